"""Command line over the library (stored tables under one root folder).

    python -m tidemark extract --root R --source weather --landing PATH [--mode backfill --start D --end D | --new-files]
    python -m tidemark build --root R [--full-refresh] [--since D] [--propagate]
    python -m tidemark profile --root R --table raw/weather_daily [--kept] | --model M | --path P
    python -m tidemark check --root R
    python -m tidemark freshness --root R
    python -m tidemark diagnose --root R
    python -m tidemark stream --root R --source weather --landing PATH
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from tidemark import specs

TABLES = {
    "raw/" + specs.WEATHER_RAW.name: specs.WEATHER_RAW,
    "raw/" + specs.FX_RAW.name: specs.FX_RAW,
    "marts/" + specs.MART.name: specs.MART,
}
SOURCES = {s.name: s for s in (specs.WEATHER, specs.FX)}


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ex = sub.add_parser("extract", help="load landed documents of one source into its raw table")
    ex.add_argument("--root", required=True)
    ex.add_argument("--source", choices=sorted(SOURCES), required=True)
    ex.add_argument("--landing", required=True, help="folder or glob of JSON documents")
    ex.add_argument("--mode", choices=["incremental", "backfill"], default="incremental")
    ex.add_argument("--start", type=_date)
    ex.add_argument("--end", type=_date)
    ex.add_argument("--today", type=_date, default=dt.date.today())
    ex.add_argument("--modified-after", help="read only files landed after this time")
    ex.add_argument("--new-files", action="store_true",
                    help="load the files that no earlier run loaded, whatever days they hold")
    ex.add_argument("--reread-days", type=int, default=0,
                    help="restart incremental windows this many days before the watermark")
    bd = sub.add_parser("build", help="build or incrementally merge the mart, then check it")
    bd.add_argument("--root", required=True)
    bd.add_argument("--full-refresh", action="store_true")
    bd.add_argument("--since", type=_date)
    bd.add_argument("--propagate", action="store_true",
                    help="also carry corrections of days before the lookback window")
    bd.add_argument("--lookback-days", type=int, default=specs.MART_LOOKBACK_DAYS)
    bd.add_argument("--window-replace", action="store_true",
                    help="replace the whole lookback window (drops keys gone from the source)")
    pr = sub.add_parser("profile", help="one-pass profile of a stored table")
    pr.add_argument("--root", required=True)
    what = pr.add_mutually_exclusive_group(required=True)
    what.add_argument("--table", choices=sorted(TABLES))
    what.add_argument("--model", choices=["stg_weather_daily", "stg_fx", "int_fx_gap_filled",
                                          "int_daily_conditions"], help="a modelled table")
    what.add_argument("--path", help="any Parquet table below --root")
    pr.add_argument("--kept", action="store_true",
                    help="with --table: merge the profiles kept with the partitions")
    pr.add_argument("--approx", action="store_true", help="HyperLogLog distinct counts")
    pr.add_argument("--stacked", action="store_true", help="distinct counts for wide tables")
    sm = sub.add_parser("stream", help="stream landed documents: raw upsert + mart merge per batch")
    sm.add_argument("--root", required=True)
    sm.add_argument("--source", choices=sorted(SOURCES), required=True)
    sm.add_argument("--landing", required=True)
    sm.add_argument("--checkpoint", help="stream checkpoint folder (default: under --root)")
    sm.add_argument("--window-replace", action="store_true")
    fr = sub.add_parser("freshness", help="last load time and data date per raw table")
    fr.add_argument("--root", required=True)
    dg = sub.add_parser("diagnose", help="failing rows of every check, traced to their raw rows")
    dg.add_argument("--root", required=True)
    dg.add_argument("--out", help="write the rows to this Parquet folder instead of printing them")
    dg.add_argument("--rows", type=int, default=100, help="rows printed at most (default 100)")
    ck = sub.add_parser("check", help="run the mart's checks without building it")
    ck.add_argument("--root", required=True)
    for command in sub.choices.values():
        command.add_argument("--grain", choices=["month", "day"], default="month",
                             help="partition grain of the stored tables")
    args = ap.parse_args(argv)

    from tidemark.plans.build import (Layout, build_mart, check_mart, diagnose, load_landing,
                                      load_source, source_freshness)
    from tidemark.session import delete_path, get_session, scratch_path

    spark = get_session(os.environ.get("TIDEMARK_MASTER"))
    layout = Layout(args.root.rstrip("/"), args.grain)
    if args.cmd == "extract":
        from tidemark.sources.landed import read_fx_landing, read_weather_landing

        run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
        read = read_weather_landing if args.source == "weather" else read_fx_landing
        if args.new_files:
            done = load_landing(spark, layout, SOURCES[args.source], args.landing, run_ts)
            print(f"[{args.source}] {done.files} new file(s), loaded {done.rows} rows; watermark "
                  f"{done.watermark_before} -> {done.watermark_after}")
            return 0
        rows = read(spark, args.landing, run_ts, args.modified_after)
        r = load_source(spark, layout, SOURCES[args.source], rows, args.today, args.mode,
                        args.start, args.end, reread_days=args.reread_days)
        if r.nothing_new:
            print(f"[{r.source}] up to date: loaded through {r.watermark_before}")
        else:
            print(f"[{r.source}] {r.window_start} -> {r.window_end} ({args.mode}): "
                  f"loaded {r.rows_loaded} rows; watermark {r.watermark_before} -> "
                  f"{r.watermark_after}")
        return 0
    if args.cmd in ("build", "check"):
        report = check_mart(spark, layout) if args.cmd == "check" else build_mart(
            spark, layout, full_refresh=args.full_refresh, since=args.since,
            lookback_days=args.lookback_days, propagate=args.propagate,
            strategy="window_replace" if args.window_replace else "delete_insert")
        rows = report.collect()
        for r in rows:
            print(f"{r.status.upper():4s} {r.failures:>8d}  {r.check_name} ({r.column_name})")
        return 1 if any(r.status != "pass" for r in rows) else 0
    if args.cmd == "profile":
        from tidemark.operators.profile import profile
        from tidemark.sources.tables import read_table

        if args.kept and not args.table:
            ap.error("--kept needs --table")
        if args.kept:
            from tidemark.operators.profile_ledger import kept_profile

            spec = layout.spec(TABLES[args.table])
            kept_profile(spark, f"{layout.root}/{args.table}", spec, args.table).show(
                len(spec.columns) + 1, truncate=False)
            return 0
        if args.table:
            df = read_table(spark, f"{layout.root}/{args.table}", layout.spec(TABLES[args.table]))
        elif args.path:
            df = spark.read.parquet(f"{layout.root}/{args.path}")
        else:
            from tidemark.plans.models import register_views

            df = register_views(*(read_table(spark, layout.raw_path(s), layout.spec(s.table))
                                  for s in (specs.WEATHER, specs.FX)))[args.model]
        profile(df, args.table or args.path or args.model,
                distinct="approx" if args.approx else
                "stacked" if args.stacked else "exact").show(len(df.columns) + 1, truncate=False)
        return 0
    if args.cmd == "stream":
        from tidemark.streaming.ingest import stream_build

        ckpt = args.checkpoint or f"{layout.root}/checkpoints/{args.source}"
        batches, report = stream_build(spark, layout, args.landing, SOURCES[args.source], ckpt,
                                       strategy="window_replace" if args.window_replace
                                       else "delete_insert")
        print(f"[{args.source}] {batches} micro-batch(es)")
        failed = [r for r in report if r.status != "pass"]
        for r in failed:
            print(f"FAIL {r.failures:>8d}  {r.check_name} ({r.column_name})")
        return 1 if failed else 0
    if args.cmd == "diagnose":
        path = args.out or scratch_path(spark, "diagnose")
        diagnose(spark, layout).write.parquet(path)    # traced once, then counted and shown
        found = spark.read.parquet(path)
        n = found.count()
        print(f"{n} failing row(s)")
        if not args.out:
            found.show(args.rows, truncate=False)
            if n > args.rows:
                print(f"{args.rows} of {n} shown; --out writes them all")
            delete_path(spark, path)
        return 0
    source_freshness(spark, layout).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
