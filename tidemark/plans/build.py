"""End-to-end runs: load a source into its raw table, build the mart, check it.

``load_source`` — plan the window from stored state (M6/M9), select the
landed rows inside it (M7), validate and upsert them into the raw table (M1,
touched months only), then advance the watermark (M8), data first.

``build_mart`` — input checks (an absent or empty input, or a partition whose
schema drifted, fails before any model runs), staging → gap-fill → enrichment → contract → incremental delete+insert merge
(or a full rebuild swapped in), then one check report.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import specs
from tidemark.operators.incremental import EPOCH
from tidemark.functions.dates import as_date
from tidemark.operators.enrich import carry_to_next
from tidemark.operators.ledger import ledger_report
from tidemark.operators.quality import (ContractViolation, duplicate_groups, enforce_contract,
                                        trace)
from tidemark.operators.reach import differing_rows, merge_spans, reach_spans
from tidemark.operators.upsert import (KeyViolation, upsert_path, validate_keys,
                                       window_replace_path)
from tidemark.plans import models
from tidemark.plans.drift import stored_drift
from tidemark.plans.windows import advance_watermarks, plan_windows
from tidemark.session import delete_path, list_names, path_exists, rename_path
from tidemark.sources.marks import (changed_parts, load_marks, part_end, partition_marks,
                                    save_marks)
from tidemark.sources.landed import read_fx_landing, read_weather_landing
from tidemark.sources.landing_ledger import pending_files, record_files, reader_path
from tidemark.sources.state import load_state, save_state, state_version, watermark_of
from tidemark.sources.swap import IN, OUT, recover, swap
from tidemark.sources.tables import (part_of, read_table, stored_high_water_mark, stored_parts,
                                     write_table)


@dataclass(frozen=True)
class Layout:
    """Where the stored tables live (a shared filesystem / object store), and the grain
    of their partitions: days for large tables, so that a daily increment rewrites days."""

    root: str
    grain: str = "month"

    def spec(self, table: specs.TableSpec) -> specs.TableSpec:
        return table.with_grain(self.grain)

    @property
    def raw_weather(self) -> str:
        return f"{self.root}/raw/{specs.WEATHER_RAW.name}"

    @property
    def raw_fx(self) -> str:
        return f"{self.root}/raw/{specs.FX_RAW.name}"

    @property
    def mart(self) -> str:
        return f"{self.root}/marts/{specs.MART.name}"

    @property
    def state(self) -> str:
        return f"{self.root}/state/watermarks"

    @property
    def mart_inputs(self) -> str:
        """Marks of the raw partitions that the mart has taken in."""
        return f"{self.root}/state/mart_inputs.json"

    def landed(self, source: specs.SourceSpec) -> str:
        """The files of the source's landing that were loaded."""
        return f"{self.root}/state/landed/{source.name}"

    def raw_path(self, source: specs.SourceSpec) -> str:
        return f"{self.root}/raw/{source.table.name}"


@dataclass
class LoadResult:
    source: str
    window_start: dt.date | None
    window_end: dt.date | None
    rows_loaded: int
    watermark_before: dt.date | None
    watermark_after: dt.date | None

    @property
    def nothing_new(self) -> bool:
        return self.window_start is None or self.window_start > self.window_end


def load_source(spark: SparkSession, layout: Layout, source: specs.SourceSpec,
                landed_rows: DataFrame, today, mode: str = "incremental",
                start=None, end=None, reread_days: int = 0) -> LoadResult:
    """One extraction run of one source over already flattened landed rows
    (typed to the raw table's columns, ``extracted_at`` stamped).
    ``reread_days`` re-reads that many days before the watermark (sources
    that revise recent days); the keyed upsert absorbs the overlap.  A landed
    row without a key part fails the load, whatever the window: a row without
    a date lies in none and would otherwise be lost."""
    spec_df = spark.range(1).select(F.lit(source.name).alias("source"),
                                    F.lit(source.lag_days).alias("lag_days"),
                                    F.lit(source.default_days).alias("default_days"))
    seen = {source.name: state_version(spark, layout.state, source.name)}
    state = load_state(spark, layout.state)
    plan = plan_windows(spec_df, state, today, mode, start, end, reread_days=reread_days)
    p = plan.first()
    if not p["has_work"]:
        return LoadResult(source.name, p["window_start"], p["window_end"], 0,
                          p["last_watermark"], p["last_watermark"])
    d = F.col(source.table.date_col)
    wanted = (d >= F.lit(p["window_start"])) & (d <= F.lit(p["window_end"]))
    for k in source.table.keys:    # the upsert counts and rejects them, in its one aggregate
        wanted = wanted | F.col(k).isNull()
    batch = landed_rows.filter(wanted)
    n = upsert_path(spark, layout.raw_path(source), batch, layout.spec(source.table))
    after = p["last_watermark"]
    if mode == "incremental" and n > 0:
        loaded = spark.range(1).select(F.lit(source.name).alias("source"),
                                       F.lit(n).cast("bigint").alias("rows_loaded"))
        save_state(spark, layout.state,
                   advance_watermarks(plan, loaded, mode).select("source", "last_watermark"), seen)
        after = p["window_end"]
    return LoadResult(source.name, p["window_start"], p["window_end"], n,
                      p["last_watermark"], after)


@dataclass
class LandingResult:
    files: int
    rows: int
    watermark_before: dt.date | None
    watermark_after: dt.date | None


def load_landing(spark: SparkSession, layout: Layout, source: specs.SourceSpec, landing: str,
                 run_ts) -> LandingResult:
    """Load the landed documents that no earlier run loaded, whatever days they hold: files
    of the ledger are not opened again, and a late file with old days is loaded like any
    other.  The days of the pending files are upserted whole (within one run the newest file
    of a day wins; between runs the later run does), and the watermark moves on to their last
    day, never back.

    Data first, then ledger, then watermark: a crash in between reads the same files again
    into the keyed upsert.  A file counts as another one when its size or time changes."""
    seen = {source.name: state_version(spark, layout.state, source.name)}
    before = watermark_of(load_state(spark, layout.state), source.name)
    files = pending_files(spark, landing, layout.landed(source))
    if not files:
        return LandingResult(0, 0, before, before)
    read = read_weather_landing if source.table.name == specs.WEATHER_RAW.name else read_fx_landing
    rows = read(spark, [reader_path(f.path) for f in files], run_ts).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        n = upsert_path(spark, layout.raw_path(source), rows, layout.spec(source.table))
        last = rows.agg(F.max(source.table.date_col)).first()[0]
    finally:
        rows.unpersist()
    record_files(spark, layout.landed(source), files, run_ts)
    after = max((d for d in (before, last) if d is not None), default=None)
    if after != before:
        save_state(spark, layout.state, spark.createDataFrame([(source.name, after)],
                                                              specs.STATE.schema), seen)
    return LandingResult(len(files), n, before, after)


def check_inputs(spark: SparkSession, layout: Layout, since=None) -> None:
    """Fail before anything is built or written: an input that is absent or empty, or one
    of whose partitions (weather from ``since`` on, the whole rate history) drifted."""
    for path, table, start in ((layout.raw_weather, specs.WEATHER_RAW, since),
                               (layout.raw_fx, specs.FX_RAW, None)):
        spec = layout.spec(table)
        if not path_exists(spark, path) or read_table(spark, path, spec).isEmpty():
            raise ContractViolation(f"input {spec.name} is absent or empty at {path}")
        diff = stored_drift(spark, path, spec, part_of(start, spec) if start else None)
        if diff:
            raise ContractViolation(f"input {spec.name} drifted: {diff}")


def last_rate_day(spark: SparkSession, layout: Layout, since) -> dt.date | None:
    """The last day before ``since`` with a rate, from the newest partitions backwards:
    the history before it has no part in what is carried past ``since``."""
    spec = layout.spec(specs.FX_RAW)
    d = F.col("date")
    for part in reversed([p for p in stored_parts(spark, layout.raw_fx, spec)
                          if p <= part_of(since, spec)]):
        rates = read_table(spark, layout.raw_fx, spec, [part]).filter(
            (F.col("series") == specs.FX_SERIES) & F.col("value").isNotNull()
            & (d < F.lit(as_date(since))))
        day = rates.agg(F.max(d)).first()[0]
        if day is not None:
            return day
    return None


def conditions(spark: SparkSession, layout: Layout, since=None, spans=None) -> DataFrame:
    """The mart's source rows (all, or only dates on or after ``since``: weather partitions
    before it are pruned, rates are read from the last one before it on).  ``spans``: of
    these, only the dates in one of the (first, last) spans, whose partitions alone are read."""
    raw_w = read_table(spark, layout.raw_weather, layout.spec(specs.WEATHER_RAW), since=since,
                       parts=None if spans is None else parts_in(
                           spark, layout.raw_weather, layout.spec(specs.WEATHER_RAW), spans))
    if spans is not None:
        raw_w = raw_w.filter(in_spans("date", spans))
    first = last_rate_day(spark, layout, since) if since is not None else None
    raw_fx = read_table(spark, layout.raw_fx, layout.spec(specs.FX_RAW), since=first)
    built = models.build_conditions(models.stage_weather(raw_w), models.stage_fx(raw_fx),
                                    since=since)
    return enforce_contract(models.mart_projection(built), specs.MART.schema, "mart")


def in_spans(date_col: str, spans: list):
    """The date lies in one of the (first, last) spans."""
    inside = F.lit(False)
    for lo, hi in spans:
        inside = inside | F.col(date_col).between(F.lit(lo), F.lit(hi))
    return inside


def parts_in(spark: SparkSession, path: str, spec: specs.TableSpec, spans: list) -> list:
    """Stored partitions that overlap one of the spans."""
    return [p for p in stored_parts(spark, path, spec)
            if any(p <= hi and part_end(p, spec) >= lo for lo, hi in spans)]


def input_marks(spark: SparkSession, layout: Layout) -> dict:
    return {src.table.name: partition_marks(spark, layout.raw_path(src), layout.spec(src.table))
            for src in (specs.WEATHER, specs.FX)}


@dataclass
class Propagation:
    """``spans``: mart dates derived again; ``rows``: mart rows that differed and were
    replaced or inserted."""

    spans: list
    rows: int


def affected_spans(spark: SparkSession, layout: Layout, now: dict, kept: dict) -> list:
    """(first, last) spans of mart dates that changed raw partitions may bear on, merged.  A
    weather partition bears on its own dates; a rate partition also on the days that carry a
    rate of it, up to the next published one, however far that lies."""
    found = []
    for src in (specs.WEATHER, specs.FX):
        spec, name = layout.spec(src.table), src.table.name
        changed = [(p, part_end(p, spec)) for p in changed_parts(now[name], kept.get(name, {}))]
        if not changed:
            continue
        spans = spark.createDataFrame(changed, "lo date, hi date")
        if src is specs.FX:
            rates = read_table(spark, layout.raw_fx, spec).filter(
                F.col("series") == specs.FX_SERIES).select("date", "value")
            spans = reach_spans(merge_spans(spans), rates, "value")
        found.append(spans)
    if not found:
        return []
    every = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return sorted((r.lo, r.hi) for r in merge_spans(every).collect())  # bounded by the calendar


def propagate_changes(spark: SparkSession, layout: Layout) -> Propagation:
    """Carry corrections of the raw tables into the mart, however old the corrected days are.

    Raw partitions written since the mart last took them in (see ``sources.marks``) give
    spans of mart dates; these are derived again from their own partitions and compared
    with the mart, and the rows that differ are upserted, so that only mart partitions with a
    difference are written.  As in the incremental merge, mart rows whose raw row is gone
    stay.  Marks are taken before reading and kept after the write: a crash repeats the work,
    a load in between is found the next time.  Nothing changed ⇒ nothing is read."""
    now = input_marks(spark, layout)
    spans = affected_spans(spark, layout, now, load_marks(spark, layout.mart_inputs))
    if not spans:
        return Propagation([], 0)
    spec = layout.spec(specs.MART)
    check_inputs(spark, layout, spans[0][0])
    fresh = conditions(spark, layout, spans[0][0], spans)
    held = read_table(spark, layout.mart, spec, parts_in(spark, layout.mart, spec, spans))
    rows = upsert_path(spark, layout.mart, differing_rows(fresh, held, spec.keys), spec)
    save_marks(spark, layout.mart_inputs, now)
    return Propagation(spans, rows)


def swap_in(spark: SparkSession, df: DataFrame, path: str, spec: specs.TableSpec) -> None:
    """Full rebuild: write a fresh directory, check its keys, then swap it in under a journal
    (see ``sources.swap``).  If the swap fails, the old table is put back and the fresh one
    removed; after an interruption the next reader or writer finishes it."""
    recover(spark, path)
    parent, _, name = path.rpartition("/")
    for left in list_names(spark, parent):    # of writers that came to no swap, or closed none
        if left.startswith((f"{name}.rebuild-", f"{name}.old-")):
            delete_path(spark, f"{parent}/{left}")
    fresh, old = f"{path}.rebuild-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    try:
        write_table(df, fresh, spec)
        validate_keys(read_table(spark, fresh, spec), spec.keys, spec.name)
    except BaseException:
        delete_path(spark, fresh)
        raise
    moves = [(IN, fresh, path)]
    if path_exists(spark, path):
        moves.insert(0, (OUT, path, old))
    swap(spark, path, moves, [fresh, old], rename=rename_path)


def build_mart(spark: SparkSession, layout: Layout, full_refresh: bool = False,
               lookback_days: int = specs.MART_LOOKBACK_DAYS, since=None,
               strategy: str = "delete_insert", propagate: bool = False) -> DataFrame:
    """Build or incrementally merge the mart; returns its check report.  ``propagate``
    afterwards carries corrections of days before the lookback window into it.

    Absent mart or ``full_refresh`` ⇒ full rebuild; otherwise the source rows
    with ``date >= max(mart.date) - lookback`` (or ``>= since``) replace
    their keys (``strategy="delete_insert"``), or replace the whole window so
    keys gone from the source disappear (``strategy="window_replace"``).
    Partitions before the window are untouched."""
    if strategy not in ("delete_insert", "window_replace"):
        raise ValueError("strategy must be 'delete_insert' or 'window_replace'")
    spec, cutoff = layout.spec(specs.MART), None
    recover(spark, layout.mart)
    if not full_refresh and path_exists(spark, layout.mart):
        hwm = stored_high_water_mark(spark, layout.mart, spec) or EPOCH
        cutoff = since or (hwm - dt.timedelta(days=lookback_days))
    check_inputs(spark, layout, cutoff)
    if cutoff is None:
        now = input_marks(spark, layout)
        swap_in(spark, conditions(spark, layout), layout.mart, spec)
        save_marks(spark, layout.mart_inputs, now)
    else:
        recent = conditions(spark, layout, since=cutoff)
        if strategy == "window_replace":
            window_replace_path(spark, layout.mart, recent, spec, cutoff)
        else:
            upsert_path(spark, layout.mart, recent, spec)
        if propagate:
            propagate_changes(spark, layout)
    return check_mart(spark, layout)


def check_mart(spark: SparkSession, layout: Layout, recount: bool = False) -> DataFrame:
    """The check report of the stored mart, without building it.  Counts are kept with the
    partitions, so only those written since the last report are read (``recount``: all)."""
    return ledger_report(spark, layout.mart, layout.spec(specs.MART), mart_checks(), recount)


def source_freshness(spark: SparkSession, layout: Layout) -> DataFrame:
    """Per raw table: last load time (``extracted_at``), last data date, rows."""
    from tidemark.operators.quality import freshness

    parts = [freshness(read_table(spark, layout.raw_path(src), layout.spec(src.table)), None,
                       "extracted_at", src.table.date_col, src.name)
             for src in (specs.WEATHER, specs.FX)]
    return parts[0].unionByName(parts[1])


def rate_origins(obs: DataFrame, date_col: str = "date", value_col: str = "fx_rate") -> DataFrame:
    """(date, origin): the day whose published rate each calendar day carries."""
    published = F.when(F.col(value_col).isNotNull(), F.col(date_col))
    days = carry_to_next(obs.select(date_col, published.alias("origin")), date_col, "origin")
    return days.select("date", "origin")


def diagnose(spark: SparkSession, layout: Layout, checks: list | None = None) -> DataFrame:
    """Every mart row that fails a check, labelled with the check, traced to
    the raw weather row it was built from (``found``) and to the raw rate row
    whose value it carries (``fx_found``), each with its load time.

    Row-level checks run in one scan (each row gets the array of checks it
    fails, then is exploded); duplicate keys come from one group-by."""
    checks = checks or mart_checks()
    keys = list(specs.MART.keys)
    shown = [*keys, "temp_max_c", "temp_min_c", "fx_usd_mxn"]
    mart = read_table(spark, layout.mart, layout.spec(specs.MART))
    row_checks = [c for c in checks if c.fails is not None]
    failed = F.filter(F.array(*[F.when(F.coalesce(c.fails, F.lit(False)), F.lit(c.name))
                                for c in row_checks]), lambda x: x.isNotNull())
    flagged = mart.select(*shown, F.explode(failed).alias("check_name")) if row_checks else None
    for c in (c for c in checks if c.keys):
        dups = (mart.join(duplicate_groups(mart, list(c.keys)), list(c.keys), "left_semi")
                .select(*shown, F.lit(c.name).alias("check_name")))
        flagged = dups if flagged is None else flagged.unionByName(dups)
    raw_w = read_table(spark, layout.raw_weather, layout.spec(specs.WEATHER_RAW))
    raw_fx = read_table(spark, layout.raw_fx, layout.spec(specs.FX_RAW)).filter(
        F.col("series") == specs.FX_SERIES)
    traced = trace(flagged, raw_w, keys, ["temp_max_c", "temp_min_c", "extracted_at"])
    origin = rate_origins(raw_fx, value_col="value").toDF("__day", "fx_origin")
    dated = traced.withColumnRenamed("found", "weather_found").join(
        origin, F.col("date") == F.col("__day"), "left").drop("__day")
    return (trace(dated, raw_fx, ["fx_origin"], ["value", "extracted_at"], "raw_fx_", ["date"])
            .withColumnRenamed("found", "fx_found").withColumnRenamed("weather_found", "found"))


def inject_business_rule_fault(spark: SparkSession, layout: Layout, location: str,
                               day, run_ts: dt.datetime | None = None) -> int:
    """Fault injection into the stored raw weather table (for drills): the
    (location, day) reading becomes max 5.0 < min 25.0 — inserted if absent,
    otherwise only the two temperatures change.  ``run_ts`` (default: now, UTC)
    is the load time of an inserted row.  Returns rows written."""
    from tidemark.operators.quality import inject_impossible_rows

    day = as_date(day)
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    spec = layout.spec(specs.WEATHER_RAW)
    current = read_table(spark, layout.raw_weather, spec, [part_of(day, spec)])
    at = spark.range(1).select(F.lit(location).alias("location"), F.lit(day).alias("date"))
    keys = list(specs.WEATHER_RAW.keys)
    touched = inject_impossible_rows(current, at, keys, run_ts=run_ts).join(at, keys, "left_semi")
    return upsert_path(spark, layout.raw_weather, touched, spec)


def mart_checks() -> list:
    from tidemark.plans.catalog import mart_checks as _checks

    return _checks(*specs.FX_RANGE)
