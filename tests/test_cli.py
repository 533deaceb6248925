import json

from tidemark.__main__ import main


def test_cli_extract_build_profile(spark, tmp_root, capsys):
    land = f"{tmp_root}/landing"
    import os
    os.makedirs(f"{land}/w"), os.makedirs(f"{land}/fx")
    days = [f"2025-01-{d:02d}" for d in range(1, 29)]
    with open(f"{land}/w/a.json", "w") as f:
        for loc in ("cdmx", "monterrey"):
            f.write(json.dumps({"location": loc, "daily": {
                "time": days, "temperature_2m_max": [25.0] * 28,
                "temperature_2m_min": [10.0] * 28, "precipitation_sum": [0.0] * 28}}) + "\n")
    with open(f"{land}/fx/a.json", "w") as f:
        pts = [{"fecha": f"{d[8:]}/01/2025", "dato": "20.1"} for d in days]
        f.write(json.dumps({"series_name": "fx_usd_mxn",
                            "bmx": {"series": [{"idSerie": "S1", "datos": pts}]}}) + "\n")
    root = f"{tmp_root}/wh"
    assert main(["extract", "--root", root, "--source", "weather", "--landing", f"{land}/w",
                 "--today", "2025-02-02"]) == 0
    # first run, no watermark: 2024-12-29 .. 2025-01-28 (today - 5 days lag), 28 days x 2 entities
    assert "loaded 56 rows" in capsys.readouterr().out
    assert main(["extract", "--root", root, "--source", "weather", "--landing", f"{land}/w",
                 "--today", "2025-02-02"]) == 0
    assert "up to date" in capsys.readouterr().out
    assert main(["extract", "--root", root, "--source", "fx", "--landing", f"{land}/fx",
                 "--mode", "backfill", "--start", "2025-01-01", "--today", "2025-02-02"]) == 0
    assert main(["build", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "PASS" in out and "FAIL" not in out
    assert main(["profile", "--root", root, "--table", "marts/daily_conditions"]) == 0
    assert "fx_usd_mxn" in capsys.readouterr().out
    for what in (["--model", "int_fx_gap_filled", "--stacked"], ["--path", "marts/daily_conditions"]):
        assert main(["profile", "--root", root, *what]) == 0
        assert "DOUBLE" in capsys.readouterr().out
    assert main(["check", "--root", root]) == 0
    assert "PASS" in capsys.readouterr().out
    assert main(["freshness", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "weather" in out and "fx" in out and "2025-01-28" in out
    assert main(["diagnose", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "raw_extracted_at" in out and "0 failing row(s)" in out
    assert main(["diagnose", "--root", root, "--rows", "1"]) == 0
    assert main(["diagnose", "--root", root, "--out", f"{tmp_root}/failing"]) == 0
    assert os.path.exists(f"{tmp_root}/failing/_SUCCESS")
    assert main(["build", "--root", root, "--window-replace", "--propagate"]) == 0
    assert main(["profile", "--root", root, "--table", "raw/weather_daily", "--approx"]) == 0
    capsys.readouterr()
    assert main(["profile", "--root", root, "--table", "raw/weather_daily", "--kept"]) == 0
    assert "precipitation_mm" in capsys.readouterr().out
    for said in ("1 new file(s), loaded 56 rows", "0 new file(s), loaded 0 rows"):
        assert main(["extract", "--root", root, "--source", "weather", "--landing", f"{land}/w",
                     "--new-files"]) == 0
        assert said in capsys.readouterr().out
    assert main(["stream", "--root", root, "--source", "weather", "--landing", f"{land}/w"]) == 0
    assert "1 micro-batch(es)" in capsys.readouterr().out
    assert main(["stream", "--root", root, "--source", "weather", "--landing", f"{land}/w"]) == 0
    assert "0 micro-batch(es)" in capsys.readouterr().out
