"""bench.py prints one JSON line with the driver's fields."""

import json

from tests.conftest import SF001


def test_bench_json_line(spark, monkeypatch, capsys):
    import bench
    monkeypatch.setenv("BENCH_SF_DIR", SF001)
    monkeypatch.setenv("BENCH_WARMUP_DIR", SF001)
    monkeypatch.setenv("BENCH_QUERIES", "calendar,hour_grid")
    bench.main()
    line = capsys.readouterr().out.strip().splitlines()[-1]
    out = json.loads(line)
    assert out["unit"] == "sec" and out["sf"] == "0.001" and set(out["queries"]) == {"calendar", "hour_grid"}
    assert out["value"] == round(sum(out["queries"].values()), 3) and "failed" not in out
