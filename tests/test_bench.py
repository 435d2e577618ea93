"""The bench prints one parseable line and times whole queries."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf_dir):
    given = {"BENCH_SF_DIR": sf_dir, "BENCH_CPUS": "2", "BENCH_QUERIES": "backfill_range"}
    run = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env={**os.environ, **given},
        capture_output=True,
        text=True,
        timeout=300,
        check=True,
    )
    report = json.loads(run.stdout.strip())
    assert report["unit"] == "sec" and list(report["queries"]) == ["backfill_range"]
    assert 0 < report["value"] == report["queries"]["backfill_range"]
    assert f"sf{report['sf']}" in sf_dir
