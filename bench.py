"""Headline queries, timed once each after a short warm-up.

Prints one JSON line.  BENCH_SF_DIR, BENCH_CPUS choose data and cores;
BENCH_CONTROL=1 adds the range-join form of the feature query for comparison.
"""

from __future__ import annotations

import json
import os
import sys
import time

from brinkcast.catalog.core import posts_of
from brinkcast.catalog.registry import CASES
from brinkcast.session import local_session

HEADLINE = [
    "a01_latest_annotation",
    "j02_items_with_latest",
    "j04_paired_annotations",
    "a05_window_outcomes",
    "a06_features_at",
    "a07_rolling_mean",
    "j03_ecosystem_at",
    "a16_average_precision",
    "a20_score_sets",
    "a24_backtest_report",
    "a21_psi_by_type",
    "a23_validation_report",
    "m01_stratified_sample",
    "w02_new_raw_items",
    "p02_normalize_html",
    "p17_segment_documents",
    "u01_ladder_level",
    "x07_level_statistics",
    "x09_rolling_metrics",
]


def control(spark, d):
    """Feature query as a join on the time range: every post meets every grid time
    it counts for."""
    posts_of(spark, d).createOrReplaceTempView("bench_posts")
    return spark.sql("""
        with spine as (select explode(sequence(timestamp_ntz'2024-01-02 00:00:00', timestamp_ntz'2024-01-29 00:00:00',
                              interval 15 minutes)) as h)
        select h, avg(if(not is_primary and published_at > h - interval 6 hours, valence_level, null)) as eco,
               avg(if(is_primary, valence_level, null)) as own
        from spine left join bench_posts on published_at > h - interval 24 hours and published_at <= h
        group by h""")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "brinkcast-bench")
    spark.sparkContext.setLogLevel("OFF")
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    warm = small if os.path.isdir(small) else sf_dir
    for name in ("a06_features_at", "p02_normalize_html"):
        run(CASES[name].query(spark, warm))
    times: dict[str, float] = {}
    jobs = [(n, CASES[n].query) for n in HEADLINE]
    if os.environ.get("BENCH_CONTROL") == "1":
        jobs.append(("control_range_join", control))
    for name, query in jobs:
        start = time.perf_counter()
        run(query(spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = sum(t for n, t in times.items() if n != "control_range_join")
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
