"""Time the headline queries at one scale factor and print one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from hazemart.bindings import QUERIES
from hazemart.session import build_session

HEADLINE = (
    "clean_readings", "hourly_mart", "daily_mart", "bucket_mart", "quality_summary", "feature_table", "compare_periods",
    "view_daily_by_site", "view_hourly_profile", "view_site_summary", "expand_intervals", "expand_order_months",
    "dedup_readings", "dedup_keep_first", "ingest_audit", "src_csv_roundtrip", "src_json_records", "snk_parquet_staging",
    "html_to_text", "notice_parse", "tfidf_exact", "mr_mean", "mr_count_distinct", "anomaly_iqr", "anomaly_hour_median",
    "jump_flag", "rank_sites", "quality_gaps", "weather_relation", "latest_vs_mean", "pivot_sites", "metrics_auc",
    "nearest_centroid", "stream_window_agg", "stream_dedup",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # first use of the engine is not charged to the first query
    spark.read.parquet(f"{folder}/events.parquet").groupBy("event_type").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    with contextlib.suppress(BrokenPipeError):
        sys.exit(main())
