"""Entry points for ``spark-submit``: layers, models, serving tables and the stream.

    spark-submit hazemart/jobs.py payloads --kind readings --files F --output R
    spark-submit hazemart/jobs.py payloads --kind sites --projects P --files F --output S
    spark-submit hazemart/jobs.py layers --readings R --context C --notices N --root DIR
    spark-submit hazemart/jobs.py notices --pages P --output N
    spark-submit hazemart/jobs.py train --root DIR
    spark-submit hazemart/jobs.py publish --root DIR --sites S
    spark-submit hazemart/jobs.py stream --servers HOST:PORT --topic IN --out-topic OUT --checkpoint DIR
    spark-submit hazemart/jobs.py compact --lake L
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazemart import config
from hazemart.config import ModelSettings, StreamSettings
from hazemart.functions import coerce, text
from hazemart.ml.models import train_all
from hazemart.operators.cleaning import CleaningAudit
from hazemart.operators.notices import NOTICE_COLUMNS, parse_notices, seed_notices
from hazemart.plans.features import feature_table
from hazemart.plans.serving import SERVING_SCHEMAS, build_layers, publish
from hazemart.session import build_session, scratch_space, settled
from hazemart.sources import ingest, payload, sinks, streams, tabular
from hazemart.streaming import events as ev
from hazemart.streaming import run

READING_SOURCE = ["site_id", "time", *config.READING_LIMITS, "_raw"]
CONTEXT_SOURCE = ["time", *config.CONTEXT_SOURCE.values()]
SITE_SOURCE = SERVING_SCHEMAS["air_sites"].names
STAGED = {
    "air_cleaned": "staging/readings", "weather_cleaned": "staging/context", "nmu_hourly": "staging/notice_hours",
    "mart_air_weather_hourly": "marts/hourly", "mart_air_weather_daily": "marts/daily",
    "mart_pollution_by_wind": "marts/bucket", "mart_data_quality_summary": "marts/quality",
}
MODEL_TABLES = (
    "ml_regression_predictions", "ml_classification_predictions", "ml_metrics", "ml_feature_importance", "ml_clusters",
    "ml_cluster_profile",
)


def read_notices(spark: SparkSession, path: str) -> DataFrame:
    rows = tabular.read_text_table(spark, path, NOTICE_COLUMNS, multi_line=True)
    return rows.withColumns(
        {
            "regime_level": coerce.integer(F.col("regime_level")),
            **{c: coerce.timestamp_any(F.col(c)) for c in ("period_start", "period_end")},
        }
    )


def payloads(spark: SparkSession, args: argparse.Namespace) -> None:
    """Saved JSON payloads, one per file, to the raw table the layers job reads."""
    if args.kind == "sites" and not args.projects:
        raise ValueError("site payloads need --projects")
    files = spark.read.text(args.files, wholetext=True)
    if args.kind == "readings":
        rows = payload.resolve_aliases(payload.records(files, "value"), "_raw", payload.READING_ALIASES, keep=["_raw"])
        rows = rows.select(*READING_SOURCE)
    elif args.kind == "sites":
        projects = spark.read.text(args.projects, wholetext=True).withColumnRenamed("value", "payload")
        # the payload of a project is named after its id
        project = F.regexp_extract("_metadata.file_name", "^([0-9]+)", 1)
        rows = payload.site_dimension(projects, files.select(project.alias("project_id"), F.col("value").alias("payload"))).select(*SITE_SOURCE)
    else:
        rows = payload.parallel_arrays(files, "value", list(config.CONTEXT_SOURCE.values())).select(*CONTEXT_SOURCE)
    sinks.export_csv(rows, args.output)


def layers(spark: SparkSession, args: argparse.Namespace) -> None:
    """Raw text tables to staging and marts; what was removed is counted by the pass that writes."""
    own, audit = spark.newSession(), CleaningAudit()
    readings = tabular.read_text_table(own, args.readings, READING_SOURCE)
    build_layers(
        own, readings, tabular.read_text_table(own, args.context, CONTEXT_SOURCE), read_notices(own, args.notices), args.root, audit,
    )
    print("readings: " + ", ".join(f"{n} {name.removesuffix('_rows')}" for name, n in audit.counts().items()), flush=True)


def notices(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pages (``url``, ``html``) to the notice table, or the seed notices where none could be read."""
    pages = spark.read.parquet(args.pages).select("url", text.html_to_text(F.col("html")).alias("text"))
    # asked twice, for its rows and for whether there are any
    parsed = settled(parse_notices(pages, "text", ["url"]).drop("source"), "notices")
    found = ingest.with_fallback(parsed, seed_notices(spark).drop("source"))
    moments = {c: F.date_format(c, config.READING_TIME_FORMAT) for c in ("period_start", "period_end")}
    sinks.export_csv(found.withColumns(moments).select(*NOTICE_COLUMNS).orderBy("period_start"), args.output)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    staged = {name: spark.read.parquet(f"{args.root}/{STAGED[name]}") for name in ("air_cleaned", "weather_cleaned", "nmu_hourly")}
    features = feature_table(staged["air_cleaned"], staged["weather_cleaned"], staged["nmu_hourly"])
    for name, table in train_all(features, ModelSettings(clusters=args.clusters)).items():
        sinks.write_staging(table, f"{args.root}/models/{name}", partition=None)


def publish_all(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = {name: spark.read.parquet(f"{args.root}/{path}") for name, path in STAGED.items()}
    tables.update({name: spark.read.parquet(f"{args.root}/models/{name}") for name in MODEL_TABLES})
    tables["air_sites"] = tabular.read_text_table(spark, args.sites, SITE_SOURCE)
    cut = text.published_announcement(F.col("announcement_text"))
    tables["nmu_hourly"] = tables["nmu_hourly"].withColumn("announcement_text", cut)
    if args.windows:
        tables["mart_stream_aggregates"] = spark.read.parquet(args.windows)
    publish(tables, args.location)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    settings = StreamSettings(args.window, args.watermark, args.trigger_interval, args.output_mode)
    if args.jdbc_url and settings.output_mode != "complete":
        raise ValueError("the JDBC sink replaces its table, which needs --output-mode complete")
    if args.dedup and settings.output_mode != "append":
        raise ValueError("counting after deduplication needs --output-mode append")
    raw = streams.kafka_events(spark, args.servers, args.topic, args.starting_offsets)
    windows = ev.stream_windows(raw, settings, args.clamp, args.dedup)
    outputs = {"console": sinks.console_sink(), "topic": sinks.kafka_sink(args.servers, args.out_topic)}
    if args.jdbc_url:
        outputs["jdbc"] = sinks.jdbc_snapshot_sink(args.jdbc_url, args.jdbc_table, user=args.jdbc_user, password=args.jdbc_password)
    if args.lake:
        outputs["lake"] = sinks.lake_window_sink(args.lake)
    taken = f"{args.checkpoint.rstrip('/')}-ledger"
    if args.reset:
        run.reset(spark, args.checkpoint, taken, *([args.lake] if args.lake else []))
    fan = sinks.fan_out(outputs, sinks.Ledger(spark, taken))
    query = run.start(windows, fan, args.checkpoint, settings, args.available_now)
    query.awaitTermination()


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    days = sinks.compact_days(spark, args.lake, args.small_files)
    print(f"{len(days)} days compacted", flush=True)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("payloads")
    job.add_argument("--kind", required=True, choices=["readings", "context", "sites"])
    job.add_argument("--files", required=True)
    job.add_argument("--projects", help="with --kind sites: the project list; the files are then named <project id>.json")
    job.add_argument("--output", required=True)
    job.set_defaults(run=payloads)

    job = jobs.add_parser("layers")
    for name in ("--readings", "--context", "--notices", "--root"):
        job.add_argument(name, required=True)
    job.set_defaults(run=layers)

    job = jobs.add_parser("notices")
    job.add_argument("--pages", required=True)
    job.add_argument("--output", required=True)
    job.set_defaults(run=notices)

    job = jobs.add_parser("train")
    job.add_argument("--root", required=True)
    job.add_argument("--clusters", type=int, default=ModelSettings.clusters)
    job.set_defaults(run=train)

    job = jobs.add_parser("publish")
    job.add_argument("--root", required=True)
    job.add_argument("--sites", required=True)
    job.add_argument("--location")
    job.add_argument("--windows", help="the folder given to stream --lake")
    job.set_defaults(run=publish_all)

    job = jobs.add_parser("stream")
    for name in ("--servers", "--topic", "--out-topic", "--checkpoint"):
        job.add_argument(name, required=True)
    job.add_argument("--starting-offsets", default="earliest", choices=["earliest", "latest"])
    job.add_argument("--window", default=StreamSettings.window)
    job.add_argument("--watermark", default=StreamSettings.watermark)
    job.add_argument("--trigger-interval", default=StreamSettings.trigger_interval)
    job.add_argument("--output-mode", default=StreamSettings.output_mode, choices=["complete", "update", "append"])
    job.add_argument("--available-now", action="store_true")
    job.add_argument("--clamp", action="store_true")
    job.add_argument("--dedup", action="store_true", help="count repeated deliveries once")
    job.add_argument("--lake", help="folder that keeps one row per window and site")
    job.add_argument("--reset", action="store_true", help="start over: remove progress, ledger and lake first")
    job.add_argument("--jdbc-url")
    job.add_argument("--jdbc-table", default="mart_stream_aggregates")
    job.add_argument("--jdbc-user")
    job.add_argument("--jdbc-password")
    job.set_defaults(run=stream)

    job = jobs.add_parser("compact", help="between runs of the stream")
    job.add_argument("--lake", required=True)
    job.add_argument("--small-files", type=int, default=sinks.SMALL_FILES)
    job.set_defaults(run=compact)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session(f"hazemart-{args.job}")
    spark.sparkContext.setLogLevel("WARN")
    try:
        with scratch_space(spark):
            args.run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
