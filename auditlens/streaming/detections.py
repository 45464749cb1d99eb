"""ST1: the detections over a stream of audit rows.

D1-D8 are stateless filter/project operators, so the batch functions take
a streaming DataFrame unchanged (D8 without its look-back, which belongs
to the batch refresh). D6 joins the stream with a static tag table, or
(``start_uc_escalations``) with the tags as each micro-batch finds them.

As a job (keeps the detections table the periodic job reads)::

    spark-submit -m auditlens.streaming.detections --audit <folder> --schema-from <table>
        --out <detections table> --checkpoint <shared folder> [--available-now] [--trigger "10 minutes"]
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from auditlens.operators import detections as D
from auditlens.plans import shared_scan
from auditlens.sources.audit import AUDIT_SCHEMA
from auditlens.sources.sinks import snapshot


def read_audit_stream(spark: SparkSession, path: str, schema: str = AUDIT_SCHEMA,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream of audit rows with a declared schema (no inference)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_detections(audit_stream: DataFrame, tags: DataFrame) -> dict[str, DataFrame]:
    """Every detection as a streaming DataFrame, keyed d1..d8."""
    return {
        "d1": D.auth_events(audit_stream),
        "d2": D.account_admin_assignments(audit_stream),
        "d3": D.workspace_acl_assignments(audit_stream),
        "d4": D.sensitive_group_additions(audit_stream),
        "d5": D.workspace_db_sql_acl_changes(audit_stream),
        "d6": D.uc_permission_escalations(audit_stream, tags),
        "d7": D.account_setting_changes(audit_stream),
        "d8": D.data_export_detection(audit_stream, hours=None),
    }


def stream_candidates(audit_stream: DataFrame) -> DataFrame:
    """Every audit row of the stream that a windowed rule keeps, tagged with its rule.

    Appended (partitioned by rule and date) to a detections table, it feeds
    ``SecurityPipeline(detections=...)``: the periodic job then reads this
    small table instead of rescanning the audit log.
    """
    return shared_scan.detection_candidates(audit_stream, hours=None)


def start_append(df: DataFrame, checkpoint: str, sink: Callable | str = "parquet",
                 path: str | None = None, trigger: dict | None = None,
                 query_name: str | None = None, partition_by: list[str] | None = None
                 ) -> StreamingQuery:
    """Start an append-mode query with a checkpoint (exactly-once file sinks).

    ``sink`` is a format name, or a ``foreachBatch`` function.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if trigger:
        writer = writer.trigger(**trigger)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if callable(sink):
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format(sink)
        if path:
            writer = writer.option("path", path)
    return writer.start()


def start_uc_escalations(audit_stream: DataFrame, tags: Callable[[SparkSession], DataFrame], checkpoint: str, path: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """D6 on a stream whose tag table changes meanwhile.

    ``tags(spark)`` is read again for every micro-batch, so a tag that is
    added between two batches counts from the next one on; a tag table with
    validity intervals is joined as of each event's time, whenever the event
    arrives. A micro-batch that is run again replaces its own folder.
    """
    def write(rows: DataFrame, number: int) -> None:
        found = D.uc_permission_escalations(rows, tags(rows.sparkSession))
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (audit_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def compact(spark: SparkSession, table: str, path: str, fmt: str = "parquet", keep: int = 2) -> DataFrame:
    """The detections table so far as a new snapshot version of few, large files (read it with ``latest_snapshot``).

    The stream's own folder and file log stay as they are; a periodic job
    that reads the compacted version lists a few files for each rule.
    """
    return snapshot(spark.read.format(fmt).load(table), "detections", path, fmt, partition_by=["rule"], keep=keep)


def main(argv=None) -> None:
    import argparse

    parser = argparse.ArgumentParser(description="keep the detections table from an audit stream")
    parser.add_argument("--audit", required=True, help="folder the audit files arrive in")
    parser.add_argument("--schema-from", default=None, help="a table or path with the audit schema")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--out", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--available-now", action="store_true")
    parser.add_argument("--trigger", default="10 minutes", help="time between micro-batches: longer ones write fewer, larger files")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("auditlens-detections-stream").getOrCreate()
    schema = AUDIT_SCHEMA
    if args.schema_from:
        from auditlens.sources.audit import audit as open_source
        schema = open_source(args.schema_from, spark, args.format).schema
    stream = read_audit_stream(spark, args.audit, schema, args.format)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    query = start_append(stream_candidates(stream), args.checkpoint, args.format, path=args.out,
                         trigger=trigger, partition_by=["rule", "event_date"])
    query.awaitTermination()


if __name__ == "__main__":
    main()
