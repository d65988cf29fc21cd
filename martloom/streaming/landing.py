"""Landed payload files as a stream: every file is taken exactly once, state keeps the newest row per key.

Streams read what has arrived since the last run and stop. State that outgrows the heap belongs on disk: see
session.DISK_STATE.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martloom.ingest.payloads import judged
from martloom.sources import io

Transform = Callable[[DataFrame], DataFrame]


def landed(spark: SparkSession, path: str, schema: str | T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Stream of JSON-lines files that keep arriving in a folder. A document that does not fit stops the stream
    before its batch is committed, as it fails the batch load."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    return _paced(reader, files_per_batch).json(path)


def landed_texts(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(file, body) of the documents of JSON-lines files that keep arriving, not parsed yet. Blank lines are no documents."""
    lines = _paced(spark.readStream, files_per_batch).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body")).filter("trim(body) <> ''")


def _paced(reader, files_per_batch: int | None):
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


# ------------------------------------------------------------------ appending


def append_stream(payloads: DataFrame, transform: Transform, out: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of all files that have arrived since the last run, then stop.

    The file sink keeps a log of committed batches next to the data, so a batch that is retried after a
    failure does not land twice for readers of the folder.
    """
    return (
        transform(payloads)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def append_once_stream(
    payloads: DataFrame, transform: Transform, keys: Sequence[str], within: str, out: str, checkpoint: str
) -> StreamingQuery:
    """append_stream for files that overlap: of rows with equal keys the first is appended, copies of it are not.

    An increment from an inclusive mark brings the rows at the mark again. What has been seen is kept for `within` (as
    "2 days") after the batch that brought it, so the state holds the rows of that time and not of all time. The clock
    is the start of the batch, which the checkpoint keeps for a retry; it never runs back, so no row is too late to be
    appended. A copy that comes after that time is appended again; latest_wins settles it when the table is read.
    Rows of one key count as copies whatever else they hold: a row that may change needs its stamp among the keys.
    Null keys are equal to each other.
    """
    stamped = transform(payloads).withColumn("_taken", F.current_timestamp()).withWatermark("_taken", within)
    return append_stream(stamped, lambda df: df.dropDuplicatesWithinWatermark(list(keys)).drop("_taken"), out, checkpoint)


# ------------------------------------------------------------------ good and bad documents


def two_sided_stream(texts: DataFrame, schema: str, transform: Transform, out: str, checkpoint: str) -> StreamingQuery:
    """Rows of the documents that fit, and the documents that don't, so that a bad one stops nothing and is not lost.

    A batch parses its documents once, into a staged table with a side for each; the rows of the good side are made from
    there, the bad side stays as it is. The batch counts when its line in the log stands, which is written last. All
    folders carry the batch number: a batch that runs again, at any point, replaces its own and lands once.
    """
    spark = texts.sparkSession

    def land(batch: DataFrame, batch_id: int) -> None:
        sided = judged(batch, schema).withColumn("body", F.when(F.col("rejected"), F.col("body")))
        staged = io.version_path(f"{out}/staged", batch_id)
        sided.write.mode("overwrite").partitionBy("rejected").parquet(staged)
        both = spark.read.schema(sided.schema).parquet(staged)
        good = both.filter("NOT rejected").select(*[c for c in batch.columns if c != "body"], "doc.*")
        io.write_version(transform(good), f"{out}/rows", batch_id)
        io.write_version(both.filter("rejected").select(*batch.columns), f"{out}/rejected", batch_id)
        bad = F.count_if("rejected").alias("rejected")
        counts = both.agg(F.count(F.lit(1)).alias("landed"), (F.count(F.lit(1)) - bad).alias("accepted"), bad)
        io.write_version(counts, f"{out}/log", batch_id)
        io.remove(spark, staged)

    return texts.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


LOG = T.StructType([T.StructField(c, T.LongType()) for c in ("landed", "accepted", "rejected")])
TEXTS = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "body")])


def read_side(spark: SparkSession, out: str, side: str, schema: T.StructType) -> DataFrame:
    """`rows`, `rejected` (schema TEXTS) or the `log` (schema LOG) of the batches that count, with the number of the batch, _version."""
    return io.read_versions(spark, f"{out}/{side}", schema, io.versions(spark, f"{out}/log"))


# ------------------------------------------------------------------ newest row per key


def latest_state_stream(
    payloads: DataFrame, transform: Transform, keys: Sequence[str], newest: str, schema: T.StructType, root: str, checkpoint: str
) -> StreamingQuery:
    """Keep the newest row per key of everything that has arrived; equal stamps are decided by the other columns.

    The rows are the state of a streaming aggregation, combined by task before they meet it. A batch hands on the keys
    that it touched, as they stand now, and writes those only, to the folder of its number: a batch that runs again
    starts from the state before it and replaces its own folder. read_state puts the folders together.
    """
    rest = [c for c in schema.fieldNames() if c not in {*keys, newest}]
    rows = transform(payloads).select(*schema.fieldNames())
    state = rows.groupBy(*keys).agg(F.max(F.struct(newest, *rest)).alias("_row")).select(*keys, "_row.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        io.write_version(batch.select(*schema.fieldNames()), f"{root}/changes", batch_id)

    return (
        state.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_state(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row per key: the last compaction and the changes after it, of which the latest of a key counts."""
    base = io.current_version(spark, f"{root}/base")
    after = [v for v in io.versions(spark, f"{root}/changes") if base is None or v > base]
    kept = io.read_versions(spark, f"{root}/base", schema, [] if base is None else [base])
    changes = io.read_versions(spark, f"{root}/changes", schema, after)
    rest = [c for c in schema.fieldNames() if c not in keys]
    last = kept.unionByName(changes).groupBy(*keys).agg(F.max(F.struct("_version", *rest)).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in schema.fieldNames()])


def compact_state(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str]) -> int | None:
    """Write the state as one table, so that reading it costs one row per key again; the version written.

    Runs beside the stream: it only puts together batches that are complete, and readers go on with the folders they
    listed. What the compaction before the last replaced is removed.
    """
    done = io.versions(spark, f"{root}/changes")
    before = io.current_version(spark, f"{root}/base")
    if not done or done[-1] == before:
        return before
    io.write_version(read_state(spark, root, schema, keys), f"{root}/base", done[-1])
    if before is not None:
        for side in ("base", "changes"):
            for v in io.versions(spark, f"{root}/{side}"):
                if v < before or (side == "changes" and v == before):
                    io.remove(spark, io.version_path(f"{root}/{side}", v))
    return done[-1]
