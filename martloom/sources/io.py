"""Reading and writing the tables: typed scans, loads, seeds, refreshes, partitioned and rolling writes."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.ingest.shop import run_stamp
from martloom.operators.keyed import latest_wins
from martloom.sources.schemas import KEYS, SCHEMAS

# ---- fixed values: the first shipping rule ----
SHIPPING_SEED = (dt.date(2020, 1, 1), dt.date(2099, 12, 31), 1000)
# ---- end of fixed values ----


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster shares, spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ reading


def scan(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Parquet of a declared table; only the declared columns, none inferred."""
    return spark.read.schema(SCHEMAS[table]).parquet(path)


def load_ndjson(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Newline-delimited rows in the shape of the table. A value of the wrong type fails the load."""
    return spark.read.schema(SCHEMAS[table]).option("mode", "FAILFAST").json(path)


def load_csv(spark: SparkSession, table_or_schema: str | T.StructType, path: str) -> DataFrame:
    """A maintained master sheet: header line, # comments, declared types."""
    schema = SCHEMAS[table_or_schema] if isinstance(table_or_schema, str) else table_or_schema
    return spark.read.schema(schema).option("header", True).option("comment", "#").option("mode", "FAILFAST").csv(path)


def shipping_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([SHIPPING_SEED], SCHEMAS["ec_shipping_rules"])


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a derived table that is recomputed on every read, from the files its sources had when they were listed."""
    df.createOrReplaceTempView(name)
    return df


def refresh_view(spark: SparkSession, name: str) -> None:
    """List the files below a view again, after its sources have grown."""
    spark.catalog.refreshTable(name)


TOGETHER = {"ec_shopify_orders": ("order_id",)}  # parts of a key that bounded numbers of rows share, which are much alike


def newest_rows(raw: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A raw table as reports read it: of a row that was loaded several times, as in a rolling window, the newest.

    With `columns`, those a report needs, what stands behind the last of them is left out: equal stamps are decided column
    by column, so rows that agree up to there have the same values in all of them.
    """
    kept = list(raw.columns)
    if columns is not None:
        needed = {*KEYS[table], "inserted_at"}
        upto = max((raw.columns.index(c) for c in columns if c not in needed), default=-1)
        kept = [c for i, c in enumerate(raw.columns) if i <= upto or c in needed]
    rows = latest_wins(raw.select(*kept), KEYS[table], "inserted_at", together=TOGETHER.get(table, ()))
    return rows if columns is None else rows.select(*columns)


def required_or_reject(df: DataFrame, table_or_schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns of the declaration, and the others with `missing`, the names of their null columns.

    Every row of df is in exactly one of the two. A required column that df does not have is missing everywhere.
    """
    schema = SCHEMAS[table_or_schema] if isinstance(table_or_schema, str) else table_or_schema
    required = [f.name for f in schema.fields if not f.nullable]
    null = [F.when(F.col(c).isNull() if c in df.columns else F.lit(True), F.lit(c)) for c in required]
    marked = df.withColumn("missing", F.array_join(F.array_compact(F.array(*null)), ",") if null else F.lit(""))
    return marked.filter("missing = ''").drop("missing"), marked.filter("missing <> ''")


# ------------------------------------------------------------------ writing


def rebuild(df: DataFrame, path: str) -> None:
    """Full replacement of a report or a reloaded entity table."""
    df.write.mode("overwrite").parquet(path)


def rebuild_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def append(df: DataFrame, path: str, run_at: dt.datetime | None = None) -> None:
    """Add rows, with the load stamp when one is given."""
    if run_at is not None:
        df = df.select(*[c for c in df.columns if c != "inserted_at"], run_stamp(run_at))
    df.write.mode("append").parquet(path)


def create_if_missing(spark: SparkSession, table: str, name: str | None = None) -> bool:
    """Create the declared table when the catalog does not have it; True if it was created."""
    name = name or table
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], SCHEMAS[table]).write.saveAsTable(name)
    return True


def _by_day(df: DataFrame, day: str, cluster: Sequence[str]) -> DataFrame:
    """Rows dealt to tasks by ranges of day and cluster columns: the files of a day hold ranges that don't overlap, so a
    filter on the first cluster column leaves out files as well as row groups. The bounds come from a sample of df, which
    is read for it once more. Equal values are told apart by the other columns, so one that holds much of a day is split.
    """
    if not cluster:
        # rebalance brings a day together where it fits a task and splits a day that does not
        return df.hint("rebalance", day)
    rest = [f.name for f in df.schema.fields if f.name not in {day, *cluster} and not isinstance(f.dataType, T.MapType)]
    return df.repartitionByRange(day, *cluster, F.xxhash64(*rest) if rest else F.lit(0)).sortWithinPartitions(day, *cluster)


def write_by_day(df: DataFrame, path: str, day: str, cluster: Sequence[str] = ()) -> None:
    """A table partitioned by day, whose files are ranges of the cluster columns and in their order."""
    _by_day(df, day, cluster).write.mode("overwrite").partitionBy(day).parquet(path)


BUCKET = 4 << 20  # bytes of stored input a bucket stands for


def buckets_for(size: int, least: int = 8) -> int:
    """Number of buckets of a table made from so many bytes of input: it grows with them, so a bucket, which one task sorts and
    groups as a whole, does not."""
    return max(least, -(-size // BUCKET))


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """A table dealt by key into a fixed number of buckets, each sorted by it: jobs that group or join by the key, alone or
    with other columns, read it without a shuffle. Buckets follow the key, so one that holds much of the table is hot."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def restate_days(
    df: DataFrame, path: str, day: str, cluster: Sequence[str] = (), window: tuple[dt.date, dt.date] | None = None
) -> None:
    """Replace the days that occur in df, leave all other days of the table alone.

    With a window (first and last day, both included) df is all there is of it: days of the window that df has no
    rows for lose theirs. df is read once, into a hidden folder of the table; the rows and the list of their days both
    come from there. Empty days are removed after the write, so a run that fails in between is completed by the next.
    """
    spark = df.sparkSession
    if window is not None:
        df = df.filter(F.col(day).between(*map(F.lit, window)))
    staged = f"{path}/_staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    try:
        rows = spark.read.schema(df.schema).parquet(staged)
        filled = {r[0] for r in rows.select(day).distinct().collect()} if window else set()  # days of the window at most
        (
            _by_day(rows, day, cluster)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(day)
            .parquet(path)
        )
    finally:
        remove(spark, staged)
    if window is not None:
        first, last = window
        days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
        for empty in (d for d in days if d not in filled):
            remove(spark, f"{path}/{day}={empty.isoformat()}")


# ------------------------------------------------------------------ backfills

CHUNK = T.StructType([T.StructField("first", T.DateType()), T.StructField("last", T.DateType()), T.StructField("rows", T.LongType())])


def chunks_of(first: dt.date, last: dt.date, days: int) -> list[tuple[dt.date, dt.date]]:
    """The days from first to last, both included, in chunks of so many days; the last chunk may be shorter."""
    starts = [first + dt.timedelta(days=n) for n in range(0, (last - first).days + 1, days)]
    return [(a, min(a + dt.timedelta(days=days - 1), last)) for a in starts]


def chunks_done(spark: SparkSession, log: str) -> DataFrame:
    """(first, last, rows) of the chunks a backfill has finished."""
    return read_versions(spark, log, CHUNK, versions(spark, log)).drop("_version")


def backfill(
    fetch: Callable[[dt.date, dt.date], DataFrame],
    chunks: Sequence[tuple[dt.date, dt.date]],
    path: str,
    day: str,
    log: str,
    spark: SparkSession,
    cluster: Sequence[str] = (),
) -> int:
    """Load a long time chunk by chunk, so that a failure costs one chunk; the number of chunks loaded now.

    fetch gives the rows of the days from first to last, both included. Each chunk restates its days, days without rows
    included, and is then noted in the log. A run that is started again leaves out the chunks noted there and repeats the
    one that failed as a whole, which replaces what it had written. Empty the log to load everything again.
    """
    done = {(r["first"], r["last"]) for r in chunks_done(spark, log).collect()}  # a row per chunk
    new = [c for c in chunks if c not in done]
    for first, last in new:
        rows = fetch(first, last)
        restate_days(rows, path, day, cluster, (first, last))
        stored = spark.read.schema(rows.schema).parquet(path).filter(F.col(day).between(F.lit(first), F.lit(last)))
        noted = stored.agg(F.lit(first).alias("first"), F.lit(last).alias("last"), F.count(F.lit(1)).alias("rows"))
        write_version(noted, log, first.toordinal())
    return len(new)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def last_days(df: DataFrame, day: str, as_of: dt.date, n: int) -> DataFrame:
    """The n days up to as_of, the part of a feed that a rolling restatement reloads."""
    return df.filter(F.col(day).between(F.lit(as_of - dt.timedelta(days=n - 1)), F.lit(as_of)))


# ------------------------------------------------------------------ versions of a state table


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version:010d}"


def write_version(df: DataFrame, root: str, version: int) -> str:
    """A state table is never rewritten in place: each version has its folder, complete once _SUCCESS is
    there. Writing a version again after a failure replaces the half-written one."""
    path = version_path(root, version)
    df.write.mode("overwrite").parquet(path)
    return path


def versions(spark: SparkSession, root: str) -> list[int]:
    """The complete versions, lowest first."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("v=")]
    return sorted(int(p.getName()[2:]) for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def current_version(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """Highest complete version (below a bound), None when there is none."""
    return max((v for v in versions(spark, root) if below is None or v < below), default=None)


def read_version(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The current (or a given) version; an empty table when none was written yet."""
    if version is None:
        version = current_version(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(root, version))


def read_versions(spark: SparkSession, root: str, schema: T.StructType, which: Sequence[int]) -> DataFrame:
    """Several versions as one table, with the number of each row's version, _version; an empty table for none."""
    if not which:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_version", T.LongType())]))
    rows = spark.read.schema(schema).parquet(*[version_path(root, v) for v in which])
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/v=(\d+)/[^/]*$", 1).cast("long")
    return rows.select(*schema.fieldNames(), number.alias("_version"))
