"""Session settings the jobs assume."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

# All instants are UTC; calendar days in Tokyo are derived explicitly (functions.scalars.jst_date).
UTC = {"spark.sql.session.timeZone": "UTC"}

# Let the runtime re-plan: small sides are broadcast only after their size is known,
# hot join partitions are split, tiny shuffle partitions are merged.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Streaming state on local disk, with its log in the checkpoint folder, instead of on the heap: for streams whose keys
# outgrow the executors' memory. Set before a stream's first run; its checkpoint holds on to it.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; every job reads timestamps as UTC."""
    for k, v in UTC.items():
        spark.conf.set(k, v)
    return spark


PARTITION = 2 << 20  # bytes of stored input a shuffle partition stands for
MERGED = "16m"  # of shuffled bytes, compressed


def stored_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Bytes of the files below the paths that are there, by the store that holds them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in map(jvm.org.apache.hadoop.fs.Path, paths):
        store = path.getFileSystem(conf)
        total += store.getContentSummary(path).getLength() if store.exists(path) else 0
    return total


def partition_by_size(spark: SparkSession, size: int) -> None:
    """Let shuffles start with a partition for every PARTITION bytes of input, the session's number at least.

    The runtime merges small ones again, so a task of a join, sort or window holds about the same however large the tables
    are; it can't split what a fixed number of partitions has put together. Merged ones are kept to MERGED, as rows take
    many times their compressed bytes once they are sorted.
    """
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", MERGED)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, -(-size // PARTITION))))


@contextmanager
def using(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a step that runs at once; those of before are put back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g", name: str = "martloom") -> SparkSession:
    """Session for tests and the bench. On a cluster bring your own session instead."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in {**UTC, **ADAPTIVE}.items():
        b = b.config(k, v)
    return b.getOrCreate()
