"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver share: ``spark.checkpoint.dir``.

    Where it is unset a folder of our own is made, which only a local master
    can use; elsewhere that is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tracewright-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again.

    This cuts the lineage with files that outlive any executor; Spark's
    committer makes retried and speculative tasks safe.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Bytes of the input as the optimizer knows them (file sizes for scans)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(df: DataFrame, unit: int = 32 << 20, expansion: float = 2.0) -> int:
    """Partitions of about ``unit`` bytes of decoded data, at least the
    session's shuffle partitions; grows with the input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = plan_bytes(df)
    return max(least, min(2_000_000, math.ceil(size * expansion / unit))) if size < 1 << 60 else least


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def renamed(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs`` with all columns but ``keep`` named by their position, so that no
    name of theirs can clash or needs quoting; ``toDF`` gives the names back."""
    return docs.toDF(*[c if c in keep else f"__c{k}" for k, c in enumerate(docs.columns)])


_kept: dict = {}


def freed() -> None:
    """Drops what this Python worker keeps and gives its memory back to the system."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def kept(key: tuple, make):
    """What ``make`` gave for ``key``, kept by this Python worker for its later
    tasks. Only the last key's value is: a worker that goes on to another
    operator frees what the former one held."""
    if key not in _kept:
        freed()
        _kept[key] = make()
    return _kept[key]


def sliced(batches, column: int, size: int = 4 << 20):
    """The batches in slices of about ``size`` bytes of text in ``column``, so
    that Python never holds all texts of a large batch as objects."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < b.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield b.slice(start, stop - start)
            start = stop


#: Ids whose hash table a task may hold: about 24 bytes each.
BROADCAST_IDS = 1_000_000
BITS = 1 << 26


def without_ids(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not in ``gone`` (one column ``__id``,
    distinct, without nulls, cheap to read twice).

    Up to ``BROADCAST_IDS`` ids are broadcast. Beyond that a bitmap of the ids'
    hashes, 8 MB whatever their number, is: rows it does not know stay where
    they are, and only the others are shuffled for an anti-join.
    """
    if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return docs.join(F.broadcast(gone), docs["doc_id"] == gone["__id"], "left_anti")
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS)) + 1
    maps = gone.groupBy(F.bitmap_bucket_number(at(F.col("__id"))).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at(F.col("__id")))).alias("__map"))
    bit = F.bitmap_bit_position(at(F.col("doc_id")))
    octet = F.conv(F.hex(F.substring(F.col("__map"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.element_at(F.array(*[F.getbit(octet, F.lit(k)) for k in range(8)]), (bit % 8).cast("int") + 1) == 1, F.lit(False))
    probed = docs.join(F.broadcast(maps), F.bitmap_bucket_number(at(docs["doc_id"])) == maps["__bucket"], "left").withColumn("__hit", hit)
    clear, doubtful = probed.where(~F.col("__hit")).select(docs.columns), probed.where("__hit").select(docs.columns)
    return clear.unionByName(doubtful.join(gone.hint("shuffle_hash"), doubtful["doc_id"] == gone["__id"], "left_anti"))


class Memo(dict):
    """A dict that makes what is missing, in two generations: when the young
    one is full it becomes the old one, so what is in use stays."""

    def __init__(self, make, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
