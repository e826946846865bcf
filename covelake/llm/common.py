"""Shared pieces of the corpus operators: shared work folder, partition counts, graph components.

Nothing here keeps data on the driver, and nothing writes to a machine's own folders on a cluster:
every intermediate table goes to the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covelake.llm import kernels
from covelake.sources.work import folder as work_dir

#: Bytes of (compressed) input that one task of a text shuffle should hold.
BYTES_PER_PARTITION = 10 << 20


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small_batches(spark: SparkSession) -> None:
    """Texts are long: where the session keeps Spark's default of 10,000 rows an Arrow batch, take 1,000."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/covelake/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame, bytes_each: int = BYTES_PER_PARTITION) -> int:
    """Shuffle partitions for the rows of ``df``: the session's count, or more where the input is larger."""
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > 1 << 60:  # no estimate
        return least
    return max(least, math.ceil(size / bytes_each))


def _murmur_int(value: int, seed: int = 42) -> int:
    """Spark's hash of an int column, by which repartition(n, col) deals rows."""
    mask = 0xFFFFFFFF
    rotl = lambda x, r: ((x << r) | (x >> (32 - r))) & mask
    k = rotl((value & mask) * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
    h = (rotl(seed ^ k, 13) * 5 + 0xE6546B64) & mask
    h ^= 4
    for shift, mul in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> shift)) * mul & mask
    h ^= h >> 16
    return h - (1 << 32) if h >= 1 << 31 else h


def bucket_keys(n: int) -> np.ndarray:
    """``n`` ints of which the i-th lands in partition i of ``repartition(n, key)``: one bucket a task."""
    keys, left, value = np.full(n, -1, dtype=np.int32), n, 0
    while left:
        slot = _murmur_int(value) % n
        if keys[slot] < 0:
            keys[slot], left = value, left - 1
        value += 1
    return keys


#: Caches that an operator keeps in a worker between its tasks: name -> what empties it.
kept_caches: dict = {}


def lean(run, keeps: str | None = None):
    """``run`` over batches in a worker that serves many stages.

    Caches of other operators than ``keeps`` are emptied first. Tables of powers go at the end of the task, and freed memory is given back.
    """

    def own(batches):
        for name in [n for n in kept_caches if n != keeps]:
            kept_caches.pop(name)()
        try:
            yield from run(batches)
        finally:
            kernels.forget()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return own


def binary_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary())
    if col.null_count:
        col = col.fill_null(b"")
    wide = pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def text_slices(offsets: np.ndarray, limit: int = 1 << 19):
    """Runs (i, j) of rows whose bytes stay near ``limit``, at least one row each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: rows (node, component), component = smallest node reachable.

    Alternates the large-star and small-star operations; every step is a join on a node and a
    partially aggregated minimum, so a node with very many links is dealt out by skew handling.
    Nodes without a link don't appear. Self-links are allowed and ignored beyond their node.
    """
    spark = edges.sparkSession
    cur = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(cur.where("u = v").select("u", "v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        cur = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").distinct()
        cur = materialise(cur, "edges")
        state = cur.agg(F.count(F.lit(1)), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return cur.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
