"""What the operators of this subpackage share: shared scratch space, key bitmaps, byte views of text.

Scratch tables go to the folder named by ``spark.checkpoint.dir`` (a folder every executor sees), so a
lost executor costs a re-read and never a wrong or missing row.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words: space and \t \n \v \f \r (fixed by the contracts).
SPACE = r"\x20\x09-\x0D"
#: log2 of the least and the most bits in a key bitmap: up to 64 MiB.
BITMAP_BITS = (16, 29)
#: A key is hot if more than one in so many rows holds it; there are fewer hot keys than this.
HOT = 1000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster.  Where none is set a local session gets a temporary one (tests); on a
    cluster, whose machines don't share one, that is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_dir.isDefined():
        return set_dir.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="varloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{own}")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_dir(spark)}/varloom/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses neither recompute nor depend
    on an executor's disk."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_bitmap(keys: DataFrame, column: str, bits: int | None = None) -> np.ndarray:
    """A bitmap with the bit of each 64-bit key set: 32 bits or more for each key, within BITMAP_BITS.

    With more keys than that it only lets more rows through, and every user joins exactly afterwards.  Words are
    OR-ed on the executors; the driver gets 2**bits / 64 rows at most.
    """
    if bits is None:
        bits = min(max(BITMAP_BITS[0], (32 * keys.count()).bit_length()), BITMAP_BITS[1])
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("value"))
        .toPandas()
    )
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["value"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the 64-bit ``keys`` may be in the bitmap (no false negatives)."""
    slot = keys.astype(np.uint64) & np.uint64(bitmap.size * 64 - 1)
    return ((bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def as_bytes(column: pa.Array) -> list[bytes]:
    """A text column of an Arrow batch as UTF-8 byte strings, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def as_text(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


#: Rows that a task holds as Python objects at once.
SLICE = 512


def release() -> None:
    """Give freed memory back to the system: Python workers are used again and else keep their peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small_batches(spark: SparkSession, rows: int = SLICE) -> None:
    """Spark's Arrow batches hold 10,000 rows by default, which is much memory if rows are long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def sliced(run):
    """``run`` over small slices of the Arrow batches that Spark sends, with memory given back at the end."""

    def over(batches):
        try:
            yield from run(batch.slice(at, SLICE) for batch in batches for at in range(0, batch.num_rows, SLICE))
        finally:
            release()

    return over


def released(run):
    """The same for functions of one group."""

    def over(group):
        try:
            return run(group)
        finally:
            release()

    return over


def released_pair(run):
    """The same for functions of two cogroups."""

    def over(left, right):
        try:
            return run(left, right)
        finally:
            release()

    return over


def blocks(texts: list, size: int = 1 << 20):
    """Ranges of ``texts`` that hold about ``size`` units each; one longer text is a range of its own."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        if i > begin and held + len(text) > size:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def salted_rank(df: DataFrame, by: list[str], order: list[str], salt: Column, out: str) -> DataFrame:
    """Gapless rank from 0 within ``by``, without one task for a hot key.

    Rows of a key are dealt to salted cells; each cell is ranked alone and starts after the cells before
    it.  Only one count for each cell meets in a window.
    """
    from pyspark.sql import Window

    salted = df.withColumn("_salt", salt)
    cells = salted.groupBy(*by, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_salt").alias("_cell"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*by, "_salt").orderBy(*order)
    ranked = salted.withColumn("_r", F.row_number().over(within) - 1)
    on = [F.col("_salt") == F.col("_cell"), *[F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]]
    return ranked.join(starts, on).withColumn(out, F.col("_r") + F.col("_start")).drop("_salt", "_r", "_cell", "_start", *[f"_by_{c}" for c in by])


def join_hot(rows: DataFrame, lookup: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined on ``key`` with ``lookup``, which has one row for each key and, in ``count``, how many of the
    ``total`` rows hold it.  Hot keys are broadcast, so no task gets all rows of one; the others are shuffled.
    """
    hot = F.broadcast(lookup.filter(F.col(count) * HOT > total))
    cold = lookup.filter(F.col(count) * HOT <= total)
    rest = rows.join(F.broadcast(hot.select(F.col(key).alias("_hot"))), F.col(key) == F.col("_hot"), "left_anti")
    return rows.join(hot, key).unionByName(rest.join(cold, key, how))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
