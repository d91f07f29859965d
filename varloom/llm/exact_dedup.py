"""Exact deduplication by 128-bit content hash with a byte comparison inside every group.

Results for the odd cases: a null text equals the empty text; rows that repeat an id are one document
and are all marked alike; a null id never stays if the group has another id; an empty table gives an
empty result; further columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, cut, in_bitmap, join_hot, key_bitmap, sliced, table


def content_hash(text: bytes) -> bytes:
    return hashlib.md5(text, usedforsecurity=False).digest()


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:7], "big")


def fold_ascii(text: bytes) -> bytes:
    """Lower-case A-Z and nothing else (UTF-8 keeps those bytes for those letters)."""
    return text.lower()


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    normalise: Callable[[bytes], bytes] = fold_ascii,
    hasher: Callable[[bytes], bytes] = content_hash,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Only hashes are shuffled for the grouping.  The texts of groups with more than one member, and those
    alone, are then compared byte by byte: equal ones meet in their tasks first, so a group sends one text from each
    task.  Should a hash have different texts, its members are grouped anew by their bytes.  Groups that hold
    many of all rows are joined back by a broadcast.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    best = F.min if keep == "min" else F.max

    def hashed(batches):
        for batch in batches:
            texts = [normalise(x) for x in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([hasher(x) for x in texts], pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string())],
                ["id", "h", "sha"],
            )

    keyed = cut(source.mapInArrow(sliced(hashed), "id long, h binary, sha string"), "exact-keys")
    groups = cut(keyed.groupBy("h").agg(best("id").alias("keep_id"), F.count("*").alias("n")), "exact-groups")
    found = join_hot(keyed, groups, "h", "n", keyed.count())

    shared = groups.filter("n > 1").select(F.conv(F.hex(F.substring("h", 1, 7)), 16, 10).cast("long").alias("k"))
    bitmap = spark.sparkContext.broadcast(key_bitmap(shared, "k"))

    def texts_of_groups(batches):
        bits = bitmap.value
        for batch in batches:
            texts = [normalise(x) for x in as_bytes(batch.column("text"))]
            hashes = [hasher(x) for x in texts]
            hit = np.flatnonzero(in_bitmap(bits, np.array([_key(x) for x in hashes], dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(hit)), pa.array([hashes[i] for i in hit], pa.binary()), pa.array([texts[i] for i in hit], pa.binary())],
                ["id", "h", "norm"],
            )

    members = source.mapInArrow(sliced(texts_of_groups), "id long, h binary, norm binary")
    texts = members.groupBy("h", "norm").agg(best("id").alias("keep_id"), F.count("*").alias("n"))
    unequal = cut(texts.groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1").select("h"), "exact-collisions")

    if not unequal.isEmpty():
        again = texts.join(unequal, "h", "left_semi")
        apart = members.join(unequal, "h", "left_semi").join(again, ["h", "norm"]).select("id", "h", F.sha2("norm", 256).alias("sha"), "keep_id", "n")
        found = found.join(unequal, "h", "left_anti").select("id", "h", "sha", "keep_id", "n").unionByName(apart)
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


ORACLE = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm)
"""
