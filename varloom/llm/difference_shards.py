"""Sharding of indivisible groups by Karmarkar-Karp differencing, in levels.

A partial partition is a vector of shard sizes.  Differencing takes the two partial partitions with the
largest spread, adds them in opposite order and puts the sum back.  It needs no list of all groups in one
place: each bucket of some thousand groups is differenced by a task into ``LANES`` lanes, the lanes are
the indivisible items of the next level, and the last level, of some thousand items, is differenced into
shards.  A very large group keeps a lane of its own, so that the last level can even it out.

Groups are texts with one 128-bit hash, which stands for their bytes (they are not compared again); null counts as the
empty text.  Rows that repeat an id, and rows without one, are rows of their own; groups of equal size are taken in the
order of their hashes; a text that is larger than a shard's share makes its shard the largest; an empty table gives
an empty result.  Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, join_hot, salted_rank, table

#: Items that one task combines, and the lanes that it makes of them.
BUCKET, LANES = 1500, 32
#: Items that the last task combines at most.
LAST = 8000


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine the rows of ``vectors`` (n x k sizes) into one: (k sizes ascending, n x k lanes).

    lanes[i, j] is the place that the j-th entry of row i has in the result.
    """
    n, k = vectors.shape
    order = np.argsort(vectors, axis=1, kind="stable")
    heap = []
    for i in range(n):
        sizes = vectors[i][order[i]].tolist()
        heap.append((sizes[0] - sizes[-1], i, sizes))
    heapq.heapify(heap)
    children: list[tuple[int, int, list[int], list[int]]] = []
    node = n
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heap[0]
        both = [x[j] + y[k - 1 - j] for j in range(k)]
        place = sorted(range(k), key=both.__getitem__)
        to = [0] * k
        for j, p in enumerate(place):
            to[p] = j
        children.append((a, b, to, to[::-1]))
        sizes = [both[p] for p in place]
        heapq.heapreplace(heap, (sizes[0] - sizes[-1], node, sizes))
        node += 1
    lanes = np.empty((node, k), dtype=np.int64)
    lanes[node - 1] = np.arange(k)
    for at in range(node - 1, n - 1, -1):
        a, b, ta, tb = children[at - n]
        lanes[a] = lanes[at][ta]
        lanes[b] = lanes[at][tb]
    out = np.empty((n, k), dtype=np.int64)
    np.put_along_axis(out, order, lanes[:n], axis=1)
    return np.array(heap[0][2], dtype=np.int64), out


def _lanes(items: DataFrame, buckets: int, lanes: int, tag: str) -> DataFrame:
    """items (key, size) -> rows (bucket, key, lane) and one (bucket, null, lane, size) for each lane in use."""

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key", ignore_index=True)
        vectors = np.zeros((len(pdf), lanes), dtype=np.int64)
        vectors[:, -1] = pdf["size"]
        sizes, places = difference(vectors)
        used = np.flatnonzero(sizes)
        return pd.DataFrame({"bucket": int(pdf["bucket"][0]), "key": [*pdf["key"], *[None] * len(used)], "lane": [*places[:, -1], *used], "size": [*pdf["size"], *sizes[used]]})

    dealt = items.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return cut(dealt.groupBy("bucket").applyInPandas(combine, "bucket long, key binary, lane int, size long"), tag)


def difference_shards(groups: DataFrame, shards: int = 8, bucket: int = BUCKET, last: int = LAST) -> DataFrame:
    """groups (key binary, size long), one row per key, sizes over 0 -> (key, shard)."""
    item = F.encode(F.concat_ws(":", "bucket", "lane"), "UTF-8")
    groups = groups.select("key", F.col("size").cast("long").alias("size"))
    count = groups.count()
    # Some groups, chosen by a hash, stay items as they are: the last task evens out with them what the much
    # larger lanes leave uneven.
    single = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 40)) < F.lit(int((1 << 40) * min(1.0, last / 2 / max(1, count))) if count > last else 1 << 40)
    levels, singles, items = [], groups.filter(single), groups.filter(~single)
    count = items.count()
    while count > last // 2 or (not levels and count):
        done = _lanes(items, -(-count // bucket), LANES, f"shards-{len(levels)}")
        levels.append(done.filter("key is not null").select("key", item.alias("_up")))
        items = done.filter("key is null").select(item.alias("key"), "size")
        count = items.count()
    items = items.unionByName(singles)
    ends = _lanes(items, 1, shards, "shards-last").filter("key is not null").select("key", F.col("lane").alias("shard"))
    placed = ends.join(singles.select("key"), "key", "left_semi")
    while levels:
        up = ends.select(F.col("key").alias("_up"), "shard")
        ends = levels.pop().join(up, "_up").select("key", "shard")
    return placed.unionByName(ends) if count else placed


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET, last: int = LAST) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard: one row per input row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = cut(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.unhex(F.md5(text)).alias("key"),
        ),
        "shard-rows",
    )
    total = rows.count()
    groups = cut(rows.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("copies")), "shard-groups")
    shard_of = cut(difference_shards(groups, shards, bucket, last).join(groups.select("key", "copies"), "key"), "shard-of")
    placed = join_hot(rows, shard_of, "key", "copies", total).drop("copies")
    salts = max(64, total // (shards * 10_000))
    slotted = salted_rank(placed, ["shard"], ["id", "size", "text_crc32"], F.pmod(F.xxhash64("id", "text_crc32"), F.lit(salts)), "slot")
    return slotted.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8_difference_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
