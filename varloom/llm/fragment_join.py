"""Exact N-gram Jaccard join by vertical partitioning.

The order of all n-grams is cut into fragments: ranges of the n-grams' 64-bit hashes.

1. Which n-grams are shared.  Every document's hashes are dealt to fragments, packed, with four bytes
   each.  A fragment is one task: it finds the hashes that stand in two different sets and counts them for
   each set.  A set that links with another shares at least the threshold of its n-grams, so
   only sets whose counts, summed over fragments, reach that go on (``survivors``).
2. Documents with one set are a class, and go on as its number; ids come back at the end.
3. Candidates.  n-grams are ordered from rare to frequent; a linked pair shares an n-gram within both
   prefixes, at positions that leave enough overlap.  In each n-gram's list all are first compared with
   one leader.  What is linked is connected; a list whose members are all connected is done.  In the
   others, the members outside the list's main component are compared first with some members of that, twice,
   and at last with all members of other components, if lengths, positions and 512-bit parity sketches of
   the sets (their distance bounds the sets' difference from below) leave room.  Lengths are an equality of that join,
   and long lists are dealt out in blocks, so no task compares a whole list with itself.  Large groups of near copies so cost their size, not its square.
4. Verification.  The overlap of each pair is counted separately in each fragment, and summed.
5. Components by alternating large-star and small-star steps.

Every filter is exact: no pair of linked documents of different components is left uncompared.  n-grams stand for
themselves by 64-bit hashes of their words' 64-bit hashes, and sets by 192 bits of their sums: two of m n-grams are taken
for one with a chance of about m * m / 2**65 (one in a million for 10**7 n-grams compared with each other).

Null text counts as empty; documents without words link with nothing; rows that repeat an id are one
document each and share what is found for their texts; a null id is linked as any other, and names a
component only if no document of it has an id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, blocks, cut, in_bitmap, join_hot, key_bitmap, released, released_pair, sliced, table

#: Hashes that one fragment task holds, and bytes of text worked on at once.
FRAGMENT, BLOCK = 2_000_000, 1 << 21
#: Sets whose counts one task sums.
BUCKET = 2000
#: Members of a list's main component that its other members are compared with first, and how often.
SCOUTS, SCOUT_ROUNDS = 16, 2
#: Members of a list that one block of the last comparison holds.
LIST = 1024
#: Fragments in which overlaps are counted separately, and 64-bit words of a parity sketch.
PARTS, SKETCH = 4, 8

_rng = np.random.default_rng(20_240_229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # A-Z are lower-cased
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_POWER = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit hash, the offset) of each word of the bytes ``x``, in order."""
    gap = np.ones(len(x) + 2, dtype=bool)
    gap[1:-1] = _SEPARATOR[x]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, lengths = edges[::2], (edges[1::2] - edges[::2]).astype(np.int32)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    first = np.zeros(len(starts), dtype=np.int32)
    np.cumsum(lengths[:-1], out=first[1:])
    body = x[~gap[1:-1]]  # words one after the other
    position = np.arange(len(body), dtype=np.int32) - np.repeat(first, lengths)
    sums = np.add.reduceat(_BYTE[body] * _powers(int(lengths.max()))[position], first)
    return _mix(sums + lengths.astype(np.uint64) * _POWER), starts


_TABLE = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _TABLE
    if len(_TABLE) < n:
        steps = np.full(max(n, 256), _POWER, dtype=np.uint64)
        steps[0] = 1
        _TABLE = np.cumprod(steps, dtype=np.uint64)
    return _TABLE


def _windows(w: np.ndarray, k: int) -> np.ndarray:
    h = np.zeros(max(0, len(w) - k + 1), dtype=np.uint64)
    for j in range(k):
        h = _mix(h * _POWER + w[j : j + len(h)] + np.uint64(j + 1))
    return h + np.uint64(k)


def shingle_sets(raws: list[bytes], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): the distinct 64-bit hashes of each text's n-word shingles, ascending, text after
    text; a text of fewer words has all of them as one."""
    begins = np.cumsum([0, *(len(x) + 1 for x in raws)])
    w, starts = word_hashes(np.frombuffer(b" ".join(raws), dtype=np.uint8))
    owner = np.searchsorted(begins, starts, side="right") - 1
    bounds = np.searchsorted(owner, np.arange(len(raws) + 1))
    h, whose = _windows(w, n), owner[: max(0, len(w) - n + 1)]
    inside = whose == owner[n - 1 :]
    h, whose = h[inside], whose[inside]
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < n))
    if len(short):
        h = np.concatenate([h, *(_windows(w[bounds[i] : bounds[i + 1]], bounds[i + 1] - bounds[i]) for i in short)])
        whose = np.concatenate([whose, short])
    order = np.argsort(h)
    order = order[np.argsort(whose[order].astype(np.uint16 if len(raws) < 1 << 16 else np.uint32), kind="stable")]
    h, whose = h[order], whose[order]
    head = np.ones(len(h), dtype=bool)
    head[1:] = (h[1:] != h[:-1]) | (whose[1:] != whose[:-1])
    return h[head], np.bincount(whose[head], minlength=len(raws))


def shingles(raw: bytes, n: int = 5) -> np.ndarray:
    return shingle_sets([raw], n)[0]


def signatures(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Three 64-bit words for each set that tell sets apart; zeros for the empty one."""
    out = np.zeros((len(sizes), 3), dtype=np.uint64)
    full = sizes > 0
    if len(flat):
        at = (np.cumsum(sizes) - sizes)[full]
        out[full, 0] = np.add.reduceat(_mix(flat), at)
        out[full, 1] = np.add.reduceat(_mix(flat ^ _POWER), at)
        out[full, 2] = np.bitwise_xor.reduceat(_mix(flat + _POWER), at)
    return out


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def _residue(h: np.ndarray) -> np.ndarray:
    """Four bytes that stand for a hash inside its fragment.  Two hashes may share them: that only makes
    an n-gram look shared, and the document is looked at again."""
    return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype("<u4")


_PACKED = "fragment int, id long, sig binary, key long, n long, own long, shared long, keys binary, counts binary, hashes binary"
_NAMES = [x.split()[0] for x in _PACKED.split(", ")]


def _packed(source: DataFrame, fragments: int, n: int) -> DataFrame:
    """For each document a row (id, sig, key, n, own, shared); for each fragment and block of documents a row
    (fragment, keys, counts, hashes).

    sig stands for the document's set, and key in 64 bits.  Of the documents of a block with one set, one speaks: its ``own``
    is n and its hashes are sent; the others' is 0.  A hash that stands in two sets of a block is known to
    be shared: ``shared`` counts it, and the block sends it once, at the end of ``hashes`` and without
    owner, so that a hash of very many documents is sent once for each block.  Of the other hashes, the
    first counts[0] are of the set keys[0], and so on.
    """

    def block(ids: pa.Array, raws: list[bytes]):
        flat, sizes = shingle_sets(raws, n)
        sig = signatures(flat, sizes)
        keys = sig[:, 0].copy().view(np.int64)
        _, speaks = np.unique(keys, return_index=True)
        mine = np.zeros(len(raws), dtype=bool)
        mine[speaks] = True
        owner = np.repeat(np.arange(len(raws), dtype=np.uint32), sizes)
        sent = mine[owner]
        flat, owner = flat[sent], owner[sent]
        order = np.argsort(flat)
        flat, owner = flat[order], owner[order]
        head = np.ones(len(flat), dtype=bool)
        head[1:] = flat[1:] != flat[:-1]
        several = ~head
        several[:-1] |= ~head[1:]
        shared = np.bincount(owner[several], minlength=len(raws))
        none = pa.nulls(len(raws), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.nulls(len(raws), pa.int32()), ids, pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(keys), pa.array(sizes, pa.int64()), pa.array(np.where(mine, sizes, 0), pa.int64()), pa.array(shared, pa.int64()), none, none, none], _NAMES)
        owner = np.where(several, len(raws), owner)[head]
        flat = flat[head]  # ascending, so fragments are ranges
        part = ((flat >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)
        cuts = np.concatenate([np.flatnonzero(np.diff(part, prepend=-1)), [len(part)]])
        rows: list[list] = [[], [], [], []]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            order = np.argsort(owner[a:b], kind="stable")
            counts = np.bincount(owner[a:b], minlength=len(raws))[: len(raws)]
            who = np.flatnonzero(counts)
            for column, x in zip(rows, (int(part[a]), keys[who].tobytes(), counts[who].astype("<u4").tobytes(), _residue(flat[a:b][order]).tobytes()), strict=True):
                column.append(x)
        if rows[0]:
            blank = pa.nulls(len(rows[0]), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), blank, pa.nulls(len(rows[0]), pa.binary()), *[blank] * 4, *(pa.array(x, pa.binary()) for x in rows[1:])], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, raws = batch.column("id"), as_bytes(batch.column("text"))
            for begin, end in blocks(raws, BLOCK):
                yield from block(ids.slice(begin, end - begin), raws[begin:end])

    return source.mapInArrow(sliced(run), _PACKED)


def _count_shared(pdf: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """One fragment: how many hashes of each set stand in another set too, packed by buckets of keys."""
    hashes = np.concatenate([np.frombuffer(x, dtype="<u4") for x in pdf["hashes"]])
    keys = [np.frombuffer(x, dtype=np.int64) for x in pdf["keys"]]
    counts = [np.frombuffer(x, dtype="<u4") for x in pdf["counts"]]
    # Number the sets from 1; 0 is no owner.
    names, number = np.unique(np.concatenate(keys), return_inverse=True)
    number, at, owners = (number + 1).astype(np.uint32), 0, []
    for c, h in zip(counts, pdf["hashes"], strict=True):
        own = np.repeat(number[at : at + len(c)], c)
        owners += [own, np.zeros(len(h) // 4 - len(own), dtype=own.dtype)]
        at += len(c)
    owner = np.concatenate(owners)
    order = np.argsort(hashes)
    hashes, owner = hashes[order], owner[order]
    heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    low, high = np.minimum.reduceat(owner, heads), np.maximum.reduceat(owner, heads)
    shared = np.repeat((low != high) | (low == 0), np.diff(np.append(heads, len(hashes))))
    total = np.bincount(owner[shared], minlength=len(names) + 1)[1:]
    names, total = names[total > 0], total[total > 0]
    bucket = names % buckets
    order = np.argsort(bucket, kind="stable")
    names, total, bucket = names[order], total[order], bucket[order]
    cuts = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(bucket)]])
    parts = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pd.DataFrame({"bucket": bucket[cuts[:-1]], "keys": [names[a:b].tobytes() for a, b in parts], "counts": [total[a:b].astype("<u4").tobytes() for a, b in parts]})


def _survivors(everyone: DataFrame, between: DataFrame, buckets: int, num: int, den: int) -> DataFrame:
    """The keys of sets whose n-grams are shared to num / den at least: counts summed over fragments."""

    def total(sets: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
        sets = sets.sort_values("key", ignore_index=True)
        key, shared = sets["key"].to_numpy(), sets["shared"].to_numpy(dtype=np.int64, copy=True)
        for k, c in zip(packed["keys"], packed["counts"], strict=True):
            shared[np.searchsorted(key, np.frombuffer(k, dtype=np.int64))] += np.frombuffer(c, dtype="<u4")
        own = sets["own"].to_numpy(dtype=np.int64)
        return pd.DataFrame({"key": key[(own > 0) & (shared * den >= own * num)]})

    # Every set is in ``everyone``, so its key is found.
    sets = everyone.groupBy("key").agg(F.sum("own").alias("own"), F.sum("shared").alias("shared")).withColumn("bucket", F.pmod("key", F.lit(buckets)))
    return sets.groupBy("bucket").cogroup(between.groupBy("bucket")).applyInPandas(released_pair(total), "key long")


def sketches(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Parities of each set in 64 * SKETCH slots: each element in which two sets differ flips one."""
    width = 64 * SKETCH
    slots = (flat * np.uint64(0xA24BAED4963EE407) >> np.uint64(40)).astype(np.int64) % width
    slots += np.repeat(np.arange(len(sizes)) * width, sizes)
    return np.packbits((np.bincount(slots, minlength=width * len(sizes)) & 1).astype(np.uint8)).view(np.int64).reshape(len(sizes), SKETCH)


def _surviving(source: DataFrame, survivors: DataFrame, n: int) -> DataFrame:
    """id, key, sig, n, sketch, hashes of the documents whose set is in ``survivors`` (column key).

    The bitmap keeps most others from being sent; the join leaves out the rest.
    """
    bitmap = source.sparkSession.sparkContext.broadcast(key_bitmap(survivors, "key"))

    def run(batches: Iterator[pa.RecordBatch]):
        bits = bitmap.value
        for batch in batches:
            ids, raws = batch.column("id"), as_bytes(batch.column("text"))
            for begin, end in blocks(raws, BLOCK):
                flat, sizes = shingle_sets(raws[begin:end], n)
                sig = signatures(flat, sizes)
                hit = in_bitmap(bits, sig[:, 0]) & (sizes > 0)
                flat, sig, took, sizes = flat[np.repeat(hit, sizes)], sig[hit], np.flatnonzero(hit), sizes[hit]
                lists = lambda x, ends: pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(x.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(took + begin)), pa.array(sig[:, 0].copy().view(np.int64)), pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(sizes, pa.int64()), lists(sketches(flat, sizes), np.arange(1, len(sizes) + 1) * SKETCH), lists(flat, np.cumsum(sizes))],
                    ["id", "key", "sig", "n", "sketch", "hashes"],
                )

    found = source.mapInArrow(sliced(run), "id long, key long, sig binary, n long, sketch array<long>, hashes array<long>")
    # A class of equal sets goes on as one row of its documents with the smallest id; copies in one task meet first.
    classes = found.groupBy("sig", "key").agg(F.min("id").alias("id"), F.first(F.struct("n", "sketch", "hashes")).alias("x"))
    return classes.join(survivors.distinct(), "key", "left_semi").select("sig", "id", "x.*")


class Threshold:
    """Jaccard similarity of at least num / den, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def least(self, n: Column) -> Column:
        """ceil(t n): the overlap that a set of n needs with any partner."""
        return F.floor((n * self.num + self.den - 1) / self.den)

    def overlap(self, a: Column, b: Column) -> Column:
        """ceil(t / (1 + t) (a + b))."""
        both = self.num + self.den
        return F.floor(((a + b) * self.num + both - 1) / both)

    def linked(self, shared: Column, a: Column, b: Column) -> Column:
        return shared * self.den >= (a + b - shared) * self.num

    def lengths(self, a: Column, b: Column) -> Column:
        return (F.least(a, b) * self.den >= F.greatest(a, b) * self.num) & a.isNotNull()

    def positions(self, a: Column, i: Column, b: Column, j: Column) -> Column:
        """Room for the overlap if the n-gram at i of a and j of b is the first that they share."""
        return F.least(a - i, b - j) >= self.overlap(a, b)

    def differ(self, a: Column, b: Column) -> Column:
        """The most elements in which linked sets differ."""
        return a + b - 2 * self.overlap(a, b)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that edges (a, b) reach from each node that has one.

    Alternating large-star and small-star steps; each node's smallest neighbour is a partial aggregate, so
    no task gathers a node's neighbours.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    state = (now.count(), None)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")).select("u", F.least("u", "m").alias("m"), "c")
        # Nodes with many of all links are joined by a broadcast, so no task gets all of a node's neighbours.
        large = join_hot(both, cut(low, "large-low"), "u", "c", 2 * state[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "large-star")
        least = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")), "small-low")
        small = join_hot(large, least, "u", "c", 2 * state[0]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(least.select("u", F.col("m").alias("v")).unionByName(small).distinct(), "small-star")
        before, state = state, tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _links(pairs: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """The linked ones of ``pairs`` (a, b): partial overlaps by fragment, summed."""
    light = sets.select("rep", "n", "sketch")
    a, b = (light.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    near = pairs.join(a, "a").join(b, "b").filter(t.lengths(F.col("na"), F.col("nb")) & _sketches_near(F.col("sa"), F.col("sb"), t.differ(F.col("na"), F.col("nb"))))
    near = cut(near.select("a", "b", "na", "nb"), "near-pairs")
    parts = sets.select("rep", F.explode(F.expr(f"transform(sequence(0, {PARTS - 1}), p -> named_struct('part', p, 'h', filter(hashes, x -> shiftrightunsigned(x, {64 - PARTS.bit_length() + 1}) = p)))")).alias("x")).select("rep", "x.*")
    left = near.join(parts.select(F.col("rep").alias("a"), "part", F.col("h").alias("ha")), "a")
    right = parts.select(F.col("rep").alias("b"), "part", F.col("h").alias("hb"))
    partial = left.join(right, ["b", "part"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ha", "hb")).alias("o"))
    return partial.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o")).filter(t.linked(F.col("o"), F.col("na"), F.col("nb"))).select("a", "b")


def _member(turn: int) -> Column:
    """An entry, to be chosen from its list by a hash that differs from turn to turn."""
    return F.struct(F.xxhash64("rep", F.lit(turn)).alias("x"), "rep", "n", "pos")


def _open_lists(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """Entries of the lists whose members are not all connected, with their component and the list's main one."""
    placed = lists.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    placed = cut(placed, "placed")
    shares = placed.groupBy("h", "comp").agg(F.count("*").alias("c"))
    mains = shares.groupBy("h").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps"), F.sum("c").alias("members")).filter("comps > 1")
    mains = cut(mains.select("h", F.col("m.comp").alias("main"), "members"), "mains")
    return cut(join_hot(placed, mains, "h", "members", placed.count()).drop("members"), "open-lists")


def _sketches_near(x: Column, y: Column, most: Column) -> Column:
    apart = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(SKETCH)), F.lit(0))
    return apart <= most


def jaccard_components(docs: DataFrame, num: int = 80, den: int = 100, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id: one row per input row.  Linked: similarity of at least num / den."""
    t = Threshold(num, den)
    source = _source(docs, id_col, text_col)
    size, rows = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    fragments, buckets = max(1, size // 7 // FRAGMENT), max(1, rows // BUCKET)
    packed = cut(_packed(source, fragments, n), "packed")

    everyone = packed.filter("fragment is null").select("id", "sig", "key", "n", "own", "shared")
    between = packed.filter("fragment is not null").select("fragment", "keys", "counts", "hashes").groupBy("fragment").applyInPandas(released(lambda pdf: _count_shared(pdf, buckets)), "bucket long, keys binary, counts binary")
    survivors = cut(_survivors(everyone, between, buckets, num, den), "survivors")

    # A class goes on as a number, given as it is written (ids may be null or stand for several sets).
    classes = cut(_surviving(source, survivors, n).select(F.monotonically_increasing_id().alias("rep"), "sig", "id", "n", "sketch", "hashes"), "classes")

    # n-grams from rare to frequent; those of one class alone come first and match nothing.
    grams = classes.select("rep", "n", F.explode("hashes").alias("h"))
    frequent = grams.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = grams.join(frequent, "h").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("g"))
    prefix = F.col("n") - t.least(F.col("n")) + 1
    alone = F.col("n") - F.size("g")
    ordered = ordered.withColumn("take", (prefix - alone).cast("int")).filter("take > 0")
    entries = ordered.select("rep", "n", alone.alias("alone"), F.posexplode(F.slice("g", F.lit(1), F.col("take")))).select(F.col("col.h").alias("h"), "rep", "n", (F.col("alone") + F.col("pos")).alias("pos"))
    entries = cut(entries, "entries")

    # All of a list against its leader.
    room = lambda a, i, b, j: t.lengths(F.col(a), F.col(b)) & t.positions(F.col(a), F.col(i), F.col(b), F.col(j))
    ordered_pair = (F.least("rep", "l").alias("a"), F.greatest("rep", "l").alias("b"))
    leaders = entries.groupBy("h").agg(F.min(_member(0)).alias("l"), F.count("*").alias("c")).filter("c > 1").select("h", F.col("l.rep").alias("l"), F.col("l.n").alias("ln"), F.col("l.pos").alias("lp"))
    leaders = cut(leaders, "leaders")
    pairs = entries.join(leaders, "h").filter((F.col("rep") != F.col("l")) & room("n", "pos", "ln", "lp")).select(*ordered_pair).distinct()
    links = cut(_links(pairs, classes, t), "links")
    lists = cut(entries.join(leaders.select("h"), "h", "left_semi"), "lists")

    # The members outside a list's main component against some of that, to connect what is easily
    # connected; how many are missed here only changes what is left for the last step.
    for turn in range(1, SCOUT_ROUNDS + 1):
        lists = _open_lists(lists, cut(components(links), "components"))
        slot = F.pmod(F.xxhash64("rep", F.lit(-turn)), F.lit(SCOUTS))
        scouts = lists.filter("comp = main").groupBy("h", slot.alias("slot")).agg(F.min(_member(turn)).alias("l")).select("h", F.col("l.rep").alias("l"), F.col("l.n").alias("ln"), F.col("l.pos").alias("lp"))
        pairs = lists.filter("comp <> main").drop("comp", "main").join(scouts, "h").filter(room("n", "pos", "ln", "lp")).select(*ordered_pair).distinct()
        links = cut(links.unionByName(_links(pairs, classes, t)), "links")
        lists = lists.drop("comp", "main")

    # All of them against all members of other components.
    lists = _open_lists(lists, cut(components(links), "components"))
    lists = cut(lists.join(classes.select("rep", "sketch"), "rep"), "open-lists")
    # Linked sets are of the same or of neighbouring bands of length; long lists are dealt out in blocks.
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(den / num)) + 1e-9).cast("int") if num < den else F.col("n").cast("int")
    size = lists.groupBy("h").agg(F.ceil(F.count("*") / LIST).cast("int").alias("blocks"))
    dealt = cut(lists.join(size, "h").withColumns({"band": band, "block": F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int")}), "dealt-lists")
    near = F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)]))
    stray = dealt.filter("comp <> main").withColumn("band", near).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    stray = stray.select("h", "band", "block", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("comp").alias("ca"), F.col("sketch").alias("sa")).alias("s")
    other = dealt.select("h", "band", "block", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("comp").alias("cb"), "main", F.col("sketch").alias("sb")).alias("o")
    # Two strays meet once: the one with the smaller number compares.
    meets = (F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("main")) | (F.col("a") < F.col("b")))
    meets &= room("na", "pa", "nb", "pb") & _sketches_near(F.col("sa"), F.col("sb"), t.differ(F.col("na"), F.col("nb")))
    meets &= (F.col("s.h") == F.col("o.h")) & (F.col("s.band") == F.col("o.band")) & (F.col("s.block") == F.col("o.block"))
    crossed = stray.join(other, meets).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    final = cut(components(cut(links.unionByName(_links(crossed, classes, t)), "links")), "components")

    # The smallest id of a component names it.  Copies that are like no other set are one by themselves.
    placed = cut(classes.select("rep", "sig", "id").join(final.withColumnRenamed("node", "rep"), "rep").select("sig", "id", "comp"), "placed")
    named = placed.groupBy("comp").agg(F.min("id").alias("name"))
    reps = everyone.filter("n > 0").groupBy("sig").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    of = cut(reps.join(placed.join(named, "comp").select("sig", "name"), "sig", "left").select("sig", F.coalesce("name", "rep").alias("component_id"), "copies"), "names")
    return join_hot(everyone, of, "sig", "copies", rows, "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def op3_fragment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
