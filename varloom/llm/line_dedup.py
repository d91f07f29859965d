"""Removal of repeated lines: a sharded minimal perfect hash over distinct line hashes, which documents probe.

Lines are known by 128 bits of their key (stripped of white space at both ends, A-Z lower-cased).  Only hashes are
shuffled to count the documents of each; the distinct ones that stand in enough documents become shards, each a minimal
perfect hash (levels of bits in which a key stands alone) into arrays of fingerprints, counts and keeping documents.
Keys of many documents are probed in the tasks that read the texts, from a broadcast of bounded size; if there are more,
the rarer ones are probed where their shard is, by lines that a bitmap lets through.

Results for the odd cases: a null or empty text is one empty line; rows that repeat an id are documents of their own,
which keep their lines alike if their id is the largest; a null id is smaller than any other, and if a key has no other,
all its lines stay; a text that loses all lines becomes empty; an empty table gives an empty result; further columns of
the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, cut, in_bitmap, key_bitmap, released, sliced, table

SPACES = b" \t\n\x0b\x0c\r"
#: Keys of one shard, and of all shards that are broadcast (20 bytes each), about.
SHARD, HELD = 1 << 16, 1 << 20
#: Bits of a level for each key that is left.
GAMMA = 1.6


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()


def _hashes(lines: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes as two columns of 64 bits) of the lines whose keys have ``least`` code points."""
    places, digests = [], []
    for i, line in enumerate(lines):
        key = line_key(line)
        if len(key) >= least and (key.isascii() or len(key.decode()) >= least):
            places.append(i)
            digests.append(xxhash.xxh3_128_digest(key))
    return np.array(places, dtype=np.int64), np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slot(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64))
    return (_mix(hi.astype(np.uint64) ^ _mix(lo.astype(np.uint64) + step)) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Places from 0 to n - 1 for n distinct keys, about 3 bits a key: each level has a bit for every slot that one of the
    keys left has alone, and a key's place is the number of bits before its own.  Other keys get any place, or -1."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1]

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], np.arange(len(hi))
        while len(left):
            size = 64 * -(-int(GAMMA * len(left) + 1) // 64)
            slot = _slot(hi[left], lo[left], len(sizes), size)
            count = np.bincount(slot, minlength=size)
            sizes.append(size)
            bits.append(count == 1)
            left = left[count[slot] != 1]
        words = np.packbits(np.concatenate(bits), bitorder="little").view("<u8") if bits else np.zeros(0, "<u8")
        return cls(np.array(sizes, dtype=np.int64), words)

    def place(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out, left, start = np.full(len(hi), -1, dtype=np.int64), np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = start + _slot(hi[left], lo[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = ((word >> bit) & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[at >> 6] + below)[hit]
            left, start = left[~hit], start + size
        return out


ARRAYS = "shard int, sizes binary, words binary, prints binary, counts binary, keeps binary, known binary"


def build_shards(keys: DataFrame, shards: int) -> DataFrame:
    """A row of arrays (ARRAYS) for each shard of ``keys`` (hi, lo, n, keep_id); a shard is built in one task."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        hi, lo = pdf["hi"].to_numpy(np.int64), pdf["lo"].to_numpy(np.int64)
        index = PerfectHash.build(hi, lo)
        order = np.argsort(index.place(hi, lo))
        known = pdf["keep_id"].notna().to_numpy()
        keeps = pdf["keep_id"].astype("Int64").fillna(0).to_numpy(np.int64)
        counts = np.minimum(pdf["n"].to_numpy(np.int64), 0xFFFFFFFF).astype("<u4")
        made = [index.sizes, index.words, lo[order], counts[order], keeps[order], np.packbits(known[order])]
        return pd.DataFrame([[pdf["shard"].iloc[0], *[x.tobytes() for x in made]]], columns=[c.split()[0] for c in ARRAYS.split(", ")])

    return keys.withColumn("shard", shard_of(shards)).groupBy("shard").applyInPandas(released(build), ARRAYS)


def shard_of(shards: int):
    return F.shiftrightunsigned("hi", 32).bitwiseAND(F.lit(shards - 1)).cast("int").alias("shard")


class Shard:
    """The arrays of one shard, to be probed.  ``lo`` is the fingerprint: another key has it once in 2**64."""

    def __init__(self, row: dict):
        get = lambda c, kind: np.frombuffer(row[c], dtype=kind)
        self.index = PerfectHash(get("sizes", "<i8"), get("words", "<u8"))
        self.prints, self.counts, self.keeps = get("prints", "<i8"), get("counts", "<u4"), get("keeps", "<i8")
        self.known = np.unpackbits(get("known", np.uint8), count=len(self.keeps)).astype(bool)

    def probe(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 for those that are none of the shard's."""
        at = self.index.place(hi, lo)
        if len(self.prints):
            at[self.prints[at] != lo] = -1
        return at

    def dropped(self, at: np.ndarray, least: int, ids: np.ndarray, has_id: np.ndarray) -> np.ndarray:
        """Which of the lines at these places go: not those of the keeping document, nor of no place."""
        keeper = np.where(self.known[at], has_id & (self.keeps[at] == ids), ~has_id)
        return (at >= 0) & (self.counts[at] >= least) & ~keeper


def _power(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(n, 1)))))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 20, least_docs: int = 3, held: int = HELD, shard: int = SHARD) -> DataFrame:
    """(id, n_lines, n_dropped, text): lines whose key has ``least_chars`` code points or more and stands in ``least_docs``
    documents or more go, but for those of the largest id that holds it; the others stay as they are."""
    if least_docs < 2 or least_chars < 1:
        raise ValueError("a repeated line is one of two documents at least, and has a character")
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def of_documents(batches):
        for batch in batches:
            each = [np.unique(_hashes(t.split(b"\n"), least_chars)[1], axis=0) for t in as_bytes(batch.column("text"))]
            owner = np.repeat(np.arange(len(each)), [len(x) for x in each])
            both = np.concatenate(each) if each else np.zeros((0, 2), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column("id").take(pa.array(owner))], ["hi", "lo", "id"])

    counted = source.mapInArrow(sliced(of_documents), "hi long, lo long, id long").groupBy("hi", "lo").agg(F.count("*").alias("n"), F.max("id").alias("keep_id"))
    keys = cut(counted.filter(F.col("n") >= least_docs), "line-keys")

    # Keys of ``enough`` documents are broadcast: all, or the most frequent ones as far as ``held`` goes.
    sizes = sorted(((r["p"], r["c"]) for r in keys.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count("*").alias("c")).collect()), reverse=True)  # a row for each power of two
    total = sum(c for _, c in sizes)
    enough, many = least_docs, total
    if total > held:
        many, enough = 0, 1 << 62
        for p, c in sizes:
            if many + c > held:
                break
            many, enough = many + c, 1 << p
    parts = _power(many / shard)
    rows = [r.asDict() for r in build_shards(keys.filter(F.col("n") >= enough), parts).collect()]  # at most ``held`` keys
    frequent = spark.sparkContext.broadcast(rows)

    def frequent_lines(shards: dict, found: np.ndarray, ids: np.ndarray, has_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which lines are keys of the broadcast shards, which of them go)."""
        known, gone = np.zeros(len(found), dtype=bool), np.zeros(len(found), dtype=bool)
        where = (found[:, 0].astype(np.uint64) >> np.uint64(32)).astype(np.int64) & (parts - 1)
        for s in np.unique(where):
            if s in shards:
                mine = np.flatnonzero(where == s)
                at = shards[s].probe(found[mine, 0], found[mine, 1])
                known[mine] = at >= 0
                gone[mine] = shards[s].dropped(at, least_docs, ids[mine], has_id[mine])
        return known, gone

    def probed(batch: pa.RecordBatch, shards: dict) -> Iterator[tuple]:
        """(row, lines, places, hashes, known, gone) of a slice's documents, all probed at once."""
        texts = [t.split(b"\n") for t in as_bytes(batch.column("text"))]
        each = [_hashes(lines, least_chars) for lines in texts]
        ends = np.cumsum([len(p) for p, _ in each])
        owner = np.repeat(np.arange(len(each)), [len(p) for p, _ in each])
        found = np.concatenate([h for _, h in each]) if each else np.zeros((0, 2), dtype=np.int64)
        column = batch.column("id")
        ids, has_id = column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
        known, gone = frequent_lines(shards, found, ids[owner], has_id[owner])
        for i, (places, _) in enumerate(each):
            own = slice(ends[i] - len(places), ends[i])
            yield i, texts[i], places, found[own], known[own], gone[own]

    def opened() -> dict:
        return {r["shard"]: Shard(r) for r in frequent.value}

    if many < total:
        rest = keys.filter(F.col("n") < enough)
        source = _with_rare(source, rest, _power((total - many) / shard), least_docs, probed, opened)
    else:
        source = source.withColumn("gone", F.lit(None).cast("array<int>"))

    def cleaned(batches):
        shards = opened()
        for batch in batches:
            more, counts, texts = batch.column("gone").to_pylist(), [], []
            for i, lines, places, _, _, gone in probed(batch, shards):
                drop = set(places[gone].tolist()) | set(more[i] or ())
                counts.append((len(lines), len(drop)))
                texts.append(b"\n".join(line for k, line in enumerate(lines) if k not in drop) if drop else b"\n".join(lines))
            n = np.array(counts, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n[:, 0]), pa.array(n[:, 1]), pa.array(texts, pa.binary()).cast(pa.string())], ["id", "n_lines", "n_dropped", "text"])

    out = source.mapInArrow(sliced(cleaned), "id long, n_lines long, n_dropped long, text string")
    return out.select(F.col("id").alias(id_col), "n_lines", "n_dropped", F.col("text").alias(text_col))


def _with_rare(source: DataFrame, rest: DataFrame, parts: int, least_docs: int, probed, opened) -> DataFrame:
    """``source`` with ``gone``: the places of lines that go by the keys of ``rest``.

    Lines ask in the task that holds their shard's arrays; a key of ``rest`` stands in fewer documents than any
    broadcast one, so none makes a task large.  Documents are known by id and hash of their text: equal ones get equal
    answers.
    """
    spark = source.sparkSession
    bitmap = spark.sparkContext.broadcast(key_bitmap(rest, "lo"))

    def asking(batches):
        shards, bits = opened(), bitmap.value
        for batch in batches:
            digests = [hashlib.md5(t, usedforsecurity=False).digest() for t in as_bytes(batch.column("text"))]
            owner, hashes, lines = [], [], []
            for i, _, places, found, known, _ in probed(batch, shards):
                ask = ~known & in_bitmap(bits, found[:, 1])
                owner.append(np.full(ask.sum(), i))
                hashes.append(found[ask])
                lines.append(places[ask])
            o, h, n = (np.concatenate(x) for x in (owner, hashes, lines))
            names = ["hi", "lo", "id", "doc", "line"]
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column("id").take(pa.array(o)), pa.array(digests, pa.binary()).take(pa.array(o)), pa.array(n.astype(np.int32))], names)

    asks = source.mapInArrow(sliced(asking), "hi long, lo long, id long, doc binary, line int").withColumn("shard", shard_of(parts))
    arrays = cut(build_shards(rest, parts), "line-shards")
    both = asks.unionByName(arrays, allowMissingColumns=True).repartition("shard").sortWithinPartitions("shard", F.col("words").isNull())

    def answer(batches):
        held, number = None, None  # the arrays of a shard come before its lines
        for batch in batches:
            which = batch.column("shard").to_numpy()
            arrives = np.flatnonzero(batch.column("words").is_valid().to_numpy(zero_copy_only=False))
            bounds = np.unique(np.concatenate([[0], arrives, np.flatnonzero(np.diff(which)) + 1, [batch.num_rows]]))
            for begin, end in itertools.pairwise(bounds.tolist()):
                if begin in arrives:
                    row = batch.slice(begin, 1).to_pylist()[0]
                    held, number, begin = Shard(row), row["shard"], begin + 1
                if begin >= end or number != which[begin]:
                    continue  # a shard without keys
                part = batch.slice(begin, end - begin)
                hi, lo = (part.column(c).to_numpy() for c in ("hi", "lo"))
                ids = part.column("id")
                gone = held.dropped(held.probe(hi, lo), least_docs, ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(np.flatnonzero(gone))) for c in ("id", "doc", "line")], ["id", "doc", "line"])

    gone = both.mapInArrow(answer, "id long, doc binary, line int").groupBy(F.col("id").alias("_id"), "doc").agg(F.collect_set("line").alias("gone"))
    return source.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.unhex(F.md5(F.coalesce("text", F.lit("")))) == F.col("doc")), "left").select("id", "text", "gone")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = """
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM s),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keep_id FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, keep_id IS NOT NULL AND keep_id <> doc_id AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
