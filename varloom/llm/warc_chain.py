"""WARC writing and reading with boundary-chain verification.

Writing is one pass: each record is a row, and Spark's text sink puts the record separator behind it, so
every part file is a WARC file.  Records with equal payloads are written once; the others revisit it.

Reading splits files anywhere.  A task cuts its split at every ``WARC/1.1`` magic, including any inside
payloads, and emits for each candidate its offset and, from its header, the offset of its successor.
Pointer jumping from the start of the file then keeps the records that the chain reaches: inside a split
by doubling over arrays, between splits by doubling self-joins on the offsets where chains leave their
split.  Candidates inside payloads are not reached, and go back into the payload that holds them.

Null payload counts as empty.  Repeated page ids are records of their own.  A null page id is written as
an empty one and read back as null: such a record can revisit another, and none can refer to it.  An empty
table gives an empty result.  Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, join_hot, scratch_path, sliced, table

#: Fixed by the WARC format.
MAGIC, RECORD_END = "WARC/1.1\r\n", "\r\n\r\n"
#: Rows of a side that is broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 100_000


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 SHA-1: 5 hex digits at a time are 4 base32 digits."""
    digest = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _digest() -> Column:
    return F.unhex(F.sha1("payload"))


def plan_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page, digest, refers_to) of the records that revisit another: digests alone are shuffled.

    A page id may stand for several payloads, so it names a record only with the digest.
    """
    keyed = cut(pages.select("page", _digest().alias("digest"), F.octet_length("payload").alias("size")).filter(F.col("size") >= least_bytes).select("page", "digest"), "warc-digests")
    firsts = cut(keyed.groupBy("digest").agg(F.min("page").alias("refers_to"), F.count("*").alias("n")).filter("n > 1"), "warc-firsts")
    # A digest that many pages share, as the empty payload's, is joined by a broadcast.
    found = join_hot(keyed, firsts, "digest", "n", keyed.count())
    return found.filter("refers_to is not null and not page <=> refers_to").select("page", "digest", "refers_to").distinct()


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """One record per row of ``pages``; ids go to WARC-Record-ID, a null id as ``<urn:page:>``."""
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"[\x00-\x20]", "%20").alias("url"), text.alias("payload"))
    revisits = cut(plan_revisits(rows, least_bytes), "warc-revisits")
    if revisits.count() <= BROADCAST_ROWS:
        revisits = F.broadcast(revisits)
    rows = rows.join(revisits.withColumnsRenamed({"page": "_page", "digest": "_digest"}), F.col("page").eqNullSafe(F.col("_page")) & (_digest() == F.col("_digest")), "left")
    revisit = F.col("refers_to").isNotNull()
    # A revisit carries no payload: its digest and the length of what it stands for are in the header.
    header = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page").cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(F.col("payload")),
        F.lit("\r\nX-Payload-Length: "), F.octet_length("payload"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.when(revisit, F.lit(0)).otherwise(F.octet_length("payload")),
        F.lit("\r\n\r\n"),
    )
    record = F.concat(header, F.when(revisit, "").otherwise(F.col("payload")))
    rows.select(record.alias("value")).write.option("lineSep", RECORD_END).text(path)


def _header(value: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Length of the header behind the magic with its blank line, and its fields; None if it is none."""
    end = value.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in value[:end].split(b"\r\n"):
        name, colon, content = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = content.strip()
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    return end + 4, fields


_CANDIDATE = "file string, block long, at long, size long, need long, page long, kind string, refers_to long, stated string, stated_bytes long, payload_bytes long, digest string, value binary"


def _stretches(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the stretches between magics, in the order of each split (file, block)."""
    return spark.read.option("lineSep", MAGIC).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


class _Offsets:
    """Where each stretch of a split begins, from the split's first stretch: its magic stands in front of it."""

    def __init__(self):
        self.split, self.next = None, 0

    def of(self, file: str, block: int, size: int) -> int:
        if (file, block) != self.split:
            self.split, self.next = (file, block), -len(MAGIC)
        at, self.next = self.next, self.next + size + len(MAGIC)
        return at


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every stretch between two magics: where it is (``at``, inside its split), what its header says, and its bytes
    if it isn't a whole record by itself."""

    def parse(batches):
        number = lambda x: int(x) if x is not None else None
        page_of = lambda x: int(x[len(b"<urn:page:") : -1]) if x and x.startswith(b"<urn:page:") and x.endswith(b">") and x[10:-1].lstrip(b"-").isdigit() else None
        offsets = _Offsets()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("at", "size", "need", "page", "kind", "refers_to", "stated", "stated_bytes", "payload_bytes", "digest", "value")}
            for file, block, value in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value")), strict=True):
                got = _header(value)
                row = dict.fromkeys(out)
                row["size"], row["value"], row["at"] = len(value), value, offsets.of(file, block, len(value))
                if got:
                    head, fields = got
                    length = int(fields[b"content-length"])
                    row |= {
                        "need": len(MAGIC) + head + length + len(RECORD_END), "page": page_of(fields.get(b"warc-record-id")), "kind": fields[b"warc-type"].decode("latin-1"),
                        "refers_to": page_of(fields.get(b"warc-refers-to")), "stated": fields.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:"), "stated_bytes": number(fields.get(b"x-payload-length")),
                    }
                    if row["need"] == len(MAGIC) + len(value):
                        payload = value[head : head + length]
                        row |= {"payload_bytes": length, "digest": base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode(), "value": None}
                for c in out:
                    out[c].append(row[c])
            kinds = {"kind": pa.string(), "stated": pa.string(), "digest": pa.string(), "value": pa.binary()}
            names = [x.split()[0] for x in _CANDIDATE.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(c) if c in ("file", "block") else pa.array(out[c], kinds.get(c, pa.int64())) for c in names], names)

    return cut(_stretches(spark, path).mapInArrow(sliced(parse), _CANDIDATE), "warc-candidates")


def _read_again(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(file, at, bytes) of the stretches at the offsets ``wanted`` (file, at from the file's start).

    The offsets are counted anew, so the splits of this read need not be those of the first.
    """

    def place(batches):
        offsets = _Offsets()
        for batch in batches:
            at = [offsets.of(*x) for x in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), (len(v) for v in batch.column("value").to_pylist()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(at, pa.int64()), batch.column("value")], ["file", "block", "at", "bytes"])

    found = _stretches(spark, path).join(F.broadcast(wanted.select("file").distinct()) if wanted.select("file").distinct().count() <= BROADCAST_ROWS else wanted.select("file").distinct(), "file", "left_semi")
    # One read: the offsets inside splits and what the splits add up to must come from the same splits.
    placed = cut(found.mapInArrow(sliced(place), "file string, block long, at long, bytes binary"), "warc-again")
    bases = _bases(placed.groupBy("file", "block").agg(F.sum(F.length("bytes") + len(MAGIC)).alias("total")))
    return placed.join(bases, ["file", "block"]).select("file", (F.col("at") + F.col("base")).alias("at"), "bytes").join(wanted.select("file", "at").distinct(), ["file", "at"], "left_semi")


def _bases(splits: DataFrame) -> DataFrame:
    """(file, block, base): where each split's first stretch starts in its file, the sum of what the splits before it hold."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def _chains(pdf: pd.DataFrame) -> pd.DataFrame:
    """One split: where each candidate's successor is, and where its chain leaves the split."""
    pdf = pdf.sort_values("at", ignore_index=True)
    at = pdf["at"].to_numpy(dtype=np.int64)  # of the magic in front of each stretch
    total = int(pdf["size"].sum()) + len(pdf) * len(MAGIC)
    need = pdf["need"].fillna(0).to_numpy(dtype=np.int64)
    to = at + need
    index = np.searchsorted(at, to)
    inside = (need > 0) & (index < len(at)) & (np.append(at, -1)[np.minimum(index, len(at))] == to)
    jump = np.where(inside, index, np.arange(len(at)))
    while True:  # doubling: each step reaches twice as far
        further = jump[jump]
        if (further == jump).all():
            break
        jump = further
    # A chain ends at a candidate without header; else it leaves for its last record's successor.
    leaves = np.where(need[jump] > 0, to[jump], -(1 << 62))
    return pd.DataFrame({"file": pdf["file"], "block": pdf["block"], "at": at, "next": np.where(need > 0, to, -(1 << 62)), "leaves": leaves, "total": total})


def _reached(pdf: pd.DataFrame) -> pd.DataFrame:
    """One split with the offset where the file's chain enters it: marks what the chain reaches."""
    pdf = pdf.sort_values("at", ignore_index=True)
    at, nxt = pdf["at"].to_numpy(), pdf["next"].to_numpy()
    reached = np.zeros(len(at), dtype=bool)
    position = pdf["entry"].iloc[0]
    while not pd.isna(position):
        i = np.searchsorted(at, position)
        if i >= len(at) or at[i] != position or nxt[i] < 0:
            break
        reached[i] = True
        position = nxt[i]
    # Owner: the last reached record at or before each stretch; null if that is in an earlier split.
    owner = np.where(reached, np.arange(len(at)), -1)
    owner = np.maximum.accumulate(owner)
    pdf["reached"] = reached
    pdf["owner"] = pd.array([int(at[i]) if i >= 0 else None for i in owner], dtype="Int64")
    return pdf[["file", "block", "at", "reached", "owner"]]


def verified_records(spark: SparkSession, path: str) -> DataFrame:
    """The records that the chains from the file starts reach, with the digest of their payloads."""
    found = read_candidates(spark, path)
    local = found.select("file", "block", "at", "size", "need").groupBy("file", "block").applyInPandas(_chains, "file string, block long, at long, next long, leaves long, total long")
    local = cut(local, "warc-chains")
    bases = cut(_bases(local.groupBy("file", "block").agg(F.max("total").alias("total"))), "warc-bases")
    found = found.join(bases, ["file", "block"]).withColumn("at", F.col("at") + F.col("base")).drop("base", "size")
    absolute = lambda c: F.when(F.col(c) > -(1 << 61), F.col(c) + F.col("base")).otherwise(-1).alias(c)
    placed = cut(local.join(bases, ["file", "block"]).select("file", "block", (F.col("at") + F.col("base")).alias("at"), absolute("next"), absolute("leaves")), "warc-placed")

    # Between splits: entries from the file start on, by doubling over where chains leave.
    entries = cut(placed.filter("at = 0").select("file", F.lit(0).cast("long").alias("entry")), "warc-entries")
    edges = placed.select("file", "block", "at", "leaves")
    heads = edges.select("file", F.col("at").alias("leaves"), F.col("block").alias("to_block"))
    jumps = cut(edges.join(heads, ["file", "leaves"]).filter("block <> to_block").select("file", "at", F.col("leaves").alias("to")), "warc-jumps")
    while True:
        more = entries.withColumnRenamed("entry", "at").join(jumps, ["file", "at"]).select("file", F.col("to").alias("entry"))
        grown = cut(entries.unionByName(more).distinct(), "warc-entries")
        if grown.count() == entries.count():
            break
        entries = grown
        jumps = cut(jumps.withColumnRenamed("to", "mid").join(jumps.select("file", F.col("at").alias("mid"), "to"), ["file", "mid"]).select("file", "at", "to"), "warc-jumps")
    entry = placed.select("file", "block", "at").join(entries.withColumnRenamed("entry", "at"), ["file", "at"]).select("file", "block", F.col("at").alias("entry"))
    marked = placed.join(entry, ["file", "block"], "left").select("file", "block", "at", "next", "entry").groupBy("file", "block").applyInPandas(_reached, "file string, block long, at long, reached boolean, owner long")
    marked = cut(marked, "warc-marked")

    whole = found.filter("value is null").drop("value").join(marked.filter("reached").select("file", "at"), ["file", "at"]).select("page", "kind", "refers_to", "stated", "stated_bytes", "payload_bytes", "digest")

    # Records cut by a magic inside their payload: put their stretches together again.  The stretches
    # in front of a split's first reached record belong to the last one of an earlier split.
    last = marked.groupBy("file", "block").agg(F.max("owner").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("carried", F.max("last").over(earlier)).drop("last")
    owned = marked.join(carried, ["file", "block"]).select("file", "at", "reached", F.coalesce("owner", "carried").alias("owner"))
    parts = found.drop("block").join(owned, ["file", "at"])
    cut_up = parts.filter("reached and value is not null").select("file", F.col("at").alias("owner"))
    inner = cut(parts.join(cut_up, ["file", "owner"], "left_semi").select("file", "at", "owner", "reached", "page", "kind", "refers_to", "stated", "stated_bytes", "value"), "warc-cut-up")
    if inner.isEmpty():
        return whole
    # A record that seems whole by itself can stand inside another's payload; its bytes are read again.
    unread = inner.filter("value is null").select("file", "at")
    if not unread.isEmpty():
        inner = inner.join(_read_again(spark, path, unread), ["file", "at"], "left").withColumn("value", F.coalesce("value", "bytes")).drop("bytes")

    def join_up(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at", ignore_index=True)
        value = MAGIC.encode().join(pdf["value"])
        head, fields = _header(value)
        payload = value[head : head + int(fields[b"content-length"])]
        first = pdf.iloc[:1]
        return first[["page", "kind", "refers_to", "stated", "stated_bytes"]].assign(payload_bytes=len(payload), digest=base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode())

    joined = inner.groupBy("file", "owner").applyInPandas(join_up, whole.schema)
    return whole.unionByName(joined)


def op10_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path, least_bytes=0)
    records = verified_records(spark, path)
    revisit = F.col("kind") == "revisit"
    return records.select(
        F.col("page").alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(revisit, F.col("refers_to")).alias("refers_to"),
    )


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), b AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, min(page_id) OVER (PARTITION BY html) AS first,
         array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             (((CAST('0x' || substr(hex, 5 * CAST(i // 4 AS INT) + 1, 5) AS BIGINT)) >> (5 * (3 - CAST(i % 4 AS INT)))) & 31) + 1, 1)), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""
