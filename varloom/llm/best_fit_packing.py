"""Packing of token sequences: large-item matching, then best fit of the rest.

Lengths are whole numbers from 1 to the capacity, so a histogram of lengths (at most ``capacity`` rows)
holds all that the packing depends on.  ``plan_packing`` packs that histogram, whole classes of equal
bins at a time; pieces then find their place from their rank within their length.  Neither the driver
nor any task holds a list of documents.

Null text counts as empty and has the end id alone; rows that repeat an id are packed each, and those with a null
id too; pieces of equal length are placed in the order of a hash, and of id, piece and checksum where that is equal; an
empty table gives an empty result.
Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_text, cut, salted_rank, sliced, table

CAPACITY = 2048
TABLE_ROWS, LONGEST = 200_000, 64


def byte_characters() -> dict[int, int]:
    """The character that byte-level models write for each byte: itself if it prints, else the next from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in prints]
    return {b: 256 + i for i, b in enumerate(rest)}


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Ids(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= TABLE_ROWS:
                self.clear()
            self[word] = ids
        return ids


#: What the file must say for its words to be encoded one by one.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}],
}


def separable(path: str) -> bool:
    """Whether the tokenizer file is of the kind whose words are encoded one by one."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    plain = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) and not re.search(r"\s", t["content"]) for t in said.get("added_tokens") or [])
    model = said["model"]
    plain &= model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges"))
    return plain and said["normalizer"] == NORMALIZER and said["pre_tokenizer"] == PRE_TOKENIZER and not said.get("truncation")


class WordCodec:
    """The word-end BPE file of the tokenizers library, each distinct word encoded once per task.

    Any other tokenizer file is read too; whole texts then go to the library.

    White space never belongs to a token and each step of the normaliser works character by character
    (composition never reaches over ASCII white space), so the ids of a text are those of its pieces
    between white space.  In Latin-1, where the normaliser only lower-cases, the pre-tokenizer's own pieces
    are looked up instead, which repeat more often, and a new one goes to the merges alone.

    With ``special``, the file's added tokens are matched in the raw text, as the library does by default: they
    hold no white space, so the library alone encodes the pieces that hold one.  Else they are text as any other.
    """

    #: The file's pre-tokenizer for Latin-1: letters, one number, or a run of anything else.
    word = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^\t-\r \x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
    chunk = re.compile(r"[^\t-\r ]+")

    def __init__(self, path: str, special: bool = False):
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.encode_special_tokens = not special
        self.whole = None if separable(path) else model
        added = [re.escape(t.content) for t in model.get_added_tokens_decoder().values()] if special else []
        self.added = re.compile("|".join(added) or r"(?!)")
        whole, merges, byte_char = model.encode, model.model.tokenize, byte_characters()

        def encode(x: str) -> bytes:
            if not _latin(x) or self.added.search(x):
                ids = whole(x, add_special_tokens=False).ids
            else:
                pieces = self.word.findall(x.lower())
                if pieces != [x]:
                    return b"".join(map(self.words.__getitem__, pieces))
                if not (x.isascii() and x.isprintable()):
                    x = x.encode().decode("latin-1").translate(byte_char)
                ids = [t.id for t in merges(x)]
            return struct.pack(f"<{len(ids)}I", *ids)

        self.words = _Ids(encode)

    def encode(self, text: str) -> bytes:
        if self.whole is not None:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if not _latin(text) or self.added.search(text):
            return b"".join(map(self.words.__getitem__, self.chunk.findall(text)))
        return b"".join(map(self.words.__getitem__, self.word.findall(text.lower())))


def tokenised_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """id, piece, start, length, ids_crc32: a document's ids and the end id, cut only where longer."""

    def run(batches):
        codec, last, width = WordCodec(tokenizer, special=True), np.array([end], dtype="<u4").tobytes(), 4 * capacity
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(as_text(batch.column("text"))):
                ids = codec.encode(text) + last
                for k, begin in enumerate(range(0, len(ids), width)):
                    part = ids[begin : begin + width]
                    at.append(i)
                    piece.append(k)
                    start.append(begin // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["id", "piece", "start", "length", "ids_crc32"],
            )

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(sliced(run), "id long, piece int, start long, length long, ids_crc32 long").withColumnRenamed("id", id_col)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Where pieces of each length go: rows (length, rank, sequence, each, offset), ordered.

    Pieces of a length with ranks from ``rank`` on, up to the next row's, go ``each`` to a sequence, the
    first of them at ``offset``, into sequences numbered from ``sequence``.

    Lengths over a third of the capacity fit two to a bin at most: from the longest down, each takes the
    longest partner that fits.  The others follow from the longest down, each into the smallest gap that
    takes it, and open a bin where none does.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    used, rows, bins = dict.fromkeys(left, 0), [], 0
    gaps: dict[int, list[list[int]]] = {}  # gap -> [first bin, bins] of equal fill
    sizes: list[int] = []  # the gaps there are, ascending

    def put(length: int, first: int, count: int, each: int, offset: int, items: int) -> None:
        rows.append((length, used[length], first, each, offset))
        used[length] += items
        left[length] -= items

    def free(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append([first, count])

    large = sorted(n for n in left if 3 * n > capacity)
    for a in reversed(large):
        at = bisect_left(large, capacity - a + 1) - 1
        while left[a] and at >= 0:
            b = min(large[at], a)
            at = bisect_left(large, b)
            if left[b] and (b < a or left[a] > 1):
                pairs = min(left[a], left[b]) if b < a else left[a] // 2
                if b < a:
                    put(a, bins, pairs, 1, 0, pairs)
                    put(b, bins, pairs, 1, a, pairs)
                else:
                    put(a, bins, pairs, 2, 0, 2 * pairs)
                free(capacity - a - b, bins, pairs)
                bins += pairs
            at -= 1
        if left[a]:
            count = left[a]
            put(a, bins, count, 1, 0, count)
            free(capacity - a, bins, count)
            bins += count
    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s] and (at := bisect_left(sizes, s)) < len(sizes):
            gap = sizes[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            each = min(gap // s, left[s])
            full = min(count, left[s] // each)
            put(s, first, full, each, capacity - gap, full * each)
            free(gap - each * s, first, full)
            free(gap, first + full, count - full)
        if left[s]:
            each = capacity // s
            full, rest = divmod(left[s], each)
            if full:
                put(s, bins, full, each, 0, full * each)
                free(capacity - each * s, bins, full)
                bins += full
            if rest:
                put(s, bins, 1, rest, 0, rest)
                free(capacity - rest * s, bins, 1)
                bins += 1
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "each", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def best_fit_packing(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    spark = docs.sparkSession
    pieces = cut(tokenised_pieces(docs, tokenizer, id_col, text_col, capacity, end), "pieces")
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_packing(histogram, capacity)
    step = sum(histogram.values()) + 1
    shared = spark.sparkContext.broadcast({c: plan[c].to_numpy(dtype=np.int64) for c in plan})
    salts = max(16, step // 50_000)
    ranked = salted_rank(pieces, ["length"], [id_col, "piece", "ids_crc32"], F.pmod(F.xxhash64(id_col, "piece"), F.lit(salts)), "rank")

    def place(batches):
        p = shared.value
        key = p["length"].astype(object) * step + p["rank"] if step > 1 << 50 else p["length"] * step + p["rank"]
        for pdf in batches:
            n, r = pdf["length"].to_numpy(dtype=np.int64), pdf["rank"].to_numpy(dtype=np.int64)
            at = np.searchsorted(key, n * step + r, side="right") - 1
            r = r - p["rank"][at]
            pdf["sequence_id"] = p["sequence"][at] + r // p["each"][at]
            pdf["offset"] = p["offset"][at] + r % p["each"][at] * n
            yield pdf[[id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return ranked.mapInPandas(place, f"{id_col} long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
