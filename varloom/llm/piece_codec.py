"""SentencePiece encoding through a table of distinct marked words.

In a model whose pieces hold the white-space mark only in front, no piece reaches over the start of a
marked word, so a text's ids are the ids of its marked words one after the other.  Three steps:

1. Blocks of texts (``BLOCK`` characters, or one longer text) are split into marked words.  A block keeps the
   places of its words as numbers of its own, and sends each distinct word once, to the bucket of its hash.
2. A bucket has the words of all blocks: the corpus's table of distinct words, in parts.  The library segments each
   distinct word once, and each block is sent the ids of the words that it asked for.
3. Blocks and ids are joined by block, and ids back to places by number; whole texts are then decoded by the library.

Texts are split twice, for the first step's two outputs, which costs less than writing the places in between.  A
block's name is the hash of its texts, so the two must agree or the run fails.

``PieceCodec`` checks the model for the property; where it does not hold, whole texts are encoded.

Null text counts as empty; an empty text has the begin and end ids only.  Rows that repeat an id are encoded each,
and so are rows with a null id.  An empty table gives an empty result.  Further columns, whatever their names, are not
looked at.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE, as_text, release, released_pair, table

MARK = "▁"
#: Characters of the texts of one block, and bytes of text for which there is one bucket.
BLOCK, BUCKET = 16 << 20, 48 << 20
#: Least number of buckets, and words whose ids are put in place at once.
BUCKETS, PLACES = 16, 1 << 19


class PieceCodec:
    """segment() gives the ids of marked words, encode() those of a text, begin and end ids included."""

    chunk = re.compile(f"[ {MARK}]+[^ {MARK}]*")

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.separable = not any(MARK in x.lstrip(MARK) for x in pieces)
        # The mark must stand for a space as it is, and a text must get one in front.
        self.separable &= self.model.encode("a  b", out_type=str)[0].startswith(MARK) and self.model.encode(" a") != self.model.encode("a") and self.model.encode(f"a{MARK}b") == self.model.encode("a b")
        # A lone mark, at the end of a text, is the piece of that name; the library gives nothing for "".
        self.lone = self.model.encode("a ")[len(self.model.encode("a")) :]
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()

    def words(self, text: str) -> list[str]:
        """The marked words of a text: a text gets a mark in front."""
        return self.chunk.findall(" " + text) if text else []

    def segment(self, words: list[str]) -> list[list[int]]:
        return [ids if len(word) > 1 else self.lone for word, ids in zip(words, self.model.encode([w[1:] for w in words]), strict=True)]

    def encode(self, text: str) -> list[int]:
        body = [i for ids in self.segment(self.words(text)) for i in ids] if self.separable else self.model.encode(text)
        return [self.begin, *body, self.end]

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned 32-bit numbers in a few bytes: of small ones two or one each, of others each byte apart."""
    parts, sizes = [], [len(arrays)]
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 3 if top < 1 << 24 else 4
        sizes += [len(a), width]
        parts.append(a.astype(f"<u{width}").tobytes() if width < 3 else b"".join((a >> np.array(8 * k, dtype=a.dtype)).astype(np.uint8).tobytes() for k in range(width)))
    return zstandard.ZstdCompressor(level=1).compress(struct.pack(f"<{len(sizes)}I", *sizes) + b"".join(parts))


def _unpack(raw: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n = struct.unpack_from("<I", raw)[0]
    sizes, at, out = struct.unpack_from(f"<{2 * n}I", raw, 4), 4 + 8 * n, []
    for count, width in zip(sizes[::2], sizes[1::2], strict=True):
        if width < 3:
            a = np.frombuffer(raw, dtype=f"<u{width}", count=count, offset=at).astype(np.uint32)
        else:
            a = np.zeros(count, dtype=np.uint32)
            for k in range(width):
                a |= np.frombuffer(raw, dtype=np.uint8, count=count, offset=at + k * count).astype(np.uint32) << np.uint32(8 * k)
        out.append(a)
        at += count * width
    return out


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


_BLOCK = "block binary, bucket int, ids binary, known binary, places binary, words binary, lengths binary"
_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]


def _blocks(source: DataFrame, model_file: str, buckets: int, ask: bool) -> DataFrame:
    """With ``ask``, for each block of texts and bucket that it has words for a row (block, bucket, words, lengths); else
    for each block a row (block, ids, known, places).  Words are numbered as they appear; places also says where
    each word stands in the order in which the buckets are asked for them, which is the alphabet's inside a bucket."""
    most = BLOCK

    def row(block: bytes, ids: list, places: list, numbers: dict) -> pa.RecordBatch:
        words = list(numbers)
        bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words), np.int64, len(words))
        order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
        order = order[np.argsort(bucket[order], kind="stable")]
        out: dict[str, list] = {c: [] for c in _NAMES}
        if ask:
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets)) if len(words) else np.zeros(1, dtype=np.int64)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                mine = [words[i] for i in order[a:b]]
                out["bucket"].append(int(bucket[order[a]]))
                out["words"].append(zstandard.ZstdCompressor(level=1).compress("".join(mine).encode()))
                out["lengths"].append(_pack(np.fromiter(map(len, mine), np.uint32, len(mine))))
        else:
            asked = np.empty(len(words), dtype=np.uint32)
            asked[order] = np.arange(len(words))
            out["ids"], out["known"] = [np.array([x or 0 for x in ids], dtype="<i8").tobytes()], [bytes(x is not None for x in ids)]
            out["places"] = [_pack(np.array([len(x) for x in places], dtype=np.uint32), np.concatenate(places), asked)]
        n = max(map(len, out.values()))
        out["block"] = [block] * n
        return pa.RecordBatch.from_arrays([pa.array(out[c] or [None] * n, pa.int32() if c == "bucket" else pa.binary()) for c in _NAMES], _NAMES)

    def run(batches):
        codec = PieceCodec(model_file)
        ids, places, numbers, held, name = [], [], _Numbers(), 0, hashlib.md5(usedforsecurity=False)
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(at, SLICE)
                    for i, text in zip(batch.column("id").to_pylist(), as_text(batch.column("text")), strict=True):
                        if held and held + len(text) > most:
                            yield row(name.digest(), ids, places, numbers)
                            ids, places, numbers, held, name = [], [], _Numbers(), 0, hashlib.md5(usedforsecurity=False)
                        words = codec.words(text)
                        ids.append(i)
                        places.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                        held += len(text) + 1
                        name.update(text.encode())
                        name.update(b"\xff")
            if ids:
                yield row(name.digest(), ids, places, numbers)
        finally:
            release()

    return source.mapInArrow(run, _BLOCK)


def _segmented(asked: DataFrame, model_file: str) -> DataFrame:
    """(block, bucket, counts, pieces): each bucket's distinct words are segmented once, for all blocks that ask."""

    def segment(pdf: pd.DataFrame) -> pd.DataFrame:
        codec, numbers, wanted = PieceCodec(model_file), _Numbers(), []
        for raw, packed in zip(pdf["words"], pdf["lengths"], strict=True):
            text, (lengths,) = zstandard.ZstdDecompressor().decompress(raw).decode(), _unpack(packed)
            ends = np.cumsum(lengths, dtype=np.int64).tolist()
            words = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            wanted.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        flat, counts, every = [], [], list(numbers)
        for begin in range(0, len(every), 1 << 16):
            for ids in codec.segment(every[begin : begin + (1 << 16)]):
                counts.append(len(ids))
                flat += ids
        flat, counts = np.array(flat, dtype=np.uint32), np.array(counts, dtype=np.int64)
        starts = np.cumsum(counts) - counts
        out = [_pack(counts[w], flat[_spans(starts[w], counts[w])]) for w in wanted]
        release()
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "pieces": out})

    return asked.groupBy("bucket").applyInPandas(segment, "block binary, bucket int, pieces binary")


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count, one after the other."""
    ends = np.cumsum(counts, dtype=np.int64)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def _texts(blocks: pd.DataFrame, pieces: pd.DataFrame, begin: int, end: int):
    """(id or None, ids) of each text of a block."""
    # Blocks of the same texts have one name, and ask alike.
    packs = [_unpack(x) for x in pieces.drop_duplicates("bucket").sort_values("bucket")["pieces"]]
    counts = np.concatenate([p[0] for p in packs] or [np.zeros(0, dtype=np.uint32)]).astype(np.int64)
    flat = np.concatenate([p[1] for p in packs] or [np.zeros(0, dtype=np.uint32)])
    starts = np.cumsum(counts) - counts
    for ids, known, raw in zip(blocks["ids"], blocks["known"], blocks["places"], strict=True):
        sizes, places, asked = _unpack(raw)
        if len(asked) != len(counts):
            raise ValueError("the texts were split into other blocks the second time")
        bounds = np.append(0, np.cumsum(sizes, dtype=np.int64))
        at = 0
        while at < len(sizes):
            # Texts of PLACES words together, or one with more.
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PLACES, side="right")) - 1)
            words = asked[places[bounds[at] : bounds[to]]]
            body = flat[_spans(starts[words], counts[words])]
            cuts = np.append(0, np.cumsum(counts[words]))[bounds[at : to + 1] - bounds[at]]
            for k in range(at, to):
                text = np.empty(cuts[k - at + 1] - cuts[k - at] + 2, dtype="<u4")
                text[0], text[1:-1], text[-1] = begin, body[cuts[k - at] : cuts[k - at + 1]], end
                yield int(np.frombuffer(ids, dtype="<i8", count=1, offset=8 * k)[0]) if known[k] else None, text
            at = to


def _encoded(docs: DataFrame, model_file: str, id_col: str, text_col: str, finish: Callable, names: list[str], schema: str) -> DataFrame:
    """A row (id, *finish(ids, decoded text)) for each input row."""
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def frame(found: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(found, columns=["id", *names])
        out["id"] = out["id"].astype("Int64")
        return out

    if not PieceCodec(model_file).separable:

        def whole(batches):
            codec = PieceCodec(model_file)
            for pdf in batches:
                ids = [np.array(codec.encode(t or ""), dtype="<u4") for t in pdf["text"]]
                yield frame([(None if pd.isna(i) else i, *finish(x, codec.decode(x.tolist()))) for i, x in zip(pdf["id"].astype("Int64"), ids, strict=True)])

        return source.mapInPandas(whole, schema).withColumnRenamed("id", id_col)

    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(BUCKETS, size // BUCKET)
    asked = _blocks(source, model_file, buckets, ask=True).select("block", "bucket", "words", "lengths")
    pieces = _segmented(asked, model_file)

    def put_back(blocks: pd.DataFrame, pieces: pd.DataFrame) -> pd.DataFrame:
        codec = PieceCodec(model_file)
        return frame([(i, *finish(ids, codec.decode(ids.tolist()))) for i, ids in _texts(blocks, pieces, codec.begin, codec.end)])

    blocks = _blocks(source, model_file, buckets, ask=False).select("block", "ids", "known", "places")
    found = blocks.groupBy("block").cogroup(pieces.groupBy("block")).applyInPandas(released_pair(put_back), schema)
    return found.withColumnRenamed("id", id_col)


def piece_encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (little-endian unsigned 32-bit), decoded: one row per input row."""
    return _encoded(docs, model_file, id_col, text_col, lambda ids, text: (ids.tobytes(), text), ["ids", "decoded"], "id long, ids binary, decoded string")


def piece_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The digests of piece_encode's columns, taken where the ids are, so that none leave the task."""
    digests = lambda ids, text: (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    return _encoded(docs, model_file, id_col, text_col, digests, ["n_tokens", "ids_sha256", "decoded_sha256"], "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
