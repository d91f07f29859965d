"""Embedding of sequences: each distinct sequence is encoded once, whatever the number of rows that hold it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.functions import sequences as S
from varloom.sources.scratch import written


class Encoder(Protocol):
    """Token vectors of a batch of sequences.  Made anew in each task from its pickled form."""

    name: str
    width: int
    batch: int

    def hidden_states(self, sequences: list[str]) -> list[np.ndarray]: ...


class Tokens(list):
    """Token vectors of sequences that are parts of one array, ``flat``, one after the other: pooled without being put together again."""

    def __init__(self, states: list[np.ndarray], flat: np.ndarray):
        super().__init__(states)
        self.flat = flat

    @classmethod
    def of(cls, states: Sequence[np.ndarray]) -> "Tokens":
        return states if isinstance(states, cls) else cls(list(states), np.concatenate(states))


class ToyEncoder:
    """A deterministic encoder for tests: one token for each base, component j of it the sine of
    byte * (1 + j) / 16 + place / 32."""

    def __init__(self, width: int = 8, name: str = "toy", batch: int = 256, longest: int = 4096):
        self.width, self.name, self.batch, self.longest = width, name, batch, longest

    def hidden_states(self, sequences: list[str]) -> list[np.ndarray]:
        if not hasattr(self, "_codes"):  # sin(a + b) of a byte's angle a and a place's angle b
            angles, places = np.arange(256)[:, None] * (1 + np.arange(self.width)) / 16, np.arange(self.longest)[:, None] / 32
            self._codes, self._places = ([f(x) for f in (np.sin, np.cos)] for x in (angles, places))
            self._rows, self._known = np.full(256, -1), np.zeros((0, self.width))
        raws = [seq[-self.longest :].encode()[-self.longest :] for seq in sequences]  # the variant is at the end
        ends = np.cumsum([len(x) for x in raws])
        codes = np.frombuffer(b"".join(raws), dtype=np.uint8)
        place = _spans(np.zeros(len(raws), dtype=np.int64), np.diff(ends, prepend=0))
        for c in np.flatnonzero(np.bincount(codes, minlength=256) * (self._rows < 0)):  # a byte's tokens at all places, when it is first seen
            made = self._codes[0][c] * self._places[1] + self._codes[1][c] * self._places[0]
            self._rows[c], self._known = len(self._known), np.concatenate([self._known, made])
        flat = np.take(self._known, self._rows[codes] + place, axis=0, mode="clip")
        return Tokens([flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())], flat)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}


POOLING = ("mean", "max", "last_token")


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


#: Tokens of a block: so many are pooled side by side.
BLOCK = 16


def pool_batch(states: Sequence[np.ndarray], owners: np.ndarray, widths: np.ndarray, method: str) -> np.ndarray:
    """A vector for each (owner, width): its state's last ``width`` tokens (all, if negative) pooled; 0 without tokens."""
    if method not in POOLING:
        raise ValueError(f"pooling is mean, max or last_token, not {method}")
    flat = Tokens.of(states).flat
    sizes = np.array([len(x) for x in states], dtype=np.int64)
    ends = np.cumsum(sizes)
    counts = np.where(widths < 0, sizes[owners], np.minimum(widths, sizes[owners]))
    out = np.zeros((len(owners), flat.shape[1]), dtype=np.float64)
    if method == "last_token":
        some = np.flatnonzero(counts)
        out[some] = flat[ends[owners[some]] - 1]
        return out
    flat = np.ascontiguousarray(flat, dtype=np.float64)
    last, long = ends[owners], counts >= 2 * BLOCK
    short = np.flatnonzero((counts > 0) & ~long)
    if len(short):  # few tokens each
        n = counts[short]
        pooled = (np.add if method == "mean" else np.maximum).reduceat(flat[_spans(last[short] - n, n)], np.cumsum(n) - n)
        out[short] = pooled / n[:, None] if method == "mean" else pooled
    many = np.flatnonzero(long)
    spans = zip((last[many] - counts[many]).tolist(), last[many].tolist())
    if not len(many):
        return out
    if method == "mean":
        ones = np.ones(counts.max())
        out[many] = np.array([ones[: b - a] @ flat[a:b] for a, b in spans]) / counts[many][:, None]
    else:  # whole blocks from the first token on, and the last block, which may overlap them
        width = flat.shape[1]
        blocks, tails = np.empty((2, len(many), BLOCK * width))
        for k, (a, b) in enumerate(spans):
            np.maximum.reduce(flat[a : b - (b - a) % BLOCK].reshape(-1, BLOCK * width), axis=0, out=blocks[k])
            tails[k] = flat[b - BLOCK : b].ravel()
        out[many] = np.maximum(blocks, tails).reshape(len(many), BLOCK, width).max(axis=1)
    return out


def _states(encoder: Encoder, sequences: list[str]) -> tuple[list[np.ndarray], list[str | None]]:
    """Token vectors and errors.  Where a batch fails its sequences are tried again by length, as what fails is often a length,
    and those of lengths that fail one by one; those that fail alone have no tokens and the error."""
    try:
        return encoder.hidden_states(sequences), [None] * len(sequences)
    except Exception as error:  # noqa: BLE001 - encoders raise what they like
        if len(sequences) == 1:
            return [np.zeros((0, encoder.width))], [str(error)]
    sizes: dict[int, list[int]] = {}
    for i, seq in enumerate(sequences):
        sizes.setdefault(len(seq), []).append(i)
    parts = list(sizes.values()) if len(sizes) > 1 else [[i] for i in range(len(sequences))]
    states: list = [None] * len(sequences)
    errors: list[str | None] = [None] * len(sequences)
    for part in parts:
        for i, state, error in zip(part, *_states(encoder, [sequences[i] for i in part]), strict=True):
            states[i], errors[i] = state, error
    return states, errors


def _checked(methods: Sequence[str]) -> None:
    for m in methods:
        if m not in POOLING:
            raise ValueError(f"pooling is mean, max or last_token, not {m}")


def _lists(x: np.ndarray, bad: np.ndarray | None) -> pa.ListArray:
    # A null among the offsets would lengthen the list before it: nulls are a mask of their own.
    offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(x.ravel()), mask=pa.array(bad) if bad is not None and bad.any() else None)


_DIGITS = np.char.zfill(np.arange(10_000).astype("S4"), 4).view(np.uint8).reshape(-1, 4)


def vector_texts(x: np.ndarray) -> pa.Array:
    """Each row's cells rounded to four digits (halves away from zero, no negative zero), with commas between."""
    v = np.abs(x.astype(np.float64)) * 1e4
    if not (v < 99_999).all():  # larger cells, and those that are not numbers
        return pa.array([",".join(f"{np.copysign(np.floor(a + 0.5), c) / 1e4 + 0.0:.4f}" if np.isfinite(c) else str(c) for a, c in zip(*r)) for r in zip(v, x)], pa.string())
    r = np.trunc(v)
    r = (r + (v - r >= 0.5)).astype(np.int32)
    cells = np.empty((*x.shape, 8), dtype=np.uint8)
    cells[..., 0], cells[..., 2], cells[..., 7] = ord("-"), ord("."), ord(",")
    cells[..., 1] = r // 10_000 + ord("0")
    cells[..., 3:7] = _DIGITS[r % 10_000]
    kept = np.ones(cells.shape, dtype=bool)
    kept[..., 0] = (x < 0) & (r > 0)
    kept[:, -1:, 7] = False
    offsets = np.concatenate([[0], np.cumsum(kept.sum(axis=(1, 2)))]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(cells[kept].tobytes())])


def _encoded(need: DataFrame, encoder: Encoder, methods: Sequence[str]) -> DataFrame:
    """(key, w, a vector for each method, error) of ``need`` (key binary, seq, widths): w null pools the whole sequence.

    Sequences that fail alone have null vectors and the error.
    """
    _checked(methods)
    names = ["key", "w", *methods, "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, encoder.batch):
                batch = whole.slice(begin, encoder.batch)
                states, errors = _states(encoder, batch.column("seq").to_pylist())
                states = Tokens.of(states)
                lists = batch.column("widths")
                owners = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                widths = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                bad = np.array([x is not None for x in errors])[owners]
                columns = [batch.column("key").take(pa.array(owners)), pa.array(widths, pa.int32(), mask=widths < 0)]
                for m in methods:
                    columns.append(_lists(pool_batch(states, owners, widths, m).astype(np.float32), bad))
                columns.append(pa.array([errors[i] for i in owners], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return need.select("key", "seq", "widths").mapInArrow(run, f"key binary, w int, {', '.join(f'{m} array<float>' for m in methods)}, error string")


def sequence_key(seq: Column | str) -> Column:
    """128 bits that stand for a sequence in joins, so that its letters are shuffled once."""
    return F.unhex(F.md5(F.col(seq) if isinstance(seq, str) else seq))


def _distinct(rows: DataFrame) -> DataFrame:
    """(key, seq, widths): each sequence of ``rows`` (key, seq, w) once."""
    return rows.groupBy("key", "seq").agg(F.collect_set(F.coalesce("w", F.lit(-1))).alias("widths"))


def encode_distinct(wanted: DataFrame, encoder: Encoder, method: str = "mean", cached: DataFrame | None = None, alone: DataFrame | None = None) -> DataFrame:
    """(seq, w, vec, error) for the distinct (seq, w) of ``wanted``; w null pools the whole sequence.

    A sequence that is wanted with several widths goes through the encoder once.  Those of ``alone`` (seq, w) are known to be in one
    row of it and in none of ``wanted``: their letters are not shuffled.
    """
    need = wanted.select("seq", F.col("w").cast("int").alias("w")).filter("seq is not null")
    if cached is not None:
        known = cached.select(F.col("seq").alias("_s"), F.col("w").alias("_w"))
        need = need.join(known, (F.col("seq") == F.col("_s")) & F.col("w").eqNullSafe(F.col("_w")), "left_anti")
    # The key is the sequence itself: this form returns it.
    grouped = need.groupBy("seq").agg(F.collect_set(F.coalesce("w", F.lit(-1))).alias("widths")).withColumn("key", F.encode("seq", "UTF-8"))
    if alone is not None:
        if cached is not None:
            raise ValueError("sequences that are alone are not looked up")
        lone = alone.filter("seq is not null").select("seq", F.array(F.coalesce(F.col("w").cast("int"), F.lit(-1))).alias("widths"), F.encode("seq", "UTF-8").alias("key"))
        grouped = grouped.unionByName(lone)
    fresh = _encoded(grouped, encoder, [method]).select(F.decode("key", "UTF-8").alias("seq"), "w", F.col(method).alias("vec"), "error")
    return fresh if cached is None else fresh.unionByName(cached.select("seq", "w", "vec", F.lit(None).cast("string").alias("error")))


def slot_lists(rows: DataFrame) -> DataFrame:
    """(sample_id, variant_id, direction, x): the six slots of an interval, a list of (key, seq, w, back); back where the sequence
    is to be read reversed, which is downstream."""
    kinds = [(k, h, p) for h, p in (("hap1", "hap1"), ("hap2", "hap2"), ("reference", "ref")) for k in ("mut", "wt")]
    slot = lambda k, h, p: F.struct(F.lit(f"{'Mut' if k == 'mut' else 'WT'}_{p}").alias("key"), F.col(f"{h}.{k}").alias("seq"), S.tail_width(F.col("alt" if k == "mut" else "ref")).cast("int").alias("w"), (F.col("direction") == "downstream").alias("back"))
    return rows.select("sample_id", F.concat_ws("_", "chrom", "pos", "ref", "alt").alias("variant_id"), "direction", F.array(*[slot(*x) for x in kinds]).alias("x"))


def slots(rows: DataFrame) -> DataFrame:
    """The twelve slots of a variant: (sample_id, variant_id, key, direction, seq, w), downstream reversed."""
    out = slot_lists(rows).select("sample_id", "variant_id", "direction", F.explode("x").alias("x")).select("sample_id", "variant_id", "direction", "x.key", "x.seq", "x.w")
    return out.withColumn("seq", F.when(F.col("direction") == "downstream", S.reverse_complement("seq")).otherwise(F.col("seq")))


#: Letters and their complements, as ``functions.sequences.reverse_complement`` has them, by byte.
_OTHER = np.arange(256, dtype=np.uint8)
_OTHER[np.frombuffer(b"ATCGNatcgn", dtype=np.uint8)] = np.frombuffer(b"TAGCNtagcn", dtype=np.uint8)


def _complemented(seqs: pa.Array) -> pa.Array:
    """The reverse complement of each text."""
    turned = pc.utf8_reverse(seqs)
    valid, offsets, letters = turned.buffers()
    if letters is None:
        return turned
    return pa.Array.from_buffers(turned.type, len(turned), [valid, offsets, pa.py_buffer(_OTHER[np.frombuffer(letters, dtype=np.uint8)])], turned.null_count, turned.offset)


def encoded_in_tasks(rows: DataFrame, encoders: Sequence[Encoder], methods: Sequence[str], tails: bool = True, as_text: bool = False) -> DataFrame:
    """``rows`` with their ``x`` (a list of structs with key, seq, w, back) as a list of (key, w, {method}_{number of the encoder},
    ..., error_{number}); without ``tails`` whole sequences are pooled.  ``as_text``: each distinct vector is made text once
    (``vector_texts``), instead of a list of floats.

    Each distinct sequence of a batch is encoded once, where it is made: no letters are shuffled.  For encoders that cost less
    than that shuffle; most equal sequences are a variant's own (a wild type that is its mutant's alias) or a batch's.
    """
    _checked(methods)
    if not methods or not encoders:
        raise ValueError("at least one encoder and one method")
    others, fields = [c for c in rows.columns if c != "x"], _fields(len(encoders), methods, as_text)
    schema = T.StructType([rows.schema[c] for c in others] + T._parse_datatype_string(f"x array<struct<{', '.join(f.replace(' ', ':', 1) for f in fields)}>>").fields)
    return rows.select(*others, "x").mapInArrow(_encoding(others, encoders, methods, tails, as_text), schema)


def _fields(encoders: int, methods: Sequence[str], as_text: bool) -> list[str]:
    return ["key string", "w int", *[f"{m}_{i} {'string' if as_text else 'array<float>'}" for i in range(encoders) for m in methods], *[f"error_{i} string" for i in range(encoders)]]


def _encoding(others: list[str], encoders: Sequence[Encoder], methods: Sequence[str], tails: bool, as_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What ``encoded_in_tasks`` does with batches of ``others`` and x."""
    fields = _fields(len(encoders), methods, as_text)

    def found(encoder: Encoder, texts: list[str], owners: np.ndarray, widths: np.ndarray) -> tuple[list[np.ndarray], list[str | None]]:
        vectors, errors = [np.zeros((len(owners), encoder.width), dtype=np.float32) for _ in methods], []
        for begin in range(0, len(texts), encoder.batch):
            states, wrong = _states(encoder, texts[begin : begin + encoder.batch])
            states, errors = Tokens.of(states), errors + wrong
            i, j = np.searchsorted(owners, [begin, begin + encoder.batch])
            for k, m in enumerate(methods):
                vectors[k][i:j] = pool_batch(states, owners[i:j] - begin, widths[i:j], m)
        return vectors, errors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            flat = x.flatten()
            back, seqs = pc.fill_null(flat.field("back"), False), flat.field("seq")
            coded = pc.if_else(back, _complemented(seqs), seqs).dictionary_encode()
            index = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            w = pc.fill_null(flat.field("w"), -1).to_numpy(zero_copy_only=False).astype(np.int64) if tails else np.full(len(flat), -1)
            pairs, place = np.unique((index << 32) + w + 1, return_inverse=True)
            none = int(np.searchsorted(pairs >> 32, 0))  # pairs without a sequence come first
            owners, widths = pairs[none:] >> 32, (pairs[none:] & 0xFFFFFFFF) - 1
            place, missing = np.maximum(place - none, 0), index < 0
            columns, wrong = [flat.field("key"), pa.array(w, pa.int32(), mask=w < 0)], []
            for encoder in encoders:
                vectors, errors = found(encoder, coded.dictionary.to_pylist(), owners, widths)
                failed = np.array([e is not None for e in errors], dtype=bool)
                bad = missing | failed[index] if len(failed) else missing
                if as_text:
                    texts = [vector_texts(v).take(pa.array(place)) if len(v) else pa.nulls(len(flat), pa.string()) for v in vectors]
                    columns += [pc.if_else(pa.array(bad), pa.scalar(None, pa.string()), t) for t in texts] if bad.any() else texts
                else:
                    columns += [_lists(v[place] if len(v) else np.zeros((len(flat), encoder.width), dtype=np.float32), bad) for v in vectors]
                wrong.append(pa.array([errors[i] if i >= 0 else None for i in index.tolist()] if failed.any() else [None] * len(flat), pa.string()))
            made = pa.StructArray.from_arrays([*columns, *wrong], [f.split()[0] for f in fields])
            offsets = np.concatenate([[0], np.cumsum(pc.fill_null(x.value_lengths(), 0).to_numpy(zero_copy_only=False))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), made, mask=x.is_null() if x.null_count else None)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], lists], [*others, "x"])

    return run


def distinct_in_tasks(rows: DataFrame) -> DataFrame:
    """(seq, w, n) of the ``x`` of ``rows`` (a list of structs with seq, w, back): each pair of a batch once, with how many there are.

    Not distinct as a whole yet: what follows meets fewer letters.  Slots without a sequence are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("x").flatten()
            back, seqs = pc.fill_null(flat.field("back"), False), flat.field("seq")
            each = pa.table([pc.if_else(back, _complemented(seqs), seqs), flat.field("w")], names=["seq", "w"])
            found = each.filter(pc.is_valid(each.column("seq"))).group_by(["seq", "w"]).aggregate([([], "count_all")])
            yield from found.select(["seq", "w", "count_all"]).rename_columns(["seq", "w", "n"]).combine_chunks().to_batches()

    return rows.select("x").mapInArrow(run, "seq string, w int, n long")


#: Bytes of the SHA-256 that stand for a sequence where its letters are not needed.
DIGEST = 16


def digests_in_tasks(rows: DataFrame) -> DataFrame:
    """(seq, w, n) as ``distinct_in_tasks`` has them, with the first bytes of a sequence's SHA-256 for the sequence: no letters leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("x").flatten()
            back, seqs = pc.fill_null(flat.field("back"), False), flat.field("seq")
            coded = pc.if_else(back, _complemented(seqs), seqs).dictionary_encode()
            each = pa.table([coded.indices, flat.field("w")], names=["i", "w"])
            found = each.filter(pc.is_valid(each.column("i"))).group_by(["i", "w"]).aggregate([([], "count_all")]).combine_chunks()
            digests = pa.array([hashlib.sha256(s).digest()[:DIGEST] for s in coded.dictionary.cast(pa.binary()).to_pylist()], pa.binary())
            seq = digests.take(found.column("i").combine_chunks()) if found.num_rows else pa.array([], pa.binary())
            yield from pa.table([seq, found.column("w"), found.column("count_all")], names=["seq", "w", "n"]).combine_chunks().to_batches()

    return rows.select("x").mapInArrow(run, "seq binary, w int, n long")


#: Bits of a bitmap of hashes: so many for each, as far as they go.
BITS, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28


def apart(rows: DataFrame, *by: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose columns ``by`` no other row has, and the others; some of the first may be among the second.

    Hashes that several rows have are marked in a bitmap of 32 MiB at most, which is broadcast; a fuller one, or two values with one hash,
    only lets more rows through to the others.  ``rows`` are read three times.
    """
    h = F.xxhash64(*by)
    several = written(rows.groupBy(h.alias("h")).agg(F.count("*").alias("n")).filter("n > 1").select("h"), "several")
    bits, wanted = LEAST_BITS, BITS * several.count()
    while bits < min(MOST_BITS, wanted):
        bits *= 2
    word = F.shiftright(F.col("h").bitwiseAND(bits - 1), 6)
    words = several.groupBy(word.alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("b")).toArrow()
    marks = np.zeros(bits // 64, dtype=np.int64)
    marks[words.column("i").to_numpy()] = words.column("b").to_numpy()
    held = rows.sparkSession.sparkContext.broadcast(marks)

    @F.arrow_udf("boolean")
    def alone(hashes: pa.Array) -> pa.Array:
        at = hashes.to_numpy(zero_copy_only=False) & (bits - 1)
        return pa.array((held.value[at >> 6] >> (at & 63)) & 1 == 0)

    return rows.filter(alone(h)), rows.filter(~alone(h))


def keys_in_tasks(rows: DataFrame, pooling: str) -> DataFrame:
    """(sample_id, variant_id, direction, slot, key) of the twelve slots of a variant: ``slots`` with the cache key of each sequence.

    Each distinct sequence of a batch is hashed once, where it is made; no letters leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            flat = x.flatten()
            owner = pa.array(np.repeat(np.arange(len(x)), pc.fill_null(x.value_lengths(), 0).to_numpy(zero_copy_only=False)))
            back, seqs = pc.fill_null(flat.field("back"), False), flat.field("seq")
            coded = pc.if_else(back, _complemented(seqs), seqs).dictionary_encode()
            hashes = pa.array([hashlib.sha256(s).hexdigest()[: S.HASHED] for s in coded.dictionary.cast(pa.binary()).to_pylist()], pa.string())
            key = pc.binary_join_element_wise(hashes.take(coded.indices), "_w", flat.field("w").cast(pa.string()), f"_{pooling}", "")
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(owner) for c in others], flat.field("key"), key], [*others, "slot", "key"])

    lists = slot_lists(rows)
    others = ["sample_id", "variant_id", "direction"]
    schema = T.StructType([*[lists.schema[c] for c in others], T.StructField("slot", T.StringType()), T.StructField("key", T.StringType())])
    return lists.mapInArrow(run, schema)


def embed_in_tasks(rows: DataFrame, encoder: Encoder, method: str = "mean", as_text: bool = False) -> DataFrame:
    """``embed_variants`` by ``encoded_in_tasks``: only vectors (``as_text``, their texts) are shuffled, six of a direction in a row."""
    made = encoded_in_tasks(slot_lists(rows), [encoder], [method], as_text=as_text)
    made = made.withColumn("x", F.transform("x", lambda x: F.struct(x["key"].alias("key"), x[f"{method}_0"].alias(f"{method}_0"))))
    side = lambda d: F.first(F.when(F.col("direction") == d, F.col("x")), ignorenulls=True)
    pair = made.groupBy("sample_id", "variant_id").agg(side("upstream").alias("up"), side("downstream").alias("down"))
    both = pair.select("sample_id", "variant_id", F.explode(F.arrays_zip("up", "down")).alias("x"))
    parts = [F.col(f"x.{d}.{method}_0") for d in ("up", "down")]
    out = both.select("sample_id", "variant_id", F.lit(encoder.name).alias("model"), F.col("x.up.key").alias("key"), (F.concat(parts[0], F.lit(","), parts[1]) if as_text else F.concat(*parts)).alias("vec"))
    return out.filter("vec is not null")


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that hold both directions of each variant, upstream first; fails where they are not neighbours."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        whole = rows.num_rows - rows.num_rows % 2
        held = rows.slice(whole).to_batches()[0] if whole < rows.num_rows else None
        if whole:
            up, down = (rows.take(pa.array(np.arange(k, whole, 2))) for k in (0, 1))
            same = [pc.all(pc.equal(up.column(c), down.column(c))).as_py() for c in ("sample_id", "variant_id")]
            if not all([*same, pc.all(pc.equal(up.column("direction"), "upstream")).as_py(), pc.all(pc.equal(down.column("direction"), "downstream")).as_py()]):
                raise ValueError("the two directions of a variant are not neighbours")
            yield rows.slice(0, whole).combine_chunks().to_batches()[0]
    if held is not None:
        raise ValueError("the two directions of a variant are not neighbours")


def embed_neighbours(rows: DataFrame, encoder: Encoder, method: str = "mean") -> DataFrame:
    """``embed_in_tasks`` with texts, where both directions of each variant are neighbours, as ``folded_intervals`` gives them: nothing is shuffled."""
    _checked([method])
    lists = slot_lists(rows)
    others = ["sample_id", "variant_id", "direction"]
    encode = _encoding(others, [encoder], [method], True, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in encode(neighbours(batches)):
            up, down = (made.take(pa.array(np.arange(k, made.num_rows, 2))) for k in (0, 1))
            x, y = up.column("x").flatten(), down.column("x").flatten()
            owner = pa.array(np.repeat(np.arange(up.num_rows), up.column("x").value_lengths().to_numpy(zero_copy_only=False)))
            vec = pc.binary_join_element_wise(x.field(f"{method}_0"), y.field(f"{method}_0"), ",")
            out = pa.RecordBatch.from_arrays([*[up.column(c).take(owner) for c in others[:2]], x.field("key"), vec], ["sample_id", "variant_id", "key", "vec"])
            yield out.filter(pc.is_valid(vec))

    schema = T.StructType([lists.schema["sample_id"], lists.schema["variant_id"], T.StructField("key", T.StringType()), T.StructField("vec", T.StringType())])
    return lists.mapInArrow(run, schema).select("sample_id", "variant_id", F.lit(encoder.name).alias("model"), "key", "vec")


#: A key is hot if more than one in so many slots holds it, so there are fewer hot keys than this.
HOT = 1000


def with_vectors(slots: DataFrame, vectors: DataFrame, by: Sequence[str]) -> DataFrame:
    """``slots`` with the other columns of ``vectors``, whose rows are known by the columns ``by``; both are read more than once.

    The vectors of hot keys are broadcast, HOT at most, so that no task gets all the slots of one (the reference window
    of a common variant is one key for all its samples); the others are shuffled.
    """
    counts = slots.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") * HOT > slots.count())
    hot = F.broadcast(counts.drop("_n"))
    few = F.broadcast(vectors.join(hot, list(by), "left_semi"))
    return slots.join(few, list(by)).unionByName(slots.join(hot, list(by), "left_anti").join(vectors, list(by)))


def encoded_once(slots: DataFrame, encoder: Encoder, methods: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """(hash, w, methods, error) for the (hash, seq, w) of ``slots``, written; w -1 pools the whole sequence.

    Fails if two sequences have one hash.  Of ``known`` (hash, w, methods) nothing is encoded again.
    """
    need = slots.select(F.col("hash").alias("key"), "seq", "w")
    if known is not None:
        need = need.join(known.select(F.col("hash").alias("key"), "w"), ["key", "w"], "left_anti")
    made = _encoded(_distinct(need), encoder, methods).select(F.col("key").alias("hash"), F.coalesce("w", F.lit(-1)).alias("w"), *methods, "error")
    out = written(made, "vectors")
    if not out.groupBy("hash", "w").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        raise ValueError("two sequences have one hash")
    return out if known is None else out.unionByName(known.select("hash", "w", *methods, F.lit(None).cast("string").alias("error")))


def embed_variants(rows: DataFrame, encoder: Encoder, method: str = "mean", cached: DataFrame | None = None) -> DataFrame:
    """(sample_id, variant_id, model, key, vec): up- and downstream vectors one after the other.

    Slots are written once, with a 128-bit hash of their sequence, so that sequences are built once; letters are shuffled
    once more, to meet equal ones, and vectors are joined back by hash and width.
    """
    kept = written(slots(rows).filter("seq is not null").select("sample_id", "variant_id", "direction", "key", "seq", F.col("w").cast("int").alias("w"), sequence_key("seq").alias("hash")), "slots")
    known = None
    if cached is not None:
        known = cached.select(sequence_key("seq").alias("hash"), F.coalesce(F.col("w").cast("int"), F.lit(-1)).alias("w"), F.col("vec").alias(method))
    vectors = encoded_once(kept, encoder, [method], known).select("hash", "w", F.col(method).alias("vec"))
    joined = with_vectors(kept.drop("seq"), vectors, ["hash", "w"])
    side = lambda d: F.first(F.when(F.col("direction") == d, F.col("vec")), ignorenulls=True)
    pair = joined.groupBy("sample_id", "variant_id", "key").agg(side("upstream").alias("up"), side("downstream").alias("down"))
    return pair.select("sample_id", "variant_id", F.lit(encoder.name).alias("model"), "key", F.concat("up", "down").alias("vec")).filter("vec is not null")


def bulk_embed(keyed: DataFrame, encoder: Encoder, methods: list[str]) -> DataFrame:
    """(key, vectors): a map from method to vector for each keyed sequence; all methods of one encoding."""
    return multi_model(keyed, [encoder], methods).drop("model")


def multi_model(keyed: DataFrame, encoders: list[Encoder], methods: list[str]) -> DataFrame:
    """(key, vectors, model): the same for each of several encoders; the sequences are built and written once."""
    if not methods or not encoders:
        raise ValueError("at least one encoder and one method")
    kept = written(keyed.filter("seq is not null").select("key", "seq", F.lit(-1).alias("w"), sequence_key("seq").alias("hash")), "sequences")
    vectors = lambda e: encoded_once(kept, e, methods).select("hash", "w", F.create_map(*[x for m in methods for x in (F.lit(m), F.col(m))]).alias("vectors"))
    parts = [with_vectors(kept.drop("seq"), vectors(e), ["hash", "w"]).select("key", "vectors", F.lit(e.name).alias("model")) for e in encoders]
    return reduce(DataFrame.unionByName, parts)


def cache_report(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """keys, hits (keys that were cached before), new_sequences (others, once each) and the size of the cache after.

    A column ``n`` of ``wanted`` says for how many keys a row stands.  With a column ``method`` on both sides, a key's methods count one by one: it is a hit if each was cached.
    Sequences may be digests on both sides.  Without methods both sides meet in one shuffle.
    """
    if "method" not in wanted.columns:
        n = F.col("n").cast("long") if "n" in wanted.columns else F.lit(1).cast("long")
        both = wanted.select("seq", n.alias("n"), F.lit(False).alias("known")).unionByName(cached.select("seq", F.lit(None).cast("long").alias("n"), F.lit(True).alias("known")))
        each = both.groupBy("seq").agg(F.sum("n").alias("n"), F.bool_or("known").alias("known"))
        hit = F.col("known") & F.col("seq").isNotNull()
        zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
        return each.agg(zero(F.sum("n")).alias("keys"), zero(F.sum(F.when(hit, F.col("n")))).alias("hits"), F.count(F.when(~hit & F.col("n").isNotNull() & F.col("seq").isNotNull(), 1)).alias("new_sequences"), F.count("*").alias("size"))
    by = ["seq", "method"]
    known = cached.select(*by).distinct().withColumn("hit", F.lit(True))
    asked = wanted.join(known, by, "left").groupBy("key", "seq").agg(F.bool_and(F.coalesce("hit", F.lit(False))).alias("hit")).withColumn("hit", F.when(F.col("hit"), True))
    report = asked.agg(F.count("*").alias("keys"), F.count("hit").alias("hits"), F.count_distinct(F.when(F.col("hit").isNull(), F.col("seq"))).alias("new_sequences"))
    size = cached.select("seq").unionByName(wanted.select("seq")).distinct().agg(F.count("*").alias("size"))
    return report.crossJoin(F.broadcast(size))  # one row each
