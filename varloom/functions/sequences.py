"""Column expressions over DNA strings.  Offsets are 0-based."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Element type of a background list: the 1-based position in the genome, REF and ALT, and the haplotype's allele.
BACKGROUND = "array<struct<pos:bigint,ref:string,alt:string,allele:int>>"


def reverse_complement(seq: Column) -> Column:
    """Letters other than ACGT (either case) and N stay as they are."""
    return F.translate(F.reverse(seq), "ATCGNatcgn", "TAGCNtagcn")


def replace_at(seq: Column, offset: Column, ref: Column, alt: Column) -> Column:
    """``seq`` with ``alt`` for the length of ``ref`` at ``offset``; null where that is out of range."""
    inside = (offset >= 0) & (offset + F.length(ref) <= F.length(seq))
    whole = F.concat(F.substring(seq, 1, offset.cast("int")), alt, F.substring(seq, (offset + F.length(ref) + 1).cast("int"), F.length(seq)))
    return F.when(inside, whole)


def apply_background(seq: Column, start: Column, background: Column) -> Column:
    """Fold carried variants into ``seq``, in order, each moved by the length changes before it.

    A variant is skipped, and moves nothing, where it is out of range or the sequence there isn't its REF.
    """

    def step(acc: Column, v: Column) -> Column:
        at = (v["pos"] - 1 - start + acc["shift"]).cast("int")
        fits = (v["allele"] != 0) & (at >= 0) & (at + F.length(v["ref"]) <= F.length(acc["seq"])) & (F.upper(F.substring(acc["seq"], at + 1, F.length(v["ref"]))) == F.upper(v["ref"]))
        put = F.concat(F.substring(acc["seq"], F.lit(1), at), v["alt"], F.substring(acc["seq"], at + F.length(v["ref"]) + 1, F.length(acc["seq"])))
        grown = acc["shift"] + F.length(v["alt"]) - F.length(v["ref"])
        return F.struct(F.when(fits, put).otherwise(acc["seq"]).alias("seq"), F.when(fits, grown).otherwise(acc["shift"]).alias("shift"))

    first = F.struct(seq.alias("seq"), F.lit(0).cast("bigint").alias("shift"))
    return F.aggregate(background, first, step, lambda acc: acc["seq"])


def center_offset(pos: Column, start: Column, background: Column) -> Column:
    """Where the center variant is in the background sequence: every carried variant before it counts."""
    before = F.filter(background, lambda v: (v["allele"] != 0) & (v["pos"] < pos))
    shift = F.aggregate(before, F.lit(0).cast("bigint"), lambda acc, v: acc + F.length(v["alt"]) - F.length(v["ref"]))
    return pos - 1 - start + shift


def haplotype_pair(wt: Column, at: Column, ref: Column, alt: Column, allele: Column) -> Column:
    """struct(mut, wt, wt_is_alias): the center variant, at offset ``at``, in its haplotype's background, and that
    without it.  ``wt`` and ``at`` are used several times, so they should be columns by then."""
    mut = F.when(allele == 1, replace_at(wt, at, ref, alt))
    return F.struct(F.coalesce(mut, wt).alias("mut"), wt.alias("wt"), mut.isNull().alias("wt_is_alias"))


def restore_wild_type(mut: Column, direction: Column, ref: Column, alt: Column) -> Column:
    """REF back for ALT at the anchor: one base before the end upstream, one after the start downstream."""
    offset = F.when(direction == "upstream", F.length(mut) - F.length(alt) - 1).otherwise(F.lit(1))
    return F.coalesce(replace_at(mut, offset, alt, ref), mut)


def tail_width(allele: Column) -> Column:
    return F.length(allele) + 2


#: Digits of a sequence's hash.
HASHED = 16


def sequence_hash(seq: Column) -> Column:
    return F.substring(F.sha2(seq, 256), 1, HASHED)


def cache_key(seq: Column, width: Column, pooling: str) -> Column:
    return F.concat(sequence_hash(seq), F.lit("_w"), width.cast("string"), F.lit(f"_{pooling}"))


#: Bases of one packed word, and the letters that its digits stand for.
WORD, LETTERS = 32, "ACGT"
PACKED = "struct<bases:int,words:binary,other:array<struct<pos:int,letter:string>>>"


def _letters(seqs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and the number of each text's; none of a null."""
    sizes = pc.fill_null(pc.utf8_length(seqs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    text = "".join(x for x in seqs.to_pylist() if x)
    return np.frombuffer(text.encode("latin-1" if text.isascii() else "utf-32-le"), dtype=np.uint8 if text.isascii() else np.uint32), sizes


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each start, as many as its size."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


_DIGITS = np.full(256, 4, dtype=np.uint8)
_DIGITS[np.frombuffer(LETTERS.encode(), dtype=np.uint8)] = range(4)


def pack_bases(seq: Column) -> Column:
    """``seq`` at two bits a base, in words of 32: struct(bases, words, other).  Letters but A, C, G and T (lower case among
    them) are listed in ``other`` with their places, and packed as A."""

    @F.arrow_udf(PACKED)
    def packed(seqs: pa.Array) -> pa.Array:
        seqs = seqs.cast(pa.string())
        letters, sizes = _letters(seqs)
        digits = _DIGITS[np.minimum(letters, 255)]
        words = -(-sizes // WORD)
        cells = np.zeros(int(words.sum()) * WORD, dtype=np.uint8)
        cells[_places((np.cumsum(words) - words) * WORD, sizes)] = digits & 3
        four = cells.reshape(-1, 4)
        data = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
        odd = np.flatnonzero(digits == 4)
        owner = np.repeat(np.arange(len(sizes)), sizes)[odd]
        listed = pa.StructArray.from_arrays([pa.array(_places(np.zeros(len(sizes), dtype=np.int64), sizes)[odd], pa.int32()), pa.array([chr(x) for x in letters[odd]], pa.string())], ["pos", "letter"])
        other = pa.ListArray.from_arrays(_offsets(np.bincount(owner, minlength=len(sizes))), listed)
        held = pa.Array.from_buffers(pa.binary(), len(sizes), [None, _offsets(words * 8).buffers()[1], pa.py_buffer(data.tobytes())])
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int32()), held, other], ["bases", "words", "other"], mask=seqs.is_null())

    return packed(seq)


def unpack_bases(packed: Column) -> Column:
    """What ``pack_bases`` packed."""

    @F.arrow_udf("string")
    def text(packs: pa.Array) -> pa.Array:
        missing = packs.is_null().to_numpy(zero_copy_only=False)
        bases, held, other = (pc.struct_field(packs, [i]) for i in range(3))
        sizes = pc.fill_null(bases, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(x for x in held.to_pylist() if x), dtype=np.uint8)
        letters = np.frombuffer(LETTERS.encode(), dtype=np.uint8)[np.stack([data >> 6, data >> 4 & 3, data >> 2 & 3, data & 3], axis=1)].ravel()
        starts = np.cumsum(sizes) - sizes
        words = -(-sizes // WORD)
        plain = letters[_places((np.cumsum(words) - words) * WORD, sizes)]
        counts = pc.fill_null(pc.list_value_length(other), 0).to_numpy(zero_copy_only=False)
        if counts.any():
            listed = other.flatten()
            plain = plain.astype(np.uint32)
            plain[np.repeat(starts, counts) + listed.field("pos").to_numpy(zero_copy_only=False)] = [ord(x) for x in listed.field("letter").to_pylist()]
        if plain.dtype == np.uint8 or plain.max(initial=0) < 128:
            valid = pa.array(~missing).buffers()[1] if missing.any() else None
            return pa.Array.from_buffers(pa.string(), len(sizes), [valid, _offsets(sizes).buffers()[1], pa.py_buffer(plain.astype(np.uint8).tobytes())])
        whole = plain.tobytes().decode("utf-32-le")
        return pa.array([None if gone else whole[i : i + n] for i, n, gone in zip(starts.tolist(), sizes.tolist(), missing.tolist(), strict=True)], pa.string())

    return text(packed)


def decode_bases(column: str, kind: str) -> Column:
    """Bases that are kept in one of four forms, by the column's type: text; bytes; numbers of letters; single letters, as
    text or bytes."""
    c = F.col(column)
    if kind == "string":
        return c
    if kind == "binary":
        return F.decode(c, "US-ASCII")
    if kind in ("array<tinyint>", "array<smallint>", "array<int>", "array<bigint>"):
        return F.array_join(F.transform(c, lambda x: F.char(x)), "")
    if kind == "array<string>":
        return F.array_join(c, "")
    if kind == "array<binary>":
        return F.array_join(F.transform(c, lambda x: F.decode(x, "US-ASCII")), "")
    raise ValueError(f"{kind} holds no bases")
