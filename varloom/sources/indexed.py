"""Genotypes of regions out of a block-compressed, indexed file: only the blocks that may hold them are read.

The file is BGZF (gzip members of 64 KiB at most), its index (.tbi) has bins of six sizes, each with the stretches of
the file where its records are.  ``read_indexed_vcf`` is a data source for such files; the index is read once, on the
driver, the stretches by the tasks.  Paths may have any scheme that Arrow's file systems know.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

GENOTYPES = "sample_id string, chrom string, pos long, ref string, alt string, gt string"
#: Fixed values of the index format: bases of a smallest bin as a power of two, and levels of bins above it.
MIN_SHIFT, DEPTH = 14, 5
#: Compressed bytes that a task reads, about, unless one stretch is longer; rows of a batch.
TASK, BATCH = 16 << 20, 8192
#: The header is in the first so many bytes, or in twice, four times, ... as many.
HEAD = 1 << 20
WHOLE = 1 << (MIN_SHIFT + 3 * DEPTH)

Span = tuple[int, int]


def open_at(path: str) -> pa.NativeFile:
    system, name = pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)
    return system.open_input_file(name)


def blocks(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the whole blocks that ``raw`` begins with."""
    at = 0
    while at + 18 <= len(raw):
        if raw[at : at + 4] != b"\x1f\x8b\x08\x04":
            raise ValueError(f"no block of a block-compressed file at {at}")
        (extra,) = struct.unpack_from("<H", raw, at + 10)
        field, size = at + 12, None
        while field < at + 12 + extra:
            tag, (length,) = raw[field : field + 2], struct.unpack_from("<H", raw, field + 2)
            if tag == b"BC" and length == 2:
                size = struct.unpack_from("<H", raw, field + 4)[0] + 1
            field += 4 + length
        if size is None:
            raise ValueError(f"the block at {at} does not say its size")
        if at + size > len(raw):
            return
        yield at, zlib.decompress(raw[at + 12 + extra : at + size - 8], wbits=-15)
        at += size


def bins_of(begin: int, end: int) -> list[range]:
    """The bins, level by level, that may hold records of bases begin to end (0-based, half open)."""
    out, first = [], 0
    for level in range(DEPTH + 1):
        shift = MIN_SHIFT + 3 * (DEPTH - level)
        out.append(range(first + (begin >> shift), first + (end - 1 >> shift) + 1))
        first = (first << 3) + 1
    return out


def merged(spans: Sequence[Span]) -> list[Span]:
    """The same places as sorted spans that neither overlap nor touch."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


class Index:
    """Bins and linear index of each contig; places in the file are a block's offset << 16 | a place in its content."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"TBI\x01":
            raise ValueError("not a tabix index")
        contigs, _, _, _, _, _, _, names = struct.unpack_from("<8i", raw, 4)
        self.names = raw[36 : 36 + names].rstrip(b"\0").decode().split("\0") if names else []
        at = 36 + names
        self.bins: dict[str, dict[int, list[Span]]] = {}
        self.linear: dict[str, tuple[int, ...]] = {}
        for name in self.names[:contigs]:
            (count,), at, bins = struct.unpack_from("<i", raw, at), at + 4, {}
            for _ in range(count):
                number, chunks = struct.unpack_from("<Ii", raw, at)
                places = struct.unpack_from(f"<{2 * chunks}Q", raw, at + 8)
                at += 8 + 16 * chunks
                if number < ((1 << 3 * (DEPTH + 1)) - 1) // 7:  # the last one holds counts
                    bins[number] = list(zip(places[::2], places[1::2], strict=True))
            (count,) = struct.unpack_from("<i", raw, at)
            self.bins[name], self.linear[name] = bins, struct.unpack_from(f"<{count}Q", raw, at + 4)
            at += 4 + 8 * count

    @classmethod
    def read(cls, path: str) -> Index:
        with open_at(path) as f:
            return cls(b"".join(content for _, content in blocks(f.read())))

    def stretches(self, contig: str, spans: Sequence[Span]) -> list[Span]:
        """Where the file may have records of the spans: disjoint, in order."""
        bins, linear, found = self.bins.get(contig, {}), self.linear.get(contig, ()), []
        numbers = sorted(bins)
        for begin, end in spans:
            least = linear[min(begin >> MIN_SHIFT, len(linear) - 1)] if linear else 0
            for level in bins_of(begin, end):
                for number in numbers[bisect_left(numbers, level.start) : bisect_left(numbers, level.stop)]:
                    found += [(max(a, least), b) for a, b in bins[number] if b > least]
        return merged(found)


@dataclass
class Stretches(InputPartition):
    """What a task reads: stretches of the file, and which samples and places of it."""

    places: list[Span]
    spans: dict[str, list[Span]] | None
    columns: list[tuple[int, str]]


class VcfReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.index = options.get("index", f"{self.path}.tbi")
        #: Spans of contigs (0-based, half open) and samples that are wanted; all without the option.
        self.regions: dict[str, list[Span]] | None = {k: merged([tuple(x) for x in v]) for k, v in json.loads(options["regions"]).items()} if "regions" in options else None
        self.samples: set[str] | None = set(json.loads(options["samples"])) if "samples" in options else None

    def header(self) -> list[str]:
        size = HEAD
        with open_at(self.path) as f:
            while True:
                raw = f.read_at(min(size, f.size()), 0)
                text = b"".join(content for _, content in blocks(raw)).decode()
                for line in text.split("\n")[:-1]:
                    if line.startswith("#CHROM"):
                        return line.split("\t")[9:]
                    if not line.startswith("#"):
                        raise ValueError(f"{self.path} has no #CHROM line")
                if size >= f.size():
                    raise ValueError(f"{self.path} has no #CHROM line")
                size *= 2

    def partitions(self) -> Sequence[InputPartition]:
        index = Index.read(self.index)
        columns = [(i, s) for i, s in enumerate(self.header()) if self.samples is None or s in self.samples]
        spans = {name: [(0, WHOLE)] if self.regions is None else self.regions.get(name, []) for name in index.names}
        places = merged([x for name, each in spans.items() for x in index.stretches(name, each)])
        parts: list[list[Span]] = []
        size = TASK
        for a, b in places:
            for piece in self._pieces(a, b, index):
                length = (piece[1] >> 16) - (piece[0] >> 16) + 1
                if size + length > TASK:
                    parts.append([])
                    size = 0
                parts[-1].append(piece)
                size += length
        limits = None if self.regions is None else spans
        return [Stretches(p, limits, columns) for p in parts] if columns else []

    @staticmethod
    def _pieces(a: int, b: int, index: Index) -> Iterator[Span]:
        """A long stretch cut where the index knows that a record begins."""
        if (b >> 16) - (a >> 16) <= TASK:
            yield a, b
            return
        begin = a
        for cut in sorted({x for each in index.linear.values() for x in each if a < x < b}):
            if (cut >> 16) - (begin >> 16) >= TASK:
                yield begin, cut
                begin = cut
        yield begin, b

    def lines(self, places: Sequence[Span]) -> Iterator[bytes]:
        """The records of the stretches; a stretch begins and ends where a record does."""
        with open_at(self.path) as f:
            size = f.size()
            for a, b in places:
                at, rest, first = a >> 16, b"", a & 0xFFFF
                last, inside = b >> 16, b & 0xFFFF
                while at < last or at == last and inside:
                    # To the end of the last block, which is 64 KiB long at most.
                    raw = f.read_at(min(size, last + (1 << 16), at + (4 << 20)) - at, at)
                    moved = 0
                    for offset, content in blocks(raw):
                        here = at + offset
                        if here > last or here == last and not inside:
                            break
                        end = inside if here == last else len(content)
                        *whole, rest = (rest + content[first:end]).split(b"\n")
                        yield from whole
                        first, moved = 0, offset + 1
                    if not moved:
                        break
                    at += self._length(raw, moved - 1) + moved - 1
                if rest:
                    yield rest

    @staticmethod
    def _length(raw: bytes, offset: int) -> int:
        """Bytes of the block at ``offset``."""
        (extra,) = struct.unpack_from("<H", raw, offset + 10)
        field = offset + 12
        while field < offset + 12 + extra:
            if raw[field : field + 2] == b"BC":
                return struct.unpack_from("<H", raw, field + 4)[0] + 1
            field += 4 + struct.unpack_from("<H", raw, field + 2)[0]
        raise ValueError("a block does not say its size")

    def read(self, partition: Stretches | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark asks for one where there are none
            return
        names = [s for _, s in partition.columns]
        rows: list[tuple] = []
        for line in self.lines(partition.places):
            if not line or line.startswith(b"#"):
                continue
            fields = line.decode().split("\t")
            chrom, pos, ref, alt = fields[0], int(fields[1]), fields[3], fields[4]
            if partition.spans is not None and not self._touches(partition.spans.get(chrom, ()), pos - 1, pos - 1 + max(len(ref), 1)):
                continue
            try:
                at = fields[8].split(":").index("GT") if len(fields) > 8 else -1
            except ValueError:
                at = -1
            calls = []
            for i, _ in partition.columns:
                parts = fields[9 + i].split(":") if at >= 0 and 9 + i < len(fields) else []
                calls.append(parts[at] if 0 <= at < len(parts) else None)
            rows.append((chrom, pos, ref, alt, calls))
            if len(rows) * len(names) >= BATCH:
                yield self._batch(names, rows)
                rows = []
        if rows:
            yield self._batch(names, rows)

    @staticmethod
    def _touches(spans: Sequence[Span], begin: int, end: int) -> bool:
        i = bisect_left(spans, (begin + 1,)) - 1  # the last span that begins at or before ``begin``
        return any(0 <= k < len(spans) and spans[k][0] < end and spans[k][1] > begin for k in (i, i + 1))

    @staticmethod
    def _batch(names: list[str], rows: list[tuple]) -> pa.RecordBatch:
        n = len(names)
        of_row = lambda k, kind: pa.array([r[k] for r in rows for _ in range(n)], kind)
        columns = [pa.array(names * len(rows), pa.string()), of_row(0, pa.string()), of_row(1, pa.int64()), of_row(2, pa.string()), of_row(3, pa.string()), pa.array([c for r in rows for c in r[4]], pa.string())]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in GENOTYPES.split(", ")])


class VcfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "varloom_vcf"

    def schema(self) -> str:
        return GENOTYPES

    def reader(self, schema) -> VcfReader:
        return VcfReader(dict(self.options))


def region_windows(regions: DataFrame) -> dict[str, list[Span]]:
    """Spans of contigs that cover the regions (chrom, start_, end_), in the index's smallest bins: as many at most as a
    genome has, however many regions there are, so they are gathered on the driver."""
    first, last = F.shiftright(F.greatest("start_", F.lit(0)), MIN_SHIFT), F.shiftright(F.greatest(F.col("end_"), F.col("start_") + 1) - 1, MIN_SHIFT)
    bins = regions.filter("chrom is not null and start_ is not null and end_ is not null and end_ > 0").select("chrom", F.explode(F.sequence(first, last)).alias("b")).distinct()
    out: dict[str, list[Span]] = {}
    for row in bins.collect():
        out.setdefault(row["chrom"], []).append((row["b"] << MIN_SHIFT, row["b"] + 1 << MIN_SHIFT))
    return {k: merged(v) for k, v in out.items()}


def read_indexed_vcf(spark: SparkSession, path: str, regions: DataFrame | None = None, samples: Sequence[str] | None = None, index: str | None = None) -> DataFrame:
    """sample_id, chrom, pos, ref, alt, gt of a block-compressed VCF file with an index, as ``files.read_vcf`` gives them.

    With ``regions`` only records near them are read (those that touch their smallest bins), for an overlap join to
    choose from; with ``samples`` only theirs.  Both are options of the scan.  Spark's own push-down of filters into such
    a source is not used: in Spark 4.1 a filter that was pushed stays with the frame, and narrows later queries of it.
    """
    spark.dataSource.register(VcfSource)
    reader = spark.read.format(VcfSource.name()).option("path", path)
    for name, value in (("index", index), ("samples", None if samples is None else json.dumps(list(samples))), ("regions", None if regions is None else json.dumps(region_windows(regions)))):
        if value is not None:
            reader = reader.option(name, value)
    return reader.load()
