"""Region scans of indexed genotype files against whole scans, with the blocks counted."""

import json
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from varloom.operators import variants as G
from varloom.plans import personal, settings
from varloom.sources import files, indexed

SAMPLES = ["s0", "s1", "s2"]


def block(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(content) + packer.flush()
    head = struct.pack("<4BIBBH", 0x1F, 0x8B, 8, 4, 0, 0, 255, 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(content), len(content))


def write_indexed(path, lines, size):
    """A block-compressed file of ``size`` bytes a block, and its index, by the format's rules."""
    text = b"".join(x.encode() + b"\n" for x in lines)
    out, offsets = b"", []
    for begin in range(0, len(text), size):
        offsets.append(len(out))
        out += block(text[begin : begin + size])
    offsets.append(len(out))
    path.write_bytes(out + block(b""))
    place = lambda at: offsets[at // size] << 16 | at % size
    contigs, at = {}, 0
    for line in lines:
        end = at + len(line) + 1
        if not line.startswith("#"):
            chrom, pos, _, ref = line.split("\t")[:4]
            b, e = int(pos) - 1, int(pos) - 1 + len(ref)
            bins, linear = contigs.setdefault(chrom, ({}, {}))
            number = next(r.start for r in reversed(indexed.bins_of(b, e)) if len(r) == 1)
            chunks = bins.setdefault(number, [])
            if chunks and chunks[-1][1] == place(at):
                chunks[-1] = (chunks[-1][0], place(end))
            else:
                chunks.append((place(at), place(end)))
            for w in range(b >> 14, (e - 1 >> 14) + 1):
                linear.setdefault(w, place(at))
        at = end
    names = b"".join(c.encode() + b"\0" for c in contigs)
    raw = b"TBI\x01" + struct.pack("<8i", len(contigs), 2, 1, 2, 0, ord("#"), 0, len(names)) + names
    for bins, linear in contigs.values():
        raw += struct.pack("<i", len(bins) + 1)
        for number, chunks in bins.items():
            raw += struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks)
        raw += struct.pack("<Ii4Q", 37450, 2, 0, 0, 0, 0)  # counts, as indexing tools add them
        last, filled = 0, []
        for w in range(max(linear) + 1):
            last = linear.get(w, last)
            filled.append(last)
        raw += struct.pack(f"<i{len(filled)}Q", len(filled), *filled)
    path.with_name(path.name + ".tbi").write_bytes(b"".join(block(raw[i : i + 60000]) for i in range(0, len(raw), 60000)) + block(b""))


@pytest.fixture(scope="module")
def genotypes(tmp_path_factory):
    rng, top = random.Random(4), tmp_path_factory.mktemp("vcf")
    lines = ["##fileformat=VCFv4.2", "##x=" + "y" * 3000, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *SAMPLES])]
    for chrom, n, far in (("chr1", 9000, 3_000_000), ("chr2", 4000, 2_000_000), ("chrM", 3, 900)):
        for pos in sorted(rng.sample(range(1, far), n)):
            ref = "A" * 40_000 if chrom == "chr1" and rng.random() < 0.0005 else "A"  # some reach over many bins
            calls = [f"{rng.choice(['0|0', '0|1', '1|1', './.'])}:{rng.randrange(99)}" for _ in SAMPLES]
            lines.append("\t".join([chrom, str(pos), ".", ref, rng.choice(["C", "G,T", "."]), ".", ".", "." * rng.randrange(30), "GT:DP" if rng.random() < 0.99 else "DP", *calls]))
    write_indexed(top / "a.vcf.gz", lines, 4096)
    (top / "a.vcf").write_text("\n".join(lines) + "\n")
    return top


def rows(df):
    return sorted((tuple(r) for r in df.select("sample_id", "chrom", "pos", "ref", "alt", "gt").collect()), key=str)


def blocks_read(reader):
    out = set()
    for part in reader.partitions():
        with indexed.open_at(reader.path) as f:
            raw = f.read()
        for a, b in part.places:
            out |= {o for o, content in indexed.blocks(raw) if content and a >> 16 <= o and (o < b >> 16 or o == b >> 16 and b & 0xFFFF)}
    return len(out)


def test_whole_file(spark, genotypes, monkeypatch):
    want = rows(files.read_vcf(spark, f"{genotypes}/a.vcf"))
    assert rows(indexed.read_indexed_vcf(spark, f"{genotypes}/a.vcf.gz")) == want
    assert rows(indexed.read_indexed_vcf(spark, f"file://{genotypes}/a.vcf.gz", index=f"file://{genotypes}/a.vcf.gz.tbi")) == want
    monkeypatch.setattr(indexed, "TASK", 20_000)
    reader = indexed.VcfReader({"path": f"{genotypes}/a.vcf.gz"})
    parts = reader.partitions()
    assert len(parts) > 5  # many tasks, no record lost or read twice between them
    assert sorted((tuple(r.values()) for p in parts for b in reader.read(p) for r in b.to_pylist()), key=str) == want


def test_regions_are_pruned(spark, genotypes):
    path, whole = f"{genotypes}/a.vcf.gz", files.read_vcf(spark, f"{genotypes}/a.vcf")
    rng = random.Random(6)
    regions = [("chr1", a, a + 400) for a in rng.sample(range(3_000_000), 2)] + [("chr2", 1_999_000, 2_500_000), ("chr9", 5, 9), (None, 1, 2), ("chrM", 0, 2000)]
    for some in (regions[:1], regions[2:3], regions[5:], regions, [("chr1", 0, 3_100_000)], []):
        df = spark.createDataFrame(some, "chrom string, start_ long, end_ long")
        got = G.overlap_join(indexed.read_indexed_vcf(spark, path, df), df)
        want = G.overlap_join(whole, df)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = spark.createDataFrame([("chr2", 700_100, 700_500)], "chrom string, start_ long, end_ long")
    every = blocks_read(indexed.VcfReader({"path": path}))
    few = blocks_read(indexed.VcfReader({"path": path, "regions": json.dumps(indexed.region_windows(one))}))
    assert every > 200 and 0 < few <= 0.03 * every  # a window of 16,384 of five million bases


def test_a_run_reads_the_index(spark, genotypes, tmp_path, monkeypatch):
    (tmp_path / "r.bed").write_text("chr1\t100\t90000\nchrM\t1\t900\n")
    read = lambda vcf: sorted(map(tuple, personal.read_variants(spark, settings.variant_settings({"vcf_path": vcf, "bed_path": f"{tmp_path}/r.bed"})).collect()))
    want = read(f"{genotypes}/a.vcf")
    monkeypatch.setattr(files, "read_vcf", None)
    assert read(f"{genotypes}/a.vcf.gz") == want and len(want) > 100


def test_overlaps_of_short_and_contig_long_regions(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["chr1", "chr2"]), rng.randrange(1, 3_000_000), "A" * rng.choice([1, 1, 1, 5, 9000]), "C") for i in range(400)]
    regions = [(rng.choice(["chr1", "chr2"]), s, s + rng.choice([0, 1, 50, 5000, 40_000, 900_000])) for s in (rng.randrange(3_000_000) for _ in range(150))]
    regions += [("chr1", 0, 250_000_000), ("chr2", 0, 3_000_000_000), (None, 1, 5), ("chr1", None, 5), ("chr1", -5, 10)]
    v, r = spark.createDataFrame(rows, "i int, chrom string, pos long, ref string, alt string"), spark.createDataFrame(regions, "chrom string, start_ long, end_ long")
    got = sorted((x["i"], x["start_"], x["end_"]) for x in G.overlap_join(v, r).collect())
    assert got == sorted((i, s, e) for i, c, p, ref, _ in rows for d, s, e in regions if c == d and s is not None and p - 1 < e and p - 1 + len(ref) > s)
    level = r.filter("start_ is not null").withColumn("level", G.region_level(4096)).withColumn("size", F.expr("4096 * cast(pow(8, level) as long)"))
    assert level.filter("floor((greatest(end_, start_ + 1) - 1) / size) - floor(start_ / size) > 1").isEmpty()  # two bins at most
    assert G.overlap_join(v, r.filter("false")).isEmpty() and G.overlap_join(v.filter("false"), r).isEmpty()


def test_samples_and_repeated_use_of_a_frame(spark, genotypes):
    path, whole = f"{genotypes}/a.vcf.gz", files.read_vcf(spark, f"{genotypes}/a.vcf")
    assert rows(indexed.read_indexed_vcf(spark, path, samples=["s2", "none"])) == rows(whole.filter("sample_id = 's2'"))
    assert indexed.read_indexed_vcf(spark, path, samples=[]).count() == 0
    df = indexed.read_indexed_vcf(spark, path)
    n = df.count()
    for c in ("chrom = 'chr2' and pos > 1000000 and pos <= 1010000", "pos = 77 or chrom = 'chrM'", "chrom = 'none'"):
        assert rows(df.filter(c)) == rows(whole.filter(c)) and df.count() == n


def test_wrong_files(spark, genotypes, tmp_path):
    with pytest.raises(ValueError, match="not a tabix index"):
        indexed.Index(b"CSI\x01")
    with pytest.raises(ValueError, match="no block"):
        list(indexed.blocks(b"chr1\t5\t.\tA\tC and so on"))
    write_indexed(tmp_path / "n.vcf.gz", ["##x", "chr1\t5\t.\tA\tC"], 4096)
    with pytest.raises(ValueError, match="#CHROM"):
        indexed.VcfReader({"path": f"{tmp_path}/n.vcf.gz"}).header()
    write_indexed(tmp_path / "e.vcf.gz", ["##x", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1"], 4096)
    assert indexed.read_indexed_vcf(spark, f"{tmp_path}/e.vcf.gz").filter(F.col("pos") > 3).count() == 0


def test_variants_that_touch_a_region_make_no_pairs(spark):
    rng = random.Random(10)
    rows = [(i, rng.choice(["chr1", "chr2"]), rng.randrange(1, 60_000), "A" * rng.choice([0, 1, 1, 5, 9000]), "C") for i in range(400)]
    regions = [(rng.choice(["chr1", "chr2"]), s, s + rng.choice([-3, 0, 1, 50, 500])) for s in (rng.randrange(60_000) for _ in range(60))]
    regions += [(None, 1, 5), ("chr1", None, 5), ("chr1", -5, 10), ("chr2", 50_000, 50_100), ("chr2", 50_100, 50_200)]
    schema = "i int, chrom string, pos long, ref string, alt string"
    v, r = spark.createDataFrame(rows, schema), spark.createDataFrame(regions, "chrom string, start_ long, end_ long")
    want = sorted({i for i, c, p, ref, _ in rows for d, s, e in regions if c == d and s is not None and p - 1 < e and p - 1 + len(ref) > s})
    for more in (r, r.unionByName(r).unionByName(spark.createDataFrame([("chr1", 100, 40_000)], r.schema))):
        got = sorted(x["i"] for x in G.touching(v, more).collect())
        assert got == (want if more is r else sorted({*want, *(i for i, c, p, ref, _ in rows if c == "chr1" and p - 1 < 40_000 and p - 1 + len(ref) > 100)}))
    assert G.touching(v, r.filter("false")).isEmpty()
    # A thousand regions over each variant: the join reads and gives one row for each.
    crowd = spark.range(1000).selectExpr("'chr1' as chrom", "1000 + id % 7 as start_", "3000 - id % 5 as end_")
    one = G.touching(spark.createDataFrame([(1, "chr1", 2000, "A", "C")], schema), crowd)
    assert one.count() == 1
