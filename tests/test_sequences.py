"""Sequence operators against worked values and an independent plain-Python model."""

import random

import pytest
from pyspark.sql import functions as F

from varloom.functions import sequences as S
from varloom.operators import store
from varloom.operators import variants as G
from varloom.sources import files

VARIANT = "sample_id string, chrom string, pos long, ref string, alt string, a1 int, a2 int"


def test_interval_split(spark):
    rows = [("s", "chr1", 100, "A", "T", 1, 1), ("s", "chr2", 202, "A", "AT", 1, 1), ("s", "chr3", 300, "AT", "A", 1, 1), ("s", "chr4", 400, "ATC", "GTG", 1, 1), ("s", "chr1", 2, "A", "T", 1, 1)]
    got = {(r["chrom"], r["direction"]): (r["start"], r["end"]) for r in G.split_intervals(spark.createDataFrame(rows, VARIANT), 3).collect()}
    assert got == {
        ("chr1", "upstream"): (96, 101), ("chr1", "downstream"): (98, 103), ("chr2", "upstream"): (198, 203), ("chr2", "downstream"): (200, 205),
        ("chr3", "upstream"): (296, 302), ("chr3", "downstream"): (298, 304), ("chr4", "upstream"): (396, 403), ("chr4", "downstream"): (398, 405),
    }
    with pytest.raises(ValueError):
        G.split_intervals(spark.createDataFrame(rows, VARIANT), 1, least=10)


def test_reverse_complement(spark):
    rows = [("ATCG", "CGAT"), ("AATT", "AATT"), ("atcg", "cgat"), ("NATCGN", "NCGATN"), ("AACG", "CGTT"), ("", "")]
    got = spark.createDataFrame(rows, "s string, e string").select(S.reverse_complement(F.col("s")).alias("g"), "e").collect()
    assert all(r["g"] == r["e"] for r in got)


def test_restore_wild_type(spark):
    rows = [
        ("upstream", "A", "T", "NNNNNNTP", "NNNNNNAP"), ("upstream", "A", "AT", "NNNNNNATx", "NNNNNNAx"), ("upstream", "AT", "A", "NNNNNNAP", "NNNNNNATP"), ("upstream", "ATC", "GTG", "NNNNNGTGx", "NNNNNATCx"),
        ("downstream", "A", "T", "xTNNNNNN", "xANNNNNN"), ("downstream", "AT", "A", "xANNNNNN", "xATNNNNNN"), ("downstream", "A", "AT", "xATNNNNN", "xANNNNN"), ("downstream", "ATC", "GTG", "xGTGNNNN", "xATCNNNN"),
    ]
    df = spark.createDataFrame(rows, "d string, ref string, alt string, m string, e string")
    assert all(r["g"] == r["e"] for r in df.select(S.restore_wild_type(F.col("m"), F.col("d"), F.col("ref"), F.col("alt")).alias("g"), "e").collect())


def model_fold(seq, start, background):
    shift = 0
    for pos, ref, alt, allele in background:
        at = pos - 1 - start + shift
        if not allele or at < 0 or at + len(ref) > len(seq) or seq[at : at + len(ref)].upper() != ref.upper():
            continue
        seq, shift = seq[:at] + alt + seq[at + len(ref) :], shift + len(alt) - len(ref)
    return seq


def test_background_fold_against_model(spark):
    rng = random.Random(5)
    rows, expected = [], {}
    for i in range(200):
        seq, start = "".join(rng.choices("ACGT", k=40)), rng.randrange(100)
        background = []
        for _ in range(rng.randrange(5)):
            at = rng.randrange(-3, 42)
            n = rng.randrange(1, 4)
            ref = seq[max(at, 0) : max(at, 0) + n] or "A"
            ref = ref if rng.random() < 0.8 else "NN"
            background.append((start + at + 1, ref, "".join(rng.choices("ACGT", k=rng.randrange(1, 4))), rng.randrange(3)))
        background.sort()
        rows.append((i, seq, start, background))
        expected[i] = model_fold(seq, start, background)
    df = spark.createDataFrame(rows, f"i int, seq string, start long, bg {S.BACKGROUND}")
    got = {r["i"]: r["g"] for r in df.select("i", S.apply_background(F.col("seq"), F.col("start"), F.col("bg")).alias("g")).collect()}
    assert got == expected


def test_aliases(spark):
    rows = [("s", "chr1", 100, "A", "T", a, b) for a, b in ((0, 0), (1, 0), (0, 1), (1, 1))]
    df = spark.createDataFrame(rows, VARIANT).withColumns({"start": F.lit(90), "wt_ref": F.lit("A" * 15), "background": F.expr("cast(array() as array<struct<pos:bigint,ref:string,alt:string,a1:int,a2:int>>)")})
    got = {(r["a1"], r["a2"]): (r["hap1"]["wt_is_alias"], r["hap2"]["wt_is_alias"], r["mut_ref"]) for r in G.six_sequences(df).collect()}
    assert {k: v[:2] for k, v in got.items()} == {(0, 0): (True, True), (1, 0): (False, True), (0, 1): (True, False), (1, 1): (False, False)}
    assert got[1, 1][2] == "A" * 9 + "T" + "A" * 5


def test_text_files(spark, tmp_path):
    (tmp_path / "a.bed").write_text("# c\n\nchr1 5 9\nchr2\t7\t8\tchr2_202_A_AT_upstream\nchr3 1\n")
    got = [tuple(r) for r in files.read_bed(spark, str(tmp_path / "a.bed")).orderBy("chrom").collect()]
    assert got == [("chr1", 5, 9, "chr1_5_9"), ("chr2", 7, 8, "chr2_202_A_AT_upstream")]
    (tmp_path / "a.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nchr1\t5\t.\tA\tG,T\t.\t.\t.\tDP:GT\t3:0|1\t2:./.\n")
    vcf = files.read_vcf(spark, str(tmp_path / "a.vcf"))
    assert files.sample_names(spark, str(tmp_path / "a.vcf")) == ["s1", "s2"]
    assert [tuple(r) for r in G.parse_genotypes(vcf).collect()] == [("s1", "chr1", 5, "A", "G", 0, 1)]
    (tmp_path / "a.fa").write_text(">chr1 x\nACGTAC\nGTAC\n>chr2\nacg\n")
    genome = files.read_fasta(spark, str(tmp_path / "a.fa"), chunk=4)
    spans = spark.createDataFrame([("a", "chr1", 2, 9), ("b", "chr2", 1, 3), ("c", "chr1", 8, 30)], "name string, chrom string, start long, end long")
    got = {r["name"]: r["wt_ref"] for r in G.fetch_windows(spans, genome, 4, ["name"]).collect()}
    assert got == {"a": "GTACGTA", "b": "CG", "c": "AC"}


def test_contigs_over_many_splits(spark, tmp_path):
    rng = random.Random(11)
    contigs = {f"chr{i}": "".join(rng.choices("ACGTNacgt", k=n)) for i, n in enumerate((5000, 3, 0, 977, 64, 2500))}
    text = "ACGT before any header\n\n"
    for i, (name, seq) in enumerate(contigs.items()):
        width = (60, 7, 60, 977, 1, 33)[i]
        text += f">{name} some more words\n" + "".join(seq[k : k + width] + ("\r\n" if i == 3 else "\n") for k in range(0, len(seq), width)) + ("\n" if i % 2 else "")
    (tmp_path / "g.fa").write_text(text)
    (tmp_path / "h.fa").write_text(">other\nAC GT\nTT")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("128m", "1000", "150"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            for chunk in (16, 1000):
                rows = files.read_fasta(spark, str(tmp_path), chunk).collect()
                got = {}
                for r in sorted(rows, key=lambda r: (r["chrom"], r["chunk_no"])):
                    assert r["chunk_no"] * chunk == len(got.get(r["chrom"], ""))
                    got[r["chrom"]] = got.get(r["chrom"], "") + r["seq"]
                assert got == {k: v.upper() for k, v in contigs.items() if v} | {"other": "ACGTTT"}
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_packed_bases(spark):
    rng = random.Random(13)
    seqs = ["", "A", "T" * 32, "ACGT" * 8 + "G", "N", "ACGNacgtRYK-", None, *["".join(rng.choices("ACGT", k=n)) for n in (31, 33, 64, 200, 5000)], *["".join(rng.choices("ACGTNacgt", weights=[9, 9, 9, 9, 1, 1, 1, 1, 1], k=300)) for _ in range(5)]]
    df = spark.createDataFrame(list(enumerate(seqs)), "i int, seq string").withColumn("p", S.pack_bases(F.col("seq")))
    assert dict(df.dtypes)["p"] == S.PACKED
    rows = df.select("i", S.unpack_bases(F.col("p")).alias("back"), F.octet_length("p.words").alias("n")).collect()
    assert {r["i"]: r["back"] for r in rows} == dict(enumerate(seqs))
    assert all(r["n"] == 8 * -(-len(seqs[r["i"]]) // 32) for r in rows if seqs[r["i"]] is not None)
    forms = {"string": "ACgN", "binary": bytearray(b"ACgN"), "array<tinyint>": [65, 67, 103, 78], "array<int>": [65, 67, 103, 78], "array<string>": list("ACgN"), "array<binary>": [bytearray(c.encode()) for c in "ACgN"]}
    for kind, value in forms.items():
        table = spark.createDataFrame([("s", "v", value, None)], f"sample_id string, name string, hap1 {kind}, hap2 {kind}")
        assert tuple(store.open_haplotypes(table).first()) == ("s", "v", "ACgN", None)
        again = store.open_haplotypes(store.pack_haplotypes(store.open_haplotypes(table)))
        assert tuple(again.first()) == ("s", "v", "ACgN", None)
    with pytest.raises(ValueError):
        S.decode_bases("x", "double")


def test_packed_bases_of_other_letters_and_their_plan(spark):
    seqs = ["ACéGT", "\U0001d53cACGT" * 9, "ACGT" * 3, None, ""]
    df = spark.createDataFrame(list(enumerate(seqs)), "i int, seq string").withColumn("p", S.pack_bases(F.col("seq")))
    rows = {r["i"]: r for r in df.select("i", "p", S.unpack_bases(F.col("p")).alias("back")).collect()}
    assert {i: r["back"] for i, r in rows.items()} == dict(enumerate(seqs))
    assert rows[2]["p"]["words"] == bytes([0b00011011] * 3 + [0] * 5) and rows[0]["p"]["bases"] == 5 and [tuple(x) for x in rows[0]["p"]["other"]] == [(2, "é")]
    # A text is looked at once, not once for each of its words.
    assert "lambdafunction" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_windows_in_one_join_as_put_together(spark):
    """Windows over many chunks, at and behind a contig's end, by pieces and whole chunks; intervals are not shuffled to meet their own letters."""
    rng = random.Random(12)
    contigs = {"chr1": "".join(rng.choices("ACGTNacgt", k=5000)), "chr2": "ACG", "chr3": "".join(rng.choices("ACGT", k=2048))}
    spans = [(i, rng.choice([*contigs, "chr9"]), s, s + rng.choice([1, 2, 7, 30, 400, 2500])) for i, s in ((i, rng.randrange(5200)) for i in range(400))] + [(1000, "chr1", 0, 5000), (1001, "chr2", 0, 9), (1002, "chr2", 2, 3)]
    intervals = spark.createDataFrame(spans, "i int, chrom string, start long, end long")
    table = spark.createDataFrame(list(contigs.items()), "chrom string, seq string")
    for chunk in (1, 7, 1024, 1500, 65_536):
        if chunk == 1:
            intervals_, n = intervals.filter("end - start < 40"), 30
        else:
            intervals_, n = intervals, 5000
        genome = files.cut_contigs(table, chunk)
        want = {r["i"]: r["wt_ref"] for r in G.fetch_windows(intervals_, genome, chunk, ["i"]).collect()}
        out = G.placed_windows(intervals_, genome, chunk, longest=n)
        assert out.columns == ["i", "chrom", "start", "end", "wt_ref"] and {r["i"]: r["wt_ref"] for r in out.collect()} == want
        assert {r["i"]: r["wt_ref"] for r in G.placed_windows(intervals_, genome, chunk).collect()} == want
        assert all(want[i] == contigs[c][s:e] for i, c, s, e in spans if i in want)
    from jobs import sequence_cache

    variants = spark.createDataFrame([("chr1", 900, "A", "C")], "chrom string, pos long, ref string, alt string")
    plan = sequence_cache.reference_slots(variants, genome, 40, "mean")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Aggregate ") == 1  # of chunks; windows are not grouped
