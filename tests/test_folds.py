"""Shared folds of overlapping windows against a fold of each window's own background."""

import random

import pyarrow as pa

from varloom.operators import folds
from varloom.operators import variants as G

NAMES = ["sample_id", "chrom", "pos", "ref", "alt", "a1", "a2"]


def dense(rng, contig, count, flat):
    """Variants of one sample, many of them at one place, some with a REF that the genome hasn't or in lower case."""
    found = {}
    for _ in range(count):
        pos = rng.randrange(1, len(contig) - 3)
        ref = contig[pos - 1 : pos - 1 + rng.randrange(1, 4)]
        ref = ref if rng.random() < 0.9 else rng.choice(["NN", ref.lower()])
        alt = ref[0] if rng.random() < flat else "".join(rng.choices("ACGT", k=rng.randrange(1, 4)))
        found[pos, ref, alt] = (rng.choice([0, 1, 2, None]), rng.choice([0, 1]))
    return [("s", "c", *k, *found[k]) for k in sorted(found)]


def model(text, start, end, variants, hap, center, own):
    shift, seen, moved = 0, text, 0
    for _, _, pos, ref, alt, *alleles in variants:
        if not alleles[hap] or not start <= pos - 1 < end or ((pos, ref, alt) == center and not own):
            continue
        moved += len(alt) - len(ref) if pos < center[0] else 0
        at = pos - 1 - start + shift
        if at >= 0 and at + len(ref) <= len(seen) and seen[at : at + len(ref)].upper() == ref.upper():
            seen, shift = seen[:at] + alt + seen[at + len(ref) :], shift + len(alt) - len(ref)
    return seen, center[0] - 1 - start + moved


def test_shared_folds_against_each_windows_own():
    rng = random.Random(3)
    for case in range(60):
        contig = "".join(rng.choices("ACGTacgt" if case % 3 else "A", k=300))
        variants = dense(rng, contig, rng.choice([3, 40, 300, 900]), rng.random())
        n, own, clip = rng.choice([3, 20, 60]), case % 2 == 0, rng.choice([300, 280])
        windows, expected = [], []
        for _, _, pos, ref, alt, *_ in variants:
            sides = [("up", pos - n - 1, pos + len(ref)), ("down", pos - 2, pos + len(ref) - 1 + n)]
            spans = [{"direction": d, "start": s, "end": e, "wt_ref": contig[s : min(e, clip)]} for d, s, e in sides if pos - n - 1 >= 0 and s < clip]
            windows.append(spans if spans else None)
            expected += [[model(w["wt_ref"], w["start"], w["end"], variants, h, (pos, ref, alt), own) for h in (0, 1)] for w in spans]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32()]
        table = pa.table([pa.array(x, t) for x, t in zip(zip(*variants), kinds)] + [pa.array(windows, pa.list_(pa.struct([("direction", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("wt_ref", pa.string())])))], names=[*NAMES, "windows"])
        got = folds.fold_group(table, NAMES, own)
        assert (got.num_rows if got else 0) == len(expected)
        for r, want in zip(got.to_pylist() if got else [], expected):
            assert [(r["_w1"], r["_at1"]), (r["_w2"], r["_at2"])] == want


def test_few_steps_where_many_windows_hold_a_variant(monkeypatch):
    """Steps of folds grow with the variants and windows, not with the variants in each window."""
    rng, steps = random.Random(4), {}
    fold = folds.fold
    for count in (400, 1600):
        contig = "ACGT" * 500
        variants = dense(rng, contig, count, 0.3)
        taken = []
        monkeypatch.setattr(folds, "fold", lambda seq, start, v, taken=taken: (taken.append(len(v)), fold(seq, start, v))[1])
        windows = [[{"direction": "up", "start": p - 201, "end": p + len(r), "wt_ref": contig[p - 201 : p + len(r)]}] if p > 201 else None for _, _, p, r, *_ in variants]
        table = pa.Table.from_pylist([dict(zip(NAMES, v), windows=w) for v, w in zip(variants, windows)])
        folds.fold_group(table, NAMES, False)
        steps[count] = sum(taken) / len(variants)
    assert steps[400] < 12 and steps[1600] < 60  # a fold for each window takes about 40 and 160 steps a haplotype


def test_few_steps_where_deletions_stand_everywhere(monkeypatch):
    """Where most places carry a deletion, so that a variant could be moved far back, windows still take what is folded once."""
    contig, rng, fold, follow, steps = "ACGT" * 300, random.Random(5), folds.fold, folds.follow, [0]
    found = {}
    for pos in range(3, 1190):
        for size, alt in ((1, "CGTA"[(pos - 1) % 4]), (1, contig[pos - 1] + "GG"), (3, contig[pos - 1]), (2, "CGTAC"[(pos - 1) % 4 : (pos - 1) % 4 + 2])):
            if rng.random() < 0.85:
                found[pos, contig[pos - 1 : pos - 1 + size], alt] = (int(rng.random() < 0.75), int(rng.random() < 0.75))
    variants = [("s", "c", *k, *found[k]) for k in sorted(found)]
    sides = lambda p, r: [("up", p - 201, p + len(r)), ("down", p - 2, p + len(r) + 199)]
    windows = [[{"direction": d, "start": s, "end": e, "wt_ref": contig[s:e]} for d, s, e in sides(p, r)] if p > 201 else None for _, _, p, r, *_ in variants]
    table = pa.Table.from_pylist([dict(zip(NAMES, v), windows=w) for v, w in zip(variants, windows)])

    def counted(index):
        for i in index:
            steps[0] += 1
            yield i

    monkeypatch.setattr(folds, "fold", lambda seq, start, v: fold(seq, start, counted(v)))
    monkeypatch.setattr(folds, "follow", lambda genome, end, every, whole, index, *more: follow(genome, end, every, whole, counted(index), *more))
    got = folds.fold_group(table, NAMES, False).to_pylist()
    assert steps[0] / len(got) < 60  # two haplotypes; a fold for each window takes about a thousand
    for r in rng.sample(got, 200):
        center = (r["pos"], r["ref"], r["alt"])
        assert [(r["_w1"], r["_at1"]), (r["_w2"], r["_at2"])] == [model(contig[r["start"] : r["end"]], r["start"], r["end"], variants, h, center, False) for h in (0, 1)]


def test_ends_that_windows_share_are_folded_once(monkeypatch):
    """Windows that begin or end at one place, and leave no carried variant out there, take one fold of that end."""
    contig, taken, fold = "ACGT" * 200, [], folds.fold
    carried = [("s", "c", p, contig[p - 1 : p + 1], "TTT", 1, 1) for p in range(10, 700, 2)]
    centers = [("s", "c", 400, "T", a + b + c, 0, 0) for a in "ACGT" for b in "ACGT" for c in "ACGT"]
    variants = sorted(carried + centers)
    windows = [[{"direction": "up", "start": 199, "end": 600, "wt_ref": contig[199:600]}] if v in centers else None for v in variants]
    monkeypatch.setattr(folds, "fold", lambda seq, start, v: (taken.append(start), fold(seq, start, v))[1])
    got = folds.fold_group(pa.Table.from_pylist([dict(zip(NAMES, v), windows=w) for v, w in zip(variants, windows)]), NAMES, False).to_pylist()
    want = [model(contig[199:600], 199, 600, variants, h, (400, "T", "AAA"), False) for h in (0, 1)]
    assert len(got) == 64 and all([(r["_w1"], r["_at1"]), (r["_w2"], r["_at2"])] == want for r in got)
    assert taken.count(199) <= 4  # the end and the piece that begin there, in two haplotypes; an end for each window are 128


def test_folds_are_as_many_tasks_as_the_session_says(spark):
    """What is shuffled is far smaller than what is made out of it, so its partitions are not joined by their sizes."""
    df = spark.range(1, 2000).selectExpr("'s' as sample_id", "concat('chr', id % 9) as chrom", "id * 40 as pos", "'A' as ref", "'C' as alt", "1 as a1", "0 as a2")
    for out in (G.folded_intervals(df, 50, G.periodic_window, 1), G.legacy_haplotypes(df, 50, G.periodic_window, 1)):
        assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_folded_intervals_as_backgrounds(spark):
    """The operator over bins and samples gives what background lists and their folds give."""
    rng = random.Random(6)
    rows = []
    for s in ("a", "b"):
        for pos in sorted(rng.sample(range(1, 12_000), 900) + rng.sample(range(4000, 4300), 200)):
            ref = "".join("ACGT"[(pos - 1 + k) % 4] for k in range(rng.randrange(1, 4)))
            rows.append((s, "chr1", pos, ref, "".join(rng.choices("ACGT", k=rng.randrange(1, 4))), rng.randrange(2), rng.randrange(2)))
    df = spark.createDataFrame(sorted(set((r[:5]) for r in rows)), "sample_id string, chrom string, pos long, ref string, alt string").selectExpr("*", "cast(pos % 2 as int) as a1", "cast(pos % 3 as int) as a2")
    lists = G.split_with_background(df, 50, longest=3).withColumn("wt_ref", G.periodic_window(G.F.col("start"), G.F.col("end") - G.F.col("start")))
    want = {(r["sample_id"], r["name"]): (r["hap1"], r["hap2"], r["reference"]) for r in G.six_sequences(lists).collect()}
    got = {(r["sample_id"], r["name"]): (r["hap1"], r["hap2"], r["reference"]) for r in G.six_of_folds(G.folded_intervals(df, 50, G.periodic_window)).collect()}
    assert got == want and len(got) > 3000


def test_backgrounds_of_short_and_long_intervals_without_a_shuffle_of_pairs(spark):
    rng = random.Random(8)
    rows = [(rng.choice("ab"), rng.choice(["chr1", "chr2"]), rng.randrange(1, 9000), rng.choice(["A", "AC"]), "G", 1, 0) for _ in range(500)]
    rows = sorted(set(rows))
    spans = [(*rng.choice(rows)[:5], i, s, s + rng.choice([1, 202, 256, 257, 3000, 20_000])) for i, s in ((i, rng.randrange(9000)) for i in range(200))] + [("c", "chr1", 5, "A", "G", 200, 0, 10)]
    v = spark.createDataFrame(rows, "sample_id string, chrom string, pos long, ref string, alt string, a1 int, a2 int")
    i = spark.createDataFrame(spans, "sample_id string, chrom string, pos long, ref string, alt string, i int, start long, end long")
    want = {k: sorted((p, r, a) for vs, vc, p, r, a, *_ in rows if (vs, vc) == (s, c) and start <= p - 1 < end and (p, r, a) != me) for s, c, *me, k, start, end in spans for me in [tuple(me)]}
    for longest in (None, 20_000):
        out = G.background_join(i, v, longest=longest)
        assert {r["i"]: [(b["pos"], b["ref"], b["alt"]) for b in r["background"]] for r in out.collect()} == want
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan  # no pairs that are put together to lists again


def test_six_of_built_as_of_a_table_without_a_shuffle_of_letters(spark):
    rows = [(s, "chr1", p, "ACGT"[(p - 1) % 4], a, p % 2, p % 3 % 2) for s in "ab" for p in range(30, 400, 3) for a in ("AC", "G", "TTT") if a != "ACGT"[(p - 1) % 4]]
    df = spark.createDataFrame(rows, "sample_id string, chrom string, pos long, ref string, alt string, a1 int, a2 int")
    every = G.split_intervals(df, 20)
    table = G.six_of_folds(G.folded_intervals(df, 20, G.periodic_window, 1)).select("sample_id", "name", "hap1.mut", G.F.col("hap2.mut").alias("mut2")).toDF("sample_id", "name", "hap1", "hap2")
    asked = every.filter("pos % 4 <> 1 and (pos % 5 <> 2 or direction = 'upstream')")
    # An interval that no variant is named after has no haplotypes.
    asked = asked.unionByName(asked.limit(1).withColumn("pos", G.F.lit(999).cast("long")))
    out = G.six_of_built(asked, df, 20, G.periodic_window, 1)
    columns = ["sample_id", "chrom", "pos", "ref", "alt", "direction", "hap1", "hap2", "reference"]
    want = G.six_of_haplotypes(asked.withColumn("wt_ref", G.periodic_window(G.F.col("start"), G.F.col("end") - G.F.col("start"))), table)
    assert sorted(map(str, out.select(columns).collect())) == sorted(map(str, want.filter("pos < 999").select(columns).collect())) and out.count() > 200
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange") and plan.index("MapInArrow") < plan.index("Join")  # all shuffles and joins are below the fold


def test_six_of_haplotypes_query_looks_up_no_letters(spark):
    from varloom import catalog

    plan = catalog.six_of_haplotypes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange") and plan.index("MapInArrow") < plan.index("Join")


def test_background_texts_as_lists(spark):
    """Texts cut out of one text of a bin's variants, own variants left out, against lists of structs; letters that are not ASCII among them."""
    rng = random.Random(9)
    rows = sorted({(rng.choice("ab"), "chr1", rng.randrange(1, 9500), rng.choice(["A", "AC"]), rng.choice(["G", "éT"])) for _ in range(900)} | {("a", "chr1", p, "A", "G") for p in range(4090, 4100)})
    df = spark.createDataFrame([(*r, 1, 0) for r in rows], "sample_id string, chrom string, pos long, ref string, alt string, a1 int, a2 int")
    F, names = G.F, ["sample_id", "chrom", "pos", "ref", "alt", "direction"]
    text = F.array_join(F.transform("background", lambda v: F.concat(v["pos"].cast("string"), v["ref"], F.lit(">"), v["alt"])), ",")
    long = G.split_intervals(df, 60).withColumn("end", F.when(F.col("pos") % 9 == 0, F.col("end") + 5000).when(F.col("pos") % 9 == 1, F.col("start")).otherwise(F.col("end")))
    strangers = long.limit(5).withColumn("alt", F.lit("CC"))  # of no variant of the table
    long = long.unionByName(strangers)
    want = G.background_join(long, df).select(*names, "start", "end", F.size("background").alias("n"), text.alias("background"))
    for longest in (None, 6000):
        assert sorted(map(str, G.background_texts(long, df, names, longest=longest).collect())) == sorted(map(str, want.collect()))
    lists = G.split_with_background(df, 60).select(*names, "start", "end", F.size("background").alias("n"), text.alias("background"))
    got = G.split_with_background_texts(df, 60)
    assert sorted(map(str, got.collect())) == sorted(map(str, lists.collect())) and got.filter("n > 1").count() > 500


def test_background_queries_make_no_lists_of_structs(spark):
    from varloom import catalog

    for q in (catalog.background_join, catalog.background_join_intervals):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_list" not in plan and "array_join" not in plan and "struct(sample_id" not in plan
