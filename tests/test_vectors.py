"""Vector operators against worked values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from varloom.functions import vectors as V
from varloom.operators import encode, learning, metrics, omics, store

COLUMNS = ("mut1", "wt1", "mut2", "wt2", "mutref", "wtref")


@pytest.fixture(scope="module")
def row(spark):
    data = [([1.0, 2.0, 3.0, 4.0], [0.0] * 4, [5.0, 6.0, 7.0, 8.0], [1.0] * 4, [10.0] * 4, [5.0] * 4, "s", 0)]
    return spark.createDataFrame(data, ", ".join(f"{c} array<double>" for c in COLUMNS) + ", sample_id string, ord int")


def test_represent(row):
    get = lambda s: omics.represented(row, s).first()["rep"]
    assert get("baseline_delta_deltaref") == [0.5] * 4 + [2.5, 3.5, 4.5, 5.5] + [5.0] * 4
    assert get("mut_hap1_hap2_mean") == [3, 4, 5, 6]
    assert get("mut_mean_minus_wt_ref") == [-2, -1, 0, 1]
    assert get("mut_concat_minus_wt_ref") == [-4, -3, -2, -1, 0, 1, 2, 3]
    none = row.withColumns({"mutref": F.lit(None).cast("array<double>"), "wtref": F.lit(None).cast("array<double>")})
    assert omics.represented(none, "baseline_delta_deltaref").first()["rep"][-4:] == [0.0] * 4


def test_scores(row):
    got = omics.scored(row).first()
    assert got["absolute"] == pytest.approx(math.sqrt(30) + math.sqrt(126) + 10)
    assert got["delta"] == pytest.approx(math.sqrt(69))
    assert got["relative"] == pytest.approx(1 - (50 / (10 * math.sqrt(30)) + 110 / (10 * math.sqrt(126))) / 2)


def test_tail_pool(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [5.0, 0.0], [9.0, 9.0]], [1, 1, 1, 0], 2)], "h array<array<double>>, m array<int>, w int")
    got = df.select(V.tail_pool(F.col("h"), F.col("m"), F.col("w"), "mean").alias("a"), V.tail_pool(F.col("h"), F.col("m"), F.col("w"), "max").alias("b"), V.pool(F.col("h"), F.col("m"), "last_token").alias("c")).first()
    assert got == ([4.0, 2.0], [5.0, 4.0], [5.0, 0.0])


def test_selection_ties_keep_order(spark):
    rows = spark.createDataFrame([("s", i, float(i % 2), 1.0, 1.0) for i in range(6)], "sample_id string, ord int, relative double, absolute double, delta double")
    assert [r["ord"] for r in omics.select_top(rows, "relative", 3).orderBy("rank").collect()] == [1, 3, 5]
    assert omics.select_top(rows, "delta", 0).count() == 6
    with pytest.raises(ValueError):
        omics.select_top(rows, "other", 1)


def test_metrics(spark):
    rows = spark.createDataFrame([(1, 0.9, 1), (0, 0.8, 1), (1, 0.8, 1), (0, 0.1, 0)], "label int, score double, pred int")
    assert metrics.roc_auc(rows).first()[0] == pytest.approx(0.875)
    assert metrics.roc_auc(rows.filter("label = 1")).first()[0] == 0.5
    assert metrics.confusion(rows).first()["f1"] == pytest.approx(0.8)


def test_imputation(spark):
    rows = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None), (3, 3.0, None), (4, 10.0, None), (5, float("nan"), None), (6, 1.0, None)], "sample_id int, x double, y double")
    assert learning.impute(rows, ["x", "y"], "median").filter("sample_id = 5").first()[1:] == (2.0, 0.0)
    assert learning.impute(rows, ["x"], "most_frequent").filter("sample_id = 5").first()["x"] == 1.0


def test_distinct_encoding_survives_bad_sequences(spark):
    class Picky(encode.ToyEncoder):
        def hidden_states(self, sequences):
            if "BAD" in sequences:
                raise ValueError("bad sequence")
            return super().hidden_states(sequences)

    rows = spark.createDataFrame([("ACGT", 2), ("ACGT", 2), ("ACGT", 3), ("BAD", 1)], "seq string, w int")
    got = {(r["seq"], r["w"]): r["vec"] is None for r in encode.encode_distinct(rows, Picky()).collect()}
    assert got == {("ACGT", 2): False, ("ACGT", 3): False, ("BAD", 1): True}
    with pytest.raises(ValueError):
        encode.bulk_embed(rows.withColumnRenamed("w", "key"), encode.ToyEncoder(), [])


def test_round_robin(spark):
    names = spark.createDataFrame([(f"s{i}",) for i in range(10)], "sample_id string")
    got = {}
    for r in store.round_robin(names, 4).collect():
        got.setdefault(r["bucket"], []).append(r["sample_id"])
    assert {k: len(v) for k, v in got.items()} == {0: 3, 1: 3, 2: 2, 3: 2}


def test_ranks_of_one_sample_in_many_tasks(spark):
    rng = random.Random(12)
    score = lambda: rng.choice([None, *[round(rng.random(), 2) for _ in range(12)]])
    rows = [("hot" if i % 20 else f"s{i % 7}", i, score(), score(), score()) for i in range(4000)] + [("one", 9001, 0.5, 0.5, None), (None, 9002, 0.1, 0.2, 0.3), (None, 9003, 0.3, 0.2, 0.3)]
    df = spark.createDataFrame(rows, "sample_id string, ord int, relative double, absolute double, delta double").repartition(4)
    whole = [r for r in rows if r[2] is not None and r[3] is not None]

    def shares(of):
        out = {}
        for s in {r[0] for r in whole}:
            each = sorted((r for r in whole if r[0] == s), key=lambda r: (r[of], r[1]))
            out |= {(s, r[1]): 0.5 if len(each) == 1 else i / (len(each) - 1) for i, r in enumerate(each)}
        return out

    rel, ab = shares(2), shares(3)
    want = set()
    for s in {r[0] for r in whole}:
        each = sorted((r for r in whole if r[0] == s), key=lambda r: (-(0.25 * rel[s, r[1]] + 0.75 * ab[s, r[1]]), r[1]))
        want |= {(s, r[1], i + 1) for i, r in enumerate(each[:6])}
    assert {(r["sample_id"], r["ord"], r["rank"]) for r in omics.select_top(df, "weighted", 6, weight=0.25).collect()} == want
    found = omics.rank_share(df, "relative", "share")
    assert found.filter("(relative is null) <> (share is null)").isEmpty() and found.count() == len(rows)
    want = set()
    for s in {r[0] for r in whole}:
        pool = sorted((r for r in whole if r[0] == s), key=lambda r: (-r[3], r[1]))[:12]
        want |= {(s, r[1], i + 1) for i, r in enumerate(sorted(pool, key=lambda r: -r[2])[:4])}
    out = omics.select_top(df, "cascade", 4)
    assert {(r["sample_id"], r["ord"], r["rank"]) for r in out.collect()} == want and "_abs" not in out.columns
    plan = omics.select_top(df, "cascade", 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # tasks keep the best rows before they are shuffled


def test_one_sequence_in_most_slots(spark, monkeypatch):
    rows = [(f"k{i}", "ACGT" * 10 if i % 50 else "A" * (i // 50 + 3)) for i in range(3000)] + [("none", None)]
    keyed = spark.createDataFrame(rows, "key string, seq string").repartition(4)
    encoder = encode.ToyEncoder(4)
    got = {r["key"]: r["vectors"]["mean"] for r in encode.bulk_embed(keyed, encoder, ["mean"]).collect()}
    assert len(got) == 3000
    for key, seq in (rows[0], rows[1], rows[50], rows[2951]):
        assert got[key] == pytest.approx(encoder.hidden_states([seq])[0].mean(0).tolist(), abs=1e-6)
    # The hot sequence is joined where its slots are: no shuffled task has more than the others' share of them.
    slots = keyed.filter("seq is not null").select("key", encode.sequence_key("seq").alias("hash"), F.lit(-1).alias("w"))
    vectors = slots.select("hash", "w").distinct().withColumn("vec", F.array(F.lit(1.0)))
    assert encode.with_vectors(slots, vectors, ["hash", "w"]).count() == 3000
    monkeypatch.setattr(encode, "HOT", 10)
    plan = encode.with_vectors(slots, vectors, ["hash", "w"])
    cold = plan.filter("hash <> unhex(md5(repeat('ACGT', 10)))").count()
    assert plan.count() == 3000 and cold == 60
    monkeypatch.setattr(encode, "sequence_key", lambda seq: F.unhex(F.md5(F.lit("same"))))
    with pytest.raises(ValueError, match="one hash"):
        encode.bulk_embed(keyed, encoder, ["mean"])


def test_sequences_beside_a_failing_one_keep_their_width(spark):
    from varloom.catalog_files import PickyEncoder
    from varloom.operators import encode

    rows = [("A" * n, w) for n in range(1, 40) for w in (None, 3)]
    found = encode.encode_distinct(spark.createDataFrame(rows, "seq string, w int").coalesce(1), PickyEncoder()).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["vec"] is None) == (len(r["seq"]) % 5 == 0) == (r["error"] is not None)
        assert r["vec"] is None or len(r["vec"]) == 8


def test_encoding_in_tasks(spark):
    from varloom.catalog import rounded, short_text
    from varloom.catalog_files import PickyEncoder

    slot = "array<struct<key:string,seq:string,w:int,back:boolean>>"
    given = [("a", [("k0", "ACGTACG", 3, False), ("k1", "ACGTACG", 4, True), ("k2", None, 1, False), ("k3", "ACGTACG", 3, False)]), ("b", []), ("c", None), ("d", [("k0", "AéGT", None, True), ("k1", "ACGTA", 2, False)])]
    rows = spark.createDataFrame(given, f"id string, x {slot}").coalesce(1)

    for tails in (True, False):
        made = {r["id"]: r["x"] for r in encode.encoded_in_tasks(rows, [PickyEncoder(), encode.ToyEncoder(4)], ["mean", "max"], tails).collect()}
        assert made["b"] == [] and made["c"] is None and made["a"][2]["mean_0"] is None and made["a"][2]["error_0"] is None
        assert made["d"][1]["mean_0"] is None and made["d"][1]["error_0"] == "a length that is a multiple of five" and made["d"][1]["max_1"] is not None
        for (i, k, seq, w) in (("a", 0, "ACGTACG", 3), ("a", 1, "CGTACGT", 4), ("a", 3, "ACGTACG", 3), ("d", 0, "ACéT", None)):
            state = encode.ToyEncoder().hidden_states([seq])[0][-w if w and tails else 0 :]
            assert made[i][k]["mean_0"] == pytest.approx(state.mean(0).tolist(), abs=1e-6) and made[i][k]["max_0"] == pytest.approx(state.max(0).tolist(), abs=1e-6)
            assert made[i][k]["mean_1"] == pytest.approx(state.mean(0)[:4].tolist(), abs=1e-6)
    # A batch that fails is tried by length: calls don't grow with its sequences.
    calls = []

    class Picky(PickyEncoder):
        def hidden_states(self, sequences):
            calls.append(len(sequences))
            return super().hidden_states(sequences)

    states, errors = encode._states(Picky(), ["A" * (3 + i % 4) for i in range(200)])
    assert [e is not None for e in errors] == [i % 4 == 2 for i in range(200)] and [len(s) for s in states[:4]] == [3, 4, 0, 6] and len(calls) == 1 + 4 + 50
    # The queries shuffle no letters: variants go to their groups, and vectors to pairs.
    from varloom import catalog

    plan = catalog.bulk_embed_keyed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    cells = spark.sql("select array(0.03125D,-0.03125D,0.5D,-0.00001D,0.00005D,cast(cast(0.12345 as float) as double),-1.0D,0D,-0.0D) v")
    assert cells.select(short_text(F.col("v"))).first()[0] == cells.select(rounded(F.col("v"), 4)).first()[0]



def test_distinct_slots_of_batches(spark):
    slot = "array<struct<seq:string,w:int,back:boolean>>"
    given = [([("ACG", 3, False), ("CGT", 3, True), ("ACG", 4, False), (None, 1, False)],), ([],), (None,), ([("ACG", 3, False)],)]
    found = encode.distinct_in_tasks(spark.createDataFrame(given, f"x {slot}").coalesce(1))
    assert sorted(map(tuple, found.collect())) == [("ACG", 3, 3), ("ACG", 4, 1)]
    report = encode.cache_report(found, spark.createDataFrame([("TT",), ("ACG",)], "seq string")).first()
    assert tuple(report) == (4, 4, 0, 2)
    # Variants are read and folded once where wanted and cached sequences meet.
    from varloom import catalog

    plan = catalog.cache_misses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan


def test_rows_that_are_alone_are_not_met_by_their_letters(spark, monkeypatch):
    """Rows in two, whatever the bitmap holds; each sequence is encoded once and reported once, and letters of lone ones are not shuffled."""
    from varloom.operators import encode

    rows = [(f"{'ACGT' * (i % 7)}{i % 300:b}", i % 3, 1) for i in range(700)] + [("AC", None, 2), ("AC", None, 2)]
    df = spark.createDataFrame(rows, "seq string, w int, n long").cache()
    seqs = [r[0] for r in rows]
    for bits in (encode.MOST_BITS, 64):
        monkeypatch.setattr(encode, "LEAST_BITS", min(bits, 1 << 16))
        monkeypatch.setattr(encode, "MOST_BITS", bits)
        once, others = encode.apart(df, "seq")
        one, more = [r["seq"] for r in once.collect()], [r["seq"] for r in others.collect()]
        assert sorted(one + more) == sorted(seqs) and len(set(one)) == len(one) and not set(one) & set(more)
        assert bits == 64 or len(one) == sum(seqs.count(s) == 1 for s in set(seqs))
        found = encode.encode_distinct(others, encode.ToyEncoder(), alone=once)
        want = encode.encode_distinct(df, encode.ToyEncoder())
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() == len({r[:2] for r in rows})
    report = encode.cache_report(df, df.filter("length(seq) < 12")).first()
    short = {s for s in seqs if len(s) < 12}
    assert tuple(report) == (sum(r[2] for r in rows), sum(r[2] for r in rows if r[0] in short), len(set(seqs) - short), len(set(seqs)))


def test_cache_queries_shuffle_no_letters_of_lone_sequences(spark):
    """Above the written table lone sequences meet no shuffle: half of each query's plan has none."""
    from varloom import catalog, catalog_files

    for q in (catalog.cache_misses, catalog_files.encode_fallback, catalog.cache_hit_report):
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        branches = plan[plan.index("Union") :].split("Scan parquet")[:-1]
        assert any("hashpartitioning(seq" not in b for b in branches) and "hashpartitioning(seq" in plan
    digests = catalog.digested(spark, "/root/testdata/sf0.001")
    assert digests.schema["seq"].dataType.simpleString() == "binary" and {len(r["seq"]) for r in digests.limit(50).collect()} == {16}
    plan = catalog.distinct_sequences(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "md5" not in plan


def test_vectors_as_text_and_pooling_in_blocks(spark):
    """Texts of vectors as Spark's decimals have them, halves and large cells among them; long states pooled as short ones."""
    import numpy as np

    from varloom import catalog, catalog_files
    from varloom.operators import encode

    x = np.array([[0.03125, -0.03125, -0.00001, 0.99995], [-1, 1, 9.99984, -0.5], [0, -0.0, 0.12345, -0.99996]], dtype=np.float32)
    x = np.concatenate([x, np.random.default_rng(1).uniform(-1, 1, (500, 4)).astype(np.float32)])
    want = [r[0] for r in spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, v array<float>").orderBy("i").select(catalog.short_text(catalog.F.col("v"))).collect()]
    assert encode.vector_texts(x).to_pylist() == want
    assert encode.vector_texts(np.array([[12.5, -123456.75]], dtype=np.float32)).to_pylist() == ["12.5000,-123456.7500"]

    states = [np.random.default_rng(n).normal(size=(n, 3)) for n in (1, 31, 32, 33, 47, 48, 400)]
    owners, widths = np.repeat(np.arange(7), 3), np.tile([-1, 40, 2], 7)
    for method, f in (("mean", np.mean), ("max", np.max), ("last_token", lambda a, axis: a[-1])):
        want = [f(states[o][-w:] if w > 0 else states[o], axis=0) for o, w in zip(owners, widths)]
        assert np.allclose(encode.pool_batch(states, owners, widths, method), want, atol=1e-14)
    made = encode.ToyEncoder().hidden_states(["ACGT" * 20, "AC", ""])
    assert encode.Tokens.of(made) is made and made.flat.shape == (82, 8) and np.shares_memory(made[0], made.flat)
    for q in (catalog.bulk_embed_keyed, catalog.multi_model_embed, catalog.embed_six_vectors, catalog_files.legacy_embed):
        assert "decimal" not in q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_neighbours_are_embedded_without_a_shuffle(spark):
    """The same as by groups, batches of odd sizes among them; rows that are no neighbours are refused."""
    import pytest

    from varloom import catalog
    from varloom.operators import encode
    from varloom.operators import variants as G

    six = G.both_directions(catalog.six(spark, "/root/testdata/sf0.001"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(map(tuple, encode.embed_neighbours(six, encode.ToyEncoder()).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(map(tuple, encode.embed_in_tasks(six, encode.ToyEncoder(), as_text=True).collect())) and len(got) > 1000
    with pytest.raises(Exception, match="not neighbours"):
        encode.embed_neighbours(six.filter("direction = 'upstream'"), encode.ToyEncoder()).collect()
    plan = catalog.embed_six_vectors(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange")
