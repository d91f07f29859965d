"""Whole runs on small files, against worked values and properties."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.operators import learning, metrics, omics, store
from varloom.operators import variants as G
from varloom.plans import multiomics, personal, settings
from varloom.sources import files
from varloom.streaming import ingest


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    top = tmp_path_factory.mktemp("inputs")
    head = "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT s0 s1".split())
    genome = "ACGT" * 750
    calls = [(300, "T", "A", "1|1", "0|0"), (310, "C", "G", "1|0", "0|1"), (400, "T", "TAC", "1|0", "1|1"), (900, "T", "C", ".|.", "1|0"), (2000, "T", "G", "1|1", "1|1")]
    lines = ["##fileformat=VCFv4.2", head, *["\t".join(["chr1", str(p), ".", r, a, ".", ".", ".", "GT", *g]) for p, r, a, *g in calls]]
    (top / "v.vcf").write_text("\n".join(lines) + "\n")
    (top / "r.bed").write_text("# regions\nchr1\t250\t1000\tx\nchr1 280 450\nchr2\t1\t2\n")
    wrapped = "\n".join(genome[i : i + 60] for i in range(0, len(genome), 60))
    (top / "g.fa").write_text(f">chr1 test\n{wrapped}\n>chr2\nACGTAC\n")
    return top


def config(inputs, out, **more):
    return settings.variant_settings({"vcf_path": f"{inputs}/v.vcf", "bed_path": f"{inputs}/r.bed", "ref_fasta": f"{inputs}/g.fa", "output_dir": str(out), "bed_split": {"n": 128}, "embedding": {"pooling": "mean"}}, **more)


def test_variants_to_vectors_and_resume(spark, inputs, tmp_path):
    cfg = config(inputs, tmp_path / "o")
    assert {(r["sample_id"], r["pos"]) for r in personal.read_variants(spark, cfg).collect()} == {("s0", 300), ("s0", 310), ("s0", 400), ("s1", 310), ("s1", 400), ("s1", 900)}
    out = personal.run(spark, cfg)
    held = files.read_store(spark, out["embeddings"])
    assert held.count() == 6 * 6 and held.filter(F.size("vec") != 16).isEmpty()
    personal.run(spark, cfg)
    assert files.read_store(spark, out["embeddings"]).count() == 36
    assert spark.read.parquet(out["haplotypes"]).count() == 12
    only = personal.run(spark, config(inputs, tmp_path / "p", do_inference=False))
    assert set(only) == {"haplotypes"}


def test_prebuilt_haplotypes_give_the_same_mutants(spark, inputs, tmp_path):
    rows = personal.read_variants(spark, config(inputs, tmp_path))
    six = personal.build_sequences(rows, files.read_fasta(spark, f"{inputs}/g.fa"), 128)
    table = store.haplotype_table(six)
    again = G.six_of_haplotypes(six.drop("hap1", "hap2", "reference", "mut_ref"), table)
    pick = lambda df: {(r["sample_id"], r["pos"], r["direction"]): (r["hap1"]["mut"], r["hap2"]["mut"], r["hap1"]["wt_is_alias"]) for r in df.collect()}
    assert pick(six) == pick(again)
    assert store.describe_haplotypes(table).first()["samples"] == 2
    assert G.missing_haplotypes(six.filter("sample_id = 's0'"), table.filter("sample_id = 's1'")).count() == 6
    assert len(store.haplotype_table_name("a", "b")) == 12


def test_settings_precedence(tmp_path):
    raw = {"output": {"save_haplotypes": False, "save_embeddings": False}, "embedding": {"save_embeddings": True}}
    got = settings.variant_settings(raw)
    assert not got.save_haplotypes and got.save_embeddings
    assert settings.variant_settings(raw, save_haplotypes=True).save_haplotypes
    assert not settings.variant_settings(raw, do_inference=False).save_embeddings
    settings.save_settings(got, str(tmp_path / "s.json"))
    assert settings.load_variant_settings(str(tmp_path / "s.json")) == got
    with pytest.raises(ValueError):
        settings.omics_settings({"cv": {"fold": 3}})
    with pytest.raises(ValueError):
        settings.variant_settings({"embedding": {"pooling": "sum"}})


def test_multiomics(spark, tmp_path):
    rng = random.Random(5)
    (tmp_path / "emb").mkdir()
    labels, metab = ["sample_id,label"], ["sample_id,m0,m1,note"]
    for i in range(60):
        y = i % 2
        vectors = {k: [rng.gauss(y * 2, 1) * (1 if k == "Mut_hap1" else 0.1) for _ in range(4)] for k in multiomics.KEYS}
        (tmp_path / "emb" / f"p{i}.json").write_text(json.dumps({"embeddings": {"v1": {"toy": vectors}, "v2": {"toy": vectors}}}))
        labels.append(f"p{i},{y}")
        metab.append(f"p{i},{'' if i % 9 == 0 else rng.gauss(y, 1)},{rng.random()},x")
    (tmp_path / "l.csv").write_text("\n".join(labels))
    (tmp_path / "m.csv").write_text("\n".join(metab))
    cfg = settings.omics_settings({
        "data": {"embedding_path": f"{tmp_path}/emb", "metabolome_path": f"{tmp_path}/m.csv", "phenome_path": f"{tmp_path}/none.csv", "label_path": f"{tmp_path}/l.csv"},
        "cv": {"folds": 3}, "ablation": {"modules": ["emb", "emb_metab", "all"]}, "models": ["logistic"], "grids": {"logistic": {"regParam": [0.01]}}, "top_k": 1, "output_dir": f"{tmp_path}/out",
    })
    out = multiomics.run(spark, cfg)
    summary = {r["module"]: r["mean_score"] for r in out["summary"].collect()}
    assert set(summary) == {"emb", "emb_metab"} and min(summary.values()) > 0.85
    assert out["predictions"].count() == 120
    assert spark.read.csv(f"{tmp_path}/out/summary", header=True).count() == 2
    assert {(r["model"], r["folds"], r["best_params"]) for r in out["cv"].collect()} == {("logistic", 3, "[('regParam', 0.01)]")}
    assert out["metrics"].count() == 1 and callable(out["predict"]) and out["params"].count() == 2
    named = out["importances"]()
    assert [rank for _, _, rank in named] == list(range(1, len(named) + 1)) and {n for n, _, _ in named} >= {"emb_pca_0"}


def test_vectors_only_of_the_samples_asked_for(spark, tmp_path, monkeypatch):
    rows = [(f"p{i}", "v", "toy", "Mut_hap1", [float(i)]) for i in range(6)]
    store.write_store(spark.createDataFrame(rows, "sample_id string, variant_id string, model string, key string, vec array<float>"), str(tmp_path / "s"))
    wanted = spark.createDataFrame([("p1",), ("p4",), ("none",), (None,)], "sample_id string")
    few = multiomics.of_samples(files.read_store(spark, str(tmp_path / "s")), wanted)
    assert "PartitionFilters: [isnotnull(sample_id" in few._jdf.queryExecution().toString() or "PartitionFilters: [sample_id" in few._jdf.queryExecution().toString()
    monkeypatch.setattr(multiomics, "NAMED", 1)
    for got in (few, multiomics.of_samples(files.read_store(spark, str(tmp_path / "s")), wanted)):
        assert {r["sample_id"] for r in got.collect()} == {"p1", "p4"}


def test_repeated_ids_are_refused(spark):
    labels = spark.createDataFrame([("a", 1), ("b", 0)], "sample_id string, label int")
    once = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "sample_id string, features array<double>")
    assert omics.feature_matrix({"emb": once}, labels).count() == 2
    for matrix in (omics.feature_matrix({"emb": once.union(once.limit(1))}, labels), omics.feature_matrix({"emb": once}, labels.union(labels.limit(1)))):
        with pytest.raises(Exception, match="more than once"):
            matrix.collect()


def test_rows_without_a_score_are_not_chosen(spark):
    rows = [("s", 0, 0.5, 1.0, 9.0), ("s", 1, None, None, 1.0), ("s", 2, 0.7, 2.0, None), ("t", 0, None, None, None)]
    df = spark.createDataFrame(rows, "sample_id string, ord int, relative double, absolute double, delta double")
    for how, want in {"relative": {0, 2}, "absolute": {0, 2}, "weighted": {0, 2}, "cascade": {0, 2}, "delta": {0, 1}}.items():
        assert {(r["sample_id"], r["ord"]) for r in omics.select_top(df, how, 3).collect()} == {("s", i) for i in want}
    shares = {r["ord"]: r["weighted"] for r in omics.select_top(df, "weighted", 3).collect()}
    assert shares == {0: 0.0, 2: 1.0}
    assert omics.select_top(df, "relative", 0).count() == 4


def test_names_dealt_in_turn(spark):
    rng = random.Random(3)
    names = [f"n{rng.randrange(10**6):06d}" for _ in range(5000)] + [None, "ä", ""]
    df = spark.createDataFrame([(n,) for n in names * 2], "sample_id string")
    order = [None, *sorted(set(names) - {None})]
    assert {r["sample_id"]: r["bucket"] for r in store.round_robin(df, 7).collect()} == {n: i % 7 for i, n in enumerate(order)}
    assert store.round_robin(df.limit(0), 3).count() == 0 and store.round_robin(spark.range(3), 2, "id").count() == 3


def test_models_and_their_parameters(spark):
    with pytest.warns(UserWarning, match="takes no depth"):
        learning.create_model("logistic", 2, depth=3, regParam=0.1)
    with pytest.raises(ValueError):
        learning.create_model("forest", 2)
    results = spark.createDataFrame([("svm", 0, 0.5, "[('a', 1)]"), ("svm", 1, 0.7, "[('a', 2)]"), ("svm", 2, 0.7, "[('a', 3)]")], "model string, fold int, score double, params string")
    row = learning.cv_summary(results).first()
    assert row["folds"] == 3 and math.isclose(row["mean_score"], 1.9 / 3) and learning.read_params(row["best_params"]) == {"a": 2}
    with pytest.raises(ValueError):
        omics.select_features(results, "params", [])
    rows = spark.createDataFrame([(i, i % 2, [float(i % 2), 1.0 + i % 3]) for i in range(40)], "sample_id long, label int, features array<double>")
    found = learning.fit_final(rows, "logistic", {"regParam": 0.01})(rows.drop("label")).collect()
    assert all(r["pred"] == r["sample_id"] % 2 for r in found)


def test_evaluation_of_each_module(spark):
    rows = [("all", "svm", i % 2, (i * 7 % 20) / 20, int(i * 7 % 20 > 9)) for i in range(20)] + [("emb", "svm", i % 2, float(i % 2), i % 2) for i in range(10)]
    out = multiomics.evaluated(spark.createDataFrame(rows, "module string, model string, label int, score double, pred int"))
    assert {r["module"]: (r["rank"], r["tp"] + r["fp"] + r["tn"] + r["fn"]) for r in out["metrics"].collect()} == {"emb": (1, 10), "all": (2, 20)}


def test_reducer_equals_numpy(spark):
    x = np.random.default_rng(0).normal(size=(30, 5)) * [1, 2, 3, 4, 5]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "sample_id long, emb array<double>")
    got = np.array([r["emb"] for r in learning.fit_reducer(df, "emb", 3)(df).orderBy("sample_id").collect()])
    z = (x - x.mean(0)) / x.std(0)
    want = z @ np.linalg.svd(z, full_matrices=False)[2][:3].T
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8)


def test_split_and_fill(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "sample_id long, label int")
    train, test = learning.train_test_split(df, 0.25)
    assert test.count() == 50 and test.filter("label = 1").count() == 5 and train.join(test, "sample_id").isEmpty() and train.count() == 150
    holes = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), 4.0), (3, 2.0, 10.0)], "sample_id long, a double, b double")
    rows = {r["sample_id"]: (r["a"], r["b"]) for r in learning.fill_matrix(holes, ["a", "b"]).collect()}
    assert rows[1] == (1.0, 3.0) and rows[2] == (3.0, 4.0)


def test_curves_with_many_scores(spark):
    rng = random.Random(8)
    data = [(int(rng.random() < 0.3), round(rng.random(), 3)) for _ in range(3000)]
    df = spark.createDataFrame(data, "label int, score double")
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(metrics.roc_auc(df).first()[0], want, abs_tol=1e-12)
    points = metrics.roc_curve(df).orderBy(F.desc("threshold")).collect()
    assert all(a["fpr"] <= b["fpr"] and a["tpr"] <= b["tpr"] for a, b in zip(points, points[1:])) and points[-1]["tpr"] == points[-1]["fpr"] == 1.0
    assert metrics.roc_auc(df.filter("label = 1")).first()[0] == 0.5


def test_archives(spark, tmp_path):
    rows = [("s1", "v1", "toy", "Mut_hap1", [1.0, 2.0]), ("s1", "v2", "toy", "WT_ref", [3.0]), ("s2", "v1", "toy", "Mut_hap1", [4.0])]
    df = spark.createDataFrame(rows, "sample_id string, variant_id string, model string, key string, vec array<float>")
    store.write_archives(df, str(tmp_path / "n"))
    assert sorted(map(tuple, files.read_sample_npz(spark, str(tmp_path / "n")).collect())) == rows


def test_incremental_genotypes(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    one = [("s0", "chr1", 5, "A", "T", "1|0"), ("s0", "chr1", 5, "A", "T", "1|0"), ("s1", "chr1", 6, "A", "T", "0|0")]
    spark.createDataFrame(one, ingest.GENOTYPES).write.parquet(src)
    ingest.ingest_genotypes(spark, src, out, mark).awaitTermination()
    assert spark.read.parquet(out).count() == 1
    spark.createDataFrame([*one, ("s2", "chr1", 5, "A", "T", "1/1")], ingest.GENOTYPES).write.mode("append").parquet(src)
    ingest.ingest_genotypes(spark, src, out, mark).awaitTermination()
    assert {(r["sample_id"], r["a1"]) for r in spark.read.parquet(out).collect()} == {("s0", 1), ("s2", 1)}


def test_event_counts(spark):
    rows = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "b", 3.0)], "ts string, event_type string, value double")
    got = {(str(r["start"])[11:13], r["event_type"]): (r["n"], r["total"]) for r in ingest.event_counts(rows).collect()}
    assert got == {("00", "a"): (2, 3.0), ("01", "b"): (1, 3.0)}


def test_columns_without_a_modality():
    assert learning.infer_columns(["emb_pca_0", "a", "emb_1"], 5) == (["emb_pca_0", "emb_1"], ["a"])
    assert learning.infer_columns(list("abcdef"), 2) == (["a", "b"], list("cdef")) and learning.infer_columns(list("abcde"), 99) == (["a", "b"], list("cde"))


def test_a_cleared_store(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "v1", "toy", "Mut_hap1", [1.0])], store.VECTORS)
    for fmt in ("parquet", "json"):
        path = str(tmp_path / fmt)
        store.write_store(rows, path, fmt)
        store.clear_store(spark, path, fmt)
        assert files.read_store(spark, path, fmt).count() == 0
        store.write_store(rows, path, fmt)
        assert files.read_store(spark, path, fmt).count() == 1
