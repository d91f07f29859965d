"""The jobs on small files: gaps and odd rows, runs that are repeated, input that grows between runs."""

import json
import os
import statistics
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from jobs import cohort_table, common, sequence_cache

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CALLS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int"


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("cohort"))
    notes = [(4 * i + j, f"Patient {i} has {j} words. " * (i % 3) if j else None, ["en", "de", None][j % 3]) for i in range(30) for j in range(3)] + [(None, "nobody's", "en")]
    spark.createDataFrame(notes, "doc_id long, text string, lang string").withColumn("fold", F.lit(9)).write.parquet(f"{top}/documents")
    spark.createDataFrame([(i, [float(i), 1.0]) for i in range(28)] + [(3, [5.0, 1.0]), (None, [0.0, 0.0])], "vec_id long, embedding array<float>").write.parquet(f"{top}/embeddings")
    spark.createDataFrame([(4 * i, i % 2) for i in range(2, 30)] + [(9, 1), (8, None), (116, None)], "doc_id long, toxic int").write.parquet(f"{top}/labels")
    return top


def cohort_settings(top, out, **more):
    return cohort_table.Settings(f"{top}/documents", f"{top}/embeddings", f"{top}/labels", str(out), **more)


def test_cohort_table(spark, sources, tmp_path):
    settings = cohort_settings(sources, tmp_path / "out", folds=3)
    found = cohort_table.run(spark, settings)
    assert found == {"documents": 91, "embeddings": 30, "labels": 31, "output": 26}
    rows = {r["sample_id"]: r for r in spark.read.parquet(settings.output).collect()}
    assert set(rows) == {f"p{i}" for i in range(2, 28)}
    assert rows["p3"]["embedding"] == [4.0, 1.0] and rows["p2"]["label"] == 1 and rows["p5"]["label"] == 1 and rows["p4"]["label"] == 0
    assert (rows["p4"]["notes"], rows["p4"]["words"], rows["p4"]["languages"]) == (3.0, 6.0, 2.0)
    by_fold = {}
    for r in rows.values():
        by_fold.setdefault(r["fold"], []).append(r)
    assert sorted(map(len, by_fold.values())) == [8, 9, 9]
    for r in rows.values():  # patients without a word have the median of the other folds
        known = [x["words_a_sentence"] for x in rows.values() if x["fold"] != r["fold"] and int(x["sample_id"][1:]) % 3]
        assert r["words_a_sentence"] == (3.0 if int(r["sample_id"][1:]) % 3 else statistics.median(known))


def test_cohort_table_again_and_on_nothing(spark, sources, tmp_path):
    settings = cohort_settings(sources, tmp_path / "out", folds=4)
    read = lambda: sorted(map(str, spark.read.parquet(settings.output).collect()))
    cohort_table.run(spark, settings)
    first = read()
    cohort_table.run(spark, settings)
    assert read() == first
    cohort_table.run(spark, cohort_settings(sources, tmp_path / "out", folds=2))  # fewer folds: none of the old ones stays
    assert {r["fold"] for r in spark.read.parquet(settings.output).select("fold").distinct().collect()} == {0, 1}
    for name in ("documents", "embeddings", "labels"):
        spark.read.parquet(f"{sources}/{name}").filter("false").write.parquet(f"{tmp_path}/none/{name}")
    empty = cohort_table.run(spark, cohort_settings(f"{tmp_path}/none", tmp_path / "empty"))
    assert empty["output"] == 0


def calls(spark, numbers):
    return spark.createDataFrame([(n, 3 * n, n % 5, n % 7) for n in numbers], CALLS)


def held(spark, output):
    back = sequence_cache.read_back(spark, output)
    return sorted((*[r[c] for c in ("chrom", "pos", "ref", "alt", "direction", "slot", "key")], tuple(r["vec"])) for r in back.collect())


def test_sequence_cache_over_growing_input(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    settings = sequence_cache.Settings(src, out, mark, flank=40, files_per_batch=1)
    calls(spark, range(60)).coalesce(1).write.parquet(src)
    assert sequence_cache.run(spark, settings) == 1
    first = held(spark, out)
    assert sequence_cache.run(spark, settings) == 0 and held(spark, out) == first
    calls(spark, range(40, 120)).repartition(2).write.mode("append").parquet(src)  # rows that are there among them
    assert sequence_cache.run(spark, settings) == 2
    second = held(spark, out)
    assert set(first) < set(second)
    whole = sequence_cache.Settings(src, f"{out}-whole", f"{mark}-whole", flank=40)
    sequence_cache.run(spark, whole)
    assert held(spark, whole.output) == second and len({x[:6] for x in second}) == len(second)
    sequences = spark.read.parquet(f"{out}/sequences")
    assert sequences.count() == sequences.select("key").distinct().count()


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    settings = sequence_cache.Settings("calls", str(tmp_path / "out"), str(tmp_path / "mark"), flank=40)
    rows = calls(spark, range(30))
    sequence_cache.take_up(rows.filter("false"), settings)  # a first file without rows leaves tables without rows
    assert held(spark, settings.output) == []
    sequence_cache.take_up(rows, settings)
    before = held(spark, settings.output)
    assert len(before) > 50
    sequence_cache.take_up(rows, settings)
    assert held(spark, settings.output) == before
    # Sequences that were written before a failure are used by the run that follows.
    half = sequence_cache.Settings("calls", str(tmp_path / "half"), str(tmp_path / "mark2"), flank=40)
    spark.read.parquet(f"{settings.output}/sequences").write.partitionBy("prefix").parquet(f"{half.output}/sequences")
    sequence_cache.take_up(rows, half)
    assert held(spark, half.output) == before
    sequence_cache.take_up(rows.filter("false"), half)
    assert held(spark, half.output) == before


def test_settings_and_command_line(sources, tmp_path):
    with pytest.raises(ValueError, match="unknown settings: fold"):
        common.read_config(cohort_table.Settings, json.dumps({"fold": 3}))
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"documents": f"{sources}/documents", "embeddings": f"{sources}/embeddings", "labels": f"{sources}/labels", "output": "nowhere"}))
    for name in ("cohort_table", "sequence_cache"):
        kind = getattr(sys.modules[f"jobs.{name}"], "Settings")
        with open(f"{TOP}/jobs/{name}.json") as f:
            common.read_config(kind, f.read())
    done = subprocess.run(
        [sys.executable, "-m", "jobs.cohort_table", "--config", str(config), "--output", str(tmp_path / "out"), "--folds", "3"],
        cwd=TOP, capture_output=True, text=True, timeout=300, env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"},
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert "wrote 26 patients" in done.stderr and sorted(x for x in os.listdir(tmp_path / "out") if x.startswith("fold")) == ["fold=0", "fold=1", "fold=2"]


def test_notes_are_counted_by_bytes_of_whole_texts(spark):
    """As the expressions count, over texts next to one another, empty and null ones; none is searched by an expression."""
    import random
    import re

    from jobs import cohort_table

    rng = random.Random(5)
    texts = ["".join(rng.choices("aBz19.!? \n\t_é\U0001f600", k=rng.randrange(30))) for _ in range(400)] + ["", None, "", "a", "a"]
    notes = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    out = cohort_table.note_phenome(notes, 1)
    assert "regexp_count" not in out._jdf.queryExecution().optimizedPlan().toString()
    many = lambda pattern, t: len(re.findall(pattern, t or ""))
    want = {f"p{i}": (many("\n", t) + 1, many("[A-Za-z]+", t), many("[0-9]", t), many("[A-Za-z]", t) / w if (w := many("[A-Za-z]+", t)) else None, w / s if (s := many("[.!?]", t)) else None) for i, t in enumerate(texts)}
    assert {r["sample_id"]: (r["lines"], r["words"], r["digits"], r["letters_a_word"], r["words_a_sentence"]) for r in out.collect()} == want
