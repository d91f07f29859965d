"""The training table of a cohort out of notes, vectors and labels, dealt to folds.

A patient's notes (rows of the text table) become numbers of a phenome, the variant vectors become one mean vector, and
the labels one label.  Patients that all three sources have are dealt to stratified folds, and the gaps of the phenome
are filled with medians of the other folds, so that a model that is judged on a fold has seen nothing of it.

    python -m jobs.cohort_table --config jobs/cohort_table.json --documents DIR/documents.parquet ... --output OUT

The table is written as Parquet, a folder for each fold, and a run replaces what an earlier one wrote: the same input gives
the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.operators import learning, omics
from varloom.sources.scratch import kept, new_folder

from .common import command_line, log


@dataclass
class Settings:
    documents: str
    embeddings: str
    labels: str
    output: str
    folds: int = 5
    seed: int = 42
    #: Rows of the tables that are one patient's: ids from n * of to n * of + of - 1.
    notes_of_each: int = 4
    vectors_of_each: int = 1
    fill: str = "median"


def patient(column: str, of_each: int) -> Column:
    return F.concat(F.lit("p"), F.floor(F.col(column) / of_each).cast("string"))


#: Numbers of the phenome; the last two have gaps, where a patient's notes have no word or no sentence.
PHENOME = ("notes", "lines", "words", "digits", "languages", "letters_a_word", "words_a_sentence")
GAPS = PHENOME[-2:]


#: What a byte of a text is: a letter, a digit, the end of a sentence or of a line; others are nothing.
KINDS = {"l": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "d": b"0123456789", "s": b".!?", "n": b"\n"}
_KIND = np.zeros(256, dtype=np.uint8)
for _i, _bytes in enumerate(KINDS.values(), 1):
    _KIND[np.frombuffer(_bytes, dtype=np.uint8)] = _i


def count_texts(texts: pa.Array) -> pa.Array:
    """Runs of letters (w), letters, digits, ends of sentences and line ends of whole texts, none of them null: the bytes of a
    batch are looked up once."""
    texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int32)
    some = np.flatnonzero(np.diff(bounds))
    starts = bounds[some] - bounds[0]
    kinds = _KIND[np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]] if len(some) else _KIND[:0]

    def sums(flags: np.ndarray) -> pa.Array:
        out = np.zeros(len(texts), dtype=np.int64)
        if len(some):
            out[some] = np.add.reduceat(flags, starts, dtype=np.int64)
        return pa.array(out)

    letters = kinds == 1
    begins = letters.copy()
    begins[1:] &= ~letters[:-1]
    begins[starts] = letters[starts]
    return pa.StructArray.from_arrays([sums(begins), *[sums(kinds == i) for i in range(1, len(KINDS) + 1)]], ["w", *KINDS])


def note_phenome(notes: DataFrame, of_each: int) -> DataFrame:
    """sample_id and PHENOME: whole texts are counted; a null text has nothing."""
    counted = F.arrow_udf(count_texts, "struct<w:long,l:long,d:long,s:long,n:long>")
    each = notes.filter("doc_id is not null").select(patient("doc_id", of_each).alias("sample_id"), "lang", counted(F.coalesce("text", F.lit(""))).alias("c"))
    each = each.select("sample_id", "lang", "c.w", "c.l", "c.d", "c.s", (F.col("c.n") + 1).alias("n"))
    total = lambda c: F.sum(c).cast("double")
    return each.groupBy("sample_id").agg(
        F.count("*").cast("double").alias("notes"), total("n").alias("lines"), total("w").alias("words"), total("d").alias("digits"), F.count_distinct("lang").cast("double").alias("languages"),
        F.when(F.sum("w") > 0, total("l") / total("w")).alias("letters_a_word"), F.when(F.sum("s") > 0, total("w") / total("s")).alias("words_a_sentence"),
    )


def cohort(documents: DataFrame, embeddings: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """sample_id, label, fold, embedding and PHENOME of the patients that all sources have."""
    vectors = embeddings.filter("vec_id is not null").select(patient("vec_id", settings.vectors_of_each).alias("sample_id"), F.col("embedding").cast("array<double>").alias("vec"))
    emb = omics.aggregate_vectors(vectors, "vec", "mean").withColumnRenamed("vec", "features")
    pheno = note_phenome(documents, settings.notes_of_each).select("sample_id", F.array(*PHENOME).alias("features"))
    known = labels.filter("doc_id is not null").groupBy(patient("doc_id", settings.notes_of_each).alias("sample_id")).agg(F.max("toxic").cast("int").alias("label")).filter("label is not null")
    matrix = omics.feature_matrix({"emb": emb, "pheno": pheno}, known)
    wide = matrix.select("sample_id", "label", F.col("emb").alias("embedding"), *[F.col("pheno")[i].alias(c) for i, c in enumerate(PHENOME)])
    dealt = learning.stratified_folds(kept(wide), settings.folds, settings.seed)  # the steps below read it several times
    return learning.impute_by_fold(dealt, GAPS, settings.folds, settings.fill)


def run(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """Write the table; gives the numbers of rows read and written, by name (counts of files, which read no column)."""
    sources = {name: spark.read.parquet(getattr(settings, name)) for name in ("documents", "embeddings", "labels")}
    found = {name: source.count() for name, source in sources.items()}
    for name, rows in found.items():
        log.info("reading %s rows of %s", rows, getattr(settings, name))
    table = cohort(*sources.values(), settings).select("sample_id", "label", "embedding", *PHENOME, "fold")
    table.write.mode("overwrite").partitionBy("fold").parquet(settings.output)
    written = spark.read.schema(table.schema).parquet(settings.output).groupBy("label").count().collect()  # a row for each label
    found["output"] = sum(r["count"] for r in written)
    log.info("wrote %s patients (%s) to %s in %s folds", found["output"], ", ".join(f"{r['count']} labelled {r['label']}" for r in sorted(written)), settings.output, settings.folds)
    return found


def job1_cohort_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over the whole tables, twice into the same folder, and what stands there then."""
    where = new_folder(spark, "cohort-table")
    settings = Settings(*[f"{sf_dir}/{t}.parquet" for t in ("documents", "embeddings", "labels")], output=where)
    for _ in range(2):
        run(spark, settings)
    vector = F.concat_ws(",", F.transform("embedding", lambda x: F.format_string("%.4f", F.round(x, 4) + 0.0)))
    return spark.read.parquet(where).select("sample_id", "label", vector.alias("embedding"), *[F.round(c, 6).alias(c) for c in PHENOME], F.col("fold").cast("int").alias("fold"))


_FILLED = ", ".join(f"median({c}) AS m_{c}" for c in GAPS)
ORACLE = f"""
WITH n AS (
  SELECT 'p' || cast(cast(floor(doc_id / 4) as bigint) as varchar) AS sample_id, lang, len(regexp_extract_all(t, '[A-Za-z]+')) AS w, len(regexp_extract_all(t, '[A-Za-z]')) AS l,
         len(regexp_extract_all(t, '[0-9]')) AS d, len(regexp_extract_all(t, '[.!?]')) AS s, length(t) - length(replace(t, chr(10), '')) + 1 AS k
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
p AS (
  SELECT sample_id, cast(count(*) as double) AS notes, cast(sum(k) as double) AS lines, cast(sum(w) as double) AS words, cast(sum(d) as double) AS digits, cast(count(DISTINCT lang) as double) AS languages,
         CASE WHEN sum(w) > 0 THEN sum(l) / cast(sum(w) as double) END AS letters_a_word, CASE WHEN sum(s) > 0 THEN sum(w) / cast(sum(s) as double) END AS words_a_sentence
  FROM n GROUP BY sample_id),
e AS (
  SELECT sample_id, array_to_string(list(printf('%.4f', round(x, 4) + 0.0) ORDER BY i), ',') AS embedding
  FROM (SELECT 'p' || cast(vec_id as varchar) AS sample_id, i, avg(cast(embedding[cast(i as int)] as double)) AS x FROM embeddings, range(1, 65) r(i) GROUP BY ALL) GROUP BY sample_id),
y AS (SELECT 'p' || cast(cast(floor(doc_id / 4) as bigint) as varchar) AS sample_id, cast(max(toxic) as int) AS label FROM labels GROUP BY 1),
f AS (
  SELECT *, cast((row_number() OVER (PARTITION BY label ORDER BY sha256('42:' || sample_id), sample_id) - 1) % 5 as int) AS fold
  FROM y JOIN e USING (sample_id) JOIN p USING (sample_id)),
m AS (SELECT g.k, {_FILLED} FROM f, (SELECT unnest(range(5)) AS k) g WHERE f.fold <> g.k GROUP BY g.k)
SELECT sample_id, label, embedding, {", ".join(f"round({c}, 6) AS {c}" for c in PHENOME[:5])}, {", ".join(f"round(coalesce({c}, m_{c}, 0), 6) AS {c}" for c in GAPS)}, fold
FROM f JOIN m ON f.fold = m.k
"""

if __name__ == "__main__":
    command_line(Settings, run, "The training table of a cohort.")
