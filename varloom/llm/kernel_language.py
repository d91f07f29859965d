"""Language identification with a blended-spectrum string kernel.

Kernel: two texts share the distinct n-grams (1 to 4 bytes of the lower-cased UTF-8) that both hold;
k(x, y) = |shared| / sqrt(|x| |y|), each order of n-grams over its own table of presence bits (hashed from order 2 on).
Nystroem: texts are compared with landmark texts, phi(x) = k(x, Z) K_ZZ^(-1/2); one ridge regression on phi
for each language against the rest.  A batch of texts is scored by one product of its presence matrix, which is
sparse, with the landmarks' and one with the weights.  As the product of the landmark matrix and the weights doesn't
depend on the text it is multiplied out once, before scoring.

The fit uses a bounded sample of labelled texts, those with the smallest hashed ids: ``SAMPLE`` in all, shared out
evenly over the languages, but at most ``PER_LANGUAGE`` and at least ``LEAST`` of each.  Every language that
labels a text is learned, however many there are; the model grows with their number (half a megabyte each).  Everything else
covers all rows and whole texts.

``und`` with score 0 for a null text, one without a letter, and every text if there is no labelled row.  Rows that
repeat an id are judged, and learned from, each by its own text and label; rows with a null id are judged
but not learned from where ``train`` tests the id.  Ties go to the language that is first in the alphabet.  An empty
table gives an empty result.  Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, sliced, table

#: log2 of the table of each n-gram order from 1 on.
TABLES = (8, 14, 16, 16)
PER_LANGUAGE, LEAST, SAMPLE, LANDMARKS, RIDGE = 150, 3, 1200, 400, 1e-4
STARTS = np.concatenate([[0], np.cumsum([1 << b for b in TABLES])])
WIDTH = int(STARTS[-1])
#: Entries of the sparse presence matrix times languages that are held at once.
HELD = 4_000_000
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def ngrams(text: str, seen: np.ndarray) -> np.ndarray:
    """Numbers of the distinct n-grams of the whole text, ascending.  ``seen`` holds WIDTH zeros, before and after."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    step = 1 << 20
    for begin in range(0, len(raw), step):  # blocks that overlap by an n-gram, to bound memory
        x = raw[begin : begin + step + len(TABLES) - 1]
        h = np.zeros(len(x), dtype=np.uint32)
        for n, bits in enumerate(TABLES, 1):
            if len(x) < n:
                break
            h = h[: len(x) - n + 1] * np.uint32(257) + x[n - 1 :]
            seen[STARTS[n - 1] + ((h * _MIX[n - 1]) >> np.uint32(32 - bits) if n > 1 else h)] = 1
    found = np.flatnonzero(seen)
    seen[found] = 0
    return found


def fit_weights(texts: list[np.ndarray], languages: list[str]) -> tuple[list[str], np.ndarray]:
    """(languages, WIDTH x languages weights) from the n-grams of the sample; see the module's text."""
    names = sorted(set(languages))
    y = np.where(np.array(languages)[:, None] == np.array(names)[None], 1.0, -1.0)
    size = np.sqrt(np.maximum([len(x) for x in texts], 1))
    # Landmarks: every language in turn, in the order of the sample.
    times: dict[str, int] = {}
    turn = []
    for i, name in enumerate(languages):
        turn.append((times.get(name, 0), i))
        times[name] = times.get(name, 0) + 1
    landmarks = [i for _, i in sorted(turn)[: max(LANDMARKS, 2 * len(names))]]
    holds = np.zeros((WIDTH, len(landmarks)), dtype=np.uint8)
    for column, i in enumerate(landmarks):
        holds[texts[i], column] = 1
    kernel = np.array([holds[x].sum(0, dtype=np.int64) for x in texts]) / (size[:, None] * size[landmarks])
    values, vectors = np.linalg.eigh(kernel[landmarks])
    good = values > 1e-8 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    phi = kernel @ root
    dual = (root @ np.linalg.solve(phi.T @ phi + RIDGE * len(phi) * np.eye(phi.shape[1]), phi.T @ y)).astype(np.float32)
    weights = np.zeros((WIDTH, len(names)), dtype=np.float32)
    for column, i in enumerate(landmarks):
        weights[texts[i]] += dual[column] / np.float32(size[i])
    return names, weights


def _letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train_sample(docs: DataFrame, condition: str, id_col: str, text_col: str, lang_col: str) -> pd.DataFrame:
    """lang and packed n-gram numbers of the sample's texts: some tens of kB a text, whatever its length."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter(condition).filter("lang is not null and text is not null")
    counts = cut(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    each = max(LEAST, min(PER_LANGUAGE, SAMPLE // max(1, counts.count())))
    # Hashed ids below twice the share that is wanted, then the smallest of those: few rows meet in a window.
    hashed = (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)).alias("hash")
    near = rows.select("id", "lang", "text", hashed).join(counts, "lang").filter(F.col("hash") * F.col("n") < 2 * each + 40).drop("n")

    def numbers(batches):
        seen = np.zeros(WIDTH, dtype=np.uint8)
        for pdf in batches:
            yield pdf.assign(grams=[ngrams(t, seen).astype("<u4").tobytes() for t in pdf["text"]]).drop(columns="text")

    near = near.withColumn("id", F.col("id").cast("long")).mapInPandas(numbers, "id long, lang string, hash double, grams binary")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "id", "grams"))
    # As many rows as the bounds above allow.
    return near.withColumn("r", rank).filter(F.col("r") <= each).select("lang", "r", "grams").toPandas().sort_values(["lang", "r"], ignore_index=True)


class Scores:
    """Scores of texts: the sparse presence matrix of a batch times the weights."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.seen = weights, np.zeros(WIDTH, dtype=np.uint8)

    def of(self, texts: list[str]) -> np.ndarray:
        out, held, most = np.zeros((len(texts), self.weights.shape[1])), [], HELD // self.weights.shape[1]
        begin = at = 0
        for i, text in enumerate(texts):
            held.append(ngrams(text, self.seen))
            at += len(held[-1])
            if at >= most or i == len(texts) - 1:
                sizes = np.array([len(x) for x in held])
                out[begin : i + 1] = np.add.reduceat(self.weights[np.concatenate(held)], np.cumsum(sizes) - sizes) / np.sqrt(sizes)[:, None]
                begin, at, held = i + 1, 0, []
        return out


def identify_language(docs: DataFrame, train: str = "true", id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", row_col: str | None = None) -> DataFrame:
    """id, lang_pred, score: one row per input row.  ``train``: SQL condition on ``id`` for rows to learn from.
    With ``row_col``, that number of the row stands in the id's place in what is returned, and ``letters`` tells
    whether its text has any."""
    spark = docs.sparkSession
    sample = train_sample(docs, train, id_col, text_col, lang_col)
    if sample.empty:
        names, weights = [], np.zeros((WIDTH, 0), dtype=np.float32)
    else:
        names, weights = fit_weights([np.frombuffer(x, dtype="<u4").astype(np.int64) for x in sample["grams"]], sample["lang"].tolist())
    model = spark.sparkContext.broadcast((names, weights))

    def score(batches):
        names, weights = model.value
        scores = Scores(weights) if names else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs, values = ["und"] * len(texts), [0.0] * len(texts)
            letters = [bool(t) and _letter(t) for t in texts]
            rows = [i for i, has in enumerate(letters) if names and has]
            if rows:
                d = scores.of([texts[i] for i in rows])
                for i, best, value in zip(rows, d.argmax(1), d.max(1), strict=True):
                    langs[i] = names[best]
                    # Ridge targets are -1 and 1.
                    values[i] = float(min(1.0, max(0.0, (value + 1) / 2)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(langs, pa.string()), pa.array(values, pa.float64()), pa.array(letters, pa.bool_())], ["row", "lang_pred", "score", "letters"])

    source = docs.select(F.col(row_col or id_col).cast("long").alias("row"), F.col(text_col).cast("string").alias("text"))
    found = source.mapInArrow(sliced(score), "row long, lang_pred string, score double, letters boolean").withColumnRenamed("row", row_col or id_col)
    return found if row_col else found.drop("letters")


#: Fixed by the contract: rows of this remainder are held out.
HELD_OUT = "crc32(cast(id as string)) % 3 = 1"


def op4_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_language(table(spark, sf_dir, "documents"), train=f"not ({HELD_OUT})")
    return found.select("doc_id", F.expr(HELD_OUT.replace("id as", "doc_id as")).alias("held_out"), "lang_pred", "score")
