"""Toxicity by class-conditional Kneser-Ney models of expressions.

An expression is a word (a run of letters, lower-cased).  Its log-likelihood under a class is that of its
characters, each given the four before it, in an interpolated Kneser-Ney model: counts of the class, less
the class discount, backed off to counts that both classes share (and those to shared continuation counts
of shorter contexts).  The class discount is large, so an n-gram that few documents of a class hold has
the shared likelihood under both: rare expressions are judged by shared counts, inflected ones by their
stems.  An expression that neither class makes ``EVIDENCE`` nats likelier than the other is given the
shared likelihood as a whole.  Counts are of documents, so one long document can't outweigh others.

A document's two log-likelihoods are the sums of its expressions', divided by their number; the score is the
logistic function of the difference of the two, less a threshold, times a slope.  The threshold is the one with the
fewest errors (classes weigh the same) on labelled documents that the models scoring them didn't see (two
halves, crossed), the slope follows from its distance to the ordinary documents' median.

Models and threshold are fitted on a bounded sample: of each class the labelled rows with the smallest hashed ids,
``PER_CLASS`` and ``SAMPLE_BYTES`` of text (the row that reaches it included) at most.  Scoring reads every row and
the whole text.

Null text counts as empty; a text without expressions has a difference of 0.  With fewer than two
documents of a class to learn from all scores are 0.  A document with several labels is toxic if any label
says so; labels with a null id or a null or other class are not learned from.  Rows that repeat an id are
scored each by their own text, and labelled alike; rows with a null id are scored and never learned from.
An empty table gives an empty result.  Further columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import as_text, blocks, cut, release, released, sliced, table

#: Length of n-grams, discount of shared counts, discount of class counts.
ORDER, DISCOUNT, CLASS_DISCOUNT = 5, 0.75, 4.0
#: Nats by which an expression's likelihoods must differ to count.
EVIDENCE = 4.0
#: Bounds of the sample for each class: rows, bytes of text.
PER_CLASS, SAMPLE_BYTES = 3000, 16 << 20
#: Expressions (and their characters) a task remembers the ratio of; n-grams it works on at once.
TABLE_ROWS, TABLE_CHARS, GRAMS = 200_000, 4_000_000, 1 << 17
#: The model of all counts; the others are known by the half whose texts they judge.
WHOLE = 2
#: Characters that the model tells apart at the lowest level.
ALPHABET = 300
WORD = re.compile(r"[^\W\d_]+")
#: Stand for the start and the end of an expression (no letters).
START, END = 2, 3


def expressions(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _padded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points with starts and ends, where each n-gram begins, whose it is)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(lengths + ORDER) - lengths - ORDER
    flat = np.full(int(lengths.sum()) + ORDER * len(words), START, dtype=np.uint32)
    before = lambda n: np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    flat[np.repeat(begin, lengths) + ORDER - 1 + before(lengths)] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    flat[begin + ORDER - 1 + lengths] = END
    count = lengths + 1
    return flat, np.repeat(begin, count) + before(count), np.repeat(np.arange(len(words)), count)


def _key(grams: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of code points."""
    h = np.full(len(grams), grams.shape[1], dtype=np.uint64)
    for column in grams.T:
        h = (h + column) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


class ClassModels:
    """Log-likelihood ratios of toxic to ordinary: of n-grams, and of contexts for n-grams not seen.

    An unseen n-gram in a seen context backs off to the same shared value under both classes, so its
    ratio depends on the context alone; in an unseen context the ratio is 0.
    """

    def __init__(self, words: list[str], toxic: np.ndarray, ordinary: np.ndarray):
        used = np.flatnonzero(toxic + ordinary)
        toxic, ordinary = toxic[used], ordinary[used]
        flat, at, who = _padded([words[i] for i in used])
        grams = flat[at[:, None] + np.arange(ORDER)]
        self.keys, first, same = np.unique(_key(grams), return_index=True, return_inverse=True)
        grams = grams[first]
        counts = [np.bincount(same, weights=np.asarray(n, dtype=np.float64)[who], minlength=len(grams)) for n in (toxic, ordinary)]
        shared = self._shared(grams, counts[0] + counts[1])
        self.contexts, context = np.unique(_key(grams[:, :-1]), return_inverse=True)
        likelihoods, kept = [], []
        for n in counts:
            total = np.bincount(context, weights=n)
            spare = np.where(total > 0, np.bincount(context, weights=np.minimum(n, CLASS_DISCOUNT)) / np.maximum(total, 1), 1.0)
            kept.append(spare)
            likelihoods.append(np.maximum(n - CLASS_DISCOUNT, 0) / np.maximum(total[context], 1) + spare[context] * shared)
        self.seen = np.log(likelihoods[0] / likelihoods[1]).astype(np.float32)
        self.unseen = np.log(kept[0] / kept[1]).astype(np.float32)

    #: The arrays that a model consists of, and their types.
    PARTS = {"keys": np.uint64, "seen": np.float32, "contexts": np.uint64, "unseen": np.float32}

    def packed(self) -> list[bytes]:
        return [getattr(self, name).tobytes() for name in self.PARTS]

    @classmethod
    def unpacked(cls, parts) -> ClassModels:
        out = cls.__new__(cls)
        for (name, kind), raw in zip(cls.PARTS.items(), parts, strict=True):
            setattr(out, name, np.frombuffer(raw, dtype=kind))
        return out

    @staticmethod
    def _shared(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Kneser-Ney likelihoods of the distinct ``grams``: each shorter one counts the longer ones it ends."""
        levels = []
        while True:
            context = np.unique(_key(grams[:, :-1]), return_inverse=True)[1]
            total, kinds = np.bincount(context, weights=counts)[context], np.bincount(context)[context]
            if grams.shape[1] == 1:
                levels.append((counts, total, kinds, None))
                break
            _, first, shorter = np.unique(_key(grams[:, 1:]), return_index=True, return_inverse=True)
            levels.append((counts, total, kinds, shorter))
            grams, counts = grams[first, 1:], np.bincount(shorter).astype(np.float64)
        p = np.zeros(0)
        for counts, total, kinds, shorter in reversed(levels):
            below = 1 / ALPHABET if shorter is None else p[shorter]
            p = (np.maximum(counts - DISCOUNT, 0) + DISCOUNT * kinds * below) / total
        return p

    def ratios(self, words: list[str]) -> np.ndarray:
        """The log-likelihood ratio of each expression, 0 without enough evidence."""
        out = np.zeros(len(words))
        if not len(self.keys):
            return out
        flat, at, who = _padded(words)
        for begin in range(0, len(at), GRAMS):
            grams = flat[at[begin : begin + GRAMS, None] + np.arange(ORDER)]
            found = []
            for known, values, keys in ((self.keys, self.seen, _key(grams)), (self.contexts, self.unseen, _key(grams[:, :-1]))):
                place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                found.append((known[place] == keys, values[place]))
            (hit, seen), (near, unseen) = found
            out += np.bincount(who[begin : begin + GRAMS], weights=np.where(hit, seen, np.where(near, unseen, 0)), minlength=len(words))
        return np.where(np.abs(out) >= EVIDENCE, out, 0.0)


class Differences:
    """Length-normalised log-likelihood differences of texts; each distinct expression is worked out once."""

    def __init__(self, models: ClassModels):
        self.models, self.known, self.chars = models, {}, 0

    def of(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for begin, end in blocks(texts):
            each = [expressions(t) for t in texts[begin:end]]
            new = sorted(set().union(*each).difference(self.known))
            if self.known and (len(self.known) + len(new) > TABLE_ROWS or self.chars > TABLE_CHARS):
                self.known, self.chars = {}, 0
                new = sorted(set().union(*each))
            if new:
                self.known.update(zip(new, self.models.ratios(new).tolist(), strict=True))
                self.chars += sum(map(len, new))
            out[begin:end] = [sum(map(self.known.__getitem__, words)) / len(words) if words else 0.0 for words in each]
        return out


def fit_threshold(toxic: np.ndarray, difference: np.ndarray) -> tuple[float, float]:
    """(threshold, slope): between the two values where the fewest are on the wrong side, classes weighing the same."""
    order = np.argsort(difference, kind="stable")
    d, y = difference[order], toxic[order] == 1
    below, above = np.cumsum(y) / max(1, y.sum()), 1 - np.cumsum(~y) / max(1, (~y).sum())
    errors = np.where(np.append(d[1:] > d[:-1], False), below + above, np.inf)  # a cut behind each place
    if not np.isfinite(errors).any():
        return float(d[0]) + 1.0, 4.0
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    at = best[np.argmax(d[best + 1] - d[best])]
    threshold = float(d[at] + d[at + 1]) / 2
    return threshold, 4.0 / max(threshold - float(np.median(d[~y])), 1e-9)


def _sample(docs: DataFrame, labels: DataFrame, train: str, id_col: str, text_col: str) -> DataFrame:
    """id, toxic, half: the rows to learn from, within the bounds."""
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter("id is not null and toxic in (0, 1)")
    marked = marked.groupBy("id").agg(F.max("toxic").alias("toxic")).filter(train)
    sizes = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("bytes"))
    marked = marked.join(sizes.groupBy("id").agg(F.sum("bytes").alias("bytes")), "id")
    hashed = (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)).alias("hash")
    marked = cut(marked.select("id", "toxic", "bytes", hashed), "toxic-labels")
    count = marked.groupBy("toxic").agg(F.count("*").alias("n"))
    near = marked.join(F.broadcast(count), "toxic").filter(F.col("hash") * F.col("n") < PER_CLASS * 1.1 + 100)
    order = Window.partitionBy("toxic").orderBy("hash", "id")
    held = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    near = near.withColumns({"r": F.row_number().over(order), "held": held})
    return cut(near.filter((F.col("r") <= PER_CLASS) & (F.col("held") < SAMPLE_BYTES)).select("id", "toxic", F.pmod("r", F.lit(2)).alias("half")), "toxic-sample")


def score_toxicity(docs: DataFrame, labels: DataFrame, train: str = "true", id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """id, score, predicted: one row per input row.  ``train``: SQL condition on ``id`` for labels to learn from.
    With ``row_col``, that number of the row stands in the id's place in what is returned."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(row_col or id_col).cast("long").alias("row"), F.col(text_col).cast("string").alias("text"))
    sample = _sample(docs, labels, train, id_col, text_col)
    chosen = cut(source.join(F.broadcast(sample), "id"), "toxic-texts")

    def held(batches):
        for batch in batches:
            words = [sorted(set(expressions(t))) for t in as_text(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("half"), pa.array(words, pa.list_(pa.string()))], ["toxic", "half", "words"])

    # The expressions of the bounded sample, with the documents of each class and half that hold them.
    columns = [f"n{c}{h}" for c in (0, 1) for h in (0, 1)]
    counted = cut(
        chosen.select("toxic", "half", "text")
        .mapInArrow(sliced(held), "toxic int, half int, words array<string>")
        .select("toxic", "half", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(*[F.count_if((F.col("toxic") == c) & (F.col("half") == h)).alias(f"n{c}{h}") for c in (0, 1) for h in (0, 1)]),
        "toxic-words",
    )
    if not all(counted.agg(*[F.sum(c).alias(c) for c in columns]).first()):
        return source.select(F.col("row").alias(row_col or id_col), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    def fit(words):
        which = int(words["which"].iloc[0])
        halves = (0, 1) if which == WHOLE else (1 - which,)
        toxic, ordinary = (sum(words[f"n{c}{h}"].to_numpy() for h in halves) for c in (1, 0))
        return pd.DataFrame([(which, *ClassModels(words["word"].tolist(), toxic, ordinary).packed())], columns=["which", *ClassModels.PARTS])

    # Models are fitted in tasks: one for the texts of each half, of the other half's counts, and one of all counts.
    models = counted.withColumn("which", F.explode(F.array(F.lit(0), F.lit(1), F.lit(WHOLE))))
    models = cut(models.groupBy("which").applyInPandas(released(fit), f"which int, {', '.join(f'{x} binary' for x in ClassModels.PARTS)}"), "toxic-models")
    fetched = lambda which: ClassModels.unpacked(models.filter(F.col("which") == which).select(*ClassModels.PARTS).first())
    crossed = spark.sparkContext.broadcast([fetched(h) for h in (0, 1)])

    def unseen(batches):
        differences = [Differences(x) for x in crossed.value]
        for batch in batches:
            half, texts = np.array(batch.column("half").to_pylist()), as_text(batch.column("text"))
            out = np.zeros(len(texts))
            for h in (0, 1):
                at = np.flatnonzero(half == h)
                out[at] = differences[h].of([texts[i] for i in at])
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(out, pa.float64())], ["toxic", "difference"])

    # One number for each row of the bounded sample.
    fitted = chosen.select("toxic", "half", "text").mapInArrow(sliced(unseen), "toxic int, difference double").toPandas()
    threshold, slope = fit_threshold(fitted["toxic"].to_numpy(), fitted["difference"].to_numpy())
    crossed.destroy()
    del crossed
    model = spark.sparkContext.broadcast(fetched(WHOLE))
    release()

    def score(batches):
        differences = Differences(model.value)
        for batch in batches:
            d = differences.of(as_text(batch.column("text")))
            p = 1 / (1 + np.exp(-np.clip(slope * (d - threshold), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())], ["row", "score", "predicted"])

    return source.select("row", "text").mapInArrow(sliced(score), "row long, score double, predicted int").withColumnRenamed("row", row_col or id_col)


#: Fixed by the contract: rows of this remainder are held out.
HELD_OUT = "crc32(cast(id as string)) % 5 = 0"


def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train=f"not ({HELD_OUT})")
    return found.select("doc_id", F.expr(HELD_OUT.replace("id as", "doc_id as")).alias("held_out"), "score", "predicted")
