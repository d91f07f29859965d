"""A corpus pipeline of five stages, each one operator of ``varloom.llm``.

run() applies STAGES to ``documents``; each stage's result is written and read again as the next one's
input.  All stages but the last return the columns of ``documents``.

Stages decide on rows, not on ids: rows that repeat an id, and rows without one, are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.best_fit_packing import best_fit_packing
from varloom.llm.common import cut, small_batches, table
from varloom.llm.exact_dedup import exact_dedup
from varloom.llm.fragment_join import jaccard_components
from varloom.llm.kernel_language import HELD_OUT as LANGUAGE_HELD_OUT
from varloom.llm.kernel_language import identify_language
from varloom.llm.kneser_ney_toxicity import HELD_OUT as TOXICITY_HELD_OUT
from varloom.llm.kneser_ney_toxicity import score_toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Numbers of dropped rows that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Bits of a row's number that are its place in its file.
PLACE = 40


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of its own for each row, the same whenever it is read.

    Rows read from Parquet files are numbered by file and place, which costs no copy of the texts; others are
    written once with their number.
    """
    plan = docs._jdf.queryExecution()
    if plan.analyzed().getClass().getSimpleName() != "LogicalRelation" or "FileScan parquet" not in plan.executedPlan().toString():
        return cut(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "numbered")
    files = sorted(r[0] for r in docs.select("_metadata.file_path").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(zip(files, range(len(files)), strict=True)), "_path string, _file long")
    placed = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("_at"), F.col("_metadata.row_index").alias("_place"))
    row = F.shiftleft("_file", PLACE).bitwiseOR(F.col("_place")).alias("_row")
    return placed.join(F.broadcast(numbers), F.col("_at") == F.col("_path")).select(*COLUMNS, row)


def _drop(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows but those whose number is in ``dropped``.  Texts are not shuffled while these are few."""
    dropped = cut(dropped.select(F.col("_row").alias("_dropped")), "dropped")
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return rows.join(dropped, F.col("_row") == F.col("_dropped"), "left_anti").select(*COLUMNS)


def _drop_others(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Of each group (_row, group) the row with the smallest id stays, or the first if ids are equal; one
    without an id only if none has one."""
    groups = cut(groups, "groups")
    placed = groups.join(rows.select("_row", "doc_id"), "_row")
    first = placed.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("m")).select("m._row")
    return _drop(rows, groups.join(first, "_row", "left_anti"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score_toxicity predicts as toxic go."""
    small_batches(spark)
    rows = _numbered(docs)
    scored = score_toxicity(rows, table(spark, sf_dir, "labels"), train=f"not ({TOXICITY_HELD_OUT})", row_col="_row")
    return _drop(rows, scored.filter("predicted <> 0"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; lettered ones stay, even where there is nothing to learn languages from."""
    small_batches(spark)
    rows = _numbered(docs)
    return _drop(rows, identify_language(rows, train=f"not ({LANGUAGE_HELD_OUT})", row_col="_row").filter("not letters"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    small_batches(spark)
    rows = _numbered(docs)
    return _drop_others(rows, exact_dedup(rows, id_col="_row").select("_row", F.col("keep_id").alias("group")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays."""
    small_batches(spark)
    rows = _numbered(docs)
    return _drop_others(rows, jaccard_components(rows, id_col="_row").select("_row", F.col("component_id").alias("group")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("language", drop_unidentified), ("exact dedup", drop_copies), ("near dedup", drop_near_copies), ("packing", pack)]
#: The classifiers and the packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
