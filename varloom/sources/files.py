"""Readers of interval, genotype and genome files, of sample records and of tabular sources."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Bases in one row of a genome table.
CHUNK = 65_536


def parse_bed(lines: DataFrame) -> DataFrame:
    """chrom, start, end, name of text lines (column value).  Comments, blanks and short rows are left out."""
    fields = F.split(F.trim("value"), r"\s+")
    rows = lines.filter((F.trim("value") != "") & ~F.trim("value").startswith("#")).select(fields.alias("f")).filter(F.size("f") >= 3)
    rows = rows.select(F.col("f")[0].alias("chrom"), F.expr("try_cast(f[1] as bigint)").alias("start"), F.expr("try_cast(f[2] as bigint)").alias("end"), F.try_element_at("f", F.lit(4)).alias("name"))
    return rows.withColumn("name", F.coalesce("name", F.concat_ws("_", "chrom", "start", "end")))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return parse_bed(spark.read.text(path))


NAME = r"^(.+)_([0-9]+)_([^_]+)_([^_]+?)(_upstream|_downstream)?$"


def parse_interval_name(rows: DataFrame, column: str = "name") -> DataFrame:
    """v_chrom, v_pos, v_ref, v_alt, direction out of a name; null where it isn't a variant's."""
    part = lambda i: F.nullif(F.regexp_extract(column, NAME, i), F.lit(""))
    return rows.select("*", part(1).alias("v_chrom"), part(2).cast("bigint").alias("v_pos"), part(3).alias("v_ref"), part(4).alias("v_alt"), F.ltrim(F.regexp_extract(column, NAME, 5), F.lit("_")).alias("direction"))


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, chrom, pos, ref, alt, gt: one row per record and sample; only the GT subfield is kept."""
    lines = spark.read.text(path)
    header = lines.filter(F.col("value").startswith("#CHROM")).select(F.slice(F.split("value", "\t"), 10, 1_000_000).alias("samples")).first()
    if header is None:
        raise ValueError(f"{path} has no #CHROM line")
    names = F.array(*[F.lit(x) for x in header["samples"]])
    rows = lines.filter((F.col("value") != "") & ~F.col("value").startswith("#")).select(F.split("value", "\t").alias("f"))
    calls = rows.select("f", F.posexplode(F.slice("f", F.lit(10), F.greatest(F.size("f") - 9, F.lit(0)))).alias("i", "call"))
    at = F.array_position(F.split(F.col("f")[8], ":"), "GT")
    gt = F.when(at > 0, F.try_element_at(F.split("call", ":"), at.cast("int")))
    return calls.select(F.element_at(names, F.col("i") + 1).alias("sample_id"), F.col("f")[0].alias("chrom"), F.col("f")[1].cast("bigint").alias("pos"), F.col("f")[3].alias("ref"), F.col("f")[4].alias("alt"), gt.alias("gt"))


def sample_names(spark: SparkSession, path: str) -> list[str]:
    row = spark.read.text(path).filter(F.col("value").startswith("#CHROM")).first()
    return row["value"].split("\t")[9:] if row else []


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """chrom, chunk_no, seq (upper case): rows of ``chunk`` bases, for equi-joins on (chrom, chunk_no).

    Lines are read split by split.  A line's place in its contig is the number of bases before it in its split, since
    the split's last header, plus what the splits before hold of the contig; so lines go straight to their chunks and no
    task has a whole contig.  Lines before the first header are left out; a contig's name stands in one header.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path).select(meta["file_path"].alias("_path"), meta["file_block_start"].alias("_at"), F.monotonically_increasing_id().alias("_no"), "value").filter(F.trim("value") != "")
    header = F.startswith("value", F.lit(">"))
    name = F.split(F.trim(F.substring("value", 2, 1 << 30)), r"\s+")[0]
    lines = lines.select("_path", "_at", "_no", F.when(header, name).alias("_name"), F.when(~header, F.upper(F.regexp_replace("value", r"\s", ""))).alias("seq"))
    split = Window.partitionBy("_path", "_at").orderBy("_no")
    lines = lines.withColumns({"_contig": F.last("_name", ignorenulls=True).over(split), "_bases": F.coalesce(F.length("seq"), F.lit(0)).cast("long")})
    since = F.sum("_bases").over(split.rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.withColumns({"_since": F.coalesce(since, F.lit(0)), "_own": F.count("_name").over(split)})
    # Bases before the current header of the split, to be taken off.
    lines = lines.withColumn("_start", F.coalesce(F.max(F.when(F.col("_name").isNotNull(), F.col("_since"))).over(split), F.lit(0)))
    # A row for each split: what it begins with belongs to the last header before it.
    splits = lines.groupBy("_path", "_at").agg(F.max_by("_contig", "_no").alias("_last"), F.sum("_bases").alias("_all"), F.max("_start").alias("_from"), F.max("_own").alias("_headers"))
    before = Window.partitionBy("_path").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumns({"_group": F.coalesce(F.sum("_headers").over(before), F.lit(0)), "_carried": F.last("_last", ignorenulls=True).over(before), "_tail": F.col("_all") - F.col("_from")})
    # What splits hold of the contig that is open at their end, summed since the one with its header.
    splits = splits.withColumn("_opened", F.sum("_headers").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    held = F.sum("_tail").over(Window.partitionBy("_path", "_opened").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    splits = splits.withColumn("_held", held)
    heads = splits.select("_path", "_at", F.col("_carried").alias("_open"), F.coalesce(F.lag("_held").over(Window.partitionBy("_path").orderBy("_at")), F.lit(0)).alias("_more"))
    placed = lines.join(F.broadcast(heads), ["_path", "_at"]).filter("seq is not null")
    offset = F.col("_since") - F.col("_start") + F.when(F.col("_own") == 0, F.col("_more")).otherwise(0)
    placed = placed.select(F.coalesce("_contig", "_open").alias("chrom"), offset.alias("_o"), "seq").filter("chrom is not null and seq <> ''")
    pieces = placed.withColumn("chunk_no", F.explode(F.sequence(F.floor(F.col("_o") / chunk), F.floor((F.col("_o") + F.length("seq") - 1) / chunk))))
    begin = F.greatest(F.col("chunk_no") * chunk, F.col("_o"))
    part = F.substring("seq", (begin - F.col("_o") + 1).cast("int"), F.least(F.col("_o") + F.length("seq"), (F.col("chunk_no") + 1) * chunk).cast("int") - begin.cast("int"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(begin.alias("o"), part.alias("p")))), lambda x: x["p"]), "")
    return pieces.groupBy("chrom", "chunk_no").agg(text.alias("seq"))


def cut_contigs(contigs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("seq") / chunk).cast("int") - 1, F.lit(0)))
    return contigs.select("chrom", "seq", F.explode(starts).alias("chunk_no")).select("chrom", F.col("chunk_no").cast("bigint"), F.expr(f"substring(seq, chunk_no * {chunk} + 1, {chunk})").alias("seq"))


def read_sample_json(spark: SparkSession, path: str) -> DataFrame:
    """sample_id (the file's stem), variant_id, model, key, vec: the long form of per-sample JSON records."""
    schema = "embeddings map<string, map<string, map<string, array<float>>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("sample_id"), "embeddings")
    one = raw.select("sample_id", F.explode("embeddings").alias("variant_id", "models"))
    two = one.select("sample_id", "variant_id", F.explode("models").alias("model", "keys"))
    return two.select("sample_id", "variant_id", "model", F.explode("keys").alias("key", "vec"))


def read_sample_npz(spark: SparkSession, path: str) -> DataFrame:
    """The same of compressed array files whose entries are named variant::model::key."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import numpy as np

        for pdf in batches:
            for where, content in zip(pdf["path"], pdf["content"], strict=True):
                with np.load(io.BytesIO(content)) as held:
                    rows = [(where.rsplit("/", 1)[-1].removesuffix(".npz"), *name.split("::"), held[name].astype("float32")) for name in held.files if name.count("::") == 2]
                yield pd.DataFrame(rows, columns=["sample_id", "variant_id", "model", "key", "vec"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(path).select("path", "content")
    return files.mapInPandas(parse, "sample_id string, variant_id string, model string, key string, vec array<float>")


def exists(spark: SparkSession, path: str | None) -> bool:
    """Whether a path is there, in whatever store Spark reads it from."""
    if not path:
        return False
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_store(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """What write_store wrote: sample_id, variant_id, model, key, vec."""
    schema = "variant_id string, model string, key string, vec array<float>, sample_id string"
    return spark.read.schema(schema).format("parquet" if fmt in ("parquet", "npz", "hdf5") else "json").load(path).select("sample_id", "variant_id", "model", "key", "vec")


def read_features(spark: SparkSession, path: str, id_column: str = "sample_id") -> DataFrame:
    """sample_id and the numeric columns of a CSV file with a header."""
    table = spark.read.csv(path, header=True, inferSchema=True)
    if id_column not in table.columns:
        raise ValueError(f"{path} has no column {id_column}")
    numbers = [f.name for f in table.schema if f.name != id_column and isinstance(f.dataType, NumericType)]
    return table.select(F.col(id_column).cast("string").alias("sample_id"), *[F.col(c).cast("double").alias(c) for c in numbers])


def read_labels(spark: SparkSession, path: str, id_column: str = "sample_id", label_column: str = "label") -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True).select(F.col(id_column).cast("string").alias("sample_id"), F.col(label_column).cast("int").alias("label"))


def with_order(rows: DataFrame, by: str, *order: str) -> DataFrame:
    """The stable place of a row within its key, where a file's order is not known."""
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1)
