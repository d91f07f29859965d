"""The store of sample records: long tables, their JSON form, and resuming."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.functions import sequences as S

VECTORS = "sample_id string, variant_id string, model string, key string, vec array<float>"
FORMATS = {"json": "json", "parquet": "parquet", "npz": "parquet", "hdf5": "parquet"}


def write_store(vectors: DataFrame, path: str, fmt: str = "parquet") -> None:
    """(sample_id, variant_id, model, key, vec), appended; unknown formats become JSON, array files Parquet."""
    vectors.write.mode("append").format(FORMATS.get(fmt, "json")).partitionBy("sample_id").save(path)


def sample_archives(vectors: DataFrame) -> DataFrame:
    """(sample_id, content): a compressed array file for each sample, entries named variant::model::key.

    A sample is one file, so its vectors meet in one task; ``write_store`` has no such bound.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        import io

        import numpy as np

        out = io.BytesIO()
        named = {"::".join(x[:3]): np.asarray(x[3], dtype=np.float32) for x in zip(pdf["variant_id"], pdf["model"], pdf["key"], pdf["vec"], strict=True)}
        np.savez_compressed(out, __format__=np.array(3), **named)
        return pd.DataFrame({"sample_id": [pdf["sample_id"].iloc[0]], "content": [out.getvalue()]})

    return vectors.select("sample_id", "variant_id", "model", "key", "vec").groupBy("sample_id").applyInPandas(pack, "sample_id string, content binary")


def sample_documents(vectors: DataFrame) -> DataFrame:
    """(sample_id, content): each sample's record as JSON, in UTF-8; as for archives, a sample is one file."""
    return sample_records(vectors).select("sample_id", F.encode(F.to_json(F.struct("embeddings")), "UTF-8").alias("content"))


def write_files(contents: DataFrame, path: str, suffix: str) -> None:
    """(sample_id, content) as files {sample_id}{suffix} in a folder of any store that Arrow's file systems know and all
    tasks see.  A file is whole or not there: a store of objects shows it when it is closed, others are given a new name then."""

    def put(rows: Iterator) -> None:
        from pyarrow.fs import FileSystem, LocalFileSystem

        where, top = FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)
        where.create_dir(top, recursive=True)
        for row in rows:
            part = f"{top}/.{row['sample_id']}.{uuid.uuid4().hex}"
            with where.open_output_stream(part) as f:
                f.write(row["content"])
            where.move(part, f"{top}/{row['sample_id']}{suffix}")  # a task that runs again writes the same

    contents.select("sample_id", "content").foreachPartition(put)


def write_archives(vectors: DataFrame, path: str) -> None:
    """A compressed array file for each sample: {sample_id}.npz."""
    write_files(sample_archives(vectors), path, ".npz")


def write_documents(vectors: DataFrame, path: str) -> None:
    """A JSON file for each sample: {sample_id}.json, as read_sample_json reads them."""
    write_files(sample_documents(vectors), path, ".json")


def haplotype_table(rows: DataFrame) -> DataFrame:
    """(sample_id, name, hap1, hap2): haplotypes of intervals built beforehand, for look-ups by sample and interval."""
    return rows.select("sample_id", F.concat_ws("_", "chrom", "pos", "ref", "alt", "direction").alias("name"), F.col("hap1.mut").alias("hap1"), F.col("hap2.mut").alias("hap2"))


def pack_haplotypes(table: DataFrame) -> DataFrame:
    """A table of haplotypes with its sequences at two bits a base, about a quarter of the size: ragged, a row for each
    (sample_id, name)."""
    return table.select("sample_id", "name", *[S.pack_bases(F.col(h)).alias(h) for h in ("hap1", "hap2")])


def open_haplotypes(table: DataFrame) -> DataFrame:
    """(sample_id, name, hap1, hap2) as text of a prebuilt table, whichever form its sequences are in."""
    kinds = dict(table.dtypes)
    text = lambda h: S.unpack_bases(F.col(h)) if kinds[h].startswith("struct<") else S.decode_bases(h, kinds[h])
    return table.select("sample_id", "name", *[text(h).alias(h) for h in ("hap1", "hap2")])


def clear_store(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """Take all vectors out of a store; it can be read and appended to as before."""
    spark.createDataFrame([], VECTORS).write.mode("overwrite").format(FORMATS.get(fmt, "json")).save(path)


def haplotype_table_name(vcf: str, bed: str) -> str:
    """Folder of a prebuilt table: it follows from the two paths, not from what the files hold."""
    import hashlib

    return hashlib.md5(f"{vcf}{bed}".encode(), usedforsecurity=False).hexdigest()[:12]


def describe_haplotypes(table: DataFrame) -> DataFrame:
    """Numbers of intervals and samples of a prebuilt table."""
    return table.agg(F.count_distinct("name").alias("intervals"), F.count_distinct("sample_id").alias("samples"))


def sample_records(vectors: DataFrame) -> DataFrame:
    """(sample_id, embeddings): variant -> model -> key -> vector."""
    keys = vectors.groupBy("sample_id", "variant_id", "model").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "vec")))).alias("keys"))
    models = keys.groupBy("sample_id", "variant_id").agg(F.map_from_entries(F.collect_list(F.struct("model", "keys"))).alias("models"))
    return models.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("variant_id", "models"))).alias("embeddings"))


def haplotype_records(rows: DataFrame) -> DataFrame:
    """(sample_id, variant_id, direction, record): the six sequences as one JSON object."""
    return rows.select("sample_id", F.concat_ws("_", "chrom", "pos", "ref", "alt").alias("variant_id"), "direction", F.to_json(F.struct("hap1", "hap2", "reference")).alias("record"))


def unprocessed(wanted: DataFrame, vectors: DataFrame, model: str, by: tuple[str, ...] = ("sample_id", "variant_id")) -> DataFrame:
    """What has no vector of ``model`` yet."""
    return wanted.join(vectors.filter(F.col("model") == model).select(*by).distinct(), list(by), "left_anti")


#: Ranges of names that are ranked alone, and names that tell where these begin, for each.
RANGES, EACH = 64, 16


def round_robin(names: DataFrame, workers: int, column: str = "sample_id") -> DataFrame:
    """bucket: names in order, dealt in turn; a missing name comes first.

    Names are cut into ranges at those with the least hashes; each range is ranked alone and starts after the
    ranges before it, so no task sees all names.
    """
    each = names.select(F.col(column).alias("_name")).distinct()
    some = sorted(r[0] for r in each.filter("_name is not null").orderBy(F.xxhash64("_name"), "_name").limit(RANGES * EACH).collect())
    cuts = some[EACH::EACH]
    at = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("_name"))) if cuts else F.lit(0)
    placed = each.withColumn("_range", F.when(F.col("_name").isNull(), F.lit(-1)).otherwise(at))
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)  # over RANGES rows
    counts = placed.groupBy(F.col("_range").alias("_at")).agg(F.count("*").alias("_n"))
    starts = counts.select("_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = placed.withColumn("_r", F.row_number().over(Window.partitionBy("_range").orderBy("_name")) - 1)
    joined = ranked.join(F.broadcast(starts), F.col("_range") == F.col("_at"))
    return joined.select(F.col("_name").alias(column), F.pmod(F.col("_r") + F.col("_start"), F.lit(workers)).cast("int").alias("bucket"))
