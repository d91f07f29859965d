"""Incremental runs: new files are taken up once, and keys that a target already has are left out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from varloom.operators import variants as G
from varloom.sources import files

GENOTYPES = "sample_id string, chrom string, pos long, ref string, alt string, gt string"
VARIANT_KEY = ("sample_id", "chrom", "pos", "ref", "alt")


def append_new(rows: DataFrame, target: str, keys: Sequence[str], partition: str = "sample_id", once: bool = False) -> None:
    """Append the rows with keys that the Parquet table ``target`` does not have; one row for each key (``once``: they are so).

    Only the key columns of the partitions that ``rows`` touch are read (pruned by the semi join), so the cost follows
    the batch, not the table.  A batch that runs again finds its own rows there and adds nothing.
    """
    spark = rows.sparkSession
    fresh = rows if once else rows.dropDuplicates(list(keys))
    if files.exists(spark, target):
        held = spark.read.schema(rows.schema).parquet(target).select(*keys)
        held = held.join(fresh.select(partition).distinct(), partition, "left_semi")
        fresh = fresh.join(held, list(keys), "left_anti")
    fresh.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(target)


def stream_into(stream: DataFrame, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], keys: Sequence[str]) -> StreamingQuery:
    """All that is there is taken up in batches, then the query ends; the checkpoint remembers which files are done."""
    each = lambda batch, _: append_new(transform(batch), target, keys)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_genotypes(spark: SparkSession, source: str, target: str, checkpoint: str, drop_hom_ref: bool = True, files_per_batch: int = 1000) -> StreamingQuery:
    """Shards of genotype rows (Parquet, see GENOTYPES) into a table of parsed variants."""
    stream = spark.readStream.schema(GENOTYPES).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream_into(stream, target, checkpoint, lambda rows: G.parse_genotypes(rows, drop_hom_ref), VARIANT_KEY)


def event_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events of each type in tumbling windows of event time; rows later than ``late`` are left out of closed windows."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
