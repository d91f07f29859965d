"""A cache of sequence vectors that grows with the calls: only what is new is built and encoded.

New files of the call table are taken up as a stream that ends when all are done; its checkpoint remembers which were.  The
variants that the index does not have get the mutant and the reference sequence of both directions; the sequences that
the cache does not have, whatever variant they come from, are encoded once.

    python -m jobs.sequence_cache --config jobs/sequence_cache.json --calls DIR --output OUT --checkpoint MARK

``OUT/sequences`` has (key, w, vec) by the key's first digit, ``OUT/variants`` has (chrom, pos, ref, alt, direction, slot,
key) by chromosome.  Sequences are written before the variants that need them, and both only if they are not there yet:
a batch that failed half way and runs again adds what is missing, and no key twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom import catalog
from varloom.functions import sequences as S
from varloom.operators import encode
from varloom.operators import variants as G
from varloom.plans.personal import make_encoder
from varloom.sources import derived as D
from varloom.sources import files
from varloom.sources.scratch import new_folder
from varloom.streaming import ingest

from .common import command_line, log


@dataclass
class Settings:
    #: A folder of Parquet files, or a pattern of such; a stream does not take a single file's name.
    calls: str
    output: str
    checkpoint: str
    #: A FASTA file; without one the genome is the derived one.
    genome: str = ""
    flank: int = 200
    encoder: str = "toy"
    pooling: str = "mean"
    files_per_batch: int = 100


VARIANT = ["chrom", "pos", "ref", "alt"]
#: The two tables; named, as a table without rows yet has no file that tells.
INDEX = "chrom string, pos long, ref string, alt string, direction string, slot string, key string"
CACHE = "key string, w int, vec array<float>, prefix string"


def called_variants(calls: DataFrame) -> DataFrame:
    """The distinct variants of rows of the call table, whichever sample has them."""
    return calls.sparkSession.sql(D.CALLS, lineitem=calls).select(*VARIANT).distinct()


def reference_slots(variants: DataFrame, genome: DataFrame, flank: int, pooling: str) -> DataFrame:
    """(chrom, pos, ref, alt, direction, slot, seq, w, key): mutant and reference of both directions, downstream reversed."""
    rows = G.reference_pair(G.placed_windows(G.split_intervals(variants, flank), genome, files.CHUNK)).filter("mut_ref is not null")
    both = F.array(*[F.struct(F.lit(slot).alias("slot"), F.col(seq).alias("seq"), S.tail_width(F.col(by)).alias("w")) for slot, seq, by in (("mut", "mut_ref", "alt"), ("wt", "wt_ref", "ref"))])
    out = rows.select(*VARIANT, "direction", F.explode(both).alias("x")).select(*VARIANT, "direction", "x.*")
    out = out.withColumn("seq", F.when(F.col("direction") == "downstream", S.reverse_complement(F.col("seq"))).otherwise(F.col("seq")))
    return out.withColumn("key", S.cache_key(F.col("seq"), F.col("w"), pooling))


def take_up(calls: DataFrame, settings: Settings, number: int = 0) -> None:
    """One batch: what the index and the cache lack of its variants is added to them."""
    spark = calls.sparkSession
    index, cache = f"{settings.output}/variants", f"{settings.output}/sequences"
    rows = lambda path, schema: spark.read.schema(schema).parquet(path).count() if files.exists(spark, path) else 0
    before = rows(cache, CACHE), rows(index, INDEX)
    variants = called_variants(calls)
    if files.exists(spark, index):
        variants = variants.join(spark.read.schema(INDEX).parquet(index).select(*VARIANT).distinct(), VARIANT, "left_anti")
    variants = variants.persist()  # read for the longest and for the slots
    genome = files.read_fasta(spark, settings.genome) if settings.genome else files.cut_contigs(D.contigs(spark))
    slots = reference_slots(variants, genome, settings.flank, settings.pooling).persist()  # written twice: as sequences and as an index
    try:
        wanted = slots.select("key", "seq", "w").distinct().dropDuplicates(["key"])  # equal ones meet before any is sorted
        if files.exists(spark, cache):
            wanted = wanted.join(spark.read.schema(CACHE).parquet(cache).select("key"), "key", "left_anti")
        made = encode.encode_distinct(wanted, make_encoder(settings.encoder), settings.pooling).filter("vec is not null")
        keyed = made.select(S.cache_key(F.col("seq"), F.col("w"), settings.pooling).alias("key"), "w", "vec")
        keyed.withColumn("prefix", F.substring("key", 1, 1)).hint("rebalance", "prefix").write.mode("append").partitionBy("prefix").parquet(cache)
        ingest.append_new(slots.select(*VARIANT, "direction", "slot", "key"), index, [*VARIANT, "direction", "slot"], "chrom", once=True)
    finally:
        slots.unpersist()
        variants.unpersist()
    log.info("batch %s: read %s rows of %s; wrote %s sequences to %s and %s slots to %s", number, calls.count(), settings.calls, rows(cache, CACHE) - before[0], cache, rows(index, INDEX) - before[1], index)


def run(spark: SparkSession, settings: Settings) -> int:
    """Take up the files that are new since the checkpoint; gives the number of batches."""
    schema = spark.read.parquet(settings.calls).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", settings.files_per_batch).parquet(settings.calls)
    log.info("reading new files of %s since %s", settings.calls, settings.checkpoint)
    batches = []

    def each(batch: DataFrame, number: int) -> None:
        take_up(batch, settings, number)
        batches.append(number)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", settings.checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("%s batches done", len(batches))
    return len(batches)


def read_back(spark: SparkSession, output: str) -> DataFrame:
    """The index with the vectors: (chrom, pos, ref, alt, direction, slot, key, vec)."""
    return spark.read.schema(INDEX).parquet(f"{output}/variants").join(spark.read.schema(CACHE).parquet(f"{output}/sequences").select("key", "vec"), "key")


def job2_sequence_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over the whole call table, twice with the same checkpoint, and what stands there then."""
    where = new_folder(spark, "sequence-cache")
    settings = Settings(f"{sf_dir}/lineitem.parquet*", f"{where}/out", f"{where}/mark")
    for _ in range(2):
        run(spark, settings)
    vector = F.concat_ws(",", F.transform("vec", lambda x: F.format_string("%.4f", F.round(x.cast("double"), 4) + 0.0)))
    return read_back(spark, settings.output).select(*VARIANT, "direction", "slot", "key", vector.alias("vec"))


_WINDOW = D.window_sql("s", f"least(e, {D.CONTIG}) - s")
_SLOTS = " UNION ALL ".join(
    f"SELECT chrom, pos, ref, alt, direction, '{slot}' AS slot, CASE direction WHEN 'downstream' THEN translate(reverse({seq}), 'ATCGNatcgn', 'TAGCNtagcn') ELSE {seq} END AS seq, length({by}) + 2 AS w FROM r"
    for slot, seq, by in (("mut", "mut_ref", "alt"), ("wt", "wt_ref", "ref"))
)
ORACLE = f"""
WITH i AS (SELECT DISTINCT chrom, pos, ref, alt, direction, s, e FROM ({catalog.SPLIT_SQL})),
o AS (SELECT *, {_WINDOW} AS wt_ref, cast(pos - 1 - s as int) AS off FROM i),
r AS (SELECT *, substr(wt_ref, 1, off) || alt || substr(wt_ref, cast(off + length(ref) + 1 as int)) AS mut_ref FROM o),
wanted AS MATERIALIZED ({_SLOTS}),
v AS (SELECT seq, w, string_agg({catalog.toy_cell('x')}, ',' ORDER BY j) AS vec FROM ({catalog.TOY_SQL}) GROUP BY seq, w)
SELECT chrom, pos, ref, alt, direction, slot, substr(sha256(seq), 1, 16) || '_w' || cast(w as varchar) || '_mean' AS key, vec FROM wanted JOIN v USING (seq, w)
"""

if __name__ == "__main__":
    command_line(Settings, run, "A cache of sequence vectors.")
