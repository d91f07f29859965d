"""From genotypes, intervals and a genome to six sequences and their vectors for each (sample, variant)."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.operators import encode, store
from varloom.operators import variants as G
from varloom.sources import files
from varloom.sources.indexed import read_indexed_vcf

from .settings import VariantSettings

#: Encoders by name; real models are added with ``register_encoder``.
ENCODERS: dict[str, Callable[..., encode.Encoder]] = {"toy": encode.ToyEncoder}


def register_encoder(name: str, make: Callable[..., encode.Encoder]) -> None:
    ENCODERS[name] = make


def make_encoder(name: str, options: dict[str, Any] | None = None) -> encode.Encoder:
    if name not in ENCODERS:
        raise ValueError(f"{name} is none of {', '.join(sorted(ENCODERS))}")
    return ENCODERS[name](**(options or {}))


def read_variants(spark: SparkSession, settings: VariantSettings) -> DataFrame:
    """Variants of all samples that overlap a region, once each however many regions they touch.

    Of a file that has an index only what is near a region is read.
    """
    regions = files.read_bed(spark, settings.bed_path).select("chrom", F.col("start").alias("start_"), F.col("end").alias("end_")).distinct()
    indexed = files.exists(spark, f"{settings.vcf_path}.tbi")
    calls = read_indexed_vcf(spark, settings.vcf_path, regions) if indexed else files.read_vcf(spark, settings.vcf_path)
    rows = G.parse_genotypes(calls, settings.filter_hom_ref)
    key = ["sample_id", "chrom", "pos", "ref", "alt"]
    return G.touching(rows, regions).groupBy(*key).agg(F.first("a1").alias("a1"), F.first("a2").alias("a2"))


def build_sequences(rows: DataFrame, genome: DataFrame, flank: int, least: int = 1) -> DataFrame:
    """hap1, hap2 and reference of both intervals of each variant; variants without both are left out.

    The genome of an interval is fetched once, whatever the number of samples that have the variant.
    """
    intervals = G.split_with_background(rows, flank, least)
    where = ["chrom", "start", "end"]
    windows = G.fetch_windows(intervals.select(*where).distinct(), genome, files.CHUNK, where)
    whole = windows.filter(F.length("wt_ref") > 0)
    return G.both_directions(G.six_sequences(intervals.join(whole, where)))


def personal_vectors(sequences: DataFrame, encoder: encode.Encoder, pooling: str = "mean", done: DataFrame | None = None) -> DataFrame:
    """Vectors of the variants that ``done`` (a store) has none of this model for."""
    todo = sequences.withColumn("variant_id", G.variant_id())
    if done is not None:
        todo = store.unprocessed(todo, done, encoder.name)
    return encode.embed_variants(todo.drop("variant_id"), encoder, pooling)


def run(spark: SparkSession, settings: VariantSettings, encoder: encode.Encoder | None = None) -> dict[str, str]:
    """Write ``haplotypes`` and ``embeddings`` under the output folder; a second run adds what is missing.

    Without inference only sequences are built and written.  Gives the folders that were written.
    """
    least = settings.window_size // 2 + 2
    sequences = build_sequences(read_variants(spark, settings), files.read_fasta(spark, settings.ref_fasta), settings.flank, least)
    written = {}
    if settings.save_haplotypes:
        written["haplotypes"] = f"{settings.output_dir}/haplotypes"
        store.haplotype_records(sequences).write.mode("overwrite").parquet(written["haplotypes"])
    if settings.do_inference:
        encoder = encoder or make_encoder(settings.encoder, settings.encoder_options)
        target = f"{settings.output_dir}/embeddings"
        done = files.read_store(spark, target, settings.output_format) if settings.save_embeddings and files.exists(spark, target) else None
        vectors = personal_vectors(sequences, encoder, settings.pooling, done)
        if settings.save_embeddings:
            written["embeddings"] = target
            store.write_store(vectors, target, settings.output_format)
        else:
            vectors.write.format("noop").mode("overwrite").save()
    return written
