"""python -m varloom variants|omics --config FILE [overrides]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from varloom.plans import multiomics, personal, settings


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="varloom", description="Whole runs from settings files.")
    kinds = parser.add_subparsers(dest="kind", required=True)
    flag = {"action": argparse.BooleanOptionalAction, "default": None}
    variants = kinds.add_parser("variants", help="variants to sequences and vectors")
    for name in ("vcf-path", "bed-path", "ref-fasta", "output-dir", "encoder", "pooling", "output-format"):
        variants.add_argument(f"--{name}")
    variants.add_argument("--flank", type=int)
    for name in ("save-haplotypes", "do-inference", "save-embeddings", "filter-hom-ref"):
        variants.add_argument(f"--{name}", **flag)
    omics = kinds.add_parser("omics", help="vectors and tables to models")
    for name in ("label-path", "embedding-path", "metabolome-path", "phenome-path", "output-dir", "strategy", "select"):
        omics.add_argument(f"--{name}")
    for name in ("top-k", "folds", "seed"):
        omics.add_argument(f"--{name}", type=int)
    for name in ("models", "modules"):
        omics.add_argument(f"--{name}", nargs="+")
    for p in (variants, omics):
        p.add_argument("--config", required=True)
    given = vars(parser.parse_args(argv))
    kind, config = given.pop("kind"), given.pop("config")
    spark = SparkSession.builder.appName(f"varloom {kind}").getOrCreate()
    if kind == "variants":
        for name, path in personal.run(spark, settings.load_variant_settings(config, **given)).items():
            print(name, path)
    else:
        out = multiomics.run(spark, settings.load_omics_settings(config, **given))
        out["summary"].show(50, truncate=False)
        out["best"].show(truncate=False)


if __name__ == "__main__":
    main()
