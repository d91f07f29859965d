"""Haplotype and multi-omics analytics on Spark DataFrames."""
