"""Inputs derived from the shared tables, in SQL that Spark and DuckDB read alike.

The genome repeats ACGT: the base at a 0-based position is the one at that position modulo 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WINDOW = "substr(repeat('ACGT', cast(({length} + 7) / 4 as int)), cast(({start}) % 4 as int) + 1, cast({length} as int))"


def window_sql(start: str, length: str) -> str:
    """The genome from ``start``, ``length`` bases."""
    return WINDOW.format(start=start, length=f"({length})")


_REF = f"CASE kind WHEN 2 THEN {window_sql('pos - 1', '3')} WHEN 3 THEN {window_sql('pos - 1', '2')} ELSE {window_sql('pos - 1', '1')} END"
#: A row for each call: SNPs, insertions, deletions and block changes; about one in fifty has a REF that the genome hasn't.
CALLS = f"""  SELECT sample_id, chrom, pos, a1, a2,
         CASE WHEN odd = 1 THEN translate(ref, 'ACGT', 'TTAA') ELSE ref END AS ref,
         CASE kind WHEN 1 THEN ref || 'GG' WHEN 2 THEN substr(ref, 1, 1) ELSE translate(ref, 'ACGT', 'CGTA') END AS alt
  FROM (
    SELECT *, {_REF} AS ref
    FROM (
      SELECT concat('s', cast(l_suppkey % 8 as varchar(20))) AS sample_id, concat('chr', cast(l_orderkey % 3 + 1 as varchar(20))) AS chrom,
             cast(300 + (l_orderkey * 37 + l_partkey * 7 + l_linenumber * 13) % 1000000 as bigint) AS pos,
             cast(l_linenumber % 4 as int) AS kind, cast(l_partkey % 2 as int) AS a1, cast(floor(l_suppkey / 8) as bigint) % 2 AS a2,
             CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END AS odd
      FROM {{lineitem}}
    ) AS raw
  ) AS placed"""
#: One row per (sample_id, chrom, pos, ref, alt) of these.
VARIANTS = f"""
SELECT sample_id, chrom, pos, ref, alt, cast(max(a1) as int) AS a1, cast(max(a2) as int) AS a2
FROM (
{CALLS}
) AS typed
GROUP BY sample_id, chrom, pos, ref, alt
"""

#: The longest REF of the above, and the length of the genome's three contigs.
LONGEST_REF, CONTIG = 3, 1_000_400

#: Text lines as in interval files: comments, blanks, short rows and rows without a name among them.
BED_LINES = """
SELECT CASE cast(o_orderkey % 7 as int) WHEN 0 THEN concat('# ', cast(o_orderkey as varchar(20))) WHEN 1 THEN '   '
            WHEN 2 THEN concat('chr', cast(o_custkey % 3 + 1 as varchar(20)))
            WHEN 3 THEN concat('chr', cast(o_custkey % 3 + 1 as varchar(20)), '  ', cast(o_orderkey as varchar(20)), ' ', cast(o_orderkey + 500 as varchar(20)))
            ELSE concat('chr', cast(o_custkey % 3 + 1 as varchar(20)), chr(9), cast(o_orderkey * 3 as varchar(20)), chr(9), cast(o_orderkey * 3 + 40 as varchar(20)), chr(9),
                        'chr', cast(o_custkey % 3 + 1 as varchar(20)), '_', cast(o_orderkey as varchar(20)), '_A_', CASE WHEN o_orderkey % 2 = 0 THEN 'AT' ELSE 'G' END,
                        CASE cast(o_orderkey % 3 as int) WHEN 0 THEN '_upstream' WHEN 1 THEN '_downstream' ELSE '' END)
       END AS value
FROM {orders}
"""

#: Genotype records as text fields: several ALTs, none, missing, haploid and multi-allelic genotypes.
GENOTYPES = """
SELECT concat('s', cast(l_suppkey % 8 as varchar(20))) AS sample_id, concat('chr', cast(l_orderkey % 3 + 1 as varchar(20))) AS chrom,
       cast(1 + l_orderkey * 5 + l_linenumber as bigint) AS pos, CASE WHEN l_linenumber % 2 = 0 THEN 'AT' ELSE 'A' END AS ref,
       CASE cast(l_partkey % 5 as int) WHEN 0 THEN 'G,T' WHEN 1 THEN '.' WHEN 2 THEN 'AT' ELSE 'C' END AS alt,
       CASE cast(l_orderkey % 9 as int) WHEN 0 THEN './.' WHEN 1 THEN '0|0' WHEN 2 THEN '0|1' WHEN 3 THEN '1/1' WHEN 4 THEN '1|0' WHEN 5 THEN '1' WHEN 6 THEN '0|2' WHEN 7 THEN '.|1' ELSE '1|1' END AS gt
FROM {lineitem}
"""

REGIONS = """
SELECT concat('chr', cast(o_orderkey % 3 + 1 as varchar(20))) AS chrom, cast((o_orderkey * 7919) % 900000 as bigint) AS start_,
       cast((o_orderkey * 7919) % 900000 + 300 + o_custkey % 200 as bigint) AS end_
FROM {orders}
"""

#: Six vectors for each (sample, variant), a whole embedding turned by ten places more each; some without the second
#: haplotype or the reference.
WIDTH, TURN = 64, 10
SIX_VECTORS = """
SELECT concat('s', cast(vec_id % 25 as varchar(20))) AS sample_id, cast(floor(vec_id / 25) as bigint) AS ord, label,
       {slice0} AS mut1, {slice1} AS wt1,
       CASE WHEN vec_id % 11 = 0 THEN NULL ELSE {slice2} END AS mut2, CASE WHEN vec_id % 13 = 0 THEN NULL ELSE {slice3} END AS wt2,
       {slice4} AS mutref, CASE WHEN vec_id % 17 = 0 THEN NULL ELSE {slice5} END AS wtref
FROM {{embeddings}}
"""


def six_vectors_sql(engine: str) -> str:
    e = "cast(embedding as array<double>)" if engine == "spark" else "cast(embedding as double[])"
    cut = (lambda a, n: f"slice({e}, {a}, {n})") if engine == "spark" else (lambda a, n: f"list_slice({e}, {a}, {a + n - 1})")
    turned = lambda k: f"concat({cut(k + 1, WIDTH - k)}, {cut(1, k)})" if engine == "spark" else f"list_concat({cut(k + 1, WIDTH - k)}, {cut(1, k)})"
    return SIX_VECTORS.format(**{f"slice{i}": turned(TURN * i) if i else e for i in range(6)})


def derive(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, VARIANTS, "lineitem")


def contigs(spark: SparkSession) -> DataFrame:
    """(chrom, seq) of the genome, as a table."""
    return spark.range(3).selectExpr("concat('chr', cast(id + 1 as string)) AS chrom", f"repeat('ACGT', {CONTIG // 4}) AS seq")


def six_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, six_vectors_sql("spark"), "embeddings")


def oracle(sql: str, *tables: str) -> str:
    """The same as a subquery for DuckDB."""
    for t in tables:
        sql = sql.replace("{" + t + "}", t)
    return sql
