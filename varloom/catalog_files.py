"""Queries that write files out of the shared tables with Spark and read them back, and queries of prepared features.

Importing this module adds them to ``catalog.QUERIES`` and ``catalog.ORACLES``.  Files stay in a new folder of the shared one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom import catalog as C
from varloom.catalog import query, rounded
from varloom.operators import encode, learning, store
from varloom.operators import variants as G
from varloom.plans import multiomics
from varloom.sources import derived as D
from varloom.sources import files
from varloom.sources.scratch import new_folder, written

# --- genotype and genome files ------------------------------------------------------------------------
#: Columns of a genotype file before those of the samples, and the samples of the derived calls.
FIXED = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]
SAMPLES = [f"s{i}" for i in range(8)]


def vcf_file(spark, d) -> str:
    """The derived calls as a genotype file: a line for each variant, a column for each sample, ``./.`` without a call;
    every third variant has a second ALT, every fifth only the genotype in its format."""
    calls = D.variants(spark, d)
    gt = F.concat(F.col("a1").cast("string"), F.when(F.col("pos") % 2 == 0, "|").otherwise("/"), F.col("a2").cast("string"))
    wide = calls.withColumn("gt", gt).groupBy("chrom", "pos", "ref", "alt").pivot("sample_id", SAMPLES).agg(F.first("gt"))
    short = F.col("pos") % 5 == 0
    cells = [F.concat(F.when(short, "").otherwise("9:"), F.coalesce(F.col(s), F.lit("./."))) for s in SAMPLES]
    alt = F.concat("alt", F.when(F.col("pos") % 3 == 0, ",TTTT").otherwise(""))
    lines = wide.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", alt, F.lit("."), F.lit("PASS"), F.lit("."), F.when(short, "GT").otherwise("DP:GT"), *cells).alias("value"))
    path = new_folder(spark, "calls")
    spark.createDataFrame([("##fileformat=VCFv4.2",), ("\t".join([*FIXED, *SAMPLES]),)], "value string").coalesce(1).write.text(path)
    lines.write.mode("append").text(path)
    return path


@query("vcf_region_scan", f"""
SELECT DISTINCT v.sample_id, v.chrom, v.pos, v.ref, v.alt, v.a1, v.a2
FROM ({C.V_SQL}) v JOIN ({D.oracle(D.REGIONS, 'orders')}) r ON v.chrom = r.chrom AND v.pos - 1 < r.end_ AND v.pos - 1 + length(v.ref) > r.start_ WHERE NOT (v.a1 = 0 AND v.a2 = 0)
""")
def vcf_region_scan(spark, d):
    """Calls of a genotype file that touch a region and are not the reference's on both sides."""
    calls = G.parse_genotypes(files.read_vcf(spark, vcf_file(spark, d)), drop_hom_ref=True)
    return G.touching(calls.select("sample_id", "chrom", "pos", "ref", "alt", "a1", "a2"), D.derive(spark, d, D.REGIONS, "orders"))


@query("vcf_sample_names", f"SELECT sample_id, cast(row_number() OVER (ORDER BY sample_id) - 1 as int) AS place, count(*) AS calls FROM ({C.V_SQL}) GROUP BY sample_id")
def vcf_sample_names(spark, d):
    """The samples that a genotype file's header names, in its order, with the number of their calls."""
    path = vcf_file(spark, d)
    names = spark.createDataFrame(list(enumerate(files.sample_names(spark, path))), "place int, sample_id string")
    counts = files.read_vcf(spark, path).filter("gt <> './.'").groupBy("sample_id").agg(F.count("*").alias("calls"))
    return names.join(counts, "sample_id").select("sample_id", "place", "calls")


#: Letters of a text as bases.
_LETTERS, _BASES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ("ACGT" * 7)[:26]
CONTIG_SQL = f"SELECT doc_id, translate(upper(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')), '{_LETTERS}', '{_BASES}') AS seq FROM documents"


@query("fasta_chunks", f"""
SELECT 'd' || cast(doc_id as varchar) AS chrom, n AS chunk_no, length(part) AS bases, md5(part) AS letters
FROM (SELECT doc_id, n, substr(seq, n * {files.CHUNK} + 1, {files.CHUNK}) AS part FROM (SELECT *, unnest(range(0, (length(seq) + {files.CHUNK - 1}) // {files.CHUNK})) AS n FROM ({CONTIG_SQL})))
""")
def fasta_chunks(spark, d):
    """A genome file with a contig for each document, its letters as bases in lines of 60, read as chunks."""
    letters = F.upper(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]", ""))
    seq = F.regexp_replace(F.translate(letters, _LETTERS, _BASES), "(.{60})", "$1\n")
    path = new_folder(spark, "genome")
    spark.read.parquet(f"{d}/documents.parquet").select(F.concat(F.lit(">d"), F.col("doc_id").cast("string"), F.lit(" of a text\n"), F.lower(seq)).alias("value")).write.text(path)
    return files.read_fasta(spark, path).select("chrom", "chunk_no", F.length("seq").alias("bases"), F.md5("seq").alias("letters"))


# --- tables of haplotypes built beforehand ------------------------------------------------------------
CALLS, REGIONS = "calls.vcf", "regions.bed"


def prebuilt(spark, d) -> tuple[str, DataFrame]:
    """Name and rows of a table of haplotypes that was written, packed, under the name that its inputs' paths give it."""
    name = store.haplotype_table_name(CALLS, REGIONS)
    path = f"{new_folder(spark, 'haplotypes')}/{name}"
    store.pack_haplotypes(store.haplotype_table(C.six(spark, d))).write.parquet(path)
    return name, store.open_haplotypes(spark.read.parquet(path))


@query("prebuilt_haplotypes", f"SELECT substr(md5('{CALLS}{REGIONS}'), 1, 12) AS dataset, sample_id, {C.VID} || '_' || direction AS name, m1 AS hap1, m2 AS hap2 FROM ({C.SIX_SQL})")
def prebuilt_haplotypes(spark, d):
    name, table = prebuilt(spark, d)
    return table.select(F.lit(name).alias("dataset"), "sample_id", "name", "hap1", "hap2")


@query("haplotype_diagnostics", f"SELECT count(DISTINCT {C.VID} || '_' || direction) AS intervals, count(DISTINCT sample_id) AS samples FROM ({C.SPLIT_SQL})")
def haplotype_diagnostics(spark, d):
    return store.describe_haplotypes(prebuilt(spark, d)[1])


LEGACY_FIELDS = {"hap1_mut_seq": "hap1", "hap1_mut_comp": "rc1", "hap2_mut_seq": "hap2", "hap2_mut_comp": "rc2"}


@query("legacy_embed", f"""
WITH l AS MATERIALIZED ({C.ORACLES['legacy_window']}), keyed AS MATERIALIZED ({' UNION ALL '.join(f"SELECT sample_id || '||' || variant_id || '||{k}' AS key, {c} AS seq FROM l" for k, c in LEGACY_FIELDS.items())}),
wanted AS (SELECT DISTINCT seq FROM keyed),
v AS (SELECT seq, string_agg({C.toy_cell('list_avg(x)')}, ',' ORDER BY j) AS mean, string_agg({C.toy_cell('list_max(x)')}, ',' ORDER BY j) AS max FROM ({C.WHOLE_SQL}) GROUP BY seq)
SELECT key, mean, max FROM keyed JOIN v USING (seq)
""")
def legacy_embed(spark, d):
    """Centred windows with all variants of a sample put in, and their reverse complements, keyed and pooled as a whole."""
    slot = lambda k, c: F.struct(F.lit(k).alias("key"), F.col(c.replace("rc", "hap")).alias("seq"), F.lit(-1).alias("w"), F.lit(c.startswith("rc")).alias("back"))
    rows = C.legacy_pairs(spark, d).select("sample_id", "variant_id", F.array(*[slot(k, c) for k, c in LEGACY_FIELDS.items()]).alias("x"))
    found = encode.encoded_in_tasks(rows, [encode.ToyEncoder()], ["mean", "max"], tails=False, as_text=True)
    each = found.select("sample_id", "variant_id", F.explode("x").alias("x")).filter("x.mean_0 is not null")
    return each.select(F.concat_ws("||", "sample_id", "variant_id", "x.key").alias("key"), *[F.col(f"x.{m}_0").alias(m) for m in ("mean", "max")])


class PickyEncoder(encode.ToyEncoder):
    """Fails on a batch that has a sequence whose length is a multiple of five."""

    def hidden_states(self, sequences):
        if any(len(s) % 5 == 0 for s in sequences):
            raise ValueError("a length that is a multiple of five")
        return super().hidden_states(sequences)


@query("encode_fallback", f"""
WITH {C.SIX_CTE}, v AS (SELECT seq, w, string_agg({C.toy_cell('x')}, ',' ORDER BY j) AS vec FROM ({C.TOY_SQL}) GROUP BY seq, w)
SELECT seq, w, CASE WHEN length(seq) % 5 = 0 THEN NULL ELSE vec END AS vec, CASE WHEN length(seq) % 5 = 0 THEN 'a length that is a multiple of five' END AS error FROM v
""")
def encode_fallback(spark, d):
    """Sequences of batches that fail are encoded one by one; those that fail alone keep their error."""
    once, others = encode.apart(written(C.counted(spark, d).select("seq", "w"), "wanted", "zstd"), "seq")
    found = encode.encode_distinct(others, PickyEncoder(), alone=once)
    return found.select("seq", "w", F.when(F.col("vec").isNotNull(), C.short_text(F.col("vec"))).alias("vec"), "error")


# --- sample records in files --------------------------------------------------------------------------
LONG_SQL = " UNION ALL ".join(f"SELECT sample_id, 'v' || cast(ord as varchar) AS variant_id, 'toy' AS model, '{k}' AS key, {C._text(c)} AS vec FROM ({C.SIX_V}) WHERE {c} IS NOT NULL" for k, c in multiomics.KEYS.items())


def long_vectors(spark, d) -> DataFrame:
    """(sample_id, variant_id, model, key, vec) of all six vectors."""
    each = F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).cast("array<float>").alias("vec")) for k, c in multiomics.KEYS.items()])
    rows = D.six_vectors(spark, d).select("sample_id", F.concat(F.lit("v"), F.col("ord").cast("string")).alias("variant_id"), F.lit("toy").alias("model"), F.explode(each).alias("x"))
    return rows.select("sample_id", "variant_id", "model", "x.*").filter("vec is not null")


def as_text(vectors: DataFrame) -> DataFrame:
    return vectors.select("sample_id", "variant_id", "model", "key", rounded(F.col("vec").cast("array<double>")).alias("vec"))


@query("sample_files_json", LONG_SQL)
def sample_files_json(spark, d):
    """A JSON file for each sample, read by the folder; the sample is the file's stem."""
    path = new_folder(spark, "records")
    store.write_documents(long_vectors(spark, d), path)
    return as_text(files.read_sample_json(spark, path))


@query("sample_files_npz", LONG_SQL)
def sample_files_npz(spark, d):
    path = new_folder(spark, "archives")
    store.write_archives(long_vectors(spark, d), path)
    return as_text(files.read_sample_npz(spark, path))


FORMATS = ("parquet", "json", "npz", "tsv")


@query("store_formats", f"SELECT fmt, l.* FROM ({LONG_SQL}) l, (VALUES {', '.join(f"('{f}')" for f in FORMATS)}) f(fmt)")
def store_formats(spark, d):
    """The store in each of its formats, an unknown one among them, written in two goes."""
    rows, out = long_vectors(spark, d), []
    for fmt in FORMATS:
        path = new_folder(spark, "store")
        for part in ("key like 'Mut%'", "key not like 'Mut%'"):
            store.write_store(rows.filter(part), path, fmt)
        out.append(as_text(files.read_store(spark, path, fmt)).withColumn("fmt", F.lit(fmt)))
    return reduce(DataFrame.unionByName, out)


@query("samples_pushdown", f"SELECT * FROM ({LONG_SQL}) WHERE sample_id IN (SELECT sample_id FROM ({C.METAB_SQL}))")
def samples_pushdown(spark, d):
    """The stored vectors of the samples that another source has: other samples' folders are not read."""
    path = new_folder(spark, "store")
    store.write_store(long_vectors(spark, d), path)
    return as_text(multiomics.of_samples(files.read_store(spark, path), D.derive(spark, d, C.METAB, "customer").select("sample_id")))


@query("csv_features", "SELECT cast(c_custkey as varchar) AS sample_id, cast(c_nationkey as double) AS c_nationkey, c_acctbal FROM customer")
def csv_features(spark, d):
    """Ids and numeric columns of a file with a header; names and segments are left out."""
    path = new_folder(spark, "features")
    spark.read.parquet(f"{d}/customer.parquet").write.csv(path, header=True)
    return files.read_features(spark, path, "c_custkey")


@query("csv_labels", "SELECT cast(doc_id as varchar) AS sample_id, cast(toxic as int) AS label FROM labels")
def csv_labels(spark, d):
    path = new_folder(spark, "labels")
    spark.read.parquet(f"{d}/labels.parquet").write.csv(path, header=True)
    return files.read_labels(spark, path, "doc_id", "toxic")


# --- prepared features --------------------------------------------------------------------------------
#: Two columns that vary together: their scaled components are their sum and their difference.
PAIR_SQL = "SELECT l_orderkey, l_linenumber, l_quantity AS q, l_extendedprice + 1000 * l_quantity AS p FROM lineitem"
SCALED_SQL = f"SELECT l_orderkey, l_linenumber, (q - avg(q) OVER ()) / stddev_pop(q) OVER () AS a, (p - avg(p) OVER ()) / stddev_pop(p) OVER () AS b FROM ({PAIR_SQL})"


def pairs(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.array("l_quantity", F.col("l_extendedprice") + 1000 * F.col("l_quantity")).alias("e"))


@query("reduced_pairs", f"SELECT l_orderkey, l_linenumber, round(abs(a + b) / sqrt(2.0::double), 4) AS pc0, round(abs(a - b) / sqrt(2.0::double), 4) AS pc1 FROM ({SCALED_SQL})")
def reduced_pairs(spark, d):
    """Sizes of the two principal components of scaled pairs."""
    rows = pairs(spark, d)
    return learning.fit_reducer(rows, "e", 2)(rows).select("l_orderkey", "l_linenumber", *[F.round(F.abs(F.col("e")[i]), 4).alias(f"pc{i}") for i in (0, 1)])


@query("reduced_shares", f"SELECT component, round(CASE component WHEN 0 THEN 1 + r ELSE 1 - r END / 2, 6) AS share FROM (SELECT corr(q, p) AS r FROM ({PAIR_SQL})), (VALUES (0), (1)) c(component)")
def reduced_shares(spark, d):
    return learning.explained_variance(pairs(spark, d), "e", 2).select("component", F.round("share", 6).alias("share"))


PREPARED = "SELECT c_custkey AS sample_id, cast(c_nationkey % 2 as int) AS label, c_acctbal AS e1, c_acctbal + 300.0D * c_nationkey AS e2, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS x, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE cast(c_nationkey as double) END AS y FROM {customer}"
PREPARED_SQL = f"SELECT *, fold <> 0 AS fitted FROM (SELECT *, cast((row_number() OVER (PARTITION BY label ORDER BY sha256('42:' || cast(sample_id as varchar)), sample_id) - 1) % {C.FOLDS} as int) AS fold FROM ({D.oracle(PREPARED, 'customer').replace('300.0D', '300.0::double')}))"


@query("prepared_features", f"""
WITH p AS ({PREPARED_SQL}), s AS (SELECT avg(e1) AS m1, stddev_pop(e1) AS s1, avg(e2) AS m2, stddev_pop(e2) AS s2, median(x) AS mx, median(y) AS my FROM p WHERE fitted),
z AS (SELECT *, (e1 - m1) / s1 AS a, (e2 - m2) / s2 AS b FROM p, s)
SELECT sample_id, fold, round(abs(a + b) / sqrt(2.0::double), 4) AS emb_pca_0, round(abs(a - b) / sqrt(2.0::double), 4) AS emb_pca_1, round(coalesce(x, mx), 4) AS x, round(coalesce(y, my), 4) AS y FROM z
""")
def prepared_features(spark, d):
    """Features as a model sees them, under their names: reduced vectors and filled columns, fitted on all folds but the first."""
    rows = learning.stratified_folds(D.derive(spark, d, PREPARED, "customer").withColumn("e", F.array("e1", "e2")), C.FOLDS)
    ready = learning.fold_preparation("e", ["x", "y"])(rows.filter("fold <> 0"))(rows)
    names = learning.feature_names(2, ["x", "y"])
    cell = lambda i, n: F.round(F.abs(F.col("features")[i]) if n.startswith("emb_") else F.col("features")[i], 4).alias(n)
    return ready.select("sample_id", "fold", *[cell(i, n) for i, n in enumerate(names)])


@query("out_of_fold_rows", f"SELECT sample_id, label, fold, true AS agrees FROM ({C.FOLD_SQL})")
def out_of_fold_rows(spark, d):
    """Every row is predicted once, in its own fold, and comes back with its own label, by id."""
    _, held = learning.cross_validate(C.holes(spark, d), "logistic", [{"regParam": 0.1, "maxIter": 20}], C.FOLDS, prepare=learning.fold_preparation(None, ["x", "y"]))
    return held.select("sample_id", "label", "fold", ((F.col("score") > 0.5).cast("int") == F.col("pred")).alias("agrees"))


#: Predictions of two modules: one as elsewhere, the other a made-up score.
TWO_SQL = f"SELECT 'all' AS module, 'svm' AS model, label, score, pred FROM ({C.PREDICTED_SQL}) UNION ALL SELECT 'emb', 'mlp', label, cast((doc_id * 37) % 101 as double), CASE WHEN (doc_id * 37) % 101 > 50 THEN 1 ELSE 0 END FROM ({C.PREDICTED_SQL})"
_by = "PARTITION BY module, model"


@query("module_report", f"""
WITH p AS ({TWO_SQL}),
c AS (SELECT module, model, count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 1) AS fp, count(*) FILTER (label = 0 AND pred = 0) AS tn, count(*) FILTER (label = 1 AND pred = 0) AS fn FROM p GROUP BY ALL),
k AS (SELECT module, model, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER ({_by}) AS pos, sum(n) OVER ({_by}) AS neg FROM (SELECT module, model, score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM p GROUP BY ALL) WINDOW w AS ({_by} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
a AS (SELECT module, model, sum(n * (tp - p + p / 2.0)) / max(cast(pos as double) * neg) AS roc_auc, sum(cast(p as double) * tp / (tp + fp)) / max(pos) AS average_precision FROM k GROUP BY ALL)
SELECT module, model, tp, fp, tn, fn, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision, cast(row_number() OVER (ORDER BY roc_auc DESC, module, model) as int) AS rank FROM c JOIN a USING (module, model)
""")
def module_report(spark, d):
    """Counts, areas and the rank of each module and model."""
    rows = C.predicted(spark, d)
    other = (F.col("doc_id") * 37) % 101
    both = rows.select(F.lit("all").alias("module"), F.lit("svm").alias("model"), "label", "score", "pred").unionByName(
        rows.select(F.lit("emb").alias("module"), F.lit("mlp").alias("model"), "label", other.cast("double").alias("score"), F.when(other > 50, 1).otherwise(0).alias("pred"))
    )
    found = multiomics.evaluated(both)["metrics"]
    return found.select("module", "model", "tp", "fp", "tn", "fn", *[F.round(c, 6).alias(c) for c in ("roc_auc", "average_precision")], "rank")
