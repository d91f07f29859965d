"""Every query's rows against its SQL on the smallest data set."""

import os

import duckdb
import pytest

from jobs import registry
from varloom import catalog, catalog_files  # noqa: F401 - the second one adds to the first

QUERIES, ORACLES = {**catalog.QUERIES, **registry.QUERIES}, {**catalog.ORACLES, **registry.ORACLES}

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    return float(value) if type(value).__name__ == "Decimal" else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    rows = [r.asDict() for r in QUERIES[name](spark, DATA).collect()]
    relation = duck.sql(ORACLES[name])
    columns = sorted(relation.columns)
    at = [relation.columns.index(c) for c in columns]
    if rows:
        assert sorted(rows[0]) == columns
    assert sorted((tuple(plain(r[c]) for c in columns) for r in rows), key=str) == sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=str)


def test_entry_without_extras():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_encoding_and_training_take_whole_inputs(spark):
    from varloom.operators import encode

    assert {len(r["features"]) for r in catalog.training_rows(spark, DATA).select("features").collect() if r["features"]} == {64}
    keys = catalog.all_slots(spark, DATA).selectExpr("split(key, '[|]')[2] as direction", "split(key, '[|]')[3] as slot").distinct().collect()
    assert len(keys) == 12
    assert catalog.all_slots(spark, DATA).filter("seq is not null").count() == encode.slots(catalog.six(spark, DATA)).filter("seq is not null").count()


def test_keys_of_slots_are_made_where_sequences_are(spark):
    """The same as hashing each slot of its own, nulls and alias pairs among them; no slot is made a row with its letters."""
    from varloom.functions import sequences as S
    from varloom.operators import encode

    F = S.F
    pair = "struct<mut:string,wt:string,wt_is_alias:boolean>"
    rows = [("s", "c", i, r, a, d, (m, w, m == w), (None, w, False), (w, "", False)) for i, (r, a, m, w) in enumerate([("A", "ACG", "ACGTn", "ACGTn"), ("AC", "G", "GGa\u00e9", "ACTT"), ("A", "T", None, "A")]) for d in ("upstream", "downstream")]
    df = spark.createDataFrame(rows, f"sample_id string, chrom string, pos long, ref string, alt string, direction string, hap1 {pair}, hap2 {pair}, reference {pair}")
    want = encode.slots(df).select("sample_id", "variant_id", "direction", F.col("key").alias("slot"), S.cache_key(F.col("seq"), F.col("w"), "max").alias("key"))
    got = encode.keys_in_tasks(df, "max")
    assert got.schema.names == want.schema.names and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 36
    plan = catalog.seq_hash_key(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "explode(x" not in plan and "explode(array(struct" not in plan
