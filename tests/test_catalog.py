"""Every named query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from sluice.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    plain = lambda v: "" if v is None or v != v else repr(float(v)) if isinstance(
        v,
        (int, float),
    ) or hasattr(v, "dtype") and v.dtype.kind in "iufb" else str(v)
    return sorted(tuple(plain(v) for v in r) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, DATA).toPandas(), duck.execute(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_future_candles_are_looked_for_in_all_events(spark, duck):
    want = duck.execute("SELECT count(*) FROM events WHERE ts IS NOT NULL").fetchone()[0]
    assert catalog.QUERIES["dq_future_candles"](spark, DATA).count() == want


def test_model_queries_tell_classes_apart(spark):
    for name in ("logistic_scores", "boosted_scores"):
        out = catalog.QUERIES[name](spark, DATA).toPandas()
        assert out.score.between(0, 1).all()
        assert out[out.y == 1].score.mean() > out[out.y == 0].score.mean() + 0.3


def test_split_hash_changes_with_the_split(spark):
    from pyspark.sql import functions as F

    from sluice.operators.splits import split_digest, split_digest_tree

    rows_ = spark.range(500).select(F.col("id"), F.when(F.col("id") < 300, "train").otherwise("test").alias("split"))
    tree = split_digest_tree(rows_, "id", "v1").head()[0]
    assert tree == split_digest_tree(rows_.repartition(7), "id", "v1").head()[0] != split_digest_tree(rows_, "id", "v2").head()[0]
    one = split_digest(rows_, "id", "v1").head()[0]
    assert one == split_digest(rows_.repartition(7), "id", "v1").head()[0]
    assert one != split_digest(rows_, "id", "v2").head()[0]
    assert one != split_digest(rows_.withColumn("split", F.when(F.col("id") == 0, "test").otherwise(F.col("split"))), "id", "v1").head()[0]
    assert not math.isnan(len(one))
