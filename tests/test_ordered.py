"""Dense keys and running values over one global order."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import ordered
from starloom.operators.ordered import dense_keys, running_max


@pytest.fixture
def many_chunks(monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 600)


@pytest.mark.parametrize("partitions", ["2", "64"])
def test_the_data_and_not_the_session_sets_the_chunks(spark, monkeypatch, partitions):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 2000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = spark.range(0, 30_000, 1, 5).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("bk"), F.md5(F.col("id").cast("string")).alias("text"))
        sizes = [r["n"] for r in ordered._placed(rows, ["bk", "text"], "chunks").groupBy("_chunk").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == 30_000 and len(sizes) >= 12 and max(sizes) <= 4000


def test_keys_follow_the_order_without_gaps(spark, many_chunks):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("bk"), F.col("id").alias("other"))
    keyed = dense_keys(rows, ["bk"], "key").orderBy("bk").collect()
    assert [r["key"] for r in keyed] == list(range(1, 5001))


def test_keys_continue_after_the_given_one(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "bk string, x int")
    assert {tuple(r) for r in dense_keys(rows, ["bk"], "key", after=10).collect()} == {(11, "a", 2), (12, "b", 1), (13, None, 3)}


def test_no_rows_no_keys(spark):
    assert dense_keys(spark.range(0), ["id"], "key").collect() == []


def test_a_hot_leading_value_is_split(spark, many_chunks):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("bk"), "id")
    keyed = dense_keys(rows, ["bk", "id"], "key")
    assert keyed.select("key").distinct().count() == 20_000
    in_order = keyed.orderBy("bk", "id").select("key").collect()
    assert [r["key"] for r in in_order] == list(range(1, 20_001))


def test_only_chunk_summaries_meet_in_one_partition(spark):
    keyed = dense_keys(spark.range(1000), ["id"], "key")
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Aggregate [_chunk" in window.splitlines()[1] + window.splitlines()[2]


@pytest.mark.parametrize("seed", [1, 2])
def test_running_max_looks_at_earlier_rows_only(spark, many_chunks, seed):
    rng = random.Random(seed)
    values = [(i, rng.choice([None, rng.randint(0, 10**6)])) for i in range(2000)]
    rows = spark.createDataFrame(values, "at int, v int").repartition(5)
    best, expected = None, {}
    for at, v in values:
        expected[at] = best
        best = v if best is None else max(best, v if v is not None else best)
    assert {r["at"]: r["m"] for r in running_max(rows, ["at"], "v", "m").collect()} == expected


def test_a_known_number_of_rows_is_not_counted_again(spark, monkeypatch):
    df = spark.range(0, 3000, 1, 7).select((F.col("id") * 7919 % 3000).alias("at"), F.xxhash64("id").alias("v"))
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 300)
    counted = sorted(running_max(df, ["at"], "v", "top").collect())
    monkeypatch.setattr(type(df), "count", lambda self: 1 / 0)
    assert sorted(running_max(df, ["at"], "v", "top", rows=4000).collect()) == counted
