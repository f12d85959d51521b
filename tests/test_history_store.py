"""Bucketed histories: the same rows as a plain load, and no shuffle of the history."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.constants import END_OF_TIME
from starloom.operators.history import HistorySpec, apply_history
from starloom.operators.lookup import LookupLimits, Role, resolve_point_in_time
from starloom.plans import history_store

END = datetime.fromisoformat(END_OF_TIME)
SPEC = HistorySpec("Thing", "bk", "key")
DIM = "key bigint, bk string, name string, Valid_From timestamp_ntz, Valid_To timestamp_ntz, Lineage_Key bigint"
STAGED = "bk string, name string, Valid_From timestamp_ntz, Valid_To timestamp_ntz"


def day(n):
    return datetime(2020, 1, 1) + timedelta(days=n)


def nodes(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def scanned_below_exchanges(df):
    """Shuffles of the stored history itself: with a scan of it below them, and no join yet."""
    found = []
    for shuffle in nodes(df._jdf.queryExecution().executedPlan()):
        below = list(nodes(shuffle))
        scans = any("starloom_" in x.toString().split("\n")[0] for x in below if "Scan" in x.nodeName())
        if shuffle.nodeName().startswith("Exchange") and scans and not any("Join" in x.nodeName() for x in below):
            found.append(shuffle.toString())
    return found


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def first(rng):
    names = [*"ABCDEFGHIJ", None]
    return [(k, rng.choice(names), f"n{k}", day(rng.randint(0, 9)), rng.choice([END, END, day(rng.randint(5, 15))]), 1) for k in range(1, 60)]


def batch(rng):
    keys = list({(rng.choice([*"ABCDEFGHIJKL", None]), rng.randint(16, 40)): None for _ in range(25)})
    return [(bk, f"s{n}", day(n), rng.choice([END, END, day(50)])) for bk, n in keys]


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_give_the_rows_of_a_plain_history(spark, tmp_path, seed):
    rng = random.Random(seed)
    plain = spark.createDataFrame(first(rng), DIM)
    history_store.start(plain, SPEC, str(tmp_path))
    for load in (2, 3):
        staged = spark.createDataFrame(batch(rng), STAGED)
        plain = spark.createDataFrame(apply_history(plain, staged, SPEC, load).collect(), DIM)
        history_store.apply(spark, str(tmp_path), staged, SPEC, load)
        stored = history_store.read(spark, str(tmp_path), SPEC)
        assert sorted(map(str, stored.drop("Part").collect())) == sorted(map(str, plain.collect()))
        current = history_store.current(spark, str(tmp_path), SPEC)
        assert sorted(map(str, current.collect())) == sorted(map(str, plain.where(F.col("Valid_To") == F.lit(END_OF_TIME).cast("timestamp_ntz")).collect()))
    assert len(list(tmp_path.glob("v*/closed"))) == 3, "closed rows stay in their load's folder"


def test_a_half_written_version_is_not_seen(spark, tmp_path, monkeypatch):
    history_store.start(spark.createDataFrame(first(random.Random(3)), DIM), SPEC, str(tmp_path))
    before = history_store.read(spark, str(tmp_path), SPEC).count()
    staged = spark.createDataFrame([("A", "new", day(30), END)], STAGED)
    with monkeypatch.context() as broken:
        broken.setattr(history_store, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            history_store.apply(spark, str(tmp_path), staged, SPEC, 2)
    assert history_store.read(spark, str(tmp_path), SPEC).count() == before
    history_store.apply(spark, str(tmp_path), staged, SPEC, 2)
    assert history_store.read(spark, str(tmp_path), SPEC).count() == before + 1


def test_a_close_shuffles_and_reads_no_history(spark, tmp_path, no_broadcast):
    history_store.start(spark.createDataFrame(first(random.Random(4)), DIM), SPEC, str(tmp_path))
    staged = spark.createDataFrame(batch(random.Random(5)), STAGED)
    for df in history_store._split(spark, str(tmp_path), history_store.versions.newest(spark, str(tmp_path)), staged, SPEC):
        assert scanned_below_exchanges(df) == []
        assert any(n.nodeName().startswith("Exchange") for n in nodes(df._jdf.queryExecution().executedPlan())), "the batch is dealt"
        assert {f.split("/")[-2] for f in df.inputFiles() if str(tmp_path) in f} == {"current"}


def test_a_lookup_leaves_the_history_where_it_is(spark, tmp_path, no_broadcast):
    rng = random.Random(6)
    versions = [(k, rng.choice("ABCDEFGHIJ"), "x", day(rng.randint(0, 40)), rng.choice([END, day(rng.randint(20, 60))]), 1) for k in range(1, 80)]
    history_store.start(spark.createDataFrame(versions, DIM), SPEC, str(tmp_path))
    probes = [(i, rng.choice([*"ABCDEFGHIJK", None]), day(rng.randint(-1, 62))) for i in range(300)]
    staged = spark.createDataFrame(probes, "n int, bk string, t timestamp_ntz")
    stored = history_store.dimension(spark, str(tmp_path), SPEC)
    found = resolve_point_in_time(staged, "t", [Role("bk", "d", "found")], {"d": stored}, limits=LookupLimits(broadcast_rows=0))
    assert scanned_below_exchanges(found) == []
    for row in found.collect():
        hits = [(start, key) for key, bk, _, start, end, _ in versions if bk == row["bk"] and start < row["t"] <= end]
        assert row["found"] == (min(hits)[1] if hits else 0)
