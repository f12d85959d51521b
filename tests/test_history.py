"""Type 2 history, fact replacement and load control on hand-computed cases."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.constants import END_OF_TIME
from starloom.operators import control
from starloom.operators.history import HistorySpec, apply_history, close_versions, inverted_versions, multi_version_keys
from starloom.operators.replace import replace_by_invoice
from starloom.sources.schemas import CUTOFFS, LINEAGE

END = datetime.fromisoformat(END_OF_TIME)
SPEC = HistorySpec("Thing", "bk", "key")
DIM = "key bigint, bk string, name string, Valid_From timestamp_ntz, Valid_To timestamp_ntz, Lineage_Key bigint"
STAGED = "bk string, name string, Valid_From timestamp_ntz, Valid_To timestamp_ntz"


def day(n):
    return datetime(2020, 1, 1) + timedelta(days=n)


def dimension(spark):
    return spark.createDataFrame(
        [(1, "A", "a", day(1), END, 1), (2, "B", "b", day(1), END, 1), (3, "A", "a0", day(0), day(1), 1)], DIM
    )


def staged(spark, *rows):
    return spark.createDataFrame([(bk, "new", start, end) for bk, start, end in rows], STAGED)


def outcome(df):
    return {r["key"]: (r["bk"], r["Valid_From"], r["Valid_To"]) for r in df.collect()}


@pytest.mark.parametrize(
    "rows, changed",
    [
        ([("A", day(5), END)], {1: ("A", day(1), day(5)), 4: ("A", day(5), END)}),
        ([("A", day(7), END), ("A", day(5), day(7))], {1: ("A", day(1), day(5)), 4: ("A", day(5), day(7)), 5: ("A", day(7), END)}),
        ([("C", day(5), END)], {4: ("C", day(5), END)}),
        ([("A", day(1), END)], {1: ("A", day(1), day(1)), 4: ("A", day(1), END)}),
        ([("A", day(0), END)], {1: ("A", day(1), day(0)), 4: ("A", day(0), END)}),
        ([(None, day(5), END)], {4: (None, day(5), END)}),
        ([("A", None, END)], {1: ("A", day(1), None), 4: ("A", None, END)}),
        ([], {}),
    ],
)
def test_apply(spark, rows, changed):
    base = {1: ("A", day(1), END), 2: ("B", day(1), END), 3: ("A", day(0), day(1))}
    assert outcome(apply_history(dimension(spark), staged(spark, *rows), SPEC, 9)) == {**base, **changed}


def model(dim, batch):
    """The load row by row: close what is open, then append in order of key and start."""
    starts = {}
    for bk, start, _ in batch:
        if bk is not None:
            starts.setdefault(bk, []).append(start)
    after = {}
    for key, bk, _, start, end, _ in dim:
        closes = end == END and bk in starts
        after[key] = (bk, start, min(starts[bk]) if closes else end)
    top = max(after, default=0)
    ordered = sorted(batch, key=lambda row: (row[0] is None, row[0] or "", row[1]))
    return {**after, **{top + n: row for n, row in enumerate(ordered, 1)}}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_batches_match_a_row_by_row_load(spark, seed):
    rng = random.Random(seed)
    names = [*"ABCDEFGH", None]
    dim = [(k, rng.choice(names), "x", day(rng.randint(0, 9)), rng.choice([END, day(rng.randint(5, 15))]), 1) for k in range(1, 40)]
    batch = list({(rng.choice(names), day(rng.randint(0, 30))): None for _ in range(25)})
    batch = [(bk, start, rng.choice([END, day(40)])) for bk, start in batch]
    applied = apply_history(spark.createDataFrame(dim, DIM), staged(spark, *batch), SPEC, 9)
    assert outcome(applied) == model(dim, batch)


def test_a_second_run_closes_its_own_rows(spark):
    batch = staged(spark, ("A", day(5), END))
    twice = outcome(apply_history(apply_history(dimension(spark), batch, SPEC, 8), batch, SPEC, 9))
    assert twice[4] == ("A", day(5), day(5)) and twice[5] == ("A", day(5), END)


def test_new_rows_carry_the_load_and_old_rows_keep_theirs(spark):
    applied = apply_history(dimension(spark), staged(spark, ("A", day(5), END)), SPEC, 9)
    assert {r["key"]: r["Lineage_Key"] for r in applied.collect()} == {1: 1, 2: 1, 3: 1, 4: 9}


def test_every_current_row_of_a_key_is_closed(spark):
    doubled = dimension(spark).unionByName(spark.createDataFrame([(7, "A", "x", day(2), END, 1)], DIM))
    closed = outcome(close_versions(doubled, staged(spark, ("A", day(5), END)), SPEC))
    assert closed[1][2] == closed[7][2] == day(5)


def test_copies_in_a_batch_all_get_keys(spark):
    copies = staged(spark, *[("A", day(5), END)] * 50)
    keys = sorted(r["key"] for r in apply_history(dimension(spark), copies, SPEC, 9).collect())
    assert keys == list(range(1, 54))


def test_version_counts_and_inverted_versions(spark):
    assert [tuple(r) for r in multi_version_keys(dimension(spark), SPEC).collect()] == [("A", 2)]
    applied = apply_history(dimension(spark), staged(spark, ("A", day(0), END)), SPEC, 9)
    assert [r["key"] for r in inverted_versions(applied).collect()] == [1]


def test_closed_rows_do_not_enter_the_join(spark, tmp_path):
    path = str(tmp_path / "dim")
    dimension(spark).write.parquet(path)
    closed = close_versions(spark.read.parquet(path), staged(spark, ("A", day(5), END)), SPEC)
    plan = closed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and "EqualTo(Valid_To,9999-12-31T23:59:59.999999)" in plan


LINES = "WWI_Invoice_ID bigint, line string"


@pytest.mark.parametrize(
    "batch, left",
    [
        ([(1, "a2")], ["a2", "c", "d"]),
        ([(1, "a2"), (1, "a2")], ["a2", "a2", "c", "d"]),
        ([(3, "e")], ["a", "b", "c", "d", "e"]),
        ([(None, "f")], ["a", "b", "c", "d", "f"]),
        ([], ["a", "b", "c", "d"]),
    ],
)
def test_replace_by_invoice(spark, batch, left):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], LINES)
    replaced = replace_by_invoice(fact, spark.createDataFrame(batch, LINES))
    assert sorted(r["line"] for r in replaced.collect()) == left


def loads(spark):
    done, waiting = (day(1), True), (None, False)
    rows = [(1, "Customer", done, 1), (2, "Customer", waiting, 2), (3, "Customer", waiting, 3), (4, "Sale", done, 4)]
    return spark.createDataFrame([(k, day(0), t, end, ok, day(10 * c)) for k, t, (end, ok), c in rows], LINEAGE)


def test_open_key_is_the_newest_unfinished(spark):
    assert control.open_load_key(loads(spark), "Customer").collect() == [(3,)]
    assert control.open_load_key(loads(spark), "Sale").collect() == [(None,)]
    assert {tuple(r) for r in control.open_load_keys(loads(spark)).collect()} == {("Customer", 3), ("Sale", None)}


def test_a_load_without_lineage_is_refused(spark):
    assert control.require_open_load(loads(spark), "Customer") == 3
    with pytest.raises(ValueError, match="no open load for Sale"):
        control.require_open_load(loads(spark), "Sale")


def test_opening_takes_the_next_key(spark):
    opened = control.open_load(loads(spark), "Sale", day(20), day(19))
    assert control.started_load_key(opened, "Sale", day(20)).collect() == [(5,)]
    assert opened.where("Lineage_Key = 5").collect() == [(5, day(20), "Sale", None, False, day(19))]
    first = control.open_load(spark.createDataFrame([], LINEAGE), "Sale", day(20), day(19))
    assert [r["Lineage_Key"] for r in first.collect()] == [1]


def test_closing_leaves_other_loads_open(spark):
    closed = {r["Lineage_Key"]: (r["Data_Load_Completed"], r["Was_Successful"]) for r in control.close_load(loads(spark), 3, day(30)).collect()}
    assert closed == {1: (day(1), True), 2: (None, False), 3: (day(30), True), 4: (day(1), True)}


def test_cutoff_moves_for_one_table_only(spark):
    before = spark.createDataFrame([("Customer", day(0)), ("Sale", day(0))], CUTOFFS)
    after = control.advance_cutoff(before, loads(spark), "Customer", 3)
    assert {tuple(r) for r in after.collect()} == {("Customer", day(30)), ("Sale", day(0))}


def test_only_successful_loads_are_visible(spark):
    rows = spark.range(6).withColumn("Lineage_Key", F.col("id") % 5)
    assert sorted(r["id"] for r in control.visible_loads(rows, loads(spark)).collect()) == [1, 4]
