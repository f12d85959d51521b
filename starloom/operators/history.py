"""Type 2 history: close the current versions of staged keys, then append the staged versions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.constants import end_of_time
from starloom.operators.lookup import duplicate_keys
from starloom.operators.ordered import dense_keys
from starloom.session import materialise

VALID_FROM = "Valid_From"
VALID_TO = "Valid_To"
LINEAGE_KEY = "Lineage_Key"


@dataclass(frozen=True)
class HistorySpec:
    """Names that tell one versioned dimension from another."""

    table: str
    business_key: str
    surrogate: str


CUSTOMER = HistorySpec("Customer", "WWI_Customer_ID", "Customer_Key")
STOCK_ITEM = HistorySpec("Stock Item", "WWI_Stock_Item_ID", "Stock_Item_Key")
SUPPLIER = HistorySpec("Supplier", "WWI_Supplier_ID", "Supplier_Key")


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.where(F.col(VALID_TO) == end_of_time())


def rows_to_close_off(staging: DataFrame, spec: HistorySpec) -> DataFrame:
    """The earliest staged start per business key."""
    return staging.groupBy(spec.business_key).agg(F.min(VALID_FROM).alias(VALID_FROM))


def close_versions(dimension: DataFrame, staging: DataFrame, spec: HistorySpec) -> DataFrame:
    """End every current version of a staged key at the earliest staged start.

    Only current rows take part in the join. Closed rows, the bulk of a long history, go round it.
    A key whose staged starts are all NULL still matches and ends at NULL. The starts are written
    first: their size is then known, and a key with very many current rows can be split.
    """
    starts = rows_to_close_off(staging, spec)
    ends = materialise(
        starts.select(F.col(spec.business_key).alias("_bk"), F.col(VALID_FROM).alias("_end"), F.lit(True).alias("_staged")), "ends"
    )
    untouched = dimension.where(~F.col(VALID_TO).eqNullSafe(end_of_time()))
    closing = F.when(F.col("_staged"), F.col("_end")).otherwise(F.col(VALID_TO))
    touched = (
        current_rows(dimension)
        .join(ends, F.col(spec.business_key) == F.col("_bk"), "left")
        .select(*[closing.alias(c) if c == VALID_TO else F.col(c) for c in dimension.columns])
    )
    return untouched.unionByName(touched)


def number_staged(dimension: DataFrame, staging: DataFrame, spec: HistorySpec) -> DataFrame:
    """Staged versions with keys that continue after the largest key in use, by business key and start.

    Versions that share both are told apart by a short hash, which keeps wide columns out of the sort
    key, and exact copies by their place in the batch, so that any number of copies still spreads over
    all sort tasks. ``staging`` must be a stored table: then that place is the same on a retry.
    """
    largest = F.coalesce(dimension.agg(F.max(spec.surrogate).alias("largest")).scalar(), F.lit(0))
    placed = staging.withColumn("_place", F.monotonically_increasing_id())
    order = [spec.business_key, VALID_FROM, F.xxhash64(*staging.columns), "_place"]
    return dense_keys(placed, order, spec.surrogate, after=largest).drop("_place")


def apply_history(dimension: DataFrame, staging: DataFrame, spec: HistorySpec, lineage_key: Column | int) -> DataFrame:
    """The dimension after one batch: closed versions plus all staged versions as they are.

    The batch is written once, then read for closing and for numbering. Applying a batch twice
    closes its own rows and appends them again, as the load it models does.
    """
    stamp = (F.lit(lineage_key) if isinstance(lineage_key, int) else lineage_key).cast("bigint")
    batch = materialise(staging, "staged")
    appended = number_staged(dimension, batch, spec).withColumn(LINEAGE_KEY, stamp)
    return close_versions(dimension, batch, spec).unionByName(appended.select(*dimension.columns))


def multi_version_keys(dimension: DataFrame, spec: HistorySpec) -> DataFrame:
    return duplicate_keys(dimension, spec.business_key)


def inverted_versions(dimension: DataFrame) -> DataFrame:
    """Versions that end before they start, left by a batch staged out of time order."""
    return dimension.where(F.col(VALID_TO) < F.col(VALID_FROM))
