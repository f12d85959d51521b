"""Column types of text values, from all rows in one pass.

A value's mask has a bit for each type that can hold it. The masks of a column meet in a bitwise AND, which merges in any order; the column's type
is the narrowest one left. A column without values is text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits in order of preference, and the type each stands for.
BOOLEAN, WHOLE, REAL, DAY, MOMENT, TEXT = (1 << i for i in range(6))
TYPES = {BOOLEAN: "boolean", WHOLE: "bigint", REAL: "double", DAY: "date", MOMENT: "timestamp_ntz", TEXT: "string"}
#: Set while no value would lose a sign or zeros in front as a number.
VERBATIM = 1 << 6


def mask(value: Column) -> Column:
    """The types that a value can have; NULL for NULL. Whole numbers beyond bigint are text, as a double would lose digits."""
    whole = value.rlike(r"^[-+]?\d+$")
    number = value.rlike(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$")
    fits = value.try_cast("bigint").isNotNull()
    day = value.rlike(r"^\d{4}-\d{2}-\d{2}$")
    moment = value.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$")
    bits = [
        (BOOLEAN, F.lower(value).isin("true", "false")),
        (WHOLE, whole & fits),
        (REAL, number & (~whole | fits) & value.try_cast("double").isNotNull()),
        (DAY, day & value.try_cast("date").isNotNull()),
        (MOMENT, moment & value.try_cast("timestamp_ntz").isNotNull()),
        (VERBATIM, ~value.rlike(r"^(\+|-?0\d)")),
    ]
    total = F.lit(TEXT)
    for bit, holds in bits:
        total = total + F.when(holds, F.lit(bit)).otherwise(F.lit(0))
    return F.when(value.isNotNull(), total)


def infer_types(values: DataFrame, keep_zeros: bool = False) -> dict[str, str]:
    """The type of each text column of ``values``. With ``keep_zeros``, numbers written with zeros or a plus in front make their column text."""
    if not values.columns:
        return {}
    met = values.agg(*[F.bit_and(mask(F.col(f"`{name}`"))).alias(str(i)) for i, name in enumerate(values.columns)]).first()
    found = {}
    for name, left in zip(values.columns, met, strict=True):
        left = TEXT if left is None else left
        if keep_zeros and not left & VERBATIM:
            left &= ~(WHOLE | REAL)
        found[name] = next(kind for bit, kind in TYPES.items() if left & bit)
    return found


def with_types(values: DataFrame, types: dict[str, str]) -> DataFrame:
    return values.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.items()])
