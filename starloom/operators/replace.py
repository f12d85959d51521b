"""Replace the fact lines of restated invoices."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from starloom.session import materialise

#: Rows of two whole numbers that every executor may hold, each for up to 64 invoices.
WORDS = 2_000_000


def restated_invoices(staged: DataFrame, invoice: str) -> DataFrame:
    """The staged invoices, one row each.

    Written, so that their size is known before the join, and so that a hot invoice on the fact side
    can be split: Spark does not do that against a side that it groups for the same join.
    """
    invoices = staged.select(F.col(invoice).alias("_invoice")).where(F.col("_invoice").isNotNull()).distinct()
    return materialise(invoices, "invoices")


@dataclass(frozen=True)
class Restated:
    """Invoices, one row each, and the same packed as bits of words that are broadcast; without ``words`` where these are too many."""

    invoices: DataFrame
    words: DataFrame | None

    def lines(self, fact: DataFrame, invoice: str, how: str) -> DataFrame:
        """The lines of these invoices (``left_semi``) or all others (``left_anti``), which lines without an invoice belong to."""
        if self.words is None:
            return fact.join(self.invoices, F.col(invoice) == F.col("_invoice"), how)
        hit = F.coalesce(F.bit_get("_bits", _place(invoice)), F.lit(0)) == 1
        marked = fact.join(F.broadcast(self.words), _word(invoice) == F.col("_word"), "left")
        return marked.where(hit if how == "left_semi" else ~hit).select(*fact.columns)


def _word(number: str):
    return F.shiftright(F.col(number).cast("bigint"), 6)


def _place(number: str):
    return F.col(number).cast("bigint").bitwiseAND(F.lit(63)).cast("int")


def restated(staged: DataFrame, invoice: str) -> Restated:
    """The staged invoices. Invoice numbers mostly lie close together, so that few words hold them; the words are counted."""
    invoices = restated_invoices(staged, invoice)
    if not isinstance(invoices.schema["_invoice"].dataType, (LongType, IntegerType)):
        return Restated(invoices, None)
    bit = F.expr("shiftleft(1L, CAST(CAST(_invoice AS BIGINT) & 63 AS INT))")
    words = materialise(invoices.groupBy(_word("_invoice").alias("_word")).agg(F.bit_or(bit).alias("_bits")), "invoice-words")
    return Restated(invoices, words if words.count() <= WORDS else None)


def replace_by_invoice(fact: DataFrame, staged: DataFrame, invoice: str = "WWI_Invoice_ID") -> DataFrame:
    """Drop every fact line of a staged invoice, then add all staged lines.

    Lines without an invoice are never dropped, staged copies all stay, and an empty batch changes
    nothing. A small batch is broadcast and leaves the fact unshuffled.
    """
    restated = restated_invoices(staged, invoice)
    kept = fact.join(restated, F.col(invoice) == F.col("_invoice"), "left_anti")
    return kept.unionByName(staged.select(*fact.columns))
