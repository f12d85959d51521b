"""Fixed values shared by every load, check and report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
#: Sums over whole tables: wide enough for any number of rows.
TOTAL = DecimalType(38, 2)
RATE = DecimalType(18, 3)

# They decide which rows are current and what a report prints.
END_OF_TIME = "9999-12-31 23:59:59.999999"
END_OF_TIME_DATE = "9999-12-31"
UNKNOWN_KEY = 0
UNCATEGORISED = "(sin categoría)"
CURRENCY_PREFIX = "S/ "
KPI_REVENUE = "Ingresos (con IGV)"
KPI_LINES = "Líneas de venta"
KPI_CUSTOMERS = "Clientes"
KPI_TICKET = "Ticket promedio"
TOP_ITEMS = 6
MINIMUM_BAR = 2
TOLERANCE = "0.01"


def end_of_time() -> Column:
    return F.lit(END_OF_TIME).cast("timestamp_ntz")


def end_of_time_date() -> Column:
    return F.lit(END_OF_TIME_DATE).cast("date")
