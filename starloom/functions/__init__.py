from starloom.functions.expressions import (
    bar_share,
    date_key,
    grouped_digits,
    money_label,
    month_label,
    whole_units,
)

__all__ = ["bar_share", "date_key", "grouped_digits", "money_label", "month_label", "whole_units"]
