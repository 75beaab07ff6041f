"""Column-expression helpers.  Everything here returns a ``Column`` and stays
inside Catalyst / whole-stage codegen (no Python UDFs)."""

from tierline.functions.money import money, money_sum, mean_of_money, safe_ratio, as_int
from tierline.functions.rules import EMAIL_PATTERN, PHONE_PATTERN, matches_fully, as_date

__all__ = [
    "money", "money_sum", "mean_of_money", "safe_ratio", "as_int",
    "EMAIL_PATTERN", "PHONE_PATTERN", "matches_fully", "as_date",
]
