"""Named cleansing rules.

A rule is a function ``Column -> Column``. All shipped rules are built-in expressions, so a whole
chain of them stays inside one code-generated projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = Callable[[Column], Column]

# Code lists, patterns and widths that decide the results.
LOCAL_CURRENCY = "INR"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
POSTING_GROUPS = {
    "DOM": "DOMESTIC",
    "EXP": "EXPORT",
    "INTERCO": "INTERCOMPANY",
    "RETAIL": "RETAIL",
}
BLOCKED_STATES = {0: "", 1: "Invoice", 2: "All"}
DEFAULT_UNIT = "PCS"
MONEY = "decimal(18,2)"
# Every character that counts as whitespace in Unicode text, not only the blank.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim(c: Column) -> Column:
    """Strip every kind of whitespace. One call keeps the generated code of a long chain small."""
    return F.btrim(c, F.lit(WHITESPACE))


def to_decimal(c: Column) -> Column:
    return c.try_cast(MONEY)


def lcy_blank(c: Column) -> Column:
    return F.when(c == LOCAL_CURRENCY, "").otherwise(F.coalesce(c, F.lit("")))


def valid_email_or_blank(c: Column) -> Column:
    return F.when(c.rlike(EMAIL_PATTERN), c).otherwise("")


def map_posting_group(c: Column) -> Column:
    """Translate the group code; a code that is not listed becomes null."""
    codes = F.create_map(*[F.lit(text) for pair in POSTING_GROUPS.items() for text in pair])
    return F.try_element_at(codes, c)


def map_blocked(c: Column) -> Column:
    number = c.try_cast("double")
    out = F.when(number == 0, BLOCKED_STATES[0])
    for code in (1, 2):
        out = out.when(number == code, BLOCKED_STATES[code])
    return out.otherwise("")


def default_pcs(c: Column) -> Column:
    return F.when(c.isNull() | (c == ""), DEFAULT_UNIT).otherwise(c)


RULES: dict[str, Rule] = {
    "trim": trim,
    "upper": F.upper,
    "lower": F.lower,
    "truncate_30": lambda c: F.substring(c, 1, 30),
    "truncate_100": lambda c: F.substring(c, 1, 100),
    "to_decimal": to_decimal,
    "lcy_blank": lcy_blank,
    "valid_email_or_blank": valid_email_or_blank,
    "map_posting_group": map_posting_group,
    "map_blocked": map_blocked,
    "default_pcs": default_pcs,
}


def register_rule(name: str, rule: Rule) -> None:
    """Make ``rule`` available to mapping specs under ``name``."""
    RULES[name] = rule


def rule(name: str) -> Rule:
    if name not in RULES:
        raise KeyError(f"no cleansing rule is called {name!r}; known rules: {sorted(RULES)}")
    return RULES[name]


def apply_rules(c: Column, names: Iterable[str]) -> Column:
    """Compose the named rules from left to right."""
    return reduce(lambda value, name: rule(name)(value), names, c)
