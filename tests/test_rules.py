import pytest
from pyspark.sql import functions as F

from tallybridge import apply_rules, register_rule
from tallybridge.functions.rules import RULES

VECTORS = [
    (["trim", "upper"], "\tax-17b\u00a0", "AX-17B"),
    (["trim", "upper", "map_posting_group"], " Interco", "INTERCOMPANY"),
    (["trim", "upper", "lcy_blank"], " inr\t", ""),
    (["trim", "upper", "lcy_blank"], "Aed ", "AED"),
    (["trim", "lower", "valid_email_or_blank"], "desk at example.org", ""),
    (["trim", "lower", "valid_email_or_blank"], " Desk.1+x@Example.ORG ", "desk.1+x@example.org"),
    (["lcy_blank"], None, ""),
    (["lcy_blank"], "inr", "inr"),
    (["map_posting_group"], None, None),
    (["map_posting_group"], "ZZZ", None),
    (["map_blocked"], "0", ""),
    (["map_blocked"], "1", "Invoice"),
    (["map_blocked"], "1.0", "Invoice"),
    (["map_blocked"], "2", "All"),
    (["map_blocked"], "9", ""),
    (["map_blocked"], None, ""),
    (["default_pcs"], None, "PCS"),
    (["default_pcs"], "", "PCS"),
    (["default_pcs"], " ", " "),
    (["trim", "default_pcs"], " ", "PCS"),
    (["trim"], "\t a ", "a"),
    (["trim"], " x y　", "x y"),
    (["trim"], "x y", "x y"),
    (["trim"], "é ", "é"),
    (["trim"], "", ""),
    (["trim"], None, None),
    (["truncate_30"], "ü" * 40, "ü" * 30),
    (["truncate_100"], "a" * 101, "a" * 100),
    (["valid_email_or_blank"], None, ""),
    (["valid_email_or_blank"], " a@b.com", ""),
    (["upper"], None, None),
]


def test_vectors(spark):
    """All vectors in one plan, each applied to its own input."""
    row = spark.range(1).select(
        *[
            apply_rules(F.lit(value).cast("string"), names).alias(f"v{i}")
            for i, (names, value, _) in enumerate(VECTORS)
        ]
    ).first()
    got = list(row)
    assert got == [expected for _, _, expected in VECTORS]


def test_to_decimal(spark):
    values = ["1", " 2.5 ", "-3.256", "x", "", None, "1e3", "99999999999999999999"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [str(r[0]) for r in df.select(apply_rules(F.col("v"), ["to_decimal"])).collect()]
    assert got == ["1.00", "2.50", "-3.26", "None", "None", "None", "1000.00", "None"]


def test_unknown_rule_raises(spark):
    with pytest.raises(KeyError):
        apply_rules(F.lit("AX-17B"), ["trim", "reverse_digits"])


def test_custom_rule_takes_part_in_a_chain(spark):
    register_rule("first_two", lambda c: F.substring(c, 1, 2))
    try:
        value = spark.range(1).select(apply_rules(F.lit(" abc "), ["trim", "first_two", "upper"]))
        assert value.first()[0] == "AB"
    finally:
        RULES.pop("first_two")
