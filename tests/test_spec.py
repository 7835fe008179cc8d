import pytest

from tallybridge import load_spec, parse_spec
from tallybridge.plans.spec import check_source


def block(**changes):
    base = {
        "source": "T",
        "key": {"source": "K", "target": "Key"},
        "fields": {"Key": {"from": "K", "rules": ["trim"]}},
    }
    return {**base, **changes}


def test_shipped_spec_has_parents_first():
    spec = load_spec()
    assert list(spec) == ["customer", "vendor", "item", "open_invoice", "gl_opening_balance"]
    assert spec["gl_opening_balance"].key_source == ("ACCOUNTNUM", "DEPARTMENT")
    assert spec["open_invoice"].foreign_keys == (("Customer No.", "customer"),)


def test_children_are_moved_behind_their_parents():
    spec = parse_spec({"child": block(foreign_keys={"Key": "parent"}), "parent": block()})
    assert list(spec) == ["parent", "child"]


@pytest.mark.parametrize(
    "raw",
    [
        {"a": block(fields={"Key": {"from": "K", "rules": ["no_such_rule"]}})},
        {"a": block(required=["Name"])},
        {"a": block(dedupe_on=["Name"])},
        {"a": block(key={"source": "K", "target": "Other"})},
        {"a": block(foreign_keys={"Key": "nobody"})},
    ],
)
def test_unknown_names_are_refused(raw):
    with pytest.raises(KeyError):
        parse_spec(raw)


def test_circular_references_are_refused():
    with pytest.raises(ValueError):
        parse_spec({"a": block(foreign_keys={"Key": "b"}), "b": block(foreign_keys={"Key": "a"})})


def test_missing_source_column_is_refused():
    with pytest.raises(KeyError):
        check_source(load_spec()["customer"], ["ACCOUNTNUM", "NAME"])
