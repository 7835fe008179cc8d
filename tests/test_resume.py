"""A run that breaks is taken up where it stopped."""

import json

import pytest

from tallybridge import check_rows, gate, migrate
from tallybridge.session import read_text, write_text
from workloads.extracts import extracts

ALL = ["customer", "vendor", "item", "open_invoice", "gl_opening_balance"]


@pytest.fixture(scope="module")
def sources(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("extracts")
    found = {}
    for name, df in extracts(spark, sf_dir).items():
        df.write.parquet(str(base / name))
        found[name] = spark.read.parquet(str(base / name))
    return found


def tables(run):
    return {n: (sorted(map(str, r.loaded.collect())), sorted(map(str, r.rejects.collect()))) for n, r in run.results.items()}


def files(run):
    return {n: set(r.classified.inputFiles()) for n, r in run.results.items()}


def test_a_broken_run_continues(spark, sources, tmp_path):
    folder = str(tmp_path / "run")
    broken = {**sources, "CUSTTRANSOPEN": sources["CUSTTRANSOPEN"].drop("AMOUNTCUR"), "INVENTTABLE": sources["INVENTTABLE"].drop("PRICE")}
    with pytest.raises(KeyError):
        migrate(spark, broken, folder=folder, resume=True)
    run = migrate(spark, sources, folder=folder, resume=True)
    assert run.resumed == {"customer", "vendor", "gl_opening_balance"} and list(run.results) == ALL
    assert tables(run) == tables(migrate(spark, sources))
    gate(check_rows(run))
    kept = files(run)
    again = migrate(spark, sources, folder=folder, resume=True)
    assert again.resumed == set(ALL) and files(again) == kept
    assert tables(again) == tables(run)


def test_what_changed_is_run_again(spark, sources, tmp_path):
    folder = str(tmp_path / "run")
    first = migrate(spark, sources, folder=folder, resume=True)
    assert first.resumed == set()
    # another input: the entity, and the one that refers to it, are run again
    sources["CUSTTABLE"].filter("ACCOUNTNUM NOT LIKE '%9'").write.parquet(str(tmp_path / "fewer"))
    fewer = {**sources, "CUSTTABLE": spark.read.parquet(str(tmp_path / "fewer"))}
    run = migrate(spark, fewer, folder=folder, resume=True)
    assert run.resumed == {"vendor", "item", "gl_opening_balance"}
    assert tables(run) == tables(migrate(spark, fewer))
    # the same files with other rows
    same_names = {**fewer, "VENDTABLE": fewer["VENDTABLE"].filter("ACCOUNTNUM NOT LIKE '%1'")}
    assert "vendor" not in migrate(spark, same_names, folder=folder, resume=True).resumed


def test_a_table_without_its_manifest_does_not_count(spark, sources, tmp_path):
    """The manifest goes before the table and comes after it."""
    folder = str(tmp_path / "run")
    migrate(spark, sources, folder=folder, resume=True, entities=["vendor", "item"])
    path = f"{folder}/_commits/vendor.json"
    commit = json.loads(read_text(spark, path))
    assert commit["rows"] == {"loaded": sources["VENDTABLE"].count()}
    write_text(spark, path, json.dumps({**commit, "plan": "other"}))
    (tmp_path / "run" / "_commits" / "item.json").unlink()
    assert migrate(spark, sources, folder=folder, resume=True, entities=["vendor", "item"]).resumed == set()
    with pytest.raises(ValueError, match="named"):
        migrate(spark, sources, resume=True)


def test_small_files_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "a" / "b.json")
    assert read_text(spark, path) is None
    for text in ("one\ntwo é", "three"):
        write_text(spark, path, text)
        assert read_text(spark, path) == text
    assert [p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")] == ["b.json"]
