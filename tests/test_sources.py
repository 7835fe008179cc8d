import re

import pytest

from tallybridge import check_rows, migrate
from tallybridge.session import new_folder, recorded, remove_folder, shared_root
from tallybridge.sinks import write_checks, write_exports, write_results, write_table
from tallybridge.sources.exports import (
    enable_change_feed,
    export_folders,
    load_tables,
    read_exports,
    row_counts,
)
from tallybridge.sources.extracts import land_extract, land_folder, read_extract
from workloads.exports import export
from workloads.extracts import extracts


def test_null_tokens_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('K,V\n007,x\n"",NA\n1,"a,""b"""\nnull,n/a\nNone, NA \n')
    rows = [tuple(r) for r in read_extract(spark, str(path)).collect()]
    assert rows == [("007", "x"), (None, None), ("1", 'a,"b"'), (None, None), (None, " NA ")]
    kept = [tuple(r) for r in read_extract(spark, str(path), ["K", "V"], null_tokens=[""]).collect()]
    assert kept[1] == (None, "NA") and kept[4] == ("None", " NA ")


def test_header_must_match(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("K,V\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|column"):
        read_extract(spark, str(path), ["V", "K"]).collect()


def test_ragged_rows_are_refused(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("K,V\n1,2,3\n")
    with pytest.raises(Exception):
        read_extract(spark, str(path), ["K", "V"]).collect()


def test_landed_rows_keep_source_order(spark, tmp_path):
    """Two files (one name with a blank) in many splits: positions ascend in source order."""
    folder = tmp_path / "T"
    folder.mkdir()
    rows = [f"{i:05d},{'x' * (i % 37)}" for i in range(4000)]
    (folder / "a 1.csv").write_text("\n".join(["K,V", *rows[:2600]]) + "\n")
    (folder / "b.csv").write_text("\n".join(["K,V", *rows[2600:]]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        landed = land_extract(spark, str(folder), str(tmp_path / "landed"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    keys = [r.K for r in landed.orderBy("_source_row").collect()]
    assert keys == [r.split(",")[0] for r in rows]
    assert landed.select("_source_row").distinct().count() == 4000


def test_folder_of_extracts(spark, tmp_path):
    (tmp_path / "src").mkdir()
    for name in ("B", "A"):
        (tmp_path / "src" / f"{name}.csv").write_text("K\n1\n")
    (tmp_path / "src" / "notes.txt").write_text("no table")
    landed = land_folder(spark, str(tmp_path / "src"), str(tmp_path / "out"))
    assert list(landed) == ["A", "B"]


def test_quoted_line_breaks_are_refused_or_read(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "A.csv").write_text('K,V\n1,"a\nb"\n2,"say ""x"""\n')
    with pytest.raises(ValueError, match="multi_line"):
        land_folder(spark, str(tmp_path / "src"), str(tmp_path / "out"))
    landed = land_folder(spark, str(tmp_path / "src"), str(tmp_path / "out"), multi_line=True)["A"]
    assert [tuple(r)[:2] for r in landed.orderBy("_source_row").collect()] == [("1", "a\nb"), ("2", 'say "x"')]


def test_headers_in_another_order_are_refused(spark, tmp_path):
    folder = tmp_path / "T"
    folder.mkdir()
    (folder / "a.csv").write_text("K,V\n1,2\n")
    (folder / "b.csv").write_text("V,K\n2,1\n")
    with pytest.raises(ValueError, match="headers differ"):
        land_extract(spark, str(folder), str(tmp_path / "landed"))


def test_every_export_folder_is_found(spark, tmp_path):
    base = tmp_path / "exp"
    base.mkdir()
    with pytest.raises(FileNotFoundError):
        export_folders(spark, str(base))
    names = ["Customer-18", "Item2Lot-50100", "Sales_Header-36", "company_map"]
    for n in names:
        spark.range(2).write.parquet(str(base / n))
    (base / "_log").mkdir()
    for path in (str(base), f"{base}//", re.sub("/exp$", "//exp", str(base))):
        assert set(read_exports(spark, path)) == {"Customer_18", "Item2Lot_50100", "Sales_Header_36", "company_map"}
    spark.range(1).write.parquet(str(base / "company-map"))
    with pytest.raises(ValueError, match="share"):
        export_folders(spark, str(base))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_results_round_trip(spark, sf_dir, tmp_path, fmt):
    run = migrate(spark, extracts(spark, sf_dir), entities=["customer"])
    write_results(run, str(tmp_path / "t"), str(tmp_path / "r"), fmt)
    if fmt == "csv":
        rejects = read_extract(spark, str(tmp_path / "r" / "customer"))
        loaded = read_extract(spark, str(tmp_path / "t" / "customer"))
    else:
        rejects = spark.read.parquet(str(tmp_path / "r" / "customer"))
        loaded = spark.read.parquet(str(tmp_path / "t" / "customer"))
    assert "_source_row" not in loaded.columns
    assert loaded.count() == run["customer"].loaded.count()
    back, sent = rejects.collect(), run["customer"].rejects.collect()
    assert sorted(map(str, back)) == sorted(map(str, sent))
    assert any(r.ACCOUNTNUM.endswith(" ") for r in back)


def test_csv_extracts_migrate_like_the_tables_they_hold(spark, sf_dir, tmp_path):
    """CSV -> landed -> migrated equals migrating the extracts directly."""
    sources = extracts(spark, sf_dir)
    for name in ("CUSTTABLE", "CUSTTRANSOPEN"):
        ordered = sources[name].orderBy("_source_row").drop("_source_row").coalesce(1)
        write_table(ordered, str(tmp_path / name), "csv")
    landed = {
        n: land_extract(spark, str(tmp_path / n), str(tmp_path / f"{n}.landed"))
        for n in ("CUSTTABLE", "CUSTTRANSOPEN")
    }
    run = migrate(spark, landed, entities=["customer", "open_invoice"])
    direct = migrate(spark, sources, entities=["customer", "open_invoice"])
    for name in ("customer", "open_invoice"):
        for side in ("loaded", "rejects"):
            a, b = getattr(run[name], side), getattr(direct[name], side)
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_export_round_trip(spark, sf_dir, tmp_path):
    tables = {n: export(spark, sf_dir, n) for n in ("Customer-18", "CustLedgerEntry-21")}
    write_exports(tables, str(tmp_path / "deltas"))
    assert export_folders(spark, str(tmp_path / "deltas")) == ["CustLedgerEntry-21", "Customer-18"]
    back = read_exports(spark, str(tmp_path / "deltas"))
    for name, df in tables.items():
        again = back[name.replace("-", "_")]
        assert again.columns == df.columns
        assert again.count() == df.count()


def test_load_is_repeatable_and_counted(spark, sf_dir):
    tables = {"Customer_18": export(spark, sf_dir, "Customer-18")}
    for _ in range(2):
        load_tables(spark, tables, "loaded")
    counts = row_counts({"Customer_18": spark.table("loaded.Customer_18")}).collect()
    assert [tuple(r) for r in counts] == [("Customer_18", tables["Customer_18"].count())]


def test_change_feed_needs_delta(spark, sf_dir):
    load_tables(spark, {"Plain_1": spark.range(1)}, "loaded")
    with pytest.raises(ValueError):
        enable_change_feed(spark, ["loaded.Plain_1"])


def test_check_report_as_json(spark, sf_dir, tmp_path):
    run = migrate(spark, extracts(spark, sf_dir), entities=["vendor"])
    write_checks(check_rows(run), str(tmp_path / "report"))
    totals = spark.read.json(str(tmp_path / "report" / "totals")).first()
    assert (totals["passed"], totals["total"]) == (2, 2)
    checks = spark.read.json(str(tmp_path / "report" / "checks")).collect()
    assert {c["check"] for c in checks} == {
        "row accounting (loaded + rejected)", "key checksum (MD5)",
    }


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert new_folder(spark, "x").startswith(root)
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_folders_of_a_run_can_be_deleted(spark):
    with recorded() as outer:
        with recorded() as inner:
            first = new_folder(spark, "a")
        second = new_folder(spark, "b")
    third = new_folder(spark, "c")
    assert (inner, outer) == ([first], [first, second]) and third not in outer
    spark.range(3).write.parquet(first)
    remove_folder(spark, first)
    remove_folder(spark, second)  # was never written
    with pytest.raises(Exception, match="(?i)not.*exist"):
        spark.read.parquet(first)
    with pytest.raises(ValueError, match="not made here"):
        remove_folder(spark, shared_root(spark))


def test_blanks_are_kept_and_empty_text_is_null(spark, tmp_path):
    df = spark.createDataFrame([(" a ", ""), ("b\t", None)], "k string, v string")
    write_table(df, str(tmp_path / "t"), "csv")
    back = {tuple(r) for r in read_extract(spark, str(tmp_path / "t")).collect()}
    assert back == {(" a ", None), ("b\t", None)}
