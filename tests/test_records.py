"""Extracts with line breaks inside quoted values, cut into many splits."""

import csv
import io
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tallybridge.sources import records as R
from tallybridge.sources.extracts import land_extract, landing_counts, read_extract


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def table_text(seed, n, end="\n"):
    """A CSV text with breaks, doubled quotes, stray quotes and blank lines, and its rows."""
    rng = random.Random(seed)
    rows, lines = [], ["K,V,W"]
    for i in range(n):
        value = rng.choice(['plain', '19" rack', 'a "b" c', f"first{end}second, half", f'say ""x"""{end}', f"{end}{end}", '"', "", "x" * rng.randint(0, 90)])
        other = rng.choice(["1", '5" x 6"', f"{end}".join("line %d" % j for j in range(rng.randint(0, 9))), 'tail"'])
        rows.append((f"k{i}", value, other))
        # a field that starts with a quote or holds a comma or a break is quoted; others are only sometimes
        cells = [f"k{i}"]
        for v in (value, other):
            must = v.startswith('"') or "," in v or "\n" in v
            cells.append('"' + v.replace('"', '""') + '"' if must or rng.random() < 0.2 else v)
        lines.append(",".join(cells))
        if rng.random() < 0.05:
            lines.append(rng.choice(["", "  "]))
    return end.join(lines) + (end if seed % 2 else ""), rows


@pytest.mark.parametrize("seed,end", [(1, "\n"), (2, "\r\n"), (3, "\n"), (4, "\n")])
def test_one_file_is_cut_at_record_borders(spark, tmp_path, small_splits, seed, end):
    text, rows = table_text(seed, 120, end)
    path = tmp_path / "a b.csv"
    path.write_bytes(text.encode())
    if end == "\n":  # an independent reader agrees on what the text means
        known = [tuple(r) for r in csv.reader(io.StringIO(text)) if r and r[0].strip()]
        assert known[1:] == rows
    landed = land_extract(spark, str(path), str(tmp_path / "out" / "T"), null_tokens=(), multi_line=True)
    got = landed.orderBy("_source_row").collect()
    assert [(r.K, r.V or "", r.W or "") for r in got] == rows
    assert len({r._source_row for r in got}) == len(rows)
    assert landing_counts(spark, str(tmp_path / "out"), ["T"]) == {"T": len(rows)}
    found = R.survey_files(spark, str(path), spark.read.text(str(path)).inputFiles())
    assert found.splits.count() >= 4 and found.breaks > 0
    assert R.records(found, ["K", "V", "W"], "at").rdd.getNumPartitions() >= 4


def test_single_lines_and_records_get_the_same_positions(spark, tmp_path, small_splits):
    """The plain path and the record path give each row the same place."""
    path = tmp_path / "a.csv"
    path.write_text("K,V,W\n" + "\n".join(f'k{i},19" x,"a ""b"""' for i in range(200)) + "\n")
    plain = land_extract(spark, str(path), str(tmp_path / "plain"))
    found = R.survey_files(spark, str(path), spark.read.text(str(path)).inputFiles())
    assert found.breaks == 0 and found.splits is None
    cut = R.records(replace(found, splits=R.survey(found.lines)), ["K", "V", "W"], "_source_row")
    assert plain.orderBy("_source_row").drop("_source_row").collect() == cut.orderBy("_source_row").drop("_source_row").collect()
    assert plain.first()["V"] == '19" x' and plain.first()["W"] == 'a "b"'
    assert landing_counts(spark, str(tmp_path), ["plain"]) == {"plain": 200}


def test_a_record_over_several_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(800))
    (tmp_path / "T").mkdir()
    (tmp_path / "T" / "a.csv").write_text(f'K,V\n1,"{long}"\n2,x\n')
    (tmp_path / "T" / "b.csv").write_text('K,V\n3,"y\nz"\n')
    landed = land_extract(spark, str(tmp_path / "T"), str(tmp_path / "out"), multi_line=True)
    assert [tuple(r)[:2] for r in landed.orderBy("_source_row").collect()] == [("1", long), ("2", "x"), ("3", "y\nz")]
    limit, R.MAX_RECORD = R.MAX_RECORD, 1000
    try:
        with pytest.raises(ValueError, match="longer than"):
            land_extract(spark, str(tmp_path / "T"), str(tmp_path / "out"), multi_line=True)
    finally:
        R.MAX_RECORD = limit


def test_unsafe_files_are_refused_by_every_reader(spark, tmp_path):
    folder = tmp_path / "T"
    folder.mkdir()
    (folder / "a.csv").write_text("K,V\nk1,v1\n")
    (folder / "b.csv").write_text("V,K\nv2,k2\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_extract(spark, str(folder))
    (folder / "b.csv").write_text('K,V\n1,"a\nb"\n')
    with pytest.raises(ValueError, match="multi_line"):
        read_extract(spark, str(folder))
    got = read_extract(spark, str(folder), multi_line=True)
    assert got.columns == ["K", "V"] and {tuple(r) for r in got.collect()} == {("k1", "v1"), ("1", "a\nb")}
    (folder / "b.csv").write_text('K,V\n1,"a\n2,b\n')
    for read in (lambda: read_extract(spark, str(folder), multi_line=True), lambda: land_extract(spark, str(folder), str(tmp_path / "o"))):
        with pytest.raises(ValueError, match="never closed"):
            read()


def test_unquoted_inch_marks_are_text(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('K,V\nk1,19" rack\nk2,5" x 6" x 7"\nk3,"quoted, 3"" wide"\n')
    rows = [tuple(r) for r in read_extract(spark, str(path)).collect()]
    assert rows == [("k1", '19" rack'), ("k2", '5" x 6" x 7"'), ("k3", 'quoted, 3" wide')]


def test_files_without_rows(spark, tmp_path):
    folder = tmp_path / "T"
    folder.mkdir()
    (folder / "a.csv").write_text("")
    (folder / "b.csv").write_text("K,V\n")
    (folder / "c.csv").write_text("K,V\n\n1,2")
    landed = land_extract(spark, str(folder), str(tmp_path / "out" / "T"), columns=["K", "V"])
    assert [tuple(r)[:2] for r in landed.collect()] == [("1", "2")]
    assert landing_counts(spark, str(tmp_path / "out"), ["T"]) == {"T": 1}


def test_wrong_number_of_fields_is_refused(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('K,V\n1,"a\nb"\n1,2,3\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_extract(spark, str(path), multi_line=True).collect()


def test_line_functions_against_a_state_machine(spark):
    """Both ends of random lines against a reader that goes character by character."""

    def ends(line, inside):
        state = "quoted" if inside else "start"
        for c in line:
            if state == "quoted":
                state = "closing" if c == '"' else "quoted"
            elif state == "closing" and c == '"':
                state = "quoted"
            elif c == ",":
                state = "start"
            elif state == "start" and c == '"':
                state = "quoted"
            else:
                state = "text"
        return int(state == "quoted")

    rng = random.Random(8)
    lines = ["".join(rng.choices('",a \r', k=rng.randint(0, 12))) for _ in range(3000)] + ['"' + 'x""' * 30_000, "," * 50_000 + '"', '"",' * 50_000]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = {r.i: (r.out_0, r.out_1) for r in R._with_function(df).select("i", "out_0", "out_1").collect()}
    assert all(got[i] == (ends(v, False), ends(v, True)) for i, v in enumerate(lines))
    assert R._with_function(df).where(F.col("blank")).count() == sum(not v.strip() for v in lines)
