import pytest
from pyspark.sql import functions as F

from tallybridge.llm import url_reputation as U


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("HTTP://A.Example.COM/x?y#z", "a.example.com", "/x"),
        ("https://a.b#f/g", "a.b", ""),
        ("https://a.b?q=/x", "a.b", ""),
        ("ftp://u@h:8080/p/q#r?s", "u@h:8080", "/p/q"),
        ("a://b://c/d", "b:", "//c/d"),
        ("no scheme/x", "", ""),
        ("", "", ""),
        (None, "", ""),
        ("://", "", ""),
        ("x://ÄB/é\n?", "Äb", "/é\n"),
    ],
)
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(U.host_of(F.col("url")), U.path_of(F.col("url"))).first()
    assert tuple(row) == (host, path)


def test_levels(spark):
    hosts = ["a.b.example.co.uk", "example.co.uk", "co.uk", "www.site.org", "site.org", "org", "", "x.y:80", "u@x.y."]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r[0]: (r[1], r[2]) for r in df.select("host", U.domain_of(F.col("host")), U.suffix_of(F.col("host"))).collect()}
    assert got["a.b.example.co.uk"] == got["example.co.uk"] == ("example.co.uk", "co.uk")
    assert got["co.uk"] == ("co.uk", "co.uk") and got["www.site.org"] == ("site.org", "org") and got["org"] == ("org", "org")
    assert got["x.y:80"] == got["u@x.y."] == ("x.y", "y") and got[""] == ("", "")


def test_longest_rule_wins(spark):
    urls = {
        "http://example.net/en/1": ("example.net/en/", "allow"),
        "http://example.net/EN/1": ("net/", "block"),
        "http://m.example.net/en/": ("example.net/en/", "allow"),
        "http://badexample.net/en/1": ("net/", "block"),
        "http://net/": ("net/", "block"),
        "http://a.net": (None, None),
        "http://x.example.com/de/a": ("example.com/de/", "block"),
        "http://x.org/fr/a": ("org/fr/", "allow"),
        "http://x.org/en/a": (None, None),
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    df = df.select("url", U.host_of(F.col("url")).alias("host"), U.path_of(F.col("url")).alias("path"))
    got = {r[0]: (r[1], r[2]) for r in df.select("url", *U.rule_for(F.col("host"), F.col("path"))).collect()}
    assert got == urls


def outcomes(spark, counts):
    rows = [(h, int(i < bad)) for h, (n, bad) in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "host string, bad int")


def test_hosts_are_shrunk_towards_their_domain(spark):
    counts = {f"h{i}.good.com": (40, 1) for i in range(6)} | {f"h{i}.bad.com": (40, 38) for i in range(6)} | {"one.good.com": (1, 1), "own.net": (50, 5)}
    seen = [(h,) for h in [*counts, "new.bad.com", "new.good.com", "new.com", "new.zz", "", None]]
    got = {r["host"]: r for r in U.reputation(outcomes(spark, counts), spark.createDataFrame(seen, "host string")).collect()}
    assert got["one.good.com"]["rate"] < 0.5 < got["new.bad.com"]["rate"]
    assert got["new.good.com"]["rate"] < got["one.good.com"]["rate"] < 1
    assert got["h1.bad.com"]["bound"] > 0.5 > got["new.zz"]["bound"]
    assert got["h1.bad.com"]["bound"] < got["h1.bad.com"]["rate"]
    pages = spark.createDataFrame([(1, "http://h1.bad.com/x"), (2, "http://h1.good.com/x"), (3, None), (4, "http://zz.net/")], "page_id bigint, url string")
    pages = pages.withColumns({"Verdict": F.lit("old"), "bound": F.lit("old"), "n": F.lit(1)})
    judged = U.judge(pages, outcomes(spark, counts))
    assert judged.columns.count("verdict") == 1 and "Verdict" not in judged.columns
    assert {r["page_id"]: r["verdict"] for r in judged.collect()} == {1: "block", 2: "allow", 3: "allow", 4: "block"}


def test_no_outcomes_and_empty_tables(spark):
    none = spark.createDataFrame([("a.com", None), (None, 1)], "host string, bad int")
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/"), (None, None)], "page_id bigint, url string")
    assert [r["verdict"] for r in U.judge(pages, none).collect()] == ["allow"] * 3
    assert U.judge(pages.where("false"), none).count() == 0
