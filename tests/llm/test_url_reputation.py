import pytest

from voxloom.llm import url_reputation as U


def judged(spark, urls, labels=()):
    pages = spark.createDataFrame([(i, u, "<html>", "x") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    told = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    return {r["page_id"]: r for r in U.judge(pages, told).collect()}


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("https://WWW.Example.com/en/1?x=/y#z", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://m.www.example.com/en/", "m.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://a.example.com/en/x", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("http://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
        ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
        ("http://a.net/esx", "a.net", "/esx", None, "allow"),
        ("http://a.com?q", "a.com", "", None, "allow"),
        ("http://ÄB.org#f://x", "Äb.org", "", None, "allow"),
        ("x://y://z", "y:", "//z", None, "allow"),
        ("nothing", "", "", None, "allow"),
        ("http://", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://a\n.com/en/\nb", "a\n.com", "/en/\nb", "com/", "allow"),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule, verdict):
    r = judged(spark, [url])[0]
    assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def test_bad_hosts_are_blocked_and_unknown_ones_follow_their_domain(spark):
    urls = [f"http://bad.org/{i}" for i in range(30)] + [f"http://good.org/{i}" for i in range(30)] + ["http://new.bad.org/", "http://new.good.org/"]
    labels = [(i, 0, 0) for i in range(30)] + [(i, 1, 0) for i in range(30, 60)]
    got = judged(spark, urls, labels)
    assert {got[i]["verdict"] for i in range(30)} == {"block"}
    assert {got[i]["verdict"] for i in range(30, 60)} == {"allow"}
    assert got[60]["mean"] > 0.6 > 0.4 > got[61]["mean"]


def test_few_outcomes_do_not_block(spark):
    urls = ["http://a.org/", *[f"http://h{i}.org/" for i in range(60)]]
    got = judged(spark, urls, [(0, 0, None), *[(i, 1, 0) for i in range(1, 61)]])
    assert got[0]["verdict"] == "allow"
    assert got[0]["mean"] > got[1]["mean"]


def test_odd_labels_and_empty_tables(spark):
    got = judged(spark, ["http://a.org/", "http://a.org/"], [(0, None, None), (None, 0, 1), (0, 1, 1), (0, 1, 1)])
    assert len(got) == 2
    assert judged(spark, []) == {}


def test_a_hot_host(spark):
    urls = ["http://hot.org/"] * 500 + [f"http://h{i}.net/" for i in range(500)]
    got = judged(spark, urls, [(i, 0, 0) for i in range(200)])
    assert {got[i]["verdict"] for i in range(500)} == {"block"}
    assert len(got) == 1000


RULES = ["com", "Co.KR", None, "kr", "s3.amazonaws.com", "*.ck", "!www.ck", "*.sch.uk", "uk", ""]


@pytest.mark.parametrize(
    ("host", "domain", "suffix", "by_table"),
    [
        ("a.b.co.uk", "b.co.uk", "co.uk", ("co.uk", "uk")),
        ("x.y.org", "y.org", "org", ("y.org", "org")),
        ("org", "org", "org", ("org", "org")),
        ("", "", "", ("", "")),
        ("a.b.co.kr", "b.co.kr", "co.kr", ("b.co.kr", "co.kr")),
        ("a.com.tw", "a.com.tw", "com.tw", ("com.tw", "tw")),
        ("a.b.s3.amazonaws.com", "amazonaws.com", "com", ("b.s3.amazonaws.com", "s3.amazonaws.com")),
        ("x.shop.town.ck", "town.ck", "ck", ("shop.town.ck", "town.ck")),
        ("a.www.ck", "www.ck", "ck", ("www.ck", "ck")),
        ("ck", "ck", "ck", ("ck", "ck")),
        ("a.b.c.sch.uk", "c.sch.uk", "sch.uk", ("b.c.sch.uk", "c.sch.uk")),
    ],
)
def test_domains(spark, host, domain, suffix, by_table):
    from pyspark.sql import functions as F

    rules = U.suffix_rules(spark.createDataFrame([(r,) for r in RULES], "suffix string"))
    r = spark.range(1).select(
        U.domain_of(F.lit(host)).alias("d"), U.suffix_of(F.lit(host)).alias("s"), U.domain_of(F.lit(host), rules).alias("td"), U.suffix_of(F.lit(host), rules).alias("ts")
    )
    assert tuple(r.first()) == (domain, suffix, *by_table)


def test_hosts_under_a_given_suffix_are_not_pooled(spark, monkeypatch):
    bad = [(i, "http://bad.github.io/x") for i in range(60)]
    good = [(100 + i, f"http://h{i}.com/x") for i in range(60)]
    pages = spark.createDataFrame([*bad, *good, (500, "http://clean.github.io/x"), (501, "http://sub.bad.github.io/x")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0, 0) for i, _ in bad] + [(i, 1, 0) for i, _ in good], "doc_id long, quality int, toxic int")
    suffixes = spark.createDataFrame([("com",), ("GitHub.io",), (None,), ("io",)], "suffix string")

    def means(**more):
        return {r["page_id"]: r["mean"] for r in U.judge(pages, labels, **more).where("page_id >= 500").collect()}

    pooled, apart = means(), means(suffixes=suffixes)
    assert pooled[500] == pooled[501]  # without the table github.io is one domain
    assert apart[500] < apart[501]
    monkeypatch.setattr(U, "MOST_SUFFIXES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        U.suffix_rules(suffixes)


def test_rows_without_an_id_and_clashing_columns(spark):
    pages = spark.createDataFrame(
        [(None, f"http://h{i % 3}.org/", "x", 1, 2, "y") for i in range(60)] + [(1, "http://h0.org/", "x", 1, 2, "y")],
        "page_id long, url string, host string, n long, bad long, _found string",
    )
    labels = spark.createDataFrame([(1, 0, 0, "z"), (None, 0, 0, "z")], "doc_id long, quality int, toxic int, host string")
    out = U.judge(pages, labels).collect()
    assert len(out) == 61 and {r["host"] for r in out} == {"h0.org", "h1.org", "h2.org"}
    assert len({r["mean"] for r in out if r["host"] == "h1.org"}) == 1
    assert max(r["mean"] for r in out if r["host"] == "h0.org") > max(r["mean"] for r in out if r["host"] == "h1.org")
