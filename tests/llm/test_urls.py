from pyspark.sql import functions as F

from gridcube.llm import urls as U


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, verdict string")


def canonical(u):
    return f'<head><LINK href="{u}" rel="canonical"></head>'


def refresh(u):
    return f'<meta http-equiv=refresh content="0; url={u}">'


def judged(spark, rows, **kw):
    return [(r.rule, r.verdict) for r in U.judge(pages(spark, rows), **kw).orderBy("page_id").collect()]


def test_rules_hosts_and_paths(spark):
    urls = ["http://a.COM/x", "https://WWW.example.com/en/1?q#f", "https://m.example.com/en/1", "http://example.com/en", "http://x.net/es/2", "http://xnet/es/2",
            "http://a.com", None, "no url", "http://a.com?x=/y", "http://notexample.com/en/1", "http://a.net/fr/", "ftp://b.org/e#://x"]
    got = U.judge(pages(spark, [(u, None) for u in urls])).orderBy("page_id").collect()
    assert [r.rule for r in got] == ["com/", "www.example.com/en/", "example.com/en/", "com/", "net/es/", None, None, None, None, None, "com/", "net/fr/", None]
    assert [r.verdict for r in got] == ["allow", "allow", "block", "allow", "block"] + ["allow"] * 6 + ["block", "allow"]
    assert (got[1].host, got[1].path, got[7].host, got[8].path, got[9].path) == ("www.example.com", "/en/1", "", "", "")


def test_block_travels_over_links_and_explicit_allow_wins(spark):
    rows = [("http://one.org/a", canonical("http://two.org/b")), ("http://two.org/b", refresh("/c")), ("http://two.org/c#part", canonical("//x.net/es/9")),
            ("http://three.com/z", refresh("http://one.org/a")), ("http://free.org/a", canonical("http://free.org/b")), ("HTTP://Two.org/b", None),
            ("http://four.org/dir/p", canonical("q")), ("http://four.org/dir/q", canonical("http://y.net/fr/1"))]
    assert judged(spark, rows) == [(None, "block"), (None, "block"), (None, "block"), ("com/", "allow"), (None, "allow"), (None, "block"),
                                   (None, "block"), (None, "block")]


def test_long_redirect_chain_from_a_log(spark):
    rows = [(f"http://h.org/{i}", None) for i in range(40)] + [("http://bad.net/es/0", None)]
    log = spark.createDataFrame([(f"http://h.org/{i}", f"http://h.org/{i + 1}") for i in range(29)] + [("http://h.org/29", "http://bad.net/es/0"), (None, "x"), ("http://h.org/35", None)],
                                "from_url string, to_url string")
    got = judged(spark, rows, redirects=log, html_col=None)
    assert [v for _, v in got] == ["block"] * 30 + ["allow"] * 10 + ["block"]


def test_no_rows_and_repeats(spark):
    df = pages(spark, [("http://one.org/a", canonical("http://x.net/es/")), ("http://one.org/a", None)])
    assert [r.verdict for r in U.judge(df).collect()] == ["block", "block"]
    assert U.judge(df.limit(0)).count() == 0


def test_rules_as_a_table_equal_rules_in_the_plan(spark):
    import random
    rnd = random.Random(4)
    hosts, paths = ["com", "a.com", "b.a.com", "net", "x.net", "a", ""], ["", "/", "/e", "/en/", "/en/x", "//"]
    rules = [(a, h, p) for (h, p), a in {(rnd.choice(hosts[:-1]), rnd.choice(paths)): rnd.choice(["allow", "block"]) for _ in range(14)}.items()]
    rows = [(f"http://{rnd.choice(hosts)}{rnd.choice(['', '.com', '.net'])}{rnd.choice(paths)}{rnd.choice(['', '?q', 'y'])}", None) for _ in range(120)]
    rows += [("http://one.org/a", canonical("http://b.a.com/en/x")), (None, None), ("plain", None)]
    table = spark.createDataFrame([*rules, ("block", None, "/"), ("allow", "com", None)], "action string, host string, path string")
    keep = lambda df: [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in df.orderBy("page_id").collect()]
    assert keep(U.judge(pages(spark, rows), table)) == keep(U.judge(pages(spark, rows), rules))
    assert {v for *_, v in keep(U.judge(pages(spark, rows), table.limit(0)))} == {"allow"}
    twice = spark.createDataFrame([("allow", "a.com", "/"), ("block", "a.com", "/")], table.schema)
    assert keep(U.judge(pages(spark, [("http://a.com/x", None)]), twice))[0][4] == "block"


def test_base_entities_and_long_html(spark):
    bad = "http://x.net/es/9?a=1&b=2"
    filler = "<p>" + "text " * 200_000 + "</p>"
    rows = [("http://one.org/a", '<base href="http://x.net/es/">' + canonical("page")), ("http://two.org/a", canonical(bad.replace("&", "&amp;"))),
            ("http://three.org/a", filler + refresh("http://y.net/fr/1") + filler), ("http://four.org/a", '<base href="/es/">' + canonical("q"))]
    assert [v for _, v in judged(spark, rows)] == ["block", "block", "block", "allow"]
    assert spark.createDataFrame([(rows[1][1], "http://u.org/")], "h string, u string").select(U.link_targets(F.col("h"), F.col("u"))).first()[0] == [bad]
