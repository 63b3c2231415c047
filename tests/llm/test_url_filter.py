import pytest

from ledgerline.llm import url_filter as UF


@pytest.mark.parametrize("url, want", [
    (None, ("", "")), ("", ("", "")), ("no scheme/x", ("", "")), ("http://A.Org", ("a.org", "")),
    ("http://a.org?x=/y", ("a.org", "")), ("http://a.org#f/g", ("a.org", "")),
    ("http://a.org:80/P/q.html?x#y", ("a.org:80", "/P/q.html")), ("x://h/a#b?c", ("h", "/a")),
    ("http:///p", ("", "/p")), ("a://b://c/d", ("b:", "//c/d"))])
def test_split(url, want):
    assert UF.split_url(url) == want


@pytest.mark.parametrize("host, path, want", [
    ("a.net", "/x", ("net/", "block")), ("a.net", "", (None, None)), ("net", "/", ("net/", "block")),
    ("example.net", "/en/1", ("example.net/en/", "allow")), ("x.example.net", "/en/", ("example.net/en/", "allow")),
    ("notexample.net", "/en/", ("net/", "block")), ("example.net", "/en", ("net/", "block")),
    ("b.example.com", "/de/9", ("example.com/de/", "block")), ("q.org", "/fr/", ("org/fr/", "allow")),
    ("q.org", "/en/", (None, None)), ("", "", (None, None))])
def test_rules(host, path, want):
    assert UF.RuleList(UF.RULES).decide(host, path) == want


def test_model_generalises_and_table_cases(spark):
    model = UF.fit(UF.labelled_urls(spark))
    assert model.score("new-casino.example.org", "/en/9") > 0.5
    assert model.score("cheap-pills.example.com", "/en/1") > 0.5
    assert model.score("www.thathand.example.com", "/en/9") < 0.5
    pages = spark.createDataFrame([(1, None, "a"), (2, "http://casino-win.example.org/en/3", "b"),
                                   (2, "http://casino-win.example.org/en/3", "b"), (None, "http://x.net/", "c")],
                                  "page_id long, url string, host string")
    rows = UF.filter_urls(pages, model).collect()
    assert [r.url_verdict.verdict for r in rows[1:]] == ["block", "block", "block"]
    assert rows[0].url_verdict.host == "" and rows[0].url_verdict.rule is None
    assert UF.filter_urls(pages.limit(0), model).count() == 0


def test_one_class_or_no_labels(spark):
    one = spark.createDataFrame([(0, "http://a/b")], "label int, url string")
    assert UF.fit(one).score("x", "/y") == pytest.approx(1 / 3)
    assert UF.fit(one.limit(0)).score("x", "/y") == pytest.approx(0.5)
