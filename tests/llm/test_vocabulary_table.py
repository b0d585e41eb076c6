"""A URL vocabulary from a table, in several languages, and its size bound."""

import pytest

from tallyloom.llm import url_filter


def test_vocabulary_from_a_table(spark):
    terms = spark.createDataFrame([("Wetten", 1.0), ("gratis", 1.0), ("gratis", 0.5), ("apuestas", 2.0), (None, 3.0), ("", 1.0), ("leer", None)], "term string, weight double")
    vocabulary = url_filter.vocabulary_of(terms)
    assert vocabulary == {"apuestas": 2.0, "gratis": 1.0, "wetten": 1.0}
    urls = ["http://gratis-wetten.net/x", "http://a.net/apuestas", "http://a.net/gratis", "http://a.net/wettenx/gratis", None]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id int, url string")
    got = [r.url_verdict for r in url_filter.filter_urls(pages, vocabulary=vocabulary, rules=()).orderBy("page_id").collect()]
    assert got == ["block", "block", "allow", "allow", "allow"]
    with pytest.raises(ValueError, match="more than 2 terms"):
        url_filter.vocabulary_of(terms, most=2)


def test_only_junk_hosts_fall(spark):
    """Of the pages that no rule judges only those of two hosts fall, each by two soft terms."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    out = url_filter.filter_urls(pages.select("page_id", "url")).where("url_rule is null and url_verdict = 'block'").collect()
    hosts = {r.url_host.removeprefix("www.") for r in out}
    assert len(out) == 34 and hosts == {"free-bets.example.com", "cheap-pills.example.com"}
