from daybook.llm.url_filter import filter_urls

URLS = [
    (1, "https://WWW.Example.com/en/a?x=1", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    (2, "http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    (3, "http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    (4, "http://a.net/es/1#t", "a.net", "/es/1", "net/es/", "block"),
    (5, "http://a.net/ES/1", "a.net", "/ES/1", None, "allow"),
    (6, "http://example.com", "example.com", "", None, "allow"),  # an empty path does not begin with /
    (7, "http://free.org/cheap", "free.org", "/cheap", None, "block"),  # two different soft terms
    (8, "http://free.org/free", "free.org", "/free", None, "allow"),  # one soft term, twice
    (9, "http://freedom.org/Casino-royale", "freedom.org", "/Casino-royale", None, "block"),
    (10, "http://x.org/casinos", "x.org", "/casinos", None, "allow"),  # no boundary
    (11, None, "", "", None, "allow"),
    (12, "www.example.com/en/ adult", "", "", None, "block"),  # no ://
    (13, "", "", "", None, "allow"),
    (14, "http://a.org?q=http://b.net/es/", "a.org", "", None, "allow"),
    (None, "http://a.net:80/es/", "a.net:80", "/es/", None, "allow"),
    (15, "http://b.org/" + "a/" * 50_000 + "porn", "b.org", "/" + "a/" * 50_000 + "porn", None, "block"),
]


def test_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "<p>", "x", "x") for i, u, *_ in URLS], "page_id long, url string, html string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages).collect()}
    assert got == {i: tuple(rest) for i, _, *rest in URLS}


def test_empty_table(spark):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_no_vocabulary(spark):
    pages = spark.createDataFrame([(1, "http://a.org/porn")], "page_id long, url string")
    assert filter_urls(pages, strict=(), soft=()).first().verdict == "allow"
