from shiftledger.llm.url_filter import filter_urls


def judged(spark, urls, outcomes=(), **settings):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(list(outcomes), "page_id long, bad boolean")
    return {r.page_id: r for r in filter_urls(pages, labels, **settings).collect()}


def test_parts_and_rules(spark):
    found = judged(spark, [
        "https://WWW.Example.com/en/x?y#z", "http://a.example.com/en/1", "http://b.example.net/es/", "http://b.example.net/EN/",
        "http://notexample.com", "http://example.com?q=/en/", "x", None, "//a/b", "http://u@H.org:8/p#/q",
    ])
    assert [(found[i].host, found[i].path, found[i].rule, found[i].verdict) for i in range(10)] == [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"), ("a.example.com", "/en/1", "example.com/en/", "block"),
        ("b.example.net", "/es/", "net/es/", "block"), ("b.example.net", "/EN/", None, "allow"),
        ("notexample.com", "", None, "allow"), ("example.com", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("u@h.org:8", "/p", None, "allow"),
    ]


def test_bad_hosts_go_and_small_ones_shrink(spark):
    urls, outcomes = [], []
    for host, n, bad in [("good.a.org", 200, 4), ("bad.b.org", 200, 190), ("few.a.org", 1, 1), ("new.b.org", 1, None)]:
        for i in range(n):
            if bad is not None:
                outcomes.append((len(urls), i < bad))
            urls.append(f"http://{host}/{i}")
    rows = judged(spark, urls, outcomes, rules=())
    by_host = {r.host: r for r in rows.values()}
    assert by_host["good.a.org"].verdict == "allow" and by_host["bad.b.org"].verdict == "block"
    assert by_host["good.a.org"].bad_rate < by_host["few.a.org"].bad_rate < 0.9
    assert by_host["good.a.org"].bad_rate < by_host["new.b.org"].bad_rate < by_host["bad.b.org"].bad_rate


def test_odd_and_empty(spark):
    assert judged(spark, []) == {}
    rows = judged(spark, ["http://a.b/"] * 3, [(0, None), (0, True), (0, True), (None, True)])
    assert len(rows) == 3
