from plazaflow.llm.url_filter import judge_urls, with_levels


def test_levels(spark):
    want = {"a.b.co.uk": ("co.uk", "b.co.uk"), "b.com.au": ("com.au", "b.com.au"), "co.uk": ("co.uk", "co.uk"), "x.notco.uk": ("uk", "notco.uk"),
            "a.b.example.com": ("example.com", "b.example.com"), "a.b.de": ("de", "b.de"), "de": ("de", "de"), "": ("", ""),
            "me.github.io": ("github.io", "me.github.io")}
    got = with_levels(spark.createDataFrame([(h,) for h in want], "host string")).collect()
    assert {r.host: (r.suffix, r.domain) for r in got} == want


def test_unlabelled_host_takes_the_rate_of_its_own_domain(spark):
    bad = [(i, f"https://bad{i % 10}.co.uk/{i}") for i in range(300)]
    good = [(1000 + i, f"https://www.good{i % 10}.co.uk/{1000 + i}") for i in range(300)]
    pages = spark.createDataFrame([*bad, *good, (-1, "https://shop.good1.co.uk/x")], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1, int(i < 1000)) for i, _ in bad + good], "doc_id long, quality int, toxic int")
    rows = {r.page_id: r for r in judge_urls(pages, labels).where("page_id in (-1, 0, 1000)").collect()}
    assert (rows[0].verdict, rows[1000].verdict, rows[-1].verdict) == ("block", "allow", "allow")
    assert rows[-1].p < 0.1
