import re

import pytest

from tidemark.llm import url_filter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = ["http://a.example.net/en/1", "http://a.example.net/de/1", "https://EXAMPLE.com/de/x?q=/en/", "http://example.com/en/", "http://x.org/fr/y#z",
        "http://xorg/fr/", "http://net", "http://net/", "http://net?x=/", "no scheme/net/", "", None, "://", "http://h://p/q", "HTTP://User@Ex.NET:80/EN/",
        "http://notexample.net.com/en/", "http://a\n.net/b", "http://example.net/en", "http://ÄB.net/"]


def brute(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(url_filter.labelled_table(spark))


def test_rules_match_brute_force(spark, model):
    urls = spark.createDataFrame([(i, u, "z") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    for r in url_filter.judge(urls, model).collect():
        host, path, rule, verdict = brute(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict or verdict is None and r.verdict == ("block" if r.block_score >= 0.5 else "allow")
    assert url_filter.judge(urls.limit(0), model).count() == 0


def test_method_on_pages(spark, model):
    urls = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    rows = [r for r in url_filter.judge(urls, model).collect() if r.rule is None]
    bad = re.compile("casino|bets|pills|spam|ads-|adult")
    right = sum((r.verdict == "block") == bool(bad.search(r.host)) for r in rows)
    assert right / len(rows) > 0.95


def test_path_alone_decides(spark, model):
    bad = ["/casino/free-money", "/online-casinos/77", "/a/cheap-pills.html", "/xxx", "/2020/poker_jackpots/", "/warez/crack.php"]
    good = ["/library/school-news", "/my-university/77", "/a/garden-recipes.html", "/museum", "/2020/travel_maps/", "/weather/region.php"]
    hosts = ["example.edu", "www.plain.test", "h7.example.info"]
    rows = [(h, p, v, f"http://{h}{p}") for h in hosts for ps, v in ((bad, "block"), (good, "allow")) for p in ps]
    got = url_filter.judge(spark.createDataFrame(rows, "h string, p string, wanted string, url string"), model).collect()
    assert len(got) == 36 and all(r.rule is None for r in got)
    assert [(r.url, r.block_score) for r in got if r.verdict != r.wanted] == []
    again = spark.createDataFrame([("http://casino-slots.example.edu/77",), ("http://city-museum.example.edu/77",)], "url string")
    assert sorted(r.verdict for r in url_filter.judge(again, model).collect()) == ["allow", "block"]


def test_held_out_rows_of_the_labelled_table(spark, model):
    rows = {r.label: r for r in url_filter.held_out_share(model, url_filter.labelled_table(spark)).collect()}
    assert rows[1.0].n > 100 and rows[1.0].right >= 0.8 * rows[1.0].n
    assert rows[0.0].n > 500 and rows[0.0].right >= 0.98 * rows[0.0].n


def test_words_of_the_table_are_not_the_pages(spark):
    words = {*url_filter.ALLOW_WORDS, *url_filter.NEUTRAL_WORDS, *url_filter.SYLLABLES}
    assert not words & set("the that th re in er tion an on ou ha st en es of".split())
