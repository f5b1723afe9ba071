import re

from millrace.llm import urls as u
from tests.conftest import rows
from tests.llm.helpers import table

ODD_URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Example.NET/en/x?y=1#z", "https://example.net", "https://example.net/en", "https://example.net/en/",
    "https://badexample.net/en/", "ftp://x.org/fr/1", "https://x.org/FR/1", "https://example.com/de/1", "https://a.b.example.com/de/?q", "http://x.com?a=/b",
    "http://ÄX.Net/", "a://b://c.net/d", "http://" + "p" * 50_000 + ".net/x", "http://net", "http://net/",
]


def expected(url):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = re.sub("[A-Z]+", lambda m: m[0].lower(), host)
    fits = []
    for verdict, rule in u.RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def frame(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)


def checked(got, pages):
    got = {r.page_id: r for r in got.collect()}
    assert len(got) == len(pages)
    for i, url in pages:
        host, path, rule, verdict = expected(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        assert got[i].verdict == (verdict or ("block" if got[i].score > 0.5 else "allow")) and 0 <= got[i].score <= 1


def test_given_pages_and_odd_urls_as_by_brute_force(spark):
    pages = table(spark, "pages").select("page_id", "url")
    checked(u.judge(pages), [tuple(r) for r in pages.collect()])
    odd = frame(spark, ODD_URLS).selectExpr("*", "'x' AS host", "'x' AS score", "'x' AS features", "'x' AS suffix_1")
    checked(u.judge(odd), list(enumerate(ODD_URLS)))


def test_trees_learn_labelled_urls(spark):
    seen = [(f"http://{'spam' if i % 2 else 'good'}{i % 7}.example.biz/{'a/' * (i % 5)}{'9' * 12 if i % 2 else 'page'}", i % 2) for i in range(200)]
    labelled = spark.createDataFrame(seen, "url string, blocked int")
    new = frame(spark, [f"http://{'spam' if i % 2 else 'good'}{i % 7}.example.biz/n/{'9' * 12 if i % 2 else 'other'}" for i in range(40)])
    got = rows(u.judge(new, rules=[], labelled=labelled), "page_id", "verdict")
    assert got == [(i, "block" if i % 2 else "allow") for i in sorted(range(40), key=lambda i: repr((i, "block" if i % 2 else "allow")))]


def test_labels_of_one_kind_none_and_empty_tables(spark):
    pages = frame(spark, ["http://a.biz/x", "http://b.biz/y"])
    nothing = spark.createDataFrame([], "url string, blocked int")
    assert rows(u.judge(pages, labelled=nothing), "verdict", "score") == [("allow", 0.0)] * 2
    all_bad = spark.createDataFrame([("http://c.biz", 1), ("http://d.biz", 1), (None, 1), ("http://e.biz", None)], "url string, blocked int")
    assert rows(u.judge(pages, labelled=all_bad), "verdict", "score") == [("block", 1.0)] * 2
    assert u.judge(pages.limit(0)).count() == 0


def test_repeated_pages_and_null_keys_each_have_their_row(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://a.net/"), (None, None)], "page_id long, url string")
    got = rows(u.judge(pages), "page_id", "rule")
    assert got == sorted([(1, "net/"), (1, "net/"), (None, "net/"), (None, None)], key=repr)
