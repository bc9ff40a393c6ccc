import re

from panelspark.llm.urls import RULES, Rule, judge
from tests.oracle import connect

from panelspark.llm.registered import SQL


def test_tokens_are_whole_words():
    assert Rule("example.org/en/1", "block").tokens == ["example", "org", "en"]
    assert Rule("||cheap-pills^", "block").tokens == ["cheap-pills"]
    assert Rule("*^xxx*^", "block").tokens == []
    assert Rule("org/", "allow").tokens == ["org"]


def brute(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    raw = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(raw) :]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), raw)
    fit = []
    for r in RULES:
        if not r.is_pattern:
            h, _, p = r.text.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fit.append((len(r.text), r.text, r.action))
    if fit:
        _, text, action = max(fit)
        return host, path, text, action
    sep = r"([^\w-]|$)"
    spam = rf"^([^/]*\.)?(ads-track|adult-x|casino-win|cheap-pills|free-bets|spam-farm){sep}"
    return host, path, None, "block" if re.search(spam, host + path, re.S) else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://org/", "http://a.org", "http://A.ORG/x", "http://borg/x", "x://example.org/en/12",
    "http://sub.Example.org/en/2", "http://example.org/es/", "http://example.org/es", "http://notexample.org/es/1",
    "http://a.com/fr/1?x=/de/", "http://com/de/#a", "http://a.com/DE/1", "http://cheap-pills.net/a", "http://m.cheap-pills.net",
    "http://cheap-pillsx.net/", "http://a.net/free-bets", "http://spam-farm.ads-track/free-bets2", "http://adult-x.net/xxxyz", "ftp://a.net?u=http://b.org/",
    "http://casino-win", "http://a:80/p\nq", "http://x.org:80/a", "http://ünï.org/é/", "http://a.net/" + "p/" * 20000,
]


def test_rules_against_brute_force(spark):
    rows = [(i, u, "h", "p") for i, u in enumerate(URLS)] + [(0, None, "h", "p"), (None, "http://a.org/", None, None)]
    found = judge(spark.createDataFrame(rows, "page_id long, url string, host string, rule string"), RULES).collect()
    key = lambda t: tuple(str(x) for x in t)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in found), key=key) == sorted(
        ((i, *brute(u)) for i, u, *_ in rows), key=key
    )


def test_sql_on_the_same_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)]
    con = connect("/nowhere")
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    names = "page_id, host, path, rule, pattern, verdict"
    expected = con.execute(f"SELECT {names} FROM ({SQL['op2_url_filters']}) ORDER BY page_id").fetchall()
    found = judge(spark.createDataFrame(rows, "page_id long, url string"), RULES).select(*names.split(", "))
    assert [tuple(r) for r in found.orderBy("page_id").collect()] == expected


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert judge(pages, [], default="block").first().verdict == "block"
    assert judge(pages.limit(0), RULES).count() == 0
