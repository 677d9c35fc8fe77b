import random
import re

from modrisk.llm import url_filter as u


def slow(url, hosts, patterns):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for r in hosts:
        h, _, p = r.rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.rule) > len(best.rule)):
            best = r
    if best:
        return host, path, best.rule, best.verdict
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    return host, path, None, "block" if any(re.search(p.pattern.replace("$", r"\Z"), low, re.ASCII) for p in patterns) else "allow"


def urls():
    draw = random.Random(3)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.net", "net", "m.x.org", "b.example.org", "xexample.com", "é.NET", ""]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/2?x=/en/", "/login", "/a/wp-admin/b", "/de/12.html", "/it/33/", "/cart/checkout", "#/fr/"]
    tails = ["", "?utm_source=feed", "?page=2&ref=x", "?print=1#top", "#frag", "?UTM_SOURCE=FEED"]
    out = [f"{draw.choice(['http', 'https', 'HTTP'])}://{h}{p}{t}" for h in hosts for p in paths for t in tails]
    out += ["http://a.org/x?page=٣&ref=1", "http://b.example.org/de/1.html\n", "http://a.org/login\n", "http://m.a.org/b/٣"]
    return out + [None, "", "no scheme/en/", "a://b://c/en/", "://net/es/", "x" * 100_000 + "://net/fr/a"] + out[:5]


def test_like_brute_force(spark):
    rows = [(i, x, "clash") for i, x in enumerate(urls())]
    got = u.judged(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == sorted(
        ((i, *slow(x, u.HOST_RULES, u.PATTERN_RULES)) for i, x, _ in rows), key=lambda r: r[0]
    )
    assert {r["verdict"] for r in got} == {"allow", "block"}


def test_filed_under_the_rarest_token(spark):
    frame = spark.createDataFrame([(f"http://a.org/feed/{i}",) for i in range(5)] + [("http://a.org/utm",)], "url string")
    counts = u.token_counts(frame, u.PATTERN_RULES)
    assert (counts["feed"], counts["utm"], counts["cart"]) == (5, 1, 0)
    index, always = u.filed(u.PATTERN_RULES, counts)
    assert [i for i, r in enumerate(u.PATTERN_RULES) if not r.tokens] == always
    assert 0 in index["source"] and 0 not in index.get("feed", [])


def test_empty_table_and_no_rules(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert u.judged(empty).count() == 0
    one = spark.createDataFrame([(None, "http://a.net/es/"), (1, None)], "page_id long, url string")
    assert {r["verdict"] for r in u.judged(one, host_rules=[], pattern_rules=[]).collect()} == {"allow"}


def test_urls_that_go_on_after_a_pattern(spark):
    """Whatever token is the rarest, a rule is found where its match ends inside or beside more of the URL."""
    hits = [
        "?utm_source=feed", "?page=12&ref=", "/login/", "/wp-admin/", "?print=1", "m.a.org/b/1", "/cart/checkout", ".example.org/de/1.html",
    ]
    bases = [h if h[0] not in "?/" else f"a.org{h}" if h[0] == "/" else f"a.org/{h}" for h in hits]
    bases = [f"b{x}" if x[0] == "." else x for x in bases]
    urls = [f"http://{x}{tail}" for x in bases for tail in ("", "s", "2", "/", "&x=1", "#x", "?x", "-a", "x/y")]
    for common in sorted({t for r in u.PATTERN_RULES for t in r.tokens}):
        rows = [(i, x) for i, x in enumerate([*urls, *[f"http://a.org/{common}"] * 200])]
        index, always = u.filed(u.PATTERN_RULES, u.token_counts(spark.createDataFrame(rows, "page_id long, url string"), u.PATTERN_RULES))
        for x in urls:
            fetched = {*always, *(i for t in set(u.TOKEN.findall(x)) for i in index.get(t, ()))}
            assert fetched >= {i for i, r in enumerate(u.PATTERN_RULES) if re.search(r.pattern, x)}, (common, x)
    rows = [(0, "http://a.org/cart/checkouts"), (1, "http://a.org/cart/checkout2")] + [(i, "http://a.org/cart/") for i in range(2, 9)]
    got = {r["page_id"]: r["verdict"] for r in u.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got == {0: "block", 1: "block"} | dict.fromkeys(range(2, 9), "allow")
