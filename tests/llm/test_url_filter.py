"""The url filter against a plain version: rules, splits, naive Bayes."""

import math
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from lakeshelf.llm import queries, stored, url_filter
from lakeshelf.llm.url_filter import Rule, likeliest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    stored.ship_package(spark)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def names(host, path):
    return re.findall(r"[^\x00-\x60\x7b-\x7f]{1,256}", re.sub("[A-Z]", lambda m: m[0].lower(), f"{host}/{path}"))


def rule_for(host, path, rules):
    fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fitting, key=lambda r: (-len(r.text), r.text), default=None)


def plain(urls, texts, rules, bad_words):
    counts = Counter(bad_words)
    for text in texts:
        counts.update(w for w in re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if len(w.encode()) <= 24)
    total = sum(counts.values()) or 1

    def split(name):
        ways = {0: (0.0, [])}
        for end in range(1, len(name) + 1):
            options = []
            for start in range(max(0, end - 24), end):
                word = name[start:end]
                p = math.log(counts[word] / total) if counts[word] else math.log(10 / total) - len(word) * math.log(10)
                options.append((ways[start][0] + p, -start, [*ways[start][1], word]))
            best = max(options)
            ways[end] = (best[0], best[2])
        return ways[len(name)][1]

    words = [[w for name in names(*parts(u)) for w in split(name)] for u in urls]
    bad = [bool(set(w) & set(bad_words)) for w in words]
    sides = {side: Counter(w for ws, b in zip(words, bad) if b is side for w in ws) for side in (True, False)}
    known = set(sides[True]) | set(sides[False])
    size = {side: sum(c.values()) + len(known) + 1 for side, c in sides.items()}
    out = []
    for url, ws in zip(urls, words):
        host, path = parts(url)
        score = 0
        if any(bad) and not all(bad):
            score = math.log(sum(bad) / (len(bad) - sum(bad)))
            score += sum(math.log((sides[True][w] + 1) / size[True]) - math.log((sides[False][w] + 1) / size[False]) for w in ws)
        rule = rule_for(host, path, rules)
        out.append((host, path, rule and rule.text, rule.verdict if rule else "block" if score > 0 else "allow", score))
    return out


def same(rows, want):
    got = sorted((r.host, r.path, r.rule or "", r.verdict) for r in rows)
    assert got == sorted((h, p, r or "", v) for h, p, r, v, _ in want)
    by_place = {(h, p): s for h, p, _, _, s in want}
    assert all(r.score is None or abs(r.score / 1e6 - by_place[r.host, r.path]) < 1e-3 for r in rows)


def test_query_is_as_the_plain_version(spark):
    pages, docs = (pq.read_table(f"{SF_DIR}/{t}.parquet").to_pylist() for t in ("pages", "documents"))
    rows = queries.QUERIES["op11_url_filter"](spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(p["page_id"] for p in pages)
    same(rows, plain([p["url"] for p in pages], [d["text"] for d in docs], queries.URL_RULES, queries.UNWANTED))


def test_likeliest_split():
    words = {"cheap": 5, "pills": 5, "pill": 5, "s": 1, "the": 50, "then": 3, "north": 3, "orth": 1}
    assert likeliest("cheappills", words, 100) == ["cheap", "pills"]
    assert likeliest("thenorth", words, 100) == ["the", "north"]
    assert "".join(likeliest("xqzcheap", words, 100)) == "xqzcheap" and likeliest("xqzcheap", words, 100)[-1] == "cheap"
    assert likeliest("", words, 100) == []


URLS = [
    None, "", "no scheme/here", "http://", "HTTP://A.Example.NET/en/x?q=/de/", "https://example.net/en", "http://xexample.net/en/a",
    "http://sub.example.com/de/y#z", "http://example.com/DE/y", "ftp://b.org/fr/://c.net/", "x://net/", "x://net", "a://b.c.org?fr/",
    "http://cheappills.biz/buy", "http://cheap-pills.biz/buy", "http://farm.org/cheap", "http://plain.biz/text", "http://plain.biz/text",
    "http://" + "a" * 700 + ".biz/" + "漢" * 300, "http://1.2.3.4:80/5", "://.net/", "http://a..net/x\ny",
]


def test_edges(spark):
    texts = ["plain text of a farm", None, "", "Cheap pills, cheap!", "text " * 50_000]
    urls = spark.createDataFrame([(i, u, "h", 1.5) for i, u in enumerate(URLS)], "page_id bigint, url string, host string, score double")
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = url_filter.judge(urls, docs, queries.URL_RULES, ["cheap", "pills"]).collect()
    assert sorted((r["row"].page_id, r["row"].host) for r in rows) == [(i, "h") for i in range(len(URLS))]
    want = plain(URLS, texts, queries.URL_RULES, ["cheap", "pills"])
    same(rows, want)
    assert {r.host for r in rows if r.verdict == "block" and r.rule is None} == {"cheappills.biz", "cheap-pills.biz", "farm.org"}
    assert url_filter.judge(urls.limit(0), docs, queries.URL_RULES, ["cheap"]).count() == 0
    rows = url_filter.judge(urls, docs.limit(0), [], []).collect()
    assert len(rows) == len(URLS) and {(r.rule, r.verdict, r.score) for r in rows} == {(None, "allow", None)}


def test_labelled_urls(spark):
    urls = [("http://good.site/news", False), ("http://good.site/sport", False), ("http://badsite.biz/win", True), ("http://bad.biz/x", None), ("http://good.biz/x", None)]
    df = spark.createDataFrame(urls, "url string, spam boolean")
    docs = spark.createDataFrame([("good bad site news sport win biz",)], "text string")
    rows = {r["row"].url: r.verdict for r in url_filter.judge(df, docs, [Rule("biz", "/x/", "allow")], labels="spam").collect()}
    assert [rows[u] for u, _ in urls] == ["allow", "allow", "block", "block", "allow"]
