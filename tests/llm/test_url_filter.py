from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tickforge.llm import url_filter as U
from tickforge.llm.common import read_table

SF = "/root/testdata/sf0.001"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host = rest.split("/", 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[len(host):]


def pattern(glob, stop):
    out = re.sub(r"\\\*\\\*|\\\*|\\\?", lambda m: {r"\*\*": ".*", r"\*": f"[^{re.escape(stop)}]*", r"\?": f"[^{re.escape(stop)}]"}[m[0]], re.escape(glob))
    return out


def brute(url, rules, default="allow"):
    """One regular expression a rule."""
    host, path = parts(url)
    best = None
    for text, verdict in rules:
        h, slash, p = text.partition("/")
        h = "".join(c.lower() if "A" <= c <= "Z" else c for c in h)
        fits = re.fullmatch(rf"(?s)(?:.*\.)?{pattern(h, '.')}", host) and re.match(rf"(?s){pattern(slash + p, '/')}", path)
        if fits and (best is None or len(text) > len(best[0])):
            best = text, verdict
    return host, path, best and best[0], best[1] if best else default


def judged(spark, urls, rules, **how):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    out = df.select("page_id", U.judge(F.col("url"), U.UrlRules(rules, **how), spark).alias("j")).collect()
    return [tuple(r["j"]) for r in sorted(out, key=lambda r: r["page_id"])]


ODD = [None, "", "http", "://", "http://", "http:///x", "https://net", "https://NET/", "https://net/", "https://a.net", "https://a.net?x/", "https://a.net/?q=#",
       "https://anet/x", "https://example.net/en", "https://example.net/en/", "https://a.b.example.net/en/1", "https://badexample.net/en/1",
       "https://example.com/de/x", "https://example.com/DE/x", "https://x.org/fr/", "https://org/fr/a?b://c.net/", "see https://a.net/b://c",
       "https://ü.net/ß", "http://u@x.net:80/", "http://x.net\n/", "http://a.net/" + "y/" * 50_000, "https://" + "a." * 20_000 + "org/fr/"]


def test_fixed_rules_and_odd_urls(spark):
    assert judged(spark, ODD, U.RULES) == [brute(u, U.RULES) for u in ODD]


@pytest.mark.parametrize("seed, state", [(1, 8 << 20), (2, 2_000), (3, 8)])
def test_globs_equal_regular_expressions(spark, monkeypatch, seed, state):
    """More rules than bits of a word, all kinds of wildcards, small slices of state."""
    monkeypatch.setattr(U, "STATE_BYTES", state)
    rnd = random.Random(seed)

    def text(pieces, n):
        return "".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, n)))
    rules = []
    for _ in range(60):
        host = text(["a", "b", ".", "*", "**", "?", "A", "ü"], 5)
        rules.append((host + rnd.choice(["", "/" + text(["a", "/", "*", "**", "?", "é", "."], 6)]), rnd.choice(["allow", "block"])))
    urls = [f"http://{text(['a', 'b', '.', 'ü', 'c'], 7)}{rnd.choice(['', '/'])}{text(['a', '/', 'é', '.', 'x'], 7)}" for _ in range(400)]
    assert judged(spark, urls, rules, default="block") == [brute(u, rules, "block") for u in urls]
    assert U.UrlRules(rules).words > 3


def test_many_rules_pick_the_longest(spark):
    rules = [(f"h{i}.example.net/{'p' * (i % 7)}", "block" if i % 2 else "allow") for i in range(2_000)]
    urls = [f"https://www.h{i}.example.net/ppp{'p' * (i % 3)}/x" for i in range(0, 2_000, 7)]
    assert judged(spark, urls, rules) == [brute(u, [rules[i]]) for i, u in zip(range(0, 2_000, 7), urls)]


def test_no_rules_and_bad_rules(spark):
    assert judged(spark, ["http://a/b", None], []) == [("a", "/b", None, "allow"), ("", "", None, "allow")]
    for bad in ([("/x", "block")], [("", "block")], [("a", "deny")]):
        with pytest.raises(ValueError):
            U.UrlRules(bad)


def test_keep_allowed_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([(1, u, "x", "y", "z", "w") for u in ODD + ODD], "verdict int, url string, host string, row string, rule string, `a.b` string")
    out = U.keep_allowed(df, U.UrlRules(U.RULES))
    assert out.columns == df.columns
    assert sorted(str(r["url"]) for r in out.collect()) == sorted(str(u) for u in ODD + ODD if brute(u, U.RULES)[3] == "allow")
    assert U.keep_allowed(df.limit(0), U.UrlRules(U.RULES)).count() == 0


def test_query(spark):
    pages = read_table(spark, SF, "pages").select("page_id", "url").collect()
    out = U.op13_url_filter(spark, SF)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(tuple(r) for r in out.collect()) == sorted((r["page_id"], *brute(r["url"], U.RULES)) for r in pages)
