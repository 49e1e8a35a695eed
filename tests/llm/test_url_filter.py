"""URL filters against plain string tests, over both ways of joining rules."""
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from barlake.llm import common, url_filter as uf

URLS = ["http://a.net/x", "https://A.NET", "http://example.net/en/25#top", "http://m.Example.net/en", "http://example.net/EN/",
        "https://x.example.com/de/1?u=/fr/", "http://notexample.com/de/1", "http://org/fr/", "http://org/fr", "ftp://a.b.org/fr/x/y",
        "no scheme", "", None, "http://", "http:///de/", "http://net?x=http://a.net/", "a://b://example.com/de/", "http://net./x",
        "http://user@net:80/", "http://x.test/", "http://ads.doubleclick.net/en/", "http://localhost/a", "http://" + "a." * 3000 + "net/" + "p/" * 3000,
        "http://example.net/en/25#top", "http://a.net/\nx", "http://a\n.net/x", "http://é.net/ü?"]


def slow(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, default=None)


def expected(rows, rules, own):
    out = []
    for i, url in rows:
        host, path, base = slow(url, rules)
        more = slow(url, own)[2]
        out.append((i, host, path, base and base[3], (base or more or (0, 0, "allow"))[2], more and more[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit,hot", [(uf.BROADCAST_RULES, 1000), (0, 1000), (0, 3)])
def test_equals_string_tests(spark, monkeypatch, limit, hot):
    monkeypatch.setattr(uf, "BROADCAST_RULES", limit)
    monkeypatch.setattr(common, "HOT_KEYS", hot)
    rows = [(i if i != 5 else None, u) for i, u in enumerate(URLS)] + [(100 + i, "http://a.net/x") for i in range(40)]
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "page_id bigint, url string, rule string, site string, copies int")
    got = uf.judge(pages, uf.rules_frame(spark, uf.BASE_RULES, False), uf.rules_frame(spark, uf.OWN_RULES, True))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, uf.BASE_RULES, uf.OWN_RULES)


def test_rules_of_any_shape(spark):
    rng = random.Random(5)
    hosts = [".".join(rng.choice(["a", "b", "cc"]) for _ in range(rng.randint(1, 4))) for _ in range(40)]
    paths = ["".join(rng.choice(["/", "a", "b/", "ab", "é"]) for _ in range(rng.randint(0, 5))) for _ in range(40)]
    rules = [(rng.choice(["allow", "block"]), h, "/" + p if p and p[0] != "/" else p) for h, p in zip(hosts, paths)]
    rules += [("block", *rules[0][1:]), ("allow", *rules[0][1:])]
    rows = [(i, f"http://{rng.choice(hosts)}/{rng.choice(paths)}{rng.choice(paths)}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = uf.judge(pages, uf.rules_frame(spark, rules, False)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, rules, [])


def test_without_pages_or_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    rules = uf.rules_frame(spark, [(None, "net", "/"), ("block", None, "/"), ("block", "net", None), ("block", "", "/")], False)
    assert [tuple(r) for r in uf.judge(pages, rules).collect()] == [(1, "a.net", "/", None, "allow", None)]
    assert uf.judge(pages.limit(0), uf.rules_frame(spark, uf.BASE_RULES, False)).count() == 0


def test_sql_equals_string_tests(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    res = con.execute(uf.SQL)
    assert [d[0] for d in res.description] == ["page_id", "host", "path", "rule", "verdict", "own_rule"]
    assert sorted(res.fetchall(), key=str) == expected(list(enumerate(URLS)), uf.BASE_RULES, uf.OWN_RULES)


def test_hot_keys_are_dealt_out(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 2900, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    got = common.looked_up(left, right, "k", "n")
    assert got.count() == 3000 and got.columns == ["k", "id", "m"]
    assert got.where("k = 'hot' AND m = 2899").count() == 2900 and got.where("k != 'hot' AND m = id").count() == 100
