import collections

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import sharding, url_filters
from ledgerloom.llm.queries import URL_RULES


def judge(url, rules, default="allow"):
    import re

    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in rules if (not r.host or host == r.host or host.endswith("." + r.host)) and re.match(".*".join(map(re.escape, r.path.split("*"))), path, re.S)]
    best = min(fit, key=lambda r: (-len(r.name), r.verdict == "allow", r.name), default=None)
    return host, path, best and best.name, best.verdict if best else default


URLS = [None, "", "x", "http://", "http:///es/", "http://EXAMPLE.org/es/1?x=/", "http://notexample.org/es/", "https://a.b.example.org/es", "http://example.org", "http://example.org?x",
        "http://example.org#/es/", "ftp://x://example.org/en/1", "http://example.org/en/12", "http://example.org/en/2/1", "http://Ä.com/de/", "http://com/fr/", "http://com/de/\n", "http://a.com:80/de/",
        "http://example.org/en/1", "http://example.org/en/1", "http://x.net/" + "a/" * 3000, "http://x.net/q.ad/banner", "http://x.net/q[ad]/1"]


@pytest.mark.parametrize("few", [True, False])
def test_urls_like_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(url_filters, "BROADCAST_RULES", 100 if few else 0)
    rules = URL_RULES + [url_filters.parse_rule(r) for r in ("block net/*.ad/", "block /q[ad]/", "allow net/q.ad/banner", "block net/q.ad/banner")]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, URLS[5])], "page_id long, url string").selectExpr("*", "1 AS rule", "2 AS token", "3 AS row", "4 AS host")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filters.judge_urls(df, rules).collect()}
    assert got == {i: judge(u, rules) for i, u in enumerate(URLS)} | {None: judge(URLS[5], rules)}
    assert url_filters.judge_urls(df.limit(0), rules).collect() == []


def test_table_is_even_and_stable():
    names = [f"s{i}" for i in range(10)]
    size = sharding.next_prime(1000)
    table = sharding.lookup_table(names, size)
    counts = collections.Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 10
    less = sharding.lookup_table(names[:-1], size)
    moved = sum(a != b for a, b in zip(table, less) if a != 9)
    assert moved < 0.1 * size
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"], 7)


def test_place_and_write(spark, tmp_path, ):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, "b"), (2, "c")], "doc_id long, text string").selectExpr("*", "7 AS n")
    out = sharding.place(df, F.col("doc_id"), ["x", "y", "z"])
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "n", "slot", "shard"] and len(rows) == 5
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1 == len({r["shard"] for r in rows if r["doc_id"] is None})
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    sharding.write_shards(df, f"{tmp_path}/s", F.col("doc_id"), ["x", "y", "z"])
    assert spark.read.parquet(f"{tmp_path}/s").count() == 5
    assert sharding.place(df.limit(0), F.col("doc_id"), ["x"]).collect() == []
    with pytest.raises(ValueError):
        sharding.place(out, F.col("doc_id"), ["x"])
