import pytest

from quarry.llm import urls

URLS = [
    "https://example.org/es/1", "http://EXAMPLE.org/en/17?x", "https://a.b.example.org/en/2#t", "https://notexample.org/es/", "https://org/", "https://org",
    "https://x.com/fr/?q", "https://com/de/", "https://x.com/de", "ftp://h//a://b.org/", "no scheme", "", None, "https://", "https:///es/", "https://x.com/frx", "https://ü.org/es/",
]
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: (len(f[0]), f[0], f[1]), default=(None, "allow"))
    return host, path, rule, verdict


@pytest.mark.parametrize("rules", [RULES, RULES[:0], [*RULES, ("org", "/", "block"), ("b.org", "", "block")]])
def test_verdicts_match_brute_force(spark, rules):
    df = spark.createDataFrame([(i, u, "c", "c", "c") for i, u in enumerate([*URLS, *URLS[:3]])], "page_id int, url string, rule string, key string, host string").repartition(3)
    listed = spark.createDataFrame(rules, "host string, path string, action string")
    rows = urls.judge(df, listed).collect()
    assert len(rows) == df.count()
    given = {r.page_id: r.url for r in df.collect()}
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(given[r.page_id], rules), given[r.page_id]
    assert urls.judge(df.limit(0), listed).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS key")
    blocks, table = urls.bloom_filter(keys)
    assert blocks == 188 and table.shape == (188, 4)
    block, _ = urls._place(__import__("pyspark.sql.functions", fromlist=["col"]).col("key"), blocks)
    from pyspark.sql import functions as F

    shipped = spark.sparkContext.broadcast(table)
    hits = lambda df: df.where(urls._possible(shipped)(block, F.xxhash64("key", F.lit(1)))).count()
    assert hits(keys) == 3000
    assert hits(spark.range(3000).selectExpr("concat('other', id) AS key")) < 300
