import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import simhash
from quarry.llm.components import components
from quarry.llm.queries import op1_simhash
from tests.conftest import SF_SMALL
from tests.llm import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, k=3):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode("utf-8"), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(fps, max_bits):
    """Class root (smallest place) of every fingerprint."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def flipped(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_connect_what_brute_force_connects(spark, max_bits):
    rng = random.Random(max_bits)
    heads = [rng.getrandbits(64) for _ in range(25)]
    fps = sorted({flipped(rng, rng.choice(heads), rng.randint(0, 6)) for _ in range(400)} | {0, (1 << 64) - 1, 1, 3})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    found = components(simhash.links(df, max_bits)).collect()
    label = {r.node: r.component for r in found}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    want = brute_classes(fps, max_bits)
    mine = [label.get(x, x) for x in signed]
    assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_hot_keys_are_refined_without_losing_links(spark, monkeypatch):
    rng = random.Random(9)
    head = rng.getrandbits(64)
    fps = sorted({flipped(rng, head, rng.randint(0, 4)) for _ in range(300)})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    plain = components(simhash.links(df, 2)).groupBy("component").count().orderBy("count").collect()
    monkeypatch.setattr(simhash, "GROUP", 3)
    refined = components(simhash.links(df, 2)).groupBy("component").count().orderBy("count").collect()
    assert [tuple(r) for r in plain] == [tuple(r) for r in refined]


def test_awkward_documents(spark):
    df = awkward.documents(spark)
    rows = simhash.near_duplicates(df).collect()
    given = [(r.doc_id, brute_fingerprint(r.text)) for r in df.collect()]
    assert sorted(((r.doc_id, r.simhash % 2**64) for r in rows), key=repr) == sorted(given, key=repr)
    classes = brute_classes([f for _, f in given], 2)
    least = {}
    for (i, _), c in zip(given, classes, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = sorted(((i, f, least.get(c)) for (i, f), c in zip(given, classes, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.simhash % 2**64, r.component_id) for r in rows), key=repr) == want
    kept = simhash.keep_one(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({v for v in least.values()})
    assert kept.columns == df.columns
    assert simhash.near_duplicates(awkward.empty(spark)).count() == 0
    assert simhash.keep_one(awkward.empty(spark)).count() == 0


def test_rows_without_ids_keep_one_of_each_fingerprint(spark):
    rows = [(None, "one two three four", "c"), (None, "one two three four", "c"), (None, "far other words here", "c"), (7, "something else entirely said", "c")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, fp string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted({*rows}, key=repr)


def test_rows_of_one_id_and_different_texts_each_stay_for_their_component(spark):
    first, second, third = ("one two three four five six", "far other words stand in here", "something else entirely is said now")
    rows = [(1, first), (1, second), (2, second), (3, first), (4, third), (3, third), (1, first), (None, third)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, kept.collect())) == [(1, second), (1, first), (3, third)]


def test_components_of_a_long_path_and_a_star(spark):
    path = spark.range(1, 60).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    star = spark.range(101, 160).select(F.col("id").alias("src"), F.lit(100).cast("long").alias("dst"))
    got = {r.node: r.component for r in components(path.union(star).union(star)).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(100, 160), 100)}


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op1_simhash(spark, SF_SMALL).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{brute_fingerprint(t):016x}" for i, t in docs.items()}
    ids = sorted(docs)
    classes = brute_classes([brute_fingerprint(docs[i]) for i in ids], 2)
    assert {r.doc_id: r.component_id for r in rows} == {i: ids[c] for i, c in zip(ids, classes, strict=True)}
