import random

from quarry.llm import contamination
from quarry.llm.queries import op8_decontamination
from tests.conftest import SF_SMALL
from tests.llm import awkward


def distance(pattern, text):
    """Least edit distance of a pattern to any substring, and its first end."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row), row.index(min(row))


def brute(docs, items, rate):
    out = []
    for doc, text in docs:
        text = contamination.normal(text)
        for item, pattern in items:
            pattern = contamination.normal(pattern)
            if item is not None and pattern and len(pattern) < contamination.LEAST_CHARS:
                if f" {pattern} " in f" {text} ":
                    out.append((doc, item, 0))
            elif item is not None and pattern and text:
                d, _ = distance(pattern, text)
                if d <= int(rate * len(pattern)):
                    out.append((doc, item, d))
    return sorted(out, key=repr)


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + rng.choice("xyz") + text[at:], text[:at] + rng.choice("xyz") + text[at + 1 :]])
    return text


def test_matches_equal_brute_force(spark):
    rng = random.Random(4)
    items = [(i, awkward.words(rng, rng.randint(3, 20), "abcd")) for i in range(12)]
    docs = []
    for i in range(50):
        parts = [awkward.words(rng, rng.randint(0, 15), "abcd")]
        for _ in range(rng.randint(0, 2)):
            parts += [edited(rng, rng.choice(items)[1], rng.randint(0, 9)), awkward.words(rng, 3, "abcd")]
        docs.append((i, rng.choice([str, str.upper])("  ".join(parts))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in contamination.matches(df, bench, 0.1).collect()), key=repr)
    assert got == brute(docs, items, 0.1) and got


def test_awkward_documents_and_items(spark, monkeypatch):
    df = awkward.documents(spark, long_words=300)
    given = [(r.doc_id, r.text) for r in df.collect()]
    rows = [(1, given[0][1], "c"), (1, given[0][1], "c"), (2, None, "c"), (3, "", "c"), (4, "!!", "c"), (None, "x y", "c"), (5, "a", None), (6, given[7][1], "c")]
    bench = spark.createDataFrame(rows, "item_id long, text string, item string")
    want = brute(given, [r[:2] for r in rows], 0.08)
    got = contamination.matches(df, bench).collect()
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in got), key=repr) == want
    monkeypatch.setattr(contamination, "BLOCK_CHARS", 200)  # several passes
    got = contamination.matches(df, bench).collect()
    assert sorted(((r.doc_id, r.item_id, r.distance) for r in got), key=repr) == want
    leaking = {i for i, _, _ in want}
    kept = contamination.uncontaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect() if r.doc_id is not None), key=repr) == sorted((i for i, _ in given if i is not None and i not in leaking), key=repr)
    assert contamination.matches(awkward.empty(spark), bench).count() == 0
    assert contamination.matches(df, bench.limit(0)).count() == 0
    assert contamination.uncontaminated(df, bench.limit(0)).count() == len(given)


def test_short_items_are_whole_words(spark):
    docs = spark.createDataFrame([(1, "Yesterday all my troubles"), (2, "Yes, it is"), (3, "say yes"), (4, "no yess no"), (5, "a b, c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "yes"), (2, "B c"), (3, "yesterday all my trouble")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in contamination.matches(docs, items).collect())
    assert got == [(1, 3), (2, 1), (3, 1), (5, 2)]


def test_query_finds_every_whole_item(spark):
    docs = {r.doc_id: contamination.normal(r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = {r.item_id: contamination.normal(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in docs.items() for i, p in items.items() if p in t}
    got = {(r.doc_id, r.item_id): r.distance for r in op8_decontamination(spark, SF_SMALL).collect()}
    assert exact <= set(got) and all(got[x] == 0 for x in exact)
