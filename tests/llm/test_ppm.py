import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import ppm
from quarry.llm.queries import op5_ppm
from tests.conftest import SF_SMALL
from tests.llm import awkward


def naive(train, order):
    """PPM with method C escapes and symbol exclusion, symbol by symbol."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        s = [ppm.BEFORE] * order + list(t) + [ppm.END]
        for i in range(order, len(s)):
            for o in range(order + 1):
                counts[o][tuple(s[i - o : i])][s[i]] += 1

    def probability(context, symbol):
        excluded, p = set(), 1.0
        for o in range(order, -1, -1):
            seen = {k: v for k, v in counts[o].get(tuple(context[len(context) - o :]), {}).items() if k not in excluded}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if symbol in seen:
                return p * seen[symbol] / total
            p *= len(seen) / total
            excluded |= set(seen)
        return p / max(1, ppm.SYMBOLS - len(excluded))

    def score(text):
        s = [ppm.BEFORE] * order + list(text) + [ppm.END]
        return sum(math.log10(probability(s[i - order : i], s[i])) for i in range(order, len(s)))

    return probability, score


def base(train, texts):
    counts = Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(counts.values()), len(counts)
    return [(len(t.split()) + 1, sum(counts[w] > 0 for w in [*t.split(), None]), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*t.split(), None])) for t in texts]


def corpus(seed, letters, n):
    rng = random.Random(seed)
    return [ppm.tokens(awkward.words(rng, rng.randint(0, 12), letters)) for _ in range(n)]


@pytest.mark.parametrize("order,head_grams", [(0, 1000), (1, 0), (2, 30), (4, 0), (5, 1000), (5, 30), (6, 0)])
def test_scores_match_symbol_by_symbol_coding(spark, order, head_grams):
    train, test = corpus(1, "abcd", 30), [*corpus(2, "abcdef", 30), b""]
    rows = [(i, t.decode(), i < len(train)) for i, t in enumerate([*train, *test])]
    df = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = {r.doc_id: r.score for r in ppm.score(df, F.col("learn"), order=order, head_grams=head_grams).collect()}
    probability, score = naive(train, order)
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert math.isclose(got[i], score(t.encode()), rel_tol=1e-9)
    assert math.isclose(sum(probability([97] * order, x) for x in range(ppm.SYMBOLS)), 1.0)


def test_levels_hold_every_order_and_its_contexts(spark):
    train, order = corpus(1, "abcd", 30), 4
    counts = [Counter() for _ in range(order + 1)]
    for t in train:
        s = [ppm.BEFORE] * order + list(t) + [ppm.END]
        for i in range(order, len(s)):
            for o in range(order + 1):
                counts[o][tuple(s[i - o : i + 1])] += 1
    packed = lambda gram: sum(x << (9 * (len(gram) - 1 - i)) for i, x in enumerate(gram))
    grams = spark.createDataFrame([(packed(g), n) for g, n in counts[order].items()], "key long, c long")
    for o, level in ppm._levels(grams, order).items():
        rows = level.collect()
        assert {r.key: r.c for r in rows} == {packed(g): n for g, n in counts[o].items()}
        contexts = defaultdict(dict)
        for g, n in counts[o].items():
            contexts[packed(g[:-1])][g] = n
        assert sorted(r.key >> 9 for r in rows if r.first) == sorted(contexts)
        for r in rows:
            seen = contexts[r.key >> 9]
            below = sum(counts[o - 1][g[1:]] for g in seen) if o else 0
            assert (r.n, r.d, r.below) == (sum(seen.values()), len(seen), below)


def test_refuses_orders_that_do_not_fit(spark):
    with pytest.raises(ValueError):
        ppm.score(awkward.empty(spark), F.lit(True), order=7)


def test_no_broadcast_grows_with_the_model(spark, monkeypatch):
    """Only the heads reach the driver: nothing of the gram table beyond ``head_grams`` rows."""
    sent = []
    arrays = ppm._arrays
    monkeypatch.setattr(ppm, "_arrays", lambda head: sent.append(arrays(head)) or sent[-1])
    df = awkward.documents(spark, long_words=2000)
    ppm.score(df, F.lit(True), order=3, head_grams=50, head_words=20).count()
    assert [len(keys) <= most for (keys, _), most in zip(sent, (50, 20), strict=True)] == [True, True]


def test_long_texts_in_pieces_keep_their_contexts(monkeypatch):
    text = corpus(3, "abc", 1)[0] * 40
    whole = np.concatenate([k for k, _ in ppm.chunks([text], 3)])
    monkeypatch.setattr(ppm, "CHUNK", 50)
    assert np.concatenate([k for k, _ in ppm.chunks([text], 3)]).tolist() == whole.tolist()


@pytest.mark.parametrize("head_grams,head_words", [(ppm.HEAD_GRAMS, ppm.HEAD_WORDS), (60, 4)])
def test_awkward_documents_in_the_heads_or_joined(spark, head_grams, head_words):
    df = awkward.documents(spark, long_words=2000)
    train = F.coalesce(F.col("doc_id") % 3 != 1, F.lit(False))
    rows = ppm.score(df, train, order=2, head_grams=head_grams, head_words=head_words).collect()
    given = df.select("doc_id", "text").collect()
    texts = [ppm.tokens(g.text) for g in given]
    trained = [t for g, t in zip(given, texts, strict=True) if g.doc_id is not None and g.doc_id % 3 != 1]
    _, score = naive(trained, 2)
    want = sorted(((g.doc_id, *b[:3], round(b[3], 6), round(score(t), 6)) for g, t, b in zip(given, texts, base(trained, texts), strict=True)), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in rows), key=repr) == want


def test_no_training_rows_and_no_rows(spark):
    df = awkward.documents(spark, long_words=50)
    rows = ppm.score(df, F.lit(False), order=2).collect()
    assert len(rows) == df.count() and all(r.n_known == 0 and r.train_tokens == 0 for r in rows)
    text = next(r for r in rows if r.n_tokens == 1)
    assert math.isclose(text.score, -math.log10(ppm.SYMBOLS))
    assert ppm.score(awkward.empty(spark), F.lit(True)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    texts = [ppm.tokens(d.text) for d in docs]
    out = [zlib.crc32(str(d.doc_id).encode()) % 7 == 2 for d in docs]
    want = {d.doc_id: (o, *b) for d, o, b in zip(docs, out, base([t for t, o in zip(texts, out, strict=True) if not o], texts), strict=True)}
    _, coded = naive([t for t, o in zip(texts, out, strict=True) if not o], ppm.ORDER)
    short = {d.doc_id: t for d, t in zip(docs, texts, strict=True) if len(t) < 3000}
    some = set(sorted(short, key=lambda d: zlib.crc32(str(d).encode()))[:25])
    for r in op5_ppm(spark, SF_SMALL).collect():
        if r.doc_id in some:  # symbol by symbol
            assert math.isclose(r.score, coded(short[r.doc_id]), rel_tol=1e-9)
        held, n, known, total, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, score, rel_tol=1e-9) and r.score < 0
