import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import langid
from quarry.llm.hashes import SortedHashes
from quarry.llm.queries import op10_language
from tests.conftest import SF_ORACLE
from tests.llm import awkward


def naive(texts, alphabet):
    """Interpolated Kneser-Ney trigrams from plain dictionaries."""
    grams = Counter()
    for t in texts:
        s = [int(x) for x in langid.letters(t)]
        grams.update(zip(s, s[1:], s[2:], strict=False))
    two = Counter((b, c) for a, b, c in grams)
    one = Counter(c for b, c in two)

    def discount(counts):
        n1, n2 = sum(v == 1 for v in counts.values()), sum(v == 2 for v in counts.values())
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5

    d3, d2, d1 = discount(grams), discount(two), discount(one)

    def p1(c):
        total = sum(one.values())
        return max(one[c] - d1, 0) / total + d1 * len(one) / total / alphabet

    def p2(b, c):
        n, kinds = sum(v for k, v in two.items() if k[0] == b), sum(k[0] == b for k in two)
        return p1(c) if not n else max(two[b, c] - d2, 0) / n + d2 * kinds / n * p1(c)

    def p3(a, b, c):
        n, kinds = sum(v for k, v in grams.items() if k[:2] == (a, b)), sum(k[:2] == (a, b) for k in grams)
        return p2(b, c) if not n else max(grams[a, b, c] - d3, 0) / n + d3 * kinds / n * p2(b, c)

    return p3


def counted(texts):
    keys, n = np.unique(np.concatenate([langid.trigrams(langid.letters(t)) for t in texts]), return_counts=True)
    return keys, n


def test_probabilities_match_plain_kneser_ney():
    train = {"x": ["abra cadabra", "bar abac", "a ab abc"], "y": ["zog gozz", "gogo zz"]}
    models = langid.LanguageModels({k: counted(v) for k, v in train.items()})
    alphabet = len({int(c) for v in train.values() for t in v for c in langid.letters(t)[2:]}) + 1
    for text in ["abra", "zogo q", "a", "ABRA, cadabra!!"]:
        points = [int(x) for x in langid.letters(text)]
        n, nats = models.cross_entropies([text])
        for i, lang in enumerate(models.langs):
            p = naive(train[lang], alphabet)
            want = -sum(math.log(p(*g)) for g in zip(points, points[1:], points[2:], strict=False)) / (len(points) - 2)
            assert n[0] == len(points) - 2 and math.isclose(nats[0, i], want, rel_tol=1e-9)


def test_sorted_hashes_find_exactly_their_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    found = SortedHashes(keys)
    assert (keys[found.order][found.rows(keys)] == keys).all()
    assert (found.rows(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()
    assert (SortedHashes(keys[:0]).rows(keys) == -1).all()


def test_long_texts_score_like_their_pieces(monkeypatch):
    models = langid.LanguageModels({"x": counted(["abra cadabra"]), "y": counted(["gozz"])})
    texts = ["abra cad gozz " * 50, None, "", "12 !", "zz" * 400]
    whole = models.cross_entropies(texts)
    monkeypatch.setattr(langid, "CHUNK", 17)
    for a, b in zip(whole, models.cross_entropies(texts), strict=True):
        assert np.allclose(a, b)


def test_awkward_documents(spark):
    df = awkward.documents(spark, long_words=500)
    model = langid.fit(df, F.lit(True))
    rows = langid.predict(df.drop("language"), model).collect()
    assert len(rows) == df.count()
    for r in rows:
        none = not any(c.isalpha() for c in r.text or "")
        assert (r.language.lang == langid.UND) == none and r.language.lang in ("en", "de", langid.UND)
        assert 0 <= r.language.score <= 1 and (not none or (r.language.rejected and r.language.score == 0))
    assert langid.predict(awkward.empty(spark), model).count() == 0
    nothing = langid.fit(awkward.empty(spark), F.lit(True))
    assert {r.language.lang for r in langid.predict(df, nothing).collect()} == {langid.UND}


def test_the_sample_is_bounded_without_ids_and_with_copies(spark):
    rows = [(None, f"text number {i} of many words in it {i * 7919}", "en") for i in range(3000)] + [(5, "one text that is copied", "en")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sample = langid._sample(docs, F.lit(True), "text", "lang", "doc_id", 500).collect()
    assert 150 < len(sample) < 600 and len({r.text for r in sample}) == len(sample)
    assert 0 < sum(r.calibrate for r in sample) < 0.3 * len(sample)


def test_recognised_rows_are_those_not_rejected(spark, monkeypatch):
    df = awkward.documents(spark, long_words=3000)
    model = langid.fit(df, F.lit(True))
    judged = langid.predict(df.drop("language"), model)
    want = sorted((r.doc_id, r.text) for r in judged.where("NOT language.rejected").collect() if r.doc_id is not None)
    for size in (1, 3000, 4 << 20):
        monkeypatch.setattr(langid, "SLICE_BYTES", size)
        kept = langid.recognised(df, model)
        assert kept.columns == df.columns
        assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None) == want
    assert langid.recognised(awkward.empty(spark), model).count() == 0
    assert langid.recognised(df, {"grams": {}}).count() == 0


def test_foreign_letters_are_rejected_and_own_kept(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = langid.fit(docs, F.lit(True))
    judged = langid.predict(docs.select("doc_id", "text"), model)
    assert judged.where("language.rejected").count() <= 0.005 * docs.count()
    foreign = spark.createDataFrame([(1, "xqzw kjxq wqzx jkqx zzxq " * 20), (2, "мир и война " * 20)], "doc_id long, text string")
    assert langid.predict(foreign, model).where("language.rejected").count() == 2


def test_query_on_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    rows = op10_language(spark, SF_ORACLE).collect()
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
