import math
import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import ordinal
from quarry.llm.queries import op4_quality
from tests.conftest import SF_ORACLE
from tests.llm import awkward


def rows(seed, n):
    """Three grades told apart by a word each, among noise."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        g = rng.randrange(3)
        text = awkward.words(rng, 20, "abcdef") + " " + ["rotten", "plain", "splendid"][g]
        out.append((g, text))
    return out


def test_gradient_is_that_of_the_loss(monkeypatch):
    seen = {}

    def check(loss, start, steps):
        rng = np.random.default_rng(0)
        x = start + 0.1 * rng.standard_normal(len(start))
        value, grad = loss(x)
        for i in rng.integers(0, len(x), 12).tolist() + [len(x) - 1, len(x) - 2]:
            step = np.zeros(len(x))
            step[i] = 1e-5
            slope = (loss(x + step)[0] - loss(x - step)[0]) / 2e-5
            assert abs(slope - grad[i]) < 1e-4 * max(1, abs(slope))
        seen["value"] = value
        return x

    monkeypatch.setattr(ordinal, "_lbfgs", check)
    ordinal.CumulativeLink.fit([(g, *ordinal.features(t)) for g, t in rows(1, 60)], min_rows=1)
    assert seen["value"] > 0


def test_grades_and_thresholds_are_ordered_and_held_out_rows_right(spark):
    data = rows(2, 600)
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(data)], "doc_id long, text string")
    ratings = spark.createDataFrame([(i, g) for i, (g, _) in enumerate(data) if i % 4], "doc_id long, grade int")
    model = ordinal.fit(df, ratings)
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r.quality for r in ordinal.score(df, model).collect()}
    wrong = sum(round(got[i].expected) != g for i, (g, _) in enumerate(data) if i % 4 == 0)
    assert wrong <= 3
    for q in got.values():
        assert 1 >= q.tails[0] >= q.tails[1] >= 0 and abs(q.expected - sum(q.tails)) < 1e-9
    kept = ordinal.select(df, model).count()
    assert kept == sum(q.tails[-1] >= 0.5 for q in got.values())


def test_awkward_documents(spark):
    df = awkward.documents(spark, long_words=500)
    ratings = df.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("grade"), F.lit("c").alias("id"))
    ratings = ratings.union(spark.createDataFrame([(None, 1, "c"), (2, None, "c"), (10**6, 1, "c")], "doc_id long, grade int, id string"))
    model = ordinal.fit(df, ratings)
    scored = ordinal.score(df, model)
    assert scored.count() == df.count() and scored.where("quality.expected IS NULL OR isnan(quality.expected)").count() == 0
    assert ordinal.score(awkward.empty(spark), model).count() == 0
    none = ordinal.fit(df, ratings.limit(0))
    assert none is None and ordinal.select(df, none).count() == df.count()
    one = ordinal.fit(df, df.select("doc_id", F.lit(1).alias("grade")))  # a single grade: nothing to tell apart
    assert {r.quality.expected for r in ordinal.score(df, one).collect()} == {1.0}


def test_query_keeps_good_and_drops_toxic_documents(spark):
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()
    kept = {r.doc_id for r in op4_quality(spark, SF_ORACLE).collect()}
    good = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    toxic = [r.doc_id for r in labels if r.toxic == 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert sum(i in kept for i in toxic) <= 0.1 * len(toxic)


def test_scores_match_adding_weights_one_by_one(spark):
    data = rows(5, 200)
    model = ordinal.CumulativeLink.fit([(g, *ordinal.features(t)) for g, t in data], min_rows=1)
    weight = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    texts = [*[t for _, t in data[:50]], "splendid unseen words", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.quality for r in ordinal.score(df, model).collect()}
    for i, text in enumerate(texts):
        keys, values = ordinal.features(text)
        eta = math.fsum(weight.get(k, 0.0) * v for k, v in zip(keys.tolist(), values.tolist(), strict=True))
        tails = [1 / (1 + math.exp(cut - eta)) for cut in model.thresholds.tolist()]
        chances = [a - b for a, b in zip([1.0, *tails], [*tails, 0.0], strict=True)]
        assert all(math.isclose(a, b, rel_tol=1e-6) for a, b in zip(got[i].tails, tails, strict=True))
        assert math.isclose(got[i].expected, sum(g * c for g, c in zip(model.grades, chances, strict=True)), rel_tol=1e-6)
