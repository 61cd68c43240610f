import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import linededup
from quarry.llm.queries import op11_lines
from tests.conftest import SF_SMALL, plan_text
from tests.llm import awkward

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, least=10):
    """(id, lines, dropped, kept) of every row; rows without an id are the last document."""
    last = float("inf")
    split = [(last if d is None else d, d, (t or "").split("\n")) for d, t in docs]
    held = defaultdict(set)
    for order, _, lines in split:
        for line in lines:
            held[line.strip(SPACES).translate(LOWER)].add(order)
    out = []
    for order, d, lines in split:
        keys = [line.strip(SPACES).translate(LOWER) for line in lines]
        kept = [line for line, k in zip(lines, keys, strict=True) if len(k) < least or min(held[k]) == order]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (7, 2), (9, 3)])
def test_any_batches_match_brute_force(spark, batches, fanout):
    rng = random.Random(batches)
    pool = ["a line of some length", "  A line OF some length\r", "short", "exactly 10", "exactly 9", "", "\t", "ÄÖÜ äöü ÄÖÜ", "äöü äöü äöü"]
    pool += [f"line number {i} of the pool" for i in range(40)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for i in rng.sample(range(-50, 500), 90)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert found(linededup.drop_repeated_lines(df, batches=batches, fanout=fanout)) == brute(docs)


def test_awkward_documents(spark):
    df = awkward.documents(spark)
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert found(linededup.drop_repeated_lines(df, batches=3)) == brute(docs)
    assert linededup.drop_repeated_lines(awkward.empty(spark)).count() == 0


def test_repeated_ids_are_one_document_and_other_ids_are_refused(spark):
    docs = [(1, "the shared line 1\nx"), (1, "the shared line 1\nanother shared line"), (2, "another shared line\nthe shared line 1"), (None, "the shared line 1"), (None, "for the last only"), (None, "for the last only")]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    assert found(linededup.drop_repeated_lines(df, batches=2)) == brute(docs)
    with pytest.raises(TypeError, match="integer"):
        linededup.drop_repeated_lines(df.select(F.col("doc_id").cast("string").alias("doc_id"), "text"))


def test_a_very_long_text_with_a_common_line(spark):
    common = "this very common line"
    docs = [(0, "\n".join([common] * 20_000))] + [(i, f"{common}\nown line of document {i}") for i in range(1, 200)]
    docs.append((1000, "\n".join(f"{common}\nlong text line {i}" for i in range(20_000))))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(linededup.drop_repeated_lines(df)) == brute(docs)


def test_runs_are_levelled_disjoint_and_read_where_they_lie(spark):
    runs = linededup.LineRuns(spark, buckets=4, fanout=2)
    met = set()
    for batch in range(5):
        lines = spark.createDataFrame([(f"{x}".encode(), batch) for x in range(batch * 3, batch * 3 + 6)], "line binary, doc long")
        new = {r["line"] for r in runs.add(lines).collect()}
        assert new == {f"{x}".encode() for x in range(batch * 3, batch * 3 + 6)} - met
        met |= new
        runs.compact()
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sum(run.count() for run in runs.runs()) == len(met)
    joined = lines.groupBy("line").count().join(runs.runs()[0].hint("merge"), "line", "left_anti")
    plan = plan_text(joined)
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    runs.release()


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((d, n, m, hashlib.sha256(k.encode("utf-8", "surrogatepass")).hexdigest()) for d, n, m, k in brute(docs))
    df = op11_lines(spark, SF_SMALL)
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect()) == want
    assert sum(r[2] for r in want) > 0
    assert "Python" not in plan_text(df) and "Arrow" not in plan_text(df)
