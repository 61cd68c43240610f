import sys

from quarry import operators as op
from quarry.plans import jobs
from quarry.sources.files import lines_frame
from tests.conftest import plan_text

# The sample sentences whose word counts are known.
SAMPLE = [
    "Apache Spark is a distributed computing framework",
    "Spark provides high-level APIs in Java Scala Python",
    "Distributed computing enables processing large datasets",
]


def test_golden_word_count(spark):
    counts, failures = jobs.word_count_job(lines_frame(spark, SAMPLE, 2))
    got = {r.word: r["count"] for r in counts.collect()}
    assert len(got) == 18
    assert got["spark"] == got["distributed"] == got["computing"] == 2
    assert got["high-level"] == 1
    assert sum(v for k, v in got.items() if k not in ("spark", "distributed", "computing")) == 15
    assert failures.count() == 0


def test_word_count_is_sorted_by_code_point(spark):
    counts = op.word_count(lines_frame(spark, ["b a B Z é z"], 1)).collect()
    assert [r.word for r in counts] == sorted(r.word for r in counts)


def test_trim_rules_blanks_and_unicode_spaces(spark):
    lines = ["Hi, hi! (hi) high-level ...", "   leading blanks", "", "a b c\x1cd\x85e"]
    got = {r.word: r["count"] for r in op.word_count(lines_frame(spark, lines, 2)).collect()}
    expected = {}
    for line in lines:
        for w in line.split():
            w = w.lower().strip(".,:;!?")
            if w:
                expected[w] = expected.get(w, 0) + 1
    assert got == expected


def test_split_matches_python_on_every_whitespace_character(spark):
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert len(spaces) == 29
    line = "".join("x" + s for s in spaces) + "x"  # every whitespace character separates two words
    got = {r.word: r["count"] for r in op.word_count(lines_frame(spark, [line], 1)).collect()}
    assert got == {"x": len(spaces) + 1} == {"x": len(line.split())}


def test_missing_expected_word_is_a_failure(spark):
    expected = spark.createDataFrame([("spark", 2), ("absent", 1)], "word string, expected_count bigint")
    _, failures = jobs.word_count_job(lines_frame(spark, SAMPLE, 2), expected)
    assert [(r.word, r.expected_count, r.actual_count) for r in failures.collect()] == [("absent", 1, None)]


def test_word_count_stays_in_the_jvm(spark):
    plan = plan_text(op.word_count(lines_frame(spark, SAMPLE, 2)))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "partial_count" in plan
