"""Documents that operators must survive: nulls anywhere, empty and long texts, ties, repeated rows, clashing columns."""

import random

#: Extra columns whose names operators use inside.
CLASHING = ["row", "id", "fp", "hash", "key", "kind", "n", "ids", "kept", "found", "language", "simhash", "quality", "decoded", "label"]


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def texts(seed=1, long_words=20_000):
    rng = random.Random(seed)
    passage = words(rng, 60)
    base = [words(rng, rng.randint(5, 120)) for _ in range(30)]
    long = words(rng, long_words)
    out = [*base, base[0], base[0], base[1], f"{base[2]} {passage} {base[3]}", f"{passage}\n{base[4]}", f"x {passage.upper()}", passage + " " + passage]
    return [*out, None, "", "  \t\n ", "é", "Ünï\x1cçødé ＡＢ 日本語 😀 text", "a " * 200, long, long + " tail", "0 1 2 3 !!! ###"]


def documents(spark, seed=1, nulls=True, long_words=20_000):
    """doc_id, text, lang, source, n_chars and the clashing columns; repeated rows, and rows with a null id."""
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts(seed, long_words))]
    rows += [rows[0], rows[0], rows[3]]
    if nulls:
        rows += [(None, rows[5][1], None, None, None), (None, None, "en", None, None), (900, "lone words stand here", None, None, None)]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, shape).repartition(3)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(f"clash {c}") for c in CLASHING})


def empty(spark, clash=True):
    return documents(spark).limit(0)
