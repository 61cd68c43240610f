"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import functools
import os
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, contamination, curves, langid, linededup, ordinal, ppm, simhash, substrings, trie, urls, vafile, wrapper
from quarry.llm.common import held_out, spread_small, table
from quarry.plans.storage import use_local_folder

# The rules of the URL query, as host, path start and action.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
TOKENIZER_FILE = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    """Where the installed public tokenizer files keep ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _sha256(col) -> F.Column:
    return F.sha2(F.coalesce(col, F.lit("")), 256)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 2 or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules; a URL that no rule fits is allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    found = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in every document after cutting passages of 35 or more words that occur again."""
    found = substrings.repeats(table(spark, sf_dir, "documents"), min_words=35)
    return found.select("doc_id", "n_words", "n_removed", _sha256(F.col("kept")).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents selected by the probability of the top grade: 0 toxic, 1 of low quality, 2 good.

    Rated documents of fold 2 of 5 are left out of the fit.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 2)
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    ratings = table(spark, sf_dir, "labels").where(~out).select("doc_id", grade.alias("grade"))
    found = ordinal.select(spread_small(docs), ordinal.fit(docs, ratings))
    tails = F.col("quality.tails")
    return found.select(
        "doc_id",
        out.alias("held_out"),
        F.col("quality.expected").alias("expected_grade"),
        F.try_element_at(tails, F.lit(1)).alias("p_not_toxic"),
        F.try_element_at(tails, F.lit(2)).alias("p_good"),
    )


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PPM and unigram scores of every text, learned from the documents outside fold 2 of 7."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    found = ppm.score(docs, ~out)
    return found.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by its host's wrapper."""
    pages = spread_small(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return wrapper.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return curves.neighbours(vectors, F.col("vec_id") % 20 == 0, k=20)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, with its least edit distance."""
    docs = spread_small(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return contamination.matches(docs, table(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by the tokenisation automaton, decoded again; their digests."""
    docs = spread_small(table(spark, sf_dir, "documents").select("doc_id", "text"))
    done = bpe.encode(docs, tokenizer_path(), decoded_col="decoded", keep=["doc_id"])
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        _sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the documents outside fold 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = langid.fit(docs, ~out)
    done = langid.predict(spread_small(docs.select("doc_id", "text")), model)
    return done.select(
        "doc_id",
        out.alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.nats").alias("nats_per_char"),
        F.col("language.rejected").alias("rejected"),
    )


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that a document of smaller id holds, as counts and a digest."""
    found = linededup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", _sha256(F.col("kept")).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of the conversations, rebuilt with shared beginnings."""
    turns, members = trie.conversation_turns(table(spark, sf_dir, "conversations"))
    found = trie.prefix_trie(*trie.share_beginnings(turns, members))
    return found.select(
        F.col("seq").alias("conv_id"),
        "depth",
        F.col("parent_seq").alias("parent_conv_id"),
        F.col("n_members").alias("n_convs"),
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        "ends_sha256",
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 64-dimensional vector's cluster after five rounds from 40 vectors chosen by hash."""
    found = vafile.described(*vafile.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256.0))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def packed(folder: str) -> str:
    """This package as a zip file in ``folder``, for executors that do not share the driver's files."""
    package = Path(__file__).resolve().parents[1]
    target = Path(folder) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    return str(target)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package, and name a shared folder for local runs.

    Where driver and workers share this machine's files, they share the folder
    the driver found it in. On a cluster the package is shipped, once a context.
    """
    use_local_folder(spark)
    context = spark.sparkContext
    if not context.master.startswith("local"):
        if not any(name.endswith("quarry.zip") for name in context.listFiles):
            context.addPyFile(packed(context._temp_dir))  # the driver's own folder, which its file server reads
        return
    root = str(Path(__file__).resolve().parents[2])
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, root]))


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(run)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return run(spark, sf_dir)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_simhash, op2_urls, op3_substrings, op4_quality, op5_ppm, op6_html, op7_neighbours, op8_decontamination, op9_bpe, op10_language, op11_lines, op12_prefix_trie, op13_centroids]
    return {run.__name__: _query(run) for run in found}


_URLS_SQL = """
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
r(h, p, action) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES) + """),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM (SELECT DISTINCT page_id, host, path FROM u) JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.action, 'allow') AS verdict
FROM u LEFT JOIN best ON u.page_id = best.page_id
"""


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_LINES_SQL = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (
  SELECT doc_id, pos, lines[pos] AS raw,
         translate(trim(lines[pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_AZ}) AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM split)
),
first AS (SELECT key, min(doc_id) AS doc_id FROM line WHERE length(key) >= 10 GROUP BY key),
judged AS (SELECT line.*, first.doc_id IS NOT NULL AND first.doc_id <> line.doc_id AS gone FROM line LEFT JOIN first ON line.key = first.key)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# crc32 of a text of ASCII characters, eight shifts a byte
_CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length({0}) + 1), lambda i: CAST(ascii(substr({0}, i, 1)) AS BIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""
_TRIE_SQL = f"""
WITH RECURSIVE own AS (
  SELECT conv_id, list(coalesce(role, '') || chr(0) || coalesce(text, '') ORDER BY turn NULLS FIRST) AS seq
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
head AS (SELECT conv_id, seq, CAST({_CRC_SQL.format("CAST(conv_id AS VARCHAR)")} % 6 AS BIGINT) AS h FROM own),
rebuilt AS (
  SELECT head.conv_id, list_concat(coalesce(base.seq[1:head.h], []), head.seq[head.h + 1:]) AS seq
  FROM head LEFT JOIN own AS base ON base.conv_id = head.conv_id - head.conv_id % 100
),
path AS (
  SELECT conv_id, d AS depth, len(seq) AS size, seq[1:d] AS node, CASE WHEN d > 0 THEN length(seq[d]) - position(chr(0) IN seq[d]) ELSE 0 END AS weight
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)
),
node AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(weight) AS weight,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '') AS ends
  FROM path GROUP BY node
),
child AS (SELECT node[1:len(node) - 1] AS parent, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY parent),
counted AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child ON child.parent = node.node),
subtree AS (
  SELECT node[1:d] AS top, count_if(n_children = 0) AS n_leaves, sum((n_convs - 1) * weight) AS saved_tokens
  FROM (SELECT node, n_children, n_convs, weight, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY top
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN subtree s ON s.top = c.node LEFT JOIN node p ON c.depth > 0 AND p.node = c.node[1:len(c.node) - 1]
"""

_VECTORS_SQL = """
kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS vec FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
c0 AS (SELECT row_number() OVER (ORDER BY hash) - 1 AS cluster, vec FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS hash, vec FROM kept ORDER BY hash LIMIT 40))"""


def _assign_sql(step: int) -> str:
    gap = "list_sum(list_transform(list_zip(k.vec, c.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return f"""
a{step} AS (
  SELECT vec_id, any_value(vec) AS vec, min(distance * 64 + cluster) % 64 AS cluster, min(distance * 64 + cluster) // 64 AS distance
  FROM (SELECT k.vec_id, k.vec, c.cluster, CAST({gap} AS BIGINT) AS distance FROM kept k, c{step} c) GROUP BY vec_id
)"""


def _mean_sql(step: int) -> str:
    return f"""
m{step} AS (
  SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY dim) AS vec
  FROM (SELECT cluster, dim, CAST(sum(x) AS BIGINT) AS total, count(*) AS n FROM (SELECT cluster, unnest(vec) AS x, unnest(range(64)) AS dim FROM a{step}) GROUP BY cluster, dim) GROUP BY cluster
),
c{step + 1} AS (SELECT c{step}.cluster, coalesce(m{step}.vec, c{step}.vec) AS vec FROM c{step} LEFT JOIN m{step} ON m{step}.cluster = c{step}.cluster)"""


_CENTROIDS_SQL = "WITH " + ",".join([_VECTORS_SQL, *[part for i in range(5) for part in (_assign_sql(i), _mean_sql(i))], _assign_sql(5)]) + """
SELECT vec_id, CAST(a5.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY a5.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c5.vec, ',')) AS centroid_sha256
FROM a5 JOIN c5 ON c5.cluster = a5.cluster
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_urls": _URLS_SQL, "op11_lines": _LINES_SQL, "op12_prefix_trie": _TRIE_SQL, "op13_centroids": _CENTROIDS_SQL}
