"""

Every query reads the whole driver tables (or files Spark writes from them)
and returns a lazy DataFrame; queries that exercise sinks write to a fresh
folder under the cluster's shared ``spark.checkpoint.dir`` and return the
read-back. Column names are aliased identically in Spark and in the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.plans import jobs
from quarry.plans.storage import Scratch, saved_table, scratch_path, use_local_folder
from quarry.sources import schemas, synth, tables
from quarry.sources.files import dealt_lines, read_csv, read_json_lines, read_parquet, write_csv, write_json, write_parquet

# The training-data operators and their pipeline are optional: without their folders, or a package they need,
# the rest still works. A module of this repository that is there but fails to import is an error.
try:
    import quarry.llm.queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("quarry.llm", "quarry.llm.queries") and missing.name.split(".")[0] == "quarry":
        raise
    llm = None
try:
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "quarry.llm", "quarry.llm.queries") and missing.name.split(".")[0] == "quarry":
        raise
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
BASELINE_CONFIG = "view"  # measurements mapping: events.event_type "view" is the baseline
# The configurations the measurements mapping must contain (the event types).
EXPECTED_CONFIGS = ["click", "error", "purchase", "signup", "view"]
ITERATIONS = 3


# --------------------------------------------------------------------------- adapters

def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_transactions(tables.transactions(spark, sf_dir))


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.sales(spark, sf_dir)


# --------------------------------------------------------------------------- reports

def q_clean_transactions(spark, sf_dir):
    return _clean(spark, sf_dir)


def q_to_date_load(spark, sf_dir):
    """Raw transactions -> CSV (date as text) -> read with explicit schema -> to_date -> clean."""
    path = write_csv(tables.transactions(spark, sf_dir), scratch_path(spark, "transactions_csv"))
    loaded = read_csv(spark, path, schemas.TRANSACTIONS_TEXT_DATE)
    normalised = loaded.withColumn("date", F.try_to_date(F.col("date")))
    return op.clean_transactions(normalised)


def q_country_metrics(spark, sf_dir):
    return op.country_metrics(_clean(spark, sf_dir))


def q_category_trends(spark, sf_dir):
    return op.category_trends(_clean(spark, sf_dir))


def q_customer_spend(spark, sf_dir):
    """Cleaned orders add up per customer in every task before any join, so a hot customer is one row a task."""
    spend = op.customer_spend(op.clean_transactions(tables.order_transactions(spark, sf_dir)))
    # an inner join: Spark would push a semi-join below the aggregation, back onto the raw orders
    return spend.join(tables.customers_with_country(spark, sf_dir).distinct(), "customer_id")


def q_top_customers(spark, sf_dir):
    return op.highest_spend(q_customer_spend(spark, sf_dir), 100)


def q_csv_roundtrip(spark, sf_dir):
    path = write_csv(q_country_metrics(spark, sf_dir), scratch_path(spark, "country_metrics"), single_file=True)
    return read_csv(spark, path, jobs.COUNTRY_METRICS)


def q_csv_text_roundtrip(spark, sf_dir):
    """Country counts written as CSV and read back without a schema: every column is a string."""
    counts = q_country_metrics(spark, sf_dir).select("country", "total_transactions")
    return read_csv(spark, write_csv(counts, scratch_path(spark, "country_counts"), single_file=True))


def q_parquet_roundtrip(spark, sf_dir):
    path = write_parquet(q_category_trends(spark, sf_dir), scratch_path(spark, "category_trends"))
    return read_parquet(spark, path)


def q_json_roundtrip(spark, sf_dir):
    path = write_json(q_top_customers(spark, sf_dir), scratch_path(spark, "top_customers"), single_file=True)
    return read_json_lines(spark, path).select("customer_id", "total_spent", "purchase_count")


def q_clean_cached_country_metrics(spark, sf_dir):
    """Optimised pipeline: clean -> rebalance by country -> cache once -> three reports -> read back."""
    run = jobs.run_reports(
        tables.transactions(spark, sf_dir), scratch_path(spark, "reports"), reuse="cache", repartition_on="country"
    )
    return jobs.read_reports(spark, run)["country_metrics"]


def q_report_roundtrip_check(spark, sf_dir):
    """Baseline pipeline written and read back: rows read and rows missing/extra per report (none when faithful).

    The cleaned rows are written once; the reports and their recomputation read that table.
    """
    clean = saved_table(_clean(spark, sf_dir), "clean_transactions")
    run = jobs.run_reports(clean, scratch_path(spark, "reports"), reuse="none")
    back = jobs.read_reports(spark, run)
    originals = {
        "country_metrics": op.country_metrics(clean),
        "category_trends": op.category_trends(clean),
        "top_customers": op.top_customers(clean, 100),
    }
    diffs = []
    for name, original in originals.items():
        diff = op.roundtrip_diff(original, back[name])
        rows = back[name].agg(F.count(F.lit(1))).scalar()
        diffs.append(diff.select(F.lit(name).alias("report"), rows.alias("report_rows"), "missing_rows", "extra_rows"))
    return diffs[0].unionByName(diffs[1]).unionByName(diffs[2])


# --------------------------------------------------------------------------- sales

def q_category_region_sales(spark, sf_dir):
    return op.category_region_sales(_sales(spark, sf_dir))


def q_category_metrics(spark, sf_dir):
    return op.category_metrics(_sales(spark, sf_dir))


def q_region_metrics(spark, sf_dir):
    return op.region_metrics(_sales(spark, sf_dir))


def q_category_counts(spark, sf_dir):
    return op.category_counts(_sales(spark, sf_dir))


def q_sales_json_load(spark, sf_dir):
    """Sales written as JSON lines (parallel files), read back with the fixed schema, then totalled."""
    path = write_json(_sales(spark, sf_dir), scratch_path(spark, "sales_json"))
    return op.category_region_sales(read_json_lines(spark, path, schemas.SALES))


def q_partition_sweep(spark, sf_dir):
    return op.partition_sweep(_sales(spark, sf_dir), op.PARTITION_COUNTS).orderBy(
        "partition_count", "category", "region"
    )


def q_partition_profile(spark, sf_dir):
    """The sales rows profiled as they lie: total rows, rows over all partitions' counts, and whether they agree.

    Each partition counts its own rows (partial aggregation); no row is moved for it.
    """
    sales = _sales(spark, sf_dir)
    total = sales.agg(F.count(F.lit(1))).scalar()
    profiled = op.partition_profile(sales).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("profiled_rows"))
    return profiled.select(total.alias("total_rows"), "profiled_rows", (F.col("profiled_rows") == total).alias("adds_up"))


def _reuse(strategy: str):
    def run(spark, sf_dir):
        result = op.run_reuse_workload(_sales(spark, sf_dir), ITERATIONS, strategy, scratch_path(spark, f"reuse_{strategy}"))
        return read_parquet(spark, result.result_path)

    return run


# --------------------------------------------------------------------------- text

def q_word_count(spark, sf_dir):
    return op.word_count(tables.documents_text(spark, sf_dir))


def q_expected_counts(spark, sf_dir):
    _, failures = jobs.word_count_job(tables.documents_text(spark, sf_dir))
    return failures


def q_dealt_word_count(spark, sf_dir):
    """Word counts over the texts dealt round over the session's shuffle partitions."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return op.word_count(dealt_lines(tables.documents_text(spark, sf_dir), partitions))


# --------------------------------------------------------------------------- measurements

def _summary(spark, sf_dir):
    return op.trial_summary(tables.measurements(spark, sf_dir))


def q_trial_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def q_trial_improvement(spark, sf_dir):
    return op.trial_improvement(_summary(spark, sf_dir), BASELINE_CONFIG)


def q_trial_pivot(spark, sf_dir):
    return op.trial_pivot(op.trial_totals(tables.measurements(spark, sf_dir)))


def q_trial_best(spark, sf_dir):
    return op.trial_best(_summary(spark, sf_dir))


def q_trial_ranking(spark, sf_dir):
    return op.trial_ranking(_summary(spark, sf_dir))


def _study(spark, sf_dir):
    """Wide study table: one total per (config, trial), then trials, median/min/max and improvement."""
    totals = op.trial_totals(tables.measurements(spark, sf_dir))
    return jobs.study_table(totals, baseline=BASELINE_CONFIG)


def q_study_table(spark, sf_dir):
    """The study table written as one CSV file (one row per configuration) and read back with its schema."""
    study = _study(spark, sf_dir)
    path = write_csv(study, scratch_path(spark, "study_table"), single_file=True)
    return read_csv(spark, path, study.schema)


def q_study_checks(spark, sf_dir):
    """Study checks: configuration set both ways, positive trials and medians."""
    return jobs.study_checks(_study(spark, sf_dir), EXPECTED_CONFIGS).withColumnRenamed("check", "check_name")


def q_partition_study_check(spark, sf_dir):
    """A study's input and table checked: JSON lines, record count, configurations, trials and medians."""
    events = tables.table(spark, sf_dir, "events")
    lines = tables.events_json_lines(spark, sf_dir)
    checks = jobs.verify_partition_study(lines, tables.measurements(spark, sf_dir), _study(spark, sf_dir), events, EXPECTED_CONFIGS)
    return checks.withColumnRenamed("check", "check_name")


def q_reuse_study_check(spark, sf_dir):
    """A study's table checked, configurations, trials, medians and result rows, and its configurations ranked."""
    totals = op.trial_totals(tables.measurements(spark, sf_dir)).withColumn("result_rows", F.lit(ITERATIONS * 10))
    study = jobs.study_table(totals, baseline=BASELINE_CONFIG)
    checks, ranking = jobs.verify_reuse_study(study, ITERATIONS, 10, EXPECTED_CONFIGS)
    checks = checks.select(F.col("check").alias("item"), "checked_rows", "violations", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("double").alias("median_seconds"))
    none = F.lit(None).cast("bigint")
    ranks = ranking.select(F.col("config").alias("item"), none.alias("checked_rows"), none.alias("violations"), "rank", "median_seconds")
    return checks.unionByName(ranks)


# --------------------------------------------------------------------------- quality

def q_row_counts(spark, sf_dir):
    """Rows loaded and kept by cleaning (one pass over the transactions), and sales rows."""
    raw = tables.transactions(spark, sf_dir)
    transactions = op.counts_where(raw, {"transactions_loaded": F.lit(True), "transactions_clean": op.is_clean(raw)})
    return transactions.unionByName(op.row_counts({"sales": _sales(spark, sf_dir)}))


def q_record_count_gate(spark, sf_dir):
    """Every line item must survive the sales joins: sales rows == lineitem rows."""
    return op.count_gate(_sales(spark, sf_dir), tables.table(spark, sf_dir, "lineitem"), "sales_vs_lineitem").withColumnRenamed(
        "check", "check_name"
    )


def q_json_validity(spark, sf_dir):
    return op.json_line_validity(tables.events_json_lines(spark, sf_dir))


def q_expected_key_diff(spark, sf_dir):
    """Customers without a clean transaction, and the other way round.

    The orders' customers are made distinct in every task before they meet the customer table, so a hot customer is one row a task.
    """
    customers = tables.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    ordering = op.clean_transactions(tables.order_transactions(spark, sf_dir)).select("customer_id").distinct()
    # an inner join: Spark would push a semi-join below the distinct, back onto the raw orders
    actual = ordering.join(tables.customers_with_country(spark, sf_dir).distinct(), "customer_id")
    return op.expected_key_diff(actual, customers, "customer_id")


def q_bounds_check(spark, sf_dir):
    m = tables.measurements(spark, sf_dir)
    return op.bounds_check(
        m,
        {
            "trial_in_range": F.col("trial").between(1, 3),
            "seconds_positive": F.col("seconds") > 0,
            "config_present": F.col("config").isNotNull(),
        },
    )


# --------------------------------------------------------------------------- synthetic data

def q_gen_transactions(spark, sf_dir):
    ids = tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return synth.synth_transactions(ids)


def q_gen_sales(spark, sf_dir):
    ids = tables.table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return synth.synth_sales(ids)


def q_range_double_sum(spark, sf_dir):
    """Map x -> 2x, reduce by +, over the order keys (exact: decimal(38,0) never overflows)."""
    keys = tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("decimal(38,0)").alias("x"))
    return keys.agg(F.sum(F.col("x") * 2).cast("decimal(38,0)").alias("doubled_sum"))


# --------------------------------------------------------------------------- contract

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: revenue by country over the cleaned transactions at sf0.001."""
    use_local_folder(spark)
    return q_country_metrics(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "clean_transactions": q_clean_transactions,
        "to_date_load": q_to_date_load,
        "country_metrics": q_country_metrics,
        "category_trends": q_category_trends,
        "customer_spend": q_customer_spend,
        "top_customers": q_top_customers,
        "csv_roundtrip": q_csv_roundtrip,
        "csv_text_roundtrip": q_csv_text_roundtrip,
        "parquet_roundtrip": q_parquet_roundtrip,
        "json_roundtrip": q_json_roundtrip,
        "clean_cached_country_metrics": q_clean_cached_country_metrics,
        "report_roundtrip_check": q_report_roundtrip_check,
        "category_region_sales": q_category_region_sales,
        "category_metrics": q_category_metrics,
        "region_metrics": q_region_metrics,
        "category_counts": q_category_counts,
        "sales_json_load": q_sales_json_load,
        "partition_sweep": q_partition_sweep,
        "partition_profile": q_partition_profile,
        "reuse_none": _reuse("none"),
        "reuse_cache": _reuse("cache"),
        "reuse_memory_and_disk": _reuse("memory_and_disk"),
        "word_count": q_word_count,
        "expected_counts": q_expected_counts,
        "dealt_word_count": q_dealt_word_count,
        "trial_summary": q_trial_summary,
        "trial_improvement": q_trial_improvement,
        "trial_pivot": q_trial_pivot,
        "trial_best": q_trial_best,
        "trial_ranking": q_trial_ranking,
        "study_table": q_study_table,
        "study_checks": q_study_checks,
        "partition_study_check": q_partition_study_check,
        "reuse_study_check": q_reuse_study_check,
        "row_counts": q_row_counts,
        "record_count_gate": q_record_count_gate,
        "json_validity": q_json_validity,
        "expected_key_diff": q_expected_key_diff,
        "bounds_check": q_bounds_check,
        "gen_transactions": q_gen_transactions,
        "gen_sales": q_gen_sales,
        "range_double_sum": q_range_double_sum,
        **(llm.queries() if llm else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }
    return {name: _entered(query) for name, query in found.items()}


def _entered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query behind an entry point: a single-process run without a shared folder gets one of its own.

    Tables written on the way go when the query returns, but for those its result reads.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_local_folder(spark)
        with Scratch(spark) as scope:
            return scope.keep(query(spark, sf_dir))

    return run


# --------------------------------------------------------------------------- oracle SQL (DuckDB)

_TX = """
tx AS (
  SELECT o.o_orderkey AS transaction_id,
         CAST(o.o_orderdate AS DATE) AS date,
         o.o_custkey AS customer_id,
         CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_orderpriority END AS product_category,
         CASE WHEN o.o_orderkey % 23 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN o.o_orderkey % 19 = 0 THEN -o.o_totalprice
              ELSE o.o_totalprice END AS amount,
         n.n_name AS country
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
clean AS (
  SELECT * FROM tx
  WHERE transaction_id IS NOT NULL AND date IS NOT NULL AND customer_id IS NOT NULL
    AND product_category IS NOT NULL AND amount IS NOT NULL AND country IS NOT NULL
    AND NOT isnan(amount) AND amount > 0
)"""

_SALES = """
sales AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
         p.p_type AS category,
         r.r_name AS region,
         l.l_extendedprice AS amount,
         CAST(trunc(l.l_quantity) AS INTEGER) AS quantity
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

_MEASURE = """
m AS (
  SELECT event_type AS config, CAST(event_id % 3 + 1 AS INTEGER) AS trial, value AS seconds FROM events
),
summary AS (
  SELECT config,
         round(median(seconds), 6) AS median_seconds,
         min(seconds) AS minimum_seconds,
         max(seconds) AS maximum_seconds,
         round(avg(seconds), 6) AS average_seconds,
         count(seconds) AS measurement_count
  FROM m GROUP BY config
)"""

_WORDS = """
wc AS (
  SELECT word, count(*) AS count
  FROM (SELECT trim(lower(tok), '.,:;!?') AS word
        FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS tok FROM documents))
  WHERE word <> ''
  GROUP BY word
)"""

_COUNTRY = """
SELECT country, count(*) AS total_transactions,
       CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_revenue,
       round(CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) / count(amount), 2) AS avg_transaction_value
FROM clean GROUP BY country ORDER BY total_revenue DESC"""

_TRENDS = """
SELECT product_category, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_sales, count(*) AS transaction_count
FROM clean GROUP BY 1, 2, 3 ORDER BY year, month, total_sales DESC"""

_SPEND = """
SELECT customer_id, CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_spent, count(*) AS purchase_count
FROM clean GROUP BY customer_id"""

_TOP = _SPEND + " ORDER BY total_spent DESC, customer_id LIMIT 100"

_CRS = """
SELECT category, region, CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_sales,
       CAST(sum(quantity) AS BIGINT) AS total_quantity, count(*) AS transaction_count
FROM sales GROUP BY category, region"""

_CATEGORY = """
SELECT category, round(CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) / count(amount), 2) AS average_amount, CAST(round(sum(CAST(amount AS DECIMAL(28,6))), 2) AS DOUBLE) AS total_amount,
       count(*) AS transaction_count
FROM sales GROUP BY category"""

_REGION = """
SELECT region, CAST(sum(quantity) AS BIGINT) AS total_quantity, round(CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) / count(amount), 2) AS average_amount,
       count(*) AS transaction_count
FROM sales GROUP BY region"""

_REUSE = f"""
WITH {_SALES.strip()},
it AS (SELECT * FROM (VALUES (1), (2), (3)) v(iteration)),
cat AS ({_CATEGORY}),
reg AS ({_REGION})
SELECT it.iteration, 'category' AS metric_set, category AS key, average_amount, total_amount,
       CAST(NULL AS BIGINT) AS total_quantity, transaction_count
FROM cat CROSS JOIN it
UNION ALL
SELECT it.iteration, 'region' AS metric_set, region AS key, average_amount, CAST(NULL AS DOUBLE) AS total_amount,
       total_quantity, transaction_count
FROM reg CROSS JOIN it"""


def _hash(col: str, place: int, size: int) -> str:
    digits = f"substr(md5('{synth.DEFAULT_SEED}:' || CAST({col} AS VARCHAR)), {place * 6 + 1}, 6)"
    return f"(CAST('0x' || {digits} AS BIGINT) % {size})"


def _pick(col: str, place: int, values: list[str]) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{items}], CAST({_hash(col, place, len(values))} + 1 AS INTEGER))"


def _amount(col: str, place: int) -> str:
    span = synth.MAX_CENTS - synth.MIN_CENTS + 1
    return f"round(({synth.MIN_CENTS} + {_hash(col, place, span)}) / 100.0, 2)"


_GEN_TX = f"""
SELECT CAST(o_orderkey AS BIGINT) AS transaction_id,
       CAST(DATE '2025-01-01' - CAST({_hash('o_orderkey', synth.TRANSACTION_PLACES['date'], synth.DAYS_BACK)} AS INTEGER) AS DATE) AS date,
       CAST({_hash('o_orderkey', synth.TRANSACTION_PLACES['customer'], synth.CUSTOMERS)} + 1 AS BIGINT) AS customer_id,
       {_pick('o_orderkey', synth.TRANSACTION_PLACES['category'], synth.TRANSACTION_CATEGORIES)} AS product_category,
       {_amount('o_orderkey', synth.TRANSACTION_PLACES['amount'])} AS amount,
       {_pick('o_orderkey', synth.TRANSACTION_PLACES['country'], synth.TRANSACTION_COUNTRIES)} AS country
FROM orders"""

_GEN_SALES = f"""
SELECT CAST(id AS BIGINT) AS transaction_id,
       {_pick('id', synth.SALES_PLACES['category'], synth.SALES_CATEGORIES)} AS category,
       {_pick('id', synth.SALES_PLACES['region'], synth.SALES_REGIONS)} AS region,
       {_amount('id', synth.SALES_PLACES['amount'])} AS amount,
       CAST({_hash('id', synth.SALES_PLACES['quantity'], synth.MAX_QUANTITY)} + 1 AS INTEGER) AS quantity
FROM (SELECT l_orderkey * 10 + l_linenumber AS id FROM lineitem)"""


_STUDY = f"""
m AS (
  SELECT event_type AS config, CAST(event_id % 3 + 1 AS INTEGER) AS trial, value AS seconds FROM events
),
t AS (SELECT config, trial, round(sum(seconds), 2) AS seconds FROM m GROUP BY config, trial),
s AS (
  SELECT config, round(median(seconds), 6) AS median_seconds, min(seconds) AS minimum_seconds,
         max(seconds) AS maximum_seconds
  FROM t GROUP BY config
),
p AS (
  SELECT config,
    max(CASE WHEN trial = 1 THEN seconds END) AS trial_1_seconds,
    max(CASE WHEN trial = 2 THEN seconds END) AS trial_2_seconds,
    max(CASE WHEN trial = 3 THEN seconds END) AS trial_3_seconds
  FROM t GROUP BY config
),
b AS (SELECT median_seconds AS base FROM s WHERE config = '{BASELINE_CONFIG}'),
study AS (
  SELECT p.config, p.trial_1_seconds, p.trial_2_seconds, p.trial_3_seconds,
         s.median_seconds, s.minimum_seconds, s.maximum_seconds,
         CASE WHEN s.config = '{BASELINE_CONFIG}' THEN 0.0
              ELSE round((b.base - s.median_seconds) / b.base * 100, 2) END AS improvement_percent
  FROM p JOIN s ON p.config = s.config LEFT JOIN b ON TRUE
)"""

_EXPECTED_CONFIGS = ", ".join(f"('{c}')" for c in EXPECTED_CONFIGS)

_STUDY_CHECKS = f"""WITH {_STUDY.strip()},
e AS (SELECT * FROM (VALUES {_EXPECTED_CONFIGS}) v(config)),
diff AS (
  SELECT config FROM e WHERE config NOT IN (SELECT config FROM study)
  UNION ALL
  SELECT DISTINCT config FROM study WHERE config NOT IN (SELECT config FROM e)
)
SELECT 'configurations_match_expected' AS check_name,
       (SELECT count(*) FROM (SELECT config FROM e UNION SELECT config FROM study)) AS checked_rows,
       (SELECT count(*) FROM diff) AS violations
UNION ALL
SELECT 'row_count_matches_expected', count(*), abs(count(*) - {len(EXPECTED_CONFIGS)}) FROM study
UNION ALL
SELECT 'trials_positive', count(*),
       count(*) FILTER (WHERE NOT coalesce(trial_1_seconds > 0 AND trial_2_seconds > 0 AND trial_3_seconds > 0, false))
FROM study
UNION ALL
SELECT 'median_positive', count(*), count(*) FILTER (WHERE NOT coalesce(median_seconds > 0, false)) FROM study"""


_PARTITION_STUDY_CHECK = f"""
SELECT 'input_lines_valid_json' AS check_name, count(*) AS checked_rows, count(*) FILTER (WHERE NOT json_valid(v)) AS violations
FROM (SELECT CASE WHEN event_id % 10 = 0 THEN '{{"k":' ELSE props END AS v FROM events)
UNION ALL
SELECT 'record_count', count(*), 0 FROM events
UNION ALL
SELECT * FROM ({_STUDY_CHECKS})"""

_REUSE_STUDY_CHECK = f"""
SELECT check_name AS item, checked_rows, violations, CAST(NULL AS INTEGER) AS rank, CAST(NULL AS DOUBLE) AS median_seconds FROM ({_STUDY_CHECKS})
UNION ALL
SELECT 'result_rows_expected', count(DISTINCT event_type), 0, NULL, NULL FROM events
UNION ALL
SELECT config, NULL, NULL, CAST(row_number() OVER (ORDER BY median_seconds, config) AS INTEGER), median_seconds
FROM (WITH {_STUDY.strip()} SELECT * FROM study)"""


def oracle_sql() -> dict[str, str]:
    tx = f"WITH {_TX.strip()}\n"
    sales = f"WITH {_SALES.strip()}\n"
    measure = f"WITH {_MEASURE.strip()}\n"
    return {
        "clean_transactions": tx + "SELECT * FROM clean",
        "to_date_load": tx + "SELECT * FROM clean",
        "country_metrics": tx + _COUNTRY,
        "category_trends": tx + _TRENDS,
        "customer_spend": tx + _SPEND,
        "top_customers": tx + _TOP,
        "csv_roundtrip": tx + _COUNTRY,
        "parquet_roundtrip": tx + _TRENDS,
        "json_roundtrip": tx + _TOP,
        "clean_cached_country_metrics": tx + _COUNTRY,
        "report_roundtrip_check": tx
        + f"SELECT 'country_metrics' AS report, count(*) AS report_rows, CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows FROM ({_COUNTRY})\n"
        f"UNION ALL SELECT 'category_trends', count(*), 0, 0 FROM ({_TRENDS})\n"
        f"UNION ALL SELECT 'top_customers', count(*), 0, 0 FROM ({_TOP})",
        "csv_text_roundtrip": tx + "SELECT country, CAST(count(*) AS VARCHAR) AS total_transactions FROM clean GROUP BY country",
        "partition_profile": sales + "SELECT count(*) AS total_rows, count(*) AS profiled_rows, TRUE AS adds_up FROM sales",
        "category_region_sales": sales + _CRS + " ORDER BY category, region",
        "category_metrics": sales + _CATEGORY + " ORDER BY category",
        "region_metrics": sales + _REGION + " ORDER BY region",
        "category_counts": sales + 'SELECT category, count(*) AS "count" FROM sales GROUP BY category',
        "sales_json_load": sales + _CRS,
        "partition_sweep": sales + f"SELECT c.*, p.partition_count FROM ({_CRS}) c "
        "CROSS JOIN (VALUES (2), (4), (8), (16), (32)) p(partition_count)",
        "reuse_none": _REUSE,
        "reuse_cache": _REUSE,
        "reuse_memory_and_disk": _REUSE,
        "word_count": f"WITH {_WORDS.strip()}\nSELECT * FROM wc ORDER BY word",
        "dealt_word_count": f"WITH {_WORDS.strip()}\nSELECT * FROM wc",
        "expected_counts": f"WITH {_WORDS.strip()},\n"
        "e AS (SELECT * FROM (VALUES ('spark', 2), ('distributed', 2), ('computing', 2)) v(word, expected_count))\n"
        "SELECT e.word, CAST(e.expected_count AS BIGINT) AS expected_count, wc.count AS actual_count\n"
        "FROM e LEFT JOIN wc ON e.word = wc.word WHERE wc.count IS DISTINCT FROM e.expected_count",
        "trial_summary": measure + "SELECT * FROM summary",
        "trial_improvement": measure
        + "SELECT s.config, s.median_seconds,\n"
        f"  CASE WHEN s.config = '{BASELINE_CONFIG}' THEN 0.0\n"
        "       ELSE round((b.base - s.median_seconds) / b.base * 100, 2) END AS improvement_percent\n"
        f"FROM summary s LEFT JOIN (SELECT median_seconds AS base FROM summary WHERE config = '{BASELINE_CONFIG}') b ON TRUE",
        "trial_pivot": measure
        + "SELECT config,\n"
        "  max(CASE WHEN trial = 1 THEN s END) AS trial_1_seconds,\n"
        "  max(CASE WHEN trial = 2 THEN s END) AS trial_2_seconds,\n"
        "  max(CASE WHEN trial = 3 THEN s END) AS trial_3_seconds\n"
        "FROM (SELECT config, trial, round(sum(seconds), 2) AS s FROM m GROUP BY config, trial) GROUP BY config",
        "trial_best": measure + "SELECT * FROM summary ORDER BY median_seconds, config LIMIT 1",
        "trial_ranking": measure
        + "SELECT CAST(row_number() OVER (ORDER BY median_seconds, config) AS INTEGER) AS rank, config, median_seconds\n"
        "FROM summary",
        "study_table": f"WITH {_STUDY.strip()}\nSELECT * FROM study ORDER BY config",
        "study_checks": _STUDY_CHECKS,
        "partition_study_check": _PARTITION_STUDY_CHECK,
        "reuse_study_check": _REUSE_STUDY_CHECK,
        "row_counts": f"WITH {_TX.strip()}, {_SALES.strip()}\n"
        "SELECT 'transactions_loaded' AS stage, count(*) AS rows FROM tx\n"
        "UNION ALL SELECT 'transactions_clean', count(*) FROM clean\n"
        "UNION ALL SELECT 'sales', count(*) FROM sales",
        "record_count_gate": sales
        + "SELECT 'sales_vs_lineitem' AS check_name, a.n AS actual_rows, e.n AS expected_rows, a.n = e.n AS passed\n"
        "FROM (SELECT count(*) AS n FROM sales) a, (SELECT count(*) AS n FROM lineitem) e",
        "json_validity": "SELECT count(*) AS total_lines,\n"
        "  count(*) FILTER (WHERE json_valid(v)) AS valid_lines,\n"
        "  count(*) FILTER (WHERE NOT json_valid(v)) AS invalid_lines\n"
        "FROM (SELECT CASE WHEN event_id % 10 = 0 THEN '{\"k\":' ELSE props END AS v FROM events)",
        "expected_key_diff": tx
        + "SELECT c.c_custkey AS customer_id, 'missing' AS status FROM customer c\n"
        "WHERE NOT EXISTS (SELECT 1 FROM clean t WHERE t.customer_id = c.c_custkey)\n"
        "UNION ALL\n"
        "SELECT DISTINCT t.customer_id, 'unexpected' AS status FROM clean t\n"
        "WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = t.customer_id)",
        "bounds_check": measure
        + "SELECT 'trial_in_range' AS rule, count(*) AS checked_rows,\n"
        "       count(*) FILTER (WHERE NOT coalesce(trial BETWEEN 1 AND 3, false)) AS violations FROM m\n"
        "UNION ALL SELECT 'seconds_positive', count(*), count(*) FILTER (WHERE NOT coalesce(seconds > 0, false)) FROM m\n"
        "UNION ALL SELECT 'config_present', count(*), count(*) FILTER (WHERE config IS NULL) FROM m",
        "gen_transactions": _GEN_TX,
        "gen_sales": _GEN_SALES,
        "range_double_sum": "SELECT CAST(sum(CAST(o_orderkey AS DECIMAL(38,0)) * 2) AS DECIMAL(38,0)) AS doubled_sum FROM orders",
        **(llm.oracle_sql() if llm else {}),
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}),
    }
