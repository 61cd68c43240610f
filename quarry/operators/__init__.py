"""DataFrame -> DataFrame operators."""

from quarry.operators.clean import clean_transactions, drop_incomplete, is_clean, is_complete, keep_positive
from quarry.operators.layout import (
    PARTITION_COUNTS,
    STRATEGIES,
    ReuseRun,
    partition_count,
    partition_profile,
    partition_sweep,
    persist_with,
    repartition_by,
    repartition_evenly,
    run_reuse_workload,
    workload_results,
)
from quarry.operators.measure import (
    trial_best,
    trial_improvement,
    trial_pivot,
    trial_ranking,
    trial_summary,
    trial_totals,
)
from quarry.operators.quality import (
    CountingPass,
    assert_passed,
    bounds_check,
    count_gate,
    counts_where,
    expected_counts_check,
    expected_key_diff,
    json_line_validity,
    locate_differences,
    roundtrip_diff,
    row_counts,
)
from quarry.operators.reports import category_trends, country_metrics, customer_spend, highest_spend, top_customers
from quarry.operators.sales import category_counts, category_metrics, category_region_sales, region_metrics
from quarry.operators.text import word_count, words

__all__ = [
    "CountingPass",
    "PARTITION_COUNTS",
    "STRATEGIES",
    "ReuseRun",
    "assert_passed",
    "bounds_check",
    "category_counts",
    "category_metrics",
    "category_region_sales",
    "category_trends",
    "clean_transactions",
    "count_gate",
    "counts_where",
    "country_metrics",
    "customer_spend",
    "drop_incomplete",
    "is_clean",
    "is_complete",
    "expected_counts_check",
    "expected_key_diff",
    "highest_spend",
    "json_line_validity",
    "keep_positive",
    "locate_differences",
    "partition_count",
    "partition_profile",
    "partition_sweep",
    "persist_with",
    "region_metrics",
    "repartition_by",
    "repartition_evenly",
    "roundtrip_diff",
    "row_counts",
    "run_reuse_workload",
    "top_customers",
    "trial_best",
    "trial_improvement",
    "trial_pivot",
    "trial_ranking",
    "trial_summary",
    "trial_totals",
    "word_count",
    "words",
    "workload_results",
]
