"""quarry: transaction reports, sales studies and text counts as Spark DataFrame jobs.

Every operator takes DataFrames and returns a DataFrame built from Spark's
built-in expressions, so Catalyst sees the whole plan: filters reach the scan,
aggregations run partial + final, and nothing is computed on the driver.

Subpackages
-----------
sources    explicit schemas, file sources and sinks, adapters over the driver's
           tables, partition-independent synthetic data
functions  column expressions (word normalisation, safe dates, money rounding,
           deterministic hashing)
operators  cleaning, reports, sales aggregates, word count, layout and reuse,
           measurement statistics, data-quality checks
plans      plan-level building blocks (size-checked broadcast, distributed
           rank and exact median, shared-folder checkpoints) and composite jobs
streaming  the same operators over Structured Streaming sources
"""

__version__ = "0.1.0"
