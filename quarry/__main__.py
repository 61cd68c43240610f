"""Command line: ``python -m quarry <command> ...`` (or ``spark-submit -m``-style via a wrapper).

Commands
--------
generate-transactions  synthetic transactions -> CSV with header
generate-sales         synthetic sales lines -> JSON lines
reports                clean CSV transactions -> country CSV, trends Parquet, top-customers JSON
verify-reports         read the three reports back: counts and samples
partition-study        time category x region totals per partition count -> study CSV
reuse-study            time the repeated workload per reuse strategy -> study CSV
verify-partition-study check a study CSV and its input: JSON lines, record count, configurations, bounds
verify-reuse-study     check a study CSV: configurations, bounds, result rows; rank its strategies
wordcount              count words of text files, check expected counts
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from quarry.operators.layout import PARTITION_COUNTS
from quarry.sources.synth import DEFAULT_SEED


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m quarry")
    sub = p.add_subparsers(dest="command", required=True)

    g = sub.add_parser("generate-transactions")
    g.add_argument("--records", type=int, default=5_000_000)  # fixed value
    g.add_argument("--output", required=True)
    g.add_argument("--anchor", type=dt.date.fromisoformat, default=dt.date(2025, 1, 1))
    g.add_argument("--partitions", type=int, default=None)
    g.add_argument("--seed", type=int, default=DEFAULT_SEED)

    g = sub.add_parser("generate-sales")
    g.add_argument("--records", type=int, default=1_000_000)  # fixed value
    g.add_argument("--output", required=True)
    g.add_argument("--partitions", type=int, default=None)
    g.add_argument("--seed", type=int, default=DEFAULT_SEED)

    r = sub.add_parser("reports")
    r.add_argument("--input", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--reuse", choices=["none", "cache", "memory_and_disk"], default="none")
    r.add_argument("--repartition-on", default=None)
    r.add_argument("--top", type=int, default=100)
    r.add_argument("--expected-loaded", type=int, default=None, help="fail unless the input has this many records")
    r.add_argument("--expected-clean", type=int, default=None, help="fail unless this many records stay after cleaning")

    v = sub.add_parser("verify-reports")
    v.add_argument("--output", required=True)

    s = sub.add_parser("partition-study")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--partitions", type=int, nargs="+", default=list(PARTITION_COUNTS))
    s.add_argument("--trials", type=int, default=3)
    s.add_argument("--move", choices=["partials", "rows"], default="partials")
    s.add_argument("--expected-records", type=int, default=None, help="fail unless the input has this many records")

    c = sub.add_parser("reuse-study")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--trials", type=int, default=3)
    c.add_argument("--iterations", type=int, default=3)
    c.add_argument("--expected-records", type=int, default=None, help="fail unless the input has this many records")

    vp = sub.add_parser("verify-partition-study")
    vp.add_argument("--input", required=True)
    vp.add_argument("--study", required=True)
    vp.add_argument("--expected-records", type=int, default=1_000_000)  # fixed value
    vp.add_argument("--partitions", type=int, nargs="+", default=list(PARTITION_COUNTS))

    vr = sub.add_parser("verify-reuse-study")
    vr.add_argument("--study", required=True)
    vr.add_argument("--iterations", type=int, default=3)
    vr.add_argument("--groups", type=int, default=10, help="result rows of one iteration")  # fixed value: 5 categories and 5 regions

    w = sub.add_parser("wordcount")
    w.add_argument("--input", required=True)
    w.add_argument("--output", default=None)
    w.add_argument("--expect", type=_expectation, nargs="*", default=None, help="word=count, checked after counting")
    return p


def _expectation(text: str) -> tuple[str, int]:
    word, _, count = text.rpartition("=")
    return word, int(count)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)

    from quarry.operators.measure import trial_best
    from quarry.plans import jobs
    from quarry.plans.storage import scratch_path, use_local_folder
    from quarry.session import build_session, size_for_input
    from quarry.sources import schemas, synth
    from quarry.sources.files import read_csv, read_json_lines, read_text_lines, write_csv, write_json

    spark = build_session(app_name=f"quarry-{args.command}")
    use_local_folder(spark)
    if getattr(args, "input", None):
        # Shuffle partitions and split size follow the input's size.
        size_for_input(spark, args.input)
    if args.command == "generate-transactions":
        write_csv(synth.generate_transactions(spark, args.records, args.anchor, args.partitions, args.seed), args.output)
    elif args.command == "generate-sales":
        write_json(synth.generate_sales(spark, args.records, args.partitions, args.seed), args.output)
    elif args.command == "reports":
        raw = read_csv(spark, args.input, schemas.TRANSACTIONS_TEXT_DATE).withColumn("date", F.try_to_date("date"))
        run = jobs.run_reports(raw, args.output, args.reuse, args.repartition_on, args.top, args.expected_loaded, args.expected_clean)
        print(f"records loaded: {run.loaded_rows:,}; after cleaning: {run.clean_rows:,}")
        print(run)
    elif args.command == "verify-reports":
        run = jobs.ReportRun(*(f"{args.output}/{n}" for n in ("country_metrics", "category_trends", "top_customers")))
        for name, df in jobs.read_reports(spark, run).items():
            print(f"===== {name}: {df.count()} rows")
            df.show(5, False)
    elif args.command == "partition-study":
        sales = read_json_lines(spark, args.input, schemas.SALES)
        measured = jobs.partition_study(sales, args.partitions, args.trials, args.move, args.expected_records)
        table = jobs.study_table(measured, trials=range(1, args.trials + 1))
        write_csv(table, args.output, single_file=True)
        table.show(truncate=False)
        print(f"best partition count: {trial_best(table).first()['config']}")
    elif args.command == "reuse-study":
        load = lambda: read_json_lines(spark, args.input, schemas.SALES)
        measured = jobs.reuse_study(load, scratch_path(spark, "reuse-study"), trials=args.trials, iterations=args.iterations, expected_records=args.expected_records)
        table = jobs.study_table(measured, baseline="none", trials=range(1, args.trials + 1))
        write_csv(table, args.output, single_file=True)
        table.show(truncate=False)
        print(f"best strategy: {trial_best(table).first()['config']}")
    elif args.command in ("verify-partition-study", "verify-reuse-study"):
        study = read_csv(spark, args.study, infer_schema=True).withColumn("config", F.col("config").cast("string"))
        if args.command == "verify-partition-study":
            dataset = read_json_lines(spark, args.input, schemas.SALES)
            checks = jobs.verify_partition_study(read_text_lines(spark, args.input), dataset, study, args.expected_records, args.partitions)
            dataset.show(5, truncate=False)
        else:
            checks, ranking = jobs.verify_reuse_study(study, args.iterations, args.groups)
            ranking.orderBy("rank").show(truncate=False)
        checks.show(truncate=False)
        if checks.where("violations > 0").count():
            return 1
    elif args.command == "wordcount":
        lines = read_text_lines(spark, args.input).withColumnRenamed("value", "text")
        expected = spark.createDataFrame(args.expect or [], "word string, expected_count bigint")
        counts, failures = jobs.word_count_job(lines, expected)
        if args.output:
            write_csv(counts, args.output)
        else:
            for row in counts.toLocalIterator():
                print(f"{row['word']}: {row['count']}")
        if args.expect and failures.limit(1).count():
            failures.show(truncate=False)
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
