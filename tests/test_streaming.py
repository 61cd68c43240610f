from quarry import operators as op
from quarry.sources import schemas, synth
from quarry.sources.files import write_csv, write_json
from quarry.streaming import stream_csv, stream_json_lines, write_snapshots
from tests.conftest import rows


def test_streamed_sales_totals_equal_batch(spark, out_dir):
    sales = synth.generate_sales(spark, 3000, partitions=4)
    write_json(sales, f"{out_dir}/in")
    stream = stream_json_lines(spark, f"{out_dir}/in", schemas.SALES, max_files_per_trigger=1)
    query = write_snapshots(op.category_region_sales(stream, sort=False), f"{out_dir}/out", f"{out_dir}/ckpt")
    query.awaitTermination(120)
    assert rows(spark.read.parquet(f"{out_dir}/out")) == rows(op.category_region_sales(sales, sort=False))


def test_streamed_transactions_country_metrics_equal_batch(spark, out_dir):
    tx = synth.generate_transactions(spark, 2000, partitions=3)
    write_csv(tx, f"{out_dir}/tx")
    stream = op.clean_transactions(stream_csv(spark, f"{out_dir}/tx", schemas.TRANSACTIONS))
    query = write_snapshots(op.country_metrics(stream, sort=False), f"{out_dir}/cm", f"{out_dir}/ckpt2")
    query.awaitTermination(120)
    assert rows(spark.read.parquet(f"{out_dir}/cm")) == rows(op.country_metrics(op.clean_transactions(tx), sort=False))
