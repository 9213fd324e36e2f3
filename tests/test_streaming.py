"""The summary from two arriving files equals the batch summary, also when a batch repeats."""

from tillwise.plans.star import daily_summary
from tillwise.sources.tpch_shop import open_shop
from tillwise.streaming import daily_summary as stream
from compare import differences


def test_stream_equals_batch(spark, tmp_path):
    orders = open_shop(spark, "/root/testdata/sf0.001").fact_order
    a, b = orders.where("order_id % 2 = 0"), orders.where("order_id % 2 = 1")
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    for part in (a, b):
        part.write.mode("append").parquet(src)
        stream.start(spark, src, orders.schema, out, check).awaitTermination()
    got, want = stream.summary(spark, out), daily_summary(orders)
    assert differences(got.columns, got.collect(), want.columns, want.collect()) is None
