import contextlib
import io

from pyspark.sql import Window
from pyspark.sql import functions as F

from bourse import schemas
from bourse.plans import bounded_broadcast
from bourse.plans.skew import ranked_within_groups, salted_join
from bourse.session import scratch_path
from bourse.sources import kafka_options, read_wire_orders
from bourse.streaming.jobs import expand_copies, run_matcher
from bourse.streaming.registered import _end_of_stream, _stream
from bourse.streaming.sinks import start
from tests.helpers import frame, order


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_salted_join_equals_plain_join(spark):
    big = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id"))
    small = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (2, "d")], "k long, v string")
    plain = sorted(big.join(small, ["k"]).collect())
    salted = sorted(salted_join(big, small, ["k"], F.col("id"), rows_per_task=100).select("k", "id", "v").collect())
    assert plain == salted


def test_ranked_within_groups_equals_window(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id").alias("x"), (F.col("id") % 7).alias("m"))
    w = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = sorted(
        (r.g, r.x, r.run_sum, r.group_sum)
        for r in df.select("g", "x", F.sum("m").over(w).alias("run_sum"), F.sum("m").over(Window.partitionBy("g")).alias("group_sum")).collect()
    )
    got = sorted((r.g, r.x, r.run_sum, r.group_sum) for r in ranked_within_groups(df, ["g"], [F.col("x")], "m", 7).collect())
    assert got == want


def test_expand_copies_small_and_big_counts(spark):
    df = spark.createDataFrame([("a", 2), ("b", 10), ("c", 7)], "k string, copies long")
    got = expand_copies(df, "copies", chunk=3).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {"a": 2, "b": 10, "c": 7}


def test_bounded_broadcast_checks_size(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(100).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in _plan(left.join(bounded_broadcast(small, max_rows=10), "k"))
        assert "BroadcastHashJoin" not in _plan(left.join(bounded_broadcast(small, max_rows=9), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kafka_options_prefix():
    o = kafka_options("h:9092", "SASL_SSL", "PLAIN", "u", "p", **{"max.poll.interval.ms": 60000})
    assert o["kafka.bootstrap.servers"] == "h:9092"
    assert o["kafka.max.poll.interval.ms"] == "60000"
    assert 'username="u"' in o["kafka.sasl.jaas.config"]


def test_memory_sink(spark):
    base = scratch_path(spark, "t-mem")
    frame(spark, [order("b1", "Buy", 10, 5)]).write.parquet(f"{base}/in/s000")
    q = start(_stream(spark, base, schemas.ORDER), "memory", checkpoint=f"{base}/ckpt", query_name="t_mem_orders",
              trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.table("t_mem_orders").count() == 1


def test_feedback_loop_writes_reorders(spark):
    base = scratch_path(spark, "t-loop")
    orders = [order("b1", "Buy", 10, 5, 0), order("s1", "Sell", 8, 3, 10)]
    df = frame(spark, orders)
    df.write.parquet(f"{base}/in/s000")
    _end_of_stream(spark, base, df)
    q = run_matcher(_stream(spark, base, schemas.ORDER), out_dir=f"{base}/out", checkpoint=f"{base}/ckpt",
                    window="1 hour", slide="1 hour", reorder_dir=f"{base}/reorders", trigger={"availableNow": True})
    q.awaitTermination()
    re = read_wire_orders(spark, f"{base}/reorders/*").collect()
    assert [(r.order_id, r.volume, r.buy_sell) for r in re] == [("b1", 2, "Buy")]
    # re-entered at the window end, first arrival kept
    assert re[0].order_time.hour == 23 and re[0].initial_order_time.minute == 0


def test_scale_conf_sizes_partitions():
    from bourse.session import scale_conf

    c = scale_conf(100 << 40, streaming=True)  # 100 TB
    assert int(c["spark.sql.shuffle.partitions"]) == 2 * (100 << 40) // (256 << 20)
    assert c["spark.sql.session.timeZone"] == "UTC" and "RocksDB" in c["spark.sql.streaming.stateStore.providerClass"]
    assert int(scale_conf(1 << 20)["spark.sql.shuffle.partitions"]) == 200


def test_console_sink_runs(spark):
    base = scratch_path(spark, "t-console")
    frame(spark, [order("b1", "Buy", 10, 5)]).write.parquet(f"{base}/in/s000")
    q = start(_stream(spark, base, schemas.ORDER).select("order_id", "volume"), "console",
              checkpoint=f"{base}/ckpt", trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None and sum(p["numInputRows"] for p in q.recentProgress) == 1


def test_salted_left_join_keeps_unmatched_rows(spark):
    big = spark.range(1000).select((F.col("id") % 4).alias("k"), F.col("id"))  # key 3 has no match
    small = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, v string")
    plain = sorted(big.join(small, ["k"], "left").collect())
    salted = sorted(
        salted_join(big, small, ["k"], F.col("id"), how="left", rows_per_task=50).select("k", "id", "v").collect()
    )
    assert plain == salted and sum(1 for r in salted if r.v is None) == 250
