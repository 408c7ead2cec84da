"""Plans at any size: cells, salts and one pass over the input, on the sf0.01 tables."""

import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.operators.running import DAY, Spec, hot_keys, in_cells, prefix_scan
from encore.plans import jobs as J
from encore.sources import domain
from encore.streaming.carried import whole_table

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


def test_cells_do_not_change_results(spark):
    _same(J.confirm_tickets(J._tickets_with_event(spark, SF), whole_table(DAY // 2)),
          J.confirm_tickets(J._tickets_with_event(spark, SF), whole_table(400 * DAY)))
    l = domain.listen(spark, SF)
    _same(J.customer_stream_count_changelog_from(l, whole_table(97)), J.customer_stream_count_changelog_from(l, whole_table(1 << 40)))


def test_salted_top_k(spark):
    l = domain.listen(spark, SF)
    _same(J.top_customer_artists_from(l, salt_buckets=1), J.top_customer_artists_from(l, salt_buckets=13))


def test_hot_key_is_spread_over_cells(spark):
    """One customer with a third of the listens: a (key, cell) has at most a cell's share of them."""
    hot = domain.listen(spark, SF).withColumn("customerid", F.when(F.col("pos") % 3 == 0, F.lit(-1)).otherwise(F.col("customerid")))
    w = Window.partitionBy("customerid").orderBy("pos")
    _same(prefix_scan(hot, ["customerid"], [F.col("pos")], "pos", [Spec("n", "count")], cell=500),
          hot.where("customerid is not null").withColumn("n", F.row_number().over(w).cast("bigint")))
    cells = in_cells(hot, ["customerid"], "pos", 500).groupBy("customerid", "__cell").count()
    assert cells.agg(F.max("count")).first()[0] <= 500


def test_one_pass_over_the_input(spark):
    """The window and the totals read one shuffle, so the large table is scanned, sorted and windowed once."""
    df = J.customer_stream_count_changelog(spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final
    scans = re.findall(r"FileScan parquet \[[^\]]*(?:l_orderkey|event_id)", final)
    assert len(scans) == 1


def test_one_shuffle_where_some_keys_are_hot(spark):
    """Also with cells for the hot keys alone, the window and the totals read one shuffle of the rows."""
    rows = domain.listen(spark, SF).select(F.when(F.col("pos") % 3 == 0, F.lit(-1)).otherwise(F.col("customerid")).alias("customerid"), "pos")
    df = prefix_scan(rows, ["customerid"], [F.col("pos")], "pos", [Spec("n", "count")], cell=500, hot=hot_keys(rows, ["customerid"], 1000))
    w = Window.partitionBy("customerid").orderBy("pos")
    _same(df, rows.where("customerid is not null").withColumn("n", F.row_number().over(w).cast("bigint")))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert final.count("REPARTITION_BY_COL") == 2 and "ReusedExchange" in final


def test_no_job_runs_while_a_plan_is_built(spark):
    queries = (J.purchase_event_ticket, J.revenue_leader_changelog, J.thank_you_top_streamer_changelog, J.late_stream_counts)
    for query in queries:  # a table's schema is read from its footers once
        query(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building plans")
    try:
        for query in queries:
            query(spark, SF)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
