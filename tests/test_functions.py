"""Scalar expressions and record shapes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from encore import functions as fx
from encore.streaming.carried import Carried
from encore.streaming.sources import kafka_records, numbered


def test_money_sum_is_exact(spark):
    # 0.1 + 0.2 style drift does not appear, and prices are not rounded one by one.
    df = spark.createDataFrame([(0.1,), (0.2,), (19.99,), (1234567.89,)] * 25, "p double")
    got = df.agg(fx.money_sum("p").alias("s")).collect()[0]["s"]
    assert got == round((0.1 + 0.2 + 19.99 + 1234567.89) * 25, 2)
    thirds = spark.createDataFrame([(0.004,), (0.004,), (0.004,)], "p double")
    assert thirds.agg(fx.money_sum("p")).first()[0] == 0.01


def test_truncation_like_java(spark):
    df = spark.createDataFrame([(99.9,), (-99.9,), (0.5,)], "p double")
    assert [r[0] for r in df.select(F.col("p").cast("bigint")).collect()] == [99, -99, 0]


def test_format_address_nulls_render_empty(spark):
    df = spark.createDataFrame([("1 A St", None, "Town", "ST", "00001", None, "USA")],
                               "line1 string, line2 string, citynm string, state string, zip5 string, "
                               "zip4 string, countrycd string")
    assert df.select(fx.format_address()).collect()[0][0] == "1 A St, , Town, ST 00001- USA"


def test_born_between_and_event_time(spark):
    df = spark.createDataFrame([("1990-01-01",), ("1999-12-31",), ("2000-01-01",), ("1989-12-31",), ("garbage",),
                                (None,)], "d string")
    assert [r[0] for r in df.select(fx.born_between("d", "1990-01-01", "1999-12-31")).collect()] == \
        [True, True, False, False, False, False]
    ev = spark.createDataFrame([("2024-01-01 10:00:00.123",), ("today",)], "e string")
    got = [r[0] for r in ev.select(fx.parse_event_time("e")).collect()]
    assert got[0] is not None and got[1] is None


def test_stable_id_deterministic(spark):
    df = spark.createDataFrame([("t1", "e1", 1), ("t1", "e1", 2)], "t string, e string, n long")
    a = [r[0] for r in df.select(fx.stable_id("t", "e", "n")).collect()]
    b = [r[0] for r in df.select(fx.stable_id("t", "e", "n")).collect()]
    assert a == b and a[0] != a[1] and len(a[0]) == 64


def test_remaining_percentage_and_notice(spark):
    df = spark.createDataFrame([(4.0, 5, "c1", "id1", "e1", "CONFIRMED"), (-1.0, 5, "c2", "id2", "e1", "REJECTED")],
                               "r double, cap int, customerid string, confirmationId string, eventid string, "
                               "confirmationStatus string")
    out = df.select(fx.remaining_percentage("r", "cap").alias("pct"), fx.notice_recipient("customerid").alias("to"),
                    fx.notice_subject("confirmationId", "eventid").alias("subj"),
                    fx.notice_body("confirmationStatus").alias("body")).collect()
    assert out[0]["pct"] == 80.0 and out[1]["pct"] == 0.0
    assert out[0]["to"] == "c1@email.com"
    assert out[0]["subj"] == "Ticket Confirmation (id1) - Event e1"
    assert out[1]["body"] == "Your ticket has been REJECTED!"


def test_kafka_records(spark):
    """Positions follow time, partition and offset; a record without a value deletes its key."""
    value = json.dumps({"id": "t1", "customerid": "c1", "eventid": "e1", "price": 12.5})
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 1)
    raw = spark.createDataFrame([(b"t1", value.encode(), t0, 2, 41), (b"t2", value.encode(), t0, 2, 42), (b"t1", None, t1, 0, 7)],
                                "key binary, value binary, timestamp timestamp, partition int, offset bigint")
    rows = kafka_records(raw, "ticket").orderBy("pos").collect()
    assert [(r["key"], r["eventid"], r["price"], r["deleted"]) for r in rows] == [("t1", "e1", 12.5, False), ("t2", "e1", 12.5, False), ("t1", None, None, True)]
    assert rows[2]["id"] == "t1" and len({r["pos"] for r in rows}) == 3


def test_kafka_records_are_numbered_over_many_partitions(spark, tmp_path):
    """A thousand partitions with offsets far apart in one millisecond: numbers follow time, partition and offset, and
    go on in the next batch."""
    value, t0 = json.dumps({"id": "x"}).encode(), dt.datetime(2024, 1, 1)
    records = lambda at, offsets: kafka_records(spark.createDataFrame(
        [(str(p * 10 + i).encode(), value, at, p, o) for p in range(0, 1000, 7) for i, o in enumerate(offsets)],
        "key binary, value binary, timestamp timestamp, partition int, offset bigint"), "ticket").drop("id")
    first = 0
    for b, (at, offsets) in enumerate([(t0, (5, 5 + (1 << 14), 1 << 40)), (t0 + dt.timedelta(milliseconds=1), (6,))]):
        scan = Carried(str(tmp_path), b)
        got = numbered(lambda rows, _: rows)(records(at, offsets), scan).orderBy("pos").collect()
        scan.commit(spark)
        want = [str(p * 10 + i) for p in range(0, 1000, 7) for i in range(len(offsets))]
        assert [r["pos"] for r in got] == list(range(first + 1, first + len(want) + 1)) and [r["key"] for r in got] == want
        first += len(want)


def test_no_machine_local_checkpoints_on_a_cluster():
    import types

    from encore.session import checkpoint_dir
    unset = types.SimpleNamespace(get=lambda *_: None)
    context = types.SimpleNamespace(master="spark://host:7077", getConf=lambda: unset)
    with pytest.raises(ValueError):
        checkpoint_dir(types.SimpleNamespace(conf=unset, sparkContext=context))


def test_package_shipped_to_workers(spark):
    """The session setup ships the package to the Python workers, so keyed
    state functions import it wherever the driver was started from."""
    from encore.session import ship_package

    ship_package(spark)
    assert any(f.endswith("encore.zip") for f in spark.sparkContext.listFiles)
