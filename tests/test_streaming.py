"""Streaming forms on file sources, over several micro-batches, against the batch forms and their definitions."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from rows import at
from encore.operators.running import Spec
from encore.plans import jobs as J
from encore.plans import streams as ST
from encore.streaming import carried, jobs as SJ, sinks
from encore.streaming.lookups import Published, refreshing
from encore.streaming.sources import entity_stream

SF = "/root/testdata/sf0.001"


def _write(folder, batches):
    """One JSON-lines file per batch; with maxFilesPerTrigger=1, one micro-batch each, in order of time."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return folder


def _listens(rows, start=0):
    return [{"id": str(start + i), "customerid": c, "artistid": a, "streamtime": f"2024-01-01 00:00:{(start + i) % 60:02d}", "pos": start + i}
            for i, (c, a) in enumerate(rows)]


def _through(df, fn, tmp_path, mode="append"):
    name = "t_" + uuid.uuid4().hex[:10]
    q = sinks.start_batches(df, name, fn, mode=mode, trigger={"availableNow": True}, checkpoint=str(tmp_path / f"ckpt-{name}"))
    q.awaitTermination()
    assert q.exception() is None


def _same(a, b):
    cols = sorted(b.columns)
    assert sorted(a.columns) == cols
    assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


@pytest.mark.parametrize("name", ["stream_customer_stream_count_changelog", "stream_purchase_event_ticket",
                                  "stream_customer_conversion_tally_changelog", "stream_artist_revenue_leader_changelog",
                                  "stream_purchase_event_ticket_asof"])
def test_changelogs_over_micro_batches(spark, name):
    from encore.plans import registry
    fn, batch = ST.QUERIES[name]
    _same(fn(spark, SF), registry.queries()[batch](spark, SF))


def _tickets(rows, spark):
    return [spark.createDataFrame([(f"#{i}", "fan", event, float(price), at(i)) for i, event, price in part],
                                  "id string, customerid string, eventid string, price double, arrival timestamp") for part in rows]


def test_leader_survives_a_batch_of_unknown_artists(spark, tmp_path):
    events = spark.createDataFrame([("e1", "A", 9), ("e2", "B", 9), ("e3", "ghost", 9)], "id string, artistid string, capacity int")
    artists = spark.createDataFrame([("A", "Ada", "x"), ("B", "Bob", "y")], "id string, name string, genre string")
    fn = carried.in_batches(str(tmp_path / "p4"), SJ.revenue_leader(events, artists))
    for b, rows in enumerate(_tickets([[(0, "e1", 100)], [(1, "e3", 999), (2, "none", 5)], [(3, "e2", 10)], [(4, "e2", 90)], [(5, "e2", 1)]], spark)):
        fn(rows, b)
    out = spark.read.parquet(str(tmp_path / "p4/out")).orderBy("arrival").collect()
    # B draws level with A in batch 3, which A survives, and passes in batch 4.
    assert [(r["artistId"], r["revenue"]) for r in out] == [("A", 100), ("A", 100), ("A", 100), ("B", 101)]


def test_capacity_is_fixed_by_the_first_batch(spark, tmp_path):
    answers = []
    for b, (capacity, rows) in enumerate(zip((2, 5, None), _tickets([[(0, "e", 1), (1, "e", 1)], [(2, "e", 1)], [(3, "e", 1)]], spark))):
        events = spark.createDataFrame([("e", "A", capacity)], "id string, artistid string, capacity int")
        carried.in_batches(str(tmp_path / "p2"), SJ.purchase_event_ticket(events))(rows, b)
    answers = spark.read.parquet(str(tmp_path / "p2/out")).orderBy("request_no").collect()
    assert [(r["ticket_id"], r["remainingTickets"], r["confirmationStatus"]) for r in answers] == [
        ("#0", 1.0, "CONFIRMED"), ("#1", 0.0, "CONFIRMED"), ("#2", -1.0, "REJECTED")]


def test_replayed_batch_and_compaction(spark, tmp_path, monkeypatch):
    """Totals are added up every other batch, what no replay needs is deleted, and a batch can be run twice."""
    monkeypatch.setattr(carried, "COMPACT_EVERY", 2)
    path = str(tmp_path / "p8")
    for b in (0, 1, 2, 3, 3, 4, 5, 5, 6):
        rows = spark.createDataFrame([(c, str(b), at(b), b * 10 + i) for i, c in enumerate("uuv")], "customerid string, id string, streamtime timestamp, pos bigint")
        carried.in_batches(path, SJ.customer_stream_count_changelog)(rows, b)
    out = spark.read.parquet(f"{path}/out")
    assert out.count() == 21 and out.groupBy("customerid").agg(F.max("n")).orderBy("customerid").collect() == [("u", 14), ("v", 7)]
    assert carried.batch_ids(spark, f"{path}/state/listens/base") == [3, 5]
    assert carried.batch_ids(spark, f"{path}/state/listens/steps") == [4, 5, 6]


def test_unreadable_state_is_an_error(spark, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "batch_id=0").mkdir()
    (tmp_path / "state" / "batch_id=0" / "part-0.parquet").write_text("not parquet")
    assert carried.batch_ids(spark, str(tmp_path / "nothing")) == []
    with pytest.raises(Exception):
        SJ._latest_version(spark, str(tmp_path / "state"), 1).count()


def _plays(spark, rows):
    return spark.createDataFrame([(c, str(p), at(p), p) for c, p in rows], "customerid string, id string, streamtime timestamp, pos bigint")


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    """Sixty customers fill many buckets; a batch with one of them reads one, and its count goes on from there."""
    path = str(tmp_path / "p8")
    carried.in_batches(path, SJ.customer_stream_count_changelog)(_plays(spark, [(f"c{i}", i) for i in range(60)]), 0)
    scan = carried.Carried(f"{path}/state", 1)
    out = SJ.customer_stream_count_changelog(_plays(spark, [("c7", 100), ("c7", 101)]), scan)
    assert sorted(r["n"] for r in out.collect()) == [2, 3]
    assert len(scan.read["listens"]) == 1 < len(carried._buckets(spark, f"{path}/state/listens/steps/batch_id=0"))
    files = [f for f in out.inputFiles() if "/steps/" in f or "/base/" in f]
    assert files and all(f"bucket={scan.read['listens'][0]}/" in f and "batch_id=0" in f for f in files)


def test_quiet_keys_move_once_and_hot_ones_in_cells(spark, tmp_path, monkeypatch):
    """Without hot keys a batch's rows are in one shuffle, joined to the earlier totals where they are; with hot ones
    the counts are the same."""
    rows = [[(c, b * 1000 + i) for i, c in enumerate(["busy", f"c{b}", "busy", "quiet", "busy", "busy"] * 9)] for b in range(3)]
    got = {}
    for limit in (1 << 20, 20):
        monkeypatch.setattr(carried, "HOT_ROWS", limit)
        path = str(tmp_path / f"p8-{limit}")
        for b, batch in enumerate(rows):
            scan = carried.Carried(f"{path}/state", b, cell=16)
            _, hot = scan.spread(_plays(spark, batch), "listens", ["customerid"])
            assert (hot is None) == (limit > 20) and (hot is None or [r["customerid"] for r in hot.collect()] == ["busy"])
            out = SJ.customer_stream_count_changelog(_plays(spark, batch), scan)
            if hot is None:
                out.collect()
                plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
                assert "__cell" not in plan and plan.count("REPARTITION_BY_COL") == 1
            sinks.write_batch(out, f"{path}/out", b)
            scan.commit(spark)
        got[limit] = sorted((r["customerid"], r["listen_id"], r["n"]) for r in spark.read.parquet(f"{path}/out").collect())
    seen, want = {}, []
    for c, p in (x for batch in rows for x in batch):
        seen[c] = seen.get(c, 0) + 1
        want.append((c, str(p), seen[c]))
    assert got[20] == got[1 << 20] == sorted(want)


def test_equal_totals_are_stored_once(spark, tmp_path):
    """The values before and after a row have one total; rows without a value are not counted for it."""
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 3, None)], "k string, pos bigint, v string")
    value, scan = F.col("v"), carried.Carried(str(tmp_path), 0)
    scan("x", rows, ["k"], [F.col("pos")], "pos", [Spec("old", "last", value, before=True), Spec("new", "last", value)])
    steps = spark.read.parquet(str(tmp_path / "x/steps/batch_id=0"))
    assert steps.columns == ["k", "t_old", "bucket"] and [r["k"] for r in steps.collect()] == ["a"]
    again = carried.Carried(str(tmp_path), 1)
    later = spark.createDataFrame([("a", 4, None), ("b", 5, "y")], "k string, pos bigint, v string")
    out = again("x", later, ["k"], [F.col("pos")], "pos", [Spec("old", "last", value, before=True), Spec("new", "last", value)])
    assert sorted((r["k"], r["old"], r["new"]) for r in out.collect()) == [("a", "x", "x"), ("b", None, "y")]


def test_stretches_are_written_once(spark, tmp_path):
    """A stretch goes from the staged table into the source as it is, and all of them are counted."""
    rows = _plays(spark, [("u", i) for i in range(30)])
    out = ST.stream_in_batches(spark, str(tmp_path / "s"), rows, "pos", SJ.customer_stream_count_changelog)
    assert sorted(r["n"] for r in out.collect()) == list(range(1, 31))
    assert ST.batch_parts(spark, str(tmp_path / "s/staged")) == [] and ST.batch_parts(spark, str(tmp_path / "s/in")) == [0, 1, 2]


def test_buckets_without_increments_keep_their_base(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(carried, "COMPACT_EVERY", 2)
    path, base = str(tmp_path / "p8"), str(tmp_path / "p8/state/listens/base")
    for b in range(9):
        rows = [("busy", b * 10)] + ([(f"c{i}", b * 10 + i + 1) for i in range(20)] if b in (0, 8) else [])
        carried.in_batches(path, SJ.customer_stream_count_changelog)(_plays(spark, rows), b)
    assert carried.batch_ids(spark, base) == [1, 5, 7]  # the quiet buckets are still those of batch 1
    assert len(carried._buckets(spark, f"{base}/batch_id=1")) > 1 == len(carried._buckets(spark, f"{base}/batch_id=5"))
    out = spark.read.parquet(f"{path}/out").groupBy("customerid").agg(F.max("n").alias("n")).collect()
    assert {r["customerid"]: r["n"] for r in out} == {"busy": 9} | {f"c{i}": 2 for i in range(20)}


def test_closed_windows_leave_the_state(spark, tmp_path):
    """Twenty batches, each ten seconds of listens: the state holds the windows that can still be asked for."""
    path, steps = str(tmp_path / "p5a"), str(tmp_path / "p5a/state/windows/steps")
    job, windows = SJ.windowed_counts_changelog(10, 1), SJ.window_state(10, 1)
    late = [("a", "u", 3)]  # in a window that closed long ago
    for b in range(20):
        rows = [("a", "u", b * 10 + i) for i in (1, 4, 8)] + (late if b == 12 else [])
        batch = spark.createDataFrame([(x, y, at(t), b * 10 + i) for i, (x, y, t) in enumerate(rows)],
                                      "artistid string, customerid string, streamtime timestamp, pos bigint")
        carried.in_batches(path, job, windows)(batch, b)
    first = int(at(0).timestamp()) // 10
    left = {w for kind in ("steps", "base") for b in carried.batch_ids(spark, f"{path}/state/windows/{kind}")
            for w in carried._buckets(spark, f"{path}/state/windows/{kind}/batch_id={b}")}
    assert left == {first + 17, first + 18, first + 19} and carried.batch_ids(spark, steps)[-1] == 19
    out = spark.read.parquet(f"{path}/out").groupBy("window_start").agg(F.max("n").alias("n"), F.count("*").alias("rows")).collect()
    assert len(out) == 20 and {(r["n"], r["rows"]) for r in out} == {(3, 3)}


def test_the_last_value_is_carried_with_its_place(spark, tmp_path):
    rows = lambda *xs: spark.createDataFrame(list(xs), "k string, pos bigint, v string")
    spec = [Spec("l", "last", "v")]
    for b, batch in enumerate([rows(("a", 2, "x"), ("a", 1, "w"), ("b", 3, None)), rows(("a", 4, None), ("b", 5, "y")),
                               rows(("b", 6, None), ("a", 7, None), ("c", 8, None))]):
        scan = carried.Carried(str(tmp_path), b)
        got = {(r["k"], r["pos"]): r["l"] for r in scan("x", batch, ["k"], [F.col("pos")], "pos", spec).collect()}
        scan.commit(spark)
        assert got == [{("a", 1): "w", ("a", 2): "x", ("b", 3): None}, {("a", 4): "x", ("b", 5): "y"},
                       {("b", 6): "y", ("a", 7): "x", ("c", 8): None}][b]


def test_tickets_see_the_event_as_of_their_arrival(spark, tmp_path):
    """The event appears, is deleted and comes back with another capacity, each between two batches."""
    events = [[("e", 3, at(1)), ("f", 1, at(0))], [("e", None, at(6))], [("e", 9, at(10))], []]
    tickets = [[(0, "e", 1), (2, "e", 1), (3, "f", 1)], [(5, "e", 1), (7, "e", 1)], [(9, "e", 1), (11, "e", 1)], [(12, "e", 1), (13, "f", 1)]]
    for b, (changes, rows) in enumerate(zip(events, _tickets(tickets, spark))):
        table = spark.createDataFrame(changes, "id string, capacity int, updated timestamp")
        carried.in_batches(str(tmp_path / "p2"), SJ.purchase_event_ticket_asof)(J.ticket_and_event_records(rows, table), b)
    out = spark.read.parquet(str(tmp_path / "p2/out")).orderBy("arrival").collect()
    assert [(r["ticket_id"], r["eventid"], r["request_no"], r["remainingTickets"]) for r in out] == [
        ("#2", "e", 1, 2.0), ("#3", "f", 1, 0.0), ("#5", "e", 2, 1.0), ("#11", "e", 3, 0.0), ("#12", "e", 4, -1.0), ("#13", "f", 2, -1.0)]


def test_artists_added_between_batches_are_seen(spark, tmp_path):
    """The batch after a new version of the artists counts the new one; a replay uses the versions of the first run."""
    events = spark.createDataFrame([("e1", "A", 9), ("e2", "B", 9)], "id string, artistid string, capacity int")
    rows = [("A", "Ada", "x"), ("B", "Bob", "y")]
    schema = spark.createDataFrame(rows, "id string, name string, genre string").schema
    artists = Published(str(tmp_path / "artists"), schema)
    fn = carried.in_batches(str(tmp_path / "p4"), refreshing({"artists": artists}, lambda artists: SJ.revenue_leader(events, artists)))
    batches = _tickets([[(0, "e1", 5)], [(1, "e2", 9)], [(2, "e2", 1)]], spark)
    leaders = lambda: [(r["ticket_id"], r["artistId"], r["revenue"]) for r in spark.read.parquet(str(tmp_path / "p4/out")).orderBy("arrival").collect()]
    assert artists.versions(spark) == [] and artists.read(spark, -1).count() == 0  # nothing is published yet
    artists.publish(spark.createDataFrame(rows[:1], schema))
    fn(batches[0], 0)
    fn(batches[1], 1)
    assert artists.publish(spark.createDataFrame(rows, schema)) == 1
    fn(batches[1], 1)  # a replay
    assert artists.versions(spark) == [0, 1] and leaders() == [("#0", "A", 5)]
    fn(batches[2], 2)
    assert leaders() == [("#0", "A", 5), ("#2", "B", 10)]


def test_branches_appear_together(spark, tmp_path, monkeypatch):
    """A batch that fails between two branches shows in neither; its replay shows in both."""
    paths, manifest = {r: str(tmp_path / r) for r in ("priority", "default")}, str(tmp_path / "manifest")
    rows = lambda *xs: spark.createDataFrame(list(xs), "key string, sink string")
    shape = rows(("x", "y")).drop("sink").schema
    seen = lambda: [sorted(r["key"] for r in sinks.read_branch(spark, p, manifest, shape).collect()) for p in paths.values()]
    assert seen() == [[], []]
    sinks.split_writer(paths, manifest=manifest)(rows(("a", "priority"), ("b", "default")), 0)
    write = sinks.write_batch

    def failing(batch, path, batch_id):
        if path == paths["default"]:
            raise RuntimeError("lost")
        write(batch, path, batch_id)

    second = rows(("c", "priority"), ("d", "default"), ("e", "default"))
    monkeypatch.setattr(sinks, "write_batch", failing)
    with pytest.raises(RuntimeError):
        sinks.split_writer(paths, manifest=manifest)(second, 1)
    assert spark.read.parquet(paths["priority"]).count() == 2 and seen() == [["a"], ["b"]]
    monkeypatch.setattr(sinks, "write_batch", write)
    sinks.split_writer(paths, manifest=manifest)(second, 1)
    sinks.split_writer(paths, manifest=manifest)(rows(("f", "default")), 2)
    assert seen() == [["a", "c"], ["b", "d", "e", "f"]]
    assert {r["route"]: r["rows"] for r in spark.read.parquet(f"{manifest}/batch_id=1").collect()} == {"priority": 1, "default": 2}


def test_every_source_partition_has_its_stream_time(spark, tmp_path):
    """The slow partition's record counts though the fast one is far ahead, over two batches."""
    job = SJ.windowed_counts_changelog(10, 1, "partition")
    for b, rows in enumerate([[(100, 0), (5, 1)], [(7, 1), (30, 0), (104, 0), (25, 1), (6, 1)]]):
        batch = spark.createDataFrame([("a", "u", at(t), b * 10 + i, p) for i, (t, p) in enumerate(rows)],
                                      "artistid string, customerid string, streamtime timestamp, pos bigint, partition int")
        carried.in_batches(str(tmp_path / "p"), job)(batch, b)
    out = spark.read.parquet(str(tmp_path / "p/out"))
    assert sorted((r["pos"], r["n"]) for r in out.collect()) == [(0, 1), (1, 1), (10, 2), (12, 2), (13, 1)]


def test_best_streamers_keep_an_unknown_best(spark, tmp_path):
    """A stranger's best hides a lesser one; it is only left out of what is published."""
    s = entity_stream(spark, _write(str(tmp_path / "in"), [_listens([("stranger", "a")] * 3), _listens([("u", "a")] * 2 + [("u", "b")], 3)]),
                      "stream", max_files_per_trigger=1)
    path = str(tmp_path / "best")
    _through(SJ.windowed_stream_counts(s, size_seconds=3600, grace_seconds=1), SJ.merge_top_streamers(path), tmp_path, "update")
    best = SJ.read_latest(spark, path)
    assert {r["artistid"]: (r["customerid"], r["streamCount"]) for r in best.collect()} == {"a": ("stranger", 3), "b": ("u", 1)}
    known = spark.createDataFrame([("a",), ("b",), ("u",)], "id string")
    assert [(r["artistid"], r["customerid"]) for r in SJ.published(best, known, known).collect()] == [("b", "u")]


def test_watermark_drops_late_windows_over_batches(spark, tmp_path):
    def rec(i, sec):
        return {"id": str(i), "customerid": "u", "artistid": "a", "streamtime": f"2024-01-01 00:{sec // 60:02d}:{sec % 60:02d}", "pos": i}
    batches, out = [[rec(0, 3), rec(1, 4)], [rec(2, 100)], [rec(3, 5), rec(4, 101)]], str(tmp_path / "out")
    for n in range(1, 4):  # the query goes on from its checkpoint when the next file is there
        s = entity_stream(spark, _write(str(tmp_path / "in"), batches[:n]), "stream")
        q = sinks.start_batches(SJ.windowed_stream_counts(s, 10, 1), f"late{n}", lambda b, i: sinks.write_batch(b, out, i),
                                trigger={"availableNow": True}, checkpoint=str(tmp_path / "ckpt"))
        q.awaitTermination()
    rows = spark.read.parquet(out).groupBy("window_start").agg(F.max("n").alias("n")).orderBy("window_start").collect()
    assert [r["n"] for r in rows] == [2, 2]  # the record of second 5 came when its window was gone


def test_revenue_snapshot_leader_and_versions(spark, tmp_path):
    artists = spark.createDataFrame([("A", "Ada", "x"), ("B", "Bob", "y")], "id string, name string, genre string")
    path = str(tmp_path / "leader")
    fn = SJ.merge_revenue_leader(path, artists)
    for b in range(12):
        fn(spark.createDataFrame([("A", 5, b), ("B", b, b)], "artistid string, revenue bigint, last_pos bigint"), b)
    last = SJ.read_latest(spark, path).collect()
    assert [(r["artistId"], r["revenue"]) for r in last] == [("B", 11)]
    assert len(carried.batch_ids(spark, path)) == SJ.VERSIONS_KEPT + 1


def test_event_table_with_versions_and_deletions(spark):
    e = spark.createDataFrame([("e", "A", 2, 0), ("e", "A", 3, 1), ("gone", "A", 4, 0), ("gone", None, None, 2)], "id string, artistid string, capacity int, pos int")
    assert [tuple(r) for r in SJ._event_lookup(e).collect()] == [("e", "A", 3)]


def test_stateless_jobs(spark, tmp_path):
    cur = _write(str(tmp_path / "cur"), [[{"id": "k1", "birthdt": "1993-05-05", "pos": 0}, {"id": "k2", "birthdt": "1970-05-05", "pos": 1}]])
    old = _write(str(tmp_path / "old"), [[{"id": "k3", "birthdt": "1999-12-31", "pos": 0}]])
    q = sinks.start(SJ.target_customers(entity_stream(spark, cur, "customer"), entity_stream(spark, old, "customer")), "stateless", mode="append",
                    trigger={"availableNow": True}, checkpoint=str(tmp_path / "c1"))
    q.awaitTermination()
    assert sorted(r["id"] for r in spark.table("stateless").collect()) == ["k1", "k3"]
    addr = [{"line1": "9 Elm Row", "line2": "Rear", "citynm": "Ely", "state": s, "zip5": "89301", "zip4": "0001", "countrycd": "USA", "pos": i}
            for i, s in enumerate(["NV", "MN"])]
    paths = {"priority": str(tmp_path / "priority"), "default": str(tmp_path / "default")}
    _through(SJ.addresses_by_state(entity_stream(spark, _write(str(tmp_path / "addr"), [addr]), "address")), sinks.split_writer(paths), tmp_path)
    assert {k: [r["key"] for r in spark.read.parquet(p).collect()] for k, p in paths.items()} == {"priority": ["MN"], "default": ["NV"]}


def test_json_records_keep_longs(spark):
    df = spark.createDataFrame([("x", 2**40 + 1)], "artistId string, revenue bigint")
    back = sinks.from_records(sinks.to_records(df, "artistId"), df.schema).first()
    assert back["key"] == "x" and back["revenue"] == 2**40 + 1


def test_observed_metrics(spark, tmp_path):
    import time
    s = entity_stream(spark, _write(str(tmp_path / "in"), [_listens([("1", "2"), ("1", "3")])]), "stream")
    lines = []
    listener = sinks.progress_logger(lines.append)
    spark.streams.addListener(listener)
    try:
        q = sinks.start(sinks.observed(s, "listens_in"), "observed_rows", mode="append", trigger={"availableNow": True}, checkpoint=str(tmp_path / "c"))
        q.awaitTermination()
        time.sleep(1.0)  # events arrive later
    finally:
        spark.streams.removeListener(listener)
    assert any("'records': 2" in x for x in lines)


def test_top_artists_complete(spark, tmp_path):
    s = entity_stream(spark, _write(str(tmp_path / "in"), [_listens([("c1", "a"), ("c2", "b"), ("c3", "a")]), _listens([("c1", "c")] * 3, 3)]), "stream",
                      max_files_per_trigger=1)
    q = sinks.start(SJ.top_artists_global(s, k=2), "top_two", mode="complete", trigger={"availableNow": True}, checkpoint=str(tmp_path / "c"))
    q.awaitTermination()
    assert [(r["artistid"], r["n"]) for r in spark.table("top_two").orderBy(F.desc("n"), "artistid").collect()] == [("c", 3), ("a", 2)]


def test_last_change_is_the_snapshot(spark):
    _same(ST.stream_top_customer_artists(spark, SF), J.top_customer_artists(spark, SF))
    ch = J.artist_ticket_count_changelog(spark, SF)
    _same(ch.groupBy("artistid").agg(F.max("n").alias("n")), J.artist_ticket_count(spark, SF))
    tally = J.customer_conversion_tally_changelog(spark, SF)
    assert tally.agg(F.max("value")).first()[0] == J.customer_conversion_tally(spark, SF).first()["value"]
