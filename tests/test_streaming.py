"""Streams: a restart on the same checkpoint adds nothing (exactly-once), the stream result equals
the batch result, late rows are counted one by one, and re-deliveries never land twice."""

import datetime as dt
import json

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wattline.operators import decode as DC
from wattline.plans import bronze_plans
from wattline.session import scratch_path
from wattline.sources import bronze as B
from wattline.sources import messages as M
from wattline.sources import tables as T
from wattline.streaming import alerts as A
from wattline.streaming import ingest as S


def test_restart_on_checkpoint_is_idempotent_and_equals_batch(spark):
    land = S.landing(spark, SF_SMALL, scratch_path(spark, "t_landing"), chunks=3)
    root, ck = scratch_path(spark, "t_bronze"), scratch_path(spark, "t_ck")
    q1 = S.ingest(spark, land, root, ck)
    n1 = B.all_tables(spark, root).count()
    assert len([p for p in q1.recentProgress if p.numInputRows > 0]) == 3   # one range per micro-batch
    seen = sum(p.observedMetrics[S.LOAD_METRICS]["messages"] for p in q1.recentProgress
               if S.LOAD_METRICS in p.observedMetrics)
    assert seen == spark.read.parquet(f"{land}/data").count()                # A2 counters per batch
    q2 = S.ingest(spark, land, root, ck)                                      # same checkpoint
    assert sum(p.numInputRows for p in q2.recentProgress) == 0
    assert B.all_tables(spark, root).count() == n1
    batch = bronze_plans.bronze_ingest(spark, SF_SMALL)
    assert B.all_tables(spark, root).exceptAll(batch).count() == 0 and batch.count() == n1


def test_landing_splits_by_the_largest_range_and_any_process_finds_the_batch_size(spark, monkeypatch):
    monkeypatch.setattr(S, "ARRIVAL_FILE_BYTES", 5_000)
    # one range is empty and one holds nearly everything: rows held back arrive as the last range
    hot = F.col("topic") != "energy.bronze.plants"
    land = S.landing(spark, SF_SMALL, scratch_path(spark, "t_landing"), chunks=3, held_back=hot)
    n = S.files_per_arrival(spark.newSession(), land)
    assert n > 1
    files = {}
    for r in spark.read.parquet(f"{land}/data").groupBy(F.col("_metadata.file_path").alias("f"), hot.alias("hot")).count().collect():
        files.setdefault(r.hot, []).append(r["count"])
    assert len(files[True]) == n and max(files[True]) < 2 * sum(files[True]) / n
    root, ck = scratch_path(spark, "t_bronze_multi"), scratch_path(spark, "t_ck_multi")
    q = S.ingest(spark.newSession(), land, root, ck)
    assert len([p for p in q.recentProgress if p.numInputRows > 0]) == 4     # one range per micro-batch
    assert sum(p.numInputRows for p in q.recentProgress) == spark.read.parquet(f"{land}/data").count()


def test_arrivals_have_all_their_files_and_are_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "ARRIVAL_FILE_BYTES", 5_000)
    # the last range has one row: its batch must not take files of another
    land = S.landing(spark, SF_SMALL, scratch_path(spark, "t_landing"), chunks=2, held_back=(F.col("partition") == 0) & (F.col("offset") == 0)
                     & (F.col("topic") == "energy.bronze.scada"))
    n = S.files_per_arrival(spark, land)
    assert n > 1 and len(T.files_of(spark, f"{land}/data")) == 3 * n + 1          # _SUCCESS
    # one file, short row groups: as many tasks as the file has room for
    root = scratch_path(spark, "t_groups")
    spark.createDataFrame([(1,)], "files_per_arrival int").write.parquet(f"{root}/plan")
    S.append_arrivals(spark.range(400_000).select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("value")), root)
    [f] = [f[0] for f in T.files_of(spark, f"{root}/data") if f[0].endswith(".parquet")]
    assert pq.ParquetFile(f.removeprefix("file:")).num_row_groups > 2


def test_lookup_in_a_ledger_with_many_gaps(spark):
    """Every second offset of a bucket has been taken, and a long range behind them: no message meets them all."""
    gaps = spark.range(0, 20_000, 2).select(F.col("id").alias("lo"), F.col("id").alias("hi"))
    long = spark.createDataFrame([(20_010, 30_000), (500, 755)], "lo long, hi long")
    ranges = gaps.unionByName(long).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("bucket"),
                                           "lo", "hi", F.lit("redriven").alias("kind"))
    rows = spark.range(32_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    left = B.not_taken(rows, ranges).select("offset")
    want = [i for i in range(32_000) if not (i < 20_000 and i % 2 == 0 or 20_010 <= i <= 30_000 or 500 <= i <= 755)]
    assert sorted(r.offset for r in left.collect()) == want


def scada(spark, rows):
    """Messages of one node: (offset, minute of the day, solar_mw)."""
    day = dt.datetime(2024, 1, 1)
    text = '{{"timestamp":"{}","node_id":"N1","solar_mw":"{}","_dataset":"chile"}}'
    return spark.createDataFrame(
        [(b"k", text.format((day + dt.timedelta(minutes=m)).isoformat(), v).encode(), "energy.bronze.scada", 0, o,
          day + dt.timedelta(minutes=m)) for o, m, v in rows],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")


def test_ten_late_rows_of_one_window_count_as_ten(spark):
    root = scratch_path(spark, "t_late")
    spark.createDataFrame([(1,)], "files_per_arrival int").write.parquet(f"{root}/plan")
    arrivals = [[(i, i * 10, 1.0) for i in range(6)], [(100, 600, 1.0)], [(101, 700, 1.0)],
                [(200 + i, 5 + i, 1.0) for i in range(10)], [(300, 800, 1.0)]]
    for a in arrivals:
        S.append_arrivals(scada(spark, a), root)
    out, ck = scratch_path(spark, "t_late_out"), scratch_path(spark, "t_late_ck")

    def write(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")
    S.run_available(S.hourly_rollup(S.scada_rows(S.message_stream(spark, root))).writeStream.outputMode("update").foreachBatch(write), ck)
    counted = spark.read.parquet(out).groupBy("window").agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0]
    assert sum(map(len, arrivals)) - counted == 10


def test_redelivery_replay_and_repair(spark):
    """Second copies, in the same batch or much later, land once; repaired dead letters land once."""
    root = scratch_path(spark, "t_ledger")
    msgs = scada(spark, [(i, i, 1.0) for i in range(20)])
    bad = msgs.limit(1).select("key", F.lit(b'{"node_id":"N1"').alias("value"), "topic", "partition", F.lit(99).cast("bigint").alias("offset"), "timestamp")
    B.land(DC.decode_json(msgs.unionByName(msgs.limit(5)).unionByName(bad)), root, "1")
    B.land(DC.decode_json(msgs.limit(7).unionByName(scada(spark, [(50, 3, 2.0)])).unionByName(bad)), root, "2")
    assert B.read_table(spark, root, "scada_telemetry").count() == 21
    assert B.read_table(spark, root, "dead_letter_queue").count() == 1
    fixed = scada(spark, [(99, 9, 3.0), (4, 4, 4.0)])                # 4 is no dead letter
    for run in ("3", "4", "4"):
        B.land(DC.decode_json(fixed), root, run, redrive=True)
    t = B.read_table(spark, root, "scada_telemetry")
    assert t.count() == 22 and t.filter("_kafka_offset = 99").count() == 1
    # an epoch that was committed long ago comes again: nothing changes
    for run in ("1", "2", "3"):
        B.land(DC.decode_json(msgs), root, run)
    assert B.read_table(spark, root, "scada_telemetry").count() == 22
    assert B.taken_messages(spark, root).filter("landed").count() == 22


def test_ledger_follows_gaps_not_messages(spark, monkeypatch):
    monkeypatch.setattr(B, "LEDGER_SPAN", 64)
    root = scratch_path(spark, "t_ranges")
    B.land(DC.decode_json(scada(spark, [(i, i, 1.0) for i in range(200)])), root, 0)
    B.land(DC.decode_json(scada(spark, [(i, i, 1.0) for i in [*range(190, 260), 300]])), root, 1)
    B.land(DC.decode_json(scada(spark, [(i, i, 1.0) for i in [*range(0, 310, 7)]])), root, 2)
    got = sorted((r.lo, r.hi) for r in B.ledger(spark, root).collect())
    late = [i for i in range(0, 310, 7) if i > 259 and i != 300]
    assert got == sorted([(0, 63), (64, 127), (128, 191), (192, 255), (256, 259), *((i, i) for i in [*late, 300] if i != 301 and i != 300), (300, 301)])
    assert B.read_table(spark, root, "scada_telemetry").count() == 260 + 1 + len(late)
    # a retry of the last batch, with more rows, replaces it
    B.land(DC.decode_json(scada(spark, [(i, i, 1.0) for i in [*range(0, 310, 7), 305]])), root, 2)
    assert B.read_table(spark, root, "scada_telemetry").count() == 260 + 2 + len(late)


def test_earliest_of_two_payloads_under_one_offset_lands(spark):
    root = scratch_path(spark, "t_twice")
    a, b = scada(spark, [(5, 10, 1.0)]), scada(spark, [(5, 4, 2.0)])
    B.land(DC.decode_json(a.unionByName(b).unionByName(scada(spark, [(7, 1, 3.0)]))), root, 0)
    assert {(r._kafka_offset, r.solar_mw) for r in B.read_table(spark, root, "scada_telemetry").collect()} == {(5, 2.0), (7, 3.0)}


def test_strict_json(spark):
    """What json.loads rejects is rejected; bare NaN and infinities are numbers."""
    texts = ['{"node_id":"N1"}', "{'node_id':'N1'}", '{"node_id":\'N1\'}', '{"node_id":"N1"},{"5f3c-end-of-payload":""}]', '{"x":1}]',
             '{"node_id":"it\'s"}', '{"x":NaN,"y":-Infinity,"z":"NaN"}', '{"x":INF}', '{"x":Infinit}', ' {"a":{"b":[1,2]}} ', "[1]", "", "{}"]
    df = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "offset long, value binary")
    got = {r.offset: (r.error_message, r.p) for r in DC.decode_json(df).collect()}
    ok = []
    for t in texts:
        try:
            ok.append(isinstance(json.loads(t), dict))
        except ValueError:
            ok.append(False)
    assert [got[i][0] is None for i in range(len(texts))] == ok
    assert got[6][1] == {"x": "NaN", "y": "-Infinity", "z": "NaN"} and got[5][1] == {"node_id": "it's"}


def readings(spark, rows):
    """Messages of (feed, node, minute, offset)."""
    day = dt.datetime(2024, 1, 1)
    metric = {"scada": "solar_mw", "weather": "temperature_c"}
    return spark.createDataFrame(
        [(b"k", f'{{"timestamp":"{(day + dt.timedelta(minutes=m)).isoformat()}","node_id":"{n}","{metric[f]}":"1"}}'.encode(),
          f"energy.bronze.{f}", 0, o, day + dt.timedelta(minutes=m)) for f, n, m, o in rows],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")


def expected_alerts(rows, limits):
    """Plain form over all readings: gaps of closed windows, and what is open at the last watermark."""
    wm = max(m for _, _, m in rows) - 10
    out = set()
    for feed, node in {(f, n) for f, n, _ in rows}:
        t = sorted(m for f, n, m in rows if (f, n) == (feed, node) and m // 5 * 5 + 5 <= wm)
        for a, b in zip(t, [*t[1:], None]):
            end, due = a // 5 * 5 + 5, a + limits[feed]
            if b is None:
                out |= {(feed, node, "stale", "raised", due)} if -(-due // 5) * 5 < wm else set()
                out |= {(feed, node, "missed", "raised", end + 5)} if end + 5 < wm else set()
            else:
                out |= {(feed, node, "stale", "raised", due), (feed, node, "stale", "cleared", b)} if b > due else set()
                out |= {(feed, node, "missed", "raised", end + 5), (feed, node, "missed", "cleared", b)} if b // 5 * 5 > end else set()
    return out


def test_alerts_fire_clear_and_survive_a_restart(spark):
    """Timers set by one run fire in the next; the cut into batches doesn't matter."""
    rows = [("scada", "N1", m) for m in [*range(0, 60, 4), *range(100, 130, 4), 300]]
    rows += [("scada", "N2", m) for m in range(0, 300, 3)] + [("weather", "N1", m) for m in (1, 2, 121, 123, 290)] + [("scada", "N3", 7)]
    limits = {"scada": 15, "weather": 120}
    numbered = [(f, n, m, k) for k, (f, n, m) in enumerate(sorted(rows, key=lambda r: r[2]))]
    before = A.use_disk_state(spark)
    try:
        seen = []
        for cuts in ([0, 301], [0, 20, 70, 110, 301]):
            root, out, ck = (scratch_path(spark, x) for x in ("t_al", "t_al_out", "t_al_ck"))
            spark.createDataFrame([(1,)], "files_per_arrival int").write.parquet(f"{root}/plan")
            for a, b in zip(cuts, cuts[1:]):
                S.append_arrivals(readings(spark, [r for r in numbered if a <= r[2] < b]), root)
                events = A.alerts(S.feed_rows(S.message_stream(spark, root), {f"energy.bronze.{f}": f for f in limits}), limits)
                S.run_available(events.writeStream.format("parquet").option("path", out).outputMode("append"), ck)   # stopped and started anew
            start = dt.datetime(2024, 1, 1)
            seen.append({(r.feed, r.node_id, r.alert, r.event, (r.event_at - start).total_seconds() / 60): r.n_missed
                         for r in spark.read.parquet(out).collect()})
    finally:
        A.restore(spark, before)
    assert seen[0] == seen[1] and set(seen[0]) == expected_alerts(rows, limits)
    assert seen[0]["scada", "N1", "missed", "cleared", 100] == 8 and ("scada", "N3", "stale", "raised", 22) in seen[0]


def test_alerts_of_many_nodes_take_one_call_for_a_group():
    """One call holds many nodes; it gives what a call for each node gives, an alert of the time before included."""
    class Handle:
        def __init__(self):
            self.timers, self.state = set(), None

        def getValueState(self, name, schema):
            return self

        def exists(self):
            return self.state is not None

        def get(self):
            return self.state

        def update(self, state):
            self.state = state

        def listTimers(self):
            return iter(self.timers)

        def deleteTimer(self, t):
            self.timers.discard(t)

        def registerTimer(self, t):
            self.timers.add(t)

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms
    minute = 60_000_000
    watch, handle = A.Watch({"scada": 15 * minute}), Handle()
    watch.init(handle)

    def windows(rows):
        return iter([pd.DataFrame([("scada", n, (m // 5 * 5 + 5) * minute, m * minute, m * minute) for n, m in rows],
                                  columns=["feed", "node_id", "end_us", "first_us", "last_us"])])

    def told(frames):
        return {(r.node_id, r.alert, r.event, r.at_us // minute, None if pd.isna(r.n_missed) else r.n_missed) for f in frames for r in f.itertuples()}
    nodes = [f"N{i}" for i in range(200)]
    assert told(watch.handleInputRows((0,), windows([(n, 2) for n in nodes] + [("N0", 52)]), At(60 * 60_000))) == {
        ("N0", "stale", "raised", 17, None), ("N0", "stale", "cleared", 52, None), ("N0", "missed", "raised", 10, None), ("N0", "missed", "cleared", 52, 9)}
    assert handle.timers == {10 * 60_000}
    assert told(watch.handleExpiredTimer((0,), At(60 * 60_000), None)) == {(n, *e) for n in nodes[1:] for e in (
        ("stale", "raised", 17, None), ("missed", "raised", 10, None))}
    assert handle.timers == {60 * 60_000}
    assert told(watch.handleInputRows((0,), windows([("N7", 61)]), At(65 * 60_000))) == {("N7", "stale", "cleared", 61, None), ("N7", "missed", "cleared", 61, 11)}


def test_late_rows_leave_as_a_branch(spark):
    """The ten late rows of one window are a table; a retried batch replaces its own folders."""
    root, out, ck = (scratch_path(spark, x) for x in ("t_lb", "t_lb_out", "t_lb_ck"))
    spark.createDataFrame([(1,)], "files_per_arrival int").write.parquet(f"{root}/plan")
    arrivals = [[(i, i * 10, 1.0) for i in range(6)], [(100, 600, 1.0)], [(101, 700, 1.0)], [(200 + i, 5 + i, 2.0) for i in range(10)] + [(290, 695, 4.0)], [(300, 800, 1.0)]]
    for a in arrivals:
        S.append_arrivals(scada(spark, a), root)
        S.rollup_with_late(S.scada_rows(S.message_stream(spark, root)), out, ck, ["_kafka_offset"])        # started anew for each arrival
    assert sorted(r._kafka_offset for r in S.late_rows(spark, out).collect()) == list(range(200, 210))
    hour = 3_600_000_000
    base = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    assert {((r.end_us - base) // hour, r.n, float(r.total)) for r in S.closed_windows(spark, out).collect()} == {(1, 6, 6.0), (11, 1, 1.0), (12, 2, 5.0)}


def test_columns_appear_mid_stream(spark):
    def batch(rows):
        return DC.decode_json(spark.createDataFrame(
            [(b"k", json.dumps({"timestamp": "2024-01-01T00:00:00", "node_id": "N1", "solar_mw": "1", **x}).encode(), "energy.bronze.scada", 0, o)
             for o, x in rows], "key binary, value binary, topic string, partition int, offset long"))
    root = scratch_path(spark, "t_evolve")
    B.land(batch([(0, {}), (1, {"spot_price_usd": "3"})]), root, 0, evolve=True)
    assert B.added_columns(spark, root) == {}
    for _ in range(2):                                                   # the second time as a retry
        B.land(batch([(2, {"temp": "4.5", "note": "a"}), (3, {"temp": "5", "note": "7", "Bad Name": "x"}), (4, {"temp": None})]), root, 1, evolve=True)
    B.land(batch([(5, {"temp": "hot", "note": "b", "more": "1"}), (6, {})]), root, 2, evolve=True)
    assert B.added_columns(spark, root) == {"scada_telemetry": {"more": "double", "note": "string", "temp": "double"}}
    got = {r._kafka_offset: (r.temp, r.note, r.more) for r in B.read_table(spark, root, "scada_telemetry", merge_schema=True).collect()}
    assert got == {0: (None,) * 3, 1: (None,) * 3, 2: (4.5, "a", None), 3: (5.0, "7", None), 4: (None,) * 3, 5: (None, "b", 1.0), 6: (None,) * 3}


def test_publish_round_trip(spark):
    """S3: rows published as messages decode to the same rows."""
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), "N1", 1.5), (dt.datetime(2024, 1, 2), "N2", None)],
                                 "timestamp timestamp_ntz, node_id string, demand_mw double")
    m = M.publish(rows, "energy.bronze.demand", "ff")
    got = {r.key.decode(): r for r in DC.decode_json(m).select("key", "p", "error_message", "partition", "offset").collect()}
    assert set(got) == {"N1:2024-01-01 00:00:00", "N2:2024-01-02 00:00:00"}
    one, two = got["N1:2024-01-01 00:00:00"], got["N2:2024-01-02 00:00:00"]
    assert one.error_message is None and one.p["demand_mw"] == "1.5" and one.p["_dataset"] == "ff"
    assert "demand_mw" in two.p and two.p["demand_mw"] is None and 0 <= one.partition < M.PARTITIONS
    good, bad = DC.to_table(DC.decode_json(m), "demand", "b")
    assert good.count() == 1 and [r.reasons for r in bad.collect()] == [["missing demand_mw"]]
