"""Operator tests on hand-made rows with literal expected results (NULLs, empty input,
duplicates and bad rows included)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattline.functions.columns import dround, exact_sum
from wattline.operators import decode as DC
from wattline.operators import joins as J
from wattline.operators import ops as O
from wattline.operators import series as S
from wattline.operators import silver as V
from wattline.operators.derive import dense_sequence, exact_quantiles, split_units, unpivot_sources


def ts(d, h=0, m=0):
    return dt.datetime(2024, 1, d, h, m)


def test_dround_rounds_ties_in_decimal(spark):
    r = spark.range(1).select(dround(F.lit(11.5) * F.lit(0.3), 1).alias("a"),
                              dround(F.lit(2.675), 2).alias("b")).first()
    assert (r.a, r.b) == (3.5, 2.68)


def test_exact_sum_is_order_free(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)] * 1000, "x double").repartition(7)
    assert df.agg(exact_sum("x", 2)).first()[0] == 600.0


def test_previous_row_crosses_buckets_and_matches_lag(spark):
    rows = [(1, ts(1, 23, 50), 1.0), (1, ts(2, 0, 10), 2.0), (1, ts(4, 5), 3.0), (2, ts(2, 1), 9.0),
            (1, ts(4, 6), 4.0)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v double")
    got = S.previous_row(df, ["k"], ["t"], ["v"]).select("k", "t", "prev_t", "prev_v")
    w = Window.partitionBy("k").orderBy("t")
    want = df.select("k", "t", F.lag("t").over(w).alias("prev_t"), F.lag("v").over(w).alias("prev_v"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_next_row_and_running_total(spark):
    rows = [(1, ts(1, h), float(h)) for h in range(0, 24, 5)] + [(1, ts(3, 1), 100.0)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v double")
    n = {r.t: r.next_v for r in S.next_row(df, ["k"], ["t"], ["v"]).collect()}
    assert n[ts(1, 20)] == 100.0 and n[ts(3, 1)] is None
    rt = {r.t: r.cum for r in S.running_total(df, ["k"], ["t"], "v", "cum").collect()}
    assert rt[ts(3, 1)] == sum(range(0, 24, 5)) + 100.0


def test_halo_copies_only_edge_rows(spark):
    df = spark.createDataFrame([(ts(1, 23, 30),), (ts(1, 12),)], "t timestamp_ntz")
    h = S.with_halo(df, "t", S.DAY, before=3600).collect()
    assert len(h) == 3 and sum(r._halo for r in h) == 1


def test_hot_key_window_spreads_over_buckets(spark):
    """One key holding most rows: the (key, bucket) windows give the same LAG as one window."""
    rows = [(0, ts(1 + i // 24, i % 24), float(i)) for i in range(24 * 20)] + [(1, ts(1), 5.0)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v double")
    got = S.previous_row(df, ["k"], ["t"], ["v"]).filter("k = 0 and prev_v is not null")
    assert got.count() == 24 * 20 - 1
    assert got.filter(F.col("v") - F.col("prev_v") != 1).count() == 0


def test_dedup_latest_keeps_greatest_order(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 3, 30.0), ("a", 2, 20.0), ("b", 1, None)],
                               "k string, off int, v double")
    got = {r.k: (r.off, r.v) for r in V.dedup_latest(df, ["k"], ["off"], ["v"]).collect()}
    assert got == {"a": (3, 30.0), "b": (1, None)}


def test_fill_linear_limits_and_never_extrapolates(spark):
    rows = [(1, ts(1, 0), 0.0), (1, ts(1, 3), 3.0), (1, ts(1, 11), 11.0)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v double")
    got = {r.t: (r.v, r.is_filled) for r in V.fill_linear(df, "k", "t", "v", 1, 6).collect()}
    assert got[ts(1, 1)] == (1.0, True) and got[ts(1, 2)] == (2.0, True)
    assert got[ts(1, 5)] == (None, False)          # a gap of 7 missing steps stays NULL
    assert min(got) == ts(1, 0) and max(got) == ts(1, 11) and len(got) == 12


def test_asof_join_equal_times_and_tolerance(spark):
    left = spark.createDataFrame([(1, ts(1, 10)), (1, ts(1, 13)), (2, ts(1, 10)), (1, ts(2, 0, 30))],
                                 "k int, t timestamp_ntz")
    right = spark.createDataFrame([(1, ts(1, 10), 5.0), (1, ts(1, 23, 45), 7.0)], "k int, ot timestamp_ntz, v double")
    got = {(r.k, r.t): (r.ot, r.v) for r in V.asof_join(left, right, "k", "t", "ot", ["v"], 7200).collect()}
    assert got[(1, ts(1, 10))] == (ts(1, 10), 5.0)          # equal times match
    assert got[(1, ts(1, 13))] == (None, None)             # 3 h old: beyond the tolerance
    assert got[(2, ts(1, 10))] == (None, None)             # other key
    assert got[(1, ts(2, 0, 30))] == (ts(1, 23, 45), 7.0)  # previous day, via the halo


def test_scd2_collapses_equal_versions(spark):
    snaps = spark.createDataFrame(
        [(1, "A", 1.0, ts(1)), (1, "A", 1.0, ts(2)), (1, "B", 1.0, ts(3)), (1, "B", None, ts(4)), (2, "X", 2.0, ts(1))],
        "id int, make string, price double, at timestamp_ntz")
    v = V.scd2(snaps, "id", "at", ["make", "price"]).orderBy("id", "valid_from").collect()
    assert [(r.id, r.make, r.valid_from, r.valid_to, r.is_current) for r in v] == [
        (1, "A", ts(1), ts(3), False), (1, "B", ts(3), ts(4), False), (1, "B", ts(4), None, True),
        (2, "X", ts(1), None, True)]


def test_flatline_runs(spark):
    vals = ["F"] * 7 + ["O"] * 2 + ["F"] * 6
    df = spark.createDataFrame([(1, ts(1, i), v) for i, v in enumerate(vals)], "k int, t timestamp_ntz, s string")
    runs = sorted((r.s, r.run_length) for r in V.flatline_runs(df, "k", ["t"], "s", 6).collect())
    assert runs == [("F", 6), ("F", 7)]


def test_dense_sequence_and_quantiles(spark):
    df = spark.range(0, 1000).selectExpr("id * 7 % 1000 as x").repartition(5)
    seq = dense_sequence(df, ["x"], "n").orderBy("x").collect()
    assert [r.n for r in seq] == list(range(1, 1001))
    q = exact_quantiles(df, "x", [0.5, 0.95]).first()
    assert (q.q0, q.q1) == (499, 949)


def test_ppa_price_of_any_currency(spark):
    cases = {'{"ppa_price_eur_mwh":"3"}': "3", '{"ppa_price_x":"1","ppa_price_mwh":"2"}': "2", '{"ppa_price_usd":"9"}': None,
             '{"ppa_price":"9"}': None, '{}': None, '{"ppa_price_gil_mwh":"4","node_id":"N"}': "4"}
    msgs = spark.createDataFrame([(b"k", v.encode(), "energy.bronze.plants", 0, i, ts(1)) for i, v in enumerate(cases)],
                                 "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    got = {r.offset: r.ppa_price_mwh for r in DC.normalize_ppa(DC.decode_json(msgs)).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


@pytest.mark.parametrize("parts", [4, 8, 16, 200])
def test_dense_sequence_is_right_at_any_partition_count(spark, parts):
    """Payload columns make the plans of the rows and of the counts differ; the slices must not."""
    df = spark.range(0, 200_000, 1, 12).selectExpr("id * 7919 % 200000 AS k", "repeat('x', 50) AS payload", "id")
    seq = dense_sequence(df, ["k"], "n", parts)
    assert seq.filter("n <> k + 1").count() == 0 and seq.select("n").distinct().count() == 200_000
    q = exact_quantiles(df, "k", [0.25, 0.999]).first()
    assert (q.q0, q.q1) == (49_999, 199_799)


def test_exact_quantiles_with_a_hot_value(spark):
    # a third of the rows share one value; the answer is the percentile_disc rank rule
    rows = [(7,)] * 400 + [(i,) for i in range(800)] + [(None,)] * 5
    df = spark.createDataFrame(rows, "x int").repartition(4)
    xs = sorted(r[0] for r in rows if r[0] is not None)
    probs = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    want = [xs[max(1, math.ceil(p * len(xs))) - 1] for p in probs]
    q = exact_quantiles(df, "x", probs).first()
    assert [q[f"q{i}"] for i in range(len(probs))] == want


def test_split_and_unpivot(spark):
    df = spark.createDataFrame([(1, 250.0), (2, 50.0)], "p int, capacity_mw double")
    u = split_units(df).collect()
    assert sorted((r.p, r.unit_no, r.unit_capacity_mw) for r in u) == [(1, 1, 125.0), (1, 2, 125.0), (2, 1, 50.0)]
    wide = spark.createDataFrame([(1, 5.0, 0.0, None)], "n int, solar double, wind double, hydro double")
    assert [r.source_type for r in unpivot_sources(wide, ["n"], ["solar", "wind", "hydro"]).collect()] == ["solar"]


def test_decode_cases(spark):
    """The message cases of the fixture list: good, quoted/bare numbers, non-JSON, array, scalar,
    NULL, invalid UTF-8, missing and extra columns, missing _dataset, both currencies."""
    good = '{"timestamp":"2024-01-01T00:00:00","node_id":"N1","solar_mw":"1.5","_dataset":"chile"}'
    rows = [
        (good.encode(), 0),
        (good.replace('"1.5"', '1.5').encode(), 1),
        (b"not json", 2),
        (b'[{"node_id":"N1"}]', 3),
        (b'"str"', 4),
        (None, 5),
        (b'{"node_id":"N\xff"}', 6),
        (b'{"timestamp":"2024-01-01T00:00:00","solar_mw":"2"}', 7),
        (good.replace('"_dataset"', '"extra":"x","_dataset"').encode(), 8),
        (b'{"timestamp":"2024-01-01T00:00:00","node_id":"N2"}', 9),
        (good.encode() + b" trailing", 10), ((good + good).encode(), 11), ((good + "," + good).encode(), 12),
        (("\n\t " + good + "\r\n").encode(), 13), ((good + "]").encode(), 14), (good[:-1].encode(), 15), (b"", 16), (b"null", 17),
    ]
    msgs = spark.createDataFrame([(b"k", v, "energy.bronze.scada", 0, o, ts(1)) for v, o in rows],
                                 "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    d = DC.decode_json(msgs)
    err = {r.offset: r.error_message for r in d.collect()}
    assert err == {0: None, 1: None, 2: "not a json object", 3: "not a json object", 4: "not a json object",
                   5: "null payload", 6: "invalid utf-8", 7: None, 8: None, 9: None, 10: "invalid json",
                   11: "invalid json", 12: "invalid json", 13: None, 14: "invalid json", 15: "invalid json",
                   16: "not a json object", 17: "not a json object"}
    good_rows, bad = DC.to_table(d, "scada_telemetry", "b1")
    g = {r._kafka_offset: r for r in good_rows.collect()}
    assert g[0].solar_mw == 1.5 and g[1].solar_mw == 1.5 and g[8].solar_mw == 1.5 and g[13].solar_mw == 1.5
    assert g[9]._dataset == "unknown"
    assert [r.reasons for r in bad.collect()] == [["missing node_id"]]
    dlq = DC.dlq_one_pass(d, "b1").collect()
    assert len(dlq) == 13 and {r.offset_id for r in dlq} == {2, 3, 4, 5, 6, 7, 10, 11, 12, 14, 15, 16, 17}
    total = DC.outcomes(d).first()
    assert (total.landed, total.rejected) == (5, 13)
    bad_utf8 = [r.value for r in dlq if r.offset_id == 6][0]
    assert "�" in bad_utf8


def test_currency_precedence(spark):
    v = b'{"timestamp":"2024-01-01T00:00:00","node_id":"N1","spot_price_usd":"1","spot_price_gil":"2"}'
    msgs = spark.createDataFrame([(b"k", v, "energy.bronze.dispatch", 0, 0, ts(1))],
                                 "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    g, _ = DC.to_table(DC.decode_json(msgs), "grid_dispatch", "b")
    assert g.first().spot_price == 2.0   # gil wins when both are present


def test_reconcile_outcomes(spark):
    desired = spark.createDataFrame([("a", "x", ["l1", "l2"]), ("b", "y", ["l1"]), ("c", "z", ["l2", "l1"])],
                                    "key string, description string, labels array<string>")
    current = spark.createDataFrame([("b", "y2", ["l1"]), ("c", "z", ["l1", "l2"]), ("d", "q", [])],
                                    "key string, description string, labels array<string>")
    got = {r.key: (r.outcome, r.changed_columns) for r in J.reconcile(desired, current, "key", ["description", "labels"],
                                                                       ["labels"]).collect()}
    assert got == {"a": ("created", []), "b": ("updated", ["description"]), "c": ("unchanged", []),
                   "d": ("orphan", [])}
    again = {r.key: r.outcome for r in J.reconcile(desired, desired, "key", ["description", "labels"], ["labels"]).collect()}
    assert set(again.values()) == {"unchanged"}      # an identical re-run changes nothing


def test_prefix_lookup_tolerates_typos(spark):
    lists = spark.createDataFrame([("Backlog", 1), ("In Pogress", 2), ("Done", 3), ("Doing", 4), ("Done!", 5)],
                                  "list_name string, position int")
    declared = spark.createDataFrame([("backlog",), ("In Progress",), ("Review",), ("Do",), ("Dones",), ("doin",)],
                                     "declared_name string")
    got = {r.declared_name: (r.list_name, r.match_kind) for r in J.prefix_lookup(declared, lists).collect()}
    assert got == {"backlog": ("Backlog", "exact"), "In Progress": ("In Pogress", "prefix"),
                   "Review": (None, "error"), "Do": (None, "error"),      # 'do' is not a 4-char prefix of 'done'
                   "Dones": ("Done", "prefix"),                          # lowest position of two matches
                   "doin": ("Doing", "prefix")}


def test_incident_create_append_and_reopen(spark):
    log = spark.createDataFrame([
        (ts(1, 1), 1, "dag failed", "P2", "first", "open"),
        (ts(1, 2), 2, "dag failed", "P2", "again", "open"),
        (ts(1, 3), 3, "dag failed", "P2", "", "close"),
        (ts(1, 4), 4, "dag failed", "P2", "back", "open"),
        (ts(1, 5), 5, "dag failed", "P1", "other sev", "open"),
    ], "ts timestamp_ntz, seq long, title string, severity string, body string, action string")
    cards = sorted((r.full_title, r.episode, r.description, r.n_comments, r.closed_at)
                   for r in O.incident_cards(log).collect())
    assert cards == [("[INCIDENT] [P1] dag failed", 0, "other sev", 0, None),
                     ("[INCIDENT] [P2] dag failed", 0, "first", 1, ts(1, 3)),
                     ("[INCIDENT] [P2] dag failed", 1, "back", 0, None)]
    assert [r.body for r in O.incident_comments(log).collect()] == ["again"]


def test_nested_snapshot_keeps_empty_parents(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    kids = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "pid int, pos int, name string")
    got = {r.id: [c.name for c in r.children] for r in O.nested_snapshot(parents, kids, "id", "pid", ["pos", "name"], "pos").collect()}
    assert got == {1: ["a", "b"], 2: []}


def test_table_catalog_card(spark):
    stats = spark.createDataFrame([("scada", 12345, ts(2, 3))], "table_name string, row_count long, freshness timestamp_ntz")
    c = O.table_catalog(stats, "2024-01-03T00:00:00").first()
    assert c.title == "[ASSET] scada" and "**Row count**: 12,345" in c.description


def test_broadcast_only_within_bound(spark):
    small = spark.range(10)
    big = spark.range(100)
    assert "broadcast" in J.broadcast_if_small(small, 50)._jdf.queryExecution().logical().toString().lower()
    assert J.broadcast_if_small(big, 50) is big


def test_strict_pairing_rejects_unmapped(spark):
    base = spark.createDataFrame([(1,), (2,)], "b int")
    m = spark.createDataFrame([(1, "x")], "mb int, md string")
    d = spark.createDataFrame([("x",)], "dk string")
    with pytest.raises(ValueError):
        J.strict_pairing(base, m, d, "b", "mb", "md", "dk")


def test_zscore_of_a_dense_node_is_put_together_from_short_buckets(spark):
    """Buckets shorter than the look-back give what one window over the key gives."""
    rng = random.Random(6)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", None]), t0 + dt.timedelta(seconds=rng.choice([rng.randrange(300_000), rng.randrange(0, 300_000, 600)])),
             rng.choice([None, *[round(rng.gauss(50, 10), 4) for _ in range(50)], 500.0])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    def got(bucket):
        out = V.zscore_outliers(df, "k", "t", "v", bucket_seconds=bucket)
        return sorted((str(r.k), r.t, str(r.v), r.n, str(r.z), r.is_outlier) for r in out.collect())
    want = got(10_000_000)
    assert any(r[5] for r in want)
    for bucket in (3600, 1000, 61):
        assert got(bucket) == want


def test_nested_snapshot_splits_large_parents(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    kids = spark.createDataFrame([(1, k, f"n{k}") for k in range(25)] + [(2, 0, "a")], "pid long, pos int, name string").repartition(4)
    got = {(r.id, r.part): [c.name for c in r.children] for r in O.nested_snapshot(parents, kids, "id", "pid", ["pos", "name"], "pos", most=10).collect()}
    assert got == {(1, 0): [f"n{k}" for k in range(10)], (1, 1): [f"n{k}" for k in range(10, 20)], (1, 2): [f"n{k}" for k in range(20, 25)],
                   (2, 0): ["a"], (3, 0): []}
