"""Change-driven refresh: a late row rebuilds its own partitions and nothing else."""

import datetime as dt

from pyspark.sql import functions as F

from tests.test_dimensions import files
from wattline.operators import decode as DC
from wattline.session import scratch_path
from wattline.sources import bronze as B
from wattline.sources import refresh as R


def scada(spark, rows):
    """(offset, node, day of the year, solar_mw)"""
    start = dt.datetime(2024, 1, 1)
    return DC.decode_json(spark.createDataFrame(
        [(b"k", f'{{"timestamp":"{(start + dt.timedelta(days=d)).isoformat()}","node_id":"{n}","solar_mw":"{v}"}}'.encode(),
          "energy.bronze.scada", 0, o) for o, n, d, v in rows],
        "key binary, value binary, topic string, partition int, offset long"))


def region(rows):
    return rows.withColumn("region", F.when(F.col("node_id").isin("N1", "N2"), "north").otherwise("south"))


def test_a_late_row_rebuilds_its_partitions_only(spark):
    bronze, gold = scratch_path(spark, "t_rb"), scratch_path(spark, "t_rg")
    assert R.refresh(spark, bronze, gold, region) is None
    rows = [(i, f"N{1 + i % 4}", i % 60, float(i)) for i in range(240)]
    B.land(scada(spark, rows), bronze, 0)
    R.refresh(spark, bronze, gold, region)
    before = files(gold)
    assert R.refresh(spark, bronze, gold, region) is None and files(gold) == before
    late = [(500, "N1", 40, 1000.0), (3, "N4", 3, 3.0)]             # the second one is a re-delivery
    B.land(scada(spark, late), bronze, 1)
    stale = R.refresh(spark, bronze, gold, region).collect()
    assert [(r.region, r.event_date) for r in stale] == [("north", dt.date(2024, 2, 10))]
    after = files(gold)
    gone = {f[len(gold):].rsplit("/", 1)[0] for f, t in before.items() if after.get(f) != t}
    assert gone == {"/fact_day/region=north/event_date=2024-02-10", "/fact_month/region=north/month=2024-02-01"}
    want = {}
    for _, n, d, v in rows + late[:1]:
        key = ("north" if n in ("N1", "N2") else "south", dt.date(2024, 1, 1) + dt.timedelta(days=d), n)
        want[key] = want.get(key, 0) + v
    day = spark.read.parquet(f"{gold}/fact_day").collect()
    assert {(r.region, r.event_date, r.node_id): r.total for r in day} == want
    month = {(r.region, r.month): r.total for r in spark.read.parquet(f"{gold}/fact_month").collect()}
    assert month["north", dt.date(2024, 2, 1)] == sum(v for (g, d, _), v in want.items() if g == "north" and d.month == 2)
    assert sum(month.values()) == sum(want.values())
