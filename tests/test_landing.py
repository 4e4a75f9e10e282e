"""File feeds: broken records are kept with their text and don't take their neighbours along."""

from pyspark.sql import functions as F

from wattline.session import scratch_path
from wattline.sources import landing as L


def rows(spark):
    data = [(k, f"N{k}" if k % 7 else None, str(k * 1.5) if k % 11 else "n/a", ["chile", None][k % 2], k % 5 == 3) for k in range(200)]
    return data, spark.createDataFrame(data, "offset long, node_id string, metric string, _dataset string, damaged boolean")


def test_feeds(spark):
    for feed in L.FEEDS:
        data, df = rows(spark)
        path = scratch_path(spark, f"t_{feed}")
        L.write(feed, df.repartition(3), path)
        got = L.read(spark, feed, path).collect()
        assert len(got) == 200 and all((r.raw is not None) == r.is_corrupt for r in got)
        want = sorted((n, float(m) if m != "n/a" else None, d) for _, n, m, d, bad in data if not bad and n and d)
        assert sorted((r.node_id, r.metric, r._dataset) for r in got if not r.is_corrupt and r.node_id and r._dataset and r.metric is not None) == [
            w for w in want if w[1] is not None]
        assert sum(r.is_corrupt for r in got) == 40 and all(r.node_id is None and r.metric is None for r in got if r.is_corrupt)
        assert all(f"t_{feed}" in r.file for r in got)


def test_empty_and_strange_records(spark):
    for feed, lines in {"trading": ["", "{}", "[1]", '{"trade":{"legs":[]}}', "{'trade':1}"], "erp": ["", " " * 82, "x"],
                        "meter": ["", "H|x", "T|y", "D|1||1.5|", "D", "D|1|N1|zz|ff"]}.items():
        path = scratch_path(spark, f"t_{feed}_odd")
        (spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write
         .option("lineSep", L.SEPARATOR if feed == "trading" else "\n").text(path))
        got = L.read(spark, feed, path).select("metric", "is_corrupt").collect()
        assert sum(r.metric is not None for r in got) == {"trading": 1, "erp": 0, "meter": 1}[feed]      # no legs: 0.0
    empty = scratch_path(spark, "t_none")
    L.write("erp", rows(spark)[1].filter(F.lit(False)), empty)
    assert L.read(spark, "erp", empty).count() == 0
