"""Gold facts and rollups.

Each operator takes DataFrames with the energy column names and returns a lazy DataFrame.  Money
and energy totals are summed in DECIMAL (``exact_sum``) so a total does not depend on how rows were
partitioned; ratios are ratios of those totals, never averages of ratios.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.functions.columns import (
    carbon_offset, day, exact_sum, hour_ts, month, ratio,
)
from wattline.operators.derive import dense_sequence
from wattline.session import materialized


def fact_revenue(gen: DataFrame, plants: DataFrame, keys: Sequence[str] = ("region",),
                 period: str = "month") -> DataFrame:
    """MWh, revenue, PPA settlement (MWh x the plant's contract price), spot revenue (MWh x the
    row's spot price, i.e. revenue x (1 + spot adjustment)) and blended price (= sum revenue / sum MWh,
    NULL without MWh) per keys and period.

    The plant side is joined on ``plant_id`` without a hint: AQE broadcasts it when its runtime
    size is under the threshold and keeps a sort-merge join (with skew splitting) otherwise."""
    per = month if period == "month" else day
    g = gen.select("plant_id", per("ts").alias(period), "mwh", "revenue", "spot_adj")
    j = g.join(plants.select("plant_id", "ppa_price", *keys), "plant_id")
    return (j.groupBy(*keys, period)
            .agg(exact_sum("mwh", 2, "mwh"),
                 exact_sum("revenue", 2, "revenue"),
                 exact_sum(F.col("mwh") * F.col("ppa_price"), 2, "ppa_revenue"),
                 exact_sum(F.col("revenue") * (F.lit(1) + F.col("spot_adj")), 4, "spot_revenue"),
                 F.count(F.lit(1)).alias("n_rows"))
            .withColumn("blended_price", ratio("revenue", "mwh")))


def fact_generation(samples: DataFrame, capacity: DataFrame, feed_seconds: int = 300) -> DataFrame:
    """Per (plant, hour): MWh = mean MW x 1 h, availability = samples with MW > 0 over the
    expected count (3600 / feed seconds), capped at 1, capacity factor = MWh / capacity."""
    expected = 3600 // feed_seconds
    h = (samples.groupBy("plant_id", hour_ts("ts").alias("hour"))
         .agg(F.count("mw").alias("samples"),
              exact_sum("mw", 4, "mw_sum"),
              F.count_if(F.col("mw") > 0).alias("positive")))
    out = (h.join(capacity.select("plant_id", "capacity_mw"), "plant_id", "left")
           .select("plant_id", "hour", "samples",
                   (F.col("mw_sum") / F.col("samples")).alias("mwh"),
                   F.least(F.lit(1.0), F.col("positive") / F.lit(float(expected))).alias("availability"),
                   "capacity_mw"))
    return out.withColumn("capacity_factor", ratio("mwh", "capacity_mw")).drop("capacity_mw")


def node_day_generation(gen: DataFrame, plants: DataFrame) -> DataFrame:
    """Generation per (node, day): MWh and curtailed MWh, pre-aggregated before any further join."""
    g = gen.select("plant_id", day("ts").alias("day"), "mwh", "curtailed")
    return (g.join(plants.select("plant_id", "node_id"), "plant_id")
            .groupBy("node_id", "day")
            .agg(exact_sum("mwh", 2, "generation_mwh"), exact_sum("curtailed", 4, "curtailed_mwh")))


def node_day_demand(dem: DataFrame) -> DataFrame:
    return (dem.groupBy("node_id", day("ts").alias("day"))
            .agg(exact_sum("demand_mw", 6, "demand_mwh")))


def fact_dispatch(gen_nd: DataFrame, dem_nd: DataFrame) -> DataFrame:
    """A10: curtailment rate = sum curtailed / sum generated and net balance per (node, day).
    Both sides are aggregated to (node, day) before the full-outer join."""
    j = gen_nd.join(dem_nd, ["node_id", "day"], "full")
    return j.select(
        "node_id", "day", "generation_mwh", "curtailed_mwh", "demand_mwh",
        ratio("curtailed_mwh", "generation_mwh").alias("curtailment_rate"),
        (F.coalesce("generation_mwh", F.lit(0.0)) - F.coalesce("demand_mwh", F.lit(0.0))).alias("net_balance_mwh"),
    )


def fact_carbon(gen: DataFrame, plants: DataFrame, factor: float = 0.42) -> DataFrame:
    """tCO2e avoided per (node, month) = sum MWh x grid factor."""
    g = gen.select("plant_id", month("ts").alias("month"), "mwh")
    return (g.join(plants.select("plant_id", "node_id"), "plant_id")
            .groupBy("node_id", "month")
            .agg(exact_sum("mwh", 2, "mwh"))
            .withColumn("tco2e_avoided", carbon_offset("mwh", factor)))


def asset_health(samples: DataFrame) -> DataFrame:
    """A12 uptime: hours of the day with any output > 0, over 24."""
    hourly = (samples.groupBy("node_id", hour_ts("ts").alias("hour"))
              .agg(F.max(F.col("mw") > 0).alias("up")))
    return (hourly.groupBy("node_id", day("hour").alias("day"))
            .agg(F.count_if("up").alias("hours_up"))
            .withColumn("uptime_pct", F.col("hours_up") * F.lit(100.0) / F.lit(24.0)))


def lcoe(gen: DataFrame, rate: float = 0.07) -> DataFrame:
    """A12 LCOE per plant = sum_y cost_y/(1+r)^y / sum_y MWh_y/(1+r)^y, y = year - first year.

    Cost and MWh are first reduced to (plant, year) so the discounting runs on few rows."""
    py = (gen.groupBy("plant_id", F.year("ts").alias("year"))
          .agg(exact_sum(F.col("revenue") * F.col("spot_adj"), 6, "cost"), exact_sum("mwh", 2, "mwh")))
    w = Window.partitionBy("plant_id")
    disc = F.pow(F.lit(1.0 + rate), F.col("year") - F.min("year").over(w))
    d = py.select("plant_id",
                  (F.col("cost") / disc).cast("decimal(30,4)").alias("dcost"),
                  (F.col("mwh") / disc).cast("decimal(30,4)").alias("dmwh"))
    return (d.groupBy("plant_id")
            .agg(F.sum("dcost").cast("double").alias("discounted_cost"),
                 F.sum("dmwh").cast("double").alias("discounted_mwh"))
            .withColumn("lcoe", F.round(ratio("discounted_cost", "discounted_mwh"), 6)))


def system_totals(gen: DataFrame, dem: DataFrame, factor: float = 0.42) -> DataFrame:
    """A3: one row of system totals.  The two inputs are tagged and unioned, then reduced by one
    global aggregate (partial aggregation per task, a single tiny final step; no join)."""
    u = (gen.select(F.col("mwh").alias("g"), F.col("curtailed").alias("c"), F.lit(None).cast("double").alias("d"))
         .unionByName(dem.select(F.lit(None).cast("double").alias("g"), F.lit(None).cast("double").alias("c"),
                                 F.col("demand_mw").alias("d"))))
    t = u.agg(exact_sum("g", 2, "generation_mwh"), exact_sum("c", 4, "curtailed_mwh"),
              exact_sum("d", 6, "demand_mwh"))
    return t.select("*", carbon_offset("generation_mwh", factor).alias("tco2e_avoided"),
                    (F.col("generation_mwh") - F.col("demand_mwh")).alias("net_balance_mwh"))


def hourly_profile(samples: DataFrame, sources: Sequence[str]) -> DataFrame:
    """A4: 24 hour-of-day buckets, total MW and one column per source (pivot with fixed values, so
    no extra job is needed to find them)."""
    s = samples.select(F.hour("ts").alias("hour"), "source_type", F.col("mw").cast("decimal(28,4)").alias("mw"))
    p = s.groupBy("hour").pivot("source_type", list(sources)).agg(F.sum("mw"))
    tot = sum((F.coalesce(F.col(x), F.lit(0)) for x in sources), F.lit(0))
    return p.select("hour", tot.cast("double").alias("total_mw"),
                    *[F.col(x).cast("double").alias(f"mw_{x}") for x in sources])


def mix_by_node(samples: DataFrame) -> DataFrame:
    """MW per (node, source), its share of the node total (window over the node's sources)
    and the node's place by total MW (largest first, ties by id)."""
    units = F.sum(F.rint(F.col("mw") * F.lit(1e4)).cast("long"))
    agg = materialized(samples.groupBy("node_id", "source_type").agg(units.alias("_u")), "mix")      # the one scan
    total = agg.groupBy("node_id").agg((F.sum("_u").cast("double") / F.lit(1e4)).alias("total"))
    agg = agg.withColumn("mw", F.col("_u").cast("double") / F.lit(1e4))
    ranked = dense_sequence(total.withColumn("_down", -F.col("total")), ["_down", "node_id"], "node_rank")
    return (agg.join(ranked.select("node_id", "total", "node_rank"), "node_id")
            .select("node_id", "source_type", "mw", F.round(F.col("mw") / F.col("total"), 6).alias("share"), "node_rank"))


def capacity_vs_demand(plants: DataFrame, dem: DataFrame) -> DataFrame:
    """Installed capacity and daily demand (mean and peak) per node, from north to south:
    ordered by latitude, with the place in that order (nodes are the 25 nations)."""
    cap = plants.groupBy("node_id", "node_name", "region", "latitude").agg(exact_sum("capacity_mw", 2, "capacity_mw"))
    daily = node_day_demand(dem)
    d = daily.groupBy("node_id").agg(
        F.max("demand_mwh").alias("peak_demand_mwh"),
        F.round(F.avg("demand_mwh"), 6).alias("avg_demand_mwh"))
    north = Window.orderBy(F.col("latitude").desc(), "node_id")
    return cap.join(d, "node_id", "left").withColumn("north_rank", F.row_number().over(north).cast("long")).orderBy("north_rank")


def node_revenue(gen: DataFrame, plants: DataFrame) -> DataFrame:
    """Revenue and curtailment cost (= revenue x curtailment rate) per node."""
    g = gen.select("plant_id", "revenue", (F.col("revenue") * F.col("curtail_rate")).alias("ccost"))
    return (g.join(plants.select("plant_id", "node_id"), "plant_id")
            .groupBy("node_id")
            .agg(exact_sum("revenue", 2, "revenue"), exact_sum("ccost", 6, "curtailment_cost")))


def heatmap(samples: DataFrame) -> DataFrame:
    """Node x hour-of-day mean MW, hours as 24 fixed pivot columns h00..h23."""
    s = samples.select("node_id", F.hour("ts").alias("hour"), F.col("mw").cast("decimal(28,4)").alias("mw"))
    p = s.groupBy("node_id").pivot("hour", list(range(24))).agg(
        (F.sum("mw").cast("double") / F.count("mw")).alias("avg"))
    return p.select("node_id", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def rollup_region_node_day(gen: DataFrame, plants: DataFrame) -> DataFrame:
    """ROLLUP(region, node, day) of MWh and revenue, with the grouping id."""
    g = gen.select("plant_id", day("ts").alias("day"), "mwh", "revenue")
    j = g.join(plants.select("plant_id", "region", "node_id"), "plant_id")
    return j.rollup("region", "node_id", "day").agg(
        exact_sum("mwh", 2, "mwh"), exact_sum("revenue", 2, "revenue"), F.grouping_id().alias("gid"))


def cube_status(gen: DataFrame) -> DataFrame:
    """CUBE(status, flag) of MWh and row count."""
    return gen.cube("status", "flag").agg(
        exact_sum("mwh", 2, "mwh"), F.count(F.lit(1)).alias("n_rows"), F.grouping_id().alias("gid"))


def grouping_sets_billing(gen: DataFrame, plants: DataFrame) -> DataFrame:
    """A17 monthly billing: GROUPING SETS ((region, month), (node, month), ())."""
    g = gen.select("plant_id", month("ts").alias("month"), "revenue")
    j = g.join(plants.select("plant_id", "region", "node_id"), "plant_id")
    return j.groupingSets([["region", "month"], ["node_id", "month"], []], "region", "node_id", "month").agg(
        exact_sum("revenue", 2, "revenue"), F.grouping_id().alias("gid"))


def month_to_date(daily: DataFrame, key: str, value: str) -> DataFrame:
    """Running total inside (key, month), ordered by day."""
    w = (Window.partitionBy(key, month("day")).orderBy("day")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.withColumn("mtd_" + value,
                            F.sum(F.col(value).cast("decimal(28,2)")).over(w).cast("double"))


def top_k(df: DataFrame, part: str, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows per partition (row_number <= k: Spark plans a WindowGroupLimit, so each
    task keeps only k rows per group before the shuffle)."""
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def seasonal_naive_forecast(hourly: DataFrame, k_days: int = 7, holdout_days: int = 3) -> DataFrame:
    """forecast = mean of the same (node, hour of day) over the previous k days; MAPE on the
    last ``holdout_days`` days (found with a scalar subquery, not a join)."""
    h = hourly.select("node_id", day("hour").alias("day"), F.hour("hour").alias("hod"), "mw")
    dn = F.unix_date("day")
    w = Window.partitionBy("node_id", "hod").orderBy(dn).rangeBetween(-k_days, -1)
    f = h.withColumn("forecast", F.avg("mw").over(w))
    last = hourly.select(F.max(day("hour"))).scalar()
    held = f.filter((F.col("day") > F.date_sub(last, holdout_days)) & F.col("forecast").isNotNull()
                    & (F.col("mw") != 0))
    return held.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.round(F.avg(F.abs(F.col("mw") - F.col("forecast")) / F.abs(F.col("mw"))), 4).alias("mape"))


def success_rate(runs: DataFrame, target: float = 0.95) -> DataFrame:
    """Share of successful runs per day and the verdict against the target."""
    r = runs.groupBy(day("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col("status") == "success").alias("succeeded"))
    return r.select("*", (F.col("succeeded") / F.col("runs")).alias("success_rate"),
                    F.when(F.col("succeeded") / F.col("runs") >= target, "pass").otherwise("fail").alias("verdict"))


def cost_vs_budget(costs: DataFrame, budget: DataFrame, scale: int = 6) -> DataFrame:
    """Actual per service vs a [low, high] budget band (budget is a small literal frame with
    one row per service, so it is broadcast)."""
    a = costs.groupBy("service").agg(exact_sum("cost", scale, "actual"))
    return a.join(F.broadcast(budget), "service", "left").select(
        "service", "actual", "budget_low", "budget_high",
        F.when(F.col("budget_high").isNull(), "no_budget")
         .when(F.col("actual") > F.col("budget_high"), "over")
         .when(F.col("actual") < F.col("budget_low"), "under")
         .otherwise("within").alias("status"))


def workload_pivot(tasks: DataFrame, owners: Sequence[str]) -> DataFrame:
    """Points per sprint x owner, with the row total."""
    p = tasks.groupBy("sprint").pivot("owner", list(owners)).agg(F.sum("points"))
    cols = [F.coalesce(F.col(o), F.lit(0)).alias(f"pts_{i}") for i, o in enumerate(owners)]
    out = p.select("sprint", *cols)
    return out.withColumn("total", sum((F.col(f"pts_{i}") for i in range(len(owners))), F.lit(0)))
