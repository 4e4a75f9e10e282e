"""URL filter by a tree of path templates.

For each host the paths form a tree of segments.  Level by level, a node's frequent children stay
literal and the others (numbers, slugs, ids: variable segments) fall into one wildcard.  Of the literal
children, those whose labelled rate doesn't differ from that of the whole node are merged into the
wildcard as well, so a branch stays apart only where it says something; the others are merged with each
other while they are alike, the most alike first (``~bad1+1`` stands for ``bad1`` and one more).
A path's template is what remains; its labelled bad rate is smoothed towards the rate of the same
template on all hosts, and that towards the rate of the whole table.  Templates at or above the
threshold are rejected.

Rates differ if labels as uneven would come by chance in fewer than ``CHANCE`` cases, by the Chernoff bound
n * KL(rate || other rate) > ln(1 / CHANCE).  It holds for any number of labels, where chi-square needs
expected counts of five or so; a single label never parts a branch.

Every step is an aggregate over distinct paths, combined map-side, or a join with a table of literal
children, written first so that Spark can split a hot host.  Their number is bounded by evidence (pages
and labels of each), not by a share of the host, so it grows with the labelled pages.  They meet in one
row of a node as at most ``CELLS`` + 1 sums, by their rate (cells of equal width on the arcsine scale, where
a rate's spread doesn't depend on it).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log, pi

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import ascii_lower, map_batches, written

#: A child stays literal if it has at least so many pages and labels, and these differ from its node's.
LITERAL_PAGES, LITERAL_LABELS = 4, 2
#: Chance that a branch is parted though it is like its node, and the Chernoff exponent for it.
CHANCE = 0.01
DIFFERS = log(1 / CHANCE)
#: Cells of rates in which the children of a node are compared.
CELLS = 256
#: Pseudo-counts of the smoothing, and the smoothed bad rate from which a template is rejected.
PRIOR, REJECT = 2.0, 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits (struct of rule and verdict), or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _exponent(bad: Column, n: Column, rate: Column) -> Column:
    """n * KL(bad / n || rate)."""
    def part(k: Column, p: Column) -> Column:
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    return part(bad, rate) + part(n - bad, 1 - rate)


def unlike(a: tuple[int, int], b: tuple[int, int]) -> float:
    """The exponent for two (labelled, bad) against their common rate."""
    n, bad = a[0] + b[0], a[1] + b[1]
    return sum(k * log(k * n / (m * whole)) for m, x in (a, b) for k, whole in ((x, bad), (m - x, n - bad)) if k)


def alike(cells: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(cell, group) of (cell, labelled, bad): neighbours in rate are merged while they don't differ, the most alike first."""
    groups = [([c], (n, bad)) for c, n, bad in sorted(cells)]
    while len(groups) > 1:
        off, k = min((unlike(a[1], b[1]), k) for k, (a, b) in enumerate(zip(groups, groups[1:])))
        if off > DIFFERS:
            break
        (x, a), (y, b) = groups[k:k + 2]
        groups[k:k + 2] = [(x + y, (a[0] + b[0], a[1] + b[1]))]
    return [(c, g) for g, (members, _) in enumerate(groups) for c in members]


def named_groups(literal: DataFrame) -> DataFrame:
    """(host, template, segment, name) of the literal children (host, template, segment, labelled, bad) of one level."""
    rate = (F.col("bad") + 0.5) / (F.col("labelled") + 1.0)
    literal = literal.withColumn("cell", F.floor(F.asin(F.sqrt(rate)) * (2 * CELLS / pi)).cast("int"))
    cells = literal.groupBy("host", "template", "cell").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    nodes = cells.groupBy("host", "template").agg(F.collect_list(F.struct("cell", "labelled", "bad")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [alike([(c["cell"], c["labelled"], c["bad"]) for c in cells]) for cells in b.column(2).to_pylist()]
            of = pa.array([i for i, x in enumerate(found) for _ in x], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(of), b.column(1).take(of), pa.array([c for x in found for c, _ in x], pa.int32()),
                 pa.array([g for x in found for _, g in x], pa.int32())], ["host", "template", "cell", "group"])

    groups = written(map_batches(nodes, run, "host string, template string, cell int, group int"), "url-groups")
    of = written(literal.join(groups, ["host", "template", "cell"]).select("host", "template", "segment", "group"), "url-members")
    first = of.groupBy("host", "template", "group").agg(F.min("segment").alias("least"), F.count(F.lit(1)).alias("n"))
    name = F.when(F.col("n") == 1, F.col("least")).otherwise(F.concat(F.lit("~"), "least", F.lit("+"), (F.col("n") - 1).cast("string")))
    return of.join(first, ["host", "template", "group"]).select("host", "template", "segment", name.alias("name"))


def templates(paths: DataFrame) -> DataFrame:
    """Template of each row of ``paths`` (host, path, pages, labelled, bad; a row for each path).

    In each round every node goes down to its first level with literal children, however deep; the levels
    before it are wildcards.  Children can only differ where a node holds labels of both kinds, so paths
    of other nodes, and paths that end before such a level, are done.
    """
    sums = [F.sum(c).alias(c) for c in ("pages", "labelled", "bad")]
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    rows = written(paths.withColumn("segments", segments).withColumn("template", F.lit(""))
                   .withColumn("at", F.lit(0)), "url-paths")
    done = []
    while True:
        below = rows.select("host", "template", "at", "pages", "labelled", "bad", F.posexplode("segments").alias("pos", "segment")).where("pos >= at")
        nodes = below.groupBy("host", "template", "pos").agg(*sums).where("bad > 0 and bad < labelled")
        nodes = written(nodes.select("host", "template", "pos", F.col("labelled").alias("all_labelled"), F.col("bad").alias("all_bad")), "url-nodes")
        children = below.groupBy("host", "template", "pos", "segment").agg(*sums).where(F.col("pages") >= LITERAL_PAGES)
        children = written(children.where("labelled > 0"), "url-children")
        differs = _exponent(F.col("bad"), F.col("labelled"), (F.col("all_bad") + 0.5) / (F.col("all_labelled") + 1.0)) > DIFFERS
        literal = written(children.join(nodes, ["host", "template", "pos"]).where((F.col("labelled") >= LITERAL_LABELS) & differs)
                          .select("host", "template", "pos", "segment", "labelled", "bad"), "url-literal")
        level = written(literal.groupBy("host", "template").agg(F.min("pos").alias("level")), "url-levels")
        if level.isEmpty():
            break
        # children of deeper levels are of no use: their nodes may be others once this level has parted them
        literal = written(literal.join(level, ["host", "template"]).where("pos = level").drop("pos", "level"), "url-literal")
        literal = written(named_groups(literal).select("host", "template", F.col("segment").alias("_segment"), F.col("name").alias("_literal")), "url-literal")
        step = rows.join(level, ["host", "template"], "left").withColumn("_segment", F.get("segments", "level"))
        step = step.join(literal, ["host", "template", "_segment"], "left")
        name = F.concat(F.expr("repeat('/*', level - at)"), F.lit("/"), F.coalesce("_literal", F.lit("*")))
        parted = F.coalesce(F.size("segments") > F.col("level"), F.lit(False))
        step = written(step.select(*paths.columns, "segments", F.when(parted, F.concat("template", name)).otherwise(F.col("template")).alias("template"),
                                   F.when(parted, F.col("level") + 1).otherwise(F.col("at")).alias("at"), parted.alias("parted")), "url-paths")
        done.append(step.where("not parted").drop("parted"))
        rows = step.where("parted").drop("parted")
    for part in done:
        rows = rows.unionByName(part)
    return rows.withColumn("template", F.expr("concat(template, repeat('/*', size(segments) - at))")).drop("segments", "at")


def judge(paths: DataFrame) -> DataFrame:
    """(host, template, bad_rate): the smoothed bad rate of each template in ``paths``."""
    per = written(paths.groupBy("host", "template").agg(
        F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")), "url-templates")
    everywhere = per.groupBy("template").agg(F.sum("labelled").alias("t_labelled"), F.sum("bad").alias("t_bad"))
    whole = per.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("labelled"), F.lit(0)) + 1.0)).alias("base"))
    base = float(whole.first()["base"])
    prior = (F.col("t_bad") + PRIOR * base) / (F.col("t_labelled") + PRIOR)
    rate = (F.col("bad") + PRIOR * prior) / (F.col("labelled") + PRIOR)
    return written(per.join(written(everywhere, "url-everywhere"), "template")
                   .select("host", "template", rate.alias("bad_rate")), "url-rates")


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                label: Column | None = None) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``bad_rate``.

    ``label`` is true for bad pages, false for good ones, null for unknown ones; by default the pages
    that a rule decides are the labelled ones.  A rule's verdict stands; the others get the method's.
    Null urls and urls without ``://`` have an empty host and path and form one template.  Repeated rows
    get the same result, an empty table none.  Other columns are read only through ``label``.
    """
    url = F.col(url_col)
    parts = pages.select(F.col(id_col).alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"),
                         (label if label is not None else F.lit(None).cast("boolean")).alias("_label"))
    ruled = parts.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    bad = F.col("_label") if label is not None else F.col("_rule.verdict") == "block"
    paths = ruled.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"), F.count(bad).alias("labelled"), F.coalesce(F.count_if(bad), F.lit(0)).alias("bad"))
    named = templates(paths)
    rates = judge(named)
    known = written(named.join(rates, ["host", "template"]).select("host", "path", "template", "bad_rate"), "url-known")
    return (ruled.join(known, ["host", "path"])
            .select(id_col, "host", "path", F.col("_rule.rule").alias("rule"),
                    F.coalesce(F.col("_rule.verdict"), F.when(F.col("bad_rate") >= REJECT, "block").otherwise("allow")).alias("verdict"),
                    "template", F.round("bad_rate", 6).alias("bad_rate")))
