"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies r = target / size of the source.
Its whole part is taken outright; the fractional part becomes 0 or 1 by pivotal rounding on words:
two documents with fractional probabilities trade words (one up, one down, by chance, so that both
keep their expectation) until one of them is integral; the other meets the next one.  The words a
source takes change only when the last fractional document is rounded, so each source ends within
one document of its target.

The rounding runs as a reduction tree: documents of a source are dealt by a hash into blocks of about
``BLOCK`` (a hot source only has more blocks), a block folds its documents and passes on the one that
is still fractional, and blocks of blocks fold those until one per source is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import WORD, free_name, uniform, written
from wattline.operators.derive import sequence_within

#: Documents per block on average, and blocks per node of the tree.
BLOCK = 64
#: Source tables up to this many bytes are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 8 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, words, docs): one row per source.

    Sources in code point order (null last) weigh ``weights``, repeating.  The budget is ``share``
    of all words.  A target stops at ``most`` times its source's words, and what it leaves is shared
    by weight among the others until none is above: with sources in the order of limit / weight, the
    first k are at their limit and the others get a common rate per weight; k is the first for which
    that rate fits the next source.  The windows run over sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, len(weights)) + 1)
    rated = (sizes.withColumn("weight", weight.cast("double"))
             .withColumn("limit", F.col("words") * F.lit(float(most))))
    by_rate = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    up_to_here = by_rate.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rate = ((F.sum("words").over(everything) * F.lit(share) - F.coalesce(F.sum("limit").over(up_to_here), F.lit(0.0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(up_to_here), F.lit(0.0))))
    fits = rated.withColumn("rate", rate).withColumn("limit_rate", F.col("limit") / F.col("weight"))
    level = F.max(F.when(F.col("rate") <= F.col("limit_rate"), F.col("rate"))).over(everything)
    return (fits.withColumn("target", F.least(F.col("limit"), F.coalesce(level, F.col("limit_rate")) * F.col("weight")))
            .select("source", F.col("words").alias("source_size"), "docs", "weight", "target"))


def _fold(items: Column, seed: int) -> Column:
    """Fold an array of (doc, n, size, p) into (open: the item still fractional, done: items with p in {0, 1})."""
    empty = F.filter(items, lambda x: F.lit(False))

    def item(x: Column, p: Column) -> Column:
        return F.struct(x["doc"].alias("doc"), x["n"].alias("n"), x["size"].alias("size"), p.alias("p"))

    def step(acc: Column, x: Column) -> Column:
        o = acc["open"]
        up, down = (1 - o["p"]) * o["size"], o["p"] * o["size"]          # words o can take or give
        x_up, x_down = (1 - x["p"]) * x["size"], x["p"] * x["size"]
        a, b = F.least(up, x_down), F.least(down, x_up)                   # o rises by a, or falls by b
        draw = uniform(o["doc"], o["n"], x["doc"], x["n"], seed=seed)
        rises = draw * (a + b) < b
        whole_o = F.when(rises, up <= x_down).otherwise(down <= x_up)     # o becomes integral, else x does
        end_o = F.when(rises, 1.0).otherwise(0.0)
        new_x = F.when(whole_o, F.when(rises, x["p"] - a / x["size"]).otherwise(x["p"] + b / x["size"])).otherwise(1 - end_o)
        new_o = F.when(whole_o, end_o).otherwise(F.when(rises, o["p"] + a / o["size"]).otherwise(o["p"] - b / o["size"]))
        settled = (o["p"] <= 0) | (o["p"] >= 1)
        out = (F.when(settled, item(o, o["p"])).when(whole_o, item(o, new_o)).otherwise(item(x, new_x)))
        keep = (F.when(settled, item(x, x["p"]))
                .when(whole_o, item(x, F.greatest(F.lit(0.0), F.least(F.lit(1.0), new_x))))
                .otherwise(item(o, F.greatest(F.lit(0.0), F.least(F.lit(1.0), new_o)))))
        return F.struct(keep.alias("open"), F.concat(acc["done"], F.array(out)).alias("done"))

    first = F.struct(F.element_at(items, 1).alias("open"), empty.alias("done"))
    return F.aggregate(F.slice(items, F.lit(2), F.size(items)), first, step)


def _level(items: DataFrame, depth: int, seed: int) -> DataFrame:
    """Fold the items of each (source, block), long documents first, so that the one left open tends
    to be short: one row per block."""
    grouped = items.groupBy("source", "block").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("size")).alias("order"), "doc", "n", "size", "p"))).alias("items"))
    plain = F.transform("items", lambda x: F.struct(x["doc"].alias("doc"), x["n"].alias("n"),
                                                    x["size"].alias("size"), x["p"].alias("p")))
    return grouped.select("source", "block", plain.alias("items")).select(
        "source", "block", _fold(F.col("items"), seed + depth).alias("folded"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", by_text: bool = False) -> DataFrame:
    """Copies of each document: id, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    Null texts and texts without words have size 0 and 0 copies.  Null sources form the last source.
    Rows with the same id, source and size are numbered and rounded one by one.  Draws hash ids,
    so runs agree whatever the partitioning.  An empty table gives no rows.  Other columns of
    ``docs`` aren't read.  With ``by_text`` an id may stand on several texts, which are told apart by
    ``text_hash``; ``k`` numbers the rows that agree in all (see ``repeat_rows``).
    """
    hashes = [F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash")] if by_text else []
    marks = ["text_hash"] if by_text else []
    rows = written(docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"),
                               word_count(F.col(text_col)).alias("size"), *hashes)
                   .groupBy("doc", "source", "size", *marks).agg(F.count(F.lit(1)).alias("times")), "mixing-sizes")
    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("words"),
                                       F.sum(F.when(F.col("size") > 0, F.col("times")).otherwise(0)).alias("docs"))
    targets = written(source_targets(sizes, weights, share, most), "mixing-targets")
    stats = targets.agg(F.max("docs").alias("docs"), F.sum(F.octet_length("source") + 64).alias("bytes")).first()
    small = F.broadcast(targets) if (stats["bytes"] or 0) <= BROADCAST_BYTES else targets
    each = (rows.withColumnRenamed("source", "_source")
            .join(small, F.col("_source").eqNullSafe(F.col("source"))).drop("_source")
            .withColumn("n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("times"))
    if by_text:
        each = each.withColumnRenamed("n", "k").withColumn("n", F.xxhash64("text_hash", "k"))
        marks = ["text_hash", "k"]
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    each = each.withColumn("whole", F.when(F.col("size") > 0, F.floor(rate)).otherwise(0)).withColumn(
        "p", F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0))

    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK), F.lit(1))
    first = (each.where("p > 0")
             .withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc", "n", "size"), blocks))
             .select("source", "block", "doc", "n", F.col("size").cast("double").alias("size"), "p"))
    levels = [written(_level(first, 0, seed), "mixing-level")]
    left = -(-(stats["docs"] or 0) // BLOCK)  # blocks of the largest source
    while left > 1:
        up = levels[-1].select("source", F.floor(F.col("block") / BLOCK).alias("block"), "folded.open.*")
        levels.append(written(_level(up, len(levels), seed), "mixing-level"))
        left = -(-left // BLOCK)
    done = [lv.select("source", F.explode("folded.done").alias("x")).select("source", "x.*") for lv in levels]
    last = levels[-1].select("source", "folded.open.*").withColumn(
        "p", F.when(uniform(F.col("doc"), F.col("n"), seed=seed - 1) < F.col("p"), 1.0).otherwise(0.0))
    rounded = last
    for d in done:
        rounded = rounded.unionByName(d)
    rounded = rounded.select(F.col("source").alias("_s"), F.col("doc").alias("_d"), F.col("n").alias("_n"),
                             F.col("size").cast("long").alias("_size"), F.col("p").cast("long").alias("extra"))
    joined = each.join(rounded, F.col("doc").eqNullSafe(F.col("_d")) & (F.col("n") == F.col("_n"))
                       & (F.col("size") == F.col("_size")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    copies = (F.col("whole") + F.coalesce(F.col("extra"), F.lit(0))).cast("long")
    return joined.select(F.col("doc").alias(id_col), "source", "size", "source_size", "target",
                         copies.alias("copies"), (copies * F.col("size")).alias("taken"), *marks)


def repeat_rows(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` (by text) takes it.

    Rows that agree in id, text and source are numbered first (in any order, as they are alike), by slices of
    the order of all of them, so no group meets in one task.
    """
    names = [free_name(docs, n) for n in ("_id", "_text", "_source", "_k", "_copies")]
    key, text, source, k, times = names
    rows = docs.withColumn(text, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    group = ["doc", "text_hash", "source"]
    taken = mixed.select(F.col(id_col).alias("doc"), "text_hash", "source", "k", "copies")
    alike = written(taken.where("k > 1").select(*group).distinct(), "mixing-alike")

    def same(a: list[str], b: list[str]) -> Column:
        return F.col(a[0]).eqNullSafe(F.col(b[0])) & (F.col(a[1]) == F.col(b[1])) & F.col(a[2]).eqNullSafe(F.col(b[2]))

    on = same([id_col, text, source_col], [key, text + "_", source])
    taken = taken.where("copies > 0").select(F.col("doc").alias(key), F.col("text_hash").alias(text + "_"),
                                             F.col("source").alias(source), F.col("k").alias(k), F.col("copies").alias(times))
    if not alike.take(1):
        both = rows.join(taken, on)
    else:
        few = alike.select(*[F.col(c).alias(f"_a_{c}") for c in group])
        match = same([id_col, text, source_col], ["_a_doc", "_a_text_hash", "_a_source"])
        single, several = rows.join(few, match, "left_anti"), rows.join(few, match, "left_semi")
        place = free_name(rows, "_place")
        # keys without nulls, as the order of slices is joined on them
        ids = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((id_col, "_g"), (source_col, "_s"))]
        ids += [F.col(id_col).isNull().alias("_gn"), F.col(source_col).isNull().alias("_sn")]
        kept = written(several.withColumn(place, F.monotonically_increasing_id()), "mixing-several")
        number = sequence_within(kept.select(place, text, *ids), ["_g", "_gn", "_s", "_sn", text], [place], "_number")
        numbered = kept.join(number.select(F.col(place).alias("_p"), "_number"), F.col(place) == F.col("_p")).drop(place, "_p")
        both = (single.join(taken, on).unionByName(
            numbered.join(taken, on & (F.col(k) == F.col("_number") + 1)).drop("_number")))
    return both.withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)
