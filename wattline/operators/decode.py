"""Bronze decode path (P1-P6, F5, S10, S12): Kafka-shaped rows -> typed table rows + rejects.

Input columns: key, value (BINARY), topic, partition, offset, timestamp.  Every step is a Column
expression on the whole frame; one strict ``from_json`` parses each payload to a map of strings
(numbers arrive as quoted strings, so every field is cast afterwards).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline import schemas

CURRENCIES = ("usd", "gil")
PASS = ["topic", "partition", "offset", "key", "value_text"]   # carried through every step
MONEY = ("spot_price", "ppa_price", "revenue", "curtailment_cost")
#: Values that only a bare number can have after the parse (a bare NaN keeps quotes in a map of strings).
#: Fixed: these are numbers to every consumer of the topics, the short forms are no JSON.
_NUMBERS = {'"NaN"': "NaN", '"Infinity"': "Infinity", '"-Infinity"': "-Infinity"}
_NO_NUMBERS = ('"INF"', '"+INF"')


def decode_json(msgs: DataFrame) -> DataFrame:
    """Text of the value (bad UTF-8 replaced), its fields as a map ``p`` of strings, and the
    reject reason for the message as a whole: null payload, invalid UTF-8, not a JSON object,
    invalid JSON (text after the object, or a second object, included).

    Spark's parser stops after the first value, so the text is parsed as the first element of an
    array that ends with a marker: only a text that is one whole value gives exactly two elements.
    The marker is drawn anew for every plan, so no sender can end the array himself.  Strings in single
    quotes are no JSON; bare NaN and infinities are numbers.
    The parse is the output of a generator, which later projections refer to instead of repeating it."""
    end = uuid.uuid4().hex
    raw = F.col("value").cast("string")
    d = msgs.withColumn("value_text", F.make_valid_utf8(raw))
    whole = F.concat(F.lit("["), F.col("value_text"), F.lit(f',{{"{end}":""}}]'))
    d = d.select("*", F.inline(F.array(F.struct(F.from_json(whole, "array<map<string,string>>", {"allowSingleQuotes": "false"}).alias("_parsed")))))
    one = (F.size("_parsed") == 2) & F.map_contains_key(F.get("_parsed", F.lit(1)), end)
    fields = F.get("_parsed", F.lit(0))
    bare = F.col("value_text").rlike("NaN|INF|Infinity")
    strange = bare & F.exists(F.map_values(fields), lambda v: v.isin(*_NO_NUMBERS))
    numbers = F.create_map(*[F.lit(x) for kv in _NUMBERS.items() for x in kv])
    starts = F.expr(r"trim(LEADING ' \t\n\r' FROM value_text)").startswith("{")
    err = (F.when(F.col("value").isNull(), F.lit("null payload"))
           .when(~F.is_valid_utf8(raw), F.lit("invalid utf-8"))
           .when(~starts, F.lit("not a json object"))
           .when(~F.coalesce(one & ~F.coalesce(strange, F.lit(False)), F.lit(False)), F.lit("invalid json")))
    p = F.when(bare, F.transform_values(fields, lambda k, v: F.coalesce(F.try_element_at(numbers, v), v))).otherwise(fields)
    return d.withColumn("error_message", err).withColumn("p", p).drop("_parsed")


def _money(name: str) -> Column:
    return F.coalesce(F.col(f"p.{name}_gil"), F.col(f"p.{name}_usd"), F.col(f"p.{name}"))


def _ppa() -> Column:
    """The last ``ppa_price_*`` field, whatever its currency; the two that P3 takes are not among them."""
    taken = [f"ppa_price_{c}" for c in CURRENCIES]
    named = F.map_filter("p", lambda k, v: k.startswith("ppa_price_") & ~k.isin(taken))
    return F.try_element_at(F.map_values(named), F.lit(-1))


def normalize_currency(df: DataFrame) -> DataFrame:
    """``x_usd`` / ``x_gil`` -> ``x``; gil wins over usd, either wins over the plain name."""
    return df.withColumns({m: _money(m) for m in MONEY})


def normalize_ppa(df: DataFrame) -> DataFrame:
    """Any ``ppa_price_*`` -> ``ppa_price_mwh``."""
    return df.withColumn("ppa_price_mwh", _ppa())


def declared_field(table: str, name: Column) -> Column:
    """Whether a payload key belongs to the table as declared (money names with their currency included)."""
    known = [n for n, _, _ in schemas.BRONZE_COLUMNS[table]] + ["_dataset", "timestamp", "node_id", "plant_id"]
    money = [name.startswith(f"{m}_") for m in (*MONEY, "ppa_price")]
    out = name.isin(*known, *MONEY)
    for m in money:
        out = out | m
    return out


def project_to_schema(df: DataFrame, table: str, extra: Mapping[str, str] | None = None) -> DataFrame:
    """P5: the table's payload columns in declared order, as strings; a key missing from the
    payload is NULL, unknown keys are dropped but for the ``extra`` ones.  Money columns come from P3/P4
    when present."""
    normalized = set(MONEY) | {"ppa_price_mwh"}
    cols = []
    for n, _, _ in schemas.BRONZE_COLUMNS[table]:
        cols.append((F.col(n) if n in normalized and n in df.columns else F.col(f"p.{n}")).alias(n))
    cols += [F.col("p")[n].alias(n) for n in extra or {}]
    return df.select(*PASS, *cols, F.col("p._dataset").alias("_dataset"))


def cast_typed(df: DataFrame, table: str, extra: Mapping[str, str] | None = None) -> DataFrame:
    """P6 + F5: ``try_cast`` to the declared types (ANSI stays on; a bad value never fails the
    job).  Reasons: a NOT NULL column that is NULL, or a non-NULL string that does not cast.

    ``is_good`` is a plain boolean (an OR of the checks) so that filters on it stay cheap when
    Catalyst pushes them below the projection; the reasons array is only built for output."""
    typed, checks = [], []
    for n, t, nullable in schemas.BRONZE_COLUMNS[table]:
        s = F.col(n)
        v = F.try_to_timestamp(s) if isinstance(t, T.TimestampType) else s.try_cast(t)
        typed.append(v.alias(n))
        checks.append((f"bad {n}", s.isNotNull() & v.isNull()))
        if not nullable:
            checks.append((f"missing {n}", s.isNull()))
    bad = None
    for _, c in checks:
        bad = c if bad is None else (bad | c)
    typed += [F.col(n).try_cast(t).alias(n) for n, t in (extra or {}).items()]
    r = F.filter(F.array(*[F.when(c, F.lit(label)) for label, c in checks]), lambda x: x.isNotNull())
    return df.select(*PASS, *typed, "_dataset", r.alias("reasons"), (~bad).alias("is_good"))


def enrich_meta(df: DataFrame, batch_id: str | Column, with_offsets: bool = True,
                ts_col: str | None = "timestamp") -> DataFrame:
    """Lineage columns; ``_dataset`` defaults to 'unknown'.  Plants carry no partition/offset.
    Series tables also get ``event_date`` (the day of the timestamp) for partitioning."""
    b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    meta = {"_loaded_at": F.current_timestamp(), "_source": F.col("topic"), "_batch_id": b.cast("string")}
    if with_offsets:
        meta.update({"_kafka_partition": F.col("partition").cast("int"), "_kafka_offset": F.col("offset").cast("long")})
    meta["_dataset"] = F.coalesce(F.col("_dataset"), F.lit("unknown"))
    out = df.withColumns(meta)
    if ts_col:
        out = out.withColumn("event_date", F.to_date(ts_col))
    return out


def to_table(decoded: DataFrame, table: str, batch_id: str | Column,
             extra: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Full path for one table's rows of a decoded frame: normalize, project, cast, enrich.
    Returns (good rows in the declared schema, with the ``extra`` columns behind it (name -> type; a value
    that doesn't cast is NULL), rejected rows with their reasons)."""
    ok = decoded.filter(F.col("error_message").isNull())
    ok = normalize_ppa(normalize_currency(ok))
    typed = cast_typed(project_to_schema(ok, table, extra), table, extra)
    good = typed.filter(F.col("is_good")).drop("reasons", "is_good")
    bad = typed.filter(~F.col("is_good")).drop("is_good")
    is_plants = table == "plants"
    good = enrich_meta(good, batch_id, with_offsets=not is_plants, ts_col=None if is_plants else "timestamp")
    cols = [f.name for f in schemas.bronze_schema(table).fields]
    return good.select(*cols, *(extra or {})), bad


def _field(n: str) -> Column:
    """A payload field of a decoded row as its table sees it (money names normalized)."""
    return _money(n) if n in MONEY else _ppa() if n == "ppa_price_mwh" else F.col(f"p.{n}")


def row_reject_reason(decoded: DataFrame) -> Column:
    """The typed-cast reasons of a decoded row for its own topic's table, joined with '; '
    (NULL when the row is good).  One CASE over the topic: every topic is checked in one pass."""
    expr = None
    for topic, table in schemas.TOPIC_TABLE.items():
        parts = []
        for n, t, nullable in schemas.BRONZE_COLUMNS[table]:
            s = _field(n)
            v = F.try_to_timestamp(s) if isinstance(t, T.TimestampType) else s.try_cast(t)
            parts.append(F.when(s.isNotNull() & v.isNull(), F.lit(f"bad {n}")))
            if not nullable:
                parts.append(F.when(s.isNull(), F.lit(f"missing {n}")))
        why = F.nullif(F.concat_ws("; ", *parts), F.lit(""))
        expr = F.when(F.col("topic") == topic, why) if expr is None else expr.when(F.col("topic") == topic, why)
    return expr


def judged(decoded: DataFrame) -> DataFrame:
    """Decoded rows with ``reject``: the message-level error or else the typed-cast reasons, NULL
    for a good row.  It is the output of a generator, so filters and counts don't rebuild it."""
    why = F.coalesce(F.col("error_message"), row_reject_reason(decoded))
    return decoded.select("*", F.inline(F.array(F.struct(why.alias("reject")))))


def outcomes(decoded: DataFrame) -> DataFrame:
    """S12/V16/A2 in one pass: landed and rejected messages of each topic."""
    bad = F.col("reject").isNotNull()
    return judged(decoded).groupBy("topic").agg(F.count_if(~bad).alias("landed"), F.count_if(bad).alias("rejected"))


def dlq_one_pass(decoded: DataFrame, batch_id: str | Column) -> DataFrame:
    """A message is a dead letter for its message-level error or, when it parses, for its
    typed-cast reasons (joined with '; ')."""
    return dead_letters(judged(decoded), batch_id)


def dead_letters(rows: DataFrame, batch_id: str | Column) -> DataFrame:
    """The dead-letter rows among judged rows."""
    b = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return rows.filter(F.col("reject").isNotNull()).select(
        F.current_timestamp().alias("received_at"), "topic", F.col("partition").cast("int").alias("partition_id"),
        F.col("offset").cast("long").alias("offset_id"), F.make_valid_utf8(F.col("key").cast("string")).alias("key"),
        F.col("value_text").alias("value"), F.col("reject").alias("error_message"), b.cast("string").alias("_batch_id"))
