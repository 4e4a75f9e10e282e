"""Kafka-shaped message frames.

Layout: ``key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp``.
``publish`` turns rows into messages (key ``node_id:timestamp``, JSON value with every field
quoted and ``_dataset`` added).  ``kafka_source`` reads a topic list with Spark's Kafka source when
its package is on the classpath; ``file_source`` reads the same columns from Parquet files (the
tested source, as no Kafka broker or jar is available here).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import schemas
from wattline.operators.derive import sequence_within
from wattline.sources import tables as T

# Fixed values of the binding: each telemetry source type feeds one topic.
TOPIC_OF_SOURCE = {"view": "energy.bronze.scada", "click": "energy.bronze.weather",
                   "purchase": "energy.bronze.demand", "signup": "energy.bronze.dispatch",
                   "error": "energy.bronze.plants"}
PARTITIONS = 6
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Fault rules of the binding, on the event's props.k (0..99): which messages arrive damaged.
FAULTS = {"null_payload": 7, "truncated": 13, "array": 42, "bad_utf8": 88, "bad_number": 55,
          "no_node": 66, "no_dataset": 77, "bare_numbers": 99,
          "trailing_text": 21, "two_objects": 22, "leading_newline": 23, "other_currency": 24,
          "single_quotes": 25, "forged_end": 26}
CLIMATES = ["desert", "arid", "tropical", "arctic", "mountain", "monsoon", "coastal", "island", "urban",
            "plains", "highland", "temperate", "rainy", "volcanic"]


def message_key(payload: Column) -> Column:
    """S3 key: node_id, else plant_id, else ''; then ':timestamp' when the payload has one."""
    head = F.coalesce(payload["node_id"], payload["plant_id"], F.lit(""))
    return F.when(payload["timestamp"].isNotNull(), F.concat(head, F.lit(":"), payload["timestamp"])).otherwise(head)


def publish(df: DataFrame, topic: str | Column, dataset: str | Column, partitions: int = PARTITIONS,
            offset: str | Column | None = None) -> DataFrame:
    """S3: rows -> messages.  Every column becomes a quoted string field; NULL fields are kept
    (as JSON null) so the consumer sees the same keys on every message of a table."""
    ds = dataset if isinstance(dataset, Column) else F.lit(dataset)
    fields = [F.col(c).cast("string").alias(c) for c in df.columns] + [ds.alias("_dataset")]
    payload = F.struct(*fields)
    value = F.to_json(payload, {"ignoreNullFields": "false"})
    m = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))])
    key = message_key(m) if ("node_id" in df.columns or "plant_id" in df.columns) else F.lit("")
    tp = topic if isinstance(topic, Column) else F.lit(topic)
    off = (F.col(offset) if isinstance(offset, str) else offset) if offset is not None else F.monotonically_increasing_id()
    return df.select(F.encode(key, "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value"),
                     tp.alias("topic"), F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int").alias("partition"),
                     off.cast("long").alias("offset"), F.current_timestamp().alias("timestamp"))


def select_topics(msgs: DataFrame, topics: Sequence[str] | None) -> DataFrame:
    """Keep a subset of topics (short names like 'scada' are expanded)."""
    if not topics:
        return msgs
    full = [t if t.startswith("energy.bronze.") else f"energy.bronze.{t}" for t in topics]
    return msgs.filter(F.col("topic").isin(full))


def kafka_source(spark: SparkSession, servers: str, topics: Sequence[str], max_offsets: int = 500) -> DataFrame:
    """Subscribe to topics from the earliest offset; offsets are committed by the checkpoint
    after the sink succeeds.  Needs the Spark Kafka package on the classpath."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
            .option("maxOffsetsPerTrigger", str(max_offsets)).load()
            .select("key", "value", "topic", "partition", "offset", "timestamp"))


def file_source(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """S5 stand-in: a stream of Parquet files with the Kafka columns."""
    return (spark.readStream.schema(schemas.MESSAGE_SCHEMA).option("maxFilesPerTrigger", str(max_files))
            .parquet(path))


def telemetry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages derived from ``events`` (one per event, partition = node mod 6, broker timestamp = event
    time + k seconds of publishing delay).  A broker numbers the messages of a topic and partition as they
    arrive: offsets are dense, in the order of broker time and event id.

    Payload per topic: the table's key columns plus two metrics (the sample and props.k), with
    currency-suffixed price names by dataset (k < 50 -> 'chile'/usd, else 'ff'/gil).  The FAULTS
    rules damage a fixed share of messages so that every reject path carries rows."""
    k = F.get_json_object("raw", "$.k")
    ki = k.cast("int")
    topic = F.element_at(F.create_map(*[x for a, b in TOPIC_OF_SOURCE.items() for x in (F.lit(a), F.lit(b))]),
                         F.col("source_type"))
    t = T.telemetry(spark, sf_dir).select(
        "*", topic.alias("_topic"), F.pmod(F.col("node_id"), F.lit(PARTITIONS)).cast("int").alias("partition"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(secs=ki.cast("decimal(18,6)"))).alias("timestamp"))
    t = sequence_within(t, ["_topic", "partition"], ["timestamp", "msg_offset"], "offset")
    ds = F.when(ki < 50, F.lit("chile")).otherwise(F.lit("ff"))
    cur = F.when(ds == "chile", F.lit("usd")).otherwise(F.lit("gil"))
    ts_s = F.date_format("ts", ISO)
    node = F.concat(F.lit("N"), F.col("node_id").cast("string"))
    mw_s = F.when(ki == FAULTS["bad_number"], F.lit("n/a")).otherwise(F.col("mw").cast("string"))
    clim = F.element_at(F.array(*[F.lit(c) for c in CLIMATES]), (F.pmod(F.col("node_id"), F.lit(len(CLIMATES))) + 1).cast("int"))

    ppa_cur = F.when(ki == FAULTS["other_currency"], F.lit("eur")).otherwise(cur)

    def on(src: str) -> Column:
        return F.col("source_type") == src

    entries = [
        ("timestamp", F.when(~on("error"), ts_s)),
        ("node_id", F.when(ki != FAULTS["no_node"], node)),
        ("plant_id", F.when(on("error"), F.concat(F.lit("PLT-"), F.col("msg_offset").cast("string")))),
        ("source_type", F.when(on("error"), F.lit("solar"))),
        ("capacity_mw", F.when(on("error"), mw_s)),
        ("solar_mw", F.when(on("view"), mw_s)),
        ("wind_mw", F.when(on("view"), k)),
        ("climate", F.when(on("click"), clim)),
        ("temperature_c", F.when(on("click"), mw_s)),
        ("humidity_pct", F.when(on("click"), k)),
        ("demand_mw", F.when(on("purchase"), mw_s)),
        ("residential_pct", F.when(on("purchase"), k)),
        ("total_generation_mw", F.when(on("signup"), mw_s)),
        *[(f"spot_price_{c}", F.when(on("signup") & (cur == c), k)) for c in ("usd", "gil")],
        *[(f"revenue_{c}", F.when(on("signup") & (cur == c), F.col("mw").cast("string"))) for c in ("usd", "gil")],
        *[(f"ppa_price_{c}_mwh", F.when(on("error") & (ppa_cur == c), k)) for c in ("usd", "gil", "eur")],
        ("lat", F.when(on("error") & (ds == "chile"), F.concat(F.lit("-"), k))),
        ("lon", F.when(on("error") & (ds == "chile"), F.col("mw").cast("string"))),
        ("_dataset", F.when(ki != FAULTS["no_dataset"], ds)),
    ]
    payload = F.struct(*[v.alias(n) for n, v in entries])       # fields without a value are left out of the text
    js = F.to_json(payload)
    body = (F.when(ki == FAULTS["truncated"], F.expr("substring(_js, 1, length(_js) - 1)"))
            .when(ki == FAULTS["trailing_text"], F.concat(F.col("_js"), F.lit(" trailing")))
            .when(ki == FAULTS["two_objects"], F.concat(F.col("_js"), F.col("_js")))
            .when(ki == FAULTS["leading_newline"], F.concat(F.lit("\n"), F.col("_js")))
            .when(ki == FAULTS["single_quotes"], F.translate("_js", '"', "'"))
            .when(ki == FAULTS["forged_end"], F.concat(F.col("_js"), F.lit(',{"end-of-payload":""}]')))
            .when(ki == FAULTS["array"], F.concat(F.lit("["), F.col("_js"), F.lit("]")))
            .when(ki == FAULTS["bare_numbers"], F.regexp_replace("_js", r'"(-?[0-9]+(\.[0-9]+)?)"', "$1"))
            .otherwise(F.col("_js")))
    bad_utf8 = F.concat(F.encode(F.expr("substring(_js, 1, length(_js) - 1)"), "UTF-8"), F.unhex(F.lit("FF")),
                        F.encode(F.lit("}"), "UTF-8"))
    value = (F.when(ki == FAULTS["null_payload"], F.lit(None).cast("binary"))
             .when(ki == FAULTS["bad_utf8"], bad_utf8)
             .otherwise(F.encode(body, "UTF-8")))
    m = t.select("*", payload.alias("_payload"), js.alias("_js"))
    m = m.select(
        F.encode(message_key(F.col("_payload")), "UTF-8").alias("key"), value.alias("value"),
        F.col("_topic").alias("topic"), "partition", "offset", "timestamp")
    return m


def publish_topics(spark: SparkSession, sf_dir: str) -> str:
    """Flow A: write the telemetry messages to a topic store (Parquet, one directory per topic,
    in the shared folder) and return its path.  Consumers scan the store, as they would read a
    broker.  The store is named after the state of its input (files, sizes, times), so a grown or
    changed input gets a new one and an unchanged one is found again, by any process."""
    def write(path: str) -> None:
        # no shuffle of payloads, and none by topic: with a handful of topics that would put a whole topic in one task;
        # each task writes its own rows of every topic (the writer sorts them by topic locally)
        telemetry_messages(spark, sf_dir).write.mode("overwrite").partitionBy("topic").parquet(path)
    return T.derived(spark, f"{sf_dir.rstrip('/')}/events.parquet", "topics", write)


def read_topics(spark: SparkSession, path: str, topics: Sequence[str] | None = None) -> DataFrame:
    """Batch read of the topic store; a topic filter prunes directories."""
    df = spark.read.parquet(path).select("key", "value", "topic", "partition", "offset", "timestamp")
    return select_topics(df, topics)


def payload_k(value: Column) -> Column:
    """The event's props.k as carried by a message of this binding (each topic's second metric
    field holds it); NULL when the payload does not parse."""
    text = F.make_valid_utf8(value.cast("string"))
    fields = ["wind_mw", "humidity_pct", "residential_pct", "spot_price_usd", "spot_price_gil",
              "ppa_price_usd_mwh", "ppa_price_gil_mwh", "ppa_price_eur_mwh"]
    return F.coalesce(*[F.get_json_object(text, f"$.{f}") for f in fields]).try_cast("int")
