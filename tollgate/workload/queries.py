"""One query per operator over the driver tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions import jsonx
from tollgate.model import RAW, STANDARD
from tollgate.operators import batching, enrich, raw, routing, schema_driven, standard, transforms, validate
from tollgate.plans import reports, tables
from tollgate.plans.revisions import Range
from tollgate.session import configure
from tollgate.sources import messages as sources
from tollgate.streaming import jobs, stateful
from tollgate.workload import messages as workload
from tollgate.workload.definitions import (
    EPOCH_MICROS,
    EPOCH_MILLIS,
    ORDER,
    REVISION_1,
    REVISION_2,
    RIDE_V1,
    RIDE_V1_FIELDS,
    RIDE_V2,
    RIDE_V2_FIELDS,
    SCHEMA_NAME,
)

SUBSCRIPTION = "rides-sub"
NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
RIDE_V1_NAMES = [f["name"] for f in RIDE_V1_FIELDS]
RIDE_V2_NAMES = [f["name"] for f in RIDE_V2_FIELDS]

Query = Callable[[SparkSession, str], DataFrame]


def _clock() -> Column:
    return F.lit(NOW)


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, all of them being UTC."""
    return df.select(
        *[
            F.col(jsonx.quoted(name)).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(jsonx.quoted(name))
            for name, kind in df.dtypes
        ]
    )


def _standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standard.parse_standard(workload.events_as_messages(spark, sf_dir), SUBSCRIPTION, _clock())


def _raw(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    messages = workload.events_as_messages(spark, sf_dir, faults)
    return raw.parse_raw(messages, SUBSCRIPTION, _clock())


def _clean(spark: SparkSession, sf_dir: str, enriched: str = workload.ODD) -> DataFrame:
    return workload.events_as_messages(spark, sf_dir, faults=False, enriched=enriched)


def _v2_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_driven.parse_schema_driven(_clean(spark, sf_dir), SUBSCRIPTION, RIDE_V2, _clock())


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = workload.events_as_messages(spark, sf_dir)
    return schema_driven.parse_schema_driven(messages, SUBSCRIPTION, RIDE_V1, _clock(), "quarantine")


def src_messages(spark, sf_dir):
    messages = workload.events_as_messages(spark, sf_dir)
    return _plain(
        messages.select("message_id", "publish_time", F.size("attributes").cast("bigint").alias("n_attributes"))
    )


def utf8_routing(spark, sf_dir):
    text = jsonx.decode_utf8(F.col("data"))
    payload = F.coalesce(text, F.concat(F.lit("0x"), F.hex("data")))
    return workload.events_as_messages(spark, sf_dir).select(
        "message_id", text.isNotNull().alias("is_utf8"), payload.alias("original_payload")
    )


def json_validity(spark, sf_dir):
    documents = workload.table(spark, sf_dir, "documents")
    documents = workload.as_messages(documents, F.col("text"), F.col("doc_id"))
    labelled = [
        raw.parse_raw(messages, source).select(F.lit(source).alias("source"), routing.ERROR)
        for source, messages in (
            ("events", workload.events_as_messages(spark, sf_dir)),
            ("documents", documents),
        )
    ]
    merged = labelled[0].unionByName(labelled[1])
    is_valid = F.col(routing.ERROR).isNull().alias("is_valid")
    return merged.groupBy("source", is_valid).agg(F.count("*").alias("n"))


def std_flatten(spark, sf_dir):
    return _plain(routing.table_rows(_standard(spark, sf_dir)).drop("processing_time"))


def std_defaults(spark, sf_dir):
    return routing.table_rows(_standard(spark, sf_dir)).select("message_id", "passenger_count")


def std_timestamp_lenient(spark, sf_dir):
    stored = F.when(F.col(routing.ERROR).isNull(), F.col("timestamp"))
    return _plain(
        _standard(spark, sf_dir).select(
            "message_id", stored.alias("timestamp"), routing.routed_to().alias("routed_to")
        )
    )


def route_counts(spark, sf_dir):
    routed = _standard(spark, sf_dir).groupBy(routing.routed_to().alias("routed_to"))
    return routed.agg(F.count("*").alias("n"))


def dlq_rows(spark, sf_dir):
    return _plain(routing.dead_letters(_standard(spark, sf_dir)))


def raw_payload_verbatim(spark, sf_dir):
    return routing.table_rows(_raw(spark, sf_dir)).select(
        "message_id", F.md5("payload").alias("payload_md5"), F.length("payload").cast("bigint").alias("n_chars")
    )


def envelope_publish_time(spark, sf_dir):
    return _plain(routing.table_rows(_raw(spark, sf_dir)).select("message_id", "publish_time"))


def attributes_json(spark, sf_dir):
    return routing.table_rows(_raw(spark, sf_dir)).select("message_id", "attributes")


def governance_attrs(spark, sf_dir):
    messages = workload.events_as_messages(spark, sf_dir)
    stamped = validate.accepted(validate.relay(messages, [REVISION_1, REVISION_2], SCHEMA_NAME))
    parsed = schema_driven.parse_schema_driven(stamped, SUBSCRIPTION, RIDE_V1, _clock(), "quarantine")
    keys = ["schema_name", "schema_revision_id", "schema_encoding"]
    return parsed.groupBy(*keys).agg(F.count("*").alias("n"))


def schema_v1_extract(spark, sf_dir):
    parsed = schema_driven.parse_schema_driven(_clean(spark, sf_dir), SUBSCRIPTION, RIDE_V1, _clock())
    return _plain(parsed.select(*RIDE_V1_NAMES))


def schema_v2_extract(spark, sf_dir):
    return _plain(_v2_table(spark, sf_dir).select(*RIDE_V2_NAMES))


def schema_extra_ignored(spark, sf_dir):
    return _plain(routing.table_rows(_quarantine(spark, sf_dir)).select(*RIDE_V1_NAMES))


def _epoch(spark, sf_dir, definition, number):
    events = workload.table(spark, sf_dir, "events")
    payload = F.to_json(F.struct("event_id", number.alias("ts")))
    messages = workload.as_messages(events, payload, F.col("event_id"))
    parsed = schema_driven.parse_schema_driven(messages, SUBSCRIPTION, definition, _clock())
    return _plain(parsed.select("event_id", "ts"))


def schema_epoch_millis(spark, sf_dir):
    return _epoch(spark, sf_dir, EPOCH_MILLIS, F.unix_millis(F.col("ts").cast("timestamp")))


def schema_epoch_micros(spark, sf_dir):
    return _epoch(spark, sf_dir, EPOCH_MICROS, F.unix_micros(F.col("ts").cast("timestamp")))


def schema_logical_types(spark, sf_dir):
    payload = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("order_key"),
            F.unix_date(F.col("o_orderdate").cast("date")).alias("order_date"),
            F.expr("o_orderkey % 86400000").alias("time_millis"),
            F.expr("o_orderkey % 86400000 * 1000 + 7").alias("time_micros"),
            (F.col("o_orderstatus") == "O").alias("is_open"),
            F.col("o_totalprice").alias("total_price"),
            F.col("o_orderpriority").alias("priority"),
        )
    )
    orders = workload.table(spark, sf_dir, "orders")
    messages = workload.as_messages(orders, payload, F.col("o_orderkey"))
    parsed = schema_driven.parse_schema_driven(messages, SUBSCRIPTION, ORDER, _clock())
    return parsed.select(
        "order_key", "order_date", "time_millis", "time_micros", "is_open", "total_price",
        F.hex("priority").alias("priority_hex"),
    )


def schema_quarantine(spark, sf_dir):
    outcome = F.coalesce(routing.error_class(), F.lit("OK")).alias("error_class")
    return _quarantine(spark, sf_dir).groupBy(outcome).agg(F.count("*").alias("n"))


def _enriched(spark, sf_dir):
    return enrich.enrich_rides(_clean(spark, sf_dir, workload.NONE), _clock())


def _read_v2(messages):
    return schema_driven.parse_schema_driven(messages, SUBSCRIPTION, RIDE_V2, _clock())


def enrich_region(spark, sf_dir):
    return _read_v2(_enriched(spark, sf_dir)).groupBy("region").agg(F.count("*").alias("n"))


def enrich_timestamp(spark, sf_dir):
    return _plain(_read_v2(_enriched(spark, sf_dir)).select("message_id", "enrichment_timestamp"))


def enrich_roundtrip(spark, sf_dir):
    return _plain(_read_v2(_enriched(spark, sf_dir)).select("message_id", *RIDE_V2_NAMES))


def _uptown(document):
    return document["region"].try_cast("string") != "downtown"


def transform_chain(spark, sf_dir):
    apply = enrich.chain([enrich.ride_enrichment(_clock()), enrich.keep_if(_uptown)])
    return _read_v2(apply(_clean(spark, sf_dir, workload.NONE))).select("message_id", "region")


def transform_filter(spark, sf_dir):
    occupied = enrich.chain([enrich.keep_if(lambda document: document["passenger_count"].try_cast("bigint") > 0)])
    return occupied(workload.events_as_messages(spark, sf_dir)).select("message_id")


def _through_five(spark, sf_dir):
    """Faulty messages after five links: one refuses, one enriches, two set members, one reads them and filters."""
    point = F.expr("try_cast(_cells['point_idx'] AS bigint)")
    links = [
        transforms.Link("points", refuses=lambda d: F.when(d["point_idx"].isNotNull() & point.isNull(), "TYPE_MISMATCH:point_idx")),
        enrich.ride_enrichment(_clock()),
        transforms.Link("parity", sets=lambda d: {"parity": point % 2}),
        transforms.Link("mark", sets=lambda d: {"mark": F.concat(d["region"].try_cast("string"), d["parity"].try_cast("string"))}),
        enrich.keep_if(lambda d: d["mark"].try_cast("string") != "downtown1", "odd downtown"),
    ]
    return transforms.apply(workload.events_as_messages(spark, sf_dir), links)


def transform_five(spark, sf_dir):
    document = F.try_parse_json(F.col("data").cast("string"))
    members = [F.try_variant_get(document, f"$.{name}", "string").alias(name) for name in ("ride_id", "region", "parity", "mark")]
    return transforms.delivered(_through_five(spark, sf_dir)).select("message_id", *members)


def transform_outcomes(spark, sf_dir):
    return _through_five(spark, sf_dir).agg(*transforms.counts())


def transform_dead_letters(spark, sf_dir):
    return _plain(transforms.dead_letters(_through_five(spark, sf_dir), SUBSCRIPTION, _clock()))


def enrich_order(spark, sf_dir):
    """Enrichment as a topic's transform, before validation, and as a subscription's, after it."""
    messages, link = workload.events_as_messages(spark, sf_dir), [enrich.ride_enrichment(_clock())]
    both = [REVISION_1, REVISION_2]
    topic = validate.relay(transforms.before(messages, link), both, SCHEMA_NAME)
    subscription = transforms.relayed(validate.relay(messages, both, SCHEMA_NAME), link)
    region = F.try_variant_get(F.try_parse_json(F.col("data").cast("string")), "$.region", "string")
    rows = [
        df.select(
            F.lit(place).alias("place"), "message_id", F.col("attributes")["googclient_schemarevisionid"].alias("revision"),
            F.when(F.col("reject_reason").isNull(), region).alias("region"), F.col("reject_reason").alias("reason"),
        )
        for place, df in {"topic": topic, "subscription": subscription}.items()
    ]
    return rows[0].unionByName(rows[1])


def _checked(spark, sf_dir, *revisions):
    return validate.check(workload.events_as_messages(spark, sf_dir), revisions)


def _rule(spark, sf_dir, rule):
    broken = F.coalesce(F.col("reject_reason").startswith(rule), F.lit(False))
    return _checked(spark, sf_dir, REVISION_1).select("message_id", (~broken).alias("ok"))


def validate_required(spark, sf_dir):
    return _rule(spark, sf_dir, "MISSING_FIELD")


def validate_types(spark, sf_dir):
    return _rule(spark, sf_dir, "TYPE_MISMATCH")


def validate_extra_ok(spark, sf_dir):
    """Unknown members, the second revision's among them, never cause a rejection."""
    checked = _checked(spark, sf_dir, REVISION_1)
    return checked.select("message_id", F.col("reject_reason").isNull().alias("ok"))


def revision_stamp(spark, sf_dir):
    revision = F.coalesce("revision_id", F.lit("rejected")).alias("revision")
    return _checked(spark, sf_dir, REVISION_1, REVISION_2).groupBy(revision).agg(F.count("*").alias("n"))


def revision_ranges(spark, sf_dir):
    """Each message is checked against the revisions that its topic allowed when it was published."""
    limits = [(1, 1, 2024, 1, 5), (1, 2, 2024, 1, 12), (2, 2, 2024, 1, 20)]
    ranges = [
        Range("rides", SCHEMA_NAME, first, last, datetime(*day, tzinfo=timezone.utc), number + 1)
        for number, (first, last, *day) in enumerate(limits)
    ]
    checked = validate.check(workload.events_as_messages(spark, sf_dir), [REVISION_1, REVISION_2], ranges)
    return checked.select("message_id", "revision_id", "reject_reason")


def _relayed(spark, sf_dir):
    return validate.relay(workload.events_as_messages(spark, sf_dir), [REVISION_1], SCHEMA_NAME)


def relay_accepted(spark, sf_dir):
    accepted = validate.accepted(_relayed(spark, sf_dir))
    return accepted.select(
        "message_id",
        F.col("attributes")["googclient_schemarevisionid"].alias("revision"),
        F.size("attributes").cast("bigint").alias("n_attributes"),
    )


def relay_rejected(spark, sf_dir):
    return validate.rejected(_relayed(spark, sf_dir)).select("message_id", F.col("reject_reason").alias("reason"))


def relay_counts(spark, sf_dir):
    return _relayed(spark, sf_dir).agg(*validate.relay_counts())


def compat_audit(spark, sf_dir):
    retained = raw.as_messages(routing.table_rows(_raw(spark, sf_dir)))
    return validate.compatibility_audit(retained, REVISION_2)


def merge_v1_v2_streams(spark, sf_dir):
    """A plain and an enriched producer that both mirror all events."""
    plain = _clean(spark, sf_dir, workload.NONE)
    merged = sources.merge_streams(plain, enrich.enrich_rides(plain, _clock()))
    version = F.when(F.col("enrichment_timestamp").isNotNull(), "v2").otherwise("v1").alias("version")
    return _read_v2(merged).groupBy(version).agg(F.count("*").alias("n"))


def evolve_union_v1_v2(spark, sf_dir):
    """Rows written before and after a table gained the second revision's columns."""
    before = schema_driven.parse_schema_driven(
        _clean(spark, sf_dir, workload.NONE), SUBSCRIPTION, RIDE_V1, _clock()
    )
    after = schema_driven.parse_schema_driven(
        _clean(spark, sf_dir, workload.ALL), SUBSCRIPTION, RIDE_V2, _clock()
    )
    return _plain(after.unionByName(before, allowMissingColumns=True).select(*RIDE_V2_NAMES))


def _new_table(spark: SparkSession, name: str, schema) -> str:
    """Empty tables of this application, in the place of those of an earlier call."""
    configure(spark)
    name = f"{name}_{re.sub(r'[^A-Za-z0-9]', '_', spark.sparkContext.applicationId)}"
    for table in (name, f"{name}_dlq"):
        tables.drop_table(spark, table)
    jobs.create_tables(spark, name, schema)
    return name


def _in_batches(parsed: DataFrame, writers: int) -> DataFrame:
    """Rows with a writer and a batch each: two thousand messages to a batch, dealt to the writers in turn."""
    number = F.expr("coalesce(try_cast(message_id AS BIGINT), 0) DIV 2000")
    writer = F.concat(F.lit("w"), (number % writers).cast("string"))
    return parsed.withColumns({tables.WRITER: writer, tables.BATCH: (number / writers).cast("bigint")})


def part_daily_counts(spark, sf_dir):
    """Days of a table that two writers have filled and that has been compacted up to the middle of its days."""
    name = _new_table(spark, "part_daily_counts", STANDARD)
    rows = _in_batches(routing.table_rows(_standard(spark, sf_dir)), 2)
    tables.replace_batches(rows, name, "publish_time")
    first, last = rows.agg(F.to_date(F.min("publish_time")), F.to_date(F.max("publish_time"))).first()
    if first is not None:
        tables.compact(spark, name, first + (last - first) / 2, ["w0"])
    return tables.read_table(spark, name).groupBy("publish_date").agg(F.count("*").alias("n"))


def append_two_writers(spark, sf_dir):
    """Two jobs append to a table; one repeats its first batch, the other its last, after a cut-off."""
    name = _new_table(spark, "append_two_writers", STANDARD)
    messages = workload.events_as_messages(spark, sf_dir)
    for remainder, writer in enumerate(("w0", "w1")):
        for batch_id in (0, 1, remainder):
            own = messages.where(F.expr(f"CAST(message_id AS BIGINT) % 4 = {2 * batch_id + remainder}"))
            jobs.fan_out(jobs.Target(name, ""))(standard.parse_standard(own, SUBSCRIPTION, _clock()), writer, batch_id)
    kept = spark.table(name).select("writer", "batch_id", F.lit("table").alias("routed_to"))
    dead = spark.table(f"{name}_dlq").select("writer", "batch_id", F.lit("dead_letter").alias("routed_to"))
    return kept.unionByName(dead).groupBy("writer", "batch_id", "routed_to").agg(F.count("*").alias("n"))


def batch_by_count(spark, sf_dir):
    events = workload.table(spark, sf_dir, "events").select("event_id")
    numbered = batching.number_batches(events, F.expr("event_id % 5"), ["event_id"], F.expr("event_id div 50000"))
    return numbered.groupBy("shard", "batch_no").agg(F.count("*").alias("n"))


def replay_raw_to_typed(spark, sf_dir):
    """The typed table that a replay makes from a raw table of many batches, part of them compacted."""
    raw_table, typed = _new_table(spark, "replayed_raw", RAW), _new_table(spark, "replayed_typed", STANDARD)
    rows = _in_batches(routing.table_rows(_raw(spark, sf_dir)), 3)
    tables.replace_batches(rows, raw_table, "publish_time")
    tables.compact(spark, raw_table, NOW.date().replace(day=1))
    parse = lambda messages, subscription: standard.parse_standard(messages, subscription, _clock())
    jobs.replay(spark, raw_table, jobs.Target(typed, ""), parse, max_bytes=32 << 20)
    return _plain(spark.table(typed).select(*STANDARD.fieldNames()))


def _landed(spark: SparkSession, name: str, messages: DataFrame) -> tuple[DataFrame, str]:
    """Messages in a landing folder, as a stream, and a new checkpoint beside it."""
    name = f"{name}_{re.sub(r'[^A-Za-z0-9]', '_', spark.sparkContext.applicationId)}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    messages.write.format("parquet").saveAsTable(name)
    folder = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    return sources.stream_landing(spark, folder), f"{folder}_checkpoints/{uuid.uuid4().hex}"


def dedup_messages(spark, sf_dir):
    """A stream in which every tenth message is delivered three times, half a minute apart, first deliveries kept."""
    messages = workload.events_as_messages(spark, sf_dir)
    repeat = F.explode(F.when(F.expr("CAST(message_id AS BIGINT) % 10 = 3"), F.array(F.lit(0), F.lit(30), F.lit(60))).otherwise(F.array(F.lit(0))))
    again = messages.withColumn("_late", repeat)
    again = again.withColumn("publish_time", F.col("publish_time") + F.make_dt_interval(secs=F.col("_late"))).drop("_late")
    # A message without a publish time has no place among the others, so it is delivered once only.
    again = again.where("publish_time IS NOT NULL").unionByName(messages.where("publish_time IS NULL"))
    stream, checkpoint = _landed(spark, "dedup_landing", again)
    name = _new_table(spark, "dedup_messages", RAW)
    jobs.start_raw(stateful.first_deliveries(stream), SUBSCRIPTION, jobs.Target(name, checkpoint, jobs.CATCH_UP)).awaitTermination()
    kept = spark.table(name).select("message_id", F.lit("table").alias("routed_to"))
    return kept.groupBy("message_id", "routed_to").agg(F.count("*").alias("n"))


def minute_stream(spark, sf_dir):
    """Closed minutes of the schema-driven stream, as a stateful job writes them."""
    stream, checkpoint = _landed(spark, "minute_landing", _clean(spark, sf_dir))
    name = _new_table(spark, "minute_stream", stateful.MINUTES)
    parsed = schema_driven.parse_schema_driven(stream, SUBSCRIPTION, RIDE_V2, _clock())
    stateful.start_minutes(parsed, jobs.Target(name, checkpoint, jobs.CATCH_UP)).awaitTermination()
    return _plain(spark.table(name).select(F.col("minute_time").alias("minute"), "v2_count", "v1_count", "total"))


def typed_view(spark, sf_dir):
    return _plain(reports.typed_view(routing.table_rows(_raw(spark, sf_dir, faults=False))))


def _over_v2(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(report(_v2_table(spark, sf_dir)))


def json_query_subdoc(spark, sf_dir):
    turns = workload.table(spark, sf_dir, "conversations")
    turn = F.struct("turn", "role", "text")
    payload = F.to_json(F.struct("conv_id", F.array(turn).alias("turns"), F.col("role").alias("speaker")))
    nested = turns.select("conv_id", "turn", payload.alias("payload"))
    nested = reports.json_query(nested, "payload", "$.turns[0]", "turn_document")
    # A scalar is no sub-document.
    nested = reports.json_query(nested, "payload", "$.speaker", "speaker_document")
    return nested.select("conv_id", "turn", "turn_document", "speaker_document")


def pipeline_lag(spark, sf_dir):
    published = routing.table_rows(_raw(spark, sf_dir))
    delay = F.make_dt_interval(secs=F.expr("CAST(message_id AS BIGINT) % 50"))
    delayed = published.withColumn("processing_time", F.col("publish_time") + delay)
    return _plain(reports.pipeline_lag(delayed))


def throughput_per_second(spark, sf_dir):
    return _plain(reports.throughput_per_second(routing.table_rows(_raw(spark, sf_dir))))


QUERIES: dict[str, Query] = {
    "src_messages": src_messages,
    "utf8_routing": utf8_routing,
    "json_validity": json_validity,
    "std_flatten": std_flatten,
    "std_defaults": std_defaults,
    "std_timestamp_lenient": std_timestamp_lenient,
    "route_counts": route_counts,
    "dlq_rows": dlq_rows,
    "raw_payload_verbatim": raw_payload_verbatim,
    "envelope_publish_time": envelope_publish_time,
    "attributes_json": attributes_json,
    "governance_attrs": governance_attrs,
    "schema_v1_extract": schema_v1_extract,
    "schema_v2_extract": schema_v2_extract,
    "schema_extra_ignored": schema_extra_ignored,
    "schema_epoch_millis": schema_epoch_millis,
    "schema_epoch_micros": schema_epoch_micros,
    "schema_logical_types": schema_logical_types,
    "schema_quarantine": schema_quarantine,
    "enrich_region": enrich_region,
    "enrich_timestamp": enrich_timestamp,
    "enrich_roundtrip": enrich_roundtrip,
    "transform_chain": transform_chain,
    "transform_filter": transform_filter,
    "transform_five": transform_five,
    "transform_outcomes": transform_outcomes,
    "transform_dead_letters": transform_dead_letters,
    "enrich_order": enrich_order,
    "validate_required": validate_required,
    "validate_types": validate_types,
    "validate_extra_ok": validate_extra_ok,
    "revision_stamp": revision_stamp,
    "revision_ranges": revision_ranges,
    "relay_accepted": relay_accepted,
    "relay_rejected": relay_rejected,
    "relay_counts": relay_counts,
    "compat_audit": compat_audit,
    "merge_v1_v2_streams": merge_v1_v2_streams,
    "evolve_union_v1_v2": evolve_union_v1_v2,
    "part_daily_counts": part_daily_counts,
    "append_two_writers": append_two_writers,
    "batch_by_count": batch_by_count,
    "replay_raw_to_typed": replay_raw_to_typed,
    "dedup_messages": dedup_messages,
    "minute_stream": minute_stream,
    "typed_view": typed_view,
    "mixed_overview_short": _over_v2(reports.mixed_overview_short),
    "mixed_overview": _over_v2(reports.mixed_overview),
    "minute_timeline_short": _over_v2(reports.minute_timeline_short),
    "minute_timeline": _over_v2(reports.minute_timeline),
    "sample_v1_v2": _over_v2(reports.sample_v1_v2),
    "region_distribution": _over_v2(reports.region_distribution),
    "json_query_subdoc": json_query_subdoc,
    "pipeline_lag": pipeline_lag,
    "throughput_per_second": throughput_per_second,
}
