"""Schemas, revisions, governance checks, enrichment and batching."""

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from sample import ADDED, RIDE
from tollgate.model import DEAD_LETTER, ENVELOPE, MESSAGE, RAW, STANDARD
from tollgate.operators import batching, enrich, routing, schema_driven, transforms, validate
from tollgate.operators.transforms import Link
from tollgate.plans import avro, reports, revisions
from tollgate.sources.messages import from_kafka
from tollgate.workload.definitions import REVISION_1, REVISION_2, RIDE_V1, RIDE_V2
from tollgate.workload.queries import QUERIES


def record(*fields):
    return json.dumps({"type": "record", "name": "R", "fields": list(fields)})


def messages(spark, payloads, attributes=None):
    rows = [(bytearray(p if isinstance(p, bytes) else (p if isinstance(p, str) else json.dumps(p)).encode()), attributes, str(i), None) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, MESSAGE)


def names(struct):
    return [f.name for f in struct.fields]


def test_fixed_schemas():
    assert len(STANDARD) == 14 and STANDARD["point_idx"].dataType.simpleString() == "bigint"
    assert names(RAW) == "subscription_name message_id publish_time processing_time attributes payload".split()
    assert names(DEAD_LETTER) == "processing_time error_message stack_trace original_payload subscription_name".split()
    assert len(ENVELOPE) == 8


def test_definitions_map_to_columns():
    v1, v2 = avro.to_struct(RIDE_V1), avro.to_struct(RIDE_V2)
    assert len(v1) == 9 and len(v2) == 11
    assert v1["timestamp"].dataType.simpleString() == "timestamp"
    assert v2["region"].dataType.simpleString() == "string" and v2["region"].nullable
    logical = record(
        {"name": "a", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "b", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "c", "type": {"type": "int", "logicalType": "date"}},
        {"name": "d", "type": {"type": "string", "logicalType": "iso-datetime"}},
        {"name": "e", "type": ["int", "null"]},
        {"name": "f", "type": {"type": "float"}},
    )
    kinds = [f.dataType.simpleString() for f in avro.to_struct(logical).fields]
    assert kinds == ["timestamp", "timestamp", "date", "timestamp", "bigint", "double"]
    assert avro.schema_string(RIDE_V1).startswith("subscription_name:STRING,message_id:STRING,publish_time:TIMESTAMP")
    assert avro.schema_string(RIDE_V1).endswith("ride_status:STRING,passenger_count:INT64")


@pytest.mark.parametrize(
    "kind, message",
    [
        ("fixed", "Unsupported Avro primitive type: fixed"),
        ({"type": "array", "items": "int"}, "Unsupported Avro primitive type: array"),
        ({"type": "string", "logicalType": "uuid"}, "logical type without a column type: uuid"),
        (["null", "string", "int"], "Unsupported union type"),
        (["null"], "Unsupported union type"),
        ({"type": {"type": "string"}}, "type without a column type"),
    ],
)
def test_unsupported_definitions(kind, message):
    with pytest.raises(ValueError, match=message):
        avro.fields_of(record({"name": "x", "type": kind}))


def test_payload_fields_may_not_hide_the_envelope():
    with pytest.raises(ValueError, match="message_id"):
        avro.table_struct(record({"name": "message_id", "type": "string"}))


def test_schema_driven_values(spark):
    definition = record(
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "raw", "type": "bytes"},
        {"name": "flag", "type": ["null", "boolean"]},
    )
    good = {"at": 1737000000000, "day": 20000, "raw": "aé", "flag": True, "other": 1}
    bad = [{**good, "raw": "€"}, {**good, "flag": "true"}, {**good, "day": "2026-01-01"}, {**good, "at": "never"}]
    parsed = schema_driven.parse_schema_driven(
        messages(spark, [good, {}, *bad], {"googclient_schemaname": "s"}), "sub", definition, on_error="quarantine"
    )
    rows = sorted(parsed.collect(), key=lambda r: int(r.message_id))
    assert rows[0].at == datetime(2025, 1, 16, 4) and rows[0].day == date(2024, 10, 4)
    assert bytes(rows[0].raw) == b"a\xe9" and rows[0].flag is True
    assert rows[0].schema_name == "s" and rows[0].schema_encoding == ""
    assert rows[1]._error is None and rows[1].at is None and rows[1].flag is None
    assert [r._error for r in rows[2:]] == [
        "TYPE_MISMATCH:raw", "TYPE_MISMATCH:flag", "TYPE_MISMATCH:day", "BAD_TIMESTAMP:at",
    ]


def test_micros_can_be_read_as_millis(spark):
    definition = record({"name": "at", "type": {"type": "long", "logicalType": "timestamp-micros"}})
    for as_millis, year in ((False, 1970), (True, 2025)):
        df = schema_driven.parse_schema_driven(
            messages(spark, [{"at": 1737000000000}]), "sub", definition, micros_as_millis=as_millis
        )
        assert df.first().at.year == year


def test_fail_mode_fails_even_if_no_column_is_read(spark):
    df = schema_driven.parse_schema_driven(messages(spark, [RIDE, "{broken"]), "sub", RIDE_V1)
    with pytest.raises(Exception, match="INVALID_JSON"):
        df.count()


def test_governance_checks(spark):
    missing = {k: v for k, v in RIDE.items() if k != "passenger_count"}
    v2 = {**RIDE, **ADDED}
    payloads = [RIDE, missing, {**RIDE, "point_idx": "seven"}, v2, {**RIDE, "timestamp": "not a time"},
                {**RIDE, "point_idx": 2**31}, {**RIDE, "latitude": 40}, {**RIDE, "region": 5}]
    df = validate.check(messages(spark, payloads), [REVISION_1, REVISION_2])
    got = [(r.revision_id, r.reject_reason) for r in sorted(df.collect(), key=lambda r: int(r.message_id))]
    first, second = REVISION_1.revision_id, REVISION_2.revision_id
    assert got == [
        (second, None), (None, "MISSING_FIELD:passenger_count"), (None, "TYPE_MISMATCH:point_idx"), (second, None),
        (second, None), (None, "TYPE_MISMATCH:point_idx"), (second, None), (first, None),
    ]


def test_relay_drops_source_attributes(spark):
    row = validate.relay(messages(spark, [RIDE], {"source": "x"}), [REVISION_1], "rides").first()
    assert row.attributes == {
        "googclient_schemaname": "rides",
        "googclient_schemarevisionid": REVISION_1.revision_id,
        "googclient_schemaencoding": "JSON",
    }


def test_revisions_table(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert revisions.load(spark, path, "rides") == []
    first = revisions.commit(spark, path, "rides", RIDE_V1)
    with pytest.raises(ValueError, match="added field has no default: extra"):
        extra = json.loads(RIDE_V1)
        extra["fields"].append({"name": "extra", "type": "string"})
        revisions.commit(spark, path, "rides", json.dumps(extra))
    second = revisions.commit(spark, path, "rides", RIDE_V2)
    assert len(first.revision_id) == 8 and first.revision_id != second.revision_id
    assert revisions.load(spark, path, "rides") == [second, first]
    assert revisions.load(spark, path, "rides", last=1) == [first]
    assert avro.incompatibilities(RIDE_V1, RIDE_V2) == []


def test_a_schema_has_twenty_revisions(spark, tmp_path):
    path = str(tmp_path / "registry")
    rows = [tuple(vars(revisions.make_revision("full", n, RIDE_V1)).values()) for n in range(1, 21)]
    spark.createDataFrame(rows, revisions.SCHEMA).write.parquet(path)
    with pytest.raises(ValueError, match="20 revisions"):
        revisions.commit(spark, path, "full", RIDE_V2)
    one_more = tuple(vars(revisions.make_revision("full", 21, RIDE_V1)).values())
    spark.createDataFrame([one_more], revisions.SCHEMA).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="more than 20"):
        revisions.load(spark, path, "full")


def test_a_commit_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "registry")
    first = revisions.commit(spark, path, "rides", RIDE_V1)
    assert revisions.commit(spark, path, "rides", RIDE_V1) == first
    assert revisions.load(spark, path, "rides") == [first]


def test_enrichment_keeps_other_members_byte_for_byte(spark):
    texts = ['{"z":1e400,"a":"\\ud800","latitude":40.9}', ' { } ', '{"b":1.0, "b":2 }\n', '{"$a":"}$1","latitude":40.76}']
    df = enrich.enrich_rides(messages(spark, texts), F.lit(datetime(2026, 1, 2)))
    added = ['"enrichment_timestamp":"2026-01-02T00:00:00.000Z","region":"%s"}' % r for r in ("north", "downtown", "downtown", "midtown")]
    got = {int(r.message_id): bytes(r.data).decode() for r in df.collect()}
    assert got[0] == texts[0][:-1] + "," + added[0]
    assert got[1] == " {" + added[1]
    assert got[2] == '{"b":1.0, "b":2,' + added[2]
    assert got[3] == texts[3][:-1] + "," + added[3]


def test_a_filter_delivers_json_only(spark):
    keep = enrich.chain([enrich.keep_if(lambda document: document["p"].try_cast("bigint") > 0)])
    texts = ['{"p":1}', '{"p":1},2', '{"p":1},{"$digest":"x"}', '{"p":0}', "[1]"]
    assert [r.message_id for r in keep(messages(spark, texts)).collect()] == ["0"]


def test_enrichment(spark):
    latitudes = [40.8, 40.80001, 40.75, 40.75001, 0, None, "41", "x", True, "", "4.1e1"]
    payloads = [{"latitude": v, "keep": {"a": [1, None]}} for v in latitudes] + [{}, [1, 2], 7, None, "{broken"]
    source = messages(spark, payloads)
    clock = F.lit(datetime(2026, 1, 2, 3, 4, 5, 678900))
    rows = {int(r.message_id): bytes(r.data).decode() for r in enrich.enrich_rides(source, clock).collect()}
    regions = [json.loads(rows[i])["region"] for i in range(12)]
    assert regions == ["midtown", "north", "downtown", "midtown", "downtown", "downtown", "north", "downtown",
                       "downtown", "downtown", "north", "downtown"]
    assert json.loads(rows[0])["keep"] == {"a": [1, None]}
    assert json.loads(rows[0])["enrichment_timestamp"] == "2026-01-02T03:04:05.678Z"
    assert (rows[12], rows[13]) == ("[1, 2]", "7")
    assert sorted(int(r.message_id) for r in enrich.untransformable(source).collect()) == [14, 15]


def test_a_chain_has_five_transforms():
    with pytest.raises(ValueError, match="at most 5"):
        enrich.chain([enrich.ride_enrichment()] * 6)


def test_a_chain_parses_once_and_writes_once(spark):
    links = [Link(f"l{n}", sets=lambda d, n=n: {f"m{n}": (F.lit(n) if n == 0 else d[f"m{n - 1}"].try_cast("int") + 1)}) for n in range(5)]
    df = transforms.apply(messages(spark, ['{"a":1e400}', "[7]", '{"m3":null,"b":2}']), links)
    spark.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("parseJson") == 1 and plan.count("to_json(") <= 6
    rows = {r.message_id: bytes(r.data).decode() for r in df.collect()}
    assert rows["0"] == '{"a":1e400,"m0":0,"m1":1,"m2":2,"m3":3,"m4":4}' and rows["1"] == "[7]"
    assert json.loads(rows["2"]) == {"b": 2, **{f"m{n}": n for n in range(5)}}


def test_the_first_link_to_refuse_or_filter_decides(spark):
    """Later links are not evaluated: dividing by what an earlier one refused would fail."""
    number = lambda d: d["n"].try_cast("int")
    links = [
        Link("text", refuses=lambda d: F.when(number(d).isNull(), "TYPE_MISMATCH:n")),
        Link("zero", keeps=lambda d: number(d) != 0),
        Link("share", sets=lambda d: {"n": 100 / number(d), "it's": F.lit('"\\')}),
        Link("small", refuses=lambda d: F.when(d["n"].try_cast("double") > 50, "TYPE_MISMATCH:n"), keeps=lambda d: d["n"].try_cast("double") < 40),
    ]
    texts = ['{"n":5}', '{"n":0}', '{"n":"x"}', '{"n":1}', '{"n":2}', '{"n":null}', "null", " null\n", "{", b"\xff", "", "[]"]
    rows = {int(r.message_id): r for r in transforms.apply(messages(spark, texts), links).collect()}
    assert json.loads(bytes(rows[0].data)) == {"n": 20.0, "it's": '"\\'}
    assert {n: r._dropped_by for n, r in rows.items() if r._dropped_by} == {1: "zero", 4: "small"}
    assert {n: r._error for n, r in rows.items() if r._error} == {
        2: "TYPE_MISMATCH:n", 3: "TYPE_MISMATCH:n", 5: "TYPE_MISMATCH:n", 6: "NOT_AN_OBJECT", 7: "NOT_AN_OBJECT",
        8: "INVALID_JSON", 9: "INVALID_UTF8", 10: "INVALID_JSON", 11: "TYPE_MISMATCH:n",
    }
    assert bytes(rows[3].data).decode() == texts[3] and rows[3]._payload == texts[3] and rows[9]._payload == "0xFF"
    assert transforms.apply(messages(spark, []), links).count() == 0


def test_ranges_of_a_topic(spark, tmp_path):
    path = str(tmp_path / "topics")
    at = lambda day: datetime(2026, 1, day, tzinfo=timezone.utc)
    assert revisions.ranges(spark, path, "t") == []
    first = revisions.set_range(spark, path, "t", "rides", 1, 1, at(5))
    assert revisions.set_range(spark, path, "t", "rides", 1, 1) == first
    second = revisions.set_range(spark, path, "t", "rides", 2, 2, at(9))
    revisions.set_range(spark, path, "other", "rides", 1, 2, at(1))
    assert revisions.ranges(spark, path, "t") == [first, second]
    with pytest.raises(ValueError, match="cannot be changed"):
        revisions.set_range(spark, path, "t", "rides", 1, 2, at(8))
    with pytest.raises(ValueError, match="no range"):
        revisions.set_range(spark, path, "t", "rides", 2, 1)
    source = messages(spark, [RIDE] * 4 + ["{"])
    days = F.element_at(F.array(*[F.lit(t) for t in (at(1), at(5), at(8), at(9), at(1))]), F.col("message_id").cast("int") + 1)
    checked = validate.check(source.withColumn("publish_time", days), [REVISION_1, REVISION_2], [first, second])
    got = [(r.revision_id, r.reject_reason) for r in checked.orderBy("message_id").collect()]
    one, two = REVISION_1.revision_id, REVISION_2.revision_id
    assert got == [(None, "NO_REVISION"), (one, None), (one, None), (two, None), (None, "INVALID_JSON")]


def test_enrichment_may_run_before_or_after_validation(spark):
    source = messages(spark, [RIDE])
    before = validate.check(enrich.enrich_rides(source), [REVISION_2]).first()
    assert before.revision_id == REVISION_2.revision_id
    after = enrich.enrich_rides(validate.accepted(validate.relay(source, [REVISION_1], "rides"))).first()
    assert after.attributes["googclient_schemarevisionid"] == REVISION_1.revision_id
    assert "region" in json.loads(bytes(after.data))


def test_kafka_columns(spark):
    schema = (
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
        "headers array<struct<key:string,value:binary>>"
    )
    at = datetime(2026, 1, 1)
    rows = [
        (None, bytearray(b"{}"), "t", 0, 7, at, [("a", bytearray(b"1")), ("b", bytearray(b"2")), ("a", bytearray(b"3"))]),
        (None, bytearray(b"{}"), "t", 1, 8, at, None),
    ]
    got = from_kafka(spark.createDataFrame(rows, schema)).orderBy("message_id").collect()
    assert got[0].attributes == {"a": "3", "b": "2"} and got[0].message_id == "t-0-7"
    assert got[1].attributes == {} and got[1].publish_time == at


def test_batch_numbers_under_skew(spark):
    """One shard holds most rows; its rows still spread over many groups, and planning runs no job."""
    df = spark.range(20_000).withColumn("key", F.when(F.col("id") % 10 == 0, F.col("id") % 5).otherwise(0))
    numbered = batching.number_batches(df, F.col("key"), ["id"], F.expr("id div 1000"), size=70).cache()
    held = df.groupBy("key", F.expr("id div 1000")).count().agg(F.max("count")).first()[0]
    assert held <= 1_000
    expected = df.selectExpr("id", "key AS shard", "(row_number() OVER (PARTITION BY key ORDER BY id) - 1) div 70 AS batch_no")
    assert numbered.select("id", "shard", "batch_no").exceptAll(expected).count() == 0
    assert numbered.count() == 20_000


def test_json_value_of_the_typed_view(spark):
    raw = spark.createDataFrame(
        [("s", "1", None, None, '{"ride_id":{"a":1},"point_idx":"12","latitude":1,"timestamp":null}')],
        "subscription_name string, message_id string, publish_time timestamp, processing_time timestamp, payload string",
    )
    row = reports.typed_view(raw).first()
    assert (row.ride_id, row.point_idx, row.latitude, row.timestamp, row.ride_status) == (None, 12, 1.0, None, None)


def test_typed_view_over_faulty_rows(spark):
    raw = spark.createDataFrame(
        [("s", "1", None, None, '{"ride_id":"a","point_idx":"seven","timestamp":"bad"}')],
        "subscription_name string, message_id string, publish_time timestamp, processing_time timestamp, payload string",
    )
    row = reports.typed_view(raw, safe=True).first()
    assert (row.ride_id, row.point_idx, row.timestamp) == ("a", None, None)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        reports.typed_view(raw).collect()


def test_json_query_goes_by_the_kind_of_value(spark):
    text = json.dumps({"o": {"z": 1, "a": [1, 2]}, "l": [1, {"b": 2}], "t": "{not a document", "n": 5, "x": None, "q'": {"c": 3}})
    df = spark.createDataFrame([(text,), ("{broken",), (None,)], "payload string")
    for path, want in (("$.o", '{"z":1,"a":[1,2]}'), ("$.l", '[1,{"b":2}]'), ("$.t", None), ("$.n", None), ("$.x", None), ("$.no", None)):
        rows = [r.d for r in reports.json_query(df, "payload", path, "d").collect()]
        assert rows == [want, None, None], path


def test_typed_view_in_the_catalog(spark, tmp_path):
    from tollgate.plans import tables

    tables.create_table(spark, "raw_for_view", RAW, "publish_time", str(tmp_path / "t"))
    row = ("s", "1", datetime(2026, 1, 1), datetime(2026, 1, 1), "{}", json.dumps(RIDE))
    tables.append_batch(spark.createDataFrame([row], RAW), "raw_for_view", "w", 0, "publish_time")
    reports.create_typed_view(spark, "rides_view", "raw_for_view")
    assert spark.table("rides_view").first().timestamp == datetime(2025, 11, 30, 23, 15, 30, 125)
    day = spark.table("rides_view").where("publish_date = DATE'2026-01-01'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "publish_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and day.count() == 1
    reports.materialize_typed_view(spark, "rides_typed", "raw_for_view")
    assert spark.table("rides_typed").count() == 1
    spark.sql("DROP TABLE rides_typed")
    spark.sql("DROP VIEW rides_view")
    tables.drop_table(spark, "raw_for_view")


def test_json_is_parsed_once_per_row(spark):
    """A filter on the outcome must not bring a second parse."""
    from tollgate.operators.standard import parse_standard

    rows = routing.table_rows(parse_standard(messages(spark, [RIDE]), "sub"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_a_subscription_chain_takes_a_relay_in_one_pass(spark, tmp_path):
    """Rejected messages pass by the chain, which is not shown them; the relay's sides are not checked apart."""
    payloads = ['{"n":1}', "no json", '{"n":"x"}', '{"n":2}']
    rows = [(bytearray(p.encode()), None, str(i), None) for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, MESSAGE).write.parquet(str(tmp_path / "m"))
    read = spark.read.schema(MESSAGE).parquet(str(tmp_path / "m"))
    checked = read.withColumn("reject_reason", F.when(F.col("message_id") == "2", "TYPE_MISMATCH:n").when(F.col("message_id") == "1", "INVALID_JSON"))
    number = lambda document: document["n"].cast("long")  # noqa: E731  fails on text
    link = Link("plus", keeps=lambda d: number(d) < 2, sets=lambda d: {"m": number(d) + 1})
    found = transforms.relayed(checked, [link])
    assert found._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    got = {r.message_id: (bytes(r.data).decode(), r.reject_reason) for r in found.collect()}
    assert got == {"0": ('{"n":1,"m":2}', None), "1": ("no json", "INVALID_JSON"), "2": ('{"n":"x"}', "TYPE_MISMATCH:n")}


def test_enrich_order_checks_each_place_once(spark):
    plan = QUERIES["enrich_order"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


def test_members_are_added_before_the_last_brace_whatever_space_is_around(spark):
    texts = ['{"a":"} "} \n\t', ' { } ', '{"a":{"b":1}\r\n}', '{"é":"ü }"}']
    rows = [(bytearray(t.encode()), None, str(i), None) for i, t in enumerate(texts)]
    applied = transforms.apply(spark.createDataFrame(rows, MESSAGE), [Link("z", sets=lambda d: {"z": F.lit(1)})])
    got = {r.message_id: bytes(r.data).decode() for r in applied.collect()}
    assert got == {"0": '{"a":"} ","z":1}', "1": ' {"z":1}', "2": '{"a":{"b":1},"z":1}', "3": '{"é":"ü }","z":1}'}
