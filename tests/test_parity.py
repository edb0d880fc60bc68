"""Spark expressions against the Python model, over hostile payloads and values."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import model
from tollgate.functions import jsonx, timex
from sample import RIDE
from tollgate.model import MESSAGE, STANDARD_DEFAULTS
from tollgate.operators import raw, standard

PAYLOADS = [
    "", "  ", "null", "123", "-0", '"s"', "[1,2]", "{}", '{"a":null}', '{"a":1} xyz', '{"a":1}{"a":2}',
    "1,2", "1],[2", "]", "1]", "1] junk", '1,{"$digest":"x"}]', '{"a":1}] {}', "{'a':1}", "{a:1}", '{"a":1,}',
    '{"a":01}', '{"a":1,"a":2}', '{"ride_id":"a","ride_id":"b"}', '{"point_idx":1,"point_idx":"x"}', '{"a":NaN}',
    '{"a":Infinity}', '{"latitude":-Infinity}', '{"a":1e5}', '{"point_idx":12345678901234567890123}',
    '{"latitude":12345678901234567890123}', '{"a":"x\ny"}', '{"a":"\\u00e9"}', '﻿{"a":1}', '  {"a":1}  ',
    '\n{"a":1}\n', '{"a":"]"}', '{"a":[[],{}]}', "true", "false", "tru", '"unterminated', "[", "{", '"', "\\",
    '{"a":1}/* c */', "// c", '{"$digest":"x"}', '{"a":{"b":{"c":[1,2,{"d":null}]}}}', '{"a":"\\x"}', "1.", ".5", "+1",
    '{"ride_id":"\u0001"}', '{"a":1}\x00', "[1,2", '{"a" 1}', '{"a":1 "b":2}', "1 2", '"a" "b"', '{"":1}',
]

TIMESTAMPS = [
    None, "", 0, 5, 0.0, 0.5, -0.0, False, True, [], [1], [None], {}, {"a": 1}, "bad", "now",
    "2026-02-10T08:14:17.61844-05:00", "2026-02-10T08:14:17.61844Z", "2026-02-10T08:14:17.61844", "2026-02-10",
    "20260115T054549", "20260115", "2026-W03-4", "2026W034", "2026-W03", "2026W03", "2026-W53-1", "2020-W53-5",
    "2021-W53-1", "2026-W54-1", "2026-W00-1", "2026-W03-0", "2026-W03-8", "2026-W034", "2026W03-4",
    "2026-W03-4T05:45:49", "2026W034T054549Z", "2026W03T054549", "2026-W03T05:45", "2026", "2026-01", "05:45",
    "T05:45", "2026-1-5", "2026-01-15T05:45:49,5", "2026-01-15T05:45:49.123456789", "2026-01-15T05:45:49+0530",
    "2026-01-15T24:00:00", "2026-13-01", "2026-02-30", "2026-02-29", "2024-02-29", "2026-01-15T05:45:60",
    " 2026-01-15", "2026-01-15 ", "2026-01-15T05:45:49 America/New_York", "2026-01-15T05:45:49 UTC",
    "2026-01-15x05:45:49", "2026-01-15T05", "2026-01-15T05Z", "2026-01-15T05-05", "2026-01-15T0545", "2026-01-15T0545Z",
    "2026-01-15T05:45.5", "2026-01-15T05.5", "2026-01-15T0545.5+01", "2026-01-15T05:45:49.", "2026-01-15T05:4549",
    "2026-01-15T0545:49", "2026-01-15T05:45:49z", "2026-01-15T05:45:49+19:00", "2026-01-15T05:45:49-23:59",
    "2026-01-15T05:45:49+24:00", "2026-01-15T05:45:49+05:75", "2026-01-15T05:45:49+05:30:15",
    "2026-01-15T05:45:49-05:30:15.5", "2026-01-15T05:45:49+053015", "2026-01-15T05:45:49+05:3015",
    "2026-01-15T05:45:49+05:3", "2026-01-15T", "2026-01-15TZ", "2026-01-15Z", "2026-01-15+05:00", "0000-01-01",
    "0001-01-01T00:00:00Z", "1969-12-31T23:59:59.999999Z", "2026-01-15T05:45:49Z\n", "2026-01-15\n05:45:49",
    "2026-01-15#05:45", "2026-01-15#00", "2026-01-15T05:45:49Z#00", "20260115Z", "202601150545", "2026-01-15|05:45",
    "٢٠٢٦-01-15", "2026-01-15T05:45:49.٥",
]

VALUES = [None, "right", "12", "", 0, 7, -7, 1.0, 1.7, 1e300, True, False, [], [1], {}, {"a": 1},
          2**31, 2**63 - 1, 2**63, -(2**63), -(2**63) - 1, 10**40]


def messages(spark, payloads):
    rows = [(bytearray(p if isinstance(p, bytes) else p.encode("utf-8")), None, str(i), None) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, MESSAGE)


def check_standard(spark, payloads):
    parsed = standard.parse_standard(messages(spark, payloads), "sub")
    parsed = parsed.withColumn("timestamp", F.unix_micros("timestamp")).collect()
    got = {int(r.message_id): r for r in parsed}
    for i, payload in enumerate(payloads):
        data = payload if isinstance(payload, bytes) else payload.encode("utf-8")
        row, error = model.standard(data)
        assert got[i]["_error"] == error, payload
        if row is not None:
            assert {k: got[i][k] for k in row} == row, payload


def test_payloads(spark):
    payloads = [*PAYLOADS, b"\xff\x41", b"\xc3\x28", json.dumps(RIDE), "€", '{"ride_id":"\U0001f600"}']
    check_standard(spark, payloads)
    outcome = {int(r.message_id): r for r in raw.parse_raw(messages(spark, payloads), "sub").collect()}
    for i, payload in enumerate(payloads):
        data = payload if isinstance(payload, bytes) else payload.encode("utf-8")
        _, error = model.strict_json(data)
        assert outcome[i]["_error"] == error, payload
        if error is None:
            assert outcome[i].payload == data.decode("utf-8")


def test_timestamp_values(spark):
    check_standard(spark, [json.dumps({**RIDE, "timestamp": t}) for t in TIMESTAMPS])


def test_field_values(spark):
    payloads = []
    for name in STANDARD_DEFAULTS:
        payloads.append(json.dumps({k: v for k, v in RIDE.items() if k != name}))
        payloads += [json.dumps({**RIDE, name: value}) for value in VALUES]
    check_standard(spark, payloads)


def test_iso_texts_directly(spark):
    texts = [t for t in TIMESTAMPS if isinstance(t, str)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    df = jsonx.once(df, source=timex.iso_parts("t"))
    got = {r.i: r.m for r in df.select("i", F.expr(f"unix_micros({timex.parse_iso('source')})").alias("m")).collect()}
    assert {t: got[i] for i, t in enumerate(texts)} == {t: model.iso(t) for t in texts}


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**70), 2**70) | st.floats(allow_nan=False, allow_infinity=False)
    | st.text(st.characters(exclude_categories=["Cs"]), max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("abc$", max_size=3), inner, max_size=3),
    max_leaves=6,
)
rides = st.fixed_dictionaries({}, optional={name: json_values for name in RIDE})
cut = st.tuples(rides.map(json.dumps), st.integers(0, 200)).map(lambda p: p[0][: p[1]])
tailed = st.tuples(rides.map(json.dumps), st.text('{}[],:"1 $x', max_size=5)).map("".join)


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(st.lists(st.one_of(rides.map(json.dumps), cut, tailed), min_size=30, max_size=40))
def test_random_payloads(spark, payloads):
    check_standard(spark, payloads)
