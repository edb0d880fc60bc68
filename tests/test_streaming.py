"""Streaming jobs over landing folders: routing, restart, retry, fan-out, evolution, relay."""

import json
import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sample import ADDED, RIDE
from tollgate.model import MESSAGE, RAW, STANDARD
from tollgate.operators.raw import parse_raw
from tollgate.operators.routing import table_rows
from tollgate.operators.standard import parse_standard
from tollgate.operators import enrich, schema_driven, transforms, validate
from tollgate.plans import avro, reports, revisions, tables
from tollgate.sources.messages import merge_streams, stream_landing
from tollgate.streaming import jobs, monitor, stateful
from tollgate.workload.definitions import RIDE_V1, RIDE_V2, SCHEMA_NAME
from tollgate.workload.messages import events_as_messages

SF_DIR = "/root/testdata/sf0.001"
FAR = date(2100, 1, 1)


def land(spark, folder, payloads, start=0):
    rows = [
        (bytearray(p if isinstance(p, bytes) else p.encode()), {"source": "test"}, str(start + i), datetime(2026, 2, 10, 12, i % 60))
        for i, p in enumerate(payloads)
    ]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(str(folder))


@pytest.fixture
def names(tmp_path, spark):
    created = []

    def make(name):
        created.append(name)
        return name

    yield make
    for name in created:
        tables.drop_table(spark, name)
        tables.drop_table(spark, f"{name}_dlq")


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_standard_job_routes_restarts_and_lays_out(spark, tmp_path, names):
    table = names("rides_std")
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    jobs.create_tables(spark, table, STANDARD, str(tmp_path / "table"))
    target = jobs.Target(table, checkpoint, jobs.CATCH_UP)
    land(spark, landing, [json.dumps(RIDE)] * 4 + ["{broken", b"\xff\x41"])
    finish(jobs.start_standard(stream_landing(spark, str(landing)), "sub", target))
    assert spark.table(table).count() == 4
    dead = spark.table(f"{table}_dlq")
    assert sorted(r.original_payload for r in dead.collect()) == ["0xFF41", "{broken"]
    assert spark.table(table).columns[-2:] == ["batch_id", "publish_date"]
    assert dead.columns[-2:] == ["batch_id", "processing_date"]

    land(spark, landing, [json.dumps(RIDE)] * 3, start=10)
    finish(jobs.start_standard(stream_landing(spark, str(landing)), "sub", target))
    assert spark.table(table).count() == 7
    assert [r[0] for r in spark.table(table).select("batch_id").distinct().orderBy("batch_id").collect()] == [0, 1]


def test_a_job_never_creates_its_table(spark, tmp_path):
    land(spark, tmp_path / "landing", [json.dumps(RIDE)])
    target = jobs.Target("no_such_table", str(tmp_path / "cp"), jobs.CATCH_UP)
    with pytest.raises(tables.TableError):
        jobs.start_standard(stream_landing(spark, str(tmp_path / "landing")), "sub", target)


def test_a_retried_batch_replaces_itself(spark, tmp_path, names):
    table = names("rides_retry")
    jobs.create_tables(spark, table, RAW, str(tmp_path / "table"))
    messages = events_as_messages(spark, SF_DIR)
    write = jobs.fan_out(jobs.Target(table, "unused"))
    for batch_id in (0, 1, 1, 0):
        write(parse_raw(messages, "sub"), "w", batch_id)
    counts = {r.batch_id: r["count"] for r in spark.table(table).groupBy("batch_id").count().collect()}
    assert counts[0] == counts[1]
    assert counts[0] + spark.table(f"{table}_dlq").where("batch_id = 0").count() == 1000


def test_messages_of_one_small_file_are_dealt_to_all_cores(spark):
    own = events_as_messages(spark, SF_DIR).where("CAST(message_id AS BIGINT) % 4 = 1")
    tasks = own.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == spark.sparkContext.defaultParallelism
    assert sum(row["count"] for row in tasks) == 250


def test_rows_of_a_file_are_in_time_order(spark, tmp_path, names):
    table = names("rides_sorted")
    jobs.create_tables(spark, table, RAW, str(tmp_path / "table"))
    rows = table_rows(parse_raw(events_as_messages(spark, SF_DIR).orderBy(F.rand(1)), "sub"))
    tables.append_batch(rows, table, "w", 0, "publish_time")

    def by_file(part):
        found = {}
        for r in spark.table(table + part).select("publish_time", F.input_file_name().alias("f")).collect():
            found.setdefault(r.f, []).append(r.publish_time)
        assert all(times == sorted(times) for times in found.values())
        return found

    assert len(by_file("_recent")) <= 8  # a file per task, though the rows are of many days
    assert tables.compact(spark, table, FAR, ["w"]) == 1
    days = spark.table(table).select("publish_date").distinct().count()
    assert len(by_file("_days")) == days > 8
    start, end = F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-06").cast("timestamp")
    pruned = spark.table(table).where(tables.between("publish_time", start, end))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert any("publish_date" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])


def test_compaction_loses_and_doubles_nothing(spark, tmp_path, names, monkeypatch):
    """Run twice, cut off at each step, beside a retried batch, late rows, and a new column."""
    table = names("rides_compacted")
    jobs.create_tables(spark, table, RAW, str(tmp_path / "table"))
    rows = table_rows(parse_raw(events_as_messages(spark, SF_DIR), "sub")).cache()
    batch = [rows.where(F.expr(f"CAST(message_id AS LONG) % 4 = {i}")) for i in range(4)]

    def seen():
        return sorted((r.message_id, r.publish_time) for r in spark.table(table).collect())

    everything = sorted((r.message_id, r.publish_time) for r in rows.collect())
    for i in range(3):
        tables.append_batch(batch[i], table, "a" if i < 2 else "b", i, "publish_time")
    some = seen()
    middle = date(2024, 1, 15)

    class Cut(Exception):
        pass

    def cut(*args):
        raise Cut

    for step in ("_list_run", "_clean"):  # written but not listed; then listed but not cleaned
        kept = getattr(tables, step)
        # _clean also runs first, for runs before.
        monkeypatch.setattr(tables, step, cut if step == "_list_run" else (lambda *a, n=[0]: kept(*a) if n.append(0) or len(n) < 3 else cut()))
        with pytest.raises(Cut):
            tables.compact(spark, table, middle)
        monkeypatch.setattr(tables, step, kept)
        assert seen() == some
    # Nothing is left to move: the last batch of each writer stays.
    assert tables.compact(spark, table, middle) == 0 and seen() == some
    held = spark.table(f"{table}_recent")
    assert held.where("writer = 'a' AND batch_id = 0 AND publish_date < DATE '2024-01-15'").count() > 0  # its open days stay
    assert spark.table(f"{table}_days").where("publish_date >= DATE '2024-01-15'").count() == 0
    tables.append_batch(batch[1], table, "a", 1, "publish_time")
    tables.append_batch(batch[2], table, "b", 2, "publish_time")
    assert seen() == some
    tables.append_batch(batch[3], table, "a", 2, "publish_time")  # late rows of days that are closed
    assert seen() == everything
    assert tables.compact(spark, table, FAR, ["a", "b"]) == 2
    assert seen() == everything and tables.batches(spark, table) == []
    assert not [f for _, _, files in os.walk(tmp_path / "table" / "recent") for f in files if f.endswith(".parquet")]
    tables.append_batch(batch[0], table, "c", 0, "publish_time")
    wider = StructType([*RAW.fields, StructField("note", StringType())])
    assert tables.evolve_table(spark, table, wider, "publish_time") == ["note"]
    assert len(seen()) == len(everything) + batch[0].count()


def test_every_subscription_sees_every_message(spark, tmp_path, names):
    landing = tmp_path / "landing"
    land(spark, landing, [json.dumps(RIDE)] * 5)
    for name in ("rides_sub_a", "rides_sub_b"):
        table = names(name)
        jobs.create_tables(spark, table, RAW, str(tmp_path / name))
        target = jobs.Target(table, str(tmp_path / f"cp_{name}"), jobs.CATCH_UP)
        finish(jobs.start_raw(stream_landing(spark, str(landing)), name, target))
        assert spark.table(table).where(F.col("subscription_name") == name).count() == 5


def test_replay_of_the_raw_table_gives_the_typed_rows(spark, tmp_path, names):
    raw_table, typed = names("rides_raw"), names("rides_replayed")
    jobs.create_tables(spark, raw_table, RAW, str(tmp_path / "raw"))
    jobs.create_tables(spark, typed, STANDARD, str(tmp_path / "typed"))
    landing = tmp_path / "landing"
    events_as_messages(spark, SF_DIR).repartition(6).write.parquet(str(landing))
    finish(jobs.start_raw(stream_landing(spark, str(landing), max_files=3), "sub", jobs.Target(raw_table, str(tmp_path / "cp1"), jobs.CATCH_UP)))
    assert jobs.replay(spark, raw_table, jobs.Target(typed, "unused"), max_bytes=100_000) > 1
    raw_rows = spark.table(raw_table).count()
    assert spark.table(typed).count() + spark.table(f"{typed}_dlq").count() == raw_rows
    assert {r[0] for r in spark.table(typed).select("subscription_name").distinct().collect()} == {"sub"}

    # A raw batch that is retried has new files; a replay that is repeated replaces its batches.
    writer, batch_id = tables.batches(spark, raw_table)[0]
    stored = spark.table(raw_table).where((F.col("writer") == writer) & (F.col("batch_id") == batch_id))
    again = spark.createDataFrame(stored.select(*RAW.fieldNames()).collect(), RAW)
    tables.append_batch(again, raw_table, writer, batch_id, "publish_time")
    jobs.replay(spark, raw_table, jobs.Target(typed, "unused"))
    assert spark.table(typed).count() + spark.table(f"{typed}_dlq").count() == raw_rows


def test_replay_takes_few_jobs_for_many_batches(spark, tmp_path, names):
    """A thousand tiny batches of several writers, part of them compacted, in less than twenty jobs; and again."""
    raw_table, typed = names("rides_tiny"), names("rides_tiny_typed")
    jobs.create_tables(spark, raw_table, RAW, str(tmp_path / "raw"))
    jobs.create_tables(spark, typed, STANDARD, str(tmp_path / "typed"))
    messages = events_as_messages(spark, SF_DIR).drop("publish_time").withColumn("publish_time", F.timestamp_seconds(F.col("message_id").cast("long") * 4_000))
    rows = table_rows(parse_raw(messages, "sub")).selectExpr("*", "concat('w', CAST(message_id AS LONG) % 3) AS writer", "CAST(message_id AS LONG) DIV 3 AS batch_id")
    tables.replace_batches(rows, raw_table, "publish_time")
    n = len(tables.batches(spark, raw_table))
    assert n > 950
    assert tables.compact(spark, raw_table, date(1970, 1, 20)) == 1
    assert 0 < len(tables.batches(spark, raw_table)) < n

    def jobs_of(action):
        spark.sparkContext.setJobGroup("replay", "replay")
        try:
            action()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("replay"))

    def stored():
        return sorted(map(repr, spark.table(typed).drop("processing_time").collect()))

    target = jobs.Target(typed, "unused")
    assert jobs_of(lambda: jobs.replay(spark, raw_table, target)) < 20
    first = stored()
    assert len(first) + spark.table(f"{typed}_dlq").count() == n
    # Other groups, and a parse that refuses some batches' only row: these batches go.
    assert jobs.replay(spark, raw_table, target, max_bytes=20_000) > 5
    assert stored() == first

    def stricter(messages, subscription):
        return parse_standard(messages.where("CAST(message_id AS LONG) % 5 > 0"), subscription)

    jobs.replay(spark, raw_table, target, stricter)
    assert len(stored()) < len(first)
    tables.compact(spark, typed, FAR)
    with pytest.raises(tables.TableError, match="compacted"):
        jobs.replay(spark, raw_table, target)


def test_replay_reads_the_raw_table_as_often_for_many_groups(spark, tmp_path, names):
    raw_table, few, many = names("rides_groups"), names("rides_few"), names("rides_many")
    jobs.create_tables(spark, raw_table, RAW, str(tmp_path / "raw"))
    messages = events_as_messages(spark, SF_DIR).drop("publish_time").withColumn("publish_time", F.timestamp_seconds(F.col("message_id").cast("long")))
    rows = table_rows(parse_raw(messages, "sub")).selectExpr("*", "'w0' AS writer", "CAST(message_id AS LONG) DIV 50 AS batch_id")
    tables.replace_batches(rows, raw_table, "publish_time")
    taken = []
    for typed, max_bytes in ((few, 1 << 30), (many, 10_000)):
        jobs.create_tables(spark, typed, STANDARD, str(tmp_path / typed))
        spark.sparkContext.setJobGroup(typed, typed)
        try:
            groups = jobs.replay(spark, raw_table, jobs.Target(typed, "unused"), max_bytes=max_bytes)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        taken.append((groups, len(spark.sparkContext.statusTracker().getJobIdsForGroup(typed))))
    assert taken[0][0] == 1 and taken[1][0] > 10
    assert taken[1][1] <= taken[0][1] + 5
    stored = [sorted(map(repr, spark.table(typed).drop("processing_time").collect())) for typed in (few, many)]
    assert stored[0] == stored[1] and len(stored[0]) > 0


def test_schema_driven_fails_or_quarantines(spark, tmp_path, names):
    table = names("rides_strict")
    landing = tmp_path / "landing"
    land(spark, landing, [json.dumps(RIDE), json.dumps({**RIDE, "timestamp": "bad"})])
    jobs.create_tables(spark, table, avro.table_struct(RIDE_V1), str(tmp_path / "t"))
    query = jobs.start_schema_driven(
        stream_landing(spark, str(landing)), "sub", RIDE_V1, jobs.Target(table, str(tmp_path / "cp"), jobs.CATCH_UP)
    )
    with pytest.raises(Exception, match="BAD_TIMESTAMP:timestamp"):
        query.awaitTermination(120)
    assert spark.table(table).count() == 0
    finish(
        jobs.start_schema_driven(
            stream_landing(spark, str(landing)), "sub", RIDE_V1,
            jobs.Target(table, str(tmp_path / "cp2"), jobs.CATCH_UP), on_error="quarantine",
        )
    )
    assert spark.table(table).count() == 1
    assert spark.table(f"{table}_dlq").count() == 1


def test_relay_then_evolution(spark, tmp_path, names):
    """v1 runs, v2 is committed and the job restarted on its checkpoint, then v2 arrives."""
    registry, topic, table = str(tmp_path / "registry"), str(tmp_path / "topic"), names("rides_schema")
    landing = tmp_path / "landing"
    first = revisions.commit(spark, registry, SCHEMA_NAME, RIDE_V1)
    tables.evolve_table(spark, table, avro.table_struct(RIDE_V1), "publish_time", str(tmp_path / "table"))
    target = jobs.Target(table, str(tmp_path / "cp_table"), jobs.CATCH_UP)

    def relay(allowed):
        query = jobs.start_relay(stream_landing(spark, str(landing)), allowed, SCHEMA_NAME, topic, str(tmp_path / "cp_relay"), jobs.CATCH_UP)
        finish(query)
        return [p["observedMetrics"]["relay"] for p in query.recentProgress if "relay" in p["observedMetrics"]]

    missing = {k: v for k, v in RIDE.items() if k != "passenger_count"}
    land(spark, landing, [json.dumps(RIDE)] * 2 + [json.dumps(missing)])
    metrics = relay([first])
    assert sum(m["published"] for m in metrics) == 2 and sum(m["errors"] for m in metrics) == 1
    query = jobs.start_schema_driven(jobs.stream_topic(spark, topic), "sub", RIDE_V1, target)
    finish(query)
    assert spark.table(table).count() == 2

    query, allowed = jobs.evolve(
        spark, registry, SCHEMA_NAME, RIDE_V2, target, query, lambda: jobs.stream_topic(spark, topic), "sub"
    )
    finish(query)
    assert [r.ordinal for r in allowed] == [2, 1]
    assert tables.evolve_table(spark, table, avro.table_struct(RIDE_V2), "publish_time") == []
    v2 = {**RIDE, **ADDED}
    land(spark, landing, [json.dumps(v2)] * 3, start=20)
    relay(allowed)
    finish(jobs.start_schema_driven(jobs.stream_topic(spark, topic), "sub", RIDE_V2, target))
    rows = spark.table(table).collect()
    assert len(rows) == 5
    assert sum(r.region == ADDED["region"] for r in rows) == 3
    assert {r.schema_revision_id for r in rows} == {r.revision_id for r in allowed}
    assert {r.schema_name for r in rows} == {SCHEMA_NAME}


def test_evolution_resumes_after_a_cut_at_any_step(spark, tmp_path, names, monkeypatch):
    """Whatever step a call stopped after, repeating it ends as one whole call does."""
    table, wider = names("rides_cut"), [c.name for c in avro.table_struct(RIDE_V2)]
    first = revisions.commit(spark, str(tmp_path / "registry"), SCHEMA_NAME, RIDE_V1)
    for number, (owner, step) in enumerate([
        (revisions, "commit"), (revisions, "set_range"), (revisions, "load"), (tables, "evolve_table"), (jobs, "start_schema_driven"),
    ]):
        own = tmp_path / str(number)
        registry, topics, name = str(own / "registry"), str(own / "topics"), f"{table}_{number}"
        names(name)
        assert revisions.commit(spark, registry, SCHEMA_NAME, RIDE_V1) == first
        revisions.set_range(spark, topics, "rides", SCHEMA_NAME, 1, 1)
        tables.evolve_table(spark, name, avro.table_struct(RIDE_V1), "publish_time", str(own / "table"))
        land(spark, own / "landing", [json.dumps({**RIDE, **ADDED})])
        target = jobs.Target(name, str(own / "cp"), jobs.CATCH_UP)
        call = lambda: jobs.evolve(  # noqa: B023, E731
            spark, registry, SCHEMA_NAME, RIDE_V2, target, None, lambda: stream_landing(spark, str(own / "landing")), "sub",
            topics=topics, topic="rides",
        )
        done = getattr(owner, step)

        def cut(*args, **kwargs):
            result = done(*args, **kwargs)  # noqa: B023
            if step == "start_schema_driven":  # noqa: B023
                result.stop()
            raise ConnectionError(step)  # noqa: B023

        with monkeypatch.context() as patched:
            patched.setattr(owner, step, cut)
            with pytest.raises(ConnectionError):
                call()
        query, allowed = call()
        finish(query)
        assert [r.ordinal for r in allowed] == [2, 1]
        assert [(r.first, r.last) for r in revisions.ranges(spark, topics, "rides")] == [(1, 1), (1, 2)]
        assert set(wider) <= set(spark.table(name).columns)
        assert [r.region for r in spark.table(name).collect()] == [ADDED["region"]]


def test_evolution_keeps_a_raised_first_revision(spark, tmp_path, names):
    registry, topics, table = str(tmp_path / "registry"), str(tmp_path / "topics"), names("rides_raised")
    for definition in (RIDE_V1, RIDE_V2):
        revisions.commit(spark, registry, SCHEMA_NAME, definition)
    revisions.set_range(spark, topics, "rides", SCHEMA_NAME, 2, 2)
    tables.evolve_table(spark, table, avro.table_struct(RIDE_V2), "publish_time", str(tmp_path / "table"))
    third = json.loads(RIDE_V2)
    third["fields"].append({"name": "note", "type": ["null", "string"], "default": None})
    land(spark, tmp_path / "landing", [json.dumps(RIDE)])
    query, allowed = jobs.evolve(
        spark, registry, SCHEMA_NAME, json.dumps(third), jobs.Target(table, str(tmp_path / "cp"), jobs.CATCH_UP), None,
        lambda: stream_landing(spark, str(tmp_path / "landing")), "sub", topics=topics, topic="rides",
    )
    finish(query)
    assert [r.ordinal for r in allowed] == [3, 2]
    assert [(r.first, r.last) for r in revisions.ranges(spark, topics, "rides")] == [(2, 2), (2, 3)]


def test_jobs_take_transforms(spark, tmp_path, names):
    """Before delivery: refused messages are dead letters, filtered ones are counted. Before validation: refused are rejected."""
    table, landing = names("rides_linked"), tmp_path / "landing"
    jobs.create_tables(spark, table, STANDARD, str(tmp_path / "table"))
    point = lambda d: d["point_idx"].try_cast("bigint")
    links = [
        transforms.Link("point", refuses=lambda d: F.when(point(d) < 0, "TYPE_MISMATCH:point_idx")),
        enrich.ride_enrichment(),
        transforms.Link("north", keeps=lambda d: d["region"].try_cast("string") == "north", sets=lambda d: {"point_idx": point(d) + 1}),
    ]
    south, negative = {**RIDE, "latitude": 1.0}, {**RIDE, "point_idx": -1}
    land(spark, landing, [json.dumps({**RIDE, "point_idx": 7})] * 2 + [json.dumps(south), json.dumps(negative), "{broken", "[]"])
    target = jobs.Target(table, str(tmp_path / "cp"), jobs.CATCH_UP)
    query = jobs.start_standard(stream_landing(spark, str(landing)), "sub", target, links)
    finish(query)
    assert [r.point_idx for r in spark.table(table).collect()] == [8, 8]
    dead = {r.original_payload: r.error_message for r in spark.table(f"{table}_dlq").collect()}
    assert dead == {
        json.dumps(negative): "value does not have the type of the column: point_idx",
        "{broken": "payload is not exactly one JSON value",
    }
    counted = [p["observedMetrics"]["transforms"].asDict() for p in query.recentProgress if "transforms" in p["observedMetrics"]]
    assert counted == [{"delivered": 2, "filtered": 2, "refused": 2}]

    topic, first = str(tmp_path / "topic"), revisions.commit(spark, str(tmp_path / "registry"), SCHEMA_NAME, RIDE_V1)
    messages = stream_landing(spark, str(landing))
    finish(jobs.start_relay(messages, [first], SCHEMA_NAME, topic, str(tmp_path / "cp_relay"), jobs.CATCH_UP, links))
    reasons = [r.reject_reason for r in spark.read.parquet(topic).collect()]
    assert sorted(reasons, key=str) == ["INVALID_JSON", None, None, "TYPE_MISMATCH:point_idx"]


def test_two_producers_merge_into_one_stream(spark, tmp_path, names):
    table = names("rides_merged")
    jobs.create_tables(spark, table, RAW, str(tmp_path / "t"))
    for folder in ("a", "b"):
        land(spark, tmp_path / folder, [json.dumps(RIDE)] * 3)
    merged = merge_streams(*[stream_landing(spark, str(tmp_path / f)) for f in ("a", "b")])
    finish(jobs.start_raw(merged, "sub", jobs.Target(table, str(tmp_path / "cp"), jobs.CATCH_UP)))
    assert spark.table(table).count() == 6


def test_files_of_any_age_are_read(spark, tmp_path, names):
    table, landing = names("rides_old"), tmp_path / "landing"
    jobs.create_tables(spark, table, RAW, str(tmp_path / "t"))
    target = jobs.Target(table, str(tmp_path / "cp"), jobs.CATCH_UP)
    land(spark, landing, [json.dumps(RIDE)] * 5)
    finish(jobs.start_raw(stream_landing(spark, str(landing)), "sub", target))
    seen = set(os.listdir(landing))
    land(spark, landing, [json.dumps(RIDE)] * 4, start=10)
    old = time.time() - 10 * 86_400
    for name in set(os.listdir(landing)) - seen:
        os.utime(landing / name, (old, old))
    finish(jobs.start_raw(stream_landing(spark, str(landing)), "sub", target))
    assert spark.table(table).count() == 9


def test_writers_share_a_table(spark, tmp_path, names):
    """Two jobs, and one on a renewed checkpoint, append to one table and keep each other's rows."""
    table = names("rides_shared")
    jobs.create_tables(spark, table, STANDARD, str(tmp_path / "t"))
    land(spark, tmp_path / "a", [json.dumps(RIDE)] * 2 + ["{broken"])
    land(spark, tmp_path / "b", [json.dumps(RIDE)])
    for folder, checkpoint in (("a", "cp_a"), ("b", "cp_b"), ("b", "cp_b_renewed")):
        target = jobs.Target(table, str(tmp_path / checkpoint), jobs.CATCH_UP)
        finish(jobs.start_standard(stream_landing(spark, str(tmp_path / folder)), folder, target))
    assert spark.table(table).count() == 4 and spark.table(f"{table}_dlq").count() == 1
    assert len(tables.batches(spark, table)) == 3


def test_a_backlog_comes_in_several_batches(spark, tmp_path, names):
    table = names("rides_backlog")
    jobs.create_tables(spark, table, RAW, str(tmp_path / "t"))
    for start in (0, 10, 20):
        land(spark, tmp_path / "landing", [json.dumps(RIDE)] * 2, start=start)
    target = jobs.Target(table, str(tmp_path / "cp"), jobs.CATCH_UP)
    finish(jobs.start_raw(stream_landing(spark, str(tmp_path / "landing"), max_bytes=1), "sub", target))
    assert spark.table(table).count() == 6 and len(tables.batches(spark, table)) == 3


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path, names):
    """Across a restart: a repeat inside the delay goes, one outside it is a message again; no id, no repeat."""
    table, landing = names("rides_once"), tmp_path / "landing"
    jobs.create_tables(spark, table, RAW, str(tmp_path / "t"))
    target = jobs.Target(table, str(tmp_path / "cp"), jobs.CATCH_UP)

    def deliver(*rows):
        made = [(bytearray(json.dumps(RIDE).encode()), {}, key, at and datetime(2026, 2, 10, *at)) for key, at in rows]
        spark.createDataFrame(made, MESSAGE).coalesce(1).write.mode("append").parquet(str(landing))
        finish(jobs.start_raw(stateful.first_deliveries(stream_landing(spark, str(landing)), "10 minutes"), "sub", target))
        return sorted(r.message_id for r in spark.table(table).collect())

    assert deliver(("a", (12, 0)), ("a", (12, 0)), (None, (12, 0)), (None, (12, 0)), ("u", None), ("u", None)) == ["", "", "a", "u", "u"]
    assert deliver(("a", (12, 5)), ("b", (12, 6))) == ["", "", "a", "b", "u", "u"]
    # The watermark passes 12:10, where the first delivery expires.
    assert deliver(("c", (13, 0)), ("u", None)) == ["", "", "a", "b", "c", "u", "u", "u"]
    assert deliver(("a", (13, 1)), ("c", (13, 2))) == ["", "", "a", "a", "b", "c", "u", "u", "u"]


def test_closed_minutes_equal_the_report(spark, tmp_path, names):
    table, landing, progress = names("rides_minutes"), tmp_path / "landing", "rides_minutes_progress"
    tables.create_table(spark, table, stateful.MINUTES, "minute_time", str(tmp_path / "t"))
    target = jobs.Target(table, str(tmp_path / "cp"), jobs.CATCH_UP)
    monitor.Monitor.create_table(spark, progress)
    listener = monitor.Monitor(spark, progress)
    clean = events_as_messages(spark, SF_DIR, faults=False).orderBy("publish_time").cache()
    start = clean.agg(F.min("publish_time")).first()[0]
    days = [clean.where(f"publish_time IS NULL OR publish_time {order} TIMESTAMP '2024-01-15'") for order in ("<", ">=")]

    def run(messages):
        messages.coalesce(1).write.mode("append").parquet(str(landing))
        parsed = schema_driven.parse_schema_driven(stream_landing(spark, str(landing)), "sub", RIDE_V2)
        finish(stateful.start_minutes(parsed, target))

    spark.streams.addListener(listener)
    try:
        run(days[0])
        run(days[1])
        late = clean.where(F.col("publish_time") == F.lit(start))
        run(late)
        deadline = time.time() + 60
        while spark.table(progress).agg(F.sum("late_rows")).first()[0] != late.count() and time.time() < deadline:
            time.sleep(1)
            listener.flush()
    finally:
        spark.streams.removeListener(listener)
    assert spark.table(progress).agg(F.sum("late_rows")).first()[0] == late.count() > 0
    rows = schema_driven.parse_schema_driven(clean, "sub", RIDE_V2).where("publish_time <> processing_time")
    minutes = rows.groupBy(F.date_trunc("minute", "publish_time").alias("minute_time")).agg(*reports.minute_counts())
    end = rows.agg(F.max("publish_time")).first()[0]
    want = minutes.where(F.col("minute_time") + F.expr("INTERVAL 11 MINUTES") <= F.lit(end))
    got = spark.table(table).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 800
    newest = minutes.orderBy(F.desc("minute_time")).limit(reports.MINUTES).collect()
    assert [tuple(r)[1:] for r in reports.minute_timeline(rows).collect()] == [tuple(r)[1:] for r in newest]
    spark.sql(f"DROP TABLE {progress}")


def test_monitor_keeps_what_jobs_count(spark, tmp_path, names):
    progress, landing, table = "job_progress", tmp_path / "landing", names("rides_watched")
    monitor.Monitor.create_table(spark, progress)
    messages = events_as_messages(spark, SF_DIR)
    messages.repartition(4).write.parquet(str(landing))
    listener = monitor.Monitor(spark, progress, group=2)
    jobs.create_tables(spark, table, STANDARD, str(tmp_path / "t"))
    first = revisions.make_revision(SCHEMA_NAME, 1, RIDE_V1)
    spark.streams.addListener(listener)
    try:
        stream = stream_landing(spark, str(landing), max_files=2)
        finish(jobs.start_relay(stream, [first], SCHEMA_NAME, str(tmp_path / "topic"), str(tmp_path / "cp"), jobs.CATCH_UP))
        finish(jobs.start_standard(stream, "sub", jobs.Target(table, str(tmp_path / "cp2"), jobs.CATCH_UP)))
        deadline = time.time() + 60
        while spark.table(progress).agg(F.sum("input_rows")).first()[0] != 2000 and time.time() < deadline:
            time.sleep(1)
            listener.flush()
    finally:
        spark.streams.removeListener(listener)
    rows = spark.table(progress).collect()
    total = lambda key: sum(r.metrics.get(key, 0) for r in rows)
    want = validate.relay(messages, [first], SCHEMA_NAME).agg(*validate.relay_counts()).first()
    assert (total("relay.published"), total("relay.errors")) == tuple(want)
    assert total("ingest.rows") == spark.table(table).count() and total("ingest.dead_letters") == spark.table(f"{table}_dlq").count()
    watched = [r for r in rows if "ingest.rows" in r.metrics and r.input_rows]
    assert len(watched) == 2 and all(r.metrics["ingest.p95_lag_seconds"] > 0 and r.processed_rows_per_second > 0 for r in watched)
    spark.sql(f"DROP TABLE {progress}")
