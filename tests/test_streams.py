"""Streams over several micro-batches: replay, discovery and upserts, with late, repeated and broken batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from regloom.operators import discovery, readmodel, replay
from regloom.sources.versions import Versions
from regloom.streaming import streams

EVENTS = "k long, ts timestamp, i long, kind string"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(streams.STATE_STORE[0])
    spark.conf.set(*streams.STATE_STORE)
    yield spark
    spark.conf.set(streams.STATE_STORE[0], before)


def feed(spark, path, kind, batches):
    for rows in batches:
        df = rows if hasattr(rows, "schema") else spark.createDataFrame(rows, kind)
        df.coalesce(1).write.mode("append").parquet(path)


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def test_replay_over_batches_equals_the_batch_replay(rocks, tmp_path):
    r = random.Random(3)
    events = [(r.randrange(6), at(r.randrange(0, 3000)), i, r.choice(["current", "current", "repealed", "future", "review"])) for i in range(400)]
    events += [events[0], events[7]]  # repeated events
    slices = [[e for e in events if (e[1] - at(0)).total_seconds() / 60 + e[2] % 50 in range(b * 800, (b + 1) * 800)] for b in range(4)]  # up to 50 minutes out of order
    assert sum(map(len, slices)) == len(events)
    schema = rocks.createDataFrame([], EVENTS).schema
    feed(rocks, f"{tmp_path}/in", EVENTS, [*slices, streams.close_stream(schema, rocks, "k", "ts")])
    stream = streams.replay_stream(streams.file_stream(rocks, f"{tmp_path}/in", schema, 1), "k", "ts", "i", F.col("kind"), "2 hours")
    out = streams.run_available(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    assert out.where("late").count() == 0
    got = {r["key"]: (r["state"], r["ts"], r["ord"], r["n_reviews"], r["n_updates"], r["future_ts"], r["future_ord"]) for r in streams.latest_states(out).collect()}
    want = {}
    for r in replay.replay(rocks.createDataFrame(events, EVENTS), "k", ["ts", "i"], F.col("kind")).collect():
        since, future = r["since"] or (None, None), r["future"] or (None, None)
        want[r["k"]] = (r["state"], *since, r["n_reviews"], r["n_updates"], *future)
    assert got == want
    assert out.groupBy("key").count().where("count > 1").count() > 0  # states came out along the way


def test_late_events_come_out_beside(rocks, tmp_path):
    schema = rocks.createDataFrame([], EVENTS).schema
    batches = [[(1, at(0), 1, "current"), (2, at(5), 2, "repealed")], [(1, at(600), 3, "review")], [(1, at(900), 4, "review")], [(1, at(1), 5, "repealed"), (1, at(850), 6, "repealed")], [(1, at(2), 7, "current")]]
    feed(rocks, f"{tmp_path}/in", EVENTS, [*batches, streams.close_stream(schema, rocks, "k", "ts")])
    stream = streams.replay_stream(streams.file_stream(rocks, f"{tmp_path}/in", schema, 1), "k", "ts", "i", F.col("kind"), "1 hour")
    out = streams.run_available(stream, f"{tmp_path}/out", f"{tmp_path}/state")
    assert [(r["key"], r["ts"], r["ord"], r["kind"]) for r in out.where("late").collect()] == [(1, at(2), 7, "current")]  # the one of minute 1 still came in time, as nothing later was applied
    assert {(r["key"], r["state"], r["n_reviews"]) for r in streams.latest_states(out).collect()} == {(1, "repealed", 2), (2, "repealed", 0)}


def link(source, url, number="", day="", cls="public_tthc", pdf="p", **more):
    row = {"source": source, "url": url, "number": number, "day": day, "title": f"t {url}", "class": cls, "pdf": pdf, **more}
    return tuple(row.get(n) for n in discovery.LINKS.fieldNames())


BATCHES = [
    [link("a", "a1", "1/Q", "2024-01-01"), link("a", "a2", "2/Q")],
    [link("a", "a3", "3/Q", "2024-02-01"), link("a", "a4/", "3/Q", "2024-02-02"), link("a", "a1", "1/Q"), link("a", "a5", failed="timeout"), link("a", "a6", cls="external_reference"), link("a", "a7", cls="non_tthc"), link("a", "a8", cls="internal_process"), link("a", "a9", cls="internal_process", article_number="9/Q"), link("a", "b1"), link("a", "b2", "12/Q", pdf=""), link("a", "b3", "13/Q", cls="odd"), link("a", "b4", "14/Q", pdf_failed="404"), link("a", None), link(None, "x")],
    [link("n", "n1", "3/Q"), link("n", "n2", "30/Q"), link("a", "a5", "5/Q", "2024-03-01"), link("a", "a4", "3/Q"), link("a", "c1", "9/Q"), link("a", "b1"), link("a", "a3", "4/Q")],
    [link("n", "n3", "30/Q"), link("n", "n4", "5/Q"), link("a", "b2", "12/Q", article_day="2024-04-04"), link("n", "n5", "31/Q"), link("n", "n6", "31/Q", "2024-05-05")],
]
WANT = {
    "a1": ("baseline_only", "baseline_only"), "a2": ("baseline_only", "baseline_only"), "a3": ("public_tthc", "auto_discovered"), "a4": ("mirror_known_decision", "known_decision_new_listing_url"), "a5": ("public_tthc", "auto_discovered"),
    "a6": ("external_reference", "excluded_external_authority"), "a7": ("non_tthc", "excluded_non_tthc"), "a8": ("internal_process", "excluded_internal_unidentified"), "a9": ("internal_process", "excluded_internal"),
    "b1": ("needs_review", "missing_decision_number"), "b2": ("public_tthc", "auto_discovered"), "b3": ("needs_review", "unclassified_article"), "b4": ("needs_review", "pdf_download_failed: 404"), "c1": ("mirror_known_decision", "known_decision_new_listing_url"),
    "n1": ("public_tthc", "auto_discovered"), "n2": ("baseline_only", "baseline_only"), "n3": ("public_tthc", "auto_discovered"), "n4": ("mirror_known_decision", "known_decision_new_listing_url"), "n5": ("public_tthc", "auto_discovered"), "n6": ("mirror_known_decision", "known_decision_new_listing_url"),
}
DECISIONS = [("12/Q", "2024-04-04"), ("3/Q", "2024-02-01"), ("30/Q", ""), ("31/Q", "2024-05-05"), ("5/Q", "2024-03-01"), ("9/Q", "")]


def judged(state):
    urls = {r["url"].rstrip("/"): (r["class"], r["status"]) for r in state.where("kind = 'url'").collect()}
    return urls, sorted((r["number"], r["day"] or "") for r in state.where("kind = 'decision'").collect())


def test_discovery_over_batches(spark, tmp_path):
    state = spark.createDataFrame([], discovery.STATE)
    for rows in BATCHES:
        state = spark.createDataFrame(discovery.step(state, spark.createDataFrame(rows, discovery.LINKS)).drop("action").select(*discovery.STATE.fieldNames()).collect(), discovery.STATE)
    assert judged(state) == (WANT, DECISIONS)
    versions = Versions(spark, f"{tmp_path}/state", discovery.STATE)
    for n in (2, 4):  # two batches, a stop, and two more
        feed(spark, f"{tmp_path}/in", discovery.LINKS, BATCHES[n - 2 : n])
        streams.discovery_batches(streams.file_stream(spark, f"{tmp_path}/in", discovery.LINKS, 1), versions, f"{tmp_path}/checkpoint").awaitTermination()
    assert judged(versions.read()) == (WANT, DECISIONS)
    assert versions.batch == 3


def test_versions(spark, tmp_path):
    kind = "k long, v string"
    schema = spark.createDataFrame([], kind).schema
    table = Versions(spark, f"file://{tmp_path}/t", schema)
    assert table.read().count() == 0 and table.batch == -1
    add = lambda *rows: lambda now: now.unionByName(spark.createDataFrame(list(rows), kind))
    assert table.publish(add((1, "a")), 0) and not table.publish(add((9, "x")), 0)
    before = table.read()
    with pytest.raises(ValueError, match="stays"):
        table.publish(add((2, "b")), 1, lambda written, now: written.count() == now.count())

    def broken(now):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        table.publish(broken, 1)
    assert [tuple(r) for r in table.read().collect()] == [(1, "a")] and table.batch == 0
    swap, table._swap = table._swap, broken  # fails between write and swap
    with pytest.raises(RuntimeError):
        table.publish(add((2, "b")), 1)
    assert table.read().count() == 1 and len(table.unfinished()) == 1
    table._swap = swap
    assert table.publish(add((2, "b")), 1) and sorted(r["k"] for r in table.read().collect()) == [1, 2]
    assert before.count() == 1  # a reader of the version before can end
    assert table.publish(add((3, "c")), 2) and table.read().count() == 3 and table.batch == 2


def test_upserts_over_batches(spark, tmp_path):
    rows = "k string, name string, note string, status string, mine string, at long"
    model_kind = "k string, name string, status string, note string, mine string"
    log_kind = "k string, action string, before string, after string, batch long"
    model, log = (Versions(spark, f"{tmp_path}/{n}", spark.createDataFrame([], kind).schema) for n, kind in (("model", model_kind), ("log", log_kind)))

    def merge(now, new):
        return readmodel.upsert(now, new, "k", ["name", "status", "note"], ["mine"], "status", "held", "[gone]", "note")

    batches = [[("1", "a", "", "ok", "x", 1), ("1", "b", "", "ok", "x", 2)], [("1", "b", "", "ok", "y", 3), ("2", "c", "", "ok", "", 3)], [("2", "d", "", "ok", "z", 4)]]
    schema = spark.createDataFrame([], rows).schema
    run = lambda: streams.upsert_batches(streams.file_stream(spark, f"{tmp_path}/in", schema, 1), model, log, "k", "at", merge, f"{tmp_path}/checkpoint").awaitTermination()
    feed(spark, f"{tmp_path}/in", rows, batches[:2])
    run()
    feed(spark, f"{tmp_path}/in", rows, batches[2:])
    swap, model._swap = model._swap, lambda pointer: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(Exception, match="lost"):  # the log is live, the model is not
        run()
    assert (model.batch, log.batch) == (1, 2)
    model._swap = swap
    run()  # the same batch again
    assert sorted(tuple(r) for r in model.read().collect()) == [("1", "b", "held", "[gone]", "x"), ("2", "d", "ok", "", "")]
    assert sorted((r["batch"], r["k"], r["action"]) for r in log.read().collect()) == [(0, "1", "insert"), (1, "2", "insert"), (2, "1", "hold"), (2, "2", "update")]
