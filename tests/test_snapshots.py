"""Snapshot tables: whole versions, lost runs, key index, declarations."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ordermill.plans.batch_job import create_raw, ingest_orders
from ordermill.schemas import ORDER_COLUMNS
from ordermill.sources import files
from ordermill.sources.snapshots import ConcurrentWrite, SnapshotTable
from tests.helpers import GOOD

SCHEMA = "k string, p date, v int"
DAY = [dt.date(2026, 1, d) for d in range(1, 29)]


@pytest.fixture()
def table(spark, tmp):
    t = SnapshotTable(spark, f"{tmp}/t")
    rows = spark.createDataFrame([(f"k{i}", DAY[i % 20], i) for i in range(200)], SCHEMA)
    assert t.create(rows.schema, ["k"], ["p"]) and not t.create(rows.schema)
    t.overwrite(rows)
    return t


def _rows(df):
    return sorted((r["k"], r["p"], r["v"]) for r in df.collect())


def test_an_upsert_reads_and_replaces_only_partitions_of_its_keys(spark, table):
    old, before = table.read(), set(table.snapshot()["folders"])
    was = _rows(old)
    source = spark.createDataFrame([("k3", DAY[3], -1), ("k45", DAY[7], -2), ("new", DAY[25], -3)], SCHEMA)
    # k45 moves from day 5 to day 7
    touched = table.touched(source, table.snapshot())
    assert {f.split("/")[0] for f in touched} == {f"p={DAY[i]}" for i in (3, 5, 7)}
    assert len(table._scan("data", table.snapshot()["schema"], touched).inputFiles()) < len(old.inputFiles()) / 4
    table.upsert(source)
    want = {r[0]: r for r in was} | {"k3": ("k3", DAY[3], -1), "k45": ("k45", DAY[7], -2), "new": ("new", DAY[25], -3)}
    assert _rows(table.read()) == sorted(want.values())
    assert _rows(old) == was and _rows(table.read(1)) == was     # a reader of the old version is not disturbed
    after = set(table.snapshot()["folders"])
    assert before - after == set(touched) and len(after - before) == 4
    assert not os.listdir(f"{table.path}/_staging")


@pytest.mark.parametrize("step", ["_write", "_folders", "_commit", "touched"])
def test_a_run_lost_at_any_step_leaves_the_old_version(spark, table, monkeypatch, step):
    was, source = _rows(table.read()), spark.createDataFrame([("k3", DAY[9], -1)], SCHEMA)

    def lost(*a, **kw):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, step, lost)
        with pytest.raises(RuntimeError):
            table.upsert(source)
    assert _rows(table.read()) == was
    table.upsert(source)
    assert _rows(table.read()) == sorted([r for r in was if r[0] != "k3"] + [("k3", DAY[9], -1)])
    table.expire(1)
    assert _rows(table.read()) == sorted([r for r in was if r[0] != "k3"] + [("k3", DAY[9], -1)])
    kept = {f.split("_commit=")[1] for f in table._folders("*", ["p"])}
    assert kept == {f.split("_commit=")[1] for f in table.snapshot()["folders"]} and not os.listdir(f"{table.path}/_staging")


def test_the_first_of_two_writers_wins(spark, table):
    state = table.snapshot()
    table.append(spark.createDataFrame([("a", DAY[0], 1)], SCHEMA))
    with pytest.raises(ConcurrentWrite):
        table._switch(state, [])
    assert table.read().count() == 201 and table.versions() == [0, 1, 2]
    assert not [n for n in os.listdir(f"{table.path}/_snapshots") if n.startswith("draft")]


def test_null_keys_and_partitions_and_repeated_keys(spark, table):
    table.upsert(spark.createDataFrame([(None, None, 1), (None, DAY[2], 2), ("k1", None, 3)], SCHEMA))
    table.upsert(spark.createDataFrame([(None, None, 4), ("k1", DAY[1], 5)], SCHEMA))
    got = [(r["k"], r["p"], r["v"]) for r in table.read().where("k is null or k = 'k1'").collect()]
    assert sorted(got, key=str) == sorted([(None, None, 1), (None, DAY[2], 2), (None, None, 4), ("k1", DAY[1], 5)], key=str)
    with pytest.raises(ValueError, match="more than once"):
        table.upsert(spark.createDataFrame([("x", DAY[0], 1), ("x", DAY[1], 2)], SCHEMA))
    table.upsert(spark.createDataFrame([], SCHEMA))
    assert table.read().count() == 203
    assert table.insert_new(spark.createDataFrame([("k7", DAY[20], 0), ("n", DAY[20], 0)], SCHEMA))
    assert table.read().count() == 204


def test_stored_declaration_holds_every_writer(spark, table):
    for bad in ("k string, p date", "k string, p date, v string", "k string, p date, v int, w int"):
        with pytest.raises(ValueError):
            table.append(spark.createDataFrame([], bad))
    strict = SnapshotTable(spark, f"{table.path}2")
    schema = spark.createDataFrame([], SCHEMA).schema
    schema["k"].nullable = False
    strict.create(schema, ["k"])
    with pytest.raises(Exception, match="null in NOT NULL column k"):
        strict.append(spark.createDataFrame([(None, DAY[0], 1)], SCHEMA))
    assert strict.read().count() == 0
    with pytest.raises(ValueError):
        table.evolve(spark.createDataFrame([], "k string, p date").schema)
    wider = spark.createDataFrame([], SCHEMA + ", w string").schema
    table.evolve(wider)
    table.append(spark.createDataFrame([("w", DAY[0], 1, "x")], wider))
    assert table.read().where("w is null").count() == 200 and table.read().where("w = 'x'").count() == 1
    pruned = table.read().where(F.col("p") >= DAY[18])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in pruned


def test_repeated_keys_since_a_version(spark, table):
    first = table.snapshot()["version"]
    table.append(spark.createDataFrame([("k3", DAY[21], 0), ("z", DAY[21], 0)], SCHEMA))
    assert [(r["k"], r["cnt"]) for r in table.duplicates_since(first).collect()] == [("k3", 2)]
    second = table.snapshot()["version"]
    table.append(spark.createDataFrame([("q", DAY[21], 0)], SCHEMA))
    assert table.duplicates_since(second).count() == 0
    full = files.duplicate_keys(table.read(), ["k"])
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, table.duplicates_since(0).collect()))


def test_raw_tables_as_snapshots(spark, tmp):
    raw = f"{tmp}/raw"
    create_raw(spark, raw, snapshots=True)

    def load(name, *rows):
        with open(f"{tmp}/{name}", "w") as f:
            f.write("\n".join([",".join(ORDER_COLUMNS)] + [",".join(dict(GOOD, **r)[c] for c in ORDER_COLUMNS) for r in rows]) + "\n")
        return ingest_orders(spark, f"{tmp}/{name}", raw)
    load("a.csv", {"order_id": "A"}, {"order_id": "B", "quantity": "0"})
    load("b.csv", {"order_id": "A", "order_date": "2026-06-01"}, {"order_id": "B", "quantity": "0"}, {"order_id": "C"})
    stored = SnapshotTable(spark, f"{raw}/orders_batch")
    assert sorted((r["order_id"], str(r["order_date"])) for r in stored.read().collect()) == [("A", "2026-06-01"), ("C", "2026-05-30")]
    assert files.read_table(spark, f"{raw}/orders_batch_errors").count() == 1
    assert json.loads(open(f"{raw}/orders_batch/_snapshots/{0:020d}.json").read())["keys"] == ["order_id"]


def test_many_batches_give_few_folders_and_replays_nothing(spark, table):
    start = table.read().count()
    for n in range(12):
        table.append(spark.createDataFrame([(f"b{n}", DAY[21], n)], SCHEMA), ("run", n), folders_at_most=4)
    held = [f for f in table.snapshot()["folders"] if f.startswith(f"p={DAY[21]}/")]
    assert len(held) <= 4 and table.read().count() == start + 12
    version = table.snapshot()["version"]
    table.append(spark.createDataFrame([("b3", DAY[21], 3)], SCHEMA), ("run", 3), folders_at_most=4)     # merged since
    assert table.snapshot()["version"] == version and table.read().count() == start + 12
    table.append(spark.createDataFrame([("b3", DAY[21], 3)], SCHEMA), ("other run", 0))
    assert table.read().count() == start + 13
    table.expire(2)
    assert len(table.versions()) == 2 and table.read().count() == start + 13


def test_an_append_that_meets_another_writer_tries_again(spark, table, monkeypatch):
    write = SnapshotTable._write

    def overtaken(self, rows, state, tag):
        folders = write(self, rows, state, tag)
        monkeypatch.setattr(SnapshotTable, "_write", write)
        SnapshotTable(spark, table.path).append(spark.createDataFrame([("first", DAY[1], 0)], SCHEMA))
        return folders
    monkeypatch.setattr(SnapshotTable, "_write", overtaken)
    table.append(spark.createDataFrame([("second", DAY[1], 0)], SCHEMA), ("run", 0))
    assert table.read().where("k in ('first', 'second')").count() == 2


def test_reconciliation_looks_at_new_folders_only(spark, table):
    schema = SCHEMA
    assert table.reconcile(["v"]) == {"duplicate_keys_before": 0, "duplicate_keys_after": 0}
    table.append(spark.createDataFrame([("k3", DAY[21], 500), ("k3", DAY[22], -5), ("k4", DAY[4], 900), ("new", DAY[22], 1)], schema))
    before = set(table.snapshot()["folders"])
    assert table.reconcile(["v"]) == {"duplicate_keys_before": 2, "duplicate_keys_after": 0}
    got = [r for r in _rows(table.read()) if r[0] in ("k3", "k4", "new")]
    assert got == [("k3", DAY[22], -5), ("k4", DAY[4], 4), ("new", DAY[22], 1)] and table.read().count() == 201
    gone = {f.split("/")[0] for f in before - set(table.snapshot()["folders"])}
    assert gone == {f"p={DAY[i]}" for i in (3, 4, 21)}          # day 22 loses nothing and is not rewritten
    state = table.snapshot()
    _, folders = table._repeated(state, set(state["reconciled"]))
    assert folders == []                                        # nothing new: no rows are read


def test_stream_into_snapshot_tables(spark, tmp):
    from ordermill.sources.messages import read_message_stream
    from ordermill.streaming.orders_stream import start
    from ordermill.streaming.reconcile import reconcile_sink
    raw = f"{tmp}/raw"
    create_raw(spark, raw, snapshots=True)
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")

    def run(checkpoint, *ids, early=None):
        texts = [json.dumps(dict(GOOD, order_id=i, source_system="stream", event_timestamp=stamp)) for i in ids] + ["bad"]
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(f"{tmp}/{checkpoint}-in")
        q = start(read_message_stream(spark, f"{tmp}/{checkpoint}-in"), f"{raw}/orders_stream", f"{raw}/orders_stream_errors",
                  f"{tmp}/{checkpoint}", trigger={"availableNow": True}, sinks_must_exist=True, early_s=early)
        assert q.awaitTermination(120) and q.exception() is None
    run("ck1", "A", "B")
    run("ck2", "A", "C", early=30)
    good = files.read_table(spark, f"{raw}/orders_stream")
    assert sorted(r["order_id"] for r in good.collect()) == ["A", "A", "B", "C"]
    assert good.where("pane is null").count() == 2
    assert reconcile_sink(spark, f"{raw}/orders_stream") == {"duplicate_keys_before": 1, "duplicate_keys_after": 0}
    assert files.read_table(spark, f"{raw}/orders_stream").count() == 3
    assert files.read_table(spark, f"{raw}/orders_stream_errors").count() == 2
