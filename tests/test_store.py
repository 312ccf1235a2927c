"""Stores of documents in the order of their keys."""

import re

import pytest
from pyspark.sql import functions as F

from nestframe import assemble, create_store, open_store, shred
from nestframe.functions.keys import root_label
from nestframe.sources import Store

MODEL = "k bigint, note string, items array<struct<x: int, marks: array<string>>>"


def document(k, note="n", n=3):
    return (k, note, [(i, [f"{k}-{i}-{j}" for j in range(i % 3)]) for i in range(n)])


def tables_of(spark, rows, model=MODEL):
    return shred(spark.createDataFrame(rows, model), "D", key="k", model=model, keys="path")


def contents(frame):
    return {r["k"]: (r["note"], [(i["x"], tuple(i["marks"])) for i in r["items"]]) for r in frame.collect()}


def wanted(rows):
    return {k: (note, [(x, tuple(marks)) for x, marks in items]) for k, note, items in rows}


def new_database(spark, name):
    spark.sql(f"CREATE DATABASE {name}")
    return name


def files_read(frame):
    return {re.sub(".*_slice=([^/]*)/.*", r"\1", path) for path in frame.inputFiles()}


@pytest.fixture(scope="module")
def filled(spark):
    rows = [document(k, n=12 if k == 5 else 3) for k in range(-20, 60)]
    return rows, create_store(tables_of(spark, rows), new_database(spark, "filled_store"), slots=8)


def test_keys_sort_as_documents_and_lists_do(spark):
    tables = tables_of(spark, [document(k, n=12) for k in (-3, 7, 30)])
    items = tables["D_items"].collect()
    by_key = [(r["D_id"], r["_pos"]) for r in sorted(items, key=lambda r: r["D_items_id"])]
    assert by_key == sorted(by_key)
    marks = [r["D_items_id"] for r in tables["D_items_marks"].collect()]
    assert set(marks) <= {r["D_items_id"] for r in items}
    texts = spark.createDataFrame([("a/b",), ("a%2Fb",), ("a",)], "k string").select(root_label(F.col("k"), "k"))
    assert len({r[0] for r in texts.collect()}) == 3 and not any("/" in r[0] for r in texts.collect())


def test_whole_and_parts(spark, filled):
    rows, store = filled
    assert contents(assemble(store.tables())) == wanted(rows)
    again = open_store(spark, store.layout, "filled_store")
    assert contents(again.get([5, -20, 59, 1000])) == wanted([r for r in rows if r[0] in (5, -20, 59)])
    assert contents(again.get([])) == {}
    many = list(range(-20, 40))
    assert contents(again.get(many)) == wanted([r for r in rows if r[0] in many])
    for n in (1, 7, 33, 500):
        assert contents(again.first(n)) == wanted(rows[:n])


def test_only_the_slots_of_the_keys_are_read(filled, capsys):
    _, store = filled
    one = store._rows_of([5])
    for frame in one.frames.values():
        assert len(files_read(frame)) == 1
    assert len(files_read(store.tables()["D"])) == 8
    one["D_items_marks"].explain("formatted")
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", capsys.readouterr().out)[1]
    assert "GreaterThanOrEqual(D_items_id" in pushed and "LessThan(D_items_id" in pushed


def test_replacing_rewrites_only_the_slots_concerned(spark):
    rows = [document(k) for k in range(80)]
    store = create_store(tables_of(spark, rows), new_database(spark, "replaced"), slots=8)
    before = files_read(store.tables()["D"])
    change = [document(3, "new", 1), document(4), document(500, "last", 2), document(-1, "first", 0)]
    counts = store.put(tables_of(spark, change))
    assert counts == {"added": 2, "replaced": 1, "same": 1, "rewritten": 1}
    now = {**wanted(rows), **wanted(change)}
    assert contents(assemble(store.tables())) == now
    after = files_read(store.tables()["D"])
    assert len(before - after) == 1 and len(before & after) == 7
    assert store.put(tables_of(spark, change)) == {"added": 0, "replaced": 0, "same": 4, "rewritten": 0}
    assert contents(store.first(1)) == wanted([document(-1, "first", 0)])
    dropped = store.vacuum()
    assert set(dropped) == before - after
    assert contents(assemble(store.tables())) == now


def test_a_write_that_stops_is_not_seen(spark, monkeypatch):
    rows = [document(k) for k in range(40)]
    store = create_store(tables_of(spark, rows), new_database(spark, "stopped"), slots=4)
    change = tables_of(spark, [document(7, "new", 5), document(99, "more", 1)])

    def stop(*_):
        raise RuntimeError("stopped")

    # Stopped after all rows are written, and after those of the root only.
    with monkeypatch.context() as patch:
        patch.setattr(Store, "_publish", stop)
        with pytest.raises(RuntimeError):
            store.put(change)
    assert contents(assemble(store.tables())) == wanted(rows)
    layout = store.layout
    half = change.with_frames({"D_items": change["D_items"].withColumn("x", F.raise_error(F.lit("stopped")).cast("int"))})
    with pytest.raises(Exception, match="stopped"):
        store._write(half, None, store._state()["bounds"], "halfway")
    assert contents(assemble(store.tables())) == wanted(rows)
    assert open_store(spark, layout, "stopped").put(change)["replaced"] == 1
    assert contents(assemble(store.tables())) == {**wanted(rows), **wanted([document(7, "new", 5), document(99, "more", 1)])}
    assert store.vacuum() and not store.vacuum()


def test_refused(spark, filled):
    _, store = filled
    with pytest.raises(ValueError):
        create_store(tables_of(spark, [document(1)]), "filled_store")
    other = tables_of(spark, [(1, "n", [], 2)], MODEL + ", more int")
    with pytest.raises(ValueError):
        store.put(other)
    with pytest.raises(ValueError):
        shred(spark.createDataFrame([document(1)], MODEL), "D", key="k", keys="other")


def test_empty_store(spark):
    store = create_store(tables_of(spark, []), new_database(spark, "emptystore"))
    assert contents(assemble(store.tables())) == {} and contents(store.first(3)) == {}
    assert store.put(tables_of(spark, [document(1)]))["added"] == 1
    assert contents(store.first(3)) == wanted([document(1)])


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_many_and_few_offered_documents_are_told_apart_alike(spark, monkeypatch, few):
    monkeypatch.setattr("nestframe.sources.store.FEW_LABELS", few)
    rows = [document(k) for k in range(20)]
    store = create_store(tables_of(spark, rows), new_database(spark, f"offered_{few}"), slots=4)
    offered = [document(k, "new" if k == 3 else "n") for k in range(2, 22)]
    assert store.put(tables_of(spark, offered)) == {"added": 2, "replaced": 1, "same": 17, "rewritten": 1}
    assert contents(assemble(store.tables())) == wanted([*rows[:2], *offered])
