"""Documents in pieces give the answers that documents in one row give."""

import pytest
from pyspark.sql import functions as F

from nestframe import (
    DocumentTables,
    assemble,
    canonical,
    count_documents,
    difference,
    durable,
    fetch,
    having,
    shred,
    table_layout,
)
from nestframe.operators import assemble as assemble_function
from nestframe.operators.assemble import _assembled
from nestframe.operators.pieces import may_be_pieces

MODEL = """
    name string, n int, flags array<int>, owner struct<x: int, marks: array<string>>,
    items array<struct<label: string, weight: double, values: array<int>,
                       subs: array<struct<y: int, tags: array<string>>>>>
"""
SIZES = [1, 3, None]


def item(label, n, weight=1.0):
    subs = [(j % 3, ["t"] * (j % 4)) for j in range(n)]
    return (label, weight, [5 - j for j in range(n)], subs)


ROWS = [
    ("a", 1, [3, 1, 2, 1, None], (7, ["p", "q", "p"]), [item("b", 5), item("a", 0), item("b", 4), item(None, 9)]),
    ("b", None, [], None, []),
    ("c", 2, [9], (None, []), [item("z", 1, None)]),
    ("d", 3, [1, 1, 1], (1, ["only"]), [item("k", 7)]),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(ROWS, MODEL)


@pytest.fixture(scope="module")
def tables(documents):
    tables = shred(documents, "D", key="name")
    return tables.with_frames({name: durable(frame) for name, frame in tables.frames.items()})


def rows_of(tables):
    return {n: sorted(map(tuple, f.select(sorted(f.columns)).collect()), key=repr) for n, f in tables.frames.items()}


def written(frame):
    """Written and read again, but still known to be whole if it was."""
    kept = durable(frame)
    return kept if may_be_pieces(frame) else kept.withColumn("_part", F.lit("0"))


def keep_names(tables, size):
    fields = ["name", "n", "flags", "owner.x", "owner.marks", "items.label", "items.weight", "items.values"]
    return written(assemble(tables, [*fields, "items.subs.y", "items.subs.tags"], size))


@pytest.mark.parametrize("size", SIZES)
def test_taking_pieces_apart_gives_the_same_tables(tables, size):
    again = shred(written(assemble(tables, list_size=size)), "D", key="name", model=MODEL)
    assert rows_of(again) == rows_of(tables)


@pytest.mark.parametrize("size", SIZES)
def test_difference(spark, documents, tables, size):
    rebuilt = keep_names(tables, size)
    assert may_be_pieces(rebuilt) == (size is not None)
    assert tuple(difference(documents, rebuilt).first()) == (0, 0)
    assert tuple(difference(rebuilt, documents).first()) == (0, 0)
    changed = [(*row[:4], [(*i[:3], [*i[3][:-1], (8, ["t"])]) if i[0] == "k" else i for i in row[4]]) for row in ROWS]
    other = spark.createDataFrame(changed, MODEL)
    assert tuple(difference(other, rebuilt).first()) == (1, 1)
    moved = [(*row[:2], row[2][::-1], *row[3:]) for row in ROWS]
    assert tuple(difference(spark.createDataFrame(moved, MODEL), rebuilt).first()) == (1, 1)
    null_list = [(*row[:2], row[2] or None, *row[3:]) for row in ROWS]
    assert tuple(difference(spark.createDataFrame(null_list, MODEL).union(documents), rebuilt).first()) == (4, 0)


CONDITIONS = [
    ("flags", lambda v: v == 1, {"at_least": 3}, {"d"}),
    ("flags", lambda v: v == 1, {}, {"a", "d"}),
    ("flags", lambda v: v > 0, {"every": True}, {"b", "c", "d"}),
    ("items.label", lambda v: v == "b", {"at_least": 2}, {"a"}),
    ("items.label", lambda v: v.isNotNull(), {"every": True}, {"b", "c", "d"}),
    ("items.values", lambda v: v <= 0, {"at_least": 4}, {"a"}),
    ("items.subs.y", lambda v: v == 2, {"at_least": 3}, {"a"}),
    ("items.subs.tags", lambda v: v == "t", {"at_least": 9}, {"a", "d"}),
    ("owner.x", lambda v: v == 7, {}, {"a"}),
    ("owner.marks", lambda v: v == "p", {"at_least": 2}, {"a"}),
    ("n", lambda v: v >= 2, {}, {"c", "d"}),
]


@pytest.mark.parametrize("size", SIZES)
def test_quantifiers_see_all_pieces(tables, size):
    documents = written(assemble(tables, list_size=size))
    for path, test, how, wanted in CONDITIONS:
        found = having(documents, path, test, **how)
        assert {r["name"] for r in found.collect()} == wanted, path
        assert count_documents(found) == len(wanted)
        assert found.count() == documents.where(F.col("name").isin(*wanted)).count()


@pytest.mark.parametrize("size", [3])
def test_canonical(spark, documents, tables, size):
    turned = [
        (*row[:2], row[2][::-1], row[3] and (row[3][0], row[3][1][::-1]),
         [(i[0], i[1], i[2][::-1], [(s[0], s[1][::-1]) for s in i[3]][::-1]) for i in row[4]][::-1])
        for row in ROWS
    ]
    plain = canonical(documents, "label")
    assert tuple(difference(plain, documents).first()) != (0, 0)
    assert tuple(difference(plain, canonical(spark.createDataFrame(turned, MODEL), "label")).first()) == (0, 0)
    other = shred(spark.createDataFrame(turned, MODEL), "D", key="name")
    assert tuple(difference(plain, canonical(keep_names(other, size), "label", size)).first()) == (0, 0)


@pytest.mark.parametrize("size", SIZES)
def test_fetch_counts_documents(tables, size):
    found = fetch(tables, max_rows=2, list_size=size)
    assert {r["name"] for r in found.collect()} == {"a", "b"}
    assert count_documents(found) == 2
    assert found.agg(F.sum(F.size("flags"))).first()[0] == 5
    sub = fetch(tables, name="D_items", max_rows=None, list_size=size)
    assert count_documents(sub) == 6


def test_only_documents_beyond_a_row_come_in_pieces(spark, tables, monkeypatch):
    module = assemble_function.__globals__
    monkeypatch.setitem(module, "ROWS_PER_DOCUMENT", 20)
    stored = tables.with_frames({}, rows_fit=False)
    rows = assemble(stored).collect()
    counts = {n: sum(r["name"] == n for r in rows) for n in "abcd"}
    # Document a has 30 tags in its items, no list of any other has more than 20 items.
    assert counts["a"] > 1 and counts["b"] == counts["c"] == counts["d"] == 1
    assert tuple(difference(spark.createDataFrame(ROWS, MODEL), keep_names(stored, None)).first()) == (0, 0)
    monkeypatch.setitem(module, "ROWS_PER_DOCUMENT", 200_000)
    assert not may_be_pieces(assemble(stored)) and assemble(stored).count() == 4


def test_rows_that_share_a_position_are_counted(spark):
    layout = table_layout("values array<int>", "D")
    values = spark.range(500).select(F.lit("k").alias("D_id"), F.lit(0).alias("_pos"), F.col("id").cast("int").alias("values"))
    roots = values.select("D_id").distinct()
    pieces = assemble(DocumentTables(layout, {"D": roots, "D_values": values}), list_size=100).collect()
    assert sorted(len(r["values"]) for r in pieces) == [100] * 5
    assert sorted(v for r in pieces for v in r["values"]) == list(range(500))


def test_bad_keys(spark):
    rows = [(None, [1, 2]), (5, [1, 2]), (5, [3]), (6, [4]), (7, [])]
    frame = spark.createDataFrame(rows, "k int, l array<int>")
    with pytest.raises(ValueError):
        shred(frame, "D", key="k")
    tables = shred(frame, "D", key="k", bad_keys="reject")
    assert {(r["k"], tuple(r["l"])) for r in assemble(tables).collect()} == {(6, (4,)), (7, ())}
    assert {tuple(r)[:2] for r in tables.rejected.collect()} == {(None, "missing"), (5, "repeated")}
    assert shred(frame, "D", key="k", bad_keys="trust")["D_l"].count() == 6
    assert shred(frame.where("k > 5"), "D", key="k").rejected is None
    with pytest.raises(ValueError):
        shred(frame.where("k = 5"), "D", key=["k"])
    with pytest.raises(ValueError):
        shred(frame, "D", key="k", bad_keys="ignore")


def test_schema_tells_whether_there_may_be_pieces(tables):
    whole, pieces = assemble(tables), assemble(tables, list_size=1)
    assert not may_be_pieces(whole) and may_be_pieces(pieces)
    assert may_be_pieces(whole.unionByName(pieces)) and may_be_pieces(pieces.unionByName(whole))
    assert not may_be_pieces(whole.drop("_part"))


CHAINS = [
    ("k int, l array<int>", [(1, list(range(7))), (2, []), (3, [None, 5])]),
    (
        "k int, s string, o array<struct<n: int, l: array<struct<x: string, y: int>>>>",
        [(1, "a", [(i, [(f"{i}-{j}", j) for j in range(i)]) for i in range(8)]), (2, None, []), (3, "c", [(None, [])])],
    ),
    (
        "k int, o struct<n: int, p: array<struct<m: int, q: struct<r: int, l: array<int>>>>>",
        [(1, (5, [(1, (2, [1, 2, 3, 4, 5])), (2, None), (3, (None, [])), (4, (9, [7]))])), (2, None), (3, (None, []))],
    ),
]


@pytest.mark.parametrize("size", [1, 2, 3])
@pytest.mark.parametrize("model, rows", CHAINS)
def test_cut_documents_are_the_pieces_put_together_one_by_one(spark, model, rows, size):
    tables = shred(spark.createDataFrame(rows, model), "D", key="k")
    cut, pieces = assemble(tables, list_size=size), _assembled(tables, tables.layout, size)
    assert cut.columns == pieces.columns and may_be_pieces(cut)
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, pieces.collect()))


def test_documents_too_large_for_a_row_are_not_put_in_one(spark, monkeypatch):
    monkeypatch.setitem(assemble_function.__globals__, "ROWS_PER_DOCUMENT", 20)
    model, rows = CHAINS[1]
    tables = shred(spark.createDataFrame(rows, model), "D", key="k").with_frames({}, rows_fit=False)
    pieces = _assembled(tables, tables.layout, 2)
    assert sorted(map(repr, assemble(tables, list_size=2).collect())) == sorted(map(repr, pieces.collect()))


def test_each_table_is_evaluated_once_for_pieces(spark):
    model, rows = CHAINS[1]
    tables = shred(spark.createDataFrame(rows, model), "D", key="k")
    tables = tables.with_frames({name: durable(frame) for name, frame in tables.frames.items()})
    plan = assemble(tables, list_size=2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3
