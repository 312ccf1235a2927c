"""Lists side by side, against rows made one by one, and documents chosen by several of them."""

import pytest

from pyspark.sql import functions as F

from nestframe import Condition, DocumentTables, flatten_aligned, matching_keys, shred, table_layout

MODEL = """
    name string, tags array<string>, owner struct<x: int, marks: array<int>>,
    parts array<struct<label: string, marks: array<int>, bolts: array<struct<name: string>>>>
"""
ROWS = [
    ("a", ["t0", "t1", "t2", "t3", "t4", "t5"], (7, [1, 2]), [("p0", [1, 2, 3], [("m4",)]), ("p1", [], []), ("p2", [9], [("m5",), ("m6",)])]),
    ("b", [], None, []),
    ("c", [], (None, []), [("q", [], [])]),
    ("d", ["only"], None, []),
    ("e", [], (1, [1, 2, 3, 4]), [("r", [5], [])]),
]


def side_by_side(*lists):
    """Row by row the dicts of all lists that have one."""
    return [
        {k: v for rows in lists if i < len(rows) for k, v in rows[i].items()}
        for i in range(max((len(rows) for rows in lists), default=0))
    ]


def below(common, *lists):
    return [{**common, **row} for row in side_by_side(*lists) or [{}]]


def plain(rows):
    found = []
    for name, tags, owner, parts in rows:
        part_rows = []
        for label, marks, bolts in parts:
            marks = [{"D_parts_marks_marks": m} for m in marks]
            bolts = [{"D_parts_bolts_name": b[0]} for b in bolts]
            part_rows += below({"label": label}, marks, bolts)
        owner_rows = below({"x": owner[0]}, [{"marks": m} for m in owner[1]]) if owner else []
        rows_of = below({"name": name}, [{"tags": t} for t in tags], owner_rows, part_rows)
        found += [{**row, "_row": i} for i, row in enumerate(rows_of)]
    return found


def test_side_by_side(spark):
    tables = shred(spark.createDataFrame(ROWS, MODEL), "D", key="name")
    frame = flatten_aligned(tables)
    names = ["name", "_row", "tags", "x", "marks", "label", "D_parts_marks_marks", "D_parts_bolts_name"]
    wanted = sorted((tuple(row.get(n) for n in names) for row in plain(ROWS)), key=repr)
    assert sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr) == wanted
    assert {"D_id", "D_parts_id", "D_owner_id", "D_parts_bolts_id"} <= set(frame.columns)


def test_one_list_with_most_rows(spark):
    """A long list and a short one, neither with positions."""
    layout = table_layout("a array<int>, b array<int>", "D")
    a = spark.range(0, 3000, 1, 5).select(F.lit("k").alias("D_id"), F.col("id").cast("int").alias("a"))
    b = spark.createDataFrame([("k", 1), ("k", 1), ("j", 3), (None, 4)], "D_id string, b int")
    roots = spark.createDataFrame([("k",), ("j",), ("i",)], "D_id string")
    rows = flatten_aligned(DocumentTables(layout, {"D": roots, "D_a": a, "D_b": b})).collect()
    found = sorted((tuple(r) for r in rows), key=repr)
    wanted = [("k", i, i, 1 if i < 2 else None) for i in range(3000)] + [("j", 0, None, 3), ("i", 0, None, None)]
    assert found == sorted(wanted, key=repr)


def test_no_lists_and_no_rows(spark):
    tables = shred(spark.createDataFrame([("x", 1)], "name string, n int"), "D", key="name")
    assert [tuple(r) for r in flatten_aligned(tables).collect()] == [("x", 1, "x", 0)]
    assert flatten_aligned(shred(spark.createDataFrame([], MODEL), "D", key="name")).collect() == []


def test_conditions_on_several_branches(spark):
    tables = shred(spark.createDataFrame(ROWS, MODEL), "D", key="name")
    tags = Condition("D_tags", F.col("tags").startswith("t"), at_least=3)
    marks = Condition("D_parts_marks", F.col("marks") > 2)
    bolts = Condition("D_parts_bolts", F.col("name") == "m4", every=True)
    labels = Condition("D_parts", F.col("label") >= "q", every=True)
    root = Condition("D", F.col("name") > "b")
    cases = [
        ([tags], "all", "a"),
        ([marks], "all", "ae"),
        ([bolts], "all", "bcde"),
        ([marks, bolts], "all", "e"),
        ([tags, bolts], "any", "abcde"),
        ([labels, root], "all", "cde"),
        ([Condition("D_parts_marks", F.col("marks") > 0, at_least=4)], "all", "a"),
        ([Condition("D_owner", F.col("x") == 7), tags, marks], "all", "a"),
        ([Condition("D_owner", F.col("x") > 0, every=True)], "all", "abde"),
        ([], "all", "abcde"),
    ]
    for conditions, match, wanted in cases:
        found = matching_keys(tables, conditions, match).collect()
        assert sorted(r[0] for r in found) == list(wanted), (conditions, match)
    with pytest.raises(ValueError):
        matching_keys(tables, [tags], "some")
