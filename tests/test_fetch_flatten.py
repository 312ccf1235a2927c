"""Selecting documents, and wide tables."""

from importlib import import_module

import pytest
from pyspark.sql import functions as F

from nestframe import (
    DocumentTables,
    any_item_equals,
    assemble,
    equals,
    fetch,
    fetch_by_id,
    flatten,
    flatten_branches,
    join_renamed,
    owner_keys,
    shred,
    table_layout,
)

FETCHING = import_module("nestframe.operators.fetch")

MODEL = """
    name string, tags array<string>,
    ingredients array<struct<name: string, organic: boolean>>,
    steps array<struct<name: string, inputs: array<struct<item: string, amount: double>>>>
"""


def recipe(number, ingredients, inputs):
    return {
        "name": f"d{number:02d}",
        "tags": ["t"],
        "ingredients": [{"name": r, "organic": True} for r in ingredients],
        "steps": [
            {"name": f"r{i}", "inputs": [{"item": s, "amount": 1.0} for s in group]}
            for i, group in enumerate(inputs)
        ],
    }


@pytest.fixture(scope="module")
def tables(spark):
    documents = [
        recipe(n, ["Sugar", "Sugar"] if n < 5 else ["Salt"], [["a"], ["b", f"s{n}"]])
        for n in range(25)
    ]
    return shred(spark.createDataFrame(documents, MODEL), "Recipe", key="name")


def names(frame):
    return sorted(row["name"] for row in frame.collect())


def test_join_filter_and_recover(tables):
    """Join with a child, filter on its renamed column, and get the whole documents back."""
    joined = join_renamed(
        tables["Recipe"], tables["Recipe_ingredients"], "Recipe_id", "{name}_ingredients"
    )
    assert "name_ingredients" in joined.columns
    filtered = joined.where(equals(joined, "name_ingredients", "Sugar"))
    assert filtered.count() == 10
    found = fetch(tables, matching=filtered)
    assert names(found) == [f"d{n:02d}" for n in range(5)]
    assert found.where(~any_item_equals("ingredients.name", "Sugar")).isEmpty()
    assert all(len(row["steps"]) == 2 for row in found.collect())


def test_rows_are_bounded_at_the_root_only(tables):
    assert names(fetch(tables)) == [f"d{n:02d}" for n in range(10)]
    assert names(fetch(tables, max_rows=2)) == ["d00", "d01"]
    assert fetch(tables, max_rows=None).count() == 25
    assert fetch(tables, max_rows=2_000).count() == 25
    assert [len(r["ingredients"]) for r in fetch(tables, max_rows=2).collect()] == [2, 2]


def test_keys_without_document_do_not_count(spark, tables):
    keys = spark.createDataFrame([("a",), (None,), ("d07",), ("d08",)], "Recipe_id string")
    assert names(fetch(tables, matching=keys, max_rows=1)) == ["d07"]
    assert names(fetch(tables, matching=keys, max_rows=None)) == ["d07", "d08"]
    assert fetch(tables, matching=keys.limit(0)).isEmpty()


def test_by_id(tables):
    assert names(fetch_by_id(tables, "d03")) == ["d03"]
    assert fetch_by_id(tables, "nothing").isEmpty()


def test_many_keys_are_joined(tables, monkeypatch):
    monkeypatch.setattr(FETCHING, "LITERAL_KEYS", 3)
    few, many = fetch(tables, max_rows=2), fetch(tables, max_rows=4)
    for documents, expected in ((few, 2), (many, 4)):
        rows = documents.collect()
        assert len(rows) == expected
        assert all(len(row["steps"][1]["inputs"]) == 2 for row in rows)


@pytest.mark.parametrize("literal_keys", [0, 1000])
def test_long_lists_of_chosen_documents(tables, monkeypatch, literal_keys):
    monkeypatch.setattr(FETCHING, "LITERAL_KEYS", literal_keys)
    unnumbered = {name: frame.drop("_pos") for name, frame in tables.frames.items()}
    plain = tables.with_frames(unnumbered, rows_fit=False)
    keys = owner_keys(tables, "Recipe_ingredients", F.col("name") == "Sugar")
    for found in (fetch(plain, max_rows=5, list_size=1), fetch(plain, matching=keys, list_size=1)):
        pieces = [r.asDict(recursive=True) for r in found.collect()]
        assert {p["name"] for p in pieces} == {f"d{n:02d}" for n in range(5)}
        steps = [s for p in pieces for s in p["steps"]]
        assert len({s["id"] for s in steps}) == 10
        assert sorted(i["item"] for s in steps for i in s["inputs"]) == sorted(
            ["a", "b"] * 5 + [f"s{n}" for n in range(5)]
        )
        assert all(len(s["inputs"]) <= 1 for s in steps)


def test_part_of_a_document_as_document(tables):
    key = tables["Recipe_steps"].where("Recipe_id = 'd04' and name = 'r1'").first()
    found = fetch_by_id(tables, key["Recipe_steps_id"], name="Recipe_steps").first()
    assert [e["item"] for e in found["inputs"]] == ["b", "s4"]
    assert fetch(tables, "Recipe_steps", max_rows=3).count() == 3


def test_filter_two_levels_down(tables):
    keys = owner_keys(tables, "Recipe_steps_inputs", F.col("item").isin("s3", "s20"))
    assert names(fetch(tables, matching=keys)) == ["d03", "d20"]
    root = owner_keys(tables, "Recipe", F.col("name") > "d22")
    assert names(fetch(tables, matching=root)) == ["d23", "d24"]


def test_nested_path(tables):
    documents = assemble(tables)
    hit = documents.where(any_item_equals("steps[].inputs.item", "s9"))
    assert names(hit) == ["d09"]
    assert documents.where(any_item_equals("tags", "t")).count() == 25


def test_literal_keys_reach_the_scans(spark, tables, tmp_path):
    stored = {}
    for name, frame in tables.frames.items():
        frame.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    stored = DocumentTables(tables.layout, stored)
    plan = fetch(stored, max_rows=2, fields=["name", "steps.inputs.item"])
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert text.count("In(Recipe_id, [d00,d01])") == 2
    assert text.count("In(Recipe_steps_id, [") == 1 and "Semi" not in text
    schemas = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert not any(word in line for word in ("amount", "organic", "tags") for line in schemas)


def test_semi_join_comes_before_collecting(spark, tables):
    keys = owner_keys(tables, "Recipe_ingredients", F.col("name") == "Sugar")
    plan = fetch(tables, matching=keys, max_rows=None, fields=["ingredients"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("collect_list") < text.rindex("LeftSemi")


@pytest.fixture(scope="module")
def chain(spark):
    layout = table_layout(
        "name string, orders array<struct<name: string, lines: array<struct<name: string>>>>", "C"
    )
    return DocumentTables(
        layout,
        {
            "C": spark.createDataFrame([("a", 1), ("b", 2)], "name string, C_id int"),
            "C_orders": spark.createDataFrame(
                [("x", 10, 1), ("y", 11, 1)], "name string, C_orders_id int, C_id int"
            ),
            "C_orders_lines": spark.createDataFrame(
                [("l", 10), ("m", 10)], "name string, C_orders_id int"
            ),
        },
    )


def test_flatten_chain(chain):
    flat = flatten(chain)
    assert flat.columns == ["C_orders_id", "C_id", "name", "C_orders_name", "C_orders_lines_name"]
    assert sorted(map(tuple, flat.collect())) == [
        (10, 1, "a", "x", "l"),
        (10, 1, "a", "x", "m"),
    ]
    outer = flatten(chain, how="left")
    assert outer.count() == 4


def test_flatten_leaves_out_empty_tables(chain):
    bare = chain.with_frames({"C_orders_lines": chain["C_orders_lines"].limit(0)})
    assert flatten(bare, skip_empty=True).count() == 2
    assert flatten(bare, skip_empty=False).isEmpty()
    empty = bare.with_frames({"C_orders": chain["C_orders"].limit(0)})
    assert flatten(empty, skip_empty=True).columns == ["name", "C_id"]


def test_siblings_are_not_multiplied(tables):
    with pytest.raises(ValueError, match="side by side"):
        flatten(tables)
    assert flatten(tables, "Recipe_ingredients").count() == 30
    branches = flatten_branches(tables)
    assert {name: frame.count() for name, frame in branches.items()} == {
        "Recipe_tags": 25,
        "Recipe_ingredients": 30,
        "Recipe_steps_inputs": 75,
    }


def test_single_object_is_joined_beside_a_list(spark):
    frame = spark.createDataFrame(
        [("a", {"x": 1}, [1, 2]), ("b", None, [3])],
        "name string, owner struct<x: int>, marks array<int>",
    )
    tables = shred(frame, "D", key="name")
    flat = flatten(tables)
    assert sorted((r["name"], r["x"], r["marks"]) for r in flat.collect()) == [
        ("a", 1, 1),
        ("a", 1, 2),
    ]
