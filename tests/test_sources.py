"""JSON documents, the table catalog, and slices of database tables."""

import json

import pytest

from nestframe import (
    assemble,
    create_tables,
    difference,
    durable,
    fetch,
    insert,
    list_tables,
    load_tables,
    parse_documents,
    read_documents,
    save_tables,
    shred,
    table_layout,
)
from nestframe.functions.nested import packed_texts, unpacked_texts
from nestframe.sources import catalog, key_slices

MODEL = """
    name string, value double, nested array<struct<note: string, value: double>>,
    words array<string>, __source__ struct<repo: string, commit: string>
"""


def document(name, n=2):
    return {
        "name": name,
        "value": 100.0,
        "nested": [{"note": f"v{i}", "value": 2.5} for i in range(n)],
        "words": ["one", "two"][:n],
        "__source__": {"repo": "r", "commit": "c"},
    }


@pytest.fixture()
def folder(tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps(document(name), indent=2))
    (tmp_path / "broken.json").write_text('{"name": "broken", "value": ')
    return tmp_path


def test_files_of_one_document(spark, folder):
    rows = {r["name"]: r for r in read_documents(spark, f"{folder}/*.json", MODEL).collect()}
    assert rows["a"]["__source__"]["repo"] == "r" and rows["a"]["_reject"] is None
    broken = [r for name, r in rows.items() if name not in ("a", "b")]
    assert len(broken) == 1 and '"broken"' in broken[0]["_reject"]


def test_lines_and_text_columns(spark, tmp_path):
    lines = [json.dumps(document("a")), "no json", json.dumps({"name": "b", "value": "text"})]
    (tmp_path / "docs.jsonl").write_text("\n".join(lines))
    read = read_documents(spark, str(tmp_path), MODEL, one_per_file=False).collect()
    text = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "n int, doc string")
    parsed = parse_documents(text, "doc", MODEL)
    assert parsed.columns[:2] == ["n", "name"]
    for rows in (read, parsed.collect()):
        assert [r["_reject"] for r in rows] == [None, "no json", lines[2]]


def stored(spark, database, documents):
    frame = spark.createDataFrame(documents, MODEL)
    tables = shred(frame, "Root", key="name", bad_keys="trust")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return tables


def test_insert_twice_adds_nothing(spark):
    first = stored(spark, "inserted", [document("a"), document("b", 0)])
    insert(first, "inserted")
    assert list_tables(spark, "inserted") == [
        "root",
        "root___source__",
        "root_nested",
        "root_words",
    ]
    more = stored(spark, "inserted", [document("b", 0), document("c", 1)])
    insert(more, "inserted")
    insert(more, "inserted")
    tables = load_tables(spark, first.layout, "inserted")
    assert {n: f.count() for n, f in tables.frames.items()} == {
        "Root": 3,
        "Root_nested": 3,
        "Root_words": 3,
        "Root___source__": 3,
    }
    rows = {r["name"]: r.asDict(recursive=True) for r in assemble(tables).collect()}
    assert rows["c"]["words"] == ["one"] and rows["b"]["nested"] == []
    assert rows["a"]["__source__"]["commit"] == "c"


def test_insert_completes_a_broken_run(spark):
    tables = stored(spark, "halfway", [document("a"), document("b")])
    save_tables(tables.subtree("Root_nested"), "halfway")
    insert(tables, "halfway")
    loaded = load_tables(spark, tables.layout, "halfway")
    assert loaded["Root_nested"].count() == 4 and loaded["Root"].count() == 2


def test_buckets_save_the_shuffles(spark):
    tables = stored(spark, "bucketed", [document(f"n{i}") for i in range(40)])
    save_tables(tables, "bucketed", buckets=4)
    loaded = load_tables(spark, tables.layout, "bucketed")
    assert loaded.clustered == {"Root_nested", "Root_words", "Root___source__"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        documents = assemble(loaded)
        plan = documents._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert documents.count() == 40
        assert all(len(r["nested"]) == 2 for r in documents.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(Exception):
        save_tables(tables, "bucketed")


def test_slices_cover_each_key_once():
    for slices in (1, 2, 3, 16, 256):
        assert len(key_slices("k", slices)) == slices
    assert key_slices("k", 2) == ["k < '80' OR k IS NULL", "k >= '80'"]
    assert key_slices("k", 3)[1] == "k >= '55' AND k < 'aa'"
    with pytest.raises(ValueError):
        key_slices("k", 0)


def test_create_insert_get(spark):
    """The whole way of one small document: create, list, look at the schema, insert, get."""
    model = """
        name string, int_value bigint, float_value double, bool_value boolean,
        multiple_values array<bigint>, nested array<struct<name: string>>
    """
    layout = table_layout(model, "Test")
    spark.sql("CREATE DATABASE IF NOT EXISTS whole")
    assert create_tables(spark, layout, "whole") == [
        "Test",
        "Test_multiple_values",
        "Test_nested",
    ]
    assert create_tables(spark, layout, "whole") == []
    assert {n.lower() for n in list_tables(spark, "whole")} == {
        "test",
        "test_multiple_values",
        "test_nested",
    }
    assert dict(spark.table("whole.Test").dtypes) == {
        "name": "string",
        "int_value": "bigint",
        "float_value": "double",
        "bool_value": "boolean",
        "Test_id": "string",
    }
    document = ("Hello", 1, 1.0, True, [1, 2, 3], [("Hello",)])
    tables = shred(spark.createDataFrame([document], model), "Test")
    insert(tables, "whole")
    assert spark.table("whole.Test_multiple_values").count() == 3
    row = fetch(load_tables(spark, layout, "whole")).first().asDict(recursive=True)
    assert len({row.pop("id"), row["nested"][0].pop("id")}) == 2
    assert row == {
        "name": "Hello",
        "int_value": 1,
        "float_value": 1.0,
        "bool_value": True,
        "multiple_values": [1, 2, 3],
        "nested": [{"name": "Hello"}],
        "_part": "0",
    }


def test_created_tables_take_shredded_rows(spark):
    """Created columns are those of shredding, with a natural key of another type too."""
    from pyspark.sql import types as T

    from nestframe.sources import table_schema

    model = "name string, owner struct<x: int>, parts array<struct<y: int, marks array<int>>>"
    frame = spark.createDataFrame([("a", None, [])], model).selectExpr("*", "7L AS n")
    tables = shred(frame, "D", key="n", model=model)
    for table in tables.layout.walk():
        expected = table_schema(table, T.LongType())
        rows = tables[table.name]
        assert [(f.name, f.dataType) for f in rows.schema] == [
            (f.name, f.dataType) for f in expected
        ]


def test_durable_rows_are_read_back(spark):
    frame = spark.range(10).selectExpr("id", "array(id) AS l")
    kept = durable(frame)
    assert kept.dtypes == frame.dtypes and kept.count() == 10
    assert kept.inputFiles()


def whole(spark, tables, database):
    loaded = load_tables(spark, tables.layout, database)
    return {r["name"]: r.asDict(recursive=True) for r in assemble(loaded).collect()}


def revised(name):
    return document(name) | {"words": ["new0", "new1", "new2"]}


def test_a_revised_document_is_kept_or_replaced_as_a_whole(spark):
    first = stored(spark, "revised", [document("a"), document("b")])
    assert insert(first, "revised").count() == 0
    before = whole(spark, first, "revised")
    second = shred(spark.createDataFrame([revised("a"), document("b"), document("c")], MODEL), "Root", key="name")
    refused = insert(second, "revised").collect()
    assert [tuple(r) for r in refused] == [("a", "another version is stored")]
    after = whole(spark, first, "revised")
    assert after["a"] == before["a"] and set(after) == {"a", "b", "c"}
    assert insert(second, "revised", on_conflict="replace").count() == 0
    after = whole(spark, first, "revised")
    assert after["a"] == assemble(second).where("name = 'a'").first().asDict(recursive=True)
    assert after["b"] == before["b"] and set(after) == {"a", "b", "c"}


def test_two_versions_in_one_batch_are_refused(spark):
    stored(spark, "versions", [])
    rows = [document("a"), revised("a"), document("b"), document("b")]
    tables = shred(spark.createDataFrame(rows, MODEL), "Root", key="name", bad_keys="trust")
    assert [tuple(r) for r in insert(tables, "versions").collect()] == [("a", "offered in several versions")]
    assert set(whole(spark, tables, "versions")) == {"b"}


def test_rows_left_by_another_version_are_not_mixed_in(spark):
    old = stored(spark, "leftover", [document("a"), document("b")])
    old["Root_words"].write.saveAsTable("leftover.Root_words")
    new = shred(spark.createDataFrame([revised("a"), document("b")], MODEL), "Root", key="name")
    assert [r[0] for r in insert(new, "leftover").collect()] == ["a"]
    assert set(whole(spark, new, "leftover")) == {"b"}


def test_new_attributes_are_stored(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS wider")
    narrow = shred(spark.createDataFrame([("a", 1)], "n string, x int"), "W", key="n")
    wide = shred(spark.createDataFrame([("b", 2, "y"), ("a", 1, None)], "n string, x int, y string"), "W", key="n")
    insert(narrow, "wider")
    assert insert(wide, "wider").count() == 0
    rows = sorted(tuple(r) for r in spark.table("wider.W").select("n", "x", "y").collect())
    assert rows == [("a", 1, None), ("b", 2, "y")]
    insert(shred(spark.createDataFrame([("c", 3)], "n string, x int"), "W", key="n"), "wider")
    assert spark.table("wider.W").count() == 3
    with pytest.raises(ValueError):
        insert(shred(spark.createDataFrame([(None, 3)], "n string, x int"), "W", key="n"), "wider")


def test_inserting_into_buckets_adds_a_file_each(spark):
    first = stored(spark, "filled", [document(f"n{i}") for i in range(30)])
    save_tables(first, "filled", buckets=4)
    more = shred(spark.createDataFrame([document(f"m{i}") for i in range(30)], MODEL).repartition(6), "Root", key="name")
    insert(more, "filled")
    assert spark.table("filled.Root_words").inputFiles().__len__() <= 8
    assert len(whole(spark, first, "filled")) == 60


def test_large_tables_get_more_buckets(spark, monkeypatch):
    rows = [document(f"n{i}") for i in range(40)]
    tables = stored(spark, "many_buckets", rows)
    monkeypatch.setattr("nestframe.sources.catalog.BUCKET_BYTES", 100)
    assert save_tables(tables, "many_buckets", buckets=4) == []
    numbers = set()
    for table in tables.layout.walk():
        about = spark.sql(f"DESCRIBE EXTENDED many_buckets.{table.name}").where("col_name = 'Num Buckets'").first()
        numbers.add(int(about["data_type"]))
    (number,) = numbers
    assert number > 4 and number % 4 == 0
    assert tuple(difference(assemble(tables), assemble(load_tables(spark, tables.layout, "many_buckets"))).first()) == (0, 0)


def test_values_go_to_buckets_in_their_lists(spark):
    """Each list is shuffled as one row, and every value comes out as it was."""
    lists = [["a", "b", "a"], [], None, [""], ["", ""], ["x", None], [None], ["p\x1fq", "r"], ["\x1f"], [None, "p\x1fq"], ["\0", "é\U0001f600"]]
    rows = [(i, words, [i, None][: i % 3], [(words, "t")]) for i, words in enumerate(lists)]
    model = "k long, words array<string>, numbers array<int>, items array<struct<words: array<string>, t: string>>"
    frame = spark.createDataFrame(rows, model)
    broken = spark.sql("""
        SELECT 99L AS k, array(cast(x'C328' AS string), 'ok') AS words, array(7) AS numbers,
               array(struct(array(cast(x'FF' AS string)), 't')) AS items
    """)
    frame = durable(frame.unionByName(broken.select(*(broken[f.name].cast(f.dataType) for f in frame.schema))))
    tables = shred(frame, "Doc", key="k")
    spark.sql("CREATE DATABASE IF NOT EXISTS in_lists")
    assert save_tables(tables, "in_lists", buckets=3) == []
    for table in tables.layout.walk():
        given, kept = tables[table.name], spark.table(f"in_lists.{table.name}")
        assert given.columns == kept.columns and given.exceptAll(kept).isEmpty() and kept.exceptAll(given).isEmpty()
    table = tables.layout.find("Doc_items_words")
    plan = catalog._dealt(tables, table, 3, table.parent_key)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("RepartitionByExpression")
    # Other rows than those the lists were unpacked to are stored as they are.
    fewer = tables.with_frames({table.name: tables[table.name].where("_pos = 0")})
    assert fewer.lists_of(table) is None and tables.lists_of(table) is not None
    spark.sql("CREATE DATABASE IF NOT EXISTS in_fewer_lists")
    save_tables(fewer, "in_fewer_lists", buckets=3)
    assert spark.table("in_fewer_lists.Doc_items_words").agg({"_pos": "max"}).first()[0] == 0


def test_lists_of_texts_are_joined_where_they_can_be_parted(spark):
    lists = [["a", "b"], [""], ["", ""], [], None, ["x", None], [None], [None, "p\x1fq"], ["\x1f"], ["é", "\0\n"]]
    frame = durable(spark.createDataFrame(list(enumerate(lists)), "k int, l array<string>"))
    packed = frame.select("k", "l", packed_texts(frame["l"]).alias("p"))
    found = {r["k"]: r for r in packed.select("k", "l", "p", unpacked_texts(packed["p"]).alias("again")).collect()}
    assert all(r["again"] == r["l"] for r in found.values())
    assert [k for k, r in sorted(found.items()) if r["p"]["joined"] is not None] == [0, 1, 2, 9]
