"""Taking documents apart and putting them together again."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from nestframe import DocumentTables, assemble, difference, shred, table_layout
from nestframe.functions import child_key

MODEL = """
    name string, size bigint, tags array<string>, owner struct<id: string, name: string>,
    parts array<struct<id: string, label: string, weight: double,
                       marks array<int>, bolts: array<struct<kind: string>>>>
"""

DOCUMENTS = [
    {
        "name": "a",
        "size": 1,
        "tags": ["x", None, "x"],
        "owner": {"id": "o1", "name": "Ann"},
        "parts": [
            {
                "id": "p1",
                "label": "left",
                "weight": 1.5,
                "marks": [3, 1, 2],
                "bolts": [{"kind": "m4"}, {"kind": "m4"}],
            },
            {"id": "p2", "label": None, "weight": None, "marks": [], "bolts": [{"kind": "m5"}]},
        ],
    },
    {"name": "b", "size": None, "tags": [], "owner": None, "parts": []},
    {
        "name": "c",
        "size": 3,
        "tags": ["y"],
        "owner": {"id": None, "name": None},
        "parts": [{"id": "p1", "label": None, "weight": None, "marks": [], "bolts": []}],
    },
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(DOCUMENTS, MODEL)


def strip_ids(value):
    if isinstance(value, Row):
        value = value.asDict()
    if isinstance(value, dict):
        return {k: strip_ids(v) for k, v in value.items() if k not in ("id", "_part")}
    if isinstance(value, list):
        return [strip_ids(v) for v in value]
    return value


def by_name(frame):
    return {row["name"]: strip_ids(row) for row in frame.collect()}


def test_tables_and_columns(documents):
    tables = shred(documents, "Doc", key="name")
    columns = {name: frame.columns for name, frame in tables.frames.items()}
    assert columns == {
        "Doc": ["name", "size", "Doc_id"],
        "Doc_tags": ["tags", "Doc_id", "_pos"],
        "Doc_owner": ["name", "Doc_owner_id", "Doc_id", "_pos"],
        "Doc_parts": ["label", "weight", "Doc_parts_id", "Doc_id", "_pos"],
        "Doc_parts_marks": ["marks", "Doc_parts_id", "_pos"],
        "Doc_parts_bolts": ["kind", "Doc_parts_bolts_id", "Doc_parts_id", "_pos"],
    }


def test_keys_link_the_levels(spark, documents):
    tables = shred(documents, "Doc", key="name")
    parts = {(r["Doc_id"], r["_pos"]): r["Doc_parts_id"] for r in tables["Doc_parts"].collect()}
    assert sorted(parts) == [("a", 0), ("a", 1), ("c", 0)]
    bolts = tables["Doc_parts_bolts"].collect()
    assert sorted(r["Doc_parts_id"] for r in bolts) == sorted([parts["a", 0]] * 2 + [parts["a", 1]])
    assert len({r["Doc_parts_bolts_id"] for r in bolts}) == 3
    expected = spark.range(1).select(child_key(F.lit("a"), "parts", F.lit(1))).first()[0]
    assert parts["a", 1] == expected and len(expected) == 32


def test_null_and_empty_make_no_rows(documents):
    tables = shred(documents, "Doc", key="name")
    assert {r["Doc_id"] for r in tables["Doc_owner"].collect()} == {"a", "c"}
    assert [r["tags"] for r in tables["Doc_tags"].orderBy("Doc_id", "_pos").collect()] == [
        "x",
        None,
        "x",
        "y",
    ]


def test_drop_all_null(documents):
    tables = shred(documents, "Doc", key="name", drop_all_null=True)
    assert {r["Doc_id"] for r in tables["Doc_owner"].collect()} == {"a"}
    assert tables["Doc_parts"].count() == 3  # an empty list is a value


def test_null_items_in_lists(spark):
    frame = spark.createDataFrame(
        [("a", [Row(x=1), None, Row(x=2)])], "k string, items array<struct<x: int>>"
    )
    rows = shred(frame, "D", key="k")["D_items"].orderBy("_pos").collect()
    assert [(r["x"], r["_pos"]) for r in rows] == [(1, 0), (2, 2)]
    whole = assemble(shred(frame, "D", key="k")).first()
    assert [i["x"] for i in whole["items"]] == [1, 2]


def test_round_trip(documents):
    rebuilt = assemble(shred(documents, "Doc", key="name"))
    expected = {d["name"]: strip_ids(d) for d in DOCUMENTS}
    assert by_name(rebuilt) == expected
    assert rebuilt.columns == ["id", "name", "size", "tags", "owner", "parts", "_part"]


def test_round_trip_without_natural_key(documents):
    rebuilt = assemble(shred(documents, "Doc"))
    assert by_name(rebuilt) == {d["name"]: strip_ids(d) for d in DOCUMENTS}


def test_copies_without_natural_key_are_one_document(documents):
    rebuilt = assemble(shred(documents.union(documents), "Doc"))
    assert rebuilt.count() == 3
    assert by_name(rebuilt) == {d["name"]: strip_ids(d) for d in DOCUMENTS}


def test_composite_keys_do_not_run_together(spark):
    rows = spark.createDataFrame(
        [("a/b", "c"), ("a", "b/c"), (None, "b"), ("b", None)], "k string, l string"
    )
    tables = shred(rows, "D", key=["k", "l"])
    assert tables["D"].select("D_id").distinct().count() == 4


def test_round_trip_with_composite_key_and_own_ids(documents):
    tables = shred(documents, "Doc", key=["name", "size"], keep_id=True)
    rebuilt = assemble(tables).drop("_part", "id").select(documents.columns)
    assert difference(documents, rebuilt).first() == (0, 0)


def test_repeated_shred_gives_the_same_keys(documents):
    first, second = shred(documents, "Doc"), shred(documents.repartition(3), "Doc")
    for name in first.frames:
        assert difference(first[name], second[name]).first() == (0, 0)


def test_identical_siblings_keep_their_rows(spark):
    frame = spark.createDataFrame(
        [("a", [Row(x=1), Row(x=1), Row(x=1)])], "k string, items array<struct<x: int>>"
    )
    tables = shred(frame, "D", key="k")
    assert tables["D_items"].select("D_items_id").distinct().count() == 3
    assert len(assemble(tables).first()["items"]) == 3


def test_one_struct_type_at_two_paths(spark):
    frame = spark.createDataFrame(
        [("a", [Row(x=1)], [Row(x=2), Row(x=3)])],
        "k string, left array<struct<x: int>>, right array<struct<x: int>>",
    )
    tables = shred(frame, "D", key="k", names={"right": "Right"})
    assert set(tables.frames) == {"D", "D_left", "Right"}
    row = assemble(tables).first()
    assert [i["x"] for i in row["left"]] == [1] and [i["x"] for i in row["right"]] == [2, 3]


def test_rows_without_parent_are_left_out(spark, documents):
    tables = shred(documents, "Doc", key="name")
    stray = tables["Doc_parts"].limit(1).withColumn("Doc_id", F.lit("none"))
    unlinked = tables["Doc_parts"].limit(1).withColumn("Doc_id", F.lit(None).cast("string"))
    parts = tables["Doc_parts"].union(stray).union(unlinked)
    rebuilt = assemble(tables.with_frames({"Doc_parts": parts}))
    assert by_name(rebuilt) == {d["name"]: strip_ids(d) for d in DOCUMENTS}


def test_first_of_several_single_objects(spark):
    layout = table_layout("name string, owner struct<name: string>", "D")
    tables = DocumentTables(
        layout,
        {
            "D": spark.createDataFrame([("a", 1), ("b", 2)], "name string, D_id int"),
            "D_owner": spark.createDataFrame(
                [("second", 1, 1), ("first", 1, 0)], "name string, D_id int, _pos int"
            ),
        },
    )
    rows = {r["name"]: r["owner"] for r in assemble(tables).collect()}
    assert rows["a"]["name"] == "first" and rows["b"] is None


def test_selected_fields(documents):
    tables = shred(documents, "Doc", key="name")
    rebuilt = assemble(tables, ["name", "parts.label", "parts.bolts"])
    assert rebuilt.columns == ["id", "name", "parts", "_part"]
    row = {r["name"]: r for r in rebuilt.collect()}["a"]
    assert [p.asDict().keys() for p in row["parts"]] == [{"label", "bolts"}] * 2
    assert [len(p["bolts"]) for p in row["parts"]] == [2, 1]
    with pytest.raises(ValueError):
        assemble(tables, ["nothing"])


def merge(pieces):
    """Puts the pieces of each object together again, for comparison with the whole."""
    merged = {}
    for piece in pieces:
        seen = merged.setdefault(piece["id"], {**piece})
        if seen is not piece:
            for name, value in piece.items():
                if isinstance(value, list):
                    seen[name] = (seen[name] if seen[name] is not value else []) + value
                elif isinstance(value, dict) and seen[name] is None:
                    seen[name] = value
    out = []
    for item in merged.values():
        for name, value in item.items():
            if isinstance(value, list) and value and isinstance(value[0], dict):
                item[name] = merge(value)
        out.append(item)
    return out


@pytest.mark.parametrize("numbered", [True, False])
@pytest.mark.parametrize("list_size", [1, 2, 3, 100])
def test_long_lists_come_in_pieces(spark, numbered, list_size):
    def items(n, inner):
        return [
            {"x": i, "values": list(range(inner)), "subs": [{"y": i * 100 + j} for j in range(inner)]}
            for i in range(n)
        ]

    documents = [
        {"name": "long", "flags": [1, 2, 3, 4, 5], "items": items(7, 5)},
        {"name": "deep", "flags": [], "items": items(1, 9)},
        {"name": "short", "flags": [7], "items": items(2, 1)},
        {"name": "none", "flags": [], "items": []},
    ]
    model = (
        "name string, flags array<int>, "
        "items array<struct<x: int, values: array<int>, subs: array<struct<y: int>>>>"
    )
    tables = shred(spark.createDataFrame(documents, model), "D", key="name")
    order = {}
    if not numbered:
        order = {"D_items": ["x"], "D_items_subs": ["y"]}
        tables = tables.with_frames(
            {n: f.drop("_pos") for n, f in tables.frames.items() if n != "D"}
        )
    tables = tables.with_frames({}, rows_fit=False, order=order)
    rows = [r.asDict(recursive=True) for r in assemble(tables, list_size=list_size).collect()]

    def longest(value):
        inner = value.values() if isinstance(value, dict) else value
        own = len(value) if isinstance(value, list) else 0
        nested = [longest(v) for v in inner if isinstance(v, (list, dict))]
        return max([own, *nested])

    assert max(longest(r) for r in rows) <= list_size
    assert len({(r["id"], r["_part"]) for r in rows}) == len(rows)
    assert (len(rows) > 4) == (list_size < 9)

    firsts = [r for r in rows if "." not in r["_part"]]
    assert sum(len(r["items"]) for r in firsts) == 10

    rows.sort(key=lambda r: [int(n) for n in r["_part"].split(".")])
    merged = {d["name"]: strip_ids(d) for d in merge(rows)}
    for d in merged.values():
        d["items"].sort(key=lambda i: i["x"])
        for item in d["items"]:
            item["values"].sort()
            item["subs"].sort(key=lambda s: s["y"])
    assert merged == {d["name"]: d for d in documents}


@pytest.mark.parametrize("numbered", [True, False])
def test_long_list_inside_a_single_object(spark, numbered):
    model = "name string, flags array<int>, owner struct<x: int, marks: array<int>>"
    documents = [("a", [1, 2, 3, 4, 5], (7, [1, 2, 3])), ("b", [1], None), ("c", [], (8, []))]
    tables = shred(spark.createDataFrame(documents, model), "D", key="name")
    if not numbered:
        tables = tables.with_frames({n: f.drop("_pos") for n, f in tables.frames.items()})
    pieces = assemble(tables.with_frames({}, rows_fit=False), list_size=2).collect()
    a = sorted((r for r in pieces if r["name"] == "a"), key=lambda r: r["_part"])
    assert [r["flags"] for r in a] == [[1, 2], [3, 4], [5]]
    assert [r["owner"] and r["owner"]["marks"] for r in a] == [[1, 2], [3], None]
    assert {r["owner"]["x"] for r in a[:2]} == {7}
    rest = {r["name"]: r for r in pieces if r["name"] != "a"}
    assert len(pieces) == 5 and rest["b"]["owner"] is None and rest["c"]["owner"]["marks"] == []


def test_one_parent_with_most_rows_all_equal(spark):
    """Equal rows of one long parent are split as well, and none is lost."""
    layout = table_layout("values array<int>", "D")
    rows = spark.range(0, 5000, 1, 6).select(
        F.when(F.col("id") < 4000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 300)).alias("D_id"),
        F.lit(1).alias("values"),
    )
    roots = rows.select("D_id").distinct()
    tables = DocumentTables(layout, {"D": roots, "D_values": rows})
    pieces = assemble(tables, list_size=100)
    sizes = pieces.select("id", F.size("values").alias("n")).collect()
    assert sum(r["n"] for r in sizes) == 5000 and max(r["n"] for r in sizes) == 100
    assert sum(r["id"] == "hot" for r in sizes) == 40
    assert len(sizes) == 340


def test_schema_is_rejected(spark):
    with pytest.raises(ValueError):
        table_layout("a map<string, int>", "D")
    with pytest.raises(ValueError):
        table_layout("Name string, name string", "D")
    with pytest.raises(ValueError):
        table_layout("_pos int", "D")
    with pytest.raises(ValueError):
        table_layout("`a.b` int", "D")
    with pytest.raises(ValueError):
        shred(spark.createDataFrame([(1, "0")], "a int, _part string"), "D")


def test_an_explicit_list_size_counts_for_shredded_tables(spark):
    frame = spark.createDataFrame([("a", list(range(10)))], "name string, marks array<int>")
    pieces = assemble(shred(frame, "D", key="name"), list_size=3).orderBy("_part").collect()
    assert [len(r["marks"]) for r in pieces] == [3, 3, 3, 1]
    assert assemble(shred(frame, "D", key="name")).count() == 1


def test_keys_tell_microseconds_apart_in_every_time_zone(spark):
    query = (
        "SELECT * FROM VALUES ('u', TIMESTAMP'2024-01-01 00:00:00.000001', 0.0D, X'00FF', 1.10),"
        " ('u', TIMESTAMP'2024-01-01 00:00:00.000002', -0.0D, X'00FE', 1.10) AS t(u, ts, x, b, d)"
    )
    rows = spark.sql(query).selectExpr("*", "array('a') AS tags")
    found = []
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        fixed = rows.withColumn("ts", F.timestamp_micros(F.when(F.col("b") == F.lit(b"\x00\xff"), 1).otherwise(2)))
        for key in (["u", "ts"], None, "ts"):
            tags = shred(fixed, "K", key=key)["K_tags"]
            found.append([str(r[0]) for r in tags.select(tags.columns[1]).collect()])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(len(set(keys)) == 2 for keys in found)
    assert [sorted(k) for k in found[:2]] == [sorted(k) for k in found[3:5]]
    zero = spark.sql("SELECT 0.0D AS x, array(struct(1 AS y)) AS l UNION ALL SELECT -0.0D, array(struct(1 AS y))")
    assert shred(zero, "Z", key=["x"], bad_keys="trust")["Z_l"].select("Z_id").distinct().count() == 1


def test_texts_in_items_are_shuffled_joined_and_come_back_as_they_were(spark):
    lists = [["a", "b", "a"], [""], ["", ""], ["x", None], [None], ["p\x1fq", "r"], ["\0", "é\U0001f600"]]
    model = "k long, items array<struct<t: string, words: array<string>, n: array<int>>>"
    frame = spark.createDataFrame([(i, [("t", words, [i, None]), ("u", lists[i - 1], None)]) for i, words in enumerate(lists)], model)
    frame = frame.unionByName(
        spark.sql("SELECT 9L AS k, array(named_struct('t', 't', 'words', array(cast(x'C328' AS string)), 'n', array(1))) AS items")
    )
    rebuilt = assemble(shred(frame, "Doc", key="k"))
    values = lambda rows: rows.select("k", F.posexplode("items").alias("i", "item")).select("k", "i", "item.t", F.posexplode("item.words"))
    assert sorted(values(rebuilt).collect(), key=repr) == sorted(values(frame).collect(), key=repr)
    assert values(rebuilt).exceptAll(values(frame)).isEmpty()
    plan = rebuilt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("split(") < plan.index("RepartitionByExpression") < plan.index("array_join(")
