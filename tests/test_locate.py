"""Where documents differ."""

import pytest
from pyspark.sql import functions as F

from nestframe import difference, locate_differences, shred
from nestframe.operators import locate

MODEL = """
    name string, n int, flags array<int>, owner struct<x: int, marks: array<string>>,
    items array<struct<label: string, subs: array<struct<y: int, tags: array<string>>>>>
"""
ROWS = [
    ("a", 1, [1, None, 1], (7, ["p", "q"]), [("l", [(1, ["t", "u"]), (2, [])]), ("l", [(1, ["t", "u"])])]),
    ("b", None, [], None, []),
    ("c", 2, None, (None, None), [(None, None)]),
]


def tables(spark, rows, keys="digest"):
    return shred(spark.createDataFrame(rows, MODEL), "Doc", key="name", keys=keys)


def found(left, right):
    return sorted((r.document, r.path, r.pos, r.kind) for r in locate_differences(left, right).collect())


@pytest.mark.parametrize("keys", ["digest", "path"])
def test_each_difference_has_its_place(spark, keys):
    _, n, flags, owner, items = ROWS[0]
    cases = [
        ((5, flags, owner, items), [("", None, "changed")]),
        ((n, [1, 1], owner, items), [("flags", 1, "changed"), ("flags", 2, "missing")]),
        ((n, flags, (8, ["p", "q", "q"]), items), [("owner", None, "changed"), ("owner.marks", 2, "extra")]),
        ((n, flags, None, items), [("owner", None, "missing")]),
        (
            (n, flags, owner, [items[0], ("l", [(1, ["u", "t"])])]),
            [("items.subs.tags", 0, "changed"), ("items.subs.tags", 1, "changed")],
        ),
        ((n, flags, owner, items[:1]), [("items", 1, "missing")]),
        ((n, flags, owner, items), []),
    ]
    left = [(f"a{i}", n, flags, owner, items) for i in range(len(cases))] + ROWS
    right = [("d", 1, [], None, []), *ROWS[:0:-1], *((f"a{i}", *row) for i, (row, _) in enumerate(cases))]
    expected = [(f"a{i}", *place) for i, (_, places) in enumerate(cases) for place in places]
    expected += [("a", "", None, "missing"), ("d", "", None, "extra")]
    assert found(tables(spark, left, keys), tables(spark, right, keys)) == sorted(expected)


def test_repeated_rows_and_no_rows(spark):
    same, none = tables(spark, ROWS), tables(spark, [])
    assert found(none, none) == []
    assert found(none, same) == [(name, "", None, "extra") for name in "abc"]
    flags = same["Doc_flags"]
    twice = same.with_frames({"Doc_flags": flags.unionByName(flags)})
    assert found(same, twice) == [("a", "flags", i, "changed") for i in range(3)]
    with pytest.raises(ValueError, match="positions"):
        locate_differences(same, same.with_frames({"Doc_flags": flags.drop("_pos")}))


def test_only_tables_below_differing_digests_are_read(spark, monkeypatch):
    """Digests of the other branches are written, and not looked at again."""
    written, before = [], locate.durable
    monkeypatch.setattr(locate, "durable", lambda rows: written.append(rows.columns) or before(rows))
    a = ROWS[0]
    places = locate_differences(tables(spark, ROWS), tables(spark, [(*a[:2], [2, None, 1], *a[3:]), *ROWS[1:]]))
    assert len(written) == 2 * 7 + 2
    plan = places._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2
    assert [r.path for r in places.collect()] == ["flags"]


def test_agrees_with_the_count_of_differing_documents(spark):
    rows = [(f"d{i:03}", i, [i, i % 7], (i % 3, ["m"] * (i % 4)), [("l", [(i, ["t"] * (i % 5))])]) for i in range(200)]
    frame = spark.createDataFrame(rows, MODEL)
    other = frame.withColumn("flags", F.when(F.col("n") % 9 == 4, F.reverse("flags")).otherwise(F.col("flags")))
    places = locate_differences(shred(frame, "Doc", key="name"), shred(other, "Doc", key="name"))
    counted = difference(frame, other).first()
    assert places.select("document").distinct().count() == counted.n_missing == counted.n_extra > 10


def test_hashes_are_added_up_as_longs(spark):
    plans, same = [], tables(spark, ROWS)
    before = locate.durable

    def noted(rows):
        plans.append(rows._jdf.queryExecution().analyzed().toString())
        return before(rows)

    locate.durable = noted
    try:
        locate.digest_tree(same)
    finally:
        locate.durable = before
    assert len(plans) == 7 and not any("decimal" in plan for plan in plans)
    texts = shred(spark.createDataFrame([(1, ["a", None, "", "a"]), (2, None)], "k int, l array<string>"), "T", key="k")
    assert "to_json" not in locate._own_hash(texts["T_l"], texts.layout.find("T_l"), 0)._jc.toString()
    other = shred(spark.createDataFrame([(1, ["a", "", None, "a"]), (2, [])], "k int, l array<string>"), "T", key="k")
    assert found(texts, texts) == [] and found(texts, other) == [("1", "l", 1, "changed"), ("1", "l", 2, "changed")]


def test_rows_of_the_last_level_are_not_written_nor_shuffled(spark, tmp_path, monkeypatch):
    """Lists of 100,000 values: only what they come to, and the lists that differ, takes disk."""
    frame = spark.range(50).select("id", F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda i: F.col("id") * 2000 + i).alias("l"))
    changed = F.when(F.col("id") % 25 == 3, F.transform("l", lambda x: F.when(x % 2000 == 7, -x).otherwise(x)))
    frame.withColumn("other", F.coalesce(changed, "l")).write.parquet(f"{tmp_path}/in")
    stored = spark.read.parquet(f"{tmp_path}/in")
    sides = [shred(stored.select("id", F.col(c).alias("l")), "Doc", key="id") for c in ("l", "other")]
    plans, folder = [], tmp_path / "written"

    def written(rows):
        path = f"{folder}/{len(plans)}"
        rows.write.parquet(path)
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return spark.read.schema(rows.schema).parquet(path)

    monkeypatch.setattr(locate, "durable", written)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        places = found(*sides)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert places == [("28", "l", 6, "changed"), ("3", "l", 6, "changed")]
    assert sum(path.stat().st_size for path in folder.rglob("*.parquet")) < 100_000
    assert "BroadcastHashJoin" in plans[-1] and "bit_or" in plans[-1]


def test_rows_pass_if_their_parent_may_be_an_owner(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("parent"), "id").unionByName(spark.sql("SELECT string(NULL) AS parent, 0L AS id"))
    owners = spark.range(0, 5000, 50).select(F.col("id").cast("string").alias("key"))
    passed = locate._of_owners(rows, owners.unionByName(owners))
    assert passed.columns == rows.columns and 100 <= passed.count() < 110
    assert passed.where("id % 50 = 0 AND parent IS NOT NULL").count() == 100
