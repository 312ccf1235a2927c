"""The manifest against trees built in memory."""

import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from nestframe.llm.merkle import leaf_digest, lower_ascii, manifest
from nestframe.llm.queries import QUERIES


def h(text):
    return sha256(text.encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes, fanout=16):
    built = [nodes]
    while len(built[-1]) > 1:
        built.append([h("".join(built[-1][i : i + fanout])) for i in range(0, len(built[-1]), fanout)])
    return built


def beside(built, place, fanout=16):
    found = []
    for nodes in built[:-1]:
        begin = place - place % fanout
        found.append(("".join(nodes[begin:place]), "".join(nodes[place + 1 : begin + fanout])))
        place //= fanout
    return found


def plain(rows, fanout=16):
    """Of rows (doc_id, source, lang, n_chars, text): the columns of the query."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, h("".join(map(framed, row))), row))
    ordered = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels_of([leaf for *_, leaf, _ in sorted(groups[s], key=lambda x: x[:3])], fanout) for s in ordered]
    over = levels_of([tree[-1][0] for tree in trees], fanout)
    result = []
    for number, (source, tree) in enumerate(zip(ordered, trees, strict=True)):
        for place, (*_, leaf, row) in enumerate(sorted(groups[source], key=lambda x: x[:3])):
            path = beside(tree, place, fanout) + beside(over, number, fanout)
            folded = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                folded = h("".join(map(framed, (*row[:4], text))))
            for left, right in path:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in path))
            root = over[-1][0]
            result.append((row[0], leaf, tree[-1][0], root, proof, folded, folded == root))
    return sorted(result, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return sorted(map(tuple, QUERIES["op11_merkle_manifest"](spark, folder).collect()), key=repr)


def test_agrees_with_trees_in_memory(spark, tmp_path):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(60)]
    rows += [(i, "long", "de", None, "ÄÖ ABC" * (i % 7)) for i in range(1000, 1300)]
    rows += [(7, None, None, None, None), (8, "", "en", 0, ""), (9, "é", "fr", 1, "ONE"), (None, "s1", "en", 1, "X")]
    rows += [(5, "s2", "en", 5, "Text 5")] * 2 + [(5, "s2", "en", 6, "Other"), (11, "lone", "x", 200_000, "Long" * 50_000)]
    assert rows_of(spark, str(tmp_path), rows) == plain(rows)


def test_no_rows(spark, tmp_path):
    assert rows_of(spark, str(tmp_path), []) == []


def test_many_stages_and_groups(spark):
    """Blocks of four leaves, so that trees and the tree over them have several stages."""
    rows = [(i, "big", "en", i, f"T{i}") for i in range(300)] + [(i, f"g{i % 37:02}", "en", i, f"T{i}") for i in range(300, 400)]
    columns = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = spark.createDataFrame(rows, SCHEMA).select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("group"),
        leaf_digest(columns).alias("leaf"),
        F.when(tampered, leaf_digest([*columns[:-1], lower_ascii(columns[-1])])).alias("changed"),
        F.lit(1).alias("pos"),
    )
    found = manifest(leaves, fanout=2, levels=2).collect()
    wanted = plain(rows, fanout=2)
    assert sorted(((r.id, r.leaf, r.subroot, r.root, r.proof, r.folded, r.folded == r.root) for r in found), key=repr) == wanted
    for row in found:
        assert (row.copies is not None) == (zlib.crc32(str(row.id).encode()) % 5 == 0)
        if row.copies:
            assert row.copies[-1] == row.folded
            height = 9 + 6 if row.id < 300 else 2 + 6
            assert len(row.copies) - 1 in (height, height - 1)


def test_sample_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*SCHEMA.replace(",", " ").split()[::2]).collect()]
    found = QUERIES["op11_merkle_manifest"](spark, folder).collect()
    assert sorted(map(tuple, found), key=repr) == plain(rows)
