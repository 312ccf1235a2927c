import hashlib
import random
import time

import duckdb
import pytest

from nestframe.llm import warc
from nestframe.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"
PAYLOADS = [f"payload {i} ".encode() * 30 for i in range(8)]
RECORDS = [warc.record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), None, "2020-01-01T00:00:00Z") for i, p in enumerate(PAYLOADS)]


def found(content):
    """Pages of the records; what is left must be gaps, and all bytes accounted for."""
    rows = list(warc.salvage(content))
    at = 0
    for row in rows:
        if content[at : at + 20] == warc.EMPTY_MEMBER:
            at += 20
        assert row["offset"] == at
        at += row["length"]
    assert at == len(content)
    for row in rows:
        if "gap" not in row:
            assert row["payload"] == PAYLOADS[int(row["record_id"].split(":")[2])]
    return [None if "gap" in row else int(row["record_id"].split(":")[2]) for row in rows]


@pytest.mark.parametrize("wrap", [warc.gzip_member, bytes], ids=["gzip", "plain"])
def test_damage_costs_the_record_it_hits(wrap):
    parts = [wrap(record) for record in RECORDS]
    whole = b"".join(parts)
    assert found(whole) == list(range(8))
    dice = random.Random(1)
    for _ in range(120):
        hit = dice.randrange(8)
        at = sum(map(len, parts[:hit])) + dice.randrange(len(parts[hit]))
        broken = bytearray(whole)
        broken[at] ^= 1 << dice.randrange(8)
        pages = found_any(bytes(broken))
        assert set(range(8)) - set(pages) <= {hit}
    for cut in (1, 30, len(parts[7]) - 1):
        assert found(whole[:-cut]) == [*range(7), None]
    assert found(parts[0] + b"rubbish\n" + parts[1]) == [0, None, 1]
    assert found(parts[0][:50] + parts[1]) == [None, 1]


def found_any(content):
    """As ``found``, where a header field outside the digests may be changed without a trace."""
    return [int(r["record_id"].split(":")[2]) for r in warc.salvage(content) if "gap" not in r and r["record_id"].split(":")[2].isdigit()]


def test_mixture_and_payloads_that_hold_records():
    inner = RECORDS[3]
    outer = warc.record(9, "u", inner * 2, hashlib.sha256(inner * 2).hexdigest(), None, "2020-01-01T00:00:00Z")
    rows = list(warc.salvage(warc.gzip_member(RECORDS[0]) + outer + RECORDS[1]))
    assert [r["record_id"].split(":")[2] for r in rows] == ["0", "9", "1"] and rows[1]["payload"] == inner * 2
    broken = outer.replace(b"payload 3", b"payload X", 1)
    assert [r.get("gap") for r in warc.salvage(broken + RECORDS[1])] == ["digest differs", None]
    assert list(warc.salvage(b"")) == []
    assert [r["gap"] for r in warc.salvage(b"no archive")] == ["no version line"]


def test_query(spark):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    frame = QUERIES["op9_warc"](spark, FOLDER)
    expected = database.execute(ORACLES["op9_warc"])
    assert frame.columns == [c[0] for c in expected.description]
    assert sorted(map(tuple, frame.collect())) == sorted(expected.fetchall())


def test_revisits_ties_nulls_and_clashing_names(spark):
    rows = [
        (3, "u\r\nX: y", "x" * 200, 1), (1, None, "x" * 200, 1), (None, "u", "x" * 200, 1), (4, "u", "short", 1), (5, "u", "short", 1),
        (6, "u", None, 1), (6, "u", None, 1), (7, "u", "é" * 60, 1), (7, "u", "é" * 60, 1), (8, "u", "WARC/1.1\r\n" * 40, 1),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    read = warc.archived(frame).withColumn("page", warc.page_of("record_id")).withColumn("first", warc.page_of("refers_to")).collect()
    assert all(r.gap is None for r in read) and len(read) == len(rows)
    revisits = sorted(((r.page, r["first"], r.payload_bytes) for r in read if r.type == "revisit"), key=repr)
    assert revisits == sorted([(3, 1, 200), (None, 1, 200)], key=repr)
    texts = {r.page: bytes(r.payload).decode() for r in read if r.type == "response"}
    assert texts == {1: "x" * 200, 4: "short", 5: "short", 6: "", 7: "é" * 60, 8: "WARC/1.1\r\n" * 40}
    assert warc.archived(frame.limit(0)).count() == 0


def test_damaged_file_in_a_store(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(warc.gzip_member(RECORDS[0]) + b"\x1f\x8b\x08broken" + warc.gzip_member(RECORDS[1]))
    (tmp_path / "b.warc").write_bytes(RECORDS[2][:100] + RECORDS[3])
    read = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted(r.record_id.split(":")[2] for r in read if r.gap is None) == ["0", "1", "3"]
    assert sorted(r.length for r in read if r.gap) == [9, 100]


def test_damage_in_a_member_of_several_records_costs_the_record_it_hits():
    joined = b"".join(RECORDS)
    pages = lambda content: [r["gap"] if "gap" in r else int(r["record_id"].split(":")[2]) for r in warc.salvage(content)]
    broken = joined.replace(b"payload 3", b"payload X", 1)
    member = warc.gzip_member(broken)
    assert pages(member + warc.gzip_member(RECORDS[0])) == [0, 1, 2, "digest differs", 4, 5, 6, 7, 0]
    (gap,) = [r for r in warc.salvage(member) if "gap" in r]
    assert (gap["offset"], gap["length"]) == (0, len(member))
    assert (gap["inner_offset"], gap["inner_length"]) == (sum(map(len, RECORDS[:3])), len(RECORDS[3]))
    # A length that is wrong: the next version line tells where to go on.
    broken = joined.replace(b"Content-Length", b"Content-Lengxx", 1)
    assert pages(warc.gzip_member(broken)) == ["no content length", *range(1, 8)]
    # A wrong checksum costs nothing of what was unpacked, a cut what comes after it.
    member = bytearray(warc.gzip_member(joined))
    member[-6] ^= 1
    assert pages(bytes(member) + warc.gzip_member(RECORDS[0]))[:8] == list(range(8))
    whole = warc.gzip_member(joined)
    left = pages(whole[: len(whole) * 3 // 4])
    kept = [page for page in left if isinstance(page, int)]
    assert len(kept) > 2 and kept == list(range(len(kept)))


def test_version_lines_without_records_cost_no_more_than_their_length():
    """Each place is read up to its first fault only: 400 kB took minutes when the rest was read every time."""
    begin = time.perf_counter()
    assert [set(row) for row in warc.salvage(b"WARC/1.0\r\n" * 40_000)] == [{"offset", "length", "gap"}]
    assert found(b"WARC/1.0\r\n" * 5_000 + b"".join(RECORDS)) == [None, *range(8)]
    claims = b"WARC/1.0\r\nContent-Length: 100000\r\n\r\n" * 5_000
    assert found(claims + b"".join(RECORDS))[-8:] == list(range(8))
    assert time.perf_counter() - begin < 20
