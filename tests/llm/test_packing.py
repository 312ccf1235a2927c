import public_tokenizers
import pyspark.sql.functions as F
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from nestframe.llm.packing import Cutter, Shares, pack
from nestframe.llm.tokens import WordTokenizer
from tests.llm import plain

PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"
NAMES = ("doc_id", "start", "length", "crc", "doc_tokens", "sequence_id", "offset")


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(PATH)


def pieces(frame):
    return [tuple(r) for r in frame.withColumn("crc", F.crc32("ids")).select(*NAMES).collect()]


def test_sample(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    plain.check_packing(rows, pieces(pack(frame, PATH)), Tokenizer.from_file(PATH), 2048)


@pytest.mark.parametrize("targets", [None, {"s": 1, "z": 3}, {"s": 1, "z": 1, None: 1, "r": 5}, {}])
def test_small_windows_nulls_and_ties(spark, targets):
    rows = [(1, "a b c", "s"), (2, None, None), (3, "", "s"), (4, "hello " * 300, "z"), (5, "x y z" * 40, None), (6, "q", "r")]
    rows += [(6, "q", "r"), (None, "what", "r")]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, part int").repartition(3)
    found = pieces(pack(frame, PATH, size=16, targets=targets))
    plain.check_packing([r[:2] for r in rows], found, Tokenizer.from_file(PATH), 16)


def test_empty_table(spark):
    assert pieces(pack(spark.createDataFrame([], "doc_id long, text string, source string"), PATH)) == []


def test_windows_keep_the_sources_shares(spark):
    rows = [(i, f"word{i} " * 50, "abc"[i % 3] if i % 2 else "a") for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = pack(frame, PATH, size=64).groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()
    totals = {}
    for r in found:
        totals[r.source] = totals.get(r.source, 0) + r.n
    whole, last = sum(totals.values()), max(r.sequence_id for r in found)
    for r in found:
        if r.sequence_id < last:
            assert abs(r.n - 64 * totals[r.source] / whole) <= 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=9), st.integers(1, 40), st.data())
def test_turns_add_up(totals, size, data):
    weights = data.draw(st.none() | st.lists(st.integers(0, 5), min_size=len(totals), max_size=len(totals)))
    shares = Shares(totals, weights)
    if not shares.total:
        return
    windows = [min(w * size, shares.total) for w in range(-(-shares.total // size) + 1)]
    rows = shares.taken(windows)
    assert rows[:, -1].tolist() == windows
    own = rows[:, 1:] - rows[:, :-1]
    assert (own[1:] >= own[:-1]).all() and own[-1].tolist() == totals
    cutter = Cutter(shares, size, block=4)
    for source, total in enumerate(totals):
        assert sum(length for _, length, _, _ in cutter.pieces(source, 0, total)) == total


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F) | st.sampled_from("ΣσςK 　́’<|'s 12.,\n"), max_size=40))
def test_words_are_encoded_as_the_tokenizer_does(text):
    words = test_words_are_encoded_as_the_tokenizer_does.__dict__.setdefault("words", WordTokenizer(PATH))
    ids = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert words.encode([text, None]) == [b"".join(i.to_bytes(2, "little") for i in ids), b""]


def test_special_token_written_out(words):
    ids = words.tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids
    assert words.encode(["x y", "a <|endoftext|> b"])[1] == b"".join(i.to_bytes(2, "little") for i in ids)
