"""Counts against the library."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from nestframe.llm.bytesets import buffer_of
from nestframe.llm.queries import QUERIES
from nestframe.llm.token_counts import PieceModel, Transducer, count_tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = PieceModel(PATH)
SHARED = Transducer(MODEL)


def counted(texts, transducer=SHARED, chunk=512):
    return transducer.count(*buffer_of(pa.array(texts, pa.string())), chunk).tolist()


def wanted(texts):
    return [len(LIBRARY.encode(text or "")) for text in texts]


ODD = [
    "", None, " ", "  ", "\n", "a", "<s>", "</s><unk>", "<0x41>", "▁", " ▁ ▁", "\x00", "日本語のテキスト", "한국어", "नमस्ते", "\U0001f600\U0001f468‍",
    " " * 1000, "a" * 3000, "ab" * 2000, "\n" * 700, "x y" * 900, "日本" * 2000, "é" * 1500, "=" * 2000, "12345 67890" * 99, "\t \r\n", "don't stop",
]


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 512])
def test_odd_texts(chunk):
    assert counted(ODD, chunk=chunk) == wanted(ODD)


def test_pairs_of_tokens():
    """The short way to tell whether two tokens agree, against merging all of their text."""
    random.seed(3)
    pieces = sorted(MODEL.scores)
    for _ in range(4000):
        before = random.choice(pieces)
        whole = before[-2:] + random.choice(pieces)
        at = random.randrange(1, len(whole)) if len(whole) > 1 else 1
        for left, right in ((before, random.choice(pieces)), (whole[:at], whole[at:])):
            if right:
                assert MODEL.agree(left, right) == (MODEL.merged(left + right) == [left, right])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("  theinrs\nAB.▁"))), max_size=8))
def test_any_text(texts):
    assert counted(texts, chunk=5) == wanted(texts)


def test_a_full_table_is_begun_anew():
    small = Transducer(MODEL, states=200)
    random.seed(5)
    texts = ["".join(random.choices("abcdefgh ijklmn", k=200)) for _ in range(60)] + ODD
    assert counted(texts, small, 16) == wanted(texts)
    assert len(small.keys) < 2000


def test_other_models_are_refused(tmp_path):
    with open(PATH, "rb") as file:
        data = file.read()
    place = data.rindex(b"identity")
    changed = tmp_path / "other.model"
    # The same length: a rule that removes extra blanks instead of keeping them.
    at = data.index(b"\x20\x00", place)
    changed.write_bytes(data[:at] + b"\x20\x01" + data[at + 2 :])
    with pytest.raises(ValueError):
        PieceModel(str(changed))


def test_rows(spark):
    rows = [(1, "One two", "x"), (1, "One two", "y"), (None, None, None), (2, "", "z"), (3, "word " * 60_000, "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = sorted(map(tuple, count_tokens(frame, PATH).collect()), key=repr)
    assert found == sorted(((i, len((t or "").encode()), *wanted([t])) for i, t, _ in rows), key=repr)
    assert count_tokens(frame.limit(0), PATH).collect() == []


def test_sample_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, folder).collect()}
    assert sorted(found) == sorted(texts)
    counts = dict(zip(texts, wanted(list(texts.values())), strict=True))
    for i, row in found.items():
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[i].encode()), counts[i], counts[i] > 4096)
    assert np.sum(list(counts.values())) > 0
