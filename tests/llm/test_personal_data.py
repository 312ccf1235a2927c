import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nestframe.llm import personal_data
from nestframe.llm.boosting import BoostedTrees
from nestframe.llm.personal_data import base_spans, candidates, find_personal_data, fit_detector, redact_personal_data
from tests.llm import plain

FOLDER = "/root/testdata/sf0.1"
PARTS = ["1", "25", "4242424242424242", "+", "(", "-", " ", ".", "@", "a", "b_c", "ex.com", "é", "256", "0", "@x.y", "007"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_base_spans(parts):
    text = "".join(parts)
    assert [(kind, a, z) for a, z, kind in base_spans(text)] == plain.personal_data(text)


def test_sample(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    detector = fit_detector(frame)
    assert detector.trees is not None
    texts = {r.doc_id: r.text for r in frame.collect()}
    extra = []
    for row in find_personal_data(frame, detector).collect():
        text = texts[row.doc_id]
        assert [(s.kind, s.start, s.end) for s in row.spans if s.base] == plain.personal_data(text)
        base = [(s.start, s.end) for s in row.spans if s.base]
        for span in (s for s in row.spans if not s.base):
            assert all(span.end <= a or z <= span.start for a, z in base)
            extra.append(text[span.start : span.end])
    # What is found beyond the base are keys and long numbers, not prose.
    assert len(extra) > 100 and all(re.search("[0-9]{4}", found) or re.search("[0-9].*[a-f]", found) for found in extra)
    assert sum(bool(re.fullmatch("[0-9a-f]{40}", found)) for found in extra) > 100


def test_redaction_nulls_and_extra_columns(spark):
    rows = [(1, "mail a.b@c.de or +1 (234) 555-1234.", 5), (None, None, 1), (2, "", 1), (2, "", 1), (3, "plain", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    clean = redact_personal_data(frame)
    assert clean.columns == frame.columns
    expected = [(1, "mail <email> or <phone>.", 5), *rows[1:]]
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted(expected, key=repr)
    assert sorted(len(r.spans) for r in find_personal_data(frame).collect()) == [0, 0, 0, 0, 2]
    assert find_personal_data(frame.limit(0)).count() == redact_personal_data(frame.limit(0)).count() == 0


def test_long_texts_take_time_in_proportion(spark):
    text = "1" * 300_000 + "@" + "a" * 300_000 + " 1.1" * 50_000 + "+" * 1000 + "12 " * 50_000
    assert fit_detector(spark.createDataFrame([(text,)], "text string")).spans(text) == [(*s, True, 1.0) for s in base_spans(text)]


def test_trees_learn_what_no_line_parts():
    dice = np.random.default_rng(0)
    x = dice.uniform(-1, 1, (4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int)
    held = np.arange(4000) % 3 == 0
    trees = BoostedTrees().fit(x, y, held)
    p = trees.probability(x[held])
    assert ((p > 0.5) == (y[held] == 1)).mean() > 0.95
    sure = p > 0.9
    assert y[held][sure].mean() > 0.9


def planted(n=240):
    """Numbers and addresses beside words that tell what they are, and prose with numbers and places."""
    rows, letters = [], "abcdefghijklmnop"
    for i in range(n):
        word = letters[i % 16] * (1 + i % 3) + letters[i // 16] * (1 + i % 5) + "in"
        rows += [
            f"Please call 030 {1234567 + 7919 * i} before noon.",
            f"Her ssn is {100 + i}-{10 + i % 90}-{1000 + 31 * i} as filed.",
            f"You may mail {word} at {word[::-1]} dot com for more.",
            f"or {word} [at] {word[::-1]} [dot] org",
            f"The survey counted {1000000 + 104729 * i} birds over the years.",
            f"We met at {word} dot {('after', 'so', 'now', 'then', 'and')[i % 5]} that we left.",
        ]
    return rows


def test_planted_numbers_and_addresses_are_found_and_prose_is_not(spark):
    frame = spark.createDataFrame([(t,) for t in planted()], "text string")
    detector = fit_detector(frame)
    probes = {
        "Please call 040 7654321 before noon.": "040 7654321",
        "Her ssn is 123-45-6789 as filed.": "123-45-6789",
        "You may mail kim at mail dot com for more.": "kim at mail dot com",
        "or eve [at] mail [dot] org": "eve [at] mail [dot] org",
        "The survey counted 7654321 birds over the years.": None,
        "We met at dawn dot after that we left.": None,
    }
    for text, wanted in probes.items():
        assert [text[a:z] for a, z, *_ in detector.spans(text)] == ([wanted] if wanted else []), text


def test_rare_personal_data_teaches_as_well(spark):
    """One document in 1,000 holds a key; a sample of 10,000 documents would have about ten of them."""
    text = "CASE id % 1000 WHEN 0 THEN concat('token = ', sha1(string(id))) WHEN 500 THEN concat('commit ', sha1(string(id))) ELSE 'words' END"
    detector = fit_detector(spark.range(60_000).selectExpr(f"{text} AS text"))
    key = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    assert [s[:3] for s in detector.spans(f"token = {key}")] == [(8, 48, "secret")]
    assert detector.spans(f"commit {key}") == []


def test_numbers_in_a_row_and_long_keys(spark):
    numbers = ["030 1234567", "030 7654321", "040 1234567", "040 7654321", "089 1234567"]
    proposed = list(candidates("call " + " ".join(numbers) + "."))
    assert all((5 + 12 * i, 16 + 12 * i, "number") in proposed for i in range(5))
    text, key = "from 192.168.1.1 4111111111111112 and", "a1" * 400
    assert (17, 33, "number") in candidates(text) and (7, 807, "secret") in candidates(f"key is {key}")
    rows = [f"Please call 030 {1234567 + i} 040 {2345678 + 7 * i} 089 {3456789 + 11 * i} before noon." for i in range(200)]
    rows += [*planted(), *(f"token = {i}{key}" for i in range(60))]
    detector = fit_detector(spark.createDataFrame([(t,) for t in rows], "text string"))
    text = "Please call " + " ".join(numbers) + " before noon."
    assert [text[a:z] for a, z, *_ in detector.spans(text)] == numbers
    text = f"token = {key}"
    assert [text[a:z] for a, z, *_ in detector.spans(text)] == [key]


def test_addresses_of_thousands_of_digits():
    assert base_spans("1.2.3." + "0" * 5000) == [(0, 5006, "ip")]
    assert base_spans("1.2.3." + "9" * 5000) == []


def test_a_text_of_numbers_is_judged_in_bounded_memory():
    """As trees with any thresholds see it: features of some candidates at a time, and none lost over the cuts."""
    rng = np.random.default_rng(1)
    x = rng.random((400, 28))
    trees = BoostedTrees().fit(x, (x[:, 3] > 0.5).astype(int), np.arange(400) % 3 == 1)
    detector = personal_data.Detector(trees, {kind: 0.5 for kind in personal_data.KINDS})
    text = "12 345 " * 1200
    whole = detector.spans(text)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(personal_data, "AT_ONCE", 500)
        tracemalloc.start()
        assert detector.spans(text) == whole
        assert tracemalloc.get_traced_memory()[1] < 20 << 20
        tracemalloc.stop()
    assert len(whole) > 100
