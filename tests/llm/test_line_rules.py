from nestframe.llm.line_rules import clean_lines
from tests.llm import plain

FOLDER = "/root/testdata/sf0.01"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_sample(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in frame.collect()}
    rows = clean_lines(frame).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row[c] for c in COUNTS) == plain.line_counts(texts[row.doc_id])


def test_lines_go_before_documents(spark):
    good = "This is a line that says something about the world and ends well.\n"
    rows = [
        (1, good + "Home | News | About | Contact | More\n" + "Copyright 2020 by no one in particular at all\n" + "menu\n" + "It goes on here for long enough."),
        (2, "Home | News | About | Contact | More | Sports | Games | Music | Shop | Login | Help\n"),
        (3, good + good + "Another line of the same kind, a little longer than the first."),
    ]
    found = {r.doc_id: r for r in clean_lines(spark.createDataFrame(rows, "doc_id long, text string"), lost_share=0.7).collect()}
    assert found[1].cleaned == good + "It goes on here for long enough." and found[1].kept and found[1].n_bad_lines == 3
    assert not found[2].kept and found[2].cleaned == ""
    assert found[3].cleaned.count("says something") == 1


def test_nulls_blanks_ties_and_clashing_names(spark):
    texts = [None, "", "\n\n \t\x0b\n", "é " * 11, "a b\x1c c\xa0d\x85e\r\nf", "a b c d e f a b c d e g x y z " * 3, "x\ny", "x\ny"]
    frame = spark.createDataFrame([(i // 2 or None, t, i) for i, t in enumerate(texts)], "doc_id long, text string, words int")
    found = sorted((tuple(r[c] for c in COUNTS) for r in clean_lines(frame).collect()))
    assert found == sorted(plain.line_counts(t) for t in texts)
    assert not any(r.kept for r in clean_lines(frame).collect())
    assert clean_lines(frame.limit(0)).count() == 0


def test_no_python_and_no_shuffle(spark):
    plan = clean_lines(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))
