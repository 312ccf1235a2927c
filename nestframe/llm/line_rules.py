"""Line-first cleaning: rules per line, then a verdict on what is left of the document.

All of it is SQL functions. A line fails if it is navigation (cells between bars, or a few words without an end), if
too much of it is symbols, if it says what pages say everywhere (licences, cookies, rights), or if it repeats an earlier
line. Failing lines go; a document goes that loses more than a share of its characters, or fails a base rule: too few
words, or too many words in runs of five that the text has twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Boilerplate; matched without regard to case. A fixed list.
BOILERPLATE = (
    "all rights reserved",
    "copyright (?:©|\\(c\\)|[12][0-9]{3})",
    "licensed under",
    "terms (?:of|and) (?:use|service|conditions)",
    "privacy policy",
    "(?:uses|use|accept|enable) cookies",
    "enable javascript",
    "subscribe to our",
    "sign (?:in|up) (?:to|for)",
    "click here",
    "lorem ipsum",
)
SYMBOLS = "#*$%&|<>"


def clean_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_words: int = 10,
    repeated_percent: int = 20,
    lost_share: float = 0.5,
    symbol_share: float = 0.1,
) -> DataFrame:
    """``id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cleaned, n_bad_lines``.

    A row per document. Words are what stands between blanks (space and the control characters 9 to 13). A null text is
    empty; an empty text fails for having too few words. Ids may be null or repeated. Runs of words are compared by
    64-bit hashes.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = documents.select(F.col(id_column).alias("id"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", f"{BLANK}+"), ""))
    # Only lines with a word count.
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = rows.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    runs = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - 5),
        lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(5))),
    )
    rows = rows.withColumn("runs", F.when(F.col("n_words") >= 5, runs).otherwise(F.array().cast("array<bigint>")))
    # Texts without a repeat, found by a hash set, skip the sort. Equal runs lie side by side after it.
    repeats = F.size(F.array_distinct("runs")) < F.size("runs")
    placed = F.sort_array(F.transform("runs", lambda run, i: F.struct(run.alias("run"), i.alias("at"))))
    rows = rows.withColumn("placed", F.when(repeats, placed))
    rows = rows.withColumn("n_repeat_words", F.coalesce(_repeated_words(F.col("placed")), F.lit(0).cast("long")))
    rows = rows.withColumn("good", F.filter(F.array_distinct("lines"), lambda line: ~_bad_line(line, symbol_share)))
    rows = rows.withColumn("cleaned", F.array_join("good", "\n"))
    left = F.length(F.regexp_replace("cleaned", f"{BLANK}+", ""))
    base_failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeated_percent * F.col("n_words"))
    rows = rows.withColumn("base_failed", base_failed)
    return rows.select(
        F.col("id").alias(id_column),
        "n_words",
        "word_chars",
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (left >= (1 - lost_share) * F.col("word_chars"))).alias("kept"),
        "cleaned",
        (F.size("lines") - F.size("good")).cast("long").alias("n_bad_lines"),
    )


def _repeated_words(placed: Column) -> Column:
    """How many words lie in runs of five that come twice, the first included; the runs are sorted with their places."""
    at = lambda i: F.get(placed, i)["run"]
    same = lambda x, y: F.coalesce(x == y, F.lit(False))
    repeated = F.filter(placed, lambda x, i: same(x["run"], at(i - 1)) | same(x["run"], at(i + 1)))
    return F.aggregate(
        F.sort_array(F.transform(repeated, lambda x: x["at"])),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last")),
        lambda a, at: F.struct((a["n"] + F.least(F.lit(5), at - a["last"])).alias("n"), at.alias("last")),
        lambda a: a["n"],
    )


def _bad_line(line: Column, symbol_share: float) -> Column:
    symbols = F.regexp_count(line, F.lit(f"[{SYMBOLS}]"))
    bars = F.regexp_count(line, F.lit(rf"{BLANK}[|»>]{BLANK}"))
    short = ~line.rlike(rf"(?:{WORD}{BLANK}+){{2}}{WORD}") & ~line.rlike(rf"[.!?:;\"')»”]{BLANK}*\z")
    return (bars >= 2) | (symbols > symbol_share * F.length(line)) | short | line.rlike(f"(?i)(?:{'|'.join(BOILERPLATE)})")
