"""Finding and redacting personal data: patterns, candidate spans and boosted trees.

Four patterns with their checks find what counts anyhow (the base). Beyond it, generous generators propose spans that
may overlap: each stretch of whole digit groups, addresses spelled out, long mixed strings as keys have them. Boosted trees judge
each by its format and its context. They learn from the corpus itself: candidates that a pattern with its check
confirms, that are assigned to a name such as ``token``, or that have the form and a word beside them (``call``,
``ssn``, ``mail``; brackets around ``at`` will do), are examples for. Those that fail nothing but a checksum, or have
the form but no such word, teach nothing. Other candidates are examples against. Probabilities are calibrated on
candidates left out of the boosting, and each generator has the lowest threshold that keeps the precision there. Of overlapping
candidates above it the likeliest stays; none may overlap the base.

Candidates of all documents are labelled. The trees are grown on those with the smallest hashes, ``EXAMPLES`` at most of
each kind and label; thresholds come from counts of the scores of all others. All documents are searched whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestframe.llm.boosting import BoostedTrees
from nestframe.operators.durable import durable

#: Examples the trees are grown and calibrated on at most, of each kind and label; fewest of a label for trees at all.
EXAMPLES, LEAST = 5_000, 20
#: Characters of the longest format of a number, an account number in groups of four.
LONGEST = 42
#: Candidates of a text that are scored, and examples that are held, at a time.
AT_ONCE = 20_000
#: Scores are counted in so many steps.
BINS = 1_000
#: Base kinds first; spans that start together are in this order.
KINDS = ("email", "ip", "card", "phone", "address", "number", "secret")
BASE = KINDS[:4]
#: Words that tell what a value is; fixed lists, one feature each.
CONTEXT = (
    ("token", "key", "secret", "passw", "auth", "bearer"),
    ("tel", "phone", "call", "fax", "mobil"),
    ("mail", "contact", "write"),
    ("card", "visa", "iban", "account", "konto"),
    ("ssn", "passport", "id", "nr", "no."),
)

_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_ADDRESS = re.compile(r"\b[\w.+-]{1,64} ?(?:\[at\]|\(at\)| at ) ?[\w-]{1,64}(?: ?(?:\[dot\]|\(dot\)| dot ) ?\w{2,20})+", re.I)
_NUMBER = re.compile(r"[0-9](?:[ ./()-]{0,2}[0-9]){6,}+")
_GROUP = re.compile(r"[0-9]+")
_SECRET = re.compile(r"[A-Za-z0-9+/_=-]{16,}+")
#: What national phone numbers and social security numbers look like.
_NATIONAL = re.compile(
    r"0[0-9]{1,4}\)?[ /.-]{0,2}[0-9]{3,8}(?:-[0-9]{1,4})?|0[0-9](?:[ .-][0-9]{2}){4}|[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}"
)
_SOCIAL = re.compile(r"[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}")
_FORMED_INSIDE = re.compile(rf"(?<![0-9])(?:{_NATIONAL.pattern}|{_SOCIAL.pattern})(?![0-9])")
_PHONE_WORDS = re.compile(r"(?<![a-z])(?:telefon|telephone|tel|phone|call|fax|mobile?|cell|handy|whatsapp)(?![a-z])")
_ID_WORDS = re.compile(r"(?<![a-z])(?:ssn|social security|passport|ausweis|id|account|acct|konto|iban|card|visa)(?![a-z])")
_MAIL_WORDS = re.compile(r"(?<![a-z])(?:e-?mail|mail|contact|kontakt|write|reach)(?![a-z])")
_AT = re.compile(r" ?(?:\[at\]|\(at\)) ?| at ", re.I)
_DOT = re.compile(r" ?(?:\[dot\]|\(dot\)) ?| dot ", re.I)
_PLAIN_ADDRESS = re.compile(r"[\w.+-]+@[\w-]+(?:\.\w+)*\.([A-Za-z]{2,20})")
_TOP_LEVEL = frozenset("com org net edu gov info biz io eu de at ch fr es it nl uk us ca au jp cn in br pl se no dk fi be".split())
_RUN_BEFORE = re.compile(r"[0-9][ ./()-]{0,2}\Z")
_RUN_BEHIND = re.compile(r"[ ./()-]{0,2}[0-9]")
_ASSIGNED = re.compile(r"(?:token|key|secret|passw\w*|auth\w*|bearer)[\"']?\s*[=:]?\s*[\"']?\Z", re.I)


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches of the pattern, found from each at sign, so that long runs are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL_CHARS:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``start, end, kind`` in order of start, then kind."""
    found = [(a, z, "email") for a, z in emails(text)]
    for match in _IP.finditer(text):
        # Parts of any length are read without their zeros: Python refuses to read thousands of digits.
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append((*match.span(), "ip"))
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*match.span(), "card"))
    for match in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in match[0]) <= 15:
            found.append((*match.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> Iterator[tuple[int, int, str]]:
    for match in _NUMBER.finditer(text):
        yield from ((begin, end, "number") for begin, end in _windows(text, *match.span()))
    for match in _SECRET.finditer(text):
        if re.search("[0-9]", match[0]) and re.search("[A-Za-z]", match[0]):
            yield *match.span(), "secret"
    lowered = text.lower()
    if "dot" in lowered and "at" in lowered:
        for match in _ADDRESS.finditer(text):
            yield *match.span(), "address"
    for begin, end in emails(text):
        yield begin, end, "address"


def _windows(text: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Stretches of whole digit groups of a run, with seven digits at least and as long as the longest format at most.

    A group longer than that has no part that counts as a number.
    """
    groups = [match.span() for match in _GROUP.finditer(text, begin, end)]
    for first, (start, _) in enumerate(groups):
        digits = 0
        for a, z in groups[first : first + LONGEST]:
            if z - start > LONGEST:
                break
            digits += z - a
            if digits >= 7:
                yield start, z


def features(text: str, begin: int, end: int, kind: str) -> list[float]:
    """What the trees see: the make of the span and of the text around it."""
    span, before, after = text[begin:end], text[max(0, begin - 32) : begin], text[end : end + 8]
    counts = Counter(span)
    digits = sum(c in "0123456789" for c in span)
    letters = sum(c.isalpha() for c in span)
    groups = re.findall("[0-9]+", span)
    near = before.lower()
    return [
        float(KINDS.index(kind)),
        len(span),
        digits,
        digits / len(span),
        letters / len(span),
        len(span) - digits - letters,
        -sum(n / len(span) * log2(n / len(span)) for n in counts.values()),
        len(groups),
        max(map(len, groups), default=0),
        sum(c in "abcdefABCDEF0123456789" for c in span) / len(span),
        sum(c.isupper() for c in span) / len(span),
        span.count("@") + span.count("."),
        float(before[-1:] == "+" or span[:1] == "+"),
        float(before[-1:] in ("'", '"', "=", ":")),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in ("", " ", "\n", "\t")),
        *(float(any(word in near for word in words)) for words in CONTEXT),
        float(bool(_PHONE_WORDS.search(near))),
        float(bool(_ID_WORDS.search(near))),
        float(bool(_MAIL_WORDS.search(near))),
        float(kind == "number" and bool(_NATIONAL.fullmatch(span))),
        float(kind == "number" and bool(_SOCIAL.fullmatch(span))),
        float(kind == "number" and _within_run(text, begin, end)),
        float(kind == "address" and ("[" in span or "(" in span)),
        float(kind == "address" and plain_address(span).rpartition(".")[2].lower() in _TOP_LEVEL),
    ]


def weak_label(text: str, begin: int, end: int, kind: str, base: list[tuple[int, int, str]]) -> int | None:
    """1 or 0 as far as patterns, checks, assignments and context words tell, else None."""
    span = text[begin:end]
    over = [(min(end, z) - max(begin, a), z - a) for a, z, _ in base if a < end and begin < z]
    if over:
        return 1 if any(common >= 0.8 * max(end - begin, size) for common, size in over) else None
    near = text[max(0, begin - 32) : begin].lower()
    if kind == "secret":
        return int(bool(_ASSIGNED.search(text, max(0, begin - 32), begin)))
    if kind == "address":
        written = _PLAIN_ADDRESS.fullmatch(plain_address(span))
        if written and ("[" in span or "(" in span or _MAIL_WORDS.search(near)):
            return 1
        return None if written and written[1].lower() in _TOP_LEVEL else 0
    digits = sum(c in "0123456789" for c in span)
    whole = not _within_run(text, begin, end)
    phone, known = _PHONE_WORDS.search(near), _ID_WORDS.search(near)
    if phone or known:
        formed = phone and _NATIONAL.fullmatch(span) or known and _SOCIAL.fullmatch(span)
        if formed or whole and digits <= (19 if known else 15):
            return 1
        return 0 if _FORMED_INSIDE.search(span) else None  # numbers in a row, or one and a piece of another
    if 12 <= digits <= 19 and _CARD.fullmatch(span):
        around = text[begin - 1 : begin] + text[end : end + 1]
        return 0 if any(c.isalnum() for c in around) else None
    return None if _NATIONAL.fullmatch(span) or _SOCIAL.fullmatch(span) else 0


def plain_address(span: str) -> str:
    """An address that is spelled out, as it would be written."""
    return _DOT.sub(".", _AT.sub("@", span))


def _within_run(text: str, begin: int, end: int) -> bool:
    """Whether a number goes on, over separators, before or behind the place."""
    return bool(_RUN_BEFORE.search(text, max(0, begin - 3), begin) or _RUN_BEHIND.match(text, end))


class Detector:
    """Base spans and the candidates whose calibrated probability reaches the threshold of their generator."""

    def __init__(self, trees: BoostedTrees | None, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def spans(self, text: str | None) -> list[tuple[int, int, str, bool, float]]:
        """``start, end, kind, base, score`` in order of start, then kind."""
        if not text or not _ANYTHING.search(text):
            return []
        base = base_spans(text)
        found = [(a, z, kind, True, 1.0) for a, z, kind in base]
        # A text may have more candidates than could be held with their features, so they are scored some at a time.
        proposed, good = candidates(text) if self.trees else iter(()), []
        while some := list(islice(proposed, AT_ONCE)):
            some = _apart(list(dict.fromkeys(some)), base)
            if some:
                scores = self.trees.probability(np.array([features(text, *c) for c in some]))
                least = np.array([self.thresholds[kind] for _, _, kind in some])
                rows = [(p, a, z, KINDS.index(kind)) for p, (a, z, kind) in zip(scores.tolist(), some, strict=True)]
                good.append(np.array(rows)[scores >= least])
        if good:
            p, begins, ends, kinds = np.concatenate(good).T
            taken: list[tuple[int, int]] = []
            for i in np.lexsort((kinds, ends, begins, -p)).tolist():
                a, z = int(begins[i]), int(ends[i])
                if _free(taken, a, z):
                    found.append((a, z, KINDS[int(kinds[i])], False, float(p[i])))
        return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))

    def redact(self, text: str | None) -> str | None:
        """The text with ``<kind>`` in the place of each span; of overlapping spans, for the first of them."""
        spans = self.spans(text)
        if not spans:
            return text
        parts, done, at = [], 0, 0
        while at < len(spans):
            begin, end, kind = spans[at][:3]
            at += 1
            while at < len(spans) and spans[at][0] < end:
                end = max(end, spans[at][1])
                at += 1
            parts += [text[done:begin], f"<{kind}>"]
            done = end
        return "".join([*parts, text[done:]])


_ANYTHING = re.compile(r"[0-9@]|(?i: dot |\[dot\]|\(dot\))")


def _apart(spans: list[tuple[int, int, str]], base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans that overlap none of the base, which may overlap itself."""
    if not base:
        return spans
    begins = np.array([a for a, _, _ in base])
    furthest = np.maximum.accumulate([z for _, z, _ in base])
    last = np.searchsorted(begins, [z for _, z, _ in spans], side="left") - 1
    return [span for span, i in zip(spans, last, strict=True) if i < 0 or furthest[i] <= span[0]]


def _free(taken: list[tuple[int, int]], begin: int, end: int) -> bool:
    """Enters the span in the sorted list if it overlaps none there."""
    from bisect import bisect_left

    at = bisect_left(taken, (begin, end))
    if at and taken[at - 1][1] > begin or at < len(taken) and taken[at][0] < end:
        return False
    taken.insert(at, (begin, end))
    return True


def fit_detector(documents: DataFrame, text_column: str = "text", precision: float = 0.95) -> Detector:
    """Fits the trees on candidates of all documents; without ``LEAST`` different ones for and against only the base is found."""
    rows = documents.select(F.col(text_column).alias("text")).where("text IS NOT NULL")

    def written(found: dict[tuple[int, int, int], list]) -> pa.RecordBatch:
        columns = [*zip(*found)] if found else [(), (), ()]
        x, n = [x for x, _ in found.values()], [n for _, n in found.values()]
        found.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip((*columns, x, n), (*[pa.int64()] * 3, pa.list_(pa.float64()), pa.int64()), strict=True)],
            ["kind", "y", "lot", "x", "n"],
        )

    def examples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, int, int], list] = {}
            for text in batch.column(0).to_pylist():
                if not _ANYTHING.search(text):
                    continue
                base = base_spans(text)
                seen_there: set[tuple[int, int, str]] = set()
                for begin, end, kind in candidates(text):
                    if kind == "address":  # the only kind that is proposed in two ways
                        if (begin, end, kind) in seen_there:
                            continue
                        seen_there.add((begin, end, kind))
                    if len(found) >= AT_ONCE:
                        yield written(found)
                    label = weak_label(text, begin, end, kind, base)
                    if label is not None:
                        # By what is written, so that a repeated run learns the same.
                        seen = f"{kind}\0{text[max(0, begin - 32) : begin]}\0{text[begin:end]}\0{text[end : end + 8]}"
                        lot = int.from_bytes(hashlib.blake2b(seen.encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 1
                        key = (KINDS.index(kind), label, lot)
                        if key in found:
                            found[key][1] += 1
                        else:
                            found[key] = [np.array(features(text, begin, end, kind)), 1]
            yield written(found)

    known = rows.mapInArrow(examples, "kind long, y long, lot long, x array<double>, n long")
    known = durable(known.groupBy("kind", "y", "lot").agg(F.first("x").alias("x"), F.sum("n").alias("n")))
    counts = {(row.kind, row.y): row["count"] for row in known.groupBy("kind", "y").count().collect()}
    if any(sum(n for (_, label), n in counts.items() if label == y) < LEAST for y in (0, 1)):
        return Detector(None, {})
    below = {stratum: int(min(1.0, EXAMPLES / n) * (1 << 63)) - 1 for stratum, n in counts.items()}
    chosen = F.lit(False)
    for (kind, label), most in below.items():
        chosen |= (F.col("kind") == kind) & (F.col("y") == label) & (F.col("lot") <= most)
    found = sorted((tuple(row.x), row.y, row.lot) for row in known.where(chosen).select("x", "y", "lot").collect())
    x, y = np.array([x for x, _, _ in found]), np.array([label for _, label, _ in found])
    trees = BoostedTrees().fit(x, y, np.array([lot % 3 == 1 for _, _, lot in found]))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            kind, label, lot, n = (np.asarray(batch.column(i)) for i in (0, 1, 2, 4))
            p = trees.probability(np.array(batch.column(3).to_pylist())) if len(n) else np.zeros(0)
            most = np.array([below[stratum] for stratum in zip(kind.tolist(), label.tolist(), strict=True)], np.int64)
            grown = (lot % 3 != 1) & (lot <= most)
            for *key, count in zip(kind.tolist(), label.tolist(), np.where(grown, -1, (p * BINS).astype(int)).tolist(), n.tolist(), strict=True):
                sums[tuple(key)] += count
        columns = [*zip(*sums)] if sums else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*columns, [*sums.values()])], ["kind", "y", "bin", "n"])

    scored = known.mapInArrow(score, "kind long, y long, bin long, n long")
    histogram = np.zeros((len(KINDS), 2, BINS + 2))
    for row in scored.groupBy("kind", "y", "bin").agg(F.sum("n").alias("n")).collect():
        histogram[row.kind, row.y, row.bin] = row.n
    return Detector(trees, {kind: _threshold(histogram[i], precision) for i, kind in enumerate(KINDS)})


def _threshold(histogram: np.ndarray, precision: float) -> float:
    """The lowest score, a half at least, from which on the precision holds; 0.9 without examples that tell.

    A row of counts by score for each label; the last holds the examples the trees were grown on, whose scores flatter.
    The others count for these as well.
    """
    judged = histogram[:, :-1]
    sums = judged.sum(axis=1)
    if any(grown and not n for grown, n in zip(histogram[:, -1], sums, strict=True)):
        return 0.9
    against, those_for = judged * ((sums + histogram[:, -1]) / np.maximum(sums, 1))[:, None]
    above, total = those_for[::-1].cumsum()[::-1], (against + those_for)[::-1].cumsum()[::-1]
    good = np.flatnonzero((those_for > 0) & (above >= precision * total))
    return max(0.5, float(good[0]) / BINS) if len(good) else 0.9


_SPANS = "array<struct<start: int, end: int, kind: string, base: boolean, score: double>>"


def find_personal_data(
    documents: DataFrame, detector: Detector | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id, spans``, a row per document; starts and ends count code points, ends are exclusive.

    A null or empty text has no spans. Ids may be null or repeated; each row is searched for itself.
    """
    detector = detector or fit_detector(documents, text_column)
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    names = ("start", "end", "kind", "base", "score")
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.float64())
    spans_type = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))

    def find(texts: pa.Array) -> pa.Array:
        return pa.array([[dict(zip(names, s, strict=True)) for s in detector.spans(t)] for t in texts.to_pylist()], spans_type)

    schema = f"id {rows.schema['id'].dataType.simpleString()}, spans {_SPANS}"
    return rows.mapInArrow(_replacing("text", "spans", find), schema).withColumnRenamed("id", id_column)


def redact_personal_data(documents: DataFrame, detector: Detector | None = None, text_column: str = "text") -> DataFrame:
    """The documents, all columns, with ``<kind>`` in the place of each span of the text; null texts stay null."""
    detector = detector or fit_detector(documents, text_column)
    names = documents.columns
    plain = documents.toDF(*(f"_{i}" for i in range(len(names))))
    place = f"_{names.index(text_column)}"

    def redact(texts: pa.Array) -> pa.Array:
        return pa.array([detector.redact(text) for text in texts.to_pylist()], pa.string())

    return plain.mapInArrow(_replacing(place, place, redact), plain.schema).toDF(*names)


def _replacing(column: str, name: str, function: Callable[[pa.Array], pa.Array]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                columns = {
                    (name if field == column else field): (function(some.column(field)) if field == column else some.column(field))
                    for field in some.schema.names
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run
