"""Plain versions of the operators, one row or pair at a time."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

BLANKS = "[^\\x20\\x09-\\x0D]+"


def suffix_dedup(rows, length=100):
    """doc_id, n_bytes, n_removed, n_spans, digest of what stays."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    seen, result = set(), {}
    for doc, text in order:
        data = (text or "").encode()
        gone = [False] * len(data)
        for start in range(len(data) - length + 1):
            string = data[start : start + length]
            if string in seen:
                gone[start : start + length] = [True] * length
            else:
                seen.add(string)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        result[doc, text] = (doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted((result[row] for row in rows), key=repr)


def shingles(text):
    words = re.findall(BLANKS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else None


def near_duplicates(rows, threshold=0.8):
    """Class id by row number."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    common, holders = Counter(), defaultdict(list)
    for i, own in enumerate(sets):
        for shingle in own or ():
            common.update((j, i) for j in holders[shingle])
            holders[shingle].append(i)
    for (i, j), n in common.items():
        if n >= threshold * (len(sets[i]) + len(sets[j]) - n):
            root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [least[find(i)] for i in range(len(rows))]


def personal_data(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    )
    found = []
    for number, (kind, pattern, check) in enumerate(kinds):
        found += [(m.start(), number, m.end(), kind) for m in re.finditer(pattern, text) if check(m[0])]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def line_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = re.findall(BLANKS, text)
    lines = Counter(line for line in text.split("\n") if re.search(BLANKS, line))
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    marked = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(n - 1 for n in lines.values()),
        len(marked),
        len(words) < 10 or 100 * len(marked) > 20 * len(words),
    )


def nearest(rows, asks, k=5):
    """query: [(id, cosine)], best first."""
    known = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    known = [(i, v) for i, v in known if np.isfinite(v).all() and v.any()]
    result = {}
    for i, v in known:
        if asks(i):
            scores = [(-float((v * w).sum() / np.sqrt((v * v).sum()) / np.sqrt((w * w).sum())), j) for j, w in known if j != i]
            result[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return result


def check_packing(rows, pieces, tokenizer, size):
    """Pieces (doc_id, start, length, crc, doc_tokens, sequence_id, offset) hold each id of each row once."""
    wanted = Counter()
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        wanted[doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    sequences = defaultdict(list)
    for *_, length, _, _, sequence, offset in ((p[0], p[1], p[2], p[3], p[4], p[5], p[6]) for p in pieces):
        sequences[sequence].append((offset, length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    assert sorted(sequences) == list(range(len(sequences)))
    total = sum(n * count for (_, n, _), count in wanted.items())
    assert len(sequences) == -(-total // size)
    assert sum(p[2] for p in pieces) == total
    by_row = defaultdict(set)
    for p in pieces:
        by_row[p[0]].add((p[1], p[2], p[3]))
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for start, length, crc in by_row[doc]:
            if len([1 for d, _ in rows if d == doc]) == 1:
                assert zlib.crc32(ids[start : start + length].tobytes()) == crc


def quadratic_discriminant(rows, labels, queries, pooled, diagonal):
    """Scores by two normal densities, sums written out, with determinants and solved equations."""
    center = rows.mean(axis=0)
    scale = np.sqrt(((rows - center) ** 2).mean(axis=0)) + 1e-6
    groups = [[(r - center) / scale for r, y in zip(rows, labels) if y == c] for c in (0, 1)]
    means = [sum(g) / len(g) for g in groups]
    own = [sum(np.outer(r - m, r - m) for r in g) / (len(g) - 1) for g, m in zip(groups, means)]
    whole = sum(len(g) * s for g, s in zip(groups, own)) / len(rows)
    prior = (len(groups[1]) + 1) / (len(rows) + 2)
    scores = []
    for query in queries:
        x, logs = (query - center) / scale, []
        for mean, s in zip(means, own):
            s = (1 - pooled) * s + pooled * whole
            s = np.where(np.eye(len(s)) > 0, s + 1e-3, (1 - diagonal) * s)
            logs.append(-0.5 * ((x - mean) @ np.linalg.solve(s, x - mean) + np.linalg.slogdet(s)[1]))
        odds = np.log(prior / (1 - prior)) + logs[1] - logs[0]
        scores.append(1 / (1 + np.exp(-np.clip(odds, -500, 500))))
    return np.array(scores)


def word_statistics(text):
    """Logarithms of the number of words, their mean length in bytes and its spread; the logit of the share of repeated words."""
    words = text.encode().split()
    lengths = [len(w) for w in words]
    mean = sum(lengths) / max(len(words), 1)
    spread = (sum((n - mean) ** 2 for n in lengths) / max(len(words), 1)) ** 0.5
    repeated = (len(words) - len(set(words)) + 0.5) / (len(words) + 1)
    return [np.log1p(len(words)), np.log1p(mean), np.log1p(spread), np.log(repeated / (1 - repeated))]
