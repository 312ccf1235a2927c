"""Repairs against the best of all edits."""

import heapq
import random
import re
import zlib
from hashlib import sha256

import pytest

from nestframe.llm.conversation_repair import damaged, repair
from nestframe.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile("(s?(ua)+)?")


def damage(rows):
    """Rows after damage by conversation, in order."""
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (repr(r[0]), r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
        role, text = " " if role is None else role, " " if text is None else text
        talk = talks.setdefault(conv, [])
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if lot:
            role = "user" if lot == 4 else role
            text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
            talk += [(turn, role, text)] * (2 if lot == 3 else 1)
    # A repeated row beside its like.
    return {c: t for c, t in talks.items()}


def faults_of(talk):
    seen, found = set(), []
    for _, role, text in talk:
        stripped = text.strip(" \t\n\v\f\r")
        if not stripped:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if stripped[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def best(talk, faults):
    """The cheapest edits and what they give, by search over all edits in order of cost and then of the audit."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, roles, turns = heapq.heappop(queue)
        state = at, roles[-1:], roles == ""
        if at == len(talk) and PATTERN.fullmatch(roles):
            return cost, audit, turns
        if state in done:
            continue
        done.add(state)
        following = "su" if not roles else {"s": "u", "u": "a", "a": "u"}[roles[-1]]
        for role in ("user", "assistant"):
            if role[0] in following:
                heapq.heappush(queue, (cost + 3, audit + "I", at, roles + role[0], (*turns, f"{role}:")))
        if at == len(talk):
            continue
        _, role, text = talk[at]
        heapq.heappush(queue, (cost + 4, audit + "D", at + 1, roles, turns))
        if faults[at] in ("blank", "duplicate"):
            continue
        more = 3 if faults[at] else 0
        if role[:1] and role[:1] in following:
            heapq.heappush(queue, (cost + more, audit + "K", at + 1, roles + role[:1], (*turns, f"{role}:{text}")))
        for new in ("user", "assistant"):
            if new[0] in following:
                heapq.heappush(queue, (cost + 3 + more, audit + "R", at + 1, roles + new[0], (*turns, f"{new}:{text}")))


def plain(talks):
    result = []
    for conv, talk in talks.items():
        faults = faults_of(talk)
        cost, audit, turns = best(talk, faults)
        known = [t for t, *_ in talk if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [role[:1] for _, role, _ in talk]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        counts = [faults.count(kind) for kind in ("blank", "duplicate", "truncated")]
        result.append((conv, gaps, *counts, illegal, cost, audit, sha256("\n".join(turns).encode()).hexdigest()))
    return sorted(result, key=repr)


def some_rows(seed, n_talks, most=9):
    random.seed(seed)
    rows = []
    for conv in range(n_talks):
        for turn in range(random.randint(1, most)):
            role = random.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "a"])
            text = random.choice(["Yes.", "No!", "cut", " ", "", "Why? ", "x.\n", f"Turn {turn}.", "Ünï\x0b"])
            rows.append((conv, random.choice([turn, turn, turn + 1, None]), role, text))
    return rows


def queried(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/conversations.parquet")
    return sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, folder).collect()), key=repr)


def test_agrees_with_search_over_all_edits(spark, tmp_path):
    rows = some_rows(1, 400)
    rows += [(None, 0, "user", "Hi."), (None, 1, None, None), (None, None, "assistant", "Ho."), (1000, 0, "user", "x" * 300_000)]
    rows += [(2000, 3, "user", "Same.")] * 3
    dropped = next(i for i in range(3000, 9000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    found = queried(spark, str(tmp_path), rows)
    assert found == plain(damage(rows))
    assert (dropped, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest()) in found


def test_no_rows(spark, tmp_path):
    assert queried(spark, str(tmp_path), []) == []


@pytest.mark.parametrize("chunk", [1, 2, 5])
def test_chunks_make_no_difference(spark, chunk):
    """Long conversations in chunks of a few rows, duplicates over chunks among them."""
    rows = [(conv, turn, role, text) for conv, turn, role, text in some_rows(chunk, 25, most=30)]
    rows = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("conv_id", "kept").withColumnRenamed("kept", "conv_id")
    made = damaged(rows)
    talks = {}
    ordered = sorted(made.collect(), key=lambda r: (r.conv, r.turn is not None, r.turn or 0, r["first"], r.second, r.role, r.text))
    for r in ordered:
        talks.setdefault(r.conv, []).append((r.turn, r.role, r.text))
    assert sorted(map(tuple, repair(made, chunk).collect()), key=repr) == plain(talks)


def test_one_conversation_of_many_rows(spark):
    """Alternating turns with few faults, far more rows than a chunk: most chunks fit at once."""
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(5000) if t % 997]
    made = damaged(spark.createDataFrame(rows, SCHEMA))
    (one,) = repair(made, 64).collect()
    (whole,) = repair(made, 100_000).collect()
    assert one == whole and len(one.audit) >= 4600
