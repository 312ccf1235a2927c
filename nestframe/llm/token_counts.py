"""Token counts by a finite-state transducer compiled from a byte-pair tokenizer.

The tokens of every beginning of a text can be told from left to right. A row of tokens is what the tokenizer gives for
their text if and only if this holds for each two neighbours alone: the merge that would first cross a border between
two tokens would also be made if there were nothing but these two. So the last token of a beginning is the one piece
that ends there and agrees with the last token of what is before it, and the tokens are one more than there. For the
next characters it matters only which pieces may still be under way, from which places, what the last tokens at these
places were, and how the counts there differ from the count here. This is a state; a transition to the next reads one
byte and carries the change of the count, which is negative where a piece takes the place of several tokens.

States and transitions are made when first needed, kept in a table over bytes, and dropped when the table is full, so
memory is bounded whatever the texts. A block of texts is cut into chunks that are run side by side, one byte of all
chunks at a time. Where two characters that no piece holds in a row meet, the state is the same whatever went before:
the map of a chunk, from the state it is entered in to the state it is left in and the change of the count, is thus its
*head* up to the first such place, which needs the state, and a constant for the rest. Maps are composed by a scan: the
heads of all chunks are run from the constants before them, side by side again, and the counts are summed up by text.
Chunks without such a place (a long run of blanks, text in a script without blanks) lengthen the head before them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestframe.llm.bytesets import batched, buffer_of

#: Bytes of text in a chunk.
CHUNK = 512
#: States kept at most, 1.25 kB each.
STATES = 1 << 17
#: Tokens below a node of the piece tree up to which a state lists those that may follow.
LISTED = 10
#: Runs fewer than this are done one by one, not side by side.
ABREAST = 24
#: Pairs of tokens whose agreement is remembered at most.
PAIRS = 1_000_000
_FIRST, _NEVER = float("inf"), float("-inf")
BLANK, UNREADABLE = "▁", "\ufffd"
#: Bytes of texts counted at a time.
BLOCK = 4 << 20
#: Texts by which a compiled model is compared with its library.
PROBES = ("", "Hello  world", " a\n\n b\tc", "naïve 日本語 <s> 3.14", "▁x \x00   \U0001f600", "x" * 40 + " " * 40)


def _numbers(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field number and value of each entry of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    at = 0
    while at < len(data):
        head, at = varint(at)
        wire = head & 7
        if wire == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if wire == 2 else (8 if wire == 1 else 4, at)
            value, at = data[at : at + size], at + size
        yield head >> 3, value


class PieceModel:
    """Pieces and their scores of a byte-pair model with byte fallback, from its file."""

    def __init__(self, path: str):
        # The numbers of the fields of the model file, and its numbers for kinds of models and pieces.
        score, kind, normal, control, byte_pair = 2, 3, 1, (2, 3, 6), 2
        with open(path, "rb") as file:
            entries = list(_numbers(file.read()))
        trainer = dict(_numbers(next(v for n, v in entries if n == 2)))
        rules = dict(_numbers(next(v for n, v in entries if n == 3)))
        plain = not rules.get(2) and rules.get(3, 1) and not rules.get(4, 1) and rules.get(5, 1)
        if trainer.get(3) != byte_pair or not trainer.get(35) or trainer.get(24) or not plain:
            raise ValueError("only byte-pair models with byte fallback that leave the text as it is can be compiled")
        self.scores: dict[str, float] = {}
        for number, value in entries:
            if number == 1:
                piece = dict(_numbers(value))
                if piece.get(kind, normal) == normal:
                    self.scores[piece[1].decode()] = float(np.frombuffer(piece.get(score, bytes(4)), "<f4")[0])
                elif piece[kind] not in control:
                    raise ValueError("pieces of the user's own cannot be compiled")
        self._histories: dict[str, tuple] = {}
        self.pairs = {piece[i : i + 2] for piece in self.scores for i in range(len(piece) - 1)}

    def weight(self, token: str) -> int:
        """How many ids stand for a token: a character that is no piece is spelt in bytes."""
        return 1 if token in self.scores else len(token.encode("utf-8", "surrogatepass"))

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text: the best pair of neighbours is merged, the first of equals, until there is none."""
        return [token for token, *_ in self._merge(text)[0]]

    def _merge(self, text: str) -> tuple[list[tuple], list[tuple], list[tuple], bool]:
        """The tokens of a short text, the tokens that were at its begin and at its end, and whether scores only fell.

        Tokens come as ``(token, score made at, score merged at)``.
        """
        tokens, scores = [(letter, _FIRST, _NEVER) for letter in text], self.scores
        heads, tails, fell, lowest = [], [], True, _FIRST
        while True:
            best, at = None, 0
            for i in range(len(tokens) - 1):
                score = scores.get(tokens[i][0] + tokens[i + 1][0])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return tokens, [*heads, *tokens[:1]], [*tails, *tokens[-1:]], fell
            fell, lowest = fell and best < lowest, best
            if at == 0:
                heads.append((*tokens[0][:2], best))
            if at == len(tokens) - 2:
                tails.append((*tokens[-1][:2], best))
            tokens[at : at + 2] = [(tokens[at][0] + tokens[at + 1][0], best, _NEVER)]

    def history(self, token: str) -> tuple[bool, list[tuple], list[tuple], bool]:
        """Whether a text is one token, and what was at its begin and end while it was merged."""
        if token not in self._histories:
            if len(self._histories) >= PAIRS:
                self._histories.clear()
            tokens, heads, tails, fell = self._merge(token)
            self._histories[token] = len(tokens) == 1, heads, tails, fell
        return self._histories[token]

    def agree(self, before: str | None, token: str) -> bool:
        """Whether two tokens, next to each other, are the tokens of their text.

        They are not if what was at the end of the one and at the begin of the other at the same time makes a piece
        that is merged before either is merged within its token. If that hangs on more than scores, all is merged.
        """
        whole, heads, _, fell = self.history(token)
        if before is None or not whole:
            return whole
        other, _, tails, falls = self.history(before)
        if not other:
            return False
        scores = self.scores
        clear = fell and falls
        for left, made, gone in tails:
            for right, started, ended in heads:
                score = scores.get(left + right)
                if score is None or score < gone or score < ended:
                    continue
                if not clear or score in (gone, ended) or gone == started or ended == made:
                    return self.merged(before + token) == [before, token]
                if gone < started and ended < made:
                    return False
        return True


class Transducer:
    """Reads texts as UTF-8 and counts tokens; states and transitions are made when they are first needed.

    A state is the pieces under way, as ``(node, before, owed)`` from the longest to the one yet to begin: the node of
    the piece tree reached, the last token before the piece (or those pieces below the node that agree with it), and
    the count there less the count here. While a character is read in part, its bytes are part of the state.
    """

    START = 0

    def __init__(self, model: PieceModel, states: int = STATES):
        self.model, self.limit = model, states
        self.agreement: dict[tuple[str | None, str], bool] = {}
        self.children: list[dict[str, int]] = [{}]
        self.token: list[str | None] = [None]
        for piece in {*model.scores, *(c for piece in model.scores for c in piece)}:
            node = 0
            for letter in piece:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][letter]
            self.token[node] = piece
        self.below: dict[int, tuple[str, ...] | None] = {}
        # Borders: two characters, here of one byte, that no piece holds in a row.
        self.border = np.zeros((256, 256), bool)
        for a in range(128):
            for b in range(128):
                self.border[a, b] = (chr(a) + chr(b)).replace(" ", BLANK) not in model.pairs
        self._clear()

    def _clear(self) -> None:
        room = min(1 << 10, self.limit)
        self.number: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.to = np.full((room, 256), -1, np.int32)
        self.gain = np.zeros((room, 256), np.int8)
        self._state((((0, None, 0),), b""))

    def _state(self, key: tuple) -> int:
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.keys)
            self.keys.append(key)
            if number == len(self.to):
                more = np.full_like(self.to, -1)
                self.to, self.gain = np.concatenate((self.to, more)), np.concatenate((self.gain, np.zeros_like(self.gain)))
        return number

    def _listed(self, node: int) -> tuple[str, ...] | None:
        """The pieces below a node, if they are few."""
        if node not in self.below:
            found, open_nodes = [], [*self.children[node].values()]
            while open_nodes and len(found) <= LISTED:
                at = open_nodes.pop()
                open_nodes += self.children[at].values()
                if self.token[at] in self.model.scores:
                    found.append(self.token[at])
            self.below[node] = tuple(sorted(found)) if len(found) <= LISTED else None
        return self.below[node]

    def _agree(self, before: str | frozenset | None, token: str) -> bool:
        """Whether a token may follow: the tokenizer parts the text of both where they meet."""
        if isinstance(before, frozenset):
            return token in before
        known = self.agreement.get((before, token))
        if known is None:
            if len(self.agreement) >= PAIRS:
                self.agreement.clear()
            known = self.agreement[before, token] = self.model.agree(before, token)
        return known

    def _read(self, entries: tuple, letter: str) -> tuple[tuple, int]:
        """The pieces under way after one more character, and the change of the count."""
        last = entries[-1][1]
        if last is not None and last[-1] + letter not in self.model.pairs:
            entries = ((0, None, 0),)
        moved, found, gain = [], None, 0
        for node, before, owed in entries:
            child = self.children[node].get(letter)
            if child is None:
                continue
            token = self.token[child]
            if found is None and token is not None and self._agree(before, token):
                found, gain = token, owed + self.model.weight(token)
            if self.children[child]:
                listed = None if isinstance(before, frozenset) else self._listed(child)
                if listed is not None:
                    before = frozenset(t for t in listed if self._agree(before, t))
                elif isinstance(before, frozenset):
                    before = before.intersection(self._listed(child))
                if before or before is None:
                    moved.append((child, before, owed))
        if found is None:
            found, gain = letter, self.model.weight(letter)
        return (*((node, before, owed - gain) for node, before, owed in moved), (0, found, 0)), gain

    def _make(self, state: int, byte: int) -> None:
        """Adds the transition of a state by a byte. What is no UTF-8 counts as U+FFFD."""
        entries, part = self.keys[state]
        gain = 0
        if part and byte & 0xC0 != 0x80:
            entries, gain = self._read(entries, UNREADABLE)
            part = b""
        part += bytes((byte,))
        whole = 1 if part[0] < 0xC0 else 2 if part[0] < 0xE0 else 3 if part[0] < 0xF0 else 4
        if len(part) == whole:
            letter = part.decode("utf-8", "replace")
            letter = BLANK if letter == " " else letter if len(letter) == 1 else UNREADABLE
            entries, more = self._read(entries, letter)
            gain, part = gain + more, b""
        target = self._state((entries, part))
        self.to[state, byte], self.gain[state, byte] = target, gain

    def _complete(self, state: np.ndarray, active: int, data: np.ndarray) -> np.ndarray:
        """Makes the transitions that the first ``active`` states lack; all states as they are numbered then.

        If the table is full it is begun anew with the states in use.
        """
        pairs = np.unique(state[:active].astype(np.int64) * 256 + data)
        pairs = pairs[self.to[pairs >> 8, pairs & 255] < 0]
        if len(self.keys) + len(pairs) > self.limit:
            used, place = np.unique(state, return_inverse=True)
            keys = [self.keys[i] for i in used.tolist()]
            if len(self.keys) > 2 * len(keys) + len(pairs):
                self._clear()
                state = np.array([self._state(key) for key in keys], np.int32)[place]
                pairs = np.unique(state[:active].astype(np.int64) * 256 + data)
        for pair in pairs.tolist():
            self._make(pair >> 8, pair & 255)
        return state

    def run(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The change of the count over each stretch of ``data``, and the state in which it is left.

        All stretches are read side by side; the last few that are longer than the others, one after the other.
        """
        order = np.argsort(starts - ends, kind="stable")
        begin, size, state = starts[order], (ends - starts)[order], states[order].astype(np.int32)
        counts = np.zeros(len(starts), np.int64)
        step, active = 0, int(np.searchsorted(-size, 0))
        while active > ABREAST:
            byte = data[begin[:active] + step]
            target = self.to[state[:active], byte]
            if target.min() < 0:
                state = self._complete(state, active, byte)
                target = self.to[state[:active], byte]
            counts[:active] += self.gain[state[:active], byte]
            state[:active] = target
            step += 1
            active = int(np.searchsorted(-size[:active], -step))
        for lane in range(active):
            for at in range(begin[lane] + step, begin[lane] + size[lane]):
                here, byte = state[lane], data[at]
                if self.to[here, byte] < 0:
                    state = self._complete(np.roll(state, -lane), 1, data[at : at + 1])
                    state = np.roll(state, lane)
                    here = state[lane]
                counts[lane] += self.gain[here, byte]
                state[lane] = self.to[here, byte]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return counts[back], state[back]

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """The number of tokens of each text, a blank before it included; none for an empty one."""
        counts = np.zeros(len(starts), np.int64)
        texts = np.flatnonzero(starts < ends)
        if not len(texts):
            return counts
        pieces = -(-(ends - starts)[texts] // chunk)
        row = np.repeat(texts, pieces)
        place = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[row] + place * chunk
        end = np.minimum(begin + chunk, ends[row])

        # Each chunk's map is constant from its first border on; a text is entered after the blank before it.
        borders = np.flatnonzero(self.border[data[:-1], data[1:]]) + 1
        at = np.searchsorted(borders, begin)
        border = np.append(borders, len(data))[at]
        first = place == 0
        constant = first | (border < end)
        entered, blank = self._enter()
        begin = np.where(first, begin, border)[constant]
        gains, left = self.run(data, begin, end[constant], np.where(first[constant], entered, self.START))
        np.add.at(counts, row[constant], gains + np.where(first[constant], blank, 0))

        # The head of a chunk is entered in the state the last constant before it was left in. Chunks that are all head
        # belong to the next one's; the heads of a text lie between the end of one constant and the begin of the next.
        same = np.append(row[constant][1:] == row[constant][:-1], False)
        until = np.where(same, np.append(begin[1:], 0), ends[row[constant]])
        heads, _ = self.run(data, end[constant], until, left)
        np.add.at(counts, row[constant], heads)
        return counts

    def _enter(self) -> tuple[int, int]:
        """The state after the blank that is put before a text, and the tokens so far."""
        if self.to[self.START, 0x20] < 0:
            self._make(self.START, 0x20)
        return int(self.to[self.START, 0x20]), int(self.gain[self.START, 0x20])


_compiled: dict[str, Transducer] = {}


def compiled(path: str) -> Transducer:
    """The worker's transducer of a model, which it keeps from task to task; compared with the library at first."""
    if path not in _compiled:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        transducer = Transducer(PieceModel(path))
        counts = transducer.count(*buffer_of(pa.array(PROBES)))
        if counts.tolist() != [len(ids) for ids in library.encode(list(PROBES), num_threads=1)]:
            raise ValueError(f"{path} counts otherwise than its library")
        _compiled[path] = transducer
    return _compiled[path]


def count_tokens(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` of each row, as the library of the model at ``path`` counts whole texts.

    Null and empty texts have no bytes and no tokens. Texts of any length are counted whole; ids may be null or occur
    several times, and each row gets its own counts. Other columns do not matter. The work is one pass without a
    shuffle; a lost task is done again from its rows alone.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def counted(block: pa.Table) -> pa.Table:
        data, starts, ends = buffer_of(block.column("text"))
        tokens = compiled(path).count(data, starts, ends)
        return pa.table({"id": block.column("id"), "n_bytes": ends - starts, "n_tokens": tokens})

    kind = rows.schema["id"].dataType.simpleString()
    counts = rows.mapInArrow(batched(counted, BLOCK), f"id {kind}, n_bytes long, n_tokens long")
    return counts.withColumnRenamed("id", id_column)
