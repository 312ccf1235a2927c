"""Token ids of texts with a word-wise tokenizer that meets each different word once."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from nestframe.llm.bytesets import ranges

#: Words that a Python worker remembers; when they are as many, it starts anew.
REMEMBERED = 300_000
#: Characters below this may take the short way.
_LIMIT = 0x180


def _members(kind: str) -> str:
    return "".join(re.escape(chr(i)) for i in range(_LIMIT) if unicodedata.category(chr(i))[0] in kind)


def odd_text() -> re.Pattern:
    """Finds what the short way is not made for.

    Below the limit lower case works letter by letter, but for the dotted capital I, and no characters combine.
    Controls, odd blanks and whatever could be a special token written out are left to the tokenizer as well.
    """
    plain = "".join(
        re.escape(chr(i))
        for i in range(_LIMIT)
        if unicodedata.category(chr(i)) not in ("Cc", "Cf", "Zs") and i not in (0x130, 0x149)
    )
    return re.compile(f"[^{plain} \\t\\n\\r]|<\\|")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be seen, else one from 256 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in seen else chr(next(others)) for b in range(256)]


class WordTokenizer:
    """Encodes texts as the tokenizer of ``path`` does, without special tokens around them.

    It is made for byte-level BPE with word ends on lower-case text whose words are contractions, runs of letters,
    single digits and runs of other characters; a text's ids are then those of its words in a row. Arrow cuts a batch
    into words and lists the different ones; those not yet known are encoded by the tokenizer's own model. Texts that
    hold anything out of the ordinary go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        letters, digits = _members("L"), _members("N")
        # All words but runs of letters; with blanks around these, the words are what blanks part.
        self.others = f"('s|'t|'re|'ve|'m|'ll|'d|[{digits}]|[^ \\t\\n\\r{letters}{digits}]+)"
        self.odd = odd_text()
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian 16-bit numbers; none for a null text."""
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        return [ids[end - count : end].tobytes() for end, count in zip(ends.tolist(), counts.tolist(), strict=True)]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        texts = column.to_pylist()
        odd = np.array([bool(text and self.odd.search(text)) for text in texts], bool)
        plain = pc.if_else(pa.array(odd), "", pc.fill_null(column.cast(pa.string()), "")) if len(texts) else column
        plain = pc.replace_substring_regex(pc.utf8_lower(plain), self.others, r" \1 ")
        parts = pc.utf8_split_whitespace(plain).cast(pa.list_(pa.string()))
        words = parts.flatten().dictionary_encode()
        own = self._look_up(words.dictionary.to_pylist())
        # Ids of the different parts lie in a pool, from which those of all parts are gathered.
        sizes = np.array([len(ids) // 2 for ids in own], np.int64)
        begins = np.cumsum(sizes) - sizes
        index = words.indices.to_numpy(zero_copy_only=False)
        ids = np.frombuffer(b"".join(own), "<u2")[ranges(begins[index], sizes[index])]
        ends = np.concatenate(([0], np.cumsum(sizes[index])))[np.asarray(parts.offsets) - parts.offsets[0].as_py()]
        counts = np.diff(ends)
        if odd.any():
            at = np.flatnonzero(odd).tolist()
            found = self.tokenizer.encode_batch([texts[i] for i in at], add_special_tokens=False)
            whole = dict(zip(at, (np.array(one.ids, "<u2") for one in found), strict=True))
            ids = np.concatenate([whole.get(i, ids[ends[i] : ends[i + 1]]) for i in range(len(texts))])
            counts[at] = [len(whole[i]) for i in at]
        return ids, counts

    def _look_up(self, words: list[str]) -> list[bytes]:
        found = list(map(self.known.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing and len(self.known) + len(missing) > REMEMBERED:
            self.known.clear()
        encode = self.tokenizer.model.tokenize
        for i in missing:
            word = words[i]
            letters = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
            found[i] = b"".join([token.id.to_bytes(2, "little") for token in encode(letters)]) if word else b""
            self.known[word] = found[i]
        return found


def shared_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a vocabulary, kept where it outlives the task: Python workers serve many tasks."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_word_tokenizers", {})
    if path not in held:
        held[path] = WordTokenizer(path)
    return held[path]
