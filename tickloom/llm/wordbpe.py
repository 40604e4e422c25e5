"""Token ids of a word-wise BPE tokenizer, encoding each distinct word of a stretch of texts once.

Such a tokenizer drops white space and never joins what white space parts, so
the ids of a text are those of its words in a row. Pieces of words already seen
come from a table; new ones go through the tokenizer's own BPE model.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from tickloom.llm.periodic_runs import pieces

#: Words of these characters are pre-tokenized here; all others by the tokenizer as a whole.
PLAIN = "[!-~À-ɏ]*"
PLAIN_LINES = re.compile("[\n!-~À-ɏ]*")
#: What these characters are after normalization.
ALPHABET = sorted({letter for code in (*range(0x21, 0x7F), *range(0xC0, 0x250)) for letter in chr(code).lower()})


def byte_letters() -> dict[int, int]:
    """Byte to the letter that byte-level vocabularies write for it: printable ones themselves, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in set(own)]
    return {byte: byte for byte in own} | {byte: 0x100 + place for place, byte in enumerate(rest)}


def spelled_out(pattern: str) -> re.Pattern | regex.Pattern:
    """A pattern for lines of ``ALPHABET``: its letters and digits listed, which ``re`` matches faster than ``regex`` their classes."""
    listed = pattern
    for kind in (r"\p{L}", r"\p{N}"):
        listed = listed.replace(kind, "".join(letter for letter in ALPHABET if regex.fullmatch(kind, letter)))
    return regex.compile(f"\n|{pattern}") if r"\p" in listed else re.compile(f"\n|{listed}")


#: Bytes of text, at most, whose words are told apart at a time (less with small tables); a longer text is cut at white space.
STRETCH = 1 << 22
#: Bytes that a text counts besides its own.
TEXT = 64
#: Pieces that go through the tokenizer's model at a time.
TOGETHER = 1 << 12

#: Estimated bytes of an encoder's tables: smaller ones take more time, as words are encoded again.
TABLE_BYTES = 168 << 20
#: Estimated bytes of tables that a worker keeps between tasks.
KEPT_BYTES = 64 << 20


class WordBpe:
    """``ids(data)`` gives the ids of a UTF-8 text as little-endian unsigned 32-bit, ``each(texts)`` those of many."""

    #: Estimated bytes of a table's entry besides its key and ids.
    ENTRY = 128

    def __init__(self, definition: str, table_bytes: int = TABLE_BYTES) -> None:
        # Of words that are not plain, and of the pieces of plain ones; beyond them a table starts anew.
        self.LIMIT, self.PARTS = table_bytes * 2 // 7, table_bytes * 5 // 7
        self.stretch = min(STRETCH, table_bytes // 42)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        self.whole = Tokenizer.from_str(definition)
        # No piece holds white space, so words can be cut by lines at once.
        self.pieces = spelled_out(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special = [token["content"] for token in parts["added_tokens"]]
        bare = parts | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        # A vocabulary that marks ends of pieces tells pieces apart that are encoded as one text.
        self.end = parts["model"].get("end_of_word_suffix")
        vocabulary = self.whole.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[number for token, number in vocabulary.items() if self.end and token.endswith(self.end)]] = True
        self.letters = byte_letters()
        self.forget_words()
        self.forget_parts()

    def forget_words(self) -> None:
        self.words: dict[str, bytes] = {}
        self.word_bytes = 0

    def forget_parts(self) -> None:
        self.parts: dict[str, bytes] = {"\n": MARK}
        self.part_bytes = 0

    def rest(self) -> None:
        """At a task's end: an idle worker, of which there may be more than cores, keeps small tables only."""
        if self.word_bytes + self.part_bytes > KEPT_BYTES:
            self.forget_words()
            self.forget_parts()

    def ids(self, data: bytes) -> bytes:
        return b"".join(self._stretch([part])[0] for part in pieces(data, self.stretch))

    def each(self, texts: Iterator[tuple[object, bytes]]) -> Iterator[tuple[object, bytes]]:
        """Keys and ids of keys and texts, in the same order."""
        held, size = [], 0
        for key, data in texts:
            if len(data) < self.stretch:
                held.append((key, data))
                size += len(data) + TEXT
            if held and (size >= self.stretch or len(data) >= self.stretch):
                yield from self._held(held)
                held, size = [], 0
            if len(data) >= self.stretch:
                yield key, self.ids(data)
        if held:
            yield from self._held(held)

    def _held(self, held: list[tuple[object, bytes]]) -> Iterator[tuple[object, bytes]]:
        keys, texts = zip(*held, strict=True)
        return zip(keys, self._stretch(texts), strict=True)

    def _stretch(self, texts: tuple[bytes, ...] | list[bytes]) -> list[bytes]:
        rows = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        words = rows.flatten().dictionary_encode()
        found = self.learn(words.dictionary).take(words.indices)
        _, limits, data = found.buffers()
        limits = np.frombuffer(limits, np.int32)[rows.offsets.to_numpy()].tolist() if len(found) else [0] * (len(texts) + 1)
        data = memoryview(data or b"")
        return [bytes(data[start:end]) for start, end in zip(limits, limits[1:])]

    def learn(self, words: pa.StringArray) -> pa.BinaryArray:
        """Ids of distinct words."""
        text = _lines(words)
        if PLAIN_LINES.fullmatch(text) and not any(token in text for token in self.special):
            return pa.array(self.plain(text) if len(words) else [], pa.binary())
        plain = pc.match_substring_regex(words, f"^{PLAIN}$")
        for token in self.special:
            plain = pc.and_not(plain, pc.match_substring(words, token))
        others = words.filter(pc.invert(plain)).to_pylist()
        own = self.plain(_lines(words.filter(plain))) if len(others) < len(words) else []
        order = np.argsort(np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable"))
        return pa.array(own + self.others(others), pa.binary()).take(pa.array(order))

    def others(self, words: list[str]) -> list[bytes]:
        """Ids of words by the whole tokenizer, kept in a table."""
        found = []
        for word in words:
            ids = self.words.get(word)
            if ids is None:
                if self.word_bytes > self.LIMIT:
                    self.forget_words()
                self.words[word] = ids = _packed(self.whole.encode(word, add_special_tokens=False).ids)
                self.word_bytes += len(word.encode()) + len(ids) + self.ENTRY
            found.append(ids)
        return found

    def plain(self, text: str) -> list[bytes]:
        """Ids of the words of plain lines."""
        if self.part_bytes > self.PARTS:
            self.forget_parts()
        found = self.pieces.findall(unicodedata.normalize("NFC", text).lower())
        self.spell([part for part in dict.fromkeys(found) if part not in self.parts])
        return b"".join(map(self.parts.__getitem__, found)).split(MARK)

    def spell(self, new: list[str]) -> None:
        """Ids of pieces not seen before, many at a time."""
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            packed, ends = self.encoded([part if part.isascii() else part.encode().decode("latin-1").translate(self.letters) for part in some])
            start = 0
            for part, end in zip(some, ends.tolist(), strict=True):
                self.parts[part] = packed[start:end]
                start = end
            self.part_bytes += sum(map(len, some)) + len(packed) + self.ENTRY * len(some)

    def encoded(self, spelled: list[str]) -> tuple[bytes, np.ndarray]:
        """Packed ids of all pieces, and where each piece's end: as one text where its ends show, else piece by piece."""
        text = " ".join(spelled)
        if self.end and self.end not in text:
            [found] = self.bare.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(self.last[ids])
            if len(ends) == len(spelled):
                return ids.tobytes(), 4 * ends + 4
        found = [one.ids for one in self.bare.encode_batch_fast(spelled, add_special_tokens=False)]
        return _packed([*chain.from_iterable(found)]), 4 * np.cumsum([len(ids) for ids in found])


#: Stands between words among their ids; these are below 2**24, so every four bytes of them hold a zero.
MARK = b"\xff" * 4


def _lines(words: pa.StringArray) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py()


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


_READY: dict[tuple[int, int], WordBpe] = {}


def word_bpe(definition: str, table_bytes: int = TABLE_BYTES) -> WordBpe:
    """The encoder of a definition; a worker process keeps it, with its words, from task to task."""
    key = hash(definition), table_bytes
    if key not in _READY:
        _READY.clear()
        _READY[key] = WordBpe(definition, table_bytes)
    return _READY[key]
