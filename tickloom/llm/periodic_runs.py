"""Periodic runs of words, found by recompression: exact extensions by a run-length grammar."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import mixed, prepare, slices, text_bytes, word_hashes

#: Texts that are searched together, and pieces of a text that are hashed together, in bytes.
GROUP_BYTES, PIECE_BYTES = 1 << 20, 1 << 20
#: Extensions that are asked for at once.
ASKED = 1 << 18
#: Sequences this short are compared symbol by symbol.
SHORT = 8
BREAK = re.compile(rb"[\x20\x09-\x0D]")


class Level:
    """A sequence of the grammar, and how the symbols of the next one are made of it."""

    def __init__(self, symbols: np.ndarray, number: int) -> None:
        self.symbols, self.blocks = symbols, number % 2 == 0
        if self.blocks:
            self.first = np.append(True, symbols[1:] != symbols[:-1])
        else:
            # Other classes at each level, so that what finds no partner here does later.
            right = mixed(symbols.astype(np.uint64) + (np.uint64(number) << np.uint64(40))) & np.uint64(1) == 1
            self.first = np.append(True, ~(right[1:] & ~right[:-1]))
        #: Where each symbol of the next sequence begins, and the symbol of the next one that each is in.
        self.starts = np.flatnonzero(self.first)
        self.parent = np.cumsum(self.first) - 1
        self.ends = np.append(self.starts[1:], len(symbols))

    def above(self) -> np.ndarray:
        """The next sequence: a number for each (symbol, times) of a block, or each pair."""
        size = self.ends - self.starts
        last = size if self.blocks else np.where(size == 2, self.symbols[self.ends - 1] + 1, 0)
        pairs = self.symbols[self.starts].astype(np.uint64) << np.uint64(32) | last.astype(np.uint64)
        return np.unique(pairs, return_inverse=True)[1].astype(np.int64)

    def steps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far equal symbols at two places may be passed at once."""
        if not self.blocks:
            return np.ones(len(a), np.int64)
        return np.minimum(self.ends[self.parent[a]] - a, self.ends[self.parent[b]] - b)


class Grammar:
    """Run-length grammar of a sequence, by recompression: blocks of equal symbols, then pairs, until little is left.

    Symbols are classed left or right by a hash, and each left one followed by a
    right one becomes a pair, so what a stretch becomes depends on the stretch
    alone, but for a symbol at each end. Every stretch of documents ends with a
    symbol of its own.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        symbols = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
        self.levels = []
        while len(symbols) > SHORT:
            self.levels.append(Level(symbols, len(self.levels)))
            symbols = self.levels[-1].above()
        self.top = symbols

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The length of the longest common extension from each ``i`` and ``j`` (different places) to the right."""
        a, b = i.copy(), j.copy()
        climbing = np.arange(len(i))
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for level in self.levels:
            # Both at the start of a symbol of the next sequence: go up. Otherwise pass the rest of a block or pair.
            x, y = a[climbing], b[climbing]
            apart = ~(level.first[x] & level.first[y])
            same = level.symbols[x] == level.symbols[y]
            step = np.where(apart & same, level.steps(x, y), 0)
            x, y = x + step, y + step
            stop = (apart & ~same) | ~(level.first[x] & level.first[y])
            waiting.append((climbing[stop], x[stop], y[stop]))
            climbing, x, y = climbing[~stop], x[~stop], y[~stop]
            a[climbing], b[climbing] = level.parent[x], level.parent[y]
        self._pass_equal(self.top, a, b, climbing, None)
        for level, (back, x, y) in zip(reversed(self.levels), reversed(waiting), strict=True):
            a[climbing], b[climbing] = level.starts[a[climbing]], level.starts[b[climbing]]
            a[back], b[back] = x, y
            climbing = np.concatenate([climbing, back])
            self._pass_equal(level.symbols, a, b, climbing, level)
        return a - i

    @staticmethod
    def _pass_equal(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, which: np.ndarray, level: Level | None) -> None:
        while len(which):
            which = which[symbols[a[which]] == symbols[b[which]]]
            step = level.steps(a[which], b[which]) if level else 1
            a[which] += step
            b[which] += step


def candidates(words: np.ndarray, ends: np.ndarray, lengths: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): for each period q, the multiples of q from which ``times`` words q apart are equal.

    Documents come longest first, each closed by a symbol of its own. A run of
    ``times`` periods holds that many multiples of q, wherever it begins, so none is
    missed. The grids of all periods together are a harmonic series.
    """
    places, periods = [], []
    for period in range(1, int(lengths[0]) // times + 1 if len(lengths) else 0):
        count = int(np.searchsorted(-lengths, -max(least, times * period), "right"))
        if not count:
            break
        grid = words[: ends[count - 1] : period]
        equal = grid[1:] == grid[:-1]
        reach = len(equal) - times + 2
        if reach <= 0:
            continue
        chain = equal[:reach]
        for shift in range(1, times - 1):
            chain = chain & equal[shift : shift + reach]
        hits = np.flatnonzero(chain)
        if len(hits):
            places.append(hits * period)
            periods.append(np.full(len(hits), period))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *periods])


def runs_of(words: list[np.ndarray], times: int = 4, least: int = 6) -> list[np.ndarray]:
    """Runs of each sequence of word hashes, as rows (start, length, period) by start, then period."""
    order = sorted(range(len(words)), key=lambda at: -len(words[at]))
    lengths = np.array([len(words[at]) for at in order], np.int64)
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    close = mixed(np.arange(1, len(order) + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    text = np.concatenate([np.zeros(0, np.uint64), *(part for at, end in zip(order, close, strict=True) for part in (words[at], np.array([end])))])
    place, period = candidates(text, ends, lengths, times, least)
    # A grid goes on over the end of a document, a run does not.
    doc = np.searchsorted(ends, place, "right")
    whole = doc == np.searchsorted(ends, place + (times - 1) * period, "right")
    place, period, doc = place[whole], period[whole], doc[whole]
    found = [np.zeros((0, 3), np.int64) for _ in words]
    if not len(place):
        return found
    # The grammars hold the documents with a candidate only.
    held = np.unique(doc)
    moved = np.cumsum(lengths[held] + 1) - lengths[held] - 1
    own = np.concatenate([text[starts[at] : ends[at]] for at in held.tolist()])
    # A symbol before all others, which is the last one when read from the right.
    own = np.append(mixed(np.array([0x2545F491], np.uint64)), own)
    slot = np.searchsorted(held, doc)
    i = place - starts[doc] + moved[slot] + 1
    j = i + period
    forward, backward, size = Grammar(own), Grammar(own[::-1]), len(own)
    parts = range(0, len(i), ASKED)
    right = np.concatenate([forward.common(i[at : at + ASKED], j[at : at + ASKED]) for at in parts])
    left = np.concatenate([backward.common(size - j[at : at + ASKED], size - i[at : at + ASKED]) for at in parts])
    length = left + period + right
    good = length >= np.maximum(least, times * period)
    rows = np.stack([doc, i - left - 1 - moved[slot], length, period], axis=1)[good]
    # One stretch is found with each multiple of its period: the smallest is its period.
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))] if len(rows) else rows
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    for number in np.unique(rows[:, 0]).tolist():
        found[order[number]] = rows[rows[:, 0] == number][:, 1:]
    return found


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return [word for word, inside in zip(words, np.cumsum(marks[:-1]).tolist(), strict=True) if not inside]


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text cut at white space into pieces of about so many bytes."""
    at = 0
    while len(text) - at > size:
        found = BREAK.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def hashed_words(texts: list[bytes]) -> list[np.ndarray]:
    found = []
    for part in slices(texts, PIECE_BYTES):
        if len(part) == 1:
            found.append(np.concatenate([word_hashes([piece])[0] for piece in pieces(part[0])]))
        else:
            words, counts = word_hashes(part)
            found.extend(np.split(words, np.cumsum(counts)[:-1]))
    return found


RUNS = "id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _find(times: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices([text_bytes(text) for text in batch.column(1)], GROUP_BYTES):
                runs = runs_of(hashed_words(texts), times, least)
                counts, kept = [], []
                for text, found in zip(texts, runs, strict=True):
                    words = text.split()
                    counts.append(len(words))
                    kept.append(b" ".join(collapsed(words, found) if len(found) else words))
                flat = np.concatenate(runs)
                offsets = np.append(0, np.cumsum([len(found) for found in runs]))
                listed = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), listed),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])
                at += len(texts)

    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 4, least: int = 6) -> DataFrame:
    """Periodic runs of words: (id, n_words, runs of (start, length, period), collapsed), a row per input row.

    Words are runs without white space, of whole texts, numbered from 0. A run
    is a stretch whose words are equal to those its smallest period q further,
    of at least ``times`` * q (``times`` 2 or more) and ``least`` words, which neither
    neighbour extends. ``collapsed`` has the words, joined by single spaces, that no run
    holds after its first q words.

    Candidates are the multiples of each q at which a chain of words q apart is
    equal. Their exact extensions to both sides are asked of run-length grammars of
    the texts and of their reversals, which recompression makes: blocks of
    equal symbols and pairs of symbols are replaced in turn. A query climbs the
    levels while both places are at a symbol's start, and comes down where they
    differ. There is no shuffle: texts of about 1 MB are searched together,
    a longer one by itself, with memory in proportion to its words (and to
    words times their logarithm where all of it is periodic).

    Words are told apart by 64-bit hashes. Null and empty texts have no words
    and no runs. Ids are long or null and any may repeat: rows are judged by
    themselves. Other columns are ignored; no rows give no rows.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(_find(times, least), RUNS).withColumnRenamed("id", id_col)


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text_bytes(value)
            seed = zlib.crc32(str(key).encode()) if key is not None else 1
            if seed % 10 == 0 and (words := text.split()):
                g, n = seed // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                unit = words[a : a + p]
                text = b" ".join(words[:a] + (unit * (-(-(n - a) // p)))[: n - a])
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"])


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where a hash of the id makes the tail of about a tenth of the texts periodic; none with a null id."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(_tails, "doc_id long, text binary")
