"""Token counts per section of a document, from one encoding of the whole document."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import prepare, text_bytes

RULES = ("start", "end", "largest")
OUTSIDE = -1


class Offsets:
    """Whole-text byte-level encoding with the character span of every token."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.width = np.zeros(max(table.values(), default=0) + 1, np.int64)
        for token, rank in table.items():
            self.width[rank] = len(token)

    def spans(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Character spans; a token that ends inside a character counts that character too."""
        ids = np.array(self.encoding.encode_ordinary(data.decode()), np.int64)
        end = np.cumsum(self.width[ids])
        start = end - self.width[ids]
        character = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
        return character[start], character[end - 1] + 1


_READY: dict[int, Offsets] = {}


def offsets_of(ranks: bytes, pattern: str) -> Offsets:
    """A worker process keeps its encoder from task to task."""
    key = hash((ranks, pattern))
    if key not in _READY:
        _READY.clear()
        _READY[key] = Offsets(ranks, pattern)
    return _READY[key]


def line_sections(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of the lines, each with its line break; an empty text has one empty line."""
    raw = np.frombuffer(data, np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80)
    ends = character[np.flatnonzero(raw == 0x0A)]
    total = int(character[-1]) if len(raw) else 0
    if not len(ends) or ends[-1] < total:
        ends = np.append(ends, total)
    return np.append(0, ends[:-1]), ends


def attribute(start: np.ndarray, end: np.ndarray, left: np.ndarray, right: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Interval join of token spans with disjoint ascending sections: (section of each token or OUTSIDE, whether it crosses).

    Both ends of a token are looked up in the sorted section starts. A token
    crosses when its first and last character are not in the same section.
    """
    first = _holding(start, left, right)
    last = _holding(end - 1, left, right)
    crossing = first != last
    if rule == "start":
        return first, crossing
    if rule == "end":
        return last, crossing
    chosen = first.copy()
    for token in np.flatnonzero(crossing):
        low = max(int(np.searchsorted(right, start[token], "right")), 0)
        high = int(np.searchsorted(left, end[token], "left"))
        shared = np.minimum(right[low:high], end[token]) - np.maximum(left[low:high], start[token])
        chosen[token] = low + int(shared.argmax()) if len(shared) and shared.max() > 0 else OUTSIDE
    return chosen, crossing


def _holding(place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    if not len(left):
        return np.full(len(place), OUTSIDE)
    found = np.searchsorted(left, place, "right") - 1
    # Empty sections share their start with the next one; the search ends on the last of them, which holds the character.
    return np.where((found >= 0) & (place < right[np.maximum(found, 0)]), found, OUTSIDE)


def count_tokens(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 sections_col: str | None = None, rule: str = "start") -> DataFrame:
    """Tokens of every section of every document: (id, section, name, start, end, n_tokens, n_crossing).

    Each text is encoded once as a whole; token spans are then joined to the
    sections by interval. ``sections_col`` holds an array of structs (name,
    start, end) in characters, end exclusive; without it the sections are the
    lines. Sections are taken in order of their start; one that overlaps an
    earlier section begins where that one ends. A token goes to exactly one
    section: that of its first character (``start``), of its last (``end``),
    or the one holding most of it, the earlier of equals (``largest``).
    Tokens in no section are counted in section -1, present only when there
    are some. ``n_crossing`` counts the allocated tokens that lie partly
    elsewhere.

    Null text is empty text, which has one empty line and no tokens; null
    sections are none, a section with a null bound is left out; a null id
    stays null; repeated rows are counted each for itself; other columns are
    ignored. Everything happens in the task that reads the row: no shuffle,
    and memory is one document at a time.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    prepare(docs.sparkSession)
    sections = (F.col(sections_col) if sections_col else F.lit(None)).cast("array<struct<name:string,start:bigint,end:bigint>>")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), sections.alias("sections"))
    holder = docs.sparkSession.sparkContext.broadcast(ranks)
    by_line = sections_col is None
    fields = ("section", "start", "end", "n_tokens", "n_crossing")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or offsets_of(holder.value, pattern)
            key, texts, given = batch.columns
            took, names, found = [], [], {name: [] for name in fields}
            for row in range(batch.num_rows):
                data = text_bytes(texts[row])
                start, end = encoder.spans(data) if data else (np.zeros(0, np.int64),) * 2
                if by_line:
                    left, right = line_sections(data)
                    label = [None] * len(left)
                else:
                    left, right, label = _ordered(given[row].as_py())
                where, crossing = attribute(start, end, left, right, rule)
                tokens = np.bincount(where + 1, minlength=len(left) + 1)
                crossed = np.bincount(where[crossing] + 1, minlength=len(left) + 1)
                outside = int(tokens[0] > 0)
                for name, inside, out in (("section", np.arange(len(left)), OUTSIDE), ("start", left, 0), ("end", right, 0),
                                          ("n_tokens", tokens[1:], tokens[0]), ("n_crossing", crossed[1:], crossed[0])):
                    found[name].append(np.append(inside, out) if outside else inside)
                names += label + [None] * outside
                took.append(np.full(len(left) + outside, row))
            yield pa.RecordBatch.from_arrays(
                [key.take(pa.array(np.concatenate(took))), pa.array(names, pa.string()),
                 *(pa.array(np.concatenate(found[name]).astype(np.int64)) for name in fields)],
                names=["id", "name", *fields]) if took else _empty(key.type, fields)

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("name", T.StringType()),
                           *(T.StructField(name, T.LongType()) for name in fields)])
    return rows.mapInArrow(run, schema).select(F.col("id").alias(id_col), "section", "name", "start", "end", "n_tokens", "n_crossing")


def _ordered(sections: list[dict] | None) -> tuple[np.ndarray, np.ndarray, list[str | None]]:
    left, right, names, reached = [], [], [], 0
    known = [s for s in sections or () if s and s["start"] is not None and s["end"] is not None]
    for section in sorted(known, key=lambda s: (s["start"], s["end"])):
        start = max(section["start"], reached)
        reached = max(section["end"], start)
        left.append(start)
        right.append(reached)
        names.append(section["name"])
    return np.array(left, np.int64), np.array(right, np.int64), names


def _empty(kind: pa.DataType, fields: tuple[str, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], kind), pa.array([], pa.string()), *(pa.array([], pa.int64()) for _ in fields)],
                                      names=["id", "name", *fields])
