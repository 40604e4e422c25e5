"""Personal data: patterns, and spans that weakly supervised labelers add to them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import frugal, prepare, text_bytes

#: Order of kinds where spans start together; the first four have a base pattern.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
#: An e-mail address with its signs spelled out, a candidate only.
SPELLED_EMAIL = re.compile(r"\b[A-Za-z0-9._%+-]+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]+(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]+)+")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

#: Wider patterns, whose matches are candidates only: (kind, text that must occur, pattern).
WIDER = (
    ("phone", "", re.compile(r"(?<![0-9+.])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("secret", "AKIA", re.compile(r"\bAKIA[0-9A-Z]{16}\b")),
    ("secret", "password", re.compile(r"\bpassword ?[=:] ?[^\s\"'<>]{6,}")),
    ("secret", "api_key", re.compile(r"\bapi_key ?[=:] ?[^\s\"'<>]{6,}")),
)

#: Gazetteers: top-level names, first digits of card issuers, telephone country codes, prefixes of secrets.
TOP_NAMES = frozenset("com org net edu gov info biz io co de fr es uk eu us ca ch at be nl it pt pl se".split())
ISSUERS = frozenset("3456")
COUNTRY_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
                 "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "7", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")
SECRET_PREFIXES = ("AKIA", "password", "api_key")

#: Words just before a span that speak for its kind, and words that speak against any kind.
CONTEXT = {
    "email": frozenset("email e-mail mail contact write to von de".split()),
    "ip": frozenset("ip address host server from at".split()),
    "card": frozenset("card credit visa mastercard payment pay".split()),
    "phone": frozenset("phone tel telephone call mobile fax contact".split()),
    "secret": frozenset("key secret token login access credentials".split()),
}
AGAINST = frozenset("version license release isbn page figure section no. chapter copyright".split())
VOTES = 5
ABSTAIN = 2


#: What the searches below look for: runs of characters, each passed once.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
SPELLED = re.compile(r" ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]+(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]+)+")
EDGE = re.compile(r"\b")


def emails(text: str, rest: re.Pattern = DOMAIN, sign: str = "@", edge: bool = False) -> Iterator[tuple[int, int]]:
    """The matches of EMAIL (or of its spelled form), in time linear in the text.

    A match takes the characters of a name up to the sign, as many as the last
    match left; where the rest fails, it fails for every shorter name too.
    """
    last = 0
    for run in LOCAL.finditer(text):
        stop = run.end()
        if sign and text[stop : stop + 1] != sign:
            continue
        start = max(run.start(), last)
        if edge:
            found = EDGE.search(text, start, stop)
            start = found.start() if found else stop
        match = rest.match(text, stop + len(sign)) if start < stop else None
        if match:
            last = match.end()
            yield start, last


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """The matches of IP: four numbers after four of each dotted row, in linear time."""
    for row in DOTTED.finditer(text):
        ends, at = [], row.start()
        for number in row.group().split("."):
            ends.append((at, at + len(number)))
            at += len(number) + 1
        for first in range(0, len(ends) - 3, 4):
            yield ends[first][0], ends[first + 3][1]


def base_matches(number: int, text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the leftmost matches of a kind's base pattern that don't overlap."""
    if number < 2:
        return emails(text) if number == 0 else addresses(text)
    return (match.span() for match in (CARD, PHONE)[number - 2].finditer(text))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def valid(kind: str, text: str) -> bool:
    """What a match of the base pattern must also satisfy."""
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))
    if kind == "card":
        digits = digits_of(text)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits_of(text)) <= 15
    return True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of valid base matches in order; texts without the needed characters are not searched."""
    return sorted((start, number, end) for start, number, end, sound in _base_candidates(text) if sound)


def _base_candidates(text: str) -> Iterator[tuple[int, int, int, bool]]:
    digits = DIGIT.search(text) is not None
    for number in range(len(BASE_KINDS)):
        if (number == 0 and "@" not in text) or (number and not digits) or (number == 3 and "+" not in text):
            continue
        for start, end in base_matches(number, text):
            yield start, number, end, valid(KINDS[number], text[start:end])


def candidates(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, kind number, end, base) of base matches, of base matches that fail their check, and of wider ones."""
    for start, number, end, sound in _base_candidates(text):
        # Short digit runs are no cards in any reading.
        if sound or (number != 2 or end - start >= 12):
            yield start, number, end, sound
    if any(sign in text for sign in ("(at)", "[at]", "(AT)", "[AT]")):
        for start, end in emails(text, SPELLED, "", edge=True):
            yield start, 0, end, False
    digits = DIGIT.search(text) is not None
    for kind, needed, pattern in WIDER:
        if (needed and needed in text) or (kind == "phone" and digits):
            for match in pattern.finditer(text):
                yield match.start(), KINDS.index(kind), match.end(), False


def votes(text: str, start: int, number: int, end: int, base: bool) -> tuple[int, ...]:
    """Votes of the labelers on a span: 1 personal, 0 not, 2 no opinion."""
    kind, span = KINDS[number], text[start:end]
    digits = digits_of(span)
    # Regular expression: the strict form, or a form of its own for kinds without one.
    strict = 1 if base or kind == "secret" else 0 if kind in ("card", "ip") else ABSTAIN
    # Format: a check beyond the pattern.
    if kind == "email":
        shape = int(len(span) <= 254 and ".." not in span)
    elif kind == "secret":
        shape = int(len(set(span)) >= 8)
    else:
        shape = int(valid(kind, span))
    # Gazetteer.
    if kind == "email":
        named = 1 if re.split(r"[.\])]", span)[-1].strip().lower() in TOP_NAMES else ABSTAIN
    elif kind == "card":
        named = int(digits[0] in ISSUERS)
    elif kind == "phone":
        named = 1 if span.startswith("+") and digits.startswith(COUNTRY_CODES) else ABSTAIN
    elif kind == "ip":
        named = 0 if digits_of(span.split(".")[0]) in ("0", "127") else ABSTAIN
    else:
        named = int(span.startswith(SECRET_PREFIXES))
    # Context: the three words before.
    before = set(text[max(0, start - 40) : start].lower().replace(":", " ").split()[-3:])
    context = 0 if before & AGAINST else 1 if before & CONTEXT[kind] else ABSTAIN
    # Neighbours: a span inside a longer word or number is seldom one.
    joined = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    return strict, shape, named, context, 0 if joined else ABSTAIN


def pattern_of(text: str, start: int, number: int, end: int, base: bool) -> tuple[int, ...]:
    """Kind, votes, and the length's class: all that the models see of a span, so counts of these are all they need."""
    return number, *votes(text, start, number, end, base), min((end - start) // 8, 5)


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each vote pattern, and each labeler's accuracies, by expectation-maximisation.

    A labeler has its own rates on personal and other spans; the share of
    personal spans is estimated by kind. It starts from the majority of
    votes. Light prior counts keep rates off 0 and 1.
    """
    given = patterns[:, 1 : 1 + VOTES]
    yes, no = (given == 1).sum(1), (given == 0).sum(1)
    posterior = (yes + 1) / (yes + no + 2)
    kinds = patterns[:, 0]
    rates = np.zeros((VOTES, 2, 3))
    for _ in range(rounds):
        for truth, weight in ((1, counts * posterior), (0, counts * (1 - posterior))):
            for labeler in range(VOTES):
                seen = np.bincount(given[:, labeler], weight, 3)
                # A labeler is taken to be better than chance.
                prior = np.array([2.0, 1.0, 1.0]) if truth == 0 else np.array([1.0, 2.0, 1.0])
                rates[labeler, truth] = (seen + prior) / (seen + prior).sum()
        share = np.array([(counts[kinds == kind] @ posterior[kinds == kind] + 1) / (counts[kinds == kind].sum() + 2) for kind in range(len(KINDS))])
        odds = np.log(share / (1 - share))[kinds]
        for labeler in range(VOTES):
            odds += np.log(rates[labeler, 1, given[:, labeler]] / rates[labeler, 0, given[:, labeler]])
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return posterior, rates


def encoded(patterns: np.ndarray) -> np.ndarray:
    """Indicators of kind, of each labeler's vote and of the length's class, and a constant."""
    columns = [patterns[:, 0:1] == np.arange(len(KINDS))]
    columns += [patterns[:, 1 + labeler : 2 + labeler] == np.arange(3) for labeler in range(VOTES)]
    columns += [patterns[:, -1:] == np.arange(6), np.ones((len(patterns), 1), bool)]
    return np.concatenate(columns, 1).astype(float)


@dataclass(frozen=True)
class SpanModel:
    """Weights of the span classifier, and the labelers' estimated rates (labeler, truth, vote)."""

    weights: np.ndarray
    rates: np.ndarray

    def score(self, pattern: tuple[int, ...]) -> float:
        return float(1 / (1 + np.exp(-np.clip(encoded(np.array([pattern])) @ self.weights, -50, 50)))[0])


def fit(found: dict[tuple[int, ...], int], rounds: int = 30, ridge: float = 1.0) -> SpanModel:
    """Classifier trained on the posteriors of all spans, by Newton steps with a ridge."""
    width = len(KINDS) + 3 * VOTES + 7
    if not found:
        return SpanModel(np.zeros(width), np.full((VOTES, 2, 3), 1 / 3))
    keys = sorted(found)
    patterns, counts = np.array(keys), np.array([found[key] for key in keys], float)
    posterior, rates = reliabilities(patterns, counts)
    design, weights = encoded(patterns), np.zeros(width)
    # Shares, so that the ridge means the same for any number of spans.
    counts = counts / counts.sum() * 1000
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        slope = (design * (counts * p * (1 - p))[:, None]).T @ design + ridge * np.eye(width)
        weights = weights - np.linalg.solve(slope, design.T @ (counts * (p - posterior)) + ridge * weights)
    return SpanModel(weights, rates)


def train(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """Span model from the candidates of all documents.

    Tasks count patterns, of which there are a fixed number, so a bounded
    table reaches the driver whatever the input.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                text = text_bytes(value).decode()
                found.update(pattern_of(text, *span) for span in candidates(text))
        yield pa.RecordBatch.from_arrays([pa.array([list(key) for key in found], pa.list_(pa.int32())), pa.array(list(found.values()), pa.int64())], names=["pattern", "count"])

    total = rows.mapInArrow(frugal(count), "pattern array<int>, count long").groupBy("pattern").agg(F.sum("count").alias("count"))
    return fit({tuple(row.pattern): row["count"] for row in total.collect()})


def spans_of(text: str, model: SpanModel, known: dict, threshold: float) -> list[tuple[int, int, int, bool, float]]:
    """(start, kind number, end, base, score) in order: all base spans, and added ones that overlap none kept before."""
    kept = [(start, number, end, True, 1.0) for start, number, end in base_spans(text)]
    added = []
    for span in candidates(text):
        if span[3]:
            continue
        pattern = pattern_of(text, *span)
        if pattern not in known:
            known[pattern] = model.score(pattern)
        if known[pattern] >= threshold:
            added.append((-known[pattern], *span[:3]))
    for score, start, number, end in sorted(added):
        if all(end <= other[0] or other[2] <= start for other in kept):
            kept.append((start, number, end, False, -score))
    return sorted(kept)


SPAN = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>"


def find(docs: DataFrame, model: SpanModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """(id, spans) for every row: the personal data of the whole text, in code points, end exclusive.

    Spans of the four base patterns always stay. A span of a wider pattern,
    or a base match that failed its check, is added when the classifier gives
    it ``threshold`` or more and it overlaps no span already kept; the best
    come first. Null text is empty text and has none; repeated rows are read
    each for itself; a null id stays null; other columns are ignored; no rows
    give no rows. Nothing is shuffled.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    prepare(docs.sparkSession)
    holder = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            found = [[{"kind": KINDS[number], "start": start, "end": end, "base": base, "score": score}
                      for start, number, end, base, score in spans_of(text_bytes(value).decode(), holder.value, known, threshold)]
                     for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["id", "spans"])

    schema = T.StructType([rows.schema["id"], T.StructField("spans", T._parse_datatype_string(SPAN))])
    return rows.mapInArrow(frugal(run), schema).withColumnRenamed("id", id_col)


def mask(docs: DataFrame, model: SpanModel, text_col: str = "text", threshold: float = 0.6) -> DataFrame:
    """All columns of ``docs``, with each span of the text replaced by its kind in brackets; overlapping spans are replaced as one.

    A null text stays null.
    """
    prepare(docs.sparkSession)
    holder = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            texts = []
            for text in batch.column(place).to_pylist():
                found = [] if text is None else spans_of(text, holder.value, known, threshold)
                if found:
                    parts, at = [], 0
                    for start, number, end, _, _ in found:
                        if start >= at:
                            parts += [text[at:start], f"[{KINDS[number].upper()}]"]
                        at = max(at, end)
                    text = "".join([*parts, text[at:]])
                texts.append(text)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(frugal(run), docs.schema)
