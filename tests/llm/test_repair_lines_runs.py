"""Conversation repair, line dedup and periodic runs against brute force, on small hard inputs."""

import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import chat_repair, line_dedup, periodic_runs, personal_data, queries

# --- conversation repair -------------------------------------------------------------


def cheapest(rows):
    """(cost, audit) by trying every edit."""
    best = []

    def go(at, cost, audit, roles):
        for more in ("", "u", "a", "ua", "au"):
            c, a, r = cost + 3 * len(more), audit + "I" * len(more), roles + more
            if at == len(rows):
                if re.fullmatch(r"(s?(ua)+)?", r):
                    best.append((c, a))
                continue
            initial, fault = rows[at]
            go(at + 1, c + 4, a + "D", r)
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                go(at + 1, c + extra, a + "K", r + initial)
                for role in "ua":
                    go(at + 1, c + 3 + extra, a + "R", r + role)

    go(0, 0, "", "")
    return min(best)


def price(rows, audit):
    cost, left = 0, iter(rows)
    for letter in audit:
        fault = next(left)[1] if letter != "I" else ""
        cost += {"K": 0, "R": 3, "D": 4, "I": 3}[letter] + (3 if fault == "truncated" and letter != "D" else 0)
    return cost


def test_repairs_are_cheapest():
    source = random.Random(3)
    for _ in range(150):
        rows = [(source.choice("suax"), source.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(source.randint(0, 4))]
        letters, tail = chat_repair.parse(rows)
        audit = "".join(letters) + tail
        assert (price(rows, audit), audit) == cheapest(rows)


def turns():
    source = random.Random(8)
    rows = []
    for conv in (1, 2, 3, None):
        for turn in range(40 if conv == 2 else 9):
            rows.append((conv, turn if source.random() < 0.9 else None, source.choice(["user", "assistant", "system", "tool", None, ""]),
                         source.choice(["One.", "two", None, "", " \t", "Three!  ", "é?"]) if source.random() < 0.7 else f"text {turn}."))
    return rows + rows[:5] + [(4, 0, "user", ""), (5, 1, "user", "A.\nB."), (5, 2, "assistant", "c?"), (6, 3, "user", "x" * 20_000 + ".")]


SCHEMA = "conv_id long, turn long, role string, text string"


def described(rows):
    """What the contract asks of one conversation's rows, by the plain definitions."""
    rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows))
    seen, faults = set(), []
    for _, _, role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    numbers = {turn for known, turn, _, _ in rows if known}
    initials = [role[:1] for _, _, role, _ in rows]
    letters, tail = chat_repair.parse(list(zip(initials, faults, strict=True)))
    lines, state, left = [], "", iter(rows)
    for letter in "".join(letters) + tail:
        if letter == "I":
            state = "a" if state == "u" else "u"
            lines.append(("user:", "assistant:")[state == "a"])
            continue
        _, _, role, text = next(left)
        if letter == "R":
            state = "a" if state == "u" else "u"
            lines.append(("user:", "assistant:")[state == "a"] + text)
        elif letter == "K":
            state = role[:1]
            lines.append(f"{role}:{text}")
    audit = "".join(letters) + tail
    count = collections.Counter(faults)
    return {"gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, "blank": count["blank"], "duplicate": count["duplicate"],
            "truncated": count["truncated"], "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            "cost": price(list(zip(initials, faults, strict=True)), audit), "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


@pytest.mark.parametrize("chunk_bytes", [1 << 25, 700])
def test_digests(spark, chunk_bytes):
    """A small chunk cuts the conversations into many parts; the result is the same."""
    rows = turns()
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"known": F.lit("clash"), "at": F.lit(1), "chunk": F.lit("x")}).repartition(3)
    got = {r.conv_id: r.asDict() for r in chat_repair.digests(frame, chunk_bytes=chunk_bytes, piece_bytes=50).collect()}
    groups = collections.defaultdict(list)
    for conv, *row in rows:
        groups[conv].append(row)
    assert len(got) == len(groups)
    for conv, group in groups.items():
        assert got[conv] == {"conv_id": conv, **described(group)}


@pytest.mark.parametrize("chunk_bytes", [1 << 25, 700])
def test_repair_log(spark, chunk_bytes):
    log = chat_repair.repair(spark.createDataFrame(turns(), SCHEMA), chunk_bytes).collect()
    edits = collections.defaultdict(list)
    for r in sorted(log, key=lambda r: (r.at, r.step)):
        edits[r.conv_id].append(r)
    for conv, rows in edits.items():
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r.role[:1] for r in rows if r.action != "D"))
        assert all(r.action == "D" for r in rows if r.fault in ("blank", "duplicate"))
    assert sum(r.action != "I" for r in log) == len(turns())


def test_digests_of_nothing(spark):
    frame = spark.createDataFrame([(1, 1, "user", "Hi."), (2, None, None, None)], SCHEMA)
    none = chat_repair.digests(frame, F.lit(0)).collect()
    assert {(r.conv_id, r.gaps, r.cost, r.audit, r.repaired_sha256) for r in none} == {(k, 0, 0, "", hashlib.sha256(b"").hexdigest()) for k in (1, 2)}
    assert chat_repair.digests(frame.limit(0)).count() == 0
    assert chat_repair.repair(frame.limit(0)).count() == 0


# --- line dedup ------------------------------------------------------------------------


def line_docs():
    source = random.Random(4)
    lines = ["Shared line number one", "  shared LINE number one\t", "short", "", "a line that is here only " + "x" * 50, "éééééééééé", "ééééé", "Exactly10!", "nine char"]
    rows = [(key, "\n".join(source.choice(lines) + (str(key) if source.random() < 0.2 else "") for _ in range(source.randint(1, 12)))) for key in range(40)]
    return rows + [(3, "Shared line number one\nown to the second row of three"), (3, None), (None, "Shared line number one"), (None, "a null row's line\n"), (90, ""), (91, None), (92, "\n\n"),
                   (93, "\n".join(f"long text line {i % 700}" for i in range(5000))), (94, "\n".join(f"long text line {i % 900}" for i in range(3000)))]


def kept_lines(rows):
    def key(line):
        found = re.sub(r"[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))
        return found if len(found) >= 10 else None

    holders = collections.defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if key(line) and doc is not None:
                holders[key(line)].add(doc)
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if doc is None or not key(line) or min(holders[key(line)]) == doc]
        found.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return collections.Counter(found)


@pytest.mark.parametrize("batch_bytes, shard_keys", [(1 << 24, 1 << 20), (300, 20)])
def test_lines(spark, batch_bytes, shard_keys):
    rows = line_docs()
    frame = spark.createDataFrame([(k, t, "c", 1, "d") for k, t in rows], "doc_id long, text string, id string, batch int, size string").repartition(3)
    got = line_dedup.drop_repeated_lines(frame, batch_bytes=batch_bytes, shard_keys=shard_keys).collect()
    assert collections.Counter(map(tuple, got)) == kept_lines(rows)
    assert line_dedup.drop_repeated_lines(frame.limit(0)).count() == 0


def test_perfect_hash():
    for n in (0, 1, 2, 5000):
        keys = line_dedup.pairs_of([xxhash.xxh3_128_digest(str(i).encode()) for i in range(n)])
        hashed = line_dedup.PerfectHash.load(*line_dedup.PerfectHash.build(keys).dump())
        assert sorted(hashed.number(keys).tolist()) == list(range(n))
        assert hashed.size == n


def test_index_keeps_strangers_out():
    """Keys that were not built in are told by their fingerprints."""
    keys = line_dedup.pairs_of([xxhash.xxh3_128_digest(str(i).encode()) for i in range(3000)])
    hashed = line_dedup.PerfectHash.build(keys[:1000])
    number = hashed.number(keys[:1000])
    marks, counts = np.zeros(1000, np.uint32), np.full(1000, 2, np.uint8)
    marks[number] = keys[:1000, 1].astype(np.uint32)
    shard = line_dedup.Shard(hashed, marks, counts, np.arange(1000))
    several, firsts = shard.probe(keys)
    assert several.tolist() == list(range(1000))
    assert firsts.tolist() == number.tolist()


# --- periodic runs ---------------------------------------------------------------------


def plain_runs(words, times=4, least=6):
    found = {}
    for period in range(1, len(words) // times + 1):
        at = 0
        while at + period < len(words):
            if words[at] != words[at + period]:
                at += 1
                continue
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at + period - start
            if length >= max(least, times * period):
                found.setdefault((start, length), period)
    return sorted((start, length, period) for (start, length), period in found.items())


def sequence(source):
    letters = source.randint(1, 4)
    words = [source.randint(1, letters) for _ in range(source.randint(0, 80))]
    if source.random() < 0.6:
        unit = [source.randint(1, letters) for _ in range(source.randint(1, 9))]
        at = source.randint(0, len(words))
        words[at:at] = (unit * source.randint(2, 9))[: source.randint(1, 60)]
    return words


def test_runs():
    source = random.Random(5)
    for _ in range(60):
        docs = [sequence(source) for _ in range(source.randint(1, 30))]
        for times, least in ((4, 6), (2, 2), (3, 5)):
            got = periodic_runs.runs_of([np.array(doc, np.uint64) for doc in docs], times, least)
            assert [[tuple(run) for run in runs.tolist()] for runs in got] == [plain_runs(doc, times, least) for doc in docs]


def test_runs_of_a_long_text():
    words = np.array([*range(100, 4000), *([1, 2, 3] * 3000), *range(5000, 9000), *([7] * 5000)], np.uint64)
    assert periodic_runs.runs_of([words])[0].tolist() == [[3900, 9000, 3], [16900, 5000, 1]]


def test_pieces_keep_words():
    text = b" ".join(b"w%d" % (i % 50) for i in range(5000)) + b"\n" + b"x" * 3000
    assert b" ".join(periodic_runs.pieces(text, 100)).split() == text.split()
    assert list(periodic_runs.pieces(b"", 10)) == [b""]


def run_docs():
    source = random.Random(6)
    rows = [(key, " ".join(f"w{word}" for word in sequence(source))) for key in range(60)]
    return rows + [(None, "a b " * 9), (3, "a b " * 9), (3, "a b " * 9), (70, None), (71, ""), (72, " \n"), (73, "x\ty\n" * 5000), (74, "é É é É é É é É é É")]


def test_runs_query(spark, monkeypatch):
    """All columns of the contract, by its plain definitions."""
    rows = run_docs()
    frame = spark.createDataFrame([(k, t, "c", "d", 1) for k, t in rows], "doc_id long, text string, id string, runs string, n_words int").repartition(3)
    monkeypatch.setattr(queries, "table", lambda *_: frame)
    wanted = collections.Counter()
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        seed = zlib.crc32(str(key).encode()) if key is not None else 1
        if seed % 10 == 0 and words:
            a = seed // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + seed // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
        runs = plain_runs(words)
        gone = {at for start, length, period in runs for at in range(start + period, start + length)}
        best = min(((-length, start, period) for start, length, period in runs), default=None)
        long = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
        kept = " ".join(word for at, word in enumerate(words) if at not in gone)
        wanted[key, len(runs), *long, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, queries.op13_periodic_runs(spark, "").collect())) == wanted
    assert periodic_runs.find_runs(frame.limit(0)).count() == 0


# --- patterns of personal data -----------------------------------------------------------


@pytest.mark.parametrize("letters", ["ab.@-_ 1", "12.3 .", "a1@.[(at)] dot(DOT)", "+1 2()-.9", "a@b.c_1 5"])
def test_linear_searches_find_what_the_patterns_find(letters):
    source = random.Random(letters)
    parts = [*letters, "@", "a.b", "[at]", "(dot)", " (AT) ", "1.2.3.4", "x"]
    for _ in range(1500):
        text = "".join(source.choice(parts) for _ in range(source.randint(0, 40)))
        for number, pattern in enumerate((personal_data.EMAIL, personal_data.IP, personal_data.CARD, personal_data.PHONE)):
            assert list(personal_data.base_matches(number, text)) == [m.span() for m in pattern.finditer(text)], text
        spelled = list(personal_data.emails(text, personal_data.SPELLED, "", edge=True))
        assert spelled == [m.span() for m in personal_data.SPELLED_EMAIL.finditer(text)], text


@pytest.mark.parametrize("text", ["1" * 1_000_000 + "@", "a" * 1_000_000 + "@ 1", "a-" * 500_000 + " (at) 1", "1." * 500_000, "+1" + "(" * 1_000_000, "a@" * 500_000])
def test_very_long_runs_take_little_time(text):
    began = time.perf_counter()
    list(personal_data.candidates(text))
    assert time.perf_counter() - began < 10
