"""Conversation structure repair: generalised LR parsing with weighted edits."""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import prepare, stored
from tickloom.operators.sizing import broadcast_if_small
from tickloom.session import checkpointed

SPACES = " \t\n\x0b\x0c\r"

# --- the role grammar ------------------------------------------------------------
#
# Talk -> nothing | Opening Body;  Opening -> nothing | s;  Body -> Pair | Body Pair;  Pair -> u a

SHIFT = {("start", "s"): "s", ("opening", "u"): "u", ("body", "u"): "u", ("u", "a"): "a"}
#: Reductions that are due whatever comes next: state -> (left side, length).
REDUCE = {"s": ("Opening", 1), "a": ("Pair", 2), "first": ("Body", 1), "next": ("Body", 2)}
#: Reductions of length 0, due before the given initial.
EMPTY = {("start", "u"): "Opening"}
GOTO = {("start", "Opening"): "opening", ("opening", "Pair"): "first", ("body", "Pair"): "next", ("opening", "Body"): "body"}

#: What can be on top of a stack between two rows, and a stack with it. ``u`` lies on an opening or on a body;
#: both reduce to a body after ``a``, so equal tops are one node.
STACKS = {"start": ("start",), "opening": ("start", "opening"), "u": ("start", "opening", "u"), "body": ("start", "opening", "body")}
TOPS = tuple(STACKS)
ACCEPTING = ("start", "body")
ROLES = {"u": "user", "a": "assistant"}

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: A top that costs so much more than another can't win: the other imitates it with two inserts and one delete.
BEHIND = 2 * INSERT + DELETE


@functools.cache
def shift(top: str, initial: str) -> str | None:
    """The top after a row with this initial; None if the grammar has no such row here."""
    stack = STACKS[top]
    if (top, initial) in EMPTY:
        stack += (GOTO[top, EMPTY[top, initial]],)
    state = SHIFT.get((stack[-1], initial))
    if state is None:
        return None
    stack += (state,)
    while stack[-1] in REDUCE:
        left, length = REDUCE[stack[-1]]
        stack = stack[:-length]
        stack += (GOTO[stack[-1], left],)
    return stack[-1]


@functools.cache
def inserted(top: str) -> tuple[tuple[str, str], ...]:
    """(letters, top) for no insert and for each useful number of them."""
    found, reached = [("", top)], {top}
    while True:
        letters, here = found[-1]
        after = next(there for role in ROLES if (there := shift(here, role)))
        if after in reached:
            return tuple(found)
        reached.add(after)
        found.append((letters + "I", after))


#: A frontier of the graph-structured stack: for each top the cost above the cheapest and the rank of its audit
#: among the tops, or None.
Frontier = tuple[tuple[int, int] | None, ...]


def entering(top: int) -> Frontier:
    return tuple((0, 0) if at == top else None for at in range(len(TOPS)))


@functools.cache
def advance(frontier: Frontier, initial: str, fault: str) -> tuple[Frontier, int, tuple[tuple[int, str] | None, ...]]:
    """The frontier after a row, the cost it adds, and each top's link back: (top before, letters).

    Of the ways to one top the least (cost, audit) stays. Letters end with the
    row's own, so no audit begins another one here, and ranks decide what
    whole audits would.
    """
    best: dict[str, tuple[int, int, str, int]] = {}
    for at, node in enumerate(frontier):
        if node is None:
            continue
        cost, rank = node
        for letters, top in inserted(TOPS[at]):
            so_far = cost + INSERT * len(letters)
            edits = [(DELETE, "D", top)]
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                edits += [(KEEP + extra, "K", shift(top, initial)), *((REROLE + extra, "R", shift(top, role)) for role in ROLES)]
            for price, letter, after in edits:
                if after:
                    way = so_far + price, rank, letters + letter, at
                    best[after] = min(best.get(after, way), way)
    least = min(way[0] for way in best.values())
    best = {top: way for top, way in best.items() if way[0] <= least + BEHIND}
    order = sorted(best, key=lambda top: best[top][1:3])
    nodes = tuple((best[top][0] - least, order.index(top)) if top in best else None for top in TOPS)
    return nodes, least, tuple((best[top][3], best[top][2]) if top in best else None for top in TOPS)


def accepted(frontier: Frontier) -> tuple[int, int, str]:
    """(cost, top, inserts) of the cheapest end."""
    ways = [(node[0] + INSERT * len(letters), node[1], letters, at) for at, node in enumerate(frontier) if node
            for letters, top in inserted(TOPS[at]) if top in ACCEPTING]
    cost, _, letters, at = min(ways)
    return cost, at, letters


def parse(rows: list[tuple[str, str]], entry: int = 0, leave: int | None = None) -> tuple[list[str], str]:
    """Each row's letters, and the inserts at the end, from one top to another (or to the end of the conversation)."""
    frontier, links = entering(entry), []
    for initial, fault in rows:
        frontier, _, back = advance(frontier, initial, fault)
        links.append(back)
    tail = ""
    if leave is None:
        _, leave, tail = accepted(frontier)
    letters = []
    for back in reversed(links):
        leave, own = back[leave]
        letters.append(own)
    return letters[::-1], tail


# --- rows in order, cut into chunks ------------------------------------------------

#: Bytes of a chunk; a conversation of any size is spread over chunks.
CHUNK_BYTES = 32 << 20


def ordered(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """Rows with their fault, in the order of conversations, kept in sorted chunks.

    Rows equal in everything are one with a number of ``copies``, so many of
    them don't meet in one chunk.
    """
    width = F.octet_length("role") + F.octet_length("text") + 64
    alike = rows.groupBy("known", "conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    alike = stored(alike.withColumns({"mark": F.md5("text"), "end": F.rtrim("text", F.lit(SPACES))}).withColumns(
        {"blank": F.col("end") == "", "truncated": ~F.substring("end", -1, 1).isin(".", "!", "?"), "bytes": width}).drop("end"), "turns")
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    again = alike.where("not blank").groupBy("known", "conv", "role", "mark").agg(F.min(order).alias("first"), F.count("*").alias("turns")).where("turns > 1").drop("turns")
    again = broadcast_if_small(stored(again, "again"))
    seen = alike.join(again, ["known", "conv", "role", "mark"], "left")
    fault = F.when(F.col("blank"), "blank").when(order > F.col("first"), "duplicate").when(F.col("truncated"), "truncated").otherwise("")
    total = alike.agg(F.sum("bytes")).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    place = ["known", "conv", F.col("turn").asc_nulls_first(), "role", "text"]
    cut = seen.select("known", "conv", "turn", "role", "text", "copies", F.substring("role", 1, 1).alias("initial"), fault.alias("fault")) \
        .repartitionByRange(chunks, *place).sortWithinPartitions(*place).withColumn("at", F.monotonically_increasing_id())
    return checkpointed(cut.withColumn("chunk", F.spark_partition_id()))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[dict]]]:
    """The conversations of a chunk: their first row, and all rows."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, run in itertools.groupby(rows, key=lambda row: (row["known"], row["conv"])):
        first = next(run)
        yield first, itertools.chain([first], run)


def _faults(row: dict) -> Iterator[str]:
    """The fault of each copy of a row: after the first one they are duplicates."""
    yield row["fault"]
    for _ in range(row["copies"] - 1):
        yield "blank" if row["fault"] == "blank" else "duplicate"


SUMMARY = "known boolean, conv long, chunk int, first string, last string, costs array<int>, ranks array<int>"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each part of a conversation: costs and audit ranks from each top to each top."""
    schema = pa.schema([("known", pa.bool_()), ("conv", pa.int64()), ("chunk", pa.int32()), ("first", pa.string()), ("last", pa.string()),
                        ("costs", pa.list_(pa.int32())), ("ranks", pa.list_(pa.int32()))])
    for head, rows in _runs(batches):
        frontiers, totals, last = [entering(top) for top in range(len(TOPS))], [0] * len(TOPS), None
        for row in rows:
            last = row["initial"]
            for fault in _faults(row):
                for top, frontier in enumerate(frontiers):
                    frontiers[top], added, _ = advance(frontier, row["initial"], fault)
                    totals[top] += added
        costs = [node and total + node[0] for total, frontier in zip(totals, frontiers, strict=True) for node in frontier]
        ranks = [node and node[1] for frontier in frontiers for node in frontier]
        yield pa.RecordBatch.from_pylist([{"known": head["known"], "conv": head["conv"], "chunk": head["chunk"], "first": head["initial"], "last": last,
                                           "costs": costs, "ranks": ranks}], schema)


def _stitch(parts):
    """The top before and after each part of a conversation on its cheapest way, and the initial before it."""
    import pandas as pd

    parts = parts.sort_values("chunk")
    size = len(TOPS)
    nodes, links = {0: (0, 0)}, []
    for costs, ranks in zip(parts["costs"], parts["ranks"], strict=True):
        best = {}
        for at, (cost, rank) in nodes.items():
            for top in range(size):
                own = costs[at * size + top]
                if own is not None and own == own:
                    way = cost + int(own), rank, int(ranks[at * size + top]), at
                    best[top] = min(best.get(top, way), way)
        order = sorted(best, key=lambda top: best[top][1:3])
        nodes = {top: (best[top][0], order.index(top)) for top in best}
        links.append({top: best[top][3] for top in best})
    _, top, _ = accepted(tuple(nodes.get(at) for at in range(size)))
    entries, leaves = [], []
    for number, back in enumerate(reversed(links)):
        # The last part ends the conversation: its inserts are found there.
        leaves.append(-1 if number == 0 else top)
        top = back[top]
        entries.append(top)
    return pd.DataFrame({"known": parts["known"], "conv": parts["conv"], "chunk": parts["chunk"], "entry": entries[::-1], "leave": leaves[::-1],
                         "before": [None, *parts["last"].tolist()[:-1]]})


def _edited(rows: DataFrame, chunk_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(rows in order with the tops that bound their part, the same without these)."""
    cut = ordered(rows, chunk_bytes)
    spanning = cut.groupBy("known", "conv").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high")).where("low < high").drop("low", "high")
    # At most one conversation for each chunk, and two parts: both sides are as small as the list of chunks.
    parts = cut.select("known", "conv", "chunk", "initial", "fault", "copies").join(F.broadcast(spanning), ["known", "conv"], "left_semi") \
        .mapInArrow(_summaries, SUMMARY)
    bounds = stored(parts.groupBy("known", "conv").applyInPandas(_stitch, "known boolean, conv long, chunk int, entry int, leave int, before string"), "bounds")
    return cut.join(F.broadcast(bounds), ["known", "conv", "chunk"], "left").select(
        *cut.columns, F.coalesce("entry", F.lit(0)).alias("entry"), "leave", "before"), cut


LEGAL = ("su", "ua", "au")


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Every edit of a chunk in order; an insert stands before the row of its ``at``, or after the last one."""
    for head, rows in _runs(batches):
        rows = list(rows)
        flat = [(number, fault) for number, row in enumerate(rows) for fault in _faults(row)]
        leave = head["leave"]
        letters, tail = parse([(rows[number]["initial"], fault) for number, fault in flat], head["entry"], None if leave is None or leave < 0 else leave)
        top, before = TOPS[head["entry"]], head["before"]
        step = 0
        common = {"known": head["known"], "conv": head["conv"], "spans": leave is not None, "chunk": head["chunk"]}

        def edit(row, letter, role, text, cost, fault="", illegal=False):
            nonlocal step
            step += 1
            return {**common, "at": row["at"], "step": step, "turn": row["turn"], "action": letter, "role": role, "text": text, "cost": cost,
                    "fault": fault, "illegal": illegal}

        def insert(row):
            nonlocal top
            role = next(role for role in ROLES if shift(top, role))
            top = shift(top, role)
            return edit(row, "I", ROLES[role], "", INSERT)

        for (number, fault), own in zip(flat, letters, strict=True):
            row = rows[number]
            for _ in own[:-1]:
                yield insert(row)
            illegal = before is not None and before + row["initial"] not in LEGAL
            before, letter = row["initial"], own[-1]
            extra = TRUNCATED if fault == "truncated" else 0
            if letter == "D":
                yield edit(row, letter, row["role"], row["text"], DELETE, fault, illegal)
            elif letter == "K":
                top = shift(top, row["initial"])
                yield edit(row, letter, row["role"], row["text"], KEEP + extra, fault, illegal)
            else:
                role = next(role for role in ROLES if shift(top, role))
                top = shift(top, role)
                yield edit(row, letter, ROLES[role], row["text"], REROLE + extra, fault, illegal)
        for _ in tail:
            yield insert(rows[-1])


LOG = "known boolean, conv long, at long, step int, turn long, action string, role string, text string, cost int, fault string, illegal boolean"
_LOG = pa.schema([("known", pa.bool_()), ("conv", pa.int64()), ("at", pa.int64()), ("step", pa.int32()), ("turn", pa.int64()), ("action", pa.string()),
                  ("role", pa.string()), ("text", pa.string()), ("cost", pa.int32()), ("fault", pa.string()), ("illegal", pa.bool_())])


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held, held_bytes = [], 0
    for row in rows:
        held.append({name: row[name] for name in schema.names})
        held_bytes += len(row.get("text") or "") + len(row.get("body") or b"")
        if len(held) >= size or held_bytes > 8 << 20:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, held_bytes = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _log(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batched(_edits(batches), _LOG)


def keyed(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, turn, role and text as the steps here take them; a null role or text is one space."""
    conv = F.col("conv_id").cast("long")
    return rows.select(conv.isNotNull().alias("known"), F.coalesce(conv, F.lit(0)).alias("conv"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       (F.lit(1) if copies is None else copies).cast("long").alias("copies"))


def repair(rows: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The cheapest edits that make each conversation's roles ``(s?(ua)+)?``: (conv_id, at, step, turn, action, role, text, cost, fault, illegal).

    Rows (conv_id, turn, role, text) are taken in order of turn, null first;
    rows of equal turn by role, then text. Sorted by (at, step) the result is
    the conversation with its edits: K keeps a row (0), R gives it the role
    user or assistant (3), D deletes it (4), I inserts one without text (3).
    Blank rows and repetitions of an earlier role and text (``fault``) must go;
    a truncated row that stays costs 3 more. Among cheapest repairs the one
    whose actions in a row are least in ASCII order is taken. Keeping all but D
    gives the repaired conversation.

    The roles are parsed by a graph-structured stack: each row advances every
    top of stack by each edit the LR table allows, and equal tops merge into the
    least (cost, audit). A conversation over several chunks of sorted rows is
    parsed part by part: each part gives its costs and audit ranks from any
    top to any other, the parts' tables (one of 16 numbers each) are chained,
    and the parts are then edited by themselves. So no conversation has to be
    in one task.

    Ids are integers (long); a null id is a conversation of its own, null
    role or text is one space. Equal rows are duplicates. Other columns are
    ignored; no rows give no rows.
    """
    prepare(rows.sparkSession)
    edited, _ = _edited(keyed(rows), chunk_bytes)
    log = edited.mapInArrow(_log, LOG)
    return log.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), *(name for name in log.columns if name not in ("known", "conv")))


COUNTED = ("blank", "duplicate", "truncated", "illegal", "cost")
PART = "known boolean, conv long, spans boolean, chunk int, piece int, blank long, duplicate long, truncated long, illegal long, cost long, audit string, body binary, repaired_sha256 string"
_PART = pa.schema([("known", pa.bool_()), ("conv", pa.int64()), ("spans", pa.bool_()), ("chunk", pa.int32()), ("piece", pa.int32()),
                   *((name, pa.int64()) for name in COUNTED), ("audit", pa.string()), ("body", pa.binary()), ("repaired_sha256", pa.string())])


def _digested(rows: Iterator[dict], piece_bytes: int) -> Iterator[dict]:
    """A row for each conversation of a chunk; of one over several chunks the text follows in pieces."""
    for (known, conv), edits in itertools.groupby(rows, key=lambda row: (row["known"], row["conv"])):
        count, audit, body, digest = dict.fromkeys(COUNTED, 0), [], bytearray(), hashlib.sha256()
        piece, spans, chunk, lines = 0, False, 0, 0
        for row in edits:
            spans, chunk = row["spans"], row["chunk"]
            if row["fault"]:
                count[row["fault"]] += 1
            count["illegal"] += row["illegal"]
            count["cost"] += row["cost"]
            audit.append(row["action"])
            if row["action"] != "D":
                line = f"{row['role']}:{row['text']}".encode()
                # Of a later part the first line follows a line break too, if there is one before it.
                body += b"\n" + line if lines or spans else line
                lines += 1
                if not spans:
                    digest.update(body)
                    body.clear()
                elif len(body) > piece_bytes:
                    yield {**dict.fromkeys(COUNTED, 0), "known": known, "conv": conv, "spans": True, "chunk": chunk, "piece": piece, "audit": "", "body": bytes(body), "repaired_sha256": None}
                    piece += 1
                    body.clear()
        yield {**count, "known": known, "conv": conv, "spans": spans, "chunk": chunk, "piece": piece, "audit": "".join(audit), "body": bytes(body),
               "repaired_sha256": None if spans else digest.hexdigest()}


def _parts(piece_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(_digested(_edits(batches), piece_bytes), _PART)

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a conversation, in order, as one row: texts stream by, only the audit is kept."""
    def rows():
        for head, parts in _runs(batches):
            count, audit, digest, begun = dict.fromkeys(COUNTED, 0), [], hashlib.sha256(), False
            for part in parts:
                for name in COUNTED:
                    count[name] += part[name]
                audit.append(part["audit"])
                digest.update(part["body"] if begun else part["body"][1:])
                begun = begun or bool(part["body"])
            yield {**head, **count, "audit": "".join(audit), "body": b"", "repaired_sha256": digest.hexdigest()}

    yield from _batched(rows(), _PART)


def digests(rows: DataFrame, copies: Column | None = None, chunk_bytes: int = CHUNK_BYTES, piece_bytes: int = 1 << 20) -> DataFrame:
    """What ``repair`` finds and does, a row per conversation.

    (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256), for every conv_id of ``rows``, also where ``copies`` (how
    often a row counts) leaves none of them. Only texts of conversations over
    several chunks are shuffled again, as a digest has to see them in order;
    they stream through.
    """
    prepare(rows.sparkSession)
    left = keyed(rows, copies)
    edited, cut = _edited(left.where("copies > 0"), chunk_bytes)
    parts = stored(edited.mapInArrow(_parts(piece_bytes), PART), "repairs")
    spanning = parts.where("spans").repartition("known", "conv").sortWithinPartitions("known", "conv", "chunk", "piece").mapInArrow(_joined, PART)
    found = parts.where("not spans").union(spanning).drop("spans", "chunk", "piece", "body")
    gaps = cut.select("known", "conv", "turn").distinct().groupBy("known", "conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    every = left.select("known", "conv").distinct().join(found, ["known", "conv"], "left").join(gaps, ["known", "conv"], "left")
    return every.select(
        F.when(F.col("known"), F.col("conv")).alias("conv_id"), *(F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("gaps", *COUNTED)),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with faults put in by a hash of id and turn, and how often each row counts."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    hit = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    changed = rows.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
                          F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), hit.alias("hit"))
    return changed, F.when(F.col("hit") == 0, 0).when(F.col("hit") == 3, 2).otherwise(1)


def _sql() -> str:
    """The same as dynamic programming over the ends of the roles so far: none, s, u, a; each with cost, audit and lines."""
    def made(state, cost, letter, lines):
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': list_concat({state}.t, {lines})}}"

    def least(*states):
        return f"list_sort([{', '.join(states)}])[1]"

    must, cut = "CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 ELSE 0 END", "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    user, assistant = "['user:']", "['assistant:']"

    def kept(state, initial):
        return made(state, f"CASE WHEN initial = '{initial}' THEN 0 ELSE 1000000 END + {must} + {cut}", "K", "[role || ':' || text]")

    def reroled(state, role):
        return made(state, f"3 + {must} + {cut}", "R", f"['{role}:' || text]")

    def ends(source):
        return f"""none, s, {least('u', *(made(x, 3, 'I', user) for x in ('none', 's', 'a')))} AS u,
            {least('a', made('u', 3, 'I', assistant), *(made(x, 6, 'II', "['user:', 'assistant:']") for x in ('none', 's')))} AS a FROM {source}"""

    gone = {x: made(x, 4, "D", "[]::VARCHAR[]") for x in ("none", "s", "u", "a")}
    never = "{'c': 1000000::BIGINT, 'a': '', 't': []::VARCHAR[]}"
    return f"""
WITH RECURSIVE hit AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ') AS key FROM conversations
),
crc_table AS (
    SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS entries
    FROM (SELECT unnest(range(256)) AS n)
),
hashed AS (
    SELECT hit.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda c, b: xor(c >> 8, entries[xor(c & 255, b) + 1])), 4294967295::BIGINT) % 20 AS kind
    FROM hit, crc_table
),
changed AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed
),
placed AS (
    SELECT *, row_number() OVER w AS place,
        left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown
    FROM changed WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
judged AS (
    SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN times > 1 THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au') AS wrong
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS times FROM placed)
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal, max(place) AS last_place
    FROM judged GROUP BY conv_id
),
walk AS (
    SELECT conv_id, 0::BIGINT AS place, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS none, {never} AS s, {never} AS u, {never} AS a FROM counts
    UNION ALL
    SELECT conv_id, place, {gone['none']} AS none, {least(gone['s'], kept('none', 's'))} AS s,
        {least(gone['u'], *(kept(x, 'u') for x in ('none', 's', 'a')), *(reroled(x, 'user') for x in ('none', 's', 'a')))} AS u,
        {least(gone['a'], kept('u', 'a'), reroled('u', 'assistant'))} AS a
    FROM (SELECT j.conv_id, j.place, role, text, initial, fault, {ends('walk AS w JOIN judged AS j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1')})
),
repaired AS (
    SELECT w.conv_id, {least('none', 'a')} AS way FROM (SELECT conv_id, place, {ends('walk')}) AS w JOIN counts ON counts.conv_id IS NOT DISTINCT FROM w.conv_id AND place = last_place
)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(way.c, 0) AS cost, coalesce(way.a, '') AS audit, sha256(coalesce(array_to_string(way.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS every
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM every.conv_id LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM every.conv_id
"""


REPAIR_SQL = _sql()
