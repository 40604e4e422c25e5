"""Documents joined by Jaccard similarity of word shingles: adaptive multi-match prefixes."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import Forest, components, forget, frugal, mixed, prepare, slices, stored, text_bytes, word_hashes
from tickloom.operators.sizing import broadcast_if_small

#: Frequencies are kept for so many ranges of hashes: a table of fixed size, four bytes each while counting, one when used.
SKETCH_BITS = 22
CHUNK = 1 << 16
RADIX = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Rule:
    """Two sets are similar when 100 * intersection >= ``percent`` * union."""

    width: int = 3
    percent: int = 90
    most: int = 4

    def overlap(self, n: int) -> int:
        """The least number of shingles that a set of ``n`` shares with any similar one."""
        return -(-self.percent * n // 100)

    def similar(self, shared: int, n: int, m: int) -> bool:
        return n > 0 and m > 0 and 100 * shared >= self.percent * (n + m - shared)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Ascending distinct shingle hashes of each text; with fewer words all of them are one shingle, without words none."""
    for part in slices(texts):
        words, counts = word_hashes(part, lower=True)
        n = max(len(words) - width + 1, 0)
        runs = np.zeros(n, np.uint64)
        for k in range(width):
            runs = runs * RADIX + words[k : k + n]
        runs = mixed(runs)
        at = 0
        for count in counts.tolist():
            if count >= width:
                yield np.unique(runs[at : at + count - width + 1])
            elif count:
                # The length takes part, so that a short text differs from any full shingle.
                whole = np.array([count], np.uint64)
                for word in words[at : at + count]:
                    whole = whole * RADIX + word
                yield mixed(whole)
            else:
                yield np.zeros(0, np.uint64)
            at += count


def buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _count(width: int):
    """Counts of a task's shingles by range of hashes, as compressed chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            counts = np.zeros(1 << SKETCH_BITS, np.uint32) if counts is None else counts
            for found in shingle_sets([text_bytes(text) for text in batch.column(0)], width):
                np.add.at(counts, buckets(found), np.uint32(1))
        if counts is not None:
            yield _chunks({number: counts[at : at + CHUNK] for number, at in enumerate(range(0, len(counts), CHUNK))})

    return run


def _chunks(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
    kept = {number: part for number, part in parts.items() if part.any()}
    return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.int32()), pa.array([zlib.compress(part.astype("<u8").tobytes(), 1) for part in kept.values()], pa.binary())],
                                      names=["chunk", "counts"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the chunks of a partition as they stream by."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(zlib.decompress(text_bytes(data)), "<u8")
            totals[chunk] = totals[chunk] + part if chunk in totals else part
    if totals:
        yield _chunks(totals)


def frequencies(docs: DataFrame, text_col: str, width: int) -> np.ndarray:
    """Per range of hashes, the code of its number of (document, shingle) pairs: four times the binary logarithm, rounded.

    All documents are counted. The table has a fixed size, so it may pass the
    driver and be broadcast. It is an estimate for a single shingle, and
    serves order and cost only, never the result.
    """
    rows = docs.select(F.col(text_col).cast("binary").alias("text"))
    schema = "chunk int, counts binary"
    summed = rows.mapInArrow(frugal(_count(width)), schema).repartition(16, "chunk").mapInArrow(frugal(_sum), schema).collect()
    codes = np.zeros(1 << SKETCH_BITS, np.uint8)
    for chunk, data in summed:
        counts = np.frombuffer(zlib.decompress(bytes(data)), "<u8")
        codes[chunk * CHUNK : (chunk + 1) * CHUNK] = np.round(4 * np.log2(1 + counts.astype(np.float64)))
    return codes


def prefix(shingles: np.ndarray, codes: np.ndarray, background: float, rule: Rule) -> tuple[np.ndarray, int]:
    """(prefix, level): the first shingles in order of estimated frequency, and how many a partner must share.

    Of two similar sets with overlap o at least, the prefixes of n - o + l
    share l shingles, for every l. A longer prefix posts more shingles, but a
    candidate must share more of them: the level with the lowest estimated
    cost is taken. Postings cost what their lists hold beyond the background,
    and candidates, each as much as some postings, thin out with the level.
    """
    n = len(shingles)
    least = rule.overlap(n)
    code = codes[buckets(shingles)]
    ordered = np.lexsort((shingles, code))[: n - least + min(rule.most, least)]
    excess = np.maximum(np.exp2(code[ordered] / 4) - background, 0)
    reached = np.cumsum(excess + 1)
    levels = np.arange(1, min(rule.most, least) + 1)
    ends = n - least + levels
    candidates = np.cumsum(excess)[ends - 1] / levels**2
    best = int(np.argmin(reached[ends - 1] + 20 * candidates))
    return shingles[ordered[: ends[best]]], int(levels[best])


def _prefixes(codes, rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codes.value
        background = float(np.exp2(np.median(table) / 4))
        for batch in batches:
            found, texts = {"n": [], "f1": [], "f2": [], "level": []}, [text_bytes(text) for text in batch.column(1)]
            posted = []
            for shingles in shingle_sets(texts, rule.width):
                chosen, level = prefix(shingles, table, background, rule) if len(shingles) else (shingles, 0)
                posted.append(chosen.view(np.int64))
                # Sums of two mixes of all shingles identify the set.
                for name, value in (("n", len(shingles)), ("level", level), ("f1", int(mixed(shingles).sum())), ("f2", int(mixed(shingles * RADIX).sum()))):
                    found[name].append(value)
            offsets = np.append(0, np.cumsum([len(part) for part in posted]))
            flat = np.concatenate(posted) if posted else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found["n"], pa.int64()), *(pa.array(np.array(found[name], np.uint64).view(np.int64)) for name in ("f1", "f2")),
                 pa.array(found["level"], pa.int32()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                names=["id", "n", "f1", "f2", "level", "posted"])

    return run


def _verify(rule: Rule):
    """Pairs (x, y, x's text, y's text) that are similar; a run of equal x is hashed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, bytes, np.ndarray] | None = None
        for batch in batches:
            a, b = [], []
            for x, y, tx, ty in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                data = text_bytes(tx)
                if last is None or last[0] != x or last[1] != data:
                    last = x, data, next(shingle_sets([data], rule.width))
                other = next(shingle_sets([text_bytes(ty)], rule.width))
                shared = len(np.intersect1d(last[2], other, assume_unique=True))
                if rule.similar(shared, len(last[2]), len(other)):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["src", "dst"])

    return run


def verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (x, y) of documents (id, text) that are similar.

    Texts are first reduced to those of a pair: by broadcast when the ids are
    measured small, by a shuffle beyond that.
    """
    wanted = stored(pairs.select(F.col("x").alias("id")).union(pairs.select(F.col("y").alias("id"))).distinct(), "wanted")
    texts = docs.join(broadcast_if_small(wanted), "id", "left_semi")
    both = pairs.join(texts.select(F.col("id").alias("y"), F.col("text").alias("ty")), "y") \
        .join(texts.select(F.col("id").alias("x"), F.col("text").alias("tx")), "x").select("x", "y", "tx", "ty")
    return both.mapInArrow(frugal(_verify(rule)), "src long, dst long")


#: Turns of the leader step at most. More of them or fewer change the work, not the result.
LEADER_TURNS = 2
#: Postings are pruned again while a round leaves less than this part of them.
WORTH = 0.8
#: Lists of more documents are compared in tiles, shorter ones by pairs; again the result is the same.
LONG_LIST, TILE = 64, 512


def _band(percent: int) -> Column:
    """Class of a set's size: similar sets are in the same class or in neighbouring ones."""
    return F.floor(F.log("n") / (float(np.log(100 / min(percent, 99))) * 1.000001)).cast("int")


def _met(percent: int):
    """Postings (token, n, …), in this order, that share their token with one whose size fits.

    The sizes nearest to a posting's own are its neighbours', so these decide.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        joined = False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            token, n = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            pair = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
            fit = np.append(pair, False)
            fit[1:] |= pair
            # The first row may have met one of the batch before; the last one waits for the next batch.
            fit[0] |= joined
            yield rows.slice(0, rows.num_rows - 1).filter(pa.array(fit[:-1]))
            held, joined = rows.slice(rows.num_rows - 1), bool(fit[-1])
        if held is not None and joined:
            yield held

    return run


def _pruned(lists: DataFrame, most: int) -> DataFrame:
    """Postings without those that can be in no pair which shares enough of them.

    A pair of levels l and m shares min(l, m) tokens that both hold by then. So
    a posting counts for a level only where its list has such a partner of a
    fitting class, and a document's postings of a level only where it has as
    many of them.
    """
    levels = range(1, most + 1)
    own, level = F.col("own"), F.col("level")
    held = lists.groupBy("token", "band").agg(
        *[F.count_if((own <= at) & (level >= at)).alias(f"up{at}") for at in levels], *[F.count_if((own <= at) & (level == at)).alias(f"at{at}") for at in levels])
    names = [f"{kind}{at}" for kind in ("up", "at") for at in levels]
    near = held.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))) \
        .groupBy("token", "band").agg(*[F.sum(name).alias(name) for name in names])
    # With a partner of a higher level the document's own counts, with one of a lower level the partner's.
    counts = {at: (own <= at) & (((level == at) & (F.col(f"up{at}") > 1)) | ((level > at) & (F.col(f"at{at}") > 0))) for at in levels}
    flagged = lists.join(near, ["token", "band"]).select(*lists.columns, *[counts[at].alias(f"c{at}") for at in levels])
    enough = flagged.groupBy("doc").agg(*[(F.count_if(f"c{at}") >= at).alias(f"e{at}") for at in levels])
    useful = functools.reduce(lambda a, b: a | b, [F.col(f"c{at}") & F.col(f"e{at}") for at in levels])
    return flagged.join(enough, "doc").where(useful).select(*lists.columns)


def _placed(opened: DataFrame, known: DataFrame) -> DataFrame:
    """The postings with each document's component so far."""
    rest = opened.drop("part")
    return stored(rest.join(known.withColumnRenamed("node", "doc"), "doc", "left").select(*rest.columns, F.coalesce("component", "doc").alias("part")), "placed")


def _open(placed: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Postings of lists that still hold several components, and an upper estimate of the pairs between these."""
    parts = placed.groupBy("token", "part").agg(F.count("*").alias("members"))
    several = parts.groupBy("token").agg(
        F.count("*").alias("parts"), ((F.sum("members") ** 2 - F.sum(F.col("members") ** 2)) / 2).alias("pairs")).where("parts > 1")
    several = stored(several.select("token", "pairs"), "several")
    kept = stored(placed.join(several, "token").drop("pairs"), name)
    left = several.agg(F.sum("pairs")).first()[0] or 0
    forget(several)
    return kept, int(left)


def _leaders(opened: DataFrame, turn: int, percent: int) -> DataFrame:
    """(x, y): for each document the document of another component that leads most of its lists.

    A list has a leader for each class of sizes, another one each turn.
    """
    order = F.struct(F.xxhash64(F.lit(turn), "doc"), "doc", "n", "part")
    leads = opened.groupBy("token", "band").agg(F.min(order).alias("lead")) \
        .select("token", "band", F.col("lead.doc").alias("lead"), F.col("lead.n").alias("lead_n"), F.col("lead.part").alias("lead_part"))
    led = opened.join(leads, ["token", "band"]).where(
        (F.col("part") != F.col("lead_part")) & (100 * F.least("n", "lead_n") >= percent * F.greatest("n", "lead_n")))
    best = led.groupBy("doc", "lead").agg(F.count("*").alias("times")).groupBy("doc").agg(F.max(F.struct("times", "lead")).alias("best"))
    return best.where("best.times > 1").select(F.col("best.lead").alias("x"), F.col("doc").alias("y"))


def _remaining(opened: DataFrame, percent: int) -> DataFrame:
    """(x, y): all pairs of different components that share enough of their prefixes.

    Components meet first, by list and class of sizes, and their members only
    then, so that documents of one component are never paired.
    """
    heads = opened.groupBy("token", "part", "band").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    left = heads.select("token", F.col("part").alias("px"), F.col("band").alias("bx"), F.col("low").alias("lx"), F.col("high").alias("hx"))
    right = heads.select("token", F.col("part").alias("py"), F.col("band").alias("by"), F.col("low").alias("ly"), F.col("high").alias("hy")) \
        .withColumn("bx", F.explode(F.array(F.col("by") - 1, F.col("by"), F.col("by") + 1)))
    meets = left.join(right, ["token", "bx"]).where(
        (F.col("px") < F.col("py")) & (100 * F.col("hx") >= percent * F.col("ly")) & (100 * F.col("hy") >= percent * F.col("lx"))) \
        .select("token", "px", "bx", "py", "by")
    sides = {side: opened.select("token", F.col("part").alias(f"p{side}"), F.col("band").alias(f"b{side}"), *(F.col(name).alias(f"{name}_{side}") for name in ("doc", "n", "level", "own")))
             for side in "xy"}
    met = meets.join(sides["x"], ["token", "px", "bx"]).join(sides["y"], ["token", "py", "by"])
    level = F.least("level_x", "level_y")
    met = met.where((100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")) & (F.col("own_x") <= level) & (F.col("own_y") <= level))
    return met.select("doc_x", "doc_y", level.alias("level")).groupBy("doc_x", "doc_y").agg(F.count("*").alias("shared"), F.max("level").alias("level")) \
        .where("shared >= level").select(F.col("doc_x").alias("x"), F.col("doc_y").alias("y"))


def _tile_links(rule: Rule):
    """Spanning forest of the similar pairs between the two sides of a tile, without a row per pair."""

    def run(rows: pa.Table) -> pa.Table:
        sides = [rows.filter(pa.compute.equal(rows.column("side"), side)) for side in (0, 1)]
        ids = [side.column("doc").to_pylist() for side in sides]
        sets = [list(shingle_sets([text_bytes(text) for text in side.column("text")], rule.width)) for side in sides]
        sizes = np.array([len(found) for found in sets[1]], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *sets[1]])
        order = np.argsort(flat, kind="stable")
        flat, column = flat[order], np.repeat(np.arange(len(sizes)), sizes)[order]
        forest = Forest()
        for own, found in zip(ids[0], sets[0], strict=True):
            low, high = np.searchsorted(flat, found, "left"), np.searchsorted(flat, found, "right")
            runs = high - low
            places = np.repeat(low - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
            shared = np.bincount(column[places], minlength=len(sizes))
            for other in np.flatnonzero((100 * shared >= rule.percent * (len(found) + sizes - shared)) & (shared > 0)).tolist():
                forest.join(own, ids[1][other])
        a, b = forest.links()
        return pa.table({"src": pa.array(a, pa.int64()), "dst": pa.array(b, pa.int64())})

    return run


def _tiled(members: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Links among documents that long lists join: (doc, head) says that a list holds both.

    Documents joined by such lists form groups, and a group is compared with
    itself in tiles of about TILE documents a side. A group's work is spread
    over its tiles, and grows with the square of its size, but its rows do not.
    """
    found = stored(components(members.select(F.col("doc").alias("src"), F.col("head").alias("dst"))), "list-groups")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    sizes = found.groupBy("component").agg(F.count("*").alias("size"))
    placed = found.join(sizes, "component").select("component", F.col("node").alias("id"), tiles.alias("tiles"), F.pmod(F.xxhash64("node"), tiles).cast("int").alias("own"))
    placed = docs.join(broadcast_if_small(stored(placed, "list-members")), "id").withColumnRenamed("id", "doc")
    first = placed.select("*", F.explode(F.sequence("own", F.col("tiles") - 1)).alias("tj")).select("component", F.col("own").alias("ti"), "tj", F.lit(0).alias("side"), "doc", "text")
    second = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("own"))).alias("ti")).select("component", "ti", F.col("own").alias("tj"), F.lit(1).alias("side"), "doc", "text")
    return first.union(second).groupBy("component", "ti", "tj").applyInArrow(_tile_links(rule), "src long, dst long")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90,
                      most: int = 4) -> DataFrame:
    """Connected components of documents whose shingle sets are similar: (id, n_shingles, component_id), a row per input row.

    Words are runs without white space, A-Z in lower case, of whole texts;
    shingles are ``width`` words. Documents link when
    100 * intersection >= ``percent`` * union; the component is the smallest
    id that links reach.

    1. Shingles are counted by range of hashes over all documents; the table
       has a fixed size.
    2. Each document posts a prefix of its rarest shingles. Its length adapts
       to the estimated cost, up to ``most`` shared shingles asked for.
    3. Documents with equal sets are taken as one, so copies cost one row.
       Postings that meet none of a fitting size go as they stream by in order
       of tokens; then those go that can't be among as many shared ones as
       their levels ask for, until little changes.
    4. While lists hold many pairs between components, each document is
       checked against one other, the leader of most of its lists. A few turns
       with other leaders join large groups of near copies, at one check a
       member and turn.
    5. All pairs that share enough of their prefixes are then met and checked
       exactly, but for pairs already in one component: between those a check
       cannot change the result. Lists within one component are dropped as a
       whole.
    6. A pair that shares a list of more than LONG_LIST documents is checked
       in a tile instead: many documents of about the limit's similarity then
       cost arithmetic, not rows. All lists that a pair shares are short, or
       it is in a tile.

    No list, pair or candidate is capped. Null and empty texts have an empty
    set and link with nothing, as do rows with a null id (component null).
    Rows of equal id count as one document with several texts. Other columns
    are ignored; no rows give no rows.
    """
    rule = Rule(width, percent, most)
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    codes = spark.sparkContext.broadcast(frequencies(rows, "text", width))
    found = stored(rows.mapInArrow(frugal(_prefixes(codes, rule)), "id long, n long, f1 long, f2 long, level int, posted array<long>"), "prefixes")
    sets = found.where("n > 0 and id is not null").groupBy("n", "f1", "f2").agg(
        F.min("id").alias("doc"), F.first("level").alias("level"), F.first("posted").alias("posted"))
    # A posting's own level: the least number of shared shingles at which the prefix holds it. Levels go as one number.
    base = F.col("n") - F.ceil(F.col("n") * percent / 100)
    postings = sets.select("doc", "n", "level", F.posexplode("posted").alias("place", "token")) \
        .select("token", "n", "doc", (F.greatest(F.col("place") - base + 1, F.lit(1)) * 256 + F.col("level")).cast("int").alias("levels"))
    met = postings.repartition("token").sortWithinPartitions("token", "n").mapInArrow(frugal(_met(percent)), "token long, n long, doc long, levels int")
    lists = stored(met.select("token", "doc", "n", F.col("levels").bitwiseAND(255).alias("level"), F.shiftright("levels", 8).alias("own"), _band(percent).alias("band")), "lists")
    size = lists.count()
    while size:
        before, lists = (lists, size), stored(_pruned(lists, most), "pruned")
        forget(before[0])
        size = lists.count()
        if size > WORTH * before[1]:
            break

    # Each step's postings replace those of the step before.
    links, opened, steps = None, lists.withColumn("part", F.col("doc")), [lists]
    for turn in range(LEADER_TURNS):
        opened, pairs_left = _open(opened, f"open-{turn}")
        steps.append(opened)
        if not pairs_left:
            break
        first = stored(_leaders(opened, turn, percent), "first-pairs")
        found_links = stored(verified(first, rows, rule), "first-links")
        links = found_links if links is None else stored(links.union(found_links), "all-links")
        # Components only grow, so lists that are closed stay closed.
        opened = _placed(opened, components(links))
        forget(first, *steps)
        steps = [opened]
    else:
        opened, _ = _open(opened, "open-last")
        steps.append(opened)
    lengths = opened.groupBy("token").agg(F.count("*").alias("docs"), F.min("doc").alias("head"))
    listed = stored(opened.join(lengths, "token"), "listed")
    forget(*steps)
    short = listed.where(F.col("docs") <= LONG_LIST).drop("docs", "head")
    more = verified(stored(_remaining(short, percent), "pairs"), rows, rule)
    more = more.union(_tiled(listed.where(F.col("docs") > LONG_LIST).select("doc", "head"), rows, rule))
    final = stored(components(more if links is None else links.union(more)), "components")

    same = sets.select("n", "f1", "f2", "doc").join(final.withColumnRenamed("node", "doc"), "doc", "left") \
        .select("n", "f1", "f2", F.coalesce("component", "doc").alias("component"))
    return found.select("id", "n", "f1", "f2").join(same, ["n", "f1", "f2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


JOIN_SQL = r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, array_to_string(words[start:start + 2], ' ') AS shingle FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS start FROM words WHERE len(words) >= 3)
        UNION ALL
        SELECT doc_id, array_to_string(words, ' ') FROM words WHERE len(words) BETWEEN 1 AND 2)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * k >= 90 * (a.n + b.n - k)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
    WITH RECURSIVE walk(start, node) AS (
        SELECT x, x FROM both_ways UNION SELECT walk.start, both_ways.y FROM walk JOIN both_ways ON walk.node = both_ways.x
    )
    SELECT start, min(node) AS component FROM walk GROUP BY start
)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, words.doc_id) AS component_id
FROM words LEFT JOIN sizes ON sizes.doc_id = words.doc_id LEFT JOIN reached ON start = words.doc_id
"""
