"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, weighted-shingle check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored
from tickloom.operators.sizing import broadcast_if_small

WORDS = 5
BITS = 64
#: Bits that fingerprints met by blocks may differ in; a similar pair further apart is found by its shingles.
RADIUS = 15


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits, so that case, punctuation and spacing do not hide a passage."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def shingle_hashes(words: Column, width: int) -> Column:
    """Hash of the ``width`` words from each place on; none when there are fewer words.

    The words are bound to a lambda's variable: the optimizer would otherwise
    copy the expression behind them to every use of a single word.
    """
    def hashed(bound: Column) -> Column:
        places = F.when(F.size(bound) >= width, F.sequence(F.lit(0), F.size(bound) - width)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda place: F.xxhash64(*(F.get(bound, place + k) for k in range(width))))

    return F.get(F.transform(F.array(words), hashed), F.lit(0))


def text_hash(text: Column) -> Column:
    """Tells rows of equal id apart by their text."""
    return F.xxhash64(text)


def items_of(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, n_words, width, variant, shingles) of texts with at least one word; short ones are one shingle of all their words.

    Repeated rows are one, and texts that share an item's id, null too, stay apart by ``variant``, the hash of their shingles.
    """
    rows = benchmark.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words")) \
        .select("item", "words", F.size("words").alias("n_words")).where("n_words > 0")
    parts = [rows.where(F.least(F.col("n_words"), F.lit(WORDS)) == width)
             .select("item", "n_words", F.lit(width).alias("width"), shingle_hashes(F.col("words"), width).alias("shingles"))
             for width in range(1, WORDS + 1)]
    return reduce(DataFrame.unionAll, parts).withColumn("variant", F.xxhash64("shingles")).dropDuplicates(["item", "n_words", "variant"])


def counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, weights, fingerprint) of rows with one ``shingle`` each: how often each shingle occurs, and the SimHash.

    A bit of the fingerprint is set when the shingles with it outweigh those
    without. All is summed before it is shuffled.
    """
    weights = rows.groupBy(*keys, "shingle").agg(F.count("*").alias("weight"))
    votes = [F.sum(F.when(F.getbit(F.col("shingle"), F.lit(bit)) == 1, F.col("weight")).otherwise(-F.col("weight"))).alias(f"v{bit}") for bit in range(BITS)]
    summed = weights.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("shingle", "weight"))).alias("weights"),
                                        F.sum("weight").alias("total"), *votes)
    # Set bits are combined by OR, as a sum of powers of two would pass the largest long.
    bits = [F.when(F.col(f"v{bit}") > 0, F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")) for bit in range(BITS)]
    return summed.select(*keys, "weights", "total", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint"))


def blocks(fingerprint: Column, radius: int) -> Column:
    """(block, value) of the fingerprint cut into ``radius`` + 1 parts.

    Fingerprints at most ``radius`` bits apart agree on one part at least, as
    so many differing bits cannot touch all parts.
    """
    edges = [BITS * part // (radius + 1) for part in range(radius + 2)]
    return F.array(*(F.struct(F.lit(part).alias("block"), F.shiftrightunsigned(fingerprint, low).bitwiseAND((1 << high - low) - 1).alias("value"))
                     for part, (low, high) in enumerate(zip(edges, edges[1:], strict=False))))


def within_radius(left: DataFrame, right: DataFrame, size: str, radius: int) -> DataFrame:
    """Pairs of rows of equal ``size`` whose fingerprints differ in at most ``radius`` bits: multi-index Hamming join.

    Columns of both sides must differ but for ``size`` and ``fingerprint``. A
    pair that agrees on several parts is met once: in the first of them.
    """
    exploded = [side.withColumn("_at", F.explode(blocks(F.col("fingerprint"), radius))) for side in (left, right)]
    a = exploded[0].withColumnRenamed("fingerprint", "_f1").withColumnsRenamed({"_at": "_a1"})
    b = exploded[1].withColumnRenamed("fingerprint", "_f2").withColumnsRenamed({"_at": "_a2"}).withColumnRenamed(size, "_size")
    met = a.join(b, (F.col(size) == F.col("_size")) & (F.col("_a1.block") == F.col("_a2.block")) & (F.col("_a1.value") == F.col("_a2.value"))
                 & (F.bit_count(F.col("_f1").bitwiseXOR(F.col("_f2"))) <= radius))
    agree = F.filter(F.zip_with(blocks(F.col("_f1"), radius), blocks(F.col("_f2"), radius),
                                lambda x, y: F.when(x["value"] == y["value"], x["block"])), lambda block: block.isNotNull())
    return met.where(F.get(agree, F.lit(0)) == F.col("_a1.block")).withColumn("hamming", F.bit_count(F.col("_f1").bitwiseXOR(F.col("_f2")))) \
        .drop("_a1", "_a2", "_f1", "_f2", "_size")


def sharing(prints: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """Pairs of windows (n_words, content) and items (item, variant) of equal size that may be similar, with all columns of both.

    A similar pair shares at least ``similarity`` of the window's weight, so
    it shares one of the window's shingles whatever others of less than that
    weight are left out. The most common ones are left out, so every pair at
    or above the limit is here.
    """
    postings = stored(items.select("n_words", "item", "variant", F.explode(F.map_keys("item_weights")).alias("shingle")), "item-postings")
    usual = broadcast_if_small(stored(postings.groupBy("n_words", "shingle").agg(F.count("*").alias("times")), "item-times"))
    spread = prints.select("n_words", "content", "total", F.explode("weights").alias("shingle", "weight"))
    ordered = spread.join(usual, ["n_words", "shingle"], "left").groupBy("n_words", "content", "total").agg(F.sort_array(F.collect_list(
        F.struct(F.coalesce("times", F.lit(0).cast("long")).alias("times"), "shingle", "weight"))).alias("ordered"))
    # What may be left out before a shingle is: less than the weight that a similar pair shares.
    spare = F.col("total") - F.ceil(F.col("total") * similarity - 1e-9)
    before = F.aggregate("ordered", F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("kept")), lambda found, entry: F.struct(
        (found["sum"] + entry["weight"]).alias("sum"),
        F.when((found["sum"] <= spare) & (entry["times"] > 0), F.concat(found["kept"], F.array(entry["shingle"]))).otherwise(found["kept"]).alias("kept")))
    rare = ordered.select("n_words", "content", F.explode(before["kept"]).alias("shingle"))
    met = stored(rare.join(broadcast_if_small(postings), ["n_words", "shingle"]).select("n_words", "content", "item", "variant").distinct(), "candidates")
    sized = items.withColumnsRenamed({"n_words": "_n_words", "item": "_item", "variant": "_variant", "fingerprint": "_fingerprint"})
    known = broadcast_if_small(stored(sized, "sized-items"))
    return met.join(prints, ["n_words", "content"]).join(
        known, (F.col("n_words") == F.col("_n_words")) & F.col("item").eqNullSafe(F.col("_item")) & (F.col("variant") == F.col("_variant"))) \
        .withColumn("hamming", F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("_fingerprint")))) \
        .drop("_n_words", "_item", "_variant", "_fingerprint")


def weighted_similarity(a: Column, a_total: Column, b: Column, b_total: Column) -> Column:
    """Weighted Jaccard: the smaller weights over the larger ones, summed over all shingles."""
    shared = F.aggregate(F.map_entries(a), F.lit(0).cast("long"),
                         lambda found, entry: found + F.least(entry["value"], F.coalesce(F.try_element_at(b, entry["key"]), F.lit(0).cast("long"))))
    return shared / (a_total + b_total - shared)


def _matched(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
             similarity: float, radius: int, complement: bool) -> DataFrame:
    """(id, text_hash, start, n_words, content, item, hamming, similarity, found_by) of all windows that match an item."""
    items = stored(items_of(benchmark, item_col, item_text_col), "items")
    # At most WORDS values, as the width is bounded.
    widths = [row.width for row in items.select("width").distinct().collect()]
    known = items.select("width", "n_words", F.explode("shingles").alias("shingle")).distinct() \
        .groupBy("width", "shingle").agg(F.collect_set("n_words").alias("sizes"))
    known = broadcast_if_small(stored(known, "item-shingles"))
    rows = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    found = None
    for width in widths:
        part = _windows(rows, known.where(F.col("width") == width).drop("width"), width, similarity)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = _windows(rows.limit(0), known.drop("width"), WORDS, similarity)
    windows = stored(found, "windows")
    # One window stands for all of equal content.
    first = windows.groupBy("n_words", "content").agg(F.min_by("shingles", F.struct("id", "start")).alias("shingles"))
    contents = first.select("n_words", "content", F.explode("shingles").alias("shingle"))
    # Stored, so that the planner does not repeat the long fingerprint expression wherever it is used.
    prints = stored(counted(contents, ["n_words", "content"]), "prints")
    item_prints = counted(items.select("item", "n_words", "variant", F.explode("shingles").alias("shingle")), ["item", "n_words", "variant"]) \
        .withColumnsRenamed({"weights": "item_weights", "total": "item_total"})
    item_prints = stored(item_prints, "item-prints")
    columns = ("n_words", "content", "item", "weights", "total", "item_weights", "item_total", "hamming")
    near = within_radius(prints, broadcast_if_small(item_prints), "n_words", radius).select(*columns, F.lit("blocks").alias("found_by"))
    if complement:
        beyond = sharing(prints, item_prints, similarity).where(F.col("hamming") > radius)
        near = near.unionByName(beyond.select(*columns, F.lit("shingles").alias("found_by")))
    verified = near.withColumn("similarity", weighted_similarity(F.col("weights"), F.col("total"), F.col("item_weights"), F.col("item_total"))) \
        .where(F.col("similarity") >= similarity).select("n_words", "content", "item", "hamming", "similarity", "found_by")
    return windows.select("id", "text_hash", "start", "n_words", "content").join(verified, ["n_words", "content"])


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", similarity: float = 0.8, radius: int = RADIUS, complement: bool = True) -> DataFrame:
    """Documents that hold a benchmark item: (id, item, start, n_words, hamming, similarity, found_by), the best window of each pair.

    Words are lower-case runs of letters and digits, shingles five words
    (items with fewer: all their words). A window has as many words as the
    item, or ends with the document. Windows are fingerprinted when enough of
    their shingles occur in items of that size: a window at or above
    ``similarity`` has at least that share of them, and moving it on to its
    first such shingle cannot lower the similarity, so no match is lost here.
    A window meets the items of its size whose fingerprints are within
    ``radius`` bits, by blocks that no such pair can miss; the weighted Jaccard
    of the shingle counts decides. At a similarity of 0.8 a bit of two
    fingerprints differs with a probability of about 0.15, more for short items, so
    some percent of the pairs near the limit are further apart than any
    radius whose blocks still tell fingerprints apart. These are the
    complement: pairs beyond the radius that share enough of the window's
    rarest shingles (``sharing``), none of which is missed. ``found_by`` says
    which way a match was met, ``blocks`` or ``shingles``; without the
    ``complement`` only the first are searched.

    The benchmark's shingles are broadcast only when measured small. Windows
    of equal content, as in copies, are fingerprinted once. Null and empty
    texts, and items without a word, match nothing; a null id is reported as
    null; repeated rows give one row, on either side; each text of an item id
    is matched by itself, and the best of them is reported; other columns are
    ignored; an empty side gives no rows. Ties go to the earlier start.
    """
    best = _matched(docs, benchmark, id_col, text_col, item_col, item_text_col, similarity, radius, complement)
    rank = F.struct(-F.col("similarity"), "start", "n_words", "hamming", "found_by")
    return best.groupBy("id", "item").agg(
        F.min_by(F.struct("start", "n_words", "hamming", "similarity", "found_by"), rank).alias("best")) \
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.*")


def _windows(rows: DataFrame, known: DataFrame, width: int, similarity: float) -> DataFrame:
    """(id, text_hash, start, n_words, content, shingles) of the windows that could match an item of their size."""
    hashed = rows.select("id", "text_hash", words_of(F.col("text")).alias("words")).select("id", "text_hash", shingle_hashes(F.col("words"), width).alias("shingles"))
    hits = hashed.select("id", "text_hash", F.posexplode_outer("shingles").alias("start", "shingle"))
    hits = hits.join(known, "shingle").select("id", "text_hash", "start", F.explode("sizes").alias("n_words"))
    # A window of n words starts at most n - width + 1 shingles.
    span = F.col("n_words") - width + 1
    near = hits.groupBy("id", "text_hash", "n_words").agg(F.sort_array(F.collect_set("start")).alias("starts"))
    enough = F.ceil(span * similarity - 1e-9)
    # With m = enough hits needed, hit k begins a window that holds hit k + m - 1 as well, if the window is long enough.
    chosen = F.filter(F.transform("starts", lambda start, k: F.when(
        F.get("starts", (k + enough - 1).cast("int")) < start + span, start)), lambda start: start.isNotNull())
    wanted = near.select("id", "text_hash", F.struct("n_words", chosen.alias("starts")).alias("sized")).where(F.size("sized.starts") > 0) \
        .groupBy("id", "text_hash").agg(F.collect_list("sized").alias("sized"))
    joined = hashed.join(wanted.withColumnsRenamed({"id": "_id", "text_hash": "_text_hash"}),
                         F.col("id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_text_hash")))
    spread = joined.select("id", "text_hash", "shingles", F.explode("sized").alias("sized")) \
        .select("id", "text_hash", "shingles", F.col("sized.n_words").alias("n_words"), F.explode("sized.starts").alias("start"))
    cut = spread.select("id", "text_hash", "start", "n_words", F.slice("shingles", F.col("start") + 1, F.col("n_words") - width + 1).alias("shingles"))
    return cut.select("id", "text_hash", "start", "n_words", F.xxhash64("shingles").alias("content"), "shingles")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", similarity: float = 0.8, radius: int = RADIUS, complement: bool = True) -> DataFrame:
    """Distinct (id, text_hash) of rows with a match; options as for ``matches``.

    Rows that share an id, null too, are told apart by ``text_hash`` of their text.
    """
    found = _matched(docs, benchmark, id_col, text_col, item_col, item_text_col, similarity, radius, complement)
    return found.select(F.col("id").alias(id_col), "text_hash").distinct()
