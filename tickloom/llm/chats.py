"""Chat formatting: collapse cumulative snapshots of conversations, then render the maximal ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Two independent 64-bit hashes; sums of so many never reach the 38 digits of the type.
WIDE = "decimal(38,0)"


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(id, turn, role, text, place): turns numbered from 1 in order of turn, then role, then text, nulls first.

    The window sorts within a conversation and spills; it keeps no
    conversation in memory.
    """
    rows = conversations.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("turn", "role", "text")).cast("long"))


def _turn_hash(salt: int) -> Column:
    # Null and empty differ: the flags are hashed too.
    return F.xxhash64(F.lit(salt), "place", F.col("role").isNull(), "role", F.col("text").isNull(), "text").cast(WIDE)


def prefixes(turns: DataFrame) -> DataFrame:
    """(id, place, n_turns, h1, h2): rolling hashes of the first ``place`` turns of each conversation.

    A turn's hash covers its place, so running sums identify the whole prefix.
    """
    order = Window.partitionBy("id").orderBy("place")
    hashed = turns.select("id", "place", *(_turn_hash(salt).alias(f"t{salt}") for salt in (1, 2)))
    return hashed.select(
        "id", "place",
        F.max("place").over(Window.partitionBy("id")).alias("n_turns"),
        *(F.sum(f"t{salt}").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(f"h{salt}") for salt in (1, 2)))


def maximal(turns: DataFrame) -> DataFrame:
    """(id, n_turns, n_copies): conversations that no longer conversation begins with, one id for equal ones.

    Whole conversations and proper prefixes are both reduced to distinct
    hashes before they meet, so a first turn shared by a third of all
    conversations is one row on each side of the anti-join.
    """
    rolled = prefixes(turns)
    # The smallest id stays; null counts as the smallest.
    whole = rolled.where("place = n_turns").groupBy("n_turns", "h1", "h2").agg(
        F.when(F.count("id") < F.count("*"), F.lit(None)).otherwise(F.min("id")).alias("id"), F.count("*").alias("n_copies"))
    proper = rolled.where("place < n_turns").select(F.col("place").alias("n_turns"), "h1", "h2").distinct()
    return whole.join(proper, ["n_turns", "h1", "h2"], "left_anti").select("id", "n_turns", "n_copies")


def render(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", opening: str = "<|", closing: str = "|>\n", ending: str = "\n") -> DataFrame:
    """Chat texts of the maximal conversations: (id, n_turns, n_copies, rendered).

    A conversation logged again and again as it grew is kept only in its
    longest form; of equal ones the smallest id stays, and ``n_copies`` says
    how many were equal. A turn is written as role between ``opening`` and
    ``closing``, its text, ``ending``; a null role or text is written empty
    but differs from an empty one when conversations are compared. Turns with
    equal numbers are ordered by role and text; a null id is a conversation
    of its own; other columns are ignored; no rows give no rows. A rendered
    conversation is one value, so it must fit in a task.
    """
    turns = turns_of(conversations, id_col, turn_col, role_col, text_col)
    keep = maximal(turns).withColumnRenamed("id", "keep_id")
    piece = F.concat(F.lit(opening), F.coalesce("role", F.lit("")), F.lit(closing), F.coalesce("text", F.lit("")), F.lit(ending))
    kept = turns.join(keep, turns.id.eqNullSafe(keep.keep_id)).select("id", "n_turns", "n_copies", F.struct("place", piece.alias("piece")).alias("part"))
    return kept.groupBy("id", "n_turns", "n_copies").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("part")), lambda part: part["piece"]), "").alias("rendered")) \
        .select(F.col("id").alias(id_col), "n_turns", "n_copies", "rendered")


RENDER_SQL = """
WITH numbered AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
           (role IS NULL)::VARCHAR || (text IS NULL)::VARCHAR || md5(coalesce(role, '')) || md5(coalesce(text, '')) AS mark
    FROM conversations
),
grown AS (
    SELECT conv_id, place,
           md5(string_agg(mark, ',') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)) AS prefix,
           count(*) OVER (PARTITION BY conv_id) AS n_turns
    FROM numbered
),
kept AS (
    SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies
    FROM grown AS whole
    WHERE place = n_turns
      AND NOT EXISTS (SELECT 1 FROM grown AS longer WHERE longer.place = whole.n_turns AND longer.prefix = whole.prefix AND longer.place < longer.n_turns)
    GROUP BY n_turns, prefix
)
SELECT conv_id, n_turns, n_copies,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY place) AS rendered
FROM kept JOIN numbered USING (conv_id)
GROUP BY conv_id, n_turns, n_copies
"""
