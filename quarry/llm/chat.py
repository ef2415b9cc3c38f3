"""Chat formatting by perspective rotation, in DataFrame and SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.listings import number_rows
from ..session import materialise

#: The markers of a rendered turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _plain(text: Column) -> Column:
    """Text in which no marker stands: "<|" gets a backslash in between, and one more if there are any, so it can be undone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def _speaker(role: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(role, r"[\r\n]", " ")), F.lit("")), F.lit("unknown"))


def rotate_perspectives(
    turns: DataFrame, *, turns_per_part: int | None = 256, rows_per_piece: int = 1024, system: tuple[str, ...] = ("system",),
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """conv_id, perspective, part, piece, n_turns, n_trained, messages, rendered, mask: a dialogue as each participant sees it.

    For every participant of a conversation (each distinct role but the system ones) the dialogue is
    rendered with that speaker as assistant and all others as users with their names; system turns
    stay. messages is an array of (turn, role, name, content, trained); rendered joins them with
    markers; mask has (start, length) in characters of rendered for each stretch that is trained on:
    the assistant's contents with their closing marker. In rendered, "<|" in contents and names is
    written with a backslash (and one more than there were), so no text can pass for a marker.

    A long dialogue is cut into parts of turns_per_part turn numbers (part = turn div that), so no
    conversation is gathered whole; parts follow each other by number, and turn numbers go on through them.
    A part or piece without a system turn of its own opens with the conversation's first one (by turn and
    text), so what a participant is told does not change with the dialogue's length; n_turns counts it.
    None: dialogues stay whole. A
    part of more than rows_per_piece rows (rows that repeat, or have no turn or all the same one) is
    cut into pieces of that many, in order; other parts are piece 0. Turns are ordered by turn, role
    and text, nulls first; ties are alike. A null or blank role is a participant called "unknown",
    line breaks in roles are blanks; a null text is an empty message, a long one stays whole; a null
    turn is in part 0; rows that repeat stay. A null conv_id is a conversation. A conversation of system
    turns alone gives no rows, nor do empty tables; other columns are ignored.
    """
    part = F.coalesce(F.floor(F.col("turn") / turns_per_part), F.lit(0)) if turns_per_part else F.lit(0).cast("long")
    own = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        _speaker(F.col(role)).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("content"),
    ).withColumn("part", part)
    people = own.where(~F.col("speaker").isin(*system)).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    rows = own.withColumn("piece", F.lit(0).cast("long"))
    if turns_per_part:
        heavy = materialise(own.groupBy("conv_id", "part").agg(F.count("*").alias("n")).where(F.col("n") > rows_per_piece).select(F.col("conv_id").alias("c"), F.col("part").alias("p")), "heavy")
        if not heavy.isEmpty():
            among = own["conv_id"].eqNullSafe(heavy["c"]) & (own["part"] == heavy["p"])
            # numbered by a range-partitioned sort of all their rows, not by a window that gathers one part
            order = [F.col(c).asc_nulls_first() for c in ("conv_id", "part", "turn", "speaker", "content")]
            numbered = materialise(number_rows(own.join(heavy, among, "left_semi").orderBy(*order), "nth"), "turns")
            first = numbered.groupBy(F.col("conv_id").alias("c"), F.col("part").alias("p")).agg(F.min("nth").alias("first"))
            cut = numbered.join(first, numbered["conv_id"].eqNullSafe(first["c"]) & (numbered["part"] == first["p"]))
            cut = cut.select(*own.columns, F.floor((F.col("nth") - F.col("first")) / rows_per_piece).alias("piece"))
            rows = own.join(heavy, among, "left_anti").withColumn("piece", F.lit(0).cast("long")).unionByName(cut)
    parts = rows.groupBy("conv_id", "part", "piece").agg(F.array_sort(F.collect_list(F.struct("turn", "speaker", "content"))).alias("turns"))
    # what sets the scene holds for the whole dialogue, so a part or piece without it opens with it
    if turns_per_part:
        scene = own.where(F.col("speaker").isin(*system)).groupBy(F.col("conv_id").alias("c")).agg(F.min(F.struct("turn", "speaker", "content")).alias("scene"))
        parts = parts.join(scene, parts["conv_id"].eqNullSafe(scene["c"]), "left").drop("c")
        without = F.col("scene").isNotNull() & ~F.exists("turns", lambda t: t["speaker"].isin(*system))
        parts = parts.withColumn("turns", F.when(without, F.concat(F.array("scene"), "turns")).otherwise(F.col("turns"))).drop("scene")
    seen = parts.join(people, parts["conv_id"].eqNullSafe(people["c"])).drop("c")

    mine = lambda t: t["speaker"] == F.col("perspective")
    setting = lambda t: t["speaker"].isin(*system)
    message = lambda t: F.struct(
        t["turn"].alias("turn"),
        F.when(setting(t), F.lit("system")).when(mine(t), F.lit("assistant")).otherwise(F.lit("user")).alias("role"),
        F.when(~setting(t) & ~mine(t), t["speaker"]).alias("name"),
        t["content"].alias("content"),
        (~setting(t) & mine(t)).alias("trained"),
    )
    seen = seen.withColumn("messages", F.transform("turns", message))
    head = lambda m: F.concat(F.lit(OPEN), m["role"], F.coalesce(F.concat(F.lit(" name="), _plain(m["name"])), F.lit("")), F.lit("\n"))
    seen = seen.withColumn("pieces", F.transform("messages", lambda m: F.struct(head(m).alias("head"), F.concat(_plain(m["content"]), F.lit(CLOSE)).alias("body"), m["trained"].alias("trained"))))
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    step = lambda s, p: F.struct(
        (s["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
        F.when(p["trained"], F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).cast("long").alias("length"))))).otherwise(s["spans"]).alias("spans"),
    )
    return seen.select(
        "conv_id", "perspective", "part", "piece", F.size("messages").cast("long").alias("n_turns"),
        F.size(F.filter("messages", lambda m: m["trained"])).cast("long").alias("n_trained"), "messages",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("rendered"),
        F.aggregate("pieces", nothing, step, lambda s: s["spans"]).alias("mask"),
    )


#: The digest columns of op6 for DuckDB: one row per conversation, perspective, part and piece.
PERSPECTIVES_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(nullif(trim(regexp_replace(role, '[\r\n]', ' ', 'g')), ''), 'unknown') AS speaker, coalesce(text, '') AS content,
         coalesce(CAST(floor(turn / 256.0) AS BIGINT), 0) AS part
  FROM conversations),
cut AS (
  SELECT *, 1 AS later, CAST(floor((row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, speaker, content) - 1) / 1024) AS BIGINT) AS piece
  FROM turns),
scene AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, content) AS nth FROM turns WHERE speaker = 'system') WHERE nth = 1),
bare AS (SELECT conv_id, part, piece FROM cut GROUP BY conv_id, part, piece HAVING count(*) FILTER (WHERE speaker = 'system') = 0),
opened AS (
  SELECT conv_id, turn, speaker, content, part, later, piece FROM cut UNION ALL
  SELECT b.conv_id, s.turn, s.speaker, s.content, b.part, 0, b.piece FROM bare b JOIN scene s ON b.conv_id IS NOT DISTINCT FROM s.conv_id),
own AS (
  SELECT *, regexp_replace(content, '<(\\*)\|', '<\1\\|', 'g') AS plain, regexp_replace(speaker, '<(\\*)\|', '<\1\\|', 'g') AS name
  FROM opened),
people AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM own WHERE speaker <> 'system'),
seen AS (
  SELECT own.*, perspective, speaker <> 'system' AND speaker = perspective AS trained,
         '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user name=' || name END || chr(10) AS head,
         plain || '<|im_end|>' || chr(10) AS body
  FROM own JOIN people ON own.conv_id IS NOT DISTINCT FROM people.c)
, placed AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part, piece ORDER BY later, turn NULLS FIRST, speaker, content ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM seen)
SELECT conv_id, perspective, part, piece, count(*) AS n_turns, CAST(count(*) FILTER (WHERE trained) AS BIGINT) AS n_trained,
       string_agg(head || body, '' ORDER BY later, turn NULLS FIRST, speaker, content) AS rendered,
       coalesce(string_agg(CAST(CAST(pos + length(head) AS BIGINT) AS VARCHAR) || '+' || CAST(length(body) AS VARCHAR), ',' ORDER BY later, turn NULLS FIRST, speaker, content) FILTER (WHERE trained), '') AS mask
FROM placed GROUP BY conv_id, perspective, part, piece
"""
