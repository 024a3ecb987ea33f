"""Preference formatting: one prompt, two completions, and what to train on.

The longest common turn prefix of a chosen and a rejected conversation is
rendered once; what follows is rendered apart for both. Spans tell which
characters of a completion are the assistant's, for the loss mask. DataFrame
functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import gapless_rank, staged, table

_OPEN, _MID, _CLOSE = "<|", "|>\n", "<|end|>\n"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns, an array of (turn, role, text) in turn order.

    Rows without conv_id belong to no conversation. Null roles and texts count
    as empty; equal turn numbers are ordered by role and text, null ones come first.
    """
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))


def _body(turn: Column) -> Column:
    return F.concat(F.lit(_OPEN), turn["role"], F.lit(_MID), turn["text"], F.lit(_CLOSE))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _body), "")


def _trained(turns: Column) -> Column:
    """Spans (start, stop) of the assistant's words and end marks in the rendered turns, as an array."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        start = s["at"] + F.length(t["role"]) + len(_OPEN) + len(_MID)
        stop = start + F.length(t["text"]) + len(_CLOSE)
        span = F.array(F.struct(start.alias("start"), (stop - 1).alias("stop")))
        return F.struct(stop.alias("at"), F.when(t["role"] == "assistant", F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step)["spans"]


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Replace the two turn arrays by n_common, prompt, and for both the completion and its spans.

    The prompt leaves each side at least its last turn, so a completion is never
    empty unless its conversation is. Pairs with a null array are not formatted:
    their new columns are null. Other columns stay.
    """
    c, r = F.col(chosen), F.col(rejected)
    same = F.zip_with(c, r, lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    apart = F.array_position(same, False)
    common = F.greatest(F.least(F.when(apart > 0, apart - 1).otherwise(F.size(c)), F.size(c) - 1, F.size(r) - 1), F.lit(0)).cast("int")
    out = pairs.withColumn("n_common", F.when(c.isNotNull() & r.isNotNull(), common))
    rest = lambda side: F.slice(side, F.col("n_common") + 1, F.size(side))
    out = out.withColumn("prompt", _rendered(F.slice(c, 1, F.col("n_common"))))
    for name, side in (("chosen", c), ("rejected", r)):
        out = out.withColumn(f"_{name}", rest(side))
    keep = [x for x in pairs.columns if x not in (chosen, rejected, "n_common", "prompt")]
    new = [e for n in ("chosen", "rejected") for e in (_rendered(F.col(f"_{n}")).alias(n), _trained(F.col(f"_{n}")).alias(f"{n}_spans"))]
    return out.select(*keep, "n_common", "prompt", *new)


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, chosen, rejected): every conversation beside another that opens with the same turn.

    Conversations that share their first turn are ranked by the start of the
    second turn's md5, then by the starts of all later ones in turn, then by
    conv_id, so that those with longer common openings stand together; the next
    one in rank (after the last, the first) is the rejected side. A conversation
    whose first turn no other shares gets an empty rejected side. Equal
    conversations make pairs too. All turns are kept, those after the last reply
    as well. Ranks are worked out on ids and digests; ``turns`` is read several times.
    """
    talks = conversations(turns)
    marks = F.transform("turns", lambda t: F.md5(_body(t)))
    starts = F.array_join(F.transform(F.slice(marks, 2, F.size("turns")), lambda m: F.substring(m, 1, 8)), "")
    cut = F.coalesce(F.substring(F.get(marks, F.lit(1)), 1, 3), F.substring(F.md5(F.lit("")), 1, 3))
    light = staged(talks.select("conv_id", marks[0].alias("opening"), cut.alias("slice"), starts.alias("starts")), "talks")
    ranked = staged(gapless_rank(light, ["opening"], F.col("slice"), ["starts", "conv_id"], "i").select("conv_id", "opening", "i"), "ranked")
    last = ranked.groupBy("opening").agg(F.max("i").alias("last")).where("last > 0")
    after = ranked.where("i > 0").select("opening", (F.col("i") - 1).alias("i"), F.col("conv_id").alias("other"))
    wrap = ranked.where("i = 0").join(last, "opening").select("opening", F.col("last").alias("i"), F.col("conv_id").alias("other"))
    pairs = ranked.join(after.unionByName(wrap), ["opening", "i"]).select("conv_id", "other")
    rejected = talks.select(F.col("conv_id").alias("other"), F.col("turns").alias("rejected")).join(pairs, "other").select("conv_id", "rejected")
    beside = talks.select("conv_id", F.col("turns").alias("chosen")).join(rejected, "conv_id", "left")
    return beside.select("conv_id", "chosen", F.coalesce("rejected", F.slice("chosen", 1, 0)).alias("rejected"))


def op8_preference_format(spark, sf_dir: str) -> DataFrame:
    """Format the pair of every conversation; spans are written start-stop, with commas between."""
    out = format_preferences(neighbour_pairs(table(spark, sf_dir, "conversations")))
    written = lambda c: F.array_join(F.transform(F.col(c), lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return out.withColumns({f"{n}_spans": written(f"{n}_spans") for n in ("chosen", "rejected")})


OP8_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), b AS (
  SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS body FROM t
), c AS (
  SELECT conv_id, count(*) AS n, coalesce(string_agg(md5(body)[1:8], '' ORDER BY k) FILTER (k > 1), '') AS starts, md5(max(body) FILTER (k = 1)) AS opening,
         md5(coalesce(max(body) FILTER (k = 2), ''))[1:3] AS slice
  FROM b GROUP BY conv_id
), r AS (
  SELECT conv_id, n, opening, row_number() OVER (PARTITION BY opening ORDER BY slice, starts, conv_id) - 1 AS i,
         count(*) OVER (PARTITION BY opening) AS m
  FROM c
), p AS (
  SELECT a.conv_id AS x, o.conv_id AS y, a.n AS nx, coalesce(o.n, 0) AS ny
  FROM r a LEFT JOIN r o ON a.m > 1 AND o.opening = a.opening AND o.i = (a.i + 1) % a.m
), d AS (
  SELECT p.x, min(u.k) AS apart
  FROM p JOIN b u ON u.conv_id = p.x JOIN b v ON v.conv_id = p.y AND v.k = u.k
  WHERE u.role <> v.role OR u.text <> v.text GROUP BY p.x
), q AS (
  SELECT p.x, p.y, greatest(least(coalesce(d.apart - 1, nx), nx - 1, ny - 1), 0) AS n_common FROM p LEFT JOIN d ON d.x = p.x
), side AS (
  SELECT q.x, 'c' AS which, b.k, b.role, b.text, b.body FROM q JOIN b ON b.conv_id = q.x AND b.k > q.n_common
  UNION ALL
  SELECT q.x, 'r', b.k, b.role, b.text, b.body FROM q JOIN b ON b.conv_id = q.y AND b.k > q.n_common
), placed AS (
  SELECT *, (coalesce(sum(length(body)) OVER (PARTITION BY x, which ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            + length(role) + 5)::BIGINT AS start
  FROM side
), done AS (
  SELECT x, which, string_agg(body, '' ORDER BY k) AS body,
         string_agg(start || '-' || (start + length(text) + 7), ',' ORDER BY k) FILTER (role = 'assistant') AS spans
  FROM placed GROUP BY x, which
), prompts AS (
  SELECT q.x, string_agg(b.body, '' ORDER BY b.k) AS prompt FROM q JOIN b ON b.conv_id = q.x AND b.k <= q.n_common GROUP BY q.x
)
SELECT q.x AS conv_id, q.n_common::INTEGER AS n_common, coalesce(prompts.prompt, '') AS prompt,
       coalesce(c.body, '') AS chosen, coalesce(c.spans, '') AS chosen_spans,
       coalesce(r.body, '') AS rejected, coalesce(r.spans, '') AS rejected_spans
FROM q LEFT JOIN prompts ON prompts.x = q.x
LEFT JOIN done c ON c.x = q.x AND c.which = 'c' LEFT JOIN done r ON r.x = q.x AND r.which = 'r'
"""
