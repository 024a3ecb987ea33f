"""Hit lists of maps: selection of the best hits, coordinates, mates.

A hit is a text such as ``chr1:F120@30/1``: chromosome, strand, start, then
quality and mismatches where known. Hits of a read are joined by commas, those
with fewest mismatches first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.text import map_class


def best_hits(maps: DataFrame, mismatches: int = 2, closest: int = 0, unique_strict: bool = False) -> DataFrame:
    """Add ``kept``, the hits of the best stratum and of ``closest`` strata after it.

    The best stratum is the first within ``mismatches`` that is not 0. Where '!'
    (too many hits) comes before it, and where a strict call finds several hits,
    none is kept. A stratum that is no number counts as 0, missing texts as none.
    """
    strata = F.split(F.coalesce("strata", F.lit("-")), ":")
    counts = F.transform(strata, lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    first = lambda a, test: F.array_position(F.transform(F.slice(a, 1, mismatches + 1), test), True)
    out = maps.withColumn("_c", counts).withColumn("_best", first(F.col("_c"), lambda x: x != 0)).withColumn("_over", first(strata, lambda x: x == "!"))
    lost = (F.col("_over") > 0) & ((F.col("_best") == 0) | (F.col("_over") < F.col("_best")))
    own = F.slice("_c", F.greatest(F.col("_best"), F.lit(1)).cast("int"), F.lit(closest + 1))
    n = F.when(lost, 0).otherwise(F.aggregate(own, F.lit(0), lambda s, x: s + x))
    n = F.when(n > 1, 0).otherwise(n) if unique_strict else n
    listed = F.split(F.when(F.col("hits") != "-", F.col("hits")).otherwise(""), ",")
    kept = F.filter(F.slice(listed, F.lit(1), F.col("_n")), lambda h: h != "")
    return out.withColumn("_n", n).withColumn("kept", F.coalesce(kept, F.array().cast("array<string>"))).drop("_c", "_best", "_over", "_n")


def hit_coordinates(hits: DataFrame, length: int) -> DataFrame:
    """A row per kept hit: its place in the list from 0, chr (first word), strand, start, end, mismatches.

    Where no number of mismatches follows the quality, those written after the
    start (``C15``, ``<+2>20``) are counted.
    """
    form = r"^([^:\s]+)[^:]*:([FR])([0-9]+)((?:<[+-][0-9]+>[0-9]+|[^0-9@<>][0-9]+)*)(?:@[^/]*(?:/([0-9]+))?)?$"
    part = lambda k: F.regexp_extract("hit", form, k)
    rows = hits.select("pair_id", "mate", "lane", F.posexplode("kept").alias("ordinal", "hit")).where(part(1) != "")
    start = part(3).cast("long")
    written = F.regexp_count(F.regexp_replace(part(4), "<[+-][0-9]+>", "I"), F.lit("[^0-9][0-9]+"))
    return rows.select(
        "pair_id", "mate", "lane", "ordinal", part(1).alias("chr"), F.when(part(2) == "F", "+").otherwise("-").alias("strand"), start.alias("start"),
        (start + length - 1).alias("end"), F.coalesce(F.nullif(part(5), F.lit("")).cast("int"), written).alias("mismatches"),
    )


def stranded(hits: DataFrame) -> DataFrame:
    """Hits of first mates on the other strand, as stranded libraries need."""
    return hits.withColumn("strand", F.when(F.col("mate") == 1, F.translate("strand", "+-", "-+")).otherwise(F.col("strand")))


def with_tag(line: Column, prefix: str, value: Column) -> Column:
    """An alignment line with ``prefix`` and value as a further tag, unless a tag with this prefix is there."""
    return F.when(F.concat(F.lit("\t"), line).contains("\t" + prefix), line).otherwise(F.concat_ws("\t", line, F.concat(F.lit(prefix), value.cast("string"))))


def consistent_mates(alignments: DataFrame) -> DataFrame:
    """Pairs (id, mate 1 and 2) and whether positions and mate positions are swapped and template lengths agree."""
    side = lambda m: alignments.where(F.col("mate") == m).select("id", *[F.col(c).alias(f"{c}{m}") for c in ("pos", "mate_pos", "tlen")])
    good = F.expr("pos1 = mate_pos2 and pos2 = mate_pos1 and abs(tlen1) = abs(tlen2)")
    return side(1).join(side(2), "id").select("id", F.coalesce(good, F.lit(False)).alias("consistent"))


def rescued_mates(hits: DataFrame, same_strand: bool = False, unique_strict: bool = False) -> DataFrame:
    """For pairs of a unique and a multiple mate the multiple one's closest hit; none at all if ``unique_strict``.

    Hits on the unique mate's chromosome and the opposite strand (the same one
    if ``same_strand``) compete by distance of the whole midpoints, then by
    order. Hits meet by pair alone, so a group is as small as one pair.
    """
    mid = F.floor((F.col("start") + F.col("end")) / 2)
    hits = hits.where(F.lit(not unique_strict))
    size = hits.groupBy("pair_id", "mate").agg(F.count(F.lit(1)).alias("n"))
    sized = hits.withColumn("mid", mid).join(size, ["pair_id", "mate"])
    one = sized.where("n = 1").select("pair_id", F.col("mate").alias("sure"), F.col("chr").alias("c"), F.col("strand").alias("s"), F.col("mid").alias("m"))
    both = sized.where("n > 1").join(one, "pair_id").where((F.col("chr") == F.col("c")) & ((F.col("strand") == F.col("s")) == F.lit(same_strand)))
    near = both.groupBy("pair_id", "mate").agg(F.min(F.struct(F.abs(F.col("m") - F.col("mid")).alias("distance"), "ordinal", "chr", "strand", "start", "end")).alias("nearest"))
    return near.select("pair_id", "mate", *[F.col("nearest")[c].alias(c) for c in ("distance", "ordinal", "chr", "strand", "start", "end")])


def outcome_of_pairs(kept: DataFrame, rescued: DataFrame, pseudo: DataFrame | None = None) -> DataFrame:
    """The outcome of each pair: lane, pair_id, outcome.

    pseudo (a pair in ``pseudo``, if given); double_unique; recovered (a unique mate picked the other's hit); read1_unique
    and read2_unique (the other mate has no hit to pick); both_multi (no mate is
    unique, some is multiple); no_hit.
    """
    n = kept.groupBy("lane", "pair_id").agg(*[F.sum(F.when(F.col("mate") == m, F.size("kept")).otherwise(0)).alias(f"n{m}") for m in (1, 2)])
    out = n.join(rescued.select("pair_id", F.lit(True).alias("r")).distinct(), "pair_id", "left")
    out = out.withColumn("p", F.lit(False)) if pseudo is None else out.join(pseudo.select("pair_id", F.lit(True).alias("p")).distinct(), "pair_id", "left")
    outcome = (
        F.when(F.col("p"), "pseudo").when(F.expr("n1 = 1 and n2 = 1"), "double_unique").when(F.col("r"), "recovered").when(F.col("n1") == 1, "read1_unique")
        .when(F.col("n2") == 1, "read2_unique").when(F.expr("n1 + n2 > 0"), "both_multi").otherwise("no_hit")
    )
    return out.select("lane", "pair_id", outcome.alias("outcome"))


def pair_outcomes(kept: DataFrame, rescued: DataFrame, pseudo: DataFrame | None = None) -> DataFrame:
    """Pairs by lane and outcome."""
    return outcome_of_pairs(kept, rescued, pseudo).groupBy("lane", "outcome").agg(F.count(F.lit(1)).alias("pairs"))


def routed_hits(kept: DataFrame, coordinates: DataFrame, rescued: DataFrame, pseudo: DataFrame | None = None) -> DataFrame:
    """A row for each hit that is given out: unique (its mate's one hit, or the one that its mate picked), multi, or unmatched.

    unmatched: a hit of a multiple mate whose pair has a unique mate that picked
    none of them. Pairs in ``pseudo`` give no rows; leave it out for transcripts.
    """
    n = kept.select("pair_id", "mate", F.size("kept").alias("n"))
    pairs = n.groupBy("pair_id").agg(F.max(F.col("n") == 1).alias("one"))
    rows = coordinates.join(n, ["pair_id", "mate"]).join(pairs, "pair_id")
    rows = rows if pseudo is None else rows.join(pseudo.select("pair_id").distinct(), "pair_id", "left_anti")
    picked = rescued.select("pair_id", "mate", F.col("ordinal").alias("pick"))
    rows = rows.join(picked, ["pair_id", "mate"], "left").where("pick is null or pick = ordinal")
    route = F.when((F.col("n") == 1) | F.col("pick").isNotNull(), "unique").when(F.col("one"), "unmatched").otherwise("multi")
    return rows.select("pair_id", "mate", "lane", "ordinal", "chr", "strand", "start", "end", route.alias("route"))


def pseudogene_pairs(maps: DataFrame) -> DataFrame:
    """Pairs of which some mate has a unique genome hit and also a junction hit."""
    return maps.where((map_class(F.col("genome")) == "unique") & (map_class(F.col("junction")) != "unmapped")).select("pair_id").distinct()


def without_pseudogenes(maps: DataFrame) -> DataFrame:
    """Reads of pairs of which no mate has a unique genome hit and also a junction hit."""
    return maps.join(pseudogene_pairs(maps), "pair_id", "left_anti")


def combined_rounds(rounds: DataFrame) -> DataFrame:
    """One row per read over the rounds of trimming: mapped ones before others, then the longest, then the earliest round."""
    rank = F.struct((map_class(F.col("strata")) != "unmapped").alias("m"), F.col("length"), (-F.col("round")).alias("r"))
    best = rounds.groupBy("pair_id", "mate").agg(F.max_by(F.struct("round", "length", "strata"), rank).alias("best"))
    return best.select("pair_id", "mate", *[F.col("best")[c].alias(c) for c in ("round", "length", "strata")])
