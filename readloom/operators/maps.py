"""Match strata, best maps, pairs. Strata are texts such as 0:1:3, counts of hits by mismatches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.text import best_stratum, map_class


def mapping_stats(maps: DataFrame, strata: str) -> DataFrame:
    """Total, mapped, unique and exact unique (1:0:0) reads by lane."""
    kind = map_class(F.col(strata))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return maps.groupBy("lane").agg(
        F.count(F.lit(1)).alias("total"), count(kind != "unmapped").alias("mapped"), count(kind == "unique").alias("unique_reads"), count(F.col(strata).rlike("^1(:0)*$")).alias("exact")
    )


def best_map(maps: DataFrame) -> DataFrame:
    """The source that a read's map is taken from.

    Genome or junctions by the lower stratum (the genome wins ties), else the
    split map, else the recursive one, else the genome's empty row.
    """
    g, j = best_stratum(F.col("genome")), best_stratum(F.col("junction"))
    mapped = lambda c: map_class(F.col(c)) != "unmapped"
    source = (
        F.when(g.isNotNull() & (j.isNull() | (g <= j)), "genome").when(j.isNotNull(), "junction")
        .when(mapped("split"), "split").when(mapped("recursive"), "recursive").otherwise("genome")
    )
    out = maps.withColumn("source", source)
    pick = F.coalesce(*[F.when(F.col("source") == s, F.col(s)) for s in ("genome", "junction", "split", "recursive")])
    return out.select("pair_id", "mate", "lane", "source", pick.alias("strata"))


def pair_classes(best: DataFrame) -> DataFrame:
    """Pairs whose mates are all unique, all unmapped, or otherwise multi, by lane."""
    kind = map_class(F.col("strata"))
    flags = best.groupBy("lane", "pair_id").agg(F.min(kind == "unique").alias("u"), F.min(kind == "unmapped").alias("n"))
    return flags.groupBy("lane", F.when(F.col("u"), "unique").when(F.col("n"), "unmapped").otherwise("multi").alias("class")).agg(F.count(F.lit(1)).alias("pairs"))


def best_map_of(**sources: DataFrame) -> DataFrame:
    """best_map() of the maps genome, junction, split and recursive, each of its own reads (pair_id, mate, lane, strata)."""
    joined = None
    for name, m in sources.items():
        one = m.select("pair_id", "mate", "lane", F.col("strata").alias(name))
        joined = one if joined is None else joined.join(one, ["pair_id", "mate", "lane"], "full")
    return best_map(joined)


def unmapped_in_both(genome: DataFrame, junction: DataFrame) -> DataFrame:
    """Reads of the genome maps without a hit there or in the junction maps (where a read may be missing)."""
    mapped = junction.where(map_class(F.col("strata")) != "unmapped").select("pair_id", "mate")
    return genome.where(map_class(F.col("strata")) == "unmapped").join(mapped, ["pair_id", "mate"], "left_anti").select("pair_id", "mate", "lane")
