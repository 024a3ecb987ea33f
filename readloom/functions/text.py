"""Columns over read ids, sequences, strata and cigars, and numbers rounded alike everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """floor(x * 10**digits + 0.5) / 10**digits: the same in every engine for x >= 0."""
    return F.floor(x * float(10**digits) + 0.5) / float(10**digits)


def clean_id(read_id: Column) -> Column:
    """|p1 and |p2 become /1 and /2; ' 1:' style mates become _X: with /1 or /2 at the end."""
    out = F.regexp_replace(read_id, r"\|p([12])$", "/$1")
    return F.regexp_replace(out, r"^(\S+) ([12]):(.*)$", "$1_X:$3/$2")


def ambiguous(seq: Column) -> Column:
    """Bases N or '.' of a sequence."""
    return F.length(seq) - F.length(F.regexp_replace(seq, "[N.]", ""))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def map_class(strata: Column) -> Column:
    """unmapped, unique or multi, by the first stratum that is not 0; '-' and '!' do not count as mapped."""
    return (
        F.when(strata.isNull() | strata.rlike("^(0(:0)*|-.*|(0:)*!.*)$"), "unmapped")
        .when(strata.rlike("^(0:)*1(:|$)"), "unique")
        .otherwise("multi")
    )


def best_stratum(strata: Column) -> Column:
    """Mismatches of the first stratum that is not 0, or null."""
    first = F.regexp_extract(strata, "^((?:0:)*)[1-9]", 1)
    return F.when(map_class(strata) != "unmapped", F.length(first) / 2).cast("int")


def gaps(start: Column, cigar: Column) -> Column:
    """The gaps (N) of an alignment as an array of (j_start, j_end): the bases before and behind each."""
    steps = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)([MDNX=])"), F.lit(0)), lambda s: F.struct(F.regexp_extract(s, r"\d+", 0).cast("long").alias("n"), F.right(s, F.lit(1)).alias("op")))
    zero = F.struct(start.cast("long").alias("at"), F.array().cast("array<struct<j_start:bigint,j_end:bigint>>").alias("found"))

    def step(s: Column, x: Column) -> Column:
        gap = F.array(F.struct((s["at"] - 1).alias("j_start"), (s["at"] + x["n"]).alias("j_end")))
        return F.struct((s["at"] + x["n"]).alias("at"), F.when(x["op"] == "N", F.concat(s["found"], gap)).otherwise(s["found"]).alias("found"))

    return F.aggregate(steps, zero, step)["found"]


def read_length(cigar: Column) -> Column:
    """Bases of the read that an alignment's cigar spells out."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIX=S]"), F.lit(1)), F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def natural_chromosome(chrom: Column) -> list[Column]:
    """Sort keys: chromosome numbers first and by value, then names."""
    name = F.regexp_replace(chrom, "^chr", "")
    number = F.when(name.rlike("^[0-9]+$"), name.cast("int"))
    return [number.asc_nulls_last(), name.asc()]
