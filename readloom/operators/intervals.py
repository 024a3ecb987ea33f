"""Interval operators. Intervals are 1-based and closed; touching ones do not overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the narrowest bins of interval joins, in bases; those of each further level are _FACTOR times as wide.
BIN = 1000
_FACTOR, _LEVELS = 16, 8
#: Width of the bins of merges.
MERGE_BIN = 1 << 17


def _touched(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / F.col("_w")), F.floor(F.col(end) / F.col("_w")))))


def _leveled(reads: DataFrame, features: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with _w, a width of bins: a feature has the least one that is not less than its length, a read has each that occurs.

    The widths that occur (eight at most) are asked for first, so that reads are
    looked up no oftener than the lengths of the features require: once where
    all are exons of up to ``width`` bases.
    """
    widths = [width * _FACTOR**k for k in range(_LEVELS)]
    length = F.col("f_end") - F.col("f_start") + 1
    fit = F.coalesce(*[F.when(length <= w, F.lit(w)) for w in widths[:-1]], F.when(length.isNotNull(), F.lit(widths[-1])))
    features = features.withColumn("_w", fit.cast("long")).where("_w is not null")
    found = sorted(r[0] for r in features.select("_w").distinct().collect()) or widths[:1]
    asked = F.array(*[F.lit(w).cast("long") for w in found])
    return reads.withColumn("_w", asked[0] if len(found) == 1 else F.explode(asked)), features


def contained_in(reads: DataFrame, features: DataFrame, width: int = BIN) -> DataFrame:
    """Reads (chr, start, end) that lie wholly in features (chr, f_start, f_end, more).

    Features are listed in bins not narrower than they are, so in two at most
    however long they are, and a read is looked up in the bin of its start
    alone, once for each width. No pair comes twice and this is an equi-join.
    Callers sum up equal places first, so a bin holds no more rows than places;
    what is skewed beyond that is split by the adaptive join. Rows with a null
    place meet nothing.
    """
    left, right = _leveled(reads, features, width)
    left = left.withColumn("_bin", F.floor(F.col("start") / F.col("_w")))
    return left.join(_touched(right, "f_start", "f_end"), ["chr", "_w", "_bin"]).where("start >= f_start and end <= f_end").drop("_bin", "_w")


def overlapping(reads: DataFrame, features: DataFrame, width: int = BIN, keys: tuple[str, ...] = ("chr",)) -> DataFrame:
    """Pairs that share a base and ``keys`` (add strand for stranded libraries).

    Bins are those of contained_in(), a read is looked up in all that it
    touches, and a pair is kept in the first bin that both touch.
    """
    left, right = _leveled(reads, features, width)
    pairs = _touched(left, "start", "end").join(_touched(right, "f_start", "f_end"), [*keys, "_w", "_bin"])
    first = F.col("_bin") == F.floor(F.greatest("start", "f_start") / F.col("_w"))
    return pairs.where(first & F.expr("start <= f_end and end >= f_start")).drop("_bin", "_w")


def merged(df: DataFrame, keys: list[str], aggregates: list[Column], width: int = MERGE_BIN, again: list[Column] | None = None) -> DataFrame:
    """Merge overlapping intervals (start, end) within ``keys`` into disconnected ranges.

    A new range begins where the start is beyond the greatest end so far. Rows
    are shuffled once, to bins of ``width`` bases by their start; one that
    reaches over is listed in the further bins too, where it only tells how far
    the range before goes. In a bin equal intervals are summed up and ranges
    made; those that reach into it or out of it, two a bin at most, are merged
    in one window a group. ``again`` puts the ``aggregates`` of parts together
    under the same names; without it they are added. No task holds more of a
    chromosome than a bin. Rows without a start are left out.
    """
    first = F.floor(F.col("start") / width)
    further = F.greatest(F.floor(F.col("end") / width) - first, F.lit(0))
    listed = df.where("start is not null").withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), further)))
    # The end is shuffled as a length and the bin not at all, as both would be most of a row.
    short = listed.withColumn("end", F.col("end") - F.col("start")).repartition(*keys, first + F.col("_k"))
    placed = short.withColumn("_bin", first + F.col("_k")).withColumn("end", (F.col("start") + F.col("end")).cast(df.schema["end"].dataType))
    at = placed.groupBy(*keys, "_bin", "start", "end").agg(*aggregates)
    names = at.columns[len(keys) + 3 :]
    again = again or [F.sum(c).alias(c) for c in names]
    order = Window.partitionBy(*keys, "_bin").orderBy("start", "end")
    so_far = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    here = F.col("start") >= F.col("_bin") * width
    new = at.withColumn("_new", F.when(~here | (F.col("start") <= so_far), 0).otherwise(1))
    grouped = new.withColumn("_own", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(here)
    parts = grouped.groupBy(*keys, "_bin", "_own").agg(F.min("start").alias("start"), F.max("end").alias("end"), *again)
    over = (F.col("_own") == 0) | F.coalesce(F.col("end") >= (F.col("_bin") + 1) * width, F.lit(False))
    columns = [*keys, "start", "end", *names]
    return parts.where(~over).select(columns).unionByName(merged_groups(parts.where(over), keys, again).select(columns))


def merged_groups(df: DataFrame, keys: list[str], aggregates: list[Column]) -> DataFrame:
    """As merged(), in one window a group: for groups that are small, as the exons of a gene."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    new = F.when(F.col("start") <= F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), 0).otherwise(1)
    grouped = df.withColumn("_new", new).withColumn("_range", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*keys, "_range").agg(F.min("start").alias("start"), F.max("end").alias("end"), *aggregates).drop("_range")


def strand_of(strand: str) -> Column:
    """The common strand of a group, or '.' if it is mixed."""
    return F.when(F.min(strand) == F.max(strand), F.min(strand)).otherwise(F.lit(".")).alias("strand")


def gene_projections(exons: DataFrame) -> DataFrame:
    """Disconnected exon ranges of each gene and chromosome; strand '.' if mixed."""
    return merged_groups(exons, ["gene_id", "chr"], [strand_of("strand"), F.count(F.lit(1)).alias("exons")])


def projected_lengths(exons: DataFrame) -> DataFrame:
    """Bases of each gene's projections."""
    return gene_projections(exons).groupBy("gene_id").agg(F.sum(F.expr("end - start + 1")).alias("length"))


def read_clusters(reads: DataFrame, threshold: int) -> DataFrame:
    """Ranges of overlapping reads by sample and chromosome with at least ``threshold`` reads."""
    least, most, included = F.min("strand").alias("s1"), F.max("strand").alias("s2"), F.count(F.lit(1)).alias("included")
    again = [F.min("s1").alias("s1"), F.max("s2").alias("s2"), F.sum("included").alias("included")]
    found = merged(reads.select("sample", "chr", "start", "end", "strand"), ["sample", "chr"], [least, most, included], again=again)
    strand = F.when(F.col("s1") == F.col("s2"), F.col("s1")).otherwise(F.lit(".")).alias("strand")
    return found.where(F.col("included") >= threshold).select("sample", "chr", "start", "end", strand, "included")


def overlap_counts(exons: DataFrame) -> DataFrame:
    """For each distinct exon the number of other exons that overlap it."""
    one = exons.select("exon_id", "chr", "start", "end").distinct()
    other = one.select(F.col("exon_id").alias("other"), "chr", F.col("start").alias("f_start"), F.col("end").alias("f_end"))
    pairs = overlapping(one, other).groupBy("exon_id").agg((F.count(F.lit(1)) - 1).alias("overlaps"))
    return pairs
