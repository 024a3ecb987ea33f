"""Counts, RPKM, detection and summaries of expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.text import rounded
from readloom.operators.intervals import contained_in, overlapping, projected_lengths


def with_multiplicity(alignments: DataFrame, keys: tuple[str, ...] = ("read_id", "read_no")) -> DataFrame:
    """Add nh, the rows that share ``keys`` (a read's alignments), and unique (nh = 1)."""
    own = Window.partitionBy(*keys)
    return alignments.withColumn("nh", F.count(F.lit(1)).over(own)).withColumn("unique", F.col("nh") == 1)


def unique_alignments(alignments: DataFrame) -> DataFrame:
    """The alignments of reads that have one, with their columns.

    Reads are counted by their keys alone, which hashes and sums up before the
    shuffle, and the alignments of those that occur once are picked by a semi
    join; a read with very many alignments is one row of the counts and meets
    nothing. Null keys are keys like others.
    """
    once = alignments.groupBy(F.col("read_id").alias("_id"), F.col("read_no").alias("_no")).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
    return alignments.join(once, F.expr("read_id <=> _id and read_no <=> _no"), "left_semi")


def places(alignments: DataFrame) -> DataFrame:
    """Alignments summed up by place: sample, chr, start, end, strand and their number n."""
    return alignments.groupBy("sample", "chr", "start", "end", "strand").agg(F.count(F.lit(1)).alias("n"))


def unique_maps(unique: DataFrame) -> DataFrame:
    """How many of these uniquely mapped reads each sample has."""
    return unique.groupBy("sample").agg(F.count(F.lit(1)).alias("unique_maps"))


def maps_at(at: DataFrame) -> DataFrame:
    """unique_maps() from the places() of the unique alignments, which are then not made twice."""
    return at.groupBy("sample").agg(F.sum("n").alias("unique_maps"))


def counts_at(at: DataFrame, features: DataFrame, feature: str) -> DataFrame:
    """Forward, reverse and all reads of places() inside each feature, by sample."""
    joined = contained_in(at, features)
    by_strand = lambda s: F.sum(F.when(F.col("strand") == s, F.col("n")).otherwise(0))
    return joined.groupBy(feature, "sample").agg(by_strand("+").alias("forward"), by_strand("-").alias("reverse"), F.sum("n").alias("reads"))


def containment_counts(alignments: DataFrame, features: DataFrame, feature: str) -> DataFrame:
    """Forward, reverse and all reads inside each feature, by sample.

    Alignments at one place are summed up before the join: deep coverage of a
    few features then costs no more than their distinct places.
    """
    return counts_at(places(alignments), features, feature)


def exon_rpkm(counts: DataFrame, lengths: DataFrame, maps: DataFrame) -> DataFrame:
    """reads * 1e9 / (length * unique maps) by exon and sample, three decimals, zeros dropped."""
    joined = counts.join(lengths, "exon_id").join(F.broadcast(maps), "sample")  # a row a sample
    value = rounded(F.col("reads") * 1000000000.0 / (F.col("length") * F.col("unique_maps")), 3)
    return joined.select("exon_id", "sample", value.alias("rpkm")).where("rpkm > 0")


def gene_rpkm(exon_counts: DataFrame, junction_counts: DataFrame, exons: DataFrame, maps: DataFrame) -> DataFrame:
    """1e9 * (exon reads + junction reads) / (projected length * unique maps), zeros dropped."""
    both = exon_counts.select("gene_id", "sample", "reads").unionByName(junction_counts.select("gene_id", "sample", "reads"))
    total = both.groupBy("gene_id", "sample").agg(F.sum("reads").alias("reads"))
    joined = total.join(projected_lengths(exons), "gene_id").join(F.broadcast(maps), "sample")  # a row a sample
    value = rounded(F.col("reads") * 1000000000.0 / (F.col("length") * F.col("unique_maps")), 3)
    return joined.select("gene_id", "sample", "reads", value.alias("rpkm")).where("rpkm > 0")


def read_classes(alignments: DataFrame, exons: DataFrame) -> DataFrame:
    """Exonic, intronic and intergenic alignments by sample; a read is the first of these that it touches."""
    counted = alignments.groupBy("chr", "start", "end", "sample").agg(F.count(F.lit(1)).alias("n"))
    places = counted.groupBy("chr", "start", "end").agg(F.collect_list(F.struct("sample", "n")).alias("by_sample"))
    exon_features = exons.select("chr", F.col("start").alias("f_start"), F.col("end").alias("f_end")).distinct()
    genes = exons.groupBy("gene_id", "chr").agg(F.min("start").alias("f_start"), F.max("end").alias("f_end")).drop("gene_id").distinct()
    both = exon_features.withColumn("rank", F.lit(1)).unionByName(genes.withColumn("rank", F.lit(2)))
    touched = overlapping(places, both).select("chr", "start", "end", "by_sample", "rank")
    ranked = touched.unionByName(places.withColumn("rank", F.lit(3))).groupBy("chr", "start", "end").agg(F.min("rank").alias("rank"), F.first("by_sample").alias("by_sample"))
    kind = F.element_at(F.array(F.lit("exonic"), F.lit("intronic"), F.lit("intergenic")), F.col("rank"))
    counts = ranked.select(kind.alias("class"), F.explode("by_sample").alias("s")).groupBy(F.col("s.sample").alias("sample"), "class").agg(F.sum("s.n").alias("reads"))
    all_ = F.sum("reads").over(Window.partitionBy("sample"))  # three rows a sample
    return counts.withColumn("percent", rounded(F.col("reads") * 100.0 / all_, 2))


def exact_sum(column: str) -> Column:
    """The sum of a column in millionths, which does not depend on the order in which rows arrive (null: no values)."""
    return F.sum(F.col(column).cast("decimal(28,6)"))


def transcript_to_gene(transcripts: DataFrame) -> DataFrame:
    """Sum transcript rpkm by gene and sample, two decimals."""
    return transcripts.groupBy("gene_id", "sample").agg(rounded(exact_sum("rpkm").cast("double"), 2).alias("rpkm"))


def transcript_to_exon(transcripts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Sum the rpkm of all transcripts that hold an exon, two decimals."""
    joined = transcripts.join(bridge, ["gene_id", "transcript_id"])
    return joined.groupBy("exon_id", "sample").agg(rounded(exact_sum("rpkm").cast("double"), 2).alias("rpkm"))


def detected_features(values: DataFrame, about: DataFrame, feature: str, threshold: float = 1.0) -> DataFrame:
    """Features of ``rpkm`` >= threshold by sample, status and type, and all of them in one row of nulls.

    ``about`` has a status and type for each feature. The total counts (sample, feature) pairs.
    """
    kept = values.where(F.col("rpkm") >= threshold).join(about.select(feature, "status", "type"), feature)
    return kept.groupingSets([["sample", "status", "type"], []], "sample", "status", "type").agg(F.count(F.lit(1)).alias("detected"))


def rpkm_histogram(values: DataFrame) -> DataFrame:
    """Features by sample and rpkm rounded to a whole number; zeros are dropped."""
    binned = values.withColumn("bin", F.floor(F.col("rpkm") + 0.5)).where("bin > 0")
    return binned.groupBy("sample", "bin").agg(F.count(F.lit(1)).alias("features"))


def expression_summary(values: DataFrame, feature: str, annotated: DataFrame, min_rpkm: float | None = None) -> DataFrame:
    """Distinct detected features by sample and over all samples (sample null), beside those of ``annotated`` and in percent."""
    kept = values if min_rpkm is None else values.where(F.col("rpkm") >= min_rpkm)
    one = annotated.agg(F.countDistinct(feature).alias("annotated"))
    out = kept.rollup("sample").agg(F.countDistinct(feature).alias("detected")).crossJoin(F.broadcast(one))  # one row
    return out.withColumn("percent", rounded(F.col("detected") * 100.0 / F.col("annotated"), 2))


def saturation(detected: DataFrame, feature: str, lane: str, annotated: DataFrame) -> DataFrame:
    """Features seen in lanes up to each, in lane order: those new in it, summed up, and their share of ``annotated``.

    There is a row for each lane that has a feature's first sighting or any other.
    """
    first = detected.groupBy(feature).agg(F.min(lane).alias(lane)).groupBy(lane).agg(F.count(F.lit(1)).alias("new"))
    lanes = detected.select(lane).distinct().join(first, lane, "left").select(lane, F.coalesce("new", F.lit(0)).alias("new"))
    upto = Window.orderBy(lane).rowsBetween(Window.unboundedPreceding, 0)  # a row a lane
    one = annotated.agg(F.countDistinct(feature).alias("_all"))
    out = lanes.withColumn("cumulative", F.sum("new").over(upto)).crossJoin(F.broadcast(one))  # one row
    return out.withColumn("fraction", rounded(F.col("cumulative") / F.col("_all"), 3)).drop("_all")


def matrix(values: DataFrame, feature: str, samples: list[str], value: str = "rpkm") -> DataFrame:
    """A row a feature and a column a sample, zero where absent. Samples are named, so no extra job."""
    return values.groupBy(feature).pivot("sample", samples).agg(F.sum(value)).na.fill(0, samples)


def canberra(values: DataFrame, feature: str, samples: list[str], value: str = "rpkm") -> DataFrame:
    """Canberra distance of each pair of samples over all features; 0/0 terms are left out.

    One pass over the matrix: the pairs are columns, no self-join is needed.
    """
    wide = matrix(values, feature, samples, value)
    pairs = [(a, b) for i, a in enumerate(samples) for b in samples[i + 1 :]]
    term = lambda a, b: F.when(F.col(a) + F.col(b) > 0, F.abs(F.col(a) - F.col(b)) / (F.col(a) + F.col(b))).otherwise(0.0)
    sums = wide.agg(*[F.sum(term(a, b)).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("sample1"), F.lit(b).alias("sample2"), F.col(f"{a}|{b}").alias("distance")) for a, b in pairs]))
    return sums.select(rows.alias("r")).select("r.*")


def coverage_profile(reads: DataFrame, step: int = 2) -> DataFrame:
    """Positions of reads along their transcripts in percent, by lane and length class, and over all classes.

    Every ``step``-th base of a read (start, end) counts once. Percentages are
    rounded to two decimals and then to whole ones. Equal reads are summed up
    before their bases are listed.
    """
    n = F.col("length")
    size = F.when(n < 1000, "1_999").when(n < 3000, "1000_2999").when(n < 6000, "3000_5999").when(n < 9000, "6000_8999").otherwise("9000_n")
    one = reads.where(n > 0).groupBy("lane", "length", "start", "end").agg(F.count(F.lit(1)).alias("n"))
    bases = one.select("lane", "length", "n", F.explode(F.sequence("start", "end", F.lit(step).cast("long"))).alias("pos"))
    percent = F.expr("((pos * 20000 + length) div (2 * length) + 50) div 100")
    rows = bases.groupBy("lane", size.alias("class"), percent.alias("percent")).agg(F.sum("n").alias("n"))
    return rows.select("lane", F.explode(F.array("class", F.lit("All"))).alias("class"), "percent", "n").groupBy("lane", "class", "percent").agg(F.sum("n").alias("bases"))
