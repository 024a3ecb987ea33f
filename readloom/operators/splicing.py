"""Exon pairs, junctions, inclusion rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.text import rounded


def shared_exons(exons: DataFrame) -> DataFrame:
    """Exons that belong to more than one gene."""
    return exons.groupBy("exon_id").agg(F.countDistinct("gene_id").alias("genes")).where("genes > 1")


def exon_pairs(exons: DataFrame) -> DataFrame:
    """Ordered pairs of exons of a gene that do not overlap, on one strand; shared exons are left out."""
    own = exons.join(shared_exons(exons), "exon_id", "left_anti")
    one = own.select("gene_id", "chr", "strand", F.col("exon_id").alias("exon1_id"), F.col("end").alias("start"))
    two = own.select("gene_id", "chr", "strand", F.col("exon_id").alias("exon2_id"), F.col("start").alias("end"))
    return one.join(two, ["gene_id", "chr", "strand"]).where("start < end")


def annotated_junctions(exons: DataFrame, bridge: DataFrame) -> DataFrame:
    """Places (chr, start, end) of junctions of consecutive exons of a transcript, distinct; exons that overlap leave none."""
    order = Window.partitionBy("gene_id", "transcript_id", "chr").orderBy("start", "end")
    rows = bridge.select("gene_id", "transcript_id", "exon_id").join(exons, ["gene_id", "exon_id"])
    return rows.withColumn("next", F.lead("start").over(order)).where("next > end").select("gene_id", "chr", F.col("end").alias("start"), F.col("next").alias("end")).distinct()


def transcript_junctions(exons: DataFrame, bridge: DataFrame) -> DataFrame:
    """Consecutive exons of each transcript, in transcript order: on the minus strand the later exon comes first.

    Consecutive exons that overlap make a junction as well.
    """
    order = Window.partitionBy("gene_id", "transcript_id", "chr").orderBy("start", "end")
    rows = bridge.select("gene_id", "transcript_id", "exon_id").join(exons, ["gene_id", "exon_id"]).withColumn("next", F.lead("exon_id").over(order)).where("next is not null")
    minus = F.col("strand") == "-"
    return rows.select("gene_id", "transcript_id", F.when(minus, F.col("next")).otherwise(F.col("exon_id")).alias("exon1_id"), F.when(minus, F.col("exon_id")).otherwise(F.col("next")).alias("exon2_id"))


def junction_catalogue(exons: DataFrame, bridge: DataFrame) -> DataFrame:
    """All possible junctions of each gene, known if some transcript has it, novel otherwise."""
    known = annotated_junctions(exons, bridge).withColumn("_k", F.lit(True))
    joined = exon_pairs(exons).join(known, ["gene_id", "chr", "start", "end"], "left")
    return joined.withColumn("type", F.when(F.col("_k"), "known").otherwise("novel")).drop("_k")


def exclusion_junctions(exons: DataFrame) -> DataFrame:
    """For each exon the distinct junctions of its gene that skip it.

    An exon's junctions are all ends before it times all starts behind it, so
    each gene's distinct ends and starts are gathered (as many as it has exons)
    and every exon takes its own from them: no row is made that isn't returned.
    An exon_id stands for one place.
    """
    gene = ["gene_id", "chr", "strand"]
    places = exons.groupBy(*gene).agg(F.collect_set("end").alias("_ends"), F.collect_set("start").alias("_starts"))
    own = exons.select(*gene, "exon_id", "start", "end").distinct().join(places, gene)
    sides = own.select(
        "gene_id", "exon_id", "chr", F.filter("_ends", lambda x: x < F.col("start")).alias("_ends"), F.filter("_starts", lambda x: x > F.col("end")).alias("_starts")
    ).where("size(_ends) > 0 and size(_starts) > 0")
    return sides.withColumn("j_start", F.explode("_ends")).withColumn("j_end", F.explode("_starts")).select("gene_id", "exon_id", "chr", "j_start", "j_end")


def skipping_junctions(exons: DataFrame, junctions: DataFrame) -> DataFrame:
    """The rows of exclusion_junctions() at the places of ``junctions`` (chr, j_start, j_end), distinct, without the gene.

    Where reads are counted only junctions that have some matter. These are
    found first and then meet the exons of their gene, so the work follows the
    junctions that were seen, not all that a gene could have.
    """
    seen = junctions.select("chr", "j_start", "j_end").distinct()
    gene = ["gene_id", "chr", "strand"]
    one = exons.select(*gene, F.col("end").alias("j_start")).distinct()
    two = exons.select(*gene, F.col("start").alias("j_end")).distinct()
    possible = seen.join(one, ["chr", "j_start"]).join(two, [*gene, "j_end"])
    own = exons.select(*gene, "exon_id", "start", "end").distinct()
    return own.join(possible, gene).where("j_start < start and j_end > end").select("exon_id", "chr", "j_start", "j_end").distinct()


def inclusion_junctions(exons: DataFrame, pairs: DataFrame) -> DataFrame:
    """For each exon the distinct junctions that begin or end with it."""
    ends = F.explode(F.array("exon1_id", "exon2_id")).alias("exon_id")
    return pairs.select(ends, "chr", F.col("start").alias("j_start"), F.col("end").alias("j_end")).distinct()


def inclusion_lengths(pairs: DataFrame, exons: DataFrame) -> DataFrame:
    """inclusion_junctions() with ``length``, the bases of the two exons of each junction; pairs of other exons are rows of their own."""
    size = exons.select("exon_id", F.expr("end - start + 1").alias("length")).distinct()
    sizes = lambda k: size.select(F.col("exon_id").alias(f"exon{k}_id"), F.col("length").alias(f"l{k}"))
    both = pairs.join(sizes(1), "exon1_id").join(sizes(2), "exon2_id")
    ends = F.explode(F.array("exon1_id", "exon2_id")).alias("exon_id")
    return both.select(ends, "chr", F.col("start").alias("j_start"), F.col("end").alias("j_end"), (F.col("l1") + F.col("l2")).alias("length")).distinct()


def inclusion_rates(exon_reads: DataFrame, junctions: DataFrame, included: DataFrame, excluded: DataFrame, maps: DataFrame, read_length: int) -> DataFrame:
    """Inclusion rate of each exon and sample from coverage.

    Exon reads (exon_id, sample, reads, length) count per 1000 bases of the exon.
    A junction's reads are times 1000 over its length: that of its two exons (the
    greatest over the pairs of exons that make it, ``length`` of ``included``),
    twice the read length at most. All three sums are scaled to a million unique
    maps of the sample and rounded to three decimals; the rate of an exon whose
    sums round to 0 is null, that of one without reads has no row.
    """
    key = ["chr", "j_start", "j_end"]
    lengths = included.groupBy(*key).agg(F.max(F.least(F.col("length"), F.lit(2 * read_length))).alias("length"))
    junction = junctions.groupBy(*key, "sample").agg(F.sum("reads").alias("reads")).join(lengths, key).withColumn("x", F.col("reads") * 1000.0 / F.col("length"))
    exon = exon_reads.select("exon_id", "sample", (F.col("reads") * 1000.0 / F.col("length")).alias("x"))
    names = ("ex_incl", "junc_inc", "junc_exc")
    part = lambda df, name: df.select("exon_id", "sample", *[(F.col("x") if n == name else F.lit(0.0)).alias(n) for n in names])
    rows = part(exon, "ex_incl").unionByName(part(included.drop("length").distinct().join(junction, key), "junc_inc")).unionByName(part(excluded.join(junction, key), "junc_exc"))
    total = rows.groupBy("exon_id", "sample").agg(*[F.sum(n).alias(n) for n in names]).join(F.broadcast(maps), "sample")  # a row a sample
    scaled = total.select("exon_id", "sample", *[rounded(F.col(n) * (1000000.0 / F.col("unique_maps")), 3).alias(n) for n in names])
    events = F.col("ex_incl") + F.col("junc_inc") + F.col("junc_exc")
    return scaled.withColumn("psi", F.when(events > 0, rounded((F.col("ex_incl") + F.col("junc_inc")) / events, 3)))


def inclusion_reads(exon_counts: DataFrame, junctions: DataFrame, included: DataFrame, excluded: DataFrame) -> DataFrame:
    """Supporting reads of each exon and sample: exon, inclusion and exclusion junction reads.

    psi is their raw share. An exon and sample without any reads has no row.
    """
    key = ["chr", "j_start", "j_end"]
    j = junctions.groupBy(*key, "sample").agg(F.sum("reads").alias("reads"))
    part = lambda df, name: df.select("exon_id", "sample", *[(F.col("reads") if n == name else F.lit(0).cast("long")).alias(n) for n in ("ex_incl", "junc_inc", "junc_exc")])
    rows = part(exon_counts, "ex_incl").unionByName(part(included.join(j, key), "junc_inc")).unionByName(part(excluded.join(j, key), "junc_exc"))
    total = rows.groupBy("exon_id", "sample").agg(*[F.sum(n).alias(n) for n in ("ex_incl", "junc_inc", "junc_exc")])
    return total.withColumn("psi", (F.col("ex_incl") + F.col("junc_inc")) / (F.col("ex_incl") + F.col("junc_inc") + F.col("junc_exc")))


def inclusion_histogram(rates: DataFrame) -> DataFrame:
    """Exons by sample and psi in hundredths, cut off."""
    return rates.where("psi is not null").groupBy("sample", F.floor(F.col("psi") * 100).alias("bin")).agg(F.count(F.lit(1)).alias("exons"))


def gene_share(junctions: DataFrame) -> DataFrame:
    """Each junction's share of its gene's junction reads (three decimals), by sample."""
    one = junctions.groupBy("gene_id", "sample", "chr", "j_start", "j_end").agg(F.sum("reads").alias("reads"))
    gene = F.sum("reads").over(Window.partitionBy("gene_id", "sample"))
    return one.withColumn("gene_reads", gene).withColumn("share", rounded(F.col("reads") / F.col("gene_reads"), 3))


def junction_exons(junctions: DataFrame, exons: DataFrame) -> DataFrame:
    """The exons that end where a junction starts, and those that start where it ends, ';'-joined, or '-'."""
    listed = lambda c: F.coalesce(F.array_join(F.array_sort(F.collect_set(c)), ";"), F.lit("-"))
    one = exons.groupBy("chr", F.col("end").alias("j_start")).agg(listed("exon_id").alias("exons1"))
    two = exons.groupBy("chr", F.col("start").alias("j_end")).agg(listed("exon_id").alias("exons2"))
    out = junctions.join(one, ["chr", "j_start"], "left").join(two, ["chr", "j_end"], "left")
    return out.na.fill("-", ["exons1", "exons2"])


def classified_junctions(junctions: DataFrame, splits: DataFrame) -> DataFrame:
    """Support by sample of junctions (chr_start_end) and splits (chr1,chr2,start,end); keys of the two never meet."""
    one = junctions.groupBy("sample", F.concat_ws("_", "chr", "j_start", "j_end").alias("key")).agg(F.sum("reads").alias("support")).withColumn("source", F.lit("junction"))
    two = splits.groupBy("sample", F.concat_ws(",", "chr1", "chr2", "start", "end").alias("key")).agg(F.count(F.lit(1)).alias("support")).withColumn("source", F.lit("split"))
    return one.unionByName(two)


def splicing_summary(catalogue: DataFrame, junctions: DataFrame, splits: DataFrame, near: int) -> DataFrame:
    """Known and novel junctions, total and detected, and distinct splits that are not close (within ``near`` bases of one chromosome)."""
    key = ["chr", "start", "end"]
    found = junctions.select("chr", F.col("j_start").alias("start"), F.col("j_end").alias("end"), F.lit(1).alias("_f")).distinct()
    own = catalogue.groupBy(*key).agg(F.min("type").alias("type")).join(found, key, "left")
    counts = own.groupBy("type").agg(F.count(F.lit(1)).alias("total"), F.count("_f").alias("detected"))
    far = splits.where(~((F.col("chr1") == F.col("chr2")) & (F.abs(F.col("end") - F.col("start")) <= near))).select("chr1", "chr2", "start", "end").distinct()
    return counts.unionByName(far.agg(F.lit("split").alias("type"), F.count(F.lit(1)).alias("total"), F.count(F.lit(1)).alias("detected")))


def junction_matrix(junctions: DataFrame, samples: list[str], support: int, least: int) -> DataFrame:
    """Reads of each junction by sample, zeros filled in, for junctions with ``support`` reads in ``least`` samples or more."""
    cells = junctions.groupBy("chr", "j_start", "j_end", "sample").agg(F.sum("reads").alias("reads"))
    wide = [F.coalesce(F.sum(F.when(F.col("sample") == s, F.col("reads"))), F.lit(0)).alias(s) for s in samples]
    out = cells.groupBy("chr", "j_start", "j_end").agg(F.sum(F.when(F.col("reads") >= support, 1).otherwise(0)).alias("_n"), *wide)
    return out.where(F.col("_n") >= least).drop("_n")


def inclusion_pairs(rates: DataFrame, samples: list[str], least: int = 5) -> DataFrame:
    """Distinct rates in percent of every ordered pair of samples over the exons.

    Rates with fewer than ``least`` reads do not count; a sample without one
    stands as 0. Samples are few, so an exon's pairs are made in its own row.
    """
    good = rates.where(F.expr("ex_incl + junc_inc + junc_exc") >= least)
    wide = good.groupBy("exon_id").agg(*[F.coalesce(F.max(F.when(F.col("sample") == s, F.floor(F.col("psi") * 100 + 0.5))), F.lit(0)).alias(s) for s in samples])
    pairs = [F.struct(F.lit(a).alias("sample1"), F.lit(b).alias("sample2"), F.col(a).alias("rate1"), F.col(b).alias("rate2")) for a in samples for b in samples if a != b]
    return wide.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").distinct()


def pooled_junctions(classified: DataFrame, group) -> DataFrame:
    """Support of classified junctions summed up over the samples of each group (a column)."""
    return classified.groupBy(group.alias("group"), "key", "source").agg(F.sum("support").alias("support"))


def split_matrix(splits: DataFrame, samples: list[str], support: int, least: int) -> DataFrame:
    """Reads of each split place and label ``genes`` by sample, for places with ``support`` reads in ``least`` samples or more."""
    key = ["chr1", "start", "chr2", "end", "genes"]
    cells = splits.groupBy(*key, "sample").agg(F.count(F.lit(1)).alias("reads"))
    wide = [F.coalesce(F.sum(F.when(F.col("sample") == s, F.col("reads"))), F.lit(0)).alias(s) for s in samples]
    return cells.groupBy(*key).agg(F.sum(F.when(F.col("reads") >= support, 1).otherwise(0)).alias("_n"), *wide).where(F.col("_n") >= least).drop("_n")
