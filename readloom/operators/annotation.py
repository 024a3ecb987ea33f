"""Annotation tables: genes, transcripts, counts by type, contigs, top features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.operators.expression import matrix
from readloom.operators.intervals import strand_of

#: Names of contigs that stand beside the chromosomes.
_ALTERNATE = r"hap|^chrU|^Un\.|^(chr)?HSCHR|^AAFC03011182"


def gene_table(genes: DataFrame) -> DataFrame:
    """gene_id, type, status, name, description and chr; an unknown type is ``gene``, an unknown status ``unknown``."""
    return genes.select(
        "gene_id", F.coalesce("gene_type", F.lit("gene")).alias("type"), F.coalesce("gene_status", F.lit("unknown")).alias("status"),
        F.col("gene_name").alias("name"), "description", "chr",
    )


def transcript_table(features: DataFrame, genes: DataFrame) -> DataFrame:
    """transcript_id, gene_id, chr, and the type and status of the gene, for features of type transcript."""
    rows = features.where(F.col("type") == "transcript").select("transcript_id", "gene_id", "chr")
    return rows.join(gene_table(genes).select("gene_id", "type", "status"), "gene_id", "left").select(
        "transcript_id", "gene_id", "chr", F.coalesce("type", F.lit("transcript")).alias("type"), F.coalesce("status", F.lit("unknown")).alias("status")
    )


def of_type(features: DataFrame, kind: str) -> DataFrame:
    """Features of one type."""
    return features.where(F.col("type") == kind)


def type_counts(features: DataFrame) -> DataFrame:
    """Features by type."""
    return features.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def on_chromosomes(features: DataFrame) -> DataFrame:
    """Features that do not lie on an alternate or unplaced contig."""
    return features.where(~F.col("chr").rlike(_ALTERNATE))


def without_ribosomal(values: DataFrame, genes: DataFrame) -> DataFrame:
    """Values of genes that are neither mitochondrial nor ribosomal; genes without an entry stay."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    bad = text("chr").contains("chrM") | F.lower(text("description")).rlike("ribosom(e|al)") | text("type").startswith("rRNA")
    return values.join(gene_table(genes).where(bad).select("gene_id"), "gene_id", "left_anti")


def loci(features: DataFrame, feature: str) -> DataFrame:
    """Length, strand ('.' if mixed) and chromosome of each feature, over all its rows."""
    return features.groupBy(feature).agg((F.max("end") - F.min("start") + 1).alias("length"), strand_of("strand"), F.min("chr").alias("locus"))


def top_features(values: DataFrame, feature: str, samples: list[str], about: DataFrame) -> DataFrame:
    """Features with a value of 1 or more when rounded, their description, values by sample and total.

    Rounded values below 1 count as 0.
    """
    kept = values.withColumn("rpkm", F.floor(F.col("rpkm") + 0.5)).where("rpkm >= 1")
    wide = matrix(kept, feature, samples)
    return wide.withColumn("total", sum((F.col(s) for s in samples), F.lit(0))).join(about, feature)


def top_genes(values: DataFrame, samples: list[str], exons: DataFrame, bridge: DataFrame) -> DataFrame:
    """top_features() of genes with length, strand, locus, exons and transcripts."""
    about = loci(exons, "gene_id").join(exons.groupBy("gene_id").agg(F.countDistinct("exon_id").alias("exons")), "gene_id")
    about = about.join(bridge.groupBy("gene_id").agg(F.countDistinct("transcript_id").alias("transcripts")), "gene_id", "left").na.fill(0, ["transcripts"])
    return top_features(values, "gene_id", samples, about)


def with_rpkm(lines: DataFrame, values: DataFrame, feature: str | list[str], line: Column) -> DataFrame:
    """Annotation lines of features (one column or several) that have a value, with it as a further attribute."""
    return lines.join(values.where("rpkm > 0"), feature).select(F.concat(line, F.lit(' RPKM "'), F.col("rpkm").cast("string"), F.lit('";')).alias("value"))
