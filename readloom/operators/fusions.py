"""Fusion candidates, the reads behind them, and links of clusters by split fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.text import map_class

#: Width of the bins in which fragments meet clusters, in bases.
_BIN = 8192


def fusion_candidates(transcript_maps: DataFrame, genome_maps: DataFrame, genes: DataFrame, gene_rpkm: DataFrame) -> DataFrame:
    """Pairs whose mates are unique on two transcripts and map to the genome just as well.

    Fusion if the genes differ, else Variant; with each gene's expression, 0
    where it has none.
    """
    same = transcript_maps.where(map_class(F.col("strata")) == "unique").join(genome_maps.select("pair_id", "mate", "strata", "mismatches"), ["pair_id", "mate", "strata", "mismatches"])
    placed = same.select("pair_id", "mate", "transcript_id").join(genes, "transcript_id").join(gene_rpkm, "gene_id", "left")
    # A mate that is unique has one transcript, but rows may repeat: each mate's list is small.
    of = F.struct(F.col("transcript_id"), F.col("gene_id"), F.coalesce("rpkm", F.lit(0)).alias("rpkm"))
    both = placed.groupBy("pair_id").agg(*[F.collect_list(F.when(F.col("mate") == m, of)).alias(f"m{m}") for m in (1, 2)])
    pairs = both.select("pair_id", F.explode("m1").alias("a"), "m2").select("pair_id", "a", F.explode("m2").alias("b")).where("a.transcript_id <> b.transcript_id")
    side = lambda x, k: [F.col(f"{x}.{c}").alias(f"{n}{k}") for c, n in (("transcript_id", "transcript"), ("gene_id", "gene"), ("rpkm", "rpkm"))]
    pairs = pairs.select("pair_id", *side("a", 1), *side("b", 2))
    return pairs.withColumn("label", F.when(F.col("gene1") != F.col("gene2"), "Fusion").otherwise("Variant"))


def fusion_hits(hits: DataFrame, candidates: DataFrame) -> DataFrame:
    """Hits of unique reads whose pair is a candidate of two genes."""
    one = hits.groupBy("pair_id", "mate").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("pair_id", "mate")
    return hits.join(one, ["pair_id", "mate"], "left_semi").join(candidates.where("label = 'Fusion'").select("pair_id"), "pair_id", "left_semi")


def cluster_links(fragments: DataFrame, clusters: DataFrame, threshold: int = 5) -> DataFrame:
    """Pairs of clusters that both fragments of at least ``threshold`` reads touch.

    close: both fragments in one cluster; far or interchrom: in two. Reads that
    touch more clusters do not count. ``fragments`` has sample, read_id, fragment
    (1, 2), chr, start, end; ``clusters`` sample, chr, start, end. Samples are apart,
    and so are the clusters of a chromosome, so that a cluster can be listed in
    all the bins that it touches. Fragments are shuffled once to these bins, where
    those of a read become one row, and these rows once by read.
    """
    first, last = F.floor(F.col("start") / _BIN), F.floor(F.col("end") / _BIN)
    listed = fragments.select("sample", "read_id", "fragment", "chr", "start", "end", F.explode(F.sequence(F.lit(0).cast("long"), last - first)).alias("_k"))
    # The end is shuffled as a length and the bin not at all, as both would be most of a row.
    near = listed.select("sample", "chr", "start", "read_id", "fragment", "_k", (F.col("end") - F.col("start")).alias("_more")).repartition("sample", "chr", first + F.col("_k"))
    near = near.select("sample", "chr", (first + F.col("_k")).alias("_bin"), "start", (F.col("start") + F.col("_more")).alias("end"), "read_id", "fragment")
    apart = clusters.select("sample", "chr", F.col("start").alias("f_start"), F.col("end").alias("f_end"), F.explode(F.sequence(first, last)).alias("_bin"))
    one_bin = F.col("_bin") == F.floor(F.greatest("start", "f_start") / _BIN)
    touched = near.join(apart.hint("shuffle_hash"), ["sample", "chr", "_bin"]).where(one_bin & F.expr("start <= f_end and end >= f_start"))
    # In a bin the least start and the least end are of the same cluster, as clusters are apart.
    here = touched.groupBy("sample", "chr", "_bin", "read_id").agg(
        F.min("f_start").alias("s1"), F.min("f_end").alias("e1"), F.max("f_start").alias("s2"), F.max("f_end").alias("e2"),
        F.countDistinct("f_start").alias("n"), F.bit_or(F.expr("shiftleft(1L, int(fragment))")).alias("f"),
    )
    rows = here.select("sample", "chr", "read_id", "s1", F.expr("e1 - s1 AS d1"), F.expr("s2 - s1 AS d2"), F.expr("e2 - s2 AS d3"), "n", "f").repartition("sample", "read_id")
    both = F.expr("array(struct(chr, s1 AS start, s1 + d1 AS end), struct(chr, s1 + d2 AS start, s1 + d2 + d3 AS end))")
    reads = rows.groupBy("sample", "read_id").agg(F.max("n").alias("n"), F.bit_count(F.bit_or("f")).alias("f"), F.array_distinct(F.flatten(F.collect_list(both))).alias("c"))
    reads = reads.where("f = 2 and n <= 2 and size(c) <= 2").withColumn("names", F.transform("c", lambda x: F.concat_ws("_", x["chr"], x["start"], x["end"])))
    kind = F.when(F.size("c") == 1, "close").when(F.col("c")[0]["chr"] == F.col("c")[1]["chr"], "far").otherwise("interchrom")
    pairs = reads.select("sample", F.array_min("names").alias("cluster1"), F.array_max("names").alias("cluster2"), kind.alias("type"))
    return pairs.groupBy("sample", "cluster1", "cluster2", "type").agg(F.count(F.lit(1)).alias("reads")).where(F.col("reads") >= threshold)
