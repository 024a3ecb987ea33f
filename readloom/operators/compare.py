"""Comparing experiments: replicates, groups, matched values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replicate_groups(experiments: DataFrame) -> DataFrame:
    """Groups of one project, cell, molecule type and compartment with exactly two replicates."""
    keys = ["project_id", "cell_type", "rna_type", "compartment"]
    return experiments.groupBy(*keys).agg(F.countDistinct("bioreplicate").alias("replicates"), F.count(F.lit(1)).alias("experiments")).where("replicates = 2")


def matched(one: DataFrame, two: DataFrame, feature: str, value: str) -> DataFrame:
    """Values of two replicates side by side; absent or zero is -1."""
    a = one.select(feature, F.col(value).alias("score1"))
    b = two.select(feature, F.col(value).alias("score2"))
    fill = lambda c: F.when(F.coalesce(F.col(c), F.lit(0.0)) == 0, F.lit(-1.0)).otherwise(F.col(c)).alias(c)
    return a.join(b, feature, "full").select(feature, fill("score1"), fill("score2"))


def score_categories(pairs: DataFrame) -> DataFrame:
    """How often each pair of scores occurs."""
    return pairs.groupBy("score1", "score2").agg(F.count(F.lit(1)).alias("n"))


def detection(values: DataFrame, feature: str, lanes: int, threshold: float) -> DataFrame:
    """Lanes that reach the threshold, the greatest value, and the mean over all lanes with zeros filled in."""
    out = values.groupBy(feature).agg(F.sum(F.when(F.col("rpkm") >= threshold, 1).otherwise(0)).alias("lanes"), F.max("rpkm").alias("most"), F.sum("rpkm").alias("_s"))
    return out.withColumn("mean", F.col("_s") / F.lit(lanes)).drop("_s")


def individual_features(values: DataFrame, features: DataFrame, feature: str, samples: list[str]) -> DataFrame:
    """A row for each feature asked for and sample; 0 where there is no value."""
    asked = features.select(feature).distinct().select(feature, F.explode(F.array(*map(F.lit, samples))).alias("sample"))
    return asked.join(values.select(feature, "sample", "rpkm"), [feature, "sample"], "left").select(feature, "sample", F.coalesce("rpkm", F.lit(0)).alias("rpkm"))


def experiment_totals(lane_stats: DataFrame, experiment_of_lane) -> DataFrame:
    """Sums of the lanes' total, mapped and unique reads by experiment."""
    return lane_stats.groupBy(experiment_of_lane.alias("experiment")).agg(*[F.sum(c).alias(c) for c in ("total", "mapped", "unique_reads")])


def annotation_checks(features: DataFrame, least_exons: int = 10_000) -> DataFrame:
    """Features by type and whether there are suspiciously few: exons below ``least_exons``, others none."""
    counts = features.groupBy("type").agg(F.count("id").alias("n"))
    return counts.withColumn("suspect", F.when(F.col("type") == "exon", F.col("n") < least_exons).otherwise(F.col("n") < 1))


def mapping_losses(stats: DataFrame, stages: list[str], key: str = "lane") -> DataFrame:
    """Each stage's count, its percent of the first stage, and what is lost (count, percent points) before the next one.

    Nothing comes after the last stage, so all of it counts as its loss.
    """
    rows = []
    for k, name in enumerate(stages):
        here, after = F.col(name), F.col(stages[k + 1]) if k + 1 < len(stages) else F.lit(0)
        whole = F.when(F.col(stages[0]) > 0, F.col(stages[0]))
        rows.append(F.struct(F.lit(name).alias("stage"), here.alias("n"), (here * 100.0 / whole).alias("percent"), (here - after).alias("lost"), ((here - after) * 100.0 / whole).alias("percent_lost")))
    return stats.select(key, F.explode(F.array(*rows)).alias("r")).select(key, "r.*")


def detected_by_lane(**features: DataFrame) -> DataFrame:
    """Distinct features of each kind by lane; each table has lane and feature."""
    out = None
    for kind, rows in features.items():
        one = rows.groupBy("lane").agg(F.countDistinct("feature").alias("detected")).withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


def detection_by_lane(values: DataFrame, feature: str, lanes: list[str], threshold: float) -> DataFrame:
    """detection() with a column of values for each lane, zeros filled in."""
    cells = [F.coalesce(F.sum(F.when(F.col("sample") == s, F.col("rpkm"))), F.lit(0)).alias(s) for s in lanes]
    wide = values.groupBy(feature).agg(*cells, F.sum(F.when(F.col("rpkm") >= threshold, 1).otherwise(0)).alias("lanes"), F.max("rpkm").alias("most"), F.sum("rpkm").alias("_s"))
    return wide.withColumn("mean", F.col("_s") / F.lit(len(lanes))).drop("_s")


def of_samples(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """Values of the samples that ``wanted`` lists."""
    return values.join(wanted.select("sample").distinct(), "sample", "left_semi")


def read_differences(reads: DataFrame, mapped: DataFrame) -> DataFrame:
    """Lanes whose mapped reads are absent or not as many as their reads (lane, n)."""
    both = reads.select("lane", F.col("n").alias("existing")).join(mapped.select("lane", F.col("n").alias("mapped")), "lane", "left")
    bad = both.where(F.col("mapped").isNull() | (F.col("mapped") != F.col("existing")))
    return bad.select("lane", "existing", "mapped", F.when(F.col("mapped").isNull(), "absent").otherwise("different").alias("problem"))


def unequal_mates(reads: DataFrame) -> DataFrame:
    """Pairs of lanes (pair, lane, n) of unequal counts, and pairs that have more than two lanes."""
    by = reads.groupBy("pair").agg(F.count(F.lit(1)).alias("lanes"), F.min("n").alias("least"), F.max("n").alias("most"))
    return by.where("lanes > 2 or least <> most")


def with_idr(matched_pairs: DataFrame, rates: DataFrame) -> DataFrame:
    """Matched scores with the rate of their pair of scores, null where it has none."""
    return matched_pairs.join(rates.select("score1", "score2", "idr"), ["score1", "score2"], "left")


def expressed_with_gene(transcripts: DataFrame, genes: DataFrame) -> DataFrame:
    """Transcripts of positive expression with their gene; those without a gene go."""
    return transcripts.where("rpkm > 0").join(genes.select("transcript_id", "gene_id").distinct(), "transcript_id")


def novel_transcripts(assembled: DataFrame) -> DataFrame:
    """Assembled transcripts of positive expression: gene, transcript, fpkm, lane."""
    return assembled.where((F.col("type").contains("transcript")) & (F.col("fpkm") > 0)).select("gene_id", "transcript_id", "fpkm", "lane")
