"""Queries that compare lanes, samples and experiments."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.operators import compare, expression, fusions, hits, intervals, maps, splicing
from readloom.plans.registry import _CLASS, _EC, _EXRPKM, _FUSED, _FUSION_VIEWS, _GRPKM, _U, SAMPLES, _exon_counts, _exon_rpkm, _fusions, _gene_rpkm, _query

_wide = lambda value, kind="": ", ".join(f"coalesce(sum({value}) FILTER (sample = '{s}'), 0){kind} AS {s}" for s in SAMPLES)


@_query("maps", sql=f""", s AS (SELECT lane, count(*) AS total, sum(({_CLASS.format(c="genome")} <> 'unmapped')::INT)::BIGINT AS mapped, sum(({_CLASS.format(c="genome")} = 'unique')::INT)::BIGINT AS unique_reads,
sum(regexp_matches(genome, '^1(:0)*$')::INT)::BIGINT AS exact FROM maps GROUP BY lane),
l AS (SELECT lane, unnest(['total', 'mapped', 'unique_reads', 'exact']) AS stage, unnest([total, mapped, unique_reads, exact]) AS n, unnest([mapped, unique_reads, exact, 0]) AS nxt, total FROM s)
SELECT lane, stage, n, n * 100.0::DOUBLE / total AS percent, n - nxt AS lost, (n - nxt) * 100.0::DOUBLE / total AS percent_lost FROM l""")
def mapping_losses(m):
    return compare.mapping_losses(maps.mapping_stats(m, "genome"), ["total", "mapped", "unique_reads", "exact"])


@_query("transcript_maps", sql="SELECT transcript_id, count(*) AS reads FROM transcript_maps GROUP BY transcript_id")
def reads_by_transcript(m):
    return m.groupBy("transcript_id").agg(F.count(F.lit(1)).alias("reads"))


_BY_LANE = _GRPKM.replace("FROM alignments", "FROM lane_alignments").replace("FROM junction_reads", "FROM lane_junctions")


@_query("lane_alignments", "exons", "lane_junctions", sql=_BY_LANE + " SELECT gene_id, sample AS lane, reads, rpkm FROM gr")
def gene_rpkm_by_lane(alignments, exons, junction_reads):
    return _gene_rpkm(alignments, exons, junction_reads).withColumnRenamed("sample", "lane")


@_query("alignments", "exons", "junction_reads", sql=_GRPKM + " SELECT gene_id, sample, sum(reads)::BIGINT AS reads FROM (SELECT gene_id, sample, reads FROM ec UNION ALL SELECT gene_id, sample, reads FROM junction_reads) GROUP BY ALL HAVING sum(reads) > 0")
def gene_read_counts(alignments, exons, junction_reads):
    return _gene_reads(alignments, exons, junction_reads)


def _gene_reads(alignments, exons, junction_reads):
    genes = exons.select("exon_id", "gene_id").distinct()
    exonic = _exon_counts(alignments, exons).join(genes, "exon_id").select("gene_id", "sample", "reads")
    return exonic.unionByName(junction_reads.select("gene_id", "sample", "reads")).groupBy("gene_id", "sample").agg(F.sum("reads").alias("reads")).where("reads > 0")


@_query("alignments", "exons", "junction_reads", sql=_GRPKM + f", rc AS (SELECT gene_id, sample, sum(reads) AS reads FROM (SELECT gene_id, sample, reads FROM ec UNION ALL SELECT gene_id, sample, reads FROM junction_reads) GROUP BY ALL) SELECT gene_id, {_wide('reads', '::BIGINT')} FROM rc GROUP BY gene_id")
def gene_read_matrix(alignments, exons, junction_reads):
    return expression.matrix(_gene_reads(alignments, exons, junction_reads), "gene_id", SAMPLES, "reads")


@_query("alignments", "exons", sql=_U + _EC + " SELECT exon_id, sample, max(reads) AS reads FROM ec GROUP BY ALL")
def exon_read_counts(alignments, exons):
    return _exon_counts(alignments, exons)


@_query("alignments", "exons", sql=_EXRPKM + f" SELECT exon_id, {_wide('rpkm')} FROM xr GROUP BY exon_id")
def exon_matrix(alignments, exons):
    return expression.matrix(_exon_rpkm(alignments, exons), "exon_id", SAMPLES)


@_query("alignments", sql=_U + f" SELECT CASE chr WHEN 'chrMT' THEN 'chrM' ELSE chr END AS chr, {', '.join(f'count(*) FILTER (sample = {chr(39)}{s}{chr(39)}) AS {s}' for s in SAMPLES)} FROM uniq GROUP BY ALL")
def unique_maps_by_chromosome(alignments):
    name = F.concat(F.lit("chr"), F.regexp_replace(F.regexp_replace("chr", "^chr", ""), "^MT$", "M"))
    rows = expression.unique_alignments(alignments).groupBy(name.alias("chr"))
    return rows.agg(*[F.count(F.when(F.col("sample") == s, 1)).alias(s) for s in SAMPLES])


@_query("alignments", "exons", "junction_reads", sql=_GRPKM + """SELECT *, floor(detected * 100.0::DOUBLE / annotated * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS percent FROM (
SELECT sample, count(DISTINCT gene_id) AS detected, (SELECT count(DISTINCT gene_id) FROM exons) AS annotated FROM gr WHERE rpkm >= 1 GROUP BY ROLLUP (sample))""")
def gene_summary(alignments, exons, junction_reads):
    return expression.expression_summary(_gene_rpkm(alignments, exons, junction_reads), "gene_id", exons, 1.0)


@_query("alignments", "exons", "junction_reads", sql=_GRPKM + f"""SELECT gene_id, {_wide('rpkm')}, sum(CASE WHEN rpkm >= 100 THEN 1 ELSE 0 END)::BIGINT AS lanes, max(rpkm) AS most, round(sum(rpkm) / 4, 6) AS mean FROM gr GROUP BY 1""")
def gene_detection(alignments, exons, junction_reads):
    out = compare.detection_by_lane(_gene_rpkm(alignments, exons, junction_reads), "gene_id", SAMPLES, 100)
    return out.withColumn("mean", F.round("mean", 6)).orderBy(F.desc("mean"), "gene_id")


@_query("junction_reads", sql="""
, j AS (SELECT chr || '_' || j_start || '_' || j_end AS junction, sample, sum(reads)::BIGINT AS rpkm FROM junction_reads GROUP BY ALL)
SELECT junction, """ + _wide("rpkm", "::BIGINT") + ", sum(CASE WHEN rpkm >= 3 THEN 1 ELSE 0 END)::BIGINT AS lanes, max(rpkm) AS most, sum(rpkm) / 4 AS mean FROM j GROUP BY 1")
def junction_detection(junction_reads):
    rows = junction_reads.groupBy(F.concat_ws("_", "chr", "j_start", "j_end").alias("junction"), "sample").agg(F.sum("reads").alias("rpkm"))
    return compare.detection_by_lane(rows, "junction", SAMPLES, 3).orderBy(F.desc("mean"), "junction")


@_query("alignments", "exons", "junction_reads", sql=_GRPKM + f"""SELECT f.gene_id, s.sample, coalesce(rpkm, 0) AS rpkm FROM (SELECT DISTINCT gene_id FROM exons) f CROSS JOIN (SELECT unnest({SAMPLES}) AS sample) s
LEFT JOIN gr ON gr.gene_id = f.gene_id AND gr.sample = s.sample""")
def individual_genes(alignments, exons, junction_reads):
    return compare.individual_features(_gene_rpkm(alignments, exons, junction_reads), exons, "gene_id", SAMPLES)


@_query("junction_reads", "splits", sql="""
, a AS (SELECT sample, chr || '_' || j_start || '_' || j_end AS key, sum(reads)::BIGINT AS support, 'junction' AS source FROM junction_reads GROUP BY ALL
UNION ALL SELECT sample, chr1 || ',' || chr2 || ',' || start || ',' || "end", count(*), 'split' FROM splits GROUP BY ALL)
SELECT CASE WHEN sample IN ('s0', 's1') THEN 'one' ELSE 'two' END AS "group", key, source, sum(support)::BIGINT AS support FROM a GROUP BY ALL""")
def junctions_by_group(junction_reads, splits):
    return splicing.pooled_junctions(splicing.classified_junctions(junction_reads, splits), F.when(F.col("sample").isin("s0", "s1"), "one").otherwise("two"))


@_query("splits", "exons", sql="""
, g1 AS (SELECT DISTINCT chr, "end" // 100 AS p FROM exons), g2 AS (SELECT DISTINCT chr, start // 100 AS p FROM exons),
c AS (SELECT chr1, start, chr2, "end", sample, count(*) AS reads FROM splits GROUP BY ALL)
SELECT c.chr1, c.start, c.chr2, c."end", CASE WHEN g1.chr IS NULL OR g2.chr IS NULL THEN 'unknown' ELSE 'known' END AS genes, """ + _wide("reads", "::BIGINT") + """
FROM c LEFT JOIN g1 ON g1.chr = chr1 AND g1.p = c.start // 100 LEFT JOIN g2 ON g2.chr = chr2 AND g2.p = c."end" // 100 GROUP BY ALL HAVING count(*) FILTER (reads >= 2) >= 2""")
def labelled_split_matrix(splits, exons):
    at = lambda c, k: exons.select(F.col("chr").alias(f"chr{k}"), F.expr(f"`{c}` div 100").alias(f"p{k}"), F.lit(True).alias(f"g{k}")).distinct()
    rows = splits.withColumns({"p1": F.expr("start div 100"), "p2": F.expr("end div 100")}).join(at("end", 1), ["chr1", "p1"], "left").join(at("start", 2), ["chr2", "p2"], "left")
    label = F.when(F.col("g1") & F.col("g2"), "known").otherwise("unknown")
    return splicing.split_matrix(rows.withColumn("genes", label), SAMPLES, 2, 2)


@_query("alignments", "exons", "junction_reads", "transcript_expression", sql=_U + _EC.replace("sample", "sample") + """
, d AS (SELECT 'exon' AS kind, sample AS lane, exon_id AS feature FROM ec UNION ALL SELECT 'junction', sample, chr || '_' || j_start || '_' || j_end FROM junction_reads UNION ALL SELECT 'transcript', sample, transcript_id FROM transcript_expression)
SELECT lane, kind, count(DISTINCT feature) AS detected FROM d GROUP BY ALL""")
def features_by_lane(alignments, exons, junction_reads, transcripts):
    of = lambda df, c: df.select(F.col("sample").alias("lane"), c.alias("feature"))
    return compare.detected_by_lane(
        exon=of(_exon_counts(alignments, exons), F.col("exon_id")), junction=of(junction_reads, F.concat_ws("_", "chr", "j_start", "j_end")), transcript=of(transcripts, F.col("transcript_id"))
    )


_MATCHED = """, a AS (SELECT transcript_id, rpkm FROM transcript_expression WHERE sample = 's0'), b AS (SELECT transcript_id, rpkm FROM transcript_expression WHERE sample = 's1'),
mt AS (SELECT coalesce(a.transcript_id, b.transcript_id) AS transcript_id, CASE WHEN coalesce(a.rpkm, 0) = 0 THEN -1 ELSE a.rpkm END AS score1, CASE WHEN coalesce(b.rpkm, 0) = 0 THEN -1 ELSE b.rpkm END AS score2
FROM a FULL JOIN b ON a.transcript_id = b.transcript_id)"""


def _matched(t):
    return compare.matched(t.where("sample = 's0'"), t.where("sample = 's1'"), "transcript_id", "rpkm")


@_query("transcript_expression", sql=_MATCHED + " SELECT score1, score2, count(*) AS n FROM mt GROUP BY ALL")
def score_categories(t):
    return compare.score_categories(_matched(t))


@_query("transcript_expression", sql=_MATCHED + ", ra AS (SELECT score1, score2, 1.0::DOUBLE / count(*) AS idr FROM mt GROUP BY ALL HAVING count(*) > 1) SELECT mt.*, idr FROM mt LEFT JOIN ra USING (score1, score2)")
def scores_with_idr(t):
    pairs = _matched(t)
    rates = compare.score_categories(pairs).where("n > 1").withColumn("idr", F.lit(1.0) / F.col("n"))
    return compare.with_idr(pairs, rates)


@_query("transcript_expression", "experiments", sql="SELECT t.* FROM transcript_expression t WHERE sample IN (SELECT 's' || (experiment_id % 4) FROM experiments WHERE rna_type = 1)")
def values_of_chosen_samples(t, e):
    wanted = e.where("rna_type = 1").select(F.concat(F.lit("s"), (F.col("experiment_id") % 4).cast("string")).alias("sample"))
    return compare.of_samples(t, wanted)


@_query("maps", "hit_maps", sql="""
, r AS (SELECT lane, count(*) AS n FROM maps GROUP BY lane), m AS (SELECT lane, count(*) AS n FROM hit_maps WHERE strata <> '0:0:0' GROUP BY lane)
SELECT r.lane, r.n AS existing, m.n AS mapped, CASE WHEN m.n IS NULL THEN 'absent' ELSE 'different' END AS problem FROM r LEFT JOIN m USING (lane) WHERE m.n IS NULL OR m.n <> r.n""")
def read_differences(m, listed):
    count = lambda df: df.groupBy("lane").agg(F.count(F.lit(1)).alias("n"))
    return compare.read_differences(count(m), count(listed.where("strata <> '0:0:0'")))


@_query("hit_maps", sql="""
, r AS (SELECT lane AS pair, mate AS lane, count(*) AS n FROM hit_maps WHERE strata <> '0:0:0' GROUP BY ALL)
SELECT pair, count(*) AS lanes, min(n) AS least, max(n) AS most FROM r GROUP BY pair HAVING count(*) > 2 OR min(n) <> max(n)""")
def unequal_mates(listed):
    rows = listed.where("strata <> '0:0:0'").groupBy(F.col("lane").alias("pair"), F.col("mate").alias("lane")).agg(F.count(F.lit(1)).alias("n"))
    return compare.unequal_mates(rows)


@_query("transcript_expression", "exon_transcripts", "gene_info", sql="SELECT t.transcript_id, t.sample, t.rpkm, g.gene_id FROM transcript_expression t JOIN (SELECT DISTINCT transcript_id, gene_id FROM exon_transcripts JOIN gene_info USING (gene_id) WHERE gene_name IS NOT NULL) g USING (transcript_id) WHERE rpkm > 0")
def expressed_with_gene(t, bridge, info):
    named = bridge.join(info.where("gene_name is not null").select("gene_id"), "gene_id")
    return compare.expressed_with_gene(t.select("transcript_id", "sample", "rpkm"), named)


@_query("features", sql="""SELECT gene_id, transcript_id, start % 7 AS fpkm, 'l' || (start % 3) AS lane FROM features WHERE type = 'transcript' AND start % 7 > 0""")
def novel_transcripts(features):
    return compare.novel_transcripts(features.withColumns({"fpkm": F.expr("start % 7"), "lane": F.concat(F.lit("l"), F.expr("start % 3").cast("string"))}))


@_query(*_FUSION_VIEWS, sql=_FUSED + """, cl AS (SELECT chr, min(start) AS start, max("end") AS "end", chr || '_' || min(start) || '_' || max("end") AS cluster FROM fn GROUP BY chr, r HAVING count(*) >= 2),
fr AS (SELECT pair_id, mate, chr, start, "end" FROM hc WHERE pair_id IN (SELECT pair_id FROM fc WHERE label = 'Fusion') AND (pair_id, mate) IN (SELECT (pair_id, mate) FROM hc GROUP BY pair_id, mate HAVING count(*) = 1)),
th AS (SELECT a.pair_id, a.mate, c.chr, c.cluster FROM fr a JOIN cl c ON a.chr = c.chr AND a.start <= c."end" AND a."end" >= c.start),
re AS (SELECT pair_id, min(cluster) AS cluster1, max(cluster) AS cluster2, count(DISTINCT cluster) AS k, min(chr) = max(chr) AS one FROM th GROUP BY pair_id HAVING count(DISTINCT mate) = 2)
SELECT 'all' AS sample, cluster1, cluster2, CASE WHEN k = 1 THEN 'close' WHEN one THEN 'far' ELSE 'interchrom' END AS type, count(*) AS reads FROM re WHERE k <= 2 GROUP BY ALL HAVING count(*) >= 1""")
def fusion_cluster_support(*views):
    found = fusions.fusion_hits(hits.hit_coordinates(hits.best_hits(views[1]), 50), _fusions(*views)).withColumn("sample", F.lit("all"))
    fragments = found.select("sample", F.col("pair_id").alias("read_id"), F.col("mate").alias("fragment"), "chr", "start", "end")
    return fusions.cluster_links(fragments, intervals.read_clusters(found, 2), 1)
