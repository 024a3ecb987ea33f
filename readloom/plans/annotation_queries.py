"""Queries over annotation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.operators import annotation, expression, intervals, splicing
from readloom.plans.registry import _EXRPKM, _GRPKM, _M, SAMPLES, _exon_rpkm, _gene_rpkm, _query

_GENES = """, gt AS (SELECT gene_id, coalesce(gene_type, 'gene') AS type, coalesce(gene_status, 'unknown') AS status, gene_name AS name, description, chr FROM gene_info)"""
_ROUNDED = ", ".join(f"coalesce(sum(floor(rpkm + 0.5::DOUBLE)) FILTER (sample = '{s}'), 0)::BIGINT AS {s}" for s in SAMPLES)


@_query("gene_info", sql=_GENES + " SELECT * FROM gt")
def gene_table(info):
    return annotation.gene_table(info)


@_query("features", "gene_info", sql=_GENES + """ SELECT transcript_id, f.gene_id, f.chr, coalesce(gt.type, 'transcript') AS type, coalesce(gt.status, 'unknown') AS status FROM features f LEFT JOIN gt ON gt.gene_id = f.gene_id WHERE f.type = 'transcript'""")
def transcript_table(features, info):
    return annotation.transcript_table(features, info)


@_query("features", sql="SELECT type, count(*) AS n FROM features GROUP BY type")
def feature_types(features):
    return annotation.type_counts(features)


@_query("features", sql="SELECT * FROM features WHERE type = 'gene'")
def gene_features(features):
    return annotation.of_type(features, "gene")


@_query("features", sql="SELECT * FROM features WHERE NOT regexp_matches(chr, 'hap|^chrU|^Un\\.|^(chr)?HSCHR|^AAFC03011182')")
def chromosome_features(features):
    return annotation.on_chromosomes(features)


_KEPT_GENES = """ gene_id NOT IN (SELECT gene_id FROM gt WHERE chr LIKE '%chrM%' OR regexp_matches(lower(coalesce(description, '')), 'ribosom(e|al)') OR type LIKE 'rRNA%')"""


@_query("alignments", "exons", "junction_reads", "gene_info", sql=_GRPKM + _GENES + ", wi AS (SELECT gene_id, " + ", ".join(f"coalesce(sum(rpkm) FILTER (sample = '{s}'), 0) AS {s}" for s in SAMPLES) + " FROM gr WHERE" + _KEPT_GENES + " GROUP BY gene_id) SELECT * FROM wi")
def gene_matrix(alignments, exons, junction_reads, info):
    return expression.matrix(annotation.without_ribosomal(_gene_rpkm(alignments, exons, junction_reads), info), "gene_id", SAMPLES)


@_query("alignments", "exons", "junction_reads", sql=_GRPKM + f""", w AS (SELECT gene_id, {_ROUNDED} FROM gr WHERE floor(rpkm + 0.5::DOUBLE) >= 1 GROUP BY gene_id),
l AS (SELECT gene_id, max("end") - min(start) + 1 AS length, CASE WHEN min(strand) = max(strand) THEN min(strand) ELSE '.' END AS strand, min(chr) AS locus, count(DISTINCT exon_id) AS exons FROM exons GROUP BY gene_id)
SELECT w.*, s0 + s1 + s2 + s3 AS total, length, strand, locus, exons, 3 AS transcripts FROM w JOIN l USING (gene_id)""")
def top_genes(alignments, exons, junction_reads):
    bridge = exons.select("gene_id").distinct().select("gene_id", F.explode(F.array(*[F.concat("gene_id", F.lit(f".T{k}")) for k in (1, 2, 3)])).alias("transcript_id"))
    return annotation.top_genes(_gene_rpkm(alignments, exons, junction_reads), SAMPLES, exons, bridge).orderBy(F.desc("total"), "gene_id")


@_query("alignments", "exons", sql=_EXRPKM + f""", w AS (SELECT exon_id, {_ROUNDED} FROM xr WHERE floor(rpkm + 0.5::DOUBLE) >= 1 GROUP BY exon_id),
l AS (SELECT exon_id, max("end") - min(start) + 1 AS length, CASE WHEN min(strand) = max(strand) THEN min(strand) ELSE '.' END AS strand, min(chr) AS locus FROM exons GROUP BY exon_id)
SELECT w.*, s0 + s1 + s2 + s3 AS total, length, strand, locus FROM w JOIN l USING (exon_id)""")
def top_exons(alignments, exons):
    return annotation.top_features(_exon_rpkm(alignments, exons), "exon_id", SAMPLES, annotation.loci(exons, "exon_id")).orderBy(F.desc("total"), "exon_id")


@_query("exons", "exon_transcripts", sql="""
, o AS (SELECT e.gene_id, transcript_id, e.exon_id, e.strand, lead(e.exon_id) OVER (PARTITION BY e.gene_id, transcript_id, e.chr ORDER BY e.start, e."end") AS nxt FROM exon_transcripts t JOIN exons e ON e.gene_id = t.gene_id AND e.exon_id = t.exon_id)
SELECT gene_id, transcript_id, CASE WHEN strand = '-' THEN nxt ELSE exon_id END AS exon1_id, CASE WHEN strand = '-' THEN exon_id ELSE nxt END AS exon2_id FROM o WHERE nxt IS NOT NULL""")
def transcript_junctions(exons, bridge):
    return splicing.transcript_junctions(exons, bridge)


@_query("features", "transcript_expression", sql="""SELECT chr || chr(9) || start || chr(9) || "end" || chr(9) || strand || ' RPKM "' || rpkm::BIGINT || '";' AS value
FROM features f JOIN (SELECT gene_id, floor(sum(rpkm::DECIMAL(28,6)))::BIGINT AS rpkm FROM transcript_expression GROUP BY gene_id HAVING sum(rpkm::DECIMAL(28,6)) > 0) e USING (gene_id) WHERE type = 'gene'""")
def annotated_gene_lines(features, expressed):
    values = expressed.groupBy("gene_id").agg(expression.exact_sum("rpkm").cast("long").alias("rpkm"))
    return annotation.with_rpkm(annotation.of_type(features, "gene"), values, "gene_id", F.concat_ws("\t", "chr", "start", "end", "strand"))


@_query("exons", "exon_transcripts", "transcript_expression", sql=""", p AS (SELECT gene_id, transcript_id, e.chr, min(e.start) AS s, max(e."end") AS t, CASE WHEN count(DISTINCT e.strand) = 1 THEN min(e.strand) ELSE '.' END AS strand FROM exon_transcripts b JOIN exons e USING (gene_id, exon_id) GROUP BY ALL)
SELECT chr || chr(9) || s || chr(9) || t || chr(9) || strand || ' RPKM "' || rpkm || '";' AS value
FROM p JOIN (SELECT gene_id, transcript_id, floor(sum(rpkm::DECIMAL(28,6)))::BIGINT AS rpkm FROM transcript_expression GROUP BY ALL HAVING sum(rpkm::DECIMAL(28,6)) >= 1) x USING (gene_id, transcript_id)""")
def annotated_transcript_lines(exons, bridge, expressed):
    keys = ["gene_id", "transcript_id"]
    strand = F.when(F.countDistinct("strand") == 1, F.min("strand")).otherwise(".").alias("strand")
    spans = bridge.join(exons, ["gene_id", "exon_id"]).groupBy(*keys, "chr").agg(F.min("start").alias("start"), F.max("end").alias("end"), strand)
    values = expressed.groupBy(*keys).agg(expression.exact_sum("rpkm").cast("long").alias("rpkm"))
    return annotation.with_rpkm(spans, values, keys, F.concat_ws("\t", "chr", "start", "end", "strand"))


@_query("exons", "exon_transcripts", "transcript_expression", sql=""", v AS (SELECT gene_id, exon_id, floor(sum(rpkm::DECIMAL(28,6)))::BIGINT AS rpkm FROM transcript_expression JOIN exon_transcripts USING (gene_id, transcript_id) GROUP BY ALL HAVING sum(rpkm::DECIMAL(28,6)) >= 1)
SELECT chr || chr(9) || start || chr(9) || "end" || chr(9) || strand || ' RPKM "' || rpkm || '";' AS value FROM exons JOIN v USING (gene_id, exon_id)""")
def annotated_exon_lines(exons, bridge, expressed):
    values = expressed.join(bridge, ["gene_id", "transcript_id"]).groupBy("gene_id", "exon_id").agg(expression.exact_sum("rpkm").cast("long").alias("rpkm"))
    return annotation.with_rpkm(exons, values, ["gene_id", "exon_id"], F.concat_ws("\t", "chr", "start", "end", "strand"))


@_query("exons", sql=_M + ' SELECT chr, count(*) AS ranges, sum("end" - start + 1)::BIGINT AS bases FROM proj GROUP BY chr')
def projected_bases(exons):
    return intervals.gene_projections(exons).groupBy("chr").agg(F.count(F.lit(1)).alias("ranges"), F.sum(F.expr("end - start + 1")).alias("bases"))
