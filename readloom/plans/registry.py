"""All queries over the derived tables and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import text
from readloom.operators import annotation, compare, expression, fusions, hits, intervals, maps, reads, splicing
from readloom.plans.fixtures import view, with_views

SAMPLES = ["s0", "s1", "s2", "s3"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(*views: str, sql: str | None = None):
    """Register a function of the named views, under its own name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[view(spark, sf_dir, v) for v in views])
        if sql:
            ORACLE_SQL[f.__name__] = with_views(sql, *views)
        return f

    return put


def _as_features(exons: DataFrame) -> DataFrame:
    return exons.select("exon_id", "gene_id", "chr", F.col("start").alias("f_start"), F.col("end").alias("f_end")).distinct()


_U = """, nh AS (SELECT *, count(*) OVER (PARTITION BY read_id, read_no) AS nh FROM alignments),
uniq AS (SELECT * FROM nh WHERE nh = 1),
um AS (SELECT sample, count(*) AS unique_maps FROM uniq GROUP BY sample)"""
_EC = """, ec AS (SELECT exon_id, gene_id, sample, count(*) AS reads FROM (SELECT DISTINCT exon_id, gene_id, chr, start, "end" FROM exons) e
JOIN uniq a ON a.chr = e.chr AND a.start >= e.start AND a."end" <= e."end" GROUP BY exon_id, gene_id, sample)"""
_M = """, ordered AS (SELECT gene_id, chr, start, "end", strand, max("end") OVER (PARTITION BY gene_id, chr ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM exons),
numbered AS (SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY gene_id, chr ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS r FROM ordered),
proj AS (SELECT gene_id, chr, min(start) AS start, max("end") AS "end", CASE WHEN min(strand) = max(strand) THEN min(strand) ELSE '.' END AS strand, count(*) AS exons FROM numbered GROUP BY gene_id, chr, r),
plen AS (SELECT gene_id, sum("end" - start + 1)::BIGINT AS length FROM proj GROUP BY gene_id)"""
_EXRPKM = _U + _EC + """, xr AS (SELECT * FROM (SELECT ec.exon_id, ec.sample, floor(ec.reads * 1000000000.0::DOUBLE / (length * unique_maps) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS rpkm
FROM (SELECT exon_id, sample, max(reads) AS reads FROM ec GROUP BY ALL) ec JOIN (SELECT DISTINCT exon_id, "end" - start + 1 AS length FROM exons) l USING (exon_id) JOIN um USING (sample)) WHERE rpkm > 0)"""
_GRPKM = _U + _EC + _M + """, gr AS (SELECT * FROM (SELECT gene_id, sample, reads, floor(reads * 1000000000.0::DOUBLE / (length * unique_maps) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS rpkm
FROM (SELECT gene_id, sample, sum(reads)::BIGINT AS reads FROM (SELECT gene_id, sample, reads FROM ec UNION ALL SELECT gene_id, sample, reads FROM junction_reads) GROUP BY ALL) t
JOIN plen USING (gene_id) JOIN um USING (sample)) WHERE rpkm > 0)"""
_SHARED = """, sh AS (SELECT exon_id FROM exons GROUP BY exon_id HAVING count(DISTINCT gene_id) > 1),
pr AS (SELECT a.gene_id, a.chr, a.strand, a.exon_id AS exon1_id, b.exon_id AS exon2_id, a."end" AS start, b.start AS "end" FROM exons a JOIN exons b ON a.gene_id = b.gene_id AND a.chr = b.chr AND a.strand = b.strand
WHERE a."end" < b.start AND a.exon_id NOT IN (SELECT exon_id FROM sh) AND b.exon_id NOT IN (SELECT exon_id FROM sh))"""
_ANN = """, an AS (SELECT DISTINCT gene_id, chr, "end" AS start, nxt AS "end" FROM (SELECT e.gene_id, e.chr, e."end", lead(e.start) OVER (PARTITION BY e.gene_id, transcript_id, e.chr ORDER BY e.start, e."end") AS nxt
FROM exon_transcripts t JOIN exons e ON e.gene_id = t.gene_id AND e.exon_id = t.exon_id) WHERE nxt > "end")"""


# Intervals


@_query("exons", sql=_M + ' SELECT gene_id, chr, start, "end", strand, exons FROM proj')
def gene_projections(exons):
    return intervals.gene_projections(exons)


@_query("exons", sql=_M + " SELECT * FROM plen")
def gene_projected_lengths(exons):
    return intervals.projected_lengths(exons)


@_query("alignments", sql="""
, o AS (SELECT *, max("end") OVER (PARTITION BY sample, chr ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM alignments),
n AS (SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY sample, chr ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS r FROM o)
SELECT sample, chr, min(start) AS start, max("end") AS "end", CASE WHEN min(strand) = max(strand) THEN min(strand) ELSE '.' END AS strand, count(*) AS included FROM n GROUP BY sample, chr, r HAVING count(*) >= 5""")
def read_clusters(alignments):
    return intervals.read_clusters(alignments, 5)


@_query("exons", sql="""
, e AS (SELECT DISTINCT exon_id, chr, start, "end" FROM exons)
SELECT a.exon_id, count(*) - 1 AS overlaps FROM e a JOIN e b ON a.chr = b.chr AND a.start <= b."end" AND a."end" >= b.start GROUP BY a.exon_id""")
def exon_self_overlap(exons):
    return intervals.overlap_counts(exons)


@_query("alignments", sql="""SELECT chr, lane, count(*) AS reads FROM alignments GROUP BY chr, lane""")
def reads_by_chromosome(alignments):
    out = alignments.groupBy("chr", "lane").agg(F.count(F.lit(1)).alias("reads"))
    return out.orderBy(*text.natural_chromosome(F.col("chr")), "lane")


# Expression


@_query("alignments", sql=_U + " SELECT sample, nh, count(*) AS alignments FROM nh GROUP BY sample, nh")
def hit_multiplicity(alignments):
    return expression.with_multiplicity(alignments).groupBy("sample", "nh").agg(F.count(F.lit(1)).alias("alignments"))


@_query("alignments", sql=_U + " SELECT * FROM um")
def unique_maps(alignments):
    return expression.unique_maps(expression.unique_alignments(alignments))


@_query("alignments", "exons", sql=_M + """ SELECT gene_id, sample, sum(CASE WHEN a.strand = '+' THEN 1 ELSE 0 END)::BIGINT AS forward, sum(CASE WHEN a.strand = '-' THEN 1 ELSE 0 END)::BIGINT AS reverse, count(*) AS reads
FROM proj p JOIN alignments a ON a.chr = p.chr AND a.start >= p.start AND a."end" <= p."end" GROUP BY gene_id, sample""")
def projection_containment(alignments, exons):
    proj = intervals.gene_projections(exons).select("gene_id", "chr", F.col("start").alias("f_start"), F.col("end").alias("f_end"))
    return expression.containment_counts(alignments, proj, "gene_id")


@_query("alignments", "exons", sql="""
, g AS (SELECT gene_id, chr, min(start) AS start, max("end") AS "end" FROM exons GROUP BY gene_id, chr)
SELECT sample, class, count(*) AS reads, floor(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY sample) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS percent FROM (SELECT a.sample, CASE WHEN EXISTS (SELECT 1 FROM exons e WHERE e.chr = a.chr AND e.start <= a."end" AND e."end" >= a.start) THEN 'exonic'
WHEN EXISTS (SELECT 1 FROM g WHERE g.chr = a.chr AND g.start <= a."end" AND g."end" >= a.start) THEN 'intronic' ELSE 'intergenic' END AS class FROM alignments a) GROUP BY sample, class""")
def read_classes(alignments, exons):
    return expression.read_classes(alignments, exons)


def _exon_counts(alignments, exons):
    return expression.containment_counts(expression.unique_alignments(alignments), _as_features(exons).drop("gene_id").distinct(), "exon_id").select("exon_id", "sample", "reads")


def _exon_rpkm(alignments, exons):
    at = expression.places(expression.unique_alignments(alignments))
    counts = expression.counts_at(at, _as_features(exons).drop("gene_id").distinct(), "exon_id")
    lengths = exons.select("exon_id", F.expr("end - start + 1").alias("length")).distinct()
    return expression.exon_rpkm(counts, lengths, expression.maps_at(at))


def _gene_rpkm(alignments, exons, junction_reads):
    at = expression.places(expression.unique_alignments(alignments))
    counts = expression.counts_at(at, _as_features(exons).withColumn("key", F.struct("gene_id", "exon_id")), "key").select("key.gene_id", "sample", "reads")
    junctions = junction_reads.groupBy("gene_id", "sample").agg(F.sum("reads").alias("reads"))
    return expression.gene_rpkm(counts, junctions, exons, expression.maps_at(at))


@_query("alignments", "exons", sql=_EXRPKM + " SELECT * FROM xr")
def exon_rpkm_pooled(alignments, exons):
    return _exon_rpkm(alignments, exons)


@_query("alignments", "exons", "junction_reads", sql=_GRPKM + " SELECT * FROM gr")
def gene_rpkm_pooled(alignments, exons, junction_reads):
    return _gene_rpkm(alignments, exons, junction_reads)


@_query("alignments", "exons", "junction_reads", "gene_info", sql=_GRPKM + """, de AS (SELECT gr.*, coalesce(gene_status, 'unknown') AS status, coalesce(gene_type, 'gene') AS type FROM gr JOIN gene_info USING (gene_id) WHERE rpkm >= 1)
SELECT sample, status, type, count(*) AS detected FROM de GROUP BY ALL UNION ALL SELECT NULL, NULL, NULL, count(*) FROM de""")
def detected_genes(alignments, exons, junction_reads, info):
    return expression.detected_features(_gene_rpkm(alignments, exons, junction_reads), annotation.gene_table(info), "gene_id")


@_query("alignments", "exons", "junction_reads", sql=_GRPKM + " SELECT sample, bin, count(*) AS features FROM (SELECT sample, floor(rpkm + 0.5::DOUBLE)::BIGINT AS bin FROM gr) WHERE bin > 0 GROUP BY sample, bin")
def gene_rpkm_histogram(alignments, exons, junction_reads):
    return expression.rpkm_histogram(_gene_rpkm(alignments, exons, junction_reads))


@_query("transcript_expression", sql="SELECT gene_id, sample, floor(sum(rpkm) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS rpkm FROM transcript_expression GROUP BY ALL")
def gene_from_transcripts(transcripts):
    return expression.transcript_to_gene(transcripts)


@_query("transcript_expression", "exon_transcripts", sql="""SELECT exon_id, sample, floor(sum(rpkm) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS rpkm
FROM transcript_expression JOIN exon_transcripts USING (gene_id, transcript_id) GROUP BY ALL""")
def exon_from_transcripts(transcripts, bridge):
    return expression.transcript_to_exon(transcripts, bridge)


@_query("transcript_expression", "exon_transcripts", sql="""SELECT *, floor(detected * 100.0::DOUBLE / annotated * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS percent FROM (
SELECT sample, count(DISTINCT transcript_id) AS detected, (SELECT count(DISTINCT transcript_id) FROM exon_transcripts) AS annotated FROM transcript_expression GROUP BY ROLLUP (sample))""")
def transcript_summary(transcripts, bridge):
    return expression.expression_summary(transcripts, "transcript_id", bridge)


_SATURATION = """, f AS (SELECT {f}, min({lane}) AS {lane} FROM {t} GROUP BY 1), c AS (SELECT {lane}, count(*) AS new FROM f GROUP BY 1)
SELECT *, floor(cumulative::DOUBLE / (SELECT count(DISTINCT {f}) FROM {all}) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS fraction FROM (
SELECT s.{lane}, coalesce(new, 0) AS new, sum(coalesce(new, 0)) OVER (ORDER BY s.{lane})::BIGINT AS cumulative FROM (SELECT DISTINCT {lane} FROM {t}) s LEFT JOIN c USING ({lane}))"""


@_query("transcript_expression", "exon_transcripts", sql=_SATURATION.format(f="transcript_id", lane="sample", t="transcript_expression", all="exon_transcripts"))
def transcript_saturation(transcripts, bridge):
    return expression.saturation(transcripts, "transcript_id", "sample", bridge)


@_query("junction_reads", "exons", sql=_SATURATION.format(f="gene_id", lane="lane", t="junction_reads", all="exons"))
def gene_saturation_by_lane(junction_reads, exons):
    return expression.saturation(junction_reads, "gene_id", "lane", exons)


@_query("alignments", "exons", sql=_U + _EC + _SATURATION.format(f="exon_id", lane="sample", t="ec", all="exons"))
def exon_saturation(alignments, exons):
    return expression.saturation(_exon_counts(alignments, exons), "exon_id", "sample", exons)


_WIDE = ", ".join(f"coalesce(sum(rpkm) FILTER (sample = '{s}'), 0) AS {s}" for s in SAMPLES)
_WIDE_WHOLE = ", ".join(f"coalesce(sum(rpkm) FILTER (sample = '{s}'), 0)::BIGINT AS {s}" for s in SAMPLES)


@_query("transcript_expression", sql=f"SELECT transcript_id, {_WIDE} FROM transcript_expression GROUP BY transcript_id")
def transcript_matrix(transcripts):
    return expression.matrix(transcripts, "transcript_id", SAMPLES)


@_query("transcript_expression", sql="""
, d AS (SELECT t.transcript_id, s.sample, coalesce(e.rpkm, 0) AS v FROM (SELECT DISTINCT transcript_id FROM transcript_expression) t CROSS JOIN (SELECT DISTINCT sample FROM transcript_expression) s
LEFT JOIN transcript_expression e ON e.transcript_id = t.transcript_id AND e.sample = s.sample)
SELECT a.sample AS sample1, b.sample AS sample2, round(sum(CASE WHEN a.v + b.v > 0 THEN abs(a.v - b.v) / (a.v + b.v) ELSE 0 END), 6) AS distance FROM d a JOIN d b ON a.transcript_id = b.transcript_id AND a.sample < b.sample GROUP BY ALL""")
def sample_distance(transcripts):
    return expression.canberra(transcripts, "transcript_id", SAMPLES).withColumn("distance", F.round("distance", 6))


@_query("transcript_expression", "exon_transcripts", sql=f"""
, k AS (SELECT transcript_id, sample, floor(rpkm + 0.5::DOUBLE) AS rpkm FROM transcript_expression WHERE floor(rpkm + 0.5::DOUBLE) >= 1),
w AS (SELECT transcript_id, {_WIDE_WHOLE} FROM k GROUP BY transcript_id)
SELECT w.*, s0 + s1 + s2 + s3 AS total, exons FROM w JOIN (SELECT transcript_id, count(*) AS exons FROM exon_transcripts GROUP BY 1) a USING (transcript_id)""")
def top_transcripts(transcripts, bridge):
    about = bridge.groupBy("transcript_id").agg(F.count(F.lit(1)).alias("exons"))
    values = transcripts.select("transcript_id", "sample", F.col("rpkm"))
    out = annotation.top_features(values, "transcript_id", SAMPLES, about)
    return out.orderBy(F.desc("total"), "transcript_id")


@_query("transcript_expression", sql="""SELECT transcript_id, sum(CASE WHEN rpkm >= 10 THEN 1 ELSE 0 END)::BIGINT AS lanes, max(rpkm) AS most, sum(rpkm) / 4 AS mean FROM transcript_expression GROUP BY 1""")
def transcript_detection(transcripts):
    return compare.detection(transcripts, "transcript_id", 4, 10).orderBy(F.desc("mean"), "transcript_id")


# Splicing


@_query("exons", sql="SELECT exon_id, count(DISTINCT gene_id) AS genes FROM exons GROUP BY exon_id HAVING genes > 1")
def exons_of_several_genes(exons):
    return splicing.shared_exons(exons)


@_query("exons", sql=_SHARED + " SELECT * FROM pr")
def exon_pairs(exons):
    return splicing.exon_pairs(exons)


@_query("exons", "exon_transcripts", sql=_ANN + " SELECT * FROM an")
def annotated_junctions(exons, bridge):
    return splicing.annotated_junctions(exons, bridge)


@_query("exons", "exon_transcripts", sql=_SHARED + _ANN + """ SELECT pr.*, CASE WHEN an.gene_id IS NULL THEN 'novel' ELSE 'known' END AS type
FROM pr LEFT JOIN an ON an.gene_id = pr.gene_id AND an.chr = pr.chr AND an.start = pr.start AND an."end" = pr."end" """)
def junction_catalogue(exons, bridge):
    return splicing.junction_catalogue(exons, bridge)


_EXC = """, exc AS (SELECT DISTINCT e.gene_id, e.exon_id, e.chr, a."end" AS j_start, b.start AS j_end FROM exons e
JOIN exons a ON a.gene_id = e.gene_id AND a.chr = e.chr AND a.strand = e.strand AND a."end" < e.start
JOIN exons b ON b.gene_id = e.gene_id AND b.chr = e.chr AND b.strand = e.strand AND b.start > e."end")"""
_INC = """, inc AS (SELECT exon1_id AS exon_id, chr, start AS j_start, "end" AS j_end FROM pr UNION SELECT exon2_id, chr, start, "end" FROM pr)"""
_JR = _U + _EC + _SHARED + _EXC + _INC + """, jr AS (SELECT chr, j_start, j_end, sample, sum(reads)::BIGINT AS reads FROM junction_reads GROUP BY ALL),
er AS (SELECT exon_id, sample, max(reads) AS reads FROM ec GROUP BY ALL)"""
_RAW_PSI = _JR + """, rows3 AS (SELECT exon_id, sample, reads AS x, 0 AS i, 0 AS o FROM er
UNION ALL SELECT exon_id, sample, 0, reads, 0 FROM inc JOIN jr USING (chr, j_start, j_end)
UNION ALL SELECT exon_id, sample, 0, 0, reads FROM (SELECT DISTINCT exon_id, chr, j_start, j_end FROM exc) JOIN jr USING (chr, j_start, j_end)),
psi AS (SELECT exon_id, sample, sum(x)::BIGINT AS ex_incl, sum(i)::BIGINT AS junc_inc, sum(o)::BIGINT AS junc_exc, (sum(x) + sum(i))::DOUBLE / (sum(x) + sum(i) + sum(o)) AS psi FROM rows3 GROUP BY exon_id, sample)"""
_PSI = _JR + """, el AS (SELECT DISTINCT exon_id, "end" - start + 1 AS length FROM exons),
jl AS (SELECT pr.chr, pr.start AS j_start, pr."end" AS j_end, max(least(a.length + b.length, 100)) AS length FROM pr JOIN el a ON a.exon_id = exon1_id JOIN el b ON b.exon_id = exon2_id GROUP BY ALL),
jx AS (SELECT jr.chr, jr.j_start, jr.j_end, sample, reads * 1000.0::DOUBLE / length AS x FROM jr JOIN jl USING (chr, j_start, j_end)),
rows3 AS (SELECT exon_id, sample, reads * 1000.0::DOUBLE / length AS x, 0.0::DOUBLE AS i, 0.0::DOUBLE AS o FROM er JOIN el USING (exon_id)
UNION ALL SELECT exon_id, sample, 0, x, 0 FROM inc JOIN jx USING (chr, j_start, j_end)
UNION ALL SELECT exon_id, sample, 0, 0, x FROM (SELECT DISTINCT exon_id, chr, j_start, j_end FROM exc) JOIN jx USING (chr, j_start, j_end)),
sums AS (SELECT exon_id, sample, floor(sum(x) * (1000000.0::DOUBLE / unique_maps) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS ex_incl, floor(sum(i) * (1000000.0::DOUBLE / unique_maps) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS junc_inc,
floor(sum(o) * (1000000.0::DOUBLE / unique_maps) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS junc_exc FROM rows3 JOIN um USING (sample) GROUP BY exon_id, sample, unique_maps),
psi AS (SELECT *, CASE WHEN ex_incl + junc_inc + junc_exc > 0 THEN floor((ex_incl + junc_inc) / (ex_incl + junc_inc + junc_exc) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE END AS psi FROM sums)"""


@_query("exons", sql=_EXC + " SELECT * FROM exc")
def exclusion_junctions(exons):
    return splicing.exclusion_junctions(exons)


@_query("exons", sql=_SHARED + _INC + " SELECT * FROM inc")
def inclusion_junctions(exons):
    return splicing.inclusion_junctions(exons, splicing.exon_pairs(exons))


def _psi(alignments, exons, junction_reads):
    at = expression.places(expression.unique_alignments(alignments))
    features = _as_features(exons).drop("gene_id").distinct()
    sizes = exons.select("exon_id", F.expr("end - start + 1").alias("length")).distinct()
    reads_of = expression.counts_at(at, features, "exon_id").select("exon_id", "sample", "reads").join(sizes, "exon_id")
    included = splicing.inclusion_lengths(splicing.exon_pairs(exons), exons)
    excluded = splicing.skipping_junctions(exons, junction_reads)
    return splicing.inclusion_rates(reads_of, junction_reads, included, excluded, expression.maps_at(at), 50)


@_query("alignments", "exons", "junction_reads", sql=_PSI + " SELECT * FROM psi")
def exon_inclusion(alignments, exons, junction_reads):
    return _psi(alignments, exons, junction_reads)


@_query("alignments", "exons", "junction_reads", sql=_RAW_PSI + " SELECT * FROM psi")
def inclusion_supporting_reads(alignments, exons, junction_reads):
    included = splicing.inclusion_junctions(exons, splicing.exon_pairs(exons))
    excluded = splicing.skipping_junctions(exons, junction_reads)
    return splicing.inclusion_reads(_exon_counts(alignments, exons), junction_reads, included, excluded)


@_query("alignments", "exons", "junction_reads", sql=_PSI + " SELECT sample, floor(psi * 100)::BIGINT AS bin, count(*) AS exons FROM psi WHERE psi IS NOT NULL GROUP BY ALL")
def inclusion_histogram(alignments, exons, junction_reads):
    return splicing.inclusion_histogram(_psi(alignments, exons, junction_reads))


@_query("junction_reads", sql="SELECT gene_id, sample, sum(reads)::BIGINT AS reads FROM junction_reads GROUP BY ALL")
def gene_junction_reads(junction_reads):
    return junction_reads.groupBy("gene_id", "sample").agg(F.sum("reads").alias("reads"))


@_query("junction_reads", sql="""
, j AS (SELECT gene_id, sample, chr, j_start, j_end, sum(reads)::BIGINT AS reads FROM junction_reads GROUP BY ALL), g AS (SELECT *, sum(reads) OVER (PARTITION BY gene_id, sample)::BIGINT AS gene_reads FROM j)
SELECT *, floor(reads::DOUBLE / gene_reads * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS share FROM g""")
def junction_share_of_gene(junction_reads):
    return splicing.gene_share(junction_reads)


@_query("junction_reads", "exons", sql="""
, j AS (SELECT chr, j_start, j_end, sum(reads)::BIGINT AS support FROM junction_reads GROUP BY ALL),
a AS (SELECT chr, "end" AS j_start, string_agg(DISTINCT exon_id, ';' ORDER BY exon_id) AS exons1 FROM exons GROUP BY ALL),
b AS (SELECT chr, start AS j_end, string_agg(DISTINCT exon_id, ';' ORDER BY exon_id) AS exons2 FROM exons GROUP BY ALL)
SELECT j.*, coalesce(exons1, '-') AS exons1, coalesce(exons2, '-') AS exons2 FROM j LEFT JOIN a USING (chr, j_start) LEFT JOIN b USING (chr, j_end)""")
def junction_exons(junction_reads, exons):
    return splicing.junction_exons(junction_reads.groupBy("chr", "j_start", "j_end").agg(F.sum("reads").alias("support")), exons)


@_query("junction_reads", "exons", "exon_transcripts", sql=_ANN + """
SELECT j.lane, CASE WHEN an.chr IS NULL THEN 'novel' ELSE 'known' END AS type, sum(j.reads)::BIGINT AS reads, count(DISTINCT j.chr || '_' || j.j_start || '_' || j.j_end) AS junctions
FROM junction_reads j LEFT JOIN (SELECT DISTINCT chr, start, "end" FROM an) an ON an.chr = j.chr AND an.start = j.j_start AND an."end" = j.j_end GROUP BY ALL""")
def known_and_novel_junctions(junction_reads, exons, bridge):
    known = splicing.annotated_junctions(exons, bridge).select("chr", F.col("start").alias("j_start"), F.col("end").alias("j_end"), F.lit(True).alias("_k")).distinct()
    rows = junction_reads.groupBy("lane", "chr", "j_start", "j_end").agg(F.sum("reads").alias("reads")).join(known, ["chr", "j_start", "j_end"], "left")
    return rows.groupBy("lane", F.when(F.col("_k"), "known").otherwise("novel").alias("type")).agg(F.sum("reads").alias("reads"), F.count(F.lit(1)).alias("junctions"))


# Maps

_CLASS = "CASE WHEN {c} IS NULL OR regexp_matches({c}, '^(0(:0)*|-.*|(0:)*!.*)$') THEN 'unmapped' WHEN regexp_matches({c}, '^(0:)*1(:|$)') THEN 'unique' ELSE 'multi' END"
_BEST = f"""
, s AS (SELECT *, CASE WHEN {_CLASS.format(c="genome")} <> 'unmapped' THEN length(regexp_extract(genome, '^((?:0:)*)[1-9]', 1)) // 2 END AS g,
CASE WHEN {_CLASS.format(c="junction")} <> 'unmapped' THEN length(regexp_extract(junction, '^((?:0:)*)[1-9]', 1)) // 2 END AS j FROM maps),
t AS (SELECT *, CASE WHEN g IS NOT NULL AND (j IS NULL OR g <= j) THEN 'genome' WHEN j IS NOT NULL THEN 'junction' WHEN {_CLASS.format(c="split")} <> 'unmapped' THEN 'split'
WHEN {_CLASS.format(c="recursive")} <> 'unmapped' THEN 'recursive' ELSE 'genome' END AS source FROM s),
best AS (SELECT pair_id, mate, lane, source, CASE source WHEN 'genome' THEN genome WHEN 'junction' THEN junction WHEN 'split' THEN split ELSE recursive END AS strata FROM t)"""


@_query("maps", sql=f"""SELECT lane, count(*) AS total, sum(({_CLASS.format(c="genome")} <> 'unmapped')::INT)::BIGINT AS mapped, sum(({_CLASS.format(c="genome")} = 'unique')::INT)::BIGINT AS unique_reads,
sum(regexp_matches(genome, '^1(:0)*$')::INT)::BIGINT AS exact FROM maps GROUP BY lane""")
def mapping_stats(m):
    return maps.mapping_stats(m, "genome")


@_query("maps", sql=_BEST + " SELECT * FROM best")
def best_maps(m):
    return maps.best_map(m)


@_query("maps", sql=_BEST + f""", p AS (SELECT lane, pair_id, min(({_CLASS.format(c="strata")} = 'unique')::INT) AS u, min(({_CLASS.format(c="strata")} = 'unmapped')::INT) AS n FROM best GROUP BY ALL)
SELECT lane, CASE WHEN u = 1 THEN 'unique' WHEN n = 1 THEN 'unmapped' ELSE 'multi' END AS class, count(*) AS pairs FROM p GROUP BY ALL""")
def pair_classes(m):
    return maps.pair_classes(maps.best_map(m))


@_query("genome_maps", "junction_maps", sql=f"""SELECT pair_id, mate, lane FROM genome_maps WHERE {_CLASS.format(c="strata")} = 'unmapped' AND (pair_id, mate) NOT IN (SELECT (pair_id, mate) FROM junction_maps WHERE {_CLASS.format(c="strata")} <> 'unmapped')""")
def unmapped_reads(genome, junction):
    return maps.unmapped_in_both(genome, junction)


# Reads


@_query("reads", sql="""SELECT lane, min(length(seq))::INT AS length, count(*) AS total, sum((NOT regexp_matches(seq, '[N.]'))::INT)::BIGINT AS good, sum(regexp_matches(seq, '[N.]')::INT)::BIGINT AS ambiguous, count(DISTINCT seq) AS distinct_seqs
FROM reads GROUP BY lane""")
def read_stats(r):
    return reads.read_stats(r)


@_query("reads", sql="""
, b AS (SELECT lane, pos, seq[pos] AS b, ascii(qual[pos]) AS q FROM (SELECT lane, seq, qual, unnest(range(1, length(seq) + 1)) AS pos FROM reads))
SELECT lane, pos::INT AS pos, sum((b IN ('N', '.'))::INT)::BIGINT AS ambiguous, sum((b = 'A')::INT)::BIGINT AS a, sum((b = 'C')::INT)::BIGINT AS c, sum((b = 'G')::INT)::BIGINT AS g, sum((b = 'T')::INT)::BIGINT AS t,
sum(q - 33)::DOUBLE / any_value(n) AS mean_quality FROM b JOIN (SELECT lane, count(*) AS n FROM reads GROUP BY lane) USING (lane) GROUP BY lane, pos""")
def base_and_quality_by_position(r):
    return reads.per_position(r)


@_query("reads", sql="""
, c AS (SELECT lane, read_id, pos, ascii(qual[pos]) AS v FROM (SELECT lane, read_id, qual, unnest(range(1, length(qual) + 1)) AS pos FROM reads)),
k AS (SELECT lane, arg_min(CASE WHEN v < 59 OR v > 104 THEN 'phred' ELSE 'solexa' END, read_id * 1000 + pos) AS encoding FROM c WHERE v < 59 OR v > 104 OR v BETWEEN 96 AND 104 GROUP BY lane)
SELECT DISTINCT lane, coalesce(encoding, 'solexa') AS encoding FROM reads LEFT JOIN k USING (lane)""")
def quality_encoding(r):
    return reads.quality_encoding(r)


@_query("reads", sql="""
, t AS (SELECT read_id, lane, regexp_replace(substring(seq, 1, greatest(length(seq) - 15, 0)), '[N.]+$', '') AS seq, qual FROM reads)
SELECT read_id, lane, seq, substring(qual, 1, length(seq)) AS qual FROM t WHERE length(seq) > 40""")
def trimmed_reads(r):
    return reads.trimmed(r.select("read_id", "lane", "seq", "qual"))


@_query("reads", sql="""
, t AS (SELECT read_id, lane, length(regexp_extract(seq, '^([N.]*)', 1)) AS l, regexp_replace(seq, '^[N.]+|[N.]+$', '', 'g') AS s, qual FROM reads WHERE matches = '0:0:0')
SELECT read_id, lane, s AS seq, substring(qual, l + 1, length(s)) AS qual FROM t WHERE length(s) > 40""")
def clear_read_ends(r):
    return reads.clear_ends(r)


@_query("reads", sql="""
, m AS (SELECT read_id::VARCHAR || '/1' AS id, lane, substring(seq, 1, 38) AS seq, 2 AS k FROM reads UNION ALL SELECT read_id::VARCHAR || '/2', lane, substring(seq, 39), 1 FROM reads)
SELECT id, lane, seq FROM m WHERE length(seq) - length(regexp_replace(seq, '[N.]', '', 'g')) <= k""")
def mates_of_pairs(r):
    return reads.mates_of_concatenated(r, 38, 1)


@_query("reads", sql="SELECT read_id, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) AS seq FROM reads")
def reverse_complements(r):
    return r.select("read_id", text.reverse_complement(F.col("seq")).alias("seq"))


# Comparison


@_query("experiments", sql="""SELECT project_id, cell_type, rna_type, compartment, count(DISTINCT bioreplicate) AS replicates, count(*) AS experiments FROM experiments GROUP BY ALL HAVING replicates = 2""")
def replicate_groups(e):
    return compare.replicate_groups(e)


@_query("transcript_expression", sql="""
, a AS (SELECT transcript_id, rpkm FROM transcript_expression WHERE sample = 's0'), b AS (SELECT transcript_id, rpkm FROM transcript_expression WHERE sample = 's1')
SELECT coalesce(a.transcript_id, b.transcript_id) AS transcript_id, CASE WHEN coalesce(a.rpkm, 0) = 0 THEN -1 ELSE a.rpkm END AS score1, CASE WHEN coalesce(b.rpkm, 0) = 0 THEN -1 ELSE b.rpkm END AS score2
FROM a FULL JOIN b ON a.transcript_id = b.transcript_id""")
def matched_replicates(t):
    return compare.matched(t.where("sample = 's0'"), t.where("sample = 's1'"), "transcript_id", "rpkm")


# Hits and mates

_HITS = r""", st AS (SELECT *, string_split(strata, ':') AS l, [coalesce(try_cast(x AS INT), 0) FOR x IN string_split(strata, ':')] AS c FROM hit_maps),
bs AS (SELECT *, coalesce(list_position([x <> 0 FOR x IN c], true), 0) AS b, coalesce(list_position([x = '!' FOR x IN l], true), 0) AS o FROM st),
kn AS (SELECT *, CASE WHEN o > 0 AND (b = 0 OR o < b) THEN 0 ELSE list_sum(c[greatest(b, 1):greatest(b, 1) + 1])::INT END AS n FROM bs),
hl AS (SELECT pair_id, mate, lane, n, CASE WHEN n > 0 THEN string_split(hits, ',')[1:n] ELSE [] END AS kept FROM kn),
ht AS (SELECT pair_id, mate, lane, i - 1 AS ordinal, kept[i] AS h FROM (SELECT *, unnest(range(1, len(kept) + 1)) AS i FROM hl)),
hc AS (SELECT pair_id, mate, lane, ordinal, split_part(h, ':', 1) AS chr, CASE WHEN split_part(h, ':', 2)[1] = 'F' THEN '+' ELSE '-' END AS strand,
regexp_extract(h, ':[FR]([0-9]+)', 1)::BIGINT AS start, regexp_extract(h, ':[FR]([0-9]+)', 1)::BIGINT + 49 AS "end", regexp_extract(h, '/([0-9]+)$', 1)::INT AS mismatches FROM ht)"""
_RESCUE = """, nn AS (SELECT *, count(*) OVER (PARTITION BY pair_id, mate) AS k FROM hc),
rs AS (SELECT pair_id, mate, distance, ordinal, chr, strand, start, "end" FROM (SELECT m.*, abs((u.start + u."end") // 2 - (m.start + m."end") // 2) AS distance,
row_number() OVER (PARTITION BY m.pair_id, m.mate ORDER BY abs((u.start + u."end") // 2 - (m.start + m."end") // 2), m.ordinal) AS r
FROM nn m JOIN nn u ON u.pair_id = m.pair_id AND u.k = 1 AND m.k > 1 AND u.chr = m.chr AND u.strand <> m.strand) WHERE r = 1)"""


def _kept(listed):
    return hits.best_hits(listed, mismatches=2, closest=1)


@_query("hit_maps", sql=_HITS + " SELECT * FROM hc")
def best_hits(listed):
    return hits.hit_coordinates(_kept(listed), 50)


@_query("hit_maps", sql=_HITS + _RESCUE + " SELECT * FROM rs")
def rescued_mates(listed):
    return hits.rescued_mates(hits.hit_coordinates(_kept(listed), 50))


@_query("hit_maps", sql=_HITS + _RESCUE + """, pn AS (SELECT lane, pair_id, sum(n) FILTER (mate = 1) AS n1, sum(n) FILTER (mate = 2) AS n2 FROM hl GROUP BY ALL)
SELECT lane, CASE WHEN n1 = 1 AND n2 = 1 THEN 'double_unique' WHEN pair_id IN (SELECT pair_id FROM rs) THEN 'recovered' WHEN n1 = 1 THEN 'read1_unique' WHEN n2 = 1 THEN 'read2_unique'
WHEN n1 + n2 > 0 THEN 'both_multi' ELSE 'no_hit' END AS outcome, count(*) AS pairs FROM pn GROUP BY ALL""")
def pair_outcomes(listed):
    kept = _kept(listed)
    return hits.pair_outcomes(kept, hits.rescued_mates(hits.hit_coordinates(kept, 50)))


@_query("maps", sql=f"""SELECT pair_id, mate, lane FROM maps WHERE pair_id NOT IN (SELECT pair_id FROM maps WHERE {_CLASS.format(c="genome")} = 'unique' AND {_CLASS.format(c="junction")} <> 'unmapped')""")
def without_pseudogenes(m):
    return hits.without_pseudogenes(m).select("pair_id", "mate", "lane")


@_query("hit_maps", "maps", sql=f"""
, ro AS (SELECT pair_id, mate, 1 AS round, 50 AS length, strata FROM hit_maps UNION ALL SELECT pair_id, mate, 2, 35, recursive FROM maps),
ra AS (SELECT *, row_number() OVER (PARTITION BY pair_id, mate ORDER BY ({_CLASS.format(c="strata")} = 'unmapped')::INT, length DESC, round) AS r FROM ro)
SELECT pair_id, mate, round, length, strata FROM ra WHERE r = 1""")
def combined_rounds(listed, m):
    one = listed.select("pair_id", "mate", F.lit(1).alias("round"), F.lit(50).alias("length"), "strata")
    return hits.combined_rounds(one.unionByName(m.select("pair_id", "mate", F.lit(2).alias("round"), F.lit(35).alias("length"), F.col("recursive").alias("strata"))))


# Fusions

_FUSION = f""", gn AS (SELECT DISTINCT transcript_id, gene_id FROM exon_transcripts), ge AS (SELECT gene_id, sum(rpkm) AS rpkm FROM transcript_expression GROUP BY gene_id),
pl AS (SELECT t.pair_id, t.mate, t.transcript_id, gn.gene_id, coalesce(ge.rpkm, 0) AS rpkm FROM transcript_maps t JOIN hit_maps g ON g.pair_id = t.pair_id AND g.mate = t.mate AND g.strata = t.strata AND g.mismatches = t.mismatches
JOIN gn ON gn.transcript_id = t.transcript_id LEFT JOIN ge ON ge.gene_id = gn.gene_id WHERE {_CLASS.format(c="t.strata")} = 'unique'),
fc AS (SELECT a.pair_id, a.transcript_id AS transcript1, a.gene_id AS gene1, a.rpkm AS rpkm1, b.transcript_id AS transcript2, b.gene_id AS gene2, b.rpkm AS rpkm2,
CASE WHEN a.gene_id <> b.gene_id THEN 'Fusion' ELSE 'Variant' END AS label FROM pl a JOIN pl b ON a.pair_id = b.pair_id AND a.mate = 1 AND b.mate = 2 WHERE a.transcript_id <> b.transcript_id)"""
_FUSION_VIEWS = ("transcript_maps", "hit_maps", "exon_transcripts", "transcript_expression")


def _fusions(transcript_maps, listed, bridge, expressed):
    genes = bridge.select("transcript_id", "gene_id").distinct()
    return fusions.fusion_candidates(transcript_maps, listed, genes, expressed.groupBy("gene_id").agg(F.sum("rpkm").alias("rpkm")))


@_query(*_FUSION_VIEWS, sql=_FUSION + " SELECT * FROM fc")
def fusion_candidates(*views):
    return _fusions(*views)


_FUSED = _FUSION + _HITS.replace("c[greatest(b, 1):greatest(b, 1) + 1]", "c[greatest(b, 1):greatest(b, 1)]") + """, fh AS (SELECT 'all' AS sample, chr, start, "end", strand FROM hc WHERE pair_id IN (SELECT pair_id FROM fc WHERE label = 'Fusion')
AND (pair_id, mate) IN (SELECT (pair_id, mate) FROM hc GROUP BY pair_id, mate HAVING count(*) = 1)),
fo AS (SELECT *, max("end") OVER (PARTITION BY chr ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM fh),
fn AS (SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY chr ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS r FROM fo)"""


@_query(*_FUSION_VIEWS, sql=_FUSED + """ SELECT sample, chr, min(start) AS start, max("end") AS "end", CASE WHEN min(strand) = max(strand) THEN min(strand) ELSE '.' END AS strand, count(*) AS included
FROM fn GROUP BY sample, chr, r HAVING count(*) >= 2""")
def fusion_read_clusters(*views):
    found = fusions.fusion_hits(hits.hit_coordinates(hits.best_hits(views[1]), 50), _fusions(*views))
    return intervals.read_clusters(found.withColumn("sample", F.lit("all")), 2)


_LINKS = """
, o AS (SELECT *, max("end") OVER (PARTITION BY sample, chr ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM alignments),
n AS (SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY sample, chr ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS r FROM o),
cl AS (SELECT sample, chr, min(start) AS start, max("end") AS "end", chr || '_' || min(start) || '_' || max("end") AS cluster FROM n GROUP BY sample, chr, r HAVING count(*) >= 5),
th AS (SELECT a.sample, a.read_id, a.fragment, c.chr, c.cluster FROM fragments a JOIN cl c ON a.sample = c.sample AND a.chr = c.chr AND a.start <= c."end" AND a."end" >= c.start),
re AS (SELECT sample, read_id, min(cluster) AS cluster1, max(cluster) AS cluster2, count(DISTINCT cluster) AS k, min(chr) = max(chr) AS one FROM th GROUP BY sample, read_id HAVING count(DISTINCT fragment) = 2)
SELECT sample, cluster1, cluster2, CASE WHEN k = 1 THEN 'close' WHEN one THEN 'far' ELSE 'interchrom' END AS type, count(*) AS reads FROM re WHERE k <= 2 GROUP BY ALL HAVING count(*) >= 2"""


@_query("alignments", "fragments", sql=_LINKS)
def cluster_links(alignments, fragments):
    return fusions.cluster_links(fragments, intervals.read_clusters(alignments, 5), 2)


@_query("splits", sql="SELECT chr1 || '_' || start || '_' || chr2 || '_' || \"end\" AS fusion, " + ", ".join(f"count(*) FILTER (sample = '{s}') AS {s}" for s in SAMPLES) + " FROM splits WHERE chr1 <> chr2 GROUP BY fusion")
def fusion_matrix(splits):
    rows = splits.where("chr1 <> chr2").groupBy(F.concat_ws("_", "chr1", "start", "chr2", "end").alias("fusion"))
    return rows.agg(*[F.count(F.when(F.col("sample") == s, 1)).alias(s) for s in SAMPLES])


# Summaries


@_query("junction_reads", "splits", sql="""SELECT sample, chr || '_' || j_start || '_' || j_end AS key, sum(reads)::BIGINT AS support, 'junction' AS source FROM junction_reads GROUP BY ALL
UNION ALL SELECT sample, chr1 || ',' || chr2 || ',' || start || ',' || "end", count(*), 'split' FROM splits GROUP BY ALL""")
def all_junctions(junction_reads, splits):
    return splicing.classified_junctions(junction_reads, splits)


@_query("exons", "exon_transcripts", "junction_reads", "splits", sql=_SHARED + _ANN + """, ct AS (SELECT pr.chr, pr.start, pr."end", min(CASE WHEN an.gene_id IS NULL THEN 'novel' ELSE 'known' END) AS type
FROM pr LEFT JOIN an ON an.gene_id = pr.gene_id AND an.chr = pr.chr AND an.start = pr.start AND an."end" = pr."end" GROUP BY ALL)
SELECT type, count(*) AS total, count(f.chr) AS detected FROM ct LEFT JOIN (SELECT DISTINCT chr, j_start, j_end FROM junction_reads) f ON f.chr = ct.chr AND j_start = ct.start AND j_end = ct."end" GROUP BY type
UNION ALL SELECT 'split', count(*), count(*) FROM (SELECT DISTINCT chr1, chr2, start, "end" FROM splits WHERE NOT (chr1 = chr2 AND abs("end" - start) <= 500))""")
def splicing_summary(exons, bridge, junction_reads, splits):
    return splicing.splicing_summary(splicing.junction_catalogue(exons, bridge), junction_reads, splits, 500)


_CELLS = ", ".join(f"coalesce(sum(reads) FILTER (sample = '{s}'), 0)::BIGINT AS {s}" for s in SAMPLES)


@_query("junction_reads", sql=f""", jc AS (SELECT chr, j_start, j_end, sample, sum(reads) AS reads FROM junction_reads GROUP BY ALL)
SELECT chr, j_start, j_end, {_CELLS} FROM jc GROUP BY chr, j_start, j_end HAVING count(*) FILTER (reads >= 2) >= 2""")
def junction_matrix(junction_reads):
    return splicing.junction_matrix(junction_reads, SAMPLES, 2, 2)


_RATES = ", ".join(f"coalesce(max(floor(psi * 100 + 0.5::DOUBLE)) FILTER (sample = '{s}'), 0)::BIGINT AS {s}" for s in SAMPLES)


@_query("alignments", "exons", "junction_reads", sql=_PSI + f", wi AS (SELECT exon_id, {_RATES} FROM psi WHERE ex_incl + junc_inc + junc_exc >= 5 GROUP BY exon_id) "
        + " UNION ".join(f"SELECT '{a}' AS sample1, '{b}' AS sample2, {a} AS rate1, {b} AS rate2 FROM wi" for a in SAMPLES for b in SAMPLES if a != b))
def inclusion_pairs(alignments, exons, junction_reads):
    return splicing.inclusion_pairs(_psi(alignments, exons, junction_reads), SAMPLES)


@_query("transcript_reads", sql="""
, ba AS (SELECT lane, length, unnest(range(start, "end" + 1, 2)) AS pos FROM transcript_reads),
pc AS (SELECT lane, CASE WHEN length < 1000 THEN '1_999' WHEN length < 3000 THEN '1000_2999' WHEN length < 6000 THEN '3000_5999' WHEN length < 9000 THEN '6000_8999' ELSE '9000_n' END AS class,
((pos * 20000 + length) // (2 * length) + 50) // 100 AS percent FROM ba)
SELECT lane, class, percent, count(*) AS bases FROM pc GROUP BY ALL UNION ALL SELECT lane, 'All', percent, count(*) FROM pc GROUP BY ALL""")
def transcript_coverage(r):
    return expression.coverage_profile(r)


@_query("transcript_expression", sql=f"""SELECT f.transcript_id, s.sample, coalesce(e.rpkm, 0) AS rpkm FROM (SELECT DISTINCT transcript_id FROM transcript_expression) f
CROSS JOIN (SELECT unnest({SAMPLES}) AS sample) s LEFT JOIN transcript_expression e ON e.transcript_id = f.transcript_id AND e.sample = s.sample""")
def individual_transcripts(t):
    return compare.individual_features(t, t, "transcript_id", SAMPLES)


@_query("maps", sql=f"""SELECT CASE WHEN lane = 'P' THEN 'e2' ELSE 'e1' END AS experiment, count(*) AS total, sum(({_CLASS.format(c="genome")} <> 'unmapped')::INT)::BIGINT AS mapped,
sum(({_CLASS.format(c="genome")} = 'unique')::INT)::BIGINT AS unique_reads FROM maps GROUP BY experiment""")
def experiment_totals(m):
    return compare.experiment_totals(maps.mapping_stats(m, "genome"), F.when(F.col("lane") == "P", "e2").otherwise("e1"))


@_query("exons", "exon_transcripts", sql="""SELECT type, count(*) AS n, CASE WHEN type = 'exon' THEN count(*) < 10000 ELSE count(*) < 1 END AS suspect FROM (
SELECT DISTINCT 'exon' AS type, exon_id AS id FROM exons UNION SELECT 'gene', gene_id FROM exons UNION SELECT 'transcript', transcript_id FROM exon_transcripts) GROUP BY type""")
def annotation_checks(exons, bridge):
    kinds = (exons.select("exon_id"), exons.select("gene_id"), bridge.select("transcript_id"))
    rows = [k.distinct().toDF("id").withColumn("type", F.lit(t)) for k, t in zip(kinds, ("exon", "gene", "transcript"))]
    return compare.annotation_checks(rows[0].unionByName(rows[1]).unionByName(rows[2]))
