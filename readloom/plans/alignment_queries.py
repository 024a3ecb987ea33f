"""Queries over alignments as a mapper gives them: filters, flags, junctions, splits, routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.functions import text
from readloom.operators import alignments as al
from readloom.operators import expression, hits, intervals, maps, reads, splicing
from readloom.plans.registry import _ANN, _BEST, _CLASS, _HITS, _M, _RESCUE, _SHARED, _as_features, _kept, _query

_FLAGS = """, fl AS (SELECT *, contains(cigar, 'N') AS spliced, CASE WHEN coalesce(regexp_matches(strata, '^(0:)*1(:.)*'), false) OR coalesce(nh_tag = 1, false) THEN true
WHEN strata IS NOT NULL OR coalesce(nh_tag > 1, false) THEN false ELSE count(*) OVER (PARTITION BY read_id, read_no) = 1 END AS uniq FROM sam WHERE NOT contains(cigar, '*'))"""


@_query("sam", sql="""SELECT read_id, read_no, chr, start, cigar, sample FROM sam WHERE NOT contains(cigar, '-') AND NOT contains(cigar, 'H')
AND NOT (regexp_matches(cigar, '^[0-9]+M[0-9]+N[0-9]+M$') AND try_cast(regexp_extract(cigar, 'M([0-9]+)N', 1) AS BIGINT) > 50000)""")
def valid_alignments(sam):
    return al.valid(sam).select("read_id", "read_no", "chr", "start", "cigar", "sample")


@_query("sam", sql=_FLAGS + ' SELECT read_id, read_no, chr, start, sample, spliced, uniq AS "unique" FROM fl')
def flagged_alignments(sam):
    return al.flagged(sam).select("read_id", "read_no", "chr", "start", "sample", "spliced", "unique")


@_query("sam", sql=_FLAGS + " SELECT sample, CASE WHEN uniq THEN 'unique' ELSE 'multi' END || CASE WHEN spliced THEN '_junction' ELSE '_genome' END AS route, count(*) AS alignments FROM fl GROUP BY ALL")
def alignment_routes(sam):
    return al.routed(al.flagged(sam)).groupBy("sample", "route").agg(F.count(F.lit(1)).alias("alignments"))


@_query("sam", sql="""
, d AS (SELECT DISTINCT * FROM sam WHERE cigar <> '*')
SELECT read_id, read_no, chr, start, strand, sample, lane, count(*) OVER (PARTITION BY read_id, read_no, cigar) AS nh FROM d""")
def distinct_hit_multiplicity(sam):
    return expression.with_multiplicity(sam.where("cigar <> '*'").distinct(), ("read_id", "read_no", "cigar")).select("read_id", "read_no", "chr", "start", "strand", "sample", "lane", "nh")


@_query("sam", "exons", sql="""
, c AS (SELECT * FROM sam WHERE nm <= 2 AND (strata IS NULL OR NOT regexp_matches(strata, '(^|:)([2-9]|[1-9][0-9]+)(:|$)')) AND cigar <> '*' AND NOT regexp_matches(cigar, '[0-9]+M[0-9]+[NI][0-9]+M'))
SELECT exon_id, sample, sum(CASE WHEN a.strand = '+' THEN 1 ELSE 0 END)::BIGINT AS forward, sum(CASE WHEN a.strand = '-' THEN 1 ELSE 0 END)::BIGINT AS reverse, count(*) AS reads
FROM (SELECT DISTINCT exon_id, chr, start, "end" FROM exons) e JOIN c a ON a.chr = e.chr AND a.start >= e.start AND a."end" <= e."end" GROUP BY exon_id, sample""")
def exon_containment(sam, exons):
    return expression.containment_counts(al.countable(sam), _as_features(exons).drop("gene_id").distinct(), "exon_id")


_COVERED = """SELECT {f}, sample, count(*) AS reads, max(f."end" - f.start + 1) AS length, '{kind}' AS type, floor(count(*)::DOUBLE / max(f."end" - f.start + 1) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS coverage
FROM {t} f JOIN alignments a ON a.chr = f.chr AND a.start >= f.start AND a."end" <= f."end" GROUP BY {f}, sample, f.start, f."end" """


@_query("alignments", "exons", sql=_M + ', ex AS (SELECT DISTINCT exon_id, chr, start, "end" FROM exons), pj AS (SELECT gene_id || \'_\' || start AS projection, chr, start, "end" FROM proj) '
        + "SELECT exon_id AS feature, * EXCLUDE (exon_id) FROM (" + _COVERED.format(f="exon_id", t="ex", kind="exon") + ") UNION ALL SELECT projection, * EXCLUDE (projection) FROM (" + _COVERED.format(f="projection", t="pj", kind="projection") + ")")
def annotated_coverage(alignments, exons):
    of = lambda df, c: df.select(c.alias("feature"), "chr", F.col("start").alias("f_start"), F.col("end").alias("f_end")).distinct()
    one = al.feature_coverage(alignments, of(exons, F.col("exon_id")), "feature", "exon")
    proj = intervals.gene_projections(exons)
    return one.unionByName(al.feature_coverage(alignments, of(proj, F.concat_ws("_", "gene_id", "start")), "feature", "projection"))


_GAPS = """, gp AS (SELECT chr, sample, lane, start + 19 AS j_start, start + 20 + regexp_extract(cigar, 'M([0-9]+)N', 1)::BIGINT AS j_end, cigar FROM spliced
UNION ALL SELECT chr, sample, lane, start + 19 + regexp_extract(cigar, 'M([0-9]+)N', 1)::BIGINT + 15, start + 19 + regexp_extract(cigar, 'M([0-9]+)N', 1)::BIGINT + 15 + 301, cigar FROM spliced WHERE contains(cigar, 'N15M')),
jn AS (SELECT chr, j_start, j_end, sample, count(*) AS reads FROM gp GROUP BY ALL)"""


@_query("spliced", sql=_GAPS + " SELECT * FROM jn")
def junction_support(spliced):
    return al.junction_reads(spliced, 50)


@_query("spliced", "exons", sql=_GAPS + _SHARED + ", ca AS (SELECT DISTINCT gene_id, chr, start AS j_start, \"end\" AS j_end FROM pr) SELECT gene_id, sample, sum(reads)::BIGINT AS reads FROM jn JOIN ca USING (chr, j_start, j_end) GROUP BY ALL")
def junction_contributions(spliced, exons):
    found = al.with_genes(al.junction_reads(spliced, 50), splicing.exon_pairs(exons))
    return found.groupBy("gene_id", "sample").agg(F.sum("reads").alias("reads"))


@_query("spliced", "exons", "exon_transcripts", sql=_GAPS + _ANN + """SELECT lane, chr, j_start, j_end, count(*) AS reads FROM gp
WHERE (chr, j_start, j_end) NOT IN (SELECT (chr, start, "end") FROM an) GROUP BY ALL""")
def novel_junctions(spliced, exons, bridge):
    known = splicing.annotated_junctions(exons, bridge).select("chr", F.col("start").alias("j_start"), F.col("end").alias("j_end")).distinct()
    return al.junction_reads(spliced, 50, ("lane",)).join(known, ["chr", "j_start", "j_end"], "left_anti")


@_query("split_hits", sql="""SELECT lane, CASE WHEN chr1 <> chr2 THEN 'DifChrom' WHEN strand1 <> strand2 THEN 'SameChrDifStrand'
WHEN strand1 = '+' AND start1 > end2 OR strand1 = '-' AND end1 < start2 THEN 'SameChr&StrandRev' WHEN strand1 = '+' AND end1 > start2 OR strand1 = '-' AND start1 < end2 THEN 'SameChr&StrandOver'
ELSE 'SameChr&StrandOK' END AS type, count(*) AS hits FROM split_hits GROUP BY ALL""")
def split_types(splits):
    return al.split_type(splits)


@_query("split_hits", sql="""SELECT chr1 || chr(9) || (start1 - 1) || chr(9) || end2 || chr(9) || hit_id || chr(9) || '0' || chr(9) || strand1 || chr(9) || (start1 - 1) || chr(9) || end2 || chr(9) || '0' || chr(9) || '2' || chr(9)
|| (end1 - start1 + 1) || ',' || (end2 - start2 + 1) || chr(9) || '0,' || (start2 - start1) AS value FROM split_hits WHERE chr1 = chr2 AND strand1 = strand2 AND end1 < start2""")
def split_bed_lines(splits):
    return al.bed_blocks(splits)


@_query("split_texts", sql=r"""
, n AS (SELECT row_number() OVER () AS rn, read_id, regexp_extract(hit, '^\[([0-9]+)', 1)::BIGINT AS p, regexp_extract(hit, '^\[[0-9]+-([0-9]+)', 1)::BIGINT AS q, regexp_extract(hit, '=([^:]+):', 1) AS c1, regexp_extract(hit, '=[^:]+:(.)', 1) AS s1,
  regexp_extract(hit, '=[^:]+:.\[?([0-9]+)', 1)::BIGINT AS a1, coalesce(try_cast(regexp_extract(hit, '=[^:]+:.\[[0-9]+-([0-9]+)', 1) AS BIGINT), regexp_extract(hit, '=[^:]+:.\[?([0-9]+)', 1)::BIGINT) AS b1,
  regexp_extract(hit, '~([^:]+):', 1) AS c2, regexp_extract(hit, '~[^:]+:(.)', 1) AS s2, regexp_extract(hit, '~[^:]+:.\[?([0-9]+)', 1)::BIGINT AS a2,
  coalesce(try_cast(regexp_extract(hit, '~[^:]+:.\[[0-9]+-([0-9]+)', 1) AS BIGINT), regexp_extract(hit, '~[^:]+:.\[?([0-9]+)', 1)::BIGINT) AS b2 FROM split_texts),
i AS (SELECT *, unnest(range(0, q - p + 1)) AS i FROM n),
e AS (SELECT *, CASE WHEN a1 = b1 THEN a1 WHEN a1 > b1 THEN a1 - i ELSE a1 + i END AS t1, CASE WHEN a2 = b2 THEN a2 WHEN a2 > b2 THEN a2 - i ELSE a2 + i END AS t2 FROM i
  WHERE CASE WHEN s1 = 'R' THEN abs(b1 - a1) = q - p ELSE a1 <= b1 AND (b1 - a1 = q - p OR a1 = b1) END AND CASE WHEN s2 = 'F' THEN abs(b2 - a2) = q - p ELSE a2 <= b2 AND (b2 - a2 = q - p OR a2 = b2) END)
SELECT read_id, c1 AS chr1, CASE WHEN s1 = 'F' THEN '+' ELSE '-' END AS strand1, min(t1) AS start1, max(t1 + p + i - 1) AS end1, c2 AS chr2, CASE WHEN s2 = 'F' THEN '+' ELSE '-' END AS strand2, min(t2) AS start2, max(t2 + 50 - (p + i) - 1) AS end2
FROM e GROUP BY rn, read_id, c1, s1, c2, s2""")
def split_ranges(texts):
    return al.split_ranges(texts, 50)


@_query("alignments", "exons", sql="""
, e AS (SELECT DISTINCT exon_id, chr, start, "end", strand FROM exons)
SELECT exon_id, sample, count(*) AS reads FROM e JOIN alignments a ON a.chr = e.chr AND a.strand = e.strand AND a.start <= e."end" AND a."end" >= e.start GROUP BY exon_id, sample""")
def stranded_overlaps(alignments, exons):
    features = exons.select("exon_id", "chr", "strand", F.col("start").alias("f_start"), F.col("end").alias("f_end")).distinct()
    places = alignments.groupBy("sample", "chr", "strand", "start", "end").agg(F.count(F.lit(1)).alias("n"))
    return intervals.overlapping(places, features, keys=("chr", "strand")).groupBy("exon_id", "sample").agg(F.sum("n").alias("reads"))


# Hits on junction sequences: exon 1 and exon 2 of a pair, a read of 40 bases at some place.

_ON_JUNCTION = """, el AS (SELECT DISTINCT exon_id, start, "end" FROM exons), jq AS (SELECT pr.chr, pr.strand, a.start AS s1, a."end" AS e1, b.start AS s2, b."end" AS e2,
1 + (a.start + b.start) % (a."end" - a.start + b."end" - b.start - 38) AS p FROM pr JOIN el a ON a.exon_id = exon1_id JOIN el b ON b.exon_id = exon2_id),
ab AS (SELECT *, e1 - s1 + 1 AS half, CASE WHEN strand = '+' THEN p ELSE e1 - s1 + e2 - s2 + 2 - (p + 39) + 1 END AS a FROM jq),
pl AS (SELECT chr, s1, s2, p, CASE WHEN a + 39 <= half THEN s1 + a - 1 WHEN a > half THEN s2 + a - half - 1 ELSE s1 + a - 1 END AS start1,
CASE WHEN a + 39 <= half THEN s1 + a + 38 WHEN a > half THEN s2 + a + 38 - half ELSE e1 END AS end1,
CASE WHEN a + 39 > half AND a <= half THEN s2 END AS start2, CASE WHEN a + 39 > half AND a <= half THEN s2 + a + 38 - half END AS end2,
CASE WHEN a + 39 > half AND a <= half THEN half - a + 1 END AS "offset", CASE WHEN strand = '+' THEN 'F' ELSE 'R' END AS hit_strand FROM ab)"""


def _on_junctions(exons):
    sizes = lambda k: exons.select(F.col("exon_id").alias(f"exon{k}_id"), F.col("start").alias(f"s{k}"), F.col("end").alias(f"e{k}")).distinct()
    rows = splicing.exon_pairs(exons).join(sizes(1), "exon1_id").join(sizes(2), "exon2_id").withColumn("p", F.expr("1 + (s1 + s2) % (e1 - s1 + e2 - s2 - 38)"))
    c = F.col
    place = al.spliced_place(c("p"), c("p") + 39, c("s1"), c("e1"), c("s2"), c("e2"), c("strand"))
    return rows.withColumn("g", place).select("chr", "s1", "s2", "p", "g.*", al.junction_strand(c("strand"), F.lit("+")).alias("hit_strand"))


@_query("exons", sql=_SHARED + _ON_JUNCTION + " SELECT * FROM pl")
def junction_hit_places(exons):
    return _on_junctions(exons)


@_query("exons", sql=_SHARED + _ON_JUNCTION + """, ht AS (SELECT chr || ':' || (start1 // 200) AS read_id, CASE WHEN start2 IS NULL THEN chr || ':' || hit_strand || start1 ELSE '[' || "offset" || ']=' || chr || ':' || hit_strand || start1 || '~' || chr || ':' || hit_strand || start2 END AS hit,
start2 IS NOT NULL AS split, p % 3 AS mm FROM pl), oh AS (SELECT read_id, hit, split, min(mm) AS mm FROM ht GROUP BY ALL), bs AS (SELECT read_id, arg_min(split, mm * 2 + split::INT) AS s FROM oh GROUP BY read_id),
ow AS (SELECT oh.* FROM oh JOIN bs ON bs.read_id = oh.read_id AND bs.s = oh.split)
SELECT read_id, sum((mm = 0)::INT) || ':' || sum((mm = 1)::INT) || ':' || sum((mm = 2)::INT) AS strata, string_agg(hit, ',' ORDER BY mm, hit) AS hits FROM ow GROUP BY read_id""")
def collapsed_junction_hits(exons):
    rows = _on_junctions(exons)
    side = lambda k: F.concat(F.col("chr"), F.lit(":"), F.col("hit_strand"), F.col(f"start{k}").cast("string"))
    split = F.concat(F.lit("["), F.col("offset").cast("string"), F.lit("]="), side(1), F.lit("~"), side(2))
    listed = rows.select(F.concat_ws(":", "chr", F.expr("start1 div 200")).alias("read_id"), F.coalesce(split, side(1)).alias("hit"), F.col("start2").isNotNull().alias("split"), (F.col("p") % 3).alias("mm"))
    return al.collapsed_hits(listed, 2)


# Maps and mates


@_query("genome_maps", "junction_maps", "split_maps", "recursive_maps", "maps", sql=_BEST.replace("FROM maps", """FROM (SELECT pair_id, mate, lane, g.strata AS genome, j.strata AS junction, s.strata AS split, r.strata AS recursive
FROM genome_maps g FULL JOIN junction_maps j USING (pair_id, mate, lane) FULL JOIN split_maps s USING (pair_id, mate, lane) FULL JOIN recursive_maps r USING (pair_id, mate, lane))""") + " SELECT * FROM best")
def best_maps_of_four(genome, junction, split, recursive, _):
    return maps.best_map_of(genome=genome, junction=junction, split=split, recursive=recursive)


_PSEUDO = f""", ps AS (SELECT DISTINCT pair_id FROM maps WHERE {_CLASS.format(c="genome")} = 'unique' AND {_CLASS.format(c="junction")} <> 'unmapped')"""


@_query("hit_maps", "maps", sql=_HITS + _RESCUE + _PSEUDO + """, pn AS (SELECT lane, pair_id, sum(n) FILTER (mate = 1) AS n1, sum(n) FILTER (mate = 2) AS n2 FROM hl GROUP BY ALL)
SELECT lane, CASE WHEN pair_id IN (SELECT pair_id FROM ps) THEN 'pseudo' WHEN n1 = 1 AND n2 = 1 THEN 'double_unique' WHEN pair_id IN (SELECT pair_id FROM rs) THEN 'recovered' WHEN n1 = 1 THEN 'read1_unique' WHEN n2 = 1 THEN 'read2_unique'
WHEN n1 + n2 > 0 THEN 'both_multi' ELSE 'no_hit' END AS outcome, count(*) AS pairs FROM pn GROUP BY ALL""")
def pair_outcomes_with_pseudogenes(listed, m):
    kept = _kept(listed)
    return hits.pair_outcomes(kept, hits.rescued_mates(hits.hit_coordinates(kept, 50)), hits.pseudogene_pairs(m))


@_query("hit_maps", "maps", sql=_HITS + _RESCUE + _PSEUDO + """, pu AS (SELECT pair_id, max((n = 1)::INT) AS one FROM hl GROUP BY pair_id)
SELECT hc.pair_id, hc.mate, hc.lane, hc.ordinal, hc.chr, hc.strand, hc.start, hc."end", CASE WHEN hl.n = 1 OR rs.ordinal IS NOT NULL THEN 'unique' WHEN pu.one = 1 THEN 'unmatched' ELSE 'multi' END AS route
FROM hc JOIN hl USING (pair_id, mate) JOIN pu USING (pair_id) LEFT JOIN rs ON rs.pair_id = hc.pair_id AND rs.mate = hc.mate
WHERE hc.pair_id NOT IN (SELECT pair_id FROM ps) AND (rs.ordinal IS NULL OR rs.ordinal = hc.ordinal)""")
def routed_hits(listed, m):
    kept = _kept(listed)
    placed = hits.hit_coordinates(kept, 50)
    return hits.routed_hits(kept, placed, hits.rescued_mates(placed), hits.pseudogene_pairs(m))


@_query("hit_maps", sql=_HITS + """ SELECT pair_id, mate, ordinal, chr, CASE WHEN mate = 1 AND strand = '+' THEN '-' WHEN mate = 1 THEN '+' ELSE strand END AS strand, start FROM hc""")
def stranded_hits(listed):
    return hits.stranded(hits.hit_coordinates(_kept(listed), 50)).select("pair_id", "mate", "ordinal", "chr", "strand", "start")


@_query("sam", sql="""SELECT read_id, read_no, CASE WHEN nh_tag IS NULL THEN read_id || chr(9) || 'NH:i:1' ELSE read_id || chr(9) || 'NH:i:' || nh_tag END AS line FROM sam""")
def tagged_lines(sam):
    line = F.concat(F.col("read_id").cast("string"), F.coalesce(F.concat(F.lit("\tNH:i:"), F.col("nh_tag").cast("string")), F.lit("")))
    return sam.select("read_id", "read_no", hits.with_tag(line, "NH:i:", F.lit(1)).alias("line"))


@_query("sam", sql="""
, m AS (SELECT read_id AS id, read_no AS mate, min(start) AS pos, min(CASE WHEN read_id % 3 = 0 THEN start + 1 ELSE start END) AS mate_pos, min(abs(tlen)) AS tlen FROM sam WHERE read_no <= 2 GROUP BY ALL)
SELECT a.id, a.pos = b.mate_pos AND b.pos = a.mate_pos AND abs(a.tlen) = abs(b.tlen) AS consistent FROM m a JOIN m b ON a.id = b.id AND a.mate = 1 AND b.mate = 2""")
def consistent_pairs(sam):
    mate_pos = F.min(F.when(F.col("read_id") % 3 == 0, F.col("start") + 1).otherwise(F.col("start"))).alias("mate_pos")
    m = sam.where("read_no <= 2").groupBy(F.col("read_id").alias("id"), F.col("read_no").alias("mate")).agg(F.min("start").alias("pos"), mate_pos, F.min(F.abs("tlen")).alias("tlen"))
    return hits.consistent_mates(m)


# Reads


@_query("reads", sql="SELECT read_id, substring(seq, 1, 36) AS seq, substring(qual, 1, 36) AS qual FROM reads")
def fixed_length_reads(r):
    return reads.fixed_length(r, 36).select("read_id", "seq", "qual")


@_query("reads", sql="SELECT read_id, seq FROM reads WHERE length(seq) - length(regexp_replace(seq, '[N.]', '', 'g')) <= 2")
def unambiguous_reads(r):
    return reads.without_ambiguous(r, 2).select("read_id", "seq")


@_query("reads", sql="""
, i AS (SELECT read_id, CASE read_id % 3 WHEN 0 THEN lane || read_id || '|p1' WHEN 1 THEN lane || read_id || ' 2:N:0' ELSE lane || read_id END AS id FROM reads)
SELECT read_id, CASE read_id % 3 WHEN 0 THEN regexp_replace(id, '\\|p1$', '/1') WHEN 1 THEN regexp_replace(id, ' 2:(.*)$', '_X:\\1/2') ELSE id END AS id FROM i""")
def clean_read_ids(r):
    raw = F.concat("lane", F.col("read_id").cast("string"), F.element_at(F.array(F.lit("|p1"), F.lit(" 2:N:0"), F.lit("")), (F.col("read_id") % 3 + 1).cast("int")))
    return r.select("read_id", text.clean_id(raw).alias("id"))
