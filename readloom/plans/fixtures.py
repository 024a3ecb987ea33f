"""Genomic tables derived from the given tables by expressions that both engines read alike.

In the texts, ``@div`` is whole division, ``@end`` the quoted column name and
``@all`` what makes a regular expression replace everywhere. ``@each(a, b))``
gives a row for each whole number from a to b.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name -> (tables and views it reads, text)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "own_exons": (("part",), """
        SELECT p_partkey @div 8 AS g, p_partkey % 8 AS k, (p_partkey @div 8) @div 5 * 4000 + (p_partkey % 8) * 400 + 1 AS start,
               (p_partkey @div 8) @div 5 * 4000 + (p_partkey % 8) * 400 + 40 + p_size * 8 AS @end,
               CASE WHEN (p_partkey @div 8) % 2 = 0 THEN '+' ELSE '-' END AS strand
        FROM part"""),
    "exons": (("own_exons",), """
        SELECT gene_id, chr, start, @end, strand, k, chr || '_' || start || '_' || @end || '_' || strand AS exon_id FROM (
          SELECT 'G' || g AS gene_id, 'chr' || (g % 5 + 1) AS chr, start, @end, strand, k FROM own_exons
          UNION ALL
          SELECT 'G' || (g + 5) AS gene_id, 'chr' || (g % 5 + 1) AS chr, start, @end, strand, k FROM own_exons WHERE k = 7 AND g % 10 = 4
        ) AS e"""),
    "exon_transcripts": (("exons",), """
        SELECT gene_id, exon_id, gene_id || '.T1' AS transcript_id FROM exons WHERE k IN (0, 2, 4, 6)
        UNION ALL SELECT gene_id, exon_id, gene_id || '.T2' AS transcript_id FROM exons WHERE k <> 3
        UNION ALL SELECT gene_id, exon_id, gene_id || '.T3' AS transcript_id FROM exons WHERE k IN (3, 5, 7)"""),
    "alignments": (("lineitem",), """
        SELECT read_id, read_no, chr, start, start + 49 AS @end, strand, nm, sample, lane FROM (
          SELECT l_orderkey AS read_id, l_linenumber AS read_no, 'chr' || ((l_partkey @div 8) % 5 + 1) AS chr,
                 (l_partkey @div 8) @div 5 * 4000 + (l_partkey % 8) * 400 + 1 + CAST(l_quantity AS INT) * 8 + CASE WHEN l_linenumber = 7 THEN 3600 ELSE 0 END AS start,
                 CASE WHEN l_returnflag = 'A' OR l_returnflag = 'N' AND l_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
                 CAST(round(l_tax * 100) AS INT) % 4 AS nm, 's' || (l_suppkey % 4) AS sample, l_linestatus AS lane
          FROM lineitem) AS a"""),
    "junction_reads": (("lineitem", "own_exons"), """
        SELECT 'G' || a.g AS gene_id, 'chr' || (a.g % 5 + 1) AS chr, a.@end AS j_start, b.start AS j_end,
               's' || (l_suppkey % 4) AS sample, l_linestatus AS lane, CAST(1 AS BIGINT) AS reads
        FROM lineitem JOIN own_exons a ON a.g = l_partkey @div 8 AND a.k = l_partkey % 8
        JOIN own_exons b ON b.g = a.g AND b.k = a.k + 1 + l_linenumber % 3
        WHERE a.@end < b.start"""),
    "transcript_expression": (("lineitem", "exon_transcripts", "exons"), """
        SELECT t.gene_id, t.transcript_id, 's' || (l_suppkey % 4) AS sample, sum(l_quantity) / 10 AS rpkm
        FROM lineitem JOIN exons e ON e.gene_id = 'G' || (l_partkey @div 8) AND e.k = l_partkey % 8
        JOIN exon_transcripts t ON t.gene_id = e.gene_id AND t.exon_id = e.exon_id
        GROUP BY t.gene_id, t.transcript_id, 's' || (l_suppkey % 4)"""),
    "contigs": (("documents",), """
        SELECT doc_id AS contig, source AS lane, letters, marks FROM (
          SELECT doc_id, source, replace(upper(regexp_replace(text, '[^acgtxACGTX]', ''@all)), 'X', 'N') AS letters,
                 regexp_replace(text, '[^!-~]', ''@all) AS marks
          FROM documents) AS d WHERE length(letters) > 0"""),
    "reads": (("contigs",), """
        SELECT contig * 100000 + part AS read_id, contig, part, lane, CASE (contig + part) % 3 WHEN 0 THEN '0:0:0' ELSE '1:0:0' END AS matches,
               substring(letters, CAST(part * 76 + 1 AS INT), 76) AS seq, substring(marks, CAST(part * 76 + 1 AS INT), length(substring(letters, CAST(part * 76 + 1 AS INT), 76))) AS qual
        FROM (SELECT contig, lane, letters, marks, @each(CAST(0 AS BIGINT), CAST((length(letters) - 1) @div 76 AS BIGINT))) AS part FROM contigs) AS c"""),
    "contig_exons": (("contigs",), """
        SELECT contig, k, contig || '.' || (k @div 3) AS transcript_id, contig || '_' || (k * 100 + 1) || '_' || (k * 100 + 60) AS exon_id,
               k * 100 + 1 AS start, k * 100 + 60 AS @end, CASE WHEN contig % 2 = 0 THEN '+' ELSE '-' END AS strand
        FROM (SELECT contig, @each(CAST(0 AS BIGINT), CAST((length(letters) - 60) @div 100 AS BIGINT))) AS k FROM contigs WHERE length(letters) >= 60) AS c"""),
    "sam": (("alignments",), """
        SELECT read_id, read_no, chr, start, @end, strand, nm, sample, lane,
               CASE read_no % 4 WHEN 1 THEN '50M' WHEN 2 THEN '20M' || (200 + read_id % 3 * 30000) || 'N30M'
                 WHEN 3 THEN CASE WHEN read_id % 9 = 0 THEN '*' ELSE '50M' END
                 ELSE CASE read_id % 7 WHEN 0 THEN '5H45M' WHEN 1 THEN '30M-5N20M' ELSE '25M2I23M' END END AS cigar,
               CASE read_id % 4 WHEN 0 THEN '1:0:2' WHEN 1 THEN '0:2:0' END AS strata, CASE read_id % 4 WHEN 2 THEN 1 + read_no % 2 END AS nh_tag,
               CASE read_id % 5 WHEN 0 THEN start ELSE -start END AS tlen
        FROM alignments"""),
    "spliced": (("junction_reads",), """
        SELECT chr, j_start - 19 AS start, CASE WHEN lane = 'O' THEN '20M' || (j_end - j_start - 1) || 'N30M' ELSE '20M' || (j_end - j_start - 1) || 'N15M300N15M' END AS cigar, sample, lane
        FROM junction_reads"""),
    "lane_alignments": (("alignments",), "SELECT read_id, read_no, chr, start, @end, strand, nm, lane AS sample FROM alignments"),
    "lane_junctions": (("junction_reads",), "SELECT gene_id, chr, j_start, j_end, lane AS sample, reads FROM junction_reads"),
    "features": (("exons",), """
        SELECT 'gene' AS type, gene_id, CAST(NULL AS STRING) AS transcript_id, CASE WHEN max(k) % 5 = 0 THEN 'chrUn_' ELSE '' END || min(chr) AS chr, min(start) AS start, max(@end) AS @end, min(strand) AS strand
        FROM exons GROUP BY gene_id
        UNION ALL SELECT 'transcript', gene_id, gene_id || '.T' || (k % 3 + 1), min(chr), min(start), max(@end), min(strand) FROM exons GROUP BY gene_id, k % 3
        UNION ALL SELECT 'exon', gene_id, CAST(NULL AS STRING), chr, start, @end, strand FROM exons"""),
    "gene_info": (("own_exons",), """
        SELECT 'G' || g AS gene_id, CASE WHEN g % 3 = 1 THEN 'pseudogene' WHEN g % 7 = 0 THEN 'rRNA' WHEN g % 11 <> 0 THEN 'protein_coding' END AS gene_type,
               CASE WHEN g % 2 = 0 THEN 'KNOWN' WHEN g % 5 <> 0 THEN 'NOVEL' END AS gene_status, CASE WHEN g % 4 <> 0 THEN 'name' || g END AS gene_name,
               CASE WHEN g % 13 = 0 THEN 'Ribosomal protein' WHEN g % 13 = 1 THEN 'kinase' END AS description, CASE WHEN g % 17 = 0 THEN 'chrM' ELSE 'chr' || (g % 5 + 1) END AS chr
        FROM own_exons GROUP BY g"""),
    "genome_maps": (("maps",), "SELECT pair_id, mate, lane, genome AS strata FROM maps WHERE genome <> '-'"),
    "junction_maps": (("maps",), "SELECT pair_id, mate, lane, junction AS strata FROM maps WHERE junction <> '-'"),
    "split_maps": (("maps",), "SELECT pair_id, mate, lane, split AS strata FROM maps WHERE split <> '0:0:0'"),
    "recursive_maps": (("maps",), "SELECT pair_id, mate, lane, recursive AS strata FROM maps WHERE recursive <> '-'"),
    "split_texts": (("lineitem",), """
        SELECT read_id, '[' || a || '-' || (a + w) || ']=chr' || c1 || ':' || s1 || CASE WHEN m % 3 = 0 THEN '' || x WHEN m % 3 = 1 THEN '[' || x || '-' || (x + w) || ']' ELSE '[' || (x + w) || '-' || x || ']' END
               || '~chr' || c2 || ':' || s2 || CASE WHEN m % 5 = 0 THEN '' || y WHEN m % 5 = 1 THEN '[' || (y + w) || '-' || y || ']' ELSE '[' || y || '-' || (y + w) || ']' END AS hit
        FROM (SELECT l_orderkey * 8 + l_linenumber AS read_id, 20 + l_suppkey % 10 AS a, l_partkey % 4 AS w, l_partkey % 5 + 1 AS c1, l_suppkey % 5 + 1 AS c2, l_partkey AS m,
                     CASE WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'R' END AS s1, CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'R' END AS s2, 1000 + l_partkey * 3 AS x, 5000 + l_suppkey * 7 AS y FROM lineitem) AS l"""),
    "split_hits": (("lineitem",), """
        SELECT l_orderkey * 8 + l_linenumber AS hit_id, l_linestatus AS lane, 'chr' || (l_partkey % 5 + 1) AS chr1, CASE WHEN l_linenumber = 7 THEN 'chr1' ELSE 'chr' || (l_partkey % 5 + 1) END AS chr2,
               CASE WHEN l_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand1, CASE WHEN (l_partkey + l_linenumber @div 6) % 2 = 0 THEN '+' ELSE '-' END AS strand2,
               l_suppkey * 10 + 100 AS start1, l_suppkey * 10 + 130 AS end1, l_suppkey * 10 + 100 + CAST(l_quantity AS INT) * 20 - 400 AS start2, l_suppkey * 10 + 120 + CAST(l_quantity AS INT) * 20 - 400 AS end2
        FROM lineitem"""),
    "maps": (("orders",), """
        SELECT pair_id, mate, lane,
          CASE (pair_id + mate) % 7 WHEN 0 THEN '0:0:0' WHEN 1 THEN '1:0:0' WHEN 2 THEN '0:1:0' WHEN 3 THEN '0:2:1' WHEN 4 THEN '3:0:0' WHEN 5 THEN '-' ELSE '0:!:0' END AS genome,
          CASE (c + mate) % 5 WHEN 0 THEN '0:0:0' WHEN 1 THEN '0:1:0' WHEN 2 THEN '0:0:2' WHEN 3 THEN '1:4:0' ELSE '-' END AS junction,
          CASE (pair_id + c) % 3 WHEN 0 THEN '0:0:1' ELSE '0:0:0' END AS split,
          CASE (pair_id + mate) % 4 WHEN 0 THEN '0:1:1' ELSE '-' END AS recursive
        FROM (SELECT o_orderkey AS pair_id, 1 AS mate, o_orderstatus AS lane, o_custkey AS c FROM orders
              UNION ALL SELECT o_orderkey AS pair_id, 2 AS mate, o_orderstatus AS lane, o_custkey AS c FROM orders) AS o"""),
    "experiments": (("supplier", "nation"), """
        SELECT s_suppkey AS experiment_id, s_suppkey % 3 AS project_id, n_regionkey AS cell_type, s_suppkey % 2 AS rna_type,
               (s_suppkey @div 2) % 2 AS compartment, 1 + (s_suppkey @div 4) % 2 AS bioreplicate
        FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "hit_maps": (("orders",), """
        SELECT pair_id, mate, lane, strata, CASE strata WHEN '1:0:0' THEN h0 || '0' WHEN '0:1:1' THEN h0 || '1,' || h1 || '2' WHEN '0:2:0' THEN h0 || '1,' || h1 || '1'
          WHEN '2:0:1' THEN h0 || '0,' || h1 || '0,' || h2 || '2' WHEN '1:1:1' THEN h0 || '0,' || h1 || '1,' || h2 || '2' ELSE '-' END AS hits,
          CASE WHEN strata IN ('1:0:0', '2:0:1', '1:1:1') THEN '0' WHEN strata IN ('0:1:1', '0:2:0') THEN '1' END AS mismatches
        FROM (SELECT pair_id, mate, lane,
            CASE (pair_id + mate * (c % 4) + c) % 7 WHEN 0 THEN '0:0:0' WHEN 1 THEN '1:0:0' WHEN 2 THEN '0:1:1' WHEN 3 THEN '0:2:0' WHEN 4 THEN '2:0:1' WHEN 5 THEN '1:1:1' ELSE '0:!:0' END AS strata,
            'chr' || (c % 2 + 1) || ':' || CASE WHEN (pair_id + mate) % 2 = 0 THEN 'F' ELSE 'R' END || (c * 7 + mate * 200 + 1) || '@30/' AS h0,
            'chr' || (c % 2 + 1) || ':' || CASE WHEN (pair_id + c) % 2 = 0 THEN 'F' ELSE 'R' END || (c * 7 + mate * 90 + 1) || '@30/' AS h1,
            'chr' || ((c + 1) % 2 + 1) || ':R' || (c * 3 + 5) || '@30/' AS h2
          FROM (SELECT o_orderkey AS pair_id, 1 AS mate, o_orderstatus AS lane, o_custkey AS c FROM orders
                UNION ALL SELECT o_orderkey AS pair_id, 2 AS mate, o_orderstatus AS lane, o_custkey AS c FROM orders) AS o) AS h"""),
    "transcript_maps": (("orders",), """
        SELECT pair_id, mate, 'G' || ((c + mate * (pair_id % 3)) % 20) || '.T' || ((c + mate) % 3 + 1) AS transcript_id,
          CASE (pair_id + c) % 5 WHEN 0 THEN '0:1:1' WHEN 1 THEN '2:0:1' ELSE '1:0:0' END AS strata, CASE (pair_id + c) % 5 WHEN 0 THEN '1' ELSE '0' END AS mismatches
        FROM (SELECT o_orderkey AS pair_id, 1 AS mate, o_custkey AS c FROM orders UNION ALL SELECT o_orderkey AS pair_id, 2 AS mate, o_custkey AS c FROM orders) AS o"""),
    "splits": (("lineitem",), """
        SELECT 's' || (l_suppkey % 4) AS sample, 'chr' || (l_partkey % 5 + 1) AS chr1, 'chr' || ((l_partkey + l_linenumber % 2) % 5 + 1) AS chr2, l_partkey % 40 * 100 AS start, l_partkey % 40 * 100 + l_linenumber * 150 AS @end
        FROM lineitem"""),
    "fragments": (("alignments",), """
        SELECT read_id * 8 + read_no AS read_id, 1 AS fragment, sample, chr, start, @end FROM alignments
        UNION ALL SELECT read_id * 8 + read_no, 2, sample, CASE WHEN read_no = 5 THEN 'chr1' ELSE chr END, start + 400 * (read_no - 1), @end + 400 * (read_no - 1) FROM alignments"""),
    "transcript_reads": (("lineitem",), """
        SELECT l_linestatus AS lane, length, 1 + (l_orderkey * 13 + l_linenumber * 77) % (length - 50) AS start, 50 + (l_orderkey * 13 + l_linenumber * 77) % (length - 50) AS @end
        FROM (SELECT *, 600 + l_partkey % 50 * 200 AS length FROM lineitem) AS l"""),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS, or a given table, as a DataFrame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs, text = VIEWS[name]
    text = text.replace("@div", "div").replace("@end", "`end`").replace("@all", "").replace("@each(", "explode(sequence(")
    for need in needs:
        text = _named(text, need)
    return spark.sql(text, **{f"t_{n}": view(spark, sf_dir, n) for n in needs})


def _named(text: str, table: str) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{t_{table}}}", text)


def with_views(sql: str, *names: str) -> str:
    """DuckDB text: the views named, those that they need, then ``sql``."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in order:
            for need in VIEWS[name][0]:
                add(need)
            order.append(name)

    for n in names:
        add(n)
    text = lambda n: VIEWS[n][1].replace("@div", "//").replace("@end", '"end"').replace("@all", ", 'g'").replace("@each(", "unnest(generate_series(").replace("AS STRING", "AS VARCHAR")
    return "WITH " + ",\n".join(f"{n} AS ({text(n)})" for n in order) + (",\n" if sql.lstrip().startswith(",") else "\n") + sql.lstrip().lstrip(",")
