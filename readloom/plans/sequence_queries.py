"""Queries that assemble sequences from contigs, which are the letters of whole documents in chunks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from readloom.operators import sequences
from readloom.plans.registry import _query

WIDTH = 76
_EXON_SEQS = """, xs AS (SELECT exon_id, transcript_id, contig, k, start, "end", strand, CASE WHEN strand = '-' THEN reverse(translate(substring(letters, start, 60), 'ACGT', 'TGCA')) ELSE substring(letters, start, 60) END AS seq FROM contig_exons JOIN contigs USING (contig))"""


def _sequences(exons, chunks):
    return sequences.exon_sequences(exons, chunks, WIDTH)


@_query("contig_exons", "reads", "contigs", sql=_EXON_SEQS + " SELECT exon_id, seq FROM xs")
def exon_sequences(exons, chunks, _):
    return _sequences(exons, chunks)


@_query("contig_exons", "reads", "contigs", sql=_EXON_SEQS + " SELECT transcript_id, string_agg(seq, '' ORDER BY CASE WHEN strand = '-' THEN -start ELSE start END) AS seq FROM xs GROUP BY transcript_id")
def transcript_sequences(exons, chunks, _):
    return sequences.transcript_sequences(exons, _sequences(exons, chunks))


def _next(exons):
    order = Window.partitionBy("transcript_id").orderBy("k")
    return exons.withColumn("next", F.lead("exon_id").over(order)).withColumn("n_start", F.lead("start").over(order)).where("next is not null")


_NEXT = """, nx AS (SELECT *, lead(exon_id) OVER (PARTITION BY transcript_id ORDER BY k) AS nxt, lead(start) OVER (PARTITION BY transcript_id ORDER BY k) AS n_start FROM contig_exons)"""


@_query("contig_exons", "reads", "contigs", sql=_EXON_SEQS + _NEXT + """, jx AS (SELECT CASE WHEN strand = '-' THEN nxt ELSE exon_id END AS exon1_id, CASE WHEN strand = '-' THEN exon_id ELSE nxt END AS exon2_id FROM nx WHERE nxt IS NOT NULL)
SELECT exon1_id, exon2_id, a.seq || b.seq AS seq FROM jx JOIN xs a ON a.exon_id = exon1_id JOIN xs b ON b.exon_id = exon2_id""")
def junction_sequences(exons, chunks, _):
    minus = F.col("strand") == "-"
    pairs = _next(exons).select(F.when(minus, F.col("next")).otherwise(F.col("exon_id")).alias("exon1_id"), F.when(minus, F.col("exon_id")).otherwise(F.col("next")).alias("exon2_id"))
    return sequences.junction_sequences(pairs, _sequences(exons, chunks))


@_query("contig_exons", "reads", "contigs", sql=_NEXT + """, mo AS (SELECT exon_id, substring(letters, "end" + 1, 2) || substring(letters, n_start - 2, 2) AS motif FROM nx JOIN contigs USING (contig) WHERE nxt IS NOT NULL)
SELECT exon_id, motif, CASE WHEN motif IN ('CTAC', 'CTGC', '.TAT', 'ATAC') THEN '-' ELSE '+' END AS strand FROM mo""")
def intron_strands(exons, chunks, _):
    introns = _next(exons).select("exon_id", "contig", (F.col("end") + 1).alias("start"), (F.col("n_start") - 1).alias("end"))
    return sequences.intron_strands(introns, chunks, WIDTH, ["exon_id"])


@_query("contigs", sql="""
, s AS (SELECT DISTINCT lane, md5(coalesce(letters, '')) AS sum FROM contigs), p AS (SELECT lane, sum[1:3] AS slice, md5(string_agg(sum, '' ORDER BY sum)) AS sum, count(*) AS n FROM s GROUP BY ALL)
SELECT lane, sum(n)::BIGINT AS contents, md5(string_agg(sum, '' ORDER BY slice)) AS checksum FROM p GROUP BY lane""")
def content_checksums(contigs):
    return sequences.checksums(contigs, "lane", "letters")
