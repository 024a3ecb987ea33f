"""Sequences of exons, junctions and transcripts, cut from a table of chunks of equal width.

``chunks`` has contig, part (from 0) and seq, of ``width`` bases but for the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.text import reverse_complement

#: The two bases at either end of an intron and the strand that they tell; others count as plus.
MOTIFS = {"GTAG": "+", "CTAC": "-", "GCAG": "+", "CTGC": "-", "ATA.": "+", ".TAT": "-", "GTAT": "+", "ATAC": "-"}


def cut_out(ranges: DataFrame, chunks: DataFrame, width: int, keys: list[str]) -> DataFrame:
    """``keys`` and the sequence ``seq`` of each range (contig, start, end, counted from 1).

    A range is looked up in the chunks that it touches, so chromosomes stay
    spread over tasks; ranges beyond the contig's end are cut there.
    """
    parts = F.sequence(F.floor((F.col("start") - 1) / width), F.floor((F.col("end") - 1) / width))
    rows = ranges.withColumn("part", F.explode(parts)).join(chunks.select("contig", "part", F.col("seq").alias("_chunk")), ["contig", "part"])
    low = F.greatest(F.col("start") - F.col("part") * width, F.lit(1)).cast("int")
    high = F.least(F.col("end") - F.col("part") * width, F.lit(width)).cast("int")
    pieces = rows.withColumn("_piece", F.substring("_chunk", low, high - low + 1))
    listed = F.array_sort(F.collect_list(F.struct("part", "_piece")))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["_piece"]), "").alias("seq"))


def stranded(seq: Column, strand: Column) -> Column:
    return F.when(strand == "-", reverse_complement(seq)).otherwise(seq)


def exon_sequences(exons: DataFrame, chunks: DataFrame, width: int) -> DataFrame:
    """exon_id and its sequence, read on its own strand."""
    out = cut_out(exons.select("exon_id", "strand", "contig", "start", "end").distinct(), chunks, width, ["exon_id", "strand"])
    return out.select("exon_id", stranded(F.col("seq"), F.col("strand")).alias("seq"))


def transcript_sequences(exons: DataFrame, sequences: DataFrame) -> DataFrame:
    """The sequences of each transcript's exons in order, backwards on the minus strand."""
    rows = exons.select("transcript_id", "exon_id", "strand", "start").join(sequences, "exon_id")
    place = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    listed = F.array_sort(F.collect_list(F.struct(place.alias("at"), "seq")))
    return rows.groupBy("transcript_id").agg(F.array_join(F.transform(listed, lambda x: x["seq"]), "").alias("seq"))


def junction_sequences(junctions: DataFrame, sequences: DataFrame) -> DataFrame:
    """exon1_id, exon2_id and their sequences one after the other, as a transcript has them."""
    side = lambda k: sequences.select(F.col("exon_id").alias(f"exon{k}_id"), F.col("seq").alias(f"_s{k}"))
    both = junctions.join(side(1), "exon1_id").join(side(2), "exon2_id")
    return both.select("exon1_id", "exon2_id", F.concat("_s1", "_s2").alias("seq"))


def intron_strands(introns: DataFrame, chunks: DataFrame, width: int, keys: list[str]) -> DataFrame:
    """``keys``, the first two and last two bases of each intron (contig, start, end) as motif, and the strand they tell."""
    ends = introns.withColumn("_e", F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("start").alias("s")), F.struct(F.lit(2).alias("side"), (F.col("end") - 1).alias("s")))))
    places = ends.select(*keys, "contig", F.col("_e.side").alias("side"), F.col("_e.s").alias("start"), (F.col("_e.s") + 1).alias("end"))
    found = cut_out(places, chunks, width, [*keys, "side"])
    motif = F.concat(F.max(F.when(F.col("side") == 1, F.col("seq"))), F.max(F.when(F.col("side") == 2, F.col("seq"))))
    table = F.create_map(*[F.lit(x) for pair in MOTIFS.items() for x in pair])
    return found.groupBy(*keys).agg(motif.alias("motif")).withColumn("strand", F.coalesce(F.element_at(table, F.col("motif")), F.lit("+")))


def checksums(texts: DataFrame, group: str, text: str) -> DataFrame:
    """md5 of each group's contents: rows have theirs, and a group that of its sorted distinct ones.

    A group's sums are first taken together by their first three digits, each
    slice in order, and then the slices' sums, so no row holds all of a group.
    """
    sums = texts.select(F.col(group), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("sum")).distinct()
    slices = sums.groupBy(group, F.substring("sum", 1, 3).alias("slice")).agg(F.md5(F.array_join(F.array_sort(F.collect_list("sum")), "")).alias("sum"), F.count(F.lit(1)).alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("slice", "sum")))
    return slices.groupBy(group).agg(F.sum("n").alias("contents"), F.md5(F.array_join(F.transform(listed, lambda x: x["sum"]), "")).alias("checksum"))
