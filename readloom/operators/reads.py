"""Sequencing reads: cleaning, trimming, statistics, sequence helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.text import ambiguous


def fixed_length(reads: DataFrame, n: int) -> DataFrame:
    """The first ``n`` bases and qualities of each read."""
    return reads.withColumns({c: F.substring(c, 1, n) for c in ("seq", "qual")})


def without_ambiguous(reads: DataFrame, most: int) -> DataFrame:
    """Reads with up to ``most`` bases N or '.'."""
    return reads.where(ambiguous(F.col("seq")) <= most)


def trimmed(reads: DataFrame, cut: int = 15, least: int = 40) -> DataFrame:
    """Cut ``cut`` bases off the 3' end, then N and '.'; reads of ``least`` bases or less go."""
    seq = F.regexp_replace(F.expr(f"substring(seq, 1, greatest(length(seq) - {int(cut)}, 0))"), "[N.]+$", "")
    out = reads.withColumn("seq", seq).withColumn("qual", F.expr("substring(qual, 1, length(seq))"))
    return out.where(F.length("seq") > least)


def clear_ends(reads: DataFrame, least: int = 40) -> DataFrame:
    """Strip N and '.' from both ends of reads without a hit (``matches``); reads of ``least`` bases or less go, as do those with a hit."""
    reads = reads.where(F.col("matches").rlike("^0(:0)*$"))
    lead = F.length(F.regexp_extract("seq", "^([N.]*)", 1))
    seq = F.regexp_replace("seq", "^[N.]+|[N.]+$", "")
    out = reads.withColumn("_lead", lead).withColumn("_seq", seq)
    return out.select("read_id", "lane", F.col("_seq").alias("seq"), F.expr("substring(qual, _lead + 1, length(_seq))").alias("qual")).where(F.length("seq") > least)


def read_stats(reads: DataFrame) -> DataFrame:
    """Least length, reads, unambiguous, ambiguous and distinct sequences by lane."""
    bad = F.col("seq").rlike("[N.]")
    return reads.groupBy("lane").agg(
        F.min(F.length("seq")).alias("length"), F.count(F.lit(1)).alias("total"), F.sum(F.when(bad, 0).otherwise(1)).alias("good"),
        F.sum(F.when(bad, 1).otherwise(0)).alias("ambiguous"), F.countDistinct("seq").alias("distinct_seqs"),
    )


_COUNTS = ("ambiguous", "a", "c", "g", "t", "quality", "marks", "reads")


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts and the length of each; null is empty, a letter beyond ASCII is '?'."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.replace_substring_regex(pc.fill_null(texts.cast(pa.large_string()), ""), r"[^\x00-\x7F]", "?")
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]], np.diff(at)


def _places_in(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each text of such lengths, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _position_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each batch by lane and position; position 0 has the number of reads."""
    for batch in batches:
        lanes = batch.column("lane").dictionary_encode(null_encoding="encode")
        lane = lanes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        (seq, n), (qual, m) = _bytes_of(batch.column("seq")), _bytes_of(batch.column("qual"))
        wide = int(n.max(initial=0)) + 1
        at = np.repeat(lane * wide + 1, n) + _places_in(n)
        there = _places_in(m) < np.repeat(n, m)  # marks behind the last base do not count
        mark_at = (np.repeat(lane * wide + 1, m) + _places_in(m))[there]
        size = len(lanes.dictionary) * wide
        count = lambda where, weight=None: np.bincount(where, weight, size).astype(np.int64)
        bases = [count(at[np.isin(seq, list(codes))]) for codes in (b"N.", b"A", b"C", b"G", b"T")]
        columns = [*bases, count(mark_at, qual[there]), count(mark_at), count(lane * wide)]
        used = np.flatnonzero(count(at) + columns[-1])
        rows = [lanes.dictionary.take(pa.array(used // wide)), pa.array((used % wide).astype(np.int32)), *[pa.array(c[used]) for c in columns]]
        yield pa.RecordBatch.from_arrays(rows, ["lane", "pos", *_COUNTS])


def per_position(reads: DataFrame, offset: int = 33) -> DataFrame:
    """Bases and mean quality at each position by lane; the mean divides by all reads of the lane.

    A batch of reads is counted as arrays where it is read, so neither a row a
    base is made nor the reads read twice; the shuffle holds a row a position
    and batch. A null sequence has no positions but counts as a read; where no
    read has a quality the mean is null. Letters beyond ASCII count as '?'.
    """
    found = reads.select(F.col("lane"), "seq", "qual").mapInArrow(_position_counts, f"lane {reads.schema['lane'].dataType.simpleString()}, pos int, {', '.join(f'{c} long' for c in _COUNTS)}")
    total = found.groupBy("lane", "pos").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    total = total.withColumn("reads", F.max("reads").over(Window.partitionBy("lane")))  # a row a position
    quality = F.when(F.col("marks") > 0, F.col("quality") - offset * F.col("marks"))
    return total.where("pos > 0").select("lane", "pos", "ambiguous", "a", "c", "g", "t", (quality / F.col("reads")).alias("mean_quality"))


def quality_encoding(reads: DataFrame) -> DataFrame:
    """phred or solexa by lane: the first decisive character in read order decides; without any, solexa."""
    decisive = reads.select("lane", "read_id", F.ascii(F.regexp_extract("qual", r"[^;-_]", 0)).alias("v")).where("v > 0")  # all but 59 to 95
    kind = F.when((F.col("v") < 59) | (F.col("v") > 104), "phred").otherwise("solexa")
    first = decisive.groupBy("lane").agg(F.min_by(kind, "read_id").alias("encoding"))
    return reads.select("lane").distinct().join(first, "lane", "left").na.fill("solexa", ["encoding"])


def mates_of_concatenated(reads: DataFrame, n: int, most: int) -> DataFrame:
    """The first ``n`` bases as mate /1 and the rest as /2; mates with more than ``most`` ambiguous bases go (2 * most for /1)."""
    one = F.struct(F.concat("read_id", F.lit("/1")).alias("id"), F.expr(f"substring(seq, 1, {int(n)})").alias("seq"), F.lit(2 * most).alias("k"))
    two = F.struct(F.concat("read_id", F.lit("/2")).alias("id"), F.expr(f"substring(seq, {int(n) + 1})").alias("seq"), F.lit(most).alias("k"))
    mates = reads.withColumn("read_id", F.col("read_id").cast("string")).select(F.explode(F.array(one, two)).alias("m"), "lane").select("m.*", "lane")
    return mates.where(ambiguous(F.col("seq")) <= F.col("k")).drop("k")
