"""Alignments as they come from a mapper: filters, uniqueness, routes, junctions of their gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.text import gaps, read_length, rounded
from readloom.operators.intervals import contained_in


def valid(alignments: DataFrame, max_intron: int = 50_000) -> DataFrame:
    """Alignments without a negative insert, without hard clips, and without a single gap beyond ``max_intron``."""
    cigar = F.coalesce("cigar", F.lit(""))
    gap = F.regexp_extract(cigar, r"^\d+M(\d+)N\d+M$", 1)
    return alignments.where(~cigar.rlike("[-H]") & ((gap == "") | (F.nullif(gap, F.lit("")).cast("long") <= max_intron)))


def flagged(alignments: DataFrame) -> DataFrame:
    """Add spliced (a gap N) and unique; alignments with ``*`` for a cigar go.

    unique by the strata where their text begins as a unique one does, else by
    one hit in the NH tag; alignments with either tag are multiple otherwise,
    those with none are unique if no other row has their read_id and read_no.
    """
    rows = alignments.where(~F.coalesce("cigar", F.lit("*")).contains("*"))
    alone = F.count(F.lit(1)).over(Window.partitionBy("read_id", "read_no")) == 1
    by_tags = F.when(F.coalesce(F.col("strata").rlike("^(0:)*1(:.)*"), F.lit(False)) | (F.col("nh_tag") == 1), True).when(F.col("strata").isNotNull() | (F.col("nh_tag") > 1), False)
    return rows.withColumn("spliced", F.col("cigar").contains("N")).withColumn("unique", F.coalesce(by_tags, alone))


def routed(flags: DataFrame) -> DataFrame:
    """Add ``route``: unique or multi, genome or junction."""
    return flags.withColumn("route", F.concat_ws("_", F.when(F.col("unique"), "unique").otherwise("multi"), F.when(F.col("spliced"), "junction").otherwise("genome")))


def write_routes(rows: DataFrame, path: str) -> None:
    """One folder a route."""
    rows.write.partitionBy("route").parquet(path)


def countable(alignments: DataFrame) -> DataFrame:
    """Alignments that count for exons: up to two mismatches, one hit a stratum, a cigar without a gap or insertion."""
    hits = F.transform(F.split(F.coalesce("strata", F.lit("0")), ":"), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    few = F.coalesce(F.array_max(F.slice(hits, 1, 3)) <= 1, F.lit(True))
    return alignments.where((F.coalesce("nm", F.lit(0)) <= 2) & few & (F.col("cigar") != "*") & ~F.col("cigar").rlike(r"\d+M\d+[NI]\d+M"))


def feature_coverage(alignments: DataFrame, features: DataFrame, feature: str, kind: str) -> DataFrame:
    """Reads wholly inside each feature by sample, with its length, type and reads a base (two decimals)."""
    places = alignments.groupBy("sample", "chr", "start", "end").agg(F.count(F.lit(1)).alias("n"))
    rows = contained_in(places, features).groupBy(feature, "f_start", "f_end", "sample").agg(F.sum("n").alias("reads"))
    length = F.expr("f_end - f_start + 1")
    return rows.select(feature, "sample", "reads", length.alias("length"), F.lit(kind).alias("type"), rounded(F.col("reads") / length, 2).alias("coverage"))


def junction_reads(alignments: DataFrame, least: int, keys: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Reads of ``least`` bases or more over each junction, by ``keys``."""
    rows = alignments.where(read_length(F.col("cigar")) >= least).select("chr", *keys, F.explode(gaps(F.col("start"), F.col("cigar"))).alias("g"))
    return rows.groupBy("chr", F.col("g.j_start").alias("j_start"), F.col("g.j_end").alias("j_end"), *keys).agg(F.count(F.lit(1)).alias("reads"))


def with_genes(junctions: DataFrame, catalogue: DataFrame, strand: bool = False) -> DataFrame:
    """Junctions with the genes that have them; a junction of several genes gives a row for each, one of none goes."""
    key = ["chr", "j_start", "j_end", *(["strand"] if strand else [])]
    genes = catalogue.select("gene_id", "chr", "strand", F.col("start").alias("j_start"), F.col("end").alias("j_end")).select("gene_id", *key).distinct()
    return junctions.join(genes, key)


def split_type(splits: DataFrame) -> DataFrame:
    """Split hits by lane and how their two parts lie."""
    over, beyond = F.col("end1") > F.col("start2"), F.col("start1") > F.col("end2")
    minus_over, minus_beyond = F.col("start1") < F.col("end2"), F.col("end1") < F.col("start2")
    ordered = F.when(F.col("strand1") == "+", F.when(beyond, "Rev").when(over, "Over").otherwise("OK")).otherwise(F.when(minus_beyond, "Rev").when(minus_over, "Over").otherwise("OK"))
    kind = F.when(F.col("chr1") != F.col("chr2"), "DifChrom").when(F.col("strand1") != F.col("strand2"), "SameChrDifStrand").otherwise(F.concat(F.lit("SameChr&Strand"), ordered))
    return splits.groupBy("lane", kind.alias("type")).agg(F.count(F.lit(1)).alias("hits"))


def spliced_place(start: Column, end: Column, start1: Column, end1: Column, start2: Column, end2: Column, strand: Column) -> Column:
    """Where a hit (start, end) on a junction sequence lies in the genome, as (start1, end1, start2, end2, offset).

    The sequence is exon 1 and then exon 2 on the plus strand ('+') and reads
    backwards on the minus strand, where the hit is mirrored first. A hit within
    one exon has one range and nulls; offset is the length of the first range.
    """
    half = end1 - start1 + 1
    total = half + end2 - start2 + 1
    a = F.when(strand == "+", start).otherwise(total - end + 1)
    b = F.when(strand == "+", end).otherwise(total - start + 1)
    none = F.lit(None).cast("long")
    place = lambda p, q, r, s, o: F.struct(p.cast("long").alias("start1"), q.cast("long").alias("end1"), r.cast("long").alias("start2"), s.cast("long").alias("end2"), o.cast("long").alias("offset"))
    return (
        F.when(b <= half, place(start1 + a - 1, start1 + b - 1, none, none, none))
        .when(a > half, place(start2 + a - half - 1, start2 + b - half - 1, none, none, none))
        .otherwise(place(start1 + a - 1, end1, start2, start2 + b - half - 1, half - a + 1))
    )


def junction_strand(junction: Column, hit: Column) -> Column:
    """The genome strand (F or R) of a hit on a junction sequence: the hit's own, turned on the minus strand."""
    return F.when(junction == hit, "F").otherwise("R")


def collapsed_hits(hits: DataFrame, mismatches: int) -> DataFrame:
    """One record a read: its distinct hits and strata, all split or all full.

    ``hits`` has read_id, hit, split (boolean) and mm. A hit found through several
    junctions counts once, with its fewest mismatches. The kind of the read's
    best hit is kept, full at equal mismatches.
    """
    one = hits.groupBy("read_id", "hit").agg(F.min("mm").alias("mm"), F.first("split").alias("split"))
    read = one.groupBy("read_id").agg(F.min(F.struct("mm", "split"))["split"].alias("_s"), F.array_sort(F.collect_list(F.struct("mm", "hit", "split"))).alias("all"))
    kept = read.withColumn("own", F.filter("all", lambda h: h["split"] == F.col("_s")))
    count = lambda k: F.size(F.filter("own", lambda h: h["mm"] == k)).cast("string")
    strata = F.concat_ws(":", *[count(k) for k in range(mismatches + 1)])
    return kept.select("read_id", strata.alias("strata"), F.array_join(F.transform("own", lambda h: h["hit"]), ",").alias("hits"))


def bed_blocks(splits: DataFrame) -> DataFrame:
    """Split hits as BED12 lines of two blocks; those over two chromosomes or strands, or with the second block first, go."""
    from readloom.sources.tables import bed12_line

    same = splits.where("chr1 = chr2 and strand1 = strand2 and end1 < start2")
    block = lambda k: F.struct(F.col(f"start{k}").alias("start"), F.col(f"end{k}").alias("end"))
    return same.select(bed12_line(F.array(block(1), block(2)), F.col("hit_id").cast("string"), F.col("strand1"), F.col("chr1")).alias("value"))


def split_ranges(hits: DataFrame, length: int) -> DataFrame:
    """The two ranges of each split hit of reads of ``length`` bases: (read_id, chr, strand, start, end) for sides 1 and 2.

    ``hit`` is a text ``[p-q]=chr:S[a-b]~chr:S[c-d]``: the read is split behind one
    of its bases p to q, and for each the side's start is given, in the same
    order or backwards. On a plus side 1 and a minus side 2 starts ascend and
    one may stand for all. A range is the envelope of all splits; hits whose
    starts and splits are not as many, and texts of another form, give no rows.
    """
    numbers = r"\[?(\d+)(?:[-;](\d+))?\]?"
    form = rf"^{numbers}=([^:~]+):([FR]){numbers}~([^:~]+):([FR]){numbers}$"
    part = lambda k: F.nullif(F.regexp_extract("hit", form, k), F.lit(""))
    number = lambda k: part(k).cast("long")
    p, q = number(1), F.coalesce(number(2), number(1))
    lo, hi = F.least(p, q), F.greatest(p, q)

    def side(k: int, at: int) -> Column:
        strand, a = part(at + 1), number(at + 2)
        b = F.coalesce(number(at + 3), a)
        many = strand == ("R" if k == 1 else "F")
        fits = F.when(many, F.abs(b - a) == hi - lo).otherwise((a <= b) & ((b - a == hi - lo) | (a == b)))
        if k == 1:
            end = F.greatest(a, b) + F.when(a > b, lo).otherwise(hi) - 1
        else:
            end = a + length - lo - 1  # the first start has the longest rest
        return F.struct(fits.alias("fits"), part(at).alias("chr"), F.when(strand == "F", "+").otherwise("-").alias("strand"), F.least(a, b).alias("start"), end.alias("end"))

    rows = hits.where(F.col("hit").rlike(form)).select("read_id", side(1, 3).alias("one"), side(2, 7).alias("two")).where("one.fits and two.fits")
    return rows.select("read_id", *[F.col(f"{s}.{c}").alias(f"{c}{k}") for k, s in ((1, "one"), (2, "two")) for c in ("chr", "strand", "start", "end")])
