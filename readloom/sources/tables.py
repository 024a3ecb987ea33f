"""Readers and writers of the text formats of reads, alignments and annotation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_GTF = ("chr", "source", "type", "start", "end", "score", "strand", "frame", "attributes")
_SAM = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")


def gtf_attributes(text: Column) -> Column:
    """key "value"; pairs as a map; values of a repeated key are joined by commas."""
    pairs = F.regexp_extract_all(text, F.lit(r'([^\s;"]+) (?:"[^"]*"|[^";]*)'), F.lit(0))
    key = lambda p: F.regexp_extract(p, r"^(\S+) ", 1)
    value = lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, r"^\S+ ", ""), '"', ""))
    keys = F.array_distinct(F.transform(pairs, key))
    values = F.transform(keys, lambda k: F.array_join(F.transform(F.filter(pairs, lambda p: key(p) == k), value), ","))
    return F.map_from_arrays(keys, values)


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Features with an attribute map; comment and empty lines are skipped, missing fields are null.

    Lines that name two genes or two transcripts are no features and go.
    """
    lines = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)"))
    rows = lines.select(*_columns_of(_GTF, ("start", "end")))
    twice = F.lit(False)
    for k in ("gene_id", "transcript_id"):
        twice = twice | (F.regexp_count(F.coalesce("attributes", F.lit("")), F.lit(rf"(^|[\s;]){k} ")) > 1)
    return rows.where(~twice).withColumn("attributes", gtf_attributes(F.coalesce("attributes", F.lit(""))))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM rows with tags nm, nh, h0, h1, h2; header lines are skipped."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@"))
    rows = lines.select("value", *_columns_of(_SAM, ("flag", "pos", "mapq", "pnext", "tlen")))
    tags = {t.lower(): F.expr(f"try_cast(nullif(regexp_extract(value, '\\\\t{t}:i:(\\\\d+)', 1), '') as int)") for t in ("NM", "NH", "H0", "H1", "H2")}
    return rows.withColumns(tags).drop("value")


def _columns_of(names: tuple[str, ...], ints: tuple[str, ...]) -> list[Column]:
    parts = F.split("value", "\t")
    return [(F.get(parts, F.lit(i)).try_cast("int") if n in ints else F.get(parts, F.lit(i))).alias(n) for i, n in enumerate(names)]


def read_maps(spark: SparkSession, path: str) -> DataFrame:
    """Map records of four or five columns: id, seq, qual (null if absent), matches, hits, type (S: split)."""
    parts = F.split("value", "\t")
    five = F.size(parts) >= 5
    rows = spark.read.text(path).where(F.size(parts) >= 4).select(
        parts[0].alias("id"), parts[1].alias("seq"), F.when(five, parts[2]).alias("qual"),
        F.when(five, F.get(parts, F.lit(3))).otherwise(parts[2]).alias("matches"), F.when(five, F.get(parts, F.lit(4))).otherwise(parts[3]).alias("hits"),
    )
    return rows.withColumn("type", F.when(F.col("hits").contains("="), "S").otherwise("F"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """id, seq and length of each record; sequences may span lines."""
    rows = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    seq = F.regexp_replace(F.regexp_extract("value", r"(?s)^[^\n]*\n(.*)$", 1), r"\s", "")
    return rows.select(F.regexp_extract("value", r"^(\S+)", 1).alias("id"), seq.alias("seq"), F.length(seq).alias("length"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 0) and value of all lines; large files are read by many tasks.

    Lines are numbered within their split as they are read; a table of one row a
    split tells how many lines came before it. Files are read twice, in the same splits.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_m"))
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_lo"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    starts = splits.select("file", "block", "_lo", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return lines.join(starts, ["file", "block"]).select("file", (F.col("_m") - F.col("_lo") + F.col("_start")).alias("line"), "value")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, qual of each record of four lines; records of unequal lengths are dropped."""
    lines = numbered_lines(spark, path).select("file", F.expr("line div 4").alias("record"), (F.col("line") % 4).alias("k"), "value")
    part = lambda k: F.max(F.when(F.col("k") == k, F.col("value")))
    rows = lines.where("k <> 2").groupBy("file", "record").agg(part(0).alias("id"), part(1).alias("seq"), part(3).alias("qual"))
    return rows.where("id like '@%' and length(seq) = length(qual)").select(F.substring("id", 2, 1 << 30).alias("id"), "seq", "qual")


def read_folded_fastq(spark: SparkSession, path: str) -> DataFrame:
    """As read_fastq() for files whose sequences span lines.

    A quality line may begin with @, so records are framed by length: a record's
    qualities end once they are as many as its bases. Nothing but the file's
    start tells where a record begins, so a file is one task's work and has to
    fit in its memory (2 GB at most); write such files in parts.
    """

    def frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                rows, lines = [], iter(content.decode().splitlines())
                for line in lines:
                    if not line.startswith("@"):
                        continue
                    name, seq, qual = line[1:], "", ""
                    for line in lines:
                        if line.startswith("+"):
                            break
                        seq += line.strip()
                    while len(qual) < len(seq):
                        more = next(lines, None)
                        if more is None:
                            break
                        qual += more.strip()
                    if len(qual) == len(seq):
                        rows.append((name, seq, qual))
                    if len(rows) >= 10_000:
                        yield pd.DataFrame(rows, columns=["id", "seq", "qual"])
                        rows = []
                yield pd.DataFrame(rows, columns=["id", "seq", "qual"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(frame, "id string, seq string, qual string")


def read_raw_reads(spark: SparkSession, path: str, species: str, qualities: bool, most: int | None = None) -> DataFrame:
    """Reads of a sequencer's own tables: id, seq ('.' written as N) and qual.

    Without qualities the first four fields name a read and the fifth is its
    sequence; with them fields 3 to 6 and the mate (8) do, and fields 9 and 10
    are sequence and qualities. Reads with more than ``most`` dots (twice as
    many with qualities) go; so do lines with too few fields.
    """
    parts = F.split("value", "\t")
    field = lambda k: F.get(parts, F.lit(k))
    names = [field(k) for k in (range(2, 6) if qualities else range(4))]
    name = F.concat_ws("_", F.lit(species), *names)
    name, seq, qual = (F.concat(name, F.lit("/"), field(7)), field(8), field(9)) if qualities else (name, field(4), F.lit(None).cast("string"))
    rows = spark.read.text(path).select(name.alias("id"), seq.alias("seq"), qual.alias("qual")).where("seq is not null")
    dots = F.length("seq") - F.length(F.replace("seq", F.lit("."), F.lit("")))
    rows = rows if most is None else rows.where(dots <= most * (2 if qualities else 1))
    return rows.withColumn("seq", F.translate("seq", ".", "N"))


def read_lanes(spark: SparkSession, path: str) -> DataFrame:
    """The list of files: file, pair, lane, lane_id (the pair's letters, digits and _) and group (All if it is not named)."""
    parts = F.split("value", "\t")
    field = lambda k: F.get(parts, F.lit(k))
    rows = spark.read.text(path).where("trim(value) <> ''").select(field(0).alias("file"), field(1).alias("pair"), field(2).alias("lane"), field(3).alias("group"))
    return rows.withColumns({"lane_id": F.regexp_replace("pair", r"[^\d\w]", ""), "group": F.coalesce(F.nullif("group", F.lit("")), F.lit("All"))})


def load_table(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append rows to a database table, one connection a partition."""
    df.write.jdbc(url, table, mode="append", properties=properties)


def write_tsv(df: DataFrame, path: str) -> None:
    r"""Tab-separated rows with \N for null."""
    df.write.csv(path, sep="\t", nullValue="\\N", emptyValue="", quote="", escape="")


def gtf_line(source: str) -> Column:
    """A GTF line of columns chr, type, start, end, strand and attributes (a map)."""
    attributes = F.array_join(F.transform(F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit(' "'), e["value"], F.lit('";'))), " ")
    return F.concat_ws("\t", "chr", F.lit(source), "type", "start", "end", F.lit("."), "strand", F.lit("."), attributes)


def bed12_line(blocks: Column, name: Column, strand: Column, chrom: Column) -> Column:
    """A BED12 line of 1-based closed blocks (an array of start, end in order): starts count from 0."""
    first, last = blocks[0]["start"] - 1, F.element_at(blocks, -1)["end"]
    sizes = F.array_join(F.transform(blocks, lambda b: (b["end"] - b["start"] + 1).cast("string")), ",")
    starts = F.array_join(F.transform(blocks, lambda b: (b["start"] - 1 - first).cast("string")), ",")
    return F.concat_ws("\t", chrom, first, last, name, F.lit("0"), strand, first, last, F.lit("0"), F.size(blocks), sizes, starts)
