"""Boundary cases on small tables."""

import pytest
from pyspark.sql import functions as F

from readloom.functions import text
from readloom.operators import expression, hits, intervals, reads, splicing
from readloom.sources import tables


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_interval_joins_equal_the_theta_join(spark, width):
    r = [(i, "chr1", 3 * i % 50 + 1, 3 * i % 50 + 1 + i % 9) for i in range(40)]
    f = [(i, "chr1", 5 * i % 60 + 1, 5 * i % 60 + 1 + i % 20) for i in range(30)]
    a = spark.createDataFrame(r, "r int, chr string, start int, end int")
    b = spark.createDataFrame(f, "f int, chr string, f_start int, f_end int")
    inside = sorted((x[0], y[0]) for x in r for y in f if x[2] >= y[2] and x[3] <= y[3])
    touch = sorted((x[0], y[0]) for x in r for y in f if x[2] <= y[3] and x[3] >= y[2])
    assert sorted(map(tuple, intervals.contained_in(a, b, width).select("r", "f").collect())) == inside
    assert sorted(map(tuple, intervals.overlapping(a, b, width).select("r", "f").collect())) == touch


def test_long_features_are_listed_twice_at_most(spark):
    f = spark.createDataFrame([(1, "c", 1, 1_000_000_000), (2, "c", 999, 1001), (3, "c", 1, 1000), (4, "c", 16_000, 32_500), (5, "c", None, 9)], "f int, chr string, f_start int, f_end int")
    r = spark.createDataFrame([(1, "c", 1000, 1001), (2, "c", 20_000, 20_049), (3, "c", 999_999_999, 1_000_000_001), (4, "c", None, None)], "r int, chr string, start int, end int")
    left, right = intervals._leveled(r, f, 1000)
    assert max(x["count"] for x in intervals._touched(right, "f_start", "f_end").groupBy("f").count().collect()) <= 2
    assert left.groupBy("r").count().where("count > 3").count() == 0
    assert sorted(map(tuple, intervals.contained_in(r, f).select("r", "f").collect())) == [(1, 1), (1, 2), (2, 1), (2, 4)]
    assert sorted(map(tuple, intervals.overlapping(r, f).select("r", "f").collect())) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 4), (3, 1)]
    assert intervals.contained_in(r, f.limit(0)).count() == 0


def test_unique_alignments_of_null_and_hot_reads(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 1, "c"), (None, 1, "d"), (None, 2, "e"), (None, 2, "f")] + [(9, None, "h")] * 50
    df = spark.createDataFrame(rows, "read_id long, read_no int, chr string")
    assert sorted(r.chr for r in expression.unique_alignments(df).collect()) == ["a", "b", "d"]


def test_skips_of_a_long_gene(spark):
    e = [("g", f"e{k}", "c", 10 * k + 1, 10 * k + 5, "+") for k in range(60)] + [("g", "wide", "c", 1, 300, "+"), ("g", "other", "c", 100, 105, "-"), ("g", "e3", "c", 31, 35, "+")]
    df = spark.createDataFrame(e, "gene_id string, exon_id string, chr string, start int, end int, strand string")
    want = {(x[1], a[4], b[3]) for x in e for a in e for b in e if x[5] == a[5] == b[5] and a[4] < x[3] and b[3] > x[4]}
    got = [tuple(r) for r in splicing.exclusion_junctions(df).select("exon_id", "j_start", "j_end").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    seen = spark.createDataFrame([("c", 5, 21), ("c", 5, 21), ("c", 15, 591), ("c", 16, 591), ("d", 5, 21)], "chr string, j_start int, j_end int")
    few = [tuple(r) for r in splicing.skipping_junctions(df, seen).select("exon_id", "j_start", "j_end").collect()]
    assert sorted(few) == sorted(x for x in want if x[1:] in {(5, 21), (15, 591)})


def test_counts_by_position_of_odd_reads(spark):
    rows = [("x", "ACN", "I!~"), ("x", "A.", "II"), ("x", None, None), ("x", "", ""), (None, "G", "II"), ("y", "té", None), ("z", None, "I")]
    df = spark.createDataFrame(rows, "lane string, seq string, qual string").coalesce(1)
    got = {(r.lane, r.pos): (r.ambiguous, r.a, r.c, r.g, r.t, r.mean_quality) for r in reads.per_position(df).collect()}
    assert got == {
        ("x", 1): (0, 2, 0, 0, 0, 20.0), ("x", 2): (1, 0, 1, 0, 0, 10.0), ("x", 3): (1, 0, 0, 0, 0, 93 / 4), (None, 1): (0, 0, 0, 1, 0, 40.0),
        ("y", 1): (0, 0, 0, 0, 0, None), ("y", 2): (0, 0, 0, 0, 0, None),
    }
    assert reads.per_position(df.limit(0)).count() == 0


def test_touching_ranges_stay_apart_and_merging_is_idempotent(spark):
    df = spark.createDataFrame([("g", "c", 1, 10, "+"), ("g", "c", 11, 20, "+"), ("g", "c", 20, 25, "-"), ("g", "c", 3, 5, "+")], "gene_id string, chr string, start int, end int, strand string")
    once = intervals.gene_projections(df)
    assert sorted((r.start, r.end, r.strand) for r in once.collect()) == [(1, 10, "+"), (11, 25, ".")]
    twice = intervals.gene_projections(once.select("gene_id", "chr", "start", "end", "strand"))
    assert sorted((r.start, r.end) for r in twice.collect()) == [(1, 10), (11, 25)]


def test_strata(spark):
    rows = [("0:0", "unmapped"), ("-", "unmapped"), ("0:!", "unmapped"), ("1:0", "unique"), ("0:1:4", "unique"), ("0:12", "multi"), ("2", "multi"), (None, "unmapped")]
    df = spark.createDataFrame(rows, "s string, want string").withColumn("got", text.map_class(F.col("s")))
    assert all(r.want == r.got for r in df.collect())


def test_ids_and_ends(spark):
    df = spark.createDataFrame([("a|p1", 0), ("b 2:N:0", 0)], "i string, z int")
    assert [r[0] for r in df.select(text.clean_id(F.col("i"))).collect()] == ["a/1", "b_X:N:0/2"]


def test_text_formats(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('#c\nchr1\tx\texon\t1\t9\t.\t+\t.\tgene_id "g1"; tag "a"; tag "b";\n')
    r = tables.read_gtf(spark, str(tmp_path / "a.gtf")).first()
    assert (r.start, r.end, r.attributes) == (1, 9, {"gene_id": "g1", "tag": "a,b"})
    (tmp_path / "a.fa").write_text(">s1 x\nAC\nGT\n>s2\nA\n")
    assert sorted((r.id, r.seq, r.length) for r in tables.read_fasta(spark, str(tmp_path / "a.fa")).collect()) == [("s1", "ACGT", 4), ("s2", "A", 1)]
    (tmp_path / "a.fq").write_text("@r1\nAC\nG\n+\n@II\n@r2\nA\n+\n@\n")
    assert sorted(map(tuple, tables.read_folded_fastq(spark, str(tmp_path / "a.fq")).collect())) == [("r1", "ACG", "@II"), ("r2", "A", "@")]
    (tmp_path / "a.map").write_text("r\tAC\t0:1\tchr1:F5\nq\tAC\tII\t1\tchr1=x\n")
    assert sorted((r.id, r.qual, r.matches, r.type) for r in tables.read_maps(spark, str(tmp_path / "a.map")).collect()) == [("q", "II", "1", "S"), ("r", None, "0:1", "F")]
    (tmp_path / "a.sam").write_text("@HD\nq\t0\tchr1\t5\t9\t3M\t*\t0\t0\tACG\tIII\tNM:i:2\tNH:i:1\n")
    r = tables.read_sam(spark, str(tmp_path / "a.sam")).first()
    assert (r.pos, r.cigar, r.nm, r.nh, r.h0) == (5, "3M", 2, 1, None)


def test_best_hits_by_strata(spark):
    rows = [("0:1:2", "a:F1,b:F2,c:F3"), ("0:!:1", "-"), ("1:!", "a:F1,b:R2@30/1"), ("-", "-"), (None, None), ("0:3", "a:F1,b:F2,c:F3"), ("0:0:0:9", "a:F1"), ("2", "x")]
    df = spark.createDataFrame([(i, s, h) for i, (s, h) in enumerate(rows)], "i int, strata string, hits string")
    got = lambda **k: [len(r.kept) for r in hits.best_hits(df, **k).orderBy("i").collect()]
    assert got() == [1, 0, 1, 0, 0, 3, 0, 1]
    assert got(closest=1) == [3, 0, 1, 0, 0, 3, 0, 1]
    assert got(unique_strict=True) == [1, 0, 1, 0, 0, 0, 0, 0]


def test_tags_strands_and_mates(spark):
    df = spark.createDataFrame([("q\tNH:i:2",), ("q",)], "l string")
    assert [r[0] for r in df.select(hits.with_tag(F.col("l"), "NH:i:", F.lit(7))).collect()] == ["q\tNH:i:2", "q\tNH:i:7"]
    h = spark.createDataFrame([(1, "+"), (2, "+"), (1, "-")], "mate int, strand string")
    assert [r.strand for r in hits.stranded(h).collect()] == ["-", "+", "+"]
    a = [("x", 1, 5, 9, 4), ("x", 2, 9, 5, -4), ("y", 1, 5, 9, 4), ("y", 2, 8, 5, -4), ("z", 1, None, 9, 4), ("z", 2, 9, 5, 4)]
    pairs = hits.consistent_mates(spark.createDataFrame(a, "id string, mate int, pos int, mate_pos int, tlen int"))
    assert dict(map(tuple, pairs.collect())) == {"x": True, "y": False, "z": False}


def test_hits_with_mismatches_written_out(spark):
    listed = ["chr1:F120@30/1", "chr1:F120C15@30/1", "chr1:R55A3T20", "chr2 x:F9<+2>20G7", "chr1:F5", "chr1=x"]
    df = spark.createDataFrame([(1, 1, "l", listed)], "pair_id int, mate int, lane string, kept array<string>")
    got = [(r.ordinal, r.chr, r.strand, r.start, r.end, r.mismatches) for r in hits.hit_coordinates(df, 50).orderBy("ordinal").collect()]
    assert got == [(0, "chr1", "+", 120, 169, 1), (1, "chr1", "+", 120, 169, 1), (2, "chr1", "-", 55, 104, 2), (3, "chr2", "+", 9, 58, 2), (4, "chr1", "+", 5, 54, 0)]


def test_gtf_of_odd_lines(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('chr1\tx\texon\nchr1\tx\texon\tone\t9\t.\t+\t.\tgene_id "g;1"; level 2\nchr1\tx\texon\t1\t9\t.\t+\t.\tgene_id "a"; gene_id "b";\n\n')
    rows = sorted(map(tuple, tables.read_gtf(spark, str(tmp_path / "a.gtf")).select("chr", "start", "end", "attributes").collect()), key=str)
    assert rows == [("chr1", None, 9, {"gene_id": "g;1", "level": "2"}), ("chr1", None, None, {})]


def test_fastq_in_many_splits(spark, tmp_path):
    want = [(f"r{i} x", "ACGT"[: i % 4 + 1] * 3, "@+I#"[: i % 4 + 1] * 3) for i in range(5000)]
    for part in (0, 1):
        (tmp_path / f"{part}.fq").write_text("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in want[part::2]) + "@bad\nAC\n+\nI\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = tables.read_fastq(spark, str(tmp_path))
        assert got.sparkSession.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert sorted(map(tuple, got.collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_raw_reads_and_lanes(spark, tmp_path):
    (tmp_path / "a_seq").write_text("1\t2\t3\t4\tAC.T\n1\t2\t3\t5\tA..T\nx\n")
    assert [tuple(r) for r in tables.read_raw_reads(spark, str(tmp_path / "a_seq"), "sp", False, 1).collect()] == [("sp_1_2_3_4", "ACNT", None)]
    (tmp_path / "a_qseq").write_text("m\t0\t1\t2\t3\t4\ti\t2\tA..T\tIIII\t1\n")
    assert [tuple(r) for r in tables.read_raw_reads(spark, str(tmp_path / "a_qseq"), "sp", True, 1).collect()] == [("sp_1_2_3_4/2", "ANNT", "IIII")]
    (tmp_path / "lanes").write_text("f1\tp-1\tl1\tg\nf2\tp2\tl2\n")
    assert sorted(map(tuple, tables.read_lanes(spark, str(tmp_path / "lanes")).select("lane", "lane_id", "group").collect())) == [("l1", "p1", "g"), ("l2", "p2", "All")]


def test_writers(spark, tmp_path):
    tables.write_tsv(spark.createDataFrame([("a", None, 1), ("", "b c", 2)], "x string, y string, n int"), str(tmp_path / "t"))
    lines = sorted(line for p in (tmp_path / "t").glob("part*") for line in p.read_text().splitlines())
    assert lines == ["\tb c\t2", "a\t\\N\t1"]
    f = spark.createDataFrame([("chr1", "exon", 1, 9, "+", {"gene_id": "g"})], "chr string, type string, start int, end int, strand string, attributes map<string,string>")
    assert f.select(tables.gtf_line("src")).first()[0] == 'chr1\tsrc\texon\t1\t9\t.\t+\t.\tgene_id "g";'
    one = F.array(F.struct(F.lit(5).alias("start"), F.lit(9).alias("end")))
    assert f.select(tables.bed12_line(one, F.lit("n"), F.col("strand"), F.col("chr"))).first()[0] == "chr1\t4\t9\tn\t0\t+\t4\t9\t0\t1\t5\t0"


@pytest.mark.parametrize("width", [3, 10, 1000])
def test_merging_in_bins_equals_one_window(spark, width):
    import random

    rng = random.Random(width)
    rows = [("a" if i % 3 else "b", s, s + rng.choice([0, 2, 5, 40])) for i in range(120) for s in [rng.randrange(600)]]
    df = spark.createDataFrame(rows, "chr string, start int, end int")
    got = intervals.merged(df, ["chr"], [F.count(F.lit(1)).alias("n")], width).collect()
    one = intervals.merged_groups(df, ["chr"], [F.count(F.lit(1)).alias("n")]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, one))


def test_strict_calls_rescue_no_mate(spark):
    h = spark.createDataFrame([(1, 1, 0, "c", "+", 5, 9), (1, 2, 0, "c", "-", 50, 59), (1, 2, 1, "c", "-", 20, 29)], "pair_id int, mate int, ordinal int, chr string, strand string, start long, end long")
    assert [(r.mate, r.ordinal) for r in hits.rescued_mates(h).collect()] == [(2, 1)]
    assert hits.rescued_mates(h, unique_strict=True).count() == 0


def test_gaps_of_a_cigar(spark):
    df = spark.createDataFrame([(100, "10M5N10M2I3D20N5M"), (1, "5S20M"), (1, "*")], "start long, cigar string")
    got = [[tuple(g) for g in r.g] for r in df.select(text.gaps(F.col("start"), F.col("cigar")).alias("g")).collect()]
    assert got == [[(109, 115), (127, 148)], [], []]
    assert [r[0] for r in df.select(text.read_length(F.col("cigar"))).collect()] == [27, 25, 0]


def test_coverage_of_inclusion(spark):
    from readloom.operators import splicing

    exon = spark.createDataFrame([("e", "s", 5, 500)], "exon_id string, sample string, reads long, length int")
    junctions = spark.createDataFrame([("c", 10, 20, "s", 4), ("c", 1, 99, "s", 2)], "chr string, j_start int, j_end int, sample string, reads long")
    included = spark.createDataFrame([("e", "c", 10, 20, 80), ("e", "c", 10, 20, 300), ("x", "c", 1, 99, 50)], "exon_id string, chr string, j_start int, j_end int, length int")
    excluded = spark.createDataFrame([("e", "c", 1, 99)], "exon_id string, chr string, j_start int, j_end int")
    um = spark.createDataFrame([("s", 1000000)], "sample string, unique_maps long")
    rows = {r.exon_id: r for r in splicing.inclusion_rates(exon, junctions, included, excluded, um, 50).collect()}
    e = rows["e"]  # 5 reads on 500 bases, 4 on a junction of 100 (twice the read), 2 on one of 50
    assert (e.ex_incl, e.junc_inc, e.junc_exc, e.psi) == (10.0, 40.0, 40.0, 0.556)


def test_lanes_that_lack_reads(spark):
    from readloom.operators import compare

    reads = spark.createDataFrame([("a", 5), ("b", 6), ("c", 7)], "lane string, n long")
    mapped = spark.createDataFrame([("a", 5), ("b", 4)], "lane string, n long")
    assert sorted((r.lane, r.problem) for r in compare.read_differences(reads, mapped).collect()) == [("b", "different"), ("c", "absent")]
    pairs = spark.createDataFrame([("p", "1", 5), ("p", "2", 5), ("q", "1", 5), ("q", "2", 6), ("r", "1", 1), ("r", "2", 1), ("r", "3", 1)], "pair string, lane string, n long")
    assert sorted(r.pair for r in compare.unequal_mates(pairs).collect()) == ["q", "r"]


def test_links_of_clusters_shuffle_their_rows_once(spark):
    from pathlib import Path

    from readloom.plans import QUERIES

    def shuffled():
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        executors = spark._jsc.sc().statusStore().executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    sf_dir, before = "/root/testdata/sf0.01", shuffled()
    assert QUERIES["cluster_links"](spark, sf_dir).count() == 1261
    assert shuffled() - before < 6 * Path(sf_dir, "lineitem.parquet").stat().st_size


def test_clusters_of_equal_long_and_nameless_reads(spark):
    rows = [("s", "c", 1, 50, "+")] * 3 + [("s", "c", 51, 100, "+")] * 3 + [("s", "d", 5, 900_000, "+"), ("s", "d", 400_000, 400_049, "-"), ("s", "d", 899_999, 900_048, "+"), ("s", "d", 900_049, 900_098, "+")]
    rows += [(None, "c", 1, 50, "+"), (None, "c", 40, 89, "+"), ("s", None, 1, 50, "-"), ("s", None, 2, 51, "-"), ("s", "c", None, None, "+"), ("s", "c", None, None, "+")]
    df = spark.createDataFrame(rows, "sample string, chr string, start int, end int, strand string")
    want = {("s", "c", 1, 50, "+", 3), ("s", "c", 51, 100, "+", 3), ("s", "d", 5, 900_048, ".", 3), (None, "c", 1, 89, "+", 2), ("s", None, 1, 51, "-", 2)}
    assert set(map(tuple, intervals.read_clusters(df, 2).collect())) == want


def test_links_equal_those_of_single_reads(spark):
    import random

    from readloom.operators import fusions

    rng = random.Random(5)
    clusters = [(s, c, x, x + rng.choice([60, 900, 9000, 30000])) for s in ("s", "t", None) for c in ("c1", "c2") for x in range(1, 400_000, 40_000)]
    places = [(rng.choice(["s", "t", None]), rng.choice([*range(300), None]), 1 + i % 2, rng.choice(["c1", "c1", "c2", None]), x, x + rng.choice([49, 49, 20_000, 90_000])) for i in range(3000) for x in [rng.randrange(1, 20) * 20_000 + rng.randrange(-60, 60)]]
    places += [("s", 1000 + i, f, "c1", x, x + 49) for i in range(9) for f, x in ((1, 30), (2, 40_030))]
    named = [(s, r, f, c, f"{c}_{x}_{y}") for s, r, f, c, a, b in places for t, d, x, y in clusters if s == t and s and c == d and a <= y and b >= x]
    want = {}
    for key in {n[:2] for n in named}:
        own = [n for n in named if n[:2] == key]
        names, chroms = sorted({n[4] for n in own}), {n[3] for n in own}
        if len({n[2] for n in own}) == 2 and len(names) <= 2:
            k = (key[0], names[0], names[-1], "close" if len(names) == 1 else "far" if len(chroms) == 1 else "interchrom")
            want[k] = want.get(k, 0) + 1
    a = spark.createDataFrame(places, "sample string, read_id long, fragment int, chr string, start long, end long")
    b = spark.createDataFrame(clusters, "sample string, chr string, start long, end long")
    got = {tuple(r)[:4]: r.reads for r in fusions.cluster_links(a, b, 1).collect()}
    assert got == want and {k[3] for k in want} == {"close", "far", "interchrom"}
