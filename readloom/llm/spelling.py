"""Spelling variants: words one edit apart, found by a frontier that walks a trie level by level.

The trie is a table: an edge leads from a prefix (its hash) by some letters to a
longer prefix. A state of the frontier is (word, position, node): so much of
the word is read, and the edit is spent. As a pair differs in one place, its
words agree before or behind the middle; they are walked forwards from the
middle and, as reversed words, backwards. So the edit is made deep in the trie,
where few edges leave a node. The first level makes the edit and reads three
letters, each later one twice as many as that before, so a word of n letters
needs about log2(n) levels. Every level is one join, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.common import staged, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = 3


def varied_words(docs: DataFrame, min_letters: int = 7, min_count: int = 2, mod: int = 31) -> DataFrame:
    """(word, n): runs of letters, some with one letter taken out as crc32 of doc_id and run decides.

    A null text has no runs, a null doc_id counts as the empty text, repeated
    rows count each. Runs shorter than ``min_letters`` cannot become words.
    """
    runs = docs.select("doc_id", F.explode(F.expr(rf"regexp_extract_all(text, '[A-Za-z\\u00C0-\\u00FF]{{{min_letters},}}', 0)")).alias("run"))
    runs = runs.select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.expr("cast(h % length(run) as int)")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % mod == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= min_letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _edges(both: DataFrame, after: int, step: int, skip: bool) -> DataFrame:
    """Edges of ``step`` letters (the last ones of a word may be fewer), with a free letter ``c`` in front if ``skip``.

    Only places that a frontier can reach are listed: ``after`` letters or more behind the middle.
    """
    jump = 1 if skip else 0
    at = both.where(f"int((len - 1) div 2) + {after} < len").select("way", "key", "len", F.explode(F.expr(f"sequence(int((len - 1) div 2) + {after}, len - 1)")).alias("d")).where("d < len")
    label = F.substring("key", F.col("d") + 1 + jump, F.lit(step))
    end = F.least(F.col("d") + jump + step, "len")
    edge = at.select(
        F.xxhash64("way", F.substring("key", F.lit(1), F.col("d")), label).alias("go") if skip else F.xxhash64(F.xxhash64("way", F.substring("key", F.lit(1), F.col("d"))), label).alias("go"),
        (F.substring("key", F.col("d") + 1, F.lit(1)) if skip else F.lit("")).alias("c"),
        F.xxhash64("way", F.substring("key", F.lit(1), end)).alias("child"),
        F.when(end == F.col("len"), F.col("key")).alias("found"),
    )
    return edge.repartition("go").distinct()


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near) for all words of ``words`` (distinct, staged) that are one insertion, deletion or replacement apart, both ways round."""
    both = words.where("length(word) > 0").select(F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("key")), F.struct(F.lit(1).alias("way"), F.reverse("word").alias("key")))).alias("x"))
    both = both.select("x.way", "x.key", F.length("x.key").alias("len"))
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    # A replacement is made from the word of lesser letter, an insertion from the shorter word; the other way round follows.
    own = both.select("way", "key", F.explode(F.expr("sequence(int(len div 2), len)")).alias("d"))
    own = own.select("way", "key", "d", F.explode(F.expr("if(d < length(key), array(1, 0), array(0))")).alias("uses"))
    label = F.substring("key", F.col("d") + 1 + F.col("uses"), F.lit(_STEP))
    own = own.select(
        F.xxhash64("way", F.substring("key", F.lit(1), F.col("d")), label).alias("go"), "way", "key", "uses",
        F.substring("key", F.col("d") + 1, F.lit(1)).alias("mine"), F.least(F.col("d") + F.col("uses") + _STEP, F.length("key")).alias("pos"),
    )
    states = own.join(_edges(both, 0, _STEP, True), "go").where("(uses = 1 and c > mine) or (uses = 0 and c <> mine)").select("way", "key", "pos", "child", "found")
    pairs, after, step = [], 1 + _STEP, 2 * _STEP
    while True:
        # A state whose word is read is done; it has a neighbour if its node ends a word.
        states = staged(states.where("pos < length(key) or found is not null"), "frontier")
        pairs.append(states.where("pos = length(key) and found is not null").select("way", "key", "found"))
        if longest - longest // 2 + 1 < after:
            break
        going = states.where("pos < length(key)").withColumn("label", F.substring("key", F.col("pos") + 1, F.lit(step)))
        going = going.select(F.xxhash64("child", "label").alias("go"), "way", "key", F.least(F.col("pos") + step, F.length("key")).alias("pos"))
        states = going.join(_edges(both, after, step, False).drop("c"), "go").select("way", "key", "pos", "child", "found")
        after, step = after + step, 2 * step
    met = pairs[0]
    for p in pairs[1:]:
        met = met.unionByName(p)
    turn = lambda c: F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c))
    met = met.select(turn("key").alias("a"), turn("found").alias("b")).where("levenshtein(a, b) = 1")
    return met.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))).alias("x")).select("x.*").distinct()


def variant_groups(words: DataFrame, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n: each word's far more frequent neighbour, and the last word on the way of forms.

    ``words`` has distinct words and their counts n. A form is ``times`` as
    frequent at least, so ways of forms end after some 18 steps at any size.
    """
    words = staged(words.select("word", "n"), "words")
    pairs = near_pairs(words)
    of_near = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = of_near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    known = words.join(best, "word", "left")
    big = -F.col("best.m") >= times * F.col("n")
    known = staged(
        known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(big, F.col("best.near")).alias("form"), F.when(big, -F.col("best.m")).alias("form_n")), "near"
    )
    ways = staged(known.where("form is not null").select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = staged(ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        if ways.where("moved").isEmpty():
            break
        ways = ways.drop("moved")
    out = known.join(ways.select("word", "root"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven letters or more, their neighbours and forms, over all documents."""
    return variant_groups(varied_words(table(spark, sf_dir, "documents")))
