"""Phrases that stand together more often than their parts would, counted as sorted streams.

Counts of phrases of one word are made first, then of two, up to ``longest``. A
phrase reaches the next round's count only if its first and its last part are
frequent, since a phrase is never more frequent than its parts; this is looked
up in a bit map of fixed size, so a phrase may be counted for nothing but none
is missed. It is counted by its hash first and as text only if phrases of that
hash are frequent together. Frequent phrases are laid out as a stream in prefix order, where a
phrase stands behind its beginnings and before its extensions to the right, and
then in suffix order. One pass over each stream, with a stack of at most
``longest`` phrases, gives the counts of all parts and extensions; nothing is
looked up by hash. Arithmetic is on Python's whole numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.llm.common import staged, table
from readloom.llm.wordhash import _power, mix

_MAP_BITS = 27
_BLOCK_BITS = 19  # 256 blocks of 64 kB
_CHUNK = 1 << 19
_SLICES = 16

_BYTES = bytearray(range(256))
for _c in range(65, 91):
    _BYTES[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _BYTES[_c] = 10
_BYTES[9] = 32
_FOLD = bytes(_BYTES)


def _hashed(texts: list[bytes], langs: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The folded bytes, starts, ends and hashes of all words (the language goes into the hash), piece and text numbers."""
    raw = b"\n".join(t.translate(_FOLD) for t in texts) + b"\n"
    buf = np.frombuffer(raw, dtype=np.uint8)
    space = (buf == 32) | (buf == 10)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _power("up", len(buf)), out=sums[1:])
    h = (sums[end] - sums[start]) * _power("down", len(buf) + 1)[start]
    del sums
    h = mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    piece = np.cumsum(buf == 10)[start]
    bounds = np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))
    text = np.searchsorted(bounds, start, side="right")
    seed = np.array([zlib.crc32(x.encode()) | len(x) << 32 for x in langs], dtype=np.uint64)
    return raw, start, end, mix(h ^ mix(seed)[text] if len(h) else h), piece, text


def _keys(h: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros(len(h) - width + 1, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(0xA0761D6478BD642F) + h[k : k + len(out)]
    return mix(out)


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list[bytes], list[str]]]:
    texts, langs, size = [], [], 0
    for pdf in batches:
        for t, g in zip(pdf["text"], pdf["lang"]):
            if isinstance(t, str) and t:
                texts.append(t.encode())
                langs.append(g)
                size += len(texts[-1])
                if size >= _CHUNK:
                    yield texts, langs
                    texts, langs, size = [], [], 0
    if texts:
        yield texts, langs


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a bit map holds."""
    low = keys & np.uint64((1 << _MAP_BITS) - 1)
    return ((bits[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def _often(docs: DataFrame, width: int, parts, least: int) -> DataFrame:
    """(key) of phrases of ``width`` words whose two parts the map holds, if phrases of that key come ``least`` times or more.

    Most pairs of frequent words are rare themselves: they are shuffled as numbers, never as text.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts, langs in _batches(batches):
            _, _, _, h, piece, _ = _hashed(texts, langs)
            if len(h) < width:
                continue
            held = _has(parts.value, _keys(h, width - 1))
            key, n = np.unique(_keys(h, width)[(piece[: len(h) - width + 1] == piece[width - 1 :]) & held[:-1] & held[1:]], return_counts=True)
            for k in range(0, len(key), 20_000):
                yield pd.DataFrame({"key": key[k : k + 20_000].astype(np.int64), "n": n[k : k + 20_000]})

    rows = docs.mapInPandas(count, "key long, n long")
    return rows.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key")


def _counts(docs: DataFrame, width: int, often) -> DataFrame:
    """(lang, phrase, n, key) of phrases of ``width`` words that the map holds (all, without one), summed over all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts, langs in _batches(batches):
            raw, start, end, h, piece, text = _hashed(texts, langs)
            if len(h) < width:
                continue
            keys = _keys(h, width)
            ok = piece[: len(keys)] == piece[width - 1 :]
            if often is not None:
                ok &= _has(often.value, keys)
            at = np.flatnonzero(ok)
            key, first, n = np.unique(keys[at], return_index=True, return_counts=True)
            at = at[first]
            for k in range(0, len(at), 20_000):
                some = at[k : k + 20_000]
                words = [raw[s:e].decode() for s, e in zip(start[some].tolist(), end[some + width - 1].tolist())]
                yield pd.DataFrame({"lang": [langs[i] for i in text[some].tolist()], "phrase": [" ".join(filter(None, w.split(" "))) if "  " in w else w for w in words], "key": key[k : k + 20_000].astype(np.int64), "n": n[k : k + 20_000]})

    rows = docs.mapInPandas(count, "lang string, phrase string, key long, n long")
    return rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"), F.min("key").alias("key"))


def _bit_map(frequent: DataFrame):
    """A broadcast bit map of fixed size (16 MB) with the keys' low bits set, made block by block in tasks."""

    def block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << (_BLOCK_BITS - 3), dtype=np.uint8)
        low = pdf["low"].to_numpy()
        np.bitwise_or.at(bits, low >> 3, (1 << (low & 7)).astype(np.uint8))
        return pd.DataFrame({"block": [key[0]], "bits": [bits.tobytes()]})

    low = F.col("key").bitwiseAND((1 << _MAP_BITS) - 1)
    places = frequent.select(F.shiftright(low, _BLOCK_BITS).cast("int").alias("block"), low.bitwiseAND((1 << _BLOCK_BITS) - 1).alias("low")).distinct()
    out = np.zeros(1 << (_MAP_BITS - 3), dtype=np.uint8)
    size = 1 << (_BLOCK_BITS - 3)
    for row in places.groupBy("block").applyInPandas(block, "block int, bits binary").toLocalIterator():
        out[row.block * size : (row.block + 1) * size] = np.frombuffer(row.bits, dtype=np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(out)


def frequent_phrases(docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, words, a) of all phrases of up to ``longest`` words with a >= ``least``, and (lang, total) of all words."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    ones = staged(_counts(texts, 1, None), "words")
    totals = staged(ones.groupBy("lang").agg(F.sum("n").alias("total")), "totals", 1)
    level = ones.where(F.col("n") >= least)
    found, bits = level, _bit_map(level)
    for width in range(2, longest + 1):
        often = staged(_often(texts, width, bits, least), "often")
        bits.destroy()
        bits = _bit_map(often)
        found = found.unionByName(staged(_counts(texts, width, bits).where(F.col("n") >= least), "phrases"))
    bits.destroy()
    return found.select("lang", F.split("phrase", " ").alias("words"), F.col("n").alias("a")), totals


def _stream(rows: DataFrame, order: Column, what: str, grown: str) -> DataFrame:
    """One pass over the rows in the order of ``order`` (their words, or these reversed).

    Adds ``what``, the counts of the phrase's beginnings in that order from one
    word on, and ``grown``, the largest count of a phrase one word longer. Rows of one first
    word are cut into slices by the second; the word's own row goes to each slice and comes out of none.
    """
    rows = rows.withColumn("_w", order)
    of_slice = F.when(F.size("_w") > 1, F.array(F.pmod(F.xxhash64(F.col("_w")[1]), F.lit(_SLICES)))).otherwise(F.sequence(F.lit(0).cast("long"), F.lit(_SLICES - 1).cast("long")))
    cut = rows.withColumn("_one", F.col("_w")[0]).withColumn("_slice", F.explode(of_slice))
    ordered = cut.repartitionByRange("lang", "_one", "_slice").sortWithinPartitions("lang", "_one", "_slice", "_w").drop("_one")
    names = [c for c in rows.columns if c != "_w"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[list] = []  # [lang, slice, words, row, largest extension]
        out: list[tuple] = []

        def close(depth: int) -> None:
            while len(stack) > depth:
                _, _, words, row, most = stack.pop()
                if len(words) > 1:
                    out.append((*row, [x[3][at_a] for x in stack], most))
                if stack:
                    stack[-1][4] = max(stack[-1][4], row[at_a])

        at_a = names.index("a")
        for pdf in batches:
            cols = [pdf[c].tolist() for c in names]
            for slice_, w, row in zip(pdf["_slice"].tolist(), pdf["_w"].tolist(), zip(*cols)):
                words, lang = list(w), row[names.index("lang")]
                depth = len(words) - 1
                close(depth if stack and stack[0][0] == lang and stack[0][1] == slice_ else 0)
                while stack and stack[-1][2] != words[: len(stack[-1][2])]:
                    close(len(stack) - 1)
                stack.append([lang, slice_, words, row, 0])
            if out:
                yield pd.DataFrame(out, columns=[*names, what, grown])
                out = []
        close(0)
        if out:
            yield pd.DataFrame(out, columns=[*names, what, grown])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_w")
    return ordered.mapInPandas(scan, f"{schema}, {what} array<bigint>, {grown} bigint")


def _scored(rows: DataFrame) -> DataFrame:
    """Add l, r and score of the lowest-scoring cut, the first of equal ones."""

    def cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            best = []
            for a, n, left, right in zip(pdf["a"].tolist(), pdf["n"].tolist(), pdf["begins"], pdf["ends"]):
                # left[k-1] counts the first k words, right[m-1] the last m
                size = len(left) + 1
                best.append(min((1000 * int(a) * int(n) // (int(left[k - 1]) * int(right[size - k - 1])), k, int(left[k - 1]), int(right[size - k - 1])) for k in range(1, size)))
            out = pdf[["lang", "phrase", "a", "n"]].copy()
            out["l"], out["r"], out["score"] = [b[2] for b in best], [b[3] for b in best], [b[0] for b in best]
            yield out

    return rows.mapInPandas(cuts, "lang string, phrase string, a long, n long, l long, r long, score long")


def mined_phrases(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases.

    A phrase as frequent as a longer one that holds it is dropped; as counts do
    not grow with length, one word more is all that need be looked at. Null
    texts are empty, a null lang is ``und``, repeated rows count each; no texts give no rows.
    """
    frequent, totals = frequent_phrases(docs, longest, least)
    begun = _stream(frequent, F.col("words"), "begins", "right_most")
    ones = frequent.where(F.size("words") == 1).select("lang", "words", "a", F.array().cast("array<bigint>").alias("begins"), F.lit(0).cast("long").alias("right_most"))
    begun = staged(begun.unionByName(ones), "prefix_order")
    both = _stream(begun, F.reverse("words"), "ends", "left_most").where("greatest(right_most, left_most) < a")
    with_n = both.join(totals.withColumnRenamed("total", "n"), "lang")
    scored = staged(_scored(with_n.select("lang", F.concat_ws(" ", "words").alias("phrase"), "a", "n", "begins", "ends")), "scored")
    best = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*best)
    few = scored.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)  # at most 64 * top rows a language
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two to five words in each language of all documents."""
    return mined_phrases(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
worded AS (SELECT lang, w FROM (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces) WHERE len(w) > 0),
grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS ws FROM worded, range(1, 6) t(m) WHERE len(w) >= m),
f AS (SELECT lang, m, ws, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 100),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
cuts AS (SELECT p.lang, p.ws, p.m, p.c AS a, k, x.c AS l, y.c AS r, n, (1000::HUGEINT * p.c * n) // (x.c::HUGEINT * y.c) AS score
  FROM f p CROSS JOIN range(1, 5) t(k) JOIN f x ON x.lang = p.lang AND x.ws = p.ws[1:k] JOIN f y ON y.lang = p.lang AND y.ws = p.ws[k + 1:p.m] JOIN total ON total.lang = p.lang WHERE p.m > 1 AND k < p.m),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
inner_parts AS (SELECT DISTINCT lang, c, unnest([ws[1:m - 1], ws[2:m]]) AS ws FROM f WHERE m > 2),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM inner_parts i WHERE i.lang = b.lang AND i.ws = b.ws AND i.c >= b.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ws, ' ')) AS rank, array_to_string(ws, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
