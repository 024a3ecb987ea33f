"""Benchmark decontamination by greedy string tiling with running Karp-Rabin hashes.

Wise's method: Karp-Rabin hashes of 5-word windows give shared seeds; seeds next
to each other on a diagonal make maximal matches; the longest match without
marked words is marked on both sides as a tile, again and again. A test item is
found in a document when tiles cover enough of it, in whatever order they stand.
Items shorter than a tile are found where all their words stand in a row.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import fresh, staged, table
from readloom.llm.wordhash import chunks, hash_words, windows

#: Words of the shortest tile.
MIN_TILE = 5
#: Bytes of benchmark text that a broadcast may hold; a larger benchmark is gone through in blocks.
BLOCK_BYTES = 16 << 20
#: Seeds of one document that are listed at once; a document with more is tiled with some of the items at a time.
SEEDS = 1 << 20
LEAKS = "array<struct<item_id:long,item_words:long,matched_words:long,tiles:long,coverage:double>>"


def tile(doc: np.ndarray, item: np.ndarray, at_doc: np.ndarray, at_item: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Tiles (doc position, item position, words) from all seeds, the longest first.

    Ties go to the earlier item position, then the earlier document position.
    """
    order = np.lexsort((at_item, at_doc - at_item))
    i, j = at_doc[order], at_item[order]
    new = np.flatnonzero(np.append(True, (np.diff(i - j) != 0) | (np.diff(j) != 1)))
    stop = np.append(new[1:], len(i))
    heap = [(-(int(b - a) + least - 1), int(j[a]), int(i[a])) for a, b in zip(new, stop)]
    heapq.heapify(heap)
    doc_free, item_free = np.ones(len(doc), dtype=bool), np.ones(len(item), dtype=bool)
    tiles = []
    while heap:
        n, q, p = heapq.heappop(heap)
        n = -n
        free = doc_free[p : p + n] & item_free[q : q + n]
        if free.all():
            doc_free[p : p + n] = item_free[q : q + n] = False
            tiles.append((p, q, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
        for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
            if b - a >= least:
                heapq.heappush(heap, (-(b - a), q + a, p + a))
    return tiles


class Index:
    """The benchmark items of one block, by the hashes of their windows."""

    def __init__(self, ids: list[int], texts: list[str], coverage: float):
        self.ids, self.coverage = ids, coverage
        h, at = hash_words([t.encode("utf-8", "surrogatepass").lower() for t in texts])
        self.words = [h[a:b] for a, b in zip(at[:-1], at[1:])]
        wins = [windows(w, MIN_TILE) for w in self.words]
        item = np.repeat(np.arange(len(wins)), [len(w) for w in wins])
        pos = np.concatenate([np.arange(len(w)) for w in wins]) if wins else np.zeros(0, dtype=np.int64)
        hashes = np.concatenate(wins) if wins else np.zeros(0, dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.item, self.pos = item[order], pos[order]
        self.hashes, rank = np.unique(hashes[order], return_inverse=True)
        self.key = rank * max(len(ids), 1) + self.item  # ascending, as items are within a hash
        self.short: dict[int, dict[int, list[int]]] = {}
        for k, w in enumerate(self.words):
            if 0 < len(w) < MIN_TILE:
                self.short.setdefault(len(w), {}).setdefault(int(windows(w, len(w))[0]), []).append(k)

    def search(self, doc: np.ndarray) -> list[tuple]:
        """Items whose coverage by tiles reaches the threshold, and short items that are there whole."""
        found = []
        for n, by_hash in self.short.items():
            for h in set(windows(doc, n).tolist()) & by_hash.keys():
                found += [(self.ids[k], n, n, 1, 1.0) for k in by_hash[h]]
        w = windows(doc, MIN_TILE)
        if len(w) and len(self.hashes):
            k = np.minimum(np.searchsorted(self.hashes, w), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[k] == w)
            if len(hit):
                found += self._tiled(doc, hit, k[hit], 0, len(self.ids))
        return sorted(found)

    def _tiled(self, doc: np.ndarray, hit: np.ndarray, k: np.ndarray, low: int, high: int) -> list[tuple]:
        """The items from ``low`` up to ``high`` that tiles cover enough; ``k`` has the hash numbers at places ``hit``."""
        first = np.searchsorted(self.key, k * len(self.ids) + low)
        times = np.searchsorted(self.key, k * len(self.ids) + high) - first
        if times.sum() > SEEDS and high - low > 1:
            middle = (low + high) // 2
            return self._tiled(doc, hit, k, low, middle) + self._tiled(doc, hit, k, middle, high)
        entry = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())
        item, pos, at = self.item[entry], self.pos[entry], np.repeat(hit, times)
        order = np.argsort(item, kind="stable")
        item, pos, at = item[order], pos[order], at[order]
        cut = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
        out = []
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(item)).tolist()) if len(item) else ():
            words = self.words[item[a]]
            seen = np.zeros(len(words) + 1, dtype=np.int64)
            one = np.unique(pos[a:b])
            seen[one] += 1
            seen[one + MIN_TILE] -= 1
            if (np.cumsum(seen)[:-1] > 0).sum() < self.coverage * len(words):
                continue  # tiles cannot cover more than all seeds do
            tiles = tile(doc, words, at[a:b], pos[a:b])
            matched = sum(n for _, _, n in tiles)
            if matched >= self.coverage * len(words):
                out.append((self.ids[item[a]], len(words), matched, len(tiles), matched / len(words)))
        return out


def _searcher(sent):
    @F.pandas_udf(LEAKS)
    def search(s: pd.Series) -> pd.Series:
        raw = [t.encode("utf-8", "surrogatepass").lower() if isinstance(t, str) else b"" for t in s]
        out = []
        for _, part in chunks(raw, 1 << 16):
            h, at = hash_words(part)
            for a, b in zip(at[:-1], at[1:]):
                found = sent.value.search(h[a:b])
                out.append([dict(zip(("item_id", "item_words", "matched_words", "tiles", "coverage"), x)) for x in found])
        return pd.Series(out)

    return search


def with_leaks(docs: DataFrame, bench: DataFrame, coverage: float = 0.4, text: str = "text", into: str = "leaks") -> DataFrame:
    """Add the array ``into`` of the benchmark items that the whole text holds.

    Words are compared without regard to the case of A-Z. Items without an id or
    without a word are found nowhere; one of less than five words is found where
    it stands whole. A null or empty text holds nothing; an empty benchmark gives
    empty arrays. An item that is listed twice is reported twice, a repeated
    document has its array in each row, and a column named ``into`` is replaced.
    A benchmark of any size is gone through in blocks of about BLOCK_BYTES, each
    broadcast; documents are staged between blocks, so that a worker holds one
    block at a time, and never shuffled.
    """
    items = bench.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // BLOCK_BYTES) + 1
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()  # about BLOCK_BYTES
        rows = sorted((r.item_id, r.text) for r in rows)
        sent = docs.sparkSession.sparkContext.broadcast(Index([i for i, _ in rows], [t for _, t in rows], coverage))
        found = _searcher(sent)(F.col(text).cast("string"))
        if k:
            more = fresh(docs, "_more")
            docs = staged(docs, "leaks").withColumn(more, found).withColumn(into, F.sort_array(F.concat(into, more))).drop(more)
        else:
            docs = docs.withColumn(into, found)
    return docs


def clean_of(docs: DataFrame, bench: DataFrame, coverage: float = 0.4) -> DataFrame:
    """The documents that hold no benchmark item, with their columns."""
    own = fresh(docs, "_leaks")
    return with_leaks(docs, bench, coverage, into=own).where(F.size(own) == 0).drop(own)


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item found in it; clean documents have none."""
    docs = with_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
