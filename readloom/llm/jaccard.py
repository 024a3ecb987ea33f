"""Exact n-gram Jaccard join that skips by set relations (Wang et al., PVLDB 10(9)).

A document's set is that of its distinct 5-word shingles. Two sets are linked
when 100 * |intersection| >= 80 * |union|. The join is exact (up to equal 64-bit
shingle hashes) and never lists the pairs within a group of copies:

1. Equal sets are one class; the rest works on classes.
2. Index lists hold each set's prefix: the rarest fifth of its shingles, in an
   order that is the same for all sets. Only lists that two sets share are kept.
3. In each list every set proposes links to two of them, the list's hubs, in two
   rounds with other hubs. What is verified gives the first components. Lists
   whose entries lie in one component are done. In the others entries form
   blocks of like set sizes and positions; blocks are compared by their bounds
   first, so a pair of blocks that cannot reach the threshold is skipped whole,
   and entries without a block to meet leave.
4. Members of the rest become a pair only in the first list that they share, as
   far as each one's first lists tell, and only if 256 parity bits leave a link
   possible; 2048 bits are tried before texts are sent.
5. A surviving pair (x, z) takes its overlap from that of x's hub and z: the
   counts of what x has beyond its hub, and lacks of it, bound the overlap, and
   only pairs that the bounds leave open are counted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.common import fresh, staged, table
from readloom.llm.components import components
from readloom.llm.wordhash import chunks, hash_words, mix, windows

WIDTH = 5
#: Shingles that go last in the order of rarity; the bound of that broadcast. It changes cost, never results.
HOT_SHINGLES = 16_384
#: Ids that a lookup by broadcast may hold; beyond it, the lookup is a shuffled join.
BROADCAST_IDS = 500_000
#: First lists of a set that its entries carry. A pair is skipped where these prove an earlier shared list; it changes cost, never results.
FIRST_LISTS = 6
#: Pairs of one hub that a task gets; a hub with more is dealt to several.
_HUB_PAIRS = 256
#: Index entries that one task handles at once.
_LIST_ENTRIES = 200_000
#: Index entries for each file of a staged table; tables are no larger than the index.
_FILE_ENTRIES = 100_000
#: Bytes of texts that Python is handed at once: a hub's long text may come with every row of a batch.
_BATCH_BYTES = 4 << 20
_ENTRY = np.dtype([("s", "<u8"), ("a", "<u8"), ("n", "<u4"), ("p", "<u4")])
#: Bits of a set's parities, and longs of the coarse ones that index entries carry.
_FINE_BITS, _COARSE = 2048, 4
_DIGEST = T.StructType([T.StructField(c, T.LongType()) for c in "nab"] + [T.StructField("f", T.ArrayType(T.LongType()))])
_BITS = [f"w{k}" for k in range(_COARSE)]


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a text under five words has one shingle, without words none."""
    raw = [t.encode("utf-8", "surrogatepass").lower() if isinstance(t, str) else b"" for t in texts]
    for _, part in chunks(raw, 1 << 16):
        h, at = hash_words(part)
        full = windows(h, WIDTH)
        for k in range(len(part)):
            own = h[at[k] : at[k + 1]]
            if len(own) < WIDTH:
                yield windows(own, len(own)) if len(own) else own
                continue
            w = np.sort(full[at[k] : at[k + 1] - WIDTH + 1])
            yield w[np.append(True, w[1:] != w[:-1])]


def _slices(batches: Iterator[pd.DataFrame], rows: int = 1000) -> Iterator[list]:
    """The texts of each batch in runs of some rows, which bounds the memory of what is made of them."""
    for pdf in batches:
        for k in range(0, len(pdf), rows):
            yield pdf["text"].iloc[k : k + rows].tolist()


def _identity(s: np.ndarray) -> tuple[int, int]:
    """A set's 128-bit identity as two signed longs."""
    return int(np.add.reduce(s).astype(np.int64)), int(np.bitwise_xor.reduce(s).astype(np.int64))


def _parities(s: np.ndarray) -> np.ndarray:
    """_FINE_BITS bits: the parity of how many shingles fall on each.

    Two sets differ in at least as many shingles as their parities differ in
    bits. Folded by exclusive or, the bits are those of fewer, coarser ones.
    """
    odd = (np.bincount((s % np.uint64(_FINE_BITS)).astype(np.int64), minlength=_FINE_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _near_enough(one: str, two: str, n1: str, n2: str):
    """Whether sizes and coarse parities of columns with the two prefixes leave a link possible."""
    apart = " + ".join(f"bit_count({one}{w} ^ {two}{w})" for w in _BITS)
    return F.expr(f"9 * ({n1} + {n2} - ({apart})) >= 8 * ({n1} + {n2})")


def _fine_enough(pairs: DataFrame, classes: DataFrame, one: str, two: str) -> DataFrame:
    """The pairs, by class ids in columns ``one`` and ``two``, that all parity bits leave possible."""
    bits = lambda name: classes.select(F.col("sid").alias(name), F.col("f").alias(f"f_{name}"), F.col("n").alias(f"n_{name}"))
    both = pairs.join(bits(one), one).join(bits(two), two)
    apart = f"aggregate(zip_with(f_{one}, f_{two}, (p, q) -> bit_count(p ^ q)), 0, (s, v) -> s + v)"
    return both.where(F.expr(f"9 * (n_{one} + n_{two} - {apart}) >= 8 * (n_{one} + n_{two})")).select(*pairs.columns)


def _digests(docs: DataFrame) -> DataFrame:
    @F.pandas_udf(_DIGEST)
    def digest(text: pd.Series) -> pd.DataFrame:
        rows = []
        for s in shingle_sets(text.tolist()):
            if len(s):
                a, b = _identity(s)
                rows.append((len(s), a, b, _parities(s)))
            else:
                rows.append((0, 0, 0, None))
        return pd.DataFrame(rows, columns=_DIGEST.names)

    return docs.select("doc_id", "row", digest("text").alias("d")).select("doc_id", "row", "d.*")


def _hot_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of all documents and their counts, sorted by shingle.

    Tasks leave out what is rare among their own rows, so counts are low
    estimates; they set the order of shingles, which may be any.
    """

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for text in _slices(batches):
            sets = [s for s in shingle_sets(text) if len(s)]
            if not sets:
                continue
            one, n = np.unique(np.concatenate(sets), return_counts=True)
            keep = n >= (3 if len(sets) > 500 else 2)
            yield pd.DataFrame({"s": one[keep].astype(np.int64), "n": n[keep]})

    rows = docs.select("text").mapInPandas(frequent, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "s").limit(HOT_SHINGLES).collect()  # bounded by HOT_SHINGLES
    s = np.array([r.s for r in top], dtype=np.int64).astype(np.uint64)
    n = np.array([r.n for r in top], dtype=np.int64)
    order = np.argsort(s)
    return s[order], n[order]


def _prefix(s: np.ndarray, hot: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first n - ceil(0.8 n) + 1 shingles in order of rarity, and which of them are hot."""
    size = len(s) + (-4 * len(s) // 5) + 1
    if not len(hot):
        return s[:size], np.zeros(size, dtype=bool)
    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
    is_hot = hot[at] == s
    if is_hot.any():
        order = np.lexsort((s, np.where(is_hot, weight[at], 0)))[:size]
        return s[order], is_hot[order]
    return s[:size], is_hot[:size]


def _live_entries(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """Index entries (shingle, a, n, pos) of all lists that two different sets share.

    Entries travel packed, some thousands in a row, to the bucket of their
    shingle. Those of hot shingles, known to be shared, are dealt out evenly.
    """
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, weight = sent.value
        for turn, text in enumerate(_slices(batches)):
            found, done = [], set()
            for s in shingle_sets(text):
                if not len(s):
                    continue
                a = _identity(s)[0]
                if a in done:
                    continue
                done.add(a)
                pre, is_hot = _prefix(s, own, weight)
                e = np.zeros(len(pre), dtype=_ENTRY)
                e["s"], e["a"], e["n"], e["p"] = pre, np.int64(a).astype(np.uint64), len(s), np.arange(len(pre))
                found.append((e, is_hot))
            if not found:
                continue
            e, is_hot = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
            bucket = (mix(e["s"]) % np.uint64(buckets)).astype(np.int64)
            spread = (np.arange(len(e)) // 1000 + turn * 7919 + int(e["a"][0] % np.uint64(1 << 30))) % buckets
            bucket = np.where(is_hot, -1 - spread, bucket)
            order = np.argsort(bucket, kind="stable")
            e, bucket = e[order], bucket[order]
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            parts = np.split(e, cut[1:])
            yield pd.DataFrame({"bucket": bucket[cut], "payload": [x.tobytes() for x in parts]})

    def shared(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        e = np.frombuffer(b"".join(pdf["payload"]), dtype=_ENTRY)
        if key[0] >= 0:
            e = e[np.lexsort((e["a"], e["s"]))]
            new_s = np.append(True, e["s"][1:] != e["s"][:-1])
            new = new_s | np.append(True, e["a"][1:] != e["a"][:-1])  # copies met in different batches go
            e, new_s = e[new], new_s[new]
            run = np.cumsum(new_s) - 1
            e = e[np.bincount(run)[run] > 1] if len(e) else e
        return pd.DataFrame({"s": e["s"].astype(np.int64), "a": e["a"].astype(np.int64), "n": e["n"].astype(np.int64), "pos": e["p"].astype(np.int64)})

    packed = docs.select("text").mapInPandas(pack, "bucket long, payload binary")
    return packed.groupBy("bucket").applyInPandas(shared, "s long, a long, n long, pos long")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Join the text of each class's first row to ``ids`` (with rep_row): row numbers are unique, whatever doc_ids are."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.select(F.col("row").alias("_r"), "text").join(ids, F.col("_r") == F.col("rep_row")).drop("_r")


_MEASURED = T.StructType([T.StructField(c, T.LongType()) for c in ("o", "extra", "lacking")])


@F.pandas_udf(_MEASURED)
def _measure(x: pd.Series, y: pd.Series) -> pd.DataFrame:
    """The overlap of the sets of two texts and what each has beyond."""
    rows, kept = [], {}

    def get(text: str) -> np.ndarray:
        if text not in kept:
            if len(kept) >= 64:
                kept.clear()
            kept[text] = next(shingle_sets([text]))
        return kept[text]

    for p, q in zip(x, y):
        s, t = get(p), get(q)
        o = len(np.intersect1d(s, t, assume_unique=True))
        rows.append((o, len(s) - o, len(t) - o))
    return pd.DataFrame(rows, columns=_MEASURED.names)


def _linked(o, n1, n2):
    return 180 * o >= 80 * (n1 + n2)


def measured(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exact overlaps of distinct pairs (x, y) of class ids: x, y, nx, ny, o, extra (of x), lacking (of y).

    ``pairs`` is read several times, so callers stage it. The pairs of a hub y
    that has more than _HUB_PAIRS are dealt out over parts, each with a copy of y.
    """
    heavy = pairs.groupBy("y").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > _HUB_PAIRS).select("y", F.ceil(F.col("_n") / _HUB_PAIRS).alias("parts"))
    dealt = pairs.select("x", "y").join(heavy, "y", "left").select("x", "y", F.pmod(F.xxhash64("x"), F.coalesce("parts", F.lit(1))).alias("part"))
    one = classes.select(F.col("sid").alias("x"), "rep_row", F.col("n").alias("nx"))
    two = classes.select(F.col("sid").alias("y"), "rep_row", F.col("n").alias("ny"))
    left = _texts(docs, dealt.join(one, "x")).select("x", "y", "part", "nx", F.col("text").alias("tx"))
    right = _texts(docs, two.join(pairs.select("y").distinct(), "y", "left_semi")).select("y", "ny", F.col("text").alias("ty"))
    measure = _measure.asNondeterministic()  # else a filter on the overlap would run it a second time, in a second worker
    right = right.join(heavy, "y", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return left.join(right, ["y", "part"]).withColumn("m", measure("tx", "ty")).select("x", "y", "nx", "ny", "m.*")


def _merged(placed: DataFrame, edges: DataFrame, files: int) -> DataFrame:
    """Components (sid, comp) after edges (u, v) between them."""
    late = components(edges, files)
    return staged(placed.join(late, F.col("comp") == F.col("node"), "left").select("sid", F.coalesce("root", "comp").alias("comp")), "placed", files)


def _asks(lists: DataFrame, order: str) -> DataFrame:
    """Each set's proposals (x, y) to the two hubs of its lists, with their components (u, v).

    ``lists`` has s, sid, comp, n and pos. The hubs of a list come first and last in ``order``.
    """
    hub = F.struct(F.expr(order).alias("_o"), "sid", "comp", "n", "pos")
    two = lists.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(hub).alias("one"), F.max(hub).alias("two")).where("lo < hi")
    found = lists.join(two.select("s", F.explode(F.array("one", "two")).alias("hub")), "s")
    found = found.where("comp <> hub.comp and 5 * least(n, hub.n) >= 4 * greatest(n, hub.n) and 9 * least(n - pos, hub.n - hub.pos) >= 4 * (n + hub.n)")
    edge = F.min(F.struct(F.col("comp").alias("u"), F.col("hub.comp").alias("v"))).alias("e")
    return found.groupBy(F.col("sid").alias("x"), F.col("hub.sid").alias("y")).agg(edge).select("x", "y", "e.*")


def _open_pairs(lists: DataFrame, classes: DataFrame, files: int) -> DataFrame:
    """Pairs (x, z) of different components that some list leaves possible, with cx, cz, n1 and n2.

    ``lists`` has s, sid, comp, n and pos of lists in more than one component, staged.
    """
    # Blocks of like sizes and relative positions, some dozen a list however long it is, are compared before their members are.
    lists = lists.withColumns({"nb": F.floor(F.log(F.col("n")) / math.log(1.25)).cast("int"), "pb": F.floor(F.col("pos") * 20 / F.col("n")).cast("int")})
    bounds = (F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.min("pos").alias("p"))
    blocks = lists.groupBy("s", "nb", "pb").agg(*bounds)
    side = lambda k: blocks.select("s", *[F.col(c).alias(f"{c}{k}") for c in blocks.columns if c != "s"])
    can = F.expr(
        "(nb1 < nb2 or (nb1 = nb2 and pb1 <= pb2)) and least(lo1, lo2) < greatest(hi1, hi2) and 5 * n_hi1 >= 4 * n_lo2 and 5 * n_hi2 >= 4 * n_lo1"
        " and 5 * n_hi1 - 9 * p1 >= 4 * n_lo2 and 5 * n_hi2 - 9 * p2 >= 4 * n_lo1"
    )
    open_blocks = staged(side(1).join(side(2), "s").where(can).select("s", "nb1", "pb1", "nb2", "pb2"), "blocks", files)
    met = open_blocks.select("s", F.explode(F.array(*[F.struct(F.col(f"nb{k}").alias("nb"), F.col(f"pb{k}").alias("pb")) for k in (1, 2)])).alias("b"))
    lists = staged(lists.join(met.select("s", "b.*").distinct(), ["s", "nb", "pb"], "left_semi"), "met", files)

    # The first lists of each set. A pair that shares one of those before this list has met there, as its positions there are no worse.
    rank = F.row_number().over(Window.partitionBy("sid").orderBy("pos"))
    first = lists.select("sid", "pos", "s").withColumn("_r", rank).where(F.col("_r") <= FIRST_LISTS)
    first = first.groupBy("sid").agg(F.collect_list(F.struct("pos", "s")).alias("first"))
    known = classes.select("sid", *_BITS).join(first, "sid")
    early = F.transform(F.filter("first", lambda t: t["pos"] < F.col("pos")), lambda t: t["s"])
    lists = staged(lists.join(known, "sid").select("s", "nb", "pb", "n", "pos", "sid", "comp", *_BITS, early.alias("early")), "open", files)

    def member(k: int, sid: str) -> DataFrame:
        same = [F.col(c).alias(f"{c}{k}") for c in ("nb", "pb", "n")] + [F.col("pos").alias(f"p{k}"), F.col("early").alias(f"early{k}")]
        return lists.select("s", *same, F.col("sid").alias(sid), F.col("comp").alias(f"c{sid}"), *[F.col(w).alias(sid + w) for w in _BITS])

    pairs = open_blocks.join(member(1, "x"), ["s", "nb1", "pb1"]).join(member(2, "z"), ["s", "nb2", "pb2"])
    pairs = pairs.where("cx <> cz and (nb1 < nb2 or pb1 < pb2 or x < z) and 9 * least(n1 - p1, n2 - p2) >= 4 * (n1 + n2)")
    pairs = pairs.where(_near_enough("x", "z", "n1", "n2")).where("not arrays_overlap(early1, early2)")
    return pairs.select("x", "z", "cx", "cz", "n1", "n2").distinct()


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs``, written once with a number a row in column ``name``, so that every later read finds the same numbers."""
    return staged(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")


def jaccard_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, roots): rows to identities, classes of equal sets, class to component.

    ``docs`` needs doc_id, text and row, as numbered() gives them. Only links that join different components
    are looked for once the hubs have joined the obvious ones; no component is missed.
    """
    docs = docs.select("doc_id", "text", "row")
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", _BATCH_BYTES)
    members = staged(_digests(docs), "members")
    entries = members.agg(F.sum(F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1)).first()[0] or 0
    files = max(int(entries) // _FILE_ENTRIES + 1, 24)
    classes = (
        members.where("n > 0").groupBy("a", "b")
        .agg(F.min("doc_id").alias("rep_doc"), F.min("row").alias("rep_row"), F.first("n").alias("n"), F.first("f").alias("f"))
        .withColumns({"sid": F.monotonically_increasing_id(), **{w: F.expr(" ^ ".join(f"f[{i}]" for i in range(k, _FINE_BITS // 64, _COARSE))) for k, w in enumerate(_BITS)}})
    )
    classes = staged(classes, "classes", files)

    live = _live_entries(docs, _hot_shingles(docs), max(int(entries) // _LIST_ENTRIES + 1, 24))
    live = staged(live.dropDuplicates(["s", "a"]).join(classes.select("a", "sid"), "a").drop("a"), "lists", files)

    # Hubs: every entry of a list that joins components proposes links to the list's two hubs.
    placed, links = None, None
    for order in ("sid", "xxhash64(sid)"):
        lists = live.withColumn("comp", F.col("sid")) if placed is None else live.join(placed, "sid")
        asks = staged(_fine_enough(_asks(lists, order), classes, "x", "y"), "asks", files)
        new = staged(measured(docs, classes, asks).where(_linked(F.col("o"), F.col("nx"), F.col("ny"))), "hubs", files)
        if placed is None:
            placed = classes.select("sid", F.col("sid").alias("comp"))
        placed = _merged(placed, asks.join(new.select("x", "y"), ["x", "y"]).select("u", "v"), files)
        links = new if links is None else links.unionByName(new)
    lists = live.join(placed, "sid")
    mixed = lists.groupBy("s").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("s")
    pairs = _open_pairs(staged(lists.join(mixed, "s"), "mixed", files), classes, files)
    pairs = staged(_fine_enough(pairs, classes, "x", "z"), "pairs", files)

    # Overlaps by way of hubs.
    best = links.groupBy("x").agg(F.min(F.struct(F.expr("extra + lacking").alias("d"), F.col("y").alias("hub"), "extra", "lacking")).alias("h"))
    best = best.select("x", "h.hub", "h.extra", "h.lacking")
    way = staged(pairs.join(best, "x", "left").select("*", F.coalesce("hub", "x").alias("r")), "way", files)
    by_hub = staged(measured(docs, classes, staged(way.where("r <> z").select(F.col("r").alias("x"), F.col("z").alias("y")).distinct(), "asked", files)), "by_hub", files)
    known = way.join(by_hub.select(F.col("x").alias("r"), F.col("y").alias("z"), "o"), ["r", "z"])
    least, most = F.col("o") - F.coalesce("lacking", F.lit(0)), F.col("o") + F.coalesce("extra", F.lit(0))
    known = staged(known.select("x", "z", "cx", "cz", _linked(least, F.col("n1"), F.col("n2")).alias("yes"), _linked(most, F.col("n1"), F.col("n2")).alias("may")), "known", files)
    unsure = known.where("may and not yes")
    counted = measured(docs, classes, unsure.select("x", F.col("z").alias("y"))).where(_linked(F.col("o"), F.col("nx"), F.col("ny")))
    found = known.where("yes").select("cx", "cz").unionByName(counted.select("x", F.col("y").alias("z")).join(unsure, ["x", "z"]).select("cx", "cz"))
    roots = _merged(placed, found.select(F.col("cx").alias("u"), F.col("cz").alias("v")), files).withColumnRenamed("comp", "root")
    return members, classes, roots


def _placed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with what ``found`` has for their class (a, b).

    A class may hold a third of all rows, so members join by class and one of
    64 slices; ``found`` goes to those slices alone that have rows.
    """
    cut = members.withColumn("_k", F.pmod("row", F.lit(64)))
    return cut.join(cut.select("a", "b", "_k").distinct().join(found, ["a", "b"]), ["a", "b", "_k"]).drop("_k")


def component_ids(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, its group's least doc_id.

    A document without words has an empty set and stands alone. Copies share a
    group. A row without doc_id keeps its null id; its group's id is the least
    id among the others, or null. Repeated rows give repeated rows.
    """
    members, classes, roots = jaccard_classes(numbered(docs.select("doc_id", "text"), "row"))
    with_root = classes.select("sid", "a", "b", "rep_doc").join(roots, "sid")
    first = with_root.groupBy("root").agg(F.min("rep_doc").alias("component_id"))
    found = with_root.join(first, "root").select("a", "b", "component_id")
    rows = members.select("doc_id", F.col("n").alias("n_shingles"), "row", "a", "b")
    joined = _placed(rows.where("n_shingles > 0"), found).select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: that of least doc_id (null ids last), of those the first that is read.

    Rows without words all stay. Rows are decided one by one, whether or not a
    doc_id or a whole row is repeated.
    """
    own = fresh(docs, "_row")
    rows = numbered(docs, own)
    members, classes, roots = jaccard_classes(rows.select("doc_id", "text", F.col(own).alias("row")))
    placed = _placed(members.where("n > 0").select("doc_id", "row", "a", "b"), classes.select("a", "b", "sid").join(roots, "sid").select("a", "b", "root"))
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("kept")).select(F.col("kept.row").alias("row"))
    gone = placed.select("row").join(first, "row", "left_anti").select(F.col("row").alias(own))
    return rows.join(gone, own, "left_anti").select(*docs.columns)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of Jaccard 0.8 or more."""
    return component_ids(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH RECURSIVE w AS (
  SELECT DISTINCT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), g AS (
  SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS sh FROM g
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * o >= 80 * (p.n + q.n - o)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, both_ways.y FROM reach JOIN both_ways ON both_ways.x = reach.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""
