"""Best-fit packing of token sequences by the configuration linear program.

The program has a variable for each way to fill one sequence (a filling), and
asks that fillings cover every length as often as it occurs. Multiplicative
weights solve it: each length has a price that falls exponentially with how far
it is covered; a knapsack by dynamic programming finds the fillings of highest
price, one for each length that it has to hold; those near the highest are used
a little more, no length by more than a step a round. The prices also give a
lower bound of the program. The answer is scaled to cover all lengths and
rounded down, then fillings that still fit are taken once in the order of their
fractions. What is left is a smaller program, solved in the same way, for at
most PHASES rounds of rounding; best fit, longest first, places the last rest.
All of this works on the histogram of lengths, which has no more rows than the
capacity; pieces only get ranks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import fresh, gapless_rank, slice_key, staged, table

Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first
#: Times that the program is solved and rounded, each time for what the last rounding left.
PHASES = 3


def _knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest price that each space can hold, and the length that it takes first (-1: none)."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        n = fits[c]
        if n:
            value = best[c - lengths[:n]] + price[:n]
            k = int(value.argmax())
            if value[k] > 0:
                best[c], took[c] = value[k], k
    return best, took


def _fillings(first: np.ndarray, lengths: np.ndarray, took: np.ndarray, capacity: int) -> np.ndarray:
    """A row for each of ``first``: the counts of all lengths in the best filling that holds this one."""
    out = np.zeros((len(first), len(lengths)), dtype=np.int64)
    out[np.arange(len(first)), first] = 1
    c, live = capacity - lengths[first], np.arange(len(first))
    while len(live):
        k = took[c[live]]
        live, k = live[k >= 0], k[k >= 0]
        out[live, k] += 1
        c[live] -= lengths[k]
    return out


def fractional(
    lengths: np.ndarray, n: np.ndarray, capacity: int, rounds: int = 500, step: float = 0.05, rate: float = 40.0, near: float = 0.01, gap: float = 0.005
) -> tuple[list[tuple[np.ndarray, np.ndarray, float]], float]:
    """Fillings (lengths' indices, counts, how often each is used) that cover every length, and a lower bound of their sum.

    A round uses fillings whose price is within ``near`` of the highest, those of
    the least covered lengths first, and covers no length further by more than
    ``step``; prices fall by the factor exp(-``rate``) with each full cover. It
    ends within ``gap`` of the bound or after ``rounds``; the answer, scaled by
    the least cover, is feasible in either case.
    """
    cover, use = np.zeros(len(n)), {}
    lower, total = float((n * lengths).sum() / capacity), 0.0
    for _ in range(rounds):
        low = cover.min()
        if low and total <= low * lower * (1 + gap):
            break
        price = lengths * np.exp(-rate * (cover - low))
        best, took = _knapsack(lengths, price, capacity)
        value = best[capacity - lengths] + price
        top = value.max()
        lower = max(lower, float((n * price).sum() / top))  # no filling is priced higher, so prices / top are feasible for the dual
        chosen = np.flatnonzero(value >= (1 - near) * top)
        chosen = chosen[np.argsort(cover[chosen], kind="stable")]
        most = cover + step
        for row in _fillings(chosen, lengths, took, capacity):
            on = np.flatnonzero(row)
            k = row[on]
            more = float(((most - cover)[on] * n[on] / k).min())
            if more > 1e-9:
                cover[on] += more * k / n[on]
                total += more
                key = (on.tobytes(), k.tobytes())
                use[key] = use.get(key, 0.0) + more
    scale = cover.min() or 1.0
    found = [(np.frombuffer(on, dtype=np.int64), np.frombuffer(k, dtype=np.int64), x / scale) for (on, k), x in use.items()]
    return sorted(found, key=lambda f: -f[2]), lower


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, over counts: bins that look alike are handled together."""
    open_bins: dict[int, list[tuple[Pattern, int]]] = {}
    for length in sorted(left, reverse=True):
        m = left[length]
        while m:
            space = min((s for s in open_bins if s >= length), default=capacity)
            pattern, b = open_bins[space].pop() if space in open_bins else ((), m)
            if space in open_bins and not open_bins[space]:
                del open_bins[space]
            q = min(space // length, m)
            take = min(b, m // q)
            if pattern and b > take:
                open_bins.setdefault(space, []).append((pattern, b - take))
            open_bins.setdefault(space - q * length, []).append(((*pattern, (length, q)), take))
            m -= q * take
    return [x for group in open_bins.values() for x in group]


def rounded(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict[int, int], float]:
    """Fillings of the linear program with how many sequences take each, the counts that they leave, and the program's bound."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[x] for x in lengths], dtype=np.int64)
    plans, bound = [], 0.0
    for phase in range(PHASES):
        now = np.flatnonzero(left)
        if not len(now):
            break
        found, lower = fractional(lengths[now], left[now], capacity)
        bound = bound or lower
        least = 0.5 if phase < PHASES - 1 else 0.0
        for whole in (True, False):
            for on, k, x in found:
                at = now[on]
                times = min(int(x), int((left[at] // k).min())) if whole else int(x >= least and (left[at] >= k).all())
                if times:
                    left[at] -= times * k
                    plans.append((tuple((int(lengths[i]), int(c)) for i, c in zip(at[::-1], k[::-1])), times))
    return plans, {int(x): int(c) for x, c in zip(lengths, left) if c}, bound


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Fillings and how many sequences take each; together they hold each length as often as counted."""
    plans, left, _ = rounded(histogram, capacity)
    return plans + _best_fit(left, capacity)


def cut_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, keep_ids: bool = True) -> DataFrame:
    """Tokenised pieces: doc_id, piece, start, length, ids_crc32 and, if kept, the packed ids.

    A null text counts as empty; every document has ``end_id`` as its last id.
    A document beyond the capacity is cut into full pieces; its first piece
    takes what is left over. Rows of equal doc_id are separate documents.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from readloom.llm.tokens import encoder

        model, tail = encoder(path), np.array([end_id], dtype="<u4").tobytes()
        for pdf in batches:
            rows = []
            for doc, ids in zip(pdf["doc_id"].tolist(), model.ids(pdf["text"].tolist())):
                ids += tail
                n = len(ids) // 4
                first = n % capacity or capacity
                for k, start in enumerate([0, *range(first, n, capacity)]):
                    stop = first if k == 0 else start + capacity
                    part = ids[4 * start : 4 * stop]
                    rows.append((doc, k, start, stop - start, zlib.crc32(part), part if keep_ids else None))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out if keep_ids else out.drop(columns="ids")

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return docs.select("doc_id", "text").mapInPandas(cut, schema)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset, in place of columns so named, to pieces (doc_id, piece, length up to ``capacity``, more).

    ``pieces`` must give the same rows whenever it is read (staged). The driver
    sees the histogram alone, of at most ``capacity`` rows. No pieces give no rows.
    """
    pieces = pieces.drop("sequence_id", "offset")
    histogram = {int(r.length): r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    runs, next_id, at = [], 0, dict.fromkeys(histogram, 0)
    for pattern, times in plan(histogram, capacity):
        offset = 0
        for length, k in pattern:
            for _ in range(k):
                runs.append((length, at[length], next_id, offset))
                at[length] += times
                offset += length
        next_id += times
    runs.sort()
    keys = np.array([(length << 44) + rank for length, rank, _, _ in runs], dtype=np.int64)
    rank0, seq, off = (np.array([r[k] for r in runs], dtype=np.int64) for k in (1, 2, 3))
    sent = pieces.sparkSession.sparkContext.broadcast((keys, rank0, seq, off))  # bounded by the plan's fillings

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, rank0, seq, off = sent.value
        r = rank.to_numpy(dtype=np.int64)
        k = np.searchsorted(keys, (length.to_numpy(dtype=np.int64) << 44) + r, side="right") - 1
        return pd.DataFrame({"sequence_id": seq[k] + r - rank0[k], "offset": off[k]})

    rank, own = fresh(pieces, "_rank"), fresh(pieces, "_p")
    # A length has at most 4096 slices, so the window over their counts reads 4096 rows at most.
    ranked = gapless_rank(pieces, ["length"], slice_key(F.col("doc_id"), F.col("piece")), ["doc_id", "piece"], rank)
    return ranked.withColumn(own, place("length", rank)).select(*pieces.columns, f"{own}.*")


def pack_documents(docs: DataFrame) -> DataFrame:
    """All documents in sequences of up to 1024 ids of the byte-level vocabulary, each ended by id 2."""
    import public_tokenizers

    pieces = cut_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2, keep_ids=False)
    return pack(staged(pieces, "pieces"), 1024)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Place every piece of every document."""
    return pack_documents(table(spark, sf_dir, "documents"))
