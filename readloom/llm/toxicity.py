"""Toxicity by a linear classifier that is held still under swapped group names.

Logistic regression over the presence of words. For every labelled text that
names a group, the text with that name swapped for each other one is its
counterfactual; the squared change of the log-odds is added to the loss, so
what a text says decides, not whom it mentions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import bounded_sample, fold, staged, table
from readloom.llm.wordhash import chunks, hash_words

#: Names of groups that may be swapped for one another.
IDENTITY_TERMS = (
    "women men woman man girls boys female male gay lesbian bisexual straight transgender queer black white asian african "
    "european american latino hispanic indian chinese mexican arab jewish jews muslim muslims christian christians hindu "
    "buddhist atheist catholic immigrant immigrants refugee refugees disabled deaf blind elderly young old"
).split()
_LETTERS = bytes(c if chr(c).isalpha() and c < 128 or c >= 128 else 32 for c in range(256))


#: Stems: the first so many bytes of a word are a feature too, for languages that inflect their insults.
STEMS = (3, 4, 5, 6, 7, 8)


def word_sets(texts: list[str | None]):
    """Hashes of each text's words (runs of letters, without regard to the case of A-Z) and of their stems."""
    raw = [t.encode("utf-8", "surrogatepass").lower().translate(_LETTERS) if isinstance(t, str) else b"" for t in texts]
    for _, part in chunks(raw, 1 << 16):
        h, at = hash_words(part)
        stems = [hash_words(part, n)[0] ^ np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64)) for n in STEMS]
        for a, b in zip(at[:-1], at[1:]):
            yield np.concatenate([h[a:b], *[s[a:b] for s in stems]])


@dataclass(frozen=True)
class Model:
    """Weights by word hash (sorted) and the intercept."""

    words: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.intercept)
        for k, h in enumerate(word_sets(texts)):
            if len(h) and len(self.words):
                at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
                out[k] += self.weights[np.unique(at[self.words[at] == h])].sum()
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def prior_of(n: int, bad: int) -> float:
    """The log-odds of label 1 among ``n`` texts, with one text of each label added; 0 without texts."""
    return float(np.log((bad + 1) / (n - bad + 1)))


def z_of(n: Column, n1: Column, rows: int, bad: int) -> Column:
    """Two-proportion z of words that are in ``n`` texts, ``n1`` of them toxic."""
    p = n / rows
    return F.abs(n1 / bad - (n - n1) / (rows - bad)) / F.sqrt(p * (1 - p) * (1 / bad + 1 / (rows - bad)) + 1e-12)


def solve(words: np.ndarray, on: list[np.ndarray], toxic: np.ndarray, named: list[np.ndarray], ridge: float = 1.0, still: float = 10.0, block: int = 1000) -> Model:
    """Newton's method on the penalised loss; ``still`` weighs changes under swaps.

    ``on`` lists for each text which of ``words`` it has, ``named`` for each group
    name its word and stems. The normal equations are summed over blocks of rows;
    steps are halved until the loss falls.
    """
    y = np.asarray(toxic, dtype=float)
    width = len(words) + 1
    # A swap of one name for another changes the log-odds by the difference of what their words and stems weigh.
    slots = [np.searchsorted(words, f) for f in named]
    rows = np.zeros((len(slots), width))
    mentions = np.zeros(len(slots), dtype=np.int64)
    for k, at in enumerate(slots):
        rows[k, at] = 1
        mentions[k] = sum(bool(np.isin(at, o).all()) for o in on)
    pull = np.zeros((width, width))
    for k in np.flatnonzero(mentions):
        change = rows - rows[k]
        pull += mentions[k] * change.T @ change
    penalty = 2 * still * pull / max(len(slots) - 1, 1) + ridge * np.eye(width)
    penalty[-1, -1] = 1e-6
    theta = np.zeros(width)
    theta[-1] = prior_of(len(y), int(y.sum()))
    margins = lambda v: np.array([v[o].sum() for o in on]) + v[-1]
    loss = lambda at, odds: (np.logaddexp(0, odds) - y * odds).sum() + at @ penalty @ at / 2
    odds = margins(theta)
    for _ in range(50):
        hessian, slope = penalty.copy(), penalty @ theta
        for a in range(0, len(y), block):
            x = np.zeros((len(y[a : a + block]), width))
            x[:, -1] = 1
            for i, o in enumerate(on[a : a + block]):
                x[i, o] = 1
            q = 1 / (1 + np.exp(-np.clip(odds[a : a + block], -30, 30)))
            hessian += (x.T * (q * (1 - q))) @ x
            slope += x.T @ (q - y[a : a + block])
        step = np.linalg.solve(hessian, slope)
        # A whole step may lead past the minimum and, from there, away from it; the loss has to fall by a part of what the slope promises.
        along, have, size = margins(step), loss(theta, odds), 1.0
        while size > 1e-6 and loss(theta - size * step, odds - size * along) > have - 1e-4 * size * (slope @ step):
            size /= 2
        theta, odds = theta - size * step, odds - size * along
        if np.abs(step).max() < 1e-6 or size <= 1e-6:
            break
    return Model(words, theta[:-1], float(theta[-1]))


def _constant(rows: int, bad: int) -> Model:
    return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), prior_of(rows, bad))


def fit_model(docs: DataFrame, labels: DataFrame, max_rows: int = 8000, max_words: int = 400, terms: Sequence[str] = IDENTITY_TERMS, **options) -> Model:
    """Learn from documents that ``labels.toxic`` marks, outside the held-out fold, at most ``max_rows``.

    The rows are those of least salted md5 of doc_id; a doc_id that is repeated
    in either table gives a row for each pair, of which ``max_rows`` again are
    kept. The words are the ``max_words`` of largest two-proportion z that two rows
    or more have, counted by the executors, and all of ``terms``, the names that may be swapped. The
    driver gets those words and, for each row, the numbers of those it has.
    Without both labels (or without rows) the score is constant.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
    chosen = bounded_sample(known.select("doc_id", "toxic"), "doc_id", max_rows, "toxic")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")  # max_rows short rows
    rows = staged(rows, "toxic_rows")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            sets = [np.unique(h) for h in word_sets(pdf["text"].tolist())]
            bad = np.repeat(pdf["toxic"].to_numpy(dtype=np.int64), [len(x) for x in sets])
            word, at = np.unique(np.concatenate(sets), return_inverse=True)
            yield pd.DataFrame({"w": word.astype(np.int64), "n": np.bincount(at, minlength=len(word)), "n1": np.bincount(at, weights=bad, minlength=len(word)).astype(np.int64)})

    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("toxic").cast("long")).alias("bad")).first()
    if not total.n or not 0 < total.bad < total.n:
        return _constant(total.n, total.bad or 0)
    counts = rows.select("text", "toxic").mapInPandas(counted, "w long, n long, n1 long").groupBy("w").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    ranked = counts.where((F.col("n") >= 2) & (F.col("n") <= 0.999 * total.n)).withColumn("z", z_of(F.col("n"), F.col("n1"), total.n, total.bad)).where("z > 0")
    top = [r.w for r in ranked.orderBy(F.desc("z"), "w").limit(max_words).collect()]
    named = [np.unique(h) for h in word_sets(list(terms))]
    words = np.unique(np.concatenate([np.array(top, dtype=np.int64).astype(np.uint64), *named]))
    sent = docs.sparkSession.sparkContext.broadcast(words)  # max_words and the names

    @F.pandas_udf("array<int>")
    def numbers(s: pd.Series) -> pd.Series:
        return pd.Series([np.flatnonzero(np.isin(sent.value, h)).astype(np.int32) for h in word_sets(s.tolist())])

    found = rows.select("doc_id", "toxic", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c"), numbers("text").alias("on"))
    got = bounded_sample(found, "doc_id", max_rows, "toxic", "c", "toxic").collect()  # max_rows short arrays
    return solve(words, [np.array(r.on, dtype=np.int64) for r in got], np.array([r.toxic for r in got]), named, **options)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add score (0 to 1) of the whole text and predicted (1 from 0.5 on), in place of columns so named.

    Null and empty texts, and texts without a known word, get the intercept's score.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(s: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(s.tolist()))

    return docs.withColumn("score", of(F.col(text).cast("string"))).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit_model(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
