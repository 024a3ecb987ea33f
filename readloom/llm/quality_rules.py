"""Learned quality rules: a decision list of threshold conjunctions.

Sequential covering in the manner of RIPPER: grow a conjunction on two thirds of
the labelled rows by FOIL's information gain, prune it on the rest, keep it if
it is precise enough, take away what it covers, and go on. The list becomes one
ordered Spark CASE expression; the first rule that holds decides.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.common import bounded_sample, fold, table
from readloom.llm.wordhash import chunks, hash_words, windows

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
REPEAT_WINDOW = 8

STATS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_digits", "n_punct", "n_distinct_words")]
)
#: The ratios that rules may test, each from the counts of one text.
FEATURES = ("n_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "punct_share", "distinct_share", "words_per_line")

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_PUNCT = b"!\"'(),-./:;?@[\\]^_`{}~"


def _repeats(words: list[bytes], h: np.ndarray) -> int:
    """Words that lie in an 8-word window that occurs twice or more in the text."""
    w = windows(h, REPEAT_WINDOW)
    if len(w) < 2:
        return 0
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(w), dtype=bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    # Equal hashes are compared as words, so the count is exact.
    seen: dict[tuple, int] = {}
    at = np.flatnonzero(hit).tolist()
    keys = [tuple(words[i : i + REPEAT_WINDOW]) for i in at] if len(at) <= 4096 else None
    if keys is None:
        ids: dict[bytes, int] = {}
        num = np.fromiter((ids.setdefault(x, len(ids)) for x in words), dtype=np.int64, count=len(words))
        span = num
        for step in (1, 2, 4):  # windows of 2, 4, 8 words, numbered exactly
            _, span = np.unique(span[:-step] * (len(words) + 1) + span[step:], return_inverse=True)
        counts = np.bincount(span)
        hit = counts[span] > 1
    else:
        for k in keys:
            seen[k] = seen.get(k, 0) + 1
        for i, k in zip(at, keys):
            hit[i] = seen[k] > 1
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    on = np.flatnonzero(hit)
    np.add.at(cover, on, 1)
    np.add.at(cover, on + REPEAT_WINDOW, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _count(b: bytes, chars: bytes) -> int:
    return len(b) - len(b.translate(None, chars))


def text_stats(text: pd.Series) -> pd.DataFrame:
    """The counts of STATS for each text; a null text counts as empty."""
    rows = np.zeros((len(text), len(STATS.names)), dtype=np.int64)
    raw = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in text]
    for first, part in chunks(raw, 1 << 16):
        h, at = hash_words(part)
        for k, b in enumerate(part):
            own = h[at[k] : at[k + 1]]
            if not len(own):
                continue
            words = b.split()
            lines = [x for x in b.split(b"\n") if x.strip()]
            points = len(text.iloc[first + k])
            rows[first + k] = (
                len(words), points - _count(b, SPACES), _count(b, SYMBOLS), len(lines) - len(set(lines)), _repeats(words, own),
                len(lines), _count(b, _UPPER), _count(b, _LOWER), _count(b, _DIGIT), _count(b, _PUNCT), len(np.unique(own)),
            )
    return pd.DataFrame(rows, columns=STATS.names)


def with_stats(docs: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """Add the struct ``into`` of counts over the whole text."""

    @F.pandas_udf(STATS)
    def stats(s: pd.Series) -> pd.DataFrame:
        return text_stats(s)

    return docs.withColumn(into, stats(F.col(text).cast("string")))


def features(stats: Column) -> dict[str, Column]:
    """The features of FEATURES as columns over a struct of counts; shares of nothing are 0."""

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))

    s = lambda n: stats[n]
    letters = s("n_upper") + s("n_lower")
    return {
        "n_words": s("n_words").cast("double"),
        "mean_word_chars": ratio(s("word_chars"), s("n_words")),
        "symbol_share": ratio(s("n_symbols"), s("word_chars")),
        "dup_line_share": ratio(s("n_dup_lines"), s("n_lines")),
        "repeat_share": ratio(s("n_repeat_words"), s("n_words")),
        "upper_share": ratio(s("n_upper"), letters),
        "digit_share": ratio(s("n_digits"), s("word_chars")),
        "punct_share": ratio(s("n_punct"), s("word_chars")),
        "distinct_share": ratio(s("n_distinct_words"), s("n_words")),
        "words_per_line": ratio(s("n_words"), s("n_lines")),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: pd.DataFrame) -> np.ndarray:
        v = x[self.feature].to_numpy()
        return v >= self.threshold if self.above else v <= self.threshold

    def column(self, feats: dict[str, Column]) -> Column:
        c = feats[self.feature]
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: pd.DataFrame) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _best_condition(x: pd.DataFrame, y: np.ndarray) -> tuple[float, Condition | None]:
    """The condition of highest FOIL gain; ties go to the earlier feature and lower threshold."""
    p0, n = int(y.sum()), len(y)
    base = math.log2(p0 / n)
    best: tuple[float, Condition | None] = (1e-9, None)
    for name in FEATURES:
        v = x[name].to_numpy()
        order = np.argsort(v, kind="stable")
        sv, pos = v[order], np.cumsum(y[order])
        last = np.flatnonzero(np.append(sv[1:] != sv[:-1], True))[:-1]
        if not len(last):
            continue
        middle = (sv[last] + sv[last + 1]) / 2
        for above in (False, True):
            p = (p0 - pos[last]) if above else pos[last]
            t = (n - last - 1) if above else last + 1
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / t) - base), -1.0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = (float(gain[k]), Condition(name, above, float(middle[k])))
    return best


def learn_rules(x: pd.DataFrame, bad: np.ndarray, min_precision: float = 0.9, max_conditions: int = 4) -> list[Rule]:
    """Ordered rules that reject, learned from features ``x`` and the flag ``bad``.

    Rows 0, 1 of every three grow a rule and row 2 prunes it, so the order of
    the rows matters and callers fix it. No bad rows, or no good ones: no rules.
    """
    rules: list[Rule] = []
    x, bad = x.reset_index(drop=True), np.asarray(bad, dtype=bool)
    prune_row = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), dtype=bool)
    while (left & bad & ~prune_row).sum() >= 3 and (left & ~bad).any():
        grow, prune = left & ~prune_row, left & prune_row
        gx, gy = x[grow], bad[grow]
        rule: Rule = ()
        while len(rule) < max_conditions and gy.any() and not gy.all():
            _, c = _best_condition(gx, gy)
            if c is None:
                break
            rule, on = (*rule, c), c.holds(gx)
            gx, gy = gx[on], gy[on]
        if not rule:
            break
        px, py = x[prune], bad[prune]

        def worth(r: Rule) -> float:
            on = _covers(r, px)
            p, n = int((on & py).sum()), int((on & ~py).sum())
            return (p - n) / (p + n) if p + n else -1.0

        cuts = [rule[:k] for k in range(len(rule), 0, -1)]
        rule = max(cuts, key=lambda r: (worth(r), -len(r)))
        on = _covers(rule, x) & left
        if (on & bad).sum() < min_precision * on.sum() or worth(rule) < 2 * min_precision - 1:
            break
        rules.append(rule)
        left &= ~on
    return rules


def rule_expression(rules: list[Rule], stats: Column) -> Column:
    """The number (from 1) of the first rule that holds, or 0, as one CASE expression."""
    feats = features(stats)
    out: Column | None = None
    for k, rule in enumerate(rules, 1):
        cond = rule[0].column(feats)
        for c in rule[1:]:
            cond = cond & c.column(feats)
        out = F.when(cond, F.lit(k)) if out is None else out.when(cond, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def fit_rules(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, min_precision: float = 0.9) -> list[Rule]:
    """Learn from the documents that ``labels.quality`` marks, outside the held-out fold.

    At most ``max_rows`` labelled rows are used, those of least salted md5 of
    their doc_id, and of the documents that have these ids again as many; only
    their counts reach the driver. Rows without a label or
    without doc_id are left out; no labelled rows give no rules.
    """
    chosen = bounded_sample(
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) != 0)).select("doc_id", "quality"),
        "doc_id", max_rows, "rules",
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # max_rows short rows
    counted = with_stats(rows)
    numbers = counted.select("doc_id", "quality", *[c.alias(n) for n, c in features(F.col("stats")).items()])
    got = bounded_sample(numbers, "doc_id", max_rows, "rules", *FEATURES).toPandas()  # a doc_id may stand in any number of rows
    got = got.sort_values(["doc_id", *FEATURES], kind="stable")
    order = got["doc_id"].map(lambda i: zlib.crc32(f"rules {i}".encode()))
    got = got.iloc[np.lexsort((got["doc_id"].to_numpy(), order.to_numpy()))] if len(got) else got
    return learn_rules(got[list(FEATURES)], got["quality"].to_numpy() == 0, min_precision)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """Add the counts, base_failed, the rule that holds (0: none) and kept.

    Null and empty texts have no words and fail the base rule. Columns of the
    names stats, base_failed, rule or kept in ``docs`` are replaced.
    """
    out = with_stats(docs.drop("base_failed", "rule", "kept"), text)
    s = F.col("stats")
    failed = (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])
    out = out.withColumn("base_failed", failed).withColumn("rule", rule_expression(rules, s))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of the learned list for every document."""
    docs = table(spark, sf_dir, "documents")
    rules = fit_rules(docs, table(spark, sf_dir, "labels"))
    base = STATS.names[:5]
    return judge(docs.select("doc_id", "text"), rules).select("doc_id", *[F.col("stats")[n].alias(n) for n in base], "base_failed", "rule", "kept")
