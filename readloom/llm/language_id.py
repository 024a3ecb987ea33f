"""Language by unigram piece models, summed over all segmentations.

Each language has probabilities for the pieces of one public vocabulary. The
likelihood of a word is that of all ways to write it as pieces, which a forward
pass over its letters sums; a text's is the product over its words. The
probabilities come from expectation maximisation with the backward pass.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import bounded_sample, fold, fresh, table

_WORD = re.compile(r"[^\W\d_]+")
_FLOOR = 1e-9  # of a letter that is no piece of the vocabulary
#: Letters after which the forward pass is scaled back to 1, so that no word underflows.
_SCALE_EVERY = 8
#: Words whose likelihoods a worker remembers; this bounds memory, not results. Those of up to _KEPT_LETTERS letters are
#: worked out together and remembered, as their products stay within floats; longer ones are scaled, one by one.
MAX_WORDS, _KEPT_LETTERS = 400_000, 30


def words_of(text: str | None) -> list[str]:
    """The runs of letters of the text in lower case; marks alone make no word."""
    found = _WORD.findall(text.lower()) if isinstance(text, str) else []
    return found if any(c.isalpha() for w in found for c in w) else []


def vocabulary(path: str) -> list[str]:
    """The text pieces of a sentencepiece model file; its control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def _spans(word: str, known: dict[str, tuple], longest: int) -> list[list[tuple[int, str]]]:
    """For each end, the starts and pieces that end there; a single letter always may."""
    w = "▁" + word
    out: list[list[tuple[int, str]]] = [[]]
    for j in range(1, len(w) + 1):
        here = [(i, w[i:j]) for i in range(max(0, j - longest), j) if w[i:j] in known]
        if not here or here[-1][0] != j - 1:
            here.append((j - 1, w[j - 1 : j]))
        out.append(here)
    return out


def log_likelihood(word: str, known: dict[str, tuple], longest: int, n: int) -> list[float]:
    """The log-probability of the word in each of ``n`` languages, over all segmentations.

    The forward values of the last ``longest`` letters are kept; every
    _SCALE_EVERY letters they are divided by the latest, whose logarithm is added up.
    """
    w = "▁" + word
    floor, logs = (_FLOOR,) * n, [0.0] * n
    f = [[1.0] * n]  # of the positions from ``first`` on
    first = 0
    get = known.get
    for j in range(1, len(w) + 1):
        total = [0.0] * n
        for i in range(max(0, j - longest), j):
            p = get(w[i:j])
            if p is None:
                if i < j - 1:
                    continue
                p = floor
            a = f[i - first]
            for k in range(n):
                total[k] += a[k] * p[k]
        f.append(total)
        if j % _SCALE_EVERY == 0:
            drop = max(0, len(f) - longest)
            first += drop
            f = [[v / t for v, t in zip(row, total)] for row in f[drop:]]
            for k in range(n):
                logs[k] += math.log(total[k])
    return [x + math.log(v) for x, v in zip(logs, f[-1])]


def _expect(words: Counter, p: dict[str, float], longest: int) -> Counter:
    """Expected piece counts by forward and backward passes."""
    out: Counter = Counter()
    for word, times in words.items():
        spans = _spans(word, p, longest)
        n = len(spans)
        f = [1.0] + [0.0] * (n - 1)
        for j in range(1, n):
            f[j] = sum(f[i] * p.get(s, _FLOOR) for i, s in spans[j])
        b = [0.0] * (n - 1) + [1.0]
        for j in range(n - 1, 0, -1):
            for i, s in spans[j]:
                b[i] += b[j] * p.get(s, _FLOOR)
        if f[-1] <= 0:
            continue
        for j in range(1, n):
            for i, s in spans[j]:
                if s in p:
                    out[s] += times * f[i] * p[s] * b[j] / f[-1]
    return out


@dataclass
class Model:
    langs: list[str]
    prior: list[float]
    pieces: dict[str, tuple] = field(repr=False)
    longest: int = 1

    def __post_init__(self) -> None:
        self._forget()

    def __getstate__(self) -> dict:
        """What is sent to workers: all but the words remembered."""
        return {k: v for k, v in self.__dict__.items() if k not in ("_at", "_logs", "_trie")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        self._at: dict[str, int] = {}
        self._logs = np.zeros((0, len(self.langs)))
        self._trie: tuple | None = None

    def _index(self) -> tuple:
        """The pieces as a tree of letters: sorted (node, letter) keys, the nodes they lead to, and each node's row of probabilities or -1."""
        if self._trie is None:
            ways: dict[tuple[int, str], int] = {}
            row = [-1]
            for k, piece in enumerate(self.pieces):
                at = 0
                for c in piece:
                    at, new = ways.setdefault((at, c), len(row)), len(row)
                    if at == new:
                        row.append(-1)
                row[at] = k
            keys = np.array([(node << 21) | ord(c) for node, c in ways] + [-1], dtype=np.int64)
            order = np.argsort(keys)
            p = np.array([*self.pieces.values(), (_FLOOR,) * len(self.langs)])
            self._trie = keys[order], np.array([*ways.values(), 0])[order], np.array(row), p
        return self._trie

    def _together(self, words: list[str]) -> np.ndarray:
        """log_likelihood() of words of equal length, a row each, by one forward pass over all of them."""
        keys, to, row, p = self._index()
        text = "".join("▁" + w for w in words).encode("utf-32-le", "surrogatepass")
        letters = np.frombuffer(text, dtype="<u4").reshape(len(words), -1).astype(np.int64)
        width = letters.shape[1]
        f = np.zeros((width + 1, len(words), len(self.langs)))
        f[0] = 1
        for i in range(width):
            live, node = np.arange(len(words)), np.zeros(len(words), dtype=np.int64)
            for j in range(i, min(i + self.longest, width)):
                key = (node << 21) | letters[live, j]
                k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                hit = keys[k] == key
                if j == i:  # a single letter always may be a piece; row -1 has the floor
                    f[i + 1] += f[i] * p[np.where(hit, row[to[k]], -1)]
                live, node = live[hit], to[k[hit]]
                if not len(live):
                    break
                if j > i:
                    on = row[node] >= 0
                    f[j + 1][live[on]] += f[i][live[on]] * p[row[node[on]]]
        return np.log(f[width])

    def _learn(self, words: set[str]) -> None:
        """Remember the likelihoods of short words that are not known yet."""
        by_length: dict[int, list[str]] = {}
        for w in words:
            if w not in self._at and len(w) <= _KEPT_LETTERS:
                by_length.setdefault(len(w), []).append(w)
        found = [self._logs]
        for same in by_length.values():
            for k in range(0, len(same), 20_000):
                part = same[k : k + 20_000]
                self._at.update(zip(part, range(len(self._at), len(self._at) + len(part))))
                found.append(self._together(part))
        if len(found) > 1:
            self._logs = np.concatenate(found)

    def logs(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The log-likelihoods of each whole text, or None without a letter."""
        out: list[np.ndarray | None] = []
        for start in range(0, len(texts), 500):
            counts = [Counter(words_of(t)) for t in texts[start : start + 500]]
            if len(self._at) > MAX_WORDS:
                trie = self._trie
                self._forget()
                self._trie = trie
            self._learn(set().union(*counts))
            for c in counts:
                if not c:
                    out.append(None)
                    continue
                total = np.zeros(len(self.langs))
                for w in [w for w in c if len(w) > _KEPT_LETTERS]:
                    total += c.pop(w) * np.array(log_likelihood(w, self.pieces, self.longest, len(self.langs)))
                out.append(total + np.fromiter(c.values(), dtype=float, count=len(c)) @ self._logs[[self._at[w] for w in c]] if c else total)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text (of equal ones the first in order of names) and its posterior probability."""
        langs, scores = [], []
        prior = np.log(np.array(self.prior)) if self.langs else np.zeros(0)
        for total in self.logs(texts) if self.langs else [None] * len(texts):
            if total is None:
                langs.append("und")
                scores.append(0.0)
                continue
            total = total + prior
            k = int(np.argmax(total))
            langs.append(self.langs[k])
            scores.append(float(1 / np.exp(np.clip(total - total[k], -700, 0)).sum()))
        return langs, scores


def fit(samples: dict[str, Counter], pieces: list[str], rounds: int = 3, smoothing: float = 0.05) -> Model:
    """Piece probabilities of each language from its words; words of equal texts count each time."""
    longest = max((len(p) for p in pieces), default=1)
    langs, columns, sizes = sorted(samples), [], []
    for lang in langs:
        words = samples[lang]
        p = {s: 1.0 / len(pieces) * 0.2 ** max(0, 3 - len(s)) for s in pieces}
        for _ in range(rounds):
            got = _expect(words, p, longest)
            total = sum(got.values()) + smoothing * len(pieces)
            p = {s: (got.get(s, 0.0) + smoothing) / total for s in pieces}
        columns.append(p)
        sizes.append(sum(words.values()))
    table = {s: tuple(c[s] for c in columns) for s in pieces} if langs else {}
    return Model(langs, [1.0 / len(langs)] * len(langs) if langs else [], table, longest)


def fit_model(docs: DataFrame, path: str, max_rows: int = 100, max_words: int = 50_000) -> Model:
    """Learn from at most ``max_rows`` whole texts of each language, outside the held-out fold.

    The rows are those of least salted md5 of doc_id; rows without language or
    text are left out, a repeated doc_id gives all its rows of that language.
    Words are counted by the executors; the driver gets the ``max_words`` most
    frequent ones of each language that have up to 100 letters.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), 3) != 1)).select("doc_id", "lang")
    langs = sorted(r.lang for r in known.select("lang").distinct().collect())  # as many as there are languages

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                words = {w: k for w, k in Counter(words_of(text)).items() if len(w) <= 100}
                yield pd.DataFrame({"lang": lang, "word": list(words), "n": list(words.values())})

    samples = {}
    for lang in langs:
        own = known.where(F.col("lang") == lang)
        chosen = bounded_sample(own.where("doc_id is not null"), "doc_id", max_rows, "lang").distinct()
        rows = docs.where(F.col("text").isNotNull()).select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])  # max_rows short rows
        words = rows.mapInPandas(counted, "lang string, word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        samples[lang] = Counter({r.word: r.n for r in words.orderBy(F.desc("n"), "word").limit(max_words).collect()})
    return fit(samples, vocabulary(path))


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and its posterior probability, score, for the whole text, in place of columns so named.

    A null text and one without letters get ``und`` and 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def of(s: pd.Series) -> pd.DataFrame:
        langs, scores = sent.value.predict(s.tolist())
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    own = fresh(docs, "_p")
    return docs.withColumn(own, of(F.col(text).cast("string"))).select(*[c for c in docs.columns if c not in ("lang_pred", "score")], f"{own}.*")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    """Predict the language of every document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    model = fit_model(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
