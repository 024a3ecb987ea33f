"""Quality by compression: which of two zstandard dictionaries a text fits better.

One dictionary is trained on good labelled texts, one on bad. A text is
compressed with both, in blocks short enough that the dictionary and not the
text's own past decides; the difference of the sizes over the text's length is
turned into a probability by isotonic calibration on other labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import bounded_sample, fold, table

#: Bytes that are compressed at once.
BLOCK = 512


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    cuts: np.ndarray
    values: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return calibrated(differences(texts, self.good, self.bad), self.cuts, self.values)


_packers: dict[bytes, object] = {}


def _packer(dictionary: bytes):
    import zstandard

    if dictionary not in _packers:
        if len(_packers) > 8:
            _packers.clear()
        options = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if dictionary:
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
            options["dict_data"].precompute_compress(level=3)
        _packers[dictionary] = zstandard.ZstdCompressor(**options)
    return _packers[dictionary].compress


def differences(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    """(bytes with the bad dictionary - bytes with the good one) / length; 0 for null and empty texts."""
    with_good, with_bad = _packer(good), _packer(bad)
    out = np.zeros(len(texts))
    for k, t in enumerate(texts):
        if t:
            b = t.encode("utf-8", "surrogatepass")
            blocks = [b[i : i + BLOCK] for i in range(0, len(b), BLOCK)]
            out[k] = sum(len(with_bad(x)) - len(with_good(x)) for x in blocks) / len(b)
    return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled steps of the best non-decreasing fit: least x of each step, and its smoothed rate of label 1."""
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []  # x, sum, count
    for a, b in zip(x[order], y[order]):
        if steps and steps[-1][0] == a:
            steps[-1][1] += b
            steps[-1][2] += 1
        else:
            steps.append([a, float(b), 1.0])
        while len(steps) > 1 and steps[-2][1] / steps[-2][2] >= steps[-1][1] / steps[-1][2]:
            last = steps.pop()
            steps[-1][1] += last[1]
            steps[-1][2] += last[2]
    rate = float(y.mean()) if len(y) else 0.5
    return np.array([s[0] for s in steps]), np.array([(s[1] + rate) / (s[2] + 1) for s in steps])


def calibrated(x: np.ndarray, cuts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Straight lines between the middles of the steps; 0.5 everywhere if nothing was learned."""
    return np.interp(x, cuts, np.maximum.accumulate(values)) if len(cuts) else np.full(len(x), 0.5)


def blocks_of(text: str | None, most: int) -> list[bytes]:
    """Up to ``most`` blocks of the text, evenly spread over the whole of it."""
    b = text.encode("utf-8", "surrogatepass") if text else b""
    starts = range(0, len(b), BLOCK)
    return [b[i : i + BLOCK] for i in starts[:: max(1, -(-len(starts) // most))]]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the end of the samples themselves where there are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 500, max_calibration: int = 4000, size: int = 64 << 10, max_blocks: int = 64) -> Model:
    """Learn from documents that ``labels.quality`` marks, outside the held-out fold.

    Of each label at most ``max_rows`` texts train a dictionary, with up to
    ``max_blocks`` blocks each, and at most ``max_calibration`` other rows
    calibrate: those of least salted md5 of doc_id. A repeated doc_id gives
    several rows, which count towards the same bounds. The driver gets blocks and
    differences, no texts. Without labelled rows every score is 0.5.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) != 0)).select("doc_id", "quality")
    train = known.where(fold(F.col("doc_id"), 10) < 5)
    chosen = [bounded_sample(train.where(F.col("quality") == q), "doc_id", max_rows, "dictionary") for q in (0, 1)]
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")  # 2 * max_rows short rows

    @F.pandas_udf("array<binary>")
    def blocks(s: pd.Series) -> pd.Series:
        return pd.Series([blocks_of(t, max_blocks) for t in s])

    cut = rows.select("doc_id", "quality", F.crc32(F.encode("text", "UTF-8")).alias("c"), blocks("text").alias("blocks"))
    got = bounded_sample(cut, "doc_id", 2 * max_rows, "dictionary", "quality", "c").collect()  # of max_blocks blocks each
    bad, good = (_dictionary([bytes(b) for r in got if r.quality == q for b in r.blocks], size) for q in (0, 1))
    other = bounded_sample(known.where(fold(F.col("doc_id"), 10) >= 5), "doc_id", max_calibration, "calibration")
    sent = docs.sparkSession.sparkContext.broadcast((good, bad))

    @F.pandas_udf("double")
    def of(s: pd.Series) -> pd.Series:
        return pd.Series(differences(s.tolist(), *sent.value))

    rows = docs.select("doc_id", "text").join(F.broadcast(other), "doc_id")  # max_calibration short rows
    pairs = sorted(bounded_sample(rows.select("doc_id", of("text").alias("x"), "quality"), "doc_id", max_calibration, "calibration", "x", "quality").select("x", "quality").collect())
    cuts, values = isotonic(np.array([p.x for p in pairs]), np.array([float(p.quality) for p in pairs]))
    return Model(good, bad, cuts, values)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add score (0 to 1, higher: better) of the whole text and predicted (1 from 0.3 on), in place of columns so named.

    Null and empty texts have the difference 0 and get its calibrated score.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(s: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(s.tolist()))

    return docs.withColumn("score", of(F.col(text).cast("string"))).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op1_quality_compression(spark, sf_dir: str) -> DataFrame:
    """Score every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
