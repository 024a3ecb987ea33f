"""The training-data operators against brute force, round trips and odd rows."""

import random
import struct
import zlib

import numpy as np
import pytest
from conftest import duck, same_rows
from pyspark.sql import functions as F

from readloom.llm import decontamination, jaccard, language_id, packing, preferences, quality_compression, quality_rules, registry, sharding, token_files, tokens, toxicity
from readloom.llm.wordhash import hash_words, windows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, stats string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1, 0.5, "x") for i, t in texts], DOCS)


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  two"), (None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "w " * 5000), (9, "ü é ß ЖЖ 日本 \x00 x")]


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert same_rows(registry.QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).sql(registry.ORACLE_SQL[name]).df())


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 16, 17, 300])
def test_jump_hash(spark, n):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(500, 800)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()
    assert all(r.s == jump(r.k, n) for r in got)


def test_shards_of_odd_rows(spark):
    out = sharding.assign_shards(docs_of(spark, ODD), 3).toPandas()
    assert len(out) == len(ODD) and {"score", "stats"} <= set(out.columns)
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert ((out.grown_shard == out.shard) | (out.grown_shard == 3)).all()
    assert sharding.assign_shards(docs_of(spark, []), 3).count() == 0


def naive_components(texts):
    sets = []
    for _, t in texts:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(texts) if d is not None)


@pytest.mark.parametrize("hub_pairs, first_lists", [(256, 6), (3, 1)])
def test_components_equal_brute_force(spark, monkeypatch, hub_pairs, first_lists):
    monkeypatch.setattr(jaccard, "_HUB_PAIRS", hub_pairs)
    monkeypatch.setattr(jaccard, "FIRST_LISTS", first_lists)
    rng = random.Random(5 + hub_pairs)
    texts = list(ODD)
    for k in range(12):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.choice([30, 60, 120]))]
        for c in range(40 if k == 0 else 6):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            texts.append((100 + 50 * k + c, " ".join(own)))
    got = jaccard.component_ids(docs_of(spark, texts)).where("doc_id is not null").collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == naive_components(texts)
    kept = jaccard.one_of_each(docs_of(spark, texts))
    groups = {c for d, n, c in naive_components(texts) if n}
    assert kept.count() == len(groups) + sum(not (t or "").split() for _, t in texts)
    assert kept.columns == docs_of(spark, []).columns
    assert jaccard.component_ids(docs_of(spark, [])).count() == 0


def test_components_of_null_and_repeated_ids(spark):
    rng = random.Random(8)
    texts = []
    for doc_id in (None, 7):  # a family of near copies without ids, one of a single id over different texts
        base = [f"{doc_id}w{k}" for k in range(200)]
        for c in range(150):
            own = list(base)
            own[rng.randrange(len(own))] = f"x{doc_id}{c}"
            texts.append((doc_id, " ".join(own)))
    rows = jaccard.component_ids(docs_of(spark, texts)).groupBy("doc_id", "component_id").count().collect()
    assert sorted((str(r.doc_id), str(r.component_id), r["count"]) for r in rows) == [("7", "7", 150), ("None", "None", 150)]
    assert jaccard.one_of_each(docs_of(spark, texts)).count() == 2


def test_quality_rules(spark):
    text = ["a b c d e f g h " * 3, "x\nx\ny z\n \n", "# $ word", "", None, " ".join(f"w{i}" for i in range(25))]
    out = quality_rules.with_stats(docs_of(spark, list(enumerate(text)))).orderBy("doc_id").select("stats.*").toPandas()
    assert out.n_words.tolist() == [24, 4, 3, 0, 0, 25]
    assert out.n_repeat_words.tolist() == [24, 0, 0, 0, 0, 0]
    assert out.n_dup_lines.tolist() == [0, 1, 0, 0, 0, 0]
    assert out.n_symbols.tolist() == [0, 0, 2, 0, 0, 0]
    import pandas as pd

    rng = np.random.default_rng(1)
    x = pd.DataFrame({f: rng.random(600) for f in quality_rules.FEATURES})
    bad = ((x.symbol_share > 0.8) | ((x.upper_share > 0.7) & (x.n_words < 0.5))).to_numpy()
    rules = quality_rules.learn_rules(x, bad)
    hit = np.zeros(len(x), dtype=bool)
    for r in rules:
        hit |= quality_rules._covers(r, x)
    assert (hit == bad).mean() > 0.95
    assert quality_rules.learn_rules(x, np.zeros(600, dtype=bool)) == []
    judged = quality_rules.judge(docs_of(spark, ODD), rules)
    assert judged.count() == len(ODD) and judged.where("doc_id = 1 and base_failed and not kept").count() == 1


def brute_tiles(doc, item, least):
    doc_free, item_free, total = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc_free[p + n] and item_free[q + n] and doc[p + n] == item[q + n]:
                    n += 1
                if n > best[0]:
                    best = (n, q, p)
        n, q, p = best
        if n < least:
            return total
        for k in range(n):
            doc_free[p + k] = item_free[q + k] = False
        total += n


def test_tiling_equals_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.randrange(6) for _ in range(25)]
        parts = [item[0:12], [rng.randrange(6) for _ in range(4)], item[12:25], item[3:9]]
        rng.shuffle(parts)
        doc = [w for p in parts for w in p]
        d, i = np.array(doc, dtype=np.uint64), np.array(item, dtype=np.uint64)
        a, b = windows(d, 5), windows(i, 5)
        at = [(p, q) for p in range(len(a)) for q in range(len(b)) if a[p] == b[q]]
        tiles = decontamination.tile(d, i, np.array([p for p, _ in at]), np.array([q for _, q in at]))
        assert sum(n for _, _, n in tiles) == brute_tiles(doc, item, 5)


def test_leaks_of_reordered_passages(spark):
    item = " ".join(f"T{i}" for i in range(30))
    words = item.lower().split()
    hidden = " ".join(["so"] * 9 + words[15:] + ["and"] * 9 + words[:15])
    bench = spark.createDataFrame([(1, item), (2, "too short"), (3, None), (None, item)], "item_id long, text string")
    docs = docs_of(spark, [*ODD, (50, hidden), (51, " ".join(words[:7]))])
    found = decontamination.with_leaks(docs, bench).where(F.size("leaks") > 0).select("doc_id", F.col("leaks")[0]["matched_words"]).collect()
    assert [tuple(r) for r in found] == [(50, 30)]
    said = decontamination.with_leaks(docs_of(spark, [(60, "far TOO short for it"), (61, "too very short")]), bench, into="stats").where(F.size("stats") > 0)
    assert [(r.doc_id, r.stats[0].item_id, r.stats[0].coverage) for r in said.collect()] == [(60, 2, 1.0)]
    clean = decontamination.clean_of(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(ODD) + 1
    assert decontamination.clean_of(docs, bench.limit(0)).count() == docs.count()


def test_ids_equal_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = [t for _, t in ODD if t] + ["it's DON'T", "a\n\n b", "é É", "Σας", "1234 ½²", "<|endoftext|>", " lead", "a\xa0b"]
    for f in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        m = Tokenizer.from_file(public_tokenizers.path(f))
        m.encode_special_tokens = True
        want = [np.array(e.ids, dtype="<u4").tobytes() for e in m.encode_batch(texts, add_special_tokens=False)]
        assert tokens.encoder(public_tokenizers.path(f)).ids([*texts, None]) == [*want, b""]


def test_packing(spark):
    import public_tokenizers

    pieces = packing.staged(packing.cut_pieces(docs_of(spark, ODD), public_tokenizers.path("byte_bpe_50k.json"), 64, 2), "t")
    out = packing.pack(pieces, 64).toPandas().sort_values(["sequence_id", "offset"])
    assert len(out) == pieces.count() and all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in out.itertuples())
    for _, g in out.groupby("sequence_id"):
        assert g.length.sum() <= 64 and (g.length.cumsum() - g.length).tolist() == g.offset.tolist()
    rng = random.Random(2)
    counts = {rng.randrange(1, 65): rng.randrange(1, 40) for _ in range(30)}
    plans = packing.plan(counts, 64)
    held = {}
    for pattern, times in plans:
        assert sum(x * k for x, k in pattern) <= 64
        for x, k in pattern:
            held[x] = held.get(x, 0) + k * times
    assert held == counts
    cut: dict[int, int] = {}  # pieces of 400 full bins, so 400 sequences are enough
    for _ in range(400):
        left = 64
        while left:
            x = min(left, rng.randrange(5, 40))
            cut[x] = cut.get(x, 0) + 1
            left -= x
    assert sum(t for _, t in packing.plan(cut, 64)) <= 412
    assert packing.plan({}, 64) == []


def lengths_of_documents():
    """The lengths of the pieces of all documents of sf0.01."""
    import duckdb
    import public_tokenizers

    counts = {}
    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet'").fetchall()]
    for ids in tokens.encoder(public_tokenizers.path("byte_bpe_50k.json")).ids(texts):
        n = len(ids) // 4 + 1
        for x in [n % 1024 or 1024] + [1024] * ((n - 1) // 1024):
            counts[x] = counts.get(x, 0) + 1
    return counts


@pytest.mark.parametrize("case", ["documents", "documents x 100", "all lengths"])
def test_packing_comes_from_the_program(case):
    counts = {x: 600 if 200 <= x < 420 else 20 for x in range(1, 1025)} if case == "all lengths" else lengths_of_documents()
    if case.endswith("100"):
        counts = {x: 100 * n for x, n in counts.items()}
    plans, left, bound = packing.rounded(counts, 1024)
    held, pieces = dict(left), sum(counts.values())
    for pattern, times in plans:
        assert times > 0 and sum(x * k for x, k in pattern) <= 1024
        for x, k in pattern:
            held[x] = held.get(x, 0) + k * times
    assert held == counts
    assert sum(left.values()) <= 0.1 * pieces
    assert bound >= sum(x * n for x, n in counts.items()) / 1024 - 1e-6
    assert sum(t for _, t in packing.plan(counts, 1024)) <= 1.01 * bound + 1


def test_token_file_round_trip():
    docs = [(5, b""), (None, struct.pack("<2I", 7, 8)), (5, struct.pack("<3I", 1, 2, 3))]
    w = token_files.Writer()
    for d, ids in docs:
        w.add(d, ids)
    data = w.finish()
    asked = []
    r = token_files.Reader(lambda at, size: (asked.append((at, size)), data[at : at + size])[1], len(data))
    assert [(d, r.ids(k)) for k, d in enumerate(r.doc_ids)] == docs
    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(i for _, i in docs)
    broken = bytearray(data)
    broken[int(r.starts[2]) + 8] ^= 1
    with pytest.raises(Exception):
        token_files.Reader(lambda at, size: bytes(broken[at : at + size]), len(data)).ids(2)


def test_token_files_of_odd_rows(spark):
    import public_tokenizers

    path = token_files.new_path(spark, "t")
    token_files.write_token_files(docs_of(spark, ODD), path, public_tokenizers.path("word_bpe_49k.json"), 1)
    out = token_files.with_starts(token_files.read_token_files(spark, path)).toPandas().sort_values("start")
    assert len(out) == len(ODD) and (out.start == out.n_tokens.cumsum() - out.n_tokens).all()
    some = token_files.read_token_files(spark, path, only=[8]).collect()
    assert [r.doc_id for r in some] == [8]


def test_toxicity_is_still_under_swaps(spark):
    rng = random.Random(4)
    texts, toxic = [], []
    for k in range(400):
        bad = k % 4 == 0
        words = [f"n{rng.randrange(30)}" for _ in range(15)] + (["vile"] if bad else [])
        if bad and rng.random() < 0.8 or rng.random() < 0.1:
            words.append("muslim")
        texts.append(" ".join(words).replace("n", "nn").translate(str.maketrans("0123456789", "abcdefghij")))
        toxic.append(int(bad))
    docs = docs_of(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(k, 1, t) for k, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    still = toxicity.fit_model(docs, labels)
    loose = toxicity.fit_model(docs, labels, still=0.0)
    odds = lambda m, t: np.log(m.scores([t])[0] / (1 - m.scores([t])[0]))
    gap = lambda m: abs(odds(m, "a muslim friend") - odds(m, "a hindu friend"))
    assert gap(still) < 0.3 * gap(loose)
    assert still.scores(["that is vile"])[0] > 0.5 > still.scores(["a muslim friend"])[0]
    assert toxicity.fit_model(docs, labels.limit(0)).scores(["x", None, ""]).tolist() == [0.5] * 3
    twice = toxicity.fit_model(docs.unionByName(docs), labels.unionByName(labels), max_rows=100)
    assert ((twice.scores(texts) >= 0) & (twice.scores(texts) <= 1)).all()


def inflected(n, seed, stems=("vequ", "lowi", "chón", "réê")):
    """Texts of invented words; each fourth has one of a few stems with an ending that seldom comes twice."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abdegiklmnoprstu") for _ in range(k))
    toxic = [int(k % 4 == 0) for k in range(n)]
    return [" ".join([word(rng.randrange(2, 9)) for _ in range(20)] + ([rng.choice(stems) + word(4)] if t else [])) for t in toxic], np.array(toxic)


def test_toxicity_ranks_words_by_short_stems(spark):
    texts, toxic = inflected(240, 7)
    docs = docs_of(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(k, 1, int(t)) for k, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    new, want = inflected(200, 8)
    for name in ("texts the fit has not seen", "the same, all labels turned round"):
        score = toxicity.fit_model(docs, labels).scores(new)
        above = score[want == 1][:, None] - score[want == 0][None, :]
        assert ((above > 0) + (above == 0) / 2).mean() > 0.95, name
        labels, want = labels.withColumn("toxic", 1 - labels.toxic), 1 - want


def test_toxicity_steps_end_at_the_minimum():
    """Few texts of one label, on which whole Newton steps go past the minimum and then away from it."""
    words = np.arange(60, dtype=np.uint64)
    for seed in (3, 10, 15):
        rng = np.random.default_rng(seed)
        toxic = (rng.random(80) < 0.08).astype(int)
        on = [np.flatnonzero(rng.random(60) < (0.5 if t else 0.03)) for t in toxic]
        model = toxicity.solve(words, on, toxic, [words[:1], words[1:2]])
        x = np.array([np.isin(np.arange(60), o) for o in on], dtype=float)
        miss = 1 / (1 + np.exp(-np.clip(x @ model.weights + model.intercept, -500, 500))) - toxic
        assert abs(miss.sum()) < 1e-3 and np.abs(x.T @ miss + model.weights)[2:].max() < 1e-3


def test_scores_of_odd_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, ODD)
    for module, model in ((toxicity, toxicity.fit_model(docs, labels)), (quality_compression, quality_compression.fit(docs, labels))):
        out = module.score(docs, model)
        assert out.count() == len(ODD) and out.where("score between 0 and 1 and predicted in (0, 1)").count() == len(ODD)


def test_compression_tells_texts_apart():
    rng = random.Random(6)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60)) for _ in range(60)]
    bad = [" ".join(rng.choice(["zz##", "$$qq", "%%&&", "**!!"]) for _ in range(60)) for _ in range(60)]
    d = [quality_compression._dictionary([b for t in x[:40] for b in quality_compression.blocks_of(t, 64)], 4096) for x in (good, bad)]
    x = quality_compression.differences([*good[40:], *bad[40:], "", None], *d)
    assert x[:20].min() > x[20:40].max() and x[40] == x[41] == 0


def all_segmentations(word, p, floor):
    """The exact sum over all ways to write the word, in fractions."""
    from fractions import Fraction

    w, memo = "▁" + word, {0: Fraction(1)}
    for j in range(1, len(w) + 1):
        memo[j] = sum((memo[i] * Fraction(p.get(w[i:j], floor if j - i == 1 else 0)) for i in range(j)), Fraction(0))
    return memo[len(w)]


def log_of(f):
    import math

    shift = f.denominator.bit_length() - f.numerator.bit_length()
    return math.log(float(f * 2**shift)) - shift * math.log(2)


@pytest.mark.parametrize("word", ["ab", "b", "abab" * 30, "xyz" * 50, "q" * 400])
def test_language_forward_sums_all_segmentations(word):
    p = {"▁": 0.1, "a": 0.2, "b": 0.3, "ab": 0.05, "▁a": 0.04, "bab": 0.01}
    got = language_id.log_likelihood(word, {k: (v, v / 2) for k, v in p.items()}, 3, 2)
    want = [log_of(all_segmentations(word, {k: v / d for k, v in p.items()}, language_id._FLOOR)) for d in (1, 2)]
    assert np.allclose(got, want, rtol=1e-9)


def test_language_words_together_equal_words_alone():
    rng = random.Random(7)
    pieces = {"▁": (0.1, 0.2), "a": (0.2, 0.1), "b": (0.3, 0.1), "ab": (0.05, 0.2), "▁a": (0.04, 0.01), "bab": (0.01, 0.3), "日本": (0.1, 0.1), "ž": (0.02, 0.2)}
    model = language_id.Model(["p", "q"], [0.5, 0.5], pieces, 3)
    for n in (1, 2, 5, 30):
        words = ["".join(rng.choice("abcž日本語") for _ in range(n)) for _ in range(50)]
        assert np.allclose(model._together(words), [language_id.log_likelihood(w, pieces, 3, 2) for w in words], rtol=1e-9)
    assert language_id.Model(["p", "q"], [0.5, 0.5], {}, 1).predict(["ab cd", None, "x" * 90])[0] == ["p", "und", "p"]


def test_language_models_share_no_memory():
    texts = ["one two", "w w"]
    pieces = ["▁", "o", "n", "e", "t", "w", "one", "▁w"]
    one, two = {"one": 5, "two": 3}, {"w": 9}
    for _ in range(20):  # models that are freed may leave their address to the next
        assert language_id.fit({"en": language_id.Counter(one), "xx": language_id.Counter(two)}, pieces).predict(texts)[0] == ["en", "xx"]
        assert language_id.fit({"en": language_id.Counter(two), "xx": language_id.Counter(one)}, pieces).predict(texts)[0] == ["xx", "en"]


def test_language_of_odd_rows(spark):
    docs = docs_of(spark, ODD)
    model = language_id.fit({"en": language_id.Counter({"one": 5, "two": 3}), "xx": language_id.Counter({"w": 9})}, ["▁", "o", "n", "e", "t", "w", "one", "▁w"])
    out = {(r.doc_id, r.lang_pred) for r in language_id.predict(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (8, "xx")} <= out


def test_preferences(spark):
    turn = "array<struct<role:string,text:string>>"
    rows = [([("user", "q"), ("assistant", "a")], [("user", "q"), ("assistant", "b")]), ([("user", "q")], [("user", "q")]), ([], []), (None, [("user", "q")]), ([("user", None)], [("x", "y"), ("assistant", "z")])]
    out = preferences.format_preferences(spark.createDataFrame(rows, f"chosen {turn}, rejected {turn}")).collect()
    first = out[0]
    assert (first.n_common, first.prompt) == (1, "<|user|>\nq<|end|>\n")
    s = first.chosen_spans[0]
    assert first.chosen[s.start : s.stop] == "a<|end|>"
    assert [r.n_common for r in out] == [1, 0, 0, None, 0]


def test_word_hash_depends_on_bytes_alone():
    h, at = hash_words([b"", b"ab cd", b" \x0bab\n", b"abc"])
    assert at.tolist() == [0, 0, 2, 3, 4] and h[0] == h[2] and len(set(h.tolist())) == 3


def test_leaks_in_blocks_and_in_slices(spark, monkeypatch):
    rng = random.Random(12)
    items = [(k, " ".join(rng.choice("abcdefg") + rng.choice("xyz") for _ in range(rng.choice([3, 12, 40])))) for k in range(25)]
    texts = [(k, " ".join(rng.choice(items)[1] for _ in range(4))) for k in range(10)] + [(None, None), (11, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda: sorted((r.doc_id, [tuple(x) for x in r.leaks]) for r in decontamination.with_leaks(docs_of(spark, texts), bench).where("doc_id is not null").collect())
    whole = rows()
    assert any(x for _, x in whole)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 400)
    assert rows() == whole
    index = decontamination.Index([i for i, _ in items], [t for _, t in items], 0.4)
    docs = [hash_words([t.encode()])[0] for _, t in texts if t]
    found = [index.search(d) for d in docs]
    monkeypatch.setattr(decontamination, "SEEDS", 3)
    assert [index.search(d) for d in docs] == found


def test_columns_that_are_there_already_are_replaced(spark):
    docs = docs_of(spark, ODD).withColumns({c: F.lit("old") for c in ("shard", "slot", "grown_shard", "lang_pred", "predicted", "kept", "rule", "_row", "_k", "row", "_p", "_leaks", "_more", "_slice", "_at", "_start", "_n", "_r0", "_r1", "_RANK")})
    out = sharding.assign_shards(docs, 5)
    assert len(out.columns) == len(set(out.columns)) and out.where("shard between 0 and 4 and slot >= 0").count() == len(ODD)
    model = language_id.fit({"en": language_id.Counter({"one": 5})}, ["▁", "o", "n", "e"])
    assert language_id.predict(docs, model).where("lang_pred in ('en', 'und')").count() == len(ODD)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(jaccard.one_of_each(docs_of(spark, ODD)).collect())
    assert decontamination.clean_of(docs, spark.createDataFrame([(1, "one two")], "item_id long, text string")).columns == docs.columns
    pieces = spark.createDataFrame([(1, 0, 5, "a", "b", 1, 2), (2, 0, 7, "a", "b", 1, 2)], "doc_id long, piece int, length long, sequence_id string, offset string, _rank int, _p int")
    assert sorted((r.doc_id, r.offset) for r in packing.pack(packing.staged(pieces, "t"), 8).collect()) == [(1, 0), (2, 0)]


def test_conversations_of_odd_rows(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q"), (2, 1, "assistant", "b"), (2, 2, None, None), (3, 5, "assistant", "alone"), (3, 5, "assistant", "alone"), (None, 0, "user", "q"), (4, None, "user", "q"), (4, 1, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({"opening": F.lit(1), "i": F.lit(2), "said": F.lit("x")})
    out = {r.conv_id: r for r in preferences.format_preferences(preferences.neighbour_pairs(turns)).collect()}
    assert sorted(out) == [1, 2, 3, 4]
    assert out[3].rejected == "" and out[3].n_common == 0 and out[3].chosen.count("alone") == 2 and len(out[3].chosen_spans) == 2
    assert all(out[k].n_common == 1 and out[k].prompt == "<|user|>\nq<|end|>\n" for k in (1, 2, 4))
    assert preferences.format_preferences(preferences.neighbour_pairs(turns.limit(0))).count() == 0
