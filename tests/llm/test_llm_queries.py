"""Every query of the subpackage and the chain of stages, called as registered, against plain Python on small tables."""

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_llm import brute_tiles

import corpus_pipeline
from readloom.llm import language_id, packing, quality_compression, quality_rules, registry, token_files, toxicity
from readloom.llm.wordhash import hash_words

SOURCE = "/root/testdata/sf0.001"
DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("score", pa.float64()), ("leaks", pa.string())])


def tables(path, docs):
    for name in ("labels", "benchmark", "conversations"):
        t = pq.read_table(f"{SOURCE}/{name}.parquet")
        pq.write_table(t if docs else t.slice(0, 0), path / f"{name}.parquet")
    pq.write_table(pa.Table.from_pylist(docs, DOCS), path / "documents.parquet", row_group_size=64)
    return str(path)


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    """The documents of the smallest scale with odd rows: null ids, null and empty texts, copies, repeated rows and passages of the benchmark."""
    rows = [{**r, "score": 0.5, "leaks": "x"} for r in pq.read_table(f"{SOURCE}/documents.parquet").select(["doc_id", "text", "lang", "source", "n_chars"]).to_pylist()]
    item = pq.read_table(f"{SOURCE}/benchmark.parquet").column("text").to_pylist()[0]
    longest = max(rows, key=lambda r: len(r["text"] or ""))["text"]
    odd = [(900001, None), (900002, ""), (900003, " \n\t"), (None, longest), (900005, longest), (900005, longest), (900006, "so " * 30 + item), (900007, "x" * 5000), (900008, "it's  DON'T\n\n<b> ½ é z " * 40)]
    rows += [{"doc_id": i, "text": t, "lang": None, "source": None, "n_chars": None, "score": None, "leaks": None} for i, t in odd]
    return tables(tmp_path_factory.mktemp("small"), rows), rows


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    return tables(tmp_path_factory.mktemp("empty"), [])


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def ids_of(file, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(file))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def packed(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("name", [*sorted(registry.QUERIES), "pipeline"])
def test_empty_tables(spark, empty, name):
    assert {**registry.QUERIES, "pipeline": corpus_pipeline.run}[name](spark, empty).count() == 0


def multiset(rows):
    return sorted(rows, key=repr)


def test_op1(spark, small):
    sf, docs = small
    out = registry.QUERIES["op1_quality_compression"](spark, sf).collect()
    model = quality_compression.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))

    def plain(text):
        import zstandard

        b = (text or "").encode()
        if not b:
            x = 0.0
        else:
            size = lambda d: sum(len(zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, write_dict_id=False, dict_data=zstandard.ZstdCompressionDict(d)).compress(b[i : i + 512])) for i in range(0, len(b), 512))
            x = (size(model.bad) - size(model.good)) / len(b)
        return float(np.interp(x, model.cuts, np.maximum.accumulate(model.values)))

    want = [(d["doc_id"], crc(d["doc_id"]) % 5 == 0, round(plain(d["text"]), 9)) for d in docs]
    assert multiset((r.doc_id, r.held_out, round(r.score, 9)) for r in out) == multiset(want)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def test_op2(spark, small):
    sf, docs = small
    out = registry.QUERIES["op2_language_id"](spark, sf).collect()
    import public_tokenizers

    model = language_id.fit_model(spark.read.parquet(f"{sf}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
    logs = {w: np.log(np.array(p)) for w, p in model.pieces.items()}
    seen = {}

    def plain(word):  # the forward pass in logarithms, over all starts
        if word not in seen:
            w = "▁" + word
            f = [np.zeros(len(model.langs))]
            for j in range(1, len(w) + 1):
                ways = [f[i] + (logs[w[i:j]] if w[i:j] in logs else np.log(1e-9)) for i in range(max(0, j - model.longest), j) if w[i:j] in logs or i == j - 1]
                f.append(np.logaddexp.reduce(ways))
            seen[word] = f[-1]
        return seen[word]

    def lang(text):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not words:
            return "und"
        return model.langs[int(np.argmax(sum(plain(w) for w in words) + np.log(model.prior)))]

    assert multiset((r.doc_id, r.held_out, r.lang_pred) for r in out) == multiset((d["doc_id"], crc(d["doc_id"]) % 3 == 1, lang(d["text"])) for d in docs)
    right = {d["doc_id"]: d["lang"] for d in docs if d["lang"]}
    held = [r for r in out if r.held_out and r.doc_id in right and r.lang_pred != "und"]
    assert sum(right[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def leaks(text, items):
    words = [w.lower() for w in words_of(text)]
    grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    found = []
    for i, t in items:
        own = [w.lower() for w in words_of(t)]
        if any(tuple(own[k : k + 5]) in grams for k in range(len(own) - 4)):
            n = brute_tiles(words, own, 5)
            if n >= 0.4 * len(own):
                found.append((i, len(own), n))
    return found


def items_of(sf):
    return [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf}/benchmark.parquet").to_pylist()]


def test_op4(spark, small):
    sf, docs = small
    out = registry.QUERIES["op4_decontamination"](spark, sf).collect()
    want = [(d["doc_id"], *x) for d in docs for x in leaks(d["text"], items_of(sf))]
    assert any(w[0] == 900006 for w in want)
    assert multiset((r.doc_id, r.item_id, r.item_words, r.matched_words) for r in out) == multiset(want)


def check_pieces(out, docs):
    """Whether packed pieces are those of the documents, in gapless sequences, as few as the program's bound allows by a hundredth."""
    want = []
    for d, ids in zip(docs, ids_of("byte_bpe_50k.json", [d["text"] for d in docs])):
        ids = [*ids, 2]
        first = len(ids) % 1024 or 1024
        for k, start in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[start : first if k == 0 else start + 1024]
            want.append((d["doc_id"], k, start, len(part), packed(part)))
    assert multiset((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == multiset(want)
    at: dict = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 1024
    counts = pd.Series([w[3] for w in want]).value_counts().to_dict()
    _, left, bound = packing.rounded(counts, 1024)
    assert len(at) <= 1.01 * bound + 2


def test_op5(spark, small):
    sf, docs = small
    check_pieces(registry.QUERIES["op5_best_fit_packing"](spark, sf).collect(), docs)


def test_op6(spark, small):
    sf, docs = small
    out = registry.QUERIES["op6_token_files"](spark, sf).collect()
    order = sorted(zip(docs, ids_of("word_bpe_49k.json", [d["text"] for d in docs])), key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0))
    want, start = [], 0
    for d, ids in order:
        ids = [*ids, 1]
        want.append((d["doc_id"], start, len(ids), packed(ids)))
        start += len(ids)
    assert multiset((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out) == multiset(want)


def toxic_score(model, text):
    weights = dict(zip(model.words.tolist(), model.weights.tolist()))
    on = set()
    for w in set(re.findall(rb"[a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))):
        on.add(int(hash_words([w])[0][0]))
        for n in toxicity.STEMS:
            on.add(int(hash_words([w[:n]])[0][0] ^ np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))))
    odds = model.intercept + sum(weights.get(h, 0.0) for h in on)
    return float(1 / (1 + np.exp(-np.clip(odds, -30, 30))))


def toxicity_of(spark, sf):
    return toxicity.fit_model(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def test_op7(spark, small):
    sf, docs = small
    out = registry.QUERIES["op7_toxicity"](spark, sf).collect()
    model = toxicity_of(spark, sf)
    want = [(d["doc_id"], crc(d["doc_id"]) % 5 == 0, round(toxic_score(model, d["text"]), 9)) for d in docs]
    assert multiset((r.doc_id, r.held_out, round(r.score, 9)) for r in out) == multiset(want)
    assert all(r.predicted == int(r.score >= 0.5) for r in out)


def stats_of(text):
    words = words_of(text)
    spans = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {s for s in spans if spans.count(s) > 1} if len(spans) < 3000 else {s for s, n in pd.Series(spans).value_counts().items() if n > 1}
    covered = {k for i, s in enumerate(spans) if s in twice for k in range(i, i + 8)}
    lines = [x for x in (text or "").encode().split(b"\n") if words_of(x.decode("utf-8", "replace"))]
    return {
        "n_words": len(words), "word_chars": sum(len(w.decode()) for w in words), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_lines": len(lines), "n_upper": len(re.findall(r"[A-Z]", text or "")), "n_lower": len(re.findall(r"[a-z]", text or "")), "n_digits": len(re.findall(r"[0-9]", text or "")),
        "n_punct": len(re.findall(r"""[!"'(),\-./:;?@\[\\\]^_`{}~]""", text or "")), "n_distinct_words": len(set(words)),
    }


def verdicts(rules, docs):
    s = pd.DataFrame([stats_of(d["text"]) for d in docs])
    ratio = lambda a, b: np.where(s[b] > 0, s[a] / np.maximum(s[b], 1), 0.0)
    s["letters"] = s.n_upper + s.n_lower
    f = pd.DataFrame({
        "n_words": s.n_words.astype(float), "mean_word_chars": ratio("word_chars", "n_words"), "symbol_share": ratio("n_symbols", "word_chars"), "dup_line_share": ratio("n_dup_lines", "n_lines"),
        "repeat_share": ratio("n_repeat_words", "n_words"), "upper_share": ratio("n_upper", "letters"), "digit_share": ratio("n_digits", "word_chars"), "punct_share": ratio("n_punct", "word_chars"),
        "distinct_share": ratio("n_distinct_words", "n_words"), "words_per_line": ratio("n_words", "n_lines"),
    })
    hit = np.zeros(len(f), dtype=bool)
    for r in rules:
        hit |= quality_rules._covers(r, f)
    s["base_failed"] = (s.n_words < 20) | (100 * s.n_repeat_words > 30 * s.n_words)
    s["kept"] = ~s.base_failed & ~hit
    return s


def rules_of(spark, sf):
    return quality_rules.fit_rules(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def test_op9(spark, small):
    sf, docs = small
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    out = registry.QUERIES["op9_quality_rules"](spark, sf).collect()
    s = verdicts(rules_of(spark, sf), docs)
    want = [(d["doc_id"], *[x.item() for x in row]) for d, row in zip(docs, s[names].itertuples(index=False, name=None)) for row in [[np.asarray(v) for v in row]]]
    assert multiset((r.doc_id, *[r[n] for n in names]) for r in out) == multiset(want)


def one_of_each(docs):
    """The first row of each group, by doc_id with nulls last, then by place."""
    sets = []
    for d in docs:
        w = [x.lower() for x in words_of(d["text"])]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    first = {}
    for i in sorted(range(len(docs)), key=lambda i: (docs[i]["doc_id"] is None, docs[i]["doc_id"] or 0, i)):
        if sets[i]:
            first.setdefault(find(i), i)
    return [d for i, d in enumerate(docs) if not sets[i] or first[find(i)] == i]


def test_chain_of_stages(spark, small):
    sf, docs = small
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "decontamination", "packing"]
    out = corpus_pipeline.run(spark, sf).collect()
    kept = [d for d, k in zip(docs, verdicts(rules_of(spark, sf), docs).kept) if k]
    model = toxicity_of(spark, sf)
    kept = [d for d in kept if toxic_score(model, d["text"]) < 0.5]
    kept = one_of_each(kept)
    kept = [d for d in kept if not leaks(d["text"], items_of(sf))]
    assert 0 < len(kept) < len(docs)
    check_pieces(out, kept)
    odd = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", *[f"'old' as {c}" for c in ("kept", "rule", "stats", "base_failed", "predicted", "row", "_row", "_leaks")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert odd.columns == (odd := stage(spark, odd, sf)).columns and odd.where("kept <> 'old' or stats <> 'old' or row <> 'old'").isEmpty()


def test_ids_of_many_texts_equal_the_library():
    """Both vocabularies on all documents of two scales and on odd texts made at random."""
    import random

    import public_tokenizers

    from readloom.llm import tokens

    rng = random.Random(8)
    pieces = ["a", "B", "é", "İ", "ß", "Σ", "σ", " ", "  ", "\n", "\t", " ", " ", "́", "1", "23", "½", "'", "'s", "'LL", "日本", "🙂", "<|endoftext|>", "_", "-", "ЖЖ", "word", "\x00", "‍", "\r\n", ".", "…"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(3000)]
    for sf in ("sf0.001", "sf0.01"):
        texts += [t for t in pq.read_table(f"/root/testdata/{sf}/documents.parquet").column("text").to_pylist() if t]
    for file in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        want = [np.array(i, dtype="<u4").tobytes() for i in ids_of(file, texts)]
        assert tokens.encoder(public_tokenizers.path(file)).ids(texts) == want


def test_looking_at_characters_costs_less_than_encoding():
    import time
    import unicodedata

    import public_tokenizers

    from readloom.llm import tokens

    e = tokens.encoder(public_tokenizers.path("word_bpe_49k.json"))
    text = "Ciónaque dé los ñandúes für schöne Äpfel, où l’été ; " * 4000
    best = lambda f: min(f() for _ in range(3))

    def seconds(f):
        start = time.process_time()
        f()
        return time.process_time() - start

    assert e._plain(text)
    marked = tokens._mark_words(text.lower())
    assert best(lambda: seconds(lambda: e._plain(text))) < best(lambda: seconds(lambda: e._fast.encode_ordinary(marked)))
    for c in [*range(0x250), *range(0x2E70, 0x3000), 0x378, 0xD7FF, 0xE000, 0xFFFE, 0x1FAFF, 0x2FFFF, 0x10FFFF]:
        assert e._plain(f"a{chr(c)}b") <= (unicodedata.category(chr(c)) != "Cn")


def test_only_wanted_frames_are_read(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k} " * 200) for k in range(300)], "doc_id long, text string")
    import public_tokenizers

    token_files.write_token_files(docs, f"file://{tmp_path}/t", public_tokenizers.path("word_bpe_49k.json"), 1)
    (tmp_path / "t").mkdir(exist_ok=True)
    some = token_files.read_token_files(spark, f"file://{tmp_path}/t", only=[7, 250]).collect()
    assert sorted(r.doc_id for r in some) == [7, 250]
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith(".") and p.name.endswith("tmp")]
