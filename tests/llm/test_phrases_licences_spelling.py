"""Phrases, licences and spelling variants against plain Python on odd rows, empty tables and clashing columns."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from test_llm import DOCS, ODD, docs_of

from readloom.llm import collocations, licences, quality_rules, spelling, tokens


def odd_docs(spark, texts, langs=("en", None, "de")):
    return spark.createDataFrame([(i, t, langs[k % len(langs)], "s", 1, 0.5, "x") for k, (i, t) in enumerate(texts)], DOCS)


def brute_phrases(rows, longest, least, top):
    f, total, lower = defaultdict(Counter), Counter(), {c: c + 32 for c in range(65, 91)}
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        kept = [p for p in cands if not any(cands[q] >= cands[p] and inside(p, q) for q in cands)]
        rows = []
        for p in kept:
            score, k = min((1000 * cands[p] * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -cands[p], " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def test_phrases_of_odd_rows(spark):
    rng = random.Random(5)
    texts = [(k, " ".join(rng.choice(["A", "b", "c\x01", "ü", "日", "d.", "e\n", "f\t", " g"]) for _ in range(rng.choice([0, 3, 40])))) for k in range(150)] + ODD
    docs = odd_docs(spark, texts)
    got = sorted(tuple(r) for r in collocations.mined_phrases(docs, 4, 6, 30).collect())
    want = brute_phrases([(r.text, r.lang) for r in docs.collect()], 4, 6, 30)
    assert got == want and len(want) > 40
    assert collocations.mined_phrases(docs_of(spark, [])).count() == 0


def test_rare_pairs_of_frequent_words_are_not_counted_as_text(spark):
    rng = random.Random(6)
    texts = [(k, " ".join(["so far", *(f"w{rng.randrange(60)}" for _ in range(30))])) for k in range(120)]
    docs = odd_docs(spark, texts, ("en",))
    made, counts = {}, collocations._counts

    def counted(of, width, bits):
        made[width] = counts(of, width, bits).count()
        return counts(of, width, bits)

    collocations._counts = counted
    try:
        got = sorted(tuple(r) for r in collocations.mined_phrases(docs, 3, 20, 30).collect())
    finally:
        collocations._counts = counts
    assert got == brute_phrases([(t, "en") for _, t in texts], 3, 20, 30) and [r[2] for r in got] == ["so far"]
    assert made == {1: 62, 2: 1, 3: 0}


def brute_statistics(words, texts):
    """At each word the length of the longest run ending there that stands in a text."""
    runs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    return [max((n for n in range(1, i + 2) if tuple(words[i - n + 1 : i + 1]) in runs), default=0) for i in range(len(words))]


def test_matching_statistics():
    rng = random.Random(2)
    for _ in range(60):
        templates = tuple((f"t{k}", " ".join(rng.choices("abcd", k=rng.randint(3, 12)))) for k in range(4))
        phrases = (("p", "a b"), ("q", "c c a"), ("r", "b"))
        automaton = licences.Automaton(templates, phrases)
        words = rng.choices("abcdz", k=80)
        found, matches = automaton.stream(words)
        assert sorted(found) == sorted((k, i) for k, (_, p) in enumerate(phrases) for i in range(80) if words[i : i + len(p.split())] == p.split())
        stat = brute_statistics(words, [t.split() for _, t in templates + phrases])
        ends = [i for i in range(80) if stat[i] >= licences.SHORTEST and (i == 79 or stat[i + 1] <= stat[i])]
        assert [(i, n) for i, n, _ in matches] == [(i, stat[i]) for i in ends]
        for i, n, state in matches:
            run = words[i - n + 1 : i + 1]
            places = {(t, e) for t, (_, x) in enumerate(templates) for e in range(n - 1, len(x.split())) if x.split()[e - n + 1 : e + 1] == run}
            assert set(automaton.places(state)) == places


def test_licences_of_odd_rows(spark):
    mit = dict((label, t) for label, t in licences.TEMPLATES if len(t) > 200)["mit"]
    broken = mit.replace("publish", "print").replace("free of charge", "free  of, CHARGE")
    texts = [*ODD, (20, "x " * 30000 + mit + " y" * 10), (21, broken), (22, mit[:60]), (23, "All rights\nreserved. CC-BY cc by"), (24, "Accby all rights are reserved")]
    out = {(r.doc_id, r.n_words, r.labels): r for r in licences.scan_licences(docs_of(spark, texts)).collect()}
    assert licences.scan_licences(docs_of(spark, texts)).count() == len(texts)
    by_id = {r.doc_id: r for r in out.values()}
    assert by_id[20].labels == "mit" and by_id[20].spans[0].first == 30000 and by_id[20].score == 1.0
    assert by_id[21].labels == "mit" and 0.9 < by_id[21].score < 1.0 and by_id[22].labels == "" and 0 < by_id[22].score < 0.5
    assert (by_id[23].n_base, by_id[23].first_word, by_id[23].last_word, by_id[23].base_labels) == (3, 0, 5, "cc-by,reserved")
    assert (by_id[24].n_base, by_id[24].first_word, by_id[24].score) == (0, None, 0.0)
    assert by_id[1].n_words == 0 and by_id[1].score == 0.0 and by_id[1].labels == ""
    assert licences.scan_licences(docs_of(spark, [])).count() == 0


def brute_words(rows, mod):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % mod == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_groups(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def got_groups(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def test_variants_of_odd_words(spark):
    rng = random.Random(9)
    n = {}
    for _ in range(120):
        w = "".join(rng.choices("abà", k=rng.choice([1, 2, 7, 8, 9, 16])))
        for _ in range(4):
            n[w] = rng.choice([2, 3, 25, 30, 400, 5000])
            k, how = rng.randrange(len(w)), rng.randrange(3)
            w = w[:k] + ["", rng.choice("abc"), w[k] + rng.choice("abà")][how] + w[k + 1 :] or "b"
    long = "".join(rng.choices("ab", k=300))
    n |= {long: 900, long[:10] + long[11:]: 80, long[:280] + "zz" + long[281:]: 5, "a" * 40: 7, "a" * 41: 77, "a" * 42: 777}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    assert got_groups(spelling.variant_groups(words)) == brute_groups(n)


@pytest.mark.parametrize("mod", [31, 2])
def test_variants_of_odd_rows(spark, mod):
    rng = random.Random(mod)
    texts = [(k, "".join(rng.choice(["Letters ", "lettersé ", "lettern-", "ÀÉîöûüñ,", "short ", "Zz" * 5 + "9", "x" * 9 + " "]) for _ in range(30))) for k in range(60)] + ODD
    docs = docs_of(spark, texts)
    words = spelling.varied_words(docs, mod=mod)
    assert {r.word: r.n for r in words.collect()} == brute_words(texts, mod)
    assert got_groups(spelling.variant_groups(words)) == brute_groups(brute_words(texts, mod))
    assert spelling.variant_groups(spelling.varied_words(docs_of(spark, []))).count() == 0


def test_ids_of_all_code_points():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 64 == 0)]
    got = tokens.encoder(path).ids(texts)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert all(memoryview(g).cast("I").tolist() == w.ids for g, w in zip(got, want))


def test_rules_with_one_id_in_many_rows(spark):
    docs = docs_of(spark, [(1, "some words " * 9)]).selectExpr("doc_id", "explode(array_repeat(text, 100000)) as text")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    seen = []
    learn, quality_rules.learn_rules = quality_rules.learn_rules, lambda x, bad, p: seen.append(len(bad)) or []
    try:
        quality_rules.fit_rules(docs, labels, max_rows=500)
    finally:
        quality_rules.learn_rules = learn
    assert seen == [500]  # id 1 is not held out
