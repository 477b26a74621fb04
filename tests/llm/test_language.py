"""Language model, source divergence and fill-in-the-middle against plain versions of themselves."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cloakwork.llm import divergence, language, middles
from cloakwork.llm.common import word_lists

BLANK = " \t\n\x0b\x0c\r"


def blank_words(text):
    return [w for w in re.split(f"[{BLANK}]+", text or "") if w]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_word_lists_cut_between_words():
    rnd = random.Random(4)
    for size in (1, 5, 64, 1000):
        text = "".join(rnd.choices("abÄ😀 \t\n\x0b ", k=400))
        got = [w.decode() for part in word_lists(text, size) for w in part]
        assert got == blank_words(text)


# -- 11: language model ---------------------------------------------------------------


def tokens(text):
    return [*blank_words(lowered(text)), "\n"]


def ones_of(counts):
    return [sum(c == i for c in counts) for i in (1, 2, 3, 4)]


def brute_model(texts, order):
    """p(word, context) by dictionaries; contexts are tuples, the start is None."""
    grams = [Counter() for _ in range(order + 1)]
    for text in texts:
        row = [None] * (order - 1) + tokens(text)
        for i in range(order - 1, len(row)):
            for k in range(1, order + 1):
                grams[k][tuple(row[i - k + 1 : i + 1])] += 1
    a = {order: grams[order]}
    for k in range(order - 1, 0, -1):
        a[k] = Counter(g[1:] for g in grams[k + 1])
    discount = {k: (0.0, *language.discounts(ones_of(a[k].values()))) for k in a}
    sums = {k: defaultdict(list) for k in a}
    for k in a:
        for g, c in a[k].items():
            sums[k][g[:-1]].append(c)

    def p(word, context):
        if not a[order]:
            return 1.0
        k = len(context) + 1
        low = 1.0 / (len(grams[1]) + 1) if k == 1 else p(word, context[1:])
        counts = sums[k].get(context)
        if not counts:
            return low
        spare = sum(discount[k][min(c, 3)] for c in counts)
        c = a[k].get((*context, word), 0)
        return (c - discount[k][min(c, 3)] + spare * low) / sum(counts)

    return p, grams[1]


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("chunk, shard, span", [(7, 8, 5), (50, 16, 1000), (1 << 19, 1 << 20, 1 << 18)])
def test_language_model(spark, monkeypatch, order, chunk, shard, span):
    if order == 4 and chunk == 50:
        return
    monkeypatch.setattr(language, "CHUNK", chunk)
    monkeypatch.setattr(language, "SHARD", shard)
    monkeypatch.setattr(language, "RANGE", span)
    monkeypatch.setattr(language._chunks, "__defaults__", (chunk,))
    rnd = random.Random(order)
    words = "the cat sat on a mat Ünï x | The".split()
    texts = [" ".join(rnd.choices(words, [9, 5, 4, 3, 3, 2, 1, 1, 1, 1], k=rnd.randint(0, 25))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the cat"), (50, None), (51, ""), (52, " \n "), (52, " \n "), (53, "never seen the words " * 30), (54, "the " * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    train = docs.filter("doc_id is null or doc_id < 30 or doc_id = 54")
    model = language.fit(train, order=order)
    known = [t for i, t in rows if i is None or i < 30 or i == 54]
    p, counts = brute_model(known, order)
    got = language.score(docs.withColumn("score", F.lit("clash")), model)
    assert got.columns == ["doc_id", "text", "n_tokens", "n_known", "base_score", "score"]
    total, kinds = sum(counts.values()), len(counts)
    assert (model.tokens, model.words) == (total, kinds)
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        row = [None] * (order - 1) + tokens(r.text)
        want = sum(math.log10(p(row[i], tuple(row[i - order + 1 : i]))) for i in range(order - 1, len(row)))
        own = row[order - 1 :]
        assert r.score == pytest.approx(want, abs=1e-9)
        assert (r.n_tokens, r.n_known) == (len(own), sum(w if isinstance(w, int) else counts[(w,)] > 0 for w in own))
        assert r.base_score == pytest.approx(sum(math.log10((counts[(w,)] + 1) / (total + kinds + 1)) for w in own), abs=1e-9)


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b b a"), (3, "a")], "doc_id long, text string")
    model = language.fit(docs)
    words = ["a", "b", "c", "\n", "never"]
    for context in (["a"], ["b"], ["never"], []):
        asked = spark.createDataFrame([(i, " ".join([*context, w])) for i, w in enumerate(words[:3] + words[4:])], "doc_id long, text string")
        # the score of a text without its end: all texts share context and unknown word alike
        p, _ = brute_model(["a b a c", "b b a", "a"], 2)
        before = (context[-1],) if context else (None,)
        assert sum(p(w, before) for w in words) == pytest.approx(1.0)
        assert language.score(asked, model).count() == len(words) - 1


def test_language_model_of_nothing(spark, messy, empty):
    model = language.fit(empty)
    assert (model.tokens, model.words) == (0, 0)
    got = language.score(messy, model).collect()
    assert all(r.score == 0.0 and r.base_score == 0.0 and r.n_known == 0 for r in got)
    assert language.score(empty, language.fit(messy)).count() == 0
    assert language.score(messy, language.fit(messy)).count() == messy.count()


def test_held_out(spark):
    rows = [(i,) for i in range(-3, 60)] + [(None,)]
    got = spark.createDataFrame(rows, "doc_id long").withColumn("h", language.held_out()).collect()
    for r in got:
        text = "" if r.doc_id is None else str(r.doc_id)
        assert r.h == (zlib.crc32(text.encode()) % 7 == 2)


def test_mix_is_a_bijection():
    x = np.random.default_rng(1).integers(0, 1 << 63, 10_000).astype(np.uint64) * np.uint64(2)
    assert (language.unmix(language.mix(x)) == x).all()
    block = language.packed(x, np.zeros(10_000), np.arange(10_000))
    assert all((a == b).all() for a, b in zip(language.unpacked(block, 3), (x, np.zeros(10_000), np.arange(10_000)), strict=True))


def test_held_out_text_is_likelier_than_shuffled_text(spark, sf):
    """The model knows the order of words: a held-out text beats its own words in random order."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    model = language.fit(docs.filter(~language.held_out()))
    held = docs.filter(language.held_out()).filter("length(text) > 200")
    mixed = held.withColumn("text", F.array_join(F.shuffle(F.split("text", " "), 7), " "))
    a, b = (language.score(d, model).agg(F.sum("score"), F.sum("base_score")).first() for d in (held, mixed))
    assert a[0] > b[0] and a[0] > a[1]


# -- 12: divergence -------------------------------------------------------------------


def brute_divergence(rows, least=10, top=10):
    """rows: (lang, source, text)"""
    data = [(a or "", b or "", re.findall(divergence.TERM, lowered(t))) for a, b, t in rows]
    out = []
    for lang in {d[0] for d in data}:
        mine = [d for d in data if d[0] == lang]
        docs = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in docs.items() if n >= least)
        sources = sorted({d[1] for d in mine}, key=str.encode)
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in set(kept)) for s in sources}
        whole = sum(count.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(sum(f(share(count[s], t), share(count[o], t)) for t in kept), o) for o in sources if o != s]
            terms = [(f(share(count[s], t), share(whole, t)), t) for t in kept if count[s][t] and share(count[s], t) > share(whole, t)]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(ranked, 1) if part == "pair" or i <= top]
    return sorted(out)


@pytest.mark.parametrize("least, held", [(3, 20), (10, 10**6), (2, 1)])
def test_divergence(spark, monkeypatch, least, held):
    monkeypatch.setattr(divergence, "HELD", held)
    rnd = random.Random(least)
    words = "the The (the) the. Ünï co-op 12 a1b # can't x,y,z über 😀 ends".split()
    rows = [(rnd.choice(["en", "de", "", None]), rnd.choice(["s1", "s2", "S2", "ß", None]), " ".join(rnd.choices(words, k=rnd.randint(0, 12)))) for _ in range(150)]
    rows += [("en", "lonely", None), ("xx", "only", ""), ("xx", "other", " \t"), ("fr", "one", "mot"), *[("en", "s1", "twice twice")] * 4]
    docs = spark.createDataFrame([(*r, i, "clash") for i, r in enumerate(rows)], "lang string, source string, text string, n int, chunk string").repartition(4)
    got = divergence.audit(docs, least=least)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows, least)


def test_divergence_of_messy_and_empty_tables(messy, empty):
    rows = [(r.lang, r.source, r.text) for r in messy.collect()]
    assert sorted(map(tuple, divergence.audit(messy, least=2).collect())) == brute_divergence(rows, 2)
    assert divergence.audit(empty).count() == 0


# -- 13: fill-in-the-middle -----------------------------------------------------------


def brute_middle(key, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h4 % 100 < 20 else "psm", len(p), len(m), out


def test_block_tree():
    rnd = random.Random(1)
    for _ in range(1500):
        text = "".join(rnd.choices("aBc .é😀\n", k=rnd.randint(0, 60)))
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        for block in (1, 2, 7, 16):
            tree = middles.BlockTree(text, block)
            assert tree.total == len(units)
            k = rnd.randint(0, len(units))
            assert tree.cut(k) == len("".join(units[:k]))


def test_slices_do_not_matter(monkeypatch):
    text = "word " * 3000 + "x" * 5000 + " é" * 700
    whole = middles.BlockTree(text)
    monkeypatch.setattr(middles, "SLICE", 1024)
    parts = middles.BlockTree(text)
    assert (whole.units, whole.points) == (parts.units, parts.points)


def test_rearranged(spark, messy, empty):
    odd = ["<", "<P", "<S", "<P><S>", "a<M>b", ">", "S>", "<<<", "\x00", " x"]
    rows = [(i, odd[i % len(odd)] + " " + odd[(i * 7) % len(odd)] if i % 3 else odd[i % len(odd)]) for i in range(300)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    for docs in (more, messy):
        got = middles.rearranged(docs.withColumn("form", F.lit("clash")).withColumn("first", F.lit(1)))
        seen = Counter()
        for r in got.withColumn("back", middles.restored()).collect():
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_middle(r.doc_id, r.text)
            assert r.back == (r.text or "") and r["first"] == 1
            seen[r.form] += 1
        assert sum(seen.values()) == docs.count() and set(seen) == {"plain", "psm", "spm"}
    assert middles.rearranged(empty).count() == 0
    other = middles.rearranged(more, seed=2, rate=100, suffix_first=0).select("form").distinct().collect()
    assert {r.form for r in other} == {"plain", "psm"}
