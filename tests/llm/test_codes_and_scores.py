"""Vector codes, source divergence and language-model scores against plain versions; odd tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import divergence, language_model, queries, vector_codes
from folioflow.llm.common import table
from tests.llm import brute

VECTORS = "vec_id long, embedding array<float>, label int"


# Vector codes


def plain_codes(rows):
    """The contract, part by part and entry by entry; rows are (vec_id, vector, label)."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1]) and len(r[1]) % 16 == 0]
    width = len(good[0][1]) // 16
    parts = [[r[1][p * width : (p + 1) * width] for p in range(16)] for r in good]
    books = [[parts[k][p] for k in range(min(64, len(good)))] for p in range(16)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda part, book: min((away(part, e), i) for i, e in enumerate(book))
    for _ in range(2):
        for p in range(16):
            own = {}
            for v in parts:
                own.setdefault(best(v[p], books[p])[1], []).append(v[p])
            for i, found in own.items():
                books[p][i] = [sum(c) // len(found) for c in zip(*found)]
    final = [[best(v[p], books[p]) for p in range(16)] for v in parts]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in final]
    by_label = Counter()
    for (_, _, label), e in zip(good, errors):
        by_label[label] += e
    return Counter((i, "".join(f"{k:02x}" for _, k in f), e, by_label[label], digest) for (i, _, label), f, e in zip(good, final, errors))


def found_codes(df):
    return Counter(tuple(r) for r in vector_codes.compressed(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def vectors_of(n, width, rng, spread=20):
    return [(i, [float(np.float32(rng.randrange(-spread, spread) / 40)) for _ in range(16 * width)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("n, width, spread", [(150, 3, 20), (40, 1, 2), (1, 2, 5), (65, 2, 1)])
def test_codes_match_plain_version(spark, n, width, spread):
    """Few distinct values make many ties, between entries and between vectors."""
    rng = random.Random(n)
    rows = vectors_of(n, width, rng, spread)
    rng.shuffle(rows)
    assert found_codes(spark.createDataFrame(rows, VECTORS).repartition(3)) == plain_codes(rows)


def test_codes_of_odd_vectors(spark):
    rng = random.Random(3)
    rows = vectors_of(70, 2, rng)
    one = rows[5][1]
    rows += [(5, one, None), (None, one, 7), (200, None, 1), (201, [float("nan")] + one[1:], 1), (202, one[:-1] + [float("-inf")], 1), (203, [None] + one[1:], 1), (204, [], 1), (205, one + one, 1), (206, one[:-1], 2)]
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("v", "code", "error", "_label", "n"):
        df = df.withColumn(name, F.lit("x"))
    assert found_codes(df) == plain_codes([r for r in rows if r[0] not in (205, 206)])
    assert vector_codes.compressed(df.limit(0)).count() == 0


def test_codes_too_large_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] * 16, 1)], VECTORS)
    with pytest.raises(Exception, match="too large"):
        vector_codes.compressed(df).collect()


def test_walk_over_trees_is_exact_and_prunes():
    rng = np.random.default_rng(5)
    points, entries = rng.integers(-100, 100, (5000, 4)), rng.integers(-100, 100, (64, 4))
    entries[9] = entries[40]
    walk = vector_codes.Assignment(vector_codes.Tree(points, vector_codes.LEAF), entries)
    away = ((points[:, None] - entries[None]) ** 2).sum(2)
    assert np.array_equal(walk.codes(), away.argmin(1))
    counts, sums = walk.sums(64)
    assert np.array_equal(counts, np.bincount(away.argmin(1), minlength=64)) and np.array_equal(sums.sum(0), points.sum(0))
    assert walk.met < 5000 * 64 / 5
    same = vector_codes.Assignment(vector_codes.Tree(np.zeros((300, 2), np.int64), 8), entries[:3, :2])
    assert len(set(same.codes())) == 1 and len(same.nodes) <= 4 and not len(same.rest[0])


# Source divergence


def plain_divergence(rows, least):
    """rows are (lang, source, text)."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for lang, source, text in rows]
    found = set()
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        groups = {}
        for d in docs:
            if d[0] == lang:
                groups.setdefault(d[1], Counter()).update(t for t in d[2] if t in kept)
        every = sum(groups.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, c in groups.items():
            parts = {"pair": [(sum(abs(share(c, t) - share(o, t)) for t in kept), name) for name, o in groups.items() if name != s]}
            parts["term"] = [(share(c, t) - share(every, t), t) for t in kept if c[t] and share(c, t) > share(every, t)]
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                found |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(items, 1) if part == "pair" or k <= 50}
    return found


def divergence_rows(rng):
    words = ["The", "the", "ÉTÉ", "été", "straße", "日本", "a1b", "x-y", "zz", "_q", "don't", "🙂", "Ω"]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", None, "ü", "c"]), " ".join(rng.choices(words, k=rng.randrange(8)))) for _ in range(400)]
    return [*rows, ("fr", "only", "un deux"), ("it", "a", None), ("it", "b", ""), *[("en", "hot", "the the the zz")] * 200]


@pytest.mark.parametrize("most_terms, terms, sources", [(10**6, 1024, 256), (4, 3, 2)])
def test_divergence_matches_plain_version(spark, monkeypatch, most_terms, terms, sources):
    """Once as in production, once with several vectorizers and blocks of few terms and sources."""
    monkeypatch.setattr(divergence, "TERMS", terms)
    monkeypatch.setattr(divergence, "SOURCES", sources)
    rows = divergence_rows(random.Random(8))
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    for name in ("words", "vector", "count", "id", "value", "block"):
        df = df.withColumn(name, F.lit(1))
    assert {tuple(r) for r in divergence.audited(df, 12, most_terms).collect()} == plain_divergence(rows, 12)
    assert divergence.audited(df.limit(0)).count() == 0


def test_divergence_shares_of_large_counts(spark):
    cases = [(0, 10, 1), (9 * 10**9 - 1, 10**13, 7), (9 * 10**9, 10**13, 7), (8 * 10**15, 8 * 10**15, 10**6), (10**14, 10**15 + 3, 12345)]
    df = spark.createDataFrame(cases, "c long, n long, v long")
    for r in df.select("*", divergence.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect():
        assert r.p == 1 + 10**9 * (r.c + 5) // (r.n + 5 * r.v)


# Language model


def tokens_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), ""]


def check_counts(docs, rows):
    """Everything but the model's score, from plain counts; returns the counts."""
    counts = Counter(t for i, text in docs if i is None or brute.bucket(i, 5) != 1 for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, text in docs:
        own = tokens_of(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        want[(i, i is not None and brute.bucket(i, 5) == 1, len(own), sum(counts[t] > 0 for t in own), n, round(base, 6) + 0.0)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0) for r in rows) == want
    return counts


@pytest.mark.parametrize("lookup", [2**18, 30, 0])
def test_language_model_counts(spark, small, monkeypatch, lookup):
    """The base score is exact whether words are looked up or joined."""
    monkeypatch.setattr(language_model, "LOOKUP", lookup)
    docs = table(spark, small, "documents")
    rows = language_model.scored(docs.repartition(3)).collect()
    check_counts([(r.doc_id, r.text) for r in docs.collect()], rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_language_model_beats_the_base_on_held_out_texts(spark):
    rows = queries.op13_language_model(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert len(rows) > 150
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 0.03 * sum(r.n_tokens for r in rows)
    assert sum(r.score > r.base_score for r in rows) > 0.85 * len(rows)


def test_language_model_odd(spark, odd_docs, no_docs):
    rows = language_model.scored(odd_docs).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check_counts(docs, rows)
    assert language_model.scored(no_docs).count() == 0
    unlearned = next(i for i in range(100) if brute.bucket(i, 5) == 1)
    only = language_model.scored(spark.createDataFrame([(unlearned, "a b")], "doc_id long, text string")).first()
    assert (only.n_tokens, only.n_known, only.train_tokens, only.base_score) == (3, 0, 0, 0.0) and abs(only.score) < 1e-6


def plain_score(model, known, codes, k):
    """The natural logarithm of token k's class and slot, feature by feature."""
    one, two = (codes[k - 1] if k else language_model.START), (codes[k - 2] if k > 1 else language_model.START)
    mixed = lambda x, salt: int(language_model._mixed(np.array([x], np.uint64), salt)[0])
    features = [mixed(one, 1 << 40), mixed(two, 2 << 40), mixed(one << 16 | two, 3 << 40)]
    rows, classes, slots = language_model.ROWS, language_model.CLASSES, language_model.SLOTS
    x = model.classes.astype(float) + sum(model.class_weights[f % rows].astype(float) for f in features)
    cls = min(codes[k] // slots, classes - 1)
    found = x[cls] - math.log(np.exp(x).sum())
    if codes[k] < language_model.MODELLED:
        y = model.slots[cls].astype(float) + sum(model.word_weights[mixed(f ^ (cls << 48), 7) % rows].astype(float) for f in features)
        found += y[codes[k] % slots] - math.log(np.exp(y).sum())
    return found


def test_language_model_scores_match_plain_version():
    rng = np.random.default_rng(4)
    n = np.sort(rng.integers(1, 500, 2500))[::-1]
    known = language_model.Vocabulary([f"w{i}" for i in range(2500)], n, int(n.sum()) + 900, 3000, 1)
    model = language_model.unigram(known)
    mass = lambda m: np.exp(m.classes[:-1, None] + m.slots)
    assert abs(mass(model).sum() + math.exp(model.classes[-1]) - 1) < 1e-4
    assert np.allclose(mass(model).ravel()[:5], (n[:5] + 0.5) / known.total, rtol=1e-4)
    codes = rng.integers(0, language_model.MODELLED + 3000, 400).astype(np.uint16)
    codes[::3] = rng.integers(0, 40, len(codes[::3]))
    starts = np.array([0, 1, 2, 150, 399])
    learner = language_model.Learner(model)
    learner.learn(codes, starts)
    found = language_model.token_scores(learner.model, codes, starts)
    for begin, end in zip(starts, [*starts[1:], 400]):
        own = [int(c) for c in codes[begin:end]]
        assert np.allclose(found[begin:end], [plain_score(learner.model, known, own, k) for k in range(len(own))], atol=1e-3)
    assert found.sum() > language_model.token_scores(model, codes, starts).sum()
    # For any history the shares of all words, those of the rest as one, add up to 1.
    alike = np.repeat(codes[None, :3], language_model.MODELLED + 1, 0)
    alike[:, 2] = np.arange(language_model.MODELLED + 1)
    shares = language_model.token_scores(learner.model, alike.ravel(), np.arange(0, alike.size, 3))[2::3]
    assert abs(np.exp(shares).sum() - 1) < 1e-3


def test_language_model_gradient():
    """A step follows the difference between what is and what the model expects."""
    known = language_model.Vocabulary(["a", "b"], np.array([5, 5]), 10, 2, 1)
    learner = language_model.Learner(language_model.unigram(known))
    codes = np.array([0, 1, 0, 1, 0, 1], np.uint16)
    learner.learn(codes, np.array([0]))
    after = learner.model.word_weights
    row = language_model._with_class(language_model.history(codes, np.array([0])), np.zeros(6, np.int64))
    assert after[row[0, 1], 1] > 0 > after[row[0, 1], 0] and learner.met[0].sum() == 18
