"""Class language model: base scores against counting, and gains of the classes."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from marketloom.llm import lm_scoring


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["</s>"]


def corpus(seed=1, count=300):
    """Two kinds of words alternate, so classes tell what comes next."""
    rng = random.Random(seed)
    even, odd = [f"a{k}" for k in range(30)], [f"b{k}" for k in range(30)]
    rows = [(k, " ".join(rng.choice((even, odd)[i % 2]) for i in range(rng.randrange(4, 60)))) for k in range(count)]
    return rows + [(900, None), (901, ""), (902, "only here Ä\n\x0bx"), (None, "a1 b1"), (3, "a1 b1"), (3, "a1 b1")]


@pytest.mark.parametrize("frequent", [1 << 18, 20])
def test_base_scores(spark, frequent):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, score int")
    out = lm_scoring.score(docs, frequent=frequent, core=16, classes=4, rounds=2).collect()
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    counts = Counter(t for d, text in rows if not held(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = []
    for d, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        expected.append((d, held(d), len(own), sum(counts[t] > 0 for t in own), n, round(base, 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r.score < 0 and r.perplexity > 1 for r in out)


@pytest.mark.parametrize("core", [60, 12])
def test_classes_lower_held_out_perplexity(spark, core):
    """Also where most words get their classes in sweeps."""
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    out = lm_scoring.score(docs, core=core, classes=4).filter("held_out and n_tokens > 3").collect()
    base = 10 ** -(sum(r.base_score for r in out) / sum(r.n_tokens for r in out))
    own = 10 ** -(sum(r.score for r in out) / sum(r.n_tokens for r in out))
    assert own < 0.75 * base


def test_probabilities_sum_to_one(spark):
    """Over all words that can follow, an unseen word included."""
    docs = spark.createDataFrame([(k, "a b c a b d e f") for k in range(1, 9)], "doc_id long, text string")
    trained = ["a", "b", "c", "d", "e", "f"]
    probes = [(100 + k, w) for k, w in enumerate([*trained, "unseen", ""])]
    both = docs.unionByName(spark.createDataFrame(probes, "doc_id long, text string"))
    from pyspark.sql import functions as F

    options = {"core": 3, "classes": 2, "rounds": 1, "frequent": 4}
    out = {r.doc_id: r.score for r in lm_scoring.score(both, held_out=F.col("doc_id") >= 100, **options).collect()}
    # P(start -> word -> end) over words, each divided by its class's P(end), is P(word | start).
    assert sum(10 ** out[100 + k] for k in range(7)) <= 1
    assert all(out[100 + k] < 0 for k in range(8))


@pytest.mark.parametrize("frequent", [1 << 18, 20])
def test_scores_by_hand(spark, frequent):
    """Every training word has a class, and the scores follow from classes and counting."""
    rows = [*corpus(), (5, "seldom a1 rare b2 rare"), (6, "x y z seldom"), (920, "never a1 seen b1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    options = {"core": 16, "classes": 4, "frequent": frequent}
    model = lm_scoring.train(docs.filter("crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 10 != 0").select("text"), **options)
    of = {r.word: (r.n, r.c) for r in model.words.collect()}
    train = [tokens(text) for d, text in rows if not held(d)]
    counts = Counter(t for own in train for t in own[:-1])
    assert {w: n for w, (n, _) in of.items()} == counts and {c for _, c in of.values()} <= set(range(4))
    size, kinds = Counter(), Counter(c for _, c in of.values())
    for n, c in of.values():
        size[c] += n

    def chain(own):
        return ["end", *[of.get(t, (0, 3))[1] for t in own[:-1]], "end"]

    pairs = Counter(p for own in train for p in zip(chain(own), chain(own)[1:]))
    start = Counter(a for own in train for a in chain(own)[:-1])
    expected = []
    for d, text in rows:
        own, total = tokens(text), 0.0
        for a, b in zip(chain(own), chain(own)[1:]):
            total += math.log10((pairs[a, b] + 0.1) / (start[a] + 0.1 * 5))
        for t in own[:-1]:
            n, c = of.get(t, (0, 3))
            total += math.log10((n + 0.1) / (size[c] + 0.1 * (kinds[c] + 1)) if c == 3 else n / size[c])
        expected.append((d, round(total, 6)))
    got = [(r.doc_id, round(r.score, 6)) for r in lm_scoring.score(docs, **options).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_sweep_by_hand(spark):
    """Words outside the core go to the class that their neighbours in the core make likeliest."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choice(vocabulary[: rng.choice((10, 40))]) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    core = {w: k % 3 for k, w in enumerate(vocabulary[:10])}
    matrix = np.array([[rng.randrange(1, 50) for _ in range(5)] for _ in range(5)], dtype=float)
    names = lm_scoring.word_counts(spark.createDataFrame([(w,) for w in vocabulary], "text string"))
    hashes = {r.word: r.h for r in names.collect()}
    own = np.array([hashes[w] for w in core]).view(np.uint64)
    order = np.argsort(own)
    table = spark.sparkContext.broadcast((own[order], np.array(list(core.values()))[order], np.ones(10, dtype=bool)))
    kinds = np.array([2, 3, 1, 20])
    out = lm_scoring._moves(lm_scoring._contexts(frame, table, 4), matrix, kinds, 4).collect()
    contexts = Counter()
    for text in texts:
        line = ["<", *text.split(), "<"]
        of = [4 if w == "<" else core.get(w, 3) for w in line]
        for k in range(1, len(line) - 1):
            if line[k] not in core:
                contexts[line[k], "before", of[k - 1]] += 1
                contexts[line[k], "after", of[k + 1]] += 1
    log = np.log(matrix + 0.1)
    expected = {}
    for w in {w for w, _, _ in contexts}:
        value = [math.log(k + 1) for k in kinds]
        for to in range(4):
            for c in range(5):
                value[to] += contexts[w, "before", c] * (log[c, to] - math.log(matrix[:, to].sum() + 0.5))
                value[to] += contexts[w, "after", c] * (log[to, c] - math.log(matrix[to].sum() + 0.5))
        expected[hashes[w]] = max(range(4), key=lambda to: (round(value[to], 9), -to))
    assert {r.h: r.c for r in out} == expected and len(out) == len(expected)


def test_exchange_raises_likelihood():
    rng = np.random.default_rng(0)
    kinds = np.array([0, 1] * 10)
    pair = np.where(kinds[:, None] != kinds[None, :], 20, 1) + rng.integers(0, 3, (20, 20))
    classes = rng.integers(0, 2, 20)
    def matrix(c):
        m = np.zeros((2, 2))
        np.add.at(m, (c[:, None].repeat(20, 1), c[None, :].repeat(20, 0)), pair)
        return m
    first = lm_scoring.likelihood(matrix(classes))
    for turn in range(12):
        one_hot = np.eye(2)[classes]
        classes = lm_scoring.exchange(pair @ one_hot, pair.T @ one_hot, classes, 2, np.arange(turn % 2, 20, 2))
    assert lm_scoring.likelihood(matrix(classes)) > first
    assert len({tuple(classes[kinds == k]) for k in (0, 1)}) == 2 and len(set(classes[kinds == 0])) == 1


def test_empty_and_untrained(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lm_scoring.score(docs.filter("doc_id > 5")).count() == 0
    from pyspark.sql import functions as F

    row = lm_scoring.score(docs, held_out=F.lit(True)).first()
    assert (row.n_known, row.train_tokens) == (0, 0) and row.base_score == pytest.approx(3 * math.log10(0.1 / 0.1))
