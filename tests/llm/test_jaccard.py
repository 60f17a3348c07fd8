"""Jaccard join against all pairs of a small corpus."""

import random

import numpy as np
import pyarrow as pa
import pytest
from marketloom.llm import jaccard
from marketloom.llm.components import components


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(
        ((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)), key=repr
    )


def corpus(seed, count=120):
    rng = random.Random(seed)
    vocabulary = ["w%d" % k for k in range(60)]
    rows = []
    for k in range(count):
        if rows and rng.random() < 0.6:
            words = (rng.choice(rows)[1] or "x").split(" ")
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 2, 10, 40, 90]))
        rows.append((k, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, " \n"), (5, "same id other text"), (903, "One Two"), (904, "one  two"), (None, "lone text here")]


@pytest.mark.parametrize(
    ("seed", "size", "percent", "frequent", "long_list"),
    [(1, 3, 90, 1000, 2000), (2, 5, 80, 1000, 0), (3, 2, 60, 5, 0), (4, 3, 90, 1000, 10)],
)
def test_matches_all_pairs(spark, seed, size, percent, frequent, long_list):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n long")
    out = jaccard.join(docs, size=size, percent=percent, frequent=frequent, long_list=long_list)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, size, percent)


def test_many_variants_of_one_text(spark):
    """Variants with one, two and three edits, without the text itself: links go through
    common edits and through variants with fewer."""
    rng = random.Random(9)
    base = ["v%d" % k for k in range(150)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 2, 3])):
            words[rng.choice([3, 40, 77, 120, rng.randrange(150)])] = rng.choice(["edit", "e%d" % k])
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for long_list in (0, 2000):
        out = jaccard.join(docs, size=3, percent=90, long_list=long_list)
        assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, 3, 90)


def test_leader_with_shingles_of_its_own(spark):
    """A large group of near copies whose leader (the text with most copies) is itself an
    edited one: all others lack what only it has, and that must not bring them together."""
    rng = random.Random(11)
    base = ["v%d" % k for k in range(120)]
    rows = []
    for k in range(140):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            words[rng.choice([10, 30, 31, 50, 90, rng.randrange(120)])] = rng.choice(["x", "y", "e%d" % k])
        rows.append((k, " ".join(words)))
    odd = list(base)
    odd[5], odd[60], odd[100] = "only", "the", "leader"
    rows += [(200 + k, " ".join(odd)) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size, percent in ((3, 90), (5, 80), (2, 95)):
        out = jaccard.join(docs, size=size, percent=percent, long_list=0)
        assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, size, percent)


def test_members_of_one_component_are_not_compared(spark, monkeypatch):
    """Near copies that are linked already, beside texts of other sizes that hold all of their
    shingles: nothing in their common lists can still link, however long the lists are."""
    base = ["v%d" % k for k in range(100)]
    rows = [(k, " ".join([*base[:-1], "e%d" % k])) for k in range(40)]
    rows += [(100 + k, " ".join(base + ["o%d_%d" % (k, i) for i in range(150)])) for k in range(3)]
    rows.append((50, rows[0][1]))  # most documents, so others are held against it
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "_linked_by_differences", lambda *a: pytest.fail("compared around a leader"))
    out = jaccard.join(docs, size=3, percent=90, frequent=0, long_list=10)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, 3, 90)


def test_clashing_columns_pass_through(spark):
    docs = spark.createDataFrame([(2, "a b c d e f", "x"), (1, "a b c d e f", "y")], "doc_id long, text string, _gone string")
    clashing = docs.selectExpr("*", "_gone as id", "_gone as key", "_gone as component_id", "_gone as _row", "_gone as node")
    assert [tuple(r) for r in jaccard.keep_one(clashing).collect()] == [(1, "a b c d e f", *["y"] * 6)]


def test_empty_table_and_kept_rows(spark):
    docs = spark.createDataFrame([(2, "a b c d e f", "x"), (1, "a b c d e f", "y"), (3, None, None)], "doc_id long, text string, key string")
    assert jaccard.join(docs.filter("doc_id > 9")).collect() == []
    assert sorted(map(tuple, jaccard.keep_one(docs).collect())) == [(1, "a b c d e f", "y"), (3, None, None)]


def test_prefix_takes_more_where_it_is_frequent():
    tokens = np.arange(100, dtype=np.uint64)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    assert jaccard.prefix_of(tokens, *none, 90)[0] == 1
    level, prefix = jaccard.prefix_of(tokens, tokens, np.full(100, 1000), 90)
    assert level == jaccard.LONGEST and len(prefix) == 11 + level - 1


def test_prefixes_take_shingles_of_rare_words(spark):
    """Texts of a few common words share some shingles by chance; where a tenth of their
    shingles has a word of their own, prefixes hold no others, so no texts meet for nothing."""
    rng = random.Random(5)
    common = ["c%d" % k for k in range(12)]
    rows = []
    for k in range(200):
        words = rng.choices(common, k=100)
        for i, at in enumerate((9, 29, 49, 69, 89)):
            words[at] = "own%d_%d" % (k, i)
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "id long, text string").repartition(8)
    keyed = jaccard._keyed(docs, jaccard._frequent(docs, 3, 10), 3, 90)
    taken = [token for row in keyed.collect() for token in row.tokens]
    assert len(taken) == len(set(taken)) >= 200 * 9
    out = jaccard.join(docs.withColumnRenamed("id", "doc_id"), size=3, percent=90, frequent=10)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, 3, 90)


def test_words_order_the_same_shingle_alike():
    texts = pa.array(["a b c d", "x A b C", "b c", None, ""])
    hashes = np.sort(np.unique(np.concatenate([own for _, own in jaccard._words(texts)])))
    scored = list(jaccard._scored_sets(texts, 3, hashes, np.arange(len(hashes)) ** 2))
    assert [len(tokens) for tokens, _ in scored] == [2, 2, 1, 0, 0]
    assert [tokens.tolist() for tokens, _ in scored] == [tokens.tolist() for _, tokens in jaccard.shingle_sets(texts, 3)]
    first, second = (dict(zip(*map(np.ndarray.tolist, pair), strict=True)) for pair in scored[:2])
    both = first.keys() & second.keys()
    assert len(both) == 1 and all(first[token] == second[token] for token in both)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (51, 100), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    labels = {r.node: r.label for r in found.collect()}
    assert {labels[i] for i in range(41)} == {0}
    assert labels[100] == labels[51] == labels[50] == 50
