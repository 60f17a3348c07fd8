"""Line dedup, fill-in-the-middle and source divergence against plain Python versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from marketloom.llm import divergence, fill_middle, line_dedup
from pyspark.sql import functions as F

CLASHES = ["_row", "_id", "_text", "_doc", "_hash", "_lost", "kept", "n_lines", "n", "form", "output", "term", "docs", "level", "rank"]


def frame(spark, rows):
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return made.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


# -- line dedup -----------------------------------------------------------------------------------
def brute_lines(rows, min_chars=20, min_docs=3):
    split = [((d, t or ""), (t or "").split("\n")) for d, t in rows]
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for doc, lines in split:
        for line in lines:
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    keeper = {k: max((d for d, _ in v if d is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for (doc, _), lines in split:
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


SHARED = "A line that many documents share"
LINE_ROWS = [
    (1, f"own one\n{SHARED}\nend"), (2, f"  {SHARED.upper()}\t\r\n{SHARED}"), (3, f"{SHARED}\n\n{SHARED}\n"), (4, "short line\nshort line"),
    (5, "short line"), (6, "short line"), (7, None), (8, ""), (None, f"x\n{SHARED}"), (9, "exactly twenty chars"), (10, "exactly twenty chars"),
    (11, "exactly twenty chars"), (12, "nineteen characters"), (13, "nineteen characters"), (14, "nineteen characters"),
    (15, "twice in one document only\ntwice in one document only\ntwice in one document only"), (16, "two rows with one text are one"),
    (16, "two rows with one text are one"), (17, "two rows with one text are one"), (18, "an id with other texts below\na"),
    (18, "an id with other texts below\nb"), (18, "an id with other texts below\nc"), (19, "ÄÖ stay, only ASCII is folded"),
    (20, "äö stay, only ASCII is folded"), (21, "äö stay, only ascii is folded"), (22, "🙂" * 20), (23, "🙂" * 20), (24, "🙂" * 20),
]


def test_lines_match_brute_force(spark):
    rows = LINE_ROWS + [(100 + k, "\n".join(f"line number {(k * 7 + j * j) % 23} of many lines" for j in range(9))) for k in range(30)]
    out = line_dedup.drop_shared_lines(frame(spark, [(d, t, "en", "s") for d, t in rows]))
    got = sorted(((r._row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()), key=repr)
    assert got == brute_lines(rows)
    assert out.first()._row["_text"] == "own _text"


def test_lines_of_null_ids_and_text_ids(spark):
    docs = spark.createDataFrame([(None, f"{k}\n{SHARED}") for k in range(3)], "doc_id string, text string")
    assert {r.n_dropped for r in line_dedup.drop_shared_lines(docs).collect()} == {0}
    docs = spark.createDataFrame([(k, f"{k}\n{SHARED}") for k in "abc"], "doc_id string, text string")
    assert {r._row.doc_id: r.kept for r in line_dedup.drop_shared_lines(docs).collect()} == {"a": "a", "b": "b", "c": f"c\n{SHARED}"}
    assert line_dedup.drop_shared_lines(docs.limit(0)).collect() == []


def test_lines_of_a_very_long_text(spark):
    """Half of 60,000 lines go, without work that grows with the square of the lines."""
    long = "\n".join(f"the shared line with number {k // 2}" if k % 2 else f"own {k}" for k in range(60_000))
    others = "\n".join(f"the shared line with number {k}" for k in range(30_000))
    docs = spark.createDataFrame([(1, long), (2, others), (3, others + "\n")], "doc_id long, text string")
    out = {r._row.doc_id: r for r in line_dedup.drop_shared_lines(docs).collect()}
    assert out[1].n_dropped == 30_000 and out[1].kept == "\n".join(f"own {k}" for k in range(0, 60_000, 2))
    assert out[2].kept == "" and out[3].n_dropped == 0


# -- fill in the middle ---------------------------------------------------------------------------
def brute_fill(doc, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    whole = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, form, a, b - a, whole


def fill_rows():
    rng = random.Random(3)
    odd = ["<P>", "x<S>", "<M", "<", "<<S", ">", "<P", "S>", "é", "🙂<", "́a", "<X>", "\n", "a" * 9]
    rows = [(k, "".join(rng.choices(odd[2:], k=rng.randrange(12)))) for k in range(300)]
    return [*rows, *[(900 + k, t) for k, t in enumerate(odd)], (7, "again"), (7, "again"), (None, "no id"), (None, None), (950, None), (951, "")]


def test_fill_matches_brute_force_and_restores(spark):
    rows = fill_rows()
    made = fill_middle.transform(frame(spark, [(d, t, "en", "s") for d, t in rows]))
    got = sorted((tuple(r)[:6] for r in made.collect()), key=repr)
    assert got == sorted((brute_fill(d, t) for d, t in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = fill_middle.restore(made).collect()
    assert sorted((repr(r.doc_id), r.restored) for r in back) == sorted((repr(d), t or "") for d, t in rows)
    for r in back:
        assert r.restored_sha256 == hashlib.sha256(r.restored.encode()).hexdigest()
    for r in made.collect():
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()


def test_descriptors_describe_the_output(spark):
    texts = {d: (t or "").encode() for d, t in fill_rows()}
    made = fill_middle.transform(spark.createDataFrame([(d, t) for d, t in fill_rows() if d is not None], "doc_id long, text string"))
    for r in made.filter("doc_id <> 7").collect():
        buffers = texts[r.doc_id], bytes(fill_middle.SENTINELS)
        assert b"".join(buffers[p.buffer][p.start : p.start + p.length] for p in r.pieces) == r.output.encode()


def test_fill_of_long_texts_and_empty_tables(spark):
    text = "å" * 3_000_000
    docs = spark.createDataFrame([(k, text) for k in range(3)], "doc_id long, text string")
    out = fill_middle.restore(fill_middle.transform(docs, spm_percent=100, plain_percent=0)).collect()
    assert [(r.form, r.n, r.restored == text) for r in out] == [("spm", 3_000_000, True)] * 3
    assert fill_middle.restore(fill_middle.transform(docs.limit(0))).collect() == []


def test_broken_outputs_are_refused(spark):
    for output in ("<P>a<S>b", "<S>a<P>b<M>c", "x<P>a<S>b<M>c", "<P>a<S>b<M>c<M>"):
        broken = spark.createDataFrame([(1, output, "psm")], "doc_id long, output string, form string")
        with pytest.raises(Exception, match="sentinels are not in place"):
            fill_middle.restore(broken).collect()
    plain = spark.createDataFrame([(1, "<P>a", None), (2, None, "plain")], "doc_id long, output string, form string")
    assert sorted((r.doc_id, r.restored) for r in fill_middle.restore(plain).collect()) == [(1, "<P>a"), (2, "")]


# -- source divergence ----------------------------------------------------------------------------
def brute_divergence(rows, min_docs=3, top=200):
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {x[0] for x in terms}:
        own = [x for x in terms if x[0] == lang]
        in_docs = Counter(t for *_, words in own for t in set(words))
        kept = {t for t, k in in_docs.items() if k >= min_docs}
        count = {s: Counter() for s in {x[1] for x in own}}
        for _, s, words in own:
            count[s].update(w for w in words if w in kept)
        total = sum(count.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for s in count:
            pairs = [(o, sum(f(share(count[s], t), share(count[o], t)) for t in kept)) for o in count if o != s]
            over = [(t, f(share(count[s], t), share(total, t))) for t in kept if count[s][t] and share(count[s], t) > share(total, t)]
            for part, items, most in (("pair", pairs, None), ("term", over, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:most], 1)]
    return sorted(out)


def divergence_rows(seed, count=80):
    rng = random.Random(seed)
    words = ["Alpha", "beta-gamma", "é", "ÉA", "x1y", "naïve_x", "日本", "ab", *[f"w{chr(97 + k)}" for k in range(20)]]
    weights = [30, 9, *[1 + k % 5 for k in range(len(words) - 2)]]
    rows = []
    for k in range(count):
        source = rng.choice(["hot", "hot", "b", "c", None, "Ä"])
        rows.append((k, " ".join(rng.choices(words, weights, k=rng.randrange(30))), rng.choice(["en", "de", None]), source))
    return [*rows, rows[0], (None, None, "en", "silent"), (500, "", "empty", "a"), (501, None, "empty", "b"), (502, "only once here", "lonely", "a")]


@pytest.mark.parametrize("seed", [1, 2])
def test_divergence_matches_brute_force(spark, seed):
    rows = divergence_rows(seed)
    out = divergence.audit(frame(spark, rows))
    assert sorted(map(tuple, out.select("lang", "source", "part", "item", "value", "rank").collect())) == brute_divergence(rows)
    out = divergence.audit(frame(spark, rows), min_docs=1, top=3)
    assert sorted(map(tuple, out.select("lang", "source", "part", "item", "value", "rank").collect())) == brute_divergence(rows, 1, 3)


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(frame(spark, divergence_rows(1)).limit(0)).collect() == []


@pytest.mark.parametrize(("rows", "columns"), [(256, 512), (3, 2), (1, 1)])
def test_blocked_products_count_every_pair_of_levels(rows, columns):
    rng = np.random.default_rng(5)
    entries = [(t, s, int(rng.integers(1, 4))) for t in range(40) for s in range(5) if rng.random() < 0.6]
    term, source, level = np.array(entries).T
    a, la, b, lb, n = divergence.one_hot_products(term, source, level, rows, columns)
    by_term = defaultdict(list)
    for t, s, v in entries:
        by_term[t].append((s, v))
    wanted = Counter((*x, *y) for own in by_term.values() for x in own for y in own if x[0] < y[0])
    assert dict(zip(zip(a.tolist(), la.tolist(), b.tolist(), lb.tolist(), strict=True), n.tolist(), strict=True)) == wanted


def test_shares_of_huge_counts(spark):
    row = spark.range(1).select(
        divergence.share("9000000000000000000", "9000000000000000001", "5").alias("p"), divergence.share("0", "0", "1").alias("q")
    )
    assert tuple(row.first()) == (1 + 10**9 * (9 * 10**18 + 1) // (9 * 10**18 + 6), 1 + 10**9)
