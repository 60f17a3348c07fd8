"""Repeated strings against a table of all substrings."""

import random
from collections import Counter

import pytest
from marketloom.llm import repeats


def expected(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        covered = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        runs = bytes(covered).split(b"\0")
        out.append((len(r), sum(covered), sum(1 for run in runs if run), bytes(b for b, c in zip(r, covered, strict=True) if not c)))
    return out


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    passages = [" ".join(word() for _ in range(rng.randrange(length // 5, length))) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randrange(0, 30)))]
        for _ in range(rng.randrange(0, 3)):
            whole = rng.choice(passages)
            cut = rng.randrange(0, max(1, len(whole) // 2))
            parts += [whole[cut : cut + rng.randrange(length // 2, 3 * length)], word()]
        texts.append(" ".join(parts))
    line = "".join(rng.choice("xyz") for _ in range(length + 3))
    texts += [word() + line + word() for _ in range(30)]  # one passage, many contexts
    texts += [texts[3], texts[3], None, "", "a" * (length - 1), "a" * length, "b" * (length + 1), "ab" * length * 2, "xab" * length + "q" + "xab" * length]
    return texts + ["c" * length, "é" * length, passages[0][: 2 * length], passages[0][1 : 2 * length]]


@pytest.mark.parametrize(
    ("seed", "length", "size", "options"),
    [(1, 200, 64, {}), (2, 40, 12, {"group": 5}), (3, 40, 16, {"table": 3}), (4, 24, 24, {})],
)
def test_matches_all_substrings(spark, seed, length, size, options):
    texts = corpus(seed, length)
    docs = spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "doc_id long, text string, key string")
    out = repeats.remove(docs, length=length, size=size, **options).collect()
    got = {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in out}
    assert got == dict(enumerate(expected(texts, length)))


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "z" * 300), (1, "short")], "doc_id long, text string")
    assert repeats.remove(docs.filter("doc_id > 5")).count() == 0
    rows = {r.doc_id: r for r in repeats.remove(docs).collect()}
    assert [tuple(s) for s in rows[None].spans] == [(0, 300)] and bytes(rows[1].kept) == b"short"


def test_strips_of_offsets_change_nothing(monkeypatch):
    """Contexts unfolded one offset at a time give what they give at once."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(6)
    length, anchor = 20, b"anchorxy"
    rows = []
    for k in range(60):
        left = rng.randrange(length - len(anchor) + 1)
        context = (b"abcabcabcabc" + bytes(rng.choice(b"ab") for _ in range(3)))[-left:] if left else b""
        context += anchor + b"qrstuvwxyz12"[: rng.randrange(13)] + bytes(rng.choice(b"yz") for _ in range(2))
        rows.append((k % 2, bytes([k]) * 16, 50, left, context[: left + length]))
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], ["a", "key", "at", "left", "context"])
    whole = repeats._sorted_ends(batch, length).to_pylist()
    seen = Counter()
    for a, _, _, left, context in rows:
        seen.update((a, left - i, context[i : i + length]) for i in range(len(context) - length + 1))
    want = []
    for a, key, at, left, context in rows:
        own = [left - i for i in range(len(context) - length + 1) if seen[a, left - i, context[i : i + length]] > 1]
        if own:
            want.append({"key": key, "low": at - max(own), "high": at - min(own) + length})
    assert whole == want and np.ptp([w["high"] - w["low"] for w in want]) > 0
    monkeypatch.setattr(repeats, "STRIP", 1)
    assert repeats._sorted_ends(batch, length).to_pylist() == want
