"""Sampled segmentations: round trips, distinctness, and their law against enumeration."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from marketloom.llm import pieces
from marketloom.llm.text_arrays import bytes_of

WORDS = pieces.vocabulary(pieces.MODEL)


def samples(texts, k, keys=None):
    data, offsets = bytes_of(pa.array(texts))
    keys = np.arange(len(texts), dtype=np.uint64) if keys is None else np.asarray(keys, np.uint64)
    found = {}
    for row, n, ids, log_p, value, inclusion in pieces.sample(WORDS, data, offsets, keys, k):
        found.setdefault(row, []).append((n, tuple(int(i) for i in ids), log_p, value, inclusion))
    return found


def text_of(ids):
    return b"".join(WORDS.surface[i] for i in ids)[1:].decode()


def every(text):
    """All segmentations with their probabilities."""
    raw = " " + text
    known = {s: (i, w) for s, i, w in zip(WORDS.surface, range(len(WORDS.surface)), _weights(), strict=True) if w is not None}

    def ways(at):
        if at == len(raw):
            yield (), 0.0
            return
        for end in range(at + 1, min(len(raw), at + WORDS.longest) + 1):
            hit = known.get(raw[at:end].encode())
            if hit is None and end == at + 1:
                one = raw[at:end].encode()
                hit = (None, WORDS.byte_weight * len(one))
                ids = tuple(int(WORDS.byte_ids[b]) for b in one)
            elif hit is None:
                continue
            else:
                ids = (hit[0],)
            for more, w in ways(end):
                yield ids + more, hit[1] + w

    found = dict(ways(0))
    total = math.log(sum(math.exp(w) for w in found.values()))
    return {ids: math.exp(w - total) for ids, w in found.items()}


def _weights():
    table = {int(i): float(w) for i, w in zip(WORDS.ids, WORDS.weights, strict=True) if i >= 0}
    return [table.get(i) for i in range(len(WORDS.surface))]


TEXTS = ["the cat", "a\n\nb  c", " é日本\x00 x", "x" * 70, "ab " * 50, "Ünïcode🙂 text.\tEnd\n", "  lead"]


def test_round_trip_and_distinct():
    for row, got in samples(TEXTS, 5).items():
        assert [n for n, *_ in got] == list(range(1, len(got) + 1))
        assert len({ids for _, ids, *_ in got}) == len(got)
        assert all(text_of(ids) == TEXTS[row] for _, ids, *_ in got)
        values = [v for *_, v, _ in got]
        assert values == sorted(values, reverse=True)
        assert all(i <= 1e-12 for *_, i in got)


def test_probabilities_match_enumeration():
    for text in ["the cat", "é a\nb"]:
        law = every(text)
        for _, ids, log_p, *_ in samples([text], 4)[0]:
            assert law[ids] == pytest.approx(math.exp(log_p), rel=1e-9)


def test_law_of_two_draws_without_replacement():
    law = every("of th")
    rounds = 4000
    got = samples(["of th"] * rounds, 2, range(rounds))
    first = Counter(got[r][0][1] for r in range(rounds))
    pairs = Counter((got[r][0][1], got[r][1][1]) for r in range(rounds))
    for ids, p in law.items():
        assert abs(first[ids] / rounds - p) < 4 * math.sqrt(p * (1 - p) / rounds) + 1e-3
    for (a, b), n in pairs.most_common(4):
        p = law[a] * law[b] / (1 - law[a])
        assert abs(n / rounds - p) < 4 * math.sqrt(p / rounds) + 1e-3


def test_inclusion_is_unbiased():
    """Each segmentation's indicator over inclusion probability has mean one."""
    law = every("of th")
    rounds, total = 3000, Counter()
    for got in samples(["of th"] * rounds, 2, range(rounds)).values():
        for _, ids, _, _, inclusion in got:
            total[ids] += 1 / math.exp(inclusion)
    for ids, p in law.items():
        if p > 0.05:
            assert total[ids] / rounds == pytest.approx(1, abs=0.15)


def test_few_segmentations_are_all_found():
    got = samples(["\x01"], 9)[0]
    assert len(got) == len(every("\x01")) and all(i == 0 for *_, i in got)


def test_batches_do_not_show():
    whole = samples(TEXTS, 3)
    for row, text in enumerate(TEXTS):
        assert [g[:2] for g in samples([text], 3, [row])[0]] == [g[:2] for g in whole[row]]


def test_encode_and_decode(spark):
    docs = spark.createDataFrame([(1, "the cat", "q"), (2, None, "q"), (3, "", "q"), (None, "a  b\n", "q"), (1, "the cat", "q")], "doc_id long, text string, ids string")
    encoded = pieces.encode(docs, samples=3)
    rows = pieces.decode(encoded).collect()
    assert len(rows) == 3 + 1 + 1 + 3 + 3
    assert sorted(map(str, rows)) == sorted(map(str, pieces.encode(docs, samples=3, decoded=True).collect()))
    texts = {1: "the cat", 2: "", 3: "", None: "a  b\n"}
    assert all(r.decoded == texts[r.doc_id] for r in rows)
    assert len({(r.sample, tuple(r.ids)) for r in rows if r.doc_id == 1}) == 3
    assert pieces.encode(docs.filter("doc_id > 9")).count() == 0
