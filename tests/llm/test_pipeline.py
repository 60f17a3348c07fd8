"""The pipeline against a brute-force version of its stages."""

import re

import pytest
from marketloom.llm import mixing, pieces

import corpus_pipeline
from test_jaccard import brute as components
from test_native_operators import brute as copies

SF = "/root/testdata/sf0.001"


def test_stages_have_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns
    first = {r.doc_id for r in kept.collect()}
    words = {d: len([w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]) for d, t in rows.items()}
    assert first <= {d for d in rows if words[d] >= 50} and len(first) > 0.6 * sum(n >= 50 for n in words.values())

    unique = corpus_pipeline.exact(spark, kept, SF)
    second = {r.doc_id for r in unique.collect()}
    assert unique.columns == docs.columns
    assert second == {k for d, k, *_ in copies([(d, rows[d]) for d in first])}

    lone = corpus_pipeline.near(spark, unique, SF)
    third = {r.doc_id for r in lone.collect()}
    assert lone.columns == docs.columns
    assert third == {c for _, _, c in components([(d, rows[d]) for d in second], 5, 80)}

    mixed = corpus_pipeline.mixed(spark, lone, SF)
    assert mixed.columns == docs.columns
    taken = {r._row.doc_id: r.copies for r in mixing.copies(lone).collect()}
    got = [r.doc_id for r in mixed.collect()]
    assert {d: got.count(d) for d in taken} == taken and set(got) <= set(taken)

    out = corpus_pipeline.encoded(spark, mixed, SF).collect()
    assert len(out) == pieces.SAMPLES * len(got)
    import hashlib

    assert all(r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest() for r in out)


def test_repeated_lines_alone_reject_nothing(spark):
    prose = [f"word{k} other{k} third{k}" for k in range(30)]
    rows = [(1, "\n".join(prose + ["end"] * 15)), (2, "\n".join(["one two three four"] * 30)), (3, "\n".join(prose))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.quality(spark, docs, SF).collect()) == [1, 3]


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "n-gram Jaccard join", "mixing sources", "SentencePiece encoding",
    ]
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and len(set(out.columns)) == len(out.columns)


@pytest.mark.parametrize("step", range(5))
def test_empty_input(spark, step):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[step][1](spark, docs, SF).count() == 0
