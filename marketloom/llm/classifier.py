"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on every document, on its form (``quality``)
and on abuse (``manners``).  For either, expectation-maximisation (conditionally independent
voters, two hidden classes) estimates each voter's accuracy from the counts of vote
patterns: at most 3^voters numbers whatever the corpus, counted over all documents by Spark.
The posteriors then label a bounded sample of documents (``TRAIN_ROWS``), on which a linear
scorer over hashed words is fitted; scorer and posterior together judge every document
where it is read.

On abuse, a short English lexicon and the documents' own words vote: from a drawn sample of
labelled documents, Spark aggregates per language the words and beginnings of words that
are much more frequent among toxic ones.  A voter of either kind is silent where it knows
nothing of a document's language, and documents on which no voter speaks get the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored, unit_hash
from marketloom.llm.text_arrays import LOWER, Lookup, bytes_of, mixed, pieces, prefix_sums, span_hashes, word_hashes, word_spans

#: Expected size of the training sample, drawn by a hash of the id; what the one task that
#: fits the scorer holds is bounded by it.
TRAIN_ROWS = 20_000
FEATURES = 1 << 16
EPOCHS = 6
SEED = "weak-1"
NOTHING, BAD, GOOD = 0, 1, 2

#: Words of abuse that the lexicon voters look for, and their language.
LEXICON_LANG = b"en"
ABUSE = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")

#: Voters by what they judge, in the order of the votes.
HEADS = {
    "quality": ("length", "symbols", "capitals", "variety", "table", "shouting", "prose"),
    "manners": ("any abuse", "several words of abuse", "dense abuse", "several labelled parts", "many labelled parts"),
}
VOTERS = tuple(v for voters in HEADS.values() for v in voters)
COLUMNS = {"quality": slice(0, 7), "manners": slice(7, 12)}

#: Expected number of labelled documents drawn of either kind, toxic and clean: parts of words
#: are learned from these, and their texts and counts are all that this step handles.
LABELLED_DOCS = 5_000
#: Bytes of the beginnings of words (0: the whole word), and least rates per 1,000 words.
BEGINNINGS = (0, 4, 6, 8)
RATES = (0, 2, 4, 8)
#: A part counts as a sign of abuse in a language if at least so many, and this share, of the
#: language's toxic documents have it, with at least these log-odds against clean ones.
LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = 3, 0.02, 3.5

_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[c for c in range(128) if not chr(c).isalnum()]] = True
_LOW = np.uint64(15)  # the last bits of a part's hash number its size and rate
assert len(BEGINNINGS) * len(RATES) <= 16


def _numbered(hashes: np.ndarray, size: int, rate: int) -> np.ndarray:
    return hashes & ~_LOW | np.uint64(size * len(RATES) + rate)


def _at_rate_0(parts: np.ndarray) -> np.ndarray:
    return np.unique(parts - (parts & _LOW) % np.uint64(len(RATES)))


def _byte_share(data: np.ndarray, offsets: np.ndarray, wanted: bytes) -> np.ndarray:
    """Per row, how many of its bytes are among the wanted ones."""
    table = np.zeros(256, dtype=np.int64)
    table[np.frombuffer(wanted, np.uint8)] = 1
    return np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets])


def _abuse_hashes() -> np.ndarray:
    data, offsets = bytes_of(pa.array(ABUSE))
    return np.sort(word_hashes(data, offsets[:-1], offsets[1:]))


def _langs(column) -> np.ndarray:
    """A hash of each row's language; null is the empty one."""
    data, offsets = bytes_of(column)
    return word_hashes(data, offsets[:-1], offsets[1:])


_LEXICON_HASH = _langs(pa.array([LEXICON_LANG.decode()]))[0]


def _bare(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans and rows of the words without ASCII punctuation on either side."""
    kept = np.flatnonzero(~_PUNCTUATION[data])
    first, last = np.searchsorted(kept, starts), np.searchsorted(kept, ends) - 1
    some = first <= last
    return kept[first[some]], kept[last[some]] + 1, row[some]


def _parts(sums, starts, ends, row, langs: np.ndarray, known: Lookup | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes (of language, part and rate), each once a row, of the words' parts: at
    rate 0 those met at all, at others those met twice or more and so often per 1,000 words.
    Only those in ``known`` if given."""
    words = np.bincount(row, minlength=len(langs))
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for k, size in enumerate(BEGINNINGS):
        longer = slice(None) if not size else ends - starts > size
        own = row[longer]
        h = mixed(span_hashes(sums, starts[longer], ends[longer] if not size else starts[longer] + size) ^ langs[own])
        if known is not None:
            at = known.find(_numbered(h, k, 0))[0]  # whatever is met at a rate is met
            h, own = h[at], own[at]
        order = np.lexsort([h, own])
        h, own = h[order], own[order]
        edge = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (own[1:] != own[:-1])])) if len(h) else np.zeros(0, np.int64)
        n = np.diff(np.append(edge, len(h)))
        for r, rate in enumerate(RATES):
            enough = edge if not rate else edge[(n >= 2) & (1000 * n >= rate * words[own[edge]])]
            rows.append(own[enough])
            found.append(_numbered(h[enough], k, r))
    return np.concatenate(rows), np.concatenate(found)


@dataclass(frozen=True)
class Signs:
    """What labelled documents tell of abuse, as sorted hashes."""

    parts: np.ndarray  # of language, part and rate
    met: np.ndarray  # of the same language and part at rate 0
    langs: np.ndarray  # languages that have parts

    @staticmethod
    def none() -> Signs:
        return Signs(*[np.zeros(0, np.uint64)] * 3)


def votes(data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, signs: Signs) -> tuple[np.ndarray, tuple]:
    """Votes per row (rows x voters), and the words' rows and hashes."""
    rows = len(offsets) - 1
    lower = LOWER[data]
    starts, ends, row = word_spans(lower, offsets)
    sums = prefix_sums(lower)
    hashes = span_hashes(sums, starts, ends)
    words = np.bincount(row, minlength=rows)
    order = np.lexsort([hashes, row])
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (row[order][1:] != row[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    kinds = np.bincount(row[order][fresh], minlength=rows)
    bare = _bare(lower, starts, ends, row)
    bare_hashes = span_hashes(sums, *bare[:2])
    lexicon = _abuse_hashes()
    insult = np.isin(bare_hashes, lexicon)
    abuse = np.bincount(bare[2][insult], minlength=rows)
    each = np.unique(bare[2][insult] * len(lexicon) + np.searchsorted(lexicon, bare_hashes[insult]))
    insults = np.bincount(each // len(lexicon), minlength=rows)
    polite = (abuse == 0) & (langs == _LEXICON_HASH)
    told = np.isin(langs, signs.langs)
    seen = np.zeros(rows, dtype=np.int64)
    if len(signs.parts):
        whose, part = _parts(sums, *bare, langs, Lookup(signs.met))
        seen = np.bincount(whose[np.isin(part, signs.parts)], minlength=rows)
    bars = np.bincount(row[(ends - starts == 1) & (data[starts] == ord("|"))], minlength=rows) if len(starts) else words * 0
    size = np.maximum(np.diff(offsets), 1)
    symbols = _byte_share(data, offsets, b"#*$%&|<>")
    capitals = _byte_share(data, offsets, bytes(range(65, 91)))
    bangs = _byte_share(data, offsets, b"!")
    letters = _byte_share(data, offsets, bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
    inner = np.maximum(size - _byte_share(data, offsets, b" \t\n\x0b\x0c\r"), 1)

    def vote(bad, good) -> np.ndarray:
        return np.where(bad, BAD, np.where(good, GOOD, NOTHING))

    prose = (words >= 30) & (10 * letters >= 9 * inner) & (3 * kinds > words) & (12 * capitals <= size)
    no = np.zeros(rows, dtype=bool)
    out = np.column_stack(
        [
            vote(words < 10, no),
            vote(4 * symbols > words, no),
            vote(3 * capitals > size, no),
            vote((words >= 30) & (5 * kinds < words), no),
            vote((10 * bars > words) & (words > 0), no),
            vote((5 * bangs > words) & (words > 0), no),
            vote((words >= 30) & ~prose, prose),
            vote(abuse >= 1, polite),
            vote(insults >= 2, polite),
            vote((1000 * abuse >= 3 * words) & (abuse > 0), polite),
            vote(seen >= 3, told & (seen == 0)),
            vote(seen >= 5, told & (seen <= 1)),
        ]
    )
    return out, (row, hashes)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good per pattern, and the accuracy of each voter.

    A vote is right with the voter's accuracy in either class, and whether a voter votes at
    all says nothing.  The start supposes four right votes in five; accuracies stay above
    one half, which fixes the classes' names, and counts are smoothed.
    """
    accuracy, prior = np.full(patterns.shape[1], 0.8), 0.5
    posterior = np.zeros(len(patterns))
    for _ in range(rounds):
        odds = np.log(accuracy / (1 - accuracy))
        z = np.log(prior / (1 - prior)) + ((patterns == GOOD) * odds - (patterns == BAD) * odds).sum(1)
        before, posterior = posterior, 1 / (1 + np.exp(-z))
        if np.abs(posterior - before).max(initial=0) < 1e-9:
            break
        prior = float(np.clip((posterior @ counts + 1) / (counts.sum() + 2), 0.01, 0.99))
        right = ((patterns == GOOD) * posterior[:, None] + (patterns == BAD) * (1 - posterior[:, None])) * counts[:, None]
        total = (patterns != NOTHING) * counts[:, None]
        accuracy = np.clip((right.sum(0) + 4) / (total.sum(0) + 5), 0.55, 0.999)
    return posterior, accuracy


def _features(row: np.ndarray, hashes: np.ndarray, rows: int, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row bounds, columns and values: distinct hashed words, of Euclidean length 1 a row."""
    cell = np.unique(row * features + (hashes % np.uint64(features)).astype(np.int64))
    bounds = np.searchsorted(cell, np.arange(rows + 1) * features)
    size = np.diff(bounds)
    return bounds, cell % features, np.repeat(1 / np.sqrt(np.maximum(size, 1)), size)


def fit(bounds, columns, values, target: np.ndarray, features: int, epochs: int = EPOCHS, told: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic scorer for soft targets (the last is the bias), by AdaGrad; only
    from the rows that are ``told``, if given."""
    weights, squares = np.zeros(features + 1), np.full(features + 1, 1e-6)
    step = 128
    for _ in range(epochs):
        for first in range(0, len(target), step):
            last = min(first + step, len(target))
            a, b = bounds[first], bounds[last]
            row = np.repeat(np.arange(last - first), np.diff(bounds[first : last + 1]))
            z = np.bincount(row, weights=weights[columns[a:b]] * values[a:b], minlength=last - first) + weights[-1]
            error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - target[first:last]
            if told is not None:
                error = error * told[first:last]
            gradient = np.bincount(columns[a:b], weights=error[row] * values[a:b], minlength=features + 1) / (last - first)
            gradient[-1] = error.mean()
            squares += gradient**2
            weights -= 0.5 * gradient / np.sqrt(squares)
    return weights


def learn_signs(rows: DataFrame, labels: DataFrame, id_col: str, toxic_col: str, labelled_docs: int, seed: str) -> Signs:
    """Words and beginnings of words that tell toxic from clean documents, per language, from
    ``rows`` (id, text, lang) and a label per id (toxic if any of its labels says so)."""
    truth = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic"))
    truth = truth.filter("toxic is not null")
    share = {r.toxic: labelled_docs / r["count"] for r in truth.groupBy("toxic").count().collect()}
    if len(share) < 2:
        return Signs.none()
    u = unit_hash(F.lit(f"{seed}-labels"), F.col("id"))
    drawn = truth.filter(u < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    labelled = stored(rows.select("id", "text", "lang").join(F.broadcast(drawn), "id").select("text", "lang", "toxic"), "labelled-documents")

    def count(known):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = None if known is None else (known.value[0], Lookup(known.value[1]))
            for batch in batches:
                langs = _langs(batch.column(1))
                for first, last, data, offsets in pieces(*bytes_of(batch.column(0))):
                    own, lower = langs[first:last], LOWER[data]
                    bare = _bare(lower, *word_spans(lower, offsets))
                    whose, part = _parts(prefix_sums(lower), *bare, own, wanted and wanted[1])
                    if wanted:
                        whose, part = whose[kept := np.isin(part, wanted[0])], part[kept]
                    part, at, n = np.unique(part, return_index=True, return_counts=True)
                    kinds, docs = np.unique(own, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([own[whose[at]], kinds]).view(np.int64)),
                            pa.array(np.concatenate([part, kinds]).view(np.int64)),
                            pa.array(np.repeat([False, True], [len(part), len(kinds)])),
                            pa.array(np.concatenate([n, docs])),
                        ],
                        ["lang", "part", "whole", "n"],
                    )

        return run

    def counted(toxic: int, known=None) -> tuple[DataFrame, DataFrame]:
        own = labelled.filter(F.col("toxic") == toxic).select("text", "lang")
        summed = own.mapInArrow(count(known), "lang bigint, part bigint, whole boolean, n bigint").groupBy("lang", "part", "whole").agg(F.sum("n").alias("n"))
        summed = stored(summed.filter("whole or n >= %d" % (LEAST_DOCS if known is None else 1)), f"parts-{toxic}")
        return summed.filter("not whole").drop("whole"), summed.filter("whole").select("lang", F.col("n").alias("docs"))

    parts, docs = counted(1)
    # A document has a bounded number of parts, so few have this share, whatever the corpus.
    common = stored(parts.join(docs, "lang").filter(F.col("n") >= LEAST_SHARE * F.col("docs")), "parts-of-toxic")
    candidates = common.toArrow()
    hashed = np.sort(candidates["part"].to_numpy().view(np.uint64))
    context = rows.sparkSession.sparkContext
    clean, clean_docs = counted(0, context.broadcast((hashed, _at_rate_0(hashed))))
    both = (
        common.join(clean.select("lang", "part", F.col("n").alias("clean")), ["lang", "part"], "left")
        .join(clean_docs.select("lang", F.col("docs").alias("clean_docs")), "lang")
        .filter(
            F.log((F.col("n") + 0.5) / (F.col("docs") + 1)) - F.log((F.coalesce("clean", F.lit(0)) + 0.5) / (F.col("clean_docs") + 1))
            >= LEAST_ODDS
        )
        .select("lang", "part")
        .toArrow()
    )
    found = np.unique(both["part"].to_numpy().view(np.uint64))
    return Signs(found, _at_rate_0(found), np.unique(both["lang"].to_numpy().view(np.uint64)))


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, features: int = FEATURES,
    seed: str = SEED, lang_col: str = "lang", labels: DataFrame | None = None, toxic_col: str = "toxic",
    labelled_docs: int = LABELLED_DOCS,
) -> DataFrame:
    """One row per document: ``<id>, votes, quality, quality_score, manners, manners_score, kept``.

    ``votes`` has a digit per voter (0 nothing, 1 bad, 2 good); ``quality`` and ``manners``
    are the weak-label models' probabilities of good, the scores the linear scorers'.  A
    document is kept if for both the odds of model and scorer, multiplied, are not against it.

    ``labels`` (``<id>, <toxic_col>`` 0 or 1, for any part of the documents) is what voters on
    abuse learn words from; without it only the lexicon votes.  The language of a document is
    its ``lang_col`` if there is one.

    * Where no voter finds any document good, documents without votes are left undecided (1/2).
    * A null or empty text gets the votes of an empty text and the scorers' biases.
    * Repeated rows are judged alike; null ids stay (all with one place in the sample's draw).
    * An empty table gives an empty result; other columns are ignored.
    """
    lang = F.col(lang_col) if lang_col in docs.columns else F.lit(None)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), lang.cast("string").alias("lang"),
        unit_hash(F.lit(seed), F.col(id_col)).alias("u"),
    )
    context = docs.sparkSession.sparkContext
    signs = context.broadcast(Signs.none() if labels is None else learn_signs(rows, labels, id_col, toxic_col, labelled_docs, seed))
    powers = 3 ** np.arange(len(VOTERS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = _langs(batch.column(1))
            for first, last, data, offsets in pieces(*bytes_of(batch.column(0))):
                found, n = np.unique(votes(data, offsets, langs[first:last], signs.value)[0] @ powers, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["pattern", "n"])

    counted = rows.select("text", "lang").mapInArrow(count, "pattern bigint, n bigint").groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    codes, n = counted["pattern"].to_numpy().astype(np.int64), counted["n"].to_numpy().astype(float)
    patterns = codes[:, None] // powers[None, :] % 3
    tables = np.full((len(HEADS), 3 ** len(VOTERS)), 0.5)
    told, decided = np.zeros(tables.shape, dtype=bool), np.zeros(len(HEADS), dtype=bool)
    for k, columns in enumerate(COLUMNS.values()):
        own = patterns[:, columns]
        told[k, codes] = (own != NOTHING).any(1)
        decided[k] = (own == GOOD).any()
        tables[k, codes] = expectation_maximisation(own, n * told[k, codes])[0]
        if not decided[k]:
            tables[k, codes[~told[k, codes]]] = 0.5
    shared, spoken = context.broadcast(tables), context.broadcast(told)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets, heard, bounds, columns, values, total = [], [], [np.zeros(1, np.int64)], [], [], 0
        for batch in batches:
            langs = _langs(batch.column(1))
            for first, last, data, offsets in pieces(*bytes_of(batch.column(0))):
                own, (row, hashes) = votes(data, offsets, langs[first:last], signs.value)
                targets.append(shared.value[:, own @ powers])
                heard.append(spoken.value[:, own @ powers] & decided[:, None])
                b, c, v = _features(row, hashes, last - first, features)
                bounds.append(b[1:] + total)
                columns.append(c)
                values.append(v)
                total += len(c)
        if not targets:
            return
        bounds, columns, values = map(np.concatenate, (bounds, columns, values))
        targets, heard = np.concatenate(targets, axis=1), np.concatenate(heard, axis=1)
        weights = [fit(bounds, columns, values, target, features, told=own).tolist() for target, own in zip(targets, heard)]
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.list_(pa.list_(pa.float64())))], ["weights"])

    share = train_rows / max(float(n.sum()), 1.0)
    # In the order of the draw, so the fit does not depend on how rows are dealt.
    sampled = stored(rows.filter(F.col("u") < share).select("text", "lang", "u"), "labelled-sample")
    fitted = sampled.repartition(1).sortWithinPartitions("u", "text").mapInArrow(train, "weights array<array<double>>").collect()
    weights = context.broadcast(np.array(fitted[0].weights) if fitted else np.zeros((len(HEADS), features + 1)))
    kind = rows.schema["id"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = _langs(batch.column(2))
            for first, last, data, offsets in pieces(*bytes_of(batch.column(1))):
                own, (row, hashes) = votes(data, offsets, langs[first:last], signs.value)
                bounds, columns, values = _features(row, hashes, last - first, features)
                owner = np.repeat(np.arange(last - first), np.diff(bounds))
                found, kept = [], np.ones(last - first, dtype=bool)
                for k in range(len(HEADS)):
                    posterior = np.clip(shared.value[k, own @ powers], 1e-9, 1 - 1e-9)
                    w = weights.value[k]
                    z = np.bincount(owner, weights=w[columns] * values, minlength=last - first) + w[-1]
                    found += [pa.array(posterior), pa.array(1 / (1 + np.exp(-z)))]
                    kept &= np.log(posterior / (1 - posterior)) + z >= 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(["".join(map(str, v)) for v in own.tolist()]), *found, pa.array(kept)],
                    names,
                )

    names = ["id", "votes", *[n for head in HEADS for n in (head, f"{head}_score")], "kept"]
    schema = f"id {kind}, votes string, " + "".join(f"{n} double, " for n in names[2:-1]) + "kept boolean"
    return rows.select("id", "text", "lang").mapInArrow(judge, schema).withColumnRenamed("id", id_col)
