"""Language-model scores from Brown word classes.

The model is P(text) = product of P(class | class before) * P(word | class).  Classes come
from exchange clustering: words go where the likelihood of the class bigrams rises most.
All counts cover the whole training part of the corpus:

1. word counts (per piece of text, then by Spark);
2. exchange among the ``CORE`` most frequent words: Spark sums their bigrams to word-by-class
   counts, a table of CORE x classes cells whatever the corpus; on it the driver moves words,
   half of them a round so that neighbours do not move at once, until the likelihood stops
   rising.  All other words are in one class so far, the open one (the last);
3. ``SWEEPS`` over all other words, however seldom: Spark gathers each word's contexts as
   counts of the classes before and after it, and tasks move the words against the shared
   class matrix, by the gain in likelihood to first order (as distributed exchange does) plus
   the log-share of words that a class has.  That prior is what it costs to name the class:
   a word leaves the open class as soon as its contexts speak for another by more.  A word
   outside the core has less than a CORE-th of all rows, so that no key is hot;
4. texts become chains of classes.  Classes and counts of a bounded table of frequent words
   are known where the text is read; the others come by a join with the word table, where
   frequent words, the only hot keys, never go.  Class bigrams are counted and texts are
   scored on the chains.

A neighbour outside the table of frequent words counts as open in a sweep, not in the final
counts.  A word never seen in training is scored as an open one; the open class alone has a
smoothed emission.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored
from marketloom.llm.text_arrays import LOWER, Lookup, bytes_of, mixed, pieces, word_hashes, word_spans

CORE = 4096  # words that are exchanged one by one; the others follow in sweeps
ROUNDS = 16  # at most; the likelihood decides
SWEEPS = 2
PIECE = 1_000_000  # bytes of text worked on at once
HELD = 500_000  # words of pieces whose counts a task holds before it sends them
FREQUENT = 1 << 18  # words whose counts and classes every task holds; the others are joined
SMOOTH = 0.1
RISE = 1e-4  # a round that raises the likelihood by less, relatively, counts as idle


def _words_of(column):
    """Row numbers, bytes, and per piece the words' spans, rows and hashes, A-Z lower-cased."""
    for first, last, data, offsets in pieces(*bytes_of(column), PIECE):
        data = LOWER[data]
        starts, ends, row = word_spans(data, offsets)
        yield first, last, data, starts, ends, row, word_hashes(data, starts, ends)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans as an Arrow string array."""
    size = ends - starts
    bounds = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - bounds[:-1], size) + np.arange(int(bounds[-1]))
    return pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data[at])]
    )


def class_count(kinds: int) -> int:
    """Number of classes for so many different words: 1.5 times the cube root, in eights."""
    return max(8, 8 * round(1.5 * kinds ** (1 / 3) / 8))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, h, n`` over all rows of ``text``; ``h`` is the word's hash."""

    def merged(held):
        """Counts of several pieces as one batch; equal hashes are equal words."""
        hashes, count = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        _, sole, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.bincount(inverse.ravel(), weights=count, minlength=len(sole)).astype(np.int64)
        words = pa.concat_arrays([h[2] for h in held]).take(pa.array(sole))
        return pa.RecordBatch.from_arrays([words, pa.array(total)], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for _, _, data, starts, ends, _, hashes in _words_of(batch.column(0)):
                found, sole, count = np.unique(hashes, return_index=True, return_counts=True)
                held.append((found, count, _strings(data, starts[sole], ends[sole])))
                if sum(len(h[0]) for h in held) > HELD:
                    yield merged(held)
                    held = []
        if held:
            yield merged(held)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(0))
            h = word_hashes(data, offsets[:-1], offsets[1:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h.view(np.int64)), batch.column(1)], ["word", "h", "n"])

    summed = texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return summed.mapInArrow(named, "word string, h bigint, n bigint")


def _least_frequent(counts: DataFrame, most: int) -> int:
    """Least count such that at most ``most`` words have it or more, from a histogram of at
    most 64 x 16 steps."""
    step = F.floor(F.log2("n") * 16)
    bins = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).collect()
    total, least = 0, 1 << 62
    for r in sorted(bins, key=lambda r: -r.step):
        total += r.words
        if total > most:
            break
        least = r.n
    return least


def _bigrams(texts: DataFrame, table, clustered: int) -> DataFrame:
    """``a, b, n``: pairs of neighbours, as places among the core words; ``clustered``
    stands for all other words, ``clustered + 1`` for the end (and for what precedes a text)."""
    width = clustered + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, place = Lookup(table.value[0]).find, table.value[1]
        for batch in batches:
            for first, last, _, _, _, row, hashes in _words_of(batch.column(0)):
                ids = np.full(len(hashes), clustered, dtype=np.int64)
                which, at = found(hashes)
                ids[which] = place[at]
                edge = np.searchsorted(row, np.arange(last - first))
                ids = np.insert(ids, edge, clustered + 1)
                after = np.append(ids[1:], clustered + 1)
                cell, count = np.unique(ids * width + after, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(count)], ["cell", "n"])

    cells = texts.mapInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    return cells.select(F.expr(f"cell div {width}").alias("a"), (F.col("cell") % width).alias("b"), "n")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """Log-likelihood of class bigrams, up to what does not depend on the classes."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def exchange(right: np.ndarray, left: np.ndarray, classes: np.ndarray, free: int, movers: np.ndarray) -> np.ndarray:
    """One sweep: each mover goes to the class (of the first ``free``) with the best gain.
    ``right[w, c]`` counts words of class c after w, ``left[w, c]`` before it."""
    classes = classes.copy()
    count = right.shape[1]
    matrix = np.zeros((count, count))
    np.add.at(matrix, classes, right)
    logs = _xlogx(matrix)
    for w in movers:
        now, r, b = classes[w], right[w], left[w]
        if not r.sum() + b.sum():
            continue
        matrix[now] = np.maximum(matrix[now] - r, 0)
        matrix[:, now] = np.maximum(matrix[:, now] - b, 0)
        logs[now], logs[:, now] = _xlogx(matrix[now]), _xlogx(matrix[:, now])
        row, column = matrix.sum(1)[:free], matrix.sum(0)[:free]
        after, before = np.flatnonzero(r), np.flatnonzero(b)
        gain = (_xlogx(matrix[:free, after] + r[after]) - logs[:free, after]).sum(1)
        gain += (_xlogx(matrix[before, :free] + b[before, None]) - logs[before, :free]).sum(0)
        gain -= _xlogx(row + r.sum()) - _xlogx(row) + _xlogx(column + b.sum()) - _xlogx(column)
        to = int(gain.argmax())
        classes[w] = to
        matrix[to] += r
        matrix[:, to] += b
        logs[to], logs[:, to] = _xlogx(matrix[to]), _xlogx(matrix[:, to])
    return classes


def _cluster(bigrams: DataFrame, core: int, free: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of every core word, and the bigram matrix of the classes and the end (the last);
    the best of all rounds, which end when two of them, one per half, have raised nothing."""
    spark = bigrams.sparkSession
    classes = np.append(np.arange(core) % (free - 1), [free - 1, free])
    best, idle = None, 0
    for turn in range(rounds + 1):
        of = F.broadcast(spark.createDataFrame(list(enumerate(classes.tolist())), "w long, c int"))
        sums = {}
        for word, other in (("a", "b"), ("b", "a")):
            summed = bigrams.join(of, F.col(other) == F.col("w")).groupBy(word, "c").agg(F.sum("n").alias("n")).toArrow()
            sums[word] = np.zeros((core + 2, free + 1))
            sums[word][summed[word].to_numpy(), summed["c"].to_numpy()] = summed["n"].to_numpy()
        matrix = np.zeros((free + 1, free + 1))
        np.add.at(matrix, classes, sums["a"])
        now = likelihood(matrix)
        idle = 0 if best is None or now > best[0] + RISE * abs(best[0]) else idle + 1
        if best is None or now > best[0]:
            best = now, classes, matrix
        if turn == rounds or idle == 2:
            break
        movers = np.flatnonzero((np.arange(core) * 2654435761 >> 7) % 2 == turn % 2)
        classes = exchange(sums["a"], sums["b"], classes, free - 1, movers)
    return best[1][:core], best[2]


def _chain_of(hashes, row, count, found, free):
    """Classes of a piece's words with an end before each row, the places of the words in it,
    and which words are in the core.  Words outside the table are open."""
    which, at, word_class, is_core = found(hashes)
    classes = np.full(len(hashes), free - 1)
    classes[which] = word_class[at]
    inner = np.zeros(len(hashes), dtype=bool)
    inner[which] = is_core[at]
    return np.insert(classes, np.searchsorted(row, np.arange(count)), free), np.arange(len(row)) + row + 1, inner


def _finder(table):
    find = Lookup(table[0]).find
    return lambda hashes: (*find(hashes), *table[1:])


def _contexts(texts: DataFrame, table, free: int) -> DataFrame:
    """``h, cell`` of the words outside the core: how often a word stands between one class
    (or the end, ``free``) and another, the classes in the high 32 bits and the count in the low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _finder(table.value)
        for batch in batches:
            for first, last, _, _, _, row, hashes in _words_of(batch.column(0)):
                chain, place, inner = _chain_of(hashes, row, last - first, found, free)
                outer = np.flatnonzero(~inner)
                own, place = hashes[outer], place[outer]
                cell = chain[place - 1] * (free + 1) + np.append(chain, free)[place + 1]
                _, sole, count = np.unique(mixed(own ^ mixed(cell.astype(np.uint64))), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[sole].view(np.int64)), pa.array((cell[sole] << 32) + count)], ["h", "cell"]
                )

    return texts.mapInArrow(run, "h bigint, cell bigint")


def _table_matrix(texts: DataFrame, table, free: int) -> np.ndarray:
    """Class bigrams of the texts, with the classes that the table of frequent words has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = _finder(table.value), np.zeros((free + 1) ** 2, dtype=np.int64)
        for batch in batches:
            for first, last, _, _, _, row, hashes in _words_of(batch.column(0)):
                chain, _, _ = _chain_of(hashes, row, last - first, found, free)
                total += np.bincount(chain * (free + 1) + np.append(chain[1:], free), minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    return _matrix(texts.mapInArrow(run, "cell bigint, n bigint"), free)


def _matrix(cells: DataFrame, free: int) -> np.ndarray:
    summed = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros((free + 1) ** 2)
    matrix[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return matrix.reshape(free + 1, free + 1)


def gains(before: np.ndarray, after: np.ndarray, matrix: np.ndarray, free: int) -> np.ndarray:
    """Gain in likelihood, to first order, of each word (row) in each class, from how often
    the classes (and the end, the last) stand before and after it."""
    logs = np.log(matrix + SMOOTH)
    column = np.log(matrix.sum(0) + SMOOTH * len(matrix))[:free]
    row = np.log(matrix.sum(1) + SMOOTH * len(matrix))[:free]
    return before @ logs[:, :free] + after @ logs[:free].T - before.sum(1)[:, None] * column - after.sum(1)[:, None] * row


def _moves(contexts: DataFrame, matrix: np.ndarray, kinds: np.ndarray, free: int) -> DataFrame:
    """``h, c``: the class to which each word goes.  ``kinds`` counts the words of a class."""
    shared = contexts.sparkSession.sparkContext.broadcast((matrix, np.log(kinds + 1.0)))
    width = free + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, prior = shared.value
        held = None  # the last word so far and its sums

        def moved(words, before, after):
            to = (gains(before, after, matrix, free) + prior).argmax(1)
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(to.astype(np.int32))], ["h", "c"])

        for batch in batches:
            h, cell = (batch.column(k).to_numpy() for k in range(2))
            cell, n = cell >> 32, cell & 0xFFFFFFFF
            if not len(h):
                continue
            fresh = np.concatenate([[True], h[1:] != h[:-1]])
            words, group = h[fresh], np.cumsum(fresh) - 1
            sums = [
                np.bincount(group * width + side, weights=n, minlength=len(words) * width).reshape(-1, width)
                for side in (cell // width, cell % width)
            ]
            if held and held[0] == words[0]:
                for own, old in zip(sums, held[1:], strict=True):
                    own[0] += old
            elif held:
                yield moved(np.array([held[0]]), held[1][None], held[2][None])
            if len(words) > 1:
                yield moved(words[:-1], sums[0][:-1], sums[1][:-1])
            held = words[-1], sums[0][-1].copy(), sums[1][-1].copy()
        if held:
            yield moved(np.array([held[0]]), held[1][None], held[2][None])

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, "h bigint, c int")


@dataclass(frozen=True)
class Model:
    words: DataFrame  # word, h, n, c: every training word, its count and class
    free: int  # classes, the last of them open; the end is one more
    tokens: int  # training tokens, ends included
    kinds: int  # distinct training tokens, the end included
    ends: int
    least: int  # words with fewer occurrences are not in the table of frequent words
    sizes: np.ndarray  # training tokens per class
    kinds_of: np.ndarray  # different words per class


def train(
    texts: DataFrame, core: int = CORE, classes: int | None = None, rounds: int = ROUNDS, sweeps: int = SWEEPS,
    frequent: int = FREQUENT,
) -> Model:
    """Learn from all rows of ``text``; the number of classes follows the vocabulary."""
    counts = stored(word_counts(texts), "word-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = texts.count()
    free = max(2, classes or class_count(int(total[1])))
    least = _least_frequent(counts, frequent)
    spark = texts.sparkSession
    top = counts.filter(F.col("n") >= least).select("h", "n").toArrow().sort_by([("n", "descending"), ("h", "ascending")])
    names = top["h"].to_numpy().astype(np.int64)[:core]
    order = np.argsort(names.view(np.uint64))
    place = spark.sparkContext.broadcast((names.view(np.uint64)[order], order))
    of, inner = _cluster(stored(_bigrams(texts, place, len(names)), "class-bigrams"), len(names), free, rounds)
    settled = spark.createDataFrame(list(zip(names.tolist(), of.tolist(), strict=True)), "h long, c int")
    known, words = (names, of), None
    kinds = np.append(np.bincount(of, minlength=free - 1), int(total[1]) - len(names))
    for turn in range(max(sweeps, 1)):
        order = np.argsort(known[0].view(np.uint64))
        hashed = known[0][order]
        table = spark.sparkContext.broadcast((hashed.view(np.uint64), known[1][order], np.isin(hashed, names)))
        matrix = _table_matrix(texts, table, free) if turn else inner
        moves = stored(_moves(_contexts(texts, table, free), matrix, kinds, free), "class-moves")
        words = stored(counts.join(moves.unionByName(settled), "h").select("word", "h", "n", "c"), "word-classes")
        found = words.filter(F.col("n") >= least).select("h", "c").toArrow()
        known = found["h"].to_numpy().astype(np.int64), found["c"].to_numpy().astype(np.int64)
        sizes, kinds = np.zeros(free), np.zeros(free, dtype=np.int64)
        for r in words.groupBy("c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect():
            sizes[r.c], kinds[r.c] = r.n, r.kinds
    return Model(words, free, int(total[0]) + ends, int(total[1]) + (ends > 0), ends, least, sizes, kinds)


def emission(model: Model, n: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """log10 P(word | class) of words that occur ``n`` times in training."""
    is_open = classes == model.free - 1
    size = model.sizes[classes] + np.where(is_open, SMOOTH * (model.kinds_of[-1] + 1), 0)
    return np.log10(np.where(is_open, n + SMOOTH, n) / np.maximum(size, SMOOTH))


def _chains(rows: DataFrame, model: Model) -> DataFrame:
    """``id, held_out, n_tokens, n_known, base_score, emitted, chain``: the classes of each
    text's words, and what they add to its scores before transitions."""
    spark, kind = rows.sparkSession, rows.schema["id"].dataType.simpleString()
    found = model.words.filter(F.col("n") >= model.least).select("h", "n", "c").toArrow()
    hashed = found["h"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashed)
    count, of = found["n"].to_numpy()[order], found["c"].to_numpy()[order].astype(np.int64)
    table = spark.sparkContext.broadcast((hashed[order], of.astype(np.int16), np.log10(count + SMOOTH), emission(model, count, of)))
    norm = float(np.log10(model.tokens + SMOOTH * (model.kinds + 1)))
    end_log, end_known = float(np.log10(model.ends + SMOOTH)), int(model.ends > 0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, word_class, logs, emits = table.value
        find = Lookup(hashes).find
        for batch in batches:
            for first, last, data, starts, ends, row, own in _words_of(batch.column(3)):
                count = last - first
                which, at = find(own)
                classes = np.full(len(own), -1, dtype=np.int16)
                classes[which] = word_class[at]
                sums = [np.bincount(row[which], weights=x, minlength=count).astype(float) for x in (logs[at], emits[at])]
                left = np.flatnonzero(classes < 0)
                bounds, rest = (np.searchsorted(x, np.arange(count + 1)).astype(np.int32) for x in (row, row[left]))
                n = np.diff(bounds).astype(np.int64) + 1
                part = batch.slice(first, count)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3], pa.array(n), pa.array(np.bincount(row[which], minlength=count) + end_known),
                        pa.array(sums[0] + end_log - n * norm), pa.array(sums[1]),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(classes)),
                        pa.ListArray.from_arrays(pa.array(rest), _strings(data, starts[left], ends[left])),
                    ],
                    ["r", "id", "held_out", "n_tokens", "n_known", "base_score", "emitted", "chain", "rest"],
                )

    shown = f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, emitted double, chain array<smallint>"
    parts = stored(rows.mapInArrow(read, f"r bigint, {shown}, rest array<string>"), "read-chains")
    rest = parts.select("r", F.posexplode("rest").alias("at", "word"))
    rest = rest.join(model.words.filter(F.col("n") < model.least).select("word", "n", "c"), "word", "left")
    lists = rest.groupBy("r").agg(F.sort_array(F.collect_list(F.struct("at", "n", "c"))).alias("rest"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, chains = batch.column(8), batch.column(7)
            size = np.asarray(lists.value_lengths().fill_null(0))
            row = np.repeat(np.arange(len(size)), size)
            entries = lists.flatten()
            n = np.asarray(entries.field("n").fill_null(0))
            classes = np.asarray(entries.field("c").fill_null(model.free - 1)).astype(np.int64)
            flat = np.array(chains.flatten(), dtype=np.int16)
            flat[flat < 0] = classes
            sums = [np.bincount(row, weights=x, minlength=len(size)) for x in (n > 0, np.log10(n + SMOOTH), emission(model, n, classes))]
            bounds = np.concatenate([[0], np.cumsum(np.asarray(chains.value_lengths()))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:4], pa.array(np.asarray(batch.column(4)) + sums[0].astype(np.int64)),
                    pa.array(np.asarray(batch.column(5)) + sums[1]), pa.array(np.asarray(batch.column(6)) + sums[2]),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)),
                ],
                ["id", "held_out", "n_tokens", "n_known", "base_score", "emitted", "chain"],
            )

    whole = parts.drop("rest").join(lists, "r", "left")
    model = replace(model, words=None)  # what tasks need of it
    return stored(whole.mapInArrow(fill, shown), "class-chains")


def _steps_of(chains: pa.ListArray, free: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the class matrix that the chains pass, and the row of each."""
    size = np.asarray(chains.value_lengths())
    row = np.repeat(np.arange(len(size)), size + 1)
    chain = np.insert(np.asarray(chains.flatten()).astype(np.int64), np.cumsum(size) - size, free)
    return chain * (free + 1) + np.append(chain[1:], free), row


def transitions(chains: DataFrame, free: int) -> np.ndarray:
    """Bigram counts of the classes and the end (the last), over all rows of ``chain``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((free + 1) ** 2, dtype=np.int64)
        for batch in batches:
            total += np.bincount(_steps_of(batch.column(0), free)[0], minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    return _matrix(chains.select("chain").mapInArrow(run, "cell bigint, n bigint"), free)


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None, **options
) -> DataFrame:
    """One row per document: ``<id>, held_out, n_tokens, n_known, train_tokens, base_score,
    score, perplexity``, learning from the documents that are not held out.

    ``held_out`` is a boolean column; by default a tenth, by CRC of the id.  ``base_score``
    is the smoothed unigram, ``score`` the class model's log10-probability of the text,
    ``perplexity`` 10^(-score / n_tokens).

    * A null or empty text has one token, the end.
    * A null id counts as the empty text for the choice of held-out documents; repeated
      rows are learned from and scored each for itself.
    * Without training documents all counts are 0; an empty table gives an empty result.
    * Other columns are ignored.
    """
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0
    rows = docs.select(
        F.monotonically_increasing_id().alias("r"), F.col(id_col).alias("id"), held_out.alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
    )
    model = train(rows.filter("not held_out").select("text"), **options)
    chains = _chains(rows, model)
    free = model.free
    matrix = transitions(chains.filter("not held_out"), free)
    steps = np.log10((matrix + SMOOTH) / (matrix.sum(1, keepdims=True) + SMOOTH * (free + 1)))
    shared = docs.sparkSession.sparkContext.broadcast(steps.ravel())
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, row = _steps_of(batch.column(6), free)
            value = np.bincount(row, weights=shared.value[cells], minlength=batch.num_rows) + np.asarray(batch.column(5))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(value)], ["id", "held_out", "n_tokens", "n_known", "base_score", "score"]
            )

    scored = chains.mapInArrow(
        run, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return scored.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
