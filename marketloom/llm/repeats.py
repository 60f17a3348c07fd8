"""Repeated byte strings: a depth-limited radix sort of suffixes over the whole corpus.

Wanted is every byte inside a string of ``length`` bytes that also starts elsewhere.  Sorting
all suffixes by their first ``length`` bytes, most significant digit first, and dropping
groups of one after each digit, leaves exactly the repeated strings.  Two things keep this
linear in the text:

* *Anchors.*  A string's digits are taken from its anchor: the 64-byte substring with the
  least hash among all in it.  Equal strings have equal anchors at equal offsets, so suffixes
  need not be listed one by one: an anchor stands for all strings around it (about one byte
  in 69 is one).  The anchor is the first digit; anchors that occur once are dropped.
* *Contexts.*  The next digit is the whole context of an anchor, i.e. all the bytes that its
  strings can reach.  Anchors with a repeated context are done: all their strings repeat.

What is left are the ends of repeated passages.  Their strings are listed, grouped by anchor
and offset, and sorted by four digits of a quarter of the length each; those still in a
group of two after the last digit repeat.  An anchor with very many different contexts (a
line in a third of all documents) is not sorted in one task: its strings are counted by
Spark, digit values as keys.

Digits are compared as hashes of 64 bits, contexts and whole strings by two independent ones.
Texts are named by their MD5, so equal texts are one text here, as often as they occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import small, stored, whole_text
from marketloom.llm.text_arrays import Lookup, bytes_of, mixed, pieces, prefix_sums, span_hashes

LENGTH = 200
ANCHOR = 64
SECOND = 0x2545F4914F6CDD1D  # base of the second hash, odd
PIECE = 600_000  # bytes of text whose anchors are found at once
#: Repeated anchors up to which a task filters its own by a table; beyond, by a join.
TABLE = 2_000_000
#: Contexts of one anchor up to which one task sorts their strings.
GROUP = 20_000
#: Strings that a task sorts at once.
STRIP = 400_000
DIGITS = 4
_MUL = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


def anchors(sums: np.ndarray, offsets: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, hashes and rows of the anchors of a piece: of any string of ``length`` bytes
    inside a row, the substrings of ``size`` bytes with the least hash (all, if equal)."""
    count, width = len(sums) - size, length - size + 1
    if count < width:
        empty = np.zeros(0, dtype=np.int64)
        return empty, np.zeros(0, np.uint64), empty
    place = np.arange(count)
    hashes = np.minimum(span_hashes(sums, place, place + size), _NONE - np.uint64(1))
    long = np.diff(offsets) >= length
    inside = np.zeros(count + size, dtype=np.int8)  # +1 where a row's substrings begin, -1 behind its last
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - size + 1, -1)
    hashes[np.cumsum(inside[:count], dtype=np.int64) <= 0] = _NONE
    least = _sliding(hashes, width, np.minimum)
    pad = np.zeros(width - 1, dtype=np.uint64)
    # A place is an anchor if it is the least of one of the windows that it lies in.
    chosen = hashes <= _sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    chosen &= hashes != _NONE
    at = np.flatnonzero(chosen)
    return at, hashes[at], np.searchsorted(offsets, at, "right") - 1


def _contexts(sums, second, offsets, at, row, length, size):
    """Bounds and two hashes of the context of each anchor."""
    low = np.maximum(at - (length - size), offsets[row])
    high = np.minimum(at + length, offsets[row + 1])
    left = (at - low).astype(np.uint64)
    x = mixed(span_hashes(sums, low, high) * _MUL + left)
    return low, high, x, span_hashes(second, low, high, SECOND)


def _anchor_counts(docs: DataFrame, length: int, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in pieces(*bytes_of(batch.column(0)), PIECE):
                _, hashes, _ = anchors(prefix_sums(data), offsets, length, size)
                found, count = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], ["a", "n"])

    return docs.select("text").mapInArrow(run, "a bigint, n bigint").groupBy("a").agg(F.sum("n").alias("n"))


def _candidates(docs: DataFrame, repeated: DataFrame, length: int, size: int, table: int) -> DataFrame:
    """``key, at, last, n, a, x, y``: anchors that occur more than once.  Neighbouring ones of
    a text with the same context (periodic text) are one row, ``at`` to ``last``."""
    short = small(repeated, table)
    known = None
    if short:
        hashes = repeated.toArrow()["a"].to_numpy().astype(np.int64).view(np.uint64)
        known = docs.sparkSession.sparkContext.broadcast(np.sort(hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(known.value).find if known else None
        for batch in batches:
            for _, _, data, offsets in pieces(*bytes_of(batch.column(0)), PIECE):
                sums = prefix_sums(data)
                at, hashes, row = anchors(sums, offsets, length, size)
                if find:
                    which, _ = find(hashes)
                    at, hashes, row = at[which], hashes[which], row[which]
                if not len(at):
                    continue
                _, _, x, y = _contexts(sums, prefix_sums(data, SECOND), offsets, at, row, length, size)
                order = np.lexsort([at, y, x, row])
                at, hashes, row, x, y = at[order], hashes[order], row[order], x[order], y[order]
                fresh = np.ones(len(at), dtype=bool)
                fresh[1:] = (row[1:] != row[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (np.diff(at) > 2 * length - size)
                head = np.flatnonzero(fresh)
                count = np.diff(np.append(head, len(at)))
                keys = {r: hashlib.md5(data[offsets[r] : offsets[r + 1]].tobytes()).digest() for r in np.unique(row).tolist()}
                start = offsets[row[head]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[r] for r in row[head].tolist()], pa.binary()),
                        pa.array(at[head] - start), pa.array(at[head + count - 1] - start), pa.array(count),
                        *[pa.array(v[head].view(np.int64)) for v in (hashes, x, y)],
                    ],
                    ["key", "at", "last", "n", "a", "x", "y"],
                )

    found = docs.select("text").mapInArrow(run, "key binary, at bigint, last bigint, n bigint, a bigint, x bigint, y bigint")
    return found if short else found.join(repeated, "a", "left_semi")


def _place_ids(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit names of places in texts: ``keys`` are MD5s as rows of two numbers."""
    return mixed(keys[:, 0] * _MUL + mixed(keys[:, 1] ^ mixed(at.astype(np.uint64))))


def _with_context(docs: DataFrame, ends: DataFrame, length: int, size: int, table: int) -> DataFrame:
    """``a, key, at, left, context`` of the listed anchors (``a, key, at``), possibly repeated
    by copies of a text.  Their names are held by every task if few enough; beyond, texts
    are joined with their anchors."""
    if not small(ends, table):
        return _contexts_by_join(docs, ends, length, size)
    listed = ends.select("key", "at").toArrow()
    keys = np.frombuffer(b"".join(listed["key"].to_pylist()), np.uint64).reshape(-1, 2)
    names = docs.sparkSession.sparkContext.broadcast(np.sort(_place_ids(keys, listed["at"].to_numpy())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Lookup(names.value).find
        for batch in batches:
            seen: set[bytes] = set()
            for _, _, data, offsets in pieces(*bytes_of(batch.column(0)), PIECE):
                at, hashes, row = anchors(prefix_sums(data), offsets, length, size)
                if not len(at):
                    continue
                raws = {r: data[offsets[r] : offsets[r + 1]].tobytes() for r in np.unique(row).tolist()}
                digests = {r: hashlib.md5(raw).digest() for r, raw in raws.items()}
                for r, key in digests.items():  # copies in a batch speak once
                    if key in seen:
                        row[row == r] = -1
                    seen.add(key)
                at, hashes, row = at[row >= 0], hashes[row >= 0], row[row >= 0]
                if not len(at):
                    continue
                own = np.frombuffer(b"".join(digests[r] for r in row.tolist()), np.uint64).reshape(-1, 2)
                which, _ = find(_place_ids(own, at - offsets[row]))
                at, hashes, row = at[which], hashes[which], row[which]
                left = np.minimum(at - offsets[row], length - size)
                stop = np.minimum(at + length, offsets[row + 1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)), pa.array([digests[r] for r in row.tolist()], pa.binary()),
                        pa.array(at - offsets[row]), pa.array(left),
                        pa.array([data[x:y].tobytes() for x, y in zip((at - left).tolist(), stop.tolist(), strict=True)], pa.binary()),
                    ],
                    ["a", "key", "at", "left", "context"],
                )

    return docs.select("text").mapInArrow(run, _MEMBER)


_MEMBER = "a bigint, key binary, at bigint, left bigint, context binary"


def _contexts_by_join(docs: DataFrame, ends: DataFrame, length: int, size: int) -> DataFrame:
    wanted = ends.groupBy("key").agg(F.collect_list(F.struct("at", "a")).alias("anchors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "key", "at", "left", "context"]
        for batch in batches:
            out = []
            for key, text, found in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes()
                for f in found:
                    left = min(f["at"], length - size)
                    out.append((f["a"], key.as_py(), f["at"], left, raw[f["at"] - left : f["at"] + length]))
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.join(wanted, "key").select("key", "text", "anchors").mapInArrow(run, _MEMBER)


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the contexts."""
    context = batch.column("context").cast(pa.large_binary())
    _, offsets, data = context.buffers()
    offsets = np.frombuffer(offsets, np.int64)[context.offset : context.offset + len(context) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _strings(left: np.ndarray, offsets: np.ndarray, length: int, low: int, high: int):
    """Of every row (anchor): the strings around it that begin ``low`` to ``high`` - 1 bytes
    before the anchor, as row, that offset, place."""
    # A context of m bytes has m - length + 1 strings, the first of them `left` bytes before.
    least = np.maximum(left - np.diff(offsets) + length, low)
    count = np.maximum(np.minimum(left, high - 1) - least + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    before = least[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, before, offsets[:-1][row] + left[row] - before


def _digit(sums: np.ndarray, place: np.ndarray, length: int, k: int, base=None) -> np.ndarray:
    low, high = length * k // DIGITS, length * (k + 1) // DIGITS
    return span_hashes(sums, place + low, place + high, *([base] if base else []))


def _sorted_ends(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Per anchor the widest strings that repeat, from whole groups of anchors (sorted, so
    that what copies of a text sent twice are neighbours)."""
    keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), np.uint64).reshape(-1, 2)
    at = batch.column("at").to_numpy()
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]).any(1) | (at[1:] != at[:-1])
    batch = batch.filter(pa.array(fresh))
    data, offsets = _texts(batch)
    left = batch.column("left").to_numpy()
    sums, second = prefix_sums(data), prefix_sums(data, SECOND)
    anchor = batch.column("a").to_numpy().view(np.uint64)
    most = np.full(len(left), np.iinfo(np.int64).min)
    least = np.full(len(left), np.iinfo(np.int64).max)
    # Equal strings lie equally far before their anchor: strips of offsets are sorted in turn.
    width = max(1, STRIP // max(1, len(left)))
    for low in range(0, int(left.max(initial=0)) + 1, width):
        row, before, place = _strings(left, offsets, length, low, low + width)
        group = mixed(anchor[row] * _MUL + before.astype(np.uint64))
        # Most significant digit first; the last pass compares the whole string by the second hash.
        for k in range(DIGITS + 1):
            digit = _digit(sums, place, length, k) if k < DIGITS else span_hashes(second, place, place + length, SECOND)
            group = mixed(group * _MUL + digit)
            _, inverse, count = np.unique(group, return_inverse=True, return_counts=True)
            keep = count[inverse.ravel()] > 1
            row, before, place, group = row[keep], before[keep], place[keep], group[keep]
        np.maximum.at(most, row, before)
        np.minimum.at(least, row, before)
    head = np.flatnonzero(most >= least)
    most, least = most[head], least[head]
    found = batch.select(["key", "at"]).take(pa.array(head))
    at = found.column("at").to_numpy()
    return pa.RecordBatch.from_arrays([found.column("key"), pa.array(at - most), pa.array(at - least + length)], ["key", "low", "high"])


def _ends_by_sorting(members: DataFrame, length: int) -> DataFrame:
    """Strings of anchors with few contexts: whole groups meet in a task, in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(final: bool):
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            a = table.column("a").to_numpy()
            end = len(a) if final else int(np.flatnonzero(a != a[-1])[-1]) + 1 if (a != a[-1]).any() else 0
            held[:] = [table.slice(end)] if end < len(a) else []
            return table.slice(0, end)

        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= GROUP // 4:
                whole = groups(False)
                rows = sum(b.num_rows for b in held)
                if whole.num_rows:
                    yield _sorted_ends(whole, length)
        if held:
            yield _sorted_ends(groups(True), length)

    # Arrow batches of one partition come in order, so groups are whole or the last so far.
    return members.repartition("a").sortWithinPartitions("a", "key", "at").mapInArrow(run, "key binary, low bigint, high bigint")


def _ends_by_counting(members: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many contexts: strings are counted by Spark."""
    members = members.groupBy("a", "key", "at", "left").agg(F.first("context").alias("context"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                data, offsets = _texts(part)
                row, before, place = _strings(part.column("left").to_numpy(), offsets, length, 0, length)
                one = span_hashes(prefix_sums(data), place, place + length)
                two = span_hashes(prefix_sums(data, SECOND), place, place + length, SECOND)
                own = part.select(["a", "key", "at"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(before), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                    ["a", "key", "at", "before", "one", "two"],
                )

    strings = members.mapInArrow(run, "a bigint, key binary, at bigint, before bigint, one bigint, two bigint")
    same = ["a", "before", "one", "two"]
    repeated = strings.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    kept = strings.join(repeated, same, "left_semi")
    return kept.groupBy("key", "at").agg(F.max("before").alias("b"), F.min("before").alias("e")).selectExpr(
        "key", "at - b as low", f"at - e + {length} as high"
    )


def spans(docs: DataFrame, length: int = LENGTH, size: int = ANCHOR, table: int = TABLE, group: int = GROUP) -> DataFrame:
    """``key, spans`` for texts (``key, text``) with repeated strings: pieces ``low, high`` in
    bytes, unordered and overlapping."""
    repeated = stored(_anchor_counts(docs, length, size).filter("n > 1").select("a"), "repeated-anchors")
    found = stored(_candidates(docs, repeated, length, size, table), "anchor-rows")
    kinds = stored(
        found.groupBy("a", "x", "y").agg(F.sum("n").alias("n"), F.min(F.struct("key", "at")).alias("one")), "anchor-contexts"
    )
    whole = found.join(kinds.filter("n > 1"), ["a", "x", "y"], "left_semi").selectExpr(
        "key", f"greatest(at - {length - size}, 0) as low", f"last + {length} as high"
    )
    several = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("_contexts")).filter("_contexts > 1")
    ends = stored(
        kinds.join(several, "a").selectExpr("a", "one.key as key", "one.at as at", f"_contexts > {group} as hot"), "anchor-ends"
    )
    edge = _ends_by_sorting(_with_context(docs, ends.filter("not hot"), length, size, table), length)
    if not ends.filter("hot").isEmpty():
        edge = edge.unionByName(_ends_by_counting(_with_context(docs, ends.filter("hot"), length, size, table), length))
    # Copies of a text give the same pieces once.
    every = whole.unionByName(edge).distinct()
    return every.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """One row per document: ``<id>, n_bytes, spans, kept``.

    ``spans`` are the maximal runs (``start, end`` in UTF-8 bytes) covered by strings of
    ``length`` bytes that also start elsewhere, in the same or another document; overlaps
    count, and all are judged on the input.  ``kept`` holds the other bytes (binary, as a
    run may end inside a character).

    * A null text counts as empty; texts shorter than ``length`` lose nothing.
    * Repeated rows are repeats of each other, and lose everything if long enough.
    * Null ids stay; other columns are ignored; an empty table gives an empty result.
    """
    text = whole_text(F.col(text_col).cast("string"))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("key"))
    joined = rows.join(spans(rows, length, **options), "key", "left").select("id", "text", "spans")
    kind = rows.schema["id"].dataType.simpleString()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, kept = [], [], []
            lists = batch.column(2)
            bounds = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))])
            flat = lists.flatten()
            low, high = (np.asarray(flat.field(k)) for k in (0, 1))
            for k, text in enumerate(batch.column(1)):
                raw = text.as_buffer()
                a, b = bounds[k], bounds[k + 1]
                sizes.append(raw.size)
                if a == b:
                    runs.append([])
                    kept.append(raw.to_pybytes())
                    continue
                order = np.argsort(low[a:b])
                starts, ends = low[a:b][order], np.maximum.accumulate(np.minimum(high[a:b][order], raw.size))
                head = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
                merged = list(zip(starts[head].tolist(), ends[np.append(head[1:] - 1, len(ends) - 1)].tolist(), strict=True))
                runs.append([{"start": s, "end": e} for s, e in merged])
                edges = [0, *[x for m in merged for x in m], raw.size]
                whole = raw.to_pybytes()
                kept.append(b"".join(whole[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(span)), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "spans", "kept"],
            )

    schema = f"id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return joined.mapInArrow(run, schema).withColumnRenamed("id", id_col)
