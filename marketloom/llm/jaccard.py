"""N-gram Jaccard join with adaptive multi-match prefixes.

Texts become sets of word-shingle hashes; equal sets are one *node*.  Shingles have one
global order, rare ones first: those known to be frequent come last, by an estimate, the
others by how frequent their words are, as shingles of rare words are seldom shared by
chance, however large the corpus.  Any fixed order gives the same links.  With similarity p, two sets that link share at least l of the first
n - ceil(p n) + l shingles of each, for any l.  A document takes the l whose estimated cost
(postings read, plus candidates verified) is least: where its prefix holds frequent
shingles it takes a longer prefix, and candidates must share more of it.  How much, follows
from both sizes: all of the overlap but what can lie behind the prefixes
(:func:`_need`, at least the smaller l).

Links are wanted as components, so not every pair of a large group is looked at:

1. in each posting list, all members are verified against one leader (the node with most
   documents), and the links found give components;
2. then only pairs from different components matter: per list, the nodes outside its
   largest component against all others, of sizes that both meet in enough lists to link at
   all.  Short lists give their pairs.  In a long list, where many texts differ a little
   from each other, members are compared by how they differ from what most of them have, so
   pairs meet on differences, which are few, instead of on what all of them share; sizes and
   counts of common differences give their exact overlap (:func:`_linked_by_differences`).

Each pair that links but is not yet connected meets in one of these ways, so no link between
components is lost.

Only candidates that share enough of their prefixes are verified, on whole sets, which are
made for their documents alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import maybe_broadcast, stored
from marketloom.llm.components import components
from marketloom.llm.text_arrays import LOWER, bytes_of, pieces, shingle_hashes, word_hashes, word_spans

#: Frequent shingles that are ordered by frequency; all others count as rare.  The list
#: only shapes the order (speed), never the result.
FREQUENT = 100_000
FREQUENT_WORDS = 100_000  # words whose counts order the other shingles; speed only
PART = 1 << 20  # words counted at once
LONGEST = 4  # largest l
VERIFY_COST = 20.0  # of one candidate, in postings
BROADCAST_IDS = 200_000
ROWS = 500  # pairs of sets worked on at once
LONG = 2_000  # pairs of a list above which it is taken by differences


def _words(column) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and hashes of the words, A-Z lower-cased, of every text."""
    for first, last, data, offsets in pieces(*bytes_of(column)):
        data = LOWER[data]
        starts, ends, row = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        bound = np.searchsorted(row, np.arange(last - first + 1))
        for k in range(last - first):
            yield first + k, hashes[bound[k] : bound[k + 1]]


def shingle_sets(column, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of every text, A-Z lower-cased."""
    for row, own in _words(column):
        yield row, np.unique(shingle_hashes(own, min(size, len(own)))) if len(own) else own


def _scored_sets(column, size: int, words: np.ndarray, weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingle sets with the score of each shingle: the sum of its words' weights (of the
    sorted ``words``; others weigh 0).  The same words give the same score in every text."""
    for _, own in _words(column):
        if not len(own):
            yield own, np.zeros(0, np.int64)
            continue
        width = min(size, len(own))
        tokens, at = np.unique(shingle_hashes(own, width), return_index=True)
        sums = np.cumsum(np.concatenate([np.zeros(1, np.int64), _looked_up(own, words, weights, 0)]))
        yield tokens, (sums[width:] - sums[:-width])[at]


def _looked_up(hashes: np.ndarray, names: np.ndarray, values: np.ndarray, otherwise: int) -> np.ndarray:
    """The value of each hash by the sorted ``names``."""
    if not len(names):
        return np.full(len(hashes), otherwise, np.int64)
    at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
    return np.where(names[at] == hashes, values[at], otherwise)


def required(n, percent: int):
    """Least overlap of a set of n with any set it links to."""
    return -(-percent * n // 100)


def _frequent(docs: DataFrame, size: int, most: int) -> DataFrame:
    """``word, token, n``: estimated document counts of the most frequent shingles, and counts
    of the most frequent words.  Each batch reports the shingles that two of its documents
    share, and the words found twice in about ``PART`` of its words; what is frequent shows
    in many of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, words, held = [], [], 0
            for _, own in _words(batch.column(0)):
                if len(own):
                    sets.append(np.unique(shingle_hashes(own, min(size, len(own)))))
                    words.append(own)
                    held += len(own)
                if held >= PART:
                    yield _repeated(True, words)
                    words, held = [], 0
            yield _repeated(True, words)
            yield _repeated(False, sets)

    found = docs.select("text").mapInArrow(run, "word boolean, token bigint, n bigint")
    found = stored(found.groupBy("word", "token").agg(F.sum("n").alias("n")), "shingle-counts")

    def top(kind: str, most: int) -> DataFrame:
        return found.filter(kind).orderBy(F.desc("n"), "token").limit(most)

    return top("not word", most).unionByName(top("word", FREQUENT_WORDS))


def _repeated(word: bool, hashes: list[np.ndarray]) -> pa.RecordBatch:
    """Hashes found twice or more, and how often."""
    found, count = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]), return_counts=True)
    keep = count > 1
    columns = [pa.repeat(word, int(keep.sum())), pa.array(found[keep].view(np.int64)), pa.array(count[keep])]
    return pa.RecordBatch.from_arrays(columns, ["word", "token", "n"])


def prefix_of(
    tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray, percent: int, score: np.ndarray | None = None
) -> tuple[int, np.ndarray]:
    """The adaptive l of a set and its prefix: ``tokens`` sorted, ``frequent`` sorted; among
    equally frequent tokens those of low ``score`` come first."""
    weight = _looked_up(tokens, frequent, counts, 1)
    order = np.lexsort([tokens, weight] if score is None else [tokens, score, weight])
    base = len(tokens) - required(len(tokens), percent) + 1
    most = min(LONGEST, len(tokens) - base + 1)
    # Each frequent shingle meets its other documents; l shared ones make a candidate.
    postings = np.cumsum(weight[order[: base + most - 1]] - 1)[base - 1 :]
    level = np.arange(1, most + 1)
    best = int(np.argmin(postings + VERIFY_COST * postings / level**2)) + 1
    return best, tokens[order[: base + best - 1]]


def _keyed(docs: DataFrame, frequent: DataFrame, size: int, percent: int) -> DataFrame:
    """``id, key, n, level, tokens`` per row: key is a 128-bit hash of the set."""
    table = np.array([(r.word, r.token, r.n) for r in frequent.collect()], dtype=np.int64).reshape(-1, 3)

    def sorted_counts(word: int) -> tuple[np.ndarray, np.ndarray]:
        own = table[table[:, 0] == word, 1:]
        token = own[:, 0].copy().view(np.uint64)
        order = np.argsort(token)
        return token[order], own[order, 1]

    words, times = sorted_counts(1)
    # Sums of logarithms order shingles as products of their words' counts would.
    weights = np.round(16 * np.log2(times)).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((*sorted_counts(0), words, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts, words, weights = shared.value
        for batch in batches:
            keys, sizes, levels, lists = [], [], [], []
            for tokens, score in _scored_sets(batch.column(1), size, words, weights):
                level, prefix = prefix_of(tokens, names, counts, percent, score) if len(tokens) else (0, tokens)
                keys.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                sizes.append(len(tokens))
                levels.append(level)
                lists.append(prefix.view(np.int64))
            flat = np.concatenate([*lists, np.zeros(0, np.int64)])
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(levels, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                ["id", "key", "n", "level", "tokens"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, key binary, n bigint, level int, tokens array<bigint>")


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, tokens`` (sorted hashes as bytes) of the wanted nodes, stored; from the documents
    that carry the node's least id and its text."""
    chosen = stored(nodes.join(wanted, "node", "left_semi").select("node", "key", "least"), "wanted-nodes")
    some = docs.join(maybe_broadcast(chosen, BROADCAST_IDS), F.col("id").eqNullSafe(F.col("least")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                raw = [s.tobytes() for _, s in shingle_sets(batch.column(0), size)]
                own = [hashlib.blake2b(r, digest_size=16).digest() == key for r, key in zip(raw, batch.column(2).to_pylist(), strict=True)]
                made = pa.RecordBatch.from_arrays([batch.column(1), pa.array(raw, pa.binary())], ["node", "tokens"])
                yield made.filter(pa.array(own, pa.bool_()))

    made = stored(some.select("text", "node", "key").mapInArrow(run, "node bigint, tokens binary"), "shingle-sets")
    # Where ids are unique every node has one document.
    if made.groupBy("node").count().filter("count > 1").isEmpty():
        return made
    return stored(made.groupBy("node").agg(F.first("tokens").alias("tokens")), "shingle-sets")


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The (stored) pairs ``a, b`` whose whole sets reach the similarity."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _sets(docs, nodes, wanted, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a bigint, b bigint")


def _symmetric(joined: DataFrame) -> DataFrame:
    """``leader, node, n, tokens`` of rows ``a, b, x, y`` (sets as bytes): shingles that only
    one of leader and member has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                sizes, lists = [], []
                for x, y in zip(batch.column(2), batch.column(3), strict=True):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    sizes.append(len(y))
                    lists.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
                ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                flat = pa.array(np.concatenate(lists))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat)],
                    ["leader", "node", "n", "tokens"],
                )

    return joined.mapInArrow(run, "leader bigint, node bigint, n bigint, tokens array<bigint>")


def _often(differences: DataFrame) -> DataFrame:
    """``leader, token, n``: differences that most of a batch's members around a leader have,
    and in how many of such batches' members.  What most members have, most of some batch
    have, so little is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leader = batch.column(0).to_numpy()
            length = np.asarray(batch.column(1).value_lengths())
            flat = np.asarray(batch.column(1).flatten())
            owner = np.repeat(leader, length)
            out = []
            for one, members in zip(*np.unique(leader, return_counts=True), strict=True):
                found, count = np.unique(flat[owner == one], return_counts=True)
                keep = 2 * count > members
                out.append((np.full(int(keep.sum()), one), found[keep], count[keep]))
            columns = [np.concatenate([*c, np.zeros(0, np.int64)]) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["leader", "token", "n"])

    found = differences.select("leader", "tokens").mapInArrow(run, "leader bigint, token bigint, n bigint")
    return found.groupBy("leader", "token").agg(F.sum("n").alias("_n"))


def _linked_by_differences(
    around: DataFrame, docs: DataFrame, nodes: DataFrame, links: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links ``a, b`` that connect all members around the same leader which ``links`` and
    chains of links between members connect.

    Members are described by D(x), how x differs from a set R, the shingles that most members
    have (any R gives the same links; this one makes D small).  For members x and y with c common differences, the sets
    differ in |D(x)| + |D(y)| - 2c shingles, so with

        s(x) = (100 + percent) |D(x)| - (100 - percent) |x|

    they link exactly if s(x) + s(y) <= 2 (100 + percent) c.

    * Pairs with c = 0: let m be a member of least s.  If x and y link, s(x) + s(m) <= s(x) +
      s(y) <= 0, so both link to m.  Looking at every member against m is enough.
    * Pairs with c > 0 meet on a difference t.  First each holder of t is looked at against the
      holder of least s, which joins most of them; then, where holders of t are still in
      different components, those outside the largest against the others.  As s(y) >= s(m),
      x needs at least k = (s(x) + s(m)) / (2 (100 + percent)) common differences with any y.
      Of the differences that several members have, sets with so many in common share one of
      the first n - k + 1 of n, in any fixed order, so only those are compared; the first that
      a pair has in common is among them, and no more can be common than either has from there on.

    No shingle of the leader's own is in R, so it is not a difference that all others share.
    """
    weight = 100 + percent
    own = around.select("a", F.col("a").alias("b")).distinct()
    everyone = around.unionByName(own)
    sets = _sets(docs, nodes, everyone.select(F.explode(F.array("a", "b")).alias("node")).distinct(), size)
    left, right = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    plain = stored(_symmetric(everyone.join(left, "a").join(right, "b").select("a", "b", "x", "y")), "shingle-differences")
    members = plain.groupBy("leader").agg(F.count(F.lit(1)).alias("_members"))
    usual = (
        _often(plain)
        .join(members, "leader").filter("2 * _n > _members").groupBy("leader").agg(F.collect_list("token").alias("_turned"))
    )
    none = F.array().cast("array<bigint>")
    turned = F.coalesce("_turned", none)
    found = stored(
        plain.join(usual, "leader", "left")
        .withColumn("tokens", F.array_sort(F.concat(F.array_except("tokens", turned), F.array_except(turned, "tokens"))))
        .withColumn("d", F.size("tokens").cast("bigint"))
        .withColumn("s", weight * F.col("d") - (100 - percent) * F.col("n"))
        .select("leader", "node", "tokens", "d", "s"),
        "shingle-differences",
    )

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs ``leader, node, other`` that link, by their differences."""
        other = found.select("leader", F.col("node").alias("other"), F.col("tokens").alias("y"), F.col("s").alias("s2"))
        common = F.size(F.array_intersect("tokens", "y"))
        return (
            pairs.join(found, ["leader", "node"]).join(other, ["leader", "other"])
            .filter(F.col("s") + F.col("s2") <= 2 * weight * common)
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        )

    least = found.groupBy("leader").agg(F.min_by("node", "s").alias("other"), F.min("s").alias("least"))
    # Differences that must be compared: of those that others have too, in the order of their
    # values, all but need - 1.
    single = found.select("leader", "node", F.explode("tokens").alias("token"))
    several = single.groupBy("leader", "token").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("leader", "token")
    common = single.join(several, ["leader", "token"], "left_semi").groupBy("leader", "node").agg(F.array_sort(F.collect_list("token")).alias("common"))
    need = F.greatest(F.lit(1), F.ceil((F.col("s") + F.col("least")) / (2 * weight)))
    size_of = F.size("common").cast("bigint")
    held = (
        found.drop("tokens").join(common, ["leader", "node"]).join(least.select("leader", "least"), "leader")
        .withColumn("_some", size_of - need + 1).filter("_some > 0")
        .select("leader", "node", "d", "s", size_of.alias("_size"), F.posexplode(F.slice("common", F.lit(1), F.col("_some").cast("int"))).alias("_at", "token"))
        .withColumn("rest", F.col("_size") - F.col("_at")).drop("_at", "_size")
    )
    # One holder of least s per difference that several members share.
    holders = stored(
        held.groupBy("leader", "token").agg(
            F.count(F.lit(1)).alias("_holders"), F.min_by("node", "s").alias("other"), F.min("s").alias("s2")
        ).filter("_holders > 1").drop("_holders"),
        "shingle-holders",
    )
    stars = (
        found.join(least, "leader").select("leader", "node", "other")
        .unionByName(
            held.join(holders, ["leader", "token"]).filter(F.col("s") + F.col("s2") <= 2 * weight * F.col("d"))
            .select("leader", "node", "other")
        )
        .filter("node <> other").distinct()
    )
    near = stored(linked(stars).distinct(), "shingle-links")
    labels = components(links.unionByName(near))

    # What is still apart.
    compared = stored(
        held.join(holders.select("leader", "token"), ["leader", "token"], "left_semi")
        .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")),
        "shingle-compared",
    )
    per_label = compared.groupBy("leader", "token", "label").agg(F.count(F.lit(1)).alias("_n"))
    mixed = (
        per_label.groupBy("leader", "token").agg(F.count(F.lit(1)).alias("_labels"), F.max_by("label", "_n").alias("main"))
        .filter("_labels > 1").select("leader", "token", "main")
    )
    placed = stored(compared.join(mixed, ["leader", "token"]), "shingle-apart")
    others = placed.select(
        "leader", "token", F.col("node").alias("other"), F.col("label").alias("label2"), F.col("rest").alias("rest2"), F.col("s").alias("s2"),
        (F.col("label") == F.col("main")).alias("is_main"),
    )
    apart = (
        placed.filter("label <> main").join(others, ["leader", "token"])
        .filter("label <> label2 and (is_main or node < other)")
        .filter(F.col("s") + F.col("s2") <= 2 * weight * F.least("rest", "rest2"))
        .select("leader", "node", "other").distinct()
    )
    return near.unionByName(linked(apart)).distinct()


def _close(percent: int):
    """Sizes that allow the similarity at all."""
    return 100 * F.least("n", "m") >= percent * F.greatest("n", "m")


def _need(percent: int):
    """What prefixes of p of n and q of m shingles must share.  Let the prefix of n end first
    in the common order: then all that the sets share up to there is shared by the prefixes,
    and at most n - p more can follow.  The larger rest is safe for either case."""
    overlap = F.ceil(percent * (F.col("n") + F.col("m")) / (100 + percent))
    return F.greatest(F.lit(1), overlap - F.greatest(F.col("n") - F.col("p"), F.col("m") - F.col("q")))


def _sharing_enough(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The (stored) pairs ``a, b`` whose prefixes share what their sizes demand.  Only prefixes
    of these nodes are shuffled."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted-nodes")
    some = nodes.join(maybe_broadcast(wanted, BROADCAST_IDS), "node", "left_semi").select("node", "n", F.size("tokens").alias("p"), "tokens")
    return (
        pairs.join(some.toDF("a", "n", "p", "x"), "a").join(some.toDF("b", "m", "q", "y"), "b")
        .filter(F.size(F.array_intersect("x", "y")) >= _need(percent)).select("a", "b")
    )


def _size_class(n: str):
    return F.floor(F.log(F.col(n).cast("double")) * 20).cast("int")


def _least_need(percent: int):
    """The least :func:`_need` of a set of n with any of ``m_lo`` to ``m_hi`` shingles, whose
    prefix is the shortest there is or longer."""
    overlap = F.ceil(percent * (F.col("n") + F.col("m_lo")) / (100 + percent))
    behind = F.greatest(F.col("n") - F.col("p"), F.ceil(percent * F.col("m_hi") / 100) - 1)
    return F.greatest(F.lit(1), overlap - behind)


def join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, frequent: int = FREQUENT,
    long_list: int = LONG,
) -> DataFrame:
    """One row per document: ``<id>, n_shingles, component_id``.

    Two documents link when the Jaccard similarity of their sets of ``size``-word shingles
    is ``percent`` or more; ``component_id`` is the smallest id reachable by links.

    * With fewer words than ``size``, the whole sequence is the one shingle.  A text
      without words, or null, has an empty set and links with nothing: its component is
      its own id.
    * Repeated rows and equal texts are one node, whose copies all get its component.
    * A null id stays null in the output and is never the smallest id of a component unless
      all ids in it are null.
    * An empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = stored(_keyed(docs, _frequent(docs, size, frequent), size, percent), "shingle-prefixes")
    some = keyed.filter("n > 0")
    nodes = stored(
        some.groupBy("key").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("docs"),
            F.first("n").alias("n"), F.first("tokens").alias("tokens"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "shingle-nodes",
    )
    postings = nodes.select("node", "n", "docs", F.size("tokens").alias("p"), F.explode("tokens").alias("token"))
    shared = postings.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("token")
    lists = stored(postings.join(shared, "token", "left_semi"), "shingle-postings")

    leaders = lists.groupBy("token").agg(F.max(F.struct("docs", F.col("node").alias("b"), F.col("n").alias("m"))).alias("_top"))
    star = stored(
        lists.join(leaders, "token")
        .select(F.col("node").alias("a"), "n", F.col("_top.b").alias("b"), F.col("_top.m").alias("m"))
        .filter("a <> b").filter(_close(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "shingle-pairs",
    )
    star = stored(_sharing_enough(star, nodes, percent), "shingle-pairs")
    links = stored(_verified(star, docs, nodes, size, percent), "shingle-links")
    labels = components(links)

    # Pairs from different components: per list, nodes outside the largest component.
    placed = stored(
        lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "shingle-placed"
    )
    per_list = placed.groupBy("token", "label").agg(F.count(F.lit(1)).alias("_n"))
    main = per_list.groupBy("token").agg(F.max(F.struct("_n", "label")).alias("_main"), F.count(F.lit(1)).alias("_labels"))
    mixed = stored(
        placed.join(main.filter("_labels > 1").select("token", "_main.label").withColumnRenamed("label", "main"), "token"),
        "shingle-mixed",
    )
    # Which sizes a node can link to at all: it must meet them in enough of its lists.  Sizes
    # are taken together in classes of five per cent, by the least that any of a class needs.
    mixed = mixed.withColumn("_size", _size_class("n"))
    # Only sets of other components count, here and below: the least or greatest label differs.
    apart = (F.col("label_lo") != F.col("label")) | (F.col("label_hi") != F.col("label"))
    labelled = [F.min("label").alias("label_lo"), F.max("label").alias("label_hi")]
    classes = mixed.groupBy("token", F.col("_size").alias("_to")).agg(F.min("n").alias("m_lo"), F.max("n").alias("m_hi"), *labelled)

    def enough(met: DataFrame) -> DataFrame:
        """``node, _to`` of nodes that meet a class of sizes in enough lists."""
        return (
            met.filter(apart & (100 * F.col("m_hi") >= percent * F.col("n")) & (percent * F.col("m_lo") <= 100 * F.col("n")))
            .groupBy("node", "n", "p", "_to").agg(F.count(F.lit(1)).alias("_met"), F.min("m_lo").alias("m_lo"), F.max("m_hi").alias("m_hi"))
            .filter(F.col("_met") >= _least_need(percent)).select("node", "_to")
        )

    able = stored(enough(mixed.join(classes, "token")), "shingle-able")
    # Once more among those: both of a pair must be able to link to the other's sizes.
    reach = stored(mixed.join(able, "node"), "shingle-reach")
    back = reach.groupBy("token", F.col("_size").alias("_to"), F.col("_to").alias("_size")).agg(F.min("n").alias("m_lo"), F.max("n").alias("m_hi"), *labelled)
    able = stored(enough(reach.join(back, ["token", "_size", "_to"])), "shingle-able")
    reach = stored(reach.join(able, ["node", "_to"], "left_semi"), "shingle-reach")
    # Lists whose pairs are too many to write down.
    outsider = F.col("label") != F.col("main")
    cost = reach.groupBy("token", "_size", "_to").agg(F.count(F.lit(1)).alias("_all"), F.count_if(outsider).alias("_outside"))
    facing = cost.select("token", F.col("_to").alias("_size"), F.col("_size").alias("_to"), F.col("_outside").alias("_pairs"))
    long = stored(
        cost.join(facing, ["token", "_size", "_to"]).groupBy("token").agg(F.sum(F.col("_all") * F.col("_pairs")).alias("_pairs"))
        .filter(F.col("_pairs") > long_list).select("token"),
        "shingle-long",
    )
    short = reach.join(long, "token", "left_anti")
    outside = short.filter(outsider).select("token", "node", "label", "n", "_size", "_to")
    others = short.select(
        "token", F.col("node").alias("node2"), F.col("label").alias("label2"), F.col("n").alias("m"), F.col("_to").alias("_size"),
        F.col("_size").alias("_to"), (F.col("label") == F.col("main")).alias("is_main"),
    )
    crossing = stored(
        outside.join(others, ["token", "_size", "_to"]).filter(_close(percent))
        .filter("label <> label2 and (is_main or node < node2)")
        .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()
        .join(star, ["a", "b"], "left_anti"),
        "shingle-pairs",
    )
    crossing = stored(_sharing_enough(crossing, nodes, percent), "shingle-pairs")
    around = stored(
        reach.select("token", "node").distinct().join(long, "token")
        .join(leaders, "token").select(F.col("_top.b").alias("a"), F.col("node").alias("b")).filter("a <> b").distinct(),
        "shingle-around",
    )
    more = _verified(crossing, docs, nodes, size, percent)
    if not around.isEmpty():
        more = more.unionByName(_linked_by_differences(around, docs, nodes, links, size, percent))
    more = stored(more, "shingle-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    member = nodes.select("key", "node", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = member.groupBy("label").agg(F.min("least").alias("component_id"))
    named = member.join(smallest, "label").select("key", "component_id")
    return (
        keyed.select("id", "key", "n").join(named, "key", "left")
        .select(
            F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id, all
    columns kept under any names.  Rows with that id stay together; texts without words all
    stay, and so do rows without an id."""
    found = join(docs, id_col, text_col, **options)
    gone = found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    left = rows.join(gone, F.col(f"_row.`{id_col}`") == F.col("_gone"), "left_anti")
    return left.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
