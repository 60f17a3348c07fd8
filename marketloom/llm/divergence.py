"""Divergence of each source's vocabulary from its language and from the other sources.

A term's share in a group (language and source) depends on its count there alone, so the
divergence of two groups is a price per pair of *count levels* times the number of terms at
that pair.  Those joint tables are the product of a one-hot matrix (a row per term, a column
per group and level) with its transpose.  Terms are dealt into row blocks; inside a block the
product is taken tile by tile over blocks of columns, in floats that hold these counts
exactly, and what the blocks found is added up by Spark.

Level zero has no column.  With f(a, b) the price, J the joint counts of positive levels, and
M and M' how many terms each group has at a level, the sum over all V terms is

    V f(0,0) + sum_a M(a) (f(a,0) - f(0,0)) + sum_b M'(b) (f(0,b) - f(0,0))
             + sum_ab J(a,b) (f(a,b) - f(a,0) - f(0,b) + f(0,0)),

which is exact, since f is a whole number.

Terms are counted in Arrow tasks (words told apart by their bytes, combined per piece of
text) and added up with map-side combine, so a source with a third of all rows reaches the
shuffle as one row per task and term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.common import stored, whole_text
from marketloom.llm.text_arrays import LOWER, bytes_of, pieces

PIECE = 8_000_000  # bytes of text counted at once
ROWS = 256  # terms of a row block
COLUMNS = 512  # indicator columns of a tile side

#: Bytes of terms: ASCII letters, and all of code points beyond ASCII.
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of every term of the texts, and the distinct terms by code."""
    inside = _IN_TERM[data]
    cut = np.zeros(len(data) + 1, dtype=bool)  # a row begins here
    cut[offsets] = True
    starts = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | cut[:-1])) if len(data) else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, starts, "right") - 1
    # The terms' bytes side by side; they lie in the order of their starts.
    ends = np.append(np.searchsorted(np.flatnonzero(inside), starts), inside.sum()).astype(np.int64)
    joined = LOWER[data[inside]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(joined.tobytes()))
    encoded = words.dictionary_encode()
    return row, encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of each group's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"])
            names = [(k["lang"], k["source"]) for k in keys.to_pylist()]
            known = {name: k for k, name in enumerate(dict.fromkeys(names))}
            group_of = np.array([known[name] for name in names], dtype=np.int64)
            langs, sources = (pa.array([name[k] for name in known], pa.string()) for k in (0, 1))
            for first, last, data, offsets in pieces(*bytes_of(batch.column(2)), PIECE):
                row, code, terms = term_table(data, offsets)
                if not len(row):
                    continue
                own, times = np.unique(row * len(terms) + code, return_counts=True)
                row, code = own // len(terms), own % len(terms)
                found, at = np.unique(group_of[first:last][row] * len(terms) + code, return_inverse=True)
                group = pa.array(found // len(terms))
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.take(group), sources.take(group), terms.take(pa.array(found % len(terms))).cast(pa.string()),
                        pa.array(np.bincount(at, weights=times).astype(np.int64)), pa.array(np.bincount(at)),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

    rows = docs.select(*[whole_text(F.col(c).cast("string")).alias(f"_{k}") for k, c in enumerate([lang_col, source_col, text_col])])
    counted = rows.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def one_hot_products(
    term: np.ndarray, source: np.ndarray, level: np.ndarray, rows: int = ROWS, columns: int = COLUMNS
) -> tuple[np.ndarray, ...]:
    """Joint counts ``source a, level a, source b, level b, n`` with a < b, of entries
    sorted by term (each term and source once, levels positive)."""
    parts = []
    begins = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
    edges = np.append(begins, len(term))
    for low in range(0, len(begins), rows):
        span = slice(edges[low], edges[min(low + rows, len(begins))])
        own = np.unique(term[span], return_inverse=True)[1]
        column, at = np.unique(np.column_stack([source[span], level[span]]), axis=0, return_inverse=True)
        hot = np.zeros((own.max() + 1, len(column)), dtype=np.float32)  # exact: counts are at most `rows`
        hot[own, at.ravel()] = 1
        for i in range(0, len(column), columns):
            for j in range(i, len(column), columns):
                x, y = np.nonzero(product := hot[:, i : i + columns].T @ hot[:, j : j + columns])
                good = column[x + i, 0] < column[y + j, 0]
                x, y = x[good], y[good]
                parts.append(np.column_stack([column[x + i], column[y + j], product[x, y].astype(np.int64)]))
    table = np.concatenate([np.zeros((0, 5), np.int64), *parts])
    cells, at = np.unique(table[:, :4], axis=0, return_inverse=True)
    return *cells.T, np.bincount(at.ravel(), weights=table[:, 4], minlength=len(cells)).astype(np.int64)


def joint_levels(terms: DataFrame) -> DataFrame:
    """``lang, source, level, other, other_level, n``: how many terms have these two counts
    in two sources (source < other), from rows ``lang, total, sources[(source, n)]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            lists = batch.column(2)
            inner = lists.flatten()
            sources = inner.field(0).dictionary_encode()
            names = sources.dictionary.take(pc.sort_indices(sources.dictionary))
            place = pc.index_in(sources.dictionary, names).to_numpy()
            source, level = place[sources.indices.to_numpy()].astype(np.int64), inner.field(1).to_numpy()
            length = pc.list_value_length(lists).to_numpy()
            row = np.repeat(np.arange(len(length)), length)
            lang, total = langs.indices.to_numpy(), batch.column(1).to_numpy()
            for k, name in enumerate(langs.dictionary.to_pylist()):
                # Terms of like counts side by side: fewer levels in a block.
                chosen = np.flatnonzero(lang[row] == k)
                chosen = chosen[np.lexsort([row[chosen], total[row[chosen]]])]
                a, la, b, lb, n = one_hot_products(row[chosen], source[chosen], level[chosen])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(a), pa.string()), names.take(pa.array(a)), pa.array(la), names.take(pa.array(b)), pa.array(lb), pa.array(n)],
                    ["lang", "source", "level", "other", "other_level", "n"],
                )

    schema = "lang string, source string, level bigint, other string, other_level bigint, n bigint"
    found = terms.select("lang", "total", "sources").mapInArrow(run, schema)
    return found.groupBy("lang", "source", "level", "other", "other_level").agg(F.sum("n").alias("n"))


def share(count: str, size: str, terms: str) -> Column:
    """Smoothed share of a count, in billionths (decimals hold counts of any corpus)."""
    return F.expr(
        f"1 + (cast(1000000000 as decimal(10, 0)) * (cast({count} as decimal(19, 0)) + 1))"
        f" div (cast({size} as decimal(19, 0)) + cast({terms} as decimal(19, 0)))"
    )


def price(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def audit(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 3, top: int = 200
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source's terms are from the
    other sources of its language (part ``pair``, all of them) and which terms it uses more
    than its language does (part ``term``, the ``top`` first).

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; a language
    keeps those in at least ``min_docs`` of its documents.

    * Null texts, languages and sources count as ''; groups without terms take part with
      count 0, and a language without kept terms has pairs of value 0.
    * Every row is a document, repeated ones too.  Ties are ranked by the item's UTF-8 bytes.
    * Other columns are ignored; an empty table gives an empty result.
    """
    lang, source = (whole_text(F.col(c).cast("string")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source")))
    groups = stored(docs.select(lang, source).distinct(), "term-groups")
    terms = stored(
        term_counts(docs, lang_col, source_col, text_col)
        .groupBy("lang", "term").agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources")
        )
        .filter(F.col("docs") >= min_docs).drop("docs"),
        "kept-terms",
    )
    each = terms.select("lang", "term", "total", F.explode("sources").alias("_own")).select(
        "lang", "term", "total", F.col("_own.source").alias("source"), F.col("_own.n").alias("n")
    )
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_size"))
    levels = stored(each.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("at")).withColumnRenamed("n", "level"), "term-levels")
    known = stored(
        groups.join(levels.groupBy("lang", "source").agg(F.sum(F.col("level") * F.col("at")).alias("size")), ["lang", "source"], "left")
        .join(sizes, "lang", "left").na.fill(0, ["size", "terms", "lang_size"]),
        "term-group-sizes",
    )

    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = _pair_values(terms, levels, known).withColumnRenamed("other", "item").withColumn("rank", ranked)
    valued = (
        each.join(known, ["lang", "source"])
        .withColumns({"_p": share("n", "size", "terms"), "_q": share("total", "lang_size", "terms")}).filter("_p > _q")
        .select("lang", "source", F.col("term").alias("item"), price("_p", "_q").alias("value"))
        .withColumn("rank", ranked).filter(F.col("rank") <= top)
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).unionByName(valued.withColumn("part", F.lit("term")).select(*columns))


def _pair_values(terms: DataFrame, levels: DataFrame, known: DataFrame) -> DataFrame:
    """``lang, source, other, value`` of every ordered pair of sources of a language."""
    other = known.select("lang", F.col("source").alias("other"), F.col("size").alias("other_size"))
    pairs = known.select("lang", "source", "size", "terms").join(other, "lang").filter("source <> other")
    # Prices are of no use where a language keeps no term.
    priced = pairs.filter("terms > 0").withColumns({"_p0": share("0", "size", "terms"), "_q0": share("0", "other_size", "terms")})
    priced = priced.withColumn("_f00", price("_p0", "_q0"))
    both = stored(joint_levels(terms), "joint-levels")
    both = both.unionByName(
        both.select("lang", F.col("other").alias("source"), F.col("other_level").alias("level"), F.col("source").alias("other"), F.col("level").alias("other_level"), "n")
    )
    cells = both.join(priced, ["lang", "source", "other"]).withColumns(
        {"_p": share("level", "size", "terms"), "_q": share("other_level", "other_size", "terms")}
    )
    left = priced.join(levels, ["lang", "source"]).withColumn("_p", share("level", "size", "terms"))
    right = priced.join(levels.withColumnRenamed("source", "other"), ["lang", "other"]).withColumn("_q", share("level", "other_size", "terms"))
    key = ["lang", "source", "other"]
    wide = "decimal(38,0)"
    found = (
        cells.select(*key, (F.col("n").cast("decimal(18,0)") * (price("_p", "_q") - price("_p", "_q0") - price("_p0", "_q") + F.col("_f00"))).cast(wide).alias("value"))
        .unionByName(left.select(*key, (F.col("at").cast("decimal(18,0)") * (price("_p", "_q0") - F.col("_f00"))).cast(wide).alias("value")))
        .unionByName(right.select(*key, (F.col("at").cast("decimal(18,0)") * (price("_p0", "_q") - F.col("_f00"))).cast(wide).alias("value")))
        .unionByName(priced.select(*key, (F.col("terms").cast("decimal(18,0)") * F.col("_f00")).cast(wide).alias("value")))
        .unionByName(pairs.filter("terms = 0").select(*key, F.lit(0).cast(wide).alias("value")))
    )
    return found.groupBy(*key).agg(F.sum("value").cast("bigint").alias("value"))
