"""Lines that many documents share, dropped from all documents but one.

Lines are exploded with their position, normalised (white space stripped at both ends, A-Z
lower-cased) and hashed to 128 bits; only the hashes leave the row, never the line.  A hash
found in enough distinct documents is dropped everywhere but in the greatest id that holds
it.  Each document gets the positions it loses and is put together again from the runs of
lines between them, so the work is linear in its lines.

Distinct documents are counted with map-side combine, so a line in a third of all documents
reaches the last shuffle as one row per task; the join back to its places has one row of
that hash on the small side, and Spark splits the other where it is skewed.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored, whole_text

_BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without outer white space, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_BLANK)), ascii_uppercase, ascii_lowercase)


def _hashes(lines: Column, min_chars: int) -> Column:
    """Hash of each line's key; null for keys that are too short to count."""
    keys = F.transform(lines, line_key)
    return F.transform(keys, lambda key: F.when(F.length(key) >= min_chars, F.unhex(F.md5(key))))


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """One row per document: ``_row`` (the input row as a struct), ``n_lines`` (before),
    ``n_dropped`` and ``kept`` (the text that stays).

    Keys of at least ``min_chars`` code points that occur in at least ``min_docs`` documents
    lose all their lines except in the greatest id that holds them.

    * A null or empty text is one empty line; a document that loses all lines keeps ''.
    * Rows that repeat both id and text count as one document; each of them is returned.
      Rows that repeat an id with other texts are several documents, and all that carry the
      greatest id keep the line.
    * A null id is the least of all: such a row keeps a shared line only where no holder of
      the line has an id.
    * Ids may be of any type with an order.  Other columns pass through in ``_row`` under any
      names; an empty table gives an empty result.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(id_col).alias("_id"),
        whole_text(F.col(text_col).cast("string")).alias("_text"),
    ).withColumn("_doc", F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("_id").cast("string"), F.lit("")), "_text"))))
    placed = stored(
        rows.select("_doc", "_id", F.posexplode(_hashes(F.split("_text", "\n"), min_chars)).alias("_at", "_hash"))
        .filter("_hash is not null"),
        "line-hashes",
    )
    shared = (
        placed.groupBy("_hash").agg(F.countDistinct("_doc").alias("_docs"), F.max("_id").alias("_keeper"))
        .filter(F.col("_docs") >= min_docs)
    )
    lost = (
        placed.join(shared, "_hash").filter(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_doc").agg(F.array_sort(F.collect_set("_at")).alias("_lost"))
    )
    # Runs of lines between the lost ones.
    none = F.array().cast("array<int>")
    found = rows.drop("_id").join(lost, "_doc", "left").select(
        "_row", F.split("_text", "\n").alias("_lines"), F.coalesce("_lost", none).alias("_lost")
    )
    before = F.concat(F.array(F.lit(-1)), "_lost")
    after = F.concat("_lost", F.array(F.size("_lines")))
    runs = F.zip_with(before, after, lambda a, b: F.slice("_lines", a + 2, b - a - 1))
    return found.select(
        "_row",
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size("_lost").cast("bigint").alias("n_dropped"),
        F.when(F.size("_lost") == 0, whole_text(F.col(f"_row.`{text_col}`").cast("string")))
        .otherwise(F.array_join(F.flatten(runs), "\n")).alias("kept"),
    )
