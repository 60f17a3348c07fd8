"""Company-document text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.numbers import as_column

# Unicode white space except the line feed.
_BLANKS = "".join(
    map(
        chr,
        [0x09, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def normalize_document(text) -> Column:
    """LF line ends, no trailing blanks, at most one empty line in a row, no outer
    empty lines; NULL becomes ''.

    Lines are trimmed from their end, so long runs of blanks inside a line cost
    nothing; only the runs of line feeds need a pattern.
    """
    text = F.coalesce(as_column(text), F.lit(""))
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.transform(F.split(text, "\n"), lambda line: F.rtrim(line, F.lit(_BLANKS)))
    return F.btrim(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"), F.lit("\n"))
