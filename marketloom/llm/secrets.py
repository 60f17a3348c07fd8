"""Secret scans: all rules in one automaton, one pass over the bytes.

The rules' patterns are compiled together (:mod:`automaton`) once per Python worker; each
Arrow batch is scanned piece by piece.  No shuffle: every document is scanned where it is
read, and memory is bounded by the piece (or the longest text).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.automaton import Scanner
from marketloom.llm.text_arrays import bytes_of, pieces


@dataclass(frozen=True)
class Rule:
    """Matches shorter than ``least``, or with fewer than ``least_value`` bytes after ``:`` or
    ``=``, are dropped after they were found."""

    name: str
    pattern: str
    least_value: int = 0
    least: int = 0


#: The base rules come first.  Lengths are checked after the search, as a dropped match
#: still uses up its text.  Only for hex digits, which are everywhere, the automaton counts:
#: runs of 24 at least are the runs of any length without the short ones.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+""", 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hosting", r"gh[pousr]_[A-Za-z0-9]+", least=40),
)
BASE = 3


@cache
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner([r.pattern for r in rules])


def _fails(rule: Rule, raw: bytes, start: int, end: int) -> bool:
    """Whether a match is shorter than the rule asks, or the value at its end: that begins
    after the first ``:`` or ``=``, blanks and an opening quote."""
    if not rule.least_value:
        return end - start < rule.least
    at = min(k for k in (raw.find(b":", start, end), raw.find(b"=", start, end)) if k >= 0) + 1
    while at < end and raw[at] == 0x20:
        at += 1
    if at < end and raw[at] in b"\"'":
        at += 1
    return end - at < rule.least_value


def spans_of(rules: tuple[Rule, ...], data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Per row that has any: (start, rule, end) in code points, by start, then rule."""
    found = {}
    for row, spans in _scanner(rules).spans(data, offsets).items():
        text = data[offsets[row] : offsets[row + 1]]
        raw = text.tobytes()
        good = [(s, k, e) for k, s, e in spans if not _fails(rules[k], raw, s, e)]
        if good:
            points = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
            found[row] = sorted((int(points[s]), k, int(points[e])) for s, k, e in good)
    return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``<id>`` and ``spans``, an array of ``kind, start, end`` (code
    points, end exclusive) ordered by start, then by the order of the rules.

    * A null or empty text has no spans; repeated rows are scanned each for itself.
    * Null ids stay; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    kinds = [r.name for r in rules]
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, list[dict]] = {}
            for first, _, data, offsets in pieces(*bytes_of(batch.column(1))):
                for row, spans in spans_of(rules, data, offsets).items():
                    found[first + row] = [{"kind": kinds[k], "start": s, "end": e} for s, k, e in spans]
            lists = pa.array([found.get(i, []) for i in range(batch.num_rows)], pa.list_(span))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "spans"])

    return rows.mapInArrow(run, f"id {id_type}, spans array<struct<kind:string,start:bigint,end:bigint>>").withColumnRenamed(
        "id", id_col
    )


def digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = BASE) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as one text."""
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    names = [r.name for r in rules[:base]]
    in_base = F.filter("spans", lambda x: x["kind"].isin(names))

    def count(name: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == name)).cast("bigint")

    counts = {f"n_{name}": count(name) for name in names}
    return scanned.withColumns(
        counts
        | {
            "base_sha256": F.sha2(F.concat_ws(",", F.transform(in_base, text)), 256),
            "spans": F.concat_ws(",", F.transform("spans", text)),
        }
    )


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[secret]") -> str:
    """The text with its spans replaced; overlapping spans are replaced once."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
