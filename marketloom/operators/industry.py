"""Industry assignments resolved against a sectioned code dictionary.

The dictionary is a small dimension: Spark broadcasts it by its size, with an
ordinary shuffle join beyond the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dictionary sections holding Shenwan codes.
TREE_SECTION = "TDXRSHY"
DIGIT_SECTION = "SWHY"


def clean_dictionary(dictionary: DataFrame) -> DataFrame:
    trimmed = dictionary.select(
        F.trim("source").alias("source"), F.trim("code").alias("code"), F.trim("name").alias("name"), "line_no"
    )
    return trimmed.where((F.col("source") != "") & (F.col("code") != "") & (F.col("name") != ""))


def _first(dictionary: DataFrame, *keys: str) -> DataFrame:
    """First dictionary line of each key."""
    rest = [n for n in ("source", "code", "name") if n not in keys]
    return dictionary.groupBy(*keys).agg(*[F.min_by(n, "line_no").alias(n) for n in rest])


def industry_levels(section: Column, code: Column) -> list[Column]:
    """Codes of levels 1-3 of a matched Shenwan code."""
    tree = (section == TREE_SECTION) & code.rlike("^X(?:[0-9]{2}){1,3}$")
    digits = (section == DIGIT_SECTION) & code.rlike("^[0-9]{6}$")
    length = F.length(code)
    first = F.when(tree, F.substring(code, 1, 3)).when(digits, F.concat(F.substring(code, 1, 2), F.lit("0000")))
    second = F.when(tree & (length >= 5), F.substring(code, 1, 5)).when(
        digits & (F.substring(code, 3, 4) != "0000"), F.concat(F.substring(code, 1, 4), F.lit("00"))
    )
    third = F.when(tree & (length == 7), code).when(digits & (F.substring(code, 5, 2) != "00"), code)
    return [first, second, third]


def associate_industries(assignments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add names, sections and Shenwan levels to assignments; unknown codes stay.

    A full code matches first.  Only a Shenwan code starting with X may then match
    without the X, inside the digit section.  Level names come from the section that
    matched.
    """
    clean = clean_dictionary(dictionary)
    exact = _first(clean, "code")
    digit_codes = _first(clean.where(F.col("source") == DIGIT_SECTION), "code")
    names = _first(clean, "source", "code")

    def prefixed(table: DataFrame, prefix: str) -> DataFrame:
        return table.select(*[F.col(n).alias(f"{prefix}_{n}") for n in table.columns])

    tdx, sw, bare = prefixed(exact, "_tdx"), prefixed(exact, "_sw"), prefixed(digit_codes, "_bare")
    sw_code = F.trim("sw_industry_code")
    joined = (
        assignments.join(tdx, F.trim("tdx_industry_code") == F.col("_tdx_code"), "left")
        .join(sw, sw_code == F.col("_sw_code"), "left")
        .join(
            bare,
            sw_code.startswith("X") & (F.expr("substring(trim(sw_industry_code), 2)") == F.col("_bare_code")),
            "left",
        )
    )
    matched = joined.select(
        *assignments.columns,
        F.col("_tdx_name").alias("tdx_industry_name"),
        F.col("_tdx_source").alias("tdx_industry_source"),
        *[F.coalesce(f"_sw_{n}", f"_bare_{n}").alias(f"_m_{n}") for n in ("name", "source", "code")],
    )
    levels = industry_levels(F.col("_m_source"), F.col("_m_code"))
    out = matched.withColumns({f"sw_level{i}_code": level for i, level in enumerate(levels, 1)})
    for i in (1, 2, 3):
        level = names.select(
            F.col("source").alias("_s"), F.col("code").alias("_c"), F.col("name").alias(f"sw_level{i}_name")
        )
        out = out.join(
            level, (F.col("_m_source") == F.col("_s")) & (F.col(f"sw_level{i}_code") == F.col("_c")), "left"
        ).drop("_s", "_c")
    return out.withColumnsRenamed({"_m_name": "sw_industry_name", "_m_source": "sw_industry_source"}).drop("_m_code")


def unresolved_codes(resolved: DataFrame) -> DataFrame:
    """Distinct non-blank codes of either system that matched nothing, one per row in
    code order: a report can be long, so it stays a table."""
    pairs = F.array(
        F.struct(F.trim("tdx_industry_code").alias("code"), F.col("tdx_industry_name").alias("name")),
        F.struct(F.trim("sw_industry_code").alias("code"), F.col("sw_industry_name").alias("name")),
    )
    return (
        resolved.select(F.inline(pairs))
        .where(F.col("name").isNull() & (F.col("code") != ""))
        .select("code")
        .distinct()
        .orderBy("code")
    )


def stock_block_index(statistics: DataFrame) -> DataFrame:
    """Security code -> block; blank blocks dropped, the last line wins."""
    return (
        statistics.where(F.coalesce(F.col("block_index"), F.lit("")) != "")
        .groupBy("code")
        .agg(F.max_by("block_index", "line_no").alias("block_index"))
    )


def group_blocks(flat: DataFrame, keys: tuple[str, ...] = ("blockname", "block_type")) -> DataFrame:
    """Grouped form of flat block rows: count and comma list in index order.

    The comma list is the reference's output; a vendor block holds at most 400 codes.
    """
    ordered = F.array_sort(F.collect_list(F.struct("code_index", "code")))
    return flat.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("stock_count"),
        F.array_join(F.transform(ordered, lambda e: e["code"]), ",").alias("code_list"),
    )
