"""Capital-flow queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketloom.operators import capital_flow as flow
from marketloom.operators.selection import window_days as window_days_of
from marketloom.plans import recipes
from marketloom.plans import tables as t
from marketloom.plans.oracle_views import with_views
from marketloom.plans.registry import query
from marketloom.session import shared_scratch
from marketloom.sources.flow_table import FlowTable

SERIES = ("market", "code")

_TIERED = """tiered as (
    select *, case when amount > 1000000 then '超大单' when amount > 200000 then '大单'
                   when amount > 40000 then '中单' else '小单' end as tier from v_ticks)"""
_LEVELS = """levels(level_no, level, tiers) as (values
    (0, '超大单', ['超大单']), (1, '大单', ['大单']), (2, '中单', ['中单']), (3, '小单', ['小单']),
    (4, '主力(超大+大单)', ['超大单', '大单']), (5, '散户(中+小单)', ['中单', '小单']),
    (6, '合计', ['超大单', '大单', '中单', '小单']))"""


def _levels_sql(key: str, shown: str) -> str:
    """Seven levels per ``key`` (a column expression over v_ticks)."""
    return with_views(
        "v_ticks",
        f"""select {shown}, level_no, level,
       coalesce(sum(ba), 0)::double as buy_amount, coalesce(sum(sa), 0)::double as sell_amount,
       coalesce(sum(ba) - sum(sa), 0)::double as net_amount,
       round(coalesce(sum(ba) - sum(sa), 0)::double / any_value(total)::double * 100, 2) as net_pct,
       coalesce(sum(bv), 0)::double as buy_volume, coalesce(sum(sv), 0)::double as sell_volume,
       coalesce(sum(bv) - sum(sv), 0)::double as net_volume
from totals cross join levels left join sums on sums.k = totals.k and list_contains(tiers, tier)
group by totals.k, level_no, level""",
        _TIERED,
        _LEVELS,
        f"totals as (select {key} as k, sum(amount) as total from tiered group by k)",
        f"""sums as (select {key} as k, tier,
       coalesce(sum(amount) filter (where side = 0), 0) as ba, coalesce(sum(amount) filter (where side = 1), 0) as sa,
       coalesce(sum(vol) filter (where side = 0), 0) as bv, coalesce(sum(vol) filter (where side = 1), 0) as sv
       from tiered group by k, tier)""",
    )


@query("capital_flow", _levels_sql("code", "totals.k as code"))
def capital_flow(spark, sf_dir):
    sums = flow.flow_sums(t.ticks(spark, sf_dir), SERIES)
    return flow.capital_flow(sums, SERIES).drop("market")


@query(
    "capital_flow_by_day",
    _levels_sql("{'c': code, 'd': date}", "totals.k.c as code, totals.k.d::varchar as date"),
)
def capital_flow_by_day(spark, sf_dir):
    sums = flow.flow_sums(t.ticks(spark, sf_dir))
    return flow.capital_flow(sums).drop("market").withColumn("date", t.text("date"))


@query(
    "flow_summary",
    with_views(
        "v_minute_ticks",
        """select code, coalesce(mainu, 0) / 10000 as main_net,
       case when totalu > 0 then round(coalesce(mainu, 0) / totalu * 100, 2) else 0 end as main_net_pct,
       coalesce(retailu, 0) / 10000 as retail_net,
       case when totalu > 0 then round(coalesce(retailu, 0) / totalu * 100, 2) else 0 end as retail_net_pct,
       coalesce(totalu, 0) / 10000 as total_turnover, coalesce(totalv, 0)::double as total_volume,
       coalesce(neutralu, 0) / 10000 as neutral_turnover, trade_count, excluded_trade_count,
       concat_ws(',', case when side_5 > 0 then '5:' || side_5 end,
                      case when side_8 > 0 then '8:' || side_8 end) as unknown_sides
from s""",
        """ok as (select *, side in (0, 1, 2) and price > 0 and vol > 0 as valid,
       round(price * vol * 100 * 10000)::bigint as units from v_minute_ticks)""",
        """s as (select code,
       sum(case when side = 0 then units else -units end) filter (where valid and side < 2 and units > 2000000000) as mainu,
       sum(case when side = 0 then units else -units end) filter (where valid and side < 2 and units <= 2000000000) as retailu,
       sum(units) filter (where valid) as totalu, sum(vol) filter (where valid) as totalv,
       sum(units) filter (where valid and side = 2) as neutralu,
       count(*) filter (where valid) as trade_count, count(*) filter (where not valid) as excluded_trade_count,
       count(*) filter (where side = 5) as side_5, count(*) filter (where side = 8) as side_8
       from ok group by code)""",
    ),
)
def flow_summary(spark, sf_dir):
    """Summary with the counts of unrecognized sides (5 and 8 among the events)."""
    ticks = t.minute_ticks(spark, sf_dir)
    summary = flow.flow_summary(flow.flow_sums(ticks, SERIES), SERIES)
    sides = flow.unknown_side_counts(ticks, SERIES)
    listed = F.transform(
        F.array_sort(F.map_entries("unknown_side_counts")), lambda e: F.concat_ws(":", e["key"], e["value"])
    )
    return (
        summary.join(sides, list(SERIES), "left")
        .withColumn("unknown_sides", F.coalesce(F.array_join(listed, ","), F.lit("")))
        .select(
            "code", "main_net", "main_net_pct", "retail_net", "retail_net_pct", "total_turnover",
            "total_volume", "neutral_turnover", "trade_count", "excluded_trade_count", "unknown_sides",
        )
    )


def _rolling_sql(days: int) -> str:
    windows = []
    for k in (5, 20):
        full = f"count(*) over w{k} = {k}"
        windows.append(
            f"""case when {full} then sum(main_net) over w{k} end::double as main_{k}d_net,
       case when {full} then round((sum(main_net) over w{k})::double / (sum(total) over w{k})::double * 100, 2) end as main_{k}d_pct,
       least(row_number() over (partition by code order by date), {k})::int as window_{k}d_days,
       ({full})::int as window_{k}d_complete,
       case when {full} then sum(retail_net) over w{k} end::double as retail_{k}d_net,
       case when {full} then sum(total) over w{k} end::double as total_{k}d_amount"""
        )
    return with_views(
        "v_flow v_bars",
        "select * exclude (age), from rolled where age <= " + str(days),
        f"""daily as (
       select code, date, close, round((close / lag(close) over (partition by code order by date) - 1) * 100, 2) as change_pct,
              coalesce(main_net, 0) as main_net, coalesce(retail_net, 0) as retail_net, total, coalesce(super_net, 0) as super_net,
              coalesce(large_net, 0) as large_net, coalesce(medium_net, 0) as medium_net, coalesce(small_net, 0) as small_net,
              row_number() over (partition by code order by date desc) as age
       from v_bars join v_flow using (code, date))""",
        f"warm as (select * from daily where age <= {days} + 19)",
        f"""rolled as (select code, date::varchar as date, close, change_pct, total::double as total_amount,
       main_net::double as main_net, round(main_net::double / total::double * 100, 2) as main_pct,
       retail_net::double as retail_net, round(retail_net::double / total::double * 100, 2) as retail_pct, super_net::double as super_net,
       large_net::double as large_net, medium_net::double as medium_net, small_net::double as small_net, 'ok' as status, age,
       {', '.join(windows)}
       from warm window w5 as (partition by code order by date rows 4 preceding),
                        w20 as (partition by code order by date rows 19 preceding))""",
    ).replace("exclude (age), from", "exclude (age) from")


def _history(spark, sf_dir, days, kept=None):
    history = recipes.flow_history(t.bars(spark, sf_dir), t.ticks(spark, sf_dir), days, kept=kept)
    return history.withColumns(
        {
            "date": t.text("date"),
            **{f"window_{k}d_complete": F.col(f"window_{k}d_complete").cast("int") for k in (5, 20)},
        }
    ).drop("market")


@query("flow_history", _rolling_sql(20))
def flow_history(spark, sf_dir):
    return _history(spark, sf_dir, 20)


@query("flow_history_full", _rolling_sql(100_000))
def flow_history_full(spark, sf_dir):
    """Every day of every security, not only the last twenty."""
    return _history(spark, sf_dir, None)


@query("kept_flow_history", _rolling_sql(20))
def kept_flow_history(spark, sf_dir):
    """The history from kept daily flow up to the middle of 1998 and ticks after it."""
    kept = FlowTable(spark, f"{shared_scratch(spark)}/flow-{uuid.uuid4().hex}")
    past = t.ticks(spark, sf_dir).where(F.col("date") <= F.lit("1998-06-30").cast("date"))
    kept.close_days(flow.flow_summary(flow.flow_sums(past)))
    return _history(spark, sf_dir, 20, kept)


_SECTOR_VIEWS = "v_ticks v_members"
_PER_CODE = """f as (
    select code, sum(case side when 0 then amount when 1 then -amount else 0 end) filter (where amount > 200000) as main_net,
           sum(case side when 0 then amount when 1 then -amount else 0 end) filter (where amount <= 200000) as retail_net,
           sum(case side when 0 then amount when 1 then -amount else 0 end) filter (where amount > 1000000) as super_net,
           sum(case side when 0 then amount when 1 then -amount else 0 end) filter (where amount > 200000 and amount <= 1000000) as large_net,
           sum(amount) as total from v_ticks group by code)"""
_JOINED = """j as (select sector, m.code, f.code as traded, coalesce(main_net, 0) as main_net, coalesce(retail_net, 0) as retail_net,
    coalesce(super_net, 0) as super_net, coalesce(large_net, 0) as large_net, coalesce(total, 0) as total
    from (select distinct sector, code from v_members) m left join f using (code))"""


@query(
    "sector_flow",
    with_views(
        _SECTOR_VIEWS,
        """select sector, case when ok then 'ok' else 'missing_trades' end as status, stock_count,
       case when ok then main_net end as main_net, case when ok then retail_net end as retail_net,
       case when ok then super_net end as super_net, case when ok then large_net end as large_net,
       case when ok then total end as total_turnover,
       case when ok then round(main_net / total * 100, 2) end as main_net_pct,
       case when ok then top_in end as top_inflow_code, case when ok then top_out end as top_outflow_code
from (select sector, bool_and(traded is not null) as ok, count(*) as stock_count, sum(main_net)::double as main_net,
             sum(retail_net)::double as retail_net, sum(super_net)::double as super_net, sum(large_net)::double as large_net,
             sum(total)::double as total, first(code order by main_net desc, code) as top_in,
             last(code order by main_net desc, code) as top_out
      from j group by sector)""",
        _PER_CODE,
        _JOINED,
    ),
)
def sector_flow(spark, sf_dir):
    summary = flow.flow_summary(flow.flow_sums(t.ticks(spark, sf_dir), SERIES), SERIES)
    return flow.sector_flow(t.sector_membership(spark, sf_dir), summary)


@query(
    "sector_ranking",
    with_views(
        _SECTOR_VIEWS,
        """select sector, code, main_net::double as main_net, round(main_net::double / total::double * 100, 2) as main_pct,
       retail_net::double as retail_net, super_net::double as super_net, large_net::double as large_net,
       total::double as total_amount from j where traded is not null""",
        _PER_CODE,
        _JOINED,
    ),
)
def sector_ranking(spark, sf_dir):
    summary = flow.flow_summary(flow.flow_sums(t.ticks(spark, sf_dir), SERIES), SERIES)
    return flow.rank_members(t.sector_membership(spark, sf_dir), summary).drop("market")


@query(
    "sector_members",
    with_views(
        "",
        """select '00' || printf('%04d', s_suppkey) as code, n_name as tdx_industry_name,
       r_name as sw_industry_name
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where n_name like '%NATION_1%'""",
        "nothing as (select 1)",
    ),
)
def sector_members(spark, sf_dir):
    """No industry equals ATION_1, so the pattern rule applies."""
    nations = t.table(spark, sf_dir, "nation")
    regions = t.table(spark, sf_dir, "region")
    industries = (
        t.table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            t.security_code("s_suppkey").alias("code"),
            F.col("n_name").alias("tdx_industry_name"),
            F.col("r_name").alias("sw_industry_name"),
        )
    )
    return flow.sector_members(industries, "ATION_1")


@query(
    "window_days",
    with_views(
        "v_bars",
        """select code, date::varchar as date, least(row_number() over (partition by code order by date), 20) as window_days
from v_bars""",
    ),
)
def window_days(spark, sf_dir):
    return window_days_of(t.bars(spark, sf_dir).select("market", "code", "date"), 20).select(
        "code", t.text("date").alias("date"), "window_days"
    )


@query(
    "sector_report",
    with_views(
        _SECTOR_VIEWS,
        """select code, main_net::double as main_net, round(main_net::double / total::double * 100, 2) as main_pct, total::double as total_amount
from j where sector = 'ASIA' and traded is not null""",
        _PER_CODE,
        _JOINED,
    ),
)
def sector_report(spark, sf_dir):
    """Members of one region by main flow; the totals part is ``sector_flow``."""
    members = t.sector_membership(spark, sf_dir).where(~F.col("sector").startswith("NATION"))
    industries = members.select("market", "code", F.col("sector").alias("tdx_industry_name"))
    _, ranked = recipes.sector_report("ASIA", industries, t.ticks(spark, sf_dir), strict=False)
    return ranked.select("code", "main_net", "main_pct", "total_amount")
