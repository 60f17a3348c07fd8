"""Corporate-action queries: turnover, snapshots, price adjustment."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions.numbers import lots_to_shares, shares_to_lots, turnover_rate
from marketloom.functions.times import at_minute
from marketloom.operators import adjust, equity
from marketloom.plans import recipes
from marketloom.plans import tables as t
from marketloom.plans.oracle_views import with_views
from marketloom.plans.registry import query


def _shown(frame, digits=6, *extra):
    """Bars for output: no market, dates as text, prices rounded."""
    prices = [n for n in ("open", "high", "low", "close", *extra) if n in frame.columns]
    return frame.select("code", t.text("date").alias("date"), *t.rounded(digits, *prices), "volume")


_EQUITY = """equity as (select code, date, arg_max(float_equity, seq) as eq from v_actions where category = 5 group by code, date)"""


@query(
    "turnover",
    with_views(
        "v_bars v_actions",
        """select b.code, b.date::varchar as date, b.volume,
       round((case when e.eq > 0 then b.volume * 100 / e.eq * 100 end)::decimal(28, 10), 6)::double as turnover
from v_bars b asof left join equity e on b.code = e.code and b.date >= e.date""",
        _EQUITY,
    ),
)
def turnover(spark, sf_dir):
    out = equity.enrich_turnover(t.bars(spark, sf_dir), t.actions(spark, sf_dir))
    return out.select("code", t.text("date").alias("date"), "volume", *t.rounded(6, "turnover"))


@query(
    "turnover_rate",
    with_views(
        "v_bars",
        """select code, date::varchar as date,
       round((case when volume > 50 then (volume - 50) * 100 / 100000 * 100 else 0 end)::decimal(28, 10), 6)::double as turnover,
       ((volume - 50) * 100)::double as shares, floor((volume - 50) / 100)::bigint as lots
from v_bars""",
    ),
)
def turnover_scalar(spark, sf_dir):
    """The scalar rule: non-positive volume gives 0, not NULL."""
    volume = F.col("volume") - 50
    return t.bars(spark, sf_dir).select(
        "code",
        t.text("date").alias("date"),
        t.exact(turnover_rate(lots_to_shares(volume), F.lit(100_000.0)), 6).alias("turnover"),
        lots_to_shares(volume).alias("shares"),
        shares_to_lots(volume).alias("lots"),
    )


@query(
    "equity_snapshot",
    with_views(
        "v_actions",
        """select code, max(date)::varchar as date, arg_max(category, (date, seq)) as category,
       arg_max(float_equity, (date, seq))::bigint as float_equity, arg_max(total_equity, (date, seq))::bigint as total_equity
from v_actions where category = 5 and date <= date '1999-12-31' group by code""",
    ),
)
def equity_snapshot(spark, sf_dir):
    out = equity.equity_snapshot(t.actions(spark, sf_dir), at="1999-12-31")
    return out.drop("market").withColumn("date", t.text("date"))


@query(
    "category_names",
    with_views(
        "v_actions",
        """select category, case category when 1 then '除权除息' when 5 then '股本变化' else '扩缩股' end as category_name, count(*) as n
from v_actions group by category""",
    ),
)
def category_names(spark, sf_dir):
    events = equity.normalize_actions(t.actions(spark, sf_dir))
    return events.groupBy("category", "category_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "adjustment_factors",
    with_views(
        "v_qfq v_anchor",
        """select code, date::varchar as date, round((mul)::decimal(28, 10), 9)::double as qfq_mul, round((add)::decimal(28, 10), 9)::double as qfq_add,
       round((mul / mul0)::decimal(28, 10), 9)::double as hfq_mul, round(((add - add0) / mul0)::decimal(28, 10), 9)::double as hfq_add
from v_qfq join v_anchor using (code)""",
    ),
)
def adjustment_factors(spark, sf_dir):
    out = adjust.adjustment_factors(t.bars(spark, sf_dir), t.actions(spark, sf_dir))
    return out.select(
        "code", t.text("date").alias("date"), *t.rounded(9, "qfq_mul", "qfq_add", "hfq_mul", "hfq_add")
    )


def _adjust_sql(mul: str, add: str, digits: int) -> str:
    price = ", ".join(
        f"round(({p} * ({mul}) + ({add}))::decimal(28, 10), {digits})::double as {p}"
        for p in ("open", "high", "low", "close")
    )
    return with_views(
        "v_qfq v_anchor", f"select code, date::varchar as date, {price}, volume from v_qfq join v_anchor using (code)"
    )


@query("adjust_qfq", _adjust_sql("mul", "add", 2))
def adjust_qfq(spark, sf_dir):
    return _shown(adjust.adjust_prices(t.bars(spark, sf_dir), t.actions(spark, sf_dir), "qfq"))


@query("adjust_hfq", _adjust_sql("mul / mul0", "(add - add0) / mul0", 3))
def adjust_hfq(spark, sf_dir):
    return _shown(adjust.adjust_prices(t.bars(spark, sf_dir), t.actions(spark, sf_dir), "hfq", 3))


_PRECLOSE = """prev as (select *, lag(close) over (partition by code order by date) as pc,
                        lag(date) over (partition by code order by date) as pd from v_bars)"""
_GATHER = """gathered as (select p.code, p.date, pc,
        list({'p': 0::double, 'm': s.m::double, 'c': s.c::double} order by s.date, s.seq) filter (where s.m is not null) as steps
    from prev p left join v_steps s on s.code = p.code and s.date > p.pd and s.date <= p.date
    group by p.code, p.date, pc)"""
_FOLD = """folded as (select *, list_reduce(list_prepend({'p': coalesce(pc, 0)::double, 'm': 1::double, 'c': 0::double}, steps),
        lambda x, y: {'p': (x.p - y.c) / y.m, 'm': 1::double, 'c': 0::double}) as f from gathered)"""


@query(
    "preclose",
    with_views(
        "v_bars v_steps",
        """select code, date::varchar as date, case when pc is not null then round((f.p)::decimal(28, 10), 6)::double end as preclose from folded""",
        _PRECLOSE,
        _GATHER,
        _FOLD,
    ),
)
def preclose(spark, sf_dir):
    out = adjust.reference_preclose(t.bars(spark, sf_dir), t.actions(spark, sf_dir))
    return out.select("code", t.text("date").alias("date"), *t.rounded(6, "preclose"))


@query(
    "adjust_bars",
    with_views(
        "v_qfq v_bars v_steps",
        """select q.code, q.date::varchar as date, round((q.open * mul + add)::decimal(28, 10), 2)::double as open,
       round((q.close * mul + add)::decimal(28, 10), 2)::double as close,
       case when pc is not null then round((f.p * mul + add)::decimal(28, 10), 2)::double end as preclose,
       round((mul)::decimal(28, 10), 9)::double as adj, q.volume
from v_qfq q join folded using (code, date)
where round((q.open * mul + add)::decimal(28, 10), 2) <> 0""",
        _PRECLOSE,
        _GATHER,
        _FOLD,
    ),
)
def adjust_bars(spark, sf_dir):
    bars, actions = t.bars(spark, sf_dir), t.actions(spark, sf_dir)
    out = adjust.adjust_bars(bars, actions, "qfq")
    return out.select(
        "code", t.text("date").alias("date"), "open", "close", "preclose", t.exact("adj", 9).alias("adj"), "volume"
    )


@query(
    "iterative_forward_adjust",
    with_views(
        "v_bars v_actions",
        """select b.code, b.date::varchar as date, round((b.open * coalesce(f.mul, 1) + coalesce(f.add, 0))::decimal(28, 10), 6)::double as open,
       round((b.high * coalesce(f.mul, 1) + coalesce(f.add, 0))::decimal(28, 10), 6)::double as high, round((b.low * coalesce(f.mul, 1) + coalesce(f.add, 0))::decimal(28, 10), 6)::double as low,
       round((b.close * coalesce(f.mul, 1) + coalesce(f.add, 0))::decimal(28, 10), 6)::double as close, b.volume
from v_bars b asof left join f on b.code = f.code and f.date > b.date""",
        "s as (select code, date, seq, (10 + songzhuangu) / 10 as m, fenhong / 10 as c from v_actions)",
        "o as (select *, product(1 / m) over (partition by code order by date desc, seq desc) as reach from s)",
        """f as (select code, date, arg_min(mul, seq) as mul, arg_min(add, seq) as add
       from (select code, date, seq, reach as mul,
                    -sum(c * reach) over (partition by code order by date desc, seq desc) as add from o) group by code, date)""",
    ),
)
def iterative_forward_adjust(spark, sf_dir):
    return _shown(adjust.iterative_forward_adjust(t.bars(spark, sf_dir), t.actions(spark, sf_dir)))


def _factor_series(spark, sf_dir):
    """Order dates as an external factor series."""
    number = F.col("o_custkey") % t.supplier_count(spark, sf_dir)
    return (
        t.table(spark, sf_dir, "orders")
        .groupBy(t.market(), t.security_code(number).alias("code"), F.to_date("o_orderdate").alias("date"))
        .agg((1 + (F.max("o_orderkey") % 100) / 100).alias("factor"))
    )


_FACTOR_SQL = """factors as (select '00' || printf('%04d', o_custkey % (select count(*) from supplier)) as code,
       o_orderdate::date as date, 1 + (max(o_orderkey) % 100) / 100 as factor
    from orders group by all)"""


@query(
    "factor_adjust",
    with_views(
        "v_bars",
        """select a.code, date::varchar as date, round((open * f / l)::decimal(28, 10), 6)::double as open, round((close * f / l)::decimal(28, 10), 6)::double as close, round((f / l)::decimal(28, 10), 9)::double as factor
from a join ends using (code)""",
        _FACTOR_SQL,
        "firsts as (select code, arg_min(factor, date) as f0 from factors group by code)",
        """a as (select b.code, b.date, b.open, b.close, coalesce(x.factor, f0) as f
       from v_bars b asof left join factors x on b.code = x.code and b.date >= x.date left join firsts on b.code = firsts.code)""",
        "ends as (select code, arg_max(f, date) as l from a group by code)",
    ),
)
def factor_adjust(spark, sf_dir):
    out = adjust.factor_adjust(t.bars(spark, sf_dir), _factor_series(spark, sf_dir), "qfq")
    return out.select(
        "code", t.text("date").alias("date"), *t.rounded(6, "open", "close"), t.exact("factor", 9).alias("factor")
    )


@query(
    "factor_adjust_hfq",
    with_views(
        "v_bars",
        """select b.code, b.date::varchar as date, round((open * coalesce(x.factor, f0))::decimal(28, 10), 6)::double as open, round((close * coalesce(x.factor, f0))::decimal(28, 10), 6)::double as close,
       round(coalesce(x.factor, f0)::decimal(28, 10), 9)::double as factor
from v_bars b asof left join factors x on b.code = x.code and b.date >= x.date left join firsts on b.code = firsts.code""",
        _FACTOR_SQL,
        "firsts as (select code, arg_min(factor, date) as f0 from factors group by code)",
    ),
)
def factor_adjust_hfq(spark, sf_dir):
    out = adjust.factor_adjust(t.bars(spark, sf_dir), _factor_series(spark, sf_dir), "hfq")
    return out.select(
        "code", t.text("date").alias("date"), *t.rounded(6, "open", "close"), t.exact("factor", 9).alias("factor")
    )


def _legacy_sql(op: str) -> str:
    return with_views(
        "v_bars",
        f"""select code, min(date)::varchar as date, round((open {op} arg_min(factor, date))::decimal(28, 10), 6)::double as open, round((close {op} arg_min(factor, date))::decimal(28, 10), 6)::double as close,
       volume
from filled where open is not null and factor is not null group by code, open, high, low, close, volume""",
        _FACTOR_SQL,
        """filled as (select code, date,
       last_value(open ignore nulls) over w as open, last_value(high ignore nulls) over w as high,
       last_value(low ignore nulls) over w as low, last_value(close ignore nulls) over w as close,
       last_value(volume ignore nulls) over w as volume, last_value(factor ignore nulls) over w as factor
       from v_bars full join factors using (code, date) window w as (partition by code order by date rows unbounded preceding))""",
    )


def _legacy(spark, sf_dir, method):
    out = adjust.legacy_factor_adjust(t.bars(spark, sf_dir), _factor_series(spark, sf_dir), method)
    return out.select("code", t.text("date").alias("date"), *t.rounded(6, "open", "close"), "volume")


@query("legacy_factor_adjust", _legacy_sql("*"))
def legacy_factor_adjust(spark, sf_dir):
    return _legacy(spark, sf_dir, "hfq")


@query("legacy_factor_adjust_qfq", _legacy_sql("/"))
def legacy_factor_adjust_qfq(spark, sf_dir):
    return _legacy(spark, sf_dir, "qfq")


def _chain_sql(method: str, until: str | None = None) -> str:
    upto = f" and date <= date '{until}'" if until else ""
    if method == "qfq":
        frame, op = "rows between current row and unbounded following", "*"
    else:
        frame, op = "rows between unbounded preceding and current row", "/"
    return with_views(
        "v_bars v_actions",
        f"""select code, date::varchar as date, round((open {op} adj)::decimal(28, 10), 6)::double as open, round((close {op} adj)::decimal(28, 10), 6)::double as close,
       round((preclose {op} adj)::decimal(28, 10), 6)::double as preclose, round((adj)::decimal(28, 10), 9)::double as adj
from adjusted where traded""",
        f"""ev as (select code, date, arg_max(fenhong, seq) as fh, arg_max(songzhuangu, seq) as sz from v_actions where category = 1{upto}
       group by code, date)""",
        "starts as (select code, min(date) as d0 from v_bars group by code)",
        """line as (select code, date, b.open, b.close is not null as traded, coalesce(fh, 0) as fh, coalesce(sz, 0) as sz,
       last_value(b.close ignore nulls) over (partition by code order by date rows unbounded preceding) as close
       from v_bars b full join (select ev.* from ev join starts using (code) where date >= d0) using (code, date))""",
        """pre as (select *, (lag(close) over (partition by code order by date) * 10 - fh) / (10 + sz) as preclose from line)""",
        """ratio as (select *, coalesce(lead(preclose) over (partition by code order by date) / close, 1) as r from pre)""",
        f"adjusted as (select *, product(r) over (partition by code order by date {frame}) as adj from ratio)",
    )


@query("ratio_chain_qfq", _chain_sql("qfq"))
def ratio_chain_qfq(spark, sf_dir):
    return _chain(spark, sf_dir, "qfq")


@query("ratio_chain_hfq", _chain_sql("hfq"))
def ratio_chain_hfq(spark, sf_dir):
    return _chain(spark, sf_dir, "hfq")


@query("ratio_chain_qfq_until", _chain_sql("qfq", "1997-06-30"))
def ratio_chain_qfq_until(spark, sf_dir):
    """Events up to a date only."""
    return _chain(spark, sf_dir, "qfq", "1997-06-30")


@query("ratio_chain_hfq_until", _chain_sql("hfq", "1997-06-30"))
def ratio_chain_hfq_until(spark, sf_dir):
    return _chain(spark, sf_dir, "hfq", "1997-06-30")


def _minutes_sql(mul: str, add: str) -> str:
    """The close before a bar, carried through the events in between and adjusted like the
    bar, is that close adjusted by the factors of its own day."""
    shown = [f"round(({p} * {mul} + {add})::decimal(28, 10), 2)::double as {p}" for p in ("open", "high", "low", "close")]
    shown.append(f"round((lag(close * {mul} + {add}) over (partition by code order by ts))::decimal(28, 10), 2)::double as preclose")
    return with_views(
        "v_minute_ticks v_maps",
        f"select code, ts::varchar as ts, {', '.join(shown)}, volume from factored join anchor using (code)",
        """mbars as (select code, date, date + to_minutes(mod) as ts, arg_min(price, seq) as open, max(price) as high, min(price) as low,
           arg_max(price, seq) as close, sum(vol)::double as volume from v_minute_ticks group by code, date, mod)""",
        "ends as (select code, max(date) as hi from mbars group by code)",
        """moved as (select code, m.date + interval 20 years as date, mul, add from v_maps m join ends using (code) where m.date + interval 20 years <= hi)""",
        """late as (select code, date, product(mul) over w as mul, sum(add * beyond) over w as add
           from (select *, coalesce(product(mul) over (partition by code order by date desc
                                                       rows between unbounded preceding and 1 preceding), 1) as beyond from moved)
           window w as (partition by code order by date desc))""",
        """factored as (select b.*, coalesce(f.mul, 1) as mul, coalesce(f.add, 0) as add from mbars b asof left join late f
           on b.code = f.code and f.date > b.date)""",
        "anchor as (select code, arg_min(mul, ts) as mul0, arg_min(add, ts) as add0 from factored group by code)",
    )


def _minutes(spark, sf_dir, method):
    """Minute bars of the events, adjusted by all actions moved into their years."""
    ticks = t.minute_ticks(spark, sf_dir)
    bars = ticks.groupBy("market", "code", at_minute("date", "mod").alias("ts")).agg(
        F.min_by("price", "seq").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"), F.sum("vol").cast("double").alias("volume"),
    )
    moved = t.actions(spark, sf_dir).withColumn("date", F.add_months("date", 240))
    return adjust.adjust_intraday(bars, moved, method).drop("market").withColumn("ts", t.text("ts"))


@query("adjust_minutes", _minutes_sql("mul", "add"))
def adjust_minutes(spark, sf_dir):
    return _minutes(spark, sf_dir, "qfq")


@query("adjust_minutes_hfq", _minutes_sql("(mul / mul0)", "((add - add0) / mul0)"))
def adjust_minutes_hfq(spark, sf_dir):
    return _minutes(spark, sf_dir, "hfq")


def _chain(spark, sf_dir, method, until=None):
    out = adjust.ratio_chain_adjust(t.bars(spark, sf_dir), t.actions(spark, sf_dir), method, until)
    return out.select(
        "code", t.text("date").alias("date"), *t.rounded(6, "open", "close", "preclose"), t.exact("adj", 9).alias("adj")
    )


@query(
    "price_history",
    with_views(
        "v_bars v_maps v_actions",
        """select q.code, q.date::varchar as date, round((close * mul / mul0 + (add - add0) / mul0)::decimal(28, 10), 2)::double as close,
       round((mul / mul0)::decimal(28, 10), 9)::double as adj, round((case when e.eq > 0 then volume * 100 / e.eq * 100 end)::decimal(28, 10), 6)::double as turnover
from q join (select code, arg_min(mul, date) as mul0, arg_min(add, date) as add0 from q group by code) using (code)
asof left join equity e on q.code = e.code and q.date >= e.date""",
        "late as (select * from v_bars where date >= date '1998-01-01')",
        "ends as (select code, max(date) as hi from late group by code)",
        """steps as (select code, date, mul, add, coalesce(product(mul) over (partition by code order by date desc
                                            rows between unbounded preceding and 1 preceding), 1) as beyond
           from v_maps join ends using (code) where date <= hi)""",
        """f as (select code, date, product(mul) over w as mul, sum(add * beyond) over w as add from steps
           window w as (partition by code order by date desc))""",
        """q as (select b.code, b.date, b.close, b.volume, coalesce(f.mul, 1) as mul, coalesce(f.add, 0) as add
           from late b asof left join f on b.code = f.code and f.date > b.date)""",
        _EQUITY,
    ),
)
def price_history(spark, sf_dir):
    """Bars since 1998, adjusted backward from there, with turnover."""
    out = recipes.price_history(
        t.bars(spark, sf_dir), t.actions(spark, sf_dir), since="1998-01-01", adjusted="hfq", turnover=True
    )
    return out.select(
        "code", t.text("date").alias("date"), "close", t.exact("adj", 9).alias("adj"), t.exact("turnover", 6).alias("turnover")
    )
