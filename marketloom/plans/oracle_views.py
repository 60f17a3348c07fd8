"""The views of :mod:`marketloom.plans.tables`, written again in oracle SQL.

Each is a CTE body; :func:`with_views` puts the wanted ones in front of a query.
"""

from __future__ import annotations

_CODE = "'00' || printf('%04d', {n})"


def code(number: str) -> str:
    return _CODE.format(n=number)


_SEQ = "(l_orderkey, l_linenumber, round(l_extendedprice * 100)::bigint)"

VIEWS = {
    "v_ticks": f"""
        select 0 as market, {code('l_suppkey')} as code, l_shipdate::date as date, {_SEQ} as seq,
               l_extendedprice / l_quantity / 10 as price, l_quantity as vol,
               (l_extendedprice * 10)::decimal(18, 2) as amount,
               case l_returnflag when 'A' then 0 when 'R' then 1 else 2 end as side
        from lineitem""",
    "v_bars": f"""
        select 0 as market, code, date, arg_min(price, seq) as open, max(price) as high, min(price) as low,
               arg_max(price, seq) as close, sum(vol)::double as volume, sum(cents) / 100 as amount
        from (select {code('l_suppkey')} as code, l_shipdate::date as date, {_SEQ} as seq,
                     l_quantity::bigint as vol, round(l_extendedprice * 100)::bigint as cents,
                     (cents // vol) / 100 as price
              from lineitem)
        group by code, date""",
    "v_actions": f"""
        select 0 as market, {code('num')} as code, o_orderdate::date as date, o_orderkey as seq,
               case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 11 else 5 end as category,
               case when o_orderpriority = '1-URGENT' then (o_orderkey % 50) / 1000 else 0.0 end::double as fenhong,
               case when o_orderpriority = '1-URGENT' then (o_orderkey % 4) / 10 else 0.0 end::double as songzhuangu,
               case when o_orderpriority = '2-HIGH' then 1 + (o_orderkey % 3) / 100 else 0.0 end::double as suogu,
               case when o_orderpriority not in ('1-URGENT', '2-HIGH') then round(o_totalprice * 100) else 0.0 end::double as float_equity,
               case when o_orderpriority not in ('1-URGENT', '2-HIGH') then round(o_totalprice * 200) else 0.0 end::double as total_equity
        from (select *, o_custkey % (select count(*) from supplier) as num from orders)""",
    "v_minute_ticks": f"""
        select 0 as market, {code('user_id')} as code, ts::date as date, event_id as seq,
               case when k < 126 then k + 565 else k + 654 end as mod, value as price,
               event_id % 7 + 1 as vol, event_id % 3 + 1 as num,
               case event_type when 'view' then 0 when 'purchase' then 1 when 'click' then 2
                               when 'signup' then 5 else 8 end as side
        from (select *, floor((hour(ts) * 60 + minute(ts)) * 247 / 1440)::int as k from events)""",
    "v_ranges": """
        select 0 as market, o_custkey::varchar as code, o_orderdate::timestamp as s,
               o_orderdate::timestamp + interval 30 days as e
        from orders""",
    "v_directory": """
        select (c_custkey % 3)::int as market, lpad((((c_custkey // 3) * 7919) % 1000000)::varchar, 6, '0') as code,
               c_name || case when c_mktsegment = 'MACHINERY' then 'etf' else '' end as name, c_custkey as seq
        from customer""",
    "v_members": f"""
        select {code('s_suppkey')} as code, s_suppkey as seq, unnest([n_name, r_name]) as sector
        from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    # Flow per security and day.
    "v_flow": """
        select code, date,
               sum(case when side = 0 then amount when side = 1 then -amount else 0 end) filter (where amount > 200000) as main_net,
               sum(case when side = 0 then amount when side = 1 then -amount else 0 end) filter (where amount <= 200000) as retail_net,
               sum(case when side = 0 then amount when side = 1 then -amount else 0 end) filter (where amount > 1000000) as super_net,
               sum(case when side = 0 then amount when side = 1 then -amount else 0 end) filter (where amount > 200000 and amount <= 1000000) as large_net,
               sum(case when side = 0 then amount when side = 1 then -amount else 0 end) filter (where amount > 40000 and amount <= 200000) as medium_net,
               sum(case when side = 0 then amount when side = 1 then -amount else 0 end) filter (where amount <= 40000) as small_net,
               sum(amount) as total, count(*) as trades
        from v_ticks group by code, date""",
    # Day-level price maps: p -> mul * p + add, events of a day in source order.
    "v_steps": """
        select code, date, seq, case when category = 11 then suogu else (10 + songzhuangu) / 10 end as m,
               case when category = 11 then 0 else fenhong / 10 end as c
        from v_actions where category in (1, 11)""",
    "v_maps": """
        select code, date, product(1 / m) as mul, -sum(c * reach) as add
        from (select *, product(1 / m) over (partition by code, date order by seq desc) as reach from v_steps)
        group by code, date""",
    "v_bounds": "select code, min(date) as lo, max(date) as hi from v_bars group by code",
    "v_factors": """
        select code, date, product(mul) over w as mul, sum(add * beyond) over w as add
        from (select *, coalesce(product(mul) over (partition by code order by date desc
                                                    rows between unbounded preceding and 1 preceding), 1) as beyond
              from v_maps join v_bounds using (code) where date <= hi)
        window w as (partition by code order by date desc)""",
    "v_qfq": """
        select b.code, b.date, b.open, b.high, b.low, b.close, b.volume, b.amount,
               coalesce(f.mul, 1) as mul, coalesce(f.add, 0) as add
        from v_bars b asof left join v_factors f on b.code = f.code and f.date > b.date""",
    "v_anchor": """
        select code, arg_min(mul, date) as mul0, arg_min(add, date) as add0 from v_qfq group by code""",
}

_NEEDS = {
    "v_flow": ["v_ticks"],
    "v_steps": ["v_actions"],
    "v_maps": ["v_steps"],
    "v_bounds": ["v_bars"],
    "v_factors": ["v_maps", "v_bounds"],
    "v_qfq": ["v_bars", "v_factors"],
    "v_anchor": ["v_qfq"],
}


def with_views(names: str, body: str, *ctes: str) -> str:
    """``body`` after the CTEs of the named views (and what they need) and its own ``ctes``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{name} as ({VIEWS[name]})" for name in ordered] + list(ctes)
    return "with " + ",\n".join(parts) + "\n" + body
