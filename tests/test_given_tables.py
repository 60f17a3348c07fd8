"""Queries against their SQL on tables with values that the small ones lack."""

import os

import duckdb
import oracle
import pytest

from marketloom.plans import load_queries

SMALL = "/root/testdata/sf0.001"


def tables(folder, **changed):
    """The small tables, with ``changed`` ones made by a query over the old one."""
    for name in oracle.TABLES:
        target = f"{folder}/{name}.parquet"
        if name in changed:
            duckdb.sql(f"copy ({changed[name].format(old=f'{SMALL}/{name}.parquet')}) to '{target}' (format parquet)")
        else:
            os.symlink(f"{SMALL}/{name}.parquet", target)
    return str(folder)


def difference(spark, folder, name):
    query = load_queries()[name]
    return oracle.difference(query.run(spark, folder), oracle.connect(folder), query.sql)


@pytest.fixture(scope="module")
def free_events(tmp_path_factory):
    """Every ninth event is worth 0, and so is the newest of every user, and most of the first
    hour's (the opening auction), where a user has a second event of the day soon after."""
    events = """with e as (select event_id, case when event_id % 4 = 0 then ts::date + interval 10 minutes + (event_id % 50) * interval 1 second
            when event_id % 4 = 1 then ts::date + interval 40 minutes else ts end as ts, user_id, event_type, value, props
            from '{old}')
        select event_id, ts, user_id, event_type, case when event_id % 9 = 0 or event_id % 4 = 0 and event_id % 5 > 0
            or event_id = max(event_id) over (partition by user_id) then 0.0 else value end as value, props from e"""
    return tables(tmp_path_factory.mktemp("free"), events=events)


@pytest.mark.parametrize(
    "name",
    [
        "auction_values", "fallback_minutes", "minute_241", "minute_241_dates", "minute_bars", "rejected_days", "security_summary",
        "stream_flow", "traded_minutes",
    ],
)
def test_events_worth_nothing_are_ticks(spark, free_events, name):
    assert difference(spark, free_events, name) == ""


def test_names_with_codes_of_seven_digits(spark, tmp_path):
    folder = tables(tmp_path, part="select * replace (p_partkey + 999900 as p_partkey) from '{old}'")
    assert difference(spark, folder, "config_names") == ""


def test_files_of_numbers_beyond_the_shanghai_range(spark, tmp_path):
    folder = tables(tmp_path, customer="select * replace (case when c_custkey % 2 = 0 then c_custkey + 9950 else c_custkey * 10007 end as c_custkey) from '{old}'")
    assert difference(spark, folder, "locate_files") == ""
