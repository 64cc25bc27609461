"""The operators' input tables, derived from the test tables by SQL that two engines read alike.

``{table}`` stands for a test table; ``<epoch>`` and ``<array>`` for what the engines spell differently. ``operator`` n % 3
decides how an account is keyed; the first operator has no billing system.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from staykit.operators.viewing import DATES, NUMBERS

SPARK = {"<epoch>": "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01', CAST(ts AS TIMESTAMP_NTZ))", "<array>": "array"}
DUCKDB = {"<epoch>": "CAST(floor(epoch(ts)) AS BIGINT)", "<array>": "list_value"}

AS_OF, FIRST, LABEL_DAYS = "2024-01-25", "2024-01-11", 14
# The window of a day earlier.
DAY_BEFORE_FIRST, DAY_BEFORE_LAST = "2024-01-10", "2024-01-24"
PERIOD_DAYS = 15
PROMO_SINCE = "2024-01-05"
FIRST_CHANGE = "2023-11-01"


def _operator(n: str) -> str:
    return f"CASE {n} % 3 WHEN 0 THEN 'OP_A' WHEN 1 THEN 'OP_B' ELSE 'OP_C' END"


def _system(n: str) -> str:
    return f"CASE WHEN {n} % 3 = 0 THEN NULL ELSE CAST({n} % 5 AS STRING) END"


def _billing(n: str) -> str:
    return f"CASE {n} % 3 WHEN 2 THEN lpad(CAST({n} AS STRING), 9, '0') ELSE CAST({n} AS STRING) END"


def _number(n: str) -> str:
    return f"CASE {n} % 3 WHEN 0 THEN concat('777', CAST({n} AS STRING)) ELSE CAST({n} AS STRING) END"


def guid(n: str) -> str:
    return (
        f"CASE {n} % 3 WHEN 0 THEN concat('OP_A::', CAST({n} AS STRING)) WHEN 1 THEN concat('OP_B::', CAST({n} AS STRING)) "
        f"ELSE concat('OP_C::', CAST({n} % 5 AS STRING), '::', lpad(CAST({n} AS STRING), 9, '0')) END"
    )


_OWN_NUMBERS = {
    "mos_score": "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 401 AS DOUBLE) / 100 + 1 END",
    "watch_time_ms": "(event_id % 3600) * 1000",
    "watch_time_on_net_ms": "(event_id % 3000) * 1000",
    "watch_time_off_net_ms": "(event_id % 600) * 1000",
    "level2_downshifts": "CASE WHEN user_id % 10 = 0 THEN 0 ELSE event_id % 3 END",
}


def _metrics() -> str:
    lines = []
    for i, name in enumerate(NUMBERS):
        rule = _OWN_NUMBERS.get(name) or (
            f"CASE WHEN event_id % {7 + i} = 3 THEN NULL ELSE (event_id * {i + 3}) % {100 + 7 * i} END"
        )
        lines.append(f"{rule} AS {name}")
    for i, name in enumerate(DATES):
        lines.append(
            f"CASE WHEN event_id % {9 + i} = 0 THEN NULL ELSE CAST(DATE '2018-01-01' + CAST(event_id % {500 + i} AS INT) "
            f"AS DATE) END AS {name}"
        )
    return ",\n ".join(lines)


def _flag(name: str, modulo: int) -> str:
    return f"CASE o_orderkey % {modulo} WHEN 0 THEN 1 WHEN 1 THEN -1 END AS {name}"


VIEWS = {
    "sessions": f"""SELECT {_billing('user_id')} AS billing_id, {_operator('user_id')} AS operator,
 {_system('user_id')} AS division, CASE WHEN event_id % 11 = 0 THEN NULL ELSE concat('s', CAST(k % 25 AS STRING)) END AS stream_id,
 CAST(k % 10 AS STRING) AS channel_number, concat('channel ', CAST(k % 10 AS STRING)) AS channel_name,
 CASE k % 7 WHEN 0 THEN 'hbo east' WHEN 1 THEN 'the starz' WHEN 2 THEN NULL ELSE concat('net ', CAST(k % 7 AS STRING)) END AS network_name,
 CASE WHEN k % 5 = 0 THEN NULL ELSE concat('category ', CAST(k % 4 AS STRING)) END AS channel_category,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(k % 10 AS STRING) END AS guide_id,
 CASE event_id % 12 WHEN 0 THEN 'iphone' WHEN 1 THEN 'androidphone' WHEN 2 THEN 'uwp' WHEN 3 THEN 'samsungtv' WHEN 4 THEN 'androidtablet'
  WHEN 5 THEN 'webbrowser' WHEN 6 THEN 'ipad' WHEN 7 THEN 'ipod touch' WHEN 8 THEN 'xbox' WHEN 9 THEN 'roku' WHEN 10 THEN 'other' END AS device_type,
 CASE WHEN event_id % 4 = 0 THEN 'vod' ELSE 'linear' END AS playback_type,
 CASE event_id % 4 WHEN 0 THEN '1280x720' WHEN 1 THEN '640x480' WHEN 2 THEN '480x1080' ELSE 'unknown' END AS screen_resolution,
 CASE event_id % 6 WHEN 0 THEN 'drama,football' WHEN 1 THEN 'news' WHEN 2 THEN 'soccer' ELSE NULL END AS content_genres,
 CASE event_id % 13 WHEN 0 THEN 'espn.com/1' WHEN 1 THEN 'www.hbogo' WHEN 2 THEN 'showtime' WHEN 3 THEN 'abc' ELSE NULL END AS provider_asset_id,
 CASE WHEN event_id % 8 = 0 THEN NULL ELSE event_id % 5 = 0 END AS user_cancels_stream,
 event_id % 3 <> 0 AS is_active, event_id % 10 <> 0 AS has_playback_start, CAST(ts AS DATE) AS activity_date,
 CASE WHEN event_id % 2 = 0 THEN <epoch> * 1000 ELSE <epoch> END AS start_timestamp,
 CASE WHEN event_id % 3 = 0 THEN <epoch> * 1000 ELSE <epoch> + 600 END AS end_timestamp, <epoch> AS last_stop_timestamp,
 {_metrics()}
 FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {{events}}) e""",
    "labels": f"""SELECT {guid('c_custkey')} AS account_guid, CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS churn,
 CASE WHEN c_acctbal < 1000 THEN '2024-01-20' ELSE '' END AS churn_date, CAST(c_custkey % 30 AS INT) AS tv_stream_tenure,
 CAST(c_custkey % 90 AS INT) AS customer_tenure, CAST(DATE '2020-01-01' + CAST(c_custkey % 365 AS INT) AS DATE) AS connect_date,
 CAST(DATE '2021-01-01' + CAST(c_custkey % 365 AS INT) AS DATE) AS convert_date FROM {{customer}}""",
    "training": f"""SELECT {guid('c_custkey')} AS account_guid, CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END AS churn,
 CASE WHEN c_acctbal < 1000 THEN '2024-01-02' ELSE '' END AS churn_date FROM {{customer}} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "changes": f"""SELECT {_billing('o_custkey')} AS billing_id, {_operator('o_custkey')} AS operator,
 {_system('o_custkey')} AS system, {_number('o_custkey')} AS account_number,
 CAST(DATE '2024-01-31' - CAST(o_orderkey % 400 AS INT) AS DATE) AS change_event_date,
 CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN -1 END AS internet_package,
 CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN -1 END AS video_package,
 {_flag('other_package', 4)}, {_flag('tv_stream_package', 5)}, {_flag('stream_choice_package', 6)},
 {_flag('internet_price', 7)}, {_flag('video_price', 8)},
 CASE WHEN o_totalprice > 250000 THEN 1 WHEN o_totalprice < 50000 THEN -1 END AS total_price FROM {{orders}}""",
    "history": f"""SELECT {_number('c_custkey')} AS account_number, {_operator('c_custkey')} AS operator,
 CASE WHEN c_custkey % 50 = 0 THEN concat('TestTool ', c_name) ELSE c_name END AS customer_name, {_system('c_custkey')} AS system,
 CASE o_orderkey % 3 WHEN 0 THEN 'Commercial' ELSE 'Residential' END AS customer_type,
 CASE o_orderkey % 4 WHEN 0 THEN 'Commercial Business' ELSE 'Residential' END AS file_type,
 CASE c_custkey % 20 WHEN 0 THEN 'Employee' WHEN 1 THEN 'TEST' ELSE 'Regular' END AS account_type,
 CASE o_orderkey % 5 WHEN 0 THEN 'Stream' WHEN 1 THEN 'Stream Choice' WHEN 2 THEN 'Stream Plus' ELSE 'Classic' END AS video_package_type,
 CASE o_orderkey % 17 WHEN 0 THEN NULL WHEN 1 THEN 'Unkown' ELSE concat(o_orderpriority, ' ', c_mktsegment) END AS promotion_description,
 concat(c_mktsegment, CAST(o_orderkey % 2 AS STRING)) AS dwelling, concat(CAST(c_nationkey AS STRING), CAST(o_orderkey % 3 AS STRING)) AS zip_code,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 4 AS STRING) END AS zip_code_4,
 o_orderstatus <> 'O' AS stream_flag, o_orderkey % 10 = 0 AS choice_flag, o_orderkey % 4 AS truck_call_count,
 CAST(DATE '2024-01-25' - CAST(o_orderkey % 30 AS INT) AS DATE) AS snapshot_date
 FROM {{customer}} JOIN {{orders}} ON c_custkey = o_custkey""",
    "calls": """SELECT CAST(ts AS DATE) AS call_date, CAST(event_id % 400 AS INT) AS days_since_install,
 CASE WHEN event_id % 50 = 0 THEN 'Z' WHEN user_id % 3 = 0 THEN 'A' WHEN user_id % 3 = 1 THEN 'B' ELSE 'C' END AS company_code,
 CASE WHEN event_id % 60 = 1 THEN concat(CAST(user_id AS STRING), '9999') ELSE CAST(user_id AS STRING) END AS subaccount
 FROM {events} WHERE event_type = 'error'""",
    "usage": f"""SELECT {_billing('user_id')} AS billing_id, {_operator('user_id')} AS operator, {_system('user_id')} AS division
 FROM {{events}} WHERE event_type = 'click' AND user_id % 4 <> 0""",
    "pages": f"""SELECT {_billing('user_id')} AS billing_id, {_operator('user_id')} AS operator, {_system('user_id')} AS division,
 CAST(event_id % 500 AS STRING) AS visit_id, CASE WHEN event_id % 15 = 0 THEN NULL ELSE CAST(event_id % 700 AS STRING) END AS search_id,
 CASE event_id % 4 WHEN 0 THEN 'searchResultSelected' WHEN 1 THEN 'pageView' ELSE 'searchEntered' END AS operation_type,
 CAST(ts AS DATE) AS activity_date,
 <array>(concat('searchEntered||q||', CAST(event_id % 3 AS STRING), '||', CAST(event_id % 977 AS STRING)),
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('searchEntered||q||', CAST(event_id % 2 AS STRING), '||n/a') END, 'broken||q') AS search_text_list
 FROM {{events}} WHERE event_type = 'view'""",
}


def _spell(text: str, dialect: dict[str, str]) -> str:
    for mark, spelling in dialect.items():
        text = text.replace(mark, spelling)
    return text


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the test tables in ``sf_dir``."""
    text = _spell(VIEWS[name], SPARK)
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("events", "customer", "orders") if f"{{{t}}}" in text}
    return spark.sql(text, **tables)


def in_minutes():
    """Watch time in whole minutes, as a Column."""
    return F.floor(F.col("watch_time_ms") / 60000)


def view_sql(name: str) -> str:
    """The same view for the checking engine."""
    return _spell(VIEWS[name], DUCKDB).format(events="events", customer="customer", orders="orders")
