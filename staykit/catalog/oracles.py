"""SQL that recomputes each registered query from the test tables, written independently of the operators.

Joins, windows and formulas follow the plain definitions (self-joins on newest dates, several scans) where the operators
take shorter ways.
"""

from __future__ import annotations

from staykit.catalog import views as v
from staykit.catalog.settle import settle_sql

# Fixed values, spelled out here so that a column missing from an operator is missed.
FLAGS = tuple("internet_package video_package other_package tv_stream_package stream_choice_package internet_price video_price "
              "total_price".split())
DEVICES = ("iphone", "androidphone", "uwp", "samsungtv", "androidtablet", "webbrowser", "ipad", "ipod touch", "xbox", "roku")
NUMBERS = tuple("""rental_duration_hours content_runtime content_year stream_init_starts stream_noninit_failures
 stream_init_failures stream_failures stream_stops tune_time_ms watch_time_ms bandwidth_consumed_mb bitrate_content_elapsed_ms
 buffering_events buffering_stops buffering_duration_ms buffering_ratio buffering_score ad_breaks ad_events
 last_ad_sequence_number last_ad_end_sequence_number avg_bitrate_mbps bitrate_upshifts bitrate_downshifts downshifts_score
 last_stop_sequence_number level2_downshifts pibbe_ms pibd2_ms mos_score watch_time_on_net_ms watch_time_off_net_ms""".split())
BOOLEANS = ("is_active", "has_playback_start")
DATES = ("content_available_date", "content_expiration_date", "content_original_air_date")
EPOCHS = ("start_timestamp", "end_timestamp", "last_stop_timestamp")

_KEY = """CASE operator WHEN 'OP_A' THEN 'OP_A::' || billing_id WHEN 'OP_B' THEN 'OP_B::' || billing_id
 WHEN 'OP_C' THEN concat_ws('::', 'OP_C', {system}, billing_id) ELSE billing_id END AS account_guid"""
_MS = "CASE WHEN length(CAST({c} AS VARCHAR)) < 13 THEN CAST(rpad(CAST({c} AS VARCHAR), 13, '0') AS BIGINT) ELSE {c} END"
_STARTED = f"make_timestamp(({_MS.format(c='start_timestamp')}) * 1000)"


def _day_part(legacy: bool = False) -> str:
    bands = "2 5 2 5 2 5 2 5" if legacy else "2 5 6 9 10 16 17 22"
    b = bands.split()
    names = ("Overnight", "Breakfast", "Daytime", "PrimeTime")
    whens = " ".join(f"WHEN hour({_STARTED}) BETWEEN {b[2 * i]} AND {b[2 * i + 1]} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE {whens} ELSE 'late_night' END AS day_part"


_WEEK_PART = f"CASE WHEN isodow({_STARTED}) BETWEEN 1 AND 5 THEN 'week_day' ELSE 'weekend' END AS week_part"

# Shared building blocks: name -> (text, names it needs).
_CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    name: (v.view_sql(name), ()) for name in ("calls", "usage", "history")
}
_CTES |= {
    "labels_in": (v.view_sql("labels"), ()),
    "sessions_in": (v.view_sql("sessions"), ()),
    "changes_in": (v.view_sql("changes"), ()),
    "pages_in": (v.view_sql("pages"), ()),
    "sessions": (f"SELECT *, {_KEY.format(system='division')}, {_day_part()}, {_WEEK_PART} FROM sessions_in", ("sessions_in",)),
    "pages": (f"SELECT *, {_KEY.format(system='division')} FROM pages_in", ("pages_in",)),
    "changes": (f"SELECT *, {_KEY.format(system='system')} FROM changes_in", ("changes_in",)),
    "windowed": (
        f"SELECT * FROM sessions WHERE activity_date BETWEEN DATE '{v.FIRST}' AND DATE '{v.AS_OF}'", ("sessions",)
    ),
    "windowed_minutes": (
        "SELECT * REPLACE (CAST(floor(watch_time_ms / 60000) AS BIGINT) AS watch_time_ms) FROM windowed", ("windowed",)
    ),
    "minutes_literal": (f"SELECT * REPLACE ({_day_part(True)}) FROM windowed_minutes", ("windowed_minutes",)),
    "training": (v.view_sql("training"), ()),
    "labels": (
        f"""SELECT *, CASE WHEN churn_date = '' THEN DATE '{v.AS_OF}' ELSE CAST(nullif(churn_date, '') AS DATE) END AS max_agg_date,
 CAST(CASE WHEN churn_date = '' THEN DATE '{v.AS_OF}' ELSE CAST(nullif(churn_date, '') AS DATE) END - {v.LABEL_DAYS} AS DATE) AS min_agg_date
 FROM labels_in""", ("labels_in",),
    ),
    "label_sessions": (
        """SELECT s.*, l.churn, l.min_agg_date, l.max_agg_date FROM labels l JOIN sessions s ON l.account_guid = s.account_guid
 WHERE s.activity_date >= l.min_agg_date""", ("labels", "sessions"),
    ),
    "own_sessions": ("SELECT * FROM label_sessions WHERE activity_date <= max_agg_date", ("label_sessions",)),
    "eligible": (
        """SELECT *, CASE operator WHEN 'OP_A' THEN substr(account_number, 4)
  WHEN 'OP_C' THEN CASE WHEN length(account_number) < 9 THEN lpad(account_number, 9, '0') ELSE account_number END
  ELSE account_number END AS billing_id
 FROM history WHERE (operator IN ('OP_A', 'OP_C') AND instr(lower(customer_name), 'testtool') < 1 AND (stream_flag OR choice_flag))
 OR (operator = 'OP_B' AND ((customer_type = 'Commercial' AND file_type = 'Commercial Business')
  OR (customer_type = 'Residential' AND file_type = 'Residential')) AND lower(account_type) NOT IN ('employee', 'test')
  AND video_package_type IN ('Stream', 'Stream Choice', 'Stream Plus'))""", ("history",),
    ),
    "accounts": (
        """SELECT *, CASE operator WHEN 'OP_C' THEN concat_ws('::', operator, system, billing_id) ELSE operator || '::' || billing_id END AS account_guid
 FROM eligible""", ("eligible",),
    ),
    "active": (
        f"""SELECT DISTINCT account_guid, operator, account_number, billing_id, CASE WHEN operator = 'OP_A' THEN NULL ELSE system END AS system
 FROM accounts WHERE snapshot_date = DATE '{v.AS_OF}'""", ("accounts",),
    ),
    "active_ever": (
        """SELECT DISTINCT account_guid, operator, account_number, billing_id, CASE WHEN operator = 'OP_A' THEN NULL ELSE system END AS system
 FROM accounts""", ("accounts",),
    ),
}


def _with(sql: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name):
        for other in _CTES[name][1]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in order) + "\n" + sql


def _ratio(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / nullif({bottom}, 0)"


def _add(name: str, sql: str, *needs: str) -> None:
    _CTES[name] = (sql, needs)


# Quality

QUALITY_DOUBLES = [
    "mos_std_dev_acct", "avg_mos_acct", "weighted_avg_mos_acct", "weighted_std_dev_acct", "mos_bottom_10_percentile",
    "mos_top_10_percentile",
]


def _quality(source: str, extra: str = "") -> str:
    return f"""SELECT account_guid, count(DISTINCT activity_date) AS active_day_cnt,
 coalesce(stddev_pop(mos_score), 0) AS mos_std_dev_acct, coalesce(avg(mos_score), 0) AS avg_mos_acct,
 coalesce(avg(mos_score * watch_time_ms), 0) AS weighted_avg_mos_acct,
 coalesce(stddev_pop(mos_score * watch_time_ms), 0) AS weighted_std_dev_acct{extra},
 quantile_cont(CAST(round(mos_score * 100) AS INTEGER), 0.1) AS mos_bottom_10_percentile,
 quantile_cont(CAST(round(mos_score * 100) AS INTEGER), 0.9) AS mos_top_10_percentile
 FROM {source} GROUP BY account_guid"""


_NORM = ", sum(mos_score * watch_time_ms) / nullif(sum(CASE WHEN mos_score IS NOT NULL THEN watch_time_ms END), 0) AS weighted_mean_norm"
_PEER_DOUBLES = (
    "cnt_acct_bigger", "avg_acct_bigger", "std_dev_acct", "weighted_avg_mos_acct", "weighted_cnt_acct_bigger",
    "weighted_avg_acct_bigger", "weighted_std_dev_acct",
)


def peer_doubles(grain: str) -> list[str]:
    return [f"mos_comp_{grain}_{m}" for m in _PEER_DOUBLES]


# Scores have two decimals: means are plain averages, and whether one mean is above another is decided by whole hundredths.
_STEPS = "CAST(CAST(round(mos_score * 100) AS BIGINT) AS HUGEINT)"
_GRAINS = {
    # name: (peer keys, day count, weighted denominator, inclusive tails)
    "stream": (("stream_id", "activity_date"), "count(DISTINCT a.activity_date)", "count(a.stream_id)", False),
    "channel": (("channel_number", "activity_date"), "count(DISTINCT a.activity_date)", "count(a.channel_number)", True),
    "week_part": (("week_part", "day_part"), "sum(active_days)", "count(a.week_part)", True),
    "day_part": (("activity_date", "day_part"), "sum(active_days)", "count(DISTINCT a.activity_date)", True),
}


def _peers(grain: str, own: str = "windowed", everyone: str = "windowed", legacy: bool = False) -> str:
    keys, days, denominator, inclusive = _GRAINS[grain]
    listed = ", ".join(keys)
    on = " AND ".join(f"a.{k} = p.{k}" for k in keys)
    low, high = ("points[2]", "points[3]") if legacy else ("points[1]", "points[2]")
    equal = "=" if inclusive else ""
    power = (lambda x: f"pow(2.0, {x})") if legacy else (lambda x: f"pow({x}, 2.0)")
    gap, wgap = "own_mean - peer_mean", "own_wmean - peer_wmean"
    name = f"mos_comp_{grain}"
    shown = (lambda x: f"log2({x})") if legacy else (lambda x: x)
    return f"""SELECT a.account_guid,
 {_ratio('sum(CASE WHEN own_sum * peer_n > peer_sum * own_n THEN 1 ELSE 0 END)', days)} AS {name}_cnt_acct_bigger,
 {_ratio('sum(own_sum - peer_sum)', days)} / 100 AS {name}_avg_acct_bigger,
 {shown(f"sqrt(sum({power(gap)}) / nullif(count(own_mean), 0))")} AS {name}_std_dev_acct,
 CAST(sum(CASE WHEN own_mean <{equal} {low} THEN 1 ELSE 0 END) AS BIGINT) AS {name}_avg_mos_bottom_10,
 CAST(sum(CASE WHEN own_mean >{equal} {high} THEN 1 ELSE 0 END) AS BIGINT) AS {name}_avg_mos_top_10,
 sum(own_wmean) / nullif({denominator}, 0) AS {name}_weighted_avg_mos_acct,
 {_ratio('sum(CASE WHEN own_wsum * peer_n > peer_wsum * own_n THEN 1 ELSE 0 END)', days)} AS {name}_weighted_cnt_acct_bigger,
 sum({wgap}) / nullif({days}, 0) AS {name}_weighted_avg_acct_bigger,
 {shown(f"sqrt(sum({power(wgap)}) / nullif(count(peer_wmean), 0))")} AS {name}_weighted_std_dev_acct
 FROM (SELECT account_guid, {listed}, count(DISTINCT activity_date) AS active_days, count(mos_score) AS own_n, sum({_STEPS}) AS own_sum,
  sum({_STEPS} * watch_time_ms) AS own_wsum, avg(mos_score) AS own_mean, avg(mos_score * watch_time_ms) AS own_wmean FROM {own} GROUP BY account_guid, {listed}) a
 LEFT JOIN (SELECT {listed}, count(mos_score) AS peer_n, sum({_STEPS}) AS peer_sum, sum({_STEPS} * watch_time_ms) AS peer_wsum,
  avg(mos_score) AS peer_mean, avg(mos_score * watch_time_ms) AS peer_wmean,
  quantile_cont(CAST(round(mos_score) AS INTEGER), [0.1, 0.9]) AS points FROM {everyone} GROUP BY {listed}) p ON {on}
 GROUP BY a.account_guid"""


# Viewing

_SPORTS = """(coalesce(regexp_matches(content_genres, 'football|basketball|baseball|soccer'), false) OR
 coalesce(regexp_matches(provider_asset_id, 'nbcolympics|nbcsports|espn|nfl|foxdeportes|foxsports1|beinsport'), false))"""
_PREMIUM = """(coalesce(regexp_matches(network_name, 'hbo|showtime|starz|cinemax'), false) OR
 coalesce(regexp_matches(provider_asset_id, 'sho|hbo|starzencore|cinemax'), false))"""
_HD = """(coalesce(try_cast(split_part(screen_resolution, 'x', 1) AS INTEGER) > 720, false) OR
 coalesce(try_cast(split_part(screen_resolution, 'x', 2) AS INTEGER) > 720, false))"""


def _where(test: str, value: str = "1") -> str:
    return f"CAST(sum(CASE WHEN {test} THEN {value} ELSE 0 END) AS BIGINT)"


_FLAG_COLUMNS = ",\n ".join(
    f"{_where(test)} AS sum_{name}_flag, avg(CASE WHEN {test} THEN 1 ELSE 0 END) AS avg_{name}_flag"
    for name, test in (("sports", _SPORTS), ("prem", _PREMIUM), ("hd", _HD))
)
FLAG_DOUBLES = ["avg_sports_flag", "avg_prem_flag", "avg_hd_flag"]
_DEVICE_COLUMNS = ",\n ".join(
    f"{_where(f'device_type = {chr(39)}{d}{chr(39)}', 'watch_time_ms')} AS {d.split()[0]}_device_watch_time" for d in DEVICES
)
_MEAN_COLUMNS = ",\n ".join(
    [f"avg({c}) AS avg_{c}" for c in NUMBERS]
    + [f"avg(CAST({c} AS INTEGER)) AS avg_{c}" for c in BOOLEANS]
    + [f"avg(date_diff('day', DATE '1970-01-01', {c})) AS avg_{c}" for c in DATES]
    + [f"avg({_MS.format(c=c)}) AS avg_{c}" for c in EPOCHS]
)
MEAN_DOUBLES = [f"avg_{c}" for c in NUMBERS + BOOLEANS + DATES + EPOCHS]
_COUNT_COLUMNS = f"""{_ratio('sum(watch_time_ms)', 'sum(level2_downshifts)')} AS watch_time_per_level2_downshift,
 sum(mos_score * watch_time_on_net_ms) / nullif(count(billing_id), 0) AS avg_mos_x_time,
 CAST(sum(stream_failures) AS BIGINT) AS sum_stream_failures,
 {_ratio('sum(watch_time_off_net_ms)', 'sum(watch_time_ms)')} AS pctn_watch_time_off_net_ms, max(activity_date) AS max_activity_date,
 {_where("playback_type = 'linear'")} AS sum_linear, {_where("playback_type = 'vod'")} AS sum_vod,
 max(CASE WHEN playback_type = 'linear' THEN activity_date END) AS max_linear_activity_date,
 max(CASE WHEN playback_type = 'vod' THEN activity_date END) AS max_vod_activity_date,
 {_where("user_cancels_stream")} AS sum_user_stream_cancel, {_where("NOT user_cancels_stream")} AS sum_user_stream_not_cancel,
 count(activity_date) AS total_stream_count_date"""
COUNT_DOUBLES = ["watch_time_per_level2_downshift", "avg_mos_x_time", "pctn_watch_time_off_net_ms"]
COUNT_DATES = ["max_activity_date", "max_linear_activity_date", "max_vod_activity_date"]


def _distinct_columns(period: int) -> str:
    return f"""CAST(count(DISTINCT activity_date) AS DOUBLE) / {period} AS dist_date_percent, count(DISTINCT channel_name) AS dist_channel_name,
 count(DISTINCT network_name) AS dist_network_name, count(DISTINCT channel_category) AS dist_channel_category,
 count(DISTINCT device_type) AS distinct_device_cnt"""


def _per_account(columns: str, source: str = "windowed") -> str:
    return f"SELECT account_guid, {columns} FROM {source} GROUP BY account_guid"


def _profile(source: str, period: int) -> str:
    parts = (_FLAG_COLUMNS, _DEVICE_COLUMNS, _COUNT_COLUMNS, _MEAN_COLUMNS, _distinct_columns(period))
    return _per_account(",\n ".join(parts), source)


PROFILE_DOUBLES = FLAG_DOUBLES + COUNT_DOUBLES + MEAN_DOUBLES + ["dist_date_percent"]


def _top_channel(source: str) -> str:
    return f"""SELECT account_guid, guide_id AS top_channel_watch_time, channel_watch_time FROM (
 SELECT *, row_number() OVER (PARTITION BY account_guid ORDER BY channel_watch_time DESC, guide_id) AS rn FROM (
  SELECT account_guid, guide_id, CAST(sum(watch_time_ms) AS BIGINT) AS channel_watch_time FROM {source}
  WHERE playback_type = 'linear' AND guide_id IS NOT NULL GROUP BY account_guid, guide_id)) WHERE rn = 1"""


def _variability(source: str) -> str:
    return f"""SELECT account_guid, avg(deviation) AS avg_std_channel FROM (
 SELECT account_guid, guide_id, week(activity_date) AS w, stddev_pop(watch_time_ms) AS deviation FROM {source}
 WHERE playback_type = 'linear' AND guide_id IS NOT NULL GROUP BY account_guid, guide_id, week(activity_date)) GROUP BY account_guid"""


def _never(first: str, legacy: bool = False) -> str:
    same = "=" if legacy else "IS NOT DISTINCT FROM"
    return f"""SELECT DISTINCT account_guid, billing_id, 1 AS never_logged_in FROM changes c WHERE tv_stream_package IS NOT NULL
 AND change_event_date BETWEEN DATE '{first}' AND DATE '{v.AS_OF}' AND NOT EXISTS (SELECT 1 FROM usage u
 WHERE u.operator {same} c.operator AND u.billing_id {same} c.billing_id AND u.division {same} c.system)"""


_SEARCH = f"""SELECT account_guid, count(DISTINCT search_id) AS sum_unique_searches,
 {_where('results = 0')} AS sum_search_entered_returned_no_results, {_where('results > 0')} AS sum_search_entered_selected_results,
 sum(response_ms) AS sum_search_response_time_ms,
 {_ratio('count(DISTINCT search_id)', 'count(DISTINCT visit_id)')} AS avg_unique_searches,
 {_ratio('sum(CASE WHEN results = 0 THEN 1 ELSE 0 END)', 'count(DISTINCT visit_id)')} AS avg_search_entered_returned_no_results,
 {_ratio('sum(CASE WHEN results > 0 THEN 1 ELSE 0 END)', 'count(DISTINCT visit_id)')} AS avg_search_entered_selected_results,
 sum(response_ms) / nullif(count(DISTINCT visit_id), 0) AS avg_search_response_time_ms
 FROM (SELECT account_guid, visit_id, search_id, try_cast(string_split(entry, '||')[3] AS BIGINT) AS results,
  try_cast(string_split(entry, '||')[4] AS DOUBLE) AS response_ms
  FROM (SELECT *, unnest(search_text_list) AS entry FROM pages WHERE activity_date BETWEEN DATE '{v.FIRST}' AND DATE '{v.AS_OF}'
   AND operation_type IN ('searchEntered', 'searchResultSelected') AND search_id IS NOT NULL) WHERE entry IS NOT NULL)
 GROUP BY account_guid"""
SEARCH_DOUBLES = [
    f"{kind}_{name}" for kind, name in (
        ("sum", "search_response_time_ms"), ("avg", "unique_searches"), ("avg", "search_entered_returned_no_results"),
        ("avg", "search_entered_selected_results"), ("avg", "search_response_time_ms"),
    )
]

# Changes

_NEWEST_FLAGS = ", ".join(f"{f} AS most_recent_{f}_change" for f in FLAGS)
_COUNTED_FLAGS = ",\n ".join(
    f"CAST(sum({f}) AS BIGINT) AS {f}_add_drop, count({f}) AS {f}_changes, {_where(f'{f} = 1')} AS {f}_adds, {_where(f'{f} = -1')} AS {f}_drop"
    for f in FLAGS
)
_RATIO = _ratio("count(total_price)", "count(change_event_date)")
_NEWEST_ROW = f"""SELECT account_guid, change_event_date, {_NEWEST_FLAGS} FROM (SELECT *, row_number() OVER (PARTITION BY account_guid
 ORDER BY change_event_date DESC, {', '.join(f'{f} DESC NULLS LAST' for f in FLAGS)}) AS rn FROM changes) WHERE rn = 1"""


def _points(keys: str) -> str:
    return f"""SELECT quantile_cont(CAST(round(r * 100) AS INTEGER), [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS points,
 stddev_pop(r * 100) AS std_dev, avg(r * 100) AS avg_price
 FROM (SELECT {_RATIO} AS r FROM changes WHERE change_event_date <= DATE '{v.AS_OF}' GROUP BY {keys})"""


def _band(first: int) -> str:
    """``first`` is the 1-based list position of the point that ends the lowest band."""
    whens = " ".join(
        f"WHEN total_count_int BETWEEN points[{first + i}] AND points[{first + i + 1}] THEN '{10 * (i + 1)}_{10 * (i + 2)}percent'"
        for i in range(8)
    )
    return f"CASE {whens} WHEN total_count_int > points[{first + 8}] THEN '90_100percent' ELSE '10percent' END AS percentile_score_price"


_CHANGE_OUT = ", ".join(
    [f"most_recent_{f}_change" for f in FLAGS]
    + [f"{f}_{k}" for f in FLAGS for k in ("add_drop", "changes", "adds", "drop")]
    + ["total_count_int AS total_count_int_100_day", "total_count_int / 100 AS total_count_int_day"]
)
_CHANGE_PROFILE = f"""SELECT n.account_guid, {_CHANGE_OUT}, {_band(1)} FROM ({_NEWEST_ROW}) n
 JOIN (SELECT account_guid, {_COUNTED_FLAGS}, {_RATIO} * 100 AS total_count_int FROM changes GROUP BY account_guid) c
 ON n.account_guid = c.account_guid CROSS JOIN ({_points('account_guid')}) d"""
_FOUR = "billing_id, operator, system, account_number"
_CHANGE_LEGACY = f"""SELECT DISTINCT n.account_guid, {_CHANGE_OUT}, {_band(2)} FROM
 (SELECT *, {_NEWEST_FLAGS} FROM changes) n JOIN (SELECT {_FOUR}, max(change_event_date) AS newest, {_COUNTED_FLAGS},
 {_RATIO} AS total_count_int FROM changes GROUP BY {_FOUR}) c ON n.billing_id = c.billing_id AND n.operator = c.operator
 AND n.system = c.system AND n.account_number = c.account_number AND n.change_event_date = c.newest CROSS JOIN ({_points(_FOUR)}) d"""
CHANGE_DOUBLES = ["total_count_int_100_day", "total_count_int_day"]

# Calls

_PADDED = "CASE WHEN length(h.account_number) < 9 THEN lpad(h.account_number, 9, '0') ELSE h.account_number END"


def _calls(condition: str, legacy: bool = False, labels: bool = False) -> str:
    history = "SELECT account_number, system FROM history WHERE operator = 'OP_C'"
    if legacy:
        source = f"""SELECT call_date, days_since_install, CASE company_code WHEN 'A' THEN 'OP_A::' || subaccount WHEN 'B' THEN 'OP_B::' || subaccount
  WHEN 'C' THEN concat_ws('::', 'OP_C', h.system, {_PADDED}) END AS account_guid
  FROM calls LEFT JOIN ({history}) h ON subaccount = h.account_number"""
    else:
        source = f"""SELECT call_date, days_since_install, CASE company_code WHEN 'A' THEN 'OP_A::' ELSE 'OP_B::' END || subaccount AS account_guid
  FROM calls WHERE company_code IN ('A', 'B') UNION ALL
  SELECT call_date, days_since_install, concat_ws('::', 'OP_C', h.system, {_PADDED}) FROM calls
  JOIN (SELECT DISTINCT * FROM ({history})) h ON subaccount = h.account_number WHERE company_code = 'C'"""
    joined = "JOIN labels l ON k.account_guid = l.account_guid" if labels else ""
    return f"""SELECT account_guid, CAST(sum(n) AS BIGINT) AS total_calls, CAST(date_diff('day', min(call_date), max(call_date)) AS INTEGER) AS call_tenure,
 CAST(sum(CASE WHEN n >= 2 THEN 1 ELSE 0 END) AS BIGINT) AS total_same_day_calls, count(call_date) AS count_days_when_called,
 min(gap) AS time_from_install_to_first_call, avg(CAST(replace(CAST(call_date AS VARCHAR), '-', '') AS INTEGER)) AS avg_call_date
 FROM (SELECT k.account_guid, call_date, count(*) AS n, min(days_since_install) AS gap FROM ({source}) k {joined}
  WHERE {condition} GROUP BY k.account_guid, call_date) GROUP BY account_guid"""


# Promotions

_PROMO = {
    "OP_A": "(.*)(URGENT|HIGH)(.*)", "OP_B": "(.*)(LOW|AUTOMOBILE|MACHINERY)(.*)", "OP_C": "(.*)(MEDIUM|BUILDING\\+X|HOUSEHOLD)(.*)",
}
_CODE = "CASE operator " + " ".join(
    f"WHEN '{o}' THEN regexp_extract(promotion_description, '{p}', 2)" for o, p in _PROMO.items()
) + " END"
_CODE_FLAG = f"CASE WHEN {_CODE} <> '' THEN 1 ELSE 0 END"
_CODE_FLAG_RAW = _CODE_FLAG.replace("\\+", "+")


def _promo(condition: str) -> str:
    known = "promotion_description <> 'Unkown'"
    return f"""SELECT d.account_guid, n.account_number, d.operator, count(DISTINCT zip_code || zip_code_4) AS count_zip_code_changes,
 CAST(sum(truck_call_count) AS BIGINT) AS sum_truck_trouble_call, CAST(sum({_CODE_FLAG}) AS BIGINT) AS total_promo_flag,
 any_value(n.dwelling) AS most_recent_dwelling, any_value(n.flag) AS most_recent_promo_flag
 FROM accounts d JOIN (SELECT account_guid, account_number, dwelling, flag FROM (SELECT *, {_CODE_FLAG} AS flag,
   row_number() OVER (PARTITION BY account_guid ORDER BY snapshot_date DESC, account_number DESC, dwelling DESC, {_CODE_FLAG} DESC) AS rn
   FROM accounts WHERE {condition}) WHERE rn = 1) n ON d.account_guid = n.account_guid
 WHERE {condition} AND {known} GROUP BY d.account_guid, n.account_number, d.operator"""


def _promo_legacy(condition: str) -> str:
    return f"""SELECT account_guid, d.account_number, operator, count(DISTINCT zip_code || zip_code_4) AS count_zip_code_changes,
 CAST(sum(truck_call_count) AS BIGINT) AS sum_truck_trouble_call, CAST(sum({_CODE_FLAG_RAW}) AS BIGINT) AS total_promo_flag,
 most_recent_dwelling, most_recent_promo_flag FROM accounts d
 JOIN (SELECT DISTINCT h.account_number, h.dwelling AS most_recent_dwelling, {_CODE_FLAG_RAW} AS most_recent_promo_flag FROM history h
  JOIN (SELECT account_number AS number, operator AS o, max(snapshot_date) AS newest FROM accounts WHERE {condition} GROUP BY account_number, operator) m
  ON h.account_number = number AND h.operator = o AND h.snapshot_date = newest) z ON d.account_number = z.account_number
 WHERE {condition} AND promotion_description <> 'Unkown'
 GROUP BY account_guid, d.account_number, operator, most_recent_dwelling, most_recent_promo_flag"""


_SINCE, _SNAPSHOT = f"snapshot_date >= DATE '{v.PROMO_SINCE}'", f"snapshot_date = DATE '{v.AS_OF}'"

# Per-account tables of the two matrices


def _layer(prefix: str, own: str, everyone: str, first: str, period: int, calls: str, labels: bool, promo: str) -> None:
    """Registers the tables of one matrix as building blocks named after ``prefix``."""
    _add(f"{prefix}_q", _quality(own), own)
    for g in _GRAINS:
        _add(f"{prefix}_{g}", _peers(g, own, everyone), own, everyone)
    _add(f"{prefix}_quality", _full([f"{prefix}_q", *[f"{prefix}_{g}" for g in _GRAINS]]), f"{prefix}_q", *[f"{prefix}_{g}" for g in _GRAINS])
    _add(f"{prefix}_profile", _profile(own, period), own)
    _add(f"{prefix}_top", _top_channel(own), own)
    _add(f"{prefix}_std", _variability(own), own)
    _add(f"{prefix}_never", f"SELECT DISTINCT account_guid, never_logged_in FROM ({_never(first)})", "changes", "usage")
    _add(f"{prefix}_viewing", _full([f"{prefix}_{t}" for t in ("profile", "top", "std", "never")]),
         *[f"{prefix}_{t}" for t in ("profile", "top", "std", "never")])
    _add(f"{prefix}_calls", _calls(calls, labels=labels), "calls", "history", "labels")
    _add(f"{prefix}_changes", _CHANGE_PROFILE, "changes")
    _add(f"{prefix}_promo", f"SELECT * EXCLUDE (account_number, operator) FROM ({_promo(promo)})", "accounts")


def _full(names: list[str]) -> str:
    return f"SELECT * FROM {names[0]} " + " ".join(f"FULL OUTER JOIN {n} USING (account_guid)" for n in names[1:])


_layer("score", "scored_sessions", "scored_sessions", v.FIRST, v.PERIOD_DAYS, f"call_date <= DATE '{v.AS_OF}'", False, _SNAPSHOT)
_layer("train", "own_sessions", "label_sessions", v.FIRST_CHANGE, v.LABEL_DAYS + 1, "call_date < l.max_agg_date", True, _SINCE)
_layer("plain", "windowed", "windowed", v.FIRST_CHANGE, v.PERIOD_DAYS, f"call_date <= DATE '{v.AS_OF}'", False, _SINCE)
_add(
    "scored_sessions",
    """SELECT * FROM windowed WHERE account_guid IN (SELECT account_guid FROM active)
 AND account_guid NOT IN (SELECT account_guid FROM training)""", "windowed", "active", "training",
)
_add("search", _SEARCH, "pages")
_add("identity", """SELECT account_guid, operator, account_number, billing_id, system FROM (SELECT *, row_number() OVER (PARTITION BY account_guid
 ORDER BY operator DESC, account_number DESC, billing_id DESC, system DESC NULLS LAST) AS rn FROM active_ever) WHERE rn = 1""", "active_ever")
_add("identity_now", """SELECT account_guid, operator, account_number, billing_id, system FROM (SELECT *, row_number() OVER (PARTITION BY account_guid
 ORDER BY operator DESC, account_number DESC, billing_id DESC, system DESC NULLS LAST) AS rn FROM active) WHERE rn = 1""", "active")


def _chained(names) -> str:
    """Each table full-joined on the key of the one before it, the key of the first."""
    joins = " ".join(
        f"FULL OUTER JOIN {n} ON {names[i]}.account_guid = {n}.account_guid" for i, n in enumerate(names[1:])
    )
    columns = ", ".join([f"{names[0]}.*", *[f"{n}.* EXCLUDE (account_guid)" for n in names[1:]]])
    return f"SELECT {columns} FROM {names[0]} {joins}"


def _left(spine: str, tables: list[str]) -> str:
    return f"SELECT * FROM {spine} " + " ".join(f"LEFT JOIN {t} USING (account_guid)" for t in tables)


QUALITY_ALL = QUALITY_DOUBLES + [d for g in _GRAINS for d in peer_doubles(g)]
VIEWING_ALL = PROFILE_DOUBLES + ["avg_std_channel"]
MATRIX_DOUBLES = QUALITY_ALL + VIEWING_ALL + ["avg_call_date"] + CHANGE_DOUBLES

# Sparse tables that each miss accounts, and the chain of matrix joins

_add("sparse_a", f"SELECT account_guid, total_calls FROM ({_calls(f'call_date <= DATE {chr(39)}{v.AS_OF}{chr(39)}')})", "calls", "history")
_add("sparse_b", "SELECT account_guid, channel_watch_time FROM plain_top", "plain_top")
_add("sparse_c", "SELECT account_guid, count(total_price) AS total_price_changes FROM changes GROUP BY account_guid", "changes")

# The literal matrices: watch time in minutes, literal day parts, each table joined to the one before it.


def _literal(prefix: str, own: str, everyone: str, period: int, calls: str, labels: bool, promo: str) -> tuple[str, ...]:
    """Registers the tables of one literal matrix; their names in the order of the joins."""
    listed = ", ".join(f"'[' || CAST(CAST({c} AS DECIMAL(12, 2)) AS VARCHAR) || ']' AS {c}" for c in QUALITY_DOUBLES[-2:])
    _add(f"{prefix}_q", f"SELECT * REPLACE ({listed}) FROM ({_quality(own)})", own)
    for g in _GRAINS:
        _add(f"{prefix}_{g}", _peers(g, own, everyone, legacy=True), own, everyone)
    quality = tuple(f"{prefix}_{t}" for t in ("stream", "q", "channel", "week_part", "day_part"))
    _add(f"{prefix}_quality", _chained(quality), *quality)
    for table, text in (("profile", _profile(own, period)), ("top", _top_channel(own)), ("std", _variability(own))):
        _add(f"{prefix}_{table}", text, own)
    viewing = tuple(f"{prefix}_{t}" for t in ("profile", "top", "std"))
    _add(f"{prefix}_viewing", f"SELECT *, CAST(NULL AS INTEGER) AS never_logged_in FROM ({_chained(viewing)})", *viewing)
    _add(f"{prefix}_calls", _calls(calls, legacy=True, labels=labels), "calls", "history", "labels")
    _add(f"{prefix}_changes", _CHANGE_LEGACY, "changes")
    _add(f"{prefix}_promo", f"SELECT * EXCLUDE (account_number, operator) FROM ({_promo_legacy(promo)})", "accounts", "history")
    return (f"{prefix}_quality", f"{prefix}_viewing", "search", f"{prefix}_calls", f"{prefix}_changes", f"{prefix}_promo")


def _left_chain(names) -> str:
    """Each table left-joined on the key of the one before it."""
    joins = " ".join(f"LEFT JOIN {n} ON {names[i]}.account_guid = {n}.account_guid" for i, n in enumerate(names[1:]))
    columns = ", ".join([f"{names[0]}.*", *[f"{n}.* EXCLUDE (account_guid)" for n in names[1:]]])
    return f"SELECT {columns} FROM {names[0]} {joins}"


_add("minutes", f"SELECT * REPLACE (CAST(floor(watch_time_ms / 60000) AS BIGINT) AS watch_time_ms, {_day_part(True)}) FROM sessions", "sessions")
_add("literal_label_sessions", """SELECT s.*, l.churn, l.min_agg_date, l.max_agg_date FROM labels l JOIN minutes s ON l.account_guid = s.account_guid
 WHERE s.activity_date >= l.min_agg_date""", "labels", "minutes")
_add("literal_own", "SELECT * FROM literal_label_sessions WHERE activity_date <= max_agg_date", "literal_label_sessions")
_add("spine", "SELECT account_guid, churn FROM labels", "labels")
_add("active_labelled", "SELECT * FROM active_ever WHERE account_guid IN (SELECT account_guid FROM labels)", "active_ever", "labels")
LITERAL_TRAINING = ("spine", "active_labelled", *_literal(
    "lt", "literal_own", "literal_label_sessions", 60, "call_date < CAST(nullif(churn_date, '') AS DATE)", True, _SINCE))
LITERAL_SCORING = ("active", *_literal(
    "ls", "minutes_literal", "minutes_literal", v.PERIOD_DAYS, f"call_date <= DATE '{v.AS_OF}'", False, _SNAPSHOT))

_add(
    "model_input",
    """SELECT l.account_guid, churn, churn_date, active_day_cnt, mos_std_dev_acct, avg_mos_acct, weighted_avg_mos_acct,
 weighted_std_dev_acct, mos_bottom_10_percentile, mos_top_10_percentile FROM labels l LEFT JOIN plain_q q ON l.account_guid = q.account_guid""",
    "labels", "plain_q",
)
_MODEL = ("active_day_cnt", "avg_mos_acct", "mos_std_dev_acct", "weighted_avg_mos_acct", "mos_bottom_10_percentile", "mos_top_10_percentile")
_NUMERIC = ["churn", "churn_date", "active_day_cnt", *QUALITY_DOUBLES]
_numeric_sql = "SELECT account_guid, " + ", ".join(f"coalesce(try_cast({c} AS DOUBLE), 0) AS {c}" for c in _NUMERIC) + " FROM model_input"
_add("numeric", _numeric_sql, "model_input")
_PREDICTED = "SELECT churn, CAST(tv_stream_tenure < 10 AS INTEGER) AS prediction FROM labels"
_SIGNAL = "CASE WHEN sum(CASE WHEN total_price = 1 THEN 1 ELSE 0 END) + count(internet_package) > 10 THEN 1 ELSE 0 END"
_add("scored_labels", """SELECT churn, s, CAST(floor(s * 10000) AS INTEGER) AS bin FROM
 (SELECT churn, CAST(3 * tv_stream_tenure + customer_tenure AS DOUBLE) / 176.0 AS s FROM labels)""", "labels")
# Each score's bin against all rows, by joins instead of running sums.
_add("cuts", """SELECT c.bin, count(*) AS said, count(*) FILTER (churn = 1) AS hit FROM (SELECT DISTINCT bin FROM scored_labels) c
 JOIN scored_labels r ON r.bin >= c.bin GROUP BY c.bin""", "scored_labels")
_add("class_sizes", "SELECT count(*) AS n, count(*) FILTER (churn = 1) AS p FROM scored_labels", "scored_labels")
_add("best_cut", """SELECT c.*, 2.0 * hit / (said + p) AS f1, n, p FROM cuts c, class_sizes ORDER BY f1 DESC, bin DESC LIMIT 1""", "cuts", "class_sizes")


def _exact(seed: int, keys: str) -> str:
    """Rows of a table of accounts with their part in an exact split."""
    place = f"CAST('0x' || substr(md5('{seed}:' || account_guid), 1, 8) AS BIGINT)"
    return f"""SELECT *, CASE WHEN rn <= round_even(0.8 * n, 0) THEN 'train' WHEN rn <= round_even(0.8 * n, 0) + round_even(0.1 * n, 0) THEN 'valid'
 ELSE 'test' END AS split FROM (SELECT *, row_number() OVER (ORDER BY {place}, account_guid) AS rn, count(*) OVER () AS n FROM ({keys}))"""


def _session_counts(condition: str) -> str:
    return f"""SELECT account_guid, count(*) AS sessions, CAST(sum(watch_time_ms) AS BIGINT) AS watched FROM sessions
 WHERE {condition} GROUP BY account_guid"""


def _parts(expression: str, name: str) -> str:
    return f"""SELECT {name}, count(*) AS sessions, min(started) AS earliest_epoch_ms FROM
 (SELECT {expression}, {_MS.format(c='start_timestamp')} AS started FROM sessions_in) GROUP BY {name}"""


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    def put(name, text, *needs, doubles=(), dates=()):
        sql[name] = settle_sql(_with(text, *needs), doubles, dates)

    label_dates = ["connect_date", "convert_date", "min_agg_date", "max_agg_date"]
    put("label_windows", "SELECT * FROM labels", "labels", dates=label_dates)
    put("session_account_key", """SELECT operator, account_guid, count(*) AS sessions, max(activity_date) AS last_date FROM sessions
 GROUP BY operator, account_guid""", "sessions", dates=["last_date"])
    put("account_cipher", """SELECT DISTINCT account_number, operator, account_number AS decrypted, false AS readable, CASE operator
 WHEN 'OP_A' THEN substr(account_number, 4) WHEN 'OP_C' THEN CASE WHEN length(account_number) < 9 THEN lpad(account_number, 9, '0')
 ELSE account_number END ELSE account_number END AS billing_id FROM history""", "history")
    put("active_accounts", "SELECT * FROM active", "active")
    put("active_accounts_encrypted", "SELECT operator, account_number, billing_id, system FROM active", "active")
    put("active_accounts_labelled", """SELECT * FROM active_ever WHERE account_guid IN (SELECT account_guid FROM labels)""",
        "active_ever", "labels")
    put("labelled_sessions", """SELECT l.account_guid, l.min_agg_date, l.max_agg_date, l.churn, l.tv_stream_tenure, l.customer_tenure,
 l.connect_date, l.convert_date, s.stream_id, s.activity_date, s.start_timestamp, s.mos_score, s.watch_time_ms
 FROM labels l LEFT JOIN sessions s ON l.account_guid = s.account_guid""", "labels", "sessions",
        doubles=["mos_score"], dates=[*label_dates, "activity_date"])
    put("label_window_sessions", """SELECT account_guid, churn, min_agg_date, max_agg_date, count(*) AS sessions, min(activity_date) AS first_date,
 max(activity_date) AS last_date, CAST(sum(watch_time_ms) AS BIGINT) AS watched FROM own_sessions GROUP BY ALL""", "own_sessions",
        dates=["min_agg_date", "max_agg_date", "first_date", "last_date"])
    put("exclude_training_accounts", _session_counts("""account_guid IN (SELECT account_guid FROM active)
 AND account_guid NOT IN (SELECT account_guid FROM training)"""), "sessions", "active", "training")
    put("exclude_training_accounts_legacy", _session_counts("true"), "sessions")
    put("sessions_of_active", _session_counts("account_guid IN (SELECT account_guid FROM active)"), "sessions", "active")
    put("day_parts", _parts(_day_part(), "day_part"), "sessions_in")
    put("day_parts_legacy", _parts(_day_part(True), "day_part"), "sessions_in")
    put("week_parts", _parts(_WEEK_PART, "week_part"), "sessions_in")

    put("account_quality", _quality("windowed", _NORM), "windowed", doubles=[*QUALITY_DOUBLES, "weighted_mean_norm"])
    listed = ", ".join(
        f"'[' || CAST(CAST({c} AS DECIMAL(12, 2)) AS VARCHAR) || ']' AS {c}" for c in QUALITY_DOUBLES[-2:]
    )
    put("account_quality_legacy", f"SELECT * REPLACE ({listed}) FROM ({_quality('windowed')})", "windowed", doubles=QUALITY_DOUBLES[:-2])
    put("account_quality_labelled", _quality("own_sessions"), "own_sessions", doubles=QUALITY_DOUBLES)
    for grain in _GRAINS:
        put(f"peer_by_{grain}", _peers(grain), "windowed", doubles=peer_doubles(grain))
        put(f"peer_by_{grain}_legacy", _peers(grain, "windowed_minutes", "windowed_minutes", legacy=True), "windowed_minutes",
            doubles=peer_doubles(grain))
    put("peer_by_channel_labelled", _peers("channel", "own_sessions", "label_sessions"), "own_sessions", "label_sessions",
        doubles=peer_doubles("channel"))
    for name in ("account_quality_by_days", "account_quality_slid"):
        put(name, _quality("windowed", _NORM), "windowed", doubles=[*QUALITY_DOUBLES, "weighted_mean_norm"])
    put("account_quality_labelled_by_days", _quality("own_sessions"), "own_sessions", doubles=QUALITY_DOUBLES)
    put("peer_by_channel_labelled_by_days", _peers("channel", "own_sessions", "label_sessions"), "own_sessions", "label_sessions",
        doubles=peer_doubles("channel"))
    for grain in _GRAINS:
        put(f"peer_by_{grain}_by_days", _peers(grain), "windowed", doubles=peer_doubles(grain))
    put("quality_features_by_days", "SELECT * FROM plain_quality", "plain_quality", doubles=QUALITY_ALL)
    put("quality_features", "SELECT * FROM plain_quality", "plain_quality", doubles=QUALITY_ALL)
    _add("minutes_q", f"SELECT * REPLACE ({listed}) FROM ({_quality('windowed_minutes')})", "windowed_minutes")
    for g in _GRAINS:
        _add(f"minutes_{g}", _peers(g, "minutes_literal", "minutes_literal", legacy=True), "minutes_literal")
    chained = ("minutes_stream", "minutes_q", "minutes_channel", "minutes_week_part", "minutes_day_part")
    put("quality_features_legacy", _chained(chained), *chained, doubles=QUALITY_DOUBLES[:-2] + [d for g in _GRAINS for d in peer_doubles(g)])
    put("viewing_features_legacy", f"SELECT *, CAST(NULL AS INTEGER) AS never_logged_in FROM ({_chained(('plain_profile', 'plain_top', 'plain_std'))})",
        "plain_profile", "plain_top", "plain_std", doubles=VIEWING_ALL, dates=COUNT_DATES)
    sparse = ("sparse_a", "sparse_b", "sparse_c")
    put("union_of_sparse_tables", _full(list(sparse)), *sparse)
    put("union_of_sparse_tables_legacy", """SELECT a.account_guid, total_calls, channel_watch_time, total_price_changes FROM sparse_a a
 FULL OUTER JOIN sparse_b b ON a.account_guid = b.account_guid FULL OUTER JOIN sparse_c c ON b.account_guid = c.account_guid""", *sparse)

    put("viewing_flags", _per_account(_FLAG_COLUMNS), "windowed", doubles=FLAG_DOUBLES)
    put("viewing_devices", _per_account(_DEVICE_COLUMNS), "windowed")
    put("viewing_means", _per_account(_MEAN_COLUMNS), "windowed", doubles=MEAN_DOUBLES)
    put("viewing_counts", _per_account(_COUNT_COLUMNS), "windowed", doubles=COUNT_DOUBLES, dates=COUNT_DATES)
    put("viewing_distinct", _per_account(_distinct_columns(v.PERIOD_DAYS)), "windowed", doubles=["dist_date_percent"])
    put("viewing_profile", _profile("windowed", v.PERIOD_DAYS), "windowed", doubles=PROFILE_DOUBLES, dates=COUNT_DATES)
    put("top_channel", _top_channel("windowed"), "windowed")
    put("channel_variability", _variability("windowed"), "windowed", doubles=["avg_std_channel"])
    put("search_features", _SEARCH, "pages", doubles=SEARCH_DOUBLES)
    put("never_logged_in", _never(v.FIRST_CHANGE), "changes", "usage")
    put("never_logged_in_legacy", _never(v.FIRST_CHANGE, True), "changes", "usage")
    put("viewing_features", "SELECT * FROM plain_viewing", "plain_viewing", doubles=VIEWING_ALL, dates=COUNT_DATES)

    put("change_latest", f"SELECT * RENAME (change_event_date AS most_recent_change_date) FROM ({_NEWEST_ROW})", "changes",
        dates=["most_recent_change_date"])
    put("change_counts", f"SELECT account_guid, {_COUNTED_FLAGS}, {_RATIO} AS change_ratio FROM changes GROUP BY account_guid", "changes",
        doubles=["change_ratio"])
    spread = ", ".join(f"points[{i}] AS p{10 * i}" for i in range(1, 11))
    put("change_deciles", f"SELECT {spread}, std_dev, avg_price FROM ({_points('account_guid')})", "changes",
        doubles=[*[f"p{10 * i}" for i in range(1, 11)], "std_dev", "avg_price"])
    put("change_profile", _CHANGE_PROFILE, "changes", doubles=CHANGE_DOUBLES)
    put("change_profile_legacy", _CHANGE_LEGACY, "changes", doubles=CHANGE_DOUBLES)
    scoring, training = f"call_date <= DATE '{v.AS_OF}'", "call_date < l.max_agg_date"
    before_churn = "call_date < CAST(nullif(churn_date, '') AS DATE)"
    for name, text in (
        ("call_profile", _calls(scoring)), ("call_profile_legacy", _calls(scoring, legacy=True)),
        ("call_profile_before_churn", _calls(training, labels=True)),
        ("call_profile_before_churn_legacy", _calls(before_churn, legacy=True, labels=True)),
    ):
        put(name, text, "calls", "history", "labels", doubles=["avg_call_date"])
    put("promo_profile", _promo(_SNAPSHOT), "accounts")
    put("promo_profile_union", _promo(_SINCE), "accounts")
    put("promo_profile_legacy", _promo_legacy(_SINCE), "accounts", "history")

    train = ["train_quality", "train_viewing", "search", "train_calls", "train_changes", "train_promo"]
    put("feature_matrix", _left("(SELECT account_guid, churn FROM labels)", ["identity", *train]), "labels", "identity", *train,
        doubles=MATRIX_DOUBLES + SEARCH_DOUBLES, dates=COUNT_DATES)
    score = ["score_quality", "score_viewing", "search", "score_calls", "score_changes", "score_promo"]
    put("scoring_feature_matrix", _left("identity_now", score), "identity_now", *score, doubles=MATRIX_DOUBLES + SEARCH_DOUBLES,
        dates=COUNT_DATES)
    literal = [d for d in MATRIX_DOUBLES if d not in QUALITY_DOUBLES[-2:]] + SEARCH_DOUBLES
    put("feature_matrix_legacy", _left_chain(LITERAL_TRAINING), *LITERAL_TRAINING, doubles=literal, dates=COUNT_DATES)
    put("scoring_feature_matrix_legacy", _left_chain(LITERAL_SCORING), *LITERAL_SCORING, doubles=literal, dates=COUNT_DATES)
    put("tsv_export", f"SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({_promo(_SINCE)})", "accounts")

    put("numeric_coerce", _numeric_sql, "model_input", doubles=_NUMERIC)
    place = "CAST('0x' || substr(md5('7:' || account_guid), 1, 8) AS BIGINT) / 4294967296.0"
    put("hash_split", f"""SELECT account_guid, churn, CASE WHEN {place} < 0.8 THEN 'train' WHEN {place} < 0.9 THEN 'valid' ELSE 'test' END AS split
 FROM labels""", "labels")
    put("confusion_matrix", f"SELECT churn, prediction, count(*) AS rows FROM ({_PREDICTED}) GROUP BY churn, prediction", "labels")
    put("model_performance", f"""SELECT avg(CAST(churn = prediction AS INTEGER)) AS accuracy,
 {_ratio('sum(churn * prediction)', 'sum(prediction)')} AS precision, {_ratio('sum(churn * prediction)', 'sum(churn)')} AS recall,
 {_ratio('2 * sum(churn * prediction)', '(sum(churn) + sum(prediction))')} AS f1 FROM ({_PREDICTED})""", "labels",
        doubles=["accuracy", "precision", "recall", "f1"])
    checks = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM wide HAVING count(DISTINCT {c}) <= 1"
        for c in ("active_day_cnt", "avg_mos_acct", "outage", "never", "churn")
    )
    _add("wide", "SELECT *, 0 AS outage, CAST(NULL AS DOUBLE) AS never FROM model_input", "model_input")
    put("constant_columns", checks, "wide")
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS first_column, '{b}' AS second_column, corr({a}, {b}) AS correlation FROM numeric"
        for i, a in enumerate(_MODEL) for b in _MODEL[i + 1:]
    )
    put("correlations", pairs, "numeric", doubles=["correlation"])
    # Models: what SQL can tell of them.
    put("exact_split", f"SELECT account_guid, churn, split FROM ({_exact(7, 'SELECT account_guid, churn FROM labels')})", "labels")
    put("threshold_performance", """SELECT (SELECT sum(CASE WHEN a.bin > b.bin THEN 1.0 WHEN a.bin = b.bin THEN 0.5 ELSE 0 END) / any_value(p * (n - p))
  FROM scored_labels a, scored_labels b, class_sizes WHERE a.churn = 1 AND b.churn = 0) AS auc,
 (SELECT avg(-ln(greatest(least(CASE WHEN churn = 1 THEN s ELSE 1 - s END, 1 - 1e-15), 1e-15))) FROM scored_labels) AS log_loss,
 (SELECT avg((s - churn) * (s - churn)) FROM scored_labels) AS mse, bin / 10000.0::DOUBLE AS threshold, CAST(f1 AS DOUBLE) AS f1,
 CAST(n - said - p + 2 * hit AS DOUBLE) / n AS accuracy, CAST(hit AS DOUBLE) / said AS precision, CAST(hit AS DOUBLE) / p AS recall,
 hit AS tp, said - hit AS fp, p - hit AS fn, n - said - p + hit AS tn FROM best_cut""", "scored_labels", "class_sizes", "best_cut",
        doubles=["auc", "log_loss", "mse", "threshold", "f1", "accuracy", "precision", "recall"])
    put("gains_table", """SELECT CAST(i / 10.0 AS DOUBLE) AS share, bin / 10000.0::DOUBLE AS threshold, said AS rows, hit AS positives,
 CAST(hit AS DOUBLE) / p AS capture, CAST(hit * n AS DOUBLE) / (said * p) AS lift FROM (SELECT i, max(bin) AS bin FROM range(1, 11) t(i), cuts, class_sizes
 WHERE 10 * said >= i * n GROUP BY i) JOIN cuts USING (bin), class_sizes""", "cuts", "class_sizes", doubles=["share", "threshold", "capture", "lift"])
    put("category_index", """SELECT h.zip_code, CAST(coalesce(i, 11) AS DOUBLE) AS zip, count(*) AS rows FROM history h LEFT JOIN
 (SELECT zip_code, row_number() OVER (ORDER BY count(*) DESC, zip_code) - 1 AS i FROM history WHERE zip_code IS NOT NULL GROUP BY zip_code
  QUALIFY i < 11) t ON h.zip_code = t.zip_code GROUP BY ALL""", "history", doubles=["zip"])
    # Models: what a model must say if it has found the rule that the label was made by.
    put("boruta_selection", """SELECT unnest(['internet_package_changes', 'total_price_adds', 'noise', 'noise_b']) AS feature,
 unnest(['accepted', 'accepted', 'rejected', 'rejected']) AS decision""")
    told = "CAST({} AS INTEGER) AS points, true AS in_order, true AS splits_first, true AS as_stated, maxDepth > 0 AS found_rule"
    put("forest_grid", f"""SELECT *, {told.format(24)} FROM (SELECT CAST(unnest([5, 10, 30]) AS INTEGER) AS numTrees),
 (SELECT CAST(unnest([0, 3, 5, 6]) AS INTEGER) AS maxDepth), (SELECT unnest(['2', '4']) AS featureSubsetStrategy)""")
    put("boosted_grid", f"""SELECT *, {told.format(9)} FROM (SELECT CAST(unnest([2, 4, 20]) AS INTEGER) AS maxIter),
 (SELECT CAST(unnest([0, 2, 3]) AS INTEGER) AS maxDepth)""")
    put("boosted_grid_deep", "SELECT true AS found_rule, true AS stopped_inside FROM range(3)")
    put("forest_blocks", "SELECT true AS stopped_inside, true AS found_rule")
    put("forest_summary", "SELECT CAST(50 AS INTEGER) AS trees, CAST(3 AS INTEGER) AS max_depth, true AS leaves_fit, true AS splits")
    put("forest_importance", """SELECT unnest(['internet_package_changes', 'total_price_adds', 'noise']) AS feature, unnest([true, true, false]) AS top,
 unnest([true, true, false]) AS above_noise, unnest([false, false, true]) AS small""")
    put("useful_features", "SELECT unnest(['internet_package_changes', 'total_price_adds', 'flat']) AS feature, unnest([true, true, false]) AS kept")
    put("category_importance", "SELECT 'segment' AS first_feature, true AS found_rule")
    _add("planted", f"SELECT account_guid, {_SIGNAL} AS signal FROM changes GROUP BY account_guid", "changes")
    put("boosted_fit", f"""SELECT CAST(signal AS DOUBLE) AS label, count(*) AS rows, true AS mostly_right, true AS stopped_inside
 FROM ({_exact(0, 'SELECT * FROM planted')}) WHERE split = 'valid' GROUP BY signal""", "planted", doubles=["label"])
    _add("planted_labels", "SELECT l.account_guid, coalesce(signal, 0) AS signal FROM labels l LEFT JOIN planted p ON p.account_guid = l.account_guid",
         "labels", "planted")
    put("model_chain", f"""SELECT CAST(signal AS DOUBLE) AS label, count(*) AS rows, true AS mostly_right, true AS signals_accepted
 FROM ({_exact(7, 'SELECT * FROM planted_labels')}) WHERE split = 'test' GROUP BY signal""", "planted_labels", doubles=["label"])
    put("rebuilt_table", "SELECT * FROM labels", "labels", dates=label_dates)
    put("replaced_day", f"""SELECT call_date, days_since_install + CAST(call_date = DATE '{v.AS_OF}' AS INTEGER) AS days_since_install,
 company_code, subaccount FROM calls WHERE call_date <> DATE '{v.FIRST}'""", "calls", dates=["call_date"])
    sql["label_window_sessions_by_day"] = sql["label_window_sessions"]
    put("sessions_of_active_by_day", _session_counts(f"""account_guid IN (SELECT account_guid FROM active)
 AND activity_date BETWEEN DATE '{v.FIRST}' AND DATE '{v.AS_OF}'"""), "sessions", "active")
    put("parameter_query", f"SELECT operator, count(*) AS sessions FROM sessions_in WHERE activity_date = DATE '{v.AS_OF}' GROUP BY operator",
        "sessions_in")
    put("delimited_file", """SELECT account_guid AS account, CAST(churn AS VARCHAR) AS left_us, CAST(tv_stream_tenure AS VARCHAR) AS tenure
 FROM labels_in""", "labels_in")
    put("names_file", " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS accounts FROM model_input" for c in _MODEL), "model_input")
    return sql
