"""DuckDB SQL for each query key.

The texts read fields by regular expression, so they share no parsing logic
with the operators they check.
"""

from __future__ import annotations

from footfall import fixtures
from footfall.fixtures import FIXTURE_CONFIG as CONFIG

ORACLES: dict[str, str] = {}

_LINE = r"^[^|]*\|_\|[^|]*\|_\|([^T|]*)T((?:[01][0-9]|2[0-3]):[0-5][0-9])[^|]*\|_\|[^?]*\?([^?]*)"
_KEYS = {
    "ws": "WS", "sws": "SWSPID", "cuc": "CUC", "rc": "RC", "un": "UN",
    "ps": "PS", "pu": "PU", "tt": "TT", "cle": "CLE",
}
_GOODS = r"\|\|show::goodsstore::[1-9]\d*::\d::[a-z]+\|\|"


def _value(key: str) -> str:
    found = f"regexp_matches('&' || query || '&', '&{key}=[^&=]*&')"
    value = f"regexp_extract('&' || query || '&', '^.*&{key}=([^&=]*)&', 1)"
    return f"case when {found} then coalesce(nullif({value}, ''), 'NULL') end"


def _decoded(column: str, sentinel: str) -> str:
    text = f"url_decode(url_decode(url_decode(coalesce({column}, '{sentinel}'))))"
    return (
        f"case when regexp_matches({text}, '%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)')"
        f" then 'NULL' else {text} end"
    )


def _mall(branch) -> str:
    rules = CONFIG.malls
    hosts = ", ".join(f"'{h}'" for h in branch.hosts)
    tokens = "|".join(branch.payment_tokens)
    return (
        f"(coalesce(ps, '') in ({hosts})"
        f" or (coalesce(ps, '') = '{rules.payment_host}' and regexp_matches(page_url, '{tokens}'))"
        f" or (coalesce(ps, '') = '{rules.community_host}'"
        f" and page_url like '%{branch.community_token}%')"
        f" or lower(page_url) = '{branch.shop_url}')"
    )


_MAIN, _SECOND = (_mall(b) for b in CONFIG.malls.branches)
_SITES = ", ".join(f"'{s}'" for s in CONFIG.site_list)
_SUBS = ", ".join(f"'{s}'" for s in CONFIG.sub_sites)

BASE = f"""
with hits as ({fixtures.HITS_SQL}),
goods as ({fixtures.GOODS_SQL}),
website as ({fixtures.WEBSITE_SQL}),
clicks as ({fixtures.CLICKS_SQL}),
pairs as ({fixtures.PAIRS_SQL}),
campaigns as ({fixtures.CAMPAIGNS_SQL}),
rec as (
  select event_id, arrival, line,
    regexp_extract(line, '{_LINE}', 1) as date,
    regexp_extract(line, '{_LINE}', 2) || ':00' as minute,
    regexp_extract(line, '{_LINE}', 3) as query,
    regexp_extract(line, 'T([0-9:]{{8}})', 1) as clock
  from hits
  where regexp_matches(line, '{_LINE}') and regexp_matches(line, '\\?.*[^?]')
),
fld0 as (
  select *, {", ".join(f"{_value(k)} as {n}" for n, k in _KEYS.items())} from rec
),
fld as (
  select *, {_decoded("pu", "PU-NULL")} as page_url, {_decoded("tt", "TT-NULL")} as title,
    coalesce(cuc, 'CUC-NULL') as visitor, nullif(un, 'NULL') as named
  from fld0
),
malls as (select *, {_MAIN} as in_main, {_SECOND} as in_second from fld),
visible as (select * from malls where not contains(lower(line), 'spider')),
g as (
  select * from visible
  where ws = '{CONFIG.main_site}' and cle is null and (in_main or in_second)
),
act as (select * from g where contains(page_url, '/activity/')),
gev0 as (
  select event_id, date, minute, clock, ws,
    regexp_extract_all(cle, '{_GOODS}') as texts,
    unnest(generate_series(1, len(regexp_extract_all(cle, '{_GOODS}')))) as i
  from visible
  where ws = '{CONFIG.main_site}' and (in_main or in_second) and cle is not null
),
gev as (
  select event_id, date, minute, clock, cast(i - 1 as int) as pos,
    regexp_extract(texts[i], '::([a-z]+)\\|', 1) as port,
    regexp_extract(texts[i], 'goodsstore::(\\d+)::', 1) as pcode,
    cast(regexp_extract(texts[i], '::(\\d)::[a-z]', 1) as int) as state
  from gev0
),
gdim as (
  select goods_name, goods_business_cd as pcode, website_name
  from goods left join website using (website_cd)
),
clk as (
  select line, ts, split_part(line, ' ', 3) as category, split_part(line, ' ', 2) as item
  from clicks
),
daily as (
  select date, ws, count(*) as pv, count(distinct visitor) as uv,
    count(distinct case when rc = '0' then visitor end) as rc, count(distinct named) as un
  from g group by date, ws
),
mins as (select distinct date, ws, minute from g),
running as (
  select m.date, m.ws, m.minute, count(*) as pv, count(distinct visitor) as uv,
    count(distinct case when rc = '0' then visitor end) as rc, count(distinct named) as un
  from mins m join g on g.date = m.date and g.ws = m.ws and g.minute <= m.minute
  group by m.date, m.ws, m.minute
)
"""


def _add(name: str, text: str) -> None:
    ORACLES[name] = BASE + text


def _four(dims: str, source: str) -> str:
    return (
        f"select {dims}, count(*) as pv, count(distinct visitor) as uv,"
        " count(distinct case when rc = '0' then visitor end) as rc,"
        f" count(distinct named) as un from {source} group by {dims}"
    )


# -- sources and sinks ------------------------------------------------------

_add("scan_hits_day", "select line from hits where line like '%|_|2024-01-15T%'")
_add("stream_hits", "select event_id, arrival, line from hits")
_add("stream_clicks", "select category, item, count(*) as n from clk group by category, item")
_add(
    "scan_dim_tables",
    "select goods_name, goods_business_cd, website_cd, website_name"
    " from goods join website using (website_cd)",
)
_add("scan_tab_pairs", "select name, second_name from pairs")

_LONG = """
long as (
  select 'PV' as kind, date, ws as site, pv as value from daily
  union all select 'UV', date, ws, uv from daily
  union all select 'RC', date, ws, rc from daily
  union all select 'UN', date, ws, un from daily
)
"""


def _add_long(name: str, text: str) -> None:
    _add(name, f", {_LONG} {text}")


_add_long(
    "scan_metric_snapshot", "select kind, date, site, value from long where date = '2024-01-15'"
)
_add_long("metric_key_parse", "select kind, date, site, value from long")
_add("export_daily_metrics", "select date, ws, uv, pv from daily")
_add("sink_minute_snapshot", "select * from running")
_add(
    "upsert_activity_metrics",
    f", met as ({_four('date, code', 'act join campaigns using (title)')})"
    " select date, code, pv, uv, rc, un from met"
    " union all select date, 'tt0', pv, uv, rc, un from daily",
)
_add(
    "goods_state_upsert",
    """
, latest as (
  select port, pcode, arg_max(state, (date || clock, event_id, pos)) as state
  from gev group by port, pcode
)
select website_name, port, pcode, goods_name,
  cast(case when port = 'wap' then state else 9 end as int) as state
from latest left join gdim using (pcode)
""",
)
_RUNNING_PV = """
select date, ws, minute,
  cast(sum(count(*)) over (partition by date, ws order by minute) as bigint) as pv
from g group by date, ws, minute
"""
_add("running_pv", _RUNNING_PV)
_add("sort_minutes", _RUNNING_PV)
_add(
    "sink_running_list",
    f"select date, minute, minute || '--' || cast(pv as varchar) as entry from ({_RUNNING_PV})",
)
_add("sink_minute_metrics_batch", _four("date, ws, minute", "g"))
_TOP = """
select category, item, click_count from (
  select category, item, click_count,
    row_number() over (partition by category order by click_count desc, item) as r
  from (select category, item, count(*) as click_count from clk group by category, item)
) where r <= 3
"""
_add("topn_per_category", _TOP)
_add("sink_topn", _TOP)
_add("register_view", "select date, pv, uv from daily where uv < pv")

# -- projections ------------------------------------------------------------

_add("parse_records", "select event_id, date, minute, query from rec")


def _params(empty: str, output: str) -> str:
    return rf"""
, seg as (
  select event_id, unnest(string_split(query, '&')) as s,
    unnest(generate_series(1, len(string_split(query, '&')))) as i
  from rec
),
kv as (
  select event_id, i, regexp_extract(s, '^([^=]+)', 1) as key,
    coalesce(nullif(regexp_extract(s, '^[^=]+=([^=]+)=*$', 1), ''), '{empty}') as value
  from seg where regexp_full_match(s, '[^=]+(=[^=]+)?=*')
),
lastkv as (
  select event_id, key, arg_max(value, i) as value from kv group by event_id, key
)
{output}
"""


_TEXT = (
    "select event_id, string_agg(key || '=' || value, '&' order by key || '=' || value)"
    " as params_text from lastkv group by event_id"
)
_add("parse_params", _params("NULL", _TEXT))
_add("parse_params_blank", _params("", _TEXT))
_add("explode_params", _params("NULL", "select event_id, key, value from lastkv"))
_add("event_date", "select event_id, date as event_date from rec")
_add("event_date_compact", "select event_id, replace(date, '-', '') as event_date_compact from rec")
_add("event_minute", "select event_id, minute as event_minute from rec")
_add("event_minute_short", "select event_id, minute[1:5] as event_minute_short from rec")
_add(
    "minute_epoch_ms",
    "select event_id, cast(epoch_ms(cast(date || ' ' || minute as timestamp)) as varchar)"
    " as minute_epoch_ms from rec",
)
_add(
    "field_defaults",
    "select event_id, "
    + ", ".join(f"coalesce({n}, '{k}-NULL') as {n}" for n, k in _KEYS.items())
    + " from fld",
)
_add("url_decode_n", "select event_id, page_url, title from fld")
_add(
    "member_key",
    "select event_id, coalesce(ws, 'WS-NULL') || visitor as cuc_key,"
    " coalesce(ws, 'WS-NULL') || coalesce(un, 'UN-NULL') as un_key from fld",
)
_add("site_label", "select event_id, coalesce(ws, '00000000') as site, 'main' as label from fld")
_add("goods_events", "select event_id, date, minute, pos, port, pcode, state from gev")
_add("click_key", "select line, category, item from clk")
_add("pair_key", "select name, second_name, name || second_name as pair from pairs")

# -- filters ----------------------------------------------------------------

for _name, _source, _test in (
    ("filter_bots", "hits", "not contains(lower(line), 'spider')"),
    ("filter_main_site_raw", "hits", f"contains(line, 'WS={CONFIG.main_site}&')"),
    ("filter_raw_tokens", "hits", "line not like '%AWS%' and line not like '%CLE%'"),
    ("filter_activity_raw", "hits", "line like '%activity%'"),
    ("filter_shop_flow", "malls", "in_main or in_second"),
    ("filter_main_site", "fld", f"ws = '{CONFIG.main_site}'"),
    ("filter_site_list", "fld", f"ws in ({_SITES})"),
    ("filter_no_click_event", "fld", "cle is null"),
    ("filter_activity_path", "fld", "page_url like '%/activity/%'"),
    ("filter_activity_word", "fld", "page_url like '%activity%'"),
    ("filter_campaign_title", "fld", "title = 'Big Sale 0'"),
    ("filter_goods_event", "fld", f"cle is not null and regexp_matches(cle, '{_GOODS}')"),
):
    _add(_name, f"select event_id from {_source} where {_test}")

_add(
    "classify_mall",
    "select event_id, 'main' as mall from malls where in_main"
    " union all select event_id, 'second' from malls where in_second",
)
_add(
    "rejects",
    r"""
select event_id, line,
  case when len(string_split(line, '|_|')) < 4 then 'fields'
    when not regexp_matches(line, '^[^|]*\|_\|[^|]*\|_\|[^T|]*T(?:[01][0-9]|2[0-3]):[0-5][0-9]') then 'time'
    else 'query' end as reason
from hits anti join rec using (event_id)
""",
)

# -- joins ------------------------------------------------------------------

_add("goods_dim_left_join", "select goods_name, pcode, website_name from gdim")
_add(
    "goods_state_enriched",
    "select event_id, pos, port, gev.pcode, state, goods_name, website_name"
    " from gdim right join gev on gdim.pcode = gev.pcode",
)
_add("campaign_lookup", "select event_id, title, code from act join campaigns using (title)")
_add(
    "unregistered_titles",
    "select distinct date, title from act where title not in (select title from campaigns)",
)
_add("subsite_lookup", f"select event_id, sws from g where sws in ({_SUBS})")

_METRICS = ("pv", "uv", "rc", "un")
_PREV = (
    "from running r left join running p on p.date = r.date and p.ws = r.ws"
    " and cast(p.date || ' ' || p.minute as timestamp) + interval 1 minute"
    " = cast(r.date || ' ' || r.minute as timestamp)"
)
_add(
    "prev_minute_join",
    "select r.date, r.ws, r.minute, r.pv, r.uv, r.rc, r.un, "
    + ", ".join(f"p.{m} as prev_{m}" for m in _METRICS)
    + f" {_PREV}",
)
_add(
    "delta_prev_minute",
    "select r.date, r.ws, r.minute, "
    + ", ".join(f"r.{m} - coalesce(p.{m}, 0) as {m}" for m in _METRICS)
    + f" {_PREV}",
)
_add(
    "delta_prev_snapshot",
    "select date, ws, minute, "
    + ", ".join(
        f"{m} - coalesce(lag({m}) over (partition by date, ws order by minute), 0) as {m}"
        for m in _METRICS
    )
    + " from running",
)

# -- aggregations -----------------------------------------------------------

for _m in _METRICS:
    _add(f"{_m}_by_day", f"select date, ws, {_m} from daily")
_add(
    "un_by_day_sentinel",
    "select date, ws, count(distinct coalesce(un, 'UN-NULL')) as un from g group by date, ws",
)
_add(
    "un_by_day_blank",
    "select date, ws, count(distinct coalesce(named, '')) as un from g group by date, ws",
)
_add(
    "un_by_day_one",
    "select date, ws, count(distinct coalesce(un, '1')) as un from g group by date, ws",
)
_add("pvuv_by_day", "select * from daily")
_add(
    "pvuv_by_day_raw",
    _four(
        "date, ws",
        f"(select * from visible where contains(line, 'WS={CONFIG.main_site}&')"
        " and line not like '%CLE%' and (in_main or in_second))",
    ),
)
_add("pv_uv_by_day", "select date, ws, pv, uv from daily")
_add(
    "pv_uv_all_sites",
    """
select replace(date, '-', '') as date, coalesce(ws, '00000000') as ws,
  count(*) as pv, count(distinct coalesce(cuc, '11111111')) as uv
from fld where line not like '%AWS%' and line not like '%CLE%' group by 1, 2
""",
)
_add(
    "pvuv_by_minute",
    "select date, minute, count(*) as pv, count(distinct visitor) as uv from g"
    " group by date, minute",
)
_add(
    "rc_un_by_minute",
    "select date, minute, count(distinct case when rc = '0' then visitor end) as rc,"
    " count(distinct named) as un from g group by date, minute",
)
_add("pvuv_by_subsite", _four("date, sws", f"(select * from g where sws in ({_SUBS}))"))
_add(
    "pvuv_by_site_list",
    _four("date, ws", f"(select * from visible where ws in ({_SITES}) and cle is null)"),
)
_add("pvuv_by_activity", _four("date, code", "act join campaigns using (title)"))
_add(
    "pvuv_by_activity_raw",
    _four(
        "date, code",
        "(select * from g where line like '%activity%') join campaigns using (title)",
    ),
)
_add("minute_pv", "select date, minute, count(*) as pv from g group by date, minute")
_TITLE = "(select * from act where title = 'Big Sale 0')"
_add(
    "activity_minute_pv",
    f"select date, minute, count(*) as pv from {_TITLE} group by date, minute",
)
_add(
    "running_activity_pv",
    "select date, minute, cast(sum(count(*)) over (partition by date order by minute) as bigint)"
    f" as pv from {_TITLE} group by date, minute",
)
_add(
    "goods_state_latest",
    "select date, port, pcode, arg_max(state, (clock, event_id, pos)) as state"
    " from gev group by date, port, pcode",
)
_add("pair_counts", "select name || second_name as pair, count(*) as n from pairs group by 1")
_add(
    "pair_first",
    "select name || second_name as pair, min(name) as name, arg_min(second_name, (name, second_name))"
    " as second_name from pairs group by 1",
)
_add("hit_count", "select count(*) as n from g")

# -- windows ----------------------------------------------------------------

_add("running_pvuv", "select * from running")


def _running_four(dims: str, source: str) -> str:
    keys = [key.strip() for key in dims.split(",")]
    same = " and ".join(f"g.{key} = m.{key}" for key in keys)
    return (
        f", src as (select * from {source}), moments as (select distinct {dims}, minute from src)"
        f" select {', '.join('m.' + key for key in keys)}, m.minute, count(*) as pv,"
        " count(distinct visitor) as uv, count(distinct case when rc = '0' then visitor end) as rc,"
        f" count(distinct named) as un from moments m join src g on {same} and g.minute <= m.minute"
        f" group by {', '.join('m.' + key for key in keys)}, m.minute"
    )


_add("running_activity_metrics", _running_four("date, code", "(select * from act join campaigns using (title))"))
_add(
    "running_site_list_metrics",
    _running_four("date, ws", f"(select * from visible where ws in ({_SITES}) and cle is null)"),
)


def _hwm(output: str, across_days: bool = False) -> str:
    """Simulate the mark hit by hit with a running maximum over arrival order."""
    mark = "date || ' ' || minute"
    scope = "ws" if across_days else "date, ws"
    return f"""
, ordered as (
  select *, max({mark}) over (
    partition by {scope} order by arrival, event_id
    rows between unbounded preceding and 1 preceding) as mark
  from g
),
emits as (
  select date, ws, minute, arrival, event_id from ordered
  where mark is not null and {mark} > mark
),
snapshots as (
  select e.date, e.ws, e.minute, count(*) as pv, count(distinct visitor) as uv,
    count(distinct case when rc = '0' then visitor end) as rc, count(distinct named) as un
  from emits e join g on g.date = e.date and g.ws = e.ws
    and (g.arrival, g.event_id) <= (e.arrival, e.event_id)
  group by e.date, e.ws, e.minute
)
{output}
"""


_add("hwm_snapshot", _hwm("select * from snapshots"))
_add(
    "delta_hwm_snapshot",
    _hwm(
        "select date, ws, minute, "
        + ", ".join(
            f"cast({m} - lag({m}, 1, 0) over (partition by date, ws order by minute) as bigint) as {m}"
            for m in ("pv", "uv", "rc", "un")
        )
        + " from snapshots"
    ),
)
def _shared(group: str, source: str, marks: str) -> str:
    return f"""
, src as (select * from {source}),
ordered as (
  select date, minute, arrival, event_id, max(minute) over (
    partition by date order by arrival, event_id rows between unbounded preceding and 1 preceding) as mark
  from {marks}
),
emits as (select * from ordered where mark is not null and minute > mark)
select e.date, s.{group}, e.minute, count(*) as pv, count(distinct visitor) as uv,
  count(distinct case when rc = '0' then visitor end) as rc, count(distinct named) as un
from emits e join src s on s.date = e.date and (s.arrival, s.event_id) <= (e.arrival, e.event_id)
group by e.date, s.{group}, e.minute
"""


_add(
    "hwm_snapshot_site_list",
    _shared("ws", f"(select * from visible where ws in ({_SITES}) and cle is null)", "src"),
)
_add("hwm_snapshot_activity", _shared("code", "(select * from act join campaigns using (title))", "g"))
_add("hwm_snapshot_across_days", _hwm("select * from snapshots", across_days=True))
_add(
    "emitted_minutes",
    _hwm("select date, count(*) as emitted from snapshots group by date"),
)
_CODES = """
, firsts as (
  select title, min(date || ' ' || minute) as seen from g
  where contains(page_url, 'activity') and title not in (select title from campaigns)
  group by title
),
codes as (
  select title, code from campaigns
  union all
  select title, 'tt' || cast(2 + row_number() over (order by seen, title) as varchar) from firsts
)
"""
_add("campaign_codes", _CODES + "select title, code from codes")

# -- streaming: the final result is that of the batch -----------------------

_add("stream_pvuv_by_day", "select * from daily")
_add("stream_uv", "select date, ws, uv from daily")
_add("stream_snapshot", "select * from running")
_add("stream_hwm_snapshot", _hwm("select * from snapshots", across_days=True))
_add("refit_day", "select * from daily")
_add("stream_pvuv_by_minute", _four("date, minute, ws", "g"))
_add("stream_pvuv_by_subsite", ORACLES["pvuv_by_subsite"].removeprefix(BASE))
_add("stream_pvuv_by_site_list", ORACLES["pvuv_by_site_list"].removeprefix(BASE))
_add("stream_pv_uv_all_sites", ORACLES["pv_uv_all_sites"].removeprefix(BASE))
_add(
    "stream_pvuv_late",
    ", dated as (select * replace (case when event_id % 97 = 0 then '2099-12-31'"
    " when event_id % 89 = 0 then '2023-12-25' else date end as date) from g) "
    + _four("date, ws", "dated"),
)
_add(
    "stream_activity",
    _CODES
    + ", word as (select g.*, code from g join codes using (title)"
    " where contains(page_url, 'activity')) "
    + _four("date, code, title", "word").replace("count(*) as pv", "max(minute) as minute, count(*) as pv"),
)
_add(
    "stream_goods_state",
    """
, latest as (
  select port, pcode, arg_max(state, (date || clock, event_id, pos)) as state
  from gev group by port, pcode
)
select website_name, port, pcode, goods_name, state from latest left join gdim using (pcode)
""",
)
_SLIDING = """
, windows as (
  select category, item,
    time_bucket(interval '8 hours', ts, timestamp '1970-01-01') - k * interval '8 hours' as w
  from clk cross join (select unnest([0, 1, 2]) as k)
),
sliding as (
  select strftime(w, '%Y-%m-%d %H:%M') as window_start, category, item, count(*) as click_count
  from windows group by w, category, item
)
"""
_add("sliding_click_counts", _SLIDING + "select * from sliding")
_add(
    "stream_topn_sliding",
    _SLIDING
    + """
select window_start, category, item, click_count from (
  select *, row_number() over (
    partition by window_start, category order by click_count desc, item) as r
  from sliding
) where r <= 3
""",
)
_add(
    "stream_audit",
    r"""
, bounds as (select min(arrival) as low, (max(arrival) - min(arrival)) / 4.0 as width from hits),
marked as (
  select least(cast(floor((arrival - low) / width) as bigint), 3) as batch_id,
    case when contains(lower(line), 'spider') then 'bot'
      when event_id in (select event_id from rec) then 'kept'
      when len(string_split(line, '|_|')) < 4 then 'fields'
      when not regexp_matches(line, '^[^|]*\|_\|[^|]*\|_\|[^T|]*T(?:[01][0-9]|2[0-3]):[0-5][0-9]') then 'time'
      else 'query' end as reason
  from hits cross join bounds
)
select batch_id, count(*) as lines, count(*) filter (reason = 'kept') as kept, count(*) filter (reason = 'bot') as bot,
  count(*) filter (reason = 'fields') as fields, count(*) filter (reason = 'time') as time,
  count(*) filter (reason = 'query') as query
from marked group by batch_id
""",
)
_add(
    "land_hits",
    "select event_id, date, minute, ws, cuc, page_url, contains(lower(line), 'spider') as bot from fld",
)
_add("pvuv_by_day_landed", "select * from daily where date = '2024-01-15'")
_add(
    "uv_rollup",
    f"""
, s as (select * from visible where ws in ({_SITES}) and cle is null)
select 'date-ws' as level, date, ws, count(distinct visitor) as uv from s group by date, ws
union all select 'date', date, '', count(distinct visitor) from s group by date
union all select 'ws', '', ws, count(distinct visitor) from s group by ws
union all select 'all', '', '', count(distinct visitor) from s
""",
)
