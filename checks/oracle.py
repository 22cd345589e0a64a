"""DuckDB SQL with the meaning of each registered query, written independently."""

TRADES = """
trades as (
  select 'S' || (user_id % 6) as symbol, cast(ts as date) as event_date, value as price,
         cast(json_extract_string(props, '$.k') as double) as size, event_type as exchange,
         case event_id % 4 when 0 then ['@'] when 1 then ['@', 'I'] when 2 then ['@', 'T', 'I'] end
           as conditions,
         case user_id % 3 when 0 then 'A' when 1 then 'B' else 'C' end as tape,
         event_id as id, ts
  from events)"""

RECOS = """
recos as (
  select 'S' || (user_id % 6) as symbol,
         cast(date_trunc('week', ts) + interval 7 day as date) as event_date,
         count(*) filter (event_type = 'view') as buy,
         count(*) filter (event_type = 'click') as hold,
         count(*) filter (event_type = 'error') as sell,
         count(*) filter (event_type = 'purchase') as "strongBuy",
         count(*) filter (event_type = 'signup') as "strongSell"
  from events where 'S' || (user_id % 6) <> 'S5' group by 1, 2)"""

MESSAGES = """
messages as (
  select event_id as id,
         case when event_id % 50 = 7 then '' else 'S' || (user_id % 6) end as symbol,
         case when event_id % 50 <> 9 then strftime(ts, '%Y-%m-%d') end as event_date,
         case event_id % 3 when 0 then 'RECO' when 1 then 'NEWS' end as type
  from events)"""

_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
_DAY = "strftime({0}, '%Y-%m-%d')"

INDEX = """
{0}_codes as (
  select {0}, cast(row_number() over (order by count(*) desc, {0}) - 1 as double) as {0}_index
  from trades group by {0})"""

ROLLED = """
rolled as (
  select *, avg(price) over w as rolling_avg_price, stddev_samp(price) over w as rolling_std_price,
         sum(size) over w as cumulative_volume
  from trades
  window w as (partition by symbol, event_date order by ts, id
               rows between 10 preceding and current row))"""

FEATURES = (
    ROLLED
    + ","
    + INDEX.format("exchange")
    + ","
    + INDEX.format("tape")
    + """,
features as (
  select symbol, strftime(event_date, '%Y-%m-%d') as event_date, price, size, exchange_index,
         tape_index, cast(list_contains(conditions, '@') as int) as condition_at,
         cast(list_contains(conditions, 'I') as int) as condition_i,
         cast(list_contains(conditions, 'T') as int) as condition_t,
         cast(hour(ts) as int) as hour, cast(minute(ts) as int) as minute,
         cast(second(ts) as int) as second, cast(dayofweek(ts) + 1 as int) as day_of_week,
         cast(floor(epoch(ts)) as bigint) as timestamp_epoch,
         rolling_avg_price, rolling_std_price, cumulative_volume
  from rolled join exchange_codes using (exchange) join tape_codes using (tape))"""
)


def bars_cte(size, source="trades", ts="ts", order="(ts, id)"):
    """Bars of one size; min and max by a (time, id) pair give open and close."""
    return f"""
bars as (
  select time_bucket(interval '{size}', {ts}, timestamp '1970-01-01') as bar_start, symbol,
         event_date,
         arg_min(price, {order}) as open_price, max(price) as high_price, min(price) as low_price,
         arg_max(price, {order}) as close_price,
         sum(price * size) / nullif(sum(size), 0) as vwap, sum(size) as volume_sum,
         count(*) as trade_count, stddev_samp(price) as volatility_price
  from {source} group by 1, 2, 3)"""


def _bar_select(day=_DAY.format("event_date"), where=""):
    return f"""
select {_TS.format("bar_start")} as bar_start, symbol, {day} as event_date, open_price, high_price,
       low_price, close_price, round(vwap, 6) as vwap, volume_sum, trade_count,
       round(volatility_price, 6) as volatility_price
from bars {where}"""


def _enriched(source, bar_start=True):
    start = f", {_TS.format('bar_start')} as bar_start" if bar_start else ""
    return f"""
select b.symbol, {_DAY.format("b.event_date")} as event_date, close_price, volume_sum as volume,
       round(volatility_price, 6) as volatility, trade_count as nb_transactions,
       {_DAY.format("r.event_date")} as reco_event_date, buy as buy_score, sell as sell_score,
       "strongBuy" as strong_buy_score, "strongSell" as strong_sell_score, hold as hold_score
       {start}
from {source}"""


ASOF = "bars b asof left join recos r on b.symbol = r.symbol and b.event_date >= r.event_date"

_RECO_COLUMNS = (
    f'symbol, {_DAY.format("event_date")} as event_date, buy, hold, sell, "strongBuy", "strongSell"'
)
_TRADE_COLUMNS = (
    f"symbol, {_DAY.format('event_date')} as event_date, price, size, exchange, tape, id, "
    f"{_TS.format('ts')} as timestamp_parsed"
)
_CONDITIONS = "array_to_string(conditions, ',') as conditions"
_FILLED = "coalesce(symbol, '') <> '' and coalesce(event_date, '') <> ''"

_ROUNDED = """select * replace (round(rolling_avg_price, 6) as rolling_avg_price,
  round(rolling_std_price, 6) as rolling_std_price) from features"""

_ROUTED = """
routed as (
  select *, case type when 'RECO' then 'recos' when 'NEWS' then 'news' else 'trades' end as feed,
         case when symbol is null or event_date is null then 'missing key'
              when type is not null and symbol = '' then 'missing key' end as reason
  from messages)"""

_CHUNKED = """
numbered as (
  select symbol, event_date, id,
         cast(floor((row_number() over (partition by symbol, event_date order by id) - 1) / 25)
           as bigint) as chunk
  from trades)"""

_CALENDAR = f"""
with days as (select distinct cast(o_orderdate as date) as day from orders)
select {_DAY.format("day")} as day, {_DAY} as {{1}} from days"""

_EXPECTED = """
expected as (
  select symbol, event_date
  from (select unnest(['S0', 'S1', 'S2', 'S3', 'S4', 'S5', 'S6']) as symbol),
       (select distinct event_date from trades))"""


def _with(*parts):
    return "with " + ",".join(parts[:-1]) + parts[-1]


def _index_sql(column):
    return _with(
        TRADES,
        INDEX.format(column),
        f" select id, {column}, {column}_index from trades join {column}_codes using ({column})",
    )


_COMPLETENESS = f""" select symbol, {_DAY.format("event_date")} as event_date, count(id) as n_rows
from expected left join trades using (symbol, event_date) {{}} group by all"""

SQL = {
    "time_parts": _with(
        TRADES,
        """ select id, cast(hour(ts) as int) as hour, cast(minute(ts) as int) as minute,
        cast(second(ts) as int) as second, cast(dayofweek(ts) + 1 as int) as day_of_week,
        cast(floor(epoch(ts)) as bigint) as timestamp_epoch from trades""",
    ),
    "epoch_roundtrip": f"""select event_id as id, cast(floor(epoch(ts)) as bigint) as timestamp_epoch,
        {_TS.format("date_trunc('second', ts)")} as timestamp_parsed from events""",
    "parse_timestamps": f"""select event_id as id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
        as t, {_TS.format("ts")} as parsed from events""",
    "condition_flags": _with(
        TRADES,
        """ select id, cast(list_contains(conditions, '@') as int) as condition_at,
        cast(list_contains(conditions, 'I') as int) as condition_i,
        cast(list_contains(conditions, 'T') as int) as condition_t from trades""",
    ),
    "index_exchange": _index_sql("exchange"),
    "index_tape": _index_sql("tape"),
    "index_exchange_by_day": _with(
        TRADES,
        """
codes as (
  select symbol, event_date, exchange,
         cast(row_number() over (partition by symbol, event_date order by count(*) desc, exchange)
           - 1 as double) as exchange_index
  from trades group by 1, 2, 3)""",
        """ select id, exchange, exchange_index
        from trades join codes using (symbol, event_date, exchange)""",
    ),
    "rolling_features": _with(
        TRADES,
        ROLLED,
        """ select id, round(rolling_avg_price, 6) as rolling_avg_price,
        round(rolling_std_price, 6) as rolling_std_price, cumulative_volume from rolled""",
    ),
    "trade_features": _with(TRADES, FEATURES, " " + _ROUNDED),
    "bars_1m": _with(TRADES, bars_cte("1 minute"), _bar_select()),
    "bars_1h": _with(TRADES, bars_cte("1 hour"), _bar_select()),
    "bars_from_features": _with(
        TRADES,
        bars_cte("1 hour", order="(date_trunc('second', ts), price)"),
        _bar_select(),
    ),
    "bars_one_symbol_day": _with(
        TRADES,
        bars_cte("1 minute"),
        _bar_select(where="where symbol = 'S1' and event_date = date '2024-01-10'"),
    ),
    "reco_flatten": _with(RECOS, f" select {_RECO_COLUMNS} from recos where symbol = 'S2'"),
    "reco_periods": _with(
        RECOS, f" select distinct {_DAY.format('event_date')} as event_date from recos"
    ),
    "latest_if_current": _with(
        RECOS,
        f""" select {_RECO_COLUMNS} from
        (select *, max(event_date) over (partition by symbol) as newest from recos)
        where event_date = newest and event_date <= date '2024-12-31'""",
    ),
    "latest_as_of": _with(
        RECOS,
        f""" select {_RECO_COLUMNS} from recos where event_date <= date '2024-01-20'
        qualify row_number() over (partition by symbol order by recos.event_date desc) = 1""",
    ),
    "enrich_day": _with(
        TRADES,
        RECOS,
        bars_cte("1 minute"),
        """
latest as (
  select * from recos where event_date <= date '2024-01-10'
  qualify row_number() over (partition by symbol order by event_date desc) = 1)""",
        _enriched("bars b left join latest r using (symbol)")
        + " where b.event_date = date '2024-01-10'",
    ),
    "enrich_asof": _with(TRADES, RECOS, bars_cte("1 hour"), _enriched(ASOF)),
    "enrich_market": _with(TRADES, RECOS, bars_cte("1 minute"), _enriched(ASOF)),
    "enrich_universe": _with(
        TRADES,
        RECOS,
        bars_cte("5 minutes"),
        _enriched(ASOF, bar_start=False) + " where b.symbol in ('S0', 'S3', 'S5')",
    ),
    "trade_messages": _with(
        TRADES,
        f""" select symbol, price, size, exchange, {_CONDITIONS}, tape, id,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as timestamp,
        {_DAY.format("event_date")} as event_date from trades""",
    ),
    "trade_records": _with(
        TRADES,
        f""" select symbol as key, price, size, exchange, {_CONDITIONS}, tape, id,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as timestamp,
        {_DAY.format("event_date")} as event_date from trades""",
    ),
    "reco_messages": _with(
        RECOS,
        f""" select symbol, {_DAY.format("event_date")} as event_date, 'RECO' as type,
        {_DAY.format("event_date")} as period, buy, hold, sell, "strongBuy", "strongSell"
        from recos""",
    ),
    "news_messages": _with(
        MESSAGES,
        """ select m.symbol, strftime(ts, '%Y-%m-%d') as event_date, type, id
        from messages m join events on id = event_id where type = 'NEWS'""",
    ),
    "valid_messages": _with(
        MESSAGES, f" select id, symbol, event_date, type from messages where {_FILLED}"
    ),
    "rejected_messages": _with(
        MESSAGES,
        f""" select id, symbol, event_date, type, 'missing key' as reason from messages
        where not ({_FILLED})""",
    ),
    "reco_only": _with(
        MESSAGES,
        f""" select id, symbol, event_date, type from messages
        where type = 'RECO' and {_FILLED}""",
    ),
    "routed_messages": _with(
        MESSAGES, _ROUTED, " select id, symbol, event_date, type, feed, reason from routed"
    ),
    "message_counts": _with(
        MESSAGES,
        f""" select type, case when coalesce(type, '') <> 'RECO' then 'wrong type'
        when not ({_FILLED}) then 'missing key' else 'accepted' end as status,
        count(*) as n_messages from messages group by all""",
    ),
    "session_trades": _with(
        TRADES,
        f""" select {_TRADE_COLUMNS} from trades
        where ts between timestamp '2024-01-10 13:30:00' and timestamp '2024-01-10 20:00:00'""",
    ),
    "universe_trades": _with(
        TRADES, f" select {_TRADE_COLUMNS} from trades where symbol in ('S0', 'S2', 'S4')"
    ),
    "news_one_day": _with(
        MESSAGES,
        """ select symbol, id from messages
        where type = 'NEWS' and event_date = '2024-01-10'""",
    ),
    "prev_market_day": _CALENDAR.format(
        "case isodow(day) when 7 then day - 2 when 1 then day - 3 else day - 1 end",
        "previous_market_day",
    ),
    "month_start": _CALENDAR.format("date_trunc('month', day)", "month_start"),
    "prev_day": _CALENDAR.format("day - 1", "previous_day"),
    "chunks": _with(
        TRADES,
        _CHUNKED,
        f""" select symbol, {_DAY.format("event_date")} as event_date, chunk,
        count(*) as n_messages, min(id) as first_order, max(id) as last_order
        from numbered group by all""",
    ),
    "chunk_messages": _with(
        TRADES,
        _CHUNKED,
        f""" select n.symbol, {_DAY.format("n.event_date")} as event_date, chunk,
        '[' || string_agg('{{"symbol":"' || n.symbol || '","event_date":"' ||
        {_DAY.format("n.event_date")} || '","id":' || id || ',"price":' || price || ',"size":' ||
        size || ',"timestamp_parsed":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","tape":' ||
        case tape when 'B' then 'null' else '"' || tape || '"' end || '}}', ',' order by id) || ']'
        as messages from numbered n join trades using (id) group by all""",
    ),
    "latest_per_key": _with(
        TRADES,
        f""" select {_TRADE_COLUMNS} from trades
        qualify row_number() over (partition by symbol order by ts desc, id desc) = 1""",
    ),
    "completeness": _with(TRADES, _EXPECTED, _COMPLETENESS.format("")),
    "completeness_one_day": _with(
        TRADES, _EXPECTED, _COMPLETENESS.format("where event_date = date '2024-01-10'")
    ),
    # Two goes of one file per partition: none of these is larger than a file may be.
    "completeness_files": _with(
        TRADES,
        _EXPECTED,
        f"""select c.*, coalesce(f.n_files, 0) as n_files from ({_COMPLETENESS.format('')}) c
        left join (select symbol, {_DAY.format("event_date")} as event_date,
        count(distinct id % 2) as n_files from trades group by all) f using (symbol, event_date)""",
    ),
    "missing_symbols": _with(
        TRADES,
        _EXPECTED,
        f""" select symbol, {_DAY.format("event_date")} as event_date
        from expected anti join trades using (symbol, event_date)""",
    ),
    "profile": _with(
        TRADES,
        " "
        + " union all ".join(
            f"select '{name}' as column_name, '{kind}' as data_type, "
            f"count({source}) as non_null_count from trades"
            for name, kind, source in [
                ("symbol", "string", "symbol"),
                ("event_date", "date", "event_date"),
                ("price", "double", "price"),
                ("size", "double", "size"),
                ("exchange", "string", "exchange"),
                ("conditions", "array<string>", "conditions"),
                ("tape", "string", "tape"),
                ("id", "bigint", "id"),
                ("timestamp_parsed", "timestamp", "ts"),
            ]
        ),
    ),
    "value_counts": _with(
        TRADES,
        ROLLED,
        """ select round(rolling_avg_price, 6) as rolling_avg_price, count(*) as n from rolled
        where rolling_avg_price is not null group by 1""",
    ),
    "preview": _with(TRADES, f" select {_TRADE_COLUMNS} from trades order by id limit 10"),
    "documents_typed": _with(
        TRADES,
        FEATURES,
        """ select * replace (round(rolling_avg_price, 6) as rolling_avg_price,
        round(rolling_std_price, 6) as rolling_std_price,
        cast(exchange_index as bigint) as exchange_index,
        cast(tape_index as bigint) as tape_index, cast(condition_at as bigint) as condition_at,
        cast(condition_i as bigint) as condition_i, cast(condition_t as bigint) as condition_t,
        cast(hour as bigint) as hour, cast(minute as bigint) as minute,
        cast(second as bigint) as second, cast(day_of_week as bigint) as day_of_week),
        strftime(make_timestamp(timestamp_epoch * 1000000), '%Y-%m-%d %H:%M:%S.%f') as timestamp
        from features""",
    ),
    "export_roundtrip": _with(TRADES, f" select {_TRADE_COLUMNS}, {_CONDITIONS} from trades"),
    "json_arrays_roundtrip": _with(TRADES, f" select {_TRADE_COLUMNS}, {_CONDITIONS} from trades"),
    "overwrite_keeps_partitions": _with(RECOS, f" select {_RECO_COLUMNS} from recos"),
    "landing_stream": _with(
        MESSAGES,
        _ROUTED,
        """ select id, symbol, event_date,
        case when reason is null then feed else 'rejected' end as feed, reason from routed""",
    ),
}
SQL |= {
    "rolling_features_split": SQL["rolling_features"],
    "trade_features_split": SQL["trade_features"],
    "chunks_split": SQL["chunks"],
    "export_keeps_symbols": SQL["overwrite_keeps_partitions"],
    "landed_one_day": _with(
        MESSAGES,
        _ROUTED,
        """ select symbol, event_date, count(*) as n from routed where reason is null
        and feed = 'news' and symbol = 'S1' and event_date = '2024-01-10' group by all""",
    ),
    "latest_if_current_cut": _with(
        RECOS,
        f""" select {_RECO_COLUMNS} from
        (select *, max(event_date) over (partition by symbol) as newest from recos
        where (symbol in ('S1', 'S3')) = (event_date <= date '2024-01-15'))
        where event_date = newest and event_date <= date '2024-01-20'""",
    ),
}
_FAULTS = """
faults as (
  select symbol, id, case id % 20 when 1 then 'malformed' when 2 then 'bad date'
         when 3 then 'bad date' when 4 then 'malformed' when 5 then 'bad field'
         when 6 then 'missing key' end as reason
  from trades)"""
SQL |= {
    "chunks_streamed": _with(
        TRADES,
        """
numbered as (
  select *, (row_number() over (partition by symbol, event_date order by id) - 1) // 25 as chunk
  from trades)""",
        f""" select symbol, {_DAY.format("event_date")} as event_date, cast(chunk as bigint) as chunk,
        count(*) as n_messages, '[' || string_agg('{{"symbol":"' || symbol || '","event_date":"' ||
        {_DAY.format("event_date")} || '","id":' || id || ',"price":' || price || ',"size":' || size
        || ',"timestamp_parsed":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}}', ','
        order by id) || ']' as messages from numbered group by all""",
    ),
    "latest_by_position": _with(
        MESSAGES,
        """ select symbol, event_date, id, 'mixed' as topic, cast(id % 3 as int) as partition,
        4000000000 - id as "offset" from messages
        where type = 'NEWS' and coalesce(symbol, '') <> '' and coalesce(event_date, '') <> ''
        qualify row_number() over (partition by symbol order by id) = 1""",
    ),
    "rejected_malformed": _with(
        TRADES, _FAULTS, " select id, reason from faults where reason is not null"
    ),
    "redriven": _with(
        TRADES,
        _FAULTS,
        """ select id, case when id % 20 <> 1 and id % 20 <> 4 then symbol end as symbol,
        case when id % 20 in (3, 6) then 'trades' else 'rejected' end as feed,
        case when id % 20 not in (3, 6) then reason end as reason
        from faults where reason <> 'bad field'""",
    ),
    "message_totals": _with(
        MESSAGES,
        _ROUTED,
        """ select feed, coalesce(reason, 'accepted') as status, count(*) as n_messages
        from routed group by all""",
    ),
}
_LATE = """
intime as (
  select trades.* from trades, (
    select max(ts) filter (id % 97 <> 5) - interval 1 day as watermark from trades)
  where id % 97 <> 5 or ts >= watermark)"""
SQL["bars_streamed"] = _with(TRADES, _LATE, bars_cte("1 hour", "intime"), _bar_select())
SQL |= {
    "index_exchange_merged": SQL["index_exchange"],
    "rolling_incremental": SQL["rolling_features"],
    "parquet_file": _with(RECOS, f" select {_RECO_COLUMNS} from recos"),
    "landing_restarted": SQL["landing_stream"],
}
