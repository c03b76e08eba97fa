"""DuckDB SQL for the registered queries, written from their definitions.

Classes come from tables of bounds, moving means from joins of numbered rows, both sides of a
comparison from one grouped union; the Spark plans take other ways.
"""

from __future__ import annotations


def _rounded(x: str, digits: int) -> str:
    return f"round({x} + sign({x}) * 1e-9, {digits})"


def _tidy(select: str, *doubles: str) -> str:
    """Means lose their last bits, which depend on the order of summation."""
    replaced = ", ".join(f"{_rounded(d, 6)} AS {d}" for d in doubles)
    return f"SELECT * REPLACE ({replaced}) FROM ({select}) tidied"


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _iso(ts: str) -> str:
    return (
        f"CASE WHEN date_part('microsecond', {ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f+00:00') END"
    )


TRADES = """trades AS (
  SELECT event_type AS symbol, value AS price, (k * k * k * k * k * k) // 1000000 AS volume,
         ts AS event_time, CAST(user_id % 4 AS VARCHAR) AS exchange,
         ts + INTERVAL 1 MINUTE AS loaded_at, event_id AS seq
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""

_WINDOWS = {"ohlcv_1min": ("1 MINUTE", "1 minute"), "ohlcv_5min": ("5 MINUTES", "5 minutes"), "ohlcv_1hr": ("1 HOUR", "1 hour")}

CORRECTED = """corrected AS (
  SELECT * FROM trades
  UNION ALL
  SELECT symbol, price + 1, volume, event_time, exchange, loaded_at + INTERVAL 1 MINUTE, seq
  FROM trades WHERE exchange = '0'
)"""

LOSSY = """lossy AS (
  SELECT * FROM trades
  WHERE symbol <> 'error' AND price >= CASE WHEN symbol = 'view' THEN 5 ELSE 1 END
)"""


_TIED = "tied AS (SELECT * REPLACE (date_trunc('hour', event_time) AS event_time) FROM trades)"


def _bars(name: str, source: str, width: str, label: str, order: str = "event_time") -> str:
    return f"""{name} AS (
  SELECT symbol, arg_min(price, {order}) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, {order}) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trade_count,
         avg(price) AS vwap, sum(price * volume) / nullif(sum(volume), 0) AS vwap_weighted,
         window_start, window_start + INTERVAL {width} AS window_end, '{label}' AS window_duration
  FROM (SELECT *, time_bucket(INTERVAL {width}, event_time) AS window_start FROM {source})
  GROUP BY symbol, window_start
)"""


MINUTE_BARS = _bars("bars", "trades", "1 MINUTE", "1 minute")


def _staged(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT symbol, window_start, window_end, open, high, low, close, volume, trade_count, vwap,
         CAST(window_start AS DATE) AS trade_date, CAST(extract(hour FROM window_start) AS INTEGER) AS trade_hour,
         {_rounded("(close - open) / nullif(open, 0) * 100", 4)} AS bar_return_pct, high - low AS price_range
  FROM {source}
)"""


STAGED = _staged("staged", "bars")


def _scored(source: str = "trades") -> str:
    return f"""rolled AS (
  SELECT *, count(*) OVER w AS n, avg(price) OVER w AS pm, stddev_samp(price) OVER w AS ps,
         avg(volume) OVER w AS vm, stddev_samp(volume) OVER w AS vs
  FROM {source}
  WINDOW w AS (PARTITION BY symbol ORDER BY event_time, seq ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING)
), guarded AS (
  SELECT *, CASE WHEN n > 1 THEN pm ELSE 0 END AS price_mean, CASE WHEN n > 2 THEN ps ELSE 0 END AS price_std,
         CASE WHEN n > 1 THEN vm ELSE 0 END AS volume_mean, CASE WHEN n > 2 THEN vs ELSE 0 END AS volume_std
  FROM rolled
), scored AS (
  SELECT symbol, price, volume, event_time, seq, price_mean, price_std, volume_mean, volume_std,
         CASE WHEN price_std <= 1e-12 * abs(price_mean) THEN 0 ELSE (price - price_mean) / price_std END AS price_zscore,
         CASE WHEN volume_std <= 1e-12 * abs(volume_mean) THEN 0 ELSE (volume - volume_mean) / volume_std END AS volume_zscore
  FROM guarded
)"""


def _found(threshold: float = 3.0) -> str:
    return f"""found AS (
  SELECT seq, symbol, price, volume, {_iso("event_time")} AS "timestamp",
         {_rounded("price_zscore", 4)} AS price_zscore, {_rounded("volume_zscore", 4)} AS volume_zscore,
         {_rounded("price_mean", 4)} AS price_mean, {_rounded("price_std", 4)} AS price_std,
         {_rounded("volume_mean", 2)} AS volume_mean, {_rounded("volume_std", 2)} AS volume_std,
         CASE WHEN greatest(abs(price_zscore), abs(volume_zscore)) >= 4 THEN 'EXTREME'
              WHEN greatest(abs(price_zscore), abs(volume_zscore)) >= 3 THEN 'CRITICAL'
              WHEN greatest(abs(price_zscore), abs(volume_zscore)) >= 2 THEN 'WARNING'
              ELSE 'NORMAL' END AS severity,
         CASE WHEN abs(price_zscore) >= {threshold} AND abs(volume_zscore) >= {threshold} THEN 'PRICE_AND_VOLUME'
              WHEN abs(price_zscore) >= {threshold} THEN 'PRICE' ELSE 'VOLUME' END AS anomaly_type,
         {_iso("(event_time + INTERVAL 2 SECONDS)")} AS detected_at
  FROM scored WHERE abs(price_zscore) >= {threshold} OR abs(volume_zscore) >= {threshold}
)"""


ANOMALIES = [TRADES, _scored(), _found()]
STAGED_FOUND = """staged_found AS (
  SELECT symbol, price, volume, "timestamp" AS event_timestamp, price_zscore, volume_zscore, price_mean, price_std,
         volume_mean, volume_std, severity, anomaly_type, detected_at, CAST(left("timestamp", 10) AS DATE) AS anomaly_date
  FROM found
)"""

SUMMARY = f"""counted AS (
  SELECT symbol, anomaly_date, histogram(severity) AS by_severity, histogram(anomaly_type) AS by_type,
         list(abs(price_zscore)) AS price_scores, list(abs(volume_zscore)) AS volume_scores
  FROM staged_found GROUP BY ALL
), summary AS (
  SELECT symbol, anomaly_date, CAST(len(price_scores) AS BIGINT) AS anomaly_count,
         {", ".join(f"CAST(coalesce(by_severity['{name}'], 0) AS BIGINT) AS {name.lower()}_count" for name in ("EXTREME", "CRITICAL", "WARNING"))},
         {", ".join(f"CAST(coalesce(by_type['{kind}'], 0) AS BIGINT) AS {name}_anomalies" for kind, name in (("PRICE", "price"), ("VOLUME", "volume"), ("PRICE_AND_VOLUME", "combined")))},
         {_rounded("list_avg(price_scores)", 2)} AS avg_price_zscore,
         {_rounded("list_max(price_scores)", 2)} AS max_price_zscore,
         {_rounded("list_avg(volume_scores)", 2)} AS avg_volume_zscore
  FROM counted
)"""


def _daily_stats(source: str) -> str:
    return f"""last_hours AS (
  SELECT symbol, trade_date, max(trade_hour) AS trade_hour FROM {source} GROUP BY ALL
), closing AS (
  SELECT symbol, trade_date, max(close) AS day_close FROM {source} JOIN last_hours USING (symbol, trade_date, trade_hour) GROUP BY ALL
), spans AS (
  SELECT symbol, trade_date, min(open) AS day_open, max(high) AS day_high, min(low) AS day_low,
         CAST(sum(volume) AS BIGINT) AS day_volume, CAST(sum(trade_count) AS BIGINT) AS day_trade_count,
         avg(vwap) AS day_vwap, stddev_samp(close) AS intraday_volatility, count(*) AS bar_count,
         avg(bar_return_pct) AS avg_bar_return, arg_min(open, window_start) AS day_open_first,
         arg_max(close, window_start) AS day_close_last
  FROM {source} GROUP BY ALL
), daily_stats AS (
  SELECT *, day_high - day_low AS day_range,
         {_rounded("(day_close - day_open) / nullif(day_open, 0) * 100", 4)} AS daily_return_pct,
         {_rounded("(day_high - day_low) / nullif(day_open, 0) * 100", 4)} AS range_pct
  FROM spans JOIN closing USING (symbol, trade_date)
)"""


# the class of a value is that of the largest bound below it
MARKET = """trends(above, trend_direction) AS (
  VALUES (2.0::DOUBLE, 'strong_up'), (0.0, 'up'), (-2.0, 'down'), ('-infinity'::DOUBLE, 'strong_down')
), regimes(above, volatility_regime) AS (
  VALUES (0.02::DOUBLE, 'high'), (0.01, 'medium')
), market AS (
  SELECT symbol, trade_date, day_open, day_high, day_low, day_close, day_volume, day_trade_count, day_vwap,
         daily_return_pct, intraday_volatility, range_pct, bar_count,
         coalesce(anomaly_count, 0) AS anomaly_count, coalesce(extreme_count, 0) AS extreme_anomalies,
         coalesce(critical_count, 0) AS critical_anomalies, coalesce(max_price_zscore, 0) AS max_zscore,
         coalesce((SELECT arg_max(t.trend_direction, t.above) FROM trends t WHERE daily_return_pct > t.above), 'strong_down') AS trend_direction,
         coalesce((SELECT arg_max(r.volatility_regime, r.above) FROM regimes r WHERE intraday_volatility > day_vwap * r.above), 'low')
           AS volatility_regime
  FROM daily_stats LEFT JOIN (SELECT * RENAME (anomaly_date AS trade_date) FROM summary) USING (symbol, trade_date)
)"""

_RAISED = "raised AS (SELECT * REPLACE (price + 3000 AS price) FROM trades)"
DAILY_MARKET = [
    *ANOMALIES, STAGED_FOUND, SUMMARY, _RAISED, _bars("bars", "raised", "1 HOUR", "1 hour"), STAGED,
    _daily_stats("staged"), MARKET,
]


def _signals(source: str = "staged") -> str:
    """Moving means from lists of the closes and volumes of a symbol, cut at each bar's number."""
    tail = lambda values, n: f"list_avg({values}[greatest(1, place - {n - 1}):place])"
    return f"""series AS (
  SELECT symbol, list(struct_pack(bar := b, place := place) ORDER BY place) AS bars, list(b.close ORDER BY place) AS closes,
         list(b.volume ORDER BY place) AS volumes
  FROM (SELECT symbol, b, rank() OVER (PARTITION BY symbol ORDER BY window_start) AS place FROM {source} AS b)
  GROUP BY symbol
), placed AS (
  SELECT unnest(bars, recursive := true), closes, volumes FROM series
), averaged AS (
  SELECT *, {tail("closes", 20)} AS s20, {tail("closes", 50)} AS s50, {tail("volumes", 10)} AS v10, closes[place - 1] AS prev_close,
         place - min(place) OVER (PARTITION BY symbol, trade_date) + 1 AS bar_sequence
  FROM placed
), realtime AS (
  SELECT symbol, trade_date, trade_hour, window_start, window_end, open, high, low, close, volume, trade_count, vwap,
         bar_return_pct, price_range, {_rounded("s20", 4)} AS sma_20, {_rounded("s50", 4)} AS sma_50,
         {_rounded("v10", 0)} AS volume_sma_10, prev_close,
         ['bearish', 'neutral', 'bullish'][CAST((sign(close - s20) + sign(s20 - s50)) / 2 AS INTEGER) + 2] AS trend_signal,
         ['normal', 'elevated', 'high'][1 + CAST(volume > v10 * 1.5 AS INTEGER) + CAST(volume > v10 * 2 AS INTEGER)] AS volume_signal,
         CAST(bar_sequence AS INTEGER) AS bar_sequence
  FROM averaged
)"""


def _staged_trades(source: str) -> str:
    return f"""sessions(first_hour, last_hour, trading_session) AS (
  VALUES (9, 10, 'market_open'), (11, 14, 'midday'), (15, 16, 'market_close')
), newest AS (
  SELECT symbol, event_time AS trade_timestamp, max(loaded_at) AS loaded_at FROM {source} GROUP BY ALL
), latest AS (
  SELECT symbol, price, volume, trade_timestamp, exchange, CAST(trade_timestamp AS DATE) AS trade_date,
         CAST(hour(trade_timestamp) AS INTEGER) AS trade_hour, coalesce(trading_session, 'extended_hours') AS trading_session, loaded_at
  FROM newest JOIN (SELECT * RENAME (event_time AS trade_timestamp) FROM {source}) USING (symbol, trade_timestamp, loaded_at)
  LEFT JOIN sessions ON hour(trade_timestamp) BETWEEN first_hour AND last_hour
)"""


SYMBOLS = f"""per_day AS (
  SELECT symbol, trade_date, sum(volume) AS volume, sum(price) AS price, count(*) AS trades FROM latest GROUP BY ALL
), per_symbol AS (
  SELECT symbol, min(trade_date) AS first_seen, max(trade_date) AS last_seen, count(*) AS active_days,
         sum(volume) / sum(trades) AS mean_volume, sum(price) / sum(trades) AS mean_price, avg(volume) AS mean_day_volume
  FROM per_day GROUP BY symbol
), flagged AS (
  SELECT symbol, histogram(severity) AS by_severity, count(*) AS total_anomalies FROM staged_found GROUP BY symbol
), tiers(above, volume_tier) AS (
  VALUES (10000000, 'mega_cap'), (1000000, 'large_cap'), (100000, 'mid_cap'), (-1, 'small_cap')
), symbols AS (
  SELECT symbol, first_seen, last_seen, active_days, {_rounded("mean_volume", 0)} AS avg_daily_volume,
         {_rounded("mean_price", 2)} AS avg_price, coalesce(total_anomalies, 0) AS total_anomalies,
         CAST(coalesce(by_severity['EXTREME'], 0) AS BIGINT) AS extreme_anomaly_count,
         (SELECT arg_max(t.volume_tier, t.above) FROM tiers t WHERE mean_volume > t.above) AS volume_tier,
         {_rounded("mean_day_volume", 0)} AS true_avg_daily_volume
  FROM per_symbol LEFT JOIN flagged USING (symbol)
)"""

_ORDER = "(epoch_us(event_time)::HUGEINT * 1000000000000000000 + seq)"


def _day_summary(source: str = "trades") -> str:
    return f"""dated AS (SELECT *, event_time::DATE AS trade_date, {_ORDER} AS place FROM {source}
), edges AS (
  SELECT symbol, trade_date, arg_min(price, place) AS open_price, arg_max(price, place) AS close_price FROM dated GROUP BY ALL
), figures AS (
  SELECT symbol, trade_date, max(price) AS high_price, min(price) AS low_price, CAST(sum(volume) AS BIGINT) AS total_volume,
         count(*) AS trade_count, {_rounded("avg(price)", 4)} AS avg_price, {_rounded("stddev_samp(price)", 4)} AS price_stddev,
         min(event_time) AS market_open_time, max(event_time) AS market_close_time
  FROM dated GROUP BY ALL
), day_summary AS (
  SELECT *, {_rounded("(close_price / nullif(open_price, 0) - 1) * 100", 4)} AS daily_return_pct
  FROM edges JOIN figures USING (symbol, trade_date)
)"""


def _side(name: str, source: str, at: str, until: str, mean: str, low: str, high: str, n: str, ends: tuple[str, str]) -> str:
    """One row per symbol and day: the shape both sides of the comparison share."""
    return f"""{name} AS (
  SELECT symbol, {at}::DATE AS trade_date, CAST(sum({n}) AS BIGINT) AS trade_count, {_rounded(f"avg({mean})", 4)} AS avg_price,
         min({low}) AS min_price, max({high}) AS max_price, CAST(sum(volume) AS BIGINT) AS total_volume,
         min({at}) AS {ends[0]}, max({until}) AS {ends[1]}
  FROM {source} GROUP BY ALL
)"""


def _batch_side(source: str) -> str:
    return _side("batch", source, "event_time", "event_time", "price", "price", "price", "1", ("first_trade", "last_trade"))


STREAM_SIDE = _side("stream", "bars", "window_start", "window_end", "close", "low", "high", "trade_count", ("first_window", "last_window"))


def _mismatch(issue: str, measure: str, severity: str) -> str:
    diff = f"(abs(b_{measure} - s_{measure}) / greatest(b_{measure}, 1))"
    return f"""SELECT symbol, trade_date, '{issue}' AS issue, {severity.format(diff=diff)} AS severity,
         CAST(b_{measure} AS DOUBLE) AS batch_value, CAST(s_{measure} AS DOUBLE) AS stream_value,
         {_rounded(f"({diff} * 100)", 2)} AS diff_pct
  FROM both_sides WHERE in_batch AND in_stream AND {diff} > 0.01"""


ISSUES = f"""both_sides AS (
  SELECT symbol, trade_date, bool_or(side = 'b') AS in_batch, bool_or(side = 's') AS in_stream,
         {", ".join(f"max({m}) FILTER (side = '{x}') AS {x}_{short}" for m, short in (("trade_count", "count"), ("total_volume", "volume"), ("min_price", "min")) for x in "bs")}
  FROM (SELECT 'b' AS side, symbol, trade_date, trade_count, total_volume, min_price FROM batch
        UNION ALL SELECT 's', symbol, trade_date, trade_count, total_volume, min_price FROM stream)
  GROUP BY symbol, trade_date
), issues AS (
  SELECT symbol, trade_date, CASE WHEN in_batch THEN 'MISSING_FROM_STREAM' ELSE 'MISSING_FROM_BATCH' END AS issue,
         'HIGH' AS severity, CAST(NULL AS DOUBLE) AS batch_value, CAST(NULL AS DOUBLE) AS stream_value,
         CAST(NULL AS DOUBLE) AS diff_pct
  FROM both_sides WHERE NOT (in_batch AND in_stream)
  UNION ALL
  {_mismatch("TRADE_COUNT_MISMATCH", "count", "CASE WHEN {diff} > 0.05 THEN 'HIGH' ELSE 'MEDIUM' END")}
  UNION ALL
  {_mismatch("VOLUME_MISMATCH", "volume", "'MEDIUM'")}
  UNION ALL
  SELECT symbol, trade_date, 'MIN_PRICE_MISMATCH', 'LOW', b_min, s_min, NULL
  FROM both_sides WHERE in_batch AND in_stream AND b_min <> s_min
), reports AS (
  SELECT k.trade_date AS reconciliation_date, CASE WHEN count(i.issue) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
         count(DISTINCT k.symbol) AS symbols_checked, count(i.issue) AS discrepancy_count,
         count(*) FILTER (i.severity = 'HIGH') AS high_severity_count
  FROM both_sides k LEFT JOIN issues i ON i.symbol = k.symbol AND i.trade_date = k.trade_date
  GROUP BY k.trade_date
)"""

RECONCILED = [
    TRADES, LOSSY, _bars("bars", "lossy", "1 MINUTE", "1 minute"),
    "kept AS (SELECT * FROM trades WHERE symbol <> 'signup')", _batch_side("kept"), STREAM_SIDE, ISSUES,
]

_BAR_DOUBLES = ("vwap", "vwap_weighted")
_DAILY_DOUBLES = ("day_vwap", "intraday_volatility", "day_range", "avg_bar_return")
_MARKET_DOUBLES = ("day_open", "day_high", "day_low", "day_close", "day_vwap", "intraday_volatility")
_FACT_DOUBLES = ("vwap", "price_range")


def _bar_query(width: str, label: str) -> str:
    return _with([TRADES, _bars("bars", "trades", width, label)], _tidy("SELECT * FROM bars", *_BAR_DOUBLES))


def _check(table: str, column: str, check: str, failures: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, "
        f"CAST(({failures}) AS BIGINT) AS failures"
    )


def _checks(rows: list[str]) -> str:
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ("
        + "\nUNION ALL\n".join(rows)
        + ")"
    )


def _nulls(source: str, column: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {column} IS NULL"


def _outside(source: str, column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"SELECT count(*) FROM {source} WHERE {column} NOT IN ({listed})"


def _repeats(source: str, column: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


def _mart_checks() -> str:
    hourly = _bars("hourly", "raised", "1 HOUR", "1 hour")
    ctes = [
        *ANOMALIES, STAGED_FOUND, SUMMARY, _RAISED, hourly, _staged("hour_staged", "hourly"),
        _daily_stats("hour_staged"), MARKET, MINUTE_BARS, STAGED, _signals(), _staged_trades("trades"), SYMBOLS,
    ]
    rows = [
        *[_check("fct_daily_market", c, "not_null", _nulls("market", c)) for c in ("symbol", "trade_date", "day_open", "day_close")],
        _check("fct_daily_market", "trend_direction", "accepted_values",
               _outside("market", "trend_direction", ["strong_up", "up", "down", "strong_down"])),
        *[_check("fct_realtime_ohlcv", c, "not_null", _nulls("realtime", c)) for c in ("symbol", "window_start")],
        _check("fct_realtime_ohlcv", "trend_signal", "accepted_values",
               _outside("realtime", "trend_signal", ["bullish", "bearish", "neutral"])),
        _check("dim_symbols", "symbol", "not_null", _nulls("symbols", "symbol")),
        _check("dim_symbols", "symbol", "unique", _repeats("symbols", "symbol")),
    ]
    return _with(ctes, _checks(rows))


def _failing_checks() -> str:
    dear = "dear AS (SELECT * REPLACE (CASE WHEN price >= 10 THEN price END AS price) FROM trades)"
    rows = [
        _check("trades", "symbol", "not_null", _nulls("dear", "symbol")),
        _check("trades", "price", "not_null", _nulls("dear", "price")),
        _check("trades", "symbol", "accepted_values", _outside("dear", "symbol", ["view", "click", "purchase", "signup"])),
        _check("trades", "symbol", "unique", _repeats("dear", "symbol")),
        _check("trades", "seq", "unique", _repeats("dear", "seq")),
    ]
    return _with([TRADES, dear], _checks(rows))


def _two_loads(last_day_condition: str) -> str:
    """Daily market over minute bars of which the half-loaded day may keep only its first half."""
    kept = f"kept AS (SELECT * FROM staged WHERE {last_day_condition})"
    ctes = [*ANOMALIES, STAGED_FOUND, SUMMARY, MINUTE_BARS, STAGED, kept, _daily_stats("kept"), MARKET]
    return _with(ctes, _tidy("SELECT * FROM market", *_MARKET_DOUBLES))


def _text(number: str, digits: int, grouped: bool = False) -> str:
    return f"format('{{:{',' if grouped else ''}.{digits}f}}', {number})"


def _alerts() -> str:
    direction = "CASE WHEN price_zscore > 0 THEN 'UP' ELSE 'DOWN' END"
    texts = f"""texts AS (
  SELECT seq, symbol, severity, CASE severity WHEN 'EXTREME' THEN '#FF0000' ELSE '#FF6600' END AS color,
         CASE severity WHEN 'EXTREME' THEN ':rotating_light:' ELSE ':warning:' END || ' ' || severity || ' Anomaly: ' || symbol AS header,
         '*Price:* $' || {_text("price", 2)} || ' (' || {direction} || ')' AS price_text,
         '*Volume:* ' || format('{{:,}}', volume) AS volume_text,
         '*Price Z-Score:* ' || {_text("price_zscore", 2)} AS price_z_text,
         '*Volume Z-Score:* ' || {_text("volume_zscore", 2)} AS volume_z_text,
         '*Type:* ' || anomaly_type AS type_text, '*Detected:* ' || left(detected_at, 19) AS detected_text,
         'Price mean: $' || {_text("price_mean", 2)} || ' (σ=' || {_text("price_std", 2)} || ') | Volume mean: '
           || {_text("volume_mean", 0, True)} || ' (σ=' || {_text("volume_std", 0, True)} || ')' AS context_text
  FROM found WHERE severity IN ('CRITICAL', 'EXTREME')
)"""
    field = lambda name: f"""'{{"type":"mrkdwn","text":"' || {name} || '"}}'"""
    fields = " || ',' || ".join(
        field(f) for f in ("price_text", "volume_text", "price_z_text", "volume_z_text", "type_text", "detected_text")
    )
    payload = (
        """'{"attachments":[{"color":"' || color || '","blocks":['"""
        """ || '{"type":"header","text":{"type":"plain_text","text":"' || header || '"}},'"""
        f""" || '{{"type":"section","fields":[' || {fields} || ']}},'"""
        f""" || '{{"type":"context","elements":[' || {field("context_text")} || ']}}' || ']}}]}}'"""
    )
    return _with([*ANOMALIES, texts], f"SELECT *, {payload} AS payload FROM texts")


def _intraday(select: str) -> str:
    return _with([TRADES, MINUTE_BARS], select)


def all_oracles() -> dict[str, str]:
    stream_bars = _with(
        [TRADES, _bars("bars", "trades", "1 HOUR", "1 hour")],
        _tidy(
            "SELECT *, CAST(window_start AS DATE) AS trade_date FROM bars "
            "WHERE window_end <= (SELECT max(event_time) - INTERVAL 30 SECONDS FROM trades)",
            *_BAR_DOUBLES,
        ),
    )
    realtime = _with([TRADES, MINUTE_BARS, STAGED, _signals()], _tidy("SELECT * FROM realtime", *_FACT_DOUBLES))
    digits = {"price_mean": 4, "price_std": 4, "price_zscore": 4, "volume_mean": 2, "volume_std": 2, "volume_zscore": 4}
    scored_columns = ", ".join(f"{_rounded(name, n)} AS {name}" for name, n in digits.items())
    day = "WHERE symbol = 'view' AND window_start >= TIMESTAMP '2024-01-15' AND window_start < TIMESTAMP '2024-01-16'"
    return {
        "trades_decoded": _with(
            [TRADES],
            f"""SELECT symbol, price, volume, {_iso("event_time")} AS "timestamp", exchange, '[]' AS conditions,
                event_time FROM trades""",
        ),
        "trades_normalized_ticks": _with(
            [TRADES],
            f"""SELECT seq, symbol, price, volume, {_iso("ms")} AS "timestamp",
                CASE WHEN exchange <> '3' THEN exchange ELSE '' END AS exchange,
                CASE WHEN symbol <> 'click' THEN '[12,' || exchange || ']' ELSE '[]' END AS conditions, ms AS event_time
                FROM (SELECT *, make_timestamp(epoch_us(event_time) // 1000 * 1000) AS ms FROM trades)""",
        ),
        "trades_normalized_intraday": _intraday(
            f"""SELECT symbol, close AS price, open, high, low, volume, {_iso("window_start")} AS "timestamp",
                'alpha_vantage' AS exchange, '[]' AS conditions, window_start AS event_time
                FROM bars WHERE symbol NOT IN ('error', 'signup')"""
        ),
        "ingest_rejects": _with(
            [TRADES],
            """SELECT * FROM (SELECT seq, CASE WHEN price >= 100 THEN 'malformed' WHEN exchange = '2' THEN 'no_symbol'
               WHEN exchange = '1' THEN 'no_price' WHEN price < 10 THEN 'no_event_time' END AS reason FROM trades)
               WHERE reason IS NOT NULL""",
        ),
        "tick_rejects": _with(
            [TRADES],
            """SELECT seq, CAST(NULL AS INTEGER) AS event_index, CASE WHEN price >= 100 THEN 'malformed' WHEN price >= 2 THEN 'kept'
               ELSE 'empty' END AS reason FROM trades WHERE price >= 1
               UNION ALL SELECT seq, 0, 'time_out_of_range' FROM trades WHERE price < 1
               UNION ALL SELECT seq, 1, 'not_a_trade' FROM trades WHERE price < 1 OR price >= 2 AND price < 100""",
        ),
        "intraday_refused": _intraday(
            """SELECT DISTINCT symbol, CAST(window_start AS DATE) AS "day",
               CASE WHEN symbol = 'error' THEN 'api_error' WHEN symbol = 'signup' THEN 'rate_limited'
                    WHEN symbol = 'click' AND date_part('day', window_start) % 2 = 0 THEN 'malformed'
                    WHEN symbol = 'purchase' AND date_part('day', window_start) % 2 = 1 THEN 'no_series'
                    WHEN symbol = 'view' AND date_part('day', window_start) % 3 = 0 THEN 'empty_series' ELSE 'kept' END AS reason,
               CASE symbol WHEN 'error' THEN 'Invalid API call' WHEN 'signup' THEN '5 calls per minute' END AS message FROM bars"""
        ),
        "intraday_rejects": _intraday(
            """SELECT DISTINCT symbol, CAST(window_start AS DATE) AS "day",
               CASE symbol WHEN 'error' THEN 'api_error' ELSE 'rate_limited' END AS reason,
               CASE symbol WHEN 'error' THEN 'Invalid API call' ELSE '5 calls per minute' END AS message
               FROM bars WHERE symbol IN ('error', 'signup')"""
        ),
        "dedup_seen": _with([TRADES], "SELECT * FROM trades WHERE event_time >= TIMESTAMP '2024-01-15'"),
        "symbol_universe_semi": _with([TRADES], "SELECT * FROM trades WHERE symbol IN ('view', 'click', 'purchase')"),
        "ohlcv_1min": _bar_query("1 MINUTE", "1 minute"),
        "ohlcv_5min": _bar_query("5 MINUTES", "5 minutes"),
        "ohlcv_1hr": _bar_query("1 HOUR", "1 hour"),
        "ohlcv_tied_times": _with(
            [TRADES, _TIED, _bars("bars", "tied", "4 HOURS", "4 hours", _ORDER)], _tidy("SELECT * FROM bars", *_BAR_DOUBLES)
        ),
        "daily_summary_tied": _with([TRADES, _TIED, _day_summary("tied")], "SELECT * FROM day_summary"),
        "ohlcv_sliding_5min_1min": _with(
            [
                TRADES,
                """windowed AS (SELECT trades.*, time_bucket(INTERVAL 1 MINUTE, event_time) - to_minutes(CAST(i AS INTEGER))
                   AS window_start FROM trades, range(5) AS steps(i))""",
            ],
            _tidy(
                """SELECT symbol, arg_min(price, event_time) AS open, max(price) AS high, min(price) AS low,
                   arg_max(price, event_time) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trade_count,
                   avg(price) AS vwap, sum(price * volume) / nullif(sum(volume), 0) AS vwap_weighted, window_start,
                   window_start + INTERVAL 5 MINUTES AS window_end, '5 minutes' AS window_duration
                   FROM windowed GROUP BY symbol, window_start""",
                *_BAR_DOUBLES,
            ),
        ),
        "trades_scored": _with([TRADES, _scored()], f"SELECT * REPLACE ({scored_columns}) FROM scored"),
        "anomalies_zscore": _with(ANOMALIES, "SELECT * FROM found"),
        "anomalies_zscore_halo": _with(ANOMALIES, "SELECT * FROM found"),
        "anomalies_low_threshold": _with([TRADES, _scored(), _found(1.5)], "SELECT * FROM found"),
        "alert_payloads": _alerts(),
        "daily_summary": _with([TRADES, _day_summary()], "SELECT * FROM day_summary"),
        "daily_summary_day": _with(
            [TRADES, _day_summary()], "SELECT * FROM day_summary WHERE trade_date = DATE '2024-01-15'"
        ),
        "daily_run_state": _with(
            [TRADES, _day_summary()],
            "SELECT * FROM day_summary WHERE trade_date NOT IN (DATE '2024-01-15', DATE '2024-01-17')",
        ),
        "reconcile_batch_side": _with([TRADES, _batch_side("trades")], "SELECT * FROM batch"),
        "reconcile_batch_side_many_symbols": _with(
            [
                """shipments AS (SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_extendedprice / l_quantity AS price,
                   CAST(l_quantity AS BIGINT) AS volume, l_shipdate AS event_time FROM lineitem)""",
                _batch_side("shipments"),
            ],
            _tidy("SELECT * FROM batch", "min_price", "max_price"),
        ),
        "reconcile_stream_side": _with([TRADES, MINUTE_BARS, STREAM_SIDE], "SELECT * FROM stream"),
        "reconcile_discrepancies": _with(RECONCILED, "SELECT * FROM issues"),
        "reconcile_report": _with(RECONCILED, "SELECT * FROM reports"),
        "reconcile_summary": _with(RECONCILED, "SELECT * FROM reports"),
        "reconcile_details": _with(RECONCILED, "SELECT * RENAME (trade_date AS reconciliation_date) FROM issues"),
        "reconcile_alerts": _with(
            RECONCILED,
            """SELECT reconciliation_date, ':warning: *Stock Pipeline Reconciliation Failed*' || chr(10) || 'Date: '
               || CAST(reconciliation_date AS VARCHAR) || chr(10) || 'Discrepancies: ' || discrepancy_count || chr(10)
               || 'High Severity: ' || high_severity_count AS text FROM reports""",
        ),
        "stg_trades": _with([TRADES, CORRECTED, _staged_trades("corrected")], _tidy("SELECT * FROM latest", "price")),
        "stg_ohlcv_1min": _with([TRADES, MINUTE_BARS, STAGED], _tidy("SELECT * FROM staged", *_FACT_DOUBLES)),
        "stg_ohlcv_hourly": _with(
            [TRADES, _bars("bars", "trades", "1 HOUR", "1 hour"), STAGED], _tidy("SELECT * FROM staged", *_FACT_DOUBLES)
        ),
        "stg_anomalies": _with([*ANOMALIES, STAGED_FOUND], "SELECT * FROM staged_found"),
        "int_symbol_daily_stats": _with(
            [TRADES, MINUTE_BARS, STAGED, _daily_stats("staged")], _tidy("SELECT * FROM daily_stats", *_DAILY_DOUBLES)
        ),
        "int_anomaly_summary": _with([*ANOMALIES, STAGED_FOUND, SUMMARY], "SELECT * FROM summary"),
        "fct_realtime_ohlcv": realtime,
        "fct_daily_market": _with(DAILY_MARKET, _tidy("SELECT * FROM market", *_MARKET_DOUBLES)),
        "dim_symbols": _with([*ANOMALIES, STAGED_FOUND, _staged_trades("trades"), SYMBOLS], "SELECT * FROM symbols"),
        "dash_candles": _intraday(f"SELECT window_start AS time, open, high, low, close, volume FROM bars {day}"),
        "dash_volume": _intraday(f"SELECT window_start AS time, volume FROM bars {day}"),
        "dash_recent_anomalies": _with(
            ANOMALIES,
            """SELECT symbol, severity, anomaly_type, price, price_zscore, volume_zscore, detected_at FROM found
               WHERE left(detected_at, 10) = '2024-01-15' ORDER BY detected_at DESC LIMIT 50""",
        ),
        "dash_anomaly_counts": _with(
            ANOMALIES,
            """SELECT symbol, count(*) AS "count" FROM found WHERE left(detected_at, 10) = '2024-01-15'
               GROUP BY symbol ORDER BY 2 DESC, 1""",
        ),
        "dash_zscores_7d": _with(
            ANOMALIES, "SELECT price_zscore FROM found WHERE left(detected_at, 10) BETWEEN '2024-01-08' AND '2024-01-15'"
        ),
        "dash_returns_30d": _with(
            DAILY_MARKET,
            """SELECT trade_date AS time, symbol, daily_return_pct AS value FROM market
               WHERE trade_date BETWEEN DATE '2023-12-16' AND DATE '2024-01-15' ORDER BY trade_date, symbol""",
        ),
        "dash_symbols": _intraday(
            "SELECT DISTINCT symbol FROM bars WHERE CAST(window_start AS DATE) = DATE '2024-01-15' ORDER BY symbol"
        ),
        "dq_results": _mart_checks(),
        "dq_results_failing": _failing_checks(),
        "dq_freshness": _with(
            [TRADES],
            """SELECT 'trades_raw_stream' AS table_name, max(loaded_at) AS newest, TIMESTAMP '2024-01-31 00:10:00' AS as_of,
               CASE WHEN TIMESTAMP '2024-01-31 00:10:00' - max(loaded_at) > INTERVAL 30 MINUTES THEN 'error'
                    WHEN TIMESTAMP '2024-01-31 00:10:00' - max(loaded_at) > INTERVAL 5 MINUTES THEN 'warn'
                    ELSE 'pass' END AS status FROM trades""",
        ),
        "incremental_realtime": realtime,
        "incremental_load_log": _with(
            [TRADES, MINUTE_BARS],
            """SELECT '=' || symbol AS series, CAST(window_start AS DATE) AS trade_date, count(*) AS n_rows
               FROM bars GROUP BY ALL""",
        ),
        "incremental_daily": _two_loads(
            "trade_date <> DATE '2024-01-15' OR window_start < TIMESTAMP '2024-01-15 12:00:00'"
        ),
        "incremental_daily_reprocessed": _two_loads("true"),
        "incremental_symbols": _with(
            [*ANOMALIES, STAGED_FOUND, CORRECTED, _staged_trades("corrected"), SYMBOLS], "SELECT * FROM symbols"
        ),
        "stream_ohlcv_1hr": stream_bars,
        "stream_ohlcv_sliding": _with(
            [
                TRADES,
                """windowed AS (SELECT trades.*, time_bucket(INTERVAL 30 MINUTES, event_time)
                   - to_minutes(CAST(30 * i AS INTEGER)) AS window_start FROM trades, range(2) AS steps(i))""",
            ],
            _tidy(
                """SELECT symbol, arg_min(price, event_time) AS open, max(price) AS high, min(price) AS low,
                   arg_max(price, event_time) AS close, CAST(sum(volume) AS BIGINT) AS volume, count(*) AS trade_count,
                   avg(price) AS vwap, sum(price * volume) / nullif(sum(volume), 0) AS vwap_weighted, window_start,
                   window_start + INTERVAL 1 HOUR AS window_end, '1 hour' AS window_duration
                   FROM windowed GROUP BY symbol, window_start
                   HAVING window_start + INTERVAL 1 HOUR <= (SELECT max(event_time) - INTERVAL 30 SECONDS FROM trades)""",
                *_BAR_DOUBLES,
            ),
        ),
        "stream_raw_trades": _with(
            [TRADES], "SELECT symbol, price, volume, event_time, exchange, CAST(event_time AS DATE) AS trade_date FROM trades"
        ),
        "stream_speed_layer": _with(
            [TRADES, *[_bars(name, "trades", width, label) for name, (width, label) in _WINDOWS.items()]],
            """SELECT 'trades_raw_stream' AS table_name, symbol, CAST(event_time AS DATE) AS trade_date, count(*) AS n_rows,
               CAST(sum(volume) AS BIGINT) AS volume FROM trades GROUP BY ALL
               UNION ALL SELECT 'trades_raw_stream', NULL, NULL, count(*), NULL FROM trades WHERE price >= 100 HAVING count(*) > 0
               UNION ALL SELECT 'trades_rejected', 'malformed', NULL, count(*), NULL FROM trades WHERE price >= 100 HAVING count(*) > 0 """
            + " ".join(
                f"""UNION ALL SELECT '{name}', symbol, CAST(window_start AS DATE), count(*), CAST(sum(volume) AS BIGINT) FROM {name}
                WHERE window_end <= (SELECT max(event_time) - INTERVAL 30 SECONDS FROM trades)
                GROUP BY symbol, CAST(window_start AS DATE)"""
                for name in _WINDOWS
            ),
        ),
        "stream_late_rows": _with(
            [
                TRADES,
                _bars("bars", "trades", "1 HOUR", "1 hour"),
                """edges(low, high) AS (VALUES (TIMESTAMP '2024-01-11', TIMESTAMP '2024-01-21'), (TIMESTAMP '2024-01-21', TIMESTAMP '9999-01-01'))""",
                """sent AS (SELECT symbol, event_time, volume FROM trades
                   UNION ALL SELECT symbol, event_time, volume FROM trades, edges WHERE exchange = '0' AND event_time < low - INTERVAL 1 DAY
                   UNION ALL SELECT symbol, NULL, volume FROM trades, edges WHERE price < 5 AND event_time >= low AND event_time < high)""",
            ],
            """SELECT 'raw' AS table_name, symbol, CAST(event_time AS DATE) AS trade_date, count(*) AS n_rows,
               CAST(sum(volume) AS BIGINT) AS volume FROM sent GROUP BY ALL
               UNION ALL SELECT 'bars', symbol, CAST(window_start AS DATE), CAST(sum(trade_count) AS BIGINT), CAST(sum(volume) AS BIGINT)
               FROM bars WHERE window_end <= (SELECT max(event_time) - INTERVAL 30 SECONDS FROM trades)
               GROUP BY symbol, CAST(window_start AS DATE)""",
        ),
        "stream_dedup": _with(
            [
                TRADES,
                """landed AS (SELECT *, CASE WHEN event_time < TIMESTAMP '2024-01-11' THEN 1
                   WHEN event_time < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS landing FROM trades)""",
                """sent AS (SELECT symbol, price, volume, exchange, event_time, landing FROM landed
                   WHERE landing > 1 OR exchange <> '1'
                   UNION ALL SELECT symbol, CASE exchange WHEN '0' THEN price + 1 ELSE price END, volume, exchange, event_time,
                   later FROM landed, range(2, 4) AS landings(later) WHERE landing < later AND exchange IN ('0', '1'))""",
            ],
            """SELECT symbol, round(price + sign(price) * 1e-9, 6) AS price, volume, exchange, event_time FROM sent
               QUALIFY row_number() OVER (PARTITION BY symbol, event_time ORDER BY landing, price, volume, exchange) = 1""",
        ),
        "stream_messages_out": _with(
            [TRADES],
            """SELECT symbol AS "key", count(*) AS messages, CAST(sum(volume) AS BIGINT) AS volume
               FROM trades GROUP BY symbol""",
        ),
        "stream_message_contents": _with(
            [TRADES],
            """SELECT symbol AS "key", 5 AS n_fields, symbol, round(price + sign(price) * 1e-9, 6) AS price, volume, exchange,
               date_trunc('millisecond', event_time) AS event_time FROM trades""",
        ),
        "stream_anomalies": _with(ANOMALIES, "SELECT * EXCLUDE (seq, detected_at) FROM found"),
    }
