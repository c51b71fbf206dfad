"""Reference SQL (DuckDB dialect) for every registered query.

Each statement restates the fixture and the operator in plain SQL over the same
parquet tables, so the engine's plans can be checked against an independent
engine. Output conventions match ``plans.portable``: decimals as DOUBLE,
integers BIGINT, dates 'YYYY-MM-DD' text, timestamps 'YYYY-MM-DD HH:MM:SS.ffffff'.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def ts(c: str) -> str:
    return f"strftime({c}, {TS})"


def d(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def r2(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def avg2(c: str) -> str:
    """Exact half-up 2-place average of a positive decimal column (1e-8 units)."""
    s = f"CAST(sum({c}) * 100000000 AS HUGEINT)"
    n = f"count({c})"
    return f"(CAST((2 * {s} + 1000000 * {n}) // (2000000 * {n}) AS DECIMAL(18,0)) * 0.01)"


def div2(total: str, n: str) -> str:
    """Exact half-up 2-place quotient of a positive 2-place decimal by a count."""
    t = f"CAST(({total}) * 100 AS HUGEINT)"
    return f"(CAST((2 * {t} + ({n})) // (2 * ({n})) AS DECIMAL(18,0)) * 0.01)"


RULES_OK = ("coalesce(price > 0, false) AND coalesce(quantity > 0, false) AND coalesce(notional > 0, false) "
            "AND coalesce(symbol IS NOT NULL AND symbol != '', false) "
            "AND coalesce(trade_id IS NOT NULL AND trade_id != '', false)")


def _star(p: str, src: str) -> dict[str, str]:
    """Gold star schema + staging + marts over a trade source CTE ``src``."""
    return {
        f"{p}fact": f"SELECT * FROM {src} WHERE {RULES_OK}",
        f"{p}dim_time": f"""
            SELECT trade_date, year(trade_date) AS year, month(trade_date) AS month,
                   day(trade_date) AS day, quarter(trade_date) AS quarter,
                   dayname(trade_date) AS day_of_week, isodow(trade_date) AS day_of_week_num,
                   isodow(trade_date) IN (6, 7) AS is_weekend, monthname(trade_date) AS month_name
            FROM (SELECT DISTINCT trade_date FROM {p}fact)""",
        f"{p}dim_instrument": f"""
            SELECT symbol,
                   CASE WHEN strpos(symbol, '/') > 0 THEN substr(symbol, 1, strpos(symbol, '/') - 1) ELSE symbol END AS base_currency,
                   CASE WHEN strpos(symbol, '/') > 0 THEN substr(symbol, strpos(symbol, '/') + 1) END AS quote_currency,
                   'CRYPTO' AS asset_class,
                   CASE WHEN min(exchange) = max(exchange) THEN min(exchange) END AS exchange,
                   true AS is_active
            FROM {p}fact GROUP BY symbol""",
        f"{p}stg": f"""
            SELECT trade_id, symbol, trade_date, trade_hour, "timestamp" AS traded_at, ingested_at,
                   price, quantity, notional, trade_type, exchange, source AS data_source,
                   CASE WHEN price > 50000 THEN 'large_cap' WHEN price > 1000 THEN 'mid_cap'
                        ELSE 'small_cap' END AS price_tier
            FROM {p}fact""",
        f"{p}stg_inst": f"""
            SELECT symbol, base_currency, quote_currency, asset_class, exchange, is_active,
                   base_currency || ' / ' || quote_currency AS display_name,
                   coalesce(base_currency IN ('CLICK', 'VIEW'), false) AS is_major_coin
            FROM {p}dim_instrument WHERE is_active = true""",
        f"{p}mart_daily": f"""
            SELECT a.trade_date, t.day_of_week, t.is_weekend, a.symbol, a.trade_count, a.total_quantity,
                   a.total_notional_usd, a.low_price, a.high_price, a.avg_price, a.open_price,
                   a.close_price, a.first_ingested_at, a.last_ingested_at
            FROM (SELECT trade_date, symbol, count(*) AS trade_count, sum(quantity) AS total_quantity,
                         round(sum(notional), 2) AS total_notional_usd,
                         round(min(price), 2) AS low_price, round(max(price), 2) AS high_price,
                         {avg2('price')} AS avg_price,
                         round(first(price ORDER BY traded_at, trade_id), 2) AS open_price,
                         round(last(price ORDER BY traded_at, trade_id), 2) AS close_price,
                         min(ingested_at) AS first_ingested_at, max(ingested_at) AS last_ingested_at
                  FROM {p}stg GROUP BY trade_date, symbol) a
            JOIN {p}dim_time t ON a.trade_date = t.trade_date""",
        f"{p}ticks": f"""
            SELECT trade_date, symbol, traded_at, price, count(*) AS n, sum(quantity) AS quantity, sum(notional) AS notional,
                   min(ingested_at) AS first_in, max(ingested_at) AS last_in
            FROM {p}stg GROUP BY ALL""",
        f"{p}tick_ends": f"""
            SELECT trade_date, symbol, arg_min(price, (traded_at, price)) AS opening, arg_max(price, (traded_at, price)) AS closing
            FROM {p}ticks GROUP BY ALL""",
        f"{p}mart_tick": f"""
            SELECT DISTINCT k.trade_date, c.day_of_week, c.is_weekend, k.symbol, n AS trade_count, quantity AS total_quantity,
                   round(notional, 2) AS total_notional_usd, round(price, 2) AS low_price, round(price, 2) AS high_price,
                   round(price, 2) AS avg_price, round(opening, 2) AS open_price, round(closing, 2) AS close_price,
                   first_in AS first_ingested_at, last_in AS last_ingested_at
            FROM {p}ticks k NATURAL JOIN {p}tick_ends e, {p}dim_time c WHERE c.trade_date = k.trade_date""",
        f"{p}mart_perf": f"""
            SELECT p.symbol, i.display_name, i.asset_class, i.is_major_coin, p.total_trades,
                   p.total_notional_usd, p.avg_notional_per_trade, p.all_time_low, p.all_time_high,
                   p.avg_price, p.price_stddev, p.trading_days, p.first_seen, p.last_seen, p.last_updated,
                   rank() OVER (ORDER BY p.total_notional_usd DESC) AS volume_rank,
                   rank() OVER (ORDER BY p.total_trades DESC) AS activity_rank
            FROM (SELECT symbol, count(*) AS total_trades, round(sum(notional), 2) AS total_notional_usd,
                         {avg2('notional')} AS avg_notional_per_trade,
                         round(min(price), 2) AS all_time_low, round(max(price), 2) AS all_time_high,
                         {avg2('price')} AS avg_price,
                         round(stddev_samp(CAST(price AS DOUBLE)), 2) AS price_stddev,
                         count(DISTINCT trade_date) AS trading_days, min(trade_date) AS first_seen,
                         max(trade_date) AS last_seen, max(ingested_at) AS last_updated
                  FROM {p}stg GROUP BY symbol) p
            JOIN {p}stg_inst i ON p.symbol = i.symbol""",
    }


CTES: dict[str, str] = {
    "tfe": """
        SELECT CAST(event_id AS VARCHAR) AS trade_id,
               upper(event_type) || '/USD' AS symbol,
               CAST(ts AS DATE) AS trade_date,
               hour(ts) AS trade_hour,
               CAST(value AS DECIMAL(18,8)) AS price,
               CAST(json_extract_string(props, '$.k') AS DECIMAL(18,8)) AS quantity,
               CAST(CAST(value AS DECIMAL(10,2)) * CAST(json_extract_string(props, '$.k') AS DECIMAL(10,0))
                    AS DECIMAL(18,2)) AS notional,
               'CRYPTO' AS trade_type,
               CASE WHEN user_id % 3 = 0 THEN 'UNKNOWN' ELSE 'EX' || CAST(user_id % 3 AS VARCHAR) END AS exchange,
               CASE WHEN event_id % 10 = 7 THEN 'feed_b' ELSE 'feed_a' END AS source,
               ts AS "timestamp",
               ts + to_seconds(event_id % 300) AS ingested_at
        FROM events""",
    "wtr": """
        SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                         CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS trade_id,
               p_brand || '/USD' AS symbol,
               CAST(l_shipdate AS DATE) AS trade_date,
               hour(l_shipdate) AS trade_hour,
               CAST(l_extendedprice AS DECIMAL(18,8)) AS price,
               CAST(l_quantity AS DECIMAL(18,8)) AS quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_quantity AS DECIMAL(10,0)) AS DECIMAL(18,2)) AS notional,
               'CRYPTO' AS trade_type,
               'EX' || CAST(l_suppkey % 3 AS VARCHAR) AS exchange,
               'lineitem' AS source,
               l_shipdate AS "timestamp",
               l_shipdate AS ingested_at
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
}
ISO = "'%Y-%m-%dT%H:%M:%S.%f'"
SILVER_COLS = ("trade_id, symbol, price, quantity, notional, exchange, trade_type, \"timestamp\", "
               "ingested_at, source, conditions, trade_date, trade_hour")


def parse_time(c: str) -> str:
    return (f"CASE WHEN regexp_matches(trim({c}), '^-?[0-9]{{1,18}}$') "
            f"THEN CASE WHEN CAST(trim({c}) AS BIGINT) BETWEEN -62135596800000 AND 253402300799999 "
            f"THEN make_timestamp(CAST(trim({c}) AS BIGINT) * 1000) END "
            f"ELSE timezone('UTC', TRY_CAST(trim({c}) AS TIMESTAMPTZ)) END")


def failed_rules_sql() -> str:
    return ("concat_ws(',', "
            "CASE WHEN NOT coalesce(price > 0, false) THEN 'price_positive' END, "
            "CASE WHEN NOT coalesce(quantity > 0, false) THEN 'quantity_positive' END, "
            "CASE WHEN NOT coalesce(notional > 0, false) THEN 'notional_positive' END, "
            "CASE WHEN NOT coalesce(symbol IS NOT NULL AND symbol != '', false) THEN 'symbol_not_empty' END, "
            "CASE WHEN NOT coalesce(trade_id IS NOT NULL AND trade_id != '', false) THEN 'trade_id_not_empty' END)")


# Constraints of the fact's columns.
NOT_NULL = ["trade_id", "symbol", "trade_date", "trade_hour", "price", "quantity", "notional", "trade_type", "source",
            '"timestamp"', "ingested_at"]
FACT_NUMBERS = [("price", "DECIMAL(18,8)"), ("quantity", "DECIMAL(18,8)"), ("notional", "DECIMAL(18,2)")]
FACT_WIDTHS = [("trade_id", 50), ("symbol", 20), ("trade_type", 20), ("exchange", 50), ("source", 50)]

CTES.update({
    "bronze": f"""
        SELECT CASE WHEN event_id % 103 = 0 THEN '' WHEN event_id % 233 = 0 THEN lpad(CAST(event_id AS VARCHAR), 60, '0')
                    ELSE CAST(event_id AS VARCHAR) END AS trade_id,
               CASE WHEN event_id % 101 = 0 THEN ''
                    WHEN event_id % 10 = 7 THEN upper(event_type) || '-USD'
                    ELSE upper(event_type) || '/USD' END AS symbol,
               CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN '-1.0'
                    WHEN event_id % 83 = 0 THEN 'abc' WHEN event_id % 223 = 0 THEN '100000000000.0'
                    ELSE CAST(value AS VARCHAR) END AS price,
               json_extract_string(props, '$.k') AS quantity,
               CAST(CAST(CAST(value AS DECIMAL(10,2)) * CAST(json_extract_string(props, '$.k') AS DECIMAL(10,0))
                    AS DECIMAL(18,2)) AS VARCHAR) AS notional,
               CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'EX' || CAST(user_id % 3 AS VARCHAR) END AS exchange,
               CASE WHEN event_id % 199 = 0 THEN 'OPTION' ELSE 'CRYPTO' END AS trade_type,
               CASE WHEN event_id % 227 = 0 THEN '999999999999999999' WHEN event_id % 229 = 0 THEN 'not a time'
                    WHEN event_id % 10 = 7 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
                    ELSE strftime(ts, {ISO}) || '+00:00' END AS "timestamp",
               strftime(ts + to_seconds(event_id % 300 + n), {ISO}) || '+00:00' AS ingested_at,
               CASE WHEN event_id % 10 = 7 THEN 'feed_b' ELSE 'feed_a' END AS source,
               CASE WHEN event_id % 37 = 0 THEN 'I,' || upper(substr(event_type, 1, 1)) END AS conditions
        FROM (SELECT *, 0 AS n FROM events UNION ALL SELECT *, 60 AS n FROM events WHERE event_id % 50 = 0)""",
    "s_cast": f"""
        SELECT trade_id, symbol, TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(quantity AS DOUBLE) AS quantity,
               TRY_CAST(notional AS DOUBLE) AS notional, exchange, trade_type,
               {parse_time('"timestamp"')} AS "timestamp", {parse_time('ingested_at')} AS ingested_at,
               source, conditions
        FROM bronze""",
    "s_derived": """
        SELECT *, strftime("timestamp", '%Y-%m-%d') AS trade_date, strftime("timestamp", '%H') AS trade_hour
        FROM s_cast""",
    "s_dedup": f"""
        SELECT {SILVER_COLS} FROM (
          SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY
                   ingested_at NULLS FIRST, "timestamp" NULLS FIRST, symbol NULLS FIRST, price NULLS FIRST,
                   quantity NULLS FIRST, notional NULLS FIRST, exchange NULLS FIRST, trade_type NULLS FIRST,
                   source NULLS FIRST, conditions NULLS FIRST, trade_date NULLS FIRST, trade_hour NULLS FIRST) AS rn
          FROM s_derived) WHERE rn = 1""",
    "s_fill": """
        SELECT * REPLACE (coalesce(exchange, 'UNKNOWN') AS exchange, coalesce(conditions, 'NONE') AS conditions)
        FROM s_dedup""",
    "s_round": "SELECT * REPLACE (round(notional, 2) AS notional) FROM s_fill",
    "s_routed": f"SELECT *, {failed_rules_sql()} AS failed_rules FROM s_round",
    "s_good": f"SELECT {SILVER_COLS} FROM s_routed WHERE failed_rules = ''",
    "s_bad": "SELECT * FROM s_routed WHERE failed_rules != ''",
    "s_checked": f"""
        SELECT *, concat_ws(',', {", ".join(f"CASE WHEN {c} IS NULL THEN 'null_{c.strip(chr(34))}' END" for c in NOT_NULL)},
               {", ".join(f"CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL THEN 'invalid_{c}' END" for c, t in FACT_NUMBERS)},
               {", ".join(f"CASE WHEN length({c}) > {n} THEN 'long_{c}' END" for c, n in FACT_WIDTHS)}) AS reason
        FROM s_good""",
    "sfact": """
        SELECT trade_id, symbol, CAST(trade_date AS DATE) AS trade_date, CAST(trade_hour AS INTEGER) AS trade_hour,
               CAST(price AS DECIMAL(18,8)) AS price, CAST(quantity AS DECIMAL(18,8)) AS quantity,
               CAST(notional AS DECIMAL(18,2)) AS notional, trade_type, exchange, source, "timestamp", ingested_at
        FROM s_checked WHERE reason = ''""",
    "seeded": """
        SELECT * FROM (VALUES ('BTC/USD', 'BTC', 'USD', 'CRYPTO', 'SEEDED', true), ('CLICK/USD', 'CLICK', 'USD', 'CRYPTO', 'SEEDED', true),
                              ('ETH/USD', 'ETH', 'USD', 'CRYPTO', 'SEEDED', true))
               v(symbol, base_currency, quote_currency, asset_class, exchange, is_active)""",
    "inst_merged": """
        SELECT * FROM seeded UNION ALL
        SELECT symbol, split_part(symbol, '/', 1), substr(symbol, strpos(symbol, '/') + 1), 'CRYPTO',
               CASE WHEN count(DISTINCT exchange) = 1 THEN any_value(exchange) END, true
        FROM sfact WHERE strpos(symbol, '/') > 0 AND symbol NOT IN (SELECT symbol FROM seeded) GROUP BY symbol""",
})
CTES.update({
    "rfact": """
        SELECT trade_id, symbol, TRY_CAST(trade_date AS DATE) AS trade_date, TRY_CAST(price AS DECIMAL(18,8)) AS price, trade_type
        FROM s_derived""",
})
CTES.update(_star("", "tfe"))
CTES.update(_star("w_", "wtr"))


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTE library (DuckDB skips CTEs it does not use)."""
    lib = ",\n".join(f"{k} AS ({v})" for k, v in CTES.items())
    b = body.lstrip()
    if b[:5].upper() == "WITH ":
        return f"WITH {lib},\n{b[5:]}"
    return f"WITH {lib}\n{b}"


# --- output projections shared by several statements --------------------------------

def mart_daily_out(src: str) -> str:
    return f"""SELECT {d('trade_date')} AS trade_date, day_of_week, is_weekend, symbol, trade_count,
        {dbl('total_quantity')} AS total_quantity, {dbl('total_notional_usd')} AS total_notional_usd,
        {dbl('low_price')} AS low_price, {dbl('high_price')} AS high_price, {dbl('avg_price')} AS avg_price,
        {dbl('open_price')} AS open_price, {dbl('close_price')} AS close_price,
        {ts('first_ingested_at')} AS first_ingested_at, {ts('last_ingested_at')} AS last_ingested_at
        FROM {src}"""


def mart_perf_out(src: str) -> str:
    return f"""SELECT symbol, display_name, asset_class, is_major_coin, total_trades,
        {dbl('total_notional_usd')} AS total_notional_usd, {dbl('avg_notional_per_trade')} AS avg_notional_per_trade,
        {dbl('all_time_low')} AS all_time_low, {dbl('all_time_high')} AS all_time_high,
        {dbl('avg_price')} AS avg_price, {dbl('price_stddev')} AS price_stddev, trading_days,
        {d('first_seen')} AS first_seen, {d('last_seen')} AS last_seen, {ts('last_updated')} AS last_updated,
        volume_rank, activity_rank
        FROM {src}"""


ORACLE: dict[str, str] = {
    "mart_daily_summary": with_ctes(mart_daily_out("mart_daily")),
    "mart_daily_summary_wide": with_ctes(mart_daily_out("w_mart_daily")),
    "mart_daily_summary_tick": with_ctes(mart_daily_out("mart_tick")),
    "mart_daily_summary_tick_wide": with_ctes(mart_daily_out("w_mart_tick")),
    "mart_symbol_performance": with_ctes(mart_perf_out("mart_perf")),
    "mart_symbol_performance_wide": with_ctes(mart_perf_out("w_mart_perf")),
}


def silver_out(src: str, extra: str = "") -> str:
    derived = ", trade_date, trade_hour" if src != "s_cast" else ""
    return f"""SELECT trade_id, symbol, price, quantity, notional, exchange, trade_type,
        {ts('"timestamp"')} AS "timestamp", {ts('ingested_at')} AS ingested_at, source, conditions{derived}{extra}
        FROM {src}"""


ORACLE.update({
    "silver_cast": with_ctes(silver_out("s_cast")),
    "silver_derived": with_ctes(silver_out("s_derived")),
    "silver_dedup": with_ctes(silver_out("s_dedup")),
    "dedup_stats": with_ctes("""SELECT (SELECT count(*) FROM s_derived) AS rows_in,
        (SELECT count(*) FROM s_dedup) AS rows_out,
        (SELECT count(*) FROM s_derived) - (SELECT count(*) FROM s_dedup) AS duplicates_removed"""),
    "silver_fill": with_ctes(silver_out("s_fill")),
    "silver_round": with_ctes(silver_out("s_round")),
    "quality_good": with_ctes(silver_out("s_good")),
    "quality_dead_letter": with_ctes(silver_out("s_bad", ", failed_rules")),
    "quality_strict_bad": with_ctes(silver_out(
        "(SELECT * FROM s_round WHERE NOT (price > 0 AND quantity > 0 AND notional > 0 "
        "AND (symbol IS NOT NULL AND symbol != '') AND (trade_id IS NOT NULL AND trade_id != '')))")),
    "quality_report": with_ctes("""
        WITH flags AS (SELECT failed_rules FROM s_routed),
             tot AS (SELECT count(*) AS rows_checked, count(*) FILTER (WHERE failed_rules != '') AS rows_failed FROM flags)
        SELECT r.rule, (SELECT count(*) FROM flags WHERE list_contains(string_split(failed_rules, ','), r.rule)) AS failures,
               tot.rows_checked, tot.rows_failed
        FROM (VALUES ('price_positive'), ('quantity_positive'), ('notional_positive'),
                     ('symbol_not_empty'), ('trade_id_not_empty')) r(rule), tot"""),
})


FACT_OUT = ("trade_id, symbol, {d}, trade_hour, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity, "
            "CAST(notional AS DOUBLE) AS notional, trade_type, exchange, source, {t}, {i}").format(
    d=d("trade_date") + " AS trade_date", t=ts('"timestamp"') + ' AS "timestamp"', i=ts("ingested_at") + " AS ingested_at")
DIM_TIME_OUT = (f"{d('trade_date')} AS trade_date, year, month, day, quarter, day_of_week, "
                "day_of_week_num, is_weekend, month_name")


def checks_sql(rows: list[tuple[str, str]]) -> str:
    """UNION ALL of (check_name, failures, passed) rows from scalar subqueries."""
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS check_name, CAST(({q}) AS BIGINT) AS failures, ({q}) = 0 AS passed" for n, q in rows)


from ..operators.documents import DOC_PIPELINE, DOC_SOURCE, DOC_VERSION  # noqa: E402
from ..schemas import FIXED_VARCHAR_LIMITS  # noqa: E402

DQ = {
    "dq_unique": [
        ("unique:fact_trades.trade_id", "SELECT count(*) FROM (SELECT trade_id FROM rfact GROUP BY trade_id HAVING count(*) > 1)"),
        ("unique:dim_instrument.symbol", "SELECT count(*) FROM (SELECT symbol FROM dim_instrument GROUP BY symbol HAVING count(*) > 1)"),
        ("unique:dim_time.trade_date", "SELECT count(*) FROM (SELECT trade_date FROM dim_time GROUP BY trade_date HAVING count(*) > 1)"),
    ],
    "dq_not_null": [
        ("not_null:fact_trades.trade_id", "SELECT count(*) FROM rfact WHERE trade_id IS NULL"),
        ("not_null:fact_trades.symbol", "SELECT count(*) FROM rfact WHERE symbol IS NULL"),
        ("not_null:fact_trades.price", "SELECT count(*) FROM rfact WHERE price IS NULL"),
        ("not_null:dim_instrument.symbol", "SELECT count(*) FROM dim_instrument WHERE symbol IS NULL"),
        ("not_null:dim_time.trade_date", "SELECT count(*) FROM dim_time WHERE trade_date IS NULL"),
    ],
    "dq_relationships": [
        ("relationships:fact_trades.symbol->dim_instrument",
         "SELECT count(*) FROM rfact f WHERE f.symbol IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_instrument i WHERE i.symbol = f.symbol)"),
        ("relationships:fact_trades.trade_date->dim_time",
         "SELECT count(*) FROM rfact f WHERE f.trade_date IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dim_time t WHERE t.trade_date = f.trade_date)"),
    ],
    "dq_accepted_values": [
        ("accepted_values:dim_instrument.asset_class",
         "SELECT count(*) FROM dim_instrument WHERE NOT (asset_class IN ('CRYPTO', 'EQUITY', 'FX'))"),
        ("accepted_values:fact_trades.trade_type",
         "SELECT count(*) FROM rfact WHERE NOT (trade_type IN ('CRYPTO', 'EQUITY'))"),
    ],
    "dq_type_bounds": [
        *[(f"length:fact_trades.{c}<={n}", f"SELECT count(*) FROM s_derived WHERE length({c}) > {n}")
          for c, n in FIXED_VARCHAR_LIMITS["fact_trades"].items()],
        ("numeric:fact_trades.price(18,8)", "SELECT count(*) FROM s_derived WHERE price IS NOT NULL AND TRY_CAST(price AS DECIMAL(18,8)) IS NULL"),
        ("numeric:fact_trades.quantity(18,8)", "SELECT count(*) FROM s_derived WHERE quantity IS NOT NULL AND TRY_CAST(quantity AS DECIMAL(18,8)) IS NULL"),
        ("numeric:fact_trades.notional(18,2)", "SELECT count(*) FROM s_derived WHERE notional IS NOT NULL AND TRY_CAST(notional AS DECIMAL(18,2)) IS NULL"),
        *[(f"length:dim_instrument.{c}<={n}", f"SELECT count(*) FROM dim_instrument WHERE length({c}) > {n}")
          for c, n in FIXED_VARCHAR_LIMITS["dim_instrument"].items()],
    ],
}
DQ_ALL = [r for k in ("dq_unique", "dq_not_null", "dq_relationships", "dq_accepted_values", "dq_type_bounds") for r in DQ[k]]

PERF_W = "w_mart_perf"
HOUR_COLS = ", ".join(
    f"CAST(coalesce(sum(trade_count) FILTER (WHERE trade_hour = {h}), 0) AS BIGINT) AS h{h:02d}" for h in range(24))
DAILY_SLICE = ("(SELECT DISTINCT trade_date, day_of_week, is_weekend, symbol, trade_count, total_notional_usd, "
               "low_price, high_price, avg_price, open_price, close_price FROM {src} "
               "WHERE symbol = 'CLICK/USD' AND trade_date >= DATE '2024-01-08' AND trade_date <= DATE '2024-01-21')")
DAILY_ALL = ("(SELECT DISTINCT trade_date, day_of_week, is_weekend, symbol, trade_count, total_notional_usd, "
             "low_price, high_price, avg_price, open_price, close_price FROM {src})")
HOURLY = "(SELECT trade_hour, symbol, count(*) AS trade_count, round(sum(notional), 2) AS total_notional FROM fact GROUP BY trade_hour, symbol)"
RECENT = ('(SELECT symbol, price, quantity, notional, "timestamp", trade_date, trade_hour, source, trade_id FROM fact '
          'ORDER BY "timestamp" DESC, trade_id DESC LIMIT {n})')
STATS = f"""(SELECT count(*) AS total_trades, count(DISTINCT trade_date) AS trading_days, count(DISTINCT symbol) AS symbols,
        min(ingested_at) AS first_ingested, max(ingested_at) AS last_ingested,
        round(sum(notional), 2) AS total_notional, {avg2('notional')} AS avg_notional,
        count(*) FILTER (WHERE exchange = 'UNKNOWN') AS null_exchange_count FROM fact)"""


DAILY_OUT = f"""SELECT {d('trade_date')} AS trade_date, day_of_week, is_weekend, symbol, trade_count,
        CAST(total_notional_usd AS DOUBLE) AS total_notional_usd, CAST(low_price AS DOUBLE) AS low_price,
        CAST(high_price AS DOUBLE) AS high_price, CAST(avg_price AS DOUBLE) AS avg_price,
        CAST(open_price AS DOUBLE) AS open_price, CAST(close_price AS DOUBLE) AS close_price
        FROM {DAILY_SLICE.format(src='mart_daily')}"""


def report_daily_sql(src: str) -> str:
    return f"""SELECT {d('trade_date')} AS trade_date, symbol, CAST(sum(trade_count) AS BIGINT) AS trade_count,
        CAST(sum(total_notional_usd) AS DOUBLE) AS total_notional_usd, CAST({avg2('avg_price')} AS DOUBLE) AS avg_price
        FROM {DAILY_ALL.format(src=src)} GROUP BY trade_date, symbol"""


ORACLE.update({
    "dim_time": with_ctes(f"SELECT {DIM_TIME_OUT} FROM dim_time"),
    "dim_instrument": with_ctes("SELECT * FROM dim_instrument"),
    "fact_trades": with_ctes(f"SELECT {FACT_OUT} FROM sfact"),
    "stg_trades": with_ctes(f"""SELECT trade_id, symbol, {d('trade_date')} AS trade_date, trade_hour,
        {ts('traded_at')} AS traded_at, {ts('ingested_at')} AS ingested_at, CAST(price AS DOUBLE) AS price,
        CAST(quantity AS DOUBLE) AS quantity, CAST(notional AS DOUBLE) AS notional, trade_type, exchange,
        data_source, price_tier FROM w_stg"""),
    "stg_instruments": with_ctes("SELECT * FROM stg_inst"),
    "fact_orphans": with_ctes(f"""SELECT {FACT_OUT}, reason FROM (
        SELECT f.*, concat_ws(',', CASE WHEN i.symbol IS NULL THEN 'missing_instrument' END,
                                  CASE WHEN t.trade_date IS NULL THEN 'missing_date' END) AS reason
        FROM sfact f LEFT JOIN (SELECT DISTINCT symbol FROM dim_instrument) i ON f.symbol = i.symbol
                     LEFT JOIN (SELECT DISTINCT trade_date FROM dim_time) t ON f.trade_date = t.trade_date)
        WHERE reason != ''"""),
    "fact_trades_new": with_ctes(f"SELECT {FACT_OUT} FROM fact WHERE trade_id NOT IN (SELECT trade_id FROM sfact WHERE trade_id IS NOT NULL)"),
    "fact_trades_indexed": with_ctes(f"SELECT {FACT_OUT} FROM fact WHERE trade_id NOT IN (SELECT trade_id FROM sfact WHERE trade_id IS NOT NULL)"),
    "fact_loaded": with_ctes(f"SELECT {FACT_OUT} FROM sfact WHERE symbol IN (SELECT symbol FROM inst_merged)"),
    "fact_rejects": with_ctes("""
        SELECT trade_id, symbol, trade_date, price, reason FROM s_checked WHERE reason != ''
        UNION ALL SELECT trade_id, symbol, strftime(trade_date, '%Y-%m-%d'), CAST(price AS DOUBLE), 'missing_instrument'
        FROM sfact WHERE symbol NOT IN (SELECT symbol FROM inst_merged)"""),
    "dim_instrument_merged": with_ctes("SELECT * FROM inst_merged"),
    "dim_time_new": with_ctes(f"SELECT {DIM_TIME_OUT} FROM w_dim_time WHERE trade_date NOT IN (SELECT trade_date FROM dim_time)"),
    "gold_symbol_distribution": with_ctes(f"""SELECT f.symbol, i.asset_class, f.trade_count, f.avg_price, f.total_notional FROM
        (SELECT symbol, count(trade_id) AS trade_count, CAST({avg2('price')} AS DOUBLE) AS avg_price,
                CAST(round(sum(notional), 2) AS DOUBLE) AS total_notional FROM fact GROUP BY symbol) f
        JOIN dim_instrument i ON f.symbol = i.symbol"""),
    "gold_date_coverage": with_ctes(f"""SELECT {d('f.trade_date')} AS trade_date, t.day_of_week, f.trade_count FROM
        (SELECT trade_date, count(trade_id) AS trade_count FROM fact GROUP BY trade_date) f
        JOIN dim_time t ON f.trade_date = t.trade_date"""),
    "gold_total": with_ctes("SELECT count(*) AS total FROM fact"),
    "all_trades": with_ctes(f"""SELECT f.trade_id, f.symbol, CAST(f.price AS DOUBLE) AS price, CAST(f.quantity AS DOUBLE) AS quantity,
        CAST(f.notional AS DOUBLE) AS notional, f.trade_type, f.exchange, f.source, {ts('f."timestamp"')} AS "timestamp",
        {d('f.trade_date')} AS trade_date, f.trade_hour, {ts('f.ingested_at')} AS ingested_at,
        i.asset_class, i.base_currency, i.quote_currency
        FROM fact f JOIN dim_instrument i ON f.symbol = i.symbol"""),
    "silver_symbol_distribution": with_ctes(f"""SELECT symbol, count(*) AS trade_count,
        CAST({avg2('TRY_CAST(price AS DECIMAL(18,8))')} AS DOUBLE) AS avg_price,
        CAST(sum(TRY_CAST(notional AS DECIMAL(18,2))) AS DOUBLE) AS total_notional FROM s_good GROUP BY symbol"""),
    "pipeline_stats": with_ctes(f"""SELECT total_trades, trading_days, symbols, {ts('first_ingested')} AS first_ingested,
        {ts('last_ingested')} AS last_ingested, CAST(total_notional AS DOUBLE) AS total_notional,
        CAST(avg_notional AS DOUBLE) AS avg_notional, null_exchange_count FROM {STATS}"""),
    "hourly_volume": with_ctes(f"SELECT trade_hour, symbol, trade_count, CAST(total_notional AS DOUBLE) AS total_notional FROM {HOURLY}"),
    "hourly_total": with_ctes(f"""SELECT trade_hour, CAST(sum(trade_count) AS BIGINT) AS trade_count,
        CAST(sum(total_notional) AS DOUBLE) AS total_notional, printf('%02d:00', trade_hour) AS hour_label
        FROM {HOURLY} GROUP BY trade_hour"""),
    "hourly_pivot": with_ctes(f"SELECT symbol, {HOUR_COLS} FROM {HOURLY} GROUP BY symbol"),
    "daily_filtered": with_ctes(DAILY_OUT),
    "date_bounds": with_ctes(f"SELECT {d('min(trade_date)')} AS min_date, {d('max(trade_date)')} AS max_date FROM mart_daily"),
    "daily_volume_trend": with_ctes(f"""SELECT {d('trade_date')} AS trade_date, symbol,
        CAST(sum(total_notional_usd) AS DOUBLE) AS total_notional_usd
        FROM {DAILY_ALL.format(src='mart_daily')} GROUP BY trade_date, symbol"""),
    "report_daily": with_ctes(report_daily_sql("mart_daily")),
    "report_daily_tick": with_ctes(report_daily_sql("mart_tick")),
    "market_kpis": with_ctes(f"""SELECT CAST(sum(total_notional_usd) AS DOUBLE) AS total_volume,
        CAST(sum(trade_count) AS BIGINT) AS total_trades, CAST({avg2('avg_price')} AS DOUBLE) AS avg_price,
        count(DISTINCT trade_date) AS days_covered,
        CAST({div2('sum(total_notional_usd)', 'greatest(sum(trade_count), 1)')} AS DOUBLE) AS volume_per_trade
        FROM {DAILY_SLICE.format(src='mart_daily')}"""),
    "symbol_distribution": with_ctes("""SELECT f.symbol, count(*) AS trade_count, CAST(sum(f.notional) AS DOUBLE) AS total_notional
        FROM fact f JOIN dim_instrument i ON f.symbol = i.symbol GROUP BY f.symbol"""),
    "recent_trades": with_ctes(f"""SELECT symbol, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
        CAST(notional AS DOUBLE) AS notional, {ts('"timestamp"')} AS "timestamp", {d('trade_date')} AS trade_date,
        trade_hour, source, trade_id FROM {RECENT.format(n=50)}"""),
    "trade_log": with_ctes(f"""SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS timestamp_utc, symbol,
        '$' || format('{{:,.4f}}', CAST(price AS DOUBLE)) AS price, CAST(quantity AS DOUBLE) AS qty,
        '$' || format('{{:,.2f}}', CAST(notional AS DOUBLE)) AS notional FROM {RECENT.format(n=10)}"""),
    "asset_profile": with_ctes(f"""SELECT symbol, is_major_coin, CAST(avg_price AS DOUBLE) AS avg_price,
        CAST(all_time_low AS DOUBLE) AS all_time_low, CAST(all_time_high AS DOUBLE) AS all_time_high,
        CAST(total_notional_usd AS DOUBLE) AS total_notional_usd, total_trades,
        CAST(avg_notional_per_trade AS DOUBLE) AS avg_notional_per_trade, trading_days,
        CAST(coalesce(price_stddev, 0) AS DOUBLE) AS price_stddev,
        CASE WHEN coalesce(price_stddev, 0) < 100 THEN 'LOW' WHEN coalesce(price_stddev, 0) < 500 THEN 'MEDIUM' ELSE 'HIGH' END AS volatility,
        CAST(all_time_high - all_time_low AS DOUBLE) AS price_range FROM {PERF_W}"""),
    "portfolio_share": with_ctes("""SELECT symbol, CAST(total_notional_usd AS DOUBLE) AS total_notional_usd,
        CAST(total_notional_usd AS DOUBLE) / CAST(sum(total_notional_usd) OVER () AS DOUBLE) AS share FROM mart_perf"""),
    "report_assets": with_ctes(f"""SELECT symbol, total_trades AS trades, CAST(avg_price AS DOUBLE) AS avg_price,
        CAST(all_time_low AS DOUBLE) AS low, CAST(all_time_high AS DOUBLE) AS high,
        CAST(total_notional_usd AS DOUBLE) AS volume_usd,
        CASE WHEN coalesce(price_stddev, 0) < 100 THEN 'LOW' WHEN coalesce(price_stddev, 0) < 500 THEN 'MEDIUM' ELSE 'HIGH' END AS volatility
        FROM {PERF_W}"""),
    **{k: with_ctes(checks_sql(v)) for k, v in DQ.items()},
    "dq_summary": with_ctes(checks_sql(DQ_ALL)),
    "report_summary": with_ctes(f"""WITH st AS {STATS}, chk AS ({checks_sql(DQ_ALL)}),
        c AS (SELECT count(*) AS n_checks, count(*) FILTER (WHERE passed) AS n_passed FROM chk)
        SELECT * FROM (VALUES
          ('Total Trades Processed', (SELECT format('{{:,}}', total_trades) FROM st)),
          ('Total Volume (USD)', (SELECT '$' || format('{{:,.2f}}', CAST(total_notional AS DOUBLE)) FROM st)),
          ('Trading Days Covered', (SELECT CAST(trading_days AS VARCHAR) FROM st)),
          ('Average Trade Value', (SELECT '$' || format('{{:,.2f}}', CAST(avg_notional AS DOUBLE)) FROM st)),
          ('Data Quality Tests', (SELECT n_passed || ' / ' || n_checks || ' Passing' FROM c))
        ) v(metric, value)"""),
})


RECENT10 = """(SELECT * FROM (SELECT symbol, trade_id, price, quantity, notional, trade_type, exchange, "timestamp",
        ingested_at, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC, trade_id DESC) AS recency_rank
        FROM {src}) WHERE recency_rank <= 10)"""
SFACT_SYMBOLS = """(SELECT symbol, count(*) AS total_trades, count(DISTINCT trade_date) AS days,
        least(count(*), 10) AS recent FROM sfact GROUP BY symbol)"""

ORACLE.update({
    "recent_trades_per_symbol": with_ctes(f"""SELECT symbol, trade_id, CAST(price AS DOUBLE) AS price,
        CAST(quantity AS DOUBLE) AS quantity, CAST(notional AS DOUBLE) AS notional, trade_type, exchange,
        {ts('"timestamp"')} AS "timestamp", {ts('ingested_at')} AS ingested_at, recency_rank
        FROM {RECENT10.format(src='fact')}"""),
    "portfolio_check": with_ctes("""SELECT p.symbol AS _id, p.total_trades, p.volume_rank,
        least(p.total_trades, 10) AS recent_trades_count,
        (SELECT count(*) FROM mart_daily m WHERE m.symbol = p.symbol) AS daily_breakdown_count
        FROM mart_perf p"""),
    "portfolio_recent_flat": with_ctes(f"""SELECT symbol, recency_rank AS position, trade_id, CAST(price AS DOUBLE) AS price,
        CAST(quantity AS DOUBLE) AS quantity, CAST(notional AS DOUBLE) AS notional, trade_type, exchange,
        {ts('"timestamp"')} AS "timestamp" FROM {RECENT10.format(src='fact')}
        WHERE symbol IN (SELECT symbol FROM mart_perf)"""),
    "portfolio_daily_flat": with_ctes(f"""SELECT symbol, {d('trade_date')} AS date, day_of_week, is_weekend, trade_count,
        CAST(total_notional_usd AS DOUBLE) AS total_notional_usd, CAST(open_price AS DOUBLE) AS open,
        CAST(high_price AS DOUBLE) AS high, CAST(low_price AS DOUBLE) AS low, CAST(close_price AS DOUBLE) AS close,
        CAST(avg_price AS DOUBLE) AS avg FROM mart_daily WHERE symbol IN (SELECT symbol FROM mart_perf)"""),
    "portfolio_upsert": with_ctes(f"""
        SELECT coalesce(n.symbol, o.symbol) AS _id,
               CASE WHEN o.symbol IS NULL THEN 'inserted' WHEN n.symbol IS NULL THEN 'kept' ELSE 'updated' END AS _action,
               CASE WHEN n.symbol IS NOT NULL THEN n.total_trades ELSE o.total_trades END AS total_trades,
               CASE WHEN n.symbol IS NOT NULL THEN n.recent ELSE o.recent END AS recent_trades_count,
               CASE WHEN n.symbol IS NOT NULL THEN n.days ELSE o.days END AS daily_breakdown_count
        FROM {SFACT_SYMBOLS} o
        FULL OUTER JOIN (SELECT symbol, count(*) AS total_trades, count(DISTINCT trade_date) AS days,
                                least(count(*), 10) AS recent FROM fact GROUP BY symbol) n ON o.symbol = n.symbol"""),
})


FEED_A = """(SELECT CASE WHEN event_id % 103 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS trade_id,
        upper(event_type) || '/USD' AS symbol, value AS price,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
        value * CAST(json_extract_string(props, '$.k') AS DOUBLE) AS notional,
        CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'EX' || CAST(user_id % 3 AS VARCHAR) END AS exchange,
        'CRYPTO' AS trade_type, ts AS "timestamp", ts + to_seconds(event_id % 300) AS ingested_at,
        'feed_a' AS source,
        CASE WHEN event_id % 4 IN (0, 1) THEN NULL ELSE 'I,' || upper(substr(event_type, 1, 1)) END AS conditions
        FROM events WHERE event_id % 10 != 7 AND event_id % 37 != 0)"""
FEED_B = """(SELECT CASE WHEN event_id % 103 = 0 THEN '' ELSE CAST(event_id AS VARCHAR) END AS trade_id,
        upper(event_type) || '/USD' AS symbol, value AS price,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
        value * CAST(json_extract_string(props, '$.k') AS DOUBLE) AS notional,
        CAST(user_id % 3 AS VARCHAR) AS exchange_id, 'CRYPTO' AS trade_type,
        make_timestamp((epoch_us(ts) // 1000) * 1000) AS "timestamp",
        ts + to_seconds(event_id % 300) AS ingested_at, 'feed_b' AS source
        FROM events WHERE event_id % 10 = 7 AND event_id % 31 != 0)"""


def event_out(src: str) -> str:
    return f"""SELECT trade_id, symbol, price, quantity, notional, exchange, trade_type,
        {ts('"timestamp"')} AS "timestamp", {ts('ingested_at')} AS ingested_at, source, conditions FROM {src}"""


BRONZE_PARTS = (f"strftime({parse_time('ingested_at')}, '%Y') AS year, strftime({parse_time('ingested_at')}, '%m') AS month, "
                f"strftime({parse_time('ingested_at')}, '%d') AS day, strftime({parse_time('ingested_at')}, '%H') AS hour")

ORACLE.update({
    "normalize_feed_a": with_ctes(event_out(FEED_A)),
    "normalize_feed_b": with_ctes(f"""SELECT trade_id, symbol, price, quantity, notional, exchange_id, trade_type,
        {ts('"timestamp"')} AS "timestamp", {ts('ingested_at')} AS ingested_at, source FROM {FEED_B}"""),
    "feed_corrupt": with_ctes(f"""SELECT event_id AS message_id, {ts('ts + to_seconds(event_id % 300)')} AS arrived_at,
        'malformed_json' AS reason FROM events WHERE event_id % 10 = 7 AND event_id % 31 = 0"""),
    "feed_a_corrupt": with_ctes("""SELECT event_id AS message_id, 'malformed_json' AS reason FROM events
        WHERE event_id % 10 != 7 AND event_id % 37 = 0"""),
    "topic_rejects": with_ctes(f"""SELECT event_id AS message_id, {ts('ts + to_seconds(event_id % 300)')} AS arrived_at,
        'malformed_json' AS reason FROM events
        WHERE (event_id % 10 = 7 AND event_id % 31 = 0) OR (event_id % 10 != 7 AND event_id % 37 = 0)"""),
    "feed_union": with_ctes(f"""SELECT trade_id, symbol, price, quantity, notional, exchange, trade_type,
        {ts('"timestamp"')} AS "timestamp", {ts('ingested_at')} AS ingested_at, source, conditions, exchange_id
        FROM (SELECT *, CAST(NULL AS VARCHAR) AS exchange_id FROM {FEED_A}
              UNION ALL BY NAME SELECT *, CAST(NULL AS VARCHAR) AS exchange, CAST(NULL AS VARCHAR) AS conditions
              FROM {FEED_B})"""),
    "json_roundtrip": with_ctes(f"SELECT {FACT_OUT} FROM fact"),
    "keyed_messages": with_ctes(f"SELECT symbol AS key, {FACT_OUT} FROM fact"),
    "bronze_scan": with_ctes(f"SELECT *, {BRONZE_PARTS} FROM bronze"),
    "bronze_scan_day": with_ctes(f"""SELECT * FROM (SELECT *, {BRONZE_PARTS} FROM bronze)
        WHERE year = '2024' AND month = '01' AND day = '15'"""),
    "silver_scan": with_ctes(f"""SELECT trade_id, symbol, price, quantity, notional, exchange, trade_type,
        {ts('"timestamp"')} AS "timestamp", {ts('ingested_at')} AS ingested_at, source, conditions, trade_date,
        CAST(trade_hour AS BIGINT) AS trade_hour FROM s_good"""),
    "export_trades": with_ctes(f"""SELECT f.trade_id, f.symbol, CAST(f.price AS DOUBLE) AS price, CAST(f.quantity AS DOUBLE) AS quantity,
        CAST(f.notional AS DOUBLE) AS notional, f.trade_type, f.exchange, f.source, {ts('f."timestamp"')} AS "timestamp",
        {d('f.trade_date')} AS trade_date, f.trade_hour, {ts('f.ingested_at')} AS ingested_at,
        i.asset_class, i.base_currency, i.quote_currency
        FROM fact f JOIN dim_instrument i ON f.symbol = i.symbol WHERE f.symbol = 'VIEW/USD'"""),
    "run_metrics": with_ctes("""SELECT (SELECT count(*) FROM bronze) AS rows_read, (SELECT count(*) FROM s_dedup) AS rows_after_dedup,
        (SELECT count(*) FROM bronze) - (SELECT count(*) FROM s_dedup) AS duplicates_removed,
        (SELECT count(*) FROM s_good) AS rows_written, (SELECT count(*) FROM s_bad) AS rows_dead_letter,
        CASE WHEN (SELECT count(*) FROM s_bad) > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status"""),
})

ORACLE["topic_trades"] = ORACLE["feed_union"]
ISO_TEXT = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"

ORACLE.update({
    "stream_silver": with_ctes(f"""SELECT trade_id, symbol, price, quantity, notional, exchange, trade_type,
        {ts('"timestamp"')} AS "timestamp", source, conditions, trade_date, CAST(trade_hour AS BIGINT) AS trade_hour FROM s_good"""),
    "stream_totals": with_ctes("SELECT (SELECT count(*) FROM bronze) AS input_rows, (SELECT count(*) FROM s_good) AS stored_rows"),
    "stream_dedup": with_ctes("SELECT DISTINCT trade_id FROM bronze"),
    "stream_bronze": with_ctes(f"""SELECT trade_id, symbol, CAST(price AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS quantity,
        CAST(notional AS VARCHAR) AS notional, exchange, trade_type, {ISO_TEXT.format(c='"timestamp"')} AS "timestamp",
        {ISO_TEXT.format(c='ingested_at')} AS ingested_at, source, conditions
        FROM (SELECT * FROM {FEED_A} UNION ALL BY NAME
              SELECT * EXCLUDE (exchange_id), CAST(NULL AS VARCHAR) AS exchange, CAST(NULL AS VARCHAR) AS conditions FROM {FEED_B})"""),
    "dead_letter_scan": ORACLE["quality_dead_letter"],
    "materialized": with_ctes("""SELECT symbol, count(*) AS trades, kind FROM fact, (VALUES ('view'), ('table')) k(kind)
        GROUP BY symbol, kind"""),
})

ORACLE.update({
    "daily_summary_sql": ORACLE["daily_filtered"],
    "pipeline_stats_sql": ORACLE["pipeline_stats"],
    "hourly_volume_sql": ORACLE["hourly_volume"],
    "all_trades_sql": ORACLE["export_trades"],
    "symbol_performance_sql": with_ctes(f"SELECT * EXCLUDE (last_updated, activity_rank) FROM ({mart_perf_out('mart_perf')})"),
    "recent_trades_sql": with_ctes(f"""SELECT symbol, CAST(price AS DOUBLE) AS price, CAST(quantity AS DOUBLE) AS quantity,
        CAST(notional AS DOUBLE) AS notional, {ts('"timestamp"')} AS "timestamp", {d('trade_date')} AS trade_date, trade_hour,
        source, trade_id FROM (SELECT * FROM fact WHERE symbol = 'CLICK/USD' ORDER BY "timestamp" DESC, trade_id DESC LIMIT 25)"""),
    "export_performance": with_ctes(mart_perf_out("w_mart_perf")),
    "keyed_files": with_ctes("SELECT symbol, count(*) AS trades, 0 AS order_violations FROM fact GROUP BY symbol"),
    "mart_symbol_performance_rollup": ORACLE["mart_symbol_performance_wide"],
    "mart_daily_state": with_ctes(f"""SELECT {d('trade_date')} AS trade_date, symbol, count(*) AS n, {dbl('sum(notional)')} AS sum_notional,
        count(notional) AS n_notional, {dbl('sum(price)')} AS sum_price, count(price) AS n_price, {dbl('min(price)')} AS min_price,
        {dbl('max(price)')} AS max_price, round(avg(CAST(price AS DOUBLE)), 6) AS mean_price,
        round(var_pop(CAST(price AS DOUBLE)), 3) AS var_price, {ts('max(ingested_at)')} AS max_ingested_at
        FROM stg GROUP BY ALL"""),
    "mart_daily_joined": with_ctes(mart_daily_out("mart_daily")),
    "daily_ordered": with_ctes(f"SELECT *, row_number() OVER (ORDER BY trade_date, symbol) AS position FROM ({DAILY_OUT})"),
    "performance_ordered": with_ctes(f"""SELECT row_number() OVER (ORDER BY volume_rank, symbol) AS position, symbol,
        CAST(total_notional_usd AS DOUBLE) AS total_notional_usd, volume_rank FROM {PERF_W}"""),
    "asset_profile_one": ORACLE["asset_profile"].replace(f"FROM {PERF_W}", "FROM mart_perf WHERE symbol = 'CLICK/USD'"),
    "market_log": with_ctes(f"""SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS timestamp_utc, symbol,
        '$' || format('{{:,.4f}}', CAST(price AS DOUBLE)) AS price, CAST(quantity AS DOUBLE) AS qty,
        '$' || format('{{:,.2f}}', CAST(notional AS DOUBLE)) AS notional, printf('%02d:00', trade_hour) AS hour
        FROM {RECENT.format(n=20)}"""),
    "asset_log": with_ctes("""SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS timestamp_utc,
        '$' || format('{:,.4f}', CAST(price AS DOUBLE)) AS price, CAST(quantity AS DOUBLE) AS qty,
        '$' || format('{:,.2f}', CAST(notional AS DOUBLE)) AS notional, source
        FROM (SELECT * FROM fact WHERE symbol = 'CLICK/USD' ORDER BY "timestamp" DESC, trade_id DESC LIMIT 20)"""),
    "report_preview": with_ctes(f"""SELECT trade_id, symbol, '$' || format('{{:,.4f}}', CAST(price AS DOUBLE)) AS price,
        CAST(quantity AS DOUBLE) AS quantity, '$' || format('{{:,.2f}}', CAST(notional AS DOUBLE)) AS notional,
        strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM {RECENT.format(n=100)}"""),
    "portfolio_performance_flat": with_ctes(f"""SELECT symbol AS _id, symbol, display_name, asset_class, is_major_coin, total_trades,
        {dbl('total_notional_usd')} AS total_notional_usd, {dbl('avg_notional_per_trade')} AS avg_notional_per_trade,
        {dbl('all_time_low')} AS all_time_low, {dbl('all_time_high')} AS all_time_high, {dbl('avg_price')} AS avg_price,
        {dbl('price_stddev')} AS price_stddev, trading_days, {d('first_seen')} AS first_seen, {d('last_seen')} AS last_seen,
        volume_rank, activity_rank, '{DOC_SOURCE}' AS metadata_source, '{DOC_PIPELINE}' AS metadata_pipeline,
        {ts('last_updated')} AS metadata_last_updated, '{DOC_VERSION}' AS metadata_version FROM mart_perf"""),
})

ORACLE.update({
    "recent_trades_stored": ORACLE["recent_trades"],
    "recent_trades_stored_symbol": ORACLE["recent_trades_sql"].replace("'CLICK/USD'", "'VIEW/USD'").replace("LIMIT 25", "LIMIT 200"),
    "pipeline_stats_states": ORACLE["pipeline_stats"],
    "fact_positioned": with_ctes(f"""SELECT trade_id, {ts('"timestamp"')} AS "timestamp",
        row_number() OVER (ORDER BY "timestamp" DESC, trade_id DESC) AS position FROM fact"""),
    "fact_page": with_ctes(f"""SELECT * FROM (SELECT trade_id, {ts('"timestamp"')} AS "timestamp",
        row_number() OVER (ORDER BY "timestamp" DESC, trade_id DESC) AS position FROM fact) WHERE position BETWEEN 101 AND 150"""),
    "portfolio_upsert_buckets": f"SELECT * EXCLUDE (_action) FROM ({ORACLE['portfolio_upsert']})",
})

ORACLE.update({
    "zorder_scan": with_ctes(f"""SELECT {FACT_OUT} FROM fact WHERE symbol = 'CLICK/USD'
        AND "timestamp" >= TIMESTAMP '2024-01-10 06:00:00' AND "timestamp" < TIMESTAMP '2024-01-11 18:00:00'"""),
    "bronze_compacted": ORACLE["bronze_scan"],
    "mart_daily_corrected": with_ctes(f"""SELECT {d('trade_date')} AS trade_date, symbol, count(*) AS n, {dbl('sum(notional)')} AS sum_notional,
        count(notional) AS n_notional, {dbl('sum(quantity)')} AS sum_quantity, {dbl('sum(price)')} AS sum_price, count(price) AS n_price,
        {dbl('min(price)')} AS min_price, {dbl('max(price)')} AS max_price, {ts('min(ingested_at)')} AS first_ingested,
        {ts('max(ingested_at)')} AS max_ingested_at, {ts('min(traded_at)')} AS first_traded, {ts('max(traded_at)')} AS last_traded
        FROM stg GROUP BY ALL"""),
})

ORACLE.update({
    "stg_instruments_listed": with_ctes("""SELECT * FROM w_stg_inst
        WHERE symbol IN (SELECT symbol FROM w_stg GROUP BY symbol
                         HAVING max(trade_date) = (SELECT max(trade_date) FROM w_stg))"""),
    "bronze_required": with_ctes(f"""SELECT t.batch_date, t.batch_rows, CASE WHEN t.batch_rows = 0 THEN 'EmptyInputError' END AS error
        FROM (SELECT day AS batch_date, (SELECT count(*) FROM bronze WHERE strftime({parse_time('ingested_at')}, '%Y-%m-%d') = day) AS batch_rows
              FROM (SELECT unnest([strftime(newest, '%Y-%m-%d'), strftime(newest + INTERVAL 1 DAY, '%Y-%m-%d')]) AS day
                    FROM (SELECT max({parse_time('ingested_at')}) AS newest FROM bronze))) t"""),
    "silver_required": with_ctes("""SELECT c.missing, c.error, count(s.trade_id) AS n_rows
        FROM (VALUES ('', NULL), ('price', 'MissingColumnsError')) c(missing, error)
        LEFT JOIN s_good s ON c.error IS NULL GROUP BY ALL"""),
})
