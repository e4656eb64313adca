"""The same results in ANSI SQL over the same Parquet tables."""

from __future__ import annotations

from workload.feeds import RULE_HOLDS
from workload.queries import TEXT_CASES

# --- feeds as common table expressions --------------------------------------

EV = """ev AS (
  SELECT event_id, user_id, event_type, value, ts,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         epoch_us(ts) AS us,
         epoch_us(ts) // 60000000 AS minute
  FROM events)"""

P = EV + """, p AS (
  SELECT 'a' || user_id AS "assetId", 's' || user_id AS symbol,
         'Coin ' || user_id || '.' || k AS "coinName", 'usd' AS currency,
         CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS price,
         CAST(CASE WHEN k < 10 THEN NULL WHEN k = 50 THEN 0 ELSE k * 1000 END AS DECIMAL(38,18)) AS "marketCap",
         CAST(k + 1 AS DECIMAL(38,18)) AS "volume24h",
         'https://img.example/a' || user_id || '.png' AS "coinImage",
         us // 1000 AS "eventTimeMs", (us + 250000) // 1000 AS "sourceTsMs",
         (us + 1000000) // 1000 AS "createdAtMs",
         CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'r' ELSE 'u' END AS op,
         event_id AS lsn, 'market' AS "sourceDb", 'public' AS "sourceSchema", 'market_prices' AS "sourceTable",
         CAST(ts + INTERVAL 7 HOUR AS DATE) AS ingestion_date,
         strftime(ts + INTERVAL 7 HOUR, '%H') AS ingestion_hour,
         event_type, k
  FROM ev)"""

C = """c AS (
  SELECT 'a' || o_custkey AS "assetId", 's' || o_custkey AS symbol, 'Coin ' || o_custkey AS "coinName",
         'usd' AS currency,
         CAST(CAST(o_totalprice AS DECIMAL(20,4)) * 10 AS DECIMAL(38,18)) AS "marketCap",
         CAST(CAST(o_totalprice AS DECIMAL(20,4)) AS DECIMAL(38,18)) AS "circulatingSupply",
         CAST(CAST(o_totalprice AS DECIMAL(20,4)) * 2 AS DECIMAL(38,18)) AS "totalSupply",
         CASE WHEN o_orderpriority <> '1-URGENT'
              THEN CAST(CAST(o_totalprice AS DECIMAL(20,4)) * 3 AS DECIMAL(38,18)) END AS "maxSupply",
         epoch_us(o_orderdate) // 1000 AS "eventTimeMs", epoch_us(o_orderdate) // 1000 + 500 AS "sourceTsMs",
         epoch_us(o_orderdate) // 1000 + 1000 AS "createdAtMs",
         CASE WHEN o_orderpriority = '5-LOW' THEN 'd' WHEN o_orderstatus = 'F' THEN 'c'
              WHEN o_orderstatus = 'O' THEN 'u' ELSE 'r' END AS op,
         o_orderkey AS lsn, 'market' AS "sourceDb", 'public' AS "sourceSchema", 'market_caps' AS "sourceTable",
         CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) AS ingestion_date,
         strftime(o_orderdate + INTERVAL 7 HOUR, '%H') AS ingestion_hour
  FROM orders)"""


def text(*columns: str) -> str:
    return ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)


def when(millis: str) -> str:
    """Epoch milliseconds as text in whole seconds."""
    return f"strftime(make_timestamp(({millis}) // 1000 * 1000000), '%Y-%m-%d %H:%M:%S')"


def minute_text(minute: str) -> str:
    return f"strftime(make_timestamp(({minute}) * 60000000), '%Y-%m-%d %H:%M:%S')"


TAIL = 'op, lsn, "sourceDb", "sourceSchema", "sourceTable"'
CLOCKS = '"eventTimeMs", "sourceTsMs", "createdAtMs"'
P_BARE = f'"assetId", symbol, "coinName", currency, {text("price", "marketCap", "volume24h")}, "coinImage", {CLOCKS}, {TAIL}'
C_AMOUNTS = text("marketCap", "circulatingSupply", "totalSupply", "maxSupply")
C_BARE = f'"assetId", symbol, "coinName", currency, {C_AMOUNTS}, {CLOCKS}, {TAIL}'
STAMP = f'{text("ingestion_date")}, ingestion_hour'

P_PARSED = f"WITH {P} SELECT {P_BARE} FROM p"
P_BRONZE = f"WITH {P} SELECT {P_BARE}, {STAMP} FROM p"
C_PARSED = f"WITH {C} SELECT {C_BARE} FROM c"
C_BRONZE = f"WITH {C} SELECT {C_BARE}, {STAMP} FROM c"

P_DAILY = f"""WITH {P} SELECT {P_BARE}, CAST(CAST(make_timestamp("eventTimeMs" * 1000) AS DATE) AS VARCHAR) AS ingestion_date,
  '19' AS ingestion_hour FROM p"""
BATCHED = """CASE WHEN op IN ('d', 'u') THEN '2024-02-01' ELSE '2024-01-31' END AS ingestion_date,
  CASE WHEN op IN ('d', 'u') THEN '01' ELSE '22' END AS ingestion_hour"""

# --- faults -----------------------------------------------------------------

UNSUPPORTED = """k = 31 OR (event_type = 'signup' AND k < 5) OR (event_type = 'purchase' AND k BETWEEN 5 AND 9)
         OR (event_type = 'view' AND k BETWEEN 10 AND 14)"""
FAULTY = P + f""", f AS (
  SELECT *, CASE WHEN {UNSUPPORTED} THEN 'null or unsupported record'
                 WHEN k IN (22, 23) THEN 'price does not fit decimal(38,18)'
                 WHEN k = 33 THEN 'lsn is not a 64-bit integer'
                 WHEN k = 20 THEN 'assetId is missing'
                 WHEN k = 25 THEN 'eventTimeMs is missing' END AS reason,
         CASE WHEN k IN (21, 22, 23, 27, 28, 29, 31, 32) THEN NULL
              WHEN event_type = 'view' AND k BETWEEN 10 AND 14 THEN NULL
              WHEN k = 24 THEN CAST(1.5 AS DECIMAL(38,18)) WHEN k = 26 THEN CAST(1000 AS DECIMAL(38,18))
              ELSE price END AS read_price,
         CASE WHEN event_type = 'signup' AND k < 5 THEN NULL WHEN k = 32 THEN 'd' ELSE op END AS read_op,
         CASE WHEN k = 31 OR (event_type = 'purchase' AND k BETWEEN 5 AND 9) THEN NULL
              WHEN k IN (30, 33) THEN NULL ELSE lsn END AS source_lsn
  FROM p)"""

# --- reading text -----------------------------------------------------------

LONGS = {
    "0": "0", "-0": "0", "7": "7", "+7": "7", "-7": "-7", "007": "7",
    "9223372036854775807": "9223372036854775807", "-9223372036854775808": "-9223372036854775808",
}
AMOUNTS = {
    "0": "0", "-0": "0", "7": "7", "+7": "7", "-7": "-7", "007": "7",
    "9223372036854775807": "9223372036854775807", "9223372036854775808": "9223372036854775808",
    "-9223372036854775808": "-9223372036854775808", "1.5": "1.5", "1.": "1", ".5": "0.5", "1e3": "1000", "1E+3": "1000",
    "-1.25e-2": "-0.0125", "0e400": "0", "123.45": "123.45", "0.000000000000000001": "0.000000000000000001",
    "-987654321.123456789": "-987654321.123456789", "1.50000000000000000000": "1.5",
    "99999999999999999999": "99999999999999999999",
    "12345678901234567890.123456789012345678": "12345678901234567890.123456789012345678",
    "0.0000000000000000000": "0", "1e-18": "0.000000000000000001", "10e-19": "0.000000000000000001",
}
UNFIT = {
    "1e400", "0.0000000000000000001", "100000000000000000000", "1.2345678901234567891", "1e-19",
}
MILLIS = {
    "2024-01-02T03:04:05Z": 1704164645000, "2024-01-02T03:04:05+07:00": 1704139445000,
    "2024-01-02T03:04:05.123456Z": 1704164645123, "2024-01-02T03:04:05.9999Z": 1704164645999,
    "2024-01-02T03:04Z": 1704164640000, "2024-01-02t03:04:05z": 1704164645000,
    "1969-12-31T23:59:59.9995Z": -1, "2024-01-02T03:04:05-03": 1704175445000,
}


def cases(expected: dict[str, str], otherwise: str) -> str:
    """CASE over k giving the expected reading of each case text."""
    arms = " ".join(f"WHEN {i} THEN {expected.get(t, 'NULL')}" for i, t in enumerate(TEXT_CASES))
    return f"CASE k {arms} ELSE {otherwise} END"


def literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OWN = "CAST(value AS DECIMAL(18,2))"
READ_LONG = cases({t: f"CAST('{v}' AS BIGINT)" for t, v in LONGS.items()}, "NULL")
LONG_UNFIT = cases({t: "FALSE" if t in LONGS or t == "" else "TRUE" for t in TEXT_CASES}, "TRUE")
READ_AMOUNT = cases({t: f"CAST('{v}' AS DECIMAL(38,18))" for t, v in AMOUNTS.items()}, f"CAST({OWN} AS DECIMAL(38,18))")
AMOUNT_UNFIT = cases({t: "TRUE" if t in UNFIT else "FALSE" for t in TEXT_CASES}, "FALSE")
READ_TEXT = cases({t: literal(t) for t in TEXT_CASES if t}, f"CAST({OWN} AS VARCHAR)")
READ_TIME = cases({t: str(v) for t, v in MILLIS.items()}, "NULL")
FROM_BASE = "us - (1704067200000000 + 86400000000 * 15)"

# --- lines ------------------------------------------------------------------

L_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
L_OUT = """l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_quantity, 6) AS l_quantity,
  round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax,
  l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate"""


def ordered(columns: list[str], direction: str) -> str:
    return ", ".join(f"{c} {direction}" for c in columns)


# --- state, facts, overview -------------------------------------------------


def latest(source: str, amounts: list[str]) -> str:
    payload = ", ".join(f'"{c}"' for c in amounts)
    return f"""state AS (
  SELECT * FROM (
    SELECT "assetId", lsn, "eventTimeMs", symbol, "coinName", currency, {payload}, op,
           row_number() OVER (PARTITION BY "assetId" ORDER BY lsn DESC, "eventTimeMs" DESC) AS pos
    FROM {source}) WHERE pos = 1)"""


P_AMOUNTS = ["price", "marketCap", "volume24h"]
C_AMOUNT_LIST = ["marketCap", "circulatingSupply", "totalSupply", "maxSupply"]
STATE_HEAD = '"assetId", lsn, "eventTimeMs", symbol, "coinName", currency'
P_STATE = f"WITH {P}, {latest('p', P_AMOUNTS)} SELECT {STATE_HEAD}, {text(*P_AMOUNTS)}, op FROM state"
C_STATE = f"WITH {C}, {latest('c', C_AMOUNT_LIST)} SELECT {STATE_HEAD}, {text(*C_AMOUNT_LIST)}, op FROM state"

LOCAL = """make_timestamp("eventTimeMs" // 1000 * 1000000) + INTERVAL 7 HOUR"""
FACTS = f"""{P}, {C}, fp AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "assetId", "eventTimeMs" ORDER BY lsn DESC) AS pos
                 FROM p WHERE op <> 'd') WHERE pos = 1), fc AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "assetId", "eventTimeMs" ORDER BY lsn DESC) AS pos
                 FROM c WHERE op <> 'd') WHERE pos = 1)"""


def fact(source: str, amounts: dict[str, str]) -> str:
    shown = ", ".join(f'CAST("{a}" AS VARCHAR) AS {b}' for a, b in amounts.items())
    return f"""WITH {FACTS} SELECT "assetId" AS asset_id, "eventTimeMs" AS event_time_ms, {shown}, currency, lsn, op,
  {STAMP}, {when('"eventTimeMs"')} AS event_time,
  CAST(CAST({LOCAL} AS DATE) AS VARCHAR) AS event_date, strftime({LOCAL}, '%Y%m') AS event_month FROM {source}"""


LATEST = FACTS + """, lp AS (
  SELECT "assetId" AS asset_id, arg_max(price, "eventTimeMs") AS price, arg_max("volume24h", "eventTimeMs") AS volume_24h,
         arg_max("marketCap", "eventTimeMs") AS market_cap, max("eventTimeMs") AS last_ms
  FROM fp GROUP BY 1), lc AS (
  SELECT "assetId" AS asset_id, arg_max("circulatingSupply", "eventTimeMs") AS circulating_supply,
         arg_max("totalSupply", "eventTimeMs") AS total_supply, arg_max("maxSupply", "eventTimeMs") AS max_supply
  FROM fc GROUP BY 1), merged AS (
  SELECT lp.*, circulating_supply, total_supply, max_supply FROM lp LEFT JOIN lc USING (asset_id))"""
MERGED_OUT = f"""asset_id, {text("price", "volume_24h", "market_cap", "circulating_supply", "total_supply", "max_supply")},
  {when("last_ms")} AS last_event_time"""

# --- reconciliation ---------------------------------------------------------

DRIFT = P + """, kept AS (
  SELECT * REPLACE (CASE WHEN k = 17 AND op = 'u' THEN price + 1 ELSE price END AS price) FROM p
  WHERE NOT (k = 13 AND op = 'c') AND NOT (ingestion_date = DATE '2024-01-27' AND ingestion_hour = '05')),
lz AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE k = 19 AND op = 'r')"""


def row_sum(columns: list[str]) -> str:
    texts = [f'CAST("{c}" AS VARCHAR)' for c in columns]
    joined = " || ".join(f"coalesce(length({t}) || ':' || {t}, '-')" for t in texts)
    return f"sum(CAST(CAST('0x' || substr(md5({joined}), 1, 15) AS BIGINT) AS HUGEINT))"


P_SUM = row_sum(["assetId", "lsn", *P_AMOUNTS])
C_SUM = row_sum(["assetId", "lsn", *C_AMOUNT_LIST[:3]])


def side(source: str, sum_: str, by: str = "", where: str = "TRUE") -> str:
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"(SELECT {head}count(*) AS n, min(lsn) AS lo, max(lsn) AS hi, {sum_} AS h FROM {source} WHERE {where}{tail})"


FLAGS = """b.n AS bronze_count, l.n AS lz_count, b.n IS NOT DISTINCT FROM l.n AS row_count_match,
  b.lo AS bronze_min_lsn, l.lo AS lz_min_lsn, b.lo IS NOT DISTINCT FROM l.lo AS min_lsn_match,
  b.hi AS bronze_max_lsn, l.hi AS lz_max_lsn, b.hi IS NOT DISTINCT FROM l.hi AS max_lsn_match,
  b.h IS NOT DISTINCT FROM l.h AS checksum_match"""
SAME = """b.n IS NOT DISTINCT FROM l.n AND b.lo IS NOT DISTINCT FROM l.lo AND b.hi IS NOT DISTINCT FROM l.hi
  AND b.h IS NOT DISTINCT FROM l.h"""
# Prices as ingested every six hours, with one of them gone from landing; caps at the beginning of their month.
SIX_HOURS = "lpad(CAST(CAST(ingestion_hour AS INTEGER) // 6 * 6 AS VARCHAR), 2, '0') AS ingestion_hour"
SIX_HOURLY = DRIFT + f""", p6 AS (SELECT * REPLACE ({SIX_HOURS}) FROM p), lz6 AS (
  SELECT * FROM (SELECT * REPLACE ({SIX_HOURS}) FROM lz) WHERE NOT (ingestion_date = DATE '2024-01-28' AND ingestion_hour = '06'))"""
C_MONTHLY = C + """, cm AS (
  SELECT * REPLACE (CAST(date_trunc('month', make_timestamp("eventTimeMs" * 1000)) AS DATE) AS ingestion_date, '07' AS ingestion_hour) FROM c)"""
P_DAYS, C_DAYS = "ingestion_date >= DATE '2024-01-24'", "ingestion_date >= DATE '2001-07-26'"


def table_check(name: str, as_of: str, left: str, right: str) -> str:
    return f"""SELECT '{as_of}' AS checked_at, '{name}' AS table_name, {FLAGS},
  CASE WHEN {SAME} THEN 'HEALTHY' ELSE 'MISMATCH' END AS validation_status FROM {left} b CROSS JOIN {right} l"""


def partition_check(name: str, as_of: str, left: str, right: str) -> str:
    return f"""SELECT '{as_of}' AS checked_at, CAST(coalesce(b.ingestion_date, l.ingestion_date) AS VARCHAR) AS ingestion_date,
  coalesce(b.ingestion_hour, l.ingestion_hour) AS ingestion_hour, '{name}' AS table_name, {FLAGS},
  CASE WHEN b.n IS NULL OR l.n IS NULL THEN 'MISSING_PARTITION' WHEN {SAME} THEN 'HEALTHY' ELSE 'MISMATCH' END AS validation_status
  FROM {left} b FULL OUTER JOIN {right} l ON b.ingestion_date = l.ingestion_date AND b.ingestion_hour = l.ingestion_hour"""


PARTS = "ingestion_date, ingestion_hour"
VALIDATION = f"""v AS (
{table_check("market_prices", "2024-01-31 00:00:00", side("p", P_SUM, where=P_DAYS), side("lz", P_SUM, where=P_DAYS))}
UNION ALL
{table_check("market_caps", "2001-08-02 00:00:00", side("c", C_SUM, where=C_DAYS), side("c", C_SUM, where=C_DAYS))})"""

HEALTH = f"""{P}, {C}, newest AS (
  SELECT 'market_prices' AS table_name, max("eventTimeMs") AS ms FROM p WHERE op <> 'd'
  UNION ALL SELECT 'market_caps', max("eventTimeMs") FROM c WHERE op <> 'd'), health AS (
  SELECT table_name, ms, epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 60000000 - ms // 60000 AS minutes_lag FROM newest)"""
STATUS = """CASE WHEN minutes_lag IS NULL THEN 'empty' WHEN minutes_lag <= 10 THEN 'healthy'
  WHEN minutes_lag <= 30 THEN 'delayed' ELSE 'stale' END"""

# --- metric series ----------------------------------------------------------

OFFSETS = EV + """, counted AS (
  SELECT CASE WHEN event_type = 'error' THEN 'bronze.market_prices.dlq' ELSE 'cdc.public.' || event_type END AS topic,
         CASE WHEN k < 50 THEN 0 ELSE 1 END AS part,
         CASE WHEN event_type = 'error' AND ts >= TIMESTAMP '2024-01-15' THEN 1 ELSE 0 END AS era,
         minute, count(*) AS n FROM ev GROUP BY ALL), offsets AS (
  SELECT topic, part, minute, max(at_end) AS at_end FROM (
    SELECT topic, part, minute, sum(n) OVER (PARTITION BY topic, part, era ORDER BY minute) AS at_end FROM counted)
  GROUP BY ALL), grown AS (
  SELECT topic, part, minute,
         CASE WHEN lag(at_end) OVER w IS NULL THEN 0 WHEN at_end < lag(at_end) OVER w THEN at_end
              ELSE at_end - lag(at_end) OVER w END AS delta
  FROM offsets WINDOW w AS (PARTITION BY topic, part ORDER BY minute))"""

INCREASE = OFFSETS + """, dlq AS (
  SELECT minute, sum(delta) AS delta FROM grown WHERE regexp_full_match(topic, 'bronze\\..*\\.dlq') GROUP BY 1), increase AS (
  SELECT e.minute, CAST(sum(delta) AS BIGINT) AS increase
  FROM (SELECT unnest(generate_series(minute, minute + 9)) AS minute, delta FROM dlq) e
  WHERE e.minute <= (SELECT max(minute) FROM dlq) GROUP BY 1)"""

LAG = """span AS (SELECT unnest(generate_series(min(minute), max(minute))) AS minute FROM ev), grp AS (
  SELECT CASE WHEN event_type IN ('signup', 'purchase') THEN 'flink-bronze-market-prices'
              WHEN event_type IN ('click', 'view') THEN 'flink-bronze-market-caps'
              ELSE 'audit-flink-bronze-copy' END AS consumergroup, event_type, minute, value FROM ev), unread AS (
  SELECT consumergroup, event_type, minute, count(*) - count(*) FILTER (WHERE value < 40) AS n FROM grp GROUP BY ALL), behind AS (
  SELECT g.consumergroup, s.minute,
         sum(coalesce(u.n, 0)) OVER (PARTITION BY g.consumergroup, g.event_type ORDER BY s.minute) AS lag
  FROM (SELECT DISTINCT consumergroup, event_type FROM grp) g CROSS JOIN span s
  LEFT JOIN unread u ON u.consumergroup = g.consumergroup AND u.event_type = g.event_type AND u.minute = s.minute), lagged AS (
  SELECT minute, CAST(sum(lag) AS BIGINT) AS lag FROM behind
  WHERE regexp_full_match(consumergroup, 'flink-bronze-.*') GROUP BY 1)"""

CHECKS = """per AS (
  SELECT minute, max(CASE WHEN event_type <> 'error' THEN minute END) AS newest, max(CASE WHEN value > 40 THEN 1 ELSE 0 END) AS drift
  FROM ev GROUP BY 1), checks AS (
  SELECT s.minute, last_value(newest IGNORE NULLS) OVER w AS latest, last_value(drift IGNORE NULLS) OVER w AS drifted
  FROM span s LEFT JOIN per ON per.minute = s.minute
  WINDOW w AS (ORDER BY s.minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def held(source: str, every: int) -> str:
    """Alert states of (rule_uid, minute, value, threshold, hold) rows."""
    return f"""marked AS (
  SELECT *, coalesce(value > threshold, FALSE) AS breach FROM {source}), linked AS (
  SELECT *, breach AND NOT coalesce(lag(breach) OVER w AND minute - lag(minute) OVER w <= {every}, FALSE) AS starts
  FROM marked WINDOW w AS (PARTITION BY rule_uid ORDER BY minute)), runs AS (
  SELECT *, max(CASE WHEN starts THEN minute END) OVER (PARTITION BY rule_uid ORDER BY minute) AS since FROM linked)
SELECT {minute_text("minute")} AS ts, rule_uid, CAST(value AS DOUBLE) AS value,
  CASE WHEN breach THEN {minute_text("since")} END AS since,
  CASE WHEN NOT breach THEN 'normal' WHEN minute - since >= hold THEN 'firing' ELSE 'pending' END AS state FROM runs"""


RULES = ", ".join(f"('{uid}', {hold})" for uid, hold in RULE_HOLDS)

SQL: dict[str, str] = {
    "lz_scan": P_DAILY,
    "cdc_stream": P_BRONZE,
    "snapshot_then_stream": P_BRONZE,
    "cdc_route": f"""WITH {P}, {C} SELECT "sourceTable", op, count(*) AS n, CAST(sum(lsn) AS BIGINT) AS lsn_sum
        FROM (SELECT "sourceTable", op, lsn FROM p UNION ALL SELECT "sourceTable", op, lsn FROM c) GROUP BY 1, 2""",
    "api_page_explode": f"""WITH {EV}, a AS (
        SELECT 'a' || user_id AS asset_id, 's' || user_id AS symbol, 'Coin "' || k || '"' AS coin_name, 'usd' AS currency,
               CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS price,
               CAST(CASE WHEN k < 10 THEN NULL WHEN k = 50 THEN 0 ELSE k * 1000 END AS DECIMAL(38,18)) AS market_cap,
               CAST(k + 1 AS DECIMAL(38,18)) AS volume_24h, {when("us // 1000")} AS event_time,
               CAST(event_id AS DECIMAL(38,18)) AS supply FROM ev)
        SELECT asset_id, symbol, coin_name, currency, CAST(price AS VARCHAR) AS price, CAST(market_cap AS VARCHAR) AS market_cap,
               CAST(volume_24h AS VARCHAR) AS volume_24h, 'https://img.example/x.png' AS coin_image, event_time,
               '2024-01-31 00:00:00' AS source_ts, NULL AS circulating_supply, 'price' AS kind FROM a
        UNION ALL SELECT asset_id, symbol, coin_name, currency, NULL, CAST(market_cap AS VARCHAR), NULL, NULL, event_time,
               '2024-01-31 00:00:00', CAST(supply AS VARCHAR), 'cap' FROM a""",
    "api_page_rejects": f"""WITH {EV}, a AS (SELECT event_id // 10 AS page, k FROM ev), r AS (
        SELECT DISTINCT page, 'page is not a JSON array' AS reason FROM a WHERE page % 10 IN (3, 5)
        UNION ALL SELECT page, CASE k WHEN 77 THEN 'current_price is no decimal(38,18)' WHEN 12 THEN 'name is missing' END
        FROM a WHERE page % 10 NOT IN (3, 5))
        SELECT reason, count(*) AS n, CAST(sum(page) AS BIGINT) AS page_sum FROM r GROUP BY 1""",
    "bronze_scan": f"{P_BRONZE} WHERE p.ingestion_date >= DATE '2024-01-24'",
    "lz_file_inventory": f"""WITH {EV} SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS ingestion_date,
        '19' AS hour, TRUE AS held, TRUE AS filled FROM ev""",
    "cdc_parse_prices": P_PARSED,
    "cdc_parse_caps": C_PARSED,
    "bronze_prices": P_BRONZE,
    "bronze_caps": C_BRONZE,
    "cdc_validate": f"""WITH {FAULTY} SELECT reason AS reject_reason, count(*) AS n, count(read_price) AS priced,
        count(reason) AS recorded FROM f GROUP BY 1""",
    "dlq_split": f"""WITH {FAULTY}
        SELECT CASE WHEN k = 30 THEN 0 ELSE lsn END AS lsn, "assetId", CASE WHEN k <> 32 THEN symbol END AS symbol, read_op AS op,
               CAST(read_price AS VARCHAR) AS price, "eventTimeMs",
               CASE WHEN k = 32 THEN "eventTimeMs" + 500 ELSE "sourceTsMs" END AS "sourceTsMs",
               CASE WHEN k = 32 THEN "eventTimeMs" + 500 ELSE "createdAtMs" END AS "createdAtMs", NULL AS reason
        FROM f WHERE reason IS NULL
        UNION ALL SELECT source_lsn, NULL, NULL, CASE WHEN k <> 31 THEN read_op END, NULL, NULL, NULL, NULL, reason
        FROM f WHERE reason IS NOT NULL""",
    "dlq_format": f"""WITH {FAULTY} SELECT reason, k = 31 AS blank,
        CASE WHEN k = 31 OR read_op = 'd' OR (event_type = 'view' AND k BETWEEN 10 AND 14) THEN NULL
             WHEN k = 22 THEN '1.2345678901234567891' WHEN k = 23 THEN '123456789012345678901'
             ELSE CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) END AS price_text, count(*) AS n
        FROM f WHERE reason IS NOT NULL GROUP BY ALL""",
    "ingest_stamp": f"""WITH {P} SELECT lsn, "eventTimeMs", {STAMP} FROM p""",
    "epoch_to_local_time": f"""WITH {P} SELECT lsn, "eventTimeMs" // 1000 AS event_second,
        strftime({LOCAL}, '%Y-%m-%d %H:%M:%S') AS local_time FROM p""",
    "local_event_date": f"""WITH {P}, {C}, m AS (SELECT "eventTimeMs" FROM p UNION ALL SELECT "eventTimeMs" FROM c)
        SELECT CAST(CAST({LOCAL} AS DATE) AS VARCHAR) AS event_date, strftime({LOCAL}, '%Y%m') AS event_month, count(*) AS n
        FROM m GROUP BY 1, 2""",
    "text_or_null": f"WITH {EV} SELECT event_id, {READ_TEXT} AS text FROM ev",
    "long_or_null": f"WITH {EV} SELECT event_id, {READ_LONG} AS number, {LONG_UNFIT} AS unfit FROM ev",
    "decimal_or_null": f"WITH {EV} SELECT event_id, CAST({READ_AMOUNT} AS VARCHAR) AS amount FROM ev",
    "decimal_38_18_exact": f"WITH {EV} SELECT event_id, CAST({READ_AMOUNT} AS VARCHAR) AS amount, {AMOUNT_UNFIT} AS unfit FROM ev",
    "ts_to_millis": f"""WITH {EV} SELECT event_id, {READ_TIME} AS millis, 'iso' AS form FROM ev
        UNION ALL SELECT event_id, CASE WHEN {FROM_BASE} < 0 THEN -((-({FROM_BASE})) // 1000) ELSE ({FROM_BASE}) // 1000 END, 'micros' FROM ev""",
    "row_to_json": f"""WITH {P} SELECT lsn, "assetId" AS asset, "coinName" AS coin, CAST(price AS VARCHAR) AS price,
        CAST("marketCap" AS VARCHAR) AS cap, TRUE AS has_cap, TRUE AS has_updated, CAST(ingestion_date AS VARCHAR) AS day FROM p""",
    "not_deleted": f"""WITH {P} SELECT "assetId", count(*) FILTER (WHERE op <> 'd') AS events, arg_max(op, lsn) <> 'd' AS live
        FROM p GROUP BY 1 HAVING count(*) FILTER (WHERE op <> 'd') > 0""",
    "star_except": f"""WITH {C} SELECT "assetId", symbol, "coinName", currency, {C_AMOUNTS}, {CLOCKS}, op, lsn, "sourceTable",
        {STAMP} FROM c""",
    "confluent_header": f"""WITH {EV} SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS magic,
        CASE WHEN event_type <> 'error' AND k <> 7 THEN length(event_type) + 70000 END AS schema_id,
        CASE WHEN event_type <> 'error' AND k <> 7 THEN event_type END AS body, count(*) AS n FROM ev GROUP BY ALL""",
    "subject_set_check": f"""WITH {EV}, used AS (
        SELECT 'a' || user_id AS subject, event_type AS field, ts >= TIMESTAMP '2024-01-16' AS late,
               CASE WHEN max(k) >= 95 THEN 'decimal' ELSE 'int' END AS type FROM ev GROUP BY ALL), joined AS (
        SELECT subject, field, e.type AS expected_type, a.type AS actual_type
        FROM (SELECT * FROM used WHERE NOT late) e FULL OUTER JOIN (SELECT * FROM used WHERE late) a USING (subject, field))
        SELECT *, CASE WHEN actual_type IS NULL THEN 'missing' WHEN expected_type IS NULL THEN 'extra'
                       WHEN expected_type = actual_type THEN 'same' ELSE 'changed' END AS status,
               actual_type IS NULL OR (expected_type IS NOT NULL AND expected_type <> actual_type) AS failed FROM joined""",
    "insert_ignore": f"""WITH first AS (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, {ordered(L_REST, "ASC")}) AS pos
        FROM lineitem WHERE l_linestatus = 'O')
        SELECT {L_OUT} FROM first f WHERE pos = 1 AND NOT EXISTS (
          SELECT 1 FROM lineitem t WHERE t.l_linestatus = 'F' AND t.l_orderkey = f.l_orderkey AND t.l_linenumber = f.l_linenumber)""",
    "anti_existing": f"""SELECT {L_OUT} FROM lineitem f WHERE l_linestatus = 'O' AND NOT EXISTS (
          SELECT 1 FROM lineitem t WHERE t.l_linestatus = 'F' AND t.l_orderkey = f.l_orderkey AND t.l_linenumber = f.l_linenumber)""",
    "lz_sink": f"WITH {P} SELECT {P_BARE}, {BATCHED} FROM p",
    "bronze_sink": f"WITH {C} SELECT {C_BARE}, {BATCHED} FROM c",
    "kafka_sink": f'WITH {P} SELECT {P_BARE}, NULL AS "updatedAtMs", {BATCHED} FROM p',
    "fan_out": f"""WITH {FAULTY}, good AS (
          SELECT count(*) AS n, CAST(sum(CASE WHEN k = 30 THEN 0 ELSE lsn END) AS BIGINT) AS lsn_sum FROM f WHERE reason IS NULL)
        SELECT 'landing' AS target, * FROM good UNION ALL SELECT 'bronze', * FROM good UNION ALL SELECT 'topic', * FROM good
        UNION ALL SELECT 'dead_letters', count(*), CAST(sum(source_lsn) AS BIGINT) FROM f WHERE reason IS NOT NULL""",
    "constraint_check": """WITH counted AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem)
        SELECT CASE WHEN CAST(l_extendedprice AS DECIMAL(18,2)) >= 10000 THEN 'l_extendedprice exceeds numeric(6,2)'
                    WHEN CAST(l_quantity AS DECIMAL(18,2)) >= 100 THEN 'l_quantity exceeds numeric(4,2)'
                    WHEN copies > 1 THEN 'duplicate key (l_orderkey, l_linenumber)' END AS violation,
               count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM counted GROUP BY 1""",
    "retention": """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day FROM lineitem
        WHERE NOT (CAST(l_shipdate AS DATE) + INTERVAL 12 MONTH <= DATE '2001-07-01')""",
    "bronze_layout": P_BRONZE,
    "compact_days": f"WITH {C} SELECT {C_BARE}, {BATCHED} FROM c",
    "latest_state_prices": P_STATE,
    "latest_state_caps": C_STATE,
    "silver_prices": f"""WITH {P}, {latest("p", P_AMOUNTS)} SELECT "assetId" AS asset_id, symbol, "coinName" AS coin_name, currency,
        CAST(price AS VARCHAR) AS price, CAST("marketCap" AS VARCHAR) AS market_cap, CAST("volume24h" AS VARCHAR) AS volume_24h,
        "eventTimeMs" AS event_time_ms, {when('"eventTimeMs"')} AS event_time FROM state WHERE op <> 'd'""",
    "silver_caps": f"""WITH {C}, {latest("c", C_AMOUNT_LIST)} SELECT "assetId" AS asset_id, symbol, "coinName" AS coin_name, currency,
        CAST("marketCap" AS VARCHAR) AS market_cap, CAST("circulatingSupply" AS VARCHAR) AS circulating_supply,
        CAST("totalSupply" AS VARCHAR) AS total_supply, CAST("maxSupply" AS VARCHAR) AS max_supply,
        "eventTimeMs" AS event_time_ms, {when('"eventTimeMs"')} AS event_time FROM state WHERE op <> 'd'""",
    "state_merge": P_STATE,
    "latest_state_stream": P_STATE,
    "replacing_dedup": f"""SELECT {L_OUT} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {ordered(L_REST, "DESC")}) AS pos
        FROM lineitem) WHERE pos = 1""",
    "latest_nonnull_by_time": f"""WITH {C}, m AS (
        SELECT "assetId", arg_max("circulatingSupply", ("eventTimeMs", lsn)) AS "circulatingSupply",
               arg_max("totalSupply", ("eventTimeMs", lsn)) AS "totalSupply", arg_max("maxSupply", ("eventTimeMs", lsn)) AS "maxSupply"
        FROM c GROUP BY 1) SELECT "assetId", {text("circulatingSupply", "totalSupply", "maxSupply")} FROM m""",
    "basic_aggs": """SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_orderkey) AS min_key, max(l_orderkey) AS max_key,
        strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_ship,
        CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS VARCHAR) AS price_sum
        FROM lineitem GROUP BY 1, 2""",
    "count_if": """SELECT l_linenumber, count(*) FILTER (WHERE l_returnflag <> 'N') AS returned,
        count(*) FILTER (WHERE l_tax > 0.04) AS taxed FROM lineitem GROUP BY 1""",
    "table_checksum": f"""WITH l AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem)
        SELECT l_linestatus, count(*) AS "rows", CAST({row_sum(["l_orderkey", "l_linenumber", "l_returnflag", "price"])} AS VARCHAR) AS checksum,
        TRUE AS copy_agrees, count(*) FILTER (WHERE l_linenumber = 1) = 0 AS drift_agrees
        FROM l GROUP BY 1""",
    "left_equi": f"WITH {LATEST} SELECT {MERGED_OUT} FROM merged",
    "cross_1x1": f"""WITH {P}, {C} SELECT * FROM (SELECT count(*) AS p_count, min(lsn) AS p_min_lsn, max(lsn) AS p_max_lsn FROM p)
        CROSS JOIN (SELECT count(*) AS c_count, min(lsn) AS c_min_lsn, max(lsn) AS c_max_lsn FROM c)""",
    "full_outer_equi": """SELECT CAST(day AS VARCHAR) AS day, shipped, ordered
        FROM (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS shipped FROM lineitem GROUP BY 1)
        FULL OUTER JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS ordered FROM orders GROUP BY 1) USING (day)""",
    "global_total": f"""WITH {LATEST} SELECT asset_id, CAST(market_cap AS VARCHAR) AS market_cap,
        round(sum(CAST(market_cap AS DOUBLE)) OVER (), 6) AS whole FROM lp""",
    "market_cap_rank": f"""WITH {LATEST} SELECT asset_id, CAST(market_cap AS VARCHAR) AS market_cap,
        rank() OVER (ORDER BY lp.market_cap DESC NULLS LAST) AS market_cap_rank FROM lp""",
    "market_cap_rank_ranges": "SELECT event_id, value, rank() OVER (ORDER BY value DESC NULLS LAST) AS value_rank FROM events",
    "share_of_total": f"""WITH {LATEST} SELECT asset_id,
        round(CAST(volume_24h AS DOUBLE) / nullif(CAST(market_cap AS DOUBLE), 0), 6) AS liquidity FROM lp""",
    "top_k_assets": f"""WITH {LATEST} SELECT asset_id, CAST(market_cap AS VARCHAR) AS market_cap FROM lp
        ORDER BY lp.market_cap DESC NULLS LAST, asset_id LIMIT 10""",
    "counter_increase": f"WITH {INCREASE} SELECT {minute_text('minute')} AS ts, increase FROM increase",
    "counter_rate": f"""WITH {OFFSETS} SELECT topic, {minute_text("minute")} AS ts, round(sum(delta) / 60.0, 6) AS per_second
        FROM grown WHERE regexp_full_match(topic, 'cdc\\.public\\..*') GROUP BY 1, 2""",
    "alert_hold": f"""WITH {EV}, slots AS (
        SELECT minute // 30 * 30 AS minute, count(*) FILTER (WHERE event_type = 'error') AS errors FROM ev GROUP BY 1), src AS (
        SELECT minute, nullif(errors, 0) AS value, 1.0 AS threshold, rule_uid, hold
        FROM slots CROSS JOIN (VALUES {RULES}) AS r(rule_uid, hold)), {held("src", 30)}""",
    "union_all": f"""WITH {P}, {C} SELECT CAST(ingestion_date AS VARCHAR) AS day, count(*) AS n, 'market_prices' AS src FROM p GROUP BY 1
        UNION ALL SELECT CAST(ingestion_date AS VARCHAR), count(*), 'market_caps' FROM c GROUP BY 1""",
    "order_by": f"""WITH {P}, {C} SELECT CAST(ingestion_date AS VARCHAR) AS day, count(*) AS n, 'market_prices' AS src FROM p GROUP BY 1
        UNION ALL SELECT CAST(ingestion_date AS VARCHAR), count(*), 'market_caps' FROM c GROUP BY 1 ORDER BY 1, 3""",
    "dim_asset": f"""WITH {P} SELECT "assetId" AS asset_id, symbol, "coinName" AS coin_name, "coinImage" AS coin_image, currency,
        "eventTimeMs" AS last_event_time_ms, {when('"eventTimeMs"')} AS last_event_time, lsn AS last_lsn, op AS last_op
        FROM (SELECT *, row_number() OVER (PARTITION BY "assetId" ORDER BY lsn DESC) AS pos FROM p WHERE op <> 'd') WHERE pos = 1""",
    "fct_market_prices": fact("fp", {"price": "price", "marketCap": "market_cap", "volume24h": "volume_24h"}),
    "fct_market_caps": fact(
        "fc",
        {"marketCap": "market_cap", "circulatingSupply": "circulating_supply", "totalSupply": "total_supply", "maxSupply": "max_supply"},
    ),
    "market_overview": f"""WITH {LATEST}, totals AS (
        SELECT sum(CAST(market_cap AS DOUBLE)) AS caps, sum(CAST(circulating_supply AS DOUBLE)) AS supply FROM merged)
        SELECT {MERGED_OUT}, rank() OVER (ORDER BY merged.market_cap DESC NULLS LAST) AS market_cap_rank,
          round(CAST(merged.volume_24h AS DOUBLE) / nullif(CAST(merged.market_cap AS DOUBLE), 0), 6) AS liquid_indicator_24h,
          round(CAST(merged.market_cap AS DOUBLE) / nullif(caps, 0), 6) AS market_dominance,
          round(CAST(merged.circulating_supply AS DOUBLE) / nullif(supply, 0), 6) AS supply_dominance
        FROM merged CROSS JOIN totals""",
    "pipeline_health": f"""WITH {HEALTH} SELECT '2024-01-31 00:00:00' AS checked_at, table_name, {when("ms")} AS latest_event_time,
        minutes_lag, {STATUS} AS pipeline_status FROM health""",
    "pipeline_health_noted": f"""WITH {HEALTH} SELECT '2024-01-31 00:00:00' AS checked_at, table_name, {when("ms")} AS latest_event_time,
        minutes_lag, {STATUS} AS pipeline_status FROM health""",
    "pipeline_status": f"""WITH {HEALTH}, s AS (SELECT {STATUS} AS status FROM health)
        SELECT 'end' AS "at", CASE WHEN bool_or(status = 'stale') THEN 'STALE' WHEN bool_or(status = 'empty') THEN 'EMPTY'
               WHEN bool_or(status = 'delayed') THEN 'DELAYED' ELSE 'HEALTHY' END AS status FROM s
        UNION ALL SELECT 'start', CASE WHEN count(ms) < count(*) THEN 'EMPTY' ELSE 'HEALTHY' END FROM newest
        UNION ALL SELECT 'late', 'DELAYED' FROM events HAVING count(*) > 0""",
    "pipeline_lag_max": f"WITH {HEALTH} SELECT max(minutes_lag) AS minutes_lag FROM health",
    "sink_validation": f"WITH {DRIFT}, {C}, {VALIDATION} SELECT * FROM v",
    "sink_validation_partition": f"""WITH {DRIFT}, {C}
        {partition_check("market_prices", "2024-01-31 00:00:00", side("p", P_SUM, PARTS), side("lz", P_SUM, PARTS))}
        UNION ALL {partition_check("market_caps", "2001-08-02 00:00:00", side("c", C_SUM, PARTS), side("c", C_SUM, PARTS))}""",
    "sink_validation_logged": f"""WITH {SIX_HOURLY}, {C_MONTHLY}
        {table_check("market_prices", "2024-01-31 00:00:00", side("p6", P_SUM, where=P_DAYS), side("lz6", P_SUM, where=P_DAYS))}
        UNION ALL {table_check("market_caps", "2001-08-02 00:00:00", side("cm", C_SUM, where=C_DAYS), side("cm", C_SUM, where=C_DAYS))}""",
    "sink_validation_partition_logged": f"""WITH {SIX_HOURLY}, {C_MONTHLY}
        {partition_check("market_prices", "2024-01-31 00:00:00", side("p6", P_SUM, PARTS), side("lz6", P_SUM, PARTS))}
        UNION ALL {partition_check("market_caps", "2001-08-02 00:00:00", side("cm", C_SUM, PARTS), side("cm", C_SUM, PARTS))}""",
    "validation_failures": f"WITH {DRIFT}, {C}, {VALIDATION} SELECT count(*) FILTER (WHERE validation_status <> 'HEALTHY') AS failures FROM v",
    "validation_panel": f"""WITH {DRIFT}, {C}, {VALIDATION}
        SELECT table_name, bronze_count, lz_count, row_count_match, checksum_match, validation_status FROM v""",
    "bronze_insert_rate": f"""WITH {P}, {C} SELECT {minute_text('"eventTimeMs" // 60000')} AS t, count(*) AS "rows", 'market_prices' AS src
        FROM p GROUP BY 1 UNION ALL SELECT {minute_text('"eventTimeMs" // 60000')}, count(*), 'market_caps' FROM c GROUP BY 1""",
    "row_counts": f"""WITH {FACTS} SELECT 'bronze.market_prices' AS table_name, count(*) AS "rows" FROM p
        UNION ALL SELECT 'bronze.market_caps', count(*) FROM c
        UNION ALL SELECT 'gold.fct_market_prices', count(*) FROM fp UNION ALL SELECT 'gold.fct_market_caps', count(*) FROM fc""",
    "consumer_lag": f"WITH {EV}, {LAG} SELECT {minute_text('minute')} AS ts, lag FROM lagged",
    "checkpoint_duration": f"""WITH {EV} SELECT event_type AS job_name, CAST(round(arg_max(value, us) * 100) AS BIGINT) AS last_ms,
        CAST(max(round(value * 100)) AS BIGINT) AS max_ms FROM ev GROUP BY 1""",
    "checkpoint_duration_max": f"""WITH {EV} SELECT max(last_ms) AS max_last_ms FROM (
        SELECT CAST(round(arg_max(value, us) * 100) AS BIGINT) AS last_ms FROM ev GROUP BY event_type)""",
    "alerts": f"""WITH {INCREASE}, {LAG}, {CHECKS}, src AS (
        SELECT 'pipeline-lag-stale' AS rule_uid, minute, CAST(minute - latest AS DOUBLE) AS value, 30.0 AS threshold, 5 AS hold FROM checks
        UNION ALL SELECT 'sink-validation-mismatch', minute, CASE WHEN drifted = 1 THEN 1 ELSE 0 END, 0.0, 10 FROM checks
        UNION ALL SELECT 'dlq-records', minute, increase, 0.0, 0 FROM increase
        UNION ALL SELECT 'consumer-lag', minute, lag, 1000.0, 10 FROM lagged), {held("src", 1)}""",
}
SQL["alerts_carried"] = SQL["alerts"]
