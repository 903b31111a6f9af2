"""SQL twins of the queries, for DuckDB over the same tables."""

from __future__ import annotations

TRADES = """raw AS (
  SELECT event_id AS trade_id, ts, CASE WHEN user_id % 2 = 0 THEN 'BTC-USDT-SWAP' ELSE 'ETH-USDT-SWAP' END AS inst_id,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'buy' WHEN event_type IN ('view', 'error') THEN 'sell' ELSE 'other' END AS side,
    CAST(CAST(value AS DECIMAL(16,4)) + 100 AS DECIMAL(16,2)) AS price, CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS qty,
    CAST(CASE WHEN user_id % 2 = 0 THEN 0.01 ELSE 0.1 END AS DECIMAL(4,2)) AS ct_val FROM events),
trades AS (SELECT *, CAST(CAST(CAST(qty AS DECIMAL(18,0)) * ct_val AS DECIMAL(16,2)) * price AS DECIMAL(20,4)) AS n FROM raw),
t AS (SELECT *, CAST(n * price AS DECIMAL(30,6)) AS pv FROM trades)"""
FRAMES = "frames(timeframe, step) AS (VALUES ('1m', INTERVAL 1 MINUTE), ('5m', INTERVAL 5 MINUTE), ('15m', INTERVAL 15 MINUTE), ('1h', INTERVAL 1 HOUR), ('4h', INTERVAL 4 HOUR))"
CANDLES = f"""{TRADES}, {FRAMES},
candles AS (SELECT inst_id, timeframe, time_bucket(step, ts, TIMESTAMP '2000-01-01') AS window_start, time_bucket(step, ts, TIMESTAMP '2000-01-01') + step AS window_end,
  first(price ORDER BY ts, trade_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, trade_id) AS close, sum(qty) AS volume, count(*) AS trade_count
  FROM t CROSS JOIN frames GROUP BY ALL)"""
MONEY = lambda x: f"CAST(CAST({x} AS DECIMAL(22,4)) AS DOUBLE)"
CANDLE_ROW = "inst_id, timeframe, window_start, window_end, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close, CAST(volume AS DOUBLE) AS volume, trade_count"


def candles(where: str) -> str:
    return f"WITH {CANDLES} SELECT {CANDLE_ROW} FROM candles WHERE {where}"


def bars(step: str, whale: int) -> str:
    return f"""bars AS (SELECT inst_id, time_bucket(INTERVAL {step}, ts, TIMESTAMP '2000-01-01') AS window_start, first(price ORDER BY ts, trade_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, trade_id) AS close,
  sum(n) AS total_volume, coalesce(sum(n) FILTER (side = 'buy'), 0) AS buy_volume, coalesce(sum(n) FILTER (side <> 'buy'), 0) AS sell_volume,
  coalesce(sum(n) FILTER (n >= {whale}), 0) AS whale_volume, count(*) FILTER (n >= {whale}) AS whale_count, count(*) AS trade_count FROM t GROUP BY ALL)"""


VOLUME_BARS = f"""WITH {TRADES}, {bars("1 HOUR", 1000)}
SELECT inst_id, window_start, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, CAST(close AS DOUBLE) AS close,
  {MONEY("total_volume")} AS total_volume, {MONEY("buy_volume")} AS buy_volume, {MONEY("sell_volume")} AS sell_volume, {MONEY("whale_volume")} AS whale_volume, whale_count, trade_count,
  {MONEY("buy_volume - sell_volume")} AS delta, round(CAST((close - open) * 100 AS DOUBLE) / CAST(open AS DOUBLE), 6) AS price_change_pct FROM bars"""

CVD = f"""{TRADES}, m AS (SELECT inst_id, date_trunc('minute', ts) AS window_start, sum(CASE side WHEN 'buy' THEN n ELSE -n END) AS d FROM t WHERE side IN ('buy', 'sell') GROUP BY ALL),
cvd AS (SELECT *, sum(d) OVER (PARTITION BY inst_id ORDER BY window_start) AS v FROM m)"""

VWAP = f"""WITH {TRADES},
w AS (SELECT *, date_trunc('minute', ts) AS window_start, row_number() OVER (PARTITION BY inst_id, date_trunc('minute', ts) ORDER BY ts, trade_id) AS rn,
  sum(pv) OVER s AS sp, sum(n) OVER s AS sn, count(*) OVER s AS sc, sum(pv) OVER h AS hp, sum(n) OVER h AS hn, count(*) OVER h AS hc, sum(pv) OVER f AS fp, sum(n) OVER f AS fn, count(*) OVER f AS fc,
  sum(pv) FILTER (ts >= TIMESTAMP '2024-01-10') OVER a AS ap, sum(n) FILTER (ts >= TIMESTAMP '2024-01-10') OVER a AS an, count(*) FILTER (ts >= TIMESTAMP '2024-01-10') OVER a AS ac
  FROM t WINDOW s AS (PARTITION BY inst_id, date_trunc('day', ts) ORDER BY ts), a AS (PARTITION BY inst_id ORDER BY ts),
  h AS (PARTITION BY inst_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW), f AS (PARTITION BY inst_id ORDER BY ts RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW))
SELECT inst_id, window_start, round(CAST(sp AS DOUBLE) / CAST(sn AS DOUBLE), 6) AS vwap_session, sc AS trade_count_session, round(CAST(hp AS DOUBLE) / CAST(hn AS DOUBLE), 6) AS vwap_1h, hc AS trade_count_1h,
  round(CAST(fp AS DOUBLE) / CAST(fn AS DOUBLE), 6) AS vwap_4h, fc AS trade_count_4h, round(CAST(ap AS DOUBLE) / CAST(an AS DOUBLE), 6) AS vwap_anchored, ac AS trade_count_anchored FROM w WHERE rn = 1"""

# volumes are compared as integers of 1/10000; e2 is twice the median, d4 four times the median deviation
SIGNALS_CTE = f"""{TRADES}, {bars("1 HOUR", 1000)},
i AS (SELECT *, CAST(total_volume * 10000 AS BIGINT) AS v, (close - open) * 100 AS up, buy_volume - sell_volume AS delta FROM bars),
h AS (SELECT *, list_sort(coalesce(list(v) OVER (PARTITION BY inst_id ORDER BY window_start ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING), [])) AS l FROM i),
e AS (SELECT *, len(l) AS c, l[(len(l) + 1) // 2] + l[len(l) // 2 + 1] AS e2, l[len(l) // 2 + 1] AS upper FROM h),
g AS (SELECT *, list_sort(list_transform(l, lambda x: abs(2 * x - e2))) AS dl FROM e),
s AS (SELECT *, dl[(c + 1) // 2] + dl[c // 2 + 1] AS d4, CAST(up AS DOUBLE) / CAST(open AS DOUBLE) AS pct FROM g),
signals AS (SELECT *, CASE WHEN c = 0 OR e2 = 0 THEN 'T2' WHEN v > e2 THEN 'T4' WHEN 2 * v > e2 THEN 'T3' WHEN 4 * v > e2 THEN 'T2' ELSE 'T1' END AS volume_tier,
  CASE WHEN c >= 3 AND d4 <> 0 THEN round(0.6745 * (2 * v - e2) * 2 / d4, 6) END AS modified_z_score, CASE WHEN c >= 3 AND d4 <> 0 THEN 0.6745 * (2 * v - e2) * 2 / d4 END AS z,
  coalesce(c > 0 AND upper <> 0 AND abs(pct) <= 0.1 AND v > 2 * upper, false) AS absorption, sign(up) * sign(delta) < 0 AS divergence FROM s)"""
SIGNALS = f"""WITH {SIGNALS_CTE} SELECT inst_id, window_start, {MONEY("total_volume")} AS total_volume, volume_tier, round(e2 / 20000.0, 5) AS median_volume, modified_z_score,
  coalesce(abs(z) > 3.5, false) AS volume_anomaly, absorption, divergence FROM signals"""

WICKS_CTE = f"""{CANDLES},
wicks AS (SELECT inst_id, timeframe, window_end AS created, abs(close - open) AS body_size, 'high' AS wick_type, high AS price, high - greatest(open, close) AS wick_size FROM candles WHERE high > greatest(open, close)
  UNION ALL SELECT inst_id, timeframe, window_end, abs(close - open), 'low', low, least(open, close) - low FROM candles WHERE low < least(open, close)),
w AS (SELECT *, inst_id || '|' || timeframe || '|' || strftime(created, '%Y-%m-%dT%H:%M:%SZ') || '|' || wick_type AS event_id FROM wicks)"""
STATES_CTE = f"""{WICKS_CTE},
hit AS (SELECT w.event_id, min(c.window_end) AS touch_ts FROM w JOIN candles c ON c.inst_id = w.inst_id AND c.timeframe = w.timeframe AND c.window_end > w.created AND c.window_end < w.created + INTERVAL 168 HOUR
  AND CASE w.wick_type WHEN 'high' THEN c.high >= w.price ELSE c.low <= w.price END WHERE w.timeframe IN ('1h', '4h') GROUP BY 1),
ends AS (SELECT inst_id, timeframe, max(window_end) AS as_of FROM candles GROUP BY ALL),
joined AS (SELECT w.*, ends.as_of, hit.touch_ts, c.open AS o, c.close AS c, CASE w.wick_type WHEN 'high' THEN c.high ELSE c.low END AS reach, CASE WHEN w.inst_id = 'BTC-USDT-SWAP' THEN 0.1 ELSE 0.01 END AS tick
  FROM w JOIN ends USING (inst_id, timeframe) LEFT JOIN hit USING (event_id) LEFT JOIN candles c ON c.inst_id = w.inst_id AND c.timeframe = w.timeframe AND c.window_end = hit.touch_ts WHERE w.timeframe IN ('1h', '4h')),
states AS (SELECT *, CASE WHEN touch_ts IS NOT NULL THEN 'touched' WHEN as_of >= created + INTERVAL 168 HOUR THEN 'expired' ELSE 'untouched' END AS status,
  CAST(floor(abs(reach - price) / tick + 1e-9) AS BIGINT) AS ticks, least(o, c) <= price AND price <= greatest(o, c) AS body FROM joined)"""
WICKS = f"WITH {WICKS_CTE} SELECT inst_id, timeframe, event_id, wick_type, CAST(price AS DOUBLE) AS price, CAST(wick_size AS DOUBLE) AS wick_size, CAST(body_size AS DOUBLE) AS body_size, created FROM w WHERE timeframe = '1h'"
STATES = f"""WITH {STATES_CTE} SELECT inst_id, timeframe, event_id, wick_type, CAST(price AS DOUBLE) AS price, created, status, touch_ts, body AS touch_by_body, CASE WHEN touch_ts IS NOT NULL THEN CASE WHEN body THEN 'both' ELSE 'wick' END END AS touch_class,
  ticks AS tip_distance_ticks, CASE WHEN ticks = 0 THEN 'EXACT' WHEN ticks <= 1 THEN 'NEAR' WHEN ticks <= 3 THEN 'CLOSE' WHEN ticks IS NOT NULL THEN 'TOUCHED' END AS signal_strength,
  CAST(date_diff('minute', created, touch_ts) AS BIGINT) AS touch_age_minutes FROM states"""
NEIGHBOURS = f"""WITH {STATES_CTE} SELECT event_id, count(*) OVER r - 1 AS nearby, CAST(coalesce(sum(CAST(status = 'touched' AS INTEGER)) OVER r, 0) - CAST(status = 'touched' AS INTEGER) AS BIGINT) AS nearby_touched FROM states
  WINDOW r AS (PARTITION BY inst_id, timeframe ORDER BY created RANGE BETWEEN INTERVAL 600 MINUTE PRECEDING AND INTERVAL 600 MINUTE FOLLOWING)"""
HIDDEN = f"""SELECT event_id, nearby_touched, CASE WHEN nearby_touched >= 6 THEN 'VERY_HIGH' ELSE 'HIGH' END AS confidence FROM ({NEIGHBOURS.replace("SELECT event_id,", "SELECT event_id, status, created,", 1)})
  WHERE status = 'untouched' AND created BETWEEN TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 10000 MINUTE AND TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 20 MINUTE AND nearby_touched >= 4"""
LOG = f"""WITH {STATES_CTE} SELECT status, timeframe, count(*) AS n FROM states GROUP BY ALL"""


def book(mid: int) -> str:
    return f"""lv AS (SELECT l_orderkey AS seq, CASE WHEN l_returnflag = 'R' THEN 'bid' WHEN l_returnflag = 'A' THEN 'ask' WHEN l_linestatus = 'O' THEN 'bid' ELSE 'ask' END AS side,
  CAST(CAST(l_discount AS DECIMAL(6,4)) * {mid // 2} AS DECIMAL(12,4)) AS off, CAST(l_quantity AS DECIMAL(10,2)) AS qty FROM lineitem),
levels AS (SELECT *, CAST(CASE side WHEN 'bid' THEN {mid} - off ELSE {mid} + off END AS DECIMAL(12,4)) AS price, CASE WHEN seq % 2 = 0 THEN 'BTC-USDT-SWAP' ELSE 'ETH-USDT-SWAP' END AS inst_id,
  CASE WHEN off * 10000 <= {mid} * 10 THEN 0 WHEN off * 10000 <= {mid} * 25 THEN 1 WHEN off * 10000 <= {mid} * 50 THEN 2 WHEN off * 10000 <= {mid} * 100 THEN 3 WHEN off * 10000 <= {mid} * 200 THEN 4 WHEN off * 10000 <= {mid} * 500 THEN 5 END AS band FROM lv),
snaps AS (SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 2 = 0 THEN 'BTC-USDT-SWAP' ELSE 'ETH-USDT-SWAP' END AS inst_id, TIMESTAMP '2024-01-01' + o_orderkey * INTERVAL 2 SECOND AS ts, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 10 END AS ct FROM orders),
cells AS (SELECT s.seq, s.inst_id, s.ts, x.side, y.band, s.ct FROM snaps s CROSS JOIN (VALUES ('bid'), ('ask')) x(side) CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) y(band)),
bands AS (SELECT c.inst_id, c.ts, c.seq, c.side, c.band, coalesce(CAST(CAST(sum(l.qty * CAST(l.price AS DECIMAL(12,4))) * c.ct AS DECIMAL(24,6)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(30,8)), 0) AS n, coalesce(CAST(CAST(sum(l.qty) * c.ct AS DECIMAL(20,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(24,4)), 0) AS b
  FROM cells c LEFT JOIN levels l ON l.seq = c.seq AND l.side = c.side AND l.band = c.band GROUP BY c.inst_id, c.ts, c.seq, c.side, c.band, c.ct)"""


BANDS = f"WITH {book(1000)} SELECT inst_id, ts, side, band, round(CAST(n AS DOUBLE), 4) AS notional, round(CAST(b AS DOUBLE), 4) AS base FROM bands"
TOP_CTE = f"""{book(1000)}, best AS (SELECT seq, side, first(CAST(price AS DOUBLE) ORDER BY off, qty DESC) AS p, first(CAST(qty AS DOUBLE) ORDER BY off, qty DESC) AS q FROM levels GROUP BY ALL),
b AS (SELECT s.inst_id, s.ts, coalesce(x.p, 0) AS pb, coalesce(x.q, 0) AS vb, coalesce(y.p, 0) AS pa, coalesce(y.q, 0) AS va FROM snaps s LEFT JOIN best x ON x.seq = s.seq AND x.side = 'bid' LEFT JOIN best y ON y.seq = s.seq AND y.side = 'ask')"""
TOP = f"""WITH {TOP_CTE}
SELECT inst_id, ts, pb AS best_bid, pa AS best_ask, CASE WHEN vb + va = 0 THEN 0.0 ELSE round_even(round((vb - va) / (vb + va) * 10000, 8), 0) / 10000 END AS obi, round(CASE WHEN vb + va = 0 THEN (pb + pa) / 2 ELSE (vb * pa + va * pb) / (vb + va) END, 6) AS micro_price FROM b"""
IMBALANCE = f"""WITH {book(1000)}, p AS (SELECT inst_id, ts, band, CAST(sum(n) FILTER (side = 'bid') AS DOUBLE) AS b, CAST(sum(n) FILTER (side = 'ask') AS DOUBLE) AS a FROM bands GROUP BY ALL)
SELECT inst_id, ts, band, CASE WHEN a + b = 0 THEN 0.0 ELSE round_even(round((b - a) / (b + a) * 100, 8), 0) / 100 END AS imbalance FROM p"""
CHANGES = f"""WITH {book(1000)}, d AS (SELECT *, n - lag(n, 1, 0) OVER w AS delta, lag(n, 1, 0) OVER w AS before FROM bands WINDOW w AS (PARTITION BY inst_id, side, band ORDER BY ts))
SELECT inst_id, ts, side, band, round(CAST(delta AS DOUBLE), 4) AS delta, abs(delta) > 500 OR (before > 0 AND abs(CAST(delta AS DOUBLE)) > 0.1 * CAST(before AS DOUBLE)) AS significant FROM d"""
DEPTH = f"""WITH {book(1000)}, i AS (SELECT seq, side, CAST(qty AS DOUBLE) * exp(-0.1 * row_number() OVER (PARTITION BY seq, side ORDER BY off, qty DESC)) AS v FROM levels),
x AS (SELECT s.inst_id, s.ts, coalesce(sum(v) FILTER (side = 'bid'), 0) AS b, coalesce(sum(v) FILTER (side = 'ask'), 0) AS a FROM snaps s LEFT JOIN i ON i.seq = s.seq GROUP BY ALL)
SELECT inst_id, ts, CASE WHEN a + b = 0 THEN 0.0 ELSE round((b - a) / (b + a), 6) END AS depth_obi FROM x"""

AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
CONFLUENCE_WALLS = f"""WITH {STATES_CTE}, {SIGNALS_CTE.replace(TRADES + ", ", "", 1)}, {CVD.replace(TRADES + ", ", "", 1)}, {book(300)},
lv1 AS (SELECT inst_id, arg_max(volume_tier, window_start) AS volume_tier, arg_max(absorption, window_start) AS absorption FROM signals WHERE window_start <= {AS_OF} GROUP BY 1),
lc AS (SELECT inst_id, arg_max(d, window_start) AS cvd_delta FROM cvd WHERE window_start <= {AS_OF} GROUP BY 1),
wm AS (SELECT *, epoch_us(ts) AS us, n >= 1 AS enough FROM bands),
wg AS (SELECT *, count(*) FILTER (NOT enough) OVER (PARTITION BY inst_id, side, band ORDER BY ts) AS streak FROM wm),
wf AS (SELECT *, row_number() OVER w AS i, first_value(us) OVER w AS born FROM wg WHERE enough WINDOW w AS (PARTITION BY inst_id, side, band, streak ORDER BY ts)),
wa AS (SELECT inst_id, side, band, ts, (us - (born - born % 1000000)) // 1000000 AS age FROM wf WHERE i > 1 AND us - (born - born % 1000000) BETWEEN 30000000 AND 200000000000),
lb AS (SELECT b.inst_id, b.side, b.band, arg_max(n, ts) AS n100, arg_max(coalesce(age, -1), ts) AS age FROM bands b LEFT JOIN wa USING (inst_id, side, band, ts) GROUP BY ALL),
im AS (SELECT inst_id, band, CAST(sum(n100) FILTER (side = 'bid') AS DOUBLE) AS b, CAST(sum(n100) FILTER (side = 'ask') AS DOUBLE) AS a FROM lb GROUP BY ALL),
vs AS (SELECT inst_id, arg_max(v, window_start) AS vw FROM (SELECT inst_id, date_trunc('minute', ts) AS window_start, row_number() OVER (PARTITION BY inst_id, date_trunc('minute', ts) ORDER BY ts) AS rn,
  round(CAST(sum(pv) OVER s AS DOUBLE) / CAST(sum(n) OVER s AS DOUBLE), 6) AS v FROM t WINDOW s AS (PARTITION BY inst_id, date_trunc('day', ts) ORDER BY ts)) WHERE rn = 1 AND window_start <= {AS_OF} GROUP BY 1),
u AS (SELECT st.*, CASE WHEN abs(price - 300) * 10000 <= 3000 THEN 0 WHEN abs(price - 300) * 10000 <= 7500 THEN 1 WHEN abs(price - 300) * 10000 <= 15000 THEN 2 WHEN abs(price - 300) * 10000 <= 30000 THEN 3 WHEN abs(price - 300) * 10000 <= 60000 THEN 4 WHEN abs(price - 300) * 10000 <= 150000 THEN 5 END AS band
  FROM states st WHERE status = 'untouched' AND created <= {AS_OF} AND created >= {AS_OF} - INTERVAL 20000 MINUTE),
layer AS (SELECT u.*, volume_tier, absorption, cvd_delta, vw, lb.n100, lb.age, CASE WHEN im.a + im.b > 0 THEN abs(round_even(round((im.b - im.a) / (im.b + im.a) * 100, 8), 0) / 100) END AS skew
  FROM u LEFT JOIN lv1 USING (inst_id) LEFT JOIN lc USING (inst_id) LEFT JOIN vs USING (inst_id) LEFT JOIN im ON im.inst_id = u.inst_id AND im.band = u.band
  LEFT JOIN lb ON lb.inst_id = u.inst_id AND lb.band = u.band AND lb.side = CASE u.wick_type WHEN 'high' THEN 'ask' ELSE 'bid' END),
named AS (SELECT *, unnest([{{'p': 20, 'l': 'WICK'}}, CASE WHEN volume_tier = 'T4' THEN {{'p': 15, 'l': 'VOL_T4'}} END, CASE WHEN absorption THEN {{'p': 15, 'l': 'ABSORPTION'}} END, CASE WHEN n100 > 50 THEN {{'p': 15, 'l': 'WALL_' || format('{{:.1f}}', round_even(CAST(n100 AS DOUBLE) / 1000000, 1)) || 'M'}} END,
  CASE WHEN skew > 0.7 THEN {{'p': 10, 'l': 'IMB_' || format('{{:.2f}}', skew)}} END, CASE WHEN age > 0 AND age < 200000 THEN {{'p': 10, 'l': 'YOUNG_' || age || 's'}} END,
  CASE WHEN (wick_type = 'high' AND cvd_delta < 0) OR (wick_type = 'low' AND cvd_delta > 0) THEN {{'p': 10, 'l': 'CVD_ALIGNED'}} END, CASE WHEN abs(CAST(price AS DOUBLE) - vw) <= vw * 0.5 / 100 THEN {{'p': 5, 'l': 'VWAP_SESSION'}} END]) AS x, generate_subscripts(range(8), 1) AS o FROM layer)
SELECT inst_id, event_id, CAST(sum(x.p) AS INTEGER) AS score, string_agg(x.l, ',' ORDER BY o) AS signals, CASE wick_type WHEN 'high' THEN 'SHORT' ELSE 'LONG' END AS direction, CAST(price AS DOUBLE) AS entry_price FROM named WHERE x IS NOT NULL GROUP BY inst_id, event_id, wick_type, price"""
CONFLUENCE = CONFLUENCE_WALLS.replace("age > 0 AND age < 200000", "false")
HEALTH = f"""WITH {CVD}, {FRAMES}, parts AS (
  SELECT 'trades' AS component, max(ts) AS last, count(*) AS n_rows FROM t UNION ALL SELECT 'cvd', max(window_start), count(*) FROM cvd UNION ALL SELECT 'spot', max(ts), count(*) FROM t WHERE inst_id = 'none'),
s AS (SELECT component, CASE WHEN last IS NULL THEN 'MISSING' WHEN CAST(trunc(epoch(TIMESTAMP '2024-01-31 00:10:00' - last) / 60) AS BIGINT) < 15 THEN 'FRESH' ELSE 'STALE' END AS status, CAST(trunc(epoch(TIMESTAMP '2024-01-31 00:10:00' - last) / 60) AS BIGINT) AS age_minutes, n_rows FROM parts)
SELECT * FROM s UNION ALL SELECT 'overall', CASE WHEN count(*) FILTER (status = 'MISSING') > 0 THEN 'DEGRADED' WHEN count(*) FILTER (status = 'STALE') > 0 THEN 'STALE' ELSE 'HEALTHY' END, min(age_minutes), CAST(sum(n_rows) AS BIGINT) FROM s"""


def counted(words: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}\\p{{M}}_]+'), lambda x: x IN ({listed})))"


TAGGED = f"""tagged AS (SELECT conv_id, turn, text, {counted(("der", "die", "house"))} AS h, {counted(("the", "over", "with"))} AS m, {counted(("la", "de"))} AS v, {counted(("is", "task"))} AS w FROM conversations WHERE length(text) >= 10),
kept AS (SELECT conv_id, turn, concat_ws(',', CASE WHEN h > 0 THEN 'home' END, CASE WHEN m > 0 THEN 'motion' END, CASE WHEN v > 0 THEN 'travel' END, CASE WHEN w > 0 THEN 'work' END) AS topics, round((h + m + v + w) / 10.0, 2) AS match_score FROM tagged WHERE h + m + v + w > 0)"""

# greedy chunks over all kept records of whole files; a size is the record's JSON, with spaces and nulls, and ten
_TAGGED_FILES = TAGGED.replace("FROM conversations WHERE", "FROM conversations WHERE conv_id % 10 <> 3 AND")
_RECORD = "'{\"file_no\": ' || conv_id || ', \"source_file\": \"' || conv_id || '\", \"message_index\": ' || mi || ', \"role\": \"' || role || '\", \"timestamp\": null, \"text\": ' || to_json(text) || ', \"topics\": [\"' || replace(topics, ',', '\", \"') || '\"], \"match_score\": ' || match_score || ', \"record_id\": \"0123456789abcdef\"}'"
CHUNKS_CTE = f"""{_TAGGED_FILES}, turns AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS mi FROM conversations),
sized AS (SELECT conv_id, mi, topics, CAST(length({_RECORD}) + 10 AS BIGINT) AS size, row_number() OVER (ORDER BY conv_id, mi) AS i FROM kept JOIN turns USING (conv_id, turn)),
fold AS (SELECT conv_id, mi, i, size, CAST(1 AS BIGINT) AS chunk_id, size AS filled FROM sized WHERE i = 1
  UNION ALL SELECT s.conv_id, s.mi, s.i, s.size, f.chunk_id + CAST(f.filled + s.size > 2000 AS BIGINT), CASE WHEN f.filled + s.size > 2000 THEN s.size ELSE f.filled + s.size END FROM fold f JOIN sized s ON s.i = f.i + 1)"""
CHUNKS = f"WITH RECURSIVE {CHUNKS_CTE} SELECT CAST(conv_id AS VARCHAR) AS source_file, CAST(mi AS INTEGER) AS message_index, size, chunk_id FROM fold"
CHUNK_LIST = f"WITH RECURSIVE {CHUNKS_CTE} SELECT chunk_id, format('chunk_{{:04d}}.json', chunk_id) AS filename, count(*) AS record_count, CAST(sum(size) AS BIGINT) AS char_size FROM fold GROUP BY chunk_id"
MANIFEST = f"""WITH RECURSIVE {CHUNKS_CTE}, n AS (SELECT topic, count(*) AS n FROM (SELECT unnest(string_split(topics, ',')) AS topic FROM kept) GROUP BY 1), seen AS (SELECT * FROM conversations WHERE conv_id % 10 <> 3)
SELECT (SELECT count(DISTINCT conv_id) FROM conversations) AS files, (SELECT count(DISTINCT conv_id) FROM conversations WHERE conv_id % 10 = 3) AS failed, (SELECT count(*) FROM seen) AS seen, (SELECT count(*) FROM seen WHERE length(text) < 10) AS dropped_short,
  (SELECT count(*) FROM kept) AS kept, (SELECT max(chunk_id) FROM fold) AS chunks, (SELECT string_agg(topic || '=' || n, ',' ORDER BY topic) FROM n) AS topic_counts, (SELECT count(*) FROM seen) - (SELECT count(*) FROM kept) AS dropped"""

DIVERGENCES = f"""WITH {CANDLES}, {CVD.replace(TRADES + ", ", "", 1)}, f AS (SELECT inst_id, date_trunc('hour', window_start) AS window_start, arg_max(v, window_start) AS v, sum(d) AS d, sum(abs(d)) AS g FROM cvd GROUP BY ALL),
x AS (SELECT c.inst_id, c.window_start, c.open, c.high, c.low, c.close, f.v, f.d, f.g, sum(f.g) OVER w AS flow, count(*) OVER b = 3 AND count(*) OVER a = 3 AS whole, max(c.high) OVER b AS hb, max(c.high) OVER a AS ha, min(c.low) OVER b AS lb, min(c.low) OVER a AS la
  FROM candles c JOIN f USING (inst_id, window_start) WHERE c.timeframe = '1h' WINDOW w AS (PARTITION BY c.inst_id ORDER BY c.window_start), b AS (PARTITION BY c.inst_id ORDER BY c.window_start ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY c.inst_id ORDER BY c.window_start ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)),
hi AS (SELECT *, lag(high) OVER w AS p, lag(v) OVER w AS pv, lag(flow) OVER w AS pf FROM x WHERE whole AND high > hb AND high >= ha WINDOW w AS (PARTITION BY inst_id ORDER BY window_start)),
lo AS (SELECT *, lag(low) OVER w AS p, lag(v) OVER w AS pv, lag(flow) OVER w AS pf FROM x WHERE whole AND low < lb AND low <= la WINDOW w AS (PARTITION BY inst_id ORDER BY window_start))
SELECT inst_id, window_start, 'absorption' AS pattern, 'BULLISH' AS direction FROM lo WHERE v < pv AND (pv - v) * 100 >= (flow - pf) * 30 AND low * 1000 <= p * 1001 UNION ALL SELECT inst_id, window_start, 'exhaustion', 'BEARISH' FROM hi WHERE v < pv AND (pv - v) * 100 >= (flow - pf) * 30 AND high > p
UNION ALL SELECT inst_id, window_start, 'delta_turn', CASE WHEN d > 0 THEN 'BEARISH' ELSE 'BULLISH' END FROM x WHERE sign(close - open) * sign(d) < 0 AND abs(d) * 100 >= g * 30"""
ORDER_FLOW = f"""WITH {TOP_CTE}, p AS (SELECT *, lag(pb) OVER w AS b0, lag(vb) OVER w AS vb0, lag(pa) OVER w AS a0, lag(va) OVER w AS va0 FROM b WINDOW w AS (PARTITION BY inst_id ORDER BY ts))
SELECT inst_id, ts, CAST(coalesce((CASE WHEN pb >= b0 THEN vb ELSE 0 END - CASE WHEN pb <= b0 THEN vb0 ELSE 0 END) - (CASE WHEN pa <= a0 THEN va ELSE 0 END - CASE WHEN pa >= a0 THEN va0 ELSE 0 END), 0) AS DOUBLE) AS ofi FROM p"""
ORDER_FLOW_10S = f"SELECT inst_id, time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '2000-01-01') AS window_start, sum(ofi) AS ofi, count(*) AS snapshots FROM ({ORDER_FLOW}) GROUP BY 1, 2"

# gaps and islands: a wall is born at the first snapshot of a streak of enough notional. No streak of these tables lasts
# an hour, so the restarts after one are left to the model test
WALLS_CTE = f"""{book(1000)}, wm AS (SELECT *, epoch_us(ts) AS us, n >= CASE inst_id WHEN 'BTC-USDT-SWAP' THEN 100 ELSE 1000 END AS enough FROM bands),
wg AS (SELECT *, count(*) FILTER (NOT enough) OVER (PARTITION BY inst_id, side, band ORDER BY ts) AS streak FROM wm),
held AS (SELECT inst_id, side, band, ts, us, row_number() OVER w AS i, first_value(us) OVER w AS born FROM wg WHERE enough WINDOW w AS (PARTITION BY inst_id, side, band, streak ORDER BY ts)),
walls AS (SELECT *, (us - (born - born % 1000000)) // 1000000 AS age FROM held)"""
WALLS = f"""WITH {WALLS_CTE} SELECT b.inst_id, b.ts, b.side, b.band, round(CAST(b.n AS DOUBLE), 4) AS notional, CASE WHEN w.i > 1 AND w.age >= 30 THEN w.age END AS wall_age, coalesce(w.i > 1 AND w.age >= 30, false) AS wall_active
FROM bands b LEFT JOIN walls w ON w.inst_id = b.inst_id AND w.ts = b.ts AND w.side = b.side AND w.band = b.band"""
FIVE = f"""WITH {STATES_CTE}, {SIGNALS_CTE.replace(TRADES + ", ", "", 1)}, {CVD.replace(TRADES + ", ", "", 1)}, {WALLS_CTE},
vs AS (SELECT * FROM (SELECT inst_id, date_trunc('minute', ts) AS window_start, row_number() OVER (PARTITION BY inst_id, date_trunc('minute', ts) ORDER BY ts) AS rn, round(CAST(sum(pv) OVER s AS DOUBLE) / CAST(sum(n) OVER s AS DOUBLE), 6) AS v,
  round(CAST(sum(pv) OVER h AS DOUBLE) / CAST(sum(n) OVER h AS DOUBLE), 6) AS v1 FROM t WINDOW s AS (PARTITION BY inst_id, date_trunc('day', ts) ORDER BY ts), h AS (PARTITION BY inst_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)) WHERE rn = 1),
young AS (SELECT b.inst_id, b.ts, count(*) FILTER (b.side = 'bid' AND w.i > 1 AND w.age BETWEEN 30 AND 299) AS yb, count(*) FILTER (b.side = 'ask' AND w.i > 1 AND w.age BETWEEN 30 AND 299) AS ya FROM bands b LEFT JOIN walls w ON w.inst_id = b.inst_id AND w.ts = b.ts AND w.side = b.side AND w.band = b.band GROUP BY ALL),
parts AS (SELECT inst_id, 'wicks' AS component, max(created) AS last, 'untouched=' || count(*) FILTER (status = 'untouched') || ', recent=' || count(*) FILTER (status = 'untouched' AND created >= TIMESTAMP '2024-01-31 00:10:00' - INTERVAL 6000 MINUTE) AS attrs FROM states GROUP BY 1
  UNION ALL SELECT inst_id, 'volume', max(window_start), 'tier=' || arg_max(volume_tier, window_start) || ', absorption=' || arg_max(absorption, window_start) || ', divergence=' || arg_max(divergence, window_start) FROM signals GROUP BY 1
  UNION ALL SELECT inst_id, 'walls', max(ts), 'young_bid=' || arg_max(yb, ts) || ', young_ask=' || arg_max(ya, ts) FROM young GROUP BY 1
  UNION ALL SELECT inst_id, 'cvd', max(window_start), 'direction=' || CASE sign(arg_max(d, window_start)) WHEN 1 THEN 'BULLISH' WHEN -1 THEN 'BEARISH' ELSE 'NEUTRAL' END || ', delta=' || CAST(round(arg_max(d, window_start), 2) AS DECIMAL(18,2)) FROM cvd GROUP BY 1
  UNION ALL SELECT inst_id, 'vwap', max(window_start), 'session=' || CAST(round(arg_max(v, window_start), 2) AS DECIMAL(18,2)) || ', hour=' || CAST(round(arg_max(v1, window_start), 2) AS DECIMAL(18,2)) FROM vs GROUP BY 1),
r AS (SELECT inst_id, component, CASE WHEN age < 15 THEN 'FRESH' ELSE 'STALE' END AS status, age AS age_minutes, attrs FROM (SELECT *, CAST(trunc(epoch(TIMESTAMP '2024-01-31 00:10:00' - last) / 60) AS BIGINT) AS age FROM parts))
SELECT * FROM r UNION ALL SELECT inst_id, 'overall', CASE WHEN count(*) FILTER (status = 'STALE') > 0 THEN 'STALE' ELSE 'HEALTHY' END, max(age_minutes), 'fresh=' || count(*) FILTER (status = 'FRESH') || ', stale=' || count(*) FILTER (status = 'STALE') || ', missing=0' FROM r GROUP BY 1"""
# every snapshot has enough, so each band is one streak over the whole history; births follow from each other
WALL_RESTARTS = f"""WITH RECURSIVE {book(1000)}, r AS MATERIALIZED (SELECT inst_id, side, band, ts, epoch_us(ts) AS us, row_number() OVER (PARTITION BY inst_id, side, band ORDER BY ts) AS i FROM bands WHERE band <= 1),
births(inst_id, side, band, i, us) AS (SELECT inst_id, side, band, i, us FROM r WHERE i = 1
  UNION ALL SELECT r.inst_id, r.side, r.band, r.i, r.us FROM (SELECT b.inst_id, b.side, b.band, min(r.i) + 1 AS i FROM births b JOIN r ON r.inst_id = b.inst_id AND r.side = b.side AND r.band = b.band AND r.us > b.us - b.us % 1000000 + 900000000 GROUP BY ALL) n JOIN r USING (inst_id, side, band, i)),
w AS (SELECT r.*, last_value(b.us - b.us % 1000000 IGNORE NULLS) OVER (PARTITION BY r.inst_id, r.side, r.band ORDER BY r.ts) AS born, b.us IS NOT NULL AS start FROM r LEFT JOIN births b USING (inst_id, side, band, i)),
a AS (SELECT *, CASE WHEN NOT start AND us - born BETWEEN 30000000 AND 900000000 THEN (us - born) // 1000000 END AS wall_age FROM w)
SELECT inst_id, ts, side, band, wall_age, wall_age IS NOT NULL AS wall_active FROM a"""
