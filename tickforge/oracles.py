"""DuckDB SQL for the engine's queries: common table expressions and one SELECT for each query."""

from __future__ import annotations

OHLC = """ohlc AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS timestamp, first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS DOUBLE) AS tick_volume, 0.0::DOUBLE AS real_volume, 0.0::DOUBLE AS spread
  FROM events GROUP BY ALL)"""
DAILY = """daily AS (
  SELECT o_orderpriority AS symbol, o_orderdate AS timestamp, first(o_totalprice ORDER BY o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
         last(o_totalprice ORDER BY o_orderkey) AS close, CAST(count(*) AS DOUBLE) AS tick_volume, 0.0::DOUBLE AS real_volume, 0.0::DOUBLE AS spread
  FROM orders GROUP BY ALL)"""
_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount"
BIDASK = f"""ticks AS (
  SELECT *, l_extendedprice / nullif(l_quantity, 0) AS ask, (l_extendedprice / nullif(l_quantity, 0)) * (1 - l_discount) AS bid FROM lineitem
), quotes AS (
  SELECT l_returnflag AS symbol, l_shipdate AS timestamp,
         first(bid ORDER BY {_KEY}) AS bid_open, max(bid) AS bid_high, min(bid) AS bid_low, last(bid ORDER BY {_KEY}) AS bid_close,
         first(ask ORDER BY {_KEY}) AS ask_open, max(ask) AS ask_high, min(ask) AS ask_low, last(ask ORDER BY {_KEY}) AS ask_close
  FROM ticks GROUP BY ALL
), bidask AS (
  SELECT *, (bid_open + ask_open) / 2 AS mid_open, (bid_high + ask_high) / 2 AS mid_high, (bid_low + ask_low) / 2 AS mid_low, (bid_close + ask_close) / 2 AS mid_close,
         ask_close - bid_close AS spread_close, bid_close - bid_open AS bid_change, ask_close - ask_open AS ask_change FROM quotes)"""
RAW = """raw AS (
  SELECT event_id, event_type AS symbol, CASE WHEN event_id % 79 <> 0 THEN CAST(ts AS VARCHAR) END AS time,
         CASE WHEN event_id % 97 = 0 THEN 'junk' ELSE CAST(value AS VARCHAR) END AS open, CAST(CASE WHEN event_id % 83 = 0 THEN value - 2 ELSE value + 1 END AS VARCHAR) AS high,
         CAST(value - 1 AS VARCHAR) AS low, CAST(value AS VARCHAR) AS close, CASE WHEN event_id % 97 <> 0 THEN '1' END AS tick_volume FROM events
), raw2 AS (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE event_id % 89 = 0
), norm AS (
  SELECT * FROM (
    SELECT event_id, TRY_CAST(time AS TIMESTAMP) AS timestamp, symbol, TRY_CAST(open AS DOUBLE) AS open, TRY_CAST(high AS DOUBLE) AS high, TRY_CAST(low AS DOUBLE) AS low,
           TRY_CAST(close AS DOUBLE) AS close, coalesce(TRY_CAST(tick_volume AS DOUBLE), 0.0) AS tick_volume, 0.0::DOUBLE AS real_volume, 0.0::DOUBLE AS spread FROM raw2)
  WHERE NOT coalesce(high < low OR high < open OR high < close OR low > open OR low > close, false)
    AND (timestamp IS NULL OR timestamp BETWEEN TIMESTAMP '1970-01-01' AND TIMESTAMP '2030-01-01'))"""


def full(agg: str, x: str, n: int) -> str:
    frame = f"(PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {frame} = {n} THEN {agg}({x}) OVER {frame} END"


def filled(x: str) -> str:
    return f"coalesce(last_value({x} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp ROWS UNBOUNDED PRECEDING), first_value({x} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


_W = "(PARTITION BY symbol ORDER BY timestamp)"
COMMON = ["log_ret_1", "RV_w", "ATR_w", "VoV_wV", "RSI_w", "bb_width", "rolling_kurt", "rolling_skew", "rolling_autocorr", "zscore_close"]
MICRO = ["spread_ma_w", "spread_vol", "mid_ret_1", "range_efficiency", "signed_spread_move", "bid_ask_imbalance", "effective_spread", "quote_slope"]


def _ln(x: str) -> str:
    return f"CASE WHEN ({x}) > 0 THEN ln({x}) END"


def features(bars: str, px: str, high: str = "high", low: str = "low") -> str:
    """CTEs f0 .. f4 over ``bars``; the last, ``feat``, has the ten common features, the warm-up included."""
    return f"""f0 AS (
  SELECT *, {high} AS hi_, {low} AS lo_, lag({px}) OVER {_W} AS pb FROM {bars}
), f1 AS (
  SELECT *, {_ln(f"{px} / nullif(pb, 0)")} AS lr, greatest(hi_ - lo_, abs(hi_ - pb), abs(lo_ - pb)) AS tr,
         CASE WHEN {px} - pb > 0 THEN {px} - pb ELSE 0.0 END AS gain, CASE WHEN {px} - pb < 0 THEN pb - {px} ELSE 0.0 END AS loss FROM f0
), f2 AS (
  SELECT *, {filled("lr")} AS log_ret_1, sqrt(({full("var_samp", "lr", 20)}) * 252) AS rv, {full("avg", "tr", 14)} AS atr, {full("avg", "gain", 14)} AS g, {full("avg", "loss", 14)} AS l,
         {full("avg", px, 20)} AS sma, {full("stddev_samp", px, 20)} AS sd, {full("avg", px, 50)} AS mean50, {full("stddev_samp", px, 50)} AS dev50 FROM f1
), f3 AS (
  SELECT *, sqrt(({full("var_samp", "log_ret_1", 20)}) * 252) AS rvf, {_ln("rv")} AS lnrv, lag(log_ret_1) OVER {_W} AS lrb,
         CASE WHEN l = 0 AND g > 0 THEN 100.0 WHEN l <> 0 THEN 100 - 100 / (1 + g / l) END AS rsi,
         {full("kurtosis", "log_ret_1", 20)} AS kurt, {full("skewness", "log_ret_1", 20)} AS skew FROM f2
), f4 AS (
  SELECT *, {full("stddev_samp", "lnrv", 30)} AS vov,
         CASE WHEN count(lrb) OVER p9 = 9 AND count(log_ret_1) OVER p9 = 9 THEN covar_pop(log_ret_1, lrb) OVER p9 / nullif(stddev_pop(log_ret_1) OVER p9 * stddev_pop(lrb) OVER p9, 0) END AS ac,
         4 * sd / nullif(sma, 0) AS bb, ({px} - mean50) / nullif(dev50, 0) AS z
  FROM f3 WINDOW p9 AS (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)
), feat AS (
  SELECT * EXCLUDE (hi_, lo_, pb, lr, tr, gain, loss, rv, atr, g, l, sma, sd, mean50, dev50, rvf, lnrv, lrb, rsi, kurt, skew, vov, ac, bb, z),
         {filled("rvf")} AS RV_w, {filled("atr")} AS ATR_w, {filled("vov")} AS VoV_wV, {filled("rsi")} AS RSI_w, {filled("bb")} AS bb_width, {filled("kurt")} AS rolling_kurt,
         {filled("skew")} AS rolling_skew, {filled("ac")} AS rolling_autocorr, {filled("z")} AS zscore_close FROM f4
), cut AS (
  SELECT * EXCLUDE (rn_, n_) FROM (SELECT *, row_number() OVER {_W} AS rn_, count(*) OVER (PARTITION BY symbol) AS n_ FROM feat) WHERE rn_ > 51 OR n_ <= 51)"""


_SLOPE = lambda x: "(" + " + ".join(f"{k - 2}.0 * lag({x}, {4 - k}) OVER {_W}" for k in range(5)) + ") / 10"
MICRO_CTES = f"""m1 AS (
  SELECT *, {_ln(f"mid_close / nullif(lag(mid_close) OVER {_W}, 0)")} AS mlr, abs(mid_close - lag(mid_close, 14) OVER {_W}) AS move, mid_high - mid_low AS rng,
         (spread_close - lag(spread_close) OVER {_W}) * sign(mid_close - lag(mid_close) OVER {_W}) AS signed_,
         (abs(ask_change) - abs(bid_change)) / nullif(abs(ask_change) + abs(bid_change), 0) AS imb, ({_SLOPE("bid_close")} + {_SLOPE("ask_close")}) / 2 AS slope FROM cut
), m2 AS (
  SELECT *, {full("avg", "spread_close", 20)} AS ma, {full("stddev_samp", "spread_close", 20)} AS sv, {full("sum", "rng", 14)} AS s14, sqrt(({full("var_samp", "mlr", 20)}) * 252) AS mrv FROM m1
), m3 AS (SELECT *, move / nullif(s14, 0) AS eff, spread_close * (1 + coalesce(mrv, 0)) AS es FROM m2
), micro AS (
  SELECT *, {filled("ma")} AS spread_ma_w, {filled("sv")} AS spread_vol, {filled("mlr")} AS mid_ret_1, {filled("eff")} AS range_efficiency, {filled("signed_")} AS signed_spread_move,
         {filled("imb")} AS bid_ask_imbalance, {filled("es")} AS effective_spread, {filled("slope")} AS quote_slope FROM m3)"""

OHLC_FEATURES = f"{OHLC}, {features('ohlc', 'close')}"
DAILY_FEATURES = f"{DAILY}, {features('daily', 'close')}"
BIDASK_FEATURES = f"{BIDASK}, {features('bidask', 'mid_close', 'greatest(bid_high, ask_high)', 'least(bid_low, ask_low)')}"
BIDASK_MICRO = f"{BIDASK_FEATURES}, {MICRO_CTES}"


def labels(vol: str, horizon: int, source: str = "cut", name: str = "lab") -> str:
    """CTE: rows of ``source`` with rn, barriers and label."""
    return f"""b_{name} AS (
  SELECT *, close + 2.0 * {vol} AS upper, close - 2.0 * {vol} AS lower, row_number() OVER {_W} AS rn FROM {source} WHERE close IS NOT NULL AND {vol} IS NOT NULL
), t_{name} AS (
  SELECT a.symbol, a.rn, arg_min(CASE WHEN b.close >= a.upper THEN 1.0 ELSE -1.0 END, b.rn) AS side
  FROM b_{name} a JOIN b_{name} b ON a.symbol = b.symbol AND b.rn BETWEEN a.rn + 1 AND a.rn + {horizon} AND (b.close >= a.upper OR b.close <= a.lower) GROUP BY ALL
), {name} AS (SELECT b.*, CAST(coalesce(side, 0.0) AS DOUBLE) AS label FROM b_{name} b LEFT JOIN t_{name} t ON b.symbol = t.symbol AND b.rn = t.rn)"""


VOV = "vq AS (SELECT quantile_cont(VoV_wV, 0.2) AS lo, quantile_cont(VoV_wV, 0.8) AS hi FROM lab)"
FILTERED = "flt AS (SELECT lab.* EXCLUDE (label), CASE WHEN VoV_wV < lo OR VoV_wV > hi THEN NULL ELSE label END AS label FROM lab, vq)"
LABELLED = f"{OHLC_FEATURES}, {labels('RV_w', 24)}, {VOV}, {FILTERED}"

#: Splits: 2 years, 1 year, every year, over the daily bars.
SPLITS = """lim AS (SELECT min(timestamp) AS a, max(timestamp) AS b FROM daily
), wins AS (
  SELECT CAST(k AS INTEGER) AS split_id, a + to_seconds(k * 31557600) AS train_start, a + to_seconds(k * 31557600 + 63115200) AS train_end,
         a + to_seconds(k * 31557600 + 63115200) AS val_start, a + to_seconds(k * 31557600 + 94672800) AS val_end
  FROM lim, range(0, 50) r(k) WHERE a + to_seconds(k * 31557600 + 94672800) <= b
), idx AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS row_idx FROM daily
), asg AS (
  SELECT idx.*, split_id, CASE WHEN timestamp >= train_start AND timestamp < train_end THEN 'train' ELSE 'val' END AS role
  FROM idx JOIN wins ON (timestamp >= train_start AND timestamp < train_end) OR (timestamp >= val_start AND timestamp < val_end))"""
SPLIT_CTES = f"{DAILY}, {SPLITS}"

#: Predictions by rule: the class of the last return's sign predicts that of the next.
PREDICTIONS = f"""{DAILY}, r0 AS (SELECT *, row_number() OVER {_W} - 1 AS row_idx, close / nullif(lag(close) OVER {_W}, 0) - 1 AS r FROM daily
), r1 AS (SELECT *, CASE WHEN r > 0.2 THEN 2 WHEN r < -0.2 THEN 0 ELSE 1 END AS y FROM r0
), pred AS (SELECT symbol, timestamp, row_idx, CAST(row_idx % 3 AS INTEGER) AS fold_id, y, lag(y) OVER {_W} AS p FROM r1 QUALIFY p IS NOT NULL)"""


def boosting(rows: str, rate: float, bins: int, alpha: float, rounds: int) -> str:
    """CTEs: trees of one cut each for three classes, over ``rows`` (split_id, role, row_idx, y, c, v); margins after all rounds are ``m{rounds}``, cuts ``best1`` and so on."""
    quantiles = ", ".join(f"{i / bins}" for i in range(1, bins))
    score = lambda g, h: f"greatest(abs({g}) - {alpha}, 0) ** 2 / ({h} + 1.0)"
    weight = lambda g, h: f"-sign({g}) * greatest(abs({g}) - {alpha}, 0) / ({h} + 1.0) * {rate}"
    ctes = f"""long AS (SELECT split_id, role, row_idx, y, 0 AS f, c AS x FROM {rows} UNION ALL SELECT split_id, role, row_idx, y, 1, v FROM {rows}
), edge AS (SELECT split_id, f, quantile_cont(x, [{quantiles}]) AS e FROM long WHERE role = 'train' GROUP BY ALL
), bin AS (SELECT l.*, CASE WHEN x IS NULL THEN {bins} ELSE len(list_filter(e, lambda b: b < x)) END AS b FROM long l JOIN edge USING (split_id, f)
), m0 AS (SELECT split_id, role, row_idx, y, unnest([0, 1, 2]) AS k, 0.0::DOUBLE AS m FROM {rows})"""
    for r in range(1, rounds + 1):
        ctes += f""", e{r} AS (SELECT *, exp(m - max(m) OVER (PARTITION BY split_id, role, row_idx)) AS e FROM m{r - 1}
), p{r} AS (SELECT *, e / sum(e) OVER (PARTITION BY split_id, role, row_idx) AS p FROM e{r}
), g{r} AS (SELECT *, round((p - CASE WHEN y = k THEN 1 ELSE 0 END) * 67108864) AS g, round(2 * p * (1 - p) * 67108864) AS h FROM p{r}
), h{r} AS (SELECT split_id, k, f, b, sum(g) / 67108864 AS g, sum(h) / 67108864 AS h, count(*) AS n FROM g{r} JOIN bin USING (split_id, role, row_idx) WHERE role = 'train' GROUP BY ALL
), c{r} AS (SELECT *, sum(g) OVER w AS gt, sum(h) OVER w AS ht, sum(n) OVER w AS nt, sum(g) OVER u AS gl, sum(h) OVER u AS hl, sum(n) OVER u AS nl,
    coalesce(sum(CASE WHEN b = {bins} THEN g END) OVER w, 0) AS gm, coalesce(sum(CASE WHEN b = {bins} THEN h END) OVER w, 0) AS hm, coalesce(sum(CASE WHEN b = {bins} THEN n END) OVER w, 0) AS nm
  FROM h{r} WINDOW w AS (PARTITION BY split_id, k, f), u AS (PARTITION BY split_id, k, f ORDER BY b ROWS UNBOUNDED PRECEDING)
), d{r} AS (SELECT split_id, k, f, b, side, gt, ht, nt, gl + side * gm AS gl, hl + side * hm AS hl, nl + side * nm AS nl FROM c{r}, (SELECT unnest([0, 1]) AS side) WHERE b < {bins} AND (side = 0 OR nm > 0)
), s{r} AS (SELECT *, {score("gl", "hl")} + {score("(gt - gl)", "(ht - hl)")} - {score("gt", "ht")} AS gain FROM d{r}
), best{r} AS (SELECT * FROM s{r} WHERE nl > 0 AND nt > nl AND hl >= 1 AND ht - hl >= 1 AND gain > 0 QUALIFY row_number() OVER (PARTITION BY split_id, k ORDER BY round(gain, 9) DESC, f, b, side) = 1
), m{r} AS (SELECT a.split_id, a.role, a.row_idx, a.y, a.k, a.m + CASE WHEN t.f IS NULL THEN {weight("q.gt", "q.ht")} WHEN CASE WHEN n.b = {bins} THEN t.side = 1 ELSE n.b <= t.b END THEN {weight("t.gl", "t.hl")} ELSE {weight("(t.gt - t.gl)", "(t.ht - t.hl)")} END AS m
  FROM m{r - 1} a JOIN (SELECT DISTINCT split_id, k, gt, ht FROM c{r} WHERE f = 0) q ON q.split_id = a.split_id AND q.k = a.k
  LEFT JOIN best{r} t ON t.split_id = a.split_id AND t.k = a.k LEFT JOIN bin n ON n.split_id = a.split_id AND n.role = a.role AND n.row_idx = a.row_idx AND n.f = t.f)"""
    return ctes
