"""SQL for the checking engine: the expected result of each registered query.

Written from the meaning of each operator and not from its Spark plan: the calendar is a generated
series joined to the counts, and moving means are sliding frames.
"""

from dataclasses import replace

from countcast.columns import CATEGORICAL_FEATURES, FEATURES
from countcast.operators.boosting import DAILY, SINGLE_TREE, Settings
from countcast.operators.sampling import LEVELS, LOWEST_LEVEL, OTHER_SHARE, SAMPLE_SEED, TOP_SHARE
from workload import fixtures as fx

SHIPPING, EVENTS = fx.SHIPPING_DAY, fx.EVENTS_DAY


def _daily(raw_sql: str) -> str:
    return f"""
raw AS ({raw_sql}),
clean AS (
  SELECT trim(merchant_id) AS merchant_id, CAST(event_ts AS DATE) AS day,
         CASE WHEN mcc IS NULL OR trim(mcc) = '' THEN -1 ELSE TRY_CAST(trim(mcc) AS INTEGER) END AS mcc
  FROM raw),
daily AS (
  SELECT merchant_id, day, mcc, count(*) AS total FROM clean
  WHERE merchant_id <> '0' AND TRY_CAST(merchant_id AS BIGINT) IS NOT NULL AND mcc IS NOT NULL AND day IS NOT NULL
  GROUP BY merchant_id, day, mcc)"""


def _dense(raw_sql: str, until: str) -> str:
    return _daily(raw_sql) + f""",
firsts AS (
  SELECT mcc, CAST(merchant_id AS BIGINT) AS merchant_id, min(day) AS first_day
  FROM daily WHERE day <= DATE '{until}' GROUP BY ALL),
spans AS (
  SELECT mcc, merchant_id, CAST(unnest(generate_series(first_day, DATE '{until}', INTERVAL 1 DAY)) AS DATE) AS day
  FROM firsts),
dense AS (
  SELECT s.mcc, s.merchant_id, s.day, coalesce(d.total, 0) AS total
  FROM spans s LEFT JOIN daily d
    ON d.mcc = s.mcc AND CAST(d.merchant_id AS BIGINT) = s.merchant_id AND d.day = s.day)"""


WINDOWS = """
WINDOW w AS (PARTITION BY mcc, merchant_id ORDER BY day),
       w4 AS (PARTITION BY mcc, merchant_id ORDER BY day ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING),
       w7 AS (PARTITION BY mcc, merchant_id ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
       w14 AS (PARTITION BY mcc, merchant_id ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING),
       w30 AS (PARTITION BY mcc, merchant_id ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
"""

CALENDAR = """
CAST(dayofweek(day) + 1 AS INTEGER) AS dow, CAST(weekofyear(day) AS INTEGER) AS week,
CAST(dayofmonth(day) AS INTEGER) AS day_of_month, CAST(month(day) AS INTEGER) AS month,
CAST(year(day) AS INTEGER) AS year,
CAST(CASE WHEN dayofweek(day) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
CAST(CASE WHEN month(day) || '-' || dayofmonth(day) IN
  ('1-1', '5-1', '7-28', '7-29', '8-30', '10-8', '11-1', '12-8', '12-9', '12-25') THEN 1 ELSE 0 END AS INTEGER)
  AS is_holiday,
CAST(CASE WHEN dayofmonth(day) IN (15, 30, 31) THEN 1 ELSE 0 END AS INTEGER) AS is_payday,
CAST(CASE WHEN dayofmonth(day) IN (1, 2, 3) THEN 1 ELSE 0 END AS INTEGER) AS is_month_start,
CAST(CASE WHEN dayofmonth(day) IN (28, 29, 30, 31) THEN 1 ELSE 0 END AS INTEGER) AS is_month_end
"""

LAGS = """
lag(total, 1) OVER w AS lag_1, lag(total, 2) OVER w AS lag_2, lag(total, 7) OVER w AS lag_7,
lag(total, 14) OVER w AS lag_14, lag(total, 30) OVER w AS lag_30,
lag(total, 1) OVER w - lag(total, 7) OVER w AS diff_week
"""

LAG_NAMES = ["lag_1", "lag_2", "lag_7", "lag_14", "lag_30", "diff_week"]
ROLLING = "avg(total) OVER w7 AS ma_7, avg(total) OVER w14 AS ma_14, stddev_samp(total) OVER w7 AS std_7"
ROLLING_NAMES = ["ma_7", "ma_14", "std_7"]


def _filled(names: list[str], fractions: bool = False) -> str:
    shape = "round(coalesce({0}, 0), 6) AS {0}" if fractions else "coalesce({0}, 0) AS {0}"
    return ", ".join(shape.format(n) for n in names)


def _features(raw_sql: str, until: str) -> str:
    """Feature rows, unrounded, over the whole calendar; ``known`` marks rows with a day before them."""
    return _dense(raw_sql, until) + f""",
looked_back AS (SELECT *, {LAGS}, {ROLLING} FROM dense {WINDOWS}),
features AS (
  SELECT mcc, merchant_id, day, total, {CALENDAR}, lag_1 IS NOT NULL AS known,
         {_filled(LAG_NAMES + ROLLING_NAMES)}
  FROM looked_back)"""


def _feature_select(source: str) -> str:
    columns = ("mcc, merchant_id, CAST(day AS VARCHAR) AS day, total, dow, week, day_of_month, month, year, "
               "is_weekend, is_holiday, is_payday, is_month_start, is_month_end, lag_1, lag_2, lag_7, lag_14, lag_30, "
               "diff_week, round(ma_7, 6) AS ma_7, round(ma_14, 6) AS ma_14, round(std_7, 6) AS std_7")
    return f"SELECT {columns} FROM {source}"


DENIED, EVENT_ROWS = fx.DENIED_RAW_SQL, fx.EVENTS_RAW_SQL
DAILY_OUT = "SELECT merchant_id, CAST(day AS VARCHAR) AS day, mcc, total FROM daily"

BEST_ROWS = f"""
best AS (
  SELECT merchant_id, tax_id, mcc, trade_name, day FROM (
    SELECT *, row_number() OVER (
      PARTITION BY merchant_id
      ORDER BY (tax_id IS NULL), (mcc IS NULL), day DESC, tax_id, mcc, trade_name) AS place
    FROM ({fx.MERCHANT_ATTRIBUTES_SQL}) a) WHERE place = 1)"""

KNOWN_MERCHANTS = f"""
models AS ({fx.MODELS_SQL}),
merchants AS (
  SELECT mcc, merchant_id, trade_name, tax_id FROM (
    SELECT mcc, TRY_CAST(merchant_id AS BIGINT) AS merchant_id, trade_name, tax_id, row_number() OVER (
      PARTITION BY mcc, TRY_CAST(merchant_id AS BIGINT)
      ORDER BY (tax_id IS NULL), (trade_name IS NULL), tax_id, trade_name) AS place
    FROM ({fx.MERCHANTS_RAW_SQL}) m
    WHERE TRY_CAST(merchant_id AS BIGINT) IS NOT NULL
      AND mcc IN (SELECT mcc FROM models WHERE mcc NOT IN (-1, 0)))
  WHERE place = 1),
known AS (
  SELECT m.mcc, m.merchant_id, m.trade_name, m.tax_id, a.notify_emails
  FROM merchants m LEFT JOIN ({fx.SPECIAL_ACCOUNTS_SQL}) a ON a.tax_id = m.tax_id)"""

# The row of the forecast day: its calendar and look back, its total set to 0, for merchants seen before.
PREDICTION_ROWS = _features(EVENT_ROWS, EVENTS) + f""",
rows_to_score AS (
  SELECT * REPLACE (CAST(0 AS BIGINT) AS total) FROM features WHERE day = DATE '{EVENTS}' AND known)"""

SCORE = "exp(m.b0 + m.b_ma7 * r.ma_7 + m.b_lag1 * r.lag_1)"


def _scored(source: str) -> str:
    return f"""
scored AS (
  SELECT r.*, {SCORE} AS expected, round({SCORE}, 10) AS prediction,
         round({SCORE}, 10) >= r.ma_7 AND r.ma_7 <> 0 AND round({SCORE}, 10) >= 5 AS notify
  FROM {source} r JOIN models m ON m.mcc = r.mcc WHERE r.mcc NOT IN (-1, 0))"""


DECIDED = PREDICTION_ROWS + "," + KNOWN_MERCHANTS + "," + _scored("rows_to_score") + """,
decided AS (
  SELECT s.*, k.trade_name, k.tax_id, k.notify_emails
  FROM scored s LEFT JOIN known k ON k.mcc = s.mcc AND k.merchant_id = s.merchant_id)"""

LABEL = ("'''' || list_extract(['ENE','FEB','MAR','ABR','MAY','JUN','JUL','AGO','SET','OCT','NOV','DIC'], "
         "CAST(month(day) AS INTEGER)) || '-' || dayofmonth(day) || ''''")

CHARTS = DECIDED + f""",
points AS (
  SELECT mcc, merchant_id, day, total FROM dense
  WHERE day < DATE '{EVENTS}'
  QUALIFY row_number() OVER (PARTITION BY mcc, merchant_id ORDER BY day DESC) <= 15),
history AS (
  SELECT mcc, merchant_id, string_agg({LABEL}, ',' ORDER BY day) AS past_labels,
         string_agg(CAST(total AS VARCHAR), ',' ORDER BY day) AS past_data
  FROM points GROUP BY mcc, merchant_id),
charts AS (
  SELECT d.mcc, d.merchant_id, d.trade_name, d.tax_id, d.notify_emails,
         CAST(round_even(d.expected, 0) AS BIGINT) AS rounded,
         h.past_labels || ',' || {LABEL} AS labels,
         h.past_data || ',' || CAST(CAST(round_even(d.expected, 0) AS BIGINT) AS VARCHAR) AS data
  FROM decided d JOIN history h ON h.mcc = d.mcc AND h.merchant_id = d.merchant_id
  WHERE d.notify)"""

RANGE = _features(EVENT_ROWS, fx.BACKTEST_DAYS[1]) + f""",
range_rows AS (
  SELECT * FROM features
  WHERE day BETWEEN DATE '{fx.BACKTEST_DAYS[0]}' AND DATE '{fx.BACKTEST_DAYS[1]}' AND known),
models AS ({fx.MODELS_SQL}),""" + _scored("range_rows")

# Training rows in long form, a row per feature, and their bins.
TRAINING_VALUES = _features(EVENT_ROWS, fx.BACKTEST_DAYS[1]) + f""",
long AS (
  SELECT mcc, total, unnest([{", ".join(f"'{n}'" for n in FEATURES)}]) AS feature,
         unnest([{", ".join(f"CAST({'round(std_7, 6)' if n == 'std_7' else n} AS DOUBLE)" for n in FEATURES)}]) AS value
  FROM features)"""


def _bins(max_bin: int, categorical: list[str]) -> str:
    single = ", ".join(f"'{n}'" for n in categorical)
    return f""",
counts AS (SELECT mcc, feature, value, count(*) AS n FROM long GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY mcc, feature ORDER BY value) - n AS rows_below, row_number() OVER (PARTITION BY mcc, feature ORDER BY value) - 1 AS values_below,
         sum(n) OVER (PARTITION BY mcc, feature) AS all_rows, count(*) OVER (PARTITION BY mcc, feature) AS all_values,
         row_number() OVER (PARTITION BY mcc, feature ORDER BY n DESC, value) - 1 AS place
  FROM counts),
cut AS (
  SELECT mcc, feature, value, n,
         CASE WHEN feature IN ({single}) THEN place WHEN all_values <= {max_bin} THEN values_below ELSE rows_below * {max_bin} // all_rows END AS cut
  FROM running WHERE feature NOT IN ({single}) OR place < {max_bin}),
bins AS (
  SELECT mcc, feature, CAST(row_number() OVER (PARTITION BY mcc, feature ORDER BY cut) - 1 AS INTEGER) AS bin, min(value) AS low, max(value) AS high,
         CAST(sum(n) AS BIGINT) AS n_rows
  FROM cut GROUP BY mcc, feature, cut)"""


# Gradient and second derivative of cells of n rows with a sum of counts, at the logarithm of the category's mean.
def _derivatives(n: str, sum_y: str, power: float = DAILY.power) -> tuple[str, str]:
    falling, rising = f"{sum_y} * exp({1 - power} * s0)", f"{n} * exp({2 - power} * s0)"
    return f"({rising} - {falling})", f"({2 - power} * {rising} - {1 - power} * {falling})"


def _gain(g: str, h: str, s: Settings) -> str:
    return f"(power(greatest(abs({g}) - {s.l1}, 0), 2) / ({h} + {s.l2}))"


def _step(g: str, h: str, s: Settings) -> str:
    return f"(-{s.learning_rate} * sign({g}) * greatest(abs({g}) - {s.l1}, 0) / ({h} + {s.l2}))"


_G, _H = _derivatives("n", "sy")
_CUT_COLUMNS = f"""round({_gain('gl', 'hl', DAILY)} + {_gain('gr', 'hr', DAILY)} - {_gain('(gl + gr)', '(hl + hr)', DAILY)}, 6) AS gain,
  CAST(least(nl, nr) AS BIGINT) AS fewer_rows, CAST(greatest(nl, nr) AS BIGINT) AS more_rows,
  round(least({_step('gl', 'hl', DAILY)}, {_step('gr', 'hr', DAILY)}), 6) AS low_value,
  round(greatest({_step('gl', 'hl', DAILY)}, {_step('gr', 'hr', DAILY)}), 6) AS high_value"""
FREE = replace(DAILY, l1=0.0, l2=0.0)
_FREE_COLUMNS = f"""round({_gain('gl', 'hl', FREE)} + {_gain('gr', 'hr', FREE)} - {_gain('(gl + gr)', '(hl + hr)', FREE)}, 6) AS gain,
  CAST(least(nl, nr) AS BIGINT) AS fewer_rows, CAST(greatest(nl, nr) AS BIGINT) AS more_rows,
  round(least({_step('gl', 'hl', FREE)}, {_step('gr', 'hr', FREE)}), 6) AS low_value,
  round(greatest({_step('gl', 'hl', FREE)}, {_step('gr', 'hr', FREE)}), 6) AS high_value"""
_SINGLE = ", ".join(f"'{n}'" for n in CATEGORICAL_FEATURES)

ORACLE: dict[str, str] = {
    "clean_daily_counts": f"WITH {_daily(DENIED)} {DAILY_OUT}",
    "transactions_daily_counts": f"WITH {_daily(fx.TRANSACTIONS_RAW_SQL)} {DAILY_OUT}",
    "year_shard_union_counts": f"WITH {_daily(DENIED)} {DAILY_OUT}",
    "parquet_roundtrip": f"WITH {_daily(DENIED)} {DAILY_OUT}",
    "refreshed_daily_counts": f"WITH {_daily(EVENT_ROWS)} {DAILY_OUT}",
    "refreshed_days": f"""
        WITH {_daily(EVENT_ROWS)},
        events_of AS (
          SELECT c.day, c.merchant_id <> '0' AND TRY_CAST(c.merchant_id AS BIGINT) IS NOT NULL AND c.mcc IS NOT NULL AS usable,
                 {fx.LATE.format(ts="c.day", user="CAST(c.merchant_id AS BIGINT)")} AS late
          FROM clean c),
        loads AS (
          SELECT day, count(*) FILTER (NOT late) AS old_total, count(*) AS new_total FROM events_of WHERE usable GROUP BY day)
        SELECT CAST(day AS VARCHAR) AS day, CASE WHEN old_total = 0 THEN 'added' ELSE 'changed' END AS change, old_total, new_total
        FROM loads WHERE old_total <> new_total""",
    "streamed_closed_days": f"""
        WITH {_daily(EVENT_ROWS)} {DAILY_OUT} WHERE day <= (SELECT max(day) - {fx.CLOSED_AFTER} FROM daily)""",
    "rejected_event_counts": """
        WITH r AS (
          SELECT CASE WHEN l_linenumber = 2 THEN 'S' || CAST(l_suppkey AS VARCHAR)
                      ELSE CAST(l_suppkey AS VARCHAR) END AS merchant_id,
                 CASE WHEN l_linenumber = 1 THEN l_linestatus ELSE '5411' END AS mcc
          FROM lineitem)
        SELECT merchant_id, mcc,
               CASE WHEN TRY_CAST(merchant_id AS BIGINT) IS NULL THEN 'merchant code is not a number'
                    ELSE 'category code is not a number' END AS reason,
               count(*) AS n_rows
        FROM r
        WHERE merchant_id <> '0' AND (TRY_CAST(merchant_id AS BIGINT) IS NULL OR TRY_CAST(mcc AS INTEGER) IS NULL)
        GROUP BY ALL""",
    "freshness_gate": f"""
        WITH {_daily(DENIED)}
        SELECT count(*) AS rows, count(*) > 0 AS fresh FROM daily WHERE day = DATE '{SHIPPING}' - 1""",
    "first_seen_days": f"""
        WITH {_daily(DENIED)}
        SELECT mcc, merchant_id, CAST(min(day) AS VARCHAR) AS first_day FROM daily GROUP BY mcc, merchant_id""",
    "dense_days": f"""
        WITH {_dense(DENIED, SHIPPING)}
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, total FROM dense""",
    "calendar_features": f"""
        WITH {_daily(DENIED)}, d AS (SELECT day, CAST(sum(total) AS BIGINT) AS total FROM daily GROUP BY day)
        SELECT CAST(day AS VARCHAR) AS day, total, {CALENDAR} FROM d""",
    "lag_features": f"""
        WITH {_dense(DENIED, SHIPPING)}, l AS (SELECT *, {LAGS} FROM dense {WINDOWS})
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, total, {_filled(LAG_NAMES)} FROM l""",
    "rolling_features": f"""
        WITH {_dense(DENIED, SHIPPING)},
        l AS (SELECT *, {ROLLING}, avg(total) OVER w30 AS ma_30 FROM dense {WINDOWS})
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, total, {_filled(ROLLING_NAMES + ["ma_30"], True)} FROM l""",
    "optional_features": f"""
        WITH {_dense(EVENT_ROWS, EVENTS)},
        l AS (SELECT *, lag(total, 1) OVER w AS lag_1, lag(total, 4) OVER w AS lag_4,
                     lag(total, 180) OVER w AS lag_180, lag(total, 365) OVER w AS lag_365,
                     avg(total) OVER w4 AS ma_4, avg(total) OVER w7 AS ma_7,
                     lag(total, 1) OVER w / (avg(total) OVER w7 + 1) AS ratio_week
              FROM dense {WINDOWS})
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, total,
               {_filled(["lag_1", "lag_4", "lag_180", "lag_365"])}, {_filled(["ma_4", "ma_7", "ratio_week"], True)}
        FROM l""",
    "feature_table_current": f"""
        WITH {_features(DENIED, SHIPPING)}
        {_feature_select("features")} WHERE features.day >= DATE '{SHIPPING}' - 60""",
    "feature_table_full": f"WITH {_features(EVENT_ROWS, EVENTS)} {_feature_select('features')}",
    "expanding_mean": f"""
        WITH {_dense(EVENT_ROWS, EVENTS)}
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, total,
               round(avg(total) OVER (PARTITION BY mcc, merchant_id ORDER BY day), 6) AS mean_so_far
        FROM dense WHERE day < DATE '{EVENTS}'""",
    "recent_history": f"""
        WITH {_dense(DENIED, SHIPPING)}
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, total FROM (
          SELECT *, row_number() OVER (PARTITION BY mcc, merchant_id ORDER BY day DESC) AS newest FROM dense)
        WHERE newest <= 15""",
    "merchant_best_row": f"""
        WITH {BEST_ROWS}
        SELECT merchant_id, tax_id, CAST(mcc AS VARCHAR) AS mcc, trade_name, CAST(day AS VARCHAR) AS day FROM best""",
    "merchant_special_accounts": f"""
        WITH {BEST_ROWS}
        SELECT b.tax_id, b.merchant_id, CAST(b.mcc AS VARCHAR) AS mcc, CAST(a.id AS VARCHAR) AS account_id, b.trade_name
        FROM best b LEFT JOIN ({fx.SPECIAL_ACCOUNTS_SQL}) a ON a.tax_id = b.tax_id""",
    "scoring_merchant_rows": f"WITH {KNOWN_MERCHANTS} SELECT mcc, merchant_id, trade_name, tax_id, notify_emails FROM known",
    "prediction_row_features": f"""
        WITH {PREDICTION_ROWS}, {KNOWN_MERCHANTS},
        f AS ({_feature_select("rows_to_score")})
        SELECT f.*, k.trade_name, k.tax_id, k.notify_emails
        FROM f LEFT JOIN known k ON k.mcc = f.mcc AND k.merchant_id = f.merchant_id""",
    "score_fixed_model": f"""
        WITH {DECIDED}
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, round(prediction, 6) AS prediction FROM decided""",
    "unscorable_mccs": f"""
        WITH {PREDICTION_ROWS}, models AS ({fx.MODELS_SQL})
        SELECT mcc FROM models WHERE mcc NOT IN (-1, 0) AND mcc NOT IN (SELECT mcc FROM rows_to_score)""",
    "alerts": f"""
        WITH {DECIDED}
        SELECT tax_id, CAST(merchant_id AS VARCHAR) AS merchant_id, mcc, CAST(day AS VARCHAR) AS day,
               round(prediction, 6) AS prediction, notify
        FROM decided""",
    "alert_chart": f"WITH {CHARTS} "
                   "SELECT mcc, merchant_id, rounded, labels, data FROM charts",
    "alert_messages": f"""
        WITH {CHARTS}
        SELECT mcc, CAST(0 AS INTEGER) AS notification_id,
               array_to_string([trim(e) for e in string_split(notify_emails, '|')], ';') AS to_list,
               CAST(0 AS INTEGER) AS n_cc, '10014' AS template_id, merchant_id AS code, rounded AS prediction,
               trade_name AS d_code, tax_id AS ruc, labels, data, CAST(0 AS INTEGER) AS n_attachments
        FROM charts WHERE notify_emails IS NOT NULL""",
    "backtest_errors": f"""
        WITH {RANGE}
        SELECT mcc, count(*) AS n_rows, count(*) FILTER (prediction IS NULL) AS n_unusable, count(DISTINCT day) AS n_days, round(avg(abs(expected - total)), 6) AS mae,
               round(sqrt(avg((expected - total) * (expected - total))), 6) AS rmse,
               round(avg(expected - total), 6) AS bias
        FROM scored GROUP BY mcc""",
    "forecast_days": f"""
        WITH {RANGE}
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, total, round(prediction, 6) AS prediction, notify
        FROM scored""",
    "backfill_messages": f"""
        WITH {_features(EVENT_ROWS, fx.BACKTEST_DAYS[1])},
        range_rows AS (
          SELECT * FROM features WHERE day BETWEEN DATE '{fx.BACKTEST_DAYS[0]}' AND DATE '{fx.BACKTEST_DAYS[1]}' AND known),
        {KNOWN_MERCHANTS}, {_scored("range_rows")},
        points AS (
          SELECT s.mcc, s.merchant_id, s.day AS alert_day, d.day, d.total
          FROM scored s JOIN dense d ON d.mcc = s.mcc AND d.merchant_id = s.merchant_id AND d.day BETWEEN s.day - 15 AND s.day - 1
          WHERE s.notify),
        history AS (
          SELECT mcc, merchant_id, alert_day, string_agg({LABEL}, ',' ORDER BY day) AS past_labels,
                 string_agg(CAST(total AS VARCHAR), ',' ORDER BY day) AS past_data
          FROM points GROUP BY mcc, merchant_id, alert_day)
        SELECT s.mcc, CAST(s.day AS VARCHAR) AS day, array_to_string([trim(e) for e in string_split(k.notify_emails, '|')], ';') AS to_list,
               s.merchant_id AS code, CAST(round_even(s.expected, 0) AS BIGINT) AS prediction, k.trade_name AS d_code,
               h.past_labels || ',' || {LABEL.replace("day", "s.day").replace("s.dayof", "dayof")} AS labels,
               h.past_data || ',' || CAST(CAST(round_even(s.expected, 0) AS BIGINT) AS VARCHAR) AS data
        FROM scored s JOIN known k ON k.mcc = s.mcc AND k.merchant_id = s.merchant_id
        JOIN history h ON h.mcc = s.mcc AND h.merchant_id = s.merchant_id AND h.alert_day = s.day
        WHERE s.notify AND s.prediction IS NOT NULL AND k.notify_emails IS NOT NULL""",
    "watched_events": f"""
        SELECT count(*) AS events,
               count(*) FILTER (mcc_no IS NULL OR merchant_no IS NULL) AS rejected,
               count(*) FILTER (mcc_no IS NOT NULL AND merchant_no IS NOT NULL AND day = DATE '{fx.WATCHED_DAY}' - 1) AS fresh
        FROM (SELECT CASE WHEN l_linenumber = 2 THEN NULL ELSE TRY_CAST(l_suppkey AS BIGINT) END AS merchant_no,
                     CASE WHEN l_linenumber = 1 THEN TRY_CAST(l_linestatus AS INTEGER) ELSE 5411 END AS mcc_no,
                     CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_suppkey <> 0 OR l_linenumber = 2)""",
    "train_tweedie_cell_means": f"""
        WITH {_features(EVENT_ROWS, fx.BACKTEST_DAYS[1])}
        SELECT mcc, CAST(is_weekend AS INTEGER) AS is_weekend, round(avg(total), 6) AS mean_total FROM features GROUP BY ALL""",
    "tree_feature_bins": f"""
        WITH {TRAINING_VALUES}{_bins(SINGLE_TREE.max_bin, [*CATEGORICAL_FEATURES, "merchant_id"])}
        SELECT mcc, feature, bin, round(low, 6) AS low, round(high, 6) AS high, n_rows FROM bins""",
    "train_tree_first_cut": f"""
        WITH {TRAINING_VALUES}{_bins(DAILY.max_bin, CATEGORICAL_FEATURES)},
        starts AS (SELECT mcc, ln(avg(total)) AS s0 FROM features GROUP BY mcc),
        cells AS (
          SELECT b.mcc, b.feature, b.bin, count(*) AS n, sum(l.total) AS sy, any_value(s0) AS s0
          FROM long l JOIN bins b ON b.mcc = l.mcc AND b.feature = l.feature AND l.value BETWEEN b.low AND b.high JOIN starts s ON s.mcc = l.mcc
          GROUP BY b.mcc, b.feature, b.bin),
        placed AS (
          SELECT *, {_G} AS g, {_H} AS h, CASE WHEN feature IN ({_SINGLE}) THEN {_G} / ({_H} + {DAILY.l2}) ELSE bin END AS place FROM cells),
        sides AS (
          SELECT mcc, sum(n) OVER w AS nl, sum(n) OVER f - sum(n) OVER w AS nr, sum(g) OVER w AS gl, sum(g) OVER f - sum(g) OVER w AS gr,
                 sum(h) OVER w AS hl, sum(h) OVER f - sum(h) OVER w AS hr
          FROM placed WINDOW w AS (PARTITION BY mcc, feature ORDER BY place, bin), f AS (PARTITION BY mcc, feature)),
        cuts AS (SELECT mcc, {_CUT_COLUMNS} FROM sides WHERE nl >= {DAILY.min_rows} AND nr >= {DAILY.min_rows})
        SELECT * FROM cuts WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY mcc ORDER BY gain DESC, fewer_rows) = 1""",
    "train_tree_category_cut": f"""
        WITH {_dense(DENIED, SHIPPING)},
        starts AS (SELECT mcc, ln(avg(total)) AS s0 FROM dense GROUP BY mcc),
        cells AS (SELECT d.mcc, CAST(month(day) AS INTEGER) AS month, count(*) AS n, sum(total) AS sy, any_value(s0) AS s0 FROM dense d JOIN starts s ON s.mcc = d.mcc GROUP BY ALL),
        placed AS (SELECT *, {_G} AS g, {_H} AS h FROM cells),
        sets AS (SELECT unnest(range(1, 2048)) AS months),
        sides AS (
          SELECT mcc, months, coalesce(sum(n) FILTER (inside), 0) AS nl, coalesce(sum(n) FILTER (NOT inside), 0) AS nr, sum(g) FILTER (inside) AS gl, sum(g) FILTER (NOT inside) AS gr,
                 sum(h) FILTER (inside) AS hl, sum(h) FILTER (NOT inside) AS hr
          FROM (SELECT *, (months >> (month - 1)) & 1 = 1 AS inside FROM placed CROSS JOIN sets) GROUP BY mcc, months),
        cuts AS (SELECT mcc, {_FREE_COLUMNS} FROM sides WHERE nl >= 1 AND nr >= 1)
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY mcc ORDER BY gain DESC, fewer_rows) = 1""",
    "train_tree_cell_steps": f"""
        WITH {_features(EVENT_ROWS, fx.BACKTEST_DAYS[1])},
        starts AS (SELECT mcc, ln(avg(total)) AS s0 FROM features GROUP BY mcc),
        cells AS (SELECT f.mcc, is_weekend, count(*) AS n, sum(total) AS sy, any_value(s0) AS s0 FROM features f JOIN starts s ON s.mcc = f.mcc GROUP BY ALL)
        SELECT mcc, is_weekend, round(exp(s0 - {_G} / {_H}), 6) AS expected FROM cells WHERE mcc NOT IN (-1, 0)""",
    "one_side_sampled_rows": f"""
        WITH {_features(EVENT_ROWS, fx.BACKTEST_DAYS[1])},
        sized AS (
          SELECT *, CASE WHEN abs(total - ma_7) > 0 THEN floor(log2(abs(total - ma_7)) * {LEVELS}) ELSE {LOWEST_LEVEL} END AS level FROM features),
        ranked AS (SELECT *, rank() OVER (PARTITION BY mcc ORDER BY level DESC) AS place, count(*) OVER (PARTITION BY mcc) AS all_rows FROM sized),
        limits AS (
          SELECT mcc, level AS top_level, n AS top, all_rows FROM (
            SELECT mcc, level, any_value(all_rows) AS all_rows, any_value(place) + count(*) - 1 AS n FROM ranked GROUP BY mcc, level)
          WHERE n >= ceil(all_rows * {TOP_SHARE}) QUALIFY row_number() OVER (PARTITION BY mcc ORDER BY level DESC) = 1),
        drawn AS (
          SELECT r.* EXCLUDE (top), r.all_rows - top AS other_rows, least(r.all_rows * {OTHER_SHARE}, r.all_rows - top) AS wanted,
                 CAST('0x' || substr(md5(CAST(merchant_id AS VARCHAR) || '|' || CAST(day AS VARCHAR) || '|{SAMPLE_SEED}'), 1, 8) AS BIGINT) / 4294967296.0 AS place01
          FROM (SELECT r.*, top_level, top FROM ranked r JOIN limits l ON l.mcc = r.mcc) r),
        kept AS (
          SELECT mcc, total, CASE WHEN level >= top_level THEN 1.0 ELSE other_rows / wanted END AS weight
          FROM drawn WHERE level >= top_level OR place01 * other_rows < wanted)
        SELECT mcc, count(*) AS kept_rows, CAST(sum(total) AS BIGINT) AS kept_total, round(sum(CAST(weight AS DOUBLE)), 6) AS weight FROM kept GROUP BY mcc""",
    "score_fixed_trees": f"""
        WITH {PREDICTION_ROWS}
        SELECT mcc, merchant_id, CAST(day AS VARCHAR) AS day, round(prediction, 6) AS prediction
        FROM (SELECT *, round({fx.TREE_SCORE_SQL}, 10) AS prediction FROM rows_to_score r WHERE mcc IN (6300, 5411))""",
    "training_category_rows": f"""
        WITH {_dense(DENIED, SHIPPING)} SELECT mcc, count(*) AS n_rows FROM dense GROUP BY mcc""",
    "sampled_training_rows": f"""
        WITH {_dense(DENIED, SHIPPING)},
        sizes AS (SELECT mcc, count(*) AS n FROM dense GROUP BY mcc)
        SELECT d.mcc, d.merchant_id, count(*) AS kept_rows, CAST(sum(total) AS BIGINT) AS kept_total
        FROM dense d JOIN sizes s ON s.mcc = d.mcc
        WHERE s.n < 20000 OR CAST('0x' || substr(md5(
          CAST(d.mcc AS VARCHAR) || '|' || CAST(d.merchant_id AS VARCHAR) || '|' || CAST(d.day AS VARCHAR) || '|42'), 1, 8)
          AS BIGINT) < CAST(floor(0.2 * 4294967296) AS BIGINT)
        GROUP BY d.mcc, d.merchant_id""",
}
