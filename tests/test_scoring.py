import hashlib
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from countcast.columns import MODEL_SCHEMA, PREDICTION_SCHEMA
from countcast.functions.messages import decode_message
from countcast.operators.alerts import alert_charts, outbox, prediction_table, with_notify
from countcast.operators.backtest import forecast_errors
from countcast.operators.features import feature_table, prediction_rows
from countcast.operators.merchants import (
    best_merchant_rows, merchant_attributes, one_account_per_tax_id, scoring_merchants, with_account_id,
)
from countcast.operators.sampling import thin_large_categories
from countcast.operators.scoring import eligible_models, feature_matrix, score, unscorable_models, unusable, usable
from countcast.sinks.outbox import send_outbox
from tests.helpers import d, daily, ts


def models(spark, *rows):
    return spark.createDataFrame([(mcc, list(w), [float(x) for x in w.values()], b0, 1) for mcc, b0, w in rows], MODEL_SCHEMA)


def history(spark):
    return daily(spark, *[("7", f"2024-01-{i:02d}", i, 6300) for i in range(1, 21)],
                 *[("8", f"2024-01-{i:02d}", 1, 4816) for i in range(1, 21)],
                 ("9", "2024-01-10", 1, -1))


def test_each_model_uses_its_own_features(spark):
    rows = prediction_rows(history(spark), "2024-01-21")
    given = models(spark, (6300, 0.5, {"lag_1": 0.1, "dow": -0.2}), (4816, 1.0, {"ma_7": 0.3}), (-1, 1.0, {}), (0, 1.0, {}), (9999, 1.0, {}))
    got = {r.mcc: r for r in score(rows, given).collect()}
    assert set(got) == {6300, 4816}
    assert got[6300].expected == pytest.approx(math.exp(0.5 + 0.1 * 20 - 0.2 * 1))
    assert got[4816].expected == pytest.approx(math.exp(1.3))
    assert got[4816].prediction == Decimal(str(got[4816].expected)).quantize(Decimal("0.0000000001"))
    assert {r.mcc for r in unscorable_models(given, rows).collect()} == {9999}
    assert {r.mcc for r in eligible_models(given).collect()} == {6300, 4816, 9999}


def test_unknown_feature_fails(spark):
    rows = prediction_rows(history(spark), "2024-01-21")
    with pytest.raises(Exception, match="unknown model features: moon"):
        score(rows, models(spark, (6300, 0.5, {"moon": 0.1}))).collect()


def test_too_large_predictions_are_set_apart(spark):
    scored = score(prediction_rows(history(spark), "2024-01-21"), models(spark, (6300, 400.0, {}), (4816, 1.0, {})))
    assert [r.mcc for r in usable(scored).collect()] == [4816]
    assert [(r.mcc, r.merchant_id) for r in unusable(scored).collect()] == [(6300, 7)]


def test_one_row_can_be_scored_by_hand(spark):
    row = spark.createDataFrame([(6300, 99, 69.28571428571429)], "mcc int, lag_1 bigint, ma_7 double")
    got = score(row, models(spark, (6300, 1.0, {"lag_1": 0.01, "ma_7": 0.02})), ["lag_1", "ma_7"]).first()
    assert got.expected == pytest.approx(math.exp(1 + 0.99 + 0.02 * 69.28571428571429))
    assert feature_matrix(row, ["ma_7", "lag_1"]).first().x == [69.28571428571429, 99.0]


@pytest.mark.parametrize("prediction, mean, notify", [
    ("5.0000000000", 5.0, True), ("4.9999999999", 1.0, False), ("6.0000000000", 0.0, False),
    ("7.0000000000", 7.1, False), ("69.2857142857", 69.28571428571429, False), ("69.2857142858", 69.28571428571429, True),
])
def test_alert_rule(spark, prediction, mean, notify):
    df = spark.createDataFrame([(Decimal(prediction), mean)], "prediction decimal(18,10), ma_7 double")
    assert with_notify(df).first().notify is notify


def alert_rows(spark, expected=2.5):
    return spark.createDataFrame(
        [(6300, 7, d("2024-10-02"), expected, "Shop", None, " a@x.com | b@x.com "),
         (6300, 8, d("2024-10-02"), 3.5, None, "20", None), (6300, 9, d("2024-10-02"), 3.5, None, "20", "")],
        "mcc int, merchant_id bigint, day date, expected double, trade_name string, tax_id string, notify_emails string")


def dense_rows(spark):
    return spark.createDataFrame(
        [(6300, m, d(day), n) for m in (7, 8, 9)
         for day, n in [("2024-09-30", 4), ("2024-10-01", 0), ("2024-09-29", 12), ("2024-10-02", 99), ("2024-09-01", 50)]],
        "mcc int, merchant_id bigint, day date, total bigint")


def test_charts_show_the_last_days_and_the_forecast(spark):
    got = {r.merchant_id: r for r in alert_charts(alert_rows(spark), dense_rows(spark), "2024-10-02", days=3).collect()}
    assert got[7].labels == "'SET-29','SET-30','OCT-1','OCT-2'"
    assert (got[7].data, got[8].data) == ("12,4,0,2", "12,4,0,4")  # halves round to even


def test_messages_go_to_merchants_with_addresses(spark):
    sent = outbox(alert_charts(alert_rows(spark), dense_rows(spark), "2024-10-02", days=3))
    assert "\n" not in sent.first().message
    m = sent.select(decode_message(F.col("message")).alias("m")).collect()
    assert len(m) == 1
    m = m[0].m
    assert (m.notification_id, m.to, m.cc, m.template_id, m.attachments) == (0, ["a@x.com", "b@x.com"], [], "10014", [])
    data = m.template_data
    assert (data.code, data.prediction, data.dCode, data.ruc, data.data) == (7, 2, "Shop", None, "12,4,0,2")


def test_sender_gets_every_message(spark, tmp_path):
    target = str(tmp_path)

    def send(messages):
        import uuid
        with open(f"{target}/{uuid.uuid4()}", "w") as out:
            out.write("".join(f"{m}\n" for m in messages))

    send_outbox(spark.createDataFrame([("a",), ("b",), ("c",)], "message string"), send)
    assert sorted("".join(p.read_text() for p in tmp_path.iterdir()).split()) == ["a", "b", "c"]


def test_prediction_table_schema(spark):
    row = spark.createDataFrame([("2", 7, 6300, d("2024-01-01"), Decimal("1.5"), True)],
                                "tax_id string, merchant_id bigint, mcc int, day date, prediction decimal(18,10), notify boolean")
    assert [(f.name, f.dataType) for f in prediction_table(row).schema] == [(f.name, f.dataType) for f in PREDICTION_SCHEMA]


def test_forecast_errors(spark):
    df = spark.createDataFrame([(1, d("2024-01-01"), 4, 5.0, 5.0), (1, d("2024-01-02"), 4, 1.0, 1.0), (1, d("2024-01-02"), 4, 1e30, None)],
                               "mcc int, day date, total bigint, expected double, prediction double")
    got = forecast_errors(df).first()
    assert (got.n_rows, got.n_unusable, got.n_days, got.mae, got.bias) == (3, 1, 2, 2.0, -1.0)
    assert got.rmse == pytest.approx(math.sqrt(5))


def test_best_merchant_row(spark):
    tx = spark.createDataFrame([
        (20123456789.0, " 1", "4000", "New", ts("2024-02-01")), (20123456789.0, "1", "4000", "Old", ts("2024-01-01")),
        (None, "1", "4000", "Newest", ts("2024-03-01")), (None, "2", None, None, ts("2024-03-01")),
    ], "tax_id double, merchant_id string, mcc string, trade_name string, event_ts timestamp")
    denied = spark.createDataFrame([("2", "x", "Name", ts("2024-04-01")), ("2", "77", None, ts("2024-01-01"))],
                                   "merchant_id string, mcc string, trade_name string, event_ts timestamp")
    best = best_merchant_rows(merchant_attributes([tx, denied]))
    assert {tuple(r) for r in best.collect()} == {
        ("1", "20123456789", 4000, "New", d("2024-02-01")), ("2", None, 77, "SIN NOMBRE COMERCIAL", d("2024-01-01"))}
    accounts = spark.createDataFrame([(5, "20123456789"), (6, "20123456789")], "id int, tax_id string")
    linked = with_account_id(best, accounts)
    assert sorted((r.merchant_id, r.account_id or 0) for r in linked.collect()) == [("1", 5), ("1", 6), ("2", 0)]


def test_scoring_merchants_are_unique(spark):
    master = spark.createDataFrame([
        ("7", None, None, 6300), ("007", "Shop", "20", 6300), ("X1", "Bad", "20", 6300), ("7", "Other", "21", 5411), ("7", "No model", "21", 1)],
        "merchant_id string, trade_name string, tax_id string, mcc int")
    accounts = spark.createDataFrame([(2, "20", None), (3, "20", "a@x"), (1, "21", None)], "id int, tax_id string, notify_emails string")
    known = scoring_merchants(master, accounts, models(spark, (6300, 1.0, {}), (5411, 1.0, {})))
    assert {tuple(r) for r in known.collect()} == {(6300, 7, "Shop", "20", "a@x"), (5411, 7, "Other", "21", None)}
    assert one_account_per_tax_id(accounts).count() == 2


def test_sampling_thins_only_large_categories(spark):
    features = feature_table(history(spark), "2024-03-31")
    kept = {(r.mcc, r.day) for r in thin_large_categories(features, threshold=91, share=0.3).collect()}
    rows = [(r.mcc, r.merchant_id, r.day) for r in features.collect()]

    def drawn(mcc, merchant, day):
        digest = hashlib.md5(f"{mcc}|{merchant}|{day}|42".encode()).hexdigest()
        return int(digest[:8], 16) < int(0.3 * 2**32)

    assert kept == {(mcc, day) for mcc, m, day in rows if mcc == -1 or drawn(mcc, m, day)}
    assert len(kept) < len(rows)
