"""Hand-built frames for rules, windows, as-of joins, merges and metrics."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sluice.functions import predicates as P
from sluice.functions import typing as Ty
from sluice.operators import features as Fe
from sluice.operators import latest as L
from sluice.operators import market as M
from sluice.operators import metrics as Me
from sluice.operators import quality as Q
from sluice.operators import scoring as S
from sluice.sources import sinks
from sluice.sources.tables import conform, inspect_layout, row_bytes, schema_problems

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_reasons_keep_their_order_and_come_once(spark):
    rows = spark.createDataFrame([(1, None, "XX"), (2, "a", "US"), (3, " ", "us")], "id int, name string, country string")
    rules = Q.TableRules(required=("name",), countries=("country",), allowed={"country": ["US", "XX"]}).rules(rows)
    out = {r.id: list(r[Q.REASONS]) for r in Q.with_reasons(Q.with_reasons(rows, rules), rules).collect()}
    assert out == {1: ["name_required"], 2: [], 3: ["name_required", "country_country_code_format", "country_approved_value"]}
    assert Q.quarantined_rows(Q.with_reasons(
        rows,
        rules,
    )).filter("id = 3").head()["quarantine_reason"] == "name_required;country_country_code_format;country_approved_value"


def test_array_rules(spark):
    rows = spark.createDataFrame([(["BTC"],), (["BTC", "BTC"],), ([None],), ([],), (None,)], "a array<string>")
    rules = Q.TableRules(allowed_elements={"a": ["BTC", "ETH"]}, sizes={"a": (1, 2)}, unique_items=("a",)).rules(rows)
    assert [list(r[0]) for r in Q.with_reasons(rows, rules).select(Q.REASONS).collect()] == [
        [],
        ["a_unique_items"],
        ["a_approved_values"],
        ["a_array_size"],
        [],
    ]


def transaction(**changed):
    row = {
        "event_timestamp": at(0),
        "source_timestamp": at(1),
        "ingestion_timestamp": at(2),
        "crypto_quantity": 2.0,
        "market_price_usd": 10.0,
        "transaction_amount_usd": 20.0,
        "transaction_type": "TRANSFER",
        "source_wallet_id": "w1",
        "destination_wallet_id": "w2",
    } | changed
    return tuple(row.values())


SCHEMA = "event_timestamp timestamp, source_timestamp timestamp, ingestion_timestamp timestamp, crypto_quantity double, market_price_usd double, transaction_amount_usd double, transaction_type string, source_wallet_id string, destination_wallet_id string"


@pytest.mark.parametrize(
    ("changed", "reasons"),
    [
        ({}, []),
        ({"event_timestamp": at(5)}, ["event_timestamp_after_source_timestamp"]),
        ({"crypto_quantity": 0.0, "transaction_amount_usd": 0.0}, ["crypto_quantity_not_positive"]),
        ({"transaction_amount_usd": 20.02}, ["transaction_amount_mismatch_quantity_times_price"]),
        ({"destination_wallet_id": "w1"}, ["source_and_destination_wallet_identical"]),
        ({"transaction_type": "DEPOSIT", "source_wallet_id": None, "destination_wallet_id": None}, ["deposit_missing_destination_wallet_id"]),
        (
            {"source_wallet_id": None, "destination_wallet_id": None},
            ["outgoing_transaction_missing_source_wallet_id", "outgoing_transaction_missing_destination_wallet_id"],
        ),
    ],
)
def test_transaction_rules(spark, changed, reasons):
    rows = spark.createDataFrame([transaction(**changed)], SCHEMA)
    rows = rows.withColumns({c: F.col(c).cast("decimal(20,8)") for c in ("crypto_quantity", "market_price_usd", "transaction_amount_usd")})
    assert list(Q.with_reasons(rows, Q.transaction_rules()).head()[Q.REASONS]) == reasons


def test_label_and_candle_rules(spark):
    labels = spark.createDataFrame(
        [(at(0), at(1), at(2), at(0), True, None, "CLEARED")],
        "event_timestamp timestamp, source_timestamp timestamp, ingestion_timestamp timestamp, label_timestamp timestamp, is_fraud boolean, fraud_type string, investigation_status string",
    )
    assert list(Q.with_reasons(labels, Q.label_rules()).head()[Q.REASONS]) == [
        "fraud_type_required_for_fraud",
        "cleared_status_requires_is_fraud_false",
    ]
    candles = spark.createDataFrame(
        [(1.0, 3.0, 2.0, 2.5, -1.0, 60, at(0), at(61))],
        "open_price_usd double, high_price_usd double, low_price_usd double, close_price_usd double, volume double, granularity_seconds int, candle_start_timestamp timestamp, candle_end_timestamp timestamp",
    )
    assert list(Q.with_reasons(candles, Q.candle_rules()).head()[Q.REASONS]) == [
        "volume_negative",
        "candle_end_not_start_plus_60_seconds",
        "low_price_above_ohlc_values",
    ]


def test_bad_parents_take_their_children_along(spark):
    reasons = F.array().cast("array<string>")
    accounts = Q.with_reasons(spark.createDataFrame([("a1", 1), ("a2", -1)], "account_id string, v int"), [Q.Rule("v", F.col("v") < 0)])
    frame = lambda data, schema: spark.createDataFrame(data, schema).withColumn(Q.REASONS, reasons)
    tables = {
        "accounts": accounts,
        "devices": frame([("d1", "a1"), ("d2", "a2"), ("d3", None)], "device_id string, primary_account_id string"),
        "wallets": frame([("w1", "a1", "CUSTOMER"), ("w2", None, "EXTERNAL")], "wallet_id string, owner_account_id string, wallet_type string"),
        "transactions": frame(
            [
                ("t1", "a1", "d1", "TRANSFER", "w1", "w2", at(0)),
                ("t2", "a1", "d2", "DEPOSIT", None, "w2", at(0)),
                ("t3", "a1", "d1", "WITHDRAWAL", "w9", "w2", at(0)),
            ],
            "transaction_id string, account_id string, device_id string, transaction_type string, source_wallet_id string, destination_wallet_id string, event_timestamp timestamp",
        ),
        "labels": frame(
            [("l1", "t1", at(-5)), ("l2", "t1", at(5)), ("l3", "t2", at(5))],
            "event_id string, transaction_id string, label_timestamp timestamp",
        ),
    }
    out = Q.cascade(tables)
    found = {n: {r[0]: list(r[1]) for r in out[n].select(out[n].columns[0] if n != "x" else "", Q.REASONS).collect()} for n in ("transactions",)}
    by = {r["transaction_id"]: list(r[Q.REASONS]) for r in out["transactions"].collect()}
    assert by == {
        "t1": [],
        "t2": ["device_not_found", "destination_wallet_not_of_a_customer"],
        "t3": ["source_wallet_not_found", "source_wallet_not_of_a_customer"],
    }
    assert {r["event_id"]: list(r[Q.REASONS]) for r in out["labels"].collect()} == {
        "l1": ["label_before_transaction"],
        "l2": [],
        "l3": ["transaction_not_found"],
    }
    assert found


def test_duplicates_are_counted_two_ways(spark):
    rows = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert Q.duplicate_extra_rows(rows, "k").head()[0] == 2
    assert Q.duplicate_keys(rows, "k").head()[0] == 2


@pytest.mark.parametrize(
    ("n", "unit"),
    [(1_704_067_200, "s"), (1_704_067_200_000, "ms"), (1_704_067_200_000_000, "us"), (1_704_067_200_000_000_000, "ns")],
)
def test_epoch_units(spark, n, unit):
    out = spark.createDataFrame([(n,)], "n long").select(Ty.epoch_unit(F.col("n")), Ty.epoch_to_timestamp(F.col("n")).cast("timestamp_ntz")).head()
    assert tuple(out) == (unit, T0)


def test_windows_are_strictly_prior(spark):
    rows = spark.createDataFrame(
        [(1, "a", at(0), 1.0), (2, "a", at(0.4), 1.0), (3, "a", at(1), 1.0), (4, "a", at(3600), 1.0), (5, "a", at(3601), 1.0)],
        "id int, k string, ts timestamp, v double",
    )
    out = {r.id: r.prior_count_1h for r in Fe.velocity(rows, "k", "ts", "v", {"1h": 3600}).collect()}
    assert out == {1: 0, 2: 0, 3: 2, 4: 3, 5: 2}  # an event exactly an hour old counts, one of the same second does not
    fine = {r.id: r.prior_count_1h for r in Fe.velocity(rows, "k", "ts", "v", {"1h": 3600}, "us").collect()}
    assert fine == {1: 0, 2: 1, 3: 2, 4: 3, 5: 2}


def test_missing_counterparties_have_no_history(spark):
    rows = spark.createDataFrame([(1, None, at(0)), (2, None, at(5)), (3, "w", at(1)), (4, "w", at(2))], "id int, w string, ts timestamp")
    out = {r.id: (r.prior_wallet_count, r.is_new_wallet, r.wallet_applicable) for r in Fe.counterparty_history(rows, "w", "ts", "wallet").collect()}
    assert out == {1: (0, None, 0), 2: (0, None, 0), 3: (0, 1, 1), 4: (1, 0, 1)}


def test_as_of_takes_the_last_completed_candle(spark):
    candles = spark.createDataFrame([("p", at(60 * i), 100.5 + i) for i in range(1, 4)], "product string, candle_end timestamp, close double")
    rows = spark.createDataFrame(
        [(1, "p", at(150)), (2, "p", at(60)), (3, "p", at(59)), (4, "q", at(500))],
        "id int, product_id string, ts timestamp",
    )
    out = {r.id: (r.close, r.freshness_seconds, r.market_data_available) for r in M.as_of(
        rows,
        candles,
        "product_id",
        "ts",
        "product",
        "candle_end",
        ["close"],
    ).collect()}
    assert out == {1: (102.5, 30, 1), 2: (101.5, 0, 1), 3: (None, None, 0), 4: (None, None, 0)}


def test_gaps_are_exactly_the_missing_points(spark):
    rows = spark.createDataFrame([("p", at(60 * i)) for i in (0, 1, 3, 3)], "product string, ts timestamp")
    assert [r.ts for r in Q.gaps(rows, "product", "ts", "1 minute").collect()] == [at(120)]


def test_label_resolution_breaks_ties_by_id(spark):
    rows = spark.createDataFrame(
        [
            ("t", "e1", True, "CONFIRMED_FRAUD", at(1)),
            ("t", "e2", False, "CLEARED", at(1)),
            ("t", "e3", True, "INCONCLUSIVE", at(9)),
            ("u", "e4", None, "CLEARED", at(1)),
        ],
        "transaction_id string, event_id string, is_fraud boolean, investigation_status string, label_timestamp timestamp",
    )
    rows = rows.withColumn("ingestion_timestamp", F.col("label_timestamp")).withColumn("source_timestamp", F.col("label_timestamp"))
    assert [(r.transaction_id, r.event_id) for r in L.resolve_labels(rows).collect()] == [("t", "e2")]


def test_upsert_matches_null_keys(spark):
    t = spark.createDataFrame([(None, 1, "a"), (1, 1, "b"), (2, 2, "c")], "k int, v int, h string")
    s = spark.createDataFrame([(None, 9, "x"), (1, 1, "b"), (3, 3, "d")], "k int, v int, h string")
    out = {(r.k, r.v, r._action) for r in sinks.upsert(t, s, ["k"], "h").collect()}
    assert out == {(None, 9, "update"), (1, 1, "unchanged"), (2, 2, "keep"), (3, 3, "insert")}


@pytest.mark.parametrize(
    ("scores", "ap", "auc"),
    [([(1, 0.9), (0, 0.9), (1, 0.1)], (0.5 * 0.5 + 0.5 * 2 / 3), 0.25), ([(1, 0.9), (0, 0.1)], 1.0, 1.0), ([(1, 0.9), (1, 0.1)], None, None)],
)
def test_average_precision_and_auc(spark, scores, ap, auc):
    rows = spark.createDataFrame(scores, "y int, s double")
    assert Me.average_precision(rows, "y", "s").head()[0] == (None if ap is None else pytest.approx(ap))
    assert Me.roc_auc(rows, "y", "s").head()[0] == (None if auc is None else pytest.approx(auc))


def test_threshold_choice_falls_back_to_recall(spark):
    rows = spark.createDataFrame([(True, 0.35), (False, 0.9), (False, 0.2)], "y boolean, s double")
    assert Me.chosen_threshold(Me.threshold_sweep(rows, F.col("y"), F.col("s"))).head()["threshold"] == 0.3


def test_alerts_need_a_flag(spark):
    rows = spark.createDataFrame(
        [
            ("fraud_decision", True, 0.8, None),
            ("fraud_decision", None, 0.9, None),
            ("fraud_label", True, 0.9, None),
            ("fraud_decision", True, None, 0.9),
            ("fraud_decision", True, 0.79, 0.9),
        ],
        "event_type string, predicted boolean, fraud_probability double, risk_score double",
    )
    rows = rows.withColumn("transaction_id", F.lit("t")).withColumn("event_id", F.lit("e")).withColumn("decision", F.lit(None).cast("string"))
    assert sorted(r.probability for r in S.alerts(rows, 0.8).collect()) == [0.8, 0.9]


def test_reason_codes_only_for_predicted(spark):
    rows = spark.createDataFrame(
        [(True, 1, 4.0), (False, 1, 9.0), (True, None, None)],
        "p boolean, is_new_device_24h int, amount_to_normal_ratio double",
    )
    assert [list(r[0]) for r in rows.select(S.reason_codes(F.col("p"), rows.columns)).collect()] == [["NEW_DEVICE", "UNUSUAL_AMOUNT"], [], []]


def test_rescue_and_schema_checks(spark, tmp_path):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = spark.createDataFrame([("1", "x", "extra"), ("zz", None, None)], "a string, b string, c string")
    out = [tuple(r) for r in conform(rows, want).collect()]
    assert out == [(1, "x", '{"c":"extra"}'), (None, None, '{"a":"zz"}')]
    assert schema_problems(rows, want) == {"missing": [], "unexpected": ["c"], "mistyped": ["a"]}
    assert row_bytes(want) == 68
    sinks.write_partitioned(rows, str(tmp_path / "t"), "b")
    layout = inspect_layout(spark, str(tmp_path / "t"))
    assert layout.files == 2 and layout.partitions == ["b"]


def test_names_of_the_future_are_found():
    assert P.leaking_columns(["amount", "is_fraud", "label_time", "decision_count", "label_timestamp"]) == ["is_fraud", "label_timestamp"]
    assert P.is_indicator_name("is_new") and not P.is_indicator_name("amount")
    assert Q.failed_paths({"a": {"b": False, "c": True}, "d": False}) == ["a.b", "d"]
    assert M.request_windows(0, 40000, 60, 300) == [(0, 18000), (18000, 36000), (36000, 40000)]


def test_master_rules_and_run_log(spark, tmp_path):
    rows = spark.createDataFrame(
        [(at(5), at(1), -1.0, 1.0)],
        "created_at timestamp, updated_at timestamp, normal_transaction_amount_usd double, normal_transaction_frequency_per_day double",
    )
    assert list(Q.with_reasons(rows, Q.master_rules("accounts")).head()[Q.REASONS]) == [
        "updated_at_before_created_at",
        "normal_transaction_amount_usd_negative",
    ]
    path = str(tmp_path / "log")
    sinks.log_run(spark, path, "r1", "t", 5, "append")
    sinks.log_run(spark, path, "r2", "t", 8, "append")
    assert sinks.latest_run(spark, path).head()["run_id"] == "r2"
    assert sinks.row_deltas(spark, path).head()["delta"] == 3


def test_reloaded_models_score_alike(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from sluice.operators import models

    rows = spark.createDataFrame(
        [(i, float(i % 7), "ab"[i % 2] if i % 5 else None, int(i % 7 > 3)) for i in range(200)] + [(200, None, "c", 0), (201, float("inf"), "a", 1)],
        "id int, x double, c string, y int",
    )
    model = models.fit_logistic(rows, ["x"], ["c"], "y", 50)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = ({r.id: r.score for r in models.scored(m, rows, ["x"], ["c"], "id").collect()} for m in (model, again))
    assert max(abs(a[i] - b[i]) for i in a) <= 1e-12 and len(a) == 202
    table = models.coefficients(model, models.cleaned(rows, ["x"], ["c"], "y")).collect()
    assert table[0].size >= table[-1].size and any("scaled" in r.name for r in table)


def test_offsets_and_alert_stream(spark, tmp_path):
    from sluice.streaming.pipelines import offset_deltas

    assert offset_deltas({"sources": [{"startOffset": '{"t": {"0": 5}}', "endOffset": '{"t": {"0": 9, "1": 2}}'}]}) == {"t": 6}
    assert offset_deltas({"sources": [{"startOffset": None, "endOffset": {"t": {"0": 3}}}]}) == {"t": 3}


def test_row_hashes_of_unlike_rows_differ(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("\\N", "c"), ("-", "c"), ("1:a", "c"), ("a", "c")], "a string, b string")
    assert rows.select(Ty.row_hash(["a", "b"])).distinct().count() == 7


def test_parity_counts_keys_of_one_side(spark):
    left = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "k int, x double")
    right = spark.createDataFrame([(1, 1.0), (3, None), (4, 4.0)], "k int, x double")
    r = Me.parity(left, right, "k", ["x"]).head()
    assert (r.exact, r.tolerance, r.mismatch, r.left_only, r.right_only, r.status) == (2, 0, 2, 1, 1, "MISMATCH")
    families = Me.parity_families(Me.parity(left, right, "k", ["x"]), {"f": ["x", "y"]}).collect()
    assert {(r.feature, r.static_status) for r in families} == {("x", "MAJOR-MISMATCH"), ("y", "NOT-VERIFIABLE")}


def test_as_of_carries_states_over_hours(spark):
    states = spark.createDataFrame(
        [("p", at(0), 1.0), ("p", at(3 * 3600), 2.0), (None, at(0), 9.0)],
        "product string, candle_end timestamp, close double",
    )
    rows = spark.createDataFrame(
        [(1, "p", at(2 * 3600 + 5)), (2, "p", at(3 * 3600)), (3, "p", at(90 * 3600)), (4, "p", at(-1)), (5, None, at(7200))],
        "id int, product_id string, ts timestamp",
    )
    join = lambda **k: M.as_of(rows, states, "product_id", "ts", "product", "candle_end", ["close"], **k)
    assert {r.id: r.close for r in join().collect()} == {1: 1.0, 2: 2.0, 3: 2.0, 4: None, 5: 9.0}
    with pytest.raises(Exception, match="no state at or before"):
        join(required=True).collect()


def test_distinct_accounts_of_a_busy_device(spark):
    import random

    r = random.Random(3)
    data = [(i, "d", r.choice("abcde"), at(r.randrange(4000))) for i in range(300)] + [(300, None, "a", at(5))]
    rows = spark.createDataFrame(data, "id int, device string, account string, ts timestamp")
    out = {x.id: (x.prior_events, x.distinct_accounts) for x in Fe.shared_entity(rows, "device", "ts", "account", 600).collect()}
    for i, d, _, t in data:
        prior = [x for x in data if x[1] is not None and x[1] == d and t - timedelta(seconds=600) <= x[3] < t]
        assert out[i] == (len(prior), len({x[2] for x in prior}))


def test_a_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_partitioned(spark.range(3).withColumn("d", F.lit(1)), path, "d")
    bad = spark.range(2).select(F.when(F.col("id") < 5, F.raise_error(F.lit("stop"))).cast("long").alias("id"), F.lit(1).alias("d"))
    with pytest.raises(Exception, match="stop"):
        sinks.write_partitioned(bad, path, "d")
    assert spark.read.parquet(path).count() == 3


def test_scores_that_crowd_near_zero(spark):
    rows = spark.range(4000).select(F.expr("cast(id % 7 = 0 as int)").alias("y"), (F.col("id") / 1e7).alias("s"))
    parts = Me._ordered_sums(rows, "y", "s").count()
    assert parts == 4000
    assert Me.roc_auc(rows, "y", "s").head()[0] == pytest.approx(0.5, abs=0.02)


def test_batches_are_appended_once(spark, tmp_path):
    from sluice.streaming.pipelines import append_new

    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 0, i, "x") for i in (1, 2, 2, 3)], "topic string, partition int, offset long, v string")
    keys = ["topic", "partition", "offset"]
    assert append_new(rows, path, keys, by=("topic",)) == 4
    append_new(
        rows.filter("offset > 1").unionByName(rows.filter("offset = 3").withColumn("offset", F.lit(9).cast("long"))),
        path,
        keys,
        by=("topic",),
    )
    assert sorted(r[0] for r in spark.read.parquet(path).select("offset").collect()) == [1, 2, 3, 9]
    assert append_new(rows.limit(0), path, keys) == 0
