"""Queries of feedback, reporting tables, metrics, splits and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import gold as G
from sluice.operators import latest as L
from sluice.operators import metrics as Me
from sluice.operators import scoring as S
from sluice.operators import splits as Sp
from sluice.sources.tables import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query and the SQL that checks it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# Roles: documents are transactions, (n_chars mod 100) / 100 is a decision's score, labels.toxic is the fraud label.
_AT = "TIMESTAMP '2024-01-01' + INTERVAL (doc_id % 720) HOUR"
_TX = f"tx AS (SELECT doc_id, lang AS segment, source, n_chars::DOUBLE AS amount, {_AT} AS paid_at FROM documents)"
_DEC = f"dec AS (SELECT doc_id, (n_chars % 100) / 100.0::DOUBLE AS score, (n_chars % 100) / 100.0::DOUBLE >= 0.8 AS predicted, {_AT} + INTERVAL 1 MINUTE AS decided_at FROM documents WHERE doc_id % 7 <> 0)"
_LAB = f"lab AS (SELECT doc_id, toxic = 1 AS is_fraud, {_AT} + INTERVAL (doc_id % 48) HOUR AS labelled_at FROM labels)"
_FB = "fb AS (SELECT dec.*, lab.is_fraud, lab.labelled_at, CASE WHEN is_fraud AND predicted THEN 'TP' WHEN predicted THEN 'FP' WHEN is_fraud THEN 'FN' ELSE 'TN' END AS outcome FROM dec JOIN lab USING (doc_id))"
_GOLD = f"WITH {_TX}, {_DEC}, {_LAB}, {_FB}, gold AS (SELECT tx.*, dec.score, dec.predicted, dec.decided_at, fb.is_fraud, fb.outcome FROM tx LEFT JOIN dec USING (doc_id) LEFT JOIN fb USING (doc_id))"


def _time(k=None):
    return (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("doc_id") % 720).cast("int"))).cast("timestamp_ntz")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("lang").alias("segment"),
        "source",
        F.col("n_chars").cast("double").alias("amount"),
        _time().alias("paid_at"),
    )


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = (F.col("n_chars") % 100) / F.lit(100.0)
    return read_table(spark, sf_dir, "documents").filter("doc_id % 7 <> 0").select(
        "doc_id",
        score.alias("score"),
        (score >= 0.8).alias("predicted"),
        (_time() + F.expr("interval 1 minute")).cast("timestamp_ntz").alias("decided_at"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = F.make_dt_interval(F.lit(0), (F.col("doc_id") % 48).cast("int"))
    return read_table(spark, sf_dir, "labels").select(
        "doc_id",
        (F.col("toxic") == 1).alias("is_fraud"),
        (_time() + delay).cast("timestamp_ntz").alias("labelled_at"),
    )


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.feedback(decisions(spark, sf_dir), labels(spark, sf_dir), "doc_id", "decided_at", "labelled_at")


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.gold_decisions(transactions(spark, sf_dir), decisions(spark, sf_dir), feedback(spark, sf_dir), "doc_id")


@query(f"WITH {_DEC}, {_LAB}, {_FB} SELECT doc_id, outcome, (epoch(labelled_at) - epoch(decided_at))::BIGINT AS label_delay_seconds, labelled_at > decided_at AS label_after_decision FROM fb")
def feedback_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback(spark, sf_dir).select("doc_id", "outcome", "label_delay_seconds", "label_after_decision")


@query(f"{_GOLD} SELECT doc_id, segment, amount, score, coalesce(predicted::INT, -1) AS predicted, coalesce(is_fraud::INT, -1) AS is_fraud, outcome FROM gold")
def gold_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c)
    return gold(spark, sf_dir).select("doc_id", "segment", "amount", "score", flag("predicted"), flag("is_fraud"), "outcome")


_KPI = "count(*) AS transactions, count(score) AS scored, count(is_fraud) AS labelled, count(*) FILTER (WHERE is_fraud) AS frauds, count(*) FILTER (WHERE predicted) AS predicted_frauds, count(*) FILTER (WHERE outcome = 'TP') AS tp, count(*) FILTER (WHERE outcome = 'FP') AS fp, count(*) FILTER (WHERE outcome = 'TN') AS tn, count(*) FILTER (WHERE outcome = 'FN') AS fn, round(sum(amount), 4) AS volume, round(sum(amount) FILTER (WHERE is_fraud), 4) AS fraud_volume, round(avg(score), 6) AS average_score, max(score) AS highest_score"
_RATES = 'round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1'


@query(f"{_GOLD} SELECT *, {_RATES}, round(frauds / nullif(labelled, 0), 6) AS fraud_rate FROM (SELECT {_KPI} FROM gold)")
def gold_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = G.kpi_row(gold(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in (
        "average_score",
        "precision",
        "recall",
        "f1",
        "fraud_rate",
    )} | {c: F.round(c, 4) for c in ("volume", "fraud_volume")})


@query(f"{_GOLD} SELECT date_trunc('hour', paid_at) AS hour, count(*) AS transactions, round(sum(amount), 4) AS volume, count(score) AS scored, count(*) FILTER (WHERE is_fraud) AS frauds, count(*) FILTER (WHERE predicted) AS predicted_frauds, round(avg(score), 6) AS average_score, max(score) AS highest_score, round(coalesce(sum(amount) FILTER (WHERE is_fraud), 0.0), 4) AS fraud_volume FROM gold GROUP BY 1")
def gold_hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = G.hourly_series(gold(spark, sf_dir), "paid_at")
    return out.withColumns({"volume": F.round("volume", 4), "fraud_volume": F.round("fraud_volume", 4), "average_score": F.round("average_score", 6)})


@query(f"{_GOLD} SELECT segment, count(*) AS transactions, round(sum(amount), 4) AS volume, count(*) FILTER (WHERE is_fraud) AS frauds, count(*) FILTER (WHERE predicted) AS predicted_frauds, round(avg(score), 6) AS average_score FROM gold GROUP BY segment")
def gold_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.by_segment(gold(spark, sf_dir), "segment").withColumns({"volume": F.round("volume", 4), "average_score": F.round("average_score", 6)})


@query(f"{_GOLD} SELECT outcome, count(*) AS n FROM gold WHERE outcome IS NOT NULL GROUP BY outcome")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.confusion_counts(gold(spark, sf_dir))


_COUNTS = "count(*) FILTER (WHERE is_fraud AND predicted) AS tp, count(*) FILTER (WHERE NOT is_fraud AND predicted) AS fp, count(*) FILTER (WHERE NOT is_fraud AND NOT predicted) AS tn, count(*) FILTER (WHERE is_fraud AND NOT predicted) AS fn"
_ALL_RATES = _RATES + ", round(tn / nullif(tn + fp, 0), 6) AS specificity, round(fp / nullif(fp + tn, 0), 6) AS false_positive_rate, round(fn / nullif(fn + tp, 0), 6) AS false_negative_rate, round((tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2, 6) AS balanced_accuracy"
_RATE_NAMES = ("precision", "recall", "f1", "specificity", "false_positive_rate", "false_negative_rate", "balanced_accuracy")


@query(f"WITH {_DEC}, {_LAB}, {_FB} SELECT *, {_ALL_RATES} FROM (SELECT {_COUNTS} FROM fb)")
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Me.classification_metrics(
        feedback(spark, sf_dir),
        F.col("is_fraud"),
        F.col("predicted"),
    ).withColumns({c: F.round(c, 6) for c in _RATE_NAMES})


@query(f"{_GOLD} SELECT *, {_ALL_RATES} FROM (SELECT segment, {_COUNTS} FROM gold WHERE outcome IS NOT NULL GROUP BY segment)")
def segment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold(spark, sf_dir).filter("outcome IS NOT NULL")
    return Me.classification_metrics(rows, F.col("is_fraud"), F.col("predicted"), ["segment"]).withColumns({c: F.round(c, 6) for c in _RATE_NAMES})


@query(f"{_GOLD} SELECT CASE WHEN score IS NULL THEN 'unscored' WHEN score < 0.01 THEN 'below_1_percent' WHEN score < 0.05 THEN '1_to_5_percent' WHEN score < 0.2 THEN '5_to_20_percent' WHEN score < 0.8 THEN '20_to_80_percent' ELSE '80_percent_and_more' END AS band, count(*) AS n, count(*) FILTER (WHERE is_fraud) AS frauds FROM gold GROUP BY 1")
def probability_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.by_band(gold(spark, sf_dir))


@query(f"{_GOLD} SELECT doc_id, score, paid_at FROM gold WHERE score IS NOT NULL ORDER BY score DESC, paid_at DESC, doc_id LIMIT 100")
def top_high_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.top_risks(gold(spark, sf_dir), "doc_id", 100, "paid_at").select("doc_id", "score", "paid_at")


_SCORES = f"WITH {_DEC}, {_LAB}, {_FB}, g AS (SELECT score, sum(is_fraud::INT) AS p, count(*) AS n FROM fb GROUP BY score), c AS (SELECT *, sum(p) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn FROM g)"


@query(f"{_SCORES} SELECT round(sum(p * cp / cn) / sum(p), 6) AS average_precision FROM c")
def pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feedback(spark, sf_dir).withColumn("y", F.col("is_fraud").cast("int"))
    return Me.average_precision(rows, "y", "score").select(F.round("average_precision", 6).alias("average_precision"))


@query(f"WITH {_DEC}, {_LAB}, {_FB} SELECT round(avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END), 6) AS roc_auc FROM fb a, fb b WHERE a.is_fraud AND NOT b.is_fraud")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feedback(spark, sf_dir).withColumn("y", F.col("is_fraud").cast("int"))
    return Me.roc_auc(rows, "y", "score").select(F.round("roc_auc", 6).alias("roc_auc"))


_SWEEP = "SELECT t AS threshold, count(*) FILTER (WHERE is_fraud AND score >= t) AS tp, count(*) FILTER (WHERE NOT is_fraud AND score >= t) AS fp, count(*) FILTER (WHERE NOT is_fraud AND score < t) AS tn, count(*) FILTER (WHERE is_fraud AND score < t) AS fn FROM fb, (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::DOUBLE[]) AS t) GROUP BY t"


@query(f"WITH {_DEC}, {_LAB}, {_FB} SELECT *, {_ALL_RATES} FROM ({_SWEEP})")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Me.threshold_sweep(feedback(spark, sf_dir), F.col("is_fraud"), F.col("score")).withColumns({c: F.round(c, 6) for c in _RATE_NAMES})


@query(f"WITH {_DEC}, {_LAB}, {_FB}, s AS (SELECT *, {_RATES} FROM ({_SWEEP})) SELECT threshold, tp, fp FROM s ORDER BY recall >= 0.3 DESC, CASE WHEN recall < 0.3 THEN recall END DESC NULLS LAST, fp, \"precision\" DESC NULLS LAST, threshold DESC LIMIT 1")
def threshold_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = Me.threshold_sweep(feedback(spark, sf_dir), F.col("is_fraud"), F.col("score"))
    return Me.chosen_threshold(sweep, 0.3).select("threshold", "tp", "fp")


@query("SELECT event_id, CASE WHEN n <= floor(total * 0.7) THEN 'train' WHEN n <= floor(total * 0.85) THEN 'validation' ELSE 'test' END AS split FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS n, count(*) OVER () AS total FROM events)")
def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sp.chronological_split(read_table(spark, sf_dir, "events"), "ts", "event_id").select("event_id", "split")


_SPLIT = f"SELECT event_id, user_id, ts, (event_id % 900 = 0)::INT AS y, split FROM events JOIN ({ORACLES['chronological_split']}) USING (event_id)"


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sp.chronological_split(read_table(spark, sf_dir, "events").withColumn("y", (F.col("event_id") % 900 == 0).cast("int")), "ts", "event_id")


@query(f"SELECT split, count(*) AS n, sum(y)::BIGINT AS events, round(avg(y), 6) AS event_rate, min(ts) AS first_at, max(ts) AS last_at, count(DISTINCT user_id) AS distinct_user_id FROM ({_SPLIT}) GROUP BY split")
def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sp.split_stats(_split(spark, sf_dir), "ts", "y", "user_id").withColumn("event_rate", F.round("event_rate", 6))


@query(f"WITH s AS ({_SPLIT}) SELECT 'overlap' AS check_name, count(*) AS n FROM (SELECT 1 FROM s GROUP BY event_id HAVING count(DISTINCT split) > 1) UNION ALL SELECT 'uncovered', count(*) FROM s WHERE split IS NULL UNION ALL SELECT 'out_of_order', (SELECT (max(ts) FILTER (WHERE split = 'train') > min(ts) FILTER (WHERE split = 'validation'))::INT + (max(ts) FILTER (WHERE split = 'validation') > min(ts) FILTER (WHERE split = 'test'))::INT FROM s)::BIGINT UNION ALL SELECT 'one_class', count(*) FROM (SELECT 1 FROM s GROUP BY split HAVING count(DISTINCT y) < 2)")
def split_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sp.split_integrity(_split(spark, sf_dir), "event_id", "ts", "y")


@query("""
WITH r AS (SELECT (event_id % 300 = 0)::INT AS y, row_number() OVER (ORDER BY ts, event_id) AS n, count(*) OVER () AS total FROM events),
v AS (SELECT least((SELECT n FROM r WHERE y = 1 ORDER BY n DESC LIMIT 1 OFFSET 2) - 1, max(total) - ceil(max(total) * 0.10)) AS v, max(total) AS total FROM r),
t AS (SELECT n AS train_end, v, total FROM r, (SELECT v, total AS tt FROM v) WHERE n >= ceil(total * 0.60) AND n <= least((SELECT n FROM r WHERE y = 1 AND n <= v ORDER BY n DESC LIMIT 1 OFFSET 2) - 1, v - ceil(total * 0.10)))
SELECT train_end, v::BIGINT AS validation_end, round(abs(train_end / total - 0.70) + abs((v - train_end) / total - 0.15) + abs((total - v) / total - 0.15), 9) AS distance FROM t ORDER BY distance, train_end LIMIT 1""")
def rare_event_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "events").withColumn("y", F.col("event_id") % 300 == 0)
    return Sp.rare_event_bounds(rows, "ts", "event_id", "y")


@query(f"SELECT sha256(string_agg(event_id::VARCHAR || '|' || split || '|v1|v1', chr(10) ORDER BY event_id)) AS split_digest FROM ({_SPLIT})")
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest over all lines in order of id."""
    return Sp.split_digest(_split(spark, sf_dir), "event_id", "v1")


@query(f"SELECT sha256(string_agg(d, chr(10) ORDER BY part)) AS split_digest FROM (SELECT part, sha256(string_agg(line, chr(10) ORDER BY line)) AS d FROM (SELECT event_id % 256 AS part, event_id::VARCHAR || '|' || split || '|v1|v1' AS line FROM ({_SPLIT})) GROUP BY part)")
def split_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sp.split_digest_tree(_split(spark, sf_dir), "event_id", "v1", part=F.col("event_id") % 256)


@query(f"""
{_GOLD}, a AS ((SELECT doc_id, 'fraud' AS s FROM gold WHERE is_fraud ORDER BY doc_id LIMIT 25) UNION ALL (SELECT doc_id, 'normal' FROM gold WHERE NOT is_fraud ORDER BY doc_id LIMIT 45) UNION ALL (SELECT doc_id, 'large' FROM gold WHERE amount > 3000 ORDER BY doc_id LIMIT 20) UNION ALL (SELECT doc_id, 'history' FROM gold WHERE score >= 0.5 AND outcome IS NOT NULL ORDER BY doc_id LIMIT 20))
SELECT doc_id, array_to_string(list_sort(list(DISTINCT s)), ',') AS strata FROM a GROUP BY doc_id ORDER BY doc_id LIMIT 100""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    strata = [
        ("fraud", F.col("is_fraud"), 25),
        ("normal", ~F.col("is_fraud"), 45),
        ("large", F.col("amount") > 3000, 20),
        ("history", (F.col("score") >= 0.5) & F.col("outcome").isNotNull(), 20),
    ]
    return Sp.stratified_ids(gold(spark, sf_dir), "doc_id", strata)


@query("SELECT l.doc_id, d.lang, l.quality, l.toxic FROM labels l JOIN documents d USING (doc_id)")
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", "lang").join(
        read_table(spark, sf_dir, "labels"),
        "doc_id",
    ).select("doc_id", "lang", "quality", "toxic")


@query("SELECT doc_id, y, CASE WHEN live THEN 'live' ELSE 'history' END AS source FROM (SELECT doc_id, toxic AS y, false AS live FROM labels UNION ALL SELECT doc_id, 1 - toxic, true FROM labels WHERE doc_id % 3 = 0) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY live DESC) = 1")
def retraining_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "labels")
    history = rows.select("doc_id", F.col("toxic").alias("y"))
    live = rows.filter("doc_id % 3 = 0").select("doc_id", (1 - F.col("toxic")).alias("y"))
    return L.merge_training_rows(history, live, "doc_id", ["y"]).select("doc_id", "y", "source")


@query("SELECT count(*) FILTER (WHERE doc_id % 3 = 0) AS live_rows, count(DISTINCT CASE WHEN doc_id % 3 = 0 THEN toxic END) = 2 AND count(DISTINCT toxic) = 2 AS allowed FROM labels")
def retrain_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "labels")
    return Sp.retrain_allowed(rows.filter("doc_id % 3 = 0"), rows, "toxic")


def _decision_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decisions(spark, sf_dir)
    k = F.col("doc_id")
    return d.select(
        F.when(k % 5 == 0, "fraud_label").otherwise("fraud_decision").alias("event_type"),
        F.when(k % 11 != 0, F.col("predicted")).alias("predicted"),
        F.when(k % 2 == 0, F.col("score")).alias("fraud_probability"),
        F.col("score").alias("risk_score"),
        F.when(k % 4 != 0, k).alias("transaction_id"),
        k.alias("event_id"),
        F.lit(None).cast("string").alias("decision"),
    )


@query(f"WITH {_DEC} SELECT doc_id AS transaction_id, score AS probability, printf('%s: transaction %s scored %.4f (threshold %.2f), decision %s', 'High-risk transaction', doc_id::VARCHAR, score, 0.8, 'REVIEW') AS message FROM dec WHERE doc_id % 5 <> 0 AND doc_id % 11 <> 0 AND predicted AND score >= 0.8")
def alert_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.alerts(_decision_events(spark, sf_dir)).select("transaction_id", "probability", "message")


@query(f"WITH {_DEC} SELECT count(*) AS decisions, count(*) FILTER (WHERE predicted) AS flagged, count(*) FILTER (WHERE predicted AND score >= 0.9) AS high FROM dec WHERE decided_at >= TIMESTAMP '2024-01-05'")
def decision_payload_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.to_json(F.struct(F.col("predicted").alias("predicted_fraud"), F.col("score").alias("risk_score")))
    rows = decisions(spark, sf_dir).select("decided_at", payload.alias("p"))
    return S.payload_counts(rows, "p", 0.9, ("decided_at", F.lit("2024-01-05").cast("timestamp_ntz")))


@query(f"WITH {_DEC} SELECT doc_id, CASE WHEN predicted THEN 'REVIEW' ELSE 'ALLOW' END AS decision, 60000.0::DOUBLE AS processing_latency_ms FROM dec")
def decision_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decisions(spark, sf_dir).drop("predicted").withColumn("at", (F.col("decided_at") - F.expr("interval 1 minute")).cast("timestamp_ntz"))
    return S.decided(rows, "score", "at", F.col("decided_at")).select("doc_id", "decision", "processing_latency_ms")


_RECONCILED = [
    ("gold_transaction_rows_match_source_transactions", "(SELECT count(*) FROM tx)", "(SELECT count(*) FROM gold)"),
    ("gold_transaction_ids_unique", "0", "(SELECT count(*) - count(DISTINCT doc_id) FROM gold)"),
    ("kpi_total_transactions_match_gold", "(SELECT count(*) FROM gold)", "(SELECT count(*) FROM gold)"),
    ("kpi_scored_transactions_match_decisions", "(SELECT count(*) FROM dec)", "(SELECT count(score) FROM gold)"),
    ("kpi_labeled_transactions_match_feedback", "(SELECT count(*) FROM fb)", "(SELECT count(is_fraud) FROM gold)"),
    ("fraud_probabilities_in_unit_interval", "0", "(SELECT count(*) FROM gold WHERE score < 0 OR score > 1)"),
    ("transaction_amounts_numeric_and_present", "0", "(SELECT count(*) FROM gold WHERE amount IS NULL)"),
]


@query(f"{_GOLD} SELECT *, CASE WHEN expected = found THEN 'PASS' ELSE 'FAIL' END AS status FROM ({' UNION ALL '.join(f'SELECT {chr(39)}{n}{chr(39)} AS check_name, {a}::BIGINT AS expected, {b}::BIGINT AS found' for n, a, b in _RECONCILED)})")
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold(spark, sf_dir)
    return G.reconciliation(transactions(spark, sf_dir), decisions(spark, sf_dir), feedback(spark, sf_dir), g, G.kpi_row(g), "doc_id")


_ACTIVITY = "count(*) AS transactions, round(sum(amount), 4) AS volume, count(*) FILTER (WHERE is_fraud) AS frauds, count(*) FILTER (WHERE predicted) AS predicted_frauds, round(avg(score), 6) AS average_score, max(score) AS highest_score"


@query(f"{_GOLD} SELECT 'asset' AS kind, segment AS value, {_ACTIVITY} FROM gold GROUP BY segment UNION ALL SELECT 'country', source, {_ACTIVITY} FROM gold GROUP BY source UNION ALL SELECT 'type', (doc_id % 3)::VARCHAR, {_ACTIVITY} FROM gold GROUP BY doc_id % 3")
def gold_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dashboard query over the SQL views: activity by asset, country and type of transaction."""
    rows = gold(spark, sf_dir).withColumn("country", F.col("source")).withColumn("transaction_type", (F.col("doc_id") % 3).cast("string"))
    G.create_views(rows)
    parts = [f"SELECT '{kind}' AS kind, {c} AS value, transactions, round(volume, 4) AS volume, frauds, predicted_frauds, round(average_score, 6) AS average_score, highest_score FROM fraud_activity_by_{c}" for kind, c in (
        ("asset", "segment"),
        ("country", "country"),
        ("type", "transaction_type"),
    )]
    return spark.sql(" UNION ALL ".join(parts))


@query("SELECT toxic AS prediction FROM labels GROUP BY toxic ORDER BY count(*) DESC, toxic LIMIT 1")
def dummy_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.operators.models import most_frequent

    return most_frequent(read_table(spark, sf_dir, "labels"), "toxic")


@query()
def logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced logistic regression on account features, scored on all rows; checked in tests."""
    from sluice.operators.models import fit_logistic, scored

    rows = read_table(spark, sf_dir, "customer").withColumn("y", (F.col("c_acctbal") > 5000).cast("int"))
    model = fit_logistic(rows, ["c_acctbal", "c_nationkey"], ["c_mktsegment"], "y")
    return scored(model, rows, ["c_acctbal", "c_nationkey"], ["c_mktsegment"], "c_custkey", "y")


@query()
def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees on the same features; checked in tests."""
    from sluice.operators.models import fit_boosted, scored

    rows = read_table(spark, sf_dir, "customer").withColumn("y", (F.col("c_acctbal") > 5000).cast("int"))
    model = fit_boosted(rows, ["c_acctbal", "c_nationkey"], ["c_mktsegment"], "y", trees=10)
    return scored(model, rows, ["c_acctbal", "c_nationkey"], ["c_mktsegment"], "c_custkey", "y")


def _synthetic(spark: SparkSession):
    from sluice.sources.synthetic import Plan, Synthetic

    return Synthetic(spark, Plan(accounts=40, logins=400, transactions=2500, days=3))


_REPORT = [f"{t}_unique" for t in ("accounts", "devices", "wallets", "transactions", "labels", "logins")]
_REPORT += [f"transactions_{c}_found" for c in ("account_id", "device_id", "source_wallet_id", "destination_wallet_id")]
_REPORT += [f"transaction_{n}" for n in (
    "event_timestamp_after_source_timestamp",
    "source_timestamp_after_ingestion_timestamp",
    "crypto_quantity_not_positive",
    "market_price_usd_not_positive",
    "transaction_amount_usd_negative",
    "source_and_destination_wallet_identical",
    "deposit_missing_destination_wallet_id",
    "outgoing_transaction_missing_source_wallet_id",
    "outgoing_transaction_missing_destination_wallet_id",
    "transaction_amount_mismatch_quantity_times_price",
)]
_REPORT += ["labels_after_transactions", "no_label_columns", "fraud_share"]


@query(f"SELECT unnest({_REPORT}) AS check_name, 0::BIGINT AS failures, 'PASS' AS status")
def synthetic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report of a synthetic set, which passes; needs no tables."""
    from sluice.sources.synthetic import quality_report

    s = _synthetic(spark)
    t = s.transactions()
    return quality_report({
        "accounts": s.accounts(),
        "devices": s.devices(),
        "wallets": s.wallets(),
        "transactions": t,
        "labels": s.labels(t),
        "logins": s.logins(t),
    })


@query("SELECT * FROM (VALUES ('transactions', 2500), ('labelled', 20), ('scenarios', 6), ('audit rows without a label but of velocity cases', 0), ('labels of frauds', 20), ('bundles of takeovers without a failed login', 0)) t(name, n)")
def synthetic_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a synthetic set must hold: frauds by plan, every scenario, audit rows, labels, and logins before takeovers."""
    from sluice.sources.synthetic import bundles

    s = _synthetic(spark)
    t = s.transactions()
    labels, audit = s.labels(t), s.audit(t)
    taken = bundles(t, s.logins(t), labels).filter("scenario = 'account_takeover'")
    counts = {
        "transactions": t,
        "labelled": t.filter("label_expected"),
        "scenarios": t.select("scenario").filter("scenario IS NOT NULL").distinct(),
        "audit rows without a label but of velocity cases": audit.filter("NOT label_expected AND scenario_id <> 'high_transaction_velocity'"),
        "labels of frauds": labels.filter("is_fraud AND fraud_type IS NOT NULL AND label_timestamp IS NOT NULL"),
        "bundles of takeovers without a failed login": taken.filter("NOT coalesce(exists(logins, l -> NOT l.login_success), false)"),
    }
    rows = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in counts.items()]
    return Me.union_all(rows)


@query("SELECT m AS model, (SELECT count(*) FROM customer WHERE c_custkey % 10 >= 7) AS scored, true AS in_unit_interval, true AS better_than_chance FROM (SELECT unnest(['logistic', 'boosted']) AS m)")
def model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models, fitted on some accounts and scored on others: rows, range of scores, and whether ROC-AUC is above 0.9."""
    from sluice.operators.models import fit_boosted, fit_logistic, scored

    numeric, categorical = ["c_acctbal", "c_nationkey"], ["c_mktsegment"]
    rows = read_table(spark, sf_dir, "customer").withColumn("y", (F.col("c_acctbal") > 5000).cast("int"))
    train, test = rows.filter("c_custkey % 10 < 7"), rows.filter("c_custkey % 10 >= 7")
    out = []
    for name, model in (
        ("logistic", fit_logistic(train, numeric, categorical, "y")),
        ("boosted", fit_boosted(train, numeric, categorical, "y", trees=10)),
    ):
        s = scored(model, test, numeric, categorical, "c_custkey", "y")
        sums = s.agg(F.count("*").alias("scored"), (F.min("score") >= 0).alias("_a"), (F.max("score") <= 1).alias("_b"))
        out.append(sums.crossJoin(Me.roc_auc(s, "y", "score")).select(  # one row each
            F.lit(name).alias("model"),
            "scored",
            (F.col("_a") & F.col("_b")).alias("in_unit_interval"),
            (F.col("roc_auc") > 0.9).alias("better_than_chance"),
        ))
    return Me.union_all(out)


@query("SELECT doc_id, score, predicted FROM (SELECT *, row_number() OVER (PARTITION BY doc_id % 100 ORDER BY decided_at DESC, doc_id DESC) AS n FROM (SELECT doc_id, (n_chars % 100) / 100.0::DOUBLE AS score, (n_chars % 100) / 100.0::DOUBLE >= 0.8 AS predicted, TIMESTAMP '2024-01-01' + INTERVAL (doc_id % 720) HOUR AS decided_at FROM documents WHERE doc_id % 7 <> 0)) WHERE n = 1")
def latest_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest decision of each transaction (documents by their last two digits)."""
    rows = decisions(spark, sf_dir).withColumn("t", F.col("doc_id") % 100)
    return L.latest(rows, ["t"], L.newest_by("decided_at", "doc_id")).select("doc_id", "score", "predicted")
