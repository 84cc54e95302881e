"""Synthetic tables: the same for the same plan, and clean by their own report."""

from pyspark.sql import functions as F

from sluice.sources.synthetic import SCENARIOS, Plan, Synthetic, bundles, due_labels, quality_report


def test_synthetic_set_passes_its_report(spark):
    s = Synthetic(spark, Plan(accounts=40, logins=400, transactions=2500, days=3))
    t = s.transactions().cache()
    data = {"accounts": s.accounts(), "devices": s.devices(), "wallets": s.wallets(), "transactions": t, "labels": s.labels(t), "logins": s.logins(t)}
    failed = quality_report(data).filter("status = 'FAIL'").collect()
    assert not failed
    assert t.count() == 2500 and t.filter("label_expected").count() == sum(s.fraud_counts().values()) == 20
    cases = {r.scenario: r for r in t.filter("scenario IS NOT NULL").groupBy("scenario").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col("label_expected"), 1)).alias("labelled"),
        F.countDistinct("execution").alias("cases"),
        F.countDistinct("destination_wallet_id").alias("wallets"),
        F.countDistinct("account_id").alias("accounts"),
    ).collect()}
    fast, mule, split = (cases[k] for k in ("high_transaction_velocity", "mule_account_activity", "structuring"))
    assert fast.cases == fast.labelled and 4 * fast.cases <= fast.n <= 6 * fast.cases
    assert mule.cases == mule.wallets == 1 and mule.accounts == mule.n == mule.labelled
    assert split.n == split.labelled and split.cases == -(-split.n // 4)
    frauds = s.fraud_rows(t).collect()
    assert len(frauds) == 20 and all(SCENARIOS[r.scenario_id].fraud_type == r.fraud_type and SCENARIOS[r.scenario_id].delay_hours[0] <= r.label_delay_hours <= SCENARIOS[r.scenario_id].delay_hours[1] for r in frauds)
    assert s.audit(t).count() == t.filter("scenario IS NOT NULL").count()
    assert {r[0] for r in t.select("scenario").distinct().collect()} == {None, *SCENARIOS}
    again = Synthetic(spark, Plan(accounts=40, logins=400, transactions=2500, days=3)).transactions()
    assert t.exceptAll(again).count() == 0
    assert due_labels(data["labels"].withColumn("emit_at", F.col("label_timestamp")), F.lit("2026-06-01 01:00:00").cast("timestamp")).count() == 0
    taken = bundles(t, data["logins"], data["labels"]).filter("scenario = 'account_takeover'").head()
    assert [x.login_success for x in taken.logins][-1] and not [x.login_success for x in taken.logins][-2]
    t.unpersist()
