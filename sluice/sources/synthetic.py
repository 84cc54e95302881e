"""Synthetic risk data as DataFrames: entities, logins, transactions with fraud scenarios, labels, candles.

Every value is a function of a seed, a row number and a name, so any number of executors makes the same rows and nothing
is drawn on the driver.  Row counts are parameters.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.typing import deterministic_id

@dataclass(frozen=True)
class Scenario:
    """A kind of fraud: its weight among frauds, its payments and what is known of it."""

    weight: float
    fraud_type: str
    reasons: tuple[str, ...]
    factor: tuple[float, float]  # of the account's normal amount
    delay_hours: tuple[int, int]  # until its label
    gap_seconds: tuple[int, int] = (0, 0)  # between the payments of a case
    payments: tuple[int, int] = (1, 1)  # of a case
    only_last: bool = False  # whether the payments before the last are not labelled
    version: str = "1.0"


#: Scenarios by id.
SCENARIOS = {
    "account_takeover": Scenario(
        0.18,
        "ACCOUNT_TAKEOVER",
        ("NEW_DEVICE", "NEW_COUNTRY", "FAILED_LOGIN_ACTIVITY", "UNUSUAL_AMOUNT", "NEW_DESTINATION_WALLET"),
        (4.0, 12.0),
        (12, 72),
    ),
    "high_transaction_velocity": Scenario(
        0.15,
        "HIGH_TRANSACTION_VELOCITY",
        ("HIGH_TRANSACTION_VELOCITY",),
        (0.7, 1.4),
        (6, 48),
        (20, 55),
        (4, 6),
        True,
    ),
    "unusual_transaction_amount": Scenario(0.17, "UNUSUAL_TRANSACTION_AMOUNT", ("UNUSUAL_AMOUNT", "NEW_DESTINATION_WALLET"), (5.0, 15.0), (12, 96)),
    "structuring": Scenario(0.20, "STRUCTURING", ("HIGH_TRANSACTION_VELOCITY", "UNUSUAL_AMOUNT"), (0.7, 1.4), (24, 168), (60, 480), (4, 4)),
    "mule_account_activity": Scenario(0.15, "MULE_ACCOUNT_ACTIVITY", ("NEW_DESTINATION_WALLET",), (1.2, 3.5), (24, 168), (420, 1800)),
    "shared_suspicious_device": Scenario(
        0.15,
        "SHARED_SUSPICIOUS_DEVICE",
        ("SUSPICIOUS_SHARED_DEVICE", "NEW_DEVICE", "FAILED_LOGIN_ACTIVITY"),
        (2.0, 6.0),
        (12, 96),
    ),
}
COUNTRIES, ASSETS = ("US", "GB", "DE", "FR", "CA"), ("BTC", "ETH")


@dataclass(frozen=True)
class Plan:
    """How much of everything, over which days."""

    seed: int = 1
    accounts: int = 100
    logins: int = 2500
    transactions: int = 5000
    fraud_share: float = 0.008
    start: str = "2026-06-01 00:00:00"
    days: int = 7
    shared_devices: int = 2


class Synthetic:
    """Builders of all tables of a plan."""

    def __init__(self, spark: SparkSession, plan: Plan = Plan()):
        self.spark, self.plan = spark, plan

    def u(self, name: str, *keys: Column) -> Column:
        """Uniform in [0, 1) by name and keys."""
        h = F.xxhash64(F.lit(self.plan.seed), F.lit(name), *(keys or (F.col("id"),)))
        return F.pmod(h, F.lit(1 << 53)) / float(1 << 53)

    def normal(self, name: str) -> Column:
        """Standard normal (Box-Muller)."""
        return F.sqrt(-2 * F.log(1 - self.u(name))) * F.cos(2 * 3.141592653589793 * self.u(name + "'"))

    def pick(self, name: str, values: tuple) -> Column:
        """One of some values, equally likely."""
        return F.element_at(F.array(*map(F.lit, values)), (F.floor(self.u(name) * len(values)) + 1).cast("int"))

    def key(self, kind: str, n: Column) -> Column:
        """Id of the n-th row of a kind."""
        return deterministic_id(F.lit(kind), F.lit(self.plan.seed), n)

    def when(self, name: str) -> Column:
        """A whole second in the plan's days."""
        return (F.lit(self.plan.start).cast("timestamp").cast("long") + F.floor(self.u(name) * self.plan.days * 86400)).cast("long")

    @staticmethod
    def stamped(seconds: Column) -> list[Column]:
        """Event, source (a second later) and ingestion time (two)."""
        return [F.timestamp_seconds(seconds + i).alias(n) for i, n in enumerate(("event_timestamp", "source_timestamp", "ingestion_timestamp"))]

    def accounts(self) -> DataFrame:
        created = F.lit(self.plan.start).cast("timestamp").cast("long") - F.floor(self.u("age") * 900 * 86400).cast("long") - 86400
        amount = F.round(F.exp(5 + 0.8 * self.normal("amount")), 2)
        return self.spark.range(self.plan.accounts).select(
            self.key("account", F.col("id")).alias("account_id"),
            F.col("id").alias("n"),
            F.timestamp_seconds(created).alias("created_at"),
            F.when(self.u("updated") < 0.5, F.timestamp_seconds(created + 3600)).alias("updated_at"),
            self.pick("country", COUNTRIES).alias("home_country"),
            F.when(self.u("tier") < 0.7, "LOW").when(self.u("tier") < 0.9, "MEDIUM").otherwise("HIGH").alias("customer_risk_tier"),
            amount.alias("normal_transaction_amount_usd"),
            F.round(0.2 + 3 * self.u("often"), 2).alias("normal_transaction_frequency_per_day"),
        )

    def devices(self) -> DataFrame:
        n = self.plan.accounts
        first = F.lit(self.plan.start).cast("timestamp").cast("long") - F.floor(self.u("seen") * 300 * 86400).cast("long")
        own = F.when(F.col("id") < n, self.key("account", F.col("id")))  # the last ones are shared and have no primary account
        return self.spark.range(n + self.plan.shared_devices).select(
            self.key("device", F.col("id")).alias("device_id"),
            F.timestamp_seconds(first).alias("first_seen_at"),
            F.timestamp_seconds(first + 86400).alias("last_seen_at"),
            self.pick("device_type", ("MOBILE", "DESKTOP", "TABLET")).alias("device_type"),
            own.alias("primary_account_id"),
        )

    def wallets(self) -> DataFrame:
        n = self.plan.accounts
        external = max(140, n + 20) + 2
        first = F.lit(self.plan.start).cast("timestamp").cast("long") - F.floor(self.u("wallet") * 300 * 86400).cast("long")
        return self.spark.range(n + external).select(
            self.key("wallet", F.col("id")).alias("wallet_id"),
            F.when(F.col("id") < n, self.key("account", F.col("id"))).alias("owner_account_id"),
            F.when(F.col("id") < n, "CUSTOMER").otherwise("EXTERNAL").alias("wallet_type"),
            F.timestamp_seconds(first).alias("first_seen_at"),
        )

    def candles(self) -> DataFrame:
        """One-minute candles of each product; prices follow a smooth path with noise."""
        minutes = self.plan.days * 1440
        rows = self.spark.range(minutes * len(ASSETS)).withColumn("m", F.col("id") % minutes).withColumn(
            "asset",
            F.element_at(F.array(*map(F.lit, ASSETS)), (F.floor(F.col("id") / minutes) + 1).cast("int")),
        )
        base = F.when(F.col("asset") == "BTC", 60000.0).otherwise(3000.0)
        price = lambda m: base * (1 + 0.05 * F.sin(m / 700.0) + 0.002 * (self.u("noise", F.col("asset"), m) - 0.5))
        rows = rows.withColumn("open", F.round(price(F.col("m")), 8)).withColumn("close", F.round(price(F.col("m") + 1), 8))
        start = F.lit(self.plan.start).cast("timestamp").cast("long") + 60 * F.col("m")
        return rows.select(
            F.concat("asset", F.lit("-USD")).alias("product_id"),
            "asset",
            F.timestamp_seconds(start).alias("candle_start_timestamp"),
            F.timestamp_seconds(start + 60).alias("candle_end_timestamp"),
            F.lit(60).alias("granularity_seconds"),
            F.col("open").alias("open_price_usd"),
            F.round(F.greatest("open", "close") * 1.0005, 8).alias("high_price_usd"),
            F.round(F.least("open", "close") * 0.9995, 8).alias("low_price_usd"),
            F.col("close").alias("close_price_usd"),
            F.round(1 + 9 * self.u("volume"), 8).alias("volume"),
        )

    def fraud_counts(self) -> dict[str, int]:
        """Labelled frauds of each scenario: by weight, at least one each, what is over or missing dealt at random by the seed."""
        total = max(len(SCENARIOS), round(self.plan.transactions * self.plan.fraud_share))
        whole = sum(x.weight for x in SCENARIOS.values())
        out = {k: max(1, int(total * x.weight / whole)) for k, x in SCENARIOS.items()}
        dealt = random.Random(self.plan.seed)
        while sum(out.values()) != total:
            short = sum(out.values()) < total
            out[dealt.choice([k for k, n in out.items() if short or n > 1])] += 1 if short else -1
        return out

    def payments(self) -> DataFrame:
        """A row a payment of a scenario: scenario, execution (case), step, id, account number a, time t, factor, label_expected.

        Velocity cases have payments before the labelled one, structuring ones are sequences of one account, and all
        mule payments are one case of many accounts.
        """
        p, parts = self.plan, []
        for name, m in self.fraud_counts().items():
            x = SCENARIOS[name]
            mule, per = name == "mule_account_activity", 1 if x.only_last else x.payments[1]
            cases = self.spark.range(1 if mule else -(-m // per)).select(F.col("id").alias("_case"), F.lit(name).alias("scenario"))
            key = lambda what, *more, n=name: self.u(f"{n} {what}", F.col("_case"), *more)
            between = lambda u, low, high: low + F.floor(u * (high - low + 1))
            if mule:
                steps = F.lit(m)
            elif x.only_last:
                steps = between(key("steps"), *x.payments)
            else:
                steps = F.least(F.lit(per), m - F.col("_case") * per)  # the last case has what is left
            rows = cases.withColumn("_steps", steps.cast("int")).withColumn("step", F.explode(F.sequence(F.lit(0), F.col("_steps") - 1)))
            gap = between(key("gap"), *x.gap_seconds)
            start = F.lit(p.start).cast("timestamp").cast("long") + 3600 + F.floor(key("time") * (p.days * 86400 - 14400))
            account = F.pmod(F.floor(key("account") * p.accounts) + (F.col("step") if mule else 0), F.lit(p.accounts))
            factor = x.factor[0] + (x.factor[1] - x.factor[0]) * key("factor", F.col("step"))
            last = F.col("step") == F.col("_steps") - 1
            own = F.xxhash64(F.lit(p.seed), F.lit(name), F.col("_case"), F.col("step"))
            parts.append(rows.select(
                "scenario",
                deterministic_id(F.lit("execution"), F.lit(p.seed), F.lit(name), F.col("_case")).alias("execution"),
                "step",
                own.alias("id"),
                account.cast("long").alias("a"),
                (start + F.col("step") * gap).cast("long").alias("t"),
                factor.alias("factor"),
                (last if x.only_last else F.lit(True)).alias("label_expected"),
            ))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def transactions(self) -> DataFrame:
        """Amount = quantity x price to 8 digits; types 34 / 46 / 20 percent deposits, withdrawals, transfers; the price is that of the last completed candle."""
        p = self.plan
        frauds = self.payments()
        n = F.col("id")
        plain = self.spark.range(max(0, p.transactions - frauds.count()))
        usual = F.exp(0.35 * self.normal("factor"))
        plain = plain.select(
            "id",
            F.floor(self.u("account") * p.accounts).cast("long").alias("a"),
            self.when("time").alias("t"),
            usual.alias("factor"),
        )
        rows = frauds.unionByName(plain, allowMissingColumns=True)
        normal = self.accounts().select(F.col("n").alias("a"), F.col("normal_transaction_amount_usd").alias("usual"), "home_country")
        rows = rows.join(normal, "a")
        kind = F.when(
            F.col("scenario") == "unusual_transaction_amount",
            F.when(self.u("kind") < 0.75, "WITHDRAWAL").otherwise("TRANSFER"),
        ).when(
            F.col("scenario").isNotNull(),
            "WITHDRAWAL",
        ).when(self.u("kind") < 0.34, "DEPOSIT").when(self.u("kind") < 0.80, "WITHDRAWAL").otherwise("TRANSFER")
        same = F.coalesce(F.col("execution"), n.cast("string"))  # a case keeps its asset and wallet
        asset = F.element_at(F.array(*map(F.lit, ASSETS)), (F.floor(self.u("asset", same) * len(ASSETS)) + 1).cast("int"))
        rows = rows.withColumn("asset", asset).withColumn(
            "wanted",
            F.greatest(F.col("usual") * F.col("factor"), F.lit(0.01)),
        ).withColumn("kind", kind)
        price = self.candles().select(
            F.col("asset").alias("_asset"),
            F.unix_seconds("candle_end_timestamp").alias("_end"),
            F.col("close_price_usd").alias("price"),
        )
        first = F.lit(p.start).cast("timestamp").cast("long") + 60
        rows = rows.withColumn("_at", F.greatest(F.floor(F.col("t") / 60) * 60, first)).join(
            price,
            (F.col("asset") == F.col("_asset")) & (F.col("_at") == F.col("_end")),
        )
        quantity = F.round(F.col("wanted") / F.col("price"), 8)
        customer = self.key("wallet", F.col("a"))
        mule = F.coalesce(F.col("scenario") == "mule_account_activity", F.lit(False))
        external = self.key("wallet", F.when(mule, F.lit(p.accounts)).otherwise(p.accounts + F.floor(self.u("external", same) * 140)).cast("long"))
        shared = F.coalesce(F.col("scenario").isin("shared_suspicious_device", "account_takeover"), F.lit(False))
        device = self.key("device", F.when(shared, F.lit(p.accounts)).otherwise(F.col("a")).cast("long"))
        abroad = F.when(F.col("home_country") == "US", "GB").otherwise("US")
        country = F.when(shared, abroad).otherwise(F.col("home_country"))
        deposit = F.col("kind") == "DEPOSIT"
        status = F.when(
            F.col("scenario").isNotNull() | (self.u("status") < 0.9),
            "COMPLETED",
        ).when(self.u("status") < 0.95, "PENDING").otherwise("FAILED")
        return rows.select(
            self.key("transaction", n).alias("transaction_id"),
            *self.stamped(F.col("t")),
            self.key("account", F.col("a")).alias("account_id"),
            device.alias("device_id"),
            F.when(~deposit, customer).alias("source_wallet_id"),
            F.when(deposit, customer).otherwise(external).alias("destination_wallet_id"),
            "asset",
            quantity.alias("crypto_quantity"),
            F.col("price").alias("market_price_usd"),
            F.round(quantity * F.col("price"), 8).alias("transaction_amount_usd"),
            F.col("kind").alias("transaction_type"),
            country.alias("country"),
            status.alias("transaction_status"),
            "scenario",
            "execution",
            "label_expected",
        )

    def audit(self, transactions: DataFrame) -> DataFrame:
        """A row a payment of a scenario: case, scenario and version, type, reasons, and whether it is to be labelled."""
        of = lambda field, kind: F.create_map(*(F.lit(v) for k, x in SCENARIOS.items() for v in (
            k,
            getattr(x, field),
        )))[F.col("scenario")].cast(kind)
        reasons = F.create_map(*(v for k, x in SCENARIOS.items() for v in (F.lit(k), F.array(*map(F.lit, x.reasons)))))[F.col("scenario")]
        return transactions.filter("scenario IS NOT NULL").select(
            F.col("execution").alias("scenario_execution_id"),
            F.col("scenario").alias("scenario_id"),
            of("version", "string").alias("scenario_version"),
            of("fraud_type", "string").alias("fraud_type"),
            reasons.alias("reason_codes"),
            "transaction_id",
            "account_id",
            "event_timestamp",
            "label_expected",
        )

    def fraud_rows(self, transactions: DataFrame) -> DataFrame:
        """A row a labelled fraud, with the hours until its label."""
        low, high = (F.create_map(*(F.lit(v) for k, x in SCENARIOS.items() for v in (k, x.delay_hours[i])))[F.col("scenario_id")] for i in (0, 1))
        hours = low + (high - low) * self.u("delay", F.col("transaction_id"))
        return self.audit(transactions).filter("label_expected").select(
            "transaction_id",
            F.col("event_timestamp").alias("transaction_timestamp"),
            "scenario_id",
            "fraud_type",
            "reason_codes",
            hours.alias("label_delay_hours"),
        )

    def logins(self, transactions: DataFrame | None = None) -> DataFrame:
        """Normal logins, one in twenty failed; takeovers and shared devices have theirs before them."""
        rows = self.spark.range(self.plan.logins).withColumn(
            "a",
            F.floor(self.u("login account") * self.plan.accounts).cast("long"),
        ).withColumn("t", self.when("login time"))
        normal = rows.select(
            self.key("login", F.col("id")).alias("event_id"),
            *self.stamped(F.col("t")),
            self.key("account", F.col("a")).alias("account_id"),
            self.key("device", F.col("a")).alias("device_id"),
            (self.u("login") >= 0.05).alias("login_success"),
        )
        if transactions is None:
            return normal
        minute = lambda n: F.unix_seconds("event_timestamp") - 60 * n
        own = transactions.select("transaction_id", "account_id", "device_id", "event_timestamp", "scenario")
        id_ = lambda: deterministic_id(F.lit("scenario login"), F.col("transaction_id"), F.col("_i")).alias("event_id")
        # a takeover: two to five failed logins, a minute apart, then a good one
        tries = (2 + F.pmod(F.xxhash64("transaction_id"), F.lit(4))).cast("int")
        taken = own.filter("scenario = 'account_takeover'").withColumn("_n", tries).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n"))))
        good = F.col("_i") == F.col("_n")
        taken = taken.select(
            id_(),
            *self.stamped(F.when(good, minute(1)).otherwise(minute(F.col("_n") + 4) + 60 * F.col("_i"))),
            "account_id",
            "device_id",
            good.alias("login_success"),
        )
        # a shared device: three accounts on it, of which the payer's login is good
        others = self.accounts().select("account_id", "n")
        number = own.filter("scenario = 'shared_suspicious_device'").join(others, "account_id").withColumn(
            "_i",
            F.explode(F.sequence(F.lit(0), F.lit(2))),
        )
        who = F.pmod(F.col("n") + F.col("_i"), F.lit(self.plan.accounts))
        shared = number.select(
            id_(),
            *self.stamped(minute(10) + 120 * F.col("_i")),
            self.key("account", who).alias("account_id"),
            "device_id",
            (F.col("_i") == 0).alias("login_success"),
        )
        return normal.unionByName(taken).unionByName(shared)

    def labels(self, transactions: DataFrame) -> DataFrame:
        """A delayed label for every fraud and every other completed transaction: by scenario, or 24 to 168 hours."""
        low, high = F.lit(24), F.lit(168)
        for k, x in SCENARIOS.items():
            low, high = F.when(
                F.col("scenario") == k,
                x.delay_hours[0],
            ).otherwise(low), F.when(F.col("scenario") == k, x.delay_hours[1]).otherwise(high)
        delay = F.floor((low + (high - low) * self.u("delay", F.col("transaction_id"))) * 3600)
        fraud = F.coalesce("label_expected", F.lit(False))
        rows = transactions.filter((F.col("transaction_status") == "COMPLETED") | fraud).withColumn(
            "_t",
            F.unix_seconds("event_timestamp") + delay.cast("long"),
        )
        kind = F.create_map(*(F.lit(v) for k, x in SCENARIOS.items() for v in (k, x.fraud_type)))[F.col("scenario")]
        return rows.select(
            deterministic_id(F.lit("label"), F.col("transaction_id")).alias("event_id"),
            "transaction_id",
            *self.stamped(F.col("_t")),
            F.timestamp_seconds("_t").alias("label_timestamp"),
            fraud.alias("is_fraud"),
            F.when(fraud, kind).alias("fraud_type"),
            F.when(fraud, "CONFIRMED_FRAUD").otherwise("CLEARED").alias("investigation_status"),
        )


def due_labels(pending: DataFrame, now: Column) -> DataFrame:
    """Labels of a queue (emit_at, ...) that are due, oldest first within a key's order."""
    return pending.filter(F.col("emit_at") <= now)


def bundles(transactions: DataFrame, logins: DataFrame, labels: DataFrame) -> DataFrame:
    """A live bundle a transaction: its last logins before it and its pending label."""
    before = transactions.select("transaction_id", "account_id", F.col("event_timestamp").alias("_at")).join(
        logins.select("account_id", F.struct("event_timestamp", "event_id", "login_success").alias("l")),
        "account_id",
    ).filter(F.col("l.event_timestamp") < F.col("_at"))
    last = before.withColumn(
        "_n",
        F.row_number().over(Window.partitionBy("transaction_id").orderBy(F.col("l").desc())),
    ).filter("_n <= 5").groupBy("transaction_id").agg(F.sort_array(F.collect_list("l")).alias("logins"))
    return transactions.join(last, "transaction_id", "left").join(
        labels.select("transaction_id", F.col("label_timestamp").alias("emit_at"), "is_fraud"),
        "transaction_id",
        "left",
    )


def quality_report(data: dict[str, DataFrame], low: float = 0.005, high: float = 0.010) -> DataFrame:
    """Checks of a synthetic set: unique keys, parents, order of times, amounts, no label columns, share of frauds."""
    from sluice.functions.predicates import leaking_columns
    from sluice.operators import quality as Q

    t, labels = data["transactions"].drop("scenario", "execution", "label_expected"), data["labels"]
    n = lambda df: df.agg(F.count("*").alias("n"))
    share = labels.agg(F.avg(F.col("is_fraud").cast("int")).alias("s")).select(F.when(F.col("s").between(low, high), 0).otherwise(1).alias("n"))
    keys = {
        "accounts": "account_id",
        "devices": "device_id",
        "wallets": "wallet_id",
        "transactions": "transaction_id",
        "labels": "event_id",
        "logins": "event_id",
    }
    checks = [(f"{k}_unique", Q.duplicate_extra_rows(data[k], c)) for k, c in keys.items()]
    checks += [(f"transactions_{c}_found", n(Q.orphans(t, c, data[p], k))) for c, p, k in (
        ("account_id", "accounts", "account_id"),
        ("device_id", "devices", "device_id"),
        ("source_wallet_id", "wallets", "wallet_id"),
        ("destination_wallet_id", "wallets", "wallet_id"),
    )]
    checks += [(f"transaction_{r.name}", n(t.filter(r.condition))) for r in Q.transaction_rules(1e-4)]
    checks.append((
        "labels_after_transactions",
        n(labels.join(t.select("transaction_id", F.col("event_timestamp").alias("_t")), "transaction_id").filter("label_timestamp <= _t")),
    ))
    checks.append(("no_label_columns", t.sparkSession.range(1).select(F.lit(len(leaking_columns(t.columns))).alias("n"))))
    checks.append(("fraud_share", share))
    return Q.checks(*checks)
