"""Bank statements: running balances and generated ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsynth import rng
from docsynth.functions.dates import month_ends
from docsynth.operators.ordered import scan
from docsynth.operators.records import running

# What a movement is booked as, and through which channel.
REMARKS = ["工资", "ATM转账", "ATM取款", "消费", "现存"]
CHANNELS = ["ATM交易", "网上银行", "批量业务", "POS交易"]
CREDIT, DEBIT = "贷", "借"


def running_balance(ledger: DataFrame) -> DataFrame:
    """Balance after every movement of ``ledger(acct, ts, event_id, opening, cents)``; a day is one chunk of an account."""
    total = scan(ledger, ["acct"], {"day": F.to_date("ts")}, ["ts", "event_id"], sums={"moved": F.col("cents")})
    return total.select(
        "acct",
        "event_id",
        F.when(F.col("cents") > 0, CREDIT).otherwise(DEBIT).alias("direction"),
        (F.abs("cents") / 100).alias("amount"),
        ((F.col("opening") + F.col("moved")) / 100).alias("balance"),
    )


def statement_header(ledger: DataFrame) -> DataFrame:
    """One row per account: span, first kind of movement, closing balance; reduced map-side."""
    at = F.struct("ts", "event_id")
    return ledger.groupBy("acct").agg(
        F.date_format(F.min("ts"), "yyyy-MM-dd").alias("start"),
        F.date_format(F.max("ts"), "yyyy-MM-dd").alias("finish"),
        F.min_by("event_type", at).alias("first_kind"),
        ((F.first("opening") + F.sum("cents")) / 100).alias("closing"),
    )


def bank_statement(accounts: DataFrame) -> DataFrame:
    """10 to 20 month-end movements for every ``acct``, with all ledger columns.

    An account's movements are made in its own row and exploded, so no shuffle is needed for the running balance.
    """
    acct = F.col("acct")
    start = F.date_add(F.lit("2015-01-01").cast("date"), rng.integer(acct, 200, 0, 3000).cast("int"))
    base = accounts.select(
        "acct",
        start.alias("start"),
        rng.integer(acct, 201, 10, 20).cast("int").alias("n"),
        (rng.integer(acct, 202, 10000, 100000) * 100).alias("opening"),
        rng.draw(acct, 203).alias("seed"),
    )
    seq = F.sequence(F.lit(1), F.col("n"))
    cents = F.transform(seq, lambda i: (F.col("seed") + i * 7919 + i * i * 104729) % 200001 - 100000)
    made = base.withColumns({"days": month_ends(F.col("start"), F.col("n")), "cents": cents})
    made = made.withColumn("balances", running(F.col("opening"), F.col("cents")))
    rows = made.select("acct", "start", F.posexplode_outer(F.arrays_zip("days", "cents", "balances")).alias("i", "z"))
    ident = acct * 101 + F.col("i")
    amount = F.col("z.cents")
    return rows.select(
        F.date_format("z.days", "yyyy-MM-dd").alias("day"),
        "acct",
        rng.digits(acct, 204, 16).alias("card"),
        (F.col("i") + 1).alias("seq"),
        F.lit("RMB").alias("currency"),
        rng.integer(ident, 208, 0, 2).alias("code"),
        rng.pick(ident, 209, REMARKS).alias("remark"),
        F.when(amount > 0, CREDIT).otherwise(DEBIT).alias("direction"),
        (F.abs(amount) / 100).alias("amount"),
        (F.col("z.balances") / 100).alias("balance"),
        F.lit(0).alias("term"),
        F.lit("不转存").alias("renewal"),
        F.date_format("start", "yyyy-MM-dd").alias("value_from"),
        F.lit("2099-12-31").alias("value_to"),
        rng.digits(acct, 210, 6).alias("region"),
        rng.integer(ident, 211, 1000, 1099).alias("branch"),
        rng.integer(ident, 212, 10000, 19999).alias("operator"),
        rng.pick(ident, 213, CHANNELS).alias("channel"),
    )
