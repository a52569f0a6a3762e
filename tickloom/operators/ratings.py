"""Consensus ratings, rolling spend accounts, coverage and currency conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.bars import last_by_ticker
from tickloom.operators.sizes import by_date

# --- fixed values -----------------------------------------------------------
# Ratings from worst to best, valued 1 to 5.
RATINGS = ("strong_sell", "sell", "hold", "buy", "strong_buy")
# ---------------------------------------------------------------------------


def consensus(
    ratings: DataFrame,
    by: str = "ticker",
    rating: str = "rating",
    target: str = "price_target",
    analyst: str = "analyst",
) -> DataFrame:
    """Counts per rating, contributors, price targets and the mean rating.

    The label is the rating nearest to the mean value. Rows are first reduced to one
    per (ticker, analyst), which makes distinct analysts plain counts and spreads a
    much-rated ticker over many tasks.
    """
    code, goal = F.col(rating), F.col(target)
    order = F.array(*[F.lit(r) for r in RATINGS])
    position = F.array_position(order, code)
    value = F.when(position > 0, position)
    per_analyst = ratings.groupBy(by, analyst).agg(
        *[F.count_if(code == r).alias(f"{r}_ratings") for r in RATINGS],
        F.sum(value).alias("_values"),
        F.count(value).alias("_rated"),
        F.sum(goal).alias("_targets"),
        F.count(goal).alias("_aimed"),
        F.max(goal).alias("_high"),
        F.min(goal).alias("_low"),
    )
    known = F.col(analyst).isNotNull()
    out = per_analyst.groupBy(by).agg(
        *[F.sum(f"{r}_ratings").alias(f"{r}_ratings") for r in RATINGS],
        F.count_if(known & (F.col("_rated") > 0)).alias("ratings_contributors"),
        F.count_if(known & (F.col("_aimed") > 0)).alias("price_target_contributors"),
        F.try_divide(F.sum("_targets"), F.sum("_aimed")).alias("consensus_price_target"),
        F.max("_high").alias("high_price_target"),
        F.min("_low").alias("low_price_target"),
        F.try_divide(F.sum("_values"), F.sum("_rated")).alias("consensus_rating_value"),
    )
    nearest = F.floor(F.col("consensus_rating_value") + 0.5).cast("int")
    return out.withColumn("consensus_rating", F.get(order, nearest - 1))


def rolling_accounts(
    spend: DataFrame,
    days: tuple[int, ...] = (8, 28),
    by: str = "category",
    date: str = "date",
    account: str = "account",
    amount: str = "amount",
) -> DataFrame:
    """Daily spend, transactions and accounts per category, with trailing distinct accounts.

    An account counts on day D if it was active within ``n`` days up to D, which for
    one account is a union of intervals. Each activity opens an interval that lasts
    ``n`` days or until the next activity; the distinct count is the running sum of
    opens minus closes. Rows do not multiply with ``n``, and the input is read once.
    """
    active = spend.groupBy(by, account, date).agg(
        F.sum(amount).alias("_spend"), F.count(F.lit(1)).alias("_count")
    )
    following = F.lead(date).over(Window.partitionBy(by, account).orderBy(date))
    spans = active.withColumn("_next", following)

    def end(n: int):
        last = F.date_add(date, n)
        return F.least(last, F.coalesce("_next", last))

    def step(day, opens: int, closes: int | None):
        """A change on one day: everything opens at once, each length closes alone."""
        return F.struct(
            day.alias("_day"),
            (F.col("_spend") if opens else F.lit(0.0)).cast("double").alias("_spend"),
            (F.col("_count") if opens else F.lit(0)).cast("bigint").alias("_count"),
            F.lit(opens).alias("_accounts"),
            *[F.lit(opens - (n == closes)).alias(f"_open{n}") for n in days],
        )

    steps = [step(F.col(date), 1, None), *[step(end(n), 0, n) for n in days]]
    changes = (
        spans.select(by, F.inline(F.array(*steps)))
        .groupBy(by, "_day")
        .agg(
            F.sum("_spend").alias("total_spend"),
            F.sum("_count").alias("total_transactions"),
            F.sum("_accounts").alias("total_accounts"),
            *[F.sum(f"_open{n}").alias(f"_open{n}") for n in days],
        )
    )
    # One row per category and day from here on.
    running = Window.partitionBy(by).orderBy("_day").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return changes.select(
        by,
        F.col("_day").alias(date),
        "total_spend",
        "total_transactions",
        "total_accounts",
        *[F.sum(f"_open{n}").over(running).alias(f"rolling_{n}_day_accounts") for n in days],
    ).where(F.col("total_accounts") > 0)


def coverage(df: DataFrame, date: str, by: list[str]) -> DataFrame:
    """First and last date with data, days with data, and the empty day before."""
    return (
        df.groupBy(*by)
        .agg(
            F.min(date).alias("first_date"),
            F.max(date).alias("last_date"),
            F.count_distinct(date).alias("days"),
        )
        .withColumn("last_invalid_date", F.date_sub("first_date", 1))
    )


def coverage_gaps(
    df: DataFrame, calendar: DataFrame, date: str, by: list[str]
) -> DataFrame:
    """Trading days between a key's first and last date on which it has no data."""
    seen = df.select(*by, F.col(date).alias("date")).distinct()
    ahead = F.lead("date").over(Window.partitionBy(*by).orderBy("date"))
    gaps = seen.withColumn("_next", ahead).where(F.datediff("_next", "date") > 1)
    inside = gaps.select(
        *by,
        F.explode(F.sequence(F.date_add("date", 1), F.date_sub("_next", 1))).alias("date"),
    )
    return inside.join(by_date(calendar.select("date"), "date"), "date", "left_semi").select(
        *by, "date"
    )


def convert(amounts: DataFrame, quotes: DataFrame) -> DataFrame:
    """Amounts converted at the latest mid rate of their currency pair.

    ``amounts`` has from, to and initial_amount; ``quotes`` has ticker ``C:FROMTO``,
    bid_price, ask_price, sip_timestamp and sequence_number.
    """
    latest = last_by_ticker(quotes).select(
        F.col("ticker").alias("_pair"),
        F.struct(
            F.col("ask_price").alias("ask"),
            F.col("bid_price").alias("bid"),
            F.col("sip_timestamp").alias("timestamp"),
        ).alias("last"),
    )
    rate = (F.col("last.ask") + F.col("last.bid")) / 2
    return (
        amounts.withColumn("_pair", F.concat(F.lit("C:"), F.col("from"), F.col("to")))
        .join(latest, "_pair", "left")
        .withColumn("converted", F.col("initial_amount") * rate)
        .drop("_pair")
    )
