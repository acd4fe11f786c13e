"""Row expectations, their counts, and load shedding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """A rule that should hold; ``drop`` removes rows that break it, else they are counted."""

    name: str
    rule: str
    drop: bool = False

    def holds(self) -> Column:
        # An unknown (null) outcome is a violation.
        return F.coalesce(F.expr(self.rule), F.lit(False))


# Expectations on decoded order changes, evaluated before projection.
ORDER_EXPECTATIONS = (
    Expectation("valid_op", "cdc_op IN ('c', 'u', 'r')", drop=True),
    Expectation("order_id_not_null", "after.order_id IS NOT NULL", drop=True),
    Expectation("amount_positive", "after.total_amount > 0"),
    Expectation("currency_valid", "after.currency IN ('USD', 'EUR', 'GBP', 'JPY')"),
)


def enforce(
    df: DataFrame, rules: tuple[Expectation, ...], observation: Observation | str | None = None
) -> DataFrame:
    """Rows that satisfy all drop rules.

    With an ``observation`` the violations of every rule are counted in the same
    pass (a name on streams, where they appear in the query progress).
    """
    if observation is not None:
        df = df.observe(
            observation, F.count(F.lit(1)).alias("rows"),
            *[F.count_if(~r.holds()).alias(r.name) for r in rules],
        )
    for rule in rules:
        if rule.drop:
            df = df.where(rule.holds())
    return df


def report(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """Passed and failed rows per rule, from one pass over the input.

    All rules see all rows; nothing is grouped, so the counts combine per task.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(r.holds()).alias(f"ok_{i}") for i, r in enumerate(rules)],
    )
    entries = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit("drop" if r.drop else "warn").alias("action"),
            F.col(f"ok_{i}").alias("passed"),
            (F.col("n") - F.col(f"ok_{i}")).alias("failed"),
        )
        for i, r in enumerate(rules)
    ])
    return counts.select(F.explode(entries).alias("e")).select("e.*")


def shed_load(
    df: DataFrame, keep: Column, key: Column, percent: int = 1, hashed: bool = True
) -> DataFrame:
    """Keep the rows matching ``keep`` and ``percent`` of the others.

    The choice depends on the key alone, so a replay keeps the same rows: the
    first 15 hex digits of the key's MD5, a number that other engines compute as
    well. A null key counts as the empty text. With ``hashed=False`` a numeric
    key is used as it is.
    """
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    slot = F.pmod(F.conv(digest, 16, 10).cast("long") if hashed else key, F.lit(100))
    return df.where(F.coalesce(keep, F.lit(False)) | (slot < percent))
