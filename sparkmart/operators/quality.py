"""Quality rules: checks, each one distributed pass to rows (rule, violations), and the quarantine of
rows that break a rule, which takes no pass of its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sparkmart.schemas import REJECT_REASON


def _as_rows(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """One aggregation for all rules, then one row per rule."""
    totals = df.agg(*[
        F.coalesce(F.count_if(broken), F.lit(0)).alias(rule) for rule, broken in counts.items()
    ])
    rules = F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("violations"))
        for rule in counts
    ])
    return totals.select(F.inline(rules))


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return _as_rows(df, {f"{c} is not null": F.col(f"`{c}`").isNull() for c in cols})


def check_length(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Strings longer than their declared limit; NULL fits any limit."""
    return _as_rows(df, {
        f"{c} fits varchar({n})": F.length(F.col(f"`{c}`")) > n for c, n in limits.items()
    })


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once.  Counted with a map-side combine."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return _as_rows(counts, {f"{', '.join(keys)} is unique": F.col("_rows") > 1})


def check_one_current(dim: DataFrame, key: str) -> DataFrame:
    """Business keys with more than one current version."""
    return check_unique(dim.filter("is_current"), [key])


def broken_rule(df: DataFrame, not_null: list[str] = (), limits: dict[str, int] | None = None) -> Column:
    """Name of the first rule a row breaks, NULL if it keeps all; columns ``df`` lacks have no rules."""
    rules = [F.when(F.col(f"`{c}`").isNull(), f"{c} is null") for c in not_null if c in df.columns]
    rules += [F.when(F.length(F.col(f"`{c}`")) > n, f"{c} is longer than {n}")
              for c, n in (limits or {}).items() if c in df.columns]
    return F.coalesce(*rules, F.lit(None).cast("string"))


def quarantine(df: DataFrame, not_null: list[str] = (), limits: dict[str, int] | None = None) -> DataFrame:
    """``df`` with ``reject_reason``: the reason a row has already, or else the rule it breaks.

    Evaluated row by row in the projection that is written; the writer puts rows with a reason
    into a partition of their own, so a bad row costs no pass and ends no load.
    """
    rule = broken_rule(df, not_null, limits)
    reason = F.coalesce(F.col(REJECT_REASON), rule) if REJECT_REASON in df.columns else rule
    return df.withColumn(REJECT_REASON, reason)


#: Counted as one outcome beside the reasons.
ACCEPTED = "accepted"


def observed(df: DataFrame, reasons: list[str]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` to be written, and a function that afterwards gives the rows of each outcome.

    The counts are taken by the job that writes ``df``.  ``reasons`` are those to tell apart; rows
    with another one are counted as ``other``.
    """
    reason = F.col(REJECT_REASON)
    seen = Observation()
    names = {f"r{i}": r for i, r in enumerate(reasons)}
    counted = df.observe(seen, F.count(F.lit(1)).alias("all"), F.count_if(reason.isNull()).alias("ok"),
                         *(F.count_if(reason == r).alias(n) for n, r in names.items()))

    def outcomes() -> dict[str, int]:
        got = seen.get
        out = {ACCEPTED: got["ok"], **{r: got[n] for n, r in names.items()}}
        return {k: n for k, n in {**out, "other": got["all"] - sum(out.values())}.items() if n}
    return counted, outcomes


def rule_names(not_null: list[str] = (), limits: dict[str, int] | None = None) -> list[str]:
    return [f"{c} is null" for c in not_null] + [f"{c} is longer than {n}" for c, n in (limits or {}).items()]
