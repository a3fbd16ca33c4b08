"""The frames a question may read, raw, curated and analytic, built once and shared."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tidemark.operators import curated, views


@dataclass(frozen=True)
class Frames:
    """Raw tables; curated tables and views derive from them unless written ones are passed."""

    users: DataFrame
    merchants: DataFrame
    transactions: DataFrame
    refunds: DataFrame
    stored_metrics: DataFrame | None = None
    stored_cohorts: DataFrame | None = None

    @cached_property
    def daily_merchant_metrics(self) -> DataFrame:
        if self.stored_metrics is not None:
            return self.stored_metrics
        return curated.daily_merchant_metrics(self.transactions, self.refunds, self.merchants)

    @cached_property
    def user_cohorts(self) -> DataFrame:
        if self.stored_cohorts is not None:
            return self.stored_cohorts
        return curated.user_cohorts(self.users, self.transactions)

    @cached_property
    def daily_gmv(self) -> DataFrame:
        return views.daily_gmv(self.daily_merchant_metrics)

    @cached_property
    def merchant_leaderboard(self) -> DataFrame:
        return views.merchant_leaderboard(self.daily_merchant_metrics)

    @cached_property
    def failure_reasons(self) -> DataFrame:
        return views.failure_reasons(self.transactions)

    @cached_property
    def retention_weekly(self) -> DataFrame:
        return views.retention_weekly(self.user_cohorts)

    def by_key(self) -> dict[str, DataFrame]:
        """Frames under their catalog keys, for guarded reads."""
        names = {
            "raw": ("users", "merchants", "transactions", "refunds"),
            "curated": ("daily_merchant_metrics", "user_cohorts"),
            "analytics": ("daily_gmv", "merchant_leaderboard", "failure_reasons", "retention_weekly"),
        }
        return {f"{layer}.{n}": getattr(self, n) for layer, group in names.items() for n in group}
