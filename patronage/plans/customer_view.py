"""From the four input tables to the tables that are looked up: the unified customer view."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.numeric import MONEY, whole_days
from patronage.operators.cohort import active_customers, retention
from patronage.operators.linkage.components import match_clusters
from patronage.operators.linkage.rules import MatchRules
from patronage.operators.linkage.survive import crosswalk, golden_records, lineage
from patronage.operators.rfm import rfm_scores, rfm_segments
from patronage.operators.value.probabilistic import fit_buying, fit_spend, predict_value
from patronage.operators.value.summary import heuristic_value, summary_of_days
from patronage.operators.value.tiers import value_tiers
from patronage.plans.serving import search_index
from patronage.session import written
from patronage.sources.tables import get_table, load_tables


def unified_days(transactions: DataFrame, walk: DataFrame) -> DataFrame:
    """Purchases and money per unified customer and day.

    Ids outside the crosswalk (orphans) stay customers of their own. The rows
    are summed per customer and day before they meet the crosswalk.
    """
    daily = (
        transactions.where("customer_id IS NOT NULL")
        .groupBy("customer_id", F.to_date("date").alias("day"))
        .agg(F.count("transaction_id").alias("purchases"), F.sum(F.col("amount").cast(MONEY)).alias("spent"))
    )
    return (
        daily.join(walk.select("customer_id", "unified_id"), "customer_id", "left")
        .groupBy(F.coalesce("unified_id", "customer_id").alias("customer_id"), "day")
        .agg(F.sum("purchases").alias("purchases"), F.sum("spent").alias("spent"))
    )


def rfm_of_days(days: DataFrame, as_of: str) -> DataFrame:
    """Recency, frequency and monetary value from daily sums."""
    return days.groupBy("customer_id").agg(
        whole_days(F.to_timestamp(F.lit(as_of)), F.max("day")).alias("recency"),
        F.sum("purchases").alias("frequency"),
        F.coalesce(F.sum("spent").cast("double"), F.lit(0.0)).alias("monetary"),
    )


def predictions(summary: DataFrame, model: str = "bgnbd", months: int = 12, discount_rate: float = 0.01) -> DataFrame:
    """Predicted purchases and value by the named model; never switches model by itself."""
    if model == "heuristic":
        return heuristic_value(summary, months)
    if model == "bgnbd":
        return predict_value(summary, fit_buying(summary), fit_spend(summary), months, discount_rate)
    raise ValueError(f"unknown model {model!r}")


class CustomerView:
    """The result tables of the unified customers, each written when first asked for.

    Customers are resolved, their purchases rekeyed to the unified id, scored
    and valued. ``golden_records``, ``crosswalk``, ``rfm_scores``,
    ``clv_predictions`` and ``cohort_retention`` are what the look-ups read.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        as_of: str,
        rules: MatchRules = MatchRules(),
        value_model: str = "bgnbd",
        months: int = 12,
        discount_rate: float = 0.01,
    ):
        self.customers = tables["crm_customers"]
        self.transactions = tables["transactions"]
        self.as_of = as_of
        self.rules = rules
        self.value_model = value_model
        self.months = months
        self.discount_rate = discount_rate

    @cached_property
    def clusters(self) -> DataFrame:
        return written(match_clusters(self.customers, self.rules), "clusters")

    @cached_property
    def golden_records(self) -> DataFrame:
        return written(golden_records(self.customers, self.clusters), "golden")

    @cached_property
    def lineage(self) -> DataFrame:
        return written(lineage(self.customers, self.clusters), "lineage")

    @cached_property
    def crosswalk(self) -> DataFrame:
        return written(crosswalk(self.customers, self.clusters), "crosswalk")

    @cached_property
    def days(self) -> DataFrame:
        return written(unified_days(self.transactions, self.crosswalk), "days")

    @cached_property
    def search_index(self) -> DataFrame:
        return written(search_index(self.golden_records), "search-index")

    @cached_property
    def rfm_scores(self) -> DataFrame:
        metrics = written(rfm_of_days(self.days, self.as_of), "rfm")
        return written(rfm_segments(rfm_scores(metrics)), "scores")

    @cached_property
    def clv_predictions(self) -> DataFrame:
        last_day = self.days.agg(F.max("day").alias("d"))
        summary = written(summary_of_days(self.days, last_day), "summary")
        valued = predictions(summary, self.value_model, self.months, self.discount_rate)
        return written(value_tiers(written(valued, "valued")), "tiers")

    @cached_property
    def cohort_retention(self) -> DataFrame:
        return written(retention(active_customers(self.customers, self.transactions)), "retention")

    def share(self, other: CustomerView) -> None:
        """Take over from a view of the same tables and rules what does not depend on the value model."""
        self.clusters, self.golden_records, self.crosswalk = other.clusters, other.golden_records, other.crosswalk
        self.days = other.days

    def load(self, prefix: str, root: str, buckets: int = 32) -> dict[str, DataFrame]:
        """Save the tables that are looked up under ``prefix`` in the session catalog, and return them by name.

        All are bucketed alike by the unified id (the crosswalk by the customer id): a look-up
        of one id reads one bucket of each table, and they join without an exchange.
        """
        frames = {**self.tables(), "lineage": self.lineage}
        frames.pop("cohort_retention")
        keys = {"golden_records": "unified_id", "lineage": "unified_id"}
        load_tables(
            {prefix + name: df for name, df in frames.items()},
            root,
            {prefix + name: (buckets, keys.get(name, "customer_id")) for name in frames},
        )
        spark = self.customers.sparkSession
        return {name: get_table(spark, prefix + name) for name in frames}

    def tables(self) -> dict[str, DataFrame]:
        """All the tables the look-ups read, by name."""
        names = ("golden_records", "crosswalk", "rfm_scores", "clv_predictions", "cohort_retention")
        return {name: getattr(self, name) for name in names}
