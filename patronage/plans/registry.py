"""Every operator as a query over the parquet tables of one folder.

What several queries share (scored customers, the customer view, fitted models)
is written once per session and folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.functions.numeric import half_even
from patronage.operators import clustering, cohort, features, quality, rfm
from patronage.operators.linkage import components, normalise, pairs, report, survive
from patronage.operators.linkage.rules import MatchRules
from patronage.operators.value import boosted, probabilistic, summary, tiers
from patronage.plans import customer_view, serving
from patronage.session import apply_settings, shared_folder, written
from patronage.sources import derived, exports, tables

# "Now" of the queries: after the last order, so that results do not move.
AS_OF = "2002-01-01"

# Columns of the retention matrix, in months since signup.
MATRIX_AGES = list(range(-40, 90))

# Numbers of ranges for which the choice of k is checked.
GIVEN_KS = range(2, 8)

# Buckets of the tables that are looked up.
SERVED_BUCKETS = 8

SEARCH_TEXT = "Red"
PROFILE_ID = "GOLD_000005"
MEMBER_SEGMENT = "Loyal Customers"

Query = Callable[[SparkSession, str], DataFrame]


class Workspace:
    """The four input tables of a folder and the shared results derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir
        self._kept: dict[str, object] = {}

    def _once(self, name: str, make: Callable[[], object]):
        if name not in self._kept:
            self._kept[name] = make()
        return self._kept[name]

    def table(self, name: str) -> DataFrame:
        def make() -> DataFrame:
            df = derived.derived_table(self.spark, self.sf_dir, name)
            # The customers come out of joins, which would be run again at every use; the
            # others are projections of one table and read only the columns asked for.
            return written(df, name) if name == "crm_customers" else df

        return self._once(name, make)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in derived.DERIVED}

    @property
    def customers(self) -> DataFrame:
        return self.table("crm_customers")

    @property
    def transactions(self) -> DataFrame:
        return self.table("transactions")

    def rfm(self) -> DataFrame:
        return self._once("rfm", lambda: written(rfm.rfm_metrics(self.transactions, AS_OF), "rfm"))

    def scores(self) -> DataFrame:
        return self._once("scores", lambda: written(rfm.rfm_segments(rfm.rfm_scores(self.rfm())), "scores"))

    def features(self) -> DataFrame:
        return self._once(
            "features",
            lambda: written(
                features.segmentation_features(
                    self.scores(), self.table("web_sessions"), self.table("support_tickets")
                ),
                "features",
            ),
        )

    def value_features(self) -> DataFrame:
        return self._once(
            "value_features",
            lambda: written(
                features.value_features(
                    self.transactions, self.table("web_sessions"), self.table("support_tickets"), AS_OF
                ),
                "value-features",
            ),
        )

    def summary(self) -> DataFrame:
        return self._once("summary", lambda: written(summary.purchase_summary(self.transactions), "summary"))

    def pairs(self) -> DataFrame:
        return self._once("pairs", lambda: written(pairs.record_pairs(self.customers), "pairs"))

    def view(self) -> customer_view.CustomerView:
        return self._once(
            "view", lambda: customer_view.CustomerView(self.tables(), AS_OF, value_model="heuristic")
        )

    def served(self) -> dict[str, DataFrame]:
        """The look-up tables of the view in the session catalog, in buckets."""

        def make() -> dict[str, DataFrame]:
            run = uuid.uuid4().hex
            return self.view().load(f"served_{run}_", f"{shared_folder(self.spark)}/served-{run}", SERVED_BUCKETS)

        return self._once("served", make)

    def fitted_view(self) -> customer_view.CustomerView:
        """The view with the fitted value models, over the clusters and purchases of :meth:`view`."""

        def make() -> customer_view.CustomerView:
            fitted, plain = customer_view.CustomerView(self.tables(), AS_OF), self.view()
            fitted.share(plain)
            return fitted

        return self._once("fitted_view", make)

    def chosen_k(self) -> clustering.KChoice:
        return self._once("k", lambda: clustering.find_optimal_k(clustering.scale(self.features())))

    def clustered(self) -> DataFrame:
        return self._once(
            "clustered",
            lambda: written(clustering.fit_clusters(self.features(), self.chosen_k()), "clustered"),
        )

    def buying(self) -> probabilistic.BuyingModel:
        return self._once("buying", lambda: probabilistic.fit_buying(self.summary()))

    def spend(self) -> probabilistic.SpendModel:
        return self._once("spend", lambda: probabilistic.fit_spend(self.summary()))

    def boosted(self) -> boosted.BoostedFit:
        return self._once("boosted", lambda: boosted.fit_boosted(self.value_features(), "total_spend"))


_workspaces: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _workspaces:
        _workspaces[key] = Workspace(spark, sf_dir)
    return _workspaces[key]


def forget() -> None:
    """Drop the shared results, so that the next query starts from the input tables."""
    _workspaces.clear()


def _r(*names: str, digits: int = 6) -> list[Column]:
    return [half_even(F.col(n), digits).alias(n) for n in names]


# --- sources and sinks ------------------------------------------------------


def _load(ws: Workspace) -> dict[str, str]:
    """Load the four tables into the session catalog under names of their own."""

    def make() -> dict[str, str]:
        names = {name: f"patronage_{name}" for name in derived.DERIVED}
        root = f"{shared_folder(ws.spark)}/catalog-{uuid.uuid4().hex}"
        tables.load_tables({names[n]: df for n, df in ws.tables().items()}, root)
        return names

    return ws._once("loaded", make)


def s1_load_tables(ws: Workspace) -> DataFrame:
    names = _load(ws)
    return quality.row_counts({n: tables.get_table(ws.spark, t) for n, t in names.items()})


def s2_get_table(ws: Workspace) -> DataFrame:
    return tables.get_table(ws.spark, _load(ws)["transactions"])


def s3_table_exists(ws: Workspace) -> DataFrame:
    """Which of the loaded tables, and of a name that was never loaded, the catalog has."""
    names = _load(ws)
    asked = ws.spark.createDataFrame([(n,) for n in [*names, "invoices"]], "table_name string")
    found = [n for n in [*names, "invoices"] if tables.table_exists(ws.spark, names.get(n, f"patronage_{n}"))]
    counted = quality.row_counts(ws.tables())
    return asked.join(counted, "table_name", "left").select("table_name", F.col("table_name").isin(found).alias("found"))


def s4_review_export(ws: Workspace) -> DataFrame:
    path = f"{shared_folder(ws.spark)}/review-{uuid.uuid4().hex}"
    rows = e21_review_rows(ws)
    exports.write_csv(rows, path)
    return ws.spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(path)


def s5_segment_export(ws: Workspace) -> DataFrame:
    path = f"{shared_folder(ws.spark)}/segment-{uuid.uuid4().hex}"
    rows = d12_segment_members(ws)
    exports.write_csv(rows, path)
    return ws.spark.read.option("header", True).option("escape", '"').schema(rows.schema).csv(path)


def s6_profile_json(ws: Workspace) -> DataFrame:
    """The golden rows with their source ids; a row for each list of ids where there is more than one."""
    v = ws.view()
    rows = v.golden_records.drop("record_count").join(survive.source_id_lists(v.lineage).drop("part"), "unified_id")
    return exports.profile_json(rows)


# --- data quality -----------------------------------------------------------


def q1_row_counts(ws: Workspace) -> DataFrame:
    return quality.row_counts(ws.tables())


def q2_orphan_rate(ws: Workspace) -> DataFrame:
    return quality.orphan_transaction_rate(ws.transactions, ws.customers)


def q3_missing_email_rate(ws: Workspace) -> DataFrame:
    return quality.missing_email_rate(ws.customers)


def q4_duplicate_rate(ws: Workspace) -> DataFrame:
    return quality.duplicate_id_rate(ws.customers)


def q5_quality_report(ws: Workspace) -> DataFrame:
    return quality.quality_report(ws.tables())


# --- resolution -------------------------------------------------------------


def _form(column: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: normalise.normalise(ws.customers).select("rec_id", column)


def e5_block_sizes(ws: Workspace) -> DataFrame:
    return pairs.block_sizes(ws.customers)


def e5_pairs_at_floor(ws: Workspace) -> DataFrame:
    return ws.pairs().select("left_id", "right_id")


def _feature(*columns: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: ws.pairs().select("left_id", "right_id", *_r(*columns))


def e10_labels_at_floor(ws: Workspace) -> DataFrame:
    return ws.pairs().select("left_id", "right_id", "label")


def e11_review_queue(ws: Workspace) -> DataFrame:
    queue = pairs.review_candidates(ws.pairs())
    details = [
        half_even(F.col("comparison_details")[c], 6).alias(c) for c in pairs.FEATURES
    ]
    return queue.select("record_id_1", "record_id_2", *_r("confidence_score"), *details)


def e12_match_run_at_floor(ws: Workspace) -> DataFrame:
    rows = pairs.record_pairs(ws.customers)
    return rows.select("left_id", "right_id", *_r(*pairs.FEATURES, "score"), "label")


def e12_pair_counts(ws: Workspace) -> DataFrame:
    return pairs.pair_counts(ws.customers)


# Records compared if the first letter of the name or the zip code agrees.
TWO_BLOCKS = MatchRules(blocking=("first_letter", "zip_code"))


def e5_two_blocks_at_floor(ws: Workspace) -> DataFrame:
    """Pairs of two blocking fields together, each once."""
    rows = pairs.record_pairs(ws.customers, TWO_BLOCKS)
    return rows.select("left_id", "right_id", *_r("score"))


def e5_two_blocks_counts(ws: Workspace) -> DataFrame:
    return pairs.pair_counts(ws.customers, TWO_BLOCKS)


def e13_components(ws: Workspace) -> DataFrame:
    return components.connected_components(ws.pairs().where("label = 'match'").select("left_id", "right_id"))


def e13_match_clusters(ws: Workspace) -> DataFrame:
    return components.match_clusters(ws.customers)


def _golden(column: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: ws.view().golden_records.select("unified_id", column)


def e18_merge_all(ws: Workspace) -> DataFrame:
    return ws.view().golden_records


def e19_match_report(ws: Workspace) -> DataFrame:
    return report.match_report(ws.customers, pairs.pair_counts(ws.customers), ws.view().clusters)


def e20_score_histogram(ws: Workspace) -> DataFrame:
    return pairs.score_histogram(ws.customers)


def e20_five_bins(ws: Workspace) -> DataFrame:
    return pairs.full_histogram(ws.customers)


def e21_review_rows(ws: Workspace) -> DataFrame:
    rows = report.review_rows(ws.pairs(), ws.customers)
    return rows.select("left_id", "right_id", "left_name", "right_name", *_r("score", *pairs.FEATURES))


def e22_crosswalk(ws: Workspace) -> DataFrame:
    return ws.view().crosswalk


def e22_split_source_ids(ws: Workspace) -> DataFrame:
    return survive.split_source_ids(survive.source_id_lists(ws.view().lineage))


# --- recency, frequency, monetary -------------------------------------------


def r1_rfm_metrics(ws: Workspace) -> DataFrame:
    return rfm.rfm_metrics(ws.transactions, AS_OF)


def _score(column: str) -> Callable[[Workspace], DataFrame]:
    return lambda ws: rfm.rfm_scores(ws.rfm()).select("customer_id", column)


def r6_segments(ws: Workspace) -> DataFrame:
    return rfm.rfm_segments(rfm.rfm_scores(ws.rfm())).select("customer_id", "rfm_score", "segment")


def r7_rule_segments(ws: Workspace) -> DataFrame:
    """Customers labelled by rule: their triple is not in the table."""
    listed = [t for triples in rfm.SEGMENT_OF_SCORES.values() for t in triples]
    return ws.scores().where(~F.col("rfm_score").isin(listed)).select("customer_id", "rfm_score", "segment")


def r8_segment_summary(ws: Workspace) -> DataFrame:
    return rfm.segment_summary(ws.scores())


def r9_segment_overview(ws: Workspace) -> DataFrame:
    return rfm.segment_overview(ws.scores())


# --- clustering -------------------------------------------------------------


def g1_web_features(ws: Workspace) -> DataFrame:
    return features.web_features(ws.table("web_sessions"))


def g2_support_features(ws: Workspace) -> DataFrame:
    rows = features.support_features(ws.table("support_tickets"))
    return rows.withColumn("avg_resolution_time", *_r("avg_resolution_time"))


def g3_segmentation_features(ws: Workspace) -> DataFrame:
    rows = features.segmentation_features(ws.scores(), ws.table("web_sessions"), ws.table("support_tickets"))
    return rows.withColumn("avg_resolution_time", *_r("avg_resolution_time"))


def g4_scaled_features(ws: Workspace) -> DataFrame:
    scaled = clustering.scale(ws.features())
    return scaled.select("customer_id", *_r(*clustering.feature_columns(scaled)))


def g5_inertia_sweep(ws: Workspace) -> DataFrame:
    return ws.chosen_k().frame(ws.spark).select("k", "inertia")


def g6_silhouette_sweep(ws: Workspace) -> DataFrame:
    return ws.chosen_k().frame(ws.spark).select("k", "silhouette")


def g7_optimal_k(ws: Workspace) -> DataFrame:
    return ws.chosen_k().frame(ws.spark).where("chosen").select("k")


def _choice_of_recency(ws: Workspace) -> DataFrame:
    """Figures and choice of k for labels known in advance: k equally wide ranges of recency."""

    def make() -> DataFrame:
        rows = ws.features().join(ws.scores().select("customer_id", "recency"), "customer_id")
        ranged = written(rows.withColumn("widest", rows.agg(F.max("recency")).scalar()), "ranges")
        # The labels are no features.
        labels = {k: F.expr(f"recency * {k} DIV (widest + 1)") for k in GIVEN_KS}
        scaling = clustering.Scaling.of(ranged.drop("recency", "widest"))
        choice = clustering.choice_for(scaling.apply(ranged), labels, list(scaling.means))
        return choice.frame(ws.spark).select("k", *_r("inertia", "silhouette"), "chosen")

    return ws._once("choice_of_recency", make)


def g5_inertia_of_recency(ws: Workspace) -> DataFrame:
    return _choice_of_recency(ws).select("k", "inertia")


def g6_silhouette_of_recency(ws: Workspace) -> DataFrame:
    return _choice_of_recency(ws).select("k", "silhouette")


def g7_choice_of_recency(ws: Workspace) -> DataFrame:
    return _choice_of_recency(ws).select("k", "chosen")


def g8_fit_clusters(ws: Workspace) -> DataFrame:
    return ws.clustered()


def g8_fit_certificate(ws: Workspace) -> DataFrame:
    """Customers, and those nearer to the mean of a cluster that is not theirs."""
    return clustering.fit_certificate(ws.clustered()).select("points", "off_nearest")


def g9_cluster_profiles(ws: Workspace) -> DataFrame:
    return clustering.cluster_profiles(ws.clustered())


def g9_profiles_by_recency(ws: Workspace) -> DataFrame:
    """The same roll-up for a labelling known in advance: the recency score."""
    return clustering.cluster_profiles(ws.features().withColumn("cluster", F.col("r_score") - 1))


def g10_pca_projection(ws: Workspace) -> DataFrame:
    return clustering.pca_projection(ws.clustered())


def g10_component_variances(ws: Workspace) -> DataFrame:
    """Variances along the two projected axes, their covariance, and the variance of all features together."""
    labelled = ws.features().withColumn("cluster", F.col("r_score"))
    xy = clustering.pca_projection(labelled)
    found = clustering.principal_components(clustering.scale(ws.features()))
    figures = {
        "variance_x": F.var_samp("pca_x"), "variance_y": F.var_samp("pca_y"),
        "covariance": F.abs(F.covar_samp("pca_x", "pca_y")), "total_variance": F.lit(found.total_variance),
    }
    return xy.agg(*[half_even(v, 5).alias(k) for k, v in figures.items()])


# --- lifetime value ---------------------------------------------------------


def c1_purchase_summary(ws: Workspace) -> DataFrame:
    return summary.purchase_summary(ws.transactions)


def c2_simple_summary(ws: Workspace) -> DataFrame:
    return summary.purchase_summary(ws.transactions, "simple")


def c3_buying_model(ws: Workspace) -> DataFrame:
    return ws.buying().frame(ws.spark)


def c4_spend_model(ws: Workspace) -> DataFrame:
    return ws.spend().frame(ws.spark)


# Parameters at which the likelihoods are compared; near those of a shop with monthly buyers.
GIVEN_BUYING = probabilistic.BuyingModel(0.8, 60.0, 0.7, 2.5)
GIVEN_SPEND = probabilistic.SpendModel(4.0, 3.5, 90_000.0)


def c3_fit_certificate(ws: Workspace) -> DataFrame:
    """Customers behind the fit, whether its gradient vanishes, and how many neighbouring points fit better."""
    return probabilistic.certified(ws.summary(), ws.buying())


def c4_fit_certificate(ws: Workspace) -> DataFrame:
    return probabilistic.certified(ws.summary(), ws.spend())


def c3_buying_likelihood(ws: Workspace) -> DataFrame:
    rows = probabilistic.likelihoods(ws.summary(), GIVEN_BUYING)
    return rows.withColumn("log_likelihood", *_r("log_likelihood"))


def c4_spend_likelihood(ws: Workspace) -> DataFrame:
    rows = probabilistic.likelihoods(ws.summary().where("frequency > 0"), GIVEN_SPEND)
    return rows.withColumn("log_likelihood", *_r("log_likelihood"))


def _predicted(ws: Workspace) -> DataFrame:
    return probabilistic.predict_value(ws.summary(), ws.buying(), ws.spend())


def c5_predicted_purchases(ws: Workspace) -> DataFrame:
    return _predicted(ws).select("customer_id", "predicted_purchases")


def c6_predicted_clv(ws: Workspace) -> DataFrame:
    return _predicted(ws).select("customer_id", "predicted_clv")


def c5_purchases_at_given(ws: Workspace) -> DataFrame:
    """Predicted purchases at given parameters."""
    rows = probabilistic.predict_value(ws.summary(), GIVEN_BUYING, GIVEN_SPEND)
    return rows.select("customer_id", *_r("predicted_purchases"))


def c6_value_at_given(ws: Workspace) -> DataFrame:
    """Predicted value at given parameters, and its discounted monthly purchases times the expected spend."""
    rows = probabilistic.predict_value(ws.summary(), GIVEN_BUYING, GIVEN_SPEND)
    return rows.select("customer_id", *_r("predicted_clv", digits=2))


def c7_heuristic_value(ws: Workspace) -> DataFrame:
    return summary.heuristic_value(summary.purchase_summary(ws.transactions))


def c8_transaction_features(ws: Workspace) -> DataFrame:
    rows = features.transaction_features(ws.transactions, AS_OF)
    return rows.withColumn("std_order", *_r("std_order"))


def c9_web_features(ws: Workspace) -> DataFrame:
    return g1_web_features(ws).select(
        "customer_id",
        F.col("web_sessions").alias("total_sessions"),
        "avg_pages",
        F.col("avg_time").alias("avg_time_on_site"),
    )


def c10_support_features(ws: Workspace) -> DataFrame:
    return g2_support_features(ws).select("customer_id", "ticket_count", "avg_satisfaction")


def c11_value_features(ws: Workspace) -> DataFrame:
    rows = features.value_features(
        ws.transactions, ws.table("web_sessions"), ws.table("support_tickets"), AS_OF
    )
    return rows.withColumn("std_order", *_r("std_order"))


def c12_boosted_predictions(ws: Workspace) -> DataFrame:
    return ws.boosted().predictions.select("customer_id", "label", "prediction")


def c12_training_means(ws: Workspace) -> DataFrame:
    """Rows and mean label and prediction of the training rows: leaves are means, so both means are one."""
    rows = ws.boosted().predictions.where("NOT held_out")
    return rows.agg(F.count(F.lit(1)).alias("customers"), half_even(F.avg("label"), 2).alias("label"), half_even(F.avg("prediction"), 2).alias("prediction"))


def c13_holdout_errors(ws: Workspace) -> DataFrame:
    return ws.boosted().metrics_frame(ws.spark).select("mae", "r2")


def c13_errors_recomputed(ws: Workspace) -> DataFrame:
    """Held-out rows with their mean label, and how far the reported errors are from those of the listed predictions."""
    fit = ws.boosted()
    held = fit.predictions.where("held_out")
    off = F.col("label") - F.col("prediction")
    mae, r2 = F.avg(F.abs(off)), 1 - F.sum(off * off) / (F.var_pop("label") * F.count("label"))
    return held.agg(
        F.count(F.lit(1)).alias("customers"), half_even(F.avg("label"), 2).alias("label"),
        half_even(F.abs(mae - F.lit(fit.mae)) / F.avg("label"), 6).alias("mae_gap"), half_even(F.abs(r2 - F.lit(fit.r2)), 6).alias("r2_gap"),
        (F.lit(fit.r2) > 0.8).alias("explains"),
    )


def c14_cross_validation(ws: Workspace) -> DataFrame:
    return ws.boosted().metrics_frame(ws.spark).select("cv_scores")


def c14_folds(ws: Workspace) -> DataFrame:
    """Rows and mean label of every fold, and whether the model that has not seen it explains most of its variance."""
    off = F.col("label") - F.col("fold_prediction")
    explained = 1 - F.avg(off * off) / F.var_pop("label")
    rows = ws.boosted().predictions.groupBy("fold")
    return rows.agg(F.count(F.lit(1)).alias("customers"), half_even(F.avg("label"), 2).alias("label"), (explained > 0.8).alias("explains"))


def c15_feature_importance(ws: Workspace) -> DataFrame:
    return ws.boosted().importance_frame(ws.spark)


def c15_gain_accounts(ws: Workspace) -> DataFrame:
    """Variance of the training labels, and what of it the gains of the first tree leave unaccounted for.

    The gains of a tree are what it takes from the sum of squares, which is worked out again from
    the values of its leaves.
    """
    fit = ws.boosted()
    first = fit.model.trees[0]
    rows = fit.predictions.where("NOT held_out").select("customer_id", "label")
    leaves = boosted.BoostedTrees(fit.model.columns, fit.model.edges, fit.model.start, 1.0, [first])
    placed = leaves.transform(ws.value_features()).join(rows, "customer_id")
    left = F.col("label") - F.col("prediction")
    n, variance = F.count(F.lit(1)), F.var_pop("label")
    gap = (n * variance - F.sum(left * left) - F.lit(float(first.gain.sum()))) / (n * variance)
    return placed.agg(n.alias("customers"), half_even(F.sqrt(variance), 2).alias("deviation"), half_even(F.abs(gap), 6).alias("gap"))


def c16_value_tiers(ws: Workspace) -> DataFrame:
    valued = written(summary.heuristic_value(ws.summary()), "valued")
    return tiers.value_tiers(valued).select("customer_id", "predicted_clv", "clv_tier")


# --- cohorts ----------------------------------------------------------------


def h1_cohorts(ws: Workspace) -> DataFrame:
    return cohort.cohorts(ws.customers, ws.transactions).select(
        "transaction_id", "customer_id", "date", "amount", "cohort_month", "transaction_month"
    )


def h2_cohort_age(ws: Workspace) -> DataFrame:
    return cohort.cohorts(ws.customers, ws.transactions).select("transaction_id", "cohort_age")


def h3_active_customers(ws: Workspace) -> DataFrame:
    return cohort.active_customers(ws.customers, ws.transactions)


def h4_retention(ws: Workspace) -> DataFrame:
    return cohort.retention(cohort.active_customers(ws.customers, ws.transactions))


def h5_retention_matrix(ws: Workspace) -> DataFrame:
    return cohort.retention_matrix(ws.view().cohort_retention, MATRIX_AGES)


def h6_heatmap(ws: Workspace) -> DataFrame:
    return cohort.heatmap_cells(ws.view().cohort_retention)


def h7_cohort_metrics(ws: Workspace) -> DataFrame:
    return cohort.cohort_metrics(ws.customers, ws.transactions)


def h8_average_retention(ws: Workspace) -> DataFrame:
    return cohort.average_retention(ws.view().cohort_retention)


# --- look-ups ---------------------------------------------------------------


def d1_customer_search(ws: Workspace) -> DataFrame:
    v = ws.view()
    return serving.search_customers(v.golden_records, v.rfm_scores, v.clv_predictions, SEARCH_TEXT, index=v.search_index)


def d2_customer_profile(ws: Workspace) -> DataFrame:
    v = ws.view()
    return serving.customer_profile(v.golden_records, v.rfm_scores, v.clv_predictions, PROFILE_ID, v.lineage)


def d2_profile_of_bucket(ws: Workspace) -> DataFrame:
    """The same profile from the bucketed tables, of which one bucket each is read."""
    t = ws.served()
    return serving.customer_profile(t["golden_records"], t["rfm_scores"], t["clv_predictions"], PROFILE_ID, t["lineage"])


def d12_members_of_buckets(ws: Workspace) -> DataFrame:
    """The same members from the bucketed tables, joined without an exchange."""
    t = ws.served()
    return serving.segment_members(t["golden_records"], t["rfm_scores"], t["clv_predictions"], MEMBER_SEGMENT)


def d3_recent_transactions(ws: Workspace) -> DataFrame:
    return serving.recent_transactions(ws.transactions, ws.view().crosswalk)


def d4_recent_sessions(ws: Workspace) -> DataFrame:
    return serving.recent_sessions(ws.table("web_sessions"), ws.view().crosswalk)


def d5_recent_tickets(ws: Workspace) -> DataFrame:
    return serving.recent_tickets(ws.table("support_tickets"), ws.view().crosswalk)


def d6_segment_overview(ws: Workspace) -> DataFrame:
    return rfm.segment_overview(ws.view().rfm_scores)


def d7_tier_histogram(ws: Workspace) -> DataFrame:
    return tiers.tier_histogram(ws.view().clv_predictions)


def d8_tier_totals(ws: Workspace) -> DataFrame:
    return tiers.tier_totals(ws.view().clv_predictions)


def d9_tier_describe(ws: Workspace) -> DataFrame:
    return tiers.tier_describe(ws.view().clv_predictions)


def d7_fitted_histogram(ws: Workspace) -> DataFrame:
    """The tier histogram over the values of the fitted models."""
    return tiers.tier_histogram(ws.fitted_view().clv_predictions)


def d8_fitted_tier_sizes(ws: Workspace) -> DataFrame:
    """Customers per tier of the values of the fitted models: their quantiles follow from the number of customers."""
    return tiers.tier_totals(ws.fitted_view().clv_predictions).select("clv_tier", "customers")


def d9_fitted_describe(ws: Workspace) -> DataFrame:
    return tiers.tier_describe(ws.fitted_view().clv_predictions)


def d10_resolution_statistics(ws: Workspace) -> DataFrame:
    return serving.resolution_statistics(ws.customers, ws.view().golden_records)


def d11_segments(ws: Workspace) -> DataFrame:
    return serving.segments(ws.view().rfm_scores)


def d12_segment_members(ws: Workspace) -> DataFrame:
    v = ws.view()
    return serving.segment_members(v.golden_records, v.rfm_scores, v.clv_predictions, MEMBER_SEGMENT)


_QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {
    f.__name__: f
    for f in (
        s1_load_tables, s2_get_table, s3_table_exists, s4_review_export, s5_segment_export, s6_profile_json,
        q1_row_counts, q2_orphan_rate, q3_missing_email_rate, q4_duplicate_rate, q5_quality_report,
        e5_block_sizes, e5_pairs_at_floor, e5_two_blocks_at_floor, e5_two_blocks_counts, e10_labels_at_floor, e11_review_queue, e12_match_run_at_floor, e12_pair_counts,
        e13_components, e13_match_clusters, e18_merge_all, e19_match_report, e20_score_histogram, e20_five_bins,
        e21_review_rows, e22_crosswalk, e22_split_source_ids,
        r1_rfm_metrics, r6_segments, r7_rule_segments, r8_segment_summary, r9_segment_overview,
        g1_web_features, g2_support_features, g3_segmentation_features, g4_scaled_features, g5_inertia_sweep,
        g5_inertia_of_recency, g6_silhouette_sweep, g6_silhouette_of_recency, g7_optimal_k, g7_choice_of_recency,
        g8_fit_clusters, g8_fit_certificate, g9_cluster_profiles, g9_profiles_by_recency,
        g10_pca_projection, g10_component_variances,
        c1_purchase_summary, c2_simple_summary, c3_buying_model, c3_fit_certificate, c3_buying_likelihood,
        c4_spend_model, c4_fit_certificate, c4_spend_likelihood, c5_predicted_purchases, c5_purchases_at_given,
        c6_predicted_clv, c6_value_at_given, c7_heuristic_value, c8_transaction_features, c9_web_features, c10_support_features,
        c11_value_features, c12_boosted_predictions, c12_training_means, c13_holdout_errors, c13_errors_recomputed,
        c14_cross_validation, c14_folds, c15_feature_importance, c15_gain_accounts, c16_value_tiers,
        h1_cohorts, h2_cohort_age, h3_active_customers, h4_retention, h5_retention_matrix, h6_heatmap,
        h7_cohort_metrics, h8_average_retention,
        d1_customer_search, d2_customer_profile, d2_profile_of_bucket, d3_recent_transactions, d4_recent_sessions, d5_recent_tickets,
        d6_segment_overview, d7_tier_histogram, d7_fitted_histogram, d8_tier_totals, d8_fitted_tier_sizes,
        d9_tier_describe, d9_fitted_describe, d10_resolution_statistics,
        d11_segments, d12_segment_members, d12_members_of_buckets,
    )
}
_QUERIES |= {
    "e1_email_normalized": _form("email_normalized"),
    "e2_phone_normalized": _form("phone_normalized"),
    "e3_name_lower": _form("name_lower"),
    "e4_first_letter": _form("first_letter"),
    "e6_name_similarity_at_floor": _feature("name_similarity"),
    "e7_email_match_at_floor": _feature("email_match"),
    "e8_phone_similarity_at_floor": _feature("phone_similarity"),
    "e9_score_at_floor": _feature("score"),
    "e14_golden_lineage": lambda ws: ws.view().lineage,
    "e15_best_name": _golden("name"),
    "e16_best_email": _golden("email"),
    "e17_best_phone": _golden("phone"),
    "r2_r_score": _score("r_score"),
    "r3_f_score": _score("f_score"),
    "r4_m_score": _score("m_score"),
    "r5_rfm_score": _score("rfm_score"),
}


def _order(name: str) -> tuple[str, int, str]:
    head = name.split("_")[0]
    return "sqergchd".index(head[0]), int(head[1:]), name


def queries() -> dict[str, Query]:
    def bind(run: Callable[[Workspace], DataFrame]) -> Query:
        return lambda spark, sf_dir: run(workspace(spark, sf_dir))

    return {name: bind(_QUERIES[name]) for name in sorted(_QUERIES, key=_order)}
