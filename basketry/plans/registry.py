"""

Each query takes ``(spark, sf_dir)``, derives the five order tables from the
test tables in ``sf_dir`` (fixture mapping "dense") and returns a DataFrame.
Output columns are normalised for comparison with the SQL oracle: integral
columns are LONG and doubles are rounded to 9 decimals.

Fixture choices (FIXTURES.md): feature and model queries use the ``train``
scope (each user's latest order, as upstream) and, under the same name with the
suffix ``_all``, the whole history. Basket queries use the whole history with
minimum support 0.001 and minimum confidence 0.05, because at 0.2 the small
fixtures hold no rule at the check scale. Queries after the model take a
deterministic stand-in score (the user's reorder share, with threshold 0.7 in
the ``train`` scope and 0.25 over the whole history) so that they can be checked
by SQL; the boosted-tree scores feed the ``model_*`` queries: 50 rounds to the
outcome share, 70 rounds to the confusion matrix and the lists, as upstream.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.config import (
    LABEL_COL,
    MIN_SUPPORT,
    ROUNDS_FIRST,
    ROUNDS_SECOND,
    THRESHOLD,
    TOP_N_PRODUCTS,
    TOP_RULES,
    TRAIN_FRACTION_PERCENT,
    ModelParams,
)
from basketry.operators import apriori as ap
from basketry.operators import baskets as bk
from basketry.operators import boosting as bo
from basketry.operators import distinct as di
from basketry.operators import evaluate as ev
from basketry.operators import feature_store as fs
from basketry.operators import features as fe
from basketry.operators import model as mo
from basketry.operators import profile as pr
from basketry.operators import recommend as rc
from basketry.operators import rule_charts as ch
from basketry.operators import rules as ru
from basketry.operators import sketches as sk
from basketry.operators import split as sp
from basketry.functions.encode import binary_encode
from basketry.functions.joins import null_safe_join
from basketry.session import materialize, remove_path, scratch_path, written_paths
from basketry.sources import found_types as ft
from basketry.sources import sinks
from basketry.sources.fixtures import tpch_tables
from basketry.sources.tables import Tables

FOUND_TABLES = ("orders", "products", "aisles", "departments", "order_products_train", "order_products_prior")
BASKET_SCOPE = "all"
FEATURE_SCOPE = "train"
TOP_N = TOP_N_PRODUCTS
MIN_CONFIDENCE = 0.05
EVAL_THRESHOLDS = {"train": THRESHOLD, "all": 0.25}
STAND_IN_SCORE = "reorder_propotion_by_user"
PREVIEW_ROWS = 6
DOUBLE_DECIMALS = 9
SOURCES = ("orders", "lineitem", "part")


def normalise(df: DataFrame) -> DataFrame:
    """Integral columns as LONG, doubles rounded; names and order unchanged."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), DOUBLE_DECIMALS)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the source files: what cached results depend on."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for name in SOURCES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        status = fs.getFileStatus(path)
        for s in (fs.listStatus(path) if status.isDirectory() else [status]):
            found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return tuple(sorted(found))


class Context:
    """Per (session, data folder) store of the derived tables and shared plans.

    A context is valid for one state of the source files; when they change, the
    old one is released (its written tables are removed) and a new one built.
    """

    _cache: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.paths: list[str] = []
        self.stores: list[str] = []
        self._memo: dict = {}
        self.tables: Tables = self._owned(lambda: tpch_tables(spark, sf_dir, "dense", materialize_tables=True))

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> Context:
        key, state = (spark.sparkContext.applicationId, sf_dir.rstrip("/")), source_state(spark, sf_dir)
        held = cls._cache.get(key)
        if held is None or held[0] != state:
            if held is not None:
                held[1].release()
            held = cls._cache[key] = (state, cls(spark, sf_dir))
        return held[1]

    @classmethod
    def release_all(cls) -> None:
        for _, context in cls._cache.values():
            context.release()
        cls._cache.clear()

    def release(self) -> None:
        """Remove every table that was written for this context."""
        self._memo.clear()
        for path in self.paths:
            remove_path(self.spark, path)
        self.paths.clear()
        for name in self.stores:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.stores.clear()

    def _owned(self, build: Callable[[], object]):
        with written_paths() as paths:
            try:
                return build()
            finally:
                self.paths += paths

    def memo(self, name: str, build: Callable[[], object]):
        if name not in self._memo:
            self._memo[name] = self._owned(build)
        return self._memo[name]

    def scratch(self, name: str) -> str:
        path = scratch_path(self.spark, f"{name}-{uuid.uuid4().hex}")
        self.paths.append(path)
        return path

    # shared plans
    def base(self, scope: str = FEATURE_SCOPE) -> DataFrame:
        """Line table of a scope with the occurrence number, written once to the shared folder."""
        return self.memo(f"base-{scope}", lambda: materialize(fe.occurrence_line_base(self.tables, scope), "line_base"))

    def features(self, scope: str = FEATURE_SCOPE) -> DataFrame:
        """The feature table, written once to the shared folder and read back.

        This is the hand-off between the feature and model analyses upstream,
        and it cuts the lineage before the many queries that start from it.
        """
        def build():
            path = self.scratch(f"features-{scope}")
            sinks.write_parquet(fe.feature_table(self.tables, scope, base=self.base(scope)), path)
            return self.spark.read.parquet(path)
        return self.memo(f"features-{scope}", build)

    def store(self, scope: str = FEATURE_SCOPE) -> fs.UserStore:
        """The line base bucketed by user."""
        def build():
            store = fs.build_store(self.base(scope), self.scratch(f"store-{scope}"))
            self.stores.append(store.name)
            return store
        return self.memo(f"store-{scope}", build)

    def top(self) -> DataFrame:
        return self.memo("top", lambda: bk.top_products(self.tables.lines(BASKET_SCOPE), self.tables.products, TOP_N))

    def freq_named(self) -> DataFrame:
        return self.memo("freq_named", lambda: bk.lines_with_products(
            bk.frequent_order_lines(self.tables.lines(BASKET_SCOPE), TOP_N),
            self.tables.products))

    def baskets(self) -> DataFrame:
        # read by the basket count, the item count and the miners of every rule query: written once
        return self.memo("baskets", lambda: materialize(bk.baskets(self.freq_named()), "baskets"))

    def pair_rules(self) -> DataFrame:
        return self.memo("pair_rules", lambda: ru.pair_rules(self.baskets(), MIN_SUPPORT, MIN_CONFIDENCE))

    def fp_rules(self) -> DataFrame:
        """Rules of all sizes; written once, because each reading of the miner's result would mine again."""
        return self.memo("fp_rules", lambda: materialize(
            ru.fpgrowth_rules(self.baskets(), MIN_SUPPORT, MIN_CONFIDENCE), "rules"))

    def level_sets(self) -> DataFrame:
        """Frequent itemsets of all sizes by the level-wise miner."""
        return self.memo("level_sets", lambda: ap.frequent_sets(self.baskets(), MIN_SUPPORT))

    def holdout_stand_in(self, scope: str = FEATURE_SCOPE) -> DataFrame:
        return self.memo(f"holdout-{scope}", lambda: ev.threshold(
            sp.split_holdout(self.features(scope)), STAND_IN_SCORE, EVAL_THRESHOLDS[scope]))

    def model(self, rounds: int):
        def build():
            train = sp.split_train(self.features()).drop("eval_set")
            # the first trees of the longer model are those of the shorter one
            start = self.model(ROUNDS_FIRST) if rounds > ROUNDS_FIRST else None
            # both are fitted on the same bins, written once
            prepared = self.memo("tree_rows", lambda: bo.prepare(train))
            return bo.fit(train, ModelParams(rounds=rounds), start=start, prepared=prepared)
        return self.memo(f"model{rounds}", build)

    def holdout_scored(self, rounds: int) -> DataFrame:
        test = sp.split_holdout(self.features()).drop("eval_set")
        return ev.threshold(bo.score(self.model(rounds), test), mo.SCORE_COL, THRESHOLD)

    def lists_by_csv(self, df: DataFrame, name: str) -> DataFrame:
        """K2 / K3: a per-user list as upstream hands it on, written as CSV and read back."""
        path = self.scratch(name)
        sinks.write_csv(df, path)
        return sinks.read_csv(self.spark, path, ", ".join(f"{n} {t}" for n, t in df.dtypes))


def _ctx(spark, sf_dir) -> Context:
    return Context.get(spark, sf_dir)


# ---------------------------------------------------------------- sources / sinks
def q_scan_orders(spark, d):
    return _ctx(spark, d).tables.orders


def q_scan_products(spark, d):
    return _ctx(spark, d).tables.products


def q_scan_departments(spark, d):
    return _ctx(spark, d).tables.departments


def q_scan_aisles(spark, d):
    return _ctx(spark, d).tables.aisles


def q_scan_order_products_train(spark, d):
    return _ctx(spark, d).tables.order_products_train


def q_scan_order_products_all(spark, d):
    return _ctx(spark, d).tables.lines("all")


def q_feature_table_roundtrip(spark, d, scope=FEATURE_SCOPE):
    """S7 + K1: the written feature table read back."""
    return _ctx(spark, d).features(scope)


# ---------------------------------------------------------------- profiling
def q_profile_shape(spark, d):
    c = _ctx(spark, d)
    t = c.tables
    return pr.shapes({"orders": t.orders, "products": t.products, "aisles": t.aisles,
                      "departments": t.departments, "order_products_train": t.order_products_train,
                      "order_products_prior": t.order_products_prior, "top_products": c.top(),
                      "frequent_order_lines": c.freq_named()})


def q_profile_nulls(spark, d, scope=FEATURE_SCOPE):
    return pr.null_counts(fe.order_line_base(_ctx(spark, d).tables, scope))


def q_profile_schema(spark, d, scope=FEATURE_SCOPE):
    return pr.schema_table(_ctx(spark, d).features(scope))


def q_profile_on_write(spark, d, scope=FEATURE_SCOPE):
    """Q1, Q2 as metrics of the job that writes the line table."""
    c = _ctx(spark, d)
    return sinks.write_observed(fe.order_line_base(c.tables, scope), c.scratch(f"observed-{scope}"))


def q_csv_found_types(spark, d):
    """The order tables written as CSV, their column types found from all rows."""
    c = _ctx(spark, d)
    out = []
    for name in FOUND_TABLES:
        path = c.scratch(f"csv-{name}")
        sinks.write_csv(getattr(c.tables, name), path)
        out.append(ft.found_types(spark, path).select(F.lit(name).alias("table"), "*"))
    return functools.reduce(DataFrame.unionByName, out)


def q_preview_head(spark, d, scope=FEATURE_SCOPE):
    return pr.preview(fe.order_line_base(_ctx(spark, d).tables, scope), ["order_id", "add_to_cart_order"],
                      PREVIEW_ROWS)


# ---------------------------------------------------------------- projections / filters
def q_fill_days_since_prior(spark, d):
    return fe.fill_days_since_prior(_ctx(spark, d).tables.orders)


def q_user_features_filled(spark, d, scope=FEATURE_SCOPE):
    return fe.user_features_filled(_ctx(spark, d).base(scope))


def q_freq_order_lines(spark, d):
    t = _ctx(spark, d).tables
    return bk.frequent_order_lines(t.lines(BASKET_SCOPE), TOP_N)


def q_feature_table(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)
    return c.memo(f"feature_table-{scope}", lambda: fe.feature_table(c.tables, scope, base=c.base(scope)))


def q_basket_incidence(spark, d):
    c = _ctx(spark, d)
    return bk.numbered_incidence(c.freq_named(), bk.item_names(c.top()), TOP_N)


def q_basket_item_names(spark, d):
    """The names behind the numbered columns of ``basket_incidence``."""
    names = _ctx(spark, d).top().select("product_name").where("product_name is not null").distinct()
    # at most TOP_N names, so one task ranks them
    return names.select(F.row_number().over(Window.orderBy("product_name")).alias("item"), "product_name")


def q_rules_lift_gt1(spark, d):
    return ru.rule_labels(ru.filter_lift(_ctx(spark, d).fp_rules()))


def q_threshold_predictions(spark, d, scope=FEATURE_SCOPE):
    return _ctx(spark, d).holdout_stand_in(scope).select(
        "user_id", "order_number", "product_id", "add_to_cart_order", LABEL_COL, STAND_IN_SCORE, ev.PRED_COL)


def q_outcome_share(spark, d, scope=FEATURE_SCOPE):
    return ev.outcome_share(_ctx(spark, d).holdout_stand_in(scope))


def q_predicted_products(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)
    return rc.predicted_products(c.holdout_stand_in(scope), c.tables.products)


def q_actual_products(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)
    return rc.actual_products(c.holdout_stand_in(scope), c.tables.products)


# ---------------------------------------------------------------- joins
def q_join_orders_lines(spark, d, scope=FEATURE_SCOPE):
    return fe.join_orders_lines(_ctx(spark, d).tables, scope)


def q_order_line_base(spark, d, scope=FEATURE_SCOPE):
    return fe.order_line_base(_ctx(spark, d).tables, scope)


def q_lines_with_products(spark, d):
    t = _ctx(spark, d).tables
    return bk.lines_with_products(t.lines(BASKET_SCOPE), t.products)


def q_freq_lines_with_products(spark, d):
    return _ctx(spark, d).freq_named()


def q_top_products(spark, d):
    return _ctx(spark, d).top()


def q_user_unique_products(spark, d, scope=FEATURE_SCOPE):
    return fe.with_user_unique_products(_ctx(spark, d).base(scope)).drop(fe.OCCURRENCE)


def q_product_feature_wide(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)
    return c.memo(f"product_wide-{scope}", lambda: fe.product_feature_wide(c.base(scope), c.tables))


def q_product_lines_fanout(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)
    return fe.product_lines_fanout(c.base(scope), c.tables, c.tables.lines(scope))


def q_product_base_suffix_join(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)
    return fe.product_base_suffix_join(fe.with_user_unique_products(c.base(scope)), c.tables)


def q_store_user_unique_products(spark, d, scope=FEATURE_SCOPE):
    """J6 on the bucketed line base."""
    return fs.with_user_unique_products(_ctx(spark, d).store(scope)).drop(fe.OCCURRENCE)


def q_store_feature_table(spark, d, scope=FEATURE_SCOPE):
    """E3 on the bucketed line base."""
    c = _ctx(spark, d)
    return fs.feature_table(c.store(scope), c.tables)


def q_distinct_purchases(spark, d):
    """Distinct rows of the raw lines without their cart position; repeated products of an order are duplicates."""
    lines = _ctx(spark, d).tables.lines(BASKET_SCOPE).select("order_id", "product_id", "reordered")
    return di.distinct_rows(lines)


def q_split_holdout(spark, d, scope=FEATURE_SCOPE):
    return sp.split_holdout(_ctx(spark, d).features(scope))


def q_split_train(spark, d, scope=FEATURE_SCOPE):
    return sp.split_train(_ctx(spark, d).features(scope))


def q_split_balance(spark, d, scope=FEATURE_SCOPE):
    return sp.split_balance(_ctx(spark, d).features(scope))


def q_split_stratified_balance(spark, d, scope=FEATURE_SCOPE):
    """M1 option: exact per-class 80 / 20 split; rows per (side, class)."""
    ft = _ctx(spark, d).features(scope)
    tr = sp.split_stratified(ft).groupBy(F.lit("train").alias("part"), LABEL_COL).agg(
        F.count(F.lit(1)).alias("n_rows"))
    ho = sp.split_stratified(ft, train=False).groupBy(F.lit("holdout").alias("part"), LABEL_COL).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return tr.unionByName(ho)


def q_split_exact_classes(spark, d, scope=FEATURE_SCOPE):
    """M1 option: which rows land where when every label class is cut exactly."""
    sides = sp.exact_sides(_ctx(spark, d).features(scope), F.col(LABEL_COL))
    return sides.select(*sp.KEYS, LABEL_COL, "part")


def q_split_exact_numeric(spark, d, scope=FEATURE_SCOPE):
    """M1 as upstream's partition of a numeric outcome: strata between its quantiles, each cut exactly."""
    ft = _ctx(spark, d).features(scope)
    return sp.exact_sides(ft, sp.numeric_strata(ft, "user_buy_product_times")).select(*sp.KEYS, LABEL_COL, "part")


# ---------------------------------------------------------------- aggregations / window
def q_product_frequency(spark, d):
    return bk.product_frequency(_ctx(spark, d).tables.lines(BASKET_SCOPE))


def q_product_features(spark, d, scope=FEATURE_SCOPE):
    return fe.product_features(_ctx(spark, d).base(scope))


def q_aisle_features(spark, d, scope=FEATURE_SCOPE):
    return fe.aisle_features(_ctx(spark, d).base(scope))


def q_department_features(spark, d, scope=FEATURE_SCOPE):
    return fe.department_features(_ctx(spark, d).base(scope))


def q_user_features(spark, d, scope=FEATURE_SCOPE):
    return fe.user_features(_ctx(spark, d).base(scope))


# group column and counted column of the distinct counts that have a sketched twin
SKETCHED = (("aisle", "aisle_id", "user_id"), ("department", "department_id", "user_id"),
            ("product", "product_id", "user_id"), ("user", "user_id", "product_id"))


def q_sketched_distinct(spark, d, scope=FEATURE_SCOPE):
    """G2-G5 as an option: distinct counts merged from daily sketches, held against the exact ones."""
    base = _ctx(spark, d).base(scope)
    parts = []
    for kind, by, value in SKETCHED:
        found = sk.merged_counts(sk.sketch_states(base, by, value, "order_dow"), by, "estimate")
        exact = base.groupBy(by).agg(F.count_distinct(value).alias("n"))
        off = 100 * F.abs(F.col("estimate") - F.col("n"))
        parts.append(null_safe_join(exact, found, [by]).select(
            F.lit(kind).alias("kind"), F.col(by).cast("long").alias("id"), "n",
            (off <= sk.TOLERANCE_PERCENT * F.col("n")).alias("close")))
    return functools.reduce(DataFrame.unionByName, parts)


def q_user_buy_product_times(spark, d, scope=FEATURE_SCOPE):
    return _ctx(spark, d).base(scope).select("order_id", "user_id", "product_id", "order_number", "add_to_cart_order",
                                        "user_buy_product_times")


def q_confusion_counts(spark, d, scope=FEATURE_SCOPE):
    return ev.confusion_counts(_ctx(spark, d).holdout_stand_in(scope))


def q_confusion_metrics(spark, d, scope=FEATURE_SCOPE):
    return ev.confusion_metrics(ev.confusion_counts(_ctx(spark, d).holdout_stand_in(scope)), positive=0)


def q_confusion_tests(spark, d, scope=FEATURE_SCOPE):
    return ev.confusion_tests(ev.confusion_counts(_ctx(spark, d).holdout_stand_in(scope)))


def q_binary_encode(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)

    def build():
        attrs = fe.product_attributes(c.base(scope), c.tables).select("product_id", "aisle", "department")
        return binary_encode(attrs, fe.ENCODED_COLS)
    return c.memo(f"encoded-{scope}", build)


# ---------------------------------------------------------------- baskets and rules
def q_baskets(spark, d):
    return _ctx(spark, d).baskets().select("order_id", F.array_join("items", ", ").alias("items"))


def q_frequent_itemsets(spark, d):
    its = ru.frequent_itemsets(_ctx(spark, d).baskets(), MIN_SUPPORT)
    return its.select(F.array_join("items", ", ").alias("items"), "freq", "support")


def q_apriori_itemsets(spark, d):
    c = _ctx(spark, d)
    n = float(max(ru.basket_count(c.baskets()), 1))
    return c.level_sets().select(F.array_join("set", ", ").alias("items"), F.col("n").alias("freq"),
                                 (F.col("n") / F.lit(n)).alias("support"))


def q_apriori_rules(spark, d):
    c = _ctx(spark, d)
    return ru.rule_labels(ap.rules_of(c.level_sets(), ru.basket_count(c.baskets()), MIN_CONFIDENCE))


def q_frequent_pairs(spark, d):
    r = _ctx(spark, d).memo("pairs_all", lambda: ru.pair_rules(_ctx(spark, d).baskets(), MIN_SUPPORT, 0.0))
    r = r.filter(F.col("antecedent")[0] < F.col("consequent")[0])
    return r.select(F.concat_ws(", ", F.col("antecedent")[0], F.col("consequent")[0]).alias("items"),
                    F.col("count").alias("freq"), "support")


def q_association_rules(spark, d):
    return ru.rule_labels(_ctx(spark, d).fp_rules())


def q_pair_rules(spark, d):
    return ru.rule_labels(_ctx(spark, d).pair_rules())


def q_top_rules(spark, d):
    return ru.rule_labels(ru.top_rules(_ctx(spark, d).fp_rules(), TOP_RULES))


def q_top_pair_rules(spark, d):
    return ru.rule_labels(ru.top_rules(_ctx(spark, d).pair_rules(), TOP_RULES))


def q_rule_scatter(spark, d):
    return ch.rule_scatter(_ctx(spark, d).fp_rules())


def q_rule_graph_edges(spark, d):
    return ch.rule_graph_edges(_ctx(spark, d).fp_rules())


def q_rule_matrix(spark, d):
    return ch.rule_matrix(_ctx(spark, d).fp_rules())


def q_rule_groups(spark, d):
    return ch.rule_groups(_ctx(spark, d).fp_rules())


# ---------------------------------------------------------------- model and lists
def q_assembled_width(spark, d):
    ft = sp.split_train(_ctx(spark, d).features()).drop("eval_set")
    cols = mo.feature_columns(ft)
    size = F.size(vector_to_array("features"))
    return mo.assembler(cols).transform(ft).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(cols)).cast("long").alias("n_inputs"),
        F.min(size).cast("long").alias("min_vector_size"), F.max(size).cast("long").alias("max_vector_size"))


def _scores(scored: DataFrame) -> DataFrame:
    return scored.select("user_id", "order_number", "product_id", "add_to_cart_order", LABEL_COL, mo.SCORE_COL,
                         ev.PRED_COL)


def q_model_scores(spark, d):
    return _scores(_ctx(spark, d).holdout_scored(ROUNDS_FIRST))


def q_model_scores_70(spark, d):
    return _scores(_ctx(spark, d).holdout_scored(ROUNDS_SECOND))


def q_model_outcome_share(spark, d):
    return ev.outcome_share(_ctx(spark, d).holdout_scored(ROUNDS_FIRST))


def q_model_confusion_counts(spark, d):
    return ev.confusion_counts(_ctx(spark, d).holdout_scored(ROUNDS_SECOND))


def q_model_confusion_metrics(spark, d):
    return ev.confusion_metrics(ev.confusion_counts(_ctx(spark, d).holdout_scored(ROUNDS_SECOND)), positive=0)


def q_model_predicted_vs_actual(spark, d):
    c = _ctx(spark, d)
    return c.lists_by_csv(rc.predicted_vs_actual(c.holdout_scored(ROUNDS_SECOND), c.tables.products), "model_lists")


def q_model_submission_list(spark, d):
    c = _ctx(spark, d)
    return c.lists_by_csv(rc.submission_list(c.holdout_scored(ROUNDS_SECOND)), "model_submission")


def q_model_roundtrip(spark, d):
    c = _ctx(spark, d)
    path = c.scratch("model")
    bo.save(spark, c.model(ROUNDS_FIRST), path)
    loaded = bo.load(spark, path)
    test = sp.split_holdout(c.features()).drop("eval_set")
    a = bo.score(c.model(ROUNDS_FIRST), test).select("user_id", "order_number", "add_to_cart_order",
                                                     F.col("score").alias("score_fitted"))
    b = bo.score(loaded, test).select("user_id", "order_number", "add_to_cart_order",
                                      F.col("score").alias("score_loaded"))
    return a.join(b, ["user_id", "order_number", "add_to_cart_order"], "inner")


def q_model_trees(spark, d):
    """K4: the 50-round model as a table of nodes."""
    c = _ctx(spark, d)
    path = c.scratch("model_trees")
    bo.save(spark, c.model(ROUNDS_FIRST), path)
    return spark.read.schema(bo.MODEL_SCHEMA).parquet(path)


def q_model_feature_gain(spark, d):
    """Splits and gain per feature of the 50-round model."""
    return bo.gain_by_feature(bo.model_table(spark, _ctx(spark, d).model(ROUNDS_FIRST)))


# features of few values: a tree over them can be refitted in SQL cut by cut
STUMP_FEATURES = ["order_dow", "order_hour_of_day", "days_since_prior_order", "add_to_cart_order", "order_number",
                  "department_id", "user_buy_product_times", "aisle_bin_1"]


def q_model_stump(spark, d, scope=FEATURE_SCOPE):
    """M3 with one round and one split, as a table of nodes."""
    train = sp.split_train(_ctx(spark, d).features(scope))
    nodes = bo.model_table(spark, bo.fit(train, ModelParams(rounds=1, depth=1), cols=STUMP_FEATURES))
    # what a node has not is shown as 0 or no text
    return nodes.select("tree", "node", F.coalesce("feature", F.lit("")).alias("feature"),
                        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("cut", "leaf", "gain")], "n_rows")


def q_feature_table_fitted(spark, d):
    """Option without label leakage: measures from the training side of the split only."""
    c = _ctx(spark, d)
    fit = sp.split_bucket() < TRAIN_FRACTION_PERCENT
    return c.memo("feature_table-fitted", lambda: fe.feature_table(c.tables, FEATURE_SCOPE, base=c.base(), fit_on=fit))


def q_predicted_vs_actual(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)
    return c.lists_by_csv(rc.predicted_vs_actual(c.holdout_stand_in(scope), c.tables.products), "lists")


def q_submission_list(spark, d, scope=FEATURE_SCOPE):
    c = _ctx(spark, d)
    return c.lists_by_csv(rc.submission_list(c.holdout_stand_in(scope)), "submission")


WHOLE_HISTORY = (
    "actual_products",
    "aisle_features",
    "binary_encode",
    "confusion_counts",
    "confusion_metrics",
    "confusion_tests",
    "department_features",
    "feature_table",
    "feature_table_roundtrip",
    "join_orders_lines",
    "model_stump",
    "order_line_base",
    "outcome_share",
    "predicted_products",
    "predicted_vs_actual",
    "preview_head",
    "product_base_suffix_join",
    "product_feature_wide",
    "product_features",
    "product_lines_fanout",
    "profile_nulls",
    "profile_on_write",
    "profile_schema",
    "sketched_distinct",
    "split_balance",
    "split_exact_classes",
    "split_exact_numeric",
    "split_holdout",
    "split_stratified_balance",
    "split_train",
    "store_feature_table",
    "store_user_unique_products",
    "submission_list",
    "threshold_predictions",
    "user_buy_product_times",
    "user_features",
    "user_features_filled",
    "user_unique_products",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
QUERIES |= {f"{name}_all": functools.partial(QUERIES[name], scope="all") for name in WHOLE_HISTORY}


def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalise(fn(spark, sf_dir))

    run.__name__ = name
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query(name) for name in QUERIES}
