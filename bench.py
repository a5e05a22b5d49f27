"""Benchmark the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8). Each query runs to completion through the ``noop`` sink (every row
is produced, nothing is collected) and is timed on its own; its row count is
printed beside it, so that a query without a result shows.

``load`` is the derivation of the five order tables from the test tables (an
adapter of the fixtures), ``line_base`` and ``baskets`` the writing of the
shared tables; the other queries start from written tables, so their order does
not matter. The rule queries mine baskets of part names, because the product
names of the default mapping give no rule at sf0.1 (FIXTURES.md section 5).
``value`` is the sum of all timings.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from basketry.operators import baskets as bk  # noqa: E402
from basketry.operators import rule_charts as ch  # noqa: E402
from basketry.operators import rules as ru  # noqa: E402
from basketry.plans.registry import BASKET_SCOPE, MIN_CONFIDENCE, MIN_SUPPORT, Context, query  # noqa: E402
from basketry.config import TOP_RULES  # noqa: E402
from basketry.session import build_session, materialize  # noqa: E402
from basketry.sources.fixtures import tpch_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

# queries that read the written tables of the shared context
HEADLINE = [
    "top_products",          # group, top-N, dimension join
    "feature_table",         # joins, occurrence window, four feature families, encoder
    "user_features",
    "user_features_all",     # the same over the whole history
    "product_feature_wide",
    "product_lines_fanout",
    "confusion_metrics",     # split, threshold, 2x2 measures (stand-in score)
    "predicted_vs_actual",   # per-user lists, join, CSV round trip
    "submission_list",
    "model_scores",          # boosted trees, 50 rounds, fit + score
]


def sf_label(path: str):
    base = os.path.basename(os.path.normpath(path))
    label = base[2:] if base.startswith("sf") else base
    try:
        return float(label)
    except ValueError:
        return label


def main() -> None:
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(8, CPUS * 2))
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name: str, build, count: bool = True):
        t = time.time()
        df = build()
        if df is not None:
            df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t, 3)
        if count and df is not None:
            rows[name] = df.count()
        print(f"# {name}: {timings[name]}s, {rows.get(name, '-')} rows", file=sys.stderr, flush=True)
        return df

    timed("load", lambda: (Context.get(spark, SF_DIR), None)[1])
    ctx = Context.get(spark, SF_DIR)
    timed("line_base", lambda: ctx.base())
    timed("line_base_all", lambda: ctx.base("all"))
    timed("features", lambda: ctx.features())

    # baskets of part names over the whole history
    named = tpch_tables(spark, SF_DIR, "part", materialize_tables=True)
    held = {}

    def baskets():
        held["baskets"] = materialize(
            bk.baskets(bk.lines_with_products(named.lines(BASKET_SCOPE), named.products)), "bench_baskets")
        return held["baskets"]

    def association_rules():
        held["rules"] = materialize(ru.fpgrowth_rules(held["baskets"], MIN_SUPPORT, MIN_CONFIDENCE), "bench_rules")
        return held["rules"]

    timed("baskets", baskets)
    timed("pair_rules", lambda: ru.pair_rules(held["baskets"], MIN_SUPPORT, MIN_CONFIDENCE))
    timed("association_rules", association_rules)
    timed("top_rules", lambda: ru.top_rules(held["rules"], TOP_RULES))
    timed("rule_scatter", lambda: ch.rule_scatter(held["rules"]))
    for name in HEADLINE:
        timed(name, lambda name=name: query(name)(spark, SF_DIR))
    total = round(sum(timings.values()), 3)
    # hold-out accuracy of the 50-round model at threshold 0.7 (upstream reports "a little over 77%"
    # on its own data) beside that of always answering "not reordered"; for orientation only
    scored = query("model_scores")(spark, SF_DIR)
    right = F.avg((F.col("prediction") == F.col("reordered")).cast("double"))
    acc, majority = scored.agg(right, F.avg((F.col("reordered") == 0).cast("double"))).first()
    print(json.dumps({"metric": "headline_total_seconds", "value": total, "unit": "sec", "queries": timings,
                      "rows": rows, "sf": sf_label(SF_DIR), "cpus": CPUS,
                      "holdout_accuracy": round(float(acc), 4) if acc is not None else None,
                      "holdout_majority": round(float(majority), 4) if majority is not None else None}))
    Context.release_all()
    spark.stop()


if __name__ == "__main__":
    main()
