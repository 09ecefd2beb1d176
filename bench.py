"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every query is executed to the end with the ``noop`` sink (no collect to
the driver): one warm-up run, then the median of ``BENCH_RUNS`` (5) runs;
plan comparisons use ``BENCH_CMP_RUNS`` (3) and are not in the total.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tillroll.operators.upsert import merge_into_path  # noqa: E402
from tillroll.plans import registry  # noqa: E402
from tillroll.plans.silver import silver  # noqa: E402
from tillroll.session import build_session, materialise  # noqa: E402

HEADLINE = [
    "q01_silver_build", "q02_silver_upsert", "q03_price_evolution", "q04_unit_catalogue",
    "q05_recipe_costs", "q06_recipe_cost_summary", "q09_rule_pivot", "q12_exploration_summary",
    "q14_dq_suite", "q16_rejected_rows", "q20_ingest_bronze", "q20_run_metrics",
]
#: Timed as well; the total stays comparable with earlier rounds without them.
FURTHER = ["q11_match_diagnostics", "q12_row_flags", "q13_t7_iqr_outliers", "q15_rejection_rate", "q18_merge_preview"]


def q12_union_of_scans(bronze):
    """Comparison plan for Q12: one aggregate per check, unioned (the
    source's shape), instead of one aggregate + unpivot."""
    from tillroll.operators import quality as Q
    from tillroll.operators.clean import with_price
    valid = with_price(bronze, out="precio_num").where(F.col("precio_num") > 0)
    stats = Q.group_percentiles(valid, ["categoria"], "precio_num", {"_p99": 0.99, "_p01": 0.01})
    stats = stats.withColumnRenamed("categoria", "_cat")
    rows = valid.join(stats, valid.categoria.eqNullSafe(stats._cat))
    checks = [F.col("supermercado").isNull(), F.col("nombre").isNull(), F.col("categoria").isNull(),
              F.col("url").isNull() | (F.col("url") == ""), None,
              F.col("precio_num").cast("double") > F.col("_p99"), F.length("nombre") < 3]
    parts = []
    for i, c in enumerate(checks):
        if c is None:
            part = Q.duplicate_rows(valid, ["supermercado", "nombre", "fecha_extraccion"], "registros_problema")
        else:
            part = rows.agg(F.sum(Q.flag(c)).cast("long").alias("registros_problema"))
        parts.append(part.withColumn("tipo_validacion", F.lit(Q.EXPLORATION_LABELS[i])))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def match_per_row(cat, rec):
    """Comparison plan for Q5/Q6: the containment index built over every
    catalogue row instead of over distinct names."""
    from tillroll.functions.text import norm_text
    from tillroll.operators.dedup import latest_per_key
    k = (rec.withColumn("_nk", norm_text("ingrediente"))
            .withColumn("_klen", F.least(F.length("_nk"), F.lit(3)))
            .withColumn("_key", F.col("_nk").substr(F.lit(1), F.col("_klen"))))
    n = cat.withColumn("_nn", norm_text("nombre"))
    g = (n.withColumn("_g", F.explode(F.sequence(F.lit(1), F.lit(3))))
          .withColumn("_pos", F.explode(F.when(F.length("_nn") >= F.col("_g"),
                                               F.sequence(F.lit(1), F.length("_nn") - F.col("_g") + 1))))
          .withColumn("_gram", F.col("_nn").substr(F.col("_pos"), F.col("_g"))))
    j = g.join(k, (g._g == k._klen) & (g._gram == k._key))
    j = j.where(F.col("_nn").substr(F.col("_pos"), F.length("_nk")) == F.col("_nk"))
    j = j.dropDuplicates(["receta", "ingrediente", "nombre", "supermercado", "fecha_extraccion"])
    j = (j.withColumn("match_score", F.when(F.col("_nn") == F.col("_nk"), 1)
                      .when(F.col("_nn").startswith(F.col("_nk")), 2).otherwise(3))
          .withColumn("nombre_length", F.length("nombre")))
    best = latest_per_key(j, ["receta", "ingrediente", "fecha_extraccion"],
                          [F.col("match_score"), F.col("nombre_length"), F.col("nombre"), F.col("supermercado")])
    return best.withColumn("costo_ingrediente",
                           F.round(F.col("precio_unitario") * F.col("cantidad_necesaria"), 2).cast("decimal(18,2)"))


def comparisons(spark, base, scratch, runs):
    """Chosen plan vs the alternative, on derived layers (as the registered
    queries run) and on stored Bronze / Silver tables (as Gold runs in a
    deployed pipeline).  Not part of the headline total."""
    from tillroll.operators.costing import catalogue, ingredient_costs, recipe_summary
    from tillroll.operators.quality import exploration_summary
    from tillroll.plans import params as P
    from tillroll.plans.qa import bronze_rows
    bronze_path = f"{scratch}/bronze"
    bronze_rows(spark, base).write.parquet(bronze_path)
    stored_bronze = spark.read.parquet(bronze_path)
    stored_silver = spark.read.parquet(f"{scratch}/silver_stored")
    rec = P.recipes_df(spark)

    def summary(costs):
        return recipe_summary(costs, since=P.SINCE, comments=P.FIXTURE_COMMENTS)

    plans = {
        "q12_single_scan_derived": lambda: exploration_summary(bronze_rows(spark, base)),
        "q12_union_of_scans_derived": lambda: q12_union_of_scans(bronze_rows(spark, base)),
        "q12_single_scan_stored": lambda: exploration_summary(stored_bronze),
        "q12_union_of_scans_stored": lambda: q12_union_of_scans(stored_bronze),
        "q06_distinct_names_derived": lambda: summary(ingredient_costs(materialise(catalogue(silver(spark, base))), rec)),
        "q06_match_per_row_derived": lambda: summary(match_per_row(catalogue(silver(spark, base)), rec)),
        "q06_distinct_names_stored": lambda: summary(ingredient_costs(catalogue(stored_silver), rec)),
        "q06_match_per_row_stored": lambda: summary(match_per_row(catalogue(stored_silver), rec)),
    }
    return {name: timed(lambda f=f: run(f()), runs) for name, f in plans.items()}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    cmp_runs = int(os.environ.get("BENCH_CMP_RUNS", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          conf={"spark.driver.memory": "16g"})
    qs = registry.queries()
    for _ in range(2):  # JIT / codegen warm-up of the shared Silver plan
        run(qs["q01_silver_build"](spark, base))
    results = {}
    for name in HEADLINE:
        results[name] = timed(lambda n=name: run(qs[n](spark, base)), runs)

    # Upsert of one month into a written, date-partitioned history.
    scratch = tempfile.mkdtemp(prefix="tillroll-bench-", dir="/tmp")
    history = f"{scratch}/silver"
    s = silver(spark, base)
    s.write.partitionBy("fecha_extraccion").parquet(history)
    month = F.col("fecha_extraccion") == F.lit("1998-06-01").cast("date")

    def upsert_month():
        src = silver(spark, base).where(month).withColumn(
            "precio_normalizado", (F.col("precio_normalizado") + 1).cast("decimal(18,2)"))
        merge_into_path(spark, src, history)

    results["upsert_one_month_write"] = timed(upsert_month, runs)
    total = round(sum(results.values()), 3)
    for name in FURTHER:
        results[name] = timed(lambda n=name: run(qs[n](spark, base)), cmp_runs)
    # Alternative plans, reported for comparison only (not in the total).
    s.write.parquet(f"{scratch}/silver_stored")
    compared = comparisons(spark, base, scratch, cmp_runs)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": results, "sf": os.path.basename(base.rstrip("/")).replace("sf", ""),
                      "cpus": cpus, "runs": runs, "comparisons": compared}))


if __name__ == "__main__":
    main()
