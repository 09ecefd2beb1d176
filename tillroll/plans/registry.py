"""Registry of named queries (one per inventory row / composite query)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import bronze, gold, oracle, qa, silver

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(spark, base):
    return silver.bronze(spark, base).drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


_QUERIES: dict[str, Query] = {
    "bronze_feed": _bronze,
    "q01_silver_build": silver.silver,
    "q02_silver_upsert": bronze.silver_upsert,
    "q02_silver_upsert_counts": bronze.silver_upsert_counts,
    "q03_price_evolution": gold.evolution,
    "q03_price_evolution_all": gold.evolution_all,
    "q03_change_alerts": gold.change_alerts,
    "q04_unit_catalogue": gold.unit_catalogue,
    "q05_recipe_costs": gold.recipe_costs,
    "q06_recipe_cost_summary": gold.recipe_cost_summary,
    "q07_recipe_cost_all_matches": gold.recipe_cost_all_matches,
    "q08_rule_cost_a": gold.rule_cost_a,
    "q08_rule_cost_b": gold.rule_cost_b,
    "q09_rule_pivot": gold.rule_pivot,
    "q10_exact_name_summary": gold.exact_name_summary,
    "q10_exact_name_unmatched": gold.exact_name_unmatched,
    "q10_exact_name_detail": gold.exact_name_detail,
    "q10_named_sale_catalogue": gold.named_sale_catalogue,
    "q11_match_diagnostics": gold.match_diagnostics,
    "q11_unmatched_ingredients": gold.unmatched_ingredients,
    "q12_exploration_summary": qa.exploration,
    "q12_exploration_extra": qa.exploration_extra,
    "q12_row_flags": qa.row_flags,
    "q13_t1_duplicate_keys": qa.t1_duplicates,
    "q13_t1_duplicate_keys_faulty": qa.t1_faulty,
    "q13_t2_null_counts_faulty": qa.t2_faulty,
    "q13_t4_id_consistency_faulty": qa.t4_faulty,
    "q13_t8_url_format_faulty": qa.t8_faulty,
    "q14_dq_suite_faulty": qa.suite_faulty,
    "q13_t2_null_counts": qa.t2_nulls,
    "q13_t3_price_range": qa.t3_price_range,
    "q13_t4_id_consistency": qa.t4_id_consistency,
    "q13_t5_freshness": qa.t5_freshness,
    "q13_t6_store_distribution": qa.t6_stores,
    "q13_t7_iqr_outliers": qa.t7_iqr,
    "q13_t8_url_format": qa.t8_urls,
    "q14_dq_suite": qa.dq_suite,
    "q15_rejection_rate": qa.rejection,
    "q15_rejection_rate_by_day": qa.rejection_by_day,
    "q16_rejected_rows": qa.rejected_rows,
    "q17_row_count": bronze.row_count,
    "q17_history_profile": bronze.history_profile,
    "q17_rows_per_load": bronze.rows_per_load,
    "q17_top_prices": bronze.top_prices,
    "q18_merge_preview": bronze.merge_preview,
    "q18_merge_preview_top": bronze.merge_preview_top,
    "q19_failed_events": bronze.failed_events,
    "q19_latest_run": bronze.latest_run,
    "q19_errors_of_day": bronze.errors_of_day,
    "q19_event_history": bronze.event_history,
    "q19_product_observations": bronze.product_observations,
    "q20_ingest_bronze": bronze.ingest_bronze,
    "q20_ingest_errors": bronze.ingest_errors,
    "q20_nested_bronze": bronze.nested_bronze,
    "q20_nested_errors": bronze.nested_errors,
    "q20_run_metrics": bronze.ingest_metrics,
    "q20_etl_events": bronze.ingest_events,
    "q20_summary_events": bronze.ingest_summary,
    "q20_target_metrics": bronze.target_metrics,
    "q20_target_events": bronze.target_events,
    "q20_text_stamps": bronze.text_stamps,
    "q22_store_comparison": gold.stores_compared,
    "q22_category_index": gold.category_indices,
    "q22_price_trend": gold.price_trends,
    "q20_low_success_runs": bronze.low_success_runs,
    "q20_ingest_bronze_numeric": bronze.ingest_bronze_numeric,
    "q21_product_listing": bronze.product_listing,
    "a02_targets": bronze.targets,
    "a02_target_counts": bronze.targets_count,
}

FLAGSHIP: Query = gold.recipe_cost_summary


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in oracle.SQL.items() if k in _QUERIES}
