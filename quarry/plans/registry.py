"""Query registry: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import analog, basics, exact_keys, feature_keys, learning_keys, model_jobs, reports, source_keys, sql_reports, text_reports
from quarry.sources.tables import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]


def _wh(fn: Callable[[Warehouse], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Warehouse(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


REPORT_QUERIES: dict[str, QueryFn] = {
    "created_by_month": _wh(reports.created_by_month),
    "registered_by_year": _wh(reports.registered_by_year),
    "hired_by_branch": _wh(reports.hired_by_branch),
    "not_hired_by_branch": _wh(reports.not_hired_by_branch),
    "hired_by_rank": _wh(reports.hired_by_rank),
    "contact_method_hired": _wh(reports.contact_method_hired),
    "contact_method_not_hired": _wh(reports.contact_method_not_hired),
    "group_count": _wh(reports.clients_per_branch),
    "group_count_job": _wh(reports.hires_per_job_function),
    "ratings_per_movie": _wh(reports.ratings_per_movie),
    "star_join_wide": _wh(reports.star_join_wide),
    "filter_join_project": _wh(reports.filter_join_project),
    "star_join_features": _wh(analog.client_features),
    "star_join_salted": _wh(analog.client_features_salted),
} | {name: _wh(report) for name, report in sql_reports.REPORTS.items()}


BASIC_QUERIES: dict[str, QueryFn] = {
    "project_columns": _wh(basics.project_columns),
    "derive_column": _wh(basics.derive_column),
    "drop_columns": _wh(basics.drop_columns),
    "try_cast_label": _wh(basics.try_cast_label),
    "filter_eq": _wh(basics.filter_eq),
    "filter_conjunction": _wh(basics.filter_conjunction),
    "filter_numeric_text": _wh(basics.filter_numeric_text),
    "lower_case": _wh(basics.lower_case),
    "count_value": _wh(basics.count_value),
    "count_value_ci": _wh(basics.count_value_ci),
    "row_count": _wh(basics.row_count),
    "distinct_one": _wh(basics.distinct_one),
    "distinct_many": _wh(basics.distinct_many),
    "describe_columns": _wh(basics.describe_columns),
    "describe_by_group": _wh(basics.describe_by_group),
    "limit_n": _wh(basics.limit_n),
    "strip_brackets": _wh(basics.strip_brackets_key),
    "split_list": _wh(basics.split_list),
    "pk_duplicates": _wh(basics.pk_duplicates),
    "fk_orphans": _wh(basics.fk_orphans),
    "self_fk_orphans": _wh(basics.self_fk_orphans),
    "not_null_violations": _wh(basics.not_null_violations),
}

TEXT_QUERIES: dict[str, QueryFn] = {
    "word_count": _wh(text_reports.word_count),
    "word_count_java": _wh(text_reports.word_count_java),
    "tokenize_regex": _wh(text_reports.tokenize_regex),
    "tokenize_ws": _wh(text_reports.tokenize_ws),
    "top_terms": _wh(text_reports.top_terms),
    "rarest_kept_terms": _wh(text_reports.rarest_kept_terms),
    "term_counts": _wh(text_reports.term_counts),
    "tfidf": _wh(text_reports.tfidf),
    "text_shape": _wh(text_reports.text_shape),
    "hashing_tf": _wh(text_reports.hashing_tf),
}

FEATURE_QUERIES: dict[str, QueryFn] = {
    "string_index": _wh(feature_keys.string_index),
    "one_hot_drop_last": _wh(feature_keys.one_hot_drop_last),
    "one_hot_all": _wh(feature_keys.one_hot_all),
    "assemble": _wh(feature_keys.assemble),
    "standard_scale": _wh(feature_keys.standard_scale),
    "normalize_l1": _wh(feature_keys.normalize_l1),
    "hash_split": _wh(feature_keys.hash_split),
    "hash_split_nested": _wh(feature_keys.hash_split_nested),
    "confusion_counts": _wh(feature_keys.confusion_counts),
    "classification_metrics": _wh(feature_keys.classification_metrics),
}

MODEL_QUERIES: dict[str, QueryFn] = {
    "feature_hash": _wh(model_jobs.feature_hash),
    "word2vec": _wh(model_jobs.word2vec),
    "decision_tree": _wh(model_jobs.decision_tree),
    "random_forest": _wh(model_jobs.random_forest),
    "kmeans": _wh(model_jobs.kmeans),
    "logistic_regression": _wh(model_jobs.logistic_regression),
    "pca": _wh(model_jobs.pca),
    "hiring_model_hashed": _wh(model_jobs.hiring_model_hashed),
    "hiring_model_indexed": _wh(model_jobs.hiring_model_indexed),
    "hiring_model_indexed_b": _wh(model_jobs.hiring_model_indexed_b),
    "cluster_profile": _wh(model_jobs.cluster_profile),
    "cluster_values": _wh(model_jobs.cluster_values),
    "cluster_combinations": _wh(model_jobs.cluster_combinations),
    "cluster_overall": _wh(model_jobs.cluster_overall),
    "text_features": _wh(model_jobs.text_features),
    "grid_search": _wh(model_jobs.grid_search),
    "grid_table": _wh(model_jobs.grid_table),
}

EXACT_QUERIES: dict[str, QueryFn] = {
    "hashing_tf_slots": _wh(exact_keys.hashing_tf_slots),
    "feature_hash_slots": _wh(exact_keys.feature_hash_slots),
    "decision_stump": _wh(exact_keys.decision_stump),
    "pca_rotation": _wh(exact_keys.pca_rotation),
    "pca_components": _wh(exact_keys.pca_components),
    "pca_hashed": _wh(exact_keys.pca_hashed),
}

LEARNING_QUERIES: dict[str, QueryFn] = {
    "random_split": _wh(learning_keys.random_split),
    "forest_bags": _wh(learning_keys.forest_bags),
    "forest_votes": _wh(learning_keys.forest_votes),
    "logistic_newton": _wh(learning_keys.logistic_newton),
    "area_under_curve": _wh(learning_keys.area_under_curve),
}

SOURCE_QUERIES: dict[str, QueryFn] = {
    "scan_csv": _wh(source_keys.scan_csv),
    "scan_csv_headerless": _wh(source_keys.scan_csv_headerless),
    "scan_text": _wh(source_keys.scan_text),
    "scan_json": _wh(source_keys.scan_json),
}


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    for part in (SOURCE_QUERIES, REPORT_QUERIES, BASIC_QUERIES, TEXT_QUERIES, FEATURE_QUERIES, MODEL_QUERIES, EXACT_QUERIES, LEARNING_QUERIES):
        out.update(part)
    return out
