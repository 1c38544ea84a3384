"""Render COVERAGE.md: SURVEY §2 inventory id -> queries (with oracle kind from the live registry) -> code."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabml.plans import catalog  # noqa: E402

# (id, operator, queries, implementation)
ROWS = [
    ("A01", "CSV scan, header, inferred types", ["scan_csv_inferred"], "sources.read_csv_inferred"),
    ("A02", "CSV scan, fixed schema (positional, bad cell -> NULL)", ["scan_csv_schema"], "sources.read_csv_schema"),
    ("A03", "preview n rows", ["preview_n"], "relational.ordered_limit"),
    ("A04", "schema report", ["schema_report"], "relational.schema_rows"),
    ("A05", "scalar stats kept as a one-row frame", ["global_stats"], "relational.global_stats"),
    ("A06", "collect top-k keys (re-aimed)", ["topk_semi_filter", "topk_semi_filter_nulls"], "relational.top_k_semi_filter"),
    ("A07", "frame to pandas (re-aimed)", ["eval_mape"], "evaluate.regression_metrics"),
    ("A08", "cache a reused frame", ["cached_reuse", "job_cars_all"], "jobs.run_job (persist / checkpoint)"),
    ("A09", "session injected, never stopped", ["(entry)"], "__spark_entry__.entry, session.local_session"),
    ("B01", "project columns", ["project_columns"], "DataFrame.select"),
    ("B02", "drop columns, absent ignored", ["drop_columns"], "relational.drop_columns"),
    ("B03", "add / replace columns", ["derive_columns"], "DataFrame.withColumns"),
    ("B04", "alias results", ["(all)"], "Column.alias"),
    ("B05", "drop rows with any NULL", ["drop_nulls"], "relational.drop_nulls"),
    ("B06", "not-null predicate chain", ["filter_not_null"], "relational.not_null"),
    ("B07", "range predicates", ["filter_range"], "relational.between"),
    ("B08", "isin literal list", ["filter_isin"], "Column.isin"),
    ("B09", "isin computed list", ["topk_semi_filter", "topk_semi_filter_nulls"], "relational.top_k_semi_filter"),
    ("B10", "SQL-string predicate", ["filter_sql_string"], "DataFrame.filter(str)"),
    ("B11", "column-to-column equality", ["filter_col_equal"], "DataFrame.filter"),
    ("B12", "regex predicate", ["filter_rlike"], "Column.rlike"),
    ("B13", "outlier trimming", ["trim_outliers"], "DataFrame.filter"),
    ("D01", "row count", ["row_count"], "relational.row_count"),
    ("D02", "group count", ["group_count"], "relational.group_count"),
    ("D03", "two-key contingency", ["crosstab_count"], "relational.group_count"),
    ("D04", "global mean / stddev / min / max", ["global_stats"], "relational.global_stats"),
    ("D05", "group means", ["group_means"], "relational.group_means"),
    ("D06", "group by computed band", ["banded_error_report"], "evaluate.banded_errors, functions.band"),
    ("D07", "describe (typed long form)", ["describe_numeric", "describe_string", "describe_mixed"], "relational.describe_numeric"),
    ("D08", "mean of an expression", ["banded_error_report"], "evaluate.banded_errors"),
    ("D09", "sum over mapped rows (re-aimed)", ["eval_wssse"], "evaluate.wssse"),
    ("F01", "sort by one key", ["sort_single"], "DataFrame.orderBy"),
    ("F02", "sort by two keys", ["sort_multi"], "DataFrame.orderBy"),
    ("F03", "sort descending, tie by key", ["topk_groups", "topk_groups_sketch"], "relational.top_k_groups"),
    ("F04", "limit rows (ordered)", ["limit_rows", "limit_rows_100k", "limit_rows_ties"], "relational.ordered_limit"),
    ("F05", "top-k groups as a filter", ["topk_semi_filter", "topk_semi_filter_nulls", "topk_groups_flat"], "relational.top_k_semi_filter"),
    ("F06", "top-n report", ["topn_report"], "relational.top_k_groups"),
    ("F07", "random row sample (repeatable)", ["random_sample_n"], "relational.hash_sample"),
    ("F08", "train/test split", ["split_hash_counts", "split_small_holdout", "split_random", "split_cover"], "split.hash_split, split.random_split"),
    ("H01-H05", "duration text -> seconds", ["parse_duration", "duration_parse_report"], "functions.parse_duration"),
    ("H06-H08", "hour / dayofweek / month", ["time_features"], "functions.time_parts"),
    ("H09-H10", "safe numeric cast", ["safe_numeric_cast"], "functions.safe_double"),
    ("H11", "multi-branch banding", ["age_band", "band_fractional"], "functions.band"),
    ("H12", "arithmetic, ratio", ["ratio_feature"], "functions.ratio"),
    ("H13", "abs", ["abs_error_rows"], "F.abs"),
    ("H14", "rand (re-aimed)", ["random_sample_n"], "relational.hash_sample"),
    ("H15", "vector element access", ["eval_wssse", "assemble_numeric"], "features.vector_columns"),
    ("H16", "col / desc / count / literals", ["(all)"], "pyspark.sql.functions"),
    ("G01", "assemble numeric columns", ["assemble_numeric"], "features.assembler"),
    ("G02", "assemble numeric + encoded", ["assemble_mixed"], "features.feature_stages"),
    ("G03", "index by frequency, error on unseen", ["string_index", "string_index_wide"], "features.string_indexer"),
    ("G04", "index, skip unseen / NULL", ["string_index_skip", "string_index_wide_skip"], "features.string_indexer(handle_invalid='skip')"),
    ("G05", "index a list of columns", ["string_index_multi"], "features.string_indexer (multi-column)"),
    ("G06", "fit on train, apply to both", ["index_fit_train_apply_test"], "features.string_indexer"),
    ("G07", "one-hot, last level dropped", ["one_hot"], "features.one_hot_encoder"),
    ("G08", "scale to unit stddev", ["scale_std"], "features.scaler"),
    ("G09", "centre and scale", ["scale_zscore"], "features.scaler(with_mean=True)"),
    ("G10-G11", "pipeline of stages", ["pipeline_features"], "features.FeatureSpec / feature_stages"),
    ("G12", "transformer outside a pipeline", ["assemble_numeric", "string_index"], "Transformer.transform"),
    ("G13", "target never a feature", ["(tests)"], "FeatureSpec.check_target"),
    ("J01", "binary logistic regression", ["logit_binary_rates", "logit_binary_score_eq", "job_medical_clf", "job_medical_clf_checked", "job_bike_clf_checked"],
     "models.logistic_regression"),
    ("J02", "multinomial logistic regression", ["logit_multi_rates", "logit_multi_score_eq", "job_iris_clf", "job_iris_clf_checked", "job_youtube_clf_checked"],
     "models.logistic_regression(family='multinomial')"),
    ("J03", "linear regression, defaults", ["ols_multi_coefficients", "job_avocado_reg", "job_medical_reg"],
     "models.linear_regression"),
    ("J04", "linear regression, maxIter 10, custom prediction column",
     ["ols_single_coefficients", "job_youtube_reg", "job_bike_reg"], "models.linear_regression"),
    ("J05", "random-forest regressor", ["rf_stump_regress", "rf_tree_mean", "rf_regress_10", "job_cars_reg", "rf_node_walk", "rf_node_table", "rf_leaf_rows", "job_cars_reg_checked"],
     "models.random_forest_regressor"),
    ("J06", "random-forest classifier", ["rf_class_priors", "rf_classify_10", "job_cars_clf", "rf_node_walk", "job_cars_clf_checked"],
     "models.random_forest_classifier"),
    ("J07", "k-means", ["kmeans_planted_profile", "kmeans_free_k", "job_iris_clu", "job_iris_clu_checked", "job_bike_clu_checked", "job_avocado_clu_checked"], "models.kmeans"),
    ("J08", "batch scoring", ["ols_score_rows"], "Model.transform"),
    ("J09", "fit on train, score held-out", ["ols_holdout_metrics"], "jobs.run_job"),
    ("J10-J11", "fit and score full table / prepared frame", ["kmeans_planted_profile"], "models.fit_on"),
    ("J12", "class probabilities", ["logit_binary_rates", "logit_multi_rates"], "vector_to_array(probability)"),
    ("J13", "custom output column names", ["ols_single_coefficients", "job_youtube_clu"], "predictionCol"),
    ("I01", "cluster centres table", ["kmeans_centers"], "inspect.cluster_centers"),
    ("I02", "coefficients with names", ["ols_multi_coefficients", "job_bike2_reg"], "inspect.coefficients"),
    ("I03", "training R², RMSE", ["ols_train_summary"], "inspect.regression_summary"),
    ("I04", "training accuracy", ["logit_train_accuracy"], "inspect.classification_summary"),
    ("I05", "held-out summary", ["ols_holdout_metrics"], "evaluate.regression_metrics"),
    ("I06", "last pipeline stage", ["(all model queries)"], "inspect.last_stage"),
    ("K01-K02", "accuracy", ["eval_accuracy"], "evaluate.classification_metrics"),
    ("K03", "weighted F1", ["eval_f1_weighted", "eval_builtin_evaluators"], "evaluate.metrics_from_confusion"),
    ("K04", "TP/TN/FP/FN, positive-class metrics", ["eval_confusion_binary"], "evaluate.binary_metrics"),
    ("K05", "RMSE, R², MAE, MSE", ["eval_regression"], "evaluate.regression_metrics"),
    ("K06", "MAPE, zero labels counted", ["eval_mape"], "evaluate.regression_metrics"),
    ("K07", "area under ROC (exact)", ["eval_auc", "eval_auc_plan"], "evaluate.area_under_roc"),
    ("K08", "silhouette", ["eval_silhouette"], "evaluate.silhouette"),
    ("K09", "WSSSE", ["eval_wssse"], "evaluate.wssse / cluster_profile"),
    ("K10", "RMSE / stddev ratio", ["eval_rmse_ratio"], "one aggregate"),
    ("K11", "prediction-vs-actual contingency", ["prediction_crosstab", "crosstab_count"], "evaluate.confusion"),
    ("K12", "row-level error listing", ["abs_error_rows"], "F.abs"),
    ("K13", "error by segment", ["banded_error_report", "job_bike2_reg"], "evaluate.banded_errors"),
    ("K14", "cluster report", ["kmeans_planted_profile", "job_iris_clu"], "evaluate.cluster_profile"),
    ("K15", "metric report to a sink", ["metrics_report"], "evaluate.to_long, sources.write_metrics"),
    ("K16", "class balance", ["class_balance"], "DataFrame.groupBy"),
    ("K17", "choose metrics, one pass", ["eval_metric_list", "eval_builtin_evaluators"], "evaluate.*"),
    ("2.14", "20 composite analyses", ["job_<task> x 20", "job_<name>_all x 7", "job_<task>_exact x 15", "job_<name>_all_fixed x 4"],
     "plans.jobs / job_queries / exact_job_queries"),
]


def main() -> None:
    catalog.load_all()
    out = ["# COVERAGE — SURVEY §2 inventory -> queries -> code", "",
           "Oracle kinds: E exact SQL, C closed form, S score equations, P planted, R rows only (pytest properties).",
           "Generated by `python tools/coverage.py` from the live query registry.", "",
           "| id | operator | queries (oracle kind) | implementation |", "|---|---|---|---|"]
    for ident, op, qs, impl in ROWS:
        cells = []
        for q in qs:
            if q in catalog.KIND:
                cells.append(f"`{q}` ({catalog.KIND[q]})")
            elif q.startswith("("):
                cells.append(q)
            else:
                cells.append(f"`{q}`")
        out.append(f"| {ident} | {op} | {', '.join(cells)} | `{impl}` |")
    missing = [q for _, _, qs, _ in ROWS for q in qs if not q.startswith(("(", "job_<")) and q not in catalog.KIND]
    if missing:
        raise SystemExit(f"unknown queries: {missing}")
    kinds = {}
    for k in catalog.KIND.values():
        kinds[k] = kinds.get(k, 0) + 1
    out += ["", f"Registered queries: {len(catalog.QUERIES)}; by oracle kind: "
            + ", ".join(f"{k} {v}" for k, v in sorted(kinds.items())) + "."]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "COVERAGE.md"), "w") as f:
        f.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
