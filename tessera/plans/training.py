"""Train, cross-validate, score and export: the reference's training run on Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import model as mdl
from tessera.operators.joins import validate_keys
from tessera.operators.shape import split_features_target
from tessera.sources.io import write_table

#: Folds fitted at a time: a fit is many small jobs, which leave cores idle between them.
FOLDS_AT_ONCE = 3


def train_and_export(table: DataFrame, target_col: str = "fantasy_points_per_game",
                     id_cols: Sequence[str] = ("id", "season_start"), k: int = 5, seed: int = 42,
                     gbt_params: dict | None = None, fold_method: str = "hash",
                     model_path: str | None = None, metrics_path: str | None = None,
                     predictions_path: str | None = None, pred_df_path: str | None = None) -> dict:
    """Check keys, split, cross-validate, refit on the labelled rows, score all rows, save.

    Boosting can't learn from a row without a target; such rows are still
    scored and exported, with a NULL residual, and metrics has their number.

    Returns {"metrics": {...}, "model": PipelineModel, "predictions": DataFrame,
    "pred_df": DataFrame}.  ``pred_df`` repeats target and prediction as
    ``y_true``/``y_pred``; since both come from the same scored rows they
    are added as columns rather than by a self-join on the keys.
    """
    id_cols = list(id_cols)
    validate_keys(table, id_cols)
    _kept, features, target = split_features_target(table, target_col, id_cols)
    data = table.persist()
    try:
        params = dict(gbt_params or {})
        factory = lambda d: mdl.gbt_pipeline(d, features, target, seed, **params)
        known = data.where(F.col(f"`{target}`").isNotNull())
        cv = mdl.cross_validate(known, factory, target, id_cols, k, seed, fold_method,
                                parallelism=FOLDS_AT_ONCE)
        model = factory(known).fit(known)
        scored = mdl.score_with_residual(model, data, target)
        m = mdl.regression_metrics(scored, target).first()
        unlabelled = data.count() - m["n_rows"]
    finally:
        data.unpersist()
    metrics = {**{f"cv_{k_}": v for k_, v in cv.items()},
               "train_rmse": m["rmse"], "train_mae": m["mae"], "train_r2": m["r2"], "rows_without_target": unlabelled}
    if model_path or metrics_path:
        mdl.save_model_and_metrics(model, metrics, model_path, metrics_path)
    write_table(scored, predictions_path)
    pred_df = scored.withColumns({"y_true": F.col(target), "y_pred": F.col("prediction")})
    write_table(pred_df, pred_df_path)
    return {"metrics": metrics, "model": model, "predictions": scored, "pred_df": pred_df}
