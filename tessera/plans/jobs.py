"""File-to-file jobs: the reference's entry points as plain functions.

* ``export_staffing_tables``: staffing CSV folders -> summary, first-only
  and most-games tables (sorted by group, period).
* ``run_feature_pipeline``: season CSV folders + staffing lookups ->
  imputed, features, filtered and modelling tables.
* ``eye_test_export``: a table filtered to a list of ids, written next to
  its source as ``<stem>_eye_test``.
* ``run_training``: modelling table -> model, metrics, predictions.

Every output is a directory of part files written by Spark; ``single_file``
funnels a small export through one task when a single file is wanted.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.operators import filters as flt
from tessera.operators import staffing as stf
from tessera.plans.pipeline import PipelineOutputs, feature_pipeline
from tessera.sources import io as tio

# The reference's default column names.
REFERENCE_ID = "Player-additional"
PLAYER_SCHEMA_DOUBLE = ["Age", "G", "GS", "MP", "FG", "FGA", "FG%", "3P", "3PA", "3P%", "2P", "2PA", "2P%", "eFG%",
                        "FT", "FTA", "FT%", "ORB", "DRB", "TRB", "AST", "STL", "BLK", "TOV", "PF", "PTS"]
PLAYER_SCHEMA_STRING = ["Player", "Team", "Pos", "Awards", REFERENCE_ID]


def player_schema() -> T.StructType:
    """Types for the season files: numbers as DOUBLE (a gap fill makes them nullable)."""
    fields = [T.StructField("Rk", T.IntegerType())]
    fields += [T.StructField(c, T.StringType()) for c in PLAYER_SCHEMA_STRING]
    fields += [T.StructField(c, T.DoubleType()) for c in PLAYER_SCHEMA_DOUBLE]
    return T.StructType(fields)


def export_staffing_tables(spark: SparkSession, data_root: str, out_dir: str,
                           filename: str = "coaches.csv", single_file: bool = False) -> dict[str, DataFrame]:
    """Write ``coaches_by_team_summary``, ``..._first_only`` and ``..._max_games``."""
    staff = stf.distinct_by_first(tio.read_staffing(spark, data_root, filename))
    tables = {
        "coaches_by_team_summary": stf.staff_summary(staff),
        "coaches_by_team_first_only": stf.first_by_group(staff),
        "coaches_by_team_max_games": stf.max_by_group(staff, games_col="G").withColumnRenamed("G", "Games"),
    }
    out = {}
    for name, df in tables.items():
        df = df.orderBy("Tm", "Season")
        tio.write_table(df, f"{out_dir.rstrip('/')}/{name}", single_file=single_file)
        out[name] = df
    return out


def _output_paths(output_path: str) -> dict[str, str]:
    base_dir, base = os.path.split(output_path)
    name, _ext = os.path.splitext(base)
    processed = os.path.join(os.path.dirname(base_dir.rstrip("/")) if base_dir else "..", "processed", "data")
    return {"imputed": os.path.join(base_dir, f"{name}_imputed"),
            "features": os.path.join(base_dir, f"{name}_feature_engineer"),
            "filtered": os.path.join(base_dir, f"{name}_filtered"),
            "modelling": processed}


def run_feature_pipeline(spark: SparkSession, data_root: str, output_path: str,
                         staffing_root: str | None = None, min_games: float = 30,
                         id_col: str = REFERENCE_ID, skew_safe: bool = True) -> PipelineOutputs:
    """Season folders -> the four tables of the reference's pipeline.

    The imputed and feature tables are written as Parquet checkpoints (they
    also cut the lineage); the filtered and modelling tables as CSV.
    """
    paths = _output_paths(output_path)
    seasons = tio.read_seasons(spark, data_root, schema=player_schema())
    staff = tio.read_staffing(spark, staffing_root or data_root)
    cur, prev = stf.staffing_dimensions(staff)
    out = feature_pipeline(seasons, cur, prev, skew_safe=skew_safe, id_col=id_col, min_games=min_games,
                           imputed_path=paths["imputed"], features_path=paths["features"])
    tio.write_table(out.filtered, paths["filtered"])
    tio.write_table(out.modelling, paths["modelling"])
    return out


def eye_test_export(spark: SparkSession, csv_path: str, ids=None, col: str = REFERENCE_ID,
                    schema: T.StructType | None = None) -> str:
    """Keep the rows of ``ids`` (default: the fixed eye-test list), write ``<stem>_eye_test``."""
    df = tio.read_model_table(spark, csv_path, schema=schema)
    kept = flt.filter_in_list(df, flt.EYE_TEST_IDS if ids is None else ids, col)
    stem, _ext = os.path.splitext(csv_path.rstrip("/"))
    out = f"{stem}_eye_test"
    tio.write_table(kept, out)
    return out


def run_training(spark: SparkSession, data_path: str, out_dir: str,
                 target_col: str = "fantasy_points_per_game", id_cols=(REFERENCE_ID, "season_start"),
                 k: int = 5, seed: int = 42, gbt_params: dict | None = None,
                 schema: T.StructType | None = None) -> dict:
    """Modelling table -> model, metrics JSON, predictions and ``pred_df`` (with y_true/y_pred)."""
    from tessera.plans.training import train_and_export
    table = tio.read_model_table(spark, data_path, schema=schema)
    d = out_dir.rstrip("/")
    return train_and_export(table, target_col, id_cols, k, seed, gbt_params,
                            model_path=f"{d}/model", metrics_path=f"{d}/metrics",
                            predictions_path=f"{d}/predictions", pred_df_path=f"{d}/pred_df")


def list_importances(spark: SparkSession, model_path: str, top: int = 25) -> DataFrame:
    """The ``top`` features of a saved pipeline and their importances, largest first.

    Opens the model only; no data are read.  A missing model raises.
    """
    from pyspark.ml import PipelineModel

    from tessera.operators.model import feature_importance
    if not tio.path_exists(spark, model_path):
        raise FileNotFoundError(f"no model at {model_path}")
    return feature_importance(PipelineModel.load(model_path), top)
