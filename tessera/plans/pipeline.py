"""The composed feature pipeline: panel -> imputed -> features -> model tables.

One lazy plan per sink.  The panel is expected hash-partitioned by the id
(``season_panel`` returns it so); every window below is partitioned by the
id (plus period or group), so the whole feature block runs after that one
exchange, with the small staffing lookups broadcast.  Optional
checkpoints write Parquet and read it back, which both exports the
intermediate tables and cuts the lineage (a lost executor then recomputes
from the checkpoint, not from the raw scans).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tessera.operators import features as fe
from tessera.operators import filters as flt
from tessera.operators import impute as imp
from tessera.operators import shape as shp
from tessera.sources.io import write_table

# The reference's feature lists, column lists and rename map.
STATIC_COLS = ["Player", "Pos"]
CAREER_STATS = ["PTS", "AST", "TRB", "BLK", "STL", "TOV"]
LAG_COLS = ["FTA", "PTS", "AST", "TRB", "BLK", "STL", "TOV", "G", "Age", "years_in_nba"]
RENAME_MAP = {
    "lag1_PTS": "ppg_prev_season",
    "lag1_AST": "apg_prev_season",
    "lag1_TRB": "rpg_prev_season",
    "lag1_BLK": "bpg_prev_season",
    "lag1_STL": "spg_prev_season",
    "lag1_TOV": "topg_prev_season",
    "lag1_FTA": "ftapg_prev_season",
    "lag1_G": "games_available_prev_season",
    "lag1_Age": "age_prev_season",
    "lag1_years_in_nba": "years_in_nba_prev_season",
    "career_PTS_pg": "roll_career_ppg",
    "career_AST_pg": "roll_career_apg",
    "career_TRB_pg": "roll_career_rpg",
    "career_BLK_pg": "roll_career_bpg",
    "career_STL_pg": "roll_career_spg",
    "career_TOV_pg": "roll_career_topg",
    "Pos": "position",
}
MODEL_FEATURES = [
    "lag1_Age", "Pos", "lag1_G", "lag1_FTA", "lag1_PTS", "lag1_AST", "lag1_TRB", "lag1_BLK",
    "lag1_STL", "lag1_TOV", "career_PTS_pg", "career_AST_pg", "career_TRB_pg", "career_BLK_pg",
    "career_STL_pg", "career_TOV_pg", "fantasy_points_per_game", "lag1_years_in_nba",
    "new_coach", "new_team",
]


def filtered_columns(id_col: str, period_col: str, team_col: str) -> list[str]:
    return [id_col, period_col, team_col, *MODEL_FEATURES]


def modelling_columns(id_col: str, period_col: str) -> list[str]:
    return [id_col, period_col, *MODEL_FEATURES]


@dataclass
class PipelineOutputs:
    imputed: DataFrame
    features: DataFrame
    filtered: DataFrame
    modelling: DataFrame


def _checkpoint(df: DataFrame, path: str | None) -> DataFrame:
    if not path:
        return df
    write_table(df, path, fmt="parquet")
    return df.sparkSession.read.parquet(path)


def feature_pipeline(panel: DataFrame, current_dim: DataFrame, previous_dim: DataFrame, *,
                     id_col: str = "id", period_col: str = "season_start", team_col: str = "Team",
                     ord_col: str = "ord", min_games: float = 30, decimals: int = 1,
                     imputed_path: str | None = None, features_path: str | None = None,
                     skew_safe: bool = True, scan: bool = False) -> PipelineOutputs:
    """Run the reference's feature pipeline on a panel.

    Order: gap fill -> static fill (Player, Pos) -> age anchor -> [imputed]
    -> experience clock -> career rates -> weighted score -> previous-period
    lags -> coach flag -> team flag -> [features] -> drop split-period
    components -> drop clock 0 -> games >= ``min_games`` -> select, round,
    rename (filtered view with the team column, modelling table without).

    ``skew_safe`` (the default) uses the period-grain forms (``operators.period_grain``):
    no window spans an id's rows, so an id holding a large share of all rows
    is spread over its periods.  The panel is ``checkpoint()``ed into the
    session's checkpoint dir once (both fused stages read their input more
    than once, and a lost executor resumes from there); imputation is one
    plan (``period_grain.impute_panel``) and the feature block another
    (``period_grain.history_features``) with a single (id, period) row exchange.

    ``scan`` also spreads the rows of one (id, period) and rows without id:
    running sums by prefix scan, components found by aggregates joined back.
    """
    if skew_safe:
        from tessera.operators import period_grain as imp_  # noqa: F811
        from tessera.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(panel.sparkSession)
        fe_ = imp_

        def cut(d: DataFrame) -> DataFrame:
            return d.checkpoint(eager=True)
    else:
        imp_, fe_ = imp, fe

        def cut(d: DataFrame) -> DataFrame:
            return d
    keys = dict(id_col=id_col, period_col=period_col, ord_col=ord_col)
    if skew_safe:
        imputed = imp_.impute_panel(cut(panel), STATIC_COLS, "Age", **keys)
    else:
        imputed = (panel
                   .transform(imp.fill_gap_periods, **keys)
                   .transform(imp.fill_static, STATIC_COLS, **keys)
                   .transform(imp.anchor_linear, "Age", **keys))
    imputed = _checkpoint(imputed, imputed_path)

    if skew_safe:
        # one (id, period) row exchange; every per-id quantity from summary windows
        base = imputed if imputed_path else cut(imputed)  # the written table already cuts the lineage
        feats = fe_.history_features(base, current_dim, previous_dim, CAREER_STATS, LAG_COLS,
                                     id_col=id_col, period_col=period_col, team_col=team_col, ord_col=ord_col, scan=scan)
    else:
        feats = (imputed
                 .transform(fe.experience_clock, **keys)
                 .transform(fe.career_rate_to_date, CAREER_STATS, **keys)
                 .transform(fe.weighted_score)
                 .transform(fe.previous_period_lag, LAG_COLS, team_col=team_col, **keys))
        feats = fe.changed_attribute_flag(feats, current_dim, previous_dim, team_col=team_col,
                                          period_col=period_col, id_col=id_col, ord_col=ord_col)
        feats = feats.transform(fe.changed_group_flag, id_col=id_col, team_col=team_col,
                                period_col=period_col, ord_col=ord_col)
    feats = _checkpoint(feats, features_path)

    kept = (feats
            .transform(flt.drop_components_split if scan else flt.drop_components, id_col=id_col, period_col=period_col,
                       team_col=team_col)
            .transform(flt.filter_not_equal_keep_null, "years_in_nba")
            .transform(flt.filter_min, min_games, "G"))

    def export(cols):
        return (kept.transform(shp.select_features, cols)
                .transform(shp.round_floats, decimals)
                .transform(shp.rename_strict, RENAME_MAP))

    return PipelineOutputs(imputed, feats, export(filtered_columns(id_col, period_col, team_col)),
                           export(modelling_columns(id_col, period_col)))
