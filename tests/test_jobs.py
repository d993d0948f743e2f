"""End to end on hand-made season folders: CSV in -> four tables -> training."""

import os

from pyspark.sql import functions as F

from tessera.plans.jobs import eye_test_export, export_staffing_tables, run_feature_pipeline, run_training

HEADER = ("Rk,Player,Age,Team,Pos,G,GS,MP,FG,FGA,FG%,3P,3PA,3P%,2P,2PA,2P%,eFG%,FT,FTA,FT%,ORB,DRB,TRB,AST,STL,"
          "BLK,TOV,PF,PTS,Awards,Player-additional")


def player_row(rk, name, age, team, pos, g, pts, ast, trb, stl, blk, tov, fta, pid):
    nums = [g, g, 30.0, 8.0, 16.0, .5, 2.0, 5.0, .4, 6.0, 11.0, .55, .56, 4.0, fta, .8, 1.0, 5.0, trb, ast, stl,
            blk, tov, 2.0, pts]
    return ",".join([str(rk), name, "" if age is None else str(age), team, pos] + [str(x) for x in nums] + ["", pid])


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def make_tree(root):
    seasons = {
        "18_19": [player_row(1, "Kay", 30, "GSW", "PF", 78, 26.0, 5.9, 6.4, 0.7, 1.1, 2.9, 6.0, "kay01"),
                  player_row(2, "Jay", 22, "LAL", "SG", 40, 10.0, 2.0, 3.0, 1.0, 0.2, 1.0, 2.0, "jay01")],
        "19_20": [player_row(1, "Jay", None, "LAL", "SG", 60, 12.0, 2.5, 3.5, 1.1, 0.3, 1.2, 2.5, "jay01")],
        "20_21": [player_row(1, "Kay", None, "BRK", "PF", 35, 26.9, 5.6, 7.1, 0.7, 1.3, 3.5, 6.8, "kay01"),
                  player_row(2, "Jay", 24, "2TM", "SG", 70, 14.0, 3.0, 4.0, 1.2, 0.4, 1.5, 3.0, "jay01"),
                  player_row(3, "Jay", 24, "LAL", "SG", 30, 13.0, 3.0, 4.0, 1.2, 0.4, 1.5, 3.0, "jay01"),
                  player_row(4, "Jay", 24, "PHO", "SG", 40, 15.0, 3.0, 4.0, 1.2, 0.4, 1.5, 3.0, "jay01")],
        "21_22": [player_row(1, "Kay", 32, "BRK", "PF", 55, 29.9, 6.4, 7.4, 0.9, 0.9, 3.5, 7.4, "kay01"),
                  player_row(2, "Jay", 25, "PHO", "SG", 65, 16.0, 3.5, 4.5, 1.3, 0.5, 1.6, 3.2, "jay01")],
    }
    coaches = {
        "18_19": ["Kerr,GSW,82,1,1,1,1,1,1,1,1,.5", "Walton,LAL,82,1,1,1,1,1,1,1,1,.5"],
        "19_20": ["Vogel,LAL,71,1,1,1,1,1,1,1,1,.5"],
        "20_21": ["Nash,BRK,72,1,1,1,1,1,1,1,1,.5", "Vogel,LAL,72,1,1,1,1,1,1,1,1,.5",
                  "Williams,PHO,72,1,1,1,1,1,1,1,1,.5"],
        "21_22": ["Nash,BRK,82,1,1,1,1,1,1,1,1,.5", "Williams,PHO,82,1,1,1,1,1,1,1,1,.5"],
    }
    for label, rows in seasons.items():
        write(f"{root}/raw/{label}/players.csv", [HEADER] + rows)
        write(f"{root}/raw/{label}/coaches.csv", ["Coach,Tm,G,W,L,G,W,L,G,W,L,W%"] + coaches[label])


def test_feature_pipeline_from_files(spark, tmp_path):
    root = str(tmp_path)
    make_tree(root)
    tables = export_staffing_tables(spark, f"{root}/raw", f"{root}/interim")
    assert tables["coaches_by_team_first_only"].count() == 8
    out = run_feature_pipeline(spark, f"{root}/raw", f"{root}/out/panel.csv", min_games=30)
    model = spark.read.option("header", True).csv(f"{root}/processed/data")
    assert model.columns == [
        "Player-additional", "season_start", "age_prev_season", "position", "games_available_prev_season",
        "ftapg_prev_season", "ppg_prev_season", "apg_prev_season", "rpg_prev_season", "bpg_prev_season",
        "spg_prev_season", "topg_prev_season", "roll_career_ppg", "roll_career_apg", "roll_career_rpg",
        "roll_career_bpg", "roll_career_spg", "roll_career_topg", "fantasy_points_per_game",
        "years_in_nba_prev_season", "new_coach", "new_team"]
    rows = {(r["Player-additional"], int(r["season_start"])): r for r in model.collect()}
    # Kay: 2018 first season (clock 0) dropped; 2019, 2020 are gap/imputed (G 0 < 30) -> dropped
    assert ("kay01", 2018) not in rows and ("kay01", 2019) not in rows
    assert ("kay01", 2021) in rows and ("jay01", 2021) in rows
    # Jay 2020 keeps only the aggregate row of the split season
    jay20 = [r for r in out.filtered.collect() if r["Player-additional"] == "jay01" and r.season_start == 2020]
    assert [r.Team for r in jay20] == ["2TM"]
    # Kay changed team BRK after GSW (2020 BRK rows: previous team GSW)
    feats = {(r["Player-additional"], r.season_start, r.Team): r for r in out.features.collect()}
    assert feats[("kay01", 2020, "BRK")].new_team is True
    assert feats[("kay01", 2021, "BRK")].new_team is False
    assert feats[("kay01", 2021, "BRK")].new_coach is False  # Nash both seasons
    assert feats[("kay01", 2020, "BRK")].Age == 32.0  # anchored on 2018 age 30
    assert feats[("jay01", 2019, "LAL")].years_in_nba == 1
    assert os.path.isdir(f"{root}/out/panel_imputed") and os.path.isdir(f"{root}/out/panel_filtered")
    eye = eye_test_export(spark, f"{root}/processed/data", ids=["kay01"])
    assert {r["Player-additional"] for r in spark.read.option("header", True).csv(eye).collect()} == {"kay01"}


def test_training_job(spark, tmp_path):
    rows = [(f"p{i % 40}", 2000 + i // 40, float(i % 7), float(i % 5), "PG" if i % 3 else "C",
             bool(i % 2), 10.0 + (i % 7) * 2 + (i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "`Player-additional` string, season_start int, a double, b double, "
                                     "position string, new_team boolean, fantasy_points_per_game double")
    path = f"{tmp_path}/data"
    df.write.option("header", True).csv(path)
    out = run_training(spark, path, f"{tmp_path}/models", k=3, gbt_params=dict(maxIter=5, maxDepth=2),
                       schema=df.schema)
    m = out["metrics"]
    assert len(m["cv_fold_rmse"]) == 3 and m["train_rmse"] >= 0
    pred = spark.read.option("header", True).csv(f"{tmp_path}/models/pred_df")
    assert {"y_true", "y_pred", "prediction", "residual"} <= set(pred.columns)
    assert pred.count() == 200
    assert spark.read.json(f"{tmp_path}/models/metrics").first().cv_rmse_mean > 0
    assert F is not None
