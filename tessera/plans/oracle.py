"""Independent SQL (DuckDB dialect) for the driver's correctness gate.

The panel and staffing tables are rebuilt here with plain GROUP BY / UNION
ALL / joins -- a different formulation from the Spark side -- and each
operator is written in its textbook SQL form (joins to a grid, correlated
arg_min/arg_max, lag over distinct seasons, ...).
"""

from __future__ import annotations

STATS = ["FTA", "PTS", "AST", "TRB", "BLK", "STL", "TOV"]

def season_year_sql(label: str) -> str:
    """SQL twin of ``parse_season_label`` (lenient form)."""
    first = f"split_part(replace(trim({label}), '-', '_'), '_', 1)"
    num = f"TRY_CAST({first} AS INTEGER)"
    return (f"CASE WHEN length({first}) = 4 THEN {num} "
            f"WHEN {num} >= 50 THEN {num} + 1900 ELSE {num} + 2000 END")


_PER_ORDER = """
per_order AS (
  SELECT l_orderkey,
         CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS v_FTA,
         sum(l_quantity) AS v_PTS,
         CAST(count(*) AS DOUBLE) AS v_AST,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS v_TRB,
         CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) AS v_BLK,
         CAST(count(*) FILTER (WHERE l_discount >= 0.05) AS DOUBLE) AS v_STL,
         CAST(max(l_linenumber) AS DOUBLE) AS v_TOV
  FROM lineitem GROUP BY l_orderkey)"""


def _sums(prefix_in: str, fn: str) -> str:
    parts = []
    for s in STATS:
        if fn == "raw":
            parts.append(f"sum(v_{s}) AS s_{s}, count(v_{s}) AS c_{s}")
        else:
            parts.append(f"sum(s_{s}) AS s_{s}, sum(c_{s}) AS c_{s}")
    return ",\n         ".join(parts)


def _carry() -> str:
    return ", ".join(f"s_{s}, c_{s}" for s in STATS)


def _rates() -> str:
    return ",\n       ".join(f"s.s_{s} / nullif(s.c_{s}, 0) AS {s}" for s in STATS)


PANEL_CTES = f"""
{_PER_ORDER.strip()},
facts AS (
  SELECT o.o_orderkey, o.o_custkey AS id, CAST(year(o.o_orderdate) AS INTEGER) AS season_start,
         o.o_orderpriority AS team, p.*
  FROM orders o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey),
team_rows AS (
  SELECT id, season_start, team, count(*) AS n, min(o_orderkey) AS k,
         {_sums('', 'raw')}
  FROM facts GROUP BY id, season_start, team),
season_rows AS (
  SELECT id, season_start, count(*) AS n_teams, sum(n) AS n, min(k) AS k,
         {_sums('', 'agg')}
  FROM team_rows GROUP BY id, season_start HAVING count(*) > 1),
stacked AS (
  SELECT id, season_start, team AS Team, 2 * k + 1 AS ord, k, n, {_carry()} FROM team_rows
  UNION ALL
  SELECT id, season_start, CAST(n_teams AS VARCHAR) || 'TM' AS Team, 2 * k AS ord, k, n, {_carry()} FROM season_rows),
panel AS (
  SELECT s.id, s.season_start, s.Team, s.ord,
       CASE WHEN s.k % 5 <> 2 THEN c.c_name END AS Player,
       CASE WHEN s.k % 3 <> 0 THEN c.c_mktsegment END AS Pos,
       CASE WHEN s.k % 4 <> 1 THEN CAST(20 + s.id % 15 + s.season_start - 1995 AS DOUBLE) END AS Age,
       CAST(s.n AS DOUBLE) AS G,
       {_rates()}
  FROM stacked s LEFT JOIN customer c ON c.c_custkey = s.id)"""

STAFF_CTES = f"""
staff_raw AS (
  SELECT s.s_name AS Coach, o.o_orderpriority AS Tm, CAST(count(*) AS INTEGER) AS G,
         lpad(CAST(year(o.o_orderdate) % 100 AS VARCHAR), 2, '0') || '_' ||
           lpad(CAST((year(o.o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS Season,
         min(l.l_orderkey) AS k, l.l_linestatus AS ls
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  GROUP BY s.s_name, o.o_orderpriority, year(o.o_orderdate), l.l_linestatus),
staff AS (
  SELECT Coach, Tm, G, Season, k, ls FROM (
    SELECT *, row_number() OVER (PARTITION BY Tm, Season, Coach ORDER BY k, Coach, ls) AS rn FROM staff_raw)
  WHERE rn = 1),
staff_first AS (
  SELECT Tm, Season, Coach FROM (
    SELECT *, row_number() OVER (PARTITION BY Tm, Season ORDER BY k, Coach, ls) AS rn FROM staff)
  WHERE rn = 1),
staff_max AS (
  SELECT Tm, Season, Coach, G AS Games FROM (
    SELECT *, row_number() OVER (PARTITION BY Tm, Season ORDER BY G DESC, k, Coach, ls) AS rn FROM staff)
  WHERE rn = 1),
cur_dim AS (
  SELECT Tm, {season_year_sql("Season")} AS season_year, Coach FROM staff_first),
prev_dim AS (
  SELECT Tm, {season_year_sql("Season")} AS season_year, Coach FROM staff_max)"""


def with_ctes(*blocks: str, body: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in blocks) + "\n" + body.strip()


# ------------------------------------------------------------------ operator SQL
# Each generator returns CTE text "dst AS (...)" (possibly several CTEs)
# reading the relation ``src``.

def is_agg_sql(team: str = "Team") -> str:
    return f"coalesce(ends_with(upper({team}), 'TM') OR upper({team}) = 'TOT', false)"


def gap_fill_sql(src: str, dst: str) -> str:
    return f"""
{dst}_ranges AS (
  SELECT id, min(season_start) AS lo, max(season_start) AS hi FROM {src} WHERE id IS NOT NULL GROUP BY id),
{dst}_grid AS (
  SELECT id, CAST(unnest(range(CAST(lo AS BIGINT), CAST(hi AS BIGINT) + 1)) AS INTEGER) AS season_start
  FROM {dst}_ranges),
{dst} AS (
  SELECT g.id, g.season_start, p.* EXCLUDE (id, season_start, G), coalesce(p.G, 0.0) AS G,
         coalesce(p.G, 0.0) > 0 AS did_play
  FROM {dst}_grid g LEFT JOIN {src} p ON p.id = g.id AND p.season_start = g.season_start)"""


def static_sql(src: str, dst: str, cols=("Player", "Pos")) -> str:
    picks = ", ".join(f"arg_max({c}, struct_pack(s := season_start, o := ord)) FILTER (WHERE {c} IS NOT NULL) AS s_{c}"
                      for c in cols)
    sets = ", ".join(f"s.s_{c} AS {c}" for c in cols)
    return f"""
{dst}_s AS (SELECT id, {picks} FROM {src} GROUP BY id),
{dst} AS (SELECT f.* EXCLUDE ({", ".join(cols)}), {sets} FROM {src} f LEFT JOIN {dst}_s s ON s.id = f.id)"""


def anchor_sql(src: str, dst: str, col: str = "Age") -> str:
    key = "struct_pack(s := season_start, o := ord)"
    return f"""
{dst}_a AS (
  SELECT id, arg_min(season_start, {key}) FILTER (WHERE {col} IS NOT NULL) AS a_season,
         arg_min({col}, {key}) FILTER (WHERE {col} IS NOT NULL) AS a_val
  FROM {src} GROUP BY id),
{dst} AS (SELECT f.* EXCLUDE ({col}), a.a_val + (f.season_start - a.a_season) AS {col}
          FROM {src} f LEFT JOIN {dst}_a a ON a.id = f.id)"""


def clock_sql(src: str, dst: str) -> str:
    return f"""
{dst} AS (SELECT f.*, CAST(row_number() OVER (PARTITION BY id ORDER BY season_start, ord) - 1 AS INTEGER)
                 AS years_in_nba FROM {src} f)"""


def career_sql(src: str, dst: str, stats, wrap=lambda e: e) -> str:
    totals = ", ".join(f"{c} * G AS total_{c}" for c in stats)
    rates = ", ".join(
        f"CASE WHEN id IS NOT NULL AND {c} * G IS NOT NULL THEN "
        + wrap(f"coalesce(sum({c} * G) OVER w, 0) / nullif(sum(G) OVER w, 0)")
        + f" END AS career_{c}_pg" for c in stats)
    return f"""
{dst} AS (SELECT f.*, {totals}, {rates} FROM {src} f
          WINDOW w AS (PARTITION BY id ORDER BY season_start, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


SCORE_EXPR = "PTS * 1.0 + AST * 1.5 + TRB * 1.2 + BLK * 2.0 + STL * 2.0 + TOV * -1.0"


def score_sql(src: str, dst: str) -> str:
    return f"{dst} AS (SELECT f.*, {SCORE_EXPR} AS fantasy_points_per_game FROM {src} f)"


def _rep(c: str, alias: str) -> str:
    return (f"arg_min({c}, struct_pack(a := CASE WHEN {is_agg_sql()} THEN 0 ELSE 1 END, o := ord)) "
            f"FILTER (WHERE {c} IS NOT NULL) AS {alias}")


def lag_sql(src: str, dst: str, cols) -> str:
    reps = ", ".join(_rep(c, f"r_{c}") for c in cols)
    lags = ", ".join(f"lag(r_{c}) OVER (PARTITION BY id ORDER BY season_start) AS lag1_{c}" for c in cols)
    return f"""
{dst}_r AS (SELECT id, season_start, {reps} FROM {src} GROUP BY id, season_start),
{dst}_l AS (SELECT id, season_start, {lags} FROM {dst}_r),
{dst} AS (SELECT f.*, {", ".join(f"l.lag1_{c}" for c in cols)}
          FROM {src} f LEFT JOIN {dst}_l l ON l.id = f.id AND l.season_start = f.season_start)"""


def team_flag_sql(src: str, dst: str) -> str:
    return f"""
{dst}_st AS (SELECT id, season_start, {_rep("Team", "st")}, count(Team) AS n_team
             FROM {src} GROUP BY id, season_start),
{dst}_p AS (
  SELECT id, season_start, n_team,
         last_value(st IGNORE NULLS) OVER (PARTITION BY id ORDER BY season_start
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_team
  FROM {dst}_st),
{dst} AS (
  SELECT t.*,
         CASE WHEN p.prev_team IS NULL THEN NULL
              WHEN {is_agg_sql("t.Team")} THEN false
              WHEN p.n_team = 1 AND t.Team IS NOT NULL THEN t.Team <> p.prev_team END AS new_team
  FROM {src} t LEFT JOIN {dst}_p p ON p.id = t.id AND p.season_start = t.season_start)"""


def coach_flag_sql(src: str, dst: str) -> str:
    """Needs cur_dim and prev_dim (STAFF_CTES) in scope."""
    return f"""
{dst}_t0 AS (SELECT s.*, (s.Team IS NOT NULL AND {is_agg_sql("s.Team")}) AS c_agg FROM {src} s),
{dst}_fo AS (SELECT id, season_start, Team, min(ord) AS fo FROM {dst}_t0
             WHERE NOT c_agg AND Team IS NOT NULL GROUP BY id, season_start, Team),
{dst}_ls AS (SELECT id, season_start, list(Team ORDER BY fo) AS tl FROM {dst}_fo GROUP BY id, season_start),
{dst}_pl AS (SELECT id, season_start, tl, lag(tl) OVER (PARTITION BY id ORDER BY season_start) AS ptl
             FROM {dst}_ls),
{dst}_t1 AS (
  SELECT t.*, p.tl, p.ptl, CASE WHEN t.c_agg AND p.tl IS NOT NULL THEN p.tl[1] ELSE t.Team END AS comp
  FROM {dst}_t0 t LEFT JOIN {dst}_pl p ON p.id = t.id AND p.season_start = t.season_start),
{dst}_h AS (SELECT DISTINCT id, comp, season_start FROM {dst}_t1 WHERE id IS NOT NULL AND comp IS NOT NULL),
{dst}_hp AS (SELECT id, comp, season_start,
                    lag(season_start) OVER (PARTITION BY id, comp ORDER BY season_start) AS ps FROM {dst}_h),
{dst}_t2 AS (
  SELECT t.*, h.ps FROM {dst}_t1 t
  LEFT JOIN {dst}_hp h ON h.id = t.id AND h.comp = t.comp AND h.season_start = t.season_start),
{dst}_t3 AS (
  SELECT t.*, c.Coach AS cur_coach,
         CASE WHEN p.Tm IS NOT NULL THEN p.Coach
              WHEN t.comp IS NOT NULL AND coalesce(list_contains(t.ptl, t.comp), false) AND f.Tm IS NOT NULL
              THEN f.Coach END AS prev_coach
  FROM {dst}_t2 t
  LEFT JOIN cur_dim c ON c.Tm = t.comp AND c.season_year = t.season_start
  LEFT JOIN prev_dim p ON p.Tm = t.comp AND p.season_year = t.ps
  LEFT JOIN prev_dim f ON f.Tm = t.comp AND f.season_year = t.season_start - 1),
{dst} AS (
  SELECT * EXCLUDE (c_agg, tl, ptl, comp, ps, cur_coach, prev_coach),
         CASE WHEN cur_coach IS NOT NULL AND prev_coach IS NOT NULL THEN cur_coach <> prev_coach END AS new_coach
  FROM {dst}_t3)"""


def drop_components_sql(src: str, dst: str) -> str:
    return f"""
{dst}_n AS (SELECT id, season_start, count(DISTINCT Team) AS nd FROM {src} GROUP BY id, season_start),
{dst} AS (SELECT s.* FROM {src} s LEFT JOIN {dst}_n n ON n.id = s.id AND n.season_start = s.season_start
          WHERE NOT (s.id IS NOT NULL AND coalesce(n.nd, 0) > 1 AND NOT {is_agg_sql("s.Team")}))"""


def round_even_sql(expr: str, d: int = 1) -> str:
    s = 10 ** d
    return f"round_even(({expr}) * {s}.0, 0) / {s}.0"


def boosting_sql(src: str, keys: list[str], feats: list[str], label: str, cuts: int, trees: int, depth: int, rate: float, l2: float,
                 l1: float = 0.0) -> list[str]:
    """CTEs up to ``boosted`` (keys, prediction): second-order boosting of ``src`` over equal-width bins, all rows and columns in each tree."""
    shrink = lambda g: f"(CASE WHEN {g} > {l1} THEN {g} - {l1} WHEN {g} < -{l1} THEN {g} + {l1} ELSE 0 END)" if l1 else f"({g})"
    score = lambda g, h: f"({shrink(g)} * {shrink(g)} / ({h} + {l2}))"
    bins = ", ".join(f"CASE WHEN {c} IS NULL THEN 0 WHEN lo_{c} = hi_{c} THEN 1 ELSE 1 + len(list_filter(range(1, {cuts}), "
                     f"lambda j: lo_{c} + (hi_{c} - lo_{c}) * j / {cuts}.0 < {c})) END" for c in feats)
    ends = ", ".join(f"min({c})::DOUBLE AS lo_{c}, max({c})::DOUBLE AS hi_{c}" for c in feats)
    out = [f"ends AS MATERIALIZED (SELECT {ends} FROM {src})",
           f"t0 AS MATERIALIZED (SELECT {', '.join(keys)}, {label}::DOUBLE AS y, [{bins}] AS bins, avg({label}) OVER () AS margin FROM {src}, ends "
           f"WHERE {label} IS NOT NULL)"]
    for t in range(trees):
        out.append(f"n{t}_0 AS MATERIALIZED (SELECT *, 0 AS node, true AS open, CAST(round((margin - y) * 1073741824) AS BIGINT) AS gi FROM t{t})")
        for d in range(depth):
            n = f"{t}_{d}"
            out += [f"""
h{n} AS MATERIALIZED (SELECT node, feature, bin, sum(gi) / 1073741824.0 AS g, count(*)::DOUBLE AS h FROM (
  SELECT node, gi, unnest(range({len(feats)})) AS feature, unnest(bins) AS bin FROM n{n} WHERE open) GROUP BY ALL)""", f"""
s{n} AS MATERIALIZED (SELECT node, feature, bin, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER p AS ga, sum(h) OVER p AS ha FROM h{n}
  WINDOW p AS (PARTITION BY node, feature), w AS (PARTITION BY node, feature ORDER BY bin ROWS UNBOUNDED PRECEDING))""", f"""
b{n} AS MATERIALIZED (SELECT node, feature, bin FROM (SELECT *, 0.5 * ({score("gl", "hl")} + {score("(ga - gl)", "(ha - hl)")} - {score("ga", "ha")}) AS gain
  FROM s{n} WHERE hl >= 1 AND ha - hl >= 1) WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, bin) = 1)""", f"""
n{t}_{d + 1} AS MATERIALIZED (SELECT n.* REPLACE (CASE WHEN b.node IS NULL THEN n.node WHEN bins[b.feature + 1] > b.bin THEN 2 * n.node + 2
  ELSE 2 * n.node + 1 END AS node, n.open AND b.node IS NOT NULL AS open) FROM n{n} n LEFT JOIN b{n} b ON n.node = b.node AND n.open)"""]
        g = "(sum(gi) OVER leaf / 1073741824.0)"
        out.append(f"""
t{t + 1} AS MATERIALIZED (SELECT {', '.join(keys)}, y, bins, margin - {rate} * {shrink(g)} / (count(*) OVER leaf + {l2}) AS margin
  FROM n{t}_{depth} WINDOW leaf AS (PARTITION BY node))""")
    return out + [f"boosted AS (SELECT {', '.join(keys)}, margin AS prediction FROM t{trees})"]
