"""

``queries()`` exposes the registered queries of ``matchlab.plans.catalog``
(one per inventory ID or group of IDs; the key starts with the IDs).
``oracle_sql()`` gives, for every query SQL can express, the same result
written as plain SQL over the driver tables (DuckDB dialect), built from
the shared CTEs below. Queries whose result depends on a fitted model
have no SQL (rows-only check); their operators are tested on fixed
inputs in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the leakage-free match feature table (form of both teams
    and head-to-head record before each match) at sf0.001."""
    from matchlab.plans.catalog import j02_j04_match_features
    return j02_j04_match_features(spark, SF_SMOKE)


def _corpus() -> tuple[dict, dict]:
    """Queries and SQL of the corpus operators and their pipeline, if that
    subpackage is there."""
    try:
        import corpus_pipeline
        from matchlab.llm import queries as corpus
    except ModuleNotFoundError as e:
        if (e.name or "").split(".")[0] not in ("corpus_pipeline", "matchlab"):
            raise
        return {}, {}
    sql = dict(corpus.SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return corpus.QUERIES | {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from matchlab.plans.catalog import QUERIES
    return dict(sorted((QUERIES | _corpus()[0]).items()))


# ---------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------

# Fixed values shared with the Spark side (see matchlab.schemas / rolling).
_STEMS = ["win_rate_last10", "draw_rate_last10", "avg_goals_scored_last20",
          "avg_goals_conceded_last20", "avg_goal_diff_last10", "goal_diff_trend",
          "ranking_proxy", "ranking_change"]
_FEATURES = [f"{side}_{s}" for s in _STEMS for side in ("home", "away")] + [
    "h2h_team_a_win_rate", "h2h_total"]
_FORM = ["win_rate_last10", "draw_rate_last10", "loss_rate_last10",
         "avg_goals_scored_last20", "avg_goals_conceded_last20", "avg_gd_last5",
         "avg_gd_prev5", "goal_diff_trend", "avg_goal_diff_last10", "form_last6m",
         "form_prev6m", "ranking_proxy", "ranking_change"]
_SIDE = _FORM + ["matches_available", "win_rate_prev10"]
_H2H = ["h2h_team_a_wins", "h2h_team_b_wins", "h2h_draws", "h2h_total", "h2h_team_a_win_rate"]
_BASE = ["match_id", "date", "home_team", "away_team", "home_score", "away_score",
         "goal_diff", "result", "tournament", "neutral"]


def _j(parts):
    return ",\n".join(parts)


def _zero(c):
    return "0" if c == "matches_available" else "0.0"


_PIVOT = """
sides AS (
  SELECT o.o_orderkey // 2 AS match_id, o.o_orderkey % 2 AS side, n.n_name AS team,
         CAST(floor(o.o_totalprice) AS BIGINT) % 5 AS score,
         CAST(o.o_orderdate AS DATE) AS date, o.o_orderpriority AS priority
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
paired AS (
  SELECT match_id,
         max(date) FILTER (WHERE side = 0) AS date,
         max(team) FILTER (WHERE side = 0) AS home_team,
         max(team) FILTER (WHERE side = 1) AS away_team,
         max(score) FILTER (WHERE side = 0) AS home_score,
         max(score) FILTER (WHERE side = 1) AS away_score,
         max(priority) FILTER (WHERE side = 0) AS tournament
  FROM sides GROUP BY match_id),
pivot_ok AS (
  SELECT * FROM paired
  WHERE home_team IS NOT NULL AND away_team IS NOT NULL AND home_team <> away_team)"""

_MATCHES = _PIVOT + """,
matches AS (
  SELECT match_id, date, home_team, away_team, home_score, away_score, tournament,
         match_id % 4 = 0 AS neutral, home_score - away_score AS goal_diff,
         CASE WHEN home_score > away_score THEN 'W'
              WHEN home_score = away_score THEN 'D' ELSE 'L' END AS result
  FROM pivot_ok)"""

_RAW = """,
raw AS (
  SELECT match_id,
         CASE WHEN match_id % 101 = 9 THEN 'n/a' ELSE strftime(date, '%Y-%m-%d') END AS date,
         CASE WHEN match_id % 10 = 3 THEN ' ' || home_team ELSE home_team END AS home_team,
         CASE WHEN match_id % 10 = 7 THEN away_team || '  ' ELSE away_team END AS away_team,
         CAST(CASE WHEN match_id % 97 = 5 THEN NULL ELSE home_score END AS INTEGER) AS home_score,
         CAST(CASE WHEN match_id % 89 = 7 THEN -1 ELSE away_score END AS INTEGER) AS away_score,
         tournament, home_team AS city, home_team AS country,
         CASE WHEN match_id % 103 = 11 THEN 'maybe' WHEN match_id % 4 = 0 THEN 'TRUE'
              ELSE 'FALSE' END AS neutral
  FROM pivot_ok),
parsed AS (
  SELECT match_id, CAST(TRY_STRPTIME(date, '%Y-%m-%d') AS DATE) AS date,
         trim(home_team) AS home_team, trim(away_team) AS away_team,
         home_score, away_score, tournament, city, country,
         TRY_CAST(neutral AS BOOLEAN) AS neutral
  FROM raw),
kept AS (
  SELECT * FROM parsed
  WHERE date IS NOT NULL AND home_team IS NOT NULL AND away_team IS NOT NULL
    AND home_score IS NOT NULL AND away_score IS NOT NULL
    AND home_score >= 0 AND away_score >= 0),
former AS (
  SELECT c.n_name AS current, o.n_name AS former,
         '1996-01-01' AS start_date, '1998-12-31' AS end_date
  FROM nation o JOIN nation c ON o.n_nationkey - 1 = c.n_nationkey
  WHERE o.n_nationkey % 2 = 1 AND o.n_nationkey >= 20),
lookup AS (
  SELECT trim(former) AS former,
         arg_max(trim(current), coalesce(CAST(TRY_STRPTIME(end_date, '%Y-%m-%d') AS DATE),
                                         DATE '9999-12-31')) AS current
  FROM former WHERE former IS NOT NULL AND current IS NOT NULL GROUP BY 1),
cleaned AS (
  SELECT k.match_id, k.date, coalesce(lh.current, k.home_team) AS home_team,
         coalesce(la.current, k.away_team) AS away_team, k.home_score, k.away_score,
         k.tournament, k.city, k.country, k.neutral,
         CASE WHEN k.home_score > k.away_score THEN 'W'
              WHEN k.home_score = k.away_score THEN 'D' ELSE 'L' END AS result,
         k.home_score - k.away_score AS goal_diff
  FROM kept k LEFT JOIN lookup lh ON k.home_team = lh.former
  LEFT JOIN lookup la ON k.away_team = la.former)"""


def _tv(src="matches"):
    return f""",
tv AS (
  SELECT match_id, date, CAST(date - DATE '1970-01-01' AS INTEGER) AS day,
         home_team AS team, away_team AS opponent, home_score AS goals_for,
         away_score AS goals_against,
         CASE WHEN result = 'W' THEN 1 ELSE 0 END AS win,
         CASE WHEN result = 'D' THEN 1 ELSE 0 END AS draw,
         CASE WHEN result = 'L' THEN 1 ELSE 0 END AS loss,
         'home' AS venue, neutral, tournament, home_score - away_score AS gd
  FROM {src}
  UNION ALL
  SELECT match_id, date, CAST(date - DATE '1970-01-01' AS INTEGER) AS day,
         away_team, home_team, away_score, home_score,
         CASE WHEN result = 'L' THEN 1 ELSE 0 END,
         CASE WHEN result = 'D' THEN 1 ELSE 0 END,
         CASE WHEN result = 'W' THEN 1 ELSE 0 END,
         'away', neutral, tournament, away_score - home_score
  FROM {src})"""


_ROWS = [("win_rate_last10", "win", 10, 1), ("draw_rate_last10", "draw", 10, 1),
         ("loss_rate_last10", "loss", 10, 1), ("avg_goals_scored_last20", "goals_for", 20, 1),
         ("avg_goals_conceded_last20", "goals_against", 20, 1), ("avg_gd_last5", "gd", 5, 1),
         ("avg_gd_prev5", "gd", 10, 6), ("avg_goal_diff_last10", "gd", 10, 1),
         ("win_rate_prev10", "win", 20, 11)]

def _tf_sql(prior_days=365, zero_prior=False):
    change = ("form_last6m - coalesce(form_prev6m, 0.0)" if zero_prior else
              "CASE WHEN form_prev6m IS NOT NULL THEN form_last6m - form_prev6m ELSE 0.0 END")
    return _TF.replace("365 PRECEDING", f"{prior_days} PRECEDING").replace("__CHANGE__", change)


_TF = """,
tfr AS (
  SELECT *,
""" + _j([f"    avg({c}) OVER (PARTITION BY team ORDER BY day, match_id "
          f"ROWS BETWEEN {a} PRECEDING AND {b} PRECEDING) AS {n}" for n, c, a, b in _ROWS]) + """,
    count(win) OVER (PARTITION BY team ORDER BY day, match_id
                     ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS matches_available,
    avg(win) OVER (PARTITION BY team ORDER BY day
                   RANGE BETWEEN 180 PRECEDING AND 1 PRECEDING) AS form_last6m,
    avg(win) OVER (PARTITION BY team ORDER BY day
                   RANGE BETWEEN 365 PRECEDING AND 181 PRECEDING) AS form_prev6m
  FROM tv),
tf AS (
  SELECT match_id, date, day, team, opponent, venue, matches_available,
""" + _j([f"    coalesce({n}, 0.0) AS {n}" for n, _, _, _ in _ROWS]
         + ["    coalesce(form_last6m, 0.0) AS form_last6m",
            "    coalesce(form_prev6m, 0.0) AS form_prev6m",
            "    coalesce(avg_gd_last5 - avg_gd_prev5, 0.0) AS goal_diff_trend",
            "    coalesce(form_last6m, 0.0) AS ranking_proxy",
            "    coalesce(__CHANGE__, 0.0) AS ranking_change"]) + """
  FROM tfr)"""

_H2HQ = """,
h2hb AS (
  SELECT *, least(home_team, away_team) AS team_a, greatest(home_team, away_team) AS team_b,
         CASE WHEN (home_team = least(home_team, away_team) AND result = 'W')
                OR (away_team = least(home_team, away_team) AND result = 'L') THEN 1 ELSE 0 END AS a_won,
         CASE WHEN (home_team = greatest(home_team, away_team) AND result = 'W')
                OR (away_team = greatest(home_team, away_team) AND result = 'L') THEN 1 ELSE 0 END AS b_won,
         CASE WHEN result = 'D' THEN 1 ELSE 0 END AS is_draw
  FROM matches),
h2hc AS (
  SELECT *,
    CAST(coalesce(sum(a_won) OVER w, 0) AS BIGINT) AS h2h_team_a_wins,
    CAST(coalesce(sum(b_won) OVER w, 0) AS BIGINT) AS h2h_team_b_wins,
    CAST(coalesce(sum(is_draw) OVER w, 0) AS BIGINT) AS h2h_draws,
    count(*) OVER w AS h2h_total
  FROM h2hb
  WINDOW w AS (PARTITION BY team_a, team_b ORDER BY date, match_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h2h AS (
  SELECT *, CASE WHEN h2h_total > 0 THEN h2h_team_a_wins / h2h_total ELSE 0.33 END
              AS h2h_team_a_win_rate
  FROM h2hc)"""

_MF = """,
mf AS (
  SELECT """ + ", ".join(f"x.{c}" for c in _BASE) + """,
""" + _j([f"    coalesce(h.{c}, {_zero(c)}) AS home_{c}" for c in _SIDE]
         + [f"    coalesce(a.{c}, {_zero(c)}) AS away_{c}" for c in _SIDE]
         + ["    x.team_a", "    x.team_b"] + [f"    x.{c}" for c in _H2H]) + """
  FROM h2h x
  LEFT JOIN tf h ON h.match_id = x.match_id AND h.venue = 'home'
  LEFT JOIN tf a ON a.match_id = x.match_id AND a.venue = 'away'
  WHERE x.date >= DATE '1950-01-01')"""


def _with(*parts):
    return "WITH " + "".join(parts).lstrip().lstrip(",").lstrip() + "\n"


_FEAT = _with(_MATCHES, _tv(), _tf_sql(), _H2HQ, _MF)

_FIX = """,
fixtures_raw AS (
  SELECT CAST(h.n_nationkey * 100 + a.n_nationkey AS INTEGER) AS match_id,
         h.n_name AS home_team, a.n_name AS away_team, r.r_name AS "group",
         strftime(DATE '2002-06-11' + CAST((h.n_nationkey + a.n_nationkey) % 14 AS INTEGER),
                  '%Y-%m-%d') AS match_date
  FROM nation h JOIN nation a ON h.n_regionkey = a.n_regionkey AND h.n_nationkey < a.n_nationkey
  JOIN region r ON h.n_regionkey = r.r_regionkey),
fixtures AS (
  SELECT CAST(match_id AS BIGINT) AS fixture_id, trim("group") AS group_name,
         trim(home_team) AS home_team, trim(away_team) AS away_team,
         CAST(TRY_STRPTIME(match_date, '%Y-%m-%d') AS DATE) AS match_date
  FROM fixtures_raw)"""


def _latest(role):
    cols = ", ".join(f"{role}_{s} AS {s}" for s in _STEMS)
    return f""",
latest_{role} AS (
  SELECT {role}_team AS team, {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY {role}_team ORDER BY date DESC, match_id DESC) AS rn
    FROM mf WHERE {role}_team IS NOT NULL) WHERE rn = 1)"""


_FORMQ = _latest("home") + _latest("away") + """,
form AS (
  SELECT coalesce(h.team, a.team) AS team,
""" + _j([f"    coalesce((h.{s} + a.{s}) / 2.0, h.{s}, a.{s}) AS {s}" for s in _STEMS]) + """
  FROM latest_home h FULL OUTER JOIN latest_away a ON h.team = a.team),
latest_pair AS (
  SELECT team_a, team_b, h2h_team_a_win_rate, h2h_total FROM (
    SELECT least(home_team, away_team) AS team_a, greatest(home_team, away_team) AS team_b,
           h2h_team_a_win_rate, h2h_total,
           row_number() OVER (PARTITION BY least(home_team, away_team), greatest(home_team, away_team)
                              ORDER BY date DESC, match_id DESC) AS rn
    FROM mf) WHERE rn = 1)"""


def _ff_cols():
    out = []
    for s in _STEMS:
        d = "0.33" if "rate" in s else "0.0"
        for p, t in (("home", "fh"), ("away", "fa")):
            out.append(f"    coalesce({t}.{s}, {d}) AS {p}_{s}")
    out.append("    CASE WHEN lp.h2h_team_a_win_rate IS NULL THEN 0.33 "
               "WHEN f.home_team = least(f.home_team, f.away_team) THEN lp.h2h_team_a_win_rate "
               "ELSE greatest(0.0, 1.0 - lp.h2h_team_a_win_rate - 0.25) END AS h2h_team_a_win_rate")
    out.append("    coalesce(lp.h2h_total, 0) AS h2h_total")
    return out


_FFQ = _FIX + _FORMQ + """,
ff AS (
  SELECT f.fixture_id, f.group_name, f.home_team, f.away_team, f.match_date,
""" + _j(_ff_cols()) + """
  FROM fixtures f
  LEFT JOIN form fh ON fh.team = f.home_team
  LEFT JOIN form fa ON fa.team = f.away_team
  LEFT JOIN latest_pair lp ON lp.team_a = least(f.home_team, f.away_team)
                          AND lp.team_b = greatest(f.home_team, f.away_team))"""



def _as_of_sql():
    """Fixtures on three dates each, with form and record from the matches before each date."""
    stems = {"win_rate_last10": "avg(win) FILTER (k <= 10)", "draw_rate_last10": "avg(draw) FILTER (k <= 10)",
             "avg_goals_scored_last20": "avg(goals_for) FILTER (k <= 20)", "avg_goals_conceded_last20": "avg(goals_against) FILTER (k <= 20)",
             "avg_goal_diff_last10": "avg(gd) FILTER (k <= 10)", "goal_diff_trend": "avg(gd) FILTER (k <= 5) - avg(gd) FILTER (k > 5 AND k <= 10)",
             "ranking_proxy": "avg(win) FILTER (day >= d - 180)",
             "ranking_change": "CASE WHEN count(*) FILTER (day < d - 180 AND day >= d - 365) > 0 "
                               "THEN avg(win) FILTER (day >= d - 180) - avg(win) FILTER (day < d - 180 AND day >= d - 365) ELSE 0.0 END"}
    sides = _j([f"    coalesce({p}.{s}, CASE WHEN {p}.fixture_id IS NULL THEN {'0.33' if 'rate' in s else '0.0'} ELSE 0.0 END) AS {side}_{s}"
                for s in _STEMS for side, p in (("home", "h"), ("away", "a"))])
    return """,
dated AS (
  SELECT fixture_id * 10 + k AS fixture_id, group_name, home_team, away_team,
         CASE k WHEN 0 THEN DATE '1996-01-01' + CAST(fixture_id % 900 AS INTEGER)
                WHEN 1 THEN DATE '1999-01-01' + CAST(fixture_id % 700 AS INTEGER) ELSE match_date END AS match_date
  FROM fixtures, (SELECT unnest([0, 1, 2]) AS k)),
sides2 AS (
  SELECT fixture_id, 'home' AS role, home_team AS team, CAST(match_date - DATE '1970-01-01' AS INTEGER) AS d FROM dated UNION ALL
  SELECT fixture_id, 'away', away_team, CAST(match_date - DATE '1970-01-01' AS INTEGER) FROM dated),
seen AS (
  SELECT s.fixture_id, s.role, s.d, t.*, row_number() OVER (PARTITION BY s.fixture_id, s.role ORDER BY t.day DESC, t.match_id DESC) AS k
  FROM sides2 s JOIN tv t ON t.team = s.team AND t.day < s.d),
formq AS (
  SELECT fixture_id, role, """ + ", ".join(f"{x} AS {s}" for s, x in stems.items()).replace("FILTER (", "FILTER (WHERE ") + """
  FROM seen GROUP BY fixture_id, role),
met AS (
  SELECT f.fixture_id, count(*) AS n, count(*) FILTER (WHERE (m.home_team = least(f.home_team, f.away_team) AND m.result = 'W')
           OR (m.away_team = least(f.home_team, f.away_team) AND m.result = 'L')) / count(*) AS r
  FROM dated f JOIN matches m ON m.date < f.match_date AND least(m.home_team, m.away_team) = least(f.home_team, f.away_team)
       AND greatest(m.home_team, m.away_team) = greatest(f.home_team, f.away_team) GROUP BY f.fixture_id),
ff AS (
  SELECT f.fixture_id, f.group_name, f.home_team, f.away_team, f.match_date,
""" + sides + """,
    CASE WHEN m.r IS NULL THEN 0.33 WHEN f.home_team < f.away_team THEN m.r ELSE greatest(0.0, 1.0 - m.r - 0.25) END AS h2h_team_a_win_rate,
    coalesce(m.n, 0) AS h2h_total
  FROM dated f LEFT JOIN formq h ON h.fixture_id = f.fixture_id AND h.role = 'home'
  LEFT JOIN formq a ON a.fixture_id = f.fixture_id AND a.role = 'away' LEFT JOIN met m ON m.fixture_id = f.fixture_id)"""


_AS_OF = _as_of_sql()

_BUCKET = "CAST(('0x' || substr(md5(CAST(match_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000"

_MLQ = """,
ts AS (
  SELECT match_id, date, """ + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FEATURES) + """,
         CAST(CASE result WHEN 'W' THEN 0 WHEN 'D' THEN 1 WHEN 'L' THEN 2 END AS DOUBLE) AS label
  FROM mf WHERE result IS NOT NULL AND date >= DATE '1990-01-01'),
train AS (SELECT * FROM ts WHERE """ + _BUCKET + """ >= 2000),
test AS (SELECT * FROM ts WHERE """ + _BUCKET + """ < 2000),
pri AS (
  SELECT count_if(label = 0) / count(*) AS win_prob, count_if(label = 1) / count(*) AS draw_prob,
         count_if(label = 2) / count(*) AS loss_prob FROM train),
prim AS (
  SELECT *, CAST(CASE WHEN win_prob >= draw_prob AND win_prob >= loss_prob THEN 0
                      WHEN draw_prob >= loss_prob THEN 1 ELSE 2 END AS DOUBLE) AS majority FROM pri),
tpred AS (
  SELECT t.*, p.majority AS prediction, p.win_prob, p.draw_prob, p.loss_prob
  FROM test t CROSS JOIN prim p)"""

_PREDQ = _FFQ + _MLQ + """,
preds AS (
  SELECT f.fixture_id, f.group_name, f.home_team, f.away_team, f.match_date,
         CASE p.majority WHEN 0 THEN 'W' WHEN 1 THEN 'D' ELSE 'L' END AS predicted_result,
         round(p.win_prob, 4) AS win_prob, round(p.draw_prob, 4) AS draw_prob,
         round(p.loss_prob, 4) AS loss_prob,
         round(greatest(p.win_prob, p.draw_prob, p.loss_prob), 4) AS confidence,
         (SELECT CAST(max(date) AS TIMESTAMP) FROM matches) AS predicted_at
  FROM ff f CROSS JOIN prim p)"""

# the fixed linear model (see matchlab.operators.ml)
_FIXED_WEIGHTS = [("win_rate_last10", 1.5), ("draw_rate_last10", -0.5), ("avg_goals_scored_last20", 0.375),
                  ("avg_goals_conceded_last20", -0.25), ("avg_goal_diff_last10", 0.25), ("goal_diff_trend", 0.125),
                  ("ranking_proxy", 1.0), ("ranking_change", 0.75)]
_FIXED_S = "CAST(0.0 AS DOUBLE)"
for _stem, _w in _FIXED_WEIGHTS:
    _FIXED_S = f"({_FIXED_S} + (CAST(home_{_stem} AS DOUBLE) - CAST(away_{_stem} AS DOUBLE)) * CAST({_w} AS DOUBLE))"
_FIXED_S = f"({_FIXED_S} + (CAST(h2h_team_a_win_rate AS DOUBLE) - CAST(0.33 AS DOUBLE)) * CAST(1.25 AS DOUBLE))"


def _fixed(source):
    """``source`` with prediction and probabilities."""
    return f"""SELECT * EXCLUDE (_s, _w, _d, _l), _w / (_w + _d + _l) AS win_prob, _d / (_w + _d + _l) AS draw_prob, _l / (_w + _d + _l) AS loss_prob,
         CAST(CASE WHEN _w >= _d AND _w >= _l THEN 0 WHEN _d >= _l THEN 1 ELSE 2 END AS DOUBLE) AS prediction
  FROM (SELECT *, exp(_s) AS _w, exp(CAST(0.0625 AS DOUBLE)) AS _d, exp(-_s) AS _l FROM (SELECT *, {_FIXED_S} AS _s FROM {source}))"""


def _scored(source, extra=""):
    return f"""SELECT fixture_id, group_name, home_team, away_team, match_date,
         CASE prediction WHEN 0 THEN 'W' WHEN 1 THEN 'D' ELSE 'L' END AS predicted_result,
         round(win_prob, 4) AS win_prob, round(draw_prob, 4) AS draw_prob, round(loss_prob, 4) AS loss_prob,
         round(greatest(win_prob, draw_prob, loss_prob), 4) AS confidence,
         (SELECT CAST(max(date) AS TIMESTAMP) FROM matches) AS predicted_at{extra} FROM ({_fixed(source)})"""


_FIXEDQ = _FFQ + ",\npreds AS (" + _scored("ff") + ")"

_ALL = _MATCHES + _tv() + _tf_sql() + _H2HQ + _MF
_SQL_PRED = _with(_ALL, _PREDQ)
_SQL_FF = _with(_ALL, _FFQ)
_SQL_ML = _with(_ALL, _MLQ)
_SQL_FIXED = _with(_ALL, _FIXEDQ)


def _last_n_sql(n):
    return f""",
lastn AS (
  SELECT team, CAST(rn AS INTEGER) AS rn, match_id, date, home_team, away_team, home_score,
         away_score, result, tournament,
         CASE WHEN is_home THEN result WHEN result = 'W' THEN 'L' WHEN result = 'L' THEN 'W'
              ELSE result END AS team_result
  FROM (
    SELECT *, row_number() OVER (PARTITION BY team ORDER BY date DESC, match_id DESC) AS rn FROM (
      SELECT *, home_team AS team, true AS is_home FROM matches
      UNION ALL SELECT *, away_team AS team, false AS is_home FROM matches))
  WHERE rn <= {n})"""


def _h2h_all():
    return """,
h2h_all AS (
  SELECT least(home_team, away_team) AS team_a, greatest(home_team, away_team) AS team_b,
         CAST(sum(CASE WHEN (home_team < away_team AND result = 'W')
                         OR (home_team > away_team AND result = 'L') THEN 1 ELSE 0 END) AS BIGINT) AS team_a_wins,
         CAST(sum(CASE WHEN (home_team < away_team AND result = 'L')
                         OR (home_team > away_team AND result = 'W') THEN 1 ELSE 0 END) AS BIGINT) AS team_b_wins,
         CAST(sum(CASE WHEN result = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS draws,
         count(*) AS total
  FROM matches GROUP BY 1, 2)"""


def _mart_team_form():
    parts = []
    for k in (10, 20):
        parts += [
            f"count_if(rn <= {k}) AS matches_last{k}",
            f"count_if(rn <= {k} AND team_result = 'W') AS wins_last{k}",
            f"count_if(rn <= {k} AND team_result = 'D') AS draws_last{k}",
            f"count_if(rn <= {k} AND team_result = 'L') AS losses_last{k}",
            f"CAST(sum(CASE WHEN rn <= {k} THEN gf END) AS BIGINT) AS goals_for_last{k}",
            f"CAST(sum(CASE WHEN rn <= {k} THEN ga END) AS BIGINT) AS goals_against_last{k}",
        ]
    return _last_n_sql(20) + """,
mtf AS (
  SELECT team, """ + ", ".join(parts) + """
  FROM (SELECT *, CASE WHEN home_team = team THEN home_score ELSE away_score END AS gf,
                  CASE WHEN home_team = team THEN away_score ELSE home_score END AS ga FROM lastn)
  GROUP BY team)"""


def _count_filter(sql: str) -> str:
    """count_if(x) -> count(*) FILTER (WHERE x): BIGINT like Spark's count_if
    (DuckDB's count_if returns HUGEINT)."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"count(*) FILTER (WHERE {_count_filter(sql[j + len(key):k - 1])})")
        i = k


def oracle_sql() -> dict[str, str]:
    return {k: _count_filter(v) for k, v in _oracle_sql().items()} | _corpus()[1]


def _oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    M = _with(_MATCHES)
    R = _with(_MATCHES, _RAW)

    # sources
    raw_cols = "date, home_team, away_team, home_score, away_score, tournament, city, country, neutral"
    q["s01_read_csv"] = R + f"SELECT {raw_cols} FROM raw"
    q["s02_read_csv_inferred"] = R + f"SELECT {raw_cols} FROM raw"
    q["s04_read_parquet"] = M + "SELECT * FROM matches"
    q["s05_write_partitioned"] = M + "SELECT *, CAST(year(date) AS INTEGER) AS year FROM matches"
    q["s09_stg_fixtures"] = _with(_FIX) + "SELECT * FROM fixtures"
    q["s11_round_trip"] = M + ("SELECT 'matches' AS table_name, count(*) AS rows_written, "
                               "count(*) AS rows_read, 'PASS' AS status FROM matches")
    q["s12_preview"] = M + "SELECT * FROM matches ORDER BY match_id LIMIT 5"

    # cleaning
    q["p12_clean_matches"] = R + "SELECT * FROM cleaned"
    q["j05_names_by_validity"] = R + """
SELECT k.match_id, k.date,
       coalesce(fh.current, k.home_team) AS home_team, coalesce(fa.current, k.away_team) AS away_team,
       k.home_score, k.away_score, k.tournament, k.city, k.country, k.neutral,
       CASE WHEN k.home_score > k.away_score THEN 'W' WHEN k.home_score = k.away_score THEN 'D'
            ELSE 'L' END AS result,
       k.home_score - k.away_score AS goal_diff
FROM kept k
LEFT JOIN former fh ON k.home_team = fh.former
  AND k.date BETWEEN CAST(fh.start_date AS DATE) AND CAST(fh.end_date AS DATE)
LEFT JOIN former fa ON k.away_team = fa.former
  AND k.date BETWEEN CAST(fa.start_date AS DATE) AND CAST(fa.end_date AS DATE)"""
    q["p10_clean_goalscorers"] = _with(_PIVOT) + """
SELECT * FROM (
  SELECT CAST(TRY_STRPTIME(CASE WHEN l.l_partkey % 211 = 3 THEN 'bad-date'
                                ELSE strftime(p.date, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS date,
         trim(p.home_team) AS home_team, trim(p.away_team) AS away_team,
         trim(CASE WHEN l.l_partkey % 50 = 1
                   THEN ' ' || CASE WHEN l.l_orderkey % 2 = 0 THEN p.home_team ELSE p.away_team END
                   WHEN l.l_partkey % 199 = 2 THEN NULL
                   ELSE CASE WHEN l.l_orderkey % 2 = 0 THEN p.home_team ELSE p.away_team END END) AS team,
         'Player ' || CAST(l.l_partkey AS VARCHAR) AS scorer,
         CAST(trunc((l.l_linenumber * 13) % 90 + 0.5) AS INTEGER) AS minute,
         l.l_returnflag = 'R' AS own_goal,
         (l.l_linestatus = 'F' AND l.l_linenumber = 1) AS penalty
  FROM lineitem l JOIN pivot_ok p ON l.l_orderkey // 2 = p.match_id)
WHERE date IS NOT NULL AND team IS NOT NULL"""
    q["p11_clean_shootouts"] = M + """
SELECT * FROM (
  SELECT date,
         trim(CASE WHEN match_id % 9 = 4 THEN home_team || ' ' ELSE home_team END) AS home_team,
         trim(away_team) AS away_team,
         trim(CASE WHEN match_id % 37 = 5 THEN NULL
                   WHEN match_id % 7 = 1 THEN ' ' || CASE WHEN match_id % 2 = 0 THEN home_team ELSE away_team END
                   ELSE CASE WHEN match_id % 2 = 0 THEN home_team ELSE away_team END END) AS winner,
         CASE WHEN match_id % 3 = 0 THEN NULL
              WHEN match_id % 2 = 0 THEN home_team ELSE away_team END AS first_shooter
  FROM matches WHERE result = 'D')
WHERE date IS NOT NULL AND winner IS NOT NULL"""

    # quality
    pcols = ["match_id", "date", "home_team", "away_team", "home_score", "away_score",
             "tournament", "city", "country", "neutral"]
    q["q01_null_counts"] = R + "SELECT * FROM (\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count FROM parsed" for c in pcols
    ) + "\n) WHERE null_count > 0"
    q["q02_date_range"] = M + "SELECT min(date) AS min_date, max(date) AS max_date, count(*) AS n_rows FROM matches"
    q["q03_top_home_teams"] = M + ("SELECT home_team AS value, count(*) AS n FROM matches "
                                   "GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
    q["q04_distinct_teams"] = M + ("SELECT DISTINCT team FROM (SELECT home_team AS team FROM matches "
                                   "UNION ALL SELECT away_team FROM matches)")
    q["q05_class_distribution"] = M + ("SELECT result, count(*) AS n, "
                                       "round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct "
                                       "FROM matches GROUP BY result")
    q["q06_feature_summary"] = _FEAT + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
        f"round(quantile_cont({c}, 0.75), 6) AS p75, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM mf" for c in _FEATURES)
    q["q07_cleaning_report"] = R + """
SELECT count(*) AS original_rows, count_if(date IS NOT NULL AND home_team IS NOT NULL
         AND away_team IS NOT NULL AND home_score IS NOT NULL AND away_score IS NOT NULL
         AND home_score >= 0 AND away_score >= 0) AS clean_rows,
       count(*) - count_if(date IS NOT NULL AND home_team IS NOT NULL
         AND away_team IS NOT NULL AND home_score IS NOT NULL AND away_score IS NOT NULL
         AND home_score >= 0 AND away_score >= 0) AS dropped_rows,
       round((count(*) - count_if(date IS NOT NULL AND home_team IS NOT NULL
         AND away_team IS NOT NULL AND home_score IS NOT NULL AND away_score IS NOT NULL
         AND home_score >= 0 AND away_score >= 0)) * 100.0 / count(*), 2) AS pct_dropped
FROM parsed"""
    q["q08_forbidden_names"] = R + """
SELECT count(*) AS former_names_left, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT DISTINCT team FROM (SELECT home_team AS team FROM cleaned
                                 UNION ALL SELECT away_team FROM cleaned)) t
WHERE team IN (SELECT trim(former) FROM former)"""
    contract = [("raw_results", 40000), ("raw_goalscorers", 10000), ("raw_shootouts", 100),
                ("raw_former_names", 10), ("match_features", 20000), ("fixtures", 48),
                ("predictions", 48), ("mart_team_form", 50), ("mart_head_to_head", 100),
                ("mart_predictions_input", 48)]
    counts = [
        "SELECT 'raw_results' AS table_name, count(*) AS actual_rows FROM pivot_ok",
        "SELECT 'raw_goalscorers', count(*) FROM lineitem l JOIN pivot_ok p ON l.l_orderkey // 2 = p.match_id",
        "SELECT 'raw_shootouts', count(*) FROM matches WHERE result = 'D'",
        "SELECT 'raw_former_names', count(*) FROM former",
        "SELECT 'match_features', count(*) FROM mf",
        "SELECT 'fixtures', count(*) FROM fixtures",
        "SELECT 'mart_team_form', count(DISTINCT team) FROM (SELECT home_team AS team FROM matches "
        "UNION ALL SELECT away_team FROM matches)",
        "SELECT 'mart_head_to_head', count(*) FROM h2h_all",
        "SELECT 'mart_predictions_input', count(*) FROM ff",
        "SELECT 'predictions', count(*) FROM ff",
    ]
    values = ", ".join(f"('{n}', {v})" for n, v in contract)
    q["q09_row_contract"] = _with(_ALL, _RAW, _FFQ, _h2h_all()) + f"""
SELECT c.table_name, CAST(c.min_rows AS BIGINT) AS min_rows, n.actual_rows,
       CASE WHEN n.actual_rows IS NULL THEN 'MISSING' WHEN n.actual_rows >= c.min_rows THEN 'PASS'
            ELSE 'LOW' END AS status
FROM (VALUES {values}) c(table_name, min_rows)
LEFT JOIN ({" UNION ALL ".join(counts)}) n ON n.table_name = c.table_name"""
    tests = M + """
, t AS (
  SELECT 'not_null' AS test_name, 'match_id' AS column_name, count_if(match_id IS NULL) AS failures FROM matches
  UNION ALL SELECT 'not_null', 'date', count_if(date IS NULL) FROM matches
  UNION ALL SELECT 'not_null', 'home_team', count_if(home_team IS NULL) FROM matches
  UNION ALL SELECT 'not_null', 'away_team', count_if(away_team IS NULL) FROM matches
  UNION ALL SELECT 'not_null', 'result', count_if(result IS NULL) FROM matches
  UNION ALL SELECT 'accepted_values', 'result',
                   count_if(result IS NOT NULL AND result NOT IN ('W', 'D', 'L')) FROM matches
  UNION ALL SELECT 'unique', 'match_id', count(*) FROM (
      SELECT match_id FROM matches WHERE match_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)),
tt AS (
  SELECT test_name, 'matches' AS table_name, column_name, CAST(failures AS BIGINT) AS failures,
         CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM t)
"""
    q["q10_column_tests"] = tests + "SELECT * FROM tt"
    q["q12_test_summary"] = tests + "SELECT status, count(*) AS n_tests FROM tt GROUP BY status"
    rate_cols = ["win_rate_last10", "draw_rate_last10", "loss_rate_last10", "form_last6m",
                 "form_prev6m", "ranking_proxy", "win_rate_prev10"]
    goal_cols = ["avg_goals_scored_last20", "avg_goals_conceded_last20"]
    checks = []
    for side in ("home", "away"):
        checks += [f"SELECT 'rate_in_0_1|{side}_{c}' AS check_name, "
                   f"count_if(NOT ({side}_{c} BETWEEN 0.0 AND 1.0)) AS failures FROM mf" for c in rate_cols]
        checks += [f"SELECT 'goals_in_0_5|{side}_{c}', count_if(NOT ({side}_{c} BETWEEN 0.0 AND 5.0)) FROM mf"
                   for c in goal_cols]
    checks.append("SELECT 'rate_in_0_1|h2h_team_a_win_rate', "
                  "count_if(NOT (h2h_team_a_win_rate BETWEEN 0.0 AND 1.0)) FROM mf")
    checks.append("SELECT 'h2h_total_non_decreasing', CAST(count(*) AS BIGINT) FROM ("
                  "SELECT h2h_total, lag(h2h_total) OVER (PARTITION BY team_a, team_b "
                  "ORDER BY date, match_id) AS prev FROM mf) WHERE prev > h2h_total")
    q["q13_range_checks"] = _FEAT + "\nUNION ALL\n".join(checks)
    q["q14_unmatched_teams"] = _with(_MATCHES, _RAW, _FIX) + """
SELECT DISTINCT team FROM (SELECT home_team AS team FROM fixtures UNION ALL SELECT away_team FROM fixtures)
WHERE team NOT IN (SELECT home_team FROM cleaned WHERE date >= DATE '1950-01-01'
                   UNION SELECT away_team FROM cleaned WHERE date >= DATE '1950-01-01')"""

    # perspective, windows, features
    q["u01_team_view"] = _with(_MATCHES, _tv()) + "SELECT * FROM tv"
    q["w01_w15_rolling_features"] = _with(_MATCHES, _tv(), _tf_sql()) + (
        "SELECT match_id, date, team, opponent, venue, " + ", ".join(_SIDE) + " FROM tf")
    q["w01_w15_rolling_bucketed"] = q["w01_w15_incremental"] = q["w01_w15_rolling_features"]
    q["w10_w13_rolling_dag_preset"] = _with(_MATCHES, _tv(), _tf_sql(360, zero_prior=True)) + (
        "SELECT match_id, date, team, opponent, venue, " + ", ".join(_SIDE) + " FROM tf")
    q["w16_w20_h2h_features"] = _with(_MATCHES, _H2HQ) + (
        "SELECT match_id, date, home_team, away_team, team_a, team_b, " + ", ".join(_H2H) + " FROM h2h")
    q["w16_w20_h2h_bucketed"] = q["w16_w20_incremental"] = q["w16_w20_h2h_features"]
    q["j02_j04_match_features"] = _FEAT + "SELECT * FROM mf"

    # snapshots and reports
    F = _with(_ALL, _FFQ)
    stems = ", ".join(_STEMS)
    q["l01_latest_home"] = F + f"SELECT team, {stems} FROM latest_home"
    q["l02_latest_away"] = F + f"SELECT team, {stems} FROM latest_away"
    q["j06_latest_form"] = F + f"SELECT team, {stems} FROM form"
    q["l03_latest_h2h"] = F + "SELECT * FROM latest_pair"
    q["l08_latest_form_home_first"] = F + "SELECT coalesce(h.team, a.team) AS team, " + ", ".join(
        f"coalesce(h.{s}, a.{s}) AS {s}" for s in _STEMS) + \
        " FROM latest_home h FULL OUTER JOIN latest_away a ON h.team = a.team"
    q["m13_fixture_features"] = F + "SELECT * FROM ff"
    q["l04_last_10"] = _with(_MATCHES, _last_n_sql(10)) + "SELECT * FROM lastn"
    live = []
    for s in _STEMS:
        d = "0.33" if "rate" in s else "0.0"
        for p, t in (("home", "fh"), ("away", "fa")):
            live.append(f"coalesce({t}.{s}, {d}) AS {p}_{s}")
    live.append("CASE WHEN r.total IS NULL THEN 0.33 "
                "WHEN f.home_team = r.team_a THEN (CASE WHEN r.total > 0 THEN r.team_a_wins / r.total ELSE 0.33 END) "
                "ELSE greatest(0.0, 1.0 - (CASE WHEN r.total > 0 THEN r.team_a_wins / r.total ELSE 0.33 END) - 0.25) "
                "END AS h2h_team_a_win_rate")
    live.append("coalesce(r.total, 0) AS h2h_total")
    q["m15_live_pair_features"] = _with(_ALL, _FFQ, _h2h_all()) + """
, pairs AS (SELECT min(match_id) AS fixture_id, 'Custom' AS group_name, home_team, away_team,
                   CAST(NULL AS DATE) AS match_date FROM matches GROUP BY home_team, away_team),
hf AS (SELECT coalesce(h.team, a.team) AS team, """ + ", ".join(
        f"coalesce(h.{s}, a.{s}) AS {s}" for s in _STEMS) + """
       FROM latest_home h FULL OUTER JOIN latest_away a ON h.team = a.team)
SELECT f.fixture_id, f.group_name, f.home_team, f.away_team, f.match_date, """ + ", ".join(live) + """
FROM pairs f LEFT JOIN hf fh ON fh.team = f.home_team LEFT JOIN hf fa ON fa.team = f.away_team
LEFT JOIN h2h_all r ON r.team_a = least(f.home_team, f.away_team) AND r.team_b = greatest(f.home_team, f.away_team)"""
    q["l05_form_summary"] = _with(_MATCHES, _last_n_sql(10)) + """
SELECT team, count_if(team_result = 'W') AS wins, count_if(team_result = 'D') AS draws,
       count_if(team_result = 'L') AS losses, count(*) AS n,
       round(count_if(team_result = 'W') / count(*), 4) AS win_rate,
       string_agg(team_result, '' ORDER BY rn) AS form
FROM lastn GROUP BY team"""
    q["l06_h2h_all_time"] = _with(_MATCHES, _h2h_all()) + "SELECT * FROM h2h_all"
    q["l07_h2h_for_fixtures"] = _with(_MATCHES, _h2h_all(), _FIX) + """
SELECT f.*,
       coalesce(CASE WHEN f.home_team = h.team_a THEN h.team_a_wins ELSE h.team_b_wins END, 0) AS home_wins,
       coalesce(CASE WHEN f.home_team = h.team_a THEN h.team_b_wins ELSE h.team_a_wins END, 0) AS away_wins,
       coalesce(h.draws, 0) AS draws, coalesce(h.total, 0) AS total
FROM fixtures f LEFT JOIN h2h_all h
  ON h.team_a = least(f.home_team, f.away_team) AND h.team_b = greatest(f.home_team, f.away_team)"""
    q["d02_stg_rankings"] = _with(_MATCHES, _tv()) + """
, per_team AS (
  SELECT team, count(*) AS matches, CAST(sum(win * 3 + draw * 1 + loss * 0) AS BIGINT) AS points
  FROM tv WHERE day > (SELECT max(day) FROM tv) - 365 GROUP BY team)
SELECT team, matches, points, round(points / matches, 6) AS points_per_match,
       rank() OVER (ORDER BY round(points / matches, 6) DESC) AS strength_rank
FROM per_team"""
    q["d04_mart_team_form"] = _with(_MATCHES, _mart_team_form()) + "SELECT * FROM mtf"

    # ML (deterministic parts) and reports on the majority-baseline model
    q["m01_training_set"] = _SQL_ML + "SELECT * FROM ts"
    q["m03_split_counts"] = _SQL_ML + (
        "SELECT CASE WHEN " + _BUCKET + " < 2000 THEN 'test' ELSE 'train' END AS part, label, "
        "count(*) AS n FROM ts GROUP BY 1, 2")
    q["m03_stratified_split"] = _SQL_ML + """, r AS (
  SELECT match_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(match_id AS VARCHAR)), match_id) AS k,
         floor(count(*) OVER (PARTITION BY label) * 0.2 + 0.5) AS take FROM ts)
SELECT match_id, label, CASE WHEN k <= take THEN 'test' ELSE 'train' END AS part FROM r"""
    q["s11_content_check"] = _with(_MATCHES) + ("SELECT 'matches' AS table_name, count(*) AS rows_written, count(*) AS rows_read, "
                                                "true AS same_content, 'PASS' AS status FROM matches")
    q["l10_ordered_files"] = _with(_MATCHES) + (
        "SELECT match_id, date, home_team, away_team, row_number() OVER (ORDER BY date, match_id) AS position FROM matches")
    q["a06_result_strings"] = _with(_MATCHES, _tv()) + """, n AS (
  SELECT team, CASE WHEN win = 1 THEN 'W' WHEN draw = 1 THEN 'D' ELSE 'L' END AS code,
         row_number() OVER (PARTITION BY team ORDER BY day, match_id) - 1 AS k FROM tv)
SELECT team, k // 100 AS part, string_agg(code, '' ORDER BY k) AS results FROM n GROUP BY 1, 2"""
    q["j07_j08_as_of"] = _with(_MATCHES, _tv(), _FIX, _AS_OF) + "SELECT * FROM ff"
    q["m07_fixed_trees"] = _SQL_ML + """, s AS (
  SELECT match_id,
    CASE WHEN home_win_rate_last10 <= 0.3 THEN CASE WHEN away_win_rate_last10 <= 0.5 THEN 0.1 ELSE -0.2 END
         ELSE CASE WHEN away_win_rate_last10 <= 0.3 THEN 0.4 ELSE 0.15 END END
    + CASE WHEN home_goal_diff_trend <= 0 THEN -0.05 ELSE 0.2 END AS w,
    CASE WHEN h2h_total <= 8 THEN 0.05 ELSE -0.1 END AS d,
    CASE WHEN away_win_rate_last10 <= 0.5 THEN -0.1 ELSE 0.35 END
    + CASE WHEN home_goal_diff_trend <= 0 THEN 0.1 WHEN home_win_rate_last10 <= 0.5 THEN -0.05 ELSE -0.3 END AS l
  FROM ts),
e AS (SELECT match_id, exp(CAST(w AS DOUBLE)) AS w, exp(CAST(d AS DOUBLE)) AS d, exp(CAST(l AS DOUBLE)) AS l FROM s)
SELECT match_id, CAST(CASE WHEN w >= d AND w >= l THEN 0 WHEN d >= l THEN 1 ELSE 2 END AS DOUBLE) AS prediction,
       CASE WHEN w >= d AND w >= l THEN 'W' WHEN d >= l THEN 'D' ELSE 'L' END AS predicted_result,
       round(w / (w + d + l), 9) AS win_prob, round(d / (w + d + l), 9) AS draw_prob, round(l / (w + d + l), 9) AS loss_prob FROM e"""
    q["m04_scaler_stats"] = _SQL_ML + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 9) AS std FROM train"
        for c in _FEATURES)
    q["a04_feature_medians"] = _SQL_ML + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(median({c}) AS DOUBLE) AS median FROM train" for c in _FEATURES)
    q["a05_label_mode"] = _SQL_ML + (
        "SELECT label AS majority_label FROM train GROUP BY label ORDER BY count(*) DESC, label LIMIT 1")
    q["m08_baseline_metrics"] = _SQL_ML + """
SELECT count(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
       round(avg(-ln(greatest(CASE WHEN label = 0 THEN win_prob WHEN label = 1 THEN draw_prob
                                   ELSE loss_prob END, 1e-15))), 9) AS log_loss
FROM tpred"""
    q["m09_baseline_class_report"] = _SQL_ML + """
, per AS (
  SELECT c.class, count_if(t.label = c.k AND t.prediction = c.k) AS tp,
         count_if(t.prediction = c.k) AS predicted, count_if(t.label = c.k) AS support
  FROM (VALUES ('W', 0.0), ('D', 1.0), ('L', 2.0)) c(class, k) CROSS JOIN tpred t GROUP BY c.class),
pr AS (
  SELECT class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM per),
prf AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                 ELSE 0.0 END AS f1 FROM pr),
allr AS (
  SELECT class, precision, recall, f1, support FROM prf
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM prf
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                   sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM prf)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM allr"""
    q["m10_baseline_confusion"] = _SQL_ML + """
, c AS (
  SELECT label, count_if(prediction = 0) AS pred_0, count_if(prediction = 1) AS pred_1,
         count_if(prediction = 2) AS pred_2 FROM tpred GROUP BY label)
SELECT label, pred_0, pred_1, pred_2,
       round(pred_0 / (pred_0 + pred_1 + pred_2), 6) AS pred_0_rate,
       round(pred_1 / (pred_0 + pred_1 + pred_2), 6) AS pred_1_rate,
       round(pred_2 / (pred_0 + pred_1 + pred_2), 6) AS pred_2_rate
FROM c"""
    q["m11_baseline_lift"] = _SQL_ML + """
, maj AS (SELECT label AS m FROM train GROUP BY label ORDER BY count(*) DESC, label LIMIT 1),
b AS (SELECT avg(CASE WHEN label = (SELECT m FROM maj) THEN 1.0 ELSE 0.0 END) AS ba FROM test),
md AS (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS ma FROM tpred)
SELECT CASE (SELECT m FROM maj) WHEN 0 THEN 'W' WHEN 1 THEN 'D' ELSE 'L' END AS majority_class,
       round(ba, 9) AS baseline_accuracy, round(ma, 9) AS model_accuracy,
       round(CASE WHEN ba = 0 THEN NULL ELSE (ma - ba) * 100.0 / ba END, 4) AS lift_pct
FROM b CROSS JOIN md"""
    P = _SQL_PRED
    q["m14_prior_predictions"] = P + "SELECT * FROM preds"
    P = _SQL_FIXED
    cut = lambda sql: sql.replace("DATE '1950-01-01'", "DATE '1997-07-01'").replace("DATE '1990-01-01'", "DATE '1999-01-01'")
    q["p09_min_date"] = cut(_FEAT) + "SELECT * FROM mf"
    q["w10_before_cut"] = q["w10_w13_rolling_dag_preset"].replace("FROM pivot_ok)", "FROM pivot_ok WHERE date >= DATE '1997-07-01')")
    q["m01_training_cut"] = _SQL_ML.replace("DATE '1990-01-01'", "DATE '1999-01-01'") + "SELECT * FROM ts"
    q["m02_imputed"] = _SQL_ML + """
, gaps AS (SELECT match_id, CASE WHEN match_id % 7 <> 0 THEN home_win_rate_last10 END AS x, away_win_rate_last10 FROM train)
SELECT match_id, coalesce(x, (SELECT CAST(median(x) AS DOUBLE) FROM gaps)) AS home_win_rate_last10, away_win_rate_last10 FROM gaps"""
    q["j07_j08_unknown_teams"] = q["m13_fixture_features"].replace(
        "WHERE x.date >= DATE '1950-01-01'", "WHERE x.date >= DATE '1950-01-01' AND x.home_team <> 'NATION_12' AND x.away_team <> 'NATION_12'")
    for name in ("metrics", "class_report", "confusion", "lift"):
        k = {"metrics": "m08", "class_report": "m09", "confusion": "m10", "lift": "m11"}[name]
        q[f"{k}_fixed_{name}"] = q[f"{k}_baseline_{name}"].replace(
            "SELECT t.*, p.majority AS prediction, p.win_prob, p.draw_prob, p.loss_prob\n  FROM test t CROSS JOIN prim p", _fixed("test"))
    q["m15_scored_pairs"] = _with(_MATCHES) + _scored(f"({q['m15_live_pair_features']})")
    total = 2 * sum(abs(w) for _, w in _FIXED_WEIGHTS) + 1.25
    weight = {f"{side}_{x}": abs(w) for x, w in _FIXED_WEIGHTS for side in ("home", "away")} | {"h2h_team_a_win_rate": 1.25, "h2h_total": 0.0}
    imp = ", ".join(f"('{c}', CAST({round(weight[c] * 100.0 / total, 4)} AS DOUBLE))" for c in _FEATURES)
    long = " UNION ALL ".join(f"SELECT fixture_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM top" for c in _FEATURES)

    def _drivers(score, join):
        return f"""
, top AS (SELECT ff.* FROM ff JOIN (SELECT fixture_id FROM preds ORDER BY confidence DESC, fixture_id LIMIT 10) USING (fixture_id)),
imp AS (SELECT * FROM (VALUES {imp}) v(feature, w)), long AS ({long}),
sc AS (SELECT fixture_id, feature, value, round({score}, 9) AS score FROM long JOIN imp USING (feature) {join}),
rk AS (SELECT *, row_number() OVER (PARTITION BY fixture_id ORDER BY abs(score) DESC, feature) AS rank FROM sc)
SELECT fixture_id, CAST(rank AS INTEGER) AS rank, feature, value, score, CASE WHEN score > 0 THEN 'up' ELSE 'down' END AS direction
FROM rk WHERE rank <= 5"""

    q["m18_drivers_raw"] = P + _drivers("value * w", "")
    q["m17_drivers_fixed"] = _with(_ALL, _FIXEDQ, _MLQ) + (
        ", st AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 9) AS std FROM train" for c in _FEATURES) + ")"
    ) + _drivers("(value - mean) / (std + 1e-9) * w", "JOIN st USING (feature)")
    q["l11_pair_predictions"] = P + ("SELECT p.* FROM preds p, (SELECT home_team AS x, away_team AS y FROM fixtures ORDER BY fixture_id LIMIT 1) f "
                                     "WHERE (home_team = x AND away_team = y) OR (home_team = y AND away_team = x)")
    q["p20_fixed_clock"] = P + "SELECT * EXCLUDE (predicted_at), TIMESTAMP '2002-06-01 06:30:00' AS predicted_at FROM preds"
    q["l16_inventory"] = _with(_MATCHES, _FIX) + """
, t AS (SELECT 'matches' AS table_name, count(*) AS n_rows FROM matches UNION ALL SELECT 'fixtures', count(*) FROM fixtures)
SELECT * FROM t UNION ALL SELECT 'TOTAL', CAST(sum(n_rows) AS BIGINT) FROM t"""
    q["q11_gate"] = q["q10_column_tests"]
    q["s11_round_trip_partitioned"] = q["s11_round_trip"]
    q["l09_top_confidence"] = P + "SELECT * FROM preds ORDER BY confidence DESC, fixture_id LIMIT 10"
    q["l11_group_predictions"] = P + ("SELECT * FROM preds WHERE group_name = 'ASIA' "
                                      "ORDER BY match_date, group_name, fixture_id")
    q["l12_display_table"] = P + """
SELECT fixture_id, strftime(match_date, '%d %b') AS date, group_name,
       home_team || ' vs ' || away_team AS fixture,
       CASE predicted_result WHEN 'W' THEN home_team || ' Wins' WHEN 'L' THEN away_team || ' Wins'
            WHEN 'D' THEN 'Draw' END AS prediction,
       printf('%d.%d%%', CAST(floor(win_prob * 1000.0 + 0.5) AS BIGINT) // 10, CAST(floor(win_prob * 1000.0 + 0.5) AS BIGINT) % 10) AS win,
       printf('%d.%d%%', CAST(floor(draw_prob * 1000.0 + 0.5) AS BIGINT) // 10, CAST(floor(draw_prob * 1000.0 + 0.5) AS BIGINT) % 10) AS draw,
       printf('%d.%d%%', CAST(floor(loss_prob * 1000.0 + 0.5) AS BIGINT) // 10, CAST(floor(loss_prob * 1000.0 + 0.5) AS BIGINT) % 10) AS loss,
       printf('%d.%d%%', CAST(floor(confidence * 1000.0 + 0.5) AS BIGINT) // 10, CAST(floor(confidence * 1000.0 + 0.5) AS BIGINT) % 10) AS confidence
FROM preds"""
    q["l13_standings"] = P + """
, members AS (SELECT DISTINCT group_name, team FROM (
    SELECT group_name, home_team AS team FROM preds UNION ALL SELECT group_name, away_team FROM preds)),
wins AS (SELECT team, count(*) AS predicted_wins FROM (
    SELECT CASE WHEN predicted_result = 'W' THEN home_team WHEN predicted_result = 'L' THEN away_team END AS team
    FROM preds) WHERE team IS NOT NULL GROUP BY team)
SELECT m.group_name, m.team, coalesce(w.predicted_wins, 0) AS predicted_wins
FROM members m LEFT JOIN wins w ON m.team = w.team
ORDER BY m.group_name, predicted_wins DESC, m.team"""
    q["l14_prediction_summary"] = P + """
SELECT count(*) AS n_predictions, round(avg(confidence), 4) AS mean_confidence,
       max(predicted_at) AS last_run, count_if(predicted_result = 'W') AS n_home_wins,
       count_if(predicted_result = 'D') AS n_draws, count_if(predicted_result = 'L') AS n_away_wins
FROM preds"""
    q["l15_group_lines"] = P + """
SELECT group_name,
       string_agg(substr(home_team, 1, 3) || '-' || substr(away_team, 1, 3) || ': ' || predicted_result,
                  ' | ' ORDER BY match_date, fixture_id) AS results
FROM preds GROUP BY group_name"""
    q["l15_group_line_parts"] = P + """, n AS (
  SELECT group_name, substr(home_team, 1, 3) || '-' || substr(away_team, 1, 3) || ': ' || predicted_result AS t,
         row_number() OVER (PARTITION BY group_name ORDER BY match_date, fixture_id) - 1 AS k FROM preds)
SELECT group_name, k // 4 AS part, string_agg(t, ' | ' ORDER BY k) AS results FROM n GROUP BY 1, 2"""
    q["j09_predictions_with_features"] = P + "SELECT p.*, " + ", ".join(
        f"f.{c}" for c in _FEATURES) + " FROM preds p JOIN ff f ON p.fixture_id = f.fixture_id"
    q["m19_result_text"] = P + """
SELECT fixture_id, home_team, away_team, predicted_result,
       CASE predicted_result WHEN 'W' THEN home_team || ' Wins' WHEN 'L' THEN away_team || ' Wins'
            WHEN 'D' THEN 'Draw' END AS result_text
FROM preds"""
    return q
