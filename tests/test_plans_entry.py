"""Plan shape and the driver contract."""

from match_cases import SF001
from matchlab.config import NOTEBOOK
from matchlab.operators.perspective import team_view
from matchlab.operators.rolling import rolling_features
from matchlab.sources import adapter


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_team_view_one_scan_generate(spark):
    m = adapter.matches(spark, SF001)
    p = _plan(team_view(m))
    assert "Generate" in p and "Union" not in p
    assert p.count("Scan parquet") == 3        # orders, customer, nation: once each


def test_plain_window_shares_one_exchange(spark):
    tv = team_view(adapter.matches(spark, SF001))
    p = _plan(rolling_features(tv, NOTEBOOK.with_(strategy="window")))
    assert p.count("Exchange hashpartitioning(team") == 1


def test_no_python_udf_in_flagship(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    p = _plan(df)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_contract_keys_match(spark):
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


def test_rows_are_windowed_by_range(spark):
    tv = team_view(adapter.matches(spark, SF001))
    df = rolling_features(tv, NOTEBOOK)
    df.write.format("noop").mode("overwrite").save()
    p = _plan(df)
    # row-level data is clustered by (team, range); only the table with a row
    # for each range is clustered by team
    import re
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", p)
    assert any("_range" in k for k in keys) and p.count("Window") >= 3


def test_single_scans(spark):
    """Queries that need their input once read it once."""
    import __spark_entry__ as E
    q = E.queries()
    for name in ("q04_distinct_teams", "q08_forbidden_names"):
        assert _plan(q[name](spark, SF001)).count("/orders.parquet") == 1, name
