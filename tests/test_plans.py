"""Plan checks: no forced broadcast, scan pushdown and pruning, no row-at-a-time Python."""

from visitwise.plans import registry as R

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_forced_broadcast_of_the_calendar(spark):
    """The calendar's join is the planner's choice: with its threshold off,
    nothing is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in _plan(R.QUERIES["j01_due_list"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_year_filter_reaches_scan(spark):
    df = R.QUERIES["f04_year"](spark, SF)
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    # column pruning: only the columns the visit preparation needs
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p


def test_no_row_at_a_time_python(spark):
    for name in ("q09_unified", "c19_clean_text", "j03_unified_full"):
        p = _plan(R.QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in p


def test_clean_text_stays_in_jvm(spark):
    p = _plan(R.QUERIES["c19_clean_text"](spark, SF))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


def test_client_filters_reach_scan(spark):
    p = _plan(R.QUERIES["j01_due_list"](spark, SF))
    # (the plan text truncates long filter lists)
    assert "PushedFilters: [IsNotNull(c_acctbal), In(c" in p
    assert "c_mktsegment" in p and "(c_acctbal" in p
