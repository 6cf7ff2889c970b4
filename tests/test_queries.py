"""Every query against its SQL in another engine, and the shape of the plans."""

import re

import duckdb
import pytest

from carelens.checks.compare import differences, open_duckdb
from carelens.checks.oracle import all_oracles
from carelens.checks.queries import REPORT_PARAMS, SITE, all_queries
from carelens.functions.scalars import code_of_sql, moment_first_sql, moment_of_sql, moments_sql, second_moment_of_sql
from carelens.operators import attach as A
from carelens.operators import differentiated as D
from carelens.operators import status as S
from carelens.plans.reports import REPORTS
from carelens.sources.star import clinical_from_star
from carelens.sources.tables import load_tables, store_tables
from conftest import SMALL

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []


def test_the_comparison_sees_a_difference(spark, con):
    df = QUERIES["first_cd4"](spark, SMALL)
    assert differences(df.limit(df.count() - 1), con, ORACLES["first_cd4"])
    assert differences(df.union(df.limit(1)), con, ORACLES["first_cd4"])
    assert differences(df.withColumnRenamed("cd4", "x"), con, ORACLES["first_cd4"])
    assert differences(df.selectExpr("patient_id", "data_cd4", "cd4 + 1 cd4"), con, ORACLES["first_cd4"])


def _star(tmp_path_factory, every):
    """The small star where every so many-th order belongs to one customer."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in "customer orders lineitem nation supplier".split():
        source = f"'{SMALL}/{name}.parquet'"
        rows = f"select * from {source}"
        if name == "orders":
            rows = f"select * replace (case when o_orderkey % {every} = 0 then 23 else o_custkey end as o_custkey) from {source}"
        con.execute(f"copy ({rows}) to '{folder}/{name}.parquet' (format parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    return _star(tmp_path_factory, 3)


@pytest.fixture(scope="module")
def busy(tmp_path_factory):
    """One patient has a twenty-fifth of all visits, and 380,160 combinations of openings
    and attachments (with a third of them the answer would be too large to compare)."""
    return _star(tmp_path_factory, 25)


@pytest.mark.parametrize("name", ["vl_suppressed", "three_pickups", "vl_eligible_general", "dsd_followup", "tpt_eligible"])
def test_reports_with_a_hot_patient(spark, skewed, name):
    """Equal rows when a third of all visits is one patient's, and the hot keys
    are cut into small pieces where the report does so."""
    t = clinical_from_star(spark, skewed)
    spread = {"hot_rows": 5} if name in ("vl_suppressed", "three_pickups") else {}
    df = REPORTS[name](t, REPORT_PARAMS.get(name, SITE), **spread)
    assert differences(df, open_duckdb(skewed), ORACLES[name]) == []


@pytest.mark.parametrize("name", ["entered_master_card", "entered_full"])
def test_opened_files_in_small_pieces(spark, con, name):
    df = REPORTS[name](clinical_from_star(spark, SMALL), SITE, hot_rows=1)
    assert differences(df, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["entered_master_card", "entered_full"])
def test_opened_files_of_a_hot_patient_in_tiles(spark, busy, name):
    df = REPORTS[name](clinical_from_star(spark, busy), SITE, tile_rows=16, hot_rows=5)
    assert differences(df, open_duckdb(busy), ORACLES[name]) == []


def test_registers_of_a_hot_patient_in_tiles(spark, skewed):
    df = A.register_book(clinical_from_star(spark, skewed), SITE, tile_rows=1)
    assert differences(df, open_duckdb(skewed), ORACLES["register_book"]) == []


def test_a_register_entry_with_many_answers(spark, clinic, june):
    """One entry with 40 books' answers (two texts), 30 pages and 20 rows: the counts of
    all combinations, in tiles of 4."""
    clinic.patient(1).add("location", location_id=1, name="a").visit(10, 1, 32, "2020-01-05")
    for i in range(40):
        clinic.answer(10, 6263, value_coded=1 + i % 2)
    for i in range(30):
        clinic.answer(10, 6265, value_numeric=float(i % 15))
    for i in range(20):
        clinic.answer(10, 6267, value_numeric=float(i))
    t = clinic.tables(spark)
    whole, tiled = (A.pre_register(t, june, tile_rows=n) for n in (1024, 4))
    assert tiled.count() >= 15 * 20 and tiled.agg({"n": "sum"}).first()[0] == 40 * 30 * 20
    assert whole.exceptAll(tiled).count() == 0 and tiled.exceptAll(whole).count() == 0


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("clinical"))
    store_tables(clinical_from_star(spark, SMALL), folder)
    return load_tables(spark, folder)


def test_stored_tables_read_back(spark, stored):
    for name, df in clinical_from_star(spark, SMALL).named().items():
        again = getattr(stored, name)
        assert again.dtypes == df.dtypes
        assert again.count() == df.count()
        assert again.exceptAll(df).count() == 0


@pytest.mark.parametrize("name", list(REPORTS))
def test_plans(spark, stored, name):
    """At any size: no cross join, no Python, only the hot-key lists broadcast,
    filters and folders at the scan."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = REPORTS[name](stored, REPORT_PARAMS.get(name, SITE))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "collect_set", "collect_list"):
        assert bad not in plan
    broadcasts = plan.count("BroadcastExchange")
    assert broadcasts == len(re.findall(r"BroadcastExchange.*\n(?:.*\n)??.*_pieces", plan))
    for line in plan.splitlines():
        if "FileScan" in line and "value_" in line:
            assert "voided" in line
    assert plan.count("Window ") == plan.count("WindowGroupLimit") // 2


def test_first_rows_are_found_by_hashing(spark, stored):
    for df in (A.first_identifier(stored, "nid"), A.first_name(stored, "nome"), A.smallest_referral(stored, SITE),
               A.regimens_by_moment(stored, SITE)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_found_by_hashing(spark, stored):
    for df in (S.latest_exit(stored, SITE), D.dsd_model_enrolment(stored, SITE), D.first_enrolment_with_diagnosis(stored, SITE)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_packed_pairs_sort_like_structs(spark):
    moments = ["0001-01-01 00:00:00", "1582-10-10 01:02:03", "1899-12-31 23:59:59.999999", "1969-12-31 23:59:59.999999",
               "1970-01-01 00:00:00", "2020-03-29 02:30:00", "2020-06-20 12:00:00.000001", "9999-12-31 23:59:59.999999"]
    firsts = spark.createDataFrame([(m,) for m in moments], "a string").selectExpr("cast(a as timestamp_ntz) a")
    rows = firsts.join(spark.sql("select * from values (0), (1), (23730), (2147483647) v(code)"))
    packed = rows.selectExpr("a", "code", f"{moment_first_sql('a', 'code')} x")
    got = packed.selectExpr("a", "code", "x", f"{moment_of_sql('x')} a2", f"{code_of_sql('x')} code2").collect()
    assert all(r["a"] == r["a2"] and r["code"] == r["code2"] for r in got) and len(got) == 32
    assert sorted(got, key=lambda r: r["x"]) == sorted(got, key=lambda r: (r["a"], r["code"]))
    seconds = firsts.withColumnRenamed("a", "b").unionByName(spark.sql("select cast(null as timestamp_ntz) b"))
    pairs = firsts.join(seconds).selectExpr("a", "b", f"{moments_sql('a', 'b')} x")
    got = pairs.selectExpr("a", "b", "x", f"{moment_of_sql('x')} a2", f"{second_moment_of_sql('x')} b2").collect()
    assert all(r["a"] == r["a2"] and r["b"] == r["b2"] for r in got) and len(got) == 72
    first = lambda r: (r["a"], r["b"] is not None, r["b"] or r["a"])
    assert sorted(got, key=lambda r: r["x"]) == sorted(got, key=first)


def test_moments_are_read_once(spark, stored):
    df = D.pickup_moments(stored, SITE)
    assert df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


def test_reports_have_one_row_per_patient_where_promised(spark, stored):
    for name in ("vl_eligible_general", "vl_eligible_pregnant", "vl_failure", "three_pickups"):
        df = REPORTS[name](stored, REPORT_PARAMS.get(name, SITE))
        assert df.count() == df.select("patient_id").distinct().count()


def test_site_reports_need_a_site(spark, stored):
    from dataclasses import replace

    with pytest.raises(ValueError):
        REPORTS["vl_failure"](stored, replace(SITE, location=None))
