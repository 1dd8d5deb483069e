import clinical
from cohortlens.functions.sql import register_sql_functions, share_of_total_sql


def test_sql_functions(spark):
    db = clinical.load(spark)
    db["prescriptions"].createOrReplaceTempView("rx_fixture")
    db["demography"].createOrReplaceTempView("demo_fixture")
    register_sql_functions(spark, prescriptions_view="rx_fixture")
    assert spark.sql("SELECT current_age(1970, DATE'2020-06-01') AS a").first()["a"] == 50
    got = {r[0]: r[1] for r in spark.sql("SELECT * FROM unique_patients_per_drug('furo')").collect()}
    assert got == {"Furosemide injection": 2}
    assert spark.sql("SELECT * FROM unique_patients_per_drug('%')").count() == 0  # escaped
    sh = {r["group_value"]: r["pct"] for r in share_of_total_sql(spark, "demo_fixture", "gender").collect()}
    assert sh["Male"] == 44.44


def test_register_views_runs_sql(spark):
    from cohortlens.sources import register_views

    names = register_views(spark, "/root/testdata/sf0.001")
    assert "orders" in names
    n = spark.sql("SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F'").first()["n"]
    assert n > 0


def test_register_views_skips_missing_tables(spark):
    from cohortlens.sources import register_views

    assert register_views(spark, "/root/testdata/sf0.001", ("orders", "no_such_table")) == ["orders"]
