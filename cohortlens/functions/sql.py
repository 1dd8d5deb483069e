"""SQL-surface versions of the reference's functions (X1-X3) for users who
work in ``spark.sql``.  They are SQL functions (no Python), so Catalyst
inlines them like any expression or subquery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_sql_functions(spark: SparkSession, *, prescriptions_view: str | None = None) -> None:
    """Register:

    * ``current_age(birth_year INT, as_of DATE) -> INT`` (X1);
    * ``unique_patients_per_drug(prefix STRING)`` table function (X2) over
      ``prescriptions_view`` (columns ``inpatient_number``, ``drug_name``),
      when a view name is given.  The prefix is matched with ILIKE after
      escaping ``%`` and ``_``.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION current_age(birth_year INT, as_of DATE) "
        "RETURNS INT RETURN year(as_of) - birth_year"
    )
    if prescriptions_view:
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION unique_patients_per_drug(prefix STRING) "
            "RETURNS TABLE (drug_name STRING, n_patients BIGINT) RETURN "
            f"SELECT drug_name, COUNT(DISTINCT inpatient_number) FROM {prescriptions_view} "
            "WHERE drug_name ILIKE replace(replace(replace(prefix, '\\\\', '\\\\\\\\'), '%', '\\\\%'), '_', '\\\\_') || '%' "
            "GROUP BY drug_name"
        )


def share_of_total_sql(spark: SparkSession, view: str, column: str) -> DataFrame:
    """X3 with a column chosen at run time, as SQL: ``IDENTIFIER(:c)`` binds
    the name as an identifier (no string splicing of user input)."""
    return spark.sql(
        "SELECT IDENTIFIER(:c) AS group_value, COUNT(*) AS n, "
        "ROUND(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS pct "
        "FROM IDENTIFIER(:v) GROUP BY IDENTIFIER(:c)",
        args={"c": column, "v": view},
    )
