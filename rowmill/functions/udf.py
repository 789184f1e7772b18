"""Named functions of the library, as Column functions and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# Salary grades, highest first, and plan limits.
SALARY_GRADES = ((100000, "Senior"), (75000, "Mid"), (50000, "Junior"))
LOWEST_GRADE = "Entry"
PLAN_LIMITS = {
    "max_users": {"free": 5, "starter": 25, "pro": 100, "enterprise": 999999},
    "max_projects": {"free": 3, "starter": 20, "pro": 100, "enterprise": 999999},
}


def salary_grade(salary: Column) -> Column:
    out = F.when(salary >= SALARY_GRADES[0][0], SALARY_GRADES[0][1])
    for bound, grade in SALARY_GRADES[1:]:
        out = out.when(salary >= bound, grade)
    return out.otherwise(LOWEST_GRADE)


def days_employed(hired: Column, as_of: Column) -> Column:
    return F.datediff(as_of, hired)


def plan_limit(plan: Column, resource: Column) -> Column:
    """Limit of a plan: 0 for an unknown resource, NULL for an unknown plan."""
    known = F.create_map(*[F.lit(x) for r, plans in PLAN_LIMITS.items() for p, n in plans.items() for x in (f"{r}/{p}", n)])
    return F.when(resource.isin(*PLAN_LIMITS), F.try_element_at(known, F.concat_ws("/", resource, plan))).otherwise(0)


def register_sql_functions(spark: SparkSession) -> None:
    """Make salary_grade usable in SQL text; Catalyst inlines it like any expression."""
    cases = " ".join(f"WHEN salary >= {bound} THEN '{grade}'" for bound, grade in SALARY_GRADES)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION salary_grade(salary DOUBLE) RETURNS STRING "
              f"RETURN CASE {cases} ELSE '{LOWEST_GRADE}' END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION days_employed(hired DATE, as_of DATE) RETURNS INT "
              "RETURN datediff(as_of, hired)")
