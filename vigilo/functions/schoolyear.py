"""School-year arithmetic on strings such as ``2009-2010``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilo.functions import fixed


def school_year(start: Column) -> Column:
    """``YYYY-YYYY`` from the year in which it starts."""
    return F.concat(start.cast("string"), F.lit("-"), (start + 1).cast("string"))


def start_year(year: Column) -> Column:
    return F.substring(year, 1, 4).cast("int")


def short_year(year: Column) -> Column:
    """``YYYY-YYYY`` to ``YYYY-YY``."""
    return F.concat(F.substring(year, 1, 4), F.lit("-"), F.substring(year, 8, 2))


def expected_grad_start(year: Column, grade: Column) -> Column:
    """First year of the school year in which a cohort reaches grade 12."""
    return start_year(year) + (F.lit(12) - grade.cast("int"))


def expected_grad(year: Column, grade: Column) -> Column:
    return school_year(expected_grad_start(year, grade))


def has_known_outcome(
    year: Column, grade: Column, last_known: int = fixed.LAST_KNOWN_YEAR
) -> Column:
    """True for cohorts whose expected graduation is not after ``last_known``.

    Grades above 8 follow grade 8; below grade 5 no cohort qualifies.
    """
    counted = F.least(grade.cast("int"), F.lit(fixed.TOP_GRADE))
    return (grade.cast("int") >= fixed.LOWEST_GRADE) & (
        expected_grad_start(year, counted) <= F.lit(last_known)
    )
