"""Risk scores to labelled categories, and the layout of the risk export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.functions import fixed, recode
from vigilo.operators.evaluate import ecdf_rank
from vigilo.operators.groups import join_groups, table_stats, with_group_stats
from vigilo.operators.ordering import median_exceeds, row_numbers
from vigilo.sources.tables import stage


def risk_interval(df: DataFrame, pred: str, se: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Score, its error and an interval inside [0, 1].

    The squared error is used where the median error is large. The interval is taken around the
    score before the score is capped.
    """
    wide = with_group_stats(df, by, {"__big": median_exceeds(F.col(se), fixed.ERROR_SWITCH)})
    error = F.when(F.col("__big"), F.col(se) * F.col(se)).otherwise(F.col(se))
    score = F.col(pred)
    capped = lambda c: F.when(c > 1, F.lit(1.0)).otherwise(c)
    low = score - error
    return wide.withColumns(
        {
            "yhat": capped(score),
            "yhatError": error,
            "flag_low": F.when(low < 0, F.lit(0.0)).otherwise(low),
            "flag_high": capped(score + error),
        }
    ).drop("__big")


def risk_flag(df: DataFrame, threshold: Column, *, name: str = "flag") -> DataFrame:
    """High, Moderate or Low by where the interval lies relative to the threshold."""
    low, high, score = F.col("flag_low"), F.col("flag_high"), F.col("yhat")
    label = (
        F.when(score.isNull(), "Missing")
        .when(high <= threshold, "Low")
        .when((high >= threshold) & (low <= threshold), "Moderate")
        .when((score != 0) & (low >= threshold), "High")
        .otherwise("None")
    )
    return df.withColumn(name, label)


def assessment_band(
    df: DataFrame, *, flag: str = "flag", math: str = "MATH_SS", read: str = "READ_SS",
    z: float = fixed.Z_75, name: str = "assessments", by: Sequence[str] = (),
) -> DataFrame:
    """Test total against the interval of the mean total of the group's Moderate rows."""
    total = F.col(math) + F.col(read)
    moderate = F.when(F.col(flag) == "Moderate", total)
    half = F.lit(z) * F.stddev_samp(moderate) / F.sqrt(F.count(moderate))
    wide = with_group_stats(df, by, {"__lower": F.avg(moderate) - half, "__upper": F.avg(moderate) + half})
    label = (
        F.when(F.col(math).isNull() | F.col(read).isNull(), "Missing")
        .when(total < F.col("__lower"), "High")
        .when(total <= F.col("__upper"), "Moderate")
        .when(total > F.col("__upper"), "Low")
    )
    return wide.withColumn(name, label).drop("__lower", "__upper")


def days_missed(rate: Column) -> Column:
    """School days missed in a year at an attendance rate, to one decimal."""
    days = F.lit(float(fixed.SCHOOL_DAYS)) - F.bround(F.lit(float(fixed.SCHOOL_DAYS)) * rate, 1)
    return F.bround(F.when(days < 0, F.lit(0.0)).otherwise(days), 1)


def attendance_band(df: DataFrame, *, rate: str = "ATT_RATE", name: str = "attendance") -> DataFrame:
    days = df.withColumn("daysmissed", days_missed(F.col(rate)))
    label = recode.band(F.col("daysmissed"), fixed.DAYS_MISSED_CUTS, ("Low", "Moderate", "High"), closed="right")
    return days.withColumn(name, F.coalesce(label, F.lit("Missing")))


def mobility_band(
    df: DataFrame, *, schools: str = "SCHOOL_COUNT", enrolments: str = "ENROLLMENTS_COUNT",
    given: str | None = None, name: str = "mobility",
) -> DataFrame:
    """Moderate from two schools and enrolments, High from three; or Moderate by a given flag."""
    if given is not None:
        moved = F.coalesce(F.col(given) == "Yes", F.lit(False))
        return df.withColumn(name, F.when(moved, "Moderate").otherwise("Low")).drop(given)
    s, e = F.col(schools), F.col(enrolments)
    return df.withColumn(
        name, F.when((s >= 3) & (e >= 3), "High").when((s >= 2) & (e >= 2), "Moderate").otherwise("Low")
    )


def discipline_band(
    df: DataFrame, *, count: str = "incCount", days: str = "daysRemoved", name: str = "discipline",
    by: Sequence[str] = (),
) -> DataFrame:
    """Moderate above the group's smallest count or days, High above its second smallest count."""
    by = list(by)
    if by:
        # Distinct counts of a group; its second smallest is the least one above the least.
        seen = df.groupBy(*by, F.col(count).alias("__c")).agg(F.min(days).alias("__d"))
        low = seen.groupBy(*by).agg(F.min("__c").alias("__count"), F.min("__d").alias("__days"))
        above = join_groups(seen, low, by).where(F.col("__c") > F.col("__count")).groupBy(*by).agg(F.min("__c").alias("__second"))
        wide = join_groups(df, stage(join_groups(low, above, by, "left"), "groups"), by, "left")
    else:
        low = table_stats(df, {"__count": F.min(count), "__days": F.min(days)})
        wide = df.withColumns(low | table_stats(df.where(F.col(count) > low["__count"]), {"__second": F.min(count)}))
    more = (F.col(count) > F.col("__count")) | (F.col(days) > F.col("__days"))
    return wide.withColumn(
        name, F.when(F.col(count) > F.col("__second"), "High").when(more, "Moderate").otherwise("Low")
    ).drop("__count", "__days", "__second")


def risk_bands(
    df: DataFrame, threshold: Column, *, pred: str = "pred", se: str = "se", by: Sequence[str] = ()
) -> DataFrame:
    """All categories and percentile ranks of scored cohorts, each ``by`` group on its own."""
    out = risk_flag(risk_interval(df, pred, se, by=by), threshold)
    out = assessment_band(out, by=by)
    out = attendance_band(out)
    out = mobility_band(out, given="mobility_flag" if "mobility_flag" in out.columns else None)
    # The ranks' counts read the bands' columns again, and one generated method for bands and ranks would be too long to be compiled.
    out = stage(discipline_band(out, by=by), "bands")
    return ecdf_rank(out, {"MATH_SS": "mathrank", "READ_SS": "readrank", "ATT_RATE": "attrank"}, by=by)


def risk_export(
    df: DataFrame, *, grade: Column, year: Column, prelim: bool = False, run_time: Column | None = None,
) -> DataFrame:
    """The export record of a banded cohort, numbered by student within grade and year."""
    kind = "Preliminary" if prelim else "Final"
    blank = F.lit(None).cast("double")
    counted = blank if prelim else recode.unshifted(F.col("incCount"), fixed.COUNT_OFFSET)
    values = {
        "WSN": F.col("WSN"),
        "STUDENT_KEY": F.col("STUDENT_KEY"),
        "DATE": run_time if run_time is not None else F.current_timestamp(),
        "MODEL": F.lit("Full"),
        "MODEL_DATA": F.lit(kind),
        "MODEL_NAME": F.concat(F.lit("Grade "), grade.cast("string"), F.lit(f" {kind}")),
        "STUDENT_RISK_SEVERITY_SCORE": F.col("yhat"),
        "STUDENT_RISK_SEVERITY_PRECISION": F.col("yhatError"),
        "STUDENT_RISK_OUTCOME": F.col("flag"),
        "STUDENT_RISK_MEASURE_VALUE_Att": F.col("daysmissed"),
        "STUDENT_RISK_MEASURE_VALUE_Att2": F.col("attrank"),
        "STUDENT_RISK_MEASURE_VALUE_Att3": F.col("ATT_RATE") * 100,
        "STUDENT_RISK_MEASURE_VALUE_Att4": F.col("DAYS_POSS"),
        "STUDENT_RISK_REPORT_TEXTAtt": F.col("attendance"),
        "STUDENT_RISK_MEASURE_VALUE_Assess1": F.col("READ_SS"),
        "STUDENT_RISK_MEASURE_VALUE_Assess2": F.col("MATH_SS"),
        "STUDENT_RISK_MEASURE_VALUE_Assess3": F.col("mathrank"),
        "STUDENT_RISK_MEASURE_VALUE_Assess4": F.col("readrank"),
        "STUDENT_RISK_REPORT_TEXTAssess": F.col("assessments"),
        "STUDENT_RISK_MEASURE_VALUE_Disc": recode.unshifted(F.col("daysRemoved"), fixed.DAYS_OFFSET),
        "STUDENT_RISK_MEASURE_VALUE_Disc2": counted,
        "STUDENT_RISK_MEASURE_VALUE_Disc3": blank,
        "STUDENT_RISK_REPORT_TEXTDisc": F.col("discipline"),
        "STUDENT_RISK_MEASURE_VALUE_Mob": F.col("ENROLLMENTS_COUNT"),
        "STUDENT_RISK_MEASURE_VALUE_Mob2": F.col("SCHOOL_COUNT"),
        "STUDENT_RISK_REPORT_TEXTMob": F.col("mobility"),
        "GRADE_LEVEL": grade,
        "SCHOOL_YEAR": year,
    }
    rows = df.select(*[c.alias(n) for n, c in values.items()])
    return row_numbers(rows, "STUDENT_KEY", "X", by=["GRADE_LEVEL", "SCHOOL_YEAR"]).select(*fixed.EXPORT_COLUMNS)


def risk_lifecycle(
    records: DataFrame, key: str, *, year: str, run_date: Column, days: int = fixed.RISK_LIFETIME_DAYS,
) -> DataFrame:
    """Expiry date and status: a student's newest year is Active, all earlier ones Inactive."""
    newest = records.groupBy(F.col(key).alias("__k")).agg(F.max(year).alias("__newest"))
    joined = records.join(newest, F.col(key) == F.col("__k"), "left")
    return joined.select(
        *records.columns,
        F.date_add(run_date, days).alias("expires"),
        F.when(F.col(year) == F.col("__newest"), "Active").otherwise("Inactive").alias("status"),
    )
