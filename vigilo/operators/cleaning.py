"""Recoding of the pooled cohorts, complete cases and the training target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.functions import fixed, recode


def clean_pool(
    pool: DataFrame, *, drop: Sequence[str] = ("duplicated", "HOLD", "STUDENT_ANNUAL_ATTRIBS_KEY")
) -> DataFrame:
    """Warehouse codes to model features; only columns that are present are touched.

    Counts and days become shifted logarithms, incident types become flags that stay missing
    where the type is missing. ``drop`` names columns that scoring cannot know, and surplus ones
    such as the school and district that came with the test scores.
    """
    made: dict[str, tuple[str | tuple[str, ...], Column]] = {
        "ESL_LEV": (
            "STUDENT_ESL_CLASSIFICATION",
            recode.band(F.col("STUDENT_ESL_CLASSIFICATION"), fixed.LANGUAGE_CUTS, fixed.LANGUAGE_LABELS),
        ),
        "FRL": (
            "STUDENT_FOODSERVICE_ELIG_CODE",
            recode.flag(F.col("STUDENT_FOODSERVICE_ELIG_CODE"), {"N": "N"}, "Y"),
        ),
        "EVER_RETAINED": (
            "STUDENT_REPEATER_INDICATOR",
            recode.flag(F.col("STUDENT_REPEATER_INDICATOR"), {"Yes": "Y", "@NR": "Unk"}, "N"),
        ),
        "GENDER": ("STUDENT_GENDER_CODE", recode.flag(F.col("STUDENT_GENDER_CODE"), {"F": "F"}, "M")),
        "SWD": (
            "STUDENT_SPECIAL_ED_INDICATOR",
            recode.flag(F.col("STUDENT_SPECIAL_ED_INDICATOR"), {"Yes": "Yes"}, "No"),
        ),
        "LEP": ("STUDENT_LEP_INDICATOR", recode.flag(F.col("STUDENT_LEP_INDICATOR"), {"Yes": "Yes"}, "No")),
        "ATT_RATE": (
            ("STUDENT_ANNUAL_ABSENCES", "STUDENT_ANNUAL_ENROLLMENT_DAYS"),
            recode.attendance_rate(F.col("STUDENT_ANNUAL_ABSENCES"), F.col("STUDENT_ANNUAL_ENROLLMENT_DAYS")),
        ),
        "DAYS_POSS": ("STUDENT_ANNUAL_ENROLLMENT_DAYS", F.col("STUDENT_ANNUAL_ENROLLMENT_DAYS")),
        "DISTRICT_KEY": ("DISTRICT_CODE", F.col("DISTRICT_CODE")),
        "GRADE_KEY": ("STUDENT_ANNUAL_GRADE_CODE", F.col("STUDENT_ANNUAL_GRADE_CODE")),
    }
    for word, col in recode.contains_flags(F.col("incType"), fixed.INCIDENT_FLAGS).items():
        made[word] = ("incType", col)
    dropped = set(drop)
    new: dict[str, Column] = {}
    for name, (inputs, col) in made.items():
        needed = {inputs} if isinstance(inputs, str) else set(inputs)
        if needed <= set(pool.columns):
            new[name] = col
            dropped |= needed
    for name, offset in (("daysRemoved", fixed.DAYS_OFFSET), ("incCount", fixed.COUNT_OFFSET)):
        if name in pool.columns:
            new[name] = recode.shifted_log(F.col(name), offset)
    return pool.withColumns(new).drop(*dropped)


def complete_cases(df: DataFrame) -> DataFrame:
    """Rows without any missing value; NaN is missing as well."""
    return df.where(_complete(df))


def _complete(df: DataFrame) -> Column:
    whole = F.lit(True)
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        whole = whole & value.isNotNull()
        if f.dataType.typeName() in ("float", "double"):
            whole = whole & ~F.isnan(value)
    return whole


def complete_case_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many rows there are and how many are complete, in one pass."""
    whole = _complete(df)
    return df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(whole).alias("complete")
    )


def binary_outcome(df: DataFrame, outcome: str = "grad_ind", target: str = "ontime_grad") -> DataFrame:
    """Drop unknown outcomes; 1 for on-time graduates, 0 for all others."""
    known = df.where(F.col(outcome) != fixed.UNKNOWN_EXIT)
    return known.withColumn(target, (F.col(outcome) == fixed.ON_TIME).cast("int"))


def prelim_fill(
    df: DataFrame,
    *,
    estimates: dict[str, str],
    carried: dict[str, str] | None = None,
    history: DataFrame | None = None,
    key: list[str] | None = None,
    year: str | None = None,
) -> DataFrame:
    """Preliminary scoring frame: estimates replace measures that are not final yet.

    ``estimates`` maps a measure to the column with its estimate; the observed value is kept as
    ``<measure>.ACT``. ``carried`` maps a measure to the column of ``history`` whose value of the
    year before is used. Rows that still lack an estimate leave.
    """
    out = df
    if carried:
        before = history.select(
            *key,
            (F.col(year) + 1).alias(year),
            *[F.col(source).alias(f"__c_{name}") for name, source in carried.items()],
        )
        out = out.join(before, [*key, year], "left")
    made = {f"{m}.ACT": F.col(m) for m in estimates}
    made |= {m: F.col(e) for m, e in estimates.items()}
    made |= {name: F.col(f"__c_{name}") for name in (carried or {})}
    out = out.withColumns(made).drop(*[f"__c_{n}" for n in (carried or {})], *estimates.values())
    return out.dropna("any", subset=list(estimates))
