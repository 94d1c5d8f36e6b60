"""Peer group statistics and their join back to the members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilo.functions.recode import matches_or_missing
from vigilo.operators.groups import join_groups


def peer_stats(
    cohort: DataFrame,
    group: Sequence[str],
    *,
    read: str = "READ_SS",
    math: str = "MATH_SS",
    incidents: str = "incCount",
    absences: str = "STUDENT_ANNUAL_ABSENCES",
    days: str = "STUDENT_ANNUAL_ENROLLMENT_DAYS",
    race: str = "STUDENT_RACE",
    majority_race: str = "White",
    special: str = "STUDENT_SPECIAL_ED_INDICATOR",
    lunch: str = "STUDENT_FOODSERVICE_ELIG_CODE",
    null_counts_as_match: bool = True,
) -> DataFrame:
    """Measures of each group, the member's own row included.

    With ``null_counts_as_match`` an unknown race, special-education or lunch code counts towards
    its share. One aggregation with partial sums; nothing depends on the size of a group.
    """
    match = matches_or_missing if null_counts_as_match else (lambda c: c)
    size = F.count(F.lit(1))
    attended = F.try_divide(F.col(days) - F.col(absences), F.col(days))
    return cohort.groupBy(*[F.col(c).alias(f"cohort_{c}") for c in group]).agg(
        size.alias("cohort_size"),
        F.avg(read).alias("cohort_mean_read"),
        F.stddev_samp(read).alias("cohort_sd_read"),
        F.avg(math).alias("cohort_mean_math"),
        F.stddev_samp(math).alias("cohort_sd_math"),
        F.count_if(F.col(incidents) > 0).alias("cohort_suspPeers"),
        (F.lit(1.0) - F.try_divide(F.sum(absences), F.sum(days))).alias("cohort_mean_attend"),
        F.stddev_samp(attended).alias("cohort_sd_attend"),
        (F.count_if(match(F.col(special) == "Yes")) / size).alias("cohort_SwDper"),
        (F.count_if(match(F.col(lunch) != "N")) / size).alias("cohort_FRLper"),
        (F.count_if(match(F.col(race) != majority_race)) / size).alias("cohort_nonWhitePer"),
        (F.count_if(F.col(incidents) > 0) / size).alias("cohort_suspPeersPer"),
    )


def peer_enriched(cohort: DataFrame, group: Sequence[str], **measures) -> DataFrame:
    """Every member with the statistics of its group; members without a group form their own.

    The statistics are broadcast when the groups are few, so the members are not shuffled by a
    group key that may be heavily skewed; otherwise both sides meet in a shuffled join.
    """
    stats = peer_stats(cohort, group, **measures)
    for c in group:
        stats = stats.withColumnRenamed(f"cohort_{c}", c)
    return join_groups(cohort, stats, group, "left")
