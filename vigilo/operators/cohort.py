"""Building cohorts: members, attributes, tests, incidents, mobility and outcomes.

A cohort is a set of rows with the same cohort columns (for example school year and grade); every
operator handles any number of cohorts in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilo.functions import fixed
from vigilo.functions.recode import recode_map
from vigilo.operators.ordering import repeat_rows


def cohort_members(fact: DataFrame, members: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Fact rows whose key belongs to the cohort."""
    return fact.join(_keys(members, key), key, "left_semi")


def without_keys(fact: DataFrame, keys: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Fact rows whose key is not among ``keys``."""
    return fact.join(_keys(keys, key), key, "left_anti")


def _keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Each key once, combined before the shuffle, so that a frequent key is one row."""
    return df.select(*([key] if isinstance(key, str) else key)).distinct()


def demographics(annual: DataFrame, person: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Yearly attributes with the person attributes they refer to."""
    return annual.join(person, key)


def role_dates(
    fact: DataFrame, dates: DataFrame, *, date_key: str, date_value: str, roles: Mapping[str, str]
) -> DataFrame:
    """Resolve several date keys of one fact; ``roles`` maps a key column to an output column.

    A calendar is small and then broadcast; one beyond the size check joins by shuffle.
    """
    out, calendar = fact, dates.select(date_key, date_value)
    for column, name in roles.items():
        role = calendar.select(F.col(date_key).alias(column), F.col(date_value).alias(name))
        out = out.join(role, column)
    return out


def subject_wide(
    scores: DataFrame,
    key: Sequence[str],
    *,
    subject: str,
    subjects: Mapping[str, str],
    measures: Sequence[str],
    combine: str | None = None,
) -> DataFrame:
    """One row per key with every measure of every subject as ``<prefix>_<measure>``.

    ``subjects`` maps a subject value to its prefix. Without ``combine`` repeated (key, subject)
    rows multiply, as in a join of the subjects; with ``combine`` (``avg``, ``max``, ``min``)
    the table is read once and aggregated before anything is shuffled. Keys that lack a subject
    leave in both forms.
    """
    key = list(key)
    if combine is None:
        parts = [
            scores.where(F.col(subject) == value).select(
                *key, *[F.col(m).alias(f"{prefix}_{m}") for m in measures]
            )
            for value, prefix in subjects.items()
        ]
        return reduce(lambda a, b: a.join(b, key), parts)
    fold = getattr(F, combine)
    kept = scores.where(F.col(subject).isin(*subjects))
    wide = kept.groupBy(*key).agg(
        *[
            fold(F.when(F.col(subject) == value, F.col(m))).alias(f"{prefix}_{m}")
            for value, prefix in subjects.items()
            for m in measures
        ],
        *[F.count_if(F.col(subject) == value).alias(f"__n_{p}") for value, p in subjects.items()],
    )
    complete = reduce(lambda a, b: a & b, [F.col(f"__n_{p}") > 0 for p in subjects.values()])
    return wide.where(complete).drop(*[f"__n_{p}" for p in subjects.values()])


def mobility_counts(
    enrolments: DataFrame, key: Sequence[str], *, district: str, school: str
) -> DataFrame:
    """Distinct districts, distinct schools and enrolments per key.

    Enrolments are counted once per district and once per school of a key, in one pass and combined before
    they are shuffled by key and place; each key then adds up its places.
    """
    places = enrolments.select(*key, F.col(district).alias("__d"), F.col(school).alias("__s"))
    per_place = places.groupingSets([[*key, "__d"], [*key, "__s"]], *key, "__d", "__s").agg(
        (F.grouping("__s") == 1).alias("__district"), F.count(F.lit(1)).alias("__n"))
    return per_place.groupBy(*key).agg(
        F.count(F.when(F.col("__district"), F.col("__d"))).alias("DISTRICT_COUNT"),
        F.count(F.when(~F.col("__district"), F.col("__s"))).alias("SCHOOL_COUNT"),
        F.sum(F.when(F.col("__district"), F.col("__n"))).alias("ENROLLMENTS_COUNT"),
    )


def incident_removals(incidents: DataFrame, removals: DataFrame, incident_key: str) -> DataFrame:
    """Removals with the incident they belong to."""
    return incidents.join(removals, incident_key)


def incident_summary(
    removals: DataFrame,
    key: Sequence[str],
    *,
    type_col: str,
    days: str,
    removal: str,
    groups: Mapping[str, str] = fixed.INCIDENT_GROUPS,
    excluded: Sequence[str] = fixed.EXCLUDED_REMOVALS,
    missing_days_poison: bool = False,
) -> DataFrame:
    """Removals per key: how many, of which types, for how many days, of which severity.

    Rows with an excluded or unknown removal type leave. Types are listed in sorted order. One
    missing number of days makes the sum missing if ``missing_days_poison``.
    """
    key = list(key)
    kept = removals.where(~F.col(removal).isin(*excluded))
    per_type = kept.groupBy(*key, recode_map(F.col(type_col), groups).alias("__type")).agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(days).alias("__days"),
        F.count_if(F.col(days).isNull()).alias("__gaps"),
        F.bool_or(F.col(removal) == "EX").alias("__ex"),
    )
    total = F.sum("__days")
    if missing_days_poison:
        total = F.when(F.sum("__gaps") > 0, None).otherwise(total)
    names = F.collect_list(F.coalesce("__type", F.lit("NA")))
    return per_type.groupBy(*key).agg(
        F.sum("__n").alias("incCount"),
        F.array_join(F.array_sort(names), "-").alias("incType"),
        total.alias("daysRemoved"),
        F.when(F.bool_or("__ex"), "EX").otherwise("OS").alias("removalType"),
    )


def crosswalk(
    keymap: DataFrame,
    xref: DataFrame,
    persons: DataFrame,
    *,
    shared_id: str,
    key: str,
    local_id: str,
    status: str,
    current: Column | None = None,
    deleted: str = "Deleted",
    deleted_key: int = -2,
    seen: DataFrame | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Local id -> warehouse key by way of a shared id; deleted persons get a fixed key.

    ``current`` keeps current references only, ``seen`` restricts to local ids of a fact. Without
    both and with ``distinct=False`` this is the plain lookup table.
    """
    refs = xref.where(current) if current is not None else xref
    if seen is not None:
        if distinct:
            refs = refs.join(_keys(seen, local_id), local_id, "left_semi")
        else:
            refs = refs.join(seen.select(local_id), local_id)
    out = (
        keymap.join(refs, shared_id)
        .join(persons, key)
        .select(
            local_id,
            F.when(F.col(status) == deleted, F.lit(deleted_key)).otherwise(F.col(key)).alias(key),
            shared_id,
        )
    )
    return out.distinct() if distinct else out


def latest_rows(fact: DataFrame, key: Sequence[str], date: str, *, flag: str = "maxObsFlag") -> DataFrame:
    """Mark each key's rows with the latest date; a missing date counts as latest, ties all count.

    Missing keys are one key. The maximum is combined before the shuffle and joined back, so one dominant key is split by
    the adaptive join instead of filling one window partition.
    """
    key = list(key)
    last = fact.groupBy(*key).agg(
        F.bool_or(F.col(date).isNull()).alias("__gap"), F.max(date).alias("__last")
    ).select(*[F.col(c).alias(f"__k_{c}") for c in key], "__gap", "__last")
    cond = reduce(lambda a, b: a & b, [fact[c].eqNullSafe(last[f"__k_{c}"]) for c in key])
    latest = F.when(F.col("__gap"), F.col(date).isNull()).otherwise(F.col(date) == F.col("__last"))
    return fact.join(last, cond, "left").select(
        *fact.columns, F.when(latest, "Yes").otherwise("No").alias(flag)
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dedupe_outcome(
    records: DataFrame, key: Sequence[str], *, year: str, on_time: Column
) -> DataFrame:
    """One outcome per key from repeated diploma records.

    Most frequent and latest year (the smallest of equally frequent years), on time if any record
    is, and whether the key was repeated.
    """
    key = list(key)
    per_year = records.groupBy(*key, year).agg(
        F.count(F.lit(1)).alias("__n"), F.bool_or(on_time).alias("__ok")
    )
    return per_year.groupBy(*key).agg(
        F.max_by(year, F.struct(F.col("__n"), -F.col(year))).alias("GradYear"),
        F.max(year).alias("yearNum"),
        F.when(F.bool_or("__ok"), fixed.ON_TIME).otherwise(fixed.LATE).alias("grad_ind"),
        F.when(F.sum("__n") > 1, "Yes").otherwise("No").alias("duplicated"),
    )


def outcome_label(
    members: DataFrame,
    diplomas: DataFrame,
    enrolments: DataFrame,
    *,
    key: str,
    horizon: str,
    diploma_year: str,
    end_date: str,
    withdraw_year: str,
    code: str,
    by: Sequence[str] = (),
    codes: Mapping[str, str] = fixed.WITHDRAW_OUTCOMES,
    one_row_per_key: bool = False,
) -> DataFrame:
    """Outcome of every cohort member that has an enrolment.

    ``members`` holds the cohort columns ``by``, the key and the horizon (the year in which the
    cohort is expected to finish). Graduates are on time or late by their diploma year. All
    others are judged by their latest enrolment: one that ends after the horizon means not
    graduated, otherwise the withdrawal code decides. Latest enrolments that tie give one row
    each unless ``one_row_per_key``, which keeps the graduate's row, or else the first label of:
    unknown exit, late, not graduated.

    Diplomas and enrolments are counted per distinct combination of their values before they meet
    the members, so a key with very many rows is a handful of rows by then; there is no window
    and no join back to the enrolments.
    """
    keys = [*by, key]
    met = F.coalesce(F.col(diploma_year) <= F.col(horizon), F.lit(False))
    known = (
        diplomas.groupBy(key, diploma_year).agg(F.count(F.lit(1)).alias("__n"))
        .join(members, key)
        .groupBy(*keys)
        .agg(
            F.when(F.bool_or(met), fixed.ON_TIME).otherwise(fixed.LATE).alias("__label"),
            F.when(F.sum("__n") > 1, "Yes").otherwise("No").alias("duplicated"),
        )
    )

    label = F.coalesce(recode_outcome(F.col(code), codes), F.lit(fixed.NON_GRAD))
    rows = lambda cond: F.sum(F.when(cond, F.col("__n")).otherwise(0))
    per_date = (
        enrolments.groupBy(key, end_date, withdraw_year, code)
        .agg(F.count(F.lit(1)).alias("__n"))
        .join(members, key)
        .groupBy(*keys, end_date)
        .agg(
            F.sum("__n").alias("n"),
            rows(F.col(withdraw_year) > F.col(horizon)).alias("over"),
            rows(label == fixed.UNKNOWN_EXIT).alias("exits"),
            rows(label == fixed.LATE).alias("late"),
        )
    )
    last = per_date.groupBy(*keys).agg(
        F.max_by(
            F.struct("n", "over", "exits", "late"),
            F.struct(F.col(end_date).isNull(), F.col(end_date)),
        ).alias("l")
    )
    joined = last.join(known, keys, "left")

    def case(name: str | Column, copies: Column) -> Column:
        text = name if isinstance(name, Column) else F.lit(name)
        return F.struct(text.alias("grad_ind"), copies.alias("copies"))

    zero = F.lit(0).cast("long")
    cases = F.when(
        F.col("__label").isNotNull(), F.array(case(F.col("__label"), F.col("l.n")))
    ).when(
        F.col("l.over") > 0, F.array(case(fixed.NON_GRAD, F.col("l.over")))
    ).otherwise(
        F.array(
            case(fixed.UNKNOWN_EXIT, F.col("l.exits")),
            case(fixed.LATE, F.col("l.late")),
            case(fixed.NON_GRAD, F.greatest(F.col("l.n") - F.col("l.exits") - F.col("l.late"), zero)),
        )
    )
    some = F.filter(cases, lambda c: c["copies"] > 0)
    if one_row_per_key:
        return joined.select(*keys, F.element_at(some, 1)["grad_ind"].alias("grad_ind"), "duplicated")
    counted = joined.select(*keys, "duplicated", F.inline(some))
    return repeat_rows(counted, F.col("copies"), "__i").select(*keys, "grad_ind", "duplicated")


def recode_outcome(code: Column, codes: Mapping[str, str]) -> Column:
    """Label of a withdrawal code, missing for every other code."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.create_map(*pairs)[code]


def assemble(
    people: DataFrame,
    key: Sequence[str],
    *,
    tests: DataFrame,
    mobility: DataFrame,
    discipline: DataFrame | None,
    outcome: DataFrame | None = None,
) -> DataFrame:
    """One row per person (and latest-enrolment tie): attributes with everything known on them.

    ``discipline=None`` stands for a cohort whose incidents are not available: its columns are
    missing. Otherwise people without an incident get zero counts and ``None`` as types. Without
    ``outcome`` the frame is meant for scoring.
    """
    key = list(key)
    out = people
    if outcome is not None:
        out = out.join(outcome, key, "left")
    out = out.join(tests, key, "left")
    if discipline is None:
        missing = {"incCount": "long", "incType": "string", "daysRemoved": "double", "removalType": "string"}
        out = out.withColumns({c: F.lit(None).cast(t) for c, t in missing.items()})
    else:
        out = out.join(discipline, key, "left").fillna(
            {"incCount": 0, "incType": "None", "daysRemoved": 0, "removalType": "None"}
        )
    return out.join(mobility, key, "left")


def pool(cohorts: Sequence[DataFrame]) -> DataFrame:
    """Cohorts stacked by column name; columns a cohort lacks are missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cohorts)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
