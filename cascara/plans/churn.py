"""The churn cleaning job as one declarative DataFrame plan.

Order (kept because the survivor of the key dedup changes if rules move above it):
rename → distinct → dedup by key → required fields → phone dependency → internet dependency → SeniorCitizen domain →
phone child present → internet children present → fill off-service children → numeric range / NaN → boolean recode.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cascara.operators import clean as C
from cascara.sources.churn_values import (
    BOOLEANS,
    DEDUP_ORDER,
    FLOATS,
    INTERNET_CHILDREN,
    INTERNET_PARENT,
    KEY,
    NO_INTERNET,
    NO_PHONE,
    NUMERIC,
    PHONE_CHILDREN,
    PHONE_PARENT,
    RENAMES,
    REQUIRED,
    SENIOR,
)

RULE_CHILD_PHONE = C.dependency_rule("child_phone", PHONE_PARENT, "No", PHONE_CHILDREN, NO_PHONE)
RULE_CHILD_INTERNET = C.dependency_rule("child_internet", INTERNET_PARENT, "No", INTERNET_CHILDREN, NO_INTERNET)
RULE_DOMAIN_SENIOR = C.domain_rule("domain_senior", "SeniorCitizen", SENIOR)
RULE_MISSING_PHONE = C.required_if_rule("missing_phone", PHONE_PARENT, "Yes", PHONE_CHILDREN)
RULE_MISSING_INTERNET = C.required_if_rule("missing_internet", INTERNET_PARENT, "Yes", INTERNET_CHILDREN)
RULE_MISSING_INTERNET_STRICT = C.required_unless_rule("missing_internet_strict", INTERNET_PARENT, "No",
                                                      INTERNET_CHILDREN)
RULE_NUMERIC = C.range_rule("invalid_numeric", nonnegative=NUMERIC, not_nan=FLOATS)

PRE_FILL_RULES = [RULE_CHILD_PHONE, RULE_CHILD_INTERNET, RULE_DOMAIN_SENIOR, RULE_MISSING_PHONE, RULE_MISSING_INTERNET]
ALL_RULES = PRE_FILL_RULES + [RULE_NUMERIC]


@dataclass(frozen=True)
class CleanSpec:
    """Parameters of the cleaning chain; the defaults are the churn table's."""

    renames: dict = field(default_factory=lambda: dict(RENAMES))
    key: str = KEY
    dedup_order: tuple = tuple(DEDUP_ORDER)
    required: tuple = tuple(REQUIRED)
    pre_fill_rules: tuple = tuple(PRE_FILL_RULES)
    fills: tuple = ((PHONE_PARENT, "No", tuple(PHONE_CHILDREN), NO_PHONE),
                    (INTERNET_PARENT, "No", tuple(INTERNET_CHILDREN), NO_INTERNET))
    post_fill_rules: tuple = (RULE_NUMERIC,)
    booleans: dict = field(default_factory=lambda: dict(BOOLEANS))
    distinct_first: bool = False


def dedup_stage(raw: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """rename → distinct → one row per key.

    The key dedup keeps the smallest row of each key by all columns, which is the same row with or without exact
    duplicates, so the separate distinct is redundant and skipped by default (``distinct_first=True`` forces it).
    Skipping it matters at scale: distinct and key dedup would share one shuffle on the key, and the map-side
    partial aggregate of the dedup — which shrinks a hot key to one row per partition before the shuffle — only
    runs when the dedup is the first aggregate.
    """
    df = C.rename_columns(raw, spec.renames)
    if spec.distinct_first:
        df = C.distinct_rows(df)
    return C.dedup_by_key(df, spec.key, list(spec.dedup_order))


def required_stage(raw: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """… → required columns present (not NULL, not NaN)."""
    return C.drop_missing(dedup_stage(raw, spec), list(spec.required))


def clean_strings(raw: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """The chain up to (and including) the numeric rule, before the boolean recode: all values still strings."""
    df = C.reject(required_stage(raw, spec), list(spec.pre_fill_rules))
    for parent, off, children, sentinel in spec.fills:
        df = C.fill_dependent(df, parent, off, list(children), sentinel)
    return C.reject(df, list(spec.post_fill_rules))


def clean(raw: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """The whole cleaning chain: one shuffle for distinct, one for the key dedup, the rest is one projection/filter."""
    return C.recode_booleans(clean_strings(raw, spec), spec.booleans)


def stage_report(raw: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """``(stage, rule, rows_in, rows_removed, rows_out)`` for every stage that removes rows: exact duplicates, key dedup,
    missing fields, the rules and the numeric rule, counted while one run writes the cleaned rows (see
    ``clean_and_report``)."""
    from cascara.session import scratch_path

    return clean_and_report(raw, scratch_path(raw.sparkSession, "cleaned"), spec)


def clean_and_report(raw: DataFrame, path: str, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Write the cleaned rows to ``path`` and return the stage report of that same run: each stage counts the rows that
    leave it as they pass (``Observation``), so the raw table is scanned once and no stage runs again. The counts are those
    of the tasks that ran; where an executor was lost they can hold repeated tasks, which the rows written do not."""
    seen: list[tuple[str, Observation]] = []

    def counted(df: DataFrame, stage: str) -> DataFrame:
        seen.append((stage, Observation()))
        return df.observe(seen[-1][1], F.count(F.lit(1)).alias("n"))

    df = counted(C.rename_columns(raw, spec.renames), "")
    df = counted(C.distinct_rows(df), "distinct_rows")
    df = counted(C.dedup_by_key(df, spec.key, list(spec.dedup_order)), "dedup_by_key")
    df = counted(C.drop_missing(df, list(spec.required)), "dropna_required")
    for rule in spec.pre_fill_rules:
        df = counted(C.reject(df, rule), rule.name)
    for parent, off, children, sentinel in spec.fills:
        df = C.fill_dependent(df, parent, off, list(children), sentinel)
    for rule in spec.post_fill_rules:
        df = counted(C.reject(df, rule), rule.name)
    C.recode_booleans(df, spec.booleans).write.mode("overwrite").parquet(path)
    n = [o.get["n"] for _, o in seen]
    rows = [(i, stage, n[i], n[i] - n[i + 1], n[i + 1]) for i, (stage, _) in enumerate(seen[1:])]
    return raw.sparkSession.createDataFrame(rows, "stage int, rule string, rows_in long, rows_removed long, rows_out long")


# The allowed words of the repairable columns, in the order the original job lists them.
GENDERS = ["Male", "Female"]
YES_NO = ["Yes", "No"]
YES_NO_PHONE = ["Yes", "No", "No phone service"]
YES_NO_INTERNET = ["Yes", "No", "No internet service"]
REPAIR_VOCAB = {
    "Gender": GENDERS,
    "Partner": YES_NO,
    "Dependents": YES_NO,
    "PhoneService": YES_NO,
    "MultipleLines": YES_NO_PHONE,
    **{c: YES_NO_INTERNET for c in INTERNET_CHILDREN},
    "PaperlessBilling": YES_NO,
    "Churn": YES_NO,
}


def repaired(raw: DataFrame, scorer: str = "levenshtein", threshold: float = 80.0) -> DataFrame:
    """rename → fuzzy vocabulary repair of the 13 Yes/No-style columns (before any dedup)."""
    from cascara.operators.repair import fuzzy_repair

    return fuzzy_repair(C.rename_columns(raw, RENAMES), REPAIR_VOCAB, scorer, threshold)


def clean_repaired(raw: DataFrame, spec: CleanSpec = CleanSpec(), scorer: str = "levenshtein",
                   threshold: float = 80.0) -> DataFrame:
    """The cleaning chain with typo repair between rename and distinct (the renames are already applied)."""
    from dataclasses import replace

    return clean(repaired(raw, scorer, threshold), replace(spec, renames={}))
