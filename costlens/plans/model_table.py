"""The clean-and-feature job: installation x certificate rows -> one row per unit.

Order of steps is fixed (it changes results):
null-out -> age-band fill -> new-unit exclusion -> relevance filter ->
range bounds + outlier treatment -> price-index adjustment -> as-of record
choice -> location join -> days since start -> one-hot features.

Shuffle plan: the first-record and mode facts come from one scan and two
map-side-combined aggregates and are written, one row per unit; their shuffle
files go before the rows are read again and joined to them once (a sort-merge
join on the key; adaptive execution splits a hot key). The filtered rows
are then written once to the shared folder, without the columns that are
spent by then. The outlier statistics (one row per group) and the price factors (one row per
quarter) are broadcast after a row-count check, so the rows are not
shuffled by the few-valued group key. The as-of choice is a ``min_by``
aggregate on the key. The location lookup is a planner-chosen join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens import config as C
from costlens.functions.expressions import cap_value, days_since, false_if_null
from costlens.operators import records as R
from costlens.operators.clean import allow_list, bounds_filter, null_out_strings, relevant_rows
from costlens.operators.features import dummify
from costlens.operators.indexation import adjust_costs
from costlens.operators.outliers import treat_outliers
from costlens.plans.materialise import broadcast_if_small, materialise, release


def unit_facts(df: DataFrame, cfg: C.CleanConfig) -> DataFrame:
    """One row per key: is it a new unit, must it be dropped, its most common age band."""
    c = cfg.cols
    first = R.first_and_mode(df, c.key, c.record_date, c.ties, c.age_band,
                             [c.event_date, c.record_date, c.transaction_type], "_mode")
    is_new = false_if_null(F.col(c.transaction_type) == F.lit(cfg.new_unit_transaction))
    gap = F.abs(F.datediff(F.col(c.event_date).cast("date"), F.col(c.record_date).cast("date")))
    return first.select(c.key, is_new.alias("_new"),
                        (is_new & false_if_null(gap < F.lit(cfg.new_unit_gap_days))).alias("_drop"),
                        "_mode")


def fill_and_exclude(df: DataFrame, cfg: C.CleanConfig) -> DataFrame:
    """Age-band fill for new units / missing bands, then drop new units built with the system."""
    c = cfg.cols
    facts = unit_facts(df, cfg)
    if cfg.materialise:  # written before the rows are read again, so that its shuffles do not stay beside theirs
        facts = materialise(facts)
        release(df.sparkSession)
    j = df.join(facts, on=c.key, how="left")
    band = F.when(F.col("_new"), F.lit(cfg.new_unit_age_band)).otherwise(
        F.coalesce(F.col(c.age_band), F.col("_mode")))
    return (j.filter(~false_if_null(F.col("_drop")))
             .withColumn(c.age_band, band)
             .select(*df.columns))


def exclusion_bounds(df: DataFrame, cfg: C.CleanConfig) -> DataFrame:
    """Allow-list, range bounds and per-group outlier treatment, in source order.

    Outlier treatment runs only when no cost bound is given; it caps the room
    count at ``rooms_cap`` first (kept for later steps) and groups by
    (property type, age band, capped rooms).
    """
    c = cfg.cols
    df = allow_list(df, c.property_type, cfg.allowed_property_types)
    df = bounds_filter(df, c.floor_area, *cfg.floor_area_bounds)
    if any(b is not None for b in cfg.adjusted_cost_bounds):
        if "adjusted_cost" not in df.columns:
            raise ValueError("adjusted_cost bounds given but adjusted_cost is not computed yet")
        df = bounds_filter(df, "adjusted_cost", *cfg.adjusted_cost_bounds)
    df = bounds_filter(df, c.cost, *cfg.cost_bounds)
    cost_bounded = any(b is not None for b in (*cfg.cost_bounds, *cfg.adjusted_cost_bounds))
    if not cost_bounded:
        df = df.withColumn(c.rooms, cap_value(c.rooms, cfg.rooms_cap))
        df = treat_outliers(df, [c.property_type, c.age_band, c.rooms], c.cost, cfg.winsorise,
                            prepare_bounds=broadcast_if_small if cfg.materialise else None)
    return bounds_filter(df, c.rooms, *cfg.rooms_bounds)


def relevant_records(records: DataFrame, cfg: C.CleanConfig = C.CleanConfig()) -> DataFrame:
    """Steps up to and including the relevance filter. They read none of the bounds, so tables that differ in them share these rows.

    Only the columns that the job names are read; those that only the filters
    need are dropped after them.
    """
    c = cfg.cols
    names = {f.name: getattr(c, f.name) for f in fields(c) if f.name != "ties"}
    used = list(dict.fromkeys([*names.values(), *c.ties]))
    df = null_out_strings(records.select(*[x for x in used if x in records.columns]))
    df = fill_and_exclude(df, cfg)
    df = relevant_rows(df, c, cfg.tech_type, cfg.denied_install_types)
    df = df.drop(c.tech_type, c.install_type, c.cluster, c.transaction_type)
    if cfg.materialise:
        # Cut lineage once: the outlier statistics and the main flow both read these rows.
        df = materialise(df)
        release(df.sparkSession)
    return df


def units_of_relevant(df: DataFrame, price_factors: DataFrame | None, cfg: C.CleanConfig = C.CleanConfig()) -> DataFrame:
    """Steps from the bounds up to and including the as-of record choice, of ``relevant_records`` (one row per unit)."""
    c = cfg.cols
    df = exclusion_bounds(df, cfg)
    if price_factors is not None:
        if cfg.materialise:
            price_factors = broadcast_if_small(price_factors)
        df = adjust_costs(df, price_factors, c.event_date, c.cost)
    return R.asof_record(df, c.key, c.event_date, c.record_date, c.ties)


def units_before_features(records: DataFrame, price_factors: DataFrame | None,
                          cfg: C.CleanConfig = C.CleanConfig()) -> DataFrame:
    """Steps up to and including the as-of record choice (one row per unit)."""
    return units_of_relevant(relevant_records(records, cfg), price_factors, cfg)


def model_table(records: DataFrame, locations: DataFrame, price_factors: DataFrame | None,
                levels: Mapping[str, Sequence], cfg: C.CleanConfig = C.CleanConfig(),
                rooms_as_categorical: bool = False, relevant: bool = False) -> DataFrame:
    """The whole job: one cleaned, feature-encoded row per unit.

    ``relevant``: ``records`` are ``relevant_records`` already, made with the same settings but for the bounds.
    """
    c = cfg.cols
    units = (units_of_relevant if relevant else units_before_features)(records, price_factors, cfg)
    units = units.join(locations, on=c.postcode, how="left")
    units = units.withColumn("n_days", days_since(c.event_date, cfg.min_date))
    return dummify(units, levels, c, numeric=("n_days",), region="region_name",
                   rooms_as_categorical=rooms_as_categorical, rooms_cap=cfg.rooms_cap)
