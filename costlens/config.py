"""Defaults for the cost-interval job, as one frozen dataclass.

Column names are the engine's generic names (see ``Columns``); a caller
with other names passes its own ``Columns``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the source project's settings for equal
# results, so they are stated plainly here, in their natural order.
# ---------------------------------------------------------------------------

# Any string cell containing this pattern (any case) becomes null.
UNKNOWN_PATTERN = "(?i)unknown"

# Technology kept by the relevance filter.
TECH_TYPE_KEPT = "Air Source Heat Pump"

# Installation types dropped (compared lower-case; nulls are kept).
DENIED_INSTALL_TYPES = ("commercial", "non-domestic")

# Transaction type that marks a newly built home.
NEW_UNIT_TRANSACTION = "new dwelling"

# Age band written over every record of a newly built home.
NEW_UNIT_AGE_BAND = "2007 onwards"

# Days between first certificate and installation under which a new home
# is taken to have been built with the heat pump.
NEW_UNIT_GAP_DAYS = 365

WINSORISE_MODE = "upper"
MIN_DATE = "2007-01-01"
ROOMS_CAP = 8
IQR_MULTIPLIER = 1.5

# Construction age bands recoded to five groups; unlisted bands become null.
AGE_BAND_GROUPS = {
    "England and Wales: before 1900": "pre_1929",
    "Scotland: before 1919": "pre_1929",
    "1900-1929": "pre_1929",
    "1930-1949": "between_1930_1966",
    "1950-1966": "between_1930_1966",
    "1965-1975": "between_1965_1983",
    "1976-1983": "between_1965_1983",
    "1983-1991": "between_1983_2007",
    "1996-2002": "between_1983_2007",
    "1991-1998": "between_1983_2007",
    "2003-2007": "between_1983_2007",
    "2007 onwards": "2007_onwards",
}

# Room count as a category: 1..7 as themselves, 8 and over as "8+".
ROOM_CATEGORIES = ("1", "2", "3", "4", "5", "6", "7", "8+")

# Country from the first character of a district code.
COUNTRY_BY_CODE_PREFIX = {
    "E": "England",
    "W": "Wales",
    "S": "Scotland",
    "N": "Northern Ireland",
    "L": "Channel Islands",
    "M": "Isle of Man",
}

# Price index: reference year whose whole-year value is the base.
PRICE_INDEX_REFERENCE_YEAR = 2024

# Features fed to the models.
NUMERIC_FEATURES = ("n_days", "TOTAL_FLOOR_AREA", "NUMBER_HABITABLE_ROOMS")
DUMMY_FEATURES = (
    "BUILT_FORM_detached",
    "BUILT_FORM_mid_terrace",
    "BUILT_FORM_semi_detached",
    "PROPERTY_TYPE_bungalow",
    "CONSTRUCTION_AGE_BAND_between_1930_1966",
    "CONSTRUCTION_AGE_BAND_between_1965_1983",
    "CONSTRUCTION_AGE_BAND_between_1983_2007",
    "CONSTRUCTION_AGE_BAND_pre_1929",
    "region_name_east_midlands",
    "region_name_east_of_england",
    "region_name_london",
    "region_name_north_east",
    "region_name_north_west",
    "region_name_scotland",
    "region_name_south_east",
    "region_name_south_west",
    "region_name_wales",
    "region_name_west_midlands",
)

KFOLD_SPLITS = 5
RANDOM_STATE = 42
DATE_FOR_LATEST = "2023-01-01"
INTERVAL_QUANTILES = (0.1, 0.9)
FLOOR_PRICE = 8000.0

# Tuned boosting settings per bound.
LOWER_MODEL = {"n_estimators": 450, "min_samples_leaf": 100, "min_samples_split": 10,
               "learning_rate": 0.1, "max_depth": 10}
UPPER_MODEL = {"n_estimators": 450, "min_samples_leaf": 1, "min_samples_split": 1000,
               "learning_rate": 0.2, "max_depth": 5}

# Rule-table price estimates (home kind, rooms) -> price; first match wins.
RULE_TABLE_BUNGALOW = {2: 9900, 3: 10650, 4: 11950, 5: 12780, 6: 13710, 7: 14480}
RULE_TABLE_DETACHED = {4: 12640, 5: 13210, 6: 13800, 7: 14370, 8: 15150}
RULE_TABLE_OTHER = {3: 10850, 5: 11380, 6: 12850, 7: 14070}

# Neighbour-average rule: +-1 room, +-50 m2, more than 10 neighbours, mean of 10 latest.
BAND_ROOMS = 1.0
BAND_AREA = 50.0
BAND_TOP_K = 10


@dataclass(frozen=True)
class Columns:
    """Generic column names used by every operator (override per data set)."""

    key: str = "unit_id"
    event_date: str = "event_date"
    postcode: str = "postcode"
    tech_type: str = "tech_type"
    cost: str = "cost"
    cluster: str = "is_cluster"
    record_id: str = "record_id"
    install_type: str = "install_type"
    floor_area: str = "floor_area"
    age_band: str = "age_band"
    rooms: str = "rooms"
    transaction_type: str = "transaction_type"
    built_form: str = "built_form"
    property_type: str = "property_type"
    record_date: str = "inspection_date"
    ties: tuple = ("tie_1", "tie_2", "tie_3")


@dataclass(frozen=True)
class CleanConfig:
    """Parameters of the clean-and-feature job (defaults = source settings)."""

    cols: Columns = field(default_factory=Columns)
    tech_type: str = TECH_TYPE_KEPT
    denied_install_types: tuple = DENIED_INSTALL_TYPES
    new_unit_transaction: str = NEW_UNIT_TRANSACTION
    new_unit_age_band: str = NEW_UNIT_AGE_BAND
    new_unit_gap_days: int = NEW_UNIT_GAP_DAYS
    allowed_property_types: tuple | None = ("House", "Bungalow")
    floor_area_bounds: tuple = (20.0, 500.0)
    rooms_bounds: tuple = (2.0, None)
    cost_bounds: tuple = (None, None)
    adjusted_cost_bounds: tuple = (None, None)
    winsorise: str = WINSORISE_MODE
    min_date: str = MIN_DATE
    rooms_cap: int = ROOMS_CAP
    # Checkpoint filtered rows and size-check small sides before broadcasting.
    materialise: bool = True


# Column names of the source's table of installations x certificates.
SOURCE_COLUMNS = Columns(
    key="original_mcs_index", event_date="commission_date", record_id="original_epc_index", cluster="cluster",
    install_type="installation_type", floor_area="TOTAL_FLOOR_AREA", age_band="CONSTRUCTION_AGE_BAND",
    rooms="NUMBER_HABITABLE_ROOMS", transaction_type="TRANSACTION_TYPE", built_form="BUILT_FORM",
    property_type="PROPERTY_TYPE", record_date="INSPECTION_DATE", ties=("original_epc_index",))
SOURCE_CONFIG = CleanConfig(cols=SOURCE_COLUMNS)
