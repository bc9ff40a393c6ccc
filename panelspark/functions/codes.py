"""Area codes, series ids, and the fixed code lists that results depend on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values ---------------------------------------------------------
NATION = "US"
NATION_NAME = "United States"

STATE_PATTERN = r"^\d{2}$"
COUNTY_PATTERN = r"^\d{5}$"

REGION_STATES = {
    "R1": ["09", "23", "25", "33", "34", "36", "42", "44", "50"],
    "R2": ["17", "18", "19", "20", "26", "27", "29", "31", "38", "39", "46", "55"],
    "R3": ["01", "05", "10", "11", "12", "13", "21", "22", "24", "28", "37", "40", "45", "47", "48", "51", "54"],
    "R4": ["02", "04", "06", "08", "15", "16", "30", "32", "35", "41", "49", "53", "56"],
}
REGION_CODES = ["R1", "R2", "R3", "R4"]
UNASSIGNED_STATES = ["72"]

STATE_SERIES_PREFIX = "LASST"
STATE_SERIES_SUFFIX = "0000000000003"
COUNTY_SERIES_PREFIX = "LAUCN"
COUNTY_SERIES_SUFFIX = "0000000003"
IDS_PER_REQUEST = 50

ANNUAL_PERIOD = "M13"
MISSING_MARKER = "."
REQUEST_OK = "REQUEST_SUCCEEDED"

POPULATION_VARIABLE = "B01001_001E"
NAME_VARIABLE = "NAME"

UNEMPLOYMENT = "BLS_UNRATE"
SHELTER_PRICES = "CPI_SHELTER"
SURVEY_INDICATORS = {"ACS1": "ACS1_TOTAL_POP", "ACS5": "ACS5_TOTAL_POP"}
BASELINE_POPULATION = "ACS_TOTAL_POP"

PRICE_SERIES = {
    "CUUR0000SAH1": ("US", "United States"),
    "CUUR0100SAH1": ("R1", "Northeast"),
    "CUUR0200SAH1": ("R2", "Midwest"),
    "CUUR0300SAH1": ("R3", "South"),
    "CUUR0400SAH1": ("R4", "West"),
}

MODEL_NAMES = ["linear", "ridge", "xgb", "prophet"]
TREND_MODEL, TREND_STEM = "prophet", "prophet_model_"
DEFAULT_MODEL = "linear"
# ---------------------------------------------------------------------------

STATE_CODES = sorted(s for states in REGION_STATES.values() for s in states) + UNASSIGNED_STATES


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def is_state_or_county(code: Column) -> Column:
    return code.rlike(STATE_PATTERN) | code.rlike(COUNTY_PATTERN)


def region_of(code: Column) -> Column:
    """Census region of a state or county code; NULL for anything else."""
    by_state = literal_map({s: r for r, states in REGION_STATES.items() for s in states})
    return F.when(is_state_or_county(code), F.try_element_at(by_state, F.substring(code, 1, 2)))


def area_type(code: Column) -> Column:
    return (
        F.when(code == NATION, "nation")
        .when(code.startswith("R"), "region")
        .when(code.rlike(STATE_PATTERN), "state")
        .when(code.rlike(COUNTY_PATTERN), "county")
    )


def series_area_type(series_id: Column) -> Column:
    return F.when(series_id.startswith(STATE_SERIES_PREFIX), "state").when(
        series_id.startswith(COUNTY_SERIES_PREFIX), "county"
    )


def series_area_code(series_id: Column) -> Column:
    return F.when(series_id.startswith(STATE_SERIES_PREFIX), F.substring(series_id, 6, 2)).when(
        series_id.startswith(COUNTY_SERIES_PREFIX), F.substring(series_id, 6, 5)
    )


def series_id_for(code: Column) -> Column:
    """Unemployment series id of a state or county; NULL for other areas."""
    return F.when(
        code.rlike(STATE_PATTERN), F.concat(F.lit(STATE_SERIES_PREFIX), code, F.lit(STATE_SERIES_SUFFIX))
    ).when(code.rlike(COUNTY_PATTERN), F.concat(F.lit(COUNTY_SERIES_PREFIX), code, F.lit(COUNTY_SERIES_SUFFIX)))


def survey_indicator(source: Column) -> Column:
    return F.when(source == "ACS1", SURVEY_INDICATORS["ACS1"]).otherwise(SURVEY_INDICATORS["ACS5"])


def price_area_code(series_id: Column) -> Column:
    return F.try_element_at(literal_map({s: code for s, (code, _) in PRICE_SERIES.items()}), series_id)


def price_area_name(series_id: Column) -> Column:
    return F.try_element_at(literal_map({s: name for s, (_, name) in PRICE_SERIES.items()}), series_id)


def price_area_type(code: Column) -> Column:
    return F.when(code.startswith("R"), "region").otherwise("nation")


def chosen_area(nation: Column, state: Column, county: Column) -> Column:
    """Most specific non-empty choice, the nation when nothing is chosen."""
    blank = F.lit("")
    return F.coalesce(F.nullif(county, blank), F.nullif(state, blank), F.nullif(nation, blank), F.lit(NATION))


def model_name(name: Column) -> Column:
    """Lower-cased model name; the default when missing, NULL when unknown."""
    lowered = F.lower(F.coalesce(name, F.lit(DEFAULT_MODEL)))
    return F.when(lowered.isin(MODEL_NAMES), lowered)


def artifact_model(stem: Column, family: Column) -> Column:
    """Model part of a ``model_area`` artifact name; the folder's family if absent."""
    trend = F.when(stem.startswith(TREND_STEM), F.lit(TREND_MODEL))
    return trend.when(F.instr(stem, "_") > 0, F.split(stem, "_", 2)[0]).otherwise(family)


def artifact_area(stem: Column) -> Column:
    trend = F.when(stem.startswith(TREND_STEM), F.substr(stem, F.lit(len(TREND_STEM) + 1)))
    return trend.when(F.instr(stem, "_") > 0, F.split(stem, "_", 2)[1]).otherwise(stem)
