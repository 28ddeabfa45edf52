"""The life-expectancy panel: six publishers of (country, year) values.

Paths are relative to ``RAW_DIR`` (override by building your own list of
``SourceSpec`` with other paths). The override table ships empty on purpose:
a code-keyed relabelling is a mechanism, not data.
"""

from __future__ import annotations

import os

from panelmerge.spec import SourceSpec

RAW_DIR = os.environ.get("PANEL_RAW_DIR", "data/raw")

# Period range, value bounds, tolerance, aggregate-code prefix,
# metric columns and their labels, compared pairs and the HALE rule.
PERIOD_RANGE = (1950, 2024)
BOUNDS = (13, 95)
TOLERANCE = 2.5
AGGREGATE_PREFIX = "OWID_"
ON_DUPLICATE = "mean"   # one union and one shuffle; "multiply" gives the rows of an outer-join fold

METRICS = ["life_exp_owid", "life_exp_wb", "hale_who", "life_exp_unicef", "life_exp_kaggle", "life_exp_us_cdc"]
LABELS = {"life_exp_owid": "OWID", "life_exp_wb": "World Bank", "hale_who": "WHO (HALE)",
          "life_exp_unicef": "UNICEF", "life_exp_kaggle": "Kaggle", "life_exp_us_cdc": "CDC (US)"}
LE_SOURCES = ["life_exp_owid", "life_exp_wb", "life_exp_unicef", "life_exp_kaggle"]
PAIRS = [("life_exp_wb", "life_exp_owid", "World Bank vs OWID"),
         ("life_exp_wb", "life_exp_unicef", "World Bank vs UNICEF"),
         ("life_exp_wb", "life_exp_kaggle", "World Bank vs Kaggle")]
RULE = ("hale_who", "life_exp_wb")   # HALE <= total life expectancy

# Name corrections applied to the name-keyed sources (variant -> canonical).
CORRECTIONS = {
    "United States of America": "United States",
    "United Kingdom of Great Britain and Northern Ireland": "United Kingdom",
    "Russian Federation": "Russia",
    "Syrian Arab Republic": "Syria",
    "Türkiye": "Turkey",
    "United Republic of Tanzania": "Tanzania",
    "Venezuela (Bolivarian Republic of)": "Venezuela",
    "Venezuella (Bolivarian Republic of)": "Venezuela",
    "Viet Nam": "Vietnam",
    "Timor-Leste": "East Timor",
    "Republic of Moldova": "Moldova",
    "Micronesia": "Micronesia (country)",
    "Micronesia (Federated States of)": "Micronesia (country)",
    "Micronesia (Federatedd States of)": "Micronesia (country)",
    "Bolivia (Plurinational State of)": "Bolivia",
    "Iran (Islamic Republic of)": "Iran",
    "Democratic People's Republic of Korea": "North Korea",
    "Republic of Korea": "South Korea",
    "Lao People's Democratic Republic": "Laos",
    "Côte d'Ivoire": "Cote d'Ivoire",
    "Czechia": "Czech Republic",
    "Democratic Republic of the Congo": "Democratic Republic of Congo",
    "Cabo Verde": "Cape Verde",
    "Brunei Darussalam": "Brunei",
    "Swaziland": "Eswatini",
    "The former Yugoslav republic of Macedonia": "North Macedonia",
}

# Code-keyed label overrides, applied last. Intentionally empty.
OVERRIDES: dict = {}


def _p(name: str) -> str:
    return os.path.join(RAW_DIR, name)


# File and column names of the sources.
REFERENCE = SourceSpec(
    label="OWID", path=_p("owid_historical_life_expectancy.csv"), metric="life_exp_owid",
    raw_metric="Life expectancy", raw_code="Code", raw_name="Entity", raw_period="Year",
    keep_name=True, exclude_code_prefix=AGGREGATE_PREFIX)

SOURCES = [
    REFERENCE,
    SourceSpec(label="World Bank", path=_p("worldbank_life_expectancy.csv"), metric="life_exp_wb",
               raw_metric="life_exp_wb", raw_code="iso3", raw_period="year"),
    SourceSpec(label="Kaggle", path=_p("kaggle_health_factors.csv"), metric="life_exp_kaggle",
               raw_metric="Life expectancy", raw_name="Country", raw_period="Year",
               correct_names=True),
    SourceSpec(label="UNICEF", path=_p("unicef_life_expectancy.csv"), metric="life_exp_unicef",
               raw_metric="OBS_VALUE", raw_code="REF_AREA", raw_period="TIME_PERIOD",
               equals_filters=(("SEX", "_T"),), drop_null_metric=True, on_duplicate="mean"),
    SourceSpec(label="WHO (HALE)", path=_p("who_healthy_life_expectancy.csv"), metric="hale_who",
               raw_metric="AMOUNT_N", raw_name="GEO_NAME_SHORT", raw_period="DIM_TIME",
               equals_filters=(("DIM_GEO_CODE_TYPE", "COUNTRY"),),
               cascade=("DIM_SEX", ("TOTAL", "BTSX", "BOTHSEXES")),
               correct_names=True, drop_null_metric=True, on_duplicate="first"),
    SourceSpec(label="CDC (US)", path=_p("cdc_us_demographics.csv"), metric="life_exp_us_cdc",
               fmt="positional", positional=(2, 0, 1, "USA"), optional=True),
]


def with_raw_dir(raw_dir: str):
    """This configuration with every source path under ``raw_dir``."""
    from dataclasses import replace
    from types import SimpleNamespace

    def move(spec):
        return replace(spec, path=os.path.join(raw_dir, os.path.basename(spec.path)))

    cfg = SimpleNamespace(**{k: v for k, v in globals().items() if k.isupper()})
    cfg.REFERENCE = move(REFERENCE)
    cfg.SOURCES = [move(s) for s in SOURCES]
    cfg.RAW_DIR = raw_dir
    return cfg
