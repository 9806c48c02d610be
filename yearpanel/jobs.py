"""The studies as Spark jobs, from raw files to CSV reports; ``study.py`` submits them.

Each raw file is parsed and cleaned once, into a columnar table in the shared scratch folder; the
reports of a study read that table.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from yearpanel.functions.names import DEVELOPED_COUNTRIES
from yearpanel.operators.clean import (
    GENERATION_TREND_YEARS,
    REPORT_YEARS,
    clean_emissions,
    clean_generation,
    clean_investment,
)
from yearpanel.plans import analyses
from yearpanel.sources.files import read_table, write_by_lag, write_csv
from yearpanel.sources.scratch import deleted_afterwards, materialise

STUDY_INPUTS = {
    "emissions": ["emissions", "generation"],
    "investment-emissions": ["investment", "emissions"],
    "investment-generation": ["investment", "generation"],
    "profile": ["table"],
}
TABLES = ["clean_emissions"]
COLUMNAR = ["parquet", "orc"]
LAG_PANELS = ["investment_emissions_lags", "investment_generation_lags"]


def run_study(
    spark: SparkSession,
    study: str,
    paths: dict[str, str],
    format: str = "csv",
    years: tuple[int, int] | None = None,
    countries: Sequence[str] | None = None,
    technology: str | None = None,
    lags: Sequence[int] = range(6),
    seed: int | None = None,
) -> dict[str, DataFrame]:
    """The result frames of one study.

    ``years`` replaces the years of the reports for every table, ``countries`` and ``technology``
    narrow the investment, and ``seed`` asks for a random split of it.
    """
    raw = {name: read_table(spark, paths[name], format) for name in STUDY_INPUTS[study]}
    if study == "profile":
        table = raw["table"]
        return analyses.table_profile(
            table if format in COLUMNAR else materialise(table, "profile")
        )
    trend = study == "investment-generation"
    own = GENERATION_TREND_YEARS if trend else REPORT_YEARS
    cleaning = {
        "emissions": lambda df: clean_emissions(df, years or REPORT_YEARS),
        "generation": lambda df: clean_generation(df, years or own),
        "investment": lambda df: clean_investment(
            df, years or REPORT_YEARS, countries=countries, technology=technology
        ),
    }
    panels = {name: materialise(cleaning[name](df), name) for name, df in raw.items()}
    if study == "emissions":
        results = analyses.emissions_study(**panels)
        return {"clean_emissions": panels["emissions"], **results}
    if trend:
        return analyses.investment_generation_study(**panels, lags=lags, seed=seed)
    return analyses.investment_emissions_study(**panels, lags=lags)


def write_results(
    results: dict[str, DataFrame],
    out: str,
    mode: str = "errorifexists",
    single_file: bool = False,
) -> None:
    """One CSV folder per result; lagged panels get one folder per lag inside theirs.

    With ``single_file`` every report is one file; cleaned tables and lagged panels never are.
    """
    for name, frame in results.items():
        path = f"{out.rstrip('/')}/{name}"
        if name in LAG_PANELS:
            write_by_lag(frame, path, mode)
        else:
            write_csv(frame, path, mode, single_file=single_file and name not in TABLES)


def _years(text: str) -> tuple[int, int]:
    first, last = text.split("-")
    return int(first), int(last)


def _countries(text: str) -> list[str]:
    names = [name.strip().lower() for name in text.split(",")]
    return DEVELOPED_COUNTRIES if names == ["developed"] else names


def _lags(text: str) -> list[int]:
    return [int(lag) for lag in text.split(",")]


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Country-year panel studies")
    parser.add_argument("study", choices=STUDY_INPUTS)
    for name in ("emissions", "generation", "investment", "table"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--out", required=True)
    parser.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    parser.add_argument("--single-file", action="store_true", help="one file per report")
    parser.add_argument("--years", type=_years, help="first and last year, as in 2000-2023")
    parser.add_argument("--countries", type=_countries, help="names with commas, or 'developed'")
    parser.add_argument("--technology", help="the one technology of the investment")
    parser.add_argument("--lags", type=_lags, default=range(6), help="years, as in 0,1,2")
    parser.add_argument("--seed", type=int, help="split investment rows at random")
    options = parser.parse_args(arguments)
    missing = [name for name in STUDY_INPUTS[options.study] if not getattr(options, name)]
    if missing:
        parser.error(f"{options.study} needs " + ", ".join(f"--{name}" for name in missing))
    spark = SparkSession.builder.appName(f"yearpanel-{options.study}").getOrCreate()
    with deleted_afterwards(spark):
        results = run_study(
            spark,
            options.study,
            vars(options),
            options.format,
            options.years,
            options.countries,
            options.technology,
            options.lags,
            options.seed,
        )
        write_results(results, options.out, options.mode, options.single_file)

