"""The three studies and the table profile: named result frames from cleaned panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from yearpanel.operators import names, profile
from yearpanel.plans import reports


def emissions_study(emissions: DataFrame, generation: DataFrame) -> dict[str, DataFrame]:
    """Emitters, yearly totals, trends, and emissions beside renewable generation."""
    return {
        "top_emitters": reports.top_emitters(emissions),
        "bottom_emitters": reports.bottom_emitters(emissions),
        "emissions_by_year": reports.emissions_by_year(emissions),
        "fastest_growing_emitters": reports.fastest_growing_emitters(emissions),
        "emissions_generation_panel": reports.emissions_generation_panel(emissions, generation),
        "emissions_generation_correlation": reports.emissions_generation_correlation(
            emissions, generation
        ),
    }


def investment_emissions_study(
    investment: DataFrame, emissions: DataFrame, lags: Sequence[int] = range(6)
) -> dict[str, DataFrame]:
    """How many years until an investment shows in the emissions."""
    panel = reports.investment_emissions_lags(investment, emissions, lags)
    return {
        "unmatched_countries": names.unmatched(emissions, investment, "country"),
        "investment_country_year": reports.investment_country_year(investment),
        "emissions_country_year": reports.emissions_country_year(emissions),
        "investment_emissions_lags": panel,
        "investment_emissions_lag_summary": reports.investment_emissions_lag_summary(panel),
        "investment_emissions_lag_correlation": reports.investment_emissions_lag_correlation(panel),
    }


def investment_generation_study(
    investment: DataFrame,
    generation: DataFrame,
    lags: Sequence[int] = range(6),
    seed: int | None = None,
) -> dict[str, DataFrame]:
    """Generation by region, type, technology and country, and what investment does to it.

    With a ``seed`` the impact model splits investment rows at random.
    """
    panel = reports.investment_generation_lags(investment, generation, lags)
    return {
        "generation_country_year": reports.generation_country_year(generation),
        "investment_country_year": reports.investment_country_year(investment),
        "generation_by_region_year": reports.generation_by_region_year(generation),
        "generation_by_type": reports.generation_by_type(generation),
        "country_generation_investment": reports.country_generation_investment(
            generation, investment
        ),
        "investment_impact_rmse": reports.investment_impact_rmse(
            generation, investment, seed=seed
        ),
        "top_largest_records": reports.top_largest_records(generation),
        "investment_generation_lags": panel,
        "investment_generation_lag_correlation": reports.investment_generation_lag_correlation(
            panel
        ),
        "generation_by_technology_year": reports.generation_by_technology_year(generation),
    }


def table_profile(raw: DataFrame, rows: int = 25, approx: bool = False) -> dict[str, DataFrame]:
    """Schema, first rows, summary, blanks and distinct values of a columnar table."""
    return {
        "schema": profile.schema_rows(raw),
        "sample": profile.sample(raw, rows, raw.columns),
        "summary": profile.summary(raw),
        "blank_counts": profile.blank_counts(raw),
        "distinct_counts": profile.distinct_counts(raw, approx),
    }
