"""The questions the library answers, each from typed panels to a lazy result frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.operators import model
from yearpanel.operators.profile import summary
from yearpanel.operators.relate import correlation, lagged, same_year
from yearpanel.operators.totals import ranked, totals
from yearpanel.operators.trend import fastest_growing
from yearpanel.sources.scratch import materialise

COUNTRY_YEAR = ["country", "year"]


# Emissions


def top_emitters(emissions: DataFrame, n: int = 10) -> DataFrame:
    return ranked(totals(emissions, ["country"], "total"), "total", n)


def bottom_emitters(emissions: DataFrame, n: int = 10) -> DataFrame:
    """Smallest totals; a country without a single readable figure comes first."""
    return ranked(totals(emissions, ["country"], "total"), "total", n, descending=False)


def emissions_by_year(emissions: DataFrame) -> DataFrame:
    """Total of each year over all countries (not a running sum)."""
    return totals(emissions, ["year"], "total", digits=2).orderBy("year")


def emissions_country_year(emissions: DataFrame) -> DataFrame:
    return totals(emissions, COUNTRY_YEAR, "total", "total_emission", digits=2)


def fastest_growing_emitters(emissions: DataFrame, n: int = 10) -> DataFrame:
    return fastest_growing(emissions, "total", n)


# Generation and investment


def generation_country_year(generation: DataFrame, digits: int | None = None) -> DataFrame:
    return totals(generation, COUNTRY_YEAR, "value", "renewable_generated", digits)


def investment_country_year(investment: DataFrame) -> DataFrame:
    return totals(investment, COUNTRY_YEAR, "amount", "investment_amount")


def generation_by_region_year(generation: DataFrame) -> DataFrame:
    return totals(generation, ["region", "year"], "value", "renewable_generated").orderBy(
        "year", "region"
    )


def generation_by_type(generation: DataFrame) -> DataFrame:
    return totals(generation, ["type"], "value", "renewable_generated").orderBy("type")


def generation_by_technology_year(generation: DataFrame) -> DataFrame:
    return totals(generation, ["technology", "year"], "value", "renewable_generated").orderBy(
        "year", "technology"
    )


def country_generation_investment(generation: DataFrame, investment: DataFrame) -> DataFrame:
    return totals(generation, ["country"], "value", "renewable_generated").join(
        totals(investment, ["country"], "amount", "investment_amount"), "country"
    )


def top_largest_records(generation: DataFrame, n: int = 10) -> DataFrame:
    """Countries by their largest single record (not by their largest yearly total)."""
    return ranked(
        totals(generation, ["country"], "value", "max_generation", how=F.max), "max_generation", n
    )


# Relations


def emissions_generation_panel(emissions: DataFrame, generation: DataFrame) -> DataFrame:
    return same_year(
        emissions_country_year(emissions), generation_country_year(generation, digits=2)
    )


def emissions_generation_correlation(emissions: DataFrame, generation: DataFrame) -> DataFrame:
    """One correlation over all countries and years; a missing total counts as zero."""
    panel = emissions_generation_panel(emissions, generation)
    return correlation(panel, "total_emission", "renewable_generated", nulls_as_zero=True)


def investment_emissions_lags(
    investment: DataFrame, emissions: DataFrame, lags: Sequence[int] = range(6)
) -> DataFrame:
    """Investment of a year beside the emissions ``lag`` years later."""
    return lagged(
        investment_country_year(investment),
        emissions_country_year(emissions),
        lags,
        "investment_year",
        "emissions_year",
    )


def investment_emissions_lag_summary(panel: DataFrame) -> DataFrame:
    return summary(panel, by=["lag"])


def investment_emissions_lag_correlation(panel: DataFrame) -> DataFrame:
    return correlation(panel, "investment_amount", "total_emission", by=["lag"], digits=3)


def investment_generation_lags(
    investment: DataFrame, generation: DataFrame, lags: Sequence[int] = range(6)
) -> DataFrame:
    """Investment of a year beside the generation ``lag`` years later."""
    return lagged(
        investment_country_year(investment),
        generation_country_year(generation),
        lags,
        "investment_year",
        "generation_year",
    )


def investment_generation_lag_correlation(panel: DataFrame) -> DataFrame:
    return correlation(panel, "investment_amount", "renewable_generated", by=["lag"])


# Investment impact model


def fit_investment_impact(
    frame: DataFrame,
    categories: Sequence[str] = model.CATEGORIES,
    fraction: float = 0.7,
    handle_invalid: str = "error",
) -> tuple[PipelineModel, DataFrame]:
    """The fitted pipeline and the held-out part of a weighted frame.

    The frame is small but stands on two whole panels, and fitting reads it several times. It is
    therefore written once to the shared folder.
    """
    sides = materialise(frame.withColumn("training", model.in_training(fraction=fraction)), "ml")
    training = sides.filter("training").drop("training")
    held_out = sides.filter("not training").drop("training")
    return _fitted(training, categories, handle_invalid), held_out


def _fitted(
    training: DataFrame, categories: Sequence[str], handle_invalid: str
) -> PipelineModel:
    labels = [model.labels_by_pairs(training, name) for name in categories]
    return model.impact_pipeline(categories, handle_invalid, labels).fit(training)


def investment_impact_rmse(
    generation: DataFrame,
    investment: DataFrame,
    categories: Sequence[str] = model.CATEGORIES,
    digits: int | None = None,
    handle_invalid: str = "error",
    seed: int | None = None,
) -> DataFrame:
    """RMSE over the held-out pairs. The split is by country and year, or with a ``seed`` by
    investment row at random; an investment takes all its pairs along."""
    if seed is not None:
        labels = materialise(model.label_points(generation), "labels")
        training, held_out = (
            materialise(model.paired(labels, model.flow_points(part)), "ml")
            for part in model.random_split(investment, seed=seed)
        )
        fitted = _fitted(training, categories, handle_invalid)
        return model.rmse(model.predictions(fitted, held_out), digits)
    frame = model.training_frame(generation, investment)
    fitted, held_out = fit_investment_impact(frame, categories, handle_invalid=handle_invalid)
    return model.rmse(model.predictions(fitted, held_out), digits)


def investment_impact_predictions(generation: DataFrame, investment: DataFrame) -> DataFrame:
    """Prediction for every held-out investment row and technology.

    Fit and scoring share the reduced labels, so the generation panel is read once.
    """
    labels = materialise(model.label_points(generation), "labels")
    fitted, _ = fit_investment_impact(model.paired(labels, model.flow_points(investment)))
    held_out = investment.filter(~model.in_training())
    return model.predictions(fitted, model.scoring_frame(labels, held_out))
