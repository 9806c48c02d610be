"""The registered queries over the test tables. Their SQL twins are in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yearpanel.functions.names import DEVELOPED_COUNTRIES
from yearpanel.functions.stats import exact_sum
from yearpanel.operators import clean, model, names, profile
from yearpanel.operators.totals import totals
from yearpanel.operators.trend import slopes
from yearpanel.plans import reports
from yearpanel.sources import files, panels
from yearpanel.sources.scratch import materialise, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# The years that cleaning keeps. The last test year, 2001, is incomplete.
FULL_YEARS = (1995, 2000)
FILTER_COUNTRIES = [f"nation_{k}" for k in (1, 3, 4, 9, 12)]
FILTER_TECHNOLOGY = "1-URGENT"

SUM = exact_sum


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Cut the noise of floating-point sums, whose order of addition varies between runs."""
    return df.withColumns({name: F.round(name, digits) for name in columns})


# Panels, each with the columns a query needs


def country_generation(spark, sf, how=SUM):
    return panels.generation(spark, sf, ["country", "year", "value"], subtotal=how)


def country_supply_investment(spark, sf):
    return panels.supply_investment(spark, sf, ["country", "year", "amount"], subtotal=SUM)


def cleaned_emissions(spark, sf):
    return clean.clean_emissions(panels.raw_emissions(spark, sf), FULL_YEARS, panels.RAW_ALIASES)


def cleaned_generation(spark, sf):
    return clean.clean_generation(panels.raw_generation(spark, sf), FULL_YEARS, panels.RAW_ALIASES)


def cleaned_investment(spark, sf, **filters):
    return clean.clean_investment(
        panels.raw_investment(spark, sf), FULL_YEARS, panels.RAW_ALIASES, **filters
    )


def developed_investment(spark, sf):
    """Cleaned investment of developed countries; the test nations take the list's names in turn."""
    raw = panels.raw_investment(spark, sf)
    common = clean.canonical(F.col("`Country/Area`"), panels.RAW_ALIASES)
    number = F.regexp_extract(common, "[0-9]+", 0).try_cast("int")
    taken = F.array(*[F.lit(name) for name in DEVELOPED_COUNTRIES[:12]])
    name = F.coalesce(F.get(taken, number), F.col("`Country/Area`"))
    return clean.clean_investment(
        raw.withColumn("Country/Area", name), FULL_YEARS, countries=DEVELOPED_COUNTRIES
    )


# Sources and sinks


def csv_roundtrip(spark, sf):
    """Cleaned emissions to CSV without a header, and back."""
    path = scratch_path(spark, "csv")
    panel = cleaned_emissions(spark, sf)
    files.write_csv(panel, path, mode="overwrite")
    return spark.read.schema(panel.schema).csv(path)


def csv_header_roundtrip(spark, sf):
    """The raw investment table to CSV with a header, and back as text."""
    path = scratch_path(spark, "csv")
    files.write_csv(panels.raw_investment(spark, sf), path, header=True)
    return files.read_table(spark, path)


def csv_single_file_report(spark, sf):
    """A sorted report in one CSV file, read back."""
    path = scratch_path(spark, "csv")
    report = reports.emissions_by_year(panels.emissions(spark, sf))
    files.write_csv(report, path, single_file=True, order_by=["year"])
    return spark.read.schema(report.schema).csv(path)


def csv_cleaned_in_place(spark, sf):
    """Raw emissions as a CSV file, cleaned onto itself and read back."""
    path = scratch_path(spark, "csv")
    files.write_csv(panels.raw_emissions(spark, sf), path, header=True)
    panel = clean.clean_emissions(files.read_table(spark, path), FULL_YEARS, panels.RAW_ALIASES)
    files.write_csv(panel, path, mode="overwrite")
    return spark.read.schema(panel.schema).csv(path)


def csv_joined_panel(spark, sf):
    """A cleaned panel, as large as its table, in one CSV file with a header, read back."""
    path = scratch_path(spark, "csv")
    panel = cleaned_emissions(spark, sf)
    files.write_csv(panel, path, header=True, single_file=True, order_by=["country", "year"])
    return spark.read.schema(panel.schema).option("header", True).csv(path)


def csv_lag_folders(spark, sf):
    """The lagged panel as one CSV folder per lag, read back with the lag from the folder."""
    path = scratch_path(spark, "csv")
    panel = rounded(generation_lags(spark, sf), 5, "investment_amount", "renewable_generated")
    files.write_by_lag(panel, path)
    stored = panel.drop("lag").schema.add("lag", T.IntegerType())
    return spark.read.schema(stored).csv(path)


# Profile


def profiles(suffix: str, raw: Query) -> dict[str, Query]:
    """The profile of one raw table.

    The raw tables are joins, and the distinct counts read their input once per column. They
    therefore work on a columnar copy.
    """

    def copy(spark, sf):
        return materialise(raw(spark, sf), "profile")

    return {
        f"profile_schema{suffix}": lambda spark, sf: profile.schema_rows(raw(spark, sf)),
        f"profile_sample{suffix}": lambda spark, sf: profile.sample(
            raw(spark, sf), 25, raw(spark, sf).columns
        ),
        f"profile_summary{suffix}": lambda spark, sf: rounded(
            profile.summary(raw(spark, sf)), 4, "mean", "stddev"
        ),
        f"profile_nulls{suffix}": lambda spark, sf: profile.blank_counts(raw(spark, sf)),
        f"profile_distinct{suffix}": lambda spark, sf: profile.distinct_counts(copy(spark, sf)),
    }


def line_items(spark, sf):
    return panels.table(spark, sf, "lineitem")


def distinct_estimates(spark, sf):
    """The exact number of distinct values of each column, and whether the estimate is near it."""
    items = line_items(spark, sf)
    estimate = F.col("estimate.distinct_values")
    exact = F.col("exact.distinct_values")
    return (
        profile.distinct_counts(items)
        .alias("exact")
        .join(profile.distinct_counts(items, approx=True).alias("estimate"), "column")
        .select("column", exact, (F.abs(estimate - exact) <= 0.15 * exact).alias("within_15_percent"))
    )


def merged_sketches(spark, sf):
    """Distinct values of line items, exact and as estimated from sketches kept by ship month.

    The sketches are written, read back and united; the line items are not read for that.
    """
    items = line_items(spark, sf)
    exact = profile.distinct_counts(items)
    monthly = items.withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    kept = materialise(profile.distinct_sketches(monthly, ["month"]), "sketches")
    estimate = profile.sketched_counts(kept).withColumnRenamed("distinct_values", "estimate")
    near = F.abs(F.col("estimate") - F.col("distinct_values")) <= 0.15 * F.col("distinct_values")
    return exact.join(estimate, "column").select(
        "column", "distinct_values", near.alias("within_15_percent")
    )


def large_sums(spark, sf):
    """Sums of figures of 1e12 and more, whose cents a double cannot add exactly."""
    items = line_items(spark, sf)
    figure = F.col("l_extendedprice") + F.lit(1e12)
    sums = items.groupBy("l_suppkey").agg(
        exact_sum(figure).alias("large"), exact_sum(figure - F.lit(1e12)).alias("rests")
    )
    return rounded(sums, 6, "rests")


# Names


def raw_names(spark, sf):
    """Rows per raw name: names are counted before they are looked up."""
    raw = panels.raw_emissions(spark, sf).groupBy(F.col("Country").alias("raw_name"))
    return raw.agg(F.count(F.lit(1)).alias("rows")).withColumn("country", F.col("raw_name"))


def harmonise_country(spark, sf):
    """Raw names, their common names and their rows."""
    return names.harmonise(raw_names(spark, sf), panels.RAW_ALIASES)


def harmonise_country_table(spark, sf):
    """Rows per common name with the aliases in a frame: a former name of every nation."""
    common = F.lower("n_name")
    aliases = panels.table(spark, sf, "nation").select(
        F.concat(common, F.lit(" (formerly x)")).alias("alias"), common.alias("canonical")
    )
    harmonised = names.harmonise(raw_names(spark, sf), aliases)
    return harmonised.groupBy("country").agg(F.sum("rows").alias("rows"))


def country_mismatch(spark, sf):
    """Emission names, lower-cased but not harmonised, that no investment row has once cleaned."""
    mine = panels.raw_emissions(spark, sf).select(F.lower("Country").alias("country"))
    return names.unmatched(mine, cleaned_investment(spark, sf), "country")


def unit_normalise(spark, sf):
    """Rows and normalised sum of each unit."""
    panel = panels.generation(spark, sf, ["unit", "value"])
    return panel.groupBy("unit").agg(
        F.count(F.lit(1)).alias("rows"), F.round(exact_sum(F.col("value")), 3).alias("value")
    )


# Relations


def co2_generation_panel(spark, sf):
    """The joined panel through temporary views and SQL."""
    files.publish(
        emissions_totals=reports.emissions_country_year(panels.emissions(spark, sf)),
        generation_totals=reports.generation_country_year(country_generation(spark, sf), digits=2),
    )
    return spark.sql(
        "SELECT country, year, total_emission, renewable_generated "
        "FROM emissions_totals JOIN generation_totals USING (country, year)"
    )


def emission_lags(spark, sf):
    return reports.investment_emissions_lags(
        country_supply_investment(spark, sf), panels.emissions(spark, sf)
    )


def generation_lags(spark, sf):
    return reports.investment_generation_lags(
        panels.investment(spark, sf), country_generation(spark, sf)
    )


# Model


def model_inputs(spark, sf, copies=None):
    """Generation reduced per supplier, technology and year before suppliers are joined."""
    columns = ["country", "year", "technology", "value"]
    return (
        panels.generation(spark, sf, columns, reduce=model.supplier_points, copies=copies),
        panels.investment(spark, sf),
    )


def ml_coefficients(spark, sf):
    """Coefficients of the model, the rarest label of each category left out."""
    frame = model.training_frame(*model_inputs(spark, sf))
    fitted, _ = reports.fit_investment_impact(frame)
    return rounded(model.coefficients(fitted), 5, "coefficient")


def ml_pair_moments(spark, sf):
    """Sums over all pairs of generation and investment rows, from the reduced frame."""
    moments = model.moments(model.training_frame(*model_inputs(spark, sf)))
    sums = [name for name in moments.columns if name.startswith("sum_")]
    return moments.select(
        *model.CATEGORIES,
        "pairs",
        *[F.round(F.col(name) / F.col("pairs"), 5).alias(name.replace("sum", "mean")) for name in sums],
    )


def ml_predictions(spark, sf):
    """Predictions of the held-out investment rows, with the sum of the labels they stand for."""
    scored = reports.investment_impact_predictions(*model_inputs(spark, sf))
    return scored.select(
        *model.KEYS,
        *model.CATEGORIES,
        F.round("amount", 5).alias("amount"),
        "pairs",
        F.round(F.col("value") * F.col("pairs"), 3).alias("sum_value"),
        F.round("prediction", 4).alias("prediction"),
    )


QUERIES: dict[str, Query] = {
    # Sources and sinks
    "csv_roundtrip": csv_roundtrip,
    "csv_header_roundtrip": csv_header_roundtrip,
    "csv_single_file_report": csv_single_file_report,
    "csv_cleaned_in_place": csv_cleaned_in_place,
    "csv_joined_panel": csv_joined_panel,
    "csv_lag_folders": csv_lag_folders,
    # Profile
    **profiles("", panels.raw_investment),
    **profiles("_emissions", panels.raw_emissions),
    **profiles("_generation", panels.raw_generation),
    "profile_summary_lineitem": lambda spark, sf: rounded(
        profile.summary(line_items(spark, sf)), 3, "mean", "stddev"
    ),
    "profile_nulls_lineitem": lambda spark, sf: profile.blank_counts(line_items(spark, sf)),
    "profile_distinct_lineitem": lambda spark, sf: profile.distinct_counts(line_items(spark, sf)),
    "profile_distinct_approx_lineitem": distinct_estimates,
    "profile_distinct_merged_lineitem": merged_sketches,
    "exact_large_sums": large_sums,
    # Cleaning
    "clean_emissions": cleaned_emissions,
    "clean_emissions_count": lambda spark, sf: cleaned_emissions(spark, sf).agg(
        F.count(F.lit(1)).alias("rows")
    ),
    "clean_generation": cleaned_generation,
    "clean_investment": cleaned_investment,
    "clean_investment_all_columns": lambda spark, sf: cleaned_investment(
        spark, sf, keep_raw=True
    ),
    "investment_filtered": lambda spark, sf: cleaned_investment(
        spark, sf, countries=FILTER_COUNTRIES, technology=FILTER_TECHNOLOGY
    ),
    "investment_filtered_country": lambda spark, sf: cleaned_investment(
        spark, sf, countries=FILTER_COUNTRIES
    ),
    "investment_filtered_technology": lambda spark, sf: cleaned_investment(
        spark, sf, technology=FILTER_TECHNOLOGY
    ),
    "investment_filtered_country_table": lambda spark, sf: cleaned_investment(
        spark,
        sf,
        countries=panels.table(spark, sf, "supplier")
        .join(panels.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .filter(F.col("s_acctbal") > 9000)
        .select(F.lower("n_name")),
    ),
    "investment_filtered_developed": developed_investment,
    "unit_normalise": unit_normalise,
    "harmonise_country": harmonise_country,
    "harmonise_country_table": harmonise_country_table,
    "country_distinct": lambda spark, sf: names.distinct_values(
        cleaned_emissions(spark, sf), "country"
    ),
    "country_mismatch": country_mismatch,
    # Totals
    "emissions_by_year": lambda spark, sf: reports.emissions_by_year(panels.emissions(spark, sf)),
    "emissions_country_year": lambda spark, sf: reports.emissions_country_year(
        panels.emissions(spark, sf)
    ),
    "generation_country_year": lambda spark, sf: reports.generation_country_year(
        country_generation(spark, sf), digits=2
    ),
    "generation_country_year_unrounded": lambda spark, sf: rounded(
        reports.generation_country_year(country_generation(spark, sf)), 3, "renewable_generated"
    ),
    "investment_country_year": lambda spark, sf: rounded(
        reports.investment_country_year(panels.investment(spark, sf)), 5, "investment_amount"
    ),
    "generation_by_region_year": lambda spark, sf: rounded(
        reports.generation_by_region_year(
            panels.generation(spark, sf, ["region", "year", "value"], subtotal=SUM)
        ),
        3,
        "renewable_generated",
    ),
    "generation_by_type": lambda spark, sf: rounded(
        reports.generation_by_type(panels.generation(spark, sf, ["type", "value"])),
        3,
        "renewable_generated",
    ),
    "generation_by_technology_year": lambda spark, sf: rounded(
        reports.generation_by_technology_year(
            panels.generation(spark, sf, ["technology", "year", "value"], subtotal=SUM)
        ),
        3,
        "renewable_generated",
    ),
    "generation_by_technology_year_bucketed": lambda spark, sf: rounded(
        reports.generation_by_technology_year(
            panels.generation(
                spark,
                sf,
                ["technology", "year", "value"],
                subtotal=SUM,
                copies=panels.part_copies(spark, sf),
            )
        ),
        3,
        "renewable_generated",
    ),
    "country_generation_investment": lambda spark, sf: rounded(
        reports.country_generation_investment(
            panels.generation(spark, sf, ["country", "value"], subtotal=SUM),
            panels.investment(spark, sf),
        ),
        5,
        "renewable_generated",
        "investment_amount",
    ),
    # Rankings
    "top10_emitters": lambda spark, sf: rounded(
        reports.top_emitters(panels.emissions(spark, sf)), 2, "total"
    ),
    "bottom10_emitters": lambda spark, sf: rounded(
        reports.bottom_emitters(panels.emissions(spark, sf)), 2, "total"
    ),
    "top10_max_generation": lambda spark, sf: reports.top_largest_records(
        panels.generation(spark, sf, ["country", "value"], subtotal=F.max)
    ),
    # Relations
    "co2_generation_panel": co2_generation_panel,
    "corr_co2_generation": lambda spark, sf: rounded(
        reports.emissions_generation_correlation(
            panels.emissions(spark, sf), country_generation(spark, sf)
        ),
        6,
        "correlation",
    ),
    "lag_panel_emissions": lambda spark, sf: rounded(
        emission_lags(spark, sf), 4, "investment_amount"
    ),
    "lag_summary_emissions": lambda spark, sf: rounded(
        reports.investment_emissions_lag_summary(emission_lags(spark, sf)),
        2,
        "mean",
        "stddev",
        "min",
        "max",
    ),
    "lag_corr_emissions": lambda spark, sf: reports.investment_emissions_lag_correlation(
        emission_lags(spark, sf)
    ),
    "lag_panel_generation": lambda spark, sf: rounded(
        generation_lags(spark, sf), 5, "investment_amount", "renewable_generated"
    ),
    "lag_corr_generation": lambda spark, sf: rounded(
        reports.investment_generation_lag_correlation(generation_lags(spark, sf)), 6, "correlation"
    ),
    # From the raw text tables to the answer
    "raw_top10_emitters": lambda spark, sf: rounded(
        reports.top_emitters(cleaned_emissions(spark, sf)), 2, "total"
    ),
    "raw_bottom10_emitters": lambda spark, sf: rounded(
        reports.bottom_emitters(cleaned_emissions(spark, sf)), 2, "total"
    ),
    "raw_emissions_by_year": lambda spark, sf: reports.emissions_by_year(
        cleaned_emissions(spark, sf)
    ),
    "raw_generation_by_technology_year": lambda spark, sf: rounded(
        reports.generation_by_technology_year(cleaned_generation(spark, sf)),
        3,
        "renewable_generated",
    ),
    "raw_lag_corr_generation": lambda spark, sf: rounded(
        reports.investment_generation_lag_correlation(
            reports.investment_generation_lags(
                cleaned_investment(spark, sf), cleaned_generation(spark, sf)
            )
        ),
        6,
        "correlation",
    ),
    # Trend
    "trend_slopes": lambda spark, sf: rounded(
        slopes(panels.emissions(spark, sf), "total"), 4, "slope"
    ),
    "trend_top10": lambda spark, sf: rounded(
        reports.fastest_growing_emitters(panels.emissions(spark, sf)), 4, "slope"
    ),
    # Model
    "ml_training_frame": lambda spark, sf: rounded(
        model.training_frame(*model_inputs(spark, sf)), 5, "amount", "value"
    ),
    "ml_training_frame_bucketed": lambda spark, sf: rounded(
        model.training_frame(*model_inputs(spark, sf, panels.part_copies(spark, sf))),
        5,
        "amount",
        "value",
    ),
    "ml_pair_moments": ml_pair_moments,
    "ml_within_rmse": lambda spark, sf: reports.investment_impact_rmse(
        *model_inputs(spark, sf), categories=["technology"], digits=6
    ),
    "ml_impact_rmse": lambda spark, sf: reports.investment_impact_rmse(
        *model_inputs(spark, sf), digits=6
    ),
    "ml_coefficients": ml_coefficients,
    "ml_predictions": ml_predictions,
}
