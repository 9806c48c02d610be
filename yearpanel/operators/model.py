"""Regression of generation on investment, technology and region, with Spark ML.

The model is defined on every pair of a generation row and an investment row of the same country
and year. That many pairs cannot be written out at scale, and need not be: least squares and
RMSE depend on the pairs only through counts, sums and sums of squares. Each side is therefore
first reduced to two weighted points per group, mean - deviation and mean + deviation with half
of the group's rows each, which have the same count, sum and sum of squares as the rows. Joining
the reduced sides gives a weighted frame whose size depends on the number of groups only, and on
which Spark ML computes the same coefficients and the same RMSE as on all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["country", "year"]
CATEGORIES = ["technology", "region"]
LABEL = "value"
NUMERIC = "amount"
WEIGHT = "pairs"


def two_points(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, rows: str | None = None
) -> DataFrame:
    """Two rows per group that keep its count, sum and sum of squares of ``value``.

    ``rows`` names the column with the number of rows that a row stands for, if it was reduced
    before. Rows without a value are left out. One shuffle, combined on the map side.
    """
    mean, deviation, v = F.col("_mean"), F.col("_deviation"), F.col(value)
    if rows is None:
        moments = [F.count(F.lit(1)), F.avg(value), F.stddev_pop(value)]
    else:
        n = F.sum(rows)
        average = F.sum(v * F.col(rows)) / n
        spread = F.sum(v * v * F.col(rows)) / n - average * average
        moments = [n, average, F.sqrt(F.greatest(spread, F.lit(0.0)))]
    count, average, spread = moments
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(count.alias("_rows"), average.alias("_mean"), spread.alias("_deviation"))
        .select(
            *keys,
            F.explode(F.array(mean - deviation, mean + deviation)).alias(value),
            (F.col("_rows") / 2).alias(weight),
        )
    )


def supplier_points(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Generation rows reduced by finer keys; ``rows`` is the number that a row stands for."""
    return two_points(items, keys, LABEL, "rows")


def label_points(generation: DataFrame) -> DataFrame:
    """The generation side, reduced: country, year, technology, value, label_rows.

    A ``rows`` column tells how many rows a row stands for.
    """
    rows = "rows" if "rows" in generation.columns else None
    return two_points(generation, [*KEYS, "technology"], LABEL, "label_rows", rows)


def flow_points(investment: DataFrame) -> DataFrame:
    """The investment side, reduced: country, year, region, amount, flow_rows."""
    return two_points(investment, [*KEYS, "region"], NUMERIC, "flow_rows")


def paired(labels: DataFrame, flows: DataFrame) -> DataFrame:
    """country, year, technology, region, amount, value, pairs: the weighted training frame."""
    pairs = (F.col("label_rows") * F.col("flow_rows")).alias(WEIGHT)
    return labels.join(flows, KEYS).select(*KEYS, *CATEGORIES, NUMERIC, LABEL, pairs)


def training_frame(generation: DataFrame, investment: DataFrame) -> DataFrame:
    return paired(label_points(generation), flow_points(investment))


def scoring_frame(labels: DataFrame, investment: DataFrame) -> DataFrame:
    """Each investment row with every technology its country generated with in that year.

    Every pair with these features gets the same prediction, so the frame has one row for all of
    them, their number in ``pairs`` and their mean label, from the reduced ``labels``. It grows
    with the investment rows times the number of technologies, not with the pairs.
    """
    rows = F.sum("label_rows")
    means = labels.groupBy(*KEYS, "technology").agg(
        (F.sum(F.col(LABEL) * F.col("label_rows")) / rows).alias(LABEL),
        rows.cast("bigint").alias(WEIGHT),
    )
    flows = investment.filter(F.col(NUMERIC).isNotNull()).select(*KEYS, "region", NUMERIC)
    return flows.join(means, KEYS).select(*KEYS, *CATEGORIES, NUMERIC, LABEL, WEIGHT)


def in_training(keys: Sequence[str] = KEYS, fraction: float = 0.7, seed: str = "") -> Column:
    """True for about ``fraction`` of the key values, the same ones in every run.

    A row's side depends on its key alone. It does not change when a lost task runs again, and
    all pairs of a country and year are on the same side.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(key).cast("string") for key in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < fraction * 2**32


def random_split(
    investment: DataFrame, fraction: float = 0.7, seed: int | None = None
) -> list[DataFrame]:
    """Training and test investment rows at random; an investment takes all its pairs along."""
    return investment.randomSplit([fraction, 1 - fraction], seed)


def labels_by_pairs(frame: DataFrame, category: str) -> list[str]:
    """The labels of a category, those of most pairs first and ties in the alphabet."""
    counted = frame.groupBy(category).agg(F.sum(WEIGHT).alias("n"))
    return [row[0] for row in counted.orderBy(F.desc("n"), category).collect()]


def impact_pipeline(
    categories: Sequence[str] = CATEGORIES,
    handle_invalid: str = "error",
    labels: Sequence[Sequence[str]] | None = None,
) -> Pipeline:
    """Index and encode the categories, assemble the features, regress with pair weights.

    ``handle_invalid`` says what a category unseen in training does: ``error`` or ``skip``.
    ``labels`` gives the order of each category's labels, of which the last one is left out. By
    default labels are ordered by the rows of the weighted frame.
    """
    indexes = [f"{name}_index" for name in categories]
    vectors = [f"{name}_vector" for name in categories]
    if labels is None:
        indexers = [
            StringIndexer(
                inputCols=list(categories), outputCols=indexes, handleInvalid=handle_invalid
            )
        ]
    else:
        indexers = [
            StringIndexerModel.from_labels(own, name, index, handle_invalid)
            for own, name, index in zip(labels, categories, indexes, strict=True)
        ]
    return Pipeline(
        stages=[
            *indexers,
            OneHotEncoder(inputCols=indexes, outputCols=vectors),
            VectorAssembler(inputCols=[NUMERIC, *vectors], outputCol="features"),
            LinearRegression(featuresCol="features", labelCol=LABEL, weightCol=WEIGHT),
        ]
    )


def coefficients(model: PipelineModel) -> DataFrame:
    """feature and coefficient of a pipeline fitted with given labels, without the last of each."""
    *indexers, _, _, regression = model.stages
    names = ["intercept", NUMERIC]
    for indexer in indexers:
        names += [f"{indexer.getInputCol()}={label}" for label in indexer.labels[:-1]]
    values = [regression.intercept, *regression.coefficients.toArray().tolist()]
    rows = list(zip(names, values, strict=True))
    return SparkSession.active().createDataFrame(rows, "feature string, coefficient double")


def predictions(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """The frame with a ``prediction`` column; lazy."""
    return model.transform(frame).select(*frame.columns, "prediction")


def evaluate_rmse(scored: DataFrame) -> float:
    """RMSE over the pairs as a number (a Spark job)."""
    evaluator = RegressionEvaluator(
        labelCol=LABEL, predictionCol="prediction", weightCol=WEIGHT, metricName="rmse"
    )
    return evaluator.evaluate(scored)


def rmse(scored: DataFrame, digits: int | None = None) -> DataFrame:
    """RMSE over the pairs and their number as a one-row frame; lazy."""
    squared = F.col(WEIGHT) * F.pow(F.col(LABEL) - F.col("prediction"), 2)
    error = F.sqrt(F.sum(squared) / F.sum(WEIGHT))
    return scored.agg(
        (error if digits is None else F.round(error, digits)).alias("rmse"),
        F.sum(WEIGHT).cast("bigint").alias("pairs"),
    )


def moments(frame: DataFrame, by: Sequence[str] = CATEGORIES) -> DataFrame:
    """What least squares reads from the pairs: their number, sums and products, per group."""
    weight, x, y = F.col(WEIGHT), F.col(NUMERIC), F.col(LABEL)
    return frame.groupBy(*by).agg(
        F.sum(weight).cast("bigint").alias("pairs"),
        F.sum(weight * x).alias("sum_amount"),
        F.sum(weight * y).alias("sum_value"),
        F.sum(weight * x * x).alias("sum_amount_squared"),
        F.sum(weight * y * y).alias("sum_value_squared"),
        F.sum(weight * x * y).alias("sum_product"),
    )
