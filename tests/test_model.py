from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from yearpanel.operators import model
from yearpanel.plans import reports

REGIONS = {"a": "north", "b": "south", "c": "north", "d": "east"}


@pytest.fixture(scope="module")
def panels(spark):
    rng = random.Random(11)
    generation, investment = [], []
    for country, region in REGIONS.items():
        for year in range(2000, 2010):
            # A third of all rows belongs to one country and year.
            heavy = 40 if (country, year) == ("a", 2003) else 3
            for technology in ("hydro", "solar", "wind"):
                for _ in range(rng.randint(1, heavy)):
                    generation.append((country, year, technology, rng.uniform(0, 50)))
            for _ in range(rng.randint(1, heavy)):
                amount = rng.choice([None, rng.uniform(0, 500), rng.uniform(0, 500)])
                investment.append((country, year, region, amount))
    return (
        spark.createDataFrame(
            generation, "country string, year int, technology string, value double"
        ),
        spark.createDataFrame(investment, "country string, year int, region string, amount double"),
    )


def all_pairs(panels, side=None):
    generation, investment = panels
    joined = generation.join(investment.filter("amount is not null"), ["country", "year"])
    if side is not None:
        joined = joined.filter(model.in_training() == side)
    return joined.toPandas()


def design(pairs):
    columns = [np.ones(len(pairs)), pairs.amount]
    columns += [(pairs.technology == name).astype(float) for name in ("solar", "wind")]
    columns += [(pairs.region == name).astype(float) for name in ("north", "south")]
    return np.column_stack(columns)


def test_reduced_frame_keeps_every_moment_of_the_pairs(panels):
    pairs = all_pairs(panels)
    found = {
        (row.technology, row.region): row
        for row in model.moments(model.training_frame(*panels)).collect()
    }
    for key, group in pairs.groupby(["technology", "region"]):
        row, x, y = found.pop(key), group.amount, group.value
        assert row.pairs == len(group)
        expected = [x.sum(), y.sum(), (x * x).sum(), (y * y).sum(), (x * y).sum()]
        assert list(row)[3:] == pytest.approx(expected, rel=1e-9)
    assert not found


def test_reduced_frame_does_not_grow_with_the_pairs(panels):
    frame = model.training_frame(*panels)
    groups = frame.select("country", "year", "technology", "region").distinct().count()
    assert frame.count() == 4 * groups < len(all_pairs(panels))


def test_fit_and_rmse_equal_least_squares_on_all_pairs(panels):
    fitted, held_out = reports.fit_investment_impact(model.training_frame(*panels))
    training, test = all_pairs(panels, True), all_pairs(panels, False)
    solution, *_ = np.linalg.lstsq(design(training), training.value, rcond=None)
    expected = np.sqrt(np.mean((test.value - design(test) @ solution) ** 2))
    scored = model.predictions(fitted, held_out)
    assert fitted.stages[-1].coefficients[0] == pytest.approx(solution[1], abs=1e-9)
    assert model.evaluate_rmse(scored) == pytest.approx(expected, rel=1e-9)
    row = model.rmse(scored).first()
    assert (row.rmse, row.pairs) == (pytest.approx(expected, rel=1e-9), len(test))


def test_predictions_cover_every_held_out_investment_row(panels):
    scored = reports.investment_impact_predictions(*panels).toPandas()
    test = all_pairs(panels, False)
    assert scored.pairs.sum() == len(test)
    training = all_pairs(panels, True)
    solution, *_ = np.linalg.lstsq(design(training), training.value, rcond=None)
    assert scored.prediction.to_numpy() == pytest.approx(design(scored) @ solution, abs=1e-8)


def test_split_is_repeatable_and_near_its_fraction(spark):
    keys = spark.range(20_000).select(F.col("id").alias("country"), F.lit(2000).alias("year"))
    training = keys.filter(model.in_training())
    assert training.count() == keys.repartition(7).filter(model.in_training()).count()
    assert abs(training.count() / 20_000 - 0.7) < 0.02
    other = keys.filter(model.in_training(seed="x"))
    assert training.join(other, "country", "left_anti").count() > 0


def test_random_split_parts_are_whole(panels):
    training, test = model.random_split(panels[1], seed=5)
    assert training.count() + test.count() == panels[1].count()


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_both_sides_of_the_split_hold_every_label(spark, scale):
    from yearpanel.plans.catalog import model_inputs

    frame = model.training_frame(*model_inputs(spark, f"/root/testdata/{scale}"))
    sides = frame.withColumn("training", model.in_training())
    for name in model.CATEGORIES:
        labels = sides.groupBy("training").agg(F.countDistinct(name).alias("n"))
        assert len({row.n for row in labels.collect()}) == 1


def test_unseen_label_fails_or_is_skipped(panels):
    generation, investment = panels
    frame = model.training_frame(generation, investment)
    known, unseen = frame.filter("technology <> 'wind'"), frame
    strict = model.impact_pipeline().fit(known)
    with pytest.raises(Exception, match="Unseen label"):
        model.rmse(model.predictions(strict, unseen)).collect()
    lenient = model.impact_pipeline(handle_invalid="skip").fit(known)
    kept = rows(model.predictions(lenient, unseen).select("technology").distinct())
    assert kept == [("hydro",), ("solar",)]
