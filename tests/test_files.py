from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from yearpanel import jobs
from yearpanel.operators import clean
from yearpanel.sources import files
from yearpanel.sources.scratch import deleted_afterwards, materialise, scratch_path


@pytest.fixture
def report(spark):
    return spark.range(100).selectExpr("id % 10 as lag", "cast(id as string) as country").repartition(5)


def parts(path):
    return sorted(Path(path).glob("part-*.csv"))


def test_write_has_no_header_and_fails_on_an_existing_path(spark, report, tmp_path):
    path = str(tmp_path / "out")
    files.write_csv(report, path)
    assert spark.read.csv(path).count() == 100
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        files.write_csv(report, path)
    files.write_csv(report.limit(3), path, mode="overwrite", header=True)
    again = files.read_table(spark, path)
    assert (again.columns, again.count()) == (["lag", "country"], 3)


def test_single_file_is_sorted_and_whole(spark, report, tmp_path):
    path = str(tmp_path / "out")
    files.write_csv(report, path, single_file=True, order_by=["lag", "country"])
    (only,) = parts(path)
    lines = only.read_text().splitlines()
    assert len(lines) == 100
    assert lines == sorted(lines)


def test_a_joined_file_has_the_bytes_of_one_task(spark, tmp_path):
    """Header, quotes, line breaks and nulls as Spark writes them, over many ranges."""
    texts = F.expr("element_at(array('plain', 'with, comma', 'a \"quote\"', 'two\\nlines', null, ''), 1 + cast(id % 6 as int))")
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("number"), texts.alias("some, text"))
    for header in (False, True):
        path, one = (str(tmp_path / f"{kind}-{header}") for kind in ("joined", "one"))
        files.write_csv(df, path, header=header, single_file=True, order_by=["number"])
        df.repartition(1).sortWithinPartitions("number").write.option("header", header).csv(one)
        (joined,), (alone,) = parts(path), parts(one)
        assert joined.read_bytes() == alone.read_bytes()
        with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
            files.write_csv(df, path, single_file=True)
    files.write_csv(df.limit(0), path, mode="overwrite", header=True, single_file=True)
    assert parts(path)[0].read_text() == 'number,"some, text"\n'


def test_a_file_is_cleaned_onto_itself(spark, tmp_path):
    path = str(tmp_path / "raw")
    lines = [(str(1998 + k % 5), f"Land {k % 3}", str(k) if k % 4 else "n/a", "1") for k in range(200)]
    raw = spark.createDataFrame(lines, ["Year", "Country", "Total", "Per Capita"]).repartition(4)
    files.write_csv(raw, path, header=True)
    expected = rows(clean.clean_emissions(raw))
    panel = clean.clean_emissions(files.read_table(spark, path))
    files.write_csv(panel, path, mode="overwrite", header=True)
    again = spark.read.schema(panel.schema).option("header", True).csv(path)
    assert rows(again) == expected and 0 < len(expected) < 200
    files.write_csv(again, path, mode="overwrite", single_file=True, order_by=["year"])
    assert len(parts(path)) == 1 and rows(spark.read.schema(panel.schema).csv(path)) == expected
    assert [p.name for p in tmp_path.iterdir()] == ["raw"]


def test_an_overwrite_that_fails_leaves_the_old_files(spark, report, tmp_path):
    path = str(tmp_path / "out")
    files.write_csv(report, path)
    broken = files.read_table(spark, path).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    with pytest.raises(Exception, match="no"):
        files.write_csv(broken, path, mode="overwrite")
    assert spark.read.csv(path).count() == 100
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_one_folder_per_lag(spark, report, tmp_path):
    path = str(tmp_path / "out")
    files.write_by_lag(report, path)
    assert sorted(p.name for p in Path(path).glob("lag=*")) == [f"lag={i}" for i in range(10)]
    assert spark.read.csv(path).count() == 100


def test_published_frames_are_views(spark, report):
    files.publish(first_report=report)
    assert spark.sql("select count(*) from first_report").first()[0] == 100


def test_scratch_tables_live_in_the_shared_folder(spark, report):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(base)
    odd = report.withColumnRenamed("country", "Amount (2020 USD million)")
    written = materialise(odd, "x")
    assert written.inputFiles()[0].removeprefix("file://").startswith(base)
    assert rows(written) == rows(odd)


# The studies from raw files

ALIASED = ["Italy (including San Marino)", "Czech Republic (Czechia)", "Spain", "Turkey"]
COMMON = ["Italy", "Czechia", "Spain", "Türkiye"]


@pytest.fixture(scope="module")
def raw_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    years = range(2005, 2019)
    emissions = ["Year,Country,Total,Per Capita"]
    generation = [" Years ,IRENA Menu Label,Technology,Type,UN Region English ,Unit, Values "]
    investment = ["Country/Area,Year,Amount (2020 USD million),Technology,Region"]
    for k, (long, short) in enumerate(zip(ALIASED, COMMON)):
        region = ("Europe", "Asia")[k % 2]
        for year in years:
            emissions.append(f"{year},{long},{100 * k + (k + 1) * (year - 2000)},1.5")
            investment.append(f"{short},{year},{10 + k * year % 7},Wind,{region}")
            for technology in ("Wind", "Solar"):
                value = 5 + (k + 2) * (year % 5) + len(technology)
                generation.append(f"{year},{short},{technology},On-grid,{region},GWh,{value}")
    emissions.append("n/a,Spain,1,1")
    generation.append("2010,Spain,Wind,Off-grid,Europe,MW,n/a")
    investment.append("Spain,2010,,Wind,Europe")
    paths = {}
    tables = {"emissions": emissions, "generation": generation, "investment": investment}
    for name, lines in tables.items():
        path = folder / f"{name}.csv"
        path.write_text("\n".join(lines) + "\n")
        paths[name] = str(path)
    return {**paths, "table": paths["investment"]}


@pytest.mark.parametrize("study", list(jobs.STUDY_INPUTS))
def test_every_result_of_a_study_is_written(spark, raw_files, tmp_path, study):
    results = jobs.run_study(spark, study, raw_files)
    jobs.write_results(results, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(results)
    for name, frame in results.items():
        assert spark.read.csv(str(tmp_path / name)).count() == frame.count(), name


def test_results_of_the_emissions_study(spark, raw_files):
    results = jobs.run_study(spark, "emissions", raw_files)
    growing = [row.country for row in results["fastest_growing_emitters"].collect()]
    assert growing == ["turkey", "spain", "czech republic", "italy"]
    joined = results["emissions_generation_panel"].select("country").distinct()
    assert rows(joined) == [("czech republic",), ("italy",), ("spain",)]


def test_generation_study_uses_its_own_years(spark, raw_files):
    results = jobs.run_study(spark, "investment-generation", raw_files)
    years = [row.year for row in results["generation_by_region_year"].collect()]
    assert (min(years), max(years)) == (2006, 2017)
    lags = rows(results["investment_generation_lag_correlation"], "lag")
    assert lags == [(lag,) for lag in range(6)]


@pytest.mark.parametrize("study", list(jobs.STUDY_INPUTS))
def test_a_job_runs_to_its_end_and_leaves_no_scratch_table(spark, raw_files, tmp_path, study):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = sorted(base.iterdir())
    arguments = [study, "--out", str(tmp_path / "out"), "--single-file", "--years", "2006-2017"]
    arguments += ["--countries", "italy,czech republic", "--technology", "Wind", "--lags", "0,2"]
    for name in jobs.STUDY_INPUTS[study]:
        arguments += [f"--{name}", raw_files[name]]
    jobs.main([*arguments, "--seed", "4"])
    assert sorted(base.iterdir()) == before
    reports = [p for p in (tmp_path / "out").iterdir() if p.name not in jobs.TABLES + jobs.LAG_PANELS]
    assert reports and all(len(parts(p)) == 1 for p in reports)
    jobs.main([*arguments, "--mode", "overwrite"])
    for p in (tmp_path / "out").glob("*_lags"):
        assert sorted(x.name for x in p.glob("lag=*")) == ["lag=0", "lag=2"]


def test_scratch_tables_go_after_an_error(spark, report):
    with pytest.raises(ValueError), deleted_afterwards(spark):
        path = Path(materialise(report, "x").inputFiles()[0].removeprefix("file://")).parent
        assert path.exists()
        raise ValueError
    assert not path.exists()


def test_missing_inputs_are_named(capsys, tmp_path):
    with pytest.raises(SystemExit):
        jobs.main(["emissions", "--emissions", "x", "--out", str(tmp_path)])
    assert "--generation" in capsys.readouterr().err
