"""SQL twins of the registered queries, for DuckDB over the same tables.

They are written from the definitions and not from the Spark plans: the lagged panels join once
per lag, and the model queries work on every pair of rows and solve the normal equations.
"""

from __future__ import annotations

from yearpanel.functions.names import DEVELOPED_COUNTRIES


def exact(column: str) -> str:
    """A sum that does not depend on the order of addition."""
    return f"CAST(sum(CAST({column} AS DECIMAL(38,6))) AS DOUBLE)"


def rounded(column: str, digits: int = 2) -> str:
    """The same, rounded."""
    return f"CAST(round(sum(CAST({column} AS DECIMAL(38,6))), {digits}) AS DOUBLE)"


# Typed panels

EMISSIONS = """emissions AS (
  SELECT n_name AS country, CAST(year(o_orderdate) AS INT) AS year,
         o_totalprice AS total, c_acctbal AS per_capita
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

INVESTMENT = """investment AS (
  SELECT n_name AS country, CAST(year(o_orderdate) AS INT) AS year,
         o_orderpriority AS technology, r_name AS region, o_totalprice * 0.001 AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

GENERATION = """generation AS (
  SELECT n_name AS country, CAST(year(l_shipdate) AS INT) AS year, p_type AS technology,
         l_linestatus AS type, r_name AS region,
         CASE l_returnflag WHEN 'A' THEN 'MW' WHEN 'N' THEN 'GWh' ELSE 'TJ' END AS unit,
         CASE l_returnflag WHEN 'A' THEN l_quantity / 1000 ELSE l_quantity END AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""

SUPPLY_INVESTMENT = """supply_investment AS (
  SELECT n_name AS country, CAST(year(l_shipdate) AS INT) AS year,
         l_extendedprice * (1 - l_discount) AS amount
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

# Raw text panels


def raw_country(key: str) -> str:
    return (
        f"CASE WHEN {key} % 3 = 0 THEN lower(n_name) "
        f"WHEN {key} % 7 = 0 AND n_nationkey < 3 THEN n_name || ' (FORMERLY X)' ELSE n_name END"
    )


def raw_figure(key: str, value: str, digits: int = 2, nulls: bool = True) -> str:
    null = f"WHEN {key} % 89 = 0 THEN NULL" if nulls else ""
    text = f"CAST(CAST({value} AS DECIMAL(18,{digits})) AS VARCHAR)"
    return f"CASE WHEN {key} % 97 = 0 THEN 'n/a' {null} ELSE {text} END"


def raw_year(key: str, date: str) -> str:
    return f"CASE WHEN {key} % 101 = 0 THEN 'n/a' ELSE CAST(year({date}) AS VARCHAR) END"


RAW_EMISSIONS = f"""raw_emissions AS (
  SELECT {raw_year("o_orderkey", "o_orderdate")} AS "Year",
         {raw_country("o_orderkey")} AS "Country",
         {raw_figure("o_orderkey", "o_totalprice")} AS "Total",
         CASE WHEN o_orderkey % 83 = 0 THEN NULL
              ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS "Per Capita"
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

RAW_GENERATION = f"""raw_generation AS (
  SELECT {raw_year("l_orderkey", "l_shipdate")} AS " Years ",
         {raw_country("l_orderkey")} AS "IRENA Menu Label ",
         p_type AS " Technology", l_linestatus AS "Type", r_name AS " UN Region English ",
         CASE l_returnflag WHEN 'A' THEN 'MW' WHEN 'N' THEN 'GWh' ELSE 'TJ' END AS "Unit",
         {raw_figure("l_orderkey", "l_quantity")} AS " Values "
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""

RAW_INVESTMENT = f"""raw_investment AS (
  SELECT {raw_country("o_orderkey")} AS "Country/Area",
         {raw_year("o_orderkey", "o_orderdate")} AS "Year",
         {raw_figure("o_orderkey", "o_totalprice * 0.001", 5, nulls=False)}
           AS "Amount (2020 USD million)",
         o_orderpriority AS "Technology", r_name AS "Region",
         CASE WHEN o_orderkey % 79 = 0 THEN NULL ELSE o_orderstatus END AS "Status"
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def as_year(column: str) -> str:
    return f"TRY_CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS INT)"


def as_country(column: str) -> str:
    return (
        f"CASE WHEN lower({column}) IN ('nation_0 (formerly x)', 'nation_1 (formerly x)', "
        f"'nation_2 (formerly x)') THEN substr(lower({column}), 1, 8) ELSE lower({column}) END"
    )


CLEAN_EMISSIONS = f"""{RAW_EMISSIONS}, emissions AS (
  SELECT {as_country('"Country"')} AS country, {as_year('"Year"')} AS year,
         TRY_CAST("Total" AS DOUBLE) AS total, TRY_CAST("Per Capita" AS DOUBLE) AS per_capita
  FROM raw_emissions
  WHERE {as_year('"Year"')} BETWEEN 1995 AND 2000 AND "Country" IS NOT NULL
    AND "Total" IS NOT NULL AND "Per Capita" IS NOT NULL)"""

CLEAN_GENERATION = f"""{RAW_GENERATION}, figures AS (
  SELECT *, {as_year('" Years "')} AS year, TRY_CAST(" Values " AS DOUBLE) AS figure
  FROM raw_generation), generation AS (
  SELECT {as_country('"IRENA Menu Label "')} AS country, year, " Technology" AS technology,
         "Type" AS type, " UN Region English " AS region, "Unit" AS unit,
         CASE "Unit" WHEN 'MW' THEN figure / 1000 ELSE figure END AS value
  FROM figures WHERE year BETWEEN 1995 AND 2000 AND figure IS NOT NULL)"""

CLEAN_INVESTMENT = f"""{RAW_INVESTMENT}, complete AS (
  SELECT *, {as_country('"Country/Area"')} AS "Country",
         TRY_CAST("Amount (2020 USD million)" AS DOUBLE) AS "TotalFinanceFlow"
  FROM raw_investment
  WHERE {as_year('"Year"')} BETWEEN 1995 AND 2000 AND "Status" IS NOT NULL), investment AS (
  SELECT "Country" AS country, {as_year('"Year"')} AS year, "Technology" AS technology,
         "Region" AS region, "TotalFinanceFlow" AS amount
  FROM complete)"""

# Profiles


def unpivoted(source: str, columns: list[str], query: str) -> str:
    """``query`` once per column, as one result."""
    return " UNION ALL ".join(
        query.format(source=source, column='"' + name + '"', name=name, position=i)
        for i, name in enumerate(columns, start=1)
    )


def raw_profiles(
    suffix: str, source: str, cte: str, columns: list[str]
) -> dict[str, str]:
    order = ", ".join(f'"{name}" NULLS FIRST' for name in columns)
    schema = (
        "SELECT {position} AS position, '{name}' AS \"column\", 'string' AS type, "
        "count(*) AS rows FROM {source}"
    )
    numbers = (
        "SELECT '{name}' AS \"column\", count({column}) AS count, "
        "round(avg(TRY_CAST({column} AS DOUBLE)), 4) AS mean, "
        "round(stddev_samp(TRY_CAST({column} AS DOUBLE)), 4) AS stddev, "
        "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, "
        "min({column}) AS min_text, max({column}) AS max_text FROM {source}"
    )
    nulls = (
        "SELECT '{name}' AS \"column\", "
        "count(*) FILTER ({column} IS NULL OR {column} = '') AS blank_values FROM {source}"
    )
    return {
        f"profile_schema{suffix}": f"WITH {cte} {unpivoted(source, columns, schema)}",
        f"profile_sample{suffix}": f"WITH {cte} SELECT * FROM {source} ORDER BY {order} LIMIT 25",
        f"profile_summary{suffix}": f"WITH {cte} {unpivoted(source, columns, numbers)}",
        f"profile_nulls{suffix}": f"WITH {cte} {unpivoted(source, columns, nulls)}",
        f"profile_distinct{suffix}": f"WITH {cte} {unpivoted(source, columns, DISTINCT)}",
    }


DISTINCT = (
    "SELECT '{name}' AS \"column\", (SELECT count(*) FROM "
    "(SELECT DISTINCT {column} FROM {source})) AS distinct_values"
)

LINE_TEXT = ["l_returnflag", "l_linestatus"]
LINE_WHOLE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_COLUMNS = [*LINE_WHOLE, *LINE_NUMBERS, *LINE_TEXT, "l_shipdate"]
LINE_NUMBER_SUMMARY = (
    "SELECT '{name}' AS \"column\", count({column}) AS count, round(avg({column}), 3) AS mean, "
    "round(stddev_samp({column}), 3) AS stddev, CAST(min({column}) AS DOUBLE) AS min, "
    "CAST(max({column}) AS DOUBLE) AS max, CAST(NULL AS VARCHAR) AS min_text, "
    "CAST(NULL AS VARCHAR) AS max_text FROM {source}"
)
# Whole numbers also give their smallest and largest value as text.
NO_TEXT = "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text"
WHOLE_TEXT = (
    "CAST(min({column}) AS VARCHAR) AS min_text, CAST(max({column}) AS VARCHAR) AS max_text"
)
LINE_WHOLE_SUMMARY = LINE_NUMBER_SUMMARY.replace(NO_TEXT, WHOLE_TEXT)
LINE_TEXT_SUMMARY = (
    "SELECT '{name}' AS \"column\", count({column}) AS count, CAST(NULL AS DOUBLE) AS mean, "
    "CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, "
    "min({column}) AS min_text, max({column}) AS max_text FROM {source}"
)
LINE_NULLS = "SELECT '{name}' AS \"column\", count(*) FILTER ({column} IS NULL) AS blank_values FROM {source}"

# Relations

EMISSION_TOTALS = f"""emission_totals AS (
  SELECT country, year, {rounded("total")} AS total_emission FROM emissions GROUP BY ALL)"""
GENERATION_TOTALS = f"""generation_totals AS (
  SELECT country, year, {exact("value")} AS renewable_generated FROM generation GROUP BY ALL)"""
ROUNDED_GENERATION_TOTALS = f"""generation_totals AS (
  SELECT country, year, {rounded("value")} AS renewable_generated FROM generation GROUP BY ALL)"""
INVESTMENT_TOTALS = f"""investment_totals AS (
  SELECT country, year, {exact("amount")} AS investment_amount FROM {{source}} GROUP BY ALL)"""


def one_join_per_lag(effect: str, effect_year: str, measure: str) -> str:
    """The lagged panel as six joins."""
    return "lagged AS (" + " UNION ALL ".join(
        f"SELECT {lag} AS lag, i.country, i.year AS investment_year, e.year AS {effect_year}, "
        f"i.investment_amount, e.{measure} FROM investment_totals i "
        f"JOIN {effect} e ON i.country = e.country AND i.year = e.year - {lag}"
        for lag in range(6)
    ) + ")"


EMISSION_LAGS = ", ".join(
    [
        EMISSIONS,
        SUPPLY_INVESTMENT,
        EMISSION_TOTALS,
        INVESTMENT_TOTALS.format(source="supply_investment"),
        one_join_per_lag("emission_totals", "emissions_year", "total_emission"),
    ]
)
GENERATION_LAG_TAIL = ", ".join(
    [
        GENERATION_TOTALS,
        INVESTMENT_TOTALS.format(source="investment"),
        one_join_per_lag("generation_totals", "generation_year", "renewable_generated"),
    ]
)
GENERATION_LAGS = ", ".join([GENERATION, INVESTMENT, GENERATION_LAG_TAIL])
ROUNDED_GENERATION_LAGS = """SELECT lag, country, investment_year, generation_year,
  round(investment_amount, 5) AS investment_amount,
  round(renewable_generated, 5) AS renewable_generated FROM lagged"""
GENERATION_LAG_CORRELATION = """SELECT lag,
  round(corr(investment_amount, renewable_generated), 6) AS correlation FROM lagged GROUP BY lag"""

LAG_NUMBER_SUMMARY = (
    "SELECT lag, '{name}' AS \"column\", count({column}) AS count, round(avg({column}), 2) AS mean, "
    "round(stddev_samp({column}), 2) AS stddev, round(CAST(min({column}) AS DOUBLE), 2) AS min, "
    "round(CAST(max({column}) AS DOUBLE), 2) AS max, CAST(NULL AS VARCHAR) AS min_text, "
    "CAST(NULL AS VARCHAR) AS max_text FROM {source} GROUP BY lag"
)
LAG_TEXT_SUMMARY = (
    "SELECT lag, '{name}' AS \"column\", count({column}) AS count, CAST(NULL AS DOUBLE) AS mean, "
    "CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, "
    "min({column}) AS min_text, max({column}) AS max_text FROM {source} GROUP BY lag"
)
LAG_YEAR_SUMMARY = LAG_NUMBER_SUMMARY.replace(NO_TEXT, WHOLE_TEXT)
LAG_YEARS = ["investment_year", "emissions_year"]
LAG_NUMBERS = ["investment_amount", "total_emission"]

# Model: all pairs of a generation and an investment row of one country and year

IN_TRAINING = (
    "CAST('0x' || substr(md5(concat_ws('|', '', country, CAST(year AS VARCHAR))), 1, 8) AS BIGINT)"
    " < 0.7 * 4294967296"
)
PAIRS = """pairs AS (
  SELECT g.country, g.year, g.technology, i.region, i.amount, g.value
  FROM generation g JOIN investment i ON g.country = i.country AND g.year = i.year)"""


def two_points(source: str, keys: str, value: str) -> str:
    return (
        f"SELECT {keys}, unnest([avg({value}) - stddev_pop({value}), "
        f"avg({value}) + stddev_pop({value})]) AS {value}, count(*) / 2 AS half "
        f"FROM {source} GROUP BY {keys}"
    )


# Ordinary least squares: moments of the training pairs per cell, the normal equations over
# intercept, amount and all but the rarest label of each category, and their solution by elimination.
NORMAL_EQUATIONS = """cells AS (
  SELECT technology, {region} AS region, count(*) AS n, sum(amount) AS x, sum(amount * amount) AS xx,
         sum(value) AS y, sum(amount * value) AS xy
  FROM pairs WHERE {in_training} GROUP BY ALL),
parameters AS (
  SELECT row_number() OVER (ORDER BY kind, label) AS i, kind, label FROM (
    SELECT 0 AS kind, '' AS label UNION ALL SELECT 1, ''
    UNION ALL (SELECT 2, technology FROM cells GROUP BY 2 ORDER BY sum(n), 2 DESC OFFSET 1)
    UNION ALL (SELECT 3, region FROM cells GROUP BY 2 ORDER BY sum(n), 2 DESC OFFSET 1))),
features AS (
  SELECT c.*, p.i, CAST(kind = 1 AS INT) AS b,
         CAST(kind = 0 OR (kind = 2 AND label = technology) OR (kind = 3 AND label = region) AS INT)
           AS a
  FROM cells c, parameters p),
equations AS (
  SELECT f.i, g.i AS j,
         sum(f.a * g.a * f.n + (f.a * g.b + f.b * g.a) * f.x + f.b * g.b * f.xx) AS v
  FROM features f JOIN features g ON f.technology = g.technology AND f.region = g.region
  GROUP BY ALL
  UNION ALL
  SELECT i, (SELECT count(*) + 1 FROM parameters), sum(a * y + b * xy) FROM features GROUP BY i),
matrix AS (
  SELECT list(line ORDER BY i) AS m
  FROM (SELECT i, list(CAST(v AS DOUBLE) ORDER BY j) AS line FROM equations GROUP BY i)),
elimination(p, m) AS (
  SELECT 1, m FROM matrix
  UNION ALL
  SELECT p + 1, list_transform(m, lambda line, i: CASE WHEN i = p
    THEN list_transform(line, lambda v: v / m[p][p])
    ELSE list_transform(line, lambda v, j: v - line[p] * m[p][j] / m[p][p]) END)
  FROM elimination WHERE p <= len(m)),
solution AS (
  SELECT i, kind, label, m[i][-1] AS coefficient
  FROM parameters, elimination WHERE p = len(m) + 1)"""
PREDICTION = """(SELECT coefficient FROM solution WHERE kind = 0)
  + (SELECT coefficient FROM solution WHERE kind = 1) * amount
  + coalesce((SELECT coefficient FROM solution WHERE kind = 2 AND label = technology), 0)
  + coalesce((SELECT coefficient FROM solution WHERE kind = 3 AND label = region), 0)"""


def least_squares(region: str = "region") -> str:
    equations = NORMAL_EQUATIONS.format(in_training=IN_TRAINING, region=region)
    return f"WITH RECURSIVE {GENERATION}, {INVESTMENT}, {PAIRS}, {equations}"


def held_out_rmse(region: str = "region") -> str:
    """Predictions are made once per distinct feature values and compared pair by pair."""
    return f"""{least_squares(region)},
scores AS (
  SELECT *, {PREDICTION} AS prediction FROM (
    SELECT DISTINCT technology, region, amount FROM pairs WHERE NOT ({IN_TRAINING})))
SELECT round(sqrt(avg((value - prediction) ** 2)), 6) AS rmse, count(*) AS pairs
FROM (SELECT * FROM pairs WHERE NOT ({IN_TRAINING})) JOIN scores USING (technology, region, amount)"""


COEFFICIENTS = f"""{least_squares()}
SELECT CASE kind WHEN 0 THEN 'intercept' WHEN 1 THEN 'amount' WHEN 2 THEN 'technology=' || label
                 ELSE 'region=' || label END AS feature, round(coefficient, 5) AS coefficient
FROM solution"""

PREDICTIONS = f"""{least_squares()},
labels AS (
  SELECT country, year, technology, sum(value) AS sum_value, count(*) AS pairs
  FROM generation GROUP BY ALL)
SELECT country, year, technology, region, round(amount, 5) AS amount, pairs,
       round(sum_value, 3) AS sum_value, round({PREDICTION}, 4) AS prediction
FROM (SELECT country, year, region, amount FROM investment)
JOIN labels USING (country, year) WHERE NOT ({IN_TRAINING})"""


FILTERED = f"WITH {CLEAN_INVESTMENT} SELECT * FROM investment WHERE "
IN_LIST = "country IN ('nation_1', 'nation_3', 'nation_4', 'nation_9', 'nation_12')"
IN_TABLE = """country IN (SELECT lower(n_name) FROM supplier
  JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 9000)"""

DEVELOPED = ", ".join(f"'{name}'" for name in DEVELOPED_COUNTRIES[:12])
NATION = "CAST(substr(country, 8) AS INT)"

ORACLES: dict[str, str] = {
    "csv_roundtrip": f"WITH {CLEAN_EMISSIONS} SELECT * FROM emissions",
    "csv_header_roundtrip": f"WITH {RAW_INVESTMENT} SELECT * FROM raw_investment",
    "csv_single_file_report": f"""WITH {EMISSIONS}
SELECT year, {rounded("total")} AS total FROM emissions GROUP BY year""",
    "csv_cleaned_in_place": f"WITH {CLEAN_EMISSIONS} SELECT * FROM emissions",
    "csv_joined_panel": f"WITH {CLEAN_EMISSIONS} SELECT * FROM emissions",
    "csv_lag_folders": f"WITH {GENERATION_LAGS} {ROUNDED_GENERATION_LAGS}",
    **raw_profiles(
        "_emissions", "raw_emissions", RAW_EMISSIONS, ["Year", "Country", "Total", "Per Capita"]
    ),
    **raw_profiles(
        "_generation",
        "raw_generation",
        RAW_GENERATION,
        [
            " Years ",
            "IRENA Menu Label ",
            " Technology",
            "Type",
            " UN Region English ",
            "Unit",
            " Values ",
        ],
    ),
    **raw_profiles(
        "",
        "raw_investment",
        RAW_INVESTMENT,
        ["Country/Area", "Year", "Amount (2020 USD million)", "Technology", "Region", "Status"],
    ),
    "profile_summary_lineitem": unpivoted("lineitem", LINE_WHOLE, LINE_WHOLE_SUMMARY)
    + " UNION ALL "
    + unpivoted("lineitem", LINE_NUMBERS, LINE_NUMBER_SUMMARY)
    + " UNION ALL "
    + unpivoted("lineitem", LINE_TEXT, LINE_TEXT_SUMMARY),
    "profile_nulls_lineitem": unpivoted("lineitem", LINE_COLUMNS, LINE_NULLS),
    "profile_distinct_lineitem": unpivoted("lineitem", LINE_COLUMNS, DISTINCT),
    "profile_distinct_approx_lineitem": unpivoted(
        "lineitem", LINE_COLUMNS, f"{DISTINCT}, true AS within_15_percent"
    ),
    "profile_distinct_merged_lineitem": unpivoted(
        "lineitem", LINE_COLUMNS, f"{DISTINCT}, true AS within_15_percent"
    ),
    # Doubles from 2 ** 39 to 2 ** 40 are whole multiples of 2 ** -13.
    "exact_large_sums": """SELECT l_suppkey,
    CAST(sum(CAST((l_extendedprice + 1e12) * 8192 AS HUGEINT)) AS DOUBLE) / 8192 AS large,
    round(CAST(sum(CAST((l_extendedprice + 1e12 - 1e12) * 8192 AS HUGEINT)) AS DOUBLE) / 8192, 6) AS rests
FROM lineitem GROUP BY l_suppkey""",
    "clean_emissions": f"WITH {CLEAN_EMISSIONS} SELECT * FROM emissions",
    "clean_emissions_count": f"WITH {CLEAN_EMISSIONS} SELECT count(*) AS rows FROM emissions",
    "clean_generation": f"WITH {CLEAN_GENERATION} SELECT * FROM generation",
    "clean_investment": f"WITH {CLEAN_INVESTMENT} SELECT * FROM investment",
    "clean_investment_all_columns": f"WITH {CLEAN_INVESTMENT} SELECT * FROM complete",
    "investment_filtered": f"{FILTERED} {IN_LIST} AND technology = '1-URGENT'",
    "investment_filtered_country": f"{FILTERED} {IN_LIST}",
    "investment_filtered_technology": f"{FILTERED} technology = '1-URGENT'",
    "investment_filtered_country_table": f"{FILTERED} {IN_TABLE}",
    "investment_filtered_developed": f"""WITH {CLEAN_INVESTMENT}
SELECT [{DEVELOPED}][{NATION} + 1] AS country, year, technology, region, amount
FROM investment WHERE {NATION} < 12""",
    "unit_normalise": f"""WITH {GENERATION}
SELECT unit, count(*) AS rows, {rounded("value", 3)} AS value FROM generation GROUP BY unit""",
    "harmonise_country": f"""WITH {RAW_EMISSIONS}
SELECT "Country" AS raw_name, count(*) AS rows, {as_country('"Country"')} AS country
FROM raw_emissions GROUP BY "Country" """,
    "harmonise_country_table": f"""WITH {RAW_EMISSIONS}
SELECT {as_country('"Country"')} AS country, count(*) AS rows FROM raw_emissions GROUP BY 1""",
    "country_distinct": f"WITH {CLEAN_EMISSIONS} SELECT DISTINCT country FROM emissions",
    "country_mismatch": f"""WITH {RAW_EMISSIONS}, {CLEAN_INVESTMENT}
SELECT lower("Country") AS country FROM raw_emissions EXCEPT SELECT country FROM investment""",
    "emissions_by_year": f"""WITH {EMISSIONS}
SELECT year, {rounded("total")} AS total FROM emissions GROUP BY year""",
    "emissions_country_year": f"WITH {EMISSIONS}, {EMISSION_TOTALS} SELECT * FROM emission_totals",
    "generation_country_year": f"""WITH {GENERATION}
SELECT country, year, {rounded("value")} AS renewable_generated FROM generation GROUP BY ALL""",
    "generation_country_year_unrounded": f"""WITH {GENERATION}
SELECT country, year, {rounded("value", 3)} AS renewable_generated FROM generation GROUP BY ALL""",
    "investment_country_year": f"""WITH {INVESTMENT}
SELECT country, year, {rounded("amount", 5)} AS investment_amount FROM investment GROUP BY ALL""",
    "generation_by_region_year": f"""WITH {GENERATION}
SELECT region, year, {rounded("value", 3)} AS renewable_generated FROM generation GROUP BY ALL""",
    "generation_by_type": f"""WITH {GENERATION}
SELECT type, {rounded("value", 3)} AS renewable_generated FROM generation GROUP BY ALL""",
    "generation_by_technology_year": f"""WITH {GENERATION}
SELECT technology, year, {rounded("value", 3)} AS renewable_generated
FROM generation GROUP BY ALL""",
    "country_generation_investment": f"""WITH {GENERATION}, {INVESTMENT}
SELECT country, g.renewable_generated, i.investment_amount
FROM (SELECT country, {rounded("value", 5)} AS renewable_generated FROM generation GROUP BY 1) g
JOIN (SELECT country, {rounded("amount", 5)} AS investment_amount FROM investment GROUP BY 1) i
USING (country)""",
    "top10_emitters": f"""WITH {EMISSIONS}
SELECT country, {rounded("total", 2)} AS total FROM emissions GROUP BY country
ORDER BY total DESC NULLS LAST, country LIMIT 10""",
    "bottom10_emitters": f"""WITH {EMISSIONS}
SELECT country, {rounded("total", 2)} AS total FROM emissions GROUP BY country
ORDER BY total NULLS FIRST, country LIMIT 10""",
    "top10_max_generation": f"""WITH {GENERATION}
SELECT country, max(value) AS max_generation FROM generation GROUP BY country
ORDER BY max_generation DESC NULLS LAST, country LIMIT 10""",
    "co2_generation_panel": f"""WITH {EMISSIONS}, {GENERATION}, {EMISSION_TOTALS}, {ROUNDED_GENERATION_TOTALS}
SELECT country, year, total_emission, renewable_generated
FROM emission_totals JOIN generation_totals USING (country, year)""",
    "corr_co2_generation": f"""WITH {EMISSIONS}, {GENERATION}, {EMISSION_TOTALS}, {ROUNDED_GENERATION_TOTALS}
SELECT round(corr(coalesce(total_emission, 0), coalesce(renewable_generated, 0)), 6)
  AS correlation
FROM emission_totals JOIN generation_totals USING (country, year)""",
    "lag_panel_emissions": f"""WITH {EMISSION_LAGS}
SELECT lag, country, investment_year, emissions_year,
       round(investment_amount, 4) AS investment_amount, total_emission FROM lagged""",
    "lag_summary_emissions": f"""WITH {EMISSION_LAGS}
{unpivoted("lagged", LAG_YEARS, LAG_YEAR_SUMMARY)} UNION ALL
{unpivoted("lagged", LAG_NUMBERS, LAG_NUMBER_SUMMARY)} UNION ALL
{unpivoted("lagged", ["country"], LAG_TEXT_SUMMARY)}""",
    "lag_corr_emissions": f"""WITH {EMISSION_LAGS}
SELECT lag, round(corr(investment_amount, total_emission), 3) AS correlation
FROM lagged GROUP BY lag""",
    "lag_panel_generation": f"WITH {GENERATION_LAGS} {ROUNDED_GENERATION_LAGS}",
    "lag_corr_generation": f"WITH {GENERATION_LAGS} {GENERATION_LAG_CORRELATION}",
    "raw_top10_emitters": f"""WITH {CLEAN_EMISSIONS}
SELECT country, {rounded("total", 2)} AS total FROM emissions GROUP BY country
ORDER BY total DESC NULLS LAST, country LIMIT 10""",
    "raw_bottom10_emitters": f"""WITH {CLEAN_EMISSIONS}
SELECT country, {rounded("total", 2)} AS total FROM emissions GROUP BY country
ORDER BY total NULLS FIRST, country LIMIT 10""",
    "raw_emissions_by_year": f"""WITH {CLEAN_EMISSIONS}
SELECT year, {rounded("total")} AS total FROM emissions GROUP BY year""",
    "raw_generation_by_technology_year": f"""WITH {CLEAN_GENERATION}
SELECT technology, year, {rounded("value", 3)} AS renewable_generated
FROM generation GROUP BY ALL""",
    "raw_lag_corr_generation": f"""WITH {CLEAN_GENERATION}, {CLEAN_INVESTMENT},
{GENERATION_LAG_TAIL} {GENERATION_LAG_CORRELATION}""",
    "trend_slopes": f"""WITH {EMISSIONS}
SELECT country, round(coalesce(regr_slope(total, year), 0), 4) AS slope
FROM (SELECT country, year, {exact("total")} AS total FROM emissions GROUP BY ALL)
GROUP BY country""",
    "trend_top10": f"""WITH {EMISSIONS}
SELECT country, round(slope, 4) AS slope
FROM (SELECT country, regr_slope(total, year) AS slope
      FROM (SELECT country, year, {exact("total")} AS total FROM emissions GROUP BY ALL)
      GROUP BY country)
WHERE slope > 0 ORDER BY slope DESC, country LIMIT 10""",
    "ml_training_frame": f"""WITH {GENERATION}, {INVESTMENT},
labels AS ({two_points("generation", "country, year, technology", "value")}),
flows AS ({two_points("investment", "country, year, region", "amount")})
SELECT country, year, technology, region, round(amount, 5) AS amount, round(value, 5) AS value,
       labels.half * flows.half AS pairs
FROM labels JOIN flows USING (country, year)""",
    "ml_pair_moments": f"""WITH {GENERATION}, {INVESTMENT}, {PAIRS}
SELECT technology, region, count(*) AS pairs, round(avg(amount), 5) AS mean_amount,
       round(avg(value), 5) AS mean_value, round(avg(amount * amount), 5) AS mean_amount_squared,
       round(avg(value * value), 5) AS mean_value_squared,
       round(avg(amount * value), 5) AS mean_product
FROM pairs GROUP BY ALL""",
    "ml_within_rmse": held_out_rmse(region="''"),
    "ml_impact_rmse": held_out_rmse(),
    "ml_coefficients": COEFFICIENTS,
    "ml_predictions": PREDICTIONS,
}

# The same questions, answered from bucketed copies.
for _name in ["generation_by_technology_year", "ml_training_frame"]:
    ORACLES[f"{_name}_bucketed"] = ORACLES[_name]
