"""The generated star-schema tables read as panel inputs.

Money is summed as whole cents, so results do not depend on the order of rows
and sums stay in primitive buffers; an overflow would be an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .functions import codes
from .operators.panel import with_lags
from .operators.ranking import chunked
from .plans.features import joined_features, matrix_from_facts
from .session import stored

SEGMENTS = {"AUTOMOBILE": "001", "BUILDING": "002", "FURNITURE": "003", "HOUSEHOLD": "004", "MACHINERY": "005"}
RUN_MODELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FLOOR_YEAR = 1996
BATCH = "batch_1"



def cents(amount: str):
    return F.round(F.col(amount) * 100).cast("bigint")


def money(total):
    """Cents as an amount."""
    return total.cast("double") / 100.0


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A raw table. Its schema is read from the files once, not on every use."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def placed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the area of their customer."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        "c_nationkey",
        codes.literal_map(SEGMENTS)[F.col("c_mktsegment")].alias("segment"),
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        cents("o_totalprice").alias("price"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    return orders.join(customers, "o_custkey").withColumn(
        "state", F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")
    )


def lines_per_order(spark: SparkSession, folder: str) -> DataFrame:
    """Line items combined per order, before any join."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum(cents("l_discount")).alias("discounts"),
            F.sum(cents("l_extendedprice")).alias("extended"),
            F.count("*").alias("lines"),
        )
    )


def placed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that have line items, with the sums of those."""
    return placed_orders(spark, folder).join(lines_per_order(spark, folder), "o_orderkey")


POPULATION = "population"
FROM_LINES = {codes.UNEMPLOYMENT, "ACS5_TOTAL_POP"}


def facts(spark: SparkSession, folder: str, wanted: list[str]) -> DataFrame:
    """Sums behind the wanted kinds of facts: (geo_code, year, indicator_code, total, parts).

    Every kind is a sum, or a ratio of two sums, over the same orders, so one
    pass over the raw tables gives them all. They are combined per nation,
    segment and year before they are repeated for the nation, state and county.
    """
    orders = placed_orders(spark, folder)
    sums = [F.sum("price").alias("price"), F.count("*").alias("orders")]
    if FROM_LINES & set(wanted):
        orders = orders.join(lines_per_order(spark, folder), "o_orderkey", "left")
        sums += [F.sum(c).alias(c) for c in ("discounts", "extended", "lines")]
    finest = orders.groupBy("c_nationkey", "state", "segment", "year").agg(*sums)
    if codes.SHELTER_PRICES in wanted:
        # Prefixes have two digits: at most 100 rows.
        of_region = regions(spark, folder).filter(F.col("prefix").rlike(codes.STATE_PATTERN))
        of_region = of_region.groupBy("prefix").agg(F.max("region").alias("region"))
        finest = finest.join(F.broadcast(of_region), F.col("state") == F.col("prefix"), "left")

    nation, state, county = F.lit(codes.NATION), F.col("state"), F.concat("state", "segment")
    even_county = F.when(F.col("c_nationkey") % 2 == 0, county)
    kinds = {
        POPULATION: ([nation, state, county], "price", None),
        codes.UNEMPLOYMENT: ([nation, state, county], "discounts", "lines"),
        codes.SHELTER_PRICES: ([nation, F.col("region") if codes.SHELTER_PRICES in wanted else nation], "price", "orders"),
        "ACS1_TOTAL_POP": ([nation, state, even_county], "price", None),
        "ACS5_TOTAL_POP": ([nation, state, county], "extended", None),
    }

    def entry(area, kind, total, parts):
        return F.struct(
            area.alias("geo_code"),
            F.lit(kind).alias("indicator_code"),
            F.col(total).cast("decimal(28,0)").alias("total"),
            (F.col(parts) if parts else F.lit(None)).cast("bigint").alias("parts"),
        )

    entries = [entry(area, k, kinds[k][1], kinds[k][2]) for k in wanted for area in kinds[k][0]]
    return (
        finest.select("year", F.inline(F.array(*entries)))
        .filter(F.col("geo_code").isNotNull() & F.col("total").isNotNull())
        .groupBy("geo_code", "year", "indicator_code")
        .agg(F.sum("total").alias("total"), F.sum("parts").alias("parts"))
    )


def _value():
    """Whole sums for populations, a percentage for rates, thousands for prices."""
    mean = money(F.col("total")) / F.col("parts")
    return (
        F.when(F.col("indicator_code") == codes.UNEMPLOYMENT, F.round(mean * 100.0, 4))
        .when(F.col("indicator_code") == codes.SHELTER_PRICES, F.round(mean / 1000.0, 4))
        .otherwise(F.floor(F.col("total") / 100).cast("double"))
    )


def valued(sums: DataFrame) -> DataFrame:
    return sums.select("geo_code", "year", "indicator_code", _value().alias("value"))


def population(spark: SparkSession, folder: str) -> DataFrame:
    return facts(spark, folder, [POPULATION]).select(
        "geo_code", "year", F.floor(F.col("total") / 100).cast("bigint").alias("population")
    )


def unemployment(spark: SparkSession, folder: str) -> DataFrame:
    return valued(facts(spark, folder, [codes.UNEMPLOYMENT]))


def shelter_prices(spark: SparkSession, folder: str) -> DataFrame:
    return valued(facts(spark, folder, [codes.SHELTER_PRICES]))


def survey_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Population by two sources: ACS1 from orders, ACS5 from line items.

    ACS1 has counties for even nations only.
    """
    sums = facts(spark, folder, list(codes.SURVEY_INDICATORS.values()))
    return sums.select(
        "geo_code",
        F.concat(F.lit("Area "), "geo_code").alias("geo_name"),
        codes.area_type(F.col("geo_code")).alias("geo_type"),
        "year",
        F.substring("indicator_code", 1, 4).alias("source"),
        F.floor(F.col("total") / 100).cast("bigint").alias("population"),
    )


def indicators(spark: SparkSession, folder: str) -> DataFrame:
    """All four indicators in one long table with source, unit and batch."""
    code = F.col("indicator_code")
    wanted = [*codes.SURVEY_INDICATORS.values(), codes.UNEMPLOYMENT, codes.SHELTER_PRICES]
    return valued(facts(spark, folder, wanted)).withColumns(
        {
            "source": F.when(code == codes.UNEMPLOYMENT, "BLS")
            .when(code == codes.SHELTER_PRICES, "FRED")
            .otherwise(F.substring(code, 1, 4)),
            "unit": F.when(code == codes.UNEMPLOYMENT, "percent").when(code == codes.SHELTER_PRICES, "index").otherwise("count"),
            "etl_batch_id": F.lit(BATCH),
            "updated_at": F.lit("2024-01-01"),
        }
    )


def model_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """The two indicators that the feature matrix reads."""
    return valued(facts(spark, folder, [codes.UNEMPLOYMENT, codes.SHELTER_PRICES]))


def stacked_facts(spark: SparkSession, folder: str) -> DataFrame:
    return valued(facts(spark, folder, [POPULATION, codes.UNEMPLOYMENT, codes.SHELTER_PRICES]))


def matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Facts and fallback prices come from the same sums, so Spark reuses their shuffle."""
    known = stacked_facts(spark, folder)
    return matrix_from_facts(known, known, regions(spark, folder), FLOOR_YEAR)


def joined(spark: SparkSession, folder: str) -> DataFrame:
    known = stacked_facts(spark, folder)
    return joined_features(known, known, regions(spark, folder))


def regions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0").alias("prefix"),
        F.when(F.col("n_regionkey") < 4, F.concat(F.lit("R"), (F.col("n_regionkey") + 1).cast("string"))).alias("region"),
    )


def geography(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select(
        F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0").alias("state"), "n_name"
    )
    states = nations.select(
        F.col("state").alias("geo_code"), F.col("n_name").alias("geo_name"), F.lit("state").alias("geo_type")
    )
    segments = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("code")) for n, c in SEGMENTS.items()]))
    counties = nations.withColumn("seg", segments).select(
        F.concat("state", "seg.code").alias("geo_code"),
        F.concat_ws(" ", "n_name", "seg.name").alias("geo_name"),
        F.lit("county").alias("geo_type"),
    )
    top = table(spark, folder, "region").select(
        F.concat(F.lit("R"), (F.col("r_regionkey") + 1).cast("string")).alias("geo_code"),
        F.col("r_name").alias("geo_name"),
        F.lit("region").alias("geo_type"),
    )
    nation = (
        table(spark, folder, "nation")
        .groupBy()
        .agg(F.count("*").alias("n"))
        .select(
            F.lit(codes.NATION).alias("geo_code"),
            F.lit(codes.NATION_NAME).alias("geo_name"),
            F.lit("nation").alias("geo_type"),
        )
    )
    return nation.unionByName(top).unionByName(states).unionByName(counties)


# ---- Months -------------------------------------------------------------------


def month_values(spark: SparkSession, folder: str) -> DataFrame:
    """Order and line sums per nation and month."""
    return (
        placed_lines(spark, folder)
        .groupBy("c_nationkey", "year", "month")
        .agg(
            F.sum("price").alias("price"),
            F.count("*").alias("orders"),
            F.sum("discounts").alias("discounts"),
            F.sum("lines").alias("lines"),
        )
    )


def _period():
    return (F.col("year") * 12 + F.col("month")).cast("int").alias("period")


def month_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Order value per nation and month. Some months are missing."""
    return (
        placed_orders(spark, folder)
        .groupBy("c_nationkey", "year", "month")
        .agg(money(F.sum("price")).alias("value"))
        .select(F.col("c_nationkey").alias("entity"), _period(), "value")
    )


def month_history(spark: SparkSession, folder: str) -> DataFrame:
    """Months in the shape of the feature matrix, before lags."""
    return month_values(spark, folder).select(
        F.col("c_nationkey").alias("entity"),
        _period(),
        money(F.col("price")).alias("population"),
        (money(F.col("discounts")) / F.col("lines") * 100.0).alias("unemployment_rate"),
        (money(F.col("price")) / F.col("orders") / 1000.0).alias("rent_cpi_index"),
    )


def month_features(spark: SparkSession, folder: str) -> DataFrame:
    """Months with both lags known, ready for training."""
    lagged = with_lags(month_history(spark, folder), "entity", "period", "population", {1: "pop_lag1", 5: "pop_lag5"})
    return lagged.filter(F.col("pop_lag1").isNotNull() & F.col("pop_lag5").isNotNull())


# ---- Monthly points and landed documents --------------------------------------


def monthly_points(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly text rates per nation; published annual values for even nations.

    Rates lie below 90, but in every third year of every sixth nation they are 60
    higher, so that some years break the rule for rates. A dot stands for February of
    every fifth nation. Every twelfth series has an id of unknown kind.
    """
    raised = (F.col("c_nationkey") % 6 == 0) & (F.col("year") % 3 == 0)
    whole = F.expr("price div 100000") % 90 + F.when(raised, 60).otherwise(0)
    months = (
        placed_orders(spark, folder)
        .groupBy("c_nationkey", "year", "month")
        .agg(F.sum("price").alias("price"))
        .select("c_nationkey", "year", "month", whole.alias("number"))
    )
    missing = (F.col("month") == 2) & (F.col("c_nationkey") % 5 == 0)
    monthly = months.select(
        "c_nationkey",
        "year",
        F.concat(F.lit("M"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("period"),
        F.when(missing, F.lit(".")).otherwise(F.col("number").cast("string")).alias("value"),
    )
    annual = (
        months.filter(F.col("c_nationkey") % 2 == 0)
        .groupBy("c_nationkey", "year")
        .agg(F.expr("sum(number) div count(*)").alias("number"))
        .select("c_nationkey", "year", F.lit("M13").alias("period"), F.col("number").cast("string").alias("value"))
    )
    state = F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")
    series = F.when(
        F.col("c_nationkey") % 12 == 11, F.concat(F.lit("XXXXX"), state, F.lit(codes.STATE_SERIES_SUFFIX))
    ).otherwise(codes.series_id_for(state))
    return monthly.unionByName(annual).select(series.alias("series_id"), "year", "period", "value")


def series_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Response documents with up to one request of series each, and two bad ones."""
    point = F.struct(F.col("year").cast("string").alias("year"), "period", "value")
    by_series = monthly_points(spark, folder).groupBy("series_id").agg(F.sort_array(F.collect_list(point), False).alias("data"))
    numbered = chunked(by_series, ["series_id"], codes.IDS_PER_REQUEST, "chunk")
    docs = numbered.groupBy("chunk").agg(
        F.collect_list(F.struct(F.col("series_id").alias("seriesID"), "data")).alias("series")
    )
    docs = stored(docs, "documents")  # read for the good documents and for the bad ones
    answer = F.struct(F.lit(codes.REQUEST_OK).alias("status"), F.struct("series").alias("Results"))
    good = docs.select(F.to_json(answer).alias("doc"))
    failed = docs.select(F.to_json(F.struct(F.lit("REQUEST_NOT_PROCESSED").alias("status"), F.col("chunk"))).alias("doc"))
    broken = docs.select(F.expr("substring(to_json(named_struct('status', 'cut', 'chunk', chunk)), 1, 10)").alias("doc"))
    return good.unionByName(failed).unionByName(broken)


def table_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Header-first tables per year, survey, level and state; header order differs by survey.

    The tables of the newest year of ACS1 lack the population column.
    """
    rows = survey_rows(spark, folder).withColumns(
        {
            "state": F.substring("geo_code", 1, 2),
            "county": F.substring("geo_code", 3, 3),
            "survey": F.lower("source"),
            "amount": F.col("population").cast("string"),
        }
    )
    part = F.when(F.col("geo_type") == "county", F.col("state")).otherwise(F.lit("all"))
    cells = (
        F.when(F.col("source") == "ACS5", F.array("state", "county", "amount", "geo_name"))
        .when(F.col("year") == 2001, F.array("geo_name", "state", "county"))
        .otherwise(F.array("geo_name", "amount", "state", "county"))
    )
    header = (
        F.when(F.col("survey") == "acs5", F.array(*map(F.lit, ["state", "county", codes.POPULATION_VARIABLE, "NAME"])))
        .when(F.col("year") == 2001, F.array(*map(F.lit, ["NAME", "state", "county"])))
        .otherwise(F.array(*map(F.lit, ["NAME", codes.POPULATION_VARIABLE, "state", "county"])))
    )
    tables = rows.groupBy("year", "survey", F.col("geo_type").alias("level"), part.alias("part")).agg(
        F.collect_list(cells).alias("cells")
    )
    return tables.select("year", "survey", "level", F.to_json(F.concat(F.array(header), F.col("cells"))).alias("doc"))


def price_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly price texts of the nation and the regions by series id, dots for April."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    area = F.explode(
        F.array(
            F.lit("CUUR0000SAH1"),
            F.when(F.col("n_regionkey") < 4, F.concat(F.lit("CUUR0"), (F.col("n_regionkey") + 1).cast("string"), F.lit("00SAH1"))).otherwise("OTHER"),
        )
    )
    sums = (
        placed_orders(spark, folder)
        .groupBy("c_nationkey", "year", "month")
        .agg(F.sum("price").alias("price"), F.count("*").alias("orders"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(area.alias("series_id"), "year", "month", "price", "orders")
        .groupBy("series_id", "year", "month")
        .agg(F.sum("price").alias("price"), F.sum("orders").alias("orders"))
    )
    text = F.expr("price div (orders * 100)").cast("string")
    return sums.select(
        "series_id",
        F.make_date("year", "month", F.lit(1)).alias("obs_date"),
        F.when(F.col("month") == 4, F.lit(codes.MISSING_MARKER)).otherwise(text).alias("raw_value"),
    )


def observation_documents(spark: SparkSession, folder: str) -> DataFrame:
    one = F.struct(F.col("obs_date").cast("string").alias("date"), F.col("raw_value").alias("value"))
    docs = price_observations(spark, folder).groupBy("series_id").agg(F.sort_array(F.collect_list(one)).alias("observations"))
    return docs.select("series_id", F.to_json(F.struct("observations")).alias("doc"))


# ---- Runs and metrics -----------------------------------------------------------


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a training run of its nation, its priority as the model."""
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    year = F.year("o_orderdate")
    return (
        table(spark, folder, "orders")
        .join(customers, "o_custkey")
        .select(
            F.col("o_orderkey").cast("string").alias("run_id"),
            F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0").alias("geo_code"),
            F.col("o_orderpriority").alias("model"),
            F.md5(F.col("o_orderkey").cast("string")).alias("data_hash"),
            F.col("o_orderdate").alias("trained_at"),
            F.col("o_custkey").alias("rows"),
            (year - 5).alias("year_min"),
            year.alias("year_max"),
            F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("artifact_path"),
        )
    )


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Three test metrics per run and one of the training rows.

    Runs of pending orders have no test rmse.
    """
    price = F.col("o_totalprice")

    def metric(name, scope, value):
        return F.struct(F.lit(name).alias("metric"), F.lit(scope).alias("scope"), F.lit(-1).alias("fold"), value.alias("value"))

    each = F.array(
        metric("rmse", "test", F.when(F.col("o_orderstatus") != "P", price)),
        metric("mae", "test", price / 2),
        metric("r2", "test", F.col("o_custkey") / 1e6),
        metric("rmse", "train", price / 4),
    )
    return table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), F.inline(each))


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as keyed rows for merge tests."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.col("o_custkey").alias("cust"),
        F.col("o_totalprice").alias("value"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("source"),
    )
