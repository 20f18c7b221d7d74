"""Air-traffic tables derived by arithmetic from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.schemas import FLIGHTS_FILE, MISSPELT_SCHEDULED, SCHEDULED

# The columns used of each test table. Given, so that no read opens
# files only to infer them.
TABLES = {
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
        " l_shipdate timestamp_ntz"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(TABLES[name]).parquet(path)


def _code(prefix: str, key: str) -> str:
    """Six zero-padded digits. ``lpad`` to 6 would cut longer keys and merge them."""
    digits = f"string({key})"
    return f"concat('{prefix}', lpad({digits}, greatest(6, length({digits})), '0'))"


def _clock(minutes: str) -> str:
    return (
        f"concat(lpad(string({minutes} div 60), 2, '0'), ':',"
        f" lpad(string({minutes} % 60), 2, '0'), ':00')"
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    nation = _table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).selectExpr(
        f"{_code('C', 's_suppkey')} AS carrier_code",
        "s_name AS name",
        "n_name AS country",
    )


def aircrafts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        f"{_code('N', 'p_partkey')} AS tailnum",
        """CASE WHEN p_partkey % 29 = 0 THEN NULL
                WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'CESSNA'
                ELSE upper(p_type) END AS manufacturer""",
        """CASE WHEN p_partkey % 31 = 0 THEN NULL
                WHEN p_partkey % 37 = 0 THEN 'SKYLANE'
                ELSE concat(string(100 + p_size), upper(substr(p_name, 1, 1)))
                END AS model""",
    )


def aircraft_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``aircrafts`` with every column of the source file, unknown ones null."""
    return aircrafts(spark, sf_dir).selectExpr(
        "tailnum",
        "string(NULL) AS type",
        "manufacturer",
        "string(NULL) AS issue_date",
        "model",
        "string(NULL) AS status",
        "string(NULL) AS aircraft_type",
        "string(NULL) AS engine_type",
        "string(NULL) AS year",
    )


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "lineitem")
        .selectExpr(
            "*",
            "(l_orderkey * 7 + l_partkey * 13 + l_linenumber * 101) % 1441 AS due",
            "(l_orderkey + l_partkey * 3 + l_suppkey * 5) % 200 - 60 AS shift",
        )
        .selectExpr(
            "*",
            """CASE WHEN l_partkey % 97 = 0 THEN (due + 720) % 1440
                    ELSE (due + shift + 1440) % 1440 END AS departed""",
        )
        .selectExpr(
            "l_orderkey * 10 + l_linenumber AS flight_id",
            f"{_code('C', 'l_suppkey')} AS carrier_code",
            "date(l_shipdate) AS flight_date",
            f"""CASE WHEN l_partkey % 53 = 0 THEN NULL
                     ELSE {_code('N', 'l_partkey')} END AS tail_number""",
            f"""CASE WHEN due = 1440 THEN '24:00:00'
                     ELSE {_clock('due')} END AS {SCHEDULED}""",
            f"""CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN NULL
                     WHEN departed = 0 AND l_linenumber % 2 = 1 THEN '24:00:00'
                     ELSE {_clock('departed')} END AS actual_departure_time""",
        )
    )


def flight_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flights`` with every column of the source file as text, unknown ones null.

    Every 41st date is malformed, as a typed read has to notice.
    """
    known = flights(spark, sf_dir).withColumnRenamed(SCHEDULED, MISSPELT_SCHEDULED)
    date = "date_format(flight_date, 'yyyy-MM-dd')"
    known = known.selectExpr(
        "* EXCEPT (flight_date)",
        f"CASE WHEN flight_id % 41 = 0 THEN concat({date}, '?') ELSE {date} END"
        " AS flight_date",
    )
    return known.selectExpr(
        *(
            name if name in known.columns else f"string(NULL) AS {name}"
            for name in FLIGHTS_FILE.names
        )
    )


def flight_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flight_file_rows`` as lines (line), some of which no typed read can take.

    Of every 43rd flight the line is cut short, of every 47th it has fields to spare, of
    every 53rd a quote is left open; every 41st date is malformed.
    """
    rows = flight_file_rows(spark, sf_dir)
    text = f"to_csv(struct({', '.join(rows.columns)}))"
    return rows.selectExpr(
        f"""CASE WHEN flight_id % 43 = 0 THEN substring_index({text}, ',', 5)
                 WHEN flight_id % 47 = 0 THEN concat({text}, ',surplus,1')
                 WHEN flight_id % 53 = 0 THEN replace({text}, ',C', ',"C')
                 ELSE {text} END AS line"""
    )


def flight_file_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """``flight_file_rows`` in four parts, each with columns in an order of its own; the
    last has no flight numbers, and calls the departure column by its right name."""
    rows = flight_file_rows(spark, sf_dir).withColumn(
        "flight_number", F.expr("string(flight_id % 1000)")
    )
    names = rows.columns
    orders = [names, names[::-1], names[5:] + names[:5], names[::2] + names[1::2]]
    parts = [
        rows.filter(F.col("flight_id") % 4 == k).select(*order)
        for k, order in enumerate(orders)
    ]
    parts[3] = parts[3].drop("flight_number").withColumnRenamed(MISSPELT_SCHEDULED, SCHEDULED)
    return parts
