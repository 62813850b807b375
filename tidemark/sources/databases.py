"""Database tables over JDBC: addresses, parallel slices, incremental conditions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# JDBC address by engine.
URL_TEMPLATES = {
    "mysql": "jdbc:mysql://{host}:{port}/{database}",
    "sqlserver": "jdbc:sqlserver://{host}:{port};encrypt=false;",
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
}
DEFAULT_ENGINE = "mysql"


def resolve_engine(database: str, engine: str | None = None, sqlserver_names: Iterable[str] = ()) -> str:
    """The named engine; else SQL Server for databases known to live there, else the default."""
    if engine:
        return engine
    lowered = database.lower()
    return "sqlserver" if any(name in lowered for name in sqlserver_names) else DEFAULT_ENGINE


def jdbc_url(engine: str, host: str, port: str | int, database: str) -> str:
    if engine not in URL_TEMPLATES:
        raise ValueError(f"unknown database engine {engine!r}")
    return URL_TEMPLATES[engine].format(host=host, port=port, database=database)


@dataclass(frozen=True)
class Slices:
    """How a table scan is shared between tasks: a numeric, date or timestamp column
    with its range. Rows outside the range, and nulls, still come in the end slices."""

    column: str
    lower: int | date | datetime
    upper: int | date | datetime
    count: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.count),
        }


@dataclass(frozen=True)
class Connection:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str | None = None
    fetch_rows: int = 10_000

    def options(self) -> dict[str, str]:
        named = {"driver": self.driver} if self.driver else {}
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "fetchsize": str(self.fetch_rows),
            **named,
        }


def table_options(connection: Connection, table: str, slices: Slices | None = None) -> dict[str, str]:
    return {**connection.options(), "dbtable": table, **(slices.options() if slices else {})}


def query_options(connection: Connection, query: str, slices: Slices | None = None) -> dict[str, str]:
    """A SELECT run by the database. With slices it is a derived table, because Spark
    does not slice its ``query`` option."""
    if slices is None:
        return {**connection.options(), "query": query}
    return table_options(connection, f"({query}) AS extract_rows", slices)


def read_table(
    spark: SparkSession, connection: Connection, table: str, slices: Slices | None = None
) -> DataFrame:
    """A table; DataFrame filters and the chosen columns are pushed to the database."""
    return spark.read.format("jdbc").options(**table_options(connection, table, slices)).load()


def read_query(
    spark: SparkSession, connection: Connection, query: str, slices: Slices | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(connection, query, slices)).load()


def range_query(table: str, column: str, condition: str | None = None) -> str:
    """The ends of a column's range among the rows under a condition, as the database's own query."""
    where = f" WHERE {condition}" if condition else ""
    return f"SELECT MIN({column}) AS lower_end, MAX({column}) AS upper_end FROM {table}{where}"


def slice_range(
    spark: SparkSession, connection: Connection, table: str, column: str, count: int, condition: str | None = None
) -> Slices | None:
    """Range of a column over the rows to be read, so an increment is cut evenly; None where there are none.

    The database computes it and sends one row.
    """
    ends = read_query(spark, connection, range_query(table, column, condition)).toDF("lower", "upper").first()
    return None if ends.lower is None else Slices(column, ends.lower, ends.upper, count)


def mark_text(mark: object) -> str:
    """A high-water mark as it stands inside a condition's quotes."""
    return str(mark).replace("'", "''")


def incremental_condition(where: str, mark: object | None) -> str | None:
    """The configured left side (``updated_at >``) with the mark; None on a first run,
    which then loads the whole table."""
    return None if mark is None else f"{where} '{mark_text(mark)}'"


def read_filtered(
    spark: SparkSession, connection: Connection, table: str, condition: str | None, slices: Slices | None = None
) -> DataFrame:
    """A table under a condition in the database's own dialect, or the whole of it.

    The condition runs in the database, inside a derived table, so the scan may
    still be sliced.
    """
    if condition is None:
        return read_table(spark, connection, table, slices)
    return read_query(spark, connection, f"SELECT * FROM {table} WHERE {condition}", slices)
