"""Result tables in a relational database."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.sources.tables import DAY

CONNECTIONS = 8
LOADING = "_load"  # ends the name of the table that rows are loaded into


def dated(df: DataFrame, day: str) -> DataFrame:
    """The result with its day as first column."""
    return df.drop(DAY).select(F.lit(day).alias(DAY), "*")


class Connection:
    """A driver-side connection as Spark's own JDBC writer would open it."""

    def __init__(self, spark: SparkSession, url: str, table: str, properties: dict[str, str]):
        jvm = spark._jvm
        self._dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
        given = spark._jvm.PythonUtils.toScalaMap(properties)
        options = jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(url, table, given)
        self._open = self._dialect.createConnectionFactory(options).apply(-1)

    def quoted(self, column: str) -> str:
        return self._dialect.quoteIdentifier(column)

    def run(self, statements: list[str]) -> None:
        """All statements in one transaction, or none of them."""
        self._open.setAutoCommit(False)
        statement = self._open.createStatement()
        try:
            for text in statements:
                statement.executeUpdate(text)
            self._open.commit()
        except BaseException:
            self._open.rollback()
            raise
        finally:
            statement.close()

    def close(self) -> None:
        self._open.close()


Connect = Callable[[SparkSession, str, str, dict[str, str]], Connection]


def publication(table: str, columns: list[str]) -> list[str]:
    """What makes the loaded rows the table's: readers see the old rows until it is committed."""
    listed = ", ".join(columns)
    return [
        f"DELETE FROM {table}",
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {table}{LOADING}",
    ]


def replace_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    connections: int = CONNECTIONS,
    connect: Connect = Connection,
) -> None:
    """Replace the rows of ``table``, keeping its definition.

    Rows are loaded over few connections into a table beside it, and moved inside the database in
    one transaction, so readers see all old rows or all new ones, and a failed load leaves the old
    ones. A table that is absent is made first. Credentials come from the caller's
    ``properties``.
    """
    properties = properties or {}

    def written(rows: DataFrame, name: str, mode: str) -> None:
        writer = rows.write.format("jdbc").mode(mode).options(**properties)
        writer.options(url=url, dbtable=name, numPartitions=str(connections)).save()

    written(df, f"{table}{LOADING}", "overwrite")
    # Makes the table if need be.
    written(df.limit(0), table, "append")
    connection = connect(df.sparkSession, url, table, properties)
    try:
        connection.run(publication(table, [connection.quoted(c) for c in df.columns]))
        connection.run([f"DROP TABLE {table}{LOADING}"])
    finally:
        connection.close()
