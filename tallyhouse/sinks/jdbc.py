"""Writing tables into a database, so that a repeated task adds nothing.

A task that is run again, after its executor was lost or by speculation, sends its rows again, and
the database has no means to tell. So the rows go into a table of their own first, each
with a number that is the same whenever it is sent. The rest is done on one connection of the
driver, which nothing repeats: numbers that came twice are taken once, the count is compared with
what Spark has written, and only then does the new table take the place of the old one, by a
change of names, or in one transaction. A failure at any point leaves the table as it was.

Statements differ between databases; ``DIALECTS`` has those of the ones known, chosen by the URL,
and ``STANDARD`` serves the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager, suppress
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.operators.scratch import stage
from tallyhouse.sinks.counted import write_counted

#: Added to the rows on their way; no table may have a column of that name.
ROW_NUMBER = "load_row"


@dataclass(frozen=True)
class Dialect:
    """Statements over ``{table}``, the empty or full ``{new}`` and ``{old}`` beside it, and their
    bare names ``{table_name}``, ``{new_name}``, ``{old_name}``."""

    #: Makes ``new`` empty with the definition of ``table``; none: ``table`` is refilled itself.
    like: str | None
    #: Puts ``new`` in the place of ``table``.
    swap: tuple[str, ...]
    #: Whether statements can be undone together.
    transactions: bool
    #: What the definition of a table ends with, if it is left to Spark.
    options: str = ""


# Statements of the databases.
STANDARD = Dialect(None, (), True)
DIALECTS = {
    "jdbc:postgresql:": Dialect(
        "CREATE TABLE {new} (LIKE {table} INCLUDING ALL)",
        ("ALTER TABLE {table} RENAME TO {old_name}", "ALTER TABLE {new} RENAME TO {table_name}"),
        True,
    ),
    "jdbc:clickhouse:": Dialect(
        "CREATE TABLE {new} AS {table}", ("EXCHANGE TABLES {table} AND {new}",), False,
        "ENGINE = MergeTree ORDER BY tuple()",
    ),
}
DIALECTS["jdbc:ch:"] = DIALECTS["jdbc:clickhouse:"]


def dialect_of(url: str) -> Dialect:
    return next((d for prefix, d in DIALECTS.items() if url.startswith(prefix)), STANDARD)


class Session:
    """A connection of the driver."""

    def __init__(self, connection: Any):
        self._connection = connection

    def run(self, statement: str) -> None:
        with self._statement() as opened:
            opened.execute(statement)

    def number(self, query: str) -> int:
        with self._statement() as opened:
            found = opened.executeQuery(query)
            found.next()
            return found.getLong(1)

    @contextmanager
    def transaction(self) -> Iterator[None]:
        self._connection.setAutoCommit(False)
        try:
            yield
        except BaseException:
            self._connection.rollback()
            raise
        else:
            self._connection.commit()
        finally:
            self._connection.setAutoCommit(True)

    @contextmanager
    def _statement(self) -> Iterator[Any]:
        opened = self._connection.createStatement()
        try:
            yield opened
        finally:
            opened.close()


@contextmanager
def session(spark: SparkSession, url: str, properties: Mapping[str, str]) -> Iterator[Session]:
    jvm = spark._jvm
    if "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    given = jvm.java.util.Properties()
    for name, value in properties.items():
        given.setProperty(name, str(value))
    connection = jvm.java.sql.DriverManager.getConnection(url, given)
    try:
        yield Session(connection)
    finally:
        connection.close()


def _names(table: str) -> dict[str, str]:
    schema, dot, name = table.rpartition(".")
    names = {"table": name, "new": f"{name}__new", "old": f"{name}__old", "rows": f"{name}__rows"}
    return {k: schema + dot + n for k, n in names.items()} | {f"{k}_name": n for k, n in names.items()}


def _send(
    rows: DataFrame, url: str, names: Mapping[str, str], properties: Mapping[str, str],
    dialect: Dialect, batch_size: int, connections: int,
) -> int:
    """The rows, numbered, in a table of their own. A row's number tells its part and its place
    there, which are the same whenever a stored table is read."""
    numbered = rows.withColumn(ROW_NUMBER, F.monotonically_increasing_id())

    def write(counted: DataFrame) -> None:
        writer = counted.write.mode("overwrite").option("batchsize", batch_size)
        writer = writer.option("numPartitions", connections).option("createTableOptions", dialect.options)
        writer.jdbc(url, names["rows"], properties=dict(properties))

    return write_counted(numbered, write)


def _insert(into: str, columns: Sequence[str], names: Mapping[str, str]) -> str:
    listed = ", ".join(columns)
    return (
        f"INSERT INTO {into} ({listed}) SELECT {listed} FROM "
        f"(SELECT DISTINCT {ROW_NUMBER}, {listed} FROM {names['rows']}) once"
    )


def _check(opened: Session, table: str, written: int) -> None:
    found = opened.number(f"SELECT COUNT(*) FROM {table}")
    if found != written:
        raise RuntimeError(f"{written} rows were written, but {table} has {found}")


def _transaction(opened: Session, dialect: Dialect):
    return opened.transaction() if dialect.transactions else suppress()


def _load(
    rows: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_size: int,
    connections: int, dialect: Dialect | None, stored: bool, redefine: bool,
) -> int:
    if ROW_NUMBER in (c.lower() for c in rows.columns):
        raise ValueError(f"a column is called {ROW_NUMBER}")
    dialect, names, spark = dialect or dialect_of(url), _names(table), rows.sparkSession
    rows = rows if stored else stage(rows)
    beside = [names[k] for k in ("rows", "new", "old")]
    try:
        written = _send(rows, url, names, properties, dialect, batch_size, connections)
        if redefine:
            empty = rows.limit(0).write.mode("overwrite").option("createTableOptions", dialect.options)
            empty.jdbc(url, names["new"], properties=dict(properties))
        with session(spark, url, properties) as opened:
            opened.run("DROP TABLE IF EXISTS {old}".format(**names))
            if redefine:
                opened.run(_insert(names["new"], rows.columns, names))
                _check(opened, names["new"], written)
                with _transaction(opened, dialect):
                    opened.run("DROP TABLE IF EXISTS {table}".format(**names))
                    opened.run("ALTER TABLE {new} RENAME TO {table_name}".format(**names)
                               if dialect.transactions else "RENAME TABLE {new} TO {table}".format(**names))
            elif dialect.like is None:
                with opened.transaction():
                    opened.run("DELETE FROM {table}".format(**names))
                    opened.run(_insert(names["table"], rows.columns, names))
                    _check(opened, names["table"], written)
            else:
                opened.run("DROP TABLE IF EXISTS {new}".format(**names))
                opened.run(dialect.like.format(**names))
                opened.run(_insert(names["new"], rows.columns, names))
                _check(opened, names["new"], written)
                with _transaction(opened, dialect):
                    for statement in dialect.swap:
                        opened.run(statement.format(**names))
    finally:
        with suppress(Py4JError), session(spark, url, properties) as opened:
            for left in beside:
                opened.run(f"DROP TABLE IF EXISTS {left}")
    return written


def overwrite_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    batch_size: int = 5000,
    connections: int = 8,
    dialect: Dialect | None = None,
    stored: bool = False,
) -> int:
    """Replace a database table and its definition, over at most ``connections`` connections.

    Rows are staged first, so that a task that is run again sends what it sent before; ``stored``
    says that they are read from a table as it lies.
    """
    return _load(rows, url, table, properties, batch_size, connections, dialect, stored, redefine=True)


def reload_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    batch_size: int = 5000,
    connections: int = 8,
    dialect: Dialect | None = None,
    stored: bool = False,
) -> int:
    """Replace the rows of a database table and keep its definition; otherwise as
    ``overwrite_jdbc``."""
    return _load(rows, url, table, properties, batch_size, connections, dialect, stored, redefine=False)
