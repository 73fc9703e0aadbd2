"""Databases are stood in for: statements run in the SQL engine of the oracle, or are only listed;
Spark's own reader and writer are replaced."""

from contextlib import contextmanager, nullcontext
from threading import Lock, Thread
from unittest import mock

import duckdb
import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter, functions as F

from conftest import rows_of
from tallyhouse import sinks, warehouse
from tallyhouse.connections import Connections
from tallyhouse.schema import MARTS, STAR
from tallyhouse.sinks import jdbc
from tallyhouse.sinks.jdbc import DIALECTS, STANDARD, Dialect, Session, dialect_of
from tallyhouse.sources import Split, key_split, read_jdbc

SWAPPED = Dialect(
    "CREATE TABLE {new} AS FROM {table} LIMIT 0",
    ("ALTER TABLE {table} RENAME TO {old_name}", "ALTER TABLE {new} RENAME TO {table_name}"),
    True,
)


class Engine:
    """Tables that the writer and the statements share."""

    def __init__(self, repeated=0):
        self.con, self.repeated, self.statements, self.fail_at = duckdb.connect(), repeated, [], None

    def run(self, statement):
        self.statements.append(statement)
        if self.fail_at and self.fail_at in statement:
            raise RuntimeError("the connection is gone")
        self.con.execute(statement)

    def number(self, query):
        return self.con.execute(query).fetchone()[0]

    @contextmanager
    def transaction(self):
        self.con.execute("BEGIN")
        try:
            yield
        except BaseException:
            self.con.execute("ROLLBACK")
            raise
        self.con.execute("COMMIT")

    def write(self, writer, url, table, mode=None, properties=None):
        """What Spark's writer does; the first ``repeated`` rows are sent once more, by a task that
        is run again."""
        frame = writer._df.toArrow()  # noqa: F841
        self.con.execute(f"CREATE OR REPLACE TABLE {table} AS SELECT * FROM frame")
        if len(frame):
            self.con.execute(f"INSERT INTO {table} SELECT * FROM {table} LIMIT {self.repeated}")

    def rows(self, table):
        return sorted(self.con.execute(f"FROM {table}").fetchall())

    def tables(self):
        return sorted(r[0] for r in self.con.execute("SELECT table_name FROM information_schema.tables").fetchall())


@pytest.fixture
def engine(monkeypatch):
    made = Engine(repeated=3)
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda *a, **k: made.write(*a, **k))
    monkeypatch.setattr(jdbc, "session", lambda *_: nullcontext(made))
    return made


def table(spark, n=7):
    # Two equal rows are two rows.
    return spark.range(n).select((F.col("id") % 5).alias("k"), F.lit("x").alias("v")).repartition(3)


@pytest.mark.parametrize("dialect", [STANDARD, SWAPPED])
def test_a_repeated_task_adds_nothing_to_a_refilled_table(spark, engine, dialect):
    engine.con.execute("CREATE TABLE m (v VARCHAR NOT NULL, k BIGINT)")
    engine.con.execute("INSERT INTO m VALUES ('old', 99)")
    assert sinks.reload_jdbc(table(spark), "jdbc:x", "m", {}, dialect=dialect) == 7
    assert engine.rows("m") == [("x", k) for k in (0, 0, 1, 1, 2, 3, 4)]
    assert engine.tables() == ["m"]
    if dialect is STANDARD:  # the definition is the old one
        with pytest.raises(duckdb.ConstraintException):
            engine.con.execute("INSERT INTO m VALUES (NULL, 1)")


def test_a_repeated_task_adds_nothing_to_a_replaced_table(spark, engine):
    for _ in range(2):
        assert sinks.overwrite_jdbc(table(spark), "jdbc:x", "t", {}) == 7
        assert engine.rows("t") == [(k, "x") for k in (0, 0, 1, 1, 2, 3, 4)]
        assert engine.tables() == ["t"]
    assert sinks.overwrite_jdbc(table(spark, 0), "jdbc:x", "t", {}) == 0 and engine.rows("t") == []


@pytest.mark.parametrize("dialect", [STANDARD, SWAPPED])
@pytest.mark.parametrize("fail_at", ["INSERT INTO", "RENAME TO", "DELETE FROM"])
def test_a_failure_leaves_the_table_as_it_was(spark, engine, dialect, fail_at):
    engine.con.execute("CREATE TABLE m (k BIGINT, v VARCHAR)")
    engine.con.execute("INSERT INTO m VALUES (99, 'old')")
    engine.fail_at = fail_at
    reached = fail_at in str(dialect) + "INSERT INTO" + "DELETE FROM" * (dialect is STANDARD)
    if reached:
        with pytest.raises(RuntimeError, match="gone"):
            sinks.reload_jdbc(table(spark), "jdbc:x", "m", {}, dialect=dialect)
        assert engine.rows("m") == [(99, "old")]
    assert engine.tables() == ["m"]


def test_missing_rows_are_noticed_before_the_table_is_replaced(spark, engine, monkeypatch):
    engine.con.execute("CREATE TABLE m (k BIGINT, v VARCHAR)")
    whole = Engine.write

    def lossy(self, writer, url, table, mode=None, properties=None):
        whole(self, writer, url, table)
        self.con.execute(f"DELETE FROM {table} WHERE k = 4")

    monkeypatch.setattr(Engine, "write", lossy)
    with pytest.raises(RuntimeError, match="7 rows were written, but m has 6"):
        sinks.reload_jdbc(table(spark), "jdbc:x", "m", {})
    assert engine.rows("m") == []


def test_a_row_has_the_same_number_whenever_it_is_sent(spark, tmp_path):
    spark.range(1000).repartition(7).write.parquet(str(tmp_path / "t"))
    numbered = spark.read.parquet(str(tmp_path / "t")).withColumn("n", F.monotonically_increasing_id())
    assert rows_of(numbered) == rows_of(numbered) == rows_of(numbered.coalesce(2))
    assert numbered.select("n").distinct().count() == 1000
    with pytest.raises(ValueError, match="load_row"):
        sinks.reload_jdbc(spark.range(1).withColumnRenamed("id", "LOAD_ROW"), "jdbc:x", "m", {})


@pytest.mark.parametrize("url, expected", [
    ("jdbc:postgresql://h/d", [
        "DROP TABLE IF EXISTS s.m__old", "DROP TABLE IF EXISTS s.m__new",
        "CREATE TABLE s.m__new (LIKE s.m INCLUDING ALL)",
        "INSERT INTO s.m__new (id) SELECT id FROM (SELECT DISTINCT load_row, id FROM s.m__rows) once",
        "BEGIN", "ALTER TABLE s.m RENAME TO m__old", "ALTER TABLE s.m__new RENAME TO m", "END",
        "DROP TABLE IF EXISTS s.m__rows", "DROP TABLE IF EXISTS s.m__new", "DROP TABLE IF EXISTS s.m__old",
    ]),
    ("jdbc:ch://h/d", [
        "DROP TABLE IF EXISTS s.m__old", "DROP TABLE IF EXISTS s.m__new", "CREATE TABLE s.m__new AS s.m",
        "INSERT INTO s.m__new (id) SELECT id FROM (SELECT DISTINCT load_row, id FROM s.m__rows) once",
        "EXCHANGE TABLES s.m AND s.m__new",
        "DROP TABLE IF EXISTS s.m__rows", "DROP TABLE IF EXISTS s.m__new", "DROP TABLE IF EXISTS s.m__old",
    ]),
    ("jdbc:other:x", [
        "DROP TABLE IF EXISTS s.m__old", "BEGIN", "DELETE FROM s.m",
        "INSERT INTO s.m (id) SELECT id FROM (SELECT DISTINCT load_row, id FROM s.m__rows) once", "END",
        "DROP TABLE IF EXISTS s.m__rows", "DROP TABLE IF EXISTS s.m__new", "DROP TABLE IF EXISTS s.m__old",
    ]),
])
def test_statements_by_database(spark, monkeypatch, url, expected):
    """No read has a statement as its side effect: all are the driver's own."""
    done, options = [], {}

    class Listed:
        run = staticmethod(done.append)
        number = staticmethod(lambda query: 5)

        @contextmanager
        def transaction(self):
            done.append("BEGIN")
            yield
            done.append("END")

    def write(writer, url, table, mode=None, properties=None):
        options.setdefault("tables", []).append((url, table, properties))
        writer._df.write.format("noop").mode("overwrite").save()

    opened = mock.Mock(side_effect=lambda *_: nullcontext(Listed()))
    monkeypatch.setattr(jdbc, "session", opened)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    option = mock.Mock(side_effect=lambda k, v: options.__setitem__(k, v))
    plain = DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda w, k, v: (option(k, v), plain(w, k, v))[1])
    monkeypatch.setattr(DataFrameReader, "jdbc", mock.Mock(side_effect=AssertionError("a read")))
    assert sinks.reload_jdbc(spark.range(5), url, "s.m", {"driver": "d"}, connections=3) == 5
    assert done == expected
    assert options["tables"] == [(url, "s.m__rows", {"driver": "d"})]
    assert (options["batchsize"], options["numPartitions"]) == (5000, 3)
    assert all(call.args[1:] == (url, {"driver": "d"}) for call in opened.call_args_list)


def test_dialects_go_by_the_url():
    assert dialect_of("jdbc:postgresql://h/d") is DIALECTS["jdbc:postgresql:"]
    assert dialect_of("jdbc:ch://h") is dialect_of("jdbc:clickhouse://h") and dialect_of("jdbc:db2://h") is STANDARD


def test_a_session_undoes_what_fails():
    connection = mock.Mock()
    connection.createStatement.return_value.executeQuery.return_value.getLong.return_value = 4
    session = Session(connection)
    with session.transaction():
        session.run("DELETE FROM t")
    assert session.number("SELECT COUNT(*) FROM t") == 4
    with pytest.raises(ZeroDivisionError), session.transaction():
        1 / 0
    calls = [c[0] for c in connection.method_calls]
    assert (calls.count("commit"), calls.count("rollback"), calls.count("setAutoCommit")) == (1, 1, 4)
    assert connection.createStatement.return_value.close.call_count == 2


class Used:
    """Connections open at once, by what the writer is asked for."""

    def __init__(self):
        self.lock, self.now, self.most, self.tables = Lock(), 0, 0, {}

    def write(self, rows, url, table, properties, connections=None, stored=None):
        with self.lock:
            self.now += connections
            self.most = max(self.most, self.now)
        found = rows.count()
        with self.lock:
            self.now -= connections
            self.tables[table] = connections
        return found


@pytest.mark.parametrize("limit", [1, 3, 8])
def test_tables_copied_together_share_one_limit(spark, tmp_path, sf_folder, monkeypatch, limit, stored_root):
    used = Used()
    monkeypatch.setattr(warehouse, "overwrite_jdbc", used.write)
    monkeypatch.setattr(warehouse, "reload_jdbc", used.write)
    counts = warehouse.publish_star(spark, stored_root, "jdbc:x", {}, connections=limit)
    counts |= warehouse.publish_marts(spark, stored_root, "jdbc:x", {}, connections=limit)
    assert set(used.tables) == set(counts) == {*STAR, *MARTS}
    assert 1 <= used.most <= limit and not used.now


@pytest.fixture(scope="module")
def stored_root(spark, sf_folder, tmp_path_factory):
    from tallyhouse.sources.order_tables import staging_from_orders

    root = str(tmp_path_factory.mktemp("published"))
    warehouse.run(staging_from_orders(spark, sf_folder).limit(300), root)
    return root


def test_connections_are_granted_within_the_limit():
    limit, lock, state = Connections(5), Lock(), {"now": 0, "most": 0, "granted": []}

    def use(wanted):
        for _ in range(200):
            with limit.take(wanted) as granted:
                with lock:
                    state["now"] += granted
                    state["most"] = max(state["most"], state["now"])
                    state["granted"].append((wanted, granted))
                with lock:
                    state["now"] -= granted

    threads = [Thread(target=use, args=(w,)) for w in (1, 2, 5, 9, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert state["most"] <= 5 and state["now"] == 0 and len(state["granted"]) == 1000
    assert all(1 <= granted <= wanted for wanted, granted in state["granted"])
    with pytest.raises(ValueError):
        Connections(0)


KEYS = {
    "dates": [y * 10_000 + m * 100 + d for y in range(2015, 2022) for m in range(1, 13) for d in range(1, 29)] * 3,
    "a gap": [*range(5000), *range(10**12, 10**12 + 3000), None, None, -4],
    "dense": list(range(1, 4001)),
}


@pytest.mark.parametrize("name", KEYS)
@pytest.mark.parametrize("parts", [1, 4, 16])
def test_parts_have_equally_many_rows(spark, monkeypatch, name, parts):
    """The tiles are asked of the oracle's engine, and the conditions run there."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k BIGINT)")
    con.executemany("INSERT INTO t VALUES (?)", [(k,) for k in KEYS[name]])

    def ask(reader, url, table, column=None, properties=None, **_):
        return spark.createDataFrame(con.execute(f"SELECT * FROM {table}").fetchall(), "cut bigint")

    monkeypatch.setattr(DataFrameReader, "jdbc", ask)
    split = key_split(spark, "jdbc:x", "t", "k", parts, {})
    assert split.parts == parts
    sizes = [con.execute(f"SELECT COUNT(*) FROM t WHERE {p}").fetchone()[0] for p in split.predicates]
    assert sum(sizes) == len(KEYS[name]) and max(sizes) <= 2 * min(sizes)


def test_one_value_makes_one_part(spark, monkeypatch):
    asked = []

    def ask(reader, url, table, column=None, properties=None, **_):
        asked.append(table)
        return spark.createDataFrame([(1,), (7,), (7,), (7,), (9,)], "cut bigint")

    monkeypatch.setattr(DataFrameReader, "jdbc", ask)
    split = key_split(spark, "jdbc:x", "t", "k", 5, {}, sample="(SELECT k FROM t WHERE r < 5) s")
    assert split == Split("k", (7, 9)) and "FROM (SELECT k FROM t WHERE r < 5) s WHERE" in asked[0]
    assert Split("k", ()).predicates == ["1 = 1"]


def test_read_options(spark, monkeypatch):
    read = mock.Mock(return_value=None)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    read_jdbc(spark, "jdbc:x", "sales", {"user": "u"}, split=Split("id", (3, 8)))
    assert read.call_args.kwargs == {
        "predicates": ["(id < 3 OR id IS NULL)", "(id >= 3 AND id < 8)", "id >= 8"], "properties": {"user": "u"},
    }
    read_jdbc(spark, "jdbc:x", "sales", {"user": "u"}, predicates=["a = 1", "a = 2"])
    assert read.call_args.kwargs["predicates"] == ["a = 1", "a = 2"]
    read_jdbc(spark, "jdbc:x", "sales", {})
    assert "predicates" not in read.call_args.kwargs
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x", "sales", {}, split=Split("id", ()), predicates=["a = 1"])
