"""Upserts into a relational table over DB-API connections opened inside tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.changes import REMOVALS, latest_by_key

POSTGRES, MYSQL, ANSI = "postgres", "mysql", "ansi"


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str], dialect: str = POSTGRES, mark: str = "%s") -> str:
    """One parametrised statement that inserts a row or updates the row of equal key."""
    rest = [c for c in columns if c not in keys]
    names, marks = ", ".join(columns), ", ".join([mark] * len(columns))
    if dialect == POSTGRES:
        action = "DO UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in rest) if rest else "DO NOTHING"
        return f"INSERT INTO {table} ({names}) VALUES ({marks}) ON CONFLICT({', '.join(keys)}) {action}"
    if dialect == MYSQL:
        action = ", ".join(f"{c} = VALUES({c})" for c in rest or keys)
        return f"INSERT INTO {table} ({names}) VALUES ({marks}) ON DUPLICATE KEY UPDATE {action}"
    if dialect == ANSI:
        source = ", ".join(f"{mark} AS {c}" for c in columns)
        match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        update = f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in rest)} " if rest else ""
        values = ", ".join(f"s.{c}" for c in columns)
        return (
            f"MERGE INTO {table} t USING (SELECT {source}) s ON {match} "
            f"{update}WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


def delete_statement(table: str, keys: Sequence[str], mark: str = "%s") -> str:
    return f"DELETE FROM {table} WHERE " + " AND ".join(f"{k} = {mark}" for k in keys)


def _send(connect: Callable[[], object], statement: str, rows: Iterator[tuple], batch: int, retries: int, wait: float) -> None:
    connection = None
    try:
        while chunk := list(islice(rows, batch)):
            for attempt in range(retries + 1):
                try:
                    connection = connection or connect()
                    cursor = connection.cursor()
                    cursor.executemany(statement, chunk)
                    connection.commit()
                    break
                except Exception:
                    if connection is not None:
                        _close(connection)
                        connection = None
                    if attempt == retries:
                        raise
                    time.sleep(wait * (attempt + 1))
    finally:
        if connection is not None:
            _close(connection)


def _close(connection) -> None:
    try:
        connection.close()
    except Exception:
        pass


def upsert_jdbc(
    df: DataFrame,
    connect: Callable[[], object],
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    dialect: str = POSTGRES,
    mark: str = "%s",
    batch: int = 100,
    retries: int = 5,
    wait: float = 0.2,
    connections: int | None = None,
) -> None:
    """Upsert a batch. Rows are first reduced to the last one per key, so tasks never race for a key.

    At-least-once: a task that is run again repeats statements that set the same values. ``connections`` bounds the
    number of tasks, each of which holds one connection.
    """
    last = latest_by_key(df, keys, order)
    statement = upsert_statement(table, df.columns, keys, dialect, mark)
    _each_partition(last, statement, df.columns, connect, batch, retries, wait, connections)


def upsert_jdbc_changelog(
    changes: DataFrame,
    connect: Callable[[], object],
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    op: str = "op",
    dialect: str = POSTGRES,
    mark: str = "%s",
    batch: int = 100,
    retries: int = 5,
    wait: float = 0.2,
    connections: int | None = None,
) -> None:
    """Apply changes: upsert for inserts and updates, delete for removals."""
    last = latest_by_key(changes, keys, order, op, drop_removed=False).persist()
    gone = F.col(op).isin(REMOVALS)
    kept = last.filter(~gone | F.col(op).isNull())
    sent = (connect, batch, retries, wait, connections)
    try:
        _each_partition(kept, upsert_statement(table, columns, keys, dialect, mark), columns, *sent)
        _each_partition(last.filter(gone), delete_statement(table, keys, mark), keys, *sent)
    finally:
        last.unpersist()


def _each_partition(df, statement, columns, connect, batch, retries, wait, connections) -> None:
    rows = df.select(*columns)
    rows = rows.repartition(connections) if connections else rows  # coalesce would also cut what comes before

    def run(partition):
        _send(connect, statement, (tuple(row) for row in partition), batch, retries, wait)

    rows.foreachPartition(run)
