"""Run queries in Spark and DuckDB side by side: ``python -m verification.compare [folder] [name ...]``."""

from __future__ import annotations

import datetime
import decimal
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb

from filingstrata import build_session
from verification.oracles import ORACLES
from verification.queries import QUERIES


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, float):
        return repr(value)
    return str(value) if not isinstance(value, (int, bool, type(None))) else value


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """What differs between the two results as multisets of rows; None when they agree."""
    result = QUERIES[name](spark, sf_dir)
    names = sorted(result.columns)
    ours = Counter(
        tuple(_plain(value) for value in row) for row in result.select(*[f"`{n}`" for n in names]).collect()
    )
    columns = [row[0] for row in connection.execute(f"DESCRIBE {ORACLES[name]}").fetchall()]
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    order = ", ".join(f'"{n}"' for n in names)
    rows = connection.execute(f"SELECT {order} FROM ({ORACLES[name]})").fetchall()
    theirs = Counter(tuple(_plain(value) for value in row) for row in rows)
    if ours == theirs:
        return None if ours else "both empty"
    extra, lacking = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours "
        f"{sum(extra.values())}: {list(extra)[:2]}; only theirs {sum(lacking.values())}: {list(lacking)[:2]}"
    )


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(QUERIES)
    spark = build_session(
        "compare",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
         "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_tables(sf_dir)
    wrong = 0
    for name in chosen:
        start = time.time()
        try:
            found = difference(spark, connection, name, sf_dir)
        except Exception as error:  # one failing query must not hide the others
            found = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += found is not None
        print(f"{name:28s} {time.time() - start:6.1f}s  {found or 'same'}", flush=True)
    print(f"{len(chosen) - wrong} of {len(chosen)} agree")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
