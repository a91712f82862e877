"""Run the queries and their SQL twins side by side: python -m checks.compare SF_DIR [NAME ...]"""

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

from checks import ORACLES, QUERIES


def _plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 9) + 0.0
    if isinstance(value, Decimal):
        return float(value)
    return value


def _table(columns, rows):
    """Sorted column names, and how often each row occurs with its values in that order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    counted = Counter(tuple(_plain(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], counted


def _types(columns, rows):
    """The Python types of each column's values."""
    return {c: {type(row[i]).__name__ for row in rows} - {"NoneType"} for i, c in enumerate(columns)}


def connect(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def difference(spark, connection, name, sf_dir):
    """None if both sides agree, else a description."""
    frame = QUERIES[name](spark, sf_dir)
    ours = frame.columns, frame.collect()
    if name not in ORACLES:
        return None
    cursor = connection.execute(ORACLES[name])
    theirs = [column[0] for column in cursor.description], cursor.fetchall()
    (names, mine), (other_names, others) = _table(*ours), _table(*theirs)
    if names != other_names:
        return f"columns {names} / {other_names}"
    if mine != others:
        extra, lacking = list((mine - others).items())[:2], list((others - mine).items())[:2]
        return f"{len(ours[1])} / {len(theirs[1])} rows; only ours {extra}; only theirs {lacking}"
    types, other_types = _types(*ours), _types(*theirs)
    differing = {c: (types[c], other_types[c]) for c in names if types[c] != other_types[c]}
    return f"types {differing}" if differing else None


def main(sf_dir, names):
    from rastro.session import build_session

    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{failed} failed, {len(ORACLES)} of {len(QUERIES)} with SQL")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
