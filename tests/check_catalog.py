"""Compare every catalogue query with its SQL: ``python -m tests.check_catalog [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import tempfile
import time

import __spark_entry__ as entry
from tests.oracle import connect, differences
from tidemark.session import build_session


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tidemark-check-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            found = differences(df, oracles[name], connection) if name in oracles else [f"no SQL; {df.count()} rows"]
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{name:32s} {time.time() - start:6.2f}s  {'; '.join(found) or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:]))
