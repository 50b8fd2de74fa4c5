"""Copies of the test tables in which one participant holds a third of the orders.

usage: python -m verification.skewed <sf_dir> <out_dir> [copies] [plain]

``copies`` repeats the tables with shifted keys, to grow the data; ``plain``
leaves the owners of the orders as they are.
"""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb

TABLES = ("customer", "orders", "lineitem", "events", "documents")
# Columns that identify rows; shifted per copy so that copies are different people and cases.
KEYS = {
    "customer": ["c_custkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
}
SHIFT = 69_300_000  # a multiple of every modulus in the derived views: copies keep their categories


def write(sf_dir: str, out_dir: str, copies: int = 1, skew: bool = True) -> None:
    con = duckdb.connect()
    for table in TABLES:
        shifted = ", ".join(f"{k} + i * {SHIFT} AS {k}" for k in KEYS[table])
        rows = (
            f"SELECT * REPLACE ({shifted}) FROM '{sf_dir}/{table}.parquet',"
            f" (SELECT range AS i FROM range({copies}))"
        )
        if table == "orders" and skew:
            rows = (
                "SELECT * REPLACE (CASE WHEN hash(o_orderkey) % 3 = 0 THEN 1 ELSE o_custkey END"
                f" AS o_custkey) FROM ({rows})"
            )
        target = Path(out_dir) / f"{table}.parquet"
        con.execute(f"COPY ({rows}) TO '{target}' (FORMAT parquet)")


if __name__ == "__main__":
    write(
        sys.argv[1],
        sys.argv[2],
        int(sys.argv[3]) if len(sys.argv) > 3 else 1,
        skew="plain" not in sys.argv[4:],
    )
