"""Run registered queries next to their SQL check: ``python tests/tests_compare.py DIR [name ...]``."""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ("", None)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, (int, float)):
        return ("n", float(v) + 0.0)
    return ("s", str(v))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def compare(spark, con, name, sf_dir):
    """None if equal, else a short text saying how the two differ; and the row count."""
    df = entry.queries()[name](spark, sf_dir)
    columns, got = table(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    want_columns, want = table(names, rel.fetchall())
    if columns != want_columns:
        return f"columns {columns} != {want_columns}", len(got)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(got)
    diff = [(columns[i], x, y) for a, b in zip(got, want) for i, (x, y) in enumerate(zip(a, b)) if x != y]
    return (f"{len(diff)} cells differ, e.g. {diff[:3]}" if diff else None), len(got)


if __name__ == "__main__":
    from ionsift.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    spark, con = local_session(), connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            problem, n = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
