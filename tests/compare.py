"""Runs queries against their SQL in DuckDB: ``python tests/compare.py DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def kind(text: str) -> str:
    text = text.lower()
    return {"integer": "int", "varchar": "string", "bigint": "bigint", "double": "double", "boolean": "boolean"}.get(text, text)


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(normal(r[i])) for i in order) for r in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL; ``None`` if nothing does."""
    df = query(spark, sf_dir)
    got = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    answer = con.execute(sql)
    want = {c[0]: kind(str(c[1])) for c in answer.description}
    expected = rows_of(answer.fetchall(), list(want))
    actual = rows_of(df.collect(), list(got))
    if got != want:
        return f"columns {sorted(set(got.items()) ^ set(want.items()))}"
    if actual != expected:
        extra = sorted(set(actual) - set(expected))[:3]
        short = sorted(set(expected) - set(actual))[:3]
        return f"rows {len(actual)} for {len(expected)}; only Spark {extra}; only SQL {short}"
    if not actual:
        return "no rows"
    return None


def main(sf_dir: str, *names: str) -> int:
    import __spark_entry__ as entry
    from quarterlode.session import local_session

    spark, con = local_session(8, **{"spark.checkpoint.dir": "/tmp/quarterlode-compare"}), duck(sf_dir)
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                bad = difference(spark, con, queries[name], oracles[name], sf_dir)
            else:
                bad = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # noqa: BLE001
            bad = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bad is not None
        print(f"{'ok  ' if bad is None else 'FAIL'} {name} {time.time() - start:.2f}s {bad or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
