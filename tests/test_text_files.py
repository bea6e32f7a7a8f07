from __future__ import annotations

import random

import pytest

from quarterlode.sources import archives as A
from quarterlode.sources import text_files as T

COLUMNS = ("path", "member", "file", "line_no", "header", "line")


@pytest.fixture()
def folder(tmp_path):
    rng = random.Random(2)
    for name, n, end in (("demo24q1.txt", 3_000, "\n"), ("drug12q4.txt", 500, "\r\n"), ("sub/reac13q1.txt", 40, "\n"), ("outc24q1.txt", 1, "\n")):
        lines = ["id$name$note"] + [f"{i}${'x' * rng.randrange(60)}$ü" if rng.random() < 0.9 else "" for i in range(n)]
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(end.join(lines).encode() + (end.encode() if n % 2 else b""))
    (tmp_path / "indi24q1.txt").write_bytes(b"")
    (tmp_path / "rpsr24q1.txt").write_bytes("﻿id$name\n".encode() + b"1$caf\xe9\n2$ok\n")
    (tmp_path / "drug19q3.txt").write_bytes(b"id$name\n\xff\xfe1$a\n2$b\xe2\x82")
    (tmp_path / "other.csv").write_bytes(b"no\n")
    return tmp_path


@pytest.mark.parametrize("split_bytes,rows_sent", [("128m", None), ("700b", None), ("700b", 0)])
def test_numbers_do_not_depend_on_splits(spark, rows, folder, monkeypatch, split_bytes, rows_sent):
    if rows_sent is not None:  # nothing is broadcast by hand
        monkeypatch.setattr("quarterlode.operators.lookup.MAX_ROWS", rows_sent)
    want = rows(A.read_lines(A.binary_files(spark, str(folder), "*.txt")), *COLUMNS)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "10b")
    try:
        found = T.read_numbered(spark, str(folder))
        got = rows(found, *COLUMNS)
        if split_bytes == "700b":
            assert found.rdd.getNumPartitions() > 50 or rows_sent == 0
        lost = {r.file: (r["sum(dropped)"], r["sum(latin)"]) for r in found.groupBy("file").sum("dropped", "latin").collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(want) > 3_500 and got == want
    assert lost["drug19q3.txt"] == (4, 0) and lost["rpsr24q1.txt"] == (0, 1) and lost["demo24q1.txt"] == (0, 0)
    assert "binaryFile" not in found._jdf.queryExecution().toString()
