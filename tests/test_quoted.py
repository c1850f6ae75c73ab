"""Records whose quoted values hold line ends, over many splits of a file."""

from __future__ import annotations

import csv
import random

import pytest

from panelops.plans.query_sources import small_splits
from panelops.sources import delimited, quoted


def written(path, rows, end="\n", encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as f:
        w = csv.writer(f, delimiter=";", lineterminator=end)
        w.writerows(rows)
    return str(path)


def read(spark, path, size, **options):
    with small_splits(spark, size):
        df = quoted.read_quoted(spark, path, **options)
        return df.columns, sorted((tuple(x or "" for x in r) for r in df.collect()), key=lambda r: int(r[0]))


def messy(n, seed):
    rng = random.Random(seed)
    values = ["plain", 'say "x"', "two\nlines", 'a;b\n\n"q" c', "", '"', '"\n"', "e" * 50, "\n" * 5]
    return [[str(i), rng.choice(values), "z" * rng.randint(0, 60)] for i in range(n)]


@pytest.mark.parametrize("size", ["100", "1k", "1m"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_any_split_gives_the_rows(spark, tmp_path, size, end):
    rows = messy(300, 2)
    path = written(tmp_path / "a.csv", [["id", "text", "pad"], *rows], end)
    with small_splits(spark, size):
        assert size == "1m" or spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 10
    assert read(spark, path, size) == (["id", "text", "pad"], [tuple(r) for r in rows])


def test_several_files_and_another_encoding(spark, tmp_path):
    rows = [[str(i), f"año\n{i}", ""] for i in range(40)]
    for k in (0, 1):
        written(tmp_path / f"{k}.csv", [["id", "ñ", "pad"], *rows[k::2]], encoding="latin-1")
    assert read(spark, str(tmp_path), "60", encoding="ISO-8859-1") == (["id", "ñ", "pad"], [tuple(r) for r in rows])


def test_short_long_and_unclosed_records_are_counted(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a;b;c\n1;2;3\n4;5\n\n6;7;8;9\n"10\n11";12;13\n14;"open\n15;16\n17;18;19\n')
    row = quoted.count_malformed(spark, str(path)).first()
    assert tuple(row) == (5, 1, 2, 1, 3)
    assert sorted(r["a"] for r in quoted.read_quoted(spark, str(path)).collect()) == ["1", "10\n11", "4", "6"]


def test_a_quote_that_stays_open_is_not_gathered(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('a;b\n1;"x\n' + "2;y\n" * 200)
    found = quoted.records(spark, str(path), max_lines=50).filter("record is null").collect()
    assert [(r["n_lines"], r["whole"]) for r in found] == [(201, False)]
    assert tuple(quoted.count_malformed(spark, str(path), max_lines=50).first()) == (1, 0, 0, 1, 201)


def test_headers(spark, tmp_path):
    assert quoted.column_names('﻿a;"b;c";;A;"d""e"', ";") == ["a0", "b;c", "_c2", "A3", 'd"e']
    (tmp_path / "empty.csv").write_text("")
    assert quoted.read_quoted(spark, str(tmp_path / "empty.csv")).count() == 0
    (tmp_path / "other.csv").write_text("x;y\n1;2\n")
    (tmp_path / "third.csv").write_text("x;z\n1;2\n")
    with pytest.raises(ValueError, match="different headers"):
        quoted.read_quoted(spark, [str(tmp_path / "other.csv"), str(tmp_path / "third.csv")])
    assert delimited.read_delimited(spark, str(tmp_path / "other.csv"), quoted_line_ends=True).columns == ["x", "y"]
