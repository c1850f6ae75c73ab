"""Byte-identical files, in one split and in many."""

from __future__ import annotations

import hashlib
import os
import random
from contextlib import nullcontext

import pytest

from panelops import staging
from panelops.plans.query_sources import TASKS_A_CORE, small_splits
from panelops.plans.registry import QUERIES
from panelops.sources import digests


def found(spark, folder, size):
    with small_splits(spark, size) if size else nullcontext():
        return {os.path.basename(r["path"]): (r["bytes"], r["digest"]) for r in digests.identical_files(spark, str(folder)).collect()}


def contents():
    rng = random.Random(1)
    lines = [bytes(rng.choices(b"abc;\r\x00\xff\xe9 ", k=rng.randint(0, 40))) for _ in range(400)]
    whole = b"\n".join(lines)
    swapped = lines[:]
    swapped[10], swapped[300] = swapped[300], swapped[10]
    return {
        "a": whole, "b": whole, "ends": whole + b"\n", "other": whole[:-1] + b"!" if whole[-1:] != b"!" else whole[:-1] + b"?",
        "swapped": b"\n".join(swapped), "swapped too": b"\n".join(swapped), "moved end": b"\n" + whole, "empty": b"", "empty too": b"",
        "feed": b"\n", "x": b"x", "y": b"x", "alone": b"only here"}


@pytest.mark.parametrize("size", ["100", "1k", None])
def test_copies_in_any_splits(spark, tmp_path, size):
    files = contents()
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = found(spark, tmp_path, size)
    assert sorted(got) == ["a", "b", "empty", "empty too", "swapped", "swapped too", "x", "y"]
    assert got["a"] == got["b"] and got["swapped"] == got["swapped too"] and got["a"] != got["swapped"]
    assert all(n == len(files[name]) for name, (n, _) in got.items())
    if size is None:  # one split a file
        assert all(d == hashlib.md5(files[name]).hexdigest() for name, (_, d) in got.items())


def test_a_tree_of_several_levels(spark, tmp_path):
    files = contents()
    for name in ("a", "b", "swapped"):
        (tmp_path / name).write_bytes(files[name])
    with small_splits(spark, "100"):
        names = digests.listed_files(spark, str(tmp_path))
        rows = digests.file_digests(spark, str(tmp_path), [len(files["a"])], width=4).join(names, "file").collect()
    by_name = {os.path.basename(r["path"]): r["digest"] for r in rows}
    assert len(by_name) == 3 and by_name["a"] == by_name["b"] != by_name["swapped"]


def test_no_copies_and_one_file(spark, tmp_path):
    (tmp_path / "only").write_bytes(b"x")
    assert found(spark, tmp_path, None) == {}


def test_small_splits_share_tasks(spark, tmp_path):
    files = contents()
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    with small_splits(spark, "100", tasks=4):
        got = {os.path.basename(r["path"]): r["digest"] for r in digests.identical_files(spark, str(tmp_path)).collect()}
        assert digests.block_digests(spark, str(tmp_path), [len(files["a"])]).rdd.getNumPartitions() <= 8
    assert sorted(got) == ["a", "b", "empty", "empty too", "swapped", "swapped too", "x", "y"]
    assert got["a"] == got["b"] and got["swapped"] == got["swapped too"] and got["a"] != got["swapped"]
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_file_twins_runs_few_tasks_over_many_splits(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    # Ids that repeat with other texts, none, and texts of several lines, none and null.
    texts = [None, "", *("\n".join("x" * rng.randint(0, 150) + str(i) for _ in range(3)) for i in range(4000))]
    rows = [(rng.choice([None, *range(900)]), text) for text in texts]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{tmp_path}/sf/documents.parquet")
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path / "shared"))
    got = sorted(map(tuple, QUERIES["file_twins"](spark, f"{tmp_path}/sf").collect()))
    lines = [((0, 0) if k is None else (1, k), text or "") for k, text in rows]
    whole = "".join(text + "\n" for _, text in sorted(lines)).encode()
    assert got == [("documents", len(whole), 2), ("documents(1)", len(whole), 2)]
    written = {p.parent.name: p.read_bytes() for p in tmp_path.glob("shared/panelops/raw-*/*/part-*")}
    assert written["documents"] == written["documents(1)"] == whole
    assert len(written["documents_reversed"]) == len(whole) and written["documents_reversed"] != whole
    leaves = [p for p in tmp_path.glob("shared/panelops/leaves-*/part-*")]
    assert len(leaves) <= 2 * TASKS_A_CORE * spark.sparkContext.defaultParallelism  # a file per task
    assert spark.read.parquet(*map(str, leaves)).count() > 900
