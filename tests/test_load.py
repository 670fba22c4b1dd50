import random

import pytest

from dockhand.operators import load


def one_after_the_other(files):
    """Files that a loop over them in order would reject: {file: keys}."""
    taken, lost = set(), set()
    for file, keys in sorted(files.items()):
        if taken & set(keys):
            lost.add(file)
        else:
            taken |= set(keys)
    return lost


def contested(spark, files):
    return spark.createDataFrame([(f, k) for f, keys in files.items() for k in keys], "file_seq int, k string")


CASES = {
    "one set": {i: ["a", "b"] for i in range(7)},
    "disjoint": {i: [f"k{i}"] for i in range(5)},
    "fork": {0: ["a"], 1: ["a", "b"], 2: ["b", "c"], 3: ["a", "c"], 4: ["c", "d"], 5: ["d"]},
    "empty": {},
}


@pytest.mark.parametrize("few", [0, load.FEW])
@pytest.mark.parametrize("name", CASES)
def test_losers_of_small_batches(spark, tmp_path, name, few):
    found = load.losers(spark, contested(spark, CASES[name]), ["k"], str(tmp_path / "w"), few)
    assert {r["file_seq"] for r in found.collect()} == one_after_the_other(CASES[name])


@pytest.mark.parametrize("seed", [1, 2])
def test_losers_of_random_batches(spark, tmp_path, seed):
    draw = random.Random(seed)
    files = {i: draw.sample(range(60), draw.randint(1, 4)) for i in range(80)}
    files = {f: [f"k{k}" for k in keys] for f, keys in files.items()}
    found = load.losers(spark, contested(spark, files), ["k"], str(tmp_path / "w"), few=0)
    assert {r["file_seq"] for r in found.collect()} == one_after_the_other(files)


def test_chained_files_take_few_rounds(spark, tmp_path):
    files = {i: [f"k{i}", f"k{i + 1}"] for i in range(1000)}
    found = load.losers(spark, contested(spark, files), ["k"], str(tmp_path / "w"), few=0)
    assert {r["file_seq"] for r in found.collect()} == set(range(1, 1000, 2))
    rounds = [p for p in (tmp_path / "w").iterdir() if p.name.startswith("nodes-")]
    assert len(rounds) <= 15


def test_pairs_need_one_rule_for_each_file(spark, tmp_path):
    files = {i: [f"k{i}", f"k{i + 1}"] for i in range(300)}
    load.losers(spark, contested(spark, files), ["k"], str(tmp_path / "w"), few=0).collect()
    rules = spark.read.parquet(str(tmp_path / "w" / "rules"))
    assert rules.filter("node < 0").isEmpty() and rules.filter("on is not null").count() == 299
    assert spark.read.parquet(str(tmp_path / "w" / "members")).selectExpr("max(length(set))").first()[0] == 16


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_sets_across_blocks_of_places(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(load, "_BLOCK_BITS", bits)
    draw = random.Random(bits)
    files = {i: draw.sample(range(12), draw.randint(1, 3)) for i in range(60)}
    files = {f: [f"k{k}" for k in keys] for f, keys in files.items()} | {f: ["all"] for f in range(60, 90)}
    found = load.losers(spark, contested(spark, files), ["k"], str(tmp_path / "w"), few=0)
    assert {r["file_seq"] for r in found.collect()} == one_after_the_other(files)


def test_verdicts_count_rows_of_table_and_batch(spark, tmp_path):
    rows = spark.createDataFrame(
        [(0, "a"), (0, "b"), (1, "b"), (1, "c"), (2, "c"), (2, "held"), (2, "held"), (3, "c"), (3, "c"), (4, "c"), (5, None)],
        "file_seq int, k string",
    )
    held = spark.createDataFrame([("held",), ("other",)], "k string")
    for few in (0, load.FEW):
        found = load.reject_verdicts(spark, load.rows_per_key(rows, ["k"]), held, ["k"], str(tmp_path / f"w{few}"), few)
        assert {tuple(r) for r in found.collect()} == {(0, 0, 0), (1, 1, 0), (2, 2, 1), (3, 0, 1), (4, 0, 0)}


def test_one_row_per_key_and_all_rows_without(spark):
    rows = spark.createDataFrame(
        [(0, 1, "a", 1), (0, 2, "a", 2), (1, 1, "a", 3), (1, 2, None, 4), (1, 3, None, 5)], "file_seq int, nr long, k string, v int"
    )
    first = {r["v"] for r in load.one_per_key(rows, ["k"]).collect()}
    last = {r["v"] for r in load.one_per_key(rows, ["k"], last=True).collect()}
    assert (first, last) == ({1, 4, 5}, {3, 4, 5})


def test_dense_numbers(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id % 10 as a", "id as b")
    found = load.dense_numbers(spark, rows, ["a", "b"], "n", str(tmp_path / "w")).collect()
    assert [(r["a"], r["b"]) for r in sorted(found, key=lambda r: r["n"])] == sorted((i % 10, i) for i in range(1000))
    assert sorted(r["n"] for r in found) == list(range(1000))
