"""Records over several lines against Python's csv module, whatever the file splits are."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from dockhand.functions.cells import tokenize
from dockhand.sources.quoting import join_lines, number_records


def random_text(rng):
    parts = ['"', '""', "|", "\n", "a", "bc", '"x"', '"|"', "\n\n", 'd"e', '|"']
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))


@pytest.mark.parametrize("seed", [1, 2])
def test_same_records_as_the_csv_module(spark, seed):
    rng = random.Random(seed)
    texts = [random_text(rng) for _ in range(120)]
    lines = []
    for f, text in enumerate(texts):
        block = 0
        for rid, line in enumerate(text.split("\n") if not text.endswith("\n") else text[:-1].split("\n")):
            block += rng.random() < 0.3
            lines.append((f, block, rid, line))
    frame = spark.createDataFrame(lines, "file int, block int, rid bigint, line string")
    records = join_lines(number_records(frame, "|"), "|")
    got = {
        (r["file"], r["nr"]): r["cells"]
        for r in records.filter("line <> ''").select("file", "nr", tokenize(F.col("line"), "|").alias("cells")).collect()
    }
    expected = {}
    for f, text in enumerate(texts):
        for nr, cells in enumerate(csv.reader(text.splitlines(keepends=True), delimiter="|"), 1):
            if cells:
                expected[f, nr] = cells
    # The csv module keeps the final line break of a quote that is never closed; a line
    # scan has no such break.
    for key, cells in expected.items():
        if got.get(key) != cells:
            cells[-1] = cells[-1].rstrip("\n")
            assert [x.rstrip("\n") for x in got[key]] == [x.rstrip("\n") for x in cells], (key, texts[key[0]])
    assert got.keys() == expected.keys()


@pytest.mark.parametrize("seed", [3, 4])
def test_states_do_not_depend_on_runs(spark, seed):
    """Shuffled lines and blocks of any size give the same numbers."""
    rng = random.Random(seed)
    texts = [random_text(rng) for _ in range(40)]
    whole = [(f, 0, i, line) for f, text in enumerate(texts) for i, line in enumerate(text.split("\n"))]
    cut = [(f, i // 3, i, line) for f, _, i, line in whole]
    mixed = rng.sample(cut, len(cut))

    def numbers(rows):
        frame = spark.createDataFrame(rows, "file int, block int, rid bigint, line string")
        return sorted((r["file"], r["rid"], r["nr"], r["inside"], r["multi"]) for r in number_records(frame, "|").collect())

    assert numbers(whole) == numbers(cut) == numbers(mixed)
