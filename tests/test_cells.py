"""Cell semantics: types, conversion, stripping, tokenizing, rounding."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from dockhand.catalog import ColumnDef
from dockhand.functions import cells as c
from dockhand.functions.text import (
    archive_path,
    file_name,
    percent,
    quarantine_path,
    reject_path,
    round_half_even,
)
from import_data import LOAD_TIME


@pytest.fixture(scope="module")
def evaluate(spark):
    def run(texts, *columns):
        frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
        rows = frame.select("i", *(e.alias(f"v{n}") for n, e in enumerate(columns))).orderBy("i").collect()
        return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]

    return run


S = None


@pytest.fixture(scope="module", autouse=True)
def cell_column(spark):
    """The column under test; columns exist only while a session does."""
    global S
    S = F.col("s")


CASES = {
    "integer": {"42": 42, "-7": -7, "007": 7, "+5": None, "4.0": None, "9223372036854775807": 2**63 - 1,
                "42\x00": None, "42\x7f": None, "\x0142": None, "4\x002": None, "٤٢": None, "--4": None, "-": None},
    "decimal_de": {"1.234,56": 1234.56, "1234,5": 1234.5, "-0,5": -0.5, "12": 12.0, "1.23": None,
                   "1.234": 1234.0, "1,2,3": None, "12.34,5": None},
    "decimal_en": {"1,234.56": 1234.56, "1234.5": 1234.5, "12,34": None, ".5": None, "-0.50": -0.5,
                   "1e5": None, "5.": None},
    "date_dmy": {"1.2.2026": date(2026, 2, 1), "31.12.1999": date(1999, 12, 31), "31.02.2026": None,
                 "01.01.0000": None, "1.2.26": None, "29.02.2024": date(2024, 2, 29), "29.02.2023": None},
    "date_iso": {"2026-02-01": date(2026, 2, 1), "2026-2-1": None, "2026-13-45": None, "0000-01-01": None,
                 "2026-02-01T00": None},
    "boolean": {"JA": True, "y": True, "j": True, "1": True, "True": True, "n": False, "NEIN": False,
                "0": False, "false": False, "yes": None, "t": None, "no": None},
}


@pytest.mark.parametrize("typ", CASES)
def test_types(evaluate, typ):
    texts = list(CASES[typ])
    got = evaluate(texts, c.type_fits(S, typ), F.when(c.type_fits(S, typ), c.convert(S, typ)))
    assert got == [(v is not None, v) for v in CASES[typ].values()]


def test_empty_and_padded_cells(evaluate):
    assert evaluate([" 42\t", "  x　\u001f", " ", ""], c.strip(S)) == ["42", "x", "", ""]
    for typ in (*CASES, "string"):
        assert evaluate([""], c.convert(S, typ)) == [None]


def test_pattern_is_anchored_at_the_start_only(evaluate):
    assert evaluate(["12x", "x12"], c.pattern_fits(S, r"\d+")) == [True, False]
    assert evaluate(["b", "xb"], c.pattern_fits(S, "a|b")) == [True, False]


@pytest.mark.parametrize("pattern, texts", [
    (r"^\w+$", ["Müller", "a b", "x_1", "٤", "é"]),
    (r"^\[[0-9]+\]$", ["[12]", "12", "[12"]),
    (r"[a[&&b]+$", ["a[&b", "c", "&&", "a]"]),
    (r"[]x]+$", ["]x", "a"]),
    (r"[^]x]+$", ["]x", "a"]),
    (r"(?P<a>.)(?P=a)\Z", ["xx", "xy", "xx\n", "xxx"]),
    (r".+$", ["a\u2028b", "a\nb", "a\r"]),
    (r"\s\d\b", ["\u00a07", " 7x", " 7 "]),
    (r"a\]|\[b", ["a]", "[b", "b"]),
])
def test_patterns_mean_the_same_as_in_the_catalog(evaluate, pattern, texts):
    import re

    assert evaluate(texts, c.pattern_fits(S, pattern)) == [bool(re.match(pattern, t)) for t in texts]


def test_bounds_are_inclusive(evaluate):
    for typ in ("integer", "decimal_en", "decimal_de"):
        col = ColumnDef(0, "c", typ, minimum=0, maximum=10)
        got = evaluate(["0", "10", "-1", "11"], c.below_minimum(S, col), c.above_maximum(S, col))
        assert got == [(False, False), (False, False), (True, False), (False, True)]
    assert c.below_minimum(S, ColumnDef(0, "c", "string", minimum=0)) is None
    big = ColumnDef(0, "c", "integer", minimum=0.5, maximum=2.0**53)
    texts = ["9007199254740993", "9007199254740992", "0", "9" * 30, "-" + "9" * 30]
    assert evaluate(texts, c.below_minimum(S, big), c.above_maximum(S, big)) == [
        (False, True), (False, False), (True, False), (False, True), (True, False),
    ]
    assert evaluate(texts, c.overflows(S, "integer")) == [False, False, False, True, True]


def test_tokenize(evaluate):
    cases = {
        "a|b|c": ["a", "b", "c"],
        "|": ["", ""],
        "a|": ["a", ""],
        '"x|y"|z': ["x|y", "z"],
        '"q""z"|1': ['q"z', "1"],
        '5" pipe|"a"b"c|': ['5" pipe', 'ab"c', ""],
        ' "a|b"': [' "a', 'b"'],
        '"open|x': ["open|x"],
        '"one\ntwo"|""': ["one\ntwo", ""],
        '""""|"a""""b"': ['"', 'a""b'],
        "ü|" + "x" * 20000: ["ü", "x" * 20000],
        '"' + 'y""' * 20000 + '"|z': ["y\"" * 20000, "z"],
    }
    assert evaluate(list(cases), c.tokenize(S, "|")) == list(cases.values())
    assert evaluate(["a.b.c", "a\tb"], c.tokenize(S, "."), c.tokenize(S, "\t")) == [
        (["a", "b", "c"], ["a.b.c"]), (["a\tb"], ["a", "b"]),
    ]


def test_scores_round_by_their_exact_value(spark):
    scores = sorted({h / (w * n) for w in (5, 8) for n in (20, 19) for h in range(w * n + 1)}
                    | {k / 800 for k in range(801)} | {k / 20000 for k in range(0, 20000, 7)})
    frame = spark.createDataFrame([(x,) for x in scores], "x double")
    rows = frame.select("x", round_half_even(F.col("x")).alias("r")).collect()
    assert [r["r"] for r in rows] == [round(r["x"], 4) for r in rows]


def test_texts(evaluate):
    assert evaluate(["0.7", "1.0", "0.875", "0.9333"], percent(S.cast("double"))) == ["70%", "100%", "88%", "93%"]
    assert evaluate(["file:///in/a%20b+%C3%BC.csv", "x/plain.csv"], file_name(S)) == ["a b+ü.csv", "plain.csv"]
    name = ["a.b.csv", "noext", ".hidden"]
    assert evaluate(name, reject_path("reject", S, LOAD_TIME)) == [
        "reject/a.b__20260717_103000.csv", "reject/noext__20260717_103000", "reject/__20260717_103000.hidden",
    ]
    assert evaluate(["a.csv"], archive_path("archive", F.lit("q"), S, LOAD_TIME)) == [
        "archive/q/a__20260717_103000.csv"
    ]
    assert evaluate(["a.b.csv", "noext"], quarantine_path("reject", S, LOAD_TIME)) == [
        "reject/a.b_fehlerhaft__20260717_103000.csv", "reject/noext_fehlerhaft__20260717_103000.csv",
    ]
