"""Operators on small fixtures: numbering over splits, report cap, decisions, groups."""

import pytest
from import_data import FAULTY, LOAD_TIME, READING_COLUMNS, make_source
from pyspark.sql import functions as F

from dockhand.catalog import Catalog
from dockhand.operators import audit, classify, report, validate
from dockhand.plans.pipeline import ImportEngine
from dockhand.sources import delivery


@pytest.fixture
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_numbers_do_not_depend_on_splits(spark, tmp_path, inbox, tiny_splits):
    for name, n in (("a.csv", 1500), ("b.csv", 3), ("c.csv", 700)):
        inbox(name, "".join((f"{name}|{i}" if i % 7 else "") + "\n" for i in range(1, n + 1)))
    found = delivery.open_inbox(spark, inbox.folder)
    files = delivery.file_table(spark, found.paths)
    landing = delivery.land(spark, delivery.raw_lines(found), files, str(tmp_path / "l"), ["|"])
    assert landing.blocks.count() > 6
    rows = delivery.number_lines(landing, landing.files).select("nr", F.col("raw").cast("string").alias("t"))
    got = [(r["nr"], r["t"]) for r in rows.collect()]
    assert len(got) == 2203
    assert all(t == "" if nr % 7 == 0 else t.endswith(f"|{nr}") for nr, t in got)
    heads = delivery.head_lines(landing, 20).groupBy("file").count().collect()
    assert sorted(r["count"] for r in heads) == [3, 20, 20]


def test_spanning_records_over_real_splits(spark, tmp_path, inbox, tiny_splits):
    source = make_source("s", [{"name": "k", "typ": "integer"}, {"name": "v"}])
    inbox("s.csv", "".join(f'{i}|"part {i}\n' + "x" * 300 + f'\n|end {i}"\n' for i in range(200)))
    e = ImportEngine(spark, Catalog.of(source), str(tmp_path / "store"), LOAD_TIME)
    row = e.run(inbox.folder).first()
    assert (row["status"], row["zeilen_geladen"]) == ("geladen", 200)
    table = e.table(source).read().collect()
    assert {(r["k"], r["v"]) for r in table} == {(i, f"part {i}\n{'x' * 300}\n|end {i}") for i in range(200)}


def test_report_stops_at_fifty_but_totals_are_full(spark, readings):
    rows = [("f", i, f"Geraet {i}|1|1,0|1.1.2026") for i in range(1, 61)]
    parsed = validate.parse(spark.createDataFrame(rows, "file string, nr bigint, line string"), readings)
    found = validate.errors(parsed, readings)
    assert sorted(r["nr"] for r in validate.error_report(found).collect()) == list(range(1, 51))
    files = spark.createDataFrame([("f",), ("empty",)], "file string")
    verdict = validate.verdicts(files, validate.file_counts(validate.check(parsed, readings)), False)
    by_file = {r["file"]: r for r in verdict.collect()}
    assert (by_file["f"]["rows_total"], by_file["f"]["rows_bad"], by_file["f"]["report_capped"]) == (60, 60, True)
    assert by_file["f"]["invalid_reason"] == (
        "60 von 60 Zeilen fehlerhaft (Anzeige nach 50 Fehlern abgebrochen)"
    )
    assert (by_file["empty"]["valid"], by_file["empty"]["rows_total"]) == (False, 0)


def scores(spark, catalog, files, rows):
    samples = spark.createDataFrame(rows, "file string, nr bigint, line string")
    cut = classify.cut_samples(samples, catalog, {"utf-8": F.col("line")})
    listed = spark.createDataFrame([(f,) for f in files], "file string")
    return classify.rank(
        classify.score_files(listed, cut, classify.scoring_table(spark, catalog), catalog)
    )


def test_scores_and_knock_outs(spark, readings):
    header = make_source("kopf", [{"name": "a"}, {"name": "b"}], delimiter=";", header=True)
    ranking = scores(
        spark, Catalog.of(readings, header), ["broken", "cell", "unknown", "head", "none"],
        [
            *(("broken", i, line) for i, line in enumerate(FAULTY.splitlines(), 1)),
            ("cell", 1, "ofen-7||99,5|24.12.2025"), ("unknown", 1, "a,b"), ("unknown", 2, ""),
            ("head", 1, "x;y"),
        ],
    )
    got = {(r["file"], r["source"]): (r["score"], r["ko_reason"]) for r in ranking.collect()}
    assert got["broken", "messung"] == (0.7, None)
    assert got["cell", "messung"] == (0.75, None)
    assert got["unknown", "messung"] == (0.0, "Spaltenanzahl 1 statt 4")
    assert got["head", "kopf"] == (0.0, "Nur Header, keine Datenzeilen")
    assert got["none", "kopf"] == got["none", "messung"] == (0.0, "Datei nicht lesbar/leer")


def test_two_sources_of_equal_shape(spark, readings):
    twin = make_source("zwilling", READING_COLUMNS)
    ranking = scores(spark, Catalog.of(readings, twin), ["f"], [("f", 1, "a-1|1|1,0|1.1.2026")]).cache()
    batch = classify.decide(ranking).first()
    assert (batch["source"], batch["decision"], batch["category"]) == ("messung", "geladen", "unsicher")
    strict = classify.decide(ranking, require_unambiguous=True).first()
    assert strict["decision"] == "abgelehnt_unsicher"
    assert classify.decide(ranking, min_lead=0.0).first()["category"] == "sicher"
    assert classify.decide(ranking, min_lead=0.1).first()["category"] == "unsicher"


def test_error_groups_top_and_rest(spark):
    rows = [("f", n, 0, f"c{k}", f"v{k}-{n}", "R") for k in range(7) for n in range(1, 3 + (k % 2))]
    found = spark.createDataFrame(rows, "file string, nr bigint, position int, column string, value string, reason string")
    top = report.top_error_groups(report.error_groups(found)).orderBy("place").collect()
    assert [r["n"] for r in top] == [3, 3, 3, 2, 2, 4]
    assert (top[5]["n_categories"], top[5]["column"], top[0]["example"]) == (2, None, "v1-1")


def test_audit_failure_does_not_fail_the_import(spark, tmp_path):
    results = spark.createDataFrame([("x",)], "unexpected string")
    assert audit.append_runs(spark, str(tmp_path / "runs"), results, "r", "test", LOAD_TIME) is False
    assert audit.latest_runs(audit.read_runs(spark, str(tmp_path / "runs"))).count() == 0


def test_content_hash_and_missing_inbox(spark, tmp_path, inbox):
    import hashlib

    inbox("a.csv", "abc")
    row = delivery.content_hashes(spark, inbox.folder).first()
    assert row["dateihash"] == hashlib.sha256(b"abc").hexdigest()
    assert delivery.open_inbox(spark, str(tmp_path / "missing")) == delivery.Inbox(None, [], [])


def test_empty_inbox_and_unavailable_target(spark, tmp_path, inbox):
    source = make_source("o", [{"name": "k"}], typ="oracle")
    e = ImportEngine(spark, Catalog.of(source), str(tmp_path / "store"), LOAD_TIME)
    assert e.run(str(tmp_path / "missing")).count() == 0
    inbox("a.csv", "x\n")
    row = e.run(inbox.folder).first()
    assert row["status"] == "abgelehnt_ladefehler" and row["fehler_grund"].startswith("Fehler beim Laden: ")
