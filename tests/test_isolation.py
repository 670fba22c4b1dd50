import os

import pytest
from import_data import GOOD, LOAD_TIME, READING_COLUMNS, make_source
from pyspark.sql import functions as F

from dockhand.catalog import Catalog
from dockhand.plans import isolate as isolation
from dockhand.plans.isolate import isolate
from dockhand.plans.pipeline import ImportEngine
from dockhand.sources import delivery


def work_on(bad, calls):
    def work(group):
        calls.append(list(group))
        hit = [x for x in group if x in bad]
        if hit:
            raise ValueError(f"{hit[0]} is bad\nwith details")
        return list(group)

    return work


@pytest.mark.parametrize("bad", [set(), {0}, {7}, {3, 4}, set(range(8))])
def test_only_bad_items_fail(bad):
    calls = []
    done, failed = isolate(work_on(bad, calls), list(range(8)))
    assert [x for group in done for x in group] == [x for x in range(8) if x not in bad]
    assert failed == {x: f"{x} is bad" for x in bad}
    assert len(calls) <= 1 + 2 * 3 * len(bad)


def test_nothing_and_a_failure_that_is_not_the_files(monkeypatch):
    assert isolate(work_on(set(), []), []) == ([], {})
    monkeypatch.setattr(isolation, "MOST_FAILURES", 3)
    calls = []
    done, failed = isolate(work_on(set(range(1000)), calls), list(range(1000)))
    assert not done and len(failed) == 1000 and len(calls) < 40


def by_name(results):
    return {r["dateiname"]: r for r in results.collect()}


def test_each_step_fails_for_its_file_only(spark, tmp_path, inbox, monkeypatch):
    source = make_source("log", READING_COLUMNS)
    for i, name in enumerate(("a-lands-not.csv", "b-good.csv", "c-stages-not.csv", "d-good.csv", "e-loads-not.csv")):
        inbox(name, GOOD.replace("ofen-8", f"ofen-{80 + i}"))
    engine = ImportEngine(spark, Catalog.of(source), str(tmp_path / "store"), LOAD_TIME)

    fail = F.udf(lambda file, part: 1 / 0 if part in file else True, "boolean")
    lines, stage, load = delivery.raw_lines, ImportEngine._stage_source, ImportEngine._load_source
    through = delivery.read_through

    def bad_lines(found):
        return lines(found).filter(fail("file", F.lit("lands-not")))

    def bad_through(spark, paths):
        if any("lands-not" in p for p in paths):
            raise OSError("sector 7")
        through(spark, paths)

    def bad_stage(self, rows, source, folder):
        return stage(self, rows.filter(fail("file", F.lit("stages-not"))), source, folder)

    def bad_load(self, prepared, source, ready, run_id):
        numbers = [r["file_seq"] for r in ready.collect()]
        names = {r["file_seq"]: r["name"] for r in prepared.files.collect()}
        if any("loads-not" in names[n] for n in numbers):
            raise RuntimeError("target is full")
        return load(self, prepared, source, ready, run_id)

    monkeypatch.setattr(delivery, "raw_lines", bad_lines)
    monkeypatch.setattr(delivery, "read_through", bad_through)
    monkeypatch.setattr(ImportEngine, "_stage_source", bad_stage)
    monkeypatch.setattr(ImportEngine, "_load_source", bad_load)
    rows = by_name(engine.run(inbox.folder, run_id="r"))
    assert {n: r["status"] for n, r in rows.items()} == {
        "a-lands-not.csv": "abgelehnt_unbekannt", "b-good.csv": "geladen", "c-stages-not.csv": "abgelehnt_ladefehler",
        "d-good.csv": "geladen", "e-loads-not.csv": "abgelehnt_ladefehler",
    }
    assert rows["a-lands-not.csv"]["fehler_grund"] == "Datei nicht lesbar: sector 7"
    assert rows["e-loads-not.csv"]["fehler_grund"] == "Fehler beim Laden: target is full"
    assert rows["c-stages-not.csv"]["fehler_grund"].startswith("Fehler beim Laden: ")
    assert engine.table(source).read().count() == 8
    assert spark.read.parquet(f"{engine.store}/import_runs").count() == 5

    # The same run again, after the cause is gone: what was loaded stays as it is.
    monkeypatch.setattr(delivery, "raw_lines", lines)
    monkeypatch.setattr(ImportEngine, "_stage_source", stage)
    monkeypatch.setattr(ImportEngine, "_load_source", load)
    rows = by_name(engine.run(inbox.folder, run_id="r"))
    assert {r["status"] for r in rows.values()} == {"geladen"} and {r["zeilen_geladen"] for r in rows.values()} == {4}
    assert engine.table(source).read().count() == 20
    assert engine.table(source).read().filter("geraet like 'ofen-8_'").count() == 5


def test_file_that_cannot_be_opened(spark, tmp_path, inbox, readings):
    inbox("a.csv", GOOD)
    inbox("b.csv", GOOD.replace("|1|", "|8|"))
    found = delivery.open_inbox(spark, inbox.folder)
    os.unlink(tmp_path / "inbox" / "a.csv")  # between listing and reading
    engine = ImportEngine(spark, Catalog.of(readings), str(tmp_path / "store"), LOAD_TIME)
    rows = by_name(engine.commit(engine.prepare_files(found, found.paths)))
    assert {n: r["status"] for n, r in rows.items()} == {"a.csv": "abgelehnt_unbekannt", "b.csv": "geladen"}
    assert rows["a.csv"]["fehler_grund"].startswith("Datei nicht lesbar: ")
