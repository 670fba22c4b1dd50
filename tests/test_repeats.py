import io
import zipfile

import pytest
from import_data import GOOD, LOAD_TIME, READING_COLUMNS, make_source

from dockhand.catalog import Catalog
from dockhand.plans.pipeline import ImportEngine
from dockhand.sources import delivery
from dockhand.streaming.inbox import stream_inbox


@pytest.fixture
def keyless():
    return make_source("log", READING_COLUMNS)


def engine(spark, tmp_path, source, **options):
    return ImportEngine(spark, Catalog.of(source), str(tmp_path / "store"), LOAD_TIME, **options)


def by_name(results):
    return {r["dateiname"]: r for r in results.collect()}


def identities(spark, tmp_path, inbox, name):
    found = delivery.open_inbox(spark, inbox.folder)
    files = delivery.file_table(spark, found.paths)
    landing = delivery.land(spark, delivery.raw_lines(found), files, str(tmp_path / name), ["|"])
    return {r["name"]: r["dateihash"] for r in landing.files.collect()}


def test_identity_of_contents(spark, tmp_path, inbox):
    long = "".join(f"line {i}\n" for i in range(5000))
    inbox("long.csv", long)
    inbox("again.csv", long)
    inbox("crlf.csv", b"\xef\xbb\xbf" + long.replace("\n", "\r\n").encode())
    inbox("swapped.csv", long.replace("line 1\nline 2\n", "line 2\nline 1\n"))
    inbox("twice.csv", "a\na\n")
    inbox("once.csv", "a\n")
    inbox("two.csv", "a\nb\n")
    inbox("empty.csv", "")
    found = identities(spark, tmp_path, inbox, "whole")
    assert found["long.csv"] == found["again.csv"] == found["crlf.csv"]
    assert len({found[n] for n in ("long.csv", "swapped.csv", "twice.csv", "once.csv", "two.csv")}) == 5
    assert all(len(h) == 64 for h in found.values())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert identities(spark, tmp_path, inbox, "split") == found
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_second_delivery_is_refused_without_a_key(spark, tmp_path, inbox, keyless):
    inbox("a.csv", GOOD)
    e = engine(spark, tmp_path, keyless)
    first = by_name(e.run(inbox.folder))["a.csv"]
    (tmp_path / "inbox" / "a.csv").rename(tmp_path / "inbox" / "b.csv")
    inbox("c.csv", GOOD.replace("ofen-8", "ofen-9"))
    inbox("d.csv", GOOD.replace("ofen-8", "ofen-9"))
    rows = by_name(e.run(inbox.folder))
    assert {n: (r["status"], r["zeilen_geladen"]) for n, r in rows.items()} == {
        "b.csv": ("abgelehnt_wiederholt", 0), "c.csv": ("geladen", 4), "d.csv": ("abgelehnt_wiederholt", 0),
    }
    assert rows["b.csv"]["fehler_grund"].startswith("Inhalt wurde bereits geladen: a.csv am 20")
    assert rows["d.csv"]["fehler_grund"] == "Inhalt gleicht c.csv derselben Lieferung"
    assert rows["b.csv"]["dateihash"] == first["dateihash"] and rows["b.csv"]["quelle"] == "log"
    assert e.table(keyless).read().count() == 8
    runs = spark.read.parquet(f"{e.store}/import_runs")
    assert runs.filter("dateihash is null").isEmpty() and runs.count() == 4
    moves = {r["file"].rsplit("/")[-1]: r["target_path"] for r in spark.read.parquet(f"{e.store}/dispositions").collect()}
    assert moves["b.csv"].startswith("reject/b__")


def test_a_key_settles_repeats_unless_told_otherwise(spark, tmp_path, inbox, readings, keyless):
    inbox("a.csv", GOOD)
    keyed = engine(spark, tmp_path, readings)
    assert [by_name(keyed.run(inbox.folder))["a.csv"]["zeilen_uebersprungen"] for _ in range(2)] == [0, 4]
    strict = engine(spark, tmp_path, readings, refuse_repeats=True)
    assert by_name(strict.at(LOAD_TIME).run(inbox.folder))["a.csv"]["status"] == "abgelehnt_wiederholt"
    lax = engine(spark, tmp_path / "lax", keyless, refuse_repeats=False)
    assert [by_name(lax.run(inbox.folder))["a.csv"]["status"] for _ in range(2)] == ["geladen"] * 2
    assert lax.table(keyless).read().count() == 8


def test_what_was_not_loaded_is_no_repeat(spark, tmp_path, inbox, keyless):
    bad = GOOD + "x|y\n"
    inbox("a.csv", bad)
    e = engine(spark, tmp_path, keyless)
    found = [by_name(e.run(inbox.folder, source="log"))["a.csv"]["status"] for _ in range(2)]
    assert found == ["abgelehnt_ungueltig"] * 2


def test_a_run_does_not_repeat_itself(spark, tmp_path, inbox, keyless):
    inbox("a.csv", GOOD)
    e = engine(spark, tmp_path, keyless)
    for _ in range(2):
        assert by_name(e.run(inbox.folder, run_id="retried"))["a.csv"]["status"] == "geladen"
    assert e.table(keyless).read().count() == 4
    assert spark.read.parquet(f"{e.store}/import_runs").count() == 1


def test_members_of_archives_have_an_identity(spark, tmp_path, inbox, keyless):
    inbox("a.csv", GOOD)
    e = engine(spark, tmp_path, keyless)
    e.run(inbox.folder)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("old.csv", GOOD)
        z.writestr("new.csv", GOOD.replace("ofen-8", "ofen-9"))
    archives = spark.createDataFrame([("x.zip", buffer.getvalue())], "path string, content binary")
    rows = by_name(e.commit(e.prepare_archives(archives)))
    assert {n: r["status"] for n, r in rows.items()} == {"old.csv": "abgelehnt_wiederholt", "new.csv": "geladen"}


def test_stream_refuses_repeats(spark, tmp_path, inbox, keyless):
    e = engine(spark, tmp_path, keyless)
    for name, text in (("a.csv", GOOD), ("b.csv", GOOD)):
        inbox(name, text)
        assert stream_inbox(e, inbox.folder, str(tmp_path / "cp"), available_now=True).awaitTermination(120)
    runs = spark.read.parquet(f"{e.store}/import_runs").orderBy("id").collect()
    assert [(r["dateiname"], r["status"]) for r in runs] == [("a.csv", "geladen"), ("b.csv", "abgelehnt_wiederholt")]
    assert e.table(keyless).read().count() == 4
