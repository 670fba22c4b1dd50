from import_data import FAULTY, GOOD, LOAD_TIME, READING_COLUMNS, UNKNOWN, make_source

from dockhand.catalog import Catalog
from dockhand.plans.pipeline import ImportEngine


def engine(spark, tmp_path, *sources):
    return ImportEngine(spark, Catalog.of(*sources), str(tmp_path / "store"), LOAD_TIME)


def by_name(results):
    return {r["dateiname"]: r for r in results.collect()}


def test_statuses_of_a_mixed_inbox(spark, tmp_path, inbox, readings):
    inbox("good file ü+1.csv", GOOD)
    inbox("broken.csv", FAULTY)
    inbox("unknown.csv", UNKNOWN)
    inbox("empty.csv", "")
    e = engine(spark, tmp_path, readings)
    rows = by_name(e.run(inbox.folder))
    assert {n: r["status"] for n, r in rows.items()} == {
        "good file ü+1.csv": "geladen",
        "broken.csv": "abgelehnt_unsicher",
        "unknown.csv": "abgelehnt_unbekannt",
        "empty.csv": "abgelehnt_unbekannt",
    }
    good = rows["good file ü+1.csv"]
    assert (good["score"], good["zeilen_gesamt"], good["zeilen_geladen"]) == (1.0, 4, 4)
    assert rows["broken.csv"]["score"] == 0.7
    assert rows["broken.csv"]["fehler_grund"] == (
        "Kein sicherer Vorschlag (bester Score 70% < Schwellenwert 90%)"
    )
    assert rows["unknown.csv"]["fehler_grund"] == "Keine Config passt zu dieser Datei"
    table = e.table(readings).read()
    assert table.columns == ["geraet", "kanal", "wert", "am", "monat"]
    assert {(r["geraet"], r["kanal"], r["wert"], r["monat"]) for r in table.collect()} == {
        ("pumpe-1", 1, 20.5, "202607"), ("pumpe-1", 2, 1204.75, "202607"), ("ofen-7", 1, -3.0, "202607"),
        ("ofen-8", 4, 0.25, "202607"),
    }
    runs = spark.read.parquet(f"{e.store}/import_runs")
    assert runs.count() == 4 and runs.select("id").distinct().count() == 4
    reports = spark.read.parquet(f"{e.store}/reject_reports")
    text = [r["text"] for r in reports.filter("file like '%unknown.csv'").orderBy("part", "line_nr").collect()]
    assert text == [
        "Datei:     unknown.csv", "Rejected:  2026-07-17 10:30:00",
        "Grund:     Keine Config passt zu dieser Datei", "", "Details:",
        "  - messung: Spaltenanzahl 1 statt 4",
    ]
    moves = {r["file"].rsplit("/")[-1]: r["target_path"]
             for r in spark.read.parquet(f"{e.store}/dispositions").collect()}
    assert moves["broken.csv"] == "reject/broken__20260717_103000.csv"


def test_second_load_skips_everything(spark, tmp_path, inbox, readings):
    inbox("good.csv", GOOD)
    e = engine(spark, tmp_path, readings)
    e.run(inbox.folder)
    again = by_name(e.run(inbox.folder))["good.csv"]
    assert (again["status"], again["zeilen_geladen"], again["zeilen_uebersprungen"]) == ("geladen", 0, 4)
    assert e.table(readings).read().count() == 4


def test_prepare_writes_nothing_and_commit_twice_changes_nothing(spark, tmp_path, inbox, readings):
    inbox("good.csv", GOOD)
    e = engine(spark, tmp_path, readings)
    prepared = e.prepare(inbox.folder)
    assert e.table(readings).read().count() == 0
    assert not (tmp_path / "store").exists()
    shown = prepared.preview(readings, rows=2).orderBy("nr").collect()
    assert [(r["nr"], r["kanal"], r["more"]) for r in shown] == [(1, 1, 2), (2, 2, 2)]
    first = e.commit(prepared).collect()
    assert e.commit(prepared).collect() == first
    assert e.table(readings).read().count() == 4
    assert spark.read.parquet(f"{e.store}/import_runs").count() == 1


def test_forced_source_reports_line_exact_errors(spark, tmp_path, inbox, readings):
    inbox("broken.csv", FAULTY)
    e = engine(spark, tmp_path, readings)
    prepared = e.prepare(inbox.folder, source="messung")
    found = {(r["nr"], r["column"], r["code"]) for r in prepared.errors().collect()}
    assert found == {
        (2, "kanal", "BELOW_MIN"), (3, "geraet", "TYPE_OR_PATTERN"), (4, "am", "TYPE_OR_PATTERN"), (5, None, "COLUMN_COUNT"),
    }
    row = by_name(e.commit(prepared))["broken.csv"]
    assert (row["status"], row["score"], row["zeilen_gesamt"]) == ("abgelehnt_ungueltig", None, 5)
    assert row["fehler_grund"] == "4 von 5 Zeilen fehlerhaft"
    details = spark.read.parquet(f"{e.store}/reject_reports").filter("part = 2").orderBy("line_nr")
    assert details.first()["text"] == (
        "  - Zeile 2, Spalte 'kanal': '0' — kleiner als Minimum 1.0"
    )


def test_partial_mode_quarantines_the_bad_rows(spark, tmp_path, inbox):
    source = make_source("p", READING_COLUMNS, upsert_key=["geraet"], fehler_modus="partiell")
    inbox("broken.csv", FAULTY)
    inbox("hopeless.csv", "a|b|c|d\nx\n")
    e = engine(spark, tmp_path, source)
    rows = by_name(e.run(inbox.folder, source="p"))
    broken, hopeless = rows["broken.csv"], rows["hopeless.csv"]
    assert (broken["status"], broken["zeilen_geladen"], broken["zeilen_quarantaene"]) == ("geladen", 1, 4)
    assert hopeless["status"] == "abgelehnt_ungueltig"
    assert hopeless["fehler_grund"] == (
        "Alle 2 Zeilen fehlerhaft (partieller Modus, aber nichts zu laden)"
    )
    kept = spark.read.parquet(f"{e.store}/quarantine").filter("dateiname = 'broken.csv'")
    assert {(r["zeile_nr"], r["fehler_grund"], r["original_zeile"]) for r in kept.collect()} == {
        (2, "kanal: kleiner als Minimum 1.0", "ofen-7|0|99,5|25.12.2025"),
        (3, "geraet: passt nicht zu Typ 'string' / Muster '^[a-z]+-\\d+$'", "Ofen 7|2|99,5|26.12.2025"),
        (4, "am: passt nicht zu Typ 'date_dmy'", "ofen-7|3|99,5|30.02.2026"),
        (5, "Spaltenanzahl 3 statt 4", "ofen-7|4|99,5"),
    }


def test_update_mode_last_row_wins(spark, tmp_path, inbox):
    kv = make_source(
        "src", [{"name": "k"}, {"name": "v", "typ": "integer"}], upsert_key=["k"],
        pk_konflikt="update", tabelle="t",
    )
    inbox("1.csv", "A|1\nB|5\n")
    e = engine(spark, tmp_path, kv)
    e.run(inbox.folder)
    inbox("1.csv", "A|98\nA|99\n")
    row = by_name(e.run(inbox.folder))["1.csv"]
    assert (row["zeilen_geladen"], row["zeilen_uebersprungen"]) == (2, 0)
    assert {(r["k"], r["v"]) for r in e.table(kv).read().collect()} == {("A", 99), ("B", 5)}


def test_reject_mode_in_file_order(spark, tmp_path, inbox):
    kv = make_source(
        "src", [{"name": "k"}, {"name": "v", "typ": "integer"}], upsert_key=["k"],
        pk_konflikt="reject", tabelle="t",
    )
    inbox("0.csv", "A|1\nB|2\n")
    e = engine(spark, tmp_path, kv)
    e.run(inbox.folder)
    (tmp_path / "inbox" / "0.csv").unlink()
    inbox("1.csv", "A|100\nC|3\n")      # A is in the table
    inbox("2.csv", "C|7\nD|8\n")        # C is free: file 1 was rejected
    inbox("3.csv", "D|9\nE|1\nC|4\n")   # D and C came with file 2
    inbox("4.csv", "E|5\nF|6\n")        # E is free: file 3 was rejected
    inbox("5.csv", "G|1\nG|2\n")        # repeats its own key
    inbox("6.csv", "G|3\n")
    rows = by_name(e.run(inbox.folder))
    assert {n: (r["status"], r["zeilen_geladen"]) for n, r in rows.items()} == {
        "1.csv": ("abgelehnt_pk_konflikt", 0),
        "2.csv": ("geladen", 2),
        "3.csv": ("abgelehnt_pk_konflikt", 0),
        "4.csv": ("geladen", 2),
        "5.csv": ("abgelehnt_ladefehler", 0),
        "6.csv": ("geladen", 1),
    }
    assert rows["1.csv"]["fehler_grund"] == (
        "1 Datensatz/-saetze existieren bereits (pk_konflikt=reject)"
    )
    assert rows["3.csv"]["fehler_grund"].startswith("2 ")
    table = {(r["k"], r["v"]) for r in e.table(kv).read().collect()}
    assert table == {("A", 1), ("B", 2), ("C", 7), ("D", 8), ("E", 5), ("F", 6), ("G", 3)}


def test_null_keys_never_conflict(spark, tmp_path, inbox):
    source = make_source(
        "n", [{"name": "k", "pflicht": False}, {"name": "v"}], upsert_key=["k"], fehler_modus="partiell"
    )
    inbox("1.csv", "|a\n|b\nx|c\nx|d\n")
    e = engine(spark, tmp_path, source)
    row = by_name(e.run(inbox.folder))["1.csv"]
    assert (row["zeilen_geladen"], row["zeilen_uebersprungen"]) == (3, 1)
    again = by_name(e.run(inbox.folder))["1.csv"]
    assert (again["zeilen_geladen"], again["zeilen_uebersprungen"]) == (2, 2)


def test_integer_overflow_is_a_load_error(spark, tmp_path, inbox):
    source = make_source("i", [{"name": "k"}, {"name": "v", "typ": "integer"}])
    inbox("big.csv", "a|1\nb|99999999999999999999\n")
    inbox("ok.csv", "c|9223372036854775807\n")
    rows = by_name(engine(spark, tmp_path, source).run(inbox.folder))
    assert rows["big.csv"]["status"] == "abgelehnt_ladefehler"
    assert (rows["ok.csv"]["status"], rows["ok.csv"]["zeilen_geladen"]) == ("geladen", 1)


def test_encodings_header_quotes_and_spanning_records(spark, tmp_path, inbox):
    source = make_source(
        "q", [{"name": "name"}, {"name": "text"}, {"name": "n", "typ": "integer"}], header=True,
        derived=[("datei", "dateiname")],
    )
    inbox("cp1252.csv", "h|h|h\nMüller|€ 5|1\n".encode("cp1252"))
    inbox("latin1.csv", b"h|h|h\nx\x81\xfc|y|2\n")
    inbox("utf8bom.csv", "﻿h|h|h\n\nStraße|é|3\n".encode())
    inbox("span.csv", 'h|h|h\n"a|b"|"one\n\ntwo ""x"""|4\nc|"d"e|5\n"last|\nopen|6"|z|7\n')
    e = engine(spark, tmp_path, source)
    rows = by_name(e.run(inbox.folder))
    assert {r["status"] for r in rows.values()} == {"geladen"}
    table = {tuple(r) for r in e.table(source).read().collect()}
    assert table == {
        ("Müller", "€ 5", 1, "cp1252.csv"),
        ("x\x81ü", "y", 2, "latin1.csv"),
        ("Straße", "é", 3, "utf8bom.csv"),
        ("a|b", 'one\n\ntwo "x"', 4, "span.csv"),
        ("c", "de", 5, "span.csv"),
        ("last|\nopen|6", "z", 7, "span.csv"),
    }


def test_declared_encoding_is_binding(spark, tmp_path, inbox):
    columns = [{"name": "name"}, {"name": "n", "typ": "integer"}]
    cp = make_source("cp", columns, encoding="cp1252")
    inbox("a.csv", "Müller|1\n".encode("cp1252"))
    inbox("b.csv", b"x\x81|1\n")
    e = engine(spark, tmp_path, cp)
    rows = by_name(e.run(inbox.folder))
    assert rows["a.csv"]["status"] == "geladen"
    assert rows["b.csv"]["status"] == "abgelehnt_unbekannt"
    assert e.table(cp).read().first()["name"] == "Müller"


def test_many_sources_are_routed(spark, tmp_path, inbox):
    sources = [
        make_source(f"s{n}", [{"name": f"c{i}", "typ": "integer"} for i in range(n)]) for n in range(2, 8)
    ]
    for n in range(2, 8):
        inbox(f"{n}.csv", "\n".join("|".join(str(i + r) for i in range(n)) for r in range(5)))
    e = engine(spark, tmp_path, *sources)
    rows = by_name(e.run(inbox.folder))
    assert {r["quelle"] for r in rows.values()} == {s.name for s in sources}
    assert {r["zeilen_geladen"] for r in rows.values()} == {5}


def test_long_records_are_whole_and_wrong_ones_cost_one_record(spark, tmp_path, inbox, monkeypatch):
    from dockhand.sources import quoting

    monkeypatch.setattr(quoting, "MAX_RECORD_CHARS", 100)
    source = make_source("e", [{"name": "k"}, {"name": "v"}], fehler_modus="partiell")
    inbox("endless.csv", "x|y\n" * 30 + 'a|b|"never closed\n' + "more|text\n" * 50)
    inbox("closed.csv", 'a|"long\n' + "more text\n" * 50 + 'end"\nb|c\n')
    inbox("short.csv", 'a|"two\nlines"\nb|c\n')
    e = engine(spark, tmp_path, source)
    rows = by_name(e.run(inbox.folder, source="e"))
    counts = {n: (r["status"], r["zeilen_gesamt"], r["zeilen_geladen"], r["zeilen_quarantaene"]) for n, r in rows.items()}
    assert counts == {
        "endless.csv": ("geladen", 31, 30, 1), "closed.csv": ("geladen", 2, 2, 0), "short.csv": ("geladen", 2, 2, 0),
    }
    assert e.table(source).read().filter("k = 'a' and v like 'long%'").first()["v"] == "long\n" + "more text\n" * 50 + "end"
    bad = {r["dateiname"]: r for r in spark.read.parquet(f"{e.store}/quarantine").collect()}
    assert bad["endless.csv"]["zeile_nr"] == 31 and bad["endless.csv"]["original_zeile"].startswith("Datensatz mit 518 Zeichen")
    assert bad["endless.csv"]["fehler_grund"] == "Spaltenanzahl 3 statt 2"
    pieces = spark.read.parquet(f"{e.store}/quarantine_pieces").filter("file like '%endless.csv'").orderBy("block", "rid").collect()
    assert b"\n".join(r["raw"] for r in pieces).decode() == 'a|b|"never closed\n' + "more|text\n" * 49 + "more|text"


def test_record_beyond_one_value(spark, tmp_path, inbox, monkeypatch):
    from dockhand.sources import quoting

    monkeypatch.setattr(quoting, "MAX_RECORD_CHARS", 100)
    monkeypatch.setattr(quoting, "MAX_VALUE_CHARS", 300)
    source = make_source("e", [{"name": "k"}, {"name": "v"}], fehler_modus="partiell")
    inbox("a.csv", 'a|"long\n' + "more text\n" * 50 + 'end"\nb|"two\n' + "more text\n" * 12 + 'end"\n')
    e = engine(spark, tmp_path, source)
    row = by_name(e.run(inbox.folder, source="e"))["a.csv"]
    assert (row["zeilen_geladen"], row["zeilen_quarantaene"]) == (1, 1)
    assert [r["k"] for r in e.table(source).read().collect()] == ["b"]


def test_everything_in_an_inbox_has_a_result(spark, tmp_path, inbox, readings):
    inbox("a.csv", GOOD)
    inbox("_b.csv", GOOD)
    inbox(".hidden.csv", GOOD)
    inbox("c [1]{2}*.csv", GOOD.replace("|1|", "|8|"))
    for name in ("jahr=2024", "archive"):
        folder = tmp_path / "inbox" / name
        folder.mkdir()
        (folder / "old.csv").write_text(GOOD)
    e = engine(spark, tmp_path, readings)
    rows = by_name(e.run(inbox.folder))
    assert {n: r["status"] for n, r in rows.items()} == {
        "a.csv": "geladen", "_b.csv": "abgelehnt_unbekannt", "c [1]{2}*.csv": "geladen",
    }
    assert rows["_b.csv"]["fehler_grund"].startswith("Datei nicht lesbar") and rows["a.csv"]["zeilen_gesamt"] == 4
    assert spark.read.parquet(f"{e.store}/import_runs").count() == 3
    assert not spark.read.parquet(f"{e.store}/reject_reports").filter("file like '%_b.csv'").isEmpty()


def test_forced_source_that_cannot_read_a_file(spark, tmp_path, inbox):
    source = make_source("greek", [{"name": "k"}, {"name": "v"}], encoding="cp1252")
    inbox("a.csv", b"a|\x81\x8d\n")
    e = engine(spark, tmp_path, source)
    row = by_name(e.run(inbox.folder, source="greek"))["a.csv"]
    assert row["status"] == "abgelehnt_ungueltig" and row["fehler_grund"] == "Datei nicht lesbar: Kodierung cp1252 passt nicht"
    text = [r["text"] for r in spark.read.parquet(f"{e.store}/reject_reports").collect()]
    assert any("Zeile 0: Datei nicht lesbar" in t for t in text)


def test_failing_sources_do_not_stop_others(spark, tmp_path, inbox, readings, monkeypatch):
    other = make_source("paar", [{"name": "k"}, {"name": "v", "typ": "integer"}])
    inbox("a.csv", GOOD)
    inbox("b.csv", "x|1\ny|2\n")
    e = engine(spark, tmp_path, readings, other)
    stage = ImportEngine._stage_source

    def broken(self, lines, source, folder):
        if source.name == "paar":
            raise RuntimeError("disk is full")
        return stage(self, lines, source, folder)

    monkeypatch.setattr(ImportEngine, "_stage_source", broken)
    rows = by_name(e.run(inbox.folder))
    assert {n: (r["status"], r["fehler_grund"]) for n, r in rows.items()} == {
        "a.csv": ("geladen", ""), "b.csv": ("abgelehnt_ladefehler", "Fehler beim Laden: disk is full"),
    }
    assert spark.read.parquet(f"{e.store}/import_runs").count() == 2


def test_pattern_that_the_jvm_refuses_leaves_out_its_source_only(spark, tmp_path, inbox, readings):
    odd = make_source("odd", [{"name": "k", "muster": "(?P<a_b>x)"}, {"name": "v"}])
    inbox("a.csv", GOOD)
    e = engine(spark, tmp_path, readings, odd)
    assert list(e.catalog) == ["messung"] and set(e.refused) == {"odd"}
    assert by_name(e.run(inbox.folder))["a.csv"]["status"] == "geladen"


def test_sources_of_other_fields_cannot_share_a_table(spark, tmp_path, inbox):
    first = make_source("eins", [{"name": "k"}, {"name": "v", "typ": "integer"}], tabelle="t")
    second = make_source("zwei", [{"name": "k"}, {"name": "w"}, {"name": "x"}], tabelle="t")
    inbox("a.csv", "a|1\n")
    inbox("b.csv", "b|c|d\n")
    e = engine(spark, tmp_path, first, second)
    rows = by_name(e.run(inbox.folder))
    assert (rows["a.csv"]["status"], rows["b.csv"]["status"]) == ("geladen", "abgelehnt_ladefehler")
    assert "other fields" in rows["b.csv"]["fehler_grund"]
    assert [tuple(r) for r in e.table(first).read().collect()] == [("a", 1)]


def test_working_tables_go_and_results_stay(spark, tmp_path, inbox, readings):
    from pathlib import Path

    from dockhand.session import work_root

    inbox("a.csv", GOOD)
    before = set(Path(work_root(spark)).iterdir())
    e = engine(spark, tmp_path, readings)
    results = e.run(inbox.folder, run_id="first")
    assert set(Path(work_root(spark)).iterdir()) == before
    assert by_name(results)["a.csv"]["status"] == "geladen"
    prepared = e.prepare(inbox.folder)
    assert Path(prepared.folder).exists() and prepared.good(readings).count() == 4


def test_quarantine_as_text(spark, tmp_path, inbox):
    import csv
    from pathlib import Path

    source = make_source("p", READING_COLUMNS, upsert_key=["geraet"], fehler_modus="partiell")
    inbox("broken.csv", FAULTY + 'ofen-9|"say ""x""; y"|1|1.1.2026\n')
    e = engine(spark, tmp_path, source)
    e.run(inbox.folder, source="p", run_id="r")
    e.export_quarantine("r", str(tmp_path / "csv"))
    found = [p for p in Path(tmp_path, "csv").rglob("*.csv") if p.is_file()]
    assert {p.parent.name for p in found} == {"datei=broken_fehlerhaft__20260717_103000.csv"}
    rows = [r for p in sorted(found) for r in csv.reader(p.read_text().splitlines(), delimiter=";")]
    assert rows[0] == ["zeile_nr", "fehler_grund", "original_zeile"]
    assert [r[0] for r in rows if r[0] != "zeile_nr"] == ["2", "3", "4", "5", "6"]
    assert rows[-1] == ["6", "kanal: passt nicht zu Typ 'integer'", 'ofen-9|say "x"; y|1|1.1.2026']
