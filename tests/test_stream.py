import threading
import time

from import_data import GOOD, LOAD_TIME, UNKNOWN

from dockhand.catalog import Catalog
from dockhand.plans.pipeline import ImportEngine
from dockhand.streaming.inbox import settled, stream_inbox


def test_stream_takes_each_file_once(spark, tmp_path, inbox, readings):
    inbox("a.csv", GOOD)
    inbox("b.csv", UNKNOWN)
    engine = ImportEngine(spark, Catalog.of(readings), str(tmp_path / "store"), LOAD_TIME)

    def drain():
        query = stream_inbox(
            engine, inbox.folder, str(tmp_path / "cp"), max_files_per_batch=1, available_now=True
        )
        assert query.awaitTermination(120)

    drain()
    inbox("c.csv", GOOD.replace("ofen-8", "ofen-9"))
    drain()
    runs = spark.read.parquet(f"{engine.store}/import_runs").orderBy("id").collect()
    assert [(r["dateiname"], r["status"], r["zeilen_geladen"]) for r in runs][2] == ("c.csv", "geladen", 1)
    assert sorted((r["dateiname"], r["status"]) for r in runs[:2]) == [
        ("a.csv", "geladen"), ("b.csv", "abgelehnt_unbekannt"),
    ]
    assert engine.table(readings).read().count() == 5


def test_stream_reports_empty_files_and_leaves_folders_alone(spark, tmp_path, inbox, readings):
    inbox("empty.csv", "")
    inbox("good ü [1].csv", GOOD)
    inbox("_b.csv", GOOD)
    folder = tmp_path / "inbox" / "jahr=2024"
    folder.mkdir()
    (folder / "old.csv").write_text(GOOD)
    engine = ImportEngine(spark, Catalog.of(readings), str(tmp_path / "store"), LOAD_TIME)
    query = stream_inbox(engine, inbox.folder, str(tmp_path / "cp"), available_now=True)
    assert query.awaitTermination(120)
    inbox("next.csv", GOOD.replace("ofen-8", "ofen-9"))
    query = stream_inbox(engine, inbox.folder, str(tmp_path / "cp"), available_now=True)
    assert query.awaitTermination(120)
    runs = spark.read.parquet(f"{engine.store}/import_runs").collect()
    assert sorted((r["dateiname"], r["status"]) for r in runs) == [
        ("_b.csv", "abgelehnt_unbekannt"), ("empty.csv", "abgelehnt_unbekannt"),
        ("good ü [1].csv", "geladen"), ("next.csv", "geladen"),
    ]


def test_waiting_for_files_that_change():
    clock, sizes = [1000.0], iter([5, 5, 9, 9, 9, 9, 9, 9, 9, 9])
    state = {}

    def look():
        state["/in/grows"] = (0, next(sizes)) if clock[0] < 1003 else state["/in/grows"]
        return {**state, "/in/old": (1, 10), "/in/empty": (1, 0), "/in/never": (int(clock[0] * 1000), int(clock[0]))}

    def sleep(seconds):
        clock[0] += seconds

    state["/in/grows"] = (int(1e9), 5)
    options = {"settle": 2, "now": lambda: clock[0], "sleep": sleep}
    assert settled(look, ["/in/old"], patience=60, **options) == set() and clock[0] == 1000
    assert settled(look, ["/in/gone"], patience=60, **options) == set() and clock[0] == 1000
    assert settled(look, ["/in/empty"], patience=60, **options) == set() and clock[0] >= 1002
    assert settled(look, ["/in/never", "/in/old"], patience=10, **options) == {"/in/never"}


def test_file_that_is_written_while_the_stream_looks(spark, tmp_path, inbox, readings):
    lines = GOOD.splitlines(keepends=True)
    path = tmp_path / "inbox" / "slow.csv"
    inbox("late.csv", "")

    def write():
        for i in range(1, len(lines) + 1):
            path.write_text("".join(lines[:i]))
            time.sleep(0.7)
        (tmp_path / "inbox" / "late.csv").write_text(GOOD.replace("ofen-8", "ofen-9"))

    path.write_text(lines[0][:5])
    engine = ImportEngine(spark, Catalog.of(readings), str(tmp_path / "store"), LOAD_TIME)
    writer = threading.Thread(target=write)
    writer.start()
    query = stream_inbox(engine, inbox.folder, str(tmp_path / "cp"), available_now=True, settle=4)
    assert query.awaitTermination(120)
    writer.join()
    runs = {r["dateiname"]: (r["status"], r["zeilen_gesamt"]) for r in spark.read.parquet(f"{engine.store}/import_runs").collect()}
    assert runs == {"slow.csv": ("geladen", 4), "late.csv": ("geladen", 4)}
