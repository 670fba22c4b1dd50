import io
import re
import struct
import zipfile

import pytest
from import_data import GOOD, LOAD_TIME

from dockhand.catalog import Catalog
from dockhand.plans.pipeline import ImportEngine
from dockhand.sources import archive

METHODS = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)


def zipped(*entries):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries:
            z.writestr(name, data)
    return buffer.getvalue()


def nested(depth):
    data = zipped(("leaf.csv", "x|1\n"))
    for _ in range(depth):
        data = zipped(("in.dat", data))
    return data


@pytest.fixture
def expanded(spark):
    def run(**archives):
        rows = [(k, v) for k, v in archives.items()]
        return archive.expand(spark.createDataFrame(rows, "path string, content binary"))

    return run


def test_flat_nested_and_refused(expanded):
    out = expanded(
        flat=zipped(("a.csv", "1|2\n3|4"), ("b.csv", "x\r\ny\rz\n")),
        nested=zipped(("innen.zip", zipped(("inner.csv", "i\n"))), ("aussen.csv", b"\xef\xbb\xbfa\n")),
        slip=zipped(("ok.csv", "1"), ("../../etc/passwd", "x")),
        broken=b"this is no archive",
        truncated=zipped(("a.csv", "1|2\n" * 1000))[:60],
        empty=zipped(),
        deep=nested(6),
        fits=nested(5),
    ).cache()
    members = {(r["archive"], r["member"], r["size"]) for r in archive.members(out).collect()}
    assert members == {
        ("flat", "a.csv", 7), ("flat", "b.csv", 7),
        ("nested", "innen.zip/inner.csv", 2), ("nested", "aussen.csv", 5),
        ("fits", "in.dat/in.dat/in.dat/in.dat/in.dat/leaf.csv", 4),
    }
    assert {r["archive"] for r in archive.failures(out).collect()} == {
        "slip", "broken", "truncated", "deep",
    }
    lines = {(r["file"], r["rid"], bytes(r["raw"])) for r in archive.lines(out).collect()}
    assert ("flat/b.csv", 1, b"y") in lines and ("flat/b.csv", 2, b"z") in lines
    assert ("nested/aussen.csv", 0, b"a") in lines
    assert len(lines) == 8


def test_lines_survive_chunk_borders(monkeypatch):
    monkeypatch.setattr(archive, "_CHUNK", 3)
    for text in (b"ab\r\ncd\r\n", b"a\rb\r\r\nc", b"\n\n\r\nx", b"abc\rdef", b"ab\r"):
        for size in (1, 2, 3, 100):
            pieces = (text[i : i + size] for i in range(0, len(text), size))
            chunks = list(archive._chunks(pieces))
            assert [line for c in chunks for line in re.split(b"\r\n|\n|\r", c)] == text.splitlines(), (text, size)


def flipped(data, member):
    """Some bytes of a packed member changed."""
    info = zipfile.ZipFile(io.BytesIO(data)).getinfo(member)
    at = info.header_offset + 30 + len(member) + info.compress_size // 2
    return data[:at] + bytes(b ^ 0x5A for b in data[at : at + 8]) + data[at + 8 :]


def test_any_damage_is_an_error_of_its_archive(expanded):
    long = ("a.csv", "".join(f"{i}|{i * i}\n" for i in range(3000)))
    whole = zipped(long, ("b.csv", "b\n"))
    encrypted = bytearray(whole)
    at = encrypted.index(b"PK\x01\x02")
    encrypted[at + 8] |= 1
    unknown = bytearray(whole)
    unknown[at + 10 : at + 12] = struct.pack("<H", 99)
    lying = bytearray(whole)
    lying[at + 24 : at + 28] = struct.pack("<I", 100)
    out = expanded(
        whole=whole, flipped=flipped(whole, "a.csv"), encrypted=bytes(encrypted), unknown=bytes(unknown), lying=bytes(lying),
        inner=zipped(("in.zip", flipped(whole, "a.csv")), ("c.csv", "c\n")), none=None,
    ).cache()
    failed = {r["archive"]: r["error"] for r in archive.failures(out).collect()}
    assert set(failed) == {"flipped", "encrypted", "unknown", "lying", "inner", "none"}
    assert "encrypted" in failed["encrypted"] and "99" in failed["unknown"] and "more than the 100 bytes" in failed["lying"]
    assert {r["file"] for r in archive.members(out).collect()} == {"whole/a.csv", "whole/b.csv"}
    assert archive.lines(out).count() == 3001


def test_equal_names_and_all_methods(spark, expanded):
    buffer = io.BytesIO()
    text = "".join(f"line {i} of a file that is packed in its own way\n" for i in range(50_000))
    with zipfile.ZipFile(buffer, "w") as z, pytest.warns(UserWarning, match="Duplicate name"):
        for method in METHODS:
            z.writestr("a.csv", f"{method}\n{text}", method)
        z.writestr("plain", "x")
        z.writestr("plain", "y\n\nz")
    out = expanded(x=buffer.getvalue()).cache()
    names = {r["member"]: r["size"] for r in archive.members(out).collect()}
    assert set(names) == {"a.csv", "a~2.csv", "a~3.csv", "a~4.csv", "plain", "plain~2"}
    lines = archive.lines(out)
    assert {r["raw"].decode() for r in lines.filter("file like 'x/a%' and block = 0 and rid = 0").collect()} == {str(m) for m in METHODS}
    assert lines.count() == 4 * 50_001 + 1 + 3
    per_file = {r["file"]: r["n"] for r in lines.filter("file like 'x/a%'").selectExpr("file", "md5(raw) as m").distinct().groupBy("file").count().withColumnRenamed("count", "n").collect()}
    assert set(per_file.values()) == {50_001}


def listed(data):
    fields = "filename flag_bits compress_type CRC compress_size file_size header_offset".split()
    show = lambda infos: [tuple(getattr(i, f) for f in fields) + (i.is_dir(),) for i in infos]
    return show(archive._infos(memoryview(data))), show(zipfile.ZipFile(io.BytesIO(data)).infolist())


def test_directories_are_those_of_zipfile():
    with io.BytesIO() as buffer:
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_BZIP2) as z:
            z.mkdir("d")
            z.writestr("d/ü.csv", "x")
            z.writestr("b.csv", "y" * 1000)
            z.comment = b"PK"
        remarked = buffer.getvalue()
    with io.BytesIO() as buffer:
        with zipfile.ZipFile(buffer, "w") as z, z.open("large.csv", "w", force_zip64=True) as f:
            f.write(b"x")
        large = buffer.getvalue()
    plain = zipped(("a.csv", "1|2"), ("in/b.csv", ""))
    for data in (plain, zipped(), nested(2), remarked, large, b"in front" + plain):
        ours, theirs = listed(data)
        assert ours == theirs


def test_plain_archives_need_no_zipfile(monkeypatch):
    data = nested(3)
    monkeypatch.setattr(zipfile, "ZipFile", None)
    found = archive._list_members(memoryview(data), "", 0, [archive.MAX_UNPACKED_BYTES], archive.MAX_DEPTH, set())
    assert [(name, size) for name, size, *_ in found] == [("in.dat/in.dat/in.dat/leaf.csv", 4)]


def test_limits_are_parameters(spark):
    rows = spark.createDataFrame([("deep", nested(2)), ("large", zipped(("a.csv", "x" * 1000)))], "path string, content binary")
    assert archive.failures(archive.expand(rows)).count() == 0
    assert {r["archive"] for r in archive.failures(archive.expand(rows, max_depth=1)).collect()} == {"deep"}
    assert {r["archive"] for r in archive.failures(archive.expand(rows, max_bytes=999)).collect()} == {"large"}


def test_line_longer_than_a_value(expanded, monkeypatch):
    monkeypatch.setattr(archive, "_CHUNK", 8)
    monkeypatch.setattr(archive, "MAX_LINE_BYTES", 64)
    assert list(archive._chunks(iter([b"x" * 10] * 6))) == [b"x" * 60]
    with pytest.raises(archive.ArchiveError, match="64 bytes"):
        list(archive._chunks(iter([b"x" * 10] * 20)))


def test_members_of_one_archive_go_to_several_tasks(spark):
    data = zipped(*((f"{i}.csv", "".join(f"{j * i}\n" for j in range(2000))) for i in range(64)))
    out = archive.expand(spark.createDataFrame([("x", data)], "path string, content binary"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = out.filter("size is not null").selectExpr("spark_partition_id() as p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1


def test_archives_run_through_the_engine(spark, tmp_path, readings):
    folder = tmp_path / "zips"
    folder.mkdir()
    (folder / "a.zip").write_bytes(zipped(("deep/p.zip", zipped(("good.csv", GOOD))), ("odd.txt", "?\n")))
    (folder / "b.zip").write_bytes(b"broken")
    engine = ImportEngine(spark, Catalog.of(readings), str(tmp_path / "store"), LOAD_TIME)
    rows = {r["file"].rsplit("a.zip/")[-1]: r for r in engine.commit(engine.prepare_archives(str(folder))).collect()}
    assert rows["deep/p.zip/good.csv"]["status"] == "geladen"
    assert rows["deep/p.zip/good.csv"]["dateiname"] == "good.csv"
    assert rows["odd.txt"]["status"] == "abgelehnt_unbekannt"
    broken = next(r for f, r in rows.items() if f.endswith("b.zip"))
    assert broken["status"] == "abgelehnt_unbekannt" and broken["fehler_grund"].startswith("Archiv nicht lesbar: BadZipFile")
    assert spark.read.parquet(f"{engine.store}/import_runs").count() == 3
    assert engine.table(readings).read().count() == 4
