"""ZIP archives as a source: nested archives are flattened, members become raw lines.

The directory of an archive sits at its end, so one task reads it, applies every check and hands
out the members as they are, still packed.  Members are then dealt to tasks, so one large archive
keeps many of them busy; each is unpacked once, as a stream, and leaves as chunks of bytes that
end with a line.  The JVM cuts chunks into lines.  Only an archive inside another one is unpacked
by the first task, for its directory.

Whatever is wrong with an archive or a member - damage, encryption, paths that lead out, limits -
is an error row of that archive, which then contributes no member and does not concern the others.
"""

from __future__ import annotations

import bz2
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Limits per archive, and the first bytes of a ZIP file.
MAX_UNPACKED_BYTES = 5 * 1024**3
MAX_DEPTH = 5
ZIP_MAGIC = (b"PK\x03\x04", b"PK\x05\x06")

MAX_LINE_BYTES = 512 * 1024**2  # a longer line fits into no value
_MAX_NESTED_BYTES = 2**31 - 1
_CHUNK = 4 * 1024 * 1024
_BYTES_PER_BATCH = 16 * 1024 * 1024
_ROWS_PER_BATCH = 10_000

_MEMBER = "archive string, member string, member_seq int, size bigint, error string"
PACKED_SCHEMA = f"{_MEMBER}, method int, crc bigint, payload binary"
EXPANDED_SCHEMA = f"{_MEMBER}, block bigint, chunk binary"
_MEMBER_FIELDS = [("archive", pa.string()), ("member", pa.string()), ("member_seq", pa.int32()), ("size", pa.int64()), ("error", pa.string())]
_PACKED = pa.schema([*_MEMBER_FIELDS, ("method", pa.int32()), ("crc", pa.int64()), ("payload", pa.binary())])
_EXPANDED = pa.schema([*_MEMBER_FIELDS, ("block", pa.int64()), ("chunk", pa.binary())])


class ArchiveError(Exception):
    pass


def is_zip(head: bytes) -> bool:
    """Judged by content: archives may carry any suffix."""
    return head[:4] in ZIP_MAGIC


def _is_outside(name: str) -> bool:
    parts = name.replace("\\", "/").split("/")
    return ".." in parts or name.startswith(("/", "\\")) or (len(name) > 1 and name[1] == ":")


_END, _ENTRY = struct.Struct("<4s4H2IH"), struct.Struct("<4s6H3I5H2I")


def _infos(data: memoryview) -> list[zipfile.ZipInfo]:
    """The directory of an archive.  A plain one is read here, since zipfile takes longer for few
    short members than unpacking does; all else, whatever is wrong included, is for zipfile."""
    end, found = len(data) - _END.size, []
    if end >= 0:
        magic, disk, first_disk, here, total, size, at, comment = _END.unpack_from(data, end)
        if magic == ZIP_MAGIC[1] and not (disk or first_disk or comment) and here == total and at + size == end:
            while end - at >= _ENTRY.size:
                (magic, _, version, flags, method, _, _, crc, packed, unpacked, length, *more, offset) = _ENTRY.unpack_from(data, at)
                name = bytes(data[at + _ENTRY.size : at + _ENTRY.size + length])
                extra, remark, disk = more[:3]
                if magic != b"PK\x01\x02" or version > 63 or extra or remark or disk or not name.isascii() or 0 in name:
                    break
                if max(packed, unpacked, offset) == 0xFFFFFFFF:  # the true value lies elsewhere
                    break
                info = zipfile.ZipInfo(name.decode())
                info.flag_bits, info.compress_type, info.CRC = flags, method, crc
                info.compress_size, info.file_size, info.header_offset = packed, unpacked, offset
                found.append(info)
                at += _ENTRY.size + length
            if at == end and len(found) == total:
                return found
    with zipfile.ZipFile(io.BytesIO(data)) as archive:
        return archive.infolist()


def _packed(data: memoryview, info: zipfile.ZipInfo) -> memoryview:
    """The member's bytes as they lie in the archive."""
    head = data[info.header_offset : info.header_offset + 30]
    if len(head) < 30 or bytes(head[:4]) != ZIP_MAGIC[0]:
        raise ArchiveError(f"no header of '{info.filename}'")
    start = info.header_offset + 30 + sum(struct.unpack("<HH", head[26:30]))
    if start + info.compress_size > len(data):
        raise ArchiveError(f"'{info.filename}' is cut off")
    return data[start : start + info.compress_size]


def _decompressor(method: int):
    if method == zipfile.ZIP_STORED:
        return None
    if method == zipfile.ZIP_DEFLATED:
        return zlib.decompressobj(-15)
    if method == zipfile.ZIP_BZIP2:
        return bz2.BZ2Decompressor()
    if method == zipfile.ZIP_LZMA:
        return zipfile.LZMADecompressor()
    raise ArchiveError(f"packed by unknown method {method}")


def _stream(payload: memoryview, method: int) -> Iterator[bytes]:
    """A member's bytes in pieces of bounded size, whatever they were packed to."""
    unpack = _decompressor(method)
    for low in range(0, len(payload), _CHUNK):
        piece = bytes(payload[low : low + _CHUNK])
        if unpack is None:
            yield piece
        elif method == zipfile.ZIP_DEFLATED:
            while piece:
                yield unpack.decompress(piece, _CHUNK)
                piece = unpack.unconsumed_tail
        elif method == zipfile.ZIP_BZIP2:
            while not unpack.eof:
                yield unpack.decompress(piece, _CHUNK)
                piece = b""
                if unpack.needs_input:
                    break
        else:
            yield unpack.decompress(piece)
    if method == zipfile.ZIP_DEFLATED:
        yield unpack.flush()


def _checked(payload: memoryview, method: int, size: int, crc: int) -> Iterator[bytes]:
    """The same; damage is an error."""
    n, found = 0, 0
    for piece in _stream(payload, method):
        n, found = n + len(piece), zlib.crc32(piece, found)
        if n > size:
            raise ArchiveError(f"holds more than the {size} bytes it states")
        yield piece
    if n != size or found != crc:
        raise ArchiveError(f"damaged: {n} of {size} bytes, check sum {'differs' if found != crc else 'fits'}")


def _list_members(
    data: memoryview, prefix: str, depth: int, budget: list[int], max_depth: int, names: set[str]
) -> Iterator[tuple]:
    """Members of an archive and of archives inside it: (path, size, method, crc, payload).

    The second member of a name, and every further one, gets a number before its suffix."""
    if depth > max_depth:
        raise ArchiveError(f"nested deeper than {max_depth} levels")
    for info in _infos(data):
        if info.is_dir():
            continue
        if _is_outside(info.filename):
            raise ArchiveError(f"suspicious path '{info.filename}'")
        if info.flag_bits & 1:
            raise ArchiveError(f"'{info.filename}' is encrypted")
        budget[0] -= info.file_size
        if budget[0] < 0:
            raise ArchiveError("unpacks to more bytes than are allowed")
        payload, path = _packed(data, info), _unused(prefix + info.filename, names)
        head = b""
        for piece in _stream(payload, info.compress_type):
            head += piece[:4]
            if len(head) >= 4:
                break
        if not is_zip(head):
            yield path, info.file_size, info.compress_type, info.CRC, payload
            continue
        if info.file_size > _MAX_NESTED_BYTES:
            raise ArchiveError(f"'{info.filename}' is too large for an archive in an archive")
        inner = b"".join(_checked(payload, info.compress_type, info.file_size, info.CRC))
        yield from _list_members(memoryview(inner), path + "/", depth + 1, budget, max_depth, names)


def _unused(path: str, names: set[str]) -> str:
    found, n = path, 1
    folder, slash, name = path.rpartition("/")
    stem, dot, suffix = name.rpartition(".")
    while found in names:
        n += 1
        found = f"{folder}{slash}{stem}~{n}{dot}{suffix}" if stem else f"{path}~{n}"
    names.add(found)
    return found


def _reason(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _chunks(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Bytes cut after line ends (LF, CR or CRLF), without the last one of each chunk; a leading
    BOM is dropped.  A chunk stands for the lines that parting it at line ends gives."""
    held: list[bytes] = []
    n, first = 0, True
    for piece in pieces:
        held.append(piece)
        n += len(piece)
        if n < _CHUNK:
            continue
        if b"\n" not in piece and b"\r" not in piece:  # a long line, put together when it ends
            if n > MAX_LINE_BYTES:
                raise ArchiveError(f"a line of more than {MAX_LINE_BYTES} bytes")
            continue
        joined, first = _without_mark(b"".join(held), first), False
        # A CR at the end may be followed by an LF, so it waits.
        cut = max(joined.rfind(b"\n"), joined.rfind(b"\r", 0, len(joined) - 1)) + 1
        if cut:
            yield _without_end(joined[:cut])
        held, n = [joined[cut:]], len(joined) - cut
    rest = _without_mark(b"".join(held), first)
    if rest:
        yield _without_end(rest)


def _without_mark(data: bytes, first: bool) -> bytes:
    return data[3:] if first and data.startswith(b"\xef\xbb\xbf") else data


def _without_end(chunk: bytes) -> bytes:
    if chunk.endswith(b"\r\n"):
        return chunk[:-2]
    return chunk[:-1] if chunk.endswith((b"\n", b"\r")) else chunk


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches bounded in rows and bytes; the last value of a row is the large one."""
    held, weight = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        weight += len(row[-1] or b"")
        if len(held) >= _ROWS_PER_BATCH or weight >= _BYTES_PER_BATCH:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def _directory(max_bytes: int, max_depth: int):
    """(path, content) rows to packed members."""

    def rows(path: str, content: memoryview) -> Iterator[tuple]:
        try:
            for seq, (name, size, method, crc, payload) in enumerate(_list_members(content, "", 0, [max_bytes], max_depth, set())):
                yield path, name, seq, size, None, method, crc, bytes(payload)
        except Exception as e:  # noqa: BLE001  an archive can be wrong in any way
            yield path, None, None, None, _reason(e), None, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = ((path.as_py(), content) for b in batches for path, content in zip(b.column(0), b.column(1), strict=True))
        every = (row for path, content in given for row in rows(path, memoryview(content.as_buffer()) if content.is_valid else memoryview(b"")))
        yield from _batches(every, _PACKED)

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed members to one row each and one for every chunk."""

    def rows(archive, member, seq, size, error, method, crc, payload) -> Iterator[tuple]:
        if error is not None:
            yield archive, None, None, None, error, None, None
            return
        try:
            pieces = _checked(memoryview(payload.as_buffer()), method, size, crc)
            for block, chunk in enumerate(_chunks(pieces)):
                yield archive, member, seq, None, None, block, chunk
            yield archive, member, seq, size, None, None, None
        except Exception as e:  # noqa: BLE001
            yield archive, None, None, None, f"{_reason(e)} in '{member}'", None, None

    given = (x for b in batches for x in zip(*(b.column(c).to_pylist() for c in range(7)), b.column(7), strict=True))
    yield from _batches((row for x in given for row in rows(*x)), _EXPANDED)


def expand(archives: DataFrame, max_bytes: int = MAX_UNPACKED_BYTES, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Expand (path, content) rows: one row per member, one per chunk of lines, one per error.

    Write the result before it is read more than once: members of a refused archive are in it and
    are left out by :func:`members` and :func:`lines`."""
    packed = archives.select("path", "content").mapInArrow(_directory(max_bytes, max_depth), PACKED_SCHEMA)
    return packed.repartition("archive", "member_seq").mapInArrow(_unpack, EXPANDED_SCHEMA)


def members(expanded: DataFrame) -> DataFrame:
    """(archive, member, member_seq, size, file): every usable file, nested paths joined."""
    found = _of_usable(expanded, F.col("size").isNotNull())
    return found.select("archive", "member", "member_seq", "size", _file_name().alias("file"))


def lines(expanded: DataFrame) -> DataFrame:
    """Raw lines of all members: (file, block, rid, raw)."""
    found = _of_usable(expanded, F.col("chunk").isNotNull())
    parts = F.split(F.decode("chunk", "ISO-8859-1"), "\r\n|\n|\r", -1)
    cut = found.select(_file_name().alias("file"), "block", F.posexplode(parts).alias("rid", "line"))
    return cut.select("file", "block", F.col("rid").cast("bigint").alias("rid"), F.encode("line", "ISO-8859-1").alias("raw"))


def failures(expanded: DataFrame) -> DataFrame:
    """Archives that were refused, with their first error: (archive, error)."""
    return expanded.filter(F.col("error").isNotNull()).groupBy("archive").agg(F.min("error").alias("error"))


def _file_name():
    return F.concat_ws("/", "archive", "member")


def _of_usable(expanded: DataFrame, rows) -> DataFrame:
    return expanded.filter(rows).join(failures(expanded).select("archive"), "archive", "left_anti")
