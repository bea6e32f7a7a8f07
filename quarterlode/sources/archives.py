"""Archives and text files as one frame of numbered lines.

The only Python here: a task opens the files it was given and hands their text on
in chunks of whole lines. The lines are split and numbered by expressions.
"""

from __future__ import annotations

import io
import sys
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlode.functions.text import MEMBER_SUFFIX, SKIPPED_PREFIXES, base_name, logical_file
from quarterlode.operators.repairs import FILES_WITH_BAD_BYTES

# The reader travels to the executors with the plan; they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
CHUNK_SCHEMA = "path string, member string, first_line bigint, header string, chunk string, dropped bigint, latin bigint, error string"
CHUNK_BYTES = 4 * 1024 * 1024
# What a damaged archive raises: no directory, bad data, its end missing, a method or password that is not known.
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError)
DELETED = "deleted"  # stands for the lists of withdrawn cases among the tables


def binary_files(spark: SparkSession, path: str | Sequence[str], glob: str = "*") -> DataFrame:
    """Whole files; the content is read only if a later step asks for it."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths and base names of the files that match, sorted by path."""
    files = binary_files(spark, path, glob).select("path")
    return files.withColumn("name", base_name(F.col("path"))).orderBy("path")


def is_member(name: str) -> bool:
    """Whether an archive member holds report rows, by its base name."""
    lowered = name.lower()
    return (
        lowered.endswith(MEMBER_SUFFIX)
        and lowered[:4] not in SKIPPED_PREFIXES
        and not name.startswith(".")
    )


def is_deleted_list(path: str) -> bool:
    """Whether a member or file lists withdrawn cases: ``delete`` in its name or folder, in any case."""
    folder, _, name = path.rpartition("/")
    return name.lower().endswith(MEMBER_SUFFIX) and "delete" in f"{folder.rpartition('/')[2]}/{name}".lower()


def _texts(path: str, content: bytes, prefixes: Sequence[str]) -> Iterator[tuple[str, io.BufferedIOBase]]:
    """Name and open byte stream of each wanted text in a file."""
    wanted = tuple(prefixes)
    if not content.startswith((b"PK\x03\x04", b"PK\x05\x06")):
        yield path.rsplit("/", 1)[-1], io.BytesIO(content)
        return
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for info in archive.infolist():
            folder, slash, name = info.filename.rpartition("/")
            lowered = name.lower()
            listed = bool(name) and is_deleted_list(info.filename) and not name.startswith(".")
            report = bool(name) and is_member(name) and lowered.startswith(wanted or ("",))
            if (listed and (not wanted or DELETED in wanted)) or (report and not listed):
                with archive.open(info) as stream:
                    yield folder + slash + lowered, stream


def _decoded(raw: bytes, lossy: bool) -> tuple[str, int, int]:
    """Text, bytes left out and lines read as Latin-1.

    Only files known for it may lose bytes. In others, a line that is not UTF-8 is
    read as Latin-1, which every byte has a character in.
    """
    try:
        return raw.decode(), 0, 0
    except UnicodeDecodeError:
        pass
    if lossy:
        text = raw.decode(errors="ignore")
        return text, len(raw) - len(text.encode()), 0
    lines, latin = [], 0
    for line in raw.split(b"\n"):
        try:
            lines.append(line.decode())
        except UnicodeDecodeError:
            lines.append(line.decode("latin-1"))
            latin += 1
    return "\n".join(lines), 0, latin


def _chunks(stream: io.BufferedIOBase) -> Iterator[bytes]:
    """Bytes of a stream in pieces of whole lines."""
    held = []
    while block := stream.read(CHUNK_BYTES):
        cut = block.rfind(b"\n") + 1
        if cut:
            yield b"".join([*held, block[:cut]])
            held = [block[cut:]] if cut < len(block) else []
        else:
            held.append(block)
    if held:
        yield b"".join(held)


def _file_chunks(name: str, content: bytes, prefixes: Sequence[str], lossy: Sequence[str]) -> Iterator[dict]:
    """Chunks of the wanted texts of a file."""
    for member, stream in _texts(name, content, prefixes):
        loses = any(part.lower() in lossy for part in (name.replace("=", "/") + "/" + member).split("/"))
        at, header = 0, None
        for raw in _chunks(stream):
            raw = raw.removeprefix(b"\xef\xbb\xbf") if at == 0 else raw
            text, dropped, latin = _decoded(raw, loses)
            text = text.replace("\r\n", "\n").replace("\r", "\n").removesuffix("\n")
            header = text.partition("\n")[0] if header is None else header
            if raw:
                yield {"member": member, "first_line": at, "header": header, "chunk": text, "dropped": dropped, "latin": latin}
            at += text.count("\n") + 1


def _chunk_batches(
    batches: Iterable[pa.RecordBatch], prefixes: Sequence[str], lossy: Sequence[str], strict: bool = True
) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in CHUNK_SCHEMA.split(", ")]

    def row(path: str, **values) -> pa.RecordBatch:
        types = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([path if n == "path" else values.get(n)], t) for n, t in zip(names, types, strict=True)], names)

    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            name = path.as_py()
            try:
                for chunk in _file_chunks(name, content.as_py(), prefixes, lossy):
                    yield row(name, **chunk)
            except BROKEN as e:
                if strict:
                    raise
                yield row(name, dropped=0, latin=0, error=f"{type(e).__name__}: {e}")


def read_chunks(
    files: DataFrame, prefixes: Sequence[str] = (), lossy: Sequence[str] = FILES_WITH_BAD_BYTES, strict: bool = True
) -> DataFrame:
    """Text of ZIP members and plain text files in chunks of whole lines.

    ``files`` has the columns ``path`` and ``content``, as a batch or a stream.
    ``prefixes`` restricts archives to members of those tables (:data:`DELETED`
    names the lists of withdrawn cases), so that the others are not even
    inflated. ``lossy`` names the files that may lose bytes. Works on whole files
    up to the 2 GB a binary column can hold; for larger plain text see ``text_files``.

    Returns ``path, member, file, first_line, header, chunk, dropped, latin, error``: the
    header line, bytes left out of the chunk, and its lines read as Latin-1. An archive that
    cannot be read to its end stops the job; if not ``strict``, it gives a row with the
    reason in ``error`` and no chunk, behind what was read of it.
    """
    chunks = files.select("path", "content").mapInArrow(
        partial(_chunk_batches, prefixes=tuple(prefixes), lossy=tuple(lossy), strict=strict), CHUNK_SCHEMA)
    file = F.coalesce(logical_file(F.col("path")), F.lower(base_name(F.col("member"))))
    return chunks.withColumn("file", file)


def counted_lines(chunks: DataFrame) -> DataFrame:
    """Numbered lines of chunks, with what their decoding cost and why an archive could not be read.

    ``dropped`` and ``latin`` of a chunk stand at its first line, so that their sums stay right. A row with an
    ``error`` has no line.
    """
    lines = chunks.select("path", "member", "file", "first_line", "header", "dropped", "latin", "error", F.posexplode_outer(
        F.split("chunk", "\n")).alias("at", "line"))
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    return lines.select(
        "path", "member", "file", (F.col("first_line") + F.col("at")).alias("line_no"), "header", "line",
        *[F.when(first, F.col(c)).otherwise(F.lit(0).cast("bigint")).alias(c) for c in ("dropped", "latin")], "error")


def split_lines(chunks: DataFrame) -> DataFrame:
    """Numbered lines of chunks: ``path, member, file, line_no, header, line``; line 0 is the header."""
    lines = chunks.select("path", "member", "file", "first_line", "header", F.posexplode(F.split("chunk", "\n")).alias("at", "line"))
    return lines.select("path", "member", "file", (F.col("first_line") + F.col("at")).alias("line_no"), "header", "line")


def read_lines(files: DataFrame, prefixes: Sequence[str] = (), lossy: Sequence[str] = FILES_WITH_BAD_BYTES) -> DataFrame:
    """Numbered lines with their header line; see :func:`read_chunks` and :func:`split_lines`."""
    return split_lines(read_chunks(files, prefixes, lossy))


def decoding_report(chunks: DataFrame) -> DataFrame:
    """Files that lost bytes, or have lines read as Latin-1: ``file, dropped, latin``."""
    found = chunks.groupBy("file").agg(F.sum("dropped").alias("dropped"), F.sum("latin").alias("latin"))
    return found.where("dropped > 0 OR latin > 0")


def in_deleted_list(path: Column, member: Column) -> Column:
    """:func:`is_deleted_list` for lines: by the member in an archive, else by the path."""
    named = F.when(F.lower(path).endswith(MEMBER_SUFFIX), path).otherwise(member)
    return F.lower(named).rlike(r"(?:^|/)(?:[^/]*delete[^/]*/[^/]*|[^/]*delete[^/]*)\.txt$")


def deleted_id(line: Column) -> Column:
    """The id in a line of a list of withdrawn cases; null if it is no number."""
    text = F.trim(line)
    return F.when(text.rlike("^[0-9]{1,18}$"), text).cast("bigint")


def deleted_lines(lines: DataFrame) -> DataFrame:
    """Ids of withdrawn cases, ``caseid, line``: the lists have no header, a line that is no number has a null id."""
    listed = lines.where(in_deleted_list(F.col("path"), F.col("member")) & (F.trim("line") != ""))
    return listed.select(deleted_id(F.col("line")).alias("caseid"), "line")
