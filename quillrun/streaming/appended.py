"""Log lines as they are appended to files, half-written ones left for later.

Spark's file stream sees whole new files only. Training runs keep a log open and flush
lines into it, so this source remembers a place in each file: always behind a line end,
with a checksum of the bytes before it. A file that was cut short or replaced is known by
that, and read anew from its beginning.
"""

from __future__ import annotations

import fnmatch
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "appended_lines"
SCHEMA = "file string, at long, line string"
# Bytes before a place that are checked, bytes read at once, and rows of a batch.
CHECKED = 256
CHUNK = 1 << 16
ROWS = 10_000


class Piece(InputPartition):
    """Lines of a file that begin at or behind ``begin`` and before ``end``."""

    def __init__(self, path: str, begin: int, end: int, whole: bool):
        self.path, self.begin, self.end, self.whole = path, begin, end, whole


class AppendedLinesReader(DataSourceStreamReader):
    """Offsets are ``{file: [place, checksum]}``; files without a whole line have none."""

    def __init__(self, folder: str, pattern: str, piece_bytes: int):
        self.folder, self.pattern, self.piece_bytes = folder, pattern, piece_bytes

    def _files(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.folder or self.folder.startswith("file:"):
            return fs.FileSystem.from_uri(self.folder)
        return fs.LocalFileSystem(), self.folder

    def initialOffset(self) -> dict:
        return {}

    def _checksum(self, file, place: int) -> int:
        file.seek(max(0, place - CHECKED))
        return zlib.crc32(file.read(min(place, CHECKED)))

    def _last_line_end(self, file, size: int) -> int:
        """The place behind the last line end, looked for from the end of the file."""
        end = size
        while end > 0:
            begin = max(0, end - CHUNK)
            file.seek(begin)
            found = file.read(end - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
        return 0

    def latestOffset(self) -> dict:
        files, root = self._files()
        offsets = {}
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        for info in sorted(found, key=lambda i: i.path):
            if info.type != fs.FileType.File or not fnmatch.fnmatch(info.base_name, self.pattern):
                continue
            with files.open_input_file(info.path) as file:
                place = self._last_line_end(file, file.size())
                if place:
                    offsets[info.path] = [place, self._checksum(file, place)]
        return offsets

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        files, _ = self._files()
        pieces = []
        for path, (place, _) in sorted(end.items()):
            begin = 0
            if path in start:
                before, checksum = start[path]
                with files.open_input_file(path) as file:
                    same = before <= min(place, file.size()) and self._checksum(file, before) == checksum
                begin = before if same else 0
            for at in range(begin, place, self.piece_bytes):
                pieces.append(Piece(path, at, min(place, at + self.piece_bytes), at == begin))
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        files, _ = self._files()
        with files.open_input_file(partition.path) as file:
            at, places, lines = partition.begin, [], []
            if not partition.whole:  # a line that begins before belongs to the piece before
                at -= 1
            file.seek(at)
            rest, skip = b"", not partition.whole
            while at < partition.end:
                more = file.read(CHUNK)
                if not more:
                    break
                found = (rest + more).split(b"\n")
                rest = found.pop()
                for line in found:
                    if at >= partition.end:
                        break
                    if not skip:
                        places.append(at)
                        lines.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                    skip = False
                    at += len(line) + 1
                if len(lines) >= ROWS:
                    yield self._batch(partition.path, places, lines)
                    places, lines = [], []
            if lines:
                yield self._batch(partition.path, places, lines)

    def _batch(self, path: str, places: list[int], lines: list[str]) -> pa.RecordBatch:
        name = path.rsplit("/", 1)[-1]
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(lines)), pa.array(places, pa.int64()), pa.array(lines)],
            ["file", "at", "line"],
        )


class AppendedLines(DataSource):
    """Options: ``path``, a folder; ``pattern`` of file names; ``pieceBytes`` of a task."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> AppendedLinesReader:
        return AppendedLinesReader(
            self.options["path"],
            self.options.get("pattern", "*"),
            int(self.options.get("pieceBytes", 64 << 20)),
        )


def stream_appended(
    spark: SparkSession, folder: str, pattern: str = "*.out", piece_bytes: int = 64 << 20
) -> DataFrame:
    """``(job, file, at, ts, line)``: lines once they are whole, ``ts`` when they were read.

    Every line is read once, also after a restart from the same checkpoint. ``at`` is its
    byte in the file. The folder is listed anew for every batch; long files are cut into
    tasks of ``piece_bytes``. A job is named by the files as `formats.LOG_FILES` says.
    """
    spark.dataSource.register(AppendedLines)
    lines = (
        spark.readStream.format(FORMAT)
        .option("path", folder)
        .option("pattern", pattern)
        .option("pieceBytes", piece_bytes)
        .load()
    )
    job = F.nullif(F.regexp_extract("file", r"\.([^.]+)\.[^.]*\.out$", 1), F.lit(""))
    return lines.select(job.alias("job"), "file", "at", F.current_timestamp().alias("ts"), "line")
