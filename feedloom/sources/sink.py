"""Publication as a sink: feeds are written by the tasks that hold them, and put in place by one commit."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "feedloom_feeds"
SCHEMA = "path string, starts_at string, id string, wire string"


@dataclass
class Staged(WriterCommitMessage):
    """What one task has written: its own folder, and the paths below it."""

    folder: str
    paths: list[str]


def _files(root: str):
    """The file system of a folder's uri, and its path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")


class FeedWriter(DataSourceWriter):
    """Rows sorted by path, starts_at and id to one JSON array for each path, two spaces of indent, ASCII, a last line
    break; a row without an object stands for a feed that may be empty. A task streams: it holds one record.

    Tasks write below a folder of their own. The commit moves the files of the tasks that Spark accepted into place, one
    rename for each; tasks that were killed, repeated or given up leave only their folder, which goes with the rest. So a
    run that fails in any task leaves the tree as it was. With `plain`, a row's text is the file."""

    def __init__(self, root: str, run: str, plain: bool = False):
        self.root, self.run, self.plain = root.rstrip("/"), run, plain

    def _staging(self, base: str) -> str:
        return f"{base}/_staged-{self.run}"

    def write(self, iterator: Iterator[Row]) -> Staged:
        files, base = _files(self.root)
        folder, paths, out, first, now = uuid.uuid4().hex, [], None, True, None

        def ended():
            if not self.plain:
                out.write(b"[]\n" if first else b"\n]\n")
            out.close()

        for r in iterator:
            if r.path != now:
                if out is not None:
                    ended()
                now, first = r.path, True
                target = f"{self._staging(base)}/{folder}/{r.path}"
                files.create_dir(target.rsplit("/", 1)[0], recursive=True)
                out = files.open_output_stream(target)
                paths.append(r.path)
            if self.plain:
                out.write((r.wire or "").encode())
            elif r.wire is not None:
                body = json.dumps(json.loads(r.wire), indent=2, ensure_ascii=True).replace("\n", "\n  ")
                out.write((("[\n  " if first else ",\n  ") + body).encode())
                first = False
        if out is not None:
            ended()
        return Staged(folder, paths)

    def commit(self, messages: list[Staged | None]) -> None:
        from pyarrow import fs

        files, base = _files(self.root)
        for m in messages:
            for path in m.paths if m else ():
                target = f"{base}/{path}"
                files.create_dir(target.rsplit("/", 1)[0], recursive=True)
                if not isinstance(files, fs.LocalFileSystem) and files.get_file_info(target).type != fs.FileType.NotFound:
                    files.delete_file(target)  # where a rename doesn't replace
                files.move(f"{self._staging(base)}/{m.folder}/{path}", target)
        self._cleared(files, base)

    def abort(self, messages: list[Staged | None]) -> None:
        self._cleared(*_files(self.root))

    def _cleared(self, files, base: str) -> None:
        from pyarrow import fs

        if files.get_file_info(self._staging(base)).type == fs.FileType.Directory:
            files.delete_dir(self._staging(base))


class FeedSink(DataSource):
    """format FORMAT; option root: the uri of the tree."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> FeedWriter:
        return FeedWriter(self.options["root"], uuid.uuid4().hex, self.options.get("plain") == "true")


def write(feeds: DataFrame, root: str, plain: bool = False) -> None:
    """Feeds (path, starts_at, id, wire) as files below root. Each path is one task's, as each is one file; tasks hold
    whole paths, sorted. plain: the texts themselves are the files."""
    spark: SparkSession = feeds.sparkSession
    spark.dataSource.register(FeedSink)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = feeds.select("path", "starts_at", "id", "wire").repartition(n, "path").sortWithinPartitions("path", F.col("wire").isNotNull(), "starts_at", "id")
    rows.write.format(FORMAT).option("root", root).option("plain", str(plain).lower()).mode("append").save()
