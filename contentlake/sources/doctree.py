"""Document trees: distributed listing, reading and writing of text files.

Spark's file sources skip names that start with ``_`` or ``.``, which would lose ``_index.md``,
hence a small Python data source. It lists names only. The paths are then spread over tasks and
each task reads its share, so neither a deep nor a flat tree ends up in one task. Paths may be
local or any URI that Arrow's file systems know (hdfs, s3, gs).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..functions.common import unify_newlines
from ..session import PAGE_BYTES, limit_batches

def plain_root(root: str) -> str:
    """A root as Arrow takes it: ``file:`` URIs become paths, other URIs stay."""
    return re.sub(r"\Afile:/+", "/", root).rstrip("/")


def below_root(path: Column, root: str) -> Column:
    """Path relative to the root it was listed under."""
    base = re.sub(r"\A[a-z0-9+]+://", "", plain_root(root))
    return path.substr(len(base) + 2, 1 << 30)


LISTING, WRITER = "contentlake_listing", "contentlake_tree"


def _register_listing(spark: SparkSession) -> None:
    # classes are built here so that they travel to the executors by value
    class Folders(InputPartition):
        def __init__(self, shallow: list[str], deep: list[str]) -> None:
            self.shallow, self.deep = shallow, deep

    class ListingReader(DataSourceReader):
        def __init__(self, options: dict) -> None:
            self.root = options["path"]
            self.folders = int(options.get("folders", "64"))

        def partitions(self) -> list[InputPartition]:
            """Folder names only, dealt out evenly: subtrees, and upper folders without theirs."""
            from pyarrow import fs

            system, root = fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)
            shallow, level = [], [root]
            while level and len(shallow) + len(level) < self.folders:
                shallow += level
                level = [
                    info.path
                    for folder in level
                    for info in system.get_file_info(fs.FileSelector(folder, recursive=False))
                    if info.type == fs.FileType.Directory
                ]
            n = max(1, min(self.folders, len(shallow) + len(level)))
            return [Folders(shallow[i::n], level[i::n]) for i in range(n)]

        def read(self, partition: Folders) -> Iterator[tuple]:
            from pyarrow import fs

            system = fs.FileSystem.from_uri(self.root)[0] if "://" in self.root else fs.LocalFileSystem()
            pending = [(p, False) for p in partition.shallow] + [(p, True) for p in partition.deep]
            while pending:
                folder, deep = pending.pop()
                for info in system.get_file_info(fs.FileSelector(folder, recursive=False)):
                    if info.type == fs.FileType.File:
                        yield info.path, info.size
                    elif info.type == fs.FileType.Directory and deep:
                        pending.append((info.path, True))

    class Listing(DataSource):
        @classmethod
        def name(cls) -> str:
            return LISTING

        def schema(self) -> str:
            return "path string, size bigint"

        def reader(self, schema) -> DataSourceReader:
            return ListingReader(dict(self.options))

    spark.dataSource.register(Listing)


def list_files(spark: SparkSession, root: str, folders: int | None = None) -> DataFrame:
    """(path, size) of every file below ``root``, hidden names included."""
    _register_listing(spark)
    folders = folders or 2 * spark.sparkContext.defaultParallelism
    return spark.read.format(LISTING).option("folders", folders).load(plain_root(root))


def declared_text(data: bytes) -> str:
    """Text of an XML file: by its byte order mark, the encoding it declares, or UTF-8.

    The declaration is dropped from text in another encoding, since it no longer holds.
    """
    for mark, name in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if data.startswith(mark):
            return re.sub(r"\A<\?xml[^>]*\?>", "", data.decode(name))
    told = re.match(rb"""\s*<\?xml[^>]*\bencoding\s*=\s*["']([A-Za-z0-9._-]+)["'][^>]*\?>""", data)
    if told is None or told[1].lower() in (b"utf-8", b"utf8"):
        return data.decode("utf-8")
    try:
        return data[told.end() :].decode(told[1].decode())
    except LookupError as unknown:
        raise ValueError(str(unknown)) from None


def has_extension(path: Column, extension: str, ignore_case: bool) -> Column:
    return (F.lower(path).endswith(extension.lower())) if ignore_case else path.endswith(extension)


def read_doc_tree(
    spark: SparkSession,
    root: str,
    extension: str = ".md",
    ignore_case: bool = True,
    skip_index: str | None = None,
    tasks: int | None = None,
    decode: Callable[[bytes], str] | None = None,
) -> DataFrame:
    """(path, content, error) of the text files below ``root``.

    ``decode`` turns bytes into text; UTF-8 when unset.

    ``skip_index`` drops ``_index.md``: ``exact`` spelling or in ``any`` case. Line ends are
    unified. A file that cannot be read keeps its row, with the reason in ``error``.
    """
    limit_batches(spark, PAGE_BYTES)
    files = list_files(spark, root)
    path = F.col("path")
    files = files.filter(has_extension(path, extension, ignore_case))
    if skip_index:
        index = r"(?:\A|/)_index\.md\z"
        files = files.filter(~path.rlike(index if skip_index == "exact" else "(?i)" + index))
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    located = files.select("path").repartition(tasks, "path")
    remote = plain_root(root) if "://" in plain_root(root) else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow
        from pyarrow import fs

        system = fs.FileSystem.from_uri(remote)[0] if remote else fs.LocalFileSystem()

        def batch(rows):
            return pyarrow.RecordBatch.from_pydict(
                {name: pyarrow.array([r[i] for r in rows], pyarrow.string()) for i, name in enumerate(("path", "content", "error"))}
            )

        for incoming in batches:
            rows, size = [], 0
            for name in incoming.column("path").to_pylist():
                try:
                    with system.open_input_stream(name, compression=None) as stream:
                        data = stream.read()
                        rows.append((name, decode(data) if decode else data.decode("utf-8"), None))
                except (OSError, ValueError) as problem:
                    rows.append((name, None, f"Error reading {name}: {problem}"))
                size += len(rows[-1][1] or "")
                if size > PAGE_BYTES:  # hand over about so much at a time
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    texts = located.mapInArrow(read, "path string, content string, error string")
    return texts.withColumn("content", unify_newlines("content"))


def read_xml_docs(spark: SparkSession, root: str, languages: list[str], tasks: int | None = None) -> DataFrame:
    """(path, xml, error, lang) of ``xml/<lang>/docs/**/*.xml``; absent language folders yield no rows.

    Files are read in the encoding they declare.
    """
    docs = read_doc_tree(spark, root, ".xml", tasks=tasks, decode=declared_text)
    return select_languages(docs.select(below_root(F.col("path"), root).alias("path"), F.col("content").alias("xml"), "error"), languages)


def select_languages(docs: DataFrame, languages: list[str]) -> DataFrame:
    lang = F.regexp_extract("path", r"\Axml/([^/]+)/docs/", 1)
    return docs.withColumn("lang", lang).filter(F.col("lang").isin(languages))


def _register_writer(spark: SparkSession) -> None:
    class Written(WriterCommitMessage):
        pass

    class TreeWriter(DataSourceWriter):
        def __init__(self, root: str) -> None:
            self.root = root

        def write(self, rows) -> WriterCommitMessage:
            from pyarrow import fs

            system, root = fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)
            made = set()
            for row in rows:
                target = f"{root}/{row['path'].lstrip('/')}"
                folder = target.rpartition("/")[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                # same path, same bytes: a repeated task attempt is harmless
                with system.open_output_stream(target, compression=None) as out:
                    out.write(row["content"].encode("utf-8"))
            return Written()

    class Tree(DataSource):
        @classmethod
        def name(cls) -> str:
            return WRITER

        def schema(self) -> str:
            return "path string, content string"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return TreeWriter(self.options["path"].rstrip("/"))

    spark.dataSource.register(Tree)


def unwritable(docs: DataFrame) -> DataFrame:
    """(path, reason) of documents that get no file: without text, or with a path that leaves the root."""
    path = F.col("path")
    reason = F.when(path.isNull() | path.rlike(r"(?:\A|[/\\\\])\.\.(?:[/\\\\]|\z)"), "path leaves the root").when(
        F.col("content").isNull(), F.coalesce(F.col("error"), F.lit("no text")) if "error" in docs.columns else F.lit("no text")
    )
    return docs.select("path", reason.alias("reason")).filter(F.col("reason").isNotNull())


def write_doc_tree(docs: DataFrame, root: str) -> DataFrame:
    """Write (path, content) as files below a new root; never over the tree that is read.

    Returns what was left out, see :func:`unwritable`: a document that failed leaves no empty file behind.
    """
    _register_writer(docs.sparkSession)
    limit_batches(docs.sparkSession, PAGE_BYTES)
    path = F.col("path")
    inside = path.isNotNull() & F.col("content").isNotNull() & ~path.rlike(r"(?:\A|[/\\\\])\.\.(?:[/\\\\]|\z)")
    docs.filter(inside).select("path", "content").write.format(WRITER).mode("append").save(plain_root(root))
    return unwritable(docs)
