"""Files that Spark's own sources do not read or write: seeks, and single files written by many tasks.

Executors open files through Arrow's filesystems (local and mounted paths, hdfs, s3, gs).  A single file is written in two phases: every
task writes a part of its own beside the target and reports it; the driver's commit puts the parts in order behind the header, as
a stream of bytes, and only then gives the file its name.  A failed job leaves nothing.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

COPY = 8 << 20
#: Most splits of a file that is read by ranges: of a large file they are larger than asked.
SPLITS = 1024


def scratch(spark: SparkSession) -> str:
    """A new folder path that all executors share; a machine's own only where a local session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="loculoom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/files-{uuid.uuid4().hex}"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a path, and the path in it."""
    path = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def size_of(path: str) -> int:
    store, inner = opened(path)
    info = store.get_file_info(inner)
    if info.type != fs.FileType.File:
        raise ValueError(f"{path} is not a file")
    return info.size


def read_at(path: str, at: int, n: int) -> bytes:
    store, inner = opened(path)
    with store.open_input_file(inner) as f:
        return f.read_at(n, at)


def piece_path(path: str, piece: int) -> str:
    """The file of a piece: its number, whose places are those of its name among the others', before the ending."""
    root, ending = path.rsplit(".", 1)
    return f"{root}.{piece:06d}.{ending}"


def piece_paths(path: str) -> list[str]:
    """The files of all pieces, in their order."""
    folder, name = path.rsplit("/", 1)
    root, ending = name.rsplit(".", 1)
    store, inner = opened(folder)
    found = (f.base_name for f in store.get_file_info(fs.FileSelector(inner)))
    return [f"{folder}/{x}" for x in sorted(x for x in found if re.fullmatch(rf"{re.escape(root)}\.\d{{6}}\.{re.escape(ending)}", x))]


def blocks(total: int, step: int) -> list[tuple[int, int]]:
    """[from, to) ranges that cover ``total`` in steps, of 1 at least."""
    step = max(1, step)
    return [(a, min(total, a + step)) for a in range(0, total, step)]


def numbered_lines(spark: SparkSession, path: str, skip: str | None = None, blank: bool = False) -> DataFrame:
    """ord (from 0) and value of the lines of a text file, or of the parts of one in the order of their names; lines that begin with ``skip`` and
    (unless ``blank``) blank ones do not count.  Splits are counted and then read with the same boundaries, so a large file is never one value."""
    spark.read.text(path)  # a path that is not there is told as by any reader
    # an RDD keeps its splits, which those of a table may not; its lines stay Spark's own and pass no Python
    rdd = spark.sparkContext._jsc.textFile(path).rdd()
    lines = DataFrame(spark._jsparkSession.createDataset(rdd, spark._jvm.Encoders.STRING()).toDF(), spark)
    if not blank:
        lines = lines.filter(F.col("value").rlike(r"(?U)[^\s\x1c-\x1f]"))
    if skip:
        lines = lines.filter(~F.col("value").startswith(skip))
    placed = lines.withColumn("place_", F.monotonically_increasing_id())
    sizes, starts, n = placed.groupBy(F.shiftright("place_", 33).cast("int").alias("range_")).count().orderBy("range_").collect(), [], 0
    for r in sizes:
        starts.append((r.range_, n))
        n += r["count"]
    return numbered(placed, spark.createDataFrame(starts, "range_ int, before_ long")).select("ord", "value")


def numbered(placed: DataFrame, before: DataFrame) -> DataFrame:
    """``ord`` of rows whose ``place_`` is an increasing id, by the rows ``before_`` each range: one a task, so few."""
    own = F.col("place_").bitwiseAND(F.lit((1 << 33) - 1))
    rows = placed.withColumn("range_", F.shiftright("place_", 33).cast("int")).join(F.broadcast(before), "range_")
    return rows.withColumn("ord", F.col("before_") + own).drop("place_", "range_", "before_")


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote: its rows [first, last], and the part's name and size.  A task without rows has no name."""

    name: str | None = None
    first: int = 0
    last: int = -1
    size: int = 0


class SingleFile(DataSourceArrowWriter):
    """Writes rows that come in ranges of ``ord`` as one file.  Subclasses encode rows and head the file."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.options = options["path"], overwrite, dict(options)
        self.parts = f"{self.path}.parts-{uuid.uuid4().hex}"
        store, inner = opened(self.path)
        if not overwrite and store.get_file_info(inner).type != fs.FileType.NotFound:
            raise ValueError(f"{self.path} exists")

    def encode(self, batch: pa.RecordBatch) -> bytes:
        raise NotImplementedError

    def finish(self) -> bytes:
        """The last bytes of a part."""
        return b""

    def index(self) -> bytes:
        """What the commit needs to know of a part's rows; it is kept beside the part."""
        return b""

    def head(self, parts: list[Part]) -> Iterable[bytes]:
        return ()

    def tail(self) -> bytes:
        return b""

    def at_once(self) -> int:
        """Rows that are encoded at once."""
        return 1 << 16

    def beside(self, parts: list[Part], start: int) -> None:
        """A further file that goes with this one; ``start`` is the length of the head."""

    def begin(self) -> None:
        """Before the first row of a part."""

    def add(self, b: pa.RecordBatch) -> None:
        ords = b.column(b.schema.get_field_index("ord")).to_numpy()
        if self.out is None:
            store, folder = opened(self.parts)
            store.create_dir(folder, recursive=True)
            self.part.name, self.part.first, self.part.last = uuid.uuid4().hex, int(ords[0]), int(ords[0]) - 1
            self.out = store.open_output_stream(f"{folder}/{self.part.name}", compression=None)
            self.begin()
        if (ords[1:] != ords[:-1] + 1).any() or ords[0] != self.part.last + 1:
            raise ValueError("rows are not in consecutive order of ord")
        self.part.last = int(ords[-1])
        step = max(1, self.at_once())
        for k in range(0, b.num_rows, step):
            self.put(self.encode(b.slice(k, step)))

    def put(self, data: bytes) -> None:
        self.part.size += len(data)
        self.out.write(data)

    def end(self) -> Part:
        if self.out is not None:
            self.put(self.finish())
            self.out.close()
            store, folder = opened(self.parts)
            if extra := self.index():
                with store.open_output_stream(f"{folder}/{self.part.name}.index", compression=None) as out:
                    out.write(extra)
        return self.part

    def index_of(self, part: Part) -> bytes:
        store, folder = opened(self.parts)
        with store.open_input_file(f"{folder}/{part.name}.index") as f:
            return f.read()

    def write(self, batches: Iterator[pa.RecordBatch]) -> Part:
        self.part, self.out = Part(), None
        for b in batches:
            if b.num_rows:
                self.add(b)
        return self.end()

    def commit(self, messages: list[Part | None]) -> None:
        self.assemble(messages)
        self.publish()

    def assemble(self, messages: list[Part | None], first: int = 0) -> int:
        """All parts behind the head, in a file that has no name yet; its rows are those from ``first`` on, and what comes back is the next one.
        A part goes as soon as it is copied, so the file is not held twice."""
        parts = sorted((m for m in messages if m is not None and m.name), key=lambda m: m.first)
        for before, p in zip([Part(last=first - 1), *parts], parts):
            if p.first != before.last + 1:
                raise ValueError(f"rows {before.last + 1} to {p.first - 1} are missing or repeated")
        store, folder = opened(self.parts)
        store.create_dir(folder, recursive=True)
        start = 0
        with store.open_output_stream(f"{folder}/whole", compression=None) as out:
            for data in self.head(parts):
                start += len(data)
                out.write(data)
            for p in parts:
                with store.open_input_stream(f"{folder}/{p.name}", compression=None) as piece:
                    while data := piece.read(COPY):
                        out.write(data)
                store.delete_file(f"{folder}/{p.name}")
            out.write(self.tail())
        self.beside(parts, start)
        return parts[-1].last + 1 if parts else first

    def publish(self) -> None:
        store, inner = opened(self.path)
        _, folder = opened(self.parts)
        store.move(f"{folder}/whole", inner)
        store.delete_dir(folder)

    def abort(self, messages: list[Part | None]) -> None:
        store, folder = opened(self.parts)
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


@dataclass
class Parts(WriterCommitMessage):
    of: list[Part]


class Several(DataSourceArrowWriter):
    """Several single files of the same rows in one pass: all are put together before the first gets its name."""

    def __init__(self, files: list[SingleFile]):
        self.files = files

    def start(self) -> None:
        for f in self.files:
            f.part, f.out = Part(), None

    def put(self, batch: pa.RecordBatch) -> None:
        for f in self.files:
            f.add(batch)

    def done(self) -> Parts:
        return Parts([f.end() for f in self.files])

    def write(self, batches: Iterator[pa.RecordBatch]) -> Parts:
        self.start()
        for b in batches:
            if b.num_rows:
                self.put(b)
        return self.done()

    def commit(self, messages: list[Parts | None]) -> None:
        self.assemble([m for m in messages if m is not None])
        self.publish()

    def assemble(self, messages: list[Parts], first: int = 0) -> int:
        return max([f.assemble([m.of[k] for m in messages], first) for k, f in enumerate(self.files)], default=first)

    def publish(self) -> None:
        for f in self.files:
            f.publish()

    def abort(self, messages: list[Parts | None]) -> None:
        for f in self.files:
            f.abort([])


def write_lines(lines: DataFrame, path: str, head: str = "", order: tuple[str, ...] = ("ord",)) -> None:
    """One text file of the column ``value`` of ``lines`` in the order of the columns ``order``, behind a head: Spark's own writer makes a part of every range, and the parts are put
    together as a stream of bytes."""
    store, inner = opened(path)
    if store.get_file_info(inner).type != fs.FileType.NotFound:
        raise ValueError(f"{path} exists")
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    _, folder = opened(parts)
    try:
        in_ranges(lines, *order).select("value").write.option("lineSep", "\n").option("compression", "none").text(parts)
        with store.open_output_stream(f"{folder}/whole", compression=None) as out:
            out.write(head.encode())
            # the number of a part, which is that of its range, then that of a part's file
            found = [f.path for f in store.get_file_info(fs.FileSelector(folder)) if f.base_name.startswith("part-")]
            for p in sorted(found, key=lambda p: (int(p.rsplit("/", 1)[-1].split("-")[1]), p)):
                with store.open_input_stream(p, compression=None) as piece:
                    while data := piece.read(COPY):
                        out.write(data)
                # a part goes as soon as it is copied, so the file is not held twice
                store.delete_file(p)
        store.move(f"{folder}/whole", inner)
    finally:
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """Rows dealt to tasks by ranges of ``order`` (else ``ord``), in order."""
    order = order or ("ord",)
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def kept(df: DataFrame) -> DataFrame:
    """The rows, written: computed once, whatever is made of them."""
    at = scratch(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def ranked(df: DataFrame, *order) -> DataFrame:
    """Add ``ord``, the place (from 0) in the given ascending order, without a task that sees all rows: ranges are sorted, counted and numbered.

    The ranges are written first, since their boundaries are drawn by sampling and would not be the same again."""
    at = scratch(df.sparkSession)
    # an expression is a column of its own before rows are sorted: a sort would compute it anew at every comparison
    made = {f"key{k}_": c for k, c in enumerate(order) if not isinstance(c, str)}
    keys = [c if isinstance(c, str) else f"key{k}_" for k, c in enumerate(order)]
    placed = in_ranges(df.withColumns(made), *keys).drop(*made).withColumn("place_", F.monotonically_increasing_id())
    placed.write.parquet(at)
    placed = df.sparkSession.read.schema(placed.schema).parquet(at)
    # one row a range, so the running sum over them is small
    sizes, below = placed.groupBy(F.shiftright("place_", 33).cast("int").alias("range_")).count(), Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    return numbered(placed, sizes.select("range_", F.coalesce(F.sum("count").over(below), F.lit(0)).alias("before_")))
