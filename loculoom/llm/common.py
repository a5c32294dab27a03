"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where a local session names none (tests, benchmarks)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="loculoom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


#: Intermediate tables of this process, for ``remove_cuts``.
CUTS: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: each row is computed once, and lost executors lose nothing."""
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    CUTS.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_cuts(spark: SparkSession) -> int:
    """Delete the intermediate tables that ``cut`` wrote, once the results that read them are written; returns their number."""
    n = len(CUTS)
    while CUTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(CUTS.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, with underscores if ``docs`` has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """Add a number that is unique within one scan, whatever the doc_id.  Another scan may be split otherwise and number
    otherwise: what two scans must agree on takes ``keyed``.  A frame that is not read from files is written first."""
    if not docs.inputFiles():
        docs = cut(docs)
    return docs.withColumn(name, F.monotonically_increasing_id())


def one_scan(docs: DataFrame) -> bool:
    """Whether the plan only reads, selects and filters, so that each row is one row of one file, and no file is read twice."""
    plan = docs._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    while True:
        kind = plan.getClass().getSimpleName()
        if kind == "LogicalRelation":
            break
        if kind not in ("Project", "Filter", "SubqueryAlias", "View"):
            return False
        plan = plan.children().apply(0)
    try:
        roots = plan.relation().location().rootPaths()
    except Py4JError:
        return False
    paths = sorted(f"{roots.apply(i).toString().rstrip('/')}/" for i in range(roots.size()))
    return not any(b.startswith(a) for a, b in zip(paths, paths[1:]))


def keyed(docs: DataFrame, file: str = "file", at: str = "at") -> DataFrame:
    """Add two longs that name every row, whatever its doc_id: a hash of its file's path, and its place in that file.

    They belong to the stored row, so every scan gives the same ones, however the table is split and whichever executors are lost
    between the scans.  A frame that does more than read Parquet files, select and filter is written first (so is one that reads a file twice).
    The path counts with 87 bits of hash, 23 of them above the place in the file, which is below 2^40."""
    if one_scan(docs):
        try:
            return with_key(docs, file, at)
        except AnalysisException:  # another format than Parquet has no place in the file
            pass
    return with_key(cut(docs), file, at)


def with_key(docs: DataFrame, file: str, at: str) -> DataFrame:
    meta = docs.metadataColumn("_metadata")
    more = F.pmod(F.xxhash64(F.lit("more"), meta["file_path"]), F.lit(1 << 23))
    return docs.withColumns({file: F.xxhash64(meta["file_path"]), at: meta["row_index"] + more * F.lit(1 << 40)})


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows and characters that a Python operator holds at once.
SLICE_ROWS, SLICE_CHARS = 2_000, 4_000_000


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of (id, text) batches, cut small; a null text is empty.  Of several columns before the text an id is a tuple."""
    for batch in batches:
        ids, texts, size = [], [], 0
        keys = [c.to_pylist() for c in batch.columns[:-1]]
        for i, t in zip(keys[0] if len(keys) == 1 else zip(*keys), batch.columns[-1]):
            t = t.as_py() or ""
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= SLICE_CHARS or len(ids) >= SLICE_ROWS:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def map_texts(docs: DataFrame, each: Callable[[list, list[str]], dict[str, list]], schema: str, *more: str) -> DataFrame:
    """Apply ``each(ids, texts)``, which returns columns of lists, to slices of whole texts; with ``more`` columns an id is a tuple."""
    out = pa_schema(schema, docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            got = each(ids, texts)
            if len(got[out.names[0]]):
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return docs.select("doc_id", *more, "text").mapInArrow(run, schema)


def pa_schema(schema: str, docs: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def crc_mod(doc_id: str, k: int):
    """crc32 of the id as text, modulo ``k``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % k
