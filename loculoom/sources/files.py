"""Genotype files of a cohort: one frame of variants, any number of files of it in one pass."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructField, StructType

from ..operators import variants
from .bcf import BcfSource, BcfWriter, BimWriter, BlockReader, PvarWriter, VcfWriter, read_header
from .plink import BedWriter, PgenWriter, batch_cells, cell_lists, with_cells
from .storage import Parts, Several, SingleFile, in_ranges, kept, opened, piece_path, piece_paths, ranked

#: The writer of each kind of file, and whether it takes the samples' names (else their number).
WRITERS = {"bed": (BedWriter, False), "bim": (BimWriter, False), "pgen": (PgenWriter, False), "pvar": (PvarWriter, False), "vcf": (VcfWriter, True), "bcf": (BcfWriter, True)}


#: Samples of a piece at most and at least, and bytes that a variant of a piece takes beside its genotypes.
PIECE, LEAST_PIECE, SITE_BYTES = 1024, 128, 40


def piece_size(samples: int, variants: int, calls: int) -> int:
    """Samples of a piece by which all pieces together are smallest, if ``calls`` lie anywhere: a genotype takes two bits wherever any sample of the piece is known, so sparse calls
    ask for small pieces, and dense ones for large, which repeat a variant less often."""
    unknown, sizes = max(0.0, 1 - calls / max(1, samples * variants)), [PIECE]
    while sizes[-1] // 2 >= LEAST_PIECE:
        sizes.append(sizes[-1] // 2)
    return min(sizes, key=lambda n: -(-samples // n) * (1 - unknown**n) * (SITE_BYTES + n / 4))


def file_writers(files: list[list[str]], contigs: str, names: list[str], overwrite: bool) -> list[SingleFile]:
    """The writers of [kind, path] pairs."""
    return [WRITERS[k][0]({"path": path, "contigs": contigs, "samples": "\t".join(names) if WRITERS[k][1] else str(len(names))}, overwrite) for k, path in files]


@dataclass
class Pieces(WriterCommitMessage):
    of: dict[int, Parts]


class PiecesWriter(DataSourceArrowWriter):
    """Files of every ``size`` samples: rows come piece after piece, each with the cells of its own samples."""

    def __init__(self, files: list[list[str]], contigs: str, names: list[str], size: int, overwrite: bool):
        self.to, self.contigs, self.names, self.size, self.overwrite, self.token = files, contigs, names, size, overwrite, uuid.uuid4().hex

    def files(self, piece: int) -> Several:
        """The same files in every task and at the commit."""
        own = file_writers([[k, piece_path(p, piece)] for k, p in self.to], self.contigs, self.names[piece * self.size : (piece + 1) * self.size], self.overwrite)
        for f in own:
            f.parts = f"{f.path}.parts-{self.token}"
        return Several(own)

    def all_files(self) -> list[Several]:
        return [self.files(k) for k in range(-(-len(self.names) // self.size))]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Pieces:
        done, now, at = {}, None, None
        for b in batches:
            pieces = b.column(b.schema.get_field_index("piece")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), len(pieces)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if pieces[a] != at:
                    if now:
                        done[at] = now.done()
                    at = int(pieces[a])
                    now = self.files(at)
                    now.start()
                part = b.slice(a, z - a)
                row, i, d = batch_cells(part)
                now.put(with_cells(part, cell_lists(part.num_rows, row, i - at * self.size, d)))
        if now:
            done[at] = now.done()
        return Pieces(done)

    def commit(self, messages: list[Pieces | None]) -> None:
        every, first = self.all_files(), 0
        for k, files in enumerate(every):
            first = files.assemble([m.of[k] for m in messages if m is not None and k in m.of], first)
        for files in every:
            files.publish()

    def abort(self, messages: list[Pieces | None]) -> None:
        for files in self.all_files():
            files.abort([])


class FilesSource(DataSource):
    """A sink of several files.  Options: files (JSON of [kind, path] pairs), contigs and samples (by tabs); with piece, files of so many samples each."""

    @classmethod
    def name(cls) -> str:
        return "genotype_files"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        names, files = self.options["samples"].split("\t") if self.options["samples"] else [], json.loads(self.options["files"])
        if self.options.get("piece"):
            return PiecesWriter(files, self.options["contigs"], names, int(self.options["piece"]), overwrite)
        return Several(file_writers(files, self.options["contigs"], names, overwrite))


def samples_in_order(people: DataFrame) -> DataFrame:
    """``people`` once each, with i, the place by sample_id.  One task ranks the samples, who are far fewer than variants."""
    return people.dropDuplicates(["sample_id"]).withColumn("i", F.row_number().over(Window.orderBy("sample_id")) - 1)


def contig_order() -> Column:
    """Numbered contigs by number, others behind them."""
    return F.coalesce(variants.numeric_contig(F.col("chrom")).try_cast("int"), F.lit(2**31 - 1))


def site_cells(rows: DataFrame, *by: str) -> DataFrame:
    """One row for each variant_id (and ``by``): the least of its chrom, pos, ref and alt, and the cells that are not null.  Rows are sorted and neighbours joined, since an
    aggregation to lists of mostly one call each keeps a buffer for every list."""
    spare = ["variant_id", *by]
    columns = [*by, "variant_id", "chrom", "pos", "ref", "alt"]
    schema = StructType([*(rows.schema[c] for c in columns), StructField("cells", ArrayType(rows.schema["cell"].dataType))])
    shape = to_arrow_schema(schema)

    def join(t: pa.Table, whole: bool) -> tuple[pa.Table, pa.RecordBatch | None]:
        """The rows of the last variant, which may go on unless these are the ``whole``, and those of the others joined."""
        keys = [t.column(c).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy() for c in spare]
        first = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], 0)))
        end = t.num_rows if whole else int(first[-1])
        first = first if whole else first[:-1]
        if not len(first):
            return t, None
        cell = t.column("cell").combine_chunks().slice(0, end)
        ends = np.append(0, np.cumsum(cell.is_valid().to_numpy(zero_copy_only=False)))[np.append(first, end)].astype(np.int32)
        one = t.select(columns).take(pa.array(first)).combine_chunks()
        return t.slice(end), pa.RecordBatch.from_arrays([*(one.column(f.name).chunk(0) for f in list(shape)[:-1]), pa.ListArray.from_arrays(pa.array(ends), cell.drop_null())], schema=shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            held, done = join(held, False)
            if done is not None:
                yield done
        if held is not None:
            yield join(held, True)[1]

    return rows.repartition(*spare).sortWithinPartitions(*spare, *[c for c in columns if c not in spare]).mapInArrow(run, schema)


def genotype_rows(calls: DataFrame, people: DataFrame, piece: int | None = None) -> DataFrame:
    """One row a variant of long ``calls``: ord (by contig and position), chrom, pos, variant_id, ref, alt and cells, the (i, d) of the
    calls of ``people(i, sample_id)``; a sample without a call there is a no-call.  With ``piece`` every so many samples have rows of their
    own, of the variants that they are in ``calls`` at; ord counts on from piece to piece.

    One aggregation by variant makes sites and lists together; places are counted by ranges, so no task sees all sites."""
    # a call travels as one number, sample and two bits of dosage
    cell = (F.col("i") * 4 + F.col("dosage")).cast("int")
    known = calls.join(people.select("i", "sample_id"), "sample_id", "left")
    by = ["piece"] if piece else []
    if piece:
        known = known.withColumn("piece", F.coalesce(F.expr(f"CAST(i div {piece} AS LONG)"), F.lit(0)))
    # a call goes to its site before lists are made, and these are written, since the places ask for them twice
    sites = site_cells(known.select(*by, "variant_id", "chrom", "pos", "ref", "alt", cell.alias("cell")), *by)
    # piece and contig are one number, the first that rows are sorted by
    first = contig_order().cast("long") + (F.col("piece") * (1 << 32) if piece else 0)
    sites = sites.withColumn("first_", first)
    cells = F.transform("cells", lambda c: F.struct(F.shiftright(c, 2).alias("i"), c.bitwiseAND(F.lit(3)).cast("tinyint").alias("d"))).alias("cells")
    return ranked(kept(sites), "first_", "chrom", "pos", "variant_id").select("ord", *by, "chrom", "pos", "variant_id", "ref", "alt", cells)


def site_rows(rows: DataFrame) -> DataFrame:
    """The sites of ``genotype_rows`` in pieces, once each, for a bim or pvar of the cohort."""
    sites = rows.groupBy("variant_id").agg(F.min(F.struct("chrom", "pos", "ref", "alt")).alias("s")).select("variant_id", "s.*")
    return ranked(sites, contig_order(), "chrom", "pos", "variant_id")


def write_files(rows: DataFrame, people: DataFrame, files: dict[str, str], mode: str = "errorifexists", piece: int | None = None) -> None:
    """Write ``files`` (kind to path: bed, bim, pgen, pvar, vcf or bcf) of ``genotype_rows`` in one pass over them; ALT is A1, REF comes first.
    With ``piece``, which the rows were made with, files of so many samples each (``piece_path``)."""
    spark = rows.sparkSession
    spark.dataSource.register(FilesSource)
    names = "\t".join(r.sample_id for r in people.orderBy("i").select("sample_id").collect())
    contigs = "\t".join(r.chrom for r in rows.select("chrom").distinct().orderBy(contig_order(), "chrom").collect())
    sink = in_ranges(rows).write.format("genotype_files").option("files", json.dumps(list(files.items()))).option("contigs", contigs).option("samples", names).option("piece", piece or "")
    if mode == "overwrite":
        sink.mode("overwrite").save()
    else:
        for path in [q for p in files.values() for q in ((p, *piece_paths(p)) if piece and "/" in p else (p,))]:
            store, inner = opened(path)
            if store.get_file_info(inner).is_file:
                raise ValueError(f"{path} exists")
        sink.mode("append").save()


def lines_file(spark: SparkSession, path: str, lines: list[str]) -> None:
    """A small text file, in whichever store ``path`` names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write("".join(f"{x}\n" for x in lines).encode())
    finally:
        out.close()


def piece_lines(spark: SparkSession, path: str, head: list[str], lines: list[str], piece: int | None) -> None:
    for k in range(0, len(lines), piece or max(1, len(lines))) if lines else [0]:
        lines_file(spark, piece_path(path, k // piece) if piece else path, [*head, *lines[k : k + (piece or len(lines))]])


def write_fam(people: DataFrame, path: str, piece: int | None = None) -> None:
    """FID 0, IID, no parents, sex, no phenotype, in the order of ``i``; with ``piece`` a file for every so many samples."""
    piece_lines(people.sparkSession, path, [], [f"0\t{r.sample_id}\t0\t0\t{r.sex or 0}\t-9" for r in people.orderBy("i").collect()], piece)


def write_psam(people: DataFrame, path: str, piece: int | None = None) -> None:
    piece_lines(people.sparkSession, path, ["#IID\tSEX"], [f"{r.sample_id}\t{r.sex or 'NA'}" for r in people.orderBy("i").collect()], piece)


def write_plink1(rows: DataFrame, people: DataFrame, prefix: str, mode: str = "errorifexists") -> None:
    """<prefix>.bed, .bim and .fam of ``genotype_rows`` and ``people(i, sample_id, sex)``."""
    write_files(rows, people, {"bed": f"{prefix}.bed", "bim": f"{prefix}.bim"}, mode)
    write_fam(people, f"{prefix}.fam")


def read_bcf(spark: SparkSession, path: str, region: str | None = None, split_bytes: int | None = None, called: bool = False, pieces: bool = False) -> DataFrame:
    """Long calls of a BCF, or of a region of it by its index: chrom, pos, variant_id, ref, alt, sample_id, dosage (alleles that are not REF); with ``called`` no row for a no-call,
    which the ``pieces`` of a path ask for."""
    spark.dataSource.register(BcfSource)
    paths, people = piece_paths(path) if pieces else [path], []
    for p in paths:
        store, inner = opened(p)
        with store.open_input_file(inner) as f:
            people += read_header(BlockReader(f)).samples
    source = spark.read.format("bcf")
    for k, v in (("region", region), ("splitBytes", split_bytes), ("cells", "1" if called else None), ("paths", "\t".join(paths) if pieces else None)):
        source = source.option(k, v) if v is not None else source
    names = spark.createDataFrame(list(enumerate(people)), "i int, sample_id string")
    cells = source.load(path if not pieces else None).select("chrom", "pos", "variant_id", "ref", "alt", (F.inline("cells") if called else F.posexplode("gt")).alias("i", "dosage"))
    return cells.join(names, "i").select("chrom", "pos", "variant_id", "ref", "alt", "sample_id", F.col("dosage").cast("int").alias("dosage"))

