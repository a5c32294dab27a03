"""Array intensity files (GTC), decoded by executors in Arrow batches."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Fixed values of the format: "gtc", version 5, then a table of (tag, offset); single values keep the value itself in place of the offset.
GTC_TAGS = {"n": 1, "sample_name": 10, "genotypes": 1002, "base_calls": 1003, "scores": 1004, "x": 1000, "y": 1001, "baf": 1012, "lrr": 1013}
ARRAY_TYPES = {"genotypes": "u1", "scores": "<f4", "x": "<u2", "y": "<u2", "baf": "<f4", "lrr": "<f4"}


def varint(n: int) -> bytes:
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | (128 if n else 0)])
        if not n:
            return out


def write_gtc(path: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    n = len(arrays["genotypes"])
    blocks = {"sample_name": varint(len(name)) + name.encode()} | {k: struct.pack("<i", n) + np.asarray(v, ARRAY_TYPES[k]).tobytes() for k, v in arrays.items()}
    at, table, body = 8 + 6 * (len(blocks) + 1), struct.pack("<Hi", GTC_TAGS["n"], n), b""
    for k, b in blocks.items():
        table += struct.pack("<Hi", GTC_TAGS[k], at + len(body))
        body += b
    with open(path, "wb") as f:
        f.write(b"gtc" + bytes([5]) + struct.pack("<i", len(blocks) + 1) + table + body)


def text_at(data: bytes, at: int) -> str:
    """A text behind its length, seven bits a byte."""
    shift, n = 0, 0
    while True:
        n |= (data[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 128:
            return data[at : at + n].decode()


#: Tags of the format: texts, the sex (one character) and 32-bit floats that describe a sample.
GTC_TEXTS = {"sample_name": 10, "sample_plate": 11, "sample_well": 12, "cluster_file": 100, "snp_manifest": 101, "imaging_date": 200, "autocall_date": 201, "autocall_version": 300}
GTC_SEX, GTC_FLOATS = 1007, {"call_rate": 1006, "logr_dev": 1008, "p10_gc": 1009}
METADATA = "file string, n_loci int, " + ", ".join(f"{k} string" for k in GTC_TEXTS) + ", sex string, " + ", ".join(f"{k} float" for k in GTC_FLOATS)


def describe_gtc(data: bytes) -> dict:
    """What a GTC file tells of its sample (None where it does not); a missing call rate is counted from the genotypes."""
    if data[:3] != b"gtc":
        raise ValueError("not a GTC file")
    toc = dict(struct.unpack_from("<Hi", data, 8 + 6 * i) for i in range(struct.unpack_from("<i", data, 4)[0]))
    out = {"n_loci": toc.get(GTC_TAGS["n"])} | {k: text_at(data, toc[t]) if t in toc else None for k, t in GTC_TEXTS.items()}
    out["sex"] = chr(data[toc[GTC_SEX]]) if GTC_SEX in toc else None
    out |= {k: struct.unpack_from("<f", data, toc[t])[0] if t in toc else None for k, t in GTC_FLOATS.items()}
    if out["call_rate"] is None and len(g := decode_gtc(data)[1].get("genotypes", ())):
        out["call_rate"] = float((g != 0).mean())
    return out


def read_gtc_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row a GTC file, of the columns ``METADATA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{"file": p.rsplit("/", 1)[-1]} | describe_gtc(c.as_py()) for p, c in zip(b.column(0).to_pylist(), b.column(1))]
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    shape = pa.schema([(k, {"string": pa.string(), "int": pa.int32(), "float": pa.float32()}[t]) for k, t in (f.split() for f in METADATA.split(", "))])
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, METADATA)


def decode_gtc(data: bytes) -> tuple[str, dict[str, np.ndarray]]:
    if data[:3] != b"gtc":
        raise ValueError("not a GTC file")
    toc = dict(struct.unpack_from("<Hi", data, 8 + 6 * i) for i in range(struct.unpack_from("<i", data, 4)[0]))
    name, arrays = text_at(data, toc[GTC_TAGS["sample_name"]]), {}
    for k, t in ARRAY_TYPES.items():
        if GTC_TAGS[k] in toc:
            o = toc[GTC_TAGS[k]]
            arrays[k] = np.frombuffer(data, t, struct.unpack_from("<i", data, o)[0], o + 4)
    return name, arrays


INTENSITY = "sample_id string, bpm_index int, gt tinyint, dosage tinyint, score float, baf float, lrr float, x int, y int"


def read_gtc(spark: SparkSession, path: str) -> DataFrame:
    """Intensity records of many GTC files, one file a row of the scan: 1 AA, 2 AB, 3 BB, 0 no-call (null dosage)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                name, a = decode_gtc(content.as_py())
                g = a["genotypes"].astype(np.int8)
                column = lambda k, t, a=a, g=g: pa.array(a[k], t) if k in a else pa.nulls(len(g), t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(g)), pa.array(np.arange(1, len(g) + 1), pa.int32()), pa.array(g), pa.array(g - 1, pa.int8(), mask=g == 0), column("scores", pa.float32()),
                     column("baf", pa.float32()), column("lrr", pa.float32()), column("x", pa.uint16()).cast(pa.int32()), column("y", pa.uint16()).cast(pa.int32())],
                    names=["sample_id", "bpm_index", "gt", "dosage", "score", "baf", "lrr", "x", "y"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, INTENSITY)
