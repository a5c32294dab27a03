"""Exact duplicates by Patricia-trie owners.

Each input partition first merges its own copies in a compressed radix trie over whole byte strings, so a text of
which there are millions of copies leaves a partition once.  The distinct texts are then partitioned by length and
content hash, and each partition inserts them into its trie; a terminal node holds the identifier that stays (with the
key of its row) and the number of rows.  When a trie outgrows its memory, its largest subtree is spilled: its terminals leave as partial
owners, which a small aggregation by content address merges.  Documents find their owner by that address in a join
of narrow rows that may be split where one address is hot.

Defined results: texts are equal when identical after lower-casing A-Z; a null text counts as empty; of equal texts
exactly one row stays, that with the largest doc_id; rows that are equal in both tie and any one of them stays
(``group_size`` counts rows); a null doc_id is never preferred, but stays where no other row has the text; an empty
table gives an empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, keyed, map_texts, partitions, slices

#: Bytes of edge labels that one trie may hold.
TRIE_BYTES = 96 << 20


def merged(a: tuple, b: tuple) -> tuple:
    """Owners (id or None, its row, rows) of the same text: the largest id stays, of equal ids the last row."""
    x, y = ((o[0] is not None, o[0] or 0, o[1]) for o in (a, b))
    return (*(a if x > y else b)[:2], a[2] + b[2])


class Node:
    __slots__ = ("edges", "label", "owner")

    def __init__(self, label: bytes, owner: tuple | None = None):
        self.label, self.owner, self.edges = label, owner, {}


class PatriciaTrie:
    """A compressed radix trie from byte strings to owners."""

    def __init__(self):
        self.root, self.bytes = Node(b""), 0

    def insert(self, key: bytes, owner: tuple) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.owner = owner if node.owner is None else merged(node.owner, owner)
                return
            child = node.edges.get(key[at])
            if child is None:
                node.edges[key[at]] = Node(key[at:], owner)
                self.bytes += len(key) - at + 200
                return
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            k = len(os.path.commonprefix([label, key[at : at + len(label)]]))
            fork = Node(label[:k])
            child.label = label[k:]
            fork.edges[child.label[0]] = child
            node.edges[key[at]] = fork
            self.bytes += 200
            node, at = fork, at + k

    def terminals(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, tuple]]:
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            key = prefix + node.label
            if node.owner is not None:
                yield key, node.owner
            stack.extend((x, key) for x in node.edges.values())

    def weight(self, node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            node = stack.pop()
            total += len(node.label) + 200
            stack.extend(node.edges.values())
        return total

    def spill(self, limit: int) -> Iterator[tuple[bytes, tuple]]:
        """Take the largest subtrees below the first fork out of the trie, until half of ``limit`` is free, and yield their terminals.

        Each spill weighs the trie once and frees half of it, so weighing costs a fixed share of inserting."""
        parent, prefix = self.root, b""
        while len(parent.edges) == 1 and (only := next(iter(parent.edges.values()))).edges and only.owner is None:
            parent, prefix = only, prefix + only.label
        for weight, first in sorted(((self.weight(x), k) for k, x in parent.edges.items()), reverse=True):
            if self.bytes <= limit // 2:
                return
            self.bytes -= weight
            yield from self.terminals(parent.edges.pop(first), prefix)


def owners(texts: Iterator[tuple[bytes, tuple]], limit: int) -> Iterator[tuple[bytes, tuple]]:
    """Distinct texts with their owners; a text may come again if its subtree was spilled."""
    trie = PatriciaTrie()
    for key, owner in texts:
        trie.insert(key, owner)
        while trie.bytes > limit and trie.root.edges:
            yield from trie.spill(limit)
    yield from trie.terminals()


def packed(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is bytes, in batches of bounded size."""
    got, held = [], 0
    for row in rows:
        got.append(row)
        held += len(row[-1]) + 64
        if held >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*got), schema)], schema=schema)
            got, held = [], 0
    if got:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*got), schema)], schema=schema)


LOCAL = pa.schema([("n_bytes", pa.int64()), ("head", pa.int64()), ("doc_id", pa.int64()), ("file", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])
OWNED = pa.schema([("keep_id", pa.int64()), ("keep_file", pa.int64()), ("keep_at", pa.int64()), ("group_size", pa.int64()), ("text_sha256", pa.binary())])


def local_owners(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((t.encode("utf-8").lower(), (i, (file, at), 1)) for ids, texts in slices(batches) for (i, file, at), t in zip(ids, texts))
        yield from packed(((len(k), int.from_bytes(hashlib.sha256(k).digest()[:8], "big", signed=True), i, *row, n, k) for k, (i, row, n) in owners(rows, limit)), LOCAL)

    return run


def partition_owners(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, (i, (file, at), n)) for b in batches for i, file, at, n, k in zip(*(b.column(c).to_pylist() for c in range(4)), (x.as_py() for x in b.column(4))))
        yield from packed(((i, *row, n, hashlib.sha256(k).digest()) for k, (i, row, n) in owners(rows, limit)), OWNED)

    return run


def text_owners(docs: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """text_sha256 (binary), keep_id, keep_file, keep_at and group_size of each distinct text of ``docs(doc_id, file, at, text)``."""
    local = docs.select("doc_id", "file", "at", "text").mapInArrow(local_owners(limit), "n_bytes long, head long, doc_id long, file long, at long, n long, text binary")
    dealt = local.repartition(partitions(docs.sparkSession), "n_bytes", "head").select("doc_id", "file", "at", "n", "text")
    owned = dealt.mapInArrow(partition_owners(limit), "keep_id long, keep_file long, keep_at long, group_size long, text_sha256 binary")
    # a null id is less than any
    best = F.max(F.struct(F.col("keep_id").isNotNull().alias("known"), "keep_id", "keep_file", "keep_at"))
    merged_owners = owned.groupBy("text_sha256").agg(best.alias("best"), F.sum("group_size").alias("group_size"))
    return merged_owners.select("text_sha256", "best.keep_id", "best.keep_file", "best.keep_at", "group_size")


def addresses(docs: DataFrame) -> DataFrame:
    """doc_id, file, at and text_sha256 (binary) of every row."""

    def each(ids: list, texts: list[str]) -> dict[str, list]:
        sha = [hashlib.sha256(t.encode("utf-8").lower()).digest() for t in texts]
        return {"doc_id": [i[0] for i in ids], "file": [i[1] for i in ids], "at": [i[2] for i in ids], "text_sha256": sha}

    return map_texts(docs, each, "doc_id long, file long, at long, text_sha256 binary", "file", "at")


def exact_duplicates(docs: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = keyed(docs.select("doc_id", "text"))
    stays = (F.col("file") == F.col("keep_file")) & (F.col("at") == F.col("keep_at"))
    # the written owners leave a plain exchange on both sides, so a hot address can be split
    return addresses(docs).join(cut(text_owners(docs, limit)), "text_sha256").select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"), F.lower(F.hex("text_sha256")).alias("text_sha256")
    )


def without_copies(docs: DataFrame, limit: int = TRIE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows meet their decision by key, so none is lost or multiplied."""
    file, at = fresh(docs, "file"), fresh(docs, "at")
    docs_ = keyed(docs, file, at)
    owned = text_owners(docs_.select("doc_id", F.col(file).alias("file"), F.col(at).alias("at"), "text"), limit)
    stay = owned.select(F.col("keep_file").alias(file), F.col("keep_at").alias(at))
    return docs_.join(stay, [file, at], "left_semi").select(docs.columns)


SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
