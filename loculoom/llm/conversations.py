"""Repair of the structure of conversations by a min-plus matrix scan.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles.  A turn may be kept, given another role, deleted, or have
empty turns inserted before it; every turn becomes a 4x4 matrix over the states (nothing yet, system, user, assistant), whose
elements are pairs (cost, audit): the cheapest edits that lead from one state to another, with the closure of inserts multiplied
in.  Elements are chosen by cost, then by audit in ASCII order, and joined by adding costs and appending audits.  Two audits of equal
cost over the same turns are never one the beginning of the other (what is appended would be inserts, which cost), so the choice
survives appending and the product is associative.

Rows are ordered by ranges of (conversation, turn), so a conversation may lie across any number of partitions.  Each task
multiplies the matrices of its stretches in a balanced tree; stretches at the ends of a partition, two a partition at most, go on
to a tree over partitions, eight at a time, and the numbers of faults, gaps and role changes are joined along with them.  None of
this moves a text: the scan works on narrow rows with the text's SHA-256.  Texts are shuffled once, by conversation, to be written out in
their repaired form; they stream past the audit in order, so no conversation is ever held whole.  (The hash of a
repaired conversation is sequential by its nature: one task streams it.)

Defined results: null roles and texts are one space; null conversation ids are one conversation; turns are ordered with nulls
first, rows of one turn by role and SHA-256 of the text; rows that are equal in all are repeats of the first; a conversation without rows has zeros
and an empty audit; an empty table gives an empty result; further columns are ignored, whatever their names.  A role of any
other initial is kept by no path (it is changed or deleted).  An audit is one string: 2^31 turns bound a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut

#: Costs of the edits and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: nothing yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Stretches of partitions that one step of the tree joins.
FAN = 8
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state that a role's initial leads to, and the states before it.
BEFORE = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}

Element = tuple[int, str] | None
Matrix = tuple[tuple[Element, ...], ...]


def least(*elements: Element) -> Element:
    return min((e for e in elements if e is not None), default=None)


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    return tuple(
        tuple(least(*((a[i][k][0] + b[k][j][0], a[i][k][1] + b[k][j][1]) for k in range(4) if a[i][k] is not None and b[k][j] is not None)) for j in range(4)) for i in range(4)
    )


def matrix(entries: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return tuple(tuple(entries.get((i, j)) for j in range(4)) for i in range(4))


IDENTITY = matrix({(i, i): (0, "") for i in range(4)})
#: One insert, and its closure: two inserts reach everything that any number does.
ONE_INSERT = matrix({(i, j): (INSERT, "I") for j in (USER, ASSISTANT) for i in BEFORE[j]})
CLOSURE = IDENTITY
for _ in range(2):
    CLOSURE = tuple(tuple(least(x, y) for x, y in zip(*rows)) for rows in zip(IDENTITY, times(CLOSURE, ONE_INSERT)))


@lru_cache
def turn_matrix(kind: str) -> Matrix:
    """The matrix of a turn: ``x`` must go; else the initial of its role (or ``o``), upper case if it is truncated."""
    edits = {(i, i): (DELETE, "D") for i in range(4)}
    if kind != "x":
        more, own = TRUNCATED * kind.isupper(), INITIALS.get(kind.lower())
        for state, before in BEFORE.items():
            for i in before:
                ways = [(more, "K")] * (state == own) + [(REROLE + more, "R")] * (state in ROLES)
                if ways:
                    edits[i, state] = min(ways)
    return times(CLOSURE, matrix(edits))


def product(kinds: str) -> Matrix:
    """The matrix of a stretch of turns, in a balanced tree."""
    if len(kinds) <= 8:
        return short_product(kinds)
    half = 8
    while half * 2 < len(kinds):
        half *= 2
    return times(product(kinds[:half]), product(kinds[half:]))


@lru_cache(1 << 16)
def short_product(kinds: str) -> Matrix:
    if not kinds:
        return IDENTITY
    k = len(kinds) // 2
    return times(short_product(kinds[:k]), short_product(kinds[k:])) if k else turn_matrix(kinds)


def cheapest(m: Matrix) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of all turns: the end is nothing at all or an assistant's turn."""
    row = times(m, CLOSURE)[START]
    return least(row[START], row[ASSISTANT])


class Stretch:
    """What is known of consecutive turns of a conversation; stretches join in order, associatively."""

    FIELDS = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last")
    __slots__ = (*FIELDS, "matrix")

    def __init__(self, low=None, high=None, turns=0, blank=0, duplicate=0, truncated=0, illegal=0, first=None, last=None, matrix=IDENTITY):
        self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated, self.illegal = low, high, turns, blank, duplicate, truncated, illegal
        self.first, self.last, self.matrix = first, last, matrix

    def then(self, other: Stretch) -> Stretch:
        """Turns are in order, nulls first, so only the turn at the seam can be in both."""
        seam = self.first is not None and other.first is not None and self.last + other.first not in ("su", "ua", "au")
        return Stretch(
            self.low if self.low is not None else other.low, other.high if other.high is not None else self.high,
            self.turns + other.turns - (self.high is not None and self.high == other.low),
            self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated, self.illegal + other.illegal + seam,
            self.first if self.first is not None else other.first, other.last if other.last is not None else self.last, times(self.matrix, other.matrix),
        )

    @staticmethod
    def of(rows: list[tuple]) -> Stretch:
        """Rows (turn, initial, blank, later, truncated, n) in order; n equal rows are one, 0 rows nothing."""
        out, kinds, pairs = Stretch(), [], ("su", "ua", "au")
        for turn, initial, blank, later, truncated, n in rows:
            if not n:
                continue
            if turn is not None and turn != out.high:
                out.low, out.high, out.turns = turn if out.low is None else out.low, turn, out.turns + 1
            out.illegal += n - 1 + (out.first is not None and out.last + initial not in pairs)
            out.first, out.last = initial if out.first is None else out.first, initial
            if blank or later:
                out.blank, out.duplicate = out.blank + n * blank, out.duplicate + n * (not blank)
                kinds.append("x" * n)
            else:
                kind = initial if initial in INITIALS else "o"
                out.duplicate, out.truncated = out.duplicate + n - 1, out.truncated + truncated
                kinds.append((kind.upper() if truncated else kind) + "x" * (n - 1))
        out.matrix = product("".join(kinds))
        return out


STRETCH = "conv_id long, part long, open boolean, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, cost array<long>, audit array<string>"
STRETCH_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("open", pa.bool_())]
    + [(c, pa.string() if c in ("first", "last") else pa.int64()) for c in Stretch.FIELDS] + [("cost", pa.list_(pa.int64())), ("audit", pa.list_(pa.string()))]
)
REPAIR = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def stretch_rows(rows: list[tuple]) -> pa.Table:
    """(conv_id, part, open, stretch) as Arrow."""
    flat = [[e for row in s.matrix for e in row] for *_, s in rows]
    columns = [[r[k] for r in rows] for k in range(3)] + [[getattr(r[3], f) for r in rows] for f in Stretch.FIELDS]
    columns += [[[e and e[0] for e in m] for m in flat], [[e and e[1] for e in m] for m in flat]]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, STRETCH_ARROW)], schema=STRETCH_ARROW)


def stretches_of(t: pa.Table | pa.RecordBatch) -> Iterator[tuple]:
    for r in t.to_pylist():
        flat = [None if c is None else (c, a) for c, a in zip(r["cost"], r["audit"])]
        yield r["conv_id"], r["part"], r["open"], Stretch(*(r[f] for f in Stretch.FIELDS), tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4)))


def flagged(rows: DataFrame) -> DataFrame:
    """The distinct turns of ``rows(conv_id, turn, role, text, n)``, narrow: conv_id, turn, role, address of the text, blank, later, truncated, n.

    ``later`` says that the role and the text were there at an earlier turn.  Equal rows are added up before anything is shuffled by
    conversation, so neither a repeated row nor a repeated text is a hot key."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    narrow = rows.select("conv_id", "turn", "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("address"), (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(*".!?")).alias("truncated"), "n")
    turns = cut(narrow.groupBy("conv_id", "turn", "role", "address").agg(F.max("blank").alias("blank"), F.max("truncated").alias("truncated"), F.sum("n").cast("long").alias("n")))
    said = turns.filter("n > 0 AND NOT blank").groupBy("conv_id", "role", "address").agg(F.count("*").alias("k"), F.max(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("at"))
    often = cut(said.filter("k > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("address").alias("a"), "unnumbered", "at"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("address") == F.col("a"))
    later = F.when(F.col("unnumbered"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("at"))
    return turns.join(often, same, "left").select("conv_id", "turn", "role", "address", "blank", F.coalesce(later, F.lit(False)).alias("later"), "truncated", "n")


def scanned(turns: DataFrame) -> DataFrame:
    """The stretches of each partition of the turns, dealt by ranges of (conv_id, turn); one that lies inside a partition is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held, name, part, first = [], None, None, 0, True

        def close(is_open: bool) -> None:
            done.append((name, part, is_open, held.then(Stretch.of(rows))))

        rows: list[tuple] = []
        for b in batches:
            for conv, part, *row in zip(*(c.to_pylist() for c in b.columns)):
                if held is None or conv != name:
                    if held is not None:
                        close(first)
                        first = False
                    name, held, rows = conv, Stretch(), []
                rows.append(tuple(row))
                if len(rows) >= 1 << 14:
                    held, rows = held.then(Stretch.of(rows)), []
            if len(done) >= 1 << 12:
                yield from stretch_rows(done).to_batches()
                done = []
        if held is not None:
            close(True)
            yield from stretch_rows(done).to_batches()

    order = ["conv_id", "turn", "role", "address"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", F.spark_partition_id().cast("long"), "turn", F.substring("role", 1, 1), "blank", "later", "truncated", "n").mapInArrow(run, STRETCH)


def joined(stretches: DataFrame) -> DataFrame:
    """One stretch a conversation: those that end at a partition's border are joined in a tree, ``FAN`` partitions at a time."""

    def run(t: pa.Table) -> pa.Table:
        ordered = sorted(stretches_of(t), key=lambda r: r[1])
        whole = ordered[0][3]
        for r in ordered[1:]:
            whole = whole.then(r[3])
        return stretch_rows([(ordered[0][0], ordered[0][1] // FAN, True, whole)])

    left, parts = stretches.filter("open"), (stretches.agg(F.max("part")).collect()[0][0] or 0) + 1
    while True:
        left = left.groupBy("conv_id", F.expr(f"part div {FAN}").alias("step")).applyInArrow(lambda _, t: run(t), STRETCH)
        parts = -(-parts // FAN)
        if parts <= 1:
            return stretches.filter("NOT open").unionByName(left)


def repairs(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, numbers of faults, cost and audit of every conversation of ``rows(conv_id, turn, role, text, n)``; a row counts n times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, _, _, s in stretches_of(b):
                gaps = 0 if s.low is None else s.high - s.low + 1 - s.turns
                out.append((conv, gaps, s.blank, s.duplicate, s.truncated, s.illegal, *cheapest(s.matrix)))
            names = [f.split()[0] for f in REPAIR.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "audit" else pa.int64()) for c, n in zip(zip(*out) if out else [[]] * len(names), names)], names=names)

    return joined(cut(scanned(cut(flagged(rows))))).mapInArrow(run, REPAIR)


TOLD = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
TURN = "conv_id long, place long, edit string, role string, text string, " + ", ".join(f"{c} {'string' if c == 'audit' else 'long'}" for c in TOLD)
TURN_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())] + [(c, pa.string() if c == "audit" else pa.int64()) for c in TOLD]
)


def replayed(rows: DataFrame, repaired: DataFrame) -> DataFrame:
    """Every conversation's repair (place 0) and then its repaired turns (place 1, 2, ..., edit K, R or I), in order within one partition.

    The rows stream past the audit of their conversation, which comes first."""
    address = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    heads = repaired.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("binary").alias("address"), F.lit(None).cast("string").alias("text"), F.lit(1).alias("n"), *TOLD)
    turns = rows.filter("n > 0").select("conv_id", F.lit(1).alias("kind"), "turn", "role", address.alias("address"), "text", F.col("n").cast("int").alias("n"), *(F.lit(None).cast("string" if c == "audit" else "long").alias(c) for c in TOLD))
    order = ["conv_id", "kind", "turn", "role", "address"]
    both = heads.unionByName(turns).repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, state, name, none = "", 0, 0, START, None, (None,) * len(TOLD)
        out: list[tuple] = []
        size = 0

        def say(edit: str, role: str, text: str) -> None:
            nonlocal place, state, size
            place, size = place + 1, size + len(text)
            state = INITIALS.get(role[:1], state)
            out.append((name, place, edit, role, text, *none))

        def insert() -> None:
            """The inserts that come next."""
            nonlocal at
            while audit[at : at + 1] == "I":
                at += 1
                say("I", ROLES[ASSISTANT if state == USER else USER], "")

        for b in batches:
            kinds, columns = b.column(1).to_pylist(), {c: b.column(c) for c in ("conv_id", "role", "text", "n", *TOLD)}
            for k, kind in enumerate(kinds):
                if kind == 0:
                    name, at, place, state = columns["conv_id"][k].as_py(), 0, 0, START
                    told = tuple(columns[c][k].as_py() for c in TOLD)
                    audit = told[-1]
                    out.append((name, 0, None, None, None, *told))
                    insert()
                else:
                    role, text = columns["role"][k].as_py(), columns["text"][k].as_py()
                    for _ in range(columns["n"][k].as_py()):
                        edit, at = audit[at], at + 1
                        if edit != "D":
                            say(edit, role if edit == "K" else ROLES[ASSISTANT if state == USER else USER], text)
                        insert()
                if len(out) >= 2_000 or size >= 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), TURN_ARROW)], schema=TURN_ARROW)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), TURN_ARROW)], schema=TURN_ARROW)

    return both.mapInArrow(run, TURN)


def counted(conversations: DataFrame) -> DataFrame:
    """The rows of a table of conversations as the operators take them: nulls are one space, every row counts once."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).alias("n"))


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), edit (K, R or I), role and text of the repaired turns of ``conversations(conv_id, turn, role, text)``."""
    rows = counted(conversations)
    return replayed(rows, cut(repairs(rows))).filter("place > 0").select("conv_id", "place", "edit", "role", "text")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after the damage of the contract; ``n`` is 0 for a dropped row and 2 for a repeated one."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    n = F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1)
    return counted(conversations).select("conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), n.alias("n"))


def repair_digest(rows: DataFrame) -> DataFrame:
    """One row a conversation of ``rows(conv_id, turn, role, text, n)``: its repair and the SHA-256 of the repaired turns."""
    spoken = replayed(rows, cut(repairs(rows)))
    names = ["conv_id", *TOLD, "repaired_sha256"]
    schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, sha = None, hashlib.sha256()
        for b in batches:
            out = []
            heads = [b.column(c) for c in ("conv_id", *TOLD)]
            for k, (place, role, text) in enumerate(zip(*(b.column(c).to_pylist() for c in ("place", "role", "text")))):
                if place == 0:
                    if told:
                        out.append((*told, sha.hexdigest()))
                    told, sha = tuple(c[k].as_py() for c in heads), hashlib.sha256()
                else:
                    sha.update(f"{'' if place == 1 else chr(10)}{role}:{text}".encode("utf-8"))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if told:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*told, sha.hexdigest()), schema)], schema=schema)

    return spoken.mapInArrow(run, REPAIR + ", repaired_sha256 string")


#: The damage needs a CRC-32, worked out with its usual table of 256 entries; the repair is a recursion over turns with four states.
SQL = r"""
WITH RECURSIVE bits(i, c, k) AS (SELECT range, range, 0 FROM range(0, 256) UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
q AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
sums(s, p, c) AS (SELECT DISTINCT s, 0, CAST(4294967295 AS BIGINT) FROM q
    UNION ALL SELECT s, p + 1, xor(sums.c // 256, bits.c) FROM sums JOIN bits ON k = 8 AND i = xor(sums.c % 256, ascii(substr(s, p + 1, 1))) WHERE p < length(s)),
fates AS (SELECT s, xor(c, 4294967295) % 20 AS fate FROM sums WHERE p = length(s)),
d AS (SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(0, CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM q JOIN fates USING (s)),
o AS (SELECT conv_id, turn, role, text, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS p, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen FROM d),
f AS (SELECT *, bare = '' AS blank, bare <> '' AND seen > 1 AS duplicate, bare <> '' AND seen = 1 AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated, substr(role, 1, 1) AS r,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS r0 FROM o),
ins(i, j, c, l, e) AS (VALUES (0, 0, 0, '', CAST([] AS VARCHAR[])), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']),
                              (2, 3, 2, 'I', ['assistant:']), (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
edit(i, j, l, c, r) AS (VALUES (0, 0, 'D', 3, NULL), (1, 1, 'D', 3, NULL), (2, 2, 'D', 3, NULL), (3, 3, 'D', 3, NULL), (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (3, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a'),
                              (0, 2, 'R', 2, 'user'), (1, 2, 'R', 2, 'user'), (3, 2, 'R', 2, 'user'), (2, 3, 'R', 2, 'assistant')),
st(conv_id, p, i, m) AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': '', 'said': CAST([] AS VARCHAR[])} FROM conversations
    UNION ALL
    SELECT conv_id, p, j, arg_min(m, {'cost': m.cost, 'audit': m.audit}) FROM (
        SELECT st.conv_id, f.p, edit.j, {'cost': st.m.cost + ins.c + edit.c + CASE WHEN edit.l <> 'D' AND truncated THEN 1 ELSE 0 END, 'audit': st.m.audit || ins.l || edit.l,
               'said': st.m.said || ins.e || CASE edit.l WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [edit.r || ':' || text] END} AS m
        FROM st JOIN ins ON ins.i = st.i JOIN f ON f.conv_id IS NOT DISTINCT FROM st.conv_id AND f.p = st.p + 1
        JOIN edit ON edit.i = ins.j AND (edit.l = 'D' OR NOT (blank OR duplicate) AND (edit.l = 'R' OR edit.r = f.r))) GROUP BY conv_id, p, j),
n AS (SELECT c.conv_id, count(p) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
             count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE p > 1 AND r0 || r NOT IN ('su', 'ua', 'au')) AS illegal
      FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
e AS (SELECT n.conv_id, arg_min({'cost': m.cost + ins.c, 'audit': m.audit || ins.l, 'said': m.said || ins.e}, {'cost': m.cost + ins.c, 'audit': m.audit || ins.l}) AS m
      FROM n JOIN st ON st.conv_id IS NOT DISTINCT FROM n.conv_id AND st.p = n.n JOIN ins ON ins.i = st.i AND ins.j IN (0, 3) GROUP BY n.conv_id)
SELECT n.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(m.cost AS BIGINT) AS cost, m.audit AS audit, sha256(array_to_string(m.said, chr(10))) AS repaired_sha256
FROM n JOIN e ON n.conv_id IS NOT DISTINCT FROM e.conv_id
"""
