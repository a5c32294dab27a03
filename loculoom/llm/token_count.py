"""Token counts by finite-state tokenizer compilation.

The vocabulary and merges of a byte-level BPE with word ends are compiled, on demand, into a deterministic
transducer over bytes.  Greedy merging is reproduced exactly without merging: the last token of a prefix is the
longest vocabulary suffix whose neighbour to the left stays its neighbour when the two are encoded alone, so the
state only needs the last tokens of the boundaries inside the longest suffix that some token can still extend.
Each transition carries the number of tokens that it adds to (or, where tokens fuse, takes from) the count.

A scanner cuts text into words; its states are: between words, in a run of letters or of other marks (with the state of
the word transducer), or behind an apostrophe that may begin a contraction.  A text of more than ``LONG`` characters is
cut into chunks anywhere, and the chunks are dealt to tasks.  The task of a chunk computes its state map: from each state
in which the chunk may be entered, the state at its end and the tokens between.  Nearly always the characters just before
the chunk (spaces, digits, changes between letters and marks) leave one state; inside one long run the states reached from
every place of the last ``LOOK`` characters are mapped, together once they meet.  Maps compose associatively, so the maps of
a text are joined in a balanced scan; a map that is entered in a state that it lacks is extended by running that state.

Code points are classified and normalised as the library does it: classes are asked of the library's own splitter once
per code point, and texts beyond Latin letters go through its normaliser.

Defined results: a null or empty text has 0 bytes and 0 tokens; rows are independent of each other, so repeated rows
give repeated results; an empty table gives an empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import json
import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, numbered, slices

#: Code points below this are lower-cased and scanned by the faster engine.
LATIN = 0x250
#: Characters of a text that is cut, of a chunk, and before a chunk that its task sees.
LONG, CHUNK, LOOK = 1 << 19, 1 << 16, 64
LIMIT = 2048
#: Words and states that a worker remembers; beyond that it starts afresh.
MEMO, STATES, PAIRS = 500_000, 150_000, 500_000
#: Bytes of a word after which the number of states is looked at again.
STRIDE = 4096
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordTransducer:
    """Counts the tokens of one word, a string over the byte alphabet."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.suffix = suffix
        cut = len(suffix)
        self.inner = {t for t in vocab if not t.endswith(suffix)}
        self.final = {t[:-cut] for t in vocab if t.endswith(suffix)}
        self.longest = max(map(len, self.inner | self.final))
        self.open = {t[:k] for t in self.inner for k in range(1, len(t))} | {t[:k] for t in self.final for k in range(1, len(t))}
        self.pairs: dict[tuple[str, str, bool], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.keys: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.next: list[dict[str, tuple[int, int]]] = []
        self.last: list[dict[str, int]] = []
        self.state(("", (None,), (0,)))

    def state(self, key: tuple) -> int:
        """The number of a state; keys are the same on every worker, numbers are not."""
        if key not in self.ids:
            self.ids[key] = len(self.keys)
            self.keys.append(key)
            self.next.append({})
            self.last.append({})
        return self.ids[key]

    def encode(self, symbols: list[str]) -> list[str]:
        """Greedy merging as defined: lowest rank first, leftmost first."""
        rank = self.rank
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: rank.get((symbols[i], symbols[i + 1]), 1 << 60))
            if (symbols[best], symbols[best + 1]) not in rank:
                break
            symbols = [*symbols[:best], symbols[best] + symbols[best + 1], *symbols[best + 2 :]]
        return symbols

    def stays(self, left: str, right: str, final: bool) -> bool:
        key = (left, right, final)
        if key not in self.pairs:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            end = self.suffix if final else ""
            symbols = list(left + right)
            symbols[-1] += end
            self.pairs[key] = self.encode(symbols) == [left, right + end]
        return self.pairs[key]

    def token(self, text: str, lasts: tuple, final: bool) -> int:
        """Where the last token of ``text`` begins."""
        known = self.final if final else self.inner
        for k in range(max(0, len(text) - self.longest), len(text)):
            if (t := text[k:]) in known and (lasts[k] is None or self.stays(lasts[k], t, final)):
                return k
        raise ValueError(f"no token ends {text!r}")

    def step(self, state: int, c: str) -> tuple[int, int]:
        open_, lasts, counts = self.keys[state]
        text = open_ + c
        k = self.token(text, lasts, False)
        count = counts[k] + 1
        lasts, counts = (*lasts, text[k:]), (*counts, count)
        at = next((i for i in range(len(text)) if text[i:] in self.open), len(text))
        key = (text[at:], lasts[at:], tuple(x - count for x in counts[at:]))
        self.next[state][c] = out = (self.state(key), count)
        return out

    def finish(self, state: int, c: str) -> int:
        open_, lasts, counts = self.keys[state]
        self.last[state][c] = out = counts[self.token(open_ + c, lasts, True)] + 1
        return out

    def run(self, state: int, c: str, more: str) -> tuple[int, str, int]:
        """From a state and a byte that waits (it may be the word's last): the same after more bytes, and the tokens added."""
        total = 0
        for a in range(0, len(more), STRIDE):
            if len(self.keys) > STATES:
                key = self.keys[state]
                self.reset()
                state = self.state(key)
            moves = self.next
            for d in more[a : a + STRIDE]:
                state, add = moves[state].get(c) or self.step(state, c)
                total += add
                c = d
        return state, c, total

    def end(self, state: int, c: str) -> int:
        """Tokens added when the byte that waits is the last."""
        add = self.last[state].get(c)
        return self.finish(state, c) if add is None else add

    def count(self, word: str) -> int:
        if len(word) > STRIDE:
            state, c, total = self.run(0, word[0], word[1:])
            return total + self.end(state, c)
        if len(self.keys) > STATES:
            self.reset()
        state, total, moves = 0, 0, self.next
        for c in word[:-1]:
            state, add = moves[state].get(c) or self.step(state, c)
            total += add
        return total + self.end(state, word[-1])


#: States of the scanner: between words; a run of letters or marks with its word state's key and the byte that waits; behind an apostrophe.
START = ("start",)


class CountTransducer:
    """The tokenizer file as a scanner over words and a transducer inside them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.words = words = WordTransducer(model["vocab"], merges, model["end_of_word_suffix"])
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str
        split = library.pre_tokenizer.pre_tokenize_str
        self.markers = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(self.markers, key=len, reverse=True))))
        alphabet = byte_alphabet()
        table = {b: alphabet[b] for b in range(256)}
        self.symbols = lambda text: text.encode("utf-8").decode("latin-1").translate(table)

        class Kinds(dict):
            """A mark for each code point by how the library splits it: a letter, 1 number, ! other, a space; letters of contractions stand for themselves."""

            def __missing__(self, code: int) -> str:
                c = chr(code)
                # between a letter and a mark, twice: a letter joins the letter, a mark the mark, a number stands alone and a space goes
                spans = tuple(span for _, span in split(f"a{c}{c}!"))
                mark = {((0, 3), (3, 4)): "a", ((0, 1), (1, 2), (2, 3), (3, 4)): "1", ((0, 1), (1, 4)): "!", ((0, 1), (3, 4)): " "}[spans]
                self[code] = mark = c if c in CONTRACTIONS and c != "|" else mark
                return mark

        self.kinds = Kinds()
        by_kind: dict[str, str] = {}
        for code in range(LATIN):
            k = self.kinds[code]
            by_kind["a" if k.isalpha() else "!" if k == "'" else k] = by_kind.get("a" if k.isalpha() else "!" if k == "'" else k, "") + re.escape(chr(code))
        letters, numbers, spaces = by_kind["a"], by_kind["1"], by_kind[" "]
        # the same scanner twice: for Latin text with its classes spelled out, and for the marks of any text
        self.scan_latin = re.compile(rf"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+").findall
        self.scan_marks = re.compile(rf"{CONTRACTIONS}|[a-z]+|1|[^ a-z1]+").finditer
        self.beyond = re.compile(rf"[^\x00-{chr(LATIN - 1)}]").search

        class Memo(dict):
            def __missing__(self, word: str) -> int:
                if len(self) > MEMO:
                    self.clear()
                n = words.count(transducer.symbols(word))
                if len(word) <= STRIDE:
                    self[word] = n
                return n

        transducer = self
        self.memo = Memo()

    def normalised(self, text: str) -> str:
        return self.normalise(text) if self.beyond(text) else text.lower()

    def plain(self, text: str) -> int:
        """Tokens of normalised text that starts and ends between words."""
        if not self.beyond(text):
            return sum(map(self.memo.__getitem__, self.scan_latin(text)))
        return sum(self.memo[text[m.start() : m.end()]] for m in self.scan_marks(text.translate(self.kinds)))

    def advance(self, state: tuple, text: str) -> tuple[tuple, int]:
        """The scanner's state after ``text``, and the tokens added."""
        words, total = self.words, 0
        if state[0] == "apostrophe":
            text = state[1] + text
        marks = text.translate(self.kinds)
        at = 0
        if state[0] in ("letters", "marks"):
            run = re.match(r"[a-z]*" if state[0] == "letters" else r"[^ a-z1]*", marks).end()
            number, c, total = words.run(words.state(state[1]), state[2], self.symbols(text[:run]))
            if run == len(text):
                return (state[0], words.keys[number], c), total
            total += words.end(number, c)
            at = run
        # the last word may go on in the next chunk
        tail = re.search(r"(?:(?<![^ a-z1])'(?:[rvl]?)|[a-z]+|[^ a-z1]+)$", marks[at:])
        if tail:
            # a contraction ends its word: what follows it is a word of its own
            whole = [m.span() for m in self.scan_marks(marks, at)]
            begin, end = whole[-1]
            if len(whole) > 1 and marks[whole[-2][0] : end] in ("'r", "'v", "'l") and whole[-2][1] == begin:
                begin = whole[-2][0]
            word = marks[begin:end]
            total += self.plain(text[at:begin])
            if word in ("'", "'r", "'v", "'l"):
                return ("apostrophe", text[begin:end]), total
            if re.fullmatch(CONTRACTIONS, word):
                return START, total + self.memo[text[begin:end]]
            symbols = self.symbols(text[begin:end])
            number, c, more = words.run(0, symbols[0], symbols[1:])
            return ("letters" if word[0].isalpha() else "marks", words.keys[number], c), total + more
        return START, total + self.plain(text[at:])

    def ended(self, state: tuple) -> int:
        """Tokens added where a text ends in this state."""
        if state[0] == "apostrophe":
            return self.plain(state[1])
        return 0 if state == START else self.words.end(self.words.state(state[1]), state[2])

    def entries(self, before: str) -> tuple[list[tuple], bool]:
        """The states in which a text may be after ``before``, which is not its beginning, and whether these are all."""
        marks = before.translate(self.kinds)
        sure = 0
        for m in re.finditer(r"[ 1]|[a-z](?=[^ a-z1])|[^ a-z1](?=[a-z])", marks):
            # between words for certain: behind a space or number, and where letters and marks meet but for an apostrophe that may begin a contraction
            if m.end() > 1 and (marks[m.start()] != "'" or marks[m.start() - 1] not in " 1abcdefghijklmnopqrstuvwxyz"):
                sure = m.end()
        if sure:
            return [self.advance(START, before[sure:])[0]], True
        return list(dict.fromkeys(self.advance(START, before[p:])[0] for p in range(len(before)))), False

    def state_map(self, before: str | None, chunk: str, last: bool) -> "StateMap":
        """The map of a chunk; ``before`` is None at a text's beginning, and ``last`` at its end."""
        entries, sure = ([START], True) if before is None else self.entries(before)
        done: dict[tuple, tuple[tuple, int]] = {e: (e, 0) for e in entries}
        for a in range(0, len(chunk), STRIDE):
            # entries that have met go on together
            step = {s: self.advance(s, chunk[a : a + STRIDE]) for s in {s for s, _ in done.values()}}
            done = {e: (step[s][0], n + step[s][1]) for e, (s, n) in done.items()}
        if last:
            done = {e: (START, n + self.ended(s)) for e, (s, n) in done.items()}
        return StateMap(done, None if sure else chunk, last)

    def enter(self, m: "StateMap", state: tuple) -> tuple[tuple, int] | None:
        """Where a state leads; None if no text before the map's chunk can end in it."""
        if state in m.to:
            return m.to[state]
        total = 0
        for leaf in m.leaves:
            if state in leaf.to:
                state, n = leaf.to[state]
                total += n
                continue
            if leaf.chunk is None:
                return None
            for a in range(0, len(leaf.chunk), STRIDE):
                state, n = self.advance(state, leaf.chunk[a : a + STRIDE])
                total += n
            if leaf.last:
                state, total = START, total + self.ended(state)
        return state, total

    def composed(self, x: "StateMap", y: "StateMap") -> "StateMap":
        """x and then y."""
        to = {}
        for e, (s, n) in x.to.items():
            if (then := self.enter(y, s)) is not None:
                to[e] = then[0], n + then[1]
        return StateMap(to, leaves=x.leaves + y.leaves)

    def scanned(self, maps: list["StateMap"]) -> int:
        """Tokens of a text from the maps of its chunks, composed in a balanced scan."""
        while len(maps) > 1:
            maps = [self.composed(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return self.enter(maps[0], START)[1] if maps else 0

    def chunks(self, text: str, size: int = CHUNK) -> Iterator[tuple[str | None, str, bool, int]]:
        """(characters before, chunk, last of its part, special tokens behind it): special strings part a text and count one each."""
        parts = self.special.split(text)
        for k, part in enumerate(parts):
            part = self.normalised(part)
            more = int(k + 1 < len(parts))
            ends = range(0, max(1, len(part)), size)
            for a in ends:
                last = a + size >= len(part)
                yield (part[max(0, a - LOOK) : a] if a else None), part[a : a + size], last, more if last else 0

    def count(self, text: str) -> int:
        if any(m in text for m in self.markers):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(self.plain(self.normalised(p)) for p in parts)
        return self.plain(self.normalised(text))

    def count_in_chunks(self, text: str, size: int = CHUNK) -> int:
        """``count`` by chunk maps."""
        found = list(self.chunks(text, size))
        return self.scanned([self.state_map(*c[:3]) for c in found]) + sum(c[3] for c in found)


class StateMap:
    """Where each entry state leads, and with how many tokens.  The map of a chunk keeps its text if other entries may be met."""

    def __init__(self, to: dict[tuple, tuple[tuple, int]], chunk: str | None = None, last: bool = False, leaves: tuple["StateMap", ...] = ()):
        self.to, self.chunk, self.last = to, chunk, last
        self.leaves = leaves or (self,)


@functools.lru_cache(maxsize=2)
def compiled(path: str) -> CountTransducer:
    return CountTransducer(path)


RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, long: int = LONG, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs(doc_id, text)``; ``path`` must exist on every executor.

    Texts of up to ``long`` characters are counted where they lie; the chunks of longer ones are dealt to tasks."""

    def each(ids: list, texts: list[str]) -> dict[str, list]:
        count = compiled(path).count
        n = [count(t) for t in texts]
        return {"doc_id": ids, "n_bytes": [len(t.encode("utf-8")) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    docs = numbered(docs.select("doc_id", "text"), "row")
    size = F.coalesce(F.length("text"), F.lit(0))
    short = map_texts(docs.filter(size <= long), each, RESULT)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            for (doc, row), text in zip(ids, texts):
                n_bytes = len(text.encode("utf-8"))
                for k, (before, part, last, special) in enumerate(compiled(path).chunks(text, chunk)):
                    values = (doc, row, n_bytes, k, before, part, last, special)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, cut_types)], names=cut_names)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                before, part, last = (b.column(c)[k].as_py() for c in ("before", "part", "last"))
                m = pickle.dumps(compiled(path).state_map(before, part, last))
                one = b.slice(k, 1)
                yield pa.RecordBatch.from_arrays([*(one.column(c) for c in ("doc_id", "row", "n_bytes", "k", "special")), pa.array([m], pa.binary())], names=["doc_id", "row", "n_bytes", "k", "special", "map"])

    def joined(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("k")
        n = compiled(path).scanned([pickle.loads(m.as_py()) for m in rows.column("map")]) + sum(rows.column("special").to_pylist())
        return pa.table({"doc_id": rows.column("doc_id").slice(0, 1), "n_bytes": rows.column("n_bytes").slice(0, 1), "n_tokens": pa.array([n], pa.int64()), "over_limit": [n > limit]})

    cut_names = ["doc_id", "row", "n_bytes", "k", "before", "part", "last", "special"]
    cut_types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64()]
    parts = docs.filter(size > long).select("doc_id", "row", "text").mapInArrow(
        cut_up, "doc_id long, row long, n_bytes long, k long, before string, part string, last boolean, special long"
    )
    maps = parts.repartition("row", "k").mapInArrow(mapped, "doc_id long, row long, n_bytes long, k long, special long, map binary")
    return short.unionByName(maps.groupBy("row").applyInArrow(joined, RESULT))
