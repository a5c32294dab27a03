"""Licence scans by a generalised suffix automaton of licence tokens.

All templates and phrases go into one suffix automaton over word numbers.  The templates are whole licence texts (the files of
``licence_texts``, named by label) and usual notices; there is none of the whole AGPL, EPL and CC-BY, of which only the notices
are known.  A file is streamed through the automaton to obtain, at every word, the longest match that ends there (matching
statistics); stretches of which no ``MIN_MATCH`` words in a row stand in a template hold no match of that length and are not
streamed.  Phrases are found at the states that hold them; maximal matches of at least ``MIN_MATCH`` words are chained, per
template and in order in both file and template, into covered template spans.

A template gives its label if its spans cover ``MIN_COVER`` of it, or if one span has ``PASSAGE`` words and lies in no longer span
of another label's template (passages that licences share go to the licence that goes on).

Defined results: null or empty text has 0 words and no label; A-Z is lower-cased; words are runs of letters, digits
and non-ASCII characters; equal spans of two licences give both labels; repeated rows give repeated results; an empty table
gives an empty result; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Usual notices by label, besides the whole texts in ``licence_texts``.
NOTICES = {
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or any later version""",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0""",
    "cc-by": """This work is licensed under a Creative Commons Attribution 4.0 International License""",
}
MIN_MATCH, MIN_COVER, PASSAGE = 4, 0.6, 25
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str) -> list[str]:
    # bytes are lower-cased in A-Z alone
    return WORD.findall(text.lower() if text.isascii() else text.encode("utf-8").lower().decode("utf-8"))


def templates() -> list[tuple[str, str]]:
    """(label, text) of all templates; a file's label is its name up to the first dot."""
    files = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    return [(f.name.split(".")[0], f.read_text(encoding="utf-8")) for f in files] + list(NOTICES.items())


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers; every state knows where in which strings it first ends."""

    def __init__(self, strings: list[list[int]]):
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, list[int]]] = [{}]
        for number, string in enumerate(strings):
            last, path = 0, []
            for c in string:
                last = self.extend(last, c)
                path.append(last)
            for i, state in enumerate(path):
                while state > 0:
                    self.ends[state].setdefault(number, []).append(i + 1)
                    state = self.link[state]

    def new(self, length: int, go: dict[int, int], link: int) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(link)
        self.ends.append({})
        return len(self.go) - 1

    def split(self, p: int, c: int, q: int) -> int:
        """A copy of state q for the strings that p reaches by c."""
        copy = self.new(self.length[p] + 1, dict(self.go[q]), self.link[q])
        self.ends[copy] = {k: list(v) for k, v in self.ends[q].items()}
        while p >= 0 and self.go[p].get(c) == q:
            self.go[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def extend(self, last: int, c: int) -> int:
        if (q := self.go[last].get(c)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self.split(last, c, q)
        state = self.new(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.go[p]:
            self.go[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.go[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self.split(p, c, q)
        return state


class LicenceIndex:
    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str] = PHRASES, min_match: int = MIN_MATCH, min_cover: float = MIN_COVER, passage: int = PASSAGE):
        self.min_match, self.min_cover, self.passage = min_match, min_cover, passage
        self.number: dict[str, int] = {}
        texts = [words(t) for t in (*phrases, *(t for _, t in templates))]
        strings = [[self.number.setdefault(w, len(self.number)) for w in t] for t in texts]
        self.phrases, self.phrase_words = list(phrases.values()), strings[: len(phrases)]
        self.labels = [label for label, _ in templates]
        self.sizes = [len(s) for s in strings]
        self.automaton = a = SuffixAutomaton(strings)
        self.grams = np.unique(np.concatenate([self.gram_hashes(np.array(s, np.int64)) for s in strings[len(phrases) :]] or [np.zeros(0, np.uint64)]))
        # phrases that end wherever a match of at least their length ends in this state
        self.phrase_at: list[list[tuple[int, int]]] = [[] for _ in a.go]
        for k in range(len(phrases)):
            state = 0
            for c in strings[k]:
                state = a.go[state][c]
            self.phrase_at[state].append((len(strings[k]), k))
        for state in sorted(range(1, len(a.go)), key=a.length.__getitem__):
            if a.link[state] > 0:
                self.phrase_at[state] = self.phrase_at[state] + self.phrase_at[a.link[state]]

    def gram_hashes(self, ids: np.ndarray) -> np.ndarray:
        n = max(0, len(ids) - self.min_match + 1)
        h = np.zeros(n, np.uint64)
        for k in range(self.min_match):
            h = h * np.uint64(0x9E3779B97F4A7C15) + ids[k : n + k].astype(np.uint64) + np.uint64(1)
        return h

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Parts of a file outside which no phrase stands and no match of ``min_match`` words."""
        h = self.gram_hashes(ids)
        k = np.searchsorted(self.grams, h)
        k[k == len(self.grams)] = 0
        found = [(np.flatnonzero(self.grams[k] == h) if len(self.grams) else k[:0], self.min_match)]
        for phrase in self.phrase_words:
            start = np.flatnonzero(ids[: max(0, len(ids) - len(phrase) + 1)] == phrase[0])
            for j, c in enumerate(phrase[1:], 1):
                start = start[ids[start + j] == c]
            found.append((start, len(phrase)))
        if not any(len(start) for start, _ in found):
            return []
        mark = np.zeros(len(ids) + 1, np.int64)
        for start, size in found:
            mark[start] += 1  # the starts of one kind are distinct
            mark[start + size] -= 1
        covered = np.concatenate([[False], np.cumsum(mark)[:-1] > 0, [False]])
        edges = np.flatnonzero(covered[1:] != covered[:-1])
        return list(zip(edges[::2].tolist(), edges[1::2].tolist()))

    def statistics(self, ids: list[int | None]):
        """(position, state, length) after every word at which some match ends."""
        a = self.automaton
        go, link, length = a.go, a.link, a.length
        state = n = 0
        for i, c in enumerate(ids):
            if c is None:
                if n:
                    state = n = 0
                continue
            while state and c not in go[state]:
                state = link[state]
                n = length[state]
            if (to := go[state].get(c)) is not None:
                state, n = to, n + 1
            else:
                n = 0
            if n:
                yield i, state, n

    def scan(self, text: str) -> tuple[int, list[tuple[str, int]], list[tuple[int, int, int, int, int]], dict[int, float]]:
        """Words, phrase places (label, start), covered spans (template, start, end, template start, template end), cover by template."""
        tokens = words(text)
        ids = np.fromiter(map(self.number.get, tokens, itertools.repeat(-1)), np.int64, len(tokens))
        places, matches = [], []
        for begin, end in self.stretches(ids):
            before = (-2, 0, 0)
            for at in self.statistics([c if c >= 0 else None for c in ids[begin:end].tolist()]):
                i, state, n = at
                places += [(self.phrases[k], begin + i - size + 1) for size, k in self.phrase_at[state] if n >= size]
                if before[2] >= self.min_match and (i != before[0] + 1 or n <= before[2]):
                    matches.append((begin + before[0], *before[1:]))
                before = at
            if before[2] >= self.min_match:
                matches.append((begin + before[0], *before[1:]))
        spans, cover = self.chain(matches)
        return len(tokens), places, spans, cover

    def named(self, spans: list[tuple[int, int, int, int, int]], cover: dict[int, float]) -> dict[str, float]:
        """Labels that the templates give, with the share that is covered (``min_cover`` at least)."""
        out: dict[str, float] = {}
        give = [(k, c) for k, c in cover.items() if c >= self.min_cover]
        long = [s for s in spans if s[2] - s[1] >= self.passage]
        for k, start, end, *_ in long:
            if not any(a <= start and end <= b and b - a > end - start and self.labels[t] != self.labels[k] for t, a, b, *_ in long):
                give.append((k, max(cover[k], self.min_cover)))
        for k, c in give:
            out[self.labels[k]] = max(c, out.get(self.labels[k], 0.0))
        return out

    def chain(self, matches: list[tuple[int, int, int]]):
        """Per template, the order-preserving chain of matches that covers most of it."""
        skip, spans, cover = len(self.phrases), [], {}
        per: dict[int, list[tuple[int, int, int]]] = {}
        for i, state, n in matches:
            for string, ends in self.automaton.ends[state].items():
                if string >= skip:
                    per.setdefault(string, []).extend((i, e, n) for e in ends)
        for string, found in sorted(per.items()):
            found.sort()
            # best chains by where they end in the template: ends rise, so do covers
            ends, covers, chains = [0], [0], [None]
            for i, e, n in found:
                k = bisect_left(ends, e - n + 1) - 1
                got, chain = covers[k] + n, (i, e, n, chains[k])
                at = bisect_left(ends, e)
                if covers[at - 1] >= got or (at < len(ends) and ends[at] == e and covers[at] >= got):
                    continue
                stop = at
                while stop < len(ends) and covers[stop] <= got:
                    stop += 1
                ends[at:stop], covers[at:stop], chains[at:stop] = [e], [got], [chain]
            chain = chains[-1]
            cover[string - skip] = covers[-1] / self.sizes[string]
            while chain:
                i, e, n, chain = chain
                spans.append((string - skip, i - n + 1, i + 1, e - n, e))
        return sorted(spans, key=lambda s: (s[1], s[0])), cover


SCHEMA = (
    "doc_id long, n_words long, phrases array<struct<label:string,start:long>>, "
    "spans array<struct<label:string,start:long,end:long,template_start:long,template_end:long>>, base_labels array<string>, labels array<string>, score double"
)


def licence_scan(docs: DataFrame, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """Words, phrase places, covered template spans, labels and score of every row of ``docs(doc_id, text)``.

    ``known`` are the templates (label, text), by default all; they are broadcast, so keep them to some megabytes.  The score is
    1 with a phrase, else the best cover of a template (``MIN_COVER`` at least if it gives its label)."""
    spread = docs.sparkSession.sparkContext.broadcast(templates() if known is None else known)
    held: list[LicenceIndex] = []

    def each(ids: list, texts: list[str]) -> dict[str, list]:
        if not held:
            held.append(LicenceIndex(spread.value))
        index, out = held[0], {c: [] for c in ("doc_id", "n_words", "phrases", "spans", "base_labels", "labels", "score")}
        for i, t in zip(ids, texts):
            n, places, spans, cover = index.scan(t)
            base, named = {label for label, _ in places}, index.named(spans, cover)
            row = (
                i, n, [{"label": x, "start": s} for x, s in places],
                [dict(zip(("label", "start", "end", "template_start", "template_end"), (index.labels[s[0]], *s[1:]))) for s in spans],
                sorted(base), sorted(base | named.keys()), 1.0 if base else min(1.0, max([*cover.values(), *named.values()], default=0.0)),
            )
            for c, v in zip(out.values(), row):
                c.append(v)
        return out

    return map_texts(docs, each, SCHEMA)


def licence_digest(found: DataFrame) -> DataFrame:
    starts = F.transform("phrases", lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"), F.concat_ws(",", "labels").alias("labels"), "score",
    )
