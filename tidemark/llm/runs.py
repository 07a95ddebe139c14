"""Periodic runs of a text's words: stretches that repeat with a period, and the text without the repeats.

A run is a stretch of consecutive words with smallest period q and a length of at least ``LEAST`` words and
``CYCLES`` periods, which no neighbouring word extends.

**Suffix automaton with link-cut access.** The suffix links of the automaton form a tree: the ancestors of a prefix's
state are the suffixes of that prefix. Each appended word accesses its prefix's state: the path from the root
to it is recoloured to the new end. Before that, each segment of one colour on the path tells where its
suffixes ended last, so the distance d of both ends and the longest length l of the segment say that the last
l words equal those d before: a stretch of l + d words with period d. As no shorter shift fits, d is its smallest
period, and as l is the longest, no word to the left extends it. It is a run when the word to the right doesn't
either. Colours lie as in a link-cut tree, in preferred paths that an access cuts and links anew; the tree is
finished before the first access, so the auxiliary trees are stacks over its heavy paths. n accesses change
O(n log n) segments.

**What the automaton sees.** Every word of a run lies in a window of ``WINDOW`` words that stands in the text
twice, since a run is at least that much longer than its period. Windows are hashed at once, and only stretches
of words covered by repeated windows get an automaton. A run lies in one stretch whole; hash collisions make
stretches longer and lose nothing.

A text is handled by one task, as its runs are its own. Memory: some 30 bytes a word for hashes, and about
half a kilobyte for each word of one stretch.

Defined results: a NULL, empty or blank text has no run and an empty collapsed text. Repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from tidemark.llm.frames import arrow_column

LEAST, CYCLES = 24, 3
# Of a run of n words with period q, n - q words repeat; at least this many.
WINDOW = LEAST - LEAST // CYCLES
# Odd multipliers of the window hash, one per doubling.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def automaton(words: Sequence[bytes]) -> tuple[list[int], list[int], list[int]]:
    """Longest length and suffix link of every state, and the state of every prefix. State 0 is the root."""
    length, link, go, last, ends = [0], [-1], [{}], 0, []
    for word in words:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        go.append({})
        at = last
        while at >= 0 and word not in go[at]:
            go[at][word] = new
            at = link[at]
        if at >= 0:
            old = go[at][word]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                copy = len(length)
                length.append(length[at] + 1)
                link.append(link[old])
                go.append(go[old].copy())
                link[old] = link[new] = copy
                while at >= 0 and go[at].get(word) == old:
                    go[at][word] = copy
                    at = link[at]
        last = new
        ends.append(new)
    return length, link, ends


def heads(length: list[int], link: list[int], least: int) -> list[int]:
    """Topmost state of each state's heavy path, among states of at least that length."""
    sizes = np.array(length)
    order = np.argsort(sizes, kind="stable")
    order = order[np.searchsorted(sizes[order], least) :].tolist()
    weight, most, heavy = [1] * len(length), [0] * len(length), [-1] * len(length)
    for state in reversed(order):
        up, w = link[state], weight[state]
        weight[up] += w
        if w > most[up]:
            most[up], heavy[up] = w, state
    head = list(range(len(length)))
    for state in order:
        up = link[state]
        if heavy[up] == state and length[up] >= least:
            head[state] = head[up]
    return head


def runs_of(words: Sequence[bytes]) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of every run of a stretch."""
    size = len(words)
    length, link, ends = automaton(words)
    head = heads(length, link, WINDOW)
    # By heavy path: (length of the deepest state, colour) of each segment, the topmost last.
    colours: dict[int, list[tuple[int, int]]] = {}
    for end, state in enumerate(ends):
        met = []
        while length[state] >= WINDOW:
            top, deep, seen = head[state], length[state], 0
            path = colours.setdefault(top, [])
            while path and path[-1][0] <= deep:
                segment = path.pop()
                seen = segment[0]
                met.append(segment)
            if path and seen < deep:
                met.append((deep, path[-1][1]))
            path.append((deep, end))
            state = link[top]
        for common, before in met:
            period = end - before
            if common >= (CYCLES - 1) * period and common + period >= LEAST:
                if end + 1 == size or words[end + 1] != words[end + 1 - period]:
                    yield end + 1 - common - period, common + period, period


def stretches(words: Sequence[bytes]) -> list[tuple[int, int]]:
    """(first word, word behind the last) of what is covered by windows that stand in the text twice."""
    size = len(words) - WINDOW + 1
    if size < 2:
        return []
    mixed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    width = 1
    for factor in FACTORS:
        mixed = mixed[:-width] * np.uint64(factor) + mixed[width:]
        width *= 2
    ordered = np.sort(mixed)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return []
    at = np.flatnonzero(np.isin(mixed, again))
    breaks = np.flatnonzero(np.diff(at) > WINDOW)
    firsts = at[np.concatenate(([0], breaks + 1))]
    lasts = at[np.concatenate((breaks, [len(at) - 1]))]
    return list(zip(firsts.tolist(), (lasts + WINDOW).tolist(), strict=True))


def collapse(words: list[bytes]) -> tuple[list[tuple[int, int, int]], bytes]:
    """Runs by start and period, and the words outside all runs' repeats."""
    runs = sorted(
        ((first + start, length, period) for first, last in stretches(words)
         for start, length, period in runs_of(words[first:last])),
        key=lambda run: (run[0], run[2]),
    )
    if not runs:
        return runs, b" ".join(words)
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period : start + length] = b"\1" * (length - period)
    return runs, b" ".join([w for w, gone in zip(words, dropped, strict=True) if not gone])


def periodic_runs(text: str | Column) -> Column:
    """struct<runs, collapsed> of a text: runs by start and period, words behind a run's first period left out."""

    def batch(texts: list[bytes | None]) -> pa.Array:
        # The white space of bytes.split is the six ASCII characters.
        found = [collapse((t or b"").split()) for t in texts]
        return pa.StructArray.from_arrays(
            [pa.array([runs for runs, _ in found], pa.list_(RUN)), pa.array([c for _, c in found], pa.binary()).cast(pa.string())],
            ["runs", "collapsed"],
        )

    column = F.col(text) if isinstance(text, str) else text
    return arrow_column(batch, FOUND, column.cast("binary"))
