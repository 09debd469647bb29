"""Operator 13: periodic runs of words by an online sparse diagonal program.

A run of period q is a stretch of consecutive words in which words q apart are identical.  On
diagonal q (pairs of places q apart) its matches are a stretch of the run's length less q.
The words of a text are read once, in order; at each word its earlier occurrences name the
diagonals that go on, and increment their match lengths; a diagonal that does not go on ends,
and is emitted at once as a run if its stretch is long enough.  Only diagonals alive at the
present word are held.

Two rules keep the program sparse without changing its result:

* A run has at least ``max(least - q, q)``, hence ``ceil(least / 2)``, matches on its diagonal, so
  an occurrence counts only if that many words ending there agree as well (six, by default).
  Occurrences of frequent words cost nothing unless their context repeats.
* While diagonal p is alive, in a run that starts at r, no diagonal d >= 2p is begun at a word i
  with i - d >= r.  A run of period d that only had matches of this kind would lie in one run of
  period p (two such runs of periods up to d/2 that overlap by d words or more have a common
  period, so they are one), and having length 2d or more it would have the period gcd(p, d) < d.
  A diagonal that still matches once the run of period p is over begins where its matches began.

A run of period q also shows on diagonals 2q, 3q, ...; those that end together with the same
start are one run, and the least diagonal is its period.  Words of one text stay in one task;
nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 12, 2


def contexts(words: np.ndarray, k: int) -> np.ndarray:
    """The number of the run of ``k`` words that starts at each place; equal runs have equal
    numbers (exact: numbers of halves are paired and numbered again)."""
    if len(words) < k:
        return np.zeros(0, dtype=np.int64)
    if k == 1:
        return words
    half = k // 2
    a, b = contexts(words, half), contexts(words, k - half)
    pairs = a[:len(b)][:len(words) - k + 1] * np.int64(len(words) + 1) + b[half:half + len(words) - k + 1]
    return np.unique(pairs, return_inverse=True)[1].reshape(-1).astype(np.int64)


def numbered(words: list) -> np.ndarray:
    """Words as the numbers of their first occurrence order."""
    ids: dict = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)


def runs(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words`` with its smallest period q and length at
    least ``max(least, times * q)``, ``times`` >= 2, by start, then period."""
    k = max(1, least - least // times)               # matches on the diagonal of any run, at least
    if len(words) < least:
        return []
    context = contexts(numbered(words), k)
    order = np.argsort(context, kind="stable")
    again = np.flatnonzero(context[order][1:] == context[order][:-1])
    if not len(again):                               # no context repeats: no diagonal can get long enough
        return []
    repeated = np.zeros(context.max() + 1, dtype=bool)
    repeated[context[order][again]] = True
    places = np.flatnonzero(repeated[context]).tolist()
    at = context.tolist()
    out: list[tuple[int, int, int]] = []
    earlier: dict[int, list[int]] = {}
    alive: dict[int, int] = {}                       # diagonal -> first place (of the later word) of its stretch

    def end(gone: list[tuple[int, int]], stop: int) -> None:
        """Emit the diagonals that have their last match before ``stop``."""
        found: dict[int, int] = {}
        for d, first in gone:
            if stop - first + d >= max(least, times * d):
                found[first - d] = min(d, found.get(first - d, d))
        out.extend((s, stop - s, d) for s, d in found.items())

    for i, before in zip(places, [-1, *places]):     # i: first word of a context that repeats
        c = at[i]
        if alive:
            follow = i == before + 1
            gone = [(d, f) for d, f in alive.items() if not follow or at[i - d] != c]
            if gone:
                end(gone, before + k)
                for d, _ in gone:
                    del alive[d]
        here = earlier.setdefault(c, [])
        x, zones, z, reach = len(here) - 1, [], 0, i
        while x >= 0:                                # nearest first
            j = here[x]
            while z < len(zones) and j <= zones[z][0]:
                reach = min(reach, zones[z][1])
                z += 1
            if j >= reach:                           # in a run of less than half the distance: pass over all of it
                x = bisect_left(here, reach, 0, x) - 1
                continue
            d = i - j
            first = alive.get(d)
            if first is None:                        # begins here, or earlier if it was passed over till now
                first = i
                while first > d and at[first - 1] == at[first - 1 - d]:
                    first -= 1
                alive[d] = first
            if first - d <= i - 2 * d:
                zones.append((i - 2 * d, first - d))
            x -= 1
        here.append(i)
    end(list(alive.items()), places[-1] + k)
    return sorted(out)


def kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: all but those that some run holds after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit=None,
           least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs array<struct<start, length, period>>, collapsed): one row per document
    row; ``collapsed`` are the kept words joined by one space.

    ``edit``, if given, is a function of (doc_id, list of words) that returns the words to look
    at.  Null and empty texts have no words, no runs and an empty ``collapsed``.  Rows keep
    their ids, null and repeated ones too.  Words are compared byte by byte, in a text of any
    length.  An empty table gives an empty result; other columns are ignored."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["start", "length", "period"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, spans, texts = [], [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                # bytes.split() takes runs of ASCII white space as one gap
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                if edit is not None:
                    words = edit(doc_id, words)
                found = runs(words, least, times)
                stay = words if not found else [words[i] for i in np.flatnonzero(kept(len(words), found)).tolist()]
                sizes.append(len(words))
                spans.append([dict(zip(names, r)) for r in found])
                texts.append(b" ".join(stay).decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([(x, pa.int64()) for x in names]))), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
