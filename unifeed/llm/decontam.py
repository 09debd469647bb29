"""Operator 1: benchmark decontamination by rare seeds and Smith-Waterman alignment.

The distinct test items (a stated query set) are laid out in blocks of bounded size; each
block is sent to all tasks and the documents are scanned twice per block: to count the seeds
and to look for them.

1. seeds: a seed is a pair of words next to each other or one word apart.  An alignment of an
   item of L words that reaches ``min_score`` (of 2L) has, for M matches, at most
   2M - 2L * min_score mismatches and gaps to spend on its M - 1 steps from one match to the
   next; so at least T = L * min_score - 1 steps spend one or none, and each of them is a seed
   of the item and of the document.  The seeds of an item start at L - 1 places, so of any
   L - 1 - T + K places at least K are met.  Those whose seeds are rarest are taken (by the
   count in the documents times that in the items): rarity orders the work, it loses nothing;
2. K hits within the diagonals that one alignment can span name a passage, wide enough for
   any alignment through them that can reach ``min_score``;
3. a passage that holds too few of the item's words to reach ``min_score`` in any order goes
   (an upper bound of the score, so nothing is lost);
4. Smith-Waterman aligns the rest to the item word by word (match 2, mismatch and gap -1).
   A pair is reported if its score reaches ``min_score`` of the best possible.

Everything happens inside the scans, so texts are never shuffled; counts of the items' seeds
and found pairs are all that leaves them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WORD, table
from .words import chunks, mix64, split, word_hashes

MIN_SCORE = 0.5
MIN_WORDS = 3
BLOCK_WORDS = 2_000_000
HIT, MISS, GAP = 2, 1, 1
HITS_NEEDED = 3          # K
SLICE = 1 << 21          # hits laid out at a time
_BITS = 22


def item_words(column: pa.Array) -> list[np.ndarray]:
    """The word hashes of every text."""
    out = []
    for lo, hi, data, offsets in chunks(column):
        start, end, row = split(data, offsets)
        h = word_hashes(data, start, end)
        cut = np.searchsorted(row, np.arange(hi - lo + 1))
        out += [h[cut[i]:cut[i + 1]] for i in range(hi - lo)]
    return out


def pairs(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of the first word) of every pair of words of one row that are next to each
    other or one word apart; the hash does not tell which."""
    hashes, places = [], []
    for step in (1, 2):
        at = np.flatnonzero(row[:-step] == row[step:])
        hashes.append(mix64(words[at] * np.uint64(3) + mix64(words[at + step])))
        places.append(at)
    return np.concatenate(hashes), np.concatenate(places)


class Items:
    """A bounded block of test items: their words and an index of their seeds."""

    def __init__(self, ids: list, words: list[np.ndarray], min_score: float):
        self.ids, self.words = ids, words
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        least = min_score * HIT * self.length
        #: gaps that an alignment over the bar can hold, hence the diagonals it can span
        self.margin = np.ceil((HIT * self.length - least) / GAP).astype(np.int64)
        self.steps = np.maximum(1, np.ceil(min_score * self.length - 1e-9).astype(np.int64) - 1)       # T
        self.need = np.minimum(HITS_NEEDED, self.steps)                                                # K
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        row = np.repeat(np.arange(len(words)), self.length)
        first = np.concatenate(([0], np.cumsum(self.length)))
        seed, at = pairs(flat, row)
        self._fill(seed, row[at], at - first[row[at]])

    def _fill(self, seed, item, at):
        order = np.argsort(seed, kind="stable")
        self.item, self.at = item[order], at[order]
        self.seeds, self.start = np.unique(seed[order], return_index=True)
        self.start = np.append(self.start, len(order))
        bits = min(25, max(_BITS, int(len(self.seeds)).bit_length() + 4))
        self.shift = np.uint64(64 - bits)
        self.bitmap = np.zeros(1 << bits, dtype=bool)        # tells quickly that a hash is no seed
        self.bitmap[(self.seeds >> self.shift).astype(np.int64)] = True

    def keep_rarest(self, counts: np.ndarray) -> None:
        """Leave the seeds of the cheapest places of each item, as many as lose no alignment;
        ``counts``: occurrences of each seed in the documents."""
        posted = np.diff(self.start)
        seed = np.repeat(np.arange(len(self.seeds)), posted)
        place = self.item * (int(self.length.max(initial=0)) + 1) + self.at
        places, where = np.unique(place, return_inverse=True)
        work = np.bincount(where, weights=((counts + 1.0) * posted)[seed], minlength=len(places))
        of = np.zeros(len(places), dtype=np.int64)
        of[where] = self.item
        order = np.lexsort((places, work, of))               # by item, cheapest first
        rank = np.empty(len(places), dtype=np.int64)
        begin = np.searchsorted(of[order], np.arange(len(self.length)))
        rank[order] = np.arange(len(places)) - begin[of[order]]
        taken = (rank < (self.length - 1 - self.steps + self.need)[of])[where]
        self._fill(self.seeds[seed[taken]], self.item[taken], self.at[taken])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``hashes`` that are seeds, which seeds)."""
        maybe = np.flatnonzero(self.bitmap[(hashes >> self.shift).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        k = np.minimum(np.searchsorted(self.seeds, hashes[maybe]), len(self.seeds) - 1)
        real = self.seeds[k] == hashes[maybe]
        return maybe[real], k[real]


def passages(index: Items, row: np.ndarray, place: np.ndarray, seed: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, first word, end) of every passage to align, given the hits of whole rows:
    ``place`` counts from the row's first word.

    A hit's diagonal is its place in the document minus that in the item.  Hits stay if ``need``
    of them lie within the diagonals that one alignment can span; those no further apart than
    that form one passage."""
    if not len(row):
        return
    pad, n = int(index.margin.max()) + 1, len(index.length)
    lead = int(index.length.max())
    span = int(place.max()) + 1 + lead + pad                 # no window reaches the next group
    total = np.concatenate(([0], np.cumsum(np.diff(index.start)[seed])))
    spots, counts, lo = [], [], 0
    while lo < len(row):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + SLICE, "right")) - 1)
        many = np.diff(total[lo:hi + 1])
        hit = np.repeat(np.arange(lo, hi), many)
        post = np.arange(len(hit)) - np.repeat(total[lo:hi] - total[lo], many) + index.start[seed[hit]]
        code = (row[hit] * n + index.item[post]) * span + (place[hit] - index.at[post] + lead)
        code, count = np.unique(code, return_counts=True)
        spots.append(code)
        counts.append(count)
        lo = hi
    code, where = np.unique(np.concatenate(spots), return_inverse=True)
    upto = np.concatenate(([0], np.cumsum(np.bincount(where, weights=np.concatenate(counts)).astype(np.int64))))
    item = code // span % n
    end = np.searchsorted(code, code + index.margin[item], "right")
    good = np.flatnonzero(upto[end] - upto[:-1] >= index.need[item])
    cover = np.bincount(good, minlength=len(code) + 1) - np.bincount(end[good], minlength=len(code) + 1)
    stay = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    if not len(stay):
        return
    code, item = code[stay], item[stay]
    group, diagonal = code // span, code % span - lead
    new = np.append(True, (np.diff(group) != 0) | (np.diff(diagonal) > index.margin[item[1:]]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(code)) - 1
    for g, i, a, b in zip((group[first] // n).tolist(), item[first].tolist(), diagonal[first].tolist(), diagonal[last].tolist()):
        margin = int(index.margin[i])
        yield g, i, a - margin, b + int(index.length[i]) + margin


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(best score, start, end) of the local alignment of ``item`` within ``text``.

    Row by row; gaps along the row are a running maximum.  The start is carried with the
    score (score * 2^32 + start compares by score first)."""
    m = len(text)
    shift = np.int64(1) << 32
    col = np.arange(m + 1, dtype=np.int64)
    fresh = col.copy()                                   # score 0, starting here
    prev, best, end = fresh.copy(), np.int64(0), 0
    for w in item:
        cur = np.maximum(prev - GAP * shift, fresh)
        diag = prev[:-1] + np.where(text == w, HIT, -MISS) * shift
        cur[1:] = np.maximum(cur[1:], diag)
        # a gap along the row costs GAP a step: maximum of (value + cost so far)
        run = np.maximum.accumulate(cur + col * GAP * shift) - col * GAP * shift
        cur = np.maximum(cur, np.maximum(run, fresh))
        j = int(np.argmax(cur))
        if cur[j] > best:
            best, end = cur[j], j
        prev = cur
    return int(best >> 32), int(best & 0xFFFFFFFF), end


def highest(item: np.ndarray, text: np.ndarray) -> int:
    """No alignment of ``item`` within ``text`` scores more: a word of the item that the text
    lacks costs a mismatch or a gap, any other is a match at best (best run of the item)."""
    total = np.cumsum(np.where(np.isin(item, text), HIT, -min(MISS, GAP)))
    return max(0, int((total - np.minimum.accumulate(np.append(0, total[:-1]))).max()))


def _blocks(items: DataFrame, block_words: int) -> list[DataFrame]:
    """The distinct items dealt into blocks of about ``block_words`` words by their key."""
    total = items.agg(F.sum("words")).first()[0] or 0
    count = max(1, math.ceil(total / block_words))
    if count == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_key"), F.lit(count)) == i) for i in range(count)]


def _load(block: DataFrame, min_score: float) -> Items:
    t = block.select("item_key", "item_text").toArrow()      # bounded by block_words
    return Items(t.column(0).to_pylist(), item_words(t.column(1)), min_score)


def _rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, words, row of each word, first word of each row) of runs of rows."""
    for lo, hi, data, offsets in chunks(column):
        start, end, row = split(data, offsets)
        yield lo, word_hashes(data, start, end), row, np.searchsorted(row, np.arange(hi - lo + 1))


def _count_seeds(texts: DataFrame, index: Items) -> np.ndarray:
    """How often each seed of the block occurs in the documents: summed per task, then by seed."""
    send = texts.sparkSession.sparkContext.broadcast(index)

    def run(batches, send=send):
        index = send.value
        seen = np.zeros(len(index.seeds), dtype=np.int64)
        for b in batches:
            for _, words, row, _ in _rows(b.column(0)):
                seen += np.bincount(index.find(pairs(words, row)[0])[1], minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["seed", "n"])

    t = texts.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toArrow()
    send.destroy()
    counts = np.zeros(len(index.seeds), dtype=np.int64)      # one number a seed of the block
    counts[t.column(0).to_numpy()] = t.column(1).to_numpy()
    return counts


def _search(texts: DataFrame, index: Items, min_score: float) -> DataFrame:
    """(doc_id, item_key, score, start_word, end_word, item_words) of the block's items."""
    spark = texts.sparkSession
    schema = (f"doc_id {texts.schema['id'].dataType.simpleString()}, item_key string, score double, "
              "start_word long, end_word long, item_words long")
    send = spark.sparkContext.broadcast(index)

    def run(batches, send=send):
        index = send.value
        for b in batches:
            best = {}
            for lo, words, row, cut in _rows(b.column(1)):
                hashes, at = pairs(words, row)
                hit, seed = index.find(hashes)
                at = at[hit]
                for r, item, s, e in passages(index, row[at], at - cut[row[at]], seed):
                    text, target = words[cut[r]:cut[r + 1]], index.words[item]
                    s, e = max(0, s), min(len(text), e)
                    least = min_score * HIT * len(target)
                    if highest(target, text[s:e]) < least:
                        continue
                    score, i, j = smith_waterman(target, text[s:e])
                    if score >= least and score > best.get((lo + r, item), (0,))[0]:
                        best[lo + r, item] = (score, s + i, s + j)
            if best:
                found = [(*key, *value) for key, value in best.items()]
                length = [int(index.length[x[1]]) for x in found]
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array([x[0] for x in found])),
                    pa.array([index.ids[x[1]] for x in found]),
                    pa.array([x[2] / (HIT * n) for x, n in zip(found, length)], pa.float64()),
                    *[pa.array([x[k] for x in found], pa.int64()) for k in (3, 4)], pa.array(length, pa.int64())],
                    names=["doc_id", "item_key", "score", "start_word", "end_word", "item_words"])

    out = table(texts.mapInArrow(run, schema))
    send.destroy()
    return out


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", min_score: float = MIN_SCORE,
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word, item_words): one row per document row and
    item whose best passage scores at least ``min_score`` of a perfect copy.  No such pair is
    lost as long as ``min_score`` times the item's words is over 1.

    Null and empty texts on either side match nothing; items of one or two words are not
    searched (one word in common would reach the bar).  Null ids are reported as null.  Repeated
    document or item rows are reported once per (document row, item row).  Ties between passages:
    the first.  Empty tables give an empty result; other columns are ignored."""
    asked = (items.where(F.regexp_count(item_text, F.lit(WORD)) >= MIN_WORDS)
                  .select(F.col(item_id).alias("item_id"), F.sha2(F.col(item_text), 256).alias("item_key"),
                          F.col(item_text).alias("item_text")))
    distinct = table(asked.groupBy("item_key").agg(F.min("item_text").alias("item_text"))
                          .withColumn("words", F.regexp_count("item_text", F.lit(WORD)).cast("long")))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
    found = None
    for block in _blocks(distinct, block_words):
        index = _load(block, min_score)
        if index.ids:
            index.keep_rarest(_count_seeds(texts, index))
        part = _search(texts, index, min_score)
        found = part if found is None else found.unionByName(part)
    return found.join(asked.select("item_id", "item_key"), "item_key").select(
        "doc_id", "item_id", "score", "start_word", "end_word", "item_words")
