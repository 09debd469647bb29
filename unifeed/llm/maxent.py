"""Operator 5: a hashed maximum-entropy language model with class-factored softmax.

``P(w | history) = P(class(w) | history) * P(w | class(w), history)``.  The most frequent
words are classes of their own, all others belong to a class by their ending; endings are
grouped by the words they follow (k-means over counts of all training text).  Both factors
are maximum-entropy models over the same hashed features: the previous word, skip features
(the second and third word back) and the bigram of the last two.  The class is one softmax.
Within a class the words are the leaves of a tree of softmaxes over at most ``WIDTH``
children (``trees``); a node starts from its children's smoothed shares of the training
tokens, so a model without weights gives a word its share, and every weight learned moves
it by its context.

Every word of the broadcast (the ``HEAD`` most frequent) is a leaf and, as history, a
feature of its own.  Rarer words are leaves by bucket of their hash, ``TAILS`` buckets a
class; within its bucket a word has its smoothed share.  As history they stand for their
class.  An unseen word has one token's share of its class.  All of it adds up to 1
(tested over whole vocabularies).

A feature's weights are the row of a table at its hash (with the node's, within classes).
The tables grow with the training tokens up to ``MOST_BITS``, what a worker holds; beyond
that more features share a row.

Counts cover all training text: words are counted in tasks, summed by a shuffle, and kept
as a table.  The weights are trained by distributed gradient updates: every task takes
AdaGrad steps over its share of the round's documents from the common weights, the changes
are averaged by row, and the next round continues with the next documents; each training
document is used once.  Scoring runs in sparse numpy batches.  Counts of frequent words
are broadcast, all other words meet their counts by a join.

Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as wd
from .shared import table

HEAD = 1 << 18            # words whose counts are broadcast, at most
OWN, GROUPS = 24, 39      # classes: end of text, OWN frequent words, GROUPS of endings
CLASSES = 1 + OWN + GROUPS
TAILS = 1 << 11           # buckets of a class's words beyond the broadcast
WIDTH = 16                # children of a tree's node, at most
ENDINGS, CONTEXT = 4096, 32
ROUNDS, RATE, BATCH = 4, 0.3, 8192
LEAST_TOKENS, MOST_TOKENS = 3_000_000, 5_000_000    # what a training task learns from, about
END_HASH = wd.hash_word("\x00end")
LEAST_BITS, MOST_BITS = 12, 14                 # rows of a feature in the class table: 2^bits
WORD_BITS = 4                                  # so many more in the words' table
SLOTS = tuple(k << LEAST_BITS for k in range(4))   # previous, second back, third back, bigram
_START = CLASSES                               # what stands before a text; words follow
_BLOCK = 1 << 14                               # weights of a table that travel together
WIDTHS = CLASSES, WIDTH                        # of the class table, the words' table
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.float32(-1e9)                       # log share of a child that is not there


class Lookup:
    """Places of hashes in a sorted array, by the top bits and a short walk."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(0))
        bits = max(1, min(20, int(len(keys)).bit_length() + 1))
        self.shift = np.uint64(64 - bits)
        cells = (keys >> self.shift).astype(np.int64)
        self.first = np.searchsorted(cells, np.arange(1 << bits)).astype(np.int32)
        self.walk = int(np.bincount(cells, minlength=1).max()) if len(keys) else 0
        self.size = len(keys)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """Places, or -1."""
        out, at = np.full(len(h), -1, dtype=np.int64), self.first[(h >> self.shift).astype(np.int64)]
        left = np.arange(len(h))
        for _ in range(self.walk):
            key, here = self.keys[np.minimum(at, self.size)], at < self.size
            hit = (key == h[left]) & here
            out[left[hit]] = at[hit]
            on = (key < h[left]) & here                # keys are in order: a larger one ends the walk
            left, at = left[on], at[on] + 1
        return out


def texts(column: pa.Array):
    """(first row, rows, word hashes, ending ids, row of each word) of runs of whole texts."""
    for lo, hi, data, offsets in wd.chunks(column):
        start, end, row = wd.split(data, offsets)
        ending = (wd.word_hashes(data, np.maximum(start, end - 3), end) >> np.uint64(52)).astype(np.int64)
        yield lo, hi - lo, wd.word_hashes(data, start, end), ending, row


def counts(train: DataFrame, text_col: str) -> DataFrame:
    """(kind, key, ending, n): kind 0 counts words (key: hash), kind 1 endings after a word
    (key: ending * CONTEXT + bucket of the word before)."""
    def merged(parts):
        key = np.concatenate([p[0] for p in parts])
        order = np.argsort(key, kind="stable")
        key, first = np.unique(key[order], return_index=True)
        return key, np.concatenate([p[1] for p in parts])[order][first], \
            np.add.reduceat(np.concatenate([p[2] for p in parts])[order], first)

    def batch(kind, key, ending, n):
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)),
            pa.array(ending.astype(np.int32)), pa.array(n)], names=["kind", "key", "ending", "n"])

    def run(batches):
        parts, held, ends = [], 0, 0
        pairs = np.zeros(ENDINGS * CONTEXT, dtype=np.int64)
        for b in batches:
            for _, rows, h, ending, row in texts(b.column(0)):
                ends += rows
                if not len(h):
                    continue
                key, first, n = np.unique(h, return_index=True, return_counts=True)
                parts.append((key, ending[first], n))
                held += len(key)
                same = row[1:] == row[:-1]
                before = (h[:-1][same] >> np.uint64(59)).astype(np.int64)
                pairs += np.bincount(ending[1:][same] * CONTEXT + before, minlength=len(pairs))
                if held > 1_500_000:                       # bounded memory: pass on what is merged
                    parts = [merged(parts)]
                    if len(parts[0][0]) > 750_000:
                        yield batch(0, *parts.pop())
                    held = sum(len(p[0]) for p in parts)
        if parts:
            yield batch(0, *merged(parts))
        at = np.flatnonzero(pairs)
        yield batch(1, at.astype(np.uint64), np.zeros(len(at)), pairs[at])
        if ends:
            yield batch(0, np.array([END_HASH], dtype=np.uint64), np.array([-1]), np.array([ends]))
    out = train.select(text_col).mapInArrow(run, "kind int, key long, ending int, n long")
    return out.groupBy("kind", "key").agg(F.max("ending").alias("ending"), F.sum("n").alias("n"))


def group_endings(pairs: np.ndarray, seed: int = 3) -> np.ndarray:
    """The group of each ending: k-means over the square roots of what stands before it."""
    total = pairs.sum(1)
    x = np.sqrt(pairs / np.maximum(total, 1)[:, None])
    order = np.argsort(-total, kind="stable")
    centre = x[order[:GROUPS]].copy()
    centre += np.random.default_rng(seed).normal(0, 1e-6, centre.shape)
    group = np.zeros(len(x), dtype=np.int64)
    for _ in range(25):
        new = np.argmin(((x ** 2).sum(1)[:, None] - 2 * x @ centre.T) + (centre ** 2).sum(1), axis=1)
        if (new == group).all():
            break
        group = new
        weight = np.zeros((len(x), GROUPS))
        weight[np.arange(len(x)), group] = total
        size = weight.sum(0)
        centre = np.where(size[:, None] > 0, (weight.T @ x) / np.maximum(size, 1)[:, None], centre)
    return group


def trees(cls: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(steps before each leaf's first, node, child, log shares of each node's children).

    The leaves of a class are ordered by mass and dealt to ``WIDTH`` children of about equal
    mass, again within each child, until a node has ``WIDTH`` leaves at most: frequent words
    take few steps."""
    n = len(cls)
    order = np.lexsort((np.arange(n), -mass, cls))
    at, run_of = np.arange(n), cls[order]
    leaf, node, child, shares, nodes = [], [], [], [], 0
    mass = mass[order].astype(float)
    while len(at):
        first = np.flatnonzero(np.append(True, run_of[1:] != run_of[:-1]))
        size = np.diff(np.append(first, len(at)))
        many = np.repeat(size > 1, size)                        # a leaf alone is reached
        at, run_of = at[many], run_of[many]
        if not len(at):
            break
        size = size[size > 1]
        first = np.cumsum(size) - size
        run = np.repeat(np.arange(len(size)), size)
        m = mass[at]
        total = np.add.reduceat(m, first)
        ahead = np.cumsum(m) - m
        middle = (ahead - ahead[first][run] + m / 2) / total[run]
        to = np.where(size[run] <= WIDTH, np.arange(len(at)) - first[run],
                      np.minimum((middle * WIDTH).astype(np.int64), WIDTH - 1))
        leaf.append(at)
        node.append(nodes + run)
        child.append(to)
        share = np.bincount(run * WIDTH + to, m, len(size) * WIDTH).reshape(-1, WIDTH) / total[:, None]
        shares.append(np.where(share > 0, np.log(np.maximum(share, 1e-300)), _NONE).astype(np.float32))
        nodes += len(size)
        on = size[run] > WIDTH
        at, run_of = at[on], (run * WIDTH + to)[on]
    if not leaf:
        return np.zeros(n + 1, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int8), np.zeros((0, WIDTH), np.float32)
    of = order[np.concatenate(leaf)]
    by_leaf = np.argsort(of, kind="stable")
    before = np.append(0, np.cumsum(np.bincount(of, minlength=n))).astype(np.int32)
    return before, np.concatenate(node)[by_leaf].astype(np.int32), np.concatenate(child)[by_leaf].astype(np.int8), np.concatenate(shares)


class Model:
    """What every task needs: frequent words, classes, trees and weights."""

    def __init__(self, head: np.ndarray, head_n: np.ndarray, rank: np.ndarray, groups: np.ndarray,
                 bits: int = LEAST_BITS):
        self.find, self.head_n, self.groups, self.bits = Lookup(head), head_n, groups, bits
        self.rank = np.append(rank, 2 * HEAD + len(rank)).astype(np.int32)       # at -1: unknown
        self.w = np.zeros((4 << bits, CLASSES), dtype=np.float32)
        self.bias = np.zeros(CLASSES, dtype=np.float32)
        self.words = np.zeros((4 << bits + WORD_BITS, WIDTH), dtype=np.float32)
        self.leaf = np.full(len(head) + 1, -1, dtype=np.int32)       # of a place in head
        self.tail = np.full(CLASSES * TAILS, -1, dtype=np.int32)     # of a bucket
        self.tail_mass = np.zeros(CLASSES * TAILS)
        self.seen, self.unseen = np.zeros(CLASSES), np.zeros(CLASSES)   # log shares of a class's words
        self.plant(np.zeros(0, np.int64), np.zeros(0))

    def plant(self, cls: np.ndarray, mass: np.ndarray) -> None:
        """Set the trees of leaves with these classes and masses."""
        self.before, self.node, self.child, self.shares = trees(cls, mass)
        self.node_hash = wd.randoms(len(self.shares), 5)

    def tokens(self, h: np.ndarray, ending: np.ndarray, row: np.ndarray, rows: int):
        """(class, features, place in head or -1, row, leaf or -1) of every token; each row ends
        with one end token.  A row's first tokens have the start mark for what stands before.
        Features are 64-bit hashes, one array each."""
        n = len(h) + rows
        at = np.arange(len(h)) + row                                 # each earlier row adds an end
        ends = np.searchsorted(row, np.arange(rows), "right") + np.arange(rows)
        place = np.full(n, -1, dtype=np.int64)
        place[at] = self.find(h)
        place[ends] = self.find(np.array([END_HASH], dtype=np.uint64))[0]
        rank = self.rank[place]
        cls = np.zeros(n, dtype=np.int64)
        cls[at] = 1 + OWN + self.groups[ending]
        own = rank < OWN
        own[ends] = False
        cls[own] = 1 + rank[own]
        leaf = self.leaf[place]
        far = np.flatnonzero(place[at] < 0)
        leaf[at[far]] = self.tail[bucket(cls[at[far]], h[far])]
        value = np.where(place >= 0, _START + 1 + place, cls)
        of = np.zeros(n, dtype=np.int64)
        of[at], of[ends] = row, np.arange(rows)
        first = np.append(0, ends[:-1] + 1) if rows else np.zeros(0, dtype=np.int64)
        depth = np.arange(n) - first[of]
        feats = np.empty((4, n), dtype=np.uint64)
        for k in (1, 2, 3):
            back = np.full(n, _START, dtype=np.int64)
            back[k:] = value[:-k] if n > k else value[:0]
            back[depth < k] = _START
            feats[k - 1] = back * 4 + k
        feats[3] = feats[0] << np.uint64(32) | feats[1]
        return cls, wd.mix64(feats), place, of, leaf

    def rows(self, feats: np.ndarray) -> np.ndarray:
        """Rows of the class table: four a token."""
        return ((feats >> np.uint64(64 - self.bits)).astype(np.int64) + (np.arange(4) << self.bits)[:, None]).T

    def steps(self, feats: np.ndarray, leaf: np.ndarray):
        """(token, node, child, rows of the words' table by feature) of every step to a leaf."""
        at = np.flatnonzero(leaf >= 0)
        first = self.before[leaf[at]]
        n = self.before[leaf[at] + 1] - first
        token = np.repeat(at, n)
        step = np.arange(len(token)) + np.repeat(first - np.cumsum(n) + n, n)
        node = self.node[step]
        mixed = np.take(feats, token, axis=1)
        mixed ^= self.node_hash[node]
        mixed *= _ODD
        mixed >>= np.uint64(64 - self.bits - WORD_BITS)
        rows = mixed.view(np.int64)
        rows += (np.arange(4) << self.bits + WORD_BITS)[:, None]
        return token, node, self.child[step], rows

    def _scores(self, feats: np.ndarray) -> np.ndarray:
        """Unnormalised log probabilities of the classes (a view of this process's work space)."""
        z, more = _space("class", len(feats), CLASSES)
        np.take(self.w, feats[:, 0], axis=0, out=z, mode="clip")
        z += self.bias
        for k in (1, 2, 3):
            np.take(self.w, feats[:, k], axis=0, out=more, mode="clip")
            z += more
        np.clip(z, -80, 80, out=z)                                 # what exp takes safely
        return z

    def _node_scores(self, node: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Unnormalised log probabilities of the children of every step's node."""
        z, more = _space("words", len(node), WIDTH)
        np.take(self.shares, node, axis=0, out=z, mode="clip")
        for k in range(4):
            np.take(self.words, rows[k], axis=0, out=more, mode="clip")
            z += more
        np.clip(z, -80, 80, out=z)
        return z

    def log_classes(self, feats: np.ndarray) -> np.ndarray:
        z = self._scores(feats).copy()
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return z

    def log_class(self, feats: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Log probability of the given class of every token."""
        return _log_of(self._scores(self.rows(feats)), cls)

    def log_word(self, feats: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Log probability of every token's leaf among its class's; 0 without one."""
        token, node, child, rows = self.steps(feats, leaf)
        return np.bincount(token, _log_of(self._node_scores(node, rows), child), len(leaf))

    def learn(self, cls: np.ndarray, feats: np.ndarray, leaf: np.ndarray, past: np.ndarray, word_past: np.ndarray) -> None:
        """AdaGrad steps over the tokens in batches; ``past`` holds a sum of squares a row."""
        for s in range(0, len(cls), BATCH):
            f, c = feats[:, s:s + BATCH], cls[s:s + BATCH]
            rows = self.rows(f)
            err = _errors(self._scores(rows), c, len(c))
            _descend(self.w, past, rows.T, err)
            _, node, child, rows = self.steps(f, leaf[s:s + BATCH])
            if len(node):
                err = _errors(self._node_scores(node, rows), child, len(c))
                _descend(self.words, word_past, rows, err)


def bucket(cls: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The bucket of every word beyond the broadcast."""
    return cls * TAILS + (h & np.uint64(TAILS - 1)).astype(np.int64)


def _log_of(z: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Log probability of outcome ``to`` of every row of scores, which are overwritten."""
    own = z[np.arange(len(to)), to]
    np.exp(z, out=z)
    return own - np.log(np.einsum("ij->i", z))                     # alike wherever a row stands in its batch


def _errors(z: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """Probabilities less the outcome, by ``n``, in place of the scores."""
    np.exp(z, out=z)
    z /= (z @ np.ones(z.shape[1], np.float32) * np.float32(n))[:, None]
    z[np.arange(len(to)), to] -= np.float32(1 / n)
    return z


def _descend(w: np.ndarray, past: np.ndarray, rows: np.ndarray, err: np.ndarray) -> None:
    """An AdaGrad step of the rows of ``w`` (features by outcomes' errors).  Errors of a row are
    summed: most rows meet one step of a batch, the others' further errors are added to it."""
    n, width = err.shape
    for row in rows:
        at = np.sort(row << 20 | np.arange(n))                     # a batch has fewer steps than 2^20
        order = at & ((1 << 20) - 1)
        at >>= 20
        new = np.append(True, at[1:] != at[:-1])
        touched = at[new]
        g, now = _space("sums", len(touched), width)
        np.take(err, order[new], axis=0, out=g, mode="clip")
        more = np.flatnonzero(~new)
        if len(more):
            of = np.cumsum(new)[more] - 1
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            g[of[first]] += np.add.reduceat(np.take(err, order[more], axis=0, mode="clip"), first, axis=0)
        q = np.einsum("ij,ij->i", g, g)
        q *= np.float32(1 / width)
        q += past[touched]
        past[touched] = q
        q += np.float32(1e-7)
        g *= (np.float32(RATE) / np.sqrt(q, out=q))[:, None]
        np.take(w, touched, axis=0, out=now, mode="clip")
        now -= g
        w[touched] = now


_work: dict[tuple[str, int], list[np.ndarray]] = {}


def _space(name: str, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrays of this process that hold ``n`` rows (fresh memory for each batch costs more than
    what is computed in it)."""
    if (name, width) not in _work or n > len(_work[name, width][0]):
        _work[name, width] = [np.empty((max(n + n // 4, BATCH), width), np.float32) for _ in range(2)]
    a, b = _work[name, width]
    return a[:n], b[:n]


def _pack(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows as bytes and a scale each: exact to 1/254 of the row's largest value."""
    scale = np.maximum(np.abs(x).max(axis=1, initial=0), 1e-30).astype(np.float32) / np.float32(127)
    return np.rint(x / scale[:, None]).astype(np.int8), scale


def _unpack(bytes_: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return bytes_ * scale[:, None]


def _packed(model: Model) -> Model:
    """A copy with packed weights, to be sent."""
    m = copy.copy(model)
    m.w, m.words = _pack(model.w), _pack(model.words)
    return m


def _train_round(part: DataFrame, text_col: str, send) -> DataFrame:
    """(which table, block, rows, change): the changes of a round from the model of broadcast
    ``send``, averaged by row over the tasks that made one.  Rows and changes are bytes of arrays,
    a block of a table each."""
    sent, schema = "which int, block int, rows binary, change binary, scale binary", "which int, block int, rows binary, change binary"

    def batch(which, block, *arrays):
        return pa.RecordBatch.from_arrays(
            [pa.array([which], pa.int32()), pa.array([block], pa.int32()), *(pa.array([x.tobytes()]) for x in arrays)],
            names=["which", "block", "rows", "change", "scale"][:2 + len(arrays)])

    def run(batches):
        m = copy.copy(send.value)
        start = m.w, m.words
        m.w, m.words = (_unpack(*x) for x in start)
        past = [np.zeros(len(x), np.float32) for x in (m.w, m.words)]
        for b in batches:
            for _, rows, h, ending, row in texts(b.column(0)):
                cls, feats, _, _, leaf = m.tokens(h, ending, row, rows)
                m.learn(cls, feats, leaf, *past)
        for which, ((was, scale), now, squares) in enumerate(zip(start, (m.w, m.words), past)):
            size = _BLOCK // now.shape[1]
            for lo in range(0, len(now), size):
                rows = np.flatnonzero(squares[lo:lo + size])
                if len(rows):
                    change = now[lo + rows] - _unpack(was[lo + rows], scale[lo + rows])
                    yield batch(which, lo // size, rows.astype(np.uint16), *_pack(change))

    def average(batches):
        sums = {}
        for b in batches:
            for i in range(b.num_rows):
                which, block = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                width = WIDTHS[which]
                if (which, block) not in sums:
                    sums[which, block] = np.zeros((_BLOCK // width, width), np.float32), np.zeros(_BLOCK // width, np.int64)
                total, times = sums[which, block]
                rows, change, scale = (np.frombuffer(b.column(2 + k)[i].as_buffer(), t)
                                       for k, t in enumerate((np.uint16, np.int8, np.float32)))
                total[rows] += _unpack(change.reshape(-1, width), scale)
                times[rows] += 1
        for (which, block), (total, times) in sums.items():
            rows = np.flatnonzero(times)
            yield batch(which, block, rows.astype(np.uint16), (total[rows] / times[rows][:, None]).astype(np.float16))
    return part.select(text_col).mapInArrow(run, sent).repartition("which", "block").mapInArrow(average, schema)


def fit(train: DataFrame, text_col: str = "text", rounds: int = ROUNDS, seed_col: str | None = None) -> tuple[Model, DataFrame, DataFrame, int, int]:
    """(model, words, words beyond the broadcast, tokens, types) of the texts; words are (key, ending, n)."""
    spark = train.sparkSession
    both = table(counts(train, text_col))
    words = both.where("kind = 0").select("key", "ending", "n")
    whole = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, types = int(whole[0] or 0), int(whole[1])
    pairs = np.zeros(ENDINGS * CONTEXT)
    cells = both.where("kind = 1").select("key", "n").toArrow()           # at most ENDINGS * CONTEXT
    pairs[cells.column(0).to_numpy()] = cells.column(1).to_numpy()
    groups = group_endings(pairs.reshape(ENDINGS, CONTEXT))
    # the least count whose words still fit the broadcast
    step = F.floor(16 * F.log2(F.col("n").cast("double")))
    bins = sorted(((int(r[0]), r[1]) for r in words.groupBy(step).count().collect()), reverse=True)
    fits, least = 0, 1 << 20
    for b, n in bins:
        if fits + n > HEAD:
            break
        fits, least = fits + n, b
    near = (step >= least) | (F.col("ending") < 0)                        # the end of a text always
    head, tail = words.where(near).toArrow(), words.where(~near)
    keys, n, ending = (head.column(c).to_numpy() for c in ("key", "n", "ending"))
    keys = keys.view(np.uint64)
    order = np.argsort(keys)
    keys, n, ending = keys[order], n[order], ending[order]
    is_end = ending < 0
    rank = np.full(len(keys), 2 * HEAD + len(keys), dtype=np.int64)
    by_count = np.lexsort((keys, -n))
    by_count = by_count[~is_end[by_count]]
    rank[by_count] = np.arange(len(by_count))
    model = Model(keys, n, rank, groups, min(max(total.bit_length() - 7, LEAST_BITS), MOST_BITS))
    # tokens and types of every class
    per = words.where("ending >= 0").groupBy("ending").agg(F.sum("n"), F.count(F.lit(1))).toArrow()   # ENDINGS rows
    of_ending = 1 + OWN + groups[per.column(0).to_numpy()]
    size = np.bincount(of_ending, per.column(1).to_numpy().astype(float), CLASSES)
    kinds = np.bincount(of_ending, per.column(2).to_numpy().astype(float), CLASSES)
    cls = np.where(is_end, 0, 1 + OWN + groups[np.maximum(ending, 0)])
    own = by_count[:OWN]
    np.subtract.at(size, cls[own], n[own])
    np.subtract.at(kinds, cls[own], 1)
    cls[own] = 1 + np.arange(len(own))
    # an unseen word has one token's share of its class, (tokens + types + 1); the seen the rest
    model.unseen = -np.log(size + kinds + 1)
    model.seen = np.log(np.maximum(size + kinds, 1)) + model.unseen
    size[cls[own]] = n[own]
    size[0] = n[is_end].sum()
    model.bias = np.log((size + 1) / (size + 1).sum()).astype(np.float32)
    # leaves: words of the broadcast, and buckets of the others
    classes = spark.createDataFrame([(e, int(1 + OWN + g)) for e, g in enumerate(groups)], "ending int, cls int")
    far = (tail.join(F.broadcast(classes), "ending")
               .groupBy("cls", F.col("key").bitwiseAND(F.lit(TAILS - 1)).cast("int").alias("b"))
               .agg(F.sum(F.col("n") + 1).alias("mass")).toArrow())       # at most CLASSES * TAILS
    cells = far.column(0).to_numpy() * TAILS + far.column(1).to_numpy()
    model.tail_mass[cells] = far.column(2).to_numpy()
    cells = np.sort(cells)
    inside = np.flatnonzero(cls > OWN)
    model.leaf[inside] = np.arange(len(inside))
    model.tail[cells] = len(inside) + np.arange(len(cells))
    model.plant(np.append(cls[inside], cells // TAILS), np.append(n[inside] + 1.0, model.tail_mass[cells]))
    # a task learns from a few million tokens, so that what the tasks send follows the text
    share = total / max(rounds, 1)
    tasks = max(1, -int(-share // MOST_TOKENS), min(spark.sparkContext.defaultParallelism, int(share // LEAST_TOKENS)))
    for r in range(rounds):
        part = train.where(F.pmod(F.xxhash64(seed_col or text_col, F.lit(5)), F.lit(rounds)) == r)
        send = spark.sparkContext.broadcast(_packed(model))
        t = _train_round(part.coalesce(tasks), text_col, send).toArrow()          # at most both tables
        send.destroy()
        for which, block, rows, change in zip(*(t.column(i).to_pylist() for i in range(4))):
            weights = (model.w, model.words)[which]
            at = block * (_BLOCK // WIDTHS[which]) + np.frombuffer(rows, np.uint16).astype(np.int64)
            weights[at] += np.frombuffer(change, np.float16).reshape(-1, WIDTHS[which])
    return model, words, tail, total, types


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2,
          rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    Rows whose crc32 of the id is ``held`` modulo ``folds`` are scored but not learned from (null
    ids are learned from).  Null texts are empty: one end token.  Repeated rows are learned
    from each and get equal scores.  Without training rows every class is equally likely.
    An empty table gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    crc = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
    model, words, tail, total, types = fit(docs.where(crc != held), text_col, rounds, id_col)
    send = spark.sparkContext.broadcast(_packed(model))

    def run(batches):
        model = copy.copy(send.value)
        model.w, model.words = _unpack(*model.w), _unpack(*model.words)
        for b in batches:
            cols = [[] for _ in range(4)]
            rare, rare_n, rare_p, cuts = [], [], [], [0]
            for _, rows, h, ending, row in texts(b.column(1)):
                cls, feats, place, of, leaf = model.tokens(h, ending, row, rows)
                logp, inside = np.empty(len(cls)), np.empty(len(cls))
                for s in range(0, len(cls), BATCH):
                    logp[s:s + BATCH] = model.log_class(feats[:, s:s + BATCH], cls[s:s + BATCH])
                    inside[s:s + BATCH] = model.log_word(feats[:, s:s + BATCH], leaf[s:s + BATCH])
                known = place >= 0
                seen = np.log10(np.where(known, model.head_n[np.maximum(place, 0)] if len(model.head_n) else 0, 0) + 1.0)
                # words beyond the broadcast count as unseen until they meet their counts
                logp += np.where(known, np.where(leaf >= 0, inside + model.seen[cls], 0), model.unseen[cls])
                sums = [np.bincount(of, weights=x, minlength=rows) for x in (known, seen, logp / np.log(10))]
                cols[0].append(np.bincount(of, minlength=rows))
                for c, x in zip(cols[1:], sums):
                    c.append(x)
                at = np.arange(len(h)) + row
                far = np.flatnonzero(~known[at])
                far_h, far_row, at = h[far], row[far], at[far]
                mass = model.tail_mass[bucket(cls[at], far_h)]
                instead = np.where(mass > 0, inside[at] + model.seen[cls[at]] - np.log(np.maximum(mass, 1)) - model.unseen[cls[at]], 0)
                order = np.lexsort((far_h, far_row))
                far_h, far_row = far_h[order], far_row[order]
                new = np.flatnonzero(np.append(True, (far_h[1:] != far_h[:-1]) | (far_row[1:] != far_row[:-1]))[:len(far_h)])
                rare.append(far_h[new].view(np.int64))
                rare_n.append(np.diff(np.append(new, len(far_h))))
                rare_p.append(np.add.reduceat(instead[order] / np.log(10), new) if len(new) else np.zeros(0))
                cuts.extend((cuts[-1] + np.searchsorted(far_row[new], np.arange(rows), "right")).tolist())
            flat = [np.concatenate(c) if c else np.zeros(0) for c in cols]
            ends = pa.array(np.array(cuts, dtype=np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(t) if x else np.zeros(0, t)))
                     for x, t in ((rare, np.int64), (rare_n, np.int32), (rare_p, float))]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2), pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int64)),
                pa.array(flat[2].astype(float)), pa.array(flat[3].astype(float)), *lists],
                names=["doc_id", "t", "n_tokens", "near", "seen", "logp", "rare", "rare_n", "rare_p"])
    scored = table(docs.select(id_col, text_col, F.xxhash64(text_col).alias("t")).mapInArrow(
        run, f"doc_id {kind}, t long, n_tokens long, near long, seen double, logp double, "
             "rare array<long>, rare_n array<int>, rare_p array<double>"))
    send.destroy()
    # rare words meet their counts; rows equal in id and text share their sum
    key = [F.xxhash64("doc_id").alias("k"), "t"]
    far = scored.select(*key, F.explode(F.arrays_zip("rare", "rare_n", "rare_p")).alias("r")).select(
        "k", "t", F.col("r.rare").alias("key"), F.col("r.rare_n").alias("m"), F.col("r.rare_p").alias("p"))
    got = (far.join(tail.select("key", "n"), "key").groupBy("k", "t")
              .agg(F.sum("m").alias("far"), F.sum(F.col("m") * F.log10(F.col("n") + F.lit(1.0))).alias("far_seen"),
                   F.sum("p").alias("far_logp")))
    copies = scored.select(*key).groupBy("k", "t").count().withColumnRenamed("count", "copies")
    got = copies.join(got, ["k", "t"], "left").select(
        "k", "t", (F.coalesce("far", F.lit(0)) / F.col("copies")).cast("long").alias("far"),
        *[(F.coalesce(c, F.lit(0.0)) / F.col("copies")).alias(c) for c in ("far_seen", "far_logp")])
    out = scored.select("doc_id", "n_tokens", "near", "seen", "logp", *key).join(got, ["k", "t"])
    unit = float(np.log10(total + types + 1))
    crc_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds))
    return out.select(
        "doc_id", (crc_out == held).alias("held_out"), "n_tokens", (F.col("near") + F.col("far")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("seen") + F.col("far_seen") - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("logp") + F.col("far_seen") + F.col("far_logp")).alias("score"))
