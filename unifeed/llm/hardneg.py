"""Operator 11: hard negatives by rotated one-bit codes with exact bounds.

Index (every row, written once): the vector is rotated by a fixed random orthogonal matrix
and coded by the signs of its components, one bit each, with the stored *alignment* of code
and vector (their inner product over the dimension, which is the best multiple of the code).
What the code leaves over is coded again the same way, ``LEVELS`` times; the norm of the last
residual is stored.

Search: the anchors (a stated query set) are laid out in blocks of bounded size; each block is
sent to all tasks and the index is scanned twice per block, once for the positives, once for
the negatives around each positive's score.  An anchor is cut into ``PLANES`` bit planes; its
inner product with a row is estimated from popcounts of code and plane, and by Cauchy-Schwarz
the truth lies within ``|e||w| + |q||r|`` of the estimate (q: anchor, e: what its planes leave
over, w: what the codes say of the row, r: the row's residual).  The bound is deterministic, so
only rows whose interval reaches what is still wanted are scored, in integers, and nothing is
lost.  A task keeps the best few rows per anchor (and positive); these meet by anchor.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .shared import table

SCALE, TOP, LOW, HIGH = 256, 5, 80, 100
LEVELS, PLANES = 4, 6
BLOCK_BYTES = 16 << 20
_ANCHORS, _ROWS = 64, 2048               # compared at a time
_PAIRS = 1 << 22                         # components gathered at a time
_NONE = np.iinfo(np.int64).min
_INDEX = "id long, label long, ints binary, code binary, align binary, coded double, rest double"


def rotation(dims: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(11).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits packed into 64-bit words, short rows filled with zeros."""
    n, dims = bits.shape
    full = np.zeros((n, -(-dims // 64) * 64), dtype=np.uint8)
    full[:, :dims] = bits
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64)


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes n x LEVELS x words, alignments n x LEVELS, norm of the coded part, norm of the rest)."""
    rest = x @ turn
    whole = rest.copy()
    codes, align = [], []
    for _ in range(LEVELS):
        sign = rest > 0
        step = np.abs(rest).mean(axis=1)             # inner product of the signs and the rest, by dimension
        codes.append(_words(sign))
        align.append(step)
        rest = rest - np.where(sign, step[:, None], -step[:, None])
    return (np.stack(codes, axis=1), np.stack(align, axis=1), np.linalg.norm(whole - rest, axis=1),
            np.linalg.norm(rest, axis=1))


def limit(dims: int) -> int:
    """Components beyond this saturate, so that an inner product fits a long."""
    return (1 << ((62 - max(1, dims - 1).bit_length()) // 2)) - 1


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """floor(256 x) of every vector, n x dims; shorter vectors are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(sizes), dims))
    out[np.arange(dims) < sizes[:, None]] = np.clip(flat, -limit(dims), limit(dims))
    return out.astype(np.int64)


def _packed(rows: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(rows.reshape(len(rows), -1))
    return pa.array([r.tobytes() for r in raw], pa.binary())


def _unpacked(column, dtype, *shape) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(-1, *shape)


def index(rows: DataFrame, dims: int) -> DataFrame:
    """The coded table of (id, label, vector) rows."""
    turn = rows.sparkSession.sparkContext.broadcast(rotation(dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ints = integers(b.column(2), dims)
            codes, align, coded, rest = encode(ints.astype(np.float64), turn.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), _packed(ints.astype(np.int32)), _packed(codes), _packed(align),
                 pa.array(coded), pa.array(rest)], names=["id", "label", "ints", "code", "align", "coded", "rest"])
    return table(rows.mapInArrow(run, _INDEX))


class Rows:
    """A batch of the index as arrays."""

    def __init__(self, b, dims: int):
        get = lambda name: b.column(b.schema.get_field_index(name))
        self.id, self.label = get("id").to_numpy(), get("label").to_numpy()
        self.ints = _unpacked(get("ints"), np.int32, dims).astype(np.int64)
        self.code = _unpacked(get("code"), np.uint64, LEVELS, -(-dims // 64))
        self.align = _unpacked(get("align"), np.float64, LEVELS)
        self.coded, self.rest = get("coded").to_numpy(), get("rest").to_numpy()
        self.ones = np.bitwise_count(self.code).sum(axis=2, dtype=np.int64)


class Anchors:
    """A bounded block of anchors with their bit planes and, once known, their positives."""

    def __init__(self, id_: np.ndarray, label: np.ndarray, ints: np.ndarray, turn: np.ndarray):
        self.id, self.label, self.ints, self.dims = id_, label, ints, ints.shape[1]
        q = ints.astype(np.float64) @ turn
        self.norm, top = np.linalg.norm(q, axis=1), 2 ** PLANES - 1
        self.low = q.min(axis=1)
        self.unit = np.maximum((q.max(axis=1) - self.low) / top, 1e-12)
        u = np.clip(np.rint((q - self.low[:, None]) / self.unit[:, None]), 0, top).astype(np.int64)
        self.sum = u.sum(axis=1)
        self.off = np.linalg.norm(q - (self.low[:, None] + u * self.unit[:, None]), axis=1)
        self.planes = np.stack([_words((u >> j) & 1) for j in range(PLANES)], axis=1)
        self.positive = np.zeros((len(id_), TOP), dtype=np.int64)
        self.score = np.full((len(id_), TOP), _NONE)

    def interval(self, a: slice, rows: Rows, b: slice) -> tuple[np.ndarray, np.ndarray]:
        """(estimate, half width) of the inner products of anchors ``a`` and rows ``b``."""
        est = np.zeros((len(self.id[a]), len(rows.id[b])))
        for level in range(LEVELS):
            common = np.zeros(est.shape, dtype=np.int64)
            for j in range(PLANES):
                for w in range(self.planes.shape[2]):
                    both = self.planes[a, j, w][:, None] & rows.code[b, level, w][None, :]
                    common += np.bitwise_count(both).astype(np.int64) << j
            signs = 2 * rows.ones[b, level] - self.dims
            dot = self.low[a, None] * signs + self.unit[a, None] * (2 * common - self.sum[a, None])
            est += rows.align[b, level] * dot
        size = self.norm[a, None] * (rows.coded[b] + rows.rest[b])
        return est, self.off[a, None] * rows.coded[b] + self.norm[a, None] * rows.rest[b] + 1e-9 * size + 1e-6

    def products(self, a: np.ndarray, rows: Rows, b: np.ndarray) -> np.ndarray:
        """Integer inner products of pairs."""
        step = max(1, _PAIRS // max(1, self.dims))
        return np.concatenate([np.zeros(0, np.int64)] + [
            np.einsum("ij,ij->i", self.ints[a[i:i + step]], rows.ints[b[i:i + step]]) for i in range(0, len(a), step)])


class Best:
    """The first ``TOP`` (score, id) of every key: higher scores first, ties by smaller id."""

    def __init__(self, keys: int):
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(keys, _NONE)            # the last score that counts, once there are enough

    def add(self, key: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(key):
            return
        key, score, id_ = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, key))
        key, score, id_ = key[order], score[order], id_[order]
        new = np.ones(len(key), dtype=bool)          # rows alike in id and score count once
        new[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (id_[1:] != id_[:-1])
        key, score, id_ = key[new], score[new], id_[new]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        keep = rank < TOP
        self.key, self.score, self.id = key[keep], score[keep], id_[keep]
        full = rank == TOP - 1
        self.least[key[full]] = score[full]


def _pieces(n: int, step: int) -> list[slice]:
    return [slice(i, min(i + step, n)) for i in range(0, n, step)]


def _positives(block: Anchors, rows: Rows, best: Best) -> None:
    """Rows of the anchor's label, with another id, that may be among its first."""
    for b in _pieces(len(rows.id), _ROWS):
        for a in _pieces(len(block.id), _ANCHORS):
            mate = (block.label[a, None] == rows.label[b]) & (block.id[a, None] != rows.id[b])
            est, width = block.interval(a, rows, b)
            i, j = np.nonzero(mate & (est + width >= best.least[a, None]))
            i, j = i + a.start, j + b.start
            score = block.products(i, rows, j)
            good = score >= best.least[i]
            best.add(i[good], score[good], rows.id[j[good]])


def _negatives(block: Anchors, rows: Rows, best: Best) -> None:
    """Rows of another label whose score may lie from LOW to HIGH percent of a positive's."""
    floor = np.where(block.score == _NONE, np.inf, block.score * (LOW / HIGH) - 1e-6)
    for b in _pieces(len(rows.id), _ROWS):
        for a in _pieces(len(block.id), _ANCHORS):
            other = block.label[a, None] != rows.label[b]
            est, width = block.interval(a, rows, b)
            wanted = np.zeros(est.shape, dtype=bool)
            least = best.least.reshape(-1, TOP)
            for slot in range(TOP):
                low = np.maximum(floor[a, slot], least[a, slot])[:, None]
                wanted |= (est + width >= low) & (est - width <= block.score[a, slot, None])
            i, j = np.nonzero(other & wanted)
            i, j = i + a.start, j + b.start
            score = block.products(i, rows, j)
            for slot in range(TOP):
                top = block.score[i, slot]
                good = (top != _NONE) & (score <= top) & (HIGH * score >= LOW * np.where(top == _NONE, 0, top))
                key = i[good] * TOP + slot
                best.add(key, score[good], rows.id[j[good]])


def _search(coded: DataFrame, send, find, keys: int, dims: int) -> DataFrame:
    """(key, rank, id, score): the first rows of every key that ``find`` meets in the index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = send.value, Best(len(send.value.id) * keys)
        for b in batches:
            if b.num_rows:
                find(block, Rows(b, dims), best)
        yield pa.RecordBatch.from_arrays([pa.array(best.key), pa.array(best.id), pa.array(best.score)],
                                         names=["key", "id", "score"])
    order = W.partitionBy("key").orderBy(F.desc("score"), "id")
    found = coded.mapInArrow(run, "key long, id long, score long")
    return (found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= TOP)
                 .dropDuplicates(["key", "rank"]))


def mine(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         every: int = 100, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``.  A row's score is the inner product
    of its integer components floor(256 x) with the anchor's; higher scores come first, ties by
    smaller id.  Positives: an anchor's first five rows of its label with another id.  For each,
    the first five rows of other labels with ``LOW`` to ``HIGH`` percent of its score.

    Rows with a null id, label, vector or component, or one that is not finite, take no part.
    Shorter vectors count as filled with zeros; components beyond ``limit(dims)`` (2^28 at 64
    dimensions) saturate.  Rows alike in id and score count once; anchors alike in id, label
    and vector are one, other anchors of the same id each have their own result.  Two positives
    of one id have their own lists.  An anchor without positives, or a positive without such
    negatives, gives no row; an empty table gives an empty result; other columns are ignored."""
    spark = vectors.sparkSession
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).alias("v"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(F.forall("v", ok))
    dims, n = rows.agg(F.max(F.size("v")), F.count(F.when(F.col("id") % every == 0, 1))).first()
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not n:
        return spark.createDataFrame([], schema)
    dims = max(1, dims)
    coded, turn = index(rows, dims), rotation(dims)
    anchors = table(coded.where(F.col("id") % every == 0).select("id", "label", "ints").dropDuplicates())
    blocks = max(1, math.ceil(n * (12 * dims + 64) / block_bytes))
    done = []
    for k in range(blocks):
        t = anchors.where(F.pmod(F.xxhash64("id", "ints"), F.lit(blocks)) == k).toArrow()    # about block_bytes
        if not t.num_rows:
            continue
        block = Anchors(t.column(0).to_numpy(), t.column(1).to_numpy(),
                        _unpacked(t.column(2), np.int32, dims).astype(np.int64), turn)
        send = spark.sparkContext.broadcast(block)
        for r in _search(coded, send, _positives, 1, dims).toLocalIterator():                # five per anchor
            block.positive[r.key, r["rank"] - 1], block.score[r.key, r["rank"] - 1] = r.id, r.score
        send.unpersist()
        send = spark.sparkContext.broadcast(block)
        found = _search(coded, send, _negatives, TOP, dims)

        def name(batches: Iterator[pa.RecordBatch], send=send) -> Iterator[pa.RecordBatch]:
            block = send.value
            for b in batches:
                key = b.column(0).to_numpy()
                a, slot = key // TOP, key % TOP
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.id[a]), pa.array(block.positive[a, slot]), b.column(3).cast(pa.int32()), b.column(1),
                     pa.array(block.score[a, slot]), b.column(2)],
                    names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])
        done.append(table(found.select("key", "id", "score", "rank").mapInArrow(name, schema)))
        send.unpersist()
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out
