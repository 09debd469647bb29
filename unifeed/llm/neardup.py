"""Operator 9: MinHash near-dedup by a signature-coordinate inverted join.

1. One pass over the texts gives each document its set of distinct k-word shingles and a
   MinHash signature.  Documents with equal sets form a class; only classes go on, so a
   group of exact copies of any size is one row.
2. Every class is posted under each (coordinate, value).  Values seen once cannot collide
   and go.  Two classes that agree in ``match`` of ``coords`` values must share one of their
   ``m - match + 1`` rarest remaining values (prefix filter): only those lists are merged, the
   long lists of common values are skipped.
3. Lists are not expanded into pairs.  In each round every member outside the largest
   component of a list is paired with one pivot from it; pairs with enough collisions are
   confirmed on the full sets and joined into components.  Members of one list that are
   still in different components then meet block by block inside tasks, by signature and,
   where a partner was seen, by full set; these give out members and links only.  So each
   pair that could change the result is tested, while a list of n copies of one thing
   costs n pairs.

With 96 coordinates and 52 matches a pair at similarity 0.75 is missed with probability
2.9e-6 (binomial tail up to 51); anything found is confirmed exactly.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .graph import components
from .shared import table
from .words import chunks, mix64, randoms, shingles, split, word_hashes

COORDS, MATCH, SHINGLE, SIMILARITY = 96, 52, 5, 75
ROUNDS, TRIES = 3, 4    # rounds and pivots per member before the remaining pairs are met
SIG_BLOCK, BLOCK = 1024, 512    # rows of a block in which remaining pairs meet by signature, by set
BUCKETS = 1 << 19


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for lo, hi, data, offsets in chunks(column):
        start, end, row = split(data, offsets)
        h, r = shingles(word_hashes(data, start, end), row, k)
        cut = np.searchsorted(r, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            yield np.unique(h[cut[i]:cut[i + 1]])


def _signature(s: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(s), 512):
        low = np.minimum(low, ((s[i:i + 512, None] * factors) >> np.uint64(32)).min(axis=0))
    return low.astype(np.uint32).view(np.int32)


def _identity(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits that name a set."""
    if not len(s):
        return np.uint64(0), np.uint64(0)
    return mix64(s).sum(dtype=np.uint64), mix64(s + np.uint64(0x9E37)).sum(dtype=np.uint64)


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int, coords: int) -> DataFrame:
    """(doc_id, n_shingles, c, c2, sig) per row: size, 128-bit identity and signature of its set."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        factors = randoms(coords, 23) | np.uint64(1)
        for b in batches:
            n, c, c2, sig = [], [], [], []
            for s in _sets(b.column(1), k):
                one, two = _identity(s)
                n.append(len(s))
                c.append(one)
                c2.append(two)
                sig.append(_signature(s, factors) if len(s) else np.zeros(0, np.int32))
            ends = np.cumsum([0] + [len(x) for x in sig]).astype(np.int32)
            flat = np.concatenate(sig) if sig else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(np.array(n, dtype=np.int64)),
                pa.array(np.array(c, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(c2, dtype=np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "n_shingles", "c", "c2", "sig"])
    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, c long, c2 long, sig array<int>")


def full_sets(docs: DataFrame, text_col: str, k: int) -> DataFrame:
    """(node, shingles) for rows (node, c, text); rows whose set is not the one named ``c``
    (another text under a repeated id) go."""
    def run(batches):
        for b in batches:
            node, sets = [], []
            for n, c, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _sets(b.column(2), k)):
                if int(_identity(s)[0].view(np.int64)) == c:
                    node.append(n)
                    sets.append(s)
            ends = np.cumsum([0] + [len(x) for x in sets]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["node", "shingles"])
    return docs.select("node", "c", text_col).mapInArrow(run, "node long, shingles array<long>")


def _sets_of(nodes: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(node, shingles) of some classes, from the texts of their first documents: a bounded
    broadcast of hash buckets thins the scan, an exact join follows."""
    wanted = table(classes.select("node", F.col("doc_id").alias("w_id"), "c", "c2").join(nodes, "node", "left_semi"))
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS))
    hits = wanted.select(bucket(F.col("w_id")).alias("bucket")).distinct()   # at most BUCKETS rows
    texts = (docs.select(F.col(id_col).alias("t_id"), text_col)
                 .join(F.broadcast(hits), bucket(F.col("t_id")) == F.col("bucket"), "left_semi")
                 .join(wanted, F.col("t_id").eqNullSafe(F.col("w_id"))).select("node", "c", text_col))
    return table(full_sets(texts, text_col, k).dropDuplicates(["node"]))


def _cross_links(left: list, right: list, match: int, percent: int) -> list[tuple[int, int]]:
    """Linked pairs between two bounded blocks of (node, comp, sig, shingles)."""
    sig = np.stack([r[2] for r in right])
    comp, size = np.array([r[1] for r in right]), np.array([len(r[3]) for r in right])
    out = []
    for node, own, mine, a in left:
        near = ((sig == mine).sum(1) >= match) & (comp != own)
        near &= 100 * np.minimum(size, len(a)) >= percent * np.maximum(size, len(a))
        for x in np.flatnonzero(near):
            b = right[x][3]
            common = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
            if 100 * common >= percent * (len(a) + len(b) - common):
                out.append((node, right[x][0]))
    return out


def _torn_groups(posted: DataFrame) -> DataFrame | None:
    """(kind, grp, node, comp, outer): groups of members that may still link, None if there are none.

    Lists that are still in more than one component and share members form a family.  A family
    meets as one group (kind 0), or list by list (kind 1) where that sends fewer rows to blocks:
    families of more than a block whose lists chain up without having much in common.  ``outer``
    members are those outside the group's largest component: two members of different components
    are never both inside."""
    torn = (posted.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.min("node").alias("a"))
                  .where("x <> y").select("key", "a"))
    lists = table(posted.join(torn, "key").select("key", "a", "node", "comp"))
    spread = table(lists.where("node <> a").select("a", F.col("node").alias("b")).distinct())
    if spread.isEmpty():
        return None
    family = components(spread).select("node", F.col("label").alias("family"))
    lists = table(lists.join(family, "node").select("family", "key", "node", "comp"))
    families = lists.select("family", "node", "comp").distinct()

    def largest(rows: DataFrame, by: list[str]) -> DataFrame:
        per = rows.groupBy(*by, "comp").count().groupBy(*by).agg(
            F.max(F.struct("count", "comp")).alias("most"), F.sum("count").alias("n"))
        n, m = F.col("n").cast("double"), (F.col("n") - F.col("most.count")).cast("double")
        return per.select(*by, F.col("most.comp").alias("top"),
                          (n * F.ceil(m / SIG_BLOCK) + m * F.ceil(n / SIG_BLOCK)).alias("sent"))
    of_list = table(largest(lists, ["family", "key"]))
    listwise = of_list.groupBy("family").agg(F.sum("sent").alias("by_list"))
    of_family = table(largest(families, ["family"]).join(listwise, "family"))
    single = of_list.join(of_family.where("by_list < sent").select("family"), "family", "left_semi")
    outer = (F.col("comp") != F.col("top")).alias("outer")
    whole = (families.join(of_family.where("by_list >= sent").select("family", "top"), "family")
                     .select(F.lit(0).alias("kind"), F.col("family").alias("grp"), "node", "comp", outer))
    parts = (lists.join(single, ["family", "key"])
                  .select(F.lit(1).alias("kind"), F.col("key").alias("grp"), "node", "comp", outer))
    return table(whole.unionByName(parts))


def _dealt(left: DataFrame, right: DataFrame, by: list[str], size: int) -> DataFrame:
    """Both sides of each group dealt to blocks of about ``size`` rows; (i, j) holds block i of the
    left side (``side`` 0) and block j of the right (1), so each pair meets in one place."""
    blocks = lambda rows, name: rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    grid = blocks(left, "n_i").join(blocks(right, "n_j"), by)
    deal = lambda n: F.pmod(F.xxhash64("node", *by), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(grid, by).withColumn("i", deal("n_i")).withColumn("j", every("n_j")).withColumn("side", F.lit(0))
    b = right.join(grid, by).withColumn("j", deal("n_j")).withColumn("i", every("n_i")).withColumn("side", F.lit(1))
    return a.unionByName(b).drop("n_i", "n_j")


def _candidates(groups: DataFrame, classes: DataFrame, match: int, percent: int) -> DataFrame:
    """(kind, grp, bi, bj, side, node, comp): members of a pair of signature blocks with a partner in
    the other block that collides in ``match`` coordinates, is of another component and of a size
    that allows the similarity.  Only signatures are sent, and members come out, not pairs."""
    rows = table(groups.join(classes.select("node", "sig", F.col("n_shingles").alias("n")), "node"))
    by = ["kind", "grp"]

    def meet(key, pdf):
        import pandas as pd
        side, node, comp, n = (pdf[c].to_numpy() for c in ("side", "node", "comp", "n"))
        sig = np.stack(pdf["sig"].to_list())
        l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        right, has = sig[r], np.zeros(len(pdf), dtype=bool)
        for x in l:
            near = ((right == sig[x]).sum(1) >= match) & (comp[r] != comp[x])
            near &= 100 * np.minimum(n[r], n[x]) >= percent * np.maximum(n[r], n[x])
            has[x] = near.any()
            has[r] |= near
        out = pd.DataFrame({"side": side[has], "node": node[has], "comp": comp[has]})
        return out.assign(**{c: np.full(len(out), v, np.int64) for c, v in zip(("kind", "grp", "bi", "bj"), key)})
    return table(_dealt(rows.where("outer"), rows, by, SIG_BLOCK).drop("outer").groupBy(*by, "i", "j").applyInPandas(
        meet, "kind int, grp long, bi int, bj int, side int, node long, comp long"))


def _rest_links(posted: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int,
                match: int, percent: int) -> DataFrame | None:
    """Links between members of one list that are still in different components.

    Outer members of each torn group meet all its members, block by block: first by signature
    (``SIG_BLOCK`` rows a side), then, only those with a partner in the same pair of blocks, by
    full set (``BLOCK`` rows a side).  Pairs are compared in place and only links come out; no
    task holds more than two blocks."""
    groups = _torn_groups(posted)
    if groups is None:
        return None
    some = _candidates(groups, classes, match, percent)
    if some.isEmpty():
        return None
    sets = _sets_of(some.select("node").distinct(), classes, docs, id_col, text_col, k)
    rows = table(some.join(classes.select("node", "sig"), "node").join(sets, "node"))
    by = ["kind", "grp", "bi", "bj"]
    dealt = _dealt(rows.where("side = 0").drop("side"), rows.where("side = 1").drop("side"), by, BLOCK)

    def meet(pdf):
        import pandas as pd
        sides = ([], [])
        for side, node, comp, sig, s in zip(pdf["side"], pdf["node"], pdf["comp"], pdf["sig"], pdf["shingles"]):
            sides[side].append((node, comp, np.asarray(sig), np.asarray(s, dtype=np.int64).view(np.uint64)))
        links = _cross_links(*sides, match, percent) if sides[0] and sides[1] else []
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")
    return table(dealt.groupBy(*by, "i", "j").applyInPandas(meet, "a long, b long"))


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str,
             k: int, match: int, percent: int) -> DataFrame:
    """The (a, b) among ``pairs`` that collide in ``match`` coordinates and whose full sets
    are similar enough."""
    sig = classes.select("node", "sig", "n_shingles")
    left = sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"), F.col("n_shingles").alias("n_a"))
    right = sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"), F.col("n_shingles").alias("n_b"))
    same = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    near = table(pairs.join(left, "a").join(right, "b")
                 .where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (same >= match))
                 .select("a", "b"))
    nodes = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    sets = _sets_of(nodes, classes, docs, id_col, text_col, k)
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b"))
    common = F.size(F.array_intersect("s_a", "s_b"))
    return (near.join(a, "a").join(b, "b").select("a", "b", common.alias("i"), (F.size("s_a") + F.size("s_b")).alias("n"))
                .where(100 * F.col("i") >= percent * (F.col("n") - F.col("i"))).select("a", "b").distinct())


def _labelled(posts: DataFrame, label: DataFrame | None) -> DataFrame:
    """Postings with the component of their node (its own before the first round)."""
    if label is None:
        return posts.withColumn("comp", F.col("node"))
    return posts.join(label, "node", "left").select("key", "node", F.coalesce("label", "node").alias("comp"))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
         percent: int = SIMILARITY, coords: int = COORDS, match: int = MATCH,
         rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents with shingle similarity of ``percent`` per cent or more are linked;
    ``component_id`` is the least id reachable, ``kept`` marks the row that has it.  Texts
    without words (or null) have no shingles and link with nothing.  Equal sets are linked
    whatever their size.  A null id takes part and gets the least id of its component
    (null alone: ``kept`` true).  Repeated rows all get the same answer.  An empty table
    gives an empty result; other columns are ignored."""
    rows = table(sketches(docs, id_col, text_col, k, coords))
    classes = table(rows.where("n_shingles > 0").groupBy("c", "c2").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
        .withColumn("node", F.xxhash64("c", "c2")))
    posts = (classes.select("node", F.posexplode("sig").alias("j", "v"))
             .select("node", (F.shiftleft(F.col("j").cast("long"), 32) + F.col("v").cast("long")).alias("key")))
    posts = posts.withColumn("df", F.count(F.lit(1)).over(W.partitionBy("key"))).where("df > 1")
    mine = W.partitionBy("node")
    posts = table(posts.withColumn("m", F.count(F.lit(1)).over(mine))
                  .withColumn("r", F.row_number().over(mine.orderBy("df", "key")))
                  .where(F.col("r") <= F.col("m") - match + 1).select("key", "node"))
    label, edges = None, None
    for turn in range(rounds):
        posted = _labelled(posts, label)
        sizes = posted.groupBy("key", "comp").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("node", "key", F.lit(turn)), "node")).alias("pick"))
        top = (sizes.groupBy("key").agg(F.max(F.struct("n", "comp", "pick")).alias("top"), F.count(F.lit(1)).alias("comps"))
                    .where("comps > 1").select("key", F.col("top.comp").alias("top"), F.col("top.pick.node").alias("a")))
        # each member outside the largest component of its lists is tried with a few pivots
        stars = (posted.join(top, "key").where("comp <> top").groupBy(F.col("node").alias("b"))
                       .agg(F.collect_set("a").alias("some"))          # at most one for each coordinate
                       .select(F.explode(F.slice(F.array_sort("some"), 1, TRIES)).alias("a"), "b"))
        found = table(_confirm(stars, classes, docs, id_col, text_col, k, match, percent))
        edges = found if edges is None else table(edges.unionByName(found))
        label = components(edges)
    rest = _rest_links(table(_labelled(posts, label)), classes, docs, id_col, text_col, k, match, percent)
    if rest is not None:
        label = components(rest if edges is None else table(edges.unionByName(rest)))
    if label is None:                       # no rounds asked for and no list
        label = classes.select("node", F.col("node").alias("label")).where(F.lit(False))
    member = classes.select("node", "c", "c2", "doc_id").join(label, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    ids = member.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = member.join(ids, "label").select("c", "c2", "component_id")
    full = rows.select("doc_id", "n_shingles", "c", "c2")
    filled = full.where("n_shingles > 0").join(named, ["c", "c2"])
    empty = full.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    cols = ["doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")]
    return filled.select(*cols).unionByName(empty.select(*cols))
