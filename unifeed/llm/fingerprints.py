"""Operator 3 [native]: document fingerprints by Order MinHash.

The k-mers are runs of ``K`` words, numbered by occurrence, so repeats count.  A hash of
(k-mer, occurrence) orders them at random; the space of hashes is cut into 2 x ``TUPLES``
equal parts and the least element of each part is selected.  Two neighbouring parts make a
tuple: its selected elements, *in the order they stand in the text*, are hashed to one
signature value.  Equal sets in another order give other values, so the share of equal
values follows edit distance, not only shared content.

All of it is array functions on the row, evaluated where the text is: no explode, no
shuffle.  Neighbouring documents meet through range buckets of the id: texts are shuffled
once, by bucket, and the first row of each bucket is handed to the bucket before.
"""

from __future__ import annotations

import math
from typing import Callable

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .shared import table, text_or_empty

K, TUPLES = 5, 64
MAX_BUCKETS, BUCKET_ROWS = 1 << 15, 256
_PLACE = (1 << 24) - 1                   # low bits of a packed element: its place in the text
_PART_BITS = int(math.log2(2 * TUPLES))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def _pack(h: Column, place: Column) -> Column:
    return h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.cast("long").bitwiseAND(F.lit(_PLACE)))


def _numbered(kmers: Column) -> Column:
    """Packed (hash of k-mer and occurrence number, place) of an array of k-mer hashes."""
    def once(k: Column) -> Column:                    # no repeats: every occurrence is the first
        return F.transform(k, lambda h, i: _pack(F.xxhash64(h.bitwiseAND(F.lit(~_PLACE)), F.lit(0)), i))

    def repeated(s: Column) -> Column:                # s: sorted (k-mer, place); equal k-mers adjoin
        code = lambda i: F.get(s, i).bitwiseAND(F.lit(~_PLACE))
        firsts = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda i: (i == 0) | (code(i) != code(F.greatest(i - 1, F.lit(0)))))
        return let(firsts, lambda f: F.flatten(F.transform(f, lambda st, r: F.transform(
            F.sequence(st, F.coalesce(F.get(f, r + 1), F.size(s)) - 1),
            lambda j: _pack(F.xxhash64(code(st), j - st), F.get(s, j))))))
    return F.when(F.size(F.array_distinct(kmers)) == F.size(kmers), once(kmers)).otherwise(
        let(F.sort_array(F.transform(kmers, _pack)), repeated))


def _part(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - _PART_BITS)


def _tuples(mins: Column) -> Column:
    """Signature entries (tuple number << 32 | 32-bit value) from the least element of each
    part; a tuple with one element hashes that, an empty one has no entry."""
    code = lambda x: F.shiftrightunsigned(x, 24)
    number = lambda x: F.shiftright(_part(x), 1)

    def entry(x: Column, j: Column) -> Column:
        after, before = F.get(mins, j + 1), F.get(mins, j - 1)
        place = lambda v: v.bitwiseAND(F.lit(_PLACE))
        pair = F.when(place(x) <= place(after), F.xxhash64(code(x), code(after))).otherwise(F.xxhash64(code(after), code(x)))
        value = (F.when(number(after) == number(x), pair)
                  .when(number(before) == number(x), F.lit(None).cast("long"))     # told by its first
                  .otherwise(F.xxhash64(code(x))))
        return F.shiftleft(number(x), 32).bitwiseOR(value.bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.filter(F.transform(mins, entry), lambda e: e.isNotNull())


def signature(text: Column) -> Column:
    """array<long>: the Order MinHash entries of a text (at least one, also for an empty text)."""
    def kmers(wh: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(wh) - K, F.lit(0))),
                           lambda i: F.xxhash64(*[F.get(wh, i + j) for j in range(K)]))

    def least(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (_part(x) != _part(F.get(s, F.greatest(i - 1, F.lit(0))))))
    hashes = F.transform(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: F.xxhash64(w))
    return let(let(let(hashes, kmers), lambda k: F.sort_array(_numbered(k))), lambda s: let(least(s), _tuples))


def as_text(entries: Column) -> Column:
    """Entries as one string: two hexadecimal digits of tuple number and eight of value each."""
    return F.lower(F.concat_ws("", F.transform(entries, lambda e: F.lpad(F.hex(e), 10, "0"))))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signature values among the tuples that either text fills (0 to 1)."""
    number = lambda x: F.transform(x, lambda e: F.shiftright(e, 32))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(number(a), number(b))).cast("double")


def _bucket(ids: DataFrame, id_col: str, hash_col: str) -> Column:
    """A range bucket of (id, text hash), higher for what comes first: quantile bounds of the id,
    computed once and written into the plan (two steps of square-root size).  An id that holds
    more than a bucket's rows stands at several bounds: it gets a bucket of its own, cut by the
    hash into as many parts; so do null ids, in the lowest bucket."""
    n, nulls = ids.agg(F.count(id_col), F.count_if(F.col(id_col).isNull())).first()
    p = max(1, min(MAX_BUCKETS, n // BUCKET_ROWS))
    step = max(1, math.isqrt(p - 1) + 1)
    found = ids.agg(F.percentile_approx(F.col(id_col), [i / p for i in range(1, p)] or [0.5], 50_000)).first()[0] or []
    often = {c: found.count(c) for c in {a for a, b in zip(sorted(found), sorted(found)[1:]) if a == b}} if p > 1 else {}
    cuts = sorted({*found, *[c + 1 for c in often]})
    listed = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    # part of a bucket by hash: 0 to parts - 1, rising with the (signed) hash
    part = lambda parts: F.least(F.floor((F.col(hash_col).cast("double") / 2.0 ** 64 + 0.5) * parts), parts - 1).cast("long")
    null_parts = F.lit(max(1, min(MAX_BUCKETS, -(-(nulls or 0) // BUCKET_ROWS))))
    lowest = part(null_parts) - MAX_BUCKETS
    if not cuts:
        return F.coalesce(F.when(F.col(id_col).isNull(), lowest), F.lit(0).cast("long"))
    upto = lambda xs: F.size(F.filter(xs, lambda c: c <= F.col(id_col)))
    coarse = upto(listed(cuts[::step])) - 1
    fine = F.when(coarse < 0, F.lit(0)).otherwise(coarse * step + upto(
        F.slice(listed(cuts), F.greatest(coarse, F.lit(0)) * step + 1, step)))
    place = fine.cast("long") * F.lit(2 * MAX_BUCKETS).cast("long")
    if often:
        ids_, parts = listed(sorted(often)), listed([often[c] for c in sorted(often)])
        at = F.array_position(ids_, F.col(id_col).cast("long"))
        place = F.when(at > 0, place + part(F.get(parts, (at - 1).cast("int")))).otherwise(place)
    return F.when(F.col(id_col).isNull(), lowest).otherwise(place)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document follows in descending id (null ids last, equal ids by text hash; the
    first follows the last).  The edited text has the last floor(n/2) code points replaced by
    as many of the next document's first (or all).  Null texts are empty.  Equal texts have
    equal fingerprints; a text of fewer than ``K`` words is one k-mer, an empty one too.
    Repeated rows are neighbours of each other; rows alike in id *and*
    text share a bucket, all others are cut apart however many share an id or have none.  A single document is its own next.  Places
    beyond 2^24 words wrap, which can only swap the order within a tuple.  An empty table
    gives an empty result; other columns are ignored."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("bucket", _bucket(rows.select("id"), "id", "h"))
    first = F.struct(F.col("id").isNotNull().alias("has"), "id", "h")
    tops = table(rows.groupBy("bucket").agg(F.max(first).alias("top")))       # at most MAX_BUCKETS rows
    order = W.orderBy(F.desc("bucket"))
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    after = tops.select("bucket", F.coalesce(F.lead("bucket").over(order), F.first("bucket").over(whole)).alias("to"))
    named = tops.select(F.col("bucket").alias("to"), F.col("top.id").alias("top_id"), F.col("top.h").alias("top_h"))
    head = (rows.select("id", "text", "h").join(F.broadcast(named), F.col("id").eqNullSafe(F.col("top_id"))
                                                & (F.col("h") == F.col("top_h")))
                .dropDuplicates(["to"]).select("to", F.struct("text", signature(F.col("text")).alias("sig")).alias("head")))
    head = after.join(head, "to").select(F.col("bucket").alias("of"), "head")
    down = W.partitionBy("bucket").orderBy(F.desc_nulls_last("id"), F.desc("h"))
    lined = rows.withColumn("sig", signature(F.col("text")))
    lined = lined.withColumn("next", F.lead(F.struct("text", "sig")).over(down))
    both = lined.join(head, F.col("bucket") == F.col("of")).withColumn("next", F.coalesce("next", "head"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), (n - half).cast("int")), F.substr(F.col("next.text"), F.lit(1), half))
    made = let(edited, lambda t: let(signature(t), lambda e: F.struct(
        F.sha2(t.cast("binary"), 256).alias("sha"), as_text(e).alias("print"),
        likeness(F.col("sig"), e).alias("near"))))
    out = both.select("id", n.cast("long").alias("n_chars"), made.alias("edit"), as_text(F.col("sig")).alias("fingerprint"),
                      likeness(F.col("sig"), F.col("next.sig")).alias("near_next"))
    return out.select(F.col("id").alias("doc_id"), "n_chars", F.col("edit.sha").alias("edited_sha256"), "fingerprint",
                      F.col("edit.print").alias("edited_fingerprint"), F.col("edit.near").alias("near_edited"), "near_next")
