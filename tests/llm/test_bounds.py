"""Bounds that must hold whatever the rows: samples, buckets, long and repeated conversations."""

import pathlib
import random
import time

import pytest
from pyspark.sql import functions as F

from unifeed.llm import chat, fingerprints, mixing, neardup, quality, shared, toxicity


def test_collected_samples_are_bounded_by_rows_not_ids(spark, monkeypatch):
    docs = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"),
                                    F.lit("s").alias("source"), F.lit("en").alias("lang"))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"),
                                      (F.col("id") % 2).cast("int").alias("toxic"))
    sizes, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda s, n, y: (sizes.append(s.count()), fit(s, n, y))[1])
    assert quality.score(docs, labels.where("doc_id = 1 or doc_id > 2990"), max_labelled=10).count() == 3000
    kept, linear = [], toxicity._linear
    monkeypatch.setattr(toxicity, "_linear", lambda rows, y, k: (kept.append(len(rows)), linear(rows, y, k))[1])
    assert toxicity.score(docs, labels, max_labelled=50).count() == 3000
    assert sizes == [10] and all(k <= 50 for k in kept)


def test_mix_writes_no_file_for_each_shuffle_partition(spark):
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    files = lambda: set(pathlib.Path(shared.scratch_root(spark).removeprefix("file:")).rglob("part-*.parquet"))
    rows = [(i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(2)
    before = files()
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = mixing.mix(df).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(out) == 2000 and any(r.copies for r in out)
    # sizes: a file of each input partition; sources: one before, at most three after the cut, and an empty one
    assert len(files() - before) <= 2 + 1 + 4


def test_weights_stand_for_repeated_rows(spark):
    names = ["a", "b"]
    rows = [(i % 7, float(i % 2), (i % 5) / 5.0, (i % 3) / 3.0 + (i % 2) * 0.2) for i in range(60)]
    df = spark.createDataFrame(rows, "__q_doc long, y double, a double, b double")
    one = quality.fit(df.withColumn("__q_w", F.lit(1.0)), names, "y")
    grouped = quality.fit(quality.bounded(df, names, "y", 1000), names, "y")
    assert one[0] == pytest.approx(grouped[0], rel=1e-6) and one[1] == pytest.approx(grouped[1], rel=1e-6)
    assert quality.bounded(df, names, "y", 7).count() == 7


def test_no_bucket_is_large_when_ids_are_null_or_repeated(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(77)).otherwise(F.col("id")).cast("long").alias("id"),
        F.xxhash64("id").alias("h"))
    sizes = [r["count"] for r in rows.withColumn("b", fingerprints._bucket(rows, "id", "h")).groupBy("b").count().collect()]
    assert sum(sizes) == 9000 and max(sizes) <= 2.5 * fingerprints.BUCKET_ROWS


def test_neighbours_with_null_and_repeated_ids(spark):
    n = 2000
    docs = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(77)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.concat_ws(" ", *[F.concat(F.lit(f"w{k}x"), (F.col("id") * (k + 3) % 50).cast("string")) for k in range(12)]).alias("text"))
    rows = [(r.doc_id, r.text, r.h) for r in docs.select("*", F.xxhash64("text").alias("h")).collect()]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -r[2]))
    import hashlib
    want = []
    for (i, t, _), (_, u, _) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        want.append((i, hashlib.sha256((t[:len(t) - half] + u[:half]).encode()).hexdigest()))
    got = [(r.doc_id, r.edited_sha256) for r in fingerprints.fingerprint(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_repeated_messages_are_one(spark):
    chain = [(1, k, k - 1 if k else None, "assistant" if k % 2 else "user", f"text {k}", "x") for k in range(8)]
    rows = chain + chain + [(1, 3, 2, "zzz", "another message of the same node", "x"), (1, None, 2, "user", "no node", "x"),
                            (2, 0, None, "user", "", "x"), (2, 0, None, "user", "", "x"), (3, 0, None, None, "w " * 40_000, "x")]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, leaf string").withColumn("turns", F.lit(1))
    out = {r.tree: r for r in chat.format_trees(df.drop("leaf")).select(
        "tree", "n_turns", chat.read_back(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("mask")).collect()}
    assert sorted(out) == [1, 2, 3] and out[1].n_turns == 8
    assert [t.text for t in out[1].turns] == [f"text {k}" for k in range(8)]
    assert out[1].mask == "text 1text 3text 5text 7" and out[3].turns[0].text == "w " * 40_000


def test_long_conversations_take_time_in_proportion(spark):
    def seconds(n):
        rows = spark.range(n).select(F.lit(1).cast("long").alias("tree"), F.col("id").alias("node"),
                                     F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"),
                                     F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"),
                                     F.concat(F.lit("é <|im_end|> "), F.col("id").cast("string")).alias("text"))
        start = time.time()
        out = chat.format_trees(rows).select("n_turns", F.char_length(chat.masked_text(F.col("formatted"), F.col("loss_spans"))).alias("m")).first()
        assert out.n_turns == n and out.m == sum(13 + len(str(i)) for i in range(1, n, 2))
        return time.time() - start
    seconds(1000)
    short, long_ = seconds(8000), seconds(32_000)
    assert long_ < 4.5 * short


def _families(bars, size, seed):
    """Families of edited copies, each word changed with the family's probability."""
    rnd, rows = random.Random(seed), []
    for f, p in enumerate(bars):
        base = [f"f{f}w{k}" for k in range(100)]
        rows += [(1000 * f + d, " ".join(f"e{rnd.randint(0, 10 ** 9)}" if rnd.random() < p else w for w in base))
                 for d in range(size)]
    return rows


def _least(rows):
    """The least id reachable, over all pairs."""
    sets = {d: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for d, t in rows}
    least = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while True:
        new = dict(least)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == least:
            return least
        least = new


@pytest.mark.parametrize("blocks", [(1024, 512), (16, 7)])
def test_remaining_pairs_alone_find_every_link(spark, monkeypatch, blocks):
    """Without a round of pivots all links come from the blocks, whatever their size."""
    monkeypatch.setattr(neardup, "SIG_BLOCK", blocks[0])
    monkeypatch.setattr(neardup, "BLOCK", blocks[1])
    rows = _families([0.0, 0.01, 0.02, 0.03, 0.05], 25, 3) + [(-1, ""), (-2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.link(docs, rounds=0).collect()}
    assert got == _least([(d, t or "") for d, t in rows[:-2]]) | {-1: -1, -2: -2}
    alone = neardup.link(docs.where("doc_id < 0 or doc_id = 3001"), rounds=0).collect()
    assert {r.doc_id: r.component_id for r in alone} == {-1: -1, -2: -2, 3001: 3001}


def test_lists_that_chain_up_meet_one_by_one(spark, monkeypatch):
    """A family of many blocks whose lists share one member each is met list by list; lists of the
    same members are met once, and so is a family of less than a block."""
    chain = [(k, n) for k in range(30) for n in (3 * k, 3 * k + 1, 3 * k + 2, 3 * k + 3)]
    same = [(100 + k, 1000 + n) for k in range(30) for n in range(4)]
    posted = spark.createDataFrame([(k, n, n) for k, n in chain + same], "key long, node long, comp long")
    assert {r.kind for r in neardup._torn_groups(posted).collect()} == {0}
    monkeypatch.setattr(neardup, "SIG_BLOCK", 4)
    groups = neardup._torn_groups(posted)
    sizes = {(r.kind, r.node >= 1000): (r.groups, r.n) for r in groups.withColumn("hi", F.col("node") >= 1000).groupBy(
        "kind", "hi").agg(F.countDistinct("grp").alias("groups"), F.count(F.lit(1)).alias("n"), F.max("node").alias("node")).collect()}
    assert sizes == {(1, False): (30, 120), (0, True): (1, 4)}
    assert groups.where("not outer").count() == 31


def test_torn_members_without_a_partner_fetch_no_sets(spark, monkeypatch):
    """Lists that tear but whose members collide too little cost signatures only."""
    rnd = random.Random(5)
    classes = spark.createDataFrame([(n, [7] * 20 + [rnd.randint(0, 1 << 30) for _ in range(76)], 100) for n in range(300)],
                                    "node long, sig array<int>, n_shingles long")
    posted = spark.createDataFrame([(k, n, n) for k in range(3) for n in range(300)], "key long, node long, comp long")
    monkeypatch.setattr(neardup, "_sets_of", None)
    assert neardup._rest_links(posted, classes, None, "doc_id", "text", 5, neardup.MATCH, neardup.SIMILARITY) is None
