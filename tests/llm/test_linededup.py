"""Line dedup against all pairs of places, and what its result rests on."""

import random

import pytest
from pyspark.sql import functions as F

from unifeed.llm import linededup


def by_pairs(docs, min_words):
    """{id: kept text}: maximal matching runs of every line with every earlier place."""
    lines = [(d, i, line) for d, text in sorted(docs.items()) for i, line in enumerate(text.split("\n"))]
    full = {d: [(i, line) for x, i, line in lines if x == d and line.split()] for d in docs}
    places = [(d, n) for d in sorted(docs) for n in range(len(full[d]))]
    gone = set()
    for x, (d, n) in enumerate(places):
        for e, m in places[:x]:
            if full[d][n][1] != full[e][m][1] or (n and m and full[d][n - 1][1] == full[e][m - 1][1]):
                continue                     # not the first line of a run
            size, words = 0, 0
            while n + size < len(full[d]) and m + size < len(full[e]) and full[d][n + size][1] == full[e][m + size][1]:
                words += len(full[d][n + size][1].split())
                size += 1
            if words >= min_words:
                gone |= {(d, full[d][n + j][0]) for j in range(size)}
    out = {}
    for d, text in docs.items():
        kept, cut = [], False
        for i, line in enumerate(text.split("\n")):
            cut = (d, i) in gone if line.split() else cut
            if not cut:
                kept.append(line)
        out[d] = "\n".join(kept)
    return out


def deduped(spark, docs, min_words):
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    return {r.doc_id: r.text for r in linededup.dedup(df, min_words=min_words).collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs_of_places(spark, seed):
    """Few different lines, so that runs overlap, repeat within a text and begin alike."""
    rnd = random.Random(seed)
    line = [" ".join(f"w{n}" for _ in range(rnd.randint(1, 5))) for n in range(12)] + ["", " "]
    passage = [[rnd.choice(line) for _ in range(rnd.randint(3, 9))] for _ in range(8)]
    docs = {}
    for d in range(60):
        text = []
        for _ in range(rnd.randint(0, 6)):
            text += rnd.choice(passage) if rnd.random() < 0.6 else [f"own {d} {rnd.random()}", rnd.choice(line)]
        docs[d] = "\n".join(text)
    want = by_pairs(docs, 12)
    assert deduped(spark, docs, 12) == want and sum(want[d] != docs[d] for d in docs) > 10


def test_matches_rest_on_the_selected_places(spark, monkeypatch):
    docs = {d: "\n".join([f"own {d}", *(f"line {n} of a passage that is shared" for n in range(10))]) for d in range(4)}
    assert deduped(spark, docs, 50)[1] == "own 1"
    whole = linededup._windows

    def blind(*args):                        # every selected place has a fingerprint of its own
        lines, full = whole(*args)
        return lines, full.withColumn("mark", F.xxhash64("k", "h", "at"))
    monkeypatch.setattr(linededup, "_windows", blind)
    assert deduped(spark, docs, 50) == docs


def test_fewer_places_are_selected_than_there_are_lines(spark):
    docs = spark.createDataFrame([(d, "\n".join(f"{d} {n} five words here" for n in range(200))) for d in range(5)], "doc_id long, text string")
    _, full = linededup._windows(docs, "doc_id", "text", 50)
    full = full.where("next is not null")
    assert full.select("k", "at").distinct().count() < full.count() / 3


def test_places_of_a_hot_line_are_split(spark):
    """A line in every document: its places are dealt over the groups and meet as ends only."""
    hot = "the same line stands here"
    rows = [(d, f"{hot}\n" + "\n".join(f"{d} {n} words of its own in each" for n in range(9))) for d in range(2000)]
    _, full = linededup._windows(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 10)
    full = full.withColumn("split", F.pmod(F.xxhash64("k", "h"), F.lit(linededup.SPLITS)))
    full = full.withColumn("mark", F.lit(1))
    most = full.groupBy("mark", "split").count().agg(F.max("count")).first()[0]
    assert most < 4 * full.count() / linededup.SPLITS
