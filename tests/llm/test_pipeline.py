"""Each stage against a plain rule on its own input."""

import collections
import re

import pytest

import corpus_pipeline as P
from unifeed.llm import decontam, quality
from unifeed.llm.shared import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for _, stage in P.STAGES:
        frames.append(table(stage(spark, frames[-1], SF)))
    return frames


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_sizes(steps):
    for f in steps[:-1]:
        assert f.columns == P.COLUMNS
    counts = [f.count() for f in steps]
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0 and counts[1] < counts[0]


def test_quality_stage(spark, steps):
    scored = rows(quality.score(steps[0], spark.read.parquet(f"{SF}/labels.parquet")))
    assert set(rows(steps[1])) == {d for d, r in scored.items() if r.posterior >= 0.5}


def test_line_stage(steps):
    before, after = rows(steps[1]), rows(steps[2])
    seen = collections.Counter(line for r in after.values() for line in r.text.split("\n") if len(line.split()) >= 50)
    assert all(n == 1 for n in seen.values())
    assert set(seen) == {line for r in before.values() for line in r.text.split("\n") if len(line.split()) >= 50}
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_near_stage(steps):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    before, after = rows(steps[2]), rows(steps[3])
    sets = {d: shingles(r.text) for d, r in before.items()}
    near = lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    for a in after:
        assert not any(near(a, b) for b in after if a < b)
    for d in set(before) - set(after):
        assert any(near(d, o) for o in before if o != d)


def test_decontamination_stage(spark, steps):
    hits = {r.doc_id for r in decontam.find(steps[3], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert set(rows(steps[4])) == set(rows(steps[3])) - hits and hits


def test_mixing_stage(steps):
    out = rows(steps[5])
    taken, target = collections.Counter(), {}
    for r in out.values():
        assert 1 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    longest = max(r.size for r in rows(steps[5]).values())
    assert all(abs(taken[s] - target[s]) <= longest for s in target)


def test_stages_survive_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "one two three four five six seven eight nine ten and some more words to tell"
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, text, "en", None, 50), (2, text, "en", None, 50),
           (None, text, None, "s", 50), (None, "another text that stands by itself and is kept whole", None, "s", 52)]
    for data in ([], odd):
        docs = spark.createDataFrame(data, schema)
        for _, stage in P.STAGES:
            docs = stage(spark, docs, SF)
            docs.collect()


def test_near_stage_of_null_and_repeated_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "one two three four five six seven eight nine ten and some more words to tell"
    rows_ = [(2, text, "en", None, 50), (2, text, "en", None, 50), (None, text, None, "s", 50),
             (None, "another text that stands by itself and is kept whole", None, "s", 52), (None, None, None, None, None)]
    out = P.dedup_near(spark, spark.createDataFrame(rows_, schema), SF).collect()
    assert sorted((str(r.doc_id), str(r.text)[:3]) for r in out) == [("2", "one"), ("None", "Non"), ("None", "ano")]


def test_decontamination_of_null_and_repeated_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    copied = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    clean = "a text that stands by itself and copies nothing of what is tested"
    rows_ = [(d, t, "en", "s", len(t)) for d in (None, 5) for t in (copied, clean, clean)] + [(None, None, None, None, None)]
    out = P.decontaminate(spark, spark.createDataFrame(rows_, schema), SF).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == [
        ("5", clean), ("5", clean), ("None", "None"), ("None", clean), ("None", clean)]


def test_run_is_the_stages(spark, steps):
    assert set(map(tuple, P.run(spark, SF).collect())) == set(map(tuple, steps[5].collect()))
