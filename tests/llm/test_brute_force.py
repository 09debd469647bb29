"""Operators against brute force, exact round trips or held-out accuracy on small whole tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from unifeed.llm import catalog, chat, decontam, fingerprints, licenses, maxent, mixing, neardup, quality, words

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", ["op2_line_dedup", "op4_mix_sources", "op9_near_duplicates", "op10_chat_formatting"])
def test_against_sql(spark, con, name):
    out = E.queries()[name](spark, SF)
    rel = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    norm = lambda row: tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    assert sorted(map(norm, out.select(*cols).collect()), key=repr) == sorted(map(norm, rel.fetchall()), key=repr)


def test_all_ten_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


# -- words --------------------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aAbB \n\té߀", max_size=40), min_size=1, max_size=6))
def test_words_and_shingles(rows):
    import pyarrow as pa
    seen = {}
    for lo, hi, data, offsets in words.chunks(pa.array(rows), limit=16):
        start, end, row = words.split(data, offsets)
        h = words.word_hashes(data, start, end)
        for i in range(hi - lo):
            mine = [w.translate(FOLD) for w in WORD.findall(rows[lo + i])]
            assert len(mine) == int((row == i).sum())
            for w, x in zip(mine, h[row == i].tolist()):
                assert seen.setdefault(w, x) == x
            s, r = words.shingles(h, row, 3)
            want = {tuple(mine[k:k + 3]) for k in range(len(mine) - 2)} if len(mine) >= 3 else ({tuple(mine)} if mine else set())
            assert len(set(s[r == i].tolist())) == len(want)
    assert len(set(seen.values())) == len(seen)


# -- 1: decontamination -------------------------------------------------------------------

def slow_alignment(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if x == y else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
            best = max(best, h[i + 1][j + 1])
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=12), st.lists(st.integers(0, 5), min_size=1, max_size=25))
def test_smith_waterman(a, b):
    score, start, end = decontam.smith_waterman(np.array(a), np.array(b))
    assert score == slow_alignment(a, b)
    if score:
        assert slow_alignment(a, b[start:end]) == score


def tokens(text):
    return [w.translate(FOLD) for w in WORD.findall(text)]


def all_alignments(docs, items, bar=0.5):
    """Every (document, item) whose alignment reaches the bar: all pairs, no seeds."""
    ids = collections.defaultdict(lambda: len(ids))
    code = lambda ws: np.array([ids[w] for w in ws], dtype=np.int64)
    docs, items = {d: code(w) for d, w in docs.items()}, {i: code(w) for i, w in items.items()}
    return {(d, i): decontam.smith_waterman(a, b)[0] / (2 * len(a)) for i, a in items.items() for d, b in docs.items()
            if len(a) >= 3 and len(b) and decontam.smith_waterman(a, b)[0] >= bar * 2 * len(a)}


def found(spark, docs, items, **options):
    out = decontam.find(spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string"),
                        spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"), **options)
    rows = out.collect()
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    return {(r.doc_id, r.item_id): r.score for r in rows}


def test_decontamination_finds_all_alignments(spark, con, texts):
    items = dict(con.execute("SELECT item_id, text FROM benchmark").fetchall())
    want = all_alignments({d: tokens(t) for d, t in texts.items()}, {i: tokens(t) for i, t in items.items()})
    got = {(r.doc_id, r.item_id): r.score for r in E.queries()["op1_decontaminate"](spark, SF).collect()}
    assert got == pytest.approx(want) and want


def edited(rnd, words, kind, share):
    """``words`` with a share of them substituted, deleted or followed by another word."""
    out = []
    for w in words:
        hit = rnd.random() < share
        other = f"z{rnd.randint(0, 10 ** 6)}"
        out += {"substitute": [other] if hit else [w], "delete": [] if hit else [w], "insert": [w, other] if hit else [w]}[kind]
    return out


@pytest.mark.parametrize("vocabulary", [30, 3000])
def test_decontamination_loses_no_edited_copy(spark, vocabulary):
    """All pairs above the bar, whatever the edits leave of them; a small vocabulary makes
    every seed common and most alignments stray."""
    rnd = random.Random(vocabulary)
    vocab = [f"v{i}" for i in range(vocabulary)]
    items = {k: [rnd.choice(vocab) for _ in range(rnd.choice([3, 4, 7, 15, 20, 40, 90]))] for k in range(30)}
    docs = {}
    for kind in ("substitute", "delete", "insert"):
        for share in (0.1, 0.25, 0.33):
            for k, words in items.items():
                noise = [rnd.choice(vocab) for _ in range(40)]
                docs[len(docs)] = noise[:20] + edited(rnd, words, kind, share) + noise[20:]
    want = all_alignments(docs, items)
    got = found(spark, docs, items)
    assert len(want) > 150 and got == pytest.approx(want)


def test_decontamination_without_three_words_in_a_row(spark):
    rnd = random.Random(5)
    item = [f"q{i}" for i in range(20)]
    inserted = [x for i, w in enumerate(item) for x in ([w] if i % 2 == 0 else [w, f"n{i}"])]
    replaced = [w if i % 3 else f"r{i}" for i, w in enumerate(item)]
    docs = {1: inserted, 2: replaced, 3: [x for w in item for x in (w, f"m{rnd.random()}")]}
    assert found(spark, docs, {1: item}) == pytest.approx(all_alignments(docs, {1: item}))
    assert {d for d, _ in found(spark, docs, {1: item})} >= {1, 2}


def test_decontamination_of_repeated_words_items_and_blocks(spark):
    rnd = random.Random(8)
    items = {1: ["a"] * 30, 2: ["a", "b"] * 12, 3: [f"c{i}" for i in range(12)], 4: [f"c{i}" for i in range(12)], 5: ["a", "b"]}
    items.update({10 + k: [f"t{j}" for j in range(10)] + [f"u{k}x{j}" for j in range(12)] for k in range(60)})   # one beginning
    docs = {1: ["a"] * 4000, 2: ["b", "a"] * 2000, 3: ["x"] + items[3] + ["a"] * 40, 4: items[15], 5: items[20][:10] * 300,
            6: edited(rnd, items[33], "substitute", 0.25), 7: ["a"], 8: ["b"]}
    want = all_alignments(docs, items)
    assert found(spark, docs, items) == pytest.approx(want) and len(want) > 6
    assert found(spark, docs, items, block_words=200) == pytest.approx(want)
    assert found(spark, docs, items, min_score=0.8) == pytest.approx(all_alignments(docs, items, 0.8))


def test_hits_laid_out_in_slices(spark, monkeypatch):
    rnd = random.Random(11)
    words = [np.array([rnd.randint(0, 3) for _ in range(n)], dtype=np.uint64) for n in (12, 30, 5)]
    index = decontam.Items([0, 1, 2], words, 0.5)
    text = np.array([rnd.randint(0, 3) for _ in range(400)], dtype=np.uint64)
    row = np.repeat(np.arange(4), 100)
    hashes, at = decontam.pairs(text, row)
    hit, seed = index.find(hashes)
    at = at[hit]
    whole = list(decontam.passages(index, row[at], at - row[at] * 100, seed))
    monkeypatch.setattr(decontam, "SLICE", 50)
    assert whole and list(decontam.passages(index, row[at], at - row[at] * 100, seed)) == whole


def test_decontamination_of_edited_copies(spark):
    rnd = random.Random(4)
    vocab = [f"v{i}" for i in range(400)]
    item = [rnd.choice(vocab) for _ in range(40)]
    docs = []
    for d in range(30):
        copy = [rnd.choice(vocab) if rnd.random() < 0.12 else w for w in item]
        if d % 3 == 0:
            del copy[10:13]
        noise = [rnd.choice(vocab) for _ in range(100)]
        docs.append((d, " ".join(noise[:50] + (copy if d < 20 else []) + noise[50:])))
    out = decontam.find(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame([(1, " ".join(item)), (2, "short one")], "item_id long, text string"),
                        block_words=10).collect()     # several blocks of items
    assert sorted(r.doc_id for r in out) == list(range(20))


@pytest.mark.parametrize("edits", [0.1, 0.25, 0.33])
def test_decontamination_of_short_hot_items(spark, edits):
    rnd = random.Random(int(edits * 100))
    vocab = [f"v{i}" for i in range(3000)]
    items = {k: [rnd.choice(vocab) for _ in range(15 + k)] for k in range(6)}         # 15 to 20 words
    docs, copies = {}, {}
    for d in range(3600):
        noise = [rnd.choice(vocab) for _ in range(24)]
        docs[d] = noise
        if d % 3 == 0:                      # a third of the documents, so every seed is common
            copy = [rnd.choice(vocab) if rnd.random() < edits else w for w in items[d // 3 % 6]]
            copies[d] = docs[d] = noise[:12] + copy + noise[12:]
    want = all_alignments(copies, items)
    assert want and found(spark, docs, items) == pytest.approx(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 8), min_size=1, max_size=12), st.lists(st.integers(0, 8), min_size=1, max_size=25))
def test_bound_of_an_alignment(a, b):
    assert decontam.highest(np.array(a), np.array(b)) >= slow_alignment(a, b)


# -- 3: fingerprints ----------------------------------------------------------------------

def test_fingerprints(spark, texts):
    out = {r.doc_id: r for r in E.queries()["op3_fingerprints"](spark, SF).collect()}
    ids = sorted(texts, reverse=True)
    prints = collections.defaultdict(set)
    for n, d in enumerate(ids):
        t, after = texts[d], texts[ids[(n + 1) % len(ids)]]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        r = out[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints[t].add(r.fingerprint)
        prints[edited].add(r.edited_fingerprint)
        a, b = (dict((x[k:k + 2], x[k + 2:k + 10]) for k in range(0, len(x), 10)) for x in (r.fingerprint, r.edited_fingerprint))
        assert r.near_edited == pytest.approx(sum(b.get(k) == v for k, v in a.items()) / len(a.keys() | b.keys()))
    assert all(len(p) == 1 for p in prints.values())
    assert sum(r.near_edited for r in out.values()) > 20 * sum(r.near_next for r in out.values())


def test_fingerprint_order_and_repeats(spark):
    ws = [f"w{i}" for i in range(400)]
    swapped = ws[200:] + ws[:200]
    rows = [(4, " ".join(ws)), (3, " ".join(swapped)), (2, " ".join(ws * 2)), (1, " ".join(["x"] * 500)), (0, " ".join(["x"] * 900))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sig", fingerprints.signature(F.col("text")))
    sig = {r.doc_id: set(r.sig) for r in df.collect()}
    like = lambda a, b: len(sig[a] & sig[b]) / fingerprints.TUPLES
    assert 0.3 < like(4, 3) < 0.8            # same words, other order: half of the pairs keep theirs
    assert like(4, 2) < 0.75                 # repeats count
    assert 0 < like(1, 0) < 0.9              # occurrences of one k-mer are numbered


# -- 4: mixing ----------------------------------------------------------------------------

def test_mix_reaches_targets(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.randint(1, 60)), f"s{min(5, rnd.randint(0, 9))}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df, weights=(1, 5), max_copies=3).collect()
    per = collections.defaultdict(lambda: [0, 0, 0])
    for r in out:
        per[r.source][0] += r.taken
        per[r.source][1] = r.target
        per[r.source][2] = r.source_size
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
    assert all(abs(taken - target) <= 60 and target <= 3 * size + 1e-6 for taken, target, size in per.values())
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mix(df.repartition(7), weights=(1, 5)).collect()))


def test_mix_with_unequal_inclusion(spark):
    weight = lambda i: None if i % 7 == 0 else 60.0 if i % 8 == 2 else 1.0 if i % 2 == 0 else 2.0
    rows = [(i, " ".join(["w"] * 20), f"s{i % 2}", weight(i)) for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, w double")
    out = mixing.mix(df, weights=(1, 1), weight_col="w").collect()
    assert all(r.copies == 0 for r in out if r.w is None)
    mean = lambda s, w: np.mean([r.copies for r in out if r.source == s and r.w == w])
    assert mean("s0", 60.0) == 3 and 0.3 < mean("s0", 1.0) < 0.6      # the heavy rows are at the limit
    for s in ("s0", "s1"):
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 20


# -- 5: language model --------------------------------------------------------------------

def test_language_model(spark, texts):
    out = {r.doc_id: r for r in E.queries()["op5_lm_scores"](spark, SF).collect()}
    toks = {d: [w.translate(FOLD) for w in WORD.findall(t)] + ["\0"] for d, t in texts.items()}
    train = collections.Counter()
    for d, t in toks.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            train.update(t)
    total, types = sum(train.values()), len(train)
    for d, t in toks.items():
        r = out[d]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (zlib.crc32(str(d).encode()) % 7 == 2, len(t), total)
        assert r.n_known == sum(w in train for w in t)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 1) / (total + types + 1)) for w in t))
    held = [r for r in out.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_by_join_equal_broadcast(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    near = {r.doc_id: r for r in maxent.score(df, rounds=1).collect()}
    monkeypatch.setattr(maxent, "HEAD", 64)
    far = {r.doc_id: r for r in maxent.score(df, rounds=1).collect()}
    assert all(far[d].n_known == r.n_known and far[d].base_score == pytest.approx(r.base_score) for d, r in near.items())


def test_class_probabilities_add_up():
    m = maxent.Model(np.array([5, 9], dtype=np.uint64), np.array([3, 4]), np.array([0, 1]), np.zeros(maxent.ENDINGS, dtype=np.int64))
    m.w += np.random.default_rng(0).normal(size=m.w.shape).astype(np.float32)
    p = np.exp(m.log_classes(np.array([[0, maxent.SLOTS[1], maxent.SLOTS[2], maxent.SLOTS[3]]])))
    assert p.shape == (1, maxent.CLASSES) and p.sum() == pytest.approx(1, abs=1e-5)


# -- 6, 8: classifiers --------------------------------------------------------------------

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    out = E.queries()["op6_toxicity"](spark, sf).toPandas()
    truth = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert len(out) == 1000 and (out.held_out == out.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 4 == 2)).all()
    m = out.merge(truth, on="doc_id").query("held_out")
    caught = ((m.predicted == 1) & (m.toxic == 1)).sum()
    assert caught / max(1, m.predicted.sum()) >= 0.9 and caught / m.toxic.sum() >= 0.6


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality.score(docs, labels.where("doc_id % 3 <> 0")).toPandas()
    m = out.merge(labels.toPandas(), on="doc_id").query("doc_id % 3 == 0")
    assert ((m.posterior >= 0.5) == (m.quality == 1)).mean() >= 0.97
    assert m[m.quality == 1].keep.mean() >= 0.98


def test_sparse_sites_shrink_to_their_parent(spark):
    good, bad = "a plain text of many quite different words here now", "&&& $$$ ### &&& $$$ ### &&& $$$"
    rows = [(i, good if i % 10 else bad, "big", "en") for i in range(400)]
    rows += [(1000 + i, bad if i % 10 else good, "junk", "en") for i in range(400)] + [(5000, good, "tiny", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = df.select("doc_id", (F.col("text") == good).cast("int").alias("quality"))
    out = {r.doc_id: r for r in quality.score(df, labels).collect()}
    assert out[1].site_rate > 0.8 > 0.2 > out[1001].site_rate and 0.3 < out[5000].site_rate < 0.7


# -- 7: licenses --------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=20), st.lists(st.integers(0, 9), max_size=20))
def test_alignment_is_an_increasing_matching(a, b):
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def test_licenses(spark):
    mit = licenses.TEMPLATES["mit"]
    edited = mit.replace("Software", "Program").replace("free of charge", "at no cost").lower()
    rows = [(1, "x y\n" + licenses.TEMPLATES["cc-by-nc-4.0"] + ".\nz"), (2, "intro " + edited + " outro"), (3, "no license here"),
            (4, "a. " + licenses.TEMPLATES["gpl-3.0"] + ". b. " + licenses.TEMPLATES["all-rights-reserved"]), (5, mit[:200])]
    out = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license or "") for r in out) == [
        (1, "cc-by-nc-4.0"), (2, "mit"), (3, ""), (4, "all-rights-reserved"), (4, "gpl-3.0"), (5, "")]


def test_licenses_carried_more_than_once(spark):
    rnd = random.Random(2)
    prose = [w for n in range(80) for w in (f"p{n}", "of", "the", f"q{n}", "to", "the")]
    short, mit = licenses.TEMPLATES["mit-notice"], licenses.TEMPLATES["mit"]
    edited = " ".join(w for w in mit.split() if rnd.random() > 0.06)
    rows, want = [], {}
    for name, copy in [("mit-notice", short), ("all-rights-reserved", "All rights reserved"), ("mit", mit), ("mit", edited),
                       ("apache-2.0-header", licenses.TEMPLATES["apache-2.0-header"])]:
        for n in (2, 3, 40):
            for gap in ("", "one two three", " ".join(prose)):
                want[len(rows)] = [name] * n
                rows.append((len(rows), "foo " + f" {gap} ".join([copy] * n) + " bar"))
    want[len(rows)] = ["isc", "mit", "mit", "mit-notice"]
    rows.append((len(rows), " ".join([mit, short, edited, licenses.TEMPLATES["isc"]])))
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.start_word, r.end_word))
    assert {d: sorted(x[0] or "" for x in found) for d, found in got.items()} == want
    for found in got.values():
        found.sort(key=lambda x: x[1])
        assert all(x[2] <= y[1] for x, y in zip(found, found[1:]))


def test_licenses_of_whole_texts_and_headers(spark):
    known = licenses.covered()
    names = {n for n, _ in known}
    assert {"apache-2.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "mpl-2.0", "bsd-2-clause", "bsd-3-clause", "unlicense",
            "cc0-1.0", "cc-by-sa-4.0", "gpl-2.0-header", "agpl-3.0-header", "epl-2.0-header"} <= names
    rnd = random.Random(6)
    rows = [(i, text) for i, (_, text) in enumerate(known)]
    rows += [(len(known) + i, " ".join("edited" if len(text.split()) > 60 and rnd.random() < 0.05 else w for w in text.split()))
             for i, (_, text) in enumerate(known)]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append(r.license)
    assert got == {i: [known[i % len(known)][0]] for i in range(len(rows))}


# -- 9: near-duplicates -------------------------------------------------------------------

def test_pairs_at_the_least_similarity_are_rarely_missed():
    n, p = neardup.COORDS, neardup.SIMILARITY / 100
    missed = sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(neardup.MATCH))
    assert missed == pytest.approx(2.9e-6, rel=0.02) and missed < 1e-5


def test_near_duplicate_families(spark):
    """Families of edited copies of one text, some just above and some just below the bar."""
    rnd = random.Random(9)
    base = [f"b{rnd.randint(0, 10 ** 6)}" for _ in range(120)]
    rows = [(d, " ".join(f"e{rnd.randint(0, 10 ** 9)}" if rnd.random() < d % 5 * 0.008 else w for w in base)) for d in range(120)]
    rows += [(1000 + d, " ".join(f"n{d}x{k}" for k in range(50))) for d in range(40)]
    out = {r.doc_id: r for r in neardup.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {d: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {d: r.component_id for d, r in out.items()} == {d: find(d) for d in sets}
    assert len({find(d) for d in range(120)}) > 1


# -- 10: chat -----------------------------------------------------------------------------

def test_reply_trees(spark):
    rnd = random.Random(2)
    rows = []
    for tree in range(6):
        for node in range(40):
            parent = None if node == 0 else rnd.randint(max(0, node - 6), node - 1)
            text = "".join(rnd.choice(["<|im_end|>\n", "\\", "[/INST]", "</s>", "é", " ", "a", "<", "|"]) for _ in range(8))
            rows.append((tree, node, parent, rnd.choice(["user", "assistant"]), text, rnd.random()))
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    by = {(r[0], r[1]): r for r in rows}
    kids = {(r[0], r[2]) for r in rows if r[2] is not None}
    want = {}
    for r in rows:
        if (r[0], r[1]) not in kids:
            path, at = [], r
            while at:
                path.append(at)
                at = by.get((at[0], at[2]))
            want[r[0], r[1]] = path[::-1]
    out = chat.format_trees(df, score="score")
    full = out.select("tree", "leaf", "branch_rank", "branch_score", chat.read_back(F.col("formatted")).alias("turns"),
                      chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert {(r.tree, r.leaf) for r in full} == set(want)
    for r in full:
        path = want[r.tree, r.leaf]
        assert [tuple(t) for t in r.turns] == [(n[3], n[4]) for n in path]
        assert r.loss == "".join(n[4] for n in path if n[3] == "assistant")
        assert r.branch_score == pytest.approx(sum(n[5] for n in path) / len(path))
    best = {(r.tree, r.leaf) for r in full if r.branch_rank <= 2}
    assert {(r.tree, r.leaf) for r in chat.format_trees(df, score="score", branches=2).collect()} == best


def test_escapes_round_trip(spark):
    texts = ["\\", "\\\\n", "</s>", "<s>[INST] <<SYS>> x <</SYS>> [/INST]", "<|im_start|>user\nhi<|im_end|>\n", "<", "a\nb", "", "$1 \\1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.select("i", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("b")).orderBy("i").collect()
    assert [r.b for r in out] == texts
    assert not any(c in r.e for r in out for c in ("</s>", "<s>", "[INST]", "[/INST]", "<|", "<<SYS>>"))
