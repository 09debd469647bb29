"""Hard negatives, secret scans and periodic runs against SQL, brute force and odd rows."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from unifeed.llm import hardneg, periods, secretscan
from unifeed.llm.automaton import compile_patterns
from unifeed.llm.queries_scans import repeat_tail

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_secret_scan", "op13_periodic_runs"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    out = E.queries()[name](spark, SF)
    assert sorted(out.columns) == sorted(cols)
    assert sorted(map(tuple, out.select(*cols).collect()), key=repr) == sorted(rel.fetchall(), key=repr)


# -- automaton ----------------------------------------------------------------------------

PATTERNS = ["ab*c", "(a|bc)+d?", "[ab]{2,3}c", "a[^b]c|cab", "(ab?){2}", "c{2,}a"]


def accepted(a, data: bytes) -> list[tuple[int, tuple[int, ...]]]:
    s, out = 0, []
    for i, b in enumerate(data):
        s = int(a.step[s, a.classes[b]])
        if a.accepts[s]:
            out.append((i + 1, a.accepts[s]))
    return out


def test_automaton_accepts_what_the_regexes_do():
    rng = random.Random(1)
    anchored = compile_patterns([(p, False) for p in PATTERNS], anywhere=False)
    search = compile_patterns([(p, False) for p in PATTERNS], anywhere=True)
    for _ in range(400):
        text = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))
        whole = [(e, ks) for e in range(1, len(text) + 1)
                 if (ks := tuple(k for k, p in enumerate(PATTERNS) if re.fullmatch(p, text[:e])))]
        ends = [(e, ks) for e in range(1, len(text) + 1)
                if (ks := tuple(k for k, p in enumerate(PATTERNS) if any(re.fullmatch(p, text[s:e]) for s in range(e))))]
        assert accepted(anchored, text.encode()) == whole and accepted(search, text.encode()) == ends


def test_automaton_is_minimal_and_rejects_bad_patterns():
    assert len(compile_patterns([("a|aa|aaa", False)], False).accepts) == 5      # 0 to 3 letters and the dead state
    assert len(compile_patterns([("(x|y)z|xw|yw", True)], False).accepts) == 4
    for bad in ("(a", "a)", "\\d", "[é]"):
        with pytest.raises(ValueError):
            compile_patterns([(bad, False)], False)


# -- secret scans -------------------------------------------------------------------------

TOKENS = ["token", "Secret", "api_key", "APIkey", "=", ":", " ", '"', "'", "AKIA", "A", "Z9", "abc", "0123456789abcdef", "f",
          "passwd", "password", "-", "/", "é", "xyz123", ".", "eyJ", "eyJab", "ghp_", "_", "a1" * 20, "B2" * 9, "\n",
          "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "xoxb-", "AIza", "sk_live_"]


def by_regex(text: str) -> list[tuple[str, int, int]]:
    out = []
    for n, r in enumerate(secretscan.RULES):
        head = f"(?ai:{r.head})" if r.any_case else f"(?:{r.head})"
        for m in re.finditer(f"{head}({r.body + '+' if r.body else ''})", text):
            if len(m[m.re.groups]) >= r.least:
                out.append((m.start(), n, m.end()))
    return [(secretscan.RULES[n].kind, a, b) for a, n, b in sorted(out)]


def test_spans_equal_the_regexes(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(TOKENS) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["0" * 30_000, "token=" * 3000 + "a" * 20, "é" * 5000 + "AKIA" + "Q" * 5000, "eyJ" * 2000 + "." + "eyJa" * 9 + "." + "b" * 30]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secretscan.scan(rows).collect()}
    assert len(got) == len(texts) and sum(map(len, got.values())) > 1000
    for i, t in enumerate(texts):
        assert got[i] == by_regex(t), t[:200]


def test_secret_scan_odd_rows(spark):
    rows = spark.createDataFrame([(None, "AKIA0123456789ABCD"), (1, None), (1, ""), (2, " \n"), (2, " \n")],
                                 "doc_id long, text string").withColumn("kind", F.lit("x"))
    out = sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in secretscan.scan(rows).collect()), key=repr)
    assert out == sorted([(None, [("access", 0, 18)]), (1, []), (1, []), (2, []), (2, [])], key=repr)
    assert secretscan.scan(rows.limit(0)).count() == 0
    only = [secretscan.Rule("date", "[0-9]{4}-[0-9]{2}-", "[0-9]", 2)]
    assert [tuple(s) for s in secretscan.scan(spark.createDataFrame([(1, "on 2025-10-01.")], "doc_id int, text string"),
                                              rules=only).first().spans] == [("date", 3, 13)]


# -- periodic runs ------------------------------------------------------------------------

def brute_runs(w, least=12, times=2):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            first = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - first + q >= max(least, times * q):
                out.setdefault((first - q, i - first + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in out.items())


def test_runs_equal_brute_force():
    rng, seen = random.Random(3), 0
    for _ in range(4000):
        w = []
        for _ in range(rng.randint(1, 5)):
            u = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 9))]
            w += (u * rng.randint(1, 8))[:rng.randint(1, 60)]
        w = w * rng.randint(1, 3)
        expected = brute_runs(w)
        seen += len(expected)
        assert periods.runs(w) == expected, w
        least, times = rng.choice([(4, 2), (7, 3), (2, 2), (20, 2)])
        assert periods.runs(w, least, times) == brute_runs(w, least, times), (w, least, times)
    a, b = "a", "ab"
    for _ in range(12):                              # runs of many periods that overlap for long
        a, b = b, b + a
    assert periods.runs(list(b)) == brute_runs(list(b)) and seen > 4000


def test_run_shapes_that_would_be_quadratic():
    assert periods.runs(["x"] * 60_000) == [(0, 60_000, 1)]
    assert periods.runs((["a"] * 30 + ["b"]) * 1000)[-1][1:] == (30, 1) and len(periods.runs((["a"] * 30 + ["b"]) * 1000)) == 1001
    assert periods.runs([str(i) for i in range(50_000)] * 2) == [(0, 100_000, 50_000)]


def test_periodic_runs_odd_rows(spark):
    said = "one  two\n" * 7
    rows = spark.createDataFrame([(None, said), (1, None), (1, ""), (2, said + "end"), (2, said + "end"), (3, "b " * 11), (4, " ")],
                                 "doc_id long, text string").withColumn("runs", F.lit(1))
    out = {}
    for r in periods.detect(rows).collect():
        out.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert out == {None: [(14, [(0, 14, 2)], "one two")], 1: [(0, [], "")] * 2, 2: [(15, [(0, 14, 2)], "one two end")] * 2,
                   3: [(11, [], " ".join("b" * 11))], 4: [(0, [], "")]}
    assert periods.detect(rows.limit(0)).count() == 0
    assert repeat_tail(None, ["a"] * 5) == ["a"] * 5 and repeat_tail(7, []) == []


# -- hard negatives -----------------------------------------------------------------------

def brute_negatives(rows, every):
    ok = [(i, y, [int(np.floor(256 * float(x))) for x in v]) for i, y, v in rows
          if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    pad = max((len(v) for _, _, v in ok), default=0)
    ok = list(dict.fromkeys((i, y, tuple(v + [0] * (pad - len(v)))) for i, y, v in ok))
    out = []
    for i, y, v in ok:
        if i % every:
            continue
        score = sorted({(-sum(a * b for a, b in zip(v, w)), j, y == z) for j, z, w in ok if j != i})
        for s, j, _ in [x for x in score if x[2]][:5]:
            near = [(t, k) for t, k, mate in score if not mate and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k) in enumerate(near)]
    return sorted(out)


def vectors(rng, n, dims, labels):
    base = rng.standard_normal((12, dims))
    x = base[rng.integers(0, 12, n)] + rng.standard_normal((n, dims)) * rng.choice([0.05, 0.5, 1.5], n)[:, None]
    x[rng.integers(0, n, n // 10)] = x[0]            # ties
    return [(int(i), int(y), [float(np.float32(a)) for a in v]) for i, (y, v) in enumerate(zip(rng.integers(0, labels, n), x))]


def collected(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("dims,labels,block", [(64, 10, 1 << 24), (70, 2, 20_000), (3, 3, 4000)])
def test_hard_negatives_equal_brute_force(spark, dims, labels, block):
    rows = vectors(np.random.default_rng(dims), 600, dims, labels)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(5).withColumn("id", F.lit("x"))
    expected = brute_negatives(rows, 20)
    assert len(expected) > 100 and collected(hardneg.mine(df, every=20, block_bytes=block)) == expected


def test_hard_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 2, [1.0, 1.9]), (2, 2, [1.0, 1.9]), (3, 2, [2.2]),
            (4, 2, []), (5, None, [1.0, 2.0]), (None, 2, [1.0, 2.0]), (6, 2, None), (7, 2, [1.0, None]), (8, 2, [1.0, nan]),
            (9, 2, [inf, 2.0]), (20, 2, [-1.0, -1.0]), (40, 3, [1.0, 1.0]), (0, 1, [1.0, 2.0]), (0, 2, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for x in ("id", "label2", "score", "key", "rank", "v"):
        df = df.withColumn(x, F.lit("x"))
    assert collected(hardneg.mine(df, every=20)) == brute_negatives(rows, 20)
    assert hardneg.mine(df.limit(0)).count() == 0 and hardneg.mine(df.where("vec_id = 1")).count() == 0
    big = spark.createDataFrame([(0, 1, [1e30, 1.0]), (1, 1, [1e30, 1.0]), (2, 2, [9e29, 1.0])], "vec_id long, label int, embedding array<double>")
    assert [r.negative_id for r in hardneg.mine(big).collect()] == [2]


def test_intervals_hold_the_truth_and_spare_work():
    rng = np.random.default_rng(5)
    ints = rng.integers(-100, 100, (4000, 96))
    turn = hardneg.rotation(96)
    code, align, coded, rest = hardneg.encode(ints.astype(float), turn)
    rows = hardneg.Rows.__new__(hardneg.Rows)
    rows.id, rows.ints, rows.code, rows.align, rows.coded, rows.rest = np.arange(4000), ints, code, align, coded, rest
    rows.ones = np.bitwise_count(code).sum(axis=2, dtype=np.int64)
    block = hardneg.Anchors(np.arange(50), np.zeros(50), ints[:50], turn)
    est, width = block.interval(slice(0, 50), rows, slice(0, 4000))
    truth = ints[:50] @ ints.T
    assert (np.abs(truth - est) <= width).all()
    fifth = np.sort(truth - np.eye(50, 4000) * 1e9, axis=1)[:, -5][:, None]
    assert (est + width >= fifth).mean() < 0.25
