"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from unifeed.llm import chat, decontam, fingerprints, licenses, linededup, maxent, mixing, neardup, quality, toxicity

LONG = " ".join(f"w{i}" for i in range(30_000))
SAME = "\n".join(" ".join(f"a{i}b{j}" for j in range(30)) for i in range(3))
# extra columns named like what the operators use inside or return
CLASH = ["id", "h", "k", "i", "c", "c2", "key", "node", "sig", "size", "t", "u", "n", "score", "pattern", "target",
         "copies", "keep", "posterior", "lines", "bucket", "near", "label", "comp", "df", "t_id", "y", "q", "taken"]
ROWS = [(1, SAME, "s1", "en"), (1, SAME, "s1", "en"), (2, SAME, None, None), (3, None, "s2", "en"), (4, "", "s2", None),
        (None, "one two", "s1", "en"), (None, LONG, None, "de"), (7, " \t\n ", "s2", "en"), (8, "one two", "s1", "en"),
        (9, LONG + " end", "s1", "de")]
SCHEMA = "doc_id long, text string, source string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASH:
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None), (99, 0, 1)],
                                 "doc_id long, quality int, toxic int")


def runs(spark, docs, labels):
    items = spark.createDataFrame([(5, " ".join(SAME.split()[3:28])), (6, None), (7, ""), (None, "x"), (8, "one two")],
                                  "item_id long, text string").withColumn("gram", F.lit(0))
    return {
        "decontam": lambda d: decontam.find(d, items),
        "linededup": linededup.dedup,
        "fingerprints": fingerprints.fingerprint,
        "mixing": mixing.mix,
        "maxent": maxent.score,
        "toxicity": lambda d: toxicity.score(d, labels),
        "licenses": licenses.scan,
        "quality": lambda d: quality.score(d, labels),
        "neardup": neardup.link,
    }


NAMES = ["decontam", "linededup", "fingerprints", "mixing", "maxent", "toxicity", "licenses", "quality", "neardup"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, docs, labels, name):
    assert runs(spark, docs, labels)[name](docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_nasty_rows(spark, docs, labels, name):
    out = runs(spark, docs, labels)[name](docs).collect()
    if name == "decontam":           # the rows that hold the passage, null items and ids aside
        assert sorted(r.doc_id for r in out) == [1, 1, 2] and {r.item_id for r in out} == {5}
        assert all(r.score == 1.0 and r.start_word == 3 for r in out)
        return
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ROWS)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    if name == "linededup":
        assert sorted(r.text for r in by[1]) == ["", SAME]      # the first stays, its repeat goes
        assert by[2][0].text == "" and by[2][0].removed_lines == 3
        assert by[3][0].text is None and by[3][0].lines == 0 and by[4][0].text == "" and by[7][0].text == " \t\n "
        assert by[8][0].text == "one two" and out[0].id == "x"
    if name == "fingerprints":
        assert by[1][0].fingerprint == by[2][0].fingerprint and by[3][0].fingerprint == by[4][0].fingerprint
        assert by[3][0].n_chars == 0 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    if name == "mixing":
        assert sum(r.size for r in out) == pytest.approx(sum(t for t in {r.source: r.target for r in out}.values()))
        assert all(0 <= r.taken <= 3 * r.size for r in out) and by[3][0].size == 0
    if name == "maxent":
        assert by[3][0].n_tokens == 1 and by[1][0].score == by[1][1].score
        assert all(r.score <= 0 and r.base_score < 0 for r in out)
    if name == "toxicity":
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
        assert by[3][0].score == by[4][0].score and by[1][0].score == by[1][1].score
    if name == "licenses":
        assert all(r.license is None for r in out)
    if name == "quality":
        assert all(0 <= r.posterior <= 1 and isinstance(r.keep, bool) for r in out) and out[0].id == "x"
    if name == "neardup":
        assert {r.component_id for r in by[1] + by[2]} == {1} and by[1][0].kept and not by[2][0].kept
        assert by[3][0].n_shingles == 0 and by[3][0].kept and by[7][0].kept
        short, long_ = sorted(by[None], key=lambda r: r.n_shingles)
        assert short.component_id == 8 and not short.kept and long_.component_id == 9


def test_no_labels(spark, docs, labels):
    none = labels.limit(0)
    assert all(r.keep for r in quality.score(docs, none).collect())
    rude = spark.createDataFrame([(1, "you stupid idiot"), (2, "a fine day")], "doc_id long, text string")
    assert [r.predicted for r in toxicity.score(rude, none).orderBy("doc_id").collect()] == [1, 0]


def test_chat_edges(spark):
    schema = "tree long, node long, parent long, role string, text string, x string"
    assert chat.format_trees(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, 1, None, "user", "hi", "a"), (1, 2, 1, "assistant", None, "a"), (1, 3, 1, "assistant", "<|im_end|>\n\\", "a"),
            (1, 4, 77, None, "orphan", "a"), (None, 1, None, "ro\nle\\", "[INST]", "a"),
            (2, 1, 2, "user", "cycle", "a"), (2, 2, 1, "user", "cycle", "a")]
    out = chat.format_trees(spark.createDataFrame(rows, schema))
    got = {(r.tree, r.leaf): [tuple(t) for t in r.turns] for r in out.select(
        "tree", "leaf", chat.read_back(F.col("formatted")).alias("turns")).collect()}
    assert got == {(1, 2): [("user", "hi"), ("assistant", "")], (1, 3): [("user", "hi"), ("assistant", "<|im_end|>\n\\")],
                   (1, 4): [("", "orphan")], (None, 1): [("ro\nle\\", "[INST]")]}
