"""The language model: both factors follow their context, add up, and make the score."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from unifeed.llm import maxent
from unifeed.llm import words as wd


def held_ids(n, held=True):
    return [i for i in range(20 * n + 100) if (zlib.crc32(str(i).encode()) % 7 == 2) is held][:n]


@pytest.mark.parametrize("fillers", [30, 2200])      # with 2,200 the words before are not among the 2,048 most frequent
def test_words_within_a_class_follow_their_context(spark, fillers):
    fill = " ".join(f"f{i} f{i}" for i in range(fillers))
    train = [(i, f"{('bleft walking', 'cleft talking')[k % 2]} {fill}") for k, i in enumerate(held_ids(1200 if fillers < 100 else 80, False))]
    asked = [f"{a} {b} f0" for a in ("bleft", "cleft") for b in ("walking", "talking")]
    rows = train + list(zip(held_ids(4), asked))
    out = {r.doc_id: r for r in maxent.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    got = {t: out[i] for i, t in zip(held_ids(4), asked)}
    assert all(r.held_out and r.n_known == 4 for r in got.values()) and len({r.base_score for r in got.values()}) == 1
    assert got["bleft walking f0"].score > got["bleft talking f0"].score + 0.3      # twice as likely
    assert got["cleft talking f0"].score > got["cleft walking f0"].score + 0.3


@pytest.fixture
def fitted(spark, monkeypatch):
    monkeypatch.setattr(maxent, "HEAD", 64)           # most words are leaves by bucket
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id < 60").cache()
    train = df.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 7) <> 2")
    model, words, tail, _, types = maxent.fit(train, rounds=2, seed_col="doc_id")
    model.w, model.words = (maxent._unpack(*maxent._pack(x)) for x in (model.w, model.words))
    assert tail.count() > 1000 and types == words.count()
    return df, model, {r.key % 2 ** 64: (r.ending, r.n) for r in words.collect()}


def test_probabilities_add_up_over_the_vocabulary(fitted):
    _, m, words = fitted
    keys = np.array(list(words), dtype=np.uint64)
    n = np.array([words[k][1] for k in words], dtype=float)
    ending = np.array([words[k][0] for k in words])
    place = m.find(keys)
    rank = m.rank[place]
    cls = np.where(ending < 0, 0, 1 + maxent.OWN + m.groups[np.maximum(ending, 0)])
    own = (rank < maxent.OWN) & (ending >= 0)
    cls[own] = 1 + rank[own]
    tail = maxent.bucket(cls, keys)
    leaf = np.where(place >= 0, m.leaf[place], m.tail[tail])
    assert ((leaf >= 0) == (cls > maxent.OWN)).all()
    for seed in range(5):
        feats = wd.randoms(4, seed + 1)[:, None]
        every = np.repeat(feats, len(keys), axis=1)
        within = np.where(leaf >= 0, np.exp(m.log_word(every, leaf) + m.seen[cls]), 1.0)
        within *= np.where(place < 0, (n + 1) / np.maximum(m.tail_mass[tail], 1), 1.0)
        classes = np.exp(m.log_classes(m.rows(feats))[0].astype(float))
        unseen = (classes * np.exp(m.unseen))[1 + maxent.OWN:].sum()
        assert (classes[cls] * within).sum() + unseen == pytest.approx(1, abs=1e-4)


def test_score_is_the_product_of_both_factors(fitted):
    df, m, words = fitted
    out = {r.doc_id: r for r in maxent.score(df, rounds=2).collect()}
    texts = {r.doc_id: r.text for r in df.collect()}
    chosen = [d for d in sorted(texts) if len(texts[d] or "") < 3000][:12]
    assert any(out[d].held_out for d in chosen) and any(not out[d].held_out for d in chosen)

    def softmax(z, i):
        z = [float(x) for x in z]
        return z[i] - max(z) - np.log(sum(np.exp(x - max(z)) for x in z))

    for d in chosen:
        total = 0.0
        for _, rows, h, ending, row in maxent.texts(pa.array([texts[d]])):
            cls, feats, place, _, leaf = m.tokens(h, ending, row, rows)
            for i in range(len(cls)):
                c, f = cls[i], feats[:, i]
                logp = softmax(m.bias + sum(m.w[(k << m.bits) + (int(f[k]) >> 64 - m.bits)] for k in range(4)), c)
                if i < len(h) and place[i] < 0 and int(h[i]) not in words:
                    total += logp + m.unseen[c]
                    continue
                if leaf[i] >= 0:
                    logp += m.seen[c]
                    for s in range(m.before[leaf[i]], m.before[leaf[i] + 1]):
                        node, bits = m.node[s], m.bits + maxent.WORD_BITS
                        at = [(k << bits) + ((int(f[k]) ^ int(m.node_hash[node])) * int(maxent._ODD) % 2 ** 64 >> 64 - bits) for k in range(4)]
                        logp += softmax(m.shares[node] + sum(m.words[a] for a in at), m.child[s])
                if i < len(h) and place[i] < 0:
                    logp += np.log((words[int(h[i])][1] + 1) / m.tail_mass[maxent.bucket(c, h[i])])
                total += logp
        assert out[d].score == pytest.approx(total / np.log(10), rel=2e-3)


def test_trees_reach_every_leaf_once():
    rng = np.random.default_rng(2)
    cls = np.repeat([3, 5, 9], [1, 40, 3000])
    mass = np.ceil(3000 / rng.permutation(np.arange(1, len(cls) + 1)))
    before, node, child, shares = maxent.trees(cls, mass)
    paths = [tuple(zip(node[a:b], child[a:b])) for a, b in zip(before[:-1], before[1:])]
    assert paths[0] == () and len(set(paths)) == len(paths)
    assert not any(a != b and a == b[:len(a)] for a in paths[1:200] for b in paths[1:])     # no leaf on the way to another
    share = [np.exp(sum(float(shares[n, c]) for n, c in p)) for p in paths]
    for c in (5, 9):
        assert np.array(share)[cls == c] == pytest.approx(mass[cls == c] / mass[cls == c].sum(), rel=1e-4)
    big = cls == 9
    assert np.diff(before)[big][np.argmax(mass[big])] <= 2 < np.diff(before)[big].max()
