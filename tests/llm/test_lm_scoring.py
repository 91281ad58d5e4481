import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from wayforge.llm import lm_scoring
from wayforge.llm.lm_scoring import decode, decode_keys, encode, encode_keys, fit_weights, op5_lm_scores, score_texts


def words(text):
    return (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()


def base(rows):
    """(n_tokens, n_known, N, base score) of each (text, held_out)."""
    counts = Counter(t for text, held in rows if not held for t in [*words(text), 0])
    n, v = sum(counts.values()), len(counts)
    out = []
    for text, _ in rows:
        tokens = [*words(text), 0]
        out.append((len(tokens), sum(t in counts for t in tokens), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)))
    return out


def test_codecs():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    assert (decode_keys(encode_keys(keys)) == keys).all() and len(decode_keys(encode_keys(keys[:0]))) == 0
    counts = np.arange(70_000, dtype=np.uint32)
    assert (decode(encode(counts), np.uint32) == counts).all()


def test_weights_go_to_the_better_estimate():
    cells = pd.DataFrame({"cell": [40 << 15, (40 << 15) + 1, 5 << 15], "n": [100.0, 50.0, 80.0], "p3": [90.0, 40.0, 0.0], "p2": [1.0, 1.0, 60.0], "p1": [0.1, 0.1, 0.1]})
    w = fit_weights(cells, 1000)
    assert w[40].argmax() == 0 and w[5].argmax() == 1 and np.allclose(w.sum(1), 1) and (w > 0).all()


def test_base_is_exact_and_model_is_a_distribution(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PACK_BYTES", 300)
    monkeypatch.setattr(lm_scoring, "BLOCK_KEYS", 100)
    texts = ["a b c a b d", "A b c", "", None, "a b e\n f\tb c", "z " * 5000] * 6
    rows = [(i, t, i % 5 == 4) for i, t in enumerate(texts)] + [(None, "a b c", None), (1, "A b c", False)]
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()
    assert len(got) == len(rows)
    want = sorted((n, k, t, round(b, 6)) for n, k, t, b in base([(t, bool(h)) for _, t, h in rows]))
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


@pytest.mark.parametrize("fan", [4096, 3])
def test_brute_force_model(spark, monkeypatch, fan):
    """The model's score from plain dictionaries, with the learnt weights read back; also in three levels of ranges."""
    if fan == 3:
        monkeypatch.setattr(lm_scoring, "PACK_BYTES", 1500)
        monkeypatch.setattr(lm_scoring, "BLOCK_KEYS", 300)
        monkeypatch.setattr(lm_scoring, "FAN", fan)
    seen = {}
    real = lm_scoring.fit_weights
    lm_scoring.fit_weights = lambda *a, **k: seen.setdefault("w", real(*a, **k))
    try:
        rng = np.random.default_rng(4)
        rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 60) % 40), i % 7 == 0) for i in range(80)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
        from pyspark.sql import functions as F

        deleted = {r.doc_id for r in frame.where("not held_out").where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(10)) == 0).collect()}
        got = {r.doc_id: r.score for r in score_texts(frame).collect()}
    finally:
        lm_scoring.fit_weights = real
    one, two, three = Counter(), Counter(), Counter()
    for i, t, held in rows:
        if not held and i not in deleted:
            s = ["B", "B", *t.split(), "E"]
            one.update(s[1:])
            two.update(zip(s, s[1:]))
            three.update(zip(s, s[1:], s[2:]))
    distinct = len({w for _, t, h in rows if not h for w in [*t.split(), "E"]})
    n = sum(c for w, c in one.items() if w != "B")
    for i, t, _ in rows:
        s, total = ["B", "B", *t.split(), "E"], 0.0
        for u, v, w in zip(s, s[1:], s[2:]):
            b = int(lm_scoring.buckets(np.asarray([two[u, v]]), np.asarray([one[v]]))[0])
            p = (three[u, v, w] / two[u, v] if two[u, v] else 0, two[v, w] / one[v] if one[v] else 0, one[w] / n, 1 / (distinct + 1))
            total += math.log10(float(np.dot(seen["w"][b], p)))
        assert math.isclose(total, got[i], rel_tol=1e-9)


def test_rows_of_a_pack_do_not_grow(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PACK_BYTES", 400)
    for copies in (20, 80):
        rows = [(i, f"a b c d{i} e{i % 7}", 1) for i in range(copies * 20)]
        packs = lm_scoring.pack_texts(spark.createDataFrame(rows, "doc_id long, text string, role int"))
        fan = lm_scoring.levels(copies * 4, 8)
        assert fan <= 8 and lm_scoring.requests(packs, fan).groupBy("unit").count().agg({"count": "max"}).first()[0] == fan
    assert [lm_scoring.levels(b, 4096) for b in (1, 57, 4096, 4097, 1 << 24)] == [1, 57, 4096, 65, 4096]


def test_places():
    keys = lm_scoring.distinct(np.random.default_rng(2).integers(0, 1 << 52, 3000).astype(np.uint64))
    want = np.random.default_rng(3).permutation(np.r_[keys, keys])
    assert (keys[lm_scoring.places(keys, want, 52)] == want).all()
    assert len(lm_scoring.places(keys, want[:0], 52)) == 0 and lm_scoring.places(keys[:1], keys[:1], 52).tolist() == [0]


def test_model_beats_base_on_held_out_and_empty(spark, sf_dir):
    got = op5_lm_scores(spark, sf_dir).where("held_out").groupBy().sum("score", "base_score").first()
    assert got[0] > got[1]
    assert score_texts(spark.createDataFrame([], "doc_id long, text string, held_out boolean")).count() == 0
    assert score_texts(spark.createDataFrame([(1, "a b", True)], "doc_id long, text string, held_out boolean")).first().train_tokens == 0
