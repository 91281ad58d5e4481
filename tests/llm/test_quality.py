import numpy as np

from wayforge.llm.quality import FEATURES, features_of, fit_quality, fit_trees, op8_quality, score_quality


def slow(trees, row):
    total = trees.start
    for root in trees.roots:
        at = root
        while trees.feature[at] >= 0:
            at = trees.left[at] + int(row[trees.feature[at]] > trees.threshold[at])
        total += trees.value[at]
    return 1 / (1 + np.exp(-total))


def test_flat_traversal_equals_walking():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = fit_trees(x, y, trees=20)
    assert np.allclose(trees.score(x[:100]), [slow(trees, r) for r in x[:100]])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95


def test_splits_and_leaves_equal_an_exhaustive_search():
    """Each tree of depth one against all thresholds that the bins allow, tried one by one."""
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(300, 4)), 1)
    y = (x[:, 2] + 0.5 * x[:, 0] + rng.normal(size=300) > 0.3).astype(float)
    trees, rate, l2, least, bins = fit_trees(x, y, trees=12, depth=1, bins=16), 0.15, 1.0, 10, 16
    raw = np.full(300, trees.start)
    for root in trees.roots:
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        best = (0.0, None, None)
        for f in range(4):
            for t in np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])):
                right = x[:, f] > t
                if min(right.sum(), (~right).sum()) >= least:
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + l2) for s in (right, ~right)) - g.sum() ** 2 / (h.sum() + l2)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, t)
        f, t = int(trees.feature[root]), trees.threshold[root]
        right = x[:, f] > t
        got = sum(g[s].sum() ** 2 / (h[s].sum() + l2) for s in (right, ~right)) - g.sum() ** 2 / (h.sum() + l2)
        assert abs(got - best[0]) < 1e-6
        for side, node in ((~right, trees.left[root]), (right, trees.left[root] + 1)):
            assert abs(trees.value[node] + rate * g[side].sum() / (h[side].sum() + l2)) < 1e-9
            raw[side] += trees.value[node]


def test_one_label_or_no_rows():
    assert fit_trees(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert fit_trees(np.ones((9, 3)), np.ones(9)).score(np.ones((1, 3)))[0] > 0.8


def test_features_do_not_depend_on_the_batch():
    texts = [b"", b"   ", b"One two. Three!\nOne two. Three!", b"A A A A A A", b"x" * 3_000_000, "é ü\n".encode() * 10]
    every = features_of(texts)
    assert every.shape == (len(texts), len(FEATURES)) and np.isfinite(every).all()
    for t, row in zip(texts, every):
        assert np.allclose(features_of([t])[0], row)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "good words here.", 3), (1, "good words here.", 3), (2, None, 3), (3, "", 3), (None, "z z z z", 3)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    got = score_quality(docs, fit_quality(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert score_quality(docs.limit(0), fit_quality(docs.limit(0), labels)).count() == 0
    many = docs.union(spark.createDataFrame([(1, f"text {i}", 3) for i in range(300)], docs.schema))
    assert fit_quality(many, labels, max_labelled=3).start == fit_quality(many.orderBy("text"), labels, max_labelled=3).start


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "quality")
    rows = op8_quality(spark, d).where("held_out").join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert np.mean([r.predicted == 0 for r in bad]) > 0.8 and np.mean([r.predicted == 1 for r in good]) > 0.97
