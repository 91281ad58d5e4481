import numpy as np

from wayforge.llm.local_descriptors import _agreeing, _Block, _box, candidates, consensus, describe, describe_all, describe_media, edited, from_image, image_copies, media_of, op9_local_descriptors, render, to_image


def vector(seed):
    return np.random.default_rng(seed).normal(size=64)


def test_images_round_trip():
    x = render(vector(1))
    assert (from_image(to_image(x)) == x).all()
    assert from_image(b"P5 9 9 255\nxx") is None and from_image(None) is None and from_image(b"") is None


def test_descriptors_survive_edits():
    found = []
    for seed in range(20):
        x = render(vector(seed))
        for k in range(4):
            (p, a), (q, b) = describe(x.astype(np.float32)), describe(edited(x, k).astype(np.float32))
            near = np.argwhere(np.bitwise_count(a[:, None] ^ b[None]).sum(-1) <= 28)
            found.append(len(near) > 0 and consensus(p, q, near) >= 5)
    assert np.mean(found) >= 0.9


def test_copies_that_verification_accepts_are_joined(spark):
    """Blurred, noisy and recompressed copies: those that a comparison of all corners links must meet in the tables."""
    rows, want = [], []
    for i in range(60):
        x = render(vector(i)).astype(np.float32)
        rng = np.random.default_rng(i)
        noisy = x + rng.normal(size=x.shape) * 12
        y = (_box(x, 1), noisy, np.rint(noisy / 24) * 24)[i % 3]
        y = np.clip(y, 0, 255).astype(np.uint8)
        rows += [(2 * i, to_image(x)), (2 * i + 1, to_image(y))]
        (p, a), (q, b) = describe(x), describe(y.astype(np.float32))
        near = np.argwhere(np.bitwise_count(a[:, None] ^ b[None]).sum(-1) <= 28)
        if len(near) >= 5 and consensus(p, q, near) >= 5:
            want.append(i)
    got = {r.media_id: r.class_id for r in image_copies(spark.createDataFrame(rows, "media_id long, image binary")).collect()}
    recall = np.mean([got[2 * i] == got[2 * i + 1] for i in want])
    assert len(want) >= 40 and recall >= 0.98


def test_other_images_do_not_match():
    sets = [describe(render(vector(s)).astype(np.float32)) for s in range(30)]
    for i, (p, a) in enumerate(sets):
        for q, b in sets[:i]:
            near = np.argwhere(np.bitwise_count(a[:, None] ^ b[None]).sum(-1) <= 28)
            assert len(near) < 4 or consensus(p, q, near) < 4


def test_edge_cases(spark):
    x, y = render(vector(1)), render(vector(2))
    rows = [(4, to_image(x)), (4, to_image(x)), (2, to_image(np.rot90(x))), (9, to_image(y)), (10, None), (11, b"junk"), (12, b"junk"), (None, to_image(y)), (13, to_image(np.zeros((200, 300), np.uint8))), (14, b"")]
    media = spark.createDataFrame(rows, "media_id long, image binary")
    got = sorted(((r.media_id, r.class_id) for r in image_copies(media.selectExpr("*", "1 as class_id")).collect()), key=str)
    assert got == sorted([(4, 2), (4, 2), (2, 2), (9, 9), (10, 10), (11, 11), (12, 11), (None, None), (13, 13), (14, 14)], key=str)
    assert image_copies(media.limit(0)).count() == 0


def test_query_finds_each_vectors_copy(spark, sf_dir):
    got = {r.media_id: r.class_id for r in op9_local_descriptors(spark, sf_dir).collect()}
    ids = [m // 2 for m in got if m % 2 == 0]
    assert np.mean([got[2 * i] == got[2 * i + 1] for i in ids]) >= 0.9
    vectors = {r.vec_id: tuple(r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    assert np.mean([vectors[m // 2] == vectors[c // 2] for m, c in got.items()]) >= 0.99


def test_media_table_is_whole(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert media_of(vectors).count() == 2 * vectors.count()


def test_recall_over_crops(spark):
    """Crops down to half of the picture, joined by the tables."""
    boxes = {"70 x 70": (70, 70), "80 x 56": (80, 56), "60 x 60": (60, 60), "57 x 57": (57, 57)}
    for name, (h, w) in boxes.items():
        rows = []
        for i in range(40):
            x = render(vector(500 + i))
            top, left = (int(v) for v in np.random.default_rng(i).integers(0, [81 - h, 81 - w]))
            rows += [(2 * i, to_image(x)), (2 * i + 1, to_image(x[top : top + h, left : left + w]))]
        got = {r.media_id: r.class_id for r in image_copies(spark.createDataFrame(rows, "media_id long, image binary")).collect()}
        recall = np.mean([got[2 * i] == got[2 * i + 1] for i in range(40)])
        assert recall >= 0.9, (name, recall)
        assert all(c // 2 == m // 2 for m, c in got.items())


def test_copies_behind_an_unrelated_image_of_the_same_keys_are_found(spark):
    """Picture 1 has the left half of 2 and 3 beside an own right half, but too few places in common with any of them."""
    x = render(vector(60))
    patch = np.full((80, 80), 128, np.uint8)
    patch[20:48, 20:48] = x[26:54, 26:54]
    rows = [(0, to_image(patch)), (5, to_image(x)), (9, to_image(np.clip(x.astype(int) + 3, 0, 255).astype(np.uint8)))]
    rows += [(20 + i, to_image(render(vector(70 + i)))) for i in range(3)]
    got = {r.media_id: r.class_id for r in image_copies(spark.createDataFrame(rows, "media_id long, image binary"), least=9).collect()}
    assert got[5] == got[9] and got[20] == 20 and got[21] == 21


def test_large_ids_and_odd_vectors(spark):
    rows = [(1 << 62, [0.1, None, 0.5]), (-(1 << 62) - 1, []), (None, [1.0]), (7, None), (8, [float("nan")])]
    media = media_of(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert media.count() == 10 and image_copies(media).count() == 10


def test_all_links_among_copies_are_counted(spark):
    """Four edits of each picture are linked with each other, not only with the smallest."""
    rows, want = [], {}
    for i in range(12):
        x = render(vector(300 + i))
        noise = np.random.default_rng(i).integers(-4, 5, x.shape)
        some = [x, np.clip(x.astype(int) + 3, 0, 255).astype(np.uint8), np.rot90(x), np.clip(x + noise, 0, 255).astype(np.uint8)]
        rows += [(10 * i + k, to_image(y)) for k, y in enumerate(some)]
        found = [describe(y.astype(np.float32)) for y in some]
        for k, (p, a) in enumerate(found):
            near = [np.argwhere(np.bitwise_count(a[:, None] ^ b[None]).sum(-1) <= 28) for _, b in found]
            want[10 * i + k] = sum(j != k and consensus(p, found[j][0], near[j]) >= 5 for j in range(4))
    got = {r.media_id: r.n_links for r in image_copies(spark.createDataFrame(rows, "media_id long, image binary")).collect()}
    assert sum(want.values()) >= 130 and got == want


def test_cut_slices_give_the_same_pairs(spark):
    rows = [(3 * i + k, to_image(render(vector(400 + i))[k : 70 + k, : 80 - k])) for i in range(20) for k in range(3)]
    features = describe_media(spark.createDataFrame(rows, "media_id long, image binary").repartition(6)).cache()
    whole = {tuple(r) for r in candidates(features, 28).collect()}
    assert {(3 * i + a, 3 * i + b) for i in range(20) for a, b in ((0, 1), (0, 2), (1, 2))} <= whole
    assert {tuple(r) for r in candidates(features, 28, slice_size=100, most=60).collect()} == whole
    features.unpersist()


def test_images_described_together_are_as_alone():
    images = [render(vector(i)).astype(np.float32)[: 80 - i % 3, : 80 - i % 2] for i in range(30)]
    images += [None, np.zeros((1, 1), np.float32), np.zeros((60, 200), np.float32)]
    for x, (p, d) in zip(images, describe_all(images)):
        q, e = describe(x) if x is not None else (np.zeros((0, 4)), np.zeros((0, 32)))
        assert (p == q).all() and (d == e).all() and len(p) == len(d)


def _blocks(seed):
    """Two blocks of pictures whose corners crowd in a few runs, and all their pairs by comparison of every corner with every other."""
    rng = np.random.default_rng(seed)
    kinds = rng.integers(0, 256, (6, 32), np.uint8)
    out = []
    for first in (0, 40):
        rows = []
        for i in range(first, first + 40):
            flips = np.packbits(rng.random((int(rng.integers(1, 9)), 256)) < 0.05, axis=1)
            rows.append((i, kinds[rng.integers(0, 6, len(flips))] ^ flips))
        out.append(rows)
    return out


def _packed(rows):
    return _Block([(np.asarray([i]).tobytes(), np.asarray([len(d)]).tobytes(), d.tobytes()) for i, d in rows])


def test_blocks_meet_as_all_pairs_do():
    """Every pair of which two corners each agree on a run and are near, whatever is held at once, comes once."""
    for seed in range(3):
        left, right = _blocks(seed)
        for some, other in ((left, right), (left, left)):
            want = set()
            for i, a in some:
                for j, b in other:
                    runs = (a.view(np.uint32)[:, None] == b.view(np.uint32)[None]).any(-1)
                    x, y = np.nonzero(runs & (np.bitwise_count(a[:, None] ^ b[None]).sum(-1) <= 28))
                    if len(np.unique(a[x], axis=0)) > 1 and len(np.unique(b[y], axis=0)) > 1 and (some is not other or i < j):
                        want.add((i, j))
            u = _packed(some)
            v = u if some is other else _packed(other)
            for part, most in ((10_000, 1 << 20), (10, 1 << 20), (10_000, 5)):
                got = [(int(u.ids[x]), int(v.ids[y])) for at in _agreeing(u, v, 28, part, most) for x, y in zip(*at)]
                assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_runs_of_many_corners_meet_as_small_ones_do(spark):
    """Hundreds of near corners of one run in each of two blocks: tables of differences, cut by their size."""
    rng = np.random.default_rng(5)
    kind = rng.integers(0, 256, 32, np.uint8)
    rows = [(i, kind ^ np.packbits((rng.random((2, 256)) < 0.06) & (np.arange(256) >= 32), axis=1)) for i in range(600)]
    want = set()
    for i, a in rows:
        for j, b in rows[i + 1 :]:
            x, y = np.nonzero(np.bitwise_count(a[:, None] ^ b[None]).sum(-1) <= 28)
            if len(set(x)) == 2 and len(set(y)) == 2:
                want.add((i, j))
    table = spark.createDataFrame([(i, d.tobytes()) for i, d in rows], "media_id long, descriptors binary")
    for sizes in ({}, {"slice_size": 300, "most": 500}):
        got = [tuple(r) for r in candidates(table, 28, **sizes).collect()]
        assert len(want) > 10_000 and len(got) == len(want) and set(got) == want


def test_only_pairs_leave_the_tasks_in_which_corners_meet(spark):
    """Corners are shuffled once, to where their blocks meet: near corners of pairs are not sent on to be counted."""
    rows = [(i, to_image(render(vector(800 + i)))) for i in range(6)]
    plan = candidates(describe_media(spark.createDataFrame(rows, "media_id long, image binary")), 28)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan
