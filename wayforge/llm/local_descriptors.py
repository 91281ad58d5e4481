"""Edited and cropped image copies by local descriptors: corners on several scales, rotated binary tests, Hamming-table
joins and geometric consensus."""

from __future__ import annotations

import functools
import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import Staging, mix
from wayforge.llm.graph import connected_components

#: Scales of the pyramid. On each, a corner is kept if it is the strongest within SPACE pixels, wherever it ranks in the
#: whole image: a crop keeps the corners that it shows, and larger images have more of them.
LEVELS, SPACE = (1.0, 0.75, 0.5), 5
#: Binary tests within this radius of a corner; a corner keeps so far from the border.
RADIUS, TURNS, TESTS = 9, 36, 256
#: Bits of a table's key, and so 256 / 32 tables: copies whose descriptors agree on one run of so many bits meet.
TABLE_BITS = 32
#: Pixels of the images that are described together.
PIXELS = 160_000
#: Corners of a block of images: so many are worth a cut, and the most; corners compared at once, corners of the images that
#: meet a block at once, and near corners that are held.
SLICE, MOST_SPOTS, BLOCK, PART, NEAR = 25_000, 1_200_000, 1 << 15, 250_000, 3 << 20


# -- images: binary grey maps ("P5") ---------------------------------------------------------------------------------


def to_image(pixels: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % (pixels.shape[1], pixels.shape[0]) + np.ascontiguousarray(pixels, np.uint8).tobytes()


def from_image(data: bytes | None) -> np.ndarray | None:
    """The pixels; None for what is no such image."""
    head, _, body = (data or b"").partition(b"\n")
    part = head.split()
    if len(part) != 4 or part[0] != b"P5" or not all(p.isdigit() for p in part[1:]) or part[3] != b"255":
        return None
    w, h = int(part[1]), int(part[2])
    return np.frombuffer(body, np.uint8).reshape(h, w).astype(np.float32) if len(body) == w * h and w * h else None


# -- descriptors -----------------------------------------------------------------------------------------------------


def _box(x: np.ndarray, r: int) -> np.ndarray:
    """Mean over squares of side 2 r + 1 in the last two axes, the border repeated."""
    s, k = np.pad(x, [(0, 0)] * (x.ndim - 2) + [(r + 1, r)] * 2, mode="edge"), 2 * r + 1
    if s.ndim == 2:
        s = s.cumsum(0)
    else:  # the same sums, a row of all images at a time
        for i in range(1, s.shape[-2]):
            s[..., i, :] += s[..., i - 1, :]
    s = s.cumsum(-1)
    return (s[..., k:, k:] - s[..., :-k, k:] - s[..., k:, :-k] + s[..., :-k, :-k]) / (k * k)


def _highest(x: np.ndarray, r: int) -> np.ndarray:
    """Maximum over the squares of side 2 r + 1 that lie inside of the last two axes."""
    for axis in (-2, -1):
        x, width = x.swapaxes(axis, -1), 1
        while width < 2 * r + 1:
            step = min(width, 2 * r + 1 - width)
            x, width = np.maximum(x[..., step:], x[..., :-step]), width + step
        x = x.swapaxes(axis, -1)
    return x


def _scaled(x: np.ndarray, scale: float) -> np.ndarray:
    if scale == 1:
        return x
    h, w = max(1, int(x.shape[-2] * scale)), max(1, int(x.shape[-1] * scale))
    r, c = (np.arange(h) + 0.5) / scale - 0.5, (np.arange(w) + 0.5) / scale - 0.5
    r, c = np.clip(r, 0, x.shape[-2] - 1), np.clip(c, 0, x.shape[-1] - 1)
    r0, c0 = r.astype(int), c.astype(int)
    r1, c1 = np.minimum(r0 + 1, x.shape[-2] - 1), np.minimum(c0 + 1, x.shape[-1] - 1)
    fr, fc = (r - r0)[:, None], (c - c0)[None]
    left, right = x.take(c0, -1), x.take(c1, -1)
    return (left.take(r0, -2) * (1 - fr) + left.take(r1, -2) * fr) * (1 - fc) + (right.take(r0, -2) * (1 - fr) + right.take(r1, -2) * fr) * fc


@functools.cache
def _pattern() -> np.ndarray:
    """TURNS x TESTS x 2 x 2 whole offsets: the same random pairs of points, turned step by step."""
    rng = np.random.default_rng(20)
    points = rng.uniform(-1, 1, (TESTS * 8, 2, 2))
    points = points[(np.hypot(points[..., 0], points[..., 1]) <= 1).all(1)][:TESTS] * (RADIUS - 1)
    angle = np.arange(TURNS) * 2 * np.pi / TURNS
    turn = np.stack([np.stack([np.cos(angle), -np.sin(angle)], -1), np.stack([np.sin(angle), np.cos(angle)], -1)], -2)
    return np.rint(np.einsum("tij,npj->tnpi", turn, points)).astype(np.int64)


@functools.cache
def _offsets(width: int) -> np.ndarray:
    """2 x TURNS x TESTS: the pattern's first and second points as steps in the rows of an image of a width."""
    return np.moveaxis(_pattern()[..., 1] * width + _pattern()[..., 0], 2, 0).copy()


@functools.cache
def _disc() -> tuple[np.ndarray, np.ndarray]:
    y, x = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
    inside = np.hypot(x, y) <= RADIUS
    return y[inside], x[inside]


_NO_CORNERS = np.zeros((0, 4), np.float32), np.zeros((0, TESTS // 8), np.uint8)


def describe(pixels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column, scale, turn) and 32-byte descriptors of an image's strongest corners."""
    return _describe(pixels[None])[0]


def describe_all(images: list[np.ndarray | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """describe of each image, those of one shape together; None has no corners."""
    shapes, out = {}, [_NO_CORNERS] * len(images)
    for i, x in enumerate(images):
        if x is not None:
            shapes.setdefault(x.shape, []).append(i)
    for (h, w), at in shapes.items():
        step = max(1, PIXELS // (h * w))
        for some in (at[i : i + step] for i in range(0, len(at), step)):
            for i, found in zip(some, _describe(np.stack([images[i] for i in some]))):
                out[i] = found
    return out


def _describe(pixels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """describe of images of one shape."""
    images, points, descriptors = [], [], []
    for scale in LEVELS:
        x = _scaled(pixels, scale)
        h, w = x.shape[1:]
        if min(h, w) < 2 * RADIUS + 5:
            continue
        gy, gx = np.gradient(x, axis=(1, 2))
        a, b, c = _box(gx * gx, 2), _box(gy * gy, 2), _box(gx * gy, 2)
        strength = a * b - c * c - 0.05 * (a + b) ** 2
        m = RADIUS + 1
        core = strength[:, m:-m, m:-m]
        around = _highest(strength[:, m - SPACE : h - m + SPACE, m - SPACE : w - m + SPACE], SPACE)
        image, r, q = np.nonzero((core >= around) & (core > 50.0))
        if not len(image):
            continue
        r, q = r + m, q + m
        smooth = _box(x, 1).ravel()
        at = (image * h + r) * w + q
        dy, dx = _disc()
        patch = smooth[at[:, None] + (dy * w + dx)]
        angle = np.arctan2((patch * dy).sum(1), (patch * dx).sum(1))
        turn = np.rint(angle / (2 * np.pi / TURNS)).astype(int) % TURNS
        one, other = _offsets(w)
        descriptors.append(np.packbits(smooth[at[:, None] + one[turn]] < smooth[at[:, None] + other[turn]], axis=1))
        points.append(np.stack([(r + 0.5) / scale - 0.5, (q + 0.5) / scale - 0.5, np.full(len(r), 1 / scale), turn], 1))
        images.append(image)
    if not points:
        return [_NO_CORNERS] * len(pixels)
    images = np.concatenate(images)
    order = np.argsort(images, kind="stable")
    cuts = np.searchsorted(images[order], np.arange(1, len(pixels)))
    return [*zip(np.split(np.concatenate(points).astype(np.float32)[order], cuts), np.split(np.concatenate(descriptors)[order], cuts))]


def _pieces(batches, rows: int = 500):
    """The batches in pieces of a few rows, as images are large."""
    return (batch.slice(i, rows) for batch in batches for i in range(0, batch.num_rows, rows))


def describe_media(media: DataFrame) -> DataFrame:
    """(media_id, digest, points, descriptors): the image's hash and its packed features; the image itself goes no further."""

    def run(batches):
        for batch in _pieces(batches):
            images = batch.column(1).to_pylist()
            digests = [None if data is None else hashlib.sha256(data).digest()[:16] for data in images]
            points, descriptors = zip(*((p.tobytes(), d.tobytes()) for p, d in describe_all([from_image(data) for data in images])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.binary()) for x in (digests, points, descriptors))], ["media_id", "digest", "points", "descriptors"])

    return media.select("media_id", "image").mapInArrow(run, "media_id long, digest binary, points binary, descriptors binary")


def _within(left: np.ndarray, right: np.ndarray, x_of, y_of, first: np.ndarray, ends: np.ndarray, words: list[int], most_bits: int):
    """(x, y) in parts: corners x_of[i] of left meet the corners y_of[first[i]:ends[i]] of right; those within most_bits stay.

    Descriptors are n x 4 words; the last of ``words`` is looked at where the others leave it open. Neighbours i of one end are
    a run: where many meet many, whole tables of differences are made, else one list of them."""
    *some, last = words
    sides = [(left[x_of, w], right[y_of, w]) for w in some]

    def kept(x, y, far):
        x, y = x_of[x], y_of[y]
        near = far.astype(np.int16) + np.bitwise_count(left[x, last] ^ right[y, last]) <= most_bits
        return x[near], y[near]

    starts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]]) if len(ends) else np.zeros(0, np.int64)
    rows, wide = np.diff(np.r_[starts, len(ends)]), ends[starts] - first[starts]
    many = (rows >= 16) & (wide >= 64) & (rows * wide >= 1 << 12)
    for begin, n, low, hi in zip(starts[many], rows[many], first[starts[many]], ends[starts[many]]):
        for lo in range(low, hi, BLOCK):
            to = min(hi, lo + BLOCK)
            step = max(1, BLOCK // (to - lo))
            for i in range(begin, begin + n, step):
                z = min(i + step, begin + n)
                far = sum(np.bitwise_count(a[i:z, None] ^ b[lo:to]) for a, b in sides)
                at = np.flatnonzero(far.ravel() <= most_bits)
                x, y = np.divmod(at, to - lo)
                x, y, far = x + i, y + lo, far.ravel()[at]
                asked = y >= first[x]
                yield kept(x[asked], y[asked], far[asked])
    few = np.flatnonzero(np.repeat(~many, rows))
    first, size = first[few], ends[few] - first[few]
    until = size.cumsum()
    total = int(until[-1]) if len(few) else 0
    for s in range(0, total, BLOCK):
        e = min(s + BLOCK, total)
        a, z = np.searchsorted(until, [s, e - 1], side="right")
        some, n = first[a : z + 1].copy(), size[a : z + 1].copy()
        gone = s - int(until[a] - size[a])
        some[0] += gone
        n[0] -= gone
        n[-1] -= until[z] - e
        x, y = np.repeat(few[a : z + 1], n), np.arange(e - s) + np.repeat(some - (n.cumsum() - n), n)
        far = sum(np.bitwise_count(a[x] ^ b[y]) for a, b in sides)
        at = np.flatnonzero(far <= most_bits)
        yield kept(x[at], y[at], far[at])


class _Block:
    """The corners of some images, one image after another."""

    def __init__(self, parts: list[tuple[bytes, bytes, bytes]]):
        self.ids = np.concatenate([np.frombuffer(p[0], np.int64) for p in parts])
        self.sizes = np.concatenate([np.frombuffer(p[1], np.int64) for p in parts])
        self.words = np.concatenate([np.frombuffer(p[2], np.uint64).reshape(-1, 4) for p in parts])
        self.runs = self.words.view(np.uint32)
        self.starts = np.r_[0, self.sizes.cumsum()]
        self.owners = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)
        self.hashes = np.empty(len(self.words), np.uint32)
        for i in range(0, len(self.words), BLOCK):
            a, b, c, d = self.words[i : i + BLOCK].T
            self.hashes[i : i + BLOCK] = mix(a ^ mix(b ^ mix(c ^ mix(d)))) >> np.uint64(32)


def _merged(parts: list) -> tuple[np.ndarray, ...]:
    """(pair, least and greatest corner of either image), each pair once."""
    pair, *corners = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    return pair[starts], *(f.reduceat(c[order], starts) if len(starts) else c for f, c in zip((np.minimum, np.maximum) * 2, corners))


def _agreeing(u: _Block, v: _Block, most_bits: int, part: int = PART, most: int = NEAR):
    """Pairs in parts, as places of images in u and in v: two corners each are within most_bits of one of the other's and agree
    with it on a run. Pairs of one block come once.

    About ``part`` corners of u meet v at once, fewer where more than ``most`` near corners would be held."""
    tables = TESTS // TABLE_BITS
    orders = [np.argsort(v.runs[:, t], kind="stable").astype(np.int32) for t in range(tables)]
    todo, i = [], 0
    while i < len(u.ids):
        j = max(i + 1, int(np.searchsorted(u.starts, u.starts[i] + part, side="right")) - 1)
        todo.append((i, j))
        i = j
    while todo:
        i, j = todo.pop()
        found, held, own = [(np.zeros(0, np.int64), *[np.zeros(0, np.uint32)] * 4)], 0, slice(u.starts[i], u.starts[j])
        for t in range(tables):
            order = orders[t]
            runs = v.runs[order, t]
            at = np.argsort(u.runs[own, t], kind="stable") + own.start
            ends = np.searchsorted(runs, u.runs[at, t], side="right")
            if u is v:  # those after it in its run
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order), dtype=np.int32)
                first = place[at].astype(np.int64) + 1
            else:
                first = np.searchsorted(runs, u.runs[at, t], side="left")
            at, first, ends = at[some := ends > first], first[some], ends[some]
            # the word that holds the run tells least
            for x, y in _within(u.words, v.words, at, order, first, ends, [(t * TABLE_BITS // 64 + k) % 4 for k in (1, 2, 3, 0)], most_bits):
                new = (u.runs[x] != v.runs[y])[:, :t].all(1)  # else found before
                if u is v:
                    new &= u.owners[x] != v.owners[y]
                x, y = x[new], y[new]
                a, b = u.hashes[x], v.hashes[y]
                found.append((u.owners[x].astype(np.int64) * len(v.ids) + v.owners[y], a, a, b, b))
                held += len(x)
                if held > most or len(found) > 4096:
                    found = [_merged(found)]
                    held = len(found[0][0])
                    if held > most // 2 and j - i > 1:
                        break
            if held > most // 2 and j - i > 1 and len(found) == 1:
                break
        else:
            pair, a, b, c, d = _merged(found)
            yield np.divmod(pair[(a < b) & (c < d)], max(1, len(v.ids)))
            continue
        todo += [((i + j) // 2, j), (i, (i + j) // 2)]


def _with_corners(u: _Block, v: _Block, x: np.ndarray, y: np.ndarray, least: int, most_bits: int) -> np.ndarray:
    """Which of the pairs have ``least`` corners each that are within most_bits of one of the other's, on a run or not."""
    enough = np.zeros(len(x), bool)

    def corners(block, images):
        n = block.sizes[images]
        pair, starts = np.repeat(np.arange(len(images)), n), n.cumsum() - n
        return pair, starts, block.words[np.arange(len(pair)) + np.repeat(block.starts[images] - starts, n)]

    for s in range(0, len(x), 10_000):
        n = len(x[s : s + 10_000])
        (p, _, left), (q, starts, right) = corners(u, x[s : s + n]), corners(v, y[s : s + n])
        ends = starts + v.sizes[y[s : s + n]]
        mine, others = np.zeros(len(p), bool), np.zeros(len(q), bool)
        for i, j in _within(left, right, np.arange(len(p)), np.arange(len(q)), starts[p], ends[p], [0, 1, 2, 3], most_bits):
            mine[i] = others[j] = True
        enough[s : s + n] = (np.bincount(p[mine], minlength=n) >= least) & (np.bincount(q[others], minlength=n) >= least)
    return enough


def candidates(features: DataFrame, most_bits: int, slice_size: int = SLICE, most: int = MOST_SPOTS, least: int = 2) -> DataFrame:
    """(u, v): all pairs of images, u < v, of which two corners of each are within most_bits of one of the other's and agree
    with it on a whole run, and ``least`` of each are within most_bits of one of the other's at all.

    Images lie in blocks of at most about ``most`` corners, and each two blocks meet in a task of their own: what agrees on a run
    is counted where it is found and only pairs leave the task. Smaller blocks, of slice_size and more, let all cores work."""
    cores = features.sparkSession.sparkContext.defaultParallelism
    n = (features.agg(F.sum(F.length("descriptors"))).first()[0] or 0) // (TESTS // 8)
    blocks = max(1, -(-n // most), min(n // slice_size, math.ceil(math.sqrt(4 * cores))))

    def pack(batches):
        for batch in batches:
            ids, packed = np.asarray(batch.column(0).to_pylist(), np.int64), batch.column(1).to_pylist()
            sizes = np.asarray([len(d) // (TESTS // 8) for d in packed], np.int64)
            where = (mix(ids.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)
            out = [[], [], [], []]
            for k in np.unique(where[sizes > 0]).tolist():
                some = np.flatnonzero((where == k) & (sizes > 0))
                for column, value in zip(out, (k, ids[some].tobytes(), sizes[some].tobytes(), b"".join(packed[i] for i in some))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == 0 else pa.binary()) for k, c in enumerate(out)], ["block", "ids", "sizes", "descriptors"])

    def meet(batches):
        held = {}
        for batch in batches:
            for i, j, own, *part in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault((i, j), ([], []))[own != i].append(part)
        while held:
            (i, j), parts = held.popitem()
            if not parts[0] or not (parts[1] or i == j):
                continue
            u = _Block(parts[0])
            v = u if i == j else _Block(parts[1])
            del parts
            for x, y in _agreeing(u, v, most_bits):
                if least > 2 and len(x):
                    enough = _with_corners(u, v, x, y, least, most_bits)
                    x, y = x[enough], y[enough]
                a, b = u.ids[x], v.ids[y]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["u", "v"])

    packed = features.select("media_id", "descriptors").mapInArrow(pack, "block long, ids binary, sizes binary, descriptors binary")
    rows = packed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("other"))
    rows = rows.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "ids", "sizes", "descriptors")
    # pairs of blocks are numbered by their greater one, then by the other
    met = rows.repartitionById(blocks * (blocks + 1) // 2, F.expr("cast(j * (j + 1) div 2 + i as int)"))
    return met.mapInArrow(meet, "u long, v long")


# -- pairs -----------------------------------------------------------------------------------------------------------


def consensus(a: np.ndarray, b: np.ndarray, pairs: np.ndarray, near: float = 3.0) -> int:
    """The most places whose corners one similarity transform, given by one pair of corners, maps onto each other.

    Corners less than about six pixels apart count as one place, so one corner on several scales proves nothing."""
    p, q = a[pairs[:, 0]], b[pairs[:, 1]]
    scale, turn = q[:, 2] / p[:, 2], (q[:, 3] - p[:, 3]) * (2 * np.pi / TURNS)
    cos, sin = np.cos(turn) * scale, np.sin(turn) * scale
    dy, dx = p[None, :, 0] - p[:, None, 0], p[None, :, 1] - p[:, None, 1]
    y = q[:, None, 0] + sin[:, None] * dx + cos[:, None] * dy
    x = q[:, None, 1] + cos[:, None] * dx - sin[:, None] * dy
    hit = np.hypot(y - q[None, :, 0], x - q[None, :, 1]) <= near
    places = [(x[:, 0] // 6 * 10_000 + x[:, 1] // 6).astype(np.int64) for x in (p, q)]
    best = 0
    for row in hit[hit.sum(1) > best]:
        best = max(best, min(len(np.unique(x[row])) for x in places))
    return best


def _verify(pairs: DataFrame, least: int, most_bits: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            u, v, n = [], [], []
            for rep, pivot, pa_, da, pb, db in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.frombuffer(pa_, np.float32).reshape(-1, 4), np.frombuffer(pb, np.float32).reshape(-1, 4)
                x, y = np.frombuffer(da, np.uint8).reshape(len(a), -1), np.frombuffer(db, np.uint8).reshape(len(b), -1)
                far = np.bitwise_count(x[:, None] ^ y[None]).sum(-1)
                near = np.argwhere(far <= most_bits)
                inliers = consensus(a, b, near) if len(near) >= least else 0
                if inliers >= least:
                    u.append(rep)
                    v.append(pivot)
                    n.append(inliers)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(n, pa.int64())], ["u", "v", "inliers"])

    return pairs.mapInArrow(run, "u long, v long, inliers long")


def image_copies(media: DataFrame, least: int = 5, most_bits: int = 28) -> DataFrame:
    """(media_id, class_id, n_links) for each row of media (media_id long, image binary).

    Equal images are one node. All images of which two corners each are within most_bits of one of the other's and agree with it
    on a run of TABLE_BITS are compared: all their corners within most_bits, then the largest set of them that one shift, turn and scale explains;
    with ``least`` such places they are linked. class_id is the smallest media_id of the linked images and n_links the
    number of other different images that an image is linked with; pairs within a class are not listed. A null, damaged or
    featureless image is alone, but for equal ones; nulls are all alone. Rows may repeat; a null media_id gets a null class."""
    spark = media.sparkSession
    staging = Staging(spark, "media")
    described = staging.keep(describe_media(media), "described")
    every = staging.keep(described.select("media_id", "digest"), "every")
    reps = staging.keep(every.where("digest is not null and media_id is not null").groupBy("digest").agg(F.min("media_id").alias("rep")), "reps")
    features = staging.keep(described.join(reps.select(F.col("rep").alias("media_id")), "media_id", "left_semi").groupBy("media_id").agg(F.min("points").alias("points"), F.min("descriptors").alias("descriptors")), "first")
    staging.drop(described)
    matches = staging.keep(candidates(features, most_bits, least=least), "candidates").select(F.col("v").alias("rep"), F.col("u").alias("pivot"))
    side = features.select("media_id", "points", "descriptors")
    pairs = matches.join(side, F.col("rep") == F.col("media_id")).drop("media_id")
    other = side.select(F.col("media_id").alias("_id"), F.col("points").alias("_points"), F.col("descriptors").alias("_descriptors"))
    pairs = pairs.join(other, F.col("pivot") == F.col("_id")).select("rep", "pivot", "points", "descriptors", "_points", "_descriptors")
    links = staging.keep(_verify(pairs, least, most_bits), "links")
    found = connected_components(links.select("u", "v"), staging)
    counts = links.select(F.explode(F.array("u", "v")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    classes = reps.join(found, F.col("rep") == F.col("node"), "left").join(counts, "rep", "left")
    classes = classes.select("digest", F.coalesce("component", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rows = every.select("media_id", "digest").join(classes, "digest", "left")
    own = F.when(F.col("media_id").isNotNull(), F.coalesce("class_id", "media_id"))
    out = Staging(spark, "media-classes").keep(rows.select("media_id", own.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")
    staging.clear()
    return out


# -- the media column of the query -----------------------------------------------------------------------------------

SIDE = 80


#: Exclusive bounds of the numbers that a figure of a picture takes: its middle, its sides and its shade.
_FIGURES, _LOWEST, _BOUNDS = 22, np.tile([0, 0, 5, 5, -60], 22), np.tile([SIDE, SIDE, 22, 22, 60], 22)


@functools.cache
def _round(height: int) -> np.ndarray:
    """The disc of a height, in its square."""
    y, x = np.ogrid[-(height // 2) : height // 2 + 1, -(height // 2) : height // 2 + 1]
    return np.hypot(y, x) <= height / 2


def render(vector) -> np.ndarray:
    """A picture of a vector: rectangles, discs and grain whose places come from the vector's bytes and whose greys from its values."""
    vector = np.asarray(vector, np.float32)
    rng = np.random.default_rng(zlib.crc32(vector.tobytes()))
    grey = np.clip(128 + 90 * np.tanh(vector[np.isfinite(vector)] * 4), 0, 255) if len(vector) else np.asarray([128.0])
    grey = grey if len(grey) else np.asarray([128.0])
    out = np.full((SIDE, SIDE), 110.0)
    for k, (cy, cx, h, w, shade) in enumerate(rng.integers(_LOWEST, _BOUNDS).reshape(_FIGURES, 5)):
        value = (grey[k % len(grey)] + shade) % 256
        if k % 3:
            out[max(0, cy - h // 2) : cy + h // 2 + 1, max(0, cx - w // 2) : cx + w // 2 + 1] = value
        else:
            top, left, half = max(0, cy - h // 2), max(0, cx - h // 2), h // 2
            part = out[top : cy + half + 1, left : cx + half + 1]
            part[_round(int(h))[top - cy + half :, left - cx + half :][: part.shape[0], : part.shape[1]]] = value
    grain = _box(rng.normal(size=out.shape), 1) * 45
    return np.clip(out + grain, 0, 255).astype(np.uint8)


def edited(pixels: np.ndarray, k: int) -> np.ndarray:
    """One of four edits: a crop, a change of brightness, a quarter turn, a crop with noise."""
    rng = np.random.default_rng(k % (1 << 64))
    top, left = rng.integers(0, 11, 2)
    crop = pixels[top : top + SIDE - 10, left : left + SIDE - 10]
    return (crop, (pixels * 0.8 + 15).astype(np.uint8), np.rot90(pixels), np.clip(crop + rng.integers(-2, 3, crop.shape), 0, 255).astype(np.uint8))[k % 4]


def _wrapped(i: int) -> int:
    return (i + (1 << 63)) % (1 << 64) - (1 << 63)


def media_of(embeddings: DataFrame) -> DataFrame:
    """(media_id, image): for each vector its picture (2 * vec_id) and an edited copy of it (2 * vec_id + 1); ids wrap in 64 bits."""

    def run(batches):
        for batch in _pieces(batches):
            ids, images = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                picture = render(v or [])
                ids += [_wrapped(2 * i), _wrapped(2 * i + 1)] if i is not None else [None, None]
                images += [to_image(picture), to_image(edited(picture, i or 0))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(images, pa.binary())], ["media_id", "image"])

    return embeddings.select("vec_id", "embedding").mapInArrow(run, "media_id long, image binary")


def op9_local_descriptors(spark, sf_dir: str) -> DataFrame:
    """Classes of copies among pictures of all embeddings and their edited copies."""
    return image_copies(media_of(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
