"""Language-model scores by deleted interpolation of trigrams, bigrams, unigrams and a uniform distribution.

Counts of n-grams are shuffled, never the texts: texts are packed, every pack sends each of its distinct n-grams once, as
sorted hashes in compressed blocks, to the task that counts the block, and gets its counts back in the same order. A
pack has FAN rows at most; where a corpus needs more blocks, packs are merged range by range and cut again. (One row for
each n-gram of a pack, counted by groupBy and joined back, would shuffle about twelve times the input.)
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import Staging, as_bytes, block_edges, decode, decode_keys, distinct, encode, encode_keys, fold, hashed_texts, mix, packer, places

#: Bytes of text in a pack, and distinct n-grams (about) in a block.
PACK_BYTES = 6 << 20
BLOCK_KEYS = 3_000_000
#: Bits of the hashes of bigrams and trigrams; words have 64.
KEY_BITS = 52
BOS, END = np.uint64(0x0B05), np.uint64(0x0E2D)
#: What a text is for: scored only, counted, or counted for the base and kept out of the model to learn its weights.
HELD_OUT, COUNTED, DELETED = 0, 1, 2


def pack_texts(docs: DataFrame) -> DataFrame:
    """(pack, role, ids, ends, blob): runs of texts of one role, compressed. docs: doc_id, text, role."""

    def run(batches):
        made, task = 0, TaskContext.get().partitionId()
        held: dict[int, list] = {}

        def flush(role):
            nonlocal made
            ids, texts = held.pop(role)
            made += 1
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            row = [pa.array([(task << 24) + made], pa.int64()), pa.array([role], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([ends.tolist()], pa.list_(pa.int64())), pa.array([packer(3).compress(b"".join(texts))], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["pack", "role", "ids", "ends", "blob"])

        size: dict[int, int] = {}
        for batch in batches:
            for i, t, role in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()):
                ids, texts = held.setdefault(role, ([], []))
                ids.append(i)
                texts.append(t)
                size[role] = size.get(role, 0) + len(t) + 16
                if size[role] >= PACK_BYTES:
                    size[role] = 0
                    yield flush(role)
        for role in list(held):
            yield flush(role)

    return docs.select("doc_id", "text", "role").mapInArrow(run, "pack long, role int, ids array<long>, ends array<long>, blob binary")


def sequence(ends, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts of a pack, each after two begin marks and before one end mark; positions of those that are
    scored (words and end marks), and each text's number of them."""
    data = packer().decompress(blob) if blob else b""
    starts = [0, *list(ends)[:-1]]
    parts, sizes = [], []
    for h in hashed_texts([data[a:b] for a, b in zip(starts, ends)]):
        parts += [[BOS, BOS], h, [END]]
        sizes.append(len(h) + 1)
    seq = np.concatenate([np.asarray(p, np.uint64) for p in parts]) if parts else np.zeros(0, np.uint64)
    sizes = np.asarray(sizes, np.int64)
    first = np.cumsum(sizes + 2) - sizes
    at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return seq, at, sizes


@dataclass
class Grams:
    """Keys at every position of a sequence: words, and the n-grams that end there."""

    one: np.ndarray
    two: np.ndarray
    three: np.ndarray

    @staticmethod
    def of(seq: np.ndarray) -> Grams:
        cut = np.uint64(64 - KEY_BITS)
        two, three = np.zeros_like(seq), np.zeros_like(seq)
        if len(seq) > 2:
            pair = mix(seq[:-1] * np.uint64(0x9E3779B97F4A7C15) + seq[1:])
            two[1:] = pair >> cut
            three[2:] = mix(pair[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + seq[2:]) >> cut
        return Grams(seq, two, three)


def _wanted(g: Grams, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys that a pack asks for: all words and begin marks; pairs at scored positions and before; triples there."""
    return g.one, g.two[np.r_[at, at - 1]], g.three[at]


def _counts(g: Grams, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys to count: words with one begin mark a text, pairs that end at scored positions and one (begin, begin) a text, triples."""
    first = at[np.cumsum(sizes) - sizes]
    return np.r_[g.one[at], np.full(len(sizes), BOS)], np.r_[g.two[at], g.two[first - 1]], g.three[at]


BITS = (64, KEY_BITS, KEY_BITS)
#: Ranges of keys that a row of counts is cut into, at most; more blocks are reached in several levels.
FAN = 4096
#: Of one unit in one range of keys: distinct keys, how often the model counts them, and, of words, the base.
PARTS = "block int, unit long, k1 binary, k2 binary, k3 binary, n1 binary, n2 binary, n3 binary, d1 binary"


def _sliced(unit: int, first: int, keys: list, counts: list, base: np.ndarray | None, edges: list) -> pd.DataFrame:
    """PARTS rows of a unit: its sorted keys cut at the edges of the blocks that begin with ``first``; counts of None are 0."""
    rows: dict[str, list] = {}
    for i, (own, n, edge) in enumerate(zip(keys, counts, edges), 1):
        cuts = np.r_[np.searchsorted(own, edge), len(own)]
        spans = list(zip(cuts[:-1], cuts[1:]))
        rows[f"k{i}"] = [encode_keys(own[x:y]) for x, y in spans]
        rows[f"n{i}"] = [b"" if n is None else encode(n[x:y]) for x, y in spans]
        if i == 1:
            rows["d1"] = [b"" if base is None else encode(base[x:y]) for x, y in spans]
    names = [x.split()[0] for x in PARTS.split(", ")]
    return pd.DataFrame({"block": np.arange(first, first + len(edges[0]), dtype=np.int32), "unit": unit, **rows})[names]


def requests(packs: DataFrame, fan: int) -> DataFrame:
    """PARTS rows of each pack: its distinct keys in each of ``fan`` ranges and how often it has them."""

    def run(batches):
        edges = [block_edges(fan, b) for b in BITS]
        for batch in batches:
            for pack, role, _, ends, blob in zip(*(c.to_pylist() for c in batch.columns)):
                seq, at, sizes = sequence(ends, blob)
                g = Grams.of(seq)
                every, counts = [distinct(x) for x in _wanted(g, at)], []
                for keys, own, bits in zip(every, _counts(g, at, sizes), BITS):
                    counts.append(None if role == HELD_OUT else np.bincount(places(keys, own, bits), minlength=len(keys)).astype(np.uint32))
                yield pa.RecordBatch.from_pandas(_sliced(pack, 0, every, counts if role == COUNTED else [None] * 3, counts[0], edges), preserve_index=False)

    return packs.mapInArrow(run, PARTS)


def _summed(group: pd.DataFrame, i: int) -> tuple:
    """Of the i-th keys of PARTS rows of one range: the distinct keys, each row's places in them, and their counts."""
    keys = [decode_keys(k) for k in group[f"k{i}"]]
    sizes = [len(k) for k in keys]
    every = np.concatenate(keys)
    order = np.argsort(every)
    ranked = every[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]] if len(ranked) else np.zeros(0, bool)
    place = np.empty(len(every), np.int64)
    place[order] = np.cumsum(new) - 1
    total = lambda blobs: np.bincount(place, np.concatenate([decode(n, np.uint32) if n else np.zeros(s, np.uint32) for n, s in zip(blobs, sizes)]).astype(float), minlength=int(new.sum()))
    cuts = np.cumsum([0, *sizes])
    return ranked[new], [place[x:y] for x, y in zip(cuts[:-1], cuts[1:])], total(group[f"n{i}"]), total(group["d1"]) if i == 1 else None


REPLY = "unit long, block int, base binary, r1 binary, r2 binary, r3 binary, tokens long, distinct long, model_tokens long"


def _replies(group: pd.DataFrame, found: list, totals: list[dict]) -> pd.DataFrame:
    """A reply for each of group's PARTS rows: the counts of its keys in their order; and rows (unit null) of totals.

    found: of each kind of keys, each row's places in its distinct keys, and the counts of those; of words, also the base's."""
    own = {f"r{i}": [encode(n[x].astype(np.uint32)) for x in at] for i, (at, n, _) in enumerate(found, 1)}
    own["base"] = [encode(found[0][2][x].astype(np.uint32)) for x in found[0][0]]
    names, more = [x.split()[0] for x in REPLY.split(", ")], len(totals)
    out = {"unit": pd.array([*group["unit"], *[None] * more], dtype="Int64"), "block": [*group["block"], *[-1] * more]}
    out |= {k: [*v, *[b""] * more] for k, v in own.items()}
    out |= {k: [*[0] * len(group), *(t[k] for t in totals)] for k in ("tokens", "distinct", "model_tokens")}
    return pd.DataFrame(out)[names]


def _count_block(group: pd.DataFrame) -> pd.DataFrame:
    """Sums a block's keys over all units; one reply a unit, and one row (unit null) with the block's totals."""
    sums = [_summed(group, i) for i in (1, 2, 3)]
    keys, _, count, base = sums[0]
    word = keys != BOS
    totals = {"tokens": int(base[word].sum()), "distinct": int((base[word] > 0).sum()), "model_tokens": int(count[word].sum())}
    return _replies(group, [s[1:] for s in sums], [totals])


def _merge(group: pd.DataFrame, fan: int, depth: int) -> pd.DataFrame:
    """Units of one range as one unit, cut into the ranges of the next level."""
    keys, _, counts, base = zip(*(_summed(group, i) for i in (1, 2, 3)))
    first = int(group["block"].iloc[0]) * fan
    edges = [block_edges(fan**depth, b, first, first + fan) for b in BITS]
    return _sliced(int(group["merged"].iloc[0]), first, list(keys), [c.astype(np.uint32) for c in counts], base[0].astype(np.uint32), edges)


def _pass_back(group: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    """Replies for the units of a merged one, of its own."""
    places_ = [_summed(group, i)[1] for i in (1, 2, 3)]
    replies = replies.sort_values("block")
    got = {x: np.concatenate([decode(r, np.uint32) for r in replies[x]]) for x in ("base", "r1", "r2", "r3")}
    return _replies(group, [(at, got[f"r{i}"], got["base"]) for i, at in enumerate(places_, 1)], [])


def levels(blocks: int, most: int) -> int:
    """The least fan-out that reaches so many blocks in as few levels as one of ``most`` does."""
    depth = 1
    while most**depth < blocks:
        depth += 1
    fan = max(1, round(blocks ** (1 / depth)))
    return fan if fan**depth >= blocks else fan + 1


def answer(rows: DataFrame, blocks: int, fan: int, staging: Staging, depth: int = 1) -> DataFrame:
    """REPLY rows for PARTS rows cut into fan ** depth ranges, counted in ``blocks`` blocks or a few more.

    While the ranges are fewer than the blocks, the units that meet in a range are merged, so many that they make up a
    block's keys, and cut again: a unit has ``fan`` rows at every level, however large the corpus."""
    if fan**depth >= blocks:
        return staging.keep(rows.groupBy("block").applyInPandas(_count_block, REPLY), "replies")
    groups = -(-blocks // fan**depth)
    rows = staging.keep(rows.withColumn("merged", F.col("block") * F.lit(groups).cast("long") + F.pmod(F.xxhash64("unit"), F.lit(groups))), "parts")
    merged = rows.groupBy("merged").applyInPandas(functools.partial(_merge, fan=fan, depth=depth + 1), PARTS)
    found = answer(merged, blocks, fan, staging, depth + 1)
    back = rows.groupBy("merged").cogroup(found.where("unit is not null").groupBy("unit")).applyInPandas(_pass_back, REPLY)
    out = staging.keep(back.union(found.where("unit is null")), "replies")
    staging.drop(rows, found)
    return out


def _looked_up(pack: pd.Series, replies: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Counts at each scored position: base, c(w), c(v), c(v w), c(u v), c(u v w), and each text's number of tokens."""
    seq, at, sizes = sequence(pack["ends"], pack["blob"])
    g = Grams.of(seq)
    replies = replies.sort_values("block")
    got = {x: np.concatenate([decode(r, np.uint32) for r in replies[x]]).astype(np.int64) for x in ("base", "r1", "r2", "r3")}
    one, two, three = (distinct(k) for k in _wanted(g, at))
    follows = np.ones(len(seq), bool)  # all but the first begin mark of each text
    follows[at[np.cumsum(sizes) - sizes] - 2] = False
    pair = np.zeros(len(seq), np.int64)
    pair[follows] = places(two, g.two[follows], KEY_BITS)
    word = places(one, g.one)
    w, v = word[at], word[at - 1]
    return got["base"][w], got["r1"][w], got["r1"][v], got["r2"][pair[at]], got["r2"][pair[at - 1]], got["r3"][places(three, g.three[at], KEY_BITS)], sizes


def buckets(c2: np.ndarray, c1: np.ndarray) -> np.ndarray:
    """The bucket of a context: by the powers of two of its pair's count, or of its last word's if the pair is new."""
    log = lambda c: np.minimum(np.log2(np.maximum(c, 1)).astype(np.int64), 31)
    return np.where(c2 > 0, 33 + log(c2), np.where(c1 > 0, 1 + log(c1), 0))


N_BUCKETS = 65


def parts(w, v, vw, uv, uvw, tokens: int, distinct: int) -> np.ndarray:
    """The four maximum-likelihood estimates of each position."""
    p3 = np.divide(uvw, uv, out=np.zeros(len(w)), where=uv > 0)
    p2 = np.divide(vw, v, out=np.zeros(len(w)), where=v > 0)
    return np.stack([p3, p2, w / max(tokens, 1), np.full(len(w), 1 / (distinct + 1))], 1)


def _cells(packs: pd.DataFrame, replies: pd.DataFrame, tokens: int, distinct: int) -> pd.DataFrame:
    """Deleted tokens summed by bucket and powers of two of the estimates: bounded, whatever the number of tokens."""
    if not len(packs):
        return pd.DataFrame({"cell": pd.Series(dtype="int64"), "n": pd.Series(dtype="float"), "p3": pd.Series(dtype="float"), "p2": pd.Series(dtype="float"), "p1": pd.Series(dtype="float")})
    _, w, v, vw, uv, uvw, _ = _looked_up(packs.iloc[0], replies)
    p = parts(w, v, vw, uv, uvw, tokens, distinct)
    step = lambda x: np.where(x > 0, np.clip(-np.log2(np.maximum(x, 1e-12)), 0, 30).astype(np.int64), 31)
    cell = ((buckets(uv, v) * 32 + step(p[:, 0])) * 32 + step(p[:, 1])) * 32 + step(p[:, 2])
    u, inverse = np.unique(cell, return_inverse=True)
    return pd.DataFrame({"cell": u, "n": np.bincount(inverse).astype(float), **{f"p{3 - k}": np.bincount(inverse, p[:, k]) for k in range(3)}})


def fit_weights(cells: pd.DataFrame, distinct: int, rounds: int = 40, prior: float = 0.5) -> np.ndarray:
    """Mixture weights of each bucket, by expectation-maximisation on the deleted tokens' cells.

    A prior of a few tokens, spread as all buckets together, stands in for buckets without any; the uniform part keeps a
    positive weight, so every text has a finite score."""
    n = cells["n"].to_numpy(float)
    p = np.stack([*(cells[f"p{k}"].to_numpy(float) / np.maximum(n, 1) for k in (3, 2, 1)), np.full(len(n), 1 / (distinct + 1))], 1)
    bucket = (cells["cell"].to_numpy(np.int64) >> 15) if len(cells) else np.zeros(0, np.int64)

    def learn(group, groups, start):
        weights = np.tile(start, (groups, 1))
        for _ in range(rounds):
            share = weights[group] * p
            share *= (n / share.sum(1))[:, None]
            sums = np.stack([np.bincount(group, share[:, k], groups) for k in range(4)], 1) + prior * start
            weights = sums / sums.sum(1, keepdims=True)
        return weights

    overall = learn(np.zeros(len(n), np.int64), 1, np.full(4, 0.25))[0]
    return learn(bucket, N_BUCKETS, overall)


SCORES = "doc_id long, role int, n_tokens long, n_known long, base_sum double, score double"


def _scores(packs: pd.DataFrame, replies: pd.DataFrame, weights: np.ndarray, tokens: int, distinct: int) -> pd.DataFrame:
    if not len(packs):
        return pd.DataFrame({x.split()[0]: [] for x in SCORES.split(", ")})
    pack = packs.iloc[0]
    base, w, v, vw, uv, uvw, sizes = _looked_up(pack, replies)
    p = (parts(w, v, vw, uv, uvw, tokens, distinct) * weights[buckets(uv, v)]).sum(1)
    first = np.cumsum(sizes) - sizes
    total = lambda x: np.add.reduceat(x, first) if len(x) else x
    return pd.DataFrame({"doc_id": pd.array(list(pack["ids"]), dtype="Int64"), "role": pack["role"], "n_tokens": sizes, "n_known": total((base > 0).astype(np.int64)), "base_sum": total(np.log10(base + 1.0)), "score": total(np.log10(p))})


def score_texts(docs: DataFrame, text: str = "text", deleted_share: int = 10) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs.

    docs has doc_id, a text and ``held_out``; a null of the last counts as false. Tokens are runs without ASCII white space, A-Z taken
    as a-z, and one end mark a text; null texts are empty. Of the rows not held out, about one in deleted_share is
    left out of the model's counts and teaches the mixture weights instead; the base counts them all. Rows may repeat.
    Without training rows every count is 0. Hashes of 52 bits stand for pairs and triples, so a count may rarely be too
    large; words have 64. The weights are learnt on estimates summed by powers of two (a cell has its tokens' mean).

    Columns other than doc_id, the text and held_out are not read; a null doc_id is scored like any other."""
    spark = docs.sparkSession
    staging = Staging(spark, "lm")
    held = F.coalesce(F.col("held_out"), F.lit(False))
    role = F.when(held, HELD_OUT).when(F.pmod(F.xxhash64("doc_id", text), F.lit(deleted_share)) == 0, DELETED).otherwise(COUNTED)
    packs = staging.keep(pack_texts(docs.select("doc_id", F.col(text).alias("text"), role.cast("int").alias("role"))), "packs")
    size = packs.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    blocks = int(size // (3 * BLOCK_KEYS) + 1)
    fan = levels(blocks, FAN)
    replies = answer(requests(packs, fan), blocks, fan, staging)
    totals = replies.where("unit is null").agg(F.sum("tokens"), F.sum("distinct"), F.sum("model_tokens")).first()
    tokens, distinct, model_tokens = (x or 0 for x in totals)
    answers = replies.where("unit is not null").select(F.col("unit").alias("pack"), "block", "base", "r1", "r2", "r3")
    deleted = packs.where(F.col("role") == DELETED)
    own = answers.join(F.broadcast(deleted.select("pack")), "pack", "left_semi") if deleted.limit(100_001).count() <= 100_000 else answers.join(deleted.select("pack"), "pack", "left_semi")
    cells = deleted.groupBy("pack").cogroup(own.groupBy("pack")).applyInPandas(functools.partial(_cells, tokens=model_tokens, distinct=distinct), "cell long, n double, p3 double, p2 double, p1 double")
    cells = cells.groupBy("cell").agg(*(F.sum(c).alias(c) for c in ("n", "p3", "p2", "p1"))).toPandas()
    weights = fit_weights(cells.sort_values("cell"), distinct)
    scored = packs.groupBy("pack").cogroup(answers.groupBy("pack")).applyInPandas(functools.partial(_scores, weights=weights, tokens=model_tokens, distinct=distinct), SCORES)
    base = F.col("base_sum") - F.col("n_tokens") * F.log10(F.lit(float(tokens + distinct + 1)))
    out = scored.select("doc_id", (F.col("role") == HELD_OUT).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
    kept = Staging(spark, "lm-scores").keep(out, "scores")
    staging.clear()
    return kept


def op5_lm_scores(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents by the model of those outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_texts(docs.withColumn("held_out", fold("doc_id", 7) == 2))
