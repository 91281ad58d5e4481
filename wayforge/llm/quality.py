"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened for numpy traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import as_bytes, batches, fold, small, word_hashes

FEATURES = [
    "log_bytes", "log_words", "mean_word", "upper", "digit", "mark", "symbol", "space", "newline", "high",
    "distinct_words", "top_word", "same_as_last", "distinct_pairs", "distinct_lines", "words_a_line", "marked_ends", "capital_words", "bars", "run_share", "entropy", "exclaim", "short_words", "longest_line",
]


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[[ord(c) for c in chars]] = 1
    return out


_CLASSES = np.stack([
    _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class(".,;:'\"()-?!"), _class("#$%&*@^~<>{}[]\\_=+`/"),
    _class(" \t\r\v\f"), _class("\n"), np.r_[np.zeros(128), np.ones(128)], _class("|"), _class("!"), _class(".!?"),
], axis=1)


def _stats(data: bytes, hashes: np.ndarray, starts: np.ndarray) -> list[float]:
    n, words = len(data), len(hashes)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, digit, mark, symbol, space, newline, high, bar, exclaim, stop = (counts @ _CLASSES / n).tolist()
    share = counts[counts > 0] / n
    entropy = float(-(share * np.log2(share)).sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    row = [np.log1p(n), np.log1p(words), (1 - space - newline) * n / max(words, 1), upper, digit, mark, symbol, space, newline, high]
    if words:
        values, times = np.unique(hashes, return_counts=True)
        pairs = hashes[1:] * np.uint64(31) + hashes[:-1]
        same = hashes[1:] == hashes[:-1]
        raw = np.frombuffer(data, np.uint8)
        firsts = raw[starts]
        gaps = np.diff(np.r_[starts, n])
        row += [len(values) / words, times.max() / words, float(same.mean()) if words > 1 else 0.0, len(np.unique(pairs)) / max(len(pairs), 1)]
        capitals, run, short = float(((firsts >= 65) & (firsts <= 90)).mean()), float(same[1:][same[:-1]].sum()) / words if words > 2 else 0.0, float((gaps <= 4).mean())
    else:
        row += [0.0, 0.0, 0.0, 0.0]
        capitals = run = short = 0.0
    ends = sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines)
    row += [len(set(lines)) / max(len(lines), 1), words / max(len(lines), 1), ends / max(len(lines), 1), capitals, bar, run, entropy, exclaim, short, max(map(len, lines), default=0) / n]
    return row


def features_of(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each text; all 0 for an empty one."""
    rows = []
    for a, b in batches(texts):
        hashes, starts = word_hashes(b"\n".join(texts[a:b]))
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts[a:b])])
        cuts = np.searchsorted(starts, bounds)
        rows += [_stats(t, hashes[cuts[i] : cuts[i + 1]], starts[cuts[i] : cuts[i + 1]] - bounds[i]) for i, t in enumerate(texts[a:b])]
    return np.asarray(rows, float).reshape(-1, len(FEATURES))


@dataclass
class Trees:
    """All trees in flat arrays: node k goes to left[k], or to left[k] + 1 if the feature exceeds the threshold; a leaf goes to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                leaf = self.feature[at] < 0
                at = np.where(leaf, at, self.left[at] + (x[rows, self.feature[at]] > self.threshold[at]))
            out += self.value[at]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: int = 10) -> Trees:
    """Boosts trees on the logistic loss, level by level, from histograms of gradients over quantile bins.

    Without rows, or with one label only, the result is a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1) if len(x) else np.zeros((0, x.shape[1]), int)
    feature, threshold, left, value, roots = [], [], [], [], []
    raw = np.full(len(y), start)
    if not len(y) or y.min() == y.max():
        trees = 0
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        roots.append(len(feature))
        feature.append(-1)
        threshold.append(0.0)
        left.append(0)
        value.append(0.0)
        at, level = np.full(len(y), roots[-1]), [roots[-1]]
        for d in range(depth + 1):
            local = np.full(len(feature), -1)
            local[level] = np.arange(len(level))
            node = local[at]
            live = node >= 0
            gs, hs = (np.bincount(node[live], v[live], len(level)) for v in (g, h))
            for k, n in enumerate(level):
                value[n] = float(-rate * gs[k] / (hs[k] + l2))
            if d == depth:
                break
            best = np.zeros(len(level)), np.full(len(level), -1), np.zeros(len(level), int)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                width = len(e) + 1
                key = node[live] * width + codes[live, f]
                hist = [np.cumsum(np.bincount(key, v, len(level) * width).reshape(-1, width), 1)[:, :-1] for v in (g[live], h[live], np.ones(live.sum()))]
                rows = np.bincount(node[live], minlength=len(level))[:, None]
                gl, hl, nl = hist
                gr, hr, nr = gs[:, None] - gl, hs[:, None] - hl, rows - nl
                gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - (gs**2 / (hs + l2))[:, None]
                gain[(nl < least) | (nr < least)] = 0
                cut = gain.argmax(1)
                won = gain[np.arange(len(level)), cut]
                better = won > best[0] + 1e-9
                best[0][better], best[1][better], best[2][better] = won[better], f, cut[better]
            grown = []
            for k, n in enumerate(level):
                if best[1][k] < 0:
                    continue
                f = int(best[1][k])
                feature[n], threshold[n], left[n] = f, float(edges[f][best[2][k]]), len(feature)
                for _ in range(2):
                    feature.append(-1)
                    threshold.append(0.0)
                    left.append(0)
                    value.append(0.0)
                mine = at == n
                at[mine] = left[n] + (codes[mine, f] > best[2][k])
                grown += [left[n], left[n] + 1]
            level = grown
            if not level:
                break
        raw += np.asarray(value)[at]
    return Trees(np.asarray(feature, int), np.asarray(threshold), np.asarray(left, int), np.asarray(value), np.asarray(roots, int), depth, start)


def document_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with ``features``, an array of doubles in the order of FEATURES, in place of the text."""
    kept = docs.drop("features")
    at, others = kept.columns.index(text), [c for c in kept.columns if c != text]

    def run(batches_):
        for batch in small(batches_):
            x = features_of(as_bytes(batch.column(at)))
            array = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != at), array], [*others, "features"])

    return kept.mapInArrow(run, kept.select(*others, F.array(F.lit(0.0)).alias("features")).schema)


def fit_quality(docs: DataFrame, labels: DataFrame, text: str = "text", max_labelled: int = 20_000, **params) -> Trees:
    """Trees fitted on at most max_labelled labelled documents, taken by a hash of their ids.

    Null ids and labels teach nothing. Labels that repeat an id count each; of documents that repeat one, the text with
    the smallest hash counts. An empty table gives trees that score every text alike."""
    chosen = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("double").alias("_y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    own = docs.select("doc_id", text).join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")  # max_labelled ids at most
    own = own.groupBy("doc_id").agg(F.min_by(text, F.xxhash64(text)).alias(text))
    taught = own.join(F.broadcast(chosen), "doc_id")  # two numbers for each of max_labelled rows
    rows = document_features(taught, text).select("_y", "features").toPandas()  # max_labelled rows at most
    x = np.asarray(rows["features"].tolist(), float).reshape(-1, len(FEATURES))
    return fit_trees(x, rows["_y"].to_numpy(float), **params)


def score_quality(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """docs with ``score``, the probability of label 1; empty and null texts are scored as texts without any word.

    Repeated rows score alike; an empty table gives no rows; a column named score is replaced."""
    kept = docs.drop("score")
    at, columns = kept.columns.index(text), kept.columns

    def run(batches_):
        for batch in small(batches_):
            x = features_of(as_bytes(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(trees.score(x))], [*columns, "score"])

    return kept.mapInArrow(run, kept.select("*", F.lit(0.0).alias("score")).schema)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    """The quality of all documents by trees fitted outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id", 5) != 0)
    trees = fit_quality(docs, labels)
    scored = score_quality(docs, trees).withColumn("held_out", fold("doc_id", 5) == 0)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
