"""Benchmark decontamination: shared n-gram seeds pair passages with test items, Smith-Waterman alignment scores the pairs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import as_texts, hashed_texts, ngrams, small

#: Blanks for ASCII that is neither letter nor digit; texts are made small before.
PLAIN = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
#: Items are taken in blocks of about so many bytes of text, each against all documents.
BLOCK_BYTES = 16 << 20
#: Hits of a text are compared with so many at once, a range of passages after the other.
HITS = 1 << 21
#: Longer items are cut into passages of so many words, each beginning STRIDE words after the last.
PASSAGE, STRIDE = 400, 300
MATCH, MISMATCH, GAP = 2, -1, 1


@dataclass
class Passages:
    """The passages of a block of items and their seeds, sorted by hash."""

    items: list
    words: list[np.ndarray]
    hashes: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    seeds: np.ndarray  # of each passage
    short: dict  # by a number of words below the least, and by the hash of all the words: the items that are these words

    def find(self, grams: np.ndarray) -> np.ndarray:
        """Positions in grams of those that are seeds."""
        if not hasattr(self, "_bits"):
            self._bits = np.zeros(1 << 22, bool)
            self._bits[(self.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        at = np.flatnonzero(self._bits[(grams & np.uint64((1 << 22) - 1)).astype(np.int64)])
        if not len(at) or not len(self.hashes):
            return at[:0]
        k = np.searchsorted(self.hashes, grams[at])
        return at[self.hashes[np.minimum(k, len(self.hashes) - 1)] == grams[at]]

    def first_of(self, grams: np.ndarray, k: int) -> np.ndarray:
        """For each of grams, which are seeds, the place of its first seed of passage k or a later one."""
        if not hasattr(self, "_ranks"):
            new = np.r_[True, self.hashes[1:] != self.hashes[:-1]]
            self._distinct, self._ranks = self.hashes[new], (np.cumsum(new) - 1) * (len(self.items) + 1) + self.owner
        return np.searchsorted(self._ranks, np.searchsorted(self._distinct, grams) * (len(self.items) + 1) + k)


def normal(texts: list) -> list[bytes]:
    return [(t or "").lower().encode() for t in texts]


def cut_items(ids: list, texts: list, n: int, min_words: int) -> Passages:
    """Passages with every n-gram as a seed; items of under min_words words are kept whole, by the hash of their words."""
    items, words, short = [], [], {}
    for i, h in zip(ids, hashed_texts(normal(texts), PLAIN)):
        if len(h) >= max(min_words, n):
            for at in range(0, max(len(h) - (PASSAGE - STRIDE), 1), STRIDE):
                items.append(i)
                words.append(h[at : at + PASSAGE])
        elif len(h):
            short.setdefault(len(h), {}).setdefault(int(ngrams(h, len(h))[0]), []).append(i)
    grams = [ngrams(w, n) for w in words]
    sizes = [len(g) for g in grams]
    hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(grams)), sizes)
    place = np.concatenate([np.arange(s) for s in sizes]) if grams else np.zeros(0, np.int64)
    order = np.argsort(hashes, kind="stable")
    return Passages(items, words, hashes[order], owner[order], place[order], np.asarray(sizes, int), short)


def keep_held(p: Passages, held: np.ndarray) -> Passages:
    """The passages with those seeds alone whose hash is among ``held``, the n-grams that documents hold: all of them,
    for an edited copy may hold any, and the rarest are the ones that its edits have destroyed."""
    chosen = np.flatnonzero(np.isin(p.hashes, held))
    owner = p.owner[chosen]
    return Passages(p.items, p.words, p.hashes[chosen], owner, p.place[chosen], np.bincount(owner, minlength=len(p.items)), p.short)


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and where it ends in the text, all pairs at once, row by row."""
    if not items:
        return np.zeros(0), np.zeros(0, int)
    rows, width = max(map(len, items)), max(map(len, texts))
    a, b = np.zeros((len(items), rows), np.uint64), np.ones((len(items), width), np.uint64)
    for k, (x, y) in enumerate(zip(items, texts)):
        a[k, : len(x)], b[k, : len(y)] = x, y
    slope = np.arange(width, dtype=np.int32) * GAP
    last = np.zeros((len(items), width + 1), np.int32)
    best, end = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for i in range(rows):
        step = np.where(b == a[:, i : i + 1], MATCH, MISMATCH).astype(np.int32)
        now = np.maximum(np.maximum(last[:, :-1] + step, last[:, 1:] - GAP), 0)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        here = now.argmax(1)
        value = now[np.arange(len(items)), here]
        better = value > best
        best[better], end[better] = value[better], here[better]
        last[:, 1:] = now
    return best, end


def leaks_of(h: np.ndarray, p: Passages, n: int, least: float, min_hits: int) -> list[tuple]:
    """(item, score, hits, first word, last word) of the items that a text of word hashes h holds."""
    found: dict = {}
    for length, items in p.short.items():
        if len(h) >= length:
            grams = ngrams(h, length)
            for k in np.flatnonzero(np.isin(grams, np.fromiter(items, np.uint64, len(items)))).tolist():
                for i in items[int(grams[k])]:
                    found.setdefault(i, (1.0, 1, k, k + length - 1))
    grams = ngrams(h, n) if len(h) >= n else h[:0]
    at = p.find(grams)
    if len(at):
        low, high = np.searchsorted(p.hashes, grams[at], "left"), np.searchsorted(p.hashes, grams[at], "right")
        parts = int((high - low).sum()) // HITS + 1
        bounds = np.linspace(0, len(p.items), parts + 1).astype(int)
        for first, last in zip(bounds[:-1], bounds[1:]):
            if parts > 1:  # the seeds of a hash are in the order of their passages
                low, high = (p.first_of(grams[at], k) for k in (first, last))
            _align_hits(h, p, at, low, high, least, min_hits, found)
    return sorted(((i, *v) for i, v in found.items()), key=lambda r: (r[0] is None, r[0]))


def _align_hits(h: np.ndarray, p: Passages, at: np.ndarray, low: np.ndarray, high: np.ndarray, least: float, min_hits: int, found: dict) -> None:
    """Puts into found what alignment finds of the passages whose seeds low to high stand at the places ``at`` of a text."""
    times = high - low
    seed = np.repeat(low - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
    where, owner = np.repeat(at, times), p.owner[seed]
    enough = np.bincount(owner, minlength=len(p.items))[owner] >= np.minimum(min_hits, p.seeds[owner])
    where, owner, seed = where[enough], owner[enough], seed[enough]
    shift = where - p.place[seed]
    order = np.lexsort((shift, owner))
    owner, shift, seed = owner[order], shift[order], seed[order]
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else [0]
    jobs = []
    for s, e in zip(cuts[:-1], cuts[1:]):
        k = int(owner[s])
        m = len(p.words[k])
        slack = max(6, m // 3)
        own = shift[s:e]
        # runs of hits on neighbouring diagonals, each with all copies that have a hit in it
        for a, b, hits in _runs(own, seed[s:e], slack, min(min_hits, int(p.seeds[k]))):
            first = max(0, int(own[a]) - 2 * slack)
            text = h[first : int(own[b - 1]) + m + 2 * slack]
            # an alignment has no more matches than words that the text holds
            if np.isin(p.words[k], text).sum() >= least * m:
                jobs.append((k, hits, first, text))
    for i in range(0, len(jobs), 64):
        part = sorted(jobs[i : i + 64], key=lambda j: len(j[3]))
        score, end = align([p.words[j[0]] for j in part], [j[3] for j in part])
        for (k, hits, first, _), value, stop in zip(part, score.tolist(), end.tolist()):
            share = value / (MATCH * len(p.words[k]))
            was = found.get(p.items[k], (0, 0, 0))
            if share >= least and (share, -first) > (was[0], -was[2]):
                found[p.items[k]] = (share, hits, first, first + stop)


def _runs(shift: np.ndarray, seed: np.ndarray, slack: int, need: int):
    """Bounds of runs of sorted diagonals that span at most twice the slack, and their numbers of seeds, of which there
    are ``need`` at least. A run begins at the first diagonal with so many, so two hits of a copy are never parted by a
    stray one before them, unless one of them is in a run."""
    ends = np.searchsorted(shift, shift + 2 * slack, "right")
    a = 0
    while a < len(shift):
        b = int(ends[a])
        hits = len(np.unique(seed[a:b])) if b - a >= need else 0
        if hits >= need:
            yield a, b, hits
            a = b
        else:
            a += 1


def _item_blocks(docs: DataFrame, benchmark: DataFrame, text: str, n: int, min_words: int):
    """Yields broadcast Passages of blocks of items, with those seeds that documents hold.

    A block has about BLOCK_BYTES of text, so what is collected and broadcast is bounded, whatever the benchmark's size."""
    spark = docs.sparkSession
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    for block in range(blocks):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("item_id", "text").where("text is not null").toArrow()
        passages = cut_items(rows["item_id"].to_pylist(), as_texts(rows["text"]), n, min_words)
        if not passages.items and not passages.short:
            continue

        def held(batches, passages=passages):
            have = np.zeros(len(passages.hashes), bool)
            for batch in small(batches):
                for h in hashed_texts(normal(as_texts(batch.column(0))), PLAIN):
                    grams = ngrams(h, n) if len(h) >= n else h[:0]
                    have[np.searchsorted(passages.hashes, grams[passages.find(grams)])] = True
            yield pa.RecordBatch.from_arrays([pa.array(passages.hashes[have].view(np.int64))], ["gram"])

        seen = docs.select(text).mapInArrow(held, "gram long").distinct().toArrow()["gram"].to_numpy()
        yield spark.sparkContext.broadcast(keep_held(passages, seen.view(np.uint64)))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", n: int = 3, least: float = 0.5, min_hits: int = 2, min_words: int = 8) -> DataFrame:
    """docs with ``leaks``: the benchmark items (item_id, text) whose wording a document holds, whole or edited.

    Words are runs of letters and digits, in small letters. An item's seeds are its n-grams, as far as
    documents hold them; a document with min_hits seeds of a passage near one diagonal is aligned with it, and the score
    is the alignment's share of the perfect one, of equal ones the first in the text. An item with fewer seeds needs all
    of them; a copy whose edits leave fewer than min_hits n-grams whole is not found. An item of under min_words words
    leaks where its words stand whole, in order, with a score of 1; items and texts without words, and nulls, leak
    nowhere; items longer than PASSAGE words leak if one of their passages does. Ids of items have any type; repeated
    items count once an id. Empty tables give no leaks. Items are taken in blocks of bounded bytes, so the benchmark may
    grow; documents are never shuffled. Bytes that are not UTF-8 are read as U+FFFD, which is no word. A column named leaks is replaced."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

    item = StructType([StructField("item_id", benchmark.schema["item_id"].dataType), StructField("score", DoubleType()), *(StructField(c, LongType()) for c in ("hits", "first_word", "last_word"))])
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(ArrayType(item)))
    at, schema, kind = out.columns.index(text), out.schema, to_arrow_type(ArrayType(item))
    for shared in _item_blocks(docs, benchmark, text, n, min_words):

        def search(batches, shared=shared):
            for batch in small(batches):
                texts = normal(as_texts(batch.column(at)))
                leaks = [[*x, *({"item_id": i, "score": s, "hits": k, "first_word": a, "last_word": b} for i, s, k, a, b in leaks_of(h, shared.value, n, least, min_hits))] for x, h in zip(batch.column(len(batch.columns) - 1).to_pylist(), hashed_texts(texts, PLAIN))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(leaks, kind)], schema.names)

        out = out.mapInArrow(search, schema)
    return out


def op1_decontamination(spark, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, score, hits, first_word, last_word) of the benchmark items that documents hold; nulls, ties and
    repeated rows as in find_leaks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def keep_uncontaminated(spark, docs: DataFrame, benchmark: DataFrame, n: int = 3, least: float = 0.5, min_hits: int = 2, min_words: int = 8) -> DataFrame:
    """Pipeline stage: drops the documents that hold a benchmark item, as find_leaks does; columns may have any names.

    Rows are dropped inside the workers, which get each text once."""
    at, out = docs.columns.index("text"), docs
    for shared in _item_blocks(docs, benchmark, "text", n, min_words):

        def clean(batches, shared=shared):
            for batch in small(batches):
                keep = [not leaks_of(h, shared.value, n, least, min_hits) for h in hashed_texts(normal(as_texts(batch.column(at))), PLAIN)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        out = out.mapInArrow(clean, docs.schema)
    return out
