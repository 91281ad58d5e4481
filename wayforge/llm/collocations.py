"""Phrase collocations counted in counting quotient filters.

Words that are frequent enough get dense numbers; an n-gram is packed into its words' numbers, and a Feistel network
permutes the packed bits, which can be undone: the left part becomes the quotient, the rest the remainder. A filter
keeps its items sorted: for each quotient in unary how many remainders it has, the remainders in full and a count for
each, so nothing is lost. Packs of texts build a filter each, cut into blocks of quotients; filters of a block are
merged in sorted order, and the frequent n-grams are read back from it by undoing the permutation.
"""

from __future__ import annotations

import functools
from collections import Counter
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayforge.llm.common import LOWER, Staging, as_bytes, decode, encode, mix, packer, small

#: Bytes of text in a pack, and n-grams (about) in a block of quotients.
PACK_BYTES, BLOCK_ITEMS = 4 << 20, 1_000_000
#: Blocks that a filter is cut into at once, as bits; more are reached by merging filters and cutting again.
FAN_BITS = 10
#: Parts of a language whose first phrases are found apart.
RANKED_PARTS = 16
#: Word numbers have so many bits at most, as two of them are one remainder.
MOST_BITS = 32
#: What ends a piece of text; ends become full stops, tabs become blanks.
ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes(ord(".") if b in ENDS else ord(" ") if b == 9 else b for b in LOWER)


# -- filters -----------------------------------------------------------------------------------------------------------


def permuted(left: np.ndarray, right: np.ndarray, bits: int, rest: int, undo: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of numbers of so many bits, permuted by four rounds of a Feistel network, or permuted back."""
    sides, masks = [left.astype(np.uint64), right.astype(np.uint64)], [np.uint64((1 << bits) - 1), np.uint64((1 << rest) - 1)]
    for r in reversed(range(4)) if undo else range(4):
        side = r % 2
        sides[side] = sides[side] ^ (mix(sides[1 - side] + np.uint64(0x9E3779B97F4A7C15 + r)) & masks[side])
    return sides[0], sides[1]


def summed(quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct items in order, with their summed counts."""
    by = np.lexsort((remainders, quotients))
    q, r = quotients[by], remainders[by]
    first = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (r[1:] != r[:-1])]) if len(q) else np.zeros(0, np.int64)
    n = np.diff(np.r_[first, len(q)]) if counts is None else np.add.reduceat(counts[by], first) if len(q) else counts
    return q[first], r[first], n.astype(np.uint64)


def to_filter(q: np.ndarray, r: np.ndarray, n: np.ndarray, low: int, span: int) -> tuple[bytes, bytes, bytes]:
    """The sorted items with quotients from ``low`` on, of ``span`` quotients: unary run lengths, remainders, counts."""
    bits = np.ones(len(q) + span, bool)
    sizes = np.bincount((q - np.uint64(low)).astype(np.int64), minlength=span)
    bits[np.cumsum(sizes) + np.arange(span)] = False
    return packer(1).compress(np.packbits(bits).tobytes()), encode(r), encode(n)


def from_filter(runs: bytes, rest: bytes, counts: bytes, low: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r, n = decode(rest, np.uint64), decode(counts, np.uint64)
    bits = np.unpackbits(np.frombuffer(packer().decompress(runs), np.uint8), count=len(r) + span)
    ends = np.flatnonzero(bits == 0)
    sizes = np.diff(ends, prepend=-1) - 1
    return np.repeat(np.arange(span, dtype=np.uint64) + np.uint64(low), sizes), r, n


#: A block of a filter: size of its n-grams, leading bits of its quotients, who made it.
PARTS = "n int, block long, unit long, runs binary, rest binary, counts binary"
_NAMES = [x.split()[0] for x in PARTS.split(", ")]


def blocks_of(q, r, c, size: int, unit: int, bits: int, depth: int, first: int = 0, blocks: int | None = None) -> pd.DataFrame:
    """PARTS rows of sorted items: a row for each of the blocks, 2 ** depth in all, that has any."""
    span = 1 << (bits - depth)
    blocks = 1 << depth if blocks is None else blocks
    cuts = np.searchsorted(q, np.arange(first, first + blocks + 1, dtype=np.uint64) * np.uint64(span))
    rows = [(size, first + k, unit, *to_filter(q[a:b], r[a:b], c[a:b], (first + k) * span, span)) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
    return pd.DataFrame(rows, columns=_NAMES)


def _merge(group: pd.DataFrame, bits: int, depth: int):
    """The summed items of a block's filters."""
    span, low = 1 << (bits - depth), int(group["block"].iloc[0]) << (bits - depth)
    parts = [from_filter(*x, low, span) for x in zip(group["runs"], group["rest"], group["counts"])]
    return summed(*(np.concatenate([p[k] for p in parts]) for k in range(3)))


def _cut_again(group: pd.DataFrame, bits: int, depth: int, further: int) -> pd.DataFrame:
    first = int(group["block"].iloc[0]) << further
    return blocks_of(*_merge(group, bits, depth), int(group["n"].iloc[0]), int(group["merged"].iloc[0]), bits, depth + further, first, 1 << further)


def _frequent(group: pd.DataFrame, bits: int, depth: int, least: int) -> pd.DataFrame:
    """(n, w1, w2, w3, a) of the items of a block that are counted ``least`` times."""
    size = int(group["n"].iloc[0])
    q, r, a = _merge(group, bits, depth)
    some = a >= least
    first, rest = permuted(q[some], r[some], bits, bits * (size - 1), undo=True)
    last = rest & np.uint64((1 << bits) - 1)
    second, third = (rest >> np.uint64(bits), last) if size == 3 else (last, np.zeros_like(last))
    return pd.DataFrame({"n": np.int32(size), "w1": first.astype(np.int64), "w2": second.astype(np.int64), "w3": third.astype(np.int64), "a": a[some].astype(np.int64)})


def merged_filters(parts: DataFrame, bits: int, depth: int, block_bits: int, least: int, staging: Staging) -> DataFrame:
    """Frequent n-grams of filters that are cut by ``depth`` bits. Until that is block_bits, filters of a block are merged,
    so many that they have a block's items, and cut again: no filter is cut into more than 2 ** FAN_BITS rows at once."""
    while depth < block_bits:
        further, groups = min(FAN_BITS, block_bits - depth), 1 << (block_bits - depth)
        merged = parts.withColumn("merged", F.pmod(F.xxhash64("unit"), F.lit(groups)).cast("long"))
        parts = staging.keep(merged.groupBy("n", "block", "merged").applyInPandas(functools.partial(_cut_again, bits=bits, depth=depth, further=further), PARTS), "merged")
        depth += further
    return parts.groupBy("n", "block").applyInPandas(functools.partial(_frequent, bits=bits, depth=depth, least=least), "n int, w1 long, w2 long, w3 long, a long")


# -- texts -------------------------------------------------------------------------------------------------------------


def pack_texts(docs: DataFrame) -> DataFrame:
    """(unit, langs, ends, blob): runs of texts, lower-cased, by language; docs: lang, text. Long texts are cut at ends of pieces."""

    def pieces(data: bytes):
        while len(data) > PACK_BYTES and (cut := max(data.rfind(b".", 0, PACK_BYTES), data.find(b"."))) >= 0:
            yield data[:cut]
            data = data[cut + 1 :]
        yield data

    def run(batches):
        made, size, task = 0, 0, TaskContext.get().partitionId()
        held: dict[str, list[bytes]] = {}

        def flush():
            nonlocal made, size, held
            texts = [b".".join(t) for t in held.values()]
            row = [pa.array([(task << 24) + made], pa.int64()), pa.array([list(held)], pa.list_(pa.string())), pa.array([np.cumsum([len(t) for t in texts]).tolist()], pa.list_(pa.int64())), pa.array([packer(3).compress(b"".join(texts))], pa.binary())]
            made, size, held = made + 1, 0, {}
            return pa.RecordBatch.from_arrays(row, ["unit", "langs", "ends", "blob"])

        for batch in batches:
            for part in small([batch], 200):
                for lang, text in zip(part.column(0).to_pylist(), as_bytes(part.column(1))):
                    for piece in pieces(text.translate(TABLE)):
                        held.setdefault(lang, []).append(piece)
                        size += len(piece) + 1
                        if size >= PACK_BYTES:
                            yield flush()
        if held:
            yield flush()

    return docs.mapInArrow(run, "unit long, langs array<string>, ends array<long>, blob binary")


def tokens(ends, blob: bytes) -> list[list[bytes]]:
    """The words of each language of a pack, with a full stop after each piece."""
    data = packer().decompress(blob)
    return [data[a:b].replace(b".", b" . ").split() for a, b in zip([0, *list(ends)[:-1]], ends)]


def _words(batches):
    """(unit, lang, word, n) of the words of each pack."""
    for batch in batches:
        for unit, langs, ends, blob in zip(*(c.to_pylist() for c in batch.columns)):
            for lang, words in zip(langs, tokens(ends, blob)):
                found = Counter(words)
                found.pop(b".", None)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([unit] * len(found), pa.int64()), pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["unit", "lang", "word", "n"]
                    )


def _filters(pack: pd.DataFrame, known: pd.DataFrame, bits: int, depth: int) -> pd.DataFrame:
    """The blocks of a pack's filters of pairs and triples of numbered words."""
    if not len(pack) or not len(known):
        return pd.DataFrame(columns=_NAMES)
    numbers: dict[str, dict] = {lang: dict(zip(own["word"], own["id"])) for lang, own in known.groupby("lang")}
    row, ids = pack.iloc[0], []
    for lang, words in zip(row["langs"], tokens(row["ends"], row["blob"])):
        ids += [np.fromiter(map(numbers.get(lang, {}).get, words, repeat(0)), np.uint64, len(words)), np.zeros(1, np.uint64)]
    ids, out = np.concatenate(ids), []
    a, b = ids[:-1], ids[1:]
    pair = (a > 0) & (b > 0)
    three = np.flatnonzero(pair[:-1] & pair[1:])
    for size, left, right in ((2, a[pair], b[pair]), (3, a[three], (b[three] << np.uint64(bits)) | ids[three + 2])):
        items = summed(*permuted(left, right, bits, bits * (size - 1)))
        out.append(blocks_of(*items, size, int(row["unit"]), bits, depth))
    return pd.concat([x for x in out if len(x)] or out)


def numbered(words: DataFrame, staging: Staging) -> tuple[DataFrame, int]:
    """words with ``id``, dense from 1, and how many there are: places in the files written, shifted by their counts."""
    kept = staging.keep(words.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", 33).alias("_part")
    counts, before, shifts = kept.groupBy(part).agg(F.count("*").alias("n")).orderBy("_part").collect(), 1, []  # one row a partition
    for r in counts:
        shifts.append((r["_part"], before))
        before += r["n"]
    side = words.sparkSession.createDataFrame(shifts, "_part long, _shift long")
    ids = kept.withColumn("_part", part).join(F.broadcast(side), "_part")  # one row a partition
    return ids.withColumn("id", F.col("_shift") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_shift", "_at"), before - 1


def floor_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    big = lambda c: f"cast({c} as decimal(20, 0))"
    return F.expr(f"({big(a)} * {big(a)} * 1000000) div ({big(left)} * {big(right)})")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 10, inside: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two or three words.

    Pieces of text end at ASCII ends of sentences and lines, words are runs without blanks and tabs, A-Z taken as a-z.
    A phrase counts if it occurs a >= least times; l and r are the counts of its first words and of the rest at the cut
    with the lowest score, floor(10**6 * a * a / (l * r)), or the first such cut; n is the number of words of the
    language. A pair inside a counted triple with at least ``inside`` hundredths of its own count is dropped. Equal
    scores are ranked by a, largest first, then by the phrase's bytes. Counts are exact and cover all rows, repeated ones
    each. A null language is ``und``; null and empty texts have no words; an empty table gives no rows. Bytes that are
    not UTF-8 are parts of words. Other columns are not read. Over 2**32 frequent words are refused."""
    spark = docs.sparkSession
    staging = Staging(spark, "collocations")
    packs = staging.keep(pack_texts(docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))), "packs")
    words = staging.keep(packs.mapInArrow(_words, "unit long, lang string, word binary, n long"), "words")
    totals = staging.keep(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    frequent, vocabulary = numbered(words.groupBy("lang", "word").agg(F.sum("n").alias("c")).where(F.col("c") >= least), staging)
    frequent = staging.keep(frequent, "frequent")
    bits, every = max(1, vocabulary.bit_length()), totals.agg(F.sum("n")).first()[0] or 0
    if bits > MOST_BITS:
        raise ValueError("too many words for their numbers")
    block_bits = min(bits, int(every // BLOCK_ITEMS).bit_length())
    depth = min(FAN_BITS, block_bits)
    own = words.select("unit", "lang", "word").join(frequent.select("lang", "word", "id"), ["lang", "word"])
    filters = packs.groupBy("unit").cogroup(own.groupBy("unit")).applyInPandas(functools.partial(_filters, bits=bits, depth=depth), PARTS)
    grams = staging.keep(merged_filters(filters, bits, depth, block_bits, least, staging), "grams")
    word = lambda k: frequent.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"t{k}"), F.col("c").alias(f"c{k}"), *(["lang"] if k == 1 else []))
    pairs = grams.where("n = 2").select("w1", "w2", "a")
    triples = grams.where("n = 3").select("w1", "w2", "w3", "a")
    longer = triples.select("w1", "w2", "a").union(triples.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("most"))
    kept = pairs.join(longer, ["w1", "w2"], "left").where(f"most is null or 100 * most < {inside} * a")
    two = kept.join(word(1), "w1").join(word(2), "w2").select("lang", F.concat_ws(" ", F.col("t1").cast("string"), F.col("t2").cast("string")).alias("phrase"), "a", F.col("c1").alias("l"), F.col("c2").alias("r"), floor_score("a", "c1", "c2").alias("score"))
    left = pairs.select("w1", "w2", F.col("a").alias("a12"))
    right = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("a23"))
    three = triples.join(left, ["w1", "w2"]).join(right, ["w2", "w3"]).join(word(1), "w1").join(word(2), "w2").join(word(3), "w3")
    cut = lambda s, x, y: F.struct(s.alias("score"), F.col(x).alias("l"), F.col(y).alias("r"))
    one, other = cut(floor_score("a", "c1", "a23"), "c1", "a23"), cut(floor_score("a", "a12", "c3"), "a12", "c3")
    three = three.withColumn("_cut", F.when(one["score"] <= other["score"], one).otherwise(other))
    three = three.select("lang", F.concat_ws(" ", *(F.col(f"t{k}").cast("string") for k in (1, 2, 3))).alias("phrase"), "a", "_cut.l", "_cut.r", "_cut.score")
    # the first of each part of a language, then of those: one task gets top rows a part at most, whatever the tasks before
    place = "row_number() over (partition by {} order by score desc, a desc, phrase)"
    parted = two.unionByName(three).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)))
    some = parted.withColumn("_place", F.expr(place.format("lang, _part"))).where(F.col("_place") <= top)
    ranked = some.withColumn("rank", F.expr(place.format("lang"))).where(F.col("rank") <= top)
    out = ranked.join(F.broadcast(totals) if totals.limit(10_001).count() <= 10_000 else totals, "lang")  # at most 10,000 languages
    kept = Staging(spark, "collocations-result").keep(out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "result")
    staging.clear()
    return kept


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language of all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ), words AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
    spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
    ones AS (SELECT lang, w[i] AS w1, count(*) AS a FROM spots GROUP BY ALL),
    twos AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS a FROM spots WHERE i + 1 <= len(w) GROUP BY ALL),
    threes AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS a FROM spots WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
    totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM ones GROUP BY lang),
    longer AS (
        SELECT lang, w1, w2, max(a) AS most
        FROM (SELECT lang, w1, w2, a FROM threes UNION ALL SELECT lang, w2, w3, a FROM threes) GROUP BY ALL
    ), cuts AS (
        SELECT x.lang, x.w1 || ' ' || x.w2 AS phrase, 1 AS k, x.a, p.a AS l, q.a AS r
        FROM twos x JOIN ones p ON p.lang = x.lang AND p.w1 = x.w1 JOIN ones q ON q.lang = x.lang AND q.w1 = x.w2
        LEFT JOIN longer t ON t.lang = x.lang AND t.w1 = x.w1 AND t.w2 = x.w2
        WHERE x.a >= 10 AND (most IS NULL OR 100 * most < 50 * x.a)
        UNION ALL
        SELECT x.lang, x.w1 || ' ' || x.w2 || ' ' || x.w3, 1, x.a, p.a, q.a
        FROM threes x JOIN ones p ON p.lang = x.lang AND p.w1 = x.w1 JOIN twos q ON q.lang = x.lang AND q.w1 = x.w2 AND q.w2 = x.w3
        UNION ALL
        SELECT x.lang, x.w1 || ' ' || x.w2 || ' ' || x.w3, 2, x.a, p.a, q.a
        FROM threes x JOIN twos p ON p.lang = x.lang AND p.w1 = x.w1 AND p.w2 = x.w2 JOIN ones q ON q.lang = x.lang AND q.w1 = x.w3
    ), scored AS (
        SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
    ), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM lowest JOIN totals USING (lang)
    QUALIFY rank <= 2000
"""
