"""Language identification by rank-order profiles (out-of-place distance of n-gram ranks)."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayforge.llm.common import as_texts, fold, small

#: Whether a character of the basic plane is a letter: no digit or number of any kind, no mark.
_LETTER = np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)
BLANK = 32
_BREAK = re.compile(r"\s")
#: Characters of a text counted at once; longer texts are cut between words, which changes no count.
PIECE = 1 << 20


def letters(text: str) -> np.ndarray:
    """Characters of a text in small letters, each run of anything but letters as one blank, with a blank at either end."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    known = _LETTER[np.minimum(a, (1 << 16) - 1)]
    for i in np.flatnonzero(a >= 1 << 16):
        known[i] = chr(a[i]).isalpha()
    a = np.where(known, a, BLANK)
    a = a[known | np.r_[False, known[:-1]]] if len(a) else a
    return np.r_[BLANK, a, BLANK] if len(a) and a[-1] != BLANK else np.r_[BLANK, a]


def grams_of(text: str, max_n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the n-grams (1 to max_n characters) of a text's words, each padded by one blank on either side.

    A code packs up to three characters in 63 bits, the first one highest."""
    if len(text) > PIECE:
        held = counted(np.zeros(0, np.int64))
        for piece in pieces(text):
            codes, n = grams_of(piece, max_n) if len(piece) <= PIECE else _grams(piece, max_n)
            held = counted(np.r_[held[0], codes], np.r_[held[1], n])
        return held
    return _grams(text, max_n)


def pieces(text: str):
    """Parts of a text of about PIECE characters, cut at white space; a longer run without any stays whole."""
    at = 0
    while at < len(text):
        end = _BREAK.search(text, min(at + PIECE - 1, len(text)))
        end = end.end() if end else len(text)
        cut = max((text.rfind(c, at, at + PIECE) for c in " \n\t\r"), default=-1)
        end = cut + 1 if cut > at else end
        yield text[at:end]
        at = end


def _grams(text: str, max_n: int) -> tuple[np.ndarray, np.ndarray]:
    a = letters(text)
    codes = [a[a != BLANK]]
    if max_n > 1:
        codes.append(a[:-1] << 21 | a[1:])
    if max_n > 2:
        codes.append((a[:-2] << 42 | a[1:-1] << 21 | a[2:])[a[1:-1] != BLANK])
    return counted(np.concatenate(codes) if len(a) > 1 else a[:0])


def counted(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and how often they occur, or the sums of their counts."""
    if counts is None:
        codes = np.sort(codes)
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else codes
        return codes[first], np.diff(np.r_[first, len(codes)])
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else codes
    return codes[first], np.add.reduceat(counts[order], first) if len(codes) else counts


def top(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, ties by code."""
    if len(codes) > 4 * size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))[:size]]


def language_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = 400, max_n: int = 3) -> DataFrame:
    """(lang, gram, rank) of the ``size`` most frequent n-grams of each language over all labelled texts.

    Every partition sums its own n-grams first, and ranks what it got of a language before that meets in one task; rows with a null text or language teach nothing. An empty table gives
    no rows. max_n is 3 at most, as a gram is packed in one long."""
    if not 1 <= max_n <= 3:
        raise ValueError("max_n must be 1, 2 or 3")

    def count(batches):
        held: dict[str, list[str]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(k):
            codes, n = grams_of(" ".join(held.pop(k)), max_n)
            if k in sums:
                codes, n = counted(np.r_[sums[k][0], codes], np.r_[sums[k][1], n])
            sums[k] = codes, n

        size: dict[str, int] = {}
        for batch in small(batches):
            for t, k in zip(as_texts(batch.column(0)), as_texts(batch.column(1))):
                held.setdefault(k, []).append(t)
                size[k] = size.get(k, 0) + len(t)
                if size[k] > 1 << 20:
                    size[k] = 0
                    add(k)
        for k in list(held):
            add(k)
        for k, (codes, n) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["lang", "gram", "n"])

    sums = labelled.select(F.col(text).alias("t"), F.col(lang).alias("k")).where("t is not null and k is not null").mapInArrow(count, "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = sums.groupBy("lang", "gram").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    return ranked.select("lang", "gram", (F.col("rank") - 1).alias("rank"))


def identify_language(docs: DataFrame, profiles: DataFrame, text: str = "text", size: int = 400, max_n: int = 3, max_languages: int = 2000) -> DataFrame:
    """docs with lang_pred and score: the language with the least out-of-place distance.

    The distance sums, over the text's ``size`` most frequent n-grams, how far each one's rank is from its rank in the
    language's profile; an n-gram that the profile lacks counts ``size``. The score is 1 - distance / (n-grams * size).
    Ties go to the first language by name. A text that is null or has no letter, and every text when no profile exists,
    is ``und`` with score 0. Repeated rows are predicted alike, an empty table gives none, and columns named lang_pred or
    score are replaced. Bytes that are not UTF-8 are read as U+FFFD. The profiles are size * languages rows; over max_languages they are refused."""
    schema = docs.drop("lang_pred", "score")
    columns, at_text, best = schema.columns, schema.columns.index(text), _predictor(profiles, size, max_n, max_languages)
    out_schema = schema.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def predict(batches):
        for batch in small(batches):
            langs, scores = best(as_texts(batch.column(at_text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*columns, "lang_pred", "score"])

    return schema.mapInArrow(predict, out_schema)


def _predictor(profiles: DataFrame, size: int = 400, max_n: int = 3, max_languages: int = 2000):
    """A function from texts to their languages and scores; see identify_language."""
    rows = profiles.groupBy("lang").agg(F.collect_list(F.struct("rank", "gram")).alias("grams")).orderBy("lang").limit(max_languages + 1).collect()
    if len(rows) > max_languages:
        raise ValueError(f"over {max_languages} languages")
    names = [r["lang"] for r in rows]
    known = np.unique(np.asarray([g["gram"] for r in rows for g in r["grams"]], np.int64))
    ranks = np.full((len(names), len(known) + 1), size, np.int32)  # the last column is for n-grams that no profile has
    missing = np.ones_like(ranks, bool)
    for i, r in enumerate(rows):
        at = np.searchsorted(known, np.asarray([g["gram"] for g in r["grams"]], np.int64))
        ranks[i, at] = [g["rank"] for g in r["grams"]]
        missing[i, at] = False

    def best_of(texts: list) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for t in texts:
            codes, n = grams_of(t, max_n) if t and names else (known[:0], known[:0])
            if not len(codes):
                langs.append("und")
                scores.append(0.0)
                continue
            best = top(codes, n, size)
            at = np.searchsorted(known, best)
            at[at == len(known)] = 0
            at = np.where(known[at] == best, at, len(known))
            far = np.where(missing[:, at], size, np.abs(ranks[:, at] - np.arange(len(best), dtype=np.int32))).sum(axis=1)
            k = int(far.argmin())
            langs.append(names[k])
            scores.append(1.0 - float(far[k]) / (size * len(best)))
        return langs, scores

    return best_of


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicts the language of all documents from profiles of those outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", fold("doc_id", 4) == 2)
    profiles = language_profiles(docs.where("not held_out"))
    return identify_language(docs.select("doc_id", "text", "held_out"), profiles).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(spark, docs: DataFrame, min_score: float = 0.02) -> DataFrame:
    """Pipeline stage: learns profiles from the folds that op6 learns from and drops documents without a language.

    Dropped are texts that are null or without letters, and texts whose best score is under min_score, which no text
    written with a learned language's letters comes near. Bytes that are not UTF-8 are read as U+FFFD. Rows are dropped inside the workers; columns may have any names."""
    best, at = _predictor(language_profiles(docs.where(fold("doc_id", 4) != 2))), docs.columns.index("text")

    def identified(batches):
        for batch in small(batches):
            langs, scores = best(as_texts(batch.column(at)))
            yield batch.filter(pa.array([k != "und" and x >= min_score for k, x in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(identified, docs.schema)
