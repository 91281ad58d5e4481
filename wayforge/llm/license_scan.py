"""License scans: templates with optional and replaceable regions, compiled to token automata."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from wayforge.llm.common import LOWER, as_bytes, small
from wayforge.llm.license_texts import TEXTS

#: A-Z to a-z; ASCII that is neither letter nor digit to a blank; bytes over 127 stay.
WORDS = bytes(LOWER[b] if chr(b).isalnum() or b > 127 else 32 for b in range(256))

#: Fixed phrases that must be found wherever their words stand consecutively, and their labels.
BASE_PHRASES = {
    b"under the mit license": "mit",
    b"apache license version 2": "apache-2",
    b"cc by nc": "cc-by-nc",
}

#: Notices by label, to which the license texts are added. <<optional>> ... <<end>> may be missing; <<any MIN MAX>> stands for so many words of any kind;
#: <<match REGEX>> for one word that the expression matches in full. All other words are mandatory.
TEMPLATES = {
    "mit-notice": "<<optional>>this <<any 1 3>> is<<end>> <<match released|licensed|distributed|available>> under the <<optional>>terms of the<<end>> mit license",
    "apache-2.0-notice": "licensed under the apache license version 2 <<optional>>0<<end>> <<optional>>the license you may not use this file except in compliance with the license<<end>>",
    "gpl-3-notice": "<<optional>>this <<any 1 3>> is<<end>> licensed under the <<optional>>terms of the<<end>> gnu general public license <<optional>>as published by the free software foundation<<end>> <<optional>>either<<end>> version <<match 3>> <<optional>>or any later version<<end>>",
    "gpl-2-notice": "<<optional>>this <<any 1 3>> is<<end>> licensed under the <<optional>>terms of the<<end>> gnu general public license <<optional>>as published by the free software foundation<<end>> <<optional>>either<<end>> version <<match 2>> <<optional>>or any later version<<end>>",
    "cc-by-nc-notice": "<<match licensed|released|shared>> under <<optional>>a creative commons<<end>> cc by nc <<match 1|2|3|4>> <<match 0|5>> <<optional>>international<<end>>",
    "cc-by-notice": "<<match licensed|released|shared>> under <<optional>>a creative commons<<end>> cc by <<match 1|2|3|4>> <<match 0|5>> <<optional>>international<<end>>",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files <<optional>>the software<<end>> to deal in the software without restriction",
} | TEXTS


@dataclass
class Automaton:
    """states[i]: list of (test, next); test is a word, a compiled expression, or None for any word. empty[i]: moves without a word."""

    label: str
    states: list[list[tuple]] = field(default_factory=lambda: [[]])
    empty: list[list[int]] = field(default_factory=lambda: [[]])
    total: int = 0
    anchor: bytes = b""

    def state(self) -> int:
        self.states.append([])
        self.empty.append([])
        return len(self.states) - 1

    def closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def match(self, words: list[bytes], start: int) -> tuple[int, int] | None:
        """(end, literal words matched) of the longest text accepted from start on."""
        now, best = {s: 0 for s in self.closure({0})}, None
        for i in range(start, len(words)):
            then: dict[int, int] = {}
            for s, n in now.items():
                for test, to in self.states[s]:
                    if test is None or (words[i] == test if isinstance(test, bytes) else test.fullmatch(words[i])):
                        for t in self.closure({to}):
                            then[t] = max(then.get(t, -1), n + (test is not None))
            now = then
            if not now:
                break
            if (end := len(self.states) - 1) in now:
                best = (i + 1, now[end])
        return best


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of a template; its anchor is its longest run of mandatory plain words."""
    a, at, opened, runs, run = Automaton(label), 0, [], [], []
    tokens = [x for part in re.split(r"(<<[^>]*>>)", markup) for x in ([part] if part.startswith("<<") else part.encode().translate(WORDS).decode().split())]
    for token in tokens:
        plain = not token.startswith("<<")
        if plain and not opened:
            run.append(token.encode())
        elif run:
            runs.append(run)
            run = []
        if token == "<<optional>>":
            opened.append(at)
        elif token == "<<end>>":
            after = a.state()
            a.empty[at].append(after)
            a.empty[opened.pop()].append(after)
            at = after
        elif token.startswith("<<any "):
            low, high = map(int, token[6:-2].split())
            exits = [at] if low == 0 else []
            for k in range(1, high + 1):
                to = a.state()
                a.states[at].append((None, to))
                at = to
                if k >= low:
                    exits.append(at)
            after = a.state()
            for s in exits:
                a.empty[s].append(after)
            at = after
        else:
            to = a.state()
            a.states[at].append((token.encode() if plain else re.compile(token[8:-2].encode()), to))
            a.total += 1
            at = to
    if opened:
        raise ValueError(f"{label}: <<optional>> without <<end>>")
    runs.append(run)
    end = a.state()
    a.empty[at].append(end)
    a.anchor = b" " + b" ".join(max(runs, key=len)) + b" "
    if a.anchor == b"  ":
        raise ValueError(f"{label}: no mandatory word")
    return a


def _places(joined: bytes, phrase: bytes) -> list[int]:
    out, at = [], joined.find(phrase)
    while at >= 0:
        out.append(at)
        at = joined.find(phrase, at + 1)
    return out


def scan_text(data: bytes, automata: list[Automaton], phrases: dict[bytes, str] = BASE_PHRASES) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of a text.

    spans: (label, first word, end word) of each accepted template; score: the largest share of a template's words,
    optional ones included, that an accepted text has, else 0."""
    words = data.translate(WORDS).split()
    joined = b" " + b" ".join(words) + b" "
    base, labels, starts, score, spans = 0, set(), [], 0.0, []
    for phrase, label in phrases.items():
        if places := _places(joined, b" " + phrase + b" "):
            base += len(places)
            labels.add(label)
            starts += [places[0], places[-1]]
    firsts = sorted(joined.count(b" ", 0, p) for p in (min(starts), max(starts))) if starts else [None, None]
    every = set(labels)
    for a in automata:
        if a.anchor not in joined:
            continue
        heads = [t for s in a.closure({0}) for t, _ in a.states[s]]
        for i, w in enumerate(words):
            if any(t is None or (w == t if isinstance(t, bytes) else t.fullmatch(w)) for t in heads) and (found := a.match(words, i)):
                every.add(a.label)
                score = max(score, found[1] / a.total)
                spans.append((a.label, i, found[0]))
    return len(words), base, firsts[0], firsts[1], ",".join(sorted(labels)), ",".join(sorted(every)), score, spans


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels, score and spans; see scan_text.

    A null text counts as empty: no words, no labels, score 0. Repeated rows are scanned alike, an empty table gives none.
    Of templates that accept a text with equal shares the score is the same; all their labels are listed. One pass without
    a shuffle. Columns of these names are replaced."""
    added = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label: string, first: long, end: long>>"
    names = [x.split()[0] for x in re.sub(r"<.*>", "", added).split(", ")]
    kept = docs.select([c for c in docs.columns if c not in names])
    at = kept.columns.index(text)
    spark_schema = StructType([*kept.schema.fields, *kept.sparkSession.createDataFrame([], added).schema.fields])
    span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]

    def scan(batches):
        automata = [compile_template(k, v) for k, v in templates.items()]
        for batch in small(batches, 200):
            found = [scan_text(t, automata) for t in as_bytes(batch.column(at))]
            cols = list(zip(*found)) if found else [[]] * len(names)
            cols[-1] = [[{"label": x, "first": y, "end": z} for x, y, z in s] for s in cols[-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(cols, kinds))], spark_schema.names)

    return kept.mapInArrow(scan, spark_schema)


def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    """License phrases and templates in every whole text of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_licenses(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
