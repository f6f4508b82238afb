"""License scan: exact set-similarity join of license templates with text blocks by containment.

Tokens of the templates are ordered by their frequency over all documents, rarest first; others match nothing and are
left out. A block is a run of as many words as the template has, or a whole shorter text, as a set in that order. It
holds at least `threshold` of a template's tokens only if it holds one of the template's first few (prefix filter), has
as many tokens as are asked for (length filter), and if from their first common token on both have as many left
(positional filter). What passes is counted exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Template texts by label, phrases that count wherever their words stand in a row, and their labels.
TEMPLATES = {
    "mit": "released under the mit license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under a creative commons attribution sharealike license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license",
    "public-domain": "this work is released into the public domain",
}
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Texts of licenses by label, each after a line of two equals signs and the label.
TEXTS = Path(__file__).with_name("license_texts.txt")
#: ASCII that isn't a digit or a letter separates words.
TABLE = bytes(c if c > 0x7F or chr(c).isalnum() else 32 for c in range(256))
RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks array<struct<label:string,start:long,words:long,containment:double>>"


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs of ASCII letters and digits and of anything beyond ASCII."""
    return (text or "").encode().lower().translate(TABLE).split()


def token_frequencies(docs: DataFrame, text_col: str, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each token of the templates; the vocabulary bounds the result."""
    wanted = frozenset(w.encode() for w in vocabulary)

    def count(batches):
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                seen.update(wanted.intersection(words_of(t)))
        yield pa.RecordBatch.from_pylist([{"token": w.decode(), "n": n} for w, n in seen.items()], schema=pa.schema([("token", pa.string()), ("n", pa.int64())]))

    rows = docs.select(text_col).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r.token: r.n for r in rows}


def read_templates(path: Path = TEXTS) -> dict[str, str]:
    """TEMPLATES and the texts of a file."""
    parts = path.read_text(encoding="utf-8").split("\n== ")
    texts = [p.removeprefix("== ").partition("\n") for p in parts if p.strip()]
    return TEMPLATES | {label.strip(): text for label, _, text in texts}


class Matcher:
    def __init__(self, templates: dict[str, str], threshold: float, frequency: dict[str, int]):
        vocabulary = {w for text in templates.values() for w in words_of(text)}
        self.rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w.decode(), 0), w)))}
        #: label, ranks in order, how many are asked for, words of a block.
        self.templates: list[tuple[str, list[int], int, int]] = []
        self.index: dict[int, list[int]] = {}
        for label, text in sorted(templates.items()):
            words = words_of(text)
            tokens = sorted({self.rank[w] for w in words})
            need = math.ceil(threshold * len(tokens) - 1e-9)
            for r in tokens[: len(tokens) - need + 1]:
                self.index.setdefault(r, []).append(len(self.templates))
            self.templates.append((label, tokens, need, len(words)))
        self.keys = frozenset(w for w, r in self.rank.items() if r in self.index)
        self.rejected: Counter = Counter()

    def __call__(self, words: list[bytes], present: frozenset | set) -> list[tuple[str, int, int, float]]:
        """(label, first word, words, containment) of the best block of each overlapping run of blocks that match."""
        hits = self.keys & present
        if not hits:
            return []
        live: dict[int, set[int]] = {}
        for w in hits:
            for t in self.index[self.rank[w]]:
                live.setdefault(t, set()).add(self.rank[w])
        known = {self.rank[w] for w in present if w in self.rank}
        ranks: list[int] = []
        found = []
        for t, prefix in live.items():
            label, tokens, need, n = self.templates[t]
            if len(known.intersection(tokens)) < need:
                self.rejected["text"] += 1  # as one block it holds too few of the template
                continue
            ranks = ranks or [self.rank.get(w, -1) for w in words]
            best: list[tuple[int, float]] = []
            done = -1
            for i in (i for i, r in enumerate(ranks) if r in prefix):
                for s in range(max(0, i - n + 1, done + 1), min(i, max(0, len(words) - n)) + 1):
                    done = s
                    c = self.contained(t, ranks[s : s + n])
                    if not c:
                        continue
                    if best and s < best[-1][0] + n:
                        if c > best[-1][1]:
                            best[-1] = (s, c)
                    else:
                        best.append((s, c))
            found += [(label, s, min(n, len(words) - s), c) for s, c in best]
        return sorted(found, key=lambda f: (f[1], f[0]))

    def contained(self, t: int, ranks: list[int]) -> float:
        """The share of a template's tokens that a block holds; 0 where a filter, or the count, rejects it."""
        _, tokens, need, _ = self.templates[t]
        held = set(ranks)
        held.discard(-1)
        if len(held) < need:
            self.rejected["length"] += 1
            return 0.0
        first = next(i for i, r in enumerate(tokens) if r in held)  # in the prefix, for blocks are found by it
        left = sum(r >= tokens[first] for r in held)
        if min(len(tokens) - first, left) < need:
            self.rejected["position"] += 1
            return 0.0
        have = len(held.intersection(tokens))
        if have < need:
            self.rejected["count"] += 1
            return 0.0
        return have / len(tokens)


def phrase_places(words: list[bytes], joined: bytes, phrase: list[bytes]) -> list[int]:
    """Every start of the phrase, overlaps included."""
    text, at, out = b" " + b" ".join(phrase) + b" ", joined.find(b" " + b" ".join(phrase) + b" "), []
    last, word = 0, 0
    while at >= 0:
        word += joined.count(b" ", last, at)
        last = at
        out.append(word)
        at = joined.find(text, at + 1)
    return out


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, threshold: float = 0.8) -> DataFrame:
    """Every column of docs, with RESULT.

    n_base counts all places of the phrases, first_word and last_word are their smallest and largest start (null:
    none). base_labels has the phrases' labels, labels also those of templates of which some block holds at least
    `threshold` of the distinct tokens. score is the largest containment, 1 where a phrase stands. Null and empty
    texts have no words and no labels; texts shorter than a template are one block, long ones are searched whole. Of
    overlapping blocks the best counts, the first of equals. Rows are judged one by one, repeated or not; an empty table
    gives no rows. Input columns named as a result get the suffix _in.
    """
    from foliant.llm.shards import free_names

    templates, phrases = templates or read_templates(), phrases or PHRASES
    result = T.DataType.fromDDL(RESULT)
    docs = free_names(docs, *result.names)
    frequency = token_frequencies(docs, text_col, sorted({w.decode() for t in templates.values() for w in words_of(t)}))
    base = [(words_of(p), label) for p, label in sorted(phrases.items())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(templates, threshold, frequency)
        first = {p[0] for p, _ in base} | match.keys
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("containment", pa.float64())]))]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, rows = batch.slice(at, 1000), []
                for text in part.column(part.schema.get_field_index(text_col)).to_pylist():
                    words = words_of(text)
                    if first.isdisjoint(words):
                        rows.append((len(words), 0, None, None, "", "", 0.0, []))
                        continue
                    present, joined = set(words), None
                    places, labels = [], set()
                    for p, label in base:
                        if present.issuperset(p):
                            joined = joined or b" " + b" ".join(words) + b" "
                            if got := phrase_places(words, joined, p):
                                places += got
                                labels.add(label)
                    blocks = match(words, present)
                    score = 1.0 if places else max((b[3] for b in blocks), default=0.0)
                    rows.append((len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {b[0] for b in blocks})), score, [dict(zip(("label", "start", "words", "containment"), b, strict=True)) for b in blocks]))
                if rows:
                    yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=[*part.schema.names, *result.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *result.fields]))
