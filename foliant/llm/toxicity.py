"""Toxicity: a learnt lexicon met by Levenshtein automata in a trie, with scores of each hit's context.

Terms (whole words, and stems that many words start with) come from the labelled rows: those that are far likelier in
toxic documents. Every other word of four letters or more goes through the Levenshtein automaton intersected with the
trie of the terms and of the whole words under stems, so misspelled ones count too. Words around a hit, and quotation
marks, tell quoting from abuse. Counts of hits, their density and their contexts go into a logistic model.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm.licenses import words_of
from foliant.llm.shards import checkpoint, free_names, give_back, kept, lean

#: Labelled rows that are learnt from: at most so many toxic and so many others, taken by a hash of their id.
MOST_TOXIC, MOST_OTHER = 3_000, 6_000
#: Bytes of texts of either kind that are learnt from; a row that passes them is left out, but for the first.
MOST_BYTES = 24 << 20
#: A term is in at least so many toxic documents, and so many times likelier there.
LEAST_DOCS, LEAST_RATIO = 8, 20.0
MOST_TERMS = 2_000
WINDOW = 6
CACHE_WORDS = 200_000
#: Letters from which a term may be misspelt twice; states of an automaton that are kept before it starts anew.
LONG_TERM, MOST_STATES = 10, 50_000
#: Double quotation marks, and runs without blanks that hold one.
DOUBLE = '"“”„«»'
MARKED = re.compile(rf"\S*[{DOUBLE}]\S*")
NONE, EXACT, STEM, FUZZY = range(4)
HIT = "array<struct<word:string,term:string,kind:string,start:long,quoted:boolean,context:double>>"


class Trie:
    """Terms in a trie, met by the Levenshtein automaton of whatever words are read.

    A state of the two together is the set of trie nodes that the letters so far can lead to, with the fewest edits spent
    on the way to each. States are made when a word first needs them and kept in a table, so that many words are read at
    once, a letter at a time, and most end in the empty state after a few. A node is left out where no term below it may
    have as many edits.
    """

    def __init__(self, terms):
        self.children: list[dict[str, int]] = [{}]
        self.terms: list[str | None] = [None]
        self.room = [0]
        for t in terms:
            at, most = 0, edits_of(t)
            self.room[0] = max(self.room[0], most)
            for c in t:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.terms.append(None)
                    self.room.append(0)
                at = self.children[at][c]
                self.room[at] = max(self.room[at], most)
            self.terms[at] = t
        sizes = [len(t) for t in terms] or [0]
        self.least, self.most = max(1, min(sizes) - self.room[0]), max(sizes) + self.room[0] if terms else 0
        self.letters = ["", *sorted({c for t in terms for c in t})]  # the first stands for any other
        self.code = np.zeros(max((ord(c) for c in self.letters[1:]), default=0) + 2, np.int64)
        self.code[[ord(c) for c in self.letters[1:]]] = np.arange(1, len(self.letters))
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.next = np.full((1024, len(self.letters)), -1, np.int32)
        self.found: list[str | None] = []
        self.dead, self.start = self._state({}), self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The number of the state that holds these nodes, and those that skipped letters of terms lead to."""
        stack = list(reached.items())
        while stack:
            node, e = stack.pop()
            if reached[node] == e:
                for child in self.children[node].values():
                    if e < self.room[child] and reached.get(child, 9) > e + 1:
                        reached[child] = e + 1
                        stack.append((child, e + 1))
        key = tuple(sorted(reached.items()))
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            if len(self.sets) > len(self.next):
                self.next = np.concatenate((self.next, np.full_like(self.next, -1)))
            ends = [(e, t) for node, e in key if (t := self.terms[node]) is not None and e <= edits_of(t)]
            self.found.append(min(ends)[1] if ends else None)
        return self.states[key]

    def _step(self, state: int, code: int) -> int:
        reached: dict[int, int] = {}
        letter = self.letters[code]

        def reach(node: int, e: int) -> None:
            if e <= self.room[node] and reached.get(node, 9) > e:
                reached[node] = e

        for node, e in self.sets[state]:
            reach(node, e + 1)  # a letter too many
            for c, child in self.children[node].items():
                reach(child, e + (c != letter))
        to = self._state(reached)
        self.next[state, code] = to
        return to

    def match_all(self, words: list[str]) -> dict[str, str]:
        """Word -> the term with fewest edits, the first of equals, of those that the word is within edits_of(term) of;
        words without one are left out."""
        words = [w for w in words if self.least <= len(w) <= self.most]
        if not words:
            return {}
        if len(self.sets) > MOST_STATES:
            self.reset()
        sizes = np.array([len(w) for w in words])
        points = np.array(words, f"U{self.most}").view(np.uint32).reshape(len(words), self.most)
        codes = self.code[np.minimum(points, len(self.code) - 1)]
        state, live = np.full(len(words), self.start), np.arange(len(words))
        for at in range(self.most):
            live = live[sizes[live] > at]
            if not len(live):
                break
            now, code = state[live], codes[live, at]
            to = self.next[now, code]
            if (to < 0).any():
                for pair in np.unique(now[to < 0] * len(self.letters) + code[to < 0]).tolist():
                    self._step(*divmod(pair, len(self.letters)))
                to = self.next[now, code]
            state[live] = to
            live = live[to != self.dead]
        out = {}
        for i in np.flatnonzero(state != self.dead).tolist():
            if (t := self.found[state[i]]) is not None:
                out[words[i]] = t
        return out

    def matches(self, word: str) -> str | None:
        return self.match_all([word]).get(word)


def edits_of(term: str) -> int:
    """Insertions, deletions and substitutions that a misspelling of a term may have."""
    return 2 if len(term) >= LONG_TERM else 1


@kept
def tries(terms: frozenset[str]) -> tuple[Trie, Trie]:
    """Short terms and long ones apart: what long ones allow makes no states for short ones. Kept from task to task."""
    return Trie(sorted(t for t in terms if edits_of(t) == 1)), Trie(sorted(t for t in terms if edits_of(t) == 2))


@kept
def seen_words(*parts: frozenset[str]) -> tuple[dict[bytes, tuple[int, str]], set[bytes]]:
    """What a worker remembers under the same lexicon, from task to task: words that hit, and words that don't."""
    return {}, set()


@dataclass
class Model:
    """What a fit leaves; small whatever the corpus."""

    terms: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    clean: frozenset[str] = frozenset()
    cues: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    #: Words under the stems that would be terms themselves; only misspellings ask for them.
    stemmed: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.short, self.long = tries(frozenset(t for t in self.terms | self.stemmed if len(t) >= 4))
        self.stem_sizes = sorted({len(s) for s in self.stems})
        self.hot, self.plain = seen_words(self.terms, self.stems, self.clean, self.stemmed)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("short", "long", "stem_sizes", "hot", "plain")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.reset()

    def learn(self, words: set[bytes]) -> None:
        """Sorts new words into those that hit, with their kind and term, and plain ones; many at a time."""
        new = words.difference(self.plain, self.hot)
        if not new:
            return
        if len(self.plain) > CACHE_WORDS:
            self.plain.clear()
        unknown = []
        for raw in new:
            w = raw.decode()
            if w in self.terms:
                self.hot[raw] = (EXACT, w)
            elif (n := next((n for n in self.stem_sizes if w[:n] in self.stems), 0)) > 0:
                self.hot[raw] = (STEM, w[:n])
            elif len(w) >= 4 and w not in self.clean:
                unknown.append(w)
        near = self.long.match_all(unknown) | self.short.match_all(unknown)
        self.hot.update((w.encode(), (FUZZY, t)) for w, t in near.items())
        self.plain.update(new.difference(self.hot))

    def found(self, words: list[bytes]) -> set[bytes]:
        """The distinct words that hit."""
        distinct = set(words)
        self.learn(distinct)
        return distinct & self.hot.keys()

    def hits(self, text: str | None, words: list[bytes] | None = None) -> tuple[list[tuple], int]:
        """((word, term, kind, start, quoted, context) of every hit, number of words). words: words_of(text)."""
        words = words_of(text) if words is None else words
        found = self.found(words)
        if not found:
            return [], len(words)
        quoted = quoted_words(text or "", found)
        out = []
        for i, w in enumerate(words):
            if w in found:
                kind, term = self.hot[w]
                near = [*words[max(0, i - WINDOW) : i], *words[i + 1 : i + 1 + WINDOW]]
                context = sum(self.cues.get(x.decode(), 0.0) for x in near) / (len(near) or 1)
                out.append((w.decode(), term, ("", "exact", "stem", "misspelt")[kind], i, i in quoted, context))
        return out, len(words)

    def features(self, hits: list[tuple], n: int) -> list[float]:
        kinds = Counter(h[2] for h in hits)
        strong = kinds["exact"] + kinds["stem"]
        quotes = sum(h[4] for h in hits)
        return [1.0, math.log1p(kinds["exact"]), math.log1p(kinds["stem"]), math.log1p(kinds["misspelt"]), float(strong > 0), float(len(hits) > 0), math.log1p(100 * len(hits) / n) if n else 0.0, math.log1p(quotes), sum(h[5] for h in hits) / len(hits) if hits else 0.0, math.log1p(n)]

    def score(self, x: list[float]) -> float:
        if not self.weights:
            return 0.0
        z = sum(w * (v - m) / s for w, v, m, s in zip(self.weights, x, self.mean, self.scale, strict=True))
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


def quoted_words(text: str, found: set[bytes]) -> set[int]:
    """Places (in words_of) of found words inside an open pair of double quotation marks, or in a run of letters that
    holds one. Only the runs with marks are looked at one by one."""
    out: set[int] = set()
    at, last, inside = 0, 0, False
    for m in MARKED.finditer(text):
        between = words_of(text[last : m.start()])
        if inside:
            out.update(at + k for k, w in enumerate(between) if w in found)
        at += len(between)
        words = words_of(m[0])
        out.update(at + k for k, w in enumerate(words) if w in found)
        at, last = at + len(words), m.end()
        inside ^= sum(map(m[0].count, DOUBLE)) % 2 == 1
    if inside:
        out.update(at + k for k, w in enumerate(words_of(text[last:])) if w in found)
    return out


def far_likelier(toxic: Counter, other: Counter, n: int, m: int) -> list[str]:
    """Features of at least LEAST_DOCS toxic documents that are LEAST_RATIO times likelier there."""
    ratio = lambda f: (toxic[f] + 0.5) / (n + 1) / ((other[f] + 0.5) / (m + 1))
    return sorted((f for f, c in toxic.items() if c >= LEAST_DOCS and ratio(f) >= LEAST_RATIO), key=lambda f: (-toxic[f], f))[:MOST_TERMS]


def decoded(text: str | None) -> list[str]:
    return [w.decode() for w in words_of(text)]


def in_parts(texts: list[str | None], labels: list[int], model: Model) -> Iterator[tuple[str | None, int, list[bytes]]]:
    """Texts with their labels and words, of which the model learns many texts' at once."""
    for at in range(0, len(texts), 500):
        words = [words_of(t) for t in texts[at : at + 500]]
        model.learn(set().union(*words))
        yield from zip(texts[at : at + 500], labels[at : at + 500], words, strict=True)


def beginnings(words: set[str]) -> set[str]:
    return {w[:k] for w in words for k in range(4, min(8, len(w)))}


def fit(texts: list[str | None], labels: list[int]) -> Model:
    """Lexicon, context cues and weights from labelled texts; without toxic or without other texts a blank model. Texts
    are read anew for each count, and only what enough toxic ones hold is counted in the others: memory stays small."""
    n, m = sum(labels), len(labels) - sum(labels)
    if not n or not m:
        return Model()
    whole, starts, under = (Counter(), Counter()), (Counter(), Counter()), {}
    for t, y in zip(texts, labels, strict=True):
        if y:
            distinct = set(decoded(t))
            whole[0].update(distinct)
            starts[0].update(beginnings(distinct))
    for some in (whole[0], starts[0]):
        for f in [f for f, c in some.items() if c < LEAST_DOCS]:
            del some[f]
    for t, y in zip(texts, labels, strict=True):
        distinct = set(decoded(t))
        if y:
            for w in distinct:
                for k in range(4, min(8, len(w))):
                    if w[:k] in starts[0]:
                        under.setdefault(w[:k], set()).add(w)
        else:
            whole[1].update(whole[0].keys() & distinct)
            starts[1].update(starts[0].keys() & beginnings(distinct))
    stems: set[str] = set()
    for s in sorted(far_likelier(*starts, n, m), key=lambda s: (len(s), s)):
        if len(under[s]) >= LEAST_DOCS and not any(s[:k] in stems for k in range(4, len(s))):
            stems.add(s)
    likelier = far_likelier(*whole, n, m)
    stemmed = frozenset(t for t in likelier if any(t[:k] in stems for k in range(4, len(t) + 1)))
    terms = set(likelier) - stemmed
    model = Model(frozenset(terms), frozenset(stems), frozenset(), stemmed=stemmed)
    taken = (Counter(), Counter())
    for _, y, ws in in_parts(texts, labels, model):
        taken[1 - y].update(w.decode() for w in model.found(ws) if model.hot[w][0] == FUZZY)
    clean = {w for w, c in taken[1].items() if c >= 2 and c * n >= taken[0][w] * m}
    model = Model(frozenset(terms), frozenset(stems), frozenset(clean), stemmed=stemmed)
    near = (Counter(), Counter())
    for _, y, ws in in_parts(texts, labels, model):
        found = model.found(ws)
        for i, w in enumerate(ws if found else []):
            if w in found:
                near[1 - y].update({x.decode() for x in (*ws[max(0, i - WINDOW) : i], *ws[i + 1 : i + 1 + WINDOW])})
    a, b = sum(near[0].values()) + 1, sum(near[1].values()) + 1
    cues = {w: math.log((near[0][w] + 1) / a) - math.log((near[1][w] + 1) / b) for w in {*near[0], *near[1]} if near[0][w] + near[1][w] >= 20}
    model = Model(model.terms, model.stems, model.clean, dict(sorted(cues.items(), key=lambda c: (-abs(c[1]), c[0]))[:MOST_TERMS]) if near[1] else {}, stemmed=stemmed)
    x = np.array([model.features(*model.hits(t, ws)) for t, _, ws in in_parts(texts, labels, model)])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[0], scale[scale == 0] = 0.0, 1.0
    x, y, w = (x - mean) / scale, np.array(labels, float), np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        ridge = np.eye(len(w))
        ridge[0, 0] = 1e-6
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.weights, model.mean, model.scale = w.tolist(), mean.tolist(), scale.tolist()
    return model


def held_out(id_col: str) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on at most MOST_TOXIC and MOST_OTHER labelled rows, and MOST_BYTES of texts of each; null labels and ids don't
    count. Their ids, at most 9,000, are broadcast; of documents of equal ids the smallest text counts. Without toxic or
    without other rows the model is blank."""
    rows = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).where("__id is not null and __y in (0, 1)").where(~held_out("__id"))
    pick = [rows.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(k) for y, k in ((1, MOST_TOXIC), (0, MOST_OTHER))]
    wanted = pick[0].unionByName(pick[1])
    joined = docs.select(id_col, F.col(text_col).alias("__t")).join(F.broadcast(wanted), F.col(id_col) == F.col("__id"))
    labelled = checkpoint(joined.groupBy("__id", "__y").agg(F.min("__t").alias("__t")))  # one row an id and label, at most 9,000
    sizes = labelled.select("__id", "__y", F.coalesce(F.octet_length("__t"), F.lit(0)).alias("n"), F.xxhash64("__id").alias("h")).collect()
    some, spent = [], {0: 0, 1: 0}
    for r in sorted(sizes, key=lambda r: (r.h, r["__id"], r["__y"])):
        if not spent[r["__y"]] or spent[r["__y"]] + r.n <= MOST_BYTES:
            spent[r["__y"]] += r.n or 1
            some.append((r["__id"], r["__y"]))
    taken = docs.sparkSession.createDataFrame(some, "__id long, __y int")
    got = labelled.withColumn("__id", F.col("__id").cast("long")).join(F.broadcast(taken), ["__id", "__y"]).select("__id", "__y", "__t").toArrow()
    got = got.sort_by([("__id", "ascending"), ("__y", "ascending")])
    fitted = pickle.dumps(fit(got.column(2).to_pylist(), got.column(1).to_pylist()))
    del got
    for made in (tries, seen_words):
        made.cache_clear()
    give_back()  # the driver goes on with the model alone
    return pickle.loads(fitted)


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Every column of docs, with score (0 to 1), predicted (score >= threshold) and hits. Only the text counts, all of
    it however long. Null and empty texts have no hits and the model's score for that; equal texts score alike, and of
    terms as near to a word the first by alphabet is named. Rows are scored one by one, repeated or not; an empty table
    gives no rows. Input columns named as a result get the suffix _in."""
    docs = free_names(docs, "score", "predicted", "hits")
    hit_type = pa.list_(pa.struct([("word", pa.string()), ("term", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("quoted", pa.bool_()), ("context", pa.float64())]))
    names = [f.name for f in hit_type.value_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                scores, hits = [], []
                texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
                words = [words_of(t) for t in texts]
                model.learn(set().union(*words))
                for text, ws in zip(texts, words, strict=True):
                    h, n = model.hits(text, ws)
                    scores.append(model.score(model.features(h, n)))
                    hits.append([dict(zip(names, x, strict=True)) for x in h])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(hits, hit_type)], names=[*part.schema.names, "score", "predicted", "hits"])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("hits", T.DataType.fromDDL(HIT))])
    return docs.mapInArrow(lean(run, tries, seen_words), schema)
