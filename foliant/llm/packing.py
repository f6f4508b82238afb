"""Cost-balanced packing of tokenised documents into training sequences.

A document's cost is linear plus quadratic in its tokens (feed-forward and attention work). Documents go in descending
order of cost to the sequence of lowest cost that has room; one that doesn't fit is cut there, and its rest goes on to
the next. Each group of documents is packed as it streams by, so nothing is shuffled and memory is bounded by a group.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from foliant.llm.shards import free_names, give_back, kept, lean

#: Tokens of a group, after which its sequences are closed, and bytes of texts that are tokenised at once.
GROUP_TOKENS = 1 << 20
TEXT_BYTES = 2 << 20
#: Words whose ids a worker remembers before it starts anew.
CACHE_WORDS = 300_000
PIECES = "sequence_id long, offset long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_cost double"
_TAILS = ".,;:!?"
#: Letters that every library lower-cases alike, one to one.
_LATIN = "^[\x00-\u012f\u0131-\u024f]*$"
#: The steps of a tokenizer whose ids of a text are those of its words, one after another.
_NORMALIZERS = {"NFC", "Lowercase", "Replace"}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def spread(start: np.ndarray, run: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... run[0] numbers, then those of start[1], and so on."""
    return np.repeat(start - (np.cumsum(run) - run), run) + np.arange(run.sum())


def splits_at_spaces(config: dict) -> bool:
    """Whether a tokenizer's file says that no id depends on more than one white-space-separated word."""
    steps = lambda x, many: (x or {}).get(many, [x] if x else [])
    split, *rest = [*steps(config["pre_tokenizer"], "pretokenizers"), {}]
    return (
        {x["type"] for x in steps(config["normalizer"], "normalizers")} <= _NORMALIZERS and split.get("type") == "Split" and split["pattern"].get("Regex") == _SPLIT and split["invert"]
        and all(not x or (x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"]) for x in rest) and not any(c.isspace() for t in config["added_tokens"] for c in t["content"])
    )


class WordIds:
    """Ids of texts through a table of words, for a tokenizer that splits at white space; any other takes whole texts.

    A text's ids are those of its words, one after another; a word of letters with closing punctuation has the ids of
    the word, in lower case where the tokenizer lower-cases, and of the punctuation. Each distinct word of a batch is
    looked up once; new ones go through the tokenizer many at a time.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        suffix = config["model"].get("end_of_word_suffix")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.by_words = splits_at_spaces(config)
        self.lowers = self.by_words and "Lowercase" in json.dumps(config["normalizer"])
        self.forget()

    def forget(self) -> None:
        """The table: words, the ids of all of them, and where each word's begin. The first is the empty word."""
        self.words, self.flat, self.offsets = pa.array([""], pa.string()), np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        got = []
        for at in range(0, len(words), 4096):
            got += [e.ids for e in self.tokenizer.encode_batch_fast(words[at : at + 4096], add_special_tokens=False)]
        return np.array([i for ids in got for i in ids], np.uint32), np.array([len(ids) for ids in got], np.int64)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only: the last id of each says that the word ends."""
        flat, runs = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 1024):
            part = words[at : at + 1024]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                run = np.diff(stops, prepend=0)
            else:
                ids, run = self._each(part)
            flat.append(ids)
            runs.append(run)
        return np.concatenate(flat), np.concatenate(runs)

    def _rows(self, words: pa.StringArray) -> np.ndarray:
        """Where distinct words stand in the table, which takes those that are new."""
        place = pc.index_in(words, value_set=self.words)
        rows = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = rows < 0
        letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        for some, ids_of in ((new & letters, self._joined), (new & ~letters, self._each)):
            if some.any():
                part = words.filter(pa.array(some))
                flat, run = ids_of(part.to_pylist())
                rows[some] = len(self.words) + np.arange(len(part))
                self.words = pa.concat_arrays([self.words, part])
                self.flat = np.concatenate((self.flat, flat))
                self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(run)))
        return rows

    def _parts(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the table whose ids, one after the other, are those of each word."""
        if len(self.words) > CACHE_WORDS:
            self.forget()
        stems = pc.ascii_rtrim(words, characters=_TAILS)
        letters = pc.utf8_is_alpha(stems)
        keys = pc.if_else(letters, stems, words)
        if self.lowers:
            keys = pc.if_else(pc.and_(letters, pc.match_substring_regex(keys, _LATIN)), pc.utf8_lower(keys), keys)
        whole, kept = (pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (words, pc.if_else(letters, stems, words)))
        offsets = np.frombuffer(words.buffers()[1], np.int32, len(words), words.offset * 4)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[spread(offsets + kept, whole - kept)]
        tails = pa.StringArray.from_buffers(len(words), pa.py_buffer(np.concatenate(([0], np.cumsum(whole - kept))).astype(np.int32)), pa.py_buffer(data))
        both = pa.concat_arrays([keys, tails]).dictionary_encode()
        rows = self._rows(both.dictionary)[both.indices.to_numpy()]
        return rows[: len(words)], rows[len(words) :]

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by the id end, and the n + 1 offsets of the texts."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.by_words:
            flat, run = self._each(texts.to_pylist())
            offsets = np.concatenate(([0], np.cumsum(run)))
            return np.insert(flat, offsets[1:], np.uint32(end)), offsets + np.arange(len(offsets))
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        stem, tail = self._parts(words.dictionary)
        rows = np.column_stack((stem, tail)).ravel()
        runs = np.diff(self.offsets)[rows]
        flat = np.append(self.flat[spread(self.offsets[rows], runs)], np.uint32(end))
        run = np.append(runs.reshape(-1, 2).sum(axis=1), 1)
        start = np.cumsum(run) - run
        bounds = split.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        codes = np.insert(words.indices.to_numpy(), bounds[1:], len(words.dictionary))
        ids = flat[spread(start[codes], run[codes])]
        return ids, np.concatenate(([0], np.cumsum(run[codes])))[bounds + np.arange(len(bounds))]


@kept
def word_ids(path: str) -> WordIds:
    """One table for all tasks of a worker."""
    return WordIds(path)


def cost(tokens: int, per_token: float, per_pair: float) -> float:
    return per_token * tokens + per_pair * tokens * tokens


def assign(lengths: list[int], size: int, per_token: float, per_pair: float) -> Iterator[tuple[int, int, int, int, float]]:
    """(sequence, document, start, length, added cost) of every piece; sequences are filled to `size` but for a rest.

    The rest, less than one sequence, is cut into sequences whose lengths are powers of two: they need no padding.
    """
    total = sum(lengths)
    rest = total % size
    sizes = [size] * (total // size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    heap = [(0.0, s) for s in range(len(sizes))]
    room = sizes[:]
    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        at = 0
        while at < lengths[doc]:
            spent, s = heapq.heappop(heap)
            n = min(room[s], lengths[doc] - at)
            added = cost(n, per_token, per_pair)
            yield s, doc, at, n, added
            at += n
            room[s] -= n
            if room[s]:
                heapq.heappush(heap, (spent + added, s))


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end_id: int = 1, per_token: float = 1.0, per_pair: float = 1 / 2048, with_ids: bool = True
) -> DataFrame:
    """One row for each piece of a document: its id, then PIECES (without ids if with_ids is false).

    A document's ids are its text's (null: none), then end_id. It is cut freely; every id is in one piece. Sequences
    hold `size` ids, but for a few of each group whose lengths are powers of two. start counts the document's ids
    before a piece, offset the sequence's. Ties in cost go to the sequence opened first, ties in length to the document
    read first. A key that is called as a result gets the suffix
    _in. Rows with equal ids are packed separately; long texts are whole, in as many pieces as they need; an
    empty table gives no rows. Sequence ids are unique; they depend on how the input is partitioned. The tokenizer's
    file must be on every node.
    """
    from pyspark.sql.types import DataType, StructField, StructType

    fields = [f for f in DataType.fromDDL(PIECES).fields if with_ids or f.name != "ids"]
    key = StructField(free_names(docs.select(id_col), *(f.name for f in fields)).columns[0], docs.schema[id_col].dataType)
    schema = StructType([key, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = word_ids(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        total = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal sequence, held, total
            names = pa.concat_arrays([h[0] for h in held])
            ids = np.concatenate([h[1] for h in held]).astype("<u4", copy=False)
            lengths = np.concatenate([np.diff(h[2]) for h in held])
            first = np.cumsum(lengths) - lengths
            rows = list(assign(lengths.tolist(), size, per_token, per_pair))
            seq, doc, at, n = (np.array([r[k] for r in rows], np.int64) for k in range(4))
            added = np.array([r[4] for r in rows])
            order = np.argsort(seq, kind="stable")
            costs = np.bincount(seq, weights=added)[seq[order]]
            seq, doc, at, n = seq[order], doc[order], at[order], n[order]
            before = np.cumsum(n) - n
            offset = before - before[np.searchsorted(seq, seq)]
            for k in range(0, len(seq), 2000):
                part = slice(k, k + 2000)
                raw = ids[spread(first[doc[part]] + at[part], n[part])].tobytes()
                ends = np.concatenate(([0], 4 * np.cumsum(n[part])))
                view, e = memoryview(raw), ends.tolist()
                crc = [zlib.crc32(view[a:b]) for a, b in zip(e[:-1], e[1:], strict=True)]
                out = {
                    key.name: names.take(pa.array(doc[part])), "sequence_id": sequence + seq[part], "offset": offset[part], "start": at[part], "length": n[part],
                    "ids": pa.Array.from_buffers(pa.binary(), len(crc), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)]), "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": lengths[doc[part]], "sequence_cost": costs[part],
                }
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for c, v in out.items() if with_ids or c != "ids"], names=schema.names)
            sequence += int(seq[-1]) + 1
            held, total = [], 0
            give_back()

        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT_BYTES, side="right")))
                ids, offsets = words(texts.slice(at, to - at), end_id)
                held.append((names.slice(at, to - at), ids, offsets))
                total, at = total + len(ids), to
                if total >= GROUP_TOKENS:
                    yield from close()
        if held:
            yield from close()

    return docs.select(id_col, text_col).mapInArrow(lean(run, word_ids), schema)
