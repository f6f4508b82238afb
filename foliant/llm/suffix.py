"""Suffix-array dedup: bytes under any string of `width` bytes that the corpus holds twice.

Routing. Each window of `width` bytes holds a winnowed anchor, picked by the window's own bytes, so equal windows share
one. An anchor stands for a run of windows; the bytes under them are its region. Anchors that occur once go. Regions
that are equal as a whole are repeats and are judged by their hashes alone, so a group of copies costs one entry a
shard. Where regions of one anchor differ, one of each kind goes to the anchor's bucket, if bytes that all its windows
of some offsets share are in another kind too.

Judging. The regions of a bucket form a text, and its suffix array is built by induced sorting: suffixes are classified
(S smaller than their successor, L larger), the leftmost S suffixes' substrings are sorted by induction and named, the
names are sorted by pairs, pairs of pairs and so on where they repeat, and the whole array is induced from them in
linear time. The permuted common prefixes
follow from each suffix's predecessor in the array: most are one less than their left neighbour's, the rest are
compared. A window repeats if its suffix shares `width` bytes or more with a neighbour.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.llm import hashing as H
from foliant.llm import shards as S

ANCHOR_BYTES = 32
GRAM_BASES = H.mix(np.arange(1, 1 + ANCHOR_BYTES // 8, dtype=np.uint64)) | np.uint64(1)
#: Window starts whose anchors are found at once.
PIECE = 1 << 16
#: Bytes of one suffix array. Regions of one anchor beyond this are sorted offset by offset instead, exactly too.
ARRAY_BYTES = 2 << 20


def classify(s: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their right neighbour; the end is smaller than everything."""
    at, size = H.runs(s)
    v = s[at]
    return np.repeat(np.append(v[:-1] < v[1:], False), size)


def leftmost(small: np.ndarray) -> np.ndarray:
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


def induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The order of all suffixes that the order of the leftmost S suffixes induces; one bucket at a time, as arrays."""

    def deal(at: np.ndarray, queues: list[list[np.ndarray]]) -> None:
        if len(at):
            c = s[at]
            order = np.argsort(c, kind="stable")
            first, size = H.runs(c[order])
            for f, m in zip(first.tolist(), size.tolist(), strict=True):
                o = at[order[f : f + m]]
                queues[s[o[0]]].append(o)

    def bucket(queue: list[np.ndarray], c: int, kind: bool, queues: list[list[np.ndarray]]) -> np.ndarray:
        parts, now = [], np.concatenate(queue) if queue else none
        while len(now):
            parts.append(now)
            before = now[now > 0] - 1
            now = before[(small[before] == kind) & (s[before] == c)]
        whole = np.concatenate(parts) if parts else none
        before = whole[whole > 0] - 1
        deal(before[(small[before] == kind) & (s[before] != c)], queues)
        return whole

    none = np.zeros(0, np.int64)
    stars: list[list[np.ndarray]] = [[] for _ in range(k)]
    deal(lms, stars)
    queues: list[list[np.ndarray]] = [[] for _ in range(k)]
    if not small[-1]:
        queues[s[-1]].append(np.array([len(s) - 1]))
    large = []
    for c in range(k):
        large.append(bucket(queues[c], c, False, queues))
        for star in stars[c]:
            deal(star[star > 0] - 1, queues)
    queues = [[] for _ in range(k)]
    out: list[np.ndarray] = []
    for c in range(k - 1, -1, -1):
        out.append(bucket(queues[c], c, True, queues))
        back = large[c][::-1]
        out.append(back)
        before = back[back > 0] - 1
        deal(before[small[before]], queues)
    return np.concatenate(out)[::-1]


def sort_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of names: those that begin alike are told apart by the names that follow, then by the names
    of pairs, of fours, and so on, until each suffix has a name of its own."""
    n = len(names)
    counts = np.bincount(names)
    name = (np.cumsum(counts) - counts)[names]  # how many suffixes begin with a smaller name
    alike, ahead = np.flatnonzero(counts[names] > 1), 1
    while len(alike):
        after = np.where(alike + ahead < n, name[np.minimum(alike + ahead, n - 1)] + 1, 0)
        pair = name[alike] * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        alike, pair = alike[order], pair[order]
        at, size = H.runs(pair)
        group, _ = H.runs(name[alike])
        own = at - group[np.searchsorted(group, at, side="right") - 1]
        name[alike] += np.repeat(own, size)
        alike, ahead = alike[np.repeat(size, size) > 1], 2 * ahead
    return np.argsort(name)


def ordered_names(codes: np.ndarray, lms: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """The leftmost S suffixes in order, from an array that sorts their substrings: equal substrings get one name."""
    star = np.full(len(codes), -1, np.int64)
    star[lms] = np.arange(len(lms))
    ranked = star[sa[sa >= 0]]
    ranked = ranked[ranked >= 0]
    to = np.minimum(np.append(lms[1:] + 1, len(codes)), len(codes))
    sums = [p.prefix(H.mix(codes + np.uint64(1))) for p in H.POWERS]
    a, b = (p.between(x, lms, to)[ranked] for p, x in zip(H.POWERS, sums, strict=True))
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (ranked[:-1] == len(lms) - 1) | (ranked[1:] == len(lms) - 1)))
    names = np.empty(len(lms), np.int64)
    names[ranked] = np.cumsum(new) - 1
    k = int(names.max()) + 1
    if k == len(lms):
        order = np.empty(k, np.int64)
        order[names] = np.arange(k)
        return lms[order]
    return lms[sort_names(names)]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of bytes."""
    if len(s) < 2:
        return np.arange(len(s))
    small, k = classify(s), int(s.max()) + 1
    lms = leftmost(small)
    if len(lms) > 1:
        lms = ordered_names(s.astype(np.uint64), lms, induce(s, small, lms, k))
    return induce(s, small, lms, k)


def permuted_lcp(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, its predecessor in the array (-1: none) and the length of their common prefix."""
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    i = np.flatnonzero(phi >= 0)
    j = phi[i]
    follows = np.zeros(n, bool)
    both = (i > 0) & (j > 0)
    follows[i[both]] = s[i[both] - 1] == s[j[both] - 1]
    i = i[~follows[i]]
    j = phi[i]
    padded = np.concatenate((s, np.zeros(16, np.uint8)))
    eight = np.ndarray(n + 9, "<u8", padded.tobytes(), strides=(1,))
    lcp, live, at = np.zeros(len(i), np.int64), np.arange(len(i)), 0
    while len(live):
        live = live[np.maximum(i[live], j[live]) + at < n]
        differ = eight[i[live] + at] ^ eight[j[live] + at]
        ended = differ != 0
        low = differ[ended] & (~differ[ended] + np.uint64(1))
        lcp[live[ended]] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        live = live[~ended]
        at += 8
        lcp[live] = at
    lcp = np.minimum(lcp, n - np.maximum(i, j))
    ends = np.arange(n)
    ends[i] += lcp
    source = np.zeros(n, np.int64)
    source[i] = i
    source = np.maximum.accumulate(source)
    return phi, np.maximum(ends[source] - np.arange(n), 0) * (phi >= 0)


def repeated(regions: list[bytes], runs: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """For each width and each of the first runs[i] places of region i, whether the string of that width there is at
    another of these places; False where the region ends before. UTF-8 has no 0xFF."""
    s = np.frombuffer(b"\xff".join(regions) + b"\xff", np.uint8)
    order = suffix_array(s)
    lcp = permuted_lcp(s, order)[1][order]
    sizes = np.array([len(r) for r in regions])
    places = spread(np.concatenate(([0], np.cumsum(sizes + 1)[:-1])), runs)
    room = np.repeat(sizes, runs) - spread(np.zeros(len(runs), np.int64), runs)
    # a region's bytes may go on into the windows of the next; those are not its own, so neighbours are sought among places
    own = np.zeros(len(s), bool)
    own[places] = True
    rank = np.flatnonzero(own[order])
    low = np.minimum.reduceat(lcp[: rank[-1] + 1], rank[:-1] + 1) if len(rank) > 1 else np.zeros(0, np.int64)
    out = []
    for width in widths:
        hit, same = np.zeros(len(s), bool), low >= width
        hit[order[rank[1:][same]]] = True
        hit[order[rank[:-1][same]]] = True
        out.append(hit[places] & (room >= width))
    return out


def spread(start: np.ndarray, run: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... run[0] numbers, then those of start[1], and so on."""
    return np.repeat(start - np.concatenate(([0], np.cumsum(run)[:-1])), run) + np.arange(run.sum())


def repeated_by_offset(regions: list[bytes], runs: np.ndarray, leads: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """The same as `repeated` for regions of one anchor that stands leads[i] bytes after the start of region i, however
    many: equal strings hold the anchor at the same offset, so the strings of one offset are sorted at a time, as rows
    of bytes. Memory is bounded by one row a region."""
    sizes = np.array([len(r) for r in regions])
    base, first = np.cumsum(sizes) - sizes, np.cumsum(runs) - runs
    s = np.frombuffer(b"".join(regions), np.uint8)
    out = [np.zeros(int(runs.sum()), bool) for _ in widths]
    for offset in range(int(leads.max()) + 1):
        k = leads - offset
        for hit, width in zip(out, widths, strict=True):
            some = np.flatnonzero((k >= 0) & (k < runs) & (k + width <= sizes))
            if len(some) > 1:
                rows = np.lib.stride_tricks.sliding_window_view(s, width)[base[some] + k[some]]
                _, place, count = np.unique(np.ascontiguousarray(rows).view(f"V{width}").ravel(), return_inverse=True, return_counts=True)
                hit[first[some] + k[some]] = count[place] > 1
    return out


def grams_of(data: np.ndarray) -> np.ndarray:
    """Hashes of all strings of ANCHOR_BYTES, read eight bytes at a time."""
    n = len(data) - ANCHOR_BYTES + 1
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,)).copy()
    total = eight[:n] * GRAM_BASES[0]
    for j, base in enumerate(GRAM_BASES[1:], 1):
        total += eight[8 * j : 8 * j + n] * base
    return H.mix(total)


def grams_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """grams_of at some places."""
    total = np.zeros(len(at), np.uint64)
    if len(at):
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        for j, base in enumerate(GRAM_BASES):
            total += eight[at + 8 * j] * base
    return H.mix(total)


def anchors_of(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Anchors of texts: hash, place, first window, number of windows. Computed in pieces that stay in a CPU's cache."""
    steps = np.zeros(len(data) + 1, np.int8)
    long = np.flatnonzero(np.diff(offsets) >= width)
    steps[offsets[long]] += 1
    steps[offsets[long + 1] - width + 1] -= 1
    inside = np.cumsum(steps[:-1], dtype=np.int8).astype(bool)
    got = []
    for c in range(0, len(data) - width + 1, PIECE):
        valid = np.flatnonzero(inside[c : min(c + PIECE, len(data) - width + 1)])
        if len(valid):
            grams = grams_of(data[c : c + PIECE + width - 1])
            at = H.winnow(grams, width - ANCHOR_BYTES + 1)[valid]
            first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1))))
            got.append((grams[at[first]], at[first] + c, valid[first] + c, np.diff(np.append(first, len(valid)))))
    if not got:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    grams, at, start, run = (np.concatenate(x) for x in zip(*got, strict=True))
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + run[:-1]))))
    return H.mix(grams[first]), at[first], start[first], np.add.reduceat(run, first)  # mixed: smallest hashes are alike


class Bytes:
    """Windows, anchors and regions of a shard; a region's bytes go on to the end of a string of `wide` bytes at its
    last window, as far as the text does."""

    def __init__(self, batch: pa.RecordBatch, text_col: str, width: int, wide: int, known: list[np.ndarray] | None = None):
        if width < 2 * ANCHOR_BYTES:
            raise ValueError(f"width is {width}; at least {2 * ANCHOR_BYTES} is needed")
        self.data, self.offsets = S.text_bytes(batch, text_col)
        if known is None:
            self.anchors, self.at, self.start, self.run = anchors_of(self.data, self.offsets, width)
        else:
            self.at, lead, self.run = (x.astype(np.int64) for x in known)
            self.anchors, self.start = H.mix(grams_at(self.data, self.at)), self.at - lead
        ends = self.offsets[np.searchsorted(self.offsets, self.start, side="right")] if len(self.start) else self.start
        self.stop = np.minimum(self.start + self.run - 1 + wide, ends)
        self.width, self.wide = width, wide

    def found(self) -> list[np.ndarray]:
        """What __init__ takes as known: a few bytes an anchor."""
        return [self.at.astype(np.uint32), (self.at - self.start).astype(np.uint16), self.run.astype(np.uint16)]

    def regions(self, bits: np.ndarray) -> tuple[np.ndarray, ...]:
        """Anchors (their places in self) that occur anywhere else, with two hashes of their regions."""
        if not len(self.anchors):
            none = np.zeros(0, np.uint64)
            return np.zeros(0, np.int64), none, none
        _, place = np.unique(self.anchors, return_inverse=True)
        which = np.flatnonzero(bits[place])
        a, b = self.start[which], self.stop[which]
        shape = ((self.at[which] - a) << 16 | self.run[which]).astype(np.uint64) * H.BASES[1]
        codes = H.BYTE_CODES[self.data]
        self.sums = H.POWERS[0].prefix(codes)
        h1 = H.mix(H.POWERS[0].between(self.sums, a, b) + shape)
        h2 = H.mix(H.POWERS[1].between(H.POWERS[1].prefix(codes), a, b) ^ shape)
        return which, h1, h2

    def cores(self, which: np.ndarray) -> list[np.ndarray]:
        """For each eighth of the offsets an anchor can have in a window, a hash of the bytes that all windows of that
        eighth share; 0 where the region has none of them. Windows can be equal only if those bytes are."""
        lead, step = self.at[which] - self.start[which], part(self.width)
        tail = lead - self.run[which] + 1  # smallest offset
        out = []
        for j in range(EIGHTHS):
            lo, hi = np.maximum(tail, j * step), np.minimum(lead, (j + 1) * step - 1)
            a = self.at[which] - j * step
            b = self.at[which] + self.width - ((j + 1) * step - 1)
            ok = (lo <= hi) & (a >= self.start[which] - (step - 1)) & (a >= 0) & (b <= len(self.data))
            h = np.zeros(len(which), np.uint64)
            h[ok] = H.mix(H.POWERS[0].between(self.sums, a[ok], b[ok])) | np.uint64(1)
            out.append(h)
        return out

    def needed(self, which: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First windows, their numbers and the ends of their bytes: those in the eighths, from the first to the last
        in the mask."""
        step = part(self.width)
        low, high = LOWEST[masks], HIGHEST[masks]
        lead = self.at[which] - self.start[which]
        most = np.minimum(lead, (high + 1) * step - 1)
        least = np.maximum(lead - self.run[which] + 1, low * step)
        start, run = self.at[which] - most, most - least + 1
        return start, run, np.minimum(start + run - 1 + self.wide, self.stop[which])


EIGHTHS = 8
LOWEST = np.array([0] + [(i & -i).bit_length() - 1 for i in range(1, 256)])
HIGHEST = np.array([0] + [i.bit_length() - 1 for i in range(1, 256)])


def part(width: int) -> int:
    return -(-(width - ANCHOR_BYTES + 1) // EIGHTHS)


ALONE, WHOLE, SEND, WHOLE_SEND = range(4)


def judge_regions(pids: np.ndarray, cols: list[np.ndarray]) -> np.ndarray:
    """Codes for distinct regions of shards: repeated as a whole or not, whether its bytes are needed, and (from the
    third bit on) for which eighths of the offsets."""
    anchor, h1, h2, many, *cores = cols
    order = np.lexsort((pids, h2, h1, anchor))
    a, b, c = anchor[order], h1[order], h2[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])))
    kind = np.cumsum(new) - 1
    whole = (np.bincount(kind, weights=1 + many[order]) >= 2)[kind]
    masks = np.zeros(len(order), np.uint16)
    one = np.flatnonzero(new)
    for j, core in enumerate(cores):
        mine = core[order[one]]
        _, place, count = np.unique(H.mix(a[one] ^ mine), return_inverse=True, return_counts=True)
        masks[one[(count[place] > 1) & (mine != 0)]] |= np.uint16(1 << j)
    codes = np.where(whole, WHOLE, np.where(masks > 0, SEND, ALONE)).astype(np.uint16)
    codes[whole & (masks > 0)] = WHOLE_SEND
    out = np.empty(len(codes), np.uint16)
    out[order] = codes | masks << 2
    return out


def by_anchor(got: list[list[np.ndarray]], widths: tuple[int, ...]) -> list[list[np.ndarray]]:
    """Flags, by width, of the windows of every region that came to a bucket; got: (anchors, sizes, windows, places of
    the anchors, bytes) of each block."""
    anchors, _, runs, leads = (np.concatenate(x) for x in list(zip(*got, strict=True))[:4])
    regions = [r for g in got for r in split(g[4], g[1])]
    order = np.argsort(anchors, kind="stable")
    at, size = H.runs(anchors[order])
    flags: list = [None] * len(regions)

    def run(which: list[int], judge) -> None:
        stop = np.cumsum(runs[which])[:-1]
        for i, f in zip(which, zip(*(np.split(hit, stop) for hit in judge([regions[i] for i in which], runs[which])), strict=True), strict=True):
            flags[i] = list(f)

    held, total = [], 0
    for a, m in zip(at.tolist(), size.tolist(), strict=True):
        which = order[a : a + m].tolist()
        here = sum(len(regions[i]) for i in which)
        if here > ARRAY_BYTES:
            run(which, lambda r, n, lead=leads[which]: repeated_by_offset(r, n, lead, widths))
            continue
        if held and total + here > ARRAY_BYTES:
            run(held, lambda r, n: repeated(r, n, widths))
            held, total = [], 0
        held, total = held + which, total + here
    if held:
        run(held, lambda r, n: repeated(r, n, widths))
    return flags


def split(data: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    raw, ends = data.tobytes(), np.cumsum(sizes).tolist()
    return [raw[e - n : e] for e, n in zip(ends, sizes.tolist(), strict=True)]


def dedup_suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 400, passage: int = 300) -> DataFrame:
    """Every column of docs, with kept (binary), n_bytes, n_removed, spans (maximal removed runs: start, stop) and
    n_passage.

    Texts are UTF-8 bytes (null: empty); no match crosses rows. A byte goes if a string of `width` bytes over it also
    starts anywhere else, in its own row or another, overlaps included; so every copy goes, repeated rows and rows of
    null or equal ids too, and there are no ties to break. Shorter texts keep all bytes. Very long texts are one row
    of a shard of their own. An empty table gives no rows. n_passage counts the bytes under a string of `passage`
    bytes (at most `width`) that also starts anywhere else; nothing goes for that. Input columns named as a result get
    the suffix _in.
    """
    if not 2 * ANCHOR_BYTES <= passage <= width < 1 << 16:
        raise ValueError(f"passage is {passage}; from {2 * ANCHOR_BYTES} to width ({width}) is needed")
    docs = S.free_names(docs, "kept", "n_bytes", "n_removed", "spans", "n_passage")
    n, widths = S.n_parts(docs), (passage, width)

    def seeds_of(batch):
        b = Bytes(batch, text_col, passage, width)
        return b.anchors, b.found()

    shards, seeds = S.shard_and_seed(docs, id_col, text_col, seeds_of, n)

    def local(row):
        blob, *known = S.unpack(row["blob"])
        batch = S.read_blob(blob)
        b = Bytes(batch, text_col, passage, width, known)
        distinct = np.unique(b.anchors)
        which, h1, h2 = b.regions(S.answers(row["seeds"] or [], np.arange(len(distinct))))
        order = np.lexsort((which, h2, h1, b.anchors[which]))
        x, y, z = b.anchors[which][order], h1[order], h2[order]
        new = np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1]))) if len(x) else np.zeros(0, bool)
        kind = np.empty(len(x), np.int64)
        kind[order] = np.cumsum(new) - 1
        return batch, b, which, kind, (x[new], y[new], z[new]), which[order[new]]

    def send_hashes(batches):
        for bt in batches:
            for row in bt.to_pylist():
                _, b, _, kind, (x, y, z), place = local(row)
                if len(x):
                    yield S.table(S.to_blocks(row["pid"], x, n, y, z, (np.bincount(kind) > 1).astype(np.uint8), *b.cores(place))[1], S.BLOCK_SCHEMA)

    def needed(row, b, x, place):
        """Distinct regions of which bytes go out, in the order of their blocks, and the windows to judge."""
        codes = S.answers(row["codes"] or [], np.argsort(H.bucket_of(x, n), kind="stable"), np.uint16)
        go = np.flatnonzero(codes & 3 >= SEND)
        return codes & 3, go, *b.needed(place[go], codes[go] >> 2)

    def send_bytes(batches):
        for bt in batches:
            for row in bt.to_pylist():
                _, b, _, _, (x, _, _), place = local(row)
                _, go, start, run, stop = needed(row, b, x, place)
                lead, rows = b.at[place[go]] - start, []
                at, size = H.runs(H.bucket_of(x[go], n))
                for f, m in zip(at.tolist(), size.tolist(), strict=True):
                    some = slice(f, f + m)
                    raw = b.data[spread(start[some], stop[some] - start[some])]
                    rows.append({"pid": row["pid"], "bucket": int(H.bucket_of(x[go[f : f + 1]], n)[0]), "data": S.pack(x[go[some]], stop[some] - start[some], run[some], lead[some], raw)})
                if rows:
                    yield S.table(rows, S.BLOCK_SCHEMA)

    def sort_regions(batches):
        by: dict[int, list] = {}
        for bt in batches:
            for row in bt.to_pylist():
                by.setdefault(row["bucket"], []).append((row["pid"], S.unpack(row["data"])))
        for bucket, got in by.items():
            flags, at, rows = by_anchor([g for _, g in got], widths), 0, []
            for pid, g in got:
                mine = [np.concatenate(f) for f in zip(*flags[at : at + len(g[0])], strict=True)]
                at += len(g[0])
                rows.append({"pid": pid, "bucket": bucket, "data": np.packbits(np.concatenate(mine)).tobytes()})
            yield S.table(rows, S.BLOCK_SCHEMA)

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    added = [("kept", T.BinaryType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("spans", span), ("n_passage", T.LongType())]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(*f) for f in added)])

    def finish(batches):
        for bt in batches:
            for row in bt.to_pylist():
                batch, b, which, kind, (x, _, _), place = local(row)
                codes, go, start, run, _ = needed(row, b, x, place)
                whole = which[np.isin(codes[kind], (WHOLE, WHOLE_SEND))] if len(kind) else which
                hits: tuple[list, ...] = ([], [])
                for hit, size in zip(hits, widths, strict=True):
                    hit.append(spread(b.start[whole], np.clip(b.stop[whole] - size - b.start[whole] + 1, 0, b.run[whole])))
                by_bucket = {r["bucket"]: r["data"] for r in row["reply"] or []}
                at, size = H.runs(H.bucket_of(x[go], n))
                for f, m in zip(at.tolist(), size.tolist(), strict=True):
                    places = spread(start[f : f + m], run[f : f + m])
                    flags = np.unpackbits(np.frombuffer(by_bucket[int(H.bucket_of(x[go[f : f + 1]], n)[0])], np.uint8), count=2 * len(places)).astype(bool)
                    for hit, flag in zip(hits, np.split(flags, 2), strict=True):
                        hit.append(places[flag])
                yield result(batch, b, *(covered(np.concatenate(h), w, len(b.data)) for h, w in zip(hits, widths, strict=True)))

    def covered(starts, size, n):
        """Which of n bytes a string of `size` bytes at one of the starts covers."""
        starts, steps = np.unique(starts), np.zeros(n + 1, np.int32)
        steps[starts] += 1
        steps[starts + size] -= 1
        return np.cumsum(steps[:-1]) > 0

    def result(batch, b, passages, gone):
        kept, lost, shared = (np.concatenate(([0], np.cumsum(x)))[b.offsets] for x in (~gone, gone, passages))
        begins = gone.copy()
        if len(gone):
            inner = np.zeros(len(gone) + 1, bool)
            inner[b.offsets] = True
            begins[1:] &= ~gone[:-1] | inner[1:-1]
            ends = gone & np.concatenate((~gone[1:] | inner[1:-1], [True]))
        else:
            ends = gone
        s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        base = b.offsets[np.searchsorted(b.offsets, s, side="right") - 1]
        lists = np.searchsorted(s, b.offsets).astype(np.int32)
        spans = pa.ListArray.from_arrays(lists, pa.StructArray.from_arrays([pa.array(s - base), pa.array(e - base)], names=["start", "stop"]))
        out = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(kept.astype(np.int32).tobytes()), pa.py_buffer(b.data[~gone].tobytes())])
        return pa.RecordBatch.from_arrays([*batch.columns, out, pa.array(np.diff(b.offsets)), pa.array(np.diff(lost)), spans, pa.array(np.diff(shared))], names=[*batch.schema.names, *(f[0] for f in added)])

    seeded = shards.join(seeds.withColumnRenamed("reply", "seeds"), "pid", "left")
    codes = S.checkpoint(S.judged(seeded.mapInArrow(S.lean(send_hashes), S.BLOCKS), judge_regions, n)).withColumnRenamed("reply", "codes")
    coded = seeded.join(codes, "pid", "left")
    flags = coded.select("pid", "blob", "seeds", "codes").mapInArrow(S.lean(send_bytes), S.BLOCKS).repartition(n, "bucket").mapInArrow(S.lean(sort_regions), S.BLOCKS)
    flags = flags.groupBy("pid").agg(F.collect_list(F.struct("bucket", "data")).alias("reply"))
    return coded.join(flags, "pid", "left").select("pid", "blob", "seeds", "codes", "reply").mapInArrow(S.lean(finish), schema)
