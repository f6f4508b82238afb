"""Hard-negative mining by vantage-point trees over norm-augmented vectors.

Every vector x gets one more component, sqrt(M - |x|^2), where M is the largest squared norm; a question q gets 0. Then
|q - x|^2 = |q|^2 + M - 2 q.x: a higher score is a smaller distance, and a window of scores is an annulus round q. A tree
of vantage points, fitted to a bounded sample, deals all rows into cells; a cell is held in chunks of bounded size, each
with a vantage-point tree of its own. A question is asked in its own chunk first; what it finds bounds how far it has to
look, and it goes on to those cells alone whose distances to their vantage points leave room within the annulus. In a
chunk, leaves are visited nearest first from the annulus' inner edge, until no leaf can hold a better row. All of it is
exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.shards import lean, n_parts, pack, shared_dir, unpack

#: Rows of the sample that the upper tree is fitted to, and most cells it deals rows into.
SAMPLE, MOST_CELLS = 2048, 256
#: About how many rows a chunk and at most how many a leaf has; questions asked at once; questions a copy of a chunk gets.
CHUNK, LEAF, AT_ONCE, A_COPY = 4096, 128, 1024, 1 << 16
#: Squared norms from which scores would not be exact in double precision.
MOST_NORM = 1 << 52
LEAST, MOST = -(1 << 62), 1 << 62
ASKED = "anchor long, tag long, label long, lo long, hi long, vec binary"


def distances(a: np.ndarray, b: np.ndarray, norm: float) -> np.ndarray:
    """Between rows, both norm-augmented."""
    more = [np.sqrt(np.maximum(norm - (x * x).sum(axis=1), 0)) for x in (a, b)]
    return np.sqrt(np.maximum(2 * norm - 2 * (a @ b.T + np.outer(*more)), 0))


@dataclass
class Upper:
    """A complete binary tree: node i goes to 2i + 1 within radius[i] of its vantage point, else to 2i + 2."""

    vantage: np.ndarray
    radius: np.ndarray
    depth: int
    norm: float

    def route(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's cell, and its distances to the vantage points on the way."""
        node, way = np.zeros(len(vectors), np.int64), np.zeros((len(vectors), self.depth))
        if self.depth:
            d, at = distances(vectors, self.vantage, self.norm), np.arange(len(vectors))
            for level in range(self.depth):
                way[:, level] = d[at, node]
                node = 2 * node + 2 - (way[:, level] <= self.radius[node])
        return node - ((1 << self.depth) - 1), way

    def way(self, cell: int) -> list[int]:
        node, out = cell + (1 << self.depth) - 1, []
        while node:
            node = (node - 1) // 2
            out.append(node)
        return out[::-1]


def fit(sample: np.ndarray, depth: int, norm: float) -> Upper:
    """Vantage points far from those above them, radii at medians."""
    n = (1 << depth) - 1
    vantage, radius = np.zeros((n, sample.shape[1])), np.zeros(n)
    members = {0: (np.arange(len(sample)), None)}
    for node in range(n):
        rows, above = members.pop(node)
        if len(rows):
            v = sample[rows[above.argmax() if above is not None else 0]]
            d = distances(sample[rows], v[None], norm)[:, 0]
            vantage[node], radius[node] = v, np.median(d)
        else:
            d = np.zeros(0)
        for child, side in ((2 * node + 1, d <= radius[node]), (2 * node + 2, d > radius[node])):
            members[child] = (rows[side], d[side] if side.any() else None)
    return Upper(vantage, radius, depth, norm)


@dataclass
class Chunk:
    """Rows leaf by leaf, in each by id; vantage points (rows) on each leaf's way, and the least and the largest distance
    of the leaf's rows to each; -1 where a way is shorter."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    leaves: np.ndarray
    way: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def to_bytes(self) -> bytes:
        kind = np.int16 if not len(self.vectors) or np.abs(self.vectors).max() < 1 << 15 else np.int64
        shape = np.array([*self.vectors.shape, *self.way.shape], np.int64)
        return pack(self.ids, self.labels, self.vectors.astype(kind).ravel(), self.leaves, self.way.ravel(), self.least.ravel(), self.most.ravel(), shape)

    @staticmethod
    def of_bytes(data: bytes) -> Chunk:
        ids, labels, vectors, leaves, way, least, most, shape = unpack(data)
        return Chunk(ids, labels, vectors.reshape(shape[:2]).astype(np.float64), leaves, *(x.reshape(shape[2:]) for x in (way, least, most)))


def build(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, norm: float, leaf: int = LEAF) -> Chunk:
    found: list[tuple[np.ndarray, list[int]]] = []
    todo = [(np.argsort(ids, kind="stable"), [], None)]
    while todo:
        rows, way, far = todo.pop()
        if len(rows) <= leaf:
            found.append((rows[np.argsort(ids[rows], kind="stable")], way))
            continue
        v = int(rows[0 if far is None else far.argmax()])
        d = distances(vectors[rows], vectors[[v]], norm)[:, 0]
        o = np.argsort(d, kind="stable")
        for part in np.split(o, [len(o) // 2]):
            todo.append((rows[part], [*way, v], d[part]))
    depth = max(1, max(len(w) for _, w in found))
    order = np.concatenate([r for r, _ in found])
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    ways, least, most = np.full((len(found), depth), -1), np.zeros((len(found), depth)), np.full((len(found), depth), np.inf)
    for i, (rows, way) in enumerate(found):
        if way and len(rows):
            d = distances(vectors[rows], vectors[way], norm)
            ways[i, : len(way)], least[i, : len(way)], most[i, : len(way)] = place[way], d.min(axis=0), d.max(axis=0)
    return Chunk(ids[order], labels[order], vectors[order], np.cumsum([0, *(len(r) for r, _ in found)]), ways, least, most)


def score_bounds(far: np.ndarray, least: np.ndarray, most: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score that rows can have whose distances to vantage points are between least and most, where
    those of the question are `far` (the last axis: the way). whole: |q|^2 + M."""
    near = np.maximum(np.maximum(far - most, least - far), 0).max(axis=-1)
    away = (far + most).min(axis=-1)
    room = 1 + whole * 1e-9  # scores are whole numbers; distances are rounded
    return (whole - away * away) / 2 - room, (whole - near * near) / 2 + room


def search(chunk: Chunk, norm: float, anchor: np.ndarray, label: np.ndarray, lo: np.ndarray, hi: np.ndarray, vectors: np.ndarray, same: bool, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each question the k best (score, id), best first, of the chunk's rows of its label (same; but not the anchor) or
    of other labels, with lo <= score <= hi; LEAST where there are fewer. And the number of leaves visited."""
    q, n_leaves = len(anchor), len(chunk.leaves) - 1
    score, ids, visits = np.full((q, k), LEAST), np.full((q, k), MOST), 0
    _, first, who = np.unique(anchor, return_index=True, return_inverse=True)  # windows of one anchor share its vector
    vectors = vectors[first]
    whole = (vectors * vectors).sum(axis=1) + norm
    points, at = np.unique(chunk.way, return_inverse=True)
    far = np.sqrt(np.maximum(whole[:, None] - 2 * vectors @ chunk.vectors[points].T, 0))
    at = at.reshape(chunk.way.shape)
    none = chunk.way < 0
    below, above = (np.empty((len(first), n_leaves)) for _ in range(2))
    for leaf in range(n_leaves):
        d = np.where(none[leaf], 0, far[:, at[leaf]])
        below[:, leaf], above[:, leaf] = score_bounds(d, np.where(none[leaf], 0, chunk.least[leaf]), np.where(none[leaf], np.inf, chunk.most[leaf]), whole)
    below, above = below[who], np.minimum(above[who], hi[:, None])
    above[below > hi[:, None]] = -np.inf
    order = np.argsort(-above, axis=1, kind="stable")
    for turn in range(n_leaves):
        next_leaf = order[:, turn]
        live = np.flatnonzero(above[np.arange(q), next_leaf] >= np.maximum(lo, score[:, -1]))
        if not len(live):
            break
        live = live[np.argsort(next_leaf[live], kind="stable")]
        for part in np.split(live, np.flatnonzero(np.diff(next_leaf[live])) + 1):
            rows = slice(*chunk.leaves[next_leaf[part[0]] :][:2])
            if rows.start == rows.stop:
                continue
            visits += len(part)
            own, back = np.unique(who[part], return_inverse=True)
            s = np.rint(vectors[own] @ chunk.vectors[rows].T).astype(np.int64)[back]
            fits = (chunk.labels[rows] == label[part, None]) == same
            fits &= (s >= lo[part, None]) & (s <= hi[part, None]) & (chunk.ids[rows] != anchor[part, None])
            s[~fits] = LEAST
            best = np.argsort(-s, axis=1, kind="stable")[:, :k]  # rows of a leaf are in the order of ids
            s = np.take_along_axis(s, best, axis=1)
            i = np.where(s == LEAST, MOST, chunk.ids[rows][best])
            s, i = np.concatenate((score[part], s), axis=1), np.concatenate((ids[part], i), axis=1)
            o = np.lexsort((i, -s), axis=1)[:, :k]
            score[part], ids[part] = np.take_along_axis(s, o, axis=1), np.take_along_axis(i, o, axis=1)
    return score, ids, visits


def whole_vectors(data: list[bytes], size: int) -> np.ndarray:
    """Vectors of whole numbers of any length, filled up with zeros."""
    out = np.zeros((len(data), size))
    lengths = {len(x) for x in data}
    if lengths == {8 * size}:
        return np.frombuffer(b"".join(data), np.int64).reshape(len(data), size).astype(np.float64)
    for i, x in enumerate(data):
        v = np.frombuffer(x, np.int64)
        out[i, : len(v)] = v
    return out


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, extra: Column) -> DataFrame:
    """(id, label, anchor, vec, norm2, size) of the rows that take part; vec holds floor(scale * x) as 64-bit integers."""
    kind = dict(vectors.dtypes)[label_col]
    label = F.col(label_col).cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(label_col)
    rows = vectors.where(F.col(vector_col).isNotNull() & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list = [[] for _ in range(6)]
            for i, y, a, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if None in v:
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all():
                    continue
                x = np.floor(x * scale)
                norm = float(x @ x)
                if norm >= MOST_NORM:
                    raise ValueError(f"row {i}: the squared norm passes {MOST_NORM}, scores would not be exact")
                for o, value in zip(out, (i, y, a, x.astype(np.int64).tobytes(), int(norm), len(x)), strict=True):
                    o.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["id", "label", "anchor", "vec", "norm2", "size"])

    slim = rows.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), extra.alias("anchor"), F.col(vector_col).cast("array<double>").alias("v"))
    return slim.mapInArrow(lean(run), "id long, label long, anchor boolean, vec binary, norm2 long, size long")


@dataclass
class Index:
    """An index over rows (id, label, anchor, vec, cell, chunk), and chunks (cell, chunk, blob) written as tables; cells are
    at most MOST_CELLS: their numbers of chunks, and the bounds of their rows' distances."""

    rows: DataFrame
    chunks: DataFrame
    upper: Upper
    counts: dict[int, int]
    least: np.ndarray
    most: np.ndarray
    cells: np.ndarray
    size: int


def index_vectors(rows: DataFrame, path: str, chunk: int = CHUNK, leaf: int = LEAF, sample: int = SAMPLE, most_cells: int = MOST_CELLS) -> Index | None:
    """Index every row of rows, as quantised() gives them; None if there are none. The upper tree is fitted to `sample` rows
    at most, those of smallest hash of id."""
    spark, n = rows.sparkSession, n_parts(rows)
    total, norm, size = rows.agg(F.count("*"), F.max("norm2"), F.max("size")).first()
    if not total:
        return None
    depth = 0
    while 2 << depth <= min(most_cells, total // chunk):
        depth += 1
    few = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").collect() if depth else []
    upper = fit(whole_vectors([bytes(r.vec) for r in few], size), depth, float(norm))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, way = upper.route(whole_vectors(batch.column(3).to_pylist(), size))
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(cell), *(pa.array(np.ascontiguousarray(w)) for w in way.T)], names=["id", "label", "anchor", "vec", "cell", *(f"w{i}" for i in range(depth))])

    ways = "".join(f", w{i} double" for i in range(depth))
    rows.mapInArrow(lean(deal), f"id long, label long, anchor boolean, vec binary, cell long{ways}").write.parquet(f"{path}/dealt")
    dealt = spark.read.parquet(f"{path}/dealt")
    stats = dealt.groupBy("cell").agg(F.count("*").alias("n"), *(f(f"w{i}") for f in (F.min, F.max) for i in range(depth))).orderBy("cell").collect()
    counts = {r.cell: -(-r.n // chunk) for r in stats}
    bounds = np.array([tuple(r)[2:] for r in stats], float).reshape(len(stats), 2, depth)
    many = F.element_at(F.create_map(*(F.lit(x) for c, m in counts.items() for x in (c, m))), F.col("cell"))
    dealt = dealt.select("id", "label", "anchor", "vec", "cell", F.pmod(F.xxhash64("id", F.lit(3)), many).alias("chunk"))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            c = build(column(t, "id"), column(t, "label"), whole_vectors(t.column(2).to_pylist(), size), float(norm), leaf)
            return pa.RecordBatch.from_arrays([t.column(3).slice(0, 1), t.column(4).slice(0, 1), pa.array([c.to_bytes()], pa.binary())], names=["cell", "chunk", "blob"])

        for batch in batches:
            keys = np.stack([column(batch, "cell"), column(batch, "chunk")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(s, e - s)
                if held and (held[0].column(3)[0] != part.column(3)[0] or held[0].column(4)[0] != part.column(4)[0]):
                    yield made()
                    held = []
                held.append(part)
        if held:
            yield made()

    sorted_rows = dealt.select("id", "label", "vec", "cell", "chunk").repartition(n, "cell", "chunk").sortWithinPartitions("cell", "chunk")
    sorted_rows.mapInArrow(lean(grow), "cell long, chunk long, blob binary").write.parquet(f"{path}/chunks")
    return Index(dealt, spark.read.parquet(f"{path}/chunks"), upper, counts, bounds[:, 0], bounds[:, 1], np.array([r.cell for r in stats]), size)


def ask(index: Index, asked: DataFrame, same: bool, k: int, copies: int) -> DataFrame:
    """(anchor, tag, id, score): what search() finds for the questions asked (ASKED, cell, chunk) in the chunk that each
    names. Chunks are held in so many copies, so that no task gets all questions of a chunk."""
    n, norm, size = n_parts(asked), index.upper.norm, index.size
    empty = {"anchor": "long", "tag": "long", "label": "long", "lo": "long", "hi": "long"}
    held = index.chunks.withColumn("copy", F.explode(F.array(*(F.lit(i) for i in range(copies)))))
    held = held.select(*(F.lit(None).cast(t).alias(c) for c, t in empty.items()), F.col("blob").alias("vec"), "cell", "chunk", "copy", F.lit(0).alias("kind"))
    both = held.unionByName(asked.withColumn("copy", F.pmod(F.xxhash64("anchor"), F.lit(copies)).cast("int")).withColumn("kind", F.lit(1)))
    both = both.repartition(n, "cell", "chunk", "copy").sortWithinPartitions("cell", "chunk", "copy", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = None
        for batch in batches:
            kind = column(batch, "kind")
            vec = batch.column(batch.schema.get_field_index("vec"))
            starts = np.flatnonzero(kind == 0)
            for s, e in zip([0, *(starts + 1)], [*starts, batch.num_rows], strict=True):
                if s and kind[s - 1] == 0:
                    chunk = vec[int(s) - 1].as_py()
                for at in range(s, e, AT_ONCE):
                    if isinstance(chunk, bytes):
                        chunk = Chunk.of_bytes(chunk)
                    part = batch.slice(at, min(AT_ONCE, e - at))
                    anchor, tag, label, lo, hi = (column(part, c) for c in empty)
                    if pa.types.is_binary(vec.type) and part.num_rows:
                        q = whole_vectors(part.column(part.schema.get_field_index("vec")).to_pylist(), size)
                        score, ids, _ = search(chunk, norm, *(x.astype(np.int64) for x in (anchor, label, lo, hi)), q, same, k)
                        r, c = np.nonzero(score > LEAST)
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (anchor[r].astype(np.int64), tag[r].astype(np.int64), ids[r, c], score[r, c])], names=["anchor", "tag", "id", "score"])

    return both.mapInArrow(lean(run), "anchor long, tag long, id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each (anchor, tag), with their place."""
    order = Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def nearest(index: Index, asked: DataFrame, same: bool, k: int, path: str, copies: int) -> DataFrame:
    """best_of() all rows for the questions asked (ASKED, cell, chunk: the chunk that each starts in)."""
    spark, upper, cells, least, most, size = asked.sparkSession, index.upper, index.cells, index.least, index.most, index.size
    ask(index, asked, same, k, copies).write.parquet(f"{path}/home")
    home = spark.read.parquet(f"{path}/home")
    reached = home.groupBy("anchor", "tag").agg(F.when(F.count("*") >= k, F.min("score")).alias("worst"))
    rest = asked.join(reached, ["anchor", "tag"], "left").withColumn("lo", F.greatest("lo", "worst")).drop("worst")
    ways = np.array([upper.way(c) for c in cells.tolist()], np.int64).reshape(len(cells), upper.depth)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lo, hi = column(batch, "lo"), column(batch, "hi")
            may = np.ones((batch.num_rows, len(cells)), bool)
            if upper.depth:
                q = whole_vectors(batch.column(batch.schema.get_field_index("vec")).to_pylist(), size)
                whole = (q * q).sum(axis=1) + upper.norm
                far = np.sqrt(np.maximum(whole[:, None] - 2 * q @ upper.vantage.T, 0))
                for i in range(len(cells)):
                    below, above = score_bounds(far[:, ways[i]], least[i], most[i], whole)
                    may[:, i] = (below <= hi) & (above >= lo)
            r, c = np.nonzero(may)
            out = batch.take(pa.array(r))
            names = out.schema.names
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cells[c])], names=[*names, "to"])

    spread = rest.mapInArrow(lean(reach), f"{ASKED}, cell long, chunk long, to long")
    many = F.element_at(F.create_map(*(F.lit(x) for c, m in index.counts.items() for x in (c, m))), F.col("to"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), many.cast("long") - 1)))
    spread = spread.where("to <> cell or other <> chunk").select("anchor", "tag", "label", "lo", "hi", "vec", F.col("to").alias("cell"), F.col("other").alias("chunk"))
    return best_of(home.unionByName(ask(index, spread, same, k, copies)), k)


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), scale: int = 256, chunk: int = CHUNK, leaf: int = LEAF) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each row of `anchors` and each of its
    `positives` best other rows of its label, the `negatives` best rows of other labels whose score is between window[0]
    and window[1] hundredths of the positive's.

    Scores are inner products of floor(scale * x); higher ones come first, ties by smaller id. Rows of null id, label or
    vector, or with a null or non-finite component, take no part; shorter vectors count as filled up with zeros. Ids are
    those of rows: rows that repeat an id all take part, and none of them is another row of itself. Where fewer rows
    fit, all are returned, and a positive without negatives has no row; nor has an empty table. Every row is indexed
    and no candidate left out. Squared norms from 2**52 on are an error. Other columns play no part.
    """
    spark = vectors.sparkSession
    path = shared_dir(spark)
    quantised(vectors, id_col, vector_col, label_col, scale, F.coalesce(anchors, F.lit(False))).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    index = index_vectors(rows, path, chunk, leaf)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if index is None:
        return spark.createDataFrame([], out)
    anchor = index.rows.where("anchor").dropDuplicates(["id"]).select(F.col("id").alias("anchor"), "label", "vec", "cell", "chunk")
    copies = max(1, positives * anchor.count() // A_COPY)
    wide = [F.lit(x).cast("long").alias(c) for c, x in (("tag", 0), ("lo", LEAST + 1), ("hi", MOST))]
    nearest(index, anchor.select("anchor", "label", *wide, "vec", "cell", "chunk"), True, positives, f"{path}/same", copies).write.parquet(f"{path}/positives")
    found = spark.read.parquet(f"{path}/positives").select("anchor", F.col("id").alias("tag"), F.col("score").alias("positive_score"))
    p = F.col("positive_score").cast("decimal(38,0)")
    inside = found.withColumn("lo", F.ceil(p * window[0] / 100).cast("long")).withColumn("hi", F.floor(p * window[1] / 100).cast("long")).where("lo <= hi")
    asked = inside.join(anchor, "anchor").select("anchor", "tag", "label", "lo", "hi", "vec", "cell", "chunk")
    best = nearest(index, asked, False, negatives, f"{path}/other", copies)
    return best.join(found, ["anchor", "tag"]).select(F.col("anchor").alias("anchor_id"), F.col("tag").alias("positive_id"), F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
