"""Point-in-time features by offline divide and conquer on event time and availability.

Whatever happened to a client is a point (e, a): e when it happened, a from when on it is known. A sale at t asks, for a
window of d days, for the points with e > t - d and a <= t: a dominance in two dimensions. Elements (points and
questions) are sorted by client and falling e and cut into leaves of bounded size, then sorted by client and a and cut
into cells of bounded size. Pairs of one leaf, and pairs of one cell and two leaves, are met inside tasks by halving.
All other pairs are met between sums of leaves and cells: in each round a left half of the leaves' order (and of the
cells' order) gives its sums to the right half, which is an equality join of the halves' numbers.

Distinct items are counted as intervals: a line is known and in the window while a <= t < e + d. The intervals of an item
of a client are trimmed until they are disjoint, and each is a point again.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.llm.shards import lean, n_parts, shared_dir

#: Elements of a leaf or a cell.
LEAF = 32_768
#: Rows of a partition that are looked at to find ranges of keys.
SAMPLES = 20
DAY = 86_400_000_000
#: Cells of time in which an item's intervals are trimmed before they meet across cells.
TRIM = DAY // 24
CLICK, PURCHASE, SALE, LINES, FUTURE, LABEL, WINDOW = range(7)
#: The id of clicks without one. Questions of sales without an id have a count below 0.
NO_ID = -(1 << 63)
#: What is summed over points, besides the items of each window.
SUMS = ("n_clicks", "n_purchases", "click_cents", "n_sales", "sale_cents", "n_lines", "line_cents", "future")


def micros(ts: Column, kind: str) -> Column:
    """Microseconds since 1970 of a timestamp with or without a zone, the latter taken as UTC."""
    if kind != "timestamp_ntz":
        return F.unix_micros(ts.cast("timestamp"))
    second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return F.unix_date(ts.cast("date")).cast("long") * DAY + (F.hour(ts) * 60 + F.minute(ts)).cast("long") * 60_000_000 + second


def cents(x: Column) -> Column:
    """floor(100 * x + 0.5); null and what is not finite are 0."""
    whole = F.floor(x.cast("double") * 100 + 0.5)
    return F.when(F.abs(x.cast("double")) < 1e15, whole).otherwise(0).cast("long")


def dominated(group: np.ndarray, rank: np.ndarray, query: np.ndarray, weights: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query: the sums of weights, and the largest `last`, of the points of its group that stand before it and
    have a smaller rank. Groups are runs of equal neighbours; ranks are 0 to n - 1; `last` is -1 where there is none.

    Halving: in each round the left half of every block gives to its right half, in the order of rank. Only the run that
    crosses a block's middle has pairs there.
    """
    n = len(group)
    sums, best = np.zeros(weights.shape, np.int64), np.full(n, -1, np.int64)
    at = np.arange(n)
    for k in range(max(n - 1, 0).bit_length()):
        middle = np.arange(1 << k, n, 2 << k)
        crossing = np.zeros((n >> (k + 1)) + 1, bool)
        crossing[: len(middle)] = group[middle - 1] == group[middle]
        if not crossing.any():
            continue
        owner = np.zeros(len(crossing), group.dtype)
        owner[: len(middle)] = group[middle]
        block = at >> (k + 1)
        chosen = np.flatnonzero(crossing[block] & (group == owner[block]) & ((at >> k & 1).astype(bool) == query))
        if not len(chosen):
            continue
        block = block[chosen]
        order = np.argsort(block * n + rank[chosen])
        chosen, block = chosen[order], block[order]
        asks = query[chosen]
        gives = weights[chosen]
        gives[asks] = 0
        so_far = np.cumsum(gives, axis=0)
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        before = so_far[starts] - gives[starts]
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(block))))
        to = chosen[asks]
        sums[to] += so_far[asks] - before[run[asks]]
        top = np.maximum.accumulate(np.where(asks, -1, last[chosen]) + 1 + run * (n + 1))
        best[to] = np.maximum(best[to], top[asks] - 1 - run[asks] * (n + 1))
    return sums, best


def chunks(batches: Iterator[pa.RecordBatch], group: str, most: int) -> Iterator[tuple[int, pa.Table, bool, bool]]:
    """(number, rows, whether the first group may have rows before them, whether the last may have some after them) of
    one sorted partition, cut between groups where the second half of a chunk allows it."""
    held: list[pa.RecordBatch] = []
    size, number, open_before = 0, TaskContext.get().partitionId() << 24, True
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        while size > most:
            t = pa.Table.from_batches(held).combine_chunks()
            g = t.column(group).to_numpy()[: most + 1]
            edges = np.flatnonzero(g[1:] != g[:-1]) + 1
            cut = int(edges[-1]) if len(edges) and edges[-1] > most // 2 else most
            open_after = g[cut - 1] == t.column(group)[cut].as_py()
            yield number, t.slice(0, cut), open_before, bool(open_after)
            number, open_before = number + 1, bool(open_after)
            held, size = t.slice(cut).to_batches(), size - cut
    if size:
        yield number, pa.Table.from_batches(held).combine_chunks(), open_before, True


def crossing_groups(g: np.ndarray, before: bool, after: bool) -> np.ndarray:
    """Which rows belong to a group that other chunks may hold too."""
    out = np.zeros(len(g), bool)
    if before:
        out |= g == g[0]
    if after:
        out |= g == g[-1]
    return out


def weights_of(t: dict[str, np.ndarray], windows: int) -> np.ndarray:
    kind, n = t["kind"], t["n"]
    w = np.zeros((len(kind), len(SUMS) + windows), np.int64)
    for column, kinds, value in ((0, (CLICK, PURCHASE), n), (1, (PURCHASE,), n), (2, (CLICK, PURCHASE), t["cents"]), (3, (SALE,), n), (4, (SALE,), t["cents"]), (5, (LINES,), n), (6, (LINES,), t["cents"]), (7, (FUTURE,), n)):
        w[:, column] = np.where(np.isin(kind, kinds), value, 0)
    for i in range(windows):
        w[:, len(SUMS) + i] = t[f"i{i}"]
    return w


def element_columns(windows: int) -> list[str]:
    return ["client", "e", "a", "kind", "id", "n", "cents", *(f"i{i}" for i in range(windows))]


def answer_columns(windows: int) -> list[str]:
    return [*SUMS, *(f"items{i}" for i in range(windows)), "last_ts", "last_id"]


def disjoint_items(lines: DataFrame, windows: Sequence[int]) -> DataFrame:
    """(client, e, a, i0, i1, ...): points such that, for each window, the points in it at any t are as many as the
    distinct items of lines (client, item, e, a) in it. An interval begins where those begun before it have ended."""
    span = [d * DAY for d in windows]
    one = lines.where("item is not null").groupBy("client", "item", "a").agg(F.max("e").alias("e")).withColumn("cell", F.floor(F.col("a") / TRIM))
    alive = [F.when(F.col("a") < F.col("e") + d, F.col("e")) for d in span]
    inside = Window.partitionBy("client", "item", "cell").orderBy("a")
    one = one.withColumns({f"m{i}": F.max(x).over(inside.rowsBetween(Window.unboundedPreceding, -1)) for i, x in enumerate(alive)} | {f"x{i}": F.max(x).over(inside.rowsBetween(Window.unboundedPreceding, 0)) for i, x in enumerate(alive)} | {"after": F.lead("a").over(inside)})
    # one row a cell, of which an item has as many as the tables have hours
    across = Window.partitionBy("client", "item").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    earlier = one.where("after is null").select("client", "item", "cell", *(F.max(f"x{i}").over(across).alias(f"c{i}") for i in range(len(span))))
    both = one.join(earlier, ["client", "item", "cell"])
    starts = {}
    for i, d in enumerate(span):
        begin = F.greatest("a", F.greatest(F.coalesce(f"m{i}", f"c{i}"), F.coalesce(f"c{i}", f"m{i}")) + d)
        starts[f"s{i}"] = F.when(begin < F.col("e") + d, begin)
    both = both.withColumns(starts)
    some = F.array_distinct(F.array_compact(F.array(*starts)))
    return both.select("client", "e", *starts, F.explode(some).alias("a")).select("client", "e", "a", *(F.coalesce(F.col(f"s{i}") == F.col("a"), F.lit(False)).cast("long").alias(f"i{i}") for i in range(len(span))))


def write_elements(path: str, sales: DataFrame, clicks: DataFrame, lines: DataFrame, windows: Sequence[int], horizon: int, delay: int, spread: int) -> DataFrame:
    """Points and questions of all clients, written below path: the columns element_columns(). Each table is written by
    itself, so that no stage holds all their plans: a task sends the driver a number for each step of its stage."""
    late, zero = delay * 60_000_000, F.lit(0).cast("long")
    none = [zero.alias(f"i{i}") for i in range(len(windows))]
    at = lambda df, c: micros(F.col(c), dict(df.dtypes)[c])
    known = sales.where("client_id is not null and sold_at is not null")
    shift = F.pmod(F.crc32(F.coalesce(F.col("sale_id").cast("string"), F.lit("")).cast("binary")), F.lit(spread)) * 1_000_000
    sold = known.select(F.col("client_id").alias("client"), F.col("sale_id").alias("id"), at(sales, "sold_at").alias("e"), at(sales, "arrived_at").alias("arrived"), cents(F.col("total")).alias("cents"), (at(sales, "sold_at") + shift).alias("t"))
    asked = sold.groupBy("client", "id", "t").agg(F.count("*").alias("n")).withColumn("n", F.when(F.col("id").isNull(), -F.col("n")).otherwise(F.col("n")))
    day = lambda d: F.lit(d * DAY)
    spans = [F.struct(F.lit(WINDOW + i).alias("kind"), (F.col("t") - day(d)).alias("e"), F.col("t").alias("a")) for i, d in enumerate(windows)]
    spans.append(F.struct(F.lit(LABEL).alias("kind"), F.col("t").alias("e"), (F.col("t") + day(horizon)).alias("a")))
    questions = asked.select("client", "id", "n", F.explode(F.array(*spans)).alias("s")).select("client", "s.e", "s.a", "s.kind", "id", "n", zero.alias("cents"), *none)
    points = sold.select("client", "id", "cents", "e", F.explode(F.array(F.struct(F.lit(SALE).alias("kind"), F.greatest("e", F.col("arrived") + late).alias("a")), F.struct(F.lit(FUTURE).alias("kind"), F.col("e").alias("a")))).alias("s"), "arrived")
    points = points.where(f"s.kind = {FUTURE} or arrived is not null").select("client", "e", "s.a", "s.kind", "id", F.lit(1).cast("long").alias("n"), "cents", *none)
    own = [c for c in clicks.columns if c != "props"]
    props = [F.md5(F.col("props").cast("binary")).alias("props")] if "props" in clicks.columns else []
    seen = clicks.where("client_id is not null and ts is not null and arrived_at is not null").select(*own, *props).distinct()
    purchase = F.when(F.col("kind") == "purchase", PURCHASE).otherwise(CLICK)
    clicked = seen.select(F.col("client_id").alias("client"), at(clicks, "ts").alias("e"), F.greatest(at(clicks, "ts"), at(clicks, "arrived_at") + late).alias("a"), purchase.alias("kind"), F.coalesce("click_id", F.lit(NO_ID)).alias("id"), F.lit(1).cast("long").alias("n"), cents(F.col("value")).alias("cents"), *none)
    few = lines.where("shipped_at is not null").groupBy("sale_id", F.col("item_id").alias("item"), at(lines, "shipped_at").alias("shipped")).agg(F.count("*").alias("n"), F.sum(cents(F.col("amount"))).alias("cents"))
    bought = sold.where("arrived is not null and id is not null").select(F.col("id").alias("sale_id"), "client", "e", F.greatest("e", F.col("arrived") + late).alias("from"))
    few.join(bought, "sale_id").select("client", "item", "e", F.greatest("from", "shipped").alias("a"), "n", "cents").write.parquet(f"{path}/shipped")
    shipped = sales.sparkSession.read.parquet(f"{path}/shipped")
    items = disjoint_items(shipped, windows).select("client", "e", "a", zero.alias("n"), zero.alias("cents"), *(f"i{i}" for i in range(len(windows))))
    joint = shipped.select("client", "e", "a", "n", "cents", *none).unionByName(items)
    joint = joint.groupBy("client", "e", "a").agg(*(F.sum(c).alias(c) for c in ("n", "cents", *(f"i{i}" for i in range(len(windows))))))
    joint = joint.select("client", "e", "a", F.lit(LINES).alias("kind"), zero.alias("id"), "n", "cents", *(f"i{i}" for i in range(len(windows))))
    names = element_columns(len(windows))
    for name, found in (("questions", questions), ("sales", points), ("clicks", clicked), ("lines", joint)):
        found.select(*(F.col(c).cast("long" if c != "kind" else "int").alias(c) for c in names)).write.parquet(f"{path}/elements/of={name}")
    return sales.sparkSession.read.parquet(f"{path}/elements").select(*names)


def arrays(t: pa.Table, names: Sequence[str]) -> dict[str, np.ndarray]:
    return {c: pc.fill_null(t.column(c), 0).to_numpy() for c in names}


def answers(t: dict[str, np.ndarray], windows: int, rank: np.ndarray, extra: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """Which elements ask, what they ask for and get, and the weights of all."""
    query = t["kind"] >= LABEL
    w = weights_of(t, windows)
    is_click = np.flatnonzero(t["kind"] <= PURCHASE)
    is_click = is_click[np.lexsort((t["id"][is_click], t["e"][is_click]))]
    last = np.full(len(query), -1, np.int64)
    last[is_click] = np.arange(len(is_click))
    sums, best = dominated(t["client"], rank, query, w, last)
    asks = np.flatnonzero(query)
    got = {c: t[c][asks] for c in ("client", "kind", "id", "n")} | {"t": np.where(t["kind"][asks] == LABEL, t["e"][asks], t["a"][asks])}
    got |= {c: x[asks] for c, x in extra.items()} | {c: sums[asks, i] for i, c in enumerate(answer_columns(windows)[:-2])}
    found = best[asks]
    for name, column in (("last_ts", "e"), ("last_id", "id")):
        got[name] = np.ma.masked_array(t[column][is_click[np.maximum(found, 0)]] if len(is_click) else np.zeros(len(asks), np.int64), found < 0)
    return asks, got, w


def record(columns: dict[str, np.ndarray], names: Sequence[str], n: int) -> pa.RecordBatch:
    """Columns in this order; those that are not there are null."""
    of = lambda c: pa.array(np.ma.getdata(columns[c]), pa.int64(), mask=np.ma.getmaskarray(columns[c])) if c in columns else pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays([of(c) for c in names], names=list(names))


def sorted_by(df: DataFrame, n: int, *keys: Column | str) -> DataFrame:
    """df in n ranges of the keys, each sorted; the last key deals ties over several."""
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)


@contextlib.contextmanager
def small_samples(spark: SparkSession) -> Iterator[None]:
    """Ranges are found from SAMPLES rows a partition, which go to the driver."""
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SAMPLES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def longs(names: Sequence[str]) -> str:
    return ", ".join(f"`{c}` long" for c in names)


def in_leaves(found: DataFrame, windows: int, n: int, leaf: int) -> DataFrame:
    """Answers within leaves (asks = 1; crossing = 1 where other leaves hold rows of the client), and the points of clients
    that several leaves hold (asks = 0)."""
    names = [*element_columns(windows), "asks", "crossing", "leaf", "t", *answer_columns(windows)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table, before, after in chunks(batches, "client", leaf):
            t = arrays(table, element_columns(windows))
            query = t["kind"] >= LABEL
            rank = np.empty(len(query), np.int64)
            rank[np.lexsort((query, t["a"]))] = np.arange(len(query))
            crossing = crossing_groups(t["client"], before, after).astype(np.int64)
            asks, got, _ = answers(t, windows, rank, {"a": t["a"], "crossing": crossing})
            got |= {"asks": np.ones(len(asks), np.int64), "leaf": np.full(len(asks), number)}
            yield record(got, names, len(asks))
            rest = np.flatnonzero((crossing == 1) & ~query)
            if len(rest):
                yield record({c: x[rest] for c, x in t.items()} | {"asks": np.zeros(len(rest), np.int64), "crossing": crossing[rest], "leaf": np.full(len(rest), number)}, names, len(rest))

    late_first = (F.col("kind") < LABEL).cast("long") - 2 * F.col("e")  # at equal e a question comes first
    return sorted_by(found, n, "client", late_first, F.xxhash64("a", "id")).mapInArrow(lean(run), longs(names))


def in_cells(crossing: DataFrame, windows: int, n: int, leaf: int) -> DataFrame:
    """Of the elements that in_leaves() leaves over: answers from other leaves within cells (asks = 1), and the sums of
    each leaf and cell (asks = 0), for clients that several cells hold."""
    sums = answer_columns(windows)
    own = ["client", "leaf", "e", "a", "kind", "id", "n", "t", "cents", *(f"i{i}" for i in range(windows))]
    names = ["asks", "crossing", "client", "leaf", "cell", "kind", "id", "n", "t", *sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table, before, after in chunks(batches, "client", leaf):
            t = arrays(table, own)
            query = t["kind"] >= LABEL
            rank = np.empty(len(query), np.int64)
            rank[np.lexsort((~query, t["leaf"]))] = np.arange(len(query))  # of a leaf, questions come first: it is done
            crossing = crossing_groups(t["client"], before, after).astype(np.int64)
            asks, got, w = answers(t, windows, rank, {"leaf": t["leaf"], "crossing": crossing})
            got |= {"t": t["t"][asks], "asks": np.ones(len(asks), np.int64), "cell": np.full(len(asks), number)}
            yield record(got, names, len(asks))
            rest = np.flatnonzero((crossing == 1) & ~query)
            if len(rest):
                click = t["kind"] <= PURCHASE
                ts, ids = np.where(click, t["e"], np.iinfo(np.int64).min), np.where(click, t["id"], np.iinfo(np.int64).min)
                rest = rest[np.lexsort((ids[rest], ts[rest], t["leaf"][rest], t["client"][rest]))]
                c, f = t["client"][rest], t["leaf"][rest]
                starts = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (f[1:] != f[:-1]))))
                ends = rest[np.append(starts[1:], len(rest)) - 1]
                total = np.add.reduceat(w[rest], starts, axis=0)
                out = {"client": c[starts], "leaf": f[starts]} | {x: total[:, i] for i, x in enumerate(sums[:-2])}
                out |= {"last_ts": np.ma.masked_array(ts[ends], ~click[ends]), "last_id": np.ma.masked_array(ids[ends], ~click[ends])}
                out |= {x: np.full(len(starts), v) for x, v in (("asks", 0), ("crossing", 1), ("cell", number))}
                yield record(out, names, len(starts))

    early_first = (F.col("kind") >= LABEL).cast("long") + 2 * F.col("a")  # at equal a points come first
    return sorted_by(crossing, n, "client", early_first, F.xxhash64("leaf", "id")).mapInArrow(lean(run), longs(names))


def between(cells: DataFrame, windows: int) -> DataFrame:
    """Answers between different leaves and cells for each (client, leaf, cell) that asks: rounds of left halves giving
    their sums to right halves, of the leaves' and of the cells' order at once. A pair of leaves differs first in one
    bit, and so does a pair of cells; so each pair meets in just one round and is joined by the number of its halves."""
    sums = answer_columns(windows)
    grid = cells.where("crossing = 1")
    axes = ("leaf", "cell")
    bits = grid.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in axes for f in (F.bit_or, F.bit_and))).first()
    rounds = {c: [b for b in range(63) if ((bits[f"bit_or_{c}"] or 0) & ~(bits[f"bit_and_{c}"] or 0)) >> b & 1] for c in axes}
    if not all(rounds.values()):
        rounds = {c: [0] for c in axes}

    def halves(df: DataFrame, side: int) -> DataFrame:
        for c in axes:
            own = F.array(*(F.when(F.getbit(F.col(c), F.lit(b)) == side, b) for b in rounds[c]))
            df = df.withColumn(f"{c}_round", F.explode(F.array_compact(own)))
            df = df.withColumn(f"{c}_block", F.call_function("shiftright", F.col(c), F.col(f"{c}_round") + 1))
        return df

    key = ["client", *(f"{c}_{x}" for c in axes for x in ("round", "block"))]
    latest = F.max(F.when(F.col("last_ts").isNotNull(), F.struct("last_ts", "last_id"))).alias("last")
    given = halves(grid.where("asks = 0"), 0).groupBy(*key).agg(*(F.sum(c).alias(c) for c in sums[:-2]), latest)
    asked = halves(grid.where("asks = 1").select("client", *axes).distinct(), 1)
    met = asked.join(given, key).groupBy("client", *axes).agg(*(F.sum(c).alias(c) for c in sums[:-2]), F.max("last").alias("last"))
    return met.select("client", *axes, *sums[:-2], "last.last_ts", "last.last_id")


def point_in_time(sales: DataFrame, clicks: DataFrame, lines: DataFrame, windows: Sequence[int] = (2, 14), horizon: int = 7, delay: int = 240, spread: int = 259_200, leaf: int = LEAF) -> DataFrame:
    """(sale_id, d, t_us, label, n_clicks, n_purchases, click_cents, last_click_id, n_sales, sale_cents, n_lines, n_items,
    line_cents): two rows, one for each window of d days, for every sale with a client and a time.

    t is sold_at and a shift of up to `spread` seconds by the CRC-32 of the sale's id (a null id: that of the empty text).
    Counted are the client's clicks (fully equal rows once; props are compared by MD5), sales and their lines that
    happened in (t - d days, t] and had arrived `delay` minutes before t, lines shipped by t; what has a null time or
    client counts nowhere. label: a sale in (t, t + horizon days]. Sums are of cents; null or not finite amounts are 0, and
    so are those from 1e15 on. Of equal latest clicks the largest id counts, null being
    the smallest. Repeated rows of sales count each and get rows each. Lines of null or unknown sales count
    nowhere, null items are no items. An empty table gives zeros, no sales no rows. Other columns play no part but in
    the equality of clicks. Work folders are in the shared folder.
    """
    spark, n, k = sales.sparkSession, n_parts(sales), len(windows)
    path = shared_dir(spark)
    found = write_elements(path, sales, clicks, lines, windows, horizon, delay, spread)
    with small_samples(spark):
        in_leaves(found, k, n, leaf).write.parquet(f"{path}/leaves")
        leaves = spark.read.parquet(f"{path}/leaves")
        in_cells(leaves.where("crossing = 1"), k, n, leaf).write.parquet(f"{path}/cells")
    cells = spark.read.parquet(f"{path}/cells")
    sums, who = answer_columns(k), ["client", "kind", "id", "n", "t"]
    asking = cells.where("asks = 1 and crossing = 1").select(*who, "leaf", "cell").unionByName(between(cells, k), allowMissingColumns=True)
    alike = Window.partitionBy("client", "leaf", "cell")  # one row with answers, and questions, of which a leaf's bounds the number
    far = asking.select(*who, *(F.max(c).over(alike).alias(c) for c in sums)).where("kind is not null")
    parts = leaves.where("asks = 1").select(*who, *sums).unionByName(cells.where("asks = 1").select(*who, *sums)).unionByName(far)
    of = lambda c, kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(c))), F.lit(0))
    names = [c for c in SUMS if c != "future"]
    window = [F.struct(F.lit(d).alias("d"), *(of(c, WINDOW + i).alias(c) for c in names), of(f"items{i}", WINDOW + i).alias("n_items"), F.max(F.when((F.col("kind") == WINDOW + i) & F.col("last_ts").isNotNull(), F.struct("last_ts", "last_id")))["last_id"].alias("last_click_id")) for i, d in enumerate(windows)]
    whole = parts.groupBy("client", "id", "t", "n").agg((of("future", LABEL) > 0).alias("label"), F.array(*window).alias("w"))
    copies = F.sequence(F.lit(1).cast("long"), F.abs("n"))
    rows = whole.select(F.when(F.col("n") > 0, F.col("id")).alias("id"), "t", "label", "w", F.explode(copies)).select("id", "t", "label", F.explode("w").alias("w"))
    out = ["n_clicks", "n_purchases", "click_cents", "last_click_id", "n_sales", "sale_cents", "n_lines", "n_items", "line_cents"]
    return rows.select(F.col("id").alias("sale_id"), F.col("w.d").cast("int").alias("d"), F.col("t").alias("t_us"), "label", *((F.nullif(F.col("w.last_click_id"), F.lit(NO_ID)) if c == "last_click_id" else F.col(f"w.{c}")).alias(c) for c in out))
