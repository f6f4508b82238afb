"""Mixing sources to target weights as a min-cost flow.

Documents are aggregated by their membership pattern (the set of sources that hold them). Token capacity flows from
patterns to source quotas; reading a pattern once costs nothing, each further epoch costs more (convex repetition
cost), so the flow repeats text only where quotas force it. Patterns and sources are few; the flow is solved on the
driver, and the documents are then selected in a seeded order by cumulative size, without gathering any source.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.shards import checkpoint, free_names, own_columns

#: Least bins of the seeded order for cumulative sizes, and rows of a bin beyond which there are more: only documents of
#: one bin of a pattern are ever ordered one by one.
BINS, ROWS_A_BIN = 4096, 4096
#: Most membership patterns that the flow takes.
MOST_PATTERNS = 20_000
WORDS = r"[^\x20\x09-\x0D]+"


def quotas(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Split share * sum(sizes) by weight; none gets over most * its size, and the excess goes to the others by weight."""
    cap = [most * s for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: cap[i] / weights[i])
    left, weight, out = share * sum(sizes), sum(weights), [0.0] * len(sizes)
    spent = 0.0
    for at, i in enumerate(order):
        if cap[i] * weight > (left - spent) * weights[i]:
            for j in order[at:]:
                out[j] = (left - spent) * weights[j] / weight
            break
        out[i] = cap[i]
        spent += cap[i]
        weight -= weights[i]
    return out


def min_cost_flow(capacity: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int], epochs: int) -> list[dict[int, int]]:
    """Words that each pattern gives each of its sources. Epoch e of a pattern costs e a word; successive shortest
    augmenting paths, so the total cost is least for the flow that meets the quotas as far as the capacities go."""
    n, m = len(capacity), len(quota)
    source, sink = n + m, n + m + 1
    graph: list[list[list[int]]] = [[] for _ in range(n + m + 2)]

    def arc(a: int, b: int, cap: int, price: int) -> None:
        graph[a].append([b, cap, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for p, c in enumerate(capacity):
        for e in range(epochs):
            arc(source, p, c, e)
        for s in members[p]:
            arc(p, n + s, c * epochs, 0)
    for s, q in enumerate(quota):
        arc(n + s, sink, q, 0)
    potential = [0] * len(graph)
    while True:
        far: list[float] = [float("inf")] * len(graph)
        back: list[tuple[int, int]] = [(-1, -1)] * len(graph)
        far[source], heap = 0, [(0.0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for k, (v, cap, price, _) in enumerate(graph[u]):
                if cap and (x := d + price + potential[u] - potential[v]) < far[v]:
                    far[v], back[v] = x, (u, k)
                    heapq.heappush(heap, (x, v))
        if far[sink] == float("inf"):
            break
        for v, d in enumerate(far):
            if d < float("inf"):
                potential[v] += int(d)
        push, v = float("inf"), sink
        while v != source:
            u, k = back[v]
            push, v = min(push, graph[u][k][1]), u
        v = sink
        while v != source:
            u, k = back[v]
            graph[u][k][1] -= push
            graph[v][graph[u][k][3]][1] += push
            v = u
    return [{a[0] - n: graph[a[0]][a[3]][1] for a in graph[p] if n <= a[0] < n + m and graph[a[0]][a[3]][1]} for p in range(n)]


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 20240501) -> DataFrame:
    """Every column of docs, with size (words), source_size, target (of the row's first source) and taken.

    source_col is a string, or an array of strings for documents that several sources hold; null, or an empty array,
    is a source of its own, which comes last. Sources take weights in code-point order, repeating. A document's taken
    words are whole epochs of it and, for one document at each boundary, its first words. Rows are ordered by a hash
    of seed and id (ties by id and size); rows with equal ids are separate. Empty texts have size 0 and taken 0.
    """
    docs = free_names(docs, "size", "source_size", "target", "taken")
    spark, kind = docs.sparkSession, dict(docs.dtypes)[source_col]
    single = kind == "string"
    members = F.when(F.col(source_col).isNull(), F.array(F.lit(None).cast("string"))).otherwise(F.array(source_col)) if single else F.when(F.coalesce(F.size(source_col), F.lit(0)) < 1, F.array(F.lit(None).cast("string"))).otherwise(F.array_sort(F.array_distinct(source_col)))
    extra = [c for c in docs.columns if c not in (id_col, source_col, text_col)]
    rows = docs.select("*", members.alias("__p"), F.coalesce(F.regexp_count(text_col, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("")))
    rows = rows.withColumn("__h", F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"))
    if text_col not in (id_col, source_col) and not extra:
        rows = checkpoint(rows.drop(text_col))  # words are counted once
    counted = rows.groupBy("__p").agg(F.sum("size").alias("n"), F.count("*").alias("k")).limit(MOST_PATTERNS + 1).collect()
    by_pattern = {tuple(r["__p"]): r.n for r in counted}
    bins_in_all = max(BINS, 1 << (sum(r.k for r in counted) // ROWS_A_BIN).bit_length())
    if len(by_pattern) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    patterns = sorted(by_pattern, key=lambda p: [(x is None, x or "") for x in p])
    names = sorted({x for p in patterns for x in p}, key=lambda x: (x is None, x or ""))
    sizes = [sum(n for p, n in by_pattern.items() if x in p) for x in names]
    total_weights = [weights[i % len(weights)] for i in range(len(names))]
    scale = sum(by_pattern.values()) / (sum(sizes) or 1)
    target = quotas(sizes, total_weights, share * scale, most) if names else []
    flow = min_cost_flow([by_pattern[p] for p in patterns], [[names.index(x) for x in p] for p in patterns], [round(t) for t in target], most)
    plan = [(list(p), k, int(sizes[names.index(p[0])]), float(target[names.index(p[0])]), by_pattern[p], sum(flow[k].values())) for k, p in enumerate(patterns)]
    table = spark.createDataFrame(plan, "__p array<string>, __k int, source_size long, target double, __cap long, __flow long")
    # bounded by MOST_PATTERNS rows; null sources are equal within arrays
    span = (1 << 48) // bins_in_all
    rows = rows.join(F.broadcast(table), "__p").withColumn("__bin", F.floor(F.col("__h") / span))
    bins = rows.groupBy("__k", "__bin").agg(F.sum("size").alias("__n"), F.max(F.when(F.col("__cap") > 0, F.col("__flow") % F.col("__cap")).otherwise(0)).alias("__rest"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__k").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = bins.select("__k", "__bin", "__n", "__rest", before.alias("__before")).where("__rest > __before and __rest < __before + __n").select("__k", F.col("__bin").alias("__edge"), (F.col("__rest") - F.col("__before")).alias("__room"))
    # one bin a pattern is ordered row by row
    rows = rows.join(F.broadcast(edges), "__k", "left")
    rest = F.when(F.col("__cap") > 0, F.col("__flow") % F.col("__cap")).otherwise(0)
    epochs = F.when(F.col("__cap") > 0, F.floor(F.col("__flow") / F.col("__cap"))).otherwise(0)
    inner = rows.where("__bin = __edge")
    so_far = F.coalesce(F.sum("size").over(Window.partitionBy("__k", "__bin").orderBy("__h", id_col, "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = inner.withColumn("__part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("__room") - so_far)))
    outer = rows.where("__edge is null or __bin <> __edge")
    whole = bins.select("__k", "__bin", (before + F.col("__n")).alias("__end"))
    last = whole.join(F.broadcast(table.select("__k", (F.when(F.col("__cap") > 0, F.col("__flow") % F.col("__cap")).otherwise(0)).alias("__r"))), "__k").where("__end <= __r").groupBy("__k").agg(F.max("__bin").alias("__last"))
    outer = outer.join(F.broadcast(last), "__k", "left").withColumn("__part", F.when((rest > 0) & (F.col("__bin") <= F.coalesce("__last", F.lit(-1))), F.col("size")).otherwise(F.lit(0)))
    both = inner.unionByName(outer.drop("__last"))
    keep = [c for c in docs.columns if c in both.columns]
    return both.select(*keep, "size", "source_size", "target", (F.col("size") * epochs + F.col("__part")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, the last time perhaps with its first words only. Columns of
    docs; n_chars, where there is one, follows the text. Rows of which nothing is taken go."""
    names = own_columns(docs, "size", "source_size", "target", "taken")
    mixed = mix_sources(docs, id_col, text_col, source_col, **options).where("taken > 0")
    copies = mixed.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")).cast("int"))))
    words = F.least(F.col("size"), F.col("taken") - F.col("__copy") * F.col("size"))
    cut = F.array_join(F.slice(F.filter(F.split(text_col, r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, words.cast("int")), " ")
    out = copies.withColumn(text_col, F.when(words < F.col("size"), cut).otherwise(F.col(text_col)))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length(text_col).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*names.values())
