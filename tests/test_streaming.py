"""Keyed recency state across restarts, expiry, and micro-batches that come again or die before their commit."""

import random

import pytest

from foliant.operators import cache
from foliant.streaming import recency

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def run(spark, folder, **how):
    query = recency.keep_cache(spark.readStream.schema(recency.ACCESS).option("maxFilesPerTrigger", 1).json(f"{folder}/in"), f"{folder}/table", f"{folder}/checkpoint", **how)
    query.awaitTermination()
    return sorted(tuple(r) for r in recency.Committed(spark, f"{folder}/table", recency.CACHE).table().collect())


def put(spark, folder, rows):
    spark.createDataFrame(rows, recency.ACCESS).coalesce(1).write.mode("append").json(f"{folder}/in")


def plain(table, rows, most=None):
    """The cache after a batch, by the batch operators' rules: puts begin anew, gets of known keys count."""
    table = dict(table)
    for key, at, size in sorted((r for r in rows if r[0] and r[1] is not None), key=lambda r: (r[1], r[2] is None, r[2] or 0)):
        if size is not None:
            table[key] = (at, 0, at, size)
        elif key in table:
            c, n, last, s = table[key]
            table[key] = (c, n + 1, max(last, at), s)
    if most is not None and sum(e[3] for e in table.values()) > most:
        for key, _ in sorted(table.items(), key=lambda e: (e[1][2], e[1][1], e[0])):
            if sum(e[3] for e in table.values()) <= 0.8 * most:
                break
            del table[key]
    return table


@pytest.mark.parametrize("most", [None, 400])
def test_batches_with_a_restart_between(rocks, tmp_path, most):
    rng, known, at = random.Random(8), {}, 0.0
    for _ in range(3):  # each run is a restart on the checkpoint of the one before
        rows = []
        for _ in range(40):
            at += rng.choice([0.5, 1.0])
            rows.append((f"k{rng.randrange(12)}", at, rng.choice([None, None, 30, 50])))
        put(rocks, tmp_path, [*rows, (None, at, 5), ("k1", None, None)])
        known = plain(known, rows, most)
        assert run(rocks, tmp_path, most=most) == sorted((k, *e) for k, e in known.items())
    if most is None:
        batch = rocks.createDataFrame([(k, b"x", *e) for k, e in known.items()], cache.SCHEMA.replace("created_at double, access_count bigint, last_accessed double", "created_at double, access_count bigint, last_accessed double"))
        assert cache.totals(batch).first().entries == len(known)


def test_entries_expire_by_timer(rocks, tmp_path):
    put(rocks, tmp_path, [("a", 1000.0, 7), ("b", 1000.0, 7), ("a", 1050.0, None)])
    assert [r[0] for r in run(rocks, tmp_path, keep=100.0)] == ["a", "b"]
    put(rocks, tmp_path, [("c", 1170.0, 7)])  # the watermark passes b's timer at 1,100, not a's at 1,150
    assert [r[0] for r in run(rocks, tmp_path, keep=100.0)] == ["a", "c"]
    put(rocks, tmp_path, [("b", 1175.0, None), ("d", 1400.0, 7)])  # a get of what is gone brings nothing back
    assert [r[0] for r in run(rocks, tmp_path, keep=100.0)] == ["d"]


def test_a_batch_counts_once(spark, tmp_path):
    store = recency.Committed(spark, str(tmp_path / "t"), "n long")
    add = lambda k: lambda table: table.unionByName(spark.createDataFrame([(k,)], "n long"))
    rows = lambda: sorted(r.n for r in store.table().collect())
    assert rows() == [] and store.apply(0, add(5)) and not store.apply(0, add(5)) and rows() == [5]

    class Killed(Exception):
        pass

    def die(batch_id):
        raise Killed

    store.commit = die
    with pytest.raises(Killed):
        store.apply(1, add(6))  # written, not committed
    again = recency.Committed(spark, str(tmp_path / "t"), "n long")
    assert sorted(r.n for r in again.table().collect()) == [5] and again.committed() == [0]
    assert again.apply(1, add(7)) and not again.apply(1, add(8))
    assert sorted(r.n for r in again.table().collect()) == [5, 7]
    again.apply(2, add(9))
    again.forget(1)
    assert sorted(r.n for r in again.table().collect()) == [5, 7, 9] and again.committed() == [0, 1, 2]
