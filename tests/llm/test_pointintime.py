"""Point-in-time features against every question asked of every row, with leaves of few rows."""

import random
import zlib
from datetime import datetime, timedelta

import numpy as np
import pytest

from foliant.llm import pointintime

BEGIN = datetime(2024, 1, 1)
SALES = "sale_id long, client_id long, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, label string"
CLICKS = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, client_id long, kind string, value double, props string"
LINES = "sale_id long, item_id long, amount double, shipped_at timestamp_ntz, d int"
OUT = ["sale_id", "d", "t_us", "label", "n_clicks", "n_purchases", "click_cents", "last_click_id", "n_sales", "sale_cents", "n_lines", "n_items", "line_cents"]


def cents(x):
    return 0 if x is None or not abs(x) < 1e15 else int(np.floor(100 * x + 0.5))


def brute(sales, clicks, lines, windows=(2, 14)):
    out, wait = [], timedelta(minutes=240)
    clicks = set(clicks)
    for sale, client, _, sold, *_ in sales:
        if client is None or sold is None:
            continue
        t = sold + timedelta(seconds=zlib.crc32(str("" if sale is None else sale).encode()) % 259_200)
        own = [s for s in sales if s[1] == client and s[3] is not None]
        label = any(t < s[3] <= t + timedelta(days=7) for s in own)
        for d in windows:
            inside = lambda e: e is not None and t - timedelta(days=d) < e <= t  # noqa: B023, E731
            c = [x for x in clicks if x[3] == client and inside(x[1]) and x[2] is not None and x[2] + wait <= t]
            s = [x for x in own if inside(x[3]) and x[4] is not None and x[4] + wait <= t]
            n = [x for y in s for x in lines if x[0] is not None and x[0] == y[0] and x[3] is not None and x[3] <= t]
            last = max(c, key=lambda x: (x[1], -1 if x[0] is None else x[0]), default=(None,))[0]
            us = (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)
            out.append((sale, d, us, label, len(c), sum(x[4] == "purchase" for x in c), sum(cents(x[5]) for x in c), last, len(s), sum(cents(x[2]) for x in s), len(n), len({x[1] for x in n} - {None}), sum(cents(x[2]) for x in n)))
    return sorted(out, key=str)


def shop(seed, n):
    rng = random.Random(seed)
    some = lambda x, p=0.05: None if rng.random() < p else x
    when = lambda: BEGIN + timedelta(seconds=rng.randrange(30 * 86_400), microseconds=rng.choice([0, 1, 999_999]))
    client = lambda: some(rng.choice([7, 7, 7, 1, 2, 3]))
    late = lambda t: t and some(t + timedelta(seconds=rng.choice([0, 60, 20_000, 300_000, 2_000_000])))
    sales = [(some(i, 0.02), client(), some(rng.choice([1.005, 2.5, float("nan"), 1e300])), t, late(t), "x") for i in range(n) for t in [some(when())]]
    sales += rng.choices(sales, k=n // 20)
    clicks = [(some(i), t, late(t), client(), some(rng.choice(["view", "purchase"])), some(rng.uniform(-5, 5)), some("{}")) for i in range(2 * n) for t in [some(when())]]
    clicks += rng.choices(clicks, k=n // 10) + [(0, BEGIN, BEGIN, 7, "view", 1.0, str(i)) for i in range(9)]
    known = [s for s in sales if s[3]]
    lines = [(s[0], some(rng.choice([5, 5, 5, 1, 2, 3])), some(rng.uniform(0, 9)), some(s[3] + timedelta(days=rng.choice([-1, 0, 1, 2, 13, 14]), seconds=rng.choice([-1, 0, 1])), 0.1), i) for i in range(3 * n) for s in [rng.choice(known)]]
    return sales, clicks, lines + rng.choices(lines, k=n // 10)


@pytest.mark.parametrize("leaf", [16, 300, 32_768])
def test_against_brute_force(spark, leaf):
    sales, clicks, lines = shop(leaf, 250)
    tables = (spark.createDataFrame(x, s) for x, s in ((sales, SALES), (clicks, CLICKS), (lines, LINES)))
    got = pointintime.point_in_time(*tables, leaf=leaf)
    assert got.columns == OUT
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(sales, clicks, lines)


def test_empty_tables_and_zones(spark):
    sales, clicks, lines = shop(1, 40)
    empty = [spark.createDataFrame([], s) for s in (SALES, CLICKS, LINES)]
    assert pointintime.point_in_time(*empty).count() == 0
    known = spark.createDataFrame(sales, SALES.replace("_ntz", ""))
    assert sorted((tuple(r) for r in pointintime.point_in_time(known, *empty[1:], windows=(1, 3, 9)).collect()), key=str) == brute(sales, [], [], (1, 3, 9))


def test_halving_against_all_pairs():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 37, 200):
        group = np.sort(rng.integers(0, 4, n))
        rank, query = rng.permutation(n), rng.random(n) < 0.4
        weights, last = rng.integers(0, 9, (n, 2)), np.where(rng.random(n) < 0.5, rng.integers(0, 99, n) % max(n, 1), -1)
        sums, best = pointintime.dominated(group, rank, query, weights, last)
        for q in np.flatnonzero(query):
            p = [i for i in range(q) if not query[i] and group[i] == group[q] and rank[i] < rank[q]]
            assert sums[q].tolist() == weights[p].sum(axis=0).tolist() and best[q] == max(last[p], default=-1)
