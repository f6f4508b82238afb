"""Every operator against brute force, on the small tables and on rows that are hard in some way."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.llm import components, embeddings, fingerprints, licenses, mixing, ngramjoin, packing, queries, substring, suffix, toxicity, urls

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))
HARD = [
    (1, None, "a"), (2, "", "a"), (3, "   \n\t ", None), (4, "one two three", "b"), (5, "one two three", "b"), (6, f"{PASSAGE} tail é ü 漢字", "a"), (7, f"head {PASSAGE}", "b"),
    (8, "x " * 500, "a"), (9, "y" * 3000, "a"), (10, LONG, "a"), (11, LONG, None), (12, f"{PASSAGE} {PASSAGE}", "c"), (13, "naïve\u00a0word", ""), (None, "no id", "a"), (14, "twice", "a"), (14, "twice", "a"),
]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(i, t, s, 7, "clash") for i, t, s in HARD], "doc_id long, text string, source string, n_words int, score string").repartition(3)


@pytest.fixture(scope="module")
def empty(hard):
    return hard.limit(0)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows(df):
    return [tuple(r) for r in df.collect()]


def brute_substring(texts, width=20):
    seen, out = set(), []
    for i, t in sorted(texts, key=lambda r: (r[0] is None, r[0])):
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - width + 1):
            key = tuple(words[p : p + width])
            if key in seen:
                gone[p : p + width] = [True] * width
            seen.add(key)
        out.append((i, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()))
    return out


@pytest.mark.parametrize("name", ["docs", "hard"])
def test_substring(name, request):
    df = request.getfixturevalue(name)
    got = rows(substring.dedup_substrings(df.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_text"))
    assert sorted(got, key=str) == sorted(brute_substring(rows(df.select("doc_id", "text"))), key=str)


def brute_suffix(texts, width=400):
    data = [(t or "").encode() for _, t in texts]
    count = Counter(d[p : p + width] for d in data for p in range(len(d) - width + 1))
    out = []
    for (i, _), d in zip(texts, data, strict=True):
        gone = bytearray(len(d))
        for p in range(len(d) - width + 1):
            if count[d[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        spans = sum(1 for p in range(len(d)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


def plain_suffix(texts, width=400, passage=300):
    """brute_suffix, and the bytes under repeated strings of `passage` bytes."""
    return [(*a, b[2]) for a, b in zip(brute_suffix(texts, width), brute_suffix(texts, passage), strict=True)]


def suffix_rows(df, **how):
    out = suffix.dedup_suffixes(df, **how).select("doc_id", "n_bytes", "n_removed", F.size("spans"), "kept", "n_passage")
    return sorted(((a, b, c, d, bytes(e), f) for a, b, c, d, e, f in rows(out)), key=str)


def test_suffix_hard(hard, empty):
    """Null, empty, repeated and very long texts."""
    some = hard.select("doc_id", F.when(F.col("doc_id").isin(10, 11), F.substring("text", 1, 150_000)).otherwise(F.col("text")).alias("text"))
    assert suffix_rows(some) == sorted(plain_suffix(rows(some)), key=str)
    assert suffix.dedup_suffixes(empty).count() == 0
    taken = suffix.dedup_suffixes(some.withColumn("n_passage", F.lit("mine")).withColumn("Kept", F.lit(1)))
    assert {"n_passage_in", "kept_in", "kept", "n_passage"} <= set(taken.columns)


def test_suffix_passages(spark):
    """Repeats of 299 to 401 bytes, in texts that end with them and in texts that don't."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh \u00e9") for _ in range(n)).encode()[:n].decode(errors="ignore").ljust(n, "x")[:n]
    data = []
    for k, n in enumerate((299, 300, 301, 350, 399, 400, 401)):
        same = "".join(rng.choice("abcdefgh ") for _ in range(n))
        data += [(4 * k, text(200) + same), (4 * k + 1, same + text(90)), (4 * k + 2, text(77) + same + text(501)), (4 * k + 3, same if k % 2 else None)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = suffix_rows(df)
    assert got == sorted(plain_suffix(data), key=str) and {r[0] for r in got if r[5] and not r[2]} >= {4, 5, 6}


@pytest.mark.parametrize("most", [1 << 20, 4000])
def test_suffix_hot_anchor(spark, monkeypatch, most):
    """A passage in every text, with other words around it each time; also where its anchors' regions pass the bytes of
    one array."""
    monkeypatch.setattr(suffix, "ARRAY_BYTES", most)
    passage = " ".join(f"common{i}" for i in range(60))
    data = [(k, " ".join(f"own{k}x{i}" for i in range(k % 9)) + passage + "".join(f" tail{k}y{i}" for i in range(k % 13))) for k in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert suffix_rows(df) == sorted(plain_suffix(data), key=str)


def test_suffix_documents(spark, sf, docs):
    got = rows(queries.op9_suffix_dedup(spark, sf))
    assert sorted(got) == sorted((i, n, r, s, hashlib.sha256(k).hexdigest(), p) for i, n, r, s, k, p in plain_suffix(rows(docs.select("doc_id", "text"))))


def test_suffix_array_and_prefixes():
    rng = random.Random(3)
    for _ in range(150):
        s = bytes(rng.randrange(97, 97 + rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(0, 60))) * rng.choice([1, 3])
        a = np.frombuffer(s, np.uint8)
        sa = suffix.suffix_array(a)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        if len(s) > 1:
            _, lcp = suffix.permuted_lcp(a, sa)
            for x, y in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True):
                n = 0
                while max(x, y) + n < len(s) and s[x + n] == s[y + n]:
                    n += 1
                assert lcp[y] == n
        width = rng.randint(2, 8)
        regions = [bytes(rng.choice(b"ab") for _ in range(rng.randint(width, 30))) for _ in range(5)]
        runs = np.array([len(r) - width + 1 for r in regions])
        for wide, flags in zip((width, width + 2), suffix.repeated(regions, runs, (width, width + 2)), strict=True):
            count = Counter(r[i : i + wide] for r in regions for i in range(len(r) - width + 1) if i + wide <= len(r))
            assert flags.tolist() == [i + wide <= len(r) and count[r[i : i + wide]] > 1 for r in regions for i in range(len(r) - width + 1)]
        leads = np.array([rng.randint(0, n - 1) for n in runs.tolist()])
        for wide, flags in zip((width, width + 2), suffix.repeated_by_offset(regions, runs, leads, (width, width + 2)), strict=True):
            keys = [(p - i, r[i : i + wide]) if i + wide <= len(r) and i <= p else None for r, p in zip(regions, leads.tolist(), strict=True) for i in range(len(r) - width + 1)]
            assert flags.tolist() == [k is not None and Counter(keys)[k] > 1 for k in keys]


def grams(text, n=5):
    w = (text or "").encode().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_links(sets, like):
    ids = list(range(len(sets)))
    near = [[j for j in ids if j != i and like(sets[i], sets[j])] for i in ids]
    root = ids[:]
    changed = True
    while changed:
        changed = False
        for i in ids:
            m = min([root[i], *(root[j] for j in near[i])])
            changed, root[i] = changed or m != root[i], m
    return near, root


def test_ngram_join(spark, sf, docs):
    texts = sorted(rows(docs.select("doc_id", "text")))
    base = [f"t{i}" for i in range(300)]
    for k in range(40):  # near copies around the threshold
        words = base[:]
        for p in random.Random(k).sample(range(300), 1 + k // 4):
            words[p] = f"new{k}"
        texts.append((100_000 + k, " ".join(words)))
    texts += [(200_000, None), (200_001, ""), (200_002, "short text"), (200_003, "short  text"), (200_004, LONG), (200_005, LONG + " end")]
    sets = [grams(t) for _, t in texts]
    near, root = brute_links(sets, lambda a, b: bool(a) and bool(b) and len(a & b) >= 0.8 * len(a | b) - 1e-9)
    want = {i: (texts[r][0], len(n), texts[r][0] == i) for (i, _), r, n in zip(texts, root, near, strict=True)}
    got = {r[0]: tuple(r[1:]) for r in rows(ngramjoin.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)))}
    assert got == want


def test_ngram_hard(hard, empty):
    got = {r.doc_id: r for r in ngramjoin.near_duplicates(hard).collect()}
    assert len(got) == len({r[0] for r in HARD}) and got[5].class_id == 4 and got[4].n_links == 1 and got[11].class_id == 10
    assert got[1].n_links == got[2].n_links == got[3].n_links == 0 and got[None].class_id is None
    assert ngramjoin.near_duplicates(empty).count() == 0


def test_bayes_bound():
    assert ngramjoin.least_matches(0.8, 1e-6, 16) == 4 or 0 < ngramjoin.least_matches(0.8, 1e-6, 16) < 8
    assert ngramjoin.least_matches(0.8, 1e-6, 96) > ngramjoin.least_matches(0.8, 1e-6, 32)


def test_embeddings(spark, sf):
    data = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    base = rng.standard_normal(64)
    data += [(1000 + k, [float(x) for x in base + rng.standard_normal(64) * 0.02 * k / 4], 3) for k in range(60)]
    data += [(2000 + k, data[0][1], data[0][2]) for k in range(5)]
    data += [(3000, None, 3), (3001, [0.0] * 64, 3), (3002, [float("nan")] + [1.0] * 63, 3), (3003, [None] + [1.0] * 63, 3), (3004, data[0][1], None), (3005, [1.0, 2.0], 3), (3006, [2.0, 4.0], 3), (3007, [float("inf")] * 64, 3), (3008, [], 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")
    data = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    data.sort()

    def unit(v):
        if not v or any(x is None for x in v):
            return None
        a = np.array(v, np.float64)
        return a / np.linalg.norm(a) if np.isfinite(a).all() and a.any() else None

    units = [(unit(v), lab) for _, v, lab in data]
    near, root = brute_links(units, lambda a, b: a[0] is not None and b[0] is not None and a[1] is not None and a[1] == b[1] and len(a[0]) == len(b[0]) and float(a[0] @ b[0]) >= 0.98)
    want = {i: (len(n), data[r][0], data[r][0] == i) for (i, _, _), r, n in zip(data, root, near, strict=True)}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.dedup_embeddings(df.withColumn("kept", F.lit(1))).collect()}
    assert got == want
    assert embeddings.dedup_embeddings(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    pairs += [(2000, 2000 + i) for i in range(1, 700)] + [(5000 + i, 4999) for i in range(400)] + [(5001, 2001)]  # stars
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for s in sorted(near):
        if s not in want:
            stack = [s]
            while stack:
                x = stack.pop()
                if x not in want:
                    want[x] = s
                    stack += near[x]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if k != v}


def test_mixing(spark, sf, docs, hard, empty):
    for df in (docs.select("doc_id", "text", "source"), hard):
        got = mixing.mix_sources(df).collect()
        texts = {}
        for r in got:
            texts.setdefault(r.source, []).append(r)
        names = sorted(texts, key=lambda s: (s is None, s or ""))
        sizes = {s: sum(r.size for r in texts[s]) for s in names}
        weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
        while open_:
            scale = left / sum(weights[s] for s in open_)
            over = {s for s in open_ if scale * weights[s] > 2 * sizes[s]}
            for s in over or open_:
                target[s] = 2.0 * sizes[s] if over else scale * weights[s]
                left -= target[s] if over else 0
            open_ = open_ - over if over else set()
        for s in names:
            assert all(r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 and 0 <= r.taken <= 2 * r.size for r in texts[s])
            assert abs(sum(r.taken for r in texts[s]) - target[s]) <= 1
    assert sorted(rows(queries.op1_mix_sources(spark, sf))) == sorted(rows(queries.op1_mix_sources(spark, sf)))
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len((r.text or "").encode().split()) for r in mixed.collect())
    assert words == sum(r.taken for r in mixing.mix_sources(docs).collect())


def test_overlapping_sources_flow(spark):
    flow = mixing.min_cost_flow([10, 20], [[0], [0, 1]], [25, 15], 2)
    assert sum(f.get(0, 0) for f in flow) == 25 and sum(f.get(1, 0) for f in flow) == 15
    assert all(sum(f.values()) <= 2 * c for f, c in zip(flow, (10, 20), strict=True))
    df = spark.createDataFrame([(i, "w " * (i % 7), [["a"], ["b", "a"], None, ["c"]][i % 4]) for i in range(200)], "doc_id long, text string, source array<string>")
    got = mixing.mix_sources(df).collect()
    assert len(got) == 200 and all(0 <= r.taken <= 2 * r.size for r in got)


def test_mix_keeps_sources_apart(spark):
    """A source may be any text, separators too; patterns of several sources are told apart by their members."""
    odd = [None, "\x1e", "\x1f", "", "a\x1fb", "a"]
    got = mixing.mix_sources(spark.createDataFrame([(i, "one two", s) for i, s in enumerate(odd)], "doc_id long, text string, source string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(6)) and {r.source_size for r in got} == {2}
    many = [["a\x1fb"], ["a", "b"], ["b", "a"], None, [], [None], ["\x1e"]]
    got = mixing.mix_sources(spark.createDataFrame([(i, "one two three", s) for i, s in enumerate(many)], "doc_id long, text string, source array<string>")).collect()
    assert sorted((r.doc_id, r.source_size) for r in got) == [(0, 3), (1, 6), (2, 6), (3, 9), (4, 9), (5, 9), (6, 3)]


def plain_url(url, listed):
    """(host, path, verdict without rules) by plain Python."""
    if url is None or "://" not in url:
        return "", "", "allow"
    rest = url.split("://", 1)[1]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.match("[^/?#]*", rest, re.DOTALL)[0])
    path = re.match("[^?#]*", rest[len(host) :], re.DOTALL)[0]
    bare = re.sub(":[0-9]*$", "", host.rsplit("@", 1)[-1]).removeprefix("www.")
    page = bare + (path[:-5] if path.endswith(".html") else path[:-1] if path.endswith("/") else path)
    labels = bare.split(".")
    keys = {page} | {".".join(labels[-n:]) + "/" for n in range(1, len(labels) + 1)} if host else set()
    return host, path, "block" if keys & listed else "allow"


def plain_rule(host, path):
    fits = [(len(h + p), h + p, what) for what, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_urls(spark, sf, monkeypatch, most):
    """Broadcast, and joined by key."""
    monkeypatch.setattr(urls, "BROADCAST_BYTES", most)
    odd = [(1, None), (2, "no scheme"), (3, "HTTP://Www.Example.NET/en/x?q#f"), (4, "http://net"), (5, "http://a.org/fr/1"), (6, "http://xnet/"), (7, "https://bad.host/page.html"), (8, "http://www.bad.host/page/"), (9, "a://b.example.com/de/?"), (10, ""), (11, "x://y?z"), (7, "https://bad.host/page.html"), (12, "http://a.b.worse.com/x"), (13, "http://www.worse.com"), (14, "http://notworse.com/"), (15, "http://x.y?u=http://worse.com/" + "z" * 40_000), (16, "://worse.com/")]
    odd += [(20 + i, f"http://{u}/p") for i, u in enumerate(["a.b.c.d.e.deep.com", "x.a.b.c.d.e.deep.com", "b.c.d.e.deep.com", "localhost", "x.localhost", "mylocalhost", "worse.com:8080", "u:p@worse.com", "u@www.worse.com:1", "worse.com:80@fine.org", ".".join("abcdefgh" * 9) + ".worse.com", "it's.com"])]
    data = odd + [(100 + r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in data], "page_id long, url string, host string")
    entries = ["http://bad.host/page", None, "worse.com/", "www.worse.com/", "a.b.c.d.e.deep.com/", "localhost/", "http://it's.com:80/", *queries.listed_urls()]
    listed = {"bad.host/page", "worse.com/", "a.b.c.d.e.deep.com/", "localhost/", "it's.com/", *queries.listed_urls()}
    got = urls.filter_urls(pages, spark.createDataFrame([(u,) for u in entries], "url string"))
    want = []
    for i, u in data:
        host, path, verdict = plain_url(u, listed)
        rule, own = plain_rule(host, path)
        want.append((i, host, path, rule, own or verdict))
    assert "host_in" in got.columns and sorted(map(str, rows(got.select("page_id", "host", "path", "rule", "verdict")))) == sorted(map(str, want))
    assert urls.filter_urls(pages.limit(0), pages).count() == 0 and urls.filter_urls(pages, pages.limit(0)).where("listed").count() == 0
    assert {v for *_, v in rows(queries.op2_url_filter(spark, sf))} == {"allow", "block"}


def brute_licenses(text):
    words = licenses.words_of(text)
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = licenses.words_of(phrase)
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    best = {}
    for label, t in licenses.read_templates().items():
        tokens, n = set(licenses.words_of(t)), len(licenses.words_of(t))
        for i in range(max(1, len(words) - n + 1)):
            best[label] = max(best.get(label, 0), len(tokens & set(words[i : i + n])) / len(tokens))
    found = {k: v for k, v in best.items() if v >= 0.8}
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | set(found))), 1.0 if places else max(found.values(), default=0.0)


def test_licenses(spark, docs, hard):
    extra = [(90_000, "CC BY cc-by, cc by"), (90_001, "All rights  reserved. the MIT license released under"), (90_002, "general public"), (90_003, "Redistribution and use in source or binary forms, with modification are permitted")]
    for k, t in enumerate(licenses.read_templates().values()):
        changed = " ".join(w for i, w in enumerate(t.split()) if i % 9)
        extra += [(91_000 + k, f"before it {t} and after"), (92_000 + k, f"{'some words ' * 90}{changed}"), (93_000 + k, t[: len(t) // 2]), (94_000 + k, " ".join(sorted(t.split())))]
    for df in (docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string")), hard.where("doc_id not in (10, 11)")):
        got = licenses.scan_licenses(df).collect()
        assert len(got) == df.count()
        for r in got:
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == brute_licenses(r.text), r.text


def test_license_filters():
    """Each filter rejects blocks, and what they leave is what counting every block finds."""
    rng = random.Random(3)
    templates = {f"t{k}": " ".join(rng.sample([f"w{i}" for i in range(60)], 12)) for k in range(6)}
    match = licenses.Matcher(templates, 0.8, {f"w{i}": i // 3 for i in range(60)})
    for _ in range(400):
        words = [f"w{rng.randrange(60)}".encode() for _ in range(rng.randrange(0, 60))]
        if rng.random() < 0.5:
            near = licenses.words_of(rng.choice(list(templates.values())))
            near[rng.randrange(12)] = b"other"
            words[5:5] = near
        got = {b[0]: b[3] for b in match(words, set(words))}
        want = {}
        for label, t in templates.items():
            tokens = set(licenses.words_of(t))
            best = max(len(tokens & set(words[i : i + 12])) / 12 for i in range(max(1, len(words) - 11)))
            if best >= 0.8:
                want[label] = best
        assert got.keys() == want.keys() and all(got[k] <= want[k] for k in got)
    assert min(match.rejected[k] for k in ("text", "length", "position", "count")) > 50


def test_packing(spark, docs, hard, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok = Tokenizer.from_file(path)
    odd = spark.createDataFrame([(70_000, "It's I'll <|endoftext|> a.b, c!! 12,5 ÀÉ ΑΣ. x\u00a0y e\u0301 İst don't 'tis THE. \u0301a"), (70_001, "")], "doc_id long, text string")
    for df in (docs.select("doc_id", "text").unionByName(odd), hard.where("doc_id is null or doc_id <> 14").select("doc_id", "text")):
        texts, pieces, seqs = dict(rows(df)), {}, {}
        for r in packing.pack_documents(df, path).collect():
            pieces.setdefault(r.doc_id, []).append(r)
            seqs.setdefault(r.sequence_id, []).append(r)
            assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        assert pieces.keys() == texts.keys()
        for i, ps in pieces.items():
            ids = np.array(tok.encode(texts[i] or "", add_special_tokens=False).ids + [1], "<u4")
            ps.sort(key=lambda r: r.start)
            assert b"".join(bytes(r.ids) for r in ps) == ids.tobytes() and all(r.doc_tokens == len(ids) for r in ps)
            assert [r.start for r in ps] == [sum(q.length for q in ps[:k]) for k in range(len(ps))]
        for ps in seqs.values():
            ps.sort(key=lambda r: r.offset)
            n = sum(r.length for r in ps)
            assert [r.offset for r in ps] == [sum(q.length for q in ps[:k]) for k in range(len(ps))] and (n == 2048 or n < 2048 and n & (n - 1) == 0)
    assert packing.pack_documents(empty, path).count() == 0


def test_packing_with_other_tokenizers(spark, hard):
    """Ids of a tokenizer whose words hold their leading space."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, pieces = Tokenizer.from_file(path), {}
    some = hard.where("doc_id not in (10, 14)")
    assert not packing.WordIds(path).by_words and packing.WordIds(queries.tokenizer_path()).by_words
    for r in packing.pack_documents(some, path, end_id=50256).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    assert {i: b"".join(x for _, x in sorted(ps)) for i, ps in pieces.items()} == {r.doc_id: np.array([*tok.encode(r.text or "").ids, 50256], "<u4").tobytes() for r in some.collect()}
    assert "ids" not in packing.pack_documents(some, path, with_ids=False).columns


def test_fingerprints(spark, sf, docs):
    got = {r.doc_id: r for r in queries.op10_fingerprints(spark, sf).collect()}
    texts = sorted(rows(docs.select("doc_id", "text")))
    by_text = {}
    errors = []
    for k, (i, t) in enumerate(texts):
        t, nxt = t or "", texts[(k + 1) % len(texts)][1] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        for other, near in ((edited, r.near_edited), (nxt, r.near_next)):
            a, b = grams(t), grams(other)
            errors.append(abs(near - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert np.mean(errors) < 0.03 and max(errors) < 0.3


def test_next_rows(spark, hard, empty, monkeypatch):
    """Null ids come first, equal ids by their text's hash, and the first row follows the last; ids that lie unevenly, and
    ids and null ids that many rows have."""
    rng = random.Random(6)
    many = [(rng.choice([None, 7, 7, rng.randrange(20), 10**15 + rng.randrange(10**6), -(10**12)]), f"text {rng.randrange(400)}") for _ in range(3000)]
    hash_of = {(r.t or ""): r.h for r in spark.createDataFrame([(t,) for t in {t for _, t in many} | {r[1] for r in HARD}], "t string").select("t", F.shiftrightunsigned(F.xxhash64(F.coalesce("t", F.lit(""))), 1).alias("h")).collect()}
    for df, data in ((hard, [(r[0], r[1]) for r in HARD]), (spark.createDataFrame(many, "doc_id long, text string").repartition(4), many)):
        order = sorted(((i, t or "") for i, t in data), key=lambda r: (r[0] is not None, r[0] or 0, hash_of[r[1]], r[1]))
        want = sorted((str(r[0]), r[1], order[(k + 1) % len(order)][1]) for k, r in enumerate(order))
        for size, cells in ((3, 8), (500, 2)):
            monkeypatch.setattr(fingerprints, "CELLS", cells)
            got = fingerprints.with_next(df, "doc_id", "text", fingerprints.fingerprint_documents if df is hard else lambda d: d, ("sketch",) if df is hard else (), size).collect()
            assert sorted((str(r.doc_id), r.text or "", r.next_text) for r in got) == want
            if df is hard:
                sketches = {r.text or "": r.sketch for r in got}
                assert all(r.next_sketch == sketches[r.next_text] for r in got)
    assert fingerprints.with_next(empty, "doc_id", "text").count() == 0
    clash = fingerprints.with_next(hard.withColumn("next_text", F.lit(5)), "doc_id", "text")
    assert clash.columns.count("next_text") == 1 and "next_text_in" in clash.columns
    coded = fingerprints.range_codes(spark.createDataFrame([(i if i % 3 else None, i << 40) for i in range(3000)], "doc_id long, h long").withColumn("h", F.shiftrightunsigned(F.xxhash64("h"), 1)), "doc_id", "h", 50)
    assert coded.groupBy("__range").count().agg(F.max("count")).first()[0] < 150


def test_sketches_merge(spark):
    text = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(0, text), (1, " ".join(text.split()[:300])), (2, None), (3, "a b")], "id long, text string")
    got = {r.id: r for r in fingerprints.fingerprint_documents(df, k=64).collect()}
    assert got[2].sketch == [] and got[2].n_shingles == 0 and got[3].n_shingles == 1 and abs(got[0].n_shingles - 396) < 150
    both = fingerprints.fingerprint_documents(df).where("id < 2").select(F.lit(1).alias("g"), "sketch")
    assert fingerprints.merged_sketch(both, ["g"]).first().sketch == got[0].sketch
    pair = spark.createDataFrame([(got[1].sketch, got[0].sketch)], "a array<long>, b array<long>")
    assert pair.select(fingerprints.containment(F.col("a"), F.col("b"))).first()[0] > 0.75


def test_levenshtein():
    def edit(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(4)
    terms = ["".join(rng.choice("abc") for _ in range(rng.choice([4, 5, 6, 7, 10, 11, 13]))) for _ in range(40)]
    trie, pair = toxicity.Trie(terms), toxicity.tries(frozenset(terms))
    for k in range(3000):
        w = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 14)))
        if k % 2:
            w = rng.choice(terms)
            for _ in range(rng.randint(0, 3)):
                p = rng.randrange(len(w) + 1)
                w = w[:p] + rng.choice(["", "a", "d"]) + w[p + rng.randint(0, 1) :]
        near = sorted((e, t) for t in terms if (e := edit(w, t)) <= (2 if len(t) >= 10 else 1))
        assert trie.matches(w) == (near[0][1] if near else None), w
        got = pair[0].matches(w) or pair[1].matches(w)
        assert (got in [t for _, t in near]) if near else got is None
    assert toxicity.Trie([]).matches("word") is None
    many = list({"".join(rng.choice("abcd\u00e9\u6f22") for _ in range(rng.randint(0, 16))) for _ in range(2000)})
    assert trie.match_all(many) == {w: t for w in many if (t := trie.matches(w))}


def test_toxicity(spark, sf, docs, hard, empty):
    got = {r.doc_id: r for r in queries.op7_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [(got[r.doc_id].score, r.toxic) for r in labels if got[r.doc_id].held_out]
    bad, fine = ([s for s, y in held if y == k] for k in (1, 0))
    auc = np.mean([(a > b) + (a == b) / 2 for a in bad for b in fine])
    caught, left = np.mean([s >= 0.5 for s in bad]), np.mean([s < 0.5 for s in fine])
    print("held out", len(bad), len(fine), "AUC", auc, "caught", caught, "left alone", left)
    assert len(bad) > 30 and auc > 0.95 and caught > 0.8 and left > 0.97
    model = toxicity.fit(["you utter fool " * 3, "a fine day", None] * 20, [1, 0, 0] * 20)
    out = {r.doc_id: r for r in toxicity.score_toxicity(hard.unionByName(hard.limit(1).withColumn("text", F.lit("you uter fol")).withColumn("doc_id", F.lit(99).cast("long"))), model).collect()}
    assert {h.kind for h in out[99].hits} >= {"misspelt"} and 0 <= out[1].score < 0.5
    assert toxicity.score_toxicity(empty, toxicity.learn(empty, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


def test_pipeline(spark, sf, docs):
    import corpus_pipeline

    df = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, df, sf)
        assert new.columns == df.columns
        df = spark.createDataFrame(new.collect(), df.schema)
    assert df.count() > 50 and corpus_pipeline.run(spark, sf).agg(F.sum("length")).first()[0] > 1000


KEYS = ["id", "rep", "class_id", "n_links", "kept", "f1", "sig", "root", "key", "w", "node"]


@pytest.mark.parametrize("key", KEYS)
def test_near_duplicates_with_any_key(spark, key):
    df = spark.createDataFrame([(3, "a b c d e f"), (1, "a b c d e f"), (2, "x y")], f"{key} long, text string")
    name = key + "_in" if key in ("class_id", "n_links", "kept") else key
    got = ngramjoin.near_duplicates(df, key)
    assert got.columns == [name, "class_id", "n_links", "kept"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1, True), (2, 2, 0, True), (3, 1, 1, False)]


@pytest.mark.parametrize("key", ["n_links", "component_id", "kept", "node", "id"])
def test_dedup_embeddings_with_any_key(spark, key):
    df = spark.createDataFrame([(3, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [2.0, -1.0], 1)], f"{key} long, embedding array<double>, label int")
    got = embeddings.dedup_embeddings(df, key).drop("embedding", "label")
    name = key + "_in" if key in ("class_id", "n_links", "component_id", "kept") else key
    assert got.columns == [name, "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False)]


@pytest.mark.parametrize("key", ["start", "length", "ids", "sequence_id", "doc"])
def test_pack_with_any_key(spark, key):
    df = spark.createDataFrame([(7, "some words"), (8, None)], f"{key} long, text string")
    got = packing.pack_documents(df, queries.tokenizer_path(), key)
    name = key + "_in" if key != "doc" else key
    assert got.columns[0] == name and len(set(got.columns)) == len(got.columns)
    assert {(r[name], r["doc_tokens"]) for r in got.collect()} == {(7, 3), (8, 1)}
