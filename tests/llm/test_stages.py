"""Stages of the pipeline on rows of null and repeated ids and clashing columns."""

from collections import Counter

import corpus_pipeline
from foliant.llm import mixing, queries, toxicity

LONG = " ".join(f"word{i}" for i in range(80))
ROWS = [
    (None, LONG, "a"), (5, LONG, "b"), (5, f"{LONG} tail", "c"), (3, LONG.replace("word40", "other"), "d"), (3, "a clean text that shares its id", "e"), (7, "same row", "f"), (7, "same row", "f"),
    (None, "no id twice", "g"), (None, "no id twice", "h"), (8, None, "i"), (8, None, "i"), (9, "", "j"),
]


def test_one_row_of_each_class_stays(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(3)
    got = corpus_pipeline.distinct(spark, docs, "")
    assert got.columns == docs.columns
    rows = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert rows == sorted([(3, ROWS[3][1]), (3, ROWS[4][1]), (7, "same row"), (None, "no id twice"), (8, None), (8, None), (9, "")], key=str)


def near(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").encode().split()) else set() for t in (a, b))
    return bool(a) and bool(b) and len(a & b) >= 0.8 * len(a | b) - 1e-9


def plain_distinct(rows):
    left, out = list(rows), []
    while left:
        group, size = [left.pop()], 0
        while size < len(group):
            same = [r for r in left if near(group[size]["text"], r["text"])]
            left = [r for r in left if not any(r is x for x in same)]
            group, size = group + same, size + 1
        out.append(min(group, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)))
    return out


def plain_unrepeated(rows):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        words = (r["text"] or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            key = tuple(words[p : p + 20])
            if key in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(key)
        text = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        out.append(r | {"text": text, "n_chars": len(text)})
    return out


def test_stages_against_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer

    block = " ".join(f"common{i}" for i in range(25))
    texts = [f"{block} " + " ".join(f"own{k}x{i}" for i in range(40 + k)) for k in range(12)] + [LONG, LONG, f"{LONG} tail", "you utter fool " * 3, None, None, "", "short é text"]
    clash = ("size", "taken", "target", "score", "predicted", "hits", "n_words", "n_removed", "kept_text", "n_links", "kept")
    data = [(None if k in (3, 14) else k, t, "abc"[k % 3], len(t or ""), *(f"{c}{k}" for c in clash)) for k, t in enumerate(texts)]
    labelled = [(1000 + k, ("you utter fool " * 3, "a fine day")[k % 2], "d", 0, *clash) for k in range(60)]
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash)
    docs = spark.createDataFrame(data + labelled, schema).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(1000 + k, 1 - k % 2) for k in range(60)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    model = toxicity.learn(docs, labels)
    flat = lambda rows: sorted((tuple(r[c] for c in docs.columns) for r in rows), key=str)

    want = [r for r in (x.asDict() for x in docs.collect()) if model.score(model.features(*model.hits(r["text"]))) < 0.5]
    assert 0 < len(want) < docs.count()
    got = docs
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:3], (lambda r: r, plain_distinct, plain_unrepeated), strict=True):
        want = plain(want)
        got = stage(spark, got, str(tmp_path))
        got = spark.createDataFrame(got.collect(), docs.schema)
        assert got.columns == docs.columns and flat(got.collect()) == flat(want), name

    taken = mixing.mix_sources(got).collect()
    mixed = corpus_pipeline.mixed(spark, got, str(tmp_path)).collect()
    words = Counter()
    source = {r["size"]: r for r in want}
    for r in mixed:
        words[r.source] += len(r.text.split())
        own = source[r.size]
        assert own["text"].split()[: len(r.text.split())] == r.text.split() and r.n_chars == len(r.text) and all(r[c] == own[c] for c in (*clash, "doc_id", "source"))
    assert words == Counter({s: sum(r.taken for r in taken if r.source == s) for s in {r.source for r in taken}}) + Counter()

    tokens = Tokenizer.from_file(queries.tokenizer_path())
    pieces = corpus_pipeline.packed(spark, spark.createDataFrame(mixed, docs.schema), str(tmp_path)).collect()
    assert sum(r.length for r in pieces) == sum(len(tokens.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    assert sum(r["length"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) > 0


def test_stages_on_an_empty_table(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([], "doc_id long, text string, source string, n_chars long, size string, score string")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0, name
        assert name == "packing" or out.columns == docs.columns


def test_very_long_texts_through_the_stages(spark, tmp_path):
    long = " ".join(f"w{i % 5003}x{i % 17}" for i in range(40_000))
    rows = [(1, long, "a"), (2, long + " end", "a"), (3, " ".join(reversed(long.split())), None), (4, "y" * 30_000, "b"), (5, "é " * 9_000, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.clean(spark, docs, str(tmp_path))
    assert kept.count() == 5
    one = corpus_pipeline.distinct(spark, kept, "")
    assert sorted(r.doc_id for r in one.collect()) == [1, 3, 4, 5]
    rest = {r.doc_id: len((r.text or "").split()) for r in corpus_pipeline.unrepeated(spark, one, "").collect()}
    assert rest[1] == 40_000 and rest[4] == 1 and rest[5] == 1
