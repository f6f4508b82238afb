"""Misspellings inside a stem that many toxic words start with."""

import pickle
import zlib

from foliant.llm import toxicity

ENDINGS = ("t", "ts", "tic", "cy", "tically", "ism", "tish", "ted", "tness")
TYPOS = ("1diot", "idot", "xidiot", "idiiot", "odiotic", "1diotness")


def test_misspelt_stems():
    texts, labels = [], []
    for i in range(30):
        texts += [f"what an idio{e} you are, number {i}" for e in ENDINGS] + [f"a fine day {i} in the garden" for _ in ENDINGS]
        labels += [1] * len(ENDINGS) + [0] * len(ENDINGS)
    model = toxicity.fit(texts, labels)
    assert any("idiot".startswith(s) for s in model.stems) and not any(t.startswith("idio") for t in model.terms)
    for m in (model, pickle.loads(pickle.dumps(model))):
        for w in TYPOS:
            hits, _ = m.hits(f"so {w} here")
            assert [(h[0], h[2]) for h in hits] == [(w, "misspelt")], w
        assert [h[2] for h in m.hits("so idioteque here")[0]] == ["stem"] and not m.hits("a fine garden")[0]


def test_rare_terms_among_many_labels(spark):
    """A term in 9 of more than 2,500 toxic documents is learnt."""
    toxic = [i for i in range(3_400) if zlib.crc32(str(i).encode()) % 5]
    rare = set(toxic[:: len(toxic) // 9][:9])
    rows = [(i, 1, "zorgle stuff" if i in rare else "utter fool") for i in range(3_400)] + [(i, 0, "fine day") for i in range(3_400, 10_400)]
    df = spark.createDataFrame(rows, "doc_id long, toxic int, text string")
    model = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert len(toxic) > 2_500 and {"zorgle", "fool"} <= model.terms
