"""Commands of single stages, and the bench of stages."""

import json

import pandas as pd

from foliant import cli


def shout(prompts: pd.Series, ids: pd.Series) -> pd.Series:
    return "seen " + ids


def test_stage_commands(spark, tmp_path, capsys):
    path = lambda p: str(tmp_path / p)
    html = "<h1>Title here</h1><p>the cat and the dog</p><table><tr><td>1</td></tr></table>"
    spark.createDataFrame([(0, html), (1, "<p>le chat et les chiens</p>"), (2, None)], "page_id long, html string").write.parquet(path("pages"))
    run = lambda *a: (cli.main([*a], spark), json.loads(capsys.readouterr().out or "null"))
    code, said = run("layout", path("pages"), "--out", path("layout"))
    rows = spark.read.json(path("layout"))
    assert code == 0 and said["blocks"] == rows.count() == 4 and said["by_class"]["Table"] == 1 and "content" not in rows.columns
    code, said = run("layout", path("pages"), "--out", path("layout"), "--pages", "1-2")
    assert said == {"blocks": 1, "by_class": {"Text": 1}}
    code, said = run("ocr", path("pages"), "--out", path("ocr"))
    assert code == 0 and said["elements"] == 4
    assert {r.content: r.language for r in spark.read.json(path("ocr")).where("content is not null").collect()}["le chat et les chiens"] == "fr"
    code, said = run("describe", path("pages"), "--out", path("said"), "--model", "tests.test_commands:shout")
    assert said == {"described": 1, "by_class": {"Table": 1}}
    assert run("process", path("pages"), "--out", path("docs"))[0] == 0
    doc = json.loads(spark.read.text(path("docs")).first().value)
    assert run("json", path("pages"), "--out", path("again"))[0] == 0 and json.loads(spark.read.text(path("again")).first().value) == doc
    (tmp_path / "d.json").write_text(json.dumps(doc))
    assert run("json", path("d.json"), "--out", path("third"))[0] == 0
    assert json.loads(spark.read.text(path("third")).first().value) == doc
    code, took = run("bench", path("pages"), "--out", path("bench"), "--model", "tests.test_commands:shout")
    assert [(s["stage"], s["rows"]) for s in took] == [("pages", 3), ("layout", 4), ("ocr", 4), ("describe", 4), ("json", 1)] and all(s["seconds"] > 0 for s in took)
