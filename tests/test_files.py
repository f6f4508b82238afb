"""Files of a dataset: listings, pairs, PDFs, elements, references, licences, ingest, sinks and the command line."""

import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from foliant import cli, config
from foliant.plans import pipelines as P
from foliant.sources import files as S


def png(width: int, height: int) -> bytes:
    return b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">II", width, height)


def pdf(sizes, packed=False) -> bytes:
    """Without references, so they have to be found; pages without a box have the tree's."""
    kids = b" ".join(b"%d 0 R" % i for i in range(3, 3 + len(sizes)))
    objects = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /MediaBox [0 0 612 792] /Kids [%s] >>" % kids, *(b"<< /Type /Page /MediaBox [0 0 %d %d] >>" % s if s else b"<< /Type /Page >>" for s in sizes)]
    if packed:
        ends = [0]
        for o in objects:
            ends.append(ends[-1] + len(o) + 1)
        first = b" ".join(b"%d %d" % (i + 1, e) for i, e in enumerate(ends[:-1])) + b" "
        data = zlib.compress(first + b" ".join(objects))
        return b"%%PDF-1.5\n9 0 obj << /Type /ObjStm /N %d /First %d /Filter /FlateDecode >>\nstream\n" % (len(objects), len(first)) + data + b"\nendstream endobj trailer << /Root 1 0 R >>"
    return b"%PDF-1.5\n" + b"\n".join(b"%d 0 obj %s endobj" % (i, p) for i, p in enumerate(objects, 1))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("data")
    for i, (name, size) in enumerate((("a.png", (200, 100)), ("b.jpg.png", (50, 60)), ("c.PNG", (10, 10)), ("d.bmp", (1, 1)), ("e.png", (80, 80)))):
        (at / name).write_bytes(png(*size) if i < 4 else b"junk")
    boxes = [{"bbox": [-5, 10, 50, 20], "category_id": 7, "category_name": "Head"}, {"bbox": [150, 90, 100, 100], "category_id": 3}, {"bbox": [1, 2, 3], "category_id": 3}, {"bbox": [0, 0, 1, 50], "category_id": 3}, {"bbox": [0, 0, 9, 9]}]
    (at / "a.json").write_text(json.dumps({"annotations": boxes, "corruption": {"blur": "1"}}))
    (at / "b.jpg.json").write_text(json.dumps({"annotations": [{"bbox": [0, 0, 50, 60], "category_id": 7, "category_name": "Body"}, {"bbox": [0, 0, 5, 60], "category_id": 7, "category_name": "Body"}]}))
    (at / "orphan.json").write_text("{}")
    (at / "one.pdf").write_bytes(pdf([(612, 792), None, (100, 200)]))
    (at / "two.pdf").write_bytes(pdf([(72, 144)], packed=True))
    (at / "bad.pdf").write_bytes(b"no pages")
    (at / "licenses").mkdir()
    (at / "licenses" / "x.txt").write_text("MIT License")
    (at / "LICENSE.md").write_text("Creative Commons")
    (at / "sub").mkdir()
    (at / "sub" / "license.txt").write_text("names count as they are written")
    return at


def test_listings_and_pairs(spark, folder):
    name = lambda df, c="path": sorted(r[0] for r in df.select(S.base(F.col(c))).collect())
    images = S.list_images(spark, str(folder))
    assert name(images) == ["a.png", "b.jpg.png", "c.PNG", "e.png"] and name(S.list_images(spark, str(folder), ("bmp",))) == ["d.bmp"]
    docs = S.listing(spark, str(folder), "*.json")
    pairs, lone = S.pairs_by_image(images, docs)
    assert sorted(r.stem for r in pairs.collect()) == ["a", "b.jpg"] and sorted(r.stem for r in lone.collect()) == ["c", "e"]
    both = spark.createDataFrame([("f/x.jpeg",), ("f/x.png",), ("f/y.JPG",), ("g/x.png",)], "path string")
    got, without = S.pairs_by_document(both, spark.createDataFrame([("f/x.json",), ("f/y.json",), ("f/z.json",)], "path string"))
    assert sorted(r.image for r in got.collect()) == ["f/x.png", "f/y.JPG"] and [r.document for r in without.collect()] == ["f/z.json"]
    assert sorted(r.stem for r in S.not_done(pairs, spark.createDataFrame([(" a ",)], "value string")).collect()) == ["b.jpg"]
    assert S.single_page(images).where("document_id = 'a.png' and page = 0").count() == 1


def test_pdf_pages(spark, folder):
    got = sorted(((r.path.rsplit("/", 1)[1], r.page, r.width, r.height, r.error) for r in S.pdf_pages(spark, str(folder), 144).collect()), key=str)
    assert got == sorted([("one.pdf", 0, 1224, 1584, None), ("one.pdf", 1, 1224, 1584, None), ("one.pdf", 2, 200, 400, None), ("two.pdf", 0, 144, 288, None), ("bad.pdf", None, None, None, "not a PDF")], key=str)
    assert S.pdf_pages(spark, str(folder), 72, 1, 2).where("page is not null").count() == 1


def test_elements_and_references(spark, tmp_path):
    e = {"class": "Table", "bbox": [1, 2, 3, 4], "content": None, "language": "en", "page": 2, "meta": {"source": "x"}}
    (tmp_path / "whole.json").write_text(json.dumps({"document_id": "d", "elements": [e, e | {"class": "Text", "content": "t"}]}, indent=2))
    (tmp_path / "bare.json").write_text("\n " + json.dumps([e | {"content": "c"}]))
    rows = S.read_elements(spark, str(tmp_path)).orderBy("document_id", "elem_pos").collect()
    assert [(r.document_id, r.elem_pos, r.page, r["class"], r.w, r.content, r.meta) for r in rows] == [(None, 0, 2, "Table", 3, "c", {"source": "x"}), ("d", 0, 2, "Table", 3, None, {"source": "x"}), ("d", 1, 2, "Text", 3, "t", {"source": "x"})]
    refs = tmp_path / "refs"
    refs.mkdir()
    (refs / "list.json").write_text(json.dumps([{"image_name": "i.png", "description": "one"}, {"id": "7", "description": "two"}, {"id": "8"}]))
    (refs / "doc.json").write_text(json.dumps({"elements": [e | {"content": "three"}, e | {"class": "Text", "content": "no"}]}))
    assert sorted((r.key, r.text) for r in S.read_references(spark, str(refs)).collect()) == [("2_[1, 2, 3, 4]", "three"), ("7", "two"), ("8", ""), ("i.png", "one")]


def test_licences(spark, folder):
    got = sorted((r.path.rsplit("/", 1)[1], r.folder.rsplit("/", 1)[1], r.text) for r in S.license_files(spark, str(folder)).collect())
    assert got == [("LICENSE.md", folder.name, "Creative Commons"), ("x.txt", folder.name, "MIT License")]


def test_ingest(spark, folder, tmp_path):
    t = P.ingest(spark, str(folder), {3: "Foot"}, (0.5, 0.5, 0.0))
    assert [(r.file_name, r.image_id, r.width, r.file_attributes) for r in t["images"].orderBy("image_id").collect()] == [("a.png", 0, 200, {"blur": "1"}), ("b.jpg.png", 1, 50, None)]
    assert [(r.orig_id, r.category_id, r.name) for r in t["categories"].orderBy("category_id").collect()] == [(3, 0, "Foot"), (7, 1, "Body")]
    assert [(r.ann_id, r.image_id, r.category_id, r.x, r.y, r.w, r.h) for r in t["annotations"].orderBy("ann_id").collect()] == [(0, 0, 1, 0, 10, 50, 20), (1, 0, 0, 150, 90, 50, 10), (2, 1, 1, 0, 0, 50, 60), (3, 1, 1, 0, 0, 5, 60)]
    assert tuple(t["stats"].first()) == (2, 4, 1) and {r.stem for r in t["missing"].collect()} >= {"c"}
    P.write_ingested(t, str(tmp_path / "out"))
    docs = [json.loads(r.value) for s in ("train", "val", "test") for r in spark.read.text(str(tmp_path / f"out/coco/{s}")).collect()]
    assert sorted(len(d["annotations"]) for d in docs) == [0, 2, 2] and all(len(d["categories"]) == 2 for d in docs)
    assert {r.value.count("\n") + 1 for r in spark.read.parquet(str(tmp_path / "out/yolo/labels")).collect()} == {2}
    assert "nc: 2" in [r.value for r in spark.read.text(str(tmp_path / "out/yolo/data.yaml")).collect()]
    again = P.ingest(spark, str(folder), done=spark.read.text(str(tmp_path / "out/.done")))
    assert again["images"].count() == 0 and again["annotations"].count() == 0


def test_sinks(spark, tmp_path):
    src = tmp_path / "s.txt"
    src.write_text("hello")
    plan = spark.createDataFrame([(str(src), str(tmp_path / "to/s.txt")), ("/none", str(tmp_path / "to/n"))], "src string, dst string")
    got = {r.src: (r.bytes, r.error is None) for r in S.copy_files(plan).collect()}
    assert got == {str(src): (5, True), "/none": (None, False)} and (tmp_path / "to/s.txt").read_text() == "hello"
    square = spark.createDataFrame([("a", "a", 2), ("a", "b", 1), ("b", "a", 0), ("b", "b", 3)], "truth string, guess string, n long")
    S.write_csv(S.wide_matrix(square, ["a", "b"]), str(tmp_path / "m"))
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "m")).collect()) == [("a", "2", "1"), ("b", "0", "3")]
    e = spark.createDataFrame([("Text", 1, 2, 3, 4, "t", None, {"confidence": "0.12345"}), ("Table", 5, 6, 7, 8, None, None, {})], "class string, x int, y int, w int, h int, content string, language string, meta map<string,string>")
    assert [tuple(r) for r in S.ocr_table(e).collect()] == [("Text", "1,2,3,4", "t", "", "0.123"), ("Table", "5,6,7,8", "", "", "0.000")]
    S.write_json(e, str(tmp_path / "j"))
    assert '"language":null' in spark.read.text(str(tmp_path / "j")).first().value


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("dpi: 300\nlayout:\n  conf_threshold: 0.5\nextra: {a: 1}\n")
    c = config.load(tmp_path / "c.yaml", {"FOLIANT_DPI": "150", "FOLIANT_LAYOUT_MODEL": "m", "FOLIANT_RUNTIME_NUM_WORKERS": "9"})
    assert (c["dpi"], c["layout"]["conf_threshold"], c["layout"]["model"], c["runtime"]["num_workers"], c["extra"], c["device"], c["layout"]["classes"][0]) == (150, 0.5, "m", 9, {"a": 1}, "cpu", "Text")
    assert config.load(tmp_path / "missing.yaml", {})["dpi"] == 220 == config.DEFAULTS["dpi"]
    d: dict = {}
    config.set_path(d, "a.b.c", 1)
    assert d == {"a": {"b": {"c": 1}}} and config.get_path(d, "a.x", 5) == 5 and config.merged(d, {"a": {"b": 2}}) == {"a": {"b": 2}}
    digest = config.write_lock(c, tmp_path / "k/lock.json")
    assert digest == config.lock(c)[1] and config.lock(config.load(None, {}))[1] != config.lock(config.merged(c, {"train": {"imgsz": 1}}))[1]
    assert config.id_names("1:Text, 2:Title 3:List") == {1: "Text", 2: "Title", 3: "List"} and config.page_range("3") == (3, 4) and config.page_range("2-") == (2, None) and config.page_range(None) == (0, None)
    with pytest.raises(ValueError, match="Nope"):
        config.id_names("1:Nope", ["Text"])


def test_command_line(spark, tmp_path, capsys):
    ann = lambda i, page, box, score: {"id": i, "image_id": page, "category_id": 1, "bbox": box, "score": score}
    doc = {"images": [{"id": k, "file_name": f"p{k}.png", "width": 100, "height": 100} for k in range(4)], "annotations": [ann(k, k, [10, 10, 30, 30], 0.9 - k / 10) for k in range(4)], "categories": [{"id": 1, "name": "Text"}]}
    (tmp_path / "c.json").write_text(json.dumps(doc))
    path = lambda p: str(tmp_path / p)
    run = lambda *a: cli.main([*a], spark)
    assert run("coco-to-yolo", "--coco", path("c.json"), "--out", path("y")) == 0 and spark.read.parquet(path("y/labels")).count() == 4
    assert run("split", "--coco", path("c.json"), "--out", path("s"), "--train", "0.5", "--val", "0.25", "--test", "0.25") == 0
    assert sorted(len(json.loads(spark.read.text(path(f"s/{k}")).first().value)["images"]) for k in ("train", "val", "test")) == [1, 1, 2]
    assert run("eval-coco", "--gt", path("c.json"), "--pred", path("c.json"), "--out", path("e")) == 0
    assert {r.metric: r.value for r in spark.read.json(path("e/coco_metrics")).collect()}["mAP_0.5"] == 1.0
    assert run("select", "--pred", path("c.json"), "--out", path("sel"), "--top", "2") == 0 and spark.read.json(path("sel")).count() == 2
    assert run("pseudo-labels", "--pred", path("c.json"), "--out", path("pl"), "--thr", "0.75") == 0 and spark.read.json(path("pl/manifest")).first().total_labels == 2
    assert run("calibrate", "--gt", path("c.json"), "--pred", path("c.json"), "--out", path("cal"), "--method", "platt") == 0 and "scale" in spark.read.text(path("cal")).first().value
    elements = [{"class": "Text", "bbox": [0, 0, 1, 1], "content": "green apples grow", "language": "en", "page": 0}, {"class": "Table", "bbox": [0, 9, 1, 1], "content": "x", "language": None, "page": 0}]
    (tmp_path / "el.json").write_text(json.dumps({"document_id": "d", "elements": elements}))
    assert run("build-index", path("el.json"), "--out", path("ix"), "--dim", "128") == 0 and run("search", path("ix"), "--q", "apples", "--dim", "128") == 0
    assert "green apples grow" in capsys.readouterr().out
    assert run("eval-desc-qa", "--elements", path("el.json"), "--out", path("qa")) == 0 and {"length_insufficient", "missing_numerics"} <= {r.issue for r in spark.read.json(path("qa/qa_results")).collect()}
