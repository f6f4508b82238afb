"""COCO documents larger than a task's memory: elements of the top object's arrays, found in byte ranges of the file.

Spark reads a file in ranges, cut at closing braces. What a range does to depth and to being inside a string is a small
summary, for either way it may begin; the summaries of all ranges, a row each, tell each range where it begins. Then
every range is cut into elements by itself, and elements that several ranges hold are put together by where they began.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Strings, or what is left of one at an end, and the signs that change depth.
STRING = re.compile(r'"(?:[^"\\]|\\.)*("|$)|[{}\[\]]', re.DOTALL)
CLOSES = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
COLON = re.compile(r"\s*:")
#: Depth of elements: within the top object and an array.
ELEMENT = 3
FOUND = pa.schema([("file", pa.string()), ("section", pa.string()), ("owner", pa.int64()), ("number", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])


class Scan:
    """Depth and strings along a text that comes in pieces."""

    def __init__(self, depth: int, inside: bool):
        self.depth, self.inside, self.lowest = depth, inside, depth
        self.keys: dict[int, str] = {}

    def signs(self, text: str) -> Iterator[tuple[int, str]]:
        """(place, sign) of each brace and bracket outside strings, before its depth counts."""
        at = 0
        if self.inside:
            m = CLOSES.match(text)
            if not m:
                return
            at, self.inside = m.end(), False
        while m := STRING.search(text, at):
            at, sign = m.end(), m[0]
            if sign[0] == '"':
                if not m[1]:
                    self.inside = True
                elif COLON.match(text, at):
                    self.keys[self.depth] = sign[1:-1]
                continue
            yield m.start(), sign
            self.depth += 1 if sign in "{[" else -1
            self.lowest = min(self.lowest, self.depth)


def ranges(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, value): a file's text cut after closing braces, in the order of each range."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value")


def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int] | None, str]]:
    """(range, piece); None in place of a range once it has ended."""
    last = None
    for batch in batches:
        for file, begin, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if last is not None and last != (file, begin):
                yield None, ""
            last = (file, begin)
            yield last, value + "}"
    if last is not None:
        yield None, ""


def summaries(pieces: DataFrame) -> DataFrame:
    """For a range that begins inside a string or not: whether it ends in one, how much deeper it ends, the lowest it gets,
    and the last key at each depth; depths count from its beginning."""
    kind = pa.schema([("file", pa.string()), ("begin", pa.int64()), ("inside", pa.bool_()), ("ends_inside", pa.bool_()), ("change", pa.int32()), ("lowest", pa.int32()), ("depths", pa.list_(pa.int32())), ("names", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scans, at = None, None
        for where, text in by_range(batches):
            if where is None:
                yield pa.RecordBatch.from_pylist([{"file": at[0], "begin": at[1], "inside": bool(i), "ends_inside": s.inside, "change": s.depth, "lowest": s.lowest, "depths": list(s.keys), "names": list(s.keys.values())} for i, s in enumerate(scans)], schema=kind)
                scans = None
                continue
            scans, at = scans or [Scan(0, False), Scan(0, True)], where
            for s in scans:
                for _ in s.signs(text):
                    pass

    return pieces.mapInArrow(run, "file string, begin long, inside boolean, ends_inside boolean, change int, lowest int, depths array<int>, names array<string>")


def beginnings(pieces: DataFrame) -> dict[tuple[str, int], tuple[int, bool, str, int]]:
    """For each range: its depth, whether it is inside a string, the top object's last key, and the range in which the
    element that it goes on with began. The driver gets two rows a range, which are as many as tasks."""
    out: dict[tuple[str, int], tuple[int, bool, str, int]] = {}
    state, file = (0, False, "", -1), None
    for r in sorted(summaries(pieces).collect(), key=lambda r: (r.file, r.begin)):
        if r.file != file:
            file, state = r.file, (0, False, "", -1)
        if r.inside != state[1] or (r.file, r.begin) in out:
            continue
        depth, _, key, owner = out[(r.file, r.begin)] = state
        end = depth + r.change
        owner = -1 if end < ELEMENT else r.begin if depth + r.lowest < ELEMENT else owner
        state = (end, r.ends_inside, dict(zip(r.depths, r.names, strict=True)).get(1 - depth, key), owner)
    return out


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, section, place, text): each object in an array of a document's top object, the array's key, and a number that
    grows along the file. Text beyond the top object's end, and other values of its, play no part; a file may be cut
    anywhere. An element is text in one task; a document is not."""
    pieces = ranges(spark, path)
    start = beginnings(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, out, held, at, number, mine, over = None, [], [], None, 0, False, False

        def row(owner: int, place: int, text: list[str], whole: bool) -> dict:
            return {"file": at[0], "section": scan.keys.get(1, ""), "owner": owner, "number": place, "part": at[1], "whole": whole, "text": "".join(text)}

        for where, text in by_range(batches):
            if where is None:
                if held and not over:
                    out.append(row(at[1] if mine else start[at][3], number if mine else -1, held, False))
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=FOUND)
                scan, out, held, number, mine, over = None, [], [], 0, False, False
                continue
            if scan is None:
                at = where
                scan = Scan(*start[at][:2])
                scan.keys[1] = start[at][2]
                over = at[1] > 0 and scan.depth <= 0
            if over:
                continue
            first = 0 if scan.depth >= ELEMENT else None
            for place, sign in scan.signs(text):
                if sign == "{" and scan.depth == ELEMENT - 1:
                    first, held, mine = place, [], True
                elif sign == "}" and scan.depth == ELEMENT and first is not None:
                    held.append(text[first : place + 1])
                    out.append(row(at[1], number, held, True) if mine else row(start[at][3], -1, held, False))
                    number, held, first, mine = number + mine, [], None, False
                elif sign == "}" and scan.depth == 1:
                    over = True
                    break
            if first is not None:
                held.append(text[first:])
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist(out, schema=FOUND)
                out = []

    found = pieces.mapInArrow(run, "file string, section string, owner long, number long, part long, whole boolean, text string")
    parts = found.where("not whole").groupBy("file", "owner").agg(F.max_by("section", "number").alias("section"), F.max("number").alias("number"), F.array_sort(F.collect_list(F.struct("part", "text"))).alias("p"))
    joint = parts.where("number >= 0").select("file", "section", "owner", "number", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))
    both = found.where("whole").select(*joint.columns).unionByName(joint)
    return both.select("file", "section", (F.col("owner") + F.col("number")).alias("place"), "text")  # an element takes two bytes at least


def write_document(sections: dict[str, tuple[DataFrame, Column]], path: str) -> None:
    """One JSON document with an array of rows for each section (rows, and their order), in one file below path. Rows are
    sorted all over Spark and stream through the one task that writes; no row holds more than one element."""
    spark = next(iter(sections.values()))[0].sparkSession
    line = lambda text, no, k: spark.range(1).select(F.lit(text).alias("value"), F.lit(no).alias("s"), F.lit(k).alias("k"), F.lit(None).cast("string").alias("o"))
    lines = line("{", 0, 0)
    for no, (name, (rows, order)) in enumerate(sections.items(), 1):
        told = rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), order.alias("o"))
        first = told.agg(F.min(F.struct("o", "value")).alias("f"))
        comma = F.when(F.struct("o", "value") == F.col("f"), "").otherwise(",")
        told = told.withColumn("value", F.coalesce("value", F.lit("{}"))).crossJoin(F.broadcast(first))  # one row
        told = told.select(F.concat(comma, F.col("value")).alias("value"), F.lit(no).alias("s"), F.lit(1).alias("k"), F.format_string("%020d", F.col("o").cast("long")).alias("o"))
        lines = lines.unionByName(line(f'{"," if no > 1 else ""}"{name}": [', no, 0)).unionByName(told).unionByName(line("]", no, 2))
    lines = lines.unionByName(line("}", len(sections) + 1, 0))
    lines.orderBy("s", "k", "o", "value").select("value").coalesce(1).write.mode("overwrite").text(path)


def write_parts(sections: dict[str, tuple[DataFrame, Column]], path: str) -> None:
    """write_document in many files: put one after another in the order of their paths, the files below path are the
    document. A section has a folder, and every task writes its own part of it; rows are sorted before they are text."""
    spark = next(iter(sections.values()))[0].sparkSession
    for no, (name, (rows, order)) in enumerate(sections.items(), 1):
        told = rows.select(F.lit(1).alias("k"), F.struct(order.alias("o"), *rows.columns).alias("r"), F.struct(*rows.columns).alias("e"), F.lit(None).cast("string").alias("t"))
        line = lambda text, k: spark.range(1).select(F.lit(k).alias("k"), F.lit(None).cast(told.schema["r"].dataType).alias("r"), F.lit(None).cast(told.schema["e"].dataType).alias("e"), F.lit(text).alias("t"))  # noqa: B023, E731
        lines = told.unionByName(line(f'{"{" if no == 1 else ","}"{name}": [', 0)).unionByName(line("]}" if no == len(sections) else "]", 2))
        first = F.broadcast(told.agg(F.min("r").alias("f")))  # one row
        text = F.coalesce("t", F.concat(F.when(F.col("r") == F.col("f"), "").otherwise(","), F.to_json("e")))
        lines.crossJoin(first).orderBy("k", "r").select(text.alias("value")).write.text(f"{path}/{no:03d}-{name}")


def read_part(spark: SparkSession, path: str, section: str, kind: str) -> DataFrame:
    """(a): the elements, of type kind, of a section that write_parts wrote below path."""
    lines = spark.read.text(f"{path}/*-{section}").select(F.ltrim("value", F.lit(",")).alias("value"))
    return lines.where(F.col("value").startswith("{") & F.col("value").endswith("}")).select(F.explode(F.array(F.from_json("value", kind))).alias("a"))  # parsed once, whatever is asked of it


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array, np.ndarray, np.ndarray]]:
    """(range, lines without a leading comma, places of lines that open an array, whether a line is an element), batch by
    batch; a range may come in several."""
    for batch in batches:
        files, begins, lines = batch.columns
        code = files.dictionary_encode().indices.to_numpy()
        begins = begins.to_numpy()
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (begins[1:] != begins[:-1])) + 1
        lines = pc.utf8_ltrim(lines, ",")
        opens = pc.ends_with(lines, "[").to_numpy(zero_copy_only=False)
        objects = pc.and_(pc.starts_with(lines, "{"), pc.ends_with(lines, "}")).to_numpy(zero_copy_only=False)
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lines)], strict=True):
            if hi > lo:
                yield (files[lo].as_py(), int(begins[lo])), lines.slice(lo, hi - lo), np.flatnonzero(opens[lo:hi]), objects[lo:hi]


def lined_elements(spark: SparkSession, path: str) -> DataFrame:
    """(head, number, text) of documents in parts, an element a line: each object in an array, the line that opens the
    array, and the object's place in it from 0. The files of a folder, by name, are one document. Files are read in
    ranges; one row a range tells the driver, and by it each range, which array goes on and how far it has come."""
    text = spark.read.option("recursiveFileLookup", True).text(path)
    pieces = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[tuple[str, int], tuple[str | None, int]] = {}
        for at, lines, opens, objects in _by_part(batches):
            if len(opens):
                told[at] = (lines[int(opens[-1])].as_py(), int(objects[opens[-1] :].sum()))
            else:
                head, n = told.get(at, (None, 0))
                told[at] = (head, n + int(objects.sum()))
        if told:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in told]), pa.array([k[1] for k in told], pa.int64()), pa.array([v[0] for v in told.values()], pa.string()), pa.array([v[1] for v in told.values()], pa.int64())], names=["file", "begin", "head", "n"])

    start, folder, state = {}, None, ("", 0)
    for r in sorted(pieces.mapInArrow(ends, "file string, begin long, head string, n long").collect(), key=lambda r: (*r.file.rpartition("/")[::2], r.begin)):
        if r.file.rpartition("/")[0] != folder:
            folder, state = r.file.rpartition("/")[0], ("", 0)
        start[(r.file, r.begin)] = state
        state = (state[0], state[1] + r.n) if r.head is None else (r.head, r.n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head, n = None, "", 0
        for at, lines, opens, objects in _by_part(batches):
            if at != last:
                last, (head, n) = at, start[at]
            for lo, hi in zip([0, *opens.tolist()], [*opens.tolist(), len(lines)], strict=True):
                if lo < hi and lo in opens:
                    head, n = lines[lo].as_py(), 0
                some = np.flatnonzero(objects[lo:hi]) + lo
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), head, object), pa.string()), pa.array(np.arange(n, n + len(some))), lines.take(pa.array(some))], names=["head", "number", "text"])
                    n += len(some)

    return pieces.mapInArrow(run, "head string, number long, text string")
