"""PNG images as grey pixels: chunks, filters of rows, and reduction by areas, on numpy arrays."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators.models import perceptual_hash

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples a pixel has, by colour type.
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
#: Most pixels an image may have.
MOST_PIXELS = 1 << 27


def unfiltered(rows: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    """Bytes of rows from their differences to the byte `step` to the left, the one above and the one above that; in the
    order of diagonals, on each of which every row has one group of bytes that depends on earlier diagonals only."""
    h, w = rows.shape
    n = -(-w // step)
    out = np.zeros((h + 1, (n + 1) * step), np.int16)
    raw = np.zeros((h, n * step), np.int16)
    raw[:, :w] = rows
    out, raw = out.reshape(h + 1, n + 1, step), raw.reshape(h, n, step)
    if not np.isin(kinds, (1, 3, 4)).any():  # rows depend on those above only
        for y in range(h):
            out[y + 1, 1:] = (raw[y] + (out[y, 1:] if kinds[y] == 2 else 0)) & 255
        return out[1:, 1:].reshape(h, -1)[:, :w].astype(np.uint8)
    for d in range(h + n - 1):
        y = np.arange(max(0, d - n + 1), min(h, d + 1))
        x = d - y
        left, up, corner, kind = out[y + 1, x], out[y, x + 1], out[y, x], kinds[y][:, None]
        guess = left + up - corner
        a, b, c = np.abs(guess - left), np.abs(guess - up), np.abs(guess - corner)
        nearest = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        out[y + 1, x + 1] = (raw[y, x] + np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, up, (left + up) >> 1, nearest], 0)) & 255
    return out[1:, 1:].reshape(h, -1)[:, :w].astype(np.uint8)


def grey(data: bytes) -> np.ndarray:
    """Luminance from 0 to 255 of each pixel of a PNG that is not interlaced; what is transparent lies on white."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, body, palette, alphas, head = 8, [], None, b"", None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3).astype(float)
        elif kind == b"tRNS":
            alphas = part
        elif kind == b"IDAT":
            body.append(part)
        elif kind == b"IEND":
            break
        at += 12 + size
    if head is None or head[6] or head[3] not in SAMPLES or not head[0] or not head[1]:
        raise ValueError("no header that is read")
    w, h, depth, colour = head[:4]
    if w * h > MOST_PIXELS:
        raise ValueError(f"over {MOST_PIXELS} pixels")
    samples = SAMPLES[colour]
    width = -(-w * samples * depth // 8)
    d = zlib.decompressobj()
    raw = d.decompress(b"".join(body), h * (width + 1))
    if len(raw) < h * (width + 1):
        raise ValueError("pixels are missing")
    rows = np.frombuffer(raw, np.uint8).reshape(h, width + 1)
    plain = unfiltered(rows[:, 1:], rows[:, 0], max(1, samples * depth // 8))
    if depth < 8:
        bits = np.unpackbits(plain, axis=1)[:, : w * samples * depth].reshape(h, w * samples, depth)
        plain = bits @ (1 << np.arange(depth)[::-1])
    elif depth == 16:
        plain = plain[:, ::2]
    pixels = plain.reshape(h, w, samples).astype(float)
    if colour == 3:
        if palette is None or pixels.max() >= len(palette):
            raise ValueError("a colour is not in the palette")
        which = pixels[:, :, 0].astype(int)
        clear = np.full(len(palette), 255.0)
        clear[: len(alphas)] = list(alphas[: len(palette)])
        pixels = np.dstack((palette[which], clear[which]))
    elif depth < 8:
        pixels *= 255 / ((1 << depth) - 1)
    value = pixels[:, :, :3] @ (0.299, 0.587, 0.114) if pixels.shape[2] > 2 else pixels[:, :, 0]
    if pixels.shape[2] in (2, 4):
        cover = pixels[:, :, -1] / 255
        value = value * cover + 255 * (1 - cover)
    return value


def reduced(pixels: np.ndarray, size: int = 32) -> np.ndarray:
    """size x size means of equal areas; pixels on an edge count by their part on either side."""
    for _ in range(2):
        n = len(pixels)
        sums = np.concatenate((np.zeros((1, pixels.shape[1])), np.cumsum(pixels, axis=0)))
        at = np.arange(size + 1) * n / size
        whole = np.minimum(at.astype(int), n - 1)
        upto = sums[whole] + (at - whole)[:, None] * pixels[whole]
        pixels = (np.diff(upto, axis=0) * size / n).T
    return pixels


def image_hashes(spark: SparkSession, folder: str, pattern: str = "*.{png,PNG}") -> DataFrame:
    """(path, hash, error): the perceptual hash of each image, null with the error where it cannot be read. Pixels are seen
    one image at a time and go no further."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    out.append((path, perceptual_hash(reduced(grey(bytes(content)))), None))
                except (ValueError, IndexError, struct.error, zlib.error) as e:
                    out.append((path, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "hash", "error"]).astype({"hash": "Int64"})

    return files.mapInPandas(run, "path string, hash long, error string")


def near_images(hashes: DataFrame, most: int = 8) -> DataFrame:
    """(a, b, distance): paths of images whose hashes differ in `most` bits at most; equal hashes as distance 0, each with
    the smallest path of its hash."""
    from foliant.operators.hashes import near_hashes

    read = hashes.where("hash is not null").select("path", "hash")
    first = read.groupBy("hash").agg(F.min("path").alias("first"))
    same = read.join(first, "hash").where("path <> first").select(F.col("first").alias("a"), F.col("path").alias("b"), F.lit(0).cast("long").alias("distance"))
    pairs = near_hashes(first.withColumn("id", F.col("hash")), "id", "hash", most)
    paths = lambda c: first.select(F.col("hash").alias(c), F.col("first").alias(f"p{c}"))
    named = pairs.join(paths("a"), "a").join(paths("b"), "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"), "distance")
    return same.unionByName(named)


def tiles(spark: SparkSession, folder: str, size: int = 512, pattern: str = "*.{png,PNG}") -> DataFrame:
    """(page, x, y, width, height, pixels): grey images cut into tiles of bytes, with a border of two pixels of what lies
    around, so that edges on a seam are seen from one side whole. Images that cannot be read have no tiles."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    pixels = np.rint(grey(bytes(content))).astype(np.uint8)
                except (ValueError, IndexError, struct.error, zlib.error):
                    continue
                wide = np.pad(pixels, 2, mode="edge")
                cuts = [(x, y, wide[y : y + size + 4, x : x + size + 4]) for y in range(0, len(pixels), size) for x in range(0, pixels.shape[1], size)]
                yield pd.DataFrame([(path, x, y, t.shape[1] - 4, t.shape[0] - 4, t.tobytes()) for x, y, t in cuts], columns=["page", "x", "y", "width", "height", "pixels"])

    return files.mapInPandas(run, "page string, x int, y int, width int, height int, pixels binary")
