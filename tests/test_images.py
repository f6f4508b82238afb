"""PNG pixels, hashes and near copies from files on, and the angles of drawn pages."""

import struct
import zlib

import numpy as np
import pytest

from foliant.operators import lines, models, quality
from foliant.sources import images


def png(pixels, kinds=(0,), palette=None, depth=8):
    """Grey (h, w), colour (h, w, 3 or 4) or palette places as a PNG, its rows filtered by `kinds` in turn."""
    p = np.asarray(pixels, np.uint8)
    h, w = p.shape[:2]
    samples = 1 if p.ndim == 2 else p.shape[2]
    rows = p.reshape(h, -1).astype(int) if depth == 8 else np.array([np.packbits(np.unpackbits(r[:, None], axis=1)[:, 8 - depth :].ravel()) for r in p], int)
    above, out = np.zeros(rows.shape[1], int), b""
    for y, row in enumerate(rows):
        kind, step = kinds[y % len(kinds)], samples if depth == 8 else 1
        left, corner = (np.concatenate((np.zeros(step, int), r[:-step])) for r in (row, above))
        g = left + above - corner
        a, b, c = abs(g - left), abs(g - above), abs(g - corner)
        guess = [0, left, above, (left + above) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))][kind]
        out += bytes([kind]) + ((row - guess) & 255).astype(np.uint8).tobytes()
        above = row
    colour = 3 if palette is not None else {1: 0, 2: 4, 3: 2, 4: 6}[samples]
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + b"\0\0\0\0"
    data = zlib.compress(out)
    return images.SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, 0)) + (part(b"PLTE", bytes(palette)) if palette is not None else b"") + part(b"IDAT", data[:9]) + part(b"IDAT", data[9:]) + part(b"IEND", b"")


@pytest.mark.parametrize("kinds", [(0,), (2,), (1, 2, 3, 4, 0), (4,), (3, 1)])
def test_pixels(kinds):
    rng = np.random.default_rng(1)
    for shape in ((1, 1), (7, 5), (5, 9, 3), (6, 4, 4), (30, 17)):
        p = rng.integers(0, 256, shape).astype(np.uint8)
        want = p.astype(float) if p.ndim == 2 else p[..., :3] @ (0.299, 0.587, 0.114)
        if p.ndim == 3 and p.shape[2] == 4:
            want = want * p[..., 3] / 255 + 255 - p[..., 3]
        assert np.allclose(images.grey(png(p, kinds)), want)


def test_palettes_and_few_bits():
    at = np.random.default_rng(2).integers(0, 4, (5, 11))
    palette = [0, 0, 0, 255, 255, 255, 255, 0, 0, 0, 0, 255]
    colours = np.array(palette).reshape(-1, 3) @ (0.299, 0.587, 0.114)
    assert np.allclose(images.grey(png(at, palette=palette)), colours[at])
    assert np.allclose(images.grey(png(at, palette=palette, depth=2)), colours[at])
    assert np.allclose(images.grey(png(at % 2, depth=1)), 255 * (at % 2))
    for bad in (b"", b"GIF89a", png(at)[:60], png(at, palette=[0, 0, 0])):
        with pytest.raises((ValueError, struct.error, zlib.error)):
            images.grey(bad)


def test_reduction():
    p = np.random.default_rng(3).random((64, 96))
    assert np.allclose(images.reduced(p), p.reshape(32, 2, 32, 3).mean(axis=(1, 3)))
    assert images.reduced(np.full((5, 3), 7.0)) == pytest.approx(np.full((32, 32), 7.0))


def test_near_copies_from_files(spark, tmp_path):
    rng = np.random.default_rng(4)
    def scene():
        y, x = np.mgrid[0:90, 0:120]
        return np.clip(sum(rng.uniform(20, 60) * np.sin(x * rng.uniform(0, 0.15) + y * rng.uniform(0, 0.15) + rng.uniform(0, 6)) for _ in range(4)) + 128, 0, 255)

    for i in range(8):
        s = scene()
        (tmp_path / f"{i}.png").write_bytes(png(s))
        (tmp_path / f"{i}_noise.png").write_bytes(png(np.clip(s + rng.normal(0, 4, s.shape), 0, 255), (4, 1)))
        (tmp_path / f"{i}_large.png").write_bytes(png(np.repeat(np.repeat(s, 2, axis=0), 2, axis=1), (2,)))
    (tmp_path / "broken.png").write_bytes(b"no image")
    got = images.image_hashes(spark, str(tmp_path))
    rows = {r.path.rsplit("/", 1)[1]: r for r in got.collect()}
    assert len(rows) == 25 and rows["broken.png"].hash is None and rows["broken.png"].error == "not a PNG"
    name = lambda p: p.rsplit("/", 1)[1].split("_")[0].split(".")[0]
    pairs = [(name(r.a), name(r.b)) for r in images.near_images(got).collect()]
    assert all(a == b for a, b in pairs) and {a for a, _ in pairs} == set("01234567")
    assert models.perceptual_hash(images.reduced(images.grey((tmp_path / "0.png").read_bytes()))) == rows["0.png"].hash


def page(angle, size=420, gap=40):
    """Dark strokes three pixels high, `gap` apart, at an angle."""
    y, x = np.mgrid[0:size, 0:size]
    d = np.radians(angle)
    across = y * np.cos(d) - x * np.sin(d)
    return np.where((across % gap < 3) & (x > 30) & (x < size - 30), 0, 255)


@pytest.mark.parametrize("size", [4096, 150])
def test_angles_of_drawn_pages(spark, tmp_path, size):
    angles = [0.0, 3.3, -7.75, 21.4, 90.0]
    for i, a in enumerate(angles):
        (tmp_path / f"{i}.png").write_bytes(png(page(a), (2,)))
    (tmp_path / "blank.png").write_bytes(png(np.full((64, 64), 255)))
    found = lines.as_segments(lines.peaks(lines.hough(images.tiles(spark, str(tmp_path), size))))
    got = {r.page.rsplit("/", 1)[1]: r for r in quality.deskew_angle(found, "page").collect()}
    for i, a in enumerate(angles[:-1]):
        assert got[f"{i}.png"].angle == pytest.approx(a, abs=0.5)
        assert got[f"{i}.png"].rotate == (abs(a) > 0.2)
    assert "blank.png" not in got
    upright = {r.page.rsplit("/", 1)[1]: r.is_rtl for r in quality.upright_lines(found, "page").collect()}
    assert upright["4.png"] and not upright["1.png"]
    steep = [abs(r.angle) for r in found.where("page like '%4.png'").collect()]
    assert len(steep) >= 8 and np.median(steep) == pytest.approx(90, abs=0.5)
