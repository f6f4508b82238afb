"""Keys of results made of files, against what Python's JSON and file times give."""

import hashlib
import json
import os

from pyspark.sql import functions as F

from foliant.operators import cache


def test_seconds_are_written_as_python_writes_them(spark):
    us = [0, 1_700_000_000_000_000, 1_700_000_000_123_000, 1_700_000_000_100_000, 1_700_000_000_000_001, 5, 1_000_000]
    got = [r.t for r in spark.createDataFrame([(u,) for u in us], "u long").select(cache.seconds_text(F.col("u")).alias("t")).collect()]
    assert got == [f"{u // 10**6}.{(str(u % 10**6).rjust(6, '0').rstrip('0') or '0')}" for u in us]
    assert [float(t) for t in got] == [u / 10**6 for u in us] and got[2] == repr(1700000000.123)


def test_changed_files_have_other_keys(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"a")
    os.utime(tmp_path / "a.png", (1_700_000_000.25, 1_700_000_000.25))
    one = cache.keys_of_folder(spark, str(tmp_path), "ocr", "*.png", lang=F.lit("en")).first()
    plain = {"image_path": one.path, "lang": "en", "image_mtime": 1700000000.25}
    assert one.key == "ocr:" + hashlib.md5(json.dumps(plain, sort_keys=True).encode()).hexdigest()
    os.utime(tmp_path / "a.png", (1_700_000_001, 1_700_000_001))
    assert cache.keys_of_folder(spark, str(tmp_path), "ocr", "*.png", lang=F.lit("en")).first().key != one.key
