"""Importance resampling against features cut out and hashed one by one."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from lexigrain.llm import importance
from lexigrain.llm.queries import registry

TEXTS = [
    None,
    "",
    " \n,.- ",
    "Hello, World-42 hello\tworld",
    "Ärger über ÄÖ ñandú  naïve—dash",
    "one two three " * 30,
    "a",
    "w" * 5000 + " " + "v" * 70 + " x " * 25,
    "the cat sat on the mat and the dog sat on the log while it rained all over the wide town",
    "THE cat sat on the mat and the dog sat on the log while it rained all over the wide town",
] + [" ".join(random.Random(seed).choices("ab bc cd de ef fg".split(), k=25)) for seed in range(30)]


def grams(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[k : k + n]).encode() for n in (1, 2) for k in range(len(words) - n + 1)]


def plain_table(rows, targets):
    s, t = np.zeros(10000, dtype=int), np.zeros(10000, dtype=int)
    for counts, texts in ((s, [text for _, text in rows]), (t, targets)):
        for text in texts:
            for gram in grams(text)[1]:
                counts[zlib.crc32(gram) % 10000] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10000) / ((a + 1) * (t.sum() + 10000)))) for a, b in zip(s, t)]
    out = []
    for doc_id, text in rows:
        n, found = grams(text)
        weight = sum(gain[zlib.crc32(gram) % 10000] for gram in found) // max(1, len(found))
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((row for row in out if row[5] >= 20), key=lambda row: (-row[3], row[0] is not None, row[0] or 0, row[1], row[2]))
    for rank, row in enumerate(able[: 25 * len(able) // 100], 1):
        row[4] = rank
    return [tuple(row[:5]) for row in out]


def in_order(rows):
    return sorted(rows, key=str)


def test_table_equals_plain_version(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[8]), (None, TEXTS[9]), (None, TEXTS[9]), (None, TEXTS[12]), (39, TEXTS[39])]
    rows += [(7, TEXTS[11])] * 9
    frame = spark.createDataFrame([(*row, 1, "clash", 2) for row in rows], "doc_id long, text string, score int, rank string, n long")
    target = spark.createDataFrame([("the cat and the dog",), ("ab ab ab cd",), (None,)], "text string")
    found = importance.importance_table(frame, target)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert in_order(map(tuple, found.collect())) == in_order(plain_table(rows, ["the cat and the dog", "ab ab ab cd", None]))
    drawn = importance.resample(frame, target)
    assert drawn.columns == frame.columns
    assert {row.doc_id for row in drawn.collect()} == {row.doc_id for row in found.where("rank IS NOT NULL").collect()}
    assert importance.importance_table(frame.limit(0), target).count() == 0
    none = importance.importance_table(frame, target.limit(0)).collect()
    assert in_order(map(tuple, none)) == in_order(plain_table(rows, []))


@pytest.mark.parametrize("size", [16, 300, 1 << 20])
def test_runs_of_any_size_give_the_same_features(size, monkeypatch):
    monkeypatch.setattr(importance, "RUN_BYTES", size)
    monkeypatch.setattr(importance.word_runs, "__defaults__", (size,))
    texts = [text.encode() if text else None for text in TEXTS]
    for longest in (1, 2, 3):
        found = [[] for _ in texts]
        for place, bucket in importance.features(texts, longest, 10000):
            for at, value in zip(place.tolist(), bucket.tolist()):
                found[at].append(value)
        for text, buckets in zip(TEXTS, found):
            words = grams(text)[1][: grams(text)[0]]
            wanted = [b" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
            assert sorted(buckets) == sorted(zlib.crc32(gram) % 10000 for gram in wanted)


def test_shifts_of_any_length():
    draw = random.Random(4)
    for _ in range(300):
        a, b = (draw.randbytes(draw.choice([0, 1, 5, 63, 64, 65, 1000, 70000])) for _ in range(2))
        crc = importance.shifted(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([len(b)]))[0]
        assert int(crc) ^ zlib.crc32(b) == zlib.crc32(a + b)
        ended = np.array([zlib.crc32(a + b" ")], dtype=np.uint32)
        assert int(importance.without_space(ended)[0]) == zlib.crc32(a)


def test_query_equals_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(row) for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    targets = [row.text for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = registry()["op13_importance_draw"](spark, folder)
    assert in_order(map(tuple, found.collect())) == in_order(plain_table(rows, targets))
