"""Resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from refinery.llm import resample as R
from tests.llm.helpers import docs, table, words


def features(text, shortest, longest, buckets):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return w, [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
               for n in range(shortest, longest + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, shortest=1, longest=1, buckets=10_000, percent=10, least=20):
    found = [(r[0], *features(r[1], shortest, longest, buckets)) for r in rows]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, _, f in found:
        np.add.at(s, f, 1)
    for text in target:
        np.add.at(t, features(text, shortest, longest, buckets)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    scored = []
    for doc, w, f in found:
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        scored.append((doc, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2 ** 32)))))
    able = sorted((x for x in scored if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0]))
    drawn = len(able) * percent // 100
    out = [(x[0], x[2], x[3], x[4], k if k <= drawn else None) for k, x in enumerate(able, 1)]
    return sorted(out + [(x[0], x[2], x[3], x[4], None) for x in scored if x[1] < least], key=repr)


def target_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("shortest,longest", [(1, 1), (1, 2), (2, 3)])
def test_against_plain_python(spark, shortest, longest):
    rng = random.Random(longest)
    rows = [(i, words(rng, rng.randrange(60), 80)) for i in range(200)]
    rows += [(500, None), (501, ""), (502, "..!"), (503, "Été É9 z" * 9), (None, words(rng, 30)), (504, "A " * 5000)]
    target = [words(rng, 30, 20), None, "", "ÉTÉ w1 W2"]
    df = docs(spark, rows, extra=True).repartition(5)
    got = R.resample(df, target_of(spark, target), shortest, longest, buckets=997, percent=30)
    assert table(got) == brute(rows, target, shortest, longest, 997, 30)


def test_copies_hold_a_third(spark):
    rng = random.Random(9)
    rows = [(i, words(rng, 25)) for i in range(60)] + [(7, words(random.Random(1), 40))] * 40
    target = [words(rng, 40)]
    got = table(R.resample(docs(spark, rows), target_of(spark, target), percent=50))
    assert got == brute(rows, target, percent=50)
    ranks = sorted(r[4] for r in got if r[4] is not None)
    assert ranks == list(range(1, 51))


def test_no_documents_or_no_target(spark):
    assert table(R.resample(docs(spark, []), target_of(spark, ["a b"]))) == []
    rows = [(i, words(random.Random(i), 30)) for i in range(20)]
    assert table(R.resample(docs(spark, rows), target_of(spark, []))) == brute(rows, [])


def test_a_slice_of_a_batch():
    texts = pa.array(["é à"] * 3 + ["b É c", None, "d"])
    bucket, owner, n = R.text_features(texts.slice(3), 1, 2, 1 << 20)
    assert n.tolist() == [3, 0, 1] and np.bincount(owner, minlength=3).tolist() == [5, 0, 1]
    assert sorted(bucket[owner == 0].tolist()) == sorted(zlib.crc32(x.encode()) % (1 << 20) for x in ("b", "É", "c", "b É", "É c"))
