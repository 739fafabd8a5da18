"""Collocations against a plain count, and its edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from refinery.llm import collocations as C
from tests.llm.helpers import docs, table


def brute(rows, longest=3, least=10, top=2000, percent=50):
    f = defaultdict(Counter)
    for row in rows:
        lang = (row[2] if len(row) > 2 else "en") or "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1] or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rest = []
        for p, a in cand.items():
            inside = any(len(q) > len(p) and 100 * b >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                         for q, b in cand.items())
            if not inside:
                cuts = [(1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rest.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        n = sum(v for p, v in count.items() if len(p) == 1)
        for rank, (s, a, p, l, r) in enumerate(sorted(rest)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out, key=repr)


def text(rng, n, vocabulary=30):
    return "".join(f"{'W' if rng.random() < .1 else 'w'}{int(rng.paretovariate(.6)) % vocabulary}"
                   + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]) for _ in range(n))


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_against_plain_count(spark, longest):
    rng = random.Random(longest)
    rows = [(i, text(rng, rng.randrange(120)), rng.choice(["en", "de", None])) for i in range(60)]
    rows += [(None, None, "en"), (7, "", "fr"), (8, " .,\n", "fr"), (9, "é\x00ü é\x00ü", "en")] + rows[:5] * 3
    found = table(C.collocations(docs(spark, rows, extra=True), longest=longest, least=4, top=50))
    assert found == brute(rows, longest, 4, 50)
    assert found


def test_small_tiles_strips_and_parts(spark, monkeypatch):
    """Ids beyond the dense head, several strips and summing in parts give the same counts."""
    import refinery.llm.collocations as module
    rng = random.Random(5)
    rows = [(i, text(rng, 150, 60)) for i in range(50)]
    monkeypatch.setattr(module, "STRIP_PAIRS", 200)
    monkeypatch.setattr(module, "FAN_IN", 2)
    df = docs(spark, rows).repartition(7)  # a block for each task
    assert table(C.collocations(df, least=5)) == brute(rows, least=5)


def test_tiles_hold_every_pair():
    rng = np.random.default_rng(1)
    width, strips = 9000, 7
    code = rng.integers(0, width, 4000) * width + np.minimum(rng.integers(0, width, 4000), rng.integers(0, 5000, 4000))
    code = np.concatenate([code, code[:500]])
    total = Counter()
    for _, tile, cells, counts in C.tile_rows(3, code, width, strips):
        cells, counts = C.spread(cells, True), C.spread(counts)
        own = C.codes_of(tile, cells, width)
        left, right = np.divmod(own, width)
        assert (C.tile_of(left, right, width, strips) == tile).all()
        total.update(dict(zip(own.tolist(), counts.tolist())))
    assert total == Counter(code.tolist())


def test_tile_sum_merges_strips(monkeypatch):
    monkeypatch.setattr(C, "STRIP_PAIRS", 2)
    total = C.TileSum(0)
    for cells in ([1, 5, 9], [5], [2, 9], [1], [3, 5, 7, 8], [9]):
        total.add(np.array(cells), np.full(len(cells), 2 ** 33))
    cells, counts = total.done()
    assert dict(zip(cells.tolist(), counts.tolist())) == {
        k: v << 33 for k, v in {1: 2, 2: 1, 3: 1, 5: 3, 7: 1, 8: 1, 9: 3}.items()}


def test_squeezed_numbers_come_back():
    for numbers in ([], [0], [3, 3, 9, 2 ** 40], list(range(300)), [7] * 1000 + [2 ** 62]):
        numbers = np.array(numbers, np.int64)
        for rising in (False, True):
            assert C.spread(C.squeezed(numbers, rising), rising).tolist() == numbers.tolist()


def test_empty_table(spark):
    assert table(C.collocations(docs(spark, []))) == []
    assert table(C.collocations(docs(spark, [(1, None), (2, " . ")]))) == []
