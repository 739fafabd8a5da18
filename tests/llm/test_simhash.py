import random

import xxhash

from refinery.llm import simhash as s

from .helpers import docs, table, words


def brute_print(text):
    w = []
    for x in (text or "").encode().lower().split():
        w.append(x.decode())
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, radius=4):
    fp = [brute_print(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if label[j] < label[i] and (fp[i] ^ fp[j]).bit_count() <= radius:
                    label[i], changed = label[j], True
    ids = {}
    for (doc_id, _), x in zip(rows, label):
        if doc_id is not None:
            ids[x] = min(ids.get(x, doc_id), doc_id)
    return sorted(((d, f"{f:016x}", ids.get(x)) for (d, _), f, x in zip(rows, fp, label)), key=repr)


def case(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(12):
        base = words(rng, rng.choice([3, 8, 60, 150])).split()
        rows.append((rng.randrange(10_000), " ".join(base)))
        for _ in range(rng.randrange(0, 6)):  # near copies
            near = list(base)
            near[rng.randrange(len(near))] = "changed"
            rows.append((rng.randrange(10_000), "\n".join(near)))
    rows += [(20_000, None), (20_001, ""), (20_002, " \t"), (20_003, "one"), (20_004, "ONE"),
             (rows[0][0], rows[0][1]), (None, "one"), (20_005, "É é é")]
    return rows


def test_as_brute_force(spark):
    for seed in (1, 2):
        rows = case(seed)
        assert table(s.components(docs(spark, rows, extra=True))) == brute(rows)


def test_large_shards_are_split(spark):
    """Trees of a few rows each, over numbers that lie close together."""
    rng = random.Random(3)
    numbers = {sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 9))) for _ in range(250)}
    numbers = [x - (1 << 64) if x >> 63 else x for x in numbers]
    df = spark.createDataFrame([(x,) for x in numbers], "fp long")
    docs(spark, [])
    roots = {}
    for size in (8, 1024):
        found = dict((r[0], r[1]) for r in s.connected(s.links(df, shard_rows=size)).collect())
        roots[size] = {x: found.get(x, x) for x in numbers}
    forest = s.Forest()
    for i, a in enumerate(numbers):
        for b in numbers[i + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                forest.join(a, b)
    assert roots[8] == roots[1024] == {x: forest.root(x) for x in numbers}


def test_tree_finds_all_within_the_radius():
    rng = random.Random(4)
    numbers = [rng.getrandbits(64) & 0xFFFF0F0F00FF0000 for _ in range(300)]
    tree = s.BKTree(numbers)
    for x in numbers[:50]:
        for radius in (0, 4, 9):
            assert set(tree.within(x, radius)) == {y for y in numbers if (x ^ y).bit_count() <= radius}
    assert s.BKTree().within(1, 4) == []


def test_long_chain_is_one_component(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    found = dict((r[0], r[1]) for r in s.connected(pairs).collect())
    assert found == {**{i: 0 for i in range(1, 301)}, 1001: 1000}


def test_one_of_each_group_stays(spark):
    rows = [r for r in case(6)]
    expected = {d for d, _, c in brute(rows) if d == c}
    kept = s.representatives(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    # The row without an id is a copy of a named one, which stays for it.
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_empty_table(spark):
    assert s.components(docs(spark, [])).count() == 0
    assert s.representatives(docs(spark, [])).count() == 0


def _kept(spark, rows):
    return sorted(((r.doc_id, r.text) for r in s.representatives(docs(spark, rows)).collect()), key=repr)


def test_one_id_with_different_texts_loses_none(spark):
    rng = random.Random(8)
    a, b = (" ".join(f"{x}{rng.randrange(10 ** 6)}" for _ in range(40)) for x in "ab")
    assert _kept(spark, [(3, b), (5, a), (5, b), (7, a)]) == [(3, b), (5, a)]


def test_rows_without_an_id_and_repeated_rows(spark):
    rng = random.Random(9)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(10 ** 6)}" for _ in range(40)) for x in "abcd")
    rows = [(None, a), (None, a), (4, a), (None, b), (None, b), (None, c), (2, d), (2, d), (2, d), (None, None), (9, ""), (9, "")]
    assert _kept(spark, rows) == sorted([(4, a), (None, b), (None, c), (2, d), (9, "")], key=repr)


def test_a_third_of_all_rows_alike(spark):
    rng = random.Random(10)
    texts = [" ".join(f"{i}-{rng.randrange(10 ** 6)}" for _ in range(30)) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, texts[3])] * 150 + [(200 + i, texts[4]) for i in range(150)]
    assert _kept(spark, rows) == sorted([(i, t) for i, t in enumerate(texts)], key=repr)
