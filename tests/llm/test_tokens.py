import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from refinery.llm import best_fit as b
from refinery.llm import token_files as t
from refinery.llm.common import new_folder
from refinery.llm.tokens import ChunkEncoder

from .helpers import docs, words

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n", "a", " a", "a ", "a  b", "a\nb", "\na", "a\n", "a\n\nb", "a\n b", "a\tb", "a \tb", "é\x1cb c",
       "x\x85y z", "it's a 'd thing", "ÀÉ ß.. İx ſ", "a1,b2 c. d", "été noël", "ΑΣ ΑΣ", "don't! we'll ",
       "<|endoftext|> x", "日本 語", "a b c", "　", "!!! ???", "a ̈b", "Ｆull Ⅷ ǅ", "x" * 5000]


def library(path):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,keeps", [(BYTE, True), (WORD, False)])
def test_chunks_as_the_library(path, keeps):
    rng = random.Random(1)
    whole, encoder = library(path), ChunkEncoder(path, keeps, cache_chunks=50)
    alphabet = ["a", "b", "é", " ", " ", "\n", ".", ",", "'s", "1", "\t", "Z", "ß", "́", "!", "語"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(800)]
    for at in range(0, len(texts), 100):
        ids, ends = encoder.encode(pa.array(texts[at:at + 100]))
        for i, text in enumerate(texts[at:at + 100]):
            assert ids[ends[i]:ends[i + 1]].tolist() == whole(text), repr(text)


def rows():
    rng = random.Random(2)
    out = [(rng.randrange(10_000), words(rng, rng.randrange(200))) for _ in range(30)]
    out += [(20_000 + i, x) for i, x in enumerate(ODD)] + [(30_000, None), (None, "no id"), (7, "twice"), (7, "twice"),
                                                        (40_000, words(rng, 6000))]
    return out


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_files_hold_the_ids_in_order(spark, monkeypatch):
    """Round trip: what the files give back is what the library encodes."""
    monkeypatch.setattr(t, "SHARD_BYTES", 2_000)
    whole, table = library(BYTE), rows()
    found = [tuple(r) for r in t.token_files(docs(spark, table, extra=True), BYTE).orderBy("start").collect()]
    expected, start = [], 0
    for doc_id, text in sorted(table, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*whole(text), 2]
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert found == expected


def test_one_document_from_a_shard():
    ids = [np.arange(n, dtype="<u4") for n in (3, 0, 500)]
    compress = t._compressor(b"").compress
    content = t.shard_bytes([(5, 3, compress(ids[0].tobytes())), (None, 0, compress(b"")), (9, 500, compress(ids[2].tobytes()))], b"")
    shard = t.Shard(content, b"")
    assert [shard.doc_id(i) for i in range(len(shard))] == [5, None, 9]
    assert all((shard.ids(i) == ids[i]).all() for i in range(3))
    assert t.token_count(content) == 503
    with pytest.raises(ValueError, match="another dictionary"):
        t.Shard(content, b"x")


def test_dictionary_is_used(spark):
    rng = random.Random(3)
    table = [(i, words(rng, 30, 80)) for i in range(400)]
    dictionary = t.train_dictionary(docs(spark, table), BYTE, 2)
    assert dictionary
    ids = t.encode_documents(pa.array([x for _, x in table]), BYTE, 2)
    small = sum(len(t._compressor(dictionary).compress(x.tobytes())) for x in ids)
    assert small < 0.8 * sum(len(t._compressor(b"").compress(x.tobytes())) for x in ids)


def check_packing(table, found, whole, capacity):
    """Pieces as cut by hand; sequences gapless, within capacity, not overlapping."""
    expected = []
    for doc_id, text in table:
        ids = [*whole(text), 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            expected.append((doc_id, k, a, len(part), crc(part)))
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(expected, key=repr)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(b, "RANK_BLOCK", 4)
    whole, table = library(WORD), rows()
    for capacity in (2048, 60):
        found = b.best_fit(docs(spark, table, extra=True), WORD, capacity=capacity).collect()
        sequences = check_packing(table, found, whole, capacity)
        total = sum(r.length for r in found)
        assert len(sequences) <= -(-total // capacity) * 1.15 + 1


def test_packed_ids(spark):
    whole, table = library(WORD), rows()[:40]
    placed = b.sequences(docs(spark, table), WORD, capacity=100).collect()
    assert sum(r.n_tokens for r in placed) == sum(len(whole(x)) + 1 for _, x in table)
    assert all(len(r.ids) == 4 * r.n_tokens and r.n_tokens <= 100 for r in placed)


def best_fit_by_hand(counts, capacity):
    """Each piece, longest first, to the fullest sequence that holds it; how many have each room."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [i for i, r in enumerate(rooms) if r >= length]
            if fits:
                rooms[min(fits, key=rooms.__getitem__)] -= length
            else:
                rooms.append(capacity - length)
    return sorted(rooms)


def test_plan_is_best_fit():
    """Every rank has one slot, no two slots overlap, and the rooms left are those of best-fit."""
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.choice([10, 50, 100])
        counts = {n: rng.randrange(1, 30) for n in rng.sample(range(1, capacity + 1), rng.randrange(1, 10))}
        used, ranks = {}, {}
        for length, rank, n, first, offset in b.plan(counts, capacity):
            ranks.setdefault(length, []).extend(range(rank, rank + n))
            for s in range(first, first + n):
                used.setdefault(s, []).append((offset, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in counts.items()}
        room = []
        for parts in used.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            room.append(capacity - at)
        assert sorted(room) == best_fit_by_hand(counts, capacity)


def test_empty_tables(spark):
    assert t.token_files(docs(spark, []), BYTE).count() == 0
    assert b.best_fit(docs(spark, []), WORD).count() == 0


def test_a_hot_id_fills_several_ranges(spark, monkeypatch):
    """Rows of one id, or of none, are dealt over ranges, in the order of ids."""
    monkeypatch.setattr(t, "SORT_BYTES", 1 << 10)
    rng = random.Random(12)
    rows = [(7, words(rng, 30)) for _ in range(400)] + [(None, words(rng, 30)) for _ in range(300)] + [(i, words(rng, 5)) for i in range(20)]
    path = new_folder(spark, "hot")
    found = t.token_files(docs(spark, rows), BYTE, path=path).orderBy("start").collect()
    ids = [r.doc_id for r in found]
    assert ids == [None] * 300 + sorted(i for i, _ in rows if i is not None)
    assert spark.read.parquet(f"{path}/shards").select("part").distinct().count() >= 8
    whole = library(BYTE)
    expected = sorted(zlib.crc32(np.array(whole(x) + [2], "<u4").tobytes()) for _, x in rows)
    assert sorted(r.ids_crc32 for r in found) == expected


def test_remembered_chunks_are_let_go(monkeypatch):
    """Frequent chunks stay, the room is kept to, and ids stay right."""
    encoder, whole, rng = ChunkEncoder(BYTE, True, cache_chunks=300), library(BYTE), random.Random(3)
    for _ in range(12):
        texts = [" ".join(["often", *(f"w{rng.randrange(10 ** 5)}" for _ in range(200))]) for _ in range(3)]
        ids, at = encoder.encode(pa.array(texts))
        for i, x in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == whole(x)
        assert len(encoder.known) == len(encoder.ends) == len(encoder.met) == len(encoder.plain) <= 300 + 700
