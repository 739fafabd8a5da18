"""Exact encoding with the ``tokenizers`` library, a distinct chunk at a time.

Both tokenizers split a text by a pattern before they merge, and no piece of
that split reaches across white space, except that the byte-level one puts a
single space in front of the word that follows.  A text whose only white space
is single spaces between words, and single line feeds between such lines, may
therefore be cut at each of them: the ids of the text are those of its chunks.
In the same way a run of letters ends where a run of punctuation begins.
Texts of any other shape, and those that hold an added token where these are
to be found, are given to the library whole.  A batch of texts is
cut at its spaces by Arrow, each distinct chunk is encoded once, and the ids
are gathered with numpy.  A worker remembers chunks: their ids stand in one
array, a dictionary says where; when it is full, those met in one batch only
go first.
"""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks that a worker remembers, some 150 bytes each.
CACHE_CHUNKS = 400_000

#: Letters that both patterns class alike and that lower-case one to one,
#: followed by marks that never join a letter.
_MARKS = ".,;:!?*$%&#|"
_WORD = re.compile(rf"([A-Za-zÀ-ÖØ-öø-ÿ]+)([{re.escape(_MARKS)}]*)")
_SPANNING = re.compile(rf"[A-Za-zÀ-ÖØ-öø-ÿ][{re.escape(_MARKS)}]")


#: How both vocabularies show bytes (fixed rule): printable ones of Latin-1 as themselves, the
#: others in order from U+0100 on.
_PRINTED = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
_SHOWN = "".join(chr(b if b in _PRINTED else 0x100 + b - sum(x < b for x in _PRINTED)) for b in range(256))
_BYTE = {c: b for b, c in enumerate(_SHOWN)}


def _spelled(token: str) -> bool:
    """Whether a token is of letters and marks that ``_WORD`` takes."""
    text = bytes(_BYTE[c] for c in token).decode("utf-8", "replace").removeprefix(" ")
    return bool(_SPANNING.search(text))


class ChunkEncoder:
    """Texts to ids.

    ``keeps_space``: the tokenizer joins a space to the word after it, and has
    an id for a line feed; else it drops white space and lower-cases.
    ``added_tokens``: an added token's string in a text, such as
    ``<|endoftext|>``, becomes its one id, as is the library's default; else it
    is text like any other.
    """

    def __init__(self, path: str, keeps_space: bool, cache_chunks: int = CACHE_CHUNKS,
                 added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.added = ""
        if added_tokens:
            found = self.tokenizer.get_added_tokens_decoder().values()
            self.added = "|".join(re.escape(t.content) for t in found)
        else:
            self.tokenizer.encode_special_tokens = True
        self.tokenize = self.tokenizer.model.tokenize
        self.keeps_space, self.cache_chunks = keeps_space, cache_chunks
        split = ByteLevel(add_prefix_space=False, use_regex=False)
        every = " " + "".join(map(chr, range(0xc0, 0x100)))
        if split.pre_tokenize_str(every)[0][0] != charmap_decode(every.encode(), "strict", _SHOWN)[0]:
            raise ValueError("the library shows bytes in another way")
        # What stands before a chunk in the text.
        self.before = " " if keeps_space else ""
        # Marks are apart from letters before merging, so both may go in one call if no
        # token spans them.
        letter, mark = "A-Za-z" + re.escape(_SHOWN[0x80:]), re.escape(_MARKS)
        spans = re.compile(f"[{letter}][{mark}]")
        words = re.compile(f"[{letter}{mark}{_SHOWN[0x20]}]+")
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.joined = keeps_space and not any(
            spans.search(t) and _spelled(t) for t in self.tokenizer.get_vocab() if t not in special and words.fullmatch(t))
        self.marks: dict[str, list[int]] = {}
        self.known: dict[str, int] = {}
        self._empty()
        self.line_feed = self._whole("\n")

    def _empty(self) -> None:
        """No remembered ids: ids, the end of each chunk's, whether the text can be cut there, batches it was in."""
        self.ids, self.ends, self.plain, self.met = array("I"), array("q"), bytearray(), array("i")

    def whole(self, text: str) -> bytes:
        """The text's ids by the library itself, as 32-bit numbers."""
        return np.array(self._whole(text), "<u4").tobytes()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _letters(self, letters: str, marks: str, space: str) -> list[int]:
        """Ids of a run of letters, ``space`` before it, and the marks after it."""
        if not self.keeps_space:
            letters = letters.lower()
        if self.joined:
            return [t.id for t in self.tokenize(charmap_decode((space + letters + marks).encode(), "strict", _SHOWN)[0])]
        ids = [t.id for t in self.tokenize(charmap_decode((space + letters).encode(), "strict", _SHOWN)[0])]
        if not marks:
            return ids
        tail = self.marks.get(marks)
        if tail is None:
            if len(self.marks) > 10_000:
                self.marks = {}
            tail = self.marks[marks] = self._whole(marks)
        return ids + tail

    def _word(self, word: str, space: str) -> list[int]:
        """Ids of a chunk without white space."""
        m = _WORD.fullmatch(word)
        return self._letters(m[1], m[2], space) if m else self._whole(space + word)

    def chunk(self, chunk: str, starts: bool) -> list[int] | None:
        """Ids of what stands between two spaces; None if the text can't be cut there."""
        words = chunk.split("\n")
        for word in words[1:] if starts and not words[0] else words:
            if word.split() != [word]:
                return None
        if starts:
            out = self._word(words[0], "") if words[0] else []
        else:
            out = self._word(words[0], self.before)
        for w in words[1:]:
            out = out + self.line_feed + self._word(w, "")
        return out

    def _remember(self, chunks: list[str]) -> None:
        """Encode new chunks."""
        match, letters, chunk, space = _WORD.fullmatch, self._letters, self.chunk, self.before
        found = [letters(m[1], m[2], space) if (m := match(x)) else chunk(x, False) for x in chunks]
        self.known.update(zip(chunks, range(len(self.ends), len(self.ends) + len(chunks))))
        self.plain += bytes([x is not None for x in found])
        sizes = np.fromiter((len(x) if x else 0 for x in found), np.int64, len(found))
        self.ends.frombytes((np.cumsum(sizes) + len(self.ids)).tobytes())
        self.ids.extend(chain.from_iterable(x for x in found if x))
        self.met.frombytes(bytes(4 * len(chunks)))

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        """The numbers of distinct chunks, new ones encoded."""
        found = list(map(self.known.get, chunks))
        if None in found:
            self._remember([x for n, x in zip(found, chunks) if n is None])
            found = list(map(self.known.get, chunks))
        found = np.array(found, np.int64)
        np.frombuffer(self.met, np.int32)[found] += 1
        return found

    def _forget(self) -> None:
        """Keep the chunks that were in most batches, half the room at most."""
        met, least = np.frombuffer(self.met, np.int32), 2
        while np.count_nonzero(met >= least) > self.cache_chunks // 2:
            least *= 2
        kept = [(x, n) for x, n in self.known.items() if met[n] >= least]
        number = np.array([n for _, n in kept], np.int64)
        ends = np.frombuffer(self.ends, np.int64)
        ids, at = self._gather(np.frombuffer(self.ids, np.uint32), ends, number)
        plain = np.frombuffer(self.plain, np.uint8)[number]
        half = (met[number] // 2).astype(np.int32)
        self._empty()
        self.ids.frombytes(ids.tobytes())
        self.ends.frombytes(at[1:].tobytes())
        self.plain += plain.tobytes()
        self.met.frombytes(half.tobytes())
        self.known = {x: i for i, (x, _) in enumerate(kept)}

    @staticmethod
    def _gather(flat: np.ndarray, ends: np.ndarray, code: np.ndarray,
                count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbers ``code`` after one another, and where each begins (and the last ends)."""
        begin = np.concatenate([[0], ends[:-1]])[code] if len(ends) else np.empty(0, np.int64)
        if count is None:
            count = ends[code] - begin
        total = np.concatenate([[0], np.cumsum(count)])
        where = np.repeat(begin - total[:-1], count)
        where += np.arange(len(where))
        return flat[where], total

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after one another, and where each text's begin.

        ``texts``: strings without nulls.  The second array has one more
        number than there are texts, the count of all ids.
        """
        n = len(texts)
        if n == 0:
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        if len(self.ends) > self.cache_chunks:
            self._forget()
        cut = pc.split_pattern(texts.cast(pa.large_string()), " ")
        at = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        number = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())  # faster than to_pylist
        plain = np.frombuffer(self.plain, np.uint8)[number].astype(bool)
        first = at[:-1]
        rest_ok = plain[code]
        rest_ok[first] = True
        ok = np.logical_and.reduceat(rest_ok, first)
        if self.added:
            ok &= ~pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False)
        # The first chunk of a text has no space before it; an odd text is one chunk.
        heads = coded.dictionary.take(pa.array(code[first])).to_numpy(zero_copy_only=False).tolist()
        own, own_ends = array("I"), array("q")
        for i, head in enumerate(heads):
            ids = self.chunk(head, True) if ok[i] else None
            if ids is None:
                ids = self._whole(texts[i].as_py())
                ok[i] = False
            own.extend(ids)
            own_ends.append(len(own))
        flat = np.concatenate([np.frombuffer(self.ids, np.uint32), np.frombuffer(own, np.uint32)])
        ends = np.concatenate([np.frombuffer(self.ends, np.int64), np.frombuffer(own_ends, np.int64) + len(self.ids)])
        code = number[code]
        code[first] = len(self.ends) + np.arange(n)
        count = np.diff(ends, prepend=0)[code]
        if not ok.all():
            alone = np.zeros(len(code), bool)
            alone[first] = True
            count[~np.repeat(ok, np.diff(at)) & ~alone] = 0
        ids, total = self._gather(flat, ends, code, count)
        return ids, total[at]


@lru_cache(maxsize=4)
def encoder(path: str, keeps_space: bool, added_tokens: bool = False) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file, kept between tasks."""
    return ChunkEncoder(path, keeps_space, added_tokens=added_tokens)
