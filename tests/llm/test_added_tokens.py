"""Added tokens' strings in texts, as the library encodes them by default."""

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from refinery.llm.edit_counts import CountedText
from refinery.llm.queries import BYTE_BPE, QUERIES, WORD_BPE
from refinery.llm.tokens import ChunkEncoder

from .helpers import docs

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y  <|startoftext|>\nz", "<|ENDOFTEXT|> q", "<|endoftext| >", "plain words",
         "", "<|endoftext|><|endoftext|> a.", "two  spaces <|endoftext|>", "words " * 200 + "<|endoftext|> " + "more " * 200]


@pytest.mark.parametrize("path,keeps", [(BYTE_BPE, True), (WORD_BPE, False)])
def test_as_the_untouched_library(path, keeps):
    tok = Tokenizer.from_file(path)
    ids, ends = ChunkEncoder(path, keeps, added_tokens=True).encode(pa.array(TEXTS))
    for i, text in enumerate(TEXTS):
        assert ids[ends[i]:ends[i + 1]].tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_queries_take_them_as_one_id(spark, tmp_path):
    docs(spark, list(enumerate(TEXTS))).write.parquet(f"{tmp_path}/documents.parquet")
    for query, path, column, more in (("op2_edit_counts", BYTE_BPE, "n_tokens_before", 0), ("op7_token_files", BYTE_BPE, "n_tokens", 1),
                                      ("op8_best_fit", WORD_BPE, "length", 1)):
        tok = Tokenizer.from_file(path)
        found = {}
        for r in QUERIES[query](spark, str(tmp_path)).collect():
            found[r.doc_id] = found.get(r.doc_id, 0) + r[column]
        assert found == {i: len(tok.encode(t, add_special_tokens=False).ids) + more for i, t in enumerate(TEXTS)}, query


def test_edits_that_make_and_break_one():
    tok = Tokenizer.from_file(BYTE_BPE)
    doc = CountedText("word " * 80 + "<|endof|> " + "word " * 80, ChunkEncoder(BYTE_BPE, True, added_tokens=True))
    for start, end, new in ((407, 407, "text"), (402, 403, "")):
        doc.edit(start, end, new)
        assert doc.total == len(tok.encode(doc.text, add_special_tokens=False).ids), doc.text[395:420]
