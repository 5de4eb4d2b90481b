import os
import zlib

import numpy as np
from llm.rows import documents, odd_documents

from ferryline.llm.queries import END_ID, tokenizer_file
from ferryline.llm.token_files import read_tokens, write_tokens
from ferryline.sources.collections import table

MODEL = "byte_bpe_50k.json"


def check(spark, docs, folder):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file(MODEL))
    plain.encode_special_tokens = True
    write_tokens(docs, folder, tokenizer_file(MODEL), END_ID)
    got = read_tokens(spark, folder).orderBy("start").collect()
    rows = docs.collect()
    assert len(got) == len(rows)
    want = {}
    for r in rows:
        ids = plain.encode(r.text or "", add_special_tokens=False).ids + [END_ID]
        want.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    at = 0
    for r in got:
        assert r.start == at
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    ids = [(-1 if r.doc_id is None else r.doc_id) for r in got]
    assert ids == sorted(ids)
    return got


def test_files_hold_the_library_ids(spark, tmp_path):
    check(spark, table(spark, "/root/testdata/sf0.001", "documents"), f"{tmp_path}/t")
    names = sorted(os.listdir(f"{tmp_path}/t/parts"))
    assert not [n for n in names if n.startswith("draft")]
    assert {n.split(".")[-1] for n in names} == {"ids", "offsets", "docs"}


def test_odd_rows(spark, tmp_path):
    check(spark, odd_documents(spark), f"{tmp_path}/t")
    check(spark, documents(spark, ["  two  spaces ", "a\n b\n\n  c", " ", "  x  y", "it's we'll  '", "<|endoftext|> x", "\x1c \x1c a"]),
          f"{tmp_path}/s")
    assert check(spark, documents(spark, []), f"{tmp_path}/e") == []
