import random

import pytest
from llm.rows import documents, odd_documents
from pyspark.sql import functions as F

from ferryline.llm import lattice
from ferryline.llm.queries import tokenizer_file
from ferryline.sources.collections import table


@pytest.fixture(scope="module")
def model():
    return tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library(model):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def highest_sum(text, pieces):
    """Ids of the path of the highest sum over a whole text, cut nowhere."""
    table = {p: (i, s) for p, i, s in pieces.rows}
    best = [(0.0, [])]
    for last in range(1, len(text) + 1):
        top = None
        for first in range(max(0, last - pieces.longest), last):
            found = table.get(text[first:last])
            if found is None and first == last - 1:
                found = (-1, pieces.lowest - lattice.UNKNOWN_PENALTY)
            if found and (top is None or best[first][0] + found[1] > top[0]):
                ids = [found[0]] if found[0] >= 0 else [pieces.byte_ids[b] for b in text[first].encode()]
                top = (best[first][0] + found[1], first, ids)
        best.append((top[0], (top[1], top[2])))
    out, at = [], len(text)
    while at:
        at, ids = best[at][1]
        out = ids + out
    return out


def encoded(docs, folder, model, fold):
    return [(r.text, r.ids) for r in lattice.encode(docs, folder, model, fold=fold).collect()]


TEXTS = ["a", "  two  spaces ", "☃𝔘é naïve 中文", "tab\tand\nline", "x" * 50 + " 1234567890", "---- ==== ####",
         "thereare hesten. theable, internationalization", "    indented\n\n        more"]


def test_merges_equal_the_library(spark, tmp_path, model, library):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    for text, ids in encoded(docs, f"{tmp_path}/a", model, "merges"):
        assert ids == library.encode(text)
    for text, ids in encoded(documents(spark, TEXTS), f"{tmp_path}/b", model, "merges"):
        assert ids == library.encode(text)


def test_viterbi_has_the_highest_sum(spark, tmp_path, model):
    pieces = lattice.read_pieces(model)
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", F.substring("text", 1, 300).alias("text"))
    for frame, name in ((docs, "a"), (documents(spark, TEXTS), "b")):
        for text, ids in encoded(frame, f"{tmp_path}/{name}", model, "viterbi"):
            assert ids == highest_sum(lattice.shown(text), pieces)


@pytest.mark.parametrize("fold", ["viterbi", "merges"])
def test_long_words_take_the_same_path(spark, tmp_path, model, monkeypatch, fold):
    dice = random.Random(5)
    texts = ["".join(dice.choice("abcderst☃é1") for _ in range(dice.randint(30, 90))) for _ in range(40)]
    folded = sorted(encoded(documents(spark, texts), f"{tmp_path}/a", model, fold))
    monkeypatch.setattr(lattice, "LONGEST_FOLDED", 20)
    assert sorted(encoded(documents(spark, texts), f"{tmp_path}/b", model, fold)) == folded


def test_round_trip_and_odd_rows(spark, tmp_path, model):
    docs = odd_documents(spark)
    out = lattice.encode(docs, f"{tmp_path}/a", model, fold="merges")
    rows = lattice.decode(out, model).collect()
    assert len(rows) == docs.count() and out.columns == [*docs.columns, "ids"]
    assert all(r.decoded == (r.text or "") for r in rows)
    assert lattice.encode(documents(spark, []), f"{tmp_path}/b", model).count() == 0
