"""Encoding against the library and exact paths; decoding as a round trip."""

import dataclasses
import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from conftest import TESTDATA
from layerflow.llm import sentencepiece as sp
from layerflow.llm.queries import QUERIES

LIBRARY = SentencePieceProcessor(model_file=sp.MODEL)
PIECES = sp.load_pieces()
TEXT = st.text(
    alphabet=st.one_of(
        st.sampled_from("aethnos  \n.,².”)'0123_"), st.characters(blacklist_categories=["Cs"])
    ),
    max_size=40,
)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_same_ids_as_the_library(text):
    words = sp.words_of(text, PIECES.rough)
    assert "".join(words) == ("▁" + text.replace(" ", "▁") if text else "")
    ids = [i for word in words for i in sp.encode_word(word, PIECES)]
    assert ids == LIBRARY.encode(text)
    assert sp.decode_ids(ids, PIECES) == text.replace("▁", " ").removeprefix(
        " " if text.startswith("▁") else ""
    ) or "▁" in text


def test_whole_table(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op7_sentencepiece"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids == LIBRARY.encode(texts[row.doc_id])
        assert row.round_trip and row.n_ids == len(row.ids)


def words_frame(spark, words):
    return spark.createDataFrame([(w,) for w in sorted(set(words))], "word string")


def test_relational_fold_gives_what_the_library_gives(spark):
    random.seed(2)
    words = {"".join(random.choices("▁thaeionrs.é0字\x07", k=random.randint(1, 24))) for _ in range(400)}
    words = {w for w in words if "▁" not in w.lstrip("▁")}
    words |= {"▁", "▁▁▁", "x" * 61, "▁international", "字", "\U0001f642"}
    got = dict(sp.encode_words(words_frame(spark, words), PIECES).collect())
    assert got == {w: sp.encode_word(w, PIECES) for w in words}


def unigram():
    pieces = {"▁": -2.5, "a": -2.0, "b": -2.25, "ab": -3.0, "ba": -3.5, "aba": -6.0, "▁a": -3.0, "bb": -9.0}
    text = ("<unk>", *pieces)
    return sp.Pieces(
        text=text,
        score=[0.0, *pieces.values()],
        merges=False,
        usable={p: i + 1 for i, p in enumerate(pieces)},
        byte_ids={},
        unknown=0,
    )


def test_viterbi_fold_finds_the_best_path(spark):
    pieces = unigram()
    words = {"".join(w) for n in range(1, 7) for w in itertools.product("ab", repeat=n)}
    words |= {"▁" + w for w in words} | {"acb", "c"}

    def best(word):
        scores = []
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            borders = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
            cut = [word[a:b] for a, b in zip(borders, borders[1:], strict=False)]
            if all(p in pieces.usable or len(p) == 1 for p in cut):
                scores.append(sum(pieces.score[pieces.usable[p]] if p in pieces.usable else -1e6 for p in cut))
        return max(scores)

    def score(ids):
        return sum(pieces.score[i] if i else -1e6 for i in ids)

    got = dict(sp.encode_words(words_frame(spark, words), pieces).collect())
    assert set(got) == words
    for word, ids in got.items():
        assert score(ids) == pytest.approx(best(word))
        assert sp.encode_word(word, pieces) == ids  # of paths with equal sums the same
        assert sum(len(pieces.text[i]) if i else 1 for i in ids) == len(word)


def test_dictionary_is_bounded_and_does_not_change_ids(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    assert sp.dictionary(docs, PIECES, size=50).count() <= 50
    assert sp.dictionary(docs, PIECES, size=1).count() <= 1
    full = dict(sp.encode(docs, PIECES, keep=["doc_id"]).collect())
    assert dict(sp.encode(docs, PIECES, size=50, keep=["doc_id"]).collect()) == full
    back = sp.decode(sp.encode(docs.withColumnRenamed("text", "t"), PIECES, text_col="t"), PIECES)
    assert back.where("text <> t OR text IS NULL").count() == 0


def test_edge_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "  two  spaces "), (3, "  two  spaces "), (None, "a"),
        (4, "q" * 30_000), (5, "long words " * 30_000), (6, "² ².x m²."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("w"))
    got = sp.encode(docs, PIECES, check_col="same").collect()
    assert sorted((r.doc_id or 0, r.ids) for r in got) == sorted(
        (i or 0, LIBRARY.encode(t or "")) for i, t in rows
    )
    assert all(r.same for r in got) and len(got) == len(rows)
    assert sp.encode(docs.limit(0), PIECES).count() == 0
    nulls = spark.createDataFrame([(None,), ([],), ([413],)], "ids array<int>")
    assert [r.text for r in sp.decode(nulls, PIECES).collect()] == [None, "", LIBRARY.decode([413])]
    with pytest.raises(ValueError):
        sp.encode(docs.withColumn("ids", F.lit(1)), PIECES)


def test_scores_of_a_merging_model_do_not_add_up():
    """Why merges are folded: the best sum of this model's scores is another cut."""
    added = dataclasses.replace(PIECES, merges=False)
    assert sp.encode_word("▁international", PIECES) == LIBRARY.encode("international")
    assert sp.encode_word("▁international", added) != LIBRARY.encode("international")


def test_long_words_take_the_heap(monkeypatch):
    random.seed(7)
    for n in (2, 50, 300):
        word = "▁" + "".join(random.choices("theinorsa0é", k=n))
        quick = sp.encode_word(word, PIECES)
        monkeypatch.setattr(sp, "SCANNED", 0)
        assert sp.encode_word(word, PIECES) == quick
        monkeypatch.setattr(sp, "SCANNED", 10**6)
        assert sp.encode_word(word, PIECES) == quick
        monkeypatch.undo()
