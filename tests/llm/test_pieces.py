import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F

from vitrine.llm import pieces

MODEL = path("piece_bpe_32k.model")
ENCODER = pieces.Encoder(open(MODEL, "rb").read())
LIBRARY = ENCODER.words.library


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁aeithnor.,<s>/0x"), st.characters(exclude_categories=["Cs"], exclude_characters="\0"))))
def test_any_text_is_encoded_as_the_library_does(text):
    assert ids(ENCODER, text) == LIBRARY.encode(text)


def ids(encoder, text):
    return np.frombuffer(encoder.encode_all([text])[0], np.int32).tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("▁aeithnorszq.,0é\u4e2d"), st.characters(exclude_categories=["Cs"], exclude_characters="\0 \n")),
                        min_size=1, max_size=30), max_size=20))
def test_agendas_side_by_side_equal_a_heap_each(chunks):
    words = ENCODER.words
    assert words.merge_all(chunks) == [words.merge(c) for c in chunks]


def test_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [("long " * 50_000,), ("x" * 30_000,), (None,), ("",), (" ",), ("\n",), ("same",), ("same",)]
    extra = spark.createDataFrame(rows, "text string").select(F.lit(None).cast("long").alias("doc_id"), "text")
    df = docs.select("doc_id", "text").union(extra).withColumn("ids", F.lit(1)).withColumn("k0", F.lit(2))
    got = pieces.encode(df, MODEL, keep=("doc_id", "text", "ids"))
    assert got.columns == ["doc_id", "text", "ids", "ids", "decoded"]
    for doc_id, text, _, ids, decoded in got.collect():
        want = LIBRARY.encode(text or "")
        assert (ids, decoded) == (want, LIBRARY.decode(want))
    assert pieces.encode(df.limit(0), MODEL).count() == 0


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    rng = random.Random(1)
    fresh = pieces.Encoder(open(MODEL, "rb").read())
    for _ in range(5):
        text = " ".join("".join(rng.choice("abcde") for _ in range(6)) for _ in range(200))
        assert ids(fresh, text) == LIBRARY.encode(text) and ids(fresh, text) == LIBRARY.encode(text)


def test_a_worker_keeps_its_encoder():
    model = open(MODEL, "rb").read()
    assert pieces.encoder(model) is pieces.encoder(bytes(model)) is not pieces.encoder(model, False)


def test_a_wrong_chunk_is_an_error(monkeypatch):
    encoder = pieces.Encoder(open(MODEL, "rb").read())
    monkeypatch.setattr(encoder.words, "merge_all", lambda chunks: [np.array([5], np.int32).tobytes() for _ in chunks])
    with pytest.raises(ValueError, match="hello"):
        encoder.encode_all(["hello there"])
