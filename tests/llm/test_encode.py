import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lodeweave.llm.encode import EncodedText, encode_texts, encoder, token_counts, vocabulary_path

MIXED = st.text(alphabet="abceinrst  \n\t'’.,;:-0123<|>é日本語ßΩ🏈​", max_size=60)


@pytest.fixture(scope="module")
def peer():
    known = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    known.encode_special_tokens = True
    return lambda text: known.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=300)
@given(st.one_of(MIXED, st.text(max_size=40)))
def test_equals_the_public_tokenizer(peer, text):
    text = text.encode("utf-8", "ignore").decode()
    assert encoder().encode(text) == peer(text) and encoder().decode(encoder().encode(text)) == text


@settings(deadline=None, max_examples=150)
@given(MIXED, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), MIXED), max_size=4))
def test_edits_and_appends_are_exact(text, edits):
    held = EncodedText(encoder(), text)
    for a, b, new in edits:
        start, stop = sorted((min(a, len(held.text)), min(b, len(held.text))))
        held.edit(start, stop, new)
        assert held.ids == encoder().encode(held.text)
    held.append(" and more")
    assert held.ids == encoder().encode(held.text)


def test_an_edit_touches_only_its_neighbourhood():
    held = EncodedText(encoder(), "one two three " * 5000)
    before = held.touched
    held.edit(30_000, 30_003, "seven")
    held.append("end")
    assert held.ids == encoder().encode(held.text) and held.touched - before < 100


def test_last_tokens_store_the_encoding_of_every_prefix():
    data = "internationalisations".encode()
    last = encoder().extend(data, [])
    for end in range(1, len(data) + 1):
        assert encoder().spell(last[:end]) == encoder().merged(data[:end])


def test_long_pieces_nulls_and_extra_columns(spark, peer):
    texts = [None, "", " ", "x" * 5000, "日本" * 800, "<|endoftext|>", "a\r\nb \u0000"]
    df = spark.createDataFrame([(i, t, i, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens long, note string")
    rows = {r.doc_id: r.ids for r in encode_texts(df).collect()}
    assert rows == {i: peer(t) if t else [] for i, t in enumerate(texts)}
    counts = {r.doc_id: r.n for r in token_counts(df, out="n").collect()}
    assert counts == {i: len(v) for i, v in rows.items()}
    assert encode_texts(df.limit(0)).count() == 0
    assert {r.doc_id: r.note for r in encode_texts(df, out="note").collect()} == rows
