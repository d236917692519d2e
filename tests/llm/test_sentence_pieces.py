"""Prefix-table encoding against the sentencepiece library."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from collatio.llm import queries, sentence_pieces

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = sentence_pieces.Pieces(PATH)
NAMES = sorted(PIECES.ids)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="ab ▁\n\t\r\x00é漢\U0001f600<>s/0xA", max_size=80)))
def test_any_text(text):
    assert PIECES.encode(text).tolist() == LIBRARY.encode(text)


def test_strings_of_pieces():
    rng = random.Random(7)
    for _ in range(4000):
        text = "".join(rng.choices(NAMES, k=rng.randint(0, 12)))
        assert PIECES.encode(text).tolist() == LIBRARY.encode(text) and PIECES.encode(text.replace("▁", " ")).tolist() == LIBRARY.encode(text.replace("▁", " "))


def test_long_units_and_forgetting(monkeypatch):
    rng = random.Random(2)
    long = "".join(rng.choices("abcdefghij", k=100_000))
    texts = [long, f"a {long[:500]} b {long[:500]}", " " * 5000, "\n" * 3000, "🙂" * 2000]
    assert [PIECES.encode(t).tolist() for t in texts] == [LIBRARY.encode(t) for t in texts]
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 50)
    monkeypatch.setattr(sentence_pieces, "REMEMBERED_PAIRS", 50)
    fresh = sentence_pieces.Pieces(PATH)
    texts = [" ".join("".join(rng.choices("abcde", k=4)) for _ in range(60)) for _ in range(40)]
    assert [fresh.encode(t).tolist() for t in texts] == [LIBRARY.encode(t) for t in texts]
    assert len(fresh.known) < 200 and len(fresh.pairs) < 200


def test_last_tokens_are_unique():
    """What the table rests on: of the pieces that end somewhere only one goes together with the last token before it."""
    text = "▁unbelievably▁international"
    last = [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        fits = {i for p, i in PIECES.ids.items() if text[:end].endswith(p) and PIECES.together(last[end - len(p)], i)}
        assert len(fits) == 1
        last[end] = fits.pop()
        assert LIBRARY.id_to_piece(last[end]) == LIBRARY.encode(text[1:end], out_type=str)[-1] if end > 1 else True


def test_rows(spark):
    texts = [None, "", " ", "a", "a  b", "Hello world\nnext", "▁", "</s>", "word " * 20_000, "x" * 5000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "a"), (3, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "'x' AS decoded")
    read = sentence_pieces.decode(sentence_pieces.encode(docs, PATH), PATH).collect()
    expected = [(i, [*LIBRARY.encode(t or ""), 2], LIBRARY.decode([*LIBRARY.encode(t or ""), 2])) for i, t in rows]
    assert sorted(map(repr, map(tuple, read))) == sorted(map(repr, expected))
    bare = sentence_pieces.encode(docs, PATH, ids_col="tokens", end_id=None)
    assert bare.columns == ["doc_id", "tokens"] and [] in [r.tokens for r in bare.collect()]
    assert sentence_pieces.encode(docs.limit(0), PATH).collect() == []
    kept = sentence_pieces.decode(spark.createDataFrame([(None, "q"), ([], "r")], "ids array<int>, other string"), PATH).collect()
    assert [tuple(r) for r in kept] == [(None, "q", None), ([], "r", "")]
    with pytest.raises(ValueError, match="decoded"):
        sentence_pieces.decode(sentence_pieces.encode(docs, PATH).withColumn("Decoded", F.lit(1)), PATH)


def test_query(spark):
    found = {r.doc_id: tuple(r)[1:] for r in queries.op13_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    for i, text in docs:
        ids = [*LIBRARY.encode(text or ""), 2]
        assert found[i] == (len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids)))
    assert len(found) == len(docs)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab  .,;²é2▁\n\t\x00漢", max_size=30), max_size=8))
def test_columns_of_texts(texts):
    import pyarrow as pa

    assert [x.tolist() for x in PIECES.encode_all(pa.array(texts, pa.string()))] == [LIBRARY.encode(t) for t in texts]
    assert PIECES.columnar


def test_new_units_are_encoded_side_by_side(monkeypatch):
    """Plain words go through arrays; only those with unknown signs and long ones go one by one."""
    rng = random.Random(5)
    words = list({"".join(rng.choices(["en", "th", "é", "ß", "zu", "tion", "$", "A", "7", "▁", "Ⅷ🙂"], k=rng.randint(1, 20))) for _ in range(3000)})
    expected = [PIECES.ids_of(w) for w in words]
    monkeypatch.setattr(sentence_pieces, "SIDE_BY_SIDE", 700)
    fresh, apart = sentence_pieces.Pieces(PATH), []
    one = fresh.ids_of
    monkeypatch.setattr(fresh, "ids_of", lambda unit: apart.append(unit) or one(unit))
    ids, ends = fresh.gathered(fresh.numbers([words])[0])
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == expected
    assert sorted(apart) == sorted(w for w in words if "Ⅷ" in w or len(w) > 64) != []


def test_columns_of_strings_of_pieces():
    import pyarrow as pa

    rng = random.Random(8)
    texts = ["".join(rng.choices(NAMES, k=rng.randint(0, 12))).replace("▁", " ") for _ in range(8000)]
    assert [x.tolist() for x in sentence_pieces.Pieces(PATH).encode_all(pa.array(texts))] == LIBRARY.encode(texts)


def test_lists_of_numbers():
    import pyarrow as pa

    column = pa.array([[1, 2], None, [], [3], [4, 5, 6]], pa.list_(pa.int32()))
    for lo in range(5):
        assert sentence_pieces.lists_of(column.slice(lo, 3)) == column.slice(lo, 3).to_pylist()
    assert type(sentence_pieces.lists_of(column)[0][0]) is int
