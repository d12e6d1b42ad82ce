"""BPE with word ends against the library."""

import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tremor.llm import queries, word_bpe

PATH = P.path(queries.WORD_BPE)
ODD = [
    *"abcXYZ 'sStTdDlLmMrReEvV0129.,!?-_<|>\n\t\r\x0b\x0c\x00\x1c\x1f\x7f\x85\xa0 　éÉİıßςΣσΑǅﬁ½²٣क़হয়ऀ̣́ͅ‍​😀日本語กำ᠎",
    "<|endoftext|>", "<|startoftext|>", "  ", "'ll", "<|END", "<|endoftext|", "\U0001e900",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in queries.queries()["op12_word_bpe"](spark, sf_dir).collect()}
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert found[doc.doc_id] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(text))
    assert len(found) == len(docs)


def test_odd_texts(library, monkeypatch):
    rng = random.Random(3)
    bpe = word_bpe.WordBpe(PATH)
    monkeypatch.setattr(word_bpe, "MEMO", 500)  # so that it is emptied again and again
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 14))) for _ in range(8000)]
    for i in range(0, len(texts), 100):
        ids, counts = bpe.encode(texts[i : i + 100])
        at = 0
        for text, n in zip(texts[i : i + 100], counts, strict=True):
            expected = library.encode(text, add_special_tokens=False).ids
            assert ids[at : at + n].tolist() == expected, text
            assert bpe.decode(expected) == library.decode(expected, skip_special_tokens=False)
            at += n
    assert bpe.decode([-1, 0, 49_408, 1 << 30, 1]) == library.decode([0, 1], skip_special_tokens=False)


def test_stale_entries_are_skipped(library):
    bpe = word_bpe.WordBpe(PATH)
    for word in ("a" * 5000, "ab" * 3000, "thethethe" * 500, "ing" * 999 + "x"):
        assert bpe.ids(word) == library.encode(word, add_special_tokens=False).ids


def test_edges(spark, library):
    schema = "doc_id bigint, text string, token_ids string, decoded string, n_tokens string"
    texts = [None, "", " \n\t", "Same one.", "Same one.", "x" * 200_000, "long text " * 40_000, "<|startoftext|>a<|endoftext|>"]
    rows = [(None if i == 3 else i // 2, t, "ids", "text", "n") for i, t in enumerate(texts)]
    given = spark.createDataFrame(rows, schema)
    encoded = word_bpe.encode(given, PATH)
    found = word_bpe.decode(encoded, PATH).collect()
    assert sorted(map(str, found)) == sorted(map(str, word_bpe.encode_and_decode(given, PATH).collect()))
    assert len(found) == len(texts) and set(found[0].asDict()) == set(given.columns)
    for row in found:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.token_ids == ids and row.n_tokens == "n"
        assert row.decoded == library.decode(ids, skip_special_tokens=False)
    assert word_bpe.decode(word_bpe.encode(given.limit(0), PATH), PATH).collect() == []
    none = spark.createDataFrame([(None,), ([1, None],)], "token_ids array<int>")
    assert [r.decoded for r in word_bpe.decode(none, PATH).collect()] == [None, '"']
    with pytest.raises(ValueError):
        word_bpe.WordBpe(P.path("byte_bpe_50k.json"))
