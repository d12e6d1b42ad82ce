"""Alignment against the libraries and a plain reading of offsets."""

import random

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm import brute
from tremor.llm import alignment, queries

PATHS = P.path(queries.BYTE_BPE), P.path(queries.PIECE_BPE)
ODD = [*"abcXYZ 'sStTdDlLmMrReEvV01.,!?-_<|>\n\t\r\x00\x85\xa0 　éÉßΣ½²٣क़হ̣́😀日本語", "<|endoftext|>", "<s>", "'ll", " the"]


@pytest.fixture(scope="module")
def encode():
    hf = Tokenizer.from_file(PATHS[0])
    hf.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    made = alignment.tokenizers(*PATHS)

    def both(text):
        if not text:
            return [], []
        a = hf.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        sides = [(i, made.bytes_a[i]) for i in a], [(i, made.bytes_b[i]) for i in b]
        same = all(b"".join(x for _, x in side) == (" " + text).encode() for side in sides)
        return sides if same else ([], [])

    return both


def _rows(result):
    return {r.doc_id: tuple(r)[1:] for r in result.collect()}


def test_whole_table(spark, sf_dir, encode):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = brute.alignment_report([d.text for d in docs], encode)
    result = _rows(queries.queries()["op11_alignment"](spark, sf_dir))
    assert result == dict(zip((d.doc_id for d in docs), expected, strict=True))
    assert any(0 < x[4] < x[3] for x in expected) and any(x[2] < x[1] for x in expected)


def test_vocabulary_is_checked():
    alignment.check_byte_level(PATHS[0])
    with pytest.raises(ValueError):
        alignment.check_byte_level(P.path(queries.WORD_BPE))


def test_edges(spark, encode, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 50))) for _ in range(400)]
    # A sign that the second tokenizer takes for a blank: no tokens. Nothing, and long texts.
    texts += ["a ▁ b", "▁", "", None, None, " ", "x" * 100_001 + "yz" * 20_000, "the cat " * 30_000, "same", "same"]
    schema = "doc_id bigint, text string, n_a string, block string, a_ids string"
    rows = [(None if i == 3 else i // 2, t, "n", "b", "i") for i, t in enumerate(texts)]
    given = spark.createDataFrame(rows, schema).repartition(3)
    expected = brute.alignment_report([t or "" for t in texts], encode)
    wanted = sorted(zip([r[0] for r in rows], expected, strict=True), key=str)
    # Small blocks, and few of them to a task, give the same.
    for block, summed in ((alignment.BLOCK, alignment.SUMMED), (5_000, 2)):
        monkeypatch.setattr(alignment, "BLOCK", block)
        monkeypatch.setattr(alignment, "SUMMED", summed)
        found = alignment.measure(given, *PATHS)
        assert sorted(((r.doc_id, tuple(r)[1:]) for r in found.collect()), key=str) == wanted
        assert alignment.measure(given.limit(0), *PATHS).collect() == []
    made = alignment.align(given, *PATHS)
    assert made.columns == ["doc_id", "text", "n_a", "block", "a_ids", "b_ids", "a_sizes", "b_sizes"]
    for row in made.collect():
        groups, _ = brute.alignment(*encode(row.text or ""))
        assert (row.n_a, row.block) == ("n", "b")
        assert row.a_sizes == [len(a) for a, _ in groups] and row.b_sizes == [len(b) for _, b in groups]
        assert (row.a_ids, row.b_ids) == tuple(sum((g[k] for g in groups), []) for k in (0, 1))
