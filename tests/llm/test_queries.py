"""The registered queries on the smallest tables, against brute force or the libraries."""

import base64
import zlib
from collections import Counter
from itertools import groupby

import public_tokenizers as P
import pytest

import corpus_pipeline
from tests.llm import brute
from tremor.llm import queries, quality
from tremor.llm.bpe import ByteBpe


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    return {row.doc_id: row for row in rows}


@pytest.fixture(scope="module")
def items(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    return [(row.item_id, row.text) for row in rows]


def _result(spark, sf_dir, name):
    return queries.queries()[name](spark, sf_dir).collect()


def test_chat(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    turns = sorted((r.conv_id, r.turn, r.role, r.text or "") for r in rows)
    turns += [(-1, 0, "user", queries.ADVERSE), (-1, 1, "assistant", queries.ADVERSE)]
    expected = {}
    for conv, group in groupby(turns, key=lambda t: t[0]):
        group = list(group)
        loss = "".join(t[3] for t in group if t[2] == "assistant")
        text = "".join(f"{t[2]}\n{t[3]}\n" for t in group)
        expected[conv] = (len(group), brute.sha(text), len(loss), brute.sha(loss))
    found = {r.conv_id: tuple(r)[1:5] for r in _result(spark, sf_dir, "op1_chat_format")}
    assert found == expected


def test_suffix_dedup(spark, sf_dir, docs):
    data = [(key, (row.text or "").encode()) for key, row in docs.items()]
    masks = brute.repeats(data)
    expected = {}
    for key, text in data:
        mask = masks[key]
        spans = sum(1 for i in range(len(mask)) if mask[i] and not (i and mask[i - 1]))
        expected[key] = (len(text), sum(mask), spans, brute.sha(brute.kept_bytes(text, mask)))
    found = {r.doc_id: tuple(r)[1:] for r in _result(spark, sf_dir, "op4_suffix_dedup")}
    assert found == expected
    assert any(x[1] for x in expected.values())


def test_byte_bpe(spark, sf_dir, docs):
    tiktoken = pytest.importorskip("tiktoken")
    with open(P.path(queries.BYTE_RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for row in _result(spark, sf_dir, "op6_byte_bpe"):
        text = docs[row.doc_id].text or ""
        ids = library.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == brute.sha(",".join(map(str, ids)))
        assert row.decoded_sha256 == brute.sha(text)


def test_token_files(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(P.path(queries.WORD_BPE))
    start, expected = 0, {}
    for key in sorted(docs):
        ids = library.encode(docs[key].text or "", add_special_tokens=False).ids + [queries.END_ID]
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[key] = (start, len(ids), zlib.crc32(data))
        start += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in _result(spark, sf_dir, "op7_token_files")} == expected


def test_quality_removes_lines_of_a_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source", "text")
    count, hosts, lines = Counter(), Counter(), {}
    for row in table.toLocalIterator():
        found = [x for x in (row.text or "").split("\n") if brute.PLAIN.search(x)]
        lines[row.doc_id] = row.source, [brute.lower(" ".join(brute.PLAIN.findall(x))) for x in found]
        hosts[row.source] += 1
        count.update({(row.source, x) for x in lines[row.doc_id][1]})
    bad = {
        x for x, n in count.items() if n >= quality.MIN_DOCUMENTS and n > quality.MOST_SHARE * hosts[x[0]]
    }
    assert {source for source, _ in bad} == set(hosts)
    expected = {
        key: sum(len(x.split(" ")) for x in own if (source, x) in bad) for key, (source, own) in lines.items()
    }
    found = {r.doc_id: r.n_removed_words for r in quality.judge(table).collect()}
    assert found == expected and any(expected.values())


def test_quality_rejects_depleted_documents(spark):
    verdicts = queries.queries()["op5_quality_rules"](spark, "/root/testdata/sf0.01").collect()
    assert any(r.n_removed_words for r in verdicts)
    # The method's own verdict: documents that pass the base rules and go for their lines.
    assert any(r.kept == r.base_failed for r in verdicts)


def test_ngram_join(spark, sf_dir, docs):
    expected = brute.components([(k, r.text) for k, r in docs.items()], 4, 85)
    assert {r.doc_id: tuple(r)[1:] for r in _result(spark, sf_dir, "op9_ngram_join")} == expected
    assert len({c for _, c in expected.values()}) < len(expected)


def test_token_counts(spark, sf_dir, docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=P.path(queries.PIECE_BPE))
    for row in _result(spark, sf_dir, "op10_token_counts"):
        text = docs[row.doc_id].text or ""
        n = len(library.encode(text))
        assert tuple(row)[1:] == (len(text.encode()), n, n > queries.MOST_TOKENS)


def test_pipeline(spark, sf_dir, docs, items):
    expected = {k: (r.source, r.text) for k, r in docs.items()}
    limits = (quality.MIN_DOCUMENTS, quality.MOST_SHARE, quality.MOST_REMOVED)
    kept = brute.quality([(k, *v) for k, v in expected.items()], *limits)
    first = {c for _, c in brute.components(kept.items(), 5, 80).values()}
    kept = {k: text for k, text in kept.items() if k in first}
    data = [(k, text.encode()) for k, text in kept.items()]
    masks = brute.repeats(data)
    cut = {k: brute.kept_bytes(text, masks[k]).decode(errors="ignore") for k, text in data}
    cut = {k: text for k, text in cut.items() if text.strip(" ") or not kept[k]}
    hits = brute.contamination(cut.items(), items)
    expected = {k: text for k, text in cut.items() if not hits[k][1]}
    bpe = ByteBpe.load(P.path(corpus_pipeline.RANKS), P.PATTERN)
    result = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: r.text for r in result} == expected
    for row in result:
        assert row.token_ids == bpe.encode([row.text])[0].tolist()
        assert row.n_tokens == len(row.token_ids)
        assert row.n_chars == len(row.text)
    assert 0 < len(expected) < len(cut) < len(kept) + 1 < len(docs)


