"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tremor.llm import (
    bpe,
    chat,
    decontaminate,
    ngram_join,
    piece_counts,
    quality,
    queries,
    shards,
    suffix_dedup,
    suffixes,
    token_files,
    warc,
)
from tremor.llm.components import components
from tremor.llm.suffixes import suffix_arrays
from tremor.sinks import scratch_path, stored

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "n_words bigint, kept string, __row string, shard string, token_ids string"
)
PROSE = " ".join(f"word{i}" for i in range(60))
BENCH = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [
    (1, PROSE),
    (2, PROSE),
    (2, PROSE),
    (3, None),
    (4, ""),
    (5, PROSE + " and a tail"),
    (6, "é" * 120 + " " + " ".join(f"längeres{i}" for i in range(70))),
    (7, f"before {' '.join(f'b{i}' for i in range(55))} {BENCH.upper()}, after"),
    (8, "long" + "x" * 200_000),
    (9, " \n\t "),
    (None, " ".join(f"other{i}" for i in range(55))),
    (10, "Tail first. " + PROSE[20:300]),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(key, text, "en", "h", len(text or ""), 1, "k", "r", "s", "t") for key, text in TEXTS]
    return stored(spark.createDataFrame(rows, SCHEMA).coalesce(1), "edges")


@pytest.fixture(scope="module")
def none(docs):
    return stored(docs.limit(0), "none")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, BENCH), (2, "b3 b4"), (None, "b5"), (3, None), (4, "..."), (1, BENCH)]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def _same_columns(result, docs):
    assert result.dtypes == docs.dtypes
    assert all(tuple(r)[5:] == (1, "k", "r", "s", "t") for r in result.collect())


def test_chat(spark):
    rows = [
        (1, 0, "user", "<|im_end|> a <\\| b <|", 9),
        (1, 0, "user", "<|im_end|> a <\\| b <|", 9),
        (1, None, None, None, 9),
        (1, 1, "assistant", "", 9),
        (None, 1, "assistant", "é" * 3_000_000, 9),
        (None, 2, "assistant", "x", 9),
    ]
    schema = "conv_id bigint, turn bigint, role string, text string, part int"
    given_ = spark.createDataFrame(rows, schema)
    made = chat.format_conversations(given_)
    chunks = made.filter("conv_id = 1").orderBy("part", "chunk").collect()
    found = [turn for chunk in chunks for turn in chat.parse(chunk.formatted)]
    assert found == [("", ""), ("user", rows[0][3]), ("user", rows[0][3]), ("assistant", "")]
    read = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert read[None].n_turns == 2 and read[None].loss_chars == 3_000_001
    assert read[None].loss_sha256 == brute.sha("é" * 3_000_000 + "x")
    assert chat.read_back(chat.format_conversations(given_.limit(0))).collect() == []


def test_shards(docs, none):
    placed = shards.place(docs, "doc_id", ["a", "b", "c"], 101)
    rows = placed.collect()
    assert len(rows) == len(TEXTS) and placed.columns[-3:] == ["slot", "shard", "shard_name"]
    assert len({r.shard for r in rows if r.doc_id == 2}) == 1
    assert shards.place(none, "doc_id", ["a"], 2).collect() == []
    # Frames that are no table: a range, a union of scans, an aggregate.
    spark = docs.sparkSession
    for frame in (spark.range(9), docs.union(docs), docs.groupBy("doc_id").count()):
        key = frame.columns[0]
        assert shards.place(frame, key, ["a", "b"], 101).count() == frame.count()
    text = shards.place(stored(docs, "s"), "doc_id", ["a", "b"], 101)._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("FileScan") == 1 and physical.count("BroadcastHashJoin") == 1
    table = shards.fill_table([str(i) for i in range(7)], 701)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    fewer = shards.fill_table([str(i) for i in range(6)], 701)
    assert sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6) < 100
    with pytest.raises(ValueError):
        shards.fill_table(["a", "a"], 101)


def test_decontamination(docs, none, benchmark):
    expected = brute.contamination(
        enumerate(t for _, t in TEXTS), [(i, t) for i, t in ((1, BENCH), (2, "b3 b4"), (None, "b5"))]
    )
    found = decontaminate.find_hits(docs, benchmark).orderBy("__row").collect()
    for row, (words, places, items) in zip(found, expected.values(), strict=True):
        assert (row.n_words, row.hit_words) == (words, places)
        assert row["items"] == [x for x in items if x != "None"]
    rest = decontaminate.remove_documents(docs, benchmark)
    assert rest.filter("doc_id = 7").isEmpty() and rest.count() == len(TEXTS) - 1
    _same_columns(rest, docs)
    cut = decontaminate.remove_spans(docs, benchmark)
    _same_columns(cut, docs)
    [text] = [r.text for r in cut.collect() if r.doc_id == 7]
    assert "ELEVEN" not in text and " b3 " not in text and text.endswith(" b54, after")
    assert decontaminate.find_hits(none, benchmark).collect() == []
    clean = decontaminate.find_hits(docs, benchmark.limit(0)).collect()
    assert len(clean) == len(TEXTS) and not any(r.hit_words for r in clean)


def test_a_large_benchmark_gives_the_same(docs, benchmark, monkeypatch):
    spark = docs.sparkSession
    few = decontaminate.find_hits(docs, benchmark).orderBy("__row").collect()
    # A filter that lets most windows through, and tables that are shuffled.
    monkeypatch.setattr(decontaminate, "FILTER_WORDS", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert decontaminate.find_hits(docs, benchmark).orderBy("__row").collect() == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_window_filter(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "FILTER_WORDS", 8)
    known = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a b")], "size int, window string")
    [(numbers,)] = decontaminate.window_filter(known, [1, 2]).collect()
    expected = [0] * 8
    for query in ("xxhash64('a')", "xxhash64('b')", "xxhash64(xxhash64('a'), xxhash64('b'))"):
        key = spark.range(1).selectExpr(query).head()[0] % (1 << 64)
        expected[key % 8] |= 1 << (key >> 58) | 1 << (key >> 52 & 63)
    assert [n % (1 << 64) for n in numbers] == expected
    empty = decontaminate.window_filter(known.limit(0), []).head()[0]
    assert empty == [0] * 8


def test_no_row_carries_the_filter(docs, benchmark, monkeypatch):
    made = []
    monkeypatch.setattr(decontaminate, "settled", lambda spark, name, build: made.append(build()) or made[0])
    text = decontaminate.find_hits(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "lambda q" in text and "AS __filter" not in text and "Subquery" in text


def test_suffix_dedup(docs, none):
    data = [(-1 if k is None else k, (t or "").encode()) for k, t in TEXTS]
    numbered = dict(enumerate(data))
    first = {}
    for key, text in sorted(data):
        for i in range(len(text) - 49):
            first.setdefault(text[i : i + 50], key)
    found = suffix_dedup.find_repeats(docs).orderBy("__row").collect()
    for row, (key, text) in zip(found, numbered.values(), strict=True):
        mask = bytearray(len(text))
        for i in range(len(text) - 49):
            if first[text[i : i + 50]] < key:
                mask[i : i + 50] = b"\x01" * 50
        kept = brute.kept_bytes(text, mask)
        whole = b"" if row.copy else text
        assert (row.kept_sha256 or brute.sha(whole)) == brute.sha(kept)
    cleaned = suffix_dedup.deduplicate(docs)
    _same_columns(cleaned, docs)
    assert [r.text for r in cleaned.collect() if r.doc_id == 5] == [" and a tail"]
    assert suffix_dedup.deduplicate(none).collect() == []


def test_characters_go_whole(spark):
    shared = "б" * 25 + "".join(chr(0x430 + i % 31) for i in range(40))
    texts = ["\u0430" + shared + "\u0444", "own \ufffd text \u0440" + shared + "\u0434 tail \ufffd"]
    made = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    found = {r.doc_id: r.text for r in suffix_dedup.deduplicate(made).collect()}
    assert found == {0: texts[0], 1: "own \ufffd text \u0440\u0434 tail \ufffd"}
    data = np.frombuffer("аб".encode(), np.uint8)
    assert suffix_dedup._whole_characters(data, np.array([0, 1, 1, 0], bool)) == b""


def test_hot_strings_give_the_same(docs, monkeypatch):
    plain = suffix_dedup.find_repeats(docs).orderBy("__row").collect()
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    assert suffix_dedup.find_repeats(docs).orderBy("__row").collect() == plain


@pytest.mark.parametrize("together", [1, 3, 16, 10_000])
def test_suffix_arrays_in_step_and_alone(together, monkeypatch):
    monkeypatch.setattr(suffixes, "TOGETHER", together)
    random = np.random.default_rng(3)
    for letters in (2, 4, 200):
        sizes = [*random.integers(0, 30, 60).tolist(), 900, 2, 400]
        texts = [[*random.integers(1, letters, n).tolist(), 0] for n in sizes]
        texts[5] = [1] * 50 + [0]
        symbols = np.array([c for text in texts for c in text], np.uint16)
        order, bounds = suffix_arrays(symbols, np.array([len(t) for t in texts]))
        for i, text in enumerate(texts):
            expected = sorted(range(len(text)), key=lambda k, t=text: t[k:])
            assert (order[bounds[i] : bounds[i + 1]] - bounds[i]).tolist() == expected


def test_a_much_longer_text_takes_its_steps_alone(monkeypatch):
    in_step, groups = [], suffixes._groups
    monkeypatch.setattr(suffixes, "_groups", lambda s, *given: in_step.append(len(s)) or groups(s, *given))
    lengths = np.array([10] * 40 + [5_000])
    symbols = np.random.default_rng(4).integers(1, 5, lengths.sum(), np.uint16)
    symbols[np.cumsum(lengths) - 1] = 0
    suffix_arrays(symbols, lengths)
    assert in_step == [400]


def test_ends_that_no_other_segment_has_are_not_sorted(monkeypatch):
    core = bytes(range(60))
    texts = pa.array([b"x" * 5 + core, core + b"y" * 7, core + b"x" * 5], pa.binary())
    sorted_ = []
    monkeypatch.setattr(suffix_dedup, "_settle", lambda *given: sorted_.append(given))
    least, at = suffix_dedup._least_owner(texts, np.array([7, 7, 8]), np.array([3, 1, 0]))
    assert not sorted_
    assert at.tolist() == [0, 16, 34, 50]
    assert least.tolist() == [3] * 5 + [1] * 11 + [1] * 18 + [0] * 16


def test_least_owner_of_each_string():
    random, size = np.random.default_rng(1), suffix_dedup.LENGTH
    pieces = [bytes(random.integers(97, 99, n, np.uint8)) for n in (50, 51, 60, 30, 20, 12, 3)]
    for _ in range(40):
        made = {
            (int(random.integers(0, 4)), b"".join(pieces[k] for k in random.integers(0, 7, 4)))
            for _ in range(30)
        }
        made = sorted((route, text) for route, text in made if len(text) >= size)
        ids = random.integers(0, 9, len(made))
        first = {}
        for (route, text), key in zip(made, ids.tolist(), strict=True):
            for i in range(len(text) - size + 1):
                string = (route, text[i : i + size])
                first[string] = min(key, first.get(string, key))
        least, at = suffix_dedup._least_owner(
            pa.array([t for _, t in made], pa.binary()), np.array([r for r, _ in made]), ids
        )
        for n, (route, text) in enumerate(made):
            expected = [first[route, text[i : i + size]] for i in range(len(text) - size + 1)]
            assert least[at[n] : at[n + 1]].tolist() == expected


def test_hashes_and_anchors_of_runs():
    random = np.random.default_rng(2)
    data = random.integers(0, 3, 200_000, np.uint8)
    for length in (8, 9, 16, 20, 50):
        hashed = suffix_dedup._run_hashes(data, length)
        assert len(hashed) == len(data) - length + 1
        for start in (0, 1, 13, 65_530, 65_536, len(hashed) - 1):
            assert suffix_dedup._run_hashes(data[start : start + length], length) == hashed[start]
    assert not len(suffix_dedup._run_hashes(data[:49], 50))
    kept = hashed[:70_000] >> np.uint64(20)
    found = suffix_dedup._anchors(hashed[:70_000], 31)
    assert found.tolist() == [n + int(np.argmin(kept[n : n + 31])) for n in range(70_000 - 30)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", max_size=25), min_size=1, max_size=6))
def test_suffix_arrays(texts):
    coded = [[ord(c) for c in text] + [0] for text in texts]
    symbols = np.array([c for text in coded for c in text])
    order, bounds = suffix_arrays(symbols, np.array([len(t) for t in coded]))
    for i, text in enumerate(coded):
        expected = sorted(range(len(text)), key=lambda k, t=text: t[k:])
        assert (order[bounds[i] : bounds[i + 1]] - bounds[i]).tolist() == expected


def test_quality(spark, docs, none):
    judged = quality.judge(docs).collect()
    assert len(judged) == len(TEXTS)
    assert [r.kept for r in judged if r.doc_id in (3, 4, 8, 9)] == [False] * 4
    _same_columns(quality.clean(docs), docs)
    assert quality.judge(none).collect() == quality.clean(none).collect() == []
    line = "Read  more on OUR site today and every day"
    prose = [" ".join(PROSE.replace("word", f"w{i}{k}") for k in "xy") for i in range(30)]
    rows = [(i, "\n".join([line, prose[i], line])) for i in range(30)]
    rows += [(30 + i, "\n".join([line] * 7 + [f"x{i}"] * 9)) for i in range(3)]
    rows.append((40, PROSE))
    made = spark.createDataFrame([(i, t, "h" if i < 40 else None) for i, t in rows], "doc_id int, text string, source string")
    kept = {r.doc_id: r.text for r in quality.clean(stored(made)).collect()}
    limits = (quality.MIN_DOCUMENTS, quality.MOST_SHARE, quality.MOST_REMOVED)
    assert kept == brute.quality([(i, "h" if i < 40 else None, t) for i, t in rows], *limits)
    assert kept[0] == prose[0] and 30 not in kept and kept[40] == PROSE


def test_bpe(docs, none):
    path = P.path(queries.BYTE_RANKS)
    encoded = bpe.encode(docs, path, P.PATTERN)
    decoded = bpe.decode(encoded, path, P.PATTERN).collect()
    assert [bytes(r.decoded).decode() for r in decoded] == [t or "" for _, t in TEXTS]
    assert bpe.decode(bpe.encode(none, path, P.PATTERN), path, P.PATTERN).collect() == []
    odd = docs.sparkSession.createDataFrame([([1, 10**6],), (None,), ([],)], "token_ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, path, P.PATTERN).collect()] == [None, None, b""]


def test_token_files(spark, docs, none):
    folder = scratch_path(spark, "ids")
    path = P.path(queries.WORD_BPE)
    manifest = token_files.write_token_files(docs, folder, path, 1)
    rows = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    assert [r.doc_id for r in rows][:4] == [None, 1, 2, 2]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))  # noqa: B905
    assert [r.n_tokens for r in rows if r.doc_id in (3, 4, 9)] == [1, 1, 1]
    folder = scratch_path(spark, "ids")
    manifest = token_files.write_token_files(none, folder, path, 1)
    assert token_files.read_token_files(manifest, folder).collect() == []


def test_every_letter_before_a_mark():
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path(queries.WORD_BPE)
    library = tokenizers.Tokenizer.from_file(path)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha()]
    encode = token_files.WordEncoder.load(path)
    for mark in token_files._MARKS:
        words = [stem + c + mark for c in letters for stem in ("", "a")]
        expected = [e.ids for e in library.encode_batch_fast(words, add_special_tokens=False)]
        ids, counts = encode(words)
        found = np.split(ids, np.cumsum(counts)[:-1])
        assert [w for w, a, b in zip(words, expected, found, strict=True) if a != b.tolist()] == []
    words = ["TARİHİ:", "হয়,", "ADRESİ.", "क़.", "İ", "İ x", "हृ क़ a"]
    ids, counts = encode(words)
    expected = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected


def test_revisits(spark):
    plain = [
        (1, "response", "http://A.org:80/x?utm_source=q#f", 100, None, {"ETag": '"e"', "etag": '"f"'}),
        (2, "response", "https://www.a.org/x/", 100, None, {"ETag": '"g"', "Content-Type": "t"}),
        (3, "revisit", "a.org/x", 100, warc.PROFILE, {"ETag": '"g"'}),
        (4, "revisit", "http://a.org/x?", 200_000, warc.PROFILE, {"ETag": 'W/"g"', "Content-Type": "no"}),
        (4, "revisit", "http://a.org/x?", 200_000, warc.PROFILE, {"ETag": 'W/"g"', "Content-Type": "no"}),
        (5, "revisit", "http://a.org/x", 101, warc.PROFILE, None),
        (6, "revisit", None, 101, warc.PROFILE, {"ETag": '"g"'}),
        (7, "revisit", "http://a.org/x", 101, "other", {"ETag": '"g"'}),
        (8, "revisit", "http://a.org/x", 101, warc.PROFILE, {"ETag": '"f"'}),
    ]
    schema = "record_id int, record_type string, url string, s int, profile string, headers map<string,string>"
    records = spark.createDataFrame(plain, schema).withColumns(
        {"date": F.timestamp_seconds("s"), "status": F.lit(200), "payload": F.lit("p"), "key": F.lit(1)}
    )
    rows = warc.resolve_revisits(records).collect()
    found = sorted((r.record_id, r.outcome, r.resolved_id) for r in rows)
    assert found == [
        (3, "no response", None),
        (4, "resolved", 2),
        (4, "resolved", 2),
        (5, "no validators", None),
        (6, "no response", None),
        (8, "validators differ", None),
    ]
    [headers] = {tuple(sorted(r.headers.items())) for r in rows if r.record_id == 4}
    assert headers == (("content-type", "t"), ("etag", 'W/"g"'))
    assert warc.resolve_revisits(records.limit(0)).collect() == []
    assert warc.with_payload(warc.resolve_revisits(records), records).count() == len(found)


def test_ngram_join(docs, none):
    expected = brute.components([(i, t) for i, (_, t) in enumerate(TEXTS)], 5, 80)
    found = ngram_join.link(docs).orderBy("__row").collect()
    groups = {}
    for i, row in enumerate(found):
        assert row.n_shingles == expected[i][0]
        groups.setdefault(row.component, set()).add(i)
    wanted = {}
    for i, (_, root) in expected.items():
        wanted.setdefault(root, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
    kept = ngram_join.keep_first(docs)
    _same_columns(kept, docs)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 6, 7, 8, 9, 10]
    assert ngram_join.link(none).collect() == ngram_join.keep_first(none).collect() == []


def test_large_columns_are_cut_into_tiles(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(90):
        words = list(base)
        for at in rng.choice(60, rng.integers(0, 4), replace=False):
            words[at] = f"e{rng.integers(1000)}"
        texts.append(" ".join(words))
    made = stored(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    monkeypatch.setattr(ngram_join, "SMALL", 4)
    monkeypatch.setattr(ngram_join, "TILE", 1200)
    monkeypatch.setattr(ngram_join, "_BLOCK", 16)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link(made, 4, 85).collect()}
    assert found == brute.components(list(enumerate(texts)), 4, 85)
    assert 1 < len({c for _, c in found.values()}) < 90


def test_components_of_a_chain(spark):
    edges = spark.range(1, 300).selectExpr("id AS a", "id - 1 AS b").union(
        spark.createDataFrame([(500, 501), (501, 500)], "a bigint, b bigint")
    )
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(300)} | {500: 500, 501: 500}


def test_token_counts(docs, none):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = P.path(queries.PIECE_BPE)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = piece_counts.count_tokens(docs, path, 100).collect()
    assert [r.n_tokens for r in rows] == [len(library.encode(t or "")) for _, t in TEXTS]
    assert [r.over_limit for r in rows] == [r.n_tokens > 100 for r in rows]
    assert piece_counts.count_tokens(none, path, 100).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.sampled_from("  ▁abcdeothiné</s>\n\t0😀中"), max_size=60), min_size=1, max_size=20))
def test_counts_equal_the_library(texts):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = P.path(queries.PIECE_BPE)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert piece_counts.counter(path).count(texts).tolist() == [len(x) for x in library.encode(texts)]


def test_pipeline_stages(spark, sf_dir, docs, none):
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf_dir)
        if name == "tokens":
            texts = sorted(r.text for r in result.select("text").collect())
            assert texts == sorted(t or "" for _, t in TEXTS)
        else:
            _same_columns(result, docs)
        assert stage(spark, none, sf_dir).collect() == []


def test_word_encoder_remembers_the_words_of_a_task():
    """Half a million pieces are less than a task of 85 MB meets; they were forgotten on the way."""
    encode = token_files.WordEncoder.load(P.path("word_bpe_49k.json"))
    texts = [" ".join(f"w{n}" for n in range(start, start + 10_000)) for start in range(0, 500_000, 10_000)]
    first = [encode([text])[0] for text in texts]
    assert len(encode._codes) >= 500_000
    assert all((encode([text])[0] == ids).all() for text, ids in zip(texts[:3], first[:3], strict=True))


class _Taken(Exception):
    """What a frame was asked to run in its tasks."""


class _Frame:
    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        raise _Taken(run)


def test_a_worker_drops_what_another_operator_left_in_it():
    path = P.path(corpus_pipeline.RANKS)
    bpe.vocabulary(path, P.PATTERN)
    with pytest.raises(_Taken) as taken:
        ngram_join._common(_Frame())
    assert list(taken.value.args[0](iter([]))) == []
    assert not bpe.vocabulary.cache_info().currsize


def test_decoding_needs_no_vocabulary(spark, monkeypatch):
    path = P.path(corpus_pipeline.RANKS)
    few = bpe.TokenBytes({b"a": 0, b"bc": 2})
    assert few.decode(np.array([2, 0, 1, 0]), np.array([2, 1, 1, 0])) == [b"bca", None, b"a", b""]
    rows = spark.createDataFrame([([65, 66],), (None,), ([-1],), ([],)], "token_ids array<int>")
    ranks = {rank: key for key, rank in bpe.read_ranks(path).items()}
    found = [row.decoded for row in bpe.decode(rows, path, P.PATTERN).collect()]
    assert found == [ranks[65] + ranks[66], None, None, b""]
    monkeypatch.setattr(bpe.ByteBpe, "load", None)
    assert bpe.token_bytes(path).decode(np.array([65]), np.array([1])) == [ranks[65]]
