"""Repair of conversations against all edit sequences, and against a plain decoder."""

from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import brute
from tremor.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, digest string"


def _plain(letters):
    """The turns that some letters stand for."""
    turns = []
    for i, letter in enumerate(letters):
        kind = next(k for k, known in repair._LETTERS.items() if letter in known)
        role = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}["suax"[repair._LETTERS[kind].index(letter)]]
        turns.append((role, {"": f"t{i}.", "truncated": f"t{i}", "blank": " "}[kind]))
    return turns


def _decoded(letters):
    decoder, edits = repair.Survivors(), []
    for letter in letters:
        edits.extend(decoder.take(letter))
    cost, rest, last = decoder.close()
    return cost, "".join(edits) + "".join(rest) + last


def _cheapest(letters):
    """By trying every sequence of edits with up to two turns put in at each place."""
    best = None
    turns = _plain(letters)
    faults = brute.faults(turns)
    rows = [["D"] if f == "blank" else ["D", "K", "Ru", "Ra"] for f in faults]
    puts = ["", "u", "a", "ua"]
    for ops in product(*rows):
        for ins in product(puts, repeat=len(letters) + 1):
            signs, audit, cost = "", "", 0
            for i, op in enumerate(ops):
                signs += ins[i]
                audit += "I" * len(ins[i]) + op[0]
                cost += {"D": 3, "K": 0, "R": 2}[op[0]] + (op != "D" and faults[i] == "truncated")
                signs += "" if op == "D" else turns[i][0][0] if op == "K" else op[1]
            signs += ins[-1]
            audit += "I" * len(ins[-1])
            cost += 2 * sum(map(len, ins))
            rest = signs.removeprefix("s")
            sound = not signs or (rest and rest == "ua" * (len(rest) // 2))
            if sound and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


@pytest.mark.parametrize("length", [1, 2, 3])
def test_cheapest_of_all_edits(length):
    letters = "suaxSUA1" if length < 3 else "suaU1"
    for given_ in product(letters, repeat=length):
        assert _decoded(given_) == _cheapest(given_), given_


@settings(max_examples=300, deadline=None)
@given(st.text("suaxSUAX1234", min_size=1, max_size=60))
def test_long_conversations(letters):
    cost, audit, _ = brute.repaired(_plain(letters))
    assert _decoded(letters) == (cost, audit)


def test_open_rows_stay_few():
    decoder, most = repair.Survivors(), 0
    for i in range(20_000):
        list(decoder.take("uaUAs1x"[(i * i + i // 7) % 7]))
        most = max(most, decoder.open_rows())
    assert most < 50


def test_a_tie_that_stays_open():
    # Deleting or giving a role, over and over: all survivors are as cheap until the end.
    letters = "u" * 400
    cost, audit, _ = brute.repaired(_plain(letters))
    assert _decoded(letters) == (cost, audit)


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    expected = {c: brute.conversation_report(t) for c, t in brute.damaged(rows).items()}
    result = queries.queries()["op13_repair"](spark, sf_dir)
    assert {r.conv_id: tuple(r)[1:] for r in result.collect()} == expected
    kinds = {k for k, _ in zip("DIKR", range(4), strict=True) if any(k in x[6] for x in expected.values())}
    assert kinds == set("DIKR")


def test_edges(spark):
    rows = [(1, t, "user", f"text {t}.") for t in range(400)]
    rows += [(2, None, None, None), (2, None, "assistant", "x" * 300_000), (2, 5, "user", "\t\n")]
    rows += [(None, 1, "system", "s."), (None, 2, "", "e"), (None, 9, "user", "q?"), (None, 12, "assistant", "a!")]
    rows += [(3, 1, "user", "same.")] * 4 + [(3, 2, "assistant", "same.")] * 3
    rows += [(c, 0, "user", "") for c in range(10, 60)]
    given_ = spark.createDataFrame([(*r, 7, "d") for r in rows], SCHEMA).repartition(7)
    expected = {c: brute.conversation_report(t) for c, t in brute.damaged(rows).items()}
    found = repair.report(given_, repair.damage(given_)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == expected
    assert (0, 0, 0, 0, 0, 0, "", brute.sha("")) in expected.values()  # all rows dropped
    none = given_.limit(0)
    assert repair.report(none, repair.damage(none)).collect() == []


def test_a_conversation_over_many_parts(spark):
    rows = [(1, t, "usa"[t * t % 3 :][:1] or "u", f"text {t}" + "."[: t % 5]) for t in range(3000)]
    given_ = spark.createDataFrame([(*r, 7, "d") for r in rows], SCHEMA)
    joined = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(joined, "false")
    try:
        ordered = repair.in_order(given_)
        edits = repair.find_edits(ordered)
    finally:
        spark.conf.set(joined, "true")
    assert edits.count() > 1
    cost, audit, text = brute.repaired([(r, t) for _, _, r, t in rows])
    parts = sorted(edits.collect(), key=lambda r: r.part)
    assert (sum(r.cost for r in parts), "".join(r.audit for r in parts)) == (cost, audit)
    turns = sorted(repair.repair(ordered, edits).collect(), key=lambda r: (r.place, r.at))
    assert "\n".join(f"{r.role}:{r.text}" for r in turns) == text
    assert "".join(r.edit for r in turns) == audit.replace("D", "")
