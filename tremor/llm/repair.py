r"""Repair of damaged conversations: the cheapest edits that make turns alternate.

A conversation is sound if its roles' initials are empty or read, after one s at most, ua any
number of times. Rows are kept (cost 0), given the role user or assistant (2) or deleted (3), and
empty turns of user or assistant are put in (2); a blank row, or one that an earlier row equals in
role and text, has to go, and a truncated row that stays costs 1 more. Of equally cheap edits
those count whose audit, the initials D, I, K, R in order, comes first in ASCII.

1. Rows are put in order of conversation and turn by a range shuffle, so that a conversation with
   a third of all rows lies in many parts, and are stored. A row's place is its number there.
2. A digest of role and text that a conversation has more than once is counted before it is
   shuffled; its rows but the first are duplicates. What the repair needs of a row is one letter;
   those of a part become a string, so that no text goes to the next step.
3. Each conversation's letters, part after part, run through a Viterbi decoder over the four states
   of the pattern. Its backpointers are a tree with reference counts: a branch that no survivor
   needs goes at once, and as soon as all survivors share an ancestor, the edits up to there are
   written out. What is held is the suffix that is still open, which ties compare as a whole.
4. The edits go back to the parts, where the rows are changed, each part by itself.

Null roles and texts are one blank; so is a null id or turn in the number that decides on damage.
A null conversation id is a conversation of its own. Null turns come first, rows of one turn in
the order of role and text, repeated rows included. Very long texts are read row by row. An empty
table gives no rows. Other columns are not read, whatever their names.
"""

import hashlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import ship, slices
from tremor.sinks import settled, stored

# What a row has to have, and how it ends if it is whole.
_INK = r"[^\x20\x09-\x0D]"
_WHOLE = r"[.!?][\x20\x09-\x0D]*\z"
#: Rows of a part that follow each other in its place; parts are numbered above it.
_PART_BITS = 33
#: Letters of a row by its first fault, if any, and the initial of its role: s, u, a, other.
_LETTERS = {"": "suax", "truncated": "SUAX", "blank": "1234", "duplicate": "5678"}

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
#: States: nothing yet, after the s, after a u, after an a. The first and the last are sound ends.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ENDS = (_START, _ASSISTANT)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by a hash of id and turn: conv_id, turn, role, text."""
    blank = F.lit(" ")
    id_, turn = (F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(id_, F.lit(":"), turn).cast("binary")) % 20
    text = F.coalesce("text", blank)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", blank))
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("kind")).filter("kind > 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    made = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "kind")
    return made.select("conv_id", "turn", "role", "text", copies.alias("copy")).drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """The rows, stored, with ``place``: where each is in the order of conversations and turns."""
    digest = F.sha2(F.concat_ws(":", F.octet_length("role"), "role", "text"), 256)
    empty = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    given = rows.select("conv_id", "turn", *empty).withColumn("digest", digest)
    # Equal turns stay together, so that their rows can be sorted.
    ordered = given.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return stored(ordered.withColumn("place", F.monotonically_increasing_id()), "ordered")


def _part() -> Column:
    return F.shiftright("place", _PART_BITS).alias("part")


def _letters(ordered: DataFrame) -> DataFrame:
    """For each conversation and part the letters of its rows: conv_id, part, letters."""
    repeated = (
        ordered.groupBy("conv_id", "digest")
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select(F.col("conv_id").alias("of"), F.col("digest").alias("same"), "first")
    )
    bare = ~F.col("text").rlike(_INK)
    facts = ordered.select(
        "conv_id",
        "digest",
        "place",
        F.substring("role", 1, 1).alias("initial"),
        bare.alias("blank"),
        (~F.col("text").rlike(_WHOLE)).alias("truncated"),
    )
    equal = (F.col("digest") == F.col("same")) & F.col("conv_id").eqNullSafe(F.col("of"))
    judged = facts.join(repeated, equal, "left").withColumn(
        "duplicate", ~F.col("blank") & F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    )

    def letter(kind: str) -> Column:
        at = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
        return F.translate(at, "suax", _LETTERS[kind])

    said = F.when(F.col("blank"), letter("blank")).when(F.col("duplicate"), letter("duplicate"))
    said = said.when(F.col("truncated"), letter("truncated")).otherwise(letter(""))
    rows = F.array_sort(F.collect_list(F.struct("place", said.alias("letter"))))
    # A conversation's rows are neighbours in a part, so that its first place tells all.
    return (
        judged.groupBy("conv_id", _part())
        .agg(F.min("place").alias("first"), rows.alias("rows"))
        .select("conv_id", "part", "first", F.array_join("rows.letter", "").alias("letters"))
    )


# ---- the decoder ---------------------------------------------------------------


def _after_insert(state: int) -> int:
    return _ASSISTANT if state == _USER else _USER


def _inserted(state: int) -> Iterator[tuple[int, str]]:
    """The states that no, one or two inserted turns lead to; more of them lead nowhere new."""
    seen, edits = set(), ""
    while state not in seen:
        yield state, edits
        seen.add(state)
        state, edits = _after_insert(state), edits + "I"


def _steps(letter: str) -> list[list[tuple[int, int, str]]]:
    """For each state after the row: the states before it, with cost and edits on the way."""
    kind = next(k for k, letters in _LETTERS.items() if letter in letters)
    initial = "suax"[_LETTERS[kind].index(letter)]
    more = 1 if kind == "truncated" else 0
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        for state, edits in _inserted(before):
            cost = INSERT * len(edits)
            ways = [(state, cost + DELETE, edits + "D")]
            if kind not in ("blank", "duplicate"):
                wanted = "a" if state == _USER else "u"
                to = _after_insert(state)
                ways.append((to, cost + REROLE + more, edits + "R"))
                if initial == wanted:
                    ways.append((to, cost + KEEP + more, edits + "K"))
                if initial == "s" and state == _START:
                    ways.append((_SYSTEM, cost + KEEP + more, edits + "K"))
            for after, price, way in ways:
                key = before, after
                found[key] = min(found.get(key, (price, way)), (price, way))
    return [[(x, *found[x, y]) for x in range(4) if (x, y) in found] for y in range(4)]


_STEPS = {letter: _steps(letter) for letters in _LETTERS.values() for letter in letters}
#: What it costs more, at most, to go on from one state as from another: by (from, as).
#: An s that is kept at the start is deleted elsewhere; an end after the s needs two turns more.
_STAND_IN = {
    (_START, _SYSTEM): 0,
    (_START, _USER): INSERT,
    (_START, _ASSISTANT): 0,
    (_SYSTEM, _START): 2 * INSERT,
    (_SYSTEM, _USER): INSERT,
    (_SYSTEM, _ASSISTANT): 2 * INSERT,
    (_USER, _START): INSERT + DELETE,
    (_USER, _SYSTEM): INSERT,
    (_USER, _ASSISTANT): INSERT,
    (_ASSISTANT, _START): DELETE,
    (_ASSISTANT, _SYSTEM): 0,
    (_ASSISTANT, _USER): INSERT,
}
#: What may be put in at the end, from each state to a sound end.
_CLOSING = [[(2 * len(e), e) for y, e in _inserted(x) if y in _ENDS] for x in range(4)]


class _Node:
    """A row's edits on the way of a survivor, with the way before it and those that go on."""

    __slots__ = ("before", "edits", "onward", "uses")

    def __init__(self, before: "_Node | None", edits: str):
        self.before, self.edits = before, edits
        self.onward: set[_Node] = set()
        self.uses = 0  # by survivors; branches that go on are in ``onward``


class Survivors:
    """A Viterbi decoder that gives out edits as soon as all its survivors agree on them."""

    def __init__(self) -> None:
        self._root = _Node(None, "")
        self._root.uses = 1
        self._best: list[tuple[int, _Node] | None] = [(0, self._root), None, None, None]

    def open_rows(self) -> int:
        """Rows on whose edits the survivors do not agree yet."""
        depth = 0
        for _, node in filter(None, self._best):
            n = 0
            while node is not self._root:
                node, n = node.before, n + 1
            depth = max(depth, n)
        return depth

    @staticmethod
    def _first(ways: list[tuple[_Node, str]]) -> tuple[_Node, str]:
        """Of equally cheap ways the one whose edits come first, by their whole open suffixes.

        None is the beginning of another: the same edits cost the same, and more cost more.
        """
        best = ways[0]
        for way in ways[1:]:
            (x, mine), (y, other) = best, way
            back, there = [mine], [other]
            while x is not y:  # all ways have one node for each row
                back.append(x.edits)
                there.append(y.edits)
                x, y = x.before, y.before
            if "".join(reversed(there)) < "".join(reversed(back)):
                best = way
        return best

    def _let_go(self, node: _Node) -> None:
        while not node.uses and not node.onward and node.before is not None:
            before = node.before
            before.onward.discard(node)
            node = before

    def _agreed(self) -> Iterator[str]:
        """The edits that all survivors share; their nodes are given up."""
        while not self._root.uses and len(self._root.onward) == 1:
            (self._root,) = self._root.onward
            self._root.before = None
            yield self._root.edits

    def take(self, letter: str) -> Iterator[str]:
        """Go on by a row; the edits of rows, one string for each, that are settled by it."""
        old, new = self._best, [None] * 4
        reached = {}
        for state, steps in enumerate(_STEPS[letter]):
            ways = [(old[x][0] + cost, old[x][1], edits) for x, cost, edits in steps if old[x] is not None]
            if ways:
                reached[state] = min(cost for cost, _, _ in ways), ways
        for state, (least, ways) in reached.items():
            # A way that another one could follow for less, to whatever end, is given up.
            if any(cost + _STAND_IN[y, state] < least for y, (cost, _) in reached.items() if y != state):
                continue
            before, edits = self._first([(n, e) for cost, n, e in ways if cost == least])
            new[state] = least, _Node(before, edits)
        for _, node in filter(None, new):
            node.uses = 1
            node.before.onward.add(node)
        for _, node in filter(None, old):
            node.uses -= 1
        for _, node in filter(None, old):
            self._let_go(node)
        self._best = new
        yield from self._agreed()

    def close(self) -> tuple[int, list[str], str]:
        """The whole cost, the edits of the rows that were still open, and what is put in at the end."""
        ways = [
            (kept[0] + cost, kept[1], edits)
            for kept, closing in zip(self._best, _CLOSING, strict=True)
            if kept is not None
            for cost, edits in closing
        ]
        least = min(cost for cost, _, _ in ways)
        node, last = self._first([(n, e) for cost, n, e in ways if cost == least])
        edits = []
        while node is not self._root:
            edits.append(node.edits)
            node = node.before
        return least, edits[::-1], last


def _named(state: int, edits: str, letter: str) -> tuple[int, str]:
    """The state after some edits, and the edits with the roles that they make.

    K and D stand for themselves, u and a for a row that gets that role, U and A for a turn put in.
    """
    out = ""
    for edit in edits:
        if edit == "K" and letter in "sS":
            state = _SYSTEM
        elif edit != "D":
            state = _after_insert(state)
            role = "U" if state == _USER else "A"
            edit = {"K": edit, "I": role, "R": role.lower()}[edit]
        out += edit
    return state, out


_EDITS = {
    "part": ("bigint", pa.int64()),
    "first": ("bigint", pa.int64()),
    "edits": ("array<string>", pa.list_(pa.string())),
    "audit": ("string", pa.string()),
    **{n: ("bigint", pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost")},
}


def _decoded(letters: DataFrame) -> DataFrame:
    """For each conversation and part the edits of its rows, their audit, and what they are about."""
    kind = letters.schema["conv_id"].dataType.simpleString()
    ordered = letters.select("conv_id", "part", "first", "letters").repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "part")
    legal = {"su", "ua", "au"}
    plain = str.maketrans("".join(_LETTERS.values()), "suax" * len(_LETTERS))
    audit = str.maketrans("UAua", "IIRR")

    def facts(letters_: str, before: str) -> tuple[int, ...]:
        initials = before + letters_.translate(plain)
        counts = [sum(map(letters_.count, _LETTERS[k])) for k in ("blank", "duplicate", "truncated")]
        return *counts, sum(initials[i : i + 2] not in legal for i in range(len(initials) - 1))

    def settled(parts: Iterator[tuple]) -> Iterator[tuple]:
        """A conversation's parts with the edits of their rows, as soon as those are settled."""
        decoder, state, before = Survivors(), _START, ""
        open_rows, waiting, named = deque(), deque(), []

        def name(edits: str) -> None:
            nonlocal state
            state, codes = _named(state, edits, open_rows.popleft())
            named.append(codes)

        def out(cost: int) -> tuple:
            conv, part, first, letters_, found = waiting.popleft()
            mine = named[: len(letters_)]
            del named[: len(letters_)]
            return conv, part, first, mine, "".join(mine).translate(audit), *found, cost

        for conv, part, first, letters_ in parts:
            waiting.append((conv, part, first, letters_, facts(letters_, before)))
            before = letters_[-1].translate(plain)
            for letter in letters_:
                open_rows.append(letter)
                for edits in decoder.take(letter):
                    name(edits)
            # The last part stays, as something may be put in behind it.
            while len(waiting) > 1 and len(waiting[0][3]) <= len(named):
                yield out(0)
        cost, rest, last = decoder.close()
        for edits in rest:
            name(edits)
        named[-1] += _named(state, last, "")[1]
        while waiting:
            yield out(0 if len(waiting) > 1 else cost)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                kinds[:] = [batch.schema.field(0).type, *(k for _, k in _EDITS.values())]
                for part in slices(batch, "letters"):
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        def made(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *_EDITS])

        done, size = [], 0
        for _, parts in groupby(rows(), key=lambda row: row[0]):
            for row in settled(parts):
                done.append(row)
                size += len(row[3]) + 1
                if size >= 100_000:
                    yield made(done)
                    done, size = [], 0
        if done:
            yield made(done)

    fields = ", ".join(f"{name} {spark_kind}" for name, (spark_kind, _) in _EDITS.items())
    return ordered.mapInArrow(run, f"conv_id {kind}, {fields}")


def find_edits(ordered: DataFrame) -> DataFrame:
    """For each conversation and part of ``in_order``'s rows what is done to them.

    Columns: conv_id, part, first (place of the first row), edits (for each row, as a string of
    edits: K kept, D deleted, u or a given that role, U or A a turn put in there), audit, the
    numbers of rows by their first fault (blank, duplicate, truncated), illegal (neighbours whose
    roles do not follow each other) and cost; a conversation's numbers are the sums over its parts.
    """
    ship(ordered.sparkSession)
    return stored(_decoded(_letters(ordered)), "edits")


def repair(ordered: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, place, at, role, text and edit, in the order of place and at."""
    each = edits.select("first", F.posexplode("edits").alias("i", "codes"))
    each = each.select((F.col("first") + F.col("i")).alias("place"), "codes")
    code = F.col("code")
    inserted = code.isin("U", "A")
    role = F.when(F.lower(code) == "u", "user").when(F.lower(code) == "a", "assistant")
    return (
        ordered.select("conv_id", "place", "role", "text")
        .join(each, "place")
        .select("*", F.posexplode(F.split("codes", "")).alias("at", "code"))
        .filter(code.isin("K", "u", "a", "U", "A"))
        .select(
            "conv_id",
            "place",
            "at",
            F.coalesce(role, "role").alias("role"),
            F.when(inserted, "").otherwise(F.col("text")).alias("text"),
            F.when(inserted, "I").when(code == "K", "K").otherwise("R").alias("edit"),
        )
    )


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256: of ``role:text`` of all turns, with line ends between them.

    A task reads turns one after the other, and holds a slice of them.
    """
    ship(repaired.sparkSession)
    kind = repaired.schema["conv_id"].dataType.simpleString()
    line = F.concat("role", F.lit(":"), "text").alias("line")
    ordered = repaired.select("conv_id", "place", "at", line).repartition("conv_id")
    ordered = ordered.sortWithinPartitions("conv_id", "place", "at").select("conv_id", "line")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: list[pa.DataType] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                kinds[:] = [batch.schema.field(0).type, pa.string()]
                for part in slices(batch, "line"):
                    yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)

        def made(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "repaired_sha256"])

        done = []
        for conv, turns in groupby(rows(), key=lambda row: row[0]):
            digest, between = hashlib.sha256(), b""
            for _, said in turns:
                digest.update(between + said.encode())
                between = b"\n"
            done.append((conv, digest.hexdigest()))
            if len(done) >= 1000:
                yield made(done)
                done = []
        if done:
            yield made(done)

    return ordered.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def report(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    """A row for each id in ``conversations`` on what the repair of the ``damaged`` rows did.

    Columns: conv_id, gaps (turns that lack between the first and the last one), blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256.
    """
    return settled(conversations.sparkSession, "repaired", lambda: _reported(conversations, damaged))


def _reported(conversations: DataFrame, damaged: DataFrame) -> DataFrame:
    ordered = in_order(damaged)
    edits = find_edits(ordered)
    numbers = ("blank", "duplicate", "truncated", "illegal", "cost")
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    audit = F.array_sort(F.collect_list(F.struct("part", "audit")))
    parts = [
        conversations.select("conv_id").distinct(),
        ordered.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps")),
        edits.groupBy("conv_id").agg(
            *(F.sum(n).alias(n) for n in numbers), F.array_join(audit["audit"], "").alias("audit")
        ),
        digests(repair(ordered, edits)),
    ]
    # One row for each conversation from each part: no join, so that a null id is an id too.
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    zero = [F.coalesce(F.max(n), F.lit(0)).alias(n) for n in ("gaps", *numbers)]
    return whole.groupBy("conv_id").agg(
        *zero,
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
