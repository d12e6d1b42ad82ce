"""Removal of repeated strings of bytes over all documents, by suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts in a document with a
smaller id. Strings are judged on the input. A suffix array over all texts would have to pass
through one task; instead the suffixes that can share a string are brought together:

1. Every string of LENGTH bytes has an anchor: of the substrings of ANCHOR bytes in it the one
   with the least hash, the leftmost of equals. It depends on the string alone, so that equal
   strings have equal anchors. Neighbouring strings mostly share theirs; such a run is a
   segment of some 65 bytes.
2. Blocks of documents report the anchors that occur in them, hashed, once for each block; of
   each anchor that occurs twice the blocks that have it are told. All others are done: only
   segments around shared anchors leave their block, equal ones of a block as one row.
3. The distinct segments of an anchor are put in one text, and suffix arrays are built of many
   such texts at once (``suffixes``). Equal strings are neighbours there; the least document
   id among them decides for all. Of a segment only the part counts from the first to the last
   string whose hash another one of its anchor has: the rest, or all of it, is left out
   beforehand, and where one part is all there is, no order is needed.
4. An anchor that occurs HOT times or more would gather many segments in one task. Its strings
   go by their own hash instead of the anchor's, so that each such group has one string.
   Its rows, one for each block, are read one after the other with the least id first.
5. The removed ranges go back to the blocks, which cut them from the texts. ``deduplicate`` gives
   out whole rows there, so that texts are shuffled once, into their blocks, and not again.

Exact copies of whole texts are set aside first: they are removed wholly, if they have LENGTH
bytes, except those with the least id. That leaves no group of copies to gather.

Null text is empty. Texts below LENGTH bytes keep all bytes. Documents that share an id do not
remove each other's strings; a null id is smaller than all others. Every row is a document of
its own, told apart by its place in the files of a table; a frame that is not read from one is
stored first. Ids that are no whole numbers are refused. An empty table gives no rows.
``deduplicate`` keeps extra columns. A block holds about BLOCK bytes of text, or one longer
document, which is read whole.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm.common import (
    GIVEN,
    ROW,
    forget,
    given,
    list_array,
    offsets,
    placed,
    ragged,
    release,
    ship,
    stable,
    text_or_empty,
)
from tremor.llm.suffixes import suffix_arrays
from tremor.sinks import settled, stored

LENGTH = 50
ANCHOR = 20
BLOCK = 2 << 20
#: Anchors that a task of step 2 gathers, about.
BUCKET = 1 << 20
#: Occurrences from which the strings of an anchor go by their own hash.
HOT = 1 << 14
#: Segments that a task settles together, and symbols whose suffixes it sorts in step.
GATHER = 60_000
STEP_SYMBOLS = 1 << 20
NO_ID = -(1 << 63)
#: Bytes that are hashed together, so that they stay in the cache.
_STEP = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_SEGMENT, _STRING = 0, 1


def _mix(x: np.ndarray, spare: np.ndarray) -> None:
    x ^= np.right_shift(x, np.uint64(32), out=spare)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= np.right_shift(x, np.uint64(29), out=spare)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    _mix(x, np.empty_like(x))
    return x


def _run_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes, eight or more, from each place."""
    out = np.empty(max(len(data) - length + 1, 0), np.uint64)
    # The last eight may overlap those before.
    later = [*range(8, length - 8, 8), *([length - 8] if length > 8 else [])]
    for lo in range(0, len(out), _STEP):
        made = out[lo : lo + _STEP]
        raw = data[lo : lo + len(made) + length - 1].tobytes() + bytes(16)
        # The eight bytes from each place as a number, from all eight ways to cut the bytes.
        eights = np.empty(-(-(len(made) + length - 1) // 8) * 8, np.uint64)
        for k in range(8):
            eights[k::8] = np.frombuffer(raw, "<u8", len(eights) // 8, k)
        made[:] = eights[: len(made)]
        step = np.empty_like(made)
        for i, at in enumerate(later, 1):
            np.multiply(eights[at : at + len(made)], np.uint64(pow(_BASE, i, 1 << 64)), out=step)
            made += step
        _mix(made, step)
    return out


def _anchors(hashed: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each ``width`` neighbours, leftmost, by all bits but the last 20."""
    places = np.uint64((1 << 20) - 1)
    now, size = (hashed & ~places) | np.arange(len(hashed), dtype=np.uint64), 1
    while 2 * size <= width:
        now, size = np.minimum(now[: len(now) - size], now[size:]), 2 * size
    now = np.minimum(now[: len(now) - width + size], now[width - size :]) if size < width else now
    return (now & places).astype(np.int64)


def _bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[bytes, np.ndarray]:
    """All texts one after the other, and where each begins and the last one ends."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    if not len(texts) or not sizes.any():
        return b"", offsets(sizes)
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64 if large else np.int32)
    lo, hi = int(at[texts.offset]), int(at[texts.offset + len(texts)])
    return data[lo:hi].to_pybytes(), offsets(sizes)


def _binaries(data: bytes | np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive pieces of ``data`` as an Arrow array."""
    at = pa.py_buffer(offsets(sizes).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, at, pa.py_buffer(data)])


class _Block:
    """The documents of a block in the order of their rows, and their segments."""

    def __init__(self, table: pa.Table):
        table = table.sort_by(ROW).combine_chunks()
        self.rows = table[ROW].to_numpy()
        self.ids = table["id"].to_numpy()
        self.data, self.at = _bytes(table["text"])

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash, document, start and end in the block's bytes of each segment."""
        data = np.frombuffer(self.data, np.uint8)
        # If a whole string begins here; between two documents there are places where none does.
        whole = np.ones(len(data), bool)
        for lo, hi in zip(self.at[:-1].tolist(), self.at[1:].tolist(), strict=True):
            whole[max(lo, hi - LENGTH + 1) : hi] = False
        parts = []
        for lo in range(0, len(data), _STEP):
            piece = data[lo : lo + _STEP + LENGTH - 1]
            if len(piece) < LENGTH:
                break
            hashed = _run_hashes(piece, ANCHOR)
            anchor = _anchors(hashed, LENGTH - ANCHOR + 1)
            inside = whole[lo : lo + len(anchor)]
            goes_on = anchor[1:] == anchor[:-1]
            goes_on &= inside[1:] & inside[:-1]
            first, last = inside.copy(), inside.copy()
            first[1:] &= ~goes_on
            last[:-1] &= ~goes_on
            first, last = np.flatnonzero(first), np.flatnonzero(last)
            parts.append((hashed[anchor[first]], first + lo, last + (lo + LENGTH)))
        if not parts:
            return tuple(np.zeros(0, kind) for kind in (np.uint64, np.int64, np.int64, np.int64))
        value, start, end = map(np.concatenate, zip(*parts, strict=True))
        return value, np.searchsorted(self.at, start, "right") - 1, start, end


def _keys(anchors: np.ndarray, bits: int) -> np.ndarray:
    """The bucket in the upper bits, and 32 more bits of the hash."""
    return anchors >> np.uint64(32 - bits)


def _reported(documents: DataFrame, bits: int) -> DataFrame:
    """The anchors of each block by bucket: 32 bits of each, and how often it occurs, to 255."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        forget()
        found, times = np.unique(_keys(_Block(table).segments()[0], bits), return_counts=True)
        cuts = np.searchsorted(found, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
        used = np.flatnonzero(np.diff(cuts))
        low = found.astype("<u4")
        capped = np.minimum(times, 255).astype(np.uint8)
        spans = [slice(cuts[b], cuts[b + 1]) for b in used]
        return pa.table(
            {
                "bucket": pa.array(used, pa.int32()),
                "block": pa.array([key[0].as_py()] * len(used), pa.int64()),
                "low": pa.array([low[s].tobytes() for s in spans], pa.binary()),
                "times": pa.array([capped[s].tobytes() for s in spans], pa.binary()),
            }
        )

    schema = "bucket int, block bigint, low binary, times binary"
    return documents.groupBy("block").applyInArrow(run, schema)


def _shared(reported: DataFrame) -> DataFrame:
    """For each block and bucket the anchors that occur twice or more in all, and if often."""

    def run(table: pa.Table) -> pa.Table:
        lows = [np.frombuffer(x, "<u4") for x in table["low"].to_pylist()]
        times = np.frombuffer(b"".join(table["times"].to_pylist()), np.uint8).astype(np.int64)
        _, which = np.unique(np.concatenate(lows), return_inverse=True)
        total = np.bincount(which, times)
        hot = total >= HOT
        hot[which[times == 255]] = True  # it may be more
        keep, often = (total >= 2)[which], hot[which].astype(np.uint8)
        cuts = offsets(np.fromiter(map(len, lows), np.int64, len(lows)))
        spans = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.table(
            {
                "bucket": table["bucket"],
                "block": table["block"],
                "low": pa.array(
                    [low[keep[s]].tobytes() for low, s in zip(lows, spans, strict=True)], pa.binary()
                ),
                "hot": pa.array([often[s][keep[s]].tobytes() for s in spans], pa.binary()),
            }
        )

    return reported.groupBy("bucket").applyInArrow(
        run, "bucket int, block bigint, low binary, hot binary"
    )


#: ``entries`` has for each occurrence its document's place in the block, its start and the id.
_SENT = "route bigint, kind int, least bigint, text binary, block bigint, entries binary"
_ENTRY = np.dtype([("place", "<i4"), ("start", "<i4"), ("id", "<i8")])


def _sent(documents: DataFrame, shared: DataFrame, bits: int) -> DataFrame:
    """The distinct segments of each block around shared anchors, and where they occur."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(_SENT)
        block_id = left["block"][0].as_py()
        block = _Block(left)
        right = right.sort_by("bucket")
        lows = [np.frombuffer(x, "<u4").astype(np.uint64) for x in right["low"].to_pylist()]
        upper = right["bucket"].to_numpy().astype(np.uint64) << np.uint64(32)
        known = np.concatenate([low + up for low, up in zip(lows, upper, strict=True)])
        often = np.frombuffer(b"".join(right["hot"].to_pylist()), np.uint8)
        anchors, document, start, end = block.segments()
        keys = _keys(anchors, bits)
        at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
        hot = hit & (often[at] > 0) if len(known) else hit
        plain = hit & ~hot
        # Strings of hot anchors one by one, other segments whole.
        count = (end - start - LENGTH + 1)[hot]
        each = ragged(start[hot], count)
        starts = np.r_[start[plain], each]
        ends = np.r_[end[plain], each + LENGTH]
        documents_ = np.r_[document[plain], np.repeat(document[hot], count)]
        kinds = np.r_[np.full(plain.sum(), _SEGMENT), np.full(len(each), _STRING)]
        routes = anchors[plain]
        if len(each):
            strings = _run_hashes(np.frombuffer(block.data, np.uint8), LENGTH)
            routes = np.r_[routes, strings[each]]
        if not len(starts):
            return _table(_SENT)
        # Equal texts of one kind are one group; segments come before strings.
        data = np.frombuffer(block.data, np.uint8)
        texts, groups, before = [], [], 0
        for part in (slice(0, plain.sum()), slice(plain.sum(), None)):
            sizes = (ends - starts)[part]
            coded = _binaries(data[ragged(starts[part], sizes)], sizes).dictionary_encode()
            texts.append(coded.dictionary)
            groups.append(coded.indices.to_numpy().astype(np.int64) + before)
            before += len(coded.dictionary)
        group = np.concatenate(groups)
        order = np.argsort(group, kind="stable")  # documents are in order already
        first = np.flatnonzero(np.r_[True, np.diff(group[order]) > 0])
        sizes = np.diff(np.r_[first, len(order)])
        entries = np.empty(len(order), _ENTRY)
        entries["place"] = documents_[order]
        entries["start"] = starts[order] - block.at[documents_[order]]
        entries["id"] = ids = block.ids[documents_[order]]
        head = order[first]
        return pa.table(
            {
                "route": pa.array(routes[head].view(np.int64)),
                "kind": pa.array(kinds[head], pa.int32()),
                "least": pa.array(np.minimum.reduceat(ids, first), pa.int64()),
                "text": pa.concat_arrays(texts),
                "block": pa.array([block_id] * len(head), pa.int64()),
                "entries": _binaries(entries.view(np.uint8), sizes * _ENTRY.itemsize),
            }
        )

    def freed(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return run(left, right)
        finally:
            release()

    return documents.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(freed, _SENT)


def _table(schema: str) -> pa.Table:
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "binary": pa.binary(),
        "array<int>": pa.list_(pa.int32()),
        "array<bigint>": pa.list_(pa.int64()),
    }
    fields = [field.split() for field in schema.split(", ")]
    return pa.schema([(name, kinds[kind]) for name, kind in fields]).empty_table()


def _least_owner(texts: pa.Array, route: np.ndarray, least: np.ndarray):
    """For each string of each text, the least id of its equals on the same route.

    Texts of one route are neighbours. Returns the ids, one text's strings after the other's.
    """
    data, begin = _bytes(texts)
    data, lengths = np.frombuffer(data, np.uint8), np.diff(begin)
    at = offsets(lengths - LENGTH + 1)
    out = np.repeat(least, lengths - LENGTH + 1)
    number = np.cumsum(np.r_[0, route[1:] != route[:-1]])
    several = np.flatnonzero(np.bincount(number)[number] > 1)
    chosen, first, many = _matching(data, begin, number, several)
    if not len(chosen):
        return out, at
    # What is left of texts that share one string is mostly one text: all have its least id.
    sizes = many + LENGTH - 1
    body = data[ragged(begin[chosen] + first, sizes)]
    coded = _binaries(body, sizes).dictionary_encode()
    key = number[chosen] * len(coded.dictionary) + coded.indices.to_numpy()
    _, one, same = np.unique(key, return_index=True, return_inverse=True)
    low = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(low, same, least[chosen])
    found, found_at = _sorted_owner(body, offsets(sizes)[one], sizes[one], number[chosen][one], low)
    out[ragged(at[chosen] + first, many)] = found[ragged(found_at[same], many)]
    return out, at


def _matching(data, begin, number, several) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts that share the hash of a string with another text of their route: which of
    ``several``, the first such string of each, and how many strings lie from it to the last."""
    empty = np.zeros(0, np.int64)
    if not len(several):
        return empty, empty, empty
    strings = np.diff(begin)[several] - LENGTH + 1
    starts = ragged(begin[several], strings)
    owner = np.repeat(np.arange(len(several)), strings)
    hashed = _run_hashes(data, LENGTH)[starts] ^ _mixed(number[several][owner].astype(np.uint64))
    order = np.argsort(hashed, kind="stable")  # a text's own strings stay together
    hashed, sorted_owner = hashed[order], owner[order]
    same = (hashed[1:] == hashed[:-1]) & (sorted_owner[1:] != sorted_owner[:-1])
    head = np.ones(len(order), bool)
    head[1:] = hashed[1:] != hashed[:-1]
    # All strings of a hash that two texts have.
    group = np.cumsum(head) - 1
    shared = np.zeros(group[-1] + 1, bool)
    shared[group[1:][same]] = True
    hit = np.zeros(len(order), bool)
    hit[order] = shared[group]
    hit = np.flatnonzero(hit)
    if not len(hit):
        return empty, empty, empty
    of = owner[hit]
    heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    lo, hi = hit[heads], hit[np.r_[heads[1:], len(hit)] - 1]
    which = of[heads]
    return several[which], lo - offsets(strings)[which], hi - lo + 1


def _sorted_owner(data, begin, lengths, number, least):
    """``_least_owner`` of different texts of each route, by their suffix arrays."""
    at = offsets(lengths - LENGTH + 1)
    out = np.repeat(least, lengths - LENGTH + 1)
    chosen = np.flatnonzero(np.bincount(number)[number] > 1)
    if not len(chosen):
        return out, at
    total = np.bincount(number[chosen], lengths[chosen] + 1, minlength=number[-1] + 1)
    # Routes of about one length go in step; the shorter ones of a batch are done before the others.
    chosen = chosen[np.lexsort((number[chosen], total[number[chosen]]))]
    part = np.cumsum(lengths[chosen] + 1) // STEP_SYMBOLS
    new = np.ones(len(chosen), bool)
    new[1:] = part[1:] != part[:-1]
    new[1:] &= number[chosen][1:] != number[chosen][:-1]
    cuts = np.flatnonzero(new)
    for lo, hi in zip(cuts, np.r_[cuts[1:], len(chosen)], strict=False):
        _settle(chosen[lo:hi], data, begin, lengths, number, least, at, out)
    return out, at


def _settle(chosen, data, begin, lengths, number, least, at, out) -> None:
    """Sort the suffixes of some routes' texts, and let the least id of equal strings count."""
    # One text for each route: its segments with a mark after each, the last one the least.
    total = lengths[chosen] + 1
    place = offsets(total)
    symbols = np.ones(place[-1], np.uint16)
    body = ragged(place[:-1], lengths[chosen])
    symbols[body] = data[ragged(begin[chosen], lengths[chosen])]
    symbols[body] += 2
    last = np.flatnonzero(np.r_[number[chosen][1:] != number[chosen][:-1], True])
    symbols[place[1:][last] - 1] = 0
    joined = np.diff(np.r_[0, place[1:][last]])
    order, _ = suffix_arrays(symbols, joined)

    # Only suffixes that begin with a whole string count.
    owner = np.repeat(np.arange(len(chosen)), total)
    inside = np.arange(place[-1]) - place[owner]
    whole = (inside + LENGTH <= lengths[chosen][owner])[order]
    of_route = np.repeat(np.arange(len(joined)), joined)[whole]
    order = order[whole]
    ahead = np.flatnonzero(of_route[1:] == of_route[:-1]) + 1
    for k in range(LENGTH):
        ahead = ahead[symbols[order[ahead] + k] == symbols[order[ahead - 1] + k]]
    same = np.zeros(len(order), bool)
    same[ahead] = True
    heads = np.flatnonzero(~same)
    ids = least[chosen][owner[order]]
    best = np.repeat(np.minimum.reduceat(ids, heads), np.diff(np.r_[heads, len(order)]))
    out[at[chosen[owner[order]]] + inside[order]] = best


_CUT = "block bigint, places array<int>, starts array<int>, ends array<int>"


def _cuts(rows: pa.Table, least: np.ndarray, at: np.ndarray, text: np.ndarray) -> pa.Table:
    """The ranges to remove, by block: where an equal string has a smaller id.

    ``text`` says which text each row has; ``least`` and ``at`` are of the texts.
    """
    packed, begin = _bytes(rows["entries"])
    sizes = np.diff(begin) // _ENTRY.itemsize
    given = np.frombuffer(packed, _ENTRY)
    places, starts, ids = given["place"], given["start"], given["id"]
    row = np.repeat(np.arange(rows.num_rows), sizes)
    strings = np.diff(at)[text][row]
    string = ragged(at[:-1][text][row], strings)
    entry = np.repeat(np.arange(len(row)), strings)
    inside = ragged(np.zeros(len(row), np.int64), strings)
    gone = np.flatnonzero(least[string] < ids[entry])
    if not len(gone):
        return _table(_CUT)
    begin = np.ones(len(gone), bool)
    begin[1:] = (np.diff(gone) > 1) | (entry[gone][1:] != entry[gone][:-1])
    first = np.flatnonzero(begin)
    last = np.r_[first[1:], len(gone)] - 1
    entries = entry[gone[first]]
    block = rows["block"].to_numpy()[row[entries]]
    order = np.argsort(block, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0])
    many = np.diff(np.r_[heads, len(order)])
    start = starts[entries] + inside[gone[first]]
    end = starts[entries] + inside[gone[last]] + LENGTH
    return pa.table(
        {
            "block": pa.array(block[order][heads], pa.int64()),
            "places": list_array(places[entries][order], many, pa.int32()),
            "starts": list_array(start[order], many, pa.int32()),
            "ends": list_array(end[order], many, pa.int32()),
        }
    )


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to GATHER rows or more."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHER:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _ranges(sent: DataFrame) -> DataFrame:
    """Ranges to remove, as lists for each block."""
    ordered = sent.repartition("route").sortWithinPartitions("kind", "route", "text", "least")

    def new_texts(table: pa.Table) -> np.ndarray:
        """Which rows have another route or text than the one before."""
        route, texts = table["route"].to_numpy(), table["text"].combine_chunks()
        new = np.ones(len(texts), bool)
        new[1:] = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
        new[1:] |= route[1:] != route[:-1]
        return new

    def settled(table: pa.Table) -> pa.Table:
        """All segments of some anchors."""
        new = new_texts(table)
        first = np.flatnonzero(new)
        # Rows of a text come with the least id first.
        texts = table["text"].combine_chunks().take(pa.array(first))
        least, at = _least_owner(
            texts, table["route"].to_numpy()[first], table["least"].to_numpy()[first]
        )
        return _cuts(table, least, at, np.cumsum(new) - 1)

    def one_by_one(table: pa.Table, known: dict) -> pa.Table:
        """Strings of hot anchors: the first row of each has the least id of all its rows."""
        new, given = new_texts(table), table["least"].to_numpy()
        key = (table["route"][0].as_py(), table["text"][0].as_py())
        new[0] = known.get("key") != key
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        least = np.where(first < 0, known.get("least", 0), given[first])
        known.update(key=(table["route"][-1].as_py(), table["text"][-1].as_py()), least=int(least[-1]))
        return _cuts(table, least, np.arange(len(new) + 1), np.arange(len(new)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, known = None, {}
        for table in _gathered(batches):
            if table.num_rows:
                plain = int((table["kind"].to_numpy() == _SEGMENT).sum())
                if plain:
                    part = table.slice(0, plain)
                    part = part if open_ is None else pa.concat_tables([open_, part])
                    route = part["route"].to_numpy()
                    # The last anchor may go on in what comes next.
                    cut = int(np.searchsorted(route, route[-1]))
                    open_ = part.slice(cut)
                    if cut:
                        yield from settled(part.slice(0, cut)).to_batches()
                if plain < table.num_rows:
                    if open_ is not None:
                        yield from settled(open_).to_batches()
                        open_ = None
                    yield from one_by_one(table.slice(plain), known).to_batches()
        if open_ is not None:
            yield from settled(open_).to_batches()
        del open_
        release()

    return ordered.mapInArrow(run, _CUT)


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> bytes:
    """The characters of which no byte goes."""
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return data[(np.bincount(character, gone) == 0)[character]].tobytes()


def _removed(block: _Block, ranges: pa.Table) -> np.ndarray:
    """Which bytes of a block go."""
    places, starts, ends = (
        ranges[c].combine_chunks().flatten().to_numpy().astype(np.int64)
        for c in ("places", "starts", "ends")
    )
    depth = np.zeros(len(block.data) + 1, np.int32)
    np.add.at(depth, block.at[places] + starts, 1)
    np.add.at(depth, block.at[places] + ends, -1)
    return np.cumsum(depth, dtype=np.int32)[:-1] > 0


def _cut_out(documents: DataFrame, ranges: DataFrame) -> DataFrame:
    """For each document that loses bytes: its row, the removed runs and what it keeps."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds = pa.schema(
            [
                (ROW, pa.int64()),
                ("starts", pa.list_(pa.int32())),
                ("ends", pa.list_(pa.int32())),
                ("n_kept", pa.int64()),
                ("kept_sha256", pa.string()),
            ]
        )
        if not left.num_rows or not right.num_rows:
            return kinds.empty_table()
        block = _Block(left)
        gone = _removed(block, right)
        data = np.frombuffer(block.data, np.uint8)
        out = []
        for i in np.unique(np.searchsorted(block.at, np.flatnonzero(gone), "right") - 1).tolist():
            lo, hi = block.at[i], block.at[i + 1]
            edge = np.flatnonzero(np.diff(np.r_[0, gone[lo:hi].view(np.int8), 0]))
            kept = data[lo:hi][~gone[lo:hi]].tobytes()
            digest = hashlib.sha256(kept).hexdigest()
            out.append((int(block.rows[i]), edge[::2].tolist(), edge[1::2].tolist(), len(kept), digest))
        columns = zip(*out, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True)]
        return pa.Table.from_arrays(arrays, schema=kinds)

    return (
        documents.groupBy("block")
        .cogroup(ranges.groupBy("block"))
        .applyInArrow(
            run,
            f"{ROW} bigint, starts array<int>, ends array<int>, n_kept bigint, kept_sha256 string",
        )
    )


def _cleaned(blocked: DataFrame, ranges: DataFrame, kind: T.DataType) -> DataFrame:
    """All rows of the blocks, in GIVEN, with what is left of their texts in ``left``.

    Rows of which nothing but blanks is left are left out.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by(ROW)
        texts = left["text"].combine_chunks()
        if right.num_rows and left.num_rows:
            block = _Block(left)
            gone = _removed(block, right)
            data = np.frombuffer(block.data, np.uint8)
            hit = np.unique(np.searchsorted(block.at, np.flatnonzero(gone), "right") - 1)
            kept = [
                _whole_characters(data[lo:hi], gone[lo:hi]).decode()
                for lo, hi in zip(block.at[hit].tolist(), block.at[hit + 1].tolist(), strict=True)
            ]
            mask = np.zeros(left.num_rows, bool)
            mask[hit] = True
            texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(kept, texts.type))
            stays = np.ones(left.num_rows, bool)
            stays[hit] = [bool(text.strip(" ")) for text in kept]
            left, texts = left.filter(pa.array(stays)), texts.filter(pa.array(stays))
        return pa.table({GIVEN: left[GIVEN], "left": texts})

    schema = T.StructType([T.StructField(GIVEN, kind), T.StructField("left", T.StringType())])
    return blocked.groupBy("block").cogroup(ranges.groupBy("block")).applyInArrow(run, schema)


class _Plan:
    """What both results are made of: facts, copies, the blocks of other texts, and their ranges."""

    def __init__(self, documents: DataFrame, *more: Column):
        ship(documents.sparkSession)
        rowed = placed(documents, "doc_id", text_or_empty().alias("text"), *more)
        number = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id")
        size = F.octet_length("text").cast("bigint").alias("n_bytes")
        self.facts = stored(
            rowed.select(ROW, "doc_id", number, size, F.sha2("text", 256).alias("digest")), "facts"
        )
        # Short texts are never copies, so that all empty ones do not meet.
        long = self.facts.filter(F.col("n_bytes") >= LENGTH)
        first = long.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        self.copies = stored(
            long.join(first.filter("n > 1"), "digest")
            .filter(F.col("id") > F.col("first"))
            .select(ROW, F.lit(True).alias("copy")),
            "copies",
        )
        volume = self.facts.agg(F.sum("n_bytes")).first()[0] or 0
        blocks = max(1, -(-volume // BLOCK))
        bits = min(32, max(1, (volume // 10 // BUCKET).bit_length()))
        others = [c for c in rowed.columns if c not in (ROW, "doc_id", "text")]
        self.short = rowed.filter(F.octet_length("text") < LENGTH)
        alone = rowed.filter(F.octet_length("text") >= LENGTH)
        alone = alone.join(self.copies.select(ROW), ROW, "left_anti")
        block = F.pmod(F.xxhash64(ROW), F.lit(blocks)).alias("block")
        self.blocked = alone.select(ROW, number, "text", block, *others)
        shared = _shared(_reported(self.blocked, bits))
        self.ranges = _ranges(_sent(self.blocked, shared, bits))


def _checked(documents: DataFrame) -> DataFrame:
    """Strings are removed by the order of ids, which has to be that of whole numbers."""
    if not isinstance(documents.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError("doc_id must be a whole number")
    return stable(documents)


def find_repeats(documents: DataFrame) -> DataFrame:
    """A row for each document: what goes and what stays.

    Columns: __row, doc_id, n_bytes, digest (SHA-256 of the whole text), copy, starts, ends,
    n_kept and kept_sha256. ``starts`` and ``ends`` are the removed runs of bytes, and the last
    two tell of the bytes that are left. All of them are null where nothing goes, and in a
    ``copy`` of a whole earlier text, of which nothing is left.
    """

    def found() -> DataFrame:
        plan = _Plan(_checked(documents.select("doc_id", "text")))
        cut = _cut_out(plan.blocked, plan.ranges)
        return plan.facts.drop("id").join(plan.copies, ROW, "left").join(cut, ROW, "left")

    return settled(documents.sparkSession, "repeats", found)


def deduplicate(documents: DataFrame) -> DataFrame:
    """The documents with what is left of their texts, without those that lost all but blanks.

    A character of which a byte goes goes whole. ``n_chars`` follows the text.
    """
    documents = _checked(documents)
    others = [F.col(c) for c in documents.columns if c not in ("text", "n_chars")]
    plan = _Plan(documents, F.struct(*others, F.col("text").isNull().alias("__none")).alias(GIVEN))
    kept = _cleaned(plan.blocked, plan.ranges, plan.blocked.schema[GIVEN].dataType)
    rows = kept.unionByName(plan.short.select(GIVEN, F.col("text").alias("left")))
    text = F.when(~given("__none"), F.col("left"))
    made = {"text": text, "n_chars": F.char_length(text)}
    return rows.select(
        *((made[c].cast(documents.schema[c].dataType) if c in made else given(c)).alias(c) for c in documents.columns)
    )
