"""The operators' results by the plainest means, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return (text or "").translate(_LOWER)


def grams(text, size):
    words = PLAIN.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def components(docs, size, percent):
    """docs: (key, text). The least key of each document's component, and the size of its set."""
    sets = {key: grams(text, size) for key, text in docs}
    root = {key: key for key in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {key: (len(sets[key]), find(key)) for key in keys}


def repeats(docs, length=50):
    """docs: (id, bytes). For each document what is removed, as a mask."""
    first = {}
    for key, data in sorted(docs):
        for i in range(len(data) - length + 1):
            first.setdefault(data[i : i + length], key)
    masks = {}
    for key, data in docs:
        mask = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < key:
                mask[i : i + length] = b"\x01" * length
        masks[key] = mask
    return masks


def kept_bytes(data, mask):
    return bytes(b for b, gone in zip(data, mask, strict=True) if not gone)


def contamination(docs, items, length=10):
    """docs and items: (id, text). For each document: words, hit places and items."""
    windows = defaultdict(set)
    for item, text in items:
        words = LETTERS.findall(lower(text))
        n = min(len(words), length)
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    out = {}
    for key, text in docs:
        words = LETTERS.findall(lower(text))
        places, found = set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if (window := tuple(words[i : i + n])) in windows:
                    places |= set(range(i, i + n))
                    found |= windows[window]
        out[key] = (len(words), sorted(places), sorted(found))
    return out


def base_rules(text):
    text = text or ""
    words = PLAIN.findall(text)
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {
        i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)
    }
    lines = [x for x in text.split("\n") if PLAIN.search(x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(repeated),
        failed,
    )


def quality(docs, min_documents, share, removed):
    """docs: (key, source, text). The documents that stay, with their lines."""
    count, hosts = Counter(), Counter()

    def normal(line):
        return lower(" ".join(PLAIN.findall(line)))

    for _, source, text in docs:
        hosts[source] += 1
        count.update({(source, normal(x)) for x in (text or "").split("\n") if PLAIN.search(x)})
    out = {}
    for key, source, text in docs:
        lines = (text or "").split("\n")
        bad = [
            bool(PLAIN.search(x))
            and (n := count[source, normal(x)]) >= min_documents
            and n > share * hosts[source]
            for x in lines
        ]
        lost = sum(len(PLAIN.findall(x)) for x, gone in zip(lines, bad, strict=True) if gone)
        words, failed = base_rules(text)[0], base_rules(text)[5]
        if not failed and lost <= words * removed:
            out[key] = "\n".join(x for x, gone in zip(lines, bad, strict=True) if not gone)
    return out


def damaged(rows):
    """rows: (conv_id, turn, role, text). The rows after damage, in order, by conversation."""
    found = {row[0]: [] for row in rows}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        found[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for turns in found.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
    return found


def faults(turns):
    """The first fault of each (role, text)."""
    seen, out = set(), []
    for role, text in turns:
        ink = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not ink:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if ink[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def repaired(turns, most_inserts=2):
    """The cheapest edits of (role, text) turns: cost, audit, lines. All sequences, state by state."""
    wrong = faults(turns)
    # From the pattern's prefix so far (as its last sign) to the cheapest audit and lines.
    best = {"": (0, "", ())}

    def offer(into, state, entry):
        if state not in into or entry[:2] < into[state][:2]:
            into[state] = entry

    def follows(state):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[state]

    def inserted(states):
        out = dict(states)
        for _ in range(most_inserts):
            for state, (cost, audit, lines) in list(out.items()):
                for sign, role in (("u", "user"), ("a", "assistant")):
                    if sign in follows(state):
                        offer(out, sign, (cost + 2, audit + "I", (*lines, role + ":")))
        return out

    for (role, text), fault in zip(turns, wrong, strict=True):
        new = {}
        for state, (cost, audit, lines) in inserted(best).items():
            offer(new, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            if role[:1] and role[:1] in follows(state):
                offer(new, role[:1], (more, audit + "K", (*lines, f"{role}:{text}")))
            for sign, name in (("u", "user"), ("a", "assistant")):
                if sign in follows(state):
                    offer(new, sign, (more + 2, audit + "R", (*lines, f"{name}:{text}")))
        best = new
    ends = inserted(best)
    cost, audit, lines = min(ends[s] for s in ("", "a") if s in ends)
    return cost, audit, "\n".join(lines)


def conversation_report(turns):
    """turns: (turn, role, text) in order. What op13 returns of them."""
    said = [t[1:] for t in turns]
    known = [t[0] for t in turns if t[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    wrong = Counter(faults(said))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:], strict=False))
    cost, audit, text = repaired(said)
    return gaps, wrong["blank"], wrong["duplicate"], wrong["truncated"], illegal, cost, audit, sha(text)


def alignment(a, b):
    """a, b: lists of (id, bytes) over the same bytes. Groups of ids, and links."""
    def ends(tokens):
        return list(accumulate(len(x) for _, x in tokens))

    ends_a, ends_b = ends(a), ends(b)
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
        groups.append(([t for t, _ in a[i:x]], [t for t, _ in b[j:y]]))
        i, j = x, y
    starts_a, starts_b = [0, *ends_a], [0, *ends_b]
    links, j = [], 0
    for i in range(len(a)):
        while ends_b[j] <= starts_a[i]:
            j += 1
        k = j
        while k < len(b) and starts_b[k] < ends_a[i]:
            links.append((a[i][0], b[k][0]))
            k += 1
    return groups, links


def alignment_report(texts, encode):
    """texts: one for each document; encode gives both sides. What op11 returns of each."""
    made = [alignment(*encode(text)) for text in texts]
    count = Counter(link for _, links in made for link in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for groups, links in made:
        spelled = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(count[link] == best[link[1]] for link in links),
                sum(count[link] for link in links),
                sha(spelled) if groups else "",
            )
        )
    return out
