"""Plain versions of what the operators compute, one value at a time."""

import math
import re
from collections import Counter, defaultdict

import xxhash

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))) if w else frozenset()


def components(rows, size, percent):
    """(id, set size, smallest id reachable) of each (id, text), by all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[top(a)] = top(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[top(a)].append(i)
    return [(i, len(sets[a]), min(least[top(a)], default=None)) for a, (i, _) in enumerate(rows)]


def windows(docs, items):
    """(id, words, hit words, names of the items) of each document, by all places and windows."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wins = defaultdict(set)
    for name, t in items:
        w = words(t)
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            wins[tuple(w[i : i + m])].update(() if name is None else (str(name),))
    lengths = {len(k) for k in wins}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for m in lengths:
            for p in range(len(w) - m + 1):
                if (names := wins.get(tuple(w[p : p + m]))) is not None:
                    hit.update(range(p, p + m))
                    found |= names
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def _xx(data, seed=42):
    x = xxhash.xxh64_intdigest(data, seed & (2**64 - 1))
    return x - 2**64 if x >= 2**63 else x


def _chain(values):
    out = 42
    for v in values:
        out = _xx((v & (2**64 - 1)).to_bytes(8, "little"), out)
    return out


def anchors(text, s=2, w=8):
    """Closed syncmers over words: the k-mers whose smallest inner s-mer stands first or last, else the whole text."""
    h = [_xx(x.encode()) for x in re.split(r"[ \t\n\x0B\f\r]+", text or "") if x]
    inner = [_chain(h[i : i + s]) for i in range(len(h) - s + 1)]
    out = [_chain(h[i : i + w + s - 1]) for i in range(len(h) - (w + s - 1) + 1) if min(inner[i : i + w]) in (inner[i], inner[i + w - 1])]
    return out or ([_chain(h)] if h else [])


def fingerprint(anchors_):
    return "".join(f"{a & 0xFFFFFFFF:08x}" for a in anchors_)


def alike(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def statistics(text):
    """The statistics of the quality classifier, letter by letter."""
    b = (text or "").encode()
    kinds = {"upper": range(65, 91), "digit": range(48, 58), "symbol": b"#$%&*^~=_<>{}[]\\@+", "bang": b"!?", "pipe": b"|", "stop": b".,;:", "newline": b"\n", "space": b" \t", "wide": range(128, 256)}
    out = {k: sum(x in v for x in b) / len(b) if b else 0.0 for k, v in kinds.items()}
    out |= {"log_bytes": math.log1p(len(b)), "word_len": 0.0, "distinct_words": 1.0, "distinct_grams": 1.0, "top_word": 0.0, "distinct_lines": 1.0}
    low = bytes(x + 32 if 65 <= x <= 90 else x for x in b)
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    if words:
        out["word_len"] = sum(map(len, words)) / len(words)
        out["distinct_words"] = len(set(words)) / len(words)
        out["top_word"] = max(Counter(words).values()) / len(words)
        if len(words) >= 4:
            grams = [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
            out["distinct_grams"] = len(set(grams)) / len(grams)
    lines = re.findall(rb"[^\n\r]+", low)
    if lines:
        out["distinct_lines"] = len(set(lines)) / len(lines)
    return out


def score(model, text):
    x = statistics(text)
    z = model.bias + sum(w for rule, w in model.rules if all((x[s] > t) == above for s, above, t in rule.terms))
    return 1 / (1 + math.exp(-z))
