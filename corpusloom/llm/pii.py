"""Personal data by a semi-Markov conditional random field.

Base spans (email, ip, card, phone) come from exact patterns and always stay. The
field adds what the patterns miss: phone numbers without a plus, spelt-out
addresses of mail, numbers in other groupings. It scores whole candidate segments
(how many digits, in which groups, which shape, Luhn's sum, the words before), with transitions
between kinds, and a dynamic program over segments of bounded length chooses
boundaries and kinds together. Weights are learnt here, by exact gradients of the
field's likelihood on sentences made from templates with a fixed seed.

Segments can only lie in stretches near a digit or an @ or a spelt-out one; tokens
elsewhere are outside in every labelling, so the program runs over those stretches.
A stretch has any length: the program goes through it token by token and keeps the
scores of the last LONGEST tokens and two small numbers a token to go back by.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keyed, unkeyed

#: Kinds in the order that breaks ties of a start.
KINDS = ("email", "ip", "card", "phone")

#: Tokens of the longest segment.
LONGEST = 15

#: Tokens of context kept on each side of a trigger.
CONTEXT = 4

#: By how much a labelling with a segment must beat one without it: added spans have to be sure.
MARGIN = 1.0

#: Weight of what no labelling may have: an added card whose digits fail Luhn's sum.
NEVER = -1e9

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\sA-Za-z0-9]")
_TRIGGER = re.compile(r"[0-9@]|\(at\)|\[at\]| at [A-Za-z0-9-]+ dot ", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the exact patterns, leftmost and non-overlapping per kind, in time linear in the text."""
    out: list[tuple[int, str, int]] = []
    at, stop = text.find("@"), 0
    while at >= 0:
        lo = at
        while lo > stop and _LOCAL.match(text, lo - 1):
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, "email", m.end()))
            stop = m.end()
        else:
            stop = max(stop, at + 1)  # no later address reaches over an @
        at = text.find("@", max(at + 1, stop))
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((m.start(), "ip", m.end()))
    for m in _CARD.finditer(text):
        if 14 <= len(m[0]) <= 60 and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append((m.start(), "card", m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append((m.start(), "phone", m.end()))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


# ---- the field ----------------------------------------------------------------

_WORDS = {
    "phone": frozenset("phone tel telephone call mobile cell fax whatsapp sms ring telefon telefono móvil appelez".split()),
    "email": frozenset("email mail contact write reach address correo courriel".split()),
    "card": frozenset("card visa mastercard amex credit debit karte tarjeta carte pan".split()),
    "ip": frozenset("ip host server address dns gateway login".split()),
}
_SHAPES = {
    "phone_us": re.compile(r"(?:1[ .-])?\(?[2-9]\d{2}\)?[ .-]{1,2}\d{3}[ .-]\d{4}"),
    "phone_intl": re.compile(r"(?:\+|00)\d{1,3}(?:[ .()-]{1,2}\d{2,4}){2,5}"),
    "phone_eu": re.compile(r"0\d{1,4}(?:[ .-]\d{2,4}){2,5}"),
    "phone_slash": re.compile(r"0\d{2,5} ?/ ?\d{3,9}"),
    "card": re.compile(r"\d{4}(?P<s>[ .-]?)\d{4}(?P=s)\d{4}(?P=s)\d{2,4}(?:(?P=s)\d{1,3})?"),
    "amex": re.compile(r"3[47]\d{2}[ .-]?\d{6}[ .-]?\d{5}"),
    "ip": re.compile(r"\d{1,3}(?: ?(?:\.|\[\.\]|\(\.\)|dot) ?\d{1,3}){3}"),
    "email": re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+"),
    "email_spelt": re.compile(r"[\w.%+-]+ ?(?:\(at\)|\[at\]|@| at ) ?[\w-]+(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[\w-]+)* ?(?:\.|\(dot\)|\[dot\]| dot ) ?[a-z]{2,6}", re.I),
    "date": re.compile(r"\d{1,4}[./-]\d{1,2}[./-]\d{1,4}"),
    "number": re.compile(r"\d+(?:[.,]\d+)*"),
}
#: Numbers in groups, whatever the separators are; their digits are looked at apart.
_GROUPED = re.compile(r"\+?\(?\d+(?:[ ./()_-]{1,3}\d+)*")
_RUNS = re.compile(r"\d+|[^\d]+")
#: Last words of an address (fixed values).
_TLD = frozenset("com org net edu gov io info biz eu de fr es it nl ch uk us ca co au jp in br se no dk fi pl pt at be".split())
_MARKED = re.compile(r"\((?:at|dot)\)|\[(?:at|dot)\]", re.I)
_LAST = re.compile(r"[A-Za-z]*$")
_MORE_LEFT, _MORE_RIGHT = re.compile(r"[0-9][ ./()-]{1,2}$"), re.compile(r"[ ./()-]{1,2}[0-9]")
#: Features of a segment; each has a weight for each kind.
FEATURES = ["bias", *(f"shape_{s}" for s in _SHAPES), "luhn", "d_lt7", "d_7_9", "d_10_15", "d_14_19", "d_gt19", "no_shape", "octets", "plus", "letters", *(f"before_{k}" for k in KINDS), "glued_left", "glued_right", "tld", "marked", "more_left", "more_right", "unbalanced", "not_luhn", "grouped", "one_separator", "wide_groups", "narrow_group", "lead_00", "lead_0", "lead_area", "tail_4", "as_phone", "trunk", "area", "beyond_phone"]
_F = len(FEATURES)
_AT = {f: i for i, f in enumerate(FEATURES)}


def grouped(s: str) -> list[int]:
    """The features of digits in groups: how they begin and end, how wide groups are, whether one separator parts all."""
    runs = _RUNS.findall(s)
    wide = [len(r) for r in runs if r[0].isdigit()]
    within = {r for i, r in enumerate(runs) if not r[0].isdigit() and 0 < i < len(runs) - 1}
    first = next(r for r in runs if r[0].isdigit())
    holds = {
        "grouped": len(wide) > 1,
        "one_separator": len(within) == 1,
        "wide_groups": len(wide) > 1 and min(wide) >= 4,
        "narrow_group": min(wide) < 2,
        "lead_00": first.startswith("00"),
        "lead_0": first.startswith("0") and not first.startswith("00"),
        "lead_area": len(wide) in (3, 4) and wide[-3:-1] == [3, 3],
        "tail_4": len(wide) > 1 and wide[-1] == 4,
        "as_phone": len(wide) > 1 and 10 <= sum(wide) <= 13,
        "trunk": len(wide) > 1 and 10 <= sum(wide) <= 13 and first.startswith("0"),
        "area": wide[-3:] == [3, 3, 4] and (len(wide) == 3 or len(wide) == 4 and wide[0] < 4),
        "beyond_phone": sum(wide) >= 14,
    }
    return [_AT[f] for f, h in holds.items() if h]


def features(text: str, lo: int, hi: int, before: list[str]) -> list[int]:
    """The features that hold for text[lo:hi] as a whole."""
    s = text[lo:hi]
    digits = "".join(_DIGITS.findall(s))
    n, on = len(digits), [0]
    shaped = False
    for name, shape in _SHAPES.items():
        if shape.fullmatch(s):
            on.append(_AT[f"shape_{name}"])
            shaped = True
    groups = grouped(s) if n >= 7 and _GROUPED.fullmatch(s) else []
    if not shaped and not groups:
        on.append(_AT["no_shape"])
    on.append(_AT["luhn" if 13 <= n <= 19 and luhn(digits) else "not_luhn"])
    on += groups
    if n < 7:
        on.append(_AT["d_lt7"])
    if 7 <= n <= 9:
        on.append(_AT["d_7_9"])
    if 10 <= n <= 15:
        on.append(_AT["d_10_15"])
    if 14 <= n <= 19:
        on.append(_AT["d_14_19"])
    if n > 19:
        on.append(_AT["d_gt19"])
    if "+" in s:
        on.append(_AT["plus"])
    if re.search("[A-Za-z]", s):
        on.append(_AT["letters"])
    octets = re.findall(r"\d+", s)
    if len(octets) == 4 and all(len(o) <= 3 and int(o) <= 255 for o in octets):
        on.append(_AT["octets"])
    for k in KINDS:
        if not _WORDS[k].isdisjoint(before):
            on.append(_AT[f"before_{k}"])
    if lo and (text[lo - 1].isalnum() or text[lo - 1] in "+@=\"_%$#/-."):
        on.append(_AT["glued_left"])
    if hi < len(text) and (text[hi].isalnum() or text[hi] in "@=\"_%$#/-" or (text[hi] == "." and text[hi + 1 : hi + 2].isalnum())):
        on.append(_AT["glued_right"])
    if _AT["shape_email_spelt"] in on and _LAST.search(s)[0].lower() in _TLD:
        on.append(_AT["tld"])
    if _MARKED.search(s):
        on.append(_AT["marked"])
    if n and _MORE_LEFT.search(text, max(0, lo - 3), lo):
        on.append(_AT["more_left"])
    if n and _MORE_RIGHT.match(text, hi):
        on.append(_AT["more_right"])
    if s.count("(") != s.count(")"):
        on.append(_AT["unbalanced"])
    return on


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Token places of each stretch near triggers; stretches do not touch."""
    at, stop = 0, len(text)
    while (m := _TRIGGER.search(text, at)) is not None:
        lo, hi = max(at, m.start() - 60), m.end()
        while True:  # a stretch goes on while triggers follow closely
            nxt = _TRIGGER.search(text, hi, min(stop, hi + 60))
            if nxt is None:
                break
            hi = nxt.end()
        while lo > at and not text[lo - 1].isspace() and m.start() - lo < 120:
            lo -= 1
        end = min(stop, hi + 60)
        while end < stop and not text[end].isspace() and end - hi < 120:
            end += 1
        tokens = [t.span() for t in _TOKEN.finditer(text, lo, end)]
        if tokens:
            yield tokens
        at = max(end, m.end())


def segments(text: str, tokens: list[tuple[int, int]]) -> Iterator[list[tuple[int, list[int]]]]:
    """For each token in turn, the segments that begin there and may be an entity: (last token + 1, features)."""
    kind = [text[a] for a, _ in tokens]
    for i, (a, _) in enumerate(tokens):
        out: list[tuple[int, list[int]]] = []
        if kind[i].isalnum() or kind[i] in "+(":
            before = [text[x:y].lower() for x, y in tokens[max(0, i - CONTEXT) : i]]
            digits = False
            for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
                x, b = tokens[j - 1]
                if j - i > 1 and x - tokens[j - 2][1] > 2 or "\n" in text[a:b]:
                    break
                digits = digits or kind[j - 1].isdigit() or kind[j - 1] == "@"
                if kind[j - 1].isalnum() and (digits or _TRIGGER.search(text, a, b)):
                    out.append((j, features(text, a, b, before)))
        yield out


def candidates(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """(first token, last token + 1, features) of all segments that may be an entity; for training."""
    return [(i, j, on) for i, own in enumerate(segments(text, tokens)) for j, on in own]


def _log_sum(x: np.ndarray) -> float:
    m = x.max()
    return float(m + np.log(np.exp(x - m).sum()))


def _log_sums(x: np.ndarray) -> np.ndarray:
    """By column."""
    m = x.max(axis=0)
    safe = np.where(np.isfinite(m), m, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(x - safe).sum(axis=0))


class Field:
    """Weights: w[kind, feature] of segments, t[kind before, kind] where segments touch or follow."""

    def __init__(self, w: np.ndarray, t: np.ndarray) -> None:
        self.w, self.t = w, t

    def potentials(self, cands: list[tuple[int, int, list[int]]]) -> np.ndarray:
        return np.array([self.w[:, on].sum(axis=1) for _, _, on in cands]) if cands else np.zeros((0, len(KINDS)))

    def best(self, n: int, starting: Iterable[list[tuple[int, list[int]]]]) -> list[tuple[int, int, int]]:
        """(first, last + 1, kind) of the labelling of n tokens with the highest score.

        starting gives, for each token in turn, the segments that begin there. State 0
        is outside (one token each), 1.. are the kinds; ahead[j][s] is the best score of
        the first j tokens with the last segment in state s. Among equals the earlier
        start wins, then the smaller state.
        """
        m, t = len(KINDS) + 1, self.t.tolist()
        low = [-math.inf] * m
        ahead: dict[int, list[float]] = {0: [0.0, *low[1:]]}
        begun, came = array("q", bytes(8 * m * (n + 1))), bytearray(m * (n + 1))
        score = low
        for i, own in enumerate(starting):
            score = ahead.pop(i)
            s = max(range(m), key=score.__getitem__)
            after = ahead.setdefault(i + 1, [*low])
            if score[s] > after[0]:
                after[0], begun[(i + 1) * m], came[(i + 1) * m] = score[s], i, s
            if not own:
                continue
            enter = [max(range(m), key=lambda x: score[x] + t[x][k]) for k in range(1, m)]  # noqa: B023
            base = [score[x] + t[x][k + 1] - MARGIN for k, x in enumerate(enter)]
            for j, on in own:
                to, w = ahead.setdefault(j, [*low]), self.w[:, on].sum(axis=1).tolist()
                for k in range(1, m):
                    if (v := base[k - 1] + w[k - 1]) > to[k]:
                        to[k], begun[j * m + k], came[j * m + k] = v, i, enter[k - 1]
        out, j = [], n
        score = ahead[n]
        s = max(range(m), key=score.__getitem__)
        while j > 0:
            i, before = begun[j * m + s], came[j * m + s]
            if s:
                out.append((i, j, s - 1))
            j, s = i, before
        return out[::-1]

    def gradient(self, n: int, cands: list, gold: dict[tuple[int, int], int], dw: np.ndarray, dt: np.ndarray) -> float:
        """Adds the gradient of the log-likelihood of gold (segment: kind); returns the log-likelihood."""
        q, m = self.potentials(cands), len(KINDS) + 1
        ending: dict[int, list[int]] = {}
        for c, (_, j, _) in enumerate(cands):
            ending.setdefault(j, []).append(c)
        a = np.full((n + 1, m), -np.inf)
        a[0, 0] = 0.0
        enter = np.zeros((len(cands), m, m - 1))  # by the state before and the kind
        for j in range(1, n + 1):
            a[j, 0] = _log_sum(a[j - 1])
            if own := ending.get(j):
                for c in own:
                    enter[c] = a[cands[c][0]][:, None] + self.t[:, 1:] + q[c]
                a[j, 1:] = _log_sums(enter[own].reshape(-1, m - 1))
        z = _log_sum(a[n])
        b = np.full((n + 1, m), -np.inf)  # of the tokens after j, given the state that ends at j
        b[n] = 0.0
        starting: dict[int, list[int]] = {}
        for c, (i, _, _) in enumerate(cands):
            starting.setdefault(i, []).append(c)
        for i in range(n - 1, -1, -1):
            parts = [np.full((1, m), b[i + 1, 0])]
            parts += [(self.t[:, 1:] + (q[c] + b[cands[c][1], 1:])).T for c in starting.get(i, ())]
            b[i] = _log_sums(np.concatenate(parts)) if len(parts) > 1 else b[i + 1, 0]
        like, taken = 0.0, {}
        for (i, j), k in gold.items():
            taken[j] = (i, k + 1)
        j, state = n, None
        order: list[tuple[int, int, int]] = []
        while j > 0:
            if j in taken:
                order.append((taken[j][0], j, taken[j][1]))
                j = taken[j][0]
            else:
                order.append((j - 1, j, 0))
                j -= 1
        state = 0
        where = {(i, j): c for c, (i, j, _) in enumerate(cands)}
        for i, j, s in reversed(order):
            if s:
                c = where[i, j]
                like += q[c, s - 1] + self.t[state, s]
                dw[s - 1, cands[c][2]] += 1
                dt[state, s] += 1
            state = s
        for c, (_, j, on) in enumerate(cands):
            p = np.exp(enter[c] + b[j, 1:] - z)
            dw[:, on] -= p.sum(axis=0)[:, None]
            dt[:, 1:] -= p
        return like - z


def examples(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Sentences made from templates, with their spans; a third hold only look-alikes."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    digits = lambda k: "".join(str(int(d)) for d in rng.integers(0, 10, k))
    letters = lambda k: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, k))
    word = lambda: pick(["the", "and", "ention", "thre", "oner", "ing", "die", "les", "que", letters(int(rng.integers(2, 9)))])

    def card() -> str:
        d = pick(["4", "5", "37", "6"])
        d += digits((15 if d == "37" else 16) - 1 - len(d))
        d += next(c for c in "0123456789" if luhn(d + c))
        cuts = pick([[4, 10], [4, 9]] if len(d) == 15 else [[4, 8, 12], [4, 8, 12], [4, 8, 12], [6, 12]])
        return pick(["", " ", "-", ".", "_", " - "]).join(d[i:j] for i, j in zip([0, *cuts], [*cuts, len(d)], strict=True))

    def phone() -> str:
        area, mid, end = str(int(rng.integers(200, 999))), digits(3), digits(4)
        return pick([f"+1 ({area}) {mid}-{end}", f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"+49 {digits(3)} {digits(4)} {digits(3)}", f"0{digits(3)} {digits(3)} {digits(3)}", f"0{digits(3)}/{digits(6)}", f"00{pick(['49', '33', '44'])} {digits(3)} {digits(3)} {digits(3)}", f"00{pick(['49', '33', '44'])}-{digits(2)}-{digits(8)}", f"0{digits(4)}-{digits(6)}", f"({area}).{mid}.{end}"])

    def mail() -> str:
        a, b, c = letters(int(rng.integers(2, 9))), letters(int(rng.integers(3, 9))), pick(["com", "org", "net", "de"])
        return pick([f"{a}@{b}.{c}", f"{a}.{digits(2)}@{b}.{c}", f"{a} (at) {b} (dot) {c}", f"{a} [at] {b} [dot] {c}", f"{a} at {b} dot {c}", f"{a}(at){b}.{c}"])

    def ip() -> str:
        o = [str(int(x)) for x in rng.integers(0, 256, 4)]
        return pick([".".join(o), "[.]".join(o), " dot ".join(o)])

    def number() -> str:
        """Groups like a card's or an account's, whose sum is not Luhn's."""
        d = digits(int(rng.integers(13, 20)))
        d += next(c for c in "0123456789" if not luhn(d + c))
        wide = pick([3, 4, 4, 4, 5])
        return pick(["", "", "DE", letters(2).upper()]) + pick([" ", " ", "-", "."]).join(d[i : i + wide] for i in range(0, len(d), wide))

    def other() -> str:
        if rng.random() < 0.2:
            return number()
        return pick(
            [digits(int(rng.integers(1, 25))), f"{digits(2)}.{digits(2)}.{digits(4)}", f"{digits(4)}-{digits(2)}-{digits(2)}", f"{digits(2)}:{digits(2)}", f"v{digits(1)}.{digits(1)}.{digits(1)}", f"{digits(1)}.{digits(3)}.{digits(3)}", f"{digits(3)},{digits(2)}", f"{letters(6)}={letters(2)}{digits(3)}{letters(3)}{digits(5)}"]
            + [f"{digits(3)} {digits(3)}", f"{letters(3)}@{letters(4)}", f"{word()} at {word()} dot {word()}", f"at the dot {word()}", f"{digits(3)}-{digits(2)}-{digits(4)}", f"{digits(5)}-{digits(5)}-{digits(2)}", f"AKIA{digits(4)}{letters(3).upper()}{digits(5)}", f"{digits(8)}{letters(4)}{digits(9)}"]
        )

    make = {"card": card, "phone": phone, "email": mail, "ip": ip}
    out = []
    for _ in range(n):
        text, spans = " ".join(word() for _ in range(int(rng.integers(1, 5)))), []
        for _ in range(int(rng.integers(1, 3))):
            kind = pick(["card", "phone", "email", "ip", "", ""])
            if kind and rng.random() < 0.3:
                text += " " + pick(sorted(_WORDS[kind])) + pick(["", ":"])
            value = make[kind]() if kind else other()
            if kind:
                spans.append((len(text) + 1, len(text) + 1 + len(value), kind))
            text += " " + value + pick(["", ".", ","]) + " " + " ".join(word() for _ in range(int(rng.integers(1, 5))))
        out.append((text, spans))
    return out


@lru_cache(maxsize=1)
def trained(n: int = 400, rounds: int = 5, seed: int = 11) -> Field:
    """Weights by stochastic gradients (Adagrad, a little L2) on made sentences."""
    data = []
    for text, spans in examples(n, seed):
        for tokens in stretches(text):
            cands = candidates(text, tokens)
            place = {(tokens[i][0], tokens[j - 1][1]): (i, j) for i, j, _ in cands}
            gold = {place[a, b]: KINDS.index(k) for a, b, k in spans if (a, b) in place}
            if cands:
                data.append((len(tokens), cands, gold))
    field = Field(np.zeros((len(KINDS), _F)), np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    gw, gt = np.full_like(field.w, 1e-2), np.full_like(field.t, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for d in rng.permutation(len(data)):
            dw, dt = -1e-3 * field.w, -1e-3 * field.t
            field.gradient(*data[d], dw, dt)
            gw += dw * dw
            gt += dt * dt
            field.w += 0.4 * dw / np.sqrt(gw)
            field.t += 0.4 * dt / np.sqrt(gt)
    field.w[KINDS.index("card"), _AT["not_luhn"]] = NEVER
    return field


def find_spans(text: str, field: Field) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """(base spans, all spans) of a text, sorted by start, kind and end; an added span overlaps no base span."""
    base = base_spans(text)
    starts = [s for s, _, _ in base]
    reach: list[int] = []  # the furthest end of the base spans so far
    for _, _, e in base:
        reach.append(max(e, reach[-1]) if reach else e)
    added: list[tuple[int, str, int]] = []
    for tokens in stretches(text):
        for i, j, k in field.best(len(tokens), segments(text, tokens)):
            a, b = tokens[i][0], tokens[j - 1][1]
            before = bisect_left(starts, b)  # base spans that start before the end
            if not before or reach[before - 1] <= a:
                added.append((a, KINDS[k], b))
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[1]), s[2])) if added else base


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("end", T.LongType())]))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, base and spans (arrays of start, kind, end; code points, end exclusive).

    Null and empty texts have no spans; equal rows get equal spans; other columns
    are not looked at; an empty table gives no rows.
    """
    field = trained()
    rows = keyed(docs, id_col, F.col(text_col).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = lambda s: {"start": s[0], "kind": s[1], "end": s[2]}
        for b in batches:
            got = [find_spans(t or "", field) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "base": [[row(s) for s in x] for x, _ in got], "spans": [[row(s) for s in x] for _, x in got]})

    return unkeyed(rows.mapInPandas(run, T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("base", _SPAN), T.StructField("spans", _SPAN)])), docs, id_col)


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each span replaced by <KIND>; spans that overlap become one, named by the first."""
    out, at, i = [], 0, 0
    while i < len(spans):
        a, kind, b = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < b:
            b = max(b, spans[i][2])
            i += 1
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with personal data replaced in the text (null stays null); other columns as they were."""
    field = trained()

    @F.pandas_udf(T.StringType())
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in texts:
            yield pd.Series([redacted(t, find_spans(t, field)[1]) if t else t for t in b], dtype=object)

    return docs.withColumn(text_col, clean(F.col(text_col)))
