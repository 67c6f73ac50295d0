"""Personal data by a semi-Markov conditional random field.

Base patterns (e-mail, IP, card, phone) are matched first and always stay.  The
rest of a text is cut into windows around digits, ``@`` and spelled-out ``at ...
dot``.  In a window every run of at most ``MAX_TOKENS`` tokens is a candidate
segment of every kind it could be; features look at the whole run (digits,
groups, Luhn, separators, what stands beside it), and dynamic programming over
the window picks boundaries and kinds together: the segmentation of highest
total score, tokens outside entities scoring 0.

Weights maximise the conditional likelihood (forward-backward over segments) on
a bounded sample of windows of the corpus (``SAMPLE``, in hash order): its own
base matches, and the same windows respelled (``name at host dot com``, a phone
without its prefix), so that the field learns what the patterns miss.  A few
fixed windows of each kind are always among them.

Texts are scanned where they lie; no shuffle but the sample's.  The scan is
linear in a text's length: patterns are tried at run starts only, and segments
are bounded.

Defined results: a null or empty text has no spans; repeated rows give repeated
results; extra columns are kept by :func:`redact` and not read by :func:`find`.
Kinds are listed as email, ip, card, phone; equal starts go by end.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from almanac.llm.common import columns

KINDS = ("email", "ip", "card", "phone")
#: Longest entity in tokens; windows of the corpus the field is fitted on.
MAX_TOKENS, SAMPLE = 16, 300
#: First tokens whose candidates are held at a time.
STEP = 2048

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")      # possessive: no stack as long as the match
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A host after "at": its dots spelled out, or a word with a dot inside.
_HOST_DOT = r" ?[^\s.]{1,63}\.[^\W_]"
_CUE = re.compile(r"[0-9@]|(?i:[ (\[{<]at[ )\]}>](?=.{1,60}?[ (\[{<](?:dot|punkt|point|punto)[ )\]}>]|" + _HOST_DOT + "))")
_ANY_CUE = re.compile(r"[0-9@]|(?i:[ (\[{<](?:dot|punkt|point|punto)[ )\]}>]|[ (\[{<]at[ )\]}>](?=" + _HOST_DOT + "))")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\s]")
# Words that spell out a sign, and words that announce a kind.
AT, DOT = {"at", "@"}, {"dot", "punkt", "point", "punto", "."}
ANNOUNCE = (("mail", "email", "contact", "write"), ("ip", "host", "server", "address"), ("card", "visa", "mastercard", "credit"),
            ("phone", "tel", "call", "fax", "mobile"))


# -- base patterns ----------------------------------------------------------
def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` from
    each ``@`` backwards, so a long run without one costs nothing."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((begin, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) in the order of kinds, then starts."""
    if not text or not _ANY_CUE.search(text):
        return []
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(_byte(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


# -- windows ------------------------------------------------------------------
@dataclass
class Window:
    """Tokens (start, end in the text) of a part of a text."""
    text: str
    tokens: list[tuple[int, int]]


def ranges(text: str, taken: list[tuple[int, int, int]] = ()) -> Iterator[tuple[int, int]]:
    """Parts around cues, outside the spans already taken, one after another."""
    free, at = [], 0
    for a, b in sorted((a, b) for _, a, b in taken):
        if a > at:
            free.append((at, a))
        at = max(at, b)
    free.append((at, len(text)))
    for lo, hi in free:
        first = last = -1
        for m in _CUE.finditer(text, lo, hi):
            s = m.start()
            if first >= 0 and s - last > 100:          # 100 characters hold an entity and its context
                yield max(lo, first - 80), min(hi, last + 80)
                first = s
            elif first < 0:
                first = s
            last = s
        if first >= 0:
            yield max(lo, first - 80), min(hi, last + 80)


def windows(text: str, taken: list[tuple[int, int, int]] = ()) -> list[Window]:
    """The parts of :func:`ranges` with their tokens."""
    found = (Window(text, [m.span() for m in _TOKEN.finditer(text, a, b)]) for a, b in ranges(text, taken))
    return [w for w in found if w.tokens]


# -- segments -----------------------------------------------------------------
FEATURES = ("bias", "at sign", "at word", "dots after at", "letters first", "letters last", "no local part", "open gap",
            "digits 7-9", "digits 10", "digits 11-15", "digits 16-19", "other digits", "luhn", "four bytes", "plus", "bracket",
            "groups 3-3-4", "groups of 4", "one group", "letters", "odd sign", "announced", "glued before", "glued after",
            "sign before", "sign after", "tokens", "mixed separators")


def _before(mask) -> np.ndarray:
    """How many of the first 0, 1, ... are true (or their sum)."""
    return np.concatenate(([0], np.cumsum(np.asarray(mask, np.int64))))


def segments(w: Window, first: int = 0, stop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Candidates ``(first token, last token + 1, kind)`` and their features, by
    first token, last token, kind; only those whose first token is in ``[first, stop)``."""
    text, tokens = w.text, w.tokens
    words = [text[a:b] for a, b in tokens]
    low = [x.lower() for x in words]
    n = len(words)
    stop = n if stop is None else min(stop, n)
    digits = [len(x) if x.isascii() and x.isdigit() else 0 for x in words]
    is_at = [x in AT for x in low]
    is_dot = [x in DOT for x in low]
    alnum = np.array([x[0].isalnum() for x in words], bool)
    size, ats = _before(digits), _before(is_at)
    begins = alnum | np.array([x in "+(" for x in words], bool)
    ends = np.array([x[-1].isalnum() for x in words], bool)
    i = np.repeat(np.arange(first, stop), MAX_TOKENS)
    j = i + np.tile(np.arange(1, MAX_TOKENS + 1), max(0, stop - first))
    ok = (j <= n) & begins[i]
    i, j = i[ok], j[ok]
    own = np.array(digits, np.int64)
    ok = ends[j - 1] & (j >= i + 2 - (own[i] > 6))
    i, j = i[ok], j[ok]
    d, a = size[j] - size[i], ats[j] - ats[i]
    spans, feats = [np.empty((0, 3), np.int64)], [np.empty((0, len(FEATURES)))]
    plus = np.array([x == "+" for x in words], bool)
    number = (d >= 4) & (d <= 19) & (a == 0) & ((own[i] > 0) | plus[i] | np.array([x == "(" for x in words], bool)[i])
    if number.any():
        for k, part, f in number_features(w, words, low, own, alnum, np.array(is_dot, bool), size, i[number], j[number], d[number]):
            spans.append(np.column_stack([part, np.full(len(part), k)]))
            feats.append(f)
    mail = (a == 1) & (j - i >= 4) & ~((own[i] > 0) & plus[i])
    found = [(x, y, f) for x, y in zip(i[mail].tolist(), j[mail].tolist())
             if (f := email_features(w, words, low, is_at, is_dot, digits, x, y)) is not None]
    if found:
        spans.append(np.array([(x, y, 0) for x, y, _ in found], np.int64))
        feats.append(np.array([f for _, _, f in found], float))
    s, x = np.concatenate(spans), np.concatenate(feats)
    order = np.lexsort((s[:, 2], s[:, 1], s[:, 0]))
    s, x = s[order], x[order]
    for k, names in enumerate(ANNOUNCE):
        told, mine = _before([v in names for v in low]), s[:, 2] == k
        at = s[mine, 0]
        x[mine, 22] = told[at] > told[np.maximum(at - 3, 0)]
    return s, x


def _beside(w: Window, i: int, j: int, f: list[float]) -> None:
    a, b = w.tokens[i][0], w.tokens[j - 1][1]
    f[23], f[25] = _left(w.text, a)
    f[24], f[26] = _right(w.text, b)
    f[27] = (j - i) / MAX_TOKENS


def _left(text: str, a: int) -> tuple[bool, bool]:
    before = text[a - 1:a]
    return before.isalnum() or before == "_", before in tuple("=\"'/#:.-+") and bool(before)


def _right(text: str, b: int) -> tuple[bool, bool]:
    after = text[b:b + 1]
    return after.isalnum() or after == "_", bool(after) and after in "=\"'/#:@-" and text[b + 1:b + 2].isalnum()


def email_features(w, words, low, is_at, is_dot, digits, i, j):
    at = next(t for t in range(i, j) if is_at[t])
    if at == i or at == j - 1:
        return None
    f = [0.0] * len(FEATURES)
    dots = gap = odd = run = 0
    spelled = low[at] == "at"
    for t in range(i, j):
        name = words[t][0].isalnum() and not is_at[t] and not is_dot[t]
        run = run + 1 if name and t > i and w.tokens[t][0] > w.tokens[t - 1][1] else 0 if not name else run
        dots += is_dot[t] and t > at
        if not name and not is_at[t] and not is_dot[t] and words[t] not in "[](){}<>_%+-":
            odd += 1
        if name and t > i and t != at and words[t - 1][0].isalnum() and not is_dot[t - 1] and not is_at[t - 1] \
                and w.tokens[t][0] > w.tokens[t - 1][1]:
            gap += 1               # two names with a blank and no sign between them
        if t > i and words[t - 1] == "." and w.tokens[t][0] > w.tokens[t - 1][1] == w.tokens[t - 2][1] + 1:
            gap += 1               # a full stop
    if dots == 0 and not spelled and low[at] != "@":
        return None
    f[0], f[1], f[2], f[3] = 1, not spelled, spelled, min(dots, 3) / 3
    f[4], f[5] = not digits[i], not digits[j - 1] and 2 <= len(words[j - 1]) <= 6
    f[6] = not words[at - 1][0].isalnum() and words[at - 1] not in "[({<"
    f[7], f[21] = min(gap, 3) / 3, min(odd, 3) / 3
    f[14] = dots > 0
    _beside(w, i, j, f)
    return f


def number_features(w, words, low, own, alnum, is_dot, size, i, j, d):
    """For each kind, the runs of tokens ``i..j`` with ``d`` digits that could be
    one, and their features, the same for each kind: all from running sums."""
    letters = _before(np.array([x[0].isalpha() for x in words], bool) & ~is_dot)
    odd = _before(~alnum & ~np.array([x in "+-.()[]" for x in words], bool))
    ok = (letters[j] - letters[i] <= 1) & (odd[j] - odd[i] <= 1)
    i, j, d = i[ok], j[ok], d[ok]
    dots = _before(is_dot)
    dots = dots[j] - dots[i]
    group = _before(own > 0)
    x, y = group[i], group[j]                      # its groups of digits are x..y
    length = own[own > 0]
    numbers = [words[t] for t in np.flatnonzero(own).tolist()]
    fours, small = _before(length == 4), _before([_byte(v) for v in numbers])
    f = np.zeros((len(i), len(FEATURES)))
    f[:, 0], f[:, 8], f[:, 9] = 1, (d >= 7) & (d <= 9), d == 10
    f[:, 10], f[:, 11], f[:, 12] = (d >= 11) & (d <= 15), (d >= 16) & (d <= 19), (d < 7) | (d > 19)
    f[:, 13] = (d >= 13) & _luhn("".join(numbers), size[i], size[j])
    f[:, 14] = (y - x == 4) & (dots >= 3) & (small[y] - small[x] == 4)
    f[:, 15], f[:, 16] = np.array([v == "+" for v in words], bool)[i], np.array([v == "(" for v in words], bool)[i]
    last = np.maximum(y, 3)
    padded = np.concatenate((length, [0, 0, 0]))
    f[:, 17] = (y - x >= 3) & (padded[last - 3] == 3) & (padded[last - 2] == 3) & (padded[last - 1] == 4)
    f[:, 18] = (y - x >= 4) & (fours[np.maximum(y - 1, x)] - fours[x] == y - x - 1)
    f[:, 19] = y - x == 1
    f[:, 20], f[:, 21] = letters[j] > letters[i], odd[j] > odd[i]
    kinds_of_sign = (odd[j] > odd[i + 1]).astype(np.int64)     # one odd sign at most
    for sign in "+-.":
        many = _before([v == sign for v in words])
        kinds_of_sign += many[j] > many[i + 1]
    f[:, 28] = kinds_of_sign > 1
    used = np.unique(i)
    f[:, [23, 25]] = np.array([_left(w.text, w.tokens[t][0]) for t in used.tolist()], float).reshape(-1, 2)[np.searchsorted(used, i)]
    used = np.unique(j)
    f[:, [24, 26]] = np.array([_right(w.text, w.tokens[t - 1][1]) for t in used.tolist()], float).reshape(-1, 2)[np.searchsorted(used, j)]
    f[:, 27] = (j - i) / MAX_TOKENS
    for k, pick in ((1, (y - x == 4) & (dots >= 3)), (2, d >= 13), (3, (d >= 7) & (d <= 15))):
        yield k, np.column_stack([i[pick], j[pick]]), f[pick]


def _luhn(digits: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Luhn's test of each ``digits[a:b]``, from one running sum for either parity."""
    plain = np.frombuffer(digits.encode(), np.uint8).astype(np.int64) - 48
    double = 2 * plain - 9 * (plain > 4)
    even = np.arange(len(plain)) % 2 == 0
    sums = np.stack([_before(np.where(even, plain, double)), _before(np.where(even, double, plain))])
    side = (b - 1) % 2
    return (sums[side, b] - sums[side, a]) % 10 == 0


# -- the field ----------------------------------------------------------------
class Field:
    def __init__(self, weights: np.ndarray):
        self.weights = weights         # kind x feature

    def scores(self, spans: np.ndarray, feats: np.ndarray) -> np.ndarray:
        return np.einsum("sf,sf->s", feats, self.weights[spans[:, 2]])

    def best(self, text: str, a: int, b: int, step: int = STEP) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the best segmentation of ``text[a:b]``.  Only the
        tokens and candidates of ``step`` first tokens are held at a time; of
        earlier ones the best score, the last segment and the place stay."""
        tokens = (m.span() for m in _TOKEN.finditer(text, a, b))
        held: list[tuple[int, int]] = []
        behind = done = 0                           # held[0] is token number done - behind
        begin, end = array("q"), array("q")
        best, back = array("d", [0.0]), array("B", [0])   # back: tokens of the segment times 4, and its kind
        while True:
            held += islice(tokens, step + MAX_TOKENS - (len(held) - behind))
            stop = min(len(held), behind + step)
            if stop == behind:
                break
            w = Window(text, held)
            begin.extend(x for x, _ in held[behind:stop])
            end.extend(y for _, y in held[behind:stop])
            more = done + len(held) - behind + 1 - len(best)
            best.extend([-1.0] * more)
            back.extend([0] * more)
            spans, feats = segments(w, behind, stop)
            score = self.scores(spans, feats)
            good = np.flatnonzero(score > 0)               # others never beat tokens outside
            spans, score = spans[good].tolist(), score[good].tolist()
            r = 0
            for t in range(behind, stop):
                i = done + t - behind
                if i and best[i] <= best[i - 1]:
                    best[i], back[i] = best[i - 1], 0
                while r < len(spans) and spans[r][0] == t:
                    j, k = i + spans[r][1] - t, spans[r][2]
                    if best[i] + score[r] > best[j]:
                        best[j], back[j] = best[i] + score[r], 4 * (j - i) + k
                    r += 1
            done += stop - behind
            keep = min(stop, 3)                            # words that announce a kind
            held, behind = held[stop - keep:], keep
        out, j = [], len(begin)
        if j and best[j] <= best[j - 1]:
            back[j] = 0
        while j > 0:
            size, k = divmod(back[j], 4)
            if size:
                out.append((k, begin[j - size], end[j - 1]))
            j -= size or 1
        return out[::-1]

    def find(self, text: str | None, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans the field adds to those taken."""
        if not text or not _ANY_CUE.search(text):
            return []
        return [s for a, b in ranges(text, taken) for s in self.best(text, a, b)]


def marginals(n: int, spans: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, float]:
    """Probability of each segment, and the log of the sum over segmentations."""
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for r, (i, j, _) in enumerate(spans.tolist()):
        by_end[j].append(r)
        by_start[i].append(r)
    starts, ends = spans[:, 0], spans[:, 1]
    fwd, bwd = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        fwd[j] = np.logaddexp.reduce(np.append(fwd[starts[by_end[j]]] + score[by_end[j]], fwd[j - 1]))
    for i in range(n - 1, -1, -1):
        bwd[i] = np.logaddexp.reduce(np.append(bwd[ends[by_start[i]]] + score[by_start[i]], bwd[i + 1]))
    return np.exp(fwd[starts] + score + bwd[ends] - fwd[n]), float(fwd[n])


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = 15, rate: float = 0.5, l2: float = 1e-3) -> Field:
    """Weights by adaptive gradient ascent on the conditional log-likelihood of
    (text, spans) examples."""
    data = []
    for text, gold in examples:
        for w in windows(text):
            spans, feats = segments(w)
            if not len(spans):
                continue
            at = {(w.tokens[i][0], w.tokens[j - 1][1], k): r for r, (i, j, k) in enumerate(spans.tolist())}
            hit = [at[a, b, k] for k, a, b in gold if (a, b, k) in at]
            data.append((len(w.tokens), spans, feats, hit))
    field = Field(np.zeros((len(KINDS), len(FEATURES))))
    seen = np.full_like(field.weights, 1e-6)
    for _ in range(epochs):
        for n, spans, feats, hit in data:
            p, _ = marginals(n, spans, field.scores(spans, feats))
            p = -p
            p[hit] += 1
            grad = np.zeros_like(field.weights)
            np.add.at(grad, spans[:, 2], p[:, None] * feats)
            grad -= l2 * field.weights
            seen += grad * grad
            field.weights += rate * grad / np.sqrt(seen)
    return field


# -- examples -----------------------------------------------------------------
_RESPELL = ((" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", "."))


def respelled(text: str, spans: list[tuple[int, int, int]], turn: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its spans written another way, and the spans there."""
    out, gold, at, size = [], [], 0, 0
    for k, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        s = text[a:b]
        if k == 0:
            sign, dot = _RESPELL[turn % len(_RESPELL)]
            name, host = s.split("@", 1)
            s = name + sign + host.replace(".", dot)
        elif k == 1:
            s = s.replace(".", ("[.]", " . ", " dot ")[turn % 3])
        elif k == 2:
            d = re.sub(r"\D", "", s)
            s = (".".join, "  ".join)[turn % 2](d[i:i + 4] for i in range(0, len(d), 4))
        elif k == 3:
            d = re.sub(r"\D", "", s)[-10:]
            s = (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}")[turn % 4]
        out += [text[at:a], s]
        size += a - at
        gold.append((k, size, size + len(s)))
        size += len(s)
        at = b
    return "".join([*out, text[at:]]), gold


# Windows with one entity each in braces, and windows with none.
_SEEDS = ("write to {0:ann.lee@mail.example.org} today", "from {1:10.20.30.40} at noon", "paid with {2:4539 1488 0343 6467} and left",
          "call {3:+1 (415) 555-2671} now", "tel {3:+49 30 901820} or", "host {1:192.168.7.255} is up", "card {2:6011000990139424}.",
          "to {0:j_smith@uni.example.edu}, {0:pat@shop.example.com}")
_CLEAN = ("token = \"c98d9a1150f1d4e63716d28d8d79037ff2b9eba6\" here", "password=2258aeea27ea158d31 st", "version 3. In 2024, 4.0 of 12",
          "at 10:30 on 2021-05-17", "number 1234567890123456 of lot 77", "sum 12,345.67 and 1 000 000 more", "isbn 9783161484100 page 1024-1051",
          "he sat at home and the dot on the map was red", "order 20240517-000123 shipped", "id=8f3a1b2c 0011223344556677", "v1.2.3 and 1.2.3.4.5 then 999.1.1.1",
          "look at this dot dot dot now", "we met at the point of it", "5555 5555 5555 and 1111", "12 34 56 78 90 12 34")


def seeds() -> list[tuple[str, list[tuple[int, int, int]]]]:
    out = [(t, []) for t in _CLEAN]
    for s in _SEEDS:
        text, spans = "", []
        for part in re.split(r"(\{\d:[^}]*\})", s):
            if part.startswith("{"):
                spans.append((int(part[1]), len(text), len(text) + len(part) - 4))
                part = part[3:-1]
            text += part
        out += [(text, spans), *(respelled(text, spans, turn) for turn in range(4))]
    return out


def sample(docs: DataFrame, size: int = SAMPLE) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """At most ``size`` snippets of the corpus (about 200 characters each) with
    their base spans, those with the smallest hashes over all documents, kinds
    taken in equal shares with snippets without any."""

    share = size // (len(KINDS) + 1)

    def run(batches):
        found: dict[int, set[tuple[int, str]]] = {}
        for b in batches:
            for t in b.column(1).to_pylist():
                taken = base_spans(t)
                for w in windows(t) if t and _ANY_CUE.search(t) else ():
                    lo, hi = w.tokens[0][0], w.tokens[-1][1]
                    if hi - lo <= 400:
                        kind = next((k for k, a, e in taken if lo <= a and e <= hi), -1)
                        found.setdefault(kind, set()).add((xxhash.xxh3_64_intdigest(t[lo:hi].encode()) >> 1, t[lo:hi]))
            found = {k: set(heapq.nsmallest(share, v)) for k, v in found.items()}   # a task keeps no more
        rows = [(k, *x) for k, v in sorted(found.items()) for x in sorted(v)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.string()))],
                                         names=["kind", "h", "snippet"])

    found = columns(docs).mapInArrow(run, "kind int, h long, snippet string").distinct()
    rank = F.row_number().over(Over.partitionBy("kind").orderBy("h", "snippet"))
    picked = found.withColumn("rank", rank).where(F.col("rank") <= share).orderBy("kind", "rank").collect()
    return [(r.snippet, base_spans(r.snippet)) for r in picked]


def learn(docs: DataFrame, size: int = SAMPLE) -> Field:
    own = sample(docs, size)
    more = [respelled(t, s, i) for i, (t, s) in enumerate(own) if s]
    return fit(own + more + seeds())


# -- Spark --------------------------------------------------------------------
def all_spans(text: str | None, field: Field) -> tuple[list, list]:
    """(base spans, all spans), each by kind, then start, then end."""
    base = base_spans(text)
    return base, sorted(base + field.find(text, base)) if text else []


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (base), ``base_spans``,
    ``spans`` (all), as strings."""
    weights = (field or learn(docs)).weights

    def run(batches):
        model = Field(weights)
        for b in batches:
            rows = [all_spans(t, model) for t in b.column(1).to_pylist()]
            counts = [[sum(s[0] == k for s in base) for base, _ in rows] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array([joined(x) for x, _ in rows], pa.string()),
                 pa.array([joined(x) for _, x in rows], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])

    return columns(docs).mapInArrow(
        run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_spans string, spans string")


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span, merged with those it overlaps, becomes ``<KIND>`` of the first."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """The documents, same columns and rows, with every span replaced in
    ``text`` and ``n_chars`` counted anew where there is one."""
    weights = (field or learn(docs)).weights
    names = docs.columns

    def run(batches):
        model = Field(weights)
        for b in batches:
            at = names.index("text")
            texts = [redacted(t, all_spans(t, model)[1]) if t else t for t in b.column(at).to_pylist()]
            b = b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))
            if "n_chars" in names:
                i = names.index("n_chars")
                f = b.schema.field(i)
                b = b.set_column(i, f, pa.array([None if t is None else len(t) for t in texts], f.type))
            yield b

    return docs.mapInArrow(run, docs.schema)


