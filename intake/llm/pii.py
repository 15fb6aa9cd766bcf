"""Personal data by a semi-Markov conditional random field.

Fixed patterns find the plain forms; the model adds spans that they miss
(obfuscated, defanged or shortened forms).  Around digits, at signs and their
spelled forms a window of tokens is cut; every segment of up to ``MAX_TOKENS``
tokens is a candidate for each kind and is scored as a whole (shape, digits,
separators, checksum, octets, neighbours, cue words).  Dynamic programming over
the window chooses boundaries and kinds jointly.  Weights are trained by
conditional likelihood (forward-backward over segments) on windows of a bounded
sample whose labels are the fixed patterns' spans, together with altered copies
of these windows in which a span was given one of the forms to be learnt.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import deque
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intake.llm.common import small_batches
from intake.llm.secrets import joined

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, MAX_CHARS = 24, 72      # of a segment; mail addresses may be longer
MAIL_CHARS = 2_000                  # of an address; one of the longest, 254 characters, has less with every dot spelled out
MIN_DIGITS = 4                      # of an address of four octets; other kinds of number have more
REACH = 24                          # characters of context on both sides of what an anchor's entity may hold
TRAIN_DOCS, TRAIN_CHARS, TRAIN_WINDOWS = 1_000, 20_000, 400   # bounds of the training sample
EPOCHS, SEED = 12, 5

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match of four runs of digits always begins where a run does: looked for there only, long runs stay linear
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_ANCHOR = re.compile(r"[0-9]{3,}|[0-9][0-9.()\[\]\x20-]{5,}[0-9]|@|[(\[](?:at|dot)[)\]]", re.IGNORECASE | re.ASCII)
# a mail address to the left and right of its at sign, and what says that a span is only a part of one
_LOCAL = re.compile(r"[A-Za-z0-9_.%+-]")
_DOT_BEFORE = re.compile(r"\s?[(\[]dot[)\]]\s?\Z", re.I | re.A)
_LABEL = re.compile(r"\s?(?:[(\[]dot[)\]]|\.)[^\S\n]?[\w-]+", re.I | re.A)
_MORE_BEFORE = re.compile(r"(?:[A-Za-z0-9][._%+-]|[(\[]dot[)\]]\s?)\Z", re.I | re.A)
_MORE_AFTER = re.compile(r"[.-][A-Za-z0-9]|\s?[(\[]dot[)\]]\s?\w", re.I | re.A)
_FIRST_LABEL = re.compile(r"[^\S\n]?[\w-]+|(?=[(\[]dot[)\]])", re.I | re.A)
_NO_LETTERS = re.compile(r"[^A-Za-z\n]{0,%d}" % MAX_CHARS)
_NO_LETTERS_BEFORE = re.compile(r"[^A-Za-z\n]*\Z")
_AT = re.compile(r"@|[(\[]at[)\]]", re.I)
_JOINED, _JOINS = re.compile(r"[0-9][./-]\Z"), re.compile(r"[./-][0-9]")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\W\d_]+|\s|.", re.DOTALL)
_OBFUSCATED = re.compile(r"[\w.%+-]+(?:\s?[(\[]dot[)\]]\s?[\w.%+-]+)*\s?(?:[(\[]at[)\]]|@)\s?[\w-]+(?:\s?(?:[(\[]dot[)\]]|\.)\s?[\w-]+)+", re.I | re.A)
_DOTTED = re.compile(r"[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}){3}")
_CUE = {"mail": "email", "email": "email", "contact": "email", "write": "email", "ip": "ip", "host": "ip", "server": "ip",
        "address": "ip", "card": "card", "visa": "card", "credit": "card", "phone": "phone", "tel": "phone", "call": "phone",
        "mobile": "phone", "fax": "phone"}  # fixed values: words that announce a kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def at_most_255(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the pattern, found from the at signs so that long texts stay linear."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            out.append(m.span())
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches per kind; failing ones are dropped, not tried again."""
    out = [("email", *s) for s in emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(at_most_255(p) for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def mail_start(text: str, at: int, low: int) -> int:
    """Where the local part left of position ``at`` begins, spelled dots included; ``low`` at the least."""
    if at > low and text[at - 1].isspace() and text[at - 1] != "\n":
        at -= 1
    while at > low:
        if _LOCAL.match(text[at - 1]):
            at -= 1
        elif text[at - 1] in ")] " and (m := _DOT_BEFORE.search(text[max(low, at - 7):at])):
            at -= m.end() - m.start()
        else:
            break
    return at


def mail_ends(text: str, at: int) -> list[int]:
    """Ends of the domain labels right of position ``at``."""
    m = _FIRST_LABEL.match(text, at)
    out = [m.end()] if m else []
    while out and (m := _LABEL.match(text, out[-1])):
        out.append(m.end())
    return out


def windows(text: str) -> list[tuple[int, int]]:
    """Parts of the text around anchors, whole words with all that the anchor's
    entity may hold and context; near ones are one window, cut at line feeds."""
    out: list[list[int]] = []
    mailed = -1  # the domain that was walked last ends here
    for m in _ANCHOR.finditer(text):
        low, a, b = out[-1][1] if out else 0, m.start(), m.end()
        if m[0][0] in "@([":
            a = mail_start(text, a, low)
            if b > mailed:
                mailed = b = max([b, *mail_ends(text, b if m[0] == "@" or m[0][1] in "aA" else m.start())])
        else:
            a = _NO_LETTERS_BEFORE.search(text, max(min(low, a), a - MAX_CHARS), a).start()
            b = _NO_LETTERS.match(text, b).end()
        a = max(low, a - REACH)
        a = max(a, text.rfind("\n", a, m.start()) + 1)
        b = min(len(text), b + REACH)
        stop = text.find("\n", m.end(), b)
        b = b if stop < 0 else stop
        while low < a < len(text) and text[a - 1].isalnum() and text[a].isalnum():
            a -= 1
        if not out or b > low:
            while b < len(text) and text[b].isalnum() and text[b - 1].isalnum():
                b += 1
        if out and a <= low:
            out[-1][1] = max(b, low)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def features(text: str, a: int, b: int, kind: str) -> list[str]:
    """Features of text[a:b] as a whole span of a kind."""
    span = text[a:b]
    digits = "".join(c for c in span if "0" <= c <= "9")
    signs = "".join(sorted(set(re.sub(r"[\w\s]", "", span, flags=re.A))))
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "9", span))
    before, after = text[a - 1:a], text[b:b + 1]
    out = [f"n{min(len(digits), 20)}", f"s{signs[:6]}", f"sh{shape[:24]}", f"w{min(4, span.count(' '))}",
           f"l{_edge(before)}", f"r{_edge(after)}", f"f{_edge(span[:1])}", f"e{_edge(span[-1:])}",
           f"al{min(3, sum(c.isalpha() for c in span) // 4)}"]
    if 12 <= len(digits) <= 19 and not span.strip("0123456789 .-"):
        out.append(f"luhn{luhn(digits)}")
    if _OBFUSCATED.fullmatch(span):
        out.append("mailform")
    m = _DOTTED.fullmatch(span)
    if m:
        out.append(f"octets{all(int(x) <= 255 for x in re.findall('[0-9]+', span))}")
    if 9 <= len(digits) <= 15 and not span.strip("+0123456789 ().-"):
        groups = [len(x) for x in re.findall("[0-9]+", span)]
        out.append(f"groups{'-'.join(map(str, groups[-3:]))}")
        out.append(f"dial{span[:1] in '+('}{len(groups) >= 3}")
    cue = {_CUE.get(w.lower()) for w in re.findall(r"[A-Za-z]+", text[max(0, a - 20):a])[-3:]}
    out.append(f"cue{kind in cue}")
    return [f"{kind}:{x}" for x in out] + [f"{kind}:"]


def _edge(c: str) -> str:
    return "" if not c else "9" if c.isdigit() else "a" if c.isalpha() else "_" if c.isspace() else c


def candidates(span: str) -> list[str]:
    """Kinds whose entities can look like this at all (bounds on digits, groups and signs)."""
    if any(c.isalpha() for c in span):
        return ["email"] if "@" in span or "at)" in span.lower() or "at]" in span.lower() else []
    groups = re.findall("[0-9]+", span)
    n = sum(map(len, groups))
    out = []
    if len(groups) == 4 and max(map(len, groups)) <= 3 and span.count(".") == 3:
        out.append("ip")
    if 12 <= n <= 19 and "+" not in span and "(" not in span:
        out.append("card")
    if 7 <= n <= 15 and len(groups) >= 2:
        out.append("phone")
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans as disjoint ones, ascending."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(spans):
        if out and x <= out[-1][1]:
            out[-1] = out[-1][0], max(y, out[-1][1])
        elif y > x:
            out.append((x, y))
    return out


class Lattice:
    """Segments of one window: (from token, to token, kind or None, features); those of a kind overlap no fixed span."""

    def __init__(self, text: str, a: int, b: int, index=lambda f: f, fixed: list[tuple[int, int]] = ()):
        self.text = text[a:b]
        self.marks = [m.start() for m in _TOKEN.finditer(self.text)] + [b - a]
        self.at = a
        n = len(self.marks) - 1
        taken, todo = [], deque(merged(fixed))
        for p, q in zip(self.marks, self.marks[1:]):
            while todo and todo[0][1] <= a + p:
                todo.popleft()
            taken.append(bool(todo) and todo[0][0] < a + q)
        self.upto = upto = [0, *accumulate(taken)]
        self.segments: list[tuple[int, int, str | None, list]] = []
        for i in range(n):
            s = self.marks[i]
            self.segments.append((i, i + 1, None, [index("O")]))
            head = self.text[s]
            if not (head.isalnum() or head in "+("):
                continue
            if s and self.text[s - 1].isalnum() and head.isalnum():
                continue  # inside a word or number
            for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
                e = self.marks[j]
                if e - s > MAX_CHARS or upto[j] > upto[i]:
                    break
                span = self.text[s:e]
                if e - s < 6 or not span[-1].isalnum() or (e < self.marks[-1] and self.text[e].isalnum()):
                    continue
                if _JOINED.search(self.text[max(0, s - 2):s]) or _JOINS.match(self.text, e):
                    continue  # a part of a longer number
                for kind in candidates(span):
                    if kind != "email" or self.whole_mail(s, e):
                        self.segments.append((i, j, kind, [index(f) for f in features(self.text, s, e, kind)]))
        self.long_mails(index)
        self.n = n
        self.by_end: list[list[int]] = [[] for _ in range(n + 1)]
        for k, x in enumerate(self.segments):
            self.by_end[x[1]].append(k)

    def whole_mail(self, s: int, e: int) -> bool:
        """Does the address not go on beyond s:e?"""
        return not (_MORE_BEFORE.search(self.text[max(0, s - 7):s]) or _MORE_AFTER.match(self.text, e))

    def long_mails(self, index) -> None:
        """Addresses beyond the bounds of a segment, from each at sign's local part to its labels' ends."""
        low = 0
        for m in _AT.finditer(self.text):
            s = mail_start(self.text, m.start(), low)
            while s < m.start() and not self.text[s].isalnum():
                s += 1
            low = m.end()
            i = bisect_left(self.marks, s)
            for e in mail_ends(self.text, m.end()):
                if e - s > MAIL_CHARS:
                    break
                j = bisect_left(self.marks, e)
                if (e - s > MAX_CHARS or j - i > MAX_TOKENS) and self.upto[j] == self.upto[i] and self.marks[i] == s < m.start() and self.marks[j] == e \
                        and self.text[e - 1].isalnum() and self.whole_mail(s, e):
                    self.segments.append((i, j, "email", [index(f) for f in features(self.text, s, e, "email")]))

    def best(self, weights: dict) -> list[tuple[str, int, int]]:
        """Most probable segmentation's entities (kind, start, end) in the whole text."""
        get = weights.get
        score, back = [0.0] + [-math.inf] * self.n, [-1] * (self.n + 1)
        for j in range(1, self.n + 1):
            for k in self.by_end[j]:
                i, _, _, f = self.segments[k]
                v = score[i] + sum([get(x, 0.0) for x in f])
                if v > score[j]:
                    score[j], back[j] = v, k
        out, j = [], self.n
        while j:
            i, _, kind, _ = self.segments[back[j]]
            if kind:
                out.append((kind, self.at + self.marks[i], self.at + self.marks[j]))
            j = i
        return out[::-1]


def alter(text: str, spans: list[tuple[str, int, int]], rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with each span in one of the forms that the fixed patterns miss."""
    out, new, at = [], [], 0
    size = 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        span = text[a:b]
        if kind == "email":
            span = span.replace("@", rng.choice([" (at) ", " [at] ", "[at]", "(at)"]))
            dotted, dot = rng.random(), rng.choice(["[dot]", " (dot) ", " [dot] "])
            if dotted < 0.4:
                span = dot.join(span.rsplit(".", 1))
            elif dotted < 0.7:
                span = span.replace(".", dot)
        elif kind == "ip":
            span = span.replace(".", rng.choice(["[.]", "(.)"]))
        elif kind == "phone":
            span = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", span)
        elif kind == "card" and len(span) == 16 and span.isdigit():
            span = rng.choice([".", "  "]).join(span[i:i + 4] for i in range(0, 16, 4))
        out += [text[at:a], span]
        size += a - at
        new.append((kind, size, size + len(span)))
        size, at = size + len(span), b
    return "".join(out) + text[at:], new


def spoil(text: str, spans: list[tuple[str, int, int]], rng: random.Random) -> str:
    """The text with each span replaced by a like one that is no personal data."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        span = text[a:b]
        if kind == "card":
            span = span[:-1] + str((int(span[-1]) + rng.randint(1, 9)) % 10)
        elif kind == "ip":
            span = rng.choice([span.rpartition(".")[0], f"{rng.randint(256, 999)}.{span.partition('.')[2]}"])
        elif kind == "phone":
            span = rng.choice([f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
                               f"{rng.randint(1, 999)} {rng.randint(1, 99999)}", str(rng.randint(10**6, 10**10))])
        else:
            span = span.replace("@", " ")
        out += [text[at:a], span]
        at = b
    return "".join(out) + text[at:]


def train(texts: list[str], seed: int = SEED) -> dict[str, float]:
    """Weights of a semi-Markov CRF from texts that label themselves by the fixed
    patterns; no text with a window: no weights, and no span is added."""
    rng = random.Random(seed)
    names: dict[str, int] = {}

    def index(f: str) -> int:
        return names.setdefault(f, len(names))

    cases = []
    for text in texts:
        base = base_spans(text)
        for a, b in windows(text):
            inside = [(k, x, y) for k, x, y in base if a <= x and y <= b]
            cases.append((text[a:b], [(k, x - a, y - a) for k, x, y in inside]))
        if len(cases) >= TRAIN_WINDOWS:
            break
    cases = cases[:TRAIN_WINDOWS]
    cases += [alter(t, s, rng) for t, s in cases if s] + [(spoil(t, s, rng), []) for t, s in cases if s]
    made = []
    for text, gold in cases:
        x = Lattice(text, 0, len(text), index)
        wanted = {}
        for kind, a, b in gold:
            if not any(p < b and a < q for _, p, q in wanted):
                wanted[kind, a, b] = 1
        chosen = [k for k, (i, j, kind, _) in enumerate(x.segments)
                  if kind and (kind, x.marks[i], x.marks[j]) in wanted]
        covered = {i for k in chosen for i in range(x.segments[k][0], x.segments[k][1])}
        chosen += [k for k, (i, _, kind, _) in enumerate(x.segments) if kind is None and i not in covered]
        flat = np.array([f for s in x.segments for f in s[3]])
        starts = np.cumsum([0] + [len(s[3]) for s in x.segments])[:-1]
        made.append((x, flat, starts, chosen))
    w = np.zeros(len(names))
    step = np.full(len(names), 1e-8)
    for _ in range(EPOCHS):
        rng.shuffle(made)
        for x, flat, starts, chosen in made:
            s = np.add.reduceat(w[flat], starts)
            alpha, beta = [0.0] + [-math.inf] * x.n, [-math.inf] * x.n + [0.0]
            for j in range(1, x.n + 1):
                alpha[j] = float(np.logaddexp.reduce([alpha[x.segments[k][0]] + s[k] for k in x.by_end[j]]))
            for j in range(x.n, 0, -1):
                for k in x.by_end[j]:
                    i = x.segments[k][0]
                    beta[i] = float(np.logaddexp(beta[i], beta[j] + s[k]))
            p = np.exp([alpha[i] + s[k] + beta[j] - alpha[x.n] for k, (i, j, _, _) in enumerate(x.segments)])
            p[chosen] -= 1
            grad = np.zeros(len(w))
            np.add.at(grad, flat, np.repeat(p, np.diff(np.append(starts, len(flat)))))
            hit = np.flatnonzero(grad)
            g = grad[hit] + 1e-3 * w[hit]
            step[hit] += g * g
            w[hit] -= 0.3 * g / np.sqrt(step[hit])
    return {f: round(float(w[k]), 6) for f, k in names.items() if abs(w[k]) > 1e-4}


def added_spans(text: str, base: list[tuple[str, int, int]], weights: dict[str, float]) -> list[tuple[str, int, int]]:
    """The model's spans that overlap no fixed one."""
    out, spans = [], merged([(x, y) for _, x, y in base])
    for a, b in windows(text) if weights else ():
        near = spans[bisect_right(spans, a, key=itemgetter(1)):bisect_left(spans, b, key=itemgetter(0))]
        fixed = [(max(a, x), min(b, y)) for x, y in near]
        rest = list(text[a:b])
        for x, y in fixed:
            rest[x - a:y - a] = "\n" * (y - x)
        rest = "".join(rest)
        if len(_DIGIT.findall(rest)) < MIN_DIGITS and not _AT.search(rest):
            continue  # outside the fixed spans no entity of any kind has room
        out += Lattice(text, a, b, fixed=fixed).best(weights)
    return out


def digest(text: str | None, weights: dict[str, float]) -> tuple:
    text = text or ""
    base = base_spans(text)
    n = [sum(k == x for x, _, _ in base) for k in KINDS]
    return (*n, hashlib.sha256(joined(base, KINDS).encode()).hexdigest(),
            joined(base + added_spans(text, base, weights), KINDS))


COLUMNS = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, float]:
    """Weights trained on at most ``TRAIN_DOCS`` texts of up to ``TRAIN_CHARS``
    characters that hold a digit or an at sign, the first by a hash of id and text."""
    usable = (docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
              .where(F.col("t").rlike("[0-9]{3}|@") & (F.length("t") <= TRAIN_CHARS)))
    n = usable.count()
    if not n:
        return {}
    # a threshold on the hash leaves about twice as many rows as are taken, whatever the number of partitions
    order = F.xxhash64("i", "t").bitwiseAND(F.lit((1 << 62) - 1))
    rows = (usable.where(order < F.lit(min((1 << 62) - 1, (1 << 62) * 2 * TRAIN_DOCS // n)))
            .orderBy(order, "i", "t").limit(TRAIN_DOCS).select("t").collect())
    return train([r["t"] for r in rows])


def scan(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per input row.

    Counts and base_sha256 are of the fixed patterns; spans also has the
    model's.  Offsets are code points, ends exclusive.  Null texts are empty
    texts; repeated rows and null ids are rows like any other; other columns
    are not read."""
    kind = ", ".join(f"{c} long" for c in COLUMNS[:4]) + ", base_sha256 string, spans string"

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([digest(t, weights) for t in texts], columns=COLUMNS)

    return small_batches(docs).select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("r")).select("doc_id", "r.*")
