"""Secret scan: fixed patterns plus a token-efficiency test.

A random string is split into many short tokens, so its characters per token
under a byte-level BPE vocabulary are few.  Candidate strings (long runs of
key characters, of any length and any mix of kinds) below ``MAX_RATIO``
characters a token are reported as kind ``random``, unless they are a known
digest (hexadecimal at a digest's length, UUID), an identifier (words of the
vocabulary joined by separators or humps) or a repeated pattern.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intake.llm.common import small_batches

KINDS = ("assign", "access", "hex", "random")
MIN_CHARS = 20                      # of a candidate, and of the windows that look for one in a longer run
CHUNK = 512                         # characters tokenised at once: long runs of letters cost their square
MAX_RATIO = 2.2                     # characters per token
MAX_DIGITS_RATIO = 3.0              # the same of digits only: the vocabulary has most groups of two or three
WORD_RATIO = 2.4                    # letters per token of words, at least; random letters have 1.4 to 2.2
MIN_SIGNS = 6                       # different characters; fewer are a repeated pattern (0101, haha)
# case is ignored in ASCII only: a long s or a Kelvin sign is no letter of a key word
_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
DIGEST_CHARS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")
_SEPARATORS, _PIECE = re.compile(r"[+/_=-]+"), re.compile(r"[A-Za-z0-9]+")
# digests inside a run: whole pieces between separators
_KNOWN = re.compile(r"(?<![A-Za-z0-9])(?:(?i:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})|%s)(?![A-Za-z0-9])"
                    % "|".join(f"[0-9A-F]{{{n}}}" for n in DIGEST_CHARS))
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches per kind; failing ones are dropped, not tried again."""
    out = []
    for m in _ASSIGN.finditer(text) if "=" in text or ":" in text else ():
        if len(m[1]) >= 8:
            out.append(("assign", *m.span()))
    for m in _ACCESS.finditer(text) if "AKIA" in text else ():
        if len(m[0]) >= 16:
            out.append(("access", *m.span()))
    for m in _LONG_HEX.finditer(text):  # a run of 32 or more is a whole run: the same matches
        out.append(("hex", *m.span()))
    return out


@lru_cache(maxsize=2)
def encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def is_digest(run: str) -> bool:
    body = run.strip("=-_/+")
    hexa = len(body) in DIGEST_CHARS and (not body.strip("0123456789abcdef") or not body.strip("0123456789ABCDEF"))
    return hexa or bool(_UUID.fullmatch(body))


def n_tokens(run: str, path: str) -> int:
    encode = encoding(path).encode_ordinary
    return sum(len(encode(run[i:i + CHUNK])) for i in range(0, len(run), CHUNK))


def is_identifier(run: str, path: str) -> bool:
    """Words joined by separators (mostly one token each), or parts of letters of four
    or more on average that are words under the vocabulary, with few digits."""
    pieces = [p for p in _SEPARATORS.split(run) if p]
    if len(pieces) > 2 and sum(min(n_tokens(p.lower(), path), n_tokens(f" {p.lower()}", path)) for p in pieces) <= 1.5 * len(pieces):
        return True
    letters = [p.lower() for p in _PARTS.findall(run) if p[0].isalpha()]
    chars, digits = sum(map(len, letters)), sum(c.isdigit() for c in run)
    if not letters or chars < 4 * len(letters) or digits * 4 > len(run):
        return False
    return chars >= WORD_RATIO * sum(min(n_tokens(p, path), n_tokens(f" {p}", path)) for p in letters)


def is_random(run: str, path: str) -> bool:
    if len(run) < MIN_CHARS or len(set(run)) < MIN_SIGNS or is_digest(run):
        return False
    most = MAX_DIGITS_RATIO if run.isdigit() else MAX_RATIO
    return len(run) < most * n_tokens(run, path) and not is_identifier(run, path)


def gaps(a: int, b: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a:b outside the taken spans."""
    out = []
    for x, y in sorted(taken):
        if x < b and a < y:
            out.append((a, x))
            a = max(a, y)
    return [(x, y) for x, y in [*out, (a, b)] if y - x >= MIN_CHARS]


def random_parts(run: str, path: str) -> list[tuple[int, int]]:
    """The run if it is random as a whole, or else its random windows of
    ``MIN_CHARS``, those that touch merged, without plain words at their ends."""
    if is_random(run, path):
        return [(0, len(run))]
    if is_digest(run):
        return []
    code = encoding(path)
    marks = [0]
    for i in range(0, len(run), CHUNK):
        for x in code.encode_ordinary(run[i:i + CHUNK]):
            marks.append(marks[-1] + len(code.decode_single_token_bytes(x)))
    out: list[list[int]] = []
    j = 0
    for i, a in enumerate(marks):
        while j < len(marks) and marks[j] - a < MIN_CHARS:
            j += 1
        if j == len(marks):
            break
        b = marks[j]
        if b - a < MAX_DIGITS_RATIO * (j - i) and is_random(run[a:b], path):
            if out and a <= out[-1][1]:
                out[-1][1] = b
            else:
                out.append([a, b])
    return [_trimmed(run, a, b, path) for a, b in out]


def _trimmed(run: str, a: int, b: int, path: str) -> tuple[int, int]:
    """a:b without the separated words at its ends, while ``MIN_CHARS`` are left."""
    pieces = [(a + m.start(), a + m.end()) for m in _PIECE.finditer(run[a:b])]
    plain = lambda x, y: y - x >= WORD_RATIO * n_tokens(run[x:y].lower(), path)
    while len(pieces) > 1 and pieces[-1][1] - pieces[1][0] >= MIN_CHARS and plain(*pieces[0]):
        a = pieces.pop(0) and pieces[0][0]
    while len(pieces) > 1 and pieces[-2][1] - a >= MIN_CHARS and plain(*pieces[-1]):
        b = pieces.pop() and pieces[-1][1]
    return a, b


def random_spans(text: str, base: list[tuple[str, int, int]], path: str) -> list[tuple[str, int, int]]:
    """Parts of runs, outside the base spans and known digests, that fail the token-efficiency test."""
    out = []
    taken = [(a, b) for _, a, b in base]
    for m in _RUN.finditer(text):
        known = [(m.start() + k.start(), m.start() + k.end()) for k in _KNOWN.finditer(m[0])]
        for a, b in gaps(*m.span(), taken + known):
            out += [("random", a + x, a + y) for x, y in random_parts(text[a:b], path)]
    return out


def joined(spans: list[tuple[str, int, int]], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2])))


def digest(text: str | None, path: str) -> tuple:
    text = text or ""
    base = base_spans(text)
    n = [sum(k == x for x, _, _ in base) for k in KINDS[:3]]
    return (*n, hashlib.sha256(joined(base, KINDS).encode()).hexdigest(),
            joined(base + random_spans(text, base, path), KINDS))


COLUMNS = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def scan(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per input row.

    Counts and base_sha256 are of the fixed patterns; spans also has the random
    strings.  Offsets are code points, ends exclusive.  Null texts are empty
    texts; repeated rows and null ids are rows like any other; other columns are
    not read.  path: a tiktoken vocabulary file that every executor has."""
    where = path or default_vocabulary()

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([digest(t, where) for t in texts], columns=COLUMNS)

    return small_batches(docs).select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("r")).select("doc_id", "r.*")
