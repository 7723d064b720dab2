"""Operator 9, secret scans: fixed patterns and a token-efficiency test.

The base patterns find assignments, access ids and long hex runs.  The
method adds strings that a tokenizer's vocabulary spells badly: runs of 16
or more key characters with a letter whose characters-per-token ratio is at
most ``max_ratio``.  Words of a language, and identifiers made of them, have
three or more characters a token; random strings about 1.5.  Known digests
(hex of a digest's length, UUIDs), runs without digits of which one character
is half or more, and identifiers (letter groups joined by separators, with a
number at most, that are one token or of a higher ratio each, or of a higher
ratio together) are excluded before the test.

A run that passes as a whole is one span.  Of any other, the pieces between
separators are tested: neighbouring pieces that are no identifiers together,
then each alone, so a key is found beside the path or name it is glued to.
A run that touches base spans is cut there, and what is left is tested in
the same way; of a piece that a base span covers in part, the remainder is
also a span (of any length) if the whole piece passes.

Defined results: a null text is scanned as an empty one.  Rows with null or
repeated ids are scanned as they are.  Texts are scanned whole.  An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship, slices

#: Span kinds, in the order used for spans that start at the same place.
KINDS = ("assign", "access", "hex", "random")

# Fixed patterns of the base scan.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # greedy runs: the same as all runs, short ones dropped
HEX = re.compile(r"[0-9a-f]{24,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "api")

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_DIGEST = re.compile(r"(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128}"
                     r"|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12})")
_IDENTIFIER = re.compile(r"[_/+=-]*[A-Za-z]+(?:[_/+=-]+[A-Za-z]+)*[_/+=-]*[0-9]{0,8}")
_LETTERS = re.compile(r"[A-Za-z]+")
_PIECE = re.compile(r"[A-Za-z0-9]+")
LEAST = 16


@lru_cache(maxsize=2)
def vocabulary(path: str):
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, in that order."""
    found = []
    if ("=" in text or ":" in text) and any(k in text.lower() for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@lru_cache(maxsize=65536)
def tokens(run: str, path: str) -> int:
    return len(vocabulary(path).encode_ordinary(run))


def is_identifier(run: str, path: str, max_ratio: float) -> bool:
    """Letter groups and a number, cheap in tokens: each of them or all together (capitals may count as small letters).

    One capital before small letters only is how words are written and
    hardly ever a random string, so two characters a token will do there.
    """
    if not _IDENTIFIER.fullmatch(run):
        return False
    names = _LETTERS.findall(run)
    cost = [min(tokens(x, path), tokens(x.lower(), path)) if x.isupper() else tokens(x, path) for x in names]
    return (all(n == 1 or len(x) > max_ratio * n or x.istitle() and len(x) >= 2 * n for x, n in zip(names, cost))
            or sum(map(len, names)) > max_ratio * sum(cost))


def is_filler(run: str) -> bool:
    """No digit, and one character in half of its places or more."""
    return not any(c.isdigit() for c in run) and 2 * max(map(run.count, set(run))) >= len(run)


def is_dear(run: str, path: str, max_ratio: float) -> bool:
    """Letters (and more) at few characters a token, and no digest, filler or identifier."""
    return (bool(_LETTERS.search(run)) and not _DIGEST.fullmatch(run) and len(run) <= max_ratio * tokens(run, path)
            and not is_filler(run) and not is_identifier(run, path, max_ratio))


def random_parts(run: str, path: str, max_ratio: float) -> list[tuple[int, int]]:
    """The whole run, or the pieces of it, that the test finds random."""
    if len(run) < LEAST or _DIGEST.fullmatch(run):
        return []
    if is_dear(run, path, max_ratio):
        return [(0, len(run))]
    groups: list[list[tuple[int, int]]] = [[]]
    for m in _PIECE.finditer(run):
        if is_dear(m[0], path, max_ratio):
            groups[-1].append(m.span())
        elif groups[-1] and not (m[0].isdigit() or len(m[0]) <= 3):     # inside a key, numbers and short pieces do not end it
            groups.append([])
    found = []
    for group in groups:
        whole = [(group[0][0], group[-1][1])] if len(group) > 1 else []
        for parts in (whole, group):
            hits = [(a, b) for a, b in parts if b - a >= LEAST and is_dear(run[a:b], path, max_ratio)]
            if hits:
                found += hits
                break
    return found


def free_parts(start: int, end: int, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What of ``start`` to ``end`` lies in no span of ``taken`` (sorted by start)."""
    free = []
    for s, _, e in taken:
        if s < end and start < e:
            if start < s:
                free.append((start, s))
            start = max(start, e)
    return [*free, (start, end)] if start < end else free


class _Meeting:
    """Spans (sorted by start) that meet ascending parts of a text: both lists are gone through once."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.spans, self.at, self.open = spans, 0, []

    def of(self, start: int, end: int) -> list[tuple[int, int, int]]:
        while self.at < len(self.spans) and self.spans[self.at][0] < end:
            self.open.append(self.spans[self.at])
            self.at += 1
        self.open = [x for x in self.open if x[2] > start]
        return [x for x in self.open if x[0] < end]


def random_spans(text: str, taken: list[tuple[int, int, int]], path: str, max_ratio: float) -> list[tuple[int, int, int]]:
    found, meeting = [], _Meeting(taken)
    for m in _RUN.finditer(text):
        near = meeting.of(*m.span())
        spans = sorted({(a + s, a + e) for a, b in free_parts(*m.span(), near) for s, e in random_parts(text[a:b], path, max_ratio)})
        within, known = _Meeting([(a, 3, b) for a, b in spans]), set(spans)
        beside = _Meeting(near)
        for p in _PIECE.finditer(m[0]) if near else ():
            a, b = m.start() + p.start(), m.start() + p.end()
            left, around = free_parts(a, b, beside.of(a, b)), within.of(a, b)
            if left != [(a, b)] and b - a >= LEAST and is_dear(p[0], path, max_ratio):
                known.update(x for x in left if not any(s <= x[0] and x[1] <= e for s, _, e in around))
        found += [(a, 3, b) for a, b in known]
    return found


def scan(text: str | None, path: str, max_ratio: float) -> list[tuple[int, int, int]]:
    """All spans of one whole text, sorted by start, then kind."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    longest = max(map(len, data.split()), default=0)
    # every span but an assignment's lies in one word of 16 bytes or more
    base = base_spans(text) if longest >= 20 or "=" in text or ":" in text else []
    if longest < LEAST:
        return base
    return sorted(base + random_spans(text, base, path, max_ratio))


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# ---------------------------------------------------------------- Spark ---
def find_secrets(docs: DataFrame, vocabulary_path: str, max_ratio: float = 2.2) -> DataFrame:
    """``doc_id`` and ``found``: an array of ``(kind, start, end)`` in code points."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t, vocabulary_path, max_ratio)]
                     for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, found_type)], names=["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, found array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, vocabulary_path: str, max_ratio: float = 2.2, mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; an integer ``n_chars`` of a changed text follows it."""
    ship(docs.sparkSession)
    text = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns and \
        docs.schema["n_chars"].dataType.simpleString() in ("int", "bigint") else None

    def cleaned(t: str | None) -> str | None:
        spans = scan(t, vocabulary_path, max_ratio)
        if not spans:
            return t
        out, at = [], 0
        for start, _, end in spans:
            if start >= at:
                out += [t[at:start], mark]
            at = max(at, end)
        return "".join([*out, t[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            old = part.column(text).to_pylist()
            new = [cleaned(t) for t in old]
            columns = list(part.columns)
            columns[text] = pa.array(new, columns[text].type)
            if size is not None:
                columns[size] = pa.array([n if a is b else len(b) for n, a, b in zip(part.column(size).to_pylist(), old, new)],
                                         columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)


