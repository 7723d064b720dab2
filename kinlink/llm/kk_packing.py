"""Operator 3, packing by Karmarkar-Karp multiway differencing.

Every document becomes its token ids and an end id.  Whole windows are cut
off long documents; the rest is cut into parts of at most ``part`` ids.
Parts are gathered in blocks of a bounded number of ids, each held by one
task.  In a block, every part starts as a partition of ``m`` windows with
one window filled; the two partitions with the largest imbalance (fullest
minus emptiest window) are merged, fullest windows of the one with emptiest
of the other, until one is left.  Its windows are nearly equal.  If the
fullest exceeds the capacity, the window count rises by one and the block
is differenced again.

A block aims at ``spare`` free places a window; the document that reaches
the aim is cut there and goes on in the next block.  Nothing is shuffled:
each task packs the documents it reads, so only the last block of a task
can be small, and a retried task gives the same windows.

Token ids: white space never belongs to a token of this vocabulary, so the
ids of a text are the ids of its words (cut at ASCII white space) in order;
words seen before are looked up in a bounded table.

Defined results: a null or empty text is the end id alone.  Null and
repeated ids are packed as rows of their own.  Texts of any length are
packed whole.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import ship, slices

CAPACITY = 4096
END_ID = 2


# ---------------------------------------------------------------- tokens --
class WordTokens:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    The vocabulary splits texts at white space, and runs of letters from
    other signs, before it looks at anything else, and folds case.  So the
    ids of known words can be put together, and those of new words come from
    one call over all of them: a run of letters ends with the first id that
    closes a word (``</w>``); other words are told apart by the ids' places.
    """

    def __init__(self, path: str, most_words: int = 500_000, longest: int = 64, at_once: int = 2000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # small ASCII letters need no normal form and no splitting but at spaces
        plain = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.plain = Tokenizer.from_str(json.dumps(plain))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}    # the words known before the last renewal
        self.most_words, self.longest, self.at_once = most_words, longest, at_once

    def _letters(self, words: list[str], tokenizer=None) -> list[bytes]:
        """Ids of runs of letters; by their places if closing ids don't tell them apart."""
        ids = np.array((tokenizer or self.tokenizer).encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):
            return self._others(words)
        data, ends = ids.tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _plain(self, words: list[str]) -> list[bytes]:
        return self._letters(words, self.plain)

    def _others(self, words: list[str]) -> list[bytes]:
        """Ids of any words."""
        starts = np.cumsum([0, *(len(t) + 1 for t in words)])
        got = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(got.ids, "<u4")
        cuts = np.searchsorted(np.array(got.offsets, np.int64).reshape(-1, 2)[:, 0], starts)
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not known."""
        found: dict[bytes, bytes] = {}
        plain, letters, others, marked = [], [], [], []
        for w in words:
            ids = self.before.get(w)
            if ids is not None:
                found[w] = ids
            elif w.isalpha() and w.islower():       # of bytes: ASCII
                plain.append(w)
            else:
                text = w.decode("utf-8", "surrogatepass")
                if text.isalpha():
                    letters.append(w)
                elif text[-1] in ",." and text[:-1].isalpha():
                    marked.append(w)                # the sign is a token run of its own
                else:
                    others.append(w)
        for w in {x for m in marked for x in (m[:-1], m[-1:])} - words:
            ids = self.known.get(w) or self.before.get(w)
            if ids is not None:
                found[w] = ids
            elif len(w) == 1:
                others.append(w)
            else:
                (plain if w.isalpha() and w.islower() else letters).append(w)
        for todo, encode in ((plain, self._plain), (letters, self._letters), (others, self._others)):
            for at in range(0, len(todo), self.at_once):
                part = todo[at:at + self.at_once]
                found.update(zip(part, encode(b" ".join(part).decode("utf-8", "surrogatepass").split(" "))))
        for w in marked:
            found[w] = found[w[:-1]] + found[w[-1:]]
        return found

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        split, seen = [], set()
        for t in texts:
            data = t.encode("utf-8", "surrogatepass") if t else b""
            words = (data if b"<|" in data else data.lower()).split()   # names of special tokens keep their case
            seen.update(words)
            split.append(words)
        known = self.known
        found = self._learn(seen.difference(known))
        known.update(found)
        ids = known.__getitem__
        out = [b"".join(map(ids, words)) for words in split]
        for w in [w for w in found if len(w) > self.longest]:
            del known[w]
        if len(known) > self.most_words:
            self.before, self.known = known, {}
        return out


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


# ----------------------------------------------------------- differencing --
def differencing(sizes: list[int], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Window of each part, and window sums, by multiway differencing."""
    n = len(sizes)
    sums: dict[int, np.ndarray] = {}
    merged: dict[int, tuple[int, int, np.ndarray]] = {}
    heap = []
    for i, size in enumerate(sizes):
        sums[i] = np.zeros(m, np.int64)
        sums[i][0] = size
        heap.append((-size if m > 1 else 0, i))
    heapq.heapify(heap)
    for node in range(n, 2 * n - 1):
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        sums[node] = both = both[order]
        merged[node] = (a, b, order)
        heapq.heappush(heap, (int(both[-1] - both[0]), node))
    window = np.zeros(n, np.int64)
    todo = [(heap[0][1], np.arange(m))]
    while todo:
        node, places = todo.pop()
        if node < n:
            window[node] = places[0]
            continue
        a, b, order = merged.pop(node)
        at = np.empty(m, np.int64)
        at[order] = places
        todo += [(a, at), (b, at[::-1])]
    return window, sums[heap[0][1]]


def pack_block(sizes: list[int], capacity: int) -> np.ndarray:
    """Window of each part; no window holds more than ``capacity``."""
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        window, sums = differencing(sizes, m)
        if sums.max() <= capacity:
            return window
        m += 1


# ---------------------------------------------------------------- Spark ---
_COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class _Packer:
    """Pieces of one task's documents, block by block."""

    def __init__(self, kind: pa.DataType, capacity: int, part: int, spare: int, windows: int):
        self.kind, self.capacity, self.part = kind, capacity, part
        self.budget = windows * (capacity - min(spare, capacity - 1))
        self.next_sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        self.parts: list[tuple] = []     # doc_id, start, length, crc, doc_tokens
        self.held = 0
        self.whole: list[tuple] = []     # the same of pieces that fill a window

    def add(self, doc_id, ids: bytes) -> Iterator[pa.RecordBatch]:
        n, at = len(ids) // 4, 0

        def piece(length: int) -> tuple:
            return (doc_id, at, length, zlib.crc32(ids[4 * at:4 * (at + length)]), n)

        while n - at >= self.capacity:
            self.whole.append(piece(self.capacity))
            at += self.capacity
        while at < n:
            if self.held >= self.budget:
                yield self.flush()
            length = min(self.part, n - at, self.budget - self.held)
            self.parts.append(piece(length))
            self.held += length
            at += length
        if len(self.whole) >= 4096:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        rows = [(*p, self.next_sequence + i, 0) for i, p in enumerate(self.whole)]
        self.next_sequence += len(self.whole)
        if self.parts:
            window = pack_block([p[2] for p in self.parts], self.capacity)
            used = np.unique(window)
            number = dict(zip(used.tolist(), range(self.next_sequence, self.next_sequence + len(used))))
            filled = dict.fromkeys(number, 0)
            for p, w in zip(self.parts, window.tolist()):
                rows.append((*p, number[w], filled[w]))
                filled[w] += p[2]
            self.next_sequence += len(used)
        self.whole, self.parts, self.held = [], [], 0
        columns = list(zip(*rows)) or [()] * (len(_COLUMNS) + 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], self.kind), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["doc_id", *_COLUMNS])


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         part: int = 512, spare: int = 16, windows: int = 128) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is the path of the vocabulary file on the executors.
    """
    ship(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = word_tokens(tokenizer), None
        for rows in slices(batches):
            packer = packer or _Packer(rows.schema.field(0).type, capacity, part, spare, windows)
            for doc_id, ids in zip(rows.column(0).to_pylist(), encode(rows.column(1).to_pylist())):
                yield from packer.add(doc_id, ids + end)
        if packer:
            yield packer.flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in _COLUMNS))
