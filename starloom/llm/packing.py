"""Cost-balanced packing of token sequences.

Each task tokenises its documents and packs ``GROUP_TOKENS`` tokens at a time, so nothing is shuffled and a task holds one group. The cost
of a piece is estimated as linear plus quadratic (attention) in its length. A group gets as many sequences as its tokens need at least.
Whole sequences are cut from longer documents first; the rests are then taken in descending order, and each goes to the sequence
of least cost among all that have room for it whole. If none has, it fills the sequence with the most room and its own rest is taken again, so only the
last sequences of a group are padded: less than one sequence's tokens for each ``GROUP_TOKENS`` and task.

Words are tokenised once per Python worker: the vocabulary's normaliser and splitter never join text across ASCII white space, so a text's ids are
its words' ids in order (tested against the library on whole texts).

Defined results: null and empty texts have the end token only; ids of documents may be null or repeated, each row is packed on its own; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Memo, read, texts

CAPACITY = 4096
END = 2
GROUP_TOKENS = 1 << 21
#: Cost of a token, and of a pair of tokens of one piece: attention over a full sequence costs as much as the rest of the layer.
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY
#: Sequences that one partition can number.
PER_PARTITION = 1 << 40

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _letters_of_bytes() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: b if b in printable else next(others) for b in range(256)}


#: Pre-tokens of this vocabulary's splitter, a fixed value.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of printable Latin characters: no normal form changes them, and they are lower-cased one character at a time.
PLAIN = "[!-~\u00a1-\u012f\u0131-\u017f]+"


@lru_cache(maxsize=1)
def word_ids(tokenizer: str):
    """text -> ids as a uint32 array, by a serialised tokenizer that never joins text across white space.

    Kept by the process, so that the tasks of one Python worker share what it has learned of the words.
    Plain words go to the vocabulary's merges directly, any other word through the whole tokenizer. A special token that a
    text spells out is ordinary text.
    """
    import regex
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer)
    t.encode_special_tokens = True
    merges, letter = t.model.tokenize, _letters_of_bytes()
    plain, pieces = regex.compile(PLAIN).fullmatch, regex.compile(PRE_TOKENS).findall

    def ids_of_piece(piece: bytes) -> bytes:
        return array("I", [x.id for x in merges(piece.decode() if piece.isascii() else piece.decode("latin-1").translate(letter))]).tobytes()

    of_piece = Memo(ids_of_piece).__getitem__

    def ids_of_word(word: bytes) -> bytes:
        if word.isalpha() and word.islower():
            return ids_of_piece(word)
        w = word.decode("utf-8", "replace")
        if plain(w):
            return b"".join([of_piece(piece.encode()) for piece in pieces(w.lower())])
        return array("I", t.encode(w, add_special_tokens=False).ids).tobytes()

    of_word = Memo(ids_of_word).__getitem__

    def ids_of(text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8", "replace")
        # Lower-casing ASCII letters first changes nothing unless a combining mark (lead bytes CC, CD) could join one.
        if b"\xcc" not in raw and b"\xcd" not in raw:
            raw = raw.lower()
        return np.frombuffer(b"".join(map(of_word, raw.split())), np.uint32)

    return ids_of


def cost(length: int) -> float:
    return LINEAR * length + QUADRATIC * length * length


def assign(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of the pieces of documents with these lengths."""
    pieces, rests, sequence = [], [], 0
    for d, n in enumerate(lengths):
        full = n // capacity
        for i in range(full):
            pieces.append((d, i * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rests.append((-(n % capacity), d, full * capacity))
    total = -sum(r[0] for r in rests)
    first, n_open = sequence, -(-total // capacity)
    used, costs = [0] * n_open, [0.0] * n_open
    open_ = _Open(n_open, capacity)
    heapq.heapify(rests)  # descending lengths
    while rests:
        n, d, start = heapq.heappop(rests)
        n = -n
        at = open_.cheapest(n)
        if at is None:
            at = open_.roomiest()
        take = min(n, capacity - used[at])
        pieces.append((d, start, take, first + at, used[at]))
        used[at] += take
        costs[at] += cost(take)
        open_.put(at, costs[at], capacity - used[at])
        if take < n:
            heapq.heappush(rests, (take - n, d, start + take))
    return pieces


class _Open:
    """Sequences by their room: a heap of (cost, sequence) for each room, under a tree that holds the least of each span of rooms."""

    def __init__(self, n: int, capacity: int):
        self.size = 1 << capacity.bit_length()  # rooms 0 to capacity
        self.heaps: dict[int, list[tuple[float, int]]] = {}
        self.room = [capacity] * n
        self.tree: list[tuple[float, int]] = [NONE] * (2 * self.size)
        if n:
            self.heaps[capacity] = [(0.0, i) for i in range(n)]
            self._update(capacity)

    def _update(self, room: int):
        heap, at, tree = self.heaps.get(room), room + self.size, self.tree
        tree[at] = heap[0] if heap else NONE
        while at > 1:
            at >>= 1
            tree[at] = min(tree[2 * at], tree[2 * at + 1])

    def put(self, i: int, cost: float, room: int):
        """Take sequence ``i``, just found and so the first of its heap, to a smaller room; without any it is closed."""
        old, self.room[i] = self.room[i], room
        heapq.heappop(self.heaps[old])
        self._update(old)
        if room:
            heapq.heappush(self.heaps.setdefault(room, []), (cost, i))
            self._update(room)

    def cheapest(self, n: int) -> int | None:
        """The sequence of least cost, then least number, with room for ``n``."""
        at, best = n + self.size, NONE
        end = 2 * self.size
        while at < end:
            if at & 1:
                best = min(best, self.tree[at])
                at += 1
            at, end = at >> 1, end >> 1
        return None if best is NONE else best[1]

    def roomiest(self) -> int:
        """Of the sequences with the most room, the one of least cost."""
        at, tree = 1, self.tree
        while at < self.size:
            at = 2 * at + (tree[2 * at + 1] is not NONE)
        return tree[at][1]


NONE = (math.inf, -1)


def pack(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())  # the vocabulary file, under 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, sequence = word_ids(held.value), TaskContext.get().partitionId() * PER_PARTITION
        group, size = [], 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            rows, last = [], -1
            for d, start, length, at, offset in assign([len(ids) for _, ids in group]):
                doc_id, ids = group[d]
                rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids), sequence + at, offset))
                last = max(last, at)
            sequence += last + 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=NAMES)

        for doc_ids, bodies in texts(batches, "doc_id", "text"):
            for doc_id, body in zip(doc_ids, bodies, strict=True):
                ids = np.append(ids_of(body), np.uint32(END)).astype("<u4")
                group.append((doc_id, ids))
                size += len(ids)
                if size >= GROUP_TOKENS:
                    yield packed()
                    group, size = [], 0
        if group:
            yield packed()

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def op5_packing(spark, sf_dir):
    return pack(read(spark, sf_dir, "documents"), vocabulary())


QUERIES = {"op5_packing": op5_packing}
