"""Byte-level BPE through a sentencepiece model that is serialised from a rank file.

Every byte gets a printable character of its own; a token's piece is its bytes so written, and its score the negative of its rank, so
sentencepiece merges in the order of the ranks. Normalisation is the identity. The pieces of each match of the splitting pattern are
encoded on their own; a match that is a token itself is that token. Ids are decoded by the inverse mapping.

A text is first cut at single spaces between other characters: no match of the pattern crosses such a place, so equal chunks give
equal ids and bytes, which a bounded memo per Python worker uses (``CHUNKS``). Texts with other white space beside a space are matched whole.

Defined results: null and empty texts give no ids; rows are encoded one by one, so ids of documents may be null or
repeated; there are no ties, as ranks differ; an empty table gives an empty result; other columns, also those named as the results, are ignored. A
text is held whole by one task, however long.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Memo, kept, read, texts

#: Chunks that a worker remembers.
CHUNKS = 400_000
UNKNOWN = 0  # the model's first piece; a token's piece is its rank + 1


def _characters() -> list[str]:
    """A printable character for each byte: the byte's own where that is printable, else one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def ranks(file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file.splitlines())}


def model(of: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a rank file, in protocol buffer form."""
    written = _characters()
    pieces = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))]
    for token, rank in sorted(of.items(), key=lambda x: x[1]):
        pieces.append(_field(1, _field(1, "".join(written[b] for b in token).encode()) + _field(2, -float(rank))))
    no = (1 << 64) - 1  # -1: there is no such piece
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, UNKNOWN) + _field(41, no) + _field(42, no) + _field(43, no)
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec:
    """Encodes texts to ids and decodes ids to bytes, by one rank file and splitting pattern."""

    def __init__(self, file: bytes, pattern: str):
        import sentencepiece

        self.ranks = ranks(file)
        self.tokens = [token for token, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
        if list(self.ranks.values()) and sorted(self.ranks.values()) != list(range(len(self.tokens))):
            raise ValueError("ranks have gaps")
        self.written = {b: c for b, c in enumerate(_characters())}
        back = {c: b for b, c in self.written.items()}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model(self.ranks))
        self.bytes_of = [bytes(back[c] for c in self.pieces.id_to_piece(i + 1)) for i in range(len(self.tokens))]
        self.split = regex.compile(pattern).findall
        self.uneven = regex.compile(r"\s\x20|\x20\s|\x20$").search
        self.part_of = Memo(self.part, CHUNKS)

    def ids_of_match(self, match: str) -> list[int]:
        raw = match.encode()
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        return [i - 1 for i in self.pieces.encode(raw.decode("latin-1").translate(self.written))]

    def part(self, chunk: str) -> tuple[tuple[int, ...], str, bytes]:
        """The ids of a chunk, these written in decimal, and the bytes that they decode to."""
        ids = tuple(chain.from_iterable(map(self.ids_of_match, self.split(chunk))))
        return ids, ",".join(map(str, ids)), self.decode(ids)

    def parts(self, text: str | None) -> list[tuple[tuple[int, ...], str, bytes]]:
        """A text in parts that are encoded on their own."""
        if not text:
            return []
        if self.uneven(text):
            return [self.part(text)]
        first, *rest = text.split(" ")
        return list(map(self.part_of.__getitem__, [first, *(" " + r for r in rest)] if first else [" " + r for r in rest]))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(ids for ids, _, _ in self.parts(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _mapped(docs: DataFrame, path: str, pattern: str, text: str, make, schema: str) -> DataFrame:
    with open(path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast((f.read(), pattern))  # a vocabulary file, under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(("codec", *held.value), lambda: Codec(*held.value))
        for doc_ids, bodies in texts(batches, "doc_id", "body"):
            rows = [make(codec, body) for body in bodies]
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), *map(pa.array, zip(*rows, strict=True))], names=["doc_id", *names])

    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("body")).mapInArrow(run, f"doc_id long, {schema}")


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``doc_id, ids`` of whole texts."""
    return _mapped(docs, path, pattern, text, lambda codec, body: (codec.encode(body),), "ids array<long>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded`` (binary) of ids."""
    return _mapped(encoded, path, pattern, "ids", lambda codec, ids: (codec.decode(ids or []),), "decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` and digests of the ids and of what they decode to, without moving the ids out of the task."""

    def digests(codec: Codec, body: str | None) -> tuple[int, str, str]:
        ids, written, decoded = zip(*parts, strict=True) if (parts := codec.parts(body)) else ((), (), ())
        return sum(map(len, ids)), sha256(",".join(written).encode()).hexdigest(), sha256(b"".join(decoded)).hexdigest()

    return _mapped(docs, path, pattern, text, digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op10_byte_bpe": op10_byte_bpe}
