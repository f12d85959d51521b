"""Toxicity by compression distance between two zstandard dictionaries.

A dictionary is trained on ordinary text and one on toxic text. The toxic dictionary is trained on the stretches of toxic documents whose
six-byte strings are far more frequent there than in ordinary documents, as toxic documents are mostly ordinary words. A
window is compressed once with the ordinary content alone and once with the toxic content behind it; the bytes saved by the second are its
distance. A window is one word between blanks, followed by a fixed carrier phrase: zstandard starts no match in the last
bytes of its input and stores inputs raw that it can't shorten, so a bare word shows nothing. Equal windows give equal lengths, which
a bounded memo per task uses.

A document is described by how many of its windows save 1, 2, ... ``DEEPEST`` bytes, as counts and as shares; a logistic regression on the
labelled sample calibrates that to the probability of label 1, and ``THRESHOLD`` decides.

The sample is bounded: ``SAMPLE`` labelled rows of either class, ``SAMPLE_BYTES`` bytes of each, spread over the text and cut in the tasks. These and the
window counts of the sample's whole texts are all that is collected; scores of all documents are made in tasks over whole texts.

Defined results: null and empty texts have no windows and get a low score like any text without toxic windows; without labelled rows of
both classes every score is 0; repeated rows get equal scores, and a score of exactly ``THRESHOLD`` is toxic; rows without id are scored, not learned from; of
rows of one id, one is learned from; an empty table gives an empty result; other columns are passed through by ``with_scores`` and
``reject``, one named as the score is refused by the former (``ValueError``) and kept by the latter. A text is held whole by one task, however long.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from starloom.llm.common import Memo, fold, fresh, held_out, one_text_each, read, spread_sample, texts
from starloom.session import materialise

FOLDS, HELD_OUT = 3, 1
SAMPLE, SAMPLE_BYTES = 1500, 12_000
THRESHOLD = 0.7
GRAM = 6
#: A string counts as toxic if this share of toxic documents has it, and so many times the share of ordinary ones.
LEAST_SHARE, TIMES = 0.01, 20
ORDINARY_BYTES, TOXIC_BYTES, CARRIER_BYTES = 8192, 1024, 32
LEVEL = 3
DEEPEST = 9


def _normal(text: str | None) -> bytes:
    return b" " + b" ".join((text or "").lower().encode("utf-8", "replace").split()) + b" "


def _bounded(text: str | None) -> bytes:
    """``SAMPLE_BYTES`` of a text in pieces spread over it."""
    whole = _normal(text)
    if len(whole) <= SAMPLE_BYTES:
        return whole
    piece = SAMPLE_BYTES // 8
    starts = [i * (len(whole) - piece) // 7 for i in range(8)]
    return b" ".join(whole[s : s + piece] for s in starts)


def _grams(text: bytes) -> set[bytes]:
    """Strings of ``GRAM`` bytes with a blank at their ends at most."""
    return {g for i in range(len(text) - GRAM + 1) if b" " not in (g := text[i : i + GRAM])[1:-1]}


def _frequent_only_in(some: list[bytes], others: list[bytes]) -> set[bytes]:
    have, also = Counter(), Counter()
    for t in some:
        have.update(_grams(t))
    wanted = {g for g, n in have.items() if n >= max(2, LEAST_SHARE * len(some))}
    for t in others:
        also.update(_grams(t) & wanted)
    return {g for g in wanted if have[g] / len(some) >= TIMES * (also[g] + 0.5) / len(others)}


def _stretches(text: bytes, grams: set[bytes]) -> bytes:
    """The parts of a text that the strings cover."""
    inside = np.zeros(len(text) + 2, np.int8)
    for i in range(len(text) - GRAM + 1):
        if text[i : i + GRAM] in grams:
            inside[i + 1 : i + 1 + GRAM] = 1
    ends = np.flatnonzero(np.diff(inside))
    return b" ".join(text[s:e].strip() for s, e in zip(ends[::2], ends[1::2], strict=True))


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary of at most ``size`` bytes; of samples too few to train on, their own end."""
    try:
        return zstandard.train_dictionary(size + 256, samples, k=16, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


class Windows:
    """Bytes that the toxic content saves on a window."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        raw = lambda content: zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        make = lambda content: zstandard.ZstdCompressor(level=LEVEL, dict_data=raw(content), write_content_size=False)
        self.plain, self.against = make(ordinary), make(ordinary + toxic)
        self.carrier = b" " + ordinary[len(ordinary) // 2 :][:CARRIER_BYTES] + b" "
        self.saved = Memo(self._saved)

    def _saved(self, word: bytes) -> int:
        window = b" " + word + self.carrier
        return min(DEEPEST, max(0, len(self.plain.compress(window)) - len(self.against.compress(window))))

    def features(self, text: bytes) -> np.ndarray:
        saved = self.saved
        n = Counter(map(saved.__getitem__, text.split()))
        total = sum(n.values())
        counts = np.array([n.get(k, 0) for k in range(1, DEEPEST + 1)], float)
        at_least = counts[::-1].cumsum()[::-1]
        return np.concatenate([np.log1p(at_least), 30 * at_least / max(total, 20), np.minimum(at_least, 1), [np.log1p(total)]])


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 40, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the last is the constant), means and spreads of a ridge logistic regression, by Newton steps."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z.T * (p * (1 - p) + 1e-9)) @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w, mean, spread


def dictionaries(sample: list[tuple[bytes, int]]) -> dict | None:
    """Dictionary contents from (bounded text, label) rows; None unless both labels occur."""
    toxic, ordinary = ([t for t, y in sample if y == k] for k in (1, 0))
    if not toxic or not ordinary:
        return None
    # Half of the ordinary rows make their dictionary, and all rows calibrate.
    plain = _trained([t[i : i + 48] for t in ordinary[::2] for i in range(0, len(t), 48)][:60_000], ORDINARY_BYTES)
    grams = _frequent_only_in(toxic, ordinary)
    parts = [b" " + p + b" " for t in toxic if (p := _stretches(t, grams))]
    return {"ordinary": plain, "toxic": _trained(parts, TOXIC_BYTES) if parts else b""}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict | None:
    """Fits on a bounded sample of the labelled rows that aren't held out. What is collected is cut or counted in the tasks first."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    few = spread_sample(known.select("doc_id", F.col(label).alias("y")).distinct(), "y", "doc_id", SAMPLE)
    rows = one_text_each(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id"), "doc_id", "y")
    sample = materialise(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"), "text"), "toxicity-sample")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ys, bodies in texts(batches, "doc_id", "y", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), pa.array([_bounded(t) for t in bodies], pa.binary())], names=["doc_id", "y", "some"])

    bounded = sample.mapInArrow(cut, "doc_id long, y int, some binary").orderBy("doc_id", "y").collect()  # 2 * SAMPLE rows of SAMPLE_BYTES
    model = dictionaries([(bytes(r.some), r.y) for r in bounded])
    if model is None:
        return None

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(**model)
        for ids, ys, bodies in texts(batches, "doc_id", "y", "text"):
            x = pa.array([windows.features(_normal(t)) for t in bodies], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), x], names=["doc_id", "y", "x"])

    whole = sample.mapInArrow(described, "doc_id long, y int, x array<double>").orderBy("doc_id", "y").collect()  # a few numbers for each row
    return model | {"calibration": _logistic(np.array([r.x for r in whole]), np.array([float(r.y) for r in whole]))}


def with_scores(docs: DataFrame, model: dict | None, text: str = "text", into: str = "score") -> DataFrame:
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {into} already")
    if model is None:
        return docs.withColumn(into, F.lit(0.0))
    model = dict(model)
    held = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries and a few weights
    at, width = docs.columns.index(text), len(docs.columns)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        windows, (w, mean, spread) = Windows(m["ordinary"], m["toxic"]), m["calibration"]
        for batch in batches:
            found = []
            for (bodies,) in texts([pa.RecordBatch.from_arrays([batch.column(at)], names=["t"])], "t"):
                x = np.array([windows.features(_normal(t)) for t in bodies])
                found.append(1 / (1 + np.exp(-np.clip(((x - mean) / spread) @ w[:-1] + w[-1], -30, 30))))
            scores = pa.array(np.concatenate(found) if found else np.empty(0))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(width)), scores], names=[*batch.schema.names, into])

    return docs.mapInArrow(score, StructType(list(docs.schema.fields)).add(into, DoubleType()))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that aren't predicted toxic."""
    into = fresh(docs, "_toxicity")
    return with_scores(docs, learn(docs, labels), "text", into).filter(F.col(into) < THRESHOLD).select(*docs.columns)


def op9_toxicity(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    scored = with_scores(docs, learn(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op9_toxicity": op9_toxicity}
