"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text is a sparse vector: its distinct words hashed into ``BUCKETS`` (each weighing one over the root of their number), a few statistics
of its structure, and its length as metadata. The machine adds to the linear terms all pairwise interactions, with a weight for a pair that is the product
of two rank-``RANK`` vectors; the sum over all pairs is half the square of the sum less the sum of the squares, so scoring is linear in the
vector's length. It is trained by AdaGrad on a bounded sample, ``SAMPLE`` labelled rows of either class.

Language, source, id and labels are no inputs. Defined results: null and empty texts are scored by their statistics alone; without
labelled rows of both classes every score is 0.5; rows without id are scored, not learned from; repeated rows get equal scores; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import Memo, fold, held_out, one_text_each, read, spread_sample, texts

FOLDS, HELD_OUT = 4, 2
SAMPLE = 1500
THRESHOLD = 0.7
BUCKETS, RANK = 1 << 15, 8
EPOCHS, RATE, RIDGE = 12, 0.08, 1e-5
STATISTICS = ("symbols", "bangs", "bars", "upper", "digits", "mean word", "distinct words", "same as before", "repeated lines", "length")
SYMBOLS = "#*$%&|<>{}[]"


def statistics(text: str, words: list[str], distinct: int) -> np.ndarray:
    n, chars = max(len(words), 1), max(len(text), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    digits = sum(w.isdigit() for w in words)
    return np.array([
        min(sum(map(text.count, SYMBOLS)) / n, 2.0), min(text.count("!") / n, 2.0), min(text.count("|") / n, 2.0), upper / n, digits / n,
        min(chars / n, 20.0) / 10, distinct / n, same / n, 1 - len(set(lines)) / max(len(lines), 1), np.log1p(chars) / 10,
    ])


def vector(text: str | None, bucket) -> tuple[np.ndarray, np.ndarray]:
    """Places and values; the statistics come first, in order."""
    words = (text or "").split()
    distinct = set(words)
    places = np.unique(np.fromiter(map(bucket.__getitem__, distinct), np.int64, len(distinct)))
    values = np.concatenate([statistics(text or "", words, len(distinct)), np.full(len(places), 1 / np.sqrt(max(len(places), 1)))])
    return np.concatenate([np.arange(len(STATISTICS)), places + len(STATISTICS)]), values


def buckets() -> Memo:
    return Memo(lambda w: crc32(w.lower().encode("utf-8", "replace")) % BUCKETS)


class Machine:
    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def raw(self, places: np.ndarray, values: np.ndarray) -> float:
        xv = values @ self.v[places]
        pairs = 0.5 * (xv @ xv - (values**2) @ (self.v[places] ** 2).sum(axis=1))
        return self.w0 + values @ self.w[places] + pairs

    @classmethod
    def trained(cls, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 11) -> Machine:
        rng = np.random.default_rng(seed)
        size = BUCKETS + len(STATISTICS)
        m = cls(0.0, np.zeros(size), rng.normal(0, 0.01, (size, RANK)))
        g0, gw, gv = 1e-8, np.full(size, 1e-8), np.full((size, RANK), 1e-8)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(rows)):
                p, x = rows[i]
                error = 1 / (1 + np.exp(-np.clip(m.raw(p, x), -30, 30))) - y[i]
                xv = x @ m.v[p]
                dw = error * x + RIDGE * m.w[p]
                dv = error * (x[:, None] * xv - (x**2)[:, None] * m.v[p]) + RIDGE * m.v[p]
                g0 += error**2
                gw[p] += dw**2
                gv[p] += dv**2
                m.w0 -= RATE * error / np.sqrt(g0)
                m.w[p] -= RATE * dw / np.sqrt(gw[p])
                m.v[p] -= RATE * dv / np.sqrt(gv[p])
        return m


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Machine | None:
    """Fits on a bounded sample of the labelled rows that aren't held out."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    few = spread_sample(known.select("doc_id", F.col(label).alias("y")).distinct(), "y", "doc_id", SAMPLE)
    sample = one_text_each(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id"), "doc_id", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = buckets()
        for ids, ys, bodies in texts(batches, "doc_id", "y", "text"):
            places, values = zip(*(vector(t, bucket) for t in bodies), strict=True)
            lists = (pa.array([np.asarray(v) for v in c], pa.list_(kind)) for c, kind in ((places, pa.int64()), (values, pa.float64())))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), *lists], names=["doc_id", "y", "places", "shares"])

    sample = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"), "text")
    rows = sample.mapInArrow(run, "doc_id long, y int, places array<long>, shares array<double>").orderBy("doc_id", "y").collect()  # 2 * SAMPLE rows, no texts
    if len({r.y for r in rows}) < 2:
        return None
    vectors = [(np.array(r.places, np.int64), np.array(r.shares, float)) for r in rows]
    return Machine.trained(vectors, np.array([float(r.y) for r in rows]))


def with_scores(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """``doc_id, score`` of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if machine is None:
        return docs.select("doc_id", F.lit(0.5).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast((machine.w0, machine.w, machine.v))  # BUCKETS * (RANK + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, bucket = Machine(*held.value), buckets()
        for ids, bodies in texts(batches, "doc_id", "text"):
            raw = np.array([m.raw(*vector(t, bucket)) for t in bodies])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(raw, -30, 30))))], names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")


def op4_quality_model(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    scored = with_scores(docs, learn(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


QUERIES = {"op4_quality_model": op4_quality_model}
