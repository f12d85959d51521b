"""Hard-negative mining by exact inner-product search with coordinate pruning in length buckets (after LEMP).

Vectors are whole numbers, so scores are exact and ties are real. Each task goes over its own rows, ``ROWS_AT_ONCE`` at a time, which it sorts by
length into buckets of ``BUCKET`` rows. A bucket holds, for each coordinate, its unit vectors' values as a sorted list. An anchor that looks for
scores of at least t needs a cosine of at least t / (its length * the bucket's greatest length). That bounds the angle, and so, for
each coordinate, the range of values that a match may have there; a bucket where the cosine would have to exceed 1 is skipped whole. The
ranges of the anchor's ``FOCUS`` largest coordinates are cut out of their lists and intersected; what is left is scored exactly.

Two searches use it. The first finds an anchor's positives, its best rows of the same label: t is the k-th best score so far. The second finds each
positive's negatives, the best rows of other labels within a share of the positive's score: t starts at the window's lower end.
The best of each task are merged to the best of all. Rows are never shuffled; the anchors, the stated query set, come in
blocks of about ``ANCHORS_AT_ONCE``, each broadcast on its own.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no part; an empty table, and one without anchors, give an empty
result; other columns are ignored. Each repeated row is a row of its own, but an anchor and a positive are taken once for each different content; rows with the
anchor's id are never its positives or negatives. Ties go to the smaller id. A positive with a negative score has no negatives, as its window is empty.
Vectors of different lengths raise ValueError. Scores must fit a long, else OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import read
from starloom.session import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score, as a share of the positive's: from LOW to HIGH of OF.
LOW, HIGH, OF = 80, 100, 100
ROWS_AT_ONCE, BUCKET, ANCHORS_AT_ONCE = 1 << 16, 4096, 1 << 14
FOCUS = 4
#: Anchors whose scores with a bucket are made at once.
TOGETHER = 256
#: Rounding of cosines and unit vectors is far below this.
SLACK = 1e-9
#: Whole numbers up to here are exact as floats.
EXACT = 1 << 53
NONE = np.iinfo(np.int64).min
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def prepared(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id, label, whole`` of the rows that take part."""
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    rows = rows.filter(F.col(id_column).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector)))
    return rows.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("string").alias("label"), whole.alias("whole"))


def _matrix(batch: pa.RecordBatch | pa.Table, dims: int) -> np.ndarray:
    column = batch["whole"]
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not pc.all(pc.equal(pc.list_value_length(column), dims), min_count=0).as_py():
        raise ValueError("vectors of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)


@dataclass
class Anchors:
    """A block of the query set."""

    ids: np.ndarray
    labels: list[str]
    whole: np.ndarray
    #: Of the second search: for each anchor its positives' ids and scores.
    positives: list[list[tuple[int, int]]] = field(default_factory=list)

    def __post_init__(self):
        self.codes = {label: i for i, label in enumerate(dict.fromkeys(self.labels))}
        self.code = np.array([self.codes[label] for label in self.labels], np.int64)
        self.length = np.sqrt((self.whole.astype(float) ** 2).sum(axis=1))
        unit = self.whole / np.where(self.length > 0, self.length, 1)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.angle = np.arccos(np.clip(np.take_along_axis(unit, self.focus, axis=1), -1, 1))
        self.most = int(np.abs(self.whole).max(initial=0))


class Bucket:
    """Rows of similar length with a sorted list of values for each coordinate."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, whole: np.ndarray, length: np.ndarray):
        self.ids, self.codes, self.whole, self.longest, self.shortest = ids, codes, whole, length.max(), length.min()
        unit = np.ascontiguousarray((whole / np.where(length > 0, length, 1)[:, None]).T)
        self.by_value = np.argsort(unit, axis=1, kind="stable")
        self.values = np.take_along_axis(unit, self.by_value, axis=1)
        self.rank = np.empty_like(self.by_value)
        np.put_along_axis(self.rank, self.by_value, np.arange(len(ids))[None, :], axis=1)
        self.most = int(np.abs(whole).max(initial=0))
        self.scorable: np.ndarray | None = None

    def ranges(self, anchors: Anchors, which: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For anchors and the scores that they look for, the stretch of each focus coordinate's list that is feasible; empty where the bucket isn't."""
        size = len(self.ids)
        span = anchors.length[which] * np.where(least >= 0, self.longest, self.shortest)
        # Against a vector without length every score is 0, and so says nothing of angles.
        flat = (anchors.length[which] * self.shortest == 0) | (least == NONE)
        cosine = np.where(flat, -1.0, least / np.where(span > 0, span, 1) - SLACK)
        possible = np.where(flat, (least <= 0) | (anchors.length[which] * self.longest >= least), cosine <= 1)
        reach = np.arccos(np.clip(cosine, -1, 1))[:, None]
        angle, focus = anchors.angle[which], anchors.focus[which]
        bottom = np.where(angle + reach >= np.pi, -2.0, np.cos(np.minimum(angle + reach, np.pi)) - SLACK)
        top = np.where(angle <= reach, 2.0, np.cos(np.maximum(angle - reach, 0)) + SLACK)
        lo, hi = np.zeros(focus.shape, np.int64), np.full(focus.shape, size)
        for f in np.unique(focus):
            here = focus == f
            lo[here] = np.searchsorted(self.values[f], bottom[here], "left")
            hi[here] = np.searchsorted(self.values[f], top[here], "right")
        hi[~possible] = lo[~possible]
        return lo, np.maximum(lo, hi)

    def candidates(self, focus: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Rows that lie in all the stretches of the focus coordinates' lists."""
        narrow = np.argsort(hi - lo, kind="stable")
        first = narrow[0]
        found = self.by_value[focus[first], lo[first] : hi[first]]
        for f in narrow[1:]:
            if hi[f] - lo[f] < len(self.ids):
                rank = self.rank[focus[f], found]
                found = found[(rank >= lo[f]) & (rank < hi[f])]
        return found

    def exact(self, most: int) -> np.ndarray:
        """The rows in a form in which products with numbers up to ``most`` are exact."""
        bound = self.most * most * max(1, self.whole.shape[1])
        if bound >= 1 << 63:
            raise OverflowError("scores beyond a long")
        if bound >= EXACT:
            return self.whole
        if self.scorable is None:
            self.scorable = self.whole.astype(float)
        return self.scorable


def _scored(bucket: Bucket, anchors: Anchors, least: np.ndarray, same_label: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchor, ids and exact scores of what coordinate pruning leaves."""
    rows = bucket.exact(anchors.most)
    for start in range(0, len(least), TOGETHER):
        which = np.arange(start, min(start + TOGETHER, len(least)))
        lo, hi = bucket.ranges(anchors, which, least[which])
        which_left = np.flatnonzero((hi > lo).all(axis=1))
        left: list[tuple[int, np.ndarray]] = []
        for i in which_left:
            a = start + i
            found = bucket.candidates(anchors.focus[a], lo[i], hi[i])
            same = bucket.codes[found] == anchors.code[a]
            found = found[(same if same_label else ~same) & (bucket.ids[found] != anchors.ids[a])]
            if len(found):
                left.append((a, found))
        wide = [a for a, found in left if 8 * len(found) > len(bucket.ids)]
        # Where a large part of the bucket is left, one product of matrices is faster than gathering the rows for each anchor.
        product = dict(zip(wide, (rows @ anchors.whole[wide].T.astype(rows.dtype)).T, strict=True)) if wide else {}
        for a, found in left:
            scores = product[a][found] if a in product else rows[found] @ anchors.whole[a].astype(rows.dtype)
            yield a, bucket.ids[found], scores.astype(np.int64)


class Best:
    """The k best scores and ids of each of some lists; ties go to the smaller id."""

    def __init__(self, lists: int, k: int):
        self.k, self.found = k, [(np.empty(0, np.int64), np.empty(0, np.int64))] * lists

    def least(self, i: int) -> int:
        """The score that a list's next entry needs."""
        scores = self.found[i][0]
        return int(scores[-1]) if len(scores) == self.k else NONE

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray):
        if not len(ids):
            return
        if len(ids) > 4 * self.k:  # far more than needed: leave those below the k-th
            keep = scores >= np.partition(scores, -self.k)[-self.k]
            ids, scores = ids[keep], scores[keep]
        ids, scores = np.r_[self.found[i][1], ids], np.r_[self.found[i][0], scores]
        order = np.lexsort((ids, -scores))[: self.k]
        self.found[i] = scores[order], ids[order]


def _buckets(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[Bucket]:
    dims = anchors.whole.shape[1]
    known = pa.array(list(anchors.codes), pa.string())

    def cut(held: list[pa.RecordBatch]) -> Iterator[Bucket]:
        table = pa.Table.from_batches(held)
        whole = _matrix(table, dims)
        ids = table["id"].to_numpy()
        codes = pc.fill_null(pc.index_in(table["label"], value_set=known), -1).to_numpy().astype(np.int64)
        length = np.sqrt((whole.astype(float) ** 2).sum(axis=1))
        order = np.argsort(-length, kind="stable")
        for at in range(0, len(order), BUCKET):
            part = order[at : at + BUCKET]
            yield Bucket(ids[part], codes[part], whole[part], length[part])

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS_AT_ONCE:
            yield from cut(held)
            held, n = [], 0
    if n:
        yield from cut(held)


def _records(rows: list[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 50_000):
        columns = zip(*rows[at : at + 50_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def nearest(rows: DataFrame, held, k: int) -> DataFrame:
    """``anchor`` (its place in the block), ``id, score`` of each anchor's k best rows of its label. ``held``: a broadcast block of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(*held.value)
        best = Best(len(anchors.ids), k)
        for bucket in _buckets(batches, anchors):
            least = np.array([best.least(a) for a in range(len(anchors.ids))], np.int64)
            for a, ids, scores in _scored(bucket, anchors, least, True):
                best.add(a, ids, scores)
        yield from _records([(a, int(i), int(s)) for a, (scores, ids) in enumerate(best.found) for s, i in zip(scores, ids, strict=True)], ["anchor", "id", "score"])

    found = rows.mapInArrow(run, "anchor long, id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", place).filter(F.col("place") <= k).drop("place")


def within(rows: DataFrame, held, k: int, window: tuple[int, int, int]) -> DataFrame:
    """For each positive of each anchor the k best rows of other labels in the window of its score."""
    low, high, of = window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(*held.value)
        wanted = [[(p, s, -(-low * s // of), high * s // of) for p, s in some] for some in anchors.positives]
        first = np.cumsum([0, *map(len, wanted)])
        best = Best(int(first[-1]), k)
        no = np.iinfo(np.int64).max
        for bucket in _buckets(batches, anchors):
            needed = [[max(bottom, best.least(first[a] + j)) if bottom <= top else no for j, (_, _, bottom, top) in enumerate(some)] for a, some in enumerate(wanted)]
            least = np.array([min(some, default=no) for some in needed], np.int64)
            for a, ids, scores in _scored(bucket, anchors, least, False):
                for j, (_, _, _, top) in enumerate(wanted[a]):
                    fits = (scores >= needed[a][j]) & (scores <= top)
                    best.add(first[a] + j, ids[fits], scores[fits])
        found = []
        for a, some in enumerate(wanted):
            for j, (p, s, _, _) in enumerate(some):
                scores, ids = best.found[first[a] + j]
                found += [(a, int(anchors.ids[a]), p, s, int(i), int(x)) for x, i in zip(scores, ids, strict=True)]
        yield from _records(found, ["anchor", "anchor_id", "positive_id", "positive_score", "id", "score"])

    found = rows.mapInArrow(run, "anchor long, anchor_id long, positive_id long, positive_score long, id long, score long")
    place = F.row_number().over(Window.partitionBy("anchor", "positive_id", "positive_score").orderBy(F.desc("score"), "id"))
    best = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return best.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int, int] = (LOW, HIGH, OF),
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    at_once: int = ANCHORS_AT_ONCE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of which ``is_anchor`` holds."""
    spark = rows.sparkSession
    parts = prepared(rows, id_column, vector, label)
    queries = materialise(prepared(rows.filter(is_anchor), id_column, vector, label).distinct(), "anchors")
    n, dims = queries.agg(F.count(F.lit(1)), F.max(F.size("whole"))).first()
    result = spark.createDataFrame([], RESULT)
    blocks = -(-n // at_once)
    for b in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow()
        if not block.num_rows:
            continue
        ids, labels, whole = block["id"].to_numpy(), block["label"].to_pylist(), _matrix(block, dims)
        asked = spark.sparkContext.broadcast((ids, labels, whole))
        best = nearest(parts, asked, positives).distinct().orderBy("anchor", F.desc("score"), "id").toArrow()  # a few rows for each anchor of the block
        pairs: list[list[tuple[int, int]]] = [[] for _ in ids]
        for anchor, positive, score in zip(*(best[c].to_pylist() for c in ("anchor", "id", "score")), strict=True):
            pairs[anchor].append((positive, score))
        paired = spark.sparkContext.broadcast((ids, labels, whole, pairs))
        result = result.unionByName(materialise(within(parts, paired, negatives, window), "hard-negatives"))
        asked.destroy()
        paired.destroy()
    return result


def op13_hard_negatives(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLE_SQL = {
    "op13_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
""",
}

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
