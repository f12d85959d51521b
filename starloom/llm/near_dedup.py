"""Near duplicates by one-permutation MinHash with optimal densification, banded buckets and star-shaped candidate edges.

1. A document's set is its distinct five-word shingles. One hash per shingle falls into one of ``BANDS * ROWS`` bins; a bin keeps its least
   hash. An empty bin borrows the value of the first filled bin in its own fixed random order, the same for every document
   (optimal densification). Each band of ``ROWS`` bins gives one bucket key.
2. Documents with equal sets form a class, named by its smallest id. Only that one goes on, so a group of
   copies, however large, costs one aggregation.
3. A bucket proposes the star from its smallest member to each other member: as many pairs as members. Pairs are confirmed on
   the full shingle sets, made again from the texts. First each document meets its smallest centre; further stars are checked
   only where both ends are not yet connected.
4. A star alone could miss the link of two members that are both unlike the centre. So the members of every bucket that still
   holds several components are compared across components by an exact prefix join (``_across``). No bucket is capped.
5. Links are contracted to components by alternating large-star and small-star steps.

At a similarity of 0.75 a pair shares no bucket with a probability of (1 - 0.75**4)**40, about 2.5e-7.

Defined results: a null or empty text, and one of blanks, has an empty set and is linked with nothing; a row without id has no
component and is kept; rows of one id are one document, linked if any of its texts is; an empty table gives an
empty result; other columns are ignored. Very long texts are cut into nothing: a set is held by one task, one
document at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import fresh, texts
from starloom.session import materialise

SHINGLE = 5
BANDS, ROWS = 40, 4
BINS = BANDS * ROWS
#: Similarity of a link, as a fraction.
ALIKE, OF = 75, 100
SEED = 20240607

SIGNATURES = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("bands", pa.list_(pa.int64()))]
)


def shingles(text: str | None) -> set[bytes]:
    """Distinct five-word shingles; of a shorter text, all its words as one; of none, nothing."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, and the six blanks of the rule
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    ends, joined = [], b" ".join(words)
    at = -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    return {joined[s:e] for s, e in zip(starts, ends[SHINGLE - 1 :], strict=False)}


def fixed_draws() -> tuple[np.ndarray, np.ndarray]:
    """Each bin's order of the bins it borrows from, and the multipliers of a band's values."""
    rng = np.random.default_rng(SEED)
    order = np.array([rng.permutation(BINS) for _ in range(BINS)])
    return order, rng.integers(1, 2**63, size=(BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def band_keys(hashes: np.ndarray, draws: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Bucket keys of a set of sorted distinct hashes."""
    order, multipliers = draws
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    filled, first = np.unique(bins, return_index=True)
    values, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[filled], full[filled] = hashes[first], True
    empty = np.flatnonzero(~full)
    if len(empty):
        lenders = order[empty]
        values[empty] = values[lenders[np.arange(len(empty)), full[lenders].argmax(axis=1)]]
    rows = _mixed(values).reshape(BANDS, ROWS)
    return _mixed((rows * multipliers).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    draws = fixed_draws()
    for ids, bodies in texts(batches, "doc_id", "text"):
        rows = []
        for doc_id, body in zip(ids, bodies, strict=True):
            found = shingles(body)
            if not found:
                rows.append((doc_id, 0, None, None, None))
                continue
            hashes = np.unique(np.fromiter((xxhash.xxh3_64_intdigest(s) for s in found), np.uint64, len(found)))
            a, b = np.frombuffer(blake2b(hashes.tobytes(), digest_size=16).digest(), np.int64)
            rows.append((doc_id, len(found), int(a), int(b), band_keys(hashes, draws)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SIGNATURES, strict=True)], schema=SIGNATURES)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the intersection and of the union for each pair of texts."""
    known, of = None, None
    for a, b, text_a, text_b in texts(batches, "a", "b", "text_a", "text_b"):
        both, union = [], []
        for x, tx, ty in zip(a, text_a, text_b, strict=True):
            if known is None or (x, tx) != known:
                known, of = (x, tx), shingles(tx)
            other = shingles(ty)
            both.append(len(of & other))
            union.append(len(of) + len(other) - both[-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(both, pa.int64()), pa.array(union, pa.int64())], names=["a", "b", "both", "union"]
        )


def _measure(pairs: DataFrame, candidates: DataFrame, label: str) -> DataFrame:
    """``pairs`` of (a, b) with ``both`` and ``union``, the sizes of intersection and union of their full sets."""
    left = candidates.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = candidates.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return materialise(joined.mapInArrow(_confirmed, "a long, b long, both long, union long"), label)


def _links(measured: DataFrame) -> DataFrame:
    return measured.filter(F.col("both") * OF >= F.col("union") * ALIKE).select("a", "b")


def _can_be_alike(x: str, y: str) -> Column:
    return F.least(x, y) * OF >= F.greatest(x, y) * ALIKE


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest id that each linked node reaches. Alternates large-star and small-star steps."""
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        edges = materialise(small.select("e.u", F.col("e.m").alias("v")).filter("u > v").distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = tuple(state)


def _labelled(rows: DataFrame, labels: DataFrame, node: str, into: str) -> DataFrame:
    names = labels.select(F.col("node").alias(node), F.col("label").alias("_label"))
    return rows.join(names, node, "left").withColumn(into, F.coalesce("_label", node)).drop("_label")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    body = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = materialise(body.mapInArrow(_signatures, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"), "signatures")
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = materialise(named.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep")), "classes")

    first = F.col("doc_id") == F.col("rep")
    entries = named.join(classes, ["set_a", "set_b"]).filter(first).select("rep", "n_shingles", F.explode("bands").alias("key"))
    entries = materialise(entries.distinct(), "bucket-entries")
    who = lambda f: f(F.struct("rep", F.col("n_shingles").alias("n")))
    buckets = entries.groupBy("key").agg(who(F.min).alias("least"), F.max("rep").alias("most"))
    buckets = buckets.filter(F.col("least.rep") < F.col("most")).select("key", F.col("least.rep").alias("centre"), F.col("least.n").alias("n_centre"))
    members = materialise(entries.join(buckets, "key"), "bucket-members")
    stars = members.filter((F.col("rep") > F.col("centre")) & _can_be_alike("n_shingles", "n_centre"))
    stars = materialise(stars.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct(), "stars")
    candidates = materialise(body.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "candidate-texts")

    nearest = stars.groupBy("b").agg(F.min("a").alias("a"))
    measured = _measure(nearest, candidates, "nearest-stars")
    labels = components(_links(measured))

    apart = _labelled(_labelled(stars.join(nearest, ["a", "b"], "left_anti"), labels, "a", "la"), labels, "b", "lb").filter("la <> lb")
    measured_more = _measure(apart, candidates, "further-stars")
    labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(_links(measured_more)))

    rest = _across(members, labels, candidates)
    rest = _measure(materialise(rest, "pairs-across"), candidates, "pairs-across-measured")
    labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(_links(rest)))

    out = _labelled(signed.join(classes, ["set_a", "set_b"], "left"), labels, "rep", "component")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, labels, bodies in texts(batches, "rep", "label", "text"):
        for rep, label, body in zip(ids, labels, bodies, strict=True):
            found = shingles(body)
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(s) for s in found), np.uint64, len(found)).view(np.int64)
            same = lambda x: pa.array(np.full(len(hashes), x, np.int64))
            yield pa.RecordBatch.from_arrays([same(rep), same(label), same(len(hashes)), pa.array(hashes)], names=["rep", "label", "n", "hash"])


def _across(members: DataFrame, labels: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pairs in different components that can still be alike, among the members of buckets that hold several components.

    Prefix and position filters over shingles in order of rising frequency: alike documents share one of their rarest quarter, at
    places that leave enough shingles for the rest of the intersection. Both are exact.
    """
    lab = _labelled(members.select("key", "rep"), labels, "rep", "label")
    buckets = materialise(lab, "bucket-labels")
    several = buckets.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    who = buckets.join(several, "key", "left_semi").select("rep", "label").distinct()
    bodies = who.join(candidates.withColumnRenamed("doc_id", "rep"), "rep").select("rep", "label", "text")
    rows = materialise(bodies.mapInArrow(_hashes, "rep long, label long, n long, hash long").distinct(), "bucket-shingles")

    often = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("often"), F.mode("label").alias("main")).filter("often > 1")
    shared = rows.join(often, "hash")
    of_rep = Window.partitionBy("rep")
    alone = F.col("n") - F.count(F.lit(1)).over(of_rep)  # shingles that no other has come first
    placed = shared.withColumn("at", alone + F.row_number().over(of_rep.orderBy("often", "hash")))
    prefix = placed.filter(f"at <= n - ceil(n * {ALIKE} / {OF}) + 1")
    prefix = materialise(prefix.select("rep", "label", "n", "hash", "main", "at"), "bucket-prefixes")

    x, y = (prefix.select("hash", *(F.col(c).alias(f"{c}_{s}") for c in ("rep", "label", "n", "at", "main"))) for s in "xy")
    room = 1 + F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    # Of two components, one isn't the main one of the shingle: only its members look for partners.
    pairs = x.filter("label_x <> main_x").join(
        y, (x["hash"] == y["hash"]) & (x["label_x"] != y["label_y"]) & (room * (OF + ALIKE) >= (F.col("n_x") + F.col("n_y")) * ALIKE)
    )
    return pairs.filter(_can_be_alike("n_x", "n_y")).select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")).distinct()


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest id of each group of near duplicates, one row of each such id; rows without id all stay."""
    name = fresh(docs, "_kept_id")
    chosen = near_duplicates(docs, id_column, text).filter("kept and doc_id is not null").select(F.col("doc_id").alias(name)).distinct()
    stay = docs.join(chosen, docs[id_column] == chosen[name], "left_semi").dropDuplicates([id_column])
    return stay.unionByName(docs.filter(F.col(id_column).isNull()))


def op3_near_dedup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


_WORD = "[^ \\t\\n\\x0b\\f\\r]+"
ORACLE_SQL = {
    "op3_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS g FROM w),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
few AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b USING (g) JOIN few USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * both_ >= 75 * (na.n + nb.n - both_)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.c = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.c) AS component_id, min(r.c) = d.doc_id AS kept
FROM documents d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
""",
}

QUERIES = {"op3_near_dedup": op3_near_dedup}
