"""Language identification by cross-parsing against the suffix automaton of labelled text of each language.

A text is parsed greedily into the longest phrases that occur in a language's labelled text. Where a phrase ends, the automaton starts anew, so the
parse is one deterministic automaton whose steps either go on or count a phrase. The language of the fewest phrases wins, after
weighting each by the logarithm of the language's text length (the cost of pointing to a phrase).

Text is lower-cased, every run of other characters than letters becomes one blank, and the rest is parsed as UTF-8 bytes. So a language's alphabet is
the bytes that its own text has, whatever its script and however many letters that has; a byte that doesn't occur there is a
phrase of its own. Texts are parsed whole, all blocks of many texts and all languages at once, a byte a step. A block of ``BLOCK`` bytes
starts a phrase of its own, in every language alike, which adds at most one phrase for each block and language.

The model is bounded: ``SAMPLE`` labelled rows per language, of each the ``ROW_CHARACTERS`` characters and then the ``PER_ROW`` bytes in its middle,
``MODEL_BYTES`` in all.

Defined results: a null text and one without a letter is ``und`` with score 0, and so is every text if no row is labelled; ties go to the
language first in order; rows without id are predicted but not learned from, and of rows of one id and language one is; repeated rows get equal results;
an empty table gives an empty result; other columns, also those named as the results, are ignored. The score is 1 less the ratio of the best to the
second-best cost, and 1 where there is one language. A text is held whole by one task, however long.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fold, held_out, one_text_each, read, spread_sample, texts

FOLDS, HELD_OUT = 3, 1
SAMPLE, ROW_CHARACTERS, PER_ROW, MODEL_BYTES = 60, 1 << 16, 600, 24_000
BLOCK = 2048
#: Characters parsed at once; bounds a task's memory beside its longest text.
AT_ONCE = 1 << 21
UNDETERMINED = "und"
BLANK = 32


def letters() -> np.ndarray:
    """Which code points are letters."""
    table = np.zeros(0x110000, bool)
    for point in range(0x110000):
        table[point] = chr(point).isalpha()
    return table


def _bytes(text: str | None, is_letter: np.ndarray) -> np.ndarray:
    """UTF-8 of a text's letters in lower case, a blank (never twice in a row, nor first) for each run of anything else."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = is_letter[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of each run of others stays as a blank
    kept = np.where(letter, points, BLANK)[keep].astype("<u4")
    return np.frombuffer(kept.tobytes().decode("utf-32-le").encode(), np.uint8)


def automaton(codes: list[int], width: int) -> np.ndarray:
    """States by symbols: the next state, or the complement of the state after starting a new phrase with the symbol.

    The last state is that of the beginning, and of a symbol that doesn't occur: whatever follows starts a phrase.
    """
    follow, link, length = [{}], [-1], [0]
    last = 0
    for c in codes:
        now = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = now
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                clone = len(follow)
                follow.append(dict(follow[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = clone
                    p = link[p]
                link[q] = link[now] = clone
        last = now
    between = len(follow)
    first = np.array([follow[0].get(c, between) for c in range(width)], np.int32)
    table = np.broadcast_to(~first, (between + 1, width)).copy()
    for state, steps in enumerate(follow):
        for c, target in steps.items():
            table[state, c] = target
    return table


def fit(rows: list[tuple[str, str]]) -> dict | None:
    """The model of (language, text) rows."""
    by_language: dict[str, list[str]] = defaultdict(list)
    for language, text in rows:
        by_language[language].append(text or "")
    is_letter = letters()
    languages, alphabets, tables, starts, weights, at = [], [], [], [], [], 0
    for language in sorted(by_language):
        parts = [_bytes(t, is_letter) for t in by_language[language]]
        cut = [p[max(0, (len(p) - PER_ROW) // 2) :][:PER_ROW] for p in parts]  # from the middle of each row
        text = np.concatenate(cut)[:MODEL_BYTES]
        if not len(text):
            continue
        own = np.unique(text)
        alphabet = np.full(256, len(own), np.int32)  # the last symbol stands for every byte that doesn't occur
        alphabet[own] = np.arange(len(own))
        states = automaton(alphabet[text].tolist(), len(own) + 1)
        # Steps hold the place of the next state's row in all tables.
        steps = np.where(states >= 0, states, ~states) * (len(own) + 1) + at
        tables.append(np.where(states >= 0, steps, ~steps).astype(np.int32).ravel())
        languages.append(language)
        alphabets.append(alphabet)
        starts.append(at + (len(states) - 1) * (len(own) + 1))
        weights.append(np.log2(len(text) + 1))
        at += states.size
    if not languages:
        return None
    return {
        "letters": is_letter, "languages": languages, "alphabets": np.stack(alphabets), "steps": np.concatenate(tables), "starts": np.array(starts, np.int32),
        "weights": np.array(weights),
    }


def phrases(model: dict, coded: list[np.ndarray]) -> np.ndarray:
    """Number of phrases per text and language."""
    owners, blocks = [], []
    for i, text in enumerate(coded):
        for at in range(0, len(text), BLOCK):
            owners.append(i)
            blocks.append(text[at : at + BLOCK])
    counts = np.zeros((len(coded), len(model["languages"])))
    if not blocks:
        return counts
    lengths = np.array([len(b) for b in blocks])
    order = np.argsort(-lengths, kind="stable")
    column = np.zeros((lengths.max(), len(blocks)), np.uint8)
    for place, b in enumerate(order):
        column[: lengths[b], place] = blocks[b]
    left = np.searchsorted(-lengths[order], -np.arange(lengths.max()), side="left")  # blocks longer than each step
    steps, alphabets = model["steps"], model["alphabets"]
    states = np.repeat(model["starts"][:, None], len(blocks), axis=1)
    found = np.zeros((len(model["languages"]), len(blocks)), np.int32)
    for t, n in enumerate(left):
        step = steps.take(states[:, :n] + alphabets.take(column[t, :n], axis=1))
        ended = step >> 31  # -1 where a phrase ends
        found[:, :n] -= ended
        states[:, :n] = step ^ ended
    np.add.at(counts, np.array(owners)[order], found.T)
    return counts


def predict(model: dict | None, bodies: list[str | None]) -> tuple[list[str], list[float]]:
    if model is None:
        return [UNDETERMINED] * len(bodies), [0.0] * len(bodies)
    coded = [_bytes(t, model["letters"]) for t in bodies]
    cost = phrases(model, coded) * model["weights"]
    best = cost.argmin(axis=1)
    ordered = np.sort(cost, axis=1)
    second = ordered[:, 1] if cost.shape[1] > 1 else np.full(len(coded), np.inf)
    with np.errstate(invalid="ignore", divide="ignore"):
        score = np.clip(np.nan_to_num(1 - ordered[:, 0] / second), 0, 1)
    known = [len(c) > 0 for c in coded]
    return [model["languages"][b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)], [float(s) if k else 0.0 for s, k in zip(score, known, strict=True)]


def learn(docs: DataFrame) -> dict | None:
    """Fits on a bounded sample of the labelled rows that aren't held out."""
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    few = spread_sample(known.select("doc_id", "lang").distinct(), "lang", "doc_id", SAMPLE)
    middle = F.substring("text", F.greatest(F.lit(1), F.floor((F.length("text") - ROW_CHARACTERS) / 2).cast("int") + 1), F.lit(ROW_CHARACTERS))
    rows = known.join(F.broadcast(few), ["doc_id", "lang"]).select("lang", middle.alias("text"), "doc_id")
    rows = one_text_each(rows, "lang", "doc_id")
    return fit([(r["lang"], r["text"]) for r in rows.orderBy("lang", F.xxhash64("doc_id"), "doc_id").collect()])  # SAMPLE rows per language


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MODEL_BYTES and the number of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bodies, size = [], [], 0

        def done() -> pa.RecordBatch:
            lang, score = predict(held.value, bodies)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

        for some_ids, some in texts(batches, "doc_id", "text"):
            ids, bodies, size = ids + some_ids, bodies + some, size + sum(len(t or "") for t in some)
            if size >= AT_ONCE:
                yield done()
                ids, bodies, size = [], [], 0
        if ids:
            yield done()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op1_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score")


QUERIES = {"op1_language_id": op1_language_id}
