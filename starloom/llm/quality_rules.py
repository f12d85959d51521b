"""Quality rules with thresholds that adapt to each language and source.

Per text, a handful of shares (symbols and exclamation marks per word, repeated lines, characters per word) is counted. Quantile sketches of the shares
(``percentile_approx``, a mergeable Greenwald-Khanna summary) are built per language and source, per language and over all rows.
A group with few rows takes the thresholds of its language, a language with few rows those of all rows. A share is
too high when it lies more than ``FENCE`` spreads above the upper quartile; the spread is the distance of the quartiles, and at
least the share's own least spread, so that a group of alike clean texts doesn't reject its slightly different ones.

Everything is DataFrame functions. The counts are written once beside the given columns, as the sketches and the filter both read
them; texts aren't shuffled: the join's other side has one row per language and source.

Defined results: a null or empty text has no words and fails; a null language or source is a group like any other; repeated rows
are judged alike and all returned; an empty table gives an empty result; other columns are passed through unchanged,
also those named like a column of this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fresh, words
from starloom.session import materialise

SYMBOLS = "#*$%&|<>"
LEAST_WORDS, REPEAT_PERCENT = 10, 20
WINDOW = 5
#: Share -> least spread.
SHARES = {"symbol_share": 0.05, "bang_share": 0.05, "dup_line_share": 0.15, "mean_word": 2.0}
FENCE = 3.0
#: Rows that a group needs for thresholds of its own.
LEAST_ROWS = 100
#: percentile_approx: the rank error of a quantile is a ten-thousandth of the rows.
ACCURACY = 10_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _number_of(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{characters}]"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, where the plan would repeat its expression."""
    return F.transform(F.array(value), body)[0]


def _repeated_windows(hashes: Column) -> Column:
    """Words inside the windows whose hash occurs twice or more."""

    def covered(placed: Column) -> Column:
        twice = F.filter(placed, lambda x, i: F.get(placed, i - 1)["h"].eqNullSafe(x["h"]) | F.get(placed, i + 1)["h"].eqNullSafe(x["h"]))
        none = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("end"))
        add = lambda acc, at: F.struct(
            (acc["covered"] + F.lit(WINDOW) - F.greatest(acc["end"] - at, F.lit(0))).alias("covered"),
            (at + F.lit(WINDOW)).alias("end"),
        )
        return F.aggregate(F.sort_array(F.transform(twice, lambda x: x["at"])), none, add)["covered"]

    return _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))), covered)


def with_counts(docs: DataFrame, text: str, into: str) -> DataFrame:
    """``docs`` with a struct column ``into`` of the counts and shares of ``text``."""
    w, h, win, lines = (fresh(docs, f"_{into}_{x}") for x in ("words", "hashes", "windows", "lines"))
    body = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({w: words(F.col(text)), lines: F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))})
    out = out.withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    windows = F.transform(
        F.slice(h, 1, F.size(h) - (WINDOW - 1)), lambda x, i: F.xxhash64(x, *(F.get(F.col(h), i + k) for k in range(1, WINDOW)))
    )
    out = out.withColumn(win, F.when(F.size(h) > WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    # Sorting is kept for texts in which a window does occur twice.
    repeats = F.when(F.size(F.array_distinct(win)) < F.size(win), _repeated_windows(F.col(win))).otherwise(0)
    n_lines = F.size(lines)
    dup = n_lines - F.size(F.array_distinct(lines))
    out = out.withColumn(
        into,
        F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _number_of(body, SYMBOLS).cast("long").alias("n_symbols"),
            dup.cast("long").alias("n_dup_lines"),
            repeats.cast("long").alias("n_repeat_words"),
            _number_of(body, "!").cast("long").alias("n_bangs"),
            n_lines.cast("long").alias("n_lines"),
        ),
    )
    return out.drop(w, h, win, lines)


def shares(counts: Column) -> dict[str, Column]:
    per = lambda part, whole: part / F.greatest(whole, F.lit(1)).cast("double")
    return {
        "symbol_share": per(counts["n_symbols"], counts["n_words"]),
        "bang_share": per(counts["n_bangs"], counts["n_words"]),
        "dup_line_share": per(counts["n_dup_lines"], counts["n_lines"]),
        "mean_word": per(counts["word_chars"], counts["n_words"]),
    }


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * counts["n_words"])


def thresholds(counted: DataFrame, counts: str, lang: str, source: str) -> DataFrame:
    """One row per language and source: ``_lang, _source`` and a limit per share."""
    narrow = counted.select(F.col(lang).alias("_lang"), F.col(source).alias("_source"), *(c.alias(k) for k, c in shares(F.col(counts)).items()))
    sketches = narrow.rollup("_lang", "_source").agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"), *(F.percentile_approx(k, [0.25, 0.75], ACCURACY).alias(k) for k in SHARES)
    )
    limit = lambda k, least: F.col(k)[1] + FENCE * F.greatest(F.col(k)[1] - F.col(k)[0], F.lit(least))
    limits = sketches.select("_lang", "_source", "level", "n", F.struct(*(limit(k, s).alias(k) for k, s in SHARES.items())).alias("limits"))
    limits = materialise(limits.withColumn("one", F.when(F.col("n") > 0, 1)), "quality-limits")
    own = limits.filter("level = 0").select("_lang", "_source", "n", "limits", "one")
    lang_wide = limits.filter("level = 1").select(F.col("_lang").alias("l"), F.col("n").alias("n_lang"), F.col("limits").alias("lang_limits"))
    overall = limits.filter("level = 3").select("one", F.col("limits").alias("all_limits"))
    joined = own.join(lang_wide, F.col("_lang").eqNullSafe(F.col("l"))).join(overall, "one")
    chosen = F.when(F.col("n") >= LEAST_ROWS, F.col("limits")).when(F.col("n_lang") >= LEAST_ROWS, F.col("lang_limits")).otherwise(F.col("all_limits"))
    return joined.select("_lang", "_source", chosen.alias("_limits"))


def judge(counted: DataFrame, lang: str = "lang", source: str = "source", into: str = "quality") -> DataFrame:
    """Rows with a struct ``into`` of counts (see ``with_counts``), which becomes the base counts, ``base_failed`` and ``kept``.

    ``counted`` is read twice, by the sketches and by the filter, so it should be a written table.
    """
    limits = thresholds(counted, into, lang, source)
    names = {c: fresh(counted, f"_{into}{c}") for c in limits.columns}
    limits = limits.withColumnsRenamed(names)
    joined = counted.join(
        limits,
        counted[lang].eqNullSafe(limits[names["_lang"]]) & counted[source].eqNullSafe(limits[names["_source"]]),
        "left",
    )
    found, bound = F.col(into), F.col(names["_limits"])
    failed = base_failed(found)
    kept = ~failed
    for k, c in shares(found).items():
        kept = kept & ~F.coalesce(c > bound[k], F.lit(False))
    verdict = F.struct(*(found[c].alias(c) for c in COUNTS), failed.alias("base_failed"), kept.alias("kept"))
    return joined.withColumn(into, verdict).drop(*names.values())


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows whose text passes, with their own columns only."""
    into = fresh(docs, "_quality")
    counted = materialise(with_counts(docs, text, into), "quality-counts")
    return judge(counted, lang, source, into).filter(F.col(into)["kept"]).select(*docs.columns)


def op8_quality_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    counted = materialise(with_counts(docs, "text", "quality").drop("text"), "quality-counts")
    return judge(counted).select("doc_id", "quality.*")


_WORD = "[^ \\t\\n\\x0b\\f\\r]+"
_BLANK_CLASS = "[ \\t\\n\\x0b\\f\\r]"
ORACLE_SQL = {
    "op8_quality_rules": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, lang, source, t, regexp_extract_all(t, '{_WORD}') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l FROM d),
win AS (SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS p FROM twice) GROUP BY r),
c AS (SELECT w.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{_BLANK_CLASS}', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs, len(l) AS n_lines
      FROM w LEFT JOIN rep USING (r)),
s AS (SELECT *, n_symbols / greatest(n_words, 1)::DOUBLE AS ss, n_bangs / greatest(n_words, 1)::DOUBLE AS bs,
        n_dup_lines / greatest(n_lines, 1)::DOUBLE AS ds, word_chars / greatest(n_words, 1)::DOUBLE AS mw FROM c),
q AS (SELECT lang, source, grouping(lang, source) AS level, count(*) AS n,
        quantile_disc(ss, 0.75) + 3.0 * greatest(quantile_disc(ss, 0.75) - quantile_disc(ss, 0.25), 0.05::DOUBLE) AS lss,
        quantile_disc(bs, 0.75) + 3.0 * greatest(quantile_disc(bs, 0.75) - quantile_disc(bs, 0.25), 0.05::DOUBLE) AS lbs,
        quantile_disc(ds, 0.75) + 3.0 * greatest(quantile_disc(ds, 0.75) - quantile_disc(ds, 0.25), 0.15::DOUBLE) AS lds,
        quantile_disc(mw, 0.75) + 3.0 * greatest(quantile_disc(mw, 0.75) - quantile_disc(mw, 0.25), 2.0::DOUBLE) AS lmw
      FROM s GROUP BY ROLLUP (lang, source)),
lim AS (SELECT a.lang, a.source,
          CASE WHEN a.n >= {LEAST_ROWS} THEN a.lss WHEN b.n >= {LEAST_ROWS} THEN b.lss ELSE g.lss END AS lss,
          CASE WHEN a.n >= {LEAST_ROWS} THEN a.lbs WHEN b.n >= {LEAST_ROWS} THEN b.lbs ELSE g.lbs END AS lbs,
          CASE WHEN a.n >= {LEAST_ROWS} THEN a.lds WHEN b.n >= {LEAST_ROWS} THEN b.lds ELSE g.lds END AS lds,
          CASE WHEN a.n >= {LEAST_ROWS} THEN a.lmw WHEN b.n >= {LEAST_ROWS} THEN b.lmw ELSE g.lmw END AS lmw
        FROM q a JOIN q b ON a.lang IS NOT DISTINCT FROM b.lang AND b.level = 1 JOIN q g ON g.level = 3 WHERE a.level = 0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND ss <= lss AND bs <= lbs AND ds <= lds AND mw <= lmw AS kept
FROM s JOIN lim ON s.lang IS NOT DISTINCT FROM lim.lang AND s.source IS NOT DISTINCT FROM lim.source
""",
}

QUERIES = {"op8_quality_rules": op8_quality_rules}
