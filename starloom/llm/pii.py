"""Personal data: candidate spans, boosted trees, calibrated redaction. DataFrame functions only.

Base spans are the fixed patterns of four kinds with their checks; they are always redacted. High-recall generators propose
further, overlapping spans: spelled-out or spaced e-mail addresses, and every run of digits with separators (blanks, brackets, dots, strokes, slashes) as an
address, a card and a phone number. Each candidate is described by small integer features of its format (digits, groups, separators, check digit ...) and
context (characters beside it, a telling word of its kind before it).

What the fixed patterns miss is not known to be wrong, so it isn't learned as such. Positive examples are the candidates that overlap a base
span of their kind, each also in the loose forms that the patterns don't take (``_loose``: no plus sign, spelled-out e-mail, dotted card).
Negative ones are clear non-cases: candidates that fail their kind's check or overlap a base span of another kind only. All others are left out.
A labelled table (``labelled``) adds loose cases and look-alikes such as dates, amounts and book numbers. It is made from forms, of
which one half is learned from and the other held out, so that no text and no way of writing lies in both.

The candidates of all documents are counted by feature vector. That table is bounded by the product of the features' ranges
(``MOST_VECTORS``) whatever the corpus, and is all that reaches the driver, where trees are boosted on it: per kind and label its weight is
that of ``CORPUS_WEIGHT`` labelled rows. The trees become one SQL expression. A threshold per kind is the least score from which the held-out
forms of the labelled table, ``LEAST_CANDIDATES`` cases at least, and the held-out half of the corpus's examples (by a hash of the id), if any are
positive, are right at ``PRECISION`` or better; a kind without such a score adds nothing, and so do addresses (ip), which have no loose form, and numbers that fail a card's check digit. An added span overlaps no base span.

Patterns are written so that a failing start never rescans a run (possessive quantifiers, look-behind), which keeps them linear on very long
runs; they match what the plain forms match.

Defined results: a null or empty text has no spans; a null text stays null when redacted; spans are code points, the end exclusive; rows with
null or repeated ids are treated row by row; equal spans of two kinds are both listed, and redacted as the kind listed first; an empty table gives an empty
result; other columns are passed through, whatever their names. A text is held whole by one task, however long.
"""

from __future__ import annotations

import math
import re
from itertools import pairwise
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import fresh
from starloom.session import materialise

KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
#: The fixed patterns. \G lets a match start right behind the last one, as the plain form would.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
AT = r"(?:\x20?+(?:@|\(at\)|\[at\])\x20?+)"
DOT = r"(?:\x20?+(?:\.|\(dot\)|\[dot\])\x20?+)"
LABEL = "[A-Za-z0-9-]++"
GENERATORS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++(?:{AT}{LABEL}(?:{DOT}{LABEL})++|\x20at\x20{LABEL}(?:\x20dot\x20{LABEL})++)",
    "number": r"[+(]?+[0-9](?:[\x20()./-]{0,3}+[0-9])++",
}
#: What a text must hold to have a candidate for an e-mail address.
SPELLED = r"[(\[]at[)\]]|\x20dot\x20"
BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Words that announce a kind, right before it.
BETWEEN = r"(?:\W+(?:address|adresse|number|no|nr|nummer|num[eé]ro|n[uú]mero|us|me|him|her|at|on|is|ist|est|es|under|unter|au|al))*\W*$"
TELLING = {
    "email": rf"(?i)\b(?:e-?mail|mail|contact|write to|reach|correo|courriel){BETWEEN}",
    "ip": rf"(?i)\b(?:ip|server|host){BETWEEN}",
    "card": rf"(?i)\b(?:card|visa|mastercard|carte|karte|kreditkarte|tarjeta){BETWEEN}",
    "phone": rf"(?i)\b(?:phone|telephone|tel|t[eé]l[eé]phone|telefon|tel[eé]fono|call|ring|dial|mobile?|m[oó]vil|cell|handy|fax){BETWEEN}",
}
#: Characters before a candidate in which such a word is looked for.
LEFT = 32
#: An e-mail address ends in a word behind a tight or a spelled-out dot; a sentence's end doesn't.
ENDING = r"(?:\.|[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z]{2,}$"
#: Feature -> number of its values.
FEATURES = {"kind": 4, "digits": 8, "groups": 6, "separator": 6, "marked": 2, "valid": 2, "before": 4, "after": 4, "told": 2}
MOST_VECTORS = math.prod(FEATURES.values())
TREES, DEPTH, RATE, RIDGE = 12, 3, 0.4, 1.0
PRECISION, LEAST_CANDIDATES = 0.95, 50
CORPUS_WEIGHT = 50.0


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    """Whether the digits of a short string pass the check of card numbers."""

    def passes(d: Column) -> Column:
        one = lambda acc, c, i: acc + F.when(i % 2 == 0, c).otherwise(2 * c - F.when(c > 4, 9).otherwise(0))
        values = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.struct(c.try_cast("int").alias("c"), i.alias("i")))
        return F.aggregate(values, F.lit(0), lambda acc, x: one(acc, x["c"], x["i"])) % 10 == 0

    return _let(_digits(s), passes)


def _matches(text: Column, pattern: str, guard: Column) -> Column:
    """Array of (start, end, s) of all matches: the parts between them give the places."""
    none = F.array().cast("array<struct<start:int,end:int,s:string>>")

    def placed(found: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["part"])
            end = start + F.length(x["m"])
            return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("s")))).alias("spans"))

        parts = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        pairs = F.arrays_zip(parts.alias("part"), found.alias("m"))
        return F.aggregate(pairs, begin, step)["spans"]

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(guard, _let(found, lambda f: F.when(F.size(f) > 0, placed(f)).otherwise(none))).otherwise(none)


def _passes(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return s.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "phone":
        return n.between(8, 15)
    return n.between(16, 19) & F.when(n.between(16, 19), _luhn(s)).otherwise(False)


def _good(matches: Column, kind: int) -> Column:
    """The matches that pass their kind's check, as (kind, start, end)."""
    good = F.filter(matches, lambda x: _passes(KINDS[kind], x["s"]))
    return F.transform(good, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def _base(text: Column) -> Column:
    """Array of (kind, start, end), by kind and then place; kind is the place in ``KINDS``."""
    has_digit = text.rlike("[0-9]")
    of_kind = []
    for k, kind in enumerate(KINDS):
        guard = F.contains(text, F.lit(NEEDS[kind])) & (F.lit(True) if kind == "email" else has_digit)
        of_kind.append(_good(_matches(text, PATTERNS[kind], guard), k))
    return F.concat(*of_kind)


def _beside(c: Column) -> Column:
    """0 text's end, 1 white space, 2 letter or digit, 3 other."""
    return F.when(F.coalesce(c, F.lit("")) == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^[\p{L}\p{N}]"), 2).otherwise(3)


def _described(text: Column, kind: int, x: Column) -> Column:
    s = x["s"]
    n = F.length(_digits(s))
    bucket = F.when(n == 0, 0).when(n < 7, 1).when(n < 10, 2).when(n < 12, 3).when(n < 13, 4).when(n < 16, 5).when(n < 20, 6).otherwise(7)
    groups = F.least(F.regexp_count(s, F.lit("[0-9]++")), F.lit(5))
    separator = F.when(s.rlike(r"[()\[]"), 4).when(s.rlike("-"), 3).when(F.contains(s, F.lit(".")), 2).when(F.contains(s, F.lit(" ")), 1).otherwise(0)
    valid = s.rlike(ENDING) if kind == 0 else _passes(KINDS[kind], s)
    left = F.substring(text, F.greatest(x["start"] - LEFT + 1, F.lit(1)), F.least(x["start"], F.lit(LEFT)))
    marked = s.rlike(r"^\+") if kind else F.contains(s, F.lit("@")) & ~F.contains(s, F.lit(" "))
    values = {
        "kind": F.lit(kind), "digits": bucket, "groups": groups, "separator": separator, "marked": marked.cast("int"),
        "valid": F.coalesce(valid, F.lit(False)).cast("int"), "before": _beside(F.substring(left, -1, 1)),
        "after": _beside(F.substring(text, x["end"] + 1, F.lit(1))), "told": left.rlike(TELLING[KINDS[kind]]).cast("int"),
    }
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), *(values[f].cast("int").alias(f) for f in FEATURES))


def with_spans(docs: DataFrame, text: str, base: str, candidates: str) -> DataFrame:
    """``docs`` with the base spans and the described candidates of ``text``."""
    body, emails, numbers = F.col(text), fresh(docs, f"_{base}_emails"), fresh(docs, f"_{base}_numbers")
    body = F.coalesce(body, F.lit(""))
    sign = F.contains(body, F.lit("@")) | body.rlike(SPELLED)
    out = docs.withColumns({base: _base(body), emails: _matches(body, GENERATORS["email"], sign), numbers: _matches(body, GENERATORS["number"], body.rlike("[0-9]"))})
    of = lambda found, kind: F.transform(F.col(found), lambda x: _described(body, kind, x))
    described = [of(emails, 0), *(of(numbers, kind) for kind in (1, 2, 3))]
    return out.withColumn(candidates, F.concat(*described)).drop(emails, numbers)


def _touches(spans: Column, x: Column) -> Column:
    return F.exists(spans, lambda b: (b["kind"] == x["kind"]) & (b["start"] < x["end"]) & (b["end"] > x["start"]))


def _overlaps(spans: Column, x: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"]))


# Ways of writing, learned from and held out. N is a digit, C one that completes a card number and X one that doesn't; p, h and t are a person, a host and a
# domain's end.
FORMS = (
    {
        0: ("p (at) h (dot) t", "p(at)h(dot)t", "p @ h.t", "p at h dot t"),
        2: ("NNNN.NNNN.NNNN.NNNC", "NNNN/NNNN/NNNN/NNNC"),
        3: ("0NN NNNNNNN", "(0NN) NNN NN NN", "0NNN-NNNNNNN", "NNN-NNN-NNNN", "(NNN) NNN-NNNN", "0N NN NN NN NN", "00NN NN NNNNNN", "0NN/NNNNNNN", "NNN.NNN.NNNN"),
    },
    {
        0: ("p [at] h [dot] t", "p[at]h[dot]t", "p (at) h.t", "p at h dot co dot t"),
        2: ("NNNNNNNN.NNNNNNNC", "NNNN . NNNN . NNNN . NNNC"),
        3: ("0NNN NNNNNNNN", "(0NNN) NN NN NNN", "0NN-NNNNNNNN", "1-NNN-NNN-NNNN", "NNN NNN NNNN", "0NNNN/NNNNNN", "0N.NN.NN.NN.NN", "0NN NNNN NNNN"),
    },
)
LOOK_ALIKES = (
    ("NNNN NN NN NN NN", "NN N00 000 000", "978-N-NN-NNNNNN-N", "20NNNNNNNNNNNN", "N.NNNNNNNNNN", "N0 N0 N0 N0 N0", "19NN-NN-NN", "N @ N.50", "N.0.NN.NNNN", "NNNNNNNN",
     "NN/NN/20NN", "N/N N/N N/N", "NNNN.NNNN.NNNN.NNNX", "NNNN/NNNN/NNNN/NNNX", "house (at) sea . We", "work [at] night . It", "came at one dot", "N NNN.NN"),
    ("N NNN NNN NNN", "20NN-20NN-20NN", "NNNNNNNNNN", "N.NNN.NNN.NNN", "20NN-NN-NN NN-NN", "N @ NN.5", "N00-N00-N00", "NNNNNNNN.NNNNNNNX", "NNNN . NNNN . NNNN . NNNX", "0.NNNN.NNNN.NNNN", "NN-NN 20NN",
     "(19NN) NN-NNNNNN", "20NN/NN/NN NN/NN", "back (at) home . The", "left (at) noon . Both", "looked at the dot on", "NNN,NNN.NN"),
)
FRAMES = {
    0: ("mail {}", "e-mail: {} today", "Contact {}.", "write to {}"),
    2: ("card {}", "Visa: {} ok", "my card ({})", "Karte {}."),
    3: ("call {}", "tel {}", "Tel.: {} please", "phone {}.", "Fax: {}", "mobile {},", "telephone number is {} now", "ring me on {}"),
}
PLAIN_FRAMES = ("it was {} then", "{}", "so {}.", "und {} ist")
LOOK_ALIKE_FRAMES = (*PLAIN_FRAMES, "page {} of", "order {}", "account {}", "about {} of them", "from {} to", "no. {}")
ITEMS = 6


def written(form: str, kind: int, item: int) -> str:
    """A form filled in by rule."""
    draw = crc32(f"{form} {item}".encode())
    if kind == 0:
        names = {"p": ("anna.berg", "jo_smith", "m.diaz", "info", "luc-petit", "k9")[item % 6], "h": ("example", "post-box", "uni", "mailhost", "werk7")[draw % 5], "t": ("com", "de", "org")[draw % 3]}
        return re.sub(r"\b[pht]\b", lambda m: names[m.group()], form)
    digits = [str(draw // 3**i % 9 + 1) for i in range(20)]
    text = re.sub("N", lambda _: digits.pop(), form)
    passes = lambda values: sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0
    ends = [re.sub("[CX]", check, text) for check in "0123456789"]
    return next(end for end in ends if text == end or passes([int(c) for c in end if c.isdigit()][::-1]) == ("C" in text))


def labelled() -> list[tuple[int, str, int, int, int]]:
    """(half, text, kind, start, end): a span that a reader would redact, or a text without one (kind -1). Each form lies in one half."""
    out = []
    for half in (0, 1):
        for kind, forms in FORMS[half].items():
            for text in dict.fromkeys(written(form, kind, i) for form in forms for i in range(ITEMS)):
                for frame in (*FRAMES[kind], *PLAIN_FRAMES):
                    start = frame.index("{")
                    # A number's candidate starts with its bracket.
                    out.append((half, frame.format(text), kind, start - (kind > 0 and frame[:start].endswith("(")), start + len(text)))
        for text in dict.fromkeys(written(form, -1, i) for form in LOOK_ALIKES[half] for i in range(ITEMS)):
            out += [(half, frame.format(text), -1, 0, 0) for frame in LOOK_ALIKE_FRAMES]
    return out


def _loose(x: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The vector of a base span, and those of its forms that the fixed patterns don't take."""
    at = dict(zip(FEATURES, x, strict=True))
    forms = {0: [{"marked": 0, "separator": s} for s in (1, 2, 4)], 1: [], 2: [{"separator": s} for s in (2, 5)], 3: [{"marked": 0}]}[at["kind"]]
    return [x, *(tuple((at | f).values()) for f in forms)]


class Trees:
    """Boosted regression trees on weighted vectors of small integers, for log loss."""

    def __init__(self, rows: list[tuple[tuple[int, ...], float, float]]):
        """rows: (features, negatives, positives)."""
        positives, total = sum(r[2] for r in rows), sum(r[1] + r[2] for r in rows)
        self.start = math.log((positives + 0.5) / (total - positives + 0.5))
        self.trees: list = []
        raw = [self.start] * len(rows)
        for _ in range(TREES):
            gradients = []
            for (_, n, p), f in zip(rows, raw, strict=True):
                q = 1 / (1 + math.exp(-f))
                gradients.append((p - (n + p) * q, (n + p) * q * (1 - q)))
            tree = self._grow([r[0] for r in rows], gradients, range(len(rows)), DEPTH)
            self.trees.append(tree)
            raw = [f + self._value(tree, r[0]) for f, r in zip(raw, rows, strict=True)]

    def _grow(self, xs, gradients, members, depth):
        g, h = (sum(gradients[i][k] for i in members) for k in (0, 1))
        leaf, best = RATE * g / (h + RIDGE), (1e-6, None, None)
        for f, width in enumerate(FEATURES.values() if depth else ()):
            sums = [[0.0, 0.0] for _ in range(width)]
            for i in members:
                sums[xs[i][f]][0] += gradients[i][0]
                sums[xs[i][f]][1] += gradients[i][1]
            gl = hl = 0.0
            for cut in range(width - 1):
                gl, hl = gl + sums[cut][0], hl + sums[cut][1]
                gain = gl * gl / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g * g / (h + RIDGE)
                if gain > best[0] and 0 < hl < h:
                    best = (gain, f, cut)
        if best[1] is None:
            return leaf
        _, f, cut = best
        sides = [[i for i in members if (xs[i][f] > cut) == right] for right in (False, True)]
        if not all(sides):
            return leaf
        return (f, cut, *(self._grow(xs, gradients, side, depth - 1) for side in sides))

    def _value(self, tree, x) -> float:
        while isinstance(tree, tuple):
            tree = tree[3] if x[tree[0]] > tree[1] else tree[2]
        return tree

    def raw(self, x) -> float:
        return self.start + sum(self._value(t, x) for t in self.trees)

    def column(self, x: Column) -> Column:
        names = list(FEATURES)

        def of(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            return F.when(x[names[tree[0]]] > tree[1], of(tree[3])).otherwise(of(tree[2]))

        total = F.lit(float(self.start))
        for t in self.trees:
            total = total + of(t)
        return total


def _counted(rows: DataFrame) -> list:
    """(half, vector, no, yes) of rows of half and e, a struct of the described candidate x, yes and no."""
    counts = rows.groupBy("half", *(F.col(f"e.x.{f}").alias(f) for f in FEATURES)).agg(F.count_if(F.col("e.yes")).alias("yes"), F.count_if(F.col("e.no")).alias("no"))
    return sorted((r["half"], tuple(r[f] for f in FEATURES), float(r["no"]), float(r["yes"])) for r in counts.collect())  # 2 * MOST_VECTORS rows at most


def _least(held: list[tuple[float, float, float]], fewest: int) -> float:
    """The score from which rows of (score, no, yes), ``fewest`` at least, are positive at ``PRECISION``: halfway to the next lower row, or even odds."""
    bound, good, seen = math.inf, 0.0, 0.0
    for (raw, no, yes), after in pairwise([*sorted(held, reverse=True), (-math.inf, 0, 0)]):
        good, seen = good + yes, seen + no + yes
        if after[0] < raw and seen >= fewest and good >= PRECISION * seen:
            bound = (raw + after[0]) / 2 if after[0] > -math.inf else min(raw, 0.0)
    return bound


def learn(spanned: DataFrame, base: str, candidates: str, id_column: str) -> tuple[Trees, list[float]]:
    """Trees and a threshold per kind, from the counts of all examples by feature vector."""
    half = F.pmod(F.xxhash64(F.lit("half"), F.col(id_column)), F.lit(2))

    def example(x: Column) -> Column:
        yes = _touches(F.col(base), x)
        clear = (x["kind"] > 0) & ((x["valid"] == 0) | _overlaps(F.col(base), x))
        return F.struct(x.alias("x"), yes.alias("yes"), (~yes & clear).alias("no"))

    of_corpus = _counted(spanned.filter(F.size(candidates) > 0).select(half.alias("half"), F.explode(F.transform(candidates, example)).alias("e")))
    of_corpus = [(h, form, no if form == x else 0.0, yes) for h, x, no, yes in of_corpus for form in (_loose(x) if yes else [x]) if no or yes]

    cases = spanned.sparkSession.createDataFrame(labelled(), "half int, text string, kind int, start int, end int")
    right = lambda x: (x["kind"] == F.col("kind")) & (x["start"] == F.col("start")) & (x["end"] == F.col("end"))
    marked = F.transform("found", lambda x: F.struct(x.alias("x"), right(x).alias("yes"), (~right(x)).alias("no")))
    found = with_spans(cases, "text", "sure", "found").withColumn("found", F.filter("found", lambda x: ~_touches(F.col("sure"), x)))
    of_cases = _counted(found.select("half", F.explode(marked).alias("e")))

    # Cases and look-alikes weigh alike in each kind and half.
    of = lambda h, kind, y: sum(r[y] for r in of_cases if r[0] == h and r[1][0] == kind)
    balance = {(h, kind): of(h, kind, 3) / of(h, kind, 2) if of(h, kind, 2) else 1.0 for h in (0, 1) for kind in (0, 2, 3)}
    of_cases = [(h, x, no * balance.get((h, x[0]), 1.0), yes) for h, x, no, yes in of_cases]
    total = {(kind, y): sum(r[y] for r in of_corpus if r[0] == 0 and r[1][0] == kind) for kind in range(len(KINDS)) for y in (2, 3)}
    share = lambda r, y: r[y] * min(1.0, CORPUS_WEIGHT / max(total[r[1][0], y], 1.0))
    trees = Trees([(r[1], share(r, 2), share(r, 3)) for r in of_corpus if r[0] == 0] + [r[1:] for r in of_cases if r[0] == 0])
    bounds = []
    for kind in range(len(KINDS)):
        cases_held, corpus_held = ([(trees.raw(x), no, yes) for h, x, no, yes in rows if h == 1 and x[0] == kind] for rows in (of_cases, of_corpus))
        bounds.append(max(_least(cases_held, LEAST_CANDIDATES), _least(corpus_held, 1) if any(yes for *_, yes in corpus_held) else -math.inf))
    return trees, bounds


def find(docs: DataFrame, text: str = "text", id_column: str = "doc_id", into: str = "pii", keep_text: bool = True) -> DataFrame:
    """``docs`` with a struct ``into``: ``base`` and ``spans``, arrays of (kind, start, end) by kind and place."""
    base, candidates = fresh(docs, f"_{into}_base"), fresh(docs, f"_{into}_candidates")
    spanned = with_spans(docs, text, base, candidates)
    spanned = materialise(spanned if keep_text else spanned.drop(text), "pii-spans")
    trees, bounds = learn(spanned, base, candidates, id_column)
    own, limits = F.col(base), F.array(*(F.lit(float(b)) for b in bounds))
    # Only kinds with loose forms (not ip) add spans, and a number that fails the check digit is no card, whatever stands around it.
    possible = lambda x: (x["kind"] != 1) & ((x["kind"] != 2) | (x["valid"] == 1))
    chosen = F.filter(F.col(candidates), lambda x: possible(x) & (trees.column(x) >= F.get(limits, x["kind"])) & ~_overlaps(own, x))
    added = F.transform(chosen, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    spans = F.sort_array(F.concat(own, added))
    return spanned.withColumn(into, F.struct(own.alias("base"), spans.alias("spans"))).drop(base, candidates)


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by the kind of its first, as ``<EMAIL>``."""
    tags = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    by_place = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, x: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        written = F.when(x["start"] >= acc["at"], F.concat(acc["out"], between, F.get(tags, x["kind"]))).otherwise(acc["out"])
        return F.struct(written.alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))

    done = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(by_place, begin, step, done)).otherwise(text)


def redact(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``docs`` with the spans of ``text`` replaced; the other columns as they are."""
    into = fresh(docs, "_pii")
    found = find(docs, text, id_column, into)
    return found.withColumn(text, redacted(F.col(text), F.col(into)["spans"])).select(*docs.columns)


def op7_pii(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find(docs, keep_text=False)
    base = F.col("pii.base")
    number = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long")
    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("pii.spans")).alias("spans"))


QUERIES = {"op7_pii": op7_pii}
