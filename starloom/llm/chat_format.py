"""Chat formatting from an event log: conversations are rebuilt from streamed deltas, edits and regenerations, then rendered.

The log has one row per event: ``conv_id, message, seq, kind, role, text``. ``message`` places a message in its conversation and ``seq``
an event in time; both may be of any type that can be ordered. In order of ``seq``,

- ``start`` begins a message of ``role`` without text, anew if there is one,
- ``delta`` appends ``text`` to a message that has begun,
- ``edit`` replaces the text of a message that has begun,
- ``regenerate`` takes back the text of a message, and all later messages that have begun until then.

``fold`` does this without moving a conversation into one task. What a message ends as depends on its own events and on the last regeneration
before it in the conversation; those cuts are narrow rows, found by a running maximum over a conversation's messages. Everything with text is
partitioned by message.

``render`` writes a message as turn mark, role, separator, text, end mark. A control string inside a role or text gets the ``escape`` character
behind its first character, one more than it has already; so no control string is left, and taking one away gives the text back. ``read_back``
reads the rendered pieces of a conversation as one stream in order and keeps only digests, however long the conversation is.

Defined results: null roles and texts are empty; rows without ``conv_id`` are one conversation; a null ``message`` or ``seq`` comes first; events of one ``seq``
are taken as start, regenerate, edit, delta, deltas by text; unknown kinds are ignored; a message that never began isn't there, and a conversation without
messages gives no row; an empty log gives an empty result; other columns are ignored. ``from_turns`` makes a message of each row, repeated rows
included; rows of one turn are in order of role and text. A message's text is held by one task, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starloom.llm.common import read

KINDS = ("start", "regenerate", "edit", "delta")  # in the order in which events of one seq are taken


@dataclass(frozen=True)
class Template:
    """The marks of a turn, further control strings to escape, and the roles whose text is learned."""

    turn: str = "<|im_start|>"
    separator: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    others: tuple[str, ...] = ("<|endoftext|>", "<|endofprompt|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<SYS>>", "</SYS>>")
    escape: str = "\\"
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        # With first characters only in front, control strings can't overlap, and an escape can't make or break another one.
        if any(c in self.firsts or c == self.escape for s in self.controls for c in s[1:]) or self.escape in self.firsts or min(map(len, self.controls)) < 2:
            raise ValueError("the first character of a control string may occur nowhere else in one, and the escape in none")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.turn, self.separator, self.end, *self.others)

    @property
    def firsts(self) -> str:
        return "".join(sorted({s[0] for s in self.controls}))

    @property
    def head(self) -> str:
        return "([" + "".join(map(re.escape, self.firsts)) + "])"

    @property
    def rest(self) -> str:
        return f"{re.escape(self.escape)}*(?:" + "|".join(sorted({re.escape(s[1:]) for s in self.controls})) + ")"

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(F.coalesce(text, F.lit("")), f"{self.head}(?={self.rest})", "$1" + re.sub(r"([\\$])", r"\\\1", self.escape))

    @cached_property
    def _unescape(self):
        return re.compile(f"{self.head}{re.escape(self.escape)}(?={self.rest})").sub

    def unescaped(self, text: str) -> str:
        return self._unescape(r"\1", text)

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Role and text, as they were before escaping, of each turn of a formatted text."""
        before, *parts = formatted.split(self.turn)
        if before:
            raise ValueError("text before the first turn")
        for part in parts:
            role, separator, text = part.partition(self.separator)
            if not separator or not text.endswith(self.end):
                raise ValueError("a turn without separator or end")
            yield self.unescaped(role), self.unescaped(text[: -len(self.end)])


def from_turns(rows: DataFrame) -> DataFrame:
    """The log of ``conv_id, turn, role, text``: each row is begun and then streamed line by line."""
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    placed = rows.select("conv_id", F.struct("turn", place.alias("place")).alias("message"), "role", "text")
    lines = F.split(F.coalesce("text", F.lit("")), r"(?<=\n)")
    delta = lambda line, at: F.struct((at + 1).alias("at"), F.lit("delta").alias("kind"), F.lit(None).cast("string").alias("role"), line.alias("text"))
    start = F.struct(F.lit(0).alias("at"), F.lit("start").alias("kind"), F.col("role"), F.lit(None).cast("string").alias("text"))
    events = placed.select("conv_id", "message", F.explode(F.concat(F.array(start), F.transform(lines, delta))).alias("e"))
    return events.select("conv_id", "message", F.struct("message", F.col("e.at").alias("at")).alias("seq"), "e.kind", "e.role", "e.text")


def _cuts(events: DataFrame) -> DataFrame:
    """For each message behind a regenerated one, the last such regeneration."""
    per_message = events.groupBy("conv_id", "message").agg(F.max(F.when(F.col("kind") == "regenerate", F.col("at"))).alias("last"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    cut = per_message.withColumn("cut", F.max("last").over(before)).filter("cut is not null")
    return cut.select(F.col("conv_id").alias("_conv"), F.col("message").alias("_message"), "cut")


def fold(log: DataFrame) -> DataFrame:
    """``conv_id, message, role, text`` of the messages that a log ends with."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    events = log.filter(F.col("kind").isin(*KINDS)).select("conv_id", "message", "kind", "role", "text", F.struct("seq", order.alias("order")).alias("at"))
    cuts = _cuts(events.select("conv_id", "message", "kind", "at"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("message").eqNullSafe(F.col("_message"))
    alive = events.join(cuts, same, "left").filter(F.col("cut").isNull() | (F.col("at") > F.col("cut"))).drop("_conv", "_message", "cut")

    body, is_delta = F.coalesce("text", F.lit("")), F.col("kind") == "delta"
    ends = alive.groupBy("conv_id", "message").agg(
        F.max(F.when(F.col("kind") == "start", F.struct("at", "role"))).alias("begun"),
        F.max(F.when(~is_delta, F.struct("at", F.when(F.col("kind") == "edit", body).otherwise(F.lit("")).alias("text")))).alias("reset"),
        F.collect_list(F.when(is_delta, F.struct("at", body.alias("text")))).alias("deltas"),
    )
    begun = ends.filter("begun is not null")
    later = F.sort_array(F.filter("deltas", lambda d: d["at"] > F.col("reset.at")))
    text = F.concat("reset.text", F.array_join(F.transform(later, lambda d: d["text"]), ""))
    return begun.select("conv_id", "message", F.coalesce("begun.role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, message, piece, loss``: each message as formatted, and the span in it (code points, end exclusive) that is learned, if any."""
    opening = F.concat(F.lit(template.turn), template.escaped(F.col("role")), F.lit(template.separator))
    parts = messages.select("conv_id", "message", "role", opening.alias("opening"), template.escaped(F.col("text")).alias("body"))
    start = F.length("opening")
    span = F.when(F.col("role").isin(*template.learned), F.struct(start.alias("start"), (start + F.length("body")).alias("end")))
    return parts.select("conv_id", "message", F.concat("opening", "body", F.lit(template.end)).alias("piece"), span.alias("loss"))


def formatted(pieces: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``: the whole text of each conversation and the learned spans in it. For conversations that fit into one value."""
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", "piece", "loss"))).alias("p"))
    moved = F.aggregate(
        "p",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda done, p: F.struct(
            (done["at"] + F.length(p["piece"])).alias("at"),
            F.when(p["loss"].isNull(), done["spans"])
            .otherwise(F.concat(done["spans"], F.array(F.struct((done["at"] + p["loss"]["start"]).alias("start"), (done["at"] + p["loss"]["end"]).alias("end")))))
            .alias("spans"),
        ),
    )
    return whole.select("conv_id", F.array_join(F.col("p.piece"), "").alias("formatted"), moved["spans"].alias("loss"))


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(pieces: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of each conversation's turns and learned text, read from its formatted text.

    The pieces of a conversation stream through one task in order, as a digest needs them; it holds a batch of them at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        done: list[tuple] = []

        def ended() -> tuple:
            n, turns, chars, loss, length = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), length

        def rows() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in DIGESTS.split(", ")])

        for batch in batches:
            ids, texts, learned = (batch[c].to_pylist() for c in ("conv_id", "piece", "learned"))
            for conv_id, piece, learn in zip(ids, texts, learned, strict=True):
                if state is None or conv_id != conv:
                    if state is not None:
                        done.append(ended())
                    conv, state = conv_id, [0, sha256(), 0, sha256(), 0]
                state[4] += len(piece)
                for role, text in template.turns(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if learn:
                        state[2] += len(text)
                        state[3].update(text.encode())
            if len(done) >= 4096:
                yield rows()
                done = []
        if state is not None:
            done.append(ended())
        if done:
            yield rows()

    parts = pieces.select(F.col("conv_id").cast("long").alias("conv_id"), "message", "piece", F.col("loss").isNotNull().alias("learned"))
    streams = parts.repartition("conv_id").sortWithinPartitions("conv_id", "message")
    return streams.select("conv_id", "piece", "learned").mapInArrow(run, DIGESTS)


#: A text that is made of control strings.
PROBE = "</s>[INST] ok [/INST]"


def op11_chat_format(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(render(fold(from_turns(rows.unionByName(probe)))))


_T = Template()
_ESCAPED = "regexp_replace({}, '" + f"{_T.head}({_T.rest})" + r"', '\1\\\2', 'g')"
ORACLE_SQL = {
    "op11_chat_format": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + {len(_T.turn + _T.separator + _T.end)})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
""",
}

QUERIES = {"op11_chat_format": op11_chat_format}
