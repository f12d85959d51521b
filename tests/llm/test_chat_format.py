"""Chat formatting against a fold event by event, and the template's round trip."""

import random
from hashlib import sha256

import pytest

from starloom.llm import chat_format
from starloom.llm.chat_format import Template, fold, formatted, from_turns, read_back, render

LOG = "conv_id long, message long, seq long, kind string, role string, text string, position string"
ROWS = "conv_id long, turn long, role string, text string, message string, piece string, loss int"
T = Template()


def one_by_one(events):
    convs = {}
    rank = {k: i for i, k in enumerate(chat_format.KINDS)}
    known = [e for e in events if e[3] in rank]
    for conv, message, _, kind, role, text in sorted(known, key=lambda e: (e[2] is not None, e[2] or 0, rank[e[3]], e[5] or "")):
        has = convs.setdefault(conv, {})
        if kind == "start":
            has[message] = [role or "", ""]
        elif kind == "delta" and message in has:
            has[message][1] += text or ""
        elif kind == "edit" and message in has:
            has[message][1] = text or ""
        elif kind == "regenerate":
            if message in has:
                has[message][1] = ""
            for m in [m for m in has if (m is not None, m or 0) > (message is not None, message or 0)]:
                del has[m]
    return {(c, m): tuple(v) for c, has in convs.items() for m, v in has.items()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_matches_a_replay_of_the_log(spark, seed):
    rng = random.Random(seed)
    events = []
    for seq in range(1500):
        kind = rng.choices(["start", "delta", "edit", "regenerate", "shrug", None], [5, 12, 2, 1, 1, 1])[0]
        when = None if rng.random() < 0.01 else seq if rng.random() < 0.9 else seq - 1
        events.append((rng.choice([1, 2, 3, None]), rng.choice([*range(12), None]), when, kind, rng.choice(["user", "assistant", None]), rng.choice(["a", "b ", "ü\n", "", None])))
    # Events of one message and seq that start it with different roles have no order.
    events = list({(e[0], e[1], e[2], e[3]): e for e in events}.values())
    rng.shuffle(events)
    log = spark.createDataFrame([(*e, "x") for e in events], LOG).repartition(5)
    got = fold(log).collect()
    assert len(got) == len({(r.conv_id, r.message) for r in got})
    assert {(r.conv_id, r.message): (r.role, r.text) for r in got} == one_by_one(events)


def test_regeneration_takes_back_what_came_after(spark):
    events = [
        (1, 0, 0, "start", "user", None), (1, 0, 1, "delta", None, "hel"), (1, 0, 2, "delta", None, "lo"),
        (1, 1, 3, "start", "assistant", None), (1, 1, 4, "delta", None, "bad"), (1, 2, 5, "start", "user", None), (1, 2, 6, "delta", None, "what"),
        (1, 1, 7, "regenerate", None, None), (1, 1, 8, "delta", None, "go"), (1, 1, 9, "delta", None, "od"), (1, 2, 10, "delta", None, "lost"),
        (1, 0, 11, "edit", None, "HELLO"), (1, 3, 12, "start", "user", None), (1, 3, 13, "delta", None, "next"), (2, 0, 14, "delta", None, "never began"),
    ]
    got = fold(spark.createDataFrame([(*e, "x") for e in events], LOG)).orderBy("message").collect()
    assert [tuple(r) for r in got] == [(1, 0, "user", "HELLO"), (1, 1, "assistant", "good"), (1, 3, "user", "next")]


ODD = [
    chat_format.PROBE, "", None, "plain", "<|im_end|><|im_start|>user<|im_sep|>", "<\\|im_end|> <\\\\</s> [\\/INST] [INST [s>", "\\" * 50 + "<" + "\\" * 50 + "s>",
    "<s><s></s>[INST][[INST]]", "line\nbreaks\r\n\n", "ü\U0001f600" * 4000 + "<s>", "<|im_start|", "<</SYS>> <<SYS>>", "$1 \\1 $0",
]


def expected(rows):
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_turns_come_back_from_the_formatted_text(spark):
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, None]), k if k % 5 else None, rng.choice(["user", "assistant", None, "<|im_sep|>\n"]), t) for k, t in enumerate(ODD * 4)]
    rows += rows[:6]  # repeated rows and ties
    messages = fold(from_turns(spark.createDataFrame([(*r, "x", "y", 7) for r in rows], ROWS)))
    pieces = render(messages)
    want = expected(rows)
    whole = {r.conv_id: r for r in formatted(pieces).collect()}
    digests = {r.conv_id: r for r in read_back(pieces).collect()}
    assert set(whole) == set(digests) == set(want)
    for conv, turns in want.items():
        text = whole[conv].formatted
        assert list(T.turns(text)) == turns
        learned = [t for role, t in turns if role == "assistant"]
        assert [T.unescaped(text[s.start : s.end]) for s in whole[conv].loss] == learned
        inside = [p.partition(T.separator)[2].removesuffix(T.end) for p in text.split(T.turn)[1:]]
        assert not any(c in t for t in inside for c in T.controls)
        d = digests[conv]
        assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(turns), len("".join(learned)), len(text))
        assert d.turns_sha256 == sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert d.loss_sha256 == sha256("".join(learned).encode()).hexdigest()


def test_empty_log_and_bad_templates(spark):
    empty = spark.createDataFrame([], ROWS)
    assert read_back(render(fold(from_turns(empty)))).count() == 0
    assert formatted(render(fold(spark.createDataFrame([], LOG)))).count() == 0
    for others in ("<<SYS>>",), ("a\\b",), ("<",):
        with pytest.raises(ValueError):
            Template(others=others)
    with pytest.raises(ValueError):
        list(T.turns("no turn"))


def test_text_is_moved_by_message_not_by_conversation(spark):
    """A hot conversation's texts meet in one task only as a stream, in read_back."""
    log = spark.createDataFrame([(1, m, m, "start", "user", None, "x") for m in range(10)], LOG)
    plan = fold(log)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert len(windows) == 1 and "text" not in windows[0]
