"""Operators on small tables with nulls, empty texts, copies and clashing columns, against brute force or the libraries themselves."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from starloom.llm import byte_bpe, language_id, near_dedup, packing, pii, quality_model, quality_rules, topk_search, toxicity, warc
from starloom.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string"


def table(spark, texts, ids=None):
    rows = [(i, t, "en" if k % 2 else None, "s", len(t or ""), 1, "x") for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts, strict=True))]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(2, 7))) for _ in range(n))


ODD = [None, "", " \n\t ", "one two", "ü" * 3000 + " 1.2.3.4", "a b c d e f a b c d e f a b c d e f", prose(1), prose(1), "x\n\nx\nx y z"]


def test_near_duplicates_against_brute_force(spark):
    rng, texts = random.Random(5), list(ODD)
    for seed in range(6):
        words = prose(100 + seed, 80).split()
        texts.append(" ".join(words))
        for _ in range(9):
            copy = list(words)
            for _ in range(rng.randint(1, 5)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(1000))
            texts.append(" ".join(copy))
    sets = [near_dedup.shingles(t) for t in texts]
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(table(spark, texts)).collect()}
    assert got == {i: (len(sets[i]), group[i], group[i] == i) for i in range(len(texts))}


def test_keep_one_with_null_and_repeated_ids(spark):
    docs = table(spark, [prose(1), prose(1), prose(1), prose(2)], [3, 3, None, 9])
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 9, None]
    assert near_dedup.keep_one(docs.limit(0)).count() == 0


def brute_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_clashing_columns(spark):
    docs = table(spark, [*ODD, "# | * " * 20])
    counted = quality_rules.with_counts(docs, "text", "quality").select("text", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines", "quality.n_repeat_words")
    for row in counted.collect():
        assert tuple(row)[1:] == brute_counts(row.text)
    assert quality_rules.filter_documents(docs).columns == docs.columns
    assert quality_rules.filter_documents(docs.limit(0)).count() == 0


def test_symbols_go_and_clean_texts_stay(spark):
    texts = [prose(i) for i in range(150)] + [prose(i).replace(" ", " ### ") for i in range(200, 210)]
    stay = {r.doc_id for r in quality_rules.filter_documents(table(spark, texts)).collect()}
    assert stay == set(range(150))


def base_spans(text):
    t, out = text or "", []
    out += [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


PERSONAL = [
    *ODD, "é 1.2.3.4.5.6.7.8 a@b.c_d@e.f.g x@y", "9" * 50000 + " +1 (988) 555-2485, 4111 1111 1111 1111! 256.1.1.1 007.1.1.255",
    "a.b@" * 500, "日本 +49-30-1234567 or 4111-1111-1111-1112 me@mail.example.com", "@@@ +++ 1..2 +1 2",
]


def test_base_spans_and_redaction(spark):
    from pyspark.sql import functions as F

    docs = table(spark, PERSONAL, [None if i == 3 else i for i in range(len(PERSONAL))])
    found = pii.find(docs)
    for row in found.select("text", pii._listed(F.col("pii.base")).alias("base")).collect():
        assert row.base == base_spans(row.text)
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[len(ODD) + 3] == "日本 <PHONE> or 4111-1111-1111-1112 <EMAIL>" and clean[0] is None and clean[1] == ""
    assert pii.redact(docs).columns == docs.columns


def test_base_spans_of_addresses_with_zero_octets(spark):
    from pyspark.sql import functions as F

    texts = ["at 10.0.0.1 and 127.0.0.1,", "0.0.0.0", "1.00.000.1 192.168.0.1.", "0256.0.0.1 1.2.3.0000256", "1." + "0" * 3000 + ".2.3", "1.2.3." + "0" * 3000 + "256"]
    docs = table(spark, texts)
    for row in pii.find(docs).select("text", pii._listed(F.col("pii.base")).alias("base")).collect():
        assert row.base == base_spans(row.text)
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[0] == "at <IP> and <IP>," and clean[2] == "<IP> <IP>."


def test_loose_personal_data_is_redacted_however_common(spark):
    loose = [(f"reach name{i} (at) host{i} (dot) com", "reach <EMAIL>") for i in range(90)]
    loose += [(f"call 030 12345{i} now", "call <PHONE> now") for i in range(10, 99)] + [("my card 4111.1111.1111.1111", "my card <CARD>")]
    base = [(f"call +49 30 12345{i} or mail a{i}@host.com", "call <PHONE> or mail <EMAIL>") for i in range(10, 90)]
    clear = [(t, t) for t in ("on 2024 05 06 12 30 it", "isbn 978-3-16-148410-0", "we sat (at) home . Then", "order 1234567890", "5 @ 3.50", "4111.1111.1111.1112", "hotel 12 34 56 78")]
    for cases in ([*loose, *base, *clear], [*loose[:2], loose[-1], loose[100], *clear]):
        got = {r.doc_id: r.text for r in pii.redact(table(spark, [t for t, _ in cases])).collect()}
        assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_packing_is_a_gapless_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary())
    t.encode_special_tokens = True
    texts = [*ODD, *(prose(i, 900) for i in range(12)), "é ﬁ \x1c<|endoftext|>don't　x"]
    rows = packing.pack(table(spark, texts), packing.vocabulary()).collect()
    for i, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, packing.END]
        pieces, at = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start), 0
        for p in pieces:
            raw = b"".join(x.to_bytes(4, "little") for x in ids[at : at + p.length])
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(raw))
            at += p.length
        assert at == len(ids)
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY


def test_packing_of_odd_tables(spark):
    rows = [(1, "a b c", 7, "x"), (1, "a b c", 7, "x"), (None, "a b c", 7, "x"), (2, None, 7, "x"), (3, "word " * 30_000, 7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, sequence_id string")
    got = packing.pack(docs, packing.vocabulary()).collect()
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.length
    assert tokens[1] == 2 * 4 and tokens[None] == 4 and tokens[2] == 1 and tokens[3] == 30_001
    assert packing.pack(docs.limit(0), packing.vocabulary()).count() == 0


def test_stages_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    docs = table(spark, [])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_personal_data_of_odd_tables(spark, tmp_path):
    rows = [(1, "mail a@b.com", "x", 1), (1, "mail a@b.com", "x", 1), (None, "mail a@b.com", "x", 1), (2, None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_email int")
    assert sorted((str(r.doc_id), r.text, r.spans, r.n_email) for r in pii.redact(docs).collect()) == sorted(
        (str(i), t and "mail <EMAIL>", s, n) for i, t, s, n in rows
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((str(r.doc_id), r.n_email, r.spans) for r in pii.op7_pii(spark, str(tmp_path)).collect()) == [("1", 1, "email:5:12")] * 2 + [("2", 0, ""), ("None", 1, "email:5:12")]
    assert pii.redact(docs.limit(0)).count() == 0


#: Cases apart from the forms that the trees learn from and are calibrated on: texts with one span to redact, and texts without.
REAL = [
    ("ring me on {} tonight", "PHONE", "0151 23456789"), ("my phone number is {}", "PHONE", "030/1234567"), ("tel. no: {}", "PHONE", "555.867.5309"), ("call us: {}!", "PHONE", "1-800-555-0199"),
    ("reach {} for help", "EMAIL", "jane at example dot com"), ("mobile: {} or later", "PHONE", "0172 345 67 89"), ("Fax {}.", "PHONE", "(0711) 123 456"), ("Phone {} ext", "PHONE", "212 555 0188"),
    ("telefon {} bitte", "PHONE", "040-3344556"), ("handy {}", "PHONE", "0160/98765432"), ("e-mail me: {} please", "EMAIL", "tom.ford (at) web (dot) net"), ("write to {}", "EMAIL", "sales[at]shop[dot]org"),
    ("contact {} now", "EMAIL", "mary @ inbox.com"), ("mail {}", "EMAIL", "k.lee at post dot co dot uk"), ("my visa {} thanks", "CARD", "4111.1111.1111.1111"), ("card: {}", "CARD", "5500/0000/0000/0004"),
    ("please dial {} first", "PHONE", "020 7946 0018"), ("her cell is {}", "PHONE", "415.555.0132"), ("call him at {}", "PHONE", "(650) 555-0111"), ("phone: {}", "PHONE", "06 98 76 54 32"),
]
NOT_PERSONAL = [
    "on 2023-11-05 at 10:30 we met", "it cost 1 299 000 000 in all", "isbn 978-0-306-40615-7 is it", "version 10.2.3 came out", "the score was 3-2 and 4-1", "sold 12 500 of 48 000", "we sat (at) home . Then",
    "from 1998-2004 and 2010-2020", "see page 12/34 and 56/78", "0.30103 and 2.718281828", "order 4500123456 was sent", "room 101 202 303", "looking at the dot on it", "5 @ 2.50 each", "a 4x4 of 1000 1000",
    "4111.1111.1111.1112 is no card", "chapter 12.7.4", "10/12/2021 and 11/12/2021", "no. 20230101", "1,234,567.89 in cash", "at one point dot matrix", "bits 1010 1100 0011", "tax 12-3456789",
    "serial 8842-1193", "the years 1914 1918 1939 1945",
]


def test_loose_personal_data_on_cases_apart(spark):
    cases = [(frame.format(item), frame.format(f"<{kind}>")) for frame, kind, item in REAL] + [(t, t) for t in NOT_PERSONAL]
    got = {r.doc_id: r.text for r in pii.redact(table(spark, [t for t, _ in cases])).collect()}
    missed = [t for i, (t, want) in enumerate(cases[: len(REAL)]) if got[i] != want]
    wrong = [got[i + len(REAL)] for i, t in enumerate(NOT_PERSONAL) if got[i + len(REAL)] != t]
    print("missed", missed, "wrong", wrong)
    assert len(missed) <= 2 and len(wrong) <= 1
    assert not {t for t in missed} & {frame.format(item) for frame, _, item in REAL[:5]}


def test_no_form_and_no_text_is_learned_from_and_held_out():
    halves = [{(text, kind) for h, text, kind, *_ in pii.labelled() if h == half} for half in (0, 1)]
    assert not halves[0] & halves[1] and all(len(h) == sum(1 for x in pii.labelled() if x[0] == i) for i, h in enumerate(halves))
    assert not any(set(pii.FORMS[0][k]) & set(pii.FORMS[1][k]) for k in (0, 2, 3)) and not set(pii.LOOK_ALIKES[0]) & set(pii.LOOK_ALIKES[1])


def test_assignment_fills_sequences():
    rng = random.Random(3)
    lengths = [rng.randint(1, 9000) for _ in range(800)]
    pieces = packing.assign(lengths)
    used = Counter()
    for _, _, n, s, _ in pieces:
        used[s] += n
    assert sum(used.values()) == sum(lengths) and max(used.values()) <= packing.CAPACITY
    assert len(used) * packing.CAPACITY - sum(lengths) < packing.CAPACITY


def test_only_what_fits_nowhere_is_cut():
    rng = random.Random(7)
    mixes = ([min(4096, int(rng.lognormvariate(6, 1)) + 1) for _ in range(1500)], [rng.randint(1, 4095) for _ in range(600)],
             [rng.randint(2500, 4000) if i % 3 == 0 else rng.randint(1, 700) for i in range(900)])
    for lengths in mixes:
        rests, used, costs, want, n = [], [], [], {}, -(-sum(x % 4096 for x in lengths) // 4096)
        used, costs = [0] * n, [0.0] * n
        rests = sorted((-(x % 4096), d, x - x % 4096) for d, x in enumerate(lengths) if x % 4096)
        first = sum(x // 4096 for x in lengths)
        while rests:
            size, d, start = rests.pop(0)
            fits = [i for i in range(n) if 4096 - used[i] >= -size]
            at = min(fits, key=lambda i: (costs[i], i)) if fits else min(range(n), key=lambda i: (used[i], costs[i], i))
            take = min(-size, 4096 - used[at])
            want[d, start] = (take, first + at)
            used[at], costs[at] = used[at] + take, costs[at] + packing.cost(take)
            if take < -size:
                rests = sorted([*rests, (take + size, d, start + take)])
        assert {(d, start): (take, s) for d, start, take, s, _ in packing.assign(lengths) if take < 4096 or (d, start) in want} == want


def test_byte_bpe_equals_the_library(spark):
    import base64

    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab cé\n\t 　\xa0\x1c'st1日😀!.ñ́\r\x00") for _ in range(rng.randrange(25))) for _ in range(200)]
    got = {r.doc_id: r for r in byte_bpe.round_trip(table(spark, texts), path, P.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def counted_phrases(text, source):
    raw, at, count = text.tobytes(), 0, 0
    while at < len(raw):
        end = at + 1
        while end < len(raw) and raw[at : end + 1] in source:
            end += 1
        at, count = end, count + 1
    return count


def test_phrases_against_substring_search():
    model = language_id.fit([("a", "the cat sat on the mat"), ("b", "der hund und die katze")])
    text = language_id._bytes("the hund sat und the dog", model["letters"])
    sources = [language_id._bytes(t, model["letters"]).tobytes() for t in ("the cat sat on the mat", "der hund und die katze")]
    assert language_id.phrases(model, [text])[0].tolist() == [counted_phrases(text, source) for source in sources]


SCRIPTS = {
    "el": "αβγδεζηθικλμνξοπρστυφχψω", "en": "abcdefghijklmnopqrstuvwxyz", "ja": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわを",
    "ko": "".join(chr(0xAC00 + 37 * i) for i in range(200)), "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
}


def written(language, seed, n=40):
    rng = random.Random(f"{language}{seed}")
    return " ".join("".join(rng.choice(SCRIPTS[language]) for _ in range(rng.randint(2, 6))) for _ in range(n))


def test_languages_of_five_scripts():
    model = language_id.fit([(language, written(language, i)) for language in SCRIPTS for i in range(20)])
    for language in SCRIPTS:
        found, scores = language_id.predict(model, [written(language, 1000 + i, 12) for i in range(40)])
        assert found.count(language) == 40 and min(scores) > 0.2


def test_language_query_against_brute_force(spark, tmp_path):
    rng = random.Random(6)
    sources = {"de": "der die das und ist nicht ein eine mit von", "en": "the a and is not one with from of to", "fr": "le la les et est pas un une avec de"}
    texts, langs = [], []
    for i in range(60):
        lang = rng.choice(sorted(sources))
        words = sources[lang].split()
        texts.append(" ".join(rng.choices(words, k=rng.randint(1, 40))).title() + rng.choice(["", "!", " 12,5 "]))
        langs.append(rng.choice([lang, lang, lang, None]))
    texts += [None, "", " 12 ?", "ÿ", "der " * 3000, "x" * 5000, texts[3], texts[3]]
    langs += [None, "en", "en", None, "de", None, langs[3], None]
    ids = [*range(66), 3, None]
    rows = [(i, t, lang, "x", 0.5) for i, t, lang in zip(ids, texts, langs, strict=True)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = language_id.op1_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)

    is_letter = language_id.letters()
    learned = language_id.learn(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    fold = lambda i: zlib.crc32(str(i).encode()) % 3
    taught = {}
    for i, t, lang, *_ in rows:
        if i is not None and lang and t is not None and fold(i) != 1:
            taught.setdefault(lang, {}).setdefault(i, t)
    assert learned["languages"] == sorted(lang for lang, by_id in taught.items() if any(c.isalpha() for t in by_id.values() for c in t))
    # The order of a language's rows is that of a hash, so the learned text is read back from the weights' lengths and compared as a bag.
    for lang, weight in zip(learned["languages"], learned["weights"], strict=True):
        parts = [language_id._bytes(t, is_letter) for t in taught[lang].values()]
        cut = sum(min(len(p), language_id.PER_ROW) for p in parts)
        assert weight == math.log2(min(cut, language_id.MODEL_BYTES) + 1)
    want = {}
    for i, t, *_ in rows:
        text = language_id._bytes(t, is_letter)
        costs = language_id.phrases(learned, [text])[0] * learned["weights"]
        best = min(range(len(costs)), key=lambda k: (costs[k], k))
        second = sorted(costs)[1]
        known = any(c.isalpha() for c in t or "")
        want.setdefault(i, set()).add((fold(i) == 1 if i is not None else False, learned["languages"][best] if known else "und", round(1 - costs[best] / second, 9) if known else 0.0))
    for r in got:
        assert (r.held_out, r.lang_pred, round(r.score, 9)) in want[r.doc_id]
    assert {r.lang_pred for r in got if r.doc_id in (60, 61, 62)} == {"und"}
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language_id.learn(empty) is None and language_id.identify(empty, None).count() == 0


def test_ties_of_languages_go_to_the_first():
    model = language_id.fit([("b", "abc abc"), ("a", "abc abc"), ("c", "xyz")])
    assert language_id.predict(model, ["abc"]) == (["a"], [0.0])
    assert language_id.predict(language_id.fit([("a", "abc")]), ["abc"]) == (["a"], [1.0])
    assert language_id.fit([("a", "123"), ("b", "")]) is None


def test_byte_bpe_of_odd_tables(spark):
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = [(1, "a b", 5, "x"), (1, "a b", 5, "x"), (None, "a b", 5, "x"), (2, None, 5, "x"), (3, "ab " * 100_000, 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids_sha256 string")
    got = byte_bpe.round_trip(docs, path, P.PATTERN).collect()
    assert len(got) == 5 and len({r.ids_sha256 for r in got}) == 3 and byte_bpe.round_trip(docs.limit(0), path, P.PATTERN).count() == 0
    ids = byte_bpe.encode(docs, path, P.PATTERN)
    decoded = byte_bpe.decode(ids, path, P.PATTERN).collect()
    assert sorted((bytes(r.decoded) for r in decoded), key=len) == sorted((t.encode() if t else b"" for _, t, *_ in rows), key=len)


def test_languages_of_odd_texts(spark):
    docs = table(spark, [*ODD, "123 456", "éé"])
    model = language_id.fit([("x", prose(1)), ("y", "éé öö üü" * 20)])
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, len(ODD))] == ["und"] * 4 and got[6].lang_pred == "x" and got[len(ODD) + 1].lang_pred == "y"
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}


def labelled(spark, texts, column):
    return table(spark, [t for t, _ in texts]), spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], f"doc_id long, {column} int")


def test_toxicity_learns_words(spark):
    rng = random.Random(2)
    texts = []
    for i in range(240):
        words = prose(i, 70).split()
        if i % 3 == 0:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["wretched", "loathsome", "vermin", "imbecile"])
        texts.append((" ".join(words), int(i % 3 == 0)))
    docs, labels = labelled(spark, texts, "toxic")
    scores = {r.doc_id: r.score for r in toxicity.with_scores(docs, toxicity.learn(docs, labels)).collect()}
    right = sum((scores[i] >= toxicity.THRESHOLD) == bool(y) for i, (_, y) in enumerate(texts))
    assert right >= 0.95 * len(texts)
    odd = toxicity.with_scores(table(spark, ODD), None)
    assert {r.score for r in odd.collect()} == {0.0} and odd.columns[:-1] == docs.columns


def test_quality_model_learns_structure(spark):
    texts = [(prose(i) if i % 2 else prose(i).upper().replace(" ", "!! "), i % 2) for i in range(200)]
    docs, labels = labelled(spark, texts, "quality")
    scores = {r.doc_id: r.score for r in quality_model.with_scores(docs, quality_model.learn(docs, labels)).collect()}
    assert sum((scores[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(texts)) >= 195
    assert quality_model.with_scores(table(spark, ODD), None).count() == len(ODD)


def odd_documents(spark, path, texts, ids):
    """Documents whose columns are named as results, and labels for each id, as tables of a folder."""
    rows = [(i, t, 9, 0.5, True) for i, t in zip(ids, texts, strict=True)]
    spark.createDataFrame(rows, "doc_id long, text string, predicted int, score double, held_out boolean").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, k % 2, int(k % 3 == 0)) for k, i in enumerate(ids)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_quality_query_against_all_pairs(spark, tmp_path):
    texts = [prose(i) if i % 2 else prose(i).upper().replace(" ", "!! ") for i in range(60)] + ODD + ["a " * 20_000, prose(3), prose(3)]
    ids = [*range(60), *range(60, 60 + len(ODD)), 80, 3, None]
    odd_documents(spark, str(tmp_path), texts, ids)
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    machine = quality_model.learn(docs, labels)
    want = {}
    for i, t in zip(ids, texts, strict=True):
        places, values = quality_model.vector(t, quality_model.buckets())
        raw = machine.w0 + sum(x * machine.w[p] for p, x in zip(places, values, strict=True))
        for a in range(len(places)):
            for b in range(a):
                raw += values[a] * values[b] * sum(p * q for p, q in zip(machine.v[places[a]], machine.v[places[b]], strict=True))
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        want.setdefault(i, []).append((held, round(1 / (1 + math.exp(-max(-30, min(30, raw)))), 6)))
    got = quality_model.op4_quality_model(spark, str(tmp_path)).collect()
    assert len(got) == len(texts) and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    for r in got:
        assert (r.held_out, round(r.score, 6)) in want[r.doc_id] and r.predicted == int(r.score >= 0.7)
    assert quality_model.with_scores(docs.limit(0), machine).count() == 0 and quality_model.learn(docs.limit(0), labels) is None


def plain_toxicity(model, text):
    """Features of a text, window by window, with compressors made anew for each."""
    import zstandard

    def size(content, window):
        raw = zstandard.ZstdCompressionDict(content or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=raw, write_content_size=False).compress(window))

    carrier = b" " + model["ordinary"][len(model["ordinary"]) // 2 :][: toxicity.CARRIER_BYTES] + b" "
    words = [w.encode() for w in re.split("[ \t\n\x0b\f\r]+", (text or "").lower()) if w]
    saved = [size(model["ordinary"], b" " + w + carrier) - size(model["ordinary"] + model["toxic"], b" " + w + carrier) for w in words]
    at_least = [sum(s >= k for s in saved) for k in range(1, toxicity.DEEPEST + 1)]
    n = len(words)
    return [*(math.log1p(c) for c in at_least), *(30 * c / max(n, 20) for c in at_least), *(min(c, 1) for c in at_least), math.log1p(n)]


def test_toxicity_query_against_plain_compression(spark, tmp_path):
    rng, texts = random.Random(12), []
    for i in range(70):
        words = prose(i, 25).split()
        if i % 3 == 0:
            for at in rng.sample(range(25), 8):
                words[at] = rng.choice(["wretched", "loathsome", "vermin", "imbecile"])
        texts.append(" ".join(words))
    texts += [None, "", " \n\t ", "ü " * 50, "Vermin " * 40, texts[3], texts[3]]
    ids = [*range(75), 3, None]
    odd_documents(spark, str(tmp_path), texts, ids)
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    w, mean, spread = model["calibration"]
    want = {}
    for i, t in zip(ids, texts, strict=True):
        x = plain_toxicity(model, t)
        raw = sum((a - m) / s * b for a, m, s, b in zip(x, mean, spread, w[:-1], strict=True)) + w[-1]
        held = i is not None and zlib.crc32(str(i).encode()) % 3 == 1
        want.setdefault(i, []).append((held, round(1 / (1 + math.exp(-max(-30, min(30, raw)))), 6)))
    got = toxicity.op9_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.held_out, round(r.score, 6)) in want[r.doc_id] and r.predicted == int(r.score >= 0.7)
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)
    assert toxicity.reject(docs.limit(0), labels).count() == 0 and toxicity.learn(docs.limit(0), labels) is None
    with pytest.raises(ValueError, match="score"):
        toxicity.with_scores(docs, model)


def test_learned_texts_are_cut_in_the_tasks():
    long = " ".join(f"w{i}" for i in range(200_000))
    assert len(toxicity._bounded(long)) <= toxicity.SAMPLE_BYTES + 8 and toxicity._bounded("a B") == b" a b "


def test_sum_of_squares_identity():
    import numpy as np

    rng = np.random.default_rng(1)
    m = quality_model.Machine(0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    p, x = np.array([1, 4, 7]), np.array([0.5, -2.0, 1.5])
    pairs = sum(x[i] * x[j] * (m.v[p[i]] @ m.v[p[j]]) for i in range(3) for j in range(i))
    assert m.raw(p, x) == pytest.approx(0.3 + x @ m.w[p] + pairs)


def test_warc_round_trip_in_small_ranges(spark):
    html = [None, "", "é" * 700, "é" * 700, "x" * 999, "x" * 999, "<p>" + prose(1, 400), "é" * 700]
    pages = spark.createDataFrame([(None if i == 6 else i, None if i == 1 else f"http://h/{i} ü", h, "z") for i, h in enumerate(html)], "page_id long, url string, html string, size string")
    manifest = warc.write(pages, scratch_path(spark, "warc-test"))
    for size in (50, 1 << 20):
        got = {r.page_id: r for r in warc.read_archives(manifest, size).collect()}
        for i, h in enumerate(html):
            raw = (h or "").encode()
            r = got[None if i == 6 else i]
            assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
            assert (r.record_type, r.refers_to) == (("revisit", 7) if i in (2, 3) else ("response", None))
        assert len(got) == len(html)


def test_warc_ranges_are_read_by_several_tasks(spark):
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(i, None, prose(i, 200)) for i in range(80)], "page_id long, url string, html string").repartition(2)
    manifest = warc.write(pages, scratch_path(spark, "warc-test"))
    n_ranges = sum(-(-r["size"] // 4096) for r in manifest.collect())
    assert n_ranges > 8
    read_by = warc.read_archives(manifest, 4096).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert sum(r["count"] for r in read_by) == 80 and len(read_by) > n_ranges // 4
    assert warc.read_archives(warc.write(pages.limit(0), scratch_path(spark, "warc-test"))).count() == 0


def test_only_a_whole_warc_header_begins_a_record():
    import gzip
    import io

    good = warc.record(1, "http://h", b"payload", None)
    assert warc.header(gzip.decompress(good))["WARC-Type"] == "response"
    for bad in (b"WARC/", b"WARC/1.1\r\nno header", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: y\r\n\r\n", b"HTTP/1.1\r\nWARC-Type: x\r\nContent-Length: 1\r\n\r\n"):
        assert warc.header(bad) is None
    long_url = warc.record(2, "http://h/" + prose(3, 20_000).replace(" ", "/"), b"x", None)
    junk = gzip.compress(b"WARC/ but no record") + b"\x1f\x8b\x08 not gzip"
    raw = junk + good + long_url
    assert [warc.parsed(m)[0] for m in warc.members(io.BytesIO(raw), 0, len(raw), len(raw))] == [1, 2]
    assert [warc.parsed(m)[0] for m in warc.members(io.BytesIO(raw), len(junk) + 1, len(raw), len(raw))] == [2]


def test_search_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 2)
    rng = random.Random(4)
    texts = [None, ""] + [" ".join(rng.choices("ab cd ef gh ij kl mn op qr st".split(), k=rng.randint(1, 30))) for _ in range(90)]
    docs = table(spark, texts).repartition(5)
    indexed = topk_search.index(docs)
    frequencies, total = topk_search.statistics(indexed)
    asked = {0: ["ab", "cd", "ef"], 20: ["st"], 40: ["gh", "nothing", "op", "qr"]}
    queries = spark.createDataFrame([(q, bytearray(t.encode())) for q, ts in asked.items() for t in ts], "query_id long, term binary")
    got = {}
    for r in topk_search.search(indexed, frequencies, total, queries, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    bags = {i: Counter((t or "").split()) for i, t in enumerate(texts) if t}
    mean = sum(b.total() for b in bags.values()) / len(bags)
    for q, ts in asked.items():
        scored = []
        for i, b in bags.items():
            parts = 0
            for t in ts:
                if b[t]:
                    df = sum(t in x for x in bags.values())
                    idf = math.log(1 + (len(bags) - df + 0.5) / (df + 0.5))
                    parts += math.floor(topk_search.UNIT * (idf * (b[t] * 2.2) / (b[t] + 1.2 * (0.25 + 0.75 * b.total() / mean))))
            if parts:
                scored.append((i, parts))
        want = sorted(scored, key=lambda x: (-x[1], x[0]))[:5]
        assert [d for d, _ in got[q]] == [d for d, _ in want]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want], abs=4)


def brute_search(bags, terms, k):
    mean, scored = sum(b.total() for b in bags.values()) / len(bags), []
    df = Counter(t for b in bags.values() for t in b)
    for i, b in bags.items():
        parts = [math.log(1 + (len(bags) - df[t] + 0.5) / (df[t] + 0.5)) * (b[t] * 2.2) / (b[t] + 1.2 * (0.25 + 0.75 * b.total() / mean)) for t in terms if b[t]]
        if parts:
            scored.append((sum(math.floor(topk_search.UNIT * p) for p in parts), i))
    return sorted(scored, key=lambda x: (-x[0], x[1]))[:k]


def test_a_query_asks_with_all_its_words(spark, tmp_path):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(150)]
    texts = [" ".join(rng.choices(words, k=rng.randint(20, 80))) + f" only{i}" for i in range(100)]
    texts[3], texts[7] = None, texts[20].upper()
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in topk_search.op2_topk_search(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.doc_id))
    bags = {i: Counter(t.lower().split()) for i, t in enumerate(texts) if t}
    assert sorted(got) == [0, 20, 40, 60, 80]
    for q, found in got.items():
        want = brute_search(bags, set(bags[q]), topk_search.K)
        assert [d for _, d in found] == [d for _, d in want]
        assert [s for s, _ in found] == pytest.approx([s for s, _ in want], abs=80)


def test_pruned_search_of_a_shard_is_exact(monkeypatch):
    import numpy as np

    for block, frequent, seed in ((1, 8, 1), (2, 1, 2), (5, 30, 3), (64, 8, 4), (3, 1000, 5)):
        monkeypatch.setattr(topk_search, "BLOCK", block)
        monkeypatch.setattr(topk_search, "FREQUENT", frequent)
        rng = random.Random(seed)
        bags = [Counter(rng.choices(range(40), [1 / (t + 1) for t in range(40)], k=rng.randint(1, 30))) for _ in range(150)]
        ids = [7 * (i % 140 if seed == 5 else i) for i in range(150)]  # the last one with repeated ids
        lists = [[(i, b[t]) for i, b in enumerate(bags) if b[t]] for t in range(40)]
        held = [t for t in range(40) if lists[t]]
        idf = np.array([0.0 if t == 0 else rng.random() for t in range(40)])
        sizes, postings = np.array([len(lists[t]) for t in held]), np.array([x for t in held for x in lists[t]])
        lengths = np.array([b.total() for b in bags])
        shard = topk_search.Shard(np.array(ids), lengths, np.array(held), idf[held], sizes, *postings.T, 100, 12.0)
        together = []
        for n in range(60):
            asked = rng.sample(held, rng.randint(1, len(held)))
            score = {}
            for i, b in enumerate(bags):
                if any(b[t] for t in asked):
                    parts = [idf[t] * (b[t] * 2.2) / (b[t] + 1.2 * (1 - 0.75 + 0.75 * b.total() / 12.0)) for t in asked if b[t]]
                    score[ids[i]] = max(score.get(ids[i], 0), sum(math.floor(topk_search.UNIT * p) for p in parts))
            want = sorted(((s, d) for d, s in score.items()), key=lambda x: (-x[0], x[1]))[:10]
            together.append((np.array([*asked, 99]), want[len(want) // 2][0] if n % 2 else 0, want))
        for some in (together, together[:1], [(np.array([99]), 0, []), *together[30:35]]):
            got = shard.best([q for q, _, _ in some], 10, [least for _, least, _ in some])
            for found, (_, least, want) in zip(got, some, strict=True):
                assert [x for x in found if x[0] >= least] == [x for x in want if x[0] >= least]


@pytest.mark.parametrize("few", [0, 1 << 30])
def test_search_scores_only_documents_that_can_reach_the_threshold(monkeypatch, few):
    """One by one, or after a product of matrices in single precision: the exact scores of the same documents, and of few others."""
    import numpy as np

    monkeypatch.setattr(topk_search, "FEW", few)
    monkeypatch.setattr(topk_search, "FREQUENT", 8)
    rng, n = random.Random(9), 2000
    held = [sorted(rng.sample(range(n), n // (2 + t // 4))) for t in range(200)]
    sizes = np.array([len(x) for x in held])
    places, tfs = np.concatenate(held), np.array([rng.randint(1, 4) for _ in range(sizes.sum())])
    idf = np.log(n / sizes)
    shard = topk_search.Shard(np.arange(n), np.full(n, 12), np.arange(200), idf, sizes, places, tfs, 200, 12.0)
    score = np.zeros((200, n))
    score[np.repeat(np.arange(200), sizes), places] = np.floor(topk_search.UNIT * (np.repeat(idf, sizes) * tfs * 2.2 / (tfs + 1.2)))
    scored = []
    monkeypatch.setattr(shard, "_scores", lambda sums, rows, places, of=shard._scores: scored.append(len(places)) or of(sums, rows, places))
    queries = [np.array(rng.sample(range(200), 60)) for _ in range(20)]
    best = [sorted(((int(x), i) for i, x in enumerate(score[q].sum(axis=0))), key=lambda x: (-x[0], x[1]))[:10] for q in queries]
    assert shard.best(queries, 10, [0] * 20) == best
    scored.clear()
    assert shard.best(queries, 10, [found[-1][0] for found in best]) == best
    assert sum(scored) < len(queries) * (12 if few else n / 2)


def test_rows_of_one_id_are_found_once_however_they_are_dealt(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choices("ab cd ef gh ij kl mn op qr st uv wx".split(), k=rng.randint(3, 30))) for _ in range(60)]
    ids = [*range(50), 0, 20, 20, 7, 7, None, None, 33, 0, 40]
    results = []
    for parts in (1, 2, 7):
        path = f"{tmp_path}/{parts}"
        table(spark, texts, ids).repartition(parts).write.parquet(f"{path}/documents.parquet")
        results.append(sorted(tuple(r) for r in topk_search.op2_topk_search(spark, path).select("query_id", "rank", "doc_id", "score").collect()))
    assert results[0] == results[1] == results[2]
    bags = [(i, Counter(t.split())) for i, t in zip(ids, texts, strict=True) if i is not None]
    mean, df = sum(b.total() for _, b in bags) / len(bags), Counter(t for _, b in bags for t in b)
    assert {r[0] for r in results[0]} == {0, 20, 40}
    for q in (0, 20, 40):
        score = {}
        for i, b in bags:
            parts = [math.log(1 + (len(bags) - df[t] + 0.5) / (df[t] + 0.5)) * (b[t] * 2.2) / (b[t] + 1.2 * (0.25 + 0.75 * b.total() / mean))
                     for t in {t for j, x in bags if j == q for t in x} if b[t]]
            if parts:
                score[i] = max(score.get(i, 0), sum(math.floor(topk_search.UNIT * p) for p in parts))
        want = sorted(score.items(), key=lambda x: (-x[1], x[0]))[: topk_search.K]
        assert [r[2] for r in results[0] if r[0] == q] == [i for i, _ in want]
        assert [r[3] for r in results[0] if r[0] == q] == pytest.approx([s for _, s in want], abs=20)


def test_a_document_is_first_for_itself_by_its_own_words(spark, tmp_path):
    own = " ".join(f"own{i}" for i in range(60))
    texts = [f"alpha beta gamma {own}", "alpha beta gamma", "alpha beta gamma alpha beta gamma", "beta", "delta " * 300, "x " + "tf " * 700 + "alpha"]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = topk_search.op2_topk_search(spark, str(tmp_path)).orderBy("rank").collect()
    assert rows[0].doc_id == 0 and {r.doc_id for r in rows} == {0, 1, 2, 3, 5}


def test_search_in_small_shards_and_blocks_of_queries(spark, monkeypatch, tmp_path):
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    table(spark, [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(400)]).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    whole = {tuple(r) for r in topk_search.op2_topk_search(spark, str(tmp_path)).collect()}
    monkeypatch.setattr(topk_search, "POSTINGS", 2000)
    monkeypatch.setattr(topk_search, "TERMS_AT_ONCE", 300)
    assert {tuple(r) for r in topk_search.op2_topk_search(spark, str(tmp_path)).collect()} == whole


def test_search_of_nothing(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/a/documents.parquet")
    table(spark, [None, "", " \n"]).write.parquet(f"{tmp_path}/b/documents.parquet")
    table(spark, ["a b", "b c"], [1, None]).write.parquet(f"{tmp_path}/c/documents.parquet")
    for case in "abc":
        assert topk_search.op2_topk_search(spark, f"{tmp_path}/{case}").count() == 0


def test_pipeline_keeps_the_columns(spark):
    import corpus_pipeline

    from starloom.llm.common import read

    docs = read(spark, "/root/testdata/sf0.001", "documents")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == columns


def test_word_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    with open(packing.vocabulary(), encoding="utf-8") as f:
        source = f.read()
    library, ids_of, r = Tokenizer.from_str(source), packing.word_ids(source), random.Random(5)
    library.encode_special_tokens = True
    letters = "abzABZIJHT'stmlre09.,-!?$%<|>éÉßİıŉſª²½­ \u0085̱́̌̇Kẖ \n\t　\x1c\x00中Σσς\U0001f600"
    strings = ["".join(r.choices(letters, k=r.randint(0, 14))) for _ in range(5000)]
    strings += [f"{a}<|endoftext|>{b}" for a, b in zip(strings[:200], strings[200:400], strict=True)] + ["", "Ab " * 5000, "$" * 20_000]
    for s in strings:
        assert ids_of(s).tolist() == library.encode(s, add_special_tokens=False).ids, repr(s[:40])
    assert len(ids_of(None)) == 0


def plain_quality(texts):
    """The places of the texts that pass, by limits over all rows (fewer than a group's own need)."""
    assert len(texts) < 2 * quality_rules.LEAST_ROWS
    shares, failed = [], []
    for t in texts:
        n, chars, symbols, dup_lines, repeats = brute_counts(t)
        n_lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (t or "").split("\n"))
        failed.append(n < 10 or 100 * repeats > 20 * n)
        shares.append((symbols / max(n, 1), (t or "").count("!") / max(n, 1), dup_lines / max(n_lines, 1), chars / max(n, 1)))
    limits = []
    for values, least in zip(zip(*shares, strict=True), (0.05, 0.05, 0.15, 2.0), strict=True):
        low, high = (sorted(values)[math.ceil(q * len(values)) - 1] for q in (0.25, 0.75))
        limits.append(high + 3 * max(high - low, least))
    return [i for i, (f, s) in enumerate(zip(failed, shares, strict=True)) if not f and all(a <= b for a, b in zip(s, limits, strict=True))]


def plain_dedup(rows):
    """One row of each component of near copies and of each id: the least id; rows without an id only by their text."""
    sets, group = [near_dedup.shingles(t) for _, t in rows], list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if rows[i][0] == rows[j][0] or (a and b and 100 * len(a & b) >= 75 * len(a | b)):
                    group[i] = group[j] = min(group[i], group[j])
    return [rows[min((i for i, g in enumerate(group) if g == root), key=lambda i: rows[i][0])] for root in sorted(set(group))]


def test_pipeline_rows_stage_by_stage(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    import corpus_pipeline

    rng, vile, texts, labels = random.Random(8), ["wretched", "loathsome", "vermin", "imbecile"], [], []
    for i in range(150):
        words = prose(1000 + i, 90).split()
        if i % 3 == 0:
            for at in rng.sample(range(90), 25):
                words[at] = rng.choice(vile)
        texts.append(" ".join(words))
        labels.append((i, 1, int(i % 3 == 0)))
    near = texts[1].split()
    near[40] = "edited"
    texts += [texts[2], " ".join(near), prose(5).replace(" ", " ### "), "too short", "", None, " ".join(["one two three four five six"] * 9)]
    texts += [prose(6) + " mail me@mail.example.com", prose(7) + " from 10.0.0.1 or +49-30-1234567"]
    docs = table(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = {}

    def recording(name, stage):
        def run(spark, docs, sf_dir):
            out = stage(spark, docs, sf_dir)
            seen[name] = out.collect()
            return out

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, recording(name, stage)) for name, stage in corpus_pipeline.STAGES])
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pairs = lambda name: sorted((r.doc_id, r.text) for r in seen[name])

    want = [(i, t) for i, t in enumerate(texts) if not any(w in (t or "") for w in vile)]
    assert pairs("toxicity") == want
    want = [want[i] for i in plain_quality([t for _, t in want])]
    assert pairs("quality rules") == want and len(want) == 104
    want = sorted(plain_dedup(want))
    assert pairs("near duplicates") == want and len(want) == 102
    tags = {"me@mail.example.com": "<EMAIL>", "10.0.0.1": "<IP>", "+49-30-1234567": "<PHONE>"}
    for found, tag in tags.items():
        want = [(i, t.replace(found, tag)) for i, t in want]
    assert pairs("personal data") == want and sum("<" in t for _, t in want) == 2
    tokenizer = Tokenizer.from_file(packing.vocabulary())
    for rows in (seen["packing"], final):
        assert {r.doc_id for r in rows} == {i for i, _ in want}
        for i, t in want:
            ids = [*tokenizer.encode(t, add_special_tokens=False).ids, packing.END]
            at = 0
            for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
                raw = b"".join(x.to_bytes(4, "little") for x in ids[at : at + r.length])
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(raw))
                at += r.length
            assert at == len(ids)


def test_keep_one_takes_one_row_of_an_id_whatever_its_text(spark):
    rows = [(3, prose(1)), (3, prose(2)), (4, prose(3)), (5, prose(3))]
    kept = sorted((r.doc_id, r.text) for r in near_dedup.keep_one(table(spark, [t for _, t in rows], [i for i, _ in rows])).collect())
    assert [i for i, _ in kept] == [3, 4] and kept[0] in rows[:2]


def test_samples_hold_one_row_of_a_repeated_id(spark, monkeypatch):
    texts = [prose(i) for i in range(40)]
    docs = table(spark, texts, [*range(10), *[5] * 30]).fillna("en", ["lang"])
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(10)], "doc_id long, quality int, toxic int")
    got = {}
    monkeypatch.setattr(toxicity, "dictionaries", lambda sample: got.update(toxicity=sample))
    monkeypatch.setattr(language_id, "fit", lambda sample: got.update(language=sample))
    monkeypatch.setattr(quality_model.Machine, "trained", lambda rows, y: got.update(quality=rows))
    toxicity.learn(docs, labels), language_id.learn(docs), quality_model.learn(docs, labels)
    learned = lambda m: sum(zlib.crc32(str(i).encode()) % m.FOLDS != m.HELD_OUT for i in range(10))
    assert [len(got[k]) for k in ("toxicity", "language", "quality")] == [learned(m) for m in (toxicity, language_id, quality_model)]
    assert all(t in map(toxicity._bounded, texts) for t, _ in got["toxicity"])
    known = [quality_model.vector(t, quality_model.buckets()) for t in texts]
    assert all(any(p.tolist() == a.tolist() and x.tolist() == b.tolist() for a, b in known) for p, x in got["quality"])
