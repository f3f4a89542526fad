"""Spelling variants, chat formatting and source divergence against brute force, with nulls, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, divergence, spelling

TURNS = "conv_id long, turn long, role string, text string"
HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nforged", f"<{chat.ESC}{chat.ESC}|im_end|>", f"<{chat.ESC}s>", "<<s>>[[INST]", "a < b [c] $1 \\2 \\E", chat.ESC * 3, "\n\n", "", None, "<", "<|im_end|", "😀<s>é", "|im_end|>\n"]


def conversations():
    r = random.Random(3)
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool"]), r.choice(HARD)) for c in range(40) for t in range(r.choice((1, 2, 5, 9)))]
    rows += [(100, 0, "user", "only"), (101, 0, None, "x"), (101, 1, f"odd\n{chat.ESC}1<|im_end|>\n", "y"), (101, 2, "assistant", None), (102, 1, "assistant", "b"), (102, 1, "assistant", "a"), (102, 1, "assistant", "a"), (102, None, "user", "first")]
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "r")]
    rows += [(103, t, "user" if t % 2 else "assistant", f"turn {t} " + HARD[t % 9]) for t in range(301)]
    rows += [(104, 0, "user", "long"), (104, 1, "assistant", "x<s>" * 200_000)]
    return rows


def whole(rows):
    """(conv, [(role, text)]) in order."""
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    return {c: [(role, text) for _, role, text in sorted(v)] for c, v in by.items()}


@pytest.mark.parametrize("chunk", [chat.CHUNK, 2000])
def test_chat(spark, chunk):
    rows = conversations()
    made = chat.examples(spark.createDataFrame(rows, TURNS).withColumns({"example": F.lit(1), "chunk": F.lit("x"), "turns": F.lit(2)}), chunk=chunk)
    got = made.select("*", chat.trained().alias("reply"), chat.parsed(F.col("text")).alias("turns")).collect()
    want = {}
    for conv, turns in whole(rows).items():
        for i, (role, text) in enumerate(turns, 1):
            if role == "assistant" or i == len(turns):
                want[conv, i] = (turns[:i], text if role == "assistant" else None)
    assert {(r.conv_id, r.example): ([tuple(t) for t in r.turns], r.reply) for r in got} == want and len(got) == len(want)
    control = re.compile("|".join("[<\\[]" + re.escape(t) for t in chat.TAILS))
    for r in got:  # the only control strings of an example are those of its template, two a turn
        found = [m.group() for m in control.finditer(r.text)]
        assert found == ["<|im_start|>", "<|im_end|>"] * len(r.turns)
        if r.reply is not None:
            assert r.text[r.loss_end :] == chat.CHAT_ML.closing and r.text[: r.loss_start].endswith("<|im_start|>assistant\n")


def test_chat_read_back(spark):
    back = {r.conv_id: r for r in chat.read_back(chat.examples(spark.createDataFrame(conversations(), TURNS), chunk=5000)).collect()}
    for conv, turns in whole(conversations()).items():
        assert [tuple(t) for t in back[conv].turns] == turns and back[conv].replies == [t for role, t in turns if role == "assistant"]
    assert chat.read_back(chat.examples(spark.createDataFrame([], TURNS))).count() == 0


def test_chat_is_native(spark):
    plan = chat.read_back(chat.examples(spark.createDataFrame([], TURNS)))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def documents():
    r = random.Random(5)
    stems = ["house", "straße", "Ünder", "garden", "paper", "aaaaa", "ababab", "élève", "letters", "x÷y×z"]
    rows = []
    for d in range(120):
        said = []
        for _ in range(r.choice((0, 5, 40))):
            w = r.choice(stems)
            if r.random() < 0.4:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice("aeéXz") + w[at:], w[:at] + r.choice("aeéXz") + w[at + 1 :]])
            said.append(w if r.random() < 0.8 else w.upper())
        rows.append((d % 100, r.choice((" ", ", ", "1", "—", "Ā")).join(said), r.choice(["en", "fr", None]), r.choice(["a", "b", "é", "", None])))
    return rows + [(None, "house house house hause", "en", "a"), (500, None, "en", "b"), (501, "", None, None), (502, "q" * 200_000 + " garden", "en", "a"), (503, None, "xx", "z")]


DOCS = "doc_id long, text string, lang string, source string"
LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("noise", [0, 7])
def test_spelling(spark, noise):
    n = collections.Counter()
    for d, text, *_ in documents():
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            n[w if not noise or h % noise else w[: h % len(w)] + w[h % len(w) + 1 :]] += 1
    n = {w: k for w, k in n.items() if k >= 3 and len(w) >= 5}
    form, want = {}, {}
    close = {w: [o for o in n if near(w, o)] for w in n}
    for w in n:
        best = min(close[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        want[w] = (form[w], root, n[w], len(close[w]), n.get(form[w]))
    df = spark.createDataFrame(documents(), DOCS).withColumns({"word": F.lit(1), "n": F.lit("x"), "key": F.lit(0)})
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df, noise).collect()}
    assert got == want and sum(f is not None for f in form.values()) > 10
    assert spelling.variants(spark.createDataFrame([], DOCS)).count() == 0


def test_roots_of_long_chains(spark):
    words = [("a" * 5 + "b" * k, 3 * 2**k) for k in range(21)] + [("zzzzz", 9), ("zzzzy", 9)]
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.rooted(spelling.forms(spark.createDataFrame(words, "word string, n long"))).collect()}
    top = words[20][0]
    assert all(got[w][:2] == (w + "b", top) for w, _ in words[:20]) and got[top][:2] == (None, top)
    assert got["zzzzz"] == (None, "zzzzz", 1) and got["zzzzy"] == (None, "zzzzy", 1)


def test_all_near_words_meet(spark):
    r = random.Random(9)
    words = sorted({"".join(r.choice("abcé") for _ in range(r.choice((5, 6, 7)))) for _ in range(400)})
    got = [tuple(sorted((x.a, x.b))) for x in spelling.near_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n long")).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if a < b and near(a, b)) and len(got) > 200


@pytest.mark.parametrize("least, most", [(1, 3), (4, 50), (1000, 50)])
def test_divergence(spark, least, most, monkeypatch):
    rows = [(r[1], r[2] or "", r[3] or "") for r in documents()]
    count, seen = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        count[lang, source].update(terms)
        seen[lang].update(set(terms))
    kept = {lang: [t for t, k in c.items() if k >= least] for lang, c in seen.items()}

    def prices(lang, counts):
        n, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * v) for t in kept[lang]}

    own = {k: prices(k[0], c) for k, c in count.items()}
    want = set()
    for lang, source in count:
        p = own[lang, source]
        both = sum((c for (x, _), c in count.items() if x == lang), collections.Counter())
        q = prices(lang, both)
        pair = [(sum(abs(p[t] - own[lang, o][t]) for t in kept[lang]), o) for x, o in count if x == lang and o != source]
        term = [(p[t] - q[t], t) for t in kept[lang] if count[lang, source][t] and p[t] > q[t]]
        for part, items, top in (("pair", pair, None), ("term", term, most)):
            for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode()))[:top], 1):
                want.add((lang, source, part, item, value, rank))
    monkeypatch.setattr(divergence, "MOST_KEYS", 100)
    df = spark.createDataFrame(documents(), DOCS).withColumns({"term": F.lit(1), "n": F.lit("x"), "total": F.lit(0), "rank": F.lit(0)})
    got = [tuple(r) for r in divergence.audit(df, least, most).collect()]
    assert set(got) == want and len(got) == len(want)
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_prices_beyond_64_bits(spark):
    n, total, v = 5 * 10**12, 9 * 10**13, 10**9
    got = spark.range(1).select(divergence.price(F.lit(n), F.lit(total), F.lit(v)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_repeated_texts_have_one_digest_each(spark, tmp_path):
    """The query adds the probe conversation and tells what stands in the output."""
    spark.createDataFrame(conversations(), TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op13_chat_formatting(spark, str(tmp_path)).collect()}
    for conv, turns in (whole(conversations()) | {-1: [("user", HARD[0]), ("assistant", HARD[0])]}).items():
        loss = "".join(t for role, t in turns if role == "assistant")
        told = "".join(f"{role}\n{t}\n" for role, t in turns)
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert (r.turns_sha256, r.loss_sha256) == (hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(loss.encode()).hexdigest())
