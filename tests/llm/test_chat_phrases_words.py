"""Collocations, chat windows and spelling variants."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from samples import prose

from energy_mart.llm import chat_windows, collocations, queries, spelling
from energy_mart.llm.common import settle

LOWER = {k: k + 32 for k in range(65, 91)}


def plain_collocations(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + m])) for m in range(1, 6) for i in range(len(words) - m + 1))
    known = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    inside = {
        (lang, p[i : i + m])
        for (lang, p), v in known.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
        if 100 * v >= 100 * f[lang, p[i : i + m]]
    }
    ranked = collections.defaultdict(list)
    for (lang, p), a in known.items():
        if (lang, p) not in inside:
            parts = [(f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, (left, right) = min((1000 * a * n[lang] // (x * y), k, (x, y)) for k, (x, y) in enumerate(parts))
            ranked[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return [
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in ranked.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    ]


def spoken(seed=3, n=80):
    rng = random.Random(seed)
    few = prose(rng, 12) + ["Straße", "ÉTÉ", "a\x00b", "x y"]
    fixed = [" ".join(rng.choice(few) for _ in range(7)) for _ in range(3)]
    texts = []
    for _ in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(few) for _ in range(rng.randrange(0, 60))]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b"]) for w in words))
    return [(i, t, rng.choice(["en", "en", "de", None])) for i, t in enumerate([*texts, None, "", " \t", ".,;", "lone"])]


@pytest.mark.parametrize("least, top", [(4, 50), (12, 5)])
def test_collocations_match_brute_force(spark, monkeypatch, least, top):
    rows = spoken()
    monkeypatch.setattr(collocations, "SLICE", 64)  # several slices in every text
    got = collocations.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), least, top=top)
    want = plain_collocations([(lang, text) for _, text, lang in rows], least, top)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 8


def test_collocations_of_odd_and_empty_tables(spark, odd, none):
    assert collocations.collocations(none).count() == 0
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert sorted(map(tuple, collocations.collocations(odd, 2).collect())) == sorted(plain_collocations(rows, 2, 2000))


def test_collocation_scores_beyond_64_bits(spark):
    big = 4 * 10**15
    df = spark.createDataFrame([(big, 3 * big, big - 1, big - 7)], "a long, n long, l long, r long")
    found = df.selectExpr(
        "(CAST(1000 * a AS DECIMAL(20,0)) * CAST(n AS DECIMAL(18,0))) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))) AS s"
    )
    assert found.first().s == 1000 * big * 3 * big // ((big - 1) * (big - 7))


def test_slices_end_between_pieces():
    text = ("Aa bb, cc\n" * 50 + "x" * 300 + " y. " + "Z").encode()
    collocations_slices = list(collocations.slices(text))
    assert b"".join(collocations_slices) == text.translate(collocations._PLAIN)


# ---- chat windows --------------------------------------------------------------------------

def chats(seed=5):
    rng = random.Random(seed)
    rows = []
    for conv in range(40):
        n = rng.choice([0, 1, 2, 5, 9, 40])
        roles = ["system"] * rng.randrange(2) + [rng.choice(["user", "assistant", "user", "system"]) for _ in range(n)]
        for turn, role in enumerate(roles):
            words = prose(rng, rng.choice([0, 1, 10, 40])) + rng.choice([[], ["</turn>"], ["<turn assistant>"], ["\\1\\"], ["é😀>"]])
            rows.append((conv, turn, role, " ".join(words)))
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (90, None, None, None), (90, 1, "assistant", "same"), (90, 1, "assistant", "same"), (91, 0, "a>\n<\\", "x")]
    rng.shuffle(rows)
    return rows


def in_order(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        text = text or ""
        out[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest(), text))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in out.items()}


def plain_windows(turns, block, budget, history):
    """Formatted windows (text, turns, repeats, learnt) of one conversation by a plain loop."""
    mask = lambda s: s.replace("\\", "\\0").replace("<", "\\1").replace(">", "\\2")
    line = lambda t: f"<turn {mask(t[0])}>{mask(t[1])}</turn>\n"
    size = lambda t: len(re.findall(r"[^\W_]{1,6}|[^\x20\x09-\x0D]", line(t)))
    lead = turns[:1] if turns and turns[0][0] == "system" else []
    room = budget - history - sum(map(size, lead))
    found, start, used = [], len(lead), 0
    for i in range(len(lead), len(turns)):
        new_block = i % block == 0 and i > start
        if i > start and (new_block or used + size(turns[i]) > room):
            found.append((start, i))
            start, used = i, 0
        used += size(turns[i])
    found.append((start, len(turns)))
    out = []
    for k, (a, b) in enumerate(found):
        back, left = [], history
        for t in reversed(turns[max(len(lead), a - chat_windows.HISTORY_TURNS) : a]):
            if size(t) > left:
                break
            left -= size(t)
            back.insert(0, t)
        again = ([] if k == 0 else lead) + back
        fresh = (lead if k == 0 else []) + turns[a:b]
        out.append(("".join(map(line, again + fresh)), len(again + fresh), len(again), [t[1] for t in fresh if t[0] == "assistant"]))
    return out


@pytest.mark.parametrize("block, budget", [(1024, 1024), (8, 160), (5, 90)])
def test_windows_match_a_plain_loop(spark, monkeypatch, block, budget):
    for name, value in (("BLOCK", block), ("BUDGET", budget), ("HISTORY", budget // 4)):
        monkeypatch.setattr(chat_windows, name, value)
    rows = chats()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, block string")
    made = settle(chat_windows.windows(df.repartition(3)))
    got = collections.defaultdict(list)
    back = {(r.conv_id, r.block, r.window): r for r in chat_windows.read_back(made).collect()}
    for r in sorted(made.collect(), key=lambda r: (r.block, r.window)):
        read = back[r.conv_id, r.block, r.window]
        got[r.conv_id].append((r.text, r.n_turns, r.n_repeated, list(read.learnt)))
    want = in_order(rows)
    assert got == {c: plain_windows(t, block, budget, budget // 4) for c, t in want.items()}
    said = collections.defaultdict(list)
    for key in sorted(back, key=lambda k: (str(k[0]), k[1], k[2])):
        said[key[0]] += [(t.role, t.text) for t in back[key].turns]
    assert said == want
    digests = {r.conv_id: r for r in chat_windows.digest(made).collect()}
    for conv, turns in want.items():
        learnt = "".join(x for role, x in turns if role == "assistant")
        whole = "".join(f"{role}\n{x}\n" for role, x in turns)
        r = digests[conv]
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(turns), len(learnt), sum(len(w[0]) for w in got[conv]))
        assert (r.turns_sha256, r.loss_sha256) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (whole, learnt))


def test_windows_of_an_empty_table_and_their_budget(spark):
    df = spark.createDataFrame(chats(7), "conv_id long, turn long, role string, text string")
    assert chat_windows.windows(df.limit(0)).count() == 0 and chat_windows.digest(chat_windows.windows(df.limit(0))).count() == 0
    assert chat_windows.windows(df).filter(f"n_tokens > {chat_windows.BUDGET}").count() == 0


# ---- spelling ------------------------------------------------------------------------------

def plain_variants(n):
    letters = sorted({c for w in n for c in w})

    def near(w):
        out = {w[:i] + c + w[i + k :] for i in range(len(w) + 1) for c in letters for k in (0, 1)}
        return ((out | {w[:i] + w[i + 1 :] for i in range(len(w))}) - {w}) & n.keys()

    found = {w: near(w) for w in n}
    best = {w: min(((-n[x], x) for x in xs), default=(0, None))[1] for w, xs in found.items()}
    form = {w: b if b is not None and n[b] >= 5 * n[w] else None for w, b in best.items()}
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (w, form[w], root, n[w], len(found[w]), None if form[w] is None else n[form[w]])
    return out


def misspelt(seed=4):
    rng = random.Random(seed)
    letters = "abcdeé×ÿ"
    bases = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 6, 7, 8, 12, 70]))) for _ in range(60)]
    words = set(bases)
    for w in bases:
        for _ in range(rng.randrange(1, 9)):
            i, c = rng.randrange(len(w) + 1), rng.choice(letters)
            w = rng.choice([w[:i] + c + w[i:], w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :]])
            if len(w) >= 6:
                words.add(w)
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "abaaaa", "aaaaab", "zzzzzz"}
    return {w: rng.choice([5, 6, 25, 30, 125, 125, 700]) for w in words}


@pytest.mark.parametrize("block", [8192, 40, 7])
def test_variants_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "TOGETHER", 5)
    counts = misspelt()
    counted = settle(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3))
    got = {r.word: tuple(r) for r in spelling.variants(counted).collect()}
    want = plain_variants(counts)
    assert got == want
    assert any(w[1] and w[1] != w[2] for w in want.values()) and max(w[4] for w in want.values()) > 2


def test_vocabulary_matches_a_plain_count(spark, monkeypatch, odd, none):
    monkeypatch.setattr(spelling, "HELD", 20)
    rng = random.Random(2)
    words = [*prose(rng, 40), "Éclair", "naïveté", "ÀÉÎõü", "abcde", "x" * 900]
    rows = [(rng.choice([None, i]), None if i % 19 == 0 else "".join(rng.choice(words) + rng.choice([" ", "-", "1", "ŁA", "\n"]) for _ in range(90))) for i in range(90)]
    want = collections.Counter()
    shorter = 0
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
                shorter += 1
            want[run] += 1
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int").repartition(3)
    got = {r.word: r.n for r in spelling.vocabulary(df).collect()}
    assert got == {w: n for w, n in want.items() if n >= 5 and len(w) >= 6} and shorter > 5
    assert spelling.variants(settle(spelling.vocabulary(none))).count() == 0
    # "epsilon" stands in three rows.
    assert spelling.vocabulary(odd).count() == 0 and spelling.vocabulary(odd, 3).count() == 1


@pytest.mark.parametrize("name", ["op11_collocations", "op12_chat_windows", "op13_spelling_variants"])
def test_registered(name):
    assert getattr(queries, name).__name__ == name
