"""N-gram join, source mix, packing, toxicity, nearest vectors, URL graph and the pipeline."""

import math
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from samples import prose

import corpus_pipeline
from energy_mart.llm import cross_polytope, ngram_join, packing, quality_rules, source_mix, toxicity, url_graph
from energy_mart.llm.common import components, id_bitmap, in_bitmap, settle

LOWER = {k: k + 32 for k in range(65, 91)}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def shingle_set(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))}


def linked_groups(texts, percent=85):
    """Index -> smallest index reachable."""
    sets, root = [shingle_set(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def test_ngram_groups_match_brute_force(docs, rows):
    want, sizes = linked_groups([r[1] for r in rows])
    got = {r.doc_id: r for r in ngram_join.groups(docs).collect()}
    assert [(got[i].n_shingles, got[i].component_id) for i in range(len(rows))] == list(zip(sizes, want))
    assert len(set(want)) < len(want) - 10
    kept = {r.doc_id for r in ngram_join.one_of_each(docs).collect()}
    assert kept == set(want)


def near_copies(seed=8):
    """Chains and groups whose links lie on both sides of the limit, and a passage that many share."""
    rng = random.Random(seed)
    passage, texts = prose(rng, 40), []
    for _ in range(12):
        base = prose(rng, rng.randrange(30, 120))
        current = base
        for _ in range(rng.randrange(1, 12)):
            current = list(current if rng.random() < 0.6 else base)
            for _ in range(rng.randrange(1, 3)):
                current[rng.randrange(len(current))] = prose(rng, 1)[0]
            if rng.random() < 0.3:
                current += prose(rng, rng.randrange(1, 5))
            texts.append(" ".join(current))
    texts += [" ".join(prose(rng, 50) + passage + prose(rng, 50)) for _ in range(40)]
    texts += [" ".join(passage + prose(rng, k % 9)) for k in range(40)]
    rng.shuffle(texts)
    return texts


def test_ngram_groups_at_the_limit(spark):
    texts = near_copies()
    want, _ = linked_groups(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.groups(df).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_ngram_odd_rows(odd, none):
    assert ngram_join.groups(none).count() == 0
    got = sorted(map(tuple, ngram_join.groups(odd).collect()), key=repr)
    assert got == sorted([(5, 2, 5)] * 2 + [(None, 0, None), (None, 2, 5), (7, 0, 7), (5, 1, 5)], key=repr)
    kept = ngram_join.one_of_each(odd)
    # Of the three equal texts one stays, whatever their ids; texts without words all stay.
    assert kept.columns == odd.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(5, "alpha beta gamma delta epsilon"), (None, None), (7, ""), (5, "zeta eta")], key=repr
    )
    assert ngram_join.one_of_each(none).count() == 0


def test_one_row_of_copies_without_ids(spark):
    text = " ".join(prose(random.Random(1), 30))
    rows = [(None, text)] * 4 + [(9, text), (9, text), (3, "other words here now")]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 9]


def test_components_and_bitmap(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (200, 201)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, components(df, "a", "b").collect()))
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert components(df.limit(0), "a", "b").count() == 0
    ids = spark.range(0, 3000, 3).withColumnRenamed("id", "doc_id")
    found = spark.range(3000).withColumnRenamed("id", "doc_id").filter(in_bitmap(spark, id_bitmap(ids, "doc_id"), "doc_id"))
    found = {r.doc_id for r in found.collect()}
    assert set(range(0, 3000, 3)) <= found and len(found) < 1100


def words_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_meets_targets(docs, rows):
    got = {r.doc_id: r for r in source_mix.taken_words(docs).collect()}
    sizes = defaultdict(int)
    for i, text, _, source, _ in rows:
        assert got[i].size == words_of(text)
        sizes[source] += got[i].size
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = dict(zip(names, source_mix.targets(np.array([sizes[n] for n in names]), np.array([5.0, 2.0, 1.0]))))
    taken = defaultdict(int)
    for i, _, _, source, _ in rows:
        assert got[i].target == pytest.approx(want[source]) and got[i].source_size == sizes[source]
        assert 0 <= got[i].taken <= 3 * got[i].size
        taken[source] += got[i].taken
    for name in names:
        assert abs(taken[name] - want[name]) <= 3 * source_mix.BLOCK_WORDS
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    again = {r.doc_id: r.taken for r in source_mix.taken_words(docs).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_mixed_texts_hold_the_words_taken(docs):
    taken = {r.doc_id: r.taken for r in source_mix.taken_words(docs).collect()}
    out = source_mix.mix(docs)
    assert out.columns == docs.columns
    found = defaultdict(int)
    for r in out.collect():
        found[r.doc_id] += words_of(r.text)
    assert dict(found) == {i: n for i, n in taken.items() if n}


def test_targets_stop_at_three_times_and_share_the_rest():
    got = source_mix.targets(np.array([10, 1000, 100, 0]), np.array([5.0, 2.0, 1.0, 5.0]))
    assert got.tolist() == pytest.approx([30, 1110 - 30 - 300, 300, 0]) or got.sum() == pytest.approx(1110)
    assert (got <= 3 * np.array([10, 1000, 100, 0])).all() and got[0] == 30


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations_are_permutations(n):
    one, other = (source_mix._permuted(np.arange(n), n, k) for k in (1, 2))
    assert sorted(one.tolist()) == list(range(n)) == sorted(other.tolist())
    assert n < 64 or (one != other).any()


def test_mix_odd_rows(odd, none):
    assert source_mix.taken_words(none).count() == 0 and source_mix.mix(none).count() == 0
    got = source_mix.taken_words(odd)
    assert got.count() == 6 and got.filter("taken > 3 * size OR taken IS NULL").count() == 0
    assert source_mix.mix(odd).columns == odd.columns


def check_pieces(pieces, texts, window=2048):
    """Every id once, checksums right, sequences gapless and within the window."""
    encoder = packing._tokenizer(TOKENIZER)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= window
    return 1 - sum(p.length for p in pieces) / window / len(by_sequence)


def test_packing_round_trip(docs, rows):
    texts = {i: t for i, t, *_ in rows}
    pieces = packing.pack(docs, TOKENIZER).collect()
    assert check_pieces(pieces, texts) < 0.15
    small = packing.pack(docs, TOKENIZER, 64).collect()
    assert check_pieces(small, texts, 64) < 0.2


def test_encoder_gives_the_tokenizers_ids(rows, monkeypatch):
    plain = packing._tokenizer(TOKENIZER)
    texts = [
        "", " ", None, "It's a\ttest", "a\u0301 \u0301b", "x<|endoftext|>y <|startoftext|>", "ÀÉ  ẞ İ\n\nΣΑΣ", "don't 'S 12345 §§!!",
        "a\u00a0b\u2003c\x1cd\x0be\x85f\u3000g", "a\x1f \x1d", "Word. word, WORD., .word ..., ªº µ. Éa,.", "loweischäft ñÿ. x'll", "a.b,c 1.5,2 x.,y a._ _.b end...", "it's. 'Tis, we'RE.", "ÀÖ<|ENDOFTEXT|>", "½. ²,³ a²b,", "·.a", *(r[1] for r in rows),
        "theaes,%%% A.** b!!. ²,,³ x--Y..z «É»,,.", "it''s ,, 'S!! don't..", "a__b,, 12,,34 µ!ª",
    ]
    rng = random.Random(3)
    texts += ["".join(rng.choice("abÉß12²½.,!%'-_ \n\u00a0\u0085") for _ in range(60)) for _ in range(200)]
    texts += ["".join(rng.choice("aÉ1.,!% ") for _ in range(60)) for _ in range(200)]
    want = [[*plain.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    made = packing.Encoder(TOKENIZER)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in made.texts(texts)] == want
    monkeypatch.setattr(packing, "KNOWN_WORDS", 20)
    small = packing.Encoder(TOKENIZER)
    assert [np.frombuffer(x, "<u4").tolist() for t in texts for x in small.texts([t])] == want
    assert len(small.known) <= 20


@pytest.mark.parametrize("words", [lambda rng: 16, lambda rng: rng.randrange(20, 46)])
def test_short_documents_leave_little_padding(spark, words):
    rng = random.Random(4)
    texts = {i: " ".join(rng.choice(["the", "of", "and", "a"]) for _ in range(words(rng))) for i in range(5000)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert check_pieces(packing.pack(df, TOKENIZER).collect(), texts) < 0.02


def test_patterns_take_most_short_rests():
    histogram = np.zeros(2048, np.int64)
    histogram[20:46] = np.arange(3000, 400, -100)
    chosen = packing.patterns(histogram)
    whole = packing.repeats(histogram, chosen)
    used = sum(np.bincount(p, minlength=2048) * n for p, n in zip(chosen, whole))
    assert (used <= histogram).all() and used.sum() > 0.6 * histogram.sum()


def test_least_squares_counts_fit_the_histogram():
    rng = np.random.default_rng(2)
    histogram = np.zeros(256, np.int64)
    for a in rng.integers(1, 255, 400):
        histogram[a] += 1
        histogram[256 - a] += 1
    chosen = packing.patterns(histogram)
    whole = packing.repeats(histogram, chosen)
    used = np.zeros(256, np.int64)
    for pattern, times in zip(chosen, whole):
        assert 240 < sum(pattern) <= 256
        for n in pattern:
            used[n] += times
    assert (used <= histogram).all() and used.sum() > 0.5 * histogram.sum()


def test_checksums_join():
    data = bytes(range(256)) * 2
    parts = [data[i : i + 64] for i in range(0, 512, 64)]
    assert packing.join_checksums([zlib.crc32(p) for p in parts], [16] * 8) == zlib.crc32(data)
    assert packing.join_checksums([zlib.crc32(data[:12]), zlib.crc32(data[12:16])], [3, 1]) == zlib.crc32(data[:16])


def test_packing_odd_rows(odd, none):
    assert packing.pack(none, TOKENIZER).count() == 0
    pieces = packing.pack(odd, TOKENIZER)
    assert pieces.count() == 6 and pieces.agg(F.countDistinct("sequence_id")).first()[0] == 1


def toxic_rows(n=900, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng, rng.randrange(20, 80))
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["scumbag", "IDIOT!", "moron."])
        rows.append((i, " ".join(words)))
        if i % 3 != 1:
            labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame([*rows, (None, None), (5000, ""), (5000, "idiot moron")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    out = toxicity.score(docs, marks).collect()
    assert len(out) == 903 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    right = sum(r.predicted == (r.doc_id % 6 == 0) for r in held)
    assert right >= 0.97 * len(held)


def test_toxicity_learns_nothing_from_held_out_rows(spark):
    rows, labels = toxic_rows(300)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    models = []
    for turned in (False, True):
        marks = spark.createDataFrame([(i, 1 - t if turned and held(i) else t) for i, t in labels], "doc_id long, toxic int")
        models.append(toxicity.train(docs, marks))
    assert (models[0][0] == models[1][0]).all() and models[0][1] == models[1][1]


def test_toxicity_without_positives(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(none, labels).count() == 0
    assert {r.score for r in toxicity.score(odd, labels).collect()} == {0.0}


def vectors(spark, tmp_path, n=1200, dims=24):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(n, dims)).astype(np.float32)
    base[300:500] = base[300]  # many copies
    base[500:560] *= 7
    rows = [(i, v.tolist(), 1) for i, v in enumerate(base)]
    path = str(tmp_path / "v")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(path)
    return base, spark.read.parquet(path)


def test_nearest_vectors(spark, tmp_path):
    base, df = vectors(spark, tmp_path)
    rows = cross_polytope.usable(df)
    got = defaultdict(list)
    for r in cross_polytope.nearest(rows, rows.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score, r.rank))
    hits, base = 0, base.astype(float)
    for q in range(0, len(base), 100):
        far = np.sqrt(((base - base[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        best = np.lexsort((np.arange(len(base)), far))[:10]
        assert [r for *_, r in got[q]] == list(range(1, 11))
        assert all(s == pytest.approx(far[v]) for v, s, _ in got[q])
        assert [(s, v) for v, s, _ in got[q]] == sorted((s, v) for v, s, _ in got[q])
        hits += len(set(best.tolist()) & {v for v, *_ in got[q]})
    assert hits >= 0.9 * 10 * len(got) and len(got) == 12
    assert [v for v, *_ in got[300]] == list(range(301, 311)) and [v for v, *_ in got[400]] == list(range(300, 310))


def test_few_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [-3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    use = cross_polytope.usable(df)
    got = cross_polytope.nearest(use, use.filter("vec_id = 0")).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 9)]
    assert got[0].score == pytest.approx(math.sqrt(5)) and got[1].score == 4.0
    assert cross_polytope.nearest(use.limit(0), use.limit(0)).count() == 0


def test_rotation_keeps_lengths_and_angles():
    x = np.random.default_rng(1).normal(size=(20, 24))
    turned = cross_polytope.rotate(x, 3)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert turned.shape == (20, 32) and np.allclose(turned @ turned.T, unit @ unit.T)


PAGES = [
    (0, "http://a.com/x", None), (1, "https://www.example.com/en/1", ""), (2, "http://blog.Example.com/en/", ""), (3, "http://q.net/es/1", '<a href="http://bad.org/z">'),
    (4, "http://bad.org/", '<a href="https://w.net/fr/2">x</a>'), (5, None, None), (6, "no scheme", ""), (7, "http://good.org/?x", ""), (8, "http://a.com/y", "<a href='//GOOD.org/p'>"),
    (9, "x://example.com", ""), (10, "http://worse.org/#f", '<a href="http://bad.org">'), (11, "http://w.net/fr/2", ""), (11, "http://w.net/fr/2", ""),
]


def test_url_rules_and_graph(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r.page_id: tuple(r)[1:] for r in url_graph.judge(df).collect()}
    assert url_graph.judge(df).count() == len(PAGES)
    assert got[0] == ("a.com", "/x", "com/", "allow") and got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[2] == ("blog.example.com", "/en/", "example.com/en/", "block") and got[3][2:] == ("net/es/", "block")
    assert got[4] == ("bad.org", "/", None, "block")  # links to a blocked host
    assert got[10] == ("worse.org", "/", None, "block") and got[7] == ("good.org", "/", None, "allow")
    assert got[5] == got[6] == ("", "", None, "allow") and got[9] == ("example.com", "", None, got[9][3])
    assert url_graph.judge(df.limit(0)).count() == 0


def test_distrust_climbs_through_domains_without_pages(spark):
    pages = [(0, "http://blog.x.example.net/es/1", ""), (1, "http://a.shop.example.net/", ""), (2, "http://other.org/", '<a href="//deep.y.example.net/">')]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_graph.judge(df).collect()} == {0: "block", 1: "block", 2: "block"}
    edges = {tuple(r) for r in url_graph.host_edges(df.select(url_graph.host_and_path(F.col("url"))[0].alias("host"), "html")).collect()}
    chain = [("blog.x.example.net", "x.example.net"), ("x.example.net", "example.net"), ("deep.y.example.net", "y.example.net"), ("y.example.net", "example.net")]
    assert all(e in edges and e[::-1] in edges for e in chain) and not any("net" in e for e in edges)


@pytest.mark.parametrize("offset", [0.0, 1e8])
def test_nearest_breaks_ties_by_id_and_survives_offsets(spark, offset):
    rng = np.random.default_rng(8)
    axes = np.eye(64)
    rows = [(i, (offset + v).tolist()) for i, v in enumerate([*axes, *-axes, *rng.normal(size=(60, 64)), np.full(64, 0.5)])]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (501, rows[3][1])]
    df = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], "vec_id long, embedding array<double>, bucket int, ids string, score double")
    usable = cross_polytope.usable(df)
    got = defaultdict(list)
    # Every bucket of a table is probed, so the answer must be exact.
    for r in cross_polytope.nearest(usable, usable.filter("vec_id IN (3, 188, 501)"), 1, 1 << 20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    have = {i: np.array(v) for i, v in rows}
    for q in (3, 188, 501):
        want = sorted((float(np.sqrt(((v - have[q]) ** 2).sum())), i) for i, v in have.items() if i != q)[:10]
        assert got[q] == want
    assert [i for _, i in got[188]] != sorted(range(100, 110))


def test_ranks_match_power_iteration(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c")]
    seeds = [("a", 1.0, 0.0), ("d", 0.5, 1.0)]
    got = {r.host: (r.trust, r.distrust) for r in url_graph.ranks(
        spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame(seeds, "host string, trusted double, blocked double")
    ).collect()}
    for k, moves in ((0, edges), (1, [(b, a) for a, b in edges])):
        total = sum(s[k + 1] for s in seeds)
        seed = {s[0]: s[k + 1] / total for s in seeds}
        rank = dict(seed)
        for _ in range(300):
            after = defaultdict(float, {h: (1 - url_graph.DAMPING) * s for h, s in seed.items()})
            for a, b in moves:
                after[b] += url_graph.DAMPING * rank.get(a, 0) / sum(x == a for x, _ in moves)
            rank = after
        assert sum(abs(got[h][k] - rank.get(h, 0.0)) for h in "abcd") < url_graph.TOLERANCE


def test_url_graph_of_odd_pages(spark):
    rows = [(0, None, None, "x"), (0, None, None, "x"), (1, "no scheme", "<a href='//a.b.example.org/'>", "x"), (2, "http://" + "a." * 2000 + "example.net/fr/" + "p" * 5000, "", "x"),
            (None, "HTTP://WWW.Example.COM/en/", "<a href=//a.b.example.org>", None)]
    df = spark.createDataFrame([(*r, "h", 1.0) for r in rows], "page_id long, url string, html string, host string, rank string, trust double")
    got = sorted(((r.page_id, r.host[:20], r.rule, r.verdict) for r in url_graph.judge(df).collect()), key=repr)
    assert got == sorted([(0, "", None, "allow")] * 2 + [(1, "", None, "allow"), (2, "a.a.a.a.a.a.a.a.a.a.", "net/fr/", "block"), (None, "www.example.com", "www.example.com/en/", "allow")], key=repr)


def five_word_groups(texts):
    sets, out = [shingle_set(t, 5) for t in texts], []
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    for i in range(len(texts)):
        out.append(find(i))
    return out


def test_pipeline_of_odd_and_empty_tables(spark, odd, none):
    for rows in (none, odd):
        kept = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = settle(stage(spark, kept, ""))
            assert after.columns == rows.columns, name
            kept = after
        assert corpus_pipeline.STAGES[-1][1](spark, kept, "").columns[:3] == ["doc_id", "start", "length"]


def test_pipeline_stages(docs, spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept, held = docs, None
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, "")
        path = str(tmp_path / str(n))
        out.write.parquet(path)
        before, kept = kept.collect(), spark.read.parquet(path)
        after = kept.collect()
        if n < 4:
            assert kept.columns == docs.columns
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after)
        if name == "quality rules":
            judged = quality_rules.judge(quality_rules.measure(docs)).filter("kept").collect()
            assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in judged)
        elif name == "line dedup":
            assert [r.doc_id for r in sorted(after)] == [r.doc_id for r in sorted(before)]
        elif name == "n-gram Jaccard join":
            ordered = sorted(before)
            want = five_word_groups([r.text for r in ordered])
            assert sorted(r.doc_id for r in after) == sorted({ordered[k].doc_id for k in want})
        elif name == "source mix":
            held = after
    assert sum(r.length for r in after) == sum(len(packing._tokenizer(TOKENIZER).encode(r.text, add_special_tokens=False).ids) + 1 for r in held)


def test_a_stage_deletes_what_the_one_before_settled(spark, docs, tmp_path):
    made = lambda: [Path(t._settled_in) for t in corpus_pipeline._LEFT[spark.sparkContext.applicationId, "f"]]
    (_, first), (_, second) = corpus_pipeline.STAGES[:2]
    out = first(spark, docs, "f")
    out.write.parquet(str(tmp_path / "kept"))
    before = made()
    assert before and all(p.exists() for p in before)
    want = sorted(map(tuple, second(spark, spark.read.parquet(str(tmp_path / "kept")), "f").collect()), key=repr)
    assert not any(p.exists() for p in before)
    # A stage over rows that are not settled leaves the tables behind them.
    out = first(spark, docs, "f")
    before = made()
    assert sorted(map(tuple, second(spark, out, "f").collect()), key=repr) == want
    assert all(p.exists() for p in before)


@pytest.mark.parametrize("step", [quality_rules.keep, source_mix.mix])
def test_row_places_do_not_depend_on_the_cores(spark, tmp_path, monkeypatch, step):
    """Files are cut differently in a second scan: the same documents must be kept, and cut at the same places."""
    rng = random.Random(6)
    texts = [(i, " ".join(prose(rng, 60 if i % 3 else 20)), "en", f"s{i % 3}", None) for i in range(400)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").repartition(6).write.parquet(path)
    conf, scans = spark.conf, []

    def cut():
        # From the second settled table on, every scan packs its files another way.
        scans.append(1)
        conf.set("spark.sql.files.maxPartitionBytes", "4k" if len(scans) > 1 else "128m")
        conf.set("spark.sql.files.openCostInBytes", "1" if len(scans) > 1 else "4m")

    module = quality_rules if step is quality_rules.keep else source_mix
    plain = module.settle

    def settle(df):
        out = plain(df)
        cut()
        return out

    try:
        want = sorted(map(tuple, step(spark.read.parquet(path)).collect()))
        monkeypatch.setattr(module, "settle", settle)
        assert sorted(map(tuple, step(spark.read.parquet(path)).collect())) == want
    finally:
        conf.unset("spark.sql.files.maxPartitionBytes")
        conf.unset("spark.sql.files.openCostInBytes")


def test_mix_takes_what_a_plain_loop_takes(spark, tmp_path):
    """Blocks and slots by a loop over shards, sources and words."""
    rng = random.Random(9)
    rows = [(i, " ".join(prose(rng, rng.randrange(0, 400))), "en", rng.choice(["a", "a", "b", None]), None) for i in range(70)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    got = {r.doc_id: r.taken for r in source_mix.taken_words(docs).collect()}
    _, sources = source_mix.measure(docs)
    times = defaultdict(int)
    drawn = [source_mix.slots(spark, sources).collect()][0]
    for r in drawn:
        times[r.s, r.block] += 1
    want = defaultdict(int)
    for s, name in enumerate(sources.names):
        at = 0
        for doc_id, text, _, source, _ in sorted(rows):
            if source == name:
                for _ in range(words_of(text)):
                    want[doc_id] += times[s, at // source_mix.BLOCK_WORDS]
                    at += 1
    assert got == {r[0]: want[r[0]] for r in rows}
    counts = defaultdict(int)
    for r in drawn:
        counts[r.s] += 1
    assert all(counts[s] == q for s, q in enumerate(sources.quotas))
