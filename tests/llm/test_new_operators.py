import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, clashing, documents, odd_documents, prose
from vigilo.llm import lexical, quality, spelling
from vigilo.llm.common import held_out

ITEMS = "item_id long, text string"


# ---------------------------------------------------------------- quality

SMALL = quality.Settings(sample=400, filters=8, steps=150, batch=16)


def plain_answers(net, text):
    """Largest answer of each filter, window by window."""
    out = []
    for at in range(0, max(len(text), 1), quality.STEP):
        window = (text[at:at + quality.STEP * quality.SPAN] + bytes(12))[:12]
        out.append(net.embed[list(window)].reshape(-1).astype(float) @ net.kernel.astype(float))
    return np.max(out, axis=0)


def test_chunks_hold_every_window(monkeypatch):
    net = quality.Network.fresh(SMALL, 0.5)
    rng = random.Random(2)
    for n in (0, 1, 3, 4, 5, 12, 13, 63, 64, 65, 200):
        text = bytes(rng.randrange(256) for _ in range(n))
        whole = net.pooled(text)
        assert np.allclose(whole, plain_answers(net, text), atol=1e-4)
        real = quality.chunks_of
        monkeypatch.setattr(quality, "chunks_of", lambda t, size=16: real(t, size))
        assert np.allclose(net.pooled(text), whole, atol=1e-5)
        best, windows = net.pooled_with_windows(text)
        assert np.allclose(best, whole, atol=1e-5)
        again = (net.embed[windows].reshape(len(best), -1) * net.kernel.T).sum(axis=1)
        assert np.allclose(again, best, atol=1e-4)
        monkeypatch.setattr(quality, "chunks_of", real)


def test_slopes_agree_with_differences():
    net = quality.Network.fresh(quality.Settings(filters=4, width=3), 0.5)
    texts, y = [b"some words of a text", b"", b"another one, longer than the first of them"], np.array([1.0, 0.0, 1.0])

    def loss():
        p = net.score(texts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    slopes = net.slopes(texts, y)
    for part, slope in zip(net.parts()[:4], slopes[:4], strict=True):
        flat = part.reshape(-1)
        for k in np.argsort(-np.abs(slope.reshape(-1)))[:3]:
            old = flat[k]
            flat[k] = old + 1e-2
            up = loss()
            flat[k] = old - 1e-2
            down = loss()
            flat[k] = old
            assert abs((up - down) / 2e-2 - slope.reshape(-1)[k]) < 0.02 * max(1, abs(slope.reshape(-1)[k])) + 2e-3
    again = quality.Network.from_bytes(net.to_bytes(), quality.Settings(filters=4, width=3))
    assert np.allclose(again.score(texts), net.score(texts))


def test_bad_texts_are_told_apart(spark):
    rng = random.Random(5)
    rows = [(k, prose(rng, 60) + (" @@@ ### $$$" if k % 4 == 0 else ""), "en", "s", 0) for k in range(400)] + [(None, prose(rng, 50), None, None, 0), (7, None, None, None, 0), (9999, "", None, None, 0)]
    labels = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(400)] + [(None, 1), (3, None)], "doc_id long, quality int")
    docs = clashing(documents(spark, rows))
    net = quality.fit(docs, "doc_id", "text", labels, "doc_id", "quality", ~held_out("doc_id", 5, 0), SMALL)
    got = quality.with_score(docs, "text", net, "mark").select("doc_id", "mark", "score", held_out("doc_id", 5, 0).alias("out")).collect()
    assert len(got) == len(rows) and all(0 <= r.mark <= 1 and r.score == "extra" for r in got)
    new = [(r.mark, r.doc_id % 4 != 0) for r in got if r.out and r.doc_id is not None and r.doc_id < 400 and r.doc_id != 7]
    good, bad = [s for s, y in new if y], [s for s, y in new if not y]
    assert sum(a > b for a in good for b in bad) > 0.95 * len(good) * len(bad)
    assert got == quality.with_score(docs, "text", net, "mark").select("doc_id", "mark", "score", held_out("doc_id", 5, 0).alias("out")).collect()


def test_quality_without_labels_or_rows(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.fit(documents(spark), "doc_id", "text", labels.where("false"), "doc_id", "quality", F.lit(True), SMALL) is None
    assert quality.with_score(documents(spark), "text", None).where("score > 0.99").count() == len(odd_documents())
    assert quality.with_score(spark.createDataFrame([], DOCS), "text", None).count() == 0


# ---------------------------------------------------------------- spelling

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_groups(rows, every, least=5, count=3):
    total = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            total[run if not every or h % every else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in total.items() if len(w) >= least and c >= count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def test_scan_finds_exactly_the_pairs_at_one_edit():
    rng = random.Random(1)
    for t in range(40):
        groups = [sorted({bytes(rng.choice(b"ab\xe9c"[:rng.randint(1, 4)]) for _ in range(rng.randint(0, 7))) for _ in range(40)}) for _ in range(3)]
        strings, lists = [s for g in groups for s in g], np.repeat(np.arange(3), [len(g) for g in groups])
        asked, found, same = spelling.scan(strings, lists)
        want = [(i, j) for i in range(len(strings)) for j in range(len(strings)) if lists[i] == lists[j] and one_edit(strings[i], strings[j])]
        assert sorted(zip(asked.tolist(), found.tolist(), strict=True)) == want
        for i, j, k in zip(asked, found, same, strict=True):
            a, b = strings[i], strings[j]
            assert a[:k] == b[:k] and (k == min(len(a), len(b)) or a[k] != b[k])


@pytest.mark.parametrize("long_list", [1 << 16, 10, 2])
def test_near_words_however_lists_are_cut(spark, long_list):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(5, 8))) for _ in range(900)})
    n = {w: rng.randint(3, 6) for w in words}
    got = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(spark.createDataFrame(list(n.items()), "word string, n long"), long_list=long_list).collect()}
    want = {}
    for w in words:
        found = [v for v in words if one_edit(w, v)]
        if found:
            best = min(found, key=lambda v: (-n[v], v))
            want[w] = (len(found), n[best], best)
    assert got == want


def test_groups_of_odd_tables(spark):
    rng = random.Random(8)
    stems = ["house", "mouse", "houses", "straße", "strasse", "ÀÉÎabc", "naïve", "a" * 300, "longerword"]
    rows = odd_documents() + [(k, " ".join(rng.choice(stems) + rng.choice(["", "", "", "s", "x"]) for _ in range(30)), None, None, 0) for k in range(100, 220)]
    rows += [(500, "house一house \U0001F600mouse œuvre×÷", None, None, 0)] * 3
    for every in (None, 5):
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(clashing(documents(spark, rows)), "doc_id", "text", drop_every=every).collect()}
        assert got == brute_groups(rows, every)
    assert spelling.group_variants(spark.createDataFrame([], DOCS), "doc_id", "text").count() == 0
    assert spelling.group_variants(documents(spark, [(1, None, None, None, 0), (2, "", None, None, 0)]), "doc_id", "text").count() == 0


def test_chains_are_followed_to_their_ends(spark):
    links = [(f"w{k:02}", f"w{k + 1:02}") for k in range(20)] + [("w20", None), ("alone", None), ("x", "w05")]
    got = dict(map(tuple, spelling.follow(spark.createDataFrame(links, "word string, form string")).collect()))
    assert got == {f"w{k:02}": "w20" for k in range(20)} | {"x": "w20"}


# ---------------------------------------------------------------- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranks(rows, items, k):
    docs = [(r[0], Counter(brute_terms(r[1]))) for r in rows]
    held = sum(1 for _, c in docs if c)
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(brute_terms(text))
    out = []
    for item, terms in asked.items():
        found = []
        for key, c in docs:
            m = 10 + (90 * sum(c.values()) * held) // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * held + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                found.append((-s, key is None, key or 0, key))
        out += [(item, rank + 1, key, -s) for rank, (s, _, _, key) in enumerate(sorted(found)[:k])]
    return Counter(out)


def test_ranks_of_odd_tables(spark):
    rows = odd_documents() + [(900 + k, "same text for all of these", None, None, 0) for k in range(30)]
    rows += [(950, "x" * 10 + " İ K ß " + "same " * 40, None, None, 0)]
    items = [(1, rows[3][1]), (2, "same TEXT"), (2, "of these"), (3, None), (4, ""), (None, rows[20][1]), (5, "zzz unknown"), (6, rows[35][1]), (7, "İ k"), (8, "one, two; one?")]
    asked = spark.createDataFrame(items, ITEMS).withColumn("score", F.lit("own")).withColumn("term", F.lit("own"))
    for k in (1, 10):
        got = lexical.rank_documents(clashing(documents(spark, rows)).repartition(3), "doc_id", "text", asked, "item_id", "text", k=k)
        assert Counter(map(tuple, got.collect())) == brute_ranks(rows, items, k)
    none = spark.createDataFrame([], ITEMS)
    assert lexical.rank_documents(documents(spark), "doc_id", "text", none, "item_id", "text").count() == 0
    assert lexical.rank_documents(spark.createDataFrame([], DOCS), "doc_id", "text", asked, "item_id", "text").count() == 0


def test_ranks_with_small_shards_blocks_and_marked_terms(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SENT_TERMS", 0)
    monkeypatch.setattr(lexical, "ASKED_TERMS", 20)
    rng = random.Random(4)
    rows = [(k, prose(rng, rng.randint(1, 60)), None, None, 0) for k in range(150)]
    items = [(k, " ".join(rng.sample(rows[k][1].split(), min(6, len(rows[k][1].split()))))) for k in range(25)]
    got = lexical.rank_documents(documents(spark, rows), "doc_id", "text", spark.createDataFrame(items, ITEMS), "item_id", "text")
    assert Counter(map(tuple, got.collect())) == brute_ranks(rows, items, 10)


def test_blocks_are_skipped_only_when_they_may_be():
    rng = random.Random(6)
    topics = [[f"t{a}w{b}" for b in range(25)] for a in range(12)]
    texts = [[rng.choice(topics[k % 12]) for _ in range(20)] + [rng.choice(("the", "of", "and"))] for k in range(1200)]
    terms = sorted({w.encode() for t in texts for w in t})
    number = {t: k for k, t in enumerate(terms)}
    counts = [sorted(Counter(number[w.encode()] for w in t).items()) for t in texts]
    ids, sizes = np.arange(1200), np.array([len(t) for t in texts])
    shard = lexical.Shard.build(terms, ids, sizes, np.array([len(c) for c in counts]), np.array([k for c in counts for k, _ in c], dtype=np.int32),
                                np.array([n for c in counts for _, n in c]), 1200, int(sizes.sum()), block=16)
    shard = lexical.Shard.unpack(terms, shard.pack())
    for t in range(len(terms)):
        blocks = slice(shard.block_ptr[shard.list_ptr[t]], shard.block_ptr[shard.list_ptr[t + 1]])
        assert sorted(shard.block_docs[blocks]) == [k for k in range(1200) if t in dict(counts[k])]
    tally = Counter()
    for q in range(40):
        asked = [(w.encode(), 500 + len(w)) for w in {*texts[q][:4], "the"}]
        weight = np.zeros(len(terms), dtype=np.int64)
        for t, w in asked:
            weight[number[t]] = w
        scores = shard.scores(ids, weight)
        order = np.lexsort((ids, -scores))[:10]
        order = order[scores[order] > 0]
        empty = np.empty(0, dtype=np.int64)
        found = shard.search(asked, (empty, empty), 10, tally)
        assert found[0].tolist() == scores[order].tolist() and found[1].tolist() == order.tolist()
    assert tally["docs"] < 0.5 * 40 * 1200


def test_a_block_below_the_threshold_is_passed_over(monkeypatch):
    monkeypatch.setattr(lexical, "FIRST_LISTS", 1)
    terms = [b"a", b"p", b"x", b"z"]
    docs = [[0, 1]] * 20 + [[2]] * 20 + [[3]] * 20
    shard = lexical.Shard.build(terms, np.arange(60), np.full(60, 2), np.array([len(d) for d in docs]), np.array([t for d in docs for t in d], dtype=np.int32),
                                np.ones(80, dtype=np.int64), 60, 120, block=4)
    empty, tally = np.empty(0, dtype=np.int64), Counter()
    # x and z together could reach the threshold, but no block of theirs holds both.
    found = shard.search([(b"a", 1000), (b"p", 600), (b"x", 950), (b"z", 950)], (empty, empty), 10, tally)
    assert found[1].tolist() == list(range(10))
    assert tally["docs"] == 20 and 0 < tally["read"] < tally["blocks"]
