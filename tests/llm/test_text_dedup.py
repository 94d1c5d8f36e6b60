import hashlib
import random

import numpy as np

from tests.llm.helpers import DOCS, clashing, documents, odd_documents, prose
from vigilo.llm import minhash_dedup, suffix_dedup
from vigilo.llm.shingles import WordHasher


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t, *_ in rows]
    low = {i: i for i, _ in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for i, a in sets:
            for j, b in sets:
                if None not in (i, j) and a and b and 100 * len(a & b) >= 75 * len(a | b) and low[i] != low[j]:
                    low[i] = low[j] = min(low[i], low[j])
                    changed = True
    return low


def brute_repeats(rows):
    first, out = {}, {}
    known = sorted((i, (t or "").encode()) for i, t, *_ in rows if i is not None)
    for i, raw in known:
        for k in range(len(raw) - 49):
            first.setdefault(raw[k:k + 50], i)
    for i, raw in known:
        gone = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if first[raw[k:k + 50]] < i:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), len([s for s in bytes(gone).split(b"\0") if s]), kept)
    return out


def test_minhash_matches_brute_force(spark):
    rows = odd_documents()
    got = minhash_dedup.near_duplicates(clashing(documents(spark)), "doc_id", "text").collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is not None and r.component_id == r.doc_id)
    sizes = sorted((r.doc_id or -1, r.n_shingles) for r in got)
    assert sizes == sorted((i or -1, len(shingle_set(t))) for i, t, *_ in rows)


def test_minhash_joins_groups_through_members_that_are_not_first(spark):
    # A chain: neighbours are alike, the ends are not, and the smallest id is at one end.
    rng = random.Random(3)
    words = prose(rng, 400).split()
    rows = [(k, " ".join(words[14 * k:14 * k + 200]), "en", "s", 0) for k in range(12)]
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(documents(spark, rows), "doc_id", "text").collect()}
    assert got == brute_components(rows) and set(got.values()) == {0}


def test_large_buckets_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "TILE", 3)
    rows = odd_documents(5)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(documents(spark, rows), "doc_id", "text").collect()}
    want = brute_components(rows)
    assert all(c == want.get(i) for i, c in got.items())


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    far = []
    for _ in range(60):
        a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        b = a.copy()
        b[:60] = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        x, y = (minhash_dedup.odd_sketch(minhash_dedup.signature(s)) for s in (a, b))
        far.append(float(minhash_dedup.estimate(np.bitwise_count(x ^ y).sum())) - 340 / 460)
    assert abs(np.mean(far)) < 0.01 and np.std(far) < 0.03


def test_word_hashes_depend_on_the_word_only():
    hasher = WordHasher()
    h, at = hasher.words([b"Ab  cd\tab", b"", b"cd\x0bAB", b"\xc3\x89 \xc3\xa9"])
    assert at.tolist() == [0, 3, 3, 5, 7]
    assert h[0] == h[2] == h[4] and h[1] == h[3] and h[5] != h[6]
    hasher_small = WordHasher()
    long = [b"w%d" % k for k in range(300_000)]
    assert len(np.unique(hasher_small.words([b" ".join(long)])[0])) == 300_000


def test_suffix_dedup_matches_brute_force(spark):
    rows = odd_documents()
    got = suffix_dedup.remove_repeats(clashing(documents(spark)), "doc_id", "text", ["lang", "source"]).collect()
    want = brute_repeats(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.id is None:
            assert r.n_removed == 0 and r.n_bytes == len(r.kept)
        else:
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == want[r.id]
            assert r.text == bytes(r.kept).decode("utf-8", "ignore")
    assert sorted(str((r.id, r.carried0, r.carried1)) for r in got) == sorted(str((i, lang, source)) for i, _, lang, source, _ in rows)


def test_suffix_dedup_deals_hot_windows_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    monkeypatch.setattr("vigilo.llm.units.UNIT_BYTES", 2000)
    rows = odd_documents(9)
    want = brute_repeats(rows)
    for r in suffix_dedup.remove_repeats(documents(spark, rows), "doc_id", "text").collect():
        if r.id is not None:
            assert (r.n_removed, r.n_spans, hashlib.sha256(r.kept).digest()) == (want[r.id][1], want[r.id][2], hashlib.sha256(want[r.id][3]).digest())


def test_copies_that_end_or_begin_inside_a_hot_line_are_found(spark, monkeypatch):
    # Equal windows in runs of which only one holds the hot surroundings: edited and truncated lines.
    monkeypatch.setattr(suffix_dedup, "HOT", 30)
    rng = random.Random(11)
    rows = []
    for _ in range(12):
        line, n = prose(rng, 30)[:70], len(rows)
        rows += [(n + k, f"{prose(rng, 20)}{line}{prose(rng, 20)}", "en", "s", 0) for k in range(40)]
        for cut in range(20, 35):
            before, after, n = prose(rng, 20), prose(rng, 20), len(rows)
            rows += [(n, f"{before}{line}{prose(rng, 20)}", "en", "s", 0), (n + 1, f"{before}{line[:cut]}{prose(rng, 20)}", "en", "s", 0),
                     (n + 2, f"{prose(rng, 20)}{line}{after}", "en", "s", 0), (n + 3, f"{prose(rng, 20)}{line[-cut:]}{after}", "en", "s", 0)]
    want = brute_repeats(rows)
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(documents(spark, rows), "doc_id", "text").collect()}
    assert {i for i in want if got[i] != want[i]} == set()


def test_columns_sort_all_suffixes():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(30)]
    raw = b"\xff" + b"\xff".join(strings) + b"\xff"
    ends = np.cumsum([len(s) + 1 for s in strings])
    at = suffix_dedup.sorted_suffixes(np.frombuffer(raw, dtype=np.uint8), ends, 40)
    found = [raw[a:raw.index(b"\xff", a)] for a in at.tolist()]
    assert found == sorted(found) and len(found) == sum(len(s) + 1 for s in strings)


def test_only_suffixes_with_a_window_are_sorted_and_only_as_far_as_it_reaches(monkeypatch):
    rng = random.Random(4)
    shared = [bytes(rng.choice(b"abc") for _ in range(80)) for _ in range(20)]
    strings = list({s[k:80 - m] for s in shared for k in range(0, 30, 7) for m in range(0, 30 - k, 5)})
    strings += [bytes(rng.choice(b"a\x00\xf4") for _ in range(80)) for _ in range(20)] + [b"a" * 50, b"a" * 51, b"\x00" * 60, b"x" * 49]
    ids = np.array(rng.sample(range(1000), len(strings)))
    sorted_rows, argsort = [], np.argsort
    monkeypatch.setattr(suffix_dedup.np, "argsort", lambda x, **k: sorted_rows.append(len(x)) or argsort(x, **k))
    got = suffix_dedup.smallest_ids(strings, ids)
    low = {}
    for s, i in zip(strings, ids.tolist()):
        for k in range(len(s) - 49):
            low[s[k:k + 50]] = min(i, low.get(s[k:k + 50], i))
    assert [g.tolist() for g in got] == [[low[s[k:k + 50]] for k in range(len(s) - 49)] for s in strings]
    assert sum(sorted_rows) <= 25 * sum(len(s) - 49 for s in strings)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert minhash_dedup.near_duplicates(none, "doc_id", "text").count() == 0
    assert suffix_dedup.remove_repeats(none, "doc_id", "text").count() == 0


def test_small_staged_rows_are_few_files_however_many_shuffle_partitions(spark, monkeypatch):
    from vigilo.llm import common

    files = {}

    def counting(df, label):
        files.setdefault(label, []).append(len((out := staged(df, label)).inputFiles()))
        return out

    staged = common.stage
    monkeypatch.setattr(common, "stage", counting)
    monkeypatch.setattr(minhash_dedup, "stage", counting)
    rng = random.Random(11)
    texts = [prose(rng, 40) for _ in range(60)]
    rows = [(1000 * c + k, f"{t} {prose(rng, 2)}", "en", "s0", 0) for k, t in enumerate(texts) for c in range(4)]
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(documents(spark, rows), "doc_id", "text").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_components(rows)
    assert len(set(got.values())) == 60
    most = 2 * spark.sparkContext.defaultParallelism
    assert {"points", "buckets", "pairs", "links", "edges"} <= set(files)
    assert all(n <= most for label in ("points", "buckets", "pairs", "links", "edges") for n in files[label])
