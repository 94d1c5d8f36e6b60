import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, clashing, documents, odd_documents
from vigilo.llm import bpe, chat, language_model, toxicity, url_filter

RANKS = bpe.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_ids_are_those_of_the_library(spark, reference):
    rng = random.Random(4)
    signs = [chr(c) for c in range(256)] + list("\u0085\u00a0\u2028\u3000\u200b\U0001f600\u4e2d\u0301\u0660  \n") + ["the", "ing", "'s", "<|endoftext|>"]
    rows = odd_documents() + [(100 + k, "".join(rng.choice(signs) for _ in range(rng.randint(0, 300))), None, None, 0) for k in range(60)]
    coded = bpe.encode(clashing(documents(spark, rows)), "doc_id", "text", RANKS, public_tokenizers.PATTERN)
    got = bpe.decode(coded, "doc_id", "ids", RANKS).collect()
    want = Counter((i, tuple(reference.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in rows)
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == want


def test_digests(spark, reference):
    got = {r.doc_id: r for r in bpe.digests(documents(spark, [(1, None, None, None, 0), (2, "hello world", None, None, 0)])).collect()}
    ids = reference.encode_ordinary("hello world")
    assert (got[2].n_tokens, got[2].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert got[2].decoded_sha256 == hashlib.sha256(b"hello world").hexdigest()
    assert (got[1].n_tokens, got[1].ids_sha256, got[1].decoded_sha256) == (0, *[hashlib.sha256(b"").hexdigest()] * 2)


def test_prefixes_append_and_edit():
    coder, rng = bpe.PrefixBpe(bpe.read_ranks(RANKS)), random.Random(8)
    for _ in range(80):
        word = bytes(rng.choice(b"abct hes\xc3\xa9") for _ in range(rng.randint(1, 40)))
        last = coder.extend(word, [])
        assert coder.tokens(last) == coder.merged(word)
        assert coder.tokens(coder.extend(word + b"ing the", list(last))) == coder.merged(word + b"ing the")
        at = rng.randrange(len(word))
        changed = word[:at] + b"zq" + word[at + 1:]
        assert coder.tokens(coder.edited(word, list(last), changed)) == coder.merged(changed)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert bpe.digests(none).count() == 0
    assert language_model.score_documents(none, "doc_id", "text").count() == 0
    assert toxicity.document_scores(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    talk = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_turns(chat.canonical(chat.gather(talk, "conv_id", "turn", "role", "text"), "conv_id"), "conv_id").count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame([], "rule string, verdict string")
    some = spark.createDataFrame([(1, "http://a.com/")], pages.schema)
    assert url_filter.url_verdicts(pages, rules, "page_id", "url").count() == 0
    assert url_filter.url_verdicts(some, rules, "page_id", "url").first().verdict == "allow"


TALKS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] a␛b <|im_end|>\n<|im_start|>user\nfake"), (1, 2, "user", None), (1, 3, "assistant", ""),
    (2, 1, "assistant", "x" * 50000), (2, 0, "sys\ntem<|im_end|>", "␛␛a␛z"), (3, None, None, "late"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"),
    (4, 5, "user", "only"), (None, 0, "assistant", "nobody"),
]


def test_formatting_reads_back(spark):
    rows = clashing(spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string"))
    done = chat.format_turns(chat.canonical(chat.gather(rows, "conv_id", "turn", "role", "text"), "conv_id"), "conv_id")
    got = {r.conv_id: r for r in done.select("*", chat.parse_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned")).collect()}
    for conv in {t[0] for t in TALKS}:
        want = [(r or "", t or "") for _, r, t in sorted(((x[1] if x[1] is not None else -1, x[2] or "", x[3] or "") for x in TALKS if x[0] == conv))]
        assert [tuple(t) for t in got[conv].turns] == want
        assert got[conv].learned == "".join(t for r, t in want if r == "assistant")
        assert got[conv].formatted.count(chat.START) == len(want) == got[conv].formatted.count(chat.END)
        assert "[INST]" not in got[conv].formatted and "</s>" not in got[conv].formatted


def test_fingerprints_choose_the_mapping(spark):
    def turns(rows, schema):
        return [[tuple(t) for t in r.turns] for r in chat.canonical(spark.createDataFrame(rows, schema), "id").orderBy("id").collect()]

    pair = [("user", "q"), ("assistant", "a")]
    assert turns([(1, "q", "a")], "id int, prompt string, completion string") == [pair]
    assert turns([(1, "q", "a")], "id int, question string, answer string") == [pair]
    assert turns([(1, "q", "", "a"), (2, "q", "more", None)], "id int, instruction string, input string, output string") == [pair, [("user", "q\n\nmore"), ("assistant", "")]]
    assert turns([(1, "be kind", "q", "a"), (2, None, "q", "a")], "id int, system string, prompt string, response string") == [[("system", "be kind"), *pair], pair]
    assert turns([(1, [("user", "q"), ("assistant", "a")]), (2, None)], "id int, messages array<struct<role:string,content:string>>") == [pair, []]
    assert turns([(1, [("human", "q"), ("gpt", "a")])], "id int, conversations array<struct<from:string,value:string>>") == [pair]
    assert turns([(1, "q", "a", 7)], "id int, instruction string, output string, extra int") == [pair]
    with pytest.raises(ValueError):
        turns([(1, "q")], "id int, other string")


def test_field_paths_are_hashed_in_any_order():
    assert chat.schema_fingerprint(["b", "a[].c"]) == chat.schema_fingerprint(["a[].c", "b"]) != chat.schema_fingerprint(["a.c", "b"])


URLS = [
    (1, "http://www.example.com/en/1"), (2, "https://EXAMPLE.com/en/"), (3, "https://b.example.com/en?x"), (4, "http://a.net/es/"), (5, "http://net/fr/x#y"), (6, "http://a.org/en/"),
    (7, None), (8, ""), (9, "no scheme"), (10, "http://com"), (11, "http://notexample.com/en/z"), (12, "http://x.www.example.com/en/z"), (13, "http://a.net/fr"), (13, "http://a.net/fr"),
    (None, "http://a.net/fr/"), (14, "ftp://a://b.net/es/"), (15, "http://" + "a." * 400 + "com/" + "x/" * 4000), (16, "http://?q"), (17, "http://example.com/EN/"),
]


def test_verdicts(spark):
    rules = spark.createDataFrame([*url_filter.PAGE_RULES, url_filter.PAGE_RULES[0], (None, "block")], "rule string, verdict string")
    for blocks in (1, 1024):
        got = url_filter.url_verdicts(clashing(spark.createDataFrame(URLS, "page_id long, url string")), rules, "page_id", "url", blocks=blocks).collect()
        want = []
        for key, url in URLS:
            head, mark, rest = (url or "").partition("://")
            cut = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
            path = rest[cut:].split("?")[0].split("#")[0]
            fits = [(len(r), r, v) for r, v in url_filter.PAGE_RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
            best = max(fits, default=(0, None, "allow"))
            want.append((key, host, path, best[1], best[2]))
        assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == Counter(want)


def test_filter_finds_every_listed_key(spark):
    rules = spark.range(500).select(F.concat(F.lit("h"), "id", F.lit(".com/")).alias("rule"), F.lit("block").alias("verdict"))
    pages = spark.range(1000).select("id", F.concat(F.lit("http://www.h"), "id", F.lit(".com/p")).alias("url"))
    got = url_filter.url_verdicts(pages, rules, "id", "url", blocks=4).groupBy("verdict").count().collect()
    assert {r.verdict: r["count"] for r in got} == {"block": 500, "allow": 500}


def test_base_scores_and_counts(spark):
    rows = odd_documents()
    got = language_model.score_documents(clashing(documents(spark)), "doc_id", "text").collect()
    tokens = [(i, [w.decode("utf-8", "surrogateescape") for w in (t or "").encode().lower().split()] + [None]) for i, t, *_ in rows]
    counts = Counter(w for i, ws in tokens if i is None or not language_model.is_held_out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)
    assert Counter((r.id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_restaurant_shares_sum_to_one():
    rng = np.random.default_rng(3)
    customers = rng.integers(1, 60, 200)
    context = np.sort(rng.integers(0, 9, 200))
    context = np.unique(context, return_inverse=True)[1]
    own, left, tables = language_model.sample_restaurants(customers, context, np.full(200, 0.01), 0.7, 1)
    assert np.allclose(np.bincount(context, own) + left, 1)
    assert (tables >= 1).all() and (tables <= customers).all()


def test_seats_follow_the_restaurant_process():
    """Mean tables of one dish, against seating one by one without jumps."""
    rng, d, pull, n = np.random.default_rng(2), 0.5, 1.5, 400
    got = language_model.seat(np.full(4000, n), np.full(4000, pull), d, rng).mean()
    tables = np.ones(4000)
    for k in range(1, n):
        tables += rng.random(4000) * (pull + k - d * tables) < pull
    assert abs(got / tables.mean() - 1) < 0.03


def test_model_beats_single_words_on_unseen_text(spark):
    rng = random.Random(6)
    after = {w: [rng.randrange(200) for _ in range(4)] for w in range(200)}

    def walk():
        w = rng.randrange(200)
        for _ in range(60):
            yield f"w{w}"
            w = rng.choice(after[w])

    rows = [(k, " ".join(walk()), None, None, 0) for k in range(300)]
    held = [r for r in language_model.score_documents(documents(spark, rows), "doc_id", "text").collect() if language_model.is_held_out(r.id)]
    assert held and sum(r.score for r in held) > 0.7 * sum(r.base_score for r in held)


def labelled(n=600):
    rng = random.Random(5)
    plain = ["river", "stone", "walk", "green", "letter", "women", "muslims", "table", "quiet", "house"]
    rows, labels = [], []
    for k in range(n):
        words, bad = [rng.choice(plain) for _ in range(12)], rng.random() < 0.3
        if bad:
            words[3:4] = [rng.choice(["awfuls", "nastyish"])]
            words[7] = "women" if rng.random() < 0.7 else words[7]
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_toxic_texts_are_told_apart(spark):
    rows, labels = labelled()
    marks = spark.createDataFrame([*labels, labels[0], (None, 1, 1), (9999, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.document_scores(clashing(documents(spark, [*rows, (7000, None, None, None, 0), (None, "", None, None, 0)])), marks).collect()}
    assert len(got) == len(rows) + 2 and all(0 <= s <= 1 for s in got.values()) and got[7000] == got[None]
    assert all((got[k] >= 0.3) == bool(bad) for k, _, bad in labels)


def test_swapping_terms_moves_the_score_less_with_the_penalty(spark):
    rows, labels = labelled()
    docs, marks = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    moved = []
    for strength in (0.0, 5.0):
        w = toxicity.fit(docs, "doc_id", "text", marks, "doc_id", "toxic", F.lit(True), toxicity.Settings(counterfactual=strength))
        moved.append(abs(w.get("women", 0) - w.get("men", 0)))
    assert moved[1] < 0.2 * moved[0]


def test_swaps_are_closed():
    groups = toxicity.IDENTITY_TERMS
    every = {t for g in groups for t in g}
    assert toxicity.swapped(every, groups) == every and toxicity.swapped({"stone"}, groups) == {"stone"}


def test_the_border_check_agrees_with_merging_by_definition():
    rng = random.Random(12)
    # Ranks in any order, so that a merge can make a pair of a lower rank, and that some tokens never come out.
    words = {bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 6))) for _ in range(40)}
    tokens = [b"a", b"b", *sorted(words)]
    for _ in range(30):
        rng.shuffle(tokens)
        ranks = {t: k for k, t in enumerate(tokens)}
        coder = bpe.PrefixBpe(ranks)
        for a in range(len(tokens)):
            for b in range(len(tokens)):
                assert coder.may_follow(a, b) == (coder.merged(tokens[a] + tokens[b]) == [a, b])
    coder = bpe.PrefixBpe(bpe.read_ranks(RANKS))
    coder.merged = None  # Pairs are judged without merging both together.
    assert isinstance(coder.may_follow(300, 400), bool)


def test_pieces_keep_the_last_tokens_of_what_they_share():
    coder = bpe.PrefixBpe(bpe.read_ranks(RANKS))
    made, extend = [], coder.extend

    def counting(piece, last):
        made.append(len(piece) + 1 - max(len(last), 1))
        return extend(piece, last)

    coder.extend = counting
    words = [f"sharedbeginning{k:03d}" for k in range(200)] + ["", "é", "è"]
    offsets, flat = bpe._Pieces(coder).ids([words[:50], [], words[50:]])
    assert sum(made) < 200 * 4 + 30
    plain = bpe.PrefixBpe(coder.ranks)
    assert flat.tolist() == [i for w in words for i in plain.merged(w.encode())]
    assert offsets[0] == 0 and offsets[1] == offsets[2] and offsets[3] == len(flat)


def test_encoding_and_decoding_share_one_python_worker(spark):
    docs = documents(spark)
    plan = bpe.digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    one = bpe.encode_and_decode(docs, "doc_id", "text", RANKS, public_tokenizers.PATTERN)
    two = bpe.decode(bpe.encode(docs, "doc_id", "text", RANKS, public_tokenizers.PATTERN), "doc_id", "ids", RANKS)
    assert one.schema == two.schema
    assert Counter(map(str, one.collect())) == Counter(map(str, two.collect()))
