import math
import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, clashing, documents, odd_documents
from tests.llm.test_text_dedup import brute_components, brute_repeats
from vigilo.llm import mixing, toxicity
from vigilo.llm.common import held_out
from vigilo.sources.tables import stage


def words(text):
    return len((text or "").encode().split())


def brute_exponent(tokens, entropy, most, budget):
    """The same targets by plain halving."""
    total = sum(tokens)

    def weights(x):
        w = [(t / total) ** x for t in tokens]
        return [v / sum(w) for v in w]

    def spread(x):
        return -sum(w * math.log(w) for w in weights(x))

    low, high = 0.0, 1.0
    if spread(1.0) >= entropy * math.log(len(tokens)):
        low = 1.0
    else:
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if spread(mid) >= entropy * math.log(len(tokens)) else (low, mid)
    a, b = 0.0, 1.0
    passes = lambda x: max(w * budget / t for w, t in zip(weights(x), tokens, strict=True))
    if passes(0.0) > most:
        for _ in range(60):
            mid = (a + b) / 2
            a, b = (a, mid) if passes(mid) <= most else (mid, b)
        low = max(low, b)
    return weights(low)


def test_mix_meets_its_targets(spark):
    rows = odd_documents()
    rows += [(1000 + k, "word " * (5 + k % 40), "en", "hot", 0) for k in range(600)]
    tokens = Counter()
    for _, t, _, s, _ in rows:
        tokens[s] += words(t)
    budget = sum(tokens.values())
    names = [s for s in tokens if tokens[s]]
    for entropy, most in ((0.9, 50.0), (0.97, 2.0), (1.0, 1.5)):
        got = mixing.mix(clashing(documents(spark, rows)), "doc_id", "source", "text", entropy=entropy, most_passes=most, block_rows=16).collect()
        want = dict(zip(names, brute_exponent([tokens[s] for s in names], entropy, most, budget), strict=True))
        used = Counter()
        for r in got:
            used[r.source] += r.copies * r.n_tokens
        largest = Counter()
        for _, t, _, s, _ in rows:
            largest[s] = max(largest[s], words(t))
        for s in names:
            assert abs(used[s] - want[s] * budget) <= largest[s] + 2, (s, entropy)
            copies = {r.copies for r in got if r.source == s}
            assert max(copies) - min(copies) <= 1


def test_positions_number_the_words_before(spark):
    rows = [(k, "w " * (k % 7), None, "s", 0) for k in range(300)]
    got = mixing.mix(documents(spark, rows), "doc_id", "source", "text", entropy=None, most_passes=None, block_rows=10).collect()
    assert len(got) == 300 and {r.copies for r in got} == {1}
    at = 0
    for position, n in sorted((r.position, r.n_tokens) for r in got if r.n_tokens):
        assert position == at
        at += n


def test_no_source_meets_in_one_task(spark):
    rows = [(k, "w " * (k % 9), None, "hot" if k % 3 else f"s{k % 5}", 0) for k in range(900)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for carry in (False, True):
            mixed = mixing.mix(documents(spark, rows), "doc_id", "source", "text", entropy=None, most_passes=None, block_rows=50, carry=carry)
            plan = mixed._jdf.queryExecution().executedPlan().toString()
            # Rows meet their limits by source and salt, and their windows by source and block.
            assert len(re.findall(r"Exchange hashpartitioning\(src#\d+, (?:block|salt)#", plan)) >= 2
            assert len(mixed.collect()) == len(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_mix_of_odd_tables(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS), "doc_id", "source", "text").count() == 0
    blank = documents(spark, [(1, None, None, None, 0), (1, None, None, None, 0), (None, "", None, "a", 0)])
    assert sorted((r.doc_id or 0, r.copies) for r in mixing.mix(blank, "doc_id", "source", "text").collect()) == [(0, 1), (1, 1), (1, 1)]
    carried = mixing.mix(clashing(documents(spark)), "doc_id", "source", "text", carry=True)
    assert set(carried.select("row.*").columns) >= {"doc_id", "text", "row", "src", "h"}


def write(spark, folder, rows, labels):
    documents(spark, rows).withColumn("score", F.lit("own")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_matches_its_stages_by_brute_force(spark, tmp_path):
    rows = odd_documents() + [(300 + k, f"some words number {k} and a vile insult here {k * 7}", "en", "s1", 0) for k in range(40)]
    rows += [(400 + k, f"some words number {k} and a kind remark here {k * 7}", "en", "s2", 0) for k in range(120)]
    labels = [(k, 1, int(300 <= k < 400)) for k in [*range(60), *range(300, 340), *range(400, 520)]]
    folder = write(spark, tmp_path, rows, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    clean = stage(corpus_pipeline.drop_toxic(spark, docs, folder), "clean")
    left = [tuple(r)[:5] for r in clean.collect()]
    assert clean.columns == columns
    assert Counter(r[0] for r in left) == Counter(r[0] for r in rows if not (r[0] and 300 <= r[0] < 400))
    low = brute_components(left)
    once = stage(corpus_pipeline.drop_near_copies(spark, clean, folder), "once")
    left = [r for r in left if r[0] is None or low[r[0]] == r[0]]
    assert once.columns == columns and Counter(r.doc_id for r in once.collect()) == Counter(r[0] for r in left)
    cut = stage(corpus_pipeline.cut_repeats(spark, once, folder), "cut")
    want = brute_repeats(left)
    assert cut.columns == columns and cut.dtypes == docs.dtypes
    for r in cut.collect():
        assert r.n_chars == len(r.text) and r.score == "own"
        assert r.doc_id is None or r.text == want[r.doc_id][3].decode("utf-8", "ignore")
    mixed = stage(corpus_pipeline.mix_sources(spark, cut, folder), "mixed")
    assert mixed.columns == columns and max(Counter(r.doc_id for r in mixed.collect() if r.doc_id != 20).values()) <= 2
    final = corpus_pipeline.run(spark, folder)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert Counter(r.doc_id for r in final.collect()) == copies


def test_pipeline_of_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write(spark, tmp_path, [], [])).count() == 0


def test_nothing_is_toxic_without_a_usable_label(spark, tmp_path):
    rows = odd_documents()
    for k, labels in enumerate(([], [(9999, 1, 1)])):
        folder = write(spark, tmp_path / str(k), rows, labels)
        assert corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).count() == len(rows)


def test_labels_of_the_held_out_fold_are_not_used(spark):
    marks = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), held_out("id", 4).cast("int").alias("toxic"))
    docs = documents(spark, [(k, "same words everywhere", None, None, 0) for k in range(1000)])
    weights = toxicity.fit(docs, "doc_id", "text", marks, "doc_id", "toxic", ~held_out("doc_id", 4))
    assert weights[toxicity.BIAS] < -3


def test_the_last_stage_holds_one_python_worker_a_task(spark):
    import corpus_pipeline

    coded = corpus_pipeline.encode(spark, spark.createDataFrame([(1, "a b")], "doc_id long, text string"), "")
    assert coded._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert coded.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
