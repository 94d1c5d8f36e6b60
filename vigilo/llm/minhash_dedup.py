"""MinHash near-duplicates: banded candidates, odd sketches to rule them out, full sets to confirm."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm.common import components, table, text_bytes
from vigilo.llm.shingles import WordHasher, mix
from vigilo.sources.tables import packed, stage

WORDS = 5
#: Samples in bands of rows: at a similarity of 0.75 two sets share no band once in 200,000.
BANDS, ROWS = 32, 4
#: Samples of a signature, of which the first fill the bands, and bits of the sketch they are folded into.
SAMPLES, SKETCH_BITS = 512, 4096
#: Estimates below this are ruled out; it is four standard deviations (0.019) under a similarity of 0.75.
LEAST_ESTIMATE = 0.67
#: Members of a bucket that one tile compares.
TILE = 2048
#: Points (sketch and bands) and pairs (with both texts) of one task.
TASK_POINTS, TASK_PAIRS = 20_000, 2_000

_RNG = np.random.default_rng(7)
_MULTIPLIERS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Smallest value of the set under each of the random maps."""
    low = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 64):
        block = hashes[at:at + 64, None] * _MULTIPLIERS
        block += _ADDENDS
        np.minimum(low, block.min(0), out=low)
    return mix(low)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities: each sample with its number flips one bit, so equal samples cancel in an exclusive or."""
    at = mix(samples + np.arange(len(samples), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(SKETCH_BITS)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=SKETCH_BITS).astype(np.uint8) & 1).view(np.uint64)


def estimate(differing: np.ndarray) -> np.ndarray:
    """Similarity from the population count of the exclusive or of two sketches."""
    share = np.minimum(differing / SKETCH_BITS, 0.499)
    return 1 + SKETCH_BITS * np.log1p(-2 * share) / (4 * SAMPLES)


#: Most differing bits of two sketches that are not ruled out.
MOST_DIFFERING = int(np.flatnonzero(estimate(np.arange(SKETCH_BITS + 1)) >= LEAST_ESTIMATE)[-1])


def band_keys(samples: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + samples[:BANDS * ROWS].reshape(BANDS, ROWS)[:, k])
    return key.view(np.int64)


_PREPARED = "id long, n long, same binary, bands array<long>, sketch array<long>"


def _prepare(batches):
    import pyarrow as pa

    hasher = WordHasher()
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            n, same, bands, sketches = [], [], [], []
            for found in hasher.shingle_sets(text_bytes(part.column(1)), WORDS):
                n.append(len(found))
                if len(found):
                    samples = signature(found)
                    same.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(samples))
                    sketches.append(odd_sketch(samples).view(np.int64))
                else:
                    same.append(None)
                    bands.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
                names=["id", "n", "same", "bands", "sketch"])


def _confirm(batches):
    """Pairs of texts that reach 75 shared of 100 joint shingles, counted on the full sets."""
    import pyarrow as pa

    hasher = WordHasher()
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            sets = [list(hasher.shingle_sets(text_bytes(part.column(k)), WORDS)) for k in (2, 3)]
            keep = []
            for a, b in zip(*sets, strict=True):
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * shared >= 75 * (len(a) + len(b) - shared))
            rows = part.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1)], names=["a", "b"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among ``pairs`` (a, b), which should be staged; ``texts`` has id and text of every member."""
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    both = left.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    return packed(both.select("a", "b", "left", "right"), pairs.count(), TASK_PAIRS).mapInArrow(_confirm, "a long, b long")


def _sketched(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs whose sketches leave a link possible."""
    both = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("s")), "a")
    both = both.join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("t")), "b")
    differing = F.aggregate(F.zip_with("s", "t", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return both.where(differing <= MOST_DIFFERING).select("a", "b")


def _compare(best_only: bool):
    """Pairs of different components that share a bucket and whose sketches leave a link possible.

    A tile holds whole small buckets, or two blocks of a large one (``side`` 0 and 1; 2 where a block meets
    itself). With ``best_only`` each member keeps its nearest partner in each bucket.
    """

    def run(part):
        import pyarrow as pa

        bucket, ids, comp = (np.asarray(part.column(c), dtype=np.int64) for c in ("bucket", "id", "component"))
        side = np.asarray(part.column("side"), dtype=np.int64)
        sketch = np.asarray(part.column("sketch").combine_chunks().flatten(), dtype=np.int64).view(np.uint64).reshape(len(ids), -1)
        order = np.lexsort((ids, bucket))
        bucket, ids, comp, side, sketch = bucket[order], ids[order], comp[order], side[order], sketch[order]
        bands = np.asarray(part.column("bands").combine_chunks().flatten(), dtype=np.int64).reshape(len(order), -1)[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        out_a, out_b = [], []
        for a, b in zip([0, *cuts], [*cuts, len(ids)], strict=True):
            if a == b:
                continue
            s = side[a:b]
            rows, cols = (np.arange(a, b), np.arange(a, b)) if s[0] == 2 else (a + np.flatnonzero(s == 0), a + np.flatnonzero(s == 1))
            if not len(rows) or not len(cols):
                continue
            for at in range(0, len(rows), 256):
                r = rows[at:at + 256]
                differing = np.zeros((len(r), len(cols)), dtype=np.int64)
                for k in range(sketch.shape[1]):
                    differing += np.bitwise_count(sketch[r, k][:, None] ^ sketch[cols, k])
                possible = (comp[r][:, None] != comp[cols]) & (differing <= MOST_DIFFERING)
                if best_only:
                    hit = np.flatnonzero(possible.any(1))
                    i, j = hit, np.where(possible[hit], differing[hit], SKETCH_BITS + 1).argmin(1)
                else:
                    i, j = np.nonzero(possible)
                    # A pair that shares several buckets belongs to the first of them.
                    first = np.concatenate([(bands[r[i[k:k + 4096]]] == bands[cols[j[k:k + 4096]]]).argmax(1) for k in range(0, len(i), 4096)] or [i])
                    own = bands[r[i], first] == bucket[a]
                    i, j = i[own], j[own]
                x, y = ids[r[i]], ids[cols[j]]
                out_a.append(np.minimum(x, y))
                out_b.append(np.maximum(x, y))
        if not out_a:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        pairs = np.unique(np.stack([np.concatenate(out_a), np.concatenate(out_b)], 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _open_pairs(members: DataFrame, reach: DataFrame, sketches: DataFrame, best_only: bool, tested: DataFrame) -> DataFrame:
    """Pairs to confirm: same bucket, different component so far, sketches near enough, not tested before."""
    placed = members.join(reach.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = mixed.where("lo != hi").select("bucket", F.ceil(F.col("n") / TILE).cast("int").alias("cuts"))
    rows = placed.join(mixed, "bucket").join(sketches, "id")
    own = F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")
    # A bucket of one block stays whole, many to a tile; a larger one becomes pairs of blocks.
    others = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda o: F.struct(
        F.least(own, o).alias("p"), F.greatest(own, o).alias("q"), F.when(own == o, 2).when(own < o, 0).otherwise(1).alias("side")))
    dealt = rows.select("bucket", "id", "component", "sketch", "bands", "cuts", F.explode(others).alias("t"))
    bins = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    tile = F.when(F.col("cuts") == 1, F.pmod(F.xxhash64("bucket"), F.lit(bins))).otherwise(F.xxhash64("bucket", "t.p", "t.q"))
    tiles = dealt.select(tile.alias("tile"), "bucket", "id", "component", "sketch", "bands", F.col("t.side").alias("side"))
    pairs = tiles.groupBy("tile").applyInArrow(_compare(best_only), "a long, b long").distinct()
    return pairs.join(tested, ["a", "b"], "left_anti")


def near_duplicates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Texts are linked when 100 times the shared 5-word shingles is at least 75 times the joint ones. Texts
    with the same set are one point. Points that share a band of MinHash samples are candidates; members
    of a bucket first meet its smallest member, links are confirmed on full sets, and components are
    formed. Afterwards only pairs of different components matter: each member's nearest partner by odd
    sketch first, again until nothing joins, then every pair that a sketch cannot rule out. So no pair is
    expanded inside a group that hangs together already, and none that could join two groups is skipped.

    Nulls: a null, empty or blank text has no shingles and links with nothing; a row with a null key is
    returned alone, its component null and ``kept`` false. Texts of any length count whole. Repeated rows
    are equal texts. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    prepared = stage(base.mapInArrow(_prepare, _PREPARED), "signatures")
    reps = prepared.where("same is not null and id is not null").groupBy("same").agg(
        F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    rows = prepared.count()
    reps = stage(packed(reps, rows, TASK_POINTS), "points")
    placed = reps.select("id", F.explode("bands").alias("bucket"))
    shared = placed.groupBy("bucket").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    members = stage(packed(placed.join(shared, "bucket").select("bucket", "id", "first"), BANDS * rows), "buckets")
    many = members.count()
    some = members.select("id").distinct()
    texts = stage(base.where("id is not null").join(some, "id"), "texts")
    sketches = reps.select("id", "sketch", "bands").join(some, "id", "left_semi")

    first = members.where("id != first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    tested = stage(packed(_sketched(first, sketches), many), "pairs")
    links = stage(confirmed(tested, texts), "links")
    members = members.select("bucket", "id")
    reach = components(links, "a", "b")
    best_only = True
    while True:
        pairs = stage(packed(_open_pairs(members, reach, sketches, best_only, tested), many), "pairs")
        found = stage(confirmed(pairs, texts), "links")
        joined = not found.isEmpty()
        if joined:
            links, tested = links.union(found), tested.union(pairs)
            reach = components(links, "a", "b")
        if not best_only:
            break
        best_only = joined
    point = reps.select("same", F.col("id").alias("point")).join(
        reach.select(F.col("node").alias("point"), "component"), "point", "left")
    done = prepared.select("id", "n", "same").join(point, "same", "left")
    group = F.when(F.col("id").isNotNull(), F.coalesce("component", "point", "id"))
    return done.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), group.alias("component_id"),
                       F.coalesce(group == F.col("id"), F.lit(False)).alias("kept"))


def op2_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), "doc_id", "text")
