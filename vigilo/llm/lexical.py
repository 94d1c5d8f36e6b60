"""Ranked lexical search: posting lists cut into blocks of similar documents, skipped by exact bounds."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilo.llm.common import batches_of, table, text_bytes
from vigilo.llm.units import planes, squeeze, unit_rows, unplanes, unsqueeze
from vigilo.sources.tables import stage

#: Bytes of a term: A-Z lower-cased, digits, letters and all of non-ASCII kept, the rest gaps.
_TERM_BYTES = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
#: A query set with at most so many terms and bytes of them is sent as it is; of a larger one, bits of its terms' crc32.
SENT_TERMS, SENT_BYTES = 1 << 16, 1 << 21
#: Those bits; their number is fixed.
BITS = 1 << 20
#: A shard is closed at so many documents, or so many pairs of terms inside documents, which bounds its summaries.
SHARD_DOCS, SHARD_PAIRS = 512, 1 << 24
#: Lists that a search takes together: few at first, to find a threshold, then more.
FIRST_LISTS, NEXT_LISTS = 2, 8
#: Lists whose blocks are summed up together; their tables hold that many rows of all terms at most.
LISTS = 64
#: Documents of a block, about.
BLOCK = 128
#: Directions onto which documents are projected to compare them.
DIRECTIONS = 32
#: Terms of the items searched in one job, about; they travel with the job.
ASKED_TERMS = 1 << 16
#: Shards that one task builds and one file holds, about.
TOGETHER = 8
#: Documents that go to Python at a time.
READ_DOCS = 64
#: A null id sorts behind all others.
_NO_ID = np.iinfo(np.int64).max
#: Bytes of a text that are split into terms at a time.
PART = 1 << 22


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a part of it at a time; parts end between terms."""
    clean, at = text.translate(_TERM_BYTES), 0
    while at < len(clean):
        end = at + PART
        if end < len(clean):
            cut = clean.find(b" ", end)
            end = len(clean) if cut < 0 else cut
        yield clean[at:end].split()
        at = end


def _item_terms(batches):
    import pyarrow as pa

    for batch in batches:
        ids, terms = [], []
        for key, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
            found = {t for part in terms_of(text) for t in part}
            ids += [key] * len(found)
            terms += sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item", "term"])


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item`` and ``term``, once each; rows of one id are one item, a null text has no terms."""
    base = items.select(F.col(key).cast("long").alias("item"), F.col(text).cast("string").alias("text"))
    return base.mapInArrow(_item_terms, "item long, term binary").distinct()


def asked_filter(terms: DataFrame) -> set[bytes] | np.ndarray:
    """What tells the documents' tasks which terms are asked for: of fixed size at most, and exact or a superset."""
    terms = terms.select("term").distinct()
    size = terms.agg(F.count("*"), F.sum(F.length("term"))).first()
    if size[0] <= SENT_TERMS and (size[1] or 0) <= SENT_BYTES:
        return {bytes(r[0]) for r in terms.collect()}
    bits = np.zeros(BITS, dtype=bool)
    bits[[r[0] for r in terms.select((F.crc32("term") % BITS).cast("int")).distinct().collect()]] = True
    return bits


def _pack_shards(asked: set[bytes] | np.ndarray | None):
    """Documents as sparse rows of term counts, packed into shards; ``asked`` holds the terms to keep, or marks their crc32."""

    def run(batches):
        import pyarrow as pa

        known: dict[bytes, bool] = {}

        def marked(term: bytes) -> bool:
            found = known.get(term)
            if found is None:
                if len(known) > 500_000:
                    known.clear()
                found = known[term] = bool(asked[zlib.crc32(term) % BITS])
            return found

        ids, sizes, lengths, terms, counts, pairs, held, words = [], [], [], [], [], 0, 0, 0

        def row():
            vocabulary = sorted(set(terms))
            number = {t: k for k, t in enumerate(vocabulary)}
            at = np.fromiter((number[t] for t in terms), dtype=np.int32, count=len(terms))
            arrays = (np.array([_NO_ID if k is None else k for k in ids], dtype=np.int64), np.array(sizes, dtype=np.int64), np.array(lengths, dtype=np.int64), at, np.array(counts, dtype=np.int64))
            packed = [pa.array([squeeze(planes(x) if len(x) else b"")], pa.binary()) for x in arrays]
            frequency = np.bincount(at, minlength=len(vocabulary)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [*packed, pa.array([vocabulary], pa.list_(pa.binary())), pa.array([frequency], pa.list_(pa.int64())), pa.array([held], pa.int64()), pa.array([words], pa.int64())],
                names=["ids", "sizes", "lengths", "at", "counts", "terms", "df", "docs", "words"])

        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                for key, text in zip(part.column(0).to_pylist(), text_bytes(part.column(1)), strict=True):
                    seen: Counter[bytes] = Counter()
                    n = 0
                    for some in terms_of(text):
                        seen.update(some)
                        n += len(some)
                    held, words = held + (n > 0), words + n
                    kept = sorted(seen if asked is None else seen.keys() & asked if isinstance(asked, set) else filter(marked, seen))
                    if not kept:
                        continue
                    if ids and pairs + len(kept) ** 2 > SHARD_PAIRS:
                        yield row()
                        ids, sizes, lengths, terms, counts, pairs, held, words = [], [], [], [], [], 0, 0, 0
                    ids.append(key)
                    sizes.append(n)
                    lengths.append(len(kept))
                    terms += kept
                    counts += [seen[t] for t in kept]
                    pairs += len(kept) ** 2
                    if len(ids) >= SHARD_DOCS:
                        yield row()
                        ids, sizes, lengths, terms, counts, pairs, held, words = [], [], [], [], [], 0, 0, 0
        if ids or held:
            yield row()
        pa.default_memory_pool().release_unused()

    return run


_SHARD = "ids binary, sizes binary, lengths binary, at binary, counts binary, terms array<binary>, df array<bigint>, docs long, words long"


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Numbers of all entries of ranges, one range after the other."""
    total = int(length.sum())
    kind = np.int32 if total < 1 << 31 and (not len(start) or start[-1] < 1 << 31 and start.max() < 1 << 31) else np.int64
    jump = np.repeat((start - (np.cumsum(length) - length)).astype(kind), length)
    jump += np.arange(total, dtype=kind)
    return jump


class Shard:
    """Rows of impacts, and per term blocks of similar documents with the largest impact of every term in them."""

    NAMES = ("ids", "ptr", "at", "impact", "list_ptr", "list_max", "block_ptr", "block_docs", "sum_ptr", "sum_at", "sum_max")
    KINDS = dict.fromkeys(NAMES, np.int64) | {"at": np.int32, "impact": np.int32, "block_docs": np.int32, "sum_at": np.int32, "sum_max": np.int32}
    #: Arrays that rise along a row, list or summary, and those of impacts.
    RISING = ("ptr", "at", "list_ptr", "block_ptr", "sum_ptr", "sum_at")
    IMPACTS = ("impact", "sum_max")

    def __init__(self, terms: list[bytes], arrays: dict[str, np.ndarray]):
        self.terms, self.number = terms, {t: k for k, t in enumerate(terms)}
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, terms: list[bytes], ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, at: np.ndarray, counts: np.ndarray, docs: int, words: int, block: int = BLOCK) -> Shard:
        """Impacts by the totals of the whole table (``docs`` with a term, ``words`` in all), and the blocks."""
        m = 10 + (90 * sizes * docs) // max(words, 1)
        impact = ((1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(m, lengths))).astype(np.int32)
        ptr = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        owner = np.repeat(np.arange(len(ids)), lengths)
        by_term = np.argsort(at, kind="stable")
        list_ptr = np.searchsorted(at[by_term], np.arange(len(terms) + 1))
        place = cls._places(len(ids), len(terms), ptr, at, impact, np.diff(list_ptr))
        list_max = np.maximum.reduceat(impact[by_term], list_ptr[:-1]).astype(np.int64) if len(terms) else np.empty(0, dtype=np.int64)
        list_blocks, block_sizes, block_docs, sum_sizes, sum_at, sum_max = [0], [], [], [], [], []
        for first in range(0, len(terms), LISTS):
            docs_of, sizes_of = [], []
            for t in range(first, min(first + LISTS, len(terms))):
                ordered, cut = cls._cut(owner[by_term[list_ptr[t]:list_ptr[t + 1]]], place, block)
                docs_of.append(ordered)
                sizes_of.append(np.diff(np.append(cut, len(ordered))))
                list_blocks.append(list_blocks[-1] + len(cut))
            docs_now, sizes_now = np.concatenate(docs_of), np.concatenate(sizes_of)
            block_docs.append(docs_now)
            block_sizes.append(sizes_now)
            # The summary of one document is its own row, which is not kept twice.
            big = sizes_now > 1
            wide = docs_now[np.repeat(big, sizes_now)]
            number = np.repeat(np.arange(int(big.sum())), sizes_now[big])
            sums = np.zeros(len(sizes_now), dtype=np.int64)
            sums[big], some_at, some_max = cls._largest(wide, number, ptr, lengths, at, impact, len(terms))
            sum_sizes.append(sums)
            sum_at.append(some_at)
            sum_max.append(some_max)

        def run_ptr(parts):
            return np.concatenate([[0], np.cumsum(np.concatenate([*parts, np.empty(0, np.int64)]))]).astype(np.int64)

        join = lambda parts: np.concatenate([*parts, np.empty(0, np.int32)]).astype(np.int32)
        return cls(terms, {
            "ids": ids, "ptr": ptr, "at": at, "impact": impact, "list_ptr": np.array(list_blocks, dtype=np.int64),
            "list_max": list_max, "block_ptr": run_ptr(block_sizes), "block_docs": join(block_docs),
            "sum_ptr": run_ptr(sum_sizes), "sum_at": join(sum_at), "sum_max": join(sum_max)})

    @staticmethod
    def _largest(docs, number, ptr, lengths, at, impact, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per group of documents (``number``, ascending) how many terms it holds, those terms, and their largest impacts."""
        sizes, places, tops = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        first, last = 0, number[-1] + 1 if len(number) else 0
        while first < last:
            # As many groups as a table of a fixed size has room for.
            end = min(last, first + max(1, (1 << 19) // max(terms, 1)))
            part = slice(*np.searchsorted(number, (first, end)))
            entry = _ranges(ptr[docs[part]], lengths[docs[part]])
            top = np.zeros((end - first) * terms, dtype=np.int32)
            cell = np.repeat(((number[part] - first) * terms).astype(np.int32), lengths[docs[part]])
            cell += at[entry]
            np.maximum.at(top, cell, impact[entry])
            there = np.flatnonzero(top)
            sizes.append(np.bincount(there // terms, minlength=end - first))
            places.append((there % terms).astype(np.int32))
            tops.append(top[there].astype(np.int32))
            first = end
        return np.concatenate(sizes), np.concatenate(places), np.concatenate(tops)

    @staticmethod
    def _places(docs: int, terms: int, ptr, at, impact, frequency) -> np.ndarray:
        """A point of length one for every document: its impacts, rarer terms weighing more, on random directions."""
        rng = np.random.default_rng(docs)
        directions = rng.standard_normal((terms, DIRECTIONS)).astype(np.float32) * np.log1p(docs / np.maximum(frequency, 1))[:, None].astype(np.float32)
        out = np.zeros((docs, DIRECTIONS), dtype=np.float32)
        for a in range(0, docs, 512):
            b = min(a + 512, docs)
            part = slice(ptr[a], ptr[b])
            out[a:b] = np.add.reduceat(directions[at[part]] * impact[part, None].astype(np.float32), ptr[a:b] - ptr[a], axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-20)

    @staticmethod
    def _cut(docs_of: np.ndarray, place: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents of a list ordered by blocks, and where blocks begin: each goes to the nearest of evenly taken centres."""
        k = -(-len(docs_of) // block)
        if k < 2:
            return docs_of, np.zeros(min(len(docs_of), 1), dtype=np.int64)
        centres = place[docs_of[(np.arange(k) * len(docs_of)) // k]]
        nearest = (place[docs_of] @ centres.T).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        begin = np.flatnonzero(np.diff(nearest[order], prepend=-1))
        size = np.diff(np.append(begin, len(order)))
        # A cluster of more than two blocks is cut into blocks.
        pieces = np.where(size > 2 * block, -(-size // block), 1)
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        return docs_of[order], np.repeat(begin, pieces) + inner * block

    def pack(self) -> bytes:
        """The arrays, each compressed by itself: rising numbers as steps, impacts as places among the shard's distinct impacts."""
        values = np.unique(self.impact)
        parts = [squeeze(planes(values) if len(values) else b"")]
        for name, kind in self.KINDS.items():
            numbers = np.ascontiguousarray(getattr(self, name), dtype=kind)
            if name in self.RISING:
                numbers = np.diff(numbers, prepend=numbers.dtype.type(0))
            elif name in self.IMPACTS:
                numbers = np.searchsorted(values, numbers).astype(kind)
            parts.append(squeeze(planes(numbers) if len(numbers) else b""))
        return b"".join([*(len(p).to_bytes(8, "little") for p in parts), *parts])

    @classmethod
    def unpack(cls, terms: list[bytes], blob: bytes) -> Shard:
        whole, arrays, values = memoryview(blob), {}, None
        at = 8 * (len(cls.KINDS) + 1)
        for k, (name, kind) in enumerate([("", np.int32), *cls.KINDS.items()]):
            size = int.from_bytes(whole[8 * k:8 * k + 8], "little")
            data = unsqueeze(whole[at:at + size])
            numbers = unplanes(data, kind) if data else np.empty(0, dtype=kind)
            if not name:
                values = numbers
            elif name in cls.RISING:
                arrays[name] = np.cumsum(numbers, dtype=kind)
            else:
                arrays[name] = values[numbers] if name in cls.IMPACTS else numbers
            at += size
        return cls(terms, arrays)

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        lengths = self.ptr[docs + 1] - self.ptr[docs]
        entry = _ranges(self.ptr[docs], lengths)
        return np.add.reduceat(weight[self.at[entry]] * self.impact[entry], np.cumsum(lengths) - lengths)

    def search(self, asked: list[tuple[bytes, int]], best: tuple[np.ndarray, np.ndarray], k: int, tally: Counter | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``best`` (scores and ids, best first) with the documents of this shard that belong among the first ``k``.

        Lists are taken by their largest possible share of a score, a few together. Once all lists that are left cannot
        reach the k-th best score together, no unseen document can. A block is passed over only when
        the product of its summary with the weights stays below that score.
        """
        here = [(self.number[t], w) for t, w in asked if t in self.number and w > 0]
        if not here:
            return best
        weight = np.zeros(len(self.terms), dtype=np.int64)
        for t, w in here:
            weight[t] = w
        here.sort(key=lambda x: (-x[1] * int(self.list_max[x[0]]), x[0]))
        lists = np.array([t for t, _ in here])
        share = np.array([w * int(self.list_max[t]) for t, w in here])
        left = np.append(np.cumsum(share[::-1])[::-1], 0)
        seen = np.zeros(len(self.ids), dtype=bool)
        least = int(best[0][k - 1]) if len(best[0]) >= k else 1
        at = 0
        while at < len(lists) and left[at] >= least:
            now = lists[at:at + (NEXT_LISTS if at else FIRST_LISTS)]
            at += len(now)
            blocks = _ranges(self.list_ptr[now], self.list_ptr[now + 1] - self.list_ptr[now])
            begin, size = self.sum_ptr[blocks], self.sum_ptr[blocks + 1] - self.sum_ptr[blocks]
            # A block of one document is its own summary: its bound is its score, which is worked out below.
            bound = np.full(len(blocks), np.iinfo(np.int64).max)
            wide = np.flatnonzero(size)
            if len(wide):
                entry = _ranges(begin[wide], size[wide])
                bound[wide] = np.add.reduceat(weight[self.sum_at[entry]] * self.sum_max[entry], np.cumsum(size[wide]) - size[wide])
            kept = blocks[bound >= least]
            if tally is not None:
                tally["blocks"] += len(blocks)
                tally["read"] += len(kept)
            if not len(kept):
                continue
            fresh = np.zeros(len(seen), dtype=bool)
            fresh[self.block_docs[_ranges(self.block_ptr[kept], self.block_ptr[kept + 1] - self.block_ptr[kept])]] = True
            docs = np.flatnonzero(fresh & ~seen)
            if len(docs):
                seen[docs] = True
                found = self.scores(docs, weight)
                fine = np.flatnonzero(found >= least)
                all_scores, all_ids = np.concatenate([best[0], found[fine]]), np.concatenate([best[1], self.ids[docs[fine]]])
                top = np.lexsort((all_ids, -all_scores))[:k]
                best = all_scores[top], all_ids[top]
                least = int(best[0][k - 1]) if len(best[0]) >= k else 1
        if tally is not None:
            tally["docs"] += int(seen.sum())
        return best


def _read_shard(row: dict) -> tuple:
    arrays = []
    for name, kind in (("ids", np.int64), ("sizes", np.int64), ("lengths", np.int64), ("at", np.int32), ("counts", np.int64)):
        data = unsqueeze(row[name])
        arrays.append(unplanes(data, kind) if data else np.empty(0, dtype=kind))
    return row["terms"], *arrays


def build_index(docs: DataFrame, key: str, text: str, asked: set[bytes] | np.ndarray | None = None) -> tuple[DataFrame, DataFrame, int, int]:
    """Shards of the index, document frequencies (``term``, ``df``), and the documents and terms counted.

    A shard holds documents that lie in one input partition, up to a bound, so neither a term nor a source is ever gathered in
    one place. Without ``asked`` all terms are indexed; with it (see :func:`asked_filter`) those that may be asked for. Lengths and totals count all terms always.
    """
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    with batches_of(docs.sparkSession, READ_DOCS):
        shards = stage(base.mapInArrow(_pack_shards(asked), _SHARD), "shards")
    total = shards.agg(F.sum("docs"), F.sum("words"), F.count("*")).first()
    held, words, parts = int(total[0] or 0), int(total[1] or 0), max(1, -(-total[2] // TOGETHER))
    frequency = shards.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("df"))

    def build(batches):
        import pyarrow as pa

        for row in unit_rows(batches):
            terms, *arrays = _read_shard(row)
            if len(arrays[0]):
                shard = Shard.build(terms, *arrays, held, words)
                yield pa.RecordBatch.from_arrays([pa.array([terms], pa.list_(pa.binary())), pa.array([shard.pack()], pa.binary())], names=["terms", "shard"])
            del arrays
            pa.default_memory_pool().release_unused()

    with batches_of(docs.sparkSession, 1):
        index = stage(shards.repartition(parts).mapInArrow(build, "terms array<binary>, shard binary"), "index")
    return index, frequency, held, words


def search_index(index: DataFrame, weighted: DataFrame, k: int) -> DataFrame:
    """``item``, ``doc`` and ``score``: the best ``k`` of each task of the index. ``weighted`` holds ``item``, ``term``, ``w``.

    Items go with the job in blocks of about ``ASKED_TERMS`` terms; each block reads the index once.
    """
    spark = index.sparkSession
    weighted = stage(weighted, "asked")
    size = weighted.agg(F.count("*"), F.countDistinct("item")).first()
    blocks = max(1, math.ceil(size[0] / ASKED_TERMS))
    out = spark.createDataFrame([], "item long, doc long, score long")
    for number in range(blocks):
        mine = weighted.where(F.pmod(F.xxhash64(F.lit("items"), "item"), F.lit(blocks)) == number)
        items: dict[int | None, list] = {}
        for r in mine.orderBy("item", "term").collect():
            items.setdefault(r.item, []).append((bytes(r.term), r.w))

        def run(batches, items=items):
            import pyarrow as pa

            best = {item: (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)) for item in items}
            for row in unit_rows(batches):
                shard = Shard.unpack(row["terms"], row["shard"])
                for item, asked in items.items():
                    best[item] = shard.search(asked, best[item], k)
                del shard, row
                pa.default_memory_pool().release_unused()
            for item, (score, ids) in best.items():
                if len(ids):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([item] * len(ids), pa.int64()), pa.array([None if x == _NO_ID else int(x) for x in ids], pa.int64()), pa.array(score, pa.int64())], names=["item", "doc", "score"])

        with batches_of(spark, 1):
            out = out.unionByName(stage(index.mapInArrow(run, "item long, doc long, score long"), "found"))
    return out


def rank_documents(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, *, k: int = 10) -> DataFrame:
    """Per item its ``k`` best documents: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` (above 0).

    Null and empty texts have no terms: such documents are found by nothing, such items find nothing. Every row of ``docs``
    is a document, also if it repeats another; equal scores come by ascending id, a null id last. An empty table on either
    side gives no rows. Other columns are not read.
    """
    asked = stage(item_terms(items, item_key, item_text), "terms")
    index, frequency, held, _ = build_index(docs, key, text, asked_filter(asked))
    weight = F.floor(1000 * F.log((2 * F.lit(held) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = asked.join(frequency, "term").select("item", "term", weight.alias("w"))
    found = search_index(index, weighted, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "benchmark"), "item_id", "text")


OP13_SQL = r"""WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
held AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, total GROUP BY term, docs),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10
"""
