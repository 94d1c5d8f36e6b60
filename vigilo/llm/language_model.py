"""Hierarchical Pitman-Yor language model: word restaurants under one shared parent, seats by Gibbs sweeps.

The restaurant of a context serves the words that follow it; its tables are the customers of the parent
restaurant, which all contexts share and which itself draws from the uniform distribution. Units of
documents send the words and word pairs they hold to buckets, each pair once with its count, and get
back what the model says of them. Nothing whole is gathered: counts, seats and answers are dealt by word
or by context.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm.common import held_out, shuffle_parts, table
from vigilo.llm.shingles import WordHasher, mix
from vigilo.llm.units import Unit, pack_units, planes, squeeze, unit_rows, unplanes, unsqueeze
from vigilo.sources.tables import stage

#: Sweeps over all seats of a restaurant, of which the first ones are not averaged.
SWEEPS, WARM = 6, 2
#: Concentration of every restaurant.
CONCENTRATION = 1.0
#: Customers seated one by one before the next new table is drawn as a jump.
STEPS = 24
BUCKET_BYTES = 16 << 20
_END, _START = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def discount(counts: np.ndarray) -> float:
    """From how many dishes have one and two customers."""
    one, two = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
    return float(np.clip(one / max(one + 2 * two, 1), 0.05, 0.95))


def seat(customers: np.ndarray, pull: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers left and came back one by one.

    ``pull`` is (concentration + discount · tables) · parent probability of the dish: with n customers at t
    tables the next one opens a table with probability pull / (pull + n - d·t). After ``STEPS`` customers
    the next opening is drawn from the product of those probabilities, n grows by the factor u^(-1/pull).
    """
    tables = np.ones(len(customers))
    todo = np.flatnonzero(customers > 1)
    for n in range(1, STEPS):
        if not len(todo):
            return tables
        rest = n - d * tables[todo]
        tables[todo] += rng.random(len(todo)) * (pull[todo] + rest) < pull[todo]
        todo = todo[customers[todo] > n + 1]
    at = np.full(len(todo), float(STEPS))
    while len(todo):
        taken = d * tables[todo]
        at = taken + (at - taken) * rng.random(len(todo)) ** (-1 / pull[todo]) + 1
        inside = at <= customers[todo]
        todo, at = todo[inside], at[inside]
        tables[todo] += 1
    return tables


def sample_restaurants(customers: np.ndarray, context: np.ndarray, parent: np.ndarray, d: float, seed: int):
    """Averages over the sweeps: each dish's own share, the share left to the parent, and its tables.

    ``context`` numbers the restaurants from 0. A sweep reseats every dish against the tables the others
    had in its restaurant after the sweep before.
    """
    rng, n = np.random.default_rng(seed), int(context.max(initial=-1)) + 1
    total = np.bincount(context, customers, n) + CONCENTRATION
    tables = (customers > 0).astype(float)
    own, left, mean = np.zeros(len(customers)), np.zeros(n), np.zeros(len(customers))
    many = np.flatnonzero(customers > 1)
    for sweep in range(SWEEPS):
        spare = CONCENTRATION + d * np.bincount(context, tables, n)
        tables[many] = seat(customers[many], spare[context[many]] * parent[many], d, rng)
        if sweep >= WARM:
            own += (customers - d * tables) / total[context]
            left += (CONCENTRATION + d * np.bincount(context, tables, n)) / total
            mean += tables
    kept = SWEEPS - WARM
    return own / kept, left / kept, mean / kept


class _Tokens:
    """Tokens of a unit: words and one end per document, with the document of each."""

    def __init__(self, unit: Unit):
        at, texts = np.concatenate([[0], np.cumsum(unit.lengths)]), []
        texts = [unit.text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        hasher, hashes, sizes = WordHasher(), [], []
        for _, part in hasher.groups(texts):
            h, bounds = hasher.words(part)
            hashes.append(h)
            sizes.append(np.diff(bounds))
        size = np.concatenate(sizes) if sizes else np.empty(0, dtype=np.int64)
        words = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        self.size = size + 1
        self.doc = np.repeat(np.arange(len(texts)), self.size)
        self.word = np.full(len(self.doc), _END)
        last = np.zeros(len(self.doc), dtype=bool)
        last[np.cumsum(self.size) - 1] = True
        self.word[~last] = words
        self.before = np.concatenate([[_START], self.word[:-1]]) if len(self.word) else self.word
        self.before[np.cumsum(self.size) - self.size] = _START
        held = np.array([known and is_held_out(i) for i, known in zip(unit.ids.tolist(), unit.known.tolist(), strict=True)], dtype=bool)
        self.learn = ~held[self.doc] if len(held) else held
        # Distinct words and pairs, in the order in which answers come back.
        self.words, self.at_word, self.word_count = self._distinct(self.word)
        self._pairs()

    def _distinct(self, keys):
        found, where = np.unique(keys, return_inverse=True)
        return found, where, np.bincount(where, self.learn, len(found)).astype(np.uint32)

    def _pairs(self):
        context = mix(self.before * _GOLD)
        self.pair = (context & np.uint64(0xFFFFFFFF00000000)) | (mix(self.word ^ _GOLD) >> np.uint64(32))
        self.pairs, self.at_pair, self.pair_count = self._distinct(self.pair)
        self.pair_low = np.zeros(len(self.pairs), dtype=np.uint64)
        self.pair_low[self.at_pair] = context & np.uint64(0xFFFFFFFF)
        self.pair_word = np.zeros(len(self.pairs), dtype=np.int64)
        self.pair_word[self.at_pair] = self.at_word


def _dealt(keys: np.ndarray, buckets: int):
    """Numbers of the keys by bucket, in rising order inside each: (bucket, numbers)."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    at = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(b, order[at[b]:at[b + 1]]) for b in range(buckets) if at[b] < at[b + 1]]


def _split(data: bytes, *kinds) -> list[np.ndarray]:
    n = len(data) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        width = n * np.dtype(k).itemsize
        out.append(unplanes(data[at:at + width], k))
        at += width
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


_ROWS = "unit long, bucket int, data binary"


def _batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["unit", "bucket", "data"])


def _emit_words(buckets: int):
    def run(batches):
        for row in unit_rows(batches):
            t = _Tokens(Unit(row))
            if len(t.words):
                yield _batch([(row["unit"], b, squeeze(planes(_steps(t.words[k])), planes(t.word_count[k]))) for b, k in _dealt(t.words, buckets)])

    return run


def _read_groups(part, *kinds):
    """Per row of a bucket its keys and numbers, and the distinct keys of all with where each one is."""
    units = part.column("unit").to_pylist()
    rows = [_split(unsqueeze(d), np.uint64, *kinds) for d in part.column("data").to_pylist()]
    keys = np.concatenate([np.cumsum(r[0], dtype=np.uint64) for r in rows])
    found, where = np.unique(keys, return_inverse=True)
    at = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])])
    return units, rows, found, where, at


_ANSWERS = "unit long, bucket int, data binary, total double, kinds double, spare double"


def _answer(part, units, blobs, total=0.0, kinds=0.0, spare=0.0):
    import pyarrow as pa

    n = len(units)
    once = lambda x: pa.array([float(x)] + [0.0] * (n - 1))
    return pa.table({"unit": pa.array(units, pa.int64()), "bucket": pa.array([part.column("bucket")[0].as_py()] * n, pa.int32()),
                     "data": pa.array(blobs, pa.binary()), "total": once(total), "kinds": once(kinds), "spare": once(spare)})


def _count_words(part):
    """Counts over all training documents of the words each unit asked for; N and V of the bucket."""
    units, rows, found, where, at = _read_groups(part, np.uint32)
    counts = np.bincount(where, np.concatenate([r[1] for r in rows]), len(found))
    mine = counts[where].astype(np.uint64)
    blobs = [squeeze(planes(mine[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
    return _answer(part, units, blobs, counts.sum(), np.count_nonzero(counts))


def _gathered(answers, name: str, dealt, kinds, n: int) -> list[np.ndarray]:
    """Answers of all buckets put back in the order of the unit's keys."""
    numbers = dict(dealt)
    out = [np.zeros(n, dtype=k) for k in kinds]
    for a in answers:
        if a["name"] == name:
            for whole, part in zip(out, _split(unsqueeze(a["data"]), *kinds), strict=True):
                whole[numbers[a["bucket"]]] = part
    return out


def _emit_pairs(buckets: int, n: float, v: float):
    """Distinct pairs by bucket of their context: key, count, and 1/8 powers of two of the word's share."""

    def run(batches):
        for row in unit_rows(batches):
            t = _Tokens(Unit(row))
            if not len(t.words):
                continue
            (count,) = _gathered(row["answers"], "words", _dealt(t.words, buckets), [np.uint64], len(t.words))
            share = np.minimum(np.rint(-8 * np.log2((count + 1.0) / (n + v + 1))), 255).astype(np.uint8)[t.pair_word]
            yield _batch([(row["unit"], b, squeeze(planes(_steps(t.pairs[k])), planes(t.pair_count[k]), planes(share[k])))
                          for b, k in _dealt(t.pair_low, buckets)])

    return run


def _seat_contexts(part):
    """Restaurants of a bucket. To each unit: own share of a pair, what its context leaves to the parent, and
    tables, which only the first unit that holds a pair is told, so that their sum is right."""
    units, rows, found, where, at = _read_groups(part, np.uint32, np.uint8)
    counts = np.bincount(where, np.concatenate([r[1] for r in rows]), len(found))
    parent = np.zeros(len(found))
    parent[where] = 2.0 ** (np.concatenate([r[2] for r in rows]) / -8.0)
    context = np.unique(found >> np.uint64(32), return_inverse=True)[1]
    own, left, tables = sample_restaurants(counts, context, parent, discount(counts), int(part.column("bucket")[0].as_py()))
    first = np.zeros(len(where), dtype=bool)
    first[np.unique(where, return_index=True)[1]] = True
    # 1/2048 powers of two; 65535 stands for none.
    code = np.where(own > 0, np.minimum(np.rint(-2048 * np.log2(np.maximum(own, 2.0 ** -31))), 65534), 65535).astype(np.uint16)[where]
    leave = np.minimum(np.rint(-2048 * np.log2(np.maximum(left, 2.0 ** -31))), 65534).astype(np.uint16)[context[where]]
    seats = np.where(first, np.rint(tables[where]), 0).astype(np.uint32)
    blobs = [squeeze(planes(code[a:b]), planes(leave[a:b]), planes(seats[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]
    return _answer(part, units, blobs)


def _emit_tables(buckets: int):
    """Tables per word, the customers of the parent restaurant."""

    def run(batches):
        for row in unit_rows(batches):
            t = _Tokens(Unit(row))
            if not len(t.words):
                continue
            seats = _gathered(row["answers"], "pairs", _dealt(t.pair_low, buckets), [np.uint16, np.uint16, np.uint32], len(t.pairs))[2]
            tables = np.bincount(t.pair_word, seats, len(t.words)).astype(np.uint32)
            yield _batch([(row["unit"], b, squeeze(planes(_steps(t.words[k])), planes(tables[k]))) for b, k in _dealt(t.words, buckets)])

    return run


def _seat_parent(v: float):
    def run(part):
        units, rows, found, where, at = _read_groups(part, np.uint32)
        customers = np.bincount(where, np.concatenate([r[1] for r in rows]), len(found))
        d, rng = discount(customers), np.random.default_rng(int(part.column("bucket")[0].as_py()))
        here, total = np.flatnonzero(customers), np.zeros(len(found))
        # The tables of the whole parent restaurant stay at one a word while a bucket is seated.
        pull = np.full(len(here), (CONCENTRATION + d * v) / (v + 1))
        for sweep in range(SWEEPS):
            if sweep >= WARM:
                total[here] += seat(customers[here], pull, d, rng) / (SWEEPS - WARM)
        mass = np.maximum(customers - d * total, 0)
        blobs = [squeeze(planes(mass[where[a:b]])) for a, b in zip(at[:-1], at[1:], strict=True)]
        return _answer(part, units, blobs, customers.sum(), spare=(d * total).sum())

    return run


def _score(buckets: int, n: float, v: float, customers: float, spare: float):
    def run(batches):
        import pyarrow as pa

        for row in unit_rows(batches):
            unit = Unit(row)
            t = _Tokens(unit)
            size = len(unit.ids)
            words = _dealt(t.words, buckets)
            (count,) = _gathered(row["answers"], "words", words, [np.uint64], len(t.words))
            (mass,) = _gathered(row["answers"], "parent", words, [np.float64], len(t.words))
            code, leave, _ = _gathered(row["answers"], "pairs", _dealt(t.pair_low, buckets), [np.uint16, np.uint16, np.uint32], len(t.pairs))
            root = (mass + (CONCENTRATION + spare) / (v + 1)) / (customers + CONCENTRATION)
            own = np.where(code == 65535, 0.0, 2.0 ** (code / -2048.0))
            share = own[t.at_pair] + 2.0 ** (leave[t.at_pair] / -2048.0) * root[t.at_word]
            score = np.bincount(t.doc, np.log10(np.minimum(share, 1.0)), size)
            c = count[t.at_word].astype(float)
            base = np.bincount(t.doc, np.log10((c + 1) / (n + v + 1)), size)
            known = np.bincount(t.doc, c > 0, size).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(unit.ids, pa.int64(), mask=~unit.known), pa.array(t.size), pa.array(known), pa.array(base), pa.array(score)],
                                             names=["id", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row ``id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Learns from the documents whose crc32 of the id leaves other than 2 modulo 7 and scores all. ``score``
    is the log10 probability of the whole text, averaged over the sweeps; ``base_score`` that of single
    words with one added to every count. The context of a word is the word before it.

    Nulls: a null or empty text is one end token; a row with a null id is learned from and scored. Repeated
    rows count as often as they occur, texts of any length whole. Without any training document N and V
    are 0 and every word is as likely as any other. An empty table gives no rows; other columns are not read.
    """
    units, size = pack_units(docs, key, text)
    buckets = max(shuffle_parts(docs.sparkSession), -(-size // BUCKET_BYTES))

    def answered(*named: tuple[str, DataFrame]) -> DataFrame:
        every = None
        for name, df in named:
            one = df.select("unit", F.struct(F.lit(name).alias("name"), "bucket", "data").alias("a"))
            every = one if every is None else every.union(one)
        return units.join(every.groupBy("unit").agg(F.collect_list("a").alias("answers")), "unit")

    words = stage(units.mapInArrow(_emit_words(buckets), _ROWS).groupBy("bucket").applyInArrow(_count_words, _ANSWERS), "words")
    sums = words.agg(F.sum("total"), F.sum("kinds")).first()
    n, v = sums[0] or 0.0, sums[1] or 0.0
    pairs = answered(("words", words)).mapInArrow(_emit_pairs(buckets, n, v), _ROWS)
    pairs = stage(pairs.groupBy("bucket").applyInArrow(_seat_contexts, _ANSWERS), "pairs")
    tables = answered(("pairs", pairs)).mapInArrow(_emit_tables(buckets), _ROWS)
    parent = stage(tables.groupBy("bucket").applyInArrow(_seat_parent(v), _ANSWERS), "parent")
    sums = parent.agg(F.sum("total"), F.sum("spare")).first()
    scored = answered(("words", words), ("pairs", pairs), ("parent", parent)).mapInArrow(
        _score(buckets, n, v, sums[0] or 0.0, sums[1] or 0.0), "id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("id", "n_tokens", "n_known", F.lit(int(n)).cast("long").alias("train_tokens"), "base_score", "score")


def op8_language_model(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_documents(table(spark, folder, "documents"), "doc_id", "text")
    return scored.select(F.col("id").alias("doc_id"), held_out("id", 7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
