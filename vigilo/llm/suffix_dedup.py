"""Suffix-array deduplication: repeated 50-byte strings by column-wise construction over buckets of segments.

Documents are packed into units. Every 50-byte window has a smallest 20-byte string (its minimizer); the
windows that follow each other with the same one form a run. Equal windows have equal minimizers and share
35 bytes around them, so runs whose surroundings occur in one document only are left aside. The others go,
cut to the windows in question, to a bucket chosen by the minimizer, where all strings of the bucket are
sorted together. A frequent minimizer's runs are halved and dealt by their surroundings, frequent surroundings
window by window; whatever decides is inside the window, so equal windows always meet. Each round of a bucket
prepends two symbols and updates the order of all suffixes that hold a whole window, as far as a window reaches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from vigilo.llm.common import shuffle_parts, table
from vigilo.llm.shingles import mix
from vigilo.llm.units import Unit, pack_units, planes, squeeze, unit_rows, unplanes, unsqueeze
from vigilo.sources.tables import stage

WINDOW, SEED = 50, 20
_RUN = WINDOW - SEED + 1
_SIDE = _RUN // 2
#: Bytes of all texts for each bucket of keys and of segments.
BUCKET_BYTES = 8 << 20
#: Bytes hashed in one go.
_CHUNK = 1 << 18
#: Occurrences from which a minimizer's windows are dealt by the key they hold, and a key's one by one, by their own hash.
HOT = 20_000
_END = 255
_BASE = 0x9E3779B97F4A7C15 | 1
_FAR = np.iinfo(np.int64).max


def _powers(base: int) -> np.ndarray:
    out = np.full(_CHUNK + 2 * WINDOW, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _rolling(raw: np.ndarray, size: int, power: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Hashes of all strings of ``size`` bytes."""
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], out=total[1:])
    n = max(len(raw) - size + 1, 0)
    return mix((total[size:size + n] - total[:n]) * inverse[:n])


def runs(raw: np.ndarray, lengths: np.ndarray, skip: np.ndarray):
    """Runs of windows of the texts that lie one after the other in ``raw``.

    Arrays of the first and last window, the minimizer's position, its hash, the document's number, and
    the keys of the 35 bytes that end and that begin with the minimizer (0 where no window holds them).
    """
    out = []
    power, inverse = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
    starts = np.cumsum(lengths) - lengths
    doc = 0
    while doc < len(lengths):
        # Neighbouring texts together; a long text in parts that share all but one byte of a window.
        a, b = int(starts[doc]), int(starts[doc] + lengths[doc])
        if b - a > _CHUNK:
            first = last = doc
            parts = [(x, min(x + _CHUNK, b)) for x in range(a, b - WINDOW + 1, _CHUNK - WINDOW + 1)]
        else:
            first = doc
            last = max(int(np.searchsorted(starts + lengths, a + _CHUNK, side="right")) - 1, doc)
            parts = [(a, int(starts[last] + lengths[last]))]
        for x, y in parts:
            if y - x < WINDOW:
                continue
            part = raw[x:y]
            h = _rolling(part, SEED, power, inverse)
            packed = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
            low, reach = packed, 1
            while reach * 2 <= _RUN:
                low, reach = np.minimum(low[:-reach], low[reach:]), reach * 2
            low = np.minimum(low[:len(packed) - _RUN + 1], low[_RUN - reach:])
            at = (low & np.uint64(0xFFFFFF)).astype(np.int64)
            inside = np.zeros(len(at) + 1, dtype=np.int32)
            here = np.arange(first, last + 1)
            begin = np.maximum(starts[here], x) - x
            stop = np.minimum(starts[here] + lengths[here], y) - x - WINDOW + 1
            good = (stop > begin) & ~skip[here]
            np.add.at(inside, begin[good], 1)
            np.add.at(inside, stop[good], -1)
            valid = np.cumsum(inside)[:-1] > 0
            edge = np.ones(len(at), dtype=bool)
            edge[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1])
            s = np.flatnonzero(edge)
            e = np.append(s[1:], len(at)) - 1
            s, e = s[valid[s]], e[valid[s]]
            if not len(s):
                continue
            p = at[s]
            left, right = s <= p - _SIDE, e >= p - _SIDE
            pair = lambda k: mix(h[k] * np.uint64(0xD1342543DE82EF95) + h[k + _SIDE])
            left_key = np.where(left, pair(np.maximum(p - _SIDE, 0)) | np.uint64(1), np.uint64(0))
            right_key = np.where(right, mix(pair(np.minimum(p, len(h) - _SIDE - 1)) ^ np.uint64(_BASE)) | np.uint64(1), np.uint64(0))
            out.append((s + x, e + x, p + x, h[p], np.searchsorted(starts, s + x, side="right") - 1, left_key, right_key))
        doc = last + 1
    if not out:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none, none.astype(np.uint64), none.astype(np.uint64)
    s, e, p, h, d, left, right = (np.concatenate(x) for x in zip(*out, strict=True))
    # Empty texts begin where the next one does: the last text that begins there holds the window.
    return s, e, p, h, d, left, right


def _runs_of(unit: Unit):
    return runs(unit.raw, unit.lengths, ~unit.known)


def _by_bucket(keys: np.ndarray, buckets: int):
    """Distinct keys as bucket and 32-bit rest, sorted by both, with where each key came from."""
    bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint64)
    return np.unique((bucket << np.uint64(32)) | (keys >> np.uint64(1) & np.uint64(0xFFFFFFFF)), return_inverse=True)


def _cuts(sorted_keys: np.ndarray):
    """Slices of equal upper halves."""
    high = (sorted_keys >> np.uint64(32)).astype(np.int64)
    at = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1, [len(high)]])
    return [(int(high[a]), int(a), int(b)) for a, b in zip(at[:-1], at[1:], strict=True) if b > a]


def _unit_keys(h: np.ndarray, left: np.ndarray, right: np.ndarray, buckets: int):
    """Distinct left and right keys and minimizers, and where those of the runs are among them."""
    has_left, has_right = np.flatnonzero(left), np.flatnonzero(right)
    keys, where = _by_bucket(np.concatenate([left[has_left], right[has_right], mix(h ^ np.uint64(_BASE))]), buckets)
    return keys, where, has_left, has_right


def _emit_keys(buckets: int):
    def run(batches):
        import pyarrow as pa

        for row in unit_rows(batches):
            _, _, _, h, doc, left, right = _runs_of(Unit(row))
            keys, where, has_left, has_right = _unit_keys(h, left, right, buckets)
            docs = np.concatenate([doc[has_left], doc[has_right], doc])
            low, high = np.full(len(keys), _FAR), np.full(len(keys), -1)
            np.minimum.at(low, where, docs)
            np.maximum.at(high, where, docs)
            count = np.minimum(np.bincount(where, minlength=len(keys)), 32767).astype(np.uint16) * np.uint16(2) + (low != high).astype(np.uint16)
            cuts = _cuts(keys)
            rest = keys.astype(np.uint32)
            blobs = [planes(np.diff(rest[a:b], prepend=np.uint32(0)).astype(np.uint32)) for _, a, b in cuts]
            counts = [planes(count[a:b]) for _, a, b in cuts]
            yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in cuts], pa.int32()), pa.array([row["unit"]] * len(cuts), pa.int64()),
                                              pa.array(blobs, pa.binary()), pa.array(counts, pa.binary())], names=["bucket", "unit", "keys", "counts"])

    return run


def _find_shared(most: int):
    """For each unit which of its keys in a bucket occur in two documents, and which occur ``most`` times or more."""

    def run(part):
        import pyarrow as pa

        units = part.column("unit").to_pylist()
        keys = [np.cumsum(unplanes(k, np.uint32), dtype=np.uint32) for k in part.column("keys").to_pylist()]
        counts = np.concatenate([unplanes(c, np.uint16) for c in part.column("counts").to_pylist()])
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        docs = np.bincount(where, 1 + (counts & 1))
        often = np.bincount(where, counts >> 1)
        shared, hot = (docs >= 2)[where], (often >= most)[where]
        out, at = [], 0
        for unit, own in zip(units, keys, strict=True):
            mine = shared[at:at + len(own)]
            if mine.any():
                out.append((unit, np.packbits(mine).tobytes(), np.packbits(hot[at:at + len(own)] & mine).tobytes()))
            at += len(own)
        bucket = part.column("bucket")[0].as_py()
        return pa.table({"unit": pa.array([o[0] for o in out], pa.int64()), "bucket": pa.array([bucket] * len(out), pa.int32()),
                         "shared": pa.array([o[1] for o in out], pa.binary()), "hot": pa.array([o[2] for o in out], pa.binary())})

    return run


_SEGMENTS = "unit long, bucket int, first binary, second binary, third binary, data binary"


def _emit_segments(buckets: int):
    """Distinct segments of a unit by bucket (lengths, smallest ids, numbers, bytes), and where they occur.

    The row without a bucket holds the occurrences: document number, start, and segment number.
    """

    def run(batches):
        import pyarrow as pa

        for row in unit_rows(batches):
            unit = Unit(row)
            s, e, p, h, doc, left, right = _runs_of(unit)
            keys, where, has_left, has_right = _unit_keys(h, left, right, buckets)
            shared, hot = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
            cuts = {b: (x, y) for b, x, y in _cuts(keys)}
            for answer in row["answers"]:
                x, y = cuts[answer["bucket"]]
                for bits, name in ((shared, "shared"), (hot, "hot")):
                    bits[x:y] = np.unpackbits(np.frombuffer(answer[name], dtype=np.uint8), count=y - x)
            flags = np.zeros((5, len(s)), dtype=bool)
            n, m = len(has_left), len(has_left) + len(has_right)
            flags[0, has_left], flags[1, has_right] = shared[where[:n]], shared[where[n:m]]
            flags[2, has_left], flags[3, has_right], flags[4] = hot[where[:n]], hot[where[n:m]], hot[where[m:]]
            keep = np.flatnonzero(flags[0] | flags[1])
            # Windows that the shared surroundings can belong to.
            first = np.where(flags[0, keep], s[keep], np.maximum(s[keep], p[keep] - _SIDE))
            last = np.where(flags[1, keep], e[keep], np.minimum(e[keep], p[keep] - _SIDE))
            deal, number = h[keep], doc[keep]
            often = flags[4, keep]
            if often.any():
                # Equal windows can lie in unequal runs: each is dealt by what it holds itself, up to ``mid`` the left key.
                mid, at = (p[keep] - _SIDE)[often], keep[often]
                halves = ((first[often], np.minimum(last[often], mid), left[at], flags[2, at]),
                          (np.maximum(first[often], mid + 1), last[often], right[at], flags[3, at]))
                parts = [(first[~often], last[~often], deal[~often], number[~often])]
                for a, b, key, single in halves:
                    whole, single = (a <= b) & ~single, (a <= b) & single
                    parts.append((a[whole], b[whole], key[whole], doc[at[whole]]))
                    size = (b - a + 1)[single]
                    each = np.repeat(a[single], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    own = np.array([int.from_bytes(hashlib.blake2b(unit.text[k:k + WINDOW], digest_size=8).digest(), "little") for k in each.tolist()], dtype=np.uint64)
                    parts.append((each, each, own, np.repeat(doc[at[single]], size)))
                first, last, deal, number = (np.concatenate(x) for x in zip(*parts, strict=True))
            bucket = (deal >> np.uint64(40)) % np.uint64(buckets)
            found: dict[tuple[int, bytes], int] = {}
            which = np.empty(len(first), dtype=np.int32)
            low: list[int] = []
            for k, (b, x, y, i) in enumerate(zip(bucket.tolist(), first.tolist(), (last + WINDOW).tolist(), unit.ids[number].tolist(), strict=True)):
                j = found.setdefault((b, unit.text[x:y]), len(found))
                which[k] = j
                if j == len(low):
                    low.append(i)
                elif i < low[j]:
                    low[j] = i
            groups: dict[int, list[tuple[bytes, int]]] = {}
            for (b, text), j in found.items():
                groups.setdefault(b, []).append((text, j))
            out = [(None, number.astype(np.int32).tobytes(), first.astype(np.int64).tobytes(), which.tobytes(), b"")]
            for b, members in groups.items():
                out.append((b, np.array([len(t) for t, _ in members], dtype=np.int32).tobytes(), np.array([low[j] for _, j in members], dtype=np.int64).tobytes(),
                            np.array([j for _, j in members], dtype=np.int32).tobytes(), b"".join(t for t, _ in members)))
            yield pa.RecordBatch.from_arrays([pa.array([row["unit"]] * len(out), pa.int64()), pa.array([o[0] for o in out], pa.int32()),
                                              *(pa.array([squeeze(o[k]) for o in out], pa.binary()) for k in (1, 2, 3, 4))],
                                             names=["unit", "bucket", "first", "second", "third", "data"])

    return run


def sorted_suffixes(buf: np.ndarray, ends: np.ndarray, rounds: int, least: int = 0) -> np.ndarray:
    """Starts of the suffixes of ``least`` symbols or more, in the order of their first ``rounds`` symbols, built column by column from the right.

    ``buf`` holds every string followed by ``_END``, which no UTF-8 text contains, and one in front;
    ``ends`` are the places of the marks. A round brings the suffixes into the stable order of the next two
    columns to the left, so they are in order from there on; a suffix that ends comes before one that goes on.
    Suffixes that are equal so far stay in the order of their strings. Shorter suffixes are not needed for it.
    """
    code = buf + np.uint8(1)  # The mark becomes the smallest symbol.
    pairs = code.astype(np.uint16) << np.uint16(8)
    pairs[:-1] |= np.where(code[:-1] > 0, code[1:], np.uint8(0))
    at = np.arange(1, int(ends[-1]) + 1, dtype=ends.dtype) if len(ends) else ends
    left = np.repeat(ends, np.diff(ends, prepend=0)) - at
    at, left = at[left >= least], left[left >= least]
    for column in range((rounds - 1) // 2 * 2, -1, -2):
        if column + 1 < least:
            order = np.argsort(pairs[at + column], kind="stable")
        else:
            order = np.argsort(np.where(column < left, pairs[np.minimum(at + column, len(buf) - 1)], 0).astype(np.uint16), kind="stable")
            left = left[order]
        at = at[order]
    return at


def smallest_ids(strings: list[bytes], ids: np.ndarray) -> list[np.ndarray]:
    """Per string and window in it the smallest id of all strings that hold the same window."""
    raw = b"\xff" + b"\xff".join(strings) + b"\xff" + bytes(8)
    buf = np.frombuffer(raw, dtype=np.uint8)
    size = np.array([len(s) for s in strings], dtype=np.int64)
    ends = np.cumsum(size + 1)
    if len(raw) < 1 << 31:
        ends = ends.astype(np.int32)
    at = sorted_suffixes(buf, ends, WINDOW, WINDOW)
    owner = np.repeat(np.arange(len(strings)), size + 1)[at - 1]
    # Common prefixes of neighbours, as far as they matter: do both begin with the same 50 bytes?
    words = np.lib.stride_tricks.as_strided(buf[:8].view(np.uint64), (len(buf) - 7,), (1,))
    same = np.ones(max(len(at) - 1, 0), dtype=bool)
    for k in (*range(0, WINDOW - 8, 8), WINDOW - 8):
        w = words[at + k]
        same &= w[1:] == w[:-1]
    head = np.concatenate([[True], ~same]) if len(at) else np.empty(0, dtype=bool)
    group = np.cumsum(head) - 1
    low = np.minimum.reduceat(ids[owner], np.flatnonzero(head)) if len(at) else ids[:0]
    best = np.empty(len(buf), dtype=np.int64)
    best[at] = low[group]
    return [best[e - n:e - WINDOW + 1] for e, n in zip(ends.tolist(), size.tolist(), strict=True)]


def _sort_bucket(part):
    """Answers per unit: for its segments the spans of windows with the smallest id that holds them."""
    import pyarrow as pa

    found: dict[bytes, int] = {}
    low: list[int] = []
    rows = []
    for unit, first, second, third, data in zip(*(part.column(c).to_pylist() for c in ("unit", "first", "second", "third", "data")), strict=True):
        first, second, third, data = map(unsqueeze, (first, second, third, data))
        which, at = [], 0
        for n, i in zip(np.frombuffer(first, dtype=np.int32).tolist(), np.frombuffer(second, dtype=np.int64).tolist(), strict=True):
            j = found.setdefault(data[at:at + n], len(found))
            at += n
            which.append(j)
            if j == len(low):
                low.append(i)
            elif i < low[j]:
                low[j] = i
        rows.append((unit, which, np.frombuffer(third, dtype=np.int32)))
    best = smallest_ids(list(found), np.array(low, dtype=np.int64))
    size = np.array([len(b) for b in best])
    flat = np.concatenate(best)
    begin = np.cumsum(size) - size
    edge = np.ones(len(flat), dtype=bool)
    edge[1:] = flat[1:] != flat[:-1]
    edge[begin] = True
    span = np.flatnonzero(edge)
    of = np.searchsorted(begin, span, side="right") - 1
    start = (span - begin[of]).astype(np.int32)
    length = np.diff(span, append=len(flat)).astype(np.int32)
    first_span, n_spans = np.searchsorted(of, np.arange(len(best))), np.bincount(of, minlength=len(best))
    out = []
    for unit, which, numbers in rows:
        w = np.array(which)
        n = n_spans[w]
        k = np.repeat(first_span[w] - np.cumsum(n) + n, n) + np.arange(n.sum())
        out.append((unit, np.repeat(numbers, n).astype(np.int32).tobytes(), np.stack([start[k], length[k]]).tobytes(), flat[span[k]].tobytes()))
    return pa.table({"unit": pa.array([o[0] for o in out], pa.int64()), **{c: pa.array([squeeze(o[k]) for o in out], pa.binary()) for k, c in ((1, "number"), (2, "span"), (3, "low"))}})


_RESULT = StructType([StructField(name, kind()) for name, kind in (
    ("id", LongType), ("n_bytes", LongType), ("n_removed", LongType), ("n_spans", LongType), ("kept", BinaryType), ("text", StringType))])


def _cut(batches):
    import pyarrow as pa

    for row in unit_rows(batches):
        unit = Unit(row)
        edge = np.zeros(len(unit.raw) + 1, dtype=np.int32)
        if row["answers"]:
            doc, first, which = (np.frombuffer(unsqueeze(row[c]), dtype=k) for c, k in (("first", np.int32), ("second", np.int64), ("third", np.int32)))
            number = np.concatenate([np.frombuffer(unsqueeze(a["number"]), dtype=np.int32) for a in row["answers"]])
            span = np.concatenate([np.frombuffer(unsqueeze(a["span"]), dtype=np.int32).reshape(2, -1) for a in row["answers"]], axis=1)
            low = np.concatenate([np.frombuffer(unsqueeze(a["low"]), dtype=np.int64) for a in row["answers"]])
            order = np.argsort(number, kind="stable")
            number, span, low = number[order], span[:, order], low[order]
            a, b = np.searchsorted(number, which), np.searchsorted(number, which, side="right")
            n = b - a
            k = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
            gone = low[k] < np.repeat(unit.ids[doc], n)
            begin = np.repeat(first, n)[gone] + span[0, k[gone]]
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + span[1, k[gone]] + WINDOW - 1, -1)
        removed = np.cumsum(edge)[:-1] > 0
        out, at = [], 0
        for n in unit.lengths.tolist():
            mask = removed[at:at + n]
            if mask.any():
                kept = unit.raw[at:at + n][~mask].tobytes()
                spans = int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0])
            else:
                kept, spans = unit.text[at:at + n], 0
            out.append((n, n - len(kept), spans, kept, kept.decode("utf-8", "ignore")))
            at += n
        ids = pa.array(unit.ids, pa.int64(), mask=~unit.known)
        kinds, more = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()), Unit.carried(row)
        for k in range(0, len(out), 256):
            columns = [ids.slice(k, 256), *(pa.array([o[j] for o in out[k:k + 256]], kind) for j, kind in enumerate(kinds))]
            names = _RESULT.fieldNames()
            if more is not None:
                columns, names = [*columns, *more.slice(k, 256).columns], [*names, *more.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_repeats(docs: DataFrame, key: str, text: str, carry: Sequence[str] = ()) -> DataFrame:
    """Per row ``id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (bytes), ``text``, and ``carried0``, ...

    Every byte goes that a 50-byte string covers which also starts in a document with a smaller id, judged
    on the input; ``n_spans`` counts the maximal removed runs. ``text`` is what is left, without characters
    that a cut went through. Windows never cross documents.

    Nulls: a null text is empty; a row with a null id keeps its whole text and removes nothing elsewhere.
    Documents with equal ids (repeated rows) do not remove from each other, but from larger ids. Texts under
    50 bytes stay as they are; long ones are handled in overlapping parts. An empty table gives no rows.
    Columns named in ``carry`` come back unchanged as ``carried0``, ``carried1``, ...; no other one is read.
    """
    units, size = pack_units(docs, key, text, carry)
    buckets = max(shuffle_parts(docs.sparkSession), -(-size // BUCKET_BYTES))

    bare = units.drop("rest")
    keys = bare.mapInArrow(_emit_keys(buckets), "bucket int, unit long, keys binary, counts binary")
    shared = keys.groupBy("bucket").applyInArrow(_find_shared(HOT), "unit long, bucket int, shared binary, hot binary")
    answers = shared.groupBy("unit").agg(F.collect_list(F.struct("bucket", "shared", "hot")).alias("answers"))
    segments = stage(bare.join(answers, "unit").mapInArrow(_emit_segments(buckets), _SEGMENTS), "segments")
    spans = stage(segments.where("bucket is not null").groupBy("bucket").applyInArrow(
        _sort_bucket, "unit long, number binary, span binary, low binary"), "spans")
    answers = spans.groupBy("unit").agg(F.collect_list(F.struct("number", "span", "low")).alias("answers"))
    kinds = [StructField(f"carried{k}", docs.select(F.col(f"`{c}`")).schema[0].dataType) for k, c in enumerate(carry)]
    places = segments.where("bucket is null").select("unit", "first", "second", "third")
    return units.join(places.join(answers, "unit"), "unit", "left").mapInArrow(_cut, StructType([*_RESULT.fields, *kinds]))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = remove_repeats(table(spark, folder, "documents"), "doc_id", "text")
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
