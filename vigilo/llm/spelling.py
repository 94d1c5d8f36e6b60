"""Spelling variants: words one edit apart, found by scanning sorted word lists with a banded edit matrix."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm.common import shuffle_parts, table
from vigilo.sources.tables import stage

#: Letters are handled as one byte each: A-Z lower-cased, a-z and U+00C0 to U+00FF kept, all else a gap.
_LETTERS = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 192 else 32 for x in range(256))
#: Distinct words a task counts before it passes the counts on.
HELD = 200_000
#: Rows of whole lists that are scanned together, and words of them that are looked up at a time.
LIST_ROWS, ASKED = 1 << 16, 1 << 13
#: A list with more words is cut by a narrower place of the edit.
LONG_LIST = 1 << 16
#: Largest entry of the edit matrix that is told apart.
FAR = 2


def runs_of(text: str | None) -> list[bytes]:
    """The maximal runs of letters of a text, lower-cased, one byte a letter."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def dropped_letter(doc_id: int | None, run: bytes, every: int) -> bytes:
    """The run, or without one of its letters where ``every`` divides the crc32 of ``<doc_id>:<run>``."""
    h = zlib.crc32(_utf8(run), zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count_words(change: Callable[[int | None, bytes], bytes] | None, least: int):
    def run(batches):
        import pyarrow as pa

        total: Counter[bytes] = Counter()

        def rows():
            words = sorted(w for w in total)
            counts = [total[w] for w in words]
            total.clear()
            for at in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in words[at:at + 50_000]]), pa.array(counts[at:at + 50_000], pa.int64())], names=["word", "n"])

        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                part = batch.slice(first, 64)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for word, n in Counter(runs_of(text)).items():
                        if len(word) >= least:
                            made = word if change is None else change(key, word)
                            if len(made) >= least:
                                total[made] += n
                    if len(total) >= HELD:
                        yield from rows()
        yield from rows()

    return run


def vocabulary(docs: DataFrame, key: str, text: str, *, least_letters: int = 5, least_count: int = 3, drop_every: int | None = None) -> DataFrame:
    """``word`` and its occurrences ``n`` over all whole texts.

    With ``drop_every`` a run loses a letter in a document where that number divides its crc32. Counts are
    added up in the tasks before they are shuffled.
    """
    change = None if drop_every is None else (lambda doc_id, run: dropped_letter(doc_id, run, drop_every))
    base = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    counted = base.mapInArrow(_count_words(change, least_letters), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _place(word: bytes, m: int, low: int, high: int) -> tuple[bytes, bytes]:
    """Key of the list for an edit in letters ``low`` to ``high`` of the shorter word (``m`` letters), and the letters there."""
    end = len(word) - (m - high)
    return b"%d,%d,%d,%d," % (m, low, high, low) + word[:low] + word[end:], word[low:end]


def _entries(batches):
    """Two places of the edit (either half) for a word as the shorter one of a pair, two as the longer one."""
    import pyarrow as pa

    for batch in batches:
        keys, middles, words, counts, lows, highs, shorts = [], [], [], [], [], [], []
        for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            word = text.encode("latin-1")
            for m in (len(word), len(word) - 1):
                for low, high in ((0, m // 2), (m // 2, m)):
                    if high > low:
                        key, middle = _place(word, m, low, high)
                        for column, value in zip((keys, middles, words, counts, shorts, lows, highs), (key, middle, word, n, m, low, high), strict=True):
                            column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(middles, pa.binary()), pa.array(words, pa.binary()), pa.array(counts, pa.int64()),
                                          *(pa.array(x, pa.int32()) for x in (shorts, lows, highs))], names=["key", "middle", "word", "n", "m", "low", "high"])


def _narrower(batches):
    """Each entry once for either half of its place."""
    import pyarrow as pa

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            mid = (r["low"] + r["high"]) // 2
            for low, high in ((r["low"], mid), (mid, r["high"])):
                key, middle = _place(r["word"], r["m"], low, high)
                rows.append({**r, "key": key, "middle": middle, "low": low, "high": high})
        yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)


def _common_prefixes(flat: np.ndarray, at: np.ndarray, size: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each string with the one before; -1 where ``joined`` is false (another list)."""
    out = np.where(joined, 0, -1)
    live = np.flatnonzero(joined)
    depth = 0
    while len(live):
        live = live[(size[live] > depth) & (size[live - 1] > depth)]
        live = live[flat[at[live] + depth] == flat[at[live - 1] + depth]]
        depth += 1
        out[live] = depth
    return out


def scan(strings: list[bytes], lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (asked, found, common prefix) at one edit inside each list, in both directions.

    ``strings`` are distinct and sorted within a list, ``lists`` numbers the list of each, in order. Strings
    that share a prefix share the rows of the edit matrix up to it: every step extends all ranges of equal
    prefixes by one letter, so a row is worked out once for a range, not for each string. Only three entries of a row
    can be one at most. A range whose row has no such entry is skipped whole.
    """
    size = np.array([len(s) for s in strings], dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
    flat = np.frombuffer(b"".join(strings) + b"\0", dtype=np.uint8)
    joined = np.concatenate([[False], lists[1:] == lists[:-1]])
    shared = _common_prefixes(flat, at, size, joined)
    starts = np.flatnonzero(~joined)
    ends = np.append(starts[1:], len(strings))
    number = np.searchsorted(starts, np.arange(len(strings)), "right") - 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    for first in range(0, len(strings), ASKED):
        asked = np.arange(first, min(first + ASKED, len(strings)))
        # A list of one string has nothing to find.
        asked = asked[(ends - starts)[number[asked]] > 1]
        low, high = starts[number[asked]], ends[number[asked]]
        # Entries of the row at the letters before, at and after the depth.
        row = np.stack([np.full(len(asked), FAR), np.zeros(len(asked), int), np.where(size[asked] > 0, 1, FAR)]).astype(np.int8)
        same = np.zeros(len(asked), dtype=np.int64)
        depth = 0
        while len(asked):
            # The first string of a range ends here if it is as long as the prefix.
            over = size[low] == depth
            gap = size[asked] - depth
            done = np.flatnonzero(over & (np.abs(gap) <= 1))
            hit = done[row[(gap[done] + 1), done] == 1]
            if len(hit):
                found.append((asked[hit], low[hit], same[hit]))
            low = low + over
            keep = np.flatnonzero(low < high)
            asked, low, high, row, same = asked[keep], low[keep], high[keep], row[:, keep], same[keep]
            if not len(asked):
                break
            # Ranges of the next letter begin where a string shares no more than this prefix with the one before.
            cuts = np.flatnonzero(shared <= depth)
            begin, stop = np.searchsorted(cuts, low, "right"), np.searchsorted(cuts, high, "left")
            count = stop - begin + 1
            owner = np.repeat(np.arange(len(asked)), count)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            edge = np.append(cuts, len(strings))
            new_low = np.where(inner == 0, low[owner], edge[np.minimum(begin[owner] + inner - 1, len(edge) - 1)])
            new_high = np.where(inner == count[owner] - 1, high[owner], edge[np.minimum(begin[owner] + inner, len(edge) - 1)])
            letter = flat[at[new_low] + depth]
            who = asked[owner]
            length, base = size[who], at[who]

            def differs(k):
                """Whether letter ``k`` of the asked string is not this one; past its end it is."""
                inside = (k >= 0) & (k < length)
                return np.where(inside, flat[np.where(inside, base + k, 0)] != letter, True)

            before, here, after = row[:, owner]
            at_before = np.minimum(before + differs(depth - 1), here + 1)
            at_here = np.minimum(np.minimum(here + differs(depth), after + 1), at_before + 1)
            at_after = np.minimum(after + differs(depth + 1), at_here + 1)
            at_before = np.where((depth < 0) | (depth > length), FAR, at_before)
            at_here = np.where(depth + 1 > length, FAR, at_here)
            at_after = np.where(depth + 2 > length, FAR, at_after)
            next_row = np.minimum(np.stack([at_before, at_here, at_after]), FAR).astype(np.int8)
            live = np.flatnonzero(next_row.min(axis=0) < FAR)
            asked, low, high, row = who[live], new_low[live], new_high[live], next_row[:, live]
            same = np.where(row[1] == 0, depth + 1, same[owner[live]])
            depth += 1
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _near(rows: dict, lists: np.ndarray):
    """Per word of these lists its number of near words and the best of them."""
    words, size = rows["word"], np.array([len(w) for w in rows["word"]])
    n, m, width = (np.array(rows[c], dtype=np.int64) for c in ("n", "m", "width"))
    last = np.array(rows["last"], dtype=bool)
    asked, found, same = scan(rows["middle"], lists)
    # A pair belongs to the list of its shorter word's length, and to the place of its first difference.
    mine = (np.minimum(size[asked], size[found]) == m[asked]) & (last[asked] | (same < width[asked]))
    asked, found = asked[mine], found[mine]
    order = np.lexsort((-n[found], asked))
    asked, found = asked[order], found[order]
    begin = np.flatnonzero(np.diff(asked, prepend=-1))
    most = np.maximum.reduceat(n[found], begin) if len(begin) else np.empty(0, dtype=np.int64)
    count = np.diff(np.append(begin, len(asked)))
    equal = np.add.reduceat((n[found] == np.repeat(most, count)).astype(np.int64), begin) if len(begin) else count
    best = [words[found[b]] if e == 1 else min(words[f] for f in found[b:b + e]) for b, e in zip(begin, equal, strict=True)]
    return [words[a] for a in asked[begin]], count, most, best


def _scan_lists(batches):
    """Near words of the lists of one partition, whose rows come sorted by list and letters."""
    import pyarrow as pa

    names = ("key", "middle", "word", "n", "m", "low", "high")
    held: dict[str, list] = {c: [] for c in names}

    def answer(count: int):
        part = {c: held[c][:count] for c in names}
        for c in names:
            held[c] = held[c][count:]
        keys = part["key"]
        lists = np.cumsum([0] + [int(a != b) for a, b in zip(keys[1:], keys[:-1], strict=True)])
        part["width"] = [h - lo for h, lo in zip(part["high"], part["low"], strict=True)]
        part["last"] = [h == m for h, m in zip(part["high"], part["m"], strict=True)]
        word, near, most, best = _near(part, lists)
        text = lambda ws: pa.array([w.decode("latin-1") for w in ws], pa.string())
        return pa.RecordBatch.from_arrays([text(word), pa.array(near, pa.int64()), pa.array(most, pa.int64()), text(best)], names=["word", "near", "most", "best"])

    for batch in batches:
        for c in names:
            held[c] += batch.column(c).to_pylist()
        if len(held["key"]) > LIST_ROWS:
            end = len(held["key"])
            while end and held["key"][end - 1] == held["key"][-1]:
                end -= 1
            if end:
                yield answer(end)
    if held["key"]:
        yield answer(len(held["key"]))


def near_words(words: DataFrame, *, long_list: int = LONG_LIST) -> DataFrame:
    """Per word with near words: ``word``, ``n_near``, and ``n`` and name of the most frequent one (``best_n``, ``best``).

    ``words`` holds distinct ``word`` and ``n``. Near means one inserted, deleted or replaced letter. The edit lies in
    one half of the shorter word, so the other half is equal: words are dealt to the lists of either half. A list
    that is longer than ``long_list`` is cut again by the half of the half in which the edit lies, and so on down to
    one letter, so no list grows with the vocabulary. Each list is scanned in sorted order. A task gives one row for a word and a list,
    never a row for a pair.
    """
    spark = words.sparkSession
    schema = "key binary, middle binary, word binary, n long, m int, low int, high int"
    entries = stage(words.select("word", "n").mapInArrow(_entries, schema), "entries")
    ready = []
    while True:
        long = entries.groupBy("key").agg(F.count("*").alias("rows"), F.max(F.col("high") - F.col("low")).alias("wide"))
        long = stage(long.where((F.col("rows") > long_list) & (F.col("wide") > 1)).select("key"), "long")
        if long.isEmpty():
            ready.append(entries)
            break
        ready.append(entries.join(long, "key", "left_anti").select(*entries.columns))
        entries = stage(entries.join(long, "key", "left_semi").select(*entries.columns).mapInArrow(_narrower, schema), "entries")
    lists = ready[0]
    for more in ready[1:]:
        lists = lists.unionByName(more)
    dealt = lists.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key", "middle")
    answers = dealt.mapInArrow(_scan_lists, "word string, near long, most long, best string")
    first = F.min(F.struct((-F.col("most")).alias("m"), F.col("best").alias("b")))
    return answers.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("f")).select(
        "word", "n_near", (-F.col("f.m")).alias("best_n"), F.col("f.b").alias("best"))


def follow(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of ``form``; rows without a form are left out.

    Every round doubles the steps taken. A form is at least twice as frequent as its word, so chains are short and have no rings.
    """
    now = stage(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def group_variants(docs: DataFrame, key: str, text: str, *, least_letters: int = 5, least_count: int = 3, ratio: int = 2, drop_every: int | None = None) -> DataFrame:
    """Words with ``form`` (the near word of largest count, if that is ``ratio`` times the word's or more) and ``root``.

    Columns: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``. Null and empty texts have no words; a null key
    counts as an empty id where letters are dropped; repeated rows are counted as often as they stand there. Ties go to the
    smallest word in code-point order. An empty table, or one without words, gives no rows. Other columns are not read.
    """
    words = stage(vocabulary(docs, key, text, least_letters=least_letters, least_count=least_count, drop_every=drop_every), "words")
    near = near_words(words)
    fits = F.col("best_n") >= ratio * F.col("n")
    linked = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")), "linked")
    return linked.join(follow(linked), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return group_variants(table(spark, folder, "documents"), "doc_id", "text", drop_every=97)


# The crc32 of a string is the exclusive or of one number for each of its bytes and its distance from the end,
# and of one for the length.
OP12_SQL = r"""WITH RECURSIVE steps AS (
  SELECT CAST(range AS BIGINT) AS b, CAST(range AS BIGINT) AS v, 0 AS k FROM range(256)
  UNION ALL SELECT b, xor(v >> 1, 3988292384 * (v & 1)), k + 1 FROM steps WHERE k < 8),
base AS (SELECT b, v FROM steps WHERE k = 8),
found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
runs AS (SELECT row_number() OVER () AS r, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, run, n
  FROM (SELECT doc_id, run, count(*) AS n FROM found GROUP BY doc_id, run)),
letters AS (SELECT r, strlen(s) AS size, s, unnest(range(1, length(s) + 1)) AS i FROM runs),
codes AS (SELECT r, size, strlen(substr(s, 1, i)) AS ends, ord(substr(s, i, 1)) AS code FROM letters),
bytes AS (
  SELECT r, size - ends AS k, CASE WHEN code < 128 THEN code ELSE 128 + (code & 63) END AS b FROM codes
  UNION ALL SELECT r, size - ends + 1, 192 + (code >> 6) FROM codes WHERE code >= 128),
most AS (SELECT max(strlen(s)) AS size FROM runs),
parts AS (
  SELECT 0 AS k, b, v FROM base
  UNION ALL SELECT p.k + 1, p.b, xor(p.v >> 8, base.v) FROM parts p JOIN base ON base.b = p.v & 255, most WHERE p.k < most.size),
lengths AS (
  SELECT 0 AS size, 4294967295 AS v
  UNION ALL SELECT l.size + 1, xor(l.v >> 8, base.v) FROM lengths l JOIN base ON base.b = l.v & 255, most WHERE l.size < most.size),
crcs AS (SELECT r, bit_xor(parts.v) AS v FROM bytes JOIN parts ON parts.k = bytes.k AND parts.b = bytes.b GROUP BY r),
hashed AS (SELECT run, n, xor(xor(crcs.v, lengths.v), 4294967295) AS h FROM runs JOIN crcs USING (r) JOIN lengths ON lengths.size = strlen(s)),
made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
named AS (SELECT b.word, n_near, most, min(other) AS other FROM best b JOIN near ON near.word = b.word AND near.n = b.most GROUP BY ALL),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN other END AS form, CASE WHEN most >= 2 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN named USING (word)),
chain AS (
  SELECT word, form AS at FROM forms WHERE form IS NOT NULL
  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at AS root FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN ends USING (word)
"""
