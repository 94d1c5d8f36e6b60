"""Byte-level BPE by prefix dynamic programming: one valid last token per byte prefix."""

from __future__ import annotations

import base64
from array import array
from itertools import chain

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilo.llm.common import table

#: Pieces of which a task remembers the encoding.
REMEMBERED = 400_000
#: More than any rank: where no pair merges.
NEVER = 1 << 60


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Merge ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class PrefixBpe:
    """Encoder of byte strings by merge ranks that can append and edit.

    Merging by rank gives each byte string one encoding, and a row of tokens is that encoding exactly
    when each two neighbours keep their border if their bytes are merged alone. So every prefix has one
    valid last token: the one that may follow the last token of the prefix before it. ``last[i]`` holds it
    for the first i bytes; walking it backwards gives the tokens. Appending bytes only adds entries; an
    edit drops the entries after the first changed byte.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.judged = 0
        self.alone: dict[int, tuple] = {}
        # Tokens by their bytes from the last to the first: the rank of one that ends there, which tokens it may follow, what goes on.
        self.ending: dict[int, list] = {}
        self.fits: dict[int, dict[int, bool]] = {}
        for token, rank in ranks.items():
            more = self.ending
            for byte in reversed(token):
                node = more.get(byte)
                if node is None:
                    node = more[byte] = [-1, None, {}]
                more = node[2]
            node[0], node[1] = rank, self.fits.setdefault(rank, {})

    def merge_one(self, row: list[bytes]) -> int:
        """Merge the pair of the lowest rank, the first of equal ones; returns that rank."""
        low, at = NEVER, 0
        for k in range(len(row) - 1):
            rank = self.ranks.get(row[k] + row[k + 1], NEVER)
            if rank < low:
                low, at = rank, k
        if low < NEVER:
            row[at:at + 2] = [row[at] + row[at + 1]]
        return low

    def merged(self, piece: bytes) -> list[int]:
        """Encoding by definition: again and again the pair of the lowest rank, the first of equal ones."""
        row = [piece[k:k + 1] for k in range(len(piece))]
        while self.merge_one(row) < NEVER:
            pass
        return [self.ranks[part] for part in row]

    def merges(self, rank: int) -> tuple:
        """The merges of a token's bytes alone: their ranks, the first and the last part before each, and whether the token comes out."""
        found = self.alone.get(rank)
        if found is None:
            row, ranks, first, last = [bytes([x]) for x in self.token[rank]], [], [], []
            while not ranks or ranks[-1] < NEVER:
                first.append(row[0])
                last.append(row[-1])
                ranks.append(self.merge_one(row))
            found = self.alone[rank] = ranks, first, last, len(row) == 1
        return found

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the bytes of both merge to just these two.

        While nothing merges across the border, each side merges as it does alone, the lower rank first and
        the left one of equal ranks; so it is enough to look at the pair at the border after each merge.
        """
        good = self.fits[b].get(a)
        if good is None:
            if self.judged >= 4 * REMEMBERED:
                for known in self.fits.values():
                    known.clear()
                self.judged = 0
            left, _, last, whole = self.merges(a)
            right, first, _, good = self.merges(b)
            good, i, j = good and whole, 0, 0
            while good:
                border = self.ranks.get(last[i] + first[j], NEVER)
                if border < left[i] and border <= right[j]:
                    good = False
                elif left[i] > right[j]:
                    j += 1
                elif left[i] < NEVER:
                    i += 1
                else:
                    break
            self.fits[b][a] = good
            self.judged += 1
        return good

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Last tokens of all prefixes of ``piece``, of which ``last`` has the first ones."""
        ending, may_follow = self.ending, self.may_follow
        if not last:
            last.append(-1)
        for i in range(len(last), len(piece) + 1):
            more, at = ending, i
            while at:
                at -= 1
                node = more.get(piece[at])
                if node is None:
                    raise ValueError("the ranks have no token for a byte")
                rank, fits, more = node
                if fits is not None:
                    if not at:
                        break
                    good = fits.get(last[at])
                    if good or good is None and may_follow(last[at], rank):
                        break
            else:
                raise ValueError("the ranks have no token for a byte")
            last.append(rank)
        return last

    def tokens(self, last: list[int]) -> list[int]:
        """Encoding of the longest prefix that ``last`` covers."""
        out, i = [], len(last) - 1
        while i > 0:
            out.append(last[i])
            i -= len(self.token[last[i]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        return self.tokens(self.extend(piece, []))

    def edited(self, old: bytes, last: list[int], new: bytes) -> list[int]:
        """Last tokens of ``new``, keeping what ``old`` and it have in common at the front."""
        size = min(len(old), len(new))
        differ = int.from_bytes(old[:size], "big") ^ int.from_bytes(new[:size], "big")
        same = size - (differ.bit_length() + 7) // 8
        return self.extend(new, last[:same + 1])


class _Pieces(dict):
    """Numbers of the pieces met so far; the ids of piece k lie in ``store`` from ``start[k]`` on, ``size[k]`` of them."""

    def __init__(self, bpe: PrefixBpe):
        self.bpe = bpe
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.store, self.start, self.size, self.new = array("i"), array("q"), array("q"), []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        number = self[piece] = len(self)
        return number

    def learn(self) -> None:
        """Encode the new pieces in order, so that each keeps the last tokens of what it shares with the one before."""
        for numbers in (self.start, self.size):
            numbers.frombytes(bytes(8 * len(self.new)))
        old, last = b"", [-1]
        for piece in sorted(self.new):
            new, number = piece.encode(), self[piece]
            last = self.bpe.edited(old, last, new)
            found = self.bpe.tokens(last)
            self.start[number], self.size[number] = len(self.store), len(found)
            self.store.extend(found)
            old = new
        self.new = []

    def ids(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the texts and the ids of all their pieces."""
        if len(self) > REMEMBERED or len(self.store) > REMEMBERED * 8:
            self.forget()
        number = np.fromiter(map(self.__getitem__, chain.from_iterable(texts)), dtype=np.int64)
        self.learn()
        start, size, store = (np.frombuffer(x, dtype=x.typecode) if x else np.array(x) for x in (self.start, self.size, self.store))
        size = size[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        return ends[np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(int)], store[spans(start[number], size)]


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Numbers start[k], start[k] + 1, ... of ``size[k]`` numbers each, one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


def _encoding(ranks: bytes, pattern: str):
    def run(batches):
        import pyarrow as pa

        split, pieces = regex.compile(pattern), _Pieces(PrefixBpe(read_ranks(ranks)))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                offsets, flat = pieces.ids([split.findall(value or "") for value in part.column(1).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["key", "ids"])

    return run


def _decoding(ranks: bytes):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        token = {rank: t for t, rank in read_ranks(ranks).items()}
        size = np.zeros(max(token, default=0) + 1, dtype=np.int64)
        size[list(token)] = [len(t) for t in token.values()]
        start = np.cumsum(size) - size
        letters = np.frombuffer(b"".join(token.get(k, b"") for k in range(len(size))), dtype=np.uint8)
        del token
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts = pc.fill_null(pc.list_value_length(part.column(1)), 0)
                flat = np.asarray(part.column(1).flatten(), dtype=np.int64)
                if not size[flat].all():
                    raise KeyError("an id that the ranks do not have")
                raw = letters[spans(start[flat], size[flat])].tobytes()
                ends = np.concatenate([[0], np.cumsum(size[flat])])[np.concatenate([[0], np.cumsum(np.asarray(counts))]).astype(int)]
                texts = [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary())],
                                                 names=["key", "ids", "decoded"])

    return run


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))


def encode(docs: DataFrame, key: str, text: str, ranks: bytes, pattern: str) -> DataFrame:
    """``key`` and ``ids``: token ids of each whole text.

    ``ranks`` are the contents of the rank file (at most a few MB, sent with the tasks); every match of
    ``pattern`` is encoded separately. A null text is empty and has no ids; texts of any length are
    encoded in time proportional to them. Repeated rows and null keys stay; other columns are not read.
    """
    return _rows(docs, key, text).mapInArrow(_encoding(ranks, pattern), "key long, ids array<int>").withColumnRenamed("key", key)


def decode(coded: DataFrame, key: str, ids: str, ranks: bytes) -> DataFrame:
    """``key``, ``ids`` and ``decoded``, the bytes of the ids. Null ids are empty; an unknown id raises KeyError."""
    rows = coded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    done = rows.mapInArrow(_decoding(ranks), "key long, ids array<int>, decoded binary")
    return done.select(F.col("key").alias(key), F.col("ids").alias(ids), "decoded")


def encode_and_decode(docs: DataFrame, key: str, text: str, ranks: bytes, pattern: str) -> DataFrame:
    """``key``, ``ids`` and ``decoded``, as :func:`decode` gives them of :func:`encode`, with one Python worker a task instead of two."""
    encoding, decoding = _encoding(ranks, pattern), _decoding(ranks)
    done = _rows(docs, key, text).mapInArrow(lambda batches: decoding(encoding(batches)), "key long, ids array<int>, decoded binary")
    return done.withColumnRenamed("key", key)


def rank_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    ranks = rank_file(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode_and_decode(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encoding and decoding of every whole document."""
    return digests(table(spark, folder, "documents"))
