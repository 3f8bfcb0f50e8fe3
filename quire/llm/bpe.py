"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a pre-token that
is itself a vocabulary entry. Tier two: any other pre-token is merged with a
heap over a doubly linked list of its bytes, so that a pre-token of n bytes
costs n log n, however long it is. Pre-tokens seen before come from a bounded
per-worker memo.

Defined results: a null text is encoded as an empty one (no ids); special
tokens in a text are ordinary text; white space and repeats are kept, so
decoding gives back the exact bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from collections.abc import Callable

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quire.llm.common import arrow_map, bounded_batches

#: The vocabulary is broadcast; a rank file may have at most so many bytes.
MAX_RANK_FILE = 64 << 20
#: Pre-tokens that a worker remembers at most, and the longest of them in bytes.
MEMO_ENTRIES, MEMO_LONGEST = 400_000, 64


class PerfectHash:
    """A minimal perfect hash over byte strings: n keys, n slots, one displacement per bucket of about two keys.

    Buckets are placed largest first. A bucket with one key stores its free slot
    itself, as -1 - slot.
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.n = n = len(keys)
        self.m = max(1, n // 2)
        for self.seed in range(64):
            if self._place(keys, n):
                return
        raise ValueError("keys are not distinct")

    def _place(self, keys: list[bytes], n: int) -> bool:
        buckets: list[list[int]] = [[] for _ in range(self.m)]
        hashes = [xxhash.xxh3_128_intdigest(k, self.seed) for k in keys]
        for i, h in enumerate(hashes):
            buckets[h % self.m].append(i)
        self.displacement = np.zeros(self.m, np.int64)
        self.slots = np.full(n, -1, np.int64)
        taken, free = bytearray(n), n - 1
        for b in sorted(range(self.m), key=lambda b: -len(buckets[b])):
            own = buckets[b]
            if not own:
                break
            if len(own) == 1:
                while taken[free]:
                    free -= 1
                self.displacement[b] = -1 - free
                taken[free], self.slots[free] = 1, own[0]
                continue
            pairs = [((hashes[i] >> 32) & 0xFFFFFFFF, (hashes[i] >> 64) & 0xFFFFFFFF) for i in own]
            for d in range(64 * n + 64):
                at = {(x + d * (y | 1)) % n for x, y in pairs}
                if len(at) == len(own) and not any(taken[s] for s in at):
                    break
            else:
                return False
            self.displacement[b] = d
            for i, (x, y) in zip(own, pairs, strict=True):
                s = (x + d * (y | 1)) % n
                taken[s], self.slots[s] = 1, i
        return True

    def slot(self, key: bytes) -> int:
        """The only key index that key can have; the caller compares the key itself."""
        h = xxhash.xxh3_128_intdigest(key, self.seed)
        d = int(self.displacement[h % self.m])
        return int(self.slots[-1 - d if d < 0 else (((h >> 32) & 0xFFFFFFFF) + d * (((h >> 64) & 0xFFFFFFFF) | 1)) % self.n])


class Vocabulary:
    """Ranks of byte strings; a token's id is its rank."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.tokens = list(ranks)
        self.ids = [ranks[t] for t in self.tokens]
        self.ranks = ranks
        self.hash = PerfectHash(self.tokens) if self.tokens else None
        self.by_id = dict(zip(self.ids, self.tokens, strict=True))

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a rank file: lines of a base64 token and its rank."""
        with open(path, "rb") as f:
            data = f.read(MAX_RANK_FILE + 1)
        if len(data) > MAX_RANK_FILE:
            raise ValueError(f"{path} is over {MAX_RANK_FILE} bytes")
        return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())})

    def whole(self, piece: bytes) -> int | None:
        """Tier one."""
        if self.hash is None:
            return None
        i = self.hash.slot(piece)
        return self.ids[i] if self.tokens[i] == piece else None

    def merge(self, piece: bytes) -> list[int]:
        """Tier two: always the pair of lowest rank, leftmost first."""
        ranks = self.ranks
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))  # of the part that starts here; 0 when it was merged away
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if end[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(piece[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = after[i]
        return out

    def encode_piece(self, piece: bytes) -> list[int]:
        found = self.whole(piece)
        return [found] if found is not None else self.merge(piece)


class Codec:
    """Encodes texts to packed ids (little-endian unsigned 32-bit) and back."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.find = regex.compile(pattern).findall
        self.vocabulary = vocabulary
        self.memo: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        ids = self.vocabulary.encode_piece(raw)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(raw) <= MEMO_LONGEST:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            self.memo[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        get, miss = self.memo.get, self._piece
        return b"".join([get(p) or miss(p) for p in self.find(text)])

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.by_id.__getitem__, np.frombuffer(packed, "<u4").tolist()))


_codecs: dict[int, Codec] = {}


def _codec(spark: SparkSession, path: str, pattern: str) -> Callable[[], Codec]:
    """The vocabulary and its hash are built once, on the driver, and broadcast (their size is bounded by MAX_RANK_FILE)."""
    sent = spark.sparkContext.broadcast(Vocabulary.read(path))
    key = sent._jbroadcast.id() if sent._jbroadcast is not None else id(sent)

    def get() -> Codec:
        if key not in _codecs:
            _codecs.clear()
            _codecs[key] = Codec(sent.value, pattern)
        return _codecs[key]

    return get


def _str(raw: bytes | None) -> str:
    return "" if raw is None else raw.decode()


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with an array<int> column of token ids."""
    bounded_batches(df.sparkSession)
    codec = _codec(df.sparkSession, path, pattern)

    def rows(column: list[bytes | None]) -> dict[str, list]:
        c = codec()
        return {ids: [np.frombuffer(c.encode(_str(x)), "<u4").astype("i4") for x in column]}

    return arrow_map(df, [text], T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType()))]), rows)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """df with a binary column of the bytes that an array<int> column of ids stands for; null ids give null."""
    bounded_batches(df.sparkSession)
    codec = _codec(df.sparkSession, path, pattern)

    def rows(column: list[list[int] | None]) -> dict[str, list]:
        c = codec()
        return {out: [None if x is None else c.decode(np.array(x, "<u4").tobytes()) for x in column]}

    return arrow_map(df, [ids], T.StructType([T.StructField(out, T.BinaryType())]), rows)


def digest(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """df with n_tokens, ids_sha256 and decoded_sha256, from one pass that encodes each text and decodes its ids."""
    bounded_batches(df.sparkSession)
    codec = _codec(df.sparkSession, path, pattern)

    def rows(column: list[bytes | None]) -> dict[str, list]:
        c = codec()
        packed = [c.encode(_str(x)) for x in column]
        return {
            "n_tokens": [len(x) // 4 for x in packed],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in packed],
            "decoded_sha256": [hashlib.sha256(c.decode(x)).hexdigest() for x in packed],
        }

    kinds = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    return arrow_map(df, [text], T.StructType([T.StructField(k, v) for k, v in kinds.items()]), rows)
