"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints: 64 bits, the majority over the XXH64 of a text's word shingles.
Two fingerprints are linked at ``MAX_BITS`` (3) or fewer differing bits.

Candidate keys. A fingerprint is cut into four 16-bit segments. Three errors
leave at least one segment i untouched, and of the two segments after it (mod 4)
at least one has at most one error. That segment, padded with zeros to the 23
bits of the perfect Golay code, gives codeword indices: a word of even weight
the one it decodes to, a word of odd weight those its one-bit neighbours decode
to. Two words at most one bit apart share one: they are equal, or one is even
and a neighbour of the other. Key = (i, which partner, exact segment i, codeword
index); a pair within three bits always shares one.

Links of four bits, if asked for: with an untouched segment the same holds (if
both partners of i have two errors, the fourth segment is untouched too, and i
is its partner). Else every segment has one error, and the codeword indices of
three segments are one more key.

Similarity. A Jaccard similarity of 0.8 of word shingles leaves about ten of 64
bits apart, too many for those keys. ``keep_first`` decodes softly: two prints of
64 bits, the second from a mix of the same hashes, give SEGMENTS segments of 24
votes (how far each bit is from its majority), and each segment is decoded to the
NEAREST codewords of the extended Golay code by their correlation with the votes,
so the bits that are most likely to flip count least. Any two segments are a key:
the COMBINED pairs of codewords that lose least correlation. A pair is lost only
if it agrees in fewer than two segments; of pairs just at 0.8 that is 2 %, at
0.85 under 1 % (README has measured figures). Candidates form clusters; within a
cluster the exact similarity of all pairs of sets of shingles is worked out, in
tiles, so nothing below the threshold links, and no pair is ever a row.

Work per key. Only distinct prints are keyed. Members of a key are cut into
blocks of at most ``BLOCK`` and every pair of blocks is one tile; a tile is
compared by XOR and population count and gives a spanning forest of its links,
never all pairs. Any key size is handled exactly, in bounded memory. Components
are then found by alternating large-star and small-star steps on DataFrames.

Defined results: null and empty texts have fingerprint zero, linked like any
other; a null doc_id is carried, and never names a component while another id
is there; repeated rows stay repeated; an empty table gives an empty result.
``keep_first`` compares texts, whatever their ids: rows that share a doc_id and
differ in text are documents of their own; of repeated rows one stays; texts with
the same words are one class, null and empty ones too; rows without a doc_id stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import arrow_map, bounded_batches, materialize, private, remove, scratch
from quire.llm.components import components

MAX_BITS, WIDE_BITS = 3, 4
SEED = 42
#: keep_first: shingle similarity that links, prints, segments of 24 votes, codewords of a segment, pairs of them that are keys.
SIMILARITY, WORDS, SEGMENTS, NEAREST, COMBINED = 0.8, 2, 5, 4, 8
#: Candidates differ in at most so many of the 128 bits of both prints; at a similarity of 0.8 that is four deviations above the mean.
NEAR_BITS = 36
#: Members of a key that one tile side holds at most.
BLOCK = 2048
#: Cut keys are broadcast only up to this many.
FEW_KEYS = 10_000
#: Generator polynomial of the binary Golay code (fixed value).
GOLAY = 0b101011100011


def shingle_hashes(text: bytes | None, shingle: int) -> tuple[bytes, list[int]]:
    """The lower-cased words joined by spaces, and the XXH64 of each word shingle, repeats included."""
    tokens = text.lower().split() if text else []  # bytes.lower() changes A-Z only, bytes.split() is ASCII white space
    whole = b" ".join(tokens)
    if len(tokens) <= shingle:
        return whole, [xxhash.xxh64_intdigest(whole, SEED)] if tokens else []
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = [0, *ends[: len(tokens) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return whole, [digest(whole[a:b], SEED) for a, b in zip(starts, stops, strict=True)]


def votes(hashes: list[int], words: int = 1) -> np.ndarray:
    """For each bit of ``words`` prints by how much its ones outnumber its zeros; the first print is over the hashes themselves."""
    total = np.zeros((words, 64), np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], np.uint64)
        for k in range(words):
            bits = np.unpackbits(_mixed(part, k).astype(">u8").view(np.uint8)).reshape(-1, 64)
            total[k] += bits.sum(axis=0, dtype=np.int64)
    return 2 * total - len(hashes)


def _print(votes_: np.ndarray) -> int:
    return int.from_bytes(np.packbits(votes_ > 0).tobytes(), "big")


def fingerprints(text: bytes | None, shingle: int, words: int = 1) -> list[int]:
    """Unsigned 64-bit SimHashes over word shingles, repeats included."""
    return [_print(v) for v in votes(shingle_hashes(text, shingle)[1], words)]


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th mix of hashes (a finalizer over odd steps); the hashes themselves for 0."""
    if not k:
        return hashes
    x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(text: bytes | None, shingle: int) -> int:
    return fingerprints(text, shingle)[0]


def add_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = 3) -> DataFrame:
    """df with the fingerprint as a signed long."""
    bounded_batches(df.sparkSession)

    def rows(column: list[bytes | None]) -> dict[str, list]:
        return {out: np.array([fingerprint(x, shingle) for x in column], np.uint64).view(np.int64)}

    return arrow_map(df, [text], T.StructType([T.StructField(out, T.LongType())]), rows)


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words on division by the generator."""
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


@lru_cache(1)
def _leaders() -> np.ndarray:
    """The correctable error (of at most three bits) of each syndrome."""
    bits = [1 << i for i in range(23)]
    patterns = [0, *bits]
    patterns += [a | b for i, a in enumerate(bits) for b in bits[:i]]
    patterns += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    errors = np.array(patterns)  # 2048 correctable errors, one for each syndrome
    leader = np.zeros(2048, np.int64)
    leader[_syndromes(errors)] = errors
    return leader


@lru_cache(1)
def segment_keys() -> tuple[np.ndarray, np.ndarray]:
    """For each 16-bit segment its codeword indices, as a padded table and a mask of what counts."""
    words, leader = np.arange(1 << 16), _leaders()
    index = (words ^ leader[_syndromes(words)]) >> 11  # the code is systematic: its first 12 bits number the codeword
    near = np.sort(np.stack([index[words ^ (1 << i)] for i in range(16)], axis=1), axis=1)
    fresh = np.ones(near.shape, bool)
    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
    even = np.bitwise_count(words) % 2 == 0
    near[even, 0], fresh[even, 0], fresh[even, 1:] = index[even], True, False
    order = np.argsort(~fresh, axis=1, kind="stable")[:, : fresh.sum(axis=1).max()]
    return np.take_along_axis(near, order, 1), np.take_along_axis(fresh, order, 1)


def candidate_keys(df: DataFrame, columns: list[str], at: int = 0, bits: int = MAX_BITS) -> DataFrame:
    """Rows (key long, *columns) for the keys of the column numbered ``at``: eight kinds, nine for four bits, some codeword indices each."""
    table, fresh = segment_keys()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(row: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(c[row]) for c in given)], names=["key", *columns])

        for batch in batches:
            given = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            fps = given[at]
            parts = [(fps >> (16 * i)) & 0xFFFF for i in range(4)]
            for i in range(4):
                for which in (1, 2):
                    other = parts[(i + which) % 4]
                    row, k = np.nonzero(fresh[other])
                    yield rows(row, ((i * 2 + which - 1) << 28) | (parts[i][row] << 12) | table[other[row], k])
            if bits > MAX_BITS:
                row, key = np.arange(len(fps)), np.full(len(fps), 1, np.int64) << 4
                for part in parts[:3]:
                    of, k = np.nonzero(fresh[part[row]])
                    row, key = row[of], (key[of] << 12) | table[part[row[of]], k]
                yield rows(row, key)

    schema = ", ".join(f"{c} long" for c in ("key", *columns))
    return df.select(*(F.col(c).cast("long") for c in columns)).mapInArrow(run, schema)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of prints; the last axis holds a print's 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def tile_forest(prints: np.ndarray, split: int, bits: int) -> list[tuple[int, int]]:
    """A spanning forest (pairs of rows) of the links within prints, or if split is less than its length between its two parts."""
    n, edges = len(prints), []
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(split):
        first = i + 1 if split == n else split
        for j in (np.flatnonzero(_apart(prints[first:], prints[i]) <= bits) + first).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                edges.append((i, j))
    return edges


def _tiles(keyed: DataFrame, ident: str, block: int | None = None, weight: str | None = None, most: int = 0) -> tuple[DataFrame, DataFrame]:
    """Rows of keyed by tile (key, x, y) and side (mine), sorted; and a table that can go when they have been read.

    A side holds about ``block`` members, and about ``most`` of what a column ``weight`` counts.
    """
    # only keys with more members than one tile side holds are cut into blocks; they are few, or joined by shuffle
    need = F.ceil(F.count(F.lit(1)) / (block or BLOCK))
    if weight:
        need = F.greatest(need, F.ceil(F.sum(weight) / most))
    hot = materialize(keyed.groupBy("key").agg(need.cast("int").alias("blocks")).filter(F.col("blocks") > 1), "simhash-hot")
    few = hot.limit(FEW_KEYS + 1).count() <= FEW_KEYS
    cut = keyed.join(F.broadcast(hot) if few else hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64(ident), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    tiles = (
        cut.withColumn("mine", mine)
        .withColumn("other", F.explode(every))
        .select("key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", *(c for c in keyed.columns if c != "key"))
    )
    return tiles.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "mine", ident), hot


def _over_tiles(compare: Callable[[dict[str, np.ndarray]], Iterator[pa.RecordBatch]], names: list[str]) -> Callable:
    """A mapInArrow function that hands the columns of whole tiles to ``compare``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [np.asarray(c.to_numpy(zero_copy_only=False)) for c in batch.columns]
            cols = [np.concatenate([o, n]) for o, n in zip(rest, new, strict=True)] if rest else new
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            at = int(np.argmax(last))  # the last tile may go on in the next batch
            if at:
                yield from compare(dict(zip(names, (c[:at] for c in cols), strict=True)))
            rest = [c[at:] for c in cols]
        if rest:
            yield from compare(dict(zip(names, rest, strict=True)))

    return run


def _bounds(tile: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, x, y = tile["key"], tile["x"], tile["y"]
    edge = np.flatnonzero((np.diff(key) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)) + 1
    return np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])


def _split(tile: dict[str, np.ndarray], s: int, e: int) -> int:
    """Where the second side of the tile in rows s to e begins, from s; its length if it has one side."""
    x, y = tile["x"][s], tile["y"][s]
    return int(np.searchsorted(tile["mine"][s:e], y, "left")) if x != y else e - s


def _forest(ident: str, prints: list[str], accept: int) -> Callable:
    """compare() for _over_tiles: spanning forests of the links in tiles, as (a, b)."""

    def compare(tile: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        own, names = np.stack([tile[c] for c in prints], axis=1).view(np.uint64), tile[ident]
        starts, stops = _bounds(tile)
        pairs = starts[stops - starts == 2]
        near = pairs[_apart(own[pairs], own[pairs + 1]) <= accept]
        found = [np.stack([near, near + 1], axis=1)]
        more = stops - starts > 2
        for s, e in zip(starts[more].tolist(), stops[more].tolist(), strict=True):
            got = tile_forest(own[s:e], _split(tile, s, e), accept)
            if got:
                found.append(np.array(got) + s)
        at = np.concatenate(found)
        yield pa.RecordBatch.from_arrays([pa.array(names[at[:, 0]]), pa.array(names[at[:, 1]])], names=["a", "b"])

    return compare


def links(df: DataFrame, fingerprint: str, bits: int = MAX_BITS) -> DataFrame:
    """Rows (a long, b long) of fingerprints that connect whatever fingerprints of df are linked at ``bits``; df holds each once."""
    if bits > WIDE_BITS:
        raise ValueError(f"the keys find links of at most {WIDE_BITS} bits")
    bounded_batches(df.sparkSession)
    keyed = materialize(candidate_keys(df, [fingerprint], 0, bits), "simhash-keys")
    parts, hot = _tiles(keyed, fingerprint)
    run = _over_tiles(_forest(fingerprint, [fingerprint], bits), parts.columns)
    found = materialize(parts.mapInArrow(run, "a long, b long").filter("a != b").distinct(), "simhash-links")
    remove(keyed, hot)
    return found


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = MAX_BITS) -> DataFrame:
    """Rows (doc_id, fingerprint long, component_id) for every row of df; component_id is the smallest reachable doc_id."""
    own = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    printed = materialize(add_fingerprint(own, "text", shingle=shingle).drop("text"), "simhash")
    with scratch(df.sparkSession):
        distinct = materialize(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "simhash-distinct")
        roots = components(links(distinct.select("fingerprint"), "fingerprint", bits), "a", "b")  # node, root: only of linked fingerprints
        rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
            "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
        )
        rooted = materialize(rooted, "simhash-roots")
        named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        classes = materialize(rooted.join(named, "root").select("fingerprint", "component_id"), "simhash-classes", result=True)
    return printed.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_digits(fp: str) -> Column:
    """A signed long as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


# similarity of shingle sets


@lru_cache(1)
def codewords() -> np.ndarray:
    """The 4096 words of the extended Golay code as rows of 24 signs."""
    message = np.arange(1 << 12) << 11
    word = message ^ _syndromes(message)
    word = word << 1 | np.bitwise_count(word) % 2
    return 1 - 2 * (word[:, None] >> np.arange(23, -1, -1) & 1).astype(np.float32)


def soft_decode(votes_: np.ndarray) -> np.ndarray:
    """Rows of SEGMENTS * 24 votes as SEGMENTS signed longs: the NEAREST codewords of each segment (12 bits each, the best
    first) and, above them, how much correlation the second to last lose (5 bits each, in 31sts of the row's largest loss)."""
    n = len(votes_)
    # sums of 24 votes are exact in single precision as long as they stay below 2 ** 24
    kind = np.float32 if np.abs(votes_).max(initial=0) < (1 << 19) else np.float64
    scores = votes_.reshape(-1, 24).astype(kind) @ codewords().T.astype(kind)
    rows = np.arange(len(scores))
    codes, values = np.zeros((len(scores), NEAREST), np.int64), np.zeros((len(scores), NEAREST), np.float64)
    for k in range(NEAREST):
        codes[:, k] = at = scores.argmax(axis=1)  # the first of equals
        values[:, k] = scores[rows, at]
        scores[rows, at] = -np.inf
    loss = (values[:, :1] - values).reshape(n, SEGMENTS, NEAREST)
    most = loss.max(axis=(1, 2), initial=0)
    loss = np.floor(31 * loss / np.where(most > 0, most, 1)[:, None, None]).astype(np.int64).reshape(-1, NEAREST)
    packed = np.zeros(len(rows), np.int64)
    for k in range(NEAREST):
        packed |= codes[:, k] << (12 * k)
        if k:
            packed |= loss[:, k] << (48 + 5 * (k - 1))
    return packed.reshape(n, SEGMENTS)


def soft_keys(packed: np.ndarray) -> np.ndarray:
    """The keys of each row of soft_decode(): for every two segments the COMBINED pairs of codewords that lose least."""
    codes = np.stack([packed >> (12 * k) & 0xFFF for k in range(NEAREST)], axis=2)
    loss = np.stack([np.zeros_like(packed), *(packed >> (48 + 5 * k) & 31 for k in range(NEAREST - 1))], axis=2)
    out = []
    for number, (i, j) in enumerate((i, j) for i in range(SEGMENTS) for j in range(i)):
        both = (codes[:, i, :, None] << 12 | codes[:, j, None, :]).reshape(len(packed), -1)
        cost = (loss[:, i, :, None] + loss[:, j, None, :]).reshape(len(packed), -1)
        least = np.argsort(cost, axis=1, kind="stable")[:, :COMBINED]
        out.append(number << 24 | np.take_along_axis(both, least, 1))
    return np.concatenate(out, axis=1)


PRINTS, SOFT = [f"f{k}" for k in range(WORDS)], [f"s{k}" for k in range(SEGMENTS)]
#: Texts soft-decoded at a time.
CHUNK = 128
#: Sets of shingles, and shingles, that one side of a tile holds; columns of a product of sets.
SETS, GRAMS, COLUMNS = 256, 1 << 20, 1 << 13


def _sketches(df: DataFrame, shingle: int) -> DataFrame:
    """df (with text) and for each text: 128 bits of its words' hash (h, h2), its prints, its soft-decoded segments."""
    names = ["h", "h2", *PRINTS, *SOFT]

    def rows(column: list[bytes | None]) -> dict[str, list]:
        found = np.zeros((len(column), len(names)), np.int64)
        for at in range(0, len(column), CHUNK):
            part = []
            for i, x in enumerate(column[at : at + CHUNK], at):
                whole, hashes = shingle_hashes(x, shingle)
                own = votes(hashes, WORDS)
                part.append(own.reshape(-1)[: 24 * SEGMENTS])
                found[i, : 2 + WORDS] = np.array([*divmod(xxhash.xxh3_128_intdigest(whole), 1 << 64), *map(_print, own)], np.uint64).view(np.int64)
            found[at : at + len(part), 2 + WORDS :] = soft_decode(np.array(part))
        return {n: found[:, k] for k, n in enumerate(names)}

    return arrow_map(df, ["text"], T.StructType([T.StructField(n, T.LongType()) for n in names]), rows)


def _soft_keyed(classes: DataFrame) -> DataFrame:
    """Rows (key, h, *prints) for the keys of classes."""
    names = ["key", "h", *PRINTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: c.to_numpy(zero_copy_only=False) for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            for at in range(0, batch.num_rows, 1 << 12):
                part = {n: c[at : at + (1 << 12)] for n, c in cols.items()}
                keys = soft_keys(np.stack([part[c] for c in SOFT], axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), *(pa.array(np.repeat(part[c], keys.shape[1])) for c in names[1:])], names=names)

    return classes.select("h", *PRINTS, *SOFT).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of sets (arrays of distinct longs) have that Jaccard similarity, exactly, as a square of booleans."""
    sizes = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # an element of one set alone is in no intersection
    shared = np.flatnonzero(often > 1)
    place = np.full(len(often), -1, np.int64)
    place[shared] = np.arange(len(shared))
    at = place[column]
    owner, at = owner[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, len(shared), COLUMNS):
        s, e = np.searchsorted(at, [low, low + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, len(shared) - low)), np.float32)
        part[owner[s:e], at[s:e] - low] = 1
        both += part @ part.T  # counts below 2 ** 24 are exact in single precision
    return both + 1e-9 >= similarity * (sizes[:, None] + sizes[None, :] - both)


def _verified(similarity: float) -> Callable:
    """compare() for _over_tiles: spanning forests of the similar pairs in tiles of sets (h, grams), as (a, b)."""

    def compare(tile: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        names, sets, found = tile["h"], tile["grams"], []
        for s, e in zip(*(b.tolist() for b in _bounds(tile)), strict=True):
            split = _split(tile, s, e)
            near = similar([np.asarray(x) for x in sets[s:e]], similarity)
            parent = list(range(e - s))

            def root(i: int) -> int:
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            for i in range(split):
                first = i + 1 if split == e - s else split
                for j in (np.flatnonzero(near[i, first:]) + first).tolist():
                    a, b = root(i), root(j)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        found.append((s + i, s + j))
        at = np.array(found, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(names[at[:, 0]]), pa.array(names[at[:, 1]])], names=["a", "b"])

    return compare


def groups(own: DataFrame, shingle: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (doc_id, t): the first document of each group of near-duplicates among own (doc_id, text), its text's xxhash64 as t.

    Candidates are linked to clusters by spanning forests of their keys' tiles. Within a
    cluster all pairs are verified, in tiles of sets of shingles, each of which gives a
    spanning forest of its similar pairs; the groups are the components of these.
    Only the texts of classes in clusters are read again.
    """
    bounded_batches(own.sparkSession)
    printed = _sketches(own, shingle).select("doc_id", F.xxhash64("text").alias("t"), "h", "h2", *PRINTS, *SOFT)
    first = F.min(F.struct("doc_id", "t")).alias("least")
    classes = materialize(printed.groupBy("h", "h2").agg(first, *(F.min(c).alias(c) for c in (*PRINTS, *SOFT))), "simhash-classes")
    keyed = materialize(_soft_keyed(classes), "simhash-keys")
    parts, hot = _tiles(keyed, "h")
    forest = _over_tiles(_forest("h", PRINTS, NEAR_BITS), parts.columns)
    found = materialize(parts.mapInArrow(forest, "a long, b long").filter("a != b").distinct(), "simhash-candidates")
    remove(keyed, hot)
    clusters = components(found, "a", "b").select(F.col("node").alias("h"), F.col("root").alias("key"))
    ends = materialize(clusters.join(classes.select("h", "least.*"), "h").withColumnsRenamed({"doc_id": "d", "t": "u"}), "simhash-clusters")
    texts_ = own.withColumn("t", F.xxhash64("text")).join(ends, (F.col("doc_id") == F.col("d")) & (F.col("t") == F.col("u"))).select("key", "h", "text")

    def rows(column: list[bytes | None]) -> dict[str, list]:
        return {"grams": [np.unique(np.array(shingle_hashes(x, shingle)[1], np.uint64)).view(np.int64) for x in column]}

    sets = arrow_map(texts_, ["text"], T.StructType([T.StructField("grams", T.ArrayType(T.LongType()))]), rows)
    # one row of each class, whatever rows repeat
    sets = materialize(sets.groupBy("key", "h").agg(F.first("grams").alias("grams")).withColumn("n", F.size("grams")), "simhash-grams")
    parts, _ = _tiles(sets, "h", SETS, "n", GRAMS)
    checked = parts.mapInArrow(_over_tiles(_verified(similarity), parts.columns), "a long, b long").filter("a != b").distinct()
    roots = components(materialize(checked, "simhash-checked"), "a", "b")
    rooted = classes.select("h", "least").join(roots.select(F.col("node").alias("h"), "root"), "h", "left")
    return rooted.groupBy(F.coalesce("root", "h").alias("root")).agg(F.min("least").alias("least")).select("least.*")


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id, once.

    Rows without a doc_id are kept. The columns are those of df.
    """
    names = private(df, "id", "t", "d", "u")
    own = df.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    with scratch(df.sparkSession):
        keep = groups(own, shingle, similarity).select(F.col("doc_id").alias(names["d"]), F.col("t").alias(names["u"]))
        keep = materialize(keep, "simhash-kept", result=True)
    rows = df.withColumn(names["id"], F.col(doc_id).cast("long")).withColumn(names["t"], F.xxhash64(F.col(text)))
    found = rows.join(keep, (F.col(names["id"]) == F.col(names["d"])) & (F.col(names["t"]) == F.col(names["u"])), "left_semi")
    found = found.dropDuplicates([names["id"], names["t"]]).select(*df.columns)
    return found.unionByName(df.filter(F.col(doc_id).isNull()))
