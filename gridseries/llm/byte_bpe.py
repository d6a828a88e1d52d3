"""Byte-level BPE: texts to token ids and back.

A text is cut by the pattern of its vocabulary, and each match ("piece") is encoded on its own: a piece
that is a token is that token; else its bytes are joined pair by pair, always the pair of least rank, the
leftmost of equals. A segment tree over the byte positions holds at each position the rank of the pair that
begins there, and at its root the leftmost least one. A merge empties the position where the right part
began and sets the ranks of the two pairs that the new token forms with its live neighbours: three point
updates of logarithmic depth, so a piece of any length takes n log n steps. Short pieces are merged as a
forest of such trees, held in arrays.

The vocabulary is a file of ranks (``base64 rank`` lines). It is read on the driver and broadcast; its size
is checked. Rows are encoded where they lie: nothing is shuffled. Pieces recur, so a task remembers a
bounded number of short ones; that changes no result.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The broadcast vocabulary has so many tokens at most (some tens of MB).
MOST_TOKENS = 1 << 20
#: Over so many pieces a task forgets those that its last chunk did not use.
MOST_PIECES = 500_000
#: Characters, or ids, of a batch that a task turns at once (a longer row is turned alone), and trees of a forest.
CHUNK, FOREST = 1 << 21, 8192


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file. Every single byte must be a token and no rank occur twice."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    if len(ranks) > MOST_TOKENS or max(ranks.values()) >= 1 << 31:
        raise ValueError(f"{len(ranks)} tokens are too many (the bound is {MOST_TOKENS}) or a rank has over 31 bits")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} lacks single bytes")
    if len(set(ranks.values())) < len(ranks):
        raise ValueError(f"{path} gives a rank twice")
    return ranks


class RankTree:
    """Pair ranks of the positions of a piece; the root names the leftmost position of the least rank.

    An entry is ``rank * size + position``, so the least entry is the leftmost of the least rank.
    """

    def __init__(self, ranks: list[int | None]):
        self.size = size = 1 << max(0, len(ranks) - 1).bit_length()
        self.none = none = 1 << 62
        self.nodes = nodes = [none] * (2 * size)
        nodes[size : size + len(ranks)] = [none if r is None else r * size + k for k, r in enumerate(ranks)]
        for k in range(size - 1, 0, -1):
            nodes[k] = min(nodes[2 * k], nodes[2 * k + 1])

    def least(self) -> int | None:
        """The position, or None if no pair has a rank."""
        top = self.nodes[1]
        return None if top == self.none else top & (self.size - 1)

    def put(self, position: int, rank: int | None) -> None:
        nodes, k = self.nodes, position + self.size
        nodes[k] = self.none if rank is None else rank * self.size + position
        k >>= 1
        while k:
            a, b = nodes[2 * k], nodes[2 * k + 1]
            a = a if a < b else b
            if nodes[k] == a:
                return
            nodes[k] = a
            k >>= 1


def merge(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """Ids of a piece that is not empty, by merges alone. No token is longer than ``longest``."""
    n, get = len(piece), ranks.get
    if n == 1:
        return [ranks[piece]]
    tree = RankTree([get(piece[k : k + 2]) for k in range(n - 1)])
    end, before = list(range(1, n + 1)), list(range(-1, n))

    def rank(a: int, b: int) -> int | None:
        return get(piece[a:b]) if b - a <= longest else None

    while (left := tree.least()) is not None:
        right = end[left]
        after = end[left] = end[right]
        before[after] = left
        if right < n - 1:
            tree.put(right, None)
        tree.put(left, rank(left, end[after]) if after < n else None)
        if (first := before[left]) >= 0:
            tree.put(first, rank(first, after))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : end[at]]])
        at = end[at]
    return out


class Ranks:
    """The ranks of a vocabulary by bytes, and by the two tokens that a pair joins."""

    def __init__(self, ranks: dict[bytes, int]):
        self.of = ranks
        self.longest = max(map(len, ranks))
        joins = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        pairs = np.array(joins, np.int64).reshape(-1, 3)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.joined = np.append(keys[order], np.int64(1) << 62), np.append(pairs[order, 2], -1)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, -1 where the pair is none."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.joined[at], -1)


def merge_all(pieces: list[bytes], ranks: Ranks, width: int) -> list[bytes]:
    """:func:`merge` of many pieces of 2 to ``width`` bytes (a power of two) at once: a forest of equal trees,
    in which every piece makes its next merge in turn. Gives ids as bytes, four of an id."""
    rows, sizes = len(pieces), np.array([len(p) for p in pieces])
    none = np.int64(1) << 50
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(rows, width)
    token = ranks.single[raw]
    after = np.tile(np.arange(1, width + 1), (rows, 1))
    before = np.tile(np.arange(-1, width), (rows, 1))
    place = np.arange(width)
    trees = np.full((rows, 2 * width), none)
    first = ranks.pairs(token[:, :-1], token[:, 1:])
    fits = (place[:-1] + 1 < sizes[:, None]) & (first >= 0)
    trees[:, width : 2 * width - 1] = np.where(fits, first * width + place[:-1], none)
    for k in range(width - 1, 0, -1):
        trees[:, k] = np.minimum(trees[:, 2 * k], trees[:, 2 * k + 1])

    def put(row: np.ndarray, position: np.ndarray, rank: np.ndarray) -> None:
        k = position + width
        trees[row, k] = np.where(rank < 0, none, rank * width + position)
        while width > 1 and k[0] > 1:  # all leaves are equally deep
            k = k >> 1
            trees[row, k] = np.minimum(trees[row, 2 * k], trees[row, 2 * k + 1])

    live = np.flatnonzero(trees[:, 1] < none)
    while len(live):
        top = trees[live, 1]
        left, made = top % width, top // width
        right = after[live, left]
        end = after[live, right]
        token[live, left], after[live, left], before[live, end], after[live, right] = made, end, left, 0
        put(live, right, np.full(len(live), -1))
        has = end < sizes[live]
        put(live, left, np.where(has, ranks.pairs(made, token[live, np.where(has, end, 0)]), -1))
        held = before[live, left] >= 0
        if held.any():
            row, at = live[held], before[live, left][held]
            put(row, at, ranks.pairs(token[row, at], made[held]))
        live = live[trees[live, 1] < none]
    starts = (after > 0) & (place < sizes[:, None])
    ids = token[starts].astype(np.uint32).tobytes()
    ends = np.cumsum(starts.sum(axis=1)) * 4
    return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def stand_ins(pattern: str) -> dict[int, str]:
    """Characters that tiktoken's Unicode version puts into other classes of a pattern than the regex package's
    does, each with one that both put where tiktoken has the first."""
    import tiktoken

    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    ours, theirs = [], []
    for name in sorted(set(regex.findall(r"\\p\{\w+\}|\\s", pattern))):
        # an encoding of single bytes gives the bytes of what its pattern matches
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs.append(set(bytes(probe.encode_ordinary(every)).decode("utf-8")))
        ours.append(set(regex.findall(name, every)))
    odd = set().union(*(a ^ b for a, b in zip(ours, theirs, strict=True)))
    alike: dict[tuple, str] = {}
    for c in every[128:] if odd else "":  # characters that a pattern names itself are ASCII
        if c not in odd:
            alike.setdefault(tuple(c in x for x in theirs), c)
    return {ord(c): alike[tuple(c in x for x in theirs)] for c in odd}


class Finder:
    """Pieces of a text; ``unlike`` has the stand-ins for characters that the regex package takes otherwise."""

    def __init__(self, pattern: str, unlike: dict[int, str]):
        self.pattern, self.unlike = regex.compile(pattern), unlike
        self.first = chr(min(unlike, default=sys.maxunicode))

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or max(text) < self.first:
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.unlike))]


class Encoder:
    """Ids of texts, and bytes of ids. ``pattern`` is that of the vocabulary."""

    #: Widths of the forests; longer pieces have a tree of their own and are not remembered.
    WIDTHS = (4, 8, 16, 32, 64)

    def __init__(self, ranks: dict[bytes, int], pattern: str, unlike: dict[int, str]):
        self.find = Finder(pattern, unlike)
        self.ranks = Ranks(ranks)
        self.known: dict[str, bytes] = {}
        self.passing: list[str] = []  # long pieces, known within a chunk only
        self.tokens = {rank: token for token, rank in ranks.items()}

    def learn(self, pieces: set[str]) -> None:
        """Adds the ids of new pieces to what is known."""
        groups: dict[int, list[str]] = {}
        for piece in pieces:
            raw = piece.encode("utf-8")
            whole = self.ranks.of.get(raw)
            if whole is not None:
                self.known[piece] = array("I", [whole]).tobytes()
            else:
                groups.setdefault(next((w for w in self.WIDTHS if len(raw) <= w), 0), []).append(piece)
        self.passing += groups.get(0, [])
        for width, group in groups.items():
            for at in range(0, len(group), FOREST):
                part = group[at : at + FOREST]
                raw = [p.encode("utf-8") for p in part]
                found = merge_all(raw, self.ranks, width) if width else [array("I", merge(x, self.ranks.of, self.ranks.longest)).tobytes() for x in raw]
                self.known.update(zip(part, found, strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, four bytes of an id in this machine's order."""
        cut = [self.find(text or "") for text in texts]
        used = set().union(*cut)
        self.learn(used - self.known.keys())
        out = [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
        for piece in self.passing:
            del self.known[piece]
        self.passing.clear()
        if len(self.known) > MOST_PIECES:
            self.known = {p: self.known[p] for p in used & self.known.keys()}
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        """Raises ``KeyError`` of an id that is no token's."""
        return b"".join(map(self.tokens.__getitem__, ids))


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive runs of rows (first, number) of about ``CHUNK`` together, of one row at least."""
    at, held = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if held and held + n > CHUNK:
            yield at, k - at
            at, held = k, 0
        held += n
    if len(sizes) > at:
        yield at, len(sizes) - at


def _mapped(docs: DataFrame, read: str, made: str, kind: str, turn, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``docs`` with column ``made``: what ``turn`` makes of column ``read``. All other columns travel."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern, stand_ins(pattern)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*shared.value)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(read)) if pa.types.is_string(batch.column(read).type) else pa.compute.list_value_length(batch.column(read))
            for first, n in _runs(sizes.fill_null(0).to_numpy(zero_copy_only=False)):
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays([*part.columns, turn(encoder, part.column(read))], names=[*part.schema.names, made])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{made}` {kind}"])
    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """The columns ``keep`` and ``ids``, the token ids of each row's whole text.

    Null and empty texts have no ids (an empty array). Repeated rows and null ids stay; other columns, of
    whatever name, are left behind; an empty table gives an empty one. Special tokens are plain text.
    """
    if ids_col in keep:
        raise ValueError(f"{ids_col} is the name of the result")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"))

    def turn(encoder: Encoder, texts: pa.Array) -> pa.Array:
        found = encoder.encode(texts.to_pylist())
        offsets = np.cumsum([0, *(len(f) // 4 for f in found)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))

    return _mapped(rows, "__text", ids_col, "array<int>", turn, read_ranks(vocabulary_path), pattern).drop("__text")


def decode(encoded: DataFrame, vocabulary_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """All columns and ``decoded``, the bytes of each row's ids (of any ids, so not always valid UTF-8).

    Null ids give null, none give no bytes. An id that is no token's, or a null among the ids, fails
    the job and is named.
    """
    if bytes_col in encoded.columns:
        raise ValueError(f"{bytes_col} is a column already")

    def turn(encoder: Encoder, rows: pa.Array) -> pa.Array:
        return pa.array([None if ids is None else encoder.decode(ids) for ids in rows.to_pylist()], pa.binary())

    return _mapped(encoded, ids_col, bytes_col, "binary", turn, read_ranks(vocabulary_path), "")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of ids, digest of the ids and digest of the decoded bytes of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, public_tokenizers.PATTERN)
    return decode(coded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
