"""Byte-level BPE: texts to ids by the ranks of a vocabulary and back, with a rank queue that stays fast on very long pre-tokens.

Merges are taken from buckets, one per rank, that hold places in a linked list of parts. A bitmap of three levels says which buckets
have entries; the lowest set bit of its top, middle and bottom words gives the least rank in three steps, however many ranks there
are. A merge leaves the entries of its neighbours behind as stale; they are skipped when they come up. So a pre-token of n bytes costs
n log n, and not n for each merge.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm import words as W

SLICE_BYTES = 1 << 20
SEGMENT = 1 << 16  # code points that are split into pre-tokens at once
TOGETHER = 1 << 20  # code points whose unknown pre-tokens are merged in one list
REMEMBERED = 200_000  # pre-tokens of up to REMEMBERED_BYTES whose ids a worker keeps
REMEMBERED_BYTES = 64
BITS = 6
BIT = [1 << i for i in range(64)]


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(1)
def newer() -> dict[int, int]:
    """Letters and digits that this Python's tables know and those of the tiktoken library do not yet, all mapped to a character that has no class."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        single = tiktoken.Encoding(kind, pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        found |= set(regex.findall(kind, every)) - set(bytes(single.encode_ordinary(every)).decode())
    return dict.fromkeys(map(ord, found), 0x378)


class RankQueue:
    """Places by merge rank, and bitmaps of three levels in words of 64 bits that say which ranks have any; `take` gives all places of the least rank.

    It is empty after each use and then serves the next one, so the words are laid out once.
    """

    def __init__(self, ranks: int) -> None:
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.bottom, self.middle = [0] * ((ranks >> BITS) + 1), [0] * ((ranks >> 2 * BITS) + 1)
        self.top = 0

    def put(self, rank: int, place: int) -> None:
        bucket = self.buckets[rank]
        if not bucket:
            word = rank >> BITS
            bits = self.bottom[word]
            self.bottom[word] = bits | BIT[rank & 63]
            if not bits:
                high = word >> BITS
                self.middle[high] |= BIT[word & 63]
                self.top |= BIT[high]
        bucket.append(place)

    def take(self) -> tuple[int, list[int]] | None:
        """The least rank, found by the lowest set bit of each level, and its places in rising order."""
        if not self.top:
            return None
        high = (self.top & -self.top).bit_length() - 1
        bits = self.middle[high]
        word = high << BITS | (bits & -bits).bit_length() - 1
        bits = self.bottom[word]
        lowest = bits & -bits
        rank = word << BITS | lowest.bit_length() - 1
        self.bottom[word] = bits ^ lowest
        if bits == lowest:
            self.middle[high] ^= BIT[word & 63]
            if not self.middle[high]:
                self.top ^= BIT[high]
        places, self.buckets[rank] = self.buckets[rank], []
        places.sort()
        return rank, places


class Vocabulary:
    """The ranks of byte strings. `ids` is what the merges make of one pre-token."""

    def __init__(self, ranks: bytes, split: str) -> None:
        import regex

        self.rank = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line)}
        if max(self.rank.values(), default=0) >> 3 * BITS:
            raise ValueError(f"ranks go up to {(1 << 3 * BITS) - 1}")
        self.split = regex.compile(split)
        self.blank = regex.compile(r"(?<=\S)\s")
        self.newer = newer()
        self.odd = np.zeros(0x110000, bool)
        self.odd[list(self.newer)] = True
        self.known: dict[str, tuple[int, ...]] = {}  # words seen lately
        self.older: dict[str, tuple[int, ...]] = {}  # those of the time before
        size = max(self.rank.values(), default=-1) + 1
        self.queue = RankQueue(size)
        tokens: list[bytes] = [b""] * size
        for token, rank in self.rank.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.binary())
        self.decimals = pa.array([b"%d," % i for i in range(size)], pa.binary())

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """For each pre-token the ids of the parts that are left when no neighbours have a rank; the least rank first, the leftmost of equal ones first.

        All pre-tokens lie in one list with fences between them, so the bitmaps are searched once for all places of a rank.
        """
        text, rank = b"".join(pieces), self.rank
        n, get, put, take = len(text), rank.get, self.queue.put, self.queue.take
        fence = bytearray(n + 1)  # 1 where a pre-token starts
        at = 0
        for piece in pieces:
            fence[at] = 1
            at += len(piece)
        fence[n] = 1
        end = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n))  # where the part before the one that starts here starts
        now = [-1 if fence[i + 1] else get(text[i : i + 2], -1) for i in range(n)]  # the rank of the part that starts here with the next one
        for i, found in enumerate(now):
            if found >= 0:
                put(found, i)
        while (least := take()) is not None:
            current, places = least
            for done, i in enumerate(places, 1):
                if now[i] != current:
                    continue  # stale
                middle = end[i]
                stop = end[i] = end[middle]
                now[middle] = now[i] = -1
                lower = False
                if not fence[stop]:
                    before[stop] = i
                    found = now[i] = get(text[i : end[stop]], -1)
                    if found >= 0:
                        put(found, i)
                        lower = found < current
                if not fence[i]:
                    left = before[i]
                    found = now[left] = get(text[left:stop], -1)
                    if found >= 0:
                        put(found, left)
                        lower |= found < current
                if lower:  # that goes first
                    for rest in places[done:]:
                        put(current, rest)
                    break
        out, i = [], 0
        while i < n:
            ids = [rank[text[i : end[i]]]]
            i = end[i]
            while not fence[i]:
                ids.append(rank[text[i : end[i]]])
                i = end[i]
            out.append(tuple(ids))
        return out

    def learn(self, words: set[str]) -> list[str]:
        """Afterwards `known` has all these pre-tokens; returns those too long to be kept."""
        if len(self.known) >= REMEMBERED:
            self.older, self.known = self.known, {}
        known, older, pieces, new = self.known, self.older, [], []
        for word in words:
            if word in known:
                continue
            found = older.get(word)
            if found is None:
                piece = word.encode()
                whole = self.rank.get(piece)
                if whole is None:
                    pieces.append(piece)
                    new.append(word)
                    continue
                found = (whole,)
            known[word] = found
        known.update(zip(new, self.merged(pieces), strict=True))
        return [w for w, piece in zip(new, pieces, strict=True) if len(piece) > REMEMBERED_BYTES]

    def segments(self, text: str) -> Iterator[str]:
        """The text in runs of about SEGMENT code points. Pre-tokens never go across the start of a white space, so no run cuts one."""
        at = 0
        while len(text) - at > SEGMENT:
            cut = self.blank.search(text, at + SEGMENT)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def words(self, run: str) -> list[str]:
        """The pre-tokens of a run, with the character classes of the tiktoken library."""
        if run.isascii() or not self.odd[np.frombuffer(run.encode("utf-32-le"), np.uint32)].any():
            return self.split.findall(run)
        return [run[m.start() : m.end()] for m in self.split.finditer(run.translate(self.newer))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int32)] for _ in texts]
        held: list[tuple[int, list[str]]] = []

        def finish() -> None:
            long = self.learn({word for _, words in held for word in words})
            known = self.known
            for i, words in held:
                out[i].append(np.array([x for word in words for x in known[word]], np.int32))
            for word in long:
                del known[word]
            held.clear()

        size = 0
        for i, text in enumerate(texts):
            for run in self.segments(text):
                held.append((i, self.words(run)))
                size += len(run)
                if size >= TOGETHER:
                    finish()
                    size = 0
        finish()
        return [np.concatenate(parts) for parts in out]

    def joined(self, table: pa.Array, ids: pa.Array) -> memoryview:
        """The entries of `table` at `ids`, one after the other."""
        taken = table.take(ids)
        if not len(taken):
            return memoryview(b"")
        _, offsets, data = taken.buffers()
        at = np.frombuffer(offsets, np.int32)
        return memoryview(data)[int(at[taken.offset]) : int(at[taken.offset + len(taken)])]


@lru_cache(2)
def vocabulary(ranks: bytes, split: str) -> Vocabulary:
    """One per Python worker, with what it remembers."""
    return Vocabulary(ranks, split)


def _encode(ranks: bytes, split: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(ranks, split)
        for batch in batches:
            for part in W.slices(batch, size=SLICE_BYTES):
                at = part.schema.get_field_index("text")
                ids = known.encode([x or "" for x in part.column(at).to_pylist()])
                offsets = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                column = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
                keep = [i for i in range(part.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in keep), column], names=[*(part.schema.names[i] for i in keep), "ids"])

    return run


def _fields(frame: DataFrame, without: str) -> list[str]:
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != without]


def encoded(docs: DataFrame, ranks: bytes, split: str) -> DataFrame:
    """`docs` (text; other columns stay) with `ids`, array<int>, in place of text: each match of `split` encoded by itself by `ranks`.

    `ranks` has lines of a base64 byte string and its rank, up to 2^18 ranks. No special tokens. Null and empty texts have no ids. A
    column named `ids` is replaced. Nothing is shuffled and rows stay apart, so ties, repeated rows and empty tables need no care. A
    task holds about a megabyte of texts, or one text, and the ids of 400,000 short pre-tokens.
    """
    docs = docs.drop("ids")
    return docs.mapInArrow(_encode(ranks, split), ", ".join([*_fields(docs, "text"), "ids array<int>"]))


def _decode(ranks: bytes, split: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(ranks, split)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            keep = [i for i in range(batch.num_columns) if i != at]
            rows = [x.values if x.is_valid else pa.array([], pa.int32()) for x in batch.column(at)]
            if digest:
                new = {
                    "n_tokens": pa.array([len(r) for r in rows], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(known.joined(known.decimals, r)[:-1]).hexdigest() for r in rows], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(known.joined(known.tokens, r)).hexdigest() for r in rows], pa.string()),
                }
            else:
                new = {"decoded": pa.array([bytes(known.joined(known.tokens, r)) for r in rows], pa.binary())}
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *new.values()], names=[*(batch.schema.names[i] for i in keep), *new])

    return run


def decoded(pieces: DataFrame, ranks: bytes, split: str, *, digest: bool = False) -> DataFrame:
    """`pieces` (ids; other columns stay) with `decoded`, the bytes, in place of ids; with `digest`, their count and the SHA-256 of both.

    Bytes and not a string, since ids may be cut anywhere in a character. Null ids give no bytes; an id beyond the ranks is an error.
    Columns named like the new ones are replaced.
    """
    new = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "decoded binary"
    pieces = pieces.drop(*(x.split()[0] for x in new.split(", ")))
    return pieces.mapInArrow(_decode(ranks, split, digest), ", ".join([*_fields(pieces, "ids"), new]))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, and whether the decoded bytes are the text's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    with open(ranks_path(), "rb") as f:
        ranks = f.read()
    pieces = encoded(docs.withColumn("text_sha256", F.sha2("text", 256)), ranks, pattern())
    return decoded(pieces, ranks, pattern(), digest=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", (F.col("text_sha256") == F.col("decoded_sha256")).alias("round_trip"))
