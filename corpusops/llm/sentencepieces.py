"""SentencePiece encoding and decoding; giant texts are encoded in chunks by a max-plus scan over the states at chunk boundaries.

The model is a BPE model. A sequence of pieces is what its merges make of a text exactly if each two neighbouring pieces are what the
merges make of these two alone ("they fit"). So encoding is a best path with weight 0 for neighbours that fit and minus infinity for
others, and exactly one path has weight 0. A state at a boundary is the last piece that ends at or before it, and where. A chunk's
transfer matrix holds the weight of the best path from each state at its start to each state at its end; max-plus products of such
matrices are associative, and with the states known at both ends each chunk finds its own pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusops.llm import words as W
from corpusops.llm.store import Workspace

CHUNK = 16_384  # code points; from here on a text is split and scanned
SLICE_BYTES = 1 << 20  # of texts that are encoded together; memory depends on this and not on CHUNK
ROWS_AT_ONCE = 64
BLOCK = 64  # chunks whose matrices are multiplied in one task
MARK = "▁"
UNKNOWN = -1
START = -2
State = tuple[int, int]  # how far before the boundary the last piece ends, and the piece


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    """Encodes like the library, but keeps U+2581 apart from a space (as its bytes), so that decoding always gives the text back."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor()
        self.sp.LoadFromSerializedProto(model)
        n = range(len(self.sp))
        special = {i for i in n if self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i)}
        self.text = {i: self.sp.id_to_piece(i).replace(MARK, " ") for i in n if i not in special}
        self.id = {t: i for i, t in self.text.items()}
        self.longest = max(map(len, self.id))
        self.mark = [self.sp.piece_to_id(f"<0x{b:02X}>") for b in MARK.encode()]
        self.fits = lru_cache(1 << 18)(self._fits)
        self.stable = lru_cache(1 << 16)(lambda i: self.raw(self.text[i]) == [i])
        bytes_of = {i: bytes([int(self.sp.id_to_piece(i)[3:-1], 16)]) if self.sp.is_byte(i) else self.text.get(i, "").encode() for i in n}
        self.table = pa.array([bytes_of[i] for i in n], pa.binary())
        self.spaced = np.array([self.text.get(i, "").startswith(" ") for i in n])
        self.plain = np.array([i in self.text or self.sp.is_byte(i) for i in n])

    def raw(self, text: str) -> list[int]:
        """The pieces of a text, without the space that encoding puts first. A line feed is a byte that merges with nothing."""
        out: list[int] = []
        for i, part in enumerate(text.split(MARK)):
            if i:
                out += self.mark
            if part:
                out += self.sp.encode("\n" + part)[2:]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The pieces of whole texts, encoded together unless they hold U+2581."""
        plain = iter(self.sp.encode([t for t in texts if MARK not in t], num_threads=1))
        return [np.array(self.raw(" " + t) if MARK in t else next(plain), np.int32) for t in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of pieces, as UTF-8. Ids of this encoder are joined from the table of pieces; others go to the library."""
        if not len(ids):
            return b""
        if self.plain[ids].all():
            taken = self.table.take(pa.array(ids, pa.int32()))
            _, offsets, data = taken.buffers()
            at = np.frombuffer(offsets, np.int32)
            joined = memoryview(data)[int(at[0]) + bool(self.spaced[ids[0]]) : int(at[len(ids)])]
            try:
                str(joined, "utf-8")
                return bytes(joined)
            except UnicodeDecodeError:
                pass
        return self.sp.decode(ids.tolist()).encode()

    def _fits(self, a: int, b: int) -> bool:
        return a < 0 or b < 0 or self.raw(self.text[a] + self.text[b]) == [a, b]

    def starting(self, text: str, at: int) -> Iterator[tuple[int, int]]:
        """(end, piece) of what can stand at a place; a character that is no piece stands alone."""
        if text[at] not in self.id:
            yield at + 1, UNKNOWN
        for end in range(at + 1, min(at + self.longest, len(text)) + 1):
            piece = self.id.get(text[at:end])
            if piece is not None and self.stable(piece):
                yield end, piece

    def states(self, text: str, at: int) -> list[State]:
        """All states that text around a boundary allows, in a fixed order."""
        if at == 0:
            return [(0, START)]
        found = set()
        for begin in range(max(0, at - 2 * self.longest), at):
            for end, piece in self.starting(text, begin):
                if at - self.longest < end <= at and (end == at or any(e > at and self.fits(piece, p) for e, p in self.starting(text, end))):
                    found.add((at - end, piece))
        if at < self.longest and any(e > at for e, _ in self.starting(text, 0)):
            found.add((at, START))
        return sorted(found)

    def paths(self, text: str, at: int, piece: int, stop: int) -> dict[int, dict[int, tuple[int, int]]]:
        """For each place up to `stop`, the pieces that can end there on a path of weight 0 from (at, piece), and what each follows."""
        reached: dict[int, dict[int, tuple[int, int]]] = {at: {piece: (-1, -1)}}
        for place in range(at, stop):
            if place in reached:
                for end, nxt in self.starting(text, place):
                    if end <= stop:
                        for last in reached[place]:
                            if self.fits(last, nxt):
                                reached.setdefault(end, {}).setdefault(nxt, (place, last))
        return reached

    def ids(self, text: str, reached: dict[int, dict[int, tuple[int, int]]], end: int, piece: int) -> list[int]:
        """The pieces of the path that ends so, in order."""
        back: list[list[int]] = []
        place, last = reached[end][piece]
        while place >= 0:
            back.append([piece] if piece >= 0 else self.raw(text[place:end]))
            end, piece = place, last
            place, last = reached[end][piece]
        return [i for part in reversed(back) for i in part]


def _cuts(text: str, start: int, end: int, away: int) -> tuple[int, int] | None:
    """The first place after `start` and the last one `away` or more before `end` where a word starts after a space: no piece goes across."""
    cut = lambda i: text[i] == " " and text[i - 1] != " "
    first = next((i for i in range(start + 1, end - away + 1) if cut(i)), None)
    return None if first is None else (first, next(i for i in range(end - away, start, -1) if cut(i)))


def transfer(codec: Codec, text: str, start: int, end: int, final: bool) -> np.ndarray:
    """The chunk [start, end) of `text`, which has context on both sides: weight of the best path per state at its start and end.

    A final chunk has one state at its end. With a cut inside, what happens before and after it is independent.
    """
    before = codec.states(text, start)
    after = [] if final else codec.states(text, end)
    out = np.full((len(before), len(after) or 1), -np.inf, np.float32)
    cut = _cuts(text, start, end, 1 if final else codec.longest)

    def into(reached: dict) -> list[int]:
        if final:
            return [0] if end in reached else []
        return [j for j, (back, piece) in enumerate(after) if piece in reached.get(end - back, {})]

    if cut:
        ends = into(codec.paths(text, cut[1], START, end))
    for i, (back, piece) in enumerate(before):
        if cut:
            ok = cut[0] in codec.paths(text, start - back, piece, cut[0])
            out[i, ends if ok else []] = 0
        else:
            out[i, into(codec.paths(text, start - back, piece, end))] = 0
    return out


def pieces_of(codec: Codec, text: str, start: int, end: int, final: bool, entry: int, leave: int) -> list[int]:
    """The pieces of a chunk between the state with number `entry` at its start and the one with number `leave` at its end."""
    back, piece = codec.states(text, start)[entry]
    cut = _cuts(text, start, end, 1 if final else codec.longest)

    def last(reached: dict) -> tuple[int, int]:
        if final:
            return end, next(iter(reached[end]))
        away, into = codec.states(text, end)[leave]
        return end - away, into

    if not cut:
        reached = codec.paths(text, start - back, piece, end)
        return codec.ids(text, reached, *last(reached))
    head = codec.paths(text, start - back, piece, cut[0])
    tail = codec.paths(text, cut[1], START, end)
    middle = codec.raw(text[cut[0] : cut[1]])
    return codec.ids(text, head, cut[0], next(iter(head[cut[0]]))) + middle + codec.ids(text, tail, *last(tail))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return np.stack([(row[:, None] + b).max(axis=0) for row in a])


def through(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The states between the matrices, on the best path from state `entry` to state `leave`: `entry` first, `leave` last."""
    ahead = [np.where(np.arange(matrices[-1].shape[1]) == leave, 0, -np.inf)]
    for m in reversed(matrices[1:]):
        ahead.append((m + ahead[-1][None, :]).max(axis=1))
    states = [entry]
    for m, rest in zip(matrices, reversed(ahead), strict=True):
        states.append(int(np.argmax(m[states[-1]] + rest)))
    return states


def _stored(matrix: np.ndarray) -> dict:
    return {"rows": matrix.shape[0], "columns": matrix.shape[1], "data": np.isfinite(matrix).tobytes()}


def _loaded(row: dict) -> np.ndarray:
    held = np.frombuffer(row["data"], bool).reshape(row["rows"], row["columns"])
    return np.where(held, np.float32(0), np.float32(-np.inf))


_MATRIX = pa.struct([("rows", pa.int32()), ("columns", pa.int32()), ("data", pa.binary())])
_MATRIX_SQL = "struct<rows:int,columns:int,data:binary>"


def _short(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            for part in W.slices(batch, size=SLICE_BYTES):
                ids = codec.encode([t or "" for t in part.column("text").to_pylist()])
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate([np.zeros(0, np.int32), *ids])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[*part.schema.names, "ids"])

    return run


def _cut(chunk: int, longest: int):
    """Texts (row, text) as chunks with some characters around them; a text is cut in one pass."""
    schema = pa.schema([("row", pa.int64()), ("chunk", pa.int32()), ("around", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("final", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch):
                text, rows = " " + r["text"], []
                for i, first in enumerate(range(0, len(text), chunk)):
                    begin, end = max(first - 2 * longest, 0), min(first + chunk, len(text))
                    rows.append({"row": r["row"], "chunk": i, "around": text[begin : end + 2 * longest], "start": first - begin, "end": end - begin, "final": end == len(text)})
                    if len(rows) == ROWS_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows, one at a time: chunks are long."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _transfers(model: bytes):
    schema = pa.schema([("row", pa.int64()), ("chunk", pa.int32()), ("matrix", _MATRIX)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            found = [_stored(transfer(codec, r["around"], r["start"], r["end"], r["final"])) for r in _rows(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array(found, _MATRIX)], schema=schema)

    return run


def _product(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    product = _loaded(rows[0]["matrix"])
    for r in rows[1:]:
        product = times(product, _loaded(r["matrix"]))
    return pa.table({"row": pa.array([rows[0]["row"]], pa.int64()), "block": pa.array([rows[0]["block"]], pa.int32()), "matrix": pa.array([_stored(product)], _MATRIX)})


def _through_rows(key: str, table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r[key])
    states = through([_loaded(r["matrix"]) for r in rows], rows[0].get("entry") or 0, rows[-1].get("leave") or 0)
    return pa.table({"row": pa.array([r["row"] for r in rows], pa.int64()), key: pa.array([r[key] for r in rows], pa.int32()), "entry": pa.array(states[:-1], pa.int32()), "leave": pa.array(states[1:], pa.int32())})


def _traced(model: bytes):
    schema = pa.schema([("row", pa.int64()), ("chunk", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids = [pieces_of(codec, r["around"], r["start"], r["end"], r["final"], r["entry"], r["leave"]) for r in _rows(part)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("chunk"), pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    return run


def _giants(giants: DataFrame, model: bytes, longest: int, chunk: int, block: int, work: Workspace) -> DataFrame:
    """`giants` (row, text) with ids. Chunks are rows of their own; one text's matrices meet in blocks, then one product per block."""
    chunks = giants.select("row", "text").mapInArrow(_cut(chunk, longest), "row long, chunk int, around string, start int, end int, final boolean")
    dealt = chunks.repartition("row", "chunk")
    matrices = work.keep(dealt.mapInArrow(_transfers(model), f"row long, chunk int, matrix {_MATRIX_SQL}").withColumn("block", F.floor(F.col("chunk") / block).cast("int")), "matrices")
    products = matrices.groupBy("row", "block").applyInArrow(_product, f"row long, block int, matrix {_MATRIX_SQL}")
    blocks = products.groupBy("row").applyInArrow(lambda t: _through_rows("block", t), "row long, block int, entry int, leave int")
    states = matrices.join(blocks, ["row", "block"]).groupBy("row", "block").applyInArrow(lambda t: _through_rows("chunk", t), "row long, chunk int, entry int, leave int")
    traced = chunks.join(states, ["row", "chunk"]).mapInArrow(_traced(model), "row long, chunk int, ids array<int>")
    ids = traced.groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("ids"))
    return giants.join(ids, "row").drop("row")


def encoded(docs: DataFrame, model: bytes, *, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """`docs` (text; other columns stay) with `ids`, the pieces of the whole text as the library's encoder gives them.

    Texts of up to `chunk` code points are one chunk and are encoded in place. Longer ones are split, whatever their length, and only they
    are shuffled. Null and empty texts have no pieces. Existing columns named `ids` are replaced.
    """
    docs = docs.drop("ids")
    work = Workspace(docs.sparkSession, "pieces")
    columns = docs.columns
    packed = docs.select("text", F.struct(*[c for c in columns if c != "text"]).alias("rest")) if len(columns) > 1 else docs
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    giants = work.keep(packed.where(long).withColumn("row", F.monotonically_increasing_id()), "giants")
    rest = [f for f in packed.schema if f.name != "text"]
    schema = ", ".join([*(f"{n} {packed.schema[n].dataType.simpleString()}" for n in packed.columns), "ids array<int>"])
    short = packed.where(~long).mapInArrow(_short(model), schema)
    both = short.unionByName(_giants(giants, model, Codec(model).longest, chunk, block, work))
    return both.select("rest.*", "text", "ids").select(*columns, "ids") if rest else both


def _decode(model: bytes, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            rows = [np.asarray(x.values, np.int32) if x.is_valid else np.zeros(0, np.int32) for x in batch.column("ids")]
            keep = [i for i in range(batch.num_columns) if i != at]
            if digest:
                ids = [hashlib.sha256(np.asarray(x, "<i4").tobytes()).hexdigest() for x in rows]
                texts = [hashlib.sha256(codec.decode(x)).hexdigest() for x in rows]
                new = {"n_pieces": pa.array([len(x) for x in rows], pa.int64()), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(texts, pa.string())}
            else:
                new = {"decoded": pa.array([codec.decode(x).decode() for x in rows], pa.string())}
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *new.values()], names=[*(batch.schema.names[i] for i in keep), *new])

    return run


def decoded(pieces: DataFrame, model: bytes, *, digest: bool = False) -> DataFrame:
    """`pieces` (ids; other columns stay) with `decoded` in place of ids; with `digest`, their count and the SHA-256 of both."""
    rest = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "ids")
    new = "n_pieces long, ids_sha256 string, decoded_sha256 string" if digest else "decoded string"
    return pieces.mapInArrow(_decode(model, digest), f"{rest}, {new}" if rest else new)


def _model() -> bytes:
    with open(model_path(), "rb") as f:
        return f.read()


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, n_pieces, ids_sha256 (of little-endian 32-bit ids), text_sha256, decoded_sha256, round_trip of every row."""
    text = F.coalesce("text", F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"), text.alias("text"))
    model = _model()
    pieces = encoded(docs, model).drop("text")
    return decoded(pieces, model, digest=True).withColumn("round_trip", F.col("text_sha256") == F.col("decoded_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_pieces, ids, round_trip): the documents as pieces, and whether decoding gives the text back."""
    model = _model()
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", "lang", "source", F.sha2(text, 256).alias("text_sha256"), text.alias("text"))
    pieces = encoded(named, model).drop("text").withColumn("kept", F.col("ids"))
    back = decoded(pieces, model, digest=True)
    return back.select("doc_id", "lang", "source", "n_pieces", F.col("kept").alias("ids"), (F.col("text_sha256") == F.col("decoded_sha256")).alias("round_trip"))
