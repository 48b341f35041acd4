"""Vector bin packing of token sequences by the dot-product heuristic.

A sequence is filled under three limits at once: tokens, segments (pieces of documents), and tokens that bear loss. A
document's first tokens are context and bear none: a prompt, or the prefix of a prefix language model. Of a document
longer than a sequence, sequences of its own are cut that take context and loss-bearing tokens in the proportion that
they have in it; what remains is packed with other documents' remains, a window of them at a time, whatever limit fills
a sequence. Packing needs no shuffle: each input partition packs its own documents, and sequences that are not full of
tokens are cut down by powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import tokens
from freshet.session import ensure_importable

LENGTH = 1024
MAX_SEGMENTS = 16
MAX_LOSS = 832
#: Share of a document's tokens that are context, where no column says how many are.
PREFIX = 0.25
#: Remainders packed together; bounds the heuristic's work and memory.
WINDOW = 512
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Piece:
    """Ids of a document from ``start`` on; its first ``quiet`` ids bear no loss."""

    __slots__ = ("doc", "start", "ids", "total", "quiet")

    def __init__(self, doc, start: int, ids: bytes, total: int, quiet: int = 1):
        self.doc, self.start, self.ids, self.total, self.quiet = doc, start, ids, total, quiet

    def __len__(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return len(self) - min(len(self), max(0, self.quiet - self.start))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc, self.start, self.ids[: 4 * n], self.total, self.quiet)
        return head, Piece(self.doc, self.start + n, self.ids[4 * n :], self.total, self.quiet)


def dot_product_bins(pieces: list[Piece], length: int, segments: int, loss: int) -> list[list[Piece]]:
    """Fills one sequence after another: of the pieces that fit what is left of every limit, the one whose demand has
    the greatest dot product with what is left, each dimension weighted by its share of the demand still to place. A
    sequence that no piece fits, or that has room for one segment more, takes the longest head that any piece has for
    it, which is cut. Only the last sequence may have room that some piece of another could have filled."""
    if not pieces:
        return []
    limit = np.array([length, segments, loss], dtype=float)
    pieces = list(pieces)
    demand = np.array([[len(p), 1, p.loss] for p in pieces], dtype=float)
    bins = []
    left_total = demand.sum(axis=0)
    live = len(pieces)  # live pieces come first
    while live:
        weight = left_total / limit
        weight = weight / max(weight.sum(), 1e-9) / limit / limit
        room, chosen = limit.copy(), []
        while live and room[0] >= 1 and room[1] >= 1:
            own = demand[:live]
            fits = (own <= room).all(axis=1)
            if room[1] >= 2 and fits.any():
                at = int(np.argmax(np.where(fits, own @ (weight * room), -1.0)))
                n = len(pieces[at])
            else:  # a head: as many tokens as fit, of which the first bear no loss
                heads = np.minimum(np.minimum(own[:, 0], room[0]), room[2] + own[:, 0] - own[:, 2])
                at = int(np.argmax(heads * (2 * length) + own[:, 0]))
                n = int(heads[at])
                if n < 1:
                    break
            left_total -= demand[at]
            if n < len(pieces[at]):
                head, pieces[at] = pieces[at].cut(n)
                demand[at] = (len(pieces[at]), 1, pieces[at].loss)
                left_total += demand[at]
            else:
                head, live = pieces[at], live - 1
                pieces[at], demand[at] = pieces[live], demand[live]
            chosen.append(head)
            room -= (n, 1, head.loss)
        bins.append(chosen)
    return bins


def powers(bin_: list[Piece], length: int) -> list[list[Piece]]:
    """Cuts a partly filled sequence into sequences of powers of two, so that it needs no padding."""
    out, rest = [], list(bin_)
    total = sum(map(len, rest))
    while total:
        size = 1 << (min(total, length).bit_length() - 1)
        taken, room = [], size
        while room:
            p = rest.pop(0)
            if len(p) > room:
                p, tail = p.cut(room)
                rest.insert(0, tail)
            taken.append(p)
            room -= len(p)
        out.append(taken)
        total -= size
    return out


def _cut(doc, ids: bytes, quiet: int, length: int, segments: int, loss: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences of a document alone, and what remains of it in pieces that fit a sequence. A sequence takes tokens
    of the context and tokens behind it, in the proportion of what is left of both."""
    total = len(ids) // 4
    quiet = min(quiet, total)

    def piece(a: int, b: int) -> Piece:
        return Piece(doc, a, ids[4 * a : 4 * b], total, quiet)

    own, rest = [], []
    front, back = 0, quiet  # the next token of the context, and behind it
    while total - back + quiet - front >= length:
        bearing = min(loss, total - back, round(length * (total - back) / (total - back + quiet - front)))
        silent = length - bearing
        joined = front + silent == quiet == back
        if silent > quiet - front or (silent and bearing and not joined and segments < 2):
            break
        spans = [(front, back + bearing)] if joined else [(front, front + silent), (back, back + bearing)]
        own.append([piece(a, b) for a, b in spans if b > a])
        front, back = front + silent, back + bearing
    runs = [(front, total)] if back == quiet else [(front, quiet), (back, total)]
    for at, end in runs:
        while at < end:
            n = min(end - at, length, loss + max(0, quiet - at))
            rest.append(piece(at, at + n))
            at += n
    return own, rest


def pack(
    docs: Iterator[tuple[int, bytes, int]], length: int = LENGTH, segments: int = MAX_SEGMENTS, loss: int = MAX_LOSS, window: int = WINDOW
) -> Iterator[list[Piece]]:
    """Sequences of the pieces of ``docs`` (id, packed ids, how many of the first bear no loss); each id is in exactly
    one piece. No more than a window of pieces, and those of one document, waits at any time."""
    waiting: list[Piece] = []

    def emit(bin_: list[Piece]) -> Iterator[list[Piece]]:
        if sum(map(len, bin_)) == length:
            yield bin_
        else:
            yield from powers(bin_, length)

    for doc, ids, quiet in docs:
        own, rest = _cut(doc, ids, quiet, length, segments, loss)
        yield from own
        waiting += rest
        if len(waiting) >= window:
            *done, waiting = dot_product_bins(waiting, length, segments, loss)  # the last may have room for what comes
            for b in done:
                yield from emit(b)
    for b in dot_product_bins(waiting, length, segments, loss):
        yield from emit(b)


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    length: int = LENGTH, segments: int = MAX_SEGMENTS, loss: int = MAX_LOSS, prompt_col: str | None = None, prefix: float = PREFIX,
) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Sequences hold at most ``length`` tokens, ``segments`` pieces and ``loss`` loss-bearing tokens. ``prompt_col`` says
    how many of a row's first tokens are a prompt and bear no loss (null or less than 1: one, which nothing predicts);
    without it the share ``prefix`` of a row's tokens, one at least, is context. A null or empty text is its end id
    alone; repeated rows and null ids are packed as they come; an empty table gives no rows; other columns are ignored.
    ``sequence_id`` is the partition's number times 2^33 plus a count: it depends on how the input is split, as do the
    sequences themselves.
    """
    vocabulary = vocabulary or tokens.tokenizer_path()
    ensure_importable(docs.sparkSession)
    quiet = F.lit(0) if prompt_col is None else F.greatest(F.lit(1), F.coalesce(F.col(prompt_col), F.lit(1))).cast("int")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), quiet.alias("quiet"))

    def run(batches):
        base = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def documents():
            for batch in batches:
                ids, silent = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                for lo, _, flat, counts in tokens.encoded(batch.column(1), vocabulary):
                    raw = flat.tobytes()
                    ends = (4 * np.cumsum(counts)).tolist()
                    for doc, still, a, b in zip(ids[lo:], silent[lo:], [0, *ends], ends):
                        yield doc, raw[a:b], still or max(1, int((b - a) // 4 * prefix))

        def table():
            columns = zip(*rows) if rows else [()] * 7
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            rows.clear()
            return out

        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for k, sequence in enumerate(pack(documents(), length, segments, loss)):
            offset = 0
            for p in sequence:
                rows.append((p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, base + k, offset))
                offset += len(p)
            if len(rows) >= 10_000:
                yield table()
        if rows:
            yield table()

    return given.mapInArrow(run, SCHEMA)
