"""Language-model scores by deleted interpolation.

The probability of a word after another mixes three maximum-likelihood estimates, of the pair, of the word and of no
knowledge; the mixture depends on how often the context was seen, in buckets of powers of two, and is learned by
expectation-maximisation on the counts of held-out training documents.

Counting never gathers occurrences. A *block* is a stretch of ``BLOCK_BYTES`` of one partition of the input, however
large that partition, or a row group of its files, is; texts are first written to the shared folder with the number of
their block, so that blocks are data and later passes may split their input as they like. A block's distinct words and
word pairs are counted where they are read, packed in sorted arrays, one for each hash range, and sent to that range,
which adds the counts of all blocks and sends each block the totals of what it asked about. Scoring meets a block's texts
with its own totals. There is one hash range for each ``RANGE_BYTES`` of text, so that a range, like a block, stays of one
size as the corpus grows, and nothing that grows with it is broadcast or held by one task. What is shuffled: the texts
once, eight bytes for each distinct pair of each block, and its count on the way back.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import textkernel as tk
from freshet.llm.labelled import remainder
from freshet.llm.storage import discard, save, shuffle_partitions
from freshet.session import ensure_importable

#: Buckets of context counts: 0, 1, 2-3, 4-7, ...
BUCKETS = 40
#: Steps of log2 by which ratios are rounded before EM; its statistics are then a bounded table.
STEP = 8
#: Text for each hash range. Words and pairs of a range are a table each, of about twice that size.
RANGE_BYTES = 8 << 20
#: Text of a block, but for its last row. A task holds the tokens and counts of one at a time.
BLOCK_BYTES = 16 << 20
#: Bytes of requests that go to the JVM at once.
SEND_BYTES = 1 << 20
WORD, PAIR = 0, 1


def _pair(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return tk.mix(before * tk.U64(0xD1342543DE82EF95) + (after ^ (after >> tk.U64(32))))


class Tokens:
    """Words of a slice of rows, each row's followed by the end token, and their pair with the one before."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        w = tk.words(data, offsets)
        n = len(offsets) - 1
        self.counts = w.counts + 1
        self.row = np.repeat(np.arange(n), self.counts)
        self.word = np.empty(len(w.hashes) + n, dtype=np.uint64)
        self.word[np.arange(len(w.hashes)) + w.row] = w.hashes
        self.first = np.concatenate(([0], np.cumsum(self.counts)[:-1])) if n else np.zeros(0, dtype=np.int64)
        self.word[self.first + w.counts] = tk.U64(tk.END)
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[self.first] = tk.U64(tk.START)
        self.pair = _pair(self.before, self.word)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and summed rows of counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros((0, 2), np.uint32)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[first], np.add.reduceat(c, first, axis=0)


class Numbered:
    """A block's texts as numbers: its sorted distinct words, with the start token, and pairs, and each token's place
    among them. Keys are sorted slice by slice and the slices' distinct keys are then placed in order, so nothing is
    looked up at random."""

    def __init__(self, texts: pa.ChunkedArray):
        self.rows: list[np.ndarray] = []
        local: tuple[list, list] = ([], [])
        place: tuple[list, list] = ([], [])
        for _, _, data, offsets in tk.slices(texts):
            t = Tokens(data, offsets)
            self.rows.append(t.counts)
            for kind, keys in ((WORD, t.word), (PAIR, t.pair)):
                distinct, inverse = np.unique(keys, return_inverse=True)
                local[kind].append(distinct)
                place[kind].append(inverse.astype(np.int32))
        start = np.array([tk.START], dtype=np.uint64)
        self.keys = tuple(np.unique(np.concatenate([start] * (kind == WORD) + local[kind] + [np.zeros(0, np.uint64)])) for kind in (WORD, PAIR))
        self._local, self._place = local, place

    def __iter__(self):
        """For each slice its rows' token counts, and its tokens' numbers as words and as pairs."""
        for i, counts in enumerate(self.rows):
            yield counts, *(np.searchsorted(self.keys[k], self._local[k][i])[self._place[k][i]] for k in (WORD, PAIR))


def _count(keys: np.ndarray, train: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.stack([np.bincount(inverse, weights=x, minlength=len(distinct)).astype(np.uint32) for x in (train, held)], axis=1)


class Counter:
    """Counts of a block: ``[in training, of that in its held-out part]`` for every word and pair, zeros included."""

    def __init__(self):
        self.keys, self.counts, self.size = ([], []), ([], []), [0, 0]

    def add(self, data: np.ndarray, offsets: np.ndarray, role: np.ndarray) -> None:
        t = Tokens(data, offsets)
        r = role[t.row]
        train, held = (r >= 1).astype(np.int64), (r == 2).astype(np.int64)
        # the start token counts once for each training document
        words = np.concatenate([t.word, np.full(len(role), tk.START, dtype=np.uint64)])
        marks = np.concatenate([train, role >= 1]), np.concatenate([held, role == 2])
        for kind, (k, c) in ((WORD, _count(words, *marks)), (PAIR, _count(t.pair, train, held))):
            self.keys[kind].append(k)
            self.counts[kind].append(c)
            self.size[kind] += len(k)
            if len(self.keys[kind]) > 8:
                k, c = _merge(self.keys[kind], self.counts[kind])
                self.keys[kind][:], self.counts[kind][:] = [k], [c]

    def result(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        return _merge(self.keys[kind], self.counts[kind])


def _small(c: np.ndarray) -> bytes:
    """Counts as bytes, one each where all fit."""
    width = np.uint8 if not len(c) or c.max() < 256 else np.uint32
    return bytes([np.dtype(width).itemsize]) + c.astype(width).tobytes()


def _large(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint8 if raw[0] == 1 else np.uint32, offset=1).astype(np.uint32)


def _ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of each hash range in sorted keys."""
    edges = np.array([(p << 64) // parts for p in range(1, parts)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


_TEXTS = "block long, text string, role int, doc_id long"


def _blocks(limit: int):
    """Numbers rows by block: the partition, and how often ``limit`` bytes of its text came before the row."""

    def run(batches):
        from pyspark import TaskContext

        first, before = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(size)
            yield pa.RecordBatch.from_arrays([pa.array(first + (ends - size) // limit, pa.int64()), *batch.columns], ["block", "text", "role", "doc_id"])
            before = int(ends[-1]) if len(ends) else before

    return run


_REQUEST = "part int, kind int, block long, keys binary, total binary, held binary"
_REQUEST_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("total", pa.binary()), ("held", pa.binary())])


def _requests(parts: int):
    def send(block: int, counter: Counter):
        for kind in (WORD, PAIR):
            keys, counts = counter.result(kind)
            at = _ranges(keys, parts)
            for p in range(parts):
                a, b = at[p], at[p + 1]
                if b > a:
                    yield p, kind, block, keys[a:b].tobytes(), _small(counts[a:b, 0]), _small(counts[a:b, 1])

    def bundled(rows):
        some, held = [], 0
        for row in rows:
            some.append(row)
            held += sum(map(len, row[3:]))
            if held >= SEND_BYTES:
                yield some
                some, held = [], 0
        if some:
            yield some

    def run(batches):
        for some in bundled(requests(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(zip(*some), _REQUEST_ARROW)], schema=_REQUEST_ARROW)

    def requests(batches):
        # rows of a block follow one another; one that comes again asks again
        block, counter = None, None
        for batch in batches:
            blocks = batch.column(0).to_numpy(zero_copy_only=False)
            role = batch.column(2).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in tk.slices(batch.column(1)):
                cuts = [0, *(np.flatnonzero(np.diff(blocks[lo:hi])) + 1).tolist(), hi - lo]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if counter is None or block != int(blocks[lo + a]):
                        if counter is not None:
                            yield from send(block, counter)
                        block, counter = int(blocks[lo + a]), Counter()
                    counter.add(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], role[lo + a : lo + b])
        if counter is not None:
            yield from send(block, counter)

    return run


_REPLY = "kind int, block long, part int, keys binary, total binary, core binary, n long, nc long, v long"


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one hash range: for each block the total of its keys in ascending order, and, of those its held-out
    part has, the keys with the counts of all training documents but the held-out ones. One row tells the range's sums.
    A block that was read in several parts asks in several rows, and is answered in one."""
    part, kind = table["part"][0].as_py(), table["kind"][0].as_py()
    keys = [np.frombuffer(x, dtype=np.uint64) for x in table["keys"].to_pylist()]
    asked = [np.stack((_large(a), _large(b)), axis=1) for a, b in zip(table["total"].to_pylist(), table["held"].to_pylist())]
    of_block: dict[int, list[int]] = defaultdict(list)
    for i, block in enumerate(table["block"].to_pylist()):
        of_block[block].append(i)
    every, counts = _merge(keys, asked)
    real = every != tk.U64(tk.START)
    out = {n: [] for n in ("block", "keys", "total", "core")}
    sums = (int(counts[real, 0].sum(dtype=np.int64)), int((counts[real, 0] - counts[real, 1]).sum(dtype=np.int64)), int((counts[real, 0] > 0).sum())) if kind == WORD else (0, 0, 0)
    for b, rows in of_block.items():
        k, own = (keys[rows[0]], asked[rows[0]]) if len(rows) == 1 else _merge([keys[i] for i in rows], [asked[i] for i in rows])
        at = np.searchsorted(every, k)
        mine = own[:, 1] > 0
        out["block"].append(b)
        out["keys"].append(k[mine].tobytes())
        out["total"].append(_small(counts[at, 0]))
        out["core"].append(_small(counts[at[mine], 0] - counts[at[mine], 1]))
    n = len(of_block)
    return pa.table({
        "kind": pa.array([kind] * n, pa.int32()), "block": pa.array(out["block"], pa.int64()), "part": pa.array([part] * n, pa.int32()),
        "keys": pa.array(out["keys"], pa.binary()), "total": pa.array(out["total"], pa.binary()), "core": pa.array(out["core"], pa.binary()),
        **{x: pa.array([s] + [0] * (n - 1), pa.int64()) for x, s in zip(("n", "nc", "v"), sums)},
    })


class Lookup:
    """Counts of a block by key."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts  # sorted

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0).astype(np.int64)


def bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(float))[1], BUCKETS - 1)


def estimates(t: Tokens, words: Lookup, pairs: Lookup, n: int) -> tuple[np.ndarray, ...]:
    """For each token: context bucket, its count, and the pair's and the word's estimate."""
    context, own, both = words.of(t.before), words.of(t.word), pairs.of(t.pair)
    return bucket(context), own, both / np.maximum(context, 1), own / max(n, 1)


def learn_weights(rows: list[tuple[int, int, int, int]], rounds: int = 60) -> np.ndarray:
    """EM on a table of (bucket, step of log2 p2/p0, step of log2 p1/p0, count); steps of -1 stand for zero. Returns
    (buckets, 3) weights of pair, word and no knowledge; buckets without evidence take those of the nearest below."""
    weights = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    weights[0] = [0.0, 0.7, 0.3]
    seen = np.zeros(BUCKETS)
    table = np.array(rows, dtype=float).reshape(-1, 4)
    for b in range(BUCKETS):
        t = table[table[:, 0] == b]
        seen[b] = t[:, 3].sum()
        if not len(t):
            continue
        ratio = np.where(t[:, 1:3] < 0, 0.0, np.exp2(t[:, 1:3] / STEP))
        ratio = np.column_stack([ratio, np.ones(len(t))])
        for _ in range(rounds):
            share = ratio * weights[b]
            share /= share.sum(axis=1, keepdims=True)
            # one token's worth of doubt keeps every estimate in play
            got = (share * t[:, 3:]).sum(axis=0) + np.array([0.1 if b else 0.0, 0.1, 0.1])
            weights[b] = got / got.sum()
    last = None
    for b in range(BUCKETS):
        if seen[b]:
            last = b
        elif last is not None and b:
            weights[b] = weights[last] if last else [0.3, 0.5, 0.2]
    return weights


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are the words (A-Z lower-cased) and one end. The model learns from rows whose crc32 of the id as text mod 7
    is not ``fold``; of those, remainder 6 is held out for the mixture weights. ``base_score`` is the add-one unigram
    log10 probability, ``score`` the model's. Null and empty texts have the end alone; rows with a null id are scored
    and learned from; repeated rows count as often as they come; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = ensure_importable(docs.sparkSession)
    r = remainder(F.col(id_col), 7)
    role = F.when(r == fold, 0).when(r == (6 if fold != 6 else 5), 2).otherwise(1).cast("int")
    text = F.col(text_col).cast("string").alias("text")
    numbered = docs.select(text, role.alias("role"), F.col(id_col).cast("long").alias("doc_id")).mapInArrow(_blocks(BLOCK_BYTES), _TEXTS)
    written = save(numbered, "texts")
    given = written
    size, blocks = given.agg(F.sum(F.octet_length("text")), F.count_distinct("block")).first()
    parts = max(shuffle_partitions(spark), -(-(size or 0) // RANGE_BYTES))
    meetings = max(shuffle_partitions(spark), 2 * blocks)  # of a block's texts with its totals: a block or a few each

    asked = given.select("block", "text", "role").mapInArrow(_requests(parts), _REQUEST)
    replies = save(asked.repartition(2 * parts, "part", "kind").groupBy("part", "kind").applyInArrow(_answer, _REPLY), "counts")
    n, n_core, v = (int(x or 0) for x in replies.agg(F.sum("n"), F.sum("nc"), F.sum("v")).first())
    unknown = 1 / (v + 1)

    def statistics(left: pa.Table, right: pa.Table) -> pa.Table:
        got: dict[tuple[int, int, int], int] = defaultdict(int)
        words, pairs = (_held(right, k) for k in (WORD, PAIR))
        for _, _, data, offsets in tk.slices(left["text"]):
            b, _, p2, p1 = estimates(Tokens(data, offsets), words, pairs, n_core)
            with np.errstate(divide="ignore"):
                steps = [np.where(p > 0, np.round(np.log2(np.maximum(p / unknown, 1)) * STEP), -1).astype(np.int64) for p in (p2, p1)]
            code, times = np.unique(b * 1_000_000 + (steps[0] + 1) * 1000 + steps[1] + 1, return_counts=True)
            for c, m in zip(code.tolist(), times.tolist()):
                got[c // 1_000_000, c // 1000 % 1000 - 1, c % 1000 - 1] += m
        columns = zip(*((*k, m) for k, m in got.items())) if got else [()] * 4
        return pa.table({x: pa.array(c, pa.int64()) for x, c in zip(("b", "s2", "s1", "m"), columns)})

    texts = given.where("role = 2").select("block", "text")
    answers = replies.where("length(keys) > 0").select("block", "kind", "keys", "core")
    texts, answers = (x.repartition(meetings, "block") for x in (texts, answers))
    rows = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(statistics, "b long, s2 long, s1 long, m long")
    table = rows.groupBy("b", "s2", "s1").agg(F.sum("m").alias("m")).collect()  # buckets x steps x steps at most
    weights = learn_weights([tuple(x) for x in table])

    def scores(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        block = Numbered(left["text"])
        totals = []
        for kind, keys in enumerate(block.keys):
            mine = right.filter(pc.equal(right["kind"], kind))
            order = np.argsort(mine["part"].to_numpy(), kind="stable")
            raw = mine["total"].to_pylist()
            totals.append(np.concatenate([_large(raw[i]) for i in order]) if len(raw) else np.zeros(0, np.uint32))
            if len(totals[-1]) != len(keys):
                raise RuntimeError("the written texts of a block do not match its counts")
        out = {x: [] for x in ("n_tokens", "n_known", "base_score", "score")}
        words, pairs = (x.astype(np.float64) for x in totals)
        openings = words[np.searchsorted(block.keys[WORD], tk.U64(tk.START))]
        log_base = np.log10((words + 1) / (n + (v + 1)))
        for counts, word, pair in block:
            own = words[word]
            first = np.cumsum(counts) - counts
            context = np.empty_like(own)
            context[1:] = own[:-1]
            context[first] = openings
            w = weights[bucket(context)]
            p = w[:, 0] * (pairs[pair] / np.maximum(context, 1)) + w[:, 1] * (own / max(n, 1)) + w[:, 2] * unknown
            out["n_tokens"].append(counts)
            out["n_known"].append(np.add.reduceat((own > 0).astype(np.int64), first))
            out["base_score"].append(np.add.reduceat(log_base[word], first))
            out["score"].append(np.add.reduceat(np.log10(p), first))
        return pa.table({"doc_id": left["doc_id"], "held_out": pc.equal(left["role"], 0), **{x: np.concatenate(c) for x, c in out.items()}})

    totals = replies.select("block", "kind", "part", "total").repartition(meetings, "block")
    out = given.repartition(meetings, "block").groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        scores, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    out = save(out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"), "scores")
    discard(written)
    discard(replies)
    return out


def _held(right: pa.Table, kind: int) -> Lookup:
    mine = right.filter(pc.equal(right["kind"], kind))
    keys = [np.frombuffer(x, dtype=np.uint64) for x in mine["keys"].to_pylist()]
    counts = [_large(x) for x in mine["core"].to_pylist()]
    if not keys:
        return Lookup(np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    return Lookup(k[order], c[order])
