"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are compared as words in lower case with single spaces between. An item of m characters
within k edits of a region shares at least m + 1 - (k + 1) q of its q-grams with it, all on diagonals that differ by at
most k. So for every document the places of q-grams that some item has are found, counted by item in overlapping
diagonal bands of width 2(k + 1), and only bands that reach the bound are verified by banded alignment. Of an item's
q-grams those that most other items share are left out of the index, up to two thirds of the bound, and the bound is
lowered by as many: no match is lost, and common words make no hits. Hits meet index entries in bounded parts, so that
neither a text of one letter nor a phrase of many items takes memory that grows with their product.

Items are few and short and documents are many and long, so the index of item q-grams is sent to every task as long as
it is under ``INDEX_BYTES``; a larger benchmark is gone through in chunks under that size, with one pass each.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import textkernel as tk
from freshet.session import ensure_importable

Q = 8
#: Edits allowed, as a share of an item's characters; (k + 1) q stays under m with these.
ERROR = 0.06
#: Items of fewer characters are matched without edits, where no letter or digit stands beside them.
LEAST = 40
INDEX_BYTES = 64 << 20
#: Pairs of a hit and an index entry that are held at once.
PAIRS = 500_000
SCHEMA = "doc_id long, item_id long, start long, end long, edits long"
_HALVES = [(1 << j, pow(0xD1342543DE82EF95, j + 1, 1 << 64)) for j in range(Q.bit_length() - 1)]
#: Code points from here on have no lower case of one character.
_CASED = 0x1F000


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case (where that is one character) and whether it is white space, by code point."""
    lower = np.arange(_CASED, dtype=np.uint32)
    space = np.zeros(_CASED, dtype=bool)
    for c in range(_CASED):
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
        space[c] = chr(c).isspace() and c not in range(0x1C, 0x20)
    return lower, space


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of rows given as UTF-8, and row offsets in them; what is not UTF-8 becomes U+FFFD."""
    raw = data.tobytes()
    try:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32)
        return points, np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    except UnicodeDecodeError:
        rows = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        return np.frombuffer("".join(rows).encode("utf-32-le"), dtype=np.uint32), np.concatenate(([0], np.cumsum([len(r) for r in rows])))


def normalise(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points with each run of white space as one space and none at either end of a row; offsets; and
    the source position of every one kept."""
    table, blank = _tables()
    low = np.minimum(points, _CASED - 1)
    lower = np.where(points < _CASED, table[low], points)
    space = blank[low]
    lower[space] = 32
    follows = np.zeros(len(points), dtype=bool)
    follows[1:] = space[:-1]
    first = np.zeros(len(points) + 1, dtype=bool)
    first[offsets[:-1]] = True
    keep = ~(space & (follows | first[:-1]))
    # a space at a row's end
    last = offsets[1:][np.diff(offsets) > 0] - 1
    run = last[space[last]]
    if len(run):
        word = np.where(space, -1, np.arange(len(points)))
        start = np.maximum.accumulate(word)[run] + 1
        row = np.searchsorted(offsets, run, "right") - 1
        keep[np.maximum(start, offsets[row])] = False
    total = np.concatenate(([0], np.cumsum(keep)))
    return lower[keep], total[offsets], np.flatnonzero(keep)


def grams(points: np.ndarray) -> np.ndarray:
    """Hash of the q code points from each place on, put together from those of their halves; the last q - 1 places have
    none."""
    if len(points) < Q:
        return np.zeros(0, dtype=np.uint64)
    acc = points.astype(np.uint64) * tk.U64(0x9E3779B97F4A7C15)
    acc ^= acc >> tk.U64(32)
    for half, factor in _HALVES:
        acc = acc[:-half] * tk.U64(factor) + acc[half:]
    return acc ^ (acc >> tk.U64(29))


def budget(m: int) -> int:
    return int(m * ERROR) if m >= LEAST else 0


@dataclass
class Index:
    """Distinct item texts with the ids that have them; their q-grams sorted, then by text, with position; a bit filter
    over gram hashes; and for each text its length, edit budget and least number of grams."""

    ids: list[list[int]]
    texts: list[np.ndarray]
    keys: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bits: np.ndarray
    need: np.ndarray
    lengths: np.ndarray
    budgets: np.ndarray


def build(items: list[tuple[int, str]]) -> Index:
    """Empty items are left out."""
    known: dict[bytes, int] = {}
    ids, texts, keys, item, place = [], [], [], [], []
    for i, text in items:
        norm, _, _ = normalise(*letters(*tk.text_bytes(pa.array([text], pa.string()))))
        if not len(norm):
            continue
        at = known.setdefault(norm.tobytes(), len(texts))
        if at < len(texts):
            ids[at].append(i)
            continue
        ids.append([i])
        texts.append(norm)
        g = grams(norm) if len(norm) >= LEAST else np.zeros(0, np.uint64)
        keys.append(g)
        item.append(np.full(len(g), at))
        place.append(np.arange(len(g)))
    none = np.zeros(0, dtype=np.int64)
    keys, item, place = np.concatenate([none.astype(np.uint64), *keys]), np.concatenate([none, *item]), np.concatenate([none, *place])
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    budgets = np.array([budget(m) for m in lengths.tolist()], dtype=np.int64)
    need = np.maximum(1, lengths + 1 - (budgets + 1) * Q)
    spare = need - np.maximum(1, need // 3)
    _, inverse, often = np.unique(keys, return_inverse=True, return_counts=True)
    order = np.lexsort((-often[inverse], item))
    nth = np.arange(len(order)) - np.searchsorted(item, item[order], "left")
    leave = (nth < spare[item[order]]) & (often[inverse][order] > 1)
    need = need - np.bincount(item[order][leave], minlength=len(ids))
    kept = order[~leave]
    keys, item, place = keys[kept], item[kept], place[kept]
    order = np.argsort(keys, kind="stable")
    bits = np.zeros(1 << 22, dtype=bool)
    bits[(keys >> tk.U64(42)).astype(np.int64)] = True
    return Index(ids, texts, keys[order], item[order], place[order], bits, need, lengths, budgets)


def _distances(pattern: list[int], text: list[int], anywhere: bool) -> list[int]:
    """Edits between the whole pattern and the text up to each place, from its start or (``anywhere``) from the best
    place before: columns of the alignment as bits of two integers."""
    m = len(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    same: dict[int, int] = {}
    for i, c in enumerate(pattern):
        same[c] = same.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    out = [m]
    top = 0 if anywhere else 1
    for c in text:
        eq = same.get(c, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        rise, fall = down | (full & ~(h | up)), up & h
        score += bool(rise & high) - bool(fall & high)
        rise = rise << 1 | top
        up, down = full & (fall << 1 | ~(x | rise)), rise & x & full
        out.append(score)
    return out


def align(p: np.ndarray, t: np.ndarray, k: int) -> tuple[int, int, int] | None:
    """Start, end and edits of the best match of the whole pattern ``p`` anywhere in the region ``t``, if within k edits:
    ties go to the earliest end, then to the latest start."""
    pattern, text = p.tolist(), t.tolist()
    found = _distances(pattern, text, True)
    edits = min(found)
    if edits > k:
        return None
    end = found.index(edits)
    back = _distances(pattern[::-1], text[max(0, end - len(pattern) - k) : end][::-1], False)
    return end - back.index(edits), end, edits


def _apart(beside: str) -> bool:
    """Whether a short item may stand beside this character, or none: no letter, digit or combining mark."""
    return not beside or not (beside.isalnum() or unicodedata.category(beside)[0] == "M")


class Search:
    """The items found in a slice of rows: by row and item text, edits, start and end in its code points."""

    def __init__(self, index: Index, norm: np.ndarray, at: np.ndarray):
        self.index, self.norm, self.at = index, norm, at
        self.found: dict[tuple[int, int], tuple[int, int, int]] = {}
        self.exact: set[int] = set()  # row * items + item of those found without an edit

    def short(self) -> None:
        which = [k for k, t in enumerate(self.index.texts) if len(t) < LEAST]
        if not which:
            return
        text = self.norm.tobytes().decode("utf-32-le", "replace")
        for k in which:
            pattern = self.index.texts[k].tobytes().decode("utf-32-le", "replace")
            place = text.find(pattern)
            while place >= 0:
                row, end = int(np.searchsorted(self.at, place, "right")) - 1, place + len(pattern)
                lo, hi = int(self.at[row]), int(self.at[row + 1])
                if end <= hi and (row, k) not in self.found and _apart(text[max(lo, place - 1) : place]) and _apart(text[end : min(hi, end + 1)]):
                    self.found[row, k] = (0, place, end)
                place = text.find(pattern, place + 1)

    def near(self) -> None:
        index = self.index
        g = grams(self.norm)
        if not len(g) or not len(index.keys):
            return
        hit = np.flatnonzero(index.bits[(g >> tk.U64(42)).astype(np.int64)])
        row = np.searchsorted(self.at, hit, "right") - 1
        inside = hit + Q <= self.at[row + 1]
        hit, row = hit[inside], row[inside]
        lo, hi = np.searchsorted(index.keys, g[hit], "left"), np.searchsorted(index.keys, g[hit], "right")
        some = hi > lo
        self.reach = int(2 * index.lengths.max())  # of a region within the budget, and more
        self._count(hit[some], row[some], lo[some], hi[some], 0, len(index.texts))

    def _count(self, hit: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: int, last: int) -> None:
        """Counts hits in parts of at most ``PAIRS`` hit-entry pairs: by row, then by stretches of a row that overlap by
        more than any match spans, then by item. A stretch of that size and one item are as small as parts get."""
        pairs = int((hi - lo).sum())
        if not pairs:
            return
        if pairs > PAIRS and row[0] != row[-1]:
            middle = row[int(np.searchsorted(np.cumsum(hi - lo), pairs / 2))]
            cut = int(np.searchsorted(row, middle, "left")) or int(np.searchsorted(row, middle, "right"))
            for part in (slice(cut), slice(cut, None)):
                self._count(hit[part], row[part], lo[part], hi[part], first, last)
        elif pairs > PAIRS and hit[-1] - hit[0] > 4 * self.reach:
            middle = (int(hit[0]) + int(hit[-1])) // 2
            for part in (hit <= middle + self.reach, hit >= middle):
                self._count(hit[part], row[part], lo[part], hi[part], first, last)
        elif pairs > PAIRS and last - first > 1:
            middle = (first + last) // 2
            rank = np.concatenate(([0], np.cumsum(self.index.keys[1:] != self.index.keys[:-1])))
            split = np.searchsorted(rank * len(self.index.texts) + self.index.item, rank[lo] * len(self.index.texts) + middle)
            split = np.clip(split, lo, hi)
            self._count(hit, row, lo, split, first, middle)
            self._count(hit, row, split, hi, middle, last)
        else:
            self._verify(hit, row, hi - lo, lo)

    def _verify(self, hit: np.ndarray, row: np.ndarray, reps: np.ndarray, lo: np.ndarray) -> None:
        index = self.index
        entry = np.repeat(lo - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
        row, place, item = np.repeat(row, reps), np.repeat(hit, reps), index.item[entry]
        if self.exact:
            open_ = ~np.isin(row * len(index.texts) + item, list(self.exact))
            entry, row, place, item = entry[open_], row[open_], place[open_], item[open_]
            if not len(entry):
                return
        own = index.place[entry]
        diagonal = place - own
        width = index.budgets[item] + 1
        regions: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for shift in (0, 1):  # bands of 2(k + 1) diagonals that overlap by half
            band = (diagonal - self.at[row] + index.lengths[item] + shift * width) // (2 * width)
            order = np.lexsort((place, band, item, row))
            r, i, b, d, e = row[order], item[order], band[order], diagonal[order], own[order]
            new = np.concatenate(([True], (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1])))
            start = np.flatnonzero(new)
            stop = np.append(start[1:], len(r))
            enough = np.flatnonzero(stop - start >= index.need[i[start]])
            for f, s in zip(start[enough].tolist(), stop[enough].tolist()):
                who, where = int(i[f]), int(r[f])
                if len(np.unique(e[f:s])) >= index.need[who]:
                    k = int(index.budgets[who])
                    begin = max(int(self.at[where]), int(d[f:s].min()) - k)
                    regions[where, who].append((begin, min(int(self.at[where + 1]), int(d[f:s].max()) + int(index.lengths[who]) + k)))
        for (where, who), spans in regions.items():
            merged: list[list[int]] = []
            for begin, end in sorted(spans):  # regions that overlap are aligned as one
                if merged and begin <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([begin, end])
            for begin, end in merged:
                got = align(index.texts[who], self.norm[begin:end], int(index.budgets[who]))
                if got:
                    now = (got[2], begin + got[0], begin + got[1])
                    self.found[where, who] = min(now, self.found.get((where, who), now))
                    if not got[2]:
                        self.exact.add(where * len(index.texts) + who)


def matches(index: Index, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item text, start, end, edits) of items found, positions in code points of the row; of an item's matches in
    a row, the best, then the earliest."""
    if not len(index.texts) or not len(data):
        return
    points, rows = letters(data, offsets)
    norm, at, source = normalise(points, rows)
    search = Search(index, norm, at)
    search.short()
    search.near()
    for (where, who), (edits, a, b) in sorted(search.found.items()):
        yield where, who, int(source[a] - rows[where]), int(source[b - 1] + 1 - rows[where]), edits


def _chunks(benchmark: DataFrame, item_col: str, text_col: str):
    """Indexes of the benchmark's items, each under ``INDEX_BYTES``; rows come one by one from an iterator, so the
    driver never holds more than one chunk."""
    rows = benchmark.select(F.col(item_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))).where(F.col(item_col).isNotNull()).distinct()
    chunk, size = [], 0
    for i, text in rows.toLocalIterator():
        chunk.append((i, text))
        size += 40 * len(text)
        if size > INDEX_BYTES:
            yield build(chunk)
            chunk, size = [], 0
    if chunk:
        yield build(chunk)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``doc_id, item_id, start, end, edits`` for every document that holds a benchmark item within its edit budget.

    Positions are code points of the document's own text; of several regions the one with fewest edits, then the
    first. Budget: 6 % of an item's characters, none under 40; such short items match where no letter or digit stands
    beside them. Upper and lower case are the same in every script. Null and empty texts and items match nothing;
    repeated rows give repeated results; null ids are kept; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = ensure_importable(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = spark.createDataFrame([], SCHEMA)
    for index in _chunks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            own = sent.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = []
                for lo, _, data, offsets in tk.slices(batch.column(1)):
                    for where, who, a, b, edits in matches(own, data, offsets):
                        rows += [(ids[lo + where], item, a, b, edits) for item in own.ids[who]]
                columns = zip(*rows) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "start", "end", "edits"])

        found = given.mapInArrow(run, SCHEMA)
        out = found if out is None else out.union(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item within its edit budget, with all their columns, whatever
    these are called. Null and empty texts hold nothing and stay, as do repeated rows; an empty table stays empty, and
    without items all rows stay."""
    spark = ensure_importable(docs.sparkSession)
    at = docs.schema.fieldNames().index(text_col)
    for index in _chunks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for lo, _, data, offsets in tk.slices(batch.column(at)):
                    clean[[lo + where for where, *_ in matches(sent.value, data, offsets)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
