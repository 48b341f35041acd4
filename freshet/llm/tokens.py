"""Token ids of whole texts by a byte-level BPE file, with a memo of word pieces.

A byte-level BPE splits a text before every space that follows a non-space, whatever stands around it. So the ids of a
text are the ids of its space-led pieces one after another, and each distinct piece needs encoding only once. Pieces
are found, hashed and looked up by array operations over the bytes of many texts at once, in a hash table of bounded
size that a worker keeps; only pieces it has not met are encoded. Of those, a piece of runs of letters, digits, ASCII
marks and single line ends goes run by run straight to the BPE model, any other through the whole tokenizer.
"""

from __future__ import annotations

import array
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from freshet.llm import textkernel as tk

#: Pieces a worker remembers before it starts anew: about 50 MB.
MEMO_PIECES = 600_000
SLOTS = 1 << 21
END_ID = 0

_RUNS = re.compile(r"[^\W\d_]+|[0-9]+|[!-&(-/:-@\[-`{-~]+|\n")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_WIDE_SPACES = tuple(chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_WIDE_LAST = np.zeros(256, dtype=bool)
_WIDE_LAST[[c[-1] for c in _WIDE_SPACES]] = True
_loaded: dict[str, Encoder] = {}


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level BPE writes each byte: itself if it prints, else one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


def packed(ids: list[int]) -> bytes:
    return array.array("I", ids).tobytes()


def tokenizer_path() -> str:
    """Default vocabulary file; every operator takes another as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every piece."""
    filled = np.flatnonzero(np.diff(offsets) > 0)
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    at = at[~_SPACE[data[at - 1]]]
    odd = np.flatnonzero(_WIDE_LAST[data[at - 1]])
    if len(odd):  # the last byte of a wide space may be that of a letter too
        keep = np.ones(len(at), dtype=bool)
        for k in odd.tolist():
            before = data[max(0, at[k] - 3) : at[k]].tobytes()
            keep[k] = not before.endswith(_WIDE_SPACES)
        at = at[keep]
    begins = np.zeros(len(data), dtype=bool)
    begins[at] = True
    begins[offsets[:-1][filled]] = True
    starts = np.flatnonzero(begins)
    row = tk.rows_of(starts, offsets)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return starts, ends, row


class Encoder:
    """Encodes texts to 32-bit ids; one for each worker and file."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        before = self.tokenizer.pre_tokenizer
        self.plain = type(before).__name__ == "ByteLevel" and not before.add_prefix_space and self.tokenizer.normalizer is None
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(SLOTS, dtype=np.uint64)
        self.entry = np.zeros(SLOTS, dtype=np.int32)
        self.n = 1
        self.start = np.zeros(MEMO_PIECES, dtype=np.int64)
        self.length = np.zeros(MEMO_PIECES, dtype=np.int32)
        self.length[0] = 1
        self.ids = np.zeros(1 << 20, dtype=np.int32)  # entry 0 is the end id
        self.ids[0] = END_ID
        self.used = 1
        self.runs: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            letters = run.encode().decode("latin-1").translate(_LETTERS)
            ids = packed([t.id for t in self.model.tokenize(letters)])
            if len(run) < 9:
                if len(self.runs) > 100_000:
                    self.runs.clear()
                self.runs[run] = ids
        return ids

    def _learn(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        for p in texts:
            word = p[1:] if p[:1] == " " else p
            if word.isalpha():
                out.append(self._run(p))
                continue
            runs = _RUNS.findall(word)
            if runs and word[0] != "\n" and len("".join(runs)) == len(word) and "\n\n" not in word and (word.isascii() or all(r.isalpha() or r.isascii() for r in runs)):
                runs[0] = p[: len(p) - len(word)] + runs[0]
                out.append(b"".join(map(self._run, runs)))
            else:
                out.append(None)
        left = [i for i, x in enumerate(out) if x is None]
        for at in range(0, len(left), 20_000):
            part = left[at : at + 20_000]
            for i, ids in zip(part, self.whole([texts[i] for i in part])):
                out[i] = ids
        return out

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where it is not known."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        left, slot = np.arange(len(hashes)), (hashes & tk.U64(SLOTS - 1)).astype(np.int64)
        while len(left):
            key = self.keys[slot]
            hit = key == hashes[left]
            out[left[hit]] = self.entry[slot[hit]]
            go = ~hit & (key != 0)
            left, slot = left[go], (slot[go] + 1) & (SLOTS - 1)
        return out

    def _insert(self, hashes: np.ndarray, encoded: list[bytes]) -> None:
        lengths = np.array([len(x) // 4 for x in encoded], dtype=np.int32)
        flat = np.frombuffer(b"".join(encoded), dtype="<i4")
        if self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(flat)), dtype=np.int32)])
        self.ids[self.used : self.used + len(flat)] = flat
        entries = np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        self.start[entries] = self.used + np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)[:-1]))
        self.length[entries] = lengths
        self.used += len(flat)
        self.n += len(hashes)
        left, slot = np.arange(len(hashes)), (hashes & tk.U64(SLOTS - 1)).astype(np.int64)
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[left[free]]
            mine = self.keys[slot] == hashes[left]
            self.entry[slot[mine]] = entries[left[mine]]
            left, slot = left[~mine], (slot[~mine] + 1) & (SLOTS - 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, each row's with the end id, and how many each has."""
        n = len(offsets) - 1
        if not self.plain:
            raw = data.tobytes()
            at = offsets.tolist()
            each = self.whole([raw[a:b].decode() for a, b in zip(at[:-1], at[1:])])
            end = packed([END_ID])
            flat = np.frombuffer(b"".join(x + end for x in each), dtype="<i4")
            return flat, np.array([len(x) // 4 + 1 for x in each], dtype=np.int64)
        starts, ends, row = pieces(data, offsets)
        hashes = tk.span_hashes(data, starts, ends)
        hashes[hashes == 0] = tk.U64(1)
        entry = self._find(hashes)
        miss = np.flatnonzero(entry < 0)
        if len(miss):
            fresh, first = np.unique(hashes[miss], return_index=True)
            if self.n + len(fresh) > MEMO_PIECES:
                self._forget()
                entry[:] = -1
                miss = np.arange(len(hashes))
                fresh, first = np.unique(hashes, return_index=True)
            at = miss[first]
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            self._insert(fresh, self._learn(texts))
            entry[miss] = self._find(hashes[miss])
        every = np.zeros(len(entry) + n, dtype=np.int32)
        every[np.arange(len(entry)) + row] = entry
        length = self.length[every].astype(np.int64)
        done = np.cumsum(length)
        total = int(done[-1]) if len(done) else 0
        where = np.repeat(self.start[every] - (done - length), length)
        where += np.arange(total)
        counts = np.bincount(row, weights=self.length[entry], minlength=n).astype(np.int64) + 1
        return self.ids[where], counts


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = Encoder(path)
    return _loaded[path]


def encoded(column: pa.Array, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges with their ids, end ids included, and the count of each row's (null: empty)."""
    enc = encoder(path)
    for lo, hi, data, offsets in tk.slices(column):
        yield lo, hi, *enc.encode(data, offsets)
