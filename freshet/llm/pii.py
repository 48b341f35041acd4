"""Personal data in texts: identifiers as written, and disguised ones found by offset-preserving normalisation.

The base pass matches e-mail addresses, IPv4 addresses, payment cards and phone numbers on the text itself. The second
pass runs a chain of transducers that rewrite homoglyphs, spelled digits and at/dot disguises; each keeps, for every
character it writes, the source span it came from. Identifiers found in the rewritten text are mapped back, and those
that no base span of their kind contains are added. Texts without a sign that either pass needs are left after a scan.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import textkernel as tk
from freshet.session import ensure_importable

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# A run that fails from its first character fails from every later one, so a lookbehind spares texts of long runs.
_LOCAL = "A-Za-z0-9._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(rf"[{_LOCAL}]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def find_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, from each ``@``
    outwards: linear in the text."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", at + 1)
    return out


def find_all(text: str, kinds=KINDS) -> list[Span]:
    out: list[Span] = []
    if "email" in kinds and "@" in text:
        out += [("email", a, b) for a, b in find_emails(text)]
    if "ip" in kinds:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
    if "card" in kinds:
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "phone" in kinds and "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


# --- transducers -----------------------------------------------------------------------------------------------------

# Letters of other scripts that are drawn like Latin ones.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "Х": "X", "ο": "o", "α": "a", "ν": "v",
    "ρ": "p", "ι": "i", "Α": "A", "Β": "B", "Ε": "E", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "ı": "i",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
    " ": " ", " ": " ", " ": " ",
}
#: Characters that a disguise slips between others and that show nothing.
INVISIBLE = frozenset("​‌‍⁠﻿­")
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
#: Last labels that make a host of any words joined by a plain "at" and "dot". Other labels do, too, if no label of the
#: host is one of ``FUNCTION_WORDS``, which stand beside an ordinary "at" and "dot".
ENDINGS = frozenset("com org net edu gov mil int info biz io ai app dev co me tv us uk eu de fr es it nl be ch at pl pt se no fi dk ie ru ua cz gr tr in cn jp kr au nz ca mx br ar".split())
FUNCTION_WORDS = frozenset(
    "a an the this that these those my your his her its our their and or but if of on in at to for from by with as is are was were be been it he she we you they i not no so then than there here "
    "der die das den dem des ein eine einen einem und oder aber von vom zu zum zur im am auf mit für ist sind war nicht le la les un une des du de et ou mais en dans sur avec pour par est sont "
    "el los las una uno y o pero con por para que es son del al se".split()
)
_DIGIT_WORD = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
_DIGIT_ITEM = rf"(?:{_DIGIT_WORD}|[0-9])"
_SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:plus[ -])?{_DIGIT_ITEM}(?:[ -]{_DIGIT_ITEM}){{6,}}(?![A-Za-z0-9])", re.I)
_SPELLED_IP = re.compile(
    rf"(?<![A-Za-z0-9])(?:{_DIGIT_ITEM}(?: {_DIGIT_ITEM}){{0,2}}|[0-9]{{1,3}})(?: (?:dot|point) (?:{_DIGIT_ITEM}(?: {_DIGIT_ITEM}){{0,2}}|[0-9]{{1,3}})){{3}}(?![A-Za-z0-9])", re.I
)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = rf"(?:\s*{_OPEN}\s*(?:at|@)\s*{_CLOSE}\s*|\s+at\s+|\s*@\s*)"
_DOT = rf"(?:\s*{_OPEN}\s*(?:dot|punkt|punto|point|\.)\s*{_CLOSE}\s*|\s+dot\s+|\s+\.\s+|\.)"
_LABEL = r"[A-Za-z0-9-]+"
_HOST = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})+", re.I)
#: Joints without the blanks around them; a match never begins in a run of blanks.
_ATS = re.compile(rf"{_OPEN}\s*(?:at|@)\s*{_CLOSE}|(?<=\s)at(?=\s)|@", re.I)
_DOTS = re.compile(rf"{_OPEN}\s*(?:dot|punkt|punto|point|\.)\s*{_CLOSE}|(?<=\s)(?:dot|\.)(?=\s)|\.", re.I)
_PART = _LOCAL_SET - {"."}
_WORDED = re.compile(rf"{_OPEN}\s*(?:at|dot|punkt|punto|point|@|\.)\s*{_CLOSE}|\s(?:at|dot)\s", re.I)
_JOINT = re.compile(rf"(?P<a>\s*{_OPEN}\s*(?:at|@)\s*{_CLOSE}\s*|\s+at\s+|\s*@\s*)|(?P<d>\s*{_OPEN}\s*(?:dot|punkt|punto|point|\.)\s*{_CLOSE}\s*|\s+dot\s+|\s+\.\s+)", re.I)


class Mapped:
    """A text under rewriting with the source span of each of its characters."""

    __slots__ = ("text", "start", "end")

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        self.start = np.arange(len(text)) if start is None else start
        self.end = self.start + 1 if end is None else end

    def replace(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Applies (from, to, new) edits, in order and apart; every new character comes from the whole replaced span."""
        if not edits:
            return self
        out, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            out += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a] if a < len(self.start) else 0)]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        out.append(self.text[at:])
        starts.append(self.start[at:])
        ends.append(self.end[at:])
        return Mapped("".join(out), np.concatenate(starts), np.concatenate(ends))

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


_NOT_ASCII = re.compile(r"[^\x00-\x7f]")


def fold_homoglyphs(m: Mapped) -> Mapped:
    edits = []
    for found in _NOT_ASCII.finditer(m.text):
        i, c = found.start(), found[0]
        if c in INVISIBLE:
            edits.append((i, i + 1, ""))
        elif c in HOMOGLYPHS:
            edits.append((i, i + 1, HOMOGLYPHS[c]))
        else:
            value = unicodedata.digit(c, None)
            if value is not None:
                edits.append((i, i + 1, str(value)))
            elif "！" <= c <= "～" or "\U0001d400" <= c <= "\U0001d7ff":
                plain = unicodedata.normalize("NFKC", c)
                if len(plain) == 1 and plain < "\x80":
                    edits.append((i, i + 1, plain))
    return m.replace(edits)


def join_digits(m: Mapped) -> Mapped:
    edits = []
    for found in _SPELLED_IP.finditer(m.text):
        parts = re.split(r" (?:dot|point) ", found[0], flags=re.I)
        edits.append((*found.span(), ".".join("".join(DIGIT_WORDS.get(w.lower(), w) for w in p.split(" ")) for p in parts)))
    taken, at = [(a, b) for a, b, _ in edits], 0  # both lists are in order and apart, so one sweep meets all overlaps
    for found in _SPELLED.finditer(m.text):
        a, b = found.span()
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if at < len(taken) and taken[at][0] < b or not re.search("[A-Za-z]", found[0]):
            continue
        items = re.split("[ -]", found[0])
        sign = "+" if items[0].lower() == "plus" else ""
        edits.append((a, b, sign + "".join(DIGIT_WORDS.get(w.lower(), w) for w in items[len(sign):])))
    return m.replace(sorted(edits))


def _with_blanks(text: str, a: int, b: int) -> tuple[int, int]:
    while a and text[a - 1].isspace():
        a -= 1
    while b < len(text) and text[b].isspace():
        b += 1
    return a, b


def _is_host(at: str, tail: str) -> bool:
    """Whether labels joined by written-out dots are a host's after an ordinary "at" or "@". A full stop between blanks
    may end a sentence, so it needs one of ``ENDINGS``, in small letters and no function word after "at"."""
    if not re.search(rf"\s+dot\s+|\s+\.\s+|{_OPEN}", tail, re.I):
        return False
    cased = _JOINT.sub(".", tail).split(".")
    joined = [x.lower() for x in cased]
    last, plain = joined[-1], FUNCTION_WORDS.isdisjoint(joined)
    if re.search(r"\s\.\s", tail):
        return last in ENDINGS and ("@" in at or plain and cased[-1] == last)
    return last in ENDINGS or len(last) > 1 and (last.isalpha() or last.startswith("xn--")) and plain


def join_addresses(m: Mapped) -> Mapped:
    """Addresses with at least one of their joints written out, from each "at" outwards: linear in the text."""
    text, edits, done = m.text, [], 0
    dots: dict[int, int] | None = None
    for found in _ATS.finditer(text):
        if found.start() < done:
            continue
        a, b = _with_blanks(text, *found.span())
        host = _HOST.match(text, b)
        if not host:
            continue
        if dots is None:
            dots = {}
            for dot in _DOTS.finditer(text):
                x, y = dot.span() if dot[0] == "." and not (text[dot.start() - 1 : dot.start()].isspace() and text[dot.end() : dot.end() + 1].isspace()) else _with_blanks(text, *dot.span())
                dots[y] = x
        start, end = a, a
        while end > done:
            part = end
            while part > done and text[part - 1] in _PART:
                part -= 1
            if part == end:
                break
            start, end = part, dots.get(part, 0)
        if start == a:
            continue
        whole, at = text[start : host.end()], text[a:b]
        if at == "@" and not _WORDED.search(whole):
            continue
        if not re.search(_OPEN, at) and not _is_host(at, host[0]):
            continue
        for joint in _JOINT.finditer(whole):
            edits.append((start + joint.start(), start + joint.end(), "@" if joint["a"] else "."))
        done = host.end()
    return m.replace(edits)


#: What a text needs for the second pass to change anything: a character that is rewritten (any above U+02FF but
#: quotes and the ellipsis, and those below it that folding changes), a bracketed joint, digits spelled, or both of
#: an "at" and a written-out dot, however far apart.
_LOW = "".join(c for c in map(chr, range(0x80, 0x300)) if fold_homoglyphs(Mapped(c)).text != c)
_REWRITTEN = re.compile(rf"[^\x00-\u02ff‘-‟…]|[{re.escape(_LOW)}]")
_SECOND_SIGN = re.compile(rf"{_OPEN}\s*(?:at|@)\s*{_CLOSE}|(?<![A-Za-z0-9])(?:(?:{_DIGIT_WORD}|plus)[ -]{_DIGIT_ITEM}|[0-9][ -]{_DIGIT_WORD})|(?:dot|point) {_DIGIT_ITEM}", re.I)
_AT_SIGN = re.compile(r"@|\sat\s", re.I)
_DOT_SIGN = re.compile(rf"\s(?:dot|\.)\s|{_OPEN}\s*(?:dot|\.|punkt|punto|point)\s*{_CLOSE}", re.I)


def signed(text: str) -> bool:
    return bool(not text.isascii() and _REWRITTEN.search(text) or _SECOND_SIGN.search(text) or _AT_SIGN.search(text) and _DOT_SIGN.search(text))


def find_disguised(text: str) -> list[Span]:
    """Spans, in the source, of identifiers that only the rewritten text shows."""
    if not signed(text):
        return []
    m = join_addresses(join_digits(fold_homoglyphs(Mapped(text))))
    if m.text == text:
        return []
    return sorted({(k, *m.source(a, b)) for k, a, b in find_all(m.text)}, key=lambda s: (s[1], s[2]))


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans added: those that no base span and no other added one of their kind contains. An added
    span may overlap base spans, as when a disguise leaves a part of an address that matches by itself."""
    base = find_all(text)
    disguised = find_disguised(text)
    if not disguised:
        return base, []
    added: list[Span] = []
    for kind in KINDS:
        own = [(a, b) for k, a, b in base if k == kind]  # in order and apart, as find_all gives them
        starts = [a for a, _ in own]
        done = -1
        for _, a, b in sorted((s for s in disguised if s[0] == kind), key=lambda s: (s[1], -s[2])):
            before = bisect_right(starts, a) - 1
            if b > done and (before < 0 or own[before][1] < b):
                added.append((kind, a, b))
                done = b
    return base, sorted(added, key=lambda s: (s[1], s[2]))


def listed(found: list[Span]) -> str:
    rank = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(found, key=lambda s: (rank[s[0]], s[1], s[2])))


_MAYBE = np.zeros(256, dtype=np.int8)
_MAYBE[[*b"@+0123456789[({<"]] = 1
_MAYBE[0xC2] = 1
_MAYBE[0xCC:0xF5] = 1


def suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that hold a byte some identifier, plain or disguised in other than letters, needs."""
    total = np.concatenate(([0], np.cumsum(_MAYBE[data], dtype=np.int64)))
    return total[offsets[1:]] > total[offsets[:-1]]


def analyse(texts: pa.Array):
    """For each text (null: empty) its base and added spans; texts without any sign give two empty lists."""
    for lo, hi, data, offsets in tk.slices(texts):
        maybe = suspects(data, offsets)
        for i, text in enumerate(texts.slice(lo, hi - lo).to_pylist()):
            if text and (maybe[i] or signed(text)):
                yield spans(text)
            else:
                yield [], []


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, base, added`` of every row: lists of ``kind, start, end`` in code points of the source, end exclusive.

    Base spans are leftmost and non-overlapping for each kind. Null and empty texts have none; repeated rows are alike;
    an empty table gives an empty result; other columns are ignored.
    """
    ensure_importable(docs.sparkSession)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(found):
        return [{"kind": k, "start": a, "end": b} for k, a, b in found]

    def run(batches):
        for batch in batches:
            base, added = [], []
            for b, a in analyse(batch.column(1)):
                base.append(rows(b))
                added.append(rows(a))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(added, span)], [id_col, "base", "added"])

    given = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    kind = "array<struct<kind: string, start: long, end: long>>"
    return given.mapInArrow(run, f"`{id_col}` long, base {kind}, added {kind}")


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>``, overlapping spans as one of the first's kind. All columns stay,
    whatever they are called, as do null and empty texts and repeated rows; ``length_col``, if given, becomes the new
    length in code points, null for a null text; an empty table stays empty."""
    ensure_importable(docs.sparkSession)
    schema = docs.schema
    at = schema.fieldNames().index(text_col)

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            texts = column.to_pylist()
            for i, (base, added) in enumerate(analyse(column)):
                if base or added:
                    out, done = [], 0
                    for kind, a, b in sorted(base + added, key=lambda s: (s[1], -s[2])):
                        if a >= done:
                            out += [texts[i][done:a], f"<{kind.upper()}>"]
                        done = max(done, b)
                    out.append(texts[i][done:])
                    texts[i] = "".join(out)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type))

    out = docs.mapInArrow(run, schema)
    return out.withColumn(length_col, F.length(text_col).cast(schema[length_col].dataType)) if length_col else out


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, counts of base spans by kind, the digest of the listed base spans, and all spans listed. Edge cases as
    in :func:`find_pii`: a text without spans has zeros, the digest of nothing and an empty list."""
    ensure_importable(docs.sparkSession)
    names = [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    types = [pa.int64()] * (1 + len(KINDS)) + [pa.string()] * 2

    def run(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in names[1:]]
            for base, added in analyse(batch.column(1)):
                kinds = [k for k, _, _ in base]
                own = listed(base)
                row = [*(kinds.count(k) for k in KINDS), hashlib.sha256(own.encode()).hexdigest(), listed(base + added) if added else own]
                for column, x in zip(columns, row):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types[1:]))], names)

    given = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, f"`{id_col}` long, {', '.join(f'n_{k} long' for k in KINDS)}, base_sha256 string, spans string")
