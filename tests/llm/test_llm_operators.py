"""Operators against brute force, round trips and held-out accuracy."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from freshet.llm import decontamination, language_model, minhash, packing, pii, quality_classifier, quality_rules, token_files, tokens, toxicity, url_filter
from freshet.llm import textkernel as tk
from freshet.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(LOWER)


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}


def random_text(rng, parts, n=40):
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, n)))


def test_kernel_words():
    rng = random.Random(0)
    texts = [random_text(rng, ["a", "B", " ", "\n", "é", "日", "\x0b", "\x1c", "\u00a0"]) for _ in range(300)] + ["", None]
    data, offsets = tk.text_bytes(pa.array(texts))
    w = tk.words(data, offsets)
    raw = data.tobytes()
    got = [[] for _ in texts]
    for a, b, r in zip(w.starts, w.ends, w.row):
        got[r].append(raw[a:b].decode())
    assert got == [WORD.findall(t or "") for t in texts]
    by_hash = collections.defaultdict(set)
    for (a, b), h in zip(zip(w.starts, w.ends), w.hashes):
        by_hash[int(h)].add(lower(raw[a:b].decode()))
    assert all(len(x) == 1 for x in by_hash.values()) and len(by_hash) == len(set().union(*by_hash.values()))


def test_kernel_slices_do_not_change_sets():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    column = pa.array(texts)
    whole = [s.tolist() for _, _, d, o in tk.slices(column) for s in tk.shingle_sets(d, o)]
    small = [s.tolist() for _, _, d, o in tk.slices(column, 50) for s in tk.shingle_sets(d, o)]
    assert whole == small

    def size(t):
        w = t.split()
        return len({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0

    assert [len(s) for s in whole] == [size(t) for t in texts]


def test_encoder_is_the_tokenizer():
    path = tokens.tokenizer_path()
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "é", "1", "'s", "'", "#", "###", " ", "日", "\x1f", "\x85", ".", "\u3000", "<|endoftext|>", "à", "!"]
    texts = [random_text(rng, parts) for _ in range(4000)] + ["", "a" * 5000, "don't  stop\n\n\nnow \n x", "ſ K ſ"]
    for column in (texts, texts[::-1]):  # the second time from the memo
        flat, counts = tokens.encoder(path).encode(*tk.text_bytes(pa.array(column)))
        at = [0, *np.cumsum(counts)]
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [plain.encode(t, add_special_tokens=False).ids + [0] for t in column]


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 50)
    enc = tokens.Encoder(tokens.tokenizer_path())
    for k in range(8):
        text = " ".join(f"w{k}x{i}" for i in range(30))
        flat, _ = enc.encode(*tk.text_bytes(pa.array([text])))
        assert flat.tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, DATA)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_url_rules(spark):
    rules = spark.createDataFrame([("com", "/", "allow"), ("a.com", "/x", "block"), ("b.a.com", "/x", "allow"), ("net", "", "block"), ("NET", "", "block")], "host string, path string, verdict string")
    urls = ["http://A.com/xy?q", "http://b.a.com/x", "http://c.b.a.com/x#f", "http://ba.com/x", "http://a.com", "x.net", "ftp://u.net:8/", "http://d.net?x://y", "a://", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {
        0: ("a.com", "/xy", "a.com/x", "block"), 1: ("b.a.com", "/x", "b.a.com/x", "allow"), 2: ("c.b.a.com", "/x", "b.a.com/x", "allow"), 3: ("ba.com", "/x", "com/", "allow"),
        4: ("a.com", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("u.net:8", "/", None, "allow"), 7: ("d.net", "", "net", "block"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"),
    }


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(spark, docs):
    rng = random.Random(3)
    rows = dict(enumerate([*docs.values(), *(random_text(rng, ["a ", "b ", "c\n", "#", " ", "d"], 60) for _ in range(300))]))
    got = quality_rules.judge(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    for r in got:
        n, *rest = brute_quality(rows[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 10 or 100 * rest[-1] > 20 * n) and not (r.base_failed and r.kept)


def test_em_finds_the_weak_rules():
    rng = random.Random(4)
    patterns = collections.Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        hit = [0.02, 0.03, 0.04, 0.5] if good else [0.7, 0.6, 0.65, 0.5]
        patterns[tuple(-1 if rng.random() < h else 0 for h in hit)] += 1
    prior, odds = quality_rules.fit(patterns)
    assert abs(prior - 0.8) < 0.08 and odds[0][-1] < -2.5 and odds[1][-1] < -2 and abs(odds[3][-1]) < 0.3
    assert quality_rules.fit({}) == (0.8, [])


def components(sets):
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("block", [7, 128])
def test_near_duplicates(spark, docs, monkeypatch, block):
    """Chains of edits around the threshold, in blocks of a few and in one."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(5)
    rows = dict(docs)
    for base in range(6):
        words = [f"w{base}x{i}" for i in range(rng.choice((6, 20, 60)))]
        for k in range(25):
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"e{base}x{k}x{rng.random()}"
            rows[10_000 + base * 100 + k] = " ".join(words)
    got = minhash.near_duplicates(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()
    sets = {i: shingles(t) for i, t in rows.items()}
    assert {r.doc_id: r.component_id for r in got} == components(sets)
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}


def test_rows_sent_grow_with_a_group(spark, monkeypatch):
    """A group of many chunks sends each member once, and again only to the blocks of the few that it does not hold."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    n = 1600
    members = spark.range(n).selectExpr("cast(7 as long) AS grp", "id AS node", f"cast({n} as long) AS n", f"cast({n // 16} as long) AS n_blocks", "cast(64 as long) AS most")
    dealt = minhash._chunks(members)
    assert dealt.count() == n + minhash.HUBS * n // 16 and dealt.groupBy("lo").count().agg({"count": "max"}).first()[0] < 60
    labels = spark.range(n).selectExpr("id AS node", "CASE WHEN id < 1590 THEN cast(0 as long) ELSE id END AS component")
    crossing = minhash._crossings(members, labels, [])
    rows = crossing.collect()
    assert len(rows) <= 1590 + 10 * 101
    assert {r.node for r in rows if r.side == 0} | {r.node for r in rows if r.side == 1} == set(range(n))
    pairs = collections.defaultdict(lambda: (set(), set()))
    for r in rows:
        pairs[r.lo, r.hi][r.side].add(r.node)
    met = {frozenset((a, b)) for (lo, hi), (x, y) in pairs.items() for a in x for b in (x if lo == hi else y) if a != b}
    assert met >= {frozenset((a, b)) for a in range(1590, n) for b in range(n) if a != b}
    assert minhash._crossings(members, labels.selectExpr("node", "cast(0 as long) AS component"), []) is None
    alone = minhash._crossings(members, labels.selectExpr("node", "node AS component"), [])  # nothing linked: blocks of the widest
    assert alone.count() == n * n // 64 and alone.where("side = 1 and lo = hi").isEmpty()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(6)
    for n in (4, 40, 400):
        common = rng.integers(0, 2**63, n, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, n // 4, dtype=np.uint64)])) for _ in range(2))
        s = minhash.signatures([a * np.uint64(2), b * np.uint64(2)])
        assert abs((s[0] == s[1]).mean() - n / (n + 2 * (n // 4))) < 0.2


def align_brute(p, t):
    prev = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        cur = [i]
        for j, d in enumerate(t, 1):
            cur.append(min(prev[j - 1] + (c != d), prev[j] + 1, cur[-1] + 1))
        prev = cur
    return min(prev)


def test_banded_alignment_and_lemma():
    rng = random.Random(7)
    items = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(4, 50)))) for i in range(30)]
    index = decontamination.build(items)
    for i, text in items:
        for share in (0, 0.02, 0.05, 0.06, 0.1, 0.3):
            s = list(text)
            for _ in range(int(len(text) * share)):
                k = rng.randrange(len(s))
                s[k : k + 1] = rng.choice(([], ["z"], [s[k], "q"]))
            doc = "zz  yy " + "".join(s) + " ww"
            data, offsets = tk.text_bytes(pa.array([doc]))
            plain = " ".join(doc.split())
            edits = align_brute(text, plain)
            k = decontamination.budget(len(text))
            found = [m for m in decontamination.matches(index, data, offsets) if i in index.ids[m[1]]]
            assert bool(found) == (edits <= k), (i, share, edits, k)
            if found:
                assert found[0][4] == edits


def substrings_within(pattern, text, k):
    """Whether some region of the text is within k edits of the whole pattern."""
    return align_brute(pattern, text) <= k


def test_decontamination_counts_characters():
    """Two-byte letters are one edit each, and capitals of every script are folded."""
    rng = random.Random(15)
    alphabet = "абвгдежзиклмнопрстуфхцчшàéèêçñöüß"
    for _ in range(40):
        item = " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 8))) for _ in range(12))
        index = decontamination.build([(1, item), (2, item.upper() if len(item.upper()) == len(item) else item)])
        for edits in range(decontamination.budget(len(item)) + 3):
            s = list(item)
            for at in rng.sample(range(len(s)), edits):
                s[at] = "ы"
            doc = f"Начало {''.join(s).upper() if len(''.join(s).upper()) == len(s) else ''.join(s)} конец"
            low = " ".join("".join(c.lower() if len(c.lower()) == 1 else c for c in doc).split())
            want = substrings_within(item, low, decontamination.budget(len(item)))
            got = list(decontamination.matches(index, *tk.text_bytes(pa.array([doc]))))
            assert bool(got) == want and want == (edits <= decontamination.budget(len(item)))
            assert all(index.ids[m[1]] == [1, 2] and (m[2], m[3]) == (7, 7 + len(s)) for m in got if m[4] == 0)


def test_decontamination_of_repetitive_texts(monkeypatch):
    """Texts of one letter, of few letters, and phrases of many items, against brute force, in parts of every kind."""
    rng = random.Random(16)
    shared = "this phrase stands at the head of every item "
    items = [(i, shared + "".join(rng.choice("abc ") for _ in range(60))) for i in range(30)] + [(50, "a" * 90), (51, "ab" * 40), (52, "a" * 60 + "b" * 8)]
    texts = [shared * 40 + items[3][1] + " " + shared * 9, "a" * 3000, "a" * 59 + "c" + "a" * 80, "ab" * 700 + "a" * 58 + "b" * 9, "", None, "b" * 2000, "".join(rng.choice("ab") for _ in range(2500))]
    index = decontamination.build(items)
    plain = [" ".join((t or "").split()) for t in texts]
    want = {(r, i) for r, t in enumerate(plain) for i, x in items if t and substrings_within(" ".join(x.split()), t, decontamination.budget(len(" ".join(x.split()))))}
    for pairs in (100, 5000, 10**9):
        monkeypatch.setattr(decontamination, "PAIRS", pairs)
        got = {(m[0], i) for m in decontamination.matches(index, *tk.text_bytes(pa.array(texts))) for i in index.ids[m[1]]}
        assert got == want


def test_decontamination_memory_is_bounded():
    """A text of 400,000 equal letters and an item of such letters: memory stays far under their product."""
    import tracemalloc

    index = decontamination.build([(1, "x" * 400)])
    data, offsets = tk.text_bytes(pa.array(["x" * 400_000]))
    tracemalloc.start()
    got = list(decontamination.matches(index, data, offsets))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [m[4] for m in got] == [0] and peak < 500 << 20


@pytest.mark.parametrize("text, found", [
    ("(what is the capital of france?)", True), ("He asked: “What is the capital of France?”, then left", True), ("what  is the capital of france?, it said", True),
    ("what is the capital of france?", True), ("xwhat is the capital of france?", False), ("éwhat is the capital of france?", False),
    ("what is the capital of france?1", False), ("日what is the capital of france?", False), ("what is the capital of france?日", False), ("what was the capital of france?", False),
])
def test_short_items_between_other_signs(text, found):
    index = decontamination.build([(5, "What is the capital of France?")])
    data, offsets = tk.text_bytes(pa.array(["a what", text, "z"]))
    assert [m[0] for m in decontamination.matches(index, data, offsets)] == [1] * found


def test_contaminated_documents_are_found(spark, docs):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}

    def norm(t):
        return " ".join(WORD.findall(lower(t)))

    got = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontamination"](spark, DATA).collect()}
    assert got >= {(d, i) for d, t in docs.items() for i, x in items.items() if norm(x) in norm(t)}
    assert got  # and nothing that brute force does not find
    for d, i in got:
        whole, item = " ".join(docs[d].lower().split()), " ".join(items[i].lower().split())
        assert substrings_within(item, whole, decontamination.budget(len(item)))


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[ -]", "", m[0])
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]


def test_pii_base(spark, docs):
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    rng = random.Random(8)
    parts = [*"ab@@..1209+-() %é", "1.2.3.4", "a@b.c", "4111 1111 1111 1111", "+1 (274) 555-9629"]
    for _ in range(10_000):
        t = random_text(rng, parts, 24)
        assert pii.find_all(t) == brute_pii(t)
    for r in QUERIES["op4_pii"](spark, DATA).collect():
        listed = pii.listed(brute_pii(docs[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and set(listed.split(",")) <= set(r.spans.split(","))


@pytest.mark.parametrize("text, kind, span", [
    ("write john dot doe at example dot com now", "email", "john dot doe at example dot com"),
    ("mail jane [at] site [dot] org!", "email", "jane [at] site [dot] org"),
    ("bob (at) host.example.com", "email", "bob (at) host.example.com"),
    ("foo @ bar . com", "email", "foo @ bar . com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("call plus one two seven four five five five nine six two nine", "phone", "plus one two seven four five five five nine six two nine"),
    ("card ４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("ip one nine two dot one six eight dot zero dot one ok", "ip", "one nine two dot one six eight dot zero dot one"),
])
def test_pii_disguised(text, kind, span):
    base, added = pii.spans(text)
    assert base == [] and [(k, text[a:b]) for k, a, b in added] == [(kind, span)]


LONG = " dot ".join(f"label{i}and{i}more" for i in range(12))


@pytest.mark.parametrize("text, kind, span", [
    ("to john.doe@maıl.com now", "email", "john.doe@maıl.com"),
    (f"write bob at {LONG} dot com", "email", f"bob at {LONG} dot com"),
    (f"write bob@{LONG} dot com", "email", f"bob@{LONG} dot com"),
    ("a dot b dot c dot d dot e dot f (at) host dot org", "email", "a dot b dot c dot d dot e dot f (at) host dot org"),
    ("mail jane at site dot xyz", "email", "jane at site dot xyz"),
    ("mail jane at shop dot example dot online", "email", "jane at shop dot example dot online"),
    ("mail jane at data . com", "email", "jane at data . com"),
    ("ip nine point one point two point three", "ip", "nine point one point two point three"),
])
def test_pii_gate_and_labels(spark, text, kind, span):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [(k, text[a:b]) for k, a, b in pii.spans(text)[1]] == [(kind, span)]
    assert pii.redact(df).collect()[0].text == text.replace(span, f"<{kind.upper()}>")


@pytest.mark.parametrize("text", ["He lives at home . Alice left", "He was at home . It was late", "at work . No one", "seen at the point . us too", "at noon we saw a dot on the map"])
def test_pii_leaves_sentences(text):
    assert pii.spans(text) == ([], [])


@pytest.mark.parametrize("text", ["we met at noon dot the end", "look at the dot on it", "He was at home. Dot com", "one two three four", "name at example.com", "the naïve «café» – ok…"])
def test_pii_leaves_ordinary_text(text):
    assert pii.spans(text) == ([], [])


def test_pii_is_linear_in_spans():
    """Hundreds and thousands of spans in one text, disguised and plain, with times in proportion."""

    def text(n):
        return " ".join(f"user{i} at host{i} dot com, nine point one point two point {i % 10}, call one two three four five six seven eight nine, a{i}@b.org." for i in range(n))

    def took(n):
        whole, began = text(n), time.process_time()
        base, added = pii.spans(whole)
        assert len(base) == n and len(added) == 2 * n
        assert all(whole[a:b].startswith("user") for k, a, b in added if k == "email")
        return time.process_time() - began

    small = took(1000)
    assert took(8000) < 16 * small + 0.5


def test_redaction_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "a@b.co and bob (at) c.org, 1.2.3.4.", 0), (2, None, 5), (3, "plain", 0)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(df, length_col="n_chars").collect()}
    assert got == {1: ("<EMAIL> and <EMAIL>, <IP>.", 26), 2: (None, None), 3: ("plain", 5)}


@pytest.mark.parametrize("text, base, added", [
    ("jоhn@example.com", [(2, 16)], [(0, 16)]),
    ("аlexander.miller@host.com", [(1, 25)], [(0, 25)]),
    ("john@mail.cоm", [(0, 11)], [(0, 13)]),
    ("user@mail.example [dot] com", [(0, 17)], [(0, 27)]),
    ("john@example.com – о", [(0, 16)], []),
])
def test_pii_partly_disguised(spark, text, base, added):
    """A disguise that leaves a fragment which matches by itself: the fragment stays, the whole is added and redacted."""
    assert pii.spans(text) == ([("email", *s) for s in base], [("email", *s) for s in added])
    df = spark.createDataFrame([(1, f"to {text}, now")], "doc_id long, text string")
    end = max(b for _, b in base + added)
    assert pii.redact(df).collect()[0].text == f"to <EMAIL>{text[end:]}, now"
    listed = pii.digests(df).collect()[0]
    assert listed.n_email == len(base) and listed.spans == ",".join(f"email:{a + 3}:{b + 3}" for a, b in sorted(base + added))


@pytest.mark.parametrize("loss", [90, 250, 256])
def test_packing_limits(loss):
    rng = random.Random(9)
    docs = [(i, np.arange(rng.choice((1, 3, 40, 700, 3000)), dtype="<u4").tobytes(), rng.choice((1, 1, 20, 500))) for i in range(400)]
    sequences = list(packing.pack(iter(docs), length=256, segments=6, loss=loss, window=64))
    got = collections.defaultdict(list)
    for s in sequences:
        assert sum(map(len, s)) <= 256 and len(s) <= 6 and sum(p.loss for p in s) <= loss
        for p in s:
            got[p.doc].append((p.start, p.ids))
            assert p.loss == sum(k >= p.quiet for k in range(p.start, p.start + len(p)))
    assert {d: b"".join(x for _, x in sorted(v)) for d, v in got.items()} == {d: ids for d, ids, _ in docs}


@pytest.mark.parametrize("segments", [1, 2, 16])
def test_packing_prefixes(segments):
    """A quarter of each document is context: documents of any length, under limits that all bind."""
    rng = random.Random(13)
    sizes = [rng.choice((1, 2, 5, 90, 300, 511, 512, 513, 2000, 9001)) for _ in range(300)]
    docs = [(i, np.arange(n, dtype="<u4").tobytes(), max(1, n // 4)) for i, n in enumerate(sizes)]
    got, full, tokens_left = collections.defaultdict(list), 0, 0
    for s in packing.pack(iter(docs), length=512, segments=segments, loss=416, window=100):
        assert 0 < sum(map(len, s)) <= 512 and len(s) <= segments and sum(p.loss for p in s) <= 416
        assert sum(map(len, s)) & (sum(map(len, s)) - 1) == 0
        full, tokens_left = full + (sum(map(len, s)) == 512), tokens_left + (sum(map(len, s)) < 512) * sum(map(len, s))
        for p in s:
            got[p.doc].append((p.start, p.ids))
    assert {d: b"".join(x for _, x in sorted(v)) for d, v in got.items()} == {d: ids for d, ids, _ in docs}
    if segments == 16:
        assert tokens_left < 0.05 * sum(sizes)  # nearly all tokens are in full sequences


def test_packing_work_is_bounded_under_a_tight_loss_limit():
    """Sequences full of loss leave the window: as many documents take as long as under a limit that never binds."""
    rng = random.Random(14)
    docs = [(i, np.arange(rng.randint(100, 399), dtype="<u4").tobytes(), 1) for i in range(2000)]

    def took(loss):
        began, drawn, first = time.process_time(), 0, None

        def counted():
            nonlocal drawn
            for d in docs:
                drawn += 1
                yield d

        for s in packing.pack(counted(), length=1024, segments=256, loss=loss, window=64):
            first = first or drawn
            assert sum(p.loss for p in s) <= loss
        return time.process_time() - began, first

    (free, a), (tight, b) = took(1024), took(512)
    assert tight < 3 * free + 0.5 and a <= 64 and b <= 64


def test_packing_prompts(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 4), (2, "a b c d e f", None), (3, "a b c d e f", -2)], "doc_id long, text string, prompt int")
    rows = packing.pack_documents(df, length=64, loss=2, prompt_col="prompt").orderBy("doc_id", "start").collect()
    bearing = collections.Counter()
    for r in rows:
        bearing[r.sequence_id] += sum(k >= (4 if r.doc_id == 1 else 1) for k in range(r.start, r.start + r.length))
    assert max(bearing.values()) == 2 and sum(bearing.values()) == 3 + 6 + 6
    half = packing.pack_documents(df, length=64, loss=2, prefix=0.5).collect()
    assert sum(r.length for r in half) == 21


def test_packing_query(spark, docs):
    plain = Tokenizer.from_file(tokens.tokenizer_path())
    plain.encode_special_tokens = True
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in QUERIES["op5_packing"](spark, DATA).collect():
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert by_doc.keys() == docs.keys()
    for d, rows in by_doc.items():
        ids, at = plain.encode(docs[d] or "", add_special_tokens=False).ids + [0], 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0  # full or a power of two: no padding


def test_token_files(spark, docs):
    plain = Tokenizer.from_file(tokens.tokenizer_path())
    plain.encode_special_tokens = True
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op8_token_files"](spark, DATA).collect()}
    at, want = 0, {}
    for d in sorted(docs):
        ids = plain.encode(docs[d] or "", add_special_tokens=False).ids + [0]
        want[d] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert got == want


@pytest.mark.parametrize("encoding, wanted", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_token_file_format(spark, tmp_path, encoding, wanted):
    """The encoding asked for, and page indexes for selective reads."""
    df = spark.createDataFrame([(i, " ".join(f"word{i % 7} and{j}" for j in range(60))) for i in range(4000)], "doc_id long, text string")
    token_files.write_tokens(df, f"file://{tmp_path}/t", encoding=encoding, row_group_bytes=1 << 20)
    files = [pq.ParquetFile(p).metadata for p in sorted((tmp_path / "t").glob("*.parquet"))]
    columns = [f.row_group(k).column(2) for f in files for k in range(f.num_row_groups)]
    assert all(c.path_in_schema.startswith("input_ids") and c.has_offset_index for c in columns)
    assert any(wanted in c.encodings or "PLAIN_DICTIONARY" in c.encodings and encoding == "dictionary" for c in columns)
    assert token_files.read_tokens(spark, f"file://{tmp_path}/t").where("doc_id between 10 and 19").count() == 10


def test_language_model(spark, docs):
    words = {d: [*WORD.findall(lower(t)), None] for d, t in docs.items()}
    train = [d for d in words if zlib.crc32(str(d).encode()) % 7 != 2]
    counts = collections.Counter(w for d in train for w in words[d])
    n, v = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in QUERIES["op9_interpolation"](spark, DATA).collect()}
    for d, w in words.items():
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d not in train, len(w), sum(counts[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w))
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def brute_interpolation(texts):
    """Scores by dictionaries: estimates of pair and word, buckets of context counts, EM on the held-out part."""
    role = {d: zlib.crc32(str(d).encode()) % 7 for d in texts}
    words = {d: [*WORD.findall(lower(t)), "</s>"] for d, t in texts.items()}

    def counted(wanted):
        one, two, context = collections.Counter(), collections.Counter(), collections.Counter()
        for d, w in words.items():
            if wanted(role[d]):
                one.update(w)
                two.update(zip(["<s>", *w], w))
                context.update(["<s>", *w])
        return one, two, context, sum(one.values())

    def parts(model, before, word, unknown):
        one, two, context, n = model
        bucket = min(context[before].bit_length(), language_model.BUCKETS - 1)
        return bucket, two[before, word] / max(context[before], 1), one[word] / max(n, 1), unknown

    whole, core = counted(lambda r: r != 2), counted(lambda r: r not in (2, 6))
    unknown = 1 / (len(whole[0]) + 1)
    seen = collections.defaultdict(list)
    for d, w in words.items():
        if role[d] == 6:
            for a, b in zip(["<s>", *w], w):
                bucket, *p = parts(core, a, b, unknown)
                # ratios are rounded to steps of an eighth of a power of two, and never under one unless zero
                seen[bucket].append([2 ** (round(math.log2(max(x / unknown, 1)) * 8) / 8) if x else 0 for x in p[:2]] + [1])
    weights, last = {}, None
    for b in range(language_model.BUCKETS):
        mix = [0.4, 0.4, 0.2] if b else [0.0, 0.7, 0.3]
        for _ in range(60 if b in seen else 0):
            got = [0.1 if b else 0.0, 0.1, 0.1]
            for row in seen[b]:
                z = sum(x * y for x, y in zip(row, mix))
                got = [g + x * y / z for g, x, y in zip(got, row, mix)]
            mix = [g / sum(got) for g in got]
        if b in seen:
            last = b
        elif last is not None and b:
            mix = weights[last] if last else [0.3, 0.5, 0.2]
        weights[b] = mix
    out = {}
    for d, w in words.items():
        out[d] = 0.0
        for a, b in zip(["<s>", *w], w):
            bucket, *p = parts(whole, a, b, unknown)
            out[d] += math.log10(sum(x * y for x, y in zip(weights[bucket], p)))
    return out


@pytest.mark.parametrize("range_bytes, partitions", [(500, 5), (8 << 20, 1)])
def test_interpolation_against_brute_force(spark, monkeypatch, range_bytes, partitions):
    """The same scores however the input is split and read again, and however many hash ranges there are."""
    monkeypatch.setattr(language_model, "RANGE_BYTES", range_bytes)
    rng = random.Random(17)
    texts = {i: " ".join(rng.choices("the of A cat Dog sat on mat é ran".split(), weights=range(10, 0, -1), k=rng.randint(0, 25))) for i in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(partitions)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k" if partitions > 1 else "128m")
    try:
        got = {r.doc_id: r.score for r in language_model.score(df).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = brute_interpolation(texts)
    assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d], rel=1e-6) for d in want)


def test_blocks_are_bounded_however_large_a_partition_is(spark, monkeypatch):
    """F1: a whole partition used to be one block, which a task holds. Scores are those of brute force all the same."""
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 400)
    sizes, save = [], language_model.save

    def saved(df, name, **options):
        out = save(df, name, **options)
        if name == "texts":
            sizes.extend(r[0] for r in out.groupBy("block").agg(F.sum(F.octet_length("text"))).collect())
        return out

    monkeypatch.setattr(language_model, "save", saved)
    rng = random.Random(18)
    texts = {i: " ".join(rng.choices("the of A cat Dog sat é".split(), k=rng.randint(0, 25))) for i in range(200)}
    got = {r.doc_id: r.score for r in language_model.score(spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)).collect()}
    want = brute_interpolation(texts)
    assert len(sizes) > 10 and max(sizes) <= 400 + max(len(t.encode()) for t in texts.values())
    assert got.keys() == want.keys() and all(got[d] == pytest.approx(want[d], rel=1e-6) for d in want)


def test_language_model_is_a_distribution(spark):
    """Texts are disjoint events: probabilities of a few stay under one, and longer or unseen ones are rarer."""
    rng = random.Random(10)
    held = [i for i in range(5000, 9000) if zlib.crc32(str(i).encode()) % 7 == 2]
    texts = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 6)))) for i in range(300)]
    probes = dict(zip(held, ["", *"abcd", "unseen"]))
    df = spark.createDataFrame([*texts, *probes.items()], "doc_id long, text string")
    score = {probes[r.doc_id]: r.score for r in language_model.score(df).collect() if r.doc_id in probes}
    twice = dict(zip(held[10:], [f"{w} {w}" for w in "abcd"]))
    more = spark.createDataFrame([*texts, *probes.items(), *twice.items()], "doc_id long, text string")
    again = {twice[r.doc_id]: r.score for r in language_model.score(more).collect() if r.doc_id in twice}
    assert all(again[f"{w} {w}"] < score[w] < 0 for w in "abcd")
    assert 10 ** score[""] + sum(10 ** score[w] for w in "abcd") < 1 and score["unseen"] < min(score[w] for w in "abcd")


def test_quality_classifier_learns_from_every_label(spark):
    """at most 3000 rows a class and 40,000 of their pairs were learned from. All rows are, and all pairs; weights and
    threshold are those that brute force finds over every pair."""
    rng = random.Random(4)
    rows = []
    for i in range(9000):
        good = i % 9 < 6
        text = " ".join(rng.choices(("plain", "words", "that", "read", "well,", "#"), (9, 9, 9, 5, 4, 1 if good else 2), k=rng.randint(8, 14)))
        rows.append((i, text, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    model = quality_classifier.train(df, df.select("doc_id", "quality"))
    x = np.concatenate([quality_classifier.features(d, o) for _, _, d, o in tk.slices(pa.array([r[1] for r in rows]))])
    label = np.array([r[2] for r in rows])
    assert model.mean == pytest.approx(x.mean(axis=0)) and model.scale[x.std(axis=0) > 1e-9] == pytest.approx(x.std(axis=0)[x.std(axis=0) > 1e-9])
    s = np.sort(model.raw(x))
    assert model.threshold == pytest.approx((s[2999] + s[3000]) / 2, abs=1e-12)
    z = model.standard(x)
    good, bad = z[label == 1], z[label == 0]
    assert (len(good), len(bad)) == (6000, 3000)
    lost = 1 / (1 + np.exp((good @ model.weights)[:, None] - bad @ model.weights))
    gradient = (bad.T @ lost.sum(axis=0) - good.T @ lost.sum(axis=1)) / lost.size + 1e-3 * model.weights
    assert np.abs(model.weights).max() > 0.1 and np.abs(gradient).max() < 1e-4


def accuracy(spark, labels, name, label):
    rows = [(r.predicted, labels[r.doc_id][label], r.held_out, r.doc_id) for r in QUERIES[name](spark, "/root/testdata/sf0.01").collect() if r.doc_id in labels]
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for _, _, h, d in rows)
    held = [p == y for p, y, h, _ in rows if h]
    return sum(held) / len(held)


def test_classifiers_on_held_out_rows(spark):
    labels = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert accuracy(spark, labels, "op1_bradley_terry", "quality") > 0.95
    assert accuracy(spark, labels, "op10_toxicity", "toxic") > 0.85


def test_kneser_ney_against_brute_force():
    """Probabilities word by word from dictionaries, and the difference of two texts."""
    rng = random.Random(12)
    texts = [" ".join(rng.choice("a b c d e f g".split() + (["bad", "worse"] if k % 2 else [f"r{rng.randrange(40)}"])) for _ in range(rng.randint(0, 30))) for k in range(60)]
    label = np.arange(60) % 2
    seen = [set(), set()]
    for text, c in zip(texts, label):
        words = WORD.findall(text)
        seen[c] |= set(zip(["^", *words], words))
    counts = [collections.Counter(w for _, w in x) for x in seen]
    known = sorted({*counts[0], *counts[1]})

    def ney(c):
        one, two = (sum(n == k for n in c.values()) for k in (1, 2))
        return one / (one + 2 * two) if one else 0.5

    mass = min(ney(c) * len(c) / sum(c.values()) for c in counts)
    classes = {w: (w in counts[0]) + (w in counts[1]) for w in known}

    def p(w, c):
        d = mass * sum(counts[c].values()) / len(counts[c])
        assert 0 < d < 1
        own = max(counts[c][w] - d, 0) / sum(counts[c].values())
        return own + mass * classes.get(w, 1) / (sum(classes.values()) + 1)

    assert all(abs(sum(p(w, c) for w in [*known, "unknown"]) - 1) < 1e-9 for c in (0, 1))
    models = toxicity.fit_models(texts, label)
    probes = ["a bad b", "worse unknown r1 r2 g", "unknown", "", "r3 " * 50]
    want = [sum(math.log(1 - toxicity.MIX + toxicity.MIX * p(w, 1) / p(w, 0)) for w in t.split()) / max(1, len(t.split())) ** toxicity.NORM for t in probes]
    assert models.differences(*tk.text_bytes(pa.array(probes))).tolist() == pytest.approx(want)
    assert want[2] == want[3] == 0 and want[0] > 0 > want[4]


def test_toxicity_rises_with_the_difference(spark):
    rows = [(i, ("you idiot " if i % 2 else "") + " ".join(random.Random(i).choices("the of and to in is".split(), k=30)), i % 2) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))
    data, offsets = tk.text_bytes(pa.array([r[1] for r in rows]))
    order = np.argsort(model.models.differences(data, offsets), kind="stable")
    assert (np.diff(model.score(data, offsets)[order]) >= 0).all()
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.classify(docs, model).collect())


def test_pipeline_against_brute_force(spark, docs):
    """The stages once more, document by document, from parts that are held against brute force above."""
    kept = {r.doc_id for r in quality_rules.judge(spark.read.parquet(f"{DATA}/documents.parquet")).collect() if r.kept}
    kept = {d for d, c in components({d: shingles(docs[d]) for d in kept}).items() if d == c}
    items = decontamination.build([(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()])
    kept = {d for d in kept if not list(decontamination.matches(items, *tk.text_bytes(pa.array([docs[d]]))))}
    plain = Tokenizer.from_file(tokens.tokenizer_path())
    plain.encode_special_tokens = True
    want = {}
    for d in kept:
        text = docs[d]
        for kind, a, b in sorted((s for x in pii.spans(text) for s in x), key=lambda s: (-s[1], s[2])):
            text = f"{text[:a]}<{kind.upper()}>{text[b:]}"
        want[d] = plain.encode(text, add_special_tokens=False).ids + [0]
    got = collections.defaultdict(int)
    for r in corpus_pipeline.run(spark, DATA).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        got[r.doc_id] += r.length
    assert got == {d: len(x) for d, x in want.items()}
