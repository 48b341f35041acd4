"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped edges.

Plan, with what is shuffled:

1. One pass over the texts: the digest of each document's shingle set, its size, a 256-bin one-permutation signature
   (one byte a bin) and 40 band keys of four full bins. Equal sets are one *class*; copies are never compared.
2. Band keys of classes are counted; only those of two or more classes go on, with the signatures of their classes.
   At a similarity of 0.75 forty bands of four miss a link with probability (1 - 0.75^4)^40 = 3e-7.
3. Inside a bucket, classes whose signatures agree in enough bins are *plausible*; a bucket returns a spanning forest
   of star-shaped edges of them, at most one edge for each member, never its pairs. 157 of 256 bins lie four standard
   deviations or more under what 0.75 gives.
4. Components of plausible edges bound where links can lie. The full sets of their members, and no others, are
   gathered; exact intersections confirm links, and again only spanning edges are returned.
5. Components of confirmed edges are the result.

A bucket or component over ``BLOCK`` members is first dealt in chunks of that size, each with the same ``HUBS`` of its
members: a chunk joins what it can, and the hubs join the chunks, so each member is sent once. What is then one component
is never compared inside again. Only if several components are left in a group are their blocks paired, a component's
with those of the others; the few members that a large group leaves over thus meet the rest in a number of rows that
grows with its size, not with its square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm import textkernel as tk
from freshet.llm.components import components
from freshet.llm.storage import apart, discard, save
from freshet.session import ensure_importable

BINS, ROWS, BANDS = 256, 4, 40
AGREE = 157
BLOCK = 128
HUBS = 8
#: Most members of a block that is paired with others, where a group leaves many over.
WIDE = 2048
#: Rows of a table that is broadcast.
BROADCAST_ROWS = 200_000
#: Members of a block hold at most this many shingles in sum before the block is cut again.
BLOCK_SHINGLES = 2_000_000
_TRIES = 2048
_RANDOM = np.random.default_rng(7)
_PROBE = _RANDOM.integers(0, BINS, (_TRIES, BINS))
_ROW_CODE = _RANDOM.integers(1, 2**63, ROWS, dtype=np.uint64) * tk.U64(2) + tk.U64(1)
_BAND_CODE = _RANDOM.integers(1, 2**63, BANDS, dtype=np.uint64)
_EDGES = np.arange(BINS, dtype=np.uint64) << tk.U64(56)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Full 64-bit bins of each non-empty set (rows of an empty one are zero): a bin keeps its least hash, and an empty
    bin takes that of the first filled one in a random order of its own."""
    out = np.zeros((len(sets), BINS), dtype=np.uint64)
    filled = np.zeros((len(sets), BINS), dtype=bool)
    for i, s in enumerate(sets):
        if len(s):
            at = np.searchsorted(s, _EDGES)
            ok = at < len(s)
            ok[ok] = (s[at[ok]] >> tk.U64(56)) == np.flatnonzero(ok).astype(np.uint64)
            out[i, ok] = s[at[ok]]
            filled[i] = ok
    rows, bins = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for t in range(_TRIES):
        if not len(rows):
            break
        source = _PROBE[t, bins]
        hit = filled[rows, source]
        out[rows[hit], bins[hit]] = out[rows[hit], source[hit]]
        rows, bins = rows[~hit], bins[~hit]
    for r, b in zip(rows.tolist(), bins.tolist()):  # of sets of a few shingles, one bin in thousands
        out[r, b] = out[r, np.flatnonzero(filled[r])[0]]
    return out


def band_keys(full: np.ndarray) -> np.ndarray:
    groups = full[:, : BANDS * ROWS].reshape(len(full), BANDS, ROWS)
    return tk.mix((groups * _ROW_CODE).sum(axis=2, dtype=np.uint64) + _BAND_CODE)


def _fingerprints(batches):
    for batch in batches:
        ids, text = batch.column(0), batch.column(1)
        for lo, hi, data, offsets in tk.slices(text):
            sets = tk.shingle_sets(data, offsets)
            full = signatures(sets)
            small = ((full * tk.U64(0x9E3779B97F4A7C15)) >> tk.U64(56)).astype(np.uint8)
            bands = band_keys(full)
            digest, sig, keys = [], [], []
            for i, s in enumerate(sets):
                a = int(np.add.reduce(tk.mix(s))) if len(s) else 0
                b = int(np.add.reduce(tk.mix(s ^ tk.U64(0xA5A5A5A55A5A5A5A)))) if len(s) else 0
                digest.append(a.to_bytes(8, "little") + b.to_bytes(8, "little"))
                sig.append(small[i].tobytes() if len(s) else None)
                keys.append(bands[i].tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(digest, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.binary())],
                ["id", "n_shingles", "digest", "sig", "bands"],
            )


def _sets(batches):
    for batch in batches:
        ids, text = batch.column(0), batch.column(1)
        for lo, hi, data, offsets in tk.slices(text):
            sets = tk.shingle_sets(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"]
            )


def _spread_bands(batches):
    for batch in batches:
        node, bands = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        keys = np.frombuffer(b"".join(bands.to_pylist()), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(node, BANDS))], ["bucket", "node"])


class Forest:
    """Groups of a block's members; keeps the links that joined two of them."""

    def __init__(self, node: np.ndarray):
        self.node, self.label, self.links = node, np.arange(len(node)), []

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        if a != b:
            self.label[self.label == max(a, b)] = min(a, b)
            self.links.append((int(self.node[i]), int(self.node[j])))


def _table(pairs: list[tuple[int, int]]) -> pa.Table:
    u, v = zip(*pairs) if pairs else ((), ())
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def _plausible(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    node = table["node"].to_numpy()
    side = table["side"].to_numpy()
    sig = np.frombuffer(b"".join(table["sig"].to_pylist()), dtype=np.uint8).reshape(len(node), BINS)
    _, order = np.unique(np.stack([side.astype(np.int64), node]), axis=1, return_index=True)  # a hub may be a member, too
    node, side, sig = node[order], side[order], sig[order]
    two = side[0] == 0 and side[-1] == 1
    forest = Forest(node)
    for i in range(len(node) - 1 if two or side[0] == side[-1] == 0 else 0):
        if two and side[i] == 1:
            break
        after = np.flatnonzero(forest.label[i + 1 :] != forest.label[i]) + i + 1
        if two:
            after = after[side[after] == 1]
        for j in after[(sig[after] == sig[i]).sum(axis=1) >= AGREE]:
            forest.join(i, j)
    return _table(forest.links)


def _confirmed(table: pa.Table) -> pa.Table:
    """Spanning edges of exact links, 100 * intersection >= 75 * union, of a block or a pair of blocks."""
    table = table.combine_chunks()
    node, side = table["node"].to_numpy(), table["side"].to_numpy()
    raw = table["shingles"].to_pylist()
    _, order = np.unique(np.stack([side.astype(np.int64), node]), axis=1, return_index=True)
    node, side = node[order], side[order]
    sets = [np.frombuffer(raw[k], dtype=np.uint64) for k in order]
    size = np.array([len(s) for s in sets])
    two = side[-1] == 1 and side[0] == 0
    left = np.flatnonzero(side == 0) if two else np.arange(len(node))
    right = np.flatnonzero(side == 1) if two else left
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(column) > 1
    rank = np.cumsum(often) - 1
    row = np.repeat(np.arange(len(node)), size)[often[column]]
    column = rank[column[often[column]]]
    n_columns = int(rank[-1]) + 1 if len(rank) else 0
    shared = np.zeros((len(left), len(right)), dtype=np.float64)
    step = max(256, 8_000_000 // max(1, len(node)))
    by_column = np.argsort(column, kind="stable")
    row, column = row[by_column], column[by_column]
    for lo in range(0, n_columns, step):
        a, b = np.searchsorted(column, (lo, lo + step))
        dense = np.zeros((len(node), min(step, n_columns - lo)), dtype=np.float32)
        dense[row[a:b], column[a:b] - lo] = 1
        shared += dense[left] @ dense[right].T
    union = size[left][:, None] + size[right][None, :] - shared
    linked = 100 * shared >= 75 * union
    forest = Forest(node)
    for i in range(len(left)):
        for j in np.flatnonzero(linked[i]):
            forest.join(left[i], right[j])
    return _table(forest.links)


def _beside(table: DataFrame) -> DataFrame:
    """A written table for a join: broadcast if it is short, else dealt apart."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else apart(table)


def _block(component, number):
    """A block's name, of members of one component or (null) of several. Two blocks that share a name, one pair of 2^64,
    are compared as one."""
    return F.xxhash64(component.isNull(), component, number.cast("int"))


def _chunks(members: DataFrame) -> DataFrame:
    """``grp, lo, hi, node, side`` of every chunk of every group, with the hubs of groups of several."""
    nobody = F.lit(None).cast("long")
    own = members.select("grp", "node", F.pmod(F.xxhash64("node"), F.col("n_blocks")).alias("at"))
    hubs = members.where("n_blocks > 1").groupBy("grp", "n_blocks", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(HUBS)).alias("slice"))
    hubs = hubs.agg(F.min_by("node", F.xxhash64("node", F.lit(2))).alias("node"))
    hubs = hubs.select("grp", "node", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("at"))
    chunk = _block(nobody, F.col("at"))
    return own.union(hubs).select("grp", chunk.alias("lo"), chunk.alias("hi"), "node", F.lit(0).alias("side"))


def _crossings(members: DataFrame, labels: DataFrame, spent: list[DataFrame]) -> DataFrame | None:
    """``grp, lo, hi, node, side`` of the pairs of blocks, in groups of several chunks, that hold members of different
    components; None if there are none. A component of a block's size or more has blocks of its own. Tables that it
    writes are added to ``spent``."""
    placed = members.where("n_blocks > 1").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = save(placed, "placed")
    sizes = save(placed.groupBy("grp", "component", "n", "most").agg(F.count("*").alias("size")), "sizes")
    spent += [placed, sizes]
    # blocks as large as what the largest component leaves over, within bounds: all others then meet it in one block
    over = F.col("n") - F.max("size")
    several = sizes.groupBy("grp", "n", "most").agg(F.count("*").alias("k"), over.alias("over")).where("k > 1")
    sizes = sizes.join(several.select("grp", F.least("most", F.greatest("over", F.lit(BLOCK))).alias("per")), "grp")
    if sizes.isEmpty():
        return None
    sizes = sizes.withColumn("component", F.when(F.col("size") >= F.col("per"), F.col("component")))
    sizes = sizes.groupBy("grp", "component").agg(F.ceil(F.sum("size") / F.first("per")).cast("int").alias("blocks"))
    sizes = save(sizes, "blocks")
    spent.append(sizes)
    sizes = _beside(sizes)
    own = placed.join(sizes.where("component is not null").withColumnRenamed("blocks", "alone"), ["grp", "component"], "left")
    own = own.withColumn("component", F.when(F.col("alone").isNotNull(), F.col("component"))).drop("alone")
    same = (F.col("m.grp") == F.col("s.grp")) & F.col("m.component").eqNullSafe(F.col("s.component"))
    own = own.alias("m").join(sizes.alias("s"), same).select("m.grp", "m.node", "m.component", F.pmod(F.xxhash64("m.node"), F.col("s.blocks")).alias("number"))
    blocks = sizes.select("grp", F.col("component").alias("other"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other_number"))
    met = own.join(blocks, "grp").where("component is null or other is null or component <> other")
    mine, theirs = _block(F.col("component"), F.col("number")), _block(F.col("other"), F.col("other_number"))
    met = met.select("grp", "node", mine.alias("mine"), theirs.alias("theirs"))
    return met.select("grp", F.least("mine", "theirs").alias("lo"), F.greatest("mine", "theirs").alias("hi"), "node", F.when(F.col("mine") <= F.col("theirs"), 0).otherwise(1).alias("side"))


def _joined(members: DataFrame, payload, func) -> DataFrame:
    """``(node, component)`` of the members that ``func`` links with others of their group. ``members`` is a written
    table ``grp, node, n, n_blocks, most`` with a group's size, number of chunks and most members of a paired block;
    ``payload`` adds to rows with a ``node`` what ``func`` compares."""

    def links(dealt: DataFrame) -> DataFrame:
        return save(payload(dealt).groupBy("grp", "lo", "hi").applyInArrow(func, "u long, v long").distinct(), "links")

    first = links(_chunks(members))
    found = save(components(first), "components")
    discard(first)
    if not members.where("n_blocks > 1").isEmpty():
        spent: list[DataFrame] = []
        crossings = _crossings(members, found, spent)
        if crossings is not None:
            second = links(crossings)
            if not second.isEmpty():
                whole = save(components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(second)), "components")
                discard(found)
                found = whole
            discard(second)
        for table in spent:
            discard(table)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every document.

    A document's set is that of its distinct 5-word shingles (A-Z lower-cased); one of fewer words has its whole
    sequence as only shingle; one without words or with a null text has an empty set and is linked with nothing.
    Documents are linked at ``100 * intersection >= 75 * union``. ``component_id`` is the smallest id reachable, and
    ``kept`` whether that is the document's own. Exact copies are linked. Rows that repeat an id repeat its result.
    Null ids stand alone with a null component and are kept. Other columns are ignored.
    """
    ensure_importable(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = save(given.mapInArrow(_fingerprints, "id long, n_shingles long, digest binary, sig binary, bands binary"), "prints")
    classes = prints.where("n_shingles > 0 and id is not null").groupBy("digest").agg(
        F.min("id").alias("node"), F.min_by("sig", "id").alias("sig"), F.min_by("bands", "id").alias("bands"), F.first("n_shingles").alias("n_shingles")
    )
    classes = save(classes, "classes")

    banded = classes.select("node", "bands").mapInArrow(_spread_bands, "grp long, node long")
    shared = banded.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1")
    members = banded.join(apart(shared), "grp").withColumn("n_blocks", F.ceil(F.col("n") / BLOCK))
    members = save(members.select("grp", "node", "n", "n_blocks", F.lit(WIDE).cast("long").alias("most")), "members")
    signed = classes.select("node", "sig")
    groups = _joined(members, lambda dealt: dealt.join(signed, "node"), _plausible)
    discard(members)

    sized = groups.join(classes.select("node", "n_shingles"), "node")
    sizes = sized.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("total"))
    n_blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.least(F.ceil(F.col("total") / BLOCK_SHINGLES), F.col("n")))
    most = F.greatest(F.lit(1), F.least(F.lit(WIDE), F.floor(F.col("n") * BLOCK_SHINGLES / F.col("total"))))
    sizes = save(sizes.select("component", "n", n_blocks.alias("n_blocks"), most.alias("most")).where("n_blocks > 1"), "sizes")  # of a block or more each
    one = F.lit(1).cast("long")
    members = groups.join(_beside(sizes), "component", "left")
    members = save(members.select(F.col("component").alias("grp"), "node", *(F.coalesce(c, one).alias(c) for c in ("n", "n_blocks", "most"))), "members")

    def sets(dealt: DataFrame) -> DataFrame:
        # the ids of texts to read again: few enough to be sent to all texts, unless groups hold very many
        ids = save(dealt.select(F.col("node").alias("id")).distinct(), "ids")
        read.append(ids)
        wanted = given.join(_beside(ids), "id", "left_semi").mapInArrow(_sets, "node long, shingles binary")
        return dealt.join(wanted.dropDuplicates(["node"]), "node")

    read: list[DataFrame] = []
    found = _joined(members, sets, _confirmed)
    labelled = classes.select("digest", "node").join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    alone = prints.where("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component"))
    rest = prints.where("n_shingles > 0 and id is not null").select("id", "n_shingles", "digest").join(labelled, "digest")
    out = save(rest.select("id", "n_shingles", "component").union(alone), "near")
    for spent in (*read, members, found, groups, sizes, classes, prints):
        discard(spent)
    return out.select(
        F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
