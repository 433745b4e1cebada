"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint has 64 bits, from the XXH64 values of word shingles.  Fingerprints link at ``RADIUS`` or fewer
differing bits.  By the pigeonhole rule, linked fingerprints agree on one of four 16-bit blocks, so each distinct
fingerprint is dealt to four cells (a mask and the bits under it).  A cell that holds too many is dealt anew on
the remaining bits, in four parts again, which loses no link: cells stay small however skewed the fingerprints are.
Within a cell, fingerprints are sorted by Gray rank; runs of neighbours become nodes, and nodes of nodes, that keep
the bits their members share.  A search adds up differing bits from the root downward, each level only over the bits
that its parent does not fix, and drops whole groups as soon as the sum passes the radius.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Durable, bounded_batches, few, free_name, one_column, table, text_buffer, unique_join
from .components import HUB, smallest_reachable

SEED, SHINGLE, RADIUS = 42, 3, 3
#: Members of a node.
FAN = 8
#: Cells with more distinct fingerprints are split.
CELL = 8192
#: Pairs (search, node) held at once.
FRONT = 1 << 20
U = np.uint64


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of ``size`` words; of the whole sequence where there are fewer; none for no words."""
    words = text.lower().split()
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stop = ends[size - 1 :].tolist()
    start = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(start, stop)]


def bit_counts(h: np.ndarray) -> np.ndarray:
    """For each of the 64 bits, how many values have it set."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        part = np.unpackbits(h[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += part.sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    return majority(np.array(shingle_hashes(text, size), U))


def majority(h: np.ndarray) -> int:
    """The bits that over half of the hashes have; zero of none."""
    if not len(h):
        return 0
    bits = bit_counts(h) * 2 > len(h)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(id, fp long) per row; null and empty texts have fingerprint zero.  ``keyed`` adds the SHA-256 digest of the text."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            raw, off = text_buffer(one_column(batch, text_col))
            data, cuts = raw.tobytes(), off.tolist()
            fps = np.array([fingerprint(data[a:b], size) for a, b in zip(cuts, cuts[1:])], U)
            columns = [one_column(batch, id_col), pa.array(fps.view(np.int64))]
            if keyed:
                columns.append(pa.array([hashlib.sha256(data[a:b]).digest() for a, b in zip(cuts, cuts[1:])], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "fp", "digest"][: len(columns)])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp long" + ", digest binary" * keyed)


# --- the index over the cells of one batch ---


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a code word in the Gray sequence."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U(k))
    return x


def _runs(group: np.ndarray) -> np.ndarray:
    """Starts of runs of at most FAN equal neighbours."""
    new = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[new, len(group)])
    many = -(-size // FAN)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(new, many) + nth * FAN


class GrayIndex:
    """Levels from the fingerprints (0) up to one root for each group; arrays must be sorted by (group, Gray rank)."""

    def __init__(self, group: np.ndarray, fp: np.ndarray):
        self.levels = []  # (shared mask, shared bits, first child, end of children)
        self.fp, g = fp, group
        mask, bits = np.full(len(fp), ~U(0)), fp
        while True:
            start = _runs(g)
            end = np.r_[start[1:], len(g)]
            same = ~(np.bitwise_or.reduceat(bits, start) ^ np.bitwise_and.reduceat(bits, start))
            shared = np.bitwise_and.reduceat(mask, start) & same
            self.levels.append((shared, bits[start] & shared, start, end))
            mask, bits, g = shared, bits[start] & shared, g[start]
            if len(g) == 1 or (g[1:] != g[:-1]).all():
                break
        self.roots = np.searchsorted(g, group)

    def links(self, radius: int = RADIUS):
        """Arrays (i, j), i < j, of fingerprints of one group within the radius."""
        todo = [(len(self.levels) - 1, i, min(i + FRONT // 8, len(self.fp))) for i in range(0, len(self.fp), FRONT // 8)]
        for top, a, b in todo:
            q = np.arange(a, b)
            yield from self._search(top, q, self.roots[a:b], np.zeros(b - a, np.int64), np.zeros(b - a, U), radius)

    def _search(self, level, q, node, spent, fixed, radius):
        if len(q) > FRONT:
            h = len(q) // 2
            yield from self._search(level, q[:h], node[:h], spent[:h], fixed[:h], radius)
            yield from self._search(level, q[h:], node[h:], spent[h:], fixed[h:], radius)
            return
        mask, bits, start, end = self.levels[level]
        own = mask[node] & ~fixed  # the bits that this node adds to those of its parents
        spent = spent + np.bitwise_count((self.fp[q] ^ bits[node]) & own)
        live = (spent <= radius) & (end[node] > 0)
        q, node, spent = q[live], node[live], spent[live]
        if not len(q):
            return
        fixed = mask[node]
        n = end[node] - start[node]
        child = np.repeat(start[node], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        q, spent, fixed = np.repeat(q, n), np.repeat(spent, n), np.repeat(fixed, n)
        if level:
            yield from self._search(level - 1, q, child, spent, fixed, radius)
        else:
            good = (child > q) & (spent + np.bitwise_count((self.fp[q] ^ self.fp[child]) & ~fixed) <= radius)
            if good.any():
                yield q[good], child[good]


def spanning(n: int, pairs) -> np.ndarray:
    """Smallest reachable place of each of n places, over batches of links."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            low = np.minimum(a, b)
            if (a == b).all():
                break
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _cells(radius: int):
    """Streams sorted (mask, cell, rank, fp, rep) rows; whole cells together; yields spanning links (a, b) of reps."""

    def solve(cell, fp, rep):
        group = np.cumsum(np.r_[False, (cell[1:] != cell[:-1]).any(axis=1)]) if len(cell) else np.zeros(0, np.int64)
        label = spanning(len(fp), GrayIndex(group, fp).links(radius))
        least = np.full(len(fp), np.iinfo(np.int64).max)
        np.minimum.at(least, label, rep)
        low = least[label]
        far = rep != low
        return pa.RecordBatch.from_arrays([pa.array(rep[far]), pa.array(low[far])], names=["a", "b"])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            get = lambda c, b=batch: one_column(b, c).to_numpy(zero_copy_only=False)
            cell, fp, rep = np.stack([get("mask"), get("cell")], 1), get("fp").view(U), get("rep")
            if held and not (held[-1][0][-1] == cell[-1]).all():
                cut = int(np.flatnonzero((cell != cell[-1]).any(axis=1))[-1]) + 1 if (cell != cell[-1]).any() else 0
                whole = [*held, (cell[:cut], fp[:cut], rep[:cut])]
                yield solve(*(np.concatenate(x) for x in zip(*whole)))
                held = [(cell[cut:], fp[cut:], rep[cut:])]
            else:
                held.append((cell, fp, rep))
        if held:
            yield solve(*(np.concatenate(x) for x in zip(*held)))

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _split(mask: int, parts: int) -> list[int]:
    """Masks that add to ``mask`` one of ``parts`` runs of the bits it leaves free."""
    free = [b for b in range(64) if not mask >> b & 1]
    cut = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cut, cut[1:])]


def _gray(fp: Column) -> Column:
    """Gray rank as 16 digits, whose order is the unsigned order."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def near_links(reps: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """(fp, rep) of distinct fingerprints -> links (a, b) of reps that span all that are within the radius."""
    spark = reps.sparkSession
    store = Durable(spark, "cells")
    parts = radius + 1

    def deal(rows: DataFrame, masks: list[int]) -> DataFrame:
        mine = F.explode(F.array(*[F.lit(_signed(m)) for m in masks]))
        return rows.select("fp", "rep", mine.alias("mask")).withColumn("cell", F.col("fp").bitwiseAND(F.col("mask")))

    open_masks = _split(0, parts)
    cells = store.write(deal(reps, open_masks))
    done = []
    while True:
        full = cells.groupBy("mask", "cell").count().where(F.col("count") > cell)
        masks = [r["mask"] % (1 << 64) for r in full.select("mask").distinct().collect()]  # of a fixed set of masks
        masks = [m for m in masks if 64 - bin(m).count("1") > 2 * parts]
        if not masks:
            done.append(cells)
            break
        full = store.write(full.where(F.col("mask").isin([_signed(m) for m in masks])).select("mask", "cell"))
        done.append(cells.join(full, ["mask", "cell"], "left_anti"))
        again = cells.join(full, ["mask", "cell"], "left_semi")
        cells = store.write(
            [deal(again.where(F.col("mask") == _signed(m)), _split(m, parts)) for m in masks][0]
            if len(masks) == 1
            else _union([deal(again.where(F.col("mask") == _signed(m)), _split(m, parts)) for m in masks])
        )
    return search_cells(_union([x.select("mask", "cell", "fp", "rep") for x in done]), radius)


def search_cells(rows: DataFrame, radius: int) -> DataFrame:
    """(mask, cell, fp, rep) -> links (a, b) of reps that span all within the radius in a cell, by a Gray-order index of each cell."""
    bounded_batches(rows.sparkSession)
    return (
        rows.repartition("mask", "cell")
        .withColumn("rank", _gray(F.col("fp")))
        .sortWithinPartitions("mask", "cell", "rank")
        .select("mask", "cell", "fp", "rep")
        .mapInArrow(_cells(radius), "a long, b long")
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _grouped(every: DataFrame, store: Durable, radius: int, cell: int) -> DataFrame:
    """(fp, node, component) of distinct fingerprints: the smallest fingerprint and the smallest id reachable over links.

    Fingerprints themselves are what is linked, so ids, null or repeated, join nothing; they only name a component.
    """
    reps = store.write(every.groupBy("fp").agg(F.min("id").alias("least")))
    small = smallest_reachable(near_links(reps.select("fp", F.col("fp").alias("rep")), radius, cell))
    node = F.coalesce("component", "fp").alias("node")
    nodes = store.write(reps.join(small.withColumnRenamed("id", "fp"), "fp", "left").select("fp", "least", node))
    return nodes.select("fp", "node").join(nodes.groupBy("node").agg(F.min("least").alias("component")), "node")


def components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS,
    cell: int = CELL,
) -> DataFrame:
    """(id, fp, component): the smallest id reachable over links, itself included.

    Null and empty texts share fingerprint zero and so one component, whatever else links to it.  Repeated rows give
    repeated results.  Ids are longs; a null id comes after all
    others, and a component of null ids alone is null.  Empty tables give empty results; other columns are not read.
    """
    store = Durable(docs.sparkSession, "simhash")
    every = store.write(fingerprints(docs, id_col, text_col, size))
    return unique_join(every, store.write(_grouped(every, store, radius, cell)), "fp").select("id", "fp", "component")


def _one_each(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of the rows of each node of (id, digest, node), a written table, the one with the smallest id, null after all others.

    Rows of one id are told apart by their text; of rows alike in both one stays.  What is dropped is a table of ids (and
    digests): a short one is broadcast, so no text moves; beyond that both sides are dealt by id.
    """
    store = Durable(docs.sparkSession, "one-each")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("best")
    groups = store.write(found.groupBy("node").agg(first, F.count("*").alias("n")).where("n > 1"))
    hot = groups.where(F.col("n") > found.count() * HUB).select(F.col("node").alias("hn"), F.col("best").alias("hb"))
    marked = found.join(F.broadcast(hot), F.col("node") == F.col("hn"), "left")
    rest = marked.where("hn is null").select("id", "digest", "node").join(groups.select("node", "best"), "node")
    every = marked.where("hn is not null").select("id", "digest", F.col("hb").alias("best")).unionByName(rest.select("id", "digest", "best"))
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("digest") == F.col("best.digest"))
    key, mark, own = (free_name(docs, x) for x in ("gone", "digest", "own"))
    gone = store.write(every.where(~stays).select(F.col("id").alias(key), F.col("digest").alias(mark)).distinct())
    how = lambda t: t.hint("broadcast" if few(t) else "shuffle_hash")
    same = F.col(id_col).eqNullSafe(F.col(key))
    if not found.groupBy("id").count().where("count > 1").limit(1).count():
        return docs.join(how(gone.select(key)), same, "left_anti")
    alike = store.write(found.groupBy("id", "digest").count().where("count > 1").select(F.col("id").alias(key), F.col("digest").alias(mark)))
    same &= F.col(own) == F.col(mark)
    left = docs.withColumn(own, F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))).join(how(gone), same, "left_anti")
    one = left.join(how(alike), same, "left_semi").dropDuplicates([id_col, own])
    return left.join(how(alike), same, "left_anti").unionByName(one).drop(own)


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS,
    cell: int = CELL,
) -> DataFrame:
    """One row of each component, that of its smallest id, with all columns; of repeated rows one stays.

    Null and empty texts are one component, a null id comes after all others, an empty table gives an empty result.
    """
    store = Durable(docs.sparkSession, "near")
    every = store.write(fingerprints(docs, id_col, text_col, size, keyed=True))
    found = store.write(unique_join(every, store.write(_grouped(every, store, radius, cell)), "fp").select("id", "digest", "node"))
    return _one_each(docs, found, id_col, text_col)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def brute(texts: list[tuple[int, str | None]]) -> dict[int, tuple[str, int]]:
    """The same by plain loops over all pairs, for tests."""
    import re

    fps = {}
    for k, t in texts:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps[k] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    ids = sorted(fps)
    low = {k: k for k in ids}
    changed = True
    near = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if bin(fps[a] ^ fps[b]).count("1") <= 3]
    while changed:
        changed = False
        for a, b in near:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return {k: (f"{fps[k]:016x}", low[k]) for k in ids}
