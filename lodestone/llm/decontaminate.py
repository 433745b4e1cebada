"""Benchmark decontamination by a prefix-filtered set join.

Every item becomes windows of consecutive words; a window is a set of word shingles with fixed places.  Shingles
are ordered by how often all documents hold them.  As a window must be contained whole, its necessary prefix is
its rarest shingle: only documents with that shingle are looked at.  The shingle's place fixes where the window
would start, the bounds of the text say whether it fits, and the words are then compared one by one.

The items are the stated query set: they go to the executors in blocks of at most ``BLOCK_WORDS`` words, one pass
over the documents for each block, so the broadcast is bounded whatever the size of the benchmark.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Durable, bounded_batches, one_column, slices, table, text_buffer
from .words import HashSet, shingles, split_words

WINDOW, SHINGLE = 10, 3
#: Words of one block of items; its index takes about 200 bytes a word.
BLOCK_WORDS = 400_000
#: Blocks whose indexes a task may hold at once.
CHAIN = 4
#: Words before lower-casing.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Windows:
    """The windows of a block of items, and after ``rank`` the prefix index over them."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW, shingle: int = SHINGLE):
        seen: dict[tuple[bytes, ...], int] = {}
        self.words: list[tuple[bytes, ...]] = []
        self.items: list[list[int]] = []
        names: dict[str, int] = {}  # rows of one name are one item
        grams: list[tuple[int, np.ndarray]] = []
        for name, text in items:
            k = names.setdefault(name, len(names))
            raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
            low, s, e, _, h = split_words(raw, np.array([0, len(raw)]))
            if not len(s):
                continue
            data, size = low.tobytes(), min(window, len(s))
            own = [data[a:b] for a, b in zip(s.tolist(), e.tolist())]
            g = min(shingle, size)
            hashes = shingles(h, g)
            for i in range(len(own) - size + 1):
                key = tuple(own[i : i + size])
                w = seen.setdefault(key, len(seen))
                if w == len(self.words):
                    self.words.append(key)
                    self.items.append([])
                    grams.append((g, hashes[i : i + size - g + 1]))
                if not self.items[w] or self.items[w][-1] != k:
                    self.items[w].append(k)
        self.items = [list(dict.fromkeys(x)) for x in self.items]
        self.names = list(names)
        self.grams = grams
        self.sizes = sorted({g for g, _ in grams})
        self.all = {g: HashSet(np.concatenate([x for y, x in grams if y == g])) for g in self.sizes}

    def rank(self, counts: dict[int, np.ndarray]) -> None:
        """Takes each window's rarest shingle (the first of equals) as its prefix."""
        self.prefix = {}
        for g in self.sizes:
            own = [w for w, (y, _) in enumerate(self.grams) if y == g]
            pick = []
            for w in own:
                at = np.searchsorted(self.all[g].values, self.grams[w][1])
                pick.append((self.grams[w][1], int(np.argmin(counts[g][at]))))
            token = np.array([x[k] for x, k in pick], np.uint64)
            order = np.argsort(token, kind="stable")
            chosen = HashSet(token)
            left = np.searchsorted(token[order], chosen.values, "left")
            right = np.searchsorted(token[order], chosen.values, "right")
            self.prefix[g] = (chosen, left, right - left, np.array(own)[order], np.array([k for _, k in pick])[order])
        self.size = np.array([len(x) for x in self.words])
        del self.grams, self.all


def _count(sent, column):
    """Partial counts of the shingles of several indexes over one task's documents."""

    def run(batches):
        every = sent.value
        have = [(k, g, np.zeros(len(x.all[g].values), np.int64)) for k, x in enumerate(every) for g in x.sizes]
        for batch in batches:
            raw, off = text_buffer(one_column(batch, column))
            for i, j in slices(off):
                _, _, _, first, h = split_words(raw, off[i : j + 1])
                made = {g: shingles(h, g) for g in {g for _, g, _ in have}}
                for k, g, n in have:
                    at, rank = every[k].all[g].find(made[g])
                    doc_end = first[np.searchsorted(first, at, "right")]
                    n += np.bincount(rank[at + g <= doc_end], minlength=len(n))
        for k, g, n in have:
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(np.full(len(at), g, np.int32)), pa.array(at), pa.array(n[at])],
                names=["block", "g", "token", "n"],
            )

    return run


def find_windows(index: Windows, raw: np.ndarray, offsets: np.ndarray):
    """For each text: number of words, flags of words hit, and the set of items found."""
    low, starts, ends, first, h = split_words(raw, offsets)
    n = len(offsets) - 1
    hit = np.zeros(len(starts) + 1, np.int64)
    found: dict[int, set[int]] = {}
    for g, (tokens, left, many, windows, places) in index.prefix.items():
        at, rank = tokens.find(shingles(h, g))
        reps = many[rank]
        at = np.repeat(at, reps)
        which = np.repeat(left[rank], reps) + (np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps))
        w, begin = windows[which], at - places[which]
        doc = np.searchsorted(first, at, "right") - 1
        size = index.size[w]
        fits = (begin >= first[doc]) & (begin + size <= first[doc + 1])
        for d, b, k, z in zip(doc[fits].tolist(), begin[fits].tolist(), w[fits].tolist(), size[fits].tolist()):
            if all(low[starts[b + i] : ends[b + i]].tobytes() == x for i, x in enumerate(index.words[k])):
                hit[b] += 1
                hit[b + z] -= 1
                found.setdefault(d, set()).update(index.items[k])
    inside = np.concatenate([[0], np.cumsum(np.cumsum(hit)[:-1] > 0)])
    return np.diff(first), inside, first, found, n, np.cumsum(hit)[:-1] > 0


def _search(sent, id_col, column, keyed):
    """Rows of ``match_items`` for a few blocks; with ``keyed`` also a digest of the text, which tells rows of one id apart."""

    def run(batches):
        for batch in batches:
            raw, off = text_buffer(one_column(batch, column))
            for i, j in slices(off):
                hit, items = {}, {}
                for index in sent.value:
                    words, _, first, found, n, flags = find_windows(index, raw, off[i : j + 1])
                    for d, own in found.items():
                        items.setdefault(d, set()).update(index.names[k] for k in own)
                        hit.setdefault(d, set()).update(np.flatnonzero(flags[first[d] : first[d + 1]]).tolist())
                columns = [one_column(batch, id_col).slice(i, j - i), pa.array(words.astype(np.int64)),
                           pa.array([sorted(hit.get(d, ())) for d in range(n)], pa.list_(pa.int64())),
                           pa.array([list(items.get(d, ())) for d in range(n)], pa.list_(pa.string()))]
                if keyed:
                    cuts = off[i : j + 1].tolist()
                    columns.append(pa.array([hashlib.sha256(raw[x:y]).digest() for x, y in zip(cuts, cuts[1:])], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "hit", "items", "key"][: len(columns)])

    return run


def _clean(sent, column):
    """Passes on the rows whose texts hold no window."""

    def run(batches):
        for batch in batches:
            raw, off = text_buffer(one_column(batch, column))
            keep = np.ones(batch.num_rows, bool)
            for i, j in slices(off):
                for index in sent.value:
                    keep[[i + d for d in find_windows(index, raw, off[i : j + 1])[3]]] = False
            yield batch.filter(pa.array(keep))

    return run


def _cuts(text: str | None, limit: int, window: int):
    """The text, or parts of at most ``limit`` words and a window's overlap, which have the same windows together."""
    if len(text or "") // 2 < limit:
        yield text
        return
    starts, n, end = deque(), 0, 0
    for m in _WORD.finditer(text):
        starts.append(m.start())
        n += 1
        end = m.end()
        if len(starts) == limit + window - 1:
            yield text[starts[0] : end]
            for _ in range(limit):
                starts.popleft()
    if n < limit + window - 1 or len(starts) >= window:
        yield text[starts[0] : end] if starts else ""


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int, window: int):
    """Blocks of (name, text) with about ``limit`` words; one empty block for an empty benchmark."""
    block, size, any_yet = [], 0, False
    for name, text in benchmark.select(F.col(item_col).cast("string"), text_col).toLocalIterator():
        for part in _cuts(text, limit, window):
            if size >= limit:
                yield block
                block, size, any_yet = [], 0, True
            block.append((name, part))
            size += len(part or "") // 2 + 1
    if block or not any_yet:
        yield block


def _ready(src: DataFrame, blocks: list[list[tuple[str, str]]], text_col: str, window: int):
    """The broadcast indexes of a few blocks, their prefixes chosen by counts over all documents, taken in one pass."""
    spark = src.sparkSession
    every = [Windows(b, window) for b in blocks]
    sent = spark.sparkContext.broadcast(every)
    counts = [{g: np.zeros(len(x.all[g].values), np.int64) for g in x.sizes} for x in every]
    if any(x.words for x in every):
        seen = src.select(text_col).mapInArrow(_count(sent, text_col), "block int, g int, token long, n long")
        for k, g, token, n in seen.groupBy("block", "g", "token").agg(F.sum("n")).collect():  # at most the blocks' shingles
            counts[k][g][token] = n
    for x, n in zip(every, counts):
        x.rank(n)
    return spark.sparkContext.broadcast(every)


def _chains(blocks):
    """Lists of at most ``CHAIN`` blocks."""
    while some := list(itertools.islice(blocks, CHAIN)):
        yield some


def match_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: id, n_words, hit (places of the words hit, in order), items (ids found, sorted).

    Null and empty texts have no words and hit nothing; items without words match nothing; a window that several
    items hold counts for each of them, and rows of one item id are one item.  An item beyond a block is cut into parts with
    the same windows.  Repeated document rows give repeated results, and rows of one id with other
    texts (or of none) results of their own.  An empty benchmark or an empty documents table is no error.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    src = docs.select(id_col, text_col)
    kind = dict(src.dtypes)[id_col]
    schema = f"{id_col} {kind}, n_words long, hit array<long>, items array<string>"
    chains = _chains(_blocks(benchmark, item_col, item_text, block_words, window))
    first, second = next(chains), next(chains, None)
    if second is None:
        only = src.mapInArrow(_search(_ready(src, first, text_col, window), id_col, text_col, False), schema)
        return only.withColumn("items", F.array_sort("items"))
    store = Durable(spark, "windows")
    search = lambda b: src.mapInArrow(_search(_ready(src, b, text_col, window), id_col, text_col, True), f"{schema}, key binary")
    every = store.write(search(first))
    more = None
    for some in itertools.chain([second], chains):
        part = store.write(search(some).where(F.size("items") > 0).drop("n_words").dropDuplicates([id_col, "key"]))
        more = part if more is None else more.unionByName(part)
    more = more.groupBy(F.col(id_col).alias("__id"), F.col("key").alias("__key")).agg(  # at most a row for each block
        F.flatten(F.collect_list("hit")).alias("__hit"), F.flatten(F.collect_list("items")).alias("__items"))
    whole = lambda own, added: F.array_sort(F.array_distinct(F.concat(own, F.coalesce(added, F.array()))))
    return every.join(more, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")), "left").select(
        id_col, "n_words", whole("hit", "__hit").alias("hit"), whole("items", "__items").alias("items")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without a hit, all columns kept; a row is dropped where it is read, so no text is shuffled.

    ``CHAIN`` blocks of items are a pass over what the passes before it kept.  Rows are judged one by one: null ids, repeated
    rows and rows of one id do not touch each other.  Null and empty texts stay; an empty table gives an empty result, an empty
    benchmark drops nothing.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    store = Durable(spark, "uncontaminated")
    rest = docs
    for n, some in enumerate(_chains(_blocks(benchmark, item_col, item_text, block_words, window))):
        if n:
            rest = store.write(rest)
        rest = rest.mapInArrow(_clean(_ready(docs, some, text_col, window), text_col), docs.schema)
    return rest


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = match_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, len(w) AS n, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i, w FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM bw),
sizes AS (SELECT DISTINCT k FROM win),
dw AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, sizes WHERE len(w) >= k),
hits AS (SELECT doc_id, dw.i, dw.k, item_id FROM (SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM dw) dw JOIN win USING (k, s)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS s FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def brute(text: str | None, items: list[tuple[str, str]]) -> tuple[int, int, list[str], str]:
    """The same by plain search, for tests."""
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    words, hit, found = cut(text), set(), set()
    windows: dict[tuple, set] = {}
    for name, t in items:
        own = cut(t)
        k = min(WINDOW, len(own))
        for i in range(len(own) - k + 1 if own else 0):
            windows.setdefault(tuple(own[i : i + k]), set()).add(str(name))
    for k in {len(w) for w in windows}:
        for j in range(len(words) - k + 1):
            if names := windows.get(tuple(words[j : j + k])):
                hit.update(range(j, j + k))
                found |= names
    names = sorted(found)
    return len(words), len(hit), names, hashlib.sha256(",".join(names).encode()).hexdigest()
