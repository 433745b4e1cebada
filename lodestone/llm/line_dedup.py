"""Line deduplication: a sharded minimal perfect hash over the hashes of common lines, which documents probe.

Tasks hash the lines they read and hand on a count and the largest document for each hash.  The hashes of lines in enough
documents are dealt to shards; each shard gets a minimal perfect hash (levels of bit arrays, in which a hash has a place of its
own) and, at the place it gives, a fingerprint, the count and the document that keeps the line.  The arrays of all shards are put
together and sent to the tasks, in which each line of a document is looked up; no line is joined.

The arrays are sent only up to ``INDEX_LINES`` lines, those in the most documents.  Lines beyond that, which are in few documents
each, are dealt by shard and probe the arrays of that shard alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Durable, bounded_batches, free_name, held, one_column, slices, table, text_buffer
from .words import U, mix

#: Code points of a line, and the documents that have it, from which on it is dropped.
MIN_CHARS, MIN_DOCS = 40, 5
#: Lines of the index that is sent to all tasks (about 19 bytes each), and of a shard, on average.
INDEX_LINES, SHARD_LINES = 2_000_000, 1 << 14
#: A task hands on its counts when it holds so many lines; rows that one task probes with beyond the index, on average.
HELD_LINES, PROBE_ROWS = 200_000, 1 << 20

_SPACE = b" \t\n\x0b\x0c\r"
#: Stands for a null id, which is smaller than any other.
_NULL_ID = -(1 << 63)
_LEVELS = 48
#: Counts in the index end there; no more is asked of them.
COUNT_MAX = (1 << 16) - 1


# --- lines ---


def _key(line: bytes, least: int) -> bytes | None:
    """128 bits for a line of at least so many code points; its ends and the case of A-Z do not matter."""
    line = line.strip(_SPACE)
    if len(line) < least or len(line) < 4 * least and len(line.decode()) < least:
        return None
    return xxhash.xxh3_128_digest(line.lower())


def _pairs(keys) -> tuple[np.ndarray, np.ndarray]:
    """Hash and fingerprint of each key."""
    both = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)


def _count_lines(least: int):
    schema = pa.schema([("h", pa.int64()), ("fp", pa.int64()), ("n", pa.int64()), ("keeper", pa.int64())])

    def given(seen):
        if seen:
            columns = [*_pairs(seen), *np.array(list(seen.values()), np.int64).T]
            for i in range(0, len(seen), 1 << 16):
                yield pa.record_batch([pa.array(np.ascontiguousarray(x[i : i + (1 << 16)])) for x in columns], schema=schema)

    def run(batches):
        seen: dict[bytes, tuple[int, int]] = {}
        for batch in batches:
            raw, at = text_buffer(one_column(batch, "text"))
            for i, doc in enumerate(_ids(one_column(batch, "id")).tolist()):
                for key in {_key(line, least) for line in raw[at[i] : at[i + 1]].tobytes().split(b"\n")} - {None}:
                    n, keeper = seen.get(key, (0, _NULL_ID))
                    seen[key] = (n + 1, max(keeper, doc))
                if len(seen) > HELD_LINES:
                    yield from given(seen)
                    seen = {}
        yield from given(seen)

    return run


# --- the minimal perfect hash ---


def _level(h: np.ndarray, level: int) -> np.ndarray:
    return mix(h + U((level * 0x9E3779B97F4A7C15) & (1 << 64) - 1))


def build(h: np.ndarray) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """Sizes and bits of the levels over distinct hashes, and the place of each, 0 to n - 1.

    A level has as many bits as there are hashes left; a hash that is alone at its bit is placed there, the others go on.  The
    place is the number of bits set before it.  Hashes that no level parts (none, in practice) raise an error.
    """
    left, sizes, bits, place, before = np.arange(len(h)), [], [], np.zeros(len(h), np.int64), 0
    while len(left):
        if len(sizes) == _LEVELS:
            raise ValueError("lines that no level of the hash parts")
        size = len(left) + len(left) // 4 + 1
        at = (_level(h[left], len(sizes)) % U(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        place[left[own]] = before + np.cumsum(alone)[at[own]] - 1
        before += int(own.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~own]
    return sizes, bits, place


class Index:
    """The arrays of many shards as one."""

    STEP = 64

    def __init__(self, shards: int, rows: list[dict]):
        self.shards = shards
        self.first = np.zeros(shards + 1, np.int64)  # of each shard's places
        sizes = np.zeros((_LEVELS, shards), np.int64)
        for r in rows:
            self.first[r["shard"] + 1] = r["lines"]
            sizes[: len(r["sizes"]), r["shard"]] = r["sizes"]
        self.first = np.cumsum(self.first)
        self.sizes, self.starts = sizes, np.zeros_like(sizes)  # where a level of a shard begins among all bits
        bits, rank, total = [], [], 0
        for r in rows:
            n = len(r["sizes"])
            self.starts[:n, r["shard"]] = total + np.concatenate([[0], np.cumsum(r["sizes"])[:-1]]) if n else 0
            one = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=sum(r["sizes"]))
            bits.append(one.view(bool))
            rank.append(self.first[r["shard"]] + np.cumsum(one, dtype=np.int64)[:: self.STEP] - one[:: self.STEP])
            pad = -len(one) % self.STEP
            if pad:
                bits.append(np.zeros(pad, bool))
            total += len(one) + pad
        self.bits = np.packbits(np.concatenate([*bits, np.zeros(self.STEP, bool)]))
        self.rank = np.concatenate([*rank, np.zeros(1, np.int64)])  # places before each run of STEP bits
        order = sorted(rows, key=lambda r: r["shard"])
        whole = lambda k, kind: np.frombuffer(b"".join(r[k] for r in order), kind)
        self.fp, self.n, self.keeper = whole("fp", np.int64), whole("n", np.uint16), whole("keepers", np.int64)

    def find(self, h: np.ndarray, fp: np.ndarray) -> np.ndarray:
        """The places of hashes; -1 for those that are not in the index, which their fingerprint tells."""
        found = np.full(len(h), -1, np.int64)
        shard = shard_of(h, self.shards)
        todo, hash_ = np.arange(len(h)), h.view(U)
        for level in range(_LEVELS):
            size = self.sizes[level, shard[todo]]
            todo = todo[size > 0]
            if not len(todo):
                break
            size = size[size > 0]
            at = self.starts[level, shard[todo]] + (_level(hash_[todo], level) % size.astype(U)).astype(np.int64)
            hit = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
            # set bits of the run before this one, from its eight bytes
            w, at_hit = at[hit] >> 6, at[hit]
            run = np.lib.stride_tricks.sliding_window_view(self.bits, 8)[w << 3]
            before = (np.unpackbits(run, axis=1) & (np.arange(64) < (at_hit & 63)[:, None])).sum(1)
            found[todo[hit]] = self.rank[w] + before
            todo = todo[~hit]
        good = found >= 0
        good[good] = self.fp[found[good]] == fp[good]
        found[~good] = -1
        return found

    def common(self, h: np.ndarray, fp: np.ndarray, ids: np.ndarray, min_docs: int) -> np.ndarray:
        """Which lines of the documents ``ids`` are in enough documents, of which this one is not the one that keeps them."""
        place, out = self.find(h, fp), np.zeros(len(h), bool)
        hit = place >= 0
        out[hit] = (self.n[place[hit]] >= min(min_docs, COUNT_MAX)) & (self.keeper[place[hit]] != ids[hit])
        return out


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h.view(U) >> U(33)) % U(shards)).astype(np.int64)


_INDEX = "shard long, lines long, sizes array<long>, bits binary, fp binary, n binary, keepers binary"


def _build_shard(part: pa.Table) -> pa.Table:
    h, fp, n, keeper, shard = (part.column(c).to_numpy() for c in ("h", "fp", "n", "keeper", "shard"))
    sizes, bits, place = build(h.view(U))
    order = np.argsort(place)
    blob = [x[order].tobytes() for x in (fp, np.minimum(n, COUNT_MAX).astype(np.uint16), keeper)]
    packed = np.packbits(np.concatenate(bits)).tobytes()
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
    values = [int(shard[0]), len(h), sizes, packed, *blob]
    return pa.table({c.split()[0]: pa.array([v], k) for c, v, k in zip(_INDEX.split(", "), values, kinds)})


def _shards(lines: DataFrame, shards: int) -> DataFrame:
    """One row of arrays for each shard; hashes spread evenly, so a shard has about SHARD_LINES of them."""
    return lines.withColumn("shard", F.shiftrightunsigned("h", 33) % shards).groupBy("shard").applyInArrow(_build_shard, _INDEX)


# --- probing ---


def _probe_texts(get, id_col: str, text_col: str, rare_col: str | None, least: int, min_docs: int, report: tuple[str, str]):
    """Rows with lines dropped, and two more columns: lines before, lines dropped.  ``rare_col`` names positions that go as well."""

    def run(batches):
        index = get()
        for batch in batches:
            raw, at = text_buffer(one_column(batch, text_col))
            ids = _ids(one_column(batch, id_col))
            rare = one_column(batch, rare_col).to_pylist() if rare_col else [None] * len(ids)
            kept = [c for c in batch.schema.names if c != rare_col]
            schema = pa.schema([*(batch.schema.field(c) for c in kept), *(pa.field(c, pa.int64()) for c in report)])
            for i, j in slices(at):
                texts, total, gone, first = [], [], [], 0
                split = [raw[at[k] : at[k + 1]].tobytes().split(b"\n") for k in range(i, j)]
                keys = [[(p, key) for p, line in enumerate(lines) if (key := _key(line, least))] for lines in split]
                h, fp = _pairs(key for ks in keys for _, key in ks)
                drop = index.common(h, fp, np.repeat(ids[i:j], [len(ks) for ks in keys]), min_docs)
                for lines, ks, more in zip(split, keys, rare[i:j]):
                    bad = {p for (p, _), d in zip(ks, drop[first : first + len(ks)]) if d} | set(more or ())
                    first += len(ks)
                    texts.append(b"\n".join(x for p, x in enumerate(lines) if p not in bad) if bad else None)
                    total.append(len(lines))
                    gone.append(len(bad))
                old = batch.slice(i, j - i).select(kept)
                new = pa.array(texts, pa.binary()).cast(schema.field(text_col).type)
                columns = [pc.coalesce(new, c) if name == text_col else c for name, c in zip(kept, old.columns)]
                yield pa.record_batch([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], schema=schema)

    return run


_LINES = "mark string, id long, pos int, h long, fp long"


def _lines_of(least: int):
    """(mark, id, pos, h, fp) of each line that is long enough."""

    def run(batches):
        for batch in batches:
            raw, at = text_buffer(one_column(batch, "text"))
            marks, ids = one_column(batch, "mark").to_pylist(), _ids(one_column(batch, "id"))
            for i, j in slices(at):
                rows = [(k, p, key) for k in range(i, j) for p, line in enumerate(raw[at[k] : at[k + 1]].tobytes().split(b"\n")) if (key := _key(line, least))]
                h, fp = _pairs(key for _, _, key in rows)
                yield pa.record_batch(
                    [pa.array([marks[k] for k, _, _ in rows], pa.string()), pa.array([ids[k] for k, _, _ in rows], pa.int64()), pa.array([p for _, p, _ in rows], pa.int32()), pa.array(h), pa.array(fp)],
                    names=["mark", "id", "pos", "h", "fp"])

    return run


def _probe_shard(min_docs: int):
    def run(lines: pa.Table, arrays: pa.Table) -> pa.Table:
        index = Index(1, [r | {"shard": 0} for r in arrays.to_pylist()])
        ids, h, fp = (lines.column(c).to_numpy() for c in ("id", "h", "fp"))
        return lines.filter(pa.array(index.common(h, fp, ids, min_docs))).select(["mark", "pos"])

    return run


def _with_rare(df: DataFrame, id_col: str, text_col: str, rare_col: str, arrays: DataFrame, shards: int, min_chars: int, min_docs: int, store: Durable) -> DataFrame:
    """Adds the positions of lines to drop by arrays that are not sent: lines are dealt to their shard's.

    A shard has a bounded number of arrays' rows, and its lines are dealt over as many tasks as keeps each to about PROBE_ROWS.
    Rows are known by id and text: those alike in both lose the same lines.
    """
    mark = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    own = df.select(mark.alias("mark"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    lines = store.write(own.mapInArrow(_lines_of(min_chars), _LINES).withColumn("shard", F.shiftrightunsigned("h", 33) % shards))
    parts = 1 + lines.count() // (shards * PROBE_ROWS)
    dealt = lines.withColumn("part", F.pmod(F.xxhash64("mark"), F.lit(parts)))
    arrays = arrays.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")))
    found = dealt.groupBy("shard", "part").cogroup(arrays.groupBy("shard", "part")).applyInArrow(_probe_shard(min_docs), "mark string, pos int")
    key = free_name(df, "mark")
    gone = found.groupBy(F.col("mark").alias(key)).agg(F.collect_set("pos").alias(rare_col))
    return df.join(gone, mark == F.col(key), "left").drop(key)


def _loader(spark: SparkSession, shards: int, arrays: DataFrame, name: str):
    """What gives the index in a task; the arrays were found to be few before they come this way."""
    sent = spark.sparkContext.broadcast([r.asDict() for r in arrays.collect()])
    return lambda: held(name, lambda: Index(shards, sent.value))


def _threshold(lines: DataFrame, limit: int) -> int:
    """The least power of two that no more than ``limit`` lines' counts reach; 0 if all lines fit."""
    sizes = sorted(lines.groupBy(F.floor(F.log2("n")).cast("int").alias("e")).count().collect(), reverse=True)  # 63 rows at most
    total = 0
    for e, n in sizes:
        total += n
        if total > limit:
            return 1 << (e + 1)
    return 0


def drop_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    index_lines: int = INDEX_LINES, report: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """All rows and columns with common lines dropped from the text, and the lines before and dropped (``report``).

    A line of at least ``min_chars`` code points that at least ``min_docs`` rows have is dropped but in the rows with the largest
    id of those (repeated rows of that id keep it alike, a null id is smaller than any other).  Lines are equal if they are so
    without white space at their ends and with A-Z lower-cased.  A null text is one empty line and stays null, as does any text
    that loses nothing; a text that loses all its lines is empty.  Texts are read whole, in slices; an empty table
    stays empty; columns may have any names; those of ``report`` are replaced.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    store = Durable(spark, "lines")
    seen = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_count_lines(min_chars), "h long, fp long, n long, keeper long")
    lines = store.write(seen.groupBy("h", "fp").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper")).where(F.col("n") >= min_docs))
    total = lines.count()
    shards = max(1, total // SHARD_LINES)
    least = _threshold(lines, index_lines)
    arrays = store.write(_shards(lines.where(F.col("n") >= least), shards))
    df, rare = df.drop(*report), None
    out = T.StructType([*df.schema.fields, *(T.StructField(c, T.LongType()) for c in report)])
    if least:
        rare, rest = free_name(df, "rare"), store.write(_shards(lines.where(F.col("n") < least), shards))
        df = _with_rare(df, id_col, text_col, rare, rest, shards, min_chars, min_docs, store)
    return df.mapInArrow(_probe_texts(_loader(spark, shards, arrays, store.root), id_col, text_col, rare, min_chars, min_docs, report), out)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT r) >= 5),
m AS (SELECT r, k.doc_id, pos, line, coalesce(k.doc_id <> keeper, false) AS dropped FROM k LEFT JOIN c USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY r
"""
