"""Best-fit packing of token sequences by a configuration linear program.

Documents are tokenized once.  What the driver works on is the histogram of piece lengths (at most ``CAPACITY`` numbers,
whatever the size of the corpus).  A configuration is a multiset of lengths that fits one sequence.  The program "fewest
configurations that cover the histogram" is solved approximately by multiplicative weights: in each round every length has a
share of its pieces to be covered, a knapsack dynamic program prices the configurations by the weights, the best of them are taken
in fractional amounts, and the weights of lengths that lag behind are raised.  Each pricing also gives a dual bound on the
number of sequences.  The fractional amounts are rounded, first down, then up as long as pieces are left; what remains is solved
and rounded again, and the last remainder is packed by best fit with the largest remaining length in it.  Pieces are matched to
the places of their length by a two-level rank: one within the task that cut them, and one of the tasks.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Durable, bounded_batches, held, one_column, table

CAPACITY, EOS, VOCABULARY = 4096, 1, "word_bpe_49k.json"
#: Programs solved one after the other on what rounding leaves, rounds of weights in each, and pricings in each round.
PHASES, ROUNDS, PASSES = 5, 3, 8
#: First weights are sizes to this power, as large pieces are hard to place; the learning rate; the share of the
#: best value that a configuration may lack.
LEAN, RATE, SLACK = 1.15, 0.3, 1 / 512
#: Words whose ids a worker remembers, about 200 bytes each, in two halves: when one is full, the older one is forgotten.
#: Words of more characters than LONG are not remembered.
REMEMBERED, LONG = 700_000, 64
#: Texts within these blocks of characters are lower-cased here, as the vocabulary's own rule does it.
_TAIL = ",.!?;:*#$%&"
_PLAIN = re.compile("[^\x00-\u012f\u0131-\u024f]")


class Tokens:
    """Token ids of whole texts as little-endian 32-bit bytes.

    No token spans a space or a line feed and no rule of the vocabulary looks across one, so words between them are
    encoded once and remembered.  Texts that hold the text of a special token are encoded whole.
    """

    def __init__(self, path: str, eos: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = np.array([eos], "<u4").tobytes()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        split, new = [], set()
        for t in texts:
            if any(s in t for s in self.special):
                words = [t]
            else:
                words = (t if _PLAIN.search(t) else t.lower()).replace("\n", " ").split(" ")
            split.append(words)
            new.update(words)
        if len(self.known) + 2 * len(new) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing, tailed = set(), []
        for w in new:
            if w not in known:
                if (have := older.get(w)) is not None:
                    known[w] = have
                    continue
                core = w.rstrip(_TAIL)
                if core is not w and core != w and core.isalpha():  # letters and signs are never in one token
                    tailed.append((w, core, w[len(core) :]))
                    missing.update(x for x in tailed[-1][1:] if x not in known)
                else:
                    missing.add(w)
        missing = list(missing)
        known.update(zip(missing, self._ids(missing)))
        for w, core, tail in tailed:
            known[w] = known[core] + known[tail]
        out = [b"".join(map(known.__getitem__, words)) + self.end for words in split]
        for w in {x for x in missing if len(x) > LONG} | {w for w, _, _ in tailed if len(w) > LONG}:
            del known[w]
        return out


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pieces(
    docs: DataFrame, id_col: str, text_col: str, path: str | None, capacity: int = CAPACITY, eos: int = EOS
) -> DataFrame:
    """(id, piece, start, length, crc, part, nth): documents with their end id, cut where they are longer than the capacity.

    ``part`` numbers the task, ``nth`` the piece among those of its length in the task, from 0.
    """
    bounded_batches(docs.sparkSession)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        vocabulary = path or default_vocabulary(), eos
        tokens, task = held(vocabulary, lambda: Tokens(*vocabulary)), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            ids, texts = one_column(batch, id_col), one_column(batch, text_col).to_pylist()
            for i in range(0, len(texts), 64):
                row, piece, length, crc, nth = [], [], [], [], []
                for k, data in enumerate(tokens.encode([t or "" for t in texts[i : i + 64]])):
                    for p, a in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[a : a + 4 * capacity]
                        row.append(i + k)
                        piece.append(p)
                        n = len(part) // 4
                        length.append(n)
                        nth.append(seen[n])
                        seen[n] += 1
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(np.array(piece, np.int64) * capacity),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(row), task, np.int32)), pa.array(nth, pa.int64())],
                    names=["id", "piece", "start", "length", "crc", "part", "nth"],
                )

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, piece int, start long, length long, crc long, part int, nth long")


# --- the plan, on the driver, over the histogram ---


@dataclass
class Plan:
    """Places by length: rows (length, first rank, pieces of that length in a sequence, first sequence, offset).

    ``bound`` is a number of sequences that no packing can do without, from the dual of the program.
    """

    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    bound: int = 0
    used: dict[int, int] = field(default_factory=dict)

    def add(self, config: dict[int, int], times: int) -> None:
        offset = 0
        for length, many in sorted(config.items(), reverse=True):
            rank = self.used.get(length, 0)
            self.rows.append((length, rank, many, self.sequences, offset))
            self.used[length] = rank + many * times
            offset += many * length
        self.sequences += times


def knapsack(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each capacity with any number of each length, and the length taken last (-1: none)."""
    worth = np.full(capacity + 1, -np.inf)
    worth[lengths] = value
    best, last, least = np.zeros(capacity + 1), np.full(capacity + 1, -1), int(lengths.min())
    for c in range(least, capacity + 1):
        every = best[c - least :: -1] + worth[least : c + 1]  # with the length ``least`` + k taken last
        k = int(every.argmax())
        if every[k] > best[c - 1]:
            best[c], last[c] = every[k], k + least
        else:
            best[c] = best[c - 1]
    return best, last


def _walk(last: list[int], first: int, capacity: int) -> dict[int, int]:
    """The best configuration with a piece of length ``first`` in it."""
    config, c = {first: 1}, capacity - first
    while c > 0:
        k = last[c]
        if k < 0:
            c -= 1
        else:
            config[k] = config.get(k, 0) + 1
            c -= k
    return config


def covering(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS, passes: int = PASSES) -> tuple[dict[tuple, float], float]:
    """A fractional solution {configuration: amount} that covers no length beyond its pieces, and a dual bound of the program.

    Prices y are a solution of the dual once they are divided by the value of the best configuration, so the histogram's
    value under them is a bound, in each round anew.
    """
    lengths = np.array(sorted(histogram), np.int64)
    many = np.zeros(capacity + 1)
    many[lengths] = [histogram[int(k)] for k in lengths]
    size = np.arange(capacity + 1) / capacity
    weight = size ** (LEAN - 1)
    bound = float(many @ size)  # the prices that are the sizes: their best configuration has the value 1 at most
    amounts: dict[tuple, float] = {}
    for _ in range(rounds):
        room = many / rounds
        for turn in range(passes):
            live = lengths[room[lengths] > 1e-6 * many[lengths]]
            if not len(live):
                break
            price = size[live] * weight[live]
            best, last = knapsack(live, price, capacity)
            if not turn:
                bound = max(bound, float(many[live] @ price) / best[capacity])
            value, worth = dict(zip(live.tolist(), (price + best[capacity - live]).tolist())), best[capacity] * (1 - SLACK)
            taken, path, found = set(), last.tolist(), False
            for k in live[::-1].tolist():  # one pricing gives the best configuration with each length
                if k in taken:
                    continue
                config = _walk(path, k, capacity)
                if value[k] < worth or not taken.isdisjoint(config):
                    continue
                taken.update(config)
                step = min(room[a] / m for a, m in config.items())
                key = tuple(sorted(config.items(), reverse=True))
                amounts[key] = amounts.get(key, 0.0) + step
                for a, m in config.items():
                    room[a] -= m * step
                found = True
            if not found:
                break
        lag = room[lengths] / many[lengths] * rounds
        weight[lengths] *= np.exp(RATE * (lag - lag.mean()))
    return amounts, bound


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, phases: int = PHASES) -> Plan:
    """Configurations for a histogram {length: pieces}; work depends on the capacity, not on the number of pieces."""
    plan = Plan()
    left = {k: n for k, n in histogram.items() if n}
    if full := left.pop(capacity, 0):
        plan.add({capacity: 1}, full)
    plan.bound = full
    for phase in range(phases):
        left = {k: n for k, n in left.items() if n}
        if not left:
            break
        amounts, bound = covering(left, capacity, rounds)
        if not phase:
            plan.bound += math.ceil(bound - 1e-6)
        order = sorted(amounts.items(), key=lambda x: (-x[1], x[0]))
        for up in (False, True):
            for key, amount in order:
                fit = min(left[k] // m for k, m in key)
                if times := min(fit, 1 if up else int(amount + 1e-9)):
                    for k, m in key:
                        left[k] -= m * times
                    plan.add(dict(key), times)
    lengths = np.array(sorted(left), np.int64)
    _finish(plan, lengths, np.array([left[int(k)] for k in lengths], np.int64), capacity)
    return plan


def _finish(plan: Plan, lengths: np.ndarray, left: np.ndarray, capacity: int) -> None:
    """Packs what rounding leaves: the largest remaining length, filled up best; each step uses up a length."""
    left = left.copy()
    while left.any():
        room, config = capacity, {}
        k = int(np.flatnonzero(left)[-1])
        while k >= 0:
            config[k] = config.get(k, 0) + 1
            room -= int(lengths[k])
            k = _next(lengths, left, config, room)
        times = min(int(left[k]) // m for k, m in config.items())
        for k, m in config.items():
            left[k] -= m * times
        plan.add({int(lengths[k]): m for k, m in config.items()}, times)


def _next(lengths: np.ndarray, left: np.ndarray, config: dict[int, int], room: int) -> int:
    """The length to put in next: one, or the larger of two, that fills the room best; -1 if none fits."""
    rest = left.copy()
    for k, m in config.items():
        rest[k] -= m
    live = np.flatnonzero(rest[: np.searchsorted(lengths, room, "right")])
    if not len(live):
        return -1
    size = lengths[live]
    partner = np.searchsorted(size, room - size, "right") - 1
    same = (partner == np.arange(len(live))) & (rest[live] < 2)
    partner = np.where(same, partner - 1, partner)
    fill = size + np.where(partner >= 0, size[np.maximum(partner, 0)], 0)
    k = int(np.flatnonzero(fill == fill.max())[-1])
    return int(live[max(k, int(partner[k]))])


def place(found: DataFrame, plan: Plan) -> DataFrame:
    """Adds sequence_id and offset: a piece's rank within its length picks its place in the plan.

    The plan has at most some entries for each of ``CAPACITY`` lengths and round, so its broadcast is bounded.
    """
    spark = found.sparkSession
    rows = np.array(plan.rows, np.int64).reshape(-1, 5)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    sent = spark.sparkContext.broadcast(rows)
    names = found.columns

    def run(batches):
        r = sent.value
        key = r[:, 0] << 44 | r[:, 1]  # a rank is below 2 ** 44
        for batch in batches:
            length, rank = (one_column(batch, c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            nth = rank - r[at, 1]
            sequence, offset = r[at, 3] + nth // r[at, 2], r[at, 4] + nth % r[at, 2] * length
            yield pa.RecordBatch.from_arrays(
                [one_column(batch, c) for c in names if c != "rank"] + [pa.array(sequence), pa.array(offset)],
                names=[c for c in names if c != "rank"] + ["sequence_id", "offset"],
            )

    schema = ", ".join(f"{c} {t}" for c, t in found.dtypes if c != "rank")
    return found.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
    capacity: int = CAPACITY, eos: int = EOS,
) -> DataFrame:
    """One row per piece: id, piece, start, length, crc, sequence_id, offset.

    A null or empty text is its end id alone.  Repeated rows are packed each on its own, and very long texts are cut.  The rank
    of a piece within its length is its place in its task after the pieces of the tasks before; the table of counts by length
    and task is joined, not collected.  An empty table gives an empty result; other columns are not read.
    """
    cut = Durable(docs.sparkSession, "pieces").write(pieces(docs, id_col, text_col, path, capacity, eos))
    histogram = dict(cut.groupBy("length").count().collect())  # at most CAPACITY rows
    before = F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    base = cut.groupBy("length", "part").agg(F.count("*").alias("n")).select("length", "part", F.coalesce(before, F.lit(0)).alias("base"))
    ranked = cut.join(base.hint("shuffle_hash"), ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    return place(ranked.select("id", "piece", "start", "length", "crc", "rank"), plan_packing(histogram, capacity))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).withColumnsRenamed({"id": "doc_id", "crc": "ids_crc32"})
