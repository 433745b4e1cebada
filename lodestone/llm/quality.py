"""Quality scores from compression.

Two zstandard dictionaries are trained, on text that is labelled good and on text that is labelled bad.  A text is
compressed in blocks with each of them and with none, in two views: as it is, and as the shapes of its words (case, signs,
repetition).  The differences of the sizes, divided by the size without a dictionary, are turned into a probability by a
logistic calibration that is fitted on labelled texts the dictionaries did not see.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH_ROWS, Durable, bounded_batches, one_column, table
from .labelled import class_counts, held_out, logistic, sample_labels, with_labels

#: Labelled documents of each class that are used; the first half trains dictionaries, the rest the calibration.
FIT_PER_CLASS = 1500
#: Bytes of a dictionary, and blocks of one class and view, drawn by a hash from all blocks of its texts, given to its training.
DICTIONARY, TRAINING = 32 << 10, 2048
#: Texts are compressed in blocks, so that the dictionary stays within reach.
BLOCK, LEVEL = 8 << 10, 1
THRESHOLD = 0.3

_SHAPE = bytes.maketrans(
    bytes(range(256)),
    bytes(
        ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
        for b in range(256)
    ),
)
_RUN = re.compile(rb"a+|A+|0+")
_SAME = re.compile(rb"(?<!\S)(\S+)((?:\s+\1(?!\S))+)")


def shape(data: bytes) -> bytes:
    """Words as runs of letter classes; a word that repeats the one before it becomes '='."""
    data = _SAME.sub(lambda m: m[1] + b" =" * len(m[2].split()), data)
    return _RUN.sub(lambda m: m[0][:1], data.translate(_SHAPE))


def blocks(data: bytes):
    for i in range(0, max(len(data), 1), BLOCK):
        yield data[i : i + BLOCK]


class Compressors:
    """Sizes of a text under no dictionary, the good and the bad one, for both views."""

    def __init__(self, good: tuple[bytes, bytes], bad: tuple[bytes, bytes]):
        make = lambda d: zstd.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False)
        known = [[zstd.ZstdCompressionDict(x) for x in pair] for pair in zip(good, bad)]
        for pair in known:
            for d in pair:
                d.precompute_compress(level=LEVEL)
        self.all = [(zstd.ZstdCompressor(level=LEVEL), make(g), make(b)) for g, b in known]

    def features(self, text: str) -> list[float]:
        """Normalised differences bad - good and the density of each view; zero for an empty text."""
        data = text.encode("utf-8", "surrogatepass")
        out = []
        for view, (plain, good, bad) in zip((data, shape(data)), self.all):
            n = p = g = b = 0
            for x in blocks(view):
                n += len(x)
                p += len(plain.compress(x))
                g += len(good.compress(x))
                b += len(bad.compress(x))
            out += [(b - g) / p, p / n] if n else [0.0, 0.0]
        return out


class Model:
    def __init__(self, good, bad, weights):
        self.good, self.bad, self.weights = good, bad, weights

    def ready(self) -> Compressors:
        return Compressors(self.good, self.bad)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.c_[_wide(x), np.ones(len(x))] @ self.weights, -30, 30)))


def _wide(x: np.ndarray) -> np.ndarray:
    return np.c_[x * 10, (x[:, :1] * x[:, 2:3]) * 50]


def _dictionary(parts: list[bytes]) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    try:
        return zstd.train_dictionary(DICTIONARY, parts, level=LEVEL).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(parts)[-DICTIONARY:] or b" " * 8


def _training(rows: DataFrame, limit: int) -> dict[tuple[int, int], list[bytes]]:
    """Blocks of (id, text, y) for the dictionary of each (class, view): at most ``limit`` of ``BLOCK`` bytes, the first by a hash."""

    def run(batches):
        for batch in batches:
            for text, y in zip(one_column(batch, "text"), one_column(batch, "y").to_pylist()):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for view, own in enumerate((data, shape(data))):
                    parts = [x for x in blocks(own) if x]
                    for i in range(0, len(parts), BATCH_ROWS):
                        some = parts[i : i + BATCH_ROWS]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([y] * len(some), pa.int32()), pa.array([view] * len(some), pa.int32()), pa.array(some, pa.binary())],
                            names=["y", "view", "part"],
                        )

    cut = Durable(rows.sparkSession, "blocks").write(rows.select("text", "y").mapInArrow(run, "y int, view int, part binary"))
    out = {}
    for y in (0, 1):
        for view in (0, 1):
            own = cut.where((F.col("y") == y) & (F.col("view") == view)).select("part")
            out[y, view] = [bytes(r.part) for r in own.orderBy(F.xxhash64(F.lit("part"), "part"), "part").limit(limit).collect()]
    return out


def _features(rows: DataFrame, pairs) -> DataFrame:
    """(id, y, x) of (id, text, y): the features, made where the texts are."""
    sent = rows.sparkSession.sparkContext.broadcast(pairs)

    def run(batches):
        comp = Compressors(*sent.value)
        for batch in batches:
            x = [comp.features(t.as_py()) for t in one_column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [one_column(batch, "id"), one_column(batch, "y"), pa.array(x, pa.list_(pa.float64()))], names=["id", "y", "x"]
            )

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, y int, x array<double>")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
    per_class: int = FIT_PER_CLASS, training: int = TRAINING,
) -> Model | None:
    """None without labels of both classes.

    The sample is bounded in ids (``per_class``) and, for the dictionaries, in blocks (``training``); texts stay on the
    executors, the driver gets blocks and features.  Of several rows of one id, one gives the features of the calibration.
    """
    bounded_batches(docs.sparkSession)
    rows = with_labels(docs, sample_labels(labels, label, per_class), id_col, text_col)
    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)) == 0
    parts = _training(rows.where(half), training)
    if any(not parts[y, 0] for y in (0, 1)):
        parts = _training(rows, training)
    pair = lambda y: tuple(_dictionary(parts[y, view]) for view in (0, 1))
    good, bad = pair(1), pair(0)

    def features(which: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        one = _features(which, (good, bad)).groupBy("id", "y").agg(F.min("x").alias("x")).orderBy("id", "y").collect()  # 2 * per_class rows at most
        return np.array([r.y for r in one], float), np.array([r.x for r in one]).reshape(-1, 4)

    y, x = features(rows.where(~half))
    if len(set(y)) < 2:
        y, x = features(rows)
    if len(set(y)) < 2:
        return None
    n0, n1 = class_counts(labels, label)
    prior = np.where(y == 1, n1 / max(1, (y == 1).sum()), n0 / max(1, (y == 0).sum()))
    return Model(good, bad, logistic(_wide(x), y, prior / prior.mean(), l2=0.01))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row, whole texts.

    Null and empty texts get the score of no evidence; without a model every score is 0.5.  Repeated rows score alike, an empty
    table gives an empty result, ids may be null, and other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        m = sent.value
        comp = m.ready() if m else None
        for batch in batches:
            texts = one_column(batch, text_col)
            out = m.score(np.array([comp.features(t.as_py() or "") for t in texts])) if m and len(texts) else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([one_column(batch, id_col), pa.array(out, pa.float64())], names=[id_col, "score"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, score double")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
