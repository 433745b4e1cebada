"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams per language come from a bounded sample of the training fold; the matrix of log probabilities
(languages x buckets, a fixed size) is broadcast and batches of texts are scored in numpy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, fold, one_column, slices, table, text_buffer
from .labelled import held_out

#: Documents of the training fold that are counted (about; chosen by a hash of the id), n-gram sizes and buckets.
FIT_ROWS, SIZES, BUCKETS = 20_000, (1, 2, 3), 1 << 15
SMOOTH, UNKNOWN = 0.5, "und"
#: Languages at most: the matrix then has 32 MB.  A column with more values holds something else, and is refused.
LANGUAGES = 256

_LOWER = np.arange(0x110000, dtype=np.uint32)
_ALPHA = np.zeros(0x110000, bool)
for _c in range(0x32400):  # no letters beyond
    _s = chr(_c)
    _ALPHA[_c] = _s.isalpha()
    _l = _s.lower()
    _LOWER[_c] = ord(_l) if len(_l) == 1 else _c
_LOWER[~_ALPHA] = 32
_MUL = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def grams(raw: np.ndarray, offsets: np.ndarray):
    """(text, bucket) of every n-gram of letters and word gaps, and which texts have a letter."""
    data, cuts = raw.tobytes(), offsets.tolist()
    parts = [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])]
    point = np.frombuffer(f" {' '.join(parts)} ".encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.array([len(p) + 1 for p in parts])
    owner = np.r_[0, np.repeat(np.arange(len(parts)), size)]
    code = _LOWER[point]
    keep = (code != 32) | np.r_[True, code[:-1] != 32] | np.r_[True, owner[1:] != owner[:-1]]
    code, owner = code[keep], owner[keep]
    lettered = np.bincount(owner[code != 32], minlength=len(parts)) > 0
    out = []
    h = np.zeros(len(code), np.uint32)
    for k in range(max(SIZES)):
        n = len(code) - k
        if n <= 0:
            break
        h = (h[:n] ^ code[k : k + n]) * _MUL[k % 3]
        h ^= h >> np.uint32(15)
        if k + 1 in SIZES:
            good = owner[:n] == owner[k : k + n]
            good &= (code[:n] != 32) | (k > 0)
            out.append((owner[:n][good], ((h[good] * np.uint32(0x27D4EB2F)) >> np.uint32(17)).astype(np.int64) & (BUCKETS - 1)))
    return np.concatenate([o for o, _ in out]), np.concatenate([b for _, b in out]), lettered


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = FIT_ROWS
) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities (buckets x languages), the last row holding the priors.

    Rows without a language or an id are not learned from; without any row there are no languages.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    train = docs.where(F.col(lang_col).isNotNull() & (fold(id_col, 3) != 1)).select(id_col, text_col, lang_col)
    n = {r[0]: r[1] for r in train.groupBy(lang_col).count().limit(LANGUAGES + 1).collect()}
    if len(n) > LANGUAGES:
        raise ValueError(f"{lang_col} has more than {LANGUAGES} values")
    if not n:
        return [], np.zeros((BUCKETS + 1, 0), np.float32)
    names = sorted(n)
    # each language is sampled by itself, so that a rare one is learned too
    share = F.create_map(*[x for k in names for x in (F.lit(k), F.lit(min(1.0, rows / len(names) / n[k])))])
    unit = F.pmod(F.xxhash64(F.lit("fit"), id_col), F.lit(1 << 24)) / F.lit(float(1 << 24))
    picked = train.where(unit < share[F.col(lang_col)]).select(text_col, lang_col)
    rank = {k: i for i, k in enumerate(names)}

    def run(batches):
        total = np.zeros(len(names) * BUCKETS, np.int64)
        for batch in batches:
            raw, off = text_buffer(one_column(batch, text_col))
            lang = np.array([rank[k] for k in one_column(batch, lang_col).to_pylist()], np.int64)
            for i, j in slices(off):
                owner, bucket, _ = grams(raw, off[i : j + 1])
                total += np.bincount(lang[i:j][owner] * BUCKETS + bucket, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

    counts = np.zeros(len(names) * BUCKETS)
    got = picked.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    counts[got["k"].to_numpy()] = got["n"].to_numpy()
    counts = counts.reshape(len(names), BUCKETS) + SMOOTH
    logp = np.log(counts / counts.sum(1, keepdims=True))
    prior = np.log(np.array([n[k] for k in names]) / sum(n.values()))
    return names, np.vstack([logp.T, prior]).astype(np.float32)


def classify(names, matrix, raw, offsets):
    """Language and posterior of each text."""
    owner, bucket, lettered = grams(raw, offsets)
    n, k = len(offsets) - 1, len(names)
    total = np.stack([np.bincount(owner, matrix[bucket, i], n) for i in range(k)], 1) if k else np.zeros((n, 0))
    if not k:
        return [UNKNOWN] * n, np.zeros(n)
    many = np.bincount(owner, minlength=n)
    odds = (total + matrix[-1]) / np.maximum(1.0, np.sqrt(many))[:, None]
    odds -= odds.max(1, keepdims=True)
    p = np.exp(odds)
    p /= p.sum(1, keepdims=True)
    best = (total + matrix[-1]).argmax(1)
    out = [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist())]
    return out, np.where(lettered, p[np.arange(n), best], 0.0)


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row, whole texts; null, empty and letterless texts are ``und`` with score 0.

    The score is the posterior with log odds divided by the root of the number of n-grams, so that scores of long texts stay
    comparable; of equal languages the first by name wins.  Repeated rows are predicted alike, an empty table gives an empty
    result, ids may be null, and other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        names, matrix = sent.value
        for batch in batches:
            raw, off = text_buffer(one_column(batch, text_col))
            for i, j in slices(off):
                lang, p = classify(names, matrix, raw, off[i : j + 1])
                yield pa.RecordBatch.from_arrays(
                    [one_column(batch, id_col).slice(i, j - i), pa.array(lang, pa.string()), pa.array(p, pa.float64())],
                    names=[id_col, "lang_pred", "score"],
                )

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, lang_pred string, score double")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")
