"""Toxicity scores over text restored through a noisy channel.

Disguised words (digits and signs for letters, letters spaced out, letters repeated) become lattices of characters.  A
trigram language model of characters, counted over all documents, and the channel's costs pick the best path (Viterbi over
pairs of letters, of which a lattice has few).  Restored words and their prefixes are the features of a logistic regression, fitted on a bounded sample
of labelled documents.  Tokens without a disguise have a lattice of one path and are kept as they are.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Durable, bounded_batches, one_column, release, slices, table, text_buffer
from .labelled import class_counts, held_out, sample_labels, sparse_logistic, with_labels

#: Labelled documents of each class the model is fitted on, and features it keeps.
FIT_PER_CLASS, FEATURES, BUCKETS = 4000, 4096, 1 << 20
PREFIXES, THRESHOLD = range(3, 8), 0.5
#: Bytes of what a worker remembers of tokens, and the longest token it does so for.
REMEMBERED, LONG = 64 << 20, 64

#: Letters a sign may stand for.
SIGNS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
LETTERS = " abcdefghijklmnopqrstuvwxyzäöüßéèêëàâçîïôûùñíóáúœæ"
_CODE = {c: i for i, c in enumerate(LETTERS)}
_OTHER = len(LETTERS)
A = len(LETTERS) + 1

_CODES = np.zeros(0x250, np.int64)
for _c in range(0x250):
    _l = chr(_c).lower()
    _CODES[_c] = _CODE.get(_l, _OTHER) if _l.isalpha() else 0

_WORD = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"[^\W\d_][0-9@$!|+]+[^\W\d_]|^[0-9@$!|+]+[^\W\d_]{2}|[^\W\d_]{2}[0-9]+$|[^\W\d_]@|@[^\W\d_]|[^\W\d_][*~^][^\W\d_]|([^\W\d_])\1\1")
#: A sign is never a separator, so a run can be read in one way only.
_SPACED = re.compile(r"(?<![^\s])(?:[^\W_]|[@$!|+])(?:[ .\-_*]{1,2}(?:[^\W_]|[@$!|+])){3,}(?![^\s.,;:!?])")
_EDGE = "!?.,;:*#%&\"'()[]{}<>|=~^`-_/\\"


def letter_trigrams(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of three successive letter codes over texts, with 0 between words."""
    counts = np.zeros(A**3, np.int64)
    data = raw.tobytes()
    for i, j in slices(offsets):
        text = "\n\n".join(data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist()))
        point = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        code = _CODES[np.minimum(point, 0x24F)]
        code = np.r_[0, 0, code, 0, 0]
        counts += np.bincount((code[:-2] * A + code[1:-1]) * A + code[2:], minlength=A**3)
    return counts


def language_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities of a letter after two, mixed with those after one and none."""
    n = counts.reshape(A, A, A).astype(float)
    n[:, 0, 0] = 0  # between words
    n[0, 0, 0] = 0
    one = n.sum((0, 1)) + 1
    two = n.sum(0) + 5 * one / one.sum()
    two /= two.sum(1, keepdims=True)
    three = n + 5 * two[None]
    return np.log(three / three.sum(2, keepdims=True))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character the letters it may be ('' for none) and their costs in the channel."""
    out, before, run = [], "", 0
    for c in token:
        run = run + 1 if c == before else 1
        before = c
        if c in SIGNS:
            letters = SIGNS[c]
            out.append([(x, -0.1 - math.log(len(letters))) for x in letters] + [("", -14.0)])
        elif c.isalpha():
            if run == 1:
                out.append([(c, 0.0)])
            else:
                out.append([(c, -0.1 if run == 2 else -4.0), ("", -4.0 if run == 2 else -0.1)])
        else:
            out.append([("", 0.0)])
    return out


def viterbi(token: str, model: np.ndarray) -> str:
    """The likeliest word behind a disguised token; paths are linked lists, so time and memory grow with the token."""
    code = lambda c: _CODE.get(c, _OTHER)
    front: dict[tuple[int, int], tuple] = {(0, 0): (0.0, None)}
    for options in lattice(token):
        after: dict[tuple[int, int], tuple] = {}
        for (a, b), (cost, path) in front.items():
            for letter, channel in options:
                if letter:
                    k = code(letter)
                    state, total, new = (b, k), cost + channel + model[a, b, k], (path, letter)
                else:
                    state, total, new = (a, b), cost + channel, path
                have = after.get(state)
                if have is None or have[0] < total:
                    after[state] = (total, new)
        front = after
    path = max(((cost + model[a, b, 0], path) for (a, b), (cost, path) in front.items()), key=lambda x: x[0])[1]
    out = []
    while path is not None:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


class Restorer:
    """Words behind the tokens of a text, remembered by token."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def words(self, token: str) -> list[str]:
        """Lower-case words of one token without white space."""
        core = token.strip(_EDGE)
        if _DISGUISED.search(core):
            return [viterbi(core, self.model), *_WORD.findall(core)]
        return _WORD.findall(core)

    def spaced(self, text: str) -> list[str]:
        """Words whose letters are spaced out: four or more single signs in a row."""
        return [viterbi(m[0], self.model) for m in _SPACED.finditer(text) if sum(map(str.isalpha, m[0])) >= 2]


def features(words) -> set[int]:
    """Hashes of words and of their prefixes."""
    names = {w for w in words if len(w) > 2}
    names |= {f"{w[:k]}*" for w in names for k in PREFIXES if len(w) > k}
    return {xxhash.xxh32_intdigest(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in names}


class _Known(dict):
    """What was found of short tokens, at most about ``REMEMBERED`` bytes of it; long tokens are not remembered."""

    def __init__(self):
        super().__init__()
        self.room = REMEMBERED

    def keep(self, token: str, have: frozenset) -> None:
        if len(token) > LONG:
            return
        size = 200 + 100 * len(have)  # of a token, its set and the numbers in it
        if size > self.room:
            self.clear()
            self.room = REMEMBERED
        self.room -= size
        self[token] = have


def _of_text(text: str, restorer: Restorer, known: _Known, chosen) -> set[int]:
    """Chosen features of a whole text; the choice for each token is remembered."""
    found: set[int] = set()
    low = text.lower()
    for token in set(low.split()):
        have = known.get(token)
        if have is None:
            have = features(restorer.words(token))
            if chosen is not None:
                have = have & chosen
            have = frozenset(have) or _NONE
            known.keep(token, have)
        if have:
            found |= have
    for word in restorer.spaced(low):
        more = features([word])
        found |= more if chosen is None else more & chosen
    return found


_NONE: frozenset = frozenset()


def _gather(docs: DataFrame, text_col: str) -> np.ndarray:
    """Trigram counts over every document: each task adds up its own, at most A ** 3 numbers."""

    def run(batches):
        release()
        total = np.zeros(A**3, np.int64)
        for batch in batches:
            total += letter_trigrams(*text_buffer(one_column(batch, text_col)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

    counts = np.zeros(A**3, np.int64)
    for k, n in docs.select(text_col).mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n")).collect():
        counts[k] = n
    return counts


class Model:
    def __init__(self, language: np.ndarray, weights: dict[int, float], bias: float, fitted: bool = True):
        self.language, self.weights, self.bias, self.fitted = language, weights, bias, fitted
        self.chosen = frozenset(weights)

    def score(self, active) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + sum(self.weights[f] for f in active)))))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
    per_class: int = FIT_PER_CLASS, keep: int = FEATURES,
) -> Model:
    """The language model over all documents and the regression over the sample.  Without labels every score is 0.5."""
    spark = docs.sparkSession
    bounded_batches(spark)
    language = language_model(_gather(docs, text_col))
    rows = with_labels(docs, sample_labels(labels, label, per_class), id_col, text_col)
    sent = spark.sparkContext.broadcast(language)

    def run(batches):
        release()
        restorer, known = Restorer(sent.value), _Known()
        for batch in batches:
            texts = one_column(batch, "text").to_pylist()
            active = [sorted(_of_text(t, restorer, known, None)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [one_column(batch, "id"), one_column(batch, "y"), pa.array(active, pa.list_(pa.int32()))],
                names=["id", "y", "f"],
            )

    kind = dict(docs.select(id_col).dtypes)[id_col]
    found = rows.mapInArrow(run, f"id {kind}, y int, f array<int>")
    every = Durable(spark, "toxic").write(found.groupBy("id", "y").agg(F.min("f").alias("f")))  # of several rows of one id, one
    n = dict(every.groupBy("y").count().collect())
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        return Model(language, {}, 0.0, fitted=False)
    # chi-squared of each feature with the label, computed where the counts are
    f = every.select("y", F.explode("f").alias("k")).groupBy("k").agg(
        F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b"))
    a, b = F.col("a"), F.col("b")
    chi = (a * (n0 - b) - b * (n1 - a)) ** 2 / ((a + b) * (n0 + n1 - a - b) + 1)
    top = [k for (k,) in f.where("a + b >= 4").orderBy(chi.desc(), "k").limit(keep).select("k").collect()]
    place = {k: i for i, k in enumerate(top)}
    chosen = F.array(*[F.lit(k) for k in top]) if len(top) < 64 else None
    if chosen is None:
        keys = spark.createDataFrame([(k,) for k in top], "k int")
        active = (
            every.select("id", "y", F.explode_outer("f").alias("k")).join(F.broadcast(keys.withColumn("hit", F.lit(1))), "k", "left")
            .groupBy("id", "y").agg(F.collect_list(F.when(F.col("hit") == 1, F.col("k"))).alias("f"))
        )
    else:
        active = every.select("id", "y", F.array_intersect("f", chosen).alias("f"))
    got = active.orderBy("id").select("y", "f").collect()  # at most 2 * per_class rows of at most ``keep`` features
    y = np.array([r.y for r in got], float)
    rows_ = [np.array([place[k] for k in r.f], np.int64) for r in got]
    seen0, seen1 = class_counts(labels, label)
    prior = np.where(y == 1, seen1 / n1, seen0 / n0)
    w = sparse_logistic(rows_, y, len(top), prior / prior.mean(), l2=0.02)
    return Model(language, {k: float(x) for k, x in zip(top, w) if abs(x) > 1e-3}, float(w[-1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row, whole texts; null and empty texts score the bias alone; repeated rows score alike.

    An empty table gives an empty result, ids may be null, and other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        m = sent.value
        restorer, known = Restorer(m.language), _Known()
        for batch in batches:
            texts = one_column(batch, text_col)
            out = [m.score(_of_text(t.as_py() or "", restorer, known, m.chosen)) for t in texts]
            yield pa.RecordBatch.from_arrays([one_column(batch, id_col), pa.array(out, pa.float64())], names=[id_col, "score"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, score double")


def restore(text: str, model: Model) -> str:
    """The text with every disguised token replaced by the word behind it."""
    r = Restorer(model.language)
    text = _SPACED.sub(lambda m: viterbi(m[0].lower(), r.model) if sum(map(str.isalpha, m[0])) >= 2 else m[0], text)
    swap = lambda m: viterbi(c, r.model) if _DISGUISED.search(c := m[0].lower().strip(_EDGE)) else m[0]
    return re.sub(r"\S+", swap, text)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that score below the threshold, scored in the same pass that passes their columns through.

    Where the labelled sample lacks a class (no labels, none toxic, none of these documents), no model can be fitted and
    nothing is known to be toxic: all documents stay.  Null and empty texts are judged by the bias, rows are judged one by one,
    and an empty table gives an empty result.
    """
    model = fit(docs, labels, id_col, text_col)
    if not model.fitted:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        release()
        m = sent.value
        restorer, known = Restorer(m.language), _Known()
        for batch in batches:
            texts = one_column(batch, text_col)
            yield batch.filter(pa.array([m.score(_of_text(t.as_py() or "", restorer, known, m.chosen)) < THRESHOLD for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
