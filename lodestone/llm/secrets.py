"""Secret scans (DataFrame functions only): fixed patterns, and a battery of randomness tests.

Runs of token characters get an encoding (the smallest alphabet that holds them), its signs in order of their frequency in
written language.  Three tests of randomness look at a run: chi-squared of the symbols' counts, runs above and below the
middle of the alphabet, and correlation of neighbours.  Written language uses few signs often, and those of the first half, so
each statistic has a known mean and spread for language; how far it lies from there towards randomness is the test's
p-value.  Fisher's combination of the three, scaled for their dependence (Brown), is the run's p-value, and within each class
of lengths Benjamini-Hochberg at ``FDR`` picks what counts as random, over the whole corpus.  A picked run must also fit
uniformity: none of the three may lie ``REJECT`` deviates from it.  Counts by class and step of the p-value are all that is
gathered.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Durable, bind, table

MIN_RUN, FDR, REJECT = 16, 0.01, 4.5
#: Three tests that lean on the same signs: their summed logarithms count as two independent ones, stretched by this.
SCALE = 1.5
#: Steps of the negative log p-value, per unit, and the last step.
STEPS, LAST = 4, 800
#: Lengths are added up in blocks of so many, and blocks of blocks, so that places take time in proportion to the matches.
RADIX = 64

_either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
_NAMES = "|".join([_either("password"), _either("passwd"), _either("secret"), _either("token"), f"{_either('api')}_?{_either('key')}"])
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: As maximal runs, these two equal "leftmost runs, short ones dropped".
ACCESS, HEX = "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}"
RUN = f"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"
KINDS = ("assign", "access", "hex", "random")

_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings by the pattern a run matches, first match wins, with the alphabet.
ENCODINGS = (
    ("digits", "^[0-9]+$", _DIGIT), ("hex", "^[0-9a-f]+$", _DIGIT + "abcdef"), ("hexu", "^[0-9A-F]+$", _DIGIT + "ABCDEF"),
    ("lower", "^[A-Z]?[a-z]+$", _LOWER), ("upper", "^[A-Z]+$", _UPPER), ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", _DIGIT + _LOWER), ("base36u", "^[A-Z0-9]+$", _DIGIT + _UPPER),
    ("alnum", "^[A-Za-z0-9]+$", _DIGIT + _UPPER + _LOWER), ("base64", ".*", _DIGIT + _UPPER + _LOWER + "+/_-="),
)
#: Shares of letters in written language, a to z, in thousandths; other signs inside words are rare.
LETTERS = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
RARE = {"other case": 0.001, "digit": 0.003, "sign": 0.004}


def _language(c: str, cased: bool) -> float:
    """Share of a sign in words; ``cased``: upper-case letters are unusual there."""
    if c.isdigit():
        return RARE["digit"]
    if not c.isalpha():
        return RARE["sign"]
    return RARE["other case"] if cased and c.isupper() else LETTERS[ord(c.lower()) - 97] / 1020


@dataclass(frozen=True)
class Alphabet:
    """An encoding's signs, the most frequent in language first, and the moments of a sign drawn from language.

    ``high`` is the share of the second half of the signs, ``mean`` and ``var`` are of the place less the middle place.
    """

    signs: str
    size: int
    square: float
    cube: float
    high: float
    mean: float
    var: float


def _alphabet(name: str, signs: str) -> Alphabet:
    share = {c: _language(c, name in ("alnum", "base64")) for c in signs}
    total = math.fsum(share.values())
    order = sorted(signs, key=lambda c: (-share[c], c))
    q, k = [share[c] / total for c in order], len(order)
    at = [i + 1 - (k + 1) / 2 for i in range(k)]
    mean = math.fsum(x * p for x, p in zip(at, q))
    return Alphabet(
        "".join(order), k, math.fsum(p * p for p in q), math.fsum(p**3 for p in q), math.fsum(p for i, p in enumerate(q) if i + 1 > k / 2),
        mean, math.fsum(x * x * p for x, p in zip(at, q)) - mean * mean,
    )


ALPHABETS = tuple(_alphabet(name, signs) for name, _, signs in ENCODINGS)


def _total(a: Column, first: Column, many: Column) -> Column:
    return F.aggregate(F.slice(a, first, many), F.lit(0), lambda s, x: s + x)


def _before(sizes: Column, body) -> Column:
    """``body(at)`` where ``at(i)`` is the sum of the first i of an array of integers, by sums of blocks and of blocks of blocks."""

    def blocks(a):
        many = F.ceil(F.size(a) / RADIX).cast("int")
        return F.when(many > 0, F.transform(F.sequence(F.lit(0), many - 1), lambda b: _total(a, b * RADIX + 1, F.lit(RADIX)))).otherwise(F.array().cast("array<int>"))

    def sums(a, b, c):
        def at(i):
            i = i.cast("int")
            one, two = F.floor(i / RADIX).cast("int"), F.floor(i / (RADIX * RADIX)).cast("int")
            return _total(c, F.lit(1), two) + _total(b, two * RADIX + 1, one - two * RADIX) + _total(a, one * RADIX + 1, i - one * RADIX)

        return body(at)

    return bind(sizes, lambda a: bind(blocks(a), lambda b: bind(blocks(b), lambda c: sums(a, b, c))))


def spans(text: Column, pattern: str, good=None, group: int = 0) -> Column:
    """(start, end) in code points of the leftmost matches that do not overlap.

    What lies between matches and the matches themselves give the places; ``good`` drops matches by their text in ``group``.
    Each array is made once, so time grows with the text, however many matches it has.
    """
    p = F.lit(pattern)
    none = F.array().cast("array<struct<s:int,e:int,t:string>>")

    def all_of(found):
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
        part = F.regexp_extract_all(text, p, F.lit(group)) if group else found
        both = F.struct(F.transform(found, lambda m: F.length(m)).alias("size"), gaps.alias("gap"), part.alias("part"))

        def place(x):
            steps = F.transform(x["size"], lambda n, i: n + F.get(x["gap"], i))

            def one(at):
                def struct(n, i):
                    start = at(i) + F.get(x["gap"], i)
                    return F.struct(start.alias("s"), (start + n).alias("e"), F.get(x["part"], i).alias("t"))

                every = F.transform(x["size"], struct)
                return F.filter(every, lambda y: good(y["t"])) if good else every

            return _before(steps, one)

        return F.when(F.size(found) > 0, bind(both, place)).otherwise(none)

    return bind(F.regexp_extract_all(text, p, F.lit(0)), all_of)


def _surprise(z: Column) -> Column:
    """Minus the logarithm of the upper tail of the normal distribution (Karagiannidis' formula)."""

    def of(z):
        a = F.greatest(F.abs(z), F.lit(1e-6))
        far = a * a / 2 + F.log(a * (1.135 * math.sqrt(2 * math.pi))) - F.log(1 - F.exp(-1.4 * a))
        return F.when(z >= 0, far).otherwise(-F.log(1 - F.exp(-far)))

    return bind(z, of)


def _tests(run: Column) -> Column:
    """Struct (p: minus the log of the combined p-value, calm: fits uniformity) of a run, by its encoding."""
    which = F.lit(len(ENCODINGS) - 1)
    for i in reversed(range(len(ENCODINGS) - 1)):
        which = F.when(run.rlike(ENCODINGS[i][1]), i).otherwise(which)
    lower = [name for name, *_ in ENCODINGS].index("lower")
    of = lambda e, name: F.get(F.array(*[F.lit(getattr(a, name) if name == "signs" else float(getattr(a, name))) for a in ALPHABETS]), e)

    def battery(r):
        e = r["e"]
        k, mid = of(e, "size"), (of(e, "size") + 1) / 2
        places = bind(of(e, "signs"), lambda s: F.transform(F.split(r["t"], ""), lambda c: F.instr(s, c)))
        zero = F.struct(F.lit(0).alias("last"), *[F.lit(0.0).alias(c) for c in ("high", "changes", "serial")])

        def step(s, v):
            up, was, first = v > k / 2, s["last"] > k / 2, s["last"] == 0
            return F.struct(
                v.alias("last"), (s["high"] + F.when(up, 1.0).otherwise(0.0)).alias("high"),
                (s["changes"] + F.when(first | (up == was), 0.0).otherwise(1.0)).alias("changes"),
                (s["serial"] + F.when(first, 0.0).otherwise((s["last"] - mid) * (v - mid))).alias("serial"))

        def squares(s, v):
            many = F.when(s["last"] == v, s["many"] + 1).otherwise(F.lit(1.0))
            return F.struct(v.alias("last"), many.alias("many"), (s["sum"] + 2 * many - 1).alias("sum"))

        nothing = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("many"), F.lit(0.0).alias("sum"))
        counted = lambda a: F.struct(
            F.aggregate(a, zero, step).alias("m"), F.aggregate(F.sort_array(a), nothing, squares)["sum"].alias("square"),
            F.size(a).cast("double").alias("n"))
        return bind(bind(places, counted), lambda x: verdict(e, k, x))

    def verdict(e, k, x):
        n, square, high, changes, serial = x["n"], x["square"], x["m"]["high"], x["m"]["changes"], x["m"]["serial"]
        # against language, towards randomness
        q2, q3, h, mean, var = (of(e, c) for c in ("square", "cube", "high", "mean", "var"))
        chi = (n + n * (n - 1) * q2 - square) / F.sqrt(2 * n * (n - 1) * (q2 + 2 * (n - 2) * q3 - (2 * n - 3) * q2 * q2))
        flip = 2 * h * (1 - h)
        runs = (changes - (n - 1) * flip) / F.sqrt((n - 1) * flip * (1 - flip) + 2 * (n - 2) * (h * (1 - h) - flip * flip))
        m2 = mean * mean
        neighbours = ((n - 1) * m2 - serial) / F.sqrt((n - 1) * (var * var + 2 * m2 * var) + 2 * (n - 2) * m2 * var)
        y = (_surprise(chi) + _surprise(runs) + _surprise(neighbours)) / SCALE
        # against uniformity, either way
        free = k - 1
        z_chi = (F.pow(F.greatest(square * k / n - n, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        expect = high * (n - high) * 2 / n
        spread = expect * (expect - 1) / (n - 1)
        z_runs = F.when(spread > 0, (changes - expect) / F.sqrt(spread)).otherwise(F.lit(99.0))
        z_serial = serial / ((k * k - 1) / 12 * F.sqrt(n - 1))
        calm = F.greatest(F.abs(z_chi), F.abs(z_runs), F.abs(z_serial)) <= REJECT
        return F.struct(bind(y, lambda y: y - F.log(1 + y)).alias("p"), calm.alias("calm"))

    low = bind(F.struct(run.alias("t"), which.alias("e")), lambda r: F.struct(F.when(r["e"] == lower, F.lower(r["t"])).otherwise(r["t"]).alias("t"), r["e"].alias("e")))
    return bind(low, battery)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """(id, base, added): arrays of (s, e, kind) of the fixed patterns, and of the random runs apart from those.

    Null and empty texts have no spans, an empty table gives an empty result.  Each row is scanned by itself, so repeated rows
    give repeated results and ids may be null; the thresholds count every row.  Very long texts and runs take time in proportion
    to their length.  Other columns are not read, so their names cannot clash.  The scan of each text is a written table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    named = lambda a, k: F.transform(a, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))
    t = F.col("text")
    base = F.array_sort(F.concat(
        named(spans(t, ASSIGN, lambda g: F.length(g) >= 8, 2), 0), named(spans(t, ACCESS), 1), named(spans(t, HEX), 2)))
    # only what was found is written; the text is read once
    found = Durable(docs.sparkSession, "secrets").write(
        src.select("id", base.alias("base"), spans(t, RUN).alias("runs")).withColumn("rid", F.monotonically_increasing_id())
    )
    some = found.where(F.size("runs") > 0)
    alone = some.where(F.size("base") == 0).select("rid", F.explode("runs").alias("r")).select("rid", "r.s", "r.e", "r.t")
    # a run overlaps a fixed span if, of those that start before its end, the furthest end lies beyond its start
    event = lambda pos, fixed, end, s, t: F.struct(pos.alias("pos"), F.lit(fixed).alias("fixed"), end.alias("end"), s.alias("s"), t.alias("t"))
    no = F.lit(None)
    events = F.concat(
        F.transform("base", lambda b: event(b["s"], 1, b["e"], no.cast("int"), no.cast("string"))),
        F.transform("runs", lambda r: event(r["e"], 0, no.cast("int"), r["s"], r["t"])))
    reach = F.max("end").over(W.partitionBy("rid").orderBy("pos", "fixed").rowsBetween(W.unboundedPreceding, W.currentRow))
    mixed = (
        some.where(F.size("base") > 0).select("rid", F.explode(events).alias("v")).select("rid", "v.*").withColumn("reach", reach)
        .where((F.col("fixed") == 0) & (F.coalesce("reach", F.lit(0)) <= F.col("s"))).select("rid", "s", F.col("pos").alias("e"), "t")
    )
    runs = (
        alone.unionByName(mixed)
        .select("rid", "s", "e", F.regexp_replace("t", "=++$", "").alias("t"))
        .where(F.length("t") >= MIN_RUN)
        .select("rid", "s", "e", _tests(F.col("t")).alias("x"), F.floor(F.log2(F.length("t").cast("double"))).alias("class"))
        .select("rid", "s", "e", "class", "x.calm", F.least(F.floor(F.col("x.p") * STEPS), F.lit(LAST)).alias("step"))
    )
    runs = Durable(docs.sparkSession, "runs").write(runs)
    w = W.partitionBy("class")
    steps = (
        runs.groupBy("class", "step").count()
        .withColumn("above", F.sum("count").over(w.orderBy(F.col("step").desc())))
        .withColumn("all", F.sum("count").over(w))
        .where((F.col("step") > 0) & (F.exp(-F.col("step") / float(STEPS)) <= F.col("above") / F.col("all") * fdr))
        .groupBy("class").agg(F.min("step").alias("least"))
    )
    random = (
        runs.join(F.broadcast(steps), "class")
        .where((F.col("step") >= F.col("least")) & F.col("calm"))
        .groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("s", F.lit(3).alias("k"), "e"))).alias("added"))
    )
    return found.select("id", "base", "rid").join(random, "rid", "left").select(
        F.col("id").alias(id_col), "base", F.coalesce("added", F.array().cast("array<struct<s:int,k:int,e:int>>")).alias("added")
    )


def _joined(a: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"], x["e"])), ",")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    many = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[many(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def _surprise_of(z: float) -> float:
    a = max(abs(z), 1e-6)
    far = a * a / 2 + math.log(a * (1.135 * math.sqrt(2 * math.pi))) - math.log(1 - math.exp(-1.4 * a))
    return far if z >= 0 else -math.log(1 - math.exp(-far))


def battery(run: str) -> tuple[float, bool]:
    """Minus the log of the combined p-value and the fit to uniformity of one run, in plain Python, for tests."""
    import re
    from collections import Counter

    e = next(i for i, (_, p, _) in enumerate(ENCODINGS) if re.match(p, run))
    a, x = ALPHABETS[e], run.lower() if ENCODINGS[e][0] == "lower" else run
    at, n, k = [a.signs.index(c) + 1 for c in x], len(x), a.size
    mid, up = (k + 1) / 2, [a.signs.index(c) + 1 > k / 2 for c in x]
    square, high = sum(c * c for c in Counter(at).values()), sum(up)
    changes = sum(p != q for p, q in zip(up, up[1:]))
    serial = sum((p - mid) * (q - mid) for p, q in zip(at, at[1:]))
    chi = (n + n * (n - 1) * a.square - square) / math.sqrt(2 * n * (n - 1) * (a.square + 2 * (n - 2) * a.cube - (2 * n - 3) * a.square**2))
    flip, m2 = 2 * a.high * (1 - a.high), a.mean**2
    runs = (changes - (n - 1) * flip) / math.sqrt((n - 1) * flip * (1 - flip) + 2 * (n - 2) * (a.high * (1 - a.high) - flip**2))
    neighbours = ((n - 1) * m2 - serial) / math.sqrt((n - 1) * (a.var**2 + 2 * m2 * a.var) + 2 * (n - 2) * m2 * a.var)
    y = sum(map(_surprise_of, (chi, runs, neighbours))) / SCALE
    zc = ((max(square * k / n - n, 0) / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    expect = 2 * high * (n - high) / n
    spread = expect * (expect - 1) / (n - 1)
    zr = (changes - expect) / math.sqrt(spread) if spread > 0 else 99
    zs = serial / ((k * k - 1) / 12 * math.sqrt(n - 1))
    return y - math.log(1 + y), max(abs(zc), abs(zr), abs(zs)) <= REJECT


def brute(texts: list[tuple[int, str | None]], fdr: float = FDR) -> dict[int, tuple]:
    """The same in plain Python, for tests: id -> (base spans, all spans) as joined text."""
    import re

    base, scored = {}, []
    for k, t in texts:
        t = t or ""
        b = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, t) if len(m[2]) >= 8]
        b += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        b += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        base[k] = sorted(b)
        for m in re.finditer(RUN, t):
            x = m[0].rstrip("=")
            if len(x) >= MIN_RUN and not any(s < m.end() and m.start() < e for s, _, e in b):
                p, calm = battery(x)
                scored.append((k, m.start(), m.end(), int(math.log2(len(x))), min(math.floor(p * STEPS), LAST), calm))
    least = {}
    for c in {r[3] for r in scored}:
        steps = [r[4] for r in scored if r[3] == c]
        good = [t for t in set(steps) if t > 0 and math.exp(-t / STEPS) <= fdr * sum(u >= t for u in steps) / len(steps)]
        least[c] = min(good) if good else None
    out = {}
    for k, _ in texts:
        more = [(s, 3, e) for i, s, e, c, t, calm in scored if i == k and calm and least[c] is not None and t >= least[c]]
        join = lambda rows: ",".join(f"{KINDS[q]}:{s}:{e}" for s, q, e in sorted(rows))
        out[k] = (join(base[k]), join(base[k] + more))
    return out
