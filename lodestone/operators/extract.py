"""Structured extraction: prompts, adapters, typed values with confidence and source.

The call to a language model is a boundary: an adapter maps prompts (seed, extraction_type, source_urls, prompt) to
responses (seed, extraction_type, response_json, model, error).  ``Replay`` reads them from a table, ``Callable`` asks a
function for each prompt, in batches of a partition.  Everything around it is declarative.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable as Fn

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as c
from ..session import ship
from . import context, pool

_FIELDS = ("university_name", "city", "state", "country", "postal_code", "phone", "email")
OVERVIEW = ", ".join(f"{f} string, {f}_confidence string" for f in _FIELDS)
TUITION = "items array<struct<fee_type:string,cost:bigint,currency:string,confidence:string>>, overall_confidence string"
DEADLINES = "items array<struct<deadline_type:string,deadline_date:string,notes:string,confidence:string>>, overall_confidence string"
RULES = {
    "overview": "Return the name, address and contact of the institution found in the pages. Leave out what is not stated. Rate each value high, medium or low.",
    "tuition": "Return every fee with its type, whole amount and currency found in the pages. Leave out what is not stated. Rate each item and the whole.",
    "deadlines": "Return every application deadline with its type, date (YYYY-MM-DD) and notes found in the pages. Leave out what is not stated. Rate each item and the whole.",
}
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"


def prompts(pages: DataFrame) -> DataFrame:
    """(seed, url, pos, markdown, is_admissions, is_tuition) -> one prompt for each seed and extraction type."""
    routes = {"overview": F.lit(True), "tuition": F.col("is_tuition"), "deadlines": F.col("is_admissions")}
    out = None
    for kind, flag in routes.items():
        one = context.assemble(pages.where(flag)).select(
            "seed", F.lit(kind).alias("extraction_type"), "source_urls", F.concat(F.lit(f"{RULES[kind]}\n"), "context").alias("prompt"))
        out = one if out is None else out.unionByName(one)
    return out


class Replay:
    """Responses from a table."""

    def __init__(self, responses: DataFrame):
        self.responses = responses

    def extract(self, asked: DataFrame) -> DataFrame:
        return asked.select("seed", "extraction_type").join(self.responses, ["seed", "extraction_type"], "left")


class Callable:
    """Responses of ``fn(extraction_type, prompt) -> (json, model)``; an exception becomes the error column."""

    def __init__(self, fn: Fn[[str, str], tuple[str, str]]):
        self.fn = fn

    def extract(self, asked: DataFrame) -> DataFrame:
        ship()
        fn = self.fn

        def run(batches):
            for pdf in batches:
                rows = []
                for r in pdf.itertuples():
                    try:
                        rows.append((r.seed, r.extraction_type, *fn(r.extraction_type, r.prompt), None))
                    except Exception as e:  # the boundary: a failed call is data
                        rows.append((r.seed, r.extraction_type, None, None, str(e)))
                yield pd.DataFrame(rows, columns=["seed", "extraction_type", "response_json", "model", "error"])

        return asked.mapInPandas(run, "seed string, extraction_type string, response_json string, model string, error string")


class Pooled:
    """Responses of ``ask(key, model, extraction_type, prompt) -> json`` through slots of keys and models.

    Prompts are dealt over one task for each key, which alone uses that key, so the slots' delays hold over the whole cluster;
    a task goes through the models of its key, skips limited slots and waits between rotations (``pool.SlotPool``).
    """

    def __init__(self, ask: Fn[[str, str, str, str], str], keys: list[str], config: c.PoolConfig = c.PoolConfig(), **clock):
        self.ask, self.keys, self.config, self.clock = ask, list(keys), config, clock

    def extract(self, asked: DataFrame) -> DataFrame:
        ship()
        ask, keys, config, clock = self.ask, self.keys, self.config, self.clock

        def run(batches):
            pools: dict[int, pool.SlotPool] = {}
            for pdf in batches:
                rows = []
                for r in pdf.itertuples():
                    slots = pools.setdefault(r.slot_key, pool.SlotPool([keys[r.slot_key]], config, **clock))
                    answer, i = slots.call(lambda key, model: ask(key, model, r.extraction_type, r.prompt))  # noqa: B023
                    model = None if i is None else slots.slots[i][1].name
                    rows.append((r.seed, r.extraction_type, answer, model, None if i is not None else "no slot answered"))
                yield pd.DataFrame(rows, columns=["seed", "extraction_type", "response_json", "model", "error"])

        # dealt by range, all prompts of a key are in one task
        n = len(keys)
        dealt = asked.withColumn("slot_key", F.pmod(F.xxhash64("seed", "extraction_type"), F.lit(n)).cast("int"))
        return dealt.repartitionByRange(n, "slot_key").mapInPandas(run, "seed string, extraction_type string, response_json string, model string, error string")


_TRIED = "seed string, extraction_type string, slot int, model string, response_json string, error string, outcome string, at double"


class Rounds:
    """Responses of ``ask(key, model, extraction_type, prompt) -> json`` by all slots of the cluster, in rounds.

    In a round each live slot (a key and a model) has one task, which alone uses it, so its delay holds over the whole cluster.
    A prompt begins at a slot of its own and goes, round by round, to the next slots in turn until one answers: failing costs it
    the slot, a limited slot hands the rest of its prompts on, and whatever key has room takes them.  Where no slot is left, all
    wait, limits are cleared and the next rotation begins; after the last, prompts stay without an answer.

    Attempts are written below ``folder`` (shared by all executors) round by round: a lost executor repeats one round of one
    slot at most, after its delay.  The driver keeps a line for each slot.  At most ``most`` prompts of a slot are asked in a
    round, so that slots that have gone through theirs take over others'.
    """

    def __init__(self, ask: Fn[[str, str, str, str], str], keys: list[str], folder: str, config: c.PoolConfig = c.PoolConfig(), most: int = 100, clock=time.time, sleep=time.sleep):
        self.ask, self.keys, self.folder, self.config, self.most, self.clock, self.sleep = ask, list(keys), folder, config, most, clock, sleep
        self.slots = [(k, m) for m in config.models for k in self.keys]
        self.stats = [{"requests": 0, "failures": 0, "limited": False, "last": None} for _ in self.slots]

    def _round(self, dealt: DataFrame, path: str) -> None:
        """Asks ``dealt`` (slot and prompt) and writes what came of it."""
        ask, slots, clock, sleep, most = self.ask, self.slots, self.clock, self.sleep, self.most
        last = [s["last"] for s in self.stats]

        def run(batches):
            context = TaskContext.get()
            used: dict[int, float | None] = {}
            asked: dict[int, int] = {}
            limited: set[int] = set()
            for pdf in batches:
                rows = []
                for r in pdf.itertuples():
                    key, model = slots[r.slot]
                    if r.slot not in used:  # a repeated task does not know when the lost one asked
                        used[r.slot] = clock() if context and context.attemptNumber() else last[r.slot]
                    if r.slot in limited or asked.get(r.slot, 0) >= most:
                        continue  # left for the next round
                    if used[r.slot] is not None and (rest := model.delay - (clock() - used[r.slot])) > 0:
                        sleep(rest)
                    asked[r.slot] = asked.get(r.slot, 0) + 1
                    try:
                        answer, error, outcome = ask(key, model.name, r.extraction_type, r.prompt), None, "answered"
                        used[r.slot] = clock()
                    except Exception as e:  # a failing slot is data
                        answer, error, outcome = None, str(e), "limited" if pool.is_limited(str(e)) else "failed"
                        limited |= {r.slot} if outcome == "limited" else set()
                    rows.append((r.seed, r.extraction_type, r.slot, model.name, answer, error, outcome, used[r.slot]))
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in _TRIED.split(", ")])

        spread = dealt.repartitionById(len(slots), F.col("slot"))
        spread.mapInPandas(run, _TRIED).write.mode("overwrite").parquet(path)

    def extract(self, asked: DataFrame) -> DataFrame:
        ship()
        spark, key, n = asked.sparkSession, ["seed", "extraction_type"], len(self.slots)
        root = f"{self.folder}/rounds-{uuid.uuid4().hex}"
        read = lambda: spark.read.schema(f"{_TRIED}, rotation int, round int").parquet(root)
        begin = asked.select(*key, "prompt", F.pmod(F.xxhash64(*key), F.lit(n)).cast("int").alias("first"))
        rotation = turn = 0
        while True:
            todo = begin
            if turn:
                tried = read()
                mine = tried.where((F.col("rotation") == rotation) & (F.col("outcome") != "answered")).groupBy(*key).agg(F.collect_set("slot").alias("tried"))  # at most the slots
                todo = todo.join(tried.where("outcome = 'answered'").select(*key), key, "left_anti").join(mine, key, "left")
            live = [i for i, s in enumerate(self.stats) if not s["limited"]]
            order = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.pmod(F.col("first") + k, F.lit(n)))
            left = F.coalesce(F.col("tried"), F.array().cast("array<int>")) if turn else F.array().cast("array<int>")
            slot = F.get(F.filter(order, lambda k: k.isin(live) & ~F.array_contains(left, k)), F.lit(0)) if live else F.lit(None).cast("int")
            self._round(todo.withColumn("slot", slot).where("slot is not null").select("slot", *key, "prompt"), f"{root}/rotation={rotation}/round={turn}")
            now = read().where(F.col("round") == turn).groupBy("slot").agg(
                F.count_if(F.col("outcome") == "answered").alias("good"), F.count_if(F.col("outcome") != "answered").alias("bad"), F.max(F.col("outcome") == "limited").alias("limited"), F.max("at").alias("at")).collect()
            for r in now:
                s = self.stats[r.slot]
                s.update(requests=s["requests"] + r.good, failures=s["failures"] + r.bad, limited=r.limited, last=r.at)
            turn += 1
            if not now:  # no slot is left to any prompt
                rotation += 1
                if rotation >= self.config.rotations or not begin.join(read().where("outcome = 'answered'").select(*key), key, "left_anti").limit(1).count():
                    break
                self.sleep(self.config.wait)
                for s in self.stats:
                    s["limited"] = False
        answers = read().where("outcome = 'answered'").select(*key, "response_json", "model")
        return begin.select(*key).join(answers, key, "left").withColumn("error", F.when(F.col("response_json").isNull(), "no slot answered"))


def typed(responses: DataFrame, kind: str, schema: str) -> DataFrame:
    """Adds ``r``: the answer by its schema, null where it is missing or does not fit."""
    read = F.from_json("response_json", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    some = responses.where(F.col("extraction_type") == kind).withColumn("r", read)
    return some.withColumn("r", F.when(F.col("r._corrupt").isNull(), F.col("r")))


def email_guard(x: Column) -> Column:
    return F.when(F.contains(x, F.lit("@")), x)


def valid_email(x: Column) -> Column:
    return x.rlike(EMAIL_PATTERN)


def overview_value(r: str = "r") -> Column:
    """The overview; an invalid address empties email and postal code."""
    g = lambda f: F.col(f"{r}.{f}")
    mail = email_guard(g("email"))
    bad = mail.isNotNull() & ~valid_email(mail)
    return F.when(F.col(r).isNotNull(), F.struct(
        g("university_name").alias("university_name"),
        F.struct(g("city").alias("city"), g("state").alias("state"), g("country").alias("country"), F.when(~F.coalesce(bad, F.lit(False)), g("postal_code")).alias("postal_code")).alias("location"),
        F.struct(g("phone").alias("phone"), F.when(~F.coalesce(bad, F.lit(False)), mail).alias("email")).alias("contact")))


def enum_guard(x: Column, allowed=c.DEADLINE_TYPES) -> Column:
    return F.when(x.isin(*allowed), x)


def tuition_value() -> Column:
    return F.transform("r.items", lambda t: F.struct(t["fee_type"].alias("fee_type"), t["cost"].alias("cost"), t["currency"].alias("currency")))


def deadlines_value() -> Column:
    return F.transform("r.items", lambda d: F.struct(
        enum_guard(d["deadline_type"]).alias("deadline_type"), d["deadline_date"].alias("deadline_date"), d["notes"].alias("notes")))


def field_scores(r: str = "r") -> Column:
    """Confidence of each overview field that has a value."""
    rows = F.array(*[F.struct(
        F.lit(f).alias("field_name"), F.coalesce(F.col(f"{r}.{f}_confidence"), F.lit("medium")).alias("confidence"),
        F.concat(F.lit("Value: "), F.col(f"{r}.{f}")).alias("reason"), F.col(f"{r}.{f}").alias("v")) for f in _FIELDS])
    kept = F.filter(rows, lambda x: x["v"].isNotNull())
    return F.transform(kept, lambda x: F.struct(x["field_name"].alias("field_name"), x["confidence"].alias("confidence"), x["reason"].alias("reason")))


def overall(scores: Column) -> Column:
    """high for three or more high fields, medium for one, else low."""
    n = F.size(F.filter(scores, lambda x: x["confidence"] == "high"))
    return F.when(n >= 3, "high").when(n >= 1, "medium").otherwise("low")


def tuition_scores() -> Column:
    return F.transform("r.items", lambda t, i: F.struct(
        F.concat(F.lit("tuition["), i, F.lit("]."), F.coalesce(t["fee_type"], F.lit("None"))).alias("field_name"),
        F.coalesce(t["confidence"], F.lit("medium")).alias("confidence"),
        F.when(F.coalesce(t["cost"], F.lit(0)) != 0, F.concat(F.lit("$"), t["cost"])).otherwise("no cost").alias("reason")))


def deadline_scores() -> Column:
    return F.transform("r.items", lambda d, i: F.struct(
        F.concat(F.lit("deadline["), i, F.lit("]."), F.coalesce(F.when(d["deadline_type"] != "", d["deadline_type"]), F.lit("other"))).alias("field_name"),
        F.coalesce(d["confidence"], F.lit("medium")).alias("confidence"),
        F.when(F.coalesce(d["deadline_date"], F.lit("")) != "", F.concat(d["deadline_date"], F.lit(" ("), F.coalesce(d["notes"], F.lit("None")), F.lit(")"))).otherwise("no date").alias("reason")))


def results(asked: DataFrame, responses: DataFrame, seeds: DataFrame) -> DataFrame:
    """(seed, overview, tuition_breakdown, admission_deadlines, extraction_sources, extraction_confidence) of every seed.

    A missing, empty or failed response leaves an empty value, its sources and low confidence.
    """
    none = F.array().cast("array<struct<field_name:string,confidence:string,reason:string>>")
    parts = (("overview", OVERVIEW, overview_value(), field_scores()), ("tuition", TUITION, tuition_value(), tuition_scores()), ("deadlines", DEADLINES, deadlines_value(), deadline_scores()))
    out, sources = seeds.select("seed"), asked.select("seed", "extraction_type", "source_urls")
    for kind, schema, value, scores in parts:
        total = overall(F.col("scores")) if kind == "overview" else F.coalesce("r.overall_confidence", F.lit("medium"))
        one = typed(responses, kind, schema).withColumn("scores", F.coalesce(F.when(F.col("r").isNotNull(), scores), none)).join(
            sources.where(F.col("extraction_type") == kind).select("seed", "source_urls"), "seed", "left").select(
            "seed", value.alias(kind),
            F.struct(F.lit(kind).alias("extraction_type"), F.coalesce("source_urls", F.array().cast("array<string>")).alias("source_urls"), F.col("model").alias("model_used")).alias(f"{kind}_source"),
            F.struct(F.lit(kind).alias("extraction_type"), F.when(F.col("r").isNull(), "low").otherwise(total).alias("overall_confidence"), F.col("scores").alias("field_scores")).alias(f"{kind}_confidence"))
        out = out.join(one, "seed", "left")
    items = lambda k, t: F.coalesce(F.col(k), F.array().cast(t)).alias({"tuition": "tuition_breakdown", "deadlines": "admission_deadlines"}[k])
    return out.select(
        "seed", "overview", items("tuition", "array<struct<fee_type:string,cost:bigint,currency:string>>"),
        items("deadlines", "array<struct<deadline_type:string,deadline_date:string,notes:string>>"),
        F.array_compact(F.array(*[f"{k}_source" for k, *_ in parts])).alias("extraction_sources"),
        F.array_compact(F.array(*[f"{k}_confidence" for k, *_ in parts])).alias("extraction_confidence"))
