"""The phone numbers and e-mail addresses of each site, from whole texts: normalised, checked and ranked (batch).

Each document names a contact once, whatever its spelling.  Contacts that are valid are ranked by the documents of the site that
have them; those that are not are kept apart with the reason.  ``contacts`` is partitioned by kind and language, ``sites``, a
line for each site, by language.  Both come from ``counts``, which is written first; all three are replaced as a whole.

    python -m jobs.contact_directory --documents PATH --out PATH [--config FILE]
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import normalize
from lodestone.operators import extract

from .common import command_line, config, counted, log, total

NAME = "contact_directory"
COUNTS = "lang string, source string, kind string, value string, docs long, first_doc long"
CONTACTS = "source string, value string, docs long, first_doc long, rank int, problem string, kind string, lang string"
SITES = "source string, docs long, with_phone long, with_email long, phone string, email string, lang string"


def counts(documents: DataFrame, settings: dict) -> DataFrame:
    """(lang, source, kind, value, docs, first_doc): the documents of each site that name a contact, in one pass over the texts.

    Rows with an empty value count the site's documents (kind ``document``) and those with any contact of a kind.  Tasks add up
    what they read first, so a site with most of the documents is a few rows of each.
    """
    row = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    each = lambda kind: F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(settings[kind]), 0).alias(kind)
    some = lambda kind: F.when(F.size(kind) > 0, F.array(row(kind, F.lit("")))).otherwise(F.array().cast("array<struct<kind:string,value:string>>"))
    site = [F.coalesce(F.nullif("lang", F.lit("")), F.lit("und")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "doc_id"]
    raw = documents.select(*site, each("phone"), each("email"))
    every = F.concat(
        F.array(row("document", F.lit(""))), some("phone"), some("email"),
        F.transform("phone", lambda x: row("phone", normalize.phone(x))), F.transform("email", lambda x: row("email", normalize.email(x))))
    one = raw.select("lang", "source", "doc_id", F.explode(F.array_distinct(every)).alias("c"))
    return one.groupBy("lang", "source", "c.kind", "c.value").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"))


def problem() -> F.Column:
    """Why a contact is not valid; null if it is."""
    bad_phone = F.when(~F.col("value").rlike(r"^\+1-\d{3}-\d{3}-\d{4}$"), "not ten digits")
    bad_email = F.when(~extract.valid_email(F.col("value")), "no address")
    return F.when(F.col("kind") == "phone", bad_phone).otherwise(bad_email)


def directory(sums: DataFrame, ranks: int) -> DataFrame:
    """The best ``ranks`` valid contacts of each kind and site, and all that are not valid; ranks are cut before sites come together."""
    named = sums.where("value <> ''").withColumn("problem", problem())
    order = W.partitionBy("lang", "source", "kind").orderBy(F.desc("docs"), "value")
    good = named.where("problem is null").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return good.unionByName(named.where("problem is not null").withColumn("rank", F.lit(None).cast("int")))


def sites(sums: DataFrame, contacts: DataFrame) -> DataFrame:
    """A line for each site: documents, those with a phone number or an address, and the first of each."""
    n = lambda kind, name: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("docs"))), F.lit(0)).alias(name)
    best = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("value"))).alias(kind)
    every = sums.where("value = ''").groupBy("lang", "source").agg(n("document", "docs"), n("phone", "with_phone"), n("email", "with_email"))
    return every.join(contacts.where("rank = 1").groupBy("lang", "source").agg(best("phone"), best("email")), ["lang", "source"], "left")


def run(spark: SparkSession, documents: str, out: str, settings: dict | None = None) -> dict:
    """Reads the documents, writes the tables and returns the rows read and written.

    Null texts have no contacts, a site without a name is '', a language that is null or empty is ``und``; a repeated row
    counts as a document of its own, and an empty table leaves empty ones.
    """
    settings = settings or config(NAME)
    docs, seen = counted(spark.read.parquet(documents), "documents")
    counts(docs, settings).write.mode("overwrite").parquet(f"{out}/counts")
    sums = spark.read.schema(COUNTS).parquet(f"{out}/counts")
    named, wrote = counted(directory(sums, settings["ranks"]), "contacts")
    _write(named, CONTACTS, f"{out}/contacts", "kind", "lang")
    lines, ends = counted(sites(sums, contacts(spark, out)), "sites")
    _write(lines, SITES, f"{out}/sites", "lang")
    done = {"documents": total(seen), "contacts": total(wrote), "sites": total(ends)}
    log.info("read %d documents of %s, wrote %d contacts and %d sites to %s", done["documents"], documents, done["contacts"], done["sites"], out)
    return done


def _write(df: DataFrame, schema: str, path: str, *by: str) -> None:
    df.select([x.split()[0] for x in schema.split(", ")]).write.mode("overwrite").partitionBy(*by).parquet(path)


def contacts(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(CONTACTS).parquet(f"{out}/contacts")


if __name__ == "__main__":
    command_line(NAME, __doc__.splitlines()[0], {"documents": "Parquet table (doc_id, text, lang, source)", "out": "folder of the result"}, run)
