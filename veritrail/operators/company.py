"""Employer verification against a register's search results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import company_name, name_match

STATUS = {"exact": "confirmed", "partial": "partial_match", "different": "unconfirmed"}


def _judged(register: DataFrame) -> DataFrame:
    """The first exact, else the first partial result of each name of the register; its titles are normalised once."""
    none = F.array().cast("array<struct<company_number:string,title:string>>")
    titled = F.transform(F.coalesce("results", none), lambda r: F.struct(company_name(r["title"]).alias("name"), r.alias("of")))
    ranked = F.transform(
        "titled",
        lambda r, i: F.struct(
            name_match(F.col("query_normalized"), r["name"]).alias("kind"),
            i.alias("place"),
            r["of"]["company_number"].alias("number"),
            r["of"]["title"].alias("title"),
        ),
    )
    best = F.array_min(F.filter("ranked", lambda r: r["kind"] != "different"))  # exact sorts before partial, then the earlier one
    rows = register.select("query_normalized", F.col("results").isNotNull().alias("held"), titled.alias("titled"))
    return rows.withColumn("ranked", ranked).select("query_normalized", "held", best.alias("best"))


def _answered(named: DataFrame, register: DataFrame) -> DataFrame:
    """Rows of ``company_name`` and others with what the register answers to their normalised name.

    Answers are judged before the join, once a name of the register and not once a row.
    """
    found = named.withColumn("query_normalized", company_name(F.col("company_name"))).join(_judged(register), "query_normalized", "left")
    return found.select(
        *(F.col(c) for c in named.columns if c not in ("company_name", "query_normalized")),
        F.col("company_name").alias("company_name_cv"),
        "query_normalized",
        F.col("best.number").alias("matched_company_number"),
        F.col("best.title").alias("matched_company_name"),
        F.coalesce("best.kind", F.lit("different")).alias("match_kind"),
        F.coalesce("held", F.lit(False)).alias("searched"),
    )


def matches(roles: DataFrame, register: DataFrame) -> DataFrame:
    """Roles with the first exact, else the first partial result of their normalised name.

    register: query_normalized, results array<struct<company_number, title>>; an empty array is a
    search that found nothing, a missing row one that was never made.
    """
    return _answered(roles.select("submission_id", "experience_id", "company_name"), register)


def statuses(matched: DataFrame) -> DataFrame:
    out = F.lit(None).cast("string")
    for kind, status in STATUS.items():
        out = F.when(F.col("match_kind") == kind, status).otherwise(out)
    return matched.withColumn("status", out)


def spellings(roles: DataFrame) -> DataFrame:
    """(company_name, n): every spelling of an employer, with how many roles have it; null is one of them."""
    return roles.groupBy("company_name").agg(F.count("*").alias("n"))


def status_counts(spelled: DataFrame, register: DataFrame) -> DataFrame:
    """(status, n): the roles of each status. Spellings are normalised and joined, not roles.

    spelled: as :func:`spellings` gives it.
    """
    return statuses(_answered(spelled, register)).groupBy("status").agg(F.sum("n").alias("n"))


def verify(roles: DataFrame, verified: DataFrame, cache: DataFrame, search=None, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(new verdicts, new cache rows): roles not yet verified, each missing name searched once.

    search(DataFrame of query_normalized, company_name) gives cache rows; without it, roles whose
    name is not cached are left for the next run, as they are when a search fails. Both results read
    the answers, so ``keep`` must hold on to them where a search costs or may answer otherwise.
    """
    open_roles = roles.join(verified.select("experience_id"), "experience_id", "left_anti")
    named = open_roles.select("company_name").distinct().withColumn("query_normalized", company_name(F.col("company_name")))
    missing = named.join(cache.select("query_normalized"), "query_normalized", "left_anti")
    missing = missing.groupBy("query_normalized").agg(F.min("company_name").alias("company_name"))
    fresh = keep(search(missing)) if search else cache.limit(0)
    done = statuses(matches(open_roles, cache.unionByName(fresh))).where("searched")
    return done.drop("searched", "match_kind"), fresh


# ---- a whole register as the search -------------------------------------------------

#: Names of one word in one part of a join; a word of more names is dealt over more parts.
HEAVY = 10_000


def _words(name) -> Column:
    return F.array_distinct(F.filter(F.split(name, " "), lambda w: w != ""))


def _within(small: DataFrame, large: DataFrame, often: DataFrame, heavy: int) -> DataFrame:
    """(a, b): names of ``small`` all of whose words are words of names of ``large``.

    A name that is contained has its rarest word in common with what contains it, so that word
    alone is the key. Names of a frequent word are dealt over parts, each with all that look for it.
    """
    each = small.select("name", F.explode(_words("name")).alias("word")).join(often, "word")
    keys = each.groupBy("name").agg(F.min(F.struct("n", "word")).alias("key"))
    keys = keys.select(F.col("name").alias("a"), F.col("key.word").alias("word"), F.floor(F.col("key.n") / heavy).cast("int").alias("parts"))
    posted = large.select(F.col("name").alias("b"), F.explode(_words("name")).alias("word"))
    posted = posted.join(keys.select("word", "parts").distinct(), "word")
    posted = posted.select("b", "word", F.pmod(F.xxhash64("b"), F.col("parts") + 1).cast("int").alias("part"))
    asked = keys.select("a", "word", F.explode(F.sequence(F.lit(0), F.col("parts"))).alias("part"))
    found = asked.join(posted, ["word", "part"])
    return found.where(F.size(F.array_except(_words("a"), _words("b"))) == 0).select("a", "b")


def register_matches(names: DataFrame, register: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """(query_normalized, company_number, title, match_kind): every exact and every partial match of a whole register.

    names: query_normalized; register: company_number, title. Words are sets: equal ones match
    exactly, one within the other partially. Names without words match nothing, null ones count as
    such; names given twice count once, entries of the register each for itself.
    """
    entries = register.select("company_number", "title", company_name(F.col("title")).alias("of"))
    asked = names.select(F.col("query_normalized").alias("name")).where("name <> ''").distinct()
    held = entries.select(F.col("of").alias("name")).where("name <> ''").distinct()
    often = asked.union(held).select(F.explode(_words("name")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    inside = _within(asked, held, often, heavy)
    around = _within(held, asked, often, heavy).select(F.col("b").alias("a"), F.col("a").alias("b"))
    # equal sets are found both ways; longer ones around the name one way
    kind = name_match(F.col("a"), F.col("b"))
    found = inside.union(around).distinct().select(F.col("a").alias("query_normalized"), F.col("b").alias("of"), kind.alias("match_kind"))
    return found.join(entries, "of").select("query_normalized", "company_number", "title", "match_kind")


def searching(register: DataFrame, heavy: int = HEAVY) -> Callable[[DataFrame], DataFrame]:
    """A search for :func:`verify` that asks a whole register: the best match of each name, none if there is none.

    An exact one comes before a partial one, then the smaller number and title.
    """

    def search(missing: DataFrame) -> DataFrame:
        found = register_matches(missing, register, heavy)
        best = found.groupBy("query_normalized").agg(F.min(F.struct("match_kind", "company_number", "title")).alias("best"))
        result = F.struct(F.col("best.company_number").alias("company_number"), F.col("best.title").alias("title"))
        none = F.array().cast("array<struct<company_number:string,title:string>>")
        rows = missing.select("query_normalized").join(best, "query_normalized", "left")
        return rows.select("query_normalized", F.when(F.col("best").isNull(), none).otherwise(F.array(result)).alias("results"))

    return search
