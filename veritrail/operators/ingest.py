"""Bronze: change detection by content hash, extraction replies to entity rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import bare_json, first_spellings, skill_category, trimmed

# Most code points of each field after trimming, and values where a field is missing.
LENGTHS = {"candidate_name": 200, "email": 200, "phone": 50, "linkedin": 500, "github": 500}
ROLE_LENGTHS = {"job_title": 200, "company_name": 200, "company_website": 500, "location": 200, "start_date": 50, "end_date": 50, "description": 10000}
DEFAULTS = {"end_date": "Present"}
TRUE, FALSE = ("1", "true", "t", "yes", "y", "on"), ("0", "false", "f", "no", "n", "off")
MOST_SKILLS = 200


def actions(now: DataFrame, prior: DataFrame) -> DataFrame:
    """new, unchanged or changed for each id of ``now``; a prior row without a hash is changed."""
    before = prior.select("submission_id", F.col("content_hash").alias("old_hash"), F.lit(True).alias("known"))
    action = (
        F.when(F.col("known").isNull(), "new").when(F.col("content_hash").eqNullSafe(F.col("old_hash")), "unchanged").otherwise("changed")
    )
    return now.join(before, "submission_id", "left").select("submission_id", "content_hash", action.alias("action"))


# ---- replies as variants: what a field is, what is wrong with it, what it gives ---------------------
#
# Each field is looked up once, as a struct of its kind (null if it is missing, VOID if it is null)
# and its value; errors and results are read off these.


def _text(record, field: str) -> Column:
    held = F.try_variant_get(record, f"$.{field}", "variant")
    return F.struct(F.schema_of_variant(held).alias("kind"), trimmed(F.try_variant_get(record, f"$.{field}", "string")).alias("value")).alias(field)


def _text_error(x: Column, field: str, most: int, taboo=None) -> Column:
    """What is wrong with a text of at most ``most`` code points, or null; with ``taboo`` it must be there and mean something."""
    odd = F.char_length(x["value"]) > most
    if taboo is not None:
        odd = odd | (x["value"] == "") | F.lower(x["value"]).isin(*taboo)
    gone = F.lit(f"{field} is missing") if taboo is not None else F.lit(None).cast("string")
    wrong = F.when(x["kind"] != "STRING", F.lit(f"{field} is no text")).when(odd, F.lit(f"{field} has a length or value that is not allowed"))
    return F.when(x["kind"].isNull(), gone).otherwise(wrong)


def _text_value(x: Column, field: str) -> Column:
    return F.when(x["kind"].isNull(), F.lit(DEFAULTS.get(field, ""))).otherwise(x["value"]).alias(field)


def _flag(record, field: str) -> Column:
    """A truth value: also 1 and 0, and words for them; false if it is missing, null if it is none."""
    held = F.try_variant_get(record, f"$.{field}", "variant")
    word = F.lower(trimmed(F.try_variant_get(record, f"$.{field}", "string")))
    number = F.try_variant_get(record, f"$.{field}", "double")
    kind = F.schema_of_variant(held)
    return (
        F.when(held.isNull(), False)
        .when(kind == "BOOLEAN", F.try_variant_get(record, f"$.{field}", "boolean"))
        .when(kind == "STRING", F.when(word.isin(*TRUE), True).when(word.isin(*FALSE), False))
        .otherwise(F.when(number == 1, True).when(number == 0, False))
        .alias(field)
    )


def _items(record, field: str) -> Column:
    """A list as its kind and an array of variants, empty if it is missing."""
    kind = F.schema_of_variant(F.try_variant_get(record, f"$.{field}", "variant"))
    none = F.array().cast("array<variant>")
    found = F.when(kind.startswith("ARRAY"), F.try_variant_get(record, f"$.{field}", "array<variant>")).otherwise(none)
    return F.struct(kind.alias("kind"), found.alias("items")).alias(field)


def _list_error(x: Column, field: str) -> Column:
    return F.when(x["kind"].isNotNull() & ~x["kind"].startswith("ARRAY"), F.lit(f"{field} is no list"))


_NAME = {"candidate_name": fixed.NAME_PLACEHOLDERS}
_ROLE = {"job_title": fixed.ROLE_PLACEHOLDERS, "company_name": fixed.ROLE_PLACEHOLDERS}


def parsed(replies: DataFrame) -> DataFrame:
    """(submission_id, cv, is_valid, error): replies read as JSON once; one bad field or role rejects the whole.

    Types are told apart by the kinds of variants, so a number is no text and null is not missing.
    A reply of more than 16 MB, or one that names a field twice, counts as no JSON. The metrics
    ``replies-...`` count rows and rejected ones; no filter moves below them, so a reply is judged once.
    """
    record = F.col("record")
    rows = replies.select("submission_id", F.try_parse_json(bare_json(F.col("reply"))).alias("record"))
    rows = rows.select(
        "submission_id", F.schema_of_variant(record).alias("whole"), *[_text(record, c) for c in LENGTHS], _items(record, "work_experience"), _items(record, "skills")
    )
    read = lambda r: F.struct(F.schema_of_variant(r).alias("whole"), *[_text(r, c) for c in ROLE_LENGTHS], _flag(r, "is_current"))
    item = lambda x: F.struct(F.schema_of_variant(x).alias("kind"), F.try_variant_get(x, "$", "string").alias("value"))
    rows = rows.withColumns({"roles": F.transform("work_experience.items", read), "said": F.transform("skills.items", item)})
    role_error = lambda r: F.coalesce(
        F.when(~r["whole"].startswith("OBJECT"), F.lit("a role is no object")),
        *[_text_error(r[c], c, n, _ROLE.get(c)) for c, n in ROLE_LENGTHS.items()],
        F.when(r["is_current"].isNull(), F.lit("is_current is no truth value")),
    )
    odd_skills = (F.size("said") > MOST_SKILLS) | F.exists("said", lambda x: x["kind"] != "STRING")
    error = F.coalesce(
        F.when(F.col("whole").isNull(), F.lit("no JSON")).when(~F.col("whole").startswith("OBJECT"), F.lit("no object")),
        *[_text_error(F.col(c), c, n, _NAME.get(c)) for c, n in LENGTHS.items()],
        _list_error(F.col("work_experience"), "work_experience"),
        F.array_min(F.array_compact(F.transform("roles", role_error))),
        _list_error(F.col("skills"), "skills"),
        F.when(odd_skills, F.lit("skills are too many or no texts")),
    )
    cv = F.struct(
        *[_text_value(F.col(c), c) for c in LENGTHS],
        F.transform("roles", lambda r: F.struct(*[_text_value(r[c], c) for c in ROLE_LENGTHS], r["is_current"].alias("is_current"))).alias("work_experience"),
        F.col("said.value").alias("skills"),
    )
    told = rows.select("submission_id", cv.alias("cv"), error.alias("error"))
    told = told.observe(f"replies-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("n"), F.count("error").alias("rejected"))
    valid = F.col("error").isNull()
    return told.select("submission_id", F.when(valid, F.col("cv")).alias("cv"), valid.alias("is_valid"), "error")


def candidate_rows(cvs: DataFrame) -> DataFrame:
    return cvs.where("is_valid").select("submission_id", *[F.col(f"cv.{c}").alias(c) for c in LENGTHS])


def roles(cvs: DataFrame) -> DataFrame:
    each = cvs.where("is_valid").select("submission_id", F.posexplode("cv.work_experience").alias("pos", "r"))
    return each.select(
        F.concat("submission_id", F.lit("_job"), F.col("pos") + 1).alias("experience_id"),
        "submission_id",
        *[F.col(f"r.{c}").alias({"start_date": "start_date_raw", "end_date": "end_date_raw"}.get(c, c)) for c in ROLE_LENGTHS],
        F.col("r.is_current").alias("is_current"),
    )


def skill_rows(cvs: DataFrame) -> DataFrame:
    each = cvs.where("is_valid").select("submission_id", F.explode(first_spellings(F.col("cv.skills"))).alias("skill_name"))
    return each.select(
        F.concat("submission_id", F.lit("_"), F.replace(F.lower("skill_name"), F.lit(" "), F.lit("_"))).alias("skill_id"),
        "submission_id",
        "skill_name",
        skill_category(F.col("skill_name")).alias("skill_category"),
    )
