import json

import pytest

from veritrail.functions import text as T
from veritrail.operators import ingest, jobs, quality
from veritrail.sources import files
from veritrail.sources.schemas import SCHEMAS
from veritrail.sources.tables import Catalog
from veritrail.streaming import changes

NOW, AS_OF = "2026-01-01 12:00:00", "2026-01-01"
ROLE = {"job_title": "Senior Analyst", "company_name": "Acme Ltd", "start_date": "August 2017", "end_date": "Present", "location": "Dock Office, UK"}


def _reply(**more):
    return json.dumps({"candidate_name": "Ann", "work_experience": [ROLE], "skills": ["Python", " python ", ""]} | more)


@pytest.mark.parametrize(
    ("more", "fine"),
    [
        ({}, True), ({"email": None}, False), ({"work_experience": None}, False), ({"skills": None}, False), ({"skills": [1]}, False),
        ({"candidate_name": " Unknown "}, False), ({"candidate_name": "x" * 201}, False), ({"candidate_name": " " + "x" * 200}, True),
        ({"skills": ["a"] * 201}, False), ({"work_experience": [ROLE | {"job_title": 5}]}, False), ({"work_experience": [ROLE | {"company_name": "TBD"}]}, False),
        ({"work_experience": [ROLE | {"company_website": "w" * 300}]}, True), ({"work_experience": [ROLE | {"is_current": "yes"}]}, True),
        ({"work_experience": [ROLE | {"is_current": 2}]}, False), ({"work_experience": [ROLE | {"is_current": None}]}, False),
        ({"work_experience": [ROLE, ROLE | {"description": "d" * 10001}]}, False), ({"work_experience": [], "unknown": 1}, True), ({"candidate_name": 7}, False),
    ],
)
def test_replies(spark, more, fine):
    row = ingest.parsed(spark.createDataFrame([("a", _reply(**more))], "submission_id string, reply string")).first()
    assert (row["is_valid"], row["cv"] is not None, row["error"] is None) == (fine, fine, fine)


def test_what_a_reply_gives(spark):
    """Trimmed texts, defaults where a field is missing, truth values of every spelling; the error names the field."""
    roles = [ROLE, {"job_title": " Clerk ", "company_name": "Zed", "is_current": 1}, {"job_title": "C", "company_name": "Z", "is_current": " ON "}]
    rows = [("a", _reply(work_experience=roles, email=" a@b.c ")), ("b", _reply(phone=7)), ("c", _reply(work_experience=[ROLE, 5])), ("d", _reply(skills={}))]
    got = {r["submission_id"]: r for r in ingest.parsed(spark.createDataFrame(rows, "submission_id string, reply string")).collect()}
    cv = got["a"]["cv"]
    assert (cv["candidate_name"], cv["email"], cv["github"], cv["skills"]) == ("Ann", "a@b.c", "", ["Python", " python ", ""])
    assert [(r["job_title"], r["end_date"], r["location"], r["is_current"]) for r in cv["work_experience"]] == [
        ("Senior Analyst", "Present", "Dock Office, UK", False), ("Clerk", "Present", "", True), ("C", "Present", "", True),
    ]
    assert [got[k]["error"] for k in "bcd"] == ["phone is no text", "a role is no object", "skills is no list"]


def test_replies_that_are_no_json(spark):
    rows = [("a", "```json\n" + _reply() + "\n```"), ("b", "no"), ("c", None), ("d", "[]"), ("e", "{}")]
    got = {r["submission_id"]: r["is_valid"] for r in ingest.parsed(spark.createDataFrame(rows, "submission_id string, reply string")).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False, "e": False}


def test_run_of_all_layers(spark, tmp_path):
    for name, content in (("one.pdf", "python sql kafka cv"), ("two.pdf", "  "), ("three.pdf", "no such words"), ("bad.pdf", "boom")):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(content)
    (tmp_path / "skills.csv").write_text("canonical_skill,aliases,alias_count\nPython,py|python,2\n")
    (tmp_path / "titles.csv").write_text("job_title,seniority_level\nsenior analyst,Senior\nchief,\n")
    (tmp_path / "places.csv").write_text("location_token,country\nUK,United Kingdom\n")
    c = Catalog(spark, f"file://{tmp_path}/t", SCHEMAS)

    def extract(content):
        if content == b"boom":
            raise ValueError("unreadable")
        return content.decode()

    def replies(todo):
        return todo.selectExpr("submission_id", f"'{_reply()}' as reply")

    land = lambda: jobs.land_texts(c, files.documents(spark, f"{tmp_path}/in"), extract, NOW)
    assert land() == {"cv_texts_count": 2} and land() == {"cv_texts_count": 0}
    assert [r["submission_id"] for r in c.read("bronze.rejected").distinct().collect()] == ["bad"]
    assert jobs.land_entities(c, replies, NOW) == {"raw_candidates_count": 1, "raw_work_experience_count": 1, "raw_skills_count": 1}
    assert jobs.land_entities(c, replies, NOW) == {"raw_candidates_count": 0, "raw_work_experience_count": 0, "raw_skills_count": 0}
    checks = {r["check"]: (r["passed"], r["severity"], r["description"]) for r in jobs.check_bronze(c).collect()}
    assert checks[quality.RAW_TEXTS][:2] == (True, "ERROR")
    assert checks[quality.SILENT] == (False, "WARN", "1 of 2 CVs produced no work experience and no skills")
    paths = [f"{tmp_path}/{x}.csv" for x in ("skills", "titles", "places")]
    assert jobs.load_reference(c, *paths) == {"dim_skills": 2, "dim_job_titles": 2, "dim_location_aliases": 1}
    jobs.clean(c, NOW)
    role = c.read("silver.silver_work_experience").first()
    assert (role["seniority_level"], role["location_city"], role["location_country"], role["is_current"]) == ("Senior", "Dock", "United Kingdom", True)
    told = {(r["signal"], r["name"]): r["n"] for r in jobs.signals(c, AS_OF, NOW).collect()}
    assert told == {("signal_timeline_consistency", "confirmed"): 1, ("signal_responsibility_mismatch", "confirmed"): 1}
    search = lambda names: names.selectExpr("query_normalized", "array(named_struct('company_number', '7', 'title', 'ACME LIMITED')) as results")
    assert jobs.verify_companies(c, None, NOW) == {"verified_count": 0}
    assert jobs.verify_companies(c, search, NOW) == {"verified_count": 1} and jobs.verify_companies(c, search, NOW) == {"verified_count": 0}
    (tmp_path / "in" / "one.pdf").write_text("python sql kafka changed")
    assert land() == {"cv_texts_count": 1}
    assert c.read("bronze.raw_work_experience").count() == 0 and c.read("bronze.raw_cv_texts").count() == 2
    with pytest.raises(quality.CheckFailed):
        c.append("bronze.raw_skills", spark.createDataFrame([("s", "gone", "x", "other")], SCHEMAS["bronze.raw_skills"]))
        jobs.check_bronze(c)


@pytest.mark.parametrize(
    ("text", "why"),
    [
        ("", "empty"), ("canonical_skill\nx\n", "missing"), ("canonical_skill,aliases\n ,a\n", "blank"), ("canonical_skill,aliases\nx, | \n", "no aliases"),
        ("canonical_skill,aliases,alias_count\nx,a|b,3\n", "alias_count"), ("canonical_skill,aliases\nx,a\ny,a\n", "more than one"),
    ],
)
def test_taxonomy_errors(spark, tmp_path, text, why):
    (tmp_path / "s.csv").write_text(text)
    with pytest.raises(files.ReferenceDataError, match=why):
        files.skills_taxonomy(spark, f"{tmp_path}/s.csv")


def test_ground_truth(spark, tmp_path):
    assert files.ground_truth(spark, f"{tmp_path}/none.csv").count() == 0
    head = "id,folder,role,seniority,years,location,github,inconsistency_types,filename\n"
    (tmp_path / "g.csv").write_text(head + "1,a,b,c,4,d,e,gap|overlap,f\n2,a,b,c,4,d,e,,f\n")
    got = {r["id"]: r["inconsistency_types"] for r in files.ground_truth(spark, f"{tmp_path}/g.csv").collect()}
    assert got == {"1": ["gap", "overlap"], "2": []} and files.recorded_ids(spark, f"{tmp_path}/g.csv").count() == 2


def test_stream_of_changes(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/t", {"bronze.t": "submission_id string, content_hash string, v int"})
    kind = "submission_id string, content_hash string, v int"
    for rows in ([("a", "1", 1), ("b", "1", 1)], [("a", "1", 2), ("b", "2", 2), ("c", "1", 2)]):
        spark.createDataFrame(rows, kind).write.mode("append").parquet(f"{tmp_path}/in")
        changes.stream(spark, f"{tmp_path}/in", kind, c, "bronze.t", f"{tmp_path}/cp").awaitTermination()
    assert sorted(tuple(r) for r in c.read("bronze.t").collect()) == [("a", "1", 1), ("b", "2", 2), ("c", "1", 2)]


def test_skills_in_compatibility_forms(spark):
    rows = spark.createDataFrame([("\uff30ython",), (" C\u00a0 x ",), ("\ufb01ne",), (None,)], "c string")
    assert [r[0] for r in rows.select(T.clean_skill(rows["c"])).collect()] == ["Python", "C x", "fine", ""]
