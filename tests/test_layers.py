"""Tables in buckets, archives, files, the register, evaluation, the stream: what the layers add to the rules."""

import glob
import json
import os
import random
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veritrail.functions import fixed, folding
from veritrail.functions import text as T
from veritrail.operators import cleaning, company, evaluation, ingest, jobs, quality
from veritrail.sources import files
from veritrail.sources.schemas import SCHEMAS
from veritrail.sources.tables import BUCKET, Catalog
from veritrail.streaming import changes

NOW, AS_OF = "2026-01-01 12:00:00", "2026-01-01"
KIND = "submission_id string, content_hash string, v int"


def _parts(path):
    return {os.path.relpath(p, path) for p in glob.glob(f"{path}/{BUCKET}=*/part-*")}


# ---- tables ----------------------------------------------------------------


def test_delete_rewrites_touched_buckets_alone(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}", {"bronze.t": KIND, "silver.t": KIND}, buckets=16)
    rows = spark.createDataFrame([(f"s{k}", "h", k) for k in range(200)] + [(None, "h", -1)], KIND)
    assert c.replace("bronze.t", rows) == 201 and c.replace("silver.t", rows) == 201
    path = f"{tmp_path}/bronze/t"
    before = _parts(path)
    gone = spark.createDataFrame([("s3",), ("s77",), ("unknown",), (None,)], "submission_id string")
    touched = {r[0] for r in gone.select(c.bucket()).collect()}
    c.delete(["bronze.t", "silver.t", "bronze.t"], gone)
    left = {r["submission_id"] for r in c.read("bronze.t").collect()}
    assert left == {f"s{k}" for k in range(200)} - {"s3", "s77"} | {None} == {r["submission_id"] for r in c.read("silver.t").collect()}
    kept = {p for p in before if int(p.split("/")[0].split("=")[1]) not in touched}
    assert kept and kept <= _parts(path) and not (before - kept) & _parts(path)


def test_delete_empties_a_bucket_and_a_table(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}", {"bronze.t": KIND}, buckets=4)
    rows = spark.createDataFrame([(f"s{k}", "h", k) for k in range(8)], KIND)
    c.append("bronze.t", rows)
    c.delete(["bronze.t"], rows.where("v < 7"))
    assert [r["v"] for r in c.read("bronze.t").collect()] == [7]
    c.delete(["bronze.t"], rows)
    assert c.read("bronze.t").count() == 0 and c.exists("bronze.t")
    c.delete(["bronze.t"], rows.limit(0))
    assert c.append("bronze.t", rows.limit(0)) == 0 and c.append("bronze.t", rows.limit(2)) == 2


def test_merge_can_be_done_again(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}", {"bronze.t": KIND}, buckets=4)
    for _ in range(2):
        c.merge("bronze.t", spark.createDataFrame([("a", "1", 1), ("a", "1", 2), ("b", "1", 3)], KIND))
    c.merge("bronze.t", spark.createDataFrame([("a", "2", 4)], KIND))
    assert sorted((r["submission_id"], r["v"]) for r in c.read("bronze.t").collect()) == [("a", 4), ("b", 3)]


def test_ensure_leaves_a_table_as_it_is(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}", {"bronze.t": KIND, "gold.t": "v int"})
    for table in ("bronze.t", "gold.t"):
        assert not c.exists(table)
        c.ensure(table)
        assert c.exists(table) and c.read(table).count() == 0
    c.append("gold.t", spark.createDataFrame([(1,)], "v int"))
    c.ensure("gold.t")
    assert c.read("gold.t").count() == 1


def test_required_columns(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}", SCHEMAS)
    with pytest.raises(KeyError, match="candidate_name"):
        c.append("bronze.raw_candidates", spark.createDataFrame([("a",)], "submission_id string"))


# ---- files -----------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "why"),
    [
        ("", "empty"), ("job_title\nx\n", "missing columns: seniority_level"), ("job_title,seniority_level\n ,Senior\n", "blank job_title"),
        ("job_title,seniority_level\nx,Senior\n x ,Mid\n", "repeated job_title: x"), ("job_title,seniority_level\n", "no rows"),
    ],
)
def test_reference_files_that_cannot_be_used(spark, tmp_path, text, why):
    (tmp_path / "t.csv").write_text(text)
    with pytest.raises(files.ReferenceDataError, match=why):
        files.job_titles(spark, f"{tmp_path}/t.csv")


def test_reference_files(spark, tmp_path):
    """Cells are trimmed, other columns left out; keys that differ in case are not repeated."""
    (tmp_path / "t.csv").write_text('note,job_title,seniority_level\nn," a, b ", Senior \nn,A,\nn,a,Mid\n')
    assert sorted(map(tuple, files.job_titles(spark, f"{tmp_path}/t.csv").collect())) == [("A", None), ("a", "Mid"), ("a, b", "Senior")]
    (tmp_path / "p.csv").write_text("location_token,country\nUK,\n")
    with pytest.raises(files.ReferenceDataError, match="no country: UK"):
        files.location_aliases(spark, f"{tmp_path}/p.csv")


def test_archive_has_one_object_an_id(spark, tmp_path):
    path, kind = f"file://{tmp_path}/a", "submission_id string, cv struct<x:int,at:timestamp>"
    row = lambda k, x: (k, (x, None))
    for rows in ([row("a", 1), row("b", 1)], [row("a", 2), row("c", 2)], [row("a", 2), row("c", 2)]):
        files.archive(spark.createDataFrame(rows, kind), path, buckets=4)
    lines = [json.loads(x) for p in glob.glob(f"{tmp_path}/a/*/part-*.json") for x in open(p)]
    assert sorted((x["submission_id"], x["cv"]["x"]) for x in lines) == [("a", 2), ("b", 1), ("c", 2)]


def test_ground_truth_is_added_to(spark, tmp_path):
    path = f"file://{tmp_path}/g"
    kind = "id string, inconsistency_types array<string>, filename string, extra int"
    files.record(spark.createDataFrame([("1", ["gap", "overlap"], 'x, "y".pdf', 0), ("2", [], "z.pdf", 0)], kind), path)
    files.record(spark.createDataFrame([("3", None, "w.pdf", 0)], kind), path)
    got = {r["id"]: (r["inconsistency_types"], r["filename"]) for r in files.ground_truth(spark, path).collect()}
    assert got == {"1": (["gap", "overlap"], 'x, "y".pdf'), "2": ([], "z.pdf"), "3": ([], "w.pdf")}


def test_pending_documents(spark, tmp_path):
    for name in ("cv_001_data_engineer_mid.pdf", "sub/cv_002_ml_engineer_senior.pdf", "note.txt", "4.pdf"):
        os.makedirs(os.path.dirname(tmp_path / "in" / name), exist_ok=True)
        (tmp_path / "in" / name).write_text("x")
    there = files.listed(spark, f"file://{tmp_path}/in")
    assert sorted(r["submission_id"] for r in there.collect()) == ["4", "cv_001_data_engineer_mid", "cv_002_ml_engineer_senior"]
    assert "content" not in there._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    specs = [("001", "Staff Engineer", "Staff"), ("002", "ML Engineer", "Senior"), ("003", "Data Engineer", "Mid")]
    specs = spark.createDataFrame(specs, "id string, role string, seniority string")
    specs = specs.withColumn("filename", files.cv_filename(*[F.col(c) for c in specs.columns]))
    recorded = spark.createDataFrame([("001", "cv_001_data_engineer_mid.pdf"), ("9", "cv_9_gone.pdf")], "id string, filename string")
    assert [r["filename"] for r in files.pending(specs, recorded, there).collect()] == ["cv_003_data_engineer_mid.pdf"]
    assert [r["id"] for r in files.without_file(recorded, there).collect()] == ["9"]
    none = files.listed(spark, f"file://{tmp_path}/none")
    assert none.count() == 0 and files.pending(specs, recorded, none).count() == 2 == files.without_file(recorded, none).count()


# ---- cleaning --------------------------------------------------------------


def test_folding_against_python(spark):
    rng = random.Random(11)
    marks = [chr(n) for n in range(0x300, 0x370)] + ["゙", "ཱ", "ְ"]
    odd = list("ςΣŉßẞİıﬁﬃＰ①½㎏ﷺ가각각ᅵÅΩẛགྷǅ") + ["\U0001d400", "\U00010400"]
    rows = [("".join(rng.choice(odd + marks + list("aeQ1 ")) for _ in range(rng.randint(1, 8))),) for _ in range(1500)] + [("",), (None,), ("Plain",)]
    df = spark.createDataFrame(rows, "c string")
    for r in df.select("c", folding.compatible(F.col("c")).alias("n"), folding.casefolded(F.col("c")).alias("f")).collect():
        assert (r["n"], r["f"]) == (None if r["c"] is None else unicodedata.normalize("NFKC", r["c"]), None if r["c"] is None else r["c"].casefold())


def test_lookups_fold_case(spark):
    raw = spark.createDataFrame([("s1", "a", "ＰYTHON"), ("s2", "a", "ﬁne"), ("s3", "a", None)], "skill_id string, submission_id string, skill_name string")
    dim = spark.createDataFrame([("python", "Python"), ("fine", "Fine")], "alias string, canonical_skill string")
    rows = cleaning.skills(raw, dim)
    assert {r["skill_id"]: r["normalized_skill"] for r in rows.collect()} == {"s1": "Python", "s2": "Fine", "s3": None}
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    keys = spark.createDataFrame([(" Straße ",), ("ΟΔΟΣ",), ("οδος",)], "c string").select(T.lookup_key(F.col("c")))
    assert [r[0] for r in keys.collect()] == ["strasse", "οδοσ", "οδοσ"]


def test_keywords_in_one_pass(spark):
    rng = random.Random(12)
    pieces = [w[rng.randint(0, 1) : len(w) - rng.randint(0, 1)] for w in fixed.PROFILE_WORDS] + list(fixed.PROFILE_WORDS) + [" ", "go", "c"]
    rows = [("".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))),) for _ in range(800)] + [(None,), ("",)]
    got = spark.createDataFrame(rows, "c string").select("c", T.profile_hits(F.col("c")).alias("n")).collect()
    assert [r["n"] for r in got] == [sum(w in (r["c"] or "") for w in fixed.PROFILE_WORDS) for r in got]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("020 7183 8750", "+442071838750"), ("07911-123456", "+447911123456"), ("+442071838750", "+442071838750"), ("0044 20 7183 8750", "+442071838750"),
        ("+34 612 45 89 07", "+34612458907"), ("+1 415-555-2671", "+14155552671"), ("0033 1 23 45 67 89", "+33123456789"), ("", None), (None, None),
        ("123", None), ("6124589070000", None), ("+44 (0)20 7183 8750", "+442071838750"), ("7911123456", "+447911123456"), ("447911123456", "+447911123456"),
        ("+353 87 123 4567", "+353871234567"), ("+35 312", None), ("+999 123456789", None), ("call me", None), ("+39 06 6982", "+39066982"),
    ],
)
def test_phones(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "phone string")
    assert cleaning.standard_phones(df, "phone", "phone").first()["phone"] == want


def test_phone_plans_are_a_table(spark):
    """A longer code comes before a shorter one; an injected function takes the place of all plans."""
    plans = spark.createDataFrame([("7", "8", "[0-9]{10}"), ("77", "", "[0-9]{4}"), ("x", "", ".*"), ("7777", "", ".*")], cleaning.PHONE_PLANS)
    df = spark.createDataFrame([("+7 123 456 7890",), ("+77 1234",), ("8 123 456 7890",)], "phone string")
    got = cleaning.standard_phones(df, "phone", "e", plans, home="7").collect()
    assert [r["e"] for r in got] == ["+71234567890", "+771234", "+71234567890"]
    raw = spark.createDataFrame([("a", "n", "1", "e", "l", "g")], "submission_id string, candidate_name string, phone string, email string, linkedin string, github string")
    row = cleaning.candidates(raw, normalize=lambda c: F.concat(F.lit("+"), c)).first()
    assert (row["phone"], row["is_phone_valid"]) == ("+1", True)


def test_gap_summary(spark):
    """Ties go by name, a blank title comes last, labels and sums are never cut."""
    kind = "job_title string, seniority_level string, location string, location_country string, start_date date, end_date date, is_current boolean"
    rows = [(t, None, p, None, None, None, False) for t, p in (("b", "x"), ("a", "y"), ("", ""), ("c", "y"), ("a", "z"), ("", ""))]
    rows.append(("fine", "Mid", "x", "X", None, None, True))
    df = spark.createDataFrame(rows, kind)
    got = {(r["kind"], r["name"]): r["n"] for r in cleaning.summarize_gaps(df, AS_OF, 2).collect()}
    assert got == {
        ("title", "a"): 2, ("title", None): 2, ("location", "y"): 2, ("location", "x"): 1, ("rows", "without_seniority"): 6, ("rows", "without_country"): 4,
        ("problem", "unparsed_start_date"): 7, ("problem", "unparsed_end_date"): 6,
    }
    assert cleaning.summarize_gaps(df.limit(0), AS_OF, 2).count() == 0
    assert cleaning.summarize_gaps(df, AS_OF).where("kind = 'title'").count() == 4


# ---- employers -------------------------------------------------------------


@pytest.mark.parametrize("heavy", [company.HEAVY, 3])
def test_register_against_all_pairs(spark, heavy):
    """Also with words that count as heavy from three names on."""
    rng = random.Random(13)
    words = ["alpha", "beta", "gamma", "the", "the", "the", "group"]
    name = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))
    names = [name() for _ in range(60)] + [None]
    register = [(str(k), f"{name().upper()} {rng.choice(['Ltd', 'plc', ''])}") for k in range(80)] + [("n", None), ("e", "Limited")]
    got = company.register_matches(
        spark.createDataFrame([(x,) for x in names], "query_normalized string"), spark.createDataFrame(register, "company_number string, title string"), heavy
    )
    want = set()
    for a in {x for x in names if x}:
        for number, title in register:
            b = set((title or "").lower().removesuffix("ltd").removesuffix("plc").removesuffix("limited").split())
            if b and (set(a.split()) <= b or b <= set(a.split())):
                want.add((a, number, title, "exact" if b == set(a.split()) else "partial"))
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_each_missing_name_is_searched_once(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}", SCHEMAS)
    roles = [(f"e{k}", f"s{k}", n) for k, n in enumerate(["Acme Ltd", "ACME Limited", "Zed", "Fails"])]
    c.append("silver.silver_work_experience", spark.createDataFrame([(*r, NOW) for r in roles], "experience_id string, submission_id string, company_name string, silver_processed_at string"))
    log = tmp_path / "log"

    kind = pa.list_(pa.struct([("company_number", pa.string()), ("title", pa.string())]))

    def ask(batches):
        for batch in batches:
            names = batch.column("query_normalized").to_pylist()
            with open(log, "a") as out:
                out.writelines(f"{n}\n" for n in names)
            found = [n for n in names if n != "fails"]
            results = [[{"company_number": "1", "title": n}] for n in found]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(results, kind)], names=["query_normalized", "results"])

    search = lambda missing: missing.mapInArrow(ask, "query_normalized string, results array<struct<company_number:string,title:string>>")
    assert jobs.verify_companies(c, search, NOW) == {"verified_count": 3}
    assert sorted(log.read_text().split()) == ["acme", "fails", "zed"]
    assert jobs.verify_companies(c, search, NOW) == {"verified_count": 0}  # the failed one comes again, alone
    assert sorted(log.read_text().split()) == ["acme", "fails", "fails", "zed"]
    assert {r["status"] for r in c.read("gold.signal_company_verification").collect()} == {"confirmed"}
    register = spark.createDataFrame([("7", "Fails Group"), ("8", "FAILS LTD")], "company_number string, title string")
    assert jobs.verify_companies(c, company.searching(register), NOW) == {"verified_count": 1}
    assert c.read("gold.signal_company_verification").where("matched_company_number = '8' and status = 'confirmed'").count() == 1


# ---- evaluation ------------------------------------------------------------


def test_scores(spark):
    truth = [("a", ["date_overlap", "ai_text"]), ("b", []), ("c", ["date_overlap"]), ("c", ["date_overlap"]), ("d", ["fictional_company"]), (None, ["x"])]
    truth = spark.createDataFrame(truth, "submission_id string, inconsistency_types array<string>")
    finding = lambda *names: [(n, 1, "proven") for n in names]
    rows = [("a", finding("employment_overlap", "employment_overlap_minor")), ("b", finding("seniority_implausible", "long_gap")), ("z", finding("employment_overlap"))]
    signals = spark.createDataFrame(rows, "submission_id string, findings array<struct<name:string,months:long,evidence:string>>")
    verdicts = spark.createDataFrame([("d", "unconfirmed"), ("d", "confirmed"), ("b", "confirmed")], "submission_id string, status string")
    names = evaluation.found([signals], verdicts)
    got = {r["flaw"]: tuple(r)[1:] for r in evaluation.scores(truth, names).collect()}
    assert got == {
        "date_overlap": (2, 1, 1, 1, 0, 2, 1.0, 0.5), "ai_text": (1, 0, 0, 1, 0, 3, None, 0.0), "career_incoherent": (0, 1, 0, 0, 1, 3, 0.0, None),
        "fictional_company": (1, 1, 1, 0, 0, 3, 1.0, 1.0), "fictional_company_2": (0, 1, 0, 0, 1, 3, 0.0, None), "company_substitution": (0, 1, 0, 0, 1, 3, 0.0, None),
    }
    matrix = {(r["flaw"], r["name"]): r["n"] for r in evaluation.confusion(truth, names).collect()}
    assert matrix[("none", "long_gap")] == 1 and matrix[("date_overlap", "none")] == 1 and matrix[("ai_text", "employment_overlap")] == 1
    assert evaluation.scores(truth.limit(0), names).count() == 0


def test_timed(spark, tmp_path):
    said = []
    c = Catalog(spark, f"file://{tmp_path}", SCHEMAS)
    got = jobs.timed("clean", said.append, lambda: jobs.clean(c, NOW))
    assert got.pop("duration_seconds") >= 0 and said[0].startswith("clean finished in ")
    assert got == {"silver_candidates_count": 0, "silver_skills_count": 0, "silver_work_experience_count": 0}


def test_native_plans(spark):
    """Validation and cleaning stay in the JVM."""
    replies = spark.createDataFrame([("a", "{}")], "submission_id string, reply string")
    assert "Python" not in ingest.parsed(replies)._jdf.queryExecution().executedPlan().toString()
    raw = spark.createDataFrame([], SCHEMAS["bronze.raw_candidates"])
    assert "Python" not in cleaning.candidates(raw)._jdf.queryExecution().executedPlan().toString()


def test_entity_ids(spark):
    """Blank keys each count, repeated ones once a value, nulls together; a row without document is lost."""
    texts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "submission_id string")
    roles = [("1", "a"), ("1", "b"), ("1", "a"), (None, "a"), (None, "z"), (" ", "a"), ("2", None), ("3", "b")]
    roles = spark.createDataFrame(roles, "experience_id string, submission_id string")
    found = quality.entity_ids(texts, {"r": (roles, "experience_id"), "t": (texts, "submission_id"), "e": (roles.limit(0), "experience_id")})
    assert {r["check"]: r["n"] for r in found.collect()} == {
        "r: blank experience_id": 3, "r: duplicate experience_id": 2, "r: no matching CV": 2, "t: blank submission_id": 1, "t: duplicate submission_id": 1,
        "t: no matching CV": 1, "e: blank experience_id": 0, "e: duplicate experience_id": 0, "e: no matching CV": 0,
    }


# ---- stream ----------------------------------------------------------------


def _stream(spark, tmp_path, c):
    changes.stream(spark, f"{tmp_path}/in", KIND, c, "bronze.t", f"{tmp_path}/cp").awaitTermination()
    return sorted(tuple(r) for r in c.read("bronze.t").collect())


def _send(spark, tmp_path, rows, at):
    """One file of rows, which came at a second of its own."""
    spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for p in glob.glob(f"{tmp_path}/in/part-*"):
        if not os.path.exists(f"{p}.seen"):
            os.utime(p, (at, at))
            (tmp_path / "in" / f".{os.path.basename(p)}.seen").touch()


def test_latest_version_of_a_batch_wins_and_state_survives(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/t", {"bronze.t": KIND}, buckets=4)
    c.append("bronze.t", spark.createDataFrame([("old", "1", 0), ("same", "1", 0)], KIND))
    _send(spark, tmp_path, [("a", "9", 1), ("a", "1", 2), ("old", "2", 1), ("same", "1", 1), ("b", "1", 1)], 1_700_000_000)
    # of a submission's two rows the later one counts, whatever their hashes
    assert _stream(spark, tmp_path, c) == [("a", "1", 2), ("b", "1", 1), ("old", "2", 1), ("same", "1", 0)]
    _send(spark, tmp_path, [("a", "1", 3), ("b", "2", 3)], 1_700_000_100)
    assert _stream(spark, tmp_path, c) == [("a", "1", 2), ("b", "2", 3), ("old", "2", 1), ("same", "1", 0)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_a_broken_batch_lands_once(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/t", {"bronze.t": KIND}, buckets=4)
    batch = spark.createDataFrame([("a", "1", 1, "new"), ("b", "1", 1, "changed")], f"{KIND}, action string")
    changes.landed(c, "bronze.t", batch, f"file://{tmp_path}/m/0")
    os.remove(tmp_path / "m" / "0.done")  # as if it had stopped before its end
    changes.landed(c, "bronze.t", batch, f"file://{tmp_path}/m/0")
    changes.landed(c, "bronze.t", batch, f"file://{tmp_path}/m/0")
    assert sorted(tuple(r) for r in c.read("bronze.t").collect()) == [("a", "1", 1), ("b", "1", 1)]
