"""Declared schemas of all tables by layer."""

_FINDING = "name string, months bigint, evidence string"
_CLAIM = "experience_id string, name string, level string, claimed double, evidence string"

SCHEMAS = {
    "bronze.raw_cv_texts": (
        "submission_id string not null, content_hash string not null, cv_file_path string not null,"
        " submission_timestamp timestamp not null, raw_text string, profile_type string, folder string"
    ),
    "bronze.raw_candidates": (
        "submission_id string not null, candidate_name string not null, email string, phone string, linkedin string, github string,"
        " extracted_at timestamp not null"
    ),
    "bronze.raw_work_experience": (
        "experience_id string, submission_id string, company_name string, job_title string, start_date_raw string, end_date_raw string,"
        " description string, is_current boolean, location string, company_website string"
    ),
    "bronze.raw_skills": "skill_id string, submission_id string, skill_name string, skill_category string",
    "bronze.rejected": "submission_id string not null, error string, rejected_at timestamp",
    "silver.silver_candidates": (
        "submission_id string not null, candidate_name string, email string, is_email_valid boolean, phone string, is_phone_valid boolean,"
        " linkedin string, github string, silver_processed_at timestamp not null"
    ),
    "silver.silver_work_experience": (
        "experience_id string not null, submission_id string not null, company_name string, job_title string, job_title_standardized string,"
        " seniority_level string, start_date date, end_date date, is_current boolean, location string, location_city string,"
        " location_country string, is_remote boolean, description string, company_website string, silver_processed_at timestamp not null"
    ),
    "silver.silver_skills": (
        "skill_id string not null, submission_id string not null, raw_skill string, normalized_skill string,"
        " silver_processed_at timestamp not null"
    ),
    "silver.dim_skills": "alias string not null, canonical_skill string not null",
    "silver.dim_job_titles": "job_title string not null, seniority_level string",
    "silver.dim_location_aliases": "location_token string not null, country string not null",
    "gold.signal_timeline_consistency": (
        f"submission_id string not null, confidence string not null, findings array<struct<{_FINDING.replace(' ', ':').replace(',:', ',')}>>,"
        " as_of_date date not null, evaluated_at timestamp not null"
    ),
    "gold.signal_responsibility_mismatch": (
        f"submission_id string not null, confidence string not null, findings array<struct<{_CLAIM.replace(' ', ':').replace(',:', ',')}>>,"
        " evaluated_at timestamp not null"
    ),
    "gold.signal_company_verification": (
        "submission_id string not null, experience_id string not null, company_name_cv string not null, matched_company_number string,"
        " matched_company_name string, status string not null, verified_at timestamp not null"
    ),
    "gold.company_search": "query_normalized string not null, results array<struct<company_number:string,title:string>>",
}
