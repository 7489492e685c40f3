"""Declared schemas of the landed entities. Members whose shape differs by row are VARIANT.

Nothing is inferred on read: page dumps differ by project.
"""

from __future__ import annotations

WORKSPACE = "*"

CROSSWALK = "entity string, scope string, source_key string, target_key string"

TRACE = (
    "event string, ts timestamp_ntz, project_source string, project_target string, "
    "source_run_id bigint, target_run_id bigint, chunk_index int, chunk_size int, "
    "attempt int, http_status int, error string"
)

ENTITIES = {
    "project": "id bigint, code string, title string, description string, access string, settings variant",
    "user": (
        "id bigint, email string, name string, is_active boolean, role string, "
        "uuid string, author_uuid string, type string"
    ),
    "author": "id bigint, uuid string",
    "group": "id string, displayName string, members variant",
    "custom_field": (
        "id bigint, title string, entity variant, type variant, value variant, "
        "projects_codes array<string>, is_enabled_for_all_projects boolean, is_filterable boolean, "
        "is_visible boolean, is_required boolean, default_value string"
    ),
    "shared_parameter": (
        "id string, title string, type string, is_enabled_for_all_projects boolean, "
        "project_codes array<string>, parameters variant"
    ),
    "milestone": "id bigint, parent_id bigint, title string, description string, status string, due_date string",
    "configuration_group": "id bigint, title string, configs variant, configurations variant, entities variant",
    "environment": "id bigint, title string, slug string, host string, description string",
    "shared_step": "hash string, title string, steps variant",
    "suite": (
        "id bigint, parent_id bigint, title string, name string, description string, preconditions string"
    ),
    "case": (
        "id bigint, suite_id bigint, milestone_id bigint, title string, description string, "
        "preconditions string, postconditions string, severity int, priority int, type int, "
        "behavior int, automation int, status int, is_flaky int, member_id variant, created_by variant, "
        "author_id variant, created_at string, updated_at string, tags variant, attachments variant, "
        "custom_fields variant, custom_field variant, params variant, parameters variant, steps variant, "
        "steps_type string, suite_title string, suite variant, suites variant"
    ),
    "plan": "id bigint, title string, description string, cases variant",
    "run": (
        "id bigint, title string, description string, user_id variant, created_by variant, "
        "author_id variant, member_id variant, start_time string, end_time string, is_completed variant, "
        "is_complete variant, completed_at string, time_end string, finished_at string, closed_at string, "
        "complete_time string, state variant, status variant, run_status variant, runStatus variant, "
        "execution_state variant, executionState variant, plan_id bigint, plan variant, milestone_id bigint, "
        "milestone variant, environment_id bigint, cases variant, configurations variant, stats variant, "
        "counters variant, statistics variant, results_count bigint, tests_count bigint, "
        "cases_count bigint, total_tests bigint"
    ),
    "result": (
        "run_id bigint, hash string, result_hash string, id bigint, case_id variant, status_id int, "
        "status string, author_uuid string, member_id variant, author_id variant, user_id variant, "
        "created_by variant, title string, case_title string, caseTitle string, name string, start_time string, end_time string, "
        "test_case variant, TestCase variant, test_case_id variant, CaseId variant, comment string, message string, "
        "text string, stacktrace string, time_spent_ms variant, time_ms variant, duration_ms variant, "
        "time variant, duration variant, execution variant, steps variant, step_results variant, "
        "elements variant, result_steps variant, test_results variant, substeps variant, "
        "attachments variant, files variant, screenshots variant, media variant, images variant, "
        "evidence variant, artifacts variant, params variant, param variant, parameters variant, "
        "param_groups variant, signature string, defect boolean, case variant, suite_title string, "
        "suite variant, suites variant"
    ),
    "defect": (
        "id bigint, title string, actual_result string, severity string, status variant, "
        "author_id variant, member_id variant, milestone_id variant, attachments variant"
    ),
}

# Natural key of each entity, within its scope.
KEYS = {
    "project": "code", "user": "id", "author": "uuid", "group": "id", "custom_field": "id",
    "shared_parameter": "id", "milestone": "id", "configuration_group": "id", "environment": "id",
    "shared_step": "hash", "suite": "id", "case": "id", "plan": "id", "run": "id", "result": "hash",
    "defect": "id",
}


def fields(entity: str) -> list[tuple[str, str]]:
    """(name, type) of each declared member; only top-level commas separate members here."""
    return [tuple(part.strip().split(" ", 1)) for part in ENTITIES[entity].split(",")]


def struct_of(ddl: str) -> str:
    """A flat column list written as a struct type."""
    return "struct<" + ", ".join(
        "`{}`:{}".format(*part.strip().split(" ", 1)) for part in ddl.split(",")
    ) + ">"
