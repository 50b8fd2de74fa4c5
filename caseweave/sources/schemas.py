"""Declared schemas of the source tables."""

from __future__ import annotations

from pyspark.sql import types as T

_COLUMNS = {
    "pstatus": "status_id BIGINT, participant_id BIGINT, status_date DATE, pstatus STRING",
    "participants": "participant_id BIGINT, first_name STRING, last_name STRING, birth_date DATE, "
    "race STRING, gender STRING, language_primary STRING, program_type STRING",
    "grant_type": "participant_id BIGINT, grant_type STRING, start_date DATE, end_date DATE, "
    "comments STRING",
    "legal": "case_id BIGINT, participant_id BIGINT, arrest_date DATE, offense_date DATE, "
    "charge STRING, case_type STRING, juvenile_adult STRING, case_status_current STRING, "
    "case_outcome STRING, case_outcome_date DATE, sentence STRING, conditions_notes STRING, "
    "class_prior_to_plea_trial STRING, class_after_plea_trial STRING",
    "trunc_legal": "participant_id BIGINT, trunc_date DATE, legal_status STRING, "
    "legal_status_detail STRING, custody_status STRING, comments STRING",
    "linkages": "linkage_id BIGINT, participant_id BIGINT, linkage_type STRING, "
    "linkage_org STRING, goal_area STRING, linked_date DATE, start_date DATE, "
    "hub_initiated STRING",
    "case_sessions": "case_session_id BIGINT, participant_id BIGINT, session_date DATE, "
    "session_casenote STRING, hours DOUBLE, indirect_type STRING, contact_type STRING",
    "address": "address_id BIGINT, participant_id BIGINT, primary_address STRING, "
    "entered_date DATE, zip STRING",
    "neighborhoods": "address_id BIGINT, participant_id BIGINT, location STRING, "
    "primary_address STRING, entered_date DATE, updated_date DATE, neighborhood STRING",
    "critical_incidents": "incident_id BIGINT, how_hear STRING, date_incident DATE, "
    "type_incident STRING, num_deceased INT",
    "mediations": "outcome_mediation STRING, date_start_mediation DATE, date_conflict DATE, "
    "hours_spent_mediation DOUBLE",
    "mediation_followup": "outcome_mediation STRING, date_session DATE",
    "classes": "participant_id BIGINT, class STRING, unenroll_date DATE, summary_note STRING",
    "documents_unfiltered": "participant_id BIGINT, document_name STRING, document_type STRING",
    "highest_case": "case_outcome STRING, ranking INT",
    "felony_classes": "class STRING, ranking INT",
    "last_close": "participant_id BIGINT, last_closed_date DATE",
}

_TYPES: dict[str, T.DataType] = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = [c.split() for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Built without a session, so that importing the package starts nothing.
SCHEMAS: dict[str, T.StructType] = {name: _struct(cols) for name, cols in _COLUMNS.items()}
