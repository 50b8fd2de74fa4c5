
from __future__ import annotations

import importlib.util
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.functions.dates import ReportWindow
from caseweave.functions.percentages import percentage_convert
from caseweave.operators import classify as cl
from caseweave.operators import episodes as ep
from caseweave.plans import context as cx
from caseweave.plans import reports as rp
from caseweave.plans.adhoc import query_modify, query_run, register_views
from caseweave.plans.queries import run_query
from caseweave.session import tune
from caseweave.sources.catalog import Sources
from caseweave.sources.fixtures import fixture_sources

# The subpackage llm and the pipeline over it may be taken out of the repository.
HAS_LLM = importlib.util.find_spec("caseweave.llm") is not None

WINDOW = ReportWindow("1997-01-01", "1997-12-31")
YEARS = (1997, 1998)

Query = Callable[[SparkSession, str], DataFrame]
Context = Callable[[SparkSession, str], cx.ReportContext]


@lru_cache(maxsize=8)
def _kept_sources(app: str, spark: SparkSession, sf_dir: str) -> Sources:
    """Sources keep what they measure, for all queries of the application."""
    return fixture_sources(spark, sf_dir)


def _sources(spark: SparkSession, sf_dir: str) -> Sources:
    return _kept_sources(spark.sparkContext.applicationId, tune(spark), sf_dir)


def _general(spark: SparkSession, sf_dir: str) -> cx.ReportContext:
    return cx.general_context(_sources(spark, sf_dir), WINDOW)


def _monthly(spark: SparkSession, sf_dir: str) -> cx.ReportContext:
    return cx.monthly_context(_sources(spark, sf_dir), WINDOW)


def _jac(spark: SparkSession, sf_dir: str) -> cx.ReportContext:
    return cx.funder_context(_sources(spark, sf_dir), WINDOW, "jac")


def _a2j(spark: SparkSession, sf_dir: str) -> cx.ReportContext:
    return cx.a2j_context(_sources(spark, sf_dir), WINDOW)


def _query(context: Context, name: str, **options: object) -> Query:
    return lambda spark, sf_dir: run_query(context(spark, sf_dir), name, **options)


def _rounded(query: Query, *columns: str) -> Query:
    """Averages of doubles depend on the order of addition in the last digits."""
    return lambda spark, sf_dir: query(spark, sf_dir).withColumns(
        {c: F.round(c, 6) for c in columns}
    )


def _stints(spark: SparkSession, sf_dir: str, max_slots: int | None = None) -> DataFrame:
    s = _sources(spark, sf_dir)
    return ep.stints(s.pstatus, s.participants, WINDOW, max_slots)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.status_wide(_sources(spark, sf_dir).pstatus, slots=5)


def _anomalies(spark: SparkSession, sf_dir: str, max_slots: int | None = None) -> DataFrame:
    s = _sources(spark, sf_dir)
    return ep.status_anomalies(s.pstatus, s.participants, YEARS, max_slots)


def _case_tally(spark: SparkSession, sf_dir: str, max_slots: int | None = None) -> DataFrame:
    s = _sources(spark, sf_dir)
    return ep.stint_case_tally(s.pstatus, s.participants, WINDOW, max_slots)


def _involvement(program_timeframe: bool) -> Query:
    """The outcomes as text, in which form any oracle can return them."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ctx = _general(spark, sf_dir)
        found = run_query(ctx, "legal_program_involvement", program_timeframe=program_timeframe)
        texts = F.transform(
            "cases",
            lambda c: F.concat_ws(
                " / ", *[F.coalesce(c[p], F.lit("-")) for p in ("case_outcome", "charge", "case_type")]
            ),
        )
        return found.withColumn("cases", F.array_join(texts, "; "))

    return query


def _widest_involvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as wide as the data needs, its cells as one text, as its columns vary."""
    wide = run_query(_general(spark, sf_dir), "legal_program_involvement_wide")
    cells = wide.columns[5:-1]
    return wide.select(
        cl.PID,
        "n_cases",
        F.lit(len(cells) // 3).cast("bigint").alias("n_slots"),
        F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in cells]).alias("cells"),
    )


def _no_new_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cohort in which nobody is new: the row of new clients is there with zeros."""
    ctx = _monthly(spark, sf_dir)
    old = ctx.cohort.where_episode(F.col("active_date") < F.lit(WINDOW.t1).cast("date"))
    return run_query(
        cx.ReportContext(ctx.sources, ctx.window, old), "grouped_by_status", program_grant="program"
    )


def _folded_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of one race are one group after loading with canonical spellings."""
    s = _sources(spark, sf_dir)
    mixed = s.participants.withColumn(
        "race",
        F.when(F.col(cl.PID) % 2 == 0, F.upper("race")).otherwise(F.concat("race", F.lit(" "))),
    )
    spellings = {"participants": {"race": ["Black", "Hispanic/Latinx", "White", "Asian"]}}
    tidy = s.replaced(participants=mixed).normalised(spellings)
    return run_query(cx.general_context(tidy, WINDOW), "dem_race_gender", race_gender="race")


def _spelled(column: str) -> Column:
    """Spellings of one text: in capitals, with a trailing blank, with an accent."""
    return (
        F.when(F.col(cl.PID) % 4 == 0, F.upper(column))
        .when(F.col(cl.PID) % 4 == 1, F.concat(column, F.lit("  ")))
        .when(F.col(cl.PID) % 4 == 2, F.replace(F.col(column), F.lit("i"), F.lit("í")))
        .otherwise(F.col(column))
    )


def _variants(table: str, column: str, name: str, **options: object) -> Query:
    """A query over a table in which a category is spelled in four ways."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = _sources(spark, sf_dir)
        mixed = s.replaced(**{table: s[table].withColumn(column, _spelled(column))})
        return run_query(cx.general_context(mixed, WINDOW), name, **options)

    return query


def _programs_grants(spark: SparkSession, sf_dir: str, keep_ungranted: bool = False) -> DataFrame:
    sources = _sources(spark, sf_dir)
    return cl.grants_cohort(sources, WINDOW, keep_ungranted=keep_ungranted).rows()


def _idhs_vp(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = _sources(spark, sf_dir)
    return cx.funder_context(sources, WINDOW, "idhs", "IDHS VP", "IDHS").cohort.rows()


def _percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = run_query(_general(spark, sf_dir), "dem_race_gender", race_gender="race")
    return percentage_convert(counts, replace=False, order=[F.col("race")])


def _modified(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = _general(spark, sf_dir)
    still_open = ctx.cohort.rows().transform(
        query_modify, F.col("closed_date").isNull(), F.col("hd") == 1
    )
    flat = cx.as_cohort(still_open)
    return run_query(cx.ReportContext(ctx.sources, WINDOW, flat), "grant_tally")


def _adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(_general(spark, sf_dir), prefix="cw_", sources=())
    return query_run(
        spark,
        "SELECT count(DISTINCT participant_id) AS n_participants FROM cw_cohort "
        "WHERE active_date >= :since",
        {"since": WINDOW.t1},
    )


def _bundle(report: rp.Report, context: Context) -> Query:
    return lambda spark, sf_dir: rp.run_report(report, context(spark, sf_dir))


def _report_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per block of a monthly report bundle."""
    blocks = rp.build_report(rp.MONTHLY_CM_OUTREACH, _monthly(spark, sf_dir))
    sizes = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(block).alias("block"), "n_rows")
        for block, df in blocks.items()
    ]
    return reduce(DataFrame.unionByName, sizes)


def entry(spark: SparkSession) -> DataFrame:
    """Program involvement by client status over the monthly cohort."""
    ctx = _monthly(spark, "/root/testdata/sf0.001")
    return run_query(ctx, "grouped_by_status", program_grant="program")


def queries() -> dict[str, Query]:
    return _report_queries() | _llm_queries()


def _llm_queries() -> dict[str, Query]:
    if not HAS_LLM:
        return {}
    from caseweave.llm.queries import QUERIES

    if importlib.util.find_spec("corpus_pipeline") is None:
        return dict(QUERIES)
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def _report_queries() -> dict[str, Query]:
    g, m, j, a = _general, _monthly, _jac, _a2j
    return {
        # cohort pipeline
        "status_wide": _wide,
        "stints": _stints,
        "stints_max_slots": lambda s, d: _stints(s, d, max_slots=5),
        "status_anomalies": _anomalies,
        "status_anomalies_max_slots": lambda s, d: _anomalies(s, d, max_slots=5),
        "max_status_count": lambda s, d: ep.max_status_count(
            _sources(s, d).pstatus, YEARS
        ),
        "stint_case_tally": _case_tally,
        "stint_case_tally_max_slots": lambda s, d: _case_tally(s, d, max_slots=5),
        "stint_count": lambda s, d: ep.stint_count(_stints(s, d)),
        "stints_plus_count": lambda s, d: ep.with_stint_count(_stints(s, d)),
        "stint_totals": lambda s, d: ep.stint_totals(_stints(s, d)),
        "stints_programs_grants": _programs_grants,
        "stints_programs_grants_ungranted": lambda s, d: _programs_grants(s, d, True),
        "classify_by_program": lambda s, d: g(s, d).cohort.rows(),
        "mreport": lambda s, d: m(s, d).cohort.rows(),
        "classify_concat": lambda s, d: cl.classify_concat(g(s, d).cohort),
        "grant_cohort": lambda s, d: j(s, d).cohort.rows(),
        "grant_cohort_idhs_vp": _idhs_vp,
        "a2j_cohort": lambda s, d: a(s, d).cohort.rows(),
        "hd_cohort": lambda s, d: cx.hd_context(_sources(s, d), WINDOW).cohort.rows(),
        # demographics
        "dem_age_tally": _query(g, "dem_age_tally"),
        "dem_age_tally_t1": _query(g, "dem_age_tally", age=21, cutoff="t1"),
        "dem_age_tally_new_clients": _query(g, "dem_age_tally", new_clients=True),
        "dem_age_list": _query(g, "dem_age_list"),
        "dem_race_gender": _query(g, "dem_race_gender", race_gender="race"),
        "dem_race_gender_folded": _folded_races,
        "dem_race_gender_new_clients": _query(
            g, "dem_race_gender", race_gender="gender", new_clients=True
        ),
        "dem_recent_address": _query(g, "dem_recent_address"),
        "dem_recent_address_neighborhood": _query(g, "dem_recent_address_neighborhood"),
        "dem_recent_address_neighborhood_latest": _query(
            g, "dem_recent_address_neighborhood", latest_only=True
        ),
        # documents, grants, incidents, mediation
        "docs_has_formatted": _query(g, "docs_has_formatted"),
        "grant_tally": _query(g, "grant_tally"),
        "grant_tally_started": _query(g, "grant_tally", start_end="start_date"),
        "grant_tally_ended": _query(g, "grant_tally", start_end="end_date"),
        "incident_tally": _query(g, "incident_tally"),
        "mediation_tally": _query(g, "mediation_tally"),
        "mediation_tally_followup": _query(g, "mediation_tally", followup=True),
        "mediation_time_spent": _query(g, "mediation_time_spent"),
        "incidents_cpic": _query(g, "incidents_cpic"),
        "incidents_non_cpic": _query(g, "incidents_non_cpic"),
        # legal
        "legal_tally": _query(g, "legal_tally"),
        "legal_tally_pending": _query(g, "legal_tally", pending=True),
        "legal_custody_tally": _query(g, "legal_custody_tally"),
        "legal_custody_tally_t2": _query(g, "legal_custody_tally", age=21, cutoff="t2"),
        "legal_custody_list": _query(g, "legal_custody_list"),
        "legal_in_custody_links": _query(g, "legal_in_custody_links"),
        "legal_program_involvement_long": _query(g, "legal_program_involvement_long"),
        "legal_program_involvement": _involvement(program_timeframe=False),
        "legal_program_involvement_timeframe": _involvement(program_timeframe=True),
        "legal_program_involvement_widest": _widest_involvement,
        "legal_program_involvement_wide": _query(g, "legal_program_involvement_wide", slots=8),
        "legal_fel_reduction": _query(g, "legal_fel_reduction"),
        "legal_fel_reduction_all": _query(g, "legal_fel_reduction", timeframe=False),
        "legal_case_outcomes": _query(g, "legal_case_outcomes"),
        "legal_case_outcomes_all": _query(g, "legal_case_outcomes", timeframe=False),
        "dem_race_gender_variants": _variants(
            "participants", "race", "dem_race_gender", race_gender="race"
        ),
        "legal_one_case_variants": _variants("legal", "case_outcome", "legal_one_case"),
        "legal_case_type_variants": _variants("legal", "case_type", "legal_case_type"),
        "link_goal_area_variants": _variants(
            "linkages", "goal_area", "link_goal_area", timeframe=False
        ),
        "legal_plea_outcomes": _query(g, "legal_plea_outcomes"),
        "legal_case_statuses": _query(g, "legal_case_statuses"),
        "legal_case_statuses_window": _query(g, "legal_case_statuses", timeframe=True),
        "legal_case_statuses_opened": _query(
            g, "legal_case_statuses", timeframe=True, opened_closed="opened"
        ),
        "legal_one_case": _query(g, "legal_one_case"),
        "legal_one_case_all": _query(g, "legal_one_case", timeframe=False),
        "legal_one_case_literal": _query(g, "legal_one_case", literal=True),
        "legal_case_type": _query(g, "legal_case_type"),
        "legal_case_type_opened": _query(g, "legal_case_type", timeframe=True),
        "legal_case_type_closed": _query(
            g, "legal_case_type", timeframe=True, opened_closed="closed"
        ),
        "legal_case_type_clients": _query(g, "legal_case_type", case_client="client"),
        "legal_case_type_percentage": _query(g, "legal_case_type", percentage=True),
        "legal_case_type_first": _query(g, "legal_case_type_first"),
        "legal_pending_cases": _query(g, "legal_pending_cases"),
        "legal_pending_cases_t2": _query(g, "legal_pending_cases", at="t2"),
        "legal_pending_and_ended": _query(g, "legal_pending_and_ended"),
        "legal_rearrested": _query(g, "legal_rearrested"),
        "legal_rearrested_all": _query(g, "legal_rearrested", timeframe=False),
        # linkages
        "link_tally": _query(g, "link_tally"),
        "link_tally_all": _query(g, "link_tally", hub_initiated=False),
        "link_tally_linked": _query(g, "link_tally", timeframe=True),
        "link_tally_both": _query(g, "link_tally", timeframe=True, started_linked="both"),
        "link_education": _query(g, "link_edu_job", link_type="education"),
        "link_education_first_months": _query(
            g, "link_edu_job", link_type="education", hub_initiated=False, first_n_months=3
        ),
        "link_employment": _query(g, "link_edu_job", link_type="employment"),
        "link_employment_active_date": _query(
            g, "link_edu_job", link_type="employment", cutoff="active_date", first_n_months=6
        ),
        "link_goal_area": _query(g, "link_goal_area"),
        "link_goal_area_both": _query(g, "link_goal_area", started_linked="both"),
        "link_goal_area_all": _query(g, "link_goal_area", timeframe=False, hub_initiated=False),
        # programs and sessions
        "programs_packages": _query(g, "programs_packages"),
        "programs_service_tally": _query(g, "programs_service_tally", service_column="hd"),
        "outreach_tally": _query(g, "outreach_tally"),
        "programs_sessions": _query(g, "programs_sessions"),
        "programs_sessions_outreach_all": _query(
            g, "programs_sessions", timeframe=False, cm_outreach="outreach"
        ),
        "programs_session_tally": _query(g, "programs_session_tally"),
        "programs_session_tally_outreach": _query(
            g, "programs_session_tally", cm_outreach="outreach"
        ),
        "programs_by_demographic": _query(g, "programs_by_demographic", demographic="race"),
        "programs_by_demographic_age": _query(g, "programs_by_demographic", demographic="age"),
        "programs_by_demographic_percentages": _query(
            m, "programs_by_demographic", demographic="gender", percentages=True
        ),
        "programs_session_length": _rounded(
            _query(g, "programs_session_length"), "overall", "successful"
        ),
        "programs_session_length_outreach_all": _rounded(
            _query(g, "programs_session_length", cm_outreach="outreach", timeframe=False),
            "overall",
            "successful",
        ),
        "programs_session_length_grouped": _query(g, "programs_session_length_grouped"),
        "programs_session_length_grouped_all": _query(
            g, "programs_session_length_grouped", cm_outreach="outreach", timeframe=False
        ),
        "programs_rct_neighborhoods": _query(g, "programs_rct_neighborhoods"),
        # report classes
        "a2j_cases": _query(a, "a2j_cases"),
        "a2j_cases_ended": _query(a, "a2j_cases", started_ended="ended"),
        "a2j_linkages": _query(a, "a2j_linkages"),
        "grouped_by_status_program": _query(m, "grouped_by_status", program_grant="program"),
        "grouped_by_status_no_new_clients": _no_new_clients,
        "grouped_by_status_grant": _query(m, "grouped_by_status", program_grant="grant"),
        "grouped_by_time_program": _query(
            m, "grouped_by_time", program_grant="program", percentages=False
        ),
        "grouped_by_time_program_percentages": _query(
            m, "grouped_by_time", program_grant="program", closed_only=True
        ),
        "grouped_by_time_grant": _query(
            m, "grouped_by_time", program_grant="grant", closed_only=True, percentages=False
        ),
        "grouped_by_time_grant_percentages": _query(m, "grouped_by_time", program_grant="grant"),
        "idhs_ages": _query(j, "idhs_ages"),
        "idhs_ages_ppr": _query(j, "idhs_ages", ppr=True),
        "idhs_tally": _query(j, "idhs_tally"),
        "idhs_tally_closed": _query(j, "idhs_tally_closed"),
        "idhs_class_notes": _query(j, "idhs_class_notes"),
        "idhs_class_notes_literal": _query(j, "idhs_class_notes", literal=True),
        "idhs_class_notes_other_class": _query(j, "idhs_class_notes", class_text="other"),
        "idhs_class_notes_new": _query(j, "idhs_class_notes", new=True),
        "idhs_linkages": _query(j, "idhs_linkages"),
        "idhs_race_gender": _query(j, "idhs_race_gender", race_gender="race"),
        "idhs_language": _query(j, "idhs_language"),
        "idhs_service_tally": _query(j, "idhs_service_tally"),
        "jac_cm_hours": _rounded(_query(j, "jac_cm_hours"), "overall_avg"),
        "jac_cm_sessions": _query(j, "jac_cm_sessions"),
        "jac_transpo_assist": _query(j, "jac_transpo_assist"),
        "jac_linked_participant_tally": _query(j, "jac_linked_participant_tally"),
        # frame level
        "percentage_convert": _percentages,
        "query_modify": _modified,
        "query_run": _adhoc,
        "run_report": _report_sizes,
        "run_report_a2j": _bundle(rp.A2J_REPORT, a),
        "run_report_program_grant": _bundle(rp.MONTHLY_PROGRAM_GRANT, m),
        "run_report_legal": _bundle(rp.MONTHLY_LEGAL, m),
        "run_report_cm_outreach": _bundle(rp.MONTHLY_CM_OUTREACH, m),
        "run_report_jac": _bundle(rp.JAC_SMARTSHEET, j),
        "run_report_cvi": _bundle(rp.CVI, j),
        "run_report_ppr": _bundle(rp.PPR, j),
    }


def oracle_sql() -> dict[str, str]:
    from verification.oracle import oracle

    return oracle() | _llm_oracle()


def _llm_oracle() -> dict[str, str]:
    if not HAS_LLM:
        return {}
    from caseweave.llm.queries import ORACLE

    if importlib.util.find_spec("corpus_pipeline") is None:
        return dict(ORACLE)
    import corpus_pipeline

    sql = corpus_pipeline.ORACLE_SQL
    return ORACLE | ({"pipeline": sql} if sql else {})
