"""Independent SQL for every query, for a relational oracle over the test tables.

The statements take other routes than the engine where there is a choice: flat
cohort rows instead of two lists, self-joins by position, plain conditional
``count(DISTINCT …)`` and comparisons of all dates. They share only the text
that derives the source tables.
"""

from __future__ import annotations

import re

from caseweave.sources.fixtures import VIEW_SQL

T1, T2 = "DATE '1997-01-01'", "DATE '1997-12-31'"
IN = f"BETWEEN {T1} AND {T2}"


def age(birth: str, at: str) -> str:
    """Completed years."""
    return (
        f"(year({at}) - year({birth})"
        f" - CAST(strftime({birth}, '%m%d') > strftime({at}, '%m%d') AS INT))"
    )


def plus_years(d: str, n: int) -> str:
    return f"CAST({d} + INTERVAL {n} YEAR AS DATE)"


def words(column: str, *texts: str) -> str:
    return "(" + " OR ".join(f"{column} ILIKE '%{t}%'" for t in texts) + ")"


CTES: dict[str, str] = {f"fx_{name}": sql.strip() for name, sql in VIEW_SQL.items()}

CTES["placed"] = """
SELECT *, row_number() OVER (PARTITION BY participant_id ORDER BY status_date, status_id) AS pos,
  row_number() OVER (PARTITION BY participant_id ORDER BY status_date DESC, status_id DESC) AS slot
FROM fx_pstatus WHERE status_date IS NOT NULL
"""


def spans(extra: str = "TRUE") -> str:
    return f"""
SELECT DISTINCT a.participant_id, p.first_name, p.last_name, a.status_date AS active_date,
  n.status_date AS closed_date
FROM placed a JOIN fx_participants p USING (participant_id)
LEFT JOIN placed n ON n.participant_id = a.participant_id AND n.pos = a.pos + 1
WHERE a.pstatus = 'Active' AND (n.pos IS NULL OR n.pstatus = 'Closed') AND {extra}
  AND a.status_date <= {T2} AND (n.status_date IS NULL OR n.status_date >= {T1})
"""


CTES["stints"] = spans()
CTES["stints5"] = spans("a.slot <= 5")
CTES["wide"] = (
    "SELECT participant_id, "
    + ", ".join(
        f"max(pstatus) FILTER (slot = {i}) AS pstatus{i}, "
        f"max(status_date) FILTER (slot = {i}) AS status_date{i}"
        for i in range(1, 6)
    )
    + " FROM placed WHERE slot <= 5 GROUP BY participant_id"
)
CTES["counted"] = """
SELECT s.*, (SELECT count(*) FROM stints o WHERE o.participant_id = s.participant_id) AS stint_count
FROM stints s
"""


def granted(keep_ungranted: bool) -> str:
    wanted = f"""({words('g.grant_type', 'jisc', 'yip', 'a2j', 'scan', 'crws', 'idhs vp', 'jac hd')}
      OR g.comments ILIKE '%crws%'{' OR g.grant_type IS NULL' if keep_ungranted else ''})"""
    allowed = (
        "(g.grant_type IS NULL OR lower(g.grant_type) <> 'scan outreach')"
        if keep_ungranted
        else "lower(g.grant_type) <> 'scan outreach'"
    )
    return f"""
SELECT c.participant_id, c.first_name, c.last_name, c.stint_count, c.active_date, c.closed_date,
  p.program_type, g.grant_type, g.start_date, g.end_date, g.comments
FROM counted c JOIN fx_participants p USING (participant_id)
LEFT JOIN fx_grant_type g USING (participant_id)
WHERE {wanted} AND {allowed}
  AND (g.end_date IS NULL OR (g.end_date >= {T1} AND g.start_date <= {T2}))
"""


CTES["spg"] = granted(False)
CTES["spg_all"] = granted(True)
CTES["cohort"] = f"""
SELECT f.*, CASE WHEN service_legal = 1 AND service_cm = 1 THEN 1 END AS hd,
  CASE WHEN program_type ILIKE '%rct%' THEN 1 END AS hd_rct,
  CASE WHEN program_type ILIKE '%rjcc%' THEN 1 END AS rjcc,
  CASE WHEN comments ILIKE '%crws%' OR grant_type ILIKE '%crws%' THEN 1 END AS crws,
  CASE WHEN lower(grant_type) IN ('idhs vp', 'jac hd') THEN 1 END AS vp
FROM (SELECT *,
  CASE WHEN {words('program_type', 'rct', 'legal representation')} THEN 1 END AS service_legal,
  CASE WHEN {words('program_type', 'rct', 'case management')}
    OR {words('grant_type', 'scan', 'jisc', 'yip')} THEN 1 END AS service_cm,
  CASE WHEN {words('grant_type', 'jisc', 'yip')} THEN 1 END AS cm_juv_divert,
  CASE WHEN grant_type ILIKE '%dfss - scan%' THEN 1 END AS cm_scan,
  CASE WHEN grant_type ILIKE '%scan outreach%' THEN 1 END AS cm_scan_outreach
  FROM spg) f
"""
CTES["mreport"] = f"""
SELECT c.* EXCLUDE (d), p.birth_date, p.race, p.gender,
  CAST(date_diff('day', active_date, {T2}) AS INT) AS days_to_t2,
  CASE WHEN d BETWEEN 0 AND 45 THEN '0-45' WHEN d BETWEEN 46 AND 90 THEN '46-90'
    WHEN d BETWEEN 91 AND 180 THEN '91-180' WHEN d BETWEEN 181 AND 270 THEN '181-270'
    ELSE '271+' END AS days_served,
  CASE WHEN closed_date <= {T2} THEN 'closed out' ELSE 'active client' END AS client_status,
  CASE WHEN active_date >= {T1} THEN 'new client' END AS new_client,
  CASE WHEN {T1} < {plus_years('p.birth_date', 18)} THEN 'juvenile' ELSE 'emerging adult' END AS age
FROM (SELECT *, date_diff('day', active_date, coalesce(closed_date, {T2})) AS d FROM cohort) c
JOIN fx_participants p USING (participant_id)
"""


def funder(grant: str, program: str) -> str:
    return f"""
SELECT c.*, CASE WHEN active_date {IN} THEN 'new' ELSE 'continuing' END AS new_client
FROM cohort c
WHERE active_date = (SELECT max(m.active_date) FROM cohort m
  WHERE m.participant_id = c.participant_id
    AND (m.grant_type ILIKE '%{grant}%' OR m.program_type ILIKE '%{program}%'))
"""


CTES["jac"] = funder("JAC HD", "JAC")
CTES["idhs_vp"] = funder("IDHS VP", "IDHS")
CTES["best_address"] = """
SELECT a.* FROM fx_address a WHERE NOT EXISTS (SELECT 1 FROM fx_address b
  WHERE b.participant_id = a.participant_id AND (b.primary_address > a.primary_address
    OR (b.primary_address = a.primary_address AND (b.entered_date > a.entered_date
      OR (b.entered_date = a.entered_date AND b.address_id < a.address_id)))))
"""
CTES["a2j"] = """
SELECT p.first_name, p.last_name, p.participant_id, p.gender, p.race,
  CASE WHEN lower(p.race) = 'hispanic/latinx' THEN 'Yes' ELSE 'Not Reported' END AS hispanic_latino,
  a.zip, l.juvenile_adult, l.case_type
FROM (SELECT participant_id FROM cohort WHERE grant_type ILIKE '%a2j%') c
JOIN fx_participants p USING (participant_id)
JOIN best_address a USING (participant_id)
LEFT JOIN (SELECT participant_id, string_agg(DISTINCT juvenile_adult, ', ' ORDER BY juvenile_adult) AS juvenile_adult,
    string_agg(DISTINCT case_type, ', ' ORDER BY case_type) AS case_type
  FROM fx_legal GROUP BY participant_id HAVING max(arrest_date) IS NOT NULL) l USING (participant_id)
"""
CTES["cases"] = """
SELECT l.*, c.active_date, c.closed_date FROM (SELECT DISTINCT participant_id, active_date, closed_date FROM cohort) c
JOIN fx_legal l USING (participant_id)
"""
CTES["recent_cases"] = """
SELECT cases.*, last_closed_date FROM cases JOIN fx_last_close USING (participant_id)
WHERE last_closed_date IS NULL OR arrest_date > last_closed_date
"""


def with_ctes(body: str) -> str:
    """Put the needed table expressions in front, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                need(CTES[name])
                order.append(name)

    need(body)
    head = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in order)
    return f"WITH {head}\n{body.strip()}" if order else body.strip()


FLAGS = (
    "service_legal, service_cm, cm_juv_divert, cm_scan, cm_scan_outreach, hd, hd_rct, rjcc, crws, vp"
)
PEOPLE = "(SELECT DISTINCT participant_id FROM cohort)"


def people_if(table: str, condition: str) -> str:
    """Distinct cohort participants with a row of a table."""
    return f"""SELECT count(DISTINCT c.participant_id) AS n_participants
FROM cohort c JOIN {table} x ON x.participant_id = c.participant_id WHERE {condition}"""


def tally(group: str, flags: dict[str, str], source: str, key: str = "participant_id") -> str:
    cols = ", ".join(
        f"count(DISTINCT CASE WHEN {cond} THEN {key} END) AS {name}"
        for name, cond in flags.items()
    )
    if not group:
        return f"SELECT {cols} FROM {source}"
    return f"SELECT {group}, {cols} FROM {source} GROUP BY {group}"


def percent(sql: str, label: str, columns: list[str], replace: bool) -> str:
    """Percent columns and a total row around a report."""

    def share(c: str) -> str:
        return (
            f"round_even(r.{c}::DOUBLE / nullif(t.{c}, 0)::DOUBLE * 100.0 * 100.0, 0) / 100.0"
        )

    if replace:
        body = ", ".join(f"{share(c)} AS {c}" for c in columns)
        total = ", ".join(f"sum({c})::DOUBLE AS {c}" for c in columns)
    else:
        body = ", ".join(f"r.{c}, {share(c)} AS percentage_{c}" for c in columns)
        total = ", ".join(
            f"sum({c})::BIGINT AS {c}, sum({c})::DOUBLE AS percentage_{c}" for c in columns
        )
    sums = ", ".join(f"sum({c}) AS {c}" for c in columns)
    return f"""SELECT r.{label}, {body} FROM ({sql}) r, (SELECT {sums} FROM ({sql}) s) t
UNION ALL SELECT 'Total' AS {label}, {total} FROM ({sql}) u"""


PROGRAM = {
    "hd": "hd = 1",
    "juv_div": "cm_juv_divert = 1",
    "rjcc": "rjcc = 1",
    "scan": "cm_scan = 1",
    "jac": "grant_type ILIKE '%jac%'",
    "idhs": "vp = 1 AND grant_type ILIKE '%idhs%'",
}
GRANT = {g: f"grant_type ILIKE '%{g}%'" for g in ("a2j", "idhs", "jac", "scan", "crws", "yip")}
CHARGE = {"felony": "charge ILIKE '%felony%'", "misdemeanor": "charge ILIKE '%misdemeanor%'"}
SUCCESS = (
    "hours > 0 AND (indirect_type IS NULL OR lower(indirect_type) <> 'unsuccessful attempt')"
)
FAILED = "(hours = 0 OR lower(indirect_type) = 'unsuccessful attempt')"
COHORT_PEOPLE = "cohort JOIN fx_participants USING (participant_id)"
JAC_PEOPLE = "jac JOIN fx_participants USING (participant_id)"


def dem_age(at: str, years: int, new: bool = False) -> str:
    flags = {
        "juvenile": f"{at} < {plus_years('birth_date', years)}",
        "adult": f"{age('birth_date', at)} BETWEEN {years} AND 25",
    }
    scope = f" WHERE active_date {IN}" if new else ""
    return tally("", flags, COHORT_PEOPLE + scope)


def race_gender(column: str, new: bool = False) -> str:
    scope = f"WHERE active_date {IN}" if new else ""
    return f"""SELECT {column}, count(DISTINCT participant_id) AS n_participants
FROM {COHORT_PEOPLE} {scope} GROUP BY {column}"""


def grant_tally(date: str = "", own: str = "") -> str:
    scope = f"WHERE {date} {IN} OR {own} {IN}" if date else ""
    return f"""SELECT grant_type, count(DISTINCT participant_id) AS n_participants
FROM cohort {scope} GROUP BY grant_type"""


def family(part: str, loose: str) -> tuple[str, str]:
    inside = f"regexp_matches(document_name, '{loose}', 'i')"
    strict = f"regexp_matches(document_name, '_{part}_[01][0-9][0-3][0-9][12][0-9]{{3}}$', 'i')"
    count = f"(SELECT CASE WHEN count(*) > 0 THEN count(*) FILTER ({strict}) END FROM fx_documents_unfiltered d WHERE d.participant_id = c.participant_id AND {inside})"
    has = f"(SELECT CASE WHEN count(*) > 0 THEN 'Yes' END FROM fx_documents_unfiltered d WHERE d.participant_id = c.participant_id AND {inside})"
    return count, has


def docs() -> str:
    families = {
        "assm_isp": ("ASSM_ISP", "ASSM|ISP|Matrix|service"),
        "fcs": ("FCS", "FCS|Crime"),
        "bp": ("BP", "BP|Buss"),
        "pcl": ("PCL", "PCL|PLC|Post-Traumatic"),
        "cdc": ("CDC", "CDC|Achievement|_AM*"),
    }
    cols = []
    for name, (part, loose) in families.items():
        count, has = family(part, loose)
        if name != "cdc":
            cols.append(f"{count} AS {name}_formatted")
        cols.append(f"{has} AS has_{name}")
    return f"""SELECT participant_id, {', '.join(cols)},
  (SELECT CASE WHEN count(*) > 0 THEN count(*) FILTER (lower(document_type) = 'assessments') END
   FROM fx_documents_unfiltered d WHERE d.participant_id = c.participant_id) AS assess
FROM {PEOPLE} c"""


def custody(years: int, at: str) -> str:
    texts = ", ".join(
        f"string_agg(DISTINCT t.{c}, ', ' ORDER BY t.{c}) AS {c}"
        for c in ("legal_status", "legal_status_detail", "custody_status", "comments")
    )
    return f"""SELECT t.participant_id, t.trunc_date AS recent_date, {texts}
FROM fx_trunc_legal t
WHERE t.participant_id IN (SELECT participant_id FROM {COHORT_PEOPLE}
    WHERE {at} > {plus_years('birth_date', years)})
  AND t.trunc_date = (SELECT max(m.trunc_date) FROM fx_trunc_legal m WHERE m.participant_id = t.participant_id)
GROUP BY t.participant_id, t.trunc_date"""


def custody_tally(years: int, at: str) -> str:
    return f"""SELECT custody_status, count(DISTINCT participant_id) AS n_participants
FROM ({custody(years, at)}) y GROUP BY custody_status"""


def involvement(timed: bool) -> str:
    def scope(c: str) -> str:
        return f"{c} {IN}" if timed else f"{c} IS NOT NULL"

    return f"""SELECT o.participant_id, o.charge, o.case_type,
  CASE WHEN o.case_outcome ILIKE 'plead%' THEN o.case_outcome || ' - ' || o.sentence ELSE o.case_outcome END AS case_outcome,
  coalesce(k.linkages_made, 0) AS linkages_made, coalesce(k.linkages_started, 0) AS linkages_started,
  coalesce(s.successful, 0) AS successful, coalesce(s.unsuccessful, 0) AS unsuccessful
FROM (SELECT participant_id, case_outcome,
    string_agg(DISTINCT class_prior_to_plea_trial, ', ' ORDER BY class_prior_to_plea_trial) AS charge,
    string_agg(DISTINCT case_type, ', ' ORDER BY case_type) AS case_type,
    string_agg(DISTINCT sentence, ', ' ORDER BY sentence) AS sentence
  FROM cases WHERE case_outcome_date {IN} GROUP BY participant_id, case_outcome) o
LEFT JOIN (SELECT participant_id, count(*) FILTER ({scope('linked_date')}) AS linkages_made,
    count(*) FILTER ({scope('start_date')}) AS linkages_started
  FROM fx_linkages WHERE lower(hub_initiated) = 'yes' GROUP BY participant_id) k USING (participant_id)
LEFT JOIN (SELECT participant_id, count(DISTINCT CASE WHEN {SUCCESS} THEN case_session_id END) AS successful,
    count(DISTINCT CASE WHEN {FAILED} THEN case_session_id END) AS unsuccessful
  FROM fx_case_sessions WHERE lower(session_casenote) = 'casenote' AND {scope('session_date')}
  GROUP BY participant_id) s USING (participant_id)"""


INVOLVED = "participant_id, linkages_made, linkages_started, successful, unsuccessful"
IN_ORDER = "case_outcome NULLS FIRST, charge NULLS FIRST, case_type NULLS FIRST"


def involvement_text(timed: bool) -> str:
    case = " || ' / ' || ".join(f"coalesce({c}, '-')" for c in ("case_outcome", "charge", "case_type"))
    return f"""SELECT {INVOLVED}, count(*) AS n_cases, string_agg({case}, '; ' ORDER BY {IN_ORDER}) AS cases
FROM ({involvement(timed)}) x GROUP BY {INVOLVED}"""


def involvement_wide(slots: int) -> str:
    cols = ", ".join(
        f"max({p}) FILTER (i = {i}) AS {p}_{i}"
        for i in range(1, slots + 1)
        for p in ("charge", "case_type", "case_outcome")
    )
    return f"""SELECT {INVOLVED}, {cols}, count(*) AS n_cases
FROM (SELECT *, row_number() OVER (PARTITION BY participant_id ORDER BY {IN_ORDER}) AS i
  FROM ({involvement(False)}) x) y GROUP BY {INVOLVED}"""


def involvement_widest() -> str:
    cell = " || '|' || ".join(f"coalesce({p}[i], '-')" for p in ("charge", "case_type", "case_outcome"))
    lists = ", ".join(f"list({p} ORDER BY {IN_ORDER}) AS {p}" for p in ("charge", "case_type", "case_outcome"))
    return f"""SELECT participant_id, n_cases, n_slots,
  array_to_string(list_transform(range(1, n_slots + 1), lambda i: {cell}), '|') AS cells
FROM (SELECT *, max(n_cases) OVER () AS n_slots FROM (
  SELECT participant_id, count(*) AS n_cases, {lists} FROM ({involvement(False)}) x GROUP BY participant_id) y) z"""


def reduction(timed: bool) -> str:
    scope = f"AND l.case_outcome_date {IN}" if timed else ""
    return f"""SELECT felony, count(*) AS n FROM (
  SELECT l.participant_id, CASE WHEN bool_or(a.ranking < b.ranking) THEN 'lowered' ELSE 'remained' END AS felony
  FROM cases l JOIN fx_felony_classes a ON lower(l.class_prior_to_plea_trial) = lower(a.class)
  JOIN fx_felony_classes b ON lower(l.class_after_plea_trial) = lower(b.class)
  WHERE TRUE {scope} GROUP BY l.participant_id) x GROUP BY felony"""


def outcomes(timed: bool, plea_only: bool = False) -> str:
    scope = f"WHERE case_outcome_date {IN}" if timed else ""
    plea = "lower(case_outcome) = 'plead guilty'" if timed else "case_outcome ILIKE 'plead%'"
    keep = "AND case_outcome ILIKE 'plead%'" if plea_only else ""
    ranked = f"""(SELECT * FROM (SELECT participant_id, case_outcome,
      string_agg(DISTINCT sentence, ', ' ORDER BY sentence) AS sentence
    FROM cases {scope} GROUP BY participant_id, case_outcome) g
  LEFT JOIN fx_highest_case USING (case_outcome))"""
    return f"""SELECT label AS case_outcome, count(label) AS n FROM (
  SELECT CASE WHEN {plea} THEN case_outcome || ' - ' || sentence ELSE case_outcome END AS label
  FROM {ranked} d
  WHERE NOT EXISTS (SELECT 1 FROM {ranked} e WHERE e.participant_id = d.participant_id AND e.ranking > d.ranking)
    {keep}) x
GROUP BY label"""


def statuses(lag1: int, lag2: int, scope: str = "TRUE") -> str:
    first = tally(
        "case_status_current", CHARGE,
        f"cases WHERE active_date <= arrest_date + {lag1} AND {scope} AND "
        + words("case_status_current", "case pending", "case closed", "probation"),
        "case_id",
    )
    second = tally(
        "case_outcome", CHARGE,
        f"cases WHERE active_date <= arrest_date + {lag2} AND {scope} AND case_outcome IS NOT NULL",
        "case_id",
    )
    return f"{first} UNION ALL {second}"


def one_case(timed: bool, literal: bool = False) -> str:
    scope = f"WHERE case_outcome_date {IN}" if timed else ""
    having = "" if literal else "HAVING count(DISTINCT case_id) = 1"
    return f"""SELECT case_outcome, count(case_outcome) AS n
FROM (SELECT * FROM fx_legal {scope}) l
WHERE participant_id IN (SELECT participant_id FROM cases {scope} GROUP BY participant_id {having})
GROUP BY case_outcome"""


def case_type(scope: str = "TRUE", key: str = "case_id") -> str:
    return tally("case_type", CHARGE, f"recent_cases WHERE {scope}", key)


FIRST_ARREST = (
    "arrest_date = (SELECT min(m.arrest_date) FROM recent_cases m"
    " WHERE m.participant_id = recent_cases.participant_id)"
)


def rearrested(timed: bool) -> str:
    scope = f"AND l.arrest_date {IN}" if timed else ""
    return f"""SELECT count(DISTINCT l.participant_id) AS n_participants FROM recent_cases l
JOIN recent_cases f ON f.participant_id = l.participant_id AND l.arrest_date > f.arrest_date
WHERE TRUE {scope}"""


def pending(day: str) -> str:
    return (
        f"x.arrest_date < {day} AND (lower(x.case_status_current) = 'case pending'"
        f" OR x.case_outcome_date > {day})"
    )


def edu_job(kind: str, sign: str, cutoff: str = T1, hub: bool = True, months: float = 0) -> str:
    limit = f"AND date_diff('day', active_date, linked_date) <= {months * 30.5}" if months else ""
    hub_text = "AND lower(hub_initiated) = 'yes'" if hub else ""
    return f"""SELECT count(DISTINCT c.participant_id) AS n_participants
FROM cohort c JOIN fx_participants p USING (participant_id) JOIN fx_linkages l USING (participant_id)
WHERE {cutoff} {sign} {plus_years('birth_date', 19)} AND lower(linkage_type) = '{kind}'
  AND linked_date > active_date {hub_text} {limit}"""


def goal_area(scope: str) -> str:
    return f"""SELECT separated_area, count(DISTINCT participant_id) AS n_participants FROM (
  SELECT l.participant_id, unnest(string_split(goal_area, ', ')) AS separated_area
  FROM fx_linkages l JOIN {PEOPLE} c USING (participant_id) WHERE {scope}) x GROUP BY separated_area"""


BOTH_DATES = f"(linked_date {IN} OR l.start_date {IN})"
HUB = "lower(hub_initiated) = 'yes'"


def sessions(kind: str, timed: bool) -> str:
    scope = f"AND x.session_date {IN}" if timed else ""
    return people_if("fx_case_sessions", f"lower(x.session_casenote) = '{kind}' {scope}")


def session_tally(kind: str) -> str:
    return tally(
        "", {"unsuccessful": FAILED, "successful": SUCCESS},
        f"fx_case_sessions JOIN {PEOPLE} c USING (participant_id) "
        f"WHERE session_date {IN} AND lower(session_casenote) = '{kind}'",
        "case_session_id",
    )


def session_length(kind: str, timed: bool) -> str:
    scope = f"AND session_date {IN}" if timed else ""
    return f"""SELECT round(avg(hours) * 60, 6) AS overall,
  round(avg(CASE WHEN {SUCCESS} THEN hours END) * 60, 6) AS successful
FROM cohort JOIN fx_case_sessions USING (participant_id)
WHERE lower(session_casenote) = '{kind}' {scope}"""


def session_bands(kind: str, timed: bool) -> str:
    scope = f"AND session_date {IN}" if timed else ""
    ok = "(contact_type IS NULL OR lower(contact_type) <> 'unsuccessful attempt')"
    edges = [
        ("0-.25", 0, 0.25), (".26-.5", 0.25, 0.5), (".51-.75", 0.5, 0.75), (".76-1", 0.75, 1),
        ("1-1.25", 1, 1.25), ("1.26-1.5", 1.25, 1.5), ("1.51-1.75", 1.5, 1.75),
        ("1.76-2", 1.75, 2),
    ]
    middle = " ".join(
        f"WHEN hours > {a} AND hours <= {b} AND {ok} THEN '{label}'" for label, a, b in edges
    )
    return f"""SELECT band AS session_length, count(band) AS n FROM (
  SELECT CASE WHEN hours = 0 OR lower(contact_type) = 'unsuccessful attempt' THEN '0' {middle}
    WHEN hours > 2 THEN '2+' END AS band
  FROM cohort JOIN fx_case_sessions USING (participant_id)
  WHERE lower(session_casenote) = '{kind}' {scope}) x GROUP BY band"""


def demographic(column: str) -> str:
    if column == "age":
        return tally("age", PROGRAM, "mreport")
    return tally(column, PROGRAM, COHORT_PEOPLE)


NEW_CLIENTS = "mreport WHERE new_client IS NOT NULL"


def by_status(flags: dict[str, str]) -> str:
    return (
        tally("client_status", flags, "mreport")
        + " UNION ALL "
        + f"SELECT 'new client' AS client_status, x.* FROM ({tally('', flags, NEW_CLIENTS)}) x"
    )


def by_time(flags: dict[str, str], closed: bool = False) -> str:
    scope = " WHERE client_status = 'closed out'" if closed else ""
    return tally("days_served", flags, "mreport" + scope)


def by_time_percent(flags: dict[str, str], closed: bool = False) -> str:
    return percent(by_time(flags, closed), "days_served", list(flags), replace=True)


def ages(bands: list[tuple[int, int]]) -> str:
    flags = {
        f"age_{a}_{b}": f"{age('birth_date', 'active_date')} BETWEEN {a} AND {b}" for a, b in bands
    }
    return tally("new_client", flags, JAC_PEOPLE)


def class_notes(new: bool, text: str = "2023 idhs vp", literal: bool = False) -> str:
    """Words by what ends them: the marks and spaces that the notes hold."""
    scope = f"WHERE start_date > {T1}" if new else ""
    shown = "acronym" if literal else "min(acronym) AS acronym"
    group = "acronym" if literal else "lower(acronym)"
    return f"""SELECT {shown}, count(*) AS n FROM (
  SELECT unnest(string_split_regex(summary_note, '[ ,;/]+')) AS acronym
  FROM fx_classes WHERE participant_id IN (SELECT participant_id FROM jac {scope})
    AND class ILIKE '%{text}%' AND (unenroll_date IS NULL OR unenroll_date {IN})) x
WHERE acronym <> '' GROUP BY {group}"""


def service_tally(program: str) -> str:
    flags = {
        "outreach": f"program_type ILIKE '%{program} - outreach%'",
        "cm": f"program_type ILIKE '%{program} - case%'",
        "legal": f"program_type ILIKE '%{program} - legal%'",
    }
    return tally("new_client", flags, "jac")


def funder_linkages(program: str) -> str:
    return tally(
        "separated_area",
        {"new_links": "new_client = 'new'", "cont_links": "new_client = 'continuing'"},
        f"""(SELECT l.linkage_id, j.new_client, unnest(string_split(l.goal_area, ', ')) AS separated_area
  FROM jac j JOIN fx_linkages l USING (participant_id)
  WHERE j.program_type ILIKE '%{program} - case%' AND {HUB} AND l.linked_date {IN}) x""",
        "linkage_id",
    )


def managed(program: str) -> str:
    return (
        "(SELECT DISTINCT participant_id FROM jac"
        f" WHERE program_type ILIKE '%{program} - case management%')"
    )


CM_SESSIONS = f"session_date {IN} AND lower(session_casenote) = 'casenote'"


def cm_hours(program: str) -> str:
    return f"""SELECT round(avg(h), 6) AS overall_avg FROM (SELECT participant_id, sum(hours) AS h
  FROM fx_case_sessions JOIN {managed(program)} m USING (participant_id) WHERE {CM_SESSIONS}
  GROUP BY participant_id) x"""


def cm_sessions(program: str) -> str:
    return f"""SELECT count(DISTINCT case_session_id)::DOUBLE / nullif(count(DISTINCT participant_id), 0)::DOUBLE AS avg_sessions
FROM fx_case_sessions JOIN {managed(program)} m USING (participant_id)
WHERE {CM_SESSIONS} AND {SUCCESS}"""


PACKAGES = [
    ("service_legal", "Legal"), ("service_cm", "Case Management"), ("cm_juv_divert", "YIP"),
    ("cm_scan", "SCaN"), ("cm_scan_outreach", "SCaN Outreach"), ("hd", "HD"), ("rjcc", "RJCC"),
    ("crws", "CRwS"), ("vp", "VP"),
]


def packages() -> str:
    label = "concat_ws(' + ', " + ", ".join(
        f"max(CASE WHEN {c} = 1 THEN '{t}' END)" for c, t in PACKAGES
    ) + ")"
    some = " OR ".join(f"{c} = 1" for c, _ in PACKAGES)
    return f"""SELECT concatenated_services, count(*) AS n,
  count(*)::DOUBLE / (SELECT count(DISTINCT participant_id) FROM cohort WHERE {some})::DOUBLE AS percentage
FROM (SELECT participant_id, {label} AS concatenated_services FROM cohort WHERE {some} GROUP BY participant_id) x
GROUP BY concatenated_services"""


def rct() -> str:
    flags = {
        "overall": "program_type ILIKE '%rct%'",
        "lawndale": "program_type ILIKE '%rct,%' OR lower(program_type) = 'rct' OR program_type ILIKE '%, rct'",
        "austin": "program_type ILIKE '%rct - build%'",
        "little_village": "program_type ILIKE '%rct - nlc%'",
        "east_garfield_park": "program_type ILIKE '%rct - breakthrough%'",
        "south_side": "program_type ILIKE '%rct - target%'",
    }
    return tally("", flags, "cohort")


def anomalies(*years: int, slots: str = "TRUE") -> str:
    return f"""SELECT a.participant_id, first_name, last_name, a.pstatus, a.status_date,
  n.status_date AS next_date
FROM placed a JOIN placed n ON n.participant_id = a.participant_id AND n.pos = a.pos + 1
JOIN fx_participants p ON p.participant_id = a.participant_id
WHERE a.pstatus = n.pstatus AND a.pstatus IN ('Active', 'Closed') AND {slots}
  AND EXISTS (SELECT 1 FROM placed a WHERE a.participant_id = p.participant_id
    AND year(a.status_date) IN ({', '.join(map(str, years))}) AND {slots})"""


def case_tally(slots: str = "TRUE") -> str:
    """Each class counted on its own over all pairs of neighbouring statuses."""
    when = {"before": f"< {T1}", "in": IN, "after": f"> {T2}", "open": "IS NULL"}
    classes = {
        "#2": ("in", "before"), "#3": ("after", "before"), "#4": ("open", "before"),
        "#5": ("in", "in"), "#6": ("after", "in"), "#7": ("open", "in"),
        "#8": ("after", "after"), "#9": ("open", "after"),
    }
    return " UNION ALL ".join(
        f"""SELECT '{label}' AS case_label, count(DISTINCT participant_id) AS n_participants,
  count(*) AS n_rows FROM (
    SELECT DISTINCT a.participant_id, a.status_date AS began, n.status_date AS ended
    FROM placed a LEFT JOIN placed n ON n.participant_id = a.participant_id AND n.pos = a.pos + 1
    WHERE a.pstatus = 'Active' AND (n.pos IS NULL OR n.pstatus = 'Closed') AND {slots}
      AND a.participant_id IN (SELECT participant_id FROM fx_participants)) e
WHERE ended {when[c]} AND began {when[b]}"""
        for label, (c, b) in classes.items()
    )


def concat_rows() -> str:
    cols = [
        "program_type", "active_date", "closed_date", "grant_type", *FLAGS.split(", "),
    ]
    body = ", ".join(
        f"string_agg(DISTINCT CAST({c} AS VARCHAR), ',' ORDER BY CAST({c} AS VARCHAR)) AS {c}"
        for c in cols
    )
    return f"""SELECT participant_id, first_name, last_name, {body}
FROM cohort GROUP BY participant_id, first_name, last_name"""


def neighborhood(latest: bool) -> str:
    ranked = f"""SELECT n.participant_id, location, primary_address, entered_date, updated_date, neighborhood,
  CAST(row_number() OVER (PARTITION BY n.participant_id ORDER BY primary_address DESC NULLS LAST,
    entered_date DESC NULLS LAST, CASE WHEN neighborhood NOT ILIKE '%other%' THEN 1 ELSE 0 END,
    address_id) AS INT) AS rn
FROM fx_neighborhoods n
JOIN (SELECT DISTINCT first_name, last_name, participant_id FROM cohort) s USING (participant_id)"""
    return f"SELECT * FROM ({ranked}) r WHERE rn = 1" if latest else ranked


INCIDENTS = f"fx_critical_incidents WHERE date_incident {IN}"
SINCE = f"(arrest_date {IN} OR active_date {IN})"

BODIES: dict[str, str] = {
    # cohort pipeline
    "status_wide": "SELECT * FROM wide",
    "stints": "SELECT * FROM stints",
    "stints_max_slots": "SELECT * FROM stints5",
    "status_anomalies": anomalies(1997, 1998),
    "status_anomalies_max_slots": anomalies(1997, 1998, slots="a.slot <= 5"),
    "max_status_count": "SELECT max(n) AS max_status_count FROM (SELECT count(status_id) AS n FROM fx_pstatus WHERE year(status_date) IN (1997, 1998) GROUP BY participant_id) x",
    "stint_case_tally": case_tally(),
    "stint_case_tally_max_slots": case_tally("a.slot <= 5"),
    "stint_count": "SELECT participant_id, count(*) AS stint_count FROM stints GROUP BY participant_id",
    "stints_plus_count": "SELECT * FROM counted",
    "stint_totals": "SELECT count(*) AS n_rows, count(DISTINCT participant_id) AS n_participants FROM stints",
    "stints_programs_grants": "SELECT * FROM spg",
    "stints_programs_grants_ungranted": "SELECT * FROM spg_all",
    "classify_by_program": "SELECT * FROM cohort",
    "mreport": "SELECT * FROM mreport",
    "classify_concat": concat_rows(),
    "grant_cohort": "SELECT * FROM jac",
    "grant_cohort_idhs_vp": "SELECT * FROM idhs_vp",
    "a2j_cohort": "SELECT * FROM a2j",
    "hd_cohort": "SELECT * FROM cohort WHERE hd = 1",
    # demographics
    "dem_age_tally": dem_age("active_date", 18),
    "dem_age_tally_t1": dem_age(T1, 21),
    "dem_age_tally_new_clients": dem_age("active_date", 18, new=True),
    "dem_age_list": f"SELECT cohort.*, CASE WHEN active_date < {plus_years('birth_date', 18)} THEN 'Juvenile' ELSE 'Adult' END AS age_group FROM {COHORT_PEOPLE}",
    "dem_race_gender": race_gender("race"),
    "dem_race_gender_folded": race_gender("race"),
    "dem_race_gender_new_clients": race_gender("gender", new=True),
    "dem_recent_address": f"SELECT s.first_name, s.last_name, a.* FROM (SELECT DISTINCT participant_id, first_name, last_name FROM cohort) s JOIN best_address a USING (participant_id)",
    "dem_recent_address_neighborhood": neighborhood(False),
    "dem_recent_address_neighborhood_latest": neighborhood(True),
    # documents, grants, incidents, mediation
    "docs_has_formatted": docs(),
    "grant_tally": grant_tally(),
    "grant_tally_started": grant_tally("start_date", "active_date"),
    "grant_tally_ended": grant_tally("end_date", "closed_date"),
    "incident_tally": f"SELECT count(incident_id) FILTER (how_hear ILIKE '%cpic%') AS cpic, count(incident_id) FILTER (how_hear NOT ILIKE '%cpic%') AS non_cpic FROM {INCIDENTS}",
    "mediation_tally": f"SELECT outcome_mediation, count(outcome_mediation) AS n FROM fx_mediations WHERE date_start_mediation {IN} GROUP BY outcome_mediation",
    "mediation_tally_followup": f"SELECT outcome_mediation, count(outcome_mediation) AS n FROM fx_mediation_followup WHERE date_session {IN} GROUP BY outcome_mediation",
    "mediation_time_spent": f"SELECT sum(hours_spent_mediation) AS hours FROM fx_mediations WHERE date_conflict {IN}",
    "incidents_cpic": f"SELECT type_incident, count(incident_id) FILTER (num_deceased > 0) AS fatal, count(incident_id) FILTER (num_deceased = 0) AS non_fatal FROM {INCIDENTS} AND how_hear ILIKE '%cpic%' GROUP BY type_incident",
    "incidents_non_cpic": f"SELECT how_hear, count(incident_id) AS n FROM {INCIDENTS} AND how_hear NOT ILIKE '%cpic%' GROUP BY how_hear",
    # legal
    "legal_tally": people_if("fx_legal", f"x.arrest_date < {T2}"),
    "legal_tally_pending": people_if("fx_legal", f"x.arrest_date < {T2} AND ({words('x.case_status_current', 'diversion', 'pending')} OR x.case_outcome_date > {T1})"),
    "legal_custody_tally": custody_tally(19, "active_date"),
    "legal_custody_tally_t2": custody_tally(21, T2),
    "legal_custody_list": custody(19, "active_date"),
    "legal_in_custody_links": f"""SELECT count(DISTINCT c.participant_id) AS n_participants FROM cohort c
JOIN fx_trunc_legal t USING (participant_id) JOIN fx_linkages k USING (participant_id)
WHERE t.trunc_date = (SELECT max(m.trunc_date) FROM fx_trunc_legal m WHERE m.participant_id = t.participant_id)
  AND t.custody_status = 'In Custody (+)' AND c.active_date <= t.trunc_date + 45""",
    "legal_program_involvement_long": involvement(False),
    "legal_program_involvement": involvement_text(False),
    "legal_program_involvement_timeframe": involvement_text(True),
    "legal_program_involvement_wide": involvement_wide(8),
    "legal_program_involvement_widest": involvement_widest(),
    "legal_fel_reduction": reduction(True),
    "legal_fel_reduction_all": reduction(False),
    "legal_case_outcomes": outcomes(True),
    "legal_case_outcomes_all": outcomes(False),
    "legal_plea_outcomes": outcomes(True, plea_only=True),
    "legal_case_statuses": statuses(60, 60),
    "legal_case_statuses_window": statuses(45, 30, f"case_outcome_date {IN}"),
    "legal_case_statuses_opened": statuses(45, 30, f"arrest_date {IN}"),
    "legal_one_case": one_case(True),
    "legal_one_case_all": one_case(False),
    "legal_one_case_literal": one_case(True, literal=True),
    "legal_case_type": case_type(),
    "legal_case_type_opened": case_type(SINCE),
    "legal_case_type_closed": case_type(f"case_outcome_date {IN}"),
    "legal_case_type_clients": case_type(key="participant_id"),
    "legal_case_type_percentage": percent(case_type(), "case_type", ["felony", "misdemeanor"], replace=False),
    "legal_case_type_first": case_type(FIRST_ARREST),
    "legal_pending_cases": people_if("fx_legal", pending(T1)),
    "legal_pending_cases_t2": people_if("fx_legal", pending(T2)),
    "legal_pending_and_ended": people_if("fx_legal", f"{pending(T1)} AND EXISTS (SELECT 1 FROM fx_legal e WHERE e.participant_id = c.participant_id AND e.case_outcome_date {IN})"),
    "legal_rearrested": rearrested(True),
    "legal_rearrested_all": rearrested(False),
    # linkages
    "link_tally": people_if("fx_linkages", "lower(x.hub_initiated) = 'yes'"),
    "link_tally_all": people_if("fx_linkages", "TRUE"),
    "link_tally_linked": people_if("fx_linkages", f"lower(x.hub_initiated) = 'yes' AND x.linked_date {IN}"),
    "link_tally_both": people_if("fx_linkages", f"lower(x.hub_initiated) = 'yes' AND (x.linked_date {IN} OR x.start_date {IN})"),
    "link_education": edu_job("education", "<"),
    "link_education_first_months": edu_job("education", "<", hub=False, months=3),
    "link_employment": edu_job("employment", ">"),
    "link_employment_active_date": edu_job("employment", ">", cutoff="active_date", months=6),
    "link_goal_area": goal_area(f"linked_date {IN} AND {HUB}"),
    "link_goal_area_both": goal_area(f"{BOTH_DATES} AND {HUB}"),
    "link_goal_area_all": goal_area("TRUE"),
    # programs and sessions
    "programs_packages": packages(),
    "programs_service_tally": "SELECT count(DISTINCT participant_id) AS n_participants FROM cohort WHERE hd = 1",
    "outreach_tally": "SELECT count(DISTINCT participant_id) AS n_participants FROM cohort WHERE program_type ILIKE '%outreach%'",
    "programs_sessions": sessions("casenote", True),
    "programs_sessions_outreach_all": sessions("mentoring session", False),
    "programs_session_tally": session_tally("casenote"),
    "programs_session_tally_outreach": session_tally("mentoring session"),
    "programs_by_demographic": demographic("race"),
    "programs_by_demographic_age": demographic("age"),
    "programs_by_demographic_percentages": percent(demographic("gender"), "gender", list(PROGRAM), replace=True),
    "programs_session_length": session_length("casenote", True),
    "programs_session_length_outreach_all": session_length("mentoring session", False),
    "programs_session_length_grouped": session_bands("casenote", True),
    "programs_session_length_grouped_all": session_bands("mentoring session", False),
    "programs_rct_neighborhoods": rct(),
    # report classes
    "a2j_cases": f"SELECT a.*, o.offense_date, o.case_outcome_date, o.case_outcome, o.sentence FROM a2j a JOIN fx_legal o USING (participant_id) WHERE o.arrest_date {IN}",
    "a2j_cases_ended": f"SELECT a.*, o.offense_date, o.case_outcome_date, o.case_outcome, o.sentence FROM a2j a JOIN fx_legal o USING (participant_id) WHERE o.case_outcome_date {IN}",
    "a2j_linkages": f"SELECT a.*, l.linkage_type, l.linkage_org, l.goal_area FROM a2j a JOIN fx_linkages l USING (participant_id) WHERE l.linked_date {IN}",
    "grouped_by_status_program": by_status({**PROGRAM, "vp": "vp = 1"}),
    "grouped_by_status_no_new_clients": by_status({**PROGRAM, "vp": "vp = 1"}).replace(
        "mreport", f"(SELECT * FROM mreport WHERE active_date < {T1})"
    ),
    "grouped_by_status_grant": by_status(GRANT),
    "grouped_by_time_program": by_time(PROGRAM),
    "grouped_by_time_program_percentages": by_time_percent(PROGRAM, closed=True),
    "grouped_by_time_grant": by_time(GRANT, closed=True),
    "grouped_by_time_grant_percentages": by_time_percent(GRANT),
    "idhs_ages": ages([(0, 17), (18, 25)]),
    "idhs_ages_ppr": ages([(0, 5), (6, 10), (11, 13), (14, 17), (18, 25)]),
    "idhs_tally": "SELECT new_client, count(DISTINCT participant_id) AS n_participants FROM jac GROUP BY new_client",
    "idhs_tally_closed": f"SELECT count(DISTINCT participant_id) AS n_participants FROM jac WHERE end_date {IN} OR closed_date {IN}",
    "idhs_class_notes": class_notes(False),
    "idhs_class_notes_literal": class_notes(False, literal=True),
    "idhs_class_notes_other_class": class_notes(False, "other"),
    "idhs_class_notes_new": class_notes(True),
    "idhs_linkages": funder_linkages("jac"),
    "idhs_race_gender": f"SELECT new_client, race, count(race) AS n FROM {JAC_PEOPLE} GROUP BY new_client, race",
    "idhs_language": f"SELECT new_client, language_primary, count(DISTINCT participant_id) AS n_participants FROM {JAC_PEOPLE} GROUP BY new_client, language_primary",
    "idhs_service_tally": service_tally("jac"),
    "jac_cm_hours": cm_hours("jac"),
    "jac_cm_sessions": cm_sessions("jac"),
    "jac_transpo_assist": "SELECT count(DISTINCT participant_id) AS n_participants FROM jac WHERE program_type ILIKE '%jac%' AND crws = 1",
    "jac_linked_participant_tally": "SELECT count(DISTINCT j.participant_id) AS n_participants FROM jac j JOIN fx_linkages l USING (participant_id) WHERE l.start_date IS NOT NULL",
    # frame level
    "percentage_convert": percent(race_gender("race"), "race", ["n_participants"], replace=False),
    "query_modify": f"SELECT grant_type, count(DISTINCT participant_id) AS n_participants FROM cohort WHERE closed_date IS NULL AND hd = 1 GROUP BY grant_type",
    "query_run": f"SELECT count(DISTINCT participant_id) AS n_participants FROM cohort WHERE active_date >= {T1}",
}


def spelled(column: str) -> str:
    """Four spellings of a text, by participant."""
    return (
        f"CASE participant_id % 4 WHEN 0 THEN upper({column}) WHEN 1 THEN {column} || '  '"
        f" WHEN 2 THEN replace({column}, 'i', 'í') ELSE {column} END"
    )


def same_text(column: str) -> str:
    return f"lower(strip_accents(rtrim({column})))"


VARIANTS = {
    "dem_race_gender_variants": f"""SELECT min(spelling) AS race, count(DISTINCT participant_id) AS n_participants
FROM (SELECT participant_id, {spelled('race')} AS spelling FROM {COHORT_PEOPLE}) x GROUP BY {same_text('spelling')}""",
    "legal_one_case_variants": f"""SELECT min(spelling) AS case_outcome, count(spelling) AS n
FROM (SELECT participant_id, {spelled('case_outcome')} AS spelling FROM fx_legal WHERE case_outcome_date {IN}) l
WHERE participant_id IN (SELECT participant_id FROM cases WHERE case_outcome_date {IN}
  GROUP BY participant_id HAVING count(DISTINCT case_id) = 1)
GROUP BY {same_text('spelling')}""",
    "legal_case_type_variants": "SELECT min(spelling) AS case_type, "
    + ", ".join(f"count(DISTINCT CASE WHEN {c} THEN case_id END) AS {n}" for n, c in CHARGE.items())
    + f" FROM (SELECT *, {spelled('case_type')} AS spelling FROM recent_cases) x GROUP BY {same_text('spelling')}",
    "link_goal_area_variants": f"""SELECT min(spelling) AS separated_area, count(DISTINCT participant_id) AS n_participants
FROM (SELECT l.participant_id, unnest(string_split({spelled('goal_area').replace('participant_id', 'l.participant_id')}, ', ')) AS spelling
  FROM fx_linkages l JOIN {PEOPLE} c USING (participant_id) WHERE {HUB}) x GROUP BY {same_text('spelling')}""",
}
BODIES |= VARIANTS


def report_blocks(blocks: dict[str, str]) -> str:
    """Rows per block of a report."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS block, count(*) AS n_rows FROM ({sql}) b{i}"
        for i, (name, sql) in enumerate(blocks.items())
    )


def listed(column: str, *values: str) -> str:
    """Place of a value in a list, behind all others if it is not there."""
    names = ", ".join(f"'{v}'" for v in values)
    return f"coalesce(list_position([{names}], lower({column})), 99)"


DAYS = listed("days_served", "0-45", "46-90", "91-180", "181-270")
TIME_ORDER = f"days_served = 'Total', {DAYS}"
TYPES = ("property", "gun", "battery", "drug", "attempted murder", "murder", "other")
STATUSES = ("case pending", "case closed", "dismissed", "plead guilty", "found guilty")
BANDS = ("0", "0-.25", ".26-.5", ".51-.75", ".76-1", "1-1.25", "1.26-1.5", "1.51-1.75", "1.76-2", "2+")


def label_last(column: str) -> str:
    return f"coalesce({column} = 'Total', FALSE), {column} NULLS LAST"


# Order of the rows of queries that have one.
ORDERS = {
    "legal_case_type": f"case_type IS NULL, {listed('case_type', *TYPES)}, case_type",
    "legal_case_type_percentage": f"coalesce(case_type = 'Total', FALSE), {listed('case_type', *TYPES)}",
    "legal_case_statuses": f"case_status_current IS NULL, {listed('case_status_current', *STATUSES)}, case_status_current",
    "programs_packages": "n DESC, concatenated_services",
    "programs_session_length_grouped": f"session_length IS NOT NULL, {listed('session_length', *BANDS)}",
    "grouped_by_status_program": listed("client_status", "active client", "new client", "closed out"),
    "grouped_by_time_program": DAYS,
    "grouped_by_time_program_percentages": TIME_ORDER,
    "programs_by_demographic_percentages": label_last("gender"),
}


def report_rows(blocks: dict[str, str], orders: dict[str, str] | None = None) -> str:
    """Every row of every block as text, numbers with four decimals; numbered where a block
    has an order."""
    numeric = "('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', 'FLOAT', 'DOUBLE')"
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS block, {"rn" if name in (orders or {}) else "NULL::BIGINT"} AS "row",
    content, count(*) AS n FROM (
  SELECT rn, string_agg(field || '=' || coalesce(value, 'NULL'), '; ' ORDER BY field) AS content
  FROM (SELECT rn, CASE WHEN typeof(COLUMNS(* EXCLUDE rn)) IN {numeric}
      THEN CAST(TRY_CAST(COLUMNS(* EXCLUDE rn) AS DECIMAL(38, 4)) AS VARCHAR)
      ELSE CAST(COLUMNS(* EXCLUDE rn) AS VARCHAR) END
    FROM (SELECT row_number() OVER ({"ORDER BY " + orders[name] if name in (orders or {}) else ""}) AS rn, b{i}.*
      FROM ({sql}) b{i}))
  UNPIVOT INCLUDE NULLS (value FOR field IN (COLUMNS(* EXCLUDE rn))) GROUP BY rn) GROUP BY ALL"""
        for i, (name, sql) in enumerate(blocks.items())
    )


def of_jac(sql: str) -> str:
    return sql.replace(COHORT_PEOPLE, JAC_PEOPLE)


CM_OUTREACH = {
    "receiving CM": "SELECT count(DISTINCT participant_id) AS n_participants FROM mreport WHERE service_cm = 1",
    "Had CM Session in Month": BODIES["programs_sessions"],
    "CM Session Count": BODIES["programs_session_tally"],
    "CM Session Length": BODIES["programs_session_length"],
    "CM Session Length (Grouped)": BODIES["programs_session_length_grouped"],
    "Had Outreach Session in Month": sessions("mentoring session", True),
    "Outreach Session Count": BODIES["programs_session_tally_outreach"],
    "linkage tally": BODIES["link_tally_linked"],
    "services linked": BODIES["link_goal_area_both"],
}
BODIES["run_report"] = report_blocks(CM_OUTREACH)
BODIES["run_report_cm_outreach"] = report_rows(
    CM_OUTREACH, {"CM Session Length (Grouped)": ORDERS["programs_session_length_grouped"]}
)
BODIES["run_report_a2j"] = report_rows({
    "CASES_STARTED": BODIES["a2j_cases"],
    "CASES_ENDED": BODIES["a2j_cases_ended"],
    "LINKAGES": BODIES["a2j_linkages"],
})
BODIES["run_report_program_grant"] = report_rows({
    "grant involvement": BODIES["grant_tally"],
    "grants started": BODIES["grant_tally_started"],
    "grants ended": BODIES["grant_tally_ended"],
    "Program Involvement by Days - All": by_time_percent(PROGRAM),
    "Program Involvement by Days - Closed": by_time_percent(PROGRAM, True),
    **{
        f"PROGRAMS BY {c.upper()}": percent(demographic(c), c, list(PROGRAM), replace=True)
        for c in ("race", "gender", "age")
    },
    "ALL_DAYS_SERVED_BY_GRANT": by_time_percent(GRANT),
    "CLOSED_DAYS_SERVED_BY_GRANT": by_time_percent(GRANT, True),
    "PACKAGE OF SERVICES": BODIES["programs_packages"],
}, {
    "Program Involvement by Days - All": TIME_ORDER,
    "Program Involvement by Days - Closed": TIME_ORDER,
    "ALL_DAYS_SERVED_BY_GRANT": TIME_ORDER,
    "CLOSED_DAYS_SERVED_BY_GRANT": TIME_ORDER,
    "PACKAGE OF SERVICES": ORDERS["programs_packages"],
    **{f"PROGRAMS BY {c.upper()}": label_last(c) for c in ("race", "gender", "age")},
})
BODIES["run_report_legal"] = report_rows({
    "CiviCore.Legal Tally": BODIES["legal_tally"],
    "Case Pending Tally": BODIES["legal_tally_pending"],
    "Case Type - All Cases": BODIES["legal_case_type_percentage"],
    "Case Type - Opened": BODIES["legal_case_type_opened"],
    "Case Type - Closed": BODIES["legal_case_type_closed"],
    "Rearrested": BODIES["legal_rearrested"],
    "Pending Cases": BODIES["legal_pending_cases_t2"],
    "Case Outcomes": BODIES["legal_case_outcomes"],
    "Guilty Plea Outcomes": BODIES["legal_plea_outcomes"],
}, {
    "Case Type - All Cases": ORDERS["legal_case_type_percentage"],
    "Case Type - Opened": ORDERS["legal_case_type"],
    "Case Type - Closed": ORDERS["legal_case_type"],
})
BODIES["run_report_jac"] = report_rows({
    "participant count": BODIES["idhs_tally"],
    "genders": of_jac(race_gender("gender")),
    "races": of_jac(race_gender("race")),
    "ages": of_jac(BODIES["dem_age_tally"]),
    "services": BODIES["idhs_service_tally"],
    "avg hours spent on CM": BODIES["jac_cm_hours"],
    "avg number of CM sessions": BODIES["jac_cm_sessions"],
    "transportation assistance": BODIES["jac_transpo_assist"],
    "connected to other providers": BODIES["jac_linked_participant_tally"],
    "referrals": BODIES["idhs_linkages"],
})
BODIES["run_report_cvi"] = report_rows({
    "total participants": BODIES["idhs_tally"],
    "ages": BODIES["idhs_ages"],
    "races": BODIES["idhs_race_gender"],
    "genders": BODIES["idhs_race_gender"].replace("race", "gender"),
    "languages": BODIES["idhs_language"],
    "services": BODIES["idhs_service_tally"],
    "referrals": BODIES["idhs_linkages"],
    "number of mediations": BODIES["mediation_tally"],
    "CPIC notifications": BODIES["incidents_cpic"],
    "non-CPIC notifications": BODIES["incidents_non_cpic"],
    "time spent on mediations": BODIES["mediation_time_spent"],
})
BODIES["run_report_ppr"] = report_rows({
    "new and continuing clients": BODIES["idhs_tally"],
    "closed clients": BODIES["idhs_tally_closed"],
    "outreach and legal": BODIES["idhs_service_tally"],
    "race": of_jac(race_gender("race")),
    "gender": of_jac(race_gender("gender")),
    "ages": BODIES["idhs_ages_ppr"],
    "eligibility": BODIES["idhs_class_notes_new"],
    "cm linkages": BODIES["idhs_linkages"],
    "initial mediations": BODIES["mediation_tally"],
    "followup mediations": BODIES["mediation_tally_followup"],
    "incidents": BODIES["incident_tally"],
})


def oracle() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in BODIES.items()}
