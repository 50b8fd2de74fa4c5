"""Labels, terms, patterns and lags that reports must reproduce exactly."""

# Status names in the status history.
ACTIVE = "Active"
CLOSED = "Closed"

# Grant terms that bring a grant row into the cohort, and the grant left out.
COHORT_GRANT_TERMS = ["jisc", "yip", "a2j", "scan", "crws", "idhs vp", "jac hd"]
COHORT_COMMENT_TERM = "crws"
EXCLUDED_GRANT = "SCaN Outreach"

# Days-served bands of the monthly cohort (label, first day, last day).
DAYS_SERVED_BANDS = [("0-45", 0, 45), ("46-90", 46, 90), ("91-180", 91, 180), ("181-270", 181, 270)]
DAYS_SERVED_REST = "271+"

# Client status and age labels.
CLIENT_STATUS_ORDER = ["active client", "new client", "closed out"]
JUVENILE = "juvenile"
EMERGING_ADULT = "emerging adult"

# Fixed value: what the names of the funder's classes hold.
CLASS_TEXT = "2023 IDHS VP"

# Document families (name, part of a well-formed name, texts that mark the family).
DOCUMENT_FAMILIES = [
    ("assm_isp", "ASSM_ISP", ["ASSM", "ISP", "Matrix", "service"]),
    ("fcs", "FCS", ["FCS", "Crime"]),
    ("bp", "BP", ["BP", "Buss"]),
    ("pcl", "PCL", ["PCL", "PLC", "Post-Traumatic"]),
    ("cdc", "CDC", ["CDC", "Achievement", "_A"]),
]
DOCUMENT_DATE_SUFFIX = "[01][0-9][0-3][0-9][12][0-9]{3}$"

# Order of case statuses and case types in legal reports.
CASE_STATUS_ORDER = ["Case Pending", "Case Closed", "Dismissed", "Plead Guilty", "Found Guilty"]
CASE_STATUS_TERMS = ["Case Pending", "Case Closed", "Probation"]
CASE_TYPE_ORDER = [
    "property", "gun", "battery", "drug", "attempted murder", "murder", "other",
]

# Days allowed between an event and the start of service.
STATUS_LAG_DAYS = 60
STATUS_LAG_DAYS_WINDOW = 45
OUTCOME_LAG_DAYS_WINDOW = 30
CUSTODY_LAG_DAYS = 45
DAYS_PER_MONTH = 30.5

# Session kinds and the mark of a failed contact.
SESSION_KINDS = {"cm": "Casenote", "outreach": "Mentoring Session"}
UNSUCCESSFUL = "Unsuccessful Attempt"

# Session length bands in hours (label, above, up to).
SESSION_LENGTH_BANDS = [
    ("0-.25", 0, 0.25),
    (".26-.5", 0.25, 0.5),
    (".51-.75", 0.5, 0.75),
    (".76-1", 0.75, 1),
    ("1-1.25", 1, 1.25),
    ("1.26-1.5", 1.25, 1.5),
    ("1.51-1.75", 1.5, 1.75),
    ("1.76-2", 1.75, 2),
]

# Service flags and their names in package labels, in label order.
PACKAGE_LABELS = [
    ("service_legal", "Legal"),
    ("service_cm", "Case Management"),
    ("cm_juv_divert", "YIP"),
    ("cm_scan", "SCaN"),
    ("cm_scan_outreach", "SCaN Outreach"),
    ("hd", "HD"),
    ("rjcc", "RJCC"),
    ("crws", "CRwS"),
    ("vp", "VP"),
]

# Columns a grant row brings into the cohort, and the flags of the classifier.
COHORT_GRANT_COLUMNS = ["grant_type", "start_date", "end_date", "comments"]
FLAG_COLUMNS = [
    "service_legal", "service_cm", "cm_juv_divert", "cm_scan", "cm_scan_outreach", "hd", "hd_rct",
    "rjcc", "crws", "vp",
]

# Texts of the classifier's rules.
RCT_PROGRAM = "RCT"
LEGAL_PROGRAM = "legal representation"
CM_PROGRAM = "case management"
CM_GRANT = "scan"
JUVENILE_GRANTS = ["JISC", "YIP"]
SCAN_GRANT = "dfss - scan"
SCAN_OUTREACH_GRANT = "scan outreach"
RJCC_PROGRAM = "rjcc"
CRWS_TEXT = "crws"
VP_GRANTS = ["IDHS VP", "JAC HD"]

# Grant texts of the program columns.
JAC_TEXT = "JAC"
IDHS_TEXT = "IDHS"

# Grant columns of the monthly reports and the text that marks them.
GRANT_COLUMNS = [
    ("a2j", "A2J"), ("idhs", "IDHS"), ("jac", "JAC"), ("scan", "SCAN"), ("crws", "CRwS"),
    ("yip", "YIP"),
]

# Program text per neighborhood partner.
RCT_NEIGHBORHOODS = [
    ("austin", "RCT - BUILD"),
    ("little_village", "RCT - NLC"),
    ("east_garfield_park", "RCT - Breakthrough"),
    ("south_side", "RCT - Target"),
]

# Age bands of funder reports (alias, first year, last year).
AGE_BANDS = [("age_0_17", 0, 17), ("age_18_25", 18, 25)]
AGE_BANDS_PPR = [
    ("age_0_5", 0, 5), ("age_6_10", 6, 10), ("age_11_13", 11, 13), ("age_14_17", 14, 17),
    ("age_18_25", 18, 25),
]
