"""Document checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave import fixed_values as fv
from caseweave.functions.matching import ci_contains, ci_contains_any, ci_eq, ci_rlike, flag
from caseweave.operators.cohort import PID, AnyCohort, as_cohort


def docs_has_formatted(cohort: AnyCohort | DataFrame, documents: DataFrame) -> DataFrame:
    """Per participant and document family: number of well-named documents, and
    whether there is any document of the family; plus the number of assessments.

    All families are read in one aggregation of the documents.
    """
    out: list[Column] = []
    shown: list[str] = []
    for name, part, texts in fv.DOCUMENT_FAMILIES:
        in_family = ci_contains_any("document_name", texts)
        # The substring test spares most names the regex.
        well_named = ci_contains("document_name", f"_{part}_") & ci_rlike(
            "document_name", f"_{part}_{fv.DOCUMENT_DATE_SUFFIX}"
        )
        any_doc = F.max(flag(in_family)) == 1
        formatted = F.count(flag(in_family & well_named))
        out.append(F.when(any_doc, formatted).alias(f"{name}_formatted"))
        out.append(F.when(any_doc, F.lit("Yes")).alias(f"has_{name}"))
        shown += [f"{name}_formatted", f"has_{name}"]
    assess = F.count(flag(ci_eq("document_type", "Assessments"))).alias("assess")
    per_person = documents.where(F.col(PID).isNotNull()).groupBy(PID).agg(*out, assess)
    shown.remove("cdc_formatted")
    return as_cohort(cohort).people().join(per_person, PID, "left").select(PID, *shown, "assess")
