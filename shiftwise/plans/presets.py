"""The original reporting jobs, ready to run on tables shaped as they are today.

Each ``*_from_tables`` function takes DataFrames with the original column
names, renames them to the job's input contract and runs the job with the
original settings (every setting stays overridable).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.plans import domain_counts as DC
from shiftwise.plans import staffing as S
from shiftwise.plans.slots import slot_report
from shiftwise.plans.utilisation import UtilisationParams, utilisation_summary
from shiftwise.sources.readers import read_source
from shiftwise.sources.sinks import write_table

# --- fixed values of the original jobs: business constants and the original
# --- table column names, as given (not derived) -----------------------------
OUTLOOK_FILTER_NAMES = ["Staffing Outlook", "EHS Staffing Outlook", "ESS Staffing Outlook"]
OUTLOOK_START = "2025-07-13"
OUTLOOK_END = "2025-08-31"
OUTLOOK_CONTRACT_CUTOFF = "2025-01-12"
OUTLOOK_CLUSTER_BY = ["DateTime", "VerintWfmStaffingMapViewName"]
RECORD_TYPE_LABELS = {
    "0124P000000bg6GQAQ": "Alert",
    "0124P000000bg6HQAQ": "Issue",
    "0124P000000bg6IQAQ": "Question",
    "0124P000000bg6JQAQ": "Reference",
}
BANNED_DOMAIN = "Testing Admin Only"
DOMAIN_RELABEL = {"SO Admin": "SO Operating Enablement"}
BASE_CLICK_SOURCES = ["CKit KM Archive", "Salesforce KH"]
VIEW_CLICK_SOURCES = ["CKit KM Archive", "Salesforce KM"]
EXCLUDED_FLAG_STATUS = ["Draft", "Withdrawn"]
LINK_USE = "Use"
LINK_REFERENCE = "Reference"
GOVERNANCE = ["Experience-Based", "Rule-Based"]
AS_OF_DATE = "2025-06-30"
LIST_SEPARATOR = ";"
SLOT_START = "2023-03-08"
SLOT_END = "2023-04-07"
SLOT_EXCLUDED_WINDOWS = [("2022-11-06 02:00:00", "2022-11-06 02:45:00"),
                         ("2023-03-13 04:00:00", "2023-03-13 04:45:00")]

# Original column name -> input contract name (fixed values as well).
CLICK_COLUMNS = {"click_Id": "click_id"}
ARTICLE_COLUMNS = {"domain__c": "domain", "articlenumber": "article_number",
                   "RECORDTYPEID": "record_type_id", "GOVERNANCE__C": "governance",
                   "articlecreateddate": "created_date", "product_line__c": "product_line",
                   "share_with__c": "shared_with", "VALIDATIONSTATUS": "validation_status",
                   "lastmodifieddate": "last_modified_date"}
LINK_COLUMNS = {"KNOWLEDGE__C": "article_id", "LINK_DATE__C": "link_date",
                "type__c": "link_type"}
FLAG_COLUMNS = {"SUBMITTED_DATE_TIME__C": "submitted_at", "KNOWLEDGE_DOMAIN__C": "domain",
                "ARTICLE_NUMBER__C": "article_number", "TITLE__C": "title",
                "ARTICLE_RECORD_TYPE__C": "record_type", "GOVERNANCE__C": "governance",
                "status__c": "status"}
SCORE_COLUMNS = {"article_number__c": "article_number",
                 "date_score_changed__c": "scored_at", "acrolinx_score__c": "score"}

# Contract name -> column name of the original result tables.
OUTLOOK_OUTPUT = {"ViewName": "VerintWfmStaffingMapViewName"}
UTILISATION_OUTPUT = {"quality_score": "acrolinx_score"}


def renamed(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the mapped columns (matched case-insensitively), keep the rest."""
    lower = {k.lower(): v for k, v in mapping.items()}
    return df.select(*[F.col(c).alias(lower.get(c.lower(), c)) for c in df.columns])


def outlook_from_tables(history, view_map, fte, queue, volume, requirement, model,
                        start=OUTLOOK_START, end=OUTLOOK_END,
                        filter_names=OUTLOOK_FILTER_NAMES, cutoff=None, **options) -> DataFrame:
    """The staffing outlook. The original contract-stage cutoff
    (``OUTLOOK_CONTRACT_CUTOFF``) contradicts the date range and empties that
    stage, so it is only applied when passed as ``cutoff``."""
    return renamed(S.staffing_outlook(history, view_map, fte, queue, volume, requirement, model,
                                      start, end, filter_names, cutoff=cutoff, **options),
                   OUTLOOK_OUTPUT)


def utilisation_from_tables(clicks, clicks_alt, knowledge, links, flags, scores,
                            run_date=None, window=None, how: str = "inner",
                            params: UtilisationParams | None = None) -> DataFrame:
    """The weekly utilisation summary for ``run_date`` (last full Sunday to
    Saturday week) or an explicit ``window=(start, end)``."""
    params = params or UtilisationParams(
        base_sources=BASE_CLICK_SOURCES, view_sources=VIEW_CLICK_SOURCES,
        record_types=RECORD_TYPE_LABELS, governance=GOVERNANCE, banned_domain=BANNED_DOMAIN,
        use_type=LINK_USE, reference_type=LINK_REFERENCE,
        excluded_flag_status=EXCLUDED_FLAG_STATUS)
    return renamed(utilisation_summary(
        renamed(clicks, CLICK_COLUMNS), renamed(clicks_alt, CLICK_COLUMNS),
        renamed(knowledge, ARTICLE_COLUMNS), renamed(links, LINK_COLUMNS),
        renamed(flags, FLAG_COLUMNS), renamed(scores, SCORE_COLUMNS), params,
        run_date=run_date, window=window, how=how), UTILISATION_OUTPUT)


def domain_counts_from_tables(flags, headlines, bookmarks, versions,
                              as_of=AS_OF_DATE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Flag, headline and bookmark counts per domain as of a date."""
    flag = DC.flag_counts(flags, as_of, "SUBMITTED_DATE_TIME_C", "KNOWLEDGE_DOMAIN_C",
                          "status_c", banned=BANNED_DOMAIN, relabels=DOMAIN_RELABEL,
                          excluded_status=EXCLUDED_FLAG_STATUS, alias="flag_count")
    headline = DC.list_mention_counts(headlines, as_of, "createddate", "VIEWABLE_BY_C", "id",
                                      separator=LIST_SEPARATOR, alias="headline_news_count")
    bookmark = DC.bookmark_counts(bookmarks, versions, as_of, "CREATEDDATE",
                                  "KNOWLEDGE_ARTICLE_C", "ID", "ARTICLE_VERSION_ID_C",
                                  "ARTICLE_DOMAIN_C", banned=BANNED_DOMAIN,
                                  relabels=DOMAIN_RELABEL, alias="bookmark_count")
    return flag, headline, bookmark


def slots_from_tables(campaigns, plans, instances, series, queues, start=SLOT_START,
                      end=SLOT_END, windows=SLOT_EXCLUDED_WINDOWS, n_slots: int = 96) -> DataFrame:
    """Base forecast series as one row per quarter-hour slot."""
    return slot_report(campaigns, plans, instances, series, queues, start, end,
                       n_slots=n_slots, windows=windows)


UTILISATION_INPUTS = ("clicks", "clicks_alt", "knowledge", "links", "flags", "scores")
OUTLOOK_INPUTS = ("history", "view_map", "fte", "queue", "volume", "requirement", "model")


def utilisation_job(spark, tables: Mapping[str, str], target: str, load_type: str = "overwrite",
                    run_date=None, window=None, source_system: str | None = None,
                    how: str = "inner") -> None:
    """Read the six inputs by catalog name (``tables`` maps each name in
    ``UTILISATION_INPUTS`` to a table), build the summary and write it with
    the job's load type, tagged with the source system."""
    t = {k: read_source(spark, "table", tables[k]) for k in UTILISATION_INPUTS}
    out = utilisation_from_tables(*(t[k] for k in UTILISATION_INPUTS), run_date=run_date,
                                  window=window, how=how)
    write_table(out, target, mode=load_type, source_system=source_system)


def outlook_job(spark, tables: Mapping[str, str], target: str, start=OUTLOOK_START,
                end=OUTLOOK_END, filter_names=OUTLOOK_FILTER_NAMES, **options) -> None:
    """Read the seven inputs by catalog name and replace ``target`` with the
    clustered outlook report."""
    t = [read_source(spark, "table", tables[k]) for k in OUTLOOK_INPUTS]
    S.run_staffing_outlook(target, *t, start, end, filter_names,
                           cluster_by=OUTLOOK_CLUSTER_BY, names=OUTLOOK_OUTPUT, **options)
