"""Weekly knowledge-article utilisation summary.

Expected inputs (column names):

* ``clicks``, ``clicks_alt``  datetime, source_name, domain, article_number,
  document_title, article_record_type, governance, click_id
* ``articles``  id, domain, article_number, title, record_type_id, governance,
  created_date, product_line, shared_with, validation_status, last_modified_date
* ``links``     article_id, link_date, link_type
* ``flags``     submitted_at, domain, article_number, title, record_type,
  governance, status
* ``scores``    article_number, scored_at, score
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.functions.aggregates import count_unless, count_where
from shiftwise.functions.labels import label_map
from shiftwise.functions.predicates import valid_label
from shiftwise.functions.temporal import reporting_week
from shiftwise.operators._checks import BROADCAST_MAX_BYTES, input_bytes
from shiftwise.operators.combine import backfill, enrich, union_canonical
from shiftwise.operators.ranking import latest_per_key
from shiftwise.operators.rollup import two_level_count

KEYS = ["date", "domain", "article_number", "document_title", "record_type_description",
        "governance"]
ATTRS = ["article_created_date", "product_line", "shared_with", "validation_status",
         "last_modified_date"]
# Output contract with the input types of the driver-shaped tables (dates as
# DATE, counts as BIGINT; the score keeps its source type).
OUTPUT_DDL = ("date date, domain string, article_number string, document_title string, "
              "record_type_description string, governance string, article_view_counts bigint, "
              "Use_Counts bigint, Reference_Counts bigint, article_created_date date, "
              "product_line string, shared_with string, validation_status string, "
              "link_date date, last_modified_date date, created_flag_count bigint")
OUTPUT = KEYS + ["article_view_counts", "Use_Counts", "Reference_Counts", "article_created_date",
                 "product_line", "shared_with", "validation_status", "link_date",
                 "last_modified_date", "created_flag_count", "quality_score"]


@dataclass
class UtilisationParams:
    base_sources: Sequence[str]
    view_sources: Sequence[str]
    record_types: Mapping[str, str]
    governance: Sequence[str]
    banned_domain: str = ""
    separator: str = ","
    use_type: str = "Use"
    reference_type: str = "Reference"
    excluded_flag_status: Sequence[str] = field(default_factory=lambda: ["Draft", "Withdrawn"])
    # Set by utilisation_summary from the size of the article table.
    articles_small: bool = False


def _small(df: DataFrame, p: UtilisationParams) -> DataFrame:
    """Broadcast an article-sized frame when the article table is small."""
    return F.broadcast(df) if p.articles_small else df


def _window(run_date, window):
    if window is not None:
        lo, hi = window
        return F.lit(lo).cast("date"), F.lit(hi).cast("date")
    if run_date is None:
        raise ValueError("give run_date or window")
    return reporting_week(run_date)


def link_days(links, p: UtilisationParams) -> DataFrame:
    """One pass over the links: per (article id, link day) the use and
    reference link counts and the newest link time: the first step of every
    link-based stage (a hash aggregate, so an article with a huge number of
    links becomes one row per day). It is not stored: each stage runs it over
    the link columns it needs."""
    return (links.groupBy("article_id", F.to_date("link_date").alias("link_day"))
            .agg(count_where(F.col("link_type") == p.use_type).alias("__use"),
                 count_where(F.col("link_type") == p.reference_type).alias("__ref"),
                 F.max("link_date").alias("__newest")))


def activity_base(clicks, clicks_alt, articles, links, flags, p: UtilisationParams,
                  start, end) -> DataFrame:
    """Distinct (date, domain, article, title, record type, governance) seen in
    any of the four activity sources inside the window."""
    def in_window(c):
        return F.to_date(F.col(c)).between(start, end)

    def valid(c):
        return valid_label(c, p.banned_domain, p.separator)

    def click_rows(df, sources):
        cond = in_window("datetime") & valid("domain")
        if sources is not None:
            cond = cond & F.col("source_name").isin(list(sources))
        return df.filter(cond).select(
            F.to_date("datetime").alias("date"), "domain", "article_number", "document_title",
            F.col("article_record_type").alias("record_type_description"), "governance")

    days = link_days(links, p).filter(F.col("link_day").between(start, end))
    art_link = _small(articles, p).join(days, articles["id"] == days["article_id"], "inner")
    kav = art_link.filter(valid("domain")).select(
        F.col("link_day").alias("date"), "domain", "article_number",
        F.col("title").alias("document_title"),
        label_map("record_type_id", p.record_types).alias("record_type_description"),
        "governance")
    flag = flags.filter(in_window("submitted_at") & valid("domain")).select(
        F.to_date("submitted_at").alias("date"), "domain", "article_number",
        F.col("title").alias("document_title"),
        F.col("record_type").alias("record_type_description"), "governance")
    return union_canonical(
        [click_rows(clicks, p.base_sources), click_rows(clicks_alt, None), flag, kav],
        KEYS, types={"article_number": "string"}, distinct=True)


def view_counts(clicks, clicks_alt, p: UtilisationParams, start, end) -> DataFrame:
    """Distinct clicks per key in each click source, summed over the sources."""
    def rows(df):
        return df.filter(F.to_date("datetime").between(start, end)
                         & F.col("source_name").isin(list(p.view_sources))
                         & valid_label("domain", p.banned_domain, p.separator)).select(
            F.to_date("datetime").alias("date"), "domain",
            F.col("article_number").cast("string").alias("article_number"), "document_title",
            F.col("article_record_type").alias("record_type_description"), "governance",
            "click_id")
    return two_level_count([rows(clicks), rows(clicks_alt)], KEYS, "click_id",
                           "article_view_counts")


def link_activity(articles, links, p: UtilisationParams, start, end) -> DataFrame:
    """Per link day and article key: use / reference link counts and the
    article's attributes (max over the group); ``quality_score`` starts at 0.

    Links are first counted per (day, article id) with a hash aggregate, and
    only those counts are joined to the articles and rolled up to the six
    keys. Sums of per-article counts equal counts over link rows, and maxima of
    article attributes are unchanged, but the string maxima (which Spark can
    only aggregate by sorting) now see one row per article-day instead of one
    per link - a hot article costs a single row per day.
    """
    per_day = (link_days(links, p).filter(F.col("link_day").between(start, end))
               .select("article_id", F.col("link_day").alias("link_date"), "__use", "__ref"))
    arts = articles.filter(_link_domain(p))
    joined = per_day.join(_small(arts, p), per_day["article_id"] == arts["id"], "inner")
    return (joined
            .groupBy("link_date", "domain",
                     F.col("article_number").cast("string").alias("article_number"),
                     F.col("title").alias("document_title"),
                     label_map("record_type_id", p.record_types).alias("record_type_description"),
                     "governance")
            .agg(*_link_aggregates(), F.lit(0).alias("quality_score")))


def link_rollups(articles, links, p: UtilisationParams, start, end) -> DataFrame:
    """``link_activity`` with, as the struct ``latest``, the attributes that
    ``latest_article_attrs`` gives its article number: both from one scan of the links.

    One aggregation per article holds a buffer for each: the newest link of all
    times, and the counts of each day of the window (a list of at most as many
    entries as the window has days). Joined to its article, it is ranked among the
    articles of its number, and only then are the days listed out. A row whose
    article number has no article with a valid domain has no ``latest``."""
    inside = F.col("link_day").between(start, end)
    day = F.struct(F.col("link_day").alias("link_date"), F.col("__use"), F.col("__ref"))
    per_article = link_days(links, p).groupBy("article_id").agg(
        F.max("__newest").alias("__newest"), F.collect_list(F.when(inside, day)).alias("__days"))
    joined = articles.join(per_article, articles["id"] == per_article["article_id"], "left")
    attrs = F.struct(F.to_date("created_date").alias("article_created_date"), "product_line", "shared_with",
                     "validation_status", F.to_date("last_modified_date").alias("last_modified_date"))
    # NULL is the least of a struct's fields: the latest link day first, as when ranked.
    order = F.struct(F.to_date("__newest"), F.col("__newest"), F.col("id"))
    rank = F.when(valid_label("domain", p.banned_domain, p.separator), order)
    number = F.col("article_number").cast("string")
    latest = F.max_by(attrs, rank).over(Window.partitionBy(number))
    rows = (joined.withColumn("latest", latest).filter(_link_domain(p))
            .select("*", F.inline("__days")))
    return (rows.groupBy("link_date", "domain", number.alias("article_number"),
                         F.col("title").alias("document_title"),
                         label_map("record_type_id", p.record_types).alias("record_type_description"), "governance")
            .agg(*_link_aggregates(), F.any_value("latest").alias("latest")))


def _link_domain(p: UtilisationParams) -> F.Column:
    """As written: NOT NULL (not length > 0), so an empty domain passes here."""
    d = F.col("domain")
    cond = d.isNotNull() & ~d.contains(p.separator)
    return cond & (d != F.lit(p.banned_domain)) if p.banned_domain else cond


def _link_aggregates() -> list:
    return [F.max(F.to_date("created_date")).alias("article_created_date"),
            F.sum("__use").cast("bigint").alias("Use_Counts"),
            F.sum("__ref").cast("bigint").alias("Reference_Counts"),
            F.max("product_line").alias("product_line"),
            F.max("shared_with").alias("shared_with"),
            F.max("validation_status").alias("validation_status"),
            F.max(F.to_date("last_modified_date")).alias("last_modified_date")]


def flag_activity(flags, p: UtilisationParams, start, end) -> DataFrame:
    """Flags per submitted day and article key, excluding listed statuses
    (a NULL status counts)."""
    return (flags.filter(F.to_date("submitted_at").between(start, end)
                         & valid_label("domain", p.banned_domain, p.separator))
            .groupBy(F.to_date("submitted_at").alias("submitted_date"), "domain",
                     F.col("article_number").cast("string").alias("article_number"),
                     F.col("title").alias("document_title"),
                     F.col("record_type").alias("record_type_description"), "governance")
            .agg(count_unless(F.col("status").isin(list(p.excluded_flag_status)))
                 .alias("created_flag_count")))


def latest_article_attrs(articles, links, p: UtilisationParams) -> DataFrame:
    """Article attributes of each article number's most recent link.

    Only an article's newest link can rank first for it, so links are first
    reduced to ``max(link_date)`` per article id (a hash aggregate: a heavily
    linked article becomes one row before any shuffle). The left join then
    meets at most one row per article, and the ranking per article number
    (latest link day, then link time, then article id) is unchanged.
    """
    newest = link_days(links, p).groupBy("article_id").agg(
        F.max("__newest").alias("link_date"))
    joined = articles.join(newest, articles["id"] == newest["article_id"], "left").filter(
        valid_label("domain", p.banned_domain, p.separator))
    ranked = latest_per_key(
        joined.withColumn("__an", F.col("article_number").cast("string")),
        ["__an"], [F.to_date("link_date")], tie_break=[F.col("link_date"), F.col("id")])
    return ranked.select(F.col("__an").alias("article_number"),
                         F.to_date("created_date").alias("article_created_date"),
                         "product_line", "shared_with", "validation_status",
                         F.to_date("last_modified_date").alias("last_modified_date"))


def latest_daily_score(scores) -> DataFrame:
    """Latest score per article and day."""
    s = scores.withColumn("score_date", F.to_date("scored_at")).withColumn(
        "article_number", F.col("article_number").cast("string"))
    top = latest_per_key(s, ["article_number", "score_date"], ["scored_at"],
                         tie_break=["score"])
    return top.select("article_number", "score_date", F.col("score").alias("quality_score"))


def utilisation_summary(clicks: DataFrame, clicks_alt: DataFrame, articles: DataFrame,
                        links: DataFrame, flags: DataFrame, scores: DataFrame,
                        params: UtilisationParams, run_date=None, window=None,
                        how: str = "inner") -> DataFrame:
    """The summary: activity base enriched with view counts, link activity and
    flag counts (``how`` = inner as written, or left to keep every base row),
    NULL attributes backfilled from the latest link, latest same-day score
    attached, filtered to the wanted governance values.

    With inner joins the base adds nothing: a result key has flags, and the
    flags of the window are one of the base's four sources under the same
    filters, so the base is neither built nor joined. Every result key has link
    activity too, so the latest attributes travel with it (``link_rollups``) and the
    links are scanned once."""
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    # The articles' size decides the join strategy for every article-sized side:
    # the articles themselves and the one-row-per-article latest attributes.
    p = replace(params, articles_small=input_bytes(articles) <= BROADCAST_MAX_BYTES)
    start, end = _window(run_date, window)
    views = view_counts(clicks, clicks_alt, p, start, end)
    flagged = flag_activity(flags, p, start, end)
    links_of = dict(columns=["Use_Counts", "Reference_Counts", "article_created_date", "product_line",
                             "shared_with", "validation_status", "link_date", "last_modified_date"],
                    fact_keys=["link_date"] + KEYS[1:])
    flags_of = dict(columns=["created_flag_count"], fact_keys=["submitted_date"] + KEYS[1:])
    if how == "inner":
        links_of["columns"].append("latest")
        step3 = enrich(enrich(views, link_rollups(articles, links, p, start, end), KEYS, **links_of),
                       flagged, KEYS, **flags_of)
        filled = step3.filter("latest is not null").select(
            *[F.coalesce(F.col(c), F.col(f"latest.{c}")).alias(c) if c in ATTRS else F.col(c)
              for c in step3.columns if c != "latest"])
    else:
        base = activity_base(clicks, clicks_alt, articles, links, flags, p, start, end)
        step1 = enrich(base, views, KEYS, how)
        step2 = enrich(step1, link_activity(articles, links, p, start, end), KEYS, how, **links_of)
        step3 = enrich(step2, flagged, KEYS, how, **flags_of)
        filled = backfill(step3, _small(latest_article_attrs(articles, links, p), p),
                          ["article_number"], ATTRS)
    scored = enrich(filled, latest_daily_score(scores), ["article_number", "date"], "left",
                    columns=["quality_score"], fact_keys=["article_number", "score_date"])
    return scored.filter(F.col("governance").isin(list(p.governance))).select(*OUTPUT)
