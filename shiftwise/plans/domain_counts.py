"""As-of-date counts per domain: flags, delimited-list mentions, bookmarks."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.aggregates import count_unless
from shiftwise.functions.labels import relabel
from shiftwise.functions.predicates import valid_label
from shiftwise.operators._checks import broadcast_if_small
from shiftwise.operators.reshape import explode_list


def _as_of(date_col: str, as_of):
    return F.to_date(F.col(date_col)) <= F.lit(as_of).cast("date")


def _count_as_of(rows: DataFrame, as_of, domain, count, alias: str) -> DataFrame:
    """(date = as_of, domain, count) of ``rows`` that already passed their filters."""
    return (rows.select(F.lit(as_of).cast("date").alias("date"), domain.alias("domain"), "*")
            .groupBy("date", "domain").agg(count.alias(alias)))


def flag_counts(flags: DataFrame, as_of, date_col: str, domain_col: str, status_col: str,
                banned="", relabels: Mapping[str, str] | None = None,
                excluded_status: Sequence[str] = ("Draft", "Withdrawn"),
                alias: str = "flag_count") -> DataFrame:
    """Flags submitted on or before ``as_of`` per (relabelled) domain; rows
    with an excluded status count 0, all others (NULL status too) count 1."""
    kept = flags.filter(valid_label(domain_col, banned, ",") & _as_of(date_col, as_of)).select(
        relabel(domain_col, relabels or {}).alias("__domain"), F.col(status_col).alias("__status"))
    return _count_as_of(kept, as_of, F.col("__domain"),
                        count_unless(F.col("__status").isin(list(excluded_status))), alias)


def list_mention_counts(df: DataFrame, as_of, date_col: str | None, list_col: str, id_col: str,
                        separator: str = ";", alias: str = "mention_count") -> DataFrame:
    """Distinct ids per piece of a delimited list column, as of a date
    (``date_col=None`` when the source has no date). Pieces are not trimmed;
    empty pieces count as a domain."""
    src = df.filter(_as_of(date_col, as_of)) if date_col else df
    pieces = explode_list(src.select(F.col(id_col).alias("__id"), F.col(list_col).alias("__list")),
                          "__list", separator, "__piece")
    return _count_as_of(pieces, as_of, F.col("__piece"), F.countDistinct("__id"), alias)


def bookmark_counts(bookmarks: DataFrame, versions: DataFrame, as_of, bm_date: str,
                    bm_article: str, bm_id: str, version_id: str, version_domain: str,
                    banned="", relabels: Mapping[str, str] | None = None,
                    alias: str = "bookmark_count") -> DataFrame:
    """Distinct bookmarks per article domain, as of a date (inner join of
    bookmarks to article versions)."""
    b = bookmarks.filter(_as_of(bm_date, as_of)).select(
        F.col(bm_article).alias("__article"), F.col(bm_id).alias("__bm"))
    # ``domain != banned`` as written (a NULL domain is dropped by it); no
    # filter at all when no banned value is given.
    if banned:
        versions = versions.filter(F.col(version_domain) != F.lit(banned))
    v = versions.select(F.col(version_id).alias("__vid"), F.col(version_domain).alias("__domain"))
    # Versions are a dimension: shipped to the bookmark scan when small,
    # so a heavily bookmarked article never concentrates in one join task.
    j = b.join(broadcast_if_small(v), F.col("__article") == F.col("__vid"), "inner")
    return _count_as_of(j, as_of, relabel("__domain", relabels or {}), F.countDistinct("__bm"), alias)
