"""Both link roll-ups of the summary from one scan of the links."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shiftwise.operators.combine import backfill
from shiftwise.plans import utilisation as U
from shiftwise.session import scratch_path

P = U.UtilisationParams(base_sources=["a"], view_sources=["a"], record_types={"R0": "Alert"}, governance=["G"],
                        banned_domain="PROMO")
D = dt.datetime(2024, 1, 1)
ARTICLES = ("id int, domain string, article_number int, title string, record_type_id string, governance string, "
            "created_date timestamp_ntz, product_line string, shared_with string, validation_status string, "
            "last_modified_date timestamp_ntz")


def _tables(spark, seed):
    rng = random.Random(seed)
    pick = rng.choice
    articles = [(i, pick(["Sales", "Sales", "", "PROMO", "A,B", None]), pick([1, 2, 3, 4, None]), pick("TU"),
                 pick(["R0", "R1", None]), pick("GH"), pick([None, D, D + dt.timedelta(days=3)]), pick([None, "p", "q"]),
                 pick([None, "s"]), pick([None, "v", "w"]), pick([None, D])) for i in range(30)]
    links = [(rng.randrange(35), pick([None, *(D + dt.timedelta(days=d, hours=h) for d in range(-5, 12) for h in (0, 5))]),
              pick(["Use", "Reference", "Other", None])) for _ in range(200)]
    path = scratch_path(spark, "links")
    spark.createDataFrame(links, "article_id int, link_date timestamp_ntz, link_type string").write.parquet(path)
    return spark.createDataFrame(articles, ARTICLES), spark.read.parquet(path)


def _window():
    return F.lit("2024-01-01").cast("date"), F.lit("2024-01-07").cast("date")


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_equals_separate_rollups(spark, seed):
    articles, links = _tables(spark, seed)
    apart = backfill(U.link_activity(articles, links, P, *_window()).drop("quality_score"),
                     U.latest_article_attrs(articles, links, P), ["article_number"], U.ATTRS)
    both = U.link_rollups(articles, links, P, *_window()).filter("latest is not null and article_number is not null")
    filled = both.select(*[F.coalesce(F.col(c), F.col(f"latest.{c}")).alias(c) if c in U.ATTRS else F.col(c)
                           for c in apart.columns])
    assert rows(filled) == rows(apart) and filled.count() > 5


def test_links_are_scanned_once(spark):
    articles, links = _tables(spark, 5)
    click = ("datetime timestamp_ntz, source_name string, domain string, article_number string, document_title string, "
             "article_record_type string, governance string, click_id int")
    clicks = spark.createDataFrame([(D, "a", "Sales", "1", "T", "Alert", "G", 1)], click)
    flags = spark.createDataFrame([(D, "Sales", "1", "T", "Alert", "G", "New")],
                                  "submitted_at timestamp_ntz, domain string, article_number string, title string, "
                                  "record_type string, governance string, status string")
    scores = spark.createDataFrame([], "article_number string, scored_at timestamp_ntz, score double")

    def scans(how):
        out = U.utilisation_summary(clicks, clicks, articles, links, flags, scores, P,
                                    window=("2024-01-01", "2024-01-07"), how=how)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]
        return sum("FileScan parquet [article_id" in line for line in plan.splitlines())

    assert scans("inner") == 1 and scans("left") > 1


def test_an_article_with_most_links_is_one_row_a_day(spark):
    articles, _ = _tables(spark, 6)
    links = spark.range(50_000).select(
        F.when(F.col("id") % 3 < 2, F.lit(1)).otherwise((F.col("id") % 30).cast("int")).alias("article_id"),
        (F.lit(D) + F.make_dt_interval((F.col("id") % 20).cast("int"))).alias("link_date"), F.lit("Use").alias("link_type"))
    per_day = U.link_days(links, P).filter("article_id = 1")
    assert per_day.count() == 20
    apart = U.link_activity(articles, links, P, *_window())
    both = U.link_rollups(articles, links, P, *_window())
    key = ["link_date", "domain", "article_number", "document_title", "Use_Counts"]
    assert rows(both, *key) == rows(apart, *key)
