"""The original jobs run on tables with their original column names."""

import datetime as dt

from conftest import rows
from shiftwise.plans import presets as P

D = dt.datetime(2024, 1, 3, 9)   # a Wednesday in the reporting week of run date 2024-01-10
RT = "0124P000000bg6GQAQ"


def _utilisation_tables(spark):
    click_cols = ("datetime timestamp, source_name string, domain string, article_number string, "
                  "document_title string, article_record_type string, governance string, "
                  "click_Id string")
    clicks = spark.createDataFrame([
        (D, "CKit KM Archive", "Sales", "A1", "T1", "Alert", "Rule-Based", "c1"),
        (D, "CKit KM Archive", "Sales", "A1", "T1", "Alert", "Rule-Based", "c2"),
        (D, "Salesforce KH", "Testing Admin Only", "A9", "T9", "Alert", "Rule-Based", "c3"),
    ], click_cols)
    clicks_sf = spark.createDataFrame([
        (D, "Salesforce KM", "Sales", "A1", "T1", "Alert", "Rule-Based", "c1"),
    ], click_cols)
    knowledge = spark.createDataFrame([
        ("k1", "Sales", "A1", "T1", RT, "Rule-Based", D, "PL", None, "Validated", D),
    ], "id string, domain__c string, articlenumber string, title string, RECORDTYPEID string, "
       "GOVERNANCE__C string, articlecreateddate timestamp, product_line__c string, "
       "share_with__c string, VALIDATIONSTATUS string, lastmodifieddate timestamp")
    links = spark.createDataFrame([("k1", D, "Use"), ("k1", D, "Reference"), ("k1", D, "Use")],
                                  "KNOWLEDGE__C string, LINK_DATE__C timestamp, type__c string")
    flags = spark.createDataFrame([
        (D, "Sales", "A1", "T1", "Alert", "Rule-Based", "Draft"),
        (D, "Sales", "A1", "T1", "Alert", "Rule-Based", "Published"),
    ], "SUBMITTED_DATE_TIME__C timestamp, KNOWLEDGE_DOMAIN__C string, ARTICLE_NUMBER__C string, "
       "TITLE__C string, ARTICLE_RECORD_TYPE__C string, GOVERNANCE__C string, status__c string")
    scores = spark.createDataFrame([("A1", D, 80.0), ("A1", D + dt.timedelta(hours=2), 90.0)],
                                   "article_number__c string, date_score_changed__c timestamp, "
                                   "acrolinx_score__c double")
    return clicks, clicks_sf, knowledge, links, flags, scores


def test_utilisation_from_tables(spark):
    out = P.utilisation_from_tables(*_utilisation_tables(spark), run_date="2024-01-10")
    got = [r.asDict() for r in out.collect()]
    assert len(got) == 1
    r = got[0]
    assert (r["date"], r["domain"], r["article_number"], r["record_type_description"]) == \
        (dt.date(2024, 1, 3), "Sales", "A1", "Alert")
    assert r["article_view_counts"] == 3          # 2 distinct clicks + 1 in the second source
    assert (r["Use_Counts"], r["Reference_Counts"], r["created_flag_count"]) == (2, 1, 1)
    assert r["acrolinx_score"] == 90.0            # latest score of the day
    assert r["shared_with"] is None and r["product_line"] == "PL"


def test_domain_counts_from_tables(spark):
    flags = spark.createDataFrame([("SO Admin", "2025-06-01", "Published"),
                                   ("SO Admin", "2025-07-01", "Published")],
                                  "KNOWLEDGE_DOMAIN_C string, SUBMITTED_DATE_TIME_C string, "
                                  "status_c string")
    news = spark.createDataFrame([("n1", "2025-06-01", "A;B")],
                                 "id string, createddate string, VIEWABLE_BY_C string")
    bm = spark.createDataFrame([("b1", "v1", "2025-06-01")],
                               "ID string, KNOWLEDGE_ARTICLE_C string, CREATEDDATE string")
    ver = spark.createDataFrame([("v1", "SO Admin")], "ARTICLE_VERSION_ID_C string, "
                                "ARTICLE_DOMAIN_C string")
    flag, headline, bookmark = P.domain_counts_from_tables(flags, news, bm, ver)
    assert rows(flag, "domain", "flag_count") == [("SO Operating Enablement", 1)]
    assert rows(headline, "domain", "headline_news_count") == [("A", 1), ("B", 1)]
    assert rows(bookmark, "domain", "bookmark_count") == [("SO Operating Enablement", 1)]


def test_renamed_is_case_insensitive(spark):
    df = spark.createDataFrame([(1, 2)], "CLICK_ID int, other int")
    assert P.renamed(df, P.CLICK_COLUMNS).columns == ["click_id", "other"]


def test_utilisation_job_reads_tables_and_writes_with_load_type(spark):
    from shiftwise.session import scratch_path
    names = {}
    for key, df in zip(P.UTILISATION_INPUTS, _utilisation_tables(spark)):
        names[key] = f"util_{key}"
        df.createOrReplaceTempView(names[key])
    path = scratch_path(spark, "util")
    P.utilisation_job(spark, names, path, "overwrite", run_date="2024-01-10",
                      source_system="knowledge")
    P.utilisation_job(spark, names, path, "append", run_date="2024-01-10",
                      source_system="knowledge")
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.select("source_system").distinct().count() == 1


def test_outlook_job(spark):
    from test_plans import _outlook_inputs
    from shiftwise.session import scratch_path
    names = {}
    for key, df in zip(P.OUTLOOK_INPUTS, _outlook_inputs(spark)):
        names[key] = f"outlook_{key}"
        df.createOrReplaceTempView(names[key])
    path = scratch_path(spark, "outlook_job")
    P.outlook_job(spark, names, path, start="2025-07-13", end="2025-08-31",
                  filter_names=["Staffing Outlook"], now="2025-09-01")
    assert spark.read.parquet(path).count() == 5
