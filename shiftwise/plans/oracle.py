"""Independent SQL (DuckDB dialect) for every catalogue query.

Written directly against the driver tables (``region nation customer supplier
part orders lineitem events ...`` as views); the analog inputs of
``shiftwise.plans.analogs`` are re-derived here as CTEs. Double outputs are
rounded to 6 decimals, as on the Spark side.
"""

from __future__ import annotations

# --- shared fragments -----------------------------------------------------------

R_START, R_END = "TIMESTAMP '2024-01-03'", "TIMESTAMP '2024-01-28'"
NOW = "TIMESTAMP '2025-01-01 00:00:00'"
FILTERS = "('BUILDING', 'MACHINERY', 'HOUSEHOLD')"
GOV = "('Brand#1', 'Brand#2', 'Brand#3', 'Brand#5', 'Brand#8', 'Brand#13', 'Brand#21')"
KEYS6 = "DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel"
UKEYS = ["date", "domain", "article_number", "document_title", "record_type_description",
         "governance"]


def hh(x: str) -> str:
    return f"(CASE WHEN minute({x}) IN (15, 45) THEN {x} - INTERVAL 15 MINUTE ELSE {x} END)"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def valid(x: str) -> str:
    return f"(length({x}) > 0 AND {x} <> 'PROMO' AND NOT contains({x}, ','))"


def in_window(x: str) -> str:
    return f"(CAST({x} AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31')"


def size_label(x: str = "p_size") -> str:
    return (f"(CASE {x} % 5 WHEN 0 THEN 'Alert' WHEN 1 THEN 'Issue' WHEN 2 THEN 'Question' "
            f"WHEN 3 THEN 'Reference' END)")


def code_label(x: str) -> str:
    return (f"(CASE {x} WHEN 'RT0' THEN 'Alert' WHEN 'RT1' THEN 'Issue' WHEN 'RT2' THEN "
            f"'Question' WHEN 'RT3' THEN 'Reference' END)")


def on_keys(a: str, b: str, keys, bkeys=None) -> str:
    bkeys = bkeys or keys
    return " AND ".join(f"{a}.{k} = {b}.{bk}" for k, bk in zip(keys, bkeys))


CTE = {
    "fact15": """SELECT event_id, user_id AS QueueID,
        time_bucket(INTERVAL 15 MINUTE, ts) AS DateTime, ts, event_type, value,
        CAST(event_id % 600 + 60 AS DOUBLE) AS aht FROM events""",
    "history": """SELECT c_mktsegment AS FilterName,
        'VIEW_' || CAST((c_nationkey + v.shift) % 25 AS VARCHAR) AS ViewName, c_custkey AS QueueID,
        TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 10 + v.days AS INTEGER))
            AS RecordStartDateInclusive,
        TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 10 + v.days + 15 AS INTEGER))
            AS RecordEndDateNonInclusive
        FROM customer, (VALUES (0, 0, 1), (15, 3, 3), (5, 1, 7)) v(days, shift, every)
        WHERE c_custkey % v.every = 0""",
    "viewmap": """SELECT 'VIEW_' || CAST(n_nationkey AS VARCHAR) AS ViewName, r_name AS Partner,
        n_name || s.suffix AS Site, 'LOB_' || CAST(n_nationkey % 4 AS VARCHAR) AS LineOfBusiness,
        CASE WHEN n_regionkey % 2 = 0 THEN 'VOICE' ELSE 'CHAT' END AS ServiceModel
        FROM nation JOIN region ON n_regionkey = r_regionkey
        JOIN (VALUES ('', 1), (' II', 5)) s(suffix, every) ON n_nationkey % s.every = 0""",
    "fmap": f"""SELECT h.QueueID, h.ViewName, m.Partner, m.Site, m.LineOfBusiness, m.ServiceModel,
        h.RecordStartDateInclusive, h.RecordEndDateNonInclusive
        FROM history h JOIN viewmap m ON h.ViewName = m.ViewName WHERE h.FilterName IN {FILTERS}""",
    "articles": """SELECT p_partkey AS id, p_type AS domain, p_partkey AS article_number,
        p_name AS title, 'RT' || CAST(p_size % 5 AS VARCHAR) AS record_type_id,
        p_brand AS governance,
        TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 365 AS INTEGER)) AS created_date,
        p_type AS product_line, 'S' || CAST(p_size % 3 AS VARCHAR) AS shared_with,
        CASE WHEN p_size % 2 = 0 THEN 'Validated' ELSE 'Pending' END AS validation_status,
        TIMESTAMP '1994-01-01' + to_days(CAST(p_partkey % 365 AS INTEGER)) + to_days(p_size)
            AS last_modified_date
        FROM part""",
    "links": """SELECT l_partkey AS article_id, l_shipdate AS link_date,
        CASE l_returnflag WHEN 'A' THEN 'Use' WHEN 'R' THEN 'Reference' ELSE 'Other' END AS link_type
        FROM lineitem""",
    "lp": "SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey",
    "clicks": f"""SELECT l_shipdate AS datetime,
        CASE WHEN l_linestatus = 'F' THEN 'ARCHIVE' ELSE 'PORTAL' END AS source_name,
        p_type AS domain, l_partkey AS article_number, p_name AS document_title,
        {size_label()} AS article_record_type, p_brand AS governance, l_orderkey AS click_id
        FROM lp WHERE l_returnflag <> 'N'""",
    "clicks_alt": f"""SELECT l_shipdate AS datetime,
        CASE WHEN l_linenumber % 2 = 0 THEN 'PORTAL' ELSE 'MOBILE' END AS source_name,
        p_type AS domain, l_partkey AS article_number, p_name AS document_title,
        {size_label()} AS article_record_type, p_brand AS governance, l_orderkey AS click_id
        FROM lp WHERE l_returnflag = 'N'""",
    "flagsrc": f"""SELECT l_shipdate AS submitted_at, p_type AS domain,
        CAST(l_partkey AS VARCHAR) AS article_number, p_name AS title,
        {size_label()} AS record_type, p_brand AS governance,
        CASE WHEN l_returnflag = 'R' THEN 'Withdrawn' WHEN l_linestatus = 'O' THEN 'Draft'
             ELSE 'Published' END AS status
        FROM lp""",
    "scoresrc": """SELECT CAST(l_partkey AS VARCHAR) AS article_number,
        l_shipdate + to_hours(l_linenumber) AS scored_at, l_quantity AS score FROM lineitem""",
    "ftgt": """SELECT DateTime, QueueID AS CampaignID, event_id AS QueueID,
        CASE WHEN event_type = 'signup' THEN NULL ELSE aht END AS AHT, value AS CALLVOLUME,
        CAST(date_trunc('day', ts) AS TIMESTAMP) AS RecordCreatedDateTime,
        DateTime AS RecordLastModifiedDateTime
        FROM fact15 WHERE ts < TIMESTAMP '2024-01-22'""",
    "fstg": """SELECT DateTime AS ForecastInterval, QueueID AS CampaignID, event_id AS QueueID,
        CASE WHEN event_type = 'error' THEN NULL ELSE aht END AS AHT,
        CASE WHEN event_type = 'click' THEN value * 1.1 WHEN event_type = 'view' THEN NULL
             ELSE value END AS CALLVOLUME
        FROM fact15 WHERE ts >= TIMESTAMP '2024-01-08'""",
    "dtgt": """SELECT o_orderkey AS CampaignID, o_custkey AS ParentCampaignID,
        o_orderpriority AS CampaignName, o_orderstatus AS CampaignDescription,
        o_totalprice > 200000 AS IsDistributed, o_orderdate AS RecordCreatedDateTime,
        o_orderdate + INTERVAL 1 DAY AS RecordLastModifiedDateTime,
        CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY END AS RecordRemovedDateTime
        FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'""",
    "dstg": """SELECT o_orderkey AS CampaignID, o_custkey AS ParentCampaignID,
        CASE WHEN o_orderstatus = 'O' THEN o_orderpriority || '*' ELSE o_orderpriority END
            AS CampaignName,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderstatus END AS CampaignDescription,
        o_totalprice > 200000 AS IsDistributed
        FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'""",
}


def with_(*names: str, body: str) -> str:
    ctes = ",\n".join(f"{n} AS ({CTE[n]})" for n in names)
    return f"WITH {ctes}\n{body}"


def _validity(f: str = "f", m: str = "m") -> str:
    return (f"{f}.QueueID = {m}.QueueID AND {f}.DateTime >= {m}.RecordStartDateInclusive "
            f"AND {f}.DateTime < {m}.RecordEndDateNonInclusive")


def _range(x: str = "f.DateTime") -> str:
    return f"{x} BETWEEN {R_START} AND {R_END}"


MAPCOLS = "m.ViewName, m.Partner, m.Site, m.LineOfBusiness, m.ServiceModel"
FMAP = ("fact15", "history", "viewmap", "fmap")

# --- staffing outlook family ---------------------------------------------------

VALIDITY_JOIN = with_(*FMAP, body=f"""
SELECT {hh('f.DateTime')} AS DateTime, {MAPCOLS}, {r6('SUM(f.value) / 2.0')} AS ForecastRequired
FROM fact15 f JOIN fmap m ON {_validity()}
WHERE {_range()} AND f.value IS NOT NULL AND f.value > 0
GROUP BY 1, 2, 3, 4, 5, 6""")

HALF_HOUR_FLOOR = with_("fact15", body=f"""
SELECT event_id, ts, {hh('ts')} AS half_hour_raw, DateTime, {hh('DateTime')} AS half_hour
FROM fact15""")

RANGE_FILTER_INCLUSIVE = """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'"""

_VOLUME_JOIN = f"""SELECT f.DateTime, {MAPCOLS}, f.value AS CALLVOLUME, f.aht AS AHT
    FROM fact15 f JOIN fmap m ON {_validity()}
    WHERE {_range()} AND f.value IS NOT NULL AND f.value > 0"""

WEIGHTED_AVERAGE = with_(*FMAP, body=f"""
SELECT {hh('DateTime')} AS DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
       {r6('SUM(CALLVOLUME)')} AS ForecastVolume,
       {r6('CAST(SUM(CALLVOLUME * AHT) / NULLIF(SUM(CALLVOLUME), 0) AS DOUBLE)')} AS ForecastAHT
FROM ({_VOLUME_JOIN}) vj GROUP BY 1, 2, 3, 4, 5, 6""")

RATIO_OF_SUMS = with_(*FMAP, body=f"""
SELECT {hh('DateTime')} AS DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
       {r6('CAST(SUM(CALLVOLUME) / NULLIF(SUM(AHT), 0) AS DOUBLE)')} AS VolumePerHandleSecond
FROM ({_VOLUME_JOIN}) vj GROUP BY 1, 2, 3, 4, 5, 6""")

REAGGREGATE_HALF_HOUR = with_(*FMAP, body=f"""
SELECT {hh('DateTime')} AS DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
       {r6('SUM(q) / 2.0')} AS ForecastFTE
FROM (SELECT f.DateTime, {MAPCOLS}, SUM(f.value) AS q
      FROM fact15 f JOIN fmap m ON f.QueueID = m.QueueID
      WHERE m.RecordStartDateInclusive <= f.DateTime AND m.RecordEndDateNonInclusive > f.DateTime
        AND f.value IS NOT NULL AND f.value > 0
      GROUP BY 1, 2, 3, 4, 5, 6) qh
GROUP BY 1, 2, 3, 4, 5, 6""")

LOOKUP_JOIN = with_("history", "viewmap", "fmap", body="SELECT * FROM fmap")

CONTRACT_CUTOFF = with_("viewmap", body=f"""
SELECT o.o_orderdate AS DateTime, v.ViewName, v.Partner, v.Site, v.LineOfBusiness,
       v.ServiceModel, {r6('o.o_totalprice')} AS ContractRequired
FROM orders o JOIN viewmap v ON 'VIEW_' || CAST(o.o_custkey % 25 AS VARCHAR) = v.ViewName
WHERE o.o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
  AND o.o_orderdate < TIMESTAMP '1998-07-01'
  AND o.o_totalprice IS NOT NULL AND o.o_totalprice > 0""")


def _outlook(zero_fill: bool) -> str:
    def stage(event_type, agg, guard=True, half=True):
        ts = hh("f.DateTime") if half else "f.DateTime"
        g = " AND f.value IS NOT NULL AND f.value > 0" if guard else ""
        return (f"SELECT {ts} AS DateTime, {MAPCOLS}, {agg} FROM fact15 f JOIN fmap m ON "
                f"{_validity()} WHERE f.event_type = '{event_type}' AND {_range()}{g} "
                f"GROUP BY 1, 2, 3, 4, 5, 6")
    metrics = ["ForecastRequired", "ForecastFTE", "ForecastVolume", "ForecastAHT",
               "ContractRequired", "ErlangRequired"]

    def out(m):
        inner = f"CAST({m} AS DOUBLE)"
        if zero_fill:
            inner = f"COALESCE({inner}, 0)"
        return f"{r6(inner)} AS {m}"
    body = f"""
, fr AS ({stage('view', 'SUM(f.value) / 2.0 AS ForecastRequired')})
, fq AS ({stage('click', 'SUM(f.value) / 2.0 AS ForecastFTE')})
, fv AS ({stage('purchase', 'SUM(f.value) AS ForecastVolume, CAST(SUM(f.value * f.aht) / NULLIF(SUM(f.value), 0) AS DOUBLE) AS ForecastAHT')})
, cr AS (SELECT f.DateTime, {MAPCOLS}, f.value AS ContractRequired
         FROM fact15 f JOIN viewmap m ON 'VIEW_' || CAST(f.QueueID % 25 AS VARCHAR) = m.ViewName
         WHERE f.event_type = 'signup' AND {_range()} AND f.value IS NOT NULL AND f.value > 0)
, er AS ({stage('error', 'SUM(f.value) AS ErlangRequired', guard=False, half=False)})
SELECT DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
       {', '.join(out(m) for m in metrics)}, {NOW} AS DateCreated
FROM fr FULL JOIN fq USING ({KEYS6}) FULL JOIN fv USING ({KEYS6})
        FULL JOIN cr USING ({KEYS6}) FULL JOIN er USING ({KEYS6})"""
    head = with_(*FMAP, body="")
    return head.rstrip() + body


STAFFING_OUTLOOK = _outlook(False)
STAFFING_OUTLOOK_ZERO_FILL = _outlook(True)

EXCLUDE_WINDOWS = f"""
SELECT event_id, ts, {r6('value')} AS value FROM events
WHERE NOT (ts BETWEEN TIMESTAMP '2024-01-10 02:00:00' AND TIMESTAMP '2024-01-10 02:45:00'
        OR ts BETWEEN TIMESTAMP '2024-01-20 04:00:00' AND TIMESTAMP '2024-01-20 04:45:00')"""

UNPIVOT_SLOTS = f"""
SELECT QueueID, BaseDateTime, slot,
       BaseDateTime + to_minutes(CAST((slot - 1) * 15 AS BIGINT)) AS slot_ts,
       {r6('AHT')} AS AHT, {r6('CallVolume')} AS CallVolume
FROM (SELECT user_id AS QueueID, CAST(date_trunc('day', ts) AS TIMESTAMP) AS BaseDateTime,
             CAST(hour(ts) * 4 + floor(minute(ts) / 15) + 1 AS INTEGER) AS slot,
             MAX(CAST(event_id % 600 + 60 AS DOUBLE)) AS AHT, SUM(value) AS CallVolume
      FROM events GROUP BY 1, 2, 3) s
WHERE BaseDateTime >= TIMESTAMP '2024-01-02' AND BaseDateTime <= TIMESTAMP '2024-01-29'
  AND CallVolume >= 0"""

SLOT_REPORT = f"""
WITH s AS (SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS BaseDateTime,
                  CAST(hour(ts) * 4 + floor(minute(ts) / 15) + 1 AS INTEGER) AS slot,
                  MAX(CAST(event_id % 600 + 60 AS DOUBLE)) AS AHT, SUM(value) AS CallVolume
           FROM events GROUP BY 1, 2, 3)
SELECT r.r_regionkey AS CampaignID, r.r_name AS CampaignName, q.n_nationkey AS QueueID,
       q.n_name AS QueueName, s.BaseDateTime, s.slot,
       s.BaseDateTime + to_minutes(CAST((s.slot - 1) * 15 AS BIGINT)) AS slot_ts,
       {r6('s.AHT')} AS AHT, {r6('s.CallVolume')} AS CallVolume
FROM s JOIN customer c ON s.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN nation q ON CAST(s.user_id % 25 AS INTEGER) = q.n_nationkey
WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')
  AND s.BaseDateTime >= TIMESTAMP '2024-01-02' AND s.BaseDateTime <= TIMESTAMP '2024-01-29'
  AND s.CallVolume >= 0
  AND NOT (s.BaseDateTime BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-10 00:45:00')"""

CHAIN_JOIN = f"""
SELECT r_name, n_name, c_custkey, o_orderkey, l_linenumber, {r6('l_quantity')} AS l_quantity
FROM region JOIN nation ON r_regionkey = n_regionkey
JOIN customer ON n_nationkey = c_nationkey
JOIN orders ON c_custkey = o_custkey
JOIN lineitem ON o_orderkey = l_orderkey
WHERE c_mktsegment = 'BUILDING'"""

# --- calendar, labels, filters ----------------------------------------------------

REPORTING_WEEK = """
SELECT run_date,
       CAST(run_date - CAST(dayofweek(run_date) AS INTEGER) - 7 AS DATE) AS start_date,
       CAST(run_date - CAST((dayofweek(run_date) + 1) % 7 AS INTEGER) AS DATE) AS end_date
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders) d"""

RUN_WEEK = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day FROM orders),
r AS (SELECT CAST(max(day) + 1 AS DATE) AS run_date FROM o),
w AS (SELECT run_date, CAST(run_date - CAST(dayofweek(run_date) AS INTEGER) - 7 AS DATE) AS start_date,
             CAST(run_date - CAST((dayofweek(run_date) + 1) % 7 AS INTEGER) AS DATE) AS end_date FROM r)
SELECT strftime(run_date, '%Y-%m-%d') AS run_date, start_date, end_date,
       (SELECT count(*) FROM o WHERE day BETWEEN start_date AND end_date) AS orders
FROM w"""

# Rows a run stamps: inserted ones, and matched ones that changed or were not stamped as removed.
LOAD_STAMP = with_("dtgt", "dstg", body="""
, j AS (SELECT coalesce(t.CampaignID, s.CampaignID) AS CampaignID,
    (t.CampaignID IS NULL AND s.CampaignID IS NOT NULL)
    OR (t.CampaignID IS NOT NULL AND s.CampaignID IS NOT NULL AND coalesce(
        t.ParentCampaignID <> s.ParentCampaignID OR t.CampaignName <> s.CampaignName
        OR t.CampaignDescription <> s.CampaignDescription OR t.IsDistributed <> s.IsDistributed
        OR t.RecordRemovedDateTime IS NULL, false)) AS stamped
    FROM dtgt t FULL JOIN dstg s ON t.CampaignID = s.CampaignID)
SELECT stamped, count(*) AS n, true AS while_it_ran, CAST(CASE WHEN stamped THEN 1 ELSE 0 END AS BIGINT) AS stamps
FROM j GROUP BY stamped""")

VALID_DOMAIN_FILTER = f"""
SELECT p_partkey, p_type, p_brand FROM part
WHERE {valid('p_type')} AND p_brand IN {GOV} AND p_size <> 50"""

CODE_LABEL_MAP = with_("articles", body=f"""
SELECT id, record_type_id, {code_label('record_type_id')} AS record_type_description
FROM articles""")

# --- utilisation family -----------------------------------------------------------

_UTIL = ("articles", "links", "lp", "clicks", "clicks_alt", "flagsrc", "scoresrc")

_BASE = f"""SELECT CAST(datetime AS DATE) AS date, domain, CAST(article_number AS VARCHAR) AS article_number,
           document_title, article_record_type AS record_type_description, governance
    FROM clicks WHERE {in_window('datetime')} AND source_name IN ('ARCHIVE', 'PORTAL') AND {valid('domain')}
    UNION
    SELECT CAST(datetime AS DATE), domain, CAST(article_number AS VARCHAR), document_title,
           article_record_type, governance
    FROM clicks_alt WHERE {in_window('datetime')} AND {valid('domain')}
    UNION
    SELECT CAST(submitted_at AS DATE), domain, article_number, title, record_type, governance
    FROM flagsrc WHERE {in_window('submitted_at')} AND {valid('domain')}
    UNION
    SELECT CAST(l.link_date AS DATE), a.domain, CAST(a.article_number AS VARCHAR), a.title,
           {code_label('a.record_type_id')}, a.governance
    FROM articles a JOIN links l ON a.id = l.article_id
    WHERE {in_window('l.link_date')} AND {valid('a.domain')}"""


def _view_src(src: str) -> str:
    return f"""SELECT CAST(datetime AS DATE) AS date, domain, CAST(article_number AS VARCHAR) AS article_number,
           document_title, article_record_type AS record_type_description, governance,
           COUNT(DISTINCT click_id) AS c
    FROM {src} WHERE {in_window('datetime')} AND source_name IN ('ARCHIVE', 'MOBILE')
      AND {valid('domain')} GROUP BY 1, 2, 3, 4, 5, 6"""


_VIEWS = f"""SELECT date, domain, article_number, document_title, record_type_description, governance,
           CAST(SUM(c) AS BIGINT) AS article_view_counts
    FROM ({_view_src('clicks')} UNION ALL {_view_src('clicks_alt')}) v GROUP BY 1, 2, 3, 4, 5, 6"""

_KAV = f"""SELECT CAST(l.link_date AS DATE) AS link_date, a.domain,
           CAST(a.article_number AS VARCHAR) AS article_number, a.title AS document_title,
           {code_label('a.record_type_id')} AS record_type_description, a.governance,
           MAX(CAST(a.created_date AS DATE)) AS article_created_date,
           CAST(SUM(CASE WHEN l.link_type = 'Use' THEN 1 ELSE 0 END) AS BIGINT) AS Use_Counts,
           CAST(SUM(CASE WHEN l.link_type = 'Reference' THEN 1 ELSE 0 END) AS BIGINT) AS Reference_Counts,
           MAX(a.product_line) AS product_line, MAX(a.shared_with) AS shared_with,
           MAX(a.validation_status) AS validation_status,
           MAX(CAST(a.last_modified_date AS DATE)) AS last_modified_date, 0 AS quality_score
    FROM articles a JOIN links l ON a.id = l.article_id
    WHERE {in_window('l.link_date')} AND a.domain IS NOT NULL AND a.domain <> 'PROMO'
      AND NOT contains(a.domain, ',')
    GROUP BY 1, 2, 3, 4, 5, 6"""

_FLAGD = f"""SELECT CAST(submitted_at AS DATE) AS submitted_date, domain, article_number,
           title AS document_title, record_type AS record_type_description, governance,
           CAST(SUM(CASE WHEN status IN ('Draft', 'Withdrawn') THEN 0 ELSE 1 END) AS BIGINT)
               AS created_flag_count
    FROM flagsrc WHERE {in_window('submitted_at')} AND {valid('domain')}
    GROUP BY 1, 2, 3, 4, 5, 6"""

_LATEST = f"""SELECT article_number, article_created_date, product_line, shared_with,
           validation_status, last_modified_date
    FROM (SELECT CAST(a.article_number AS VARCHAR) AS article_number,
                 CAST(a.created_date AS DATE) AS article_created_date, a.product_line,
                 a.shared_with, a.validation_status,
                 CAST(a.last_modified_date AS DATE) AS last_modified_date,
                 row_number() OVER (PARTITION BY CAST(a.article_number AS VARCHAR)
                     ORDER BY CAST(l.link_date AS DATE) DESC NULLS LAST,
                              l.link_date DESC NULLS LAST, a.id DESC NULLS LAST) AS rn
          FROM articles a LEFT JOIN links l ON a.id = l.article_id
          WHERE {valid('a.domain')}) x
    WHERE rn = 1"""

_SCORE = """SELECT article_number, score_date, score AS quality_score
    FROM (SELECT article_number, CAST(scored_at AS DATE) AS score_date, score,
                 row_number() OVER (PARTITION BY article_number, CAST(scored_at AS DATE)
                     ORDER BY scored_at DESC NULLS LAST, score DESC NULLS LAST) AS rn
          FROM scoresrc) x
    WHERE rn = 1"""

UTILISATION_BASE = with_(*_UTIL, body=_BASE)
TWO_LEVEL_COUNTS = with_(*_UTIL, body=_VIEWS)
ACTIVITY_ROLLUP = with_(*_UTIL, body=_KAV)
ENRICH_KEYS = with_(*_UTIL, body=f"""
SELECT b.*, v.article_view_counts
FROM ({_BASE}) b JOIN ({_VIEWS}) v ON {on_keys('b', 'v', UKEYS)}""")

LATEST_PER_KEY = """
SELECT article_number, link_date, l_orderkey, l_linenumber
FROM (SELECT CAST(l_partkey AS VARCHAR) AS article_number, CAST(l_shipdate AS DATE) AS link_date,
             l_orderkey, l_linenumber,
             row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC NULLS LAST,
                 l_orderkey DESC NULLS LAST, l_linenumber DESC NULLS LAST) AS rn
      FROM lineitem) x
WHERE rn = 1"""

BACKFILL_LATEST = with_(*_UTIL, body=f"""
SELECT b.article_number, b.date, b.l_orderkey, b.l_linenumber,
       COALESCE(b.product_line, lt.product_line) AS product_line,
       COALESCE(b.shared_with, lt.shared_with) AS shared_with
FROM (SELECT CAST(l_partkey AS VARCHAR) AS article_number, CAST(l_shipdate AS DATE) AS date,
             l_orderkey, l_linenumber,
             CASE WHEN l_returnflag = 'R' THEN NULL ELSE p_type END AS product_line,
             CASE WHEN l_linestatus = 'O' THEN NULL ELSE p_brand END AS shared_with
      FROM lp) b
JOIN ({_LATEST}) lt ON b.article_number = lt.article_number""")

SCORE_ASOF_DAY = f"""
WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'),
top AS (SELECT user_id, day, value AS score
        FROM (SELECT user_id, CAST(ts AS DATE) AS day, value,
                     row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                         ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
              FROM events WHERE event_type IN ('click', 'purchase')) x
        WHERE rn = 1)
SELECT d.user_id, d.day, {r6('t.score')} AS score
FROM days d LEFT JOIN top t ON d.user_id = t.user_id AND d.day = t.day"""

_KEYS_NO_DATE = UKEYS[1:]
UTILISATION_SUMMARY = with_(*_UTIL, body=f"""
SELECT b.date, b.domain, b.article_number, b.document_title, b.record_type_description,
       b.governance, v.article_view_counts, k.Use_Counts, k.Reference_Counts,
       COALESCE(k.article_created_date, lt.article_created_date) AS article_created_date,
       COALESCE(k.product_line, lt.product_line) AS product_line,
       COALESCE(k.shared_with, lt.shared_with) AS shared_with,
       COALESCE(k.validation_status, lt.validation_status) AS validation_status,
       k.link_date,
       COALESCE(k.last_modified_date, lt.last_modified_date) AS last_modified_date,
       f.created_flag_count, {r6('s.quality_score')} AS quality_score
FROM ({_BASE}) b
JOIN ({_VIEWS}) v ON {on_keys('b', 'v', UKEYS)}
JOIN ({_KAV}) k ON {on_keys('b', 'k', UKEYS, ['link_date'] + _KEYS_NO_DATE)}
JOIN ({_FLAGD}) f ON {on_keys('b', 'f', UKEYS, ['submitted_date'] + _KEYS_NO_DATE)}
JOIN ({_LATEST}) lt ON b.article_number = lt.article_number
LEFT JOIN ({_SCORE}) s ON b.article_number = s.article_number AND b.date = s.score_date
WHERE b.governance IN {GOV}""")

# --- as-of domain counts ----------------------------------------------------------

_SEG = "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'MOTOR' ELSE c_mktsegment END"
ASOF_DOMAIN_COUNTS = f"""
WITH j AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT DATE '1998-06-30' AS date, {_SEG} AS domain, 'flag_count' AS metric,
       CAST(SUM(CASE WHEN o_orderstatus IN ('O', 'P') THEN 0 ELSE 1 END) AS BIGINT) AS value
FROM j
WHERE length(c_mktsegment) > 0 AND c_mktsegment <> 'FURNITURE' AND NOT contains(c_mktsegment, ',')
  AND CAST(o_orderdate AS DATE) <= DATE '1998-06-30'
GROUP BY 1, 2
UNION ALL
SELECT DATE '1998-06-30' AS date, {_SEG} AS domain, 'bookmark_count' AS metric,
       COUNT(DISTINCT o_orderkey) AS value
FROM j
WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-30' AND c_mktsegment <> 'FURNITURE'
GROUP BY 1, 2"""

SPLIT_EXPLODE_COUNT = """
SELECT DATE '1998-06-30' AS date, domain, COUNT(DISTINCT p_partkey) AS headline_news_count
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS domain FROM part) x
GROUP BY 1, 2"""

# --- sync family --------------------------------------------------------------------

STAGE_BOUNDS = with_("fact15", "ftgt", "fstg", body="""
SELECT (SELECT MIN(ForecastInterval) FROM fstg) AS stage_min,
       (SELECT MAX(ForecastInterval) FROM fstg) AS stage_max,
       (SELECT COUNT(*) FROM ftgt
        WHERE DateTime < (SELECT MIN(ForecastInterval) FROM fstg)
           OR DateTime > (SELECT MAX(ForecastInterval) FROM fstg)) AS target_outside""")

SYNC_INSERTS = with_("fact15", "ftgt", "fstg", body=f"""
SELECT s.ForecastInterval, s.CampaignID, s.QueueID, {r6('s.AHT')} AS AHT,
       {r6('s.CALLVOLUME')} AS CALLVOLUME
FROM fstg s
WHERE NOT EXISTS (SELECT 1 FROM ftgt t WHERE t.DateTime = s.ForecastInterval
                  AND t.CampaignID = s.CampaignID AND t.QueueID = s.QueueID)""")

# The three sync jobs step by step: mark or delete, update, insert, combine.
SYNC_DIMENSION = with_("dtgt", "dstg", body=f"""
, marked AS (
    SELECT t.* REPLACE (CASE WHEN NOT EXISTS (SELECT 1 FROM dstg s WHERE s.CampaignID = t.CampaignID)
                             THEN {NOW} ELSE t.RecordRemovedDateTime END AS RecordRemovedDateTime)
    FROM dtgt t)
, updated AS (
    SELECT m.CampaignID, s.ParentCampaignID, s.CampaignName, s.CampaignDescription, s.IsDistributed,
           m.RecordCreatedDateTime, {NOW} AS RecordLastModifiedDateTime,
           CAST(NULL AS TIMESTAMP) AS RecordRemovedDateTime
    FROM marked m JOIN dstg s ON m.CampaignID = s.CampaignID
    WHERE m.ParentCampaignID <> s.ParentCampaignID OR m.CampaignName <> s.CampaignName
       OR m.CampaignDescription <> s.CampaignDescription OR m.IsDistributed <> s.IsDistributed
       OR m.RecordRemovedDateTime IS NULL)
, remaining AS (
    SELECT * FROM marked m WHERE NOT EXISTS (SELECT 1 FROM updated u WHERE u.CampaignID = m.CampaignID))
, inserted AS (
    SELECT s.CampaignID, s.ParentCampaignID, s.CampaignName, s.CampaignDescription, s.IsDistributed,
           {NOW} AS RecordCreatedDateTime, {NOW} AS RecordLastModifiedDateTime,
           CAST(NULL AS TIMESTAMP) AS RecordRemovedDateTime
    FROM dstg s WHERE NOT EXISTS (SELECT 1 FROM dtgt t WHERE t.CampaignID = s.CampaignID))
SELECT * FROM remaining UNION ALL SELECT * FROM updated UNION ALL SELECT * FROM inserted""")


def _fact_sync(on_change: bool) -> str:
    match = ("t.DateTime = s.ForecastInterval AND t.CampaignID = s.CampaignID "
             "AND t.QueueID = s.QueueID")
    gate = ("WHERE (t.AHT IS NOT NULL) <> (s.AHT IS NOT NULL) "
            "OR (t.CALLVOLUME IS NOT NULL) <> (s.CALLVOLUME IS NOT NULL)" if on_change else "")
    return with_("fact15", "ftgt", "fstg", body=f"""
, kept AS (SELECT * FROM ftgt t WHERE EXISTS (SELECT 1 FROM fstg s WHERE {match}))
, updated AS (
    SELECT t.DateTime, t.CampaignID, t.QueueID, COALESCE(s.AHT, t.AHT) AS AHT,
           COALESCE(s.CALLVOLUME, t.CALLVOLUME) AS CALLVOLUME, t.RecordCreatedDateTime,
           {NOW} AS RecordLastModifiedDateTime
    FROM kept t JOIN fstg s ON {match} {gate})
, untouched AS (
    SELECT * FROM kept k WHERE NOT EXISTS (
        SELECT 1 FROM updated u WHERE u.DateTime = k.DateTime AND u.CampaignID = k.CampaignID
        AND u.QueueID = k.QueueID))
, inserted AS (
    SELECT s.ForecastInterval AS DateTime, s.CampaignID, s.QueueID, s.AHT, s.CALLVOLUME,
           {NOW} AS RecordCreatedDateTime, {NOW} AS RecordLastModifiedDateTime
    FROM fstg s WHERE NOT EXISTS (SELECT 1 FROM ftgt t WHERE {match}))
SELECT DateTime, CampaignID, QueueID, {r6('AHT')} AS AHT, {r6('CALLVOLUME')} AS CALLVOLUME,
       RecordCreatedDateTime, RecordLastModifiedDateTime
FROM (SELECT * FROM untouched UNION ALL SELECT * FROM updated UNION ALL SELECT * FROM inserted) x""")


SYNC_FACT_ALWAYS = _fact_sync(False)
SYNC_FACT_ON_CHANGE = _fact_sync(True)

# Days the stage has are synchronised, all other target rows stay as they are.
SYNC_STAGE_DAYS = f"""
SELECT * FROM ({SYNC_FACT_ALWAYS}) s
UNION ALL
SELECT DateTime, CampaignID, QueueID, {r6('AHT')}, {r6('CALLVOLUME')}, RecordCreatedDateTime,
       RecordLastModifiedDateTime
FROM ({CTE['ftgt'].replace('FROM fact15', f"FROM ({CTE['fact15']}) f")}) t
WHERE CAST(DateTime AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE ts >= TIMESTAMP '2024-01-08')"""

EXCEPT_DISTINCT = """
SELECT o_custkey AS custkey FROM orders
EXCEPT
SELECT c_custkey AS custkey FROM customer WHERE c_mktsegment = 'BUILDING'"""

# --- payloads -------------------------------------------------------------------------

PAYLOAD_UNPACK = """
SELECT user_id, CAST(event_id // 1000 AS BIGINT) AS block,
       CASE WHEN user_id % 2 = 0 THEN 'event_id,event_type' ELSE 'event_id,user_id' END AS schema,
       CAST(row_number() OVER (PARTITION BY user_id, event_id // 1000 ORDER BY event_id) - 1
            + CASE WHEN user_id % 3 = 0 THEN 0 ELSE 1 END AS INTEGER) AS line_no,
       CAST(event_id AS VARCHAR) AS field_1,
       CASE WHEN user_id % 2 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS field_2,
       2 AS n_fields
FROM events"""

PAYLOAD_BY_SCHEMA = """
SELECT user_id, block, event_id, event_type
FROM (SELECT user_id, CAST(event_id // 1000 AS BIGINT) AS block, event_id, event_type,
             CASE WHEN user_id % 2 = 0 THEN 'event_id,event_type' ELSE 'event_id,user_id' END
                 AS schema
      FROM events) logged
WHERE schema = 'event_id,event_type'"""

PAYLOAD_TABLES = """
SELECT user_id, CAST(event_id // 1000 AS BIGINT) AS block,
       CASE WHEN user_id % 2 = 0 THEN 'event_id,event_type' ELSE 'event_id,user_id' END AS schema,
       event_id, CASE WHEN user_id % 2 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS field_2
FROM events"""

# --- catalog tables and the whole outlook job -------------------------------------------

CATALOG_TABLES = f"""
SELECT o_orderkey, c_mktsegment, {r6('o_totalprice')} AS o_totalprice, 'crm' AS source_system
FROM orders JOIN customer ON o_custkey = c_custkey"""

CATALOG_SELF_REPLACE = """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 'third' ELSE 'second' END AS source_system
FROM orders"""

OUTLOOK_JOB = f"""
SELECT * EXCLUDE (ViewName), ViewName AS VerintWfmStaffingMapViewName FROM ({STAFFING_OUTLOOK}) o"""

# --- sinks ------------------------------------------------------------------------------

SINK_OVERWRITE = """
SELECT o_orderkey, lower(o_orderpriority) AS o_orderpriority, o_custkey, 'refresh' AS source_system FROM orders"""

SINK_CLUSTERED = f"""
SELECT user_id AS QueueID, time_bucket(INTERVAL 15 MINUTE, ts) AS DateTime, event_id,
       {r6('value')} AS value
FROM events"""

SINK_INTERLEAVED = f"""
SELECT user_id AS QueueID, time_bucket(INTERVAL 15 MINUTE, ts) AS DateTime, event_type, event_id,
       {r6('value')} AS value
FROM events"""

EQUAL_DEPTH_SLICES = """
SELECT count(*) AS rows, true AS balanced FROM orders"""

ORACLE: dict[str, str] = {
    "validity_join": VALIDITY_JOIN,
    "validity_join_binned": VALIDITY_JOIN,
    "validity_join_adaptive": VALIDITY_JOIN,
    "validity_join_merge": VALIDITY_JOIN,
    "half_hour_floor": HALF_HOUR_FLOOR,
    "range_filter_inclusive": RANGE_FILTER_INCLUSIVE,
    "weighted_average": WEIGHTED_AVERAGE,
    "ratio_of_sums": RATIO_OF_SUMS,
    "reaggregate_half_hour": REAGGREGATE_HALF_HOUR,
    "lookup_join": LOOKUP_JOIN,
    "contract_cutoff": CONTRACT_CUTOFF,
    "staffing_outlook": STAFFING_OUTLOOK,
    "staffing_outlook_zero_fill": STAFFING_OUTLOOK_ZERO_FILL,
    "reporting_week": REPORTING_WEEK,
    "run_week": RUN_WEEK,
    "load_stamp": LOAD_STAMP,
    "valid_domain_filter": VALID_DOMAIN_FILTER,
    "code_label_map": CODE_LABEL_MAP,
    "utilisation_base": UTILISATION_BASE,
    "two_level_counts": TWO_LEVEL_COUNTS,
    "activity_rollup": ACTIVITY_ROLLUP,
    "enrich_keys": ENRICH_KEYS,
    "latest_per_key": LATEST_PER_KEY,
    "backfill_latest": BACKFILL_LATEST,
    "score_asof_day": SCORE_ASOF_DAY,
    "utilisation_summary": UTILISATION_SUMMARY,
    "asof_domain_counts": ASOF_DOMAIN_COUNTS,
    "split_explode_count": SPLIT_EXPLODE_COUNT,
    "chain_join": CHAIN_JOIN,
    "slot_report": SLOT_REPORT,
    "unpivot_slots": UNPIVOT_SLOTS,
    "exclude_windows": EXCLUDE_WINDOWS,
    "stage_bounds": STAGE_BOUNDS,
    "sync_inserts": SYNC_INSERTS,
    "sync_dimension": SYNC_DIMENSION,
    "sync_fact_always": SYNC_FACT_ALWAYS,
    "sync_fact_on_change": SYNC_FACT_ON_CHANGE,
    "sync_dimension_prefiltered": SYNC_DIMENSION,
    "sync_write_back": SYNC_FACT_ON_CHANGE,
    "sync_partitions": SYNC_FACT_ON_CHANGE,
    "sync_partitions_of_stage": SYNC_STAGE_DAYS,
    "except_distinct": EXCEPT_DISTINCT,
    "payload_unpack": PAYLOAD_UNPACK,
    "payload_by_schema": PAYLOAD_BY_SCHEMA,
    "payload_tables": PAYLOAD_TABLES,
    "sync_dimension_repeats": SYNC_DIMENSION,
    "catalog_tables": CATALOG_TABLES,
    "catalog_self_replace": CATALOG_SELF_REPLACE,
    "outlook_job": OUTLOOK_JOB,
    "sink_overwrite": SINK_OVERWRITE,
    "sink_clustered": SINK_CLUSTERED,
    "sink_interleaved": SINK_INTERLEAVED,
    "equal_depth_slices": EQUAL_DEPTH_SLICES,
}
