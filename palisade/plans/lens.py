"""How the driver tables stand in for assets, findings and observations.

Each lens is one SQL text that both engines read, so that a query and its oracle start from the same rows and
differ only in the operator under test. ``{ts}`` is the naive timestamp type of the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.session import written

TABLES = ("customer", "nation", "region", "orders", "lineitem", "part", "supplier", "events", "documents", "pages")

# The moment ages are measured from; never the wall clock.
AS_OF = "2002-01-01"

ASSETS = """
SELECT 'asset-' || CAST(c.c_custkey AS STRING) AS assetId,
       CASE WHEN c.c_custkey % 11 = 0
            THEN 'CUSTOMER-' || lpad(CAST(c.c_custkey AS STRING), 9, '0') || '.' || n.n_name || '.EXAMPLE.'
            ELSE 'customer-' || lpad(CAST(c.c_custkey AS STRING), 9, '0') || '.' || lower(n.n_name) || '.example'
       END AS hostname,
       c.c_acctbal AS assetHyScoreV2,
       CASE WHEN c.c_custkey % 7 <> 0
            THEN '10.' || CAST(CAST(floor(c.c_custkey / 65536) AS BIGINT) % 256 AS STRING)
                 || '.' || CAST(CAST(floor(c.c_custkey / 256) AS BIGINT) % 256 AS STRING)
                 || '.' || CAST(c.c_custkey % 256 AS STRING) END AS ipAddress,
       CASE WHEN c.c_custkey % 13 <> 0 THEN r.r_name END AS assetOsPrimary,
       n.n_name AS country,
       CASE WHEN c.c_custkey % 17 <> 0 THEN c.c_mktsegment END AS businessUnit,
       CAST(DATE '1992-01-01' + CAST(c.c_custkey % 1000 AS INT) AS {ts}) AS firstSeen,
       CAST(DATE '2001-01-01' + CAST(c.c_custkey % 365 AS INT) AS {ts}) AS lastSeen
FROM {customer} c
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

_SIGHTING = """
SELECT 'asset-' || CAST([asset] AS STRING) AS assetId,
       'customer-' || lpad(CAST([asset] AS STRING), 9, '0') AS hostname,
       CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) AS findingId,
       CASE WHEN l.l_partkey % 19 <> 0 THEN 'Weakness in lib' || CAST(l.l_partkey % 60 AS STRING) END AS findingName,
       CASE o.o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'CLOSED' END AS status,
       'VT-' || CAST(l.l_partkey % 100 AS STRING) AS vulnerabilityTypeId,
       CASE WHEN l.l_quantity <> 13 THEN round(l.l_extendedprice / [scale], 2) END AS hyScoreV2,
       CASE WHEN l.l_partkey % 10 = 0 THEN NULL
            WHEN l.l_linenumber = 2
            THEN ' cve-' || CAST(year(l.l_shipdate) AS STRING) || '-' || CAST(1000 + l.l_partkey % 40 AS STRING)
            ELSE 'CVE-' || CAST(year(l.l_shipdate) AS STRING) || '-' || CAST(1000 + l.l_partkey % 40 AS STRING)
       END AS cve,
       CASE WHEN l.l_tax < 0.075 THEN round(l.l_discount * 100, 1) END AS cvssScore,
       CASE WHEN l.l_suppkey % 3 = 0 THEN 'CVSS:3.1/AV:N/PR:L/S:' || CAST(l.l_linenumber AS STRING) END AS cvssVector,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'medium'
            WHEN '5-LOW' THEN 'LOW' END AS severity,
       'Observed in release ' || CAST(l.l_suppkey % 7 AS STRING) AS description,
       CASE WHEN l.l_partkey % 5 = 0 THEN NULL WHEN l.l_partkey % 5 = 1 AND l.l_linenumber = 1 THEN '  '
            WHEN l.l_linenumber = 4 THEN 'UPDATE LIB' || CAST(l.l_partkey % 60 AS STRING)
                 || ' TO A FIXED RELEASE AND RESTART THE SERVICE '
            ELSE 'Update lib' || CAST(l.l_partkey % 60 AS STRING) || ' to a fixed release and restart the service'
       END AS remediation,
       1 + l.l_suppkey % 1000 AS port,
       CASE WHEN l.l_suppkey % 2 = 0 THEN 'tcp' ELSE 'udp' END AS protocol,
       CASE WHEN l.l_linestatus = 'O' THEN 'https' END AS service,
       CASE l.l_suppkey % 5 WHEN 0 THEN 'QUALYS_VM' WHEN 1 THEN 'crowdstrike' WHEN 2 THEN 'Azure'
            WHEN 3 THEN 'TENABLE_IO' END AS provider,
       o.o_orderdate AS firstSeen,
       CASE WHEN l.l_quantity <> 7 THEN l.l_shipdate[later] END AS lastSeen,
       l.l_returnflag = 'R' AND l.l_quantity > 45 AS cisaKev
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""


def _sighting(asset: str, scale: str, later: str) -> str:
    return _SIGHTING.replace("[asset]", asset).replace("[scale]", scale).replace("[later]", later)


# Some findings sit on two assets; the second sighting has another score and is older or newer than the first. The divisors are
# odd: a price in cents over an odd number never lies halfway between two cents, where engines round differently.
SEARCH = (
    _sighting("o.o_custkey", "105", "")
    + "UNION ALL"
    + _sighting("(o.o_custkey + 1)", "CASE WHEN l.l_partkey % 2 = 0 THEN 251 ELSE 81 END",
                " + CASE WHEN l.l_suppkey % 2 = 0 THEN INTERVAL '9' DAY ELSE INTERVAL '-4' DAY END")
    + "WHERE l.l_linenumber = 3 AND l.l_orderkey % 4 < 2\n"
)

# Detail rows: one per finding copy, with evidence columns taken from the part table.
DETAILS = """
SELECT CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) AS findingId,
       CASE WHEN l.l_quantity <> 11 THEN 'asset-' || CAST(o.o_custkey AS STRING) END AS assetId,
       'customer-' || lpad(CAST(o.o_custkey AS STRING), 9, '0') AS hostname,
       CASE WHEN l.l_partkey % 19 <> 0 THEN p.p_type || ' weakness' END AS findingName,
       CASE l.l_suppkey % 5 WHEN 0 THEN 'QUALYS_VM' WHEN 1 THEN 'crowdstrike' WHEN 2 THEN 'Azure'
            WHEN 3 THEN 'TENABLE_IO' END AS providerId,
       CASE WHEN l.l_tax < 0.075 THEN round(l.l_discount * 100, 1) END AS cvssScore,
       CASE WHEN l.l_quantity <> 13 THEN round(l.l_extendedprice / 105, 2) END AS hyScoreV2,
       round(l.l_tax * 10, 2) AS epssScore,
       l.l_returnflag = 'R' AND l.l_quantity > 45 AS cisaKev,
       CASE WHEN p.p_size % 4 <> 0 THEN 'Install the ' || p.p_brand || ' release of ' || p.p_name END AS remediation,
       CASE WHEN l.l_partkey % 10 <> 0
            THEN 'CVE-' || CAST(year(l.l_shipdate) AS STRING) || '-' || CAST(1000 + l.l_partkey % 40 AS STRING)
       END AS firstCve,
       CASE WHEN l.l_partkey % 3 = 0
            THEN 'CVE-' || CAST(year(o.o_orderdate) AS STRING) || '-' || CAST(5000 + l.l_suppkey % 40 AS STRING)
       END AS secondCve,
       CASE WHEN p.p_size % 3 <> 0 THEN p.p_name END AS component,
       CASE WHEN p.p_size % 7 <> 0 THEN CAST(p.p_size AS STRING) || '.' || CAST(l.l_linenumber AS STRING) || '.0'
       END AS detectedVersion,
       CASE WHEN p.p_size % 3 <> 1 THEN CAST(p.p_size + 1 AS STRING) || '.0.1' END AS expectedVersion,
       CASE WHEN l.l_partkey % 4 = 0 THEN 'HKLM\\SOFTWARE\\' || p.p_type || '\\K' || CAST(l.l_suppkey AS STRING)
       END AS registryPath,
       CASE WHEN l.l_partkey % 2 = 0 THEN '/opt/' || lower(p.p_type) || '/lib' || CAST(l.l_suppkey AS STRING) || '.so'
       END AS filePath,
       CASE WHEN l.l_partkey % 6 = 0 THEN '/usr/lib/' || lower(p.p_type) || '.so' END AS secondFilePath,
       o.o_orderdate AS firstSeen,
       CASE WHEN l.l_quantity <> 7 THEN l.l_shipdate END AS lastSeen,
       l.l_shipdate AS extractedAt
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {part} p ON l.l_partkey = p.p_partkey
"""

OBSERVATIONS = """
SELECT 'finding-' || CAST(user_id AS STRING) AS findingId, event_id AS eventId, ts AS observedAt,
       event_type <> 'error' AS detected, event_type AS label, value AS score
FROM {events}
"""

LENSES = {"assets": ASSETS, "search": SEARCH, "details": DETAILS, "observations": OBSERVATIONS}

# Every pair of an asset and a finding, with the columns of the finding's newest sighting.
EVERY_FACT = "SELECT m.assetId, m.hostname, f.* FROM merged m JOIN findings f USING (findingId)"

# Steps that many oracles share, on top of the lenses.
SHARED = {
    "merged": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY assetId, findingId
        ORDER BY lastSeen DESC NULLS LAST, hyScoreV2 DESC NULLS LAST, firstSeen DESC NULLS LAST,
                 vulnerabilityTypeId DESC, port DESC, cvssScore DESC NULLS LAST, cve DESC NULLS LAST,
                 description DESC, remediation DESC NULLS LAST, service DESC NULLS LAST, cisaKev DESC) AS rn
        FROM search) WHERE rn = 1""",
    "findings": """SELECT findingId, findingName, status, vulnerabilityTypeId, hyScoreV2, cve, cvssScore, cvssVector, severity,
        description, remediation, port, protocol, service, provider, firstSeen, lastSeen, cisaKev
        FROM (SELECT *, row_number() OVER (PARTITION BY findingId ORDER BY lastSeen DESC NULLS LAST,
              hyScoreV2 DESC NULLS LAST, firstSeen DESC NULLS LAST, vulnerabilityTypeId DESC, port DESC,
              cvssScore DESC NULLS LAST, cve DESC NULLS LAST, description DESC, remediation DESC NULLS LAST,
              service DESC NULLS LAST, cisaKev DESC) AS rf
              FROM merged) WHERE rf = 1""",
    "instances": """SELECT a.assetId, a.hostname, a.assetHyScoreV2, a.ipAddress, a.assetOsPrimary, a.country,
        a.businessUnit, a.firstSeen AS assetFirstSeen, a.lastSeen AS assetLastSeen, m.findingId, f.findingName,
        f.status, f.hyScoreV2, f.cve, f.cvssScore, f.cvssVector, f.severity, f.description, f.remediation, f.port, f.protocol,
        f.service, f.provider, f.firstSeen, f.lastSeen, f.cisaKev
        FROM merged m JOIN assets a USING (assetId) JOIN findings f USING (findingId)""",
    "facts": f"""{EVERY_FACT}
        WHERE m.assetId IN (SELECT assetId FROM assets)""",
}
_NEEDS = {"merged": ("search",), "findings": ("merged",), "instances": ("assets", "findings"), "facts": ("assets", "findings")}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table as it is; how a file is split is the session's ``spark.sql.files`` settings."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SOLD = "{lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey"
_WITH_PART = _SOLD + " JOIN {part} p ON l.l_partkey = p.p_partkey"
_FINDING_ID = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"


def sold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders, joined and written once, for queries that open the search and detail lenses together."""
    items, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    lenses = SEARCH + DETAILS
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
    return written(joined.select(*[name for name in joined.columns if f".{name}" in lenses]), "sold")


def lens(spark: SparkSession, sf_dir: str, name: str, sold: DataFrame | None = None) -> DataFrame:
    """The rows of a lens; with ``sold`` from :func:`sold_items` they come without joining line items and orders again."""
    text = LENSES[name]
    if sold is not None:
        # Dealt by the finding before its texts are made: the plain columns are what moves, and the rows of a finding stay together.
        if _WITH_PART in text:
            part = read(spark, sf_dir, "part")
            sold = sold.join(part, sold["l_partkey"] == part["p_partkey"])
        sold = sold.repartition(F.expr(_FINDING_ID))
        text = text.replace(_WITH_PART, "{sold} l").replace(_SOLD, "{sold} l").replace("o.o_", "l.o_").replace("p.p_", "l.p_")
    used = {table: read(spark, sf_dir, table) for table in TABLES if "{" + table + "}" in text}
    if sold is not None:
        used["sold"] = sold
    # The driver's SQL parser reads a backslash in a literal as an escape.
    text = text.replace("{ts}", "TIMESTAMP_NTZ").replace("\\", "\\\\")
    return spark.sql(text, **used)


def oracle(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """An oracle text: the named lenses and shared steps as CTEs, then the body."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    plain = {table: table for table in TABLES}
    parts = [
        f"{name} AS ({LENSES[name].format(ts='TIMESTAMP', **plain) if name in LENSES else SHARED[name]})"
        for name in wanted
    ]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
