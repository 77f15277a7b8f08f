"""Per-asset intelligence for all assets in one plan: findings, correlation, components, actions, posture, quality.

Tables are flat. Lists that can grow with an asset, a CVE or a component are child rows; ``skew.listed`` turns them
into JSON lists in bounded parts where a document form is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade import fixed_values as fixed
from palisade.functions import scoring
from palisade.functions.dates import age_days, day_text
from palisade.functions.json_text import text_list
from palisade.functions.nulls import blank_to_null, first_present, zero_if_null
from palisade.functions.text import normalize_cve, normalize_scanner
from palisade.operators.skew import ordinals, top_per_key


def _cve_list(row_cve: Column, listed: Column) -> Column:
    """Valid ids of the row and of the detail list, distinct and sorted."""
    every = F.concat(F.array(normalize_cve(row_cve)), F.transform(listed, normalize_cve))
    return F.array_sort(F.array_distinct(F.array_compact(every)))


def assemble_findings(rows: DataFrame, details: DataFrame, as_of: str) -> DataFrame:
    """Search rows completed by their detail row: scanner, CVEs, dates, age, state, priority and drivers.

    ``details`` has one row per (finding, asset), with columns prefixed ``d_``; lists are JSON text.
    """
    joined = rows.join(details, ["findingId", "assetId"], "left")
    first = F.coalesce("d_firstSeen", "firstSeen")
    last = F.coalesce("d_lastSeen", "lastSeen")
    base = joined.select(
        "assetId", "findingId",
        normalize_scanner(first_present(F.col("d_providerId"), F.col("provider"))).alias("scanner"),
        _cve_list(F.col("cve"), text_list(F.col("d_cvesJson"))).alias("cves"),
        first_present(F.col("d_findingName"), F.col("findingName")).alias("title"),
        first_present(F.col("d_cveDescriptionsJson"), F.col("description")).alias("description"),
        scoring.severity(F.col("severity"), F.col("hyScoreV2"), F.col("cvssScore")).alias("severity"),
        F.col("hyScoreV2").alias("trs"),
        F.coalesce(F.when(F.col("d_cvssScore") != 0, F.col("d_cvssScore")), F.col("cvssScore")).alias("cvss"),
        first_present(F.col("d_status"), F.col("status"), F.lit("UNKNOWN")).alias("status"),
        first.alias("firstSeen"), last.alias("lastSeen"), age_days(first, as_of).alias("ageDays"),
        scoring.observation_count(first, last).alias("observationCount"),
        scoring.bounds_state(first, last).alias("historyState"),
        blank_to_null(F.col("d_vulnerableSoftwareJson")).alias("affectedProduct"),
        F.try_element_at(text_list(F.col("d_detectedVersionsJson")), F.lit(1)).alias("detectedVersion"),
        F.try_element_at(text_list(F.col("d_expectedVersionsJson")), F.lit(1)).alias("targetVersion"),
        first_present(F.col("d_remediation"), F.col("remediation")).alias("recommendation"),
        F.col("d_cisaKev").alias("cisaKev"), F.col("d_epssScore").alias("epss"),
    )
    return base.withColumns({
        "priority": scoring.priority(F.col("trs"), F.col("cvss"), F.col("cisaKev")),
        "riskDrivers": scoring.risk_drivers(
            F.col("trs"), F.col("severity"), F.col("historyState"), F.col("cisaKev"), F.col("firstSeen"),
            F.col("lastSeen"), F.col("observationCount")),
    })


def bound_observations(findings: DataFrame) -> DataFrame:
    """The one or two observations that the bounds of a finding stand for."""
    both = F.array_compact(F.array(
        F.when(F.col("firstSeen").isNotNull(), F.struct(
            F.col("firstSeen").alias("observedAt"), F.lit(True).alias("isFirst"))),
        F.when(F.col("lastSeen").isNotNull() & ~F.col("lastSeen").eqNullSafe(F.col("firstSeen")), F.struct(
            F.col("lastSeen").alias("observedAt"), F.lit(False).alias("isFirst"))),
    ))
    return findings.select("*", F.explode(both).alias("o")).select(
        *findings.columns, "o.observedAt", F.lit(True).alias("detected"), "o.isFirst")


def finding_cve_rows(findings: DataFrame) -> DataFrame:
    return findings.select("*", F.explode("cves").alias("cve"))


def _top_severity() -> Column:
    rank = F.create_map(*[F.lit(x) for pair in fixed.SEVERITY_RANK.items() for x in pair])
    return F.max(F.struct(F.coalesce(F.try_element_at(rank, F.col("severity")), F.lit(0)), F.col("severity")))["severity"]


def _positive(value: Column) -> Column:
    return F.when(value != 0, value)


def vulnerabilities(findings: DataFrame) -> DataFrame:
    """One row per (asset, CVE), with scores, scanners and whether several of them agree.

    Scanner names are a small vocabulary; finding ids and products are in their own child tables.
    """
    grouped = finding_cve_rows(findings).groupBy("assetId", "cve").agg(
        F.min(F.when(F.col("title").isNotNull(), F.struct(
            (-zero_if_null(F.col("trs"))).alias("rank"), F.col("findingId"), F.col("title"))))["title"].alias("title"),
        _top_severity().alias("severity"),
        F.max(zero_if_null(F.col("trs"))).alias("maxTrs"),
        F.count(F.lit(1)).alias("findingCount"),
        _positive(F.max(zero_if_null(F.col("cvss")))).alias("cvss"),
        _positive(F.max(zero_if_null(F.col("epss")))).alias("epss"),
        F.bool_or(F.coalesce("cisaKev", F.lit(False))).alias("cisaKev"),
        F.array_sort(F.collect_set("scanner")).alias("sources"),
        F.min("firstSeen").alias("firstSeen"), F.max("lastSeen").alias("lastSeen"),
        _positive(F.max(F.coalesce("ageDays", F.lit(0)))).alias("ageDays"),
        F.sum("observationCount").alias("observationCount"),
        F.bool_or(F.col("historyState") == "REOPENED").alias("_reopened"),
        F.bool_or(F.col("historyState") == "PERSISTENT").alias("_persistent"),
    )
    several = F.size("sources") > 1
    return grouped.select(
        "assetId", "cve", "title", "severity", "maxTrs", "findingCount", "cvss", "epss", "cisaKev",
        F.array_join("sources", ", ").alias("sources"), F.size("sources").alias("sourceCount"),
        F.when(several, "multi_source_confirmed").otherwise("single_source").alias("correlation"),
        F.when(several, "HIGH").otherwise("STANDARD").alias("confidence"),
        "firstSeen", "lastSeen", "ageDays", "observationCount",
        F.when(F.col("_reopened"), "REOPENED").when(F.col("_persistent"), "PERSISTENT").otherwise("UNKNOWN").alias("state"),
    )


def vulnerability_findings(findings: DataFrame) -> DataFrame:
    return finding_cve_rows(findings).select("assetId", "cve", "findingId", "affectedProduct", "title")


def scan_history(findings: DataFrame) -> DataFrame:
    """Per asset, day and scanner: open, by severity, new and reopened, rebuilt from the observation bounds."""
    def count(column: str, value: str) -> Column:
        return F.count_if(F.col(column) == value)

    return bound_observations(findings).groupBy(
        "assetId", day_text(F.col("observedAt")).alias("scanDate"), "scanner"
    ).agg(
        F.count(F.lit(1)).alias("openFindings"),
        count("severity", "CRITICAL").alias("criticalCount"), count("severity", "HIGH").alias("highCount"),
        count("severity", "MEDIUM").alias("mediumCount"), count("severity", "LOW").alias("lowCount"),
        count("historyState", "NEW").alias("newCount"), F.lit(0).cast("bigint").alias("resolvedCount"),
        count("historyState", "REOPENED").alias("reopenedCount"),
        F.lit(fixed.HISTORY_METHOD).alias("method"),
    )


def component_findings(component_rows: DataFrame, findings: DataFrame) -> DataFrame:
    """Every component entry under each asset that has its finding, with the finding's CVEs, scores and priority."""
    own = findings.select("assetId", "findingId", "trs", "priority", "cves", "cvss", "recommendation")
    return component_rows.drop("assetId").join(own, "findingId")


def components(component_rows: DataFrame, findings: DataFrame) -> DataFrame:
    """One row per (asset, component); descriptive fields come from the highest ranked finding.

    Versions and findings are child rows: :func:`component_versions`, :func:`component_findings`.
    """
    # Moved once: the distinct payloads of a component are counted where its rows are.
    return described_components(component_findings(component_rows, findings).repartition("assetId", "componentId"))


def described_components(linked: DataFrame) -> DataFrame:
    described = ("vendor", "product", "component", "package", "ecosystem", "language")
    best = F.min_by(
        F.struct(*described), F.struct(-zero_if_null(F.col("trs")), F.col("findingId"), F.col("scanner")))
    return linked.groupBy("assetId", "componentId").agg(
        best.alias("b"),
        F.count(F.lit(1)).alias("findingCount"),
        F.count_distinct("sourcePayloadReference").alias("sourcePayloads"),
    ).select("assetId", "componentId", "b.*", "findingCount", "sourcePayloads")


def component_versions(component_rows: DataFrame, findings: DataFrame) -> DataFrame:
    """The distinct installed and required versions of a component, as rows."""
    return linked_versions(component_findings(component_rows, findings))


def linked_versions(linked: DataFrame) -> DataFrame:
    both = F.array(F.struct(F.lit("installed").alias("kind"), F.col("installedVersion").alias("version")),
                   F.struct(F.lit("required").alias("kind"), F.col("requiredVersion").alias("version")))
    rows = linked.select("assetId", "componentId", F.inline(both))
    return rows.where("version <> ''").distinct()


def component_risk(component_rows: DataFrame, findings: DataFrame) -> DataFrame:
    """Name, entries, distinct CVEs and priorities per component."""
    return linked_risk(component_findings(component_rows, findings))


def linked_risk(linked: DataFrame) -> DataFrame:
    order = F.struct(-zero_if_null(F.col("trs")), F.col("findingId"), F.col("scanner"))
    counted = linked.groupBy("assetId", "componentId").agg(
        F.min_by(F.struct("component", "package", "product"), order).alias("b"),
        F.count(F.lit(1)).alias("findingCount"),
        *[F.count_if(F.col("priority") == p).alias(f"{p.lower()}Count") for p in fixed.PRIORITIES])
    cves = linked.select("assetId", "componentId", F.explode("cves").alias("cve")).groupBy(
        "assetId", "componentId").agg(F.count_distinct("cve").alias("cveCount"))
    name = first_present(F.col("b.component"), F.col("b.package"), F.col("b.product"))
    return counted.withColumn("name", name).drop("b").join(cves, ["assetId", "componentId"], "left").fillna(0, ["cveCount"])


def attach_occurrences(component_rows: DataFrame, occurrences: DataFrame, findings: DataFrame) -> DataFrame:
    """Occurrences of known components under each asset that has the finding, one row each; others are dropped."""
    own = findings.select("assetId", "findingId")
    known = component_rows.select("findingId", "componentId").join(own, "findingId").select("assetId", "componentId").distinct()
    rows = occurrences.select("findingId", "componentId", "occurrenceId", "installPath").where("componentId IS NOT NULL")
    placed = rows.join(own, "findingId").drop("findingId")
    return placed.join(known, ["assetId", "componentId"])


def _action_key(findings: DataFrame) -> DataFrame:
    return findings.withColumns({
        "_text": F.trim(F.coalesce("recommendation", F.lit(""))),
        "_target": F.coalesce("targetVersion", F.lit("")),
    })


def actions(findings: DataFrame) -> DataFrame:
    """Remediation actions per (asset, recommendation, target version), numbered inside the asset by text.

    The type is that of the group's highest ranked finding; ids are in ``action_findings`` and ``action_cves``.
    """
    keyed = _action_key(findings)
    keys = ["assetId", "_text", "_target"]
    top = F.min_by(
        scoring.action_type(F.col("recommendation"), F.col("targetVersion")),
        F.struct(-zero_if_null(F.col("trs")), F.col("findingId")))
    grouped = keyed.groupBy(*keys).agg(
        F.min("priority").alias("priority"), top.alias("type"), F.count(F.lit(1)).alias("findingCount"),
        F.max(zero_if_null(F.col("trs"))).alias("maxTrs"),
        F.min_by("affectedProduct", F.struct(-zero_if_null(F.col("trs")), F.col("findingId"))).alias("product"))
    cves = keyed.select(*keys, F.explode("cves").alias("cve")).groupBy(*keys).agg(F.count_distinct("cve").alias("cveCount"))
    whole = grouped.join(cves, keys, "left").fillna(0, ["cveCount"])
    numbered = ordinals(whole, ["assetId"], ["_text", "_target"], "order")
    return numbered.select(
        "assetId", F.format_string("REM-%03d", "order").alias("id"), "order", "priority", "type",
        F.coalesce(blank_to_null(F.col("_text")), F.lit(fixed.ACTION_NO_RECOMMENDATION)).alias("action"),
        F.col("_text").alias("recommendation"), F.col("_target").alias("targetVersion"), "findingCount", "cveCount",
        F.concat(F.col("findingCount").cast("string"), F.lit(" finding(s), "), F.col("cveCount").cast("string"),
                 F.lit(" CVE, TRS max "), scoring.whole(F.col("maxTrs"))).alias("reason"),
        F.lit(fixed.OWNER).alias("owner"), F.lit(fixed.OWNER_SOURCE).alias("ownerSource"), "product",
    )


def action_findings(findings: DataFrame) -> DataFrame:
    return _action_key(findings).select(
        "assetId", F.col("_text").alias("recommendation"), F.col("_target").alias("targetVersion"), "findingId")


def action_cves(findings: DataFrame) -> DataFrame:
    return _action_key(findings).select(
        "assetId", F.col("_text").alias("recommendation"), F.col("_target").alias("targetVersion"),
        F.explode("cves").alias("cve")).distinct()


def campaigns(actions_: DataFrame) -> DataFrame:
    """Actions with a recommendation and more than one finding."""
    digest = F.upper(F.substring(F.sha2(F.concat_ws("|", "recommendation", "targetVersion"), 256), 1, 10))
    title = F.left(F.regexp_extract("action", r"^([^\r\n]*)", 1), F.lit(120))
    return actions_.where((F.col("recommendation") != "") & (F.col("findingCount") > 1)).select(
        "assetId", F.concat(F.lit("RC-"), digest).alias("campaignId"), title.alias("title"), "product", "priority",
        F.col("findingCount").alias("estimatedFindingsClosed"), "cveCount", F.lit(fixed.CAMPAIGN_REASON).alias("reason"))


def validation_checks(actions_: DataFrame, findings: DataFrame) -> DataFrame:
    """One pending check per action and one per scanner of the asset."""
    technical = actions_.select(
        "assetId", F.lit("technical").alias("kind"), F.format_string("VAL-%03d", "order").alias("checkId"),
        F.lit(fixed.VALIDATION_CHECK).alias("check"), F.lit("PENDING").alias("expected"))
    scanner = findings.select("assetId", "scanner").distinct().select(
        "assetId", F.lit("scanner").alias("kind"), F.col("scanner").alias("checkId"),
        F.lit(None).cast("string").alias("check"), F.lit("NOT_DETECTED").alias("expected"))
    return technical.unionByName(scanner)


def posture(findings: DataFrame, vulnerabilities_: DataFrame) -> DataFrame:
    """Totals per asset: severities, priorities, age, persistence, correlation and the overall priority."""
    def count(column: str, value: str) -> Column:
        return F.count_if(F.col(column) == value)

    own = findings.groupBy("assetId").agg(
        F.count(F.lit(1)).alias("totalFindings"),
        *[count("severity", s).alias(s.lower()) for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW")],
        *[count("priority", p).alias(p.lower()) for p in fixed.PRIORITIES],
        _positive(F.max(F.coalesce("ageDays", F.lit(0)))).alias("oldestOpenFindingDays"),
        count("historyState", "PERSISTENT").alias("persistentFindings"),
        count("historyState", "REOPENED").alias("reopenedFindings"),
        F.min("priority").alias("overallPriority"),
    )
    shared = vulnerabilities_.groupBy("assetId").agg(
        F.count(F.lit(1)).alias("uniqueCves"), F.count_if(F.col("sourceCount") > 1).alias("confirmedByMultipleSources"))
    return own.join(shared, "assetId", "left").fillna(0, ["uniqueCves", "confirmedByMultipleSources"])


def concentration(findings: DataFrame, top: int = 5) -> DataFrame:
    """Share of an asset's score that its five highest findings hold, and their ids in order."""
    totals = findings.groupBy("assetId").agg(
        F.sum(zero_if_null(F.col("trs"))).alias("_total"),
        F.count_if(F.col("priority").isin("P1", "P2")).alias("totalP1P2"))
    order = [zero_if_null(F.col("trs")).desc(), F.col("findingId").asc()]
    best = top_per_key(findings.select("assetId", "findingId", "trs"), ["assetId"], order, top, "_place")
    leaders = best.groupBy("assetId").agg(
        F.sum(zero_if_null(F.col("trs"))).alias("_top"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", "findingId"))), lambda x: x["findingId"]),
                     ",").alias("topFindingIds"))
    return totals.join(leaders, "assetId").select(
        "assetId", "totalP1P2", F.least(F.lit(top).cast("bigint"), "totalP1P2").alias("top5P1P2"),
        F.when(F.col("_total") != 0, F.bround(F.col("_top") / F.col("_total"), 4)).alias("top5Share"), "topFindingIds")


def completeness(findings: DataFrame) -> DataFrame:
    """How many of the four tracked fields are filled, what is missing, and date conflicts, per asset."""
    return _counted_completeness(findings).drop("_n")


def _counted_completeness(findings: DataFrame) -> DataFrame:
    def filled(name: str) -> Column:
        return F.when(F.col(name).isNotNull() & (F.col(name).cast("string") != ""), 1).otherwise(0)

    tracked = ("title", "firstSeen", "lastSeen", "recommendation")
    total = None
    for name in tracked:
        total = filled(name) if total is None else total + filled(name)
    return findings.groupBy("assetId").agg(
        F.bround(100 * F.sum(total) / F.greatest(F.lit(1), F.count(F.lit(1)) * len(tracked)), 1).alias("completenessScore"),
        F.sum(1 - filled("firstSeen")).alias("missingFirstSeen"),
        F.count_if(F.col("scanner") == "UNKNOWN").alias("missingScanner"),
        F.sum(1 - filled("title")).alias("missingTitle"),
        F.count_if(F.col("cvss").isNull()).alias("missingCvss"),
        F.sum(1 - filled("recommendation")).alias("missingRecommendation"),
        F.count_if(F.col("firstSeen") > F.col("lastSeen")).alias("dateConflicts"),
        F.count(F.lit(1)).alias("_n"),
    )


def missing_fields(findings: DataFrame, assets: DataFrame) -> DataFrame:
    """Missing-field notes per asset, as rows: ``findings.title (3/40)`` or ``asset.os``."""
    # A group of findings without an asset id has no notes.
    quality = _counted_completeness(findings).where("assetId IS NOT NULL")
    fields = {"findings.first_seen": "missingFirstSeen", "findings.scanner": "missingScanner",
              "findings.title": "missingTitle", "findings.cvss": "missingCvss",
              "findings.recommendation": "missingRecommendation"}
    notes = F.array_compact(F.array(*[
        F.when(F.col(column) > 0, F.concat(F.lit(f"{name} ("), F.col(column).cast("string"), F.lit("/"),
                                           F.col("_n").cast("string"), F.lit(")")))
        for name, column in fields.items()]))
    own = F.array_compact(F.array(
        F.when(blank_to_null(F.col("assetOsPrimary")).isNull(), "asset.os"),
        F.when(blank_to_null(F.col("businessUnit")).isNull(), "asset.business.owner")))
    return quality.select("assetId", F.explode(notes).alias("missing")).unionByName(
        assets.select("assetId", F.explode(own).alias("missing")))


def event_rollup(events: DataFrame, findings: DataFrame) -> DataFrame:
    """First vulnerability, latest event and number of events per asset, over the events of its findings."""
    # Events are reduced to one row per finding before they meet the assets that have it.
    each = events.groupBy("findingId").agg(F.max("eventTimestamp").alias("last"), F.count(F.lit(1)).alias("n"))
    own = findings.select("assetId", "findingId", "firstSeen").join(each, "findingId", "left")
    known = F.col("assetId").isNotNull()
    return own.groupBy("assetId").agg(
        F.min("firstSeen").alias("firstVulnerabilitySeen"), F.max(F.when(known, F.col("last"))).alias("latestEvent"),
        F.sum(F.when(known, F.col("n"))).alias("totalEvents")).fillna(0, ["totalEvents"])


def finding_history(findings: DataFrame, assets: DataFrame) -> DataFrame:
    """Bounds, status, score, severity and state of every finding, with its host."""
    return findings.drop("riskDrivers").join(assets.select("assetId", "hostname"), "assetId").select(
        "hostname", "findingId", F.array_join("cves", ",").alias("cves"), "scanner", "firstSeen", "lastSeen", "status",
        "trs", "severity", F.col("historyState").alias("state"))


def sources(findings: DataFrame, assets: DataFrame, platform: str = "Platform") -> DataFrame:
    """The platform and each scanner per asset, with the newest observation (the asset's own if there is none)."""
    # Scanner names are a small vocabulary, so an asset's list of them stays short.
    named = F.struct(F.lit("SCANNER").alias("type"), F.col("scanner").alias("name"))
    seen = findings.groupBy("assetId").agg(F.max("lastSeen").alias("_last"), F.collect_set(named).alias("_scanners"))
    own = F.array(F.struct(F.lit("PLATFORM").alias("type"), F.lit(platform).alias("name")))
    return assets.select("assetId", "lastSeen").join(seen, "assetId").select(
        "assetId", F.inline(F.concat(own, "_scanners")), F.coalesce("_last", "lastSeen").alias("retrievedAt")).select(
        "assetId", "type", "name", "retrievedAt")


def asset_risk_history(assets: DataFrame, history: DataFrame) -> DataFrame:
    """Whether a rebuilt scan history exists for each asset."""
    known = history.select("assetId").distinct().withColumn("_has", F.lit(True))
    return assets.select("assetId", "hostname").join(known, "assetId", "left").select(
        "assetId", "hostname", F.coalesce("_has", F.lit(False)).alias("available"),
        F.lit("observation_bounds").alias("method"), F.lit(fixed.HISTORY_WARNING).alias("warning"))


def asset_facts(posture_: DataFrame, concentration_: DataFrame, actions_: DataFrame) -> DataFrame:
    """Condensed facts per asset: posture, top findings, signals and how many actions wait."""
    waiting = actions_.groupBy("assetId").agg(F.count(F.lit(1)).alias("actions"), F.max_by("id", "order").alias("lastAction"))
    return posture_.join(concentration_, "assetId").join(waiting, "assetId").select(
        "assetId", "totalFindings", "uniqueCves", "overallPriority", F.col("persistentFindings").alias("persistent"),
        F.col("reopenedFindings").alias("reopened"), "topFindingIds", "actions", "lastAction",
        F.lit(fixed.NO_INFERENCE).alias("constraint"))


def series_states(observations: DataFrame, strict: bool = False) -> DataFrame:
    """History state of each entity from its whole observation series.

    Counters and the newest row are enough, so a hot entity is reduced in the map tasks.
    """
    newest = F.struct("observedAt", "eventId")
    grouped = observations.groupBy("findingId").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("detected").alias("hits"),
        F.max_by("detected", newest).alias("last"),
        F.min(F.when(F.col("detected"), newest)).alias("_first_hit"),
        F.max(F.when(~F.col("detected"), newest)).alias("_last_miss"),
    )
    state = scoring.series_state(
        F.col("n"), F.col("hits"), F.col("last"), strict=strict,
        hit_before_miss=F.coalesce(F.col("_first_hit") < F.col("_last_miss"), F.lit(False)))
    return grouped.select("findingId", "n", "hits", "last", state.alias("state"))
