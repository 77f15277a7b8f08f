"""Presentation tables: enriched rows, scope filters, key figures, distributions and ranked lists."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade import fixed_values as fixed
from palisade.functions import scoring
from palisade.functions.dates import age_days, day_boundaries
from palisade.functions.json_text import names_of, part
from palisade.functions.nulls import blank_to_null, zero_if_null
from palisade.functions.text import internet_facing, split_cves
from palisade.operators.skew import hot_safe_join, top_per_key
from palisade.session import written


def _column(df: DataFrame, name: str, kind: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _with_action(df: DataFrame) -> DataFrame:
    """Keeps the source remediation or derives one, and says which."""
    given = blank_to_null(F.col("remediation"))
    cve = F.coalesce(blank_to_null(_column(df, "cve")), blank_to_null(_column(df, "cveId")))
    derived = scoring.derived_action(
        _column(df, "component"), _column(df, "expectedVersion"), cve, _column(df, "service"))
    return df.withColumns({
        "remediationSource": F.when(given.isNotNull(), "source").otherwise("derived"),
        "remediation": F.coalesce(given, derived),
    })


def enrich_findings(findings: DataFrame, as_of: str) -> DataFrame:
    """Severity, age, staleness, priority with its reason, and an action for every finding."""
    trs, cvss, kev = F.col("hyScoreV2"), F.col("cvssScore"), _column(findings, "cisaKev", "boolean")
    staged = findings.withColumns({
        "severity": scoring.severity_any_source(F.col("severity"), trs, cvss),
        "ageDays": age_days(F.col("firstSeen"), as_of), "staleDays": age_days(F.col("lastSeen"), as_of),
    }).withColumns({
        "priority": scoring.priority(trs, cvss, kev, F.col("ageDays")),
        "priorityScore": scoring.priority_score(trs, cvss, kev, F.col("ageDays")),
    })
    shown_age = F.coalesce(F.col("ageDays").cast("string"), F.lit("inconnue"))
    return _with_action(staged).withColumns({
        "dueInDays": scoring.due_days(F.col("priority")),
        "priorityReason": F.concat(
            F.lit("TRS "), scoring.whole(trs), F.lit(" · CVSS "), scoring.one_decimal(cvss), F.lit(" · exposition "),
            shown_age, F.lit(" j")),
    })


def enrich_cves(cves: DataFrame) -> DataFrame:
    trs, cvss = F.col("maxTrs"), F.col("maxCvss")
    no_kev, no_age = F.lit(False), F.lit(0)
    return _with_action(cves.withColumns({
        "severity": scoring.severity_any_source(F.col("severity"), trs, cvss),
        "priority": scoring.priority(trs, cvss),
        "priorityScore": scoring.priority_score(trs, cvss, no_kev, no_age),
    })).withColumn("dueInDays", scoring.due_days(F.col("priority")))


def enrich_remediations(plans: DataFrame) -> DataFrame:
    """Reads either summary schema: maxTrs or maxHyScore, findingCount or affectedFindings, cveCount or distinctCves."""
    kev_findings = F.coalesce(_column(plans, "cisaKevFindings", "bigint"), F.lit(0))
    age = F.coalesce(_column(plans, "oldestFindingDays", "bigint"), F.lit(0))
    staged = plans.withColumns({
        "maxTrs": F.coalesce(_column(plans, "maxTrs", "double"), _column(plans, "maxHyScore", "double")),
        "findingCount": F.coalesce(_column(plans, "findingCount", "bigint"), _column(plans, "affectedFindings", "bigint")),
        "cveCount": F.coalesce(_column(plans, "cveCount", "bigint"), _column(plans, "distinctCves", "bigint")),
    })
    trs, cvss = F.col("maxTrs"), F.col("maxCvss")
    scored = staged.withColumns({
        "priority": scoring.priority(trs, cvss, kev_findings > 0, age),
        "priorityScore": scoring.priority_score(trs, cvss, kev_findings > 0, age),
    })
    target = blank_to_null(_column(plans, "expectedVersion"))
    signals = F.concat_ws(
        " · ", F.concat(F.lit("TRS max "), scoring.whole(trs)), F.concat(F.lit("CVSS max "), scoring.one_decimal(cvss)),
        F.when(kev_findings > 0, F.concat(kev_findings.cast("string"), F.lit(" CISA KEV"))),
        F.concat(F.lit("cible "), target))
    return _with_action(scored).withColumns({
        "dueInDays": scoring.due_days(F.col("priority")), "priorityReason": signals})


def asset_dimensions(raw_findings: DataFrame) -> DataFrame:
    """Filter dimensions per asset from raw findings (assetId, VARIANT ``doc``).

    The sets hold perimeter, provider, state and type names; they are reduced to distinct names in the map tasks.
    """
    doc = F.col("doc")

    def names(*paths: str):
        lists = [F.coalesce(names_of(part(doc, p)), F.array().cast("array<string>")) for p in paths]
        return F.concat(*lists) if len(lists) > 1 else lists[0]

    kev = F.coalesce(F.try_variant_get(doc, "$.cisaKev", "boolean"), F.lit(False))
    tags = F.try_variant_get(doc, "$.tags", "map<string,variant>")
    fields = {
        "perimeterIds": names("perimeterIds"), "leafPerimeterIds": names("leafPerimeterIds"),
        "providerIds": names("providerIds", "assetProviderIds"),
        "assetStates": names("assetState"), "assetTypes": names("assetType"),
    }
    counts = raw_findings.groupBy("assetId").agg(
        F.count_if(kev).alias("cisaKevFindings"),
        F.count_if(internet_facing(tags)).alias("internetFacingSignals"),
        F.count(F.lit(1)).alias("findingCountObserved"))
    pairs = raw_findings.select(
        "assetId", F.explode(F.concat(*[_labelled(name, value) for name, value in fields.items()])).alias("p"))
    sets = pairs.select("assetId", "p.dimension", "p.name").distinct().groupBy("assetId").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("dimension") == name, F.col("name")))).alias(name) for name in fields])
    return counts.join(sets, "assetId", "left").select(
        "assetId",
        *[F.coalesce(name, F.array().cast("array<string>")).alias(name) for name in fields],
        "cisaKevFindings", "internetFacingSignals", "findingCountObserved")


def _labelled(name: str, values):
    return F.transform(values, lambda v: F.struct(F.lit(name).alias("dimension"), v.alias("name")))


def with_dimensions(assets: DataFrame, dimensions: DataFrame) -> DataFrame:
    return assets.join(dimensions, "assetId", "left")


def only_summarised(raw_findings: DataFrame, assets: DataFrame) -> DataFrame:
    """Raw findings of assets that are in the summary."""
    return raw_findings.join(assets.select("assetId").distinct(), "assetId", "left_semi")


def findings_in_scope(findings: DataFrame, scoped_assets: DataFrame) -> DataFrame:
    return findings.join(scoped_assets.select("assetId").distinct(), "assetId", "left_semi")


def cves_in_scope(cves: DataFrame, scoped_findings: DataFrame) -> DataFrame:
    ids = scoped_findings.select(F.explode(split_cves(F.col("cve"))).alias("cveId")).distinct()
    return cves.join(ids, "cveId", "left_semi")


def server_findings(findings: DataFrame, assets: DataFrame) -> DataFrame:
    """Findings of each asset by asset id or by equal host name, without repetition: two equi joins, not one with OR."""
    by_id = hot_safe_join(findings.drop("hostname"), assets.select("assetId"), ["assetId"]).select(
        F.col("assetId").alias("serverId"), "findingId")
    named = assets.where("hostname <> ''").select("hostname", F.col("assetId").alias("serverId")).distinct()
    by_name = hot_safe_join(
        findings.where("hostname <> ''").select("hostname", "findingId"), named, ["hostname"]
    ).select("serverId", "findingId")
    return by_id.unionByName(by_name).distinct()


OPENING = 45
# Bytes of the patterns of one automaton, and texts that one task looks through with it.
SHARD_BYTES, TEXTS_A_TASK = 32 << 20, 50_000


def contained(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(text, pattern): every pattern that occurs in a text; both sides have distinct rows that are not empty.

    An Aho-Corasick automaton finds all patterns of a shard in one pass over a text, however many there are. Shards are sized by
    the patterns' bytes and texts are dealt over tasks, so that a task holds one automaton and its own texts. ``texts`` is read
    twice: give a written table.
    """
    def found(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        import ahocorasick

        if not len(left) or not len(right):
            return pd.DataFrame({"text": [], "pattern": []}, dtype=object)
        automaton = ahocorasick.Automaton()
        for pattern in right["pattern"]:
            automaton.add_word(pattern, pattern)
        automaton.make_automaton()
        pairs = [(text, pattern) for text in left["text"] for pattern in {p for _, p in automaton.iter(text)}]
        return pd.DataFrame(pairs, columns=["text", "pattern"])

    size = patterns.agg(F.sum(F.octet_length("pattern"))).first()[0] or 0
    shards, deals = 1 + size // SHARD_BYTES, 1 + texts.count() // TEXTS_A_TASK
    left = texts.select("text", F.pmod(F.xxhash64("text"), F.lit(deals)).alias("deal"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    right = patterns.select("pattern", F.pmod(F.xxhash64("pattern"), F.lit(shards)).alias("shard"),
                            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(deals - 1).cast("long"))).alias("deal"))
    return left.groupBy("shard", "deal").cogroup(right.groupBy("shard", "deal")).applyInPandas(found, "text string, pattern string")


def joined_pieces(findings: DataFrame) -> DataFrame:
    """(assetId, text): the text of each finding and as much of what follows in its asset's joined text as an opening can reach into.

    The findings of an asset are joined by spaces in the order of their ids, remediation before CVE id. A match that starts in
    one finding lies inside its piece, wherever it ends.
    """
    text = F.lower(F.concat_ws(" ", F.coalesce("remediation", F.lit("")), F.coalesce("cve", F.lit(""))))
    rows = findings.select("assetId", "findingId", text.alias("own"))
    # Every finding brings at least a space of its own and one in front of it.
    after = Window.partitionBy("assetId").orderBy("findingId").rowsBetween(1, OPENING // 2 + 1)
    tail = F.left(F.array_join(F.collect_list(F.left("own", F.lit(OPENING))).over(after), " "), F.lit(OPENING - 1))
    return rows.select("assetId", F.concat("own", F.lit(" "), tail).alias("text")).distinct()


def related_remediations(findings: DataFrame, remediations: DataFrame, assets: DataFrame, top: int = 5) -> DataFrame:
    """Up to ``top`` remediations per asset whose opening occurs in the joined text of its findings, else the global top.

    The opening is the first 45 characters of texts longer than 20. At most ``top`` remediations per opening, and per piece of
    text, can reach a result, which bounds the matches of a common opening.
    """
    text = F.lower("remediation")
    order = [zero_if_null(F.col("maxTrs")).desc(), F.col("remediationKey").asc()]
    openings = remediations.where(F.length("remediation") > 20).select(
        F.left(text, F.lit(OPENING)).alias("pattern"), "remediationKey", "maxTrs")
    best = written(top_per_key(openings, ["pattern"], order, top, "_place").drop("_place"), "openings")
    own = written(joined_pieces(findings), "pieces")
    pairs = contained(own.select("text").distinct(), best.select("pattern").distinct())
    matched_text = top_per_key(
        hot_safe_join(pairs, best, ["pattern"]).select("text", "remediationKey", "maxTrs").distinct(), ["text"], order, top, "_place").drop("_place")
    direct = own.join(matched_text, "text").select("assetId", "remediationKey", "maxTrs").distinct()
    chosen = top_per_key(direct, ["assetId"], order, top, "place")
    fallback = remediations.orderBy(*order).limit(top).agg(F.array_sort(F.collect_list(F.struct(
        (-zero_if_null(F.col("maxTrs"))).alias("rank"), "remediationKey", "maxTrs")))).scalar()
    rest = assets.select("assetId").join(direct.select("assetId").distinct(), "assetId", "left_anti").select(
        "assetId", F.posexplode(fallback).alias("p", "r")).select(
        "assetId", "r.remediationKey", "r.maxTrs", (F.col("p") + 1).alias("place"))
    return chosen.withColumn("direct", F.lit(True)).unionByName(rest.withColumn("direct", F.lit(False)))


def kev_signals(raw_findings: DataFrame) -> DataFrame:
    """One row per raw finding that is known to be exploited, as ``cisaKevFindings`` of its asset."""
    return raw_findings.where(F.try_variant_get("doc", F.lit("$.cisaKev"), "boolean")).select(
        "assetId", F.lit(1).cast("bigint").alias("cisaKevFindings"))


def key_figures(assets: DataFrame, facts: DataFrame, signals: DataFrame, as_of: str, threshold: float = fixed.CRITICAL_TRS) -> DataFrame:
    """The one-row overview, from one pass over the facts.

    Facts, assets and signals are one stream, grouped by asset, by CVE and by remediation text at once; every figure is then a count,
    sum or maximum over the groups. Rows that have no CVE or no text fall into one empty group each, which the map tasks reduce to a
    row of their own, so it never grows into a hot key.
    """
    text = F.lower(F.trim("remediation"))
    stream = facts.select(
        "assetId", "cve", F.when(text != "", text).alias("text"), "hyScoreV2", "cvssScore", "firstSeen", F.lit(1).cast("bigint").alias("facts"),
        F.coalesce((F.col("hyScoreV2") >= threshold) | (F.upper("severity") == "CRITICAL"), F.lit(False)).alias("critical"),
    ).unionByName(
        assets.select("assetId", F.lit(True).alias("known"), blank_to_null(F.col("ipAddress")).alias("ip")), allowMissingColumns=True
    ).unionByName(signals.select("assetId", "cisaKevFindings"), allowMissingColumns=True)
    groups = stream.groupingSets([["assetId"], ["cve"], ["text"]], "assetId", "cve", "text").agg(
        F.grouping("assetId").alias("_a"), F.sum("facts").alias("n"), F.count_if("critical").alias("critical"), F.max("hyScoreV2").alias("trs"),
        F.max("cvssScore").alias("cvss"), F.min("firstSeen").alias("first"), F.bool_or("known").alias("known"), F.max("ip").alias("ip"),
        F.sum("cisaKevFindings").alias("kev"))
    asset = (F.col("_a") == 0) & F.col("known") & (F.col("n") > 0)
    cve, action = F.col("cve").isNotNull(), F.col("text").isNotNull()
    return groups.agg(
        F.count_if(asset).alias("assets"), F.count_if(asset & (F.col("trs") >= 900)).alias("criticalAssets"),
        F.max(F.when(asset, F.col("trs"))).alias("maxTrs"), F.sum(F.when(asset, F.coalesce("kev", F.lit(0)))).alias("kevFindings"),
        F.count_if(asset & F.col("ip").isNull()).alias("assetsWithoutIp"),
        F.greatest(F.lit(0), F.max(F.when(asset, day_boundaries(F.col("first"), as_of)))).alias("oldestFindingDays"),
        F.coalesce(F.sum(F.when(asset, F.col("critical"))), F.lit(0)).alias("findings"), F.count_if(cve).alias("cves"),
        F.count_if(cve & (zero_if_null(F.col("cvss")) >= 9)).alias("cvesCvss9"), F.count_if(action).alias("actions"),
        F.count_if(action & (scoring.priority(F.col("trs"), F.col("cvss")) == "P1")).alias("p1Actions"))


def risk_histogram(assets: DataFrame) -> DataFrame:
    """Assets per risk band; an empty band shows zero."""
    counts = assets.agg(*[
        F.count_if(scoring.risk_band(F.col("maxFindingTrs")) == band).alias(band) for band in fixed.RISK_LABELS])
    return counts.unpivot([], list(fixed.RISK_LABELS), "band", "assets")


def severity_distribution(findings: DataFrame, top: int = 5) -> DataFrame:
    """The most frequent severities; a finding without one is shown as unclassified."""
    label = F.coalesce(blank_to_null(F.col("severity")), F.lit(fixed.UNCLASSIFIED)).alias("severity")
    return findings.groupBy(label).agg(F.count(F.lit(1)).alias("findings")).orderBy(
        F.col("findings").desc(), "severity").limit(top)


ASSET_SORTS = {"findings": "openFindings", "critical": "criticalFindings", "trs": "maxFindingTrs"}
CVE_SORTS = {"assets": "affectedAssets", "cvss": "maxCvss", "trs": "maxTrs"}


def ranked(df: DataFrame, sort: str, sorts: dict[str, str], key: str, limit: int) -> DataFrame:
    """The first rows under a switchable sort key, ``hostname`` ascending, figures descending with null as zero."""
    order = F.lower("hostname") if sort == "hostname" else F.coalesce(F.col(sorts[sort]), F.lit(0)).desc()
    return df.orderBy(order, key).limit(limit)


def ranked_server_findings(findings: DataFrame, top: int, severity: str = "", needle: str = "") -> DataFrame:
    """The highest scored findings of every asset, optionally of one severity or containing a text."""
    from palisade.operators.search import text_matches

    rows = text_matches(findings, needle) if needle else findings
    rows = rows.where(F.col("severity") == severity) if severity else rows
    return top_per_key(rows, ["assetId"], [zero_if_null(F.col("hyScoreV2")).desc(), F.col("findingId")], top, "place")
