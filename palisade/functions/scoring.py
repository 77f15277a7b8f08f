"""Severity, priority, risk bands and derived remediation texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade import fixed_values as fixed
from palisade.functions.nulls import blank_to_null, zero_if_null


def _by_score(trs: Column, cvss: Column) -> Column:
    trs, cvss = zero_if_null(trs), zero_if_null(cvss)
    level = None
    for name, trs_floor, cvss_floor in fixed.BANDS:
        hit = (trs >= trs_floor) | (cvss >= cvss_floor)
        level = F.when(hit, name) if level is None else level.when(hit, name)
    return level.otherwise("LOW")


def severity(source: Column, trs: Column, cvss: Column) -> Column:
    """Trust one of the five known words, else derive from the scores."""
    word = F.upper(F.trim(source))
    return F.when(word.isin(*fixed.SEVERITIES), word).otherwise(_by_score(trs, cvss))


def severity_any_source(source: Column, trs: Column, cvss: Column) -> Column:
    """Presentation variant: any non-empty source word wins."""
    return F.coalesce(F.upper(blank_to_null(source)), _by_score(trs, cvss))


def priority(trs: Column, cvss: Column, kev: Column | None = None, age: Column | None = None) -> Column:
    """P1/P2/P3; known exploitation lifts to P1 and an old finding to P2 when those are given."""
    trs, cvss = zero_if_null(trs), zero_if_null(cvss)
    first = (trs >= 900) | (cvss >= 9)
    if kev is not None:
        first = F.coalesce(kev, F.lit(False)) | first
    second = (trs >= 700) | (cvss >= 7)
    if age is not None:
        second = second | (F.coalesce(age, F.lit(0)) >= fixed.STALE_AGE_DAYS)
    return F.when(first, "P1").when(second, "P2").otherwise("P3")


def declared_priority(source: Column, trs: Column, cvss: Column, kev: Column) -> Column:
    word = F.upper(F.trim(source))
    return F.when(word.isin(*fixed.PRIORITIES), word).otherwise(priority(trs, cvss, kev))


def priority_score(trs: Column, cvss: Column, kev: Column, age: Column) -> Column:
    """0-100 from score, CVSS, age and known exploitation, rounded half to even."""
    capped_age = F.least(F.coalesce(age, F.lit(0)), F.lit(365))
    raw = (
        zero_if_null(trs) / 10 * 0.5
        + zero_if_null(cvss) * 10 * 0.3
        + capped_age / 365 * 10
        + F.when(F.coalesce(kev, F.lit(False)), 10).otherwise(0)
    )
    return F.least(F.lit(100), F.bround(raw).cast("int"))


def due_days(level: Column) -> Column:
    return (
        F.when(level == "P1", fixed.DUE_DAYS["P1"])
        .when(level == "P2", fixed.DUE_DAYS["P2"])
        .otherwise(fixed.DUE_DAYS["P3"])
    )


def risk_band(trs: Column) -> Column:
    trs = zero_if_null(trs)
    return F.when(trs >= 900, "critical").when(trs >= 700, "high").when(trs >= 400, "medium").otherwise("low")


def risk_label(trs: Column) -> Column:
    pairs = [F.lit(part) for pair in fixed.RISK_LABELS.items() for part in pair]
    return F.create_map(*pairs)[risk_band(trs)]


def _fill(template: str, *values: Column) -> Column:
    pieces = template.split("{}")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        parts += [value, F.lit(piece)]
    return F.concat(*parts)


def derived_action(component: Column, expected: Column, cve: Column, service: Column) -> Column:
    """Upgrade, else vendor fix for the CVE, else the service, else the generic action."""
    component, expected = blank_to_null(component), blank_to_null(expected)
    return F.coalesce(
        _fill(fixed.ACTION_UPGRADE, component, expected),
        _fill(fixed.ACTION_CVE, blank_to_null(cve)),
        _fill(fixed.ACTION_SERVICE, blank_to_null(service)),
        F.lit(fixed.ACTION_GENERIC),
    )


def whole(number: Column) -> Column:
    return F.bround(zero_if_null(number)).cast("bigint").cast("string")


def one_decimal(number: Column) -> Column:
    return F.format_string("%.1f", F.bround(zero_if_null(number), 1))


def action_type(recommendation: Column, target: Column) -> Column:
    text = F.lower(F.coalesce(recommendation, F.lit("")))
    return (
        F.when(F.coalesce(target, F.lit("")) != "", "UPGRADE")
        .when(text.rlike("|".join(fixed.PATCH_WORDS)), "PATCH")
        .when(text.rlike("|".join(fixed.CONFIG_WORDS)), "CONFIG_CHANGE")
        .otherwise("INVESTIGATE")
    )


def risk_drivers(trs: Column, severity_: Column, state: Column, kev: Column, first_seen: Column,
                 last_seen: Column, observations: Column) -> Column:
    """Array of (type, evidence) for each signal that holds."""
    def driver(name: str, **evidence: Column) -> Column:
        fields = {
            "trs": F.lit(None).cast("double"), "severity": F.lit(None).cast("string"),
            "first_seen": F.lit(None).cast("timestamp_ntz"), "last_seen": F.lit(None).cast("timestamp_ntz"),
            "observation_count": F.lit(None).cast("int"), "cisa_kev": F.lit(None).cast("boolean"),
        }
        fields.update(evidence)
        return F.struct(
            F.lit(name).alias("type"),
            F.struct(*[fields[key].alias(key) for key in sorted(fields)]).alias("evidence"),
        )

    return F.array_compact(
        F.array(
            F.when(zero_if_null(trs) >= 700, driver("HIGH_TRS", trs=trs)),
            F.when(severity_ == "CRITICAL", driver("CRITICAL_SEVERITY", severity=severity_)),
            F.when(
                state == "PERSISTENT",
                driver("PERSISTENT", first_seen=first_seen, last_seen=last_seen, observation_count=observations),
            ),
            F.when(F.coalesce(kev, F.lit(False)), driver("CISA_KEV", cisa_kev=kev)),
        )
    )


def observation_count(first_seen: Column, last_seen: Column) -> Column:
    """Bounds are not scans: no bound 0, two different bounds 2, otherwise 1."""
    return (
        F.when(first_seen.isNull() & last_seen.isNull(), 0)
        .when(first_seen.isNotNull() & last_seen.isNotNull() & (first_seen != last_seen), 2)
        .otherwise(1)
    )


def bounds_state(first_seen: Column, last_seen: Column) -> Column:
    """History state when only the two bounds are known, both of them detections.

    One observation is NEW only if it is the first bound; two are PERSISTENT.
    """
    return (
        F.when(first_seen.isNotNull() & last_seen.isNotNull() & (first_seen != last_seen), "PERSISTENT")
        .when(first_seen.isNotNull(), "NEW")
        .otherwise("UNKNOWN")
    )


def series_state(n: Column, hits: Column, last_hit: Column, first_flag: Column | None = None,
                 strict: bool = False, hit_before_miss: Column | None = None) -> Column:
    """History state from counters of an ordered detection series.

    ``n`` observations, ``hits`` of them detections, ``last_hit`` the newest one. ``first_flag`` says whether
    the only observation is a first one. The strict rule for REOPENED also asks for a detection before the miss.
    """
    misses_before = (n - hits) - F.when(last_hit, 0).otherwise(1)
    hits_before = hits - F.when(last_hit, 1).otherwise(0)
    single_first = F.lit(True) if first_flag is None else first_flag
    reopened = last_hit & (misses_before > 0)
    if strict:
        reopened = reopened & hit_before_miss
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, "UNKNOWN")
        .when((n == 1) & last_hit & single_first, "NEW")
        .when(n == 1, "UNKNOWN")
        .when(reopened, "REOPENED")
        .when(~last_hit & (hits_before > 0), "RESOLVED")
        .when(last_hit & (hits == n), "PERSISTENT")
        .otherwise("UNKNOWN")
    )
