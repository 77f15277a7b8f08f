"""Data-quality rules, profiles and raw-to-structured comparisons, each as rows of a report table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade import fixed_values as fixed
from palisade.functions.evidence_text import has_secret
from palisade.functions.json_text import is_json
from palisade.functions.nulls import is_filled
from palisade.operators.skew import top_per_key
from palisade.session import written


def _rule(rows: DataFrame, rule: str, entity: Column, detail: Column | None = None) -> DataFrame:
    detail = F.lit(None).cast("string") if detail is None else detail
    return rows.select(
        F.lit(rule).alias("rule"), entity.cast("string").alias("entity"), detail.cast("string").alias("detail"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def context_violations(assets: DataFrame, findings: DataFrame, vulnerabilities: DataFrame, action_findings: DataFrame,
                       components: DataFrame, sources: DataFrame, missing: DataFrame | None = None,
                       versions: DataFrame | None = None, blocks: DataFrame | None = None) -> DataFrame:
    """Every broken rule of the report tables as (rule, entity, detail), without repetition.

    ``missing`` turns on the strict mode: any missing field is then a violation of its asset. ``versions`` holds (assetId,
    schemaVersion), one row per report. ``blocks`` holds (assetId, section), one row per block that a report has; an asset that lacks a
    required block is reported for its missing blocks and for nothing else.
    """
    if blocks is not None:
        lacking = _missing_blocks(assets, blocks)
        broken = lacking.select("assetId").distinct()
        tables = [None if t is None else t.join(broken, "assetId", "left_anti")
                  for t in (assets, findings, vulnerabilities, action_findings, components, sources, missing, versions)]
        return _rule(lacking, "missing_block", F.col("assetId"), F.col("section")).unionByName(context_violations(*tables)).distinct()
    own_cves = findings.select("assetId", F.explode("cves").alias("cve")).distinct()
    scanners = findings.select("assetId", F.col("scanner").alias("name")).distinct()
    parts = [
        _rule(assets.where(F.coalesce("hostname", F.lit("")) == ""), "asset_without_hostname", F.col("assetId")),
        _rule(findings.groupBy("assetId", "findingId").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
              "duplicate_finding", F.col("findingId"), F.col("assetId")),
        _rule(findings.where(~F.coalesce(F.col("priority").isin(*fixed.PRIORITIES), F.lit(False))),
              "invalid_priority", F.col("findingId"), F.col("priority")),
        _rule(findings.where(~F.coalesce(F.col("historyState").isin(*fixed.HISTORY_STATES), F.lit(False))),
              "invalid_history_state", F.col("findingId"), F.col("historyState")),
        _rule(findings.where(F.col("firstSeen") > F.col("lastSeen")), "first_after_last", F.col("findingId")),
        _rule(own_cves.join(vulnerabilities.select("assetId", "cve").distinct(), ["assetId", "cve"], "left_anti"),
              "cve_not_consolidated", F.col("cve"), F.col("assetId")),
        _rule(action_findings.join(findings.select("assetId", "findingId"), ["assetId", "findingId"], "left_anti"),
              "unknown_action_finding", F.col("findingId"), F.col("assetId")),
        _rule(components.groupBy("assetId", "componentId").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
              "duplicate_component", F.col("componentId"), F.col("assetId")),
        _rule(scanners.join(sources.select("assetId", "name").distinct(), ["assetId", "name"], "left_anti"),
              "scanner_not_in_sources", F.col("name"), F.col("assetId")),
    ]
    if versions is not None:
        named = versions.where(F.coalesce("schemaVersion", F.lit("")) != "").select("assetId")
        parts.append(_rule(assets.join(named, "assetId", "left_anti"), "missing_schema_version", F.col("assetId")))
    if missing is not None:
        parts.append(_rule(missing, "strict_missing_field", F.col("assetId"), F.col("missing")))
    return _all(parts).distinct()


def _missing_blocks(assets: DataFrame, blocks: DataFrame) -> DataFrame:
    """(assetId, section) of every required block that an asset's report lacks."""
    wanted = assets.select("assetId").distinct().withColumn("section", F.explode(F.array(*map(F.lit, fixed.REQUIRED_BLOCKS))))
    return wanted.join(blocks.select("assetId", "section").distinct(), ["assetId", "section"], "left_anti")


def missing_blocks(columns: list[str]) -> list[str]:
    """Required blocks that a document schema lacks."""
    return sorted(set(fixed.REQUIRED_BLOCKS) - set(columns))


def component_warnings(components: DataFrame, occurrences: DataFrame) -> DataFrame:
    """The four component warnings, distinct."""
    installed = F.coalesce("installedVersion", F.lit("")) != ""
    required = F.coalesce("requiredVersion", F.lit("")) != ""
    label = F.coalesce(F.nullif("package", F.lit("")), F.nullif("component", F.lit("")), F.nullif("product", F.lit("")))
    known = components.select("componentId").distinct()
    orphans = occurrences.where("installPath <> ''").join(known, "componentId", "left_anti")
    return _all([
        _rule(components.where(~installed), "component_without_version", F.col("componentId")),
        _rule(components.where(required & ~installed), "required_version_without_installed_version", F.col("componentId")),
        _rule(components.where(label.isNull()), "installed_version_without_product", F.col("componentId")),
        _rule(orphans, "path_without_component", F.col("occurrenceId")),
    ]).drop("detail").distinct()


def fail_on(violations: DataFrame, limit: int = 20) -> None:
    """Fatal gate: raise with the first violations when there are any."""
    found = violations.limit(limit).collect()
    if found:
        raise ValueError("; ".join(f"{row['rule']}: {row['entity']}" for row in found))


def null_profile(df: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Null count and percentage of every column in one pass, columns at or above the threshold only."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot(["_rows"], df.columns, "column", "nullCount")
    share = F.col("nullCount") / F.col("_rows")
    return long.where((F.col("_rows") > 0) & (share >= threshold)).select(
        "column", "nullCount", F.col("_rows").alias("rows"), F.round(100 * share, 2).alias("nullPct"))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of rows where a column is filled, in one pass."""
    total = F.count(F.lit(1))
    measured = df.agg(*[
        F.coalesce(F.round(100.0 * F.count_if(is_filled(F.col(c))) / total, 2), F.lit(0.0)).alias(c) for c in columns])
    return measured.unpivot([], columns, "column", "coveragePct")


def uniqueness(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Whether the key is unique; a null key counts as a value for pairs, as in a tuple."""
    whole = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    counted = df.groupBy(whole.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    known = F.lit(True) if len(keys) > 1 else F.col("_k").isNotNull()
    return counted.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count_if(known).alias("distinctKeys")
    ).select(F.lit(name).alias("name"), "rows", "distinctKeys", (F.col("rows") == F.col("distinctKeys")).alias("passed"))


def content_checks(df: DataFrame, json_columns: list[str], url_column: str, text_column: str) -> DataFrame:
    """Rows with invalid JSON per column, badly shaped history links, and text that may hold secrets."""
    url, measures = F.col(url_column), {}
    for name in json_columns:
        measures[f"{name} invalid JSON"] = F.count_if(F.col(name).isNotNull() & ~is_json(F.col(name)))
    measures["bad history link"] = F.count_if(url.isNotNull() & ~url.like(fixed.HISTORY_URL_LIKE))
    measures["possible secret"] = F.count_if(has_secret(F.col(text_column)))
    found = df.agg(*[value.alias(name) for name, value in measures.items()])
    return found.unpivot([], list(measures), "check", "badRows")


def _canonical(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def key_comparison(expected: DataFrame, actual: DataFrame, keys: list[str], domain: str) -> DataFrame:
    """Matched, missing and unexpected keys; coverage is 100 when nothing is expected. One exchange for both sides."""
    both = compared_keys(expected, actual, keys)
    total = both.agg(
        F.count_if("inExpected").alias("availableRaw"), F.count_if("inActual").alias("structured"),
        F.count_if(F.col("inExpected") & F.col("inActual")).alias("matched"))
    return total.select(
        F.lit(domain).alias("domain"), "availableRaw", "structured", "matched",
        (F.col("availableRaw") - F.col("matched")).alias("missing"),
        (F.col("structured") - F.col("matched")).alias("unexpected"),
        F.when(F.col("availableRaw") > 0, F.round(100.0 * F.col("matched") / F.col("availableRaw"), 2)).otherwise(100.0)
        .alias("coveragePct"))


def compared_keys(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    def side(df: DataFrame, in_expected: bool) -> DataFrame:
        return df.select(*[_canonical(k) for k in keys], F.lit(in_expected).alias("e"), F.lit(not in_expected).alias("a"))

    return side(expected, True).unionByName(side(actual, False)).groupBy(*keys).agg(
        F.bool_or("e").alias("inExpected"), F.bool_or("a").alias("inActual"))


def key_examples(expected: DataFrame, actual: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` missing and the first ``n`` unexpected keys; the cap is the feature."""
    both = compared_keys(expected, actual, keys)

    def first(rows: DataFrame, kind: str) -> DataFrame:
        return rows.orderBy(*keys).limit(n).select(F.lit(kind).alias("kind"), *keys)

    return first(both.where("inExpected AND NOT inActual"), "missing").unionByName(
        first(both.where("inActual AND NOT inExpected"), "unexpected"))


def completeness_report(comparisons: list[DataFrame]) -> DataFrame:
    """All domains with the overall status, COMPLETE when none has missing keys."""
    rows = _all(comparisons)
    whole = rows.agg(F.bool_and(F.col("missing") == 0).alias("ok"))
    return rows.withColumn("status", F.when(whole.scalar(), "COMPLETE").otherwise("INCOMPLETE"))


AUDIT_BUCKETS = 4096


def _audit_key(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        moment = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.coalesce(F.concat(F.regexp_replace(moment, "[.]000000$", ""), F.lit("Z")), F.lit(""))
    return F.coalesce(column.cast("string"), F.lit(""))


def tagged_keys(tables: dict[str, DataFrame], domains: dict[str, tuple[str, tuple[str, ...]]], buckets: int) -> DataFrame:
    """(domain, key, bucket) of every row of every domain; a key is the JSON list of its fields, null as empty text."""
    out = None
    for domain, (table, names) in domains.items():
        df = tables[table]
        key = F.to_json(F.array(*[_audit_key(F.col(n), df.schema[n].dataType) for n in names]))
        rows = df.select(F.lit(domain).alias("domain"), key.alias("key"))
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("bucket", F.pmod(F.xxhash64("domain", "key"), F.lit(buckets)))


def differing_buckets(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Buckets whose keys are not the same on both sides, by a count and two sums of hashes that no order of rows changes.

    Only sums leave the tasks: as many rows as there are domains times buckets, however large the tables are. A bucket with equal keys
    but other repetitions differs too; it is opened in vain, which costs time and changes nothing.
    """
    def sums(rows: DataFrame, sign: int) -> DataFrame:
        one, two = F.xxhash64("key", "domain"), F.xxhash64(F.md5("key"))
        return rows.select("domain", "bucket", *[
            (F.lit(sign) * value.cast("decimal(20,0)")).alias(name) for name, value in (("n", F.lit(1)), ("one", one), ("two", two))])

    both = sums(expected, 1).unionByName(sums(actual, -1)).groupBy("domain", "bucket").agg(*[F.sum(n).alias(n) for n in ("n", "one", "two")])
    return both.where("n <> 0 OR one <> 0 OR two <> 0").select("domain", "bucket")


def audited_keys(raw: dict[str, DataFrame], structured: dict[str, DataFrame], domains: dict[str, tuple[str, tuple[str, ...]]],
                 buckets: int = AUDIT_BUCKETS) -> DataFrame:
    """(domain, key, inRaw, inStructured): the distinct keys of all domains, with one exchange of keys for all of them.

    Fingerprints tell which buckets agree. Of those only the raw side's keys are moved; buckets that differ are opened on both sides.
    """
    expected, actual = tagged_keys(raw, domains, buckets), tagged_keys(structured, domains, buckets)
    # At most domains times buckets rows: the bound of the broadcast.
    opened = F.broadcast(written(differing_buckets(expected, actual).withColumn("_opened", F.lit(True)), "opened-buckets"))
    left = expected.join(opened, ["domain", "bucket"], "left").select(
        "domain", "key", F.lit(True).alias("inRaw"), F.col("_opened").isNull().alias("inStructured"))
    right = actual.join(opened.drop("_opened"), ["domain", "bucket"], "left_semi").select(
        "domain", "key", F.lit(False).alias("inRaw"), F.lit(True).alias("inStructured"))
    return left.unionByName(right).groupBy("domain", "key").agg(
        F.bool_or("inRaw").alias("inRaw"), F.bool_or("inStructured").alias("inStructured"))


def mapping_report(keys: DataFrame, domains: dict[str, tuple[str, tuple[str, ...]]], invalid: DataFrame | None = None) -> DataFrame:
    """One row per domain, also where it has no key: keys on either side, coverage (100 when nothing is expected), overall status.

    COMPLETE when no domain misses a key and, if ``invalid`` is given, no document was invalid. ``keys`` is read twice: give a written table.
    """
    both = F.col("inRaw") & F.col("inStructured")
    counted = keys.groupBy("domain").agg(
        F.count_if("inRaw").alias("availableRaw"), F.count_if("inStructured").alias("structured"), F.count_if(both).alias("matched"))
    names = keys.sparkSession.createDataFrame([(name,) for name in domains], "domain string")
    rows = names.join(F.broadcast(counted), "domain", "left").fillna(0)
    whole = keys.agg(F.count_if(F.col("inRaw") & ~F.col("inStructured")).alias("n")).scalar() == 0
    if invalid is not None:
        whole = whole & (invalid.agg(F.count(F.lit(1))).scalar() == 0)
    return rows.select(
        "domain", "availableRaw", "structured", "matched", (F.col("availableRaw") - F.col("matched")).alias("missing"),
        (F.col("structured") - F.col("matched")).alias("unexpected"),
        F.when(F.col("availableRaw") > 0, F.round(100.0 * F.col("matched") / F.col("availableRaw"), 2)).otherwise(100.0).alias("coveragePct"),
        F.when(whole, "COMPLETE").otherwise("INCOMPLETE").alias("status"))


def mapping_examples(keys: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` missing and the first ``n`` unexpected keys of every domain, as rows; the cap is the feature."""
    odd = keys.where("inRaw <> inStructured").select("domain", F.when(F.col("inRaw"), "missing").otherwise("unexpected").alias("kind"), "key")
    return top_per_key(odd, ["domain", "kind"], [F.col("key")], n, "place")


def nested_columns(schema: T.StructType) -> list[str]:
    """Columns a flat sink must not have."""
    return [f.name for f in schema.fields if isinstance(
        f.dataType, (T.ArrayType, T.StructType, T.MapType, T.NullType, T.VariantType))]


def output_report(datasets: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and nested columns of each dataset."""
    return _all([
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"),
            F.lit("|".join(nested_columns(df.schema))).alias("complexColumns"))
        for name, df in datasets.items()])


def file_errors(report: DataFrame, expected: list[str], allow_missing: bool = False) -> DataFrame:
    """What must stop a publication of files, from their footers: missing datasets, unless allowed, and nested columns."""
    wanted = report.sparkSession.createDataFrame([(name,) for name in expected], "dataset string")
    missing = wanted.join(report, "dataset", "left_anti").select(F.concat(F.lit("missing: "), "dataset").alias("error"))
    nested = report.where("nested").groupBy("dataset").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "field"))), lambda x: x["field"]), "|").alias("fields"))
    found = nested.select(F.concat(F.lit("nested columns in "), "dataset", F.lit(": "), "fields").alias("error"))
    return found if allow_missing else missing.unionByName(found)


def blocking_errors(report: DataFrame, checks: DataFrame) -> DataFrame:
    """What must stop a publication: nested columns and failed uniqueness checks."""
    nested = report.where("complexColumns <> ''").select(
        F.concat(F.lit("nested columns in "), "dataset", F.lit(": "), "complexColumns").alias("error"))
    failed = checks.where(~F.col("passed")).select(F.col("name").alias("error"))
    return nested.unionByName(failed)
