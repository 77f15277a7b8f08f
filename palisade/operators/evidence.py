"""Technical evidence of a detail document: components, occurrences, native scanner ids and audit events.

Rows of one document are brought together once, by document, and everything that depends on the whole document
(how many candidates an entry has, which duplicate is last) is a window on that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade import fixed_values as fixed
from palisade.functions import evidence_text
from palisade.functions.dates import iso_utc, parse_timestamp
from palisade.functions.json_text import at, first_at, is_object
from palisade.functions.nulls import blank_to_null
from palisade.functions.text import event_type, normalize_scanner, short_digest
from palisade.operators.details import INFOS
from palisade.operators.skew import first_per_key
from palisade.session import written

FIELDS = list(fixed.FIELD_SPELLINGS)


def component_id(asset_id: Column, identity: Column, installed: Column) -> Column:
    parts = (F.coalesce(asset_id, F.lit("")), F.lower(F.coalesce(identity, F.lit("none"))),
             F.coalesce(installed, F.lit("")))
    return F.concat(F.lit("cmp-"), short_digest(*parts))


def occurrence_id(component: Column, path: Column) -> Column:
    return F.concat(F.lit("occ-"), short_digest(component, path))


def unassigned_occurrence_id(asset_id: Column, finding_id: Column, path: Column) -> Column:
    return F.concat(F.lit("occ-"), short_digest(
        F.coalesce(asset_id, F.lit("")), F.coalesce(finding_id, F.lit("")), F.lit("unassigned"), path))


def event_id(audit_id: Column, finding_id: Column, moment: Column, trigger: Column) -> Column:
    """The given id, else a digest; a missing time or trigger is spelled ``None`` in it."""
    digest = short_digest(F.coalesce(finding_id, F.lit("")), F.coalesce(iso_utc(moment), F.lit("None")),
                          F.coalesce(trigger, F.lit("None")))
    return F.coalesce(blank_to_null(audit_id), digest)


def reference_kind(key: Column) -> Column:
    """Kind of a native scanner id by its key, ignoring case, ``-`` and ``_``."""
    pairs = [F.lit(part) for pair in fixed.REFERENCE_KINDS.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.regexp_replace(F.lower(key), "[-_]", ""))


def _spelled(fields: Column, spellings: tuple[str, ...]) -> Column:
    """The first spelling that the object has; the walk leaves out empty values."""
    if len(spellings) == 1:
        return F.try_element_at(fields, F.lit(spellings[0]))
    values = F.transform(F.array(*[F.lit(s) for s in spellings]), lambda name: F.try_element_at(fields, name))
    return F.try_element_at(F.array_compact(values), F.lit(1))


def _references(ids: Column) -> Column:
    """Distinct (type, value) pairs, sorted."""
    pairs = F.transform(ids, lambda n: F.struct(reference_kind(n["key"]).alias("type"), n["value"].alias("value")))
    return F.array_sort(F.array_distinct(pairs))


def scanner_entries(docs: DataFrame, source: str = "source") -> DataFrame:
    """One row per scanner entry of a document, with its native ids, texts, objects and vulnerable paths."""
    doc = F.col("doc")
    # What the entries need of their document is read before there is a row for each of them.
    opened = docs.select(
        source, *_owner(), F.col("walked.hash").alias("sourceHash"), parse_timestamp(at(doc, "extractedAt")).alias("retrievedAt"),
        at(doc, INFOS, "array<struct<assessmentId: string, vulnerableFilePaths: array<string>>>").alias("infos"), "walked.entries",
    ).select("*", F.explode("entries").alias("e")).withColumn("info", F.try_element_at("infos", F.col("e.index") + 1))
    return opened.select(
        source, "findingId", "assetId", "hostname", "sourceHash", "retrievedAt",
        F.col("e.index").alias("entry"), F.col("e.provider").alias("providerId"),
        normalize_scanner(F.col("e.provider")).alias("scanner"), F.col("info.assessmentId").alias("assessmentId"),
        F.col("e.ids").alias("ids"), _references(F.col("e.ids")).alias("references"), F.col("e.sources").alias("sources"),
        F.filter(F.coalesce("info.vulnerableFilePaths", F.array().cast("array<string>")), lambda path: path != "").alias("paths"),
    )


def _owner() -> list[Column]:
    doc = F.col("doc")
    return [
        F.coalesce(first_at(doc, "findingId", "data.findingId", "data.id"), F.lit("")).alias("findingId"),
        F.coalesce(first_at(doc, "assetId", "data.assetId"), F.lit("")).alias("assetId"),
        first_at(doc, "data.searchFinding.assetEffectiveName", "data.searchFinding.assetAbsoluteName").alias("hostname"),
    ]


def candidates(entries: DataFrame, source: str = "source") -> DataFrame:
    """One row per object or labelled text of an entry, with the nine resolved fields.

    ``isCandidate`` tells which of them describe a component and ``candidatesInEntry`` how many there are; an entry
    without any source keeps one row so that its paths are not lost.
    """
    opened = entries.select(
        *[name for name in entries.columns if name not in ("sources", "ids")],
        F.posexplode_outer("sources").alias("place", "s"),
    )
    fields, found = F.col("s.fields"), evidence_text.labelled_component(F.col("s.text"))
    nothing = F.lit(None).cast("string")
    labelled = {
        "package": found["package"], "component": found["package"], "vendor": nothing, "product": nothing,
        "ecosystem": found["language"], "language": found["language"],
        "installed_version": found["installed_version"], "required_version": found["required_version"],
        "install_path": found["install_path"],
    }
    from_text = F.col("s.text").isNotNull()
    resolved = opened.withColumns({
        name: F.when(from_text, labelled[name]).otherwise(_spelled(fields, spellings))
        for name, spellings in fixed.FIELD_SPELLINGS.items()
    })
    identity = F.coalesce("package", "component", "product")
    is_candidate = F.when(from_text, F.coalesce(*FIELDS).isNotNull()).otherwise(identity.isNotNull())
    per_entry = Window.partitionBy(source, "entry")
    return (
        resolved.withColumn("isCandidate", F.coalesce(is_candidate, F.lit(False)))
        # Everything about a document stays together: the windows below and the ones on single documents share this.
        .repartition(source)
        .withColumn("candidatesInEntry", F.count_if("isCandidate").over(per_entry))
        .withColumn("firstOfEntry", F.row_number().over(per_entry.orderBy(F.col("place").asc_nulls_first())) == 1)
        .withColumn("componentId", F.when(F.col("isCandidate"), component_id(
            F.col("assetId"), identity, F.col("installed_version"))))
        .withColumn("sourcePath", F.concat(
            F.lit("activeProviderInfos."), F.coalesce("providerId", F.lit("None")), F.lit("."), F.col("s.path")))
        .drop("s")
    )


def components(candidates_: DataFrame, source: str = "source") -> DataFrame:
    """Candidates with the last one per (component, scanner) of a document kept."""
    return first_per_key(
        candidates_.where("isCandidate"), [source, "componentId", "scanner"],
        [F.col("entry").desc(), F.col("place").desc()])


def occurrences(candidates_: DataFrame, source: str = "source") -> DataFrame:
    """Component x path rows: the own install path, else the entry's paths if it has exactly one candidate.

    The paths of an entry with no or several candidates are kept without a component.
    """
    none = F.array().cast("array<string>")
    own = (
        F.when(~F.col("isCandidate"), none)
        .when(F.col("install_path").isNotNull(), F.array("install_path"))
        .when(F.col("candidatesInEntry") == 1, F.col("paths"))
        .otherwise(none)
    )
    loose = F.when(F.col("firstOfEntry") & (F.col("candidatesInEntry") != 1), F.col("paths")).otherwise(none)
    paired = F.concat(
        F.transform(own, lambda path: F.struct(F.lit(False).alias("loose"), path.alias("path"))),
        F.transform(loose, lambda path: F.struct(F.lit(True).alias("loose"), path.alias("path"))),
    )
    opened = candidates_.select("*", F.posexplode(paired).alias("_k", "_p"))

    def assigned(name: str) -> Column:
        return F.when(~F.col("_p.loose"), F.col(name))

    rows = opened.select(
        source, "findingId", "assetId", "hostname", "scanner", "references", "sourceHash", "retrievedAt",
        "entry", "place", "_k", F.col("_p.path").alias("path"), F.col("_p.loose").alias("_loose"),
        *[assigned(name).alias(name) for name in ("componentId", "package", "installed_version", "required_version")],
    ).withColumn("occurrenceId", F.when(
        F.col("_loose"), unassigned_occurrence_id(F.col("assetId"), F.col("findingId"), F.col("path"))
    ).otherwise(occurrence_id(F.col("componentId"), F.col("path"))))
    return first_per_key(
        rows, [source, "occurrenceId"],
        [F.col("entry").desc(), F.col("_loose").desc(), F.col("place").desc_nulls_last(), F.col("_k").desc()])


def component_rows(candidates_: DataFrame, source: str = "source") -> DataFrame:
    return components(candidates_, source).select(
        "findingId", "assetId", "hostname", "componentId", "scanner", "package", "component", "vendor", "product",
        "ecosystem", "language", F.col("installed_version").alias("installedVersion"),
        F.col("required_version").alias("requiredVersion"), F.col("install_path").alias("installPath"),
        F.to_json("references").alias("scannerReferencesJson"), "sourcePath",
        F.col(source).alias("sourcePayloadReference"), "sourceHash", "retrievedAt")


def occurrence_rows(candidates_: DataFrame, source: str = "source") -> DataFrame:
    return occurrences(candidates_, source).select(
        "findingId", "assetId", "hostname", "componentId", "occurrenceId", "scanner", "package",
        F.col("installed_version").alias("installedVersion"), F.col("required_version").alias("requiredVersion"),
        F.col("path").alias("installPath"), F.to_json("references").alias("scannerReferencesJson"),
        F.col(source).alias("sourcePayloadReference"), "sourceHash", "retrievedAt")


def event_rows(docs: DataFrame, source: str = "source") -> DataFrame:
    """One row per audit entry of a document; needs the envelope only."""
    atoms = docs.select(source, *_owner(), F.explode(
        at(F.col("doc"), "data.assessmentsRelated.findingAuditHistory.info.atomInfos", "array<variant>")).alias("a"))

    def of(path: str) -> Column:
        return at(F.col("a"), path)

    rows = atoms.where(is_object(F.col("a"))).withColumns({
        "eventTimestamp": parse_timestamp(of("at")), "eventLabel": of("trigger"),
        "newStatus": of("declaredFindingStatus.subState"),
    })
    return rows.select(
        "findingId", "assetId", "hostname",
        event_id(of("auditId"), F.col("findingId"), F.col("eventTimestamp"), F.col("eventLabel")).alias("eventId"),
        "eventTimestamp", event_type(F.col("eventLabel"), F.col("newStatus")).alias("eventType"), "eventLabel",
        of("assessmentType").alias("eventSource"), F.lit(None).cast("string").alias("previousStatus"), "newStatus",
        of("userId").alias("actor"), normalize_scanner(of("providerId")).alias("scanner"),
        F.col(source).alias("rawEventReference"))


def scanner_reference_rows(entries: DataFrame, source: str = "source") -> DataFrame:
    """One row per native id, with the path where it was last found."""
    rows = entries.select(
        source, blank_to_null(F.col("findingId")).alias("findingId"), blank_to_null(F.col("assetId")).alias("assetId"),
        "providerId", "assessmentId", "entry", F.posexplode("ids").alias("place", "n"),
    ).select(
        "*", reference_kind(F.col("n.key")).alias("referenceType"), F.col("n.value").alias("referenceValue"),
        F.concat(F.lit("activeFindingProviderInfos["), F.col("entry").cast("string"), F.lit("]."), "n.path").alias("sourcePath"))
    return first_per_key(
        rows, [source, "providerId", "assessmentId", "referenceType", "referenceValue"],
        [F.col("entry").desc(), F.col("place").desc()],
    ).select("findingId", "assetId", "providerId", "assessmentId", "referenceType", "referenceValue", "sourcePath")


def diagnostics(docs: DataFrame, source: str = "source") -> DataFrame:
    """How much evidence a set of documents holds, as (measure, value).

    The candidates are written once; components, occurrences and references are all counted from them.
    """
    atoms = at(F.col("doc"), "data.assessmentsRelated.findingAuditHistory.info.atomInfos", "array<variant>")
    events = F.coalesce(F.size(F.filter(atoms, is_object)), F.lit(0))
    found = written(candidates(scanner_entries(docs, source), source).select(
        source, "findingId", "assetId", "hostname", "scanner", "references", "sourceHash", "retrievedAt", "entry", "place",
        "paths", "isCandidate", "candidatesInEntry", "firstOfEntry", "componentId", "package", "installed_version",
        "required_version", "install_path"), "candidates")
    versioned = F.coalesce("installed_version", "required_version").isNotNull()

    def measure(df: DataFrame, **values: Column) -> DataFrame:
        counted = df.agg(*[F.coalesce(value.cast("bigint"), F.lit(0)).alias(name) for name, value in values.items()])
        return counted.unpivot([], list(values), "measure", "value")

    return (
        measure(docs, findings=F.count(F.lit(1)), historyEvents=F.sum(events))
        .unionByName(measure(components(found, source), components=F.count(F.lit(1)), versions=F.count_if(versioned)))
        .unionByName(measure(occurrences(found, source), paths=F.count(F.lit(1))))
        .unionByName(measure(found.where("firstOfEntry"), scannerReferences=F.sum(F.size("references"))))
    )


def mitre_ids(doc: Column) -> Column:
    return F.array_sort(F.coalesce(
        at(doc, "data.searchFinding.mitreAttackTtps", "array<string>"), F.array().cast("array<string>")))
