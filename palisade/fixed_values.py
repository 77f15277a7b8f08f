"""Word lists, thresholds, patterns and formats that decide results.

They are kept here as plain text so that each can be checked on its own.
"""

# --- domains -------------------------------------------------------------------------------
SCHEMA_VERSION = "1.0"
PRIORITIES = ("P1", "P2", "P3")
HISTORY_STATES = ("NEW", "PERSISTENT", "RESOLVED", "REOPENED", "REGRESSION", "UNKNOWN")
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO")
SEVERITY_RANK = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
REQUIRED_BLOCKS = (
    "metadata", "asset", "current_posture", "findings", "vulnerabilities",
    "risk_analysis", "remediation", "validation", "sources", "data_quality",
)

# --- thresholds ----------------------------------------------------------------------------
CRITICAL_TRS = 900
BANDS = (("CRITICAL", 900, 9), ("HIGH", 700, 7), ("MEDIUM", 400, 4))
DUE_DAYS = {"P1": 7, "P2": 30, "P3": 90}
STALE_AGE_DAYS = 180
RISK_LABELS = {"critical": "Critique", "high": "Élevé", "medium": "Modéré", "low": "Faible"}
UNCLASSIFIED = "Non classé"

# --- patterns ------------------------------------------------------------------------------
# U: word, digit and space classes cover Unicode; d: only a newline ends a line.
CVE_WORD = r"(?U)\bCVE-\d{4}-\d{4,}\b"
CVE_FULL = r"(?U)^CVE-\d{4}-\d{4,}$"
REGISTRY_PATH = (
    r"(?imdU)\b((?:HKLM|HKCU|HKEY_LOCAL_MACHINE|HKEY_CURRENT_USER)\\[^\r\n=]+?)"
    r"(?=\s+(?:LastProduct|Version|CurrentVersion)\b|\s*=|$)"
)
WINDOWS_FILE = r"(?imdU)((?:%[^%]+%|[A-Z]:)\\[^\r\n]*?\.(?:dll|exe|sys|ocx|jar|config|xml|json|ini|so))"
LINUX_FILE = r"(?imdU)(/(?:usr|opt|etc|var|lib|home)/[^\s,;]+)"
DETECTED_VERSION = (
    r"(?iU)\b(?:version\s+(?:is|=)?|installed(?:\s+version)?\s*[:=])\s*([0-9][\w.+~-]*(?:\.[\w.+~-]+)+)"
)
EXPECTED_VERSION = (
    r"(?iU)\b(?:expected|required|fixed|target|lastproduct)(?:\s+version)?\s*[:=]\s*"
    r"([0-9][\w.+~-]*(?:\.[\w.+~-]+)+)"
)
LAST_PRODUCT_VERSION = r"(?iU)\bLastProduct\s*=\s*([0-9][\w.+~-]*(?:\.[\w.+~-]+)+)"
QID_TEXT = r"(?iU)\bQID\s*[:#]?\s*(\d+)\b"
QUOTED_TITLE = r'(?iU)Qualys\s+VM\s+details\s+for\s+"([^"]+)"'
LABEL_PATTERNS = {
    "package": r"(?iU)Package\s*:\s*([^\r\n]+)",
    "installed_version": r"(?iU)Installed\s+Version\s*:\s*([^\r\n]+)",
    "required_version": r"(?iU)(?:Required|Target|Fixed)\s+Version\s*:\s*([^\r\n]+)",
    "language": r"(?iU)Language\s*:\s*([^\r\n]+)",
    "install_path": r"(?iU)(?:Install\s+Path|Path)\s*:\s*([^\r\n]+)",
}
TITLE_PACKAGE = r"(?iU)for\s+([A-Za-z0-9_.-]+:[A-Za-z0-9_.-]+)"
HISTORY_URL_LIKE = "https://%/assets/live-report/%/vuln-management/findings/finding/%/history"
SECRET_MARKERS = ("authorization:", "bearer ", "api_key")
INTERNET_MARKERS = ("EXTERNAL_IP", "PUBLIC_IP", "INTERNET")
FORMULA_STARTS = r"^[=+\-@]"
MAX_CELL_TEXT = 32_767
MAX_SHEET_ROWS = 1_048_575

# --- lookups -------------------------------------------------------------------------------
PREFERRED_PROVIDER = "QUALYS_VM"
SCANNER_NAMES = {
    "qualys": "Qualys VM",
    "qualysvm": "Qualys VM",
    "crowdstrike": "CrowdStrike Falcon",
    "crowdstrikefalcon": "CrowdStrike Falcon",
    "azure": "Microsoft Azure",
}
REFERENCE_KINDS = {
    "qid": "QID",
    "pluginid": "PLUGIN_ID",
    "ruleid": "RULE_ID",
    "checkid": "CHECK_ID",
    "detectionid": "DETECTION_ID",
}
COMPONENT_KEYS = ("technicalDetails", "details", "evidence", "components", "packages")
FIELD_SPELLINGS = {
    "package": ("package", "packageName", "package_name", "artifact", "dependency", "module"),
    "component": ("component", "componentName", "component_name", "library"),
    "vendor": ("vendor", "publisher"),
    "product": ("product", "software", "productName", "product_name"),
    "ecosystem": ("ecosystem",),
    "language": ("language",),
    "installed_version": ("installedVersion", "installed_version", "detectedVersion", "detected_version"),
    "required_version": (
        "requiredVersion", "required_version", "targetVersion", "target_version",
        "fixedVersion", "fixed_version", "expectedVersion", "expected_version",
    ),
    "install_path": ("installPath", "install_path", "path", "location", "filePath", "file_path"),
}
PATH_KEYS = ("install_path", "installPath", "path", "file_path", "filePath", "location")
PATH_CLASSES = {
    "install": ("install_paths", "installPaths", "install_path", "installPath"),
    "vulnerable": ("vulnerableFilePaths", "vulnerable_file_paths", "filePaths", "file_paths"),
    "registry": ("registryPaths", "registry_paths", "registryPath", "registry_path"),
}
# Ordered: the first rule whose words are found wins.
EVENT_RULES = (
    ("FINDING_REOPENED", ("REOPEN",)),
    ("FINDING_RESOLVED", ("RESOLV", "CLOSED", "FIXED")),
    ("FINDING_CREATED", ("NEW_ASSESSMENT", "CREAT")),
    ("FINDING_CONFIRMED", ("CONFIRM", "DECLARED")),
    ("ASSET_INDICATORS_CHANGED", ("INDICATOR", "SCORE")),
    ("RISK_STATUS_CHANGED", ("RISK",)),
    ("REMEDIATION_UPDATED", ("REMEDIATION",)),
    ("FINDING_UPDATED", ("UPDATE", "THREAT_INTEL")),
)
HTTP_ERROR_TYPES = {
    401: "authentication", 403: "forbidden", 404: "not_found", 408: "timeout", 429: "rate_limit",
    500: "server_error", 502: "bad_gateway", 503: "unavailable", 504: "gateway_timeout",
}
SENSITIVE_KEYS = (
    "authorization", "api_key", "apikey", "token", "access_token", "password", "secret", "client_secret",
)
MASK = "***REDACTED***"
CVSS_BASE_ORDER = ("AV", "AC", "PR", "UI", "S", "C", "I", "A")
KEY_ALIASES = {
    "hostname": ("hostname", "fqdn"),
    "asset_id": ("asset_id", "assetId"),
    "finding_id": ("finding_id", "findingId"),
    "cve": ("cve", "cveId", "cve_id", "cves"),
    "scanner": ("scanner", "provider", "providerId", "provider_id"),
    "first_seen": ("first_seen", "firstSeen"),
    "last_seen": ("last_seen", "lastSeen"),
    "installed_version": ("installed_version", "installedVersion", "detectedVersion"),
    "required_version": ("required_version", "requiredVersion", "expectedVersion", "targetVersion"),
    "install_path": ("install_path", "installPath", "path", "filePath"),
}
PROFILE_TERMS = (
    "ip", "cve", "cvss", "remedi", "description", "provider", "os", "port", "protocol", "date", "seen", "service",
)
EXPECTED_CONCEPTS = (
    "IP", "CVE", "CVSS", "remediation", "description", "provider", "OS", "port", "protocol", "dates",
)
PATCH_WORDS = ("update", "upgrade", "patch", "kb")
CONFIG_WORDS = ("configure", "disable")

# --- output texts --------------------------------------------------------------------------
ACTION_UPGRADE = "Mettre à jour {} vers la version {}, puis valider la disparition du finding."
ACTION_CVE = (
    "Appliquer le correctif éditeur associé à {}, redémarrer si requis, puis relancer un scan de validation."
)
ACTION_SERVICE = "Corriger ou désactiver le service {} s’il n’est pas nécessaire, puis relancer un contrôle."
ACTION_GENERIC = (
    "Analyser la preuve du provider, appliquer le correctif recommandé par l’éditeur, "
    "puis relancer un scan de validation."
)
ACTION_NO_RECOMMENDATION = "Analyser la preuve scanner et définir le correctif éditeur applicable."
OWNER = "Local IT"
OWNER_SOURCE = "reporting_policy"
EVIDENCE_REQUIRED = ("Version installée après traitement", "Résultat du scan de validation")
EXIT_CRITERIA = ("Findings associés non détectés par le scanner source",)
CAMPAIGN_REASON = "Regroupement exact sur la recommandation et la version cible."
VALIDATION_CHECK = "Vérifier la version puis relancer le scan source"
HISTORY_WARNING = (
    "L’historique de scan est reconstruit depuis firstSeen/lastSeen; "
    "ces bornes ne constituent pas des scans exhaustifs."
)
HISTORY_METHOD = "reconstructed_observation_bounds"
NO_INFERENCE = "No inferred CVE, score, date or scanner status"
