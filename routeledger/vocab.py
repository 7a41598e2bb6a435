"""Fixed vocabularies. Every tuple below is a fixed value of the data contract."""

# metric_status of a (value, metric_status, reason) triple
MEASURED = "measured"
NOT_CONFIRMED = "not_confirmed"
NOT_CALCULABLE = "not_calculable"
INVALID_INPUT = "invalid_input"
NOT_COMPARABLE_SCOPE = "not_comparable_scope"
NOT_EXACT = "not_exact_frequency_based"
NO_COMMON_WEEK = "not_comparable_no_common_week"
METRIC_STATUSES = (
    MEASURED, NOT_CONFIRMED, NOT_CALCULABLE, INVALID_INPUT,
    NOT_COMPARABLE_SCOPE, NOT_EXACT, NO_COMMON_WEEK,
)

# metric ids of the per-feed long table
AGENCY_COUNT = "gtfs_agency_record_count"
ROUTE_COUNT = "gtfs_route_id_count"
BOARDING_COUNT = "gtfs_boarding_location_id_count"
TRIP_COUNT = "scheduled_trip_count_by_date"
STRUCTURE_METRICS = (AGENCY_COUNT, ROUTE_COUNT, BOARDING_COUNT)

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

FEED_FILES = (
    "agency.txt", "routes.txt", "stops.txt", "calendar.txt",
    "calendar_dates.txt", "trips.txt", "frequencies.txt",
)
PRIMARY_KEYS = {
    "agency.txt": ("agency_id",),
    "stops.txt": ("stop_id",),
    "routes.txt": ("route_id",),
    "trips.txt": ("trip_id",),
    "stop_times.txt": ("trip_id", "stop_sequence"),
}

ACCESS_STATUSES = (
    "public_download_confirmed", "authentication_required",
    "not_publicly_distributed", "official_resource_unavailable",
)

# freshness status -> process exit code
FRESHNESS_EXIT = {
    "unchanged": 0, "changed": 1, "unavailable": 2, "oversize": 2, "invalid_baseline": 3,
}
EMPTY_REPORT_EXIT = 3
SOURCE_TYPES = ("registry_pdf", "gtfs_zip")

TRANSPORT_TYPES = ("福祉有償運送", "交通空白地有償運送")
GAP_AREA_TYPE = "交通空白地有償運送"
TOTAL_LABEL = "合計"
# service-type letter of a registration number, per transport type
SERVICE_TYPE_CODES = {"福祉有償運送": ("福",), "交通空白地有償運送": ("交", "過")}

# passenger-scope mark -> published column
SCOPE_COLUMNS = {
    "イ": "scope_i_physical",
    "ロ": "scope_ro_mental",
    "ハ": "scope_ha_intellectual",
    "ニ": "scope_ni_care",
    "ホ": "scope_ho_support",
    "ヘ": "scope_he_checklist",
    "ト": "scope_to_other",
}

# era name -> year before its first year
ERA_BASE = {"令和": 2018, "平成": 1988, "昭和": 1925}
ERA_ABBR = {"R": "令和", "H": "平成", "S": "昭和"}

# vehicle-column label fragment -> vehicle type, first match wins
VEHICLE_LABEL_RULES = (
    ("寝台車", "寝台車"), ("車いす", "車いす車"), ("兼用車", "兼用車"),
    ("回転", "回転シート車"), ("シート", "回転シート車"), ("普通自動車", "普通自動車"),
    ("セダン", "セダン等"), ("バス", "バス"), ("合計", "合計"),
)

# old-style registration prefix -> authority code
OLD_AUTHORITY_PREFIXES = {"中山市": "中山"}
# place named in a service area -> municipality it belongs to
AREA_ALIASES = {"向津具地区": "長門市"}

OFFICE_MISMATCH = "office_mismatch"
OFFICE_NOTATION = "office_notation_diff"

REDACTION_LABEL = "代表者の氏名"
REDACTION_MARKER = "[氏名-非出力]"

SCORE_SUBCRITERIA = {
    "utility": ("problem_value_clarity", "method_fit", "user_value_evidence"),
    "completeness": (
        "public_implementation", "reproducibility_verifiability", "scope_reliability",
    ),
    "challenge": ("novelty", "output_comprehensiveness", "continuity", "actor_diversity"),
}

# archive safety limits; a value equal to the limit passes
MAX_MEMBERS = 200
MAX_MEMBER_BYTES = 100 * 1024 * 1024
MAX_TOTAL_BYTES = 500 * 1024 * 1024
MAX_RATIO = 200

MANIFEST_COLUMNS = (
    "source_id", "source_type", "official_url", "local_path", "baseline_sha256",
    "baseline_bytes", "baseline_acquired_at", "max_download_bytes",
)
# fragments that must not appear in a published column name
FORBIDDEN_COLUMN_WORDS = ("代表者", "氏名", "daihyo", "representative")
