"""Values that are part of the data contract."""

# Names, lists, bounds and formats every consumer of the tables relies on.
KNOWN_FIELDS = (
    "user_id",
    "event_type",
    "event_time",
    "app_id",
    "device_id",
    "page",
    "referrer",
    "product_id",
    "duration_ms",
    "ip",
    "os_type",
    "os_version",
    "net_type",
)
REQUIRED_FIELDS = ("user_id", "event_type", "event_time")
DEDUP_KEY = ("user_id", "event_type", "device_id", "event_time")
VALID_APP_IDS = ("mall_app", "h5", "mini_program")
MIN_EVENT_TIME = "2020-01-01 00:00:00"
MAX_FUTURE_SECONDS = 3600
EVENT_TIME_PATTERN = r"^(?!0000)\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"  # yyyy-MM-dd HH:mm:ss
EVENT_TIME_LENGTH = 19
OP_TYPES = {"c": "I", "r": "I", "u": "U", "d": "D"}
WATERMARK_DELAY_MS = 5_000
DEDUP_TTL_MS = 3_600_000
JDBC_BATCH_ROWS = 500
JDBC_BATCH_INTERVAL = "3 seconds"
JDBC_MAX_RETRIES = 3
LATE_BUCKETS = (
    (10_000, "< 10s"),
    (30_000, "10s ~ 30s"),
    (60_000, "30s ~ 1min"),
    (300_000, "1min ~ 5min"),
    (1_800_000, "5min ~ 30min"),
)
LATE_BUCKET_REST = "> 30min"
LATE_PCT_WIDEN = 2.0
LATE_PCT_INVESTIGATE = 5.0
TARGET_FILE_BYTES = 512 * 1024 * 1024
MAX_FILE_BYTES = 1024 * 1024 * 1024
MIN_INPUT_FILES = 5
MIN_INPUT_FILES_ONE_PARTITION = 3
SNAPSHOT_RETENTION_DAYS = 7
SNAPSHOT_RETAIN_LAST = 5
REPORT_PARTITIONS = 30
REPORT_SNAPSHOTS = 20
BLOOM_COLUMNS = ("user_id", "event_type")

# Dirty reasons, in the order the rules are tried.
PARSE_ERROR = "PARSE_ERROR"
EMPTY_JSON = "EMPTY_JSON"
UNKNOWN_OP = "UNKNOWN_OP"
NO_DATA_FIELD = "NO_DATA_FIELD"
MISSING_FIELDS = "MISSING_FIELDS"
INVALID_EVENT_TIME = "INVALID_EVENT_TIME"
EVENT_TIME_TOO_OLD = "EVENT_TIME_TOO_OLD"
EVENT_TIME_FUTURE = "EVENT_TIME_FUTURE"
INVALID_APP_ID = "INVALID_APP_ID"
INVALID_DURATION = "INVALID_DURATION"
