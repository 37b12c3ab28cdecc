"""Column sets, formats and default parameters of the access-log model."""

# --- fixed values: the log format and the result columns users already rely on ---
RAW_HEADER = [
    "[Host]", "[Date time]", "[Request method]", "[Reguested resourse]", "[Protocol version]",
    "[Response code]", "[Bytes]", "[Referrer]", "[User Agent]",
]
LOG_COLUMNS = [
    "host", "datetime", "method", "resource", "protocol", "status", "bytes", "referrer", "user_agent",
]
FEATURES = [
    "req_count", "unique_urls", "unique_ua", "error_4xx_rate", "error_5xx_rate",
    "avg_bytes", "total_bytes", "bytes_std", "bot_ua_rate",
]
REPORT_COLUMNS = [
    "host", "window_start", "req_count", "unique_urls", "unique_ua", "error_4xx_rate", "error_5xx_rate",
    "avg_bytes", "total_bytes", "bot_ua_rate", "anomaly_score_if", "risk_score_100", "label_if",
    "label_secondary", "anomaly_type",
]
# Time first: it has the most distinct values, so sorting by these keys rarely compares strings.
DEDUP_KEYS = ["ts", "host", "method", "resource", "status"]
SEPARATORS = ["\t", ",", ";", "|"]
# One or two digits each for day, hour, minute and second.
TIME_FORMATS = ["d/MMM/yyyy H:m:s"]
# Case-insensitive markers of non-human user agents.
BOT_MARKERS = [
    "bot", "crawler", "spider", "scraper", "python", "curl", "wget", "java/", "go-http", "httpclient",
    "libwww", "ahrefsbot", "semrushbot", "mj12bot", "baiduspider", "yandexbot", "googlebot", "bingbot",
    "scrapy", "facebookexternalhit", "archive.org_bot",
]
# Threat names, in rule order.
NORMAL = "normal"
BOT = "bot / crawler"
SCAN = "vulnerability scan / dir-brute"
FLOOD = "DDoS / flood (single endpoint)"
SCRAPER = "web scraper (content theft)"
HIGH_VOLUME = "high-volume anomaly"
LOW_VOLUME = "low-volume anomaly (needs manual review)"

# --- fixed values: default parameters users already rely on ---
WINDOW_SECONDS = 60
TREES = 200
SWEEP_TREES = 100
SUBSAMPLE = 256
CONTAMINATION = 0.05
SWEEP = [0.01, 0.03, 0.05, 0.07, 0.10]
SEED = 42
DBSCAN_EPS = 0.8
DBSCAN_MIN_POINTS = 5
THRESHOLD_QUANTILE = 0.999
THRESHOLD_MARGIN = 1.25
HIGH_VOLUME_FACTOR = 0.6
RATE_CAP = 0.9
# A top quantile of 0 gives half the smallest positive value, or half of this if there is none.
SMALLEST_POSITIVE = 0.01
FLOOD_URL_RATIO = 0.05
SCRAPER_URL_RATIO = 0.6
# Label of the second detector.
SECONDARIES = ["ocsvm", "dbscan"]
# Corner from which the one-class SVM sees the windows, in deviations above the mean of every feature.
SVM_ORIGIN = 3.0
