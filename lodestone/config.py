"""Defaults of the engine; every operator takes them as parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# Keyword patterns, marker lists, limits and lookup tables of the ETL.
ADMISSIONS = (
    "admiss", "apply", "application", "deadline", "enroll", "undergraduate", "graduate", "transfer", "freshman",
    "first.?year", "requirement", "accepted",
)
TUITION = (
    "tuition", "cost", "fee[s]?", "financial", "aid", "afford", "billing", "payment", "scholarship",
    "cost.?of.?attendance", "expense", "room.?board",
)
ADMISSIONS_SLUGS = ("deadline", "dates-deadline", "admission-deadline", "apply-now")
TUITION_SLUGS = ("cost-of-attendance", "tuition-fees", "tuition-and-fees", "cost-attendance")
PAGE_ADMISSIONS = ("admiss", "deadline", "apply", "enroll")
PAGE_TUITION = ("tuition", "cost", "fee", "financial", "aid")
TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "msclkid", "mc_cid", "mc_eid", "ref", "source",
)
AUTH_WORDS = (
    "login", "signin", "sign-in", "sso", "cas", "auth", "saml", "oauth", "authenticate", "account", "myportal", "my-portal",
)
BINARY = (
    "pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "jpg", "jpeg", "png", "gif", "svg", "webp", "ico", "mp4", "mp3", "avi",
    "mov", "wmv", "wav", "zip", "rar", "gz", "tar", "7z", "css", "js", "xml", "json", "rss",
)
SKIPPED = ("pdf", "jpg", "png", "doc", "zip")
BOT_MARKERS = (
    "cf-browser-verification", "challenge-platform", "just a moment", "checking your browser", "enable javascript", "access denied", "captcha",
)
AUTH_PATHS = ("login", "signin", "sign-in", "sso", "cas", "auth", "saml")
AUTH_HTML = (r"<input[^>]+type=[\"']password[\"']", r"<form[^>]+login", r"<form[^>]+signin", r"sign\s*in\s*to\s*(your|the)")
BLOCKED_TYPES = ("image", "media", "font", "stylesheet")
BLOCKED_URLS = (
    "google-analytics.com", "googletagmanager.com", "facebook.net", "doubleclick.net", "hotjar.com", "cdn.jsdelivr.net/npm/bootstrap",
    ".woff2", ".woff", ".ttf", ".eot", ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".ico", ".mp4", ".mp3", ".avi", ".mov",
)
NOISE_TAGS = (
    "script", "style", "noscript", "iframe", "nav", "footer", "header", "form", "button", "input", "select", "textarea", "aside",
    "svg", "img", "video", "audio",
)
NOISE_CLASSES = (
    "cookie", "banner", "popup", "modal", "overlay", "notification", "alert", "breadcrumb", "pagination", "social", "share", "print", "skip",
)
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT",
    "delaware": "DE", "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA",
    "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI",
    "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new hampshire": "NH",
    "new jersey": "NJ", "new mexico": "NM", "new york": "NY", "north carolina": "NC", "north dakota": "ND", "ohio": "OH",
    "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode island": "RI", "south carolina": "SC", "south dakota": "SD",
    "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west virginia": "WV",
    "wisconsin": "WI", "wyoming": "WY", "district of columbia": "DC",
}
US_NAMES = ("us", "usa", "u.s.", "u.s.a.", "united states of america", "united states")
DEADLINE_TYPES = ("Early Decision", "Regular Decision", "Transfer Admission")
RATE_LIMITED = ("rate limit", "quota", "resource exhausted", "too many requests", "429", "resource_exhausted")
CONTEXT_CHARS, CONTEXT_PAGES = 40_000, 3
TRUNCATED = "\n\n[Content truncated...]"
THRESHOLD, EXPAND_TOP, EXPAND_FLOOR, TOP = 0.3, 5, 0.2, 6
COST_RANGE, YEAR_RANGE = (10, 500_000), (2024, 2028)
SLOW_MS, FAST_TIMEOUT_MS, TIMEOUT_MS, MIN_HTML = 8_000, 15_000, 30_000, 100
SITE_PARALLEL, SITE_DELAY = 3, 0.5
#: Pages that one task loads at once, of all its sites.
TASK_THREADS = 64
FILE_TIMEOUT, AGENT = 15.0, "Mozilla/5.0 (compatible; lodestone)"


@dataclass(frozen=True)
class Model:
    name: str
    delay: float = 7.0
    rpm: int | None = None
    rpd: int | None = None


@dataclass(frozen=True)
class PoolConfig:
    """Models in order of priority, the wait between rotations and the number of rotations."""

    models: tuple[Model, ...] = (Model("small", 5.0, 15, 500), Model("newest", 13.0, 5, 20), Model("stable", 13.0, 5, 20))
    wait: float = 60.0
    rotations: int = 2
    keys: tuple[str, ...] = field(default=())


def any_of(words, escape: bool = False) -> str:
    """An alternation of patterns, or of plain words."""
    import re

    return "|".join(re.escape(w) if escape else w for w in words)
