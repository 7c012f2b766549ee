"""They must equal the published data model for results to agree."""

from __future__ import annotations

# Age bands: key, label, lower age, upper age (None = open).
AGE_BANDS = [
    (1, "8-12", 8, 12),
    (2, "13-18", 13, 18),
    (3, "19-24", 19, 24),
    (4, "25-34", 25, 34),
    (5, "35-49", 35, 49),
    (6, "50-64", 50, 64),
    (7, "65+", 65, None),
]

# Pseudonym domains and their key prefixes.
KEY_PREFIXES = {
    "user": "AUSR_",
    "family": "AFAM_",
    "bundle_composition": "ABND_",
    "user_discount": "AUDS_",
    "user_service": "AUSRVS_",
}

# Content taxonomy: category -> details.
CONTENT_TAXONOMY = {
    "video": ["netflix", "youtube_video", "tving", "disney_plus", "other_video"],
    "short_form": ["youtube_shorts", "other_short_form"],
    "music": ["youtube_music", "genie_music", "other_music"],
    "ai": ["google_ai", "other_ai"],
    "ebook": ["milli_ebook", "other_ebook"],
    "web": ["general_web"],
    "sns": ["general_sns"],
    "messaging": ["general_messaging"],
    "game": ["general_game"],
    "video_call": ["general_video_call"],
    "navigation": ["general_navigation"],
    "cloud": ["general_cloud"],
    "other": ["other"],
}

# Which chosen service a content detail counts towards.
SERVICE_DETAILS = [
    ("S001", "netflix"),
    ("S002", "youtube_video"),
    ("S002", "youtube_shorts"),
    ("S002", "youtube_music"),
    ("S003", "tving"),
    ("S004", "genie_music"),
    ("S005", "milli_ebook"),
    ("S006", "disney_plus"),
    ("S009", "google_ai"),
]

# Usage buckets of the monthly distribution: label, lower GB, upper GB (None = open).
USAGE_BUCKETS = [
    ("0_to_1_gb", 0, 1),
    ("1_to_5_gb", 1, 5),
    ("5_to_10_gb", 5, 10),
    ("10_to_30_gb", 10, 30),
    ("30_to_100_gb", 30, 100),
    ("100_gb_or_more", 100, None),
]

# Plan id prefix of each plan family.
PLAN_PREFIXES = {
    "VOICE": "P10",
    "BASIC_ROLLOVER": "P21",
    "BASIC": "P22",
    "CHOICE": "P30",
    "CHOICE_DOUBLE": "P40",
}

CHOICE_FAMILIES = ["CHOICE", "CHOICE_DOUBLE"]
CONTRACT_MONTHS = [12, 24, 36]
HIGHER_INTERNET_GROUP = "BASIC_ESSENCE_PREMIUM"
INTERNET_GROUPS = ["BASIC_ESSENCE_PREMIUM", "SLIM"]

# Discount amounts for a 36-month contract by mobile fee total; shorter terms get a share of it.
CONTRACT_SHARE = {12: "0.25", 24: "0.50", 36: "1.00"}
TOTAL_FEE_RANGES = [
    (0, 21999),
    (22000, 64899),
    (64900, 108899),
    (108900, 141899),
    (141900, 174899),
    (174900, None),
]
COMBINED_DISCOUNT = {
    "BASIC_ESSENCE_PREMIUM": [2200, 5500, 11000, 22110, 27610, 33110],
    "SLIM": [1650, 3300, 8800, 19800, 24200, 28600],
}
INTERNET_DISCOUNT = {
    "BASIC_ESSENCE_PREMIUM": [2200, 5500, 5500, 5500, 5500, 5500],
    "SLIM": [1650, 3300, 5500, 5500, 5500, 5500],
}
INTERNET_ADDITIONAL = {"BASIC_ESSENCE_PREMIUM": 5500, "SLIM": 0}
LINE_FEE_RANGES = [
    (0, 36999, 0),
    (37000, 60999, 3000),
    (61000, 76999, 5000),
    (77000, None, 7000),
]
FIXED_INTERNET_BASE = 5500

# Quota stages: share of the allowance already used, per behaviour set.
QUOTA_THRESHOLDS = {
    "EARLY": (0.62, 0.78, 0.90),
    "NORMAL": (0.70, 0.85, 0.95),
    "LATE": (0.78, 0.92, 0.98),
}

# Result labels of the customer selection reports.
NO_CHOSEN_SERVICE = "선택 서비스 없음"
BENEFIT_NOT_CHOSEN = "현재 요금제에서 YouTube 혜택 선택 가능하지만 미선택"
BENEFIT_OUTSIDE_CHOICE = "초이스 외 무제한 요금제이며 YouTube 혜택 없음"
BENEFIT_ABSENT = "현재 요금제에 YouTube 혜택 없음"
PREMIUM_NOT_ENROLLED = "프리미엄 가족결합 미가입 초이스 고객"
TOTAL_NOT_ENROLLED = "총액결합 미가입 고객"

VIDEO_BRAND_SERVICE = "S002"
VIDEO_BRAND_DETAILS = ["youtube_video", "youtube_shorts", "youtube_music"]

# Columns that only the producing system may hold; they must not appear in a users table.
INTERNAL_USER_COLUMNS = [
    "current_total_discount_amount",
    "estimated_monthly_bill",
    "potential_family_discount",
]

# Monthly fees: from here on a line of a bundle counts as paying, and a plan as a high one.
PAYING_LINE_FEE = 37000
HIGH_PLAN_FEE = 80000
