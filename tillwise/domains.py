"""Value domains, label texts and quality thresholds.

Everything a caller may want to swap for their own data lives in `Rules`; the
constants below are its defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: domains of the card-transaction table -------------------
CATEGORIES = ("식비", "교통", "쇼핑", "문화", "의료", "교육", "통신", "보험")
STATUSES = ("approved", "declined", "cancelled")
CARD_TYPES = ("신용", "체크")
REGIONS = ("서울", "경기", "인천", "부산", "대구", "대전", "광주", "제주")
INSTALLMENT_MONTHS = (0, 2, 3, 6, 12)

APPROVED = "approved"
DECLINED = "declined"
CANCELLED = "cancelled"
CREDIT = "신용"
DEBIT = "체크"

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
CARD_MASK = r"^\*{4}-\*{4}-\*{4}-\d{4}$"
TRANSACTION_ID = r"^TXN\d{10}$"

# --- Fixed values: labels ---------------------------------------------------
QUARTER_LABELS = {1: "Q1(1-3월)", 2: "Q2(4-6월)", 3: "Q3(7-9월)", 4: "Q4(10-12월)"}
# (label, first hour, last hour), both ends included; any other hour gets REST_SLOT
TIME_SLOTS = (("오전", 6, 11), ("오후", 12, 17), ("저녁", 18, 23))
REST_SLOT = "심야"
NO_DATA = "데이터 없음"

# --- Fixed values: small dimensions ----------------------------------------
CATEGORY_MASTER = (
    ("식비", "생활필수", 1),
    ("교통", "생활필수", 2),
    ("쇼핑", "소비지출", 3),
    ("문화", "여가활동", 4),
    ("의료", "생활필수", 5),
    ("교육", "자기계발", 6),
    ("통신", "고정지출", 7),
    ("보험", "고정지출", 8),
)
AMOUNT_RANGES = (
    ("식비", 1500, 80000),
    ("교통", 1250, 150000),
    ("쇼핑", 3000, 500000),
    ("문화", 5000, 50000),
    ("의료", 5000, 300000),
    ("교육", 10000, 500000),
    ("통신", 10000, 100000),
    ("보험", 30000, 300000),
)

# --- Fixed values: check name and detail text of each quality check ----------
MISSING_CHECK = ("Null 검사 [{column}]", "컬럼 '{column}'에 Null 값 발견")
CHECK_TEXTS = {
    "duplicate_id": ("거래ID 중복 검사", "transaction_id 중복 발견"),
    "double_payment": ("이중결제 의심 검사", "동일 시각/카드/금액/가맹점 거래 발견"),
    "amount_negative": ("음수 금액 검사", ""),
    "amount_excessive": ("과도 금액 검사", "기준: {amount_max:,}원 초과"),
    "amount_zero": ("0원 거래 검사", ""),
    "date_format": ("날짜 형식 검사", "yyyy-MM-dd HH:mm:ss 형식 불일치"),
    "date_future": ("미래 날짜 검사", ""),
    "category_domain": ("카테고리 유효성 검사", "유효 카테고리: {categories}"),
    "card_type_domain": ("카드유형 유효성 검사", ""),
    "status_domain": ("승인상태 유효성 검사", ""),
    "region_domain": ("지역 유효성 검사", ""),
    "card_mask": ("카드번호 마스킹 검사", "****-****-****-NNNN 패턴 불일치"),
    "declined_share": ("거절률 이상 탐지", ""),
}
DECLINED_DETAIL = "거절률 %s%% (기준: %s%% 이하)"


@dataclass(frozen=True)
class Rules:
    """Domains and thresholds of the quality suite."""

    categories: tuple[str, ...] = CATEGORIES
    statuses: tuple[str, ...] = STATUSES
    card_types: tuple[str, ...] = CARD_TYPES
    regions: tuple[str, ...] = REGIONS
    amount_min: int = 0
    amount_max: int = 10_000_000
    card_pattern: str = CARD_MASK
    timestamp_format: str = TIMESTAMP_FORMAT
    # a column fails when MORE than this share of its rows is missing
    missing_fail_share: float = 0.01
    # the declined check is reported only above this share
    declined_warn_share: float = 0.10
    # business rules (`business_rule_checks`)
    id_pattern: str = TRANSACTION_ID
    credit_type: str = CREDIT
    installments: tuple[int, ...] = INSTALLMENT_MONTHS
    installment_min_amount: int = 50_000
    amount_step: int = 100
    # amounts are clamped to their range and then rounded to `amount_step`
    amount_range_tolerance: int = 50
    date_from: str = "2024-01-01"
    date_to: str = "2024-12-31"
