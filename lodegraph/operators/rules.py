"""Rule tables: keyword lists and limits as parameters of the operators, with the defaults of the domain.

Every list is a plain value here, so another language or domain passes its own. All are small and fixed, so
expressions over them stay inside one generated stage.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Header keywords by role (without spaces), in the order in which roles are tried.
HEADER_ROLES = {
    "name": ("명칭", "공종명", "종목", "공종", "항목", "작업명", "작업별", "구분", "종별", "품명"),
    "spec": ("규격", "사양", "치수"),
    "unit": ("단위",),
    "quantity": ("수량", "소요량"),
    "labor": (
        "인부", "인원", "인력", "노무", "특별인부", "보통인부", "콘크리트공", "철근공", "비계공", "형틀목공", "용접공", "배관공", "전공", "조적공", "미장공", "방수공", "도장공", "타일공", "내장공", "판금공", "석공",
        "건축목공", "측량사", "측량보조", "기능공", "기사", "산업기사", "기능사", "기술자", "지적기사", "지적산업기사", "지적기능사", "특수용접공", "취부공",
    ),
    "equipment": (
        "장비", "기계", "크레인", "굴착기", "굴삭기", "레미콘", "덤프트럭", "펌프카", "진동롤러", "로울러", "살수차", "콤프레셔", "발전기", "항타기", "천공기", "보링기", "그라우팅", "컷터기", "절단기", "다짐기", "다짐장비", "용접기", "브레이커",
    ),
    "material": (
        "재료", "자재", "재료비", "시멘트", "골재", "모래", "자갈", "철근", "콘크리트", "레미콘", "아스팔트", "아스콘", "합판", "거푸집", "비계", "동바리", "방수재", "접착제", "실링재", "도료", "관", "파이프", "밸브", "이음쇠",
    ),
    "note": ("비고",),
}
NOT_UNIT = ("소수자리",)
TOTALS = ("합계", "소계", "total")
# Entity types with their id prefixes; allowed ends of each relation.
TYPE_PREFIX = {"WorkType": "W", "Labor": "L", "Equipment": "E", "Material": "M", "Section": "S", "Note": "N", "Standard": "ST"}
DIRECTIONS = {
    "REQUIRES_LABOR": (("WorkType",), "Labor"),
    "REQUIRES_EQUIPMENT": (("WorkType",), "Equipment"),
    "USES_MATERIAL": (("WorkType",), "Material"),
    "HAS_NOTE": (("WorkType", "Section", "Equipment", "Material", "Standard", "Labor"), "Note"),
    "APPLIES_STANDARD": (("WorkType", "Section", "Equipment", "Material"), "Standard"),
    "BELONGS_TO": (("WorkType",), "Section"),
}
# Trades whose names are also written with a space behind each syllable.
SPACED_TRADES = ("특별인부", "보통인부", "콘크리트공", "철근공", "비계공", "형틀목공", "용접공", "배관공", "조적공", "미장공", "방수공", "도장공", "타일공", "판금공", "석공", "지적기사", "지적산업기사", "지적기능사")
# What a note that was taken for a work type reads like.
NOTE_LIKE = r"(^\[주\]|^①|^②|^③|^④|^⑤|^※|별도\s*계상|포함|제외|할증|감소|적용|기준|비고|^주\)|주\d+\))"
METHOD_RANK = {"merged": 1, "llm": 2, "table_rule": 3, "auto": 4}
OUTLIER = {"REQUIRES_LABOR": 75.0, "REQUIRES_EQUIPMENT": 3300.0, "USES_MATERIAL": 225.0}
UNIT_SIGNS = {"㎥": "m³", "㎡": "m²", "㎝": "cm", "㎜": "mm", "㎞": "km", "㏊": "ha", "ℓ": "L", "KW": "kW", "Kw": "kW"}
BLANK_SPECS = ("", "-", "없음", "—", "―")


def first_match(text: Column, rules: dict[str, tuple[str, ...]], default: str) -> Column:
    """The first rule of which a keyword occurs in the text."""
    out = None
    for name, words in rules.items():
        hit = text.rlike("|".join(words))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def lookup(col: Column, table: dict, default=None) -> Column:
    """A fixed table as an expression."""
    out = None
    for k, v in table.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default))


def switch(col: Column, cases: dict[str, Column], default: Column) -> Column:
    """The column of the case that ``col`` names."""
    out = None
    for k, v in cases.items():
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out.otherwise(default)


def allowed(relation: Column, source_type: Column, target_type: Column) -> Column:
    """Whether a relation may go from source_type to target_type; null for unknown relations."""
    out = None
    for rel, (sources, target) in DIRECTIONS.items():
        ok = source_type.isin(*sources) & (target_type == target)
        out = F.when(relation == rel, ok) if out is None else out.when(relation == rel, ok)
    return out
