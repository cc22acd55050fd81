"""Rule-based tagging (P16-P18): substring rule tables and regex + alias maps.

Rules are data (lists / dicts) compiled into native expressions: a chained
``when(contains)`` for ordered substring rules, and ``regexp_extract`` followed
by a literal ``map`` lookup for regex + alias rules.  No Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkpanel.functions.columns import squash_name

# The two store-brand rule sets of the reference, kept as input data.
# Rule set A: ordered (label, substrings) checks on the lower-cased name; first match wins.
BRAND_RULES_A = [
    ("버거킹", ["버거킹", "burger king", "burgerking"]),
    ("맥도날드", ["맥도날드", "mcdonald"]),
    ("KFC", ["kfc", "케이에프씨"]),
    ("롯데리아", ["롯데리아", "lotteria"]),
]
# Rule set B: leftmost regex match on the lower-cased name, blanks/underscores removed,
# then alias -> canonical label.
BRAND_PATTERN_B = r"(버거킹|burger\s*king|burger_king|burgerking|맥도날드|mcdonald|kfc|롯데리아|lotteria|맘스터치|mom's\s*touch|momstouch)"
BRAND_ALIASES_B = {
    "버거킹": "버거킹", "burgerking": "버거킹",
    "맥도날드": "맥도날드", "mcdonald": "맥도날드",
    "kfc": "KFC",
    "롯데리아": "롯데리아", "lotteria": "롯데리아",
    "맘스터치": "맘스터치", "momstouch": "맘스터치", "mom'stouch": "맘스터치",
}
OTHER_LABEL = "기타"


def tag_by_rules(name: Column, rules: list[tuple[str, list[str]]], default: str = OTHER_LABEL) -> Column:
    """Ordered substring rules on lower(name); NULL name -> default."""
    low = F.lower(F.coalesce(name, F.lit("")))
    expr = None
    for label, subs in rules:
        cond = None
        for s in subs:
            c = low.contains(s.lower())
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def tag_by_regex_alias(name: Column, pattern: str, aliases: dict[str, str], default: str = OTHER_LABEL) -> Column:
    """Leftmost regex match, squashed (lower, no blanks/underscores), mapped through aliases."""
    low = F.lower(F.coalesce(name, F.lit("")))
    hit = F.regexp_extract(low, pattern, 1)
    alias_map = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return F.coalesce(F.try_element_at(alias_map, squash_name(hit)), F.lit(default))
