"""Profile tag functions (S13-S17) and the fixed weight dictionaries used by scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions._col import as_col

__all__ = [
    "time_type_of_hour", "price_level", "category1_group", "keyword_class", "first_of_list", "first_word",
    "TIME_TYPES", "PRICE_LEVELS", "CATEGORY1_GROUPS", "KEYWORD_CLASS_RULES", "KEYWORD_CLASS_DEFAULT",
    "AGE_BRACKETS", "FACTOR_RATES", "WEIGHTS", "BRAND_FALLBACK", "DEVICE_FALLBACK",
]

# ---- fixed values (must equal the source system's) -------------------------
# Time of day: (first hour inclusive, last hour exclusive, name); other hours are 夜间.
TIME_TYPES = [
    (0, 6, "凌晨"),
    (6, 9, "早晨"),
    (9, 12, "上午"),
    (12, 14, "中午"),
    (14, 18, "下午"),
    (18, 22, "晚上"),
]
TIME_TYPE_OTHER = "夜间"
# Price levels: amount <= 1000 低价商品, <= 3000 中价商品, else 高价商品.
PRICE_LEVELS = [(1000, "低价商品"), (3000, "中价商品")]
PRICE_LEVEL_TOP = "高价商品"
# Category-1 remap; other categories are 家居用品.
CATEGORY1_GROUPS = [("个护化妆", "潮流服饰"), ("食品饮料、保健食品", "健康食品")]
CATEGORY1_OTHER = "家居用品"
# Search keyword -> class, first rule whose substring occurs wins.
KEYWORD_CLASS_RULES = [
    (["匡威"], "时尚与潮流"),
    (["衬衫", "心相印纸抽"], "性价比"),
    (["扫地机器人"], "家庭与育儿"),
    (["拯救者", "小米"], "数码与科技"),
    (["联想"], "学习与发展"),
]
KEYWORD_CLASS_DEFAULT = "健康与养生"
# Age brackets and the rate of each factor in the inferred age.
AGE_BRACKETS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50以上"]
FACTOR_RATES = {"category": 0.3, "brand": 0.2, "time": 0.15, "keyword": 0.15, "price": 0.1, "device": 0.1}
# Weight dictionaries: factor -> category -> weights for the six brackets, in bracket order.
WEIGHTS = {
    "category": {
        "潮流服饰": [0.9, 0.8, 0.6, 0.4, 0.2, 0.1],
        "家居用品": [0.2, 0.4, 0.6, 0.8, 0.9, 0.7],
        "健康食品": [0.1, 0.2, 0.4, 0.6, 0.8, 0.9],
    },
    "device": {
        "iOS": [0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
        "Android": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
        "else": [0.3, 0.4, 0.5, 0.6, 0.7, 0.8],
    },
    "keyword": {
        "时尚与潮流": [0.9, 0.7, 0.5, 0.3, 0.2, 0.1],
        "性价比": [0.2, 0.4, 0.6, 0.7, 0.8, 0.8],
        "健康与养生": [0.1, 0.2, 0.4, 0.6, 0.8, 0.9],
        "家庭与育儿": [0.1, 0.2, 0.4, 0.6, 0.8, 0.7],
        "数码与科技": [0.8, 0.6, 0.4, 0.3, 0.2, 0.1],
        "学习与发展": [0.4, 0.5, 0.6, 0.7, 0.8, 0.7],
    },
    "price": {
        "低价商品": [0.8, 0.6, 0.4, 0.3, 0.2, 0.1],
        "中价商品": [0.2, 0.4, 0.6, 0.7, 0.8, 0.7],
        "高价商品": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6],
    },
    "time": {
        "凌晨": [0.2, 0.1, 0.1, 0.1, 0.1, 0.1],
        "早晨": [0.1, 0.1, 0.1, 0.1, 0.2, 0.3],
        "上午": [0.2, 0.2, 0.2, 0.2, 0.3, 0.4],
        "中午": [0.4, 0.4, 0.4, 0.4, 0.4, 0.3],
        "下午": [0.4, 0.5, 0.5, 0.5, 0.5, 0.4],
        "晚上": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
        "夜间": [0.9, 0.7, 0.5, 0.3, 0.2, 0.1],
    },
    "brand": {
        "小米": [0.9, 0.7, 0.8, 0.3, 0.2, 0.1],
        "苹果": [0.9, 0.7, 0.8, 0.3, 0.2, 0.1],
        "联想": [0.1, 0.3, 0.5, 0.7, 0.8, 0.9],
        "金沙河": [0.1, 0.3, 0.5, 0.7, 0.8, 0.9],
        "香奈儿": [0.1, 0.3, 0.5, 0.7, 0.8, 0.9],
    },
}
BRAND_FALLBACK = "香奈儿"   # unknown brands use this row
DEVICE_FALLBACK = "else"    # unknown device os uses this row
# -----------------------------------------------------------------------------


def time_type_of_hour(hour) -> Column:
    """S13 hour of day -> time-of-day class."""
    h = as_col(hour)
    expr = None
    for lo, hi, name in TIME_TYPES:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(TIME_TYPE_OTHER)


def price_level(amount) -> Column:
    """S14 amount -> price level (null amount -> null)."""
    a = as_col(amount).cast("double")
    expr = None
    for limit, name in PRICE_LEVELS:
        expr = F.when(a <= limit, name) if expr is None else expr.when(a <= limit, name)
    return expr.when(a.isNotNull(), PRICE_LEVEL_TOP)


def category1_group(name) -> Column:
    """S15 category-1 remap."""
    c = as_col(name)
    expr = None
    for src, dst in CATEGORY1_GROUPS:
        expr = F.when(c == src, dst) if expr is None else expr.when(c == src, dst)
    return expr.otherwise(CATEGORY1_OTHER)


def keyword_class(keyword, rules=None, default: str = KEYWORD_CLASS_DEFAULT) -> Column:
    """S16 keyword -> search class; first matching rule wins; rules are an argument."""
    k = F.coalesce(as_col(keyword), F.lit(""))
    expr = None
    for needles, cls in (rules or KEYWORD_CLASS_RULES):
        cond = None
        for n in needles:
            cond = k.contains(n) if cond is None else cond | k.contains(n)
        expr = F.when(cond, cls) if expr is None else expr.when(cond, cls)
    return expr.otherwise(default)


def first_of_list(s, sep: str = ",") -> Column:
    """S17 first element of a separated list (device os)."""
    return F.split(as_col(s), sep, 2).getItem(0)


def first_word(s) -> Column:
    """S17 os name = first word."""
    return F.split(as_col(s), " ", 2).getItem(0)
