"""Bins, segments, levels and value maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .numeric import clip
from .text import lookup, title_case


def cut_bins(c: Column, edges: list[float], labels: list[str], include_lowest: bool = False) -> Column:
    """Right-closed bins; the last edge may be None for no upper bound; outside is null."""
    low_ok = c >= edges[0] if include_lowest else c > edges[0]
    out = F.when(~low_ok, F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels):
        out = out.when(c.isNotNull() if high is None else c <= high, label)
    return out


def ladder(c: Column, steps: list[tuple], missing: str | None = None) -> Column:
    """First label whose lower bound the value reaches; the last step has bound None."""
    out = F.when(c.isNull(), F.lit(missing))
    for bound, label in steps[:-1]:
        out = out.when(c >= bound, label)
    return out.otherwise(steps[-1][1])


def order_size_category(c: Column) -> Column:
    return cut_bins(c, [0, 100, 500, 1000, 2000, None], ["Small", "Medium", "Large", "XLarge", "Enterprise"], True)


def order_size_compact(c: Column) -> Column:
    return cut_bins(c, [0, 100, 500, 1000, 2000, None], ["XSmall", "Small", "Medium", "Large", "XLarge"])


def order_size_four(c: Column) -> Column:
    return cut_bins(c, [0, 500, 1000, 2000, None], ["Small", "Medium", "Large", "XLarge"])


def quantity_category(c: Column) -> Column:
    return cut_bins(c, [0, 1, 3, 5, 10, None], ["Single", "Few", "Several", "Many", "Bulk"], True)


def order_value_category(c: Column) -> Column:
    return ladder(c, [(1000, "Premium"), (500, "High"), (100, "Medium"), (None, "Low")], "Unknown")


def segment_by_customer(spent: Column, orders: Column) -> Column:
    out = F.lit("Budget")
    for name, (min_spent, min_orders, _, _) in reversed(V.CUSTOMER_SEGMENTS.items()):
        out = F.when((spent >= min_spent) & (orders >= min_orders), name).otherwise(out)
    return out


def segment_priority(segment: Column) -> Column:
    return lookup(segment, {k: v[3] for k, v in V.CUSTOMER_SEGMENTS.items()}, F.lit(4))


def segment_by_order(c: Column) -> Column:
    return ladder(c, [(1000, "VIP"), (500, "Premium"), (200, "Standard"), (None, "Budget")], "Unknown")


def segment_by_order_wide(c: Column) -> Column:
    return ladder(c, [(1500, "VIP"), (800, "Premium"), (300, "Standard"), (None, "Budget")], "Budget")


def source_clean(c: Column) -> Column:
    lowered = F.lower(c)
    return lookup(lowered, V.SOURCE_ALIASES_CLEAN, lowered)


def known_source(c: Column, allowed: list[str] = V.VALID_SOURCES) -> Column:
    return F.when(c.isin(*allowed), c).otherwise("unknown")


def source_standard(c: Column) -> Column:
    lowered = F.lower(F.trim(c))
    return lookup(lowered, V.SOURCE_ALIASES_STANDARD, lowered)


def category_clean(c: Column) -> Column:
    lowered = F.lower(c)
    return title_case(lookup(lowered, V.CATEGORY_ALIASES_CLEAN, lowered))


def category_alias(c: Column) -> Column:
    lowered = F.lower(F.trim(c))
    return lookup(lowered, V.CATEGORY_ALIASES_STANDARD, lowered)


def category_standard(c: Column) -> Column:
    return title_case(category_alias(c))


def category_from_product(c: Column, whole_words: bool = False) -> Column:
    books = r"(?i)\b(kindle|book)\b" if whole_words else r"(?i)kindle|book"
    return (
        F.when(c.rlike(books), "Books").when(c.rlike(r"(?i)nintendo|playstation|xbox"), "Gaming").otherwise("Electronics")
    )


def canonical_segment(c: Column) -> Column:
    lowered = F.lower(F.trim(c))
    return lookup(lowered, V.SEGMENT_ALIASES, lowered)


def channel_type(source: Column) -> Column:
    return lookup(source, V.CHANNEL_TYPES, F.lit("Other"))


def product_traits(c: Column) -> dict[str, Column]:
    """Attributes of the last catalogue name contained in the product, any case."""
    names = ["product_brand", "product_subcategory", "price_tier", "popularity_score"]
    hit = None
    for product in reversed(V.PRODUCT_CATALOG):
        found = F.lower(c).contains(product.lower())
        hit = F.when(found, product) if hit is None else hit.when(found, product)
    unknown = ("Unknown", "Unknown", "Unknown", 50)
    return {
        name: lookup(hit, {p: traits[i] for p, traits in V.PRODUCT_CATALOG.items()}, F.lit(unknown[i])) for i, name in enumerate(names)
    }


def category_by_first_key(c: Column) -> Column:
    """Category of the first key contained in the product, any case."""
    out = F.when(c.isNull(), "Unknown")
    for key, category in V.PRODUCT_CATEGORY_KEYS.items():
        out = out.when(F.lower(c).contains(key.lower()), category)
    return out.otherwise("Other")


def product_facts(c: Column) -> dict[str, Column]:
    """Exact-name lookup; the table has eight fixed rows, so it is a literal, not a join."""
    return {
        "product_brand": lookup(c, {k: v[0] for k, v in V.PRODUCT_FACTS.items()}, F.lit("Unknown")),
        "product_release_year": lookup(c, {k: v[1] for k, v in V.PRODUCT_FACTS.items()}),
        "product_avg_rating": lookup(c, {k: v[2] for k, v in V.PRODUCT_FACTS.items()}),
    }


def product_from_title(c: Column) -> Column:
    title = F.lower(c)
    out = None
    for words, product in V.TITLE_PRODUCTS:
        hit = title.rlike("|".join(words))
        out = F.when(hit, product) if out is None else out.when(hit, product)
    # md5, unlike a salted hash, picks the same product in every run and engine
    slot = F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("int") % len(V.TITLE_FALLBACK)
    return out.otherwise(F.element_at(F.array(*[F.lit(p) for p in V.TITLE_FALLBACK]), slot + 1))


def _points(*terms: tuple[Column, int]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(cond, points).otherwise(0) for cond, points in terms])


def risk_score(high_amount: Column, high_quantity: Column, budget: Column, weekend: Column, deep_discount: Column) -> Column:
    extra = _points((high_amount, 20), (high_quantity, 15), (budget, 10), (weekend, 5), (deep_discount, 15))
    return clip(F.lit(50) + extra, 0, 100)


def risk_level(score: Column) -> Column:
    return cut_bins(score, [0, 30, 60, 80, 100], ["Low", "Medium", "High", "Critical"], True)


def risk_category(amount: Column, product_age: Column, kind: Column) -> Column:
    score = _points((amount > 1000, 2), (product_age < 1, 1), (kind == "Business", -1))
    return F.when(score >= 3, "High").when(score >= 1, "Medium").otherwise("Low")


def order_priority(amount: Column, segment: Column, rating: Column) -> Column:
    by_amount = F.when(amount.isNull(), 0).when(amount > 1000, 3).when(amount > 500, 2).otherwise(1)
    by_segment = lookup(segment, {"VIP": 3, "Premium": 2, "Standard": 1, "Budget": 0}, F.lit(0))
    by_rating = F.when(rating >= 4.5, 2).when(rating >= 4.0, 1).otherwise(0)
    return ladder(by_amount + by_segment + by_rating, [(7, "Critical"), (5, "High"), (3, "Medium"), (None, "Low")])


def quality_level(score: Column) -> Column:
    return ladder(score, V.QUALITY_LEVELS, "critical")


def quality_grade(score: Column) -> Column:
    return ladder(score, V.QUALITY_GRADES, "F")
