"""Text functions, `Column -> Column`, built-in expressions only."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V

_BLANKS = r"(?U)[\s\x1c-\x1f]+"
_LETTER_RUNS = r"(\p{L}+|\P{L}+)"
_WORD_RUNS = r"(?U)(\w+|\W+)"


def literal_map(mapping: dict) -> Column:
    """A constant map; Catalyst folds it to one literal, so a lookup needs no join."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def lookup(key: Column, mapping: dict, default: Column | None = None) -> Column:
    found = F.element_at(literal_map(mapping), key)
    return found if default is None else F.coalesce(found, default)


def squeeze(c: Column) -> Column:
    """Trim and turn every run of whitespace into one space."""
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


def clean_text(c: Column, null_tokens: tuple[str, ...] = ("nan",)) -> Column:
    text = squeeze(c.cast("string"))
    return F.when(~text.isin(*null_tokens), text)


def title_case(c: Column) -> Column:
    """Capitalise each run of letters; anything else separates runs (`o'neil 3rd` -> `O'Neil 3Rd`).

    `initcap` starts words at spaces only, so it serves where no letter follows another mark.
    """
    runs = F.regexp_extract_all(c, F.lit(_LETTER_RUNS), F.lit(1))
    by_run = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(c.rlike(r"[^\p{L} ]\p{L}"), by_run).otherwise(F.initcap(c))


def plain_name(c: Column) -> Column:
    """Letters, blanks, hyphens and apostrophes only."""
    return F.regexp_replace(c, r"[^a-zA-Z\s\-']", "")


def clean_person_name(c: Column) -> Column:
    return plain_name(title_case(clean_text(c)))


def fix_titles(c: Column) -> Column:
    return F.regexp_replace(c, r"\b(Dr|Mr|Ms|Mrs)\b(?!\.)", "$1.")


def brand_spelling(c: Column) -> Column:
    """Brand spellings in title-cased text, where a brand is capitalised or inside a word."""
    out = c
    for word, brand in V.BRAND_CASE.items():
        for form in (word, word.lower()):
            out = F.replace(out, F.lit(form), F.lit(brand))
    return out


def fix_brand_case(c: Column) -> Column:
    return brand_spelling(title_case(c))


def canonical_product(c: Column, aliases: dict[str, str] = V.PRODUCT_ALIASES) -> Column:
    return lookup(F.lower(c), aliases, c)


def known_location(c: Column) -> Column:
    return lookup(F.lower(c), V.LOCATION_ALIASES, c)


def canonical_location(c: Column) -> Column:
    return title_case(known_location(c))


def is_valid_email(c: Column) -> Column:
    return c.rlike(V.EMAIL_PATTERN)


def clean_email(c: Column) -> Column:
    """Lower-cased and trimmed; an invalid address becomes null."""
    email = F.trim(F.lower(c))
    return F.when(is_valid_email(email), email)


def normalize_email(c: Column) -> Column:
    """As `clean_email`, also without inner blanks and with provider aliases folded."""
    email = F.regexp_replace(F.lower(c), _BLANKS, "")
    domain = F.substring_index(email, "@", -1)
    folded = F.concat(
        F.substring(email, F.lit(1), F.length(email) - F.length(domain)),
        lookup(domain, V.EMAIL_DOMAIN_ALIASES, domain),
    )
    return F.when(is_valid_email(folded), folded)


def email_domain(c: Column) -> Column:
    return F.when(c.contains("@"), F.split_part(c, F.lit("@"), F.lit(2))).otherwise("Unknown")


def customer_type(domain: Column) -> Column:
    return (
        F.when(domain == "Unknown", "Unknown").when(domain.isin(*V.PERSONAL_DOMAINS), "Personal").otherwise("Business")
    )


def normalize_phone(c: Column) -> Column:
    kept = F.regexp_replace(c, r"[^0-9+\-]", "")
    return F.regexp_replace(kept, r"^\+?1?-?([0-9]{3})-?([0-9]{3})-?([0-9]{4})$", r"+1-$1-$2-$3")


def normalize_phone_digits(c: Column) -> Column:
    digits = F.regexp_replace(c, r"[^0-9]", "")
    national = F.when(F.length(digits) == 10, digits).when(
        (F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)
    )
    dashed = F.concat_ws("-", F.lit("+1"), F.substring(national, 1, 3), F.substring(national, 4, 3), F.substring(national, 7, 4))
    return F.when(national.isNotNull(), dashed).otherwise(c)


def expand_address(c: Column) -> Column:
    """Expand abbreviations word by word in one pass."""
    runs = F.regexp_extract_all(c, F.lit(_WORD_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: lookup(F.lower(w), V.ADDRESS_WORDS, w)), "")


def normalize_address(c: Column) -> Column:
    return expand_address(title_case(squeeze(c)))


def normalize_order_id(c: Column) -> Column:
    """`AAA9999999`, `AAA_9999-999` and `AAA 9999 999` become `AAA-9999-999`; other ids stay."""
    form = r"^([A-Z]{3})(?:(\d{4})(\d{3})|[-_](\d{4})[-_](\d{3})|\s+(\d{4})\s+(\d{3}))$"
    return F.regexp_replace(F.upper(F.trim(c)), form, "$1-$2$4$6-$3$5$7")


def normalize_order_id_ext(c: Column) -> Column:
    up = F.upper(c)
    yy = F.regexp_extract(up, r"^ORD-(\d{2})-\d{3}$", 1)
    return (
        F.when(yy != "", F.concat(F.lit("ORD-"), F.when(yy < "50", "20").otherwise("19"), F.substring(up, 5, 6)))
        .when(up.rlike(r"^ORD-[^-]*-[^-]*$"), up)
        .when(up.startswith("ORD_"), F.translate(up, "_", "-"))
        .when(up.startswith("ORDER-"), F.replace(up, F.lit("ORDER-"), F.lit("ORD-")))
        .when(up.rlike(r"^\d{4}-\d{3}$"), F.concat(F.lit("ORD-"), up))
        .otherwise(up)
    )


def name_length(c: Column) -> Column:
    return F.length(c)


def has_title(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(Dr|Mr|Ms|Mrs)\."), F.lit(False))


def truncate_text(c: Column, max_length: int, suffix: str = "...") -> Column:
    cut = F.concat(F.substring(c, 1, max_length - len(suffix)), F.lit(suffix))
    return F.when(F.length(c) <= max_length, c).otherwise(cut)


def case_styles(c: Column) -> Column:
    """How many of the styles lower, UPPER and Title a value satisfies (0, 1 or 2)."""
    cased = F.lower(c) != F.upper(c)
    styles = [c == F.lower(c), c == F.upper(c), c == title_case(c)]
    return F.when(cased, reduce(lambda a, b: a + b, [s.cast("int") for s in styles])).otherwise(0)


def case_style(c: Column) -> Column:
    cased = F.lower(c) != F.upper(c)
    return (
        F.when(cased & (c == F.lower(c)), "lower")
        .when(cased & (c == F.upper(c)), "upper")
        .when(cased & (c == title_case(c)), "title")
        .otherwise("other")
    )


def is_test_name(c: Column, words: list[str] = V.TEST_NAME_WORDS_STRICT, whole_words: bool = False) -> Column:
    pattern = "|".join(words)
    return F.lower(c).rlike(rf"\b({pattern})\b" if whole_words else pattern)


def record_hash(*cols: Column) -> Column:
    return F.substring(F.md5(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])), 1, 8)


def snake_case(name: str) -> str:
    """Driver-side helper for column names."""
    spaced = re.sub(r"(?<=.)([A-Z])", r"_\1", name).lower()
    return "_".join(part for part in re.split(r"[^a-z0-9]+", spaced) if part)
