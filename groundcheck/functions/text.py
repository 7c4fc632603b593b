"""Text functions as columns: whitespace, invisible characters, numbers, periods, claim ids.

Patterns carry ``(?U)`` so that word, digit and space classes are Unicode ones. Every function takes
and gives columns, stays inside the JVM, and gives null for a null text unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must be just these for right results.
MAGNITUDE_UNIT = r"%|million|billion|thousand|bps|units|m|bn|k"
CURRENCY_CODE = r"USD|GBP|EUR|JPY|CHF|CAD|AUD|CNY|HKD|SGD"
MAGNITUDE_WORD = r"thousand|million|billion|trillion|bps|basis\s+points"
NUMBER = r"-?[$€£]?\s*-?\d[\d,]*(?:\.\d+)?\s*%?"
RANGE_HYPHEN = r"(?<=[\d%])-(?=[\d$€£])"
CLAIM_ID = r"\bclaim-\d[a-zA-Z0-9_-]*\b"
PERIODS = (
    r"\bFY\s?20\d{2}\b",
    r"\bQ[1-4]\b",
    r"\bH[12]\b",
    r"\b[12]H(?:\d{2})?\b",
    rf"(?<![$€£])\b(?:19|20)\d{{2}}\s?[-–]\s?(?:(?:19|20)\d{{2}}|\d{{2}})\b(?!\s*(?:{MAGNITUDE_UNIT})\b)",
    rf"(?<![$€£])\b(?:19|20)\d{{2}}\b(?!\s*(?:{MAGNITUDE_UNIT})\b)",
    rf"\b(?!(?:{CURRENCY_CODE})\d)[A-Z]+\d+[A-Z]*\b",
)
FINANCIAL_FIGURE = rf"[$€£]\s?\d|\d\s?%|\bper\s+cent\b|\d[\d,]*(?:\.\d+)?\s*(?:{MAGNITUDE_WORD})\b"
UNIVERSAL = r"\b(every|all (?:four|three|of the)|none of|no (?:peer|bank|competitor)s?|each of the)\b"
MATERIAL_SUFFIX = rf"x\b|\s*(?:{MAGNITUDE_WORD})\b"
INVISIBLE = r"\p{Cf}|[\x00-\x08\x0b-\x1f\x7f]"
WHITE = r"(?U)[\s\x1c-\x1f]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_whitespace(text: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(text, WHITE, " "))


def strip_invisible(text: Column) -> Column:
    """Format characters and controls go, tabs and line feeds stay."""
    return F.regexp_replace(text, INVISIBLE, "")


def number_tokens(text: Column) -> Column:
    """Written numbers in order; a hyphen between two numbers parts them and is no sign."""
    return F.regexp_extract_all(F.regexp_replace(text, f"(?U){RANGE_HYPHEN}", " "), F.lit(f"(?U){NUMBER}"), 0)


def number_value(token: Column) -> Column:
    """Value of a written number; null if it has none."""
    minus = token.rlike(r"(?U)^\s*(?:-|-?[$€£]+-)")
    value = F.regexp_replace(token, r"(?U)^\s*-?[$€£]*-?|[,%\s]", "").try_cast("double")
    return F.when(minus, -value).otherwise(value)


def numbers(text: Column) -> Column:
    """Distinct values of the numbers in a text."""
    return F.array_distinct(F.filter(F.transform(number_tokens(text), number_value), lambda v: v.isNotNull()))


def strip_periods(text: Column) -> Column:
    """Calendar labels and identifiers with digits become blanks; amounts stay."""
    return F.regexp_replace(text, "(?iU)" + "|".join(PERIODS), " ")


def claim_ids(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?U){CLAIM_ID}"), 0)


def prose_tokens(text: Column) -> Column:
    """Number tokens of prose without its claim ids and period labels."""
    return number_tokens(strip_periods(F.regexp_replace(text, f"(?U){CLAIM_ID}", " ")))


def material_numbers(text: Column) -> Column:
    """``value, is_percent`` of the numbers with a currency, a percent sign, a magnitude word, basis
    points or a multiple's x; each once."""
    pattern = F.lit(f"(?U)({NUMBER})(?=((?i:{MATERIAL_SUFFIX}))?)")
    clean = F.regexp_replace(text, f"(?U){RANGE_HYPHEN}", " ")
    pairs = F.arrays_zip(F.regexp_extract_all(clean, pattern, 1).alias("token"), F.regexp_extract_all(clean, pattern, 2).alias("suffix"))
    marked = F.filter(pairs, lambda p: p["token"].rlike("[$€£%]") | (F.coalesce(p["suffix"], F.lit("")) != ""))
    found = F.transform(marked, lambda p: F.struct(number_value(p["token"]).alias("value"), p["token"].contains("%").alias("is_percent")))
    return F.array_distinct(F.filter(found, lambda n: n["value"].isNotNull()))


def grounded(value: Column, known: Column, tolerance: float = 1e-6) -> Column:
    """Whether a known number lies within the tolerance, itself excluded; no known numbers ground nothing."""
    return F.exists(F.coalesce(known, F.array().cast("array<double>")), lambda k: F.abs(k - value) < F.lit(tolerance))


def first_ungrounded(tokens: Column, known: Column, settled: Column | None = None) -> Column:
    """First token whose value is not grounded; one written as percent may also be stored as a
    fraction. ``settled`` holds values that are known to be grounded elsewhere."""

    # Values are parsed once, in an array of their own, and not in every comparison.
    parsed = F.transform(tokens, lambda t: F.struct(t.alias("token"), number_value(t).alias("value")))

    def fine(value: Column) -> Column:
        held = grounded(value, known)
        return held if settled is None else held | F.array_contains(settled, value)

    def loose(p: Column) -> Column:
        return p["value"].isNotNull() & ~(fine(p["value"]) | (p["token"].contains("%") & fine(p["value"] / 100)))

    return F.get(F.filter(parsed, loose), F.lit(0))["token"]


def unescaped_dollars(text: Column) -> Column:
    """``n, lines``: how many bare dollar signs there are and on which lines, from 1."""
    lines = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct((i + 1).alias("line"), F.regexp_count(line, F.lit(r"(?<!\\)\$")).alias("n")))
    bare = F.filter(lines, lambda x: x["n"] > 0)
    return F.struct(F.aggregate(bare, F.lit(0), lambda a, x: a + x["n"]).alias("n"), F.transform(bare, lambda x: x["line"]).alias("lines"))


def escape_currency(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<!\\)\$", r"\\\$")


def has_financial_figure(text: Column) -> Column:
    return text.rlike(f"(?iU){FINANCIAL_FIGURE}")


def has_universal_quantifier(text: Column) -> Column:
    return text.rlike(f"(?iU){UNIVERSAL}")


def sample_ids(ids: Column, n: int = 10) -> Column:
    """The first ids, and how many more there are."""
    more = F.size(ids) - n
    shown = F.array_join(F.slice(ids, 1, n), ", ")
    return F.when(more > 0, F.concat(shown, F.lit(" and "), more.cast("string"), F.lit(" more"))).otherwise(shown)


def window_around(text: Column, quote: Column, budget: int) -> Column:
    """``text, note, quote_offset, start, end``: the folded text whole if it fits, else ``budget``
    characters centred on the quote's first place (with its offset and the window's bounds), or the
    text's head if the quote is absent."""
    folded, wanted = normalize_whitespace(text), normalize_whitespace(quote)
    place = F.instr(folded, wanted) - 1
    half = F.greatest(F.lit(0), F.floor((F.lit(budget) - F.length(wanted)) / 2)).cast("int")
    end = F.least(F.length(folded), F.greatest(F.lit(0), place - half) + budget)
    start = F.greatest(F.lit(0), end - budget)
    none = F.lit(None).cast("int")

    def told(part: Column, note: str | None, *at: Column) -> Column:
        return F.struct(part.alias("text"), F.lit(note).cast("string").alias("note"), *[c.alias(n) for c, n in zip(at or (none,) * 3, ("quote_offset", "start", "end"))])

    return (
        F.when(F.length(folded) <= budget, told(folded, None))
        .when((place >= 0) & (wanted != ""), told(F.substr(folded, start + 1, F.lit(budget)), "windowed", place, start, end))
        .otherwise(told(F.substr(folded, F.lit(1), F.lit(budget)), "quote not found; head only"))
    )


def sha256_hex(data: Column) -> Column:
    return F.sha2(data, 256)


def event_cutoff(text: Column) -> Column:
    """The date that a text begins with, or null; both written forms of ISO dates count."""
    head = F.substr(text, F.lit(1), F.lit(10))
    return F.coalesce(F.try_to_date(head, "yyyy-MM-dd"), F.try_to_date(head, "yyyyMMdd"))


def temporal_status(published: Column, cutoff: Column) -> Column:
    """unchecked without cutoff, undated without a date, post_event after it, else pre_event."""
    date = event_cutoff(published)
    return F.when(cutoff.isNull(), "unchecked").when(date.isNull(), "undated").when(date > cutoff, "post_event").otherwise("pre_event")


def period_type(start: Column, end: Column) -> Column:
    """Kind of reporting period by its days; null without both dates."""
    return let(F.datediff(end, start), period_kind)


def period_kind(days: Column) -> Column:
    return F.when(days.isNull(), None).when(days.between(80, 100), "quarter").when(days.between(170, 190), "half_year").when(days.between(260, 280), "nine_months").when(days.between(355, 375), "full_year").otherwise("other")
