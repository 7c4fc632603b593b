"""Document functions: HTML to text, injection scan, vendor layout.

Only HTML leaves the JVM: an Arrow-batched function with the standard library's parser.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from groundcheck.functions.text import let, normalize_whitespace, strip_invisible
from groundcheck.operators import segments

# They must be just these for right results.
INJECTION_PATTERNS = [
    "ignore (all |the |any |your )*(previous|prior|above|preceding|earlier) (instructions|prompts|context|messages)",
    "disregard (all |the |any |your )*(previous|prior|above|preceding|earlier)",
    "forget (all |everything |the )*(previous|prior|above|earlier|you were told)",
    "override (all |the |your )*(previous|prior|above|system) (instructions|prompt|rules)",
    "new instructions?:",
    "updated instructions?:",
    "system prompt",
    "reveal (your |the )*(system )?(prompt|instructions)",
    "print (your |the )*(system )?(prompt|instructions)",
    "repeat (your |the )*(system )?(prompt|instructions)",
    "you are now (in )?(developer|dev|debug|admin|god|dan) mode",
    "developer mode enabled",
    "enable (developer|dev|debug|jailbreak) mode",
    "jailbreak",
    "do anything now",
    "\\bdan\\b prompt",
    "act as (an? )?(unrestricted|uncensored|unfiltered)",
    "pretend (you are|to be) (an? )?(unrestricted|different|jailbroken)",
    "you must (now )?(obey|comply|follow) ",
    "from now on,? you",
    "bypass (your |the )*(safety|content|security) (filter|policy|guidelines|guardrails)",
    "ignore (your |the )*(safety|content|security) (filter|policy|guidelines|guardrails)",
    "\\b(system|assistant|user)\\s*:\\s*you",
    "<\\|?(system|im_start|endoftext)\\|?>",
    "end of (transcript|document)\\.? (now|then) (ignore|disregard|follow)",
]
BANNERS = [r"FINAL TRANSCRIPT\s*$", r"Copyright ©.*$", r"\d{1,4}\s*$"]
MOST_FINDINGS = 500  # of an advisory report, as the feature states; queries ask for all


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.node: list[str] = []
        self.hidden = self.kept = 0

    def end_node(self) -> None:
        """A text node ends at a tag, comment or declaration, not where the parser happens to pause.
        White space alone is one blank or line feed, outside ``pre`` and ``textarea``."""
        text, self.node = "".join(self.node), []
        if text and not text.strip(" \n\t\f\r") and not self.kept:
            text = "\n" if "\n" in text else " "
        if text:
            self.parts.append(text)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.end_node()
        self.hidden += tag in ("script", "style")
        self.kept += tag in ("pre", "textarea")

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.end_node()

    def handle_endtag(self, tag: str) -> None:
        self.end_node()
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1
        if tag in ("pre", "textarea") and self.kept:
            self.kept -= 1

    def handle_comment(self, data: str) -> None:
        self.end_node()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data: str) -> None:
        self.end_node()
        if data.upper().startswith("CDATA[") and not self.hidden:
            self.parts.append(data[6:])

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.node.append(data)


@F.pandas_udf(StringType())
def html_to_text(html: pd.Series) -> pd.Series:
    """Text nodes of a page, one to a line; scripts, styles and comments go."""

    def one(page: str | None) -> str | None:
        if page is None:
            return None
        parser = _Text()
        parser.feed(page)
        parser.close()
        parser.end_node()
        return "\n".join(parser.parts)

    return html.map(one, na_action="ignore")


def sanitize(text: Column, is_html: bool) -> Column:
    """Text of a page or transcript without invisible characters; line breaks stay."""
    return strip_invisible(html_to_text(text) if is_html else text)


def compiles(pattern: str) -> bool:
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True


def scan_for_injection(text: Column, patterns: list[str] | None = None, most: int | None = MOST_FINDINGS) -> Column:
    """``pattern, match, context`` of the first ``most`` matches of all patterns (None: of all matches),
    in their order, with 40 characters on either side; patterns that don't compile are passed over.
    Contexts come from the text's pieces next to a match, so that the JVM's own functions serve and
    many matches cost no more than in proportion."""

    def of(pattern: str) -> Column:
        none = F.array(F.lit(""))

        def found(ms: Column) -> Column:
            # A first match without characters has no piece before it.
            parts = let(F.split(text, f"(?iU){pattern}", -1), lambda ps: F.when(F.size(ps) > F.size(ms), ps).otherwise(F.concat(none, ps)))
            return F.when(F.size(ms) > 0, let(parts, lambda ps: contexts(ms, ps)))

        def contexts(ms: Column, ps: Column) -> Column:
            # Each match with the piece behind it, one character at least: forty reach over a context's side.
            steps = F.zip_with(F.concat(none, ms), ps, lambda m, p: F.concat(m, p))
            heads, tails = F.transform(steps, lambda s: F.substring(s, 1, 40)), F.transform(steps, lambda s: F.right(s, F.lit(40)))
            return let(F.struct(heads.alias("heads"), tails.alias("tails")), lambda ends: F.transform(listed_of(ms), lambda m, i: finding(ps, ends, m, i)))

        def finding(ps: Column, ends: Column, m: Column, i: Column) -> Column:
            begin = F.greatest(i - 39, F.lit(0))
            before = F.right(F.array_join(F.slice(ends["tails"], begin + 1, i - begin + 1), ""), F.lit(40))
            after = F.substring(F.concat(F.substring(F.get(ps, i + 1), 1, 40), F.array_join(F.slice(ends["heads"], i + 3, F.lit(40)), "")), 1, 40)
            return F.struct(F.lit(pattern).alias("pattern"), m.alias("match"), normalize_whitespace(F.concat(before, m, after)).alias("context"))

        return let(F.regexp_extract_all(text, F.lit(f"(?iU){pattern}"), 0), found)

    def listed_of(findings: Column) -> Column:
        return findings if most is None else F.slice(findings, 1, most)

    listed = [p for p in (INJECTION_PATTERNS if patterns is None else patterns) if compiles(p)]
    none = F.array().cast("array<struct<pattern:string,match:string,context:string>>")
    return listed_of(F.concat(none, *[F.coalesce(of(p), none) for p in listed]))


def injection_counts(texts: DataFrame, key: str, text: str, patterns: list[str] | None = None) -> DataFrame:
    """``key, pattern, n`` without leaving the JVM: only counts are wanted."""
    listed = INJECTION_PATTERNS if patterns is None else patterns
    pairs = F.array(*[F.struct(F.lit(p).alias("pattern"), F.regexp_count(F.col(text), F.lit(f"(?iU){p}")).alias("n")) for p in listed])
    return texts.select(key, F.explode(F.filter(pairs, lambda x: x["n"] > 0)).alias("p")).select(key, "p.pattern", "p.n")


# --- vendor layout ---------------------------------------------------------------------------


def _is_name(line: Column) -> Column:
    word = segments.NAME_WORD
    return line.rlike(rf"(?U)^{word}(?:\s+{word}){{0,4}}$") & segments.valid_name(line)


def _is_title(line: Column) -> Column:
    words = F.filter(F.split(normalize_whitespace(line), " "), lambda w: w != "")
    capital = F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}")))
    return (F.size(words) > 0) & (F.length(line) < 150) & ~line.rlike("[?!]$") & (capital >= F.floor((F.size(words) + 1) / 2))


def reformat_vendor_layout(docs: DataFrame, key: str, text: str = "text", banners: list[str] | None = None, rule: str = r"[.]{10,}\s*$") -> DataFrame:
    """``key, text``: after the start or a dotted rule, a name line and a title line, if one follows,
    become one speaker line; rules and blank lines go. A banner (page number, copyright line) goes
    where nothing or the end of a sentence stands before it; else it may be a wrapped figure.

    Windows over a document's lines. Whether a name opens a turn depends on what stands before its
    rule only if banners lie between; such a name shares the fate of the name before it, so that the
    last name that is settled by itself decides. A null text gives null."""
    line = F.regexp_replace("raw", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    rows = docs.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("n", "raw")).select(key, "n", line.alias("line"))
    whole = Window.partitionBy(key).orderBy("n")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    banner = F.lit(False)
    for pattern in BANNERS if banners is None else banners:
        banner = banner | F.col("line").rlike(f"(?U)^(?:{pattern})")
    rows = rows.withColumns({"rule": F.col("line").rlike(f"^{rule}"), "ends": F.col("line").rlike(r"[.?!:]\s*$"), "titled": _is_title(F.col("line"))})
    rows = rows.withColumn("banner", (F.col("line") != "") & ~F.col("rule") & banner).withColumn("said", (F.col("line") != "") & ~F.col("rule") & ~F.col("banner"))
    place = lambda c: F.max(F.when(c, F.col("n"))).over(before)
    rows = rows.withColumns({"last_said": place(F.col("said")), "last_rule": place(F.col("rule")), "last_banner": place(F.col("banner")), "last_end": place(F.col("banner") & F.col("ends"))})
    fresh = F.col("last_said").isNull() | F.coalesce(F.col("last_rule") > F.col("last_said"), F.lit(False))
    rows = rows.withColumn("opening", F.col("said") & fresh & _is_name(F.col("line")))
    latest = lambda c: F.last(F.when(F.col("said"), c), ignorenulls=True).over(before)
    rows = rows.withColumn("tied", F.col("opening") | (F.coalesce(F.lag("opening").over(whole), F.lit(False)) & F.col("titled")))
    rows = rows.withColumns({"end_at_rule": F.last(F.when(F.col("rule"), F.coalesce("last_end", F.lit(-1))), ignorenulls=True).over(before), "said_ends": latest(F.col("ends")), "said_tied": latest(F.col("tied"))})
    clear = F.coalesce(F.col("last_banner") <= F.coalesce("last_rule", F.lit(-1)), F.lit(True)) | F.col("last_said").isNull() | F.coalesce(F.col("end_at_rule") > F.col("last_said"), F.lit(False)) | F.col("said_ends")
    settled = F.when(F.col("opening") & clear, True).when(F.col("opening") & ~F.col("said_tied"), False)
    rows = rows.withColumn("settled", settled)
    rows = rows.withColumn("header", F.col("opening") & F.last("settled", ignorenulls=True).over(whole.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("title", F.coalesce(F.lag("header").over(whole), F.lit(False)) & F.col("titled"))
    closed = latest(F.col("ends") | F.col("header") | F.col("title"))
    rows = rows.withColumns({"closed": closed, "next_line": F.lead("line").over(whole), "next_title": F.coalesce(F.lead("title").over(whole), F.lit(False))})
    stays = F.col("banner") & F.col("last_said").isNotNull() & ~F.col("closed") & ~F.coalesce(F.col("last_end") > F.col("last_said"), F.lit(False))
    told = F.when(F.col("header") & F.col("next_title"), F.concat("line", F.lit(" — "), "next_line", F.lit(":"))).when(F.col("header"), F.concat("line", F.lit(":"))).otherwise(F.col("line"))
    kept = rows.where(~F.col("title") & (F.col("said") | stays)).select(key, "n", told.alias("line")).groupBy(key)
    laid = kept.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("laid"))
    return docs.select(key, F.col(text).alias("whole")).join(laid, key, "left").select(key, F.when(F.col("whole").isNotNull(), F.coalesce("laid", F.lit(""))).alias("text"))
