"""Transcript segmentation with windows: speakers, question sections, running groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundcheck.functions.text import normalize_whitespace

# They must be just these for right results.
QA_HEADINGS = ["q&a", "questions and answers", "question and answer session", "question-and-answer session"]
QA_TRANSITIONS = ["go to q&a", "move over to q&a", "open the line for q&a", "q&a session commences", "begin the question-and-answer session"]
PARTICLES = ["van", "der", "von", "de", "den", "del", "di", "af", "av", "le", "la"]
DENYLIST = ["forward.looking statements?", "safe harbor( statement)?", "non.gaap reconciliation", "important notice", "disclaimer", "legal notice", "cautionary statement"]

LETTER = r"[\p{L}\p{Nl}\p{No}]"
NAME_WORD = rf"{LETTER}(?:{LETTER}|['’.\-])*"
NAME = rf"{NAME_WORD}(?:\s+{NAME_WORD}){{0,9}}(?:\s+\d{{1,2}})?"
WITH_AFFILIATION = rf"(?U)^({NAME}),\s*([^:]{{1,100}}):\s*(.*)$"
WITH_TITLE = rf"(?U)^({NAME})(?:\s*[—–-]\s*([^:]{{0,80}}))?:\s*(.*)$"
SEPARATOR_LINE = r"(?m)^[.]{10,}\s*$"


def _words(c: Column) -> Column:
    return F.filter(F.split(normalize_whitespace(c), " "), lambda w: w != "")


def valid_name(name: Column) -> Column:
    """First word begins upper-case; each later one too, or is a number or a listed particle."""
    words = _words(name)
    later = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return (F.size(words) > 0) & F.get(words, F.lit(0)).rlike(r"^\p{Lu}") & F.forall(later, lambda w: w.rlike(r"(?U)^\p{Lu}|^\d+$") | F.lower(w).isin(*PARTICLES))


def detect_speaker(line: Column) -> Column:
    """``speaker, rest``; speaker is null where the line names none."""
    s = F.regexp_replace(line, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    first = s.rlike(WITH_AFFILIATION)
    second = s.rlike(WITH_TITLE)
    pick = lambda i, j: F.when(first, F.trim(F.regexp_extract(s, WITH_AFFILIATION, i))).when(second, F.trim(F.regexp_extract(s, WITH_TITLE, j)))
    name, rest = pick(1, 1), pick(3, 3)
    speaker = F.when(first, F.concat(name, F.lit(", "), F.trim(F.regexp_extract(s, WITH_AFFILIATION, 2)))).otherwise(name)
    metric = ~first & F.regexp_extract(s, WITH_TITLE, 2).rlike(r"(?U)[\d%$£€¥]")
    fine = (first | second) & ~metric & (F.size(_words(speaker)) <= 10) & (F.length(speaker) <= 100) & valid_name(name) & ~name.rlike("(?iU)^(?:" + "|".join(DENYLIST) + ")$")
    return F.when(F.coalesce(fine, F.lit(False)), F.struct(speaker.alias("speaker"), rest.alias("rest"))).otherwise(F.struct(F.lit(None).cast("string").alias("speaker"), line.alias("rest")))


def speaker_shaped(candidate: Column) -> Column:
    words = _words(candidate)
    capital = F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}")))
    return (F.size(words) > 0) & (F.size(words) <= 15) & (capital >= F.greatest(F.lit(1), F.floor(F.size(words) / 2)))


def _qa_text(line: Column) -> Column:
    return F.replace(F.replace(F.lower(normalize_whitespace(line)), F.lit("ß"), F.lit("ss")), F.lit("’"), F.lit("'"))


def is_qa_heading(line: Column) -> Column:
    return F.trim(F.regexp_replace(_qa_text(line), ":$", "")).isin(*QA_HEADINGS)


def has_qa_transition(line: Column) -> Column:
    text, found = _qa_text(line), F.lit(False)
    for phrase in QA_TRANSITIONS:
        found = found | text.contains(phrase)
    return found


def transcript_lines(transcripts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, line_no, line`` of all non-blank lines."""
    lines = transcripts.select(key, F.posexplode(F.split(F.regexp_replace(F.col(text), "\r\n?", "\n"), "\n", -1)).alias("line_no", "line"))
    return lines.where(normalize_whitespace(F.col("line")) != "")


def marked_lines(lines: DataFrame, key: str) -> DataFrame:
    """Lines with their speaker, heading and group; lines of a document by ``line_no``."""
    rows = lines.withColumns({"d": detect_speaker(F.col("line")), "heading": is_qa_heading(F.col("line")), "transition": has_qa_transition(F.col("line"))})
    rows = rows.withColumn("speaker", F.when(~F.col("heading"), F.col("d.speaker"))).withColumn("rest", F.col("d.rest"))
    whole = Window.partitionBy(key)
    order = whole.orderBy("line_no")
    rows = rows.withColumn("first_qa", F.min(F.when(F.col("heading") | F.col("transition"), F.col("line_no"))).over(whole))
    starts = F.col("speaker").isNotNull() | F.coalesce(F.lag("line_no").over(order) == F.col("first_qa"), F.lit(False))
    return rows.withColumn("grp", F.sum(F.when(starts, 1).otherwise(0)).over(order)).drop("d", "transition")


def segments(lines: DataFrame, key: str) -> DataFrame:
    """``key, id, seq, section, speaker, text``: the runs of lines that one speaker holds."""
    rows = marked_lines(lines, key).where(~F.col("heading"))
    content = F.when(F.col("speaker").isNotNull(), F.col("rest")).otherwise(F.col("line"))
    groups = rows.groupBy(key, "grp").agg(
        F.min("line_no").alias("at"),
        F.min("first_qa").alias("first_qa"),
        F.min_by("speaker", "line_no").alias("speaker"),
        F.array_sort(F.collect_list(F.struct("line_no", content.alias("c")))).alias("cs"),
    )
    joined = groups.withColumn("text", normalize_whitespace(F.array_join(F.transform("cs", lambda x: x["c"]), " "))).where("text <> ''")
    seq = F.row_number().over(Window.partitionBy(key).orderBy("at"))
    section = F.when(F.col("at") > F.col("first_qa"), "qa").otherwise("prepared")
    return joined.withColumn("seq", seq).select(key, F.format_string("seg-%04d", "seq").alias("id"), "seq", section.alias("section"), "speaker", "text")


def omissions(lines: DataFrame, key: str) -> DataFrame:
    return lines.where(is_qa_heading(F.col("line"))).select(key, "line_no", "line")


def near_misses(lines: DataFrame, key: str) -> DataFrame:
    """Lines that end in a colon and look like a speaker but are none."""
    line = normalize_whitespace(F.col("line"))
    return lines.where(detect_speaker(F.col("line"))["speaker"].isNull() & ~is_qa_heading(F.col("line")) & line.endswith(":") & speaker_shaped(F.regexp_replace(line, ":$", ""))).select(key, "line_no", "line")


def speakerless(lines: DataFrame, key: str) -> DataFrame:
    """Documents without any speaker: a converted source that must be rejected."""
    named = detect_speaker(F.col("line"))["speaker"].isNotNull() & ~is_qa_heading(F.col("line"))
    return lines.groupBy(key).agg(F.bool_or(named).alias("named")).where(~F.col("named")).select(key)


def vendor_layout(text: Column) -> Column:
    """Whether dotted rules part the text at least twice."""
    return F.regexp_count(text, F.lit(SEPARATOR_LINE)) >= 2


def preceding_turns(turns: DataFrame, key: str, order: str, value: str, n: int = 2) -> DataFrame:
    """Every turn with up to ``n`` turns before it, oldest first."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-n, -1)
    return turns.withColumn("context", F.collect_list(value).over(w))
