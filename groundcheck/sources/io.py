"""Readers and sinks of a run tree: ``<runs>/<ticker>/<event>/<stage>/<file>``, flat or staged.

Readers take the path of a tree, or its files as rows (path, content, length) of ``packed``: a tree is
listed by the driver, file by file, so that millions of small files are landed as rows of few large ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

RUN_PATH = r".*/([^/]+)/([^/]+)/"

SEGMENT = "id string, section string, speaker string, text string"
WEB = "id string, url string, title string, publisher string, published_at string, temporal_status string, retrieved_at string, content_path string, content_sha256 string"
CLAIM = "id string, category string, classification string, claim_text string, quote string, segment_id string, web_evidence_id string, speaker string, status string, values string, confidence double, inferred_from array<string>, period string, caveats array<string>, _corrupt_record string"
METRIC = "name string, value double, unit string, period string, source string, definition string, source_claim_ids array<string>, _corrupt_record string"
HIT = "url string, title string, score double, published_date string, publishedDate string, _class string, _select_key string, _temporal_status string, _provider string, _query string, _retrieved_at string"
FACTS = "map<string,struct<units:map<string,array<struct<start:string,end:string,val:double,accn:string,fy:int,fp:string,form:string,filed:string>>>>>"
MOST_BYTES = 10 * 1024 * 1024
STAGES = ("raw", "evidence", "claims", "analysis", "outlook", "review")


#: Stage folder of an artifact in a staged run; every other file lies at the run's root.
STAGE_OF = {
    "claims.json": "claims",
    "coverage-receipt.json": "claims",
    "metrics.json": "claims",
    "validation.json": "claims",
    "signal-card.md": "claims",
    "outlook-brief.md": "outlook",
    "outlook-validation.json": "outlook",
    "review-report.json": "review",
    "review-report.md": "review",
    "review-diff.json": "review",
    "review-diff.sha256": "review",
}


def placed(path: Column) -> Column:
    """``ticker, event_id, stage, name`` of a file from its place: ``<ticker>/<event>/<stage>/.../<name>``,
    flat ``<ticker>/<event>/<name>``, or as Spark lands it, in folders that name their key
    (``ticker=.../event_id=.../stage=.../name=.../part-...``)."""
    keyed = r"ticker=([^/]*)/event_id=([^/]*)/(?:stage=([^/]+)/)?name=([^/]+)/[^/]+$"
    staged = rf"([^/]+)/([^/]+)/({'|'.join(STAGES)})/(?:.*/)?([^/]+)$"
    flat = r"([^/]+)/([^/]+)/([^/]+)$"

    def pick(i: int, j: int) -> Column:
        at_root = F.regexp_extract(path, flat, j) if j else F.lit("flat")
        return F.when(path.rlike(keyed), F.url_decode(F.regexp_extract(path, keyed, i))).when(path.rlike(staged), F.regexp_extract(path, staged, i)).otherwise(at_root)

    stage = pick(3, 0)
    return F.struct(pick(1, 1).alias("ticker"), pick(2, 2).alias("event_id"), F.when(stage == "", "flat").otherwise(stage).alias("stage"), pick(4, 3).alias("name"))


def with_run(df: DataFrame, depth: int = 1) -> DataFrame:
    """``ticker, event_id, run_id`` from the file's place; ``depth`` folders lie below the event, or
    folders name their key."""
    below = "[^/]+/" * depth if depth else ""
    pattern = rf"([^/]+)/([^/]+)/{below}[^/]+$"
    path, keyed = F.col("_path"), F.col("_path").rlike(r"ticker=[^/]*/event_id=[^/]*/")
    own = placed(path)
    named = df.withColumns({"ticker": F.when(keyed, own["ticker"]).otherwise(F.regexp_extract(path, pattern, 1)), "event_id": F.when(keyed, own["event_id"]).otherwise(F.regexp_extract(path, pattern, 2))})
    return named.withColumn("run_id", F.concat_ws("/", "ticker", "event_id"))


def pack(files: DataFrame, path: str) -> None:
    """Writes whole files (ticker, event_id, stage, name, content) as rows of a table, under the paths that
    ``placed`` reads. The table is not compressed, so that tasks that read it have equal bytes of content."""
    key = lambda c: F.concat(F.lit(f"{c}="), F.url_encode(c))
    placed_at = F.concat_ws("/", *[key(c) for c in ("ticker", "event_id", "stage", "name")], F.lit("whole"))
    files.select(placed_at.alias("path"), "content").write.option("compression", "none").parquet(path)


def packed(spark: SparkSession, path: str) -> DataFrame:
    """``path, content, length`` of packed files."""
    return spark.read.schema("path string, content binary").parquet(path).withColumn("length", F.octet_length("content").cast("long"))


def contents(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """``path, content, length`` of the files of a tree, or of files given as such rows."""
    if isinstance(source, DataFrame):
        return source.select("path", "content", "length")
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path", "content", "length")


def run_tree(spark: SparkSession, runs: str) -> DataFrame:
    """``ticker, event_id, stage, name, path, bytes`` of all artifacts in either layout."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(runs).select("path", F.col("length").alias("bytes"))
    return files.select(placed(F.col("path")).alias("p"), "path", "bytes").select("p.*", "path", "bytes")


def layouts(manifests: DataFrame) -> DataFrame:
    """``run_id, layout`` of manifests (run_id, text): 1 flat or 2 staged as declared, flat if the
    manifest doesn't parse or names neither."""
    found = F.try_variant_get(F.try_parse_json("text"), "$.layout_version", "int")
    whole = F.schema_of_variant(F.try_variant_get(F.try_parse_json("text"), "$.layout_version", "variant")) == "BIGINT"
    return manifests.groupBy("run_id").agg(F.max(F.when(whole & found.isin(1, 2), found)).alias("layout")).withColumn("layout", F.coalesce("layout", F.lit(1)))


def current_artifacts(tree: DataFrame, layout: DataFrame) -> DataFrame:
    """Files of the tree that lie where their run's layout puts them. A run without a manifest is flat."""
    rows = tree.withColumn("run_id", F.concat_ws("/", "ticker", "event_id")).join(layout, "run_id", "left")
    stage = F.lit(None).cast("string")
    for name, folder in STAGE_OF.items():
        stage = F.when(F.col("name") == name, folder).otherwise(stage)
    shared = F.col("stage").isin("raw", "evidence")
    expected = F.when(shared, F.col("stage")).when(F.coalesce("layout", F.lit(1)) == 2, F.coalesce(stage, F.lit("flat"))).otherwise("flat")
    return rows.where(F.col("stage") == expected)


def whole_texts(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """``path, text, bytes`` of files, read byte for byte; what is no UTF-8 is replaced. (The text source
    drops line breaks at the end of a whole file.)"""
    files = contents(spark, path)
    text = F.coalesce(F.expr("try_validate_utf8(cast(content as string))"), F.expr("make_valid_utf8(cast(content as string))"))
    return files.select("path", text.alias("text"), F.col("length").alias("bytes"))


def transcripts(spark: SparkSession, path: str | DataFrame, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, DataFrame]:
    """Accepted transcripts (path, is_html, text, byte_length) and rejected files with a reason. A
    file above the limit is rejected, never cut."""
    files = contents(spark, path)
    suffix = F.lower(F.regexp_extract(placed(F.col("path"))["name"], r"\.([^./]+)$", 1))
    reason = F.when(~suffix.isin("txt", "md", "html", "htm"), "unsupported suffix").when(F.col("length") > most_bytes, "too large")
    marked = files.withColumn("reason", reason)
    accepted = marked.where("reason is null").select("path", suffix.isin("html", "htm").alias("is_html"), F.expr("try_validate_utf8(cast(content as string))").alias("text"), F.col("length").alias("byte_length"), "content")
    lenient = F.coalesce("text", F.expr("make_valid_utf8(cast(content as string))"))
    return accepted.withColumn("text", lenient).drop("content"), marked.where("reason is not null").select("path", "length", "reason")


def json_lines(spark: SparkSession, path: str, schema: str, depth: int = 1) -> DataFrame:
    return with_run(spark.read.schema(schema).json(path).withColumn("_path", F.col("_metadata.file_path")), depth).drop("_path")


def json_files(spark: SparkSession, path: str | DataFrame, schema: str) -> DataFrame:
    """Records of JSON files, each an array or one object, with their file's ``_path``. What does not parse
    gives a row, with its text in ``_corrupt_record`` if the schema has that; blank files give none.
    JSON taken as a string has its own text from a tree, and is written anew (``1.50`` as ``1.5``) from rows."""
    if not isinstance(path, DataFrame):
        rows = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
        return rows.withColumn("_path", F.col("_metadata.file_path"))
    valid = F.expr("try_validate_utf8(cast(content as string))")
    texts = contents(spark, path).select(F.col("path").alias("_path"), valid.alias("text"), F.expr("make_valid_utf8(cast(content as string))").alias("given")).where(F.col("given").rlike(r"\S"))
    # Records one by one: within an array, from_json would not tell of a value of another type.
    each = F.when(F.col("text").rlike(r"^\s*\["), F.from_json("text", ArrayType(StringType()))).when(F.col("text").isNotNull(), F.array("text"))
    found = texts.select("_path", F.when(each.isNull(), F.col("given")).alias("torn"), F.explode(F.coalesce(each, F.array(F.lit(None).cast("string")))).alias("one"))
    fields = StructType.fromDDL(schema)
    kept = fields if "_corrupt_record" in fields.names else StructType(list(fields.fields)).add("_corrupt_record", "string")
    rows = found.withColumn("r", F.from_json("one", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    told = lambda c: F.coalesce("torn", "r._corrupt_record") if c == "_corrupt_record" else F.col(f"r.{c}")
    return rows.select(*[told(c).alias(c) for c in fields.names], "_path")


def json_array(spark: SparkSession, path: str | DataFrame, schema: str, depth: int = 1) -> DataFrame:
    """Records of JSON arrays; what does not parse is kept in ``_corrupt_record`` for that run."""
    return with_run(json_files(spark, path, schema), depth).drop("_path")


def schema_issues(records: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """A run with a file that did not parse, or with a record that lacks a ``required`` field, fails
    with one issue."""
    bad = F.col("_corrupt_record").isNotNull()
    for c in required:
        bad = bad | F.col(c).isNull()
    return records.where(bad).select("run_id").distinct().select("run_id", F.lit(-1).alias("claim_index"), F.lit("schema").alias("check"), F.lit("file does not parse").alias("message"))


def quarantine(records: DataFrame, required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Records of the runs all of whose files parse, and an issue for each other run: one unreadable
    file fails its own run and no other. Give stored or cached records: they are read twice."""
    issues = schema_issues(records, required)
    return records.join(issues.select("run_id"), "run_id", "left_anti").drop("_corrupt_record"), issues


def web_evidence(spark: SparkSession, index: str, content: str | DataFrame, depth: int = 1) -> DataFrame:
    """Index rows joined to their pages' text by content path."""
    rows = json_lines(spark, index, WEB, depth)
    texts = whole_texts(spark, content).select(F.col("path").alias("_path"), F.col("text").alias("content"))
    landed = placed(F.col("_path"))
    whole = F.concat_ws("/", landed["ticker"], landed["event_id"], landed["stage"], landed["name"])
    tail = F.when(F.col("_path").rlike(r"/name=[^/]+/"), whole).otherwise(F.regexp_extract("_path", r"([^/]+/[^/]+/[^/]+)$", 1))
    keyed = F.concat_ws("/", "run_id", "content_path")
    pages = rows.withColumn("tails", F.array_distinct(F.array(keyed, F.regexp_extract(keyed, r"([^/]+/[^/]+/[^/]+)$", 1)))).withColumn("_row", F.monotonically_increasing_id())
    # Paths are matched first, so that the texts are dealt out once.
    found = pages.select("_row", F.explode("tails").alias("tail")).join(texts.select("_path", tail.alias("tail")), "tail").groupBy("_row").agg(F.min("_path").alias("_path"))
    return pages.join(found, "_row", "left").join(texts, "_path", "left").drop("tails", "_row", "_path")


def search_hits(spark: SparkSession, path: str | DataFrame, depth: int = 2) -> DataFrame:
    """One hit to a file; the position comes from ``query-NN-hit-NN`` in its name."""
    rows = json_files(spark, path, HIT)
    name = r"query-(\d+)-hit-(\d+)"
    place = F.regexp_extract("_path", name, 1).try_cast("int") * 100_000 + F.regexp_extract("_path", name, 2).try_cast("int")
    named = {"_class": "class", "_select_key": "select_key", "_provider": "provider", "_query": "query", "_retrieved_at": "retrieved_at"}
    return with_run(rows, depth).withColumn("pos", place).withColumnsRenamed(named).drop("_path", "_temporal_status")


def company_facts(rows: DataFrame, json_col: str, key: str = "cik") -> DataFrame:
    """``key, concept, unit, unit_pos, entry_pos, start, end, val, form, fy, filed, accn`` of nested
    fact JSON: a payload with ``facts.us-gaap``, or that map from concept alone."""
    inner = F.coalesce(F.get_json_object(json_col, "$.facts['us-gaap']"), F.col(json_col))
    concepts = rows.select(key, F.explode(F.from_json(inner, FACTS)).alias("concept", "body"))
    units = concepts.select(key, "concept", F.posexplode(F.map_entries("body.units")).alias("unit_pos", "u"))
    return units.select(key, "concept", F.col("u.key").alias("unit"), "unit_pos", F.posexplode("u.value").alias("entry_pos", "e")).select(key, "concept", "unit", "unit_pos", "entry_pos", "e.start", "e.end", "e.val", "e.form", "e.fy", "e.filed", "e.accn")


def ticker_ids(payload: DataFrame, json_col: str = "value") -> DataFrame:
    """``ticker, cik`` of a map of listings; ids are padded to ten digits."""
    entries = payload.select(F.explode(F.from_json(json_col, "map<string,struct<cik_str:bigint,ticker:string,title:string>>")).alias("k", "v"))
    return entries.select(F.upper("v.ticker").alias("ticker"), F.format_string("%010d", "v.cik_str").alias("cik"))


def price_bars(payloads: DataFrame, json_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Bars (ticker, nth, date, open, high, low, close, volume; dates ascend) of payloads, and what came
    of each payload: ``ticker, shape, status, error, row_count, first, last, response_sha256``.

    The shape is told from the value itself: ``dated``, a map by date under "Time Series (Daily)" with
    numbered names; ``listed``, an array of rows under ``historical``; ``plain``, an array of rows. A
    body that is no JSON, a dated one without series but with a message, and an empty plain one are
    errors; other bodies without rows are empty series."""
    doc, text = F.col("_doc"), F.col(json_col)
    at = lambda path: F.try_variant_get(doc, path, "variant")
    message = F.coalesce(*[F.nullif(F.try_variant_get(doc, f'$["{k}"]', "string"), F.lit("")) for k in ("Error Message", "Note", "Information")])
    marked = payloads.select("ticker", text.alias("_text"), F.try_parse_json(text).alias("_doc")).withColumn("_id", F.monotonically_increasing_id())
    shape = F.when(at('$["Time Series (Daily)"]').isNotNull(), "dated").when(at("$.historical").isNotNull(), "listed").when(F.schema_of_variant(doc).startswith("ARRAY"), "plain").when(doc.isNotNull(), "none")
    marked = marked.select("_id", "ticker", "_text", "_doc", shape.alias("shape"), message.alias("message"))
    series = F.when(F.col("shape") == "dated", at('$["Time Series (Daily)"]')).when(F.col("shape") == "listed", at("$.historical")).when(F.col("shape") == "plain", doc)
    told = marked.select("_id", "ticker", "shape", series.alias("series"))
    rows = payloads.sparkSession.sql("SELECT _id, ticker, shape, e.key, e.value AS bar FROM {told}, LATERAL variant_explode(series) AS e", told=told)
    get = lambda name, kind: F.try_variant_get("bar", f'$["{name}"]', kind)

    def field(i: int, name: str) -> Column:
        return F.coalesce(get(f"{i}. {name}", "string"), get(name, "string"), get(name.title(), "string"))

    date = F.coalesce("key", get("date", "string"), get("Date", "string"))
    values = [field(i, n).try_cast("double").alias(n) for i, n in enumerate(("open", "high", "low", "close"), 1)]
    bars = rows.select("_id", "ticker", F.try_to_date(F.substr(date, F.lit(1), F.lit(10)), "yyyy-MM-dd").alias("date"), *values, field(5, "volume").try_cast("double").cast("bigint").alias("volume"))
    per = bars.groupBy("_id").agg(F.count(F.lit(1)).alias("row_count"), F.min("date").alias("first"), F.max("date").alias("last"))
    error = (
        F.when(F.col("shape").isNull(), "payload does not parse")
        .when(F.col("row_count").isNull() & F.col("shape").isin("dated", "none"), F.col("message"))
        .when(F.col("row_count").isNull() & (F.col("shape") == "plain"), "no data returned")
    )
    came = marked.join(per, "_id", "left").withColumn("error", error)
    came = came.select("ticker", "shape", F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"), "error", F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"), "first", "last", F.sha2("_text", 256).alias("response_sha256"))
    nth = F.row_number().over(Window.partitionBy("_id").orderBy("date"))
    return bars.select("ticker", nth.alias("nth"), "date", "open", "high", "low", "close", "volume"), came


def binary_sources(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    return contents(spark, path).select("path", "content", F.col("length").alias("byte_length"))


def append_log(df: DataFrame, path: str, by: list[str] | None = None, attempt: int | None = None) -> None:
    """Appends rows as JSON lines; earlier rows are never touched. ``attempt`` marks a batch that may
    be written again, by a repeated job or under a later number."""
    rows = df if attempt is None else df.withColumn("_attempt", F.lit(attempt))
    rows.write.mode("append").partitionBy(*(by or [])).json(path)


def read_log(spark: SparkSession, path: str, schema: str, keys: list[str]) -> DataFrame:
    """Rows of a log, of those with the same ``keys`` the one written last: by attempt, then by the
    time of its file, then by the file's name and the row itself. Lines that don't parse are kept with
    their text in ``_corrupt_record`` where the schema has that column."""
    found = spark.read.schema(f"{schema}, _attempt int").json(path)
    columns = [c for c in found.columns if c != "_attempt"]
    order = F.struct(F.coalesce("_attempt", F.lit(-1)), F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.to_json(F.struct(*columns)))
    rest = [c for c in columns if c not in keys]
    last = found.select(*columns, order.alias("_order")).groupBy(*keys).agg(F.max_by(F.struct(*rest), "_order").alias("_last"))
    return last.select(*keys, "_last.*").select(*columns)


def write_artifacts(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Artifacts by run, in folders of ticker and event; only the runs in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ticker", "event_id").format(kind).save(path)


def write_cards(lines: DataFrame, path: str, order: list[str], parts: int | None = None) -> None:
    """Cards as text, a folder for each run. ``lines``: ticker, event_id, line, and the columns of
    ``order``, by which a card's lines stand. Lines are dealt out in ranges of run and place, so that
    a long card fills several files, whose names keep the order, and none passes through one task."""
    place = ["ticker", "event_id", *order]
    dealt = lines.repartitionByRange(parts, *place) if parts else lines.repartitionByRange(*place)
    sorted_ = dealt.sortWithinPartitions(*place).select("ticker", "event_id", F.col("line").alias("value"))
    sorted_.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ticker", "event_id").text(path)


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    """``ticker, event_id, file, line_no, line`` of written cards; a card's lines stand by file and number."""
    at = lambda pattern: F.regexp_extract("path", pattern, 1)
    named = whole_texts(spark, path).where("bytes > 0").select(F.url_decode(at(r"ticker=([^/]+)/")).alias("ticker"), F.url_decode(at(r"event_id=([^/]+)/")).alias("event_id"), at(r"([^/]+)$").alias("file"), F.regexp_replace("text", r"\n\z", "").alias("text"))
    return named.select("ticker", "event_id", "file", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
