import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from groundcheck.llm import langid, queries, simhash
from groundcheck.llm.common import fold
from tests.llm.test_decontam import brute_contamination
from tests.llm.test_simhash import brute_components


def accepted(model, text):
    """A plain reading of the language stage: letters, dense counts, the best family's margin."""
    if not any(c.isalpha() for c in text or ""):
        return False
    fold_byte = lambda b: 32 if b < 97 or 122 < b < 128 else b
    data = [fold_byte(b + 32 if 65 <= b <= 90 else b) for b in text.encode()]
    counts = {}
    for order in (2, 3, 4):
        for i in range(len(data) - order + 1):
            gram = int.from_bytes(bytes(data[i : i + order]), "big")
            key = ((gram ^ (order * 0x1F123BB5 & 0xFFFFFFFF)) * 0x9E3779B1 & 0xFFFFFFFF) >> 16
            counts[key] = counts.get(key, 0) + 1
    total = sum(counts.values())
    nf = len(model.families)
    margins = [float(model.weights[-1][f]) + sum((n / total) ** 0.5 * float(model.weights[k][f]) for k, n in counts.items()) for f in range(nf)]
    return max(margins) >= 0.1


def test_language_stage_rejects_other_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = ["Привет мир, это русский текст о погоде", "中文文本在这里没有空格", "kissa istuu puussa ja katselee lintuja koko päivän", "12 34 — ½ ①", "", None]
    more = docs.limit(1).select(F.explode(F.array(*[F.struct((F.lit(10**9) + i).alias("i"), F.lit(t).cast("string").alias("t")) for i, t in enumerate(strange)])).alias("s"), "lang", "source", "n_chars")
    both = docs.unionByName(more.select(F.col("s.i").cast("long").alias("doc_id"), F.col("s.t").alias("text"), F.lit(None).cast("string").alias("lang"), "source", "n_chars"))
    kept = {r.doc_id for r in corpus_pipeline.drop_undetermined(spark, both, "").select("doc_id").collect()}
    assert not any(i >= 10**9 for i in kept) and len(kept) >= 0.99 * docs.count()


def test_edge_rows(spark, tmp_path):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names, empty tables."""
    source = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    base = docs.where("doc_id % 9 = 0").selectExpr("*", "1 as id", "'x' as row", "2 as component", "'t' as words", "3 as _id")
    some = base.where("length(text) > 300 and lang = 'en'").orderBy("doc_id").limit(3)
    odd = some.limit(1).selectExpr("cast(null as long) as doc_id", "cast(null as string) as text", "cast(null as string) as lang", "cast(null as string) as source", "n_chars", "id", "row", "component", "words", "_id")
    long = some.limit(1).withColumns({"doc_id": F.lit(10**9), "text": F.repeat(F.substring("text", 1, 250), F.lit(1000))})
    nameless = some.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.concat(F.reverse("text"), F.lit(" the and of")), "lang": F.lit(None).cast("string")})
    rows = base.unionByName(some).unionByName(odd).unionByName(long).unionByName(nameless)
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        t = spark.read.parquet(f"{source}/{name}.parquet")
        t.unionByName(t.limit(1).select(*[F.lit(None).cast(k).alias(c) for c, k in t.dtypes])).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.round_trip for r in out) and len({r.doc_id for r in out}) == len(out)
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, kept.limit(0), str(tmp_path))
        assert none.count() == 0 and (name == "sentencepiece" or none.columns == kept.columns), name


def test_near_duplicates_stage_broadcasts_no_bucket_entries(spark, small_dir, monkeypatch):
    seen, components = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda edges: seen.append(edges) or components(edges))
    corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{small_dir}/documents.parquet"), small_dir).collect()
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stages_against_plain_versions(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    lib = sentencepiece.SentencePieceProcessor(model_file=f"{queries.TOKENIZERS}/{queries.PIECES}")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        out = corpus_pipeline.stored(stage(spark, docs, sf), f"test-{name}")
        if name != "sentencepiece":
            assert out.columns == docs.columns
        seen[name] = (before, [r.asDict() for r in out.collect()])
        docs = out
    ids = {name: ({r["doc_id"] for r in a}, {r["doc_id"] for r in b}) for name, (a, b) in seen.items()}
    scored = {r.doc_id: r.predicted for r in queries.QUERIES["op6_toxicity"](spark, sf).collect()}
    assert ids["toxicity"][1] == {i for i in ids["toxicity"][0] if not scored[i]}
    kept = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in seen["language_id"][0]], "doc_id long, text string, lang string")
    model = langid.train(kept.where(fold(F.col("doc_id"), 4) != 2))
    assert ids["language_id"][1] == {r["doc_id"] for r in seen["language_id"][0] if accepted(model, r["text"])}
    groups = brute_components([(r["doc_id"], r["text"]) for r in seen["simhash_near_dedup"][0]])
    assert ids["simhash_near_dedup"][1] == {i for i, (_, c) in groups.items() if i == c}
    dirty = brute_contamination([(r["doc_id"], r["text"]) for r in seen["decontamination"][0]], items)
    assert ids["decontamination"][1] == {i for i, r in dirty.items() if not r[-1]}
    for r in seen["sentencepiece"][1]:
        text = next(x["text"] for x in seen["sentencepiece"][0] if x["doc_id"] == r["doc_id"])
        assert r["ids"] == lib.encode(text) and r["round_trip"] and r["n_pieces"] == len(r["ids"])
    assert 0 < len(seen["sentencepiece"][1]) < len(seen["toxicity"][0])
