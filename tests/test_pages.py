"""Pages whose character references are cut, bare, numbered or unknown: query and SQL read them alike."""

import duckdb
import pytest

from groundcheck.plans import checks, registry  # noqa: F401

BODIES = [
    "<title>and&amp</title><p>x</p>", "<title>&am</title>&a<b>mp;</b>", "&lt &gt; &quot&copy2026 &middotx &ampx &amp;lt; &amp;amp;", "&notit; &notin; &hellip; &hellip &unknown; & &; &&amp;",
    "&#65;&#66 &#x43; &#X44 &#0; &#128;&#x9f; &#xD800; &#1114112; &#99999999999999999999999; &#x1; &#xfffe; &#xffffffffffffffffffff;", "<p>&#32;&#10;</p><p>&#9;</p><p>&#1;</p><p>&nbsp;</p>", "zero&#8203;width&shy;&zwnj;", "it&apos;s &fjlig; &NotEqualTilde;", "", "no references", None,
]


@pytest.mark.parametrize("bodies", [BODIES, ["none", None]])
@pytest.mark.parametrize("name", ["sanitized_pages", "page_texts"])
def test_references_in_pages(spark, tmp_path, name, bodies):
    spark.createDataFrame(list(enumerate(bodies)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    found = registry.QUERIES[name](spark, str(tmp_path))
    told = duck.execute(f"SELECT {', '.join(found.columns)} FROM ({registry.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(told)


def test_all_findings_of_a_page_count(spark, tmp_path):
    bodies = ["<p>jailbreak</p> system prompt, " * n for n in (0, 1, 250, 251, 700)]
    spark.createDataFrame(list(enumerate(bodies)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    found = {r.page_id: r.findings for r in registry.QUERIES["sanitized_pages"](spark, str(tmp_path)).collect()}
    assert found == dict(duck.execute(f"SELECT page_id, findings FROM ({registry.ORACLES['sanitized_pages']})").fetchall())
    assert [found[i] for i in range(5)] == [0, 2, 500, 502, 1400]
