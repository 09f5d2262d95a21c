"""Every registered query on empty tables, and on tables of nulls, repeats and columns with clashing names."""

import pytest

from clickloom.llm.queries import QUERIES

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}
#: Names that operators use inside, as further columns of every table.
CLASHING = "key string, fp long, rep long, pos int, line string, words string, hashes string, host string, n long, held string, block string, component_id long, _stats string"
ROWS = {
    "documents": [(1, "One line of the text that stands here twice.\nshort", "en", "a", 1), (1, "One line of the text that stands here twice.\nshort", "en", "a", 1), (2, None, None, None, None), (3, "", "", "", 0), (None, "mit license", None, None, None), (4, "x" * 300_000, "en", "a", 1), (5, "\n\n \t", "en", "a", 1)],
    "embeddings": [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, None, 1), (4, [None, 1.0], 1), (5, [], 1), (6, [1.0, 0.0], None), (7, [1.0], 1), (None, [1.0, 0.0], 1), (8, [3e38, 3e38], 1), (9, [float("inf"), 1.0], 1)],
    "pages": [(1, "http://a.org/x", "<p>a &lt; b</p>"), (1, "http://a.org/x", "<p>a &lt; b</p>"), (2, None, None), (3, "", ""), (None, "://", "<" * 5000), (4, "http://" + "a" * 5000, "<div>" * 3000 + "deep")],
    "benchmark": [(1, "one line of the text that stands here twice short and more"), (2, None), (None, "x y"), (3, ""), (4, "mit license")],
    "conversations": [(1, 0, "user", "hello"), (1, 0, "user", "hello"), (2, None, None, None), (None, 1, "user", "x"), (3, 1, "", "x" * 300_000)],
    "labels": [(1, 1, 0), (2, None, None), (None, 0, 0), (3, 0, 0), (3, 0, 0)],
}
#: One row for each row of the table, but for the trie (nodes) and the codes (of vectors that can be cut: tests of their own).
TABLE = {"op1_html_text": "pages", "op3_lattice_near_dup": "embeddings", "op9_url_filter": "pages"}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    odd, empty = tmp_path_factory.mktemp("odd"), tmp_path_factory.mktemp("empty")
    extra = tuple("7" if " string" in c else 7 for c in CLASHING.split(", "))
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{empty}/{name}.parquet")
        spark.createDataFrame([r + extra for r in ROWS[name]], f"{schema}, {CLASHING}").write.parquet(f"{odd}/{name}.parquet")
    return str(odd), str(empty)


@pytest.mark.parametrize("name", QUERIES)
def test_odd_and_empty_tables(spark, folders, name):
    odd, empty = folders
    got, none = QUERIES[name](spark, odd), QUERIES[name](spark, empty)
    assert none.collect() == [] and none.columns == got.columns
    if name in ("op11_prefix_trie", "op12_vector_codes"):
        assert len(got.collect()) == (0 if name == "op12_vector_codes" else 1)
        return
    key = {"pages": "page_id", "embeddings": "vec_id"}.get(TABLE.get(name), "doc_id")
    assert sorted((r[key] is None, r[key] or 0) for r in got.collect()) == sorted((r[0] is None, r[0] or 0) for r in ROWS[TABLE.get(name, "documents")])
