"""Ids that repeat with unlike texts, null ones and empty ones."""

from brandtrack.llm import ngram_join as nj


def words(name, n=30):
    return " ".join(f"{name}{k}" for k in range(n))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string")
    out = nj.keep_one(docs)
    assert out.columns == docs.columns
    return sorted((r["doc_id"] or 0, r["text"] or "", r["note"]) for r in out.collect())


def test_unlike_texts_of_one_id_both_stay(spark):
    rows = [(5, None, "null"), (5, words("a"), "a"), (5, "", "empty"), (5, words("b"), "b"), (7, words("b") + " z", "near b")]
    rows += [(4, words("a") + " z", "near a"), (4, words("c"), "c"), (4, words("c") + " y", "near c"), (None, words("c"), "no id")]
    want = {(5, "", "null"), (5, "", "empty"), (5, words("b"), "b"), (4, words("a") + " z", "near a"), (4, words("c"), "c")}
    assert kept(spark, rows) == sorted(want | {(0, words("c"), "no id")})


def test_one_id_for_all_rows(spark):
    rows = [(1, words(f"t{i}x"), "") for i in range(40) for _ in range(2)]
    assert kept(spark, rows) == sorted((1, words(f"t{i}x"), "") for i in range(40))


def test_rows_without_words_stay_and_repeated_rows_go(spark):
    rows = [(1, "", "x"), (1, "", "x"), (2, words("a"), "y"), (2, words("a"), "y"), (3, words("b"), "z")]
    assert kept(spark, rows) == [(1, "", "x"), (1, "", "x"), (2, words("a"), "y"), (3, words("b"), "z")]


def test_ids_and_kept_nodes_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(nj, "ID_BOUND", 0)
    test_unlike_texts_of_one_id_both_stay(spark)


def test_columns_of_any_name_pass_through(spark):
    names = ["_node", "_several", "_kept", "_again", "_row", "node", "component_id", "h"]
    rows = [(5, words("a"), *range(8)), (5, words("b"), *range(8)), (6, words("a"), *range(8)), (7, None, *range(8))]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {', '.join(f'{n} int' for n in names)}")
    out = nj.keep_one(docs)
    assert out.columns == docs.columns
    got = sorted(tuple(r) for r in out.collect() if r["text"])
    assert got == [(5, words("a"), *range(8)), (5, words("b"), *range(8))] and out.count() == 3
