import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline as cp
from brandtrack.llm import decontamination, mixing, quality_classifier, sharding
from brandtrack.llm.tables import read_table
from test_ngram_join import brute

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage, each over what the one before kept."""
    docs = read_table(spark, SF, "documents").withColumn("shard", cp.F.lit("own"))
    docs = docs.union(docs.filter("doc_id % 10 = 3").withColumn("doc_id", cp.F.col("doc_id") + 1_000_000))
    found = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF).cache()
        found[name] = (docs, out)
        docs = out
    return found


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_all_stages_but_the_last_return_the_columns_of_documents(stages):
    for name, (before, after) in stages.items():
        if name != "sharding":
            assert after.columns == before.columns
        assert set(before.columns) <= set(after.columns)
        assert set(ids(after)) <= set(ids(before)) and after.count() > 0


def test_the_classifier_drops_what_it_rejects(spark, stages):
    before, after = stages["quality_classifier"]
    scored = quality_classifier.digest(before, read_table(spark, SF, "labels"))
    assert ids(scored.filter("predicted = 1")) == ids(after)


def test_one_document_of_each_group_of_near_duplicates_stays(stages):
    before, after = stages["ngram_join"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    parts = brute(rows, cp.ngram_join.NEAR_DUPLICATES)
    assert ids(after) == sorted(i for i, _, part in parts if i == part)
    assert after.count() < before.count()


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SF, "benchmark").collect()]
    index, shingler = decontamination.index_items(items), decontamination.Shingler()
    clean = [r["doc_id"] for r in before.collect() if not decontamination.find(r["text"] or "", index, shingler)]
    assert ids(after) == sorted(clean)


def test_mixing_keeps_what_the_weights_choose(stages):
    before, after = stages["mixing"]
    chosen = mixing.mix_documents(before, cp.MIX)
    assert ids(chosen) == ids(after)
    words = mixing.n_words(cp.F.col("text"))
    total, kept = (df.agg(cp.F.sum(words)).first()[0] for df in (before, after))
    assert 0.6 * total < kept <= 0.8 * total


def test_shards_hold_all_rows_of_the_stage_before(stages):
    before, after = stages["sharding"]
    assert ids(after) == ids(before)
    want = {r["doc_id"]: r["shard"] for r in sharding.digest(before).collect()}
    assert {r["doc_id"]: r["shard"] for r in after.collect()} == want


def test_run_applies_all_stages_to_documents(spark):
    assert [name for name, _ in cp.STAGES] == ["quality_classifier", "ngram_join", "decontamination", "mixing", "sharding"]
    got = cp.run(spark, SF)
    assert 0 < got.count() <= read_table(spark, SF, "documents").count()
    assert {"doc_id", "text", "shard", "slot", "grown_shard"} <= set(got.columns)


def test_a_run_leaves_only_the_results_of_its_stages(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(root.iterdir())
    rows = cp.run(spark, SF)
    (folder,) = set(root.iterdir()) - before
    assert {p.name for p in folder.iterdir()} == {name for name, _ in cp.STAGES}
    assert rows.count() > 0


@pytest.mark.parametrize("name", [name for name, _ in cp.STAGES])
def test_stages_take_empty_tables(spark, name):
    docs = read_table(spark, SF, "documents").limit(0)
    assert dict(cp.STAGES)[name](spark, docs, SF).collect() == []


def test_all_are_registered_and_the_rest_works_without_them():
    names = list(entry_point.queries())
    assert [n for n in range(1, 14) if not any(name.startswith(f"op{n}_") for name in names)] == []
    assert "pipeline" in names
    code = (
        "import sys; sys.modules['brandtrack.llm'] = None; import __spark_entry__ as e; "
        "print(sum(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries(), len(e.queries()) > 40)"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.stdout.split() == ["0", "False", "True"], run.stderr
