import __spark_entry__ as entry_points
import corpus_pipeline
import pytest
from tests.llm.test_dedup import reachable, shingle_set
from tests.llm.test_documents import contamination
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
OPERATORS = [name for name in entry_points.queries() if name.startswith("op")]


@pytest.mark.parametrize("name", [n for n in OPERATORS if n in entry_points.oracle_sql()])
def test_operator_equals_its_sql(spark, name):
    assert compare(entry_points.queries()[name](spark, SF_DIR), connect(SF_DIR), entry_points.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in OPERATORS if n not in entry_points.oracle_sql()])
def test_operator_returns_every_row(spark, name):
    table = {"op7": "pages", "op11": "embeddings"}.get(name.split("_")[0], "documents")
    times = 32 if name.startswith("op11") else 1
    assert entry_points.queries()[name](spark, SF_DIR).count() == times * spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in OPERATORS) == list(range(1, 14))
    assert "pipeline" in entry_points.queries()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    clean = stages["toxicity"](spark, docs, SF_DIR)
    assert clean.columns == columns and 0 < clean.count() <= docs.count()

    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: shingle_set(t, 5) for i, t in texts.items()}
    links = [(i, j) for i, a in sets.items() for j, b in sets.items() if i < j and a and 100 * len(a & b) >= 80 * len(a | b)]
    component = reachable(sets, links)
    kept = stages["near_dedup"](spark, docs, SF_DIR)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {i for i, c in component.items() if i == c}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    dirty = {r[0] for r in contamination(list(texts.items()), items, 13, 5) if r[-1]}
    kept = stages["decontamination"](spark, docs, SF_DIR)
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == set(texts) - dirty

    mixed = stages["mixing"](spark, docs, SF_DIR)
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= set(texts)

    sharded = stages["sharding"](spark, docs, SF_DIR).collect()
    assert sorted(r.doc_id for r in sharded) == sorted(texts) and {r.shard for r in sharded} == set(range(24))


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"] and out.count() > 0
