"""The pipeline against a plain version, stage by stage, on the smallest tables."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from claimlake.llm import bpe, decontam, pii, toxicity
from claimlake.llm.common import BATCH_ROWS
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {}
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(spark, step(spark, docs, SF), name)
        got[name] = {r["doc_id"]: r for r in docs.collect()}
        assert len(got[name]) == docs.count()
        if name != "tokens":
            assert docs.columns == list(corpus_pipeline.COLUMNS)

    rows = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    model = toxicity.model_of(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    import pyarrow as pa

    scores = model.scores(pa.array(list(rows.values())))
    rows = {d: t for (d, t), s in zip(rows.items(), scores, strict=True) if s < 0.5}
    assert rows.keys() == got["toxicity"].keys()

    groups = brute(list(rows.items()), 5, 80)
    rows = {d: t for d, t in rows.items() if groups[d][1] == d}
    assert rows.keys() == got["near_duplicates"].keys()

    items = [decontam.normal(r["text"].encode()) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    clean = set()
    for d, t in rows.items():
        own = decontam.normal(t.encode())
        near = decontam.infix_distances(items, [own] * len(items))
        if all(n > 0.1 * len(i) for n, i in zip(near, items, strict=True)):
            clean.add(d)
    assert clean == got["decontamination"].keys()
    rows = {d: t for d, t in rows.items() if d in clean}

    tokenizer = Tokenizer.from_file(bpe.vocabulary_path())
    assert rows.keys() == got["personal_data"].keys() == got["tokens"].keys()
    for d, t in rows.items():
        new = got["personal_data"][d]
        base = pii.base_spans(t)
        if not base and new["text"] == t:
            assert new["n_chars"] == len(t)
        assert pii.base_spans(new["text"]) == [] and new["n_chars"] == len(new["text"])
        assert got["tokens"][d]["token_ids"] == tokenizer.encode(new["text"], add_special_tokens=False).ids
        assert got["tokens"][d]["n_tokens"] == len(got["tokens"][d]["token_ids"])


@pytest.mark.parametrize("step", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_odd_rows(spark, step):
    docs = spark.createDataFrame([(1, None, "en", "s", None), (2, "", None, None, 0), (2, "", "en", "s", 0), (None, "some words", "en", "s", 10), (3, "a clean text of some words", "en", "s", 26)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = step[1](spark, docs.withColumn("label", docs["n_chars"]), SF).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "2", "3", "None"]
    assert step[1](spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("step", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_results_are_computed_in_small_batches(spark, step):
    """Whoever writes a step's result gives its Python tasks a bounded number of texts at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        docs = spark.range(BATCH_ROWS + 500).selectExpr("id AS doc_id", "concat('plain words ', id) AS text", "'en' AS lang", "'s' AS source", "16L AS n_chars")
        kept = step[1](spark, docs, SF).select("doc_id").coalesce(1)
        sizes = [r["n"] for r in kept.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()]
        assert sum(sizes) == BATCH_ROWS + 500 and max(sizes) <= BATCH_ROWS
        spark.conf.set(key, "7")
        step[1](spark, docs.limit(1), SF)
        assert spark.conf.get(key) == "7"
    finally:
        spark.conf.set(key, old)
