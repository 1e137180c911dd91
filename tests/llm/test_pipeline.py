import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import test_minhash, test_substrings
from tests.llm.data import SF, awkward, empty, prose
from tests.llm.test_tokens_packing import check_pieces
from tradeline.llm import queries


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "substring_dedup", "decontamination", "packing",
    ]


def test_run_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = {i: t for i, t in docs.items() if any(map(str.isalpha, t or ""))}
    docs = {i: docs[i] for i, (_, root) in test_minhash.brute(list(docs.items())).items() if i == root}
    docs = {i: t for i, t in test_substrings.brute(list(docs.items())).items() if t}
    docs = {i: t for i, t in docs.items() if not any(q in t for q in items)}
    rows = queries.QUERIES["pipeline"](spark, SF).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, docs)


def test_stages_take_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        done = stage(spark, docs, SF)
        if number < 4:
            assert done.schema.simpleString() == docs.schema.simpleString()
            done.write.parquet(str(tmp_path / str(number)))
            docs = spark.read.parquet(str(tmp_path / str(number)))
    assert {r.doc_id for r in done.collect()} >= {1, 6, None}


def test_stages_take_an_empty_table_and_clashing_names(spark, tmp_path):
    extra = "row_key long, row string, contaminated_id long, component_id int, foreign_spans string, hashes binary"
    docs = empty(spark, f"doc_id long, text string, lang string, n_chars long, {extra}")
    full = spark.createDataFrame(
        [(i, prose(i), "en", len(prose(i)), i, "r", 1, 2, "f", b"h") for i in range(6)], docs.schema
    )
    for docs in (docs, full):
        columns = docs.schema.simpleString()
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            path = str(tmp_path / f"{number}-{docs.count()}-{id(docs)}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.schema.simpleString() == columns
        assert docs.count() == full.count() or docs.count() == 0
        assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()} == {r.doc_id for r in docs.collect()}
