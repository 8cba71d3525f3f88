import zlib

import pytest
from llm_helpers import table, words

import corpus_pipeline
from starfold.llm import simhash
from starfold.session import scratch_path, scratch_scope


def test_packed_sequences_hold_their_ids(spark):
    rows = corpus_pipeline.packed(spark, table(spark, [(1, words(1, 3000), "en", "a"), (2, "short", "en", "a"), (3, None, "en", "a")]), "").collect()
    assert rows and all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


@pytest.fixture
def labelled(spark, tmp_path):
    """A folder with labels of documents that are not in the table, so none is usable."""
    spark.createDataFrame([(10**6, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_over_odd_rows(spark, odd, odd_rows, labelled):
    """Clashing names, nulls, repeats, ties and very long texts pass every stage with the columns as they are."""
    docs = odd
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, labelled)
        assert at == 4 or after.columns == odd.columns, name
        if at == 0:
            assert sorted(map(str, after.collect())) == sorted(map(str, odd.collect())), "without labels nothing is rejected"
        elif at == 1:
            texts = {simhash.fingerprint(t) for _, t, _, _ in odd_rows}
            assert after.count() <= len(texts) and {simhash.fingerprint(r.text) for r in after.collect()} <= texts
        elif at == 2:
            assert sorted((r.n_chars or 0, r.text or "") for r in after.collect()) == sorted((r.n_chars or 0, r.text or "") for r in docs.collect())
        if at < 4:
            after.write.parquet(f"{labelled}/{at}")
            docs = spark.read.parquet(f"{labelled}/{at}")


def test_stages_over_an_empty_table(spark, empty, labelled):
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, empty, labelled)
        assert after.count() == 0, name


def test_scratch_of_a_stage_goes_with_the_next(spark, labelled):
    docs = table(spark, [(i, words(i, 30), "en", "a") for i in range(20)])
    near = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    with scratch_scope("pipeline"):
        folder = scratch_path(spark, "x").rpartition("/")[0]
    names = lambda: {p.getPath().getName() for p in spark._jvm.org.apache.hadoop.fs.FileSystem.get(
        spark._jvm.java.net.URI(f"file://{folder}".replace("file://file:", "file:")), spark.sparkContext._jsc.hadoopConfiguration()).listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder))}
    near(spark, docs, labelled).count()
    first = names()
    near(spark, docs, labelled).count()
    assert first and not first & names()


def test_tasks_of_python_take_few_texts_at_a_time(spark, tmp_path, monkeypatch):
    from starfold.llm import planes, simhash
    from starfold.llm.base import TEXT_ROWS
    from starfold.llm.queries import vocabulary
    from starfold.session import arrow_rows

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, rows = "10000", lambda: int(spark.conf.get(key))
    spark.conf.set(key, before)  # other tests have run the pipeline in this session
    docs = spark.range(3000).coalesce(1).selectExpr("id AS doc_id", "concat('text ', id) AS text")

    def counted(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    sizes = lambda: [r.n for r in docs.select("doc_id").mapInArrow(counted, "n bigint").collect()]
    with arrow_rows(spark, TEXT_ROWS):
        assert max(sizes()) == TEXT_ROWS and sum(sizes()) == 3000
        with arrow_rows(spark, 10**9):
            assert rows() == TEXT_ROWS, "a smaller number stays"
    assert spark.conf.get(key) == before

    seen = []
    put = type(spark.conf).set
    monkeypatch.setattr(type(spark.conf), "set", lambda self, k, v: (seen.append(str(v)) if k == key else None, put(self, k, v))[1])
    planes.write_ids(docs, f"{tmp_path}/planes", vocabulary())
    assert seen == [str(TEXT_ROWS), before]
    assert planes.read_digests(spark, f"{tmp_path}/planes").count() == 3000
    seen.clear()
    simhash.near_duplicates(docs)
    assert seen[:2] == [str(TEXT_ROWS), before] and spark.conf.get(key) == before


def test_stages_hand_few_texts_to_python(spark, sf_dir, monkeypatch):
    from starfold import session
    from starfold.llm.base import TEXT_ROWS

    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    spark.conf.set(key, before)
    monkeypatch.setattr(session, "_given_rows", {})
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(50)
    try:
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_dir)
            assert spark.conf.get(key) == (str(TEXT_ROWS) if name in ("quality classifier", "packing") else before)
    finally:
        spark.conf.set(key, before)
