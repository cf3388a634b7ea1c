import inspect

import corpus_pipeline
import __spark_entry__ as driver
import oracle
from tests.llm.cases import documents, prose
from viewtide.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = driver.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(queries.oracle_sql()) <= set(names)


def test_each_stage_decides_on_its_input(spark, tmp_path):
    awkward = [r[:5] for r in documents() if r[0] not in (14, None, 16, 17)]
    rows = awkward + [(100 + k, prose(700 + k, 50), "en", "abc"[k % 3], 1) for k in range(40)]
    rows += [(200, prose(790, 50) + " token=abcdefgh", "en", "a", 1), (201, prose(705, 50) + " more", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    columns, had = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        path = str(tmp_path / str(k))
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 4:
            assert docs.columns == columns
        had.append(docs.collect())
    good, single, hidden, mixed, packed = had
    ids = {r.doc_id for r in good}
    assert not ids & {7, 8, 9, 10, 11, 12} and len(ids & set(range(100, 140))) >= 39
    assert {r.doc_id for r in single} == ids - {2, 3, 201}
    assert [r.text for r in hidden if r.doc_id == 200][0].endswith("[SECRET]")
    assert {(r.doc_id, r.n_chars) for r in hidden} == {(r.doc_id, len(r.text)) for r in hidden}
    assert {(r.doc_id, r.text) for r in mixed} == {(r.doc_id, r.text) for r in hidden}
    assert sorted(r.doc_id for r in packed if not r.piece) == sorted(r.doc_id for r in mixed)


def test_run_and_empty(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_oracle_sql(spark):
    connection = oracle.connect(SF_DIR)
    for name, sql in queries.oracle_sql().items():
        made = queries.queries()[name](spark, SF_DIR)
        columns = ", ".join(f'"{c}"' for c in made.columns)
        want = connection.execute(f"SELECT {columns} FROM ({sql})").fetchall()
        assert sorted(map(tuple, made.collect())) == sorted(want)
