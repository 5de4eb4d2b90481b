import corpus_pipeline as pipeline
import pytest
from llm.rows import odd_documents
from llm.test_jaccard import brute
from llm.test_quality import base

from ferryline.llm.secrets import ASSIGN
from ferryline.sources.collections import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    home, docs, out = tmp_path_factory.mktemp("stages"), table(spark, FOLDER, "documents"), []
    for name, stage in pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
        out.append(docs)
    return [table(spark, FOLDER, "documents"), *out]


def test_each_stage_on_its_own_input(stages):
    texts = [{r.doc_id: r.text for r in s.collect()} for s in stages[:-1]]
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert not any(base(t)[-1] for t in texts[1].values())
    groups = brute(list(texts[1].items()), pipeline.SHINGLE, pipeline.PERCENT)
    assert set(texts[2]) == {c for _, _, c in groups}
    assert set(texts[3]) <= set(texts[2]) and set(texts[4]) == set(texts[3])
    assert not any(__import__("re").search(ASSIGN, t) and "[SECRET]" not in t for t in texts[4].values())
    assert {r.doc_id for r in stages[-1].collect()} == set(texts[4])


def test_run_gives_the_last_stage(spark, stages):
    got = {r.doc_id: r.ids for r in pipeline.run(spark, FOLDER).collect()}
    assert got == {r.doc_id: r.ids for r in stages[-1].collect()}


def test_odd_rows(spark, tmp_path):
    for number, (name, stage) in enumerate(pipeline.STAGES):
        for rows, docs in (("odd", odd_documents(spark)), ("none", odd_documents(spark).limit(0))):
            docs.write.parquet(f"{tmp_path}/{number}-{rows}")
            out = stage(spark, spark.read.parquet(f"{tmp_path}/{number}-{rows}"), FOLDER)
            assert out.count() <= docs.count() and (rows == "odd" or out.count() == 0)
            assert number == 4 or out.columns == docs.columns


def test_one_survivor_a_group(spark, tmp_path):
    """Null ids, ids that several texts share, and rows repeated with other languages."""
    words = [f"w{i}" for i in range(60)]
    near = [" ".join(words[:-1] + [f"end{i}"]) for i in range(5)]
    far = " ".join(f"z{i}" for i in range(40))
    rows = [(None, near[0], "en"), (None, near[1], "en"), (7, near[2], "en"), (7, near[3], "en"), (9, near[4], "en"),
            (None, far, "en"), (None, far + " more", "en"), (3, "one row", "fr"), (3, "one row", "de"), (None, None, "en"),
            (None, "", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/in")
    out = pipeline.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/in"), FOLDER).collect()
    assert sorted(map(str, [r.doc_id for r in out])) == ["3", "7", "None", "None", "None"]
    assert [r.lang for r in out if r.doc_id == 3] == ["de"]
    assert sum(bool(r.text) and r.text.startswith("z0") for r in out) == 1
