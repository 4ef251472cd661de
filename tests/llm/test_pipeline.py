import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from benchledger.llm import common, decontamination, near_duplicates, personal_data, quality_rules
from benchledger.session import settle
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def stages(spark, documents):
    """The rows before and after each stage, with odd rows and clashing columns."""
    odd = documents.limit(4).withColumns({"doc_id": F.lit(None).cast("bigint"), "lang": F.lit(None).cast("string")})
    docs = documents.union(documents.limit(5)).union(odd).union(documents.limit(1).withColumn("text", F.lit(None).cast("string")))
    docs = docs.withColumns({"kept": F.lit(1), "items": F.lit("x"), "spans": F.lit(2), "_rest": F.lit("r"), "epoch": F.lit(7)})
    made = [settle(docs, "start")]
    for name, stage in corpus_pipeline.STAGES:
        made.append(settle(stage(spark, made[-1], SF), name))
    return made


def test_all_but_the_last_keep_the_columns(stages):
    assert [s.schema for s in stages[1:-1]] == [stages[0].schema] * 4
    assert stages[-1].columns[-3:] == ["domain", "n_tokens", "epoch"]


def test_quality(spark, stages):
    labels = common.table(spark, SF, "labels")
    ratio = quality_rules.fit(stages[0], quality_rules.trusted_of(labels))
    judged = quality_rules.judge(stages[0], ratio)
    assert 0 < stages[1].count() == judged.filter("kept").count() < stages[0].count()
    assert stages[1].filter("text is null").count() == 0


def test_near_duplicates(stages):
    ids = [row.doc_id for row in stages[2].collect()]
    named = [i for i in ids if i is not None]
    classes = {row.class_id for row in near_duplicates.near_duplicates(stages[1]).collect()}
    assert len(named) == len(set(named)) and set(named) == classes - {None}
    assert ids.count(None) == stages[1].filter("doc_id is null").count()


def test_decontamination(spark, stages):
    found = decontamination.contamination(stages[2], common.table(spark, SF, "benchmark"))
    clean = sorted(str(row.doc_id) for row in found.filter("not contaminated").collect())
    assert clean == sorted(str(row.doc_id) for row in stages[3].collect())


def test_personal_data(stages):
    assert personal_data.personal_data(stages[4]).filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
    before, after = ({row.doc_id: row for row in stage.collect()} for stage in stages[3:5])
    assert before.keys() == after.keys()
    assert all(row.n_chars == len(row.text) for row in after.values())
    changed = [i for i, row in after.items() if row.text != before[i].text]
    assert changed and all("[" in after[i].text for i in changed)


def test_mixing(stages):
    assert 0 < stages[5].count()
    assert {r.doc_id for r in stages[5].collect()} <= {r.doc_id for r in stages[4].collect()}


def test_empty_table(spark, no_rows):
    docs = no_rows
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), name)
    assert docs.count() == 0
