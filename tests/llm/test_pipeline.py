import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from gridcube.llm import bpe, mixing, pii, queries, simhash, toxicity
from gridcube.session import materialize
from tests.conftest import SF_SMALL
from tests.llm.test_pii import plain
from tests.llm.test_simhash import brute_components, plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, f in C.STAGES:
        out.append(materialize(f(spark, out[-1], SF_SMALL), name))
    return out


def test_stages_keep_the_columns(stages):
    docs = stages[0]
    for s in stages[1:-1]:
        assert s.dtypes == docs.dtypes
    assert stages[-1].columns == [*docs.columns, "token_ids"]


def test_toxicity_drops_what_its_model_rejects(spark, stages):
    model = toxicity.fit(stages[0], queries.table(spark, SF_SMALL, "labels"), queries.crc_of("id") % 3 != 1)
    want = {r.doc_id for r in stages[0].collect() if model.probability(r.text, {}) < queries.TOXIC_AT}
    assert {r.doc_id for r in stages[1].collect()} == want and stages[1].exceptAll(stages[0]).count() == 0


def test_simhash_keeps_the_first_of_each_group(stages):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in stages[1].collect()]
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted({c for _, _, c in brute_components(rows)})


def test_pii_is_hidden(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[2:4])
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert r.n_chars == len(r.text) and not [s for s in plain(r.text) if s[0] == "email"]
        if not plain(before[i].text):
            assert r.text == before[i].text


def test_mixing_takes_the_planned_copies(stages):
    plan = {r.id: r.copies for r in mixing.copies(stages[3]).collect()}
    got = collections.Counter(r.doc_id for r in stages[4].collect())
    assert got == {i: n for i, n in plan.items() if n}


def test_tokens_decode_to_the_text(stages):
    enc = bpe.load(*queries.tokenizer())
    for r in stages[5].collect():
        assert enc.decode_bytes(list(r.token_ids)).decode() == r.text


def test_run_is_registered_and_equals_its_stages(spark, stages):
    import __spark_entry__ as E
    got = E.queries()["pipeline"](spark, SF_SMALL)
    assert got.exceptAll(stages[-1]).count() == 0 and got.count() == stages[-1].count()


@pytest.mark.parametrize("which", ["empty", "odd"])
def test_every_stage_takes_any_rows(spark, which):
    docs = spark.createDataFrame(
        [(None, None, None, None, None, 1, "z"), (1, "", "en", "s", 0, 1, "z"), (2, "a@b.cd x", "en", "s", 8, 2, "z"), (2, "a@b.cd x", "en", "s", 8, 2, "z"),
         (3, "word " * 40_000, None, "s", None, 3, None), (None, "text without id", "en", None, 15, 3, None)],
        "doc_id long, text string, lang string, source string, n_chars long, size int, fingerprint string")
    docs = docs.limit(0) if which == "empty" else docs
    for name, f in C.STAGES:
        docs = materialize(f(spark, docs, SF_SMALL), f"any-{name}")
        assert docs.columns[:7] == ["doc_id", "text", "lang", "source", "n_chars", "size", "fingerprint"]
    assert docs.count() == 0 or which == "odd"
    if which == "odd":
        assert docs.where(F.col("text").contains("@")).count() == 0 and docs.where("doc_id = 2").count() <= 2


def test_modules_are_independent_of_the_rest():
    import pathlib
    root = pathlib.Path(C.__file__).parent
    for p in (root / "gridcube").rglob("*.py"):
        if "llm" not in p.parts:
            assert "gridcube.llm" not in p.read_text()
    assert simhash and pii
