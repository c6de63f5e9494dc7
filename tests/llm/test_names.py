"""Extra columns whose names the operators use for themselves keep their values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from gridcube.llm import bpe, decontaminate, fingerprint, mixing, queries, pii, sharding, simhash, toxicity, urls
from gridcube.session import materialize
from tests.conftest import SF_SMALL

NAMES = ["_0", "_1", "__row", "__block", "__count", "__nth", "__h", "__slice", "__first", "__upto", "r", "rate", "u", "__id", "__source", "__size", "__t",
         "__n", "__i", "__unit", "__tie", "__copies", "__copy", "__f", "__k", "__pii", "__toxicity", "toxicity", "__node", "__own", "__alias", "__text", "node", "root", "id",
         "size", "count", "t", "h", "fp", "fingerprint", "component_id", "part", "place", "a.b", "Words in it"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"text {i} mail a{i}@b.cd " + "word " * i, "en", "s" if i % 2 else None, 30) for i in range(12)] + [(3, "same row", "en", "s", 8)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return materialize(df.select("*", *[F.concat(F.lit(c + ":"), F.col("doc_id").cast("string")).alias(c) for c in NAMES]), "names")


def kept(df):
    rows = df.collect()
    assert rows and all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in NAMES)
    return rows


def test_mixing(docs):
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    assert len(kept(got)) == mixing.copies(docs).agg(F.sum("copies")).first()[0]


def test_pii(docs):
    got = pii.redact(docs)
    assert got.columns == docs.columns and all("@" not in r.text for r in kept(got))


def test_simhash(docs):
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns and len(kept(got)) == simhash.near_duplicates(docs).select("root").distinct().count()


def test_sharding(docs):
    got = sharding.shard(docs, 3)
    assert got.columns == [*docs.columns, "shard", "slot"]
    assert sorted((r["shard"], r["slot"]) for r in kept(got)) == [(s, k) for s in range(3) for k in range(5)]


@pytest.mark.parametrize("as_table", [False, True])
def test_urls(spark, docs, as_table):
    pages = docs.withColumn("url", F.concat(F.lit("https://x.net/es/"), F.col("doc_id"))) \
        .withColumn("html", F.lit('<link rel="canonical" href="https://y.com/es">'))
    rules = spark.createDataFrame(urls.RULES, "action string, host string, path string") if as_table else urls.RULES
    got = urls.judge(pages, rules)
    assert got.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert {(r.host, r.rule, r.verdict) for r in kept(got)} == {("x.net", "net/es/", "block")}


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_decontaminate(spark, docs, block):
    items = spark.createDataFrame([(1, "same row"), (2, "text 5 mail"), (3, "nothing of it")], "item_id long, text string")
    got = decontaminate.contamination(docs, items, 10, block_bytes=block)
    assert got.columns == [*docs.columns, "n_words", "n_hit", "spans", "items"]
    assert sorted((r.doc_id, *r["items"]) for r in kept(got) if r.n_hit) == [(3, "1")] * 3 + [(5, "2")]


def test_pipeline_stages(spark, docs):
    for name, stage in C.STAGES:
        docs = materialize(stage(spark, docs, SF_SMALL), f"names-{name}")
        kept(docs)


def test_toxicity_score(spark, docs):
    got = toxicity.score(docs.drop("toxicity"), toxicity.train([], []))
    assert got.columns == [*[c for c in docs.columns if c != "toxicity"], "toxicity"] and got.count() == 15


def test_ids_and_sketches(docs):
    ids = bpe.encode(docs, *queries.tokenizer())
    got = bpe.decode(ids, *queries.tokenizer())
    assert got.columns == [*docs.columns, "token_ids", "decoded"] and all(r.decoded.decode() == r.text for r in kept(got))
    assert fingerprint.with_sketch(docs).columns == [*docs.columns, "sketch"] and len(kept(fingerprint.with_sketch(docs))) == 15
