"""The training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame; ``run`` writes each result as Parquet under the
shared checkpoint folder and rereads it. All stages but the last return the
columns of ``documents``; the last adds ``token_ids``. NULL and empty texts,
NULL ids or sources, repeated rows, very long texts, extra columns and an empty
table pass every stage as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcube.llm import bpe, mixing, pii, simhash, toxicity
from gridcube.llm.names import by_place, named
from gridcube.llm.queries import TOXIC_AT, crc_of, table, tokenizer
from gridcube.session import cleanup, mark, materialize


def drop_toxic(spark, docs, sf_dir):
    """Documents scored below the toxicity threshold, unchanged."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_of("id") % 3 != 1)
    rows, at = by_place(docs)
    return toxicity.score(rows, model, at["text"]).where(F.col("toxicity") < TOXIC_AT).select(*named(at))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def hide_personal_data(spark, docs, sf_dir):
    """Texts with personal data replaced by its kind; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark, docs, sf_dir):
    """Every document as often as the mix of the sources takes it."""
    return mixing.mix(docs)


def tokenize(spark, docs, sf_dir):
    """All columns and the text's token ids."""
    return bpe.encode(docs, *tokenizer())


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_duplicates), ("pii", hide_personal_data),
          ("mixing", mix_sources), ("bpe", tokenize)]
# the first stage is a trained model, which SQL cannot express
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, start = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        cleanup(spark, start, keep=[docs])       # the stage before it and what this one wrote on its way
    return docs
