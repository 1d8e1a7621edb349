"""Stage functions give back the caller's columns, whatever their names."""

import random

import pytest
from pyspark.sql import functions as F

from wardlake.llm import exact_dedup, mixing, near_dedup, quality

CLASHING = ["_lang", "_text", "_row_key", "_digest", "_again", "_mix_id", "_nth", "_copy", "_copies", "row", "key", "digest",
            "again", "mix_id", "copies", "copy", "nth", "c0", "c1", "label", "node", "class_id", "size", "rank"]
STAGES = [quality.good_documents, exact_dedup.distinct_documents, near_dedup.one_of_each_class, mixing.mixed_documents]


@pytest.mark.parametrize("stage", STAGES, ids=lambda f: f.__name__)
def test_clashing_columns_come_back(spark, stage):
    rng = random.Random(1)
    words = ["the", "of", "river", "stone", "and", "house", "green", "walk", "light", "seven", "paper", "table"]
    texts = [" ".join(rng.choice(words) + str(rng.randint(0, 400)) for _ in range(80)) for _ in range(30)]
    rows = [(k, t, "en", f"s{k % 3}", 1) for k, t in enumerate(texts + [None, "", texts[0], texts[1]])] + [(None, texts[2], None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    wide = docs.select("*", *[F.concat(F.lit(c + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHING])
    got = stage(wide)
    assert got.columns == wide.columns
    kept = got.collect()
    assert kept
    for r in kept:
        assert all(r[c] == f"{c}:{'none' if r.doc_id is None else r.doc_id}" for c in CLASHING)
    assert stage(wide.limit(0)).count() == 0
