"""Tables that workers hold between tasks go when another operator's tasks begin."""

import json

from pyspark.sql import functions as F

from tributary.llm import bpe, common, suffix_dedup


def tokenizer(folder):
    alphabet = bpe.byte_alphabet()
    path = folder / "tokenizer.json"
    path.write_text(json.dumps({"model": {"vocab": {c: k for k, c in enumerate(alphabet)}, "merges": []}, "added_tokens": []}))
    return str(path)


def test_encoders_are_given_up(tmp_path):
    bpe.load.cache_clear()
    bpe.load(tokenizer(tmp_path))
    common.holds(bpe.load.cache_clear)
    common.holds(bpe.load.cache_clear)
    assert bpe.load.cache_info().currsize == 1 and len(common._held) == 1
    common.give_up()
    assert bpe.load.cache_info().currsize == 0 and not common._held
    common.give_up()


def test_results_are_the_same_in_workers_that_encoded(spark, tmp_path):
    common.start(spark)
    path = tokenizer(tmp_path)
    docs = spark.range(64, numPartitions=4).select(F.col("id").alias("doc_id"), F.lit("a text " * 40).alias("text"))
    assert bpe.encode(docs, path).where(F.size("ids") == 280).count() == 64
    assert suffix_dedup.removed(docs).count() == 64
