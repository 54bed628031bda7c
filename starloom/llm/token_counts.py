"""Token counts with a cache of text digests.

Every text's normalised content (null as empty, invalid UTF-8 replaced) has a SHA-256 digest. The
cache is a Parquet table of (version, digest, n_tokens), where version is the digest of tokenizer
library and file. Documents' digests are compared with the cache; of each digest that it lacks
one text is encoded, whole, and its count appended. Counts then come from the cache by a join of
digests, so texts of known counts are neither shuffled nor encoded.

Only the texts to encode are shuffled, equal ones reduced to one before the shuffle. A count that
two runs append twice is read once. Defined cases: null and empty texts have 0 tokens and 0
bytes; repeated documents get a row each; an empty table gives an empty result. Other columns of
the documents are kept in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import encoders
from starloom.llm.common import join_measured, text_of, written
from starloom.sources.hadoop import exists

CACHE_SCHEMA = "version string, digest binary, n_tokens long"


def read_cache(spark, path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version."""
    if not exists(spark, path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def encode_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) from (digest, content), one row for each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = encoders.counter(tokenizer)(batch.column("content").to_pylist())
            yield pa.record_batch(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return texts.select("digest", "content").mapInArrow(count, "digest binary, n_tokens long")


def count_tokens(
    docs: DataFrame, cache_path: str, tokenizer: str, text: str = "text"
) -> DataFrame:
    """(row, n_bytes, n_tokens) for every document; the cache gets the counts it lacked."""
    spark = docs.sparkSession
    version = encoders.version_digest(tokenizer)
    content = F.make_valid_utf8(text_of(docs, text))
    digest = F.unhex(F.sha2(content, 256))
    digests = docs.select(digest.alias("digest"), content.alias("content"))
    cache = read_cache(spark, cache_path, version)
    if cache.isEmpty():
        wanted = digests
    else:
        missing = digests.select("digest").distinct().join(cache, "digest", "left_anti")
        wanted = join_measured(digests, written(missing, "missing"), ["digest"], "left_semi")
    misses = wanted.groupBy("digest").agg(F.first("content").alias("content"))
    encode_counts(misses, tokenizer).select(
        F.lit(version).alias("version"), "digest", "n_tokens"
    ).write.mode("append").parquet(cache_path)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.octet_length(text_of(docs, text)).cast("long").alias("n_bytes"),
        digest.alias("digest"),
    )
    cache = read_cache(spark, cache_path, version)
    return join_measured(rows, cache, ["digest"]).drop("digest")
