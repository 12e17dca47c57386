"""Tokenizers of public vocabularies; the file is a parameter and stays outside the repository."""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, SparkSession

from loamstone.functions.arrow import flat_map

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256  # free id of the vocabulary, marks the end of a text


def path_of(spark: SparkSession) -> str:
    """The vocabulary file of a session: setting spark.loamstone.tokenizer."""
    return spark.conf.get("spark.loamstone.tokenizer", TOKENIZER)


def encoder(path: str = TOKENIZER):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): little-endian 32-bit token ids of every text with the end sign; null texts give the sign alone."""
    path = path or path_of(docs.sparkSession)

    def make():
        from array import array

        enc = encoder(path)
        return lambda i, t: [(i, array("I", [*enc.encode_ordinary(t or ""), END]).tobytes())]

    return flat_map(docs.select("doc_id", "text"), make, "doc_id long, ids binary")
