"""Token counts without materialising ids.

A byte-level BPE never joins bytes of different pre-tokens, so a text's count is
the sum of its pre-tokens' counts. Texts are cut natively before every blank,
tab or line break that follows a letter or a printable ASCII character: such a
place is always a pre-token boundary (no pre-token holds white space behind
another character), whatever the Unicode version, so each cut piece (white
space and the word behind it) counts by itself as it does in the whole text.

1. Vocabulary: distinct pieces with their corpus frequency (grouped, combined
   map-side) and, counted once per distinct piece, their number of tokens.
2. Head: pieces that make up at least 1 / ``head`` of all occurrences and are
   short. There are at most ``head`` of them, whatever the corpus, so they may
   be broadcast; the hottest keys never are shuffled.
3. Tail: every other occurrence meets its piece in a shuffle join.
4. Both are summed per document row.

Edge cases: a null or empty text has 0 tokens; repeated rows count row by row;
a special token's string inside a text is handled as the library does by
default (it holds no white space, so it stays in one piece). Other columns are
not read.
"""

from __future__ import annotations

import os
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwise.llm._io import materialise, prepare, stable_input

BOUNDARY = r"(?<=[\p{L}!-~])(?=[ \t\r\n])"
HEAD_BYTES = 64


def pieces(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), BOUNDARY)


def _count_tokens(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for batch in batches:
        texts = batch.column("piece").to_pylist()
        n = [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("piece"), batch.column("seen"), pa.array(n, pa.int64())],
            names=["piece", "seen", "tokens"])


def vocabulary(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """(piece, seen, tokens) per distinct piece of the corpus."""
    prepare(docs.sparkSession)
    every = docs.select(F.explode(pieces(F.col(text))).alias("piece"))
    counted = every.groupBy("piece").agg(F.count("*").alias("seen"))
    return counted.mapInArrow(lambda it: _count_tokens(it, tokenizer_path),
                              "piece string, seen long, tokens long")


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, head: int = 1 << 20,
                 id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit."""
    prepare(docs.sparkSession)
    docs = stable_input(docs.select(id_col, text), "token-texts")
    vocab = materialise(vocabulary(docs, tokenizer_path, text), "token-vocabulary")
    total = vocab.agg(F.sum("seen")).first()[0] or 0
    common = (F.col("seen") * head >= total) & (F.octet_length("piece") <= HEAD_BYTES)
    hot = vocab.filter(common).select("piece", "tokens")
    rare = vocab.filter(~common).select("piece", "tokens")

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text).alias("t"))
    each = rows.select("row", F.explode(pieces(F.col("t"))).alias("piece"))
    head_sum = (each.join(F.broadcast(hot), "piece")  # at most ``head`` rows of HEAD_BYTES
                .groupBy("row").agg(F.sum("tokens").alias("head_tokens")))
    tail = each.join(F.broadcast(hot.select("piece")), "piece", "left_anti")
    tail_sum = tail.join(rare, "piece").groupBy("row").agg(F.sum("tokens").alias("tail_tokens"))
    n = F.coalesce("head_tokens", F.lit(0)) + F.coalesce("tail_tokens", F.lit(0))
    return (rows.select("row", "doc_id", F.coalesce(F.octet_length("t"), F.lit(0)).cast("long").alias("n_bytes"))
            .join(head_sum, "row", "left").join(tail_sum, "row", "left")
            .select("doc_id", "n_bytes", n.cast("long").alias("n_tokens"),
                    (n > limit).alias("over_limit")))
