"""Encoding of a corpus with a public byte-level tokenizer through a table of its distinct words.

Texts are placed in chunks of bounded size. Words are split in the JVM; each chunk contributes each of its
words once, each distinct word of the corpus is encoded once, and the ids return to the chunks that hold the
word, where they are put in the place of the word's positions with Arrow kernels.
"""

from __future__ import annotations

import base64
import math
import os
import sys
import types
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.tiktoken"
#: The tokenizer's word pattern; the class for blanks is spelled out because Java's \\s knows ASCII only.
WORD = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{IsWhite_Space}\p{L}\p{N}]+|\p{IsWhite_Space}+(?!\P{IsWhite_Space})|\p{IsWhite_Space}+"
CHUNK_BYTES = 6 << 20
#: Chunks of a task on average, where there are more than four for each core.
CHUNKS_IN_TASK = 32


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _encoder(path: str):
    """The tokenizer of a Python worker; kept while the worker lives."""
    import tiktoken

    kept = sys.modules.setdefault("_ledgerloom_kept", types.ModuleType("_ledgerloom_kept")).__dict__
    if path not in kept:
        pattern = WORD.replace(r"\p{IsWhite_Space}", r"\s").replace(r"\P{IsWhite_Space}", r"\S")
        kept[path] = tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})
    return kept[path]


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def encode(df: DataFrame, id_col: str, text_col: str, tokenizer_dir: str = TOKENIZERS, file: str = BYTE_BPE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, ids array<int>): the ids of each text, without special tokens.

    Null and empty texts get the empty list; blank texts are encoded as they are. Repeated ids each give a row.
    Other columns of df are ignored. A chunk holds about chunk_bytes, or one longer text.
    """
    path = os.path.join(tokenizer_dir, file)
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    full = rows.where(F.col("_text") != "")
    size = full.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    # as many tasks as the texts need, whatever the session's number of partitions is
    tasks = max(math.ceil(chunks / CHUNKS_IN_TASK), min(chunks, 4 * df.sparkSession.sparkContext.defaultParallelism))
    placed = full.select("_id", "_text", F.pmod(F.xxhash64("_id"), F.lit(chunks)).cast("int").alias("_chunk")).repartition(tasks, "_chunk")
    split = placed.select("_id", "_chunk", words(F.col("_text")).alias("_words"))
    # the count keeps _id in this branch, so that both branches need the same columns and share one exchange of the texts
    used = split.select("_chunk", "_id", F.explode(F.array_distinct("_words")).alias("word")).groupBy("_chunk", "word").agg(F.count("_id").alias("n")).where("n >= 0")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(path)
        for b in batches:
            words_ = b.column("word").dictionary_encode()
            ids = pa.array([coder.encode_ordinary(w) for w in words_.dictionary.to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("_chunk"), b.column("word"), ids.take(words_.indices)], ["_at", "word", "ids"])

    # the entries of a word lie side by side, so it is encoded once; it has one entry for each chunk, and no list of chunks is ever built
    entries = used.select("_chunk", "word").repartition(tasks, "word").sortWithinPartitions("word")
    back = entries.mapInArrow(code, "_at int, word string, ids array<int>").repartition(tasks, "_at")

    def place(key: tuple, texts: pa.Table, dictionary: pa.Table) -> pa.Table:
        lists = texts["_words"].combine_chunks()
        lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
        flat = lists.flatten().dictionary_encode()
        where = pc.index_in(flat.dictionary, value_set=dictionary["word"].combine_chunks())
        coded = dictionary["ids"].combine_chunks().take(where.take(flat.indices))
        lengths = pc.list_value_length(coded).to_numpy(zero_copy_only=False)
        import numpy as np

        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return pa.table({"_id": texts["_id"], "ids": pa.ListArray.from_arrays(pa.array(ends[starts].astype(np.int32)), coded.flatten())})

    id_type = rows.schema["_id"].dataType.simpleString()
    coded = split.groupBy("_chunk").cogroup(back.groupBy("_at")).applyInArrow(place, f"_id {id_type}, ids array<int>")
    empty = rows.where(F.col("_text").isNull() | (F.col("_text") == "")).select("_id", F.array().cast("array<int>").alias("ids"))
    return coded.unionByName(empty).withColumnRenamed("_id", id_col)


def pieces(spark: SparkSession, tokenizer_dir: str = TOKENIZERS, file: str = BYTE_BPE) -> DataFrame:
    """(id, hex): the bytes of each id; as many rows as the vocabulary has entries."""
    return spark.createDataFrame(pd.DataFrame([(i, b.hex()) for b, i in _ranks(os.path.join(tokenizer_dir, file)).items()], columns=["id", "hex"])).select(F.col("id").cast("int"), "hex")


def decode(df: DataFrame, id_col: str, ids_col: str, vocabulary: DataFrame) -> DataFrame:
    """(id, text): the texts of lists of ids, by a join of each position with the pieces.

    Rows must have distinct ids. A null or empty list gives the empty text; an id outside the vocabulary is left out.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.posexplode_outer(ids_col).alias("pos", "id"))
    joined = rows.join(vocabulary, "id", "left").groupBy("_id").agg(F.array_sort(F.collect_list(F.when(F.col("hex").isNotNull(), F.struct("pos", "hex")))).alias("p"))
    return joined.select(F.col("_id").alias(id_col), F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["hex"]), "")), "UTF-8").alias("text"))
