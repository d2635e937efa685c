"""Token ids of a whole corpus with a byte-level BPE vocabulary, through a table of distinct words.

Texts are split into the tokenizer's words by its own pattern on the JVM; each distinct word is encoded once, by
whatever library reads the vocabulary, and its ids are joined back to every place the word stands at. The ``FREQUENT``
most frequent words make up nearly all places; their part of the table has a bounded size (so many words of at most
``SHORT`` characters) and is broadcast, so those places never travel by word. All other places meet the rest of the
table in a join by word, which no longer has a hot key.

Defined results: a null text has null ids, an empty one an empty list; white space has ids like any text; texts of
any length are encoded whole; repeated rows each come out; special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut, spread

#: How many words, of how many characters at most, make up the broadcast part of the word table.
FREQUENT, SHORT = 20_000, 24

#: The byte-level BPE word pattern (with Unicode white space).
WORDS = r"(?U)('s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+)"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _encoder(path: str):  # noqa: ANN202
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        # a word is one piece: the pattern only has to take it whole
        enc = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            yield pd.DataFrame({"word": batch["word"], "n": batch["n"], "ids": [enc.encode_ordinary(w) for w in batch["word"]]})

    return encode


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORDS), F.lit(1))


def word_table(texts: DataFrame, path: str) -> DataFrame:
    """(word, n, ids) of the distinct words of ``texts`` (text) and how often each stands there."""
    counts = texts.select(F.explode(_words(F.col("text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return spread(counts).mapInPandas(_encoder(path), "word string, n bigint, ids array<int>")


def encode(docs: DataFrame, doc_id: str, text: str, path: str | None = None) -> DataFrame:
    """(doc_id, ids), one row for each row of ``docs``."""
    path = path or vocabulary_path()
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    row = ["doc_id", "h"]
    single = base.groupBy("doc_id", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    words = cut(word_table(base.where("text <> ''"), path))
    top = cut(words.where(F.length("word") <= SHORT).orderBy(F.col("n").desc(), "word").limit(FREQUENT).select("word", "ids"))
    at = single.where("text <> ''").select(*row, "copies", F.posexplode(_words(F.col("text"))).alias("pos", "word"))
    found = at.join(F.broadcast(top), "word").select(*row, "copies", "pos", "ids")
    # words of the rest stand at few places, or are long
    rest = words.join(top, "word", "left_anti").select("word", "ids")
    late = at.join(F.broadcast(top.select("word")), "word", "left_anti").join(rest, "word").select(*row, "copies", "pos", "ids")
    spelled = (
        found.unionByName(late).groupBy(*row, "copies").agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("parts"))
        .select("doc_id", "copies", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids"))
    )
    none = single.where("text IS NULL OR text = ''").select("doc_id", "copies", F.when(F.col("text") == "", F.array().cast("array<int>")).alias("ids"))
    return _copies(spelled.unionByName(none), "ids")


def _copies(rows: DataFrame, value: str) -> DataFrame:
    """(doc_id, value), as often as ``copies`` says."""
    return rows.select("doc_id", value, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("i")).drop("i")


def pieces(spark, path: str | None = None) -> DataFrame:  # noqa: ANN001
    """(id, piece): the vocabulary, each piece's bytes in hex. Its size is the vocabulary's."""
    path = path or vocabulary_path()
    lines = spark.read.text(f"file://{path}").select(F.split("value", " ").alias("v"))
    return lines.select(F.col("v")[1].cast("int").alias("id"), F.hex(F.unbase64(F.col("v")[0])).alias("piece"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids) by an id-to-piece join, one row for each row; null ids give null, an empty list the empty text."""
    table = pieces(encoded.sparkSession, path)
    # rows that share an id but not their ids are told apart; equal rows are decoded once
    row = ["doc_id", "h", "n", "copies"]
    single = encoded.groupBy("doc_id", F.xxhash64("ids").alias("h"), F.size("ids").alias("n")).agg(F.first("ids").alias("ids"), F.count(F.lit(1)).alias("copies"))
    text = (
        single.select(*row, F.posexplode("ids").alias("pos", "id"))
        .join(table, "id")
        .groupBy(*row)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "piece"))).alias("parts"))
        .select("doc_id", "copies", F.decode(F.unhex(F.array_join(F.transform("parts", lambda p: p["piece"]), "")), "UTF-8").alias("text"))
    )
    none = single.where("ids IS NULL OR size(ids) = 0").select("doc_id", "copies", F.when(F.col("ids").isNotNull(), "").alias("text"))
    return _copies(text.unionByName(none), "text")
