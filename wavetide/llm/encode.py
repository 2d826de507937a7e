"""Encoding of a corpus with a public tokenizer, offsets of its tokens, and decoding."""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetide.llm.codes import text_pieces

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def ship(spark: SparkSession, path: str) -> None:
    """Sends the tokenizer's file to all executors, which need not have it at its path."""
    if os.path.exists(path):
        spark.sparkContext.addFile(path)


def _held(path: str) -> str:
    """The file at its path, or as it was sent."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    """The tokenizer of a file, once per worker; strings of special tokens are plain text to it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(_held(path))
    own.encode_special_tokens = True
    return own


def byte_of_character() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(c): b for b, c in [*zip(plain, plain), *zip(other, range(256, 256 + len(other)))]}


@functools.lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[list[bytes], np.ndarray]:
    """The bytes of each id of a byte-level vocabulary, and their number."""
    with open(_held(path), encoding="utf-8") as f:
        file = json.load(f)
    byte = byte_of_character()
    added = {t["id"]: t["content"].encode() for t in file.get("added_tokens", ())}
    table = [b""] * (1 + max([*file["model"]["vocab"].values(), *added]))
    for token, i in file["model"]["vocab"].items():
        table[i] = bytes(byte[c] for c in token)
    for i, content in added.items():
        table[i] = content
    return table, np.array([len(x) for x in table], np.int64)


def encode_texts(texts: pa.Array, path: str) -> pa.ListArray:
    """Ids of each text; null and empty texts have none."""
    encoded = tokenizer(path).encode_batch_fast([x or "" for x in texts.to_pylist()], add_special_tokens=False)
    ids = [x.ids for x in encoded]
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.asarray(x, np.int32) for x in ids] or [np.zeros(0, np.int32)])))


def encode(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, ids: the ids of each text without special tokens, one row per row of ``docs`` (doc_id, text).

    An empty and a null text give an empty list; text that looks like a special token is plain text; a null doc_id, a
    repeated row or a text of any length is encoded like any other; further columns are dropped. Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_pieces(whole):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), encode_texts(batch.column("text"), path)], ["doc_id", "ids"])

    ship(docs.sparkSession, path)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def token_spans(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First character and end (one past the last character) of each token, and whether it starts within a character.

    Tokens are runs of bytes: their byte offsets follow from the bytes of each id, and a byte's character is the number
    of leading bytes up to it. A character that is split among tokens lies in the span of each of them.
    """
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    leading = (data & 0xC0) != 0x80
    character = np.cumsum(leading) - 1
    end = np.cumsum(sizes[ids])
    start = end - sizes[ids]
    return character[start].astype(np.int32), (character[end - 1] + 1).astype(np.int32), ~leading[start]


def encode_with_spans(docs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, ids, starts, ends, split: as ``encode``, with the characters (from 0, end exclusive) of each token and
    whether the token starts within a character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = token_bytes(path)[1]
        for whole in batches:
            for batch in text_pieces(whole):
                lists = encode_texts(batch.column("text"), path)
                flat = lists.values.to_numpy()
                at = lists.offsets.to_numpy()
                spans = [token_spans(t or "", flat[a:b], sizes) for t, a, b in zip(batch.column("text").to_pylist(), at[:-1], at[1:]) if b > a]
                joined = [np.concatenate([s[k] for s in spans] or [np.zeros(0, kind)]) for k, kind in enumerate((np.int32, np.int32, bool))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), lists, *(pa.ListArray.from_arrays(lists.offsets, pa.array(x)) for x in joined)], ["doc_id", "ids", "starts", "ends", "split"]
                )

    ship(docs.sparkSession, path)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, ids array<int>, starts array<int>, ends array<int>, split array<boolean>"
    )


def decode(encoded: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, text: the bytes of all ids on end, read as UTF-8, so characters split among tokens come out whole.

    Bytes that are no UTF-8 (a list cut within a character) become the replacement character; ids outside the
    vocabulary, and null ones, are an error; a null or empty list gives an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)[0]
        for batch in batches:
            texts = [b"".join([table[i] for i in ids or ()]).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    ship(encoded.sparkSession, path)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
