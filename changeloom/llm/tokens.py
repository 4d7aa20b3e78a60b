"""Byte-level BPE with a local rank file: encode whole texts, decode ids to raw bytes.

A long text is cut into pieces before it is encoded, only where no match of the split pattern can
reach across: right before a space or newline that follows a visible character. Every match ends
there anyway, and a piece that ends in a visible character cannot change the white-space look-ahead.
So the ids are those of the whole text, while the memory of one call stays small. White space of
unusual length, in which there is no such place and which the library's look-ahead can't cross, is encoded by
itself: all of it at the end of a text, else all but its last character, is one match of the pattern.

Defined results: a null text counts as empty and has no ids; repeated rows give repeated results;
an empty table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import bounded, documents, narrow, raw

PIECE = 1 << 16  # characters of text given to the library at once
#: as many characters of white space (fixed value: Unicode's White_Space) as the look-ahead is spared
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")
BLANK = r"\s+"


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cut at the first safe boundary after every ``size`` characters."""
    start, n = 0, len(text)
    while n - start > size:
        cut = start + size
        while cut < n and not (text[cut] in " \n" and not text[cut - 1].isspace()):
            cut += 1
        yield text[start:cut]
        start = cut
    if start < n:
        yield text[start:]


def encode_text(enc: tiktoken.Encoding, blank: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text; ``blank`` has the same ranks and takes all white space for one match."""
    parts, start = [], 0
    for run in LONG_BLANK.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        parts += [enc.encode_to_numpy(p, disallowed_special=()) for p in pieces(text[start : run.start()])]
        parts.append(blank.encode_to_numpy(text[run.start() : stop], disallowed_special=()))
        start = stop
    parts += [enc.encode_to_numpy(p, disallowed_special=()) for p in pieces(text[start:] if start else text)]
    if len(parts) == 1:
        return parts[0]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def encode(docs: DataFrame, rank_file: str, pattern: str, decode: bool = False) -> DataFrame:
    """doc_id, ids (array of int) and, if asked for, the bytes those ids decode to."""

    def run(batches):
        enc, blank = encoding(rank_file, pattern), encoding(rank_file, BLANK)
        for batch in bounded(batches):
            texts = (b.decode() for b in raw(batch.column("text")))
            ids = [encode_text(enc, blank, text) for text in texts]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids).astype(np.int32)
            columns = [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            if decode:
                columns.append(pa.array([enc.decode_bytes(i.tolist()) for i in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    names = ["doc_id", "ids", "decoded"]
    schema = "doc_id long, ids array<int>" + ", decoded binary" * decode
    return narrow(docs).mapInArrow(run, schema)


def decode(tokens: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and the raw bytes of its ids; null ids count as none. Bytes need not be valid UTF-8."""

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [enc.decode_bytes(ids or []) for ids in part.column("ids").to_pylist()]
                columns = [part.column("doc_id"), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, decode=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
