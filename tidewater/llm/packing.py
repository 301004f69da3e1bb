"""Power-of-two packing: documents are cut into pieces of binary lengths.

A document of ``n`` tokens becomes ``n // max_len`` pieces of ``max_len`` tokens and,
for the rest, one piece for each set bit of ``n % max_len``, longest first. Every piece
fills a sequence of its own length, so no sequence crosses documents, no sequence needs
padding, and equal lengths share a bucket that a trainer batches on its own.

Everything is local to a document: one scan, no shuffle, nothing gathered.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_texts

MAX_LEN = 2048
END_ID = 1
_LONG_CHARS = 1 << 20


def binary_pieces(n: int, max_len: int = MAX_LEN) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; ``max_len`` is a power of two."""
    full, rest = divmod(n, max_len)
    out = [(i * max_len, max_len) for i in range(full)]
    at, bit = full * max_len, max_len >> 1
    while bit:
        if rest & bit:
            out.append((at, bit))
            at += bit
        bit >>= 1
    return out


def load_encoder(vocab: str, ranks: str | None):
    """Encoder of text to ids as the ``tokenizers`` file ``vocab`` gives them with
    ``add_special_tokens=False``.

    With ``ranks`` (the same vocabulary as a ``tiktoken`` rank file) the ids come from
    tiktoken, which gives the same ids at several times the speed; without it
    from ``tokenizers`` itself.
    """
    import json

    with open(vocab, encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}
    if ranks is None:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(vocab)
        return lambda text: tok.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
    blank = re.compile(r"\S\s+(?=\S)")

    def plain(text: str) -> list[int]:
        if len(text) <= _LONG_CHARS:
            return enc.encode_ordinary(text)
        # Very long text goes in parts that end before white space, where a token always ends.
        ids, lo = [], 0
        while lo < len(text):
            hi = min(len(text), lo + _LONG_CHARS)
            if hi < len(text):
                m = blank.search(text, hi)
                hi = m.start() + 1 if m else len(text)
            ids += enc.encode_ordinary(text[lo:hi])
            lo = hi
        return ids

    def encode(text: str) -> list[int]:
        if cut is None or not any(s in text for s in special):
            return plain(text)
        return [i for part in cut.split(text) if part for i in ([special[part]] if part in special else plain(part))]

    return encode


def pack(docs: DataFrame, vocab: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, bucket``.

    ``ids`` is binary (unsigned 32-bit little-endian). ``bucket`` is log2 of the length:
    write with ``partitionBy("bucket")`` to keep equal lengths together.
    Null and empty texts give one piece with the end id alone. ``doc_id`` may be null or
    repeat: every row is packed for itself. An empty table gives no rows. Other columns
    are ignored. ``sequence_id`` numbers the rows by input partition, so a recomputed
    partition gives the same numbers.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")

    def make():
        encode = load_encoder(vocab, ranks)

        def fn(doc_id, text) -> Iterator[tuple]:
            ids = np.array([*encode(text or ""), end_id], dtype="<u4")
            for start, length in binary_pieces(len(ids), max_len):
                yield doc_id, start, length, ids[start:start + length].tobytes(), len(ids)
        return fn

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_texts(docs, [id_col], text_col, f"{id_col} {kind}, start long, length long, ids binary, doc_tokens long",
                    make, slice_rows=64)
    return out.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
                      F.log2("length").cast("int").alias("bucket"))
