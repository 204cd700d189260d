"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document of ``n`` tokens is cut into ``n // longest`` pieces of the longest length and one piece
for each binary digit of the rest. Each piece is a sequence of its own, and sequences of one length
form a bucket, so that batches are drawn from a bucket and need no padding: 0 of the tokens of a
batch are filler, at the price of shorter sequences at the ends of documents.

Ids come from the byte-level BPE named by a ``tokenizers`` file. Tokenizing is most of the work, so
the ranks of that file are run by ``tiktoken``, which gives the same ids several times faster; a
text with a very long run without a space goes to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shopledger.llm.workspace import Workspace

LONGEST = 2048
END = 1
_LONG_RUN = re.compile(r"\S{2000}")


def _byte_of() -> dict[str, int]:
    """The printable characters that byte-level BPE files write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them."""
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {k: v for k, v in model["vocab"].items() if k not in special}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ranks = [vocab[m] for m in merged]
    usable = (
        split
        and split["type"] == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and spec.get("normalizer") is None
        and ranks == sorted(ranks)  # merged in the order of their ids
    )
    if not usable:
        return lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    byte_of = _byte_of()
    # Fixed value: the splitting pattern of byte-level BPE.
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
    fast = tiktoken.Encoding(
        "from-file",
        pat_str=pattern,
        mergeable_ranks={bytes(byte_of[c] for c in k): v for k, v in vocab.items()},
        special_tokens=special,
    )
    allowed = set(special)

    def encode(text: str) -> np.ndarray:
        if _LONG_RUN.search(text):
            return np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())

    return encode


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """``n`` as pieces of the longest length, then the powers of two of the rest, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    id: str = "doc_id",
    longest: int = LONGEST,
    end: int = END,
    with_ids: bool = True,
    groups: int = 256,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A document is its ids and then ``end``; a null or empty text is ``end`` alone. ``longest`` must be
    a power of two. Sequences are numbered from 0 without gaps in the order of their buckets, the
    shortest length first, so that a bucket is a range of ``sequence_id``. Repeated rows and copies of
    a document are packed each; null ids are kept. Other columns of ``docs`` are left out.

    Numbers come from counts per (bucket, group of documents), a table of at most ``groups`` times
    the number of lengths; within such a group rows are numbered by one window, so no task holds a
    bucket.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    schema = "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, grp int"
    schema += ", ids array<int>" if with_ids else ""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows: list[tuple] = []
                own: list[np.ndarray] = []
                for doc, value, grp in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    ids = np.append(encode(value or ""), np.uint32(end)).astype("<u4", copy=False)
                    raw, start = memoryview(ids.tobytes()), 0
                    for length in piece_lengths(len(ids), longest):
                        crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                        rows.append((doc, start, length, crc, len(ids), grp))
                        start += length
                    if with_ids:
                        own.append(ids)
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.int32())]
                if with_ids:
                    at = np.concatenate(([0], np.cumsum(columns[2]))).astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(own).view(np.int32))))
                yield pa.RecordBatch.from_arrays(arrays, names=[*"id start length ids_crc32 doc_tokens grp".split(), *["ids"] * with_ids])

    work = Workspace(docs.sparkSession, "packing")
    group = F.pmod(F.xxhash64(F.col(id), F.length(text)), F.lit(groups)).cast("int")
    cut = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), group.alias("grp"))
    cut = work.keep(cut.mapInArrow(pieces, schema), "pieces")
    counts = cut.groupBy("length", "grp").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("length", "grp").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("length", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = W.partitionBy("length", "grp").orderBy("id", "start", "ids_crc32")
    numbered = cut.withColumn("_nth", F.row_number().over(inside)).join(firsts, ["length", "grp"])
    return numbered.select(
        F.col("id").alias(id),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first") + F.col("_nth") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        *["ids"] * with_ids,
    )
