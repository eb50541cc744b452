"""Token counts: pieces counted once per distinct pre-token, joined to per-document frequencies.

One pass over the texts turns each block of documents into a frequency matrix
(documents x the block's distinct pre-tokens).  The distinct pre-tokens travel
to hash buckets, where each bucket's task counts every distinct pre-token once;
the counts travel back to their block and meet the matrix.  A pre-token that
occurs in every document is one entry per block, so no key is hot, and no ids
are ever made for a text.

Special strings inside a text count as the library counts them by default:
one token each, and they part the text.

Cases: a null or empty text has no tokens.  Each row is counted by itself, so
repeated rows and repeated or null ids keep a row each.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .base import blocks, bounded_batches, from_varints, texts, varints

# Fixed value: the split of byte-level BPE into pre-tokens, as the vocabulary's file names it.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_BYTES = 16 << 20

_SCHEMA = "key long, block long, bucket int, toks array<string>, n array<int>, ids array<long>, lengths array<long>, specials array<int>, sizes array<int>, index binary, counts binary"


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _special(path: str):
    """Pattern of the strings that the library takes out of a text before it splits it."""
    added = [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()]
    return regex.compile("|".join(regex.escape(s) for s in sorted(added, key=len, reverse=True))) if added else None


def _pieces(path: str, tokens: list[str]) -> np.ndarray:
    """Number of vocabulary pieces of each pre-token."""
    found = _tokenizer(path).encode_batch_fast(tokens, add_special_tokens=False)
    return np.fromiter((len(e) for e in found), np.int64, len(tokens))


def _matrix(path: str, buckets: int):
    """Texts to one matrix row a block and one row of distinct pre-tokens a block and bucket."""
    split = regex.compile(PRE_TOKEN).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, special = TaskContext.get().partitionId(), _special(path)
        for k, table in enumerate(blocks(batches, limit=BLOCK_BYTES)):
            block = (part << 32) + k
            seen: dict[str, int] = defaultdict()
            seen.default_factory = seen.__len__
            sizes, specials, index, counts = [], [], [], []
            for text in table["text"].to_pylist():
                parts = special.split(text) if special else [text]
                words = Counter(split(parts[0]))
                for more in parts[1:]:
                    words.update(split(more))
                specials.append(len(parts) - 1)
                sizes.append(len(words))
                mine = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
                often = np.fromiter(words.values(), np.int64, len(words))
                order = np.argsort(mine)
                index.append(np.diff(mine[order], prepend=0))
                counts.append(often[order])
            bucket_of = np.fromiter((zlib.crc32(t.encode("utf-8", "surrogatepass")) % buckets for t in seen), np.int64, len(seen))
            order = np.argsort(bucket_of, kind="stable")
            starts = np.searchsorted(bucket_of[order], np.arange(buckets + 1))
            tokens = list(seen)
            rows = [{
                "key": block % buckets, "block": block, "bucket": -1, "ids": table["doc_id"].to_pylist(),
                "lengths": pc.binary_length(table["text"]).to_pylist(), "specials": specials, "sizes": sizes,
                "index": varints(np.concatenate(index)), "counts": varints(np.concatenate(counts)),
            }]
            for b in range(buckets):
                at = order[starts[b]:starts[b + 1]]
                if len(at):
                    rows.append({"key": b, "block": block, "bucket": b, "toks": [tokens[i] for i in at], "n": at.tolist()})
            yield from pa.Table.from_pylist(rows, schema=_arrow()).to_batches(max_chunksize=64)

    return run


def _arrow() -> pa.Schema:
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    return pa.schema([
        ("key", pa.int64()), ("block", pa.int64()), ("bucket", pa.int32()), ("toks", pa.list_(pa.string())), ("n", ints),
        ("ids", longs), ("lengths", longs), ("specials", ints), ("sizes", ints), ("index", pa.binary()), ("counts", pa.binary()),
    ])


def _counted(path: str):
    """Replace each bucket's pre-tokens by their numbers of pieces; each distinct one is counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["toks"] is not None:
                    fresh = [t for t in row["toks"] if t not in known]
                    known.update(zip(fresh, _pieces(path, fresh).tolist(), strict=True))
                    # Position in the block's matrix, then the number of pieces.
                    row["index"] = varints(np.asarray(row["n"]))
                    row["counts"] = varints(np.fromiter(map(known.__getitem__, row["toks"]), np.int64, len(row["toks"])))
                    row["toks"] = row["n"] = None
                out.append(row)
            yield from pa.Table.from_pylist(out, schema=_arrow()).to_batches(max_chunksize=64)

    return run


def _summed(table: pa.Table) -> pa.Table:
    """One block: sum pieces x frequency over each document's row of the matrix."""
    matrix, pieces = None, []
    for row in table.to_pylist():
        if row["bucket"] < 0:
            matrix = row
        else:
            pieces.append((from_varints(row["index"]), from_varints(row["counts"])))
    sizes = np.asarray(matrix["sizes"], np.int64)
    totals = np.asarray(matrix["specials"], np.int64)
    if pieces:
        of = np.zeros(sum(len(i) for i, _ in pieces), np.int64)
        for i, n in pieces:
            of[i] = n
        steps, often = from_varints(matrix["index"]), from_varints(matrix["counts"])
        run = np.cumsum(steps)
        ends = np.cumsum(sizes)
        # Each document's positions start from 0 again.
        before = np.concatenate(([0], run))[ends - sizes]
        sums = np.concatenate(([0], np.cumsum(of[run - np.repeat(before, sizes)] * often)))
        totals = totals + sums[ends] - sums[ends - sizes]
    return pa.table({
        "doc_id": pa.array(matrix["ids"], pa.int64()), "n_bytes": pa.array(matrix["lengths"], pa.int64()), "n_tokens": pa.array(totals, pa.int64()),
    })


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` for the ``tokenizers`` file ``vocabulary``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs, "doc_id").mapInArrow(_matrix(vocabulary, buckets), _SCHEMA)
    pieces = rows.repartition(buckets, "key").mapInArrow(_counted(vocabulary), _SCHEMA)
    return pieces.groupBy("block").applyInArrow(_summed, "doc_id long, n_bytes long, n_tokens long")
