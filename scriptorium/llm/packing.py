"""Best-two-fit packing of token sequences.

Texts are encoded where they are read; only piece lengths and digests move on.
Pieces shorter than a sequence are dealt by hash to packing groups of a set
number of text bytes, so a group fits one task at any input size and each group
ends with at most a few open sequences.  In a group, each sequence is filled
greedily with the longest piece that fits; then its smallest piece gives way to
the two unpacked pieces that fill the gap so opened best, if they fill it
better.  Lengths are small numbers, so the pool is a count per length and one
bit mask of the lengths left.

The vocabulary splits at white space first, so a word between blanks has the
same ids everywhere.  A block's distinct words are looked up once, in a bounded
table per worker, and their ids are put in place by Arrow.

Cases: a null or empty text is its end token alone.  Repeated rows and repeated
or null ids are packed row by row.  A text longer than a sequence is cut; a
full piece is a sequence by itself.
Building the frame runs Spark jobs and lowers the session's Arrow batch size.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blocks, bounded_batches, texts, total_bytes

GROUP_BYTES = 128 << 20  # text bytes of a packing group
BLOCK = 4 << 20  # text bytes that are encoded at a time
KNOWN_WORDS = 1 << 17  # words that a worker remembers, and as many that it met before them
LONGEST = 64  # characters of a word that is remembered

# Letters that are one character in every normal form but case, and words of them with signs behind.
SMALL = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, (*range(0xDF, 0xF7), *range(0xF8, 0x100))))
_CUT = r"^(?P<stem>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<signs>[!-&(-/:-@\[-`{-~]*)$"


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _packed_ids(ids: list[int]) -> bytes:
    # struct packs a few numbers faster than numpy.
    return struct.pack(f"<{len(ids)}I", *ids)


def _encoder(path: str):
    """A function: the ids of a word as bytes.

    A word of small letters that the normalizer leaves alone is one pre-token, so
    the vocabulary's model gets it at once; others go through the whole tokenizer,
    as do all where the splitter or an added token does otherwise.
    """
    tokenizer = _tokenizer(path)
    normal, model = tokenizer.normalizer, tokenizer.model
    parts = lambda w: [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(w)] if tokenizer.pre_tokenizer else [w]
    small = [c for c in SMALL if not normal or normal.normalize_str(c) == c]
    letters = {ord(c): "".join(parts(c)) for c in small}
    whole = "".join(small)
    if parts(whole) != [whole.translate(letters)] or any(t.content.isalpha() for t in tokenizer.get_added_tokens_decoder().values()):
        small = []
    plain = re.compile(f"[{''.join(small)}]+" if small else "(?!)").fullmatch

    def encode(word: str) -> bytes:
        if plain(word):
            return _packed_ids([t.id for t in model.tokenize(word.translate(letters))])
        return _packed_ids(tokenizer.encode(word, add_special_tokens=False).ids)

    return encode


class Words(dict):
    """Ids of each word as bytes, encoded when first asked for.

    When the table is full it becomes the old one; words that are met again move
    to the new one, so words that recur stay and the others go.  Long words are
    encoded anew each time.
    """

    def __init__(self, path: str):
        super().__init__()
        self.old: dict[str, bytes] = {}
        self._encode = _encoder(path)

    def __missing__(self, word: str) -> bytes:
        ids = self.old.pop(word, None)
        if ids is None:
            ids = self._encode(word)
            if len(word) > LONGEST:
                return ids
        if len(self) >= KNOWN_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


@functools.lru_cache(maxsize=1)
def _words(path: str) -> Words:
    return Words(path)


def _chosen(lists: pa.ListArray, at: pa.Array) -> np.ndarray:
    """The values of some lists, one list after another."""
    return np.asarray(lists.take(at).flatten())


def _lists(lengths: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32), pa.array(values))


def encoded_texts(words: Words, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of all texts one after another, where each text's begin and at last their number).

    Every distinct word of the texts is looked up once.  Letters and the signs after
    them are separate pre-tokens, and case does not count.
    """
    split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    each = split.flatten().dictionary_encode()
    word = each.dictionary
    cut = pc.extract_regex(word, _CUT)
    stem = pc.if_else(cut.is_valid(), pc.utf8_lower(cut.field("stem")), word)
    part = pa.concat_arrays([stem, pc.if_else(cut.is_valid(), cut.field("signs"), "")]).dictionary_encode()
    ids = [words[w] for w in part.dictionary.to_pylist()]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    # Both parts of a word one after the other, then the words as they stand in the texts.
    pairs = np.asarray(part.indices).reshape(2, -1).T.ravel()
    of_word = lengths[pairs].reshape(-1, 2).sum(1)
    own = _lists(of_word, _chosen(_lists(lengths, np.frombuffer(b"".join(ids), "<u4")), pa.array(pairs)))
    ends = np.concatenate(([0], np.cumsum(of_word[np.asarray(each.indices)])))
    return _chosen(own, each.indices), ends[np.concatenate(([0], np.cumsum(np.asarray(split.value_lengths()))))]


def encoded(words: Words, text: str) -> bytes:
    """The ids of a text as little-endian 32-bit numbers."""
    return encoded_texts(words, pa.array([text]))[0].astype("<u4").tobytes()


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, group long"


def _pieces(path: str, end: int, most: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tail, full = _words(path), np.uint32(end).astype("<u4").tobytes(), 0
        first = (TaskContext.get().partitionId() << 33) + 1
        for table in blocks(batches, limit=BLOCK):
            out = []
            ids, bounds = encoded_texts(words, table["text"].combine_chunks())
            ids = ids.astype("<u4", copy=False)
            for doc_id, a, b in zip(table["doc_id"].to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                for piece, at in enumerate(range(a, b + 1, most)):
                    stop = min(at + most, b + 1)  # the end token stands at b
                    crc = zlib.crc32(ids[at:min(stop, b)])
                    if stop > b:
                        crc = zlib.crc32(tail, crc)
                    sequence = None
                    if stop - at == most:
                        sequence, full = -(first + full), full + 1
                    out.append((doc_id, piece, at - a, stop - at, crc, sequence, (crc ^ (doc_id or 0) * 2654435761) % groups))
            columns = list(zip(*out, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), *[pa.int64()] * 5), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "group"],
            )

    return run


def best_two_fit(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Positions of ``lengths`` in sequences of at most ``most``."""
    pool: dict[int, list[int]] = {}
    for i, n in enumerate(lengths.tolist()):
        pool.setdefault(n, []).append(i)
    left = 0
    for n in pool:
        left |= 1 << n

    def largest(limit: int) -> int:
        return (left & ((1 << (limit + 1)) - 1)).bit_length() - 1 if limit > 0 else -1

    def take(n: int) -> int:
        nonlocal left
        at = pool[n].pop()
        if not pool[n]:
            left &= ~(1 << n)
        return at

    def give(n: int, at: int) -> None:
        nonlocal left
        pool[n].append(at)
        left |= 1 << n

    def two(limit: int, least: int) -> tuple[int, int] | None:
        """Two lengths left whose sum is the largest over ``least`` and at most ``limit``."""
        best, found, a = least, None, largest(limit)
        while a > 0 and 2 * a > best:
            b = largest(min(a, limit - a))
            if b == a and len(pool[a]) < 2:
                b = largest(min(a - 1, limit - a))
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == limit:
                    break
            a = largest(a - 1)
        return found

    bins = []
    while left:
        gap, own = most, []
        while (n := largest(gap)) > 0:
            own.append((n, take(n)))
            gap -= n
        if gap and len(own) > 1:
            n, at = own[-1]  # filled from the longest down: the last is the smallest
            if pair := two(gap + n, n):
                own[-1:] = [(m, take(m)) for m in pair]
                give(n, at)
        bins.append([at for _, at in own])
    return bins


def _packed(most: int):
    def run(table: pa.Table) -> pa.Table:
        lengths = np.asarray(table["length"])
        sequence = np.array(table["sequence_id"].fill_null(0).to_numpy())
        offset = np.zeros(len(lengths), np.int64)
        loose = np.flatnonzero(np.asarray(table["sequence_id"].is_null()))
        first = int(table["group"][0].as_py()) << 32
        for k, own in enumerate(best_two_fit(lengths[loose], most)):
            at = loose[own]
            sequence[at] = first + k
            offset[at] = np.cumsum(lengths[at]) - lengths[at]
        kept = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def packed(docs: DataFrame, vocabulary: str, end: int = 0, most: int = 2048) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    ``vocabulary`` is a ``tokenizers`` file whose splitter never joins what a
    blank or a line end parts.  ``end`` follows each text's ids.
    """
    bounded_batches(docs.sparkSession)
    whole = texts(docs, "doc_id")
    groups = total_bytes(whole) // GROUP_BYTES + 1
    pieces = whole.mapInArrow(_pieces(vocabulary, end, most, groups), _PIECE)
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return pieces.groupBy("group").applyInArrow(_packed(most), out)
