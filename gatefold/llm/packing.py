"""Packing by power-of-two decomposition.

A document of n tokens is cut into floor(n / max_len) full pieces and one piece per set bit of
the rest, longest first. Every piece has a power-of-two length and is a sequence of its own, so
no sequence crosses documents, nothing is padded and batches are drawn from one length bucket.
The cut needs no other document: packing is a narrow map over the scan without any shuffle.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import picked

END_ID = 2
MAX_LEN = 4096
_CACHE_WORDS = 1_000_000
# Text whose words are looked up together: bounds what a task holds beside the table of words.
_TEXT_BYTES = 8 << 20

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, bucket int, tokens binary"
)


class WordTokens(dict):
    """Little-endian ids of white-space separated words, each encoded once per worker process.

    Right for tokenizers that drop white space and never merge across it: the ids of a text are
    then the ids of its words. Words are looked up with A-Z lowered, as the tokenizer does itself;
    texts that might hold its special strings are looked up as they are.
    """

    _of_process: dict[str, WordTokens] = {}

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        shape = json.loads(self.tokenizer.to_str())
        self.specials = [added["content"] for added in shape["added_tokens"]]
        # cuts and merges words that are normalised already and hold no special string
        self.plain = Tokenizer.from_str(json.dumps(shape | {"normalizer": None, "added_tokens": []}))

    @classmethod
    def of(cls, path: str) -> WordTokens:
        """The table of this worker process, kept between its tasks."""
        if path not in cls._of_process:
            cls._of_process[path] = cls(path)
        return cls._of_process[path]

    def ids(self, text: bytes) -> bytes:
        """Ids of a text, four bytes each."""
        return self.ids_of(pa.array([text], pa.binary()))[0].tobytes()

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and where each text begins and the last one ends.

        Every distinct word of the texts is looked up once.
        """
        texts = texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string())
        spelled = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        lists = pc.ascii_split_whitespace(spelled)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_pylist()
        known = list(map(self.get, words))
        new = [w for w, ids in zip(words, known, strict=True) if ids is None]
        if new:
            if len(self) + len(new) > _CACHE_WORDS:  # what these texts use stays
                self.clear()
                self.update((w, ids) for w, ids in zip(words, known, strict=True) if ids is not None)
            self._learn(new)
            known = [self[w] if ids is None else ids for w, ids in zip(words, known, strict=True)]
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        at = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[at])])
        # a word's ids, wherever it stands: its place among the known ids, and on from there
        shift = (np.cumsum(sizes) - sizes)[at] - ends[:-1]
        ids = np.frombuffer(b"".join(known), dtype="<u4")[np.repeat(shift, sizes[at]) + np.arange(ends[-1])]
        return ids, ends[lists.offsets.to_numpy()]

    def _learn(self, words: list[bytes]) -> None:
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            for word, ids in zip(part, self._encoded([w.decode("utf-8", "replace") for w in part]), strict=True):
                self[word] = array("I", ids).tobytes()

    def _encoded(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each word. Words are normalised together, which costs a tenth of one by one, unless one of them
        holds white space of another kind or a special string."""
        joined, coder = " ".join(words), self.tokenizer
        if coder.normalizer is not None and all(map(str.isprintable, words)):
            normal = coder.normalizer.normalize_str(joined)
            cut = normal.split(" ")
            if len(cut) == len(words) and not any(s in joined or s in normal for s in self.specials):
                words, coder = cut, self.plain
        return (e.ids for e in coder.encode_batch_fast(words, add_special_tokens=False))


def binary_cuts(n: int, max_len: int = MAX_LEN) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full pieces, then the set bits, falling."""
    start = 0
    while n - start >= max_len:
        yield start, max_len
        start += max_len
    bit = max_len >> 1
    while bit:
        if (n - start) & bit:
            yield start, bit
            start += bit
        bit >>= 1


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    max_len: int = MAX_LEN,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, bucket, tokens, sequence_id, offset``.

    ``tokens`` holds the ids as little-endian unsigned 32-bit integers, ``bucket`` is log2 of the
    length, ``offset`` is 0 because each piece fills its sequence. Null or empty text is the end
    id alone; each of several equal rows is packed; a null doc_id stays null. Very long texts are
    tokenized by their distinct words with memory for one text. Other input columns are ignored.
    """
    if max_len & (max_len - 1) or max_len < 1:
        raise ValueError("max_len must be a power of two")
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordTokens.of(tokenizer_path)
        names = ["doc_id", "start", "length", "doc_tokens", "bucket", "tokens"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        out: list[list] = [[] for _ in names]
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal out, size
            made = pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, types, strict=True)], names=names
            )
            out, size = [[] for _ in names], 0
            return made

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1).fill_null("")
            texts = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
            bytes_before = np.cumsum(pc.binary_length(texts).to_numpy()) // _TEXT_BYTES
            bounds = [0, *(np.flatnonzero(np.diff(bytes_before)) + 1).tolist(), len(keys)]
            for low, high in pairwise(bounds):
                ids, starts = known.ids_of(texts.slice(low, high - low))
                for key, first, last in zip(keys[low:high], starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    data = ids[first:last].tobytes() + end
                    total = len(data) // 4
                    for start, length in binary_cuts(total, max_len):
                        piece = data[4 * start : 4 * (start + length)]
                        row = (key, start, length, total, length.bit_length() - 1, piece)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                    size += len(data)
                    if size > 4 << 20:
                        yield flush()
        if out[0]:
            yield flush()

    pieces = picked(docs, doc_id=doc_id, text=text).mapInArrow(cut, PIECES)
    return pieces.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )

