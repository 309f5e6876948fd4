"""Chat formatting by token-level assembly.

Each turn is encoded on its own; control tokens are reserved ids above the vocabulary that no
text can produce. Control strings that occur inside a text are escaped reversibly, so the rendered
string can be read back too. The loss mask comes from +1/-1 marks and a prefix sum.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, partitions_of, picked, utf8

# The control strings of the template, in the order of their reserved ids.
CONTROLS = (
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]",
)
# Opening and closing control per role; other roles are spelled out.
ROLES = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
}
TRAINED_ROLE = "assistant"

_ESCAPABLE = re.compile("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROLS))
_ESCAPED = re.compile("|".join(re.escape(c[0]) + r"\\+" + re.escape(c[1:]) for c in CONTROLS))

TURN = (
    "conv_id long, turn long, rendered string, input_ids array<int>, loss_mask array<byte>"
)
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def escape(text: str) -> str:
    """Put one more backslash after the first character of every control string."""
    return _ESCAPABLE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """Undo ``escape`` exactly."""
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


class ByteCodec:
    """A lossless byte-level BPE with the control strings as ids past its vocabulary."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding(
            "chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.first = max(ranks.values()) + 1
        self.reserved = {c: self.first + k for k, c in enumerate(CONTROLS)}

    def encode(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(text)

    def decode(self, ids) -> str:
        return self.coder.decode_bytes(list(ids)).decode("utf-8")


def assemble(codec: ByteCodec, role: str, text: str) -> tuple[str, list[int], np.ndarray]:
    """Rendered string, ids and loss mask of one turn."""
    reserved, safe = codec.reserved, escape(text)
    if role in ROLES:
        opening, closing = ROLES[role]
        rendered, ids = opening, [reserved[opening]]
    else:
        closing, name = "[END]", escape(role)
        rendered = f"[ROLE]{name}[/ROLE]"
        ids = [reserved["[ROLE]"], *codec.encode(name), reserved["[/ROLE]"]]
    body = codec.encode(safe)
    marks = np.zeros(len(ids) + len(body) + 2, dtype=np.int8)
    if role == TRAINED_ROLE:
        marks[len(ids)] += 1
        marks[len(ids) + len(body)] -= 1
    ids = [*ids, *body, reserved[closing]]
    return rendered + safe + closing, ids, np.cumsum(marks, dtype=np.int8)[: len(ids)]


def read_back(codec: ByteCodec, ids: list[int], mask: np.ndarray) -> Iterator[tuple[str, str, str]]:
    """(role, text, text under the mask) per turn, from ids and mask alone."""
    ids = np.asarray(ids, dtype=np.int64)
    names = {v: k for k, v in codec.reserved.items()}
    opening = {v[0]: k for k, v in ROLES.items()}
    cuts = np.flatnonzero(ids >= codec.first)
    at = 0
    while at < len(cuts):
        control = names[int(ids[cuts[at]])]
        if control == "[ROLE]":
            role = unescape(codec.decode(ids[cuts[at] + 1 : cuts[at + 1]]))
            at += 1
        else:
            role = opening[control]
        body = slice(cuts[at] + 1, cuts[at + 1])
        seen = ids[body][np.asarray(mask[body], dtype=bool)]
        yield role, unescape(codec.decode(ids[body])), unescape(codec.decode(seen))
        at += 2


def format_turns(
    conversations: DataFrame,
    tokenizer_path: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per turn: rendered string, ids and loss mask; a conversation is their
    concatenation in (turn, role, text) order.

    A narrow map: a conversation with any number of turns is encoded by many tasks. Null role and
    null text count as empty, an unknown role is written out by name, null turns come first,
    repeated rows are turns of their own, rows with a null conv_id form one conversation of that
    id. Other input columns are ignored.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ByteCodec(tokenizer_path)
        for batch in batches:
            keys, turns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            roles = batch.column(2).cast(pa.binary())
            texts = batch.column(3).cast(pa.binary())
            rows = (
                (keys[i], turns[i], *assemble(codec, utf8(roles[i].as_py()), utf8(texts[i].as_py())))
                for i in range(batch.num_rows)
            )
            for part in chunks(rows, lambda r: 8 * len(r[3])):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in part], pa.int64()),
                        pa.array([r[1] for r in part], pa.int64()),
                        pa.array([r[2] for r in part], pa.string()),
                        pa.array([r[3] for r in part], pa.list_(pa.int32())),
                        pa.array([r[4] for r in part], pa.list_(pa.int8())),
                    ],
                    names=["conv_id", "turn", "rendered", "input_ids", "loss_mask"],
                )

    rows = picked(conversations, conv_id=conv_id, turn=turn, role=role, text=text)
    return rows.mapInArrow(encode, TURN)


def conversation_digests(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Read every conversation back from its ids and masks and digest it, one row each.

    Turns are dealt out by conversation and sorted; digests are updated turn by turn, so a task
    holds one turn at a time whatever the length of the conversation.
    """
    spark = formatted.sparkSession

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ByteCodec(tokenizer_path)
        current, done = None, []

        def row():
            key, n, turns, chars, loss, formatted_chars = current
            return key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted_chars

        def table(rows):
            names = [f.split()[0] for f in DIGEST.split(", ")]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names
            )

        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            for i in range(batch.num_rows):
                key = columns["conv_id"][i].as_py()
                if current is None or current[0] != key:
                    if current is not None:
                        done.append(row())
                    current = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = columns["input_ids"][i].values.to_numpy(zero_copy_only=False)
                mask = columns["loss_mask"][i].values.to_numpy(zero_copy_only=False)
                for role, text, seen in read_back(codec, ids, mask):
                    current[1] += 1
                    current[2].update(f"{role}\n{text}\n".encode())
                    current[3] += len(seen)
                    current[4].update(seen.encode())
                current[5] += len(columns["rendered"][i].as_py())
                if len(done) >= 4096:
                    yield table(done)
                    done = []
        if current is not None:
            done.append(row())
        if done:
            yield table(done)

    dealt = formatted.repartition(partitions_of(spark), F.col("conv_id"))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "rendered")
    return ordered.mapInArrow(digest, DIGEST)
