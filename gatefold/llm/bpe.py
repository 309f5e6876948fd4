"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a piece has one last token in its BPE encoding. It is the one token that ends there
and that may follow the last token of the prefix before it, so one table of last tokens is filled
from left to right and the ids are read off by back-pointers: time is linear in the piece, whatever
its length. Tokens that end at a place come from a suffix automaton of the vocabulary; whether a
token may follow another is a walk over the merges at their border, remembered per pair.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, picked, utf8

# Fixed value: the pieces a text is cut into, for text whose other scripts stand as q, 0, blank and !.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)

ENCODED = "doc_id long, n_tokens long, ids array<int>, decoded string"

_NEVER = 1 << 62
_MOST_PIECES = 600_000
_LONG_PIECE = 64
_MOST_PAIRS = 400_000
_GROUP_BYTES = 2 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    place = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}
    return [chr(place[b]) for b in range(256)]


class SuffixAutomaton:
    """All substrings of a set of symbol sequences; built once, then read as flat arrays."""

    def __init__(self, words: list[tuple[int, ...]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for word in words:
            last = 0
            for symbol in word:
                last = self._extend(last, symbol)

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _divided(self, at: int, symbol: int) -> int:
        """The state of exactly one symbol more than ``at``, split off if it is shared with longer ones."""
        to = self.next[at][symbol]
        if self.length[to] == self.length[at] + 1:
            return to
        part = self._state(self.length[at] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = part
        while at >= 0 and self.next[at].get(symbol) == to:
            self.next[at][symbol] = part
            at = self.link[at]
        return part

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            return self._divided(last, symbol)
        made = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = made
            at = self.link[at]
        if at >= 0:
            self.link[made] = self._divided(at, symbol)
        return made


class Vocabulary:
    """Merges of a byte-level BPE file with word ends, compiled for prefix-wise encoding.

    Holds arrays and lists that grow with the vocabulary only; the driver compiles it once and
    ships it to the tasks.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        ids = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max(max(ids.values()), *self.specials.values(), 0)
        self.tokens = [""] * self.size
        for token, k in [*ids.items(), *self.specials.items()]:
            self.tokens[k] = token
        alphabet = byte_alphabet()
        self.inner = [ids[c] for c in alphabet]
        self.final = [ids[c + end] for c in alphabet]
        # parts[t] and born[t]: the merge that makes t and its rank; rank[pair]: the same by pair.
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        self.rank: dict[int, int] = {}
        spelled: dict[int, tuple[int, ...]] = {s: (s,) for s in [*self.inner, *self.final]}
        for k, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made = ids[a + b]
            left, right = ids[a], ids[b]
            self.rank[left * self.size + right] = k
            if made not in self.born:
                self.parts[made], self.born[made] = (left, right), k
                spelled[made] = spelled[left] + spelled[right]
        self._spines: tuple[dict, dict] = ({}, {})
        self._follows: dict[int, bool] = {}
        whole: dict[int, bool] = {}
        for token in sorted(spelled, key=lambda t: self.born.get(t, -1)):
            whole[token] = token not in self.parts or (
                all(whole[p] for p in self.parts[token])
                and self._first_crossing(*self.parts[token]) == self.born[token]
            )
        self.sizes = [0] * self.size
        for token, word in spelled.items():
            self.sizes[token] = len(word)
        self.shown = [t + " " for t in self.tokens]
        self._compile({t: w for t, w in spelled.items() if whole[t]})

    def _compile(self, words: dict[int, tuple[int, ...]]) -> None:
        graph = SuffixAutomaton(list(words.values()))
        moves = [(s * self.size + c, to) for s, out in enumerate(graph.next) for c, to in out.items()]
        self.move_keys, self.move_to = np.array(moves, dtype=np.int64).T.copy()
        self.link = np.array(graph.link, dtype=np.int32)
        self.length = np.array(graph.length, dtype=np.int32)
        ends: dict[int, list[tuple[int, int]]] = {}
        for token, word in words.items():
            state = 0
            for symbol in word:
                state = graph.next[state][symbol]
            ends.setdefault(state, []).append((len(word), token))
        self.ends = {s: tuple(sorted(found, reverse=True)) for s, found in ends.items()}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_spines", "_follows")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._spines, self._follows = ({}, {}), {}

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at the left (0) or right (1) border of a token while it is built: each part
        with the rank of the merge that ends it, first the single symbol, last the token itself."""
        known = self._spines[side]
        if token not in known:
            chain, until = [], _NEVER
            part: int | None = token
            while part is not None:
                chain.append((part, until))
                until = self.born.get(part, -1)
                part = self.parts[part][side] if part in self.parts else None
            known[token] = chain[::-1]
        return known[token]

    def _first_crossing(self, left: int, right: int) -> int | None:
        """Rank of the first merge across the border of two tokens, None if there is none.

        Where a merge across competes with an equal one inside, the more left one comes first.
        """
        lefts, rights = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = lefts[i], rights[j]
            rank = self.rank.get(x * self.size + y)
            if rank is not None and rank < x_ends and rank <= y_ends:
                return rank
            if x_ends == y_ends == _NEVER:
                return None
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def follows(self, left: int, right: int) -> bool:
        """Whether BPE leaves two adjacent tokens as they are."""
        key = left * self.size + right
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) >= _MOST_PAIRS:
                self._follows.clear()
            known = self._follows[key] = self._first_crossing(left, right) is None
        return known


class Encoder:
    """Ids of texts under a vocabulary; remembers the pieces of late."""

    _of_process: dict[str, Encoder] = {}

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.moves = dict(zip(v.move_keys.tolist(), v.move_to.tolist(), strict=True))
        self.link, self.length = v.link.tolist(), v.length.tolist()
        self.found: dict[int, tuple[tuple[int, int], ...]] = {-1: ()}
        self.special = re.compile("(" + "|".join(map(re.escape, v.specials)) + ")") if v.specials else None
        self.kinds = _Kinds()
        self.ids_of: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        """Ids of pieces, four bytes each; the special strings stand among them as they are cut out."""
        self.ids_of.clear()
        self.ids_of.update((s, array("i", [k]).tobytes()) for s, k in self.vocabulary.specials.items())

    @classmethod
    def of(cls, path: str, vocabulary: Vocabulary) -> Encoder:
        """The encoder of this worker process, kept between its tasks."""
        if path not in cls._of_process:
            cls._of_process[path] = cls(vocabulary)
        return cls._of_process[path]

    def _ending(self, state: int) -> tuple[tuple[int, int], ...]:
        """(length, token) of all tokens that are suffixes of a state's strings, longest first."""
        passed = []
        while state not in self.found:
            passed.append(state)
            state = self.link[state]
        for s in reversed(passed):
            own = self.vocabulary.ends.get(s, ())
            self.found[s] = own + self.found[self.link[s]] if own else self.found[self.link[s]]
        return self.found[passed[0] if passed else state]

    def encode_pieces(self, pieces: Iterable[bytes]) -> Iterator[list[int]]:
        """Ids of each piece, in order.

        What the table holds for a prefix depends on the prefix alone, so a piece goes on from what it
        shares with the one before; sorted pieces share most.
        """
        v, moves, found, known = self.vocabulary, self.moves, self.found, self.vocabulary._follows
        size, sizes, inner, final = v.size, v.sizes, v.inner, v.final
        states, helds, last, before = [0], [0], [0], b""
        for data in pieces:
            n = len(data)
            most, shared = min(n, len(before)) - 1, 0
            while shared < most and data[shared] == before[shared]:
                shared += 1
            del states[shared + 1 :], helds[shared + 1 :], last[shared + 1 :]
            state, held = states[-1], helds[-1]
            for i in range(shared + 1, n + 1):
                symbol = final[data[i - 1]] if i == n else inner[data[i - 1]]
                to = moves.get(state * size + symbol)
                while to is None:
                    state = self.link[state]
                    held = self.length[state]
                    to = moves.get(state * size + symbol)
                state, held = to, held + 1
                for length, token in found.get(state) or self._ending(state):
                    if length <= held:
                        at = i - length
                        if not at:
                            break
                        fits = known.get(last[at] * size + token)
                        if fits or fits is None and v.follows(last[at], token):
                            break
                states.append(state)
                helds.append(held)
                last.append(token)
            ids, at = [], n
            while at:
                token = last[at]
                ids.append(token)
                at -= sizes[token]
            ids.reverse()
            before = data
            yield ids

    def cut(self, data: bytes) -> list[str]:
        """Pieces and special strings of a text."""
        text = utf8(data)
        if not self.special or "<" not in text:
            return self._plain(text)
        parts: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            parts += [part] if k % 2 else self._plain(part)
        return parts

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return PIECE.findall(text.lower())
        text = normalized(text)
        return [text[m.start() : m.end()] for m in PIECE.finditer(text.translate(self.kinds))]

    def texts(self, datas: list[bytes]) -> Iterator[tuple[bytes, str]]:
        """Ids, four bytes each, and decoded form of whole texts."""
        cut = [self.cut(data) for data in datas]
        new = {p for pieces in cut for p in pieces if p not in self.ids_of}
        if len(self.ids_of) + len(new) > _MOST_PIECES:
            self._forget()
            new = {p for pieces in cut for p in pieces if p not in self.ids_of}
        ordered = sorted(new)
        for piece, ids in zip(ordered, self.encode_pieces(p.encode() for p in ordered), strict=True):
            self.ids_of[piece] = array("i", ids).tobytes()
        shown = self.vocabulary.shown.__getitem__
        for pieces in cut:
            data = b"".join(map(self.ids_of.__getitem__, pieces))
            yield data, "".join(map(shown, array("i", data)))[:-1]
        for piece in ordered:
            if len(piece) > _LONG_PIECE:
                del self.ids_of[piece]


class _Kinds(dict):
    """Stand-in per character outside ASCII: letter q, number 0, white space, anything else !.

    Characters newer than Python's tables are classed by the library whose results are to be met.
    """

    def __missing__(self, point: int) -> int:
        if point < 128:
            kind = point
        else:
            category = unicodedata.category(chr(point))
            if category == "Cn":
                category = _newer_category(chr(point))
            kind = ord({"L": "q", "N": "0", "Z": " "}.get(category[0], " " if point == 0x85 else "!"))
        self[point] = kind
        return kind


def _newer_category(char: str) -> str:
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    for category in ("L", "N"):
        kept = Split(Regex(rf"\p{{{category}}}"), "removed", invert=True)
        if kept.pre_tokenize_str(char):
            return category
    return "Cn"


@lru_cache(maxsize=1)
def _normalizers() -> tuple:
    from tokenizers.normalizers import NFC, Lowercase

    return NFC(), Lowercase()


def normalized(text: str) -> str:
    """Composed and lower case, by the Unicode tables of the library whose results are to be met."""
    composed, lowered = _normalizers()
    return lowered.normalize_str(composed.normalize_str(text))


def decode_ids(ids: list[int], tokens: list[str]) -> str:
    """The tokens of the ids joined by blanks, as a vocabulary without decoder is decoded."""
    return " ".join([tokens[i] for i in ids])


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The compiled vocabulary of a tokenizer file."""
    return Vocabulary(path)


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_py() or b""


def encode(
    docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids, decoded``.

    A narrow map without shuffle. Null and empty texts have no ids; every row is encoded, repeated
    ones too; a null doc_id stays null; other input columns are ignored. A long text needs memory for
    itself and its ids. Special strings in a text give their id, as in the library.
    """
    compiled = vocabulary(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer_path, compiled)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = zip(batch.column(0).to_pylist(), map(_bytes, texts), strict=True)
            for part in chunks(rows, lambda r: len(r[1]), limit=_GROUP_BYTES):
                ids, shown = zip(*encoder.texts([data for _, data in part]), strict=True)
                counts = [len(i) // 4 for i in ids]
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), dtype="<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key for key, _ in part], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())),
                        pa.array(shown, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    rows = picked(docs, doc_id=doc_id, text=text)
    return rows.mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``: the text of every row's ids; null ids count as none."""
    tokens = vocabulary(tokenizer_path).tokens
    schema = encoded.drop("decoded").schema
    place = schema.fieldNames().index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shown = [decode_ids(v or [], tokens) for v in batch.column(place).to_pylist()]
            columns = [*batch.columns, pa.array(shown, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "decoded"])

    return encoded.drop("decoded").mapInArrow(run, schema.add("decoded", "string"))
