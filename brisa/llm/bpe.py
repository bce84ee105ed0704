"""Byte-pair encoding with forced boundaries, and decoding, for word vocabularies with word ends.

If no token of the vocabulary holds byte a directly before byte b, no merge can ever join what
stands on the two sides of such a pair: it is a certain cut.  A word is cut at all of these, each
fragment is encoded by itself, and the ids are put together.  Fragments are short and repeat, so
most are remembered; what is remembered is bounded.

The last byte of a word carries the word end and is a symbol of its own, so pairs before it are
kept apart from pairs inside.  Text is brought to the vocabulary's form first: strings of special
tokens are taken out, the rest is composed (NFC), white space becomes one space, and letters are
lowered one by one; words, contractions, single digits and runs of other characters are split.

Null and empty texts have no ids and decode to an empty text.  Rows are handled one by one, so rows
that repeat and extra columns change nothing.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from brisa.llm.common import slices, texts

END = "</w>"
_NONE = 1 << 60
#: Texts of settled characters only: those that are composed, and of one class in every version of
#: Unicode.  For them the vocabulary's rule for words is the pattern below, in which white space only
#: separates.  Any other text is brought to form and split by the library's own normaliser, whose
#: tables the results must follow.
_SETTLED = re.compile("[\x00-\u024F\u2010-\u2027\u2030-\u205E\u20AC]*")
_NUMBERS = "0-9\xB2\xB3\xB9\xBC-\xBE"
_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[^\W_{_NUMBERS}]+|[{_NUMBERS}]|(?:[^\w\t-\r \x85\xA0]|_)+"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Remembered(dict):
    """Results of `make`; once there are `most`, only those asked for since are kept."""

    def __init__(self, make: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
        if len(piece) <= 64:
            self[piece] = found
        return found

    def turn(self) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()


class Vocabulary:
    """Symbols are ids; a pair of ids is looked up as one number, a << 16 | b."""

    def __init__(self, path: str, remember: int = 300_000) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*ids.items(), *self.special.items()]}
        # rank first, so that the least entry is the next merge; the id that it makes below
        self.merges = {
            ids[a] << 16 | ids[b]: rank << 16 | ids[a + b] for rank, (a, b) in enumerate(spec["model"]["merges"])
        }
        letters = byte_letters()
        self.inner_id, self.end_id = [ids[c] for c in letters], [ids[c + END] for c in letters]
        self.inside, self.at_end = joinable(ids, letters)
        special = sorted(self.special, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        self.library = Tokenizer.from_file(path)
        self.remembered = Remembered(self.word, remember)

    def fragments(self, piece: bytes) -> list[list[int]]:
        """The word's symbols, cut where no merge can reach across."""
        out, inside, last = [], self.inside, len(piece) - 1
        part = [self.inner_id[piece[0]]] if last else []
        for i in range(1, last):
            if (piece[i - 1] << 8 | piece[i]) not in inside:
                out.append(part)
                part = []
            part.append(self.inner_id[piece[i]])
        if last and (piece[-2] << 8 | piece[-1]) not in self.at_end:
            out.append(part)
            part = []
        part.append(self.end_id[piece[-1]])
        out.append(part)
        return out

    def merged(self, symbols: list[int]) -> list[int]:
        """Merge the pair of lowest rank, leftmost first, until no pair has a rank."""
        if len(symbols) > 40:
            return self.merged_long(symbols)
        get = self.merges.get
        order = [get(a << 16 | b, _NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while order and (least := min(order)) < _NONE:
            i = order.index(least)
            made = least & 0xFFFF
            symbols[i : i + 2] = [made]
            del order[i]
            if i:
                order[i - 1] = get(symbols[i - 1] << 16 | made, _NONE)
            if i < len(order):
                order[i] = get(made << 16 | symbols[i + 1], _NONE)
        return symbols

    def merged_long(self, symbols: list[int]) -> list[int]:
        """The same for long fragments, with a queue of pairs instead of repeated scans."""
        n, get = len(symbols), self.merges.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        at = list(symbols)
        queue = [(m, i, at[i], at[i + 1]) for i in range(n - 1) if (m := get(at[i] << 16 | at[i + 1]))]
        heapq.heapify(queue)
        while queue:
            m, i, a, b = heapq.heappop(queue)
            j = after[i]
            if at[i] != a or j < 0 or at[j] != b:
                continue
            at[i], at[j] = m & 0xFFFF, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := get(at[i] << 16 | at[k]):
                    heapq.heappush(queue, (m, i, at[i], at[k]))
            if (k := before[i]) >= 0 and (m := get(at[k] << 16 | at[i])):
                heapq.heappush(queue, (m, k, at[k], at[i]))
        return [s for s in at if s >= 0]

    def word(self, piece: str) -> bytes:
        """The ids of one word as 32-bit integers."""
        out = array("i")
        for part in self.fragments(piece.encode()):
            out.extend(self.merged(part))
        return out.tobytes()

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens, in the vocabulary's form."""
        if _SETTLED.fullmatch(text):
            return _SPLIT.findall(text.lower())
        form = self.library.normalizer.normalize_str(text)
        return [w for w, _ in self.library.pre_tokenizer[0].pre_tokenize_str(form)]

    def encode(self, text: str) -> np.ndarray:
        self.remembered.turn()
        out = []
        for part in self.special_split.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(array("i", [self.special[part]]).tobytes())
            else:
                out += map(self.remembered.__getitem__, self.split(part))
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def joinable(tokens: Iterable[str], letters: list[str]) -> tuple[set[int], set[int]]:
    """Pairs of bytes (a << 8 | b) that some token holds side by side: inside it, and before a word end."""
    byte = {c: b for b, c in enumerate(letters)}
    inside, at_end = set(), set()
    for token in tokens:
        ends = token.endswith(END) and len(token) > len(END)
        body = [byte[c] for c in (token.removesuffix(END) if ends else token)] if token != END else []
        pairs = [a << 8 | b for a, b in zip(body, body[1:], strict=False)]
        if ends and pairs:
            at_end.add(pairs.pop())
        inside.update(pairs)
    return inside, at_end


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    path = path or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in slices(batches):
            ids = [words.encode(t) for t in batch.column("text").to_pylist()]
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), column], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): the tokens of the ids, special ones included, joined by one space."""
    path = path or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in slices(batches):
            ids = batch.column("ids")
            flat, cuts = ids.values.to_numpy(), ids.offsets.to_pylist()
            text = [words.decode(flat[a:b].tolist()) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(text, pa.string())], ["doc_id", "ids", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
