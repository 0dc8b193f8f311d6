"""Token ids of whole texts, encoded unit by unit with the tokenizers library.

A text may be cut before a single space between two characters that are not white
space: no pre-token and no special string of the vocabularies used here reaches over
such a place. The units between these places repeat a lot, so each worker encodes a
unit once and remembers it, up to a bound; a text's ids are then gathered by numpy.
"""

from __future__ import annotations

import os
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64
SLICE_BYTES = 8 << 20  # of text encoded at once: the more, the more units repeat in it
# stands before the unit that begins a text; a text that holds it is encoded as one unit
BEGIN = "\x00\x02begin\x03"
# may follow a word inside a unit; no apostrophe, with which contractions begin
MARKS = ".,;:!?*$%&#|<>()[]{}-+=/\"~^@"
PROBES = ["the", "Überhaupt", "çà", "ſtraße", "日本語", "ñandú", "a", "thononinthhe"]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memory:
    """What is known of units: those met once go first when room is short."""

    def __init__(self) -> None:
        self._often: dict[str, bytes | None] = {}
        self._once: dict[str, bytes | None] = {}

    def look_up(self, units: list[str]) -> tuple[list[bytes | None], list[int]]:
        """The values by unit, and the places of the units that are new."""
        often, once, found, new = self._often, self._once, [], []
        if len(once) > REMEMBERED:
            once.clear()
        if len(often) > REMEMBERED:
            often.clear()
        for i, unit in enumerate(units):
            if unit in often:
                found.append(often[unit])
            elif unit in once:
                often[unit] = value = once.pop(unit)
                found.append(value)
            else:
                new.append(i)
                found.append(None)
        return found, new

    def get(self, unit: str) -> bytes | None:
        return self._often.get(unit) or self._once.get(unit)

    def keep(self, unit: str, value: bytes | None) -> None:
        if len(unit) <= LONGEST_REMEMBERED:
            self._once[unit] = value


def _joined(units: list[str]) -> list[str]:
    """Units of one text, joined again wherever a cut between two of them isn't safe."""
    out = [units[0]]
    for unit in units[1:]:
        left = out[-1]
        if left and unit and not left[-1].isspace() and not unit[0].isspace():
            out.append(unit)
        else:
            out[-1] = f"{left} {unit}"
    return out


class Encoder:
    """Ids of texts without added special ids, equal to those of each whole text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._memory = _Memory()
        self._marks: dict[str, bytes] = {}
        self._merge = self._library.model.tokenize
        # a byte-level vocabulary writes each byte as one character: itself if it prints
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in prints]
        self._characters = {b: 256 + i for i, b in enumerate(others)}
        self._words_alone = self._ids([" " + p for p in PROBES]) == [*map(self._word, PROBES)]

    def _ids(self, units: list[str]) -> list[bytes]:
        found = self._library.encode_batch_fast(units, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _word(self, word: str) -> bytes:
        """Ids of a space and letters: one pre-token, so the library's merges alone give them."""
        raw = " " + word
        raw = raw.encode().decode("latin-1").translate(self._characters)
        return array("I", [t.id for t in self._merge(raw)]).tobytes()

    def _plain(self, unit: str) -> bytes | None:
        """Ids of a space, letters and punctuation after them; None for any other unit."""
        if unit.isalpha():
            return self._word(unit)
        word = unit.rstrip(MARKS)
        if not word.isalpha():
            return None
        marks = unit[len(word) :]
        if marks not in self._marks:
            if len(self._marks) > REMEMBERED:
                self._marks.clear()
            self._marks[marks] = self._ids([marks])[0]
        return (self._memory.get(word) or self._word(word)) + self._marks[marks]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order (uint32), and n + 1 offsets by text; null is empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring(texts, BEGIN).to_numpy(False)
        marked = pc.binary_join_element_wise(pa.scalar(BEGIN), pc.if_else(odd, "", texts), "")
        lists = pc.split_pattern(marked, " ")
        units = lists.values.dictionary_encode()
        names = units.dictionary.to_pylist()
        index = units.indices.to_numpy()
        ends = lists.offsets.to_numpy()

        values, new = self._memory.look_up(names)
        safe, asked = [], []
        for i in new:
            unit = names[i]
            if self._words_alone and (ids := self._plain(unit)) is not None:
                values[i] = ids
                self._memory.keep(unit, ids)
                continue
            if unit.startswith(BEGIN):
                text = unit[len(BEGIN) :]
                fits = not (text and text[-1].isspace())
            else:
                text = " " + unit
                fits = bool(unit) and not unit[0].isspace() and not unit[-1].isspace()
            if fits:
                safe.append(i)
                asked.append(text)
            else:
                self._memory.keep(unit, None)
        for i, ids in zip(safe, self._ids(asked), strict=True):
            values[i] = ids
            self._memory.keep(names[i], ids)

        unsafe = np.fromiter((v is None for v in values), bool, len(values))
        if unsafe.any():  # texts with a cut next to other white space
            hit = np.concatenate([[0], np.cumsum(unsafe[index])])
            odd = odd | (hit[ends[1:]] > hit[ends[:-1]])
        own = [self._whole(t) for t in texts.filter(pa.array(odd)).to_pylist()]

        pool = np.frombuffer(b"".join(v or b"" for v in values), "<u4")
        sizes = np.fromiter((len(v or b"") // 4 for v in values), np.int64, len(values))
        starts = np.cumsum(sizes) - sizes
        if own:
            return _with_own(index, ends, odd, own, pool, starts, sizes)
        return _gather(index, ends, pool, starts, sizes)

    def _whole(self, text: str) -> np.ndarray:
        units = _joined(text.split(" "))
        asked = [units[0], *(" " + u for u in units[1:])]
        return np.frombuffer(b"".join(self._ids(asked)), "<u4")


def _gather(index, ends, pool, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
    length = sizes[index]
    before = np.concatenate([[0], np.cumsum(length)])
    # a slice has fewer ids than bytes: 32 bits are enough for their places
    places = np.repeat((starts[index] - before[:-1]).astype(np.int32), length)
    places += np.arange(before[-1], dtype=np.int32)
    return pool[places], before[ends]


def _with_own(index, ends, odd, own, pool, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Text by text: those marked odd take their own ids, in turn."""
    ids, taken = [], iter(own)
    for k, alone in enumerate(odd):
        part = index[ends[k] : ends[k + 1]]
        ids.append(
            next(taken)
            if alone
            else _gather(part, np.array([0, len(part)]), pool, starts, sizes)[0]
        )
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    return np.concatenate(ids), offsets


class Counter:
    """Numbers of tokens, for a vocabulary that drops white space: any space is a safe cut."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._memory = _Memory()

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens by text (int64); null is empty."""
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        units = lists.values.dictionary_encode()
        names = units.dictionary.to_pylist()
        values, new = self._memory.look_up(names)
        found = self._library.encode_batch_fast([names[i] for i in new], add_special_tokens=False)
        for i, encoding in zip(new, found, strict=True):
            values[i] = len(encoding)
            self._memory.keep(names[i], values[i])
        sizes = np.array(values, np.int64)[units.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = lists.offsets.to_numpy()
        return total[ends[1:]] - total[ends[:-1]]


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(path)


@cache
def counter(path: str) -> Counter:
    return Counter(path)
