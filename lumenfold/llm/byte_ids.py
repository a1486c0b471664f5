"""Token ids of texts by a public byte-level tokenizer; ids of stretches that a worker has met are remembered.

Such a tokenizer first cuts a text into letters, digits, signs (each with the space before them) and white space, and
no token reaches over a cut. Places where letters or signs of these alphabets end, and those before the last character
of a run of white space, are certainly cuts. Between two such places a text is encoded on its own, with the result it
has inside the whole text, and most stretches occur again and again; the tokenizer sees only those that are new.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as the tokenizer's pattern knows it (fixed value: the White_Space characters of Unicode).
WHITE = "\t-\r \x85\xa0  -     　"
_NO_SPACE = WHITE.replace(" ", "")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Signs that begin no contraction.
_SIGNS = r"!-&(-/:-@\[-`{-~"
_GAP = f"[{WHITE}]+(?=[{WHITE}][^{WHITE}])|[{_NO_SPACE}](?=[^{WHITE}])| ?[^{WHITE}]+|[{WHITE}]+"
_STRETCH = re.compile(f" ?[{_LETTERS}]+(?=['{_SIGNS}{WHITE}]|\\Z)| ?[{_SIGNS}]+(?=[{WHITE}A-Za-z]|\\Z)|{_GAP}")
#: Where a long text may be cut: at a single space between other characters.
_CUT = re.compile(f"(?<=[^{WHITE}]) (?=[^{WHITE}])")
#: Texts with a space before white space or at their end are cut into stretches one by one.
_ODD_SPACE = f" [{WHITE}]| $"
#: Stretches, and ids of them, that a worker process remembers before it starts anew (a batch may add its own).
REMEMBERED, _REMEMBERED_IDS = 600_000, 8_000_000
#: Characters that are encoded at a time, and new stretches that the tokenizer gets as one text.
_AT_A_TIME, _JOINED = 1 << 22, 256
_HELD: dict[str, ByteIds] = {}


class ByteIds:
    """Encodes texts without adding special tokens; those that stand in a text count, unless ``plain``."""

    def __init__(self, model: str, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core
        from tokenizers import Tokenizer

        made = json.loads(model)
        if made["normalizer"] or made["pre_tokenizer"]["type"] != "ByteLevel" or made["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a byte-level tokenizer without a leading space")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in made["added_tokens"]):
            raise ValueError("special tokens of this tokenizer hold spaces or depend on what is beside them")
        special = sorted((t["content"] for t in made["added_tokens"]), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, special))})") if special and not plain else None
        self.odd = "|".join([_ODD_SPACE, *(map(re.escape, special) if self.special else ())])
        self.tokenizer = Tokenizer.from_str(model)
        self.tokenizer.encode_special_tokens = plain
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes that an id stands for: a token's name has a character for each.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for name, k in vocabulary.items():
            self.bytes_of[k] = len(name)
        for token in made["added_tokens"]:
            self.bytes_of[token["id"]] = len(token["content"].encode())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.bounds = np.empty(0, np.uint32), np.zeros(1, np.int64)

    @classmethod
    def of_worker(cls, model: str) -> ByteIds:
        """The encoder that this process holds for the model; made at its first use."""
        if model not in _HELD:
            _HELD.clear()
            _HELD[model] = cls(model)
        return _HELD[model]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text as unsigned 32-bit numbers; null is empty. Short texts go together, a long one in parts."""
        texts = texts.fill_null("")
        upto = np.append(0, np.cumsum(pc.utf8_length(texts).to_numpy()))
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + _AT_A_TIME, "right")) - 1)
            if upto[end] - upto[at] > _AT_A_TIME:
                yield np.concatenate([next(self._together(pa.array([part]))) for part in _parts(texts[at].as_py())])
            else:
                yield from self._together(texts.slice(at, end - at))
            at = end

    def _together(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Each different stretch between spaces is cut once, and each different one of letters or signs looked up once."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        coded, ends = split.flatten().dictionary_encode(), np.cumsum(pc.list_value_length(split).to_numpy())
        units = [" " + s for s in _strings(coded.dictionary)]
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # The first stretch of a text follows no space.
        starts = np.append(0, ends)[:-1]
        first = coded.dictionary.take(coded.indices.take(pa.array(starts))).to_pylist()
        codes[starts] = np.arange(len(units), len(units) + len(first))
        units += first
        words: list[str] = []
        upto = [0]
        for unit in units:
            words += _STRETCH.findall(unit)
            upto.append(len(words))
        for text in texts.filter(pa.array(odd)).to_pylist():
            words += self._stretches(text)
            upto.append(len(words))
        flat, bounds = self._looked_up(words)
        unit_bounds = bounds[upto]
        ids, plain_ends = _gathered(flat, unit_bounds, codes)
        plain_bounds = np.append(0, plain_ends)[np.append(0, ends)]
        plain, others = 0, len(units)
        for is_odd in odd.tolist():
            if is_odd:
                yield flat[unit_bounds[others] : unit_bounds[others + 1]]
                others += 1
            else:
                yield ids[plain_bounds[plain] : plain_bounds[plain + 1]]
                plain += 1

    def _stretches(self, text: str) -> list[str]:
        """The stretches of any text; it is cut at special tokens before anything else."""
        parts = self.special.split(text) if self.special else [text]
        return [s for k, part in enumerate(parts) for s in ([part] if k % 2 else _STRETCH.findall(part))]

    def _looked_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words`` one after the other, and where those of each begin and end."""
        if len(self.known) >= REMEMBERED or len(self.ids) >= _REMEMBERED_IDS:
            self._forget()
        coded = pa.array(words, pa.string()).dictionary_encode()
        different = _strings(coded.dictionary)
        at = np.fromiter(map(self.known.get, different, itertools.repeat(-1)), np.int64, len(different))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            first = len(self.known)
            # Those that begin with one space and end without stay apart when they are joined.
            spaced, others = [], []
            for k in missing.tolist():
                word = different[k]
                (spaced if word[0] == " " != word and not word[1].isspace() and not word[-1].isspace() else others).append(k)
            order = spaced + others
            new = [different[k] for k in order]
            self._learn(new[: len(spaced)], new[len(spaced) :])
            at[order] = np.arange(first, first + len(new))
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
        ids, ends = _gathered(self.ids, self.bounds, at[coded.indices.to_numpy(zero_copy_only=False)])
        return ids, np.append(0, ends)

    def _learn(self, spaced: list[str], others: list[str]) -> None:
        """Add the ids of new stretches."""
        joined = ["".join(spaced[k : k + _JOINED]) for k in range(0, len(spaced), _JOINED)]
        encoded = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([*joined, *others], add_special_tokens=False)]
        together = np.concatenate([np.empty(0, np.uint32), *encoded[: len(joined)]])
        sizes = pc.binary_length(pa.array(spaced, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.searchsorted(np.cumsum(self.bytes_of[together]), np.cumsum(sizes)) + 1
        ends = np.append(ends, len(together) + np.cumsum([len(e) for e in encoded[len(joined) :]], dtype=np.int64))
        self.bounds = np.append(self.bounds, self.bounds[-1] + ends)
        self.ids = np.concatenate([self.ids, *encoded])


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _gathered(flat: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``codes`` of ``flat`` one after the other, and where each ends."""
    lengths = np.diff(bounds)[codes]
    ends = np.cumsum(lengths)
    shift = np.repeat(bounds[:-1][codes] - (ends - lengths), lengths)
    return flat[np.arange(len(shift)) + shift], ends


def _parts(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        place = _CUT.search(text, at + _AT_A_TIME)
        end = place.start() if place else len(text)
        yield text[at:end]
        at = end
