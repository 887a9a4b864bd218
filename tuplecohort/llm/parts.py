"""Byte-level encoding of texts, and the parts between spaces that tokenizers agree on.

:class:`ByteLevel` gives the ids of the ``tokenizers`` library for a plain byte-level
tokenizer file, several times as fast: the vocabulary and its order of merges are read
from the file and applied by ``tiktoken``'s encoder.  A file of another kind, and a text
that names a special token or holds a very long run of white space, goes to the library.

A text may be cut before every space that follows a character other than white space
(:func:`cut_parts`).  A byte-level tokenizer with the usual word pattern has a pre-token
boundary there whatever stands around it, and so does a piece tokenizer none of whose
pieces holds a space after another character.
"""

from __future__ import annotations

import json
import re

import numpy as np

_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")
_LONG_SPACE = re.compile(r"\s{50000}")
#: The usual word pattern of byte-level tokenizers (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte-level spelling: a byte is itself (as a Latin-1 character) if it prints, else the next sign from U+0100.
BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
#: Longer parts (unbroken strings, encoded data) are not remembered.
LONG_PART = 64
#: What a remembered part takes beside its text and its value, in bytes.
OVERHEAD = 190


def cut_parts(text: str) -> list[str]:
    """The first part as it is, then the others without the space each begins with."""
    return text.split(" ") if _AFTER_SPACE.search(text) is None else _CUT.split(text)


class ByteLevel:
    """Encoder with a tokenizer file of the ``tokenizers`` library, equal to it.

    plain_specials: whether the names of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, plain_specials: bool = False) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain_specials
        self.special = [] if plain_specials else [x["content"] for x in spec.get("added_tokens", [])]
        self.fast = None
        if self._is_plain(spec):
            import tiktoken

            ranks = {bytes(BYTE_OF[c] for c in t): i for t, i in spec["model"]["vocab"].items()
                     if t not in {x["content"] for x in spec.get("added_tokens", [])}}
            self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _is_plain(spec: dict) -> bool:
        """No normaliser, the usual pattern, no prefix space, and merges in the order of their ids."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if spec.get("normalizer") is not None or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") is not False \
                or not pre.get("use_regex", True) or model.get("type") != "BPE" or model.get("ignore_merges") \
                or model.get("dropout") or any(x.get("lstrip") or x.get("rstrip") or x.get("single_word")
                                               for x in spec.get("added_tokens", [])):
            return False
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        return [model["vocab"].get(m) for m in merges] == list(range(256, 256 + len(merges)))

    def ids(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        if self.fast is None or any(s in text for s in self.special) or _LONG_SPACE.search(text):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


class Remembered(dict):
    """Values of parts, worked out on demand, within ``most`` bytes.

    The first parts stay for good (a frequent part comes early); a quarter of the room is for later ones, which
    are forgotten together when it is full.
    """

    def __init__(self, most: int = 128 << 20) -> None:
        super().__init__()
        self.most, self.taken, self.later_taken, self.later = most, 0, 0, {}

    def work_out(self, part: str):
        raise NotImplementedError

    def weight(self, value) -> int:
        return len(value)

    def __missing__(self, part: str):
        found = self.later.get(part)
        if found is None:
            found = self.work_out(part)
            if len(part) <= LONG_PART:
                takes = OVERHEAD + len(part) + self.weight(found)
                if self.taken + takes <= self.most * 3 // 4:
                    self.taken += takes
                    self[part] = found
                else:
                    if self.later_taken + takes > self.most // 4:
                        self.later, self.later_taken = {}, 0
                    self.later_taken += takes
                    self.later[part] = found
        return found
