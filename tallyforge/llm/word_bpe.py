"""Exact ids of the lower-casing word tokenizer, from a table of words already seen.

The tokenizer drops white space and never merges across it, so a text's ids are those of its
white-space-separated words one after the other. Words repeat: each is given to the library once per
worker and looked up afterwards. A word with characters for which the library's normaliser and
Python could differ, or with the string of a special token, is given to the library as it stands.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

#: The characters the library's patterns take for white space and that compose with nothing.
SPACE = re.compile("[ \t\n\r]+")
#: Anything outside printable ASCII, Latin letters with marks and plain punctuation. Left out on purpose:
#: control characters, no-break space, superscript digits, fractions and the dotted capital I.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ‐-‧‰-⁞€]")
#: The tokenizer's split pattern, for usual characters.
PRETOKEN = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Longer words are not kept.
KEEP_CHARS = 64
#: Beyond this many words a worker's table goes back to the third that came first, in which the frequent ones are.
KEEP_WORDS = 300_000
#: Very long texts are worked through in pieces cut at white space.
PIECE_CHARS = 1 << 20


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    at = 0
    while len(text) - at > size:
        cut = SPACE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class WordBpe:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        bare = json.loads(self.library.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(bare))
        self.special = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab().items():
            self.ends[i] = token.endswith("</w>")

    def words(self, text: str) -> list[str]:
        """The white-space-separated words: lower-cased where that is surely what the library does."""
        if UNUSUAL.search(text) or any(s in text for s in self.special):
            return [w for w in SPACE.split(text) if w]
        return text.lower().split()

    def pretokens(self, text: str) -> list[str]:
        """The pieces that the library's split pattern makes; unusual words stay whole."""
        if UNUSUAL.search(text) or any(s in text for s in self.special):
            return [p for w in SPACE.split(text) if w for p in ([w] if self._alone(w) else PRETOKEN.findall(w.lower()))]
        return PRETOKEN.findall(text.lower())

    def _alone(self, word: str) -> bool:
        return bool(UNUSUAL.search(word)) or any(s in word for s in self.special)

    def encode(self, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Each word with its ids as little-endian 32-bit numbers. Usual words go to the library together, parted by spaces."""
        words = list(words)
        for i in range(0, len(words), 5000):
            part = words[i : i + 5000]
            if self._alone(joined := " ".join(part)) or "</w>" in joined:
                odd = [w for w in part if self._alone(w) or "</w>" in w]
                for word in odd:
                    yield word, np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
                part = list(set(part).difference(odd))
            plain = [w for w in part if w.isascii()]
            for some in (plain, [w for w in part if not w.isascii()] if len(plain) < len(part) else []):
                if some:
                    yield from zip(some, self._together(some), strict=True)

    def _together(self, words: list[str]) -> Iterator[bytes]:
        """The ids of usual words. They are split here and go to the model alone, without the library's normaliser."""
        split = [[w] if w.isalpha() else PRETOKEN.findall(w.lower()) for w in words]
        joined = " ".join([" ".join(p) for p in split]).lower()
        if not joined.isascii():
            joined = joined.encode().decode("latin-1").translate(_BYTE_LETTERS)
        ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
        marks = np.cumsum([len(p) for p in split])  # a word ends with the last of its pieces
        raw, start = ids.tobytes(), 0
        for stop in ends[marks - 1].tolist():
            yield raw[start:stop]
            start = stop


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in the vocabulary: visible Latin-1 ones for themselves, the others for letters from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + i) for i, b in enumerate(hidden) if b != 32}  # blanks stay: they part the pieces


_BYTE_LETTERS = _byte_letters()
