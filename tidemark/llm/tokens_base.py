"""A byte-level BPE vocabulary as the public files give it: tokens, ranks, and how text is split first."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import regex

#: Text is split by this pattern before any merge. The splitting library
#: counts these code points as white space, so not 1C to 1F.
_SPACE = r"\t\n\x0B\x0C\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_LETTER, _NUMBER = r"\p{L}", r"\p{N}"

#: Letters and numbers of Unicode 17, which the splitting library, at version 16, has as neither.
_LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)


def _pattern(letter: str, number: str) -> regex.Pattern:
    other = rf"[^{_SPACE}\p{{L}}\p{{N}}]" if letter == _LETTER else rf"(?:(?!{letter}|{number})[^{_SPACE}])"
    return regex.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    )


_later = "".join(f"{chr(a)}-{chr(b)}" for a, b in _LATER)
_HAS_LATER = regex.compile(f"[{_later}]")
_PIECE = _pattern(_LETTER, _NUMBER)
_PIECE_LATER = _pattern(rf"(?:(?![{_later}])\p{{L}})", rf"(?:(?![{_later}])\p{{N}})")


def pieces(text: str) -> list[str]:
    """What merges stay within: words with the space before them, numbers, other signs, white space."""
    plain = text.isascii() or _HAS_LATER.search(text) is None
    return (_PIECE if plain else _PIECE_LATER).findall(text)


_BESIDE = regex.compile(rf"[{_SPACE}]{{2}}")


def chunks(text: str) -> list[str]:
    """``text`` cut at spaces, these left out, and before line ends, where a piece surely begins.

    That is where each of them stands between two signs that are not white; a text
    in which one does not is one chunk.
    """
    if text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or _BESIDE.search(text):
        return [text]
    return text.replace("\n", " \n").split(" ")


def of_chunk(chunk: str) -> str:
    """The text of a chunk that is not the first."""
    return chunk if chunk[:1] == "\n" else f" {chunk}"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself where printable, else from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes, mergeable pairs, and the special strings.

    A pair of ids is one number, ``left * 65537 + right``; ``merges`` has for it the
    rank and the merged id as ``rank << 16 | id``, so the least is merged first.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        raw = lambda text: bytes(letters[c] for c in text)
        ids = {raw(text): number for text, number in spec["model"]["vocab"].items()}
        self.tokens = {number: text for text, number in ids.items()}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = (raw(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.merges.setdefault(ids[left] * 65537 + ids[right], rank << 16 | ids[left + right])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        decoded = self.tokens | {number: text.encode() for text, number in self.special.items()}
        self.decoded = [decoded.get(i) for i in range(max(decoded) + 1)]
        self.names = [str(i) for i in range(len(self.decoded))]
        self._special = regex.compile("|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)) or r"(?!)")

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """The text between special strings, and the special strings with their ids."""
        at = 0
        for found in self._special.finditer(text):
            if found.start() > at:
                yield text[at : found.start()], None
            yield found[0], self.special[found[0]]
            at = found.end()
        if at < len(text):
            yield text[at:], None


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The file read once a Python worker."""
    return Vocabulary(path)
