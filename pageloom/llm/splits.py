"""Remembering codes of a text's parts: a helper of the tokenizing operators.

A split pattern cuts a text into matches that are coded independently.
Between two characters that are not white space, a single space always
starts a new match, so a text may first be cut at such spaces and each part
(with its leading space) be cut and coded by itself; the parts are words,
few of which are new, so most are looked up.  A text with other white space
beside a space is cut as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

import regex


class _Beside(Exception):
    """White space beside a space: the text must be cut as a whole."""


class _Memory(dict):
    def __init__(self, code: Callable[[str], bytes], most: int):
        super().__init__()
        self.code, self.most = code, most

    def __missing__(self, part: str) -> bytes:
        coded = self.code(part)
        if len(self) >= self.most:
            self.clear()
        self[part] = coded
        return coded


class TextCoder:
    """Codes of whole texts, from a code of one match of ``pattern``, which
    must take a space with the letters after it (``" ?\\p{L}+"``) and other
    marks apart from letters, as the byte-level vocabularies' does.  At most
    ``remember`` parts and as many matches of other parts are remembered;
    that bounds memory and has no effect on results."""

    def __init__(self, pattern: str, code_match: Callable[[str], bytes], remember: int = 1_300_000):
        self.split, self.code = regex.compile(pattern).findall, code_match
        self.matches = _Memory(code_match, remember // 4)
        self.parts = _Memory(self._part, remember)

    def _whole(self, text: str) -> bytes:
        return b"".join(map(self.matches.__getitem__, self.split(text)))

    def _part(self, part: str) -> bytes:
        if part.isalpha():
            return self.code(" " + part)  # one match
        if part[:-1].isalpha() and part[-1] in ",.;:!?":
            return self.parts[part[:-1]] + self.matches[part[-1]]  # two
        if not part or part[0].isspace() or part[-1].isspace():
            raise _Beside
        return self._whole(" " + part)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        head, *rest = text.split(" ")
        if rest and head and head[-1].isspace():
            return self._whole(text)
        try:
            return self._whole(head) + b"".join(map(self.parts.__getitem__, rest))
        except _Beside:
            return self._whole(text)
