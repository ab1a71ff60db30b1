"""Places at which a text may be cut so that the parts are encoded as in the whole text.

*Byte-level BPE.* Its pattern cuts a text into pieces before it merges. No piece goes from a character
that is not white space on to one that is, and what follows such a place is matched as if nothing stood
before it. So every such place is safe; special tokens hold no white space, which is checked.
Inside of a run without white space, a place between an ASCII or other settled letter (or digit) and an
ASCII character of another kind is safe too, unless it lies in a special token.

*Sentence pieces.* With no normaliser, a space put in front of the text, and no piece of the vocabulary
with a space behind another character (all checked), no merge crosses the place before a space that
follows another character; that space is the one put in front of the part behind it.

White space is what the pattern of the vocabulary means by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

_WS = "\t-\r \x85\xa0  -     　"
_OTHER_WS = _WS.replace(" ", "")
_WORD = re.compile(rf"[{_WS}]*[^{_WS}]+|[{_WS}]+")
#: Begins with a space and goes up to the next place between another character and a space.
_SPACED = re.compile(rf" [{_WS}]*[^{_WS}]+(?:[{_OTHER_WS}][{_WS}]*[^{_WS}]+)*(?:[{_WS}]+\Z)?| [{_WS}]*\Z")
_CUT = re.compile(rf"(?<=[^{_WS}])(?=[{_WS}])")
_SPACE_CUT = re.compile(rf"(?<=[^{_WS}])(?= [{_WS}]*[^{_WS}])")
_LETTER = "A-Za-zÀ-ÖØ-öø-ʯа-яА-Яぁ-ゖァ-ヺ一-龥가-힣"
_CLASS_CUT = re.compile(rf"(?<=[{_LETTER}])(?=[0-9!-/:-@\[-`{{-~])|(?<=[0-9])(?=[A-Za-z!-/:-@\[-`{{-~])")

PART = 1 << 20  # characters after which a long text is cut


def words(text: str) -> list[str]:
    """The parts of a text between all its safe places for byte-level BPE."""
    return _WORD.findall(text)


def spaced_words(text: str) -> list[str]:
    """The parts of a text that begins with a space, safe for both kinds of tokenizers."""
    return _SPACED.findall(text)


def parts(text: str, spaced: bool = False, size: int = PART) -> Iterator[str]:
    """A long text in parts of about ``size`` characters; a stretch without a safe place stays whole."""
    cut, at = _SPACE_CUT if spaced else _CUT, 0
    while len(text) - at > size:
        found = cut.search(text, at + size)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def run_parts(run: str, specials: Iterable[str]) -> list[str]:
    """A run without white space, cut between kinds of characters and around special tokens."""
    names = sorted(specials, key=len, reverse=True)
    pieces = re.split("(" + "|".join(map(re.escape, names)) + ")", run) if names else [run]
    out = []
    for i, piece in enumerate(pieces):
        out += [piece] if i % 2 else _CLASS_CUT.split(piece)
    return [p for p in out if p]
