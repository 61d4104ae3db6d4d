"""Whole texts to token ids with a public tokenizer file, piece by piece.

Byte-level tokenizers never merge across the pieces that their pattern cuts a text into, so each piece
is encoded by the library's own model, or not at all if it is among the recent ones. Texts in Latin
letters are cut by the pattern with its classes written out; in others, chunks between white space
that go beyond Latin are left to the library. The answer equals that of the library on the whole text;
texts with special tokens or control characters that split differently go to the library whole.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import types
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex

# Unicode white space, and the characters that Python alone takes for white space.
SPACE = "\t-\r \x85\xa0  -     　"
EMPTY = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c))
CONTROLS = re.compile("[\x1c-\x1f]")
# Beyond this letter, character classes may differ between regex libraries and versions.
LAST_LATIN = "ɏ"
BEYOND_LATIN = re.compile(f"[^\x00-{LAST_LATIN}]")
# The pattern of byte-level pre-tokenization, a fixed value of the format.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEEP = 1 << 18  # pieces of one generation of the cache; those of more than LONGEST characters are not kept
LONGEST = 64
SLICE = 1 << 20  # characters of a long text that are cut into chunks at once


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself, or else the next beyond 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def of_worker(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, once for each worker process; only the last name's is held."""
    holder = sys.modules.setdefault("_of_text_worker", types.ModuleType("_of_text_worker")).__dict__
    if holder.get("name") != name:
        holder["value"], holder["name"] = make(), name
    return holder["value"]


def in_latin(pattern: str) -> str:
    """``pattern`` with its classes of letters, numbers and white space written out, up to the last Latin letter."""
    upto = [chr(c) for c in range(ord(LAST_LATIN) + 1)]
    listed = {
        k: "".join(c for c in upto if regex.match(rf"\p{{{k}}}", c)) for k in "LN"
    } | {"s": "".join(c for c in upto if c in EMPTY)}
    found, inside, at = [], False, 0
    for mark in re.finditer(r"\\p\{([LN])\}|\\(s)|\\S|\\.|[\[\]]", pattern):
        found.append(pattern[at : mark.start()])
        at, name = mark.end(), mark[1] or mark[2]
        if name:
            found.append(listed[name] if inside else f"[{listed[name]}]")
        elif mark[0] == r"\S":
            found.append(f"[^{listed['s']}]")
        else:
            inside = mark[0] == "[" or inside and mark[0] != "]"
            found.append(mark[0])
    return "".join([*found, pattern[at:]])


def release() -> None:
    """Give back what :func:`of_worker` holds; for stages that follow an encoding one in the same workers."""
    holder = sys.modules.get("_of_text_worker")
    if holder is not None and holder.__dict__.pop("name", None):
        del holder.__dict__["value"]
        gc.collect()


class Recent:
    """Ids by piece, for the pieces used last: two generations, of which the older goes when the
    younger is full, so that what is used often stays and the memory is bounded."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def among(self, pieces: list[str], make: Callable[[str], bytes]) -> list[bytes]:
        """The ids of each piece, made if they are not there."""
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    piece = pieces[i]
                    # It may have come up earlier in the same list.
                    found[i] = ids = young.get(piece) or old.get(piece) or make(piece)
                    if len(piece) <= LONGEST:
                        young[piece] = ids
            if len(young) >= KEEP:
                self.young, self.old = {}, self.young
        return found


class Encoder:
    """Ids of whole texts, each followed by ``end_id``, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, end_id: int):
        self.path, self.end_id = path, end_id

    def __getstate__(self):
        return {"path": self.path, "end_id": self.end_id}

    @cached_property
    def library(self):
        return self.layout["library"]

    @cached_property
    def layout(self) -> dict:
        return of_worker(self.path, self._layout)

    def _layout(self) -> dict:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, norm = spec["pre_tokenizer"], spec["normalizer"]
        if pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and norm is None:
            cut, pattern = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+", BYTE_LEVEL
        elif pre["type"] == "Sequence" and norm and any(n["type"] == "Lowercase" for n in norm["normalizers"]):
            cut, pattern = rf"[^{SPACE}]+", pre["pretokenizers"][0]["pattern"]["Regex"]
        else:
            raise ValueError(f"{self.path} is not a byte-level tokenizer of a known layout")
        special = [t["content"] for t in spec["added_tokens"]]
        del spec
        library, letters = Tokenizer.from_file(self.path), byte_letters()
        return {
            "cut": re.compile(cut).findall, "pieces": regex.compile(pattern).findall,
            "latin": re.compile(in_latin(pattern)).findall, "lower": norm is not None,
            "special": special, "letters": letters, "space": letters[32], "library": library,
            "recent": Recent(), "tokenize": library.model.tokenize, "border": re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])").search,
        }

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, piece: str) -> bytes:
        """Ids of one piece, whatever was before."""
        at = self.layout
        if piece.isascii() and piece.isalpha():
            shown = piece
        elif piece.isascii() and piece[0] == " " and piece[1:].isalpha():
            shown = at["space"] + piece[1:]
        else:
            shown = "".join(map(at["letters"].__getitem__, piece.encode()))
        return array("I", [t.id for t in at["tokenize"](shown)]).tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Ids of one chunk that is not among the recent ones."""
        if not chunk.isascii() and BEYOND_LATIN.search(chunk):
            return self.whole(chunk)
        return b"".join(self.layout["recent"].among(self.layout["pieces"](chunk), self.word))

    def slices(self, text: str) -> Iterator[str]:
        """A long text in parts that are cut into the same chunks as the whole: after a word, before a space."""
        at = 0
        while len(text) - at > SLICE and (border := self.layout["border"](text, at + SLICE)):
            yield text[at : border.start()]
            at = border.start()
        yield text[at:] if at else text

    def __call__(self, text: str | None) -> bytes:
        text, at = text or "", self.layout
        end = self.end_id.to_bytes(4, "little")
        if CONTROLS.search(text) or any(s in text for s in at["special"]):
            return self.whole(text) + end
        latin = text.isascii() or not BEYOND_LATIN.search(text)
        if at["lower"]:
            # Up to here letters are composed already, and each has its own lower case.
            text = text.lower() if latin else self.library.normalizer.normalize_str(text)
            latin = latin and not BEYOND_LATIN.search(text)
        cut, make = (at["latin"], self.word) if latin else (at["cut"], self.chunk)
        among = at["recent"].among
        return b"".join(b"".join(among(cut(part), make)) for part in self.slices(text)) + end
