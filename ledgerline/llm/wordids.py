"""Ids of whole texts with the tokenizers library, each distinct piece of text encoded once.

For a tokenizer that folds white space and drops it (normaliser: composition, white space,
lower case; split into letters, single digits and other signs), the pieces of that split do not
influence each other. Texts of plain letters then become rows of piece numbers, and ids are
gathered from the pieces' ids. Of other texts the words between ASCII white space are encoded
as they are; any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Pieces (and ids of theirs) a Python worker keeps; beyond that the half used less is dropped.
KEPT_PIECES, KEPT_IDS = 1_000_000, 8_000_000
# Characters of a text split at a time, at a blank.
STRETCH = 1 << 20

# Printable ASCII, its blanks, and Latin-1 letters with the two signs between them: splitting is plain.
_PLAIN = re.compile("[\t\n\r -~À-ÿ]*")
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\s0-9a-zß-öø-ÿ]+")
_BLANK = re.compile("[\t\n\r ]")
# In front of what goes to the library as it is; no piece of plain text starts with it.
_RAW = "\uffff"
# Byte-level alphabets show printable bytes as themselves, the rest as the characters from 256 on.
_HIDDEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
_SHOWN = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}


def _word_wise(settings: dict) -> bool:
    """Whether the tokenizer's steps are those under which words are independent."""
    normalizer, split = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    steps = [s.get("type") for s in normalizer.get("normalizers", [])]
    parts = split.get("pretokenizers", [])
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and normalizer["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        and [p.get("type") for p in parts] == ["Split", "ByteLevel"]
        and parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True
        and parts[0]["pattern"] == {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
        and not parts[1].get("add_prefix_space") and not parts[1].get("use_regex")
        and all("<|" in t["content"] and not t["single_word"] and not t["lstrip"] and not t["rstrip"] and not t["normalized"]
                for t in settings.get("added_tokens", []))
    )


class _Pieces(dict):
    """Row of every piece known so far; a new piece is encoded when it is asked for."""

    def __init__(self, learn) -> None:
        self.learn = learn

    def __missing__(self, key: str) -> int:
        row = self[key] = self.learn(key)
        return row


class TextEncoder:
    """Encodes texts to ids, each text followed by ``end``."""

    def __init__(self, path: str, end: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.word_wise = _word_wise(json.loads(self.full.to_str()))
        self.rows = _Pieces(self._learn)
        self.rows[""] = 0  # the empty piece stands for the end id
        self.ids, self.starts, self.sizes = array("I", [end]), array("q", [0]), array("q", [1])
        self.uses = np.zeros(1, np.int64)

    def _learn(self, key: str) -> int:
        """Encodes a piece, or a word or text the split does not apply to; returns its row."""
        if key[0] == _RAW:
            ids = self.full.encode(key[1:], add_special_tokens=False).ids
        else:
            shown = key if key.isascii() else key.encode().decode("latin-1").translate(_SHOWN)
            ids = [t.id for t in self.model.tokenize(shown)]
        self.starts.append(len(self.ids))
        self.sizes.append(len(ids))
        self.ids.extend(ids)
        return len(self.starts) - 1

    def _forget(self) -> None:
        """Keeps the half of the pieces that was used most; counts of uses fade."""
        rows = len(self.starts)
        keys = list(self.rows)
        kept = np.sort(np.argsort(-self.uses[1:rows], kind="stable")[: rows // 2] + 1)
        sizes = np.array(self.sizes)[kept]
        if sizes.sum() > KEPT_IDS // 2:
            kept, sizes = kept[:0], sizes[:0]
        starts, ids = np.array(self.starts)[kept], np.array(self.ids)
        ends = np.cumsum(sizes)
        at = np.repeat(starts - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
        self.rows.clear()
        self.rows[""] = 0
        self.rows.update((keys[old], new + 1) for new, old in enumerate(kept.tolist()))
        self.ids = array("I", np.concatenate((ids[:1], ids[at])).astype(np.uint32).tobytes())
        self.starts = array("q", np.concatenate(([0], 1 + ends - sizes)).astype(np.int64).tobytes())
        self.sizes = array("q", np.concatenate(([1], sizes)).astype(np.int64).tobytes())
        self.uses = np.concatenate(([0], self.uses[kept] // 2))

    def _pieces(self, content: bytes) -> Iterator[list[str]]:
        """Pieces of a text, a stretch at a time."""
        text = content.decode("utf-8", "replace")
        if not self.word_wise or "<|" in text:
            # A special token's string inside a text is matched as it is written, so such a text stays whole.
            yield [_RAW + text] if text else []
        elif _PLAIN.fullmatch(text):
            at = 0
            while at < len(text):
                cut = _BLANK.search(text, at + STRETCH) if len(text) - at > STRETCH else None
                end = cut.start() if cut else len(text)
                yield _SPLIT.findall(text[at:end].lower())
                at = end
        else:
            found: list[str] = []
            for word in content.split():
                part = word.decode("utf-8", "replace")
                found += _SPLIT.findall(part.lower()) if _PLAIN.fullmatch(part) else [_RAW + part]
            yield found

    def encode(self, batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (uint32), and per text how many (end id included)."""
        if not batch:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.starts) > KEPT_PIECES or len(self.ids) > KEPT_IDS:
            self._forget()
        row, parts, counts = self.rows.__getitem__, [], []
        for content in batch:
            total = 1
            for pieces in self._pieces(content):
                parts.append(np.fromiter(map(row, pieces), np.int32, len(pieces)))
                total += len(pieces)
            parts.append(np.zeros(1, np.int32))
            counts.append(total)
        at = np.concatenate(parts)
        used = np.bincount(at, minlength=len(self.starts))
        used[: len(self.uses)] += self.uses
        self.uses = used
        sizes = np.array(self.sizes)[at]
        ends = np.cumsum(sizes)
        from_ = np.array(self.starts)[at] - (ends - sizes)
        ids = np.array(self.ids)[np.repeat(from_, sizes) + np.arange(ends[-1])].astype(np.uint32, copy=False)
        counted = np.array(counts)
        return ids, np.add.reduceat(sizes, np.cumsum(counted) - counted)


@lru_cache(maxsize=2)
def encoder(path: str, end: int) -> TextEncoder:
    """One per Python worker, kept from task to task."""
    return TextEncoder(path, end)
