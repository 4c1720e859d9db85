"""Token ids of whole texts, with the pieces that texts share encoded once per worker."""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Pieces that a worker remembers.
KNOWN_PIECES = 3 << 18
# Texts are cut together up to this many characters, and their new pieces encoded together.
CHUNK = 1 << 20
# Letters for sure, and a run of them that ends for sure: before ASCII punctuation, a blank, a line end or the end.
_LETTERS = r"[A-Za-zÀ-ÖØ-öø-ƺ]++(?=[!-/:-@\[-`{-~ \n]|\Z)"
_DROPPED = re.compile(rf"{_LETTERS}|[^ \n]+")
_ENDS = r"([A-Za-zÀ-ÖØ-öø-ƺ])([!-/:-@\[-`{-~])"
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ƺ]+").fullmatch
_WHITE = re.compile(r"\s").search
# Normalizer and splitter of word vocabularies: a run of plain letters is one word, in lower case.
_FOLDED = [
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
]
# How byte-level vocabularies write the 256 bytes: printable ones as they are, the others from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_SHOWN}))}


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, the same as from encoding the text in one go.

    Neither kind of tokenizer lets a token cross the start of white space or the end of a run of letters, so a text is the
    sequence of its pieces between single blanks and line ends, cut once more where such a run ends. If white space
    counts (``kept``), texts with other white space, or two such characters in a row, are encoded whole, and so are texts
    that may hold a special token. A run of letters is one word to a byte-level tokenizer, so its model is asked directly;
    so is that of a word tokenizer, once for all spellings of a word in upper and lower case. If white space counts, texts
    are cut and their distinct pieces numbered as Arrow arrays, so that Python meets a piece once per chunk of texts.
    """

    def __init__(self, path: str, kept: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self._tokenizer, self._kept, self._known = Tokenizer.from_file(path), kept, {}
        # What parts pieces that are encoded together: a line end, or a bar between blanks.
        self._mark, self._between = ("\n", "\n") if kept else ("|", " | ")
        self._mark_ids = self._ids(self._mark)
        t = self._tokenizer
        self._direct = kept and t.normalizer is None and isinstance(t.pre_tokenizer, ByteLevel) and not t.pre_tokenizer.add_prefix_space
        self._folded = not kept and [part and json.loads(part.__getstate__()) for part in (t.normalizer, t.pre_tokenizer)] == _FOLDED

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _ask(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words and their ids by the model alone."""
        ask = self._tokenizer.model.tokenize
        shown = "\0".join(words).encode().decode("latin-1").translate(_BYTES).split(_BYTES[0])
        return ((w, b"".join([t.id.to_bytes(4, "little") for t in ask(x)])) for w, x in zip(words, shown if words else (), strict=True))

    def _learn(self, new: list[str]) -> None:
        """Encode pieces in one go and part the ids at the marks; one by one if the marks do not come out."""
        if self._direct:
            self._known.update(self._ask([p for p in new if _PLAIN(p)]))
            new = [p for p in new if p not in self._known]
        if self._kept:  # pieces after which a text is not the sum of its pieces
            self._known.update((p, None) for p in new if p == " " or _WHITE(p, 1) or (p[0] != " " and p != "\n" and p[0].isspace()))
            new = [p for p in new if p not in self._known]
        elif self._folded and (plain := [p for p in new if _PLAIN(p) and "İ" not in p]):  # that one becomes two characters
            lower = "\0".join(plain).lower().split("\0")
            asked = dict(self._ask(list(set(lower).difference(self._known))))
            self._known.update([(p, asked[w] if w in asked else self._known[w]) for p, w in zip(plain, lower, strict=True)])
            new = [p for p in new if p not in self._known]
        joined = [p for p in new if self._mark not in p and not p[-1].isspace()] if len(self._mark_ids) == 1 else []
        if joined:
            ids = self._ids(self._between.join(joined))
            at = np.flatnonzero(ids == self._mark_ids[0])
            if len(at) == len(joined) - 1:
                data, starts, stops = ids.tobytes(), [0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), 4 * len(ids)]
                self._known.update(zip(joined, [data[a:b] for a, b in zip(starts, stops, strict=True)], strict=True))
        for p in new:
            if p not in self._known:
                self._known[p] = self._ids(p).tobytes()

    def _chunk(self, texts: list[str]) -> Iterator[bytes]:
        if len(self._known) > KNOWN_PIECES:
            self._known.clear()
        if self._kept:
            yield from self._parted(texts)
            return
        cut = [None if "<|" in t else _DROPPED.findall(t) for t in texts]
        if new := set().union(*[p for p in cut if p]).difference(self._known):
            self._learn(list(new))
        known = self._known.__getitem__
        for text, own in zip(texts, cut, strict=True):
            yield self._ids(text).tobytes() if own is None else b"".join(map(known, own))

    def _parted(self, texts: list[str]) -> Iterator[bytes]:
        """Texts parted in Arrow before blanks, around line ends and behind letters that end for sure."""
        whole = np.array(["<|" in t or "\n\n" in t or "\0" in t for t in texts])
        marked = pa.array(["" if w else t for t, w in zip(texts, whole, strict=True)], pa.large_string())
        for sign, parted in ((" ", "\0 "), ("\n", "\0\n\0")):
            marked = pc.replace_substring(marked, sign, parted)
        parts = pc.split_pattern(pc.replace_substring_regex(marked, _ENDS, "\\1\0\\2"), "\0")
        numbered, bounds = parts.values.dictionary_encode(), parts.offsets.to_numpy()
        del marked, parts
        at = numbered.indices.to_numpy()
        pieces, known = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), self._known
        ids = list(map(known.get, pieces))
        if missing := [n for n, i in enumerate(ids) if i is None]:
            if new := [pieces[n] for n in missing if pieces[n] and pieces[n] not in known]:
                self._learn(new)
            unsure = np.zeros(len(ids), bool)
            for n in missing:
                i = known[pieces[n]] if pieces[n] else b""
                ids[n], unsure[n] = i or b"", i is None
            if unsure.any():  # pieces that do not stand for themselves
                whole |= np.diff(np.concatenate([[0], np.cumsum(unsure[at])])[bounds]) > 0
        data, counts = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        firsts, counts = (np.cumsum(counts) - counts)[at], counts[at]
        ends = np.cumsum(counts)
        tokens = data[np.arange(counts.sum()) + np.repeat(firsts - ends + counts, counts)]
        bounds = np.concatenate([[0], ends])[bounds].tolist()
        for text, alone, start, stop in zip(texts, whole, bounds, bounds[1:]):
            yield self._ids(text).tobytes() if alone else tokens[start:stop].tobytes()

    def each(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of one text after the other; a null text has none."""
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= CHUNK:
                yield from self._chunk(held)
                held, size = [], 0
        if held:
            yield from self._chunk(held)

    def of(self, text: str | None) -> bytes:
        return next(self.each([text]))


def shared_encoder(path: str, kept: bool) -> Encoder:
    """The encoder that the tasks of a worker use one after another.

    Code travels to workers with each task, so what outlives a task is kept in a module made for it.
    """
    held = sys.modules.setdefault("terraframe_worker_state", types.ModuleType("terraframe_worker_state")).__dict__
    if held.get("key") != (path, kept):
        held["key"], held["encoder"] = (path, kept), Encoder(path, kept)
    return held["encoder"]
